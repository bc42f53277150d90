"""Physical layout: partitioning for writes, caching, compaction and clustering."""

from __future__ import annotations

import math
from bisect import bisect_left
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Rows from which the bounds of the buckets are taken.
SAMPLE_ROWS = 16_384
#: Buckets of a column, and z-values in all, as powers of two. With two columns or more only
#: the second one binds.
MOST_BITS, CELL_BITS = 12, 20
#: Up to so many buckets are told apart by nested conditions, more by a search in an array.
NESTED_BITS = 8
ROWS_PER_FILE = 5_000_000


def repartition_by_date(
    df: DataFrame, date_col: str = "event_date", n: int | None = None
) -> DataFrame:
    """Brings the rows of a date together for a partitioned write.

    A rebalance, not a plain hash: adaptive execution splits a large date over several
    tasks and joins small ones. ``n`` sets the initial number of partitions.
    """
    spread = [F.col(date_col)] if n is None else [n, F.col(date_col)]
    return df.hint("rebalance", *spread)


def cache_if_reused(df: DataFrame, uses: int = 2) -> DataFrame:
    """Caches a frame that is read more than once; release it with ``unpersist()``."""
    return df.persist() if uses > 1 else df


def _bounds(values: Sequence, buckets: int) -> list:
    """The values at which a new bucket starts, so that the buckets hold nearly equal shares."""
    known = sorted(v for v in values if v is not None and v == v)
    places = [i for i, v in enumerate(known) if i == 0 or v != known[i - 1]]
    cuts = set()
    for b in range(1, buckets):
        want = b * len(known) / buckets
        j = bisect_left(places, want)
        near = [k for k in (j - 1, j) if 0 < k < len(places)]
        cuts |= {min(near, key=lambda k: abs(places[k] - want))} if near else set()
    return [known[places[k]] for k in sorted(cuts)]


def _bucket(x: Column, bounds: Sequence[Column], first: int = 0) -> Column:
    """Binary search for the number of bounds not above ``x``."""
    if not bounds:
        return F.lit(first)
    mid = len(bounds) // 2
    return F.when(x < bounds[mid], _bucket(x, bounds[:mid], first)).otherwise(
        _bucket(x, bounds[mid + 1 :], first + mid + 1)
    )


def _searched_bucket(x: Column, bounds: Sequence[Column]) -> Column:
    """The same number, or zero for a null, by halving steps over an array of the bounds, for many of them."""
    if not bounds:
        return F.lit(0)
    array = F.array(*bounds)
    steps = F.array(*[F.lit(2**i) for i in reversed(range(len(bounds).bit_length()))])

    def step_on(at: Column, step: Column) -> Column:
        # A place beyond the bounds gives null, so the step is not taken.
        return F.when(F.get(array, at + step - 1) <= x, at + step).otherwise(at)

    return F.aggregate(steps, F.lit(0), step_on)


def bucket_bits(files: int, columns: int) -> int:
    """Bits for each column: four buckets more along each than the files need."""
    needed = math.ceil(math.log2(max(files, 2)) / columns) + 2
    return min(needed, MOST_BITS, CELL_BITS // columns)


def _buckets(df: DataFrame, cols: Sequence[str], bits: int) -> list[Column]:
    """The bucket of each column, of ``2 ** bits`` with about equal shares; nulls in the first.

    The buckets' bounds are whole values, taken from ``SAMPLE_ROWS`` rows chosen by hash of
    these columns and the row's place; no other column is read.
    """
    drawn = F.xxhash64(*cols, F.monotonically_increasing_id()).alias("_at")
    chosen = df.select(*cols, drawn).orderBy("_at")
    sample = chosen.limit(SAMPLE_ROWS).collect()
    out = []
    for c in cols:
        kind = df.schema[c].dataType
        cuts = [F.lit(v).cast(kind) for v in _bounds([r[c] for r in sample], 2**bits)]
        number = (_searched_bucket if bits > NESTED_BITS else _bucket)(F.col(c), cuts)
        out.append(F.when(F.col(c).isNull(), 0).otherwise(number).cast("bigint"))
    return out


def z_value(df: DataFrame, cols: Sequence[str], bits: int) -> Column:
    """Interleaved bits of the columns' buckets."""
    z = F.lit(0).cast("bigint")
    for place, bucket in enumerate(_buckets(df, cols, bits)):
        for bit in range(bits):
            one = F.shiftright(bucket, bit).bitwiseAND(F.lit(1).cast("bigint"))
            z = z + F.shiftleft(one, bit * len(cols) + place)
    return z


def hilbert_place(x: Column, y: Column, bits: int) -> Column:
    """How far along a Hilbert curve of ``4 ** bits`` cells the cell ``(x, y)`` lies.

    From the largest squares to the smallest: the number of the quarter counts, and the cell
    is turned into that quarter's own direction.
    """
    top = 2**bits - 1
    halves = F.array(*[F.lit(2**i).cast("bigint") for i in reversed(range(bits))])
    begin = F.struct(F.lit(0).cast("bigint").alias("d"), x.alias("x"), y.alias("y"))

    def enter(at: Column, half: Column) -> Column:
        right, upper = at["x"].bitwiseAND(half) > 0, at["y"].bitwiseAND(half) > 0
        quarter = F.when(right, F.when(upper, 2).otherwise(3)).otherwise(F.when(upper, 1).otherwise(0))
        flipped = right & ~upper
        across = F.when(flipped, F.lit(top) - at["x"]).otherwise(at["x"])
        along = F.when(flipped, F.lit(top) - at["y"]).otherwise(at["y"])
        return F.struct(
            (at["d"] + half * half * quarter).alias("d"),
            F.when(upper, across).otherwise(along).alias("x"),
            F.when(upper, along).otherwise(across).alias("y"),
        )

    return F.aggregate(halves, begin, enter, lambda at: at["d"])


def hilbert_value(df: DataFrame, cols: Sequence[str], bits: int) -> Column:
    """The place of the buckets of two columns on a Hilbert curve."""
    if len(cols) != 2:
        raise ValueError("a Hilbert curve takes two columns")
    return hilbert_place(*_buckets(df, cols, bits), bits)


CURVES = {"z": z_value, "hilbert": hilbert_value}


def _file_cells(keyed: DataFrame, files: int) -> DataFrame:
    """For each place on the curve its first file and how many it fills, by exact counts.

    There are at most ``2 ** CELL_BITS`` places, so their running sum is one small task.
    """
    counted = keyed.groupBy("_z").agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.orderBy("_z").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum("_n").over(earlier), F.lit(0))
    share = F.sum("_n").over(Window.partitionBy()) / F.lit(files)
    cells = counted.select("_z", "_n", start.alias("_start"), share.alias("_share"))
    small = F.col("_n") < F.col("_share")
    middle = F.floor((F.col("_start") + F.col("_n") / 2) / F.col("_share"))
    first = F.round(F.col("_start") / F.col("_share"))
    last = F.round((F.col("_start") + F.col("_n")) / F.col("_share"))
    return cells.select(
        "_z",
        F.when(small, middle).otherwise(first).cast("int").alias("_first"),
        F.when(small, 1).otherwise(F.greatest(last - first, F.lit(1))).cast("int").alias("_span"),
    )


def compact(
    df: DataFrame,
    cols: Sequence[str] | None = None,
    files: int | None = None,
    curve: str = "z",
) -> DataFrame:
    """The same rows in fewer, larger partitions, clustered along ``cols`` if given.

    ``curve`` orders the cells. Along ``hilbert``, for two columns, neighbours on the curve
    are neighbours in the plane, so files that are not whole squares are narrower than by
    ``z``. Files are cut on exact counts of places on the curve. Rows that agree in every clustering column
    are spread by their hash over as many files as they fill.
    """
    if not cols:
        return df.repartition(files) if files else df.hint("rebalance")
    if files is None:
        files = max(1, math.ceil(df.count() / ROWS_PER_FILE))
    keyed = df.withColumn("_z", CURVES[curve](df, cols, bucket_bits(files, len(cols))))
    placed = keyed.join(F.broadcast(_file_cells(keyed, files)), "_z")
    spread = F.pmod(F.xxhash64(*df.columns), F.col("_span")).cast("int")
    number = F.least(F.col("_first") + spread, F.lit(files - 1))
    ranged = placed.repartitionById(files, number)
    return ranged.sortWithinPartitions("_z", *cols).select(*df.columns)
