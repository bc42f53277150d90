"""Hard negatives by slot-decomposed selection.

Each positive of an anchor allows negatives up to an upper limit and from a lower one. The
upper limits, in falling order, split the scores into disjoint slots. Whatever part of the
rows a task has scored, it keeps the best few rows of each slot; the best rows below some
limit are then the first of the slots from there down, merged in falling order, and the
lower limit only cuts that list. So all overlapping windows of an anchor are answered from
one short list, however many rows lie in them.

Anchors are compared with all rows in blocks: a block of anchors meets a block of rows by a
join on the pair of their numbers, so that no block is held by the driver or sent to all.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from runnel.llm.text import checkpoint

POSITIVES = 5
NEGATIVES = 3
#: A negative has at least LOW and at most HIGH hundredths of the positive's score.
LOW, HIGH = 50, 95
SCALE = 256
#: Rows and bytes of vectors in a block; a table has at least BLOCKS blocks if they have
#: LEAST_ROWS rows each. They change the plan, not the result.
ANCHOR_ROWS = 65_536
BLOCK_ROWS = 262_144
BLOCK_BYTES = 1 << 25
BLOCKS = 32
LEAST_ROWS = 1_024
#: Scores held at a time: anchors by rows.
TILE = 512, 4_096
#: Stands for a missing id: behind every other one.
NO_ID = (1 << 63) - 1
LOWEST = -(1 << 63)
PACKED = "id long, label long, anchor boolean, width int, vector binary, own long"
FOUND = "anchor long, slot int, id long, score long"


def pack_rows(
    rows: DataFrame, id_col: str, vector_col: str, label: Column, anchor: Column
) -> DataFrame:
    """Rows that take part, with ``floor(SCALE * x)`` of their components as little-endian
    integers of ``width`` bytes (2 if all fit, else 8), and their score with themselves."""
    picked = rows.select(
        F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("id"),
        label.cast("long").alias("label"),
        F.coalesce(anchor, F.lit(False)).alias("anchor"),
        F.col(vector_col).cast("array<double>").alias("x"),
    )
    whole = picked.where("label IS NOT NULL AND x IS NOT NULL").where(
        ~F.exists("x", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    )
    names = [c.split()[0] for c in PACKED.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(3)
            flat = np.floor(SCALE * lists.flatten().to_numpy(zero_copy_only=False))
            ends = lists.offsets.to_numpy()
            ends = (ends - ends[0]).tolist()
            widths, vectors, owns = [], [], []
            for start, stop in zip(ends[:-1], ends[1:], strict=True):
                part = flat[start:stop]
                most = np.abs(part).max() if part.size else 0
                if most**2 * part.size >= 2.0**63:
                    raise ValueError("the components of a row are too large for 64-bit scores")
                widths.append(2 if most < 2**15 else 8)
                vectors.append(part.astype("<i2" if most < 2**15 else "<i8").tobytes())
                ints = part.astype(np.int64)
                owns.append(int(ints @ ints))
            made = pa.array(widths, pa.int32()), pa.array(vectors, pa.binary()), pa.array(owns, pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], *made], names)

    return whole.mapInArrow(run, PACKED)


def matrix(widths: np.ndarray, vectors: list[bytes]) -> np.ndarray:
    """The vectors as rows of one integer matrix; shorter ones end in zeros."""
    kinds = {2: np.dtype("<i2"), 8: np.dtype("<i8")}
    if len(set(widths.tolist())) == 1 and len({len(v) for v in vectors}) == 1:
        return np.frombuffer(b"".join(vectors), kinds[int(widths[0])]).reshape(len(vectors), -1)
    rows = [np.frombuffer(v, kinds[w]) for w, v in zip(widths.tolist(), vectors, strict=True)]
    out = np.zeros((len(rows), max(map(len, rows), default=0)), np.int64)
    for i, row in enumerate(rows):
        out[i, : len(row)] = row
    return out


def score_type(a: np.ndarray, b: np.ndarray) -> np.dtype:
    """The fastest type in which all inner products of the rows are exact."""
    most = [int(np.abs(m.astype(np.float64)).max()) if m.size else 0 for m in (a, b)]
    bound = most[0] * most[1] * max(a.shape[1], 1)
    if bound < 1 << 24:
        return np.dtype(np.float32)
    if bound < 1 << 53:
        return np.dtype(np.float64)
    if bound >= 1 << 63:
        raise ValueError("scores do not fit 64 bits")
    return np.dtype(np.int64)


class Slots:
    """The best ``keep`` rows of each slot of each anchor, among the rows seen so far.

    Slot ``j`` of an anchor takes scores up to ``limits[:, j]`` and above the next limit; the
    last one has no lower end but ``floors``. Rows must come in rising order of their ids,
    so that of equal scores the earlier one stays.
    """

    def __init__(self, limits: np.ndarray, floors: np.ndarray, keep: int) -> None:
        self.limits, self.floors, self.keep = limits, floors.copy(), keep
        number, slots = limits.shape
        self.shape = number, slots
        self.scores = np.full((number * slots, keep), LOWEST, np.int64)
        self.ids = np.full((number * slots, keep), NO_ID, np.int64)
        self.held = np.zeros(number * slots, np.int64)

    def offer(self, first: int, scores: np.ndarray, ids: np.ndarray, allowed) -> None:
        """Scores of the anchors from ``first`` on; ``allowed`` tests index pairs."""
        number, slots = len(scores), self.shape[1]
        span = slice(first, first + number)
        kind = scores.dtype
        low = self.floors[span].astype(kind)[:, None]
        high = self.limits[span, 0].astype(kind)[:, None]
        a, r = np.nonzero((scores >= low) & (scores <= high))
        fits = allowed(a, r)
        a, r = a[fits], r[fits]
        value = scores[a, r].astype(np.int64)
        slot = (value[:, None] <= self.limits[span][a]).sum(1) - 1
        key = (a + first) * slots + slot
        worst = self.scores[:, -1]
        better = (self.held[key] < self.keep) | (value > worst[key])
        key, value, ident = key[better], value[better], ids[r[better]]
        if not len(key):
            return
        touched = np.unique(key)
        old = np.repeat(touched, self.held[touched])
        place = np.arange(len(old)) - np.repeat(
            np.cumsum(self.held[touched]) - self.held[touched], self.held[touched]
        )
        key = np.concatenate([old, key])
        value = np.concatenate([self.scores[old, place], value])
        ident = np.concatenate([self.ids[old, place], ident])
        order = np.lexsort((ident, ~value, key))
        key, value, ident = key[order], value[order], ident[order]
        new = np.ones(len(key), bool)
        new[1:] = key[1:] != key[:-1]
        start = np.maximum.accumulate(np.where(new, np.arange(len(key)), 0))
        rank = np.arange(len(key)) - start
        kept = rank < self.keep
        self.scores[key[kept], rank[kept]] = value[kept]
        self.ids[key[kept], rank[kept]] = ident[kept]
        self.held[touched] = np.bincount(key[kept], minlength=len(self.held))[touched]
        # Nothing below a full last slot can count any more.
        last = np.arange(first, first + number) * slots + slots - 1
        full = self.held[last] == self.keep
        raised = np.maximum(self.floors[span], np.where(full, worst[last] + 1, LOWEST))
        self.floors[span] = raised

    def rows(self, anchors: np.ndarray) -> pa.Table:
        key, place = np.nonzero(np.arange(self.keep) < self.held[:, None])
        names = [c.split()[0] for c in FOUND.split(", ")]
        values = (
            anchors[key // self.shape[1]], (key % self.shape[1]).astype(np.int32),
            self.ids[key, place], self.scores[key, place],
        )
        return pa.table(dict(zip(names, values, strict=True)))


def _block(table: pa.Table, names: list[str]) -> list[np.ndarray]:
    return [table[n].to_numpy() for n in names]


def best_of_blocks(keep: int, same_label: bool):
    """Scores a block of anchors against a block of rows, and keeps the best of each slot.

    With ``same_label`` only rows of the anchor's label count, and only these are scored.
    """

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return pa.table({n: pa.array([], t) for n, t in (
                ("anchor", pa.int64()), ("slot", pa.int32()),
                ("id", pa.int64()), ("score", pa.int64()),
            )})
        left = left.sort_by("label")
        right = right.sort_by([("label", "ascending"), ("id", "ascending")] if same_label else "id")
        anchors, a_labels, a_widths = _block(left, ["anchor", "label", "width"])
        ids, labels, widths = _block(right, ["id", "label", "width"])
        a = matrix(a_widths, left["vector"].to_pylist())
        b = matrix(widths, right["vector"].to_pylist())
        dims = max(a.shape[1], b.shape[1])
        a, b = (np.pad(m, ((0, 0), (0, dims - m.shape[1]))) for m in (a, b))
        kind = score_type(a, b)
        limits = np.array(left["limits"].to_pylist(), np.int64).reshape(len(anchors), -1)
        slots = Slots(limits, left["floor"].to_numpy(), keep)
        step_a, step_b = TILE
        for i in range(0, len(anchors), step_a):
            some = a[i : i + step_a].astype(kind)
            mine = a_labels[i : i + step_a]
            low, high = 0, len(ids)
            if same_label:
                low = np.searchsorted(labels, mine[0], "left")
                high = np.searchsorted(labels, mine[-1], "right")
            for j in range(low, high, step_b):
                end = min(j + step_b, high)
                theirs = labels[j:end]
                scores = some @ b[j:end].astype(kind).T
                slots.offer(
                    i, scores, ids[j:end],
                    lambda x, y, mine=mine, theirs=theirs: (mine[x] == theirs[y]) == same_label,
                )
        return slots.rows(anchors)

    return run


def _parts(rows: int, width: int, most: int, least: int) -> int:
    """Into how many blocks rows of so many bytes are dealt."""
    fitting = -(-rows // max(min(most, BLOCK_BYTES // max(width, 1)), 1))
    return max(fitting, min(least, rows // LEAST_ROWS), 1)


def _dealt(df: DataFrame, number: str, parts: int, name: str) -> DataFrame:
    return df.withColumn(name, F.pmod(F.xxhash64(number), F.lit(parts)).cast("int"))


def _meet(
    anchors: DataFrame, rows: DataFrame, parts: tuple[int, int], keep: int, same_label: bool
) -> DataFrame:
    """The best rows of each slot, over all pairs of blocks."""
    n_a, n_r = parts
    left = _dealt(anchors, "anchor", n_a, "_a").withColumn(
        "_r", F.explode(F.sequence(F.lit(0), F.lit(n_r - 1)))
    )
    right = _dealt(rows, "number", n_r, "_r").withColumn(
        "_a", F.explode(F.sequence(F.lit(0), F.lit(n_a - 1)))
    )
    left = left.select("_a", "_r", "anchor", "label", "width", "vector", "limits", "floor")
    right = right.select("_a", "_r", "id", "label", "width", "vector")
    met = left.groupBy("_a", "_r").cogroup(right.groupBy("_a", "_r"))
    found = met.applyInArrow(best_of_blocks(keep, same_label), FOUND)
    best = Window.partitionBy("anchor", "slot").orderBy(F.desc("score"), "id")
    return found.withColumn("place", F.row_number().over(best)).where(F.col("place") <= keep)


def mine_negatives(
    rows: DataFrame,
    anchor: Column,
    label: Column | None = None,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
) -> DataFrame:
    """Hard negatives of each positive of the rows that ``anchor`` selects.

    Scores are integer inner products of the components' ``floor(256 * x)``. An anchor's
    positives are its best other rows of the same label; of the rows of other labels, the
    best between ``LOW`` and ``HIGH`` hundredths of the positive's score are its negatives.
    Ties go to the smaller id. ``label`` replaces the column ``label_col``.

    Rows with a null label, a null vector, or a null or non-finite component take no part;
    vectors of different lengths are compared as if the shorter one ended in zeros. A row
    without an id takes part behind all others of its score (2^63 - 1 is read as no id). A
    repeated row is another row: it can be its copy's positive, and a repeated anchor gives
    its rows again. An empty table gives no rows; other columns are not read. Components and
    scores beyond 64 bits are an error.
    """
    label = F.col(label_col) if label is None else label
    packed = checkpoint(pack_rows(rows, id_col, vector_col, label, anchor))
    numbered = packed.withColumn("number", F.monotonically_increasing_id())
    size = packed.agg(
        F.count(F.lit(1)), F.count_if("anchor"), F.coalesce(F.max(F.length("vector")), F.lit(0))
    ).first()
    parts = (
        _parts(size[1], size[2], ANCHOR_ROWS, 1),
        _parts(size[0], size[2], BLOCK_ROWS, BLOCKS),
    )
    chosen = numbered.where("anchor").drop("anchor").withColumnRenamed("number", "anchor")
    others = numbered.drop("anchor")
    every_score = {"limits": F.array(F.lit(NO_ID)), "floor": F.lit(LOWEST)}
    near = _meet(chosen.withColumns(every_score), others, parts, positives + 1, True)
    limited = checkpoint(_windows(chosen, near, positives))
    below = _meet(limited.drop("windows"), others, parts, negatives, False)
    return _answers(limited.select("anchor", "id", "windows"), below, negatives)


def _hundredths(score: Column, share: int) -> Column:
    """Exact at any 64-bit score."""
    return score.cast("decimal(20,0)") * F.lit(share).cast("decimal(3,0)") / F.lit(100).cast("decimal(3,0)")


def _windows(chosen: DataFrame, near: DataFrame, positives: int) -> DataFrame:
    """The anchors with the ``windows`` of their positives, and the slots that these make.

    An anchor is among its own nearest rows at most once too often: one row with its id and
    its own score is left out.
    """
    listed = near.groupBy("anchor").agg(
        F.array_sort(F.collect_list(F.struct("place", "id", "score"))).alias("near")
    )
    itself = F.array_position(
        F.transform("near", lambda n: (n["id"] == F.col("id")) & (n["score"] == F.col("own"))), True
    )
    found = chosen.join(listed, "anchor").withColumn("_itself", itself)
    kept = F.slice(F.filter("near", lambda n, i: i != F.col("_itself") - 1), 1, positives)
    window = F.transform(
        kept,
        lambda n: F.struct(
            n["id"].alias("id"),
            n["score"].alias("score"),
            F.ceil(_hundredths(n["score"], LOW)).cast("long").alias("low"),
            F.floor(_hundredths(n["score"], HIGH)).cast("long").alias("high"),
        ),
    )
    highs = F.transform("windows", lambda w: w["high"])
    padding = F.array_repeat(F.element_at(highs, -1), F.lit(positives) - F.size("windows"))
    return (
        found.withColumn("windows", window)
        .where(F.size("windows") > 0)
        .withColumn("limits", F.concat(highs, padding))
        .withColumn("floor", F.array_min(F.transform("windows", lambda w: w["low"])))
        .drop("near", "_itself", "own")
    )


def _answers(windows: DataFrame, below: DataFrame, negatives: int) -> DataFrame:
    """Each window's first rows, from the slots merged in falling order."""
    merged = below.groupBy("anchor").agg(
        F.array_sort(
            F.collect_list(F.struct("slot", (-F.col("score")).alias("falling"), "id", "score"))
        ).alias("merged")
    )
    each = windows.withColumnRenamed("id", "anchor_id").join(merged, "anchor")
    each = each.select("anchor_id", F.explode("windows").alias("w"), "merged")
    first = F.slice(F.filter("merged", lambda m: m["score"] <= F.col("w.high")), 1, negatives)
    kept = F.filter(first, lambda m: m["score"] >= F.col("w.low"))
    ranked = each.select("anchor_id", "w", F.posexplode(kept).alias("at", "m"))
    return ranked.select(
        "anchor_id",
        F.nullif(F.col("w.id"), F.lit(NO_ID)).alias("positive_id"),
        (F.col("at") + 1).cast("long").alias("rank"),
        F.nullif(F.col("m.id"), F.lit(NO_ID)).alias("negative_id"),
        F.col("w.score").alias("positive_score"),
        F.col("m.score").alias("negative_score"),
    )
