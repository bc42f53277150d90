"""Helpers of the operators: words of whole texts as bytes, Arrow passes, checkpoints."""

from __future__ import annotations

import pickle
import zlib
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructField, StructType, _parse_datatype_string


def _table(keep: Callable[[int], bool]) -> bytes:
    low = [b + 32 if 65 <= b <= 90 else b for b in range(256)]
    return bytes(b if keep(b) else 32 for b in low)


#: A-Z to a-z; every other byte stays.
LOWER = _table(lambda _: True)
#: A-Z to a-z; all ASCII but letters and digits to a space.
ALNUM = _table(lambda b: b >= 128 or 48 <= b <= 57 or 97 <= b <= 122)

#: A key with more than this part of all rows is cut up in a join.
HOT_SHARE = 1000


def spaced_words(text: bytes | None) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+``: ``bytes.split`` splits at these six bytes alone."""
    return text.split() if text else []


def lower_words(text: bytes | None) -> list[bytes]:
    """The same words, A-Z lower-cased."""
    return text.translate(LOWER).split() if text else []


def alnum_words(text: bytes | None) -> list[bytes]:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the text with A-Z lower-cased."""
    return text.translate(ALNUM).split() if text else []


def checkpoint(df: DataFrame) -> DataFrame:
    """Cuts the lineage through the shared folder that ``spark.checkpoint.dir`` names."""
    spark = df.sparkSession
    if not spark.sparkContext.getCheckpointDir():
        base = spark.conf.get("spark.checkpoint.dir", None)
        if not base:
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        spark.sparkContext.setCheckpointDir(base)
    return df.checkpoint(eager=True)


def join_spread(
    rows: DataFrame, keys: DataFrame, on: Sequence[str], by: Sequence[str], share: int = HOT_SHARE
) -> DataFrame:
    """Joins ``rows`` with ``keys``, whose ``n`` says how many of the rows each key has.

    A key with more than a ``share``-th of the rows is cut into parts no larger than that,
    by a hash of the columns ``by``. There are fewer than ``share`` such keys, so their
    broadcast is bounded. ``keys`` is read twice and should be a checkpoint.
    """
    total = keys.agg(F.sum("n")).first()[0] or 1
    parted = keys.withColumn("_parts", F.ceil(F.col("n") * share / total).cast("int"))
    hot = F.broadcast(parted.where("_parts > 1").select(*on, "_parts"))
    part = F.coalesce(F.pmod(F.xxhash64(*by), "_parts").cast("int"), F.lit(0))
    salted = rows.join(hot, list(on), "left").withColumn("_part", part).drop("_parts")
    every = F.explode(F.sequence(F.lit(0), F.col("_parts") - 1))
    dealt = parted.withColumn("_part", every).drop("n", "_parts")
    return salted.join(dealt, [*on, "_part"]).drop("_part")


def share(spark: SparkSession, value: object) -> Broadcast[bytes]:
    """Broadcasts a value compressed: tables with many zeros take little room on disks."""
    return spark.sparkContext.broadcast(zlib.compress(pickle.dumps(value, 5), 1))


def shared_value(shared: Broadcast[bytes]):
    return pickle.loads(zlib.decompress(shared.value))


@dataclass
class Counts:
    """Numbers by 64-bit hash; any hash that is not there has zero."""

    keys: np.ndarray
    values: np.ndarray

    @classmethod
    def made(cls, keys: np.ndarray, values: np.ndarray) -> Counts:
        some = np.flatnonzero(values)
        some = some[np.argsort(keys[some])]
        return cls(keys[some], values[some].astype(np.float64))

    def of(self, hashes: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.zeros(len(hashes))
        distinct, back = np.unique(hashes, return_inverse=True)
        at = np.minimum(np.searchsorted(self.keys, distinct), len(self.keys) - 1)
        return np.where(self.keys[at] == distinct, self.values[at], 0.0)[back]


def as_binary(name: str) -> Column:
    return F.col(name).cast("string").cast("binary")


def texts(column: pa.Array) -> Iterator[bytes | None]:
    """The column's values as bytes, one at a time."""
    return (x.as_py() for x in column.cast(pa.binary()))


def _rows_and_text(
    df: DataFrame, text_col: str, carry: Sequence[str] | None
) -> tuple[DataFrame, StructField, Callable[[pa.RecordBatch], pa.Array]]:
    """The carried columns as a struct ``row``, and how to get the text out of a batch."""
    names = list(df.columns if carry is None else carry)
    row = F.struct(*[df[f"`{c}`"] for c in names]).alias("row")
    if text_col in names and dict(df.dtypes)[text_col] == "string":
        at, picked = names.index(text_col), df.select(row)
        take = lambda batch: batch.column(0).field(at)
    else:
        picked = df.select(row, df[f"`{text_col}`"].cast("string").cast("binary").alias("text"))
        take = lambda batch: batch.column(1)
    return picked, picked.schema["row"], take


def map_texts(
    df: DataFrame,
    text_col: str,
    start: Callable[[], Callable[[bytes | None], tuple]],
    fields: str,
    carry: Sequence[str] | None = None,
) -> DataFrame:
    """One row out for one row in: ``row`` and the ``fields`` (a DDL list).

    ``row`` is a struct of the input's columns, or of those named by ``carry``, so added
    names cannot clash with them. ``start`` makes the row function, once for each task.
    """
    picked, row, take = _rows_and_text(df, text_col, carry)
    added = _parse_datatype_string(fields)
    kinds = to_arrow_schema(added)
    out = StructType([StructField("row", row.dataType, False), *added.fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one = start()
        for batch in batches:
            made = [one(text) for text in texts(take(batch))]
            columns = list(zip(*made, strict=True)) or [()] * len(kinds)
            arrays = [pa.array(c, f.type) for c, f in zip(columns, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], out.names)

    return picked.mapInArrow(run, out)


def map_batches(
    df: DataFrame,
    text_col: str,
    start: Callable[[], Callable[[list[bytes | None]], list[Sequence]]],
    fields: str,
    carry: Sequence[str] | None = None,
    size: int = 1000,
) -> DataFrame:
    """As :func:`map_texts`, but the function gets up to ``size`` texts and gives columns."""
    picked, row, take = _rows_and_text(df, text_col, carry)
    added = _parse_datatype_string(fields)
    kinds = to_arrow_schema(added)
    out = StructType([StructField("row", row.dataType, False), *added.fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        many = start()
        for batch in batches:
            for at in range(0, batch.num_rows, size):
                part = batch.slice(at, size)
                columns = many(list(texts(take(part))))
                arrays = [pa.array(c, f.type) for c, f in zip(columns, kinds, strict=True)]
                yield pa.RecordBatch.from_arrays([part.column(0), *arrays], out.names)

    return picked.mapInArrow(run, out)


def expand(
    df: DataFrame,
    columns: Sequence[Column],
    start: Callable[[], Callable[..., Sequence]],
    fields: str,
    rows: int = 100_000,
) -> DataFrame:
    """Any number of rows out for one row in.

    The row function gets the values of ``columns`` and gives one array for each of the
    ``fields``, all of one length. About ``rows`` rows go out at a time.
    """
    out = _parse_datatype_string(fields)
    kinds = to_arrow_schema(out)

    def pack(parts: list[Sequence]) -> pa.RecordBatch:
        arrays = [
            pa.concat_arrays([pa.array(p[i], f.type) for p in parts]) for i, f in enumerate(kinds)
        ]
        return pa.RecordBatch.from_arrays(arrays, out.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one, parts, held = start(), [], 0
        for batch in batches:
            for row in zip(*([x.as_py() for x in c] for c in batch.columns), strict=True):
                made = one(*row)
                if len(made[0]):
                    parts.append(made)
                    held += len(made[0])
                if held >= rows:
                    yield pack(parts)
                    parts, held = [], 0
        if parts:
            yield pack(parts)

    return df.select(*(c.alias(f"_{i}") for i, c in enumerate(columns))).mapInArrow(run, out)


class WordCodes(dict):
    """64-bit codes of words; forgets them when ``most`` words are held."""

    def __init__(self, code: Callable[[bytes], int], most: int = 300_000) -> None:
        super().__init__()
        self.code, self.most = code, most

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.most:
            self.clear()
        found = self[word] = self.code(word)
        return found

    def array(self, words: list[bytes]) -> np.ndarray:
        return np.array([self[w] for w in words], dtype=np.uint64)


def rolling(codes: np.ndarray, width: int, base: int) -> np.ndarray:
    """A 64-bit hash of each run of ``width`` codes."""
    size = len(codes) - width + 1
    if size <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(size, np.uint64)
    factor = 1
    for i in range(width):
        out += codes[i : i + size] * np.uint64(factor)
        factor = factor * base % (1 << 64)
    return out
