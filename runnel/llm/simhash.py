"""SimHash near-duplicates by pivot distance tables.

Each fingerprint gets a table of Hamming distances to fixed reference fingerprints. Two
fingerprints at a distance d differ by at most d in every such distance (triangle
inequality), so a pair with a larger coordinate difference is discarded without comparing
the fingerprints themselves.

For references that look at one block of bits only, equal blocks give equal coordinates.
With ``radius + 2`` blocks, two linked fingerprints agree in at least two whole blocks.
Fingerprints therefore meet under the coordinates of each pair of blocks; inside such a
group the dense references discard pairs, and the survivors are compared exactly.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from runnel.llm.text import checkpoint, lower_words, map_texts

BITS = 64
SHINGLE = 3
RADIUS = 2
SEED = 42
BLOCK_REFERENCES = 8
DENSE_REFERENCES = 16
#: Fingerprints compared with each other in one step; larger groups are cut into parts of it.
GROUP = 1024


def fingerprint(text: bytes | None, shingle: int = SHINGLE) -> int:
    """Signed 64-bit SimHash of the word shingles' XXH64 (seed 42); zero without words."""
    words = lower_words(text)
    if not words:
        return 0
    if len(words) < shingle:
        parts = [b" ".join(words)]
    else:
        parts = map(b" ".join, zip(*(words[i:] for i in range(shingle)), strict=False))
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(p, SEED) for p in parts], dtype="<u8")
    set_bits = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 1 << 14):
        bits = np.unpackbits(hashes[at : at + (1 << 14)].view(np.uint8).reshape(-1, 8), axis=1)
        set_bits += bits.sum(axis=0, dtype=np.int32)
    return int(np.packbits(2 * set_bits > len(hashes)).view("<i8")[0])


def fingerprints(
    docs: DataFrame,
    text_col: str = "text",
    shingle: int = SHINGLE,
    carry: Sequence[str] | None = None,
) -> DataFrame:
    """``row`` (the input row, or its columns ``carry``) and ``fp``, one for each row."""

    def start():
        return lambda text: (fingerprint(text, shingle),)

    return map_texts(docs, text_col, start, "fp long", carry)


def _blocks(radius: int) -> list[np.uint64]:
    """Masks of ``radius + 2`` blocks that share out the bits."""
    edges = [BITS * i // (radius + 2) for i in range(radius + 3)]
    return [np.uint64(((1 << b) - 1) ^ ((1 << a) - 1)) for a, b in zip(edges, edges[1:], strict=False)]


def _references(count: int, seed: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(0, 1 << 64, count, dtype=np.uint64)


def dense_coordinates(fps: np.ndarray) -> np.ndarray:
    """Distances to the dense references, a row for each fingerprint."""
    return np.bitwise_count(fps[:, None] ^ _references(DENSE_REFERENCES, 1)[None, :]).astype(np.int8)


def pair_keys(fps: np.ndarray, radius: int = RADIUS) -> np.ndarray:
    """One key for each pair of blocks: a hash of the blocks' coordinates."""
    blocks, keys = [], []
    for b, mask in enumerate(_blocks(radius)):
        refs = _references(BLOCK_REFERENCES, 2 + b)
        table = np.bitwise_count((fps[:, None] ^ refs[None, :]) & mask).astype(np.uint64)
        code = np.zeros(len(fps), np.uint64)
        for j in range(BLOCK_REFERENCES):
            code = code * np.uint64(BITS + 1) + table[:, j]
        blocks.append(code)
    for n, (a, b) in enumerate(combinations(range(len(blocks)), 2)):
        mixed = (blocks[a] * np.uint64(0x9E3779B97F4A7C15)) ^ (blocks[a] >> np.uint64(29))
        mixed = (mixed + blocks[b] + np.uint64(n)) * np.uint64(0xBF58476D1CE4E5B9)
        keys.append(mixed ^ (mixed >> np.uint64(31)))
    return np.stack(keys, axis=1)


def _key_rows(radius: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, fps = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            keys = pair_keys(fps.view(np.uint64), radius).view(np.int64)
            times = keys.shape[1]
            columns = keys.ravel(), np.repeat(fps, times), np.repeat(ids, times)
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["k", "fp", "id"])

    return run


class Forest:
    """Union-find over the members of one group."""

    def __init__(self, size: int) -> None:
        self.above = list(range(size))

    def root(self, i: int) -> int:
        while self.above[i] != i:
            self.above[i] = self.above[self.above[i]]
            i = self.above[i]
        return i

    def join(self, i: int, j: int) -> bool:
        a, b = self.root(i), self.root(j)
        self.above[max(a, b)] = min(a, b)
        return a != b


def links(fps: np.ndarray, radius: int = RADIUS) -> list[tuple[int, int]]:
    """A spanning forest of the pairs within the radius."""
    table, forest, out = dense_coordinates(fps), Forest(len(fps)), []
    for i in range(len(fps) - 1):
        near = np.abs(table[i + 1 :] - table[i]).max(axis=1) <= radius
        for j in np.flatnonzero(near) + i + 1:
            if (int(fps[i]) ^ int(fps[j])).bit_count() <= radius and forest.join(i, int(j)):
                out.append((i, int(j)))
    return out


def _link_groups(radius: int):
    """Reads rows sorted by group, holds one group at a time, gives node pairs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            keys = np.stack([batch.column(i).to_numpy() for i in range(3)], axis=1)
            fps = batch.column(3).to_numpy().view(np.uint64)
            ids = batch.column(4).to_numpy()
            if held is not None:
                keys, fps, ids = (np.concatenate(x) for x in zip(held, (keys, fps, ids), strict=True))
            edges = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
            bounds = [0, *edges.tolist()]
            yield from _pairs(fps, ids, bounds, radius)
            last = bounds[-1]
            held = keys[last:], fps[last:], ids[last:]
        if held is not None:
            yield from _pairs(held[1], held[2], [0, len(held[1])], radius)

    return run


def _pairs(fps, ids, bounds, radius) -> Iterator[pa.RecordBatch]:
    found: list[tuple[int, int]] = []
    for a, b in zip(bounds, bounds[1:], strict=False):
        if b - a > 1:
            part = ids[a:b]
            found += [(part[i], part[j]) for i, j in links(fps[a:b], radius)]
    if found:
        pairs = np.array(found, dtype=np.int64)
        low, high = pairs.min(axis=1), pairs.max(axis=1)
        yield pa.RecordBatch.from_arrays([pa.array(high), pa.array(low)], ["u", "v"])


def near_pairs(nodes: DataFrame, radius: int = RADIUS, group: int = GROUP) -> DataFrame:
    """Links ``u > v`` between the ids of ``nodes`` (``id, fp``, both distinct).

    In each group only a spanning forest of its links goes out. A key with more than
    ``group`` fingerprints is cut into parts, and each pair of parts is one group.
    """

    keyed = nodes.select("id", "fp").mapInArrow(_key_rows(radius), "k long, fp long, id long")
    counted = keyed.groupBy("k").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > group)
    joined = keyed.join(counted, "k", "left")
    parts = F.ceil(F.coalesce("n", F.lit(1)) * 2 / group).cast("int")
    own = F.pmod(F.xxhash64("fp"), parts).cast("int")
    cut = joined.select("k", "fp", "id", parts.alias("parts"), own.alias("own")).withColumn(
        "other",
        F.explode(
            F.when(F.col("parts") <= 2, F.array(F.lit(0))).otherwise(
                F.sequence(F.lit(0), F.col("parts") - 1)
            )
        ),
    )
    small = F.col("parts") <= 2
    dealt = cut.select(
        "k",
        F.when(small, 0).otherwise(F.least("own", "other")).alias("a"),
        F.when(small, 0).otherwise(F.greatest("own", "other")).alias("b"),
        "fp",
        "id",
    )
    placed = dealt.repartition("k", "a", "b").sortWithinPartitions("k", "a", "b")
    return placed.mapInArrow(_link_groups(radius), "u long, v long")


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for all nodes of the edges ``u > v``: the smallest node reachable.

    Alternates two steps until nothing changes: every node hands its larger neighbours to
    its smallest one, then its smaller ones. Each step is a grouped minimum and a join.
    """
    edges = checkpoint(edges.distinct())
    before = None
    while True:
        both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        least = least.select("u", F.least("m", "u").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = checkpoint(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct())
        now = edges.agg(F.count(F.lit(1)), F.sum(F.hash("u", "v").cast("long"))).first()
        if now == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = now


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = SHINGLE,
    radius: int = RADIUS,
) -> DataFrame:
    """``doc_id, fp, component_id``, one row for each row of ``docs``.

    ``component_id`` is the smallest id reachable over fingerprints at most ``radius`` bits
    apart. Null, empty and blank texts have fingerprint zero, which is linked like any
    other. Equal fingerprints are grouped first, so copies never meet in pairs. A row with
    a null id gets the component of its fingerprint; it is null if no row with an id
    reaches it. Repeated rows stay; an empty table gives no rows.
    """
    marked = fingerprints(docs, text_col, shingle, [id_col])
    marked = checkpoint(marked.select(F.col(f"row.{id_col}").cast("long").alias("doc_id"), "fp"))
    nodes = marked.groupBy("fp").agg(F.min("doc_id").alias("id"))
    known = nodes.where("id IS NOT NULL")
    roots = components(near_pairs(known, radius))
    named = known.join(roots, known["id"] == roots["node"], "left").select(
        "fp", F.coalesce("root", "id").alias("component_id")
    )
    linked = nodes.where("id IS NULL").select("fp")
    if not linked.isEmpty():
        named = named.unionByName(_adopted(linked, known, named, radius))
    return marked.join(named, "fp", "left").select("doc_id", "fp", "component_id")


def _adopted(orphans: DataFrame, known: DataFrame, named: DataFrame, radius: int) -> DataFrame:
    """Components of fingerprints that only rows without an id have."""
    numbered = orphans.select(
        "fp", (-F.lit(1) - F.monotonically_increasing_id()).alias("id")
    )
    numbered = checkpoint(numbered)
    roots = components(near_pairs(known.select("fp", "id").unionByName(numbered), radius))
    # Negative ids win the minimum, so a component goes by its smallest orphan here.
    own = known.join(named, "fp").join(roots, known["id"] == roots["node"])
    best = own.groupBy("root").agg(F.min("component_id").alias("component_id"))
    at = numbered.join(roots, numbered["id"] == roots["node"], "left")
    at = at.select("fp", F.coalesce("root", "id").alias("root"))
    return at.join(best, "root", "left").select("fp", "component_id")


def hex_fingerprint() -> Column:
    """``fp`` as 16 lowercase hex digits."""
    return F.lower(F.lpad(F.hex("fp"), 16, "0"))


def keep_one(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = SHINGLE,
    radius: int = RADIUS,
) -> DataFrame:
    """The rows of ``docs`` that stand for their group of near-duplicates.

    That is the row with the smallest id; of rows that share it, the one with the smallest
    fingerprint. A row without an id stands only for a group that has no id, each
    fingerprint for itself. All columns are kept as they are.
    """
    found = near_duplicates(docs, id_col, text_col, shingle, radius)
    heads = (
        found.where("doc_id = component_id")
        .groupBy("doc_id")
        .agg(F.min(F.struct("fp")).alias("least"), F.count(F.lit(1)).alias("rows"))
        .select("doc_id", "least.fp", "rows")
    )
    lone = (
        found.where("doc_id IS NULL AND component_id IS NULL")
        .groupBy("doc_id", "fp")
        .agg(F.count(F.lit(1)).alias("rows"))
    )
    heads = checkpoint(heads.unionByName(lone))
    marked = fingerprints(docs, text_col, shingle)
    wanted = heads.select(F.col("doc_id").alias("_id"), F.col("fp").alias("_fp"))
    same = F.col(f"row.{id_col}").cast("long").eqNullSafe(F.col("_id"))
    kept = marked.join(wanted, same & (F.col("fp") == F.col("_fp")), "left_semi")
    if not heads.where("rows > 1").isEmpty():
        by = [F.col(f"row.{id_col}").alias("_id"), "fp"]
        kept = kept.groupBy(*by).agg(F.first("row").alias("row"))
    return kept.select(*[F.col("row")[c].alias(c) for c in docs.columns])
