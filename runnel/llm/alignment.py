"""Cross-tokenizer alignment by interval coalescing.

Two tokenizers cut the same bytes into two rows of intervals. All tokens of a batch of texts
are sorted by their start; the running maximum of the ends says where nothing reaches over a
border, so a group breaks where a start reaches that maximum. Within the groups, overlapping
tokens are expanded into pairs; the pairs that end together are links. Links are counted
over the corpus by Spark, and each document is held against the counts.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Sequence
from functools import cache

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from runnel.llm.text import as_binary, checkpoint, join_spread

#: Texts are encoded and aligned together up to so many bytes; a longer one by itself.
BATCH_BYTES = 1 << 20
#: A pair table of at most so many rows is broadcast (16 bytes a row); else it is joined by
#: a shuffle.
BROADCAST_PAIRS = 1_000_000
#: A link as one number: A's id times this plus B's id.
PAIR = 1 << 32
FIELDS = (
    "n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
    "pairs array<long>, times array<int>"
)
NAMES = [f.split()[0] for f in FIELDS.split(", ")]


def read_ranks(path: str) -> dict[bytes, int]:
    """A vocabulary file of lines with base64 bytes and a rank."""
    with open(path, "rb") as lines:
        return {base64.b64decode(word): int(rank) for word, rank in map(bytes.split, lines)}


class Vocabulary:
    """Bytes and their number for each id. Ids without bytes have an empty entry."""

    def __init__(self, entries: list[bytes]) -> None:
        self.entries = entries
        self.sizes = np.array([len(e) for e in entries], np.int64)

    def whole(self, ids: list[int]) -> bytes:
        return b"".join(map(self.entries.__getitem__, ids))


class ByteTokens(Vocabulary):
    """Byte-level pairs by rank; strings of special tokens are plain text."""

    def __init__(self, path: str, pattern: str) -> None:
        ranks = read_ranks(path)
        self.encoder = tiktoken.Encoding(
            "bytes", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}
        )
        entries = [b""] * (max(ranks.values()) + 1)
        for word, rank in ranks.items():
            entries[rank] = word
        super().__init__(entries)

    def encode(self, texts: list[str]) -> list[list[int]]:
        return [self.encoder.encode_ordinary(t) for t in texts]


class PieceTokens(Vocabulary):
    """Pieces with byte fallback. The model puts a space before a text by itself."""

    def __init__(self, path: str) -> None:
        self.encoder = sentencepiece.SentencePieceProcessor(model_file=path)
        entries = []
        for i in range(self.encoder.vocab_size()):
            piece = self.encoder.id_to_piece(i)
            # Fixed forms: a byte piece is <0xHH>, U+2581 stands for a space.
            is_byte = self.encoder.is_byte(i)
            entries.append(
                bytes([int(piece[3:5], 16)]) if is_byte else piece.replace("▁", " ").encode()
            )
        super().__init__(entries)

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.encoder.encode(texts, num_threads=1)


@cache
def tokenizers_of(byte_path: str, pattern: str, piece_path: str):
    """One pair of tokenizers for each Python worker."""
    return ByteTokens(byte_path, pattern), PieceTokens(piece_path)


def coalesce(
    a_ends: np.ndarray, b_ends: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Groups and overlaps of two rows of adjoining intervals that begin at 0.

    Gives the order of all intervals (A's, then B's) by group, kind and place, the group of
    each of them in that order, and the index pairs of A and B that overlap.
    """
    n_a = len(a_ends)
    ends = np.concatenate([a_ends, b_ends])
    starts = np.concatenate([[0], a_ends[:-1], [0], b_ends[:-1]]) if len(ends) else ends
    order = np.lexsort((ends, starts))
    reach = np.maximum.accumulate(ends[order])
    breaks = np.ones(len(order), bool)
    breaks[1:] = starts[order][1:] >= reach[:-1]
    group = np.cumsum(breaks) - 1
    kinds = order >= n_a
    tidy = np.lexsort((order, kinds, group))
    order, group = order[tidy], group[tidy]
    # The tokens of B that begin before an A token ends, and end behind its start.
    first = np.searchsorted(b_ends, starts[:n_a], side="right")
    last = np.searchsorted(starts[n_a:], a_ends, side="left")
    many = np.maximum(last - first, 0)
    left = np.repeat(np.arange(n_a), many)
    begin = np.cumsum(many) - many
    right = np.arange(many.sum()) - np.repeat(begin, many) + np.repeat(first, many)
    return order, group, left, right


class Aligner:
    """Aligns lists of texts."""

    def __init__(self, a: Vocabulary, b: Vocabulary) -> None:
        self.a, self.b = a, b
        self.base = len(a.entries)
        names = [str(i) for i in range(len(a.entries))] + [str(i) for i in range(len(b.entries))]
        # An id with the sign behind it: the next of its kind, the other kind, a new group.
        self.signed = [n + sign for sign in ",|;" for n in names]

    def align(self, texts: Sequence[str | None]) -> list[list]:
        """Columns of :data:`FIELDS`, with one value for each text."""
        rows: list[list] = [[0] * len(texts) for _ in range(4)]
        rows += [[""] * len(texts), [[] for _ in texts], [[] for _ in texts]]
        some = [i for i, t in enumerate(texts) if t]
        spaced = [" " + texts[i] for i in some]
        a_ids = self.a.encode(spaced)
        b_ids = self.b.encode([texts[i] for i in some])
        whole = [t.encode() for t in spaced]
        fits = [
            j for j, data in enumerate(whole)
            if self.a.whole(a_ids[j]) == data == self.b.whole(b_ids[j])
        ]
        if not fits:
            return rows
        a_flat = np.concatenate([np.array(a_ids[j], np.int64) for j in fits])
        b_flat = np.concatenate([np.array(b_ids[j], np.int64) for j in fits])
        a_ends, b_ends = np.cumsum(self.a.sizes[a_flat]), np.cumsum(self.b.sizes[b_flat])
        order, group, left, right = coalesce(a_ends, b_ends)
        tied = a_ends[left] == b_ends[right]
        left, right = left[tied], right[tied]
        pairs = a_flat[left] * PAIR + b_flat[right]
        n_a = np.array([len(a_ids[j]) for j in fits])
        n_b = np.array([len(b_ids[j]) for j in fits])
        # Texts adjoin each other, so a group never reaches over the end of one.
        stops = np.cumsum(n_a + n_b)
        links = np.searchsorted(left, np.cumsum(n_a))
        codes = self._signed(order, group, a_flat, b_flat)
        at = linked = 0
        for j, stop, end in zip(fits, stops.tolist(), links.tolist(), strict=True):
            i = some[j]
            text = "".join(map(self.signed.__getitem__, codes[at:stop].tolist()))[:-1]
            found, times = np.unique(pairs[linked:end], return_counts=True)
            values = (
                len(a_ids[j]), len(b_ids[j]), int(group[stop - 1] - group[at]) + 1, end - linked,
                hashlib.sha256(text.encode()).hexdigest(), found, times.astype(np.int32),
            )
            for column, value in zip(rows, values, strict=True):
                column[i] = value
            at, linked = stop, end
        return rows

    def _signed(self, order, group, a_flat, b_flat) -> np.ndarray:
        kinds = order >= len(a_flat)
        ids = np.concatenate([a_flat, b_flat + self.base])[order]
        sign = np.zeros(len(order), np.int64)
        sign[:-1][kinds[1:] & ~kinds[:-1]] = 1
        sign[:-1][group[1:] != group[:-1]] = 2
        sign[-1:] = 2
        return ids + sign * (self.base + len(self.b.entries))


def _parts(sizes: list[int]) -> list[tuple[int, int]]:
    """Runs of texts of together at most :data:`BATCH_BYTES`, or of one text."""
    parts, start, held = [], 0, 0
    for i, size in enumerate(sizes):
        if i > start and held + size > BATCH_BYTES:
            parts.append((start, i))
            start, held = i, 0
        held += size
    return [*parts, (start, len(sizes))] if sizes else parts


def align_texts(
    docs: DataFrame,
    byte_path: str,
    pattern: str,
    piece_path: str,
    text_col: str = "text",
    carry: Sequence[str] | None = None,
) -> DataFrame:
    """``row`` (the input row, or its columns ``carry``) and :data:`FIELDS`, row by row.

    ``pairs`` are the document's different links, as A's id times 2^32 plus B's id, and
    ``times`` says how often each occurs. Null and empty texts, and those whose tokens do
    not give back their bytes, have no tokens: zeros, no pairs and an empty digest. A very
    long text is aligned by itself, as a whole.
    """
    names = list(docs.columns if carry is None else carry)
    row = F.struct(*[docs[f"`{c}`"] for c in names]).alias("row")
    picked = docs.select(row, as_binary(f"`{text_col}`").alias("text"))
    schema = f"row {picked.schema['row'].dataType.simpleString()}, {FIELDS}"
    kinds = [pa.int64()] * 4 + [pa.string(), pa.list_(pa.int64()), pa.list_(pa.int32())]

    def run(batches):
        aligner = Aligner(*tokenizers_of(byte_path, pattern, piece_path))
        for batch in batches:
            texts = [None if t is None else t.decode() for t in batch.column(1).to_pylist()]
            for start, stop in _parts([len(t or "") for t in texts]):
                columns = aligner.align(texts[start:stop])
                arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
                held = batch.column(0).slice(start, stop - start)
                yield pa.RecordBatch.from_arrays([held, *arrays], ["row", *NAMES])

    return picked.mapInArrow(run, schema)


def count_links(aligned: DataFrame) -> DataFrame:
    """``pair, n, best``: how many links of all documents join the two ids, and whether no
    other A id has more with this B id (ties included)."""
    each = aligned.select(F.explode(F.arrays_zip("pairs", "times")).alias("_l"))
    counted = each.groupBy(F.col("_l.pairs").alias("pair")).agg(F.sum("_l.times").alias("n"))
    counted = checkpoint(counted)
    b_id = F.pmod("pair", F.lit(PAIR))
    most = counted.groupBy(b_id.alias("_b")).agg(F.max("n").alias("_most"))
    joined = counted.join(most, b_id == F.col("_b"))
    return joined.select("pair", "n", (F.col("n") == F.col("_most")).alias("best"))


def held_against_corpus(
    aligned: DataFrame, broadcast_pairs: int = BROADCAST_PAIRS
) -> DataFrame:
    """The aligned rows with ``n_best`` and ``count_sum`` instead of their pairs.

    ``aligned`` should be a checkpoint: it is read three times, and its rows are numbered.
    The table of pairs is broadcast if it was counted to be small; else it is joined by a
    shuffle in which very frequent pairs are spread.
    """
    numbered = aligned.withColumn("_row", F.monotonically_increasing_id())
    counts = checkpoint(count_links(aligned))
    links = numbered.select("_row", F.explode(F.arrays_zip("pairs", "times")).alias("_l")).select(
        "_row", F.col("_l.pairs").alias("pair"), F.col("_l.times").alias("_times")
    )
    if counts.count() <= broadcast_pairs:
        met = links.join(F.broadcast(counts), "pair")
    else:
        met = join_spread(links, counts.withColumn("_n", F.col("n")), ["pair"], ["_row"])
        met = met.withColumnRenamed("_n", "n")
    sums = met.groupBy("_row").agg(
        F.sum(F.when(F.col("best"), F.col("_times")).otherwise(0)).alias("n_best"),
        F.sum(F.col("n") * F.col("_times")).alias("count_sum"),
    )
    rows = numbered.drop("pairs", "times").join(sums, "_row", "left").drop("_row")
    return rows.na.fill(0, ["n_best", "count_sum"])


def align_corpus(
    docs: DataFrame,
    byte_path: str,
    pattern: str,
    piece_path: str,
    text_col: str = "text",
    carry: Sequence[str] | None = None,
) -> DataFrame:
    """``row``, counts and digest of each document, and its links against all documents.

    Ties: of equally frequent A partners of a B id all are best. Repeated rows count each
    time. Null ids are carried along; an empty table gives no rows; extra columns stay
    inside ``row``, so their names cannot clash.
    """
    aligned = align_texts(docs, byte_path, pattern, piece_path, text_col, carry)
    return held_against_corpus(checkpoint(aligned))


def columns() -> list[Column]:
    names = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    return [F.col(n) for n in names]
