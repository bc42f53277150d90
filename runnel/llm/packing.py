"""Best-fit packing of documents into sequences of bounded size.

A piece is a vector: tokens, one document, and attention cost (tokens squared). All three
follow from its length, so pieces of equal length are alike, and the plan needs only the
number of pieces of each length. Vector best-fit takes lengths in falling order and puts
them into open sequences that have room in every dimension, chosen by the residual norm or
the weighted dot product. The plan is a table of a few thousand rows; the pieces find their
places in it by joins, on their length and their number among the pieces of that length.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from collections.abc import Sequence
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from runnel.llm.text import as_binary, checkpoint

CAPACITY = 2048
TOKENIZER = "word_bpe_49k.json"
SEPARATOR = 0
#: Words remembered by a Python worker, about 130 MB.
WORDS_KEPT = 500_000
PIECES = (
    "doc_id long, piece int, start long, length long, ids_crc32 long, part long, local long"
)
PLACES = "length long, first long, last long, lowest long, each long, used long"


# How the tokenizer file prepares a text and cuts it, and how its words end.
NORMALIZERS = ["NFC", "Replace", "Lowercase"]
CUTS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
WORD_END = "</w>"
#: The same cuts in lower-case ASCII words that are parted by the sign \x01.
ASCII_CUTS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^\s\x01a-z0-9]+")
ODD = re.compile(r"[\x00\x01\s]|<\|")


def byte_alphabet() -> dict[str, int]:
    """The byte that each letter of a byte-level vocabulary stands for: printable bytes for
    themselves, the others for the letters from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(others)}


def ascii_coder(path: str) -> tiktoken.Encoding | None:
    """A faster coder of ASCII words with the merges of the tokenizer file; None if the file
    is of another kind.

    The end of a word is the byte 0 behind it. In this vocabulary a token's id is the rank of
    its merge, those with a single byte and a word's end coming first.
    """
    with open(path) as file:
        made = json.load(file)
    parts = [n["type"] for n in (made["normalizer"] or {}).get("normalizers", [])]
    cuts = [p.get("pattern") for p in (made["pre_tokenizer"] or {}).get("pretokenizers", [])]
    if parts != NORMALIZERS or cuts[:1] != [{"Regex": CUTS}]:
        return None
    if made["model"].get("end_of_word_suffix") != WORD_END:
        return None
    special = {t["content"] for t in made["added_tokens"]}
    alphabet, ranks = byte_alphabet(), {}
    for token, number in made["model"]["vocab"].items():
        if token not in special:
            whole = token.removesuffix(WORD_END)
            end = b"\0" if whole != token else b""
            ranks[bytes(map(alphabet.__getitem__, whole)) + end] = number
    return tiktoken.Encoding(
        "words", pat_str=r"\x01|[^\x00\x01]+\x00", mergeable_ranks=ranks, special_tokens={}
    )


class Tokens:
    """Token ids of whole texts as bytes (little-endian, 32 bit).

    White space always ends a token and is dropped, so the ids of a text are those of its
    runs without spaces and line ends. Each run is encoded once while it is remembered.
    Strings of special tokens hold no white space, so they get their ids as in the whole
    text. Runs of plain ASCII take the faster coder, if the file is of its kind.
    """

    def __init__(self, path: str, most: int = WORDS_KEPT) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.encoder = Tokenizer.from_file(path)
        self.fast = ascii_coder(path)
        self.known: dict[str, bytes] = {}
        self.most = most

    def learn_ascii(self, words: list[str]) -> None:
        """Encodes many runs at once; the sign \\x01 between them is a token of its own."""
        cut = ASCII_CUTS.sub("\\g<0>\0", "\1".join(words).lower())
        ids = np.array(self.fast.encode_to_numpy(cut), dtype="<u4")
        ends = np.flatnonzero(ids == self.fast.encode_single_token(b"\1")) * 4
        data = ids.tobytes()
        starts = [0, *(ends + 4).tolist()]
        for word, start, stop in zip(words, starts, [*ends.tolist(), len(data)], strict=True):
            self.known[word] = data[start:stop]

    def learn(self, words: list[str]) -> None:
        made = self.encoder.encode_batch_fast(words, add_special_tokens=False)
        for word, code in zip(words, made, strict=True):
            self.known[word] = np.array(code.ids, dtype="<u4").tobytes()

    def of(self, texts: list[str]) -> list[bytes]:
        split = [t.replace("\n", " ").split(" ") for t in texts]
        if len(self.known) > self.most:
            self.known = {}
        new = [w for w in {w for words in split for w in words} if w not in self.known]
        plain = [w for w in new if w.isascii() and not ODD.search(w)] if self.fast else []
        quick = set(plain)
        rest = [w for w in new if w not in quick]
        for some, learn in ((plain, self.learn_ascii), (rest, self.learn)):
            for at in range(0, len(some), 5000):
                learn(some[at : at + 5000])
        get = self.known.__getitem__
        return [b"".join(map(get, words)) for words in split]


@cache
def tokens_of(path: str) -> Tokens:
    """One for each Python worker, so that later tasks find the words of earlier ones."""
    return Tokens(path)


def token_pieces(
    docs: DataFrame,
    tokenizer: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = CAPACITY,
) -> DataFrame:
    """Pieces of at most ``capacity`` tokens, each numbered among the equally long ones of
    its task (``part, local``), so that no sort is needed to number them all."""

    def run(batches):
        coder = tokens_of(tokenizer)
        part, seen = TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
        stop = np.array([SEPARATOR], dtype="<u4").tobytes()
        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                some = batch.slice(at, 200)
                texts = [(t or b"").decode() for t in some.column(1).to_pylist()]
                rows = []
                for doc, ids in zip(some.column(0).to_pylist(), coder.of(texts), strict=True):
                    ids += stop
                    size = len(ids) // 4
                    for piece, start in enumerate(range(0, size, capacity)):
                        length = min(capacity, size - start)
                        crc = zlib.crc32(ids[4 * start : 4 * (start + length)])
                        rows.append((doc, piece, start, length, crc, part, int(seen[length])))
                        seen[length] += 1
                columns = list(zip(*rows, strict=True))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, types, strict=True)], names
                )

    names = [c.split()[0] for c in PIECES.split(", ")]
    types = [pa.int32() if n == "piece" else pa.int64() for n in names]
    picked = docs.select(F.col(id_col).cast("long"), as_binary(text_col))
    return picked.mapInArrow(run, PIECES)


@dataclass
class Bins:
    """Open sequences ``lowest .. highest - 1`` that all hold the same lengths."""

    lowest: int
    highest: int
    tokens: int
    docs: int
    attention: int


@dataclass(frozen=True)
class Limits:
    """Capacities of a sequence. The defaults for documents and attention cost are the
    largest values that the tokens allow, so only tokens bind unless they are lowered."""

    tokens: int = CAPACITY
    docs: int | None = None
    attention: int | None = None

    @property
    def vector(self) -> tuple[int, int, int]:
        return (
            self.tokens,
            self.tokens if self.docs is None else self.docs,
            self.tokens**2 if self.attention is None else self.attention,
        )


def plan(
    counts: dict[int, int],
    limits: Limits = Limits(),
    rule: str = "norm",
    weights: Sequence[float] = (1.0, 0.0, 0.0),
) -> tuple[list[tuple[int, int, int, int, int, int]], int]:
    """Places for ``counts`` pieces of each length, and the number of sequences.

    A place ``(length, first, last, lowest, each, used)`` takes the pieces ``first`` to
    ``last - 1`` of a length; ``each`` of them go into one sequence, from ``lowest`` on,
    behind ``used`` tokens. ``rule`` is ``norm`` (least weighted norm of what is left) or
    ``dot`` (largest weighted product of the piece and what is left).
    """
    caps = np.array(limits.vector, dtype=float)
    if min(caps) < 1 or any(n**2 > caps[2] or n > caps[0] for n in counts):
        raise ValueError("a piece is larger than a sequence")
    scale = np.asarray(weights, dtype=float)
    places, bins, made = [], [], 0
    for length in sorted((n for n, c in counts.items() if c), reverse=True):
        item = np.array([length, 1, length**2], dtype=float)
        rank, count = 0, counts[length]

        def put(target: Bins, each: int, number: int, length=length) -> Bins:
            nonlocal rank
            size = target.highest - target.lowest
            left = Bins(
                target.lowest, target.highest, target.tokens - each * length,
                target.docs - each, target.attention - each * length**2,
            )
            assert number == size * each
            used = limits.tokens - target.tokens
            places.append((length, rank, rank + number, target.lowest, each, used))
            rank += number
            return left

        def fill(target: Bins, each: int) -> list[Bins]:
            """Puts up to ``each`` pieces into every sequence; splits off what differs."""
            size, todo = target.highest - target.lowest, count - rank
            whole, rest = min(size, todo // each), 0
            out, edge = [], target.lowest + whole
            values = target.tokens, target.docs, target.attention
            if whole:
                out.append(put(Bins(target.lowest, edge, *values), each, whole * each))
            if whole < size and (rest := count - rank):
                out.append(put(Bins(edge, edge + 1, *values), rest, rest))
                edge += 1
            if edge < target.highest:
                out.append(Bins(edge, target.highest, *values))
            return out

        def room(b: Bins, length=length) -> int:
            return min(b.tokens // length, b.docs, b.attention // length**2)

        while rank < count:
            fits = [b for b in bins if room(b)]
            if not fits:
                each = room(Bins(0, 0, *map(int, caps)))
                if rule == "dot":
                    each = 1
                number = -(-(count - rank) // each)
                opened = Bins(made, made + number, *map(int, caps))
                made += number
                bins += fill(opened, each)
                continue
            state = np.array([(b.tokens, b.docs, b.attention) for b in fits], dtype=float)
            if rule == "norm":
                left = ((state - item) / caps) ** 2 @ scale
                best = fits[int(left.argmin())]
                each = room(best)
            else:
                best = fits[int(((state / caps) * (item / caps) @ scale).argmax())]
                each = 1
            bins.remove(best)
            bins += fill(best, each)
        bins = [b for b in bins if b.tokens and b.docs and b.attention]
    return places, made


def pack(
    pieces: DataFrame,
    limits: Limits = Limits(),
    rules: Sequence[tuple[str, tuple[float, float, float]]] = (
        ("norm", (1.0, 0.25, 0.25)),
        ("dot", (1.0, 0.25, 0.25)),
    ),
) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to pieces that have ``length, part, local``.

    The driver sees one count for each length (at most as many as tokens in a sequence) and
    makes the plan by each of ``rules`` until one needs no more sequences than the tokens
    do; the one with the fewest counts. Pieces of a length are numbered over all tasks by adding up the tasks' counts.
    """
    spark = pieces.sparkSession
    pieces = checkpoint(pieces)
    counted = checkpoint(pieces.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n")))
    totals = counted.groupBy("length").agg(F.sum("n").alias("n")).collect()
    counts = {r["length"]: r["n"] for r in totals}
    places, least = plan(counts, limits, *rules[0])
    for rule in rules[1:]:
        if least > -(-sum(n * c for n, c in counts.items()) // limits.tokens):
            other = plan(counts, limits, *rule)
            places, least = min((places, least), other, key=lambda made: made[1])
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    begin = counted.select(
        "part", "length", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("begin")
    )
    ranked = pieces.join(begin, ["part", "length"]).withColumn("rank", F.expr("begin + local"))
    table = F.broadcast(spark.createDataFrame(places, PLACES))
    found = ranked.join(
        table,
        (ranked["length"] == table["length"]) & F.col("rank").between(F.col("first"), F.col("last") - 1),
    ).drop(table["length"])
    at = F.col("rank") - F.col("first")
    return found.select(
        *[c for c in pieces.columns if c not in ("part", "local")],
        (F.col("lowest") + F.floor(at / F.col("each"))).cast("long").alias("sequence_id"),
        (F.col("used") + F.pmod(at, "each") * F.col("length")).cast("long").alias("offset"),
    )


def pack_documents(
    docs: DataFrame,
    tokenizer: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    limits: Limits = Limits(),
) -> DataFrame:
    """Documents as pieces with their sequence and place.

    A null or empty text is a document of the separator alone. A null id is carried along,
    repeated rows are packed each by itself, an empty table gives no rows.
    """
    pieces = token_pieces(docs, tokenizer, id_col, text_col, limits.tokens)
    return pack(pieces, limits)
