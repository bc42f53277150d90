"""Quality classifier from weak labels.

Several heuristics look at a document's counts and vote good, bad, or not at all. None of
them is right all the time, and no true label is used: expectation-maximisation estimates
how often each heuristic is right on good and on bad documents from how they agree, over the
votes of all documents. The posterior of each pattern of votes is then the soft label from
which a hashed linear scorer learns, so that documents on which the heuristics are silent
get a score by their words' shapes.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from runnel.llm.rules import SYMBOLS, repeated_codes
from runnel.llm.text import checkpoint, map_texts, spaced_words

SLOTS = 1 << 12
#: Documents on which the scorer is trained.
SAMPLE_DOCS = 4_000
STEPS = 150
KEEP = 0.5
BAD, GOOD, SILENT = 0, 1, 2
WORDS_KEPT = 300_000
#: Letters by case, digits, other signs as they are.
SHAPE = bytes(
    ord("a") if 97 <= b <= 122 or b >= 128 else
    ord("A") if 65 <= b <= 90 else
    ord("0") if 48 <= b <= 57 else b
    for b in range(256)
)
#: Frequent short words of four languages, fixed values.
COMMON = frozenset(
    "a an and are as at be by for from in is it of on or that the this to was with "
    "auf das dem den der des die ein eine im ist mit nicht sich sie und von zu "
    "au dans de des du elle en est et la le les par pas pour que qui sur un une "
    "al como con de del el en es la las los no para por que se su un una y".encode().split()
)
HEURISTICS = (
    "length", "symbols", "tails", "capitals", "no_letters", "repeats", "lines", "word_size",
    "common_words", "sentence_ends", "variety",
)


class Words(dict):
    """Numbers of words, and what is to be known of each word."""

    def __init__(self) -> None:
        super().__init__()
        self.rows: list[tuple[int, ...]] = []
        self.table, self.filled = np.zeros((0, 8), np.int32), 0

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self.rows)
        shape = word.translate(SHAPE)
        last = shape[-1:]
        self.rows.append(
            (
                b"A" in shape and b"a" not in shape,
                b"a" not in shape and b"A" not in shape,
                last in b".!?",
                word in COMMON,
                last not in b"aA0.,!?",
                len(word) - len(word.translate(None, SYMBOLS)),
                zlib.crc32(shape[:1] + shape[-2:] + b"%d" % min(len(word), 12)) % SLOTS,
                zlib.crc32(b"end " + word[-2:].lower()) % SLOTS,
            )
        )
        return number

    def about(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The words' numbers, and a row for each word."""
        if len(self) > WORDS_KEPT:
            self.clear()
            self.rows, self.filled = [], 0
        codes = np.array([self[w] for w in words])
        total = len(self.rows)
        if total > self.filled:
            if total > len(self.table):
                larger = np.zeros((2 * total, 8), np.int32)
                larger[: self.filled] = self.table[: self.filled]
                self.table = larger
            self.table[self.filled : total] = self.rows[self.filled :]
            self.filled = total
        return codes, self.table[codes]


@cache
def known_words() -> Words:
    """One for each Python worker, so that later tasks find the words of earlier ones."""
    return Words()


def _vote(value: float, good: float, bad: float) -> int:
    """Good up to one limit, bad from another on, silent between."""
    return GOOD if value <= good else BAD if value >= bad else SILENT


def look(text: bytes | None, known: Words) -> tuple[list[int], np.ndarray, np.ndarray]:
    """The heuristics' votes on a whole text, its hashed features and their values."""
    words = spaced_words(text)
    n = len(words)
    if not n:
        return [BAD] + [SILENT] * (len(HEURISTICS) - 1), np.array([0]), np.array([1.0])
    codes, about = known.about(words)
    upper, bare, ends, common, tails, symbols = about[:, :6].sum(axis=0) / n
    lines = [line for line in text.split(b"\n") if line.strip()]
    different = len(np.unique(codes)) / n
    long = n >= 30
    votes = [
        BAD if n < 3 else GOOD if n >= 40 else SILENT,
        _vote(symbols, 0.05, 0.3),
        _vote(tails, 0.1, 0.3),
        _vote(upper, 0.1, 0.4),
        _vote(bare, 0.08, 0.2),
        _vote(repeated_codes(codes) / n, 0.05, 0.2),
        _vote(1 - len(set(lines)) / len(lines), 0.1, 0.3),
        _vote(abs(sum(map(len, words)) / n - 6), 2.5, 5),
        _vote(-common, -0.1, -0.04) if long else SILENT,
        _vote(ends, 0.3, 0.5) if long else SILENT,
        _vote(1 - different, 0.75, 0.9) if n >= 100 else SILENT,
    ]
    slots, times = np.unique(about[:, 6:8], return_counts=True)
    extra = [
        zlib.crc32(b"size %d" % n.bit_length()) % SLOTS,
        zlib.crc32(b"variety %d" % int(10 * different)) % SLOTS,
    ]
    return votes, np.append(slots, extra), np.append(np.sqrt(times / n), [1.0, 1.0])


@dataclass
class Votes:
    """What EM has found: the share of good documents and, by heuristic, the probabilities
    of its votes (bad, good) on bad (row 0) and good (row 1) documents."""

    share: float
    table: np.ndarray

    def evidence(self, patterns: np.ndarray) -> np.ndarray:
        """Log-probability of votes and class, for both classes; silence says nothing."""
        silent = np.zeros((len(self.table), 2, 1))
        logs = np.concatenate([np.log(self.table), silent], axis=2)
        sums = [logs[np.arange(len(logs)), c, patterns].sum(axis=1) for c in (BAD, GOOD)]
        return np.stack(sums, axis=1) + np.log([1 - self.share, self.share])

    def posterior(self, patterns: np.ndarray) -> np.ndarray:
        """Probability that a document with these votes is good."""
        both = self.evidence(patterns)
        return 1 / (1 + np.exp(np.clip(both[:, BAD] - both[:, GOOD], -50, 50)))


def expectation_maximisation(patterns: np.ndarray, counts: np.ndarray, rounds: int = 200) -> Votes:
    """Dawid and Skene's model for two classes over patterns of votes with their counts.

    Starts where a bad vote is hardly ever cast on a good document, while a bad document
    trips only some of the heuristics. That also names the classes.
    """
    each = patterns.shape[1]
    start = np.array([[0.3, 0.7], [0.01, 0.99]])
    votes = Votes(0.8, np.broadcast_to(start, (each, 2, 2)).copy())
    last = -np.inf
    for _ in range(rounds):
        good = votes.posterior(patterns)
        sums = np.zeros((each, 2, 3))
        for h in range(each):
            for c, weight in ((BAD, 1 - good), (GOOD, good)):
                sums[h, c] = np.bincount(patterns[:, h], weight * counts, 3)
        seen = sums[:, :, :2] + start
        share = float(((good * counts).sum() + 1) / (counts.sum() + 2))
        votes = Votes(share, seen / seen.sum(axis=2, keepdims=True))
        fit = float((np.logaddexp.reduce(votes.evidence(patterns), axis=1) * counts).sum())
        if fit - last < 1e-7 * abs(fit):
            break
        last = fit
    return votes


@dataclass
class Scorer:
    weight: np.ndarray
    bias: float

    def score(self, slots: np.ndarray, values: np.ndarray) -> float:
        z = float(self.weight[slots] @ values) + self.bias
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def train(rows: Sequence[tuple[np.ndarray, np.ndarray]], labels: np.ndarray) -> Scorer:
    """Logistic regression on soft labels, by Adam over the whole sample."""
    if not len(rows):
        return Scorer(np.zeros(SLOTS), 0.0)
    x = np.zeros((len(rows), SLOTS), np.float32)
    for i, (slots, values) in enumerate(rows):
        np.add.at(x[i], slots, values)
    weight, bias = np.zeros(SLOTS, np.float32), 0.0
    first = np.zeros(SLOTS + 1)
    second = np.zeros(SLOTS + 1)
    for step in range(1, STEPS + 1):
        p = 1 / (1 + np.exp(-np.clip(x @ weight + bias, -30, 30)))
        off = ((p - labels) / len(rows)).astype(np.float32)
        slope = np.append(x.T @ off + 1e-4 * weight, off.sum())
        first += 0.1 * (slope - first)
        second += 0.01 * (slope**2 - second)
        move = 0.1 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
        weight -= move[:-1].astype(np.float32)
        bias -= float(move[-1])
    return Scorer(weight, bias)


def features_of(slots: bytes, values: bytes) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(slots, "<u2").astype(np.int64), np.frombuffer(values, "<f8")


def classify(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    sample: int = SAMPLE_DOCS,
    keep: float = KEEP,
) -> DataFrame:
    """``doc_id, posterior, score, kept``, one row for each row of ``docs``.

    ``posterior`` is the heuristics' joint verdict, ``score`` the scorer's; ``kept`` is
    whether the score reaches ``keep``. The votes of all documents are counted; at most
    ``sample`` distinct texts (least hash) train the scorer. A null or empty text is voted
    bad; a very long one is looked at as a whole. Repeated rows each count; an empty table
    gives no rows. Of texts with equal hashes one trains.
    """
    spark = docs.sparkSession
    rows = docs.select(
        docs[f"`{id_col}`"].alias("doc_id"),
        docs[f"`{text_col}`"].cast("string").alias("text"),
    )

    def start_look():
        known = known_words()

        def one(text):
            votes, slots, values = look(text, known)
            return votes, slots.astype("<u2").tobytes(), values.astype("<f8").tobytes()

        return one

    # The texts are looked at once; votes and features are written out together.
    voted = map_texts(
        rows.withColumn("at", F.xxhash64("text")), "text", start_look,
        "votes array<int>, slots binary, values binary", ["doc_id", "at"],
    )
    voted = checkpoint(voted.select("row.doc_id", "row.at", "votes", "slots", "values"))
    counted = voted.groupBy("votes").agg(F.count(F.lit(1)).alias("n")).collect()
    if not counted:
        empty = F.lit(0.0).alias
        return voted.select("doc_id", empty("posterior"), empty("score"), F.lit(False).alias("kept"))
    patterns = np.array([r["votes"] for r in counted])
    found = expectation_maximisation(patterns, np.array([r["n"] for r in counted], float))

    chosen = voted.select("at").distinct().orderBy("at").limit(sample)
    edge = chosen.agg(F.max("at")).first()[0]
    some = voted.where(F.col("at") <= F.lit(edge)).dropDuplicates(["at"])
    taken = some.select("votes", "slots", "values").collect()
    features = [features_of(r["slots"], r["values"]) for r in taken]
    soft = found.posterior(np.array([r["votes"] for r in taken])) if taken else np.zeros(0)
    shared = spark.sparkContext.broadcast((found, train(features, soft)))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, scorer = shared.value
        for batch in batches:
            votes = np.array(batch.column(1).to_pylist(), dtype=np.int64)
            pairs = zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)
            scores = [scorer.score(*features_of(*pair)) for pair in pairs]
            posterior = found.posterior(votes) if len(votes) else np.zeros(0)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(posterior), pa.array(scores, pa.float64())],
                ["doc_id", "posterior", "score"],
            )

    kind = voted.schema["doc_id"].dataType.simpleString()
    scored = voted.select("doc_id", "votes", "slots", "values").mapInArrow(
        score, f"doc_id {kind}, posterior double, score double"
    )
    return scored.withColumn("kept", F.col("score") >= keep)
