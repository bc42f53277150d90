"""Toxicity by class-conditional Kneser-Ney models.

Two models give each letter of a word the probability that it follows the five letters
before it (or the word's start): one counted over toxic, one over ordinary documents. Both
discount their counts and give what they take to one shared back-off model, whose counts are
the number of different longer contexts (Kneser-Ney), so an expression that neither class
has seen often scores alike in both. A word's weight is the difference of its two
log-likelihoods; a text's are means of it, over the whole text and over its most toxic
passage. A logistic curve turns them into a score.

Counting is distributed: words are counted by class and fold, split into letter runs, and
summed by the full 64-bit hash of a run, so different runs do not share counts. The tables
grow with the number of different runs; all labelled rows count.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from runnel.llm.text import Counts, alnum_words, as_binary, map_batches, share, shared_value

ORDER = 6
DISCOUNT = 0.75
PASSAGE = 8
THRESHOLD = 0.7
#: Labelled rows on which the curve is fitted.
CURVE_ROWS = 20_000
#: Labels are broadcast up to so many rows (16 bytes each), else joined by shuffle.
LABEL_ROWS = 500_000
#: Words kept with their weights by one task.
WORDS_KEPT = 300_000
START, STOP = 2, 3
#: Words of at least this weight count as strong.
STRONG = 3.0
FEATURES = ("mean", "passage", "top", "strong", "length")


def words_of(text: bytes | None) -> list[bytes]:
    """Runs of letters and digits, lower-cased in all alphabets."""
    return alnum_words(text.decode().lower().encode()) if text else []


def held_out(id_col: str) -> Column:
    """Rows whose labels are never learnt from."""
    return F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string")), F.lit(3)) == 1, F.lit(False))


def letter_runs(words: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes of all words, each after its start marks and before its stop mark.

    Gives the codes, the positions that are predicted, and each word's first of these.
    """
    lead = chr(START) * (ORDER - 1)
    whole = "".join(lead + w.decode() + chr(STOP) for w in words)
    codes = np.frombuffer(whole.encode("utf-32-le"), dtype="<u4").astype(np.uint64)
    inner = np.flatnonzero(codes != START)
    ends = np.flatnonzero(codes[inner] == STOP)
    return codes, inner, np.concatenate([[0], ends[:-1] + 1]) if len(ends) else ends


def run_hash(codes: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
    """A mixed hash of the ``size`` codes that end before each position ``at``."""
    out = np.full(len(at), size + 1, np.uint64)
    for i in range(size, 0, -1):
        out = (out ^ codes[at - i]) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    out *= np.uint64(0xBF58476D1CE4E5B9)
    return out ^ (out >> np.uint64(32))


def run_key(codes: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
    return run_hash(codes, at, size).view(np.int64)


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words with their number in each class of each fold (0 and 2)."""
    held: Counter[tuple[bytes, int]] = Counter()

    def out() -> pa.RecordBatch:
        by_word: dict[bytes, list[int]] = {}
        for (word, cell), n in held.items():
            by_word.setdefault(word, [0, 0, 0, 0])[cell] += n
        words = pa.array([w.decode() for w in by_word], pa.string())
        counts = np.array(list(by_word.values()), dtype=np.int64).reshape(-1, 4)
        columns = [words, *(pa.array(counts[:, i]) for i in range(4))]
        return pa.RecordBatch.from_arrays(columns, ["word", "o0", "t0", "o2", "t2"])

    for batch in batches:
        for text, toxic, fold in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            cell = (2 if fold else 0) + (1 if toxic else 0)
            for word, n in Counter(words_of(text)).items():
                held[(word, cell)] += n
            if len(held) > WORDS_KEPT:
                yield out()
                held.clear()
    yield out()


#: Kinds of keys in the class tables: counts of a run, of its context, kinds of letters.
RUN, CONTEXT, KINDS = 0, 1, 2
CELLS = ["o0", "t0", "o2", "t2"]
RUN_COLUMNS = ["size", "run", "last", "inner", "context", *CELLS]


def _letter_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words to their distinct letter runs of each size, with hashes of their parts.

    ``last`` is the run without its first letter, ``inner`` what lies between its ends,
    ``context`` the run without its last letter.
    """
    for batch in batches:
        for at in range(0, batch.num_rows, 20_000):
            part = batch.slice(at, 20_000)
            codes, here, first = letter_runs([w.encode() for w in part.column(0).to_pylist()])
            if not len(here):
                continue
            size = np.diff(np.append(first, len(here)))
            cells = np.stack([np.repeat(part.column(i).to_numpy(), size) for i in range(1, 5)])
            for k in range(1, ORDER + 1):
                hashes = run_hash(codes, here + 1, k)
                run, one, back = np.unique(hashes, return_index=True, return_inverse=True)
                added = np.stack([np.bincount(back, c, len(run)) for c in cells]).astype(np.int64)
                place = here[one]
                columns = [
                    np.full(len(run), k, np.int64), run.view(np.int64),
                    run_key(codes, place + 1, k - 1),
                    run_key(codes, place, max(k - 2, 0)),
                    run_key(codes, place, k - 1),
                    *added,
                ]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], RUN_COLUMNS)


def run_counts(labelled: DataFrame) -> DataFrame:
    """``kind, key, o0, t0, o2, t2`` over ``text, toxic, fold``: all tables of the models.

    Class tables (kinds 0 to 2) have a number for each cell of class and fold. Shared tables
    have in ``o0`` a number of different runs: kind ``10 + k`` by the last ``k`` letters of
    runs of ``k + 1``, ``20 + k`` the sum of these by context, ``30 + k`` the number of
    different letters after a context of ``k``.
    """
    words = labelled.mapInArrow(_count_words, "word string, o0 long, t0 long, o2 long, t2 long")
    words = words.groupBy("word").agg(*[F.sum(c).alias(c) for c in CELLS])
    parts = words.mapInArrow(_letter_counts, ", ".join(f"{c} long" for c in RUN_COLUMNS))
    runs = parts.groupBy("size", "run").agg(
        *[F.first(c).alias(c) for c in ("last", "inner", "context")],
        *[F.sum(c).alias(c) for c in CELLS],
    )

    def entry(kind: Column | int, at: Column, cells: Sequence[Column] | None = None) -> Column:
        values = cells or [F.lit(1).cast("long"), *[F.lit(0).cast("long")] * 3]
        named = [v.alias(c) for v, c in zip(values, CELLS, strict=True)]
        kind = F.lit(kind) if isinstance(kind, int) else kind
        return F.struct(kind.cast("int").alias("kind"), at.alias("key"), *named)

    counts = [F.col(c) for c in CELLS]
    seen = [(c > 0).cast("long") for c in counts]
    context = F.col("context")
    continued = [entry(F.col("size") + 9, F.col("last")), entry(F.col("size") + 18, F.col("inner"))]
    top = [entry(RUN, F.col("run"), counts), entry(CONTEXT, context, counts), entry(KINDS, context, seen)]
    kinds = entry(F.col("size") + 29, F.col("context"))
    made = (
        F.when(F.col("size") == ORDER, F.array(*continued, *top))
        .when(F.col("size") == 1, F.array(kinds))
        .otherwise(F.array(*continued, kinds))
    )
    each = runs.select(F.inline(made))
    return each.groupBy("kind", "key").agg(*[F.sum(c).alias(c) for c in CELLS])


@dataclass
class Tables:
    """The models' counts: class tables by class, shared tables by length."""

    run: list[Counts]
    context: list[Counts]
    kinds: list[Counts]
    shared: dict[int, Counts]

    def back_off(self, codes: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Shared probability of each letter after up to ``ORDER - 2`` letters."""
        p = np.full(len(at), 1 / 256)
        for k in range(1, ORDER):
            context, run = run_key(codes, at, k - 1), run_key(codes, at + 1, k)
            p = _discounted(
                self.shared[10 + k].of(run), self.shared[20 + k - 1].of(context),
                self.shared[30 + k - 1].of(context), p,
            )
        return p

    def weights(self, words: Sequence[bytes]) -> np.ndarray:
        """Toxic less ordinary log-likelihood of each word."""
        if not words:
            return np.zeros(0)
        codes, at, first = letter_runs(words)
        lower = self.back_off(codes, at)
        run, context = run_key(codes, at + 1, ORDER), run_key(codes, at, ORDER - 1)
        ordinary, toxic = (
            np.log(_discounted(n.of(run), total.of(context), kinds.of(context), lower))
            for n, total, kinds in zip(self.run, self.context, self.kinds, strict=True)
        )
        return np.add.reduceat(toxic - ordinary, first)


def _discounted(count, total, kinds, lower):
    """Interpolated absolute discounting; the back-off where the context is unknown."""
    known = total > 0
    total = np.where(known, total, 1)
    kept = np.maximum(count - DISCOUNT, 0) / total
    given = np.where(known, np.minimum(DISCOUNT * kinds / total, 1.0), 1.0)
    return np.maximum(np.where(known, kept, 0) + given * lower, 1e-12)


def _tables(rows: np.ndarray, cells: Sequence[Sequence[int]]) -> Tables:
    """Tables from rows ``kind, key, o0, t0, o2, t2``; ``cells`` names each class's cells."""

    def table(kind: int, columns: Sequence[int]) -> Counts:
        some = rows[rows[:, 0] == kind]
        return Counts.made(some[:, 1], some[:, list(columns)].sum(axis=1))

    by_class = [
        [table(kind, [2 + c for c in cell]) for cell in cells] for kind in (RUN, CONTEXT, KINDS)
    ]
    shared = {
        base + k: table(base + k, [2])
        for base, lengths in ((10, range(1, ORDER)), (20, range(ORDER - 1)), (30, range(ORDER - 1)))
        for k in lengths
    }
    return Tables(*by_class, shared)


class Scorer:
    """Features of texts: mean weights of the whole, of the most toxic passage and word, the
    sum over strong words, and the length."""

    def __init__(self, tables: Tables) -> None:
        self.tables = tables
        self.known: dict[bytes, float] = {}

    def many(self, texts: Sequence[bytes | None]) -> np.ndarray:
        """A row of features for each text. New words of all of them are weighed together,
        as each search in the tables costs as much for a few words as for thousands."""
        words = [words_of(t) for t in texts]
        if len(self.known) > WORDS_KEPT:
            self.known = {}
        new = [w for w in set().union(*words) if w not in self.known]
        for at in range(0, len(new), 20_000):
            some = new[at : at + 20_000]
            self.known.update(zip(some, self.tables.weights(some).tolist(), strict=True))
        return np.array([self.features(w) for w in words]).reshape(-1, len(FEATURES))

    def features(self, words: Sequence[bytes]) -> tuple[float, ...]:
        """Of words that are known."""
        if not words:
            return (0.0,) * len(FEATURES)
        weight = np.array(list(map(self.known.__getitem__, words)))
        total = np.concatenate([[0.0], weight.cumsum()])
        size = min(PASSAGE, len(words))
        passage = (total[size:] - total[:-size]).max() / size
        strong = np.log1p(np.maximum(weight - STRONG, 0).sum())
        found = weight.mean(), passage, weight.max(), strong, np.log1p(len(words))
        return tuple(map(float, found))


@dataclass
class Curve:
    """A logistic curve over standardised features."""

    mean: np.ndarray
    scale: np.ndarray
    weight: np.ndarray

    def score(self, x: np.ndarray) -> np.ndarray:
        z = np.column_stack([(x - self.mean) / self.scale, np.ones(len(x))])
        return 1 / (1 + np.exp(-np.clip(z @ self.weight, -30, 30)))


def fit_curve(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2) -> Curve:
    """Newton's method; without both classes the score is the share of toxic rows."""
    mean, scale = (x.mean(axis=0), x.std(axis=0) + 1e-6) if len(x) else (np.zeros(len(FEATURES)), np.ones(len(FEATURES)))
    weight = np.zeros(len(FEATURES) + 1)
    if len(set(y.tolist())) < 2:
        share = (y.sum() + 0.5) / (len(y) + 1) if len(y) else 0.01
        weight[-1] = np.log(share / (1 - share))
        return Curve(mean, scale, weight)
    curve = Curve(mean, scale, weight)
    z = np.column_stack([(x - mean) / scale, np.ones(len(x))])
    pull = np.full(len(FEATURES) + 1, ridge * len(x) / 100)
    pull[-1] = 0
    for _ in range(30):
        p = curve.score(x)
        slope = z.T @ (p - y) + pull * curve.weight
        bend = (z * (p * (1 - p))[:, None]).T @ z + np.diag(pull + 1e-9)
        step = np.linalg.solve(bend, slope)
        curve.weight = curve.weight - np.clip(step, -3, 3)
        if np.abs(step).max() < 1e-6:
            break
    return curve


def _features_of(df: DataFrame, shared) -> DataFrame:
    def start():
        scorer = Scorer(shared_value(shared))
        return lambda texts: list(scorer.many(texts).T)

    return map_batches(
        df, "text", start, ", ".join(f"{n} double" for n in FEATURES), ["toxic"]
    )


def usable_labels(labels: DataFrame, id_col: str, label_col: str) -> DataFrame:
    """``id, toxic`` outside the held-out third; an id with several labels takes the largest."""
    named = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
    named = named.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).alias("toxic"))
    return named.where(~held_out("id")).groupBy("id").agg(F.max("toxic").cast("int").alias("toxic"))


def labelled_rows(
    docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str
) -> DataFrame:
    """``text, toxic, fold, id`` of the rows to learn from. Few labels are broadcast."""
    named = usable_labels(labels, id_col, label_col)
    few = labels.limit(LABEL_ROWS + 1).count() <= LABEL_ROWS
    texts = docs.select(
        docs[f"`{id_col}`"].cast("long").alias("id"), as_binary(text_col).alias("text")
    )
    joined = texts.where(~held_out("id")).join(F.broadcast(named) if few else named, "id")
    fold = F.pmod(F.crc32(F.col("id").cast("string")), F.lit(3)).cast("int")
    return joined.select("text", "toxic", fold.alias("fold"), "id")


@dataclass
class Model:
    tables: Tables
    curve: Curve


def learn(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
) -> Model:
    """Both class models from all labelled rows outside the held-out third.

    The curve is fitted on at most ``CURVE_ROWS`` of these rows (those with the least hash
    of their id), each scored by class models that were counted without its fold.
    """
    spark = docs.sparkSession
    train = labelled_rows(docs, labels, id_col, text_col, label_col)
    counts = run_counts(train.select("text", "toxic", "fold")).toArrow()
    rows = np.column_stack([counts.column(n).to_numpy() for n in ["kind", "key", *CELLS]])
    rows = rows.reshape(-1, 6).astype(np.int64)
    ids = usable_labels(labels, id_col, label_col).select(F.xxhash64("id").alias("at"))
    edge = ids.orderBy("at").limit(CURVE_ROWS).agg(F.max("at")).first()[0]
    x, y = np.zeros((0, len(FEATURES))), np.zeros(0)
    if edge is not None:
        some = train.where(F.xxhash64("id") <= F.lit(edge))
        parts = []
        for fold, cells in ((0, [[2], [3]]), (2, [[0], [1]])):
            shared = share(spark, _tables(rows, cells))
            parts.append(_features_of(some.where(F.col("fold") == fold), shared))
        found = parts[0].unionByName(parts[1]).toArrow()
        x = np.column_stack(
            [found.column(n).to_numpy() for n in FEATURES]
        )
        y = np.array([r["toxic"] for r in found.column("row").to_pylist()], dtype=float)
    return Model(_tables(rows, [[0, 2], [1, 3]]), fit_curve(x, y))


def score_texts(
    docs: DataFrame, model: Model, text_col: str = "text", carry: Sequence[str] | None = None
) -> DataFrame:
    """``row`` (the input row, or its columns ``carry``) and ``score`` between 0 and 1.

    A null or empty text has no words and gets the curve's value for that. Repeated rows are
    each scored; an empty table gives no rows.
    """
    shared = share(docs.sparkSession, model)

    def start():
        learnt = shared_value(shared)
        scorer, curve = Scorer(learnt.tables), learnt.curve

        return lambda texts: [curve.score(scorer.many(texts))]

    return map_batches(docs, text_col, start, "score double", carry)
