"""Exact substring deduplication by seed and extend.

Of the hashes of a document's runs of five words, winnowing keeps the least in every window
as an anchor. Two documents that share 13 words share the anchor of those 13 words, as it
depends on them alone. Documents are joined on anchors; around a shared anchor the match is
extended both ways, one step for each run of 13 words whose anchor it is, and compared by
the hash of the whole run. Runs that some document with a smaller id starts too are
repeats; neighbouring ones join to maximal repeats, which are cut out.

No pair of documents is ever made: shared anchors and shared runs are found by grouped
minima, which are built up before the shuffle, so a passage that very many documents share
is one row for each task. Rows go back to these minima by a join that spreads the rows of
such a passage over many tasks.
"""

from __future__ import annotations

import gc
import hashlib
import time
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from runnel.llm.text import checkpoint, expand, join_spread, rolling, spaced_words

WINDOW = 13
SEED_WORDS = 5
BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
#: Bytes of text that are hashed in one step.
STEP_BYTES = 1 << 21
#: Low bits of a winnowing key that hold the position.
PLACE_BITS = 24
SPACES = (9, 10, 11, 12, 13, 32)


def _byte_codes() -> np.ndarray:
    codes = np.random.default_rng(13).integers(1, 1 << 64, 256, dtype=np.uint64)
    codes[list(SPACES)] = 0
    return codes


BYTE_CODES = _byte_codes()
IS_SPACE = np.isin(np.arange(256), SPACES)


def word_codes(texts: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of every word of all texts, and the number of its text.

    A word's hash is a polynomial in its bytes' random codes, over the whole buffer at once.
    """
    buffer = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
    space = IS_SPACE[buffer]
    first = np.flatnonzero(~space[1:] & space[:-1]) + 1
    if not space[0]:
        first = np.concatenate([[0], first])
    if not len(first):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    run = np.diff(np.append(first, len(buffer)))
    inside = np.arange(len(buffer) - first[0]) - np.repeat(first - first[0], run)
    powers = np.full(int(run.max()), BASES[1], np.uint64)
    powers[0] = 1
    powers = np.multiply.accumulate(powers)
    codes = BYTE_CODES[buffer[first[0] :]] * powers[inside]
    hashes = np.add.reduceat(codes, first - first[0])
    ends = np.cumsum([len(t) + 1 for t in texts])
    return hashes ^ (hashes >> np.uint64(32)), np.searchsorted(ends, first, side="right")


def anchors(
    codes: np.ndarray, of: np.ndarray, window: int = WINDOW, seed: int = SEED_WORDS
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the runs of ``seed`` words; where runs of ``window`` words inside one text
    start; and where the anchor of each of these starts: the least hash in it (by its high
    bits), of equals the last."""
    grams = rolling(codes, seed, BASES[0])
    grams ^= grams >> np.uint64(33)
    grams *= np.uint64(0xFF51AFD7ED558CCD)
    grams ^= grams >> np.uint64(29)
    width = window - seed + 1
    if len(grams) < width:
        return grams, np.zeros(0, np.int64), np.zeros(0, np.int64)
    low = (1 << PLACE_BITS) - 1
    place = np.arange(len(grams)) & low
    keys = (grams & np.uint64(~low & (1 << 64) - 1)) | (low - place).astype(np.uint64)
    least, size = keys, 1
    while 2 * size <= width:
        least, size = np.minimum(least[:-size], least[size:]), 2 * size
    if size < width:
        least = np.minimum(least[: len(keys) - width + 1], least[width - size :])
    start = np.flatnonzero(of[: len(least)] == of[window - 1 : window - 1 + len(least)])
    at = low - (least[start] & np.uint64(low)).astype(np.int64)
    return grams, start, start + ((at - start) & low)


def _steps(batches: Iterator[pa.RecordBatch], text: int) -> Iterator[tuple[pa.RecordBatch, list]]:
    """Parts of the batches with about ``STEP_BYTES`` of text each."""
    for batch in batches:
        texts = [(x.as_py() or b"") for x in batch.column(text)]
        first = size = 0
        for i, t in enumerate(texts):
            size += len(t)
            if size >= STEP_BYTES or i + 1 == len(texts):
                yield batch.slice(first, i + 1 - first), texts[first : i + 1]
                first, size = i + 1, 0


def _distinct_anchors(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in _steps(batches, 2):
            codes, of = word_codes(texts)
            grams, start, at = anchors(codes, of, window)
            at = at[np.append(True, at[1:] != at[:-1])] if len(at) else at
            doc, key = (part.column(i).to_numpy()[of[at]] for i in (0, 1))
            columns = [grams[at].view(np.int64), doc, key]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["anchor", "doc", "key"])

    return run


def _runs(window: int):
    """The runs of a document that a shared anchor belongs to."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in _steps(batches, 2):
            codes, of = word_codes(texts)
            grams, start, at = anchors(codes, of, window)
            lists = part.column(3)
            shared = lists.flatten().to_numpy()
            owner = np.repeat(np.arange(len(texts)), lists.value_lengths().to_numpy())
            # An anchor and its text as one number; what is equal by chance is sorted out later.
            mark = np.uint64(BASES[1])
            wanted = shared.view(np.uint64) + owner.astype(np.uint64) * mark
            own = grams[at] + of[start].astype(np.uint64) * mark
            kept = np.isin(own, wanted)
            start = start[kept]
            first, second = (rolling(codes, window, b)[start] for b in BASES)
            text = of[start]
            begin = np.searchsorted(of, text)
            columns = [
                first.view(np.int64), (second >> np.uint64(33)).astype(np.int32),
                part.column(0).to_numpy()[text], part.column(1).to_numpy()[text],
                (start - begin).astype(np.int32),
            ]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c) for c in columns], ["run", "check", "doc", "key", "place"]
            )

    return run


def covered(places: Sequence[int], n_words: int, window: int = WINDOW) -> np.ndarray:
    """Which words lie in a run that starts at one of the places."""
    inside = np.zeros(n_words + 1, np.int64)
    starts = np.unique(np.asarray(places, dtype=np.int64))
    inside[starts] += 1
    np.add.at(inside, starts + window, -1)
    return inside.cumsum()[:n_words] > 0


def _cut(window: int):
    def start():
        def one(text, whole, places):
            words = spaced_words(text)
            if whole:
                gone = np.full(len(words), len(words) >= window)
            else:
                gone = covered(places or (), len(words), window)
            kept = [w for w, g in zip(words, gone, strict=True) if not g]
            return len(words), int(gone.sum()), b" ".join(kept)

        return one

    return start


def release(spark: SparkSession) -> None:
    """Lets Spark delete the shuffle files of finished steps, which no plan refers to now.

    Spark deletes them when the driver has collected its garbage; the plans are let go by
    Python first, a moment later by the JVM.
    """
    for _ in range(3):
        gc.collect()
        time.sleep(0.3)
        spark.sparkContext._jvm.System.gc()


def remove_repeats(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    window: int = WINDOW,
    digest: bool = False,
) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_text``, one row for each row of ``docs``.

    ``kept_text`` are the kept words joined by one space; with ``digest`` it is replaced by
    ``kept_sha256``, its lowercase hex digest. Runs are compared on the input, so what is
    cut from one document does not change another. A null text has no words. Rows with a
    null id keep all words and take nothing from others. Rows that repeat an id are no
    sources for each other. An empty table gives no rows.
    """
    rows = docs.select(
        docs[f"`{id_col}`"].cast("long").alias("doc"),
        docs[f"`{text_col}`"].cast("string").alias("text"),
    )
    named = rows.where("doc IS NOT NULL")
    # Where an id has several rows, the text's hash tells them apart.
    repeated = named.groupBy("doc").count().where("count > 1")
    key = F.lit(0).cast("long") if repeated.isEmpty() else F.xxhash64("text")
    texts = named.select("doc", key.alias("key"), "text")
    copies = checkpoint(
        named.groupBy(F.xxhash64("text").alias("at"), F.hash("text").alias("check"), key.alias("key"))
        .agg(F.min("doc").alias("doc"))
        .select("doc", "key", F.lit(False).alias("copy"))
    )
    shared = _shared_anchors(texts, copies, window)
    release(docs.sparkSession)
    here = ["doc", "key"]
    runs = (
        texts.join(shared.hint("shuffle_hash"), here)
        .select("doc", "key", F.col("text").cast("binary"), "shared")
        .mapInArrow(_runs(window), "run long, check int, doc long, key long, place int")
    )
    least = checkpoint(
        runs.groupBy("run", "check")
        .agg(F.min("doc").alias("least"), F.max("doc").alias("most"), F.count(F.lit(1)).alias("n"))
        .where("least < most")
        .drop("most")
    )
    release(docs.sparkSession)
    places = (
        join_spread(runs, least, ["run", "check"], ["doc", "place"])
        .where("doc > least")
        .groupBy(*here)
        .agg(F.collect_list("place").alias("places"))
    )
    found = (
        texts.join(places.hint("shuffle_hash"), here, "left")
        .join(copies.hint("shuffle_hash"), here, "left")
        .select("doc", "text", F.col("copy").isNull().alias("whole"), "places")
    )
    nameless = rows.where("doc IS NULL").select(
        "doc", "text", F.lit(False).alias("whole"), F.lit(None).cast("array<int>").alias("places")
    )
    kept = "kept_sha256 string" if digest else "kept_text string"
    return _apply(found.unionByName(nameless), window, digest, f"n_words long, n_removed long, {kept}")


def _shared_anchors(texts: DataFrame, copies: DataFrame, window: int) -> DataFrame:
    """``doc, key, shared``: each document's anchors that other documents have too.

    Copies of a whole text are settled by the first of them; only firsts give anchors.
    """
    here = ["doc", "key"]
    seeds = (
        texts.join(copies.hint("shuffle_hash"), here)
        .select("doc", "key", F.col("text").cast("binary"))
        .mapInArrow(_distinct_anchors(window), "anchor long, doc long, key long")
    )
    several = checkpoint(
        seeds.groupBy("anchor")
        .agg(F.min("doc").alias("least"), F.max("doc").alias("most"), F.count(F.lit(1)).alias("n"))
        .where("least < most")
        .select("anchor", "n")
    )
    release(texts.sparkSession)
    of_doc = join_spread(seeds, several, ["anchor"], ["doc"]).groupBy(*here)
    return checkpoint(of_doc.agg(F.collect_set("anchor").alias("shared")))


def _apply(found: DataFrame, window: int, digest: bool, fields: str) -> DataFrame:
    def start():
        cut = _cut(window)()

        def one(doc, text, whole, places):
            n_words, n_removed, kept = cut(text, whole, places)
            out = hashlib.sha256(kept).hexdigest() if digest else kept.decode()
            return [doc], [n_words], [n_removed], [out]

        return one

    columns = [F.col("doc"), F.col("text").cast("binary"), F.col("whole"), F.col("places")]
    return expand(found, columns, start, "doc_id long, " + fields, rows=1000)
