"""URL filter: site rules, and a character language-model ratio for the rest.

A rule names a host, whose subdomains it also fits, and a path prefix. The rules also give
the examples to learn from: URLs that a rule blocks, or whose host has a blocked word, are
rejected ones, all others accepted ones. (Were only allowed URLs accepted, the models would
learn the rules' own sites and reject every other.) Two variable-order Markov models over
characters, smoothed down to shorter contexts, give each URL a difference of
log-likelihoods, divided by its length. The rows are parted by a hash of the URL, and each
part is scored by models counted on all others, so no URL votes for itself. The threshold
comes from the scores of all accepted examples.

Counts go by the full 64-bit hash of a run or context, over all examples; the tables grow
with the number of different ones.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from runnel.llm.text import Counts, checkpoint, share, shared_value

ORDER = 6
#: Weight of the shorter context against one count.
PRIOR = 1.0
#: Share of accepted examples that the calibrated threshold may reject.
FALSE_REJECTIONS = 0.01
#: Parts of the rows that are scored by models of the others.
FOLDS = 8
#: The threshold's rank is off by at most this part of the accepted examples.
RANK_ERROR = 1e-5
#: Host parts that mark an example as rejected.
BLOCKED_WORDS = ("ads", "adult", "bets", "casino", "pills", "porn", "spam", "track", "viagra")


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str = "/"

    @property
    def name(self) -> str:
        return self.host + self.path


#: Fixed values of the contract: ``host/path`` with its verdict.
RULES = (
    Rule("allow", "org", "/"),
    Rule("block", "example.org", "/es/"),
    Rule("block", "example.org", "/en/1"),
    Rule("allow", "com", "/fr/"),
    Rule("block", "com", "/de/"),
)


def lower_ascii(value: Column) -> Column:
    return F.translate(value, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Both empty for null and where there is no ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"\A([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"\A[^/?#]*([^?#]*)", 1)
    return lower_ascii(host), path


def rule_of(host: Column, path: Column, rules: Sequence[Rule] = RULES) -> Column:
    """The longest rule that fits, as a struct ``rule, verdict``; null if none does."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for r in sorted(rules, key=lambda r: (len(r.name), r.name)):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        one = F.struct(F.lit(r.name).alias("rule"), F.lit(r.verdict).alias("verdict"))
        found = F.when(fits, one).otherwise(found)
    return found


def blocked_host(host: Column, words: Sequence[str] = BLOCKED_WORDS) -> Column:
    return F.arrays_overlap(F.split(host, r"[^a-z0-9]+"), F.array(*map(F.lit, words)))


def _codes(urls: Sequence[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes of all URLs, each between marks; predicted positions; each URL's first."""
    lead = "\x02" * (ORDER - 1)
    whole = "".join(lead + u.replace("\x02", "").replace("\x03", "") + "\x03" for u in urls)
    codes = np.frombuffer(whole.encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.uint64)
    at = np.flatnonzero(codes != 2)
    ends = np.flatnonzero(codes[at] == 3)
    return codes, at, np.concatenate([[0], ends[:-1] + 1]).astype(np.int64)


def _hashes(codes: np.ndarray, at: np.ndarray, size: int, salt: int) -> np.ndarray:
    """Signed 64-bit hashes of the ``size`` codes that end before each position ``at``."""
    out = np.full(len(at), 2 * size + salt + 1, np.uint64)
    for i in range(size, 0, -1):
        out = (out ^ codes[at - i]) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(31)
    out *= np.uint64(0xBF58476D1CE4E5B9)
    return (out ^ (out >> np.uint64(32))).view(np.int64)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of runs and contexts by hash and fold for each class."""
    for batch in batches:
        urls = batch.column(0).to_pylist()
        cell = batch.column(1).to_numpy()
        for a in range(0, len(urls), 5000):
            codes, at, first = _codes(urls[a : a + 5000])
            size = np.diff(np.append(first, len(at)))
            of = np.repeat(cell[a : a + 5000], size)
            for k in range(ORDER):
                for salt, place in ((0, at + 1), (1, at)):
                    found = _hashes(codes, place, k + 1 - salt, salt + 2 * k)
                    keys, back = np.unique(found, return_inverse=True)
                    counts = np.bincount(2 * FOLDS * back + of, minlength=2 * FOLDS * len(keys))
                    counts = counts.reshape(-1, FOLDS, 2)
                    key, fold = np.nonzero(counts.any(axis=2))
                    columns = [keys[key], fold, *counts[key, fold].T]
                    yield pa.RecordBatch.from_arrays(list(map(pa.array, columns)), ["key", "fold", "a", "r"])


@dataclass
class Markov:
    """Counts of the accepted and the rejected class: of all rows, and of each fold."""

    whole: tuple[Counts, Counts]
    folds: list[tuple[Counts, Counts]]

    def ratios(self, urls: Sequence[str], fold: int) -> np.ndarray:
        """Accepted less rejected log-likelihood, by character, by the other folds' counts.

        Zero where these lack a class.
        """
        pairs = list(zip(self.whole, self.folds[fold], strict=True))
        if not urls or any(every.values.sum() <= own.values.sum() for every, own in pairs):
            return np.zeros(len(urls))
        codes, at, first = _codes(urls)
        p = [np.full(len(at), 1 / 128), np.full(len(at), 1 / 128)]
        for k in range(ORDER):
            run, context = (
                _hashes(codes, place, k + 1 - salt, salt + 2 * k) for salt, place in ((0, at + 1), (1, at))
            )
            for c, (every, own) in enumerate(pairs):
                seen, total = every.of(run) - own.of(run), every.of(context) - own.of(context)
                p[c] = (seen + PRIOR * p[c]) / (total + PRIOR)
        size = np.diff(np.append(first, len(at)))
        return np.add.reduceat(np.log(p[0]) - np.log(p[1]), first) / size


def _ratio_column(df: DataFrame, shared, keep: Sequence[str]) -> DataFrame:
    """``row`` (the columns ``keep``) and ``ratio`` of ``text`` in its ``fold``."""
    picked = df.select(F.struct(*keep).alias("row"), "text", F.col("fold").cast("long"))
    out = f"row {picked.schema['row'].dataType.simpleString()}, ratio double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared_value(shared)
        for part in batches:
            fold = part.column(2).to_numpy()
            ratio = np.zeros(len(fold))
            for f in np.unique(fold).tolist():
                at = np.flatnonzero(fold == f)
                ratio[at] = model.ratios(part.column(1).take(pa.array(at)).to_pylist(), f)
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(ratio)], ["row", "ratio"])

    return picked.mapInArrow(run, out)


def learn(examples: DataFrame) -> Markov:
    """The models from ``text, rejected, fold``."""
    cell = (F.col("rejected") + 2 * F.col("fold")).cast("long")
    made = examples.select("text", cell).mapInArrow(_count, "key long, fold long, a long, r long")
    found = made.groupBy("key", "fold").agg(F.sum("a").alias("a"), F.sum("r").alias("r")).toArrow()
    key, fold, *cells = (found.column(c).to_numpy() for c in ("key", "fold", "a", "r"))
    keys, back = np.unique(key, return_inverse=True)
    whole = [Counts.made(keys, np.bincount(back, c, len(keys))) for c in cells]
    parts = [np.flatnonzero(fold == f) for f in range(FOLDS)]
    return Markov(tuple(whole), [tuple(Counts.made(key[p], c[p]) for c in cells) for p in parts])


def judge_urls(
    pages: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    rules: Sequence[Rule] = RULES,
    blocked_words: Sequence[str] = BLOCKED_WORDS,
) -> DataFrame:
    """``page_id, host, path, rule, verdict, ratio``, one row for each row of ``pages``.

    A rule decides where one fits; else the ratio of the whole URL does. It rejects below the
    value that ``FALSE_REJECTIONS`` of all accepted rows fall below, at most 0; without
    accepted or without rejected rows it rejects nothing. A null URL, and one without
    ``://``, has an empty host and path; null is judged like an empty text. Repeated rows
    count and stay; an empty table gives no rows.
    """
    host, path = host_and_path(F.col("text"))
    rows = pages.select(
        pages[f"`{id_col}`"].alias("page_id"),
        F.coalesce(pages[f"`{url_col}`"].cast("string"), F.lit("")).alias("text"),
    )
    rows = rows.select("page_id", "text", host.alias("host"), path.alias("path"))
    rows = rows.withColumn("found", rule_of(F.col("host"), F.col("path"), rules))
    spam = blocked_host(F.col("host"), blocked_words)
    blocked = F.coalesce(F.col("found.verdict") == "block", F.lit(False))
    rows = rows.withColumn("rejected", (spam | blocked).cast("long"))
    rows = rows.withColumn("fold", F.pmod(F.xxhash64("text"), F.lit(FOLDS)))
    shared = share(pages.sparkSession, learn(rows))
    scored = checkpoint(
        _ratio_column(rows, shared, ["page_id", "host", "path", "found", "rejected"])
    )
    edge = F.percentile_approx("ratio", FALSE_REJECTIONS, round(1 / RANK_ERROR))
    found = scored.where("row.rejected = 0").agg(edge).first()[0]
    threshold = 0.0 if found is None else min(0.0, found)
    by_ratio = F.when(F.col("ratio") < F.lit(threshold), "block").otherwise("allow")
    return scored.select(
        "row.page_id",
        "row.host",
        "row.path",
        "row.found.rule",
        F.coalesce("row.found.verdict", by_ratio).alias("verdict"),
        "ratio",
    )
