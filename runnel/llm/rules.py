"""Quality rules for documents, and for hosts by shrunken failure rates.

Each document is judged by counts over its whole text. For each rule by itself, the failures
of a host's documents are added up; the host's rate is shrunk towards the rate of all hosts by
a beta prior whose parameters are fitted to the hosts themselves. Documents of a host whose
rate lies above the prior's upper tail are rejected with it.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from runnel.llm.text import checkpoint, map_texts, rolling, spaced_words

SYMBOLS = b"#*$%&|<>"
REPEAT_WINDOW = 5
LEAST_WORDS = 10
REPEAT_PERCENT = 20
SYMBOL_PERCENT = 10
LINES_PERCENT = 5
#: The upper tail of a prior begins so many standard deviations above its mean; a host's limit
#: is that place, but at least the first and at most the second of these rates.
TAIL, HOST_RATES = 3.0, (0.25, 0.5)
COUNTS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"


def repeated_words(words: list[bytes], window: int = REPEAT_WINDOW) -> int:
    """Words in windows that occur twice or more, the first occurrence included."""
    number: dict[bytes, int] = {}
    return repeated_codes(np.array([number.setdefault(w, len(number)) for w in words]), window)


def repeated_codes(codes: np.ndarray, window: int = REPEAT_WINDOW) -> int:
    """The same for words given as numbers."""
    if len(codes) <= window:
        return 0
    mixed = (codes.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(32)
    _, at, times = np.unique(
        rolling(mixed, window, 0xD6E8FEB86659FD93), return_inverse=True, return_counts=True
    )
    start = np.flatnonzero(times[at] > 1)
    inside = np.zeros(len(codes) + 1, np.int64)
    inside[start] += 1
    inside[start + window] -= 1
    return int((inside.cumsum()[:-1] > 0).sum())


def counts_of(text: bytes | None) -> tuple[int, int, int, int, int]:
    """Words, code points in words, symbols, repeated lines, words in repeated windows."""
    words = spaced_words(text)
    if not words:
        return 0, 0, len(text or b"") - len((text or b"").translate(None, SYMBOLS)), 0, 0
    later_bytes = len(text) - len(text.decode())
    seen: set[bytes] = set()
    again = 0
    for line in text.split(b"\n"):
        if line.strip():
            again += line in seen
            seen.add(line)
    return (
        len(words),
        sum(map(len, words)) - later_bytes,
        len(text) - len(text.translate(None, SYMBOLS)),
        again,
        repeated_words(words),
    )


def failures() -> dict[str, Column]:
    """The rules whose failures hosts answer for. A document itself fails by the first two."""
    words = F.col("n_words")
    return {
        "few_words": words < LEAST_WORDS,
        "repeats": 100 * F.col("n_repeat_words") > REPEAT_PERCENT * words,
        "symbols": 100 * F.col("n_symbols") > SYMBOL_PERCENT * words,
        "lines": 100 * F.col("n_dup_lines") > LINES_PERCENT * words,
    }


def failed() -> Column:
    rules = failures()
    return rules["few_words"] | rules["repeats"]


def host_verdicts(
    judged: DataFrame,
    host: str,
    rules: dict[str, Column],
    tail: float = TAIL,
    bounds: tuple[float, float] = HOST_RATES,
) -> DataFrame:
    """``host, n, rates, rejected_by``: failure rates under empirical beta priors.

    Each rule has a prior of its own. Where the hosts differ no more than by chance, all get
    the common rate. A host is rejected by the rules whose limit its rate exceeds. Rows
    without a host count for none. Three numbers for each rule come to the driver.
    """
    hosts = (
        judged.where(F.col(host).isNotNull())
        .groupBy(F.col(host).alias("host"))
        .agg(
            F.count(F.lit(1)).alias("n"),
            *[F.sum(fails.cast("long")).alias(f"n_{rule}") for rule, fails in rules.items()],
        )
    )
    rate = {rule: F.col(f"n_{rule}") / F.col("n") for rule in rules}
    moments = [F.avg(1 / F.col("n")).alias("inverse")]
    for rule, x in rate.items():
        moments += [F.avg(x).alias(f"mean_{rule}"), F.avg(x * x).alias(f"square_{rule}")]
    over = hosts.agg(*moments).first()
    shrunk, above = [], []
    for rule in rules:
        mean, weight = beta_prior(over[f"mean_{rule}"], over[f"square_{rule}"], over["inverse"])
        value = F.lit(mean) if weight is None else (
            (F.col(f"n_{rule}") + F.lit(mean * weight)) / (F.col("n") + F.lit(weight))
        )
        shrunk.append(value.cast("double").alias(rule))
        above.append(F.when(value > rate_limit(mean, weight, tail, bounds), rule))
    return hosts.select(
        "host", "n", F.struct(*shrunk).alias("rates"),
        F.array_compact(F.array(*above)).alias("rejected_by"),
    )


def rate_limit(
    mean: float | None, weight: float | None, tail: float, bounds: tuple[float, float]
) -> float:
    """Where the upper tail of a beta prior begins, within bounds."""
    if mean is None or weight is None:
        return bounds[1]
    far = mean + tail * math.sqrt(mean * (1 - mean) / (weight + 1))
    return min(max(far, bounds[0]), bounds[1])


def beta_prior(
    mean: float | None, square: float | None, inverse: float | None
) -> tuple[float | None, float | None]:
    """Mean and weight (the sum of both parameters) by the hosts' moments.

    The variance of the hosts' rates less what chance alone gives hosts of their sizes is
    the variance of the beta. No weight: the hosts differ no more than by chance.
    """
    if mean is None:
        return None, None
    inner = mean * (1 - mean)
    between = square - mean * mean - inner * inverse
    return (mean, max(inner / between - 1, 0.0)) if between > 0 else (mean, None)


def judge_hosts(
    docs: DataFrame,
    host_col: str = "source",
    text_col: str = "text",
    bounds: tuple[float, float] = HOST_RATES,
    carry: Sequence[str] = ("doc_id",),
) -> DataFrame:
    """``row, host``, the counts, ``base_failed``, the host's ``rates`` and ``rejected_by``
    (the rules that reject it), and ``kept``.

    ``row`` holds the columns ``carry``, which are written out once with the counts, so extra
    columns cannot clash. A null or empty text has no words and so fails; texts of any length
    are counted whole. A document without a host is judged by itself. A rate that equals the
    limit is not above it. Repeated rows count each; an empty table gives no rows. The join
    with the hosts' verdicts moves the counts, not the texts.
    """
    names = list(dict.fromkeys(carry))
    row = F.struct(*[docs[f"`{c}`"] for c in names])
    picked = docs.select(
        row.alias("row"), docs[f"`{host_col}`"].alias("host"), docs[f"`{text_col}`"].alias("text")
    )
    counted = map_texts(picked, "text", lambda: counts_of, COUNTS, ["row", "host"])
    judged = counted.select(
        "row.row",
        F.col("row.host").cast("string").alias("host"),
        *[c.split()[0] for c in COUNTS.split(", ")],
        failed().alias("base_failed"),
    )
    judged = checkpoint(judged)
    verdicts = host_verdicts(judged, "host", failures(), bounds=bounds)
    verdicts = verdicts.select(F.col("host").alias("_h"), "rates", "rejected_by")
    joined = judged.join(verdicts, F.col("host") == F.col("_h"), "left").drop("_h")
    bad_host = F.coalesce(F.size("rejected_by") > 0, F.lit(False))
    return joined.withColumn("kept", ~F.col("base_failed") & ~bad_host)
