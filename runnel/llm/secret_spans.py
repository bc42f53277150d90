"""Secrets in texts: fixed forms, and random strings by token efficiency.

The fixed forms are matched by patterns. Beyond them, a run of key characters is random if a
byte-pair vocabulary needs many tokens for it: words and names are made of frequent pieces,
random strings are not, so few characters fall on a token. Digests and identifiers, which
look as random but are no secrets, are known by their form and passed over first.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Callable, Iterator, Sequence
from functools import cache
from itertools import accumulate

import tiktoken
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from runnel.llm.alignment import read_ranks
from runnel.llm.text import map_texts

#: Order of kinds at one place; the first three are the base kinds.
KINDS = ("assign", "access", "hex", "random")
BASE = KINDS[:3]
SPANS = "spans array<struct<kind:string,start:int,stop:int,base:boolean>>"

#: A run of at least so many characters is tried.
LEAST = 20
#: Random if fewer characters than this fall on a token. Prose has over 3, names in code over
#: 2.3, base64 text about 1.3 and hexadecimal text about 1.7.
RATIO = 2.0
#: A random string has a piece of so many letters and digits without a sign; dates, versions
#: and short codes have not.
PIECE = 8
#: Runs longer than this are tried by windows of this size, so that a secret inside a long
#: run of other text is not averaged away.
WINDOW = 64

# The patterns of the base kinds.
ASSIGN = re.compile(
    r"(?ai:(?:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")

RUN = re.compile(rf"[A-Za-z0-9+/_=-]{{{LEAST},}}")
# Lengths of hexadecimal digests (MD5, SHA-1, SHA-2 family).
DIGEST_SIZES = (32, 40, 48, 56, 64, 96, 128)
DIGEST = re.compile(r"(?:md5|sha[0-9]{1,3})[-:=/_]?[A-Za-z0-9+/=_-]+", re.ASCII | re.IGNORECASE)
HEX_ANY = re.compile(r"[0-9a-f]+|[0-9A-F]+")
UUID = re.compile(r"[0-9a-f]{8}(?:-[0-9a-f]{4}){3}-[0-9a-f]{12}", re.ASCII | re.IGNORECASE)
NUMBER = re.compile(r"[0-9+/_=-]+")
SOLID = re.compile(rf"[A-Za-z0-9]{{{PIECE}}}")
WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")
#: Words, numbers and short codes between signs: names in code, paths, dates, versions.
NAME = re.compile(r"(?:(?:[A-Z]?[a-z]{2,}|[A-Z]{2,}|[0-9]{1,8}|[A-Za-z][0-9]{0,3})[+/_=-]*)+")


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Leftmost matches of each kind without overlaps; those that are too short are dropped."""
    found = [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m[1]) >= 6]
    if "AKIA" in text:
        found += [("access", *m.span()) for m in ACCESS.finditer(text) if len(m[0]) >= 20]
    return found + [("hex", *m.span()) for m in HEX.finditer(text)]


def is_known(run: str) -> bool:
    """Whether the form says digest, identifier or number rather than secret."""
    core = run.strip("+/_=-")
    if HEX_ANY.fullmatch(core) and len(core) in DIGEST_SIZES:
        return True
    if UUID.fullmatch(core) or DIGEST.fullmatch(run) or NUMBER.fullmatch(run):
        return True
    if not SOLID.search(core):
        return True
    kinds = (str.islower, str.isupper, str.isdigit)
    return sum(any(map(kind, core)) for kind in kinds) < 2


def is_name(part: str) -> bool:
    """Whether it is made of words and short codes; random text has only short pieces."""
    return bool(NAME.fullmatch(part)) and 5 * len(WORD.findall(part)) <= len(part)


def windows(run: str) -> Iterator[str]:
    """The run, or if it is longer than ``WINDOW`` its windows at every half of that."""
    last = max(len(run) - WINDOW, 0)
    for at in range(0, last + WINDOW // 2, WINDOW // 2):
        yield run[min(at, last) :][:WINDOW]


def is_random(run: str, tokens_of: Callable[[str], int], ratio: float = RATIO) -> bool:
    """Whether some window, if it is no name, has few characters for each token."""
    return any(len(w) < ratio * tokens_of(w) for w in windows(run) if not is_name(w))


def find_spans(
    text: str, tokens_of: Callable[[str], int], ratio: float = RATIO
) -> list[tuple[str, int, int, bool]]:
    """``kind, start, stop, base`` in code points, by start, then by the order of kinds.

    A random run is kept only where no base span lies.
    """
    order = {k: i for i, k in enumerate(KINDS)}
    base = sorted(base_spans(text), key=lambda s: (s[1], order[s[0]]))
    starts = [s[1] for s in base]
    reach = list(accumulate((s[2] for s in base), max, initial=0))
    more = []
    for m in RUN.finditer(text):
        start, stop = m.span()
        if reach[bisect_right(starts, stop - 1)] > start or is_known(m[0]):
            continue
        if is_random(m[0], tokens_of, ratio):
            more.append(("random", start, stop, False))
    named = [(*s, True) for s in base]
    return sorted(named + more, key=lambda s: (s[1], order[s[0]])) if more else named


@cache
def counter(path: str, pattern: str) -> Callable[[str], int]:
    """How many tokens a string has; one vocabulary for each Python worker."""
    coder = tiktoken.Encoding(
        "secrets", pat_str=pattern, mergeable_ranks=read_ranks(path), special_tokens={}
    )
    return lambda s: len(coder.encode_ordinary(s))


def find_secrets(
    docs: DataFrame,
    path: str,
    pattern: str,
    text_col: str = "text",
    carry: Sequence[str] | None = None,
    ratio: float = RATIO,
) -> DataFrame:
    """``row`` (the input row, or its columns ``carry``) and ``spans``, one for each row.

    ``path`` and ``pattern`` name the byte-pair vocabulary. A null or empty text has no
    spans; a very long one is searched as a whole. Spans of different kinds may overlap;
    with equal starts they come in the order of kinds. Repeated rows are each searched, an
    empty table gives no rows, and extra columns stay inside ``row``. Offsets are code
    points, the stop exclusive.
    """

    def start():
        tokens_of = counter(path, pattern)
        names = ("kind", "start", "stop", "base")

        def one(text):
            if not text:
                return ([],)
            found = find_spans(text.decode(), tokens_of, ratio)
            return ([dict(zip(names, s, strict=True)) for s in found],)

        return one

    return map_texts(docs, text_col, start, SPANS, carry)


def count_of(kind: str) -> Column:
    return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")


def listed(base_only: bool = False) -> Column:
    """``kind:start:stop`` of the spans, comma-joined."""
    spans = F.filter("spans", lambda s: s["base"]) if base_only else F.col("spans")
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"])), ","
    )
