"""Personal data by anchor expansion.

One Aho-Corasick pass finds cheap anchors: at-signs, digits, plus signs before digits,
dots between digits, schemes and identifier cues. At an anchor a local parser works out the
borders of an address, number or account and validates it. Text without anchors is passed
over at the speed of the automaton.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Callable, Sequence
from itertools import accumulate

import ahocorasick
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from runnel.llm.text import map_texts

#: Order of kinds at one place; the first four are the base kinds.
KINDS = ("email", "ip", "card", "phone", "url", "iban", "account")
BASE = KINDS[:4]
DIGITS = "0123456789"
ACCOUNT_CUES = (
    "account", "acct", "ssn", "passport", "password", "token", "secret", "api_key", "apikey",
)
SPANS = "spans array<struct<kind:string,start:int,stop:int,base:boolean>>"

LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
QUAD = re.compile(r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
SCHEME = re.compile(r"[A-Za-z][A-Za-z0-9+.-]*\Z")
LOGIN = re.compile(r"://[^\s/?#@\"'<>]+@[^\s/?#\"'<>]+[^\s\"'<>]*")
IBAN = re.compile(r"[ :=#]{0,3}([A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30})(?![A-Za-z0-9])")
VALUE = re.compile(
    r"[ \t]*(?:no\.?|nr\.?|number|id)?[ \t]*[:=#][ \t]*(?:\"([^\"\s]{6,128})\"|'([^'\s]{6,128})'"
    r"|([A-Za-z0-9_-]{6,128}))",
    re.IGNORECASE,
)


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) << (i & 1)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def iban_valid(text: str) -> bool:
    turned = text[4:] + text[:4]
    return int("".join(str(int(c, 36)) for c in turned)) % 97 == 1


def automaton() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    found.add_word("@", "email")
    found.add_word("://", "url")
    for d in DIGITS:
        found.add_word(d, "card")
        found.add_word("+" + d, "phone")
        for e in DIGITS:
            found.add_word(f"{d}.{e}", "ip")
    for cue in ("iban", "IBAN", "Iban"):
        found.add_word(cue, "iban")
    for cue in ACCOUNT_CUES:
        for form in {cue, cue.upper(), cue.capitalize()}:
            found.add_word(form, "account")
    found.make_automaton()
    return found


def _email(text: str, end: int, after: int) -> tuple[int, int, bool] | None:
    start = end
    while start > after and text[start - 1] in LOCAL:
        start -= 1
    right = DOMAIN.match(text, end) if start < end else None
    return (start, right.end(), True) if right else None


def _ip(text: str, end: int, after: int) -> tuple[int, int, bool] | None:
    start = end - 1
    while start > after and text[start - 1] in DIGITS:
        start -= 1
    found = QUAD.match(text, start) if start >= after else None
    if not found:
        return None
    parts = (p.lstrip("0") for p in found[0].split("."))
    return start, found.end(), all(len(p) < 4 and int(p or 0) <= 255 for p in parts)


def _card(text: str, end: int, after: int) -> tuple[int, int, bool] | None:
    found = CARD.match(text, end) if end >= after else None
    if not found:
        return None
    digits = found[0].replace(" ", "").replace("-", "")
    return end, found.end(), 14 <= len(digits) <= 19 and luhn(digits)


def _phone(text: str, end: int, after: int) -> tuple[int, int, bool] | None:
    found = PHONE.match(text, end - 1) if end - 1 >= after else None
    if not found:
        return None
    return end - 1, found.end(), 10 <= sum(c in DIGITS for c in found[0]) <= 15


def _login(text: str, end: int, after: int) -> tuple[int, int, bool] | None:
    """A URL that names a user, from its scheme on."""
    colon = end - 2
    left = SCHEME.search(text, max(after, colon - 20), colon)
    right = LOGIN.match(text, colon) if left else None
    return (left.start(), right.end(), True) if right else None


def _iban(text: str, end: int, after: int) -> tuple[int, int, bool] | None:
    found = IBAN.match(text, end + 1)
    if not found or found.start(1) < after:
        return None
    value = found[1].replace(" ", "")
    return found.start(1), found.end(1), 15 <= len(value) <= 34 and iban_valid(value)


def _account(text: str, end: int, after: int) -> tuple[int, int, bool] | None:
    """A value with digits that follows a cue word and a sign such as ``:`` or ``=``."""
    cue, first = end, max(-1, end - 20)
    while cue > first and (text[cue].isalpha() or text[cue] == "_"):
        cue -= 1
    if text[cue + 1 : end + 1].lower() not in ACCOUNT_CUES:
        return None
    found = VALUE.match(text, end + 1)
    if not found:
        return None
    group = next(g for g in (1, 2, 3) if found[g])
    if found.start(group) < after:
        return None
    digits = sum(c in DIGITS for c in found[group])
    return found.start(group), found.end(group), digits >= 3


PARSERS: dict[str, Callable[[str, int, int], tuple[int, int, bool] | None]] = {
    "email": _email, "ip": _ip, "card": _card, "phone": _phone,
    "url": _login, "iban": _iban, "account": _account,
}


def find_spans(text: str, anchors: ahocorasick.Automaton) -> list[tuple[str, int, int, bool]]:
    """``kind, start, stop, base`` in code points, by start, then by the order of kinds.

    Base kinds are matched left to right without overlaps within a kind; a match that fails
    its check is used up all the same. Other kinds are kept where no base span lies.
    """
    after = dict.fromkeys(KINDS, 0)
    base: list[tuple[str, int, int, bool]] = []
    more: list[tuple[str, int, int, bool]] = []
    for end, kind in anchors.iter(text):
        # The anchor of an IP address ends one behind its dot.
        at = end - 1 if kind == "ip" else end
        made = PARSERS[kind](text, at, after[kind])
        if made is None:
            continue
        start, stop, valid = made
        after[kind] = stop
        if valid:
            (base if kind in BASE else more).append((kind, start, stop, kind in BASE))
    order = {k: i for i, k in enumerate(KINDS)}
    base.sort(key=lambda s: (s[1], order[s[0]]))
    starts = [s[1] for s in base]
    reach = list(accumulate((s[2] for s in base), max, initial=0))
    free = [s for s in more if reach[bisect_left(starts, s[2])] <= s[1]]
    return sorted(base + free, key=lambda s: (s[1], order[s[0]]))


def personal_data(
    docs: DataFrame, text_col: str = "text", carry: Sequence[str] | None = None
) -> DataFrame:
    """``row`` (the input row, or its columns ``carry``) and ``spans``, one for each row.

    A null or empty text has no spans. Repeated rows are each searched; an empty table gives
    no rows. Offsets are code points, the stop exclusive.
    """

    def start():
        anchors = automaton()

        def one(text):
            if not text:
                return ([],)
            found = find_spans(text.decode(), anchors)
            return ([dict(zip(("kind", "start", "stop", "base"), s, strict=True)) for s in found],)

        return one

    return map_texts(docs, text_col, start, SPANS, carry)


def mask(text: str | None, spans: Sequence[tuple[int, int, str]]) -> str | None:
    """The text with each span replaced by its kind; overlapping spans become one."""
    if not spans:
        return text
    out, at = [], 0
    for start, stop, kind in spans:
        if start >= at:
            out += [text[at:start], f"[{kind.upper()}]"]
        at = max(at, stop)
    return "".join([*out, text[at:]])


def masked(
    docs: DataFrame, text_col: str = "text", carry: Sequence[str] | None = None
) -> DataFrame:
    """``row`` and ``clean``: the text with every span masked. Null stays null."""

    def start():
        anchors = automaton()

        def one(text):
            if not text:
                return (None if text is None else "",)
            whole = text.decode()
            return (mask(whole, [(s[1], s[2], s[0]) for s in find_spans(whole, anchors)]),)

        return one

    return map_texts(docs, text_col, start, "clean string", carry)


def count_of(kind: str) -> Column:
    return F.size(F.filter("spans", lambda s: s["base"] & (s["kind"] == kind))).cast("long")


def listed(base_only: bool = False) -> Column:
    """``kind:start:stop`` of the spans, comma-joined."""
    spans = F.filter("spans", lambda s: s["base"]) if base_only else F.col("spans")
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"])), ","
    )
