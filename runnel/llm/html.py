"""Main text of web pages by a recurrent block labeller.

A page is cut into leaf blocks in page order. Each block has a vector: its tag path with
class and id words, hashed; its words, hashed; and a few numbers. A bidirectional LSTM in
numpy reads the vectors of the whole page and says for every block whether it is main text.

The labeller is trained here on a bounded sample of the pages. Its examples are the pages'
own blocks, dealt into varied layouts: content containers on one side, and the kinds of
sections that the contract excludes on the other, inside and outside of the content. Both
sides draw their text from the same blocks, so the layout has to be learnt.
"""

from __future__ import annotations

import html
import random
import re
import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from runnel.llm.text import map_batches

PATH_SLOTS = 256
WORD_SLOTS = 32
NUMBERS = 4
INPUTS = PATH_SLOTS + WORD_SLOTS + NUMBERS
HIDDEN = 12
#: Pages whose blocks the labeller is trained on.
SAMPLE_PAGES = 96
LAYOUTS = 480
EPOCHS = 6
#: Blocks of a training layout, at most.
LAYOUT_BLOCKS = 48
#: Pages that are labelled in one step, and blocks of a step.
STEP_PAGES = 128

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<![^>]*>|<\?[^>]*>"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']+|\"[^\"]*\"|'[^']*')*+)>"
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>"
    r"|([^<]+)|<",
    re.DOTALL,
)
NAMES = re.compile(r"""\b(class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.IGNORECASE)
PARTS = re.compile(r"[a-z]+|[0-9]+")
#: Fixed values of the HTML standard.
VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em embed font i img ins kbd label map "
    "mark object q ruby rb rp rt s samp small span strike strong sub sup time tt u var wbr".split()
)
RAW = frozenset(("script", "style", "textarea", "title", "noscript", "template", "iframe", "svg"))
CLOSED_BY = {
    "p": frozenset(
        "address article aside blockquote details div dl fieldset figcaption figure footer form h1 "
        "h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul".split()
    ),
    "li": frozenset(("li",)),
    "dt": frozenset(("dt", "dd")),
    "dd": frozenset(("dt", "dd")),
    "tr": frozenset(("tr", "tbody", "tfoot")),
    "td": frozenset(("td", "th", "tr")),
    "th": frozenset(("td", "th", "tr")),
    "option": frozenset(("option",)),
    "head": frozenset(("body",)),
}
#: Elements inside which an open element of the kinds above stays open.
WALLS = frozenset(("table", "ul", "ol", "dl", "article", "div", "section", "body", "td", "button"))


@dataclass
class Block:
    text: str
    path: tuple[str, ...]
    linked: float = 0.0


@lru_cache(maxsize=20_000)
def _names(tag: str, rest: str) -> tuple[str, ...]:
    """The tag and the parts of its class, id and role."""
    parts = [tag]
    for m in NAMES.finditer(rest):
        parts += ["." + p for p in PARTS.findall(m[2].lower())][:8]
    return tuple(parts)


def blocks_of(page: str | None) -> list[Block]:
    """Leaf blocks with text, in page order; scripts, styles and comments have none."""
    out: list[Block] = []
    stack: list[tuple[str, tuple[str, ...]]] = []
    text: list[str] = []
    links = 0
    linked = 0
    total = 0

    def flush() -> None:
        nonlocal linked, total
        if text:
            whole = " ".join(html.unescape("".join(text)).split())
            if whole:
                path = tuple(p for _, parts in stack for p in parts)
                out.append(Block(whole, path, linked / max(total, 1)))
            text.clear()
        linked = total = 0

    page = page or ""
    at, n, last = 0, len(page), page.rfind(">")
    while at < n:
        if at > last and not page.startswith("<!--", at):
            text.append(page[at:])
            break
        m = TOKEN.match(page, at)
        at = m.end()
        if m.lastindex is None:
            if m[0] == "<":
                text.append("&lt;")
            continue
        if (run := m[7]) is not None:
            text.append(run)
            size = len(run)
            total += size
            linked += size if links else 0
            continue
        closing, tag, rest = (m[1], m[2], m[3]) if m[2] else (m[4], m[5], m[6])
        tag = tag.lower()
        if tag in RAW and not closing:
            if not rest.endswith("/"):
                end = re.compile(rf"</{re.escape(tag)}\b[^>]*>", re.IGNORECASE).search(page, at)
                at = end.end() if end else n
            continue
        if tag == "a":
            links = max(0, links + (-1 if closing else 1))
        if tag in INLINE:
            if tag == "br":
                text.append(" ")
            continue
        flush()
        if closing:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == tag:
                    del stack[i:]
                    links = 0
                    break
            continue
        for i in range(len(stack) - 1, -1, -1):
            if tag in CLOSED_BY.get(stack[i][0], ()):
                del stack[i:]
                break
            if stack[i][0] in WALLS:
                break
        if tag not in VOID and not rest.endswith("/"):
            stack.append((tag, _names(tag, rest)))
    flush()
    return out


@lru_cache(maxsize=20_000)
def _path_slots(path: tuple[str, ...]) -> np.ndarray:
    """A block's path: every part of it, and its last tag once more."""
    out = np.zeros(PATH_SLOTS, np.float32)
    for p in path:
        out[zlib.crc32(p.encode()) % PATH_SLOTS] = 1
    tags = [p for p in path if p[0] != "."]
    if tags:
        out[zlib.crc32(("last " + tags[-1]).encode()) % PATH_SLOTS] = 1
    return out


def vectors(blocks: Sequence[Block]) -> np.ndarray:
    out = np.zeros((len(blocks), INPUTS), np.float32)
    for i, b in enumerate(blocks):
        words = b.text.lower().split()
        slots = np.bincount([zlib.crc32(w.encode()) % WORD_SLOTS for w in words], minlength=WORD_SLOTS)
        out[i, :PATH_SLOTS] = _path_slots(b.path)
        out[i, PATH_SLOTS : PATH_SLOTS + WORD_SLOTS] = slots / len(words)
        out[i, -NUMBERS:] = (
            np.log1p(len(words)) / 5, b.linked, i / len(blocks), b.text[-1] in ".!?",
        )
    return out


@dataclass
class Labeller:
    """Weights of the two directions and of the output."""

    w: list[np.ndarray]
    u: list[np.ndarray]
    b: list[np.ndarray]
    out: np.ndarray

    @staticmethod
    def new(seed: int = 0) -> Labeller:
        rng = np.random.default_rng(seed)
        w = [rng.normal(0, 0.1, (INPUTS, 4 * HIDDEN)).astype(np.float32) for _ in range(2)]
        u = [rng.normal(0, 0.2, (HIDDEN, 4 * HIDDEN)).astype(np.float32) for _ in range(2)]
        b = [np.zeros(4 * HIDDEN, np.float32) for _ in range(2)]
        for x in b:
            x[HIDDEN : 2 * HIDDEN] = 1
        return Labeller(w, u, b, rng.normal(0, 0.3, 2 * HIDDEN + 1).astype(np.float32))

    def weights(self) -> list[np.ndarray]:
        return [*self.w, *self.u, *self.b, self.out]

    def states(self, x: np.ndarray, size: np.ndarray, way: int, keep: bool = False):
        """Hidden states of one direction, ``(pages, blocks, hidden)``; padding is skipped."""
        pages, length, _ = x.shape
        z = x @ self.w[way] + self.b[way]
        h = c = np.zeros((pages, HIDDEN), np.float32)
        states = np.zeros((pages, length, HIDDEN), np.float32)
        tape = []
        for t in range(length) if way == 0 else range(length - 1, -1, -1):
            on = (t < size)[:, None]
            gates = z[:, t] + h @ self.u[way]
            i, f, o = (_sigmoid(gates[:, k * HIDDEN : (k + 1) * HIDDEN]) for k in range(3))
            g = np.tanh(gates[:, 3 * HIDDEN :])
            c_new = np.where(on, f * c + i * g, c)
            tanh_c = np.tanh(c_new)
            h_new = np.where(on, o * tanh_c, h)
            if keep:
                tape.append((t, on, i, f, o, g, c, tanh_c, h))
            h, c = h_new, c_new
            states[:, t] = h
        return states, tape

    def predict(self, x: np.ndarray, size: np.ndarray) -> np.ndarray:
        both = [self.states(x, size, way)[0] for way in (0, 1)]
        return _sigmoid(np.concatenate(both, axis=2) @ self.out[:-1] + self.out[-1])

    def gradients(self, x, size, y, on):
        """Loss gradients by back-propagation through time, in the order of ``weights``."""
        runs = [self.states(x, size, way, keep=True) for way in (0, 1)]
        hidden = np.concatenate([r[0] for r in runs], axis=2)
        p = _sigmoid(hidden @ self.out[:-1] + self.out[-1])
        delta = ((p - y) * on / max(on.sum(), 1)).astype(np.float32)
        d_out = np.append(np.einsum("ptk,pt->k", hidden, delta), delta.sum()).astype(np.float32)
        d_w, d_u, d_b = [], [], []
        for way, (_, tape) in enumerate(runs):
            d_hidden = delta[:, :, None] * self.out[way * HIDDEN : (way + 1) * HIDDEN]
            d_z = np.zeros((*x.shape[:2], 4 * HIDDEN), np.float32)
            u = np.zeros_like(self.u[way])
            dh = dc = np.zeros((len(x), HIDDEN), np.float32)
            for t, live, i, f, o, g, c, tanh_c, h in reversed(tape):
                dh = dh + d_hidden[:, t]
                step_h, step_c = np.where(live, dh, 0), np.where(live, dc, 0)
                step_c = step_c + step_h * o * (1 - tanh_c**2)
                d_gates = np.concatenate(
                    [
                        step_c * g * i * (1 - i), step_c * c * f * (1 - f),
                        step_h * tanh_c * o * (1 - o), step_c * i * (1 - g**2),
                    ],
                    axis=1,
                )
                d_z[:, t] = d_gates
                u += h.T @ d_gates
                dh = d_gates @ self.u[way].T + np.where(live, 0, dh)
                dc = np.where(live, step_c * f, dc)
            flat = d_z.reshape(-1, 4 * HIDDEN)
            d_w.append(x.reshape(-1, INPUTS).T @ flat)
            d_u.append(u)
            d_b.append(flat.sum(axis=0))
        return [*d_w, *d_u, *d_b, d_out]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def padded(pages: Sequence[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    size = np.array([len(p) for p in pages])
    x = np.zeros((len(pages), max(size, default=0), INPUTS), np.float32)
    for i, p in enumerate(pages):
        x[i, : len(p)] = p
    return x, size


#: Layouts of the training pages: content containers and what may stand in them, ...
CONTAINERS = (
    ("article",), ("main",), ("main", "article"), ("div", ".content"), ("div", ".post", ".body"),
    ("div", ".entry", ".content"), ("section", ".article", ".body"), ("div", ".main", ".text"),
    ("article", ".post"), ("div", ".wrapper", "article"), ("body", "article", "section"),
)
INNER = (
    ("p",), ("p",), ("p",), ("p",), ("h1",), ("h2",), ("h3",), ("ul", "li"), ("ol", "li"),
    ("blockquote", "p"), ("pre",), ("table", "tr", "td"), ("section", "p"), ("div", "p"),
    ("figure", "figcaption"), ("div",), ("dl", "dd"), (),
)
#: ... and sections that are not main text.
EXCLUDED = (
    ("nav",), ("nav", "ul", "li"), ("header",), ("header", "nav"), ("footer",), ("aside",),
    ("form",), ("div", ".ad"), ("div", ".ads"), ("div", ".advert"), ("div", ".advertisement"),
    ("div", ".banner"), ("div", ".sponsored"), ("div", ".promo"), ("div", ".sidebar"),
    ("aside", ".sidebar"), ("div", ".menu"), ("ul", ".menu", "li"), ("div", ".nav"),
    ("div", ".navigation"), ("div", ".breadcrumb"), ("div", ".breadcrumbs"), ("div", ".footer"),
    ("div", ".header"), ("div", ".cookie"), ("div", ".cookie", ".notice"),
    ("div", ".cookie", ".banner"), ("div", ".notice"), ("div", ".consent"), ("div", ".popup"),
    ("div", ".modal"), ("div", ".newsletter"), ("div", ".subscribe"), ("div", ".signup"),
    ("form", ".search"), ("div", ".search"), ("div", ".login"), ("section", ".comments"),
    ("div", ".comments"), ("div", ".comment"), ("div", ".comment", ".body"), ("ol", ".comment", ".list", "li"),
    ("section", ".comments", "article", ".comment"), ("div", ".reply"), ("div", ".replies"),
    ("div", ".disqus", ".thread"), ("div", ".share"), ("div", ".social"), ("div", ".related"),
    ("div", ".related", ".posts"), ("section", ".related"), ("div", ".recommended"),
    ("div", ".widget"), ("div", ".pagination"), ("div", ".pager"), ("div", ".toolbar"),
    ("div", ".copyright"), ("div", ".disclaimer"), ("button",), ("select", "option"),
    ("div", ".alert"), ("div", ".toc"), ("dialog",), ("menu", "li"),
)


def layouts(texts: Sequence[str], count: int, seed: int = 0) -> Iterator[tuple[list[Block], list[int]]]:
    """Pages made of the given block texts, with a label for each block."""
    rng = random.Random(seed)
    root = ("html", "body")

    def some(path: tuple[str, ...], number: int, inner=((),)) -> list[Block]:
        made = []
        for _ in range(number):
            text = rng.choice(texts)
            if rng.random() < 0.3:
                text = " ".join(text.split()[: rng.randint(1, 6)])
            linked = 1.0 if path and path[-1] in ("nav", "li") and rng.random() < 0.7 else 0.0
            made.append(Block(text, (*root, *path, *rng.choice(inner)), linked))
        return made

    def extra(base: tuple[str, ...]) -> list[Block]:
        inner = ((), (), ("p",), ("ul", "li"), ("h2",), ("div",), ("div", "p"), ("span",))
        return some((*base, *rng.choice(EXCLUDED)), rng.randint(1, 4), inner)

    for _ in range(count):
        parts: list[tuple[int, Block]] = []
        container = rng.choice(CONTAINERS) if rng.random() < 0.6 else ("article",)
        for _ in range(rng.randint(0, 4)):
            parts += [(0, b) for b in extra(())]
        for _ in range(rng.randint(1, 4)):
            parts += [(1, b) for b in some(container, rng.randint(1, 7), INNER)]
            if rng.random() < 0.4:
                parts += [(0, b) for b in extra(container)]
        for _ in range(rng.randint(0, 4)):
            parts += [(0, b) for b in extra(())]
        parts = parts[:LAYOUT_BLOCKS]
        yield [b for _, b in parts], [y for y, _ in parts]


def train(texts: Sequence[str], count: int = LAYOUTS, epochs: int = EPOCHS, seed: int = 0) -> Labeller:
    """Adam over layouts of the block texts."""
    model = Labeller.new(seed)
    texts = [t for t in texts if t] or ["text"]
    examples = [(vectors(b), np.array(y, np.float32)) for b, y in layouts(texts, count, seed)]
    examples.sort(key=lambda e: len(e[1]))
    batches = [examples[a : a + 24] for a in range(0, len(examples), 24)]
    first = [np.zeros_like(w) for w in model.weights()]
    second = [np.zeros_like(w) for w in model.weights()]
    step, rng = 0, random.Random(seed)
    for epoch in range(epochs):
        rng.shuffle(batches)
        rate = 0.03 * 0.6**epoch
        for batch in batches:
            x, size = padded([e[0] for e in batch])
            y = np.zeros(x.shape[:2], np.float32)
            for i, (_, labels) in enumerate(batch):
                y[i, : len(labels)] = labels
            on = np.arange(x.shape[1])[None, :] < size[:, None]
            step += 1
            for w, g, m, v in zip(model.weights(), model.gradients(x, size, y, on), first, second, strict=True):
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                w -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-7)
    return model


def label(model: Labeller, pages: Sequence[Sequence[Block]]) -> list[np.ndarray]:
    """For each page, which blocks are main text; pages of similar length go together."""
    out: list[np.ndarray] = [np.zeros(0, bool)] * len(pages)
    order = sorted((i for i, p in enumerate(pages) if p), key=lambda i: len(pages[i]))
    at = 0
    while at < len(order):
        longest = len(pages[order[min(at + STEP_PAGES, len(order)) - 1]])
        number = max(1, min(STEP_PAGES, 20_000 // longest))
        step = order[at : at + number]
        x, size = padded([vectors(pages[i]) for i in step])
        p = model.predict(x, size)
        for row, i in enumerate(step):
            out[i] = p[row, : size[row]] > 0.5
        at += number
    return out


def fit(pages: DataFrame, html_col: str = "html", sample: int = SAMPLE_PAGES) -> Labeller:
    """A labeller trained on the blocks of at most ``sample`` pages (least hash of the text)."""
    text = F.col(html_col).cast("string")
    some = pages.select(text.alias("html")).where("html IS NOT NULL")
    rows = some.orderBy(F.xxhash64("html")).limit(sample).collect()
    return train([b.text for r in rows for b in blocks_of(r["html"])[:LAYOUT_BLOCKS]])


def main_text(
    pages: DataFrame,
    html_col: str = "html",
    carry: Sequence[str] | None = None,
    model: Labeller | None = None,
) -> DataFrame:
    """``row`` (the input row, or its columns ``carry``) and ``main``, the main text.

    Main text blocks are joined by line ends, in page order. A null or empty page, and one
    without main text, has an empty text. Repeated rows are each read; an empty table gives
    no rows.
    """
    shared = pages.sparkSession.sparkContext.broadcast(model or fit(pages, html_col))

    def start():
        def many(texts):
            blocks = [blocks_of(t.decode() if t else None) for t in texts]
            kept = label(shared.value, blocks)
            joined = [
                "\n".join(b.text for b, k in zip(p, on, strict=True) if k)
                for p, on in zip(blocks, kept, strict=True)
            ]
            return [joined]

        return many

    return map_batches(pages, html_col, start, "main string", carry, size=500)
