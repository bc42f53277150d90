"""Benchmark decontamination by Wu-Manber search over words.

The patterns are windows of benchmark words. A table gives for each block of two words how
far the search may jump; blocks that end a pattern lead to a bucket of patterns, which are
compared word by word. The windows are cut by the tasks and dealt by hash into blocks of
bounded size, which are searched for one after the other. With one block, the documents are
not shuffled.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from runnel.llm.text import alnum_words, as_binary, checkpoint, map_texts

WINDOW = 10
#: Windows of one block: about 30 MB of tables in a task.
BLOCK_WINDOWS = 50_000
FOUND = "n_words long, hits array<struct<start:int,stop:int>>, item_ids array<string>"


class WuManber:
    """Finds every occurrence of word sequences that all have the same length."""

    def __init__(self, patterns: dict[tuple[bytes, ...], set[str]], length: int) -> None:
        self.length = length
        self.width = min(2, length)
        self.far = length - self.width + 1
        self.shift: dict[bytes, int] = {}
        self.bucket: dict[bytes, list[tuple[list[bytes], set[str]]]] = defaultdict(list)
        for words, items in patterns.items():
            for end in range(self.width, length + 1):
                block = b" ".join(words[end - self.width : end])
                self.shift[block] = min(self.shift.get(block, self.far), length - end)
            self.bucket[block].append((list(words), items))
        self.bucket = dict(self.bucket)

    def search(self, words: list[bytes]) -> Iterator[tuple[int, set[str]]]:
        """Start and items of each occurrence."""
        shift, far, pair, back = self.shift, self.far, self.width == 2, self.length - 1
        end, n = back, len(words)
        while end < n:
            block = words[end - 1] + b" " + words[end] if pair else words[end]
            jump = shift.get(block, far)
            if jump:
                end += jump
                continue
            start = end - back
            for pattern, items in self.bucket[block]:
                if words[start : end + 1] == pattern:
                    yield start, items
            end += 1


def windows(words: list[bytes], window: int) -> set[tuple[bytes, ...]]:
    if not words:
        return set()
    return {tuple(words[i : i + window]) for i in range(max(1, len(words) - window + 1))}


def _windows_of(
    benchmark: DataFrame, id_col: str, text_col: str, window: int
) -> DataFrame:
    """``item, pattern`` for each different window of each item, its words joined by a space."""
    named = benchmark.where(benchmark[f"`{id_col}`"].isNotNull())

    def start():
        return lambda text: ([b" ".join(w).decode() for w in windows(alnum_words(text), window)],)

    cut = map_texts(named, text_col, start, "patterns array<string>", [id_col])
    item = F.col("row").getField(id_col).cast("string")
    return cut.select(item.alias("item"), F.explode("patterns").alias("pattern")).distinct()


def _block(patterns: DataFrame, number: int, blocks: int):
    """One block of the windows as a broadcast; about as many rows as a block may have."""
    mine = F.pmod(F.xxhash64("pattern", "item"), F.lit(blocks)) == number
    found: dict[tuple[bytes, ...], set[str]] = defaultdict(set)
    for item, pattern in patterns.where(mine).collect():
        found[tuple(pattern.encode().split(b" "))].add(item)
    return patterns.sparkSession.sparkContext.broadcast(dict(found))


def _searcher(shared):
    def start():
        by_length: dict[int, dict] = defaultdict(dict)
        for w, items in shared.value.items():
            by_length[len(w)][w] = items
        found = [WuManber(patterns, length) for length, patterns in by_length.items()]

        def one(text):
            words = alnum_words(text)
            spans, items = [], set()
            for matcher in found:
                for at, names in matcher.search(words):
                    spans.append((at, at + matcher.length))
                    items |= names
            return len(words), merged(spans), sorted(items)

        return one

    return start


def _put_together(spans: Column) -> Column:
    """Overlapping and touching spans as one, in order."""
    kind = "array<struct<start:int,stop:int>>"

    def add(done: Column, x: Column) -> Column:
        last = F.try_element_at(done, F.lit(-1))
        wider = F.struct(last["start"].alias("start"), F.greatest(last["stop"], x["stop"]).alias("stop"))
        # Spans come in the order of their starts, so only the last one can meet the next.
        return F.when(x["start"] <= last["stop"], F.concat(F.slice(done, 1, F.size(done) - 1), F.array(wider))).otherwise(
            F.concat(done, F.array(x))
        )

    return F.aggregate(F.array_sort(F.array_distinct(spans)), F.array().cast(kind), add)


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Overlapping and touching spans as one, in order."""
    out: list[list[int]] = []
    for start, stop in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], stop)
        else:
            out.append([start, stop])
    return [(a, b) for a, b in out]


def find_passages(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    block_windows: int = BLOCK_WINDOWS,
    carry: Sequence[str] | None = None,
) -> DataFrame:
    """Each row's words, hit spans of words and items: ``row, n_words, hits, item_ids``.

    ``row`` is a struct of the input row, or of its columns ``carry``, so extra columns
    cannot clash. A null or empty text has no words and no hits. Items with a null id or
    without words are left out; rows that repeat an item id count as one item. Repeated
    documents are each judged, very long ones as a whole. An empty benchmark finds nothing. A
    benchmark of more than ``block_windows`` windows (of all items together) takes a pass
    over the distinct texts for each block, whose hits are stored and then put together; one
    block at a time is on the driver and with the tasks.
    """
    patterns = checkpoint(_windows_of(benchmark, item_col, item_text_col, window))
    blocks = max(1, -(-patterns.count() // block_windows))
    if blocks == 1:
        return map_texts(docs, text_col, _searcher(_block(patterns, 0, 1)), FOUND, carry)
    names = docs.columns if carry is None else carry
    row = F.struct(*[docs[f"`{c}`"] for c in names])
    keyed = docs.select(row.alias("row"), as_binary(text_col).alias("_text"))
    distinct = checkpoint(keyed.select("_text").distinct())
    parts = []
    for number in range(blocks):
        shared = _block(patterns, number, blocks)
        some = map_texts(distinct, "_text", _searcher(shared), FOUND)
        hit = some.where(F.size("hits") > 0).select("row._text", "hits", "item_ids")
        parts.append(checkpoint(hit))
        shared.destroy()
    whole = (
        reduce(DataFrame.unionByName, parts)
        .groupBy("_text")
        .agg(
            F.flatten(F.collect_list("hits")).alias("hits"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_list("item_ids")))).alias("item_ids"),
        )
        .select(F.col("_text").alias("_same"), _put_together(F.col("hits")).alias("hits"), "item_ids")
    )
    joined = keyed.join(whole, F.col("_text") == F.col("_same"), "left")
    rows = joined.select(F.struct("row", "hits", "item_ids").alias("at"), "_text")
    counted = map_texts(rows, "_text", lambda: lambda text: (len(alnum_words(text)),), "n_words long", ["at"])
    none = [F.array().cast("array<struct<start:int,stop:int>>"), F.array().cast("array<string>")]
    return counted.select(
        "row.at.row",
        "n_words",
        *[F.coalesce(F.col(f"row.at.{c}"), n).alias(c) for c, n in zip(("hits", "item_ids"), none)],
    )


def hit_words() -> Column:
    """The number of words inside ``hits``."""
    return F.aggregate(
        "hits", F.lit(0).cast("long"), lambda n, x: n + (x["stop"] - x["start"]).cast("long")
    )
