"""Benchmark passages in documents by Wu-Manber search over words.

Patterns are windows of benchmark words. All patterns of one length share a shift table over
blocks of two words: it tells how far a window can move before any pattern can end there. Where
it says zero, the last block picks a bucket of patterns, and these are compared word by word.
"""

from __future__ import annotations

from collections import defaultdict
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotwatch.llm.common import map_slices, texts
from lotwatch.llm.words import ALNUM, LOWER, find, mix, span_hashes

#: Entries of a shift table; blocks that share one get the smaller shift.
SHIFTS = 1 << 18
#: Window ends that one cursor walks over; longer texts get several cursors.
LANE = 4096
SPANS = "array<struct<first:long,after:long>>"


@dataclass(frozen=True)
class SearchParams:
    """``window``: words in a pattern; ``block_bytes``: benchmark text searched for at once."""

    window: int = 10
    block_bytes: int = 8 << 20


def word_spans(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    data, rows = texts(column)
    data = LOWER[data]
    return data, *find(data, rows, ALNUM)


def blocks(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of the block of ``size`` words that ends at each word."""
    if size == 1:
        return words
    return np.concatenate([words[:1], mix(words[:-1] * np.uint64(3) + words[1:])])


class Patterns:
    """All windows of one length, with their shift table and suffix buckets."""

    def __init__(self, windows: dict[bytes, set[str | None]], hashes: dict[bytes, np.ndarray], length: int) -> None:
        self.length, self.block = length, min(2, length)
        self.texts = sorted(windows)
        self.items = [sorted(windows[t]) for t in self.texts]
        words = np.array([hashes[t] for t in self.texts]).reshape(-1, length)
        self.shift = np.full(SHIFTS, length - self.block + 1, np.int64)
        last = np.zeros(len(words), np.uint64)
        for end in range(self.block - 1, length):
            last = words[:, end] if self.block == 1 else mix(words[:, end - 1] * np.uint64(3) + words[:, end])
            np.minimum.at(self.shift, (last & np.uint64(SHIFTS - 1)).astype(np.int64), length - 1 - end)
        order = np.argsort(last, kind="stable")
        self.bucket, self.member = last[order], order

    def ends(self, words: np.ndarray, first: np.ndarray, after: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Candidate (window end, pattern) pairs in rows that own words first..after-1."""
        lows, highs = [], []
        for a, b in zip(first.tolist(), after.tolist()):
            for low in range(a + self.length - 1, b, LANE):
                lows.append(low)
                highs.append(min(b, low + LANE))
        at, stop = np.array(lows, np.int64), np.array(highs, np.int64)
        block, found = blocks(words, self.block), []
        while len(at):
            skip = self.shift[(block[at] & np.uint64(SHIFTS - 1)).astype(np.int64)]
            found.append(at[skip == 0])
            at = at + np.maximum(skip, 1)
            live = at < stop
            at, stop = at[live], stop[live]
        end = np.concatenate(found) if found else np.zeros(0, np.int64)
        low = np.searchsorted(self.bucket, block[end], "left")
        many = np.searchsorted(self.bucket, block[end], "right") - low
        offset = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        return np.repeat(end, many), self.member[np.repeat(low, many) + offset]


class Searcher:
    def __init__(self, items: list[tuple[str | None, str]], window: int) -> None:
        windows: dict[int, dict[bytes, set[str | None]]] = defaultdict(lambda: defaultdict(set))
        hashes: dict[bytes, np.ndarray] = {}
        for item, text in items:
            data, starts, ends, _ = word_spans(pa.array([text]))
            if not len(starts):
                continue
            words = span_hashes(data, starts, ends)
            length = min(window, len(words))
            parts = [data[a:b].tobytes() for a, b in zip(starts, ends)]
            for i in range(len(words) - length + 1):
                key = b" ".join(parts[i:i + length])
                windows[length][key].add(item)
                hashes[key] = words[i:i + length]
        self.patterns = [Patterns(w, hashes, n) for n, w in sorted(windows.items())]

    def search(self, column: pa.Array) -> tuple[list[int], list[list[tuple[int, int]]], list[set[str | None]]]:
        """Words of each text, its hit word ranges (merged, in order), and the items found."""
        data, starts, ends, row = word_spans(column)
        n = len(column)
        count = np.bincount(row, minlength=n)[:n] if len(row) else np.zeros(n, np.int64)
        words = span_hashes(data, starts, ends)
        after = np.cumsum(count)
        first = after - count
        spans: list[list[tuple[int, int]]] = [[] for _ in range(n)]
        items: list[set[str | None]] = [set() for _ in range(n)]
        for patterns in self.patterns:
            length = patterns.length
            for end, k in zip(*map(np.ndarray.tolist, patterns.ends(words, first, after))):
                begin = end - length + 1
                here = b" ".join(data[a:b].tobytes() for a, b in zip(starts[begin:end + 1], ends[begin:end + 1]))
                if here == patterns.texts[k]:
                    r = int(row[end])
                    spans[r].append((begin - int(first[r]), end + 1 - int(first[r])))
                    items[r].update(patterns.items[k])
        return count.tolist(), [merged(s) for s in spans], items


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for first, after in sorted(spans):
        if out and first <= out[-1][1]:
            out[-1] = (out[-1][0], max(after, out[-1][1]))
        else:
            out.append((first, after))
    return out


def searchers(items: DataFrame, params: SearchParams, key: str, text: str) -> list[Searcher]:
    """One searcher per block of items; a block has about ``block_bytes`` of text."""
    items = items.select(items[key].cast("string").alias("key"), items[text].alias("text")).where(
        "text is not null")
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = -(-size // params.block_bytes) or 1
    part = F.pmod(F.xxhash64("key", "text"), F.lit(n))
    return [Searcher([tuple(r) for r in items.where(part == k).distinct().collect()], params.window)
            for k in range(n)]


def find_passages(docs: DataFrame, items: DataFrame, params: SearchParams = SearchParams(),
                  text: str = "text", key: str = "doc_id", item_key: str = "item_id",
                  item_text: str = "text") -> DataFrame:
    """Where words of ``docs`` lie inside benchmark windows.

    Returns ``key``, ``n_words``, ``spans`` (hit word ranges, merged) and ``items`` (sorted ids of
    items with occurring windows) for every row. Null and empty texts have no words and no hits.
    Items with a null text or without a word have no windows; items with the same window are all
    reported, those without an id together as one null, last in ``items``. Other columns of either table are ignored. The benchmark is searched for in
    blocks of bounded size, one narrow pass after the other; documents are never shuffled.
    """
    kind = docs.select(key).schema[key].dataType.simpleString()
    out = docs.select(docs[key].alias("_key"), docs[text].alias("_text"), F.lit(0).cast("long").alias("_words"),
                      F.array().cast(SPANS).alias("_spans"), F.array().cast("array<string>").alias("_items"))
    schema = f"_key {kind}, _text string, _words long, _spans {SPANS}, _items array<string>"
    spans_type = pa.list_(pa.struct([("first", pa.int64()), ("after", pa.int64())]))
    for searcher in searchers(items, params, item_key, item_text):

        def run(batch: pa.RecordBatch, searcher: Searcher = searcher) -> pa.RecordBatch:
            count, spans, ids = searcher.search(batch.column("_text"))
            spans = [merged(new + [(s["first"], s["after"]) for s in old])
                     for new, old in zip(spans, batch.column("_spans").to_pylist())]
            return pa.RecordBatch.from_arrays([
                batch.column("_key"), batch.column("_text"), pa.array(count, pa.int64()),
                pa.array([[{"first": a, "after": b} for a, b in s] for s in spans], spans_type),
                pa.array([sorted(new.union(old), key=lambda x: (x is None, x)) for new, old in zip(ids, batch.column("_items").to_pylist())],
                         pa.list_(pa.string()))], ["_key", "_text", "_words", "_spans", "_items"])

        out = map_slices(out, run, schema, "_text")
    return out.select(F.col("_key").alias(key), F.col("_words").alias("n_words"),
                      F.col("_spans").alias("spans"), F.col("_items").alias("items"))


def drop_contaminated(docs: DataFrame, items: DataFrame, params: SearchParams = SearchParams(),
                      text: str = "text", item_key: str = "item_id", item_text: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns as they are, in which no benchmark window occurs."""
    for searcher in searchers(items, params, item_key, item_text):

        def run(batch: pa.RecordBatch, searcher: Searcher = searcher) -> pa.RecordBatch:
            return batch.filter(pa.array([not s for s in searcher.search(batch.column(text))[1]]))

        docs = map_slices(docs, run, docs.schema, text)
    return docs
