"""Token counts by rank-synchronous array merging of byte-pair encodings."""

from __future__ import annotations

import json

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from lotwatch.llm.common import map_slices

#: Pre-tokens of byte-level BPE: contractions, letters, numbers, other signs, white space.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Counts a worker remembers of pre-tokens; beyond that it starts anew. Results don't change.
REMEMBERED = 1 << 20
#: Bytes of a pre-token worth remembering.
SHORT = 64


def byte_signs() -> list[str]:
    """The printable sign by which vocabulary files write each byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    signs, extra = {b: chr(b) for b in plain}, 256
    for b in range(256):
        if b not in signs:
            signs[b], extra = chr(extra), extra + 1
    return [signs[b] for b in range(256)]


class Merges:
    """The merges of a byte-level BPE vocabulary file, as sorted arrays."""

    def __init__(self, spec: dict) -> None:
        vocab = spec["model"]["vocab"]
        pairs = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        self.byte_ids = np.array([vocab[s] for s in byte_signs()], np.int64)
        left = np.array([vocab[a] for a, _ in pairs], np.int64)
        right = np.array([vocab[b] for _, b in pairs], np.int64)
        made = np.array([vocab[a + b] for a, b in pairs], np.int64)
        key = (left << 32) | right
        order = np.argsort(key, kind="stable")
        self.keys, self.ranks, self.made = key[order], order.astype(np.int64), made[order]
        self.special = [t["content"] for t in spec.get("added_tokens", [])]

    def lookup(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and result of each pair; pairs that never merge have the rank of infinity."""
        key = (left << 32) | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        known = self.keys[at] == key
        return np.where(known, self.ranks[at], np.iinfo(np.int64).max), self.made[at]

    def counts(self, tokens: list[bytes]) -> np.ndarray:
        """Surviving symbols of each byte string.

        All strings lie end to end in one symbol array with an owner for each symbol. A round
        finds every string's lowest rank and merges all its occurrences in it, left to right,
        in all strings together; strings without a pair left are counted and taken out.
        """
        n = len(tokens)
        length = np.array([len(t) for t in tokens], np.int64)
        result = length.copy()
        symbols = self.byte_ids[np.frombuffer(b"".join(tokens), np.uint8)]
        owner = np.repeat(np.arange(n), length)
        while len(symbols) > 1:
            rank, made = self.lookup(symbols[:-1], symbols[1:])
            rank[owner[:-1] != owner[1:]] = np.iinfo(np.int64).max
            lowest = np.full(n, np.iinfo(np.int64).max)
            np.minimum.at(lowest, owner[:-1], rank)
            hit = np.flatnonzero((rank == lowest[owner[:-1]]) & (rank < np.iinfo(np.int64).max))
            if not len(hit):
                break
            # In a run of overlapping hits (as in "aaa") the first, third, ... merge.
            begins = np.ones(len(hit), bool)
            begins[1:] = (hit[1:] != hit[:-1] + 1) | (owner[hit[1:]] != owner[hit[:-1]])
            place = np.arange(len(hit)) - np.maximum.accumulate(np.where(begins, np.arange(len(hit)), 0))
            hit = hit[place % 2 == 0]
            symbols[hit] = made[hit]
            keep = np.ones(len(symbols), bool)
            keep[hit + 1] = False
            # Strings that had no hit are finished and leave the arrays.
            live = lowest < np.iinfo(np.int64).max
            np.subtract.at(result, owner[hit], 1)
            keep &= live[owner]
            symbols, owner = symbols[keep], owner[keep]
        return result


class Counter:
    def __init__(self, merges: Merges) -> None:
        self.merges = merges
        self.special = regex.compile("|".join(map(regex.escape, sorted(merges.special, key=len, reverse=True)))) if merges.special else None
        self.split = regex.compile(SPLIT)
        self.known: dict[str, int] = {}

    def __call__(self, batch: list[str | None]) -> list[int]:
        found, extra = [], []
        for text in batch:
            parts = [text or ""]
            n = 0
            if self.special and text:
                parts = self.special.split(text)
                n = len(parts) - 1
            found.append([t for p in parts for t in self.split.findall(p)])
            extra.append(n)
        if len(self.known) > REMEMBERED:
            self.known.clear()
        new = list({t for tokens in found for t in tokens} - self.known.keys())
        fresh = dict(zip(new, self.merges.counts([t.encode() for t in new]).tolist()))
        self.known.update((t, n) for t, n in fresh.items() if len(t) <= SHORT)
        known = self.known
        count = [n + sum([known[t] if t in known else fresh[t] for t in tokens])
                 for n, tokens in zip(extra, found)]
        return count


def count_tokens(docs: DataFrame, vocabulary: str, text: str = "text", key: str = "doc_id",
                 limit: int = 1024) -> DataFrame:
    """Tokens of every whole text, as the vocabulary's own library counts them.

    Returns ``key``, ``n_bytes`` (UTF-8), ``n_tokens`` and ``over_limit`` (more than ``limit``
    tokens), one row per input row; other columns of ``docs`` are ignored. Null and empty texts
    have no tokens. Special strings inside a text are one token each. ``vocabulary`` is the path
    of a tokenizers JSON file of a byte-level BPE; the driver reads it and ships the merges
    (their number is the vocabulary's, whatever the input).
    """
    with open(vocabulary, encoding="utf-8") as f:
        merges = Merges(json.load(f))
    workers: list[Counter] = []

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        if not workers:
            workers.append(Counter(merges))
        column = batch.column("_text").to_pylist()
        tokens = workers[0](column)
        return pa.RecordBatch.from_arrays([
            batch.column("_key"),
            pa.array([len((t or "").encode()) for t in column], pa.int64()),
            pa.array(tokens, pa.int64()),
            pa.array([n > limit for n in tokens], pa.bool_())], [key, "n_bytes", "n_tokens", "over_limit"])

    narrow = docs.select(docs[key].alias("_key"), docs[text].alias("_text"))
    kind = narrow.schema["_key"].dataType.simpleString()
    return map_slices(narrow, run, f"`{key}` {kind}, n_bytes long, n_tokens long, over_limit boolean", "_text")
