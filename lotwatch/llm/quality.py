"""Quality classification by histogram gradient-boosted trees over document statistics."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotwatch.llm.common import map_slices, texts
from lotwatch.llm.words import DENSE, LOWER, find, span_hashes


@dataclass(frozen=True)
class QualityParams:
    """``rows``: labelled rows to learn from, about, chosen by a hash of the key; the rest shape
    the trees: their number and depth, bins per statistic, step, regularisation, and the least
    weight of a leaf."""

    rows: int = 20_000
    trees: int = 80
    depth: int = 4
    bins: int = 64
    step: float = 0.15
    ridge: float = 1.0
    least: float = 2.0


def byte_classes() -> np.ndarray:
    """Kind of each byte: lower case, upper case, digits, space, line break, single signs that
    tell texts apart, other signs, first and further bytes of other characters, controls."""
    kind = np.full(256, 15, np.int64)
    kind[0x61:0x7B], kind[0x41:0x5B], kind[0x30:0x3A] = 0, 1, 2
    kind[0x20], kind[0x0A] = 3, 4
    for i, signs in enumerate([".", ",", "!?", "|", "#$%&*", ":;", "'\"()-"]):
        for c in signs:
            kind[ord(c)] = 5 + i
    for c in range(0x21, 0x7F):
        if kind[c] == 15:
            kind[c] = 12
    kind[0xC0:], kind[0x80:0xC0] = 13, 14
    return kind


KINDS, KIND = 16, byte_classes()


def statistics(column: pa.Array) -> np.ndarray:
    """One row of statistics per text; null and empty texts have zeros."""
    data, rows = texts(column)
    n = len(column)
    owner = np.repeat(np.arange(n), np.diff(rows))
    bytes_ = np.diff(rows).astype(float)
    kinds = np.bincount(owner * KINDS + KIND[data], minlength=n * KINDS)[:n * KINDS].reshape(n, KINDS).astype(float)
    starts, ends, row = find(data, rows, DENSE)
    lower = LOWER[data]
    word = span_hashes(lower, starts, ends)
    length = (ends - starts).astype(float)
    per = lambda row, weights=None: np.bincount(row, weights, minlength=n)[:n].astype(float)
    words = per(row)
    total = np.maximum(words, 1)
    mean = per(row, length) / total
    spread = np.sqrt(np.maximum(per(row, length ** 2) / total - mean ** 2, 0))
    order = np.lexsort((word, row))
    new = np.ones(len(word), bool)
    new[1:] = (word[order][1:] != word[order][:-1]) | (row[order][1:] != row[order][:-1])
    distinct = per(row[order][new])
    run = np.diff(np.append(np.flatnonzero(new), len(word)))
    top = np.zeros(n)
    np.maximum.at(top, row[order][new], run)
    again = np.zeros(len(word), bool)
    again[1:] = (word[1:] == word[:-1]) & (row[1:] == row[:-1])
    last = lower[ends - 1] if len(ends) else lower[:0]
    ends_as = [per(row, np.isin(last, [ord(c) for c in signs])) / total for signs in (".", ",", "!?", "#$%&*|")]
    capital = per(row, np.isin(KIND[data[starts]], [1]) if len(starts) else None) / total
    lines = kinds[:, 4] + (bytes_ > 0)
    return np.column_stack([
        np.log1p(bytes_), np.log1p(words), kinds / np.maximum(bytes_, 1)[:, None], mean, spread, distinct / total,
        top / total, per(row, again) / total, *ends_as, capital, words / np.maximum(lines, 1), np.log1p(lines)])


@dataclass(frozen=True)
class Trees:
    """Complete binary trees in arrays: node i of a tree has children 2i + 1 and 2i + 2."""

    feature: np.ndarray
    threshold: np.ndarray
    value: np.ndarray
    base: float

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1: all rows descend all trees together, level by level."""
        margin = np.full(len(x), self.base)
        inner = self.feature.shape[1]
        row = np.arange(len(x))
        for feature, threshold, value in zip(self.feature, self.threshold, self.value):
            node = np.zeros(len(x), np.int64)
            for _ in range(int(np.log2(inner + 1))):
                node = 2 * node + 1 + (x[row, feature[node]] > threshold[node])
            margin += value[node - inner]
        return 1 / (1 + np.exp(-np.clip(margin, -50, 50)))


def boost(x: np.ndarray, y: np.ndarray, params: QualityParams) -> Trees:
    """Fit trees to log-loss gradients on binned statistics."""
    inner, leaves = 2 ** params.depth - 1, 2 ** params.depth
    feature = np.zeros((params.trees, inner), np.int64)
    threshold = np.full((params.trees, inner), np.inf)
    value = np.zeros((params.trees, leaves))
    if not len(y) or y.min() == y.max():
        return Trees(feature[:0], threshold[:0], value[:0], 0.0 if not len(y) else (4.0 if y[0] else -4.0))
    base = float(np.log(y.mean() / (1 - y.mean())))
    edges = [np.unique(np.quantile(c, np.linspace(0, 1, params.bins + 1)[1:-1])) for c in x.T]
    binned = np.column_stack([np.searchsorted(e, c, "left") for e, c in zip(edges, x.T)])
    margin = np.full(len(y), base)
    for t in range(params.trees):
        p = 1 / (1 + np.exp(-margin))
        grad, hess = p - y, p * (1 - p)
        node = np.zeros(len(y), np.int64)
        for level in range(params.depth):
            low, many = 2 ** level - 1, 2 ** level
            place = node - low
            best = np.full(many, 1e-9)
            for f, e in enumerate(edges):
                slot = place * params.bins + binned[:, f]
                g = np.bincount(slot, grad, many * params.bins).reshape(many, -1).cumsum(1)
                h = np.bincount(slot, hess, many * params.bins).reshape(many, -1).cumsum(1)
                all_g, all_h = g[:, -1:], h[:, -1:]
                gain = g ** 2 / (h + params.ridge) + (all_g - g) ** 2 / (all_h - h + params.ridge) - all_g ** 2 / (all_h + params.ridge)
                gain[(h < params.least) | (all_h - h < params.least)] = 0
                gain[:, len(e):] = 0
                at = gain.argmax(1)
                top = gain[np.arange(many), at]
                for k in np.flatnonzero(top > best):
                    best[k], feature[t, low + k], threshold[t, low + k] = top[k], f, e[at[k]]
            node = 2 * node + 1 + (x[np.arange(len(y)), feature[t, node]] > threshold[t, node])
        leaf = node - inner
        g, h = np.bincount(leaf, grad, leaves), np.bincount(leaf, hess, leaves)
        value[t] = -params.step * g / (h + params.ridge)
        margin += value[t, leaf]
    return Trees(feature, threshold, value, base)


def fit(docs: DataFrame, labels: DataFrame, params: QualityParams = QualityParams(), text: str = "text",
        key: str = "doc_id", label: str = "quality") -> Trees:
    """Learn from the rows of ``labels`` (key, label 0 or 1) that have a document.

    Null keys and labels teach nothing; of several labels of one key the greatest counts. About
    ``params.rows`` rows are taken by a hash of the key, so their number bounds what is
    broadcast and what reaches the driver (its statistics). Without rows every score is 0.5.
    """
    known = labels.select(labels[key].alias("_key"), labels[label].cast("double").alias("_y")).where(
        "_key is not null and _y in (0, 1)").groupBy("_key").agg(F.max("_y").alias("_y"))
    share = min(1.0, params.rows / max(1, known.count()))
    taken = known.where(F.pmod(F.xxhash64(F.col("_key").cast("string")), F.lit(1 << 30)) < share * (1 << 30))
    rows = docs.select(docs[key].alias("_id"), docs[text].alias("_text")).join(F.broadcast(taken), F.col("_id") == F.col("_key"))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        x = statistics(batch.column("_text"))
        return pa.RecordBatch.from_arrays([batch.column("_key"), batch.column("_y"), pa.array([r.tobytes() for r in x], pa.binary())],
                                          ["key", "y", "x"])

    rows = rows.select("_key", "_y", "_text")
    out = map_slices(rows, run, f"key {rows.schema['_key'].dataType.simpleString()}, y double, x binary", "_text")
    sample = sorted((str(r.key), r.y, bytes(r.x)) for r in out.dropDuplicates(["key"]).collect())
    x = np.array([np.frombuffer(s[2]) for s in sample]) if sample else np.zeros((0, 1))
    return boost(x, np.array([s[1] for s in sample]), params)


def score(docs: DataFrame, trees: Trees, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, score) for every row; null and empty texts are scored by their zero statistics."""
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([batch.column("_key"), pa.array(trees.score(statistics(batch.column("_text"))))],
                                          [key, "score"])

    narrow = docs.select(docs[key].alias("_key"), docs[text].alias("_text"))
    kind = narrow.schema["_key"].dataType.simpleString()
    return map_slices(narrow, run, f"`{key}` {kind}, score double", "_text")
