"""Phrase collocations against counting all phrases in plain Python."""

import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from lotwatch.llm import phrases
from lotwatch.llm.phrases import PhraseParams

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(rows, p):
    """(lang, rank, phrase, a, l, r, n, score) of all rows (lang, text)."""
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            f.update((lang, tuple(w[i:i + k])) for k in range(1, p.longest + 1) for i in range(len(w) - k + 1))
    f = {x: c for x, c in f.items() if c >= p.least}
    within = Counter()
    for (lang, w), c in f.items():
        for k in range(2, len(w)):
            for i in range(len(w) - k + 1):
                within[lang, w[i:i + k]] = max(within[lang, w[i:i + k]], c)
    found = {}
    for (lang, w), a in f.items():
        if len(w) > 1 and 100 * within[lang, w] < p.covered * a:
            score, _, l, r = min((2_000_000 * a // (f[lang, w[:k]] + f[lang, w[k:]]), k, f[lang, w[:k]], f[lang, w[k:]]) for k in range(1, len(w)))
            found.setdefault(lang, []).append((-score, -a, " ".join(w).encode(), l, r))
    return sorted((lang, i + 1, x[2].decode(), -x[1], x[3], x[4], n[lang], -x[0])
                  for lang, best in found.items() for i, x in enumerate(sorted(best)[:p.top]))


def result(docs, params):
    got = phrases.collocations(docs, params).select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect()
    return sorted(map(tuple, got))


def texts(seed, n=120):
    rng = np.random.default_rng(seed)
    words = ["the", "of", "and", "Él", "漢字", "x|y", "<P>", "naïve", "a-b", "1"] + [f"w{i}" for i in range(40)]
    weight = 1 / np.arange(1, len(words) + 1)
    made = []
    for _ in range(n):
        w = rng.choice(words, rng.integers(1, 60), p=weight / weight.sum())
        made.append("".join(x + rng.choice([" ", "  ", " \t", ", ", ".", "\n", "\x0b"], p=[.7, .06, .06, .06, .06, .03, .03]) for x in w))
    return made + [None, "", " . , ", "one", "The OF", "a a a a a a a a", "the of " * 3000, "the the the the " * 50]


@pytest.mark.parametrize("params", [
    PhraseParams(least=3), PhraseParams(least=3, bucket=200, heavy=3), PhraseParams(least=5, bucket=500, heavy=60, top=7),
    PhraseParams(least=2, bucket=100, heavy=300, covered=50, longest=3)])
def test_matches_counting_all_phrases(corpus, params):
    made = texts(params.least)
    lang = {i: [None, "en", "en", "fr", "und", ""][i % 6] for i in range(len(made))}
    docs = corpus(made, lang=lang)
    want = plain([(lang[i], t) for i, t in enumerate(made)], params)
    assert len(want) > 20 and result(docs, params) == want


def test_quicksort_partitions():
    rng = np.random.default_rng(1)
    keys = rng.integers(0, 6, (3000, 4))
    size = rng.integers(2, 5, 3000)
    keys[np.arange(4) >= size[:, None]] = -1
    weights = rng.integers(1, 4, 3000)
    want = Counter()
    for row, w in zip(keys.tolist(), weights.tolist()):
        for k in range(2, 5):
            if row[k - 1] >= 0:
                want[tuple(row[:k])] += w
    for least in (1, 30, 10**9):
        got = {}
        for pointers, d, f in phrases.equal_partitions(keys, weights, np.zeros(3000, np.int64), least):
            for p, c in zip(pointers, f):
                assert got.setdefault(tuple(keys[p, :d].tolist()), int(c)) == c
        assert {k: c for k, c in got.items() if c >= least} == {k: c for k, c in want.items() if c >= least}


def test_hot_groups_are_counted_whole(spark):
    """One pair of words makes most of the table, in one document and in many."""
    rows = [(i, "en", "hot pair " * 20 + f"tail{i % 3} end") for i in range(300)] + [(999, "en", "hot pair " * 20_000)]
    docs = spark.createDataFrame(rows, "doc_id long, lang string, text string").repartition(7)
    params = PhraseParams(bucket=1000, heavy=200)
    assert result(docs, params) == plain([(r[1], r[2]) for r in rows], params)


def test_exact_beyond_64_bits(spark):
    """Counts are not multiplied in 64 bits."""
    kept = spark.createDataFrame([("en", "a b", 2, 9 * 10**17), ("en", "a", 1, 10**18), ("en", "b", 1, 10**18)],
                                 "lang string, phrase string, words int, f long")
    made = phrases.Phrases.__new__(phrases.Phrases)
    made.counts = kept
    r = phrases.scored(made).first()
    assert (r.a, r.l, r.r, r.score) == (9 * 10**17, 10**18, 10**18, 900_000)


def test_empty_null_and_clashing(corpus, nulls):
    params = PhraseParams(least=1)
    docs = corpus(["a b", "a b"]).withColumnsRenamed({"score": "phrase", "component_id": "mark", "source": "word"})
    assert result(docs.limit(0), params) == [] and result(nulls, params) == []
    assert result(docs, params) == [("en", 1, "a b", 2, 2, 2, 4, 1_000_000)]
    assert result(docs.withColumn("lang", F.lit(None).cast("string")), params)[0][0] == "und"
