"""Language, quality, tokens, licenses and URLs: held-out accuracy, brute force, edge cases."""

import json
import re
import zlib
from urllib.parse import urlsplit

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lotwatch.llm import language, licenses, quality, tokens, urls
from lotwatch.llm.queries import QUERIES, RULES

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


def test_language_of_held_out_documents(spark, sf, documents):
    got = QUERIES["op1_language_id"](spark, sf).collect()
    truth = {r.doc_id: r.lang for r in documents.collect()}
    assert sorted(r.doc_id for r in got) == sorted(truth)
    held = [r for r in got if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in got)


def test_language_edge_cases(corpus, by_id, nulls, documents):
    model = language.fit(documents)
    docs = corpus([None, "", "123 !?", "the of and with", "und der die nicht ist " * 20_000, "the of and with"])
    got = by_id(language.classify(docs, model))
    assert [got[i].lang_pred for i in range(3)] == ["und"] * 3 and got[0].score == 0.0
    assert got[4].lang_pred == "de" and got[3].lang_pred == got[5].lang_pred == "en"
    kept = language.keep_identified(docs, model)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [3, 4, 5]
    assert language.classify(docs.limit(0), model).count() == 0
    assert [r.lang_pred for r in language.classify(nulls, model).collect()] == ["und"]
    untaught = language.fit(nulls)
    assert {r.lang_pred for r in language.classify(docs, untaught).collect()} == {"und"}


def test_kernel_is_shared_ngrams_over_geometric_mean():
    def grams(text):
        text = re.sub(r"\W+", " ", text.lower())
        return {text[i:i + n] for n in range(1, 5) for i in range(len(text) - n + 1)}

    texts = ["An apple a day", "a pear a day!", "Über Äpfel"]
    seen, _ = language.presence(pa.array(texts))
    for i, a in enumerate(texts):
        for j, b in enumerate(texts):
            assert abs(int((seen[i] & seen[j]).sum()) - len(grams(a) & grams(b))) <= 1  # a place may be shared


def test_quality_of_held_out_documents(spark):
    sf = "/root/testdata/sf0.01"  # the smallest table has too few labels to learn from
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    got = QUERIES["op2_quality"](spark, sf).collect()
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got)
    held = [r for r in got if r.held_out and r.doc_id in labels]
    assert held and sum(r.predicted == labels[r.doc_id] for r in held) >= 0.9 * len(held)


def test_quality_edge_cases(spark, corpus, nulls):
    docs = corpus([None, "", "a " * 50_000, "fine words here", "fine words here"])
    labels = spark.createDataFrame([(3, 1), (3, 0), (2, 0), (None, 1), (4, None), (9, 1)], "doc_id long, quality int")
    trees = quality.fit(docs, labels)
    got = {r.doc_id: r.score for r in quality.score(docs, trees).collect()}
    assert len(got) == 5 and got[0] == got[1] and got[3] == got[4]
    assert {r.score for r in quality.score(docs, quality.fit(docs, labels.limit(0))).collect()} == {0.5}
    assert quality.score(docs.limit(0), trees).count() == 0 and quality.score(nulls, trees).count() == 1


def test_flat_trees_equal_walking_them():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(400, 5))
    trees = quality.boost(x, (x[:, 0] + x[:, 1] > 0).astype(float), quality.QualityParams(trees=10))

    def walk(row):
        total = trees.base
        for feature, threshold, value in zip(trees.feature, trees.threshold, trees.value):
            node = 0
            while node < len(feature):
                node = 2 * node + (2 if row[feature[node]] > threshold[node] else 1)
            total += value[node - len(feature)]
        return 1 / (1 + np.exp(-total))

    assert np.allclose(trees.score(x), [walk(r) for r in x])
    assert ((trees.score(x) > 0.5) == (x[:, 0] + x[:, 1] > 0)).mean() > 0.95


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(VOCABULARY)


def test_token_counts_of_documents(spark, sf, documents, library):
    got = {r.doc_id: r for r in QUERIES["op5_token_counts"](spark, sf).collect()}
    for r in documents.collect():
        n = len(library.encode(r.text, add_special_tokens=False).ids)
        assert (got[r.doc_id].n_tokens, got[r.doc_id].n_bytes, got[r.doc_id].over_limit) == (n, len(r.text.encode()), n > 1024)


def test_token_counts_edge_cases(corpus, by_id, library):
    texts = ["", "aaaa aaaaa aaaaaaa", "a<|endoftext|>b <|endoftext|>", "\n\n  x\t y  ", "ÀÀÀÀ😀😀😀 日本語 " * 3, "x" * 50_000,
             "<|endoftext|", " 's't  'll don't", "a\x1cb\x85c\u00a0d", "1234567 " * 9, "\u200b\ufeff", "ab" * 999, "ab" * 999]
    got = by_id(tokens.count_tokens(corpus([*texts, None]), VOCABULARY))
    for i, text in enumerate(texts):
        assert got[i].n_tokens == len(library.encode(text, add_special_tokens=False).ids), text[:40]
    assert got[len(texts)].n_tokens == 0 and got[len(texts)].n_bytes == 0
    assert tokens.count_tokens(corpus(["x"]).limit(0), VOCABULARY).count() == 0


def test_merges_equal_one_at_a_time():
    with open(VOCABULARY) as f:
        spec = json.load(f)
    merges = tokens.Merges(spec)
    ranks = {tuple(m): i for i, m in enumerate(spec["model"]["merges"])}
    signs = tokens.byte_signs()

    def slow(word):
        parts = [signs[b] for b in word]
        while len(parts) > 1:
            rank, at = min((ranks.get((a, b), 1e9), i) for i, (a, b) in enumerate(zip(parts, parts[1:])))
            if rank == 1e9:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return len(parts)

    rng = np.random.default_rng(2)
    words = [bytes(rng.choice(list(b"aeinst h\n\xc3\xa9"), rng.integers(1, 30))) for _ in range(300)] + [b"a" * 31, b"x"]
    assert merges.counts(words).tolist() == [slow(w) for w in words]


def test_license_scan(corpus, by_id):
    texts = ["one\nLicensed under the Apache License, Version 2.0.\ntwo", "THIS WORK is licensed under the GNU  general public license, version 3",
             "Licensed under CC BY-NC 4.0.", "Licensed under CC BY-NC-SA 4.0.", "I lost my driving license yesterday", None, "",
             "Released under the MIT License.\nLicensed under CC BY 4.0.", "word " * 100_000 + "\nReleased under the MIT license"]
    got = by_id(licenses.scan(corpus(texts), licenses.LicenseParams()))
    first = {i: [f.license for f in r.found][:1] for i, r in got.items()}
    assert first[0] == ["Apache-2.0"] and got[0].found[0].first_line == 1 and got[0].found[0].differing == 0
    assert first[1] == ["GPL-3.0"] and first[2] == ["CC-BY-NC-4.0"] and first[3] == ["CC-BY-NC-SA-4.0"]
    assert first[4] == [] and got[4].n_blocks == 1 and got[5].n_blocks == got[6].n_blocks == 0
    assert {f.license for f in got[7].found} == {"MIT", "CC-BY-4.0"} and first[8] == ["MIT"]
    assert licenses.scan(corpus(["x"]).limit(0)).count() == 0


def test_license_scan_equals_wording_search(spark, sf, documents):
    """Every template line that stands in a text word for word is found, in that document."""
    found = {r.doc_id: set(r.licenses) for r in QUERIES["op7_license_scan"](spark, sf).collect()}
    for r in documents.collect():
        for t in licenses.LicenseParams().templates:
            if f"\n{t.text}\n" in f"\n{r.text}\n":
                assert t.license in found[r.doc_id]
        if not licenses.HINT.search(r.text):
            assert not found[r.doc_id]


def test_differences_equal_slow_alignment():
    def slow(t, b):
        row = [0] * (len(b) + 1)
        for i, w in enumerate(t, 1):
            new = [i]
            for j, v in enumerate(b, 1):
                new.append(min(row[j - 1] + (w != v), row[j] + 1, new[-1] + 1))
            row = new
        return min(row)

    rng = np.random.default_rng(3)
    for _ in range(200):
        t, b = (list(rng.choice(list("abcd"), rng.integers(1, 9))) for _ in range(2))
        assert licenses.differences(t, b)[0] == slow(t, b)


def test_url_rules_and_parts_by_brute_force(spark, sf):
    got = QUERIES["op8_url_filter"](spark, sf).collect()
    assert len(got) == spark.read.parquet(f"{sf}/pages.parquet").count()
    page = {r.page_id: r.url for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    for r in got:
        parts = urlsplit(page[r.page_id])
        assert (r.host, r.path) == (parts.netloc.lower(), parts.path)
        fit = [x for x in RULES if f".{r.host}".endswith(f".{x.host}") and r.path.startswith(x.path)]
        best = max(fit, key=lambda x: len(x.name), default=None)
        assert r.rule == (best.name if best else None)
        assert not best or r.verdict == best.verdict
        if not best:
            seeds = set(urls.UrlParams().seeds) & set(re.findall("[a-z]+", r.host))
            assert r.verdict == ("block" if seeds else "allow"), r


def test_url_edge_cases(spark):
    rows = [(0, None, None), (1, "no scheme", "x"), (2, "http://", "<p>casino night</p>"), (3, "HTTP://WWW.Ex.ORG/a?b#c", ""),
            (4, "x://a.com#/de/", None), (5, "x://a.com/de/?q=://y", None), (6, "http://megacasinobets.net/x", "<b>mega mega casino</b>"),
            (7, "http://" + "a" * 20_000 + ".net/" + "b" * 20_000, None), (8, "http://deorg/", None), (9, "\nhttp://q.org/\n", None)]
    rows += [(20 + i, f"http://casino-{i}.com/x", None) for i in range(9)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r for r in urls.judge(pages, RULES, urls.fit(pages)).collect()}
    assert [(got[i].host, got[i].path) for i in (0, 1, 2)] == [("", "")] * 3
    assert (got[3].host, got[3].path, got[3].rule) == ("www.ex.org", "/a", "org/")
    assert (got[4].host, got[4].path, got[4].rule) == ("a.com", "", None) and got[5].rule == "com/de/"
    assert got[6].words.startswith("mega casino bets") and got[6].verdict == "block"
    assert got[8].rule is None and got[9].host == "q.org"
    empty = pages.limit(0)
    assert urls.judge(empty, RULES, urls.fit(empty)).count() == 0


def test_viterbi_equals_all_splits():
    words = urls.Words({"ab": 2.0, "a": 3.0, "b": 3.5, "abc": 2.5, "ca": 1.0, "bca": 1.2}, 100.0, 24)

    def cost(w):
        return words.costs.get(w, np.log(100.0) + 2.3 * len(w))

    def all_splits(s):
        return [[]] if not s else [[s[:i], *rest] for i in range(1, len(s) + 1) for rest in all_splits(s[i:])]

    for s in ("abca", "abcab", "bcaab", "zab", "zz"):
        best = min(sum(map(cost, x)) for x in all_splits(s))
        assert sum(map(cost, words.split(s))) == pytest.approx(best) and "".join(words.split(s)) == s


def test_learned_blocking_beyond_seeds(spark):
    """Words that only stand with seeds weigh towards blocking."""
    rows = [(i, f"http://casino-jackpotland{i}.net/spin", None) for i in range(30)] + [(100 + i, f"http://garden{i}.net/plants", None) for i in range(60)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    model = urls.fit(pages)
    score = {r.host: r.score for r in urls.judge(pages.withColumn("url", F.regexp_replace("url", "casino-", "")), (), model).collect()}
    assert score["jackpotland1.net"] > 0.5 > score["garden1.net"]
