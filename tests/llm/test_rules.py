"""Quality rules against a plain Python version, at edges and with other tables of rules."""

import re

import pytest
from pyspark.sql import functions as F

from lotwatch.llm import rules


def plain(text):
    t = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    covered = {k for i, x in enumerate(windows) if windows.count(x) > 1 for k in (i, i + 1, i + 2)}
    return {
        "n_words": len(w), "word_chars": sum(map(len, w)), "n_symbols": len(re.findall(r"[#*$%&|<>]", t)),
        "n_lines": len(lines), "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(covered),
        "n_letter_words": sum(any(c.isalpha() for c in x) for x in w), "n_capitals": sum(c.isupper() for c in t),
        "n_stop_words": sum(x in rules.STOP_WORDS or x[0].lower() + x[1:] in rules.STOP_WORDS for x in w)}


TEXTS = [
    None, "", " \t\n\x0b\f\r ", "one", "a b c", "a b c a b c", "a a a a", "a a a", "x y z x y\nx y z\nx y z\n x y z",
    "f\x0bg\x0cf\x85h i j k", "Ünï 𝒳𝒴 漢字 # * $ % & | < > 12", "same line\n\nsame line\nsame line \nsame  line",
    "The cat and the hat are in the box " * 3000, "und der die das " + "wort " * 60]


def test_statistics_match_a_plain_version(corpus, by_id):
    got = by_id(rules.judge(corpus(TEXTS)))
    for i, text in enumerate(TEXTS):
        want = plain(text) if len(text or "") < 10_000 else None
        if want:
            assert {n: got[i][n] for n in want} == want, text
    long = got[12]
    assert (long.n_words, long.n_repeat_words) == (27_000, 27_000) and long.base_failed
    for r in got.values():
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert not (r.base_failed and r.kept) and r.kept == (r.failed == [])


def test_windows_sorted_as_they_are(spark):
    """The exact way for windows whose hashes collide gives the same places."""
    docs = spark.createDataFrame([(t,) for t in ("a b c a b c", "p q r s p q r", "a a a a a")], "text string")
    sql = rules.let("t", "text", rules.let("w", rules.WORDS, rules.let("d", rules.BY_WINDOW, rules.COVERED)))
    assert [r.n for r in docs.select(F.expr(sql).alias("n")).collect()] == [6, 6, 5]


def test_clean_text_stays_and_columns_too(corpus):
    clean = " ".join(f"The word{i}a of word{i}b was in word{i}c." for i in range(12))
    docs = corpus([clean, clean, clean.upper(), "### " * 60 + clean, "short", None])
    kept = rules.keep_passing(docs)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [0, 1]


@pytest.mark.parametrize("table, kept", [((), [0, 1]), ((rules.Rule("any", "n_words", least=1),), [1]),
                                         ((rules.Rule("none", "n_words", most=0, base=True),), [0])])
def test_other_tables_of_rules(corpus, table, kept):
    docs = corpus(["", "a word"])
    assert sorted(r.doc_id for r in rules.judge(docs, table).where("kept").collect()) == kept


def test_empty_null_and_clashing(corpus, nulls):
    docs = corpus(["a b"]).withColumnsRenamed({"score": "v", "component_id": "key", "_lines": "n_words"})
    assert rules.judge(docs.limit(0)).count() == 0 and rules.keep_passing(docs.limit(0)).count() == 0
    assert rules.judge(docs).first().n_words == 2
    r = rules.judge(nulls).first()
    assert r.doc_id is None and r.n_words == 0 and not r.kept and rules.keep_passing(nulls).count() == 0


def test_plan_has_no_python_and_no_shuffle(corpus):
    plan = rules.judge(corpus(["a"]))._jdf.queryExecution().optimizedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Aggregate" not in plan.replace("HigherOrder", "")
