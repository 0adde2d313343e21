"""Fill-in-the-middle against plain slicing, with exact round trips."""

import hashlib

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lotwatch.llm import infill


def plain(key, text, form_of=90, spm_of=20):
    t = text or ""
    x = hashlib.sha256(f"1:{'' if key is None else key}".encode()).hexdigest()
    h = [int(x[8 * i:8 * i + 8], 16) for i in range(4)]
    if not t or any(m in t for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= form_of:
        return len(t), "plain", None, None, t
    low, high = sorted((h[0] % (len(t) + 1), h[1] % (len(t) + 1)))
    p, m, s = t[:low], t[low:high], t[high:]
    if h[3] % 100 < spm_of:
        return len(t), "spm", low, high - low, f"<S>{s}<P>{p}<M>{m}"
    return len(t), "psm", low, high - low, f"<P>{p}<S>{s}<M>{m}"


TEXTS = [None, "", "a", "ab", "<P> is here", "x<S>", "<M>", "<P", "S><", "<<S>>", "<S<M<P", "naïve 漢字 𝒳é́ \x00 end",
         "\n\t \r", "é" * 1000, "word " * 500] + [f"text {i} {'€𝄞z' * (i % 9)}<" for i in range(60)]


def check(rows, texts, **kw):
    for r in rows:
        assert (r.n, r.form, r.prefix_chars, r.middle_chars, r.output) == plain(r.doc_id, texts[r.doc_id], **kw)
        assert r.back == (texts[r.doc_id] or "")


def result(docs, params=infill.InfillParams()):
    return infill.infill(docs, params).withColumn("back", infill.restored(F.col("output"), F.col("form"), params)).collect()


def test_matches_slicing(corpus):
    rows = result(corpus(TEXTS))
    assert len(rows) == len(TEXTS) and {r.form for r in rows} == {"plain", "psm", "spm"}
    check(rows, TEXTS)


def test_long_texts_in_windows(corpus):
    texts = ["a", "xé𝄞漢" * 500_000, "€" * 1_500_001, "b" * infill.WINDOW_BYTES, "𝄞" * (infill.WINDOW_BYTES // 4) + "!"]
    check(result(corpus(texts), infill.InfillParams(form_of=100)), texts, form_of=100)


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="<>PSM a€𝄞", max_size=12), min_size=40, max_size=40), st.integers(0, 100))
def test_round_trip_of_any_text(corpus, texts, spm_of):
    check(result(corpus(texts), infill.InfillParams(spm_of=spm_of)), texts, spm_of=spm_of)


def test_windows_are_cut_between_code_points(monkeypatch):
    import pyarrow as pa
    monkeypatch.setattr(infill, "WINDOW_BYTES", 4)
    texts = pa.array(["", "é𝄞漢a" * 5, "abcd", None, "𝄞𝄞", "x"])
    pieces, first = infill.windows(texts)
    parts = pieces.to_pylist()
    assert ["".join(parts[a:b]) for a, b in zip(first, first[1:])] == [t or "" for t in texts.to_pylist()]
    low, high = pa.array([0, 3, 1, 0, 1, 1]), pa.array([0, 11, 4, 0, 2, 1])
    got = [p.to_pylist() for p in infill.parts(texts, low, high)]
    for i, t in enumerate(texts.to_pylist()):
        t, a, b = t or "", low[i].as_py(), high[i].as_py()
        assert (got[0][i], got[1][i], got[2][i]) == (t[:a], t[a:b], t[b:])


@pytest.mark.parametrize("names", [{"score": "h0", "component_id": "key", "_lines": "n"}, {"score": "output", "lang": "form"}])
def test_empty_null_repeated_and_clashing(corpus, nulls, names):
    docs = corpus(["abc", "abc"]).withColumnsRenamed(names)
    assert infill.infill(docs.limit(0)).count() == 0
    twice = infill.infill(docs.where("doc_id = 0").unionAll(docs.where("doc_id = 0"))).collect()
    assert len(twice) == 2 and twice[0] == twice[1]
    r = infill.infill(nulls).first()
    assert (r.doc_id, r.n, r.form, r.prefix_chars, r.output) == (None, 0, "plain", None, "")
