import re
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from lotwatch.functions import text as T
from lotwatch.operators import briefing
from lotwatch.params import SummaryParams

P = SummaryParams()


def test_claims(rows):
    df = rows([("up 24% at 2.4M, 17,190 units of B-001 on L2, 3 days",), ("none",)], "t string")
    got = [r[0] for r in df.select(T.extract_claims("t")).collect()]
    assert got == [["24", "2.4M", "17,190 units", "001", "3 days"], []]


def test_numbers_are_not_scaled(rows):
    df = rows([("2.4M",), ("17,190 units",), ("001",)], "c string")
    assert [r[0] for r in df.select(T.claim_number(F.col("c"))).collect()] == [2.4, 17190.0, 1.0]


def audit(spark, text, trusted):
    df = spark.createDataFrame([(text, trusted)], "text string, trusted array<double>")
    return briefing.audit(df, "text", "trusted", P).first()


def test_tolerance_and_zero(spark):
    got = audit(spark, "105 and 106 and 0 and 0.04", [100.0, 0.0])
    assert got.verified_claims == ["105"] and got.unverified_claims == ["106", "0", "0.04"]
    assert audit(spark, "0.04", [0.05]).all_claims_verified
    assert audit(spark, "7", []).unverified_claims == ["7"]


def test_marks_first_occurrence_each_time(spark):
    got = audit(spark, "5 é 5 then 9", [1.0])
    mark = " [⚠ UNVERIFIED]"
    assert got.revised_text == f"5{mark}{mark} é 5 then 9{mark}"
    assert audit(spark, "no numbers", [1.0]).revised_text == "no numbers"


def test_table_audit_equals_brute_force(spark):
    values = [0.0, 0.02, -0.03, 0.5, 0.97, 1.0, 1.04, 2.0, 9.9, 100.0, 100.4, 5000.0, 17190.0, 1e7]
    claims = [0, 0.01, 0.06, 0.07, 0.45, 0.55, 0.92, 0.95, 1.05, 1.09, 1.1, 2.1, 2.11, 9.4, 95, 94.9, 105, 105.5, 4750, 5250, 5251, 18049, 18050, 9500000, 12]
    texts = spark.createDataFrame([("k", i, f"about {c} here") for i, c in enumerate(claims)], "k string, id int, text string")
    trusted = spark.createDataFrame([("k", v) for v in values] + [("other", 12.0)], "k string, value double")
    got = {r.id: r.is_verified for r in briefing.audit_against_table(texts, "text", trusted, "k", "id", P).collect()}
    near = lambda c, v: v != 0 and abs(c - v) / max(abs(v), 1.0) <= 0.05
    assert got == {i: any(near(float(c), v) for v in values) for i, c in enumerate(claims)}


def test_table_audit_on_a_dense_grid(spark):
    values = [round(0.37 * 1.13**i, 4) for i in range(60)]
    claims = [round(0.011 * 1.017**i, 4) for i in range(700)]
    texts = spark.createDataFrame([("k", i, f"x {c:.4f} y") for i, c in enumerate(claims)], "k string, id int, text string")
    trusted = spark.createDataFrame([("k", v) for v in values], "k string, value double")
    got = {r.id: r.is_verified for r in briefing.audit_against_table(texts, "text", trusted, "k", "id", P).collect()}
    want = {i: any(abs(c - v) / max(abs(v), 1.0) <= 0.05 for v in values) for i, c in enumerate(claims)}
    assert got == want and len(set(got.values())) == 2


@pytest.mark.parametrize("units,rate,expected", [(4999, 0.0, False), (5000, 0.0, True), (1, 0.03, True)])
def test_severity(spark, units, rate, expected):
    df = spark.createDataFrame([(units, rate)], "total_units_flagged bigint, avg_defect_rate double")
    assert briefing.with_severity(df, P).first().should_publish is expected


def test_disclosure_only_when_inconclusive(spark):
    df = spark.createDataFrame([("INSUFFICIENT_EVIDENCE", 0.4), ("COMPLETE", 0.8)], "s string, c double")
    got = [r[0] for r in df.select(briefing.disclosure(F.col("s"), F.col("c"))).collect()]
    assert "40%" in got[0] and got[1] is None


def marked_one_by_one(text, claims):
    """Each claim marked in the text that the ones before it left."""
    for c in claims:
        at = text.find(c)
        if at >= 0:
            text = text[:at + len(c)] + T.UNVERIFIED_MARK + text[at + len(c):]
    return text


def test_one_pass_marks_as_one_by_one():
    rng = np.random.default_rng(8)
    for _ in range(400):
        text = "".join(rng.choice(list("1234 ,.%é") + [" units", " days"], rng.integers(0, 60)))
        claims = re.findall(T.CLAIM_PATTERN, text)
        claims = [c for c in claims if rng.random() < 0.7] + list(rng.choice(["12", "1 days", "3", "999"], 2))
        assert T.marked_text(text, claims) == marked_one_by_one(text, claims)
    assert T.marked_text(None, ["1"]) is None and T.marked_text("a 1", None) == "a 1" and T.marked_text("a 1", []) == "a 1"


def test_marks_of_a_long_text_take_one_pass():
    text = " ".join(f"{'x' * 980} {i} units" for i in range(10_000))
    claims = [f"{i} units" for i in range(10_000)]
    began = time.process_time()
    got = T.marked_text(text, claims)
    assert len(text) > 9_800_000 and time.process_time() - began < 10
    assert got.count(T.UNVERIFIED_MARK) == 10_000 and got.replace(T.UNVERIFIED_MARK, "") == text
