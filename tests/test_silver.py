from datetime import date

from pyspark.sql import functions as F

from lotwatch.functions import scalars as S
from lotwatch.functions.ranking import exact_quantiles, latest_per_key
from lotwatch.operators import silver

LABELS = ["a", "b", "c"]


def test_dominant_category(rows):
    df = rows([(1, 1, 0), (0, 0, 0), (None, 2, 5), (None, None, None), (0, 2, 2)], "a int, b int, c int")
    assert [r[0] for r in df.select(S.dominant(LABELS, LABELS)).collect()] == ["a", "a", "c", "c", "b"]


def test_two_spellings_one_row(rows):
    data = [("s1 ", "old", "2024-01-01", "VALID"), (" S1", "new", "2024-01-01", "VALID"),
            ("S1", "gone", "2024-02-01", "INVALID"), ("s2", "x", "bad time", "VALID")]
    df = rows(data, "supplier_id string, v string, ingested_at string, _ingest_status string")
    got = {r.supplier_id: r.v for r in silver.newest(silver.valid_rows(df), ["supplier_id"]).collect()}
    assert got == {"S1": "old", "S2": "x"}


def test_latest_is_stable_for_any_partitioning(spark):
    df = spark.range(10_000).select(
        (F.col("id") % 3).alias("k"), (F.col("id") % 7).alias("t"), F.col("id").alias("v"))
    answers = {tuple(sorted(tuple(r) for r in latest_per_key(df.repartition(n), ["k"], ["t"]).collect())) for n in (1, 8)}
    want = tuple(sorted(max(((i % 7, i) for i in range(10_000) if i % 3 == k))[::-1] for k in range(3)))
    assert answers == {tuple(sorted((v % 3, t, v) for v, t in want))}


def test_trailing_average_counts_rows_not_months(rows):
    months = [date(2024, 1, 1), date(2024, 2, 1), date(2024, 4, 1), date(2024, 5, 1)]
    df = rows([("S", "L1", m, float(i)) for i, m in enumerate(months, 1)],
              "supplier_id string, line_id string, month date, r double")
    out = silver.trailing_average(df, "r", "avg").orderBy("month").collect()
    assert [r.avg for r in out] == [1.0, 1.5, 2.0, 3.0]


def test_weeks_start_on_monday(rows):
    df = rows([(date(2024, 1, 7),), (date(2024, 1, 8),), (date(2024, 12, 31),)], "d date")
    got = [r[0] for r in df.select(S.week_label(S.week_start("d"))).collect()]
    assert got == ["2024-01-01/2024-01-07", "2024-01-08/2024-01-14", "2024-12-30/2025-01-05"]


def test_safe_ratio_and_percent(rows):
    df = rows([(1, 3), (1, 0), (None, 2)], "a int, b int")
    assert [r[0] for r in df.select(S.safe_ratio("a", "b")).collect()] == [0.333333, None, None]
    base = rows([(0.06, 0.04), (0.06, 0.0), (0.06, None)], "o double, b double")
    assert [r[0] for r in base.select(S.pct_above("o", "b")).collect()] == [50.0, None, None]


def test_active_flag_and_words(rows):
    df = rows([(" Active ",), ("no",), (None,)], "s string")
    assert [r[0] for r in df.select(S.is_active("s")).collect()] == [True, False, False]
    words = rows([("a  b\nc ",), ("",), ("  ",), (None,)], "t string")
    assert [r[0] for r in words.select(S.word_count("t")).collect()] == [3, 0, 0, None]
    lists = rows([('["a","b"]',), ("[]",), (None,), ("oops",)], "j string")
    assert [r[0] for r in lists.select(S.json_list_size("j")).collect()][:3] == [2, 0, None]


def test_quantiles_match_interpolation(spark):
    import numpy as np
    rng = np.random.default_rng(1)
    hot = np.round(rng.normal(100, 20, 9000), 2)
    same = np.full(500, 7.0)
    tiny = np.array([3.0])
    data = [("hot", float(v)) for v in hot] + [("same", 7.0)] * 500 + [("tiny", 3.0), ("tiny", None)]
    df = spark.createDataFrame(data, "g string, v double")
    probs, names = [0.1, 0.5, 0.9], ["a", "b", "c"]
    got = {r.g: (r.a, r.b, r.c) for r in exact_quantiles(df, ["g"], "v", probs, names).collect()}
    for g, values in {"hot": hot, "same": same, "tiny": tiny}.items():
        assert np.allclose(got[g], np.percentile(values, [10, 50, 90])), g
    whole = exact_quantiles(df, [], "v", probs, names).first()
    assert np.allclose(tuple(whole), np.percentile(np.concatenate([hot, same, tiny]), [10, 50, 90]))


def test_quantiles_of_every_small_size_and_a_large_group(spark):
    import numpy as np
    rng = np.random.default_rng(5)
    groups = {f"n{n}": rng.random(n) for n in [*range(1, 41), 333, 1985, 2003]}
    data = [(g, float(v)) for g, values in groups.items() for v in values]
    names = ["a", "b", "c"]
    df = spark.createDataFrame(data, "g string, v double")
    got = {r.g: (r.a, r.b, r.c) for r in exact_quantiles(df, ["g"], "v", [0.1, 0.5, 0.9], names).collect()}
    for g, values in groups.items():
        assert np.allclose(got[g], np.percentile(values, [10, 50, 90])), g
    large = spark.range(250_007).select(F.lit("big").alias("g"), (F.pmod(F.xxhash64("id"), F.lit(100_003)) / 7).alias("v"))
    values = large.select("v").toPandas()["v"].to_numpy()
    big = exact_quantiles(large, ["g"], "v", [0.1, 0.5, 0.9], names).first()
    assert np.allclose((big.a, big.b, big.c), np.percentile(values, [10, 50, 90]))
