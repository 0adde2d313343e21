"""Only rows of keys that come more than once are sorted whole; nothing is queued on disk meanwhile."""

from pyspark.sql import functions as F

from lotwatch.functions.ranking import latest_per_key
from lotwatch.plans import stages
from lotwatch.sources import versions


def test_latest_rows_are_those_of_latest_per_key(spark, rows):
    data = [(k, t, f"v{t % 3}") for k in ["a", "b", None, "d"] for t in range(3)] + [(f"x{i}", i, None) for i in range(300)]
    df = rows(data, "k string, t long, v string").repartition(4)
    want, got = (sorted(map(tuple, f(df, ["k"], ["t"]).collect()), key=str) for f in (latest_per_key, stages.latest))
    assert got == want and len(got) == 304
    once = df.where("k like 'x%'")
    assert stages.latest(once, ["k"], ["t"]) is once
    assert stages.latest(df.where("false"), ["k"], ["t"]).count() == 0


def test_sifted_rows(spark):
    rows = spark.range(1000).select("id", F.array(F.lit("é"), F.lit(None)).alias("x"), F.timestamp_seconds("id").alias("t"))
    maybe = versions._maybe_in(rows.where("id < 50").select(F.xxhash64("id").alias("hash")), 50)
    some, others = (maybe.sift(rows, F.xxhash64("id"), wanted) for wanted in (True, False))
    assert some.schema == rows.schema and {r.id for r in some.collect()} >= set(range(50)) and some.count() < 400
    assert sorted(map(tuple, some.union(others).collect())) == sorted(map(tuple, rows.collect()))
    assert "ArrowEvalPython" not in some._jdf.queryExecution().toString()


def test_held_rows_are_removed(spark):
    with stages.held(spark.range(5), "held") as df:
        assert df.count() == 5 and (path := df.inputFiles()[0])
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    assert not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)
