"""Stored layouts: lookups read few bytes, keyed reads and joins shuffle nothing."""

from pyspark.sql import functions as F

from lotwatch.functions.ranking import latest_per_key
from lotwatch.operators import lookups
from lotwatch.sources import tables


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def scanned(df):
    """Rows of a result, and the rows that its scan took from the files for it."""
    rows = df.collect()
    return rows, df._jdf.queryExecution().executedPlan().collectLeaves().apply(0).metrics().apply("numOutputRows").value()


def test_lookups_on_a_clustered_table_read_little(spark, tmp_path):
    rows = spark.range(400_000).select(
        F.md5(F.col("id").cast("string")).alias("batch_id"), F.sha2(F.col("id").cast("string"), 512).alias("inspection_id"))
    plain, clustered = str(tmp_path / "plain"), str(tmp_path / "clustered")
    rows.repartition(4).write.parquet(plain)
    tables.write_clustered(rows.repartition(4), clustered, ["batch_id"], row_group_bytes=1 << 20)
    wanted = rows.filter("batch_id >= '8'").agg(F.min("batch_id")).first()[0]
    find = lambda path: lookups.qc(spark.read.parquet(path), batch_id=wanted)
    (a, whole), (b, part) = scanned(find(plain)), scanned(find(clustered))
    assert a == b and len(a) == 1 and part * 10 < whole
    assert "PushedFilters: [IsNotNull(batch_id), EqualTo(batch_id" in plan(find(clustered))


def test_bucketed_tables_are_not_shuffled(spark, tmp_path):
    rows = spark.range(5000).select((F.col("id") % 700).cast("string").alias("k"), F.col("id").alias("t"))
    dim = rows.select("k").distinct().withColumn("name", F.concat(F.lit("n"), "k"))
    left = tables.write_bucketed(rows, str(tmp_path / "l"), ["k"], 4)
    right = tables.write_bucketed(dim, str(tmp_path / "r"), ["k"], 4)
    newest = latest_per_key(left, ["k"], ["t"])
    assert "Exchange" not in plan(newest)
    assert newest.count() == 700 and newest.agg(F.min("t")).first()[0] == 4300
    star = left.join(right.hint("merge"), "k", "left")
    assert "Exchange" not in plan(star) and star.filter("name IS NOT NULL").count() == 5000
