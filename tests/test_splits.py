"""A task's share of a table does not grow with the table."""

from lotwatch import session
from lotwatch.session import SPLIT_BYTES, small_shuffles, small_splits, split_bytes
from lotwatch.sources import landing
from lotwatch.sources import testdata as D

NAME = "spark.sql.files.maxPartitionBytes"


def test_tables_are_read_in_small_splits(spark, sf):
    before = spark.conf.get(NAME)
    try:
        spark.conf.set(NAME, "128MB")
        D.table(spark, sf, "orders")
        assert spark.conf.get(NAME) == str(SPLIT_BYTES)
        for size in ("1m", "4096", "100k"):
            spark.conf.set(NAME, size)
            small_splits(spark)
            assert spark.conf.get(NAME) == size
        with split_bytes(spark, 5):
            assert spark.conf.get(NAME) == "5"
        assert spark.conf.get(NAME) == "100k"
    finally:
        spark.conf.set(NAME, before)


def test_json_files_are_dealt_over_tasks(spark, tmp_path):
    before = spark.conf.get(NAME)
    try:
        spark.conf.set(NAME, "128MB")
        for i in range(40):
            (tmp_path / f"{i}.json").write_text(f'[{{"a": {i}.50}}]')
        rows = landing.read_json(spark, str(tmp_path), ["a"])
        assert sorted(r.a for r in rows.select("a").collect()) == sorted(f"{i}.50" for i in range(40))
        assert rows.rdd.getNumPartitions() >= 8 and max(rows.select("a").rdd.glom().map(len).collect()) <= 4
    finally:
        spark.conf.set(NAME, before)


def test_buckets_grow_with_the_table(spark, monkeypatch):
    from lotwatch.sources import tables

    rows = spark.range(1000)
    assert tables.bucket_count(rows, 16) == 16
    monkeypatch.setattr(tables, "BUCKET_ROWS", 30)
    assert tables.bucket_count(rows, 16) == 34


def test_texts_are_marked_a_few_at_a_time(spark, rows):
    from lotwatch.functions import text as T
    from lotwatch.operators import briefing
    from lotwatch.params import SummaryParams

    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    try:
        for given, kept in (("10000", str(T.BATCH_ROWS)), ("0", str(T.BATCH_ROWS)), ("7", "7")):
            spark.conf.set(name, given)
            out = briefing.audit(rows([("42 units", [1.0])], "text string, trusted array<double>"), "text", "trusted", SummaryParams())
            assert spark.conf.get(name) == kept
        assert out.first().revised_text == "42 units" + T.UNVERIFIED_MARK
    finally:
        spark.conf.set(name, before)


def test_shuffles_have_partitions_for_the_table(spark, tmp_path, monkeypatch):
    initial, advisory = "spark.sql.adaptive.coalescePartitions.initialPartitionNum", "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    streams, before = spark.conf.get("spark.sql.shuffle.partitions"), spark.conf.get(advisory)
    path = str(tmp_path / "t")
    spark.range(1000).write.parquet(path)
    try:
        spark.conf.set(advisory, "64MB")
        small_shuffles(spark, path)
        assert spark.conf.get(initial, None) is None and spark.conf.get(advisory) == str(SPLIT_BYTES)
        monkeypatch.setattr(session, "TABLE_BYTES", 100)
        small_shuffles(spark, path)
        many = int(spark.conf.get(initial))
        assert many > 4 and spark.range(10).repartition("id").rdd.getNumPartitions() <= many
        monkeypatch.setattr(session, "TABLE_BYTES", 10_000_000)
        spark.conf.set(advisory, "1m")
        small_shuffles(spark, path)
        assert (int(spark.conf.get(initial)), spark.conf.get(advisory)) == (many, "1m")
        assert spark.conf.get("spark.sql.shuffle.partitions") == streams
    finally:
        spark.conf.unset(initial)
        spark.conf.set(advisory, before)
