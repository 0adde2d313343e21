"""Writing and reading the silver and gold tables (Parquet, partitioned by run)."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lotwatch.functions.ranking import latest_per_key
from lotwatch.schemas import GOLD, SILVER
from lotwatch.session import COMPRESSION
from lotwatch.sources import versions


def with_lineage(df: DataFrame, run_id: str, at: Column | str, time_column: str) -> DataFrame:
    return df.withColumn(time_column, F.lit(at).cast("timestamp")).withColumn("run_id", F.lit(run_id))


def write_run(df: DataFrame, path: str, run_id: str, at: Column | str,
              time_column: str = "created_at", mode: str = "append") -> None:
    """Write one run's rows.

    ``append`` keeps other runs and replaces this run's own partition, so a repeated run
    leaves the same table; ``overwrite`` replaces the whole table.
    """
    partition_mode = {"append": "dynamic", "overwrite": "static"}[mode]
    (
        with_lineage(df, run_id, at, time_column)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", partition_mode)
        .partitionBy("run_id")
        .parquet(path, compression=COMPRESSION)
    )


def write_clustered(df: DataFrame, path: str, columns: Sequence[str], row_group_bytes: int = 16 << 20) -> None:
    """Write a table in ranges of ``columns``, sorted within each file.

    The footers' minima and maxima of those columns then tell a lookup by them apart from nearly
    all row groups, which are not read. Ranges are of about equal size whatever a value's share.
    """
    (
        df.repartitionByRange(*columns).sortWithinPartitions(*columns)
        .write.mode("overwrite").option("parquet.block.size", row_group_bytes).parquet(path)
    )


#: Rows of one bucket, which a task sorts.
BUCKET_ROWS = 500_000


def bucket_count(df: DataFrame, least: int) -> int:
    """Buckets for a table, so that none grows with it: ``least``, or more beyond ``BUCKET_ROWS`` rows a bucket."""
    return max(least, -(-df.count() // BUCKET_ROWS))


def write_bucketed(df: DataFrame, path: str, keys: Sequence[str], buckets: int) -> DataFrame:
    """Store a table in ``buckets`` hash buckets of its keys, sorted, and read it from the
    catalogue: aggregates and joins on the keys then need no shuffle of the stored side."""
    spark, name = df.sparkSession, f"bucketed_{uuid.uuid4().hex}"
    df.repartition(buckets, *keys).write.bucketBy(buckets, *keys).sortBy(*keys).option("path", path).saveAsTable(name)
    return spark.table(name)


def read_table(spark: SparkSession, path: str, filter_expr: str | Column | None = None) -> DataFrame:
    """A stored table, of the newest version where it keeps versions."""
    version = versions.newest(spark, path)
    df = versions.read(spark, path, version) if version.schema else spark.read.parquet(path)
    return df if filter_expr is None else df.filter(filter_expr)


def upsert(existing: DataFrame, incoming: DataFrame, keys: Sequence[str],
           order: Sequence[Column | str]) -> DataFrame:
    """Merge by key: the newest version of each key survives."""
    return latest_per_key(existing.unionByName(incoming), keys, order)


def quarantine(bad: DataFrame, reason: str = "error_reason", source: str = "source_path",
               run_id: str = "", at: Column | str | None = None) -> DataFrame:
    """Bad rows of any table in one schema: the row itself as JSON, with reason and origin."""
    payload = [c for c in bad.columns if c not in (reason, source)]
    return bad.select(
        F.to_json(F.struct(*payload), {"ignoreNullFields": "false"}).alias("payload"),
        F.col(reason).alias("error_reason"),
        F.col(source).alias("source_file"),
        F.lit(at).cast("timestamp").alias("quarantined_at"),
        F.lit(run_id).alias("run_id"),
    )


def ingest_log(rows: DataFrame, table: Column | str, run_id: str, at: Column | str,
               source: str = "source_path", bad: str = "is_bad", files: Sequence[str] = ()) -> DataFrame:
    """One row per file with the written and quarantined counts; ``files`` that have no row are
    logged as EMPTY, so that they don't count as new for ever."""
    column = F.lit(table) if isinstance(table, str) else table
    rows = rows.select(F.col(source).alias("source_path"), column.alias("table_name"), (~F.col(bad)).alias("ok"))
    if files:
        listed = rows.sparkSession.createDataFrame([(f,) for f in files], "source_path STRING")
        name = table if isinstance(table, str) else None
        rows = rows.unionByName(listed.select("source_path", F.lit(name).cast("string").alias("table_name"),
                                              F.lit(None).cast("boolean").alias("ok")))
    return rows.groupBy("source_path").agg(
        F.max("table_name").alias("table_name"), F.count_if("ok").alias("rows_written"),
        F.count_if(~F.col("ok")).alias("rows_quarantined"),
    ).select(
        "source_path", "table_name", "rows_written", "rows_quarantined",
        F.lit(run_id).alias("run_id"),
        F.when(F.col("rows_written") > 0, "OK").when(F.col("rows_quarantined") > 0, "QUARANTINED").otherwise("EMPTY").alias("status"),
        F.lit(at).cast("timestamp").alias("ingested_at"),
    )


def run_log(runs: DataFrame, stages: Sequence[str], at: Column | str) -> DataFrame:
    """Run-log rows from per-run summaries (run_id, escalations, duration_seconds, notes)."""
    return runs.select(
        "run_id", F.lit(at).cast("timestamp").alias("run_timestamp"),
        F.array(*[F.lit(s) for s in stages]).alias("stages"),
        F.col("escalations").cast("bigint").alias("escalations"),
        F.col("duration_seconds").cast("double").alias("duration_seconds"),
        "notes", F.lit(at).cast("timestamp").alias("created_at"),
    )


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Project to a registered schema; a missing column becomes null."""
    have = set(df.columns)
    return df.select(*[
        (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in schema.fields
    ])


def create_tables(spark: SparkSession, database: str, tables: dict[str, str]) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    for name, columns in tables.items():
        spark.sql(f"CREATE TABLE IF NOT EXISTS {database}.{name} ({columns}) USING PARQUET")


def create_catalogue(spark: SparkSession, silver: str = "silver", gold: str = "gold") -> None:
    create_tables(spark, silver, SILVER)
    create_tables(spark, gold, GOLD)
