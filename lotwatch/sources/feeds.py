"""Raw feeds derived from the order-line tables, with the faults that ingestion must catch.

Bad spellings, types and values are set by rules on the row's own keys, so the same rows are
faulty in every run; no row is left out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lotwatch.session import landed, split_bytes
from lotwatch.sources.testdata import table

QC_COLUMNS = ["inspection_id", "batch_id", "supplier_id", "line_id", "inspection_date",
              "inspector_id", "units_inspected", "defect_count", "defect_type", "pass_fail"]


def qc_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Inspection log as text; l_returnflag names the file the row arrives in."""
    return table(spark, sf_dir, "lineitem").selectExpr(
        "concat_ws('-', 'I', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS inspection_id",
        "concat_ws('-', 'B', l_orderkey) AS batch_id", "concat('S', l_suppkey) AS supplier_id",
        "concat('L', l_linenumber) AS line_id", "date_format(l_shipdate, 'yyyy-MM-dd') AS inspection_date",
        "concat('Q', l_linenumber) AS inspector_id",
        """CASE (l_orderkey + l_partkey) % 50 WHEN 0 THEN 'abc' WHEN 1 THEN '' WHEN 2 THEN ' 12 '
           WHEN 3 THEN '12.7' ELSE CAST(CAST(l_quantity AS BIGINT) AS STRING) END AS units_inspected""",
        """CASE WHEN l_partkey % 60 = 0 THEN 'n/a' WHEN l_partkey % 60 = 1 THEN '-1'
           ELSE CAST(CAST(floor(l_quantity * l_discount) AS BIGINT) AS STRING) END AS defect_count""",
        "CASE WHEN l_linestatus = 'F' THEN 'minor_thread' ELSE 'none' END AS defect_type",
        """CASE WHEN l_partkey % 40 = 7 THEN 'UNKNOWN' WHEN l_returnflag = 'R' THEN 'FAIL'
           WHEN l_returnflag = 'A' THEN 'REVIEW' ELSE 'PASS' END AS pass_fail""",
        "l_returnflag AS flag",
    )


QC_SQL = """
SELECT 'I-' || l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey AS inspection_id,
       'B-' || l_orderkey AS batch_id, 'S' || l_suppkey AS supplier_id, 'L' || l_linenumber AS line_id,
       strftime(l_shipdate, '%Y-%m-%d') AS inspection_date, 'Q' || l_linenumber AS inspector_id,
       CASE (l_orderkey + l_partkey) % 50 WHEN 0 THEN 'abc' WHEN 1 THEN NULL WHEN 2 THEN ' 12 '
            WHEN 3 THEN '12.7' ELSE CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) END AS units_inspected,
       CASE WHEN l_partkey % 60 = 0 THEN 'n/a' WHEN l_partkey % 60 = 1 THEN '-1'
            ELSE CAST(CAST(floor(l_quantity * l_discount) AS BIGINT) AS VARCHAR) END AS defect_count,
       CASE WHEN l_linestatus = 'F' THEN 'minor_thread' ELSE 'none' END AS defect_type,
       CASE WHEN l_partkey % 40 = 7 THEN 'UNKNOWN' WHEN l_returnflag = 'R' THEN 'FAIL'
            WHEN l_returnflag = 'A' THEN 'REVIEW' ELSE 'PASS' END AS pass_fail, l_returnflag AS flag
FROM lineitem"""

# Typed inspection rows: nulls where the text is no number, decimals cut toward zero.
QC_TYPED_SQL = """
SELECT * EXCLUDE (units_inspected, defect_count), units_inspected AS raw_units, defect_count AS raw_defects,
       CAST(trunc(TRY_CAST(trim(units_inspected) AS DOUBLE)) AS BIGINT) AS units_inspected,
       CAST(trunc(TRY_CAST(trim(defect_count) AS DOUBLE)) AS BIGINT) AS defect_count
FROM qc"""


def qc_folder(spark: SparkSession, sf_dir: str) -> str:
    def write(path: str) -> None:
        (qc_rows(spark, sf_dir).write.option("header", True)
         .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
         .partitionBy("flag").csv(path))

    return landed(spark, sf_dir, "qc_inspection_logs", write)


def _date_files(spark: SparkSession, folder: str, seconds: int) -> None:
    """Set the times of a folder's files, so that the order of deliveries doesn't hang on the clock."""
    jvm = spark._jvm
    place = jvm.org.apache.hadoop.fs.Path(folder)
    fs = place.getFileSystem(spark._jsc.hadoopConfiguration())
    files = fs.listFiles(place, True)
    while files.hasNext():
        fs.setTimes(files.next().getPath(), (1_704_067_200 + seconds) * 1000, -1)


def qc_again(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Inspections of every fifth batch once more, one unit higher where the units are a number."""
    units = F.col("units_inspected")
    higher = F.when(units.rlike("^[0-9]+$"), (units.try_cast("bigint") + 1).cast("string")).otherwise(units)
    return qc_rows(spark, sf_dir).filter(F.substring("batch_id", 3, 20).cast("bigint") % 5 == 0).withColumn(
        "units_inspected", higher)


def redelivered_folder(spark: SparkSession, sf_dir: str) -> str:
    """Two drops, ``first`` with all inspections and ``second`` with those of every fifth batch
    again. Files are dated by drop and flag."""
    def write(path: str) -> None:
        for i, (name, rows) in enumerate((("first", qc_rows(spark, sf_dir)), ("second", qc_again(spark, sf_dir)))):
            # Large splits, since each of them is a file that a stream takes in a trigger.
            with split_bytes(spark, 128 << 20):
                rows.write.option("header", True).option("ignoreLeadingWhiteSpace", False).option(
                    "ignoreTrailingWhiteSpace", False).partitionBy("flag").csv(f"{path}/{name}")
            for j, flag in enumerate("ANR"):
                _date_files(spark, f"{path}/{name}/flag={flag}", 10 * i + j)

    return landed(spark, sf_dir, "qc_redelivered", write)


#: Rows of both drops, typed; part ``qc`` holds the rows of the first.
REDELIVERED_SQL = """
SELECT * EXCLUDE (units_inspected, defect_count), CAST(trunc(TRY_CAST(trim(units_inspected) AS DOUBLE)) AS BIGINT) AS units_inspected,
       CAST(trunc(TRY_CAST(trim(defect_count) AS DOUBLE)) AS BIGINT) AS defect_count
FROM (SELECT *, 1 AS delivery FROM qc UNION ALL
  SELECT * REPLACE (CASE WHEN regexp_matches(units_inspected, '^[0-9]+$') THEN CAST(CAST(units_inspected AS BIGINT) + 1 AS VARCHAR)
    ELSE units_inspected END AS units_inspected), 2 AS delivery FROM qc WHERE CAST(batch_id[3:] AS BIGINT) % 5 = 0)"""


def mixed_folder(spark: SparkSession, sf_dir: str) -> str:
    """One landing drop under three headers: full, in another order, and without a required
    column; by return flag A, N and R."""
    moved = [c for c in QC_COLUMNS if c not in ("units_inspected", "defect_count")]
    variants = {"A": list(QC_COLUMNS), "N": ["defect_count", "units_inspected", *moved[::-1]],
                "R": [c for c in QC_COLUMNS if c != "pass_fail"]}

    def write(path: str) -> None:
        for flag, columns in variants.items():
            qc_rows(spark, sf_dir).filter(F.col("flag") == flag).select(*columns).write.option("header", True).option(
                "ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(f"{path}/{flag}")

    return landed(spark, sf_dir, "qc_mixed", write)


def customer_arrays(spark: SparkSession, sf_dir: str) -> str:
    """Customers as files that hold one JSON array each, ten thousand keys to a file."""
    def write(path: str) -> None:
        rows = table(spark, sf_dir, "customer")
        record = F.struct("c_custkey", "c_name", "c_acctbal", "c_mktsegment")
        rows.groupBy(F.floor(F.col("c_custkey") / 10_000).alias("chunk")).agg(
            F.to_json(F.collect_list(record)).alias("value")
        ).write.partitionBy("chunk").text(path)

    return landed(spark, sf_dir, "customers", write)


def raw_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batches of a supplier, line and year; later years carry SKUs outside the known set."""
    return table(spark, sf_dir, "lineitem").groupBy(
        "l_suppkey", "l_linenumber", F.year("l_shipdate").alias("y")
    ).agg(F.sum(F.col("l_quantity").cast("bigint")).alias("unit_count")).selectExpr(
        "concat_ws('-', 'B', l_suppkey, l_linenumber, y) AS batch_id",
        "concat('S', l_suppkey) AS supplier_id", "concat('L', l_linenumber) AS line_id",
        "concat('SKU-', y - 1994) AS sku", "unit_count")


RAW_BATCHES_SQL = """
SELECT 'B-' || l_suppkey || '-' || l_linenumber || '-' || year(l_shipdate) AS batch_id, 'S' || l_suppkey AS supplier_id,
       'L' || l_linenumber AS line_id, 'SKU-' || (year(l_shipdate) - 1994) AS sku,
       sum(CAST(l_quantity AS BIGINT)) AS unit_count
FROM lineitem GROUP BY l_suppkey, l_linenumber, year(l_shipdate)"""


def raw_inspections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Inspection feed with repeated keys in mixed spelling and per-type defect counts."""
    return table(spark, sf_dir, "lineitem").selectExpr(
        """CASE WHEN l_partkey % 2 = 0 THEN concat('i-', l_orderkey, '-', l_linenumber)
           ELSE concat(' I-', l_orderkey, '-', l_linenumber, ' ') END AS inspection_id""",
        "concat('b-', l_orderkey) AS batch_id", "concat('s', l_suppkey) AS supplier_id",
        "concat('l', l_linenumber) AS line_id", "date_format(l_shipdate, 'yyyy-MM-dd') AS inspection_date",
        "CAST(CAST(l_quantity AS BIGINT) - 1 AS STRING) AS units_inspected",
        "CAST(CAST(floor(l_quantity * l_discount) AS BIGINT) AS STRING) AS total_defects",
        "CAST(l_partkey % 3 AS STRING) AS stitching_defects",
        "CAST(l_suppkey % 3 AS STRING) AS colorfastness_defects",
        "CAST(l_orderkey % 4 AS STRING) AS sizing_defects",
        "CAST(l_linenumber % 4 AS STRING) AS material_defects",
        "CAST((l_partkey + l_suppkey) % 5 AS STRING) AS print_defects",
        "concat(' ', l_returnflag) AS qc_result",
        "date_format(l_shipdate, 'yyyy-MM-dd 00:00:00') AS ingested_at",
        "CASE WHEN l_tax = 0.08 THEN 'INVALID' ELSE 'VALID' END AS _ingest_status",
    )


RAW_INSPECTIONS_SQL = """
SELECT upper('I-' || l_orderkey || '-' || l_linenumber) AS inspection_id, 'B-' || l_orderkey AS batch_id,
       'S' || l_suppkey AS supplier_id, 'L' || l_linenumber AS line_id, strftime(l_shipdate, '%Y-%m-%d') AS inspection_date,
       CAST(CAST(l_quantity AS BIGINT) - 1 AS VARCHAR) AS units_inspected,
       CAST(CAST(floor(l_quantity * l_discount) AS BIGINT) AS VARCHAR) AS total_defects,
       CAST(l_partkey % 3 AS VARCHAR) AS stitching_defects, CAST(l_suppkey % 3 AS VARCHAR) AS colorfastness_defects,
       CAST(l_orderkey % 4 AS VARCHAR) AS sizing_defects, CAST(l_linenumber % 4 AS VARCHAR) AS material_defects,
       CAST((l_partkey + l_suppkey) % 5 AS VARCHAR) AS print_defects, ' ' || l_returnflag AS qc_result,
       CAST(l_shipdate AS TIMESTAMP) AS ingested_at, l_tax
FROM lineitem WHERE l_tax <> 0.08"""


def raw_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Return feed: ordered on the order date, returned on the ship date."""
    lines, orders = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).selectExpr(
        "concat(' r-', l_orderkey, '-', l_linenumber) AS return_id",
        "concat('b-', l_orderkey) AS batch_id", "concat('s', l_suppkey) AS supplier_id",
        "concat('SKU-', l_partkey, ' ') AS sku", "date_format(o_orderdate, 'yyyy-MM-dd') AS sale_date",
        "date_format(l_shipdate, 'yyyy-MM-dd') AS return_date",
        "CAST(CAST(l_quantity AS BIGINT) - 1 AS STRING) AS units_sold",
        "CAST(CAST(floor(l_quantity * l_discount) AS BIGINT) AS STRING) AS units_returned",
        "l_returnflag AS return_reason",
        "CAST(l_extendedprice AS STRING) AS unit_price_usd",
        "o_orderpriority AS channel", "date_format(l_shipdate, 'yyyy-MM-dd 00:00:00') AS ingested_at",
        "CASE WHEN l_tax = 0.08 THEN 'INVALID' ELSE 'VALID' END AS _ingest_status",
    )


RAW_SALES_SQL = """
SELECT 'R-' || l_orderkey || '-' || l_linenumber AS return_id, 'B-' || l_orderkey AS batch_id, 'S' || l_suppkey AS supplier_id,
       'SKU-' || l_partkey || ' ' AS sku, strftime(o_orderdate, '%Y-%m-%d') AS sale_date, strftime(l_shipdate, '%Y-%m-%d') AS return_date,
       CAST(CAST(l_quantity AS BIGINT) - 1 AS VARCHAR) AS units_sold,
       CAST(CAST(floor(l_quantity * l_discount) AS BIGINT) AS VARCHAR) AS units_returned, l_returnflag AS return_reason,
       l_extendedprice AS unit_price_usd, o_orderpriority AS channel, CAST(l_shipdate AS TIMESTAMP) AS ingested_at
FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_tax <> 0.08"""


def raw_suppliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every supplier delivered twice, first in lower case and then corrected."""
    suppliers = table(spark, sf_dir, "supplier")
    return suppliers.select("*", F.explode(F.array(F.lit(1), F.lit(2))).alias("v")).selectExpr(
        "CASE v WHEN 1 THEN concat('s', s_suppkey) ELSE concat(' S', s_suppkey) END AS supplier_id",
        "concat(s_name, ' ') AS supplier_name", "concat('N', s_nationkey) AS country",
        "concat('R', s_nationkey % 5) AS region", "concat('TIER_', v) AS tier",
        "CAST(s_acctbal / 100000 AS STRING) AS avg_defect_rate",
        "CASE WHEN s_acctbal > 5000 THEN ' Active' WHEN s_acctbal > 0 THEN 'paused' END AS status",
        "concat('2024-01-0', v, ' 00:00:00') AS ingested_at", "'VALID' AS _ingest_status",
    )


def raw_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly history delivered twice in two spellings, the second time one unit higher."""
    return table(spark, sf_dir, "lineitem").groupBy(
        "l_suppkey", "l_linenumber", F.trunc(F.col("l_shipdate").cast("date"), "month").alias("m")
    ).agg(F.sum(F.col("l_quantity").cast("bigint")).alias("u"),
          F.sum(F.floor(F.col("l_quantity") * F.col("l_discount")).cast("bigint")).alias("d")
    ).select("*", F.explode(F.array(F.lit(1), F.lit(2))).alias("v")).selectExpr(
        "CASE v WHEN 1 THEN concat('s', l_suppkey) ELSE concat('S', l_suppkey, ' ') END AS supplier_id",
        "concat('l', l_linenumber) AS line_id", "date_format(m, 'yyyy-MM-dd') AS month",
        "CAST(d / u AS STRING) AS avg_defect_rate", "CAST(u + v AS STRING) AS total_units",
        "CAST(d AS STRING) AS total_defects", "concat('2024-01-0', v, ' 00:00:00') AS ingested_at",
        "'VALID' AS _ingest_status",
    )


#: Files of one drop, which a trigger takes together.
DROP_FILES = 2


def deliver(rows: DataFrame, folder: str, drop: int, key: str) -> None:
    """Write one drop of a stream, dated by its number so that triggers take drops in order."""
    rows.repartition(DROP_FILES, key).write.mode("overwrite").parquet(f"{folder}/drop-{drop}")
    _date_files(rows.sparkSession, f"{folder}/drop-{drop}", 10 * drop)


def event_drops(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """Events in drops of six days. Of the first, every fiftieth comes a drop late, while its week
    is still open, and the one after each of these comes last of all, when its week is closed."""
    events = table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    drop = F.floor((F.dayofmonth("ts") - 1) / 6)
    moved = F.when((drop == 0) & (F.col("event_id") % 50 == 1), 1).when((drop == 0) & (F.col("event_id") % 50 == 2), 6).otherwise(drop)
    return [events.filter(moved == d) for d in range(7)]


ON_TIME_SQL = "SELECT * FROM events WHERE NOT (day(ts) <= 6 AND event_id % 50 = 2)"


def arrival_drops(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """Order lines by line number, two numbers to a drop and a day apart, so a lot's come in several."""
    lines = table(spark, sf_dir, "lineitem").withColumn("arrival", F.floor((F.col("l_linenumber") - 1) / 2).cast("int"))
    at = F.timestamp_seconds(F.lit(1_704_067_200) + F.col("arrival") * 86_400)
    return [lines.filter(F.col("arrival") == d).withColumn("arrived_at", at) for d in range(4)]
