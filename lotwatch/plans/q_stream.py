"""Registered queries: streaming forms, drained with an available-now trigger."""

from __future__ import annotations

from pyspark.sql import functions as F

from lotwatch.operators import detection
from lotwatch.plans.present import present
from lotwatch.plans.q_ingest import AT, DOMAINS, QC
from lotwatch.plans.registry import query
from lotwatch.plans.sqlparts import part, with_parts
from lotwatch.plans.stages import RunParams
from lotwatch.session import scratch_path
from lotwatch.sources import feeds, tables
from lotwatch.sources import testdata as D
from lotwatch.streaming import live


@query("stream_ingest", with_parts("perkey", """
SELECT 'bad_records' AS table_name, count(reason) AS row_count, NULL::BIGINT AS units FROM ruled
UNION ALL SELECT 'fact_qc_inspections', count(*), CAST(sum(units_inspected) AS BIGINT) FROM perkey
  WHERE delivery = 2 OR inspection_id NOT IN (SELECT inspection_id FROM perkey WHERE delivery = 2)
UNION ALL SELECT 'logged', count(*), NULL FROM ruled"""))
def stream_ingest(spark, sf):
    """Files in the order of their age, a few to a trigger; keys of the second drop replace
    those that earlier triggers stored."""
    folder = scratch_path(spark, "stream-ingest")
    # The second pass finds no new file and must add nothing.
    for _ in range(2):
        rows = live.landing_stream(spark, f"{feeds.redelivered_folder(spark, sf)}/*/flag=*", files_per_trigger=2)
        live.ingest(rows, QC, folder, D.RUN_ID, AT, RunParams(domains=DOMAINS)).awaitTermination()
    total = lambda df, name, n, units=None: df.agg(
        F.lit(name).alias("table_name"), n.alias("row_count"), F.sum(F.lit(None).cast("bigint") if units is None else units).alias("units"))
    one = F.count(F.lit(1))
    logged = F.sum(F.col("rows_written") + F.col("rows_quarantined"))
    return total(tables.read_table(spark, f"{folder}/{QC.table}"), QC.table, one, F.col("units_inspected")).union(
        total(spark.read.parquet(f"{folder}/bad_records"), "bad_records", one)).union(
        total(spark.read.parquet(f"{folder}/ingest_log"), "logged", logged))


def _drained(spark, drops, key, build, name):
    """Run a stream over its first drops, and after a restart over the rest."""
    root = scratch_path(spark, name)
    schema, half = drops[0].schema, len(drops) // 2
    for part in (range(half), range(half, len(drops))):
        for d in part:
            feeds.deliver(drops[d], f"{root}/in", d, key)
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", feeds.DROP_FILES).parquet(f"{root}/in/*")
        out = live.run_to_table(build(stream), f"{root}/out")
    return out


def _events(stream):
    return stream.select(
        "event_id", "event_type", "ts", F.concat(F.lit("S"), F.col("user_id").cast("string")).alias("supplier_id"),
        F.when(F.col("event_type") == "error", 1).otherwise(0).alias("defect_count"),
        F.lit(1).alias("units_inspected"))


part("intime", "", feeds.ON_TIME_SQL)


@query("stream_dedup", "SELECT DISTINCT 'S' || user_id AS supplier_id, event_type FROM events")
def stream_dedup(spark, sf):
    """Keys repeat over triggers and over a restart; the state tells them."""
    build = lambda s: live.deduplicated(_events(s), ["supplier_id", "event_type"], "ts", "60 days").select(
        "supplier_id", "event_type")
    return _drained(spark, feeds.event_drops(spark, sf), "event_id", build, "stream-dedup")


@query("stream_weekly_trend", with_parts("intime", """
SELECT 'S' || user_id AS supplier_id, CAST(CAST(date_trunc('week', ts) AS DATE) AS VARCHAR) AS production_week,
       round(avg(CASE WHEN event_type = 'error' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END), 6) AS weekly_defect_rate, count(*) AS inspections,
       count(*) AS total_units_inspected, count(*) FILTER (event_type = 'error') AS total_defects,
       avg(CASE WHEN event_type = 'error' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) >= 0.038 AS above_threshold
FROM intime WHERE CAST(date_trunc('week', ts) AS TIMESTAMP) + INTERVAL 7 DAY <= (SELECT max(ts) FROM events) - INTERVAL 1 DAY GROUP BY 1, 2"""))
def stream_weekly_trend(spark, sf):
    """Rows one drop late count, those that come after their week has closed don't."""
    build = lambda s: live.weekly_trend(_events(s), "ts", "1 day", D.PARAMS.rate_threshold)
    return present(_drained(spark, feeds.event_drops(spark, sf), "event_id", build, "stream-weekly"))


@query("stream_arrival_alerts", with_parts("insp base risk", """
SELECT inspection_id, round(z, 4) AS z, round(lot_rate, 6) AS lot_rate,
  CASE WHEN z IS NULL THEN 'UNRESOLVED' WHEN z >= 2.5 * CASE WHEN risk_tier = 'HIGH' THEN 0.85 ELSE 1 END THEN 'FLAGGED'
  WHEN z >= 1.8 AND lot_rate >= mean_rate + 1.8 * std_rate THEN 'FLAGGED' WHEN z >= 1.8 THEN 'REVIEW' ELSE 'NORMAL' END AS alert_status
FROM (SELECT *, CASE WHEN std_rate = 0 THEN 0.0::DOUBLE ELSE (r - mean_rate) / std_rate END AS z FROM (
  SELECT inspection_id, supplier_id, line_id, r, avg(r) OVER (PARTITION BY material_lot
    ORDER BY (CAST(line_id[2:] AS INT) - 1) // 2, inspection_date, inspection_id, units_inspected, defect_count
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS lot_rate
  FROM (SELECT *, defect_count::DOUBLE / units_inspected AS r FROM insp))
  LEFT JOIN base USING (supplier_id, line_id) LEFT JOIN risk USING (supplier_id))"""))
def stream_arrival_alerts(spark, sf):
    """A borderline arrival is decided by its lot's arrivals so far, over triggers and a restart."""
    baseline, risk = detection.baselines(D.history(spark, sf)), D.risk_scores(spark, sf)

    def build(stream):
        arrivals = D.as_inspections(stream, [F.col("arrived_at")]).withColumn(
            "observed_defect_rate", F.col("defect_count") / F.col("units_inspected"))
        arrivals = arrivals.select("inspection_id", "supplier_id", "line_id", "material_lot", "inspection_date", "units_inspected",
                                   "defect_count", "arrived_at", "observed_defect_rate")
        rows = live.with_lot_rates(arrivals, "arrived_at", "1 day", 30,
                                   order=("inspection_date", "inspection_id", "units_inspected", "defect_count"))
        return live.arrival_alerts(rows, baseline, risk, D.PARAMS).select(
            "inspection_id", F.round("z", 4).alias("z"), F.round("lot_rate", 6).alias("lot_rate"), "alert_status")

    return _drained(spark, feeds.arrival_drops(spark, sf), "l_orderkey", build, "stream-alerts")
