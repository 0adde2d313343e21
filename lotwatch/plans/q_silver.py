"""Registered queries: silver tables and scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from lotwatch.functions import scalars as S
from lotwatch.operators import silver
from lotwatch.plans.present import present
from lotwatch.plans.registry import query
from lotwatch.plans.sqlparts import part, with_parts
from lotwatch.session import scratch_path
from lotwatch.sources import feeds, tables
from lotwatch.sources import testdata as D

#: Buckets of the stored tables below; a production table takes about 128 MB to a bucket.
BUCKETS = 16

part("rawi", "", feeds.RAW_INSPECTIONS_SQL)
part("raws", "", feeds.RAW_SALES_SQL)
part("newi", "rawi", """
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY inspection_id ORDER BY ingested_at DESC, batch_id DESC,
  colorfastness_defects DESC, inspection_date DESC, line_id DESC, material_defects DESC, print_defects DESC, qc_result DESC,
  sizing_defects DESC, stitching_defects DESC, supplier_id DESC, total_defects DESC, units_inspected DESC) AS n FROM rawi) WHERE n = 1""")
part("news", "raws", """
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY return_id ORDER BY ingested_at DESC, batch_id DESC, channel DESC,
  return_date DESC, return_reason DESC, sale_date DESC, sku DESC, supplier_id DESC, unit_price_usd DESC,
  units_returned DESC, units_sold DESC) AS n FROM raws) WHERE n = 1""")
part("dom", "", """
SELECT inspection_id, units_inspected, greatest(a, b, c, d, e) AS top, a, b, c, d, e, u, t FROM (SELECT *,
  CAST(stitching_defects AS BIGINT) AS a, CAST(colorfastness_defects AS BIGINT) AS b, CAST(sizing_defects AS BIGINT) AS c,
  CAST(material_defects AS BIGINT) AS d, CAST(print_defects AS BIGINT) AS e, CAST(units_inspected AS BIGINT) AS u,
  CAST(total_defects AS BIGINT) AS t FROM newi) WHERE u > 0""")


@query("fact_qc_inspections", with_parts("newi dom", """
SELECT inspection_id, u AS units_inspected, t AS total_defects, round(t::DOUBLE / u, 6) AS defect_rate,
       CASE top WHEN a THEN 'stitching' WHEN b THEN 'colorfastness' WHEN c THEN 'sizing' WHEN d THEN 'material' ELSE 'print' END AS dominant_defect_type
FROM dom"""))
def fact_qc_inspections(spark, sf):
    return present(silver.fact_qc_inspections(feeds.raw_inspections(spark, sf)), "inspection_id",
                   "units_inspected", "total_defects", "defect_rate", "dominant_defect_type")


@query("latest_inspection", with_parts("newi", """
SELECT inspection_id, batch_id, supplier_id, line_id, inspection_date, trim(qc_result) AS qc_result, strftime(ingested_at, '%Y-%m-%d %H:%M:%S') AS ingested_at
FROM newi WHERE CAST(units_inspected AS BIGINT) > 0"""))
def latest_inspection(spark, sf):
    return present(silver.fact_qc_inspections(feeds.raw_inspections(spark, sf)), "inspection_id",
                   "batch_id", "supplier_id", "line_id", "inspection_date", "qc_result", "ingested_at")


@query("latest_from_buckets", with_parts("newi", """
SELECT inspection_id, batch_id, supplier_id, line_id, trim(qc_result) AS qc_result, strftime(ingested_at, '%Y-%m-%d %H:%M:%S') AS ingested_at FROM newi"""))
def latest_from_buckets(spark, sf):
    """Latest row per key of a table stored in buckets of the key: no shuffle on reading."""
    tidy = silver.normalised(silver.valid_rows(feeds.raw_inspections(spark, sf)), ["inspection_id"], ["batch_id", "supplier_id", "line_id"])
    table = tables.write_bucketed(tidy, scratch_path(spark, "bucketed-inspections"), ["inspection_id"],
                                  tables.bucket_count(tidy, BUCKETS))
    rows = silver.newest_of(table, ["inspection_id"])
    return present(rows.select("inspection_id", "batch_id", "supplier_id", "line_id", F.trim("qc_result").alias("qc_result"),
                               F.col("ingested_at").try_cast("timestamp").alias("ingested_at")))


@query("fact_sales_returns", with_parts("news", """
SELECT return_id, trim(sku) AS sku, date_diff('day', CAST(sale_date AS DATE), CAST(return_date AS DATE)) AS days_to_return,
       CAST(units_sold AS BIGINT) AS units_sold, CAST(units_returned AS BIGINT) AS units_returned,
       round(CAST(units_returned AS DOUBLE) / CAST(units_sold AS BIGINT), 6) AS return_rate,
       round(CAST(units_returned AS DOUBLE) * CAST(unit_price_usd AS DOUBLE), 2) AS gross_return_cost_usd, channel
FROM news WHERE CAST(units_sold AS BIGINT) > 0"""))
def fact_sales_returns(spark, sf):
    return present(silver.fact_sales_returns(feeds.raw_sales(spark, sf)), "return_id", "sku",
                   "days_to_return", "units_sold", "units_returned", "return_rate",
                   "gross_return_cost_usd", "channel")


@query("dim_supplier", """
SELECT 'S' || s_suppkey AS supplier_id, s_name AS supplier_name, 'N' || s_nationkey AS country, 'R' || (s_nationkey % 5) AS region,
       'TIER_2' AS tier, round(s_acctbal / 100000, 8) AS avg_defect_rate, s_acctbal > 5000 AS is_active FROM supplier""")
def dim_supplier(spark, sf):
    return present(silver.dim_supplier(feeds.raw_suppliers(spark, sf)).drop("ingested_at"), digits=8)


@query("dim_batch", """
SELECT batch_id, supplier_id, line_id, sku, production_date, unit_count, lot_id FROM (
  SELECT 'B-' || l_orderkey || '-' || l_linenumber AS batch_id, 'S' || l_suppkey AS supplier_id, 'L' || l_linenumber AS line_id,
         'SKU-' || l_partkey AS sku, CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS production_date, CAST(l_quantity AS BIGINT) AS unit_count,
         'LOT-' || l_suppkey AS lot_id, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC,
         'LOT-' || l_suppkey DESC, 'SKU-' || l_partkey DESC, l_suppkey DESC, CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) DESC) AS n
  FROM lineitem WHERE l_tax <> 0.08) WHERE n = 1""")
def dim_batch(spark, sf):
    raw = D.table(spark, sf, "lineitem").selectExpr(
        "CASE WHEN l_partkey % 2 = 0 THEN concat('b-', l_orderkey, '-', l_linenumber) ELSE concat('B-', l_orderkey, '-', l_linenumber, ' ') END AS batch_id",
        "concat('s', l_suppkey) AS supplier_id", "concat('l', l_linenumber) AS line_id",
        "concat('SKU-', l_partkey) AS sku", "date_format(l_shipdate, 'yyyy-MM-dd') AS production_date",
        "CAST(CAST(l_quantity AS BIGINT) AS STRING) AS unit_count", "concat('LOT-', l_suppkey) AS lot_id",
        "date_format(l_shipdate, 'yyyy-MM-dd 00:00:00') AS ingested_at",
        "CASE WHEN l_tax = 0.08 THEN 'INVALID' ELSE 'VALID' END AS _ingest_status")
    return present(silver.dim_batch(raw).drop("ingested_at"))


@query("supplier_defect_history", """
SELECT supplier_id, line_id, CAST(month AS VARCHAR) AS month, u + 2 AS total_units, d AS total_defects,
       round(avg(r) OVER (PARTITION BY supplier_id, line_id ORDER BY month ROWS BETWEEN 2 PRECEDING AND CURRENT ROW), 6) AS trailing_3m_avg_rate
FROM (SELECT 'S' || l_suppkey AS supplier_id, 'L' || l_linenumber AS line_id, CAST(date_trunc('month', l_shipdate) AS DATE) AS month,
             CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS u, CAST(sum(CAST(floor(l_quantity * l_discount) AS BIGINT)) AS BIGINT) AS d,
             CAST(sum(CAST(floor(l_quantity * l_discount) AS BIGINT)) AS DOUBLE) / sum(CAST(l_quantity AS BIGINT)) AS r
      FROM lineitem GROUP BY 1, 2, 3)""")
def supplier_defect_history(spark, sf):
    rows = silver.supplier_defect_history(feeds.raw_history(spark, sf))
    return present(rows, "supplier_id", "line_id", "month", "total_units", "total_defects", "trailing_3m_avg_rate")


@query("risk_scores", with_parts("risk", """
SELECT supplier_id, composite_risk_score, risk_tier, would_trigger_audit FROM risk"""))
def risk_scores(spark, sf):
    typed = silver.supplier_risk_scores(
        D.risk_scores(spark, sf).select(*[F.col(c).cast("string").alias(c) for c in D.risk_scores(spark, sf).columns]),
        D.RISK.dimensions)
    return typed.select("supplier_id", "composite_risk_score", "risk_tier", "would_trigger_audit")


@query("material_lots", with_parts("lotmeta", """
SELECT lot_id, supplier_id, material_type, strftime(entered_production_date, '%Y-%m-%d %H:%M:%S') AS entered_production_date,
       is_defective, hours_to_first_alert FROM lotmeta"""))
def material_lots(spark, sf):
    meta = D.lot_meta(spark, sf).withColumns({"batch_count": F.lit("1"), "total_units": F.lit("1")})
    typed = silver.material_lots(meta.select(*[F.col(c).cast("string").alias(c) for c in meta.columns]))
    return present(typed, "lot_id", "supplier_id", "material_type", "entered_production_date",
                   "is_defective", "hours_to_first_alert")


@query("month_and_week_keys", """
SELECT o_orderkey, strftime(o_orderdate, '%Y-%m') AS month, CAST(CAST(date_trunc('week', o_orderdate) AS DATE) AS VARCHAR) || '/' ||
       CAST(CAST(date_trunc('week', o_orderdate) AS DATE) + 6 AS VARCHAR) AS week FROM orders""")
def month_and_week_keys(spark, sf):
    day = F.col("o_orderdate").cast("date")
    return D.table(spark, sf, "orders").select(
        "o_orderkey", S.month_key(day).alias("month"), S.week_label(S.week_start(day)).alias("week"))


@query("confidence_tiers", """
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_discount * 10 AS confidence,
       CASE WHEN l_discount * 10 >= 0.70 THEN 'HIGH' WHEN l_discount * 10 >= 0.50 THEN 'MEDIUM' ELSE 'LOW' END AS tier,
       CASE WHEN l_discount * 10 >= 0.75 THEN 'HIGH' WHEN l_discount * 10 >= 0.60 THEN 'MEDIUM' ELSE 'LOW' END AS strict_tier FROM lineitem""")
def confidence_tiers(spark, sf):
    c = F.col("l_discount") * F.lit(10)
    return D.table(spark, sf, "lineitem").select(
        "l_orderkey", F.col("l_linenumber").cast("bigint").alias("l_linenumber"), c.alias("confidence"),
        S.confidence_tier(c).alias("tier"), S.confidence_tier(c, 0.75, 0.60).alias("strict_tier"))


@query("escalation_urgency", """
SELECT event_id, CASE WHEN event_type = 'error' AND value / 100 < 0.5 THEN 'HIGH' WHEN event_type IN ('click', 'view') THEN 'MEDIUM' ELSE 'LOW' END AS urgency,
       CASE WHEN event_type <> 'signup' THEN round(date_diff('second', date_trunc('second', ts), TIMESTAMP '2024-02-01 00:00:00') / 3600.0::DOUBLE, 1) END AS open_hours,
       round(date_diff('second', date_trunc('second', ts), TIMESTAMP '2024-02-01 00:00:00') / 60.0::DOUBLE, 2) AS duration_minutes FROM events""")
def escalation_urgency(spark, sf):
    kind = F.col("event_type")
    agent = F.when(kind == "error", "A-03").when(kind == "click", "A-01").when(kind == "view", "A-02").otherwise("A-05")
    context = F.to_json(F.struct((F.col("value") / 100).alias("confidence")))
    as_of = F.lit("2024-02-01 00:00:00").cast("timestamp")
    return D.table(spark, sf, "events").select(
        "event_id", S.urgency(agent, context).alias("urgency"),
        S.open_hours(kind == "signup", "ts", as_of).alias("open_hours"),
        S.duration_minutes(F.col("ts"), as_of).alias("duration_minutes"))


@query("display_formats", """
SELECT l_orderkey, l_partkey, CAST(round(CAST(l_extendedprice AS DECIMAL(18, 2)), 1) AS DOUBLE) AS price,
       format('{:,}', CAST(floor(l_extendedprice) AS BIGINT)) AS price_text, substr(l_returnflag || l_linestatus || l_orderkey, 1, 3) AS code FROM lineitem""")
def display_formats(spark, sf):
    return D.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_partkey", F.round("l_extendedprice", 1).alias("price"),
        F.format_number(F.floor("l_extendedprice"), 0).alias("price_text"),
        F.substring(F.concat("l_returnflag", "l_linestatus", F.col("l_orderkey").cast("string")), 1, 3).alias("code"))


@query("distinct_in_order", """
WITH x AS (SELECT o_orderkey, o_orderstatus || ',' || substr(o_orderpriority, 3) || ',' || o_orderstatus AS raw, o_orderstatus AS a, substr(o_orderpriority, 3) AS b FROM orders)
SELECT o_orderkey, CASE WHEN a = b THEN a ELSE a || ',' || b END AS items FROM x""")
def distinct_in_order(spark, sf):
    a, b = F.col("o_orderstatus"), F.expr("substring(o_orderpriority, 3)")
    return D.table(spark, sf, "orders").select(
        "o_orderkey", F.array_join(F.array_distinct(F.array(a, b, a)), ",").alias("items"))
