"""Registered queries: scenarios, cost curves, sales and operations reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from lotwatch.operators import briefing, lookups, reports, scenarios
from lotwatch.params import (
    RETURN_RATE_VARIANTS,
    ROI_STAGE_COSTS,
    ROI_STAGES,
    ScenarioParams,
    SummaryParams,
)
from lotwatch.plans.present import present
from lotwatch.plans.registry import query
from lotwatch.plans.sqlparts import part, with_parts
from lotwatch.schemas import registered
from lotwatch.session import scratch_path, stored
from lotwatch.sources import export, tables
from lotwatch.sources import testdata as D

PARAMS = ScenarioParams()
SUMMARY = SummaryParams()
ROI_SCENARIOS = ("detect_early", "detect_late", "do_nothing")

part("scope", "alerts", """
SELECT strftime(production_date, '%Y') AS run_id, count(DISTINCT batch_id) AS flagged_batches,
       CAST(sum(units_flagged) AS BIGINT) AS total_units_flagged, avg(anomaly_score) AS avg_anomaly_score,
       avg(observed_defect_rate) AS avg_defect_rate, count(DISTINCT supplier_id) AS affected_suppliers
FROM alerts WHERE alert_status = 'FLAGGED' GROUP BY 1""")
part("params", "", """
SELECT * FROM (VALUES ('do_nothing', 1.0::DOUBLE, 0.0::DOUBLE, 0.0::DOUBLE, 3.0::DOUBLE, 90.5::DOUBLE, 17.0::DOUBLE),
 ('partial_remediation', 0.4, 8.5, 85000, 0.5, 44.7, 9.0), ('full_recall', 0.0, 22.0, 220000, 0.2, 74.5, 15.0))
 AS t(scenario_name, mult, per_unit, fixed, brand, t_mean, t_std)""")
part("draws", "scope sales params", """
SELECT s.run_id, p.*, s.total_units_flagged AS units, r.return_rate, v.variant,
       s.total_units_flagged::DOUBLE * p.per_unit + s.total_units_flagged::DOUBLE * (r.return_rate * v.variant) * p.mult * 85.0 * p.brand + p.fixed AS cost
FROM scope s JOIN sales r ON strftime(r.date, '%Y') = s.run_id CROSS JOIN params p
CROSS JOIN (VALUES (0.70::DOUBLE), (0.85), (1.00), (1.15), (1.30)) AS v(variant)""")
part("proj", "draws", """
SELECT *, min({'c': mean_total_cost_usd, 'n': scenario_name}) OVER (PARTITION BY run_id, return_rate_assumption).n = scenario_name AS is_recommended
FROM (SELECT run_id, variant AS return_rate_assumption, scenario_name, any_value(units) AS total_units_in_scope, count(*) AS n_samples,
             round(avg(cost), 2) AS mean_total_cost_usd, round(quantile_cont(cost, 0.1), 2) AS p10_total_cost_usd,
             round(quantile_cont(cost, 0.5), 2) AS p50_total_cost_usd, round(quantile_cont(cost, 0.9), 2) AS p90_total_cost_usd,
             any_value(t_mean) AS mean_timeline_days,
             round(greatest(any_value(t_mean) - 1.2815515655446004 * any_value(t_std), 14), 1) AS p10_timeline_days,
             round(greatest(any_value(t_mean) + 1.2815515655446004 * any_value(t_std), 14), 1) AS p90_timeline_days,
             round(any_value(units) * avg(return_rate) * variant * any_value(mult), 0) AS mean_returns_volume
      FROM draws GROUP BY 1, 2, 3)""")
part("flagged_proj", "proj", """
SELECT *, CASE WHEN bool_or(NOT is_recommended AND p10_total_cost_usd <= rec_high AND p90_total_cost_usd >= rec_low)
                    OVER (PARTITION BY run_id, return_rate_assumption) THEN 'LOW_CONFIDENCE' ELSE 'OK' END AS confidence_flag
FROM (SELECT *, max(CASE WHEN is_recommended THEN p90_total_cost_usd END) OVER w AS rec_high,
             max(CASE WHEN is_recommended THEN p10_total_cost_usd END) OVER w AS rec_low
      FROM proj WINDOW w AS (PARTITION BY run_id, return_rate_assumption))""")


def _yearly(df, date="production_date"):
    return df.withColumn("run_id", F.date_format(date, "yyyy"))


def _scope(spark, sf):
    return briefing.defect_scope(_yearly(D.alerts(spark, sf)), ["run_id"])


def _profile(spark, sf):
    rates = scenarios.rate_profile(_yearly(D.sales_returns(spark, sf), "date"), ["run_id"])
    return _scope(spark, sf).select(
        "run_id", F.col("total_units_flagged").alias("total_units")).join(rates, "run_id")


def _projections(spark, sf, variants=(1.0,), overrides=None):
    return scenarios.projections(_profile(spark, sf), PARAMS, overrides, variants)


@query("defect_scope", with_parts("scope", """
SELECT run_id, flagged_batches, total_units_flagged, round(avg_anomaly_score, 6) AS avg_anomaly_score,
       round(avg_defect_rate, 8) AS avg_defect_rate, affected_suppliers FROM scope"""))
def defect_scope(spark, sf):
    return present(_scope(spark, sf).withColumns({
        "avg_anomaly_score": F.round("avg_anomaly_score", 6)}), digits=8)


@query("affected_suppliers", with_parts("alerts", """
SELECT supplier_id, count(*) AS flagged_batches, CAST(sum(units_flagged) AS BIGINT) AS units_flagged
FROM alerts WHERE alert_status = 'FLAGGED' GROUP BY 1"""))
def affected_suppliers(spark, sf):
    return present(briefing.affected_suppliers(D.alerts(spark, sf)))


@query("severity_gate", with_parts("scope", """
SELECT run_id, total_units_flagged >= 5000 OR avg_defect_rate >= 0.03 AS should_publish,
       CASE WHEN total_units_flagged >= 5000 THEN 'unit_threshold' WHEN avg_defect_rate >= 0.03 THEN 'rate_threshold' END AS trigger_reason FROM scope"""))
def severity_gate(spark, sf):
    return briefing.with_severity(_scope(spark, sf), SUMMARY).select("run_id", "should_publish", "trigger_reason")


@query("sales_totals", with_parts("sales", """
SELECT CAST(sum(units_sold) AS BIGINT) AS total_sold, CAST(sum(units_returned) AS BIGINT) AS total_returned,
       round(avg(return_rate), 4) AS avg_return_rate, round(sum(revenue_usd), 2) AS total_revenue, round(sum(refund_usd), 2) AS total_refunds
FROM sales WHERE date BETWEEN DATE '1999-01-01' AND DATE '1999-12-31'"""))
def sales_totals(spark, sf):
    return present(reports.sales_totals(D.sales_returns(spark, sf), "1999-01-01", "1999-12-31"))


@query("scenario_projections", with_parts("flagged_proj", """
SELECT run_id, scenario_name, total_units_in_scope, n_samples, mean_total_cost_usd, p10_total_cost_usd, p50_total_cost_usd, p90_total_cost_usd,
       mean_timeline_days, p10_timeline_days, p90_timeline_days, mean_returns_volume, is_recommended, confidence_flag,
       CASE WHEN n_samples >= 10000 THEN 'HIGH' ELSE 'LOW' END AS sample_flag FROM flagged_proj WHERE return_rate_assumption = 1.0"""))
def scenario_projections(spark, sf):
    return present(_projections(spark, sf).drop("return_rate_assumption", "scenario_label"))


@query("return_rate_variants", with_parts("flagged_proj", """
SELECT run_id, return_rate_assumption, scenario_name, mean_total_cost_usd, p10_total_cost_usd, p90_total_cost_usd, is_recommended, confidence_flag FROM flagged_proj"""))
def return_rate_variants(spark, sf):
    return present(_projections(spark, sf, RETURN_RATE_VARIANTS), "run_id", "return_rate_assumption", "scenario_name",
                   "mean_total_cost_usd", "p10_total_cost_usd", "p90_total_cost_usd", "is_recommended", "confidence_flag")


@query("cost_range", with_parts("flagged_proj", """
SELECT run_id, return_rate_assumption, scenario_name, is_recommended, confidence_flag, round(mean_total_cost_usd, 0) AS mean_total_cost_usd,
       round(p10_total_cost_usd, 0) AS p10_total_cost_usd, round(p50_total_cost_usd, 0) AS p50_total_cost_usd,
       round(p90_total_cost_usd, 0) AS p90_total_cost_usd, round(p90_total_cost_usd - p10_total_cost_usd, 0) AS cost_uncertainty_usd FROM flagged_proj"""))
def cost_range(spark, sf):
    return present(scenarios.cost_range(_projections(spark, sf, RETURN_RATE_VARIANTS)))


@query("scenario_overrides", with_parts("scope params", """
SELECT run_id, scenario_name AS name, CASE scenario_name WHEN 'do_nothing' THEN round(avg_defect_rate * 10, 4) ELSE brand END AS brand_factor,
       CASE WHEN scenario_name = 'full_recall' AND flagged_batches > 300 THEN affected_suppliers * 1000.0::DOUBLE ELSE fixed END AS fixed_cost, per_unit AS cost_per_unit
FROM scope CROSS JOIN params"""))
def scenario_overrides(spark, sf):
    scope = _scope(spark, sf)
    brand = scope.select("run_id", F.lit("do_nothing").alias("name"),
                         F.round(F.col("avg_defect_rate") * 10, 4).alias("brand_factor"),
                         F.lit(None).cast("double").alias("fixed_cost"))
    fixed = scope.select("run_id", F.lit("full_recall").alias("name"), F.lit(None).cast("double").alias("brand_factor"),
                         F.when(F.col("flagged_batches") > 300, F.col("affected_suppliers") * 1000.0).alias("fixed_cost"))
    rows = scenarios.scenario_rows(scope.select("run_id"), PARAMS, brand.unionByName(fixed))
    return rows.select("run_id", "name", "brand_factor", "fixed_cost", "cost_per_unit")


@query("scenario_summary", with_parts("flagged_proj", """
SELECT scenario_name, mean_total_cost_usd, is_recommended FROM flagged_proj WHERE return_rate_assumption = 1.0 AND run_id = '1999'"""))
def scenario_summary(spark, sf):
    return lookups.scenario_summary(_projections(spark, sf), "1999").select(
        "scenario_name", "mean_total_cost_usd", "is_recommended")


@query("recommended_scenario", with_parts("flagged_proj", """
SELECT run_id, scenario_name, mean_total_cost_usd FROM flagged_proj WHERE return_rate_assumption = 1.0 AND is_recommended"""))
def recommended_scenario(spark, sf):
    rows = scenarios.recommended_by_flag(_projections(spark, sf), F.col("is_recommended"))
    return rows.select("run_id", "scenario_name", "mean_total_cost_usd")


@query("quantile_summary", """
SELECT l_returnflag, round(avg(l_extendedprice), 4) AS mean, round(quantile_cont(l_extendedprice, 0.1), 4) AS p10,
       round(quantile_cont(l_extendedprice, 0.5), 4) AS p50, round(quantile_cont(l_extendedprice, 0.9), 4) AS p90 FROM lineitem GROUP BY 1""")
def quantile_summary(spark, sf):
    return present(scenarios.quantile_summary(
        D.table(spark, sf, "lineitem"), ["l_returnflag"], "l_extendedprice"), digits=4)


@query("roi_curves", with_parts("curves", """
SELECT run_id, scenario, CAST(stage_sequence AS BIGINT) AS stage_sequence, stage_name, stage_cost_usd, cumulative_cost_usd,
       p10_cumulative_usd, p90_cumulative_usd, savings_vs_reference FROM curves"""))
def roi_curves(spark, sf):
    return present(scenarios.roi_curves(D.stage_costs(spark, sf), PARAMS).drop("created_at"))


@query("roi_pivot", with_parts("curves", """
SELECT run_id, CAST(stage_sequence AS BIGINT) AS stage_sequence, stage_name,
       max(CASE WHEN scenario = 'detect_early' THEN cumulative_cost_usd END) AS detect_early,
       max(CASE WHEN scenario = 'detect_late' THEN cumulative_cost_usd END) AS detect_late,
       max(CASE WHEN scenario = 'do_nothing' THEN cumulative_cost_usd END) AS do_nothing,
       max(CASE WHEN scenario = 'detect_late' THEN cumulative_cost_usd END) - max(CASE WHEN scenario = 'detect_early' THEN cumulative_cost_usd END) AS savings_usd
FROM curves GROUP BY 1, 2, 3"""))
def roi_pivot(spark, sf):
    return present(scenarios.roi_pivot(scenarios.roi_curves(D.stage_costs(spark, sf), PARAMS), ROI_SCENARIOS))


@query("final_savings", with_parts("curves", """
SELECT run_id, max(CASE WHEN scenario = 'detect_early' THEN cumulative_cost_usd END) AS early_cost_usd,
       max(CASE WHEN scenario = 'detect_late' THEN cumulative_cost_usd END) AS late_cost_usd,
       max(CASE WHEN scenario = 'detect_late' THEN cumulative_cost_usd END) - max(CASE WHEN scenario = 'detect_early' THEN cumulative_cost_usd END) AS savings_usd
FROM curves WHERE stage_sequence = (SELECT max(stage_sequence) FROM curves) GROUP BY 1"""))
def final_savings(spark, sf):
    return present(scenarios.final_savings(scenarios.roi_curves(D.stage_costs(spark, sf), PARAMS)))


def _stored_curves(spark, sf):
    """Curves of all runs, computed once for the newest run and for its rows."""
    return stored(spark, sf, "prevention_roi_curves", lambda: scenarios.roi_curves(D.stage_costs(spark, sf), PARAMS))


@query("latest_run_curves", with_parts("curves", """
SELECT run_id, scenario, CAST(stage_sequence AS BIGINT) AS stage_sequence, cumulative_cost_usd FROM curves
WHERE run_id = (SELECT run_id FROM curves ORDER BY created_at DESC, run_id DESC LIMIT 1)"""))
def latest_run_curves(spark, sf):
    curves, _ = lookups.prevention_roi(_stored_curves(spark, sf))
    return present(curves, "run_id", "scenario", "stage_sequence", "cumulative_cost_usd")


@query("latest_run_savings", with_parts("curves", """
SELECT run_id, max(CASE WHEN scenario = 'detect_early' THEN cumulative_cost_usd END) AS early_cost_usd,
       max(CASE WHEN scenario = 'detect_late' THEN cumulative_cost_usd END) AS late_cost_usd,
       max(CASE WHEN scenario = 'detect_late' THEN cumulative_cost_usd END) - max(CASE WHEN scenario = 'detect_early' THEN cumulative_cost_usd END) AS savings_usd
FROM curves WHERE run_id = (SELECT run_id FROM curves ORDER BY created_at DESC, run_id DESC LIMIT 1)
  AND stage_sequence = (SELECT max(stage_sequence) FROM curves) GROUP BY 1"""))
def latest_run_savings(spark, sf):
    """The second result of the same tool."""
    _, savings = lookups.prevention_roi(_stored_curves(spark, sf))
    return present(savings)


@query("stage_plan", with_parts("scope", """
SELECT run_id, scenario, seq AS stage_sequence, sum(cost) OVER (PARTITION BY run_id, scenario ORDER BY seq) AS cumulative_cost_usd
FROM scope CROSS JOIN (VALUES ('detect_early', [15000, 25000, 30000, 40000, 350000, 420000]), ('detect_late', [0, 0, 0, 250000, 1200000, 1850000]),
  ('do_nothing', [0, 0, 0, 0, 580000, 2600000]), ('ai_investment', [15000, 25000, 30000, 40000, 350000, 420000])) AS p(scenario, costs),
  LATERAL (SELECT unnest(costs)::DOUBLE AS cost, generate_subscripts(costs, 1) AS seq)"""))
def stage_plan(spark, sf):
    plan = scenarios.stage_cost_rows(_scope(spark, sf).select("run_id"), ROI_STAGES, ROI_STAGE_COSTS)
    return present(scenarios.roi_curves(plan, PARAMS), "run_id", "scenario", "stage_sequence", "cumulative_cost_usd")


@query("table_freshness", """
SELECT 'events' AS table_name, strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS last_updated, FALSE AS is_stale FROM events
UNION ALL SELECT 'lineitem', strftime(max(l_shipdate), '%Y-%m-%d %H:%M:%S'), FALSE FROM lineitem
UNION ALL SELECT 'orders', strftime(max(o_orderdate), '%Y-%m-%d %H:%M:%S'), FALSE FROM orders
UNION ALL SELECT 'orders_unknown', NULL, TRUE""")
def table_freshness(spark, sf):
    t = lambda n: D.table(spark, sf, n)
    return present(reports.freshness({
        "events": (t("events"), "ts"), "lineitem": (t("lineitem"), "l_shipdate"), "orders": (t("orders"), "o_orderdate"),
        "orders_unknown": (t("orders").filter(F.col("o_orderstatus") == "?"), "o_orderdate")}))


@query("table_row_counts", with_parts("alerts weekly lotrates finds trace histall", """
SELECT 'defect_alerts' AS table_name, count(*) AS row_count FROM alerts UNION ALL SELECT 'weekly_defect_trend', count(*) FROM weekly
UNION ALL SELECT 'lot_defect_rates', count(*) FROM lotrates UNION ALL SELECT 'rca_findings', count(*) FROM finds
UNION ALL SELECT 'lot_defect_traceability', count(*) FROM trace UNION ALL SELECT 'supplier_defect_history', count(*) FROM histall"""))
def table_row_counts(spark, sf):
    return present(reports.row_counts({
        "defect_alerts": D.alerts(spark, sf), "weekly_defect_trend": D.weekly(spark, sf),
        "lot_defect_rates": D.lot_rates(spark, sf), "rca_findings": D.findings(spark, sf),
        "lot_defect_traceability": D.traceability(spark, sf), "supplier_defect_history": D.history(spark, sf, before=None)}))


@query("risk_extract", with_parts("risk", """
SELECT r.supplier_id, s_name AS supplier_name, r_name AS region, CAST(NULL AS VARCHAR) AS material_type,
       CASE WHEN s_acctbal >= 6000 THEN 'TIER_1' WHEN s_acctbal >= 2000 THEN 'TIER_2' ELSE 'TIER_3' END AS contract_tier,
       composite_risk_score, risk_tier, would_trigger_audit, '2024-02-01 00:00:00' AS scored_at
FROM risk r JOIN supplier ON r.supplier_id = 'S' || s_suppkey LEFT JOIN nation ON s_nationkey = n_nationkey
LEFT JOIN region ON n_regionkey = r_regionkey"""))
def risk_extract(spark, sf):
    rows = export.risk_extract(D.risk_scores(spark, sf), D.RISK.dimensions, D.dim_supplier(spark, sf), "2024-02-01 00:00:00")
    return present(rows.drop(*D.RISK.dimensions))


@query("roi_extract", with_parts("curves", """
SELECT scenario, CAST(stage_sequence AS BIGINT) AS stage_sequence, stage_name, stage_cost_usd, cumulative_cost_usd, p10_cumulative_usd,
       p90_cumulative_usd, savings_vs_reference, CAST(created_at AS VARCHAR) AS created_at FROM curves"""))
def roi_extract(spark, sf):
    return present(export.roi_extract(scenarios.roi_curves(D.stage_costs(spark, sf), PARAMS)))


@query("traceability_extract", with_parts("trace", """
SELECT lot_id, supplier_id, material_type, strftime(entered_production_date, '%Y-%m-%d %H:%M:%S') AS entered_production_date, is_defective,
       defect_root_cause, hours_to_first_alert, round(mean_defect_rate, 5) AS mean_defect_rate, batch_count, batches_flagged,
       round(rca_top_confidence, 3) AS rca_top_confidence, rca_status FROM trace"""))
def traceability_extract(spark, sf):
    return present(export.traceability_extract(D.traceability(spark, sf)))


@query("refresh_record", with_parts("alerts lotrates", """
SELECT 'run-1' AS run_id, '2024-02-01 00:00:00' AS last_export, (SELECT count(*) FROM alerts) AS alert_rows, (SELECT count(*) FROM lotrates) AS lot_rows"""))
def refresh_record(spark, sf):
    """Two tables exported as CSV with the record of the export, read back."""
    folder = scratch_path(spark, "extracts")
    export.export_all({"alerts": D.alerts(spark, sf), "lots": D.lot_rates(spark, sf)}, folder, D.RUN_ID, "2024-02-01 00:00:00", spark)
    count = lambda name: spark.read.option("header", True).csv(f"{folder}/{name}").agg(F.count(F.lit(1)).alias("n"))
    record = spark.read.schema("last_export TIMESTAMP, run_id STRING").json(f"{folder}/_refresh")
    return present(record.join(count("alerts").withColumnRenamed("n", "alert_rows")).join(count("lots").withColumnRenamed("n", "lot_rows")))


@query("registered_alerts", with_parts("alerts", """
SELECT batch_id, supplier_id, observed_defect_rate, units_flagged, anomaly_score, alert_status, fail_inspections, material_lot,
       CAST(production_date AS VARCHAR) AS production_date, '2024-02-01 00:00:00' AS created_at, 'run-1' AS run_id,
       'batch_id,supplier_id,line_id,observed_defect_rate,units_flagged,anomaly_score,alert_status,supplier_risk_tier,defect_types,'
       || 'fail_inspections,material_lot,production_date,reasoning_chain,created_at,run_id' AS columns FROM alerts"""))
def registered_alerts(spark, sf):
    """Alerts written under the catalogue's schema; figures outside it are not stored."""
    path = scratch_path(spark, "registered")
    tables.write_run(tables.conform(D.alerts(spark, sf), registered("defect_alerts")), path, D.RUN_ID, "2024-02-01 00:00:00")
    rows = tables.read_table(spark, path)
    return present(rows.withColumn("columns", F.lit(",".join(rows.columns))), "batch_id", "supplier_id", "observed_defect_rate",
                   "units_flagged", "anomaly_score", "alert_status", "fail_inspections", "material_lot", "production_date",
                   "created_at", "run_id", "columns")
