"""Registered queries: detection, trends and lot reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from lotwatch.functions.scalars import pct_above
from lotwatch.operators import detection, lookups, outliers, reports, trends
from lotwatch.plans import stages
from lotwatch.plans.present import present
from lotwatch.plans.registry import ORACLES, query
from lotwatch.plans.sqlparts import with_parts
from lotwatch.session import scratch_path, staged
from lotwatch.sources import tables
from lotwatch.sources import testdata as D

THRESHOLD = D.PARAMS.rate_threshold


@query("batch_alerts", with_parts("alerts", """
SELECT batch_id, supplier_id, line_id, observed_defect_rate, units_flagged, anomaly_score,
       alert_status, supplier_risk_tier, fail_inspections, material_lot,
       CAST(production_date AS VARCHAR) AS production_date FROM alerts"""))
def batch_alerts(spark, sf):
    return present(
        D.compute_alerts(spark, sf, with_type=False), "batch_id", "supplier_id", "line_id",
        "observed_defect_rate", "units_flagged", "anomaly_score", "alert_status",
        "supplier_risk_tier", "fail_inspections", "material_lot", "production_date")


@query("alert_reasoning", with_parts("reasons", "SELECT batch_id, reasoning FROM reasons"))
def alert_reasoning(spark, sf):
    return D.compute_alerts(spark, sf, with_type=False).select(
        "batch_id", F.col("reasoning_chain").alias("reasoning"))


@query("supplier_baselines", with_parts("base", """
SELECT supplier_id, line_id, mean_rate, std_rate, max_rate, months_on_record FROM base"""))
def supplier_baselines(spark, sf):
    return present(detection.baselines(D.history(spark, sf)))


@query("batch_quality_monthly", with_parts("typed", """
SELECT batch_id, supplier_id, line_id, round(avg(defect_count), 6) AS avg_defect_count,
       round(avg(units_inspected), 6) AS avg_units_inspected, count(*) AS inspection_count,
       count(*) FILTER (pass_fail = 'FAIL') AS fail_count,
       array_to_string(list_sort(list(DISTINCT defect_type)), ',') AS defect_types,
       round(avg(defect_count) / avg(units_inspected), 6) AS observed_defect_rate
FROM (SELECT * EXCLUDE (batch_id), 'B-' || supplier_id || '-' || line_id || '-' || year(inspection_date) AS batch_id FROM typed)
WHERE units_inspected >= 10 GROUP BY 1, 2, 3"""))
def batch_quality_monthly(spark, sf):
    rows = D.inspections(spark, sf, with_type=True).withColumn(
        "batch_id", F.concat_ws("-", F.lit("B"), "supplier_id", "line_id",
                                F.year("inspection_date").cast("string")))
    return present(detection.batch_quality(rows, D.PARAMS))


@query("min_units_filter", with_parts("insp", """
SELECT supplier_id, count(*) AS kept, CAST(sum(units_inspected) AS BIGINT) AS units
FROM insp WHERE units_inspected >= 10 GROUP BY 1"""))
def min_units_filter(spark, sf):
    kept = D.inspections(spark, sf).filter(F.col("units_inspected") >= D.PARAMS.min_units)
    return present(kept.groupBy("supplier_id").agg(
        F.count(F.lit(1)).alias("kept"), F.sum("units_inspected").alias("units")))


@query("alerts_with_batch_table", with_parts("alerts dimb", """
SELECT a.batch_id, CAST(d.unit_count AS BIGINT) AS unit_count, d.material_lot,
       CAST(d.production_date AS VARCHAR) AS production_date, a.observed_defect_rate
FROM alerts a LEFT JOIN dimb d USING (batch_id)"""))
def alerts_with_batch_table(spark, sf):
    batches = detection.with_batch_metadata(
        detection.batch_quality(D.watched(spark, sf), D.PARAMS), D.dim_batch(spark, sf))
    return present(batches, "batch_id", "unit_count", "material_lot", "production_date",
                   "observed_defect_rate")


@query("baseline_join", with_parts("scored", """
SELECT batch_id, mean_rate, std_rate, round(z, 4) AS z, mean_rate IS NULL AS no_baseline FROM scored"""))
def baseline_join(spark, sf):
    rows = detection.scored(D.batch_quality(spark, sf), detection.baselines(D.history(spark, sf)),
                            D.risk_scores(spark, sf), D.PARAMS)
    return rows.select("batch_id", "mean_rate", "std_rate", F.round("z", 4).alias("z"),
                       F.col("mean_rate").isNull().alias("no_baseline"))


@query("risk_tier_lookup", with_parts("bq risk", """
SELECT batch_id, coalesce(risk_tier, 'UNKNOWN') AS risk_tier, coalesce(composite_risk_score, 0.8) AS composite_risk_score,
       2.5::DOUBLE * CASE WHEN risk_tier = 'HIGH' THEN 0.85::DOUBLE ELSE 1.0::DOUBLE END AS threshold
FROM bq LEFT JOIN (SELECT * FROM risk WHERE risk_tier <> 'NORMAL') USING (supplier_id)"""))
def risk_tier_lookup(spark, sf):
    listed = D.risk_scores(spark, sf).filter(F.col("risk_tier") != "NORMAL")
    rows = detection.with_risk(D.batch_quality(spark, sf), listed, D.PARAMS)
    return present(rows.withColumn("threshold", detection.effective_threshold(F.col("risk_tier"), D.PARAMS)),
                   "batch_id", "risk_tier", "composite_risk_score", "threshold")


@query("lot_corroboration", with_parts("scored", """
SELECT batch_id, material_lot, round(lot_rate, 6) AS lot_rate, round(mean_rate + 1.8 * std_rate, 6) AS lot_cut, alert_status
FROM scored WHERE z >= 1.8 AND z < threshold"""))
def lot_corroboration(spark, sf):
    rows = detection.scored(D.batch_quality(spark, sf), detection.baselines(D.history(spark, sf)),
                            D.risk_scores(spark, sf), D.PARAMS)
    cut = F.col("mean_rate") + D.PARAMS.borderline_low * F.col("std_rate")
    borderline = (F.col("z") >= D.PARAMS.borderline_low) & (F.col("z") < F.col("threshold"))
    return present(rows.filter(borderline).withColumn("lot_cut", cut),
                   "batch_id", "material_lot", "lot_rate", "lot_cut", "alert_status")


@query("outlier_screen")
def outlier_screen(spark, sf):
    return outliers.flag_outliers(D.batch_quality(spark, sf), D.PARAMS)


@query("outlier_invariants", with_parts("bq", """
SELECT count(*) AS batches, count(*) AS scores_in_range, 0 AS wrongly_marked,
       least(count(*), CAST(floor(0.1 * (count(*) - 1)) AS BIGINT) + 1) AS marked_at_most FROM bq"""))
def outlier_invariants(spark, sf):
    """What must hold of the screen whatever its random trees: every batch is scored within
    (0, 1], the marks are those that the scores and the exact quantile give when taken again,
    and there are no more than the share allows."""
    rows = staged(outlier_screen(spark, sf), "screened")
    cut = rows.agg(F.percentile("outlier_score", 1 - D.PARAMS.contamination).alias("cut"))
    marked, again = F.col("is_outlier"), F.col("outlier_score") > F.col("cut")
    in_range = (F.col("outlier_score") > 0) & (F.col("outlier_score") <= 1)
    n = F.count(F.lit(1))
    most = F.least(n, F.floor(F.lit(D.PARAMS.contamination) * (n - 1)).cast("bigint") + 1)
    return rows.join(cut, F.col("outlier_score").isNotNull(), "left").agg(
        n.alias("batches"), F.count_if(in_range).alias("scores_in_range"),
        F.count_if(marked != again).cast("int").alias("wrongly_marked"),
        F.when(F.count_if(marked) <= most, most).otherwise(F.count_if(marked)).alias("marked_at_most"))


@query("alerts_under_screen", with_parts("scored", """
SELECT count(*) FILTER (z >= threshold) AS by_score, count(*) FILTER (z >= 1.8 AND z < threshold AND alert_status = 'FLAGGED') AS by_lot,
       count(*) FILTER (alert_status = 'REVIEW') AS borderline, count(*) FILTER (alert_status = 'NORMAL') AS normal,
       count(*) FILTER (alert_status = 'UNRESOLVED') AS unresolved FROM scored"""))
def alerts_under_screen(spark, sf):
    """The screen raises borderline batches and nothing else: with it, batches flagged by score
    or lot, normal and unresolved ones are those without it, and each borderline batch is
    flagged if it was marked and up for review if not."""
    batches = staged(D.batch_quality(spark, sf), "screened-batches")
    flags = outliers.flag_outliers(batches, D.PARAMS)
    rows = detection.scored(batches, detection.baselines(D.history(spark, sf)), D.risk_scores(spark, sf), D.PARAMS, flags)
    z, status, low = F.col("z"), F.col("alert_status"), D.PARAMS.borderline_low
    raised = F.col("lot_rate") >= F.col("mean_rate") + low * F.col("std_rate")
    near = (z >= low) & (z < F.col("threshold"))
    judged = F.when(F.col("is_outlier"), status == "FLAGGED").otherwise(status == "REVIEW")
    return rows.agg(
        F.count_if((status == "FLAGGED") & (z >= F.col("threshold"))).alias("by_score"),
        F.count_if((status == "FLAGGED") & near & raised).alias("by_lot"),
        F.count_if(near & ~raised & judged).alias("borderline"),
        F.count_if(status == "NORMAL").alias("normal"), F.count_if(status == "UNRESOLVED").alias("unresolved"))


@query("alerts_with_outliers")
def alerts_with_outliers(spark, sf):
    batches = D.batch_quality(spark, sf)
    flags = outliers.flag_outliers(batches, D.PARAMS)
    rows = detection.alerts(batches, detection.baselines(D.history(spark, sf)),
                            D.risk_scores(spark, sf), D.PARAMS, flags)
    return present(rows, "batch_id", "anomaly_score", "alert_status", "reasoning_chain")


@query("weekly_defect_trend", with_parts("weekly", """
SELECT supplier_id, CAST(production_week AS VARCHAR) AS production_week, round(weekly_defect_rate, 6) AS weekly_defect_rate,
       inspections, total_units_inspected, total_defects, above_threshold FROM weekly"""))
def weekly_defect_trend(spark, sf):
    return present(trends.weekly_trend(D.inspections(spark, sf), THRESHOLD))


@query("incremental_weekly_trend", with_parts("weekly", """
SELECT supplier_id, CAST(production_week AS VARCHAR) AS production_week, round(weekly_defect_rate, 6) AS weekly_defect_rate,
       inspections, total_units_inspected, total_defects, above_threshold FROM weekly"""))
def incremental_weekly_trend(spark, sf):
    """Two runs share every week; each stores the sums of its own rows, the second one twice."""
    path = scratch_path(spark, "weekly-state")
    for run, half in (("run-1", 0), ("run-2", 1), ("run-2", 1)):
        rows = D.inspections(spark, sf).filter(F.crc32("inspection_id") % 2 == half)
        states = stages.add_state(trends.weekly_state(rows), path, run, D.CUTOVER)
    return present(trends.finish_weekly(states, THRESHOLD))


@query("incremental_lot_rates", with_parts("lotrates", """
SELECT lot_id, supplier_id, round(mean_defect_rate, 6) AS mean_defect_rate, round(max_defect_rate, 6) AS max_defect_rate,
       batch_count, total_units, above_threshold FROM lotrates"""))
def incremental_lot_rates(spark, sf):
    """Inspections of a batch come in two runs; rates are those of the whole batches."""
    path = scratch_path(spark, "lot-state")
    for run, half in (("run-1", 0), ("run-2", 1)):
        rows = D.inspections(spark, sf).filter(F.crc32("inspection_id") % 2 == half)
        batches = detection.batch_quality(rows, D.PARAMS, carry={"unit_count": F.sum("units_inspected")}, extra_keys=["material_lot"])
        states = stages.add_state(trends.lot_state(batches), path, run, D.CUTOVER)
    return present(trends.finish_lots(states, THRESHOLD, units_add_up=True))


@query("weekly_trend_by_batch_date", with_parts("insp dimball", """
SELECT supplier_id, CAST(date_trunc('week', production_date) AS DATE)::VARCHAR AS production_week,
       round(avg(CAST(defect_count AS DOUBLE) / greatest(units_inspected, 1)), 6) AS weekly_defect_rate,
       count(*) AS inspections, CAST(sum(units_inspected) AS BIGINT) AS total_units_inspected,
       CAST(sum(defect_count) AS BIGINT) AS total_defects,
       avg(CAST(defect_count AS DOUBLE) / greatest(units_inspected, 1)) >= 0.038 AS above_threshold
FROM insp JOIN (SELECT batch_id, supplier_id, production_date FROM dimball) USING (batch_id, supplier_id)
GROUP BY 1, 2"""))
def weekly_trend_by_batch_date(spark, sf):
    return present(trends.weekly_trend(D.inspections(spark, sf), THRESHOLD, D.dim_batch(spark, sf, since=None)))


@query("lot_defect_rates", with_parts("lotrates", """
SELECT lot_id, supplier_id, round(mean_defect_rate, 6) AS mean_defect_rate, round(max_defect_rate, 6) AS max_defect_rate,
       batch_count, total_units, above_threshold FROM lotrates"""))
def lot_defect_rates(spark, sf):
    return present(trends.lot_rates(D.batch_quality(spark, sf, since=None), THRESHOLD))


@query("top_lots", with_parts("lotrates", """
SELECT lot_id, supplier_id, round(mean_defect_rate, 6) AS mean_defect_rate, batch_count FROM lotrates
ORDER BY lotrates.mean_defect_rate DESC, lot_id LIMIT 15"""))
def top_lots(spark, sf):
    rates = trends.lot_rates(D.batch_quality(spark, sf, since=None), THRESHOLD)
    return present(trends.top_lots(rates), "lot_id", "supplier_id", "mean_defect_rate", "batch_count")


@query("lot_master", with_parts("dimball", """
SELECT material_lot AS lot_id, supplier_id, count(*) AS batch_count, CAST(sum(unit_count) AS BIGINT) AS total_units,
       CAST(min(production_date) AS VARCHAR) AS first_batch_production_date FROM dimball GROUP BY 1, 2"""))
def lot_master(spark, sf):
    return present(trends.lot_master(D.dim_batch(spark, sf, since=None)))


@query("fleet_signal", with_parts("histall risk", """
SELECT strftime(month, '%Y-%m') AS period, round(avg(defect_rate), 6) AS defect_rate
FROM histall WHERE supplier_id IN (SELECT supplier_id FROM risk WHERE risk_tier = 'HIGH') GROUP BY 1"""))
def fleet_signal(spark, sf):
    risky = D.risk_scores(spark, sf).filter(F.col("risk_tier") == "HIGH")
    return present(trends.fleet_signal(D.history(spark, sf, before=None), risky))


@query("first_crossing_fleet", with_parts("weekly", """
SELECT CAST(min(w) AS VARCHAR) AS first_alert_week, round(arg_min(r, w), 6) AS rate_at_crossing
FROM (SELECT production_week AS w, avg(weekly_defect_rate) AS r FROM weekly GROUP BY 1) WHERE r >= 0.022"""))
def first_crossing_fleet(spark, sf):
    return present(trends.first_crossing(D.weekly(spark, sf), 0.022))


@query("first_crossing_supplier", with_parts("weekly", """
SELECT supplier_id, CAST(min(production_week) AS VARCHAR) AS first_alert_week,
       round(arg_min(weekly_defect_rate, production_week), 6) AS rate_at_crossing
FROM weekly WHERE weekly_defect_rate >= 0.038 GROUP BY 1"""))
def first_crossing_supplier(spark, sf):
    return present(trends.first_crossing(D.weekly(spark, sf), THRESHOLD, ["supplier_id"]))


@query("production_conditions", with_parts("cond", """
SELECT line_id, month, batches_produced, total_units, round(avg_defects_per_inspection, 6) AS avg_defects_per_inspection,
       max_defects, fail_inspections FROM cond"""))
def production_conditions(spark, sf):
    return present(D.production_conditions(spark, sf))


@query("detection_run_status", with_parts("alerts", """
SELECT count(*) AS batches_evaluated, count(*) FILTER (alert_status = 'FLAGGED') AS flagged,
       count(*) FILTER (alert_status = 'REVIEW') AS review, count(*) FILTER (alert_status = 'UNRESOLVED') AS unresolved,
       CASE WHEN count(*) FILTER (alert_status = 'UNRESOLVED') = 0 THEN 'COMPLETE' ELSE 'PARTIAL' END AS status FROM alerts"""))
def detection_run_status(spark, sf):
    return present(detection.run_status(D.alerts(spark, sf)))


@query("alert_distribution", with_parts("alerts", """
SELECT alert_status, supplier_risk_tier, count(*) AS batch_count, round(avg(observed_defect_rate), 4) AS avg_defect_rate,
       round(avg(anomaly_score), 2) AS avg_zscore FROM alerts GROUP BY 1, 2"""))
def alert_distribution(spark, sf):
    return present(reports.alert_distribution(D.alerts(spark, sf)))


@query("defect_heat_map", with_parts("alerts", "SELECT supplier_id, " + ", ".join(
    f"round(avg(observed_defect_rate) FILTER (line_id = '{line}'), 12) AS {line}" for line in D.LINES)
    + " FROM alerts WHERE alert_status IN ('FLAGGED', 'REVIEW') GROUP BY 1"))
def defect_heat_map(spark, sf):
    return reports.heat_map(D.alerts(spark, sf), D.LINES, ("FLAGGED", "REVIEW"))


@query("defect_heat_cells", with_parts("alerts base", """
SELECT supplier_id, line_id, round(avg(observed_defect_rate), 12) AS observed_defect_rate,
       round(max(anomaly_score), 4) AS max_anomaly_score, count(*) AS batches, b.mean_rate AS baseline_mean_rate
FROM alerts LEFT JOIN base b USING (supplier_id, line_id) GROUP BY supplier_id, line_id, b.mean_rate"""))
def defect_heat_cells(spark, sf):
    return present(reports.heat_cells(D.alerts(spark, sf), detection.baselines(D.history(spark, sf))), digits=12)


@query("pct_above_baseline", with_parts("alerts", """
SELECT batch_id, CASE WHEN mean_rate > 0 THEN round(CAST((observed_defect_rate - mean_rate) / mean_rate * 100 AS DECIMAL(24, 12)), 1)::DOUBLE END AS pct_above_baseline
FROM alerts"""))
def pct_above_baseline(spark, sf):
    return D.alerts(spark, sf).select(
        "batch_id", pct_above("observed_defect_rate", "mean_rate").alias("pct_above_baseline"))


@query("star_join", with_parts("alerts dimb", """
SELECT a.batch_id, a.alert_status, d.unit_count, s_name AS supplier_name, n_name AS country, r_name AS region,
       CASE WHEN s_acctbal >= 6000 THEN 'TIER_1' WHEN s_acctbal >= 2000 THEN 'TIER_2' ELSE 'TIER_3' END AS tier
FROM alerts a LEFT JOIN dimb d USING (batch_id) LEFT JOIN supplier ON a.supplier_id = 'S' || s_suppkey
LEFT JOIN nation ON s_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey"""))
def star_join(spark, sf):
    alerts = D.alerts(spark, sf).select("batch_id", "supplier_id", "alert_status")
    batches = D.dim_batch(spark, sf).select("batch_id", "unit_count")
    rows = alerts.join(batches, "batch_id", "left").join(D.dim_supplier(spark, sf), "supplier_id", "left")
    return present(rows, "batch_id", "alert_status", "unit_count", "supplier_name", "country", "region", "tier")


@query("attention_list", with_parts("alerts reasons", """
SELECT batch_id, reasoning[1:100] AS reasoning, supplier_id, line_id, supplier_risk_tier, CAST(round(CAST(observed_defect_rate AS DECIMAL(18, 6)), 4) AS DOUBLE) AS defect_rate,
       CAST(round(CAST(anomaly_score AS DECIMAL(18, 4)), 2) AS DOUBLE) AS z_score, alert_status, material_lot FROM alerts JOIN reasons USING (batch_id)
WHERE alert_status IN ('FLAGGED', 'REVIEW', 'UNRESOLVED')"""))
def attention_list(spark, sf):
    return lookups.attention_list(D.alerts(spark, sf))


@query("lot_members", with_parts("dimball alerts", """
SELECT material_lot, batch_id, supplier_id, line_id, CAST(production_date AS VARCHAR) AS production_date FROM dimball
WHERE material_lot IN (SELECT material_lot FROM alerts WHERE alert_status = 'FLAGGED')"""))
def lot_members(spark, sf):
    flagged = D.alerts(spark, sf).filter(F.col("alert_status") == "FLAGGED")
    return present(detection.lot_members(D.dim_batch(spark, sf, since=None), flagged))


@query("flagged_batches_only", with_parts("insp alerts", """
SELECT inspection_id, batch_id, units_inspected, defect_count FROM insp
WHERE batch_id IN (SELECT batch_id FROM alerts WHERE alert_status = 'FLAGGED')"""))
def flagged_batches_only(spark, sf):
    flagged = D.alerts(spark, sf).filter(F.col("alert_status") == "FLAGGED").select("batch_id")
    rows = D.inspections(spark, sf).join(flagged, "batch_id", "left_semi")
    return present(rows, "inspection_id", "batch_id", "units_inspected", "defect_count")


@query("star_from_buckets", ORACLES["star_join"])
def star_from_buckets(spark, sf):
    """The same star with alerts and batches stored in buckets of the batch: neither is shuffled."""
    keep = lambda df, name: tables.write_bucketed(df, scratch_path(spark, name), ["batch_id"], 16)
    alerts = keep(D.alerts(spark, sf).select("batch_id", "supplier_id", "alert_status"), "bucketed-alerts")
    batches = keep(D.dim_batch(spark, sf).select("batch_id", "unit_count"), "bucketed-batches")
    rows = alerts.join(batches, "batch_id", "left").join(D.dim_supplier(spark, sf), "supplier_id", "left")
    return present(rows, "batch_id", "alert_status", "unit_count", "supplier_name", "country", "region", "tier")
