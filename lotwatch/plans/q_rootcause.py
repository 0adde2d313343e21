"""Registered queries: root cause, lots and escalations."""

from __future__ import annotations

from pyspark.sql import functions as F

from lotwatch.functions.ranking import global_rank, latest_per_key
from lotwatch.operators import detection, lookups, reports, rootcause, trends
from lotwatch.plans.present import present
from lotwatch.plans.registry import query
from lotwatch.plans.sqlparts import part, with_parts
from lotwatch.sources import tables
from lotwatch.sources import testdata as D
from lotwatch.sources.export import trend_extract

AT = "2024-02-01 00:00:00"

part("escal", "alerts finds", """
SELECT sha256('run-1|A-02|' || batch_id) AS escalation_id, 'A-02' AS agent_id, batch_id, supplier_id, FALSE AS recovery_attempted
FROM alerts WHERE alert_status = 'UNRESOLVED'
UNION ALL SELECT sha256('run-1|A-03|' || batch_id), 'A-03', batch_id, supplier_id, TRUE FROM finds WHERE top_confidence < 0.65""")


def _escalations(spark, sf):
    return rootcause.escalations(D.alerts(spark, sf), D.findings(spark, sf), D.RCA, D.RUN_ID, AT)


def _run(df):
    return df.withColumn("run_id", F.date_format("production_date", "yyyy"))


@query("evidence_sources", with_parts("sources alerts", """
SELECT batch_id, evidence_sources FROM sources JOIN alerts USING (batch_id)"""))
def evidence_sources(spark, sf):
    chosen = rootcause.select_sources(F.col("defect_types"), D.RCA)
    return present(D.alerts(spark, sf).select("batch_id", chosen.alias("evidence_sources")))


@query("supplier_trend", with_parts("trend6", """
SELECT supplier_id, months_on_record, recent_avg_defect_rate, round(max_historical_rate, 6) AS max_historical_rate, trend FROM trend6"""))
def supplier_trend(spark, sf):
    return present(rootcause.supplier_trend(D.history(spark, sf), D.RCA))


def _evidence(spark, sf):
    batches = D.dim_batch(spark, sf)
    flagged = D.alerts(spark, sf).filter(F.col("alert_status") == "FLAGGED")
    return rootcause.evidence(
        flagged, rootcause.supplier_trend(D.history(spark, sf), D.RCA), detection.lot_sizes(batches),
        D.production_conditions(spark, sf), D.lot_rates(spark, sf), D.RCA)


@query("evidence_bundle", with_parts("finds trend6 dimb cond lotrates", """
SELECT f.batch_id, CASE WHEN contains(evidence_sources, 'supplier_history') THEN t.months_on_record END::DOUBLE AS months_on_record,
       CASE WHEN contains(evidence_sources, 'supplier_history') THEN t.trend END AS trend,
       CASE WHEN contains(evidence_sources, 'material_lot') THEN s.n - 1 END::DOUBLE AS other_batches,
       CASE WHEN contains(evidence_sources, 'production_conditions') THEN c.batches_produced END::DOUBLE AS batches_produced,
       CASE WHEN contains(evidence_sources, 'production_conditions') THEN c.fail_inspections END::DOUBLE AS line_fails,
       round(r.mean_defect_rate, 6) AS lot_mean_rate, r.above_threshold
FROM finds f LEFT JOIN trend6 t USING (supplier_id)
LEFT JOIN (SELECT material_lot, count(*) AS n FROM dimb GROUP BY 1) s USING (material_lot)
LEFT JOIN cond c ON c.line_id = f.line_id AND c.month = strftime(f.production_date, '%Y-%m')
LEFT JOIN lotrates r ON r.lot_id = f.material_lot AND r.supplier_id = f.supplier_id"""))
def evidence_bundle(spark, sf):
    number = lambda path, name: F.col(path).cast("double").alias(name)
    return _evidence(spark, sf).select(
        "batch_id", number("supplier_history.months_on_record", "months_on_record"),
        F.col("supplier_history.trend").alias("trend"),
        number("material_lot_evidence.other_batches", "other_batches"),
        number("production_conditions.batches_produced", "batches_produced"),
        number("production_conditions.fail_inspections", "line_fails"),
        F.round("lot_rate_evidence.mean_defect_rate", 6).alias("lot_mean_rate"),
        F.col("lot_rate_evidence.above_threshold").alias("above_threshold"))


@query("rca_findings", with_parts("finds", """
SELECT batch_id, supplier_id, line_id, material_lot, rca_status, top_hypothesis, top_confidence, overall_confidence,
       evidence_sources, confidence_tier FROM finds"""))
def rca_findings(spark, sf):
    return present(D.compute_findings(spark, sf), "batch_id", "supplier_id", "line_id", "material_lot",
                   "rca_status", "top_hypothesis", "top_confidence", "overall_confidence",
                   "evidence_sources", "confidence_tier")


part("bundle", "finds trend6 dimb cond lotrates", """
SELECT f.*, contains(evidence_sources, 'supplier_history') AS asked_supplier, contains(evidence_sources, 'material_lot') AS asked_lot,
       contains(evidence_sources, 'production_conditions') AS asked_line,
       CASE WHEN asked_supplier THEN t.months_on_record END AS months, CASE WHEN asked_lot THEN s.n END AS lot_n,
       CASE WHEN asked_line THEN c.batches_produced END AS line_n, r.batch_count AS rated
FROM finds f LEFT JOIN trend6 t USING (supplier_id)
LEFT JOIN (SELECT material_lot, count(*) AS n FROM dimb GROUP BY 1) s USING (material_lot)
LEFT JOIN cond c ON c.line_id = f.line_id AND c.month = strftime(f.production_date, '%Y-%m')
LEFT JOIN lotrates r ON r.lot_id = f.material_lot AND r.supplier_id = f.supplier_id""")


@query("data_gaps", with_parts("bundle", """
SELECT batch_id, concat_ws('; ',
  CASE WHEN months IS NULL THEN 'supplier_history: ' || CASE WHEN asked_supplier THEN 'no record' ELSE 'not consulted' END END,
  CASE WHEN lot_n IS NULL THEN 'material_lot: ' || CASE WHEN asked_lot THEN 'no record' ELSE 'not consulted' END END,
  CASE WHEN line_n IS NULL THEN 'production_conditions: ' || CASE WHEN asked_line THEN 'no record' ELSE 'not consulted' END END,
  CASE WHEN rated IS NULL THEN 'lot_rate: no record' END) AS data_gaps
FROM bundle"""))
def data_gaps(spark, sf):
    return D.findings(spark, sf).select("batch_id", F.concat_ws("; ", "data_gaps").alias("data_gaps"))


@query("ranked_hypotheses", with_parts("bundle", """
SELECT batch_id, 1 AS rank, top_confidence AS confidence,
       CASE WHEN has_seam THEN 'hold_lot' WHEN has_heat THEN 'check_press' ELSE 'inspect_batch' END AS action,
       2 * (months IS NOT NULL)::INT + (lot_n IS NOT NULL)::INT + 2 * (line_n IS NOT NULL)::INT + (rated IS NOT NULL)::INT AS evidence_items
FROM bundle
UNION ALL SELECT batch_id, 2, heat_conf, 'check_press',
       2 * (months IS NOT NULL)::INT + (lot_n IS NOT NULL)::INT + 2 * (line_n IS NOT NULL)::INT + (rated IS NOT NULL)::INT
FROM bundle WHERE has_seam AND has_heat"""))
def ranked_hypotheses(spark, sf):
    rows = D.findings(spark, sf).select("batch_id", F.explode("hypotheses").alias("h"))
    return present(rows.select(
        "batch_id", F.col("h.rank").alias("rank"), F.col("h.confidence_score").alias("confidence"),
        F.col("h.recommended_action").alias("action"), F.size("h.supporting_evidence").alias("evidence_items")))


@query("lot_traceability", with_parts("trace", """
SELECT lot_id, supplier_id, material_type, strftime(entered_production_date, '%Y-%m-%d %H:%M:%S') AS entered_production_date, is_defective,
       defect_root_cause, hours_to_first_alert, round(mean_defect_rate, 6) AS mean_defect_rate, batch_count, batches_flagged,
       rca_top_confidence, rca_status FROM trace"""))
def lot_traceability(spark, sf):
    return present(rootcause.lot_traceability(
        D.findings(spark, sf), D.lot_rates(spark, sf), D.lot_meta(spark, sf)))


@query("traceability_listing", with_parts("trace", """
SELECT lot_id, is_defective, round(mean_defect_rate, 5) AS mean_defect_rate,
       row_number() OVER (ORDER BY is_defective DESC, round(trace.mean_defect_rate, 9) DESC, lot_id) AS place
FROM trace"""))
def traceability_listing(spark, sf):
    listed = global_rank(D.traceability(spark, sf), [F.desc("is_defective"), F.round("mean_defect_rate", 9).desc(), F.asc("lot_id")], "place")
    return present(listed.select("lot_id", "is_defective", F.round("mean_defect_rate", 5).alias("mean_defect_rate"), "place"))


@query("detection_hours", with_parts("trace", """
SELECT is_defective, count(*) AS lot_count, round(avg(mean_defect_rate), 4) AS avg_defect_rate,
       round(avg(hours_to_first_alert), 1) AS avg_hours_to_alert, min(hours_to_first_alert) AS fastest_alert_hrs,
       max(hours_to_first_alert) AS slowest_alert_hrs FROM trace GROUP BY 1"""))
def detection_hours(spark, sf):
    return present(reports.detection_hours(D.traceability(spark, sf)))


@query("finding_distribution", with_parts("finds", """
SELECT rca_status, confidence_tier, count(*) AS findings, count(DISTINCT batch_id) AS batches,
       round(avg(top_confidence), 3) AS avg_confidence FROM finds GROUP BY 1, 2"""))
def finding_distribution(spark, sf):
    return present(reports.finding_distribution(D.findings(spark, sf)).orderBy(reports.tier_order()))


@query("rca_run_status", with_parts("finds", """
SELECT count(*) AS batches_investigated, count(*) FILTER (top_confidence >= 0.65) AS rca_complete,
       count(*) FILTER (top_confidence < 0.65) AS rca_low_confidence, round(coalesce(max(top_confidence), 0), 4) AS max_top_confidence,
       CASE WHEN max(top_confidence) >= 0.65 THEN 'COMPLETE' ELSE 'INSUFFICIENT_EVIDENCE' END AS rca_status FROM finds"""))
def rca_run_status(spark, sf):
    return present(rootcause.run_status(D.findings(spark, sf), D.RCA))


@query("escalation_queue", with_parts("escal", """
SELECT escalation_id, agent_id, batch_id, supplier_id, recovery_attempted FROM escal"""))
def escalation_queue(spark, sf):
    field = lambda n: F.get_json_object("context_json", f"$.{n}").alias(n)
    return _escalations(spark, sf).select(
        "escalation_id", "agent_id", field("batch_id"), field("supplier_id"), "recovery_attempted")


@query("open_escalations", with_parts("escal", """
SELECT agent_id, count(*) AS open_escalations FROM escal WHERE escalation_id < '8' GROUP BY 1"""))
def open_escalations(spark, sf):
    # Cases whose id hash starts with 8 or higher count as resolved.
    queue = _escalations(spark, sf).withColumn("resolved", F.col("escalation_id") >= "8")
    return present(reports.open_escalations(queue))


@query("run_log", with_parts("alerts", """
SELECT strftime(production_date, '%Y') AS run_id, count(*) FILTER (alert_status = 'UNRESOLVED') AS escalations,
       'detect,rca,scenario,summary' AS stages, (count(*) / 10.0)::DOUBLE AS duration_seconds,
       'flagged=' || count(*) FILTER (alert_status = 'FLAGGED') AS notes FROM alerts GROUP BY 1"""))
def run_log(spark, sf):
    is_status = lambda s: F.count_if(F.col("alert_status") == s)
    runs = _run(D.alerts(spark, sf)).groupBy("run_id").agg(
        is_status("UNRESOLVED").alias("escalations"),
        (F.count(F.lit(1)) / 10.0).alias("duration_seconds"),
        F.concat(F.lit("flagged="), is_status("FLAGGED").cast("string")).alias("notes"))
    log = tables.run_log(runs, ["detect", "rca", "scenario", "summary"], AT)
    return present(log, "run_id", "escalations", "stages", "duration_seconds", "notes")


@query("top_finding_per_run", with_parts("finds", """
SELECT strftime(production_date, '%Y') AS run_id, batch_id, top_confidence FROM finds
QUALIFY row_number() OVER (PARTITION BY strftime(production_date, '%Y') ORDER BY top_confidence DESC, batch_id DESC) = 1"""))
def top_finding_per_run(spark, sf):
    rows = _run(D.findings(spark, sf)).select("run_id", "batch_id", "top_confidence")
    return present(latest_per_key(rows, ["run_id"], ["top_confidence", "batch_id"]))


@query("alerts_with_findings", with_parts("alerts finds", """
SELECT a.batch_id, a.alert_status, a.anomaly_score, f.confidence_tier, f.top_confidence
FROM alerts a LEFT JOIN finds f USING (batch_id)"""))
def alerts_with_findings(spark, sf):
    found = D.findings(spark, sf).select("batch_id", "confidence_tier", "top_confidence")
    return D.alerts(spark, sf).select("batch_id", "alert_status", "anomaly_score").join(found, "batch_id", "left")


@query("lookup_qc", with_parts("insp", """
SELECT inspection_id, batch_id, units_inspected, defect_count FROM insp
WHERE inspection_date BETWEEN DATE '1999-03-01' AND DATE '1999-03-31'"""))
def lookup_qc(spark, sf):
    rows = lookups.qc(D.clustered_inspections(spark, sf), dates=("1999-03-01", "1999-03-31"))
    return present(rows, "inspection_id", "batch_id", "units_inspected", "defect_count")


@query("lookup_qc_batch", with_parts("insp", """
SELECT inspection_id, units_inspected, defect_count FROM insp WHERE batch_id = (SELECT min(batch_id) FROM insp)"""))
def lookup_qc_batch(spark, sf):
    stored = D.clustered_inspections(spark, sf, "batch_id")
    wanted = stored.agg(F.min("batch_id")).first()[0]
    return present(lookups.qc(stored, batch_id=wanted), "inspection_id", "units_inspected", "defect_count")


@query("lookup_material_lot", with_parts("dimball", """
SELECT batch_id, supplier_id, material_lot, line_id, CAST(production_date AS VARCHAR) AS production_date FROM dimball
WHERE material_lot = 'LOT-7-199903'"""))
def lookup_material_lot(spark, sf):
    return present(lookups.material_lot(D.dim_batch(spark, sf, since=None), "LOT-7-199903"))


@query("lookup_supplier_history", with_parts("histall", """
SELECT supplier_id, line_id, CAST(month AS VARCHAR) AS month, units_inspected, round(defect_rate, 6) AS defect_rate, defects_found
FROM histall WHERE supplier_id = 'S7'"""))
def lookup_supplier_history(spark, sf):
    return present(lookups.supplier_history(D.history(spark, sf, before=None), "S7"))


@query("lookup_findings", with_parts("finds", """
SELECT batch_id, top_confidence, rca_status FROM finds WHERE supplier_id = 'S7'"""))
def lookup_findings(spark, sf):
    return lookups.rca_findings(D.findings(spark, sf), supplier_id="S7").select(
        "batch_id", "top_confidence", "rca_status")


@query("lookup_supplier_risk", with_parts("risk", """
SELECT supplier_id, composite_risk_score, risk_tier, TRUE AS is_high_risk FROM risk WHERE risk_tier = 'HIGH'"""))
def lookup_supplier_risk(spark, sf):
    return lookups.supplier_risk(D.risk_scores(spark, sf), risk_tier="HIGH").select(
        "supplier_id", "composite_risk_score", "risk_tier", "is_high_risk")


@query("lookup_lot_traceability", with_parts("trace", """
SELECT lot_id, supplier_id, round(mean_defect_rate, 6) AS mean_defect_rate, batches_flagged FROM trace WHERE is_defective"""))
def lookup_lot_traceability(spark, sf):
    return present(lookups.lot_traceability(D.traceability(spark, sf), defective_only=True),
                   "lot_id", "supplier_id", "mean_defect_rate", "batches_flagged")


@query("lookup_weekly_trend", with_parts("weekly", """
SELECT supplier_id, CAST(production_week AS VARCHAR) AS production_week, round(weekly_defect_rate, 6) AS weekly_defect_rate FROM weekly
QUALIFY dense_rank() OVER (PARTITION BY supplier_id ORDER BY production_week) <= 24"""))
def lookup_weekly_trend(spark, sf):
    return present(lookups.weekly_trend(D.weekly(spark, sf)), "supplier_id", "production_week", "weekly_defect_rate")


@query("lookup_first_alert_week", with_parts("weekly", """
SELECT CAST(min(w) AS VARCHAR) AS first_alert_week, round(arg_min(r, w), 6) AS rate_at_crossing
FROM (SELECT production_week AS w, avg(weekly_defect_rate) AS r FROM weekly WHERE supplier_id IN ('S7', 'S8') GROUP BY 1) WHERE r >= 0.038"""))
def lookup_first_alert_week(spark, sf):
    return present(lookups.first_alert_week(D.weekly(spark, sf), D.PARAMS.rate_threshold, ["S7", "S8"]))


@query("alert_week_extract", with_parts("weekly", """
SELECT supplier_id, CAST(production_week AS VARCHAR) AS production_week, round(CAST(weekly_defect_rate AS DECIMAL(24, 12)), 5)::DOUBLE AS weekly_defect_rate, total_defects,
       total_units_inspected, above_threshold, 0.038::DOUBLE AS threshold,
       CASE WHEN above_threshold THEN CAST(production_week AS VARCHAR) END AS alert_week FROM weekly"""))
def alert_week_extract(spark, sf):
    return present(trend_extract(D.weekly(spark, sf), D.PARAMS.rate_threshold))
