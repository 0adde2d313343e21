"""One registry of table schemas, keys, landing routes and typed columns."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql.types import StructType


@dataclass(frozen=True)
class LandingFeed:
    """What a landing file must hold and where its rows go."""

    stem: str
    table: str
    key: tuple[str, ...]
    required: tuple[str, ...]
    types: dict[str, str]
    not_null: tuple[str, ...]


# Landing feeds in routing order (the first stem found in a file name wins).
FEEDS = (
    LandingFeed(
        "manufacturing_batches", "dim_batch", ("batch_id",),
        ("batch_id", "supplier_id", "production_date", "line_id", "unit_count",
         "material_lot", "material_type", "sku"),
        {"unit_count": "int"},
        ("batch_id", "supplier_id", "production_date", "line_id", "unit_count"),
    ),
    LandingFeed(
        "qc_inspection_logs", "fact_qc_inspections", ("inspection_id",),
        ("inspection_id", "batch_id", "supplier_id", "line_id", "inspection_date",
         "defect_count", "units_inspected", "pass_fail", "defect_type"),
        {"defect_count": "int", "units_inspected": "int"},
        ("inspection_id", "batch_id", "defect_count", "units_inspected"),
    ),
    LandingFeed(
        "sales_returns", "fact_sales_returns", ("transaction_id",),
        ("transaction_id", "date", "sku", "channel", "units_sold", "units_returned",
         "return_rate", "return_reason", "revenue_usd", "refund_usd"),
        {"units_sold": "int", "units_returned": "int", "return_rate": "float",
         "revenue_usd": "float", "refund_usd": "float"},
        ("transaction_id", "date", "units_sold"),
    ),
    LandingFeed(
        "supplier_defect_history", "supplier_defect_history",
        ("supplier_id", "line_id", "month"),
        ("supplier_id", "line_id", "month", "units_inspected", "defect_rate", "defects_found"),
        {"units_inspected": "int", "defects_found": "int", "defect_rate": "float"},
        ("supplier_id", "line_id", "month", "defect_rate"),
    ),
    LandingFeed(
        "supplier_manifest", "dim_supplier", ("supplier_id",),
        ("supplier_id", "supplier_name", "region", "material_type", "contract_tier",
         "baseline_defect_rate"),
        {"baseline_defect_rate": "float"},
        ("supplier_id", "supplier_name"),
    ),
    LandingFeed(
        "supplier_risk_scores", "supplier_risk_scores", ("supplier_id",),
        ("supplier_id", "historical_defect_score", "on_time_delivery_score", "audit_score",
         "material_lot_stability_score", "capacity_utilization_score",
         "composite_risk_score", "risk_tier"),
        {"composite_risk_score": "float"},
        ("supplier_id", "composite_risk_score"),
    ),
    LandingFeed(
        "material_lots", "material_lots", ("lot_id",),
        ("lot_id", "supplier_id", "material_type", "entered_production_date", "is_defective"),
        {"is_defective": "bool"},
        ("lot_id", "supplier_id"),
    ),
    LandingFeed(
        "batch_lot_mapping", "batch_lot_mapping", ("batch_id", "lot_id"),
        ("batch_id", "supplier_id", "lot_id", "production_date"),
        {},
        ("batch_id", "lot_id"),
    ),
)
FEED_BY_STEM = {feed.stem: feed for feed in FEEDS}

# Ground-truth labels that must never reach the silver tables of the detector.
LABEL_COLUMNS = ("is_defective", "lot_is_defective")

# Table schemas as DDL text, lineage columns last.
_LINEAGE = "ingested_at TIMESTAMP, run_id STRING"
_GOLD_LINEAGE = "created_at TIMESTAMP, run_id STRING"

SILVER = {
    "dim_supplier": (
        "supplier_id STRING, supplier_name STRING, region STRING, material_type STRING,"
        f" contract_tier STRING, baseline_defect_rate DOUBLE, {_LINEAGE}"),
    "dim_batch": (
        "batch_id STRING, supplier_id STRING, production_date DATE, line_id STRING,"
        f" unit_count BIGINT, material_lot STRING, material_type STRING, sku STRING, {_LINEAGE}"),
    "fact_qc_inspections": (
        "inspection_id STRING, batch_id STRING, supplier_id STRING, line_id STRING,"
        " inspection_date DATE, inspector_id STRING, units_inspected BIGINT,"
        f" defect_count BIGINT, defect_type STRING, pass_fail STRING, notes STRING, {_LINEAGE}"),
    "fact_sales_returns": (
        "transaction_id STRING, date DATE, sku STRING, channel STRING, units_sold BIGINT,"
        " units_returned BIGINT, return_rate DOUBLE, return_reason STRING,"
        f" revenue_usd DOUBLE, refund_usd DOUBLE, {_LINEAGE}"),
    "supplier_defect_history": (
        "supplier_id STRING, line_id STRING, month DATE, units_inspected BIGINT,"
        f" defect_rate DOUBLE, defects_found BIGINT, {_LINEAGE}"),
    "supplier_risk_scores": (
        "supplier_id STRING, historical_defect_score DOUBLE, on_time_delivery_score DOUBLE,"
        " audit_score DOUBLE, material_lot_stability_score DOUBLE,"
        " capacity_utilization_score DOUBLE, composite_risk_score DOUBLE, risk_tier STRING,"
        f" would_trigger_audit BOOLEAN, scored_at TIMESTAMP, {_LINEAGE}"),
    "material_lots": (
        "lot_id STRING, supplier_id STRING, material_type STRING,"
        " entered_production_date TIMESTAMP, batch_count INT, total_units BIGINT,"
        f" is_defective BOOLEAN, defect_root_cause STRING, hours_to_first_alert DOUBLE, {_LINEAGE}"),
    "batch_lot_mapping": (
        f"batch_id STRING, supplier_id STRING, lot_id STRING, production_date DATE, {_LINEAGE}"),
    "social_sentiment": (
        "date DATE, platform STRING, topic STRING, volume BIGINT, sentiment_score DOUBLE,"
        f" mentions_product BOOLEAN, {_LINEAGE}"),
    "ingest_log": (
        "source_path STRING, table_name STRING, rows_written BIGINT, rows_quarantined BIGINT,"
        " run_id STRING, status STRING, ingested_at TIMESTAMP"),
    "bad_records": (
        "payload STRING, error_reason STRING, source_file STRING, quarantined_at TIMESTAMP,"
        " run_id STRING"),
}

_HYPOTHESES = (
    "ARRAY<STRUCT<rank: INT, hypothesis: STRING, confidence_score: DOUBLE,"
    " supporting_evidence: ARRAY<STRING>, recommended_action: STRING>>"
)
# Result tables.
GOLD = {
    "defect_alerts": (
        "batch_id STRING, supplier_id STRING, line_id STRING, observed_defect_rate DOUBLE,"
        " units_flagged BIGINT, anomaly_score DOUBLE, alert_status STRING,"
        " supplier_risk_tier STRING, defect_types ARRAY<STRING>, fail_inspections BIGINT,"
        f" material_lot STRING, production_date DATE, reasoning_chain STRING, {_GOLD_LINEAGE}"),
    "weekly_defect_trend": (
        "supplier_id STRING, production_week DATE, weekly_defect_rate DOUBLE,"
        " inspections BIGINT, total_units_inspected BIGINT, total_defects BIGINT,"
        f" above_threshold BOOLEAN, {_GOLD_LINEAGE}"),
    "lot_defect_rates": (
        "lot_id STRING, supplier_id STRING, mean_defect_rate DOUBLE, max_defect_rate DOUBLE,"
        f" batch_count BIGINT, total_units BIGINT, above_threshold BOOLEAN, {_GOLD_LINEAGE}"),
    "rca_findings": (
        "batch_id STRING, supplier_id STRING, line_id STRING, material_lot STRING,"
        " rca_status STRING, top_hypothesis STRING, top_confidence DOUBLE,"
        f" overall_confidence DOUBLE, hypotheses {_HYPOTHESES},"
        " evidence_sources ARRAY<STRING>, data_gaps ARRAY<STRING>, confidence_tier STRING,"
        f" {_GOLD_LINEAGE}"),
    "lot_defect_traceability": (
        "lot_id STRING, supplier_id STRING, material_type STRING,"
        " entered_production_date TIMESTAMP, is_defective BOOLEAN, defect_root_cause STRING,"
        " hours_to_first_alert DOUBLE, mean_defect_rate DOUBLE, batch_count BIGINT,"
        f" batches_flagged BIGINT, rca_top_confidence DOUBLE, rca_status STRING, {_GOLD_LINEAGE}"),
    "scenario_projections": (
        "scenario_name STRING, scenario_label STRING, is_recommended BOOLEAN,"
        " confidence_flag STRING, total_units_in_scope BIGINT, mean_total_cost_usd DOUBLE,"
        " p10_total_cost_usd DOUBLE, p50_total_cost_usd DOUBLE, p90_total_cost_usd DOUBLE,"
        f" mean_timeline_days DOUBLE, mean_returns_volume DOUBLE, n_samples BIGINT, {_GOLD_LINEAGE}"),
    "prevention_roi_curves": (
        "scenario STRING, stage_sequence INT, stage_name STRING, stage_cost_usd DOUBLE,"
        " cumulative_cost_usd DOUBLE, p10_cumulative_usd DOUBLE, p90_cumulative_usd DOUBLE,"
        f" savings_vs_reference DOUBLE, {_GOLD_LINEAGE}"),
    "executive_briefings": (
        "briefing_id STRING, briefing_text STRING, word_count INT, rca_confidence DOUBLE,"
        " rca_status STRING, recommended_scenario STRING, units_flagged BIGINT,"
        " flagged_batches BIGINT, verified_claims ARRAY<STRING>,"
        f" unverified_claims ARRAY<STRING>, all_claims_verified BOOLEAN, {_GOLD_LINEAGE}"),
    "escalation_queue": (
        "escalation_id STRING, agent_id STRING, run_id STRING, escalated_at TIMESTAMP,"
        " question STRING, context_json STRING, recovery_attempted BOOLEAN, resolved BOOLEAN,"
        " resolution_notes STRING"),
    "run_log": (
        "run_id STRING, run_timestamp TIMESTAMP, stages ARRAY<STRING>, escalations BIGINT,"
        " duration_seconds DOUBLE, notes STRING, created_at TIMESTAMP"),
}


def registered(table: str) -> StructType:
    """Columns of a registered table without its lineage, which the writer adds."""
    return StructType([f for f in schema_of(table) if f.name not in ("run_id", "created_at", "ingested_at")])


def schema_of(table: str) -> StructType:
    """Parsed schema of a registered table (needs an active session)."""
    return StructType.fromDDL({**SILVER, **GOLD}[table])
