"""Parameterised queries over the stored tables; every filter reaches the scan."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lotwatch.operators.reports import latest_run_only
from lotwatch.operators.scenarios import final_savings
from lotwatch.operators.trends import first_crossing


def _matching(df: DataFrame, **wanted: object) -> DataFrame:
    for column, value in wanted.items():
        if value is not None:
            df = df.filter(F.col(column) == value)
    return df


def qc(inspections: DataFrame, batch_id: str | None = None,
       dates: tuple[str, str] | None = None) -> DataFrame:
    rows = _matching(inspections, batch_id=batch_id)
    if dates:
        rows = rows.filter(F.col("inspection_date").between(*[F.lit(d).cast("date") for d in dates]))
    return rows


def material_lot(dim_batch: DataFrame, lot: str) -> DataFrame:
    return _matching(dim_batch, material_lot=lot).select(
        "batch_id", "supplier_id", "material_lot", "line_id", "production_date")


def supplier_history(history: DataFrame, supplier_id: str) -> DataFrame:
    return _matching(history, supplier_id=supplier_id).orderBy("month", "line_id")


def rca_findings(findings: DataFrame, run_id: str | None = None,
                 supplier_id: str | None = None) -> DataFrame:
    rows = _matching(findings, run_id=run_id, supplier_id=supplier_id)
    return rows.orderBy(F.desc("top_confidence"), "batch_id")


def scenario_summary(projections: DataFrame, run_id: str) -> DataFrame:
    return _matching(projections, run_id=run_id)


def supplier_risk(scores: DataFrame, supplier_id: str | None = None,
                  risk_tier: str | None = None) -> DataFrame:
    rows = _matching(scores, supplier_id=supplier_id, risk_tier=risk_tier)
    return rows.withColumn("is_high_risk", F.col("risk_tier") == "HIGH").orderBy(
        "composite_risk_score", "supplier_id")


def lot_traceability(lots: DataFrame, lot_id: str | None = None, supplier_id: str | None = None,
                     defective_only: bool = False) -> DataFrame:
    rows = _matching(lots, lot_id=lot_id, supplier_id=supplier_id,
                     is_defective=True if defective_only else None)
    return rows.orderBy(F.desc("mean_defect_rate"), "lot_id")


def weekly_trend(trend: DataFrame, supplier_ids: Sequence[str] | None = None,
                 weeks: int = 24) -> DataFrame:
    """The first ``weeks`` recorded weeks of each supplier, so no week is cut in half.

    The trend holds one row per supplier and week, so a window group is bounded by the calendar.
    """
    rows = trend.filter(F.col("supplier_id").isin(*supplier_ids)) if supplier_ids else trend
    week = F.dense_rank().over(Window.partitionBy("supplier_id").orderBy("production_week"))
    return rows.withColumn("_week", week).filter(F.col("_week") <= weeks).drop("_week")


def first_alert_week(trend: DataFrame, threshold: float,
                     supplier_ids: Sequence[str] | None = None) -> DataFrame:
    rows = trend.filter(F.col("supplier_id").isin(*supplier_ids)) if supplier_ids else trend
    return first_crossing(rows, threshold)


def prevention_roi(curves: DataFrame, run_id: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Curves of a run (by default the last one written) and the final savings."""
    rows = latest_run_only(curves) if run_id is None else _matching(curves, run_id=run_id)
    return rows.orderBy("stage_sequence", "scenario"), final_savings(rows)


def attention_list(alerts: DataFrame) -> DataFrame:
    """Batches that need a look, worst score first."""
    rows = alerts.filter(F.col("alert_status").isin("FLAGGED", "REVIEW", "UNRESOLVED"))
    return rows.select(
        "batch_id", "supplier_id", "line_id", "supplier_risk_tier",
        F.round("observed_defect_rate", 4).alias("defect_rate"),
        F.round("anomaly_score", 2).alias("z_score"), "alert_status", "material_lot",
        F.substring("reasoning_chain", 1, 100).alias("reasoning"),
    ).orderBy(F.desc("z_score"), "batch_id")
