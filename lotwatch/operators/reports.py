"""Aggregate reports over silver and gold tables."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotwatch.functions.scalars import json_list_size, kpi_colour
from lotwatch.params import RiskParams


def sales_totals(sales: DataFrame, start: str | None = None, end: str | None = None) -> DataFrame:
    if start and end:
        sales = sales.filter(F.col("date").between(F.lit(start).cast("date"), F.lit(end).cast("date")))
    zero = lambda c: F.coalesce(c, F.lit(0))
    return sales.agg(
        zero(F.sum("units_sold")).alias("total_sold"),
        zero(F.sum("units_returned")).alias("total_returned"),
        F.round(F.coalesce(F.avg("return_rate"), F.lit(0.0)), 4).alias("avg_return_rate"),
        F.round(F.coalesce(F.sum("revenue_usd"), F.lit(0.0)), 2).alias("total_revenue"),
        F.round(F.coalesce(F.sum("refund_usd"), F.lit(0.0)), 2).alias("total_refunds"),
    )


def composite_risk(scores: DataFrame, params: RiskParams) -> DataFrame:
    """Unweighted mean of the dimension scores, its tier and the audit trigger."""
    total = reduce(lambda a, b: a + b, [F.col(d) for d in params.dimensions])
    score = F.col("composite_risk_score")
    return scores.withColumn(
        "composite_risk_score", F.round(total / len(params.dimensions), 4)
    ).withColumn(
        "risk_tier",
        F.when(score < params.high_below, "HIGH")
        .when(score < params.elevated_below, "ELEVATED").otherwise("NORMAL"),
    ).withColumn("would_trigger_audit", F.col("risk_tier") == "HIGH")


def alert_distribution(alerts: DataFrame) -> DataFrame:
    return alerts.groupBy("alert_status", "supplier_risk_tier").agg(
        F.count(F.lit(1)).alias("batch_count"),
        F.round(F.avg("observed_defect_rate"), 4).alias("avg_defect_rate"),
        F.round(F.avg("anomaly_score"), 2).alias("avg_zscore"),
    )


def detection_hours(lots: DataFrame) -> DataFrame:
    hours = "hours_to_first_alert"
    return lots.groupBy("is_defective").agg(
        F.count(F.lit(1)).alias("lot_count"),
        F.round(F.avg("mean_defect_rate"), 4).alias("avg_defect_rate"),
        F.round(F.avg(hours), 1).alias("avg_hours_to_alert"),
        F.min(hours).alias("fastest_alert_hrs"),
        F.max(hours).alias("slowest_alert_hrs"),
    )


def finding_distribution(findings: DataFrame) -> DataFrame:
    return findings.groupBy("rca_status", "confidence_tier").agg(
        F.count(F.lit(1)).alias("findings"),
        F.count_distinct("batch_id").alias("batches"),
        F.round(F.avg("top_confidence"), 3).alias("avg_confidence"),
    )


def tier_order(tier: Column | str = "confidence_tier") -> Column:
    """Sort key HIGH, MEDIUM, LOW."""
    return F.array_position(F.array(F.lit("HIGH"), F.lit("MEDIUM"), F.lit("LOW")), tier)


def open_escalations(queue: DataFrame) -> DataFrame:
    return queue.filter(~F.col("resolved")).groupBy("agent_id").agg(
        F.count(F.lit(1)).alias("open_escalations")
    )


def freshness(tables: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """Latest write time of each table (each with its own time column); empty means stale."""
    rows = [
        df.agg(F.max(time).cast("timestamp").alias("last_updated")).select(
            F.lit(name).alias("table_name"), "last_updated")
        for name, (df, time) in tables.items()
    ]
    return reduce(DataFrame.unionByName, rows).withColumn("is_stale", F.col("last_updated").isNull())


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    rows = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, rows)


def heat_map(alerts: DataFrame, lines: Sequence[str], statuses: Sequence[str] = ()) -> DataFrame:
    """Mean observed rate per supplier, one column per line."""
    if statuses:
        alerts = alerts.filter(F.col("alert_status").isin(*statuses))
    return alerts.groupBy("supplier_id").pivot("line_id", list(lines)).agg(
        F.round(F.avg("observed_defect_rate"), 12)
    )


def heat_cells(alerts: DataFrame, baseline: DataFrame) -> DataFrame:
    """The same map in long form with scores and the baseline reference line."""
    cells = alerts.groupBy("supplier_id", "line_id").agg(
        F.round(F.avg("observed_defect_rate"), 12).alias("observed_defect_rate"),
        F.round(F.max("anomaly_score"), 4).alias("max_anomaly_score"),
        F.count(F.lit(1)).alias("batches"),
    )
    reference = baseline.select("supplier_id", "line_id", F.col("mean_rate").alias("baseline_mean_rate"))
    return cells.join(reference, ["supplier_id", "line_id"], "left")


def latest_row(rows: DataFrame, order: Sequence[Column | str]) -> DataFrame:
    """The single newest row of a table."""
    ordering = F.struct(*[F.col(o) if isinstance(o, str) else o for o in order])
    return rows.agg(F.max_by(F.struct(*rows.columns), ordering).alias("_r")).select("_r.*")


def latest_run_only(rows: DataFrame, time: str = "created_at") -> DataFrame:
    """Rows of the run written last. Run ids are random, so the time decides, not the id."""
    newest = rows.agg(F.max_by("run_id", F.struct(time, "run_id")).alias("run_id"))
    return rows.join(newest, "run_id", "left_semi")


def operations_summary(alerts: DataFrame, briefings: DataFrame, keys: Sequence[str] = ("run_id",)) -> DataFrame:
    """Scan counts per run beside the KPIs of its latest briefing."""
    status = F.col("alert_status")
    counts = alerts.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("batches_scanned"),
        F.count_distinct(F.when(status == "FLAGGED", F.col("batch_id"))).alias("flagged"),
        F.count_distinct(F.when(status == "REVIEW", F.col("batch_id"))).alias("borderline"),
    )
    kpis = briefings.select(
        *keys, "word_count", "all_claims_verified", "recommended_scenario",
        F.size("unverified_claims").alias("unverified_claim_count"))
    return counts.join(kpis, list(keys), "left").withColumn(
        "kpi_colour", kpi_colour("unverified_claim_count"))


def claim_log(briefings: DataFrame) -> DataFrame:
    """Verified and unverified counts from stored JSON lists."""
    return briefings.select(
        "run_id", "all_claims_verified",
        json_list_size("verified_json").alias("verified_count"),
        json_list_size("unverified_json").alias("unverified_count"),
        F.length("briefing_text").alias("briefing_char_count"),
    )
