"""Typed, deduplicated silver tables from raw feeds."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lotwatch.functions import scalars as S
from lotwatch.functions.ranking import latest_per_key

DEFECT_COUNTS = {
    "stitching": "stitching_defects",
    "colorfastness": "colorfastness_defects",
    "sizing": "sizing_defects",
    "material": "material_defects",
    "print": "print_defects",
}


def valid_rows(raw: DataFrame) -> DataFrame:
    return raw.filter(F.col("_ingest_status") == "VALID").drop("_ingest_status")


def newest(raw: DataFrame, keys: Sequence[str], upper: Sequence[str] = ()) -> DataFrame:
    """Normalise the keys, then keep the latest ingested row of each.

    Two spellings of one key meet because the keys are normalised first; equal ingest times
    are settled by the remaining columns, so the choice never depends on row order.
    """
    return newest_of(normalised(raw, keys, upper), keys)


def normalised(raw: DataFrame, keys: Sequence[str], upper: Sequence[str] = ()) -> DataFrame:
    return raw.withColumns({c: S.norm_key(c) for c in {*keys, *upper}})


def newest_of(tidy: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The latest ingested row of each key; without a shuffle where ``tidy`` is bucketed by it."""
    ties = [c for c in tidy.columns if c not in keys and c != "ingested_at"]
    return latest_per_key(tidy, keys, [F.col("ingested_at").try_cast("timestamp"), *sorted(ties)])


def dim_supplier(raw: DataFrame) -> DataFrame:
    rows = newest(valid_rows(raw), ["supplier_id"])
    return rows.select(
        "supplier_id", F.trim("supplier_name").alias("supplier_name"),
        F.trim("country").alias("country"), F.trim("region").alias("region"),
        F.trim("tier").alias("tier"), S.to_double("avg_defect_rate").alias("avg_defect_rate"),
        S.is_active("status").alias("is_active"),
        F.col("ingested_at").try_cast("timestamp").alias("ingested_at"),
    )


def dim_batch(raw: DataFrame) -> DataFrame:
    rows = newest(valid_rows(raw), ["batch_id"], ["supplier_id", "line_id"])
    return rows.select(
        "batch_id", "supplier_id", "line_id", F.trim("sku").alias("sku"),
        F.col("production_date").try_cast("date").alias("production_date"),
        S.to_long("unit_count").alias("unit_count"), F.trim("lot_id").alias("lot_id"),
        F.col("ingested_at").try_cast("timestamp").alias("ingested_at"),
    )


def fact_qc_inspections(raw: DataFrame) -> DataFrame:
    rows = newest(valid_rows(raw), ["inspection_id"], ["batch_id", "supplier_id", "line_id"])
    counts = list(DEFECT_COUNTS.values())
    typed = rows.withColumns({c: S.to_long(c) for c in ["units_inspected", "total_defects", *counts]})
    return typed.filter(F.col("units_inspected") > 0).select(
        "inspection_id", "batch_id", "supplier_id", "line_id",
        F.col("inspection_date").try_cast("date").alias("inspection_date"),
        "units_inspected", "total_defects",
        S.safe_ratio("total_defects", "units_inspected").alias("defect_rate"),
        *counts,
        S.dominant(list(DEFECT_COUNTS), counts).alias("dominant_defect_type"),
        F.trim("qc_result").alias("qc_result"),
        F.col("ingested_at").try_cast("timestamp").alias("ingested_at"),
    )


def fact_sales_returns(raw: DataFrame) -> DataFrame:
    rows = newest(valid_rows(raw), ["return_id"], ["batch_id", "supplier_id"])
    typed = rows.withColumns({
        "units_sold": S.to_long("units_sold"),
        "units_returned": S.to_long("units_returned"),
        "unit_price_usd": S.to_double("unit_price_usd"),
        "sale_date": F.col("sale_date").try_cast("date"),
        "return_date": F.col("return_date").try_cast("date"),
    })
    return typed.filter(F.col("units_sold") > 0).select(
        "return_id", "batch_id", "supplier_id", F.trim("sku").alias("sku"),
        "sale_date", "return_date", S.days_between("sale_date", "return_date").alias("days_to_return"),
        "units_sold", "units_returned",
        S.safe_ratio("units_returned", "units_sold").alias("return_rate"),
        F.trim("return_reason").alias("return_reason"), "unit_price_usd",
        S.amount("units_returned", "unit_price_usd").alias("gross_return_cost_usd"),
        F.trim("channel").alias("channel"),
        F.col("ingested_at").try_cast("timestamp").alias("ingested_at"),
    )


def trailing_average(history: DataFrame, value: str, out: str, rows: int = 3) -> DataFrame:
    """Moving average over the last ``rows`` recorded months (missing months are not filled).

    A group is one supplier and line, so it holds at most one row per calendar month.
    """
    frame = Window.partitionBy("supplier_id", "line_id").orderBy("month").rowsBetween(1 - rows, 0)
    return history.withColumn(out, F.avg(value).over(frame))


def supplier_defect_history(raw: DataFrame) -> DataFrame:
    rows = newest(
        valid_rows(raw).withColumn("month", F.col("month").try_cast("date").cast("string")),
        ["supplier_id", "line_id", "month"],
    )
    typed = rows.select(
        "supplier_id", "line_id", F.col("month").cast("date").alias("month"),
        S.to_double("avg_defect_rate").alias("avg_defect_rate"),
        S.to_long("total_units").alias("total_units"),
        S.to_long("total_defects").alias("total_defects"),
        F.col("ingested_at").try_cast("timestamp").alias("ingested_at"),
    )
    return trailing_average(typed, "avg_defect_rate", "trailing_3m_avg_rate")


def material_lots(raw: DataFrame) -> DataFrame:
    return raw.select(
        "lot_id", "supplier_id", "material_type",
        F.col("entered_production_date").try_cast("timestamp").alias("entered_production_date"),
        S.to_long("batch_count").cast("int").alias("batch_count"),
        S.to_long("total_units").alias("total_units"),
        S.to_bool("is_defective").alias("is_defective"), "defect_root_cause",
        S.to_double("hours_to_first_alert").alias("hours_to_first_alert"),
    )


def supplier_risk_scores(raw: DataFrame, dimensions: Sequence[str]) -> DataFrame:
    return raw.select(
        "supplier_id",
        *[S.to_double(d).alias(d) for d in dimensions],
        S.to_double("composite_risk_score").alias("composite_risk_score"), "risk_tier",
        S.to_bool("would_trigger_audit").alias("would_trigger_audit"),
    )
