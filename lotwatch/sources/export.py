"""CSV extracts for dashboards."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StructType

from lotwatch.functions.scalars import steady_round


def flat(df: DataFrame) -> DataFrame:
    """Nested columns as JSON text, which is the only form CSV can hold."""
    nested = (ArrayType, MapType, StructType)
    return df.select(*[
        F.to_json(f.name).alias(f.name) if isinstance(f.dataType, nested) else F.col(f.name)
        for f in df.schema.fields
    ])


def export_csv(df: DataFrame, path: str, order: list[Column | str] | None = None) -> None:
    """Distributed CSV write; ``order`` sorts by range so part files are globally ordered."""
    out = flat(df)
    if order:
        out = out.orderBy(*order)
    out.write.mode("overwrite").option("header", True).csv(path)


def export_all(tables: dict[str, DataFrame], folder: str, run_id: str, at: Column | str,
               spark: SparkSession) -> None:
    for name, df in tables.items():
        export_csv(df, f"{folder}/{name}")
    refresh = spark.range(1).select(
        F.lit(at).cast("timestamp").alias("last_export"), F.lit(run_id).alias("run_id")
    )
    refresh.coalesce(1).write.mode("overwrite").json(f"{folder}/_refresh")


def trend_extract(trend: DataFrame, threshold: float) -> DataFrame:
    """Weekly trend with the helper column that marks alert weeks."""
    return trend.select(
        "supplier_id", "production_week", steady_round("weekly_defect_rate", 5).alias("weekly_defect_rate"),
        "total_defects", "total_units_inspected", "above_threshold",
        F.lit(threshold).alias("threshold"),
        F.when(F.col("above_threshold"), F.col("production_week")).alias("alert_week"),
    )


def risk_extract(scores: DataFrame, dimensions: tuple[str, ...], suppliers: DataFrame, at: Column | str) -> DataFrame:
    """Scores with who the supplier is; what ``suppliers`` doesn't hold is null."""
    known = {"supplier_name": "supplier_name", "region": "region", "material_type": "material_type", "contract_tier": "tier"}
    about = [F.col(c).alias(n) if c in suppliers.columns else F.lit(None).cast("string").alias(n) for n, c in known.items()]
    return scores.join(suppliers.select("supplier_id", *about), "supplier_id", "left").select(
        "supplier_id", *known, *dimensions, "composite_risk_score", "risk_tier", "would_trigger_audit",
        F.lit(at).cast("timestamp").alias("scored_at"))


def traceability_extract(lots: DataFrame) -> DataFrame:
    return lots.withColumn("mean_defect_rate", F.round("mean_defect_rate", 5)).withColumn(
        "rca_top_confidence", F.round("rca_top_confidence", 3)
    )


def roi_extract(curves: DataFrame) -> DataFrame:
    return curves.select(
        "scenario", "stage_sequence", "stage_name", "stage_cost_usd", "cumulative_cost_usd",
        "p10_cumulative_usd", "p90_cumulative_usd", "savings_vs_reference", "created_at",
    )
