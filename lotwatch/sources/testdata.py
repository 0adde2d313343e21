"""The quality model bound to the order-line tables, for checks and benchmarks.

An order line stands for one inspection. For alerting, the date 1998-01-01 parts the history
from the batches under watch; everything else reads all lines.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lotwatch.operators import detection, reports, rootcause, trends
from lotwatch.params import DetectionParams, RiskParams, RootCauseParams
from lotwatch.session import landed, small_shuffles, small_splits, staged, stored
from lotwatch.sources.tables import write_clustered

CUTOVER = "1998-01-01"
LINES = tuple(f"L{i}" for i in range(1, 8))
PARAMS = DetectionParams(min_units=10)
# A gate above the lowest hypothesis confidence, so that doubtful findings occur.
RCA = RootCauseParams(min_confidence=0.65)
RISK = RiskParams()
RUN_ID = "run-1"

# Defect type of an inspection, from the part type.
DEFECT_TYPES = {
    "ECONOMY": "seam_bulge",
    "LARGE": "heat_transfer_failure",
    "MEDIUM": "material_deformation",
    "PROMO": "minor_thread",
    "SMALL": "minor_color_variation",
    "STANDARD": "none",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = f"{sf_dir}/{name}.parquet"
    small_splits(spark)
    small_shuffles(spark, path)
    return spark.read.parquet(path)


def _joined(prefix: str, *parts: Column | str) -> Column:
    texts = [(F.col(p) if isinstance(p, str) else p).cast("string") for p in parts]
    return F.concat_ws("-", F.lit(prefix), *texts)


def _day(c: str) -> Column:
    return F.col(c).cast("date")


def _lines(spark: SparkSession, sf_dir: str, since: str | None, before: str | None, with_type: bool) -> tuple[DataFrame, list[Column]]:
    """Order lines, with the defect type as a further column on request. Date bounds are set on
    the stored column, so they reach the Parquet scan."""
    lines = table(spark, sf_dir, "lineitem")
    if since:
        lines = lines.filter(F.col("l_shipdate") >= F.lit(since).cast("timestamp_ntz"))
    if before:
        lines = lines.filter(F.col("l_shipdate") < F.lit(before).cast("timestamp_ntz"))
    extra = []
    if with_type:
        parts = table(spark, sf_dir, "part").select("p_partkey", "p_type")
        lines = lines.join(parts, F.col("l_partkey") == F.col("p_partkey"), "left")
        kind = F.coalesce(*[F.when(F.col("p_type") == p, F.lit(d)) for p, d in DEFECT_TYPES.items()])
        extra = [kind.alias("defect_type")]
    return lines, extra


def inspections(spark: SparkSession, sf_dir: str, since: str | None = None,
                before: str | None = None, with_type: bool = False) -> DataFrame:
    return as_inspections(*_lines(spark, sf_dir, since, before, with_type))


def _month() -> Column:
    return F.year("l_shipdate") * 100 + F.month("l_shipdate")


def _figures(extra: Sequence[Column]) -> list[Column]:
    return [
        _day("l_shipdate").alias("inspection_date"),
        F.col("l_quantity").cast("bigint").alias("units_inspected"),
        F.floor(F.col("l_quantity") * F.col("l_discount")).cast("bigint").alias("defect_count"),
        F.when(F.col("l_returnflag") == "R", "FAIL").when(F.col("l_returnflag") == "A", "REVIEW")
        .otherwise("PASS").alias("pass_fail"),
        *extra,
    ]


def as_inspections(lines: DataFrame, extra: Sequence[Column] = ()) -> DataFrame:
    return lines.select(
        _joined("I", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("inspection_id"),
        _joined("B", "l_suppkey", "l_linenumber", "l_orderkey", _month()).alias("batch_id"),
        F.concat(F.lit("S"), F.col("l_suppkey").cast("string")).alias("supplier_id"),
        F.concat(F.lit("L"), F.col("l_linenumber").cast("string")).alias("line_id"),
        _joined("LOT", "l_suppkey", _month()).alias("material_lot"),
        *_figures(extra),
    )


def numbered_inspections(spark: SparkSession, sf_dir: str, since: str | None = None,
                         before: str | None = None, with_type: bool = False) -> DataFrame:
    """The inspections under numbers for ids, which move in half the bytes of their texts.

    A batch has its number within its supplier, line and lot, so it is grouped by all four; ``named``
    puts the texts back on what is left after the folds.
    """
    lines, extra = _lines(spark, sf_dir, since, before, with_type)
    return lines.select(
        F.struct(F.col("l_orderkey").alias("number")).alias("batch_id"), F.col("l_suppkey").alias("supplier_id"),
        F.col("l_linenumber").alias("line_id"),
        F.struct(F.col("l_suppkey").alias("supplier"), _month().alias("month")).alias("material_lot"),
        *_figures(extra),
    )


def named(rows: DataFrame, lot: str = "material_lot") -> DataFrame:
    """Texts for the ids of ``numbered_inspections``, in the columns that ``rows`` has."""
    texts = {
        "batch_id": lambda: _joined("B", "supplier_id", "line_id", "batch_id.number", f"{lot}.month"),
        "supplier_id": lambda: F.concat(F.lit("S"), F.col("supplier_id").cast("string")),
        "line_id": lambda: F.concat(F.lit("L"), F.col("line_id").cast("string")),
        lot: lambda: _joined("LOT", f"{lot}.supplier", f"{lot}.month"),
    }
    return rows.withColumns({c: text() for c, text in texts.items() if c in rows.columns})


def clustered_inspections(spark: SparkSession, sf_dir: str, by: str = "inspection_date") -> DataFrame:
    """Stored inspections in ranges of a column that they are looked up by."""
    def write(path: str) -> None:
        write_clustered(inspections(spark, sf_dir), path, [by])

    return spark.read.parquet(landed(spark, sf_dir, f"inspections-by-{by}", write))


def watched(spark: SparkSession, sf_dir: str, with_type: bool = False) -> DataFrame:
    return inspections(spark, sf_dir, since=CUTOVER, with_type=with_type)


def dim_batch(spark: SparkSession, sf_dir: str, since: str | None = CUTOVER) -> DataFrame:
    """Batches, by default those under watch, with units, lot and first production date."""
    rows = numbered_inspections(spark, sf_dir, since=since)
    return named(rows.groupBy("batch_id", "supplier_id", "line_id", "material_lot").agg(
        F.sum("units_inspected").alias("unit_count"),
        F.min("inspection_date").alias("production_date"),
    ))


def history(spark: SparkSession, sf_dir: str, before: str | None = CUTOVER) -> DataFrame:
    """Monthly rates, by default those before the watch began, against which it is scored."""
    return named(_numbered_history(spark, sf_dir, before))


def _numbered_history(spark: SparkSession, sf_dir: str, before: str | None = CUTOVER) -> DataFrame:
    rows = numbered_inspections(spark, sf_dir, before=before)
    return rows.groupBy(
        "supplier_id", "line_id", F.trunc("inspection_date", "month").alias("month")
    ).agg(
        F.sum("units_inspected").alias("units_inspected"),
        F.avg(F.col("defect_count") / F.col("units_inspected")).alias("defect_rate"),
        F.sum("defect_count").alias("defects_found"),
    )


def risk_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five bounded dimension scores per supplier, then the composite and its tier."""
    return named(_numbered_risk_scores(spark, sf_dir))


def _numbered_risk_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    key, balance = F.col("s_suppkey"), F.floor("s_acctbal").cast("bigint")

    def bounded(x: Column) -> Column:
        return F.lit(0.5) + F.pmod(x, F.lit(51)) / F.lit(100.0)

    suppliers = table(spark, sf_dir, "supplier").select(
        key.alias("supplier_id"),
        bounded(key * 7).alias("historical_defect_score"),
        bounded(key * 11 + 3).alias("on_time_delivery_score"),
        bounded(balance).alias("audit_score"),
        bounded(balance * 3 + key).alias("material_lot_stability_score"),
        bounded(balance + key * 5).alias("capacity_utilization_score"),
    )
    return reports.composite_risk(suppliers, RISK)


def dim_supplier(spark: SparkSession, sf_dir: str) -> DataFrame:
    s, n, r = (table(spark, sf_dir, t) for t in ("supplier", "nation", "region"))
    return (
        s.join(n, s.s_nationkey == n.n_nationkey, "left")
        .join(r, n.n_regionkey == r.r_regionkey, "left")
        .select(
            F.concat(F.lit("S"), F.col("s_suppkey").cast("string")).alias("supplier_id"),
            F.col("s_name").alias("supplier_name"), F.col("n_name").alias("country"),
            F.col("r_name").alias("region"),
            F.when(F.col("s_acctbal") >= 6000, "TIER_1").when(F.col("s_acctbal") >= 2000, "TIER_2")
            .otherwise("TIER_3").alias("tier"),
        )
    )


def sales_returns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily sales by part type and order priority; return flag R counts as returned."""
    lines = table(spark, sf_dir, "lineitem")
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_type")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    returned = F.col("l_returnflag") == "R"
    units = F.col("l_quantity").cast("bigint")
    return (
        lines.join(parts, F.col("l_partkey") == F.col("p_partkey"))
        .join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .groupBy(_day("l_shipdate").alias("date"), F.col("p_type").alias("sku"),
                 F.col("o_orderpriority").alias("channel"))
        .agg(
            F.sum(units).alias("units_sold"),
            F.sum(F.when(returned, units).otherwise(0)).alias("units_returned"),
            F.round(F.sum("l_extendedprice"), 2).alias("revenue_usd"),
            F.round(F.sum(F.when(returned, F.col("l_extendedprice")).otherwise(0.0)), 2)
            .alias("refund_usd"),
        )
        .withColumn("return_rate", F.round(F.col("units_returned") / F.col("units_sold"), 6))
    )


def stage_costs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cost by scenario and stage: order status is the scenario, line number the stage,
    and each order priority counts as one run."""
    lines, orders = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    status = F.col("o_orderstatus")
    scenario = (F.when(status == "F", "detect_early").when(status == "O", "detect_late")
                .otherwise("do_nothing"))
    cost = F.floor(F.col("l_extendedprice") * F.col("l_tax")).cast("bigint")
    return (
        lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .groupBy(F.col("o_orderpriority").alias("run_id"), scenario.alias("scenario"),
                 F.col("l_linenumber").cast("int").alias("stage_sequence"))
        .agg(F.sum(cost).cast("double").alias("stage_cost_usd"),
             F.max(_day("o_orderdate")).alias("created_at"))
        .withColumn("stage_name", F.concat(F.lit("Stage "), F.col("stage_sequence").cast("string")))
    )


def lot_meta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lot metadata; a lot is labelled defective when over 40 % of its rows failed, and its
    hours to alert run from its first inspection to its first failed one."""
    fail = F.col("pass_fail") == "FAIL"
    first_fail = F.min(F.when(fail, F.col("inspection_date")))
    rows = numbered_inspections(spark, sf_dir).groupBy(F.col("material_lot").alias("lot_id"), "supplier_id").agg(
        F.lit("bonded_seam_tape").alias("material_type"),
        F.min("inspection_date").cast("timestamp").alias("entered_production_date"),
        (F.count_if(fail) / F.count(F.lit(1)) > 0.4).alias("is_defective"),
        F.lit(None).cast("string").alias("defect_root_cause"),
        (F.datediff(first_fail, F.min("inspection_date")) * 24.0).alias("hours_to_first_alert"),
    )
    return named(rows, "lot_id")


def batch_quality(spark: SparkSession, sf_dir: str, with_type: bool = False,
                  since: str | None = CUTOVER) -> DataFrame:
    """Batch aggregate, by default of those under watch, with the metadata carried along."""
    return _folded(inspections(spark, sf_dir, since=since, with_type=with_type))


def _numbered_batches(spark: SparkSession, sf_dir: str, with_type: bool, since: str | None) -> DataFrame:
    return _folded(numbered_inspections(spark, sf_dir, since=since, with_type=with_type))


def _folded(rows: DataFrame) -> DataFrame:
    return detection.batch_quality(rows, PARAMS, carry={
        "unit_count": F.sum("units_inspected"), "production_date": F.min("inspection_date"),
    }, extra_keys=["material_lot"], type_domain=list(DEFECT_TYPES.values()))


def compute_alerts(spark: SparkSession, sf_dir: str, with_type: bool = True) -> DataFrame:
    """Alerts from the raw lines. The batches, which the lots' averages read too, and the
    baselines are written first; the rest is one plan that runs when it is read."""
    batches = staged(_numbered_batches(spark, sf_dir, with_type, CUTOVER), "batches")
    baselines = staged(detection.baselines(_numbered_history(spark, sf_dir)), "baselines")
    return named(detection.alerts(batches, baselines, _numbered_risk_scores(spark, sf_dir), PARAMS))


def alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored alert table, written once per application to the shared folder."""
    return stored(spark, sf_dir, "defect_alerts", lambda: compute_alerts(spark, sf_dir))


def compute_findings(spark: SparkSession, sf_dir: str) -> DataFrame:
    batches, hist = dim_batch(spark, sf_dir), history(spark, sf_dir)
    flagged = alerts(spark, sf_dir).filter(F.col("alert_status") == "FLAGGED")
    bundle = rootcause.evidence(
        flagged, rootcause.supplier_trend(hist, RCA), detection.lot_sizes(batches),
        production_conditions(spark, sf_dir), lot_rates(spark, sf_dir), RCA)
    return rootcause.findings(bundle, RCA)


def findings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored(spark, sf_dir, "rca_findings", lambda: compute_findings(spark, sf_dir))


def production_conditions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trends.line_months(inspections(spark, sf_dir))


def lot_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored(spark, sf_dir, "lot_defect_rates", lambda: named(trends.lot_rates(
        _numbered_batches(spark, sf_dir, with_type=False, since=None), PARAMS.rate_threshold), "lot_id"))


def traceability(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored(spark, sf_dir, "lot_defect_traceability", lambda: rootcause.lot_traceability(
        findings(spark, sf_dir), lot_rates(spark, sf_dir), lot_meta(spark, sf_dir)))


def weekly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored(spark, sf_dir, "weekly_defect_trend", lambda: trends.weekly_trend(
        inspections(spark, sf_dir), PARAMS.rate_threshold))
