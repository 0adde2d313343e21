"""Run scope, severity gate, briefing text and its numeric audit."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotwatch.functions import text as T
from lotwatch.functions.scalars import word_count
from lotwatch.params import RootCauseParams, SummaryParams


def defect_scope(alerts: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Size of the flagged problem. Suppliers are counted here and listed by
    ``affected_suppliers``, since a list in one row would grow with the data."""
    return alerts.filter(F.col("alert_status") == "FLAGGED").groupBy(*keys).agg(
        F.count_distinct("batch_id").alias("flagged_batches"),
        F.coalesce(F.sum("units_flagged"), F.lit(0)).alias("total_units_flagged"),
        F.coalesce(F.avg("anomaly_score"), F.lit(0.0)).alias("avg_anomaly_score"),
        F.coalesce(F.avg("observed_defect_rate"), F.lit(0.0)).alias("avg_defect_rate"),
        F.count_distinct("supplier_id").alias("affected_suppliers"),
    )


def affected_suppliers(alerts: DataFrame) -> DataFrame:
    return alerts.filter(F.col("alert_status") == "FLAGGED").groupBy("supplier_id").agg(
        F.count(F.lit(1)).alias("flagged_batches"), F.sum("units_flagged").alias("units_flagged")
    )


def with_severity(scope: DataFrame, params: SummaryParams) -> DataFrame:
    units = F.col("total_units_flagged") >= params.severity_units
    rate = F.col("avg_defect_rate") >= params.severity_rate
    return scope.withColumn("should_publish", units | rate).withColumn(
        "trigger_reason", F.when(units, "unit_threshold").when(rate, "rate_threshold")
    )


def disclosure(rca_status: Column, confidence: Column) -> Column:
    return F.when(
        rca_status.isin("ESCALATED", "INSUFFICIENT_EVIDENCE"),
        F.format_string("Root cause is inconclusive at a confidence of %.0f%%; analyst review requested.",
                        confidence * 100),
    )


def briefing_text(rows: DataFrame) -> Column:
    """Plain-text summary of one run (scope, cause, response)."""
    body = F.concat(
        F.lit("Quality briefing. "),
        F.format_string("Scope: %d units in %d batches from %d suppliers were flagged. ",
                        "total_units_flagged", "flagged_batches", "affected_suppliers"),
        F.format_string("Root cause: %s, confidence %.1f percent. ",
                        "top_hypothesis", F.col("max_top_confidence") * 100),
        F.format_string("Response: %s at an expected cost of $%s USD over %.1f days.",
                        F.initcap(F.replace("scenario_name", F.lit("_"), F.lit(" "))),
                        F.format_number("mean_total_cost_usd", 0), "mean_timeline_days"),
    )
    return F.concat_ws(" ", body, disclosure(F.col("rca_status"), F.col("max_top_confidence")))


def trusted_values() -> Column:
    names = ["total_units_flagged", "flagged_batches", "affected_suppliers", "_confidence_pct",
             "mean_total_cost_usd", "mean_timeline_days", "mean_returns_volume"]
    return F.array(*[F.coalesce(F.col(n).cast("double"), F.lit(0.0)) for n in names])


def briefings(scope: DataFrame, rca: DataFrame, top_finding: DataFrame, scenario: DataFrame,
              params: SummaryParams) -> DataFrame:
    """Audited briefing per run that passes the severity gate.

    Each input holds one row per run_id.
    """
    rows = with_severity(scope, params).filter("should_publish")
    rows = rows.join(rca.select("run_id", "max_top_confidence", "rca_status"), "run_id", "left")
    rows = rows.join(top_finding.select("run_id", "top_hypothesis"), "run_id", "left")
    rows = rows.join(scenario.select(
        "run_id", "scenario_name", "mean_total_cost_usd", "mean_timeline_days",
        "mean_returns_volume"), "run_id", "left")
    rows = rows.withColumn("_confidence_pct", F.round(F.col("max_top_confidence") * 100, 1))
    rows = rows.withColumns({"draft_text": briefing_text(rows), "trusted": trusted_values()})
    return audit(rows, "draft_text", "trusted", params).select(
        "run_id", "trigger_reason", "draft_text",
        note_unverified(F.col("revised_text"), F.col("unverified_claims")).alias("briefing_text"),
        F.col("scenario_name").alias("recommended_scenario"), "rca_status",
        F.col("max_top_confidence").alias("rca_confidence"),
        F.col("total_units_flagged").alias("units_flagged"), "flagged_batches",
        "verified_claims", "unverified_claims", "all_claims_verified",
    ).withColumn("word_count", word_count("briefing_text"))


def note_unverified(text: Column, unverified: Column) -> Column:
    note = F.format_string("[Please check these figures before sharing: %s.]",
                           F.array_join(unverified, ", "))
    return F.when(F.size(unverified) > 0, F.concat_ws("\n\n", text, note)).otherwise(text)


def audit(rows: DataFrame, text: str, trusted: str, params: SummaryParams) -> DataFrame:
    """Check every numeric claim of a text against the trusted values on its row.

    The claims are judged once, as the one element of an array that is laid out as columns. Texts
    are marked ``BATCH_ROWS`` at a time, so that a worker's memory doesn't follow Arrow's batches.
    """
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(rows.sparkSession.conf.get(setting))
    if not 0 < now <= T.BATCH_ROWS:
        rows.sparkSession.conf.set(setting, str(T.BATCH_ROWS))
    judged = F.array(T.judged_claims(T.extract_claims(text), trusted, params.claim_tolerance))
    lists = F.transform(judged, lambda j: F.struct(
        T.claims_where(j, True).alias("verified_claims"), T.claims_where(j, False).alias("unverified_claims")))
    return rows.select("*", F.inline(lists)).withColumns({
        "all_claims_verified": F.size("unverified_claims") == 0,
        "revised_text": T.annotate(text, "unverified_claims"),
    })


def audit_against_table(texts: DataFrame, text: str, trusted: DataFrame, key: str,
                        text_id: str, params: SummaryParams) -> DataFrame:
    """The same check with the trusted values in a table (key, value), for long value lists.

    Values are folded to the minimum and maximum of narrow logarithmic cells, and a claim looks
    only at the cells its tolerance can reach. A cell is narrower than the tolerance, so the
    one holding the claim matches as a whole, and in any other cell the end nearer the claim
    decides: no claim is ever paired with every value.
    """
    tolerance = params.claim_tolerance
    claims = texts.select(
        key, text_id, F.posexplode(T.extract_claims(text)).alias("position", "claim")
    ).withColumn("number", T.claim_number(F.col("claim")))

    def cell(x: Column) -> Column:
        return F.floor(F.log1p(x) / F.log1p(F.lit(tolerance / 4))).cast("int")

    value = F.col("value")
    cells = trusted.filter((value != 0) & (value > -tolerance * 2)).groupBy(
        key, cell(value).alias("cell")
    ).agg(F.min(value).alias("low"), F.max(value).alias("high"))

    number = F.col("number")
    reach = F.greatest(number, F.lit(1.0)) * (1.01 * tolerance / (1 - tolerance))
    probes = claims.select(key, "number").distinct().withColumn(
        "cell", F.explode(F.sequence(cell(number - reach), cell(number + reach))))

    def near(v: Column) -> Column:
        return F.abs(number - v) / F.greatest(F.abs(v), F.lit(1.0)) <= tolerance

    matched = (
        probes.join(cells, [key, "cell"])
        .groupBy(key, "number")
        .agg(F.max(near(F.col("low")) | near(F.col("high"))).alias("is_verified"))
    )
    return claims.join(matched, [key, "number"], "left").select(
        key, text_id, "position", "claim", F.coalesce("is_verified", F.lit(False)).alias("is_verified"))


def run_confidence(findings: DataFrame, keys: Sequence[str], params: RootCauseParams) -> DataFrame:
    best = F.max("top_confidence")
    return findings.groupBy(*keys).agg(
        best.alias("max_top_confidence"),
        F.when(best >= params.min_confidence, "COMPLETE").otherwise("INSUFFICIENT_EVIDENCE")
        .alias("rca_status"),
    )
