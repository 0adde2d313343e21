"""The stages of a run as plain functions: DataFrames in, DataFrames or stored tables out."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lotwatch.operators import briefing, detection, outliers, rootcause, scenarios, trends
from lotwatch.operators import validation as V
from lotwatch.params import (
    DetectionParams,
    Domains,
    IngestParams,
    RootCauseParams,
    ScenarioParams,
    SummaryParams,
)
from lotwatch.functions.ranking import latest_per_key
from lotwatch.schemas import LABEL_COLUMNS, LandingFeed, registered
from lotwatch.session import held, staged
from lotwatch.sources import versions
from lotwatch.sources.landing import FILE_COLUMNS, SOURCE_TIME, strip_labels
from lotwatch.sources.tables import conform, ingest_log, write_run


@dataclass(frozen=True)
class RunParams:
    detection: DetectionParams = field(default_factory=DetectionParams)
    rootcause: RootCauseParams = field(default_factory=RootCauseParams)
    scenario: ScenarioParams = field(default_factory=ScenarioParams)
    summary: SummaryParams = field(default_factory=SummaryParams)
    ingest: IngestParams = field(default_factory=IngestParams)
    domains: Domains = field(default_factory=Domains)


def assess(raw: DataFrame, feed: LandingFeed, params: RunParams) -> DataFrame:
    """Landing rows typed, with ``error_reason`` and the raw row kept for rejected ones.

    Rows of a file without a required column are rejected whole. Else type errors come first,
    then the names of broken rules; a file with too many bad rows is rejected whole too. Rates
    per file come from a pass over the narrow columns that they need.
    """
    columns = [c for c in raw.columns if c not in ("source_path", SOURCE_TIME, FILE_COLUMNS)]
    lacking = V.file_lacks(raw, feed)
    absent = [F.lit(None).cast("string").alias(c) for c in V.missing_columns(raw, feed)]
    marked = raw.select("*", *absent).withColumns({"_payload": F.struct(*columns), "_lacking": V.missing_reason(lacking)})
    typed = marked.withColumn("_type_error", V.coercion_error(marked, feed.types)).withColumns(
        {c: V._CASTS[k](c) for c, k in feed.types.items() if c in marked.columns})
    rules = {
        **V.not_null_rules(feed.not_null), **V.range_rules(columns),
        **V.business_rules(feed.stem, params.domains),
    }
    broken = V.failed_rules(rules)
    reason = F.coalesce("_lacking", "_type_error", F.when(F.size(broken) > 0, F.array_join(broken, ", ")))
    checked = typed.withColumn("error_reason", reason).drop("_type_error", "_lacking", FILE_COLUMNS)
    gated = V.gate_files(checked, F.col("error_reason").isNotNull(), params.ingest)
    held = F.when(F.col("file_quarantined"), F.lit("File held back: too many invalid rows"))
    gated = gated.withColumn("error_reason", F.coalesce("error_reason", held)).drop("file_quarantined")
    # Raw rows go through the gate as they are, so that only those of rejected rows are made JSON.
    as_json = F.to_json("_payload", {"ignoreNullFields": "false"})
    return gated.withColumn("_payload", F.when(F.col("error_reason").isNotNull(), as_json))


def latest(rows: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """``latest_per_key`` where few keys come more than once: only rows whose keys may are sorted and
    shuffled whole, told by counts of the keys' hashes."""
    hashed = F.xxhash64(*keys)
    twice = rows.groupBy(hashed.alias("hash")).count().where("count > 1").select("hash")
    many = twice.count()
    if not many:
        return rows
    again = versions._maybe_in(twice, many)
    return again.sift(rows, hashed, False).unionByName(latest_per_key(again.sift(rows, hashed), keys, order))


@dataclass(frozen=True)
class Assessed:
    """The three outputs of a landing: typed rows by key, rejected rows, and the file log."""

    good: DataFrame
    bad: DataFrame
    log: DataFrame


def split(rows: DataFrame, feed: LandingFeed, run_id: str, at: Column | str, files: Sequence[str] = ()) -> Assessed:
    """Outputs of assessed rows. Labels are taken off where they are not the feed's own; of a
    key that came more than once, the row of the file written last stays. The log also lists
    those of ``files`` that have no row."""
    is_bad = F.col("error_reason").isNotNull()
    good = strip_labels(rows.filter(~is_bad).drop("error_reason", "_payload"),
                        () if feed.stem == "material_lots" else LABEL_COLUMNS)
    bad = rows.filter(is_bad).select(
        F.col("_payload").alias("payload"), "error_reason",
        F.col("source_path").alias("source_file"), F.lit(feed.table).alias("table_name"))
    log = ingest_log(rows.withColumn("is_bad", is_bad), feed.table, run_id, at, files=files).drop("run_id", "ingested_at")
    order = [c for c in (SOURCE_TIME, "source_path") if c in good.columns]
    return Assessed(latest(good, feed.key, order).drop(SOURCE_TIME), bad, log)


def ingest(raw: DataFrame, feed: LandingFeed, root: str, run_id: str, at: Column | str,
           params: RunParams, files: Sequence[str] = ()) -> versions.Version:
    """Commit good rows, then write rejected rows and the file log of one feed.

    A key that an earlier run stored is taken from that run, so the newest delivery stays. The
    log comes last: files of a run that was killed count as new, and delivering them again
    changes nothing. The commit tells how many keys were delivered again.
    """
    with held(assess(raw, feed, params), "assessed") as rows:
        out = split(rows, feed, run_id, at, files)
        done = versions.merge(out.good, f"{root}/silver/{feed.table}", feed.key, run_id, at)
        write_run(out.bad, f"{root}/silver/bad_records/{feed.table}", run_id, at, "quarantined_at")
        write_run(out.log, f"{root}/silver/ingest_log/{feed.table}", run_id, at, "ingested_at")
    return done


@dataclass(frozen=True)
class Gold:
    """Result tables of one run, still lazy."""

    alerts: DataFrame
    weekly_trend: DataFrame
    lot_rates: DataFrame
    findings: DataFrame
    traceability: DataFrame
    projections: DataFrame
    roi_curves: DataFrame
    escalations: DataFrame
    briefings: DataFrame
    states: dict[str, tuple[DataFrame, Callable[[DataFrame], DataFrame]]] = field(default_factory=dict)

    def tables(self) -> dict[str, DataFrame]:
        return {
            "defect_alerts": self.alerts, "weekly_defect_trend": self.weekly_trend,
            "lot_defect_rates": self.lot_rates, "rca_findings": self.findings,
            "lot_defect_traceability": self.traceability,
            "scenario_projections": self.projections, "prevention_roi_curves": self.roi_curves,
            "escalation_queue": self.escalations, "executive_briefings": self.briefings,
        }


def build_gold(inspections: DataFrame, dim_batch: DataFrame, history: DataFrame, risk: DataFrame,
               lot_meta: DataFrame, sales: DataFrame, stage_costs: DataFrame, run_id: str,
               at: Column | str, params: RunParams, with_outliers: bool = True) -> Gold:
    """All result tables of a run from the silver tables.

    The batch aggregate and the alerts feed several tables each, so both are staged.
    """
    batches = staged(detection.with_batch_metadata(
        detection.batch_quality(inspections, params.detection), dim_batch), "batch-quality")
    flags = outliers.flag_outliers(batches, params.detection) if with_outliers else None
    baseline = staged(detection.baselines(history), "baselines")
    alerts = staged(detection.alerts(batches, baseline, risk, params.detection, flags), "alerts")
    rates = trends.lot_rates(batches, params.detection.rate_threshold)
    flagged = alerts.filter(F.col("alert_status") == "FLAGGED")
    bundle = rootcause.evidence(
        flagged, rootcause.supplier_trend(history, params.rootcause),
        detection.lot_sizes(dim_batch), trends.production_conditions(dim_batch, inspections),
        rates, params.rootcause)
    findings = staged(rootcause.findings(bundle, params.rootcause), "findings")
    weekly = trends.weekly_state(inspections, dim_batch)
    run = F.lit(run_id).alias("run_id")
    scope = briefing.defect_scope(alerts).select(run, "*")
    profile = scope.select("run_id", F.col("total_units_flagged").alias("total_units")).join(
        scenarios.rate_profile(sales).select(run, "*"), "run_id")
    projections = scenarios.projections(profile, params.scenario)
    rca = findings.groupBy(run).agg(
        F.max("top_confidence").alias("max_top_confidence"),
        F.when(F.max("top_confidence") >= params.rootcause.min_confidence, "COMPLETE")
        .otherwise("INSUFFICIENT_EVIDENCE").alias("rca_status"))
    top = findings.groupBy(run).agg(
        F.max_by("top_hypothesis", F.struct("top_confidence", "batch_id")).alias("top_hypothesis"))
    chosen = projections.filter("is_recommended")
    return Gold(
        alerts=alerts,
        weekly_trend=trends.finish_weekly(weekly, params.detection.rate_threshold),
        lot_rates=rates,
        findings=findings,
        traceability=rootcause.lot_traceability(findings, rates, lot_meta),
        projections=projections,
        roi_curves=scenarios.roi_curves(stage_costs, params.scenario),
        escalations=rootcause.escalations(alerts, findings, params.rootcause, run_id, at),
        briefings=briefing.briefings(scope, rca, top, chosen, params.summary),
        states={
            "weekly_defect_trend": (weekly, lambda s: trends.finish_weekly(s, params.detection.rate_threshold)),
            "lot_defect_rates": (trends.lot_state(batches), lambda s: trends.finish_lots(s, params.detection.rate_threshold)),
        },
    )


def write_gold(gold: Gold, root: str, run_id: str, at: Column | str) -> None:
    """Store a run; repeating it leaves identical tables.

    Weekly trend and lot rates cover the rows of all runs: a run stores the sums of its own
    rows, and the tables are put together from the runs' sums, not from their inspections.
    """
    for name, df in gold.tables().items():
        if name in gold.states:
            state, finish = gold.states[name]
            df = finish(add_state(state, f"{root}/gold/state/{name}", run_id, at))
            write_run(conform(df, registered(name)), f"{root}/gold/{name}", run_id, at, mode="overwrite")
        else:
            write_run(conform(df, registered(name)), f"{root}/gold/{name}", run_id, at)


def add_state(state: DataFrame, path: str, run_id: str, at: Column | str) -> DataFrame:
    """Store the sums of one run's rows beside those of the other runs, and read them all."""
    write_run(state, path, run_id, at)
    return state.sparkSession.read.parquet(path)


def read_gold(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{root}/gold/{name}")
