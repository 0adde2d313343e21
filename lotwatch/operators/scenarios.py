"""Response-scenario costs over observed return rates, and cumulative cost curves."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import fields

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lotwatch.functions.ranking import exact_quantiles
from lotwatch.params import Scenario, ScenarioParams

# Fixed value: standard normal quantile at 0.9, and the shortest timeline in days.
NORMAL_P90 = 1.2815515655446004
MIN_TIMELINE_DAYS = 14.0

SCENARIO_FIELDS = [f.name for f in fields(Scenario)]


def scenario_array(scenarios: Sequence[Scenario]) -> Column:
    """The parameter table as an array literal: exploding it needs no join."""
    return F.array(*[
        F.struct(*[F.lit(getattr(s, name)).alias(name) for name in SCENARIO_FIELDS])
        for s in scenarios
    ])


def scenario_rows(runs: DataFrame, params: ScenarioParams,
                  overrides: DataFrame | None = None) -> DataFrame:
    """Each run beside every scenario; a non-null override field replaces the default."""
    rows = runs.select("*", F.explode(scenario_array(params.scenarios)).alias("_s")).select(
        *runs.columns, "_s.*"
    )
    if overrides is None:
        return rows
    changed = [c for c in overrides.columns if c in SCENARIO_FIELDS and c != "name"]
    renamed = overrides.select("run_id", "name", *[F.col(c).alias(f"_{c}") for c in changed])
    joined = rows.join(renamed, ["run_id", "name"], "left")
    return joined.withColumns({c: F.coalesce(f"_{c}", c) for c in changed}).drop(
        *[f"_{c}" for c in changed]
    )


def rate_profile(returns: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Mean and exact quantiles of the observed return rates.

    Return rates lie in [0, 1] with six digits, so a group has at most a million distinct
    values; the percentile works on those values and their counts, not on the rows.
    """
    rate = F.col("return_rate")
    counts = returns.filter(rate.isNotNull()).groupBy(*keys, "return_rate").agg(
        F.count(F.lit(1)).alias("_n")
    )
    quantiles = F.percentile("return_rate", F.array(F.lit(0.1), F.lit(0.5), F.lit(0.9)), F.col("_n"))
    return counts.groupBy(*keys).agg(
        F.sum("_n").alias("n_samples"),
        (F.sum(rate * F.col("_n")) / F.sum("_n")).alias("mean_rate"),
        quantiles.alias("_q"),
    ).select(
        *keys, "n_samples", "mean_rate", F.col("_q")[0].alias("p10_rate"),
        F.col("_q")[1].alias("p50_rate"), F.col("_q")[2].alias("p90_rate"),
    )


def total_cost(units: Column, rate: Column, params: ScenarioParams) -> Column:
    returns = units * rate * F.col("return_rate_multiplier")
    return (
        units * F.col("cost_per_unit")
        + returns * params.avg_unit_price * F.col("brand_factor")
        + F.col("fixed_cost")
    )


def projections(profile: DataFrame, params: ScenarioParams, overrides: DataFrame | None = None,
                variants: Sequence[float] = (1.0,)) -> DataFrame:
    """Cost summary per run, return-rate variant and scenario.

    ``profile`` has one row per run: run_id, total_units and the columns of ``rate_profile``.
    The cost is linear in the return rate, so its quantiles are the costs at the rate
    quantiles and no row is ever repeated per scenario or variant.
    """
    rows = scenario_rows(profile, params, overrides).withColumn(
        "return_rate_assumption", F.explode(F.array(*[F.lit(float(v)) for v in variants]))
    )
    units = F.col("total_units").cast("double")
    factor = F.col("return_rate_assumption")
    cost = {
        stat: F.round(total_cost(units, F.col(f"{stat}_rate") * factor, params), 2)
        for stat in ("mean", "p10", "p50", "p90")
    }
    # Under a negative factor the cost falls with the rate, so the ends change places.
    cost["p10"], cost["p90"] = F.least(cost["p10"], cost["p90"]), F.greatest(cost["p10"], cost["p90"])
    half = F.lit(NORMAL_P90) * F.col("timeline_std")
    rows = rows.select(
        "run_id", "return_rate_assumption", F.col("name").alias("scenario_name"),
        F.col("label").alias("scenario_label"),
        F.col("total_units").cast("bigint").alias("total_units_in_scope"),
        *[c.alias(f"{stat}_total_cost_usd") for stat, c in cost.items()],
        F.round("timeline_mean", 1).alias("mean_timeline_days"),
        F.round(F.greatest(F.col("timeline_mean") - half, F.lit(MIN_TIMELINE_DAYS)), 1)
        .alias("p10_timeline_days"),
        F.round(F.greatest(F.col("timeline_mean") + half, F.lit(MIN_TIMELINE_DAYS)), 1)
        .alias("p90_timeline_days"),
        F.round(units * F.col("mean_rate") * factor * F.col("return_rate_multiplier"), 0)
        .alias("mean_returns_volume"),
        "n_samples",
        F.when(F.col("n_samples") >= params.min_sample, "HIGH").otherwise("LOW").alias("sample_flag"),
    )
    return recommend(rows)


def recommend(rows: DataFrame) -> DataFrame:
    """Mark the cheapest scenario and whether its cost range is clear of the others.

    A window group is the handful of scenarios of one run and variant.
    """
    group = Window.partitionBy("run_id", "return_rate_assumption")
    cheapest = F.min(F.struct("mean_total_cost_usd", "scenario_name")).over(group)
    rows = rows.withColumn("is_recommended", cheapest["scenario_name"] == F.col("scenario_name"))
    rec_low = F.max(F.when(F.col("is_recommended"), F.col("p10_total_cost_usd"))).over(group)
    rec_high = F.max(F.when(F.col("is_recommended"), F.col("p90_total_cost_usd"))).over(group)
    overlaps = (
        ~F.col("is_recommended")
        & (F.col("p10_total_cost_usd") <= rec_high)
        & (F.col("p90_total_cost_usd") >= rec_low)
    )
    rows = rows.withColumn("_overlaps", overlaps)
    unclear = F.max("_overlaps").over(group)
    return rows.withColumn(
        "confidence_flag", F.when(unclear, "LOW_CONFIDENCE").otherwise("OK")
    ).drop("_overlaps")


def recommended_by_flag(rows: DataFrame, flag: Column) -> DataFrame:
    """Per run the flagged scenario, or the first by name where none is flagged."""
    best = F.min_by(F.struct("*"), F.struct(~F.coalesce(flag, F.lit(False)), "scenario_name"))
    return rows.groupBy("run_id").agg(best.alias("_r")).select("_r.*")


def cost_range(rows: DataFrame) -> DataFrame:
    """Whole-dollar projection with the P90 - P10 width."""
    width = F.col("p90_total_cost_usd") - F.col("p10_total_cost_usd")
    return rows.select(
        "run_id", "return_rate_assumption", "scenario_name", "is_recommended", "confidence_flag",
        *[F.round(c, 0).alias(c) for c in rows.columns if c.endswith("_total_cost_usd")],
        F.round(width, 0).alias("cost_uncertainty_usd"),
    )


def quantile_summary(df: DataFrame, keys: Sequence[str], value: str,
                     approximate: bool = False) -> DataFrame:
    """Mean, P10, P50 and P90 of a column per group (exact, or sketched on request)."""
    names = ["p10", "p50", "p90"]
    probs = [0.1, 0.5, 0.9]
    if approximate:
        sketch = F.percentile_approx(value, F.array(*[F.lit(p) for p in probs]), 10_000)
        return df.groupBy(*keys).agg(F.avg(value).alias("mean"), sketch.alias("_q")).select(
            *keys, "mean", *[F.col("_q")[i].alias(n) for i, n in enumerate(names)])
    return exact_quantiles(df, keys, value, probs, names, mean="mean")


def stage_cost_rows(runs: DataFrame, stages: Sequence[str],
                    costs: dict[str, Sequence[float]]) -> DataFrame:
    """The planned stage costs beside each run, as rows."""
    plan = F.array(*[
        F.struct(F.lit(name).alias("scenario"), F.lit(i + 1).alias("stage_sequence"),
                 F.lit(stage).alias("stage_name"), F.lit(float(cost)).alias("stage_cost_usd"))
        for name, per_stage in costs.items()
        for i, (stage, cost) in enumerate(zip(stages, per_stage))
    ])
    return runs.select("*", F.explode(plan).alias("_p")).select(*runs.columns, "_p.*")


def roi_curves(stage_costs: DataFrame, params: ScenarioParams,
               keys: Sequence[str] = ("run_id",)) -> DataFrame:
    """Cumulative cost by stage with its band, and savings against the reference scenario.

    Windows run over the stages of one scenario and the scenarios of one stage: a few rows.
    """
    along = Window.partitionBy(*keys, "scenario").orderBy("stage_sequence").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    at_stage = Window.partitionBy(*keys, "stage_sequence")
    curves = stage_costs.withColumn("cumulative_cost_usd", F.sum("stage_cost_usd").over(along))
    reference = F.max(
        F.when(F.col("scenario") == params.reference_scenario, F.col("cumulative_cost_usd"))
    ).over(at_stage)
    total = F.col("cumulative_cost_usd")
    return curves.withColumns({
        "p10_cumulative_usd": F.round(total * (1 - params.band), 0),
        "p90_cumulative_usd": F.round(total * (1 + params.band), 0),
        "savings_vs_reference": F.round(F.coalesce(reference, F.lit(0.0)) - total, 0),
    })


def roi_pivot(curves: DataFrame, scenarios: Sequence[str], keys: Sequence[str] = ("run_id",),
              early: str = "detect_early", late: str = "detect_late") -> DataFrame:
    """Cumulative cost by stage, one column per scenario, with the savings of acting early."""
    wide = curves.groupBy(*keys, "stage_sequence", "stage_name").pivot(
        "scenario", list(scenarios)
    ).agg(F.max("cumulative_cost_usd"))
    return wide.withColumn("savings_usd", F.col(late) - F.col(early))


def final_savings(curves: DataFrame, keys: Sequence[str] = ("run_id",),
                  early: str = "detect_early", late: str = "detect_late") -> DataFrame:
    """Savings at the last stage of each run."""
    last = F.max_by("cumulative_cost_usd", "stage_sequence")
    ends = curves.groupBy(*keys, "scenario").agg(last.alias("_c"))
    pick = lambda s: F.coalesce(F.max(F.when(F.col("scenario") == s, F.col("_c"))), F.lit(0.0))
    return ends.groupBy(*keys).agg(
        pick(early).alias("early_cost_usd"), pick(late).alias("late_cost_usd")
    ).withColumn("savings_usd", F.round(F.col("late_cost_usd") - F.col("early_cost_usd"), 2))
