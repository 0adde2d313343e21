import numpy as np
import pytest

from lotwatch.operators import scenarios
from lotwatch.params import ROI_STAGE_COSTS, ROI_STAGES, ScenarioParams

P = ScenarioParams()


def profile(spark, rates, units=1000):
    returns = spark.createDataFrame([(r,) for r in rates], "return_rate double")
    row = scenarios.rate_profile(returns)
    from pyspark.sql import functions as F
    return row.select(F.lit("r").alias("run_id"), F.lit(units).alias("total_units"), "*")


def test_costs_equal_the_costs_of_every_rate(spark):
    rates = [round(float(x), 6) for x in np.random.default_rng(3).random(101)]
    got = {r.scenario_name: r for r in scenarios.projections(profile(spark, rates), P).collect()}
    for s in P.scenarios:
        costs = [1000 * s.cost_per_unit + 1000 * r * s.return_rate_multiplier * 85.0 * s.brand_factor + s.fixed_cost for r in rates]
        row = got[s.name]
        assert row.mean_total_cost_usd == pytest.approx(np.mean(costs), abs=0.02)
        assert row.p10_total_cost_usd == pytest.approx(np.percentile(costs, 10), abs=0.02)
        assert row.p90_total_cost_usd == pytest.approx(np.percentile(costs, 90), abs=0.02)
    assert [r.scenario_name for r in got.values() if r.is_recommended] == ["partial_remediation"]


def test_variants_and_overrides(spark):
    over = spark.createDataFrame([("r", "do_nothing", 0.0)], "run_id string, name string, brand_factor double")
    rows = scenarios.projections(profile(spark, [0.5]), P, over, (0.7, 1.3)).collect()
    assert len(rows) == 6
    assert {r.mean_total_cost_usd for r in rows if r.scenario_name == "do_nothing"} == {0.0}
    assert all(r.is_recommended == (r.scenario_name == "do_nothing") for r in rows)
    assert {r.sample_flag for r in rows} == {"LOW"}


def test_overlapping_ranges_lower_the_confidence(spark):
    wide = scenarios.projections(profile(spark, [0.0, 0.2, 0.9, 1.0]), P).collect()
    assert {r.confidence_flag for r in wide} == {"LOW_CONFIDENCE"}
    narrow = scenarios.projections(profile(spark, [0.5]), P).collect()
    assert {r.confidence_flag for r in narrow} == {"OK"}


def test_first_scenario_when_none_is_flagged(spark):
    from pyspark.sql import functions as F
    rows = scenarios.projections(profile(spark, [0.5]), P)
    assert scenarios.recommended_by_flag(rows, F.lit(False)).first().scenario_name == "do_nothing"


def test_planned_curves(spark):
    runs = spark.createDataFrame([("r",)], "run_id string")
    curves = scenarios.roi_curves(scenarios.stage_cost_rows(runs, ROI_STAGES, ROI_STAGE_COSTS), P)
    assert curves.count() == 24
    saved = scenarios.final_savings(curves).first()
    assert (saved.early_cost_usd, saved.late_cost_usd, saved.savings_usd) == (880_000.0, 3_300_000.0, 2_420_000.0)
    last = curves.filter("scenario = 'detect_early' AND stage_sequence = 6").first()
    assert (last.p10_cumulative_usd, last.p90_cumulative_usd) == (809_600.0, 950_400.0)


def test_approximate_summary_is_close(spark):
    df = spark.range(1000).selectExpr("'g' AS g", "CAST(id AS DOUBLE) AS v")
    exact = scenarios.quantile_summary(df, ["g"], "v").first()
    near = scenarios.quantile_summary(df, ["g"], "v", approximate=True).first()
    assert exact.p50 == 499.5 and abs(near.p50 - exact.p50) <= 1


def test_quantiles_of_a_cost_that_falls_with_the_rate(spark):
    """An override may make returns pay: the low end of the cost is then that of the high rates."""
    over = spark.createDataFrame([("r", "do_nothing", -0.5)], "run_id string, name string, brand_factor double")
    rates = [0.0, 0.1, 0.2, 0.5, 1.0]
    row = next(r for r in scenarios.projections(profile(spark, rates), P, over).collect() if r.scenario_name == "do_nothing")
    costs = [1000 * r * 85.0 * -0.5 for r in rates]
    assert row.p10_total_cost_usd == pytest.approx(np.percentile(costs, 10), abs=0.02)
    assert row.p90_total_cost_usd == pytest.approx(np.percentile(costs, 90), abs=0.02)
    assert row.p10_total_cost_usd < row.p50_total_cost_usd < row.p90_total_cost_usd
