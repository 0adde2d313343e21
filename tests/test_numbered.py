"""Folds of the order lines move numbers and give the rows of their texts."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from lotwatch.operators import detection, trends
from lotwatch.sources import testdata as D

LINES = ("l_orderkey LONG, l_partkey LONG, l_suppkey LONG, l_linenumber INT, l_quantity DOUBLE, l_discount DOUBLE,"
         " l_returnflag STRING, l_shipdate TIMESTAMP_NTZ")


@pytest.fixture
def lines(rows, tmp_path):
    days = [datetime(1997, 5, 3), datetime(1998, 2, 1), datetime(1998, 2, 9), None]
    data = [(o, 1, s, n, 12.0 + o, 0.05 * n, "RAN"[o % 3], days[(o + n) % 4])
            for o in (1, 2, 3, None) if o for s in (7, 70, None) for n in (1, 2)]
    data += [(None, 1, 7, 1, 20.0, 0.1, "R", days[1]), (1, 1, 7, None, 20.0, 0.1, "R", days[1]), *data[:9]]
    rows(data, LINES).write.parquet(str(tmp_path / "lineitem.parquet"))
    return str(tmp_path)


def same(a, b):
    assert sorted(map(str, a.select(*b.columns).collect())) == sorted(map(str, b.collect()))


def test_batches_and_lots(spark, lines):
    texts = D.inspections(spark, lines)
    carry = {"unit_count": F.sum("units_inspected"), "production_date": F.min("inspection_date")}
    batches = detection.batch_quality(texts, D.PARAMS, carry, ["material_lot"])
    same(D.named(D._numbered_batches(spark, lines, False, None)), batches)
    same(D.lot_rates(spark, lines), trends.lot_rates(batches, D.PARAMS.rate_threshold))
    same(D.dim_batch(spark, lines, since=None), texts.groupBy("batch_id", "supplier_id", "line_id", "material_lot").agg(
        F.sum("units_inspected").alias("unit_count"), F.min("inspection_date").alias("production_date")))
    lots = texts.groupBy(F.col("material_lot").alias("lot_id"), "supplier_id").agg(F.min("inspection_date").cast("timestamp").alias("entered_production_date"))
    same(D.lot_meta(spark, lines).select(*lots.columns), lots)


def test_history(spark, lines):
    texts = D.inspections(spark, lines, before=D.CUTOVER).groupBy(
        "supplier_id", "line_id", F.trunc("inspection_date", "month").alias("month")).agg(F.sum("units_inspected").alias("units_inspected"))
    same(D.history(spark, lines).select(*texts.columns), texts)


def test_texts_come_after_the_fold(spark, lines):
    for df in (D.dim_batch(spark, lines), D.named(D._numbered_batches(spark, lines, False, None)), D.lot_meta(spark, lines), D.history(spark, lines)):
        steps = df._jdf.queryExecution().optimizedPlan().toString().splitlines()
        fold = next(i for i, step in enumerate(steps) if "Aggregate [" in step)
        assert any("concat" in step for step in steps[:fold + 1])
        assert not any("concat" in step for step in steps[fold + 1:])
