"""Lot means with many lots to a bucket."""

from datetime import datetime, timedelta

import pandas as pd

from lotwatch.streaming import live

KIND = "batch_id string, material_lot string, observed_defect_rate double, arrived_at timestamp"


def expected(drops, idle_days):
    known, out = {}, {}
    for drop in drops:
        for batch, lot, rate, at in sorted(drop, key=lambda r: (r[3], r[0])):
            if lot is None:
                out[batch] = rate
                continue
            n, total, last = known.get(lot, (0, 0.0, at))
            if at - last > timedelta(days=idle_days):
                n, total = 0, 0.0
            n, total = n + (rate is not None), total + (rate or 0.0)
            known[lot] = (n, total, at)
            out[batch] = total / n if n else None
    return {k: None if v is None else round(v, 9) for k, v in out.items()}


def test_lots_of_a_bucket_keep_their_own_means(spark, tmp_path):
    day = lambda d: datetime(2024, 1, 1) + timedelta(days=d)
    drops = [[(f"{d}-{i}", None if i % 17 == 0 else f"lot-{i % 7}", None if i % 11 == 0 else (i * 37 + d) % 100 / 100,
               day(d + i % 3)) for i in range(60) if i % 7 or d in (0, 16)] for d in (0, 3, 14, 16)]
    got = {}
    for i, drop in enumerate(drops):
        spark.createDataFrame(drop, KIND).coalesce(1).write.parquet(str(tmp_path / "in" / f"drop-{i}"))
        stream = spark.readStream.schema(KIND).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in" / "*"))
        rows = live.with_lot_rates(stream, "arrived_at", "1 day", 9, buckets=2).select("batch_id", "lot_rate")
        got = {r.batch_id: None if r.lot_rate is None else round(r.lot_rate, 9)
               for r in live.run_to_table(rows, str(tmp_path / "out")).collect()}
    assert got == expected(drops, 9)


def test_one_call_serves_all_lots_of_a_bucket(spark, tmp_path):
    """Lots by the thousand: one state and one timer for them, not one each."""
    calls = {"get": 0, "update": 0, "timers": 0}

    class State:
        value = None

        def get(self):
            calls["get"] += 1
            return self.value

        def update(self, value):
            calls["update"] += 1
            self.value = value

    class Handle:
        def getValueState(self, name, schema):
            return State()

        def registerTimer(self, at):
            calls["timers"] += 1

    names = ["batch_id", "material_lot", "observed_defect_rate", "arrived_at", "lot_rate"]
    mean = live._LotMean("material_lot", "observed_defect_rate", "arrived_at", ["batch_id"], 86_400_000, None, names)
    mean.init(Handle())
    rows = pd.DataFrame({"batch_id": [f"b{i:05}" for i in range(6000)], "material_lot": [f"lot-{i % 3000}" for i in range(6000)],
                         "observed_defect_rate": [0.1] * 3000 + [0.3] * 3000, "arrived_at": pd.Timestamp("2024-01-01")})
    out = pd.concat(mean.handleInputRows((0,), iter([rows[:4000], rows[4000:]]), None))
    assert calls == {"get": 1, "update": 1, "timers": 1}
    assert sorted(round(r, 9) for r in out["lot_rate"]) == [0.1] * 3000 + [0.2] * 3000
