import csv
import os
import time
from datetime import datetime

from pyspark.sql import functions as F

from lotwatch.schemas import FEED_BY_STEM
from lotwatch.params import IngestParams
from lotwatch.plans.stages import RunParams, assess, split
from lotwatch.sources import landing, versions
from lotwatch.sources.tables import read_table
from lotwatch.streaming import live

QC = FEED_BY_STEM["qc_inspection_logs"]
COLUMNS = list(QC.required)


def drop_file(folder, name, units):
    with open(folder / name, "w", newline="") as f:
        writer = csv.writer(f)
        writer.writerow(COLUMNS)
        for i, u in enumerate(units):
            record = dict.fromkeys(COLUMNS, "x") | {"inspection_id": f"{name}-{i}", "units_inspected": u, "defect_count": "1",
                                                     "pass_fail": "PASS"}
            writer.writerow([record[c] for c in COLUMNS])


def test_each_file_is_ingested_once(spark, tmp_path):
    landing, out = tmp_path / "in", str(tmp_path / "out")
    landing.mkdir()

    def run():
        rows = live.landing_stream(spark, str(landing))
        live.ingest(rows, QC, out, "r", "2024-01-01", RunParams(ingest=IngestParams(file_failure_rate=0.6))).awaitTermination()
        count = lambda t: read_table(spark, f"{out}/{t}").count()
        return count(QC.table), count("bad_records"), count("ingest_log")

    drop_file(landing, "a.csv", ["10", "bad"])
    assert run() == (1, 1, 1)
    assert run() == (1, 1, 1)
    drop_file(landing, "b.csv", ["20", "30"])
    assert run() == (3, 1, 2)
    # Columns in another order are read by name; a file without a required one is held back.
    (landing / "c.csv").write_text(",".join(COLUMNS[::-1]) + "\n" + ",".join(
        {"inspection_id": "c", "units_inspected": "40", "defect_count": "2", "pass_fail": "PASS"}.get(c, "x") for c in COLUMNS[::-1]) + "\n")
    (landing / "d.csv").write_text("inspection_id,units_inspected\nd,50\n")
    assert run() == (4, 2, 4)
    row = read_table(spark, f"{out}/{QC.table}").filter("inspection_id = 'c'").first()
    assert (row.units_inspected, row.defect_count) == (40, 2)
    reasons = {r.error_reason for r in spark.read.parquet(f"{out}/bad_records").collect()}
    assert any("'pass_fail'" in r for r in reasons)


def records(folder, name, *pairs, header=COLUMNS):
    with open(folder / name, "w", newline="") as f:
        writer = csv.writer(f)
        writer.writerow(header)
        for key, units in pairs:
            record = dict.fromkeys(COLUMNS, "x") | {"inspection_id": key, "units_inspected": units, "defect_count": "1", "pass_fail": "PASS"}
            writer.writerow([record[c] for c in header])


def test_keys_delivered_again_in_a_later_trigger(spark, tmp_path):
    folder, out = tmp_path / "in", str(tmp_path / "out")
    folder.mkdir()

    def run():
        rows = live.landing_stream(spark, str(folder), files_per_trigger=1)
        live.ingest(rows, QC, out, "r", "2024-01-01", RunParams()).awaitTermination()
        return {r.inspection_id: r.units_inspected for r in read_table(spark, f"{out}/{QC.table}").collect()}

    records(folder, "part-9.csv", ("a", "10"), ("b", "20"))
    os.utime(folder / "part-9.csv", (1_000, 1_000))
    records(folder, "part-10.csv", ("b", "21"), ("c", "30"))
    os.utime(folder / "part-10.csv", (2_000, 2_000))
    assert run() == {"a": 10, "b": 21, "c": 30}
    records(folder, "part-11.csv", ("a", "11"))
    records(folder, "empty.csv")
    (folder / "void.csv").write_text("")
    want = {"a": 11, "b": 21, "c": 30}
    assert run() == want
    log = {r.source_path.rsplit("/", 1)[1]: (r.status, r.rows_written) for r in spark.read.parquet(f"{out}/ingest_log").collect()}
    assert log == {"part-9.csv": ("OK", 2), "part-10.csv": ("OK", 2), "part-11.csv": ("OK", 1), "empty.csv": ("EMPTY", 0)}
    assert sum(r.duplicate_count for r in versions.history(spark, f"{out}/{QC.table}").collect()) == 2
    # The last batch failed after it had committed: it is replayed and leaves the same rows.
    done = sorted((tmp_path / "out" / "_checkpoint" / "commits").glob("[0-9]*"), key=lambda p: int(p.name))
    for p in (done[-1], done[-1].with_name(f".{done[-1].name}.crc")):
        p.unlink(missing_ok=True)
    assert run() == want
    assert read_table(spark, f"{out}/{QC.table}").count() == 3


def test_of_one_batch_the_file_written_last_stays(spark, tmp_path):
    for name, units, at in (("part-10.csv", "20", 2_000), ("part-9.csv", "10", 1_000)):
        records(tmp_path, name, ("k", units))
        os.utime(tmp_path / name, (at, at))
    raw = landing.read_csv(spark, str(tmp_path))
    out = split(assess(raw, QC, RunParams()), QC, "r", "2024-01-01")
    assert [r.units_inspected for r in out.good.collect()] == [20]


def test_headers_read_first_bytes_only(spark, tmp_path):
    with open(tmp_path / "big.csv", "w") as f:
        f.write("a,\"b,c\",d\r\n")
        for _ in range(400):
            f.write("x" * 50_000 + ",1,2\n")
    (tmp_path / "other.csv").write_text("d,a\n")
    (tmp_path / "none.csv").write_text("")
    jvm = spark._jvm.org.apache.hadoop.fs.FileSystem
    read = lambda: sum(s.getBytesRead() for s in jvm.getAllStatistics())
    before = read()
    found = landing.headers(spark, str(tmp_path))
    assert {k: len(v) for k, v in found.items()} == {("a", "b,c", "d"): 1, ("d", "a"): 1}
    assert read() - before < 2_000_000 < (tmp_path / "big.csv").stat().st_size


def test_lot_means_over_triggers_and_a_restart(spark, tmp_path):
    kind = "batch_id string, material_lot string, observed_defect_rate double, arrived_at timestamp"
    day = lambda d: datetime(2024, 1, d)
    drops = [[("a", "x", 0.2, day(1)), ("b", "y", 0.6, day(1)), ("n", None, 0.9, day(1))],
             [("c", "x", 0.4, day(2)), ("d", "x", 0.6, day(2))], [("e", "x", 0.8, day(3))],
             [("z", "w", 0.5, day(28))], [("f", "x", 0.1, day(29)), ("g", "y", 0.2, day(29))]]

    def run():
        stream = spark.readStream.schema(kind).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
        rows = live.with_lot_rates(stream, "arrived_at", "1 day", 20).select("batch_id", "lot_rate")
        return {r.batch_id: None if r.lot_rate is None else round(r.lot_rate, 6) for r in live.run_to_table(rows, str(tmp_path / "out")).collect()}

    got = {}
    for i, drop in enumerate(drops):
        spark.createDataFrame(drop, kind).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        if i in (1, 4):  # two drops, then a restart with the rest
            got = run()
        time.sleep(1.1)
    # Lot x is averaged over triggers and the restart; after weeks without arrivals it starts anew.
    assert got == {"a": 0.2, "b": 0.6, "n": 0.9, "c": 0.3, "d": 0.4, "e": 0.5, "z": 0.5, "f": 0.1, "g": 0.2}


def test_state_store_setting_comes_back(spark):
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name, None)
    with live.durable_state(spark):
        assert "RocksDB" in spark.conf.get(name)
    assert spark.conf.get(name, None) == before


EVENT = "supplier_id string, ts timestamp, defect_count int, units_inspected int"


def event_stream(spark, folder, batches):
    """One file per batch, read one file at a time in the order of their age."""
    for i, batch in enumerate(batches):
        spark.createDataFrame(batch, EVENT).coalesce(1).write.mode("append").parquet(str(folder))
        time.sleep(1.1)
    return spark.readStream.schema(EVENT).option("maxFilesPerTrigger", 1).parquet(str(folder))


def test_weekly_windows_and_late_rows(spark, tmp_path):
    at = lambda d, h=0: datetime(2024, 1, d, h)
    batches = [
        [("S", at(1), 1, 10), ("S", at(7, 23), 3, 10), ("S", at(8), 5, 10)],
        [("S", at(20), 0, 10)],
        # Lateness is judged by the watermark of the batch before, hence one batch more.
        [("S", at(21), 0, 10)],
        [("S", at(2), 9, 10), ("S", at(30), 0, 10)],
    ]
    stream = event_stream(spark, tmp_path / "in", batches)
    out = live.run_to_table(live.weekly_trend(stream, "ts", "2 days", 0.038), str(tmp_path / "out"))
    got = {str(r.production_week): (round(r.weekly_defect_rate, 4), r.inspections) for r in out.collect()}
    assert got == {"2024-01-01": (0.2, 2), "2024-01-08": (0.5, 1), "2024-01-15": (0.0, 2)}


def test_dedup_drops_repeats(spark, tmp_path):
    row = ("S", datetime(2024, 1, 1), 1, 10)
    stream = event_stream(spark, tmp_path / "in", [[row, row], [row]])
    out = live.run_to_table(live.deduplicated(stream, ["supplier_id"], "ts", "1 day"), str(tmp_path / "out"))
    assert out.count() == 1


def test_arrivals_use_lot_averages(spark, tmp_path):
    from lotwatch.params import DetectionParams
    schema = "batch_id string, supplier_id string, line_id string, material_lot string, observed_defect_rate double"
    spark.createDataFrame([("a", "S", "L1", "x", 2.0), ("b", "S", "L1", "y", 2.0), ("c", "T", "L1", "y", 2.0)], schema).write.parquet(str(tmp_path / "in"))
    base = spark.createDataFrame([("S", "L1", 0.0, 1.0)], "supplier_id string, line_id string, mean_rate double, std_rate double")
    risk = spark.createDataFrame([("S", "NORMAL", 0.9)], "supplier_id string, risk_tier string, composite_risk_score double")
    lots = spark.createDataFrame([("x", 0.1)], "material_lot string, lot_avg_rate double")
    stream = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
    rows = live.arrival_alerts(stream, base, risk, DetectionParams(), lots)
    out = live.run_to_table(rows.select("batch_id", "alert_status", F.col("risk_tier")), str(tmp_path / "out"))
    assert {r.batch_id: r.alert_status for r in out.collect()} == {"a": "REVIEW", "b": "FLAGGED", "c": "UNRESOLVED"}
