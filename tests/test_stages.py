from pyspark.sql import functions as F

from lotwatch.params import DetectionParams, Domains
from lotwatch.plans import stages
from lotwatch.schemas import FEED_BY_STEM
from lotwatch.sources import export, feeds, landing
from lotwatch.sources import testdata as D
from lotwatch.sources.tables import read_table

AT = "2024-01-01 00:00:00"


def digest(df):
    cols = [F.coalesce(F.col(c).cast("string"), F.lit("-")) for c in sorted(df.columns)]
    return df.agg(F.count(F.lit(1)), F.sum(F.xxhash64(*cols).cast("decimal(38,0)"))).first()


def test_run_twice_leaves_the_same_tables(spark, sf, tmp_path):
    params = stages.RunParams(detection=DetectionParams(min_units=10), rootcause=D.RCA)
    digests = []
    for _ in range(2):
        gold = stages.build_gold(
            D.watched(spark, sf, with_type=True), D.dim_batch(spark, sf), D.history(spark, sf), D.risk_scores(spark, sf),
            D.lot_meta(spark, sf), D.sales_returns(spark, sf), D.stage_costs(spark, sf).drop("created_at"), "run-1", AT, params)
        stages.write_gold(gold, str(tmp_path), "run-1", AT)
        digests.append({n: digest(stages.read_gold(spark, str(tmp_path), n)) for n in gold.tables()})
    assert digests[0] == digests[1]
    assert all(d[0] > 0 for d in digests[0].values())


def test_ingest_routes_good_and_bad_rows(spark, sf, tmp_path):
    feed = FEED_BY_STEM["qc_inspection_logs"]
    params = stages.RunParams(domains=Domains())
    raw = landing.read_csv(spark, feeds.qc_folder(spark, sf)).drop("flag")
    total = raw.count()
    for _ in range(2):
        stages.ingest(raw, feed, str(tmp_path), "run-1", AT, params)
    read = lambda p: read_table(spark, f"{tmp_path}/silver/{p}")
    good, bad, log = read(feed.table), read(f"bad_records/{feed.table}"), read(f"ingest_log/{feed.table}")
    rows = stages.assess(raw, feed, params).filter("error_reason IS NULL")
    # One row per key is stored; the log counts what each file delivered.
    assert good.count() == rows.select(*feed.key).distinct().count() and bad.count() > 0
    assert log.agg(F.sum("rows_written"), F.sum("rows_quarantined")).first() == (rows.count(), bad.count())
    assert rows.count() + bad.count() == total
    assert dict(good.dtypes)["units_inspected"] == "bigint"
    assert bad.filter("payload IS NULL OR error_reason IS NULL").count() == 0


def test_file_without_a_required_column_is_held_back(spark, sf):
    feed = FEED_BY_STEM["qc_inspection_logs"]
    raw = landing.read_csv(spark, feeds.qc_folder(spark, sf)).drop("pass_fail")
    assert {r.error_reason for r in stages.assess(raw, feed, stages.RunParams()).select("error_reason").distinct().collect()} == {
        "Missing required columns: ['pass_fail']"}


def test_exports(spark, sf, tmp_path):
    tables = {
        "weekly_defect_trend": export.trend_extract(D.weekly(spark, sf), 0.038),
        "supplier_risk_scores": export.risk_extract(
            D.risk_scores(spark, sf), D.RISK.dimensions, D.dim_supplier(spark, sf), AT),
        "lot_traceability": export.traceability_extract(D.traceability(spark, sf)),
        "rca_findings": D.findings(spark, sf),
    }
    export.export_all(tables, str(tmp_path), "run-1", AT, spark)
    for name, df in tables.items():
        assert spark.read.option("header", True).csv(f"{tmp_path}/{name}").count() == df.count()
    assert spark.read.json(f"{tmp_path}/_refresh").first().run_id == "run-1"


def test_intermediate_tables_live_in_one_removable_folder(spark):
    from lotwatch import session

    path = session.scratch_path(spark, "x")
    assert path.startswith(session.run_folder(spark)) and spark.sparkContext.applicationId in path
