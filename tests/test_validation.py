from pyspark.sql import functions as F

from lotwatch.functions import scalars as S
from lotwatch.operators import constraints, validation as V
from lotwatch.params import Domains, IngestParams
from lotwatch.schemas import FEED_BY_STEM
from lotwatch.sources import landing, tables


def test_whole_numbers_from_text(rows):
    df = rows([("12",), (" 12 ",), ("12.7",), ("-12.7",), ("abc",), ("",), (None,), ("nan",), ("1e400",)], "u string")
    got = [r[0] for r in df.select(S.to_long("u")).collect()]
    assert got == [12, 12, 12, -12, None, None, None, None, None]


def test_booleans(rows):
    df = rows([("true",), ("0",), ("Yes",), ("maybe",), (None,)], "b string")
    assert [r[0] for r in df.select(S.to_bool("b")).collect()] == [True, False, True, None, None]


def test_first_failing_column_is_the_reason(rows):
    feed = FEED_BY_STEM["qc_inspection_logs"]
    df = rows([("x", "y"), ("1", "y"), ("1", "2")], "defect_count string, units_inspected string")
    good, bad = V.coerce(df, feed.types)
    assert good.count() == 1
    reasons = sorted(r.error_reason for r in bad.collect())
    assert reasons == ["Type coercion failure: defect_count", "Type coercion failure: units_inspected"]
    assert {r.defect_count for r in bad.collect()} == {"x", "1"}


def test_unparsed_boolean_is_kept(rows):
    good, bad = V.coerce(rows([("L", "maybe")], "lot_id string, is_defective string"), {"is_defective": "bool"})
    assert good.first().is_defective is None and bad.count() == 0


def test_null_passes_ranges_but_not_membership(rows):
    df = rows([(None, None, None), (50, "L1", "A"), (200, "L9", "A")], "unit_count int, line_id string, sku string")
    checked = V.check_rows(df, V.business_rules("manufacturing_batches", Domains(skus=("A",))))
    assert [r.failed_rules for r in checked.collect()] == [
        ["valid_line_id", "valid_sku"], ["unit_count_range"], ["valid_line_id"]]
    ranges = V.range_rules(["unit_count"])
    assert V.rule_report(df, ranges).first().violations == 0


def test_rate_ranges(rows):
    df = rows([(-0.1, 0.5), (0.0, 1.0), (1.0, 1.1), (None, None)], "defect_rate double, return_rate double")
    got = {r.rule: r.violations for r in V.rule_report(df, V.range_rules(df.columns)).collect()}
    assert got == {"defect_rate:out_of_range_0_1": 1, "return_rate:out_of_range_0_1": 1}


def test_unknown_feed_has_no_rules(rows):
    df = rows([(1,)], "a int")
    assert V.check_rows(df, V.business_rules("other", Domains())).first().failed_rules == []


def test_file_gate_is_strict(rows):
    data = [("at", i < 30) for i in range(100)] + [("over", i < 31) for i in range(100)]
    gated = V.gate_files(rows(data, "source_path string, bad boolean"), F.col("bad"), IngestParams())
    held = {r.source_path: r.file_quarantined for r in gated.distinct().collect()}
    assert held == {"at": False, "over": True}
    assert gated.count() == 200


def test_duplicate_preview(rows):
    incoming = rows([(f"k{i % 30:02d}",) for i in range(60)] + [("new",)], "k string")
    stored = rows([(f"k{i:02d}",) for i in range(30)], "k string")
    report = V.duplicate_report(incoming, stored, "k").first()
    assert (report.total_rows, report.duplicate_count) == (61, 60)
    assert report.duplicate_ids == [f"k{i // 2:02d}" for i in range(20)]
    none = V.duplicate_report(incoming, stored.filter("k = 'zz'"), "k").first()
    assert (none.duplicate_count, none.duplicate_ids) == (0, [])


def test_constraints(rows):
    df = rows([("a", 1), ("a", 2), (None, 3)], "k string, v int")
    parent = rows([("b",)], "k string")
    got = {r.test: r.violations for r in constraints.suite(
        df, unique=[["k"]], not_null=["k"], accepted={"k": ["b"]}, relationships={"k": (parent, "k")}).collect()}
    assert got == {"not_null(k)": 1, "accepted_values(k)": 2, "unique(k)": 1, "relationships(k)": 2}


def test_routes(rows):
    paths = ["/in/Manufacturing_Batches_2024.csv", "/in/x.sales_returns.json", "/in/readme.csv", "/in/material_lots.csv/"]
    got = landing.routed_files(rows([(p,) for p in paths], "source_path string")).collect()
    assert [r.table_name for r in got] == ["dim_batch", "fact_sales_returns", None, "material_lots"]
    assert [r.status for r in got] == ["ROUTED", "ROUTED", "SKIPPED", "ROUTED"]


def test_json_array_and_lines(spark, tmp_path):
    (tmp_path / "a.json").write_text('[{"a": 1, "b": "x"}, {"a": null}]')
    (tmp_path / "b.jsonl").write_text('{"a": 2.5, "b": true}\n{"b": "y"}\n')
    array = landing.read_json(spark, str(tmp_path / "a.json"), ["a", "b"]).select("a", "b").collect()
    lines = landing.read_json(spark, str(tmp_path / "b.jsonl"), ["a", "b"], multi_line=False).select("a", "b").collect()
    assert [tuple(r) for r in array] == [("1", "x"), (None, None)]
    assert [tuple(r) for r in lines] == [("2.5", "true"), (None, "y")]


def test_listing_skips_other_suffixes_and_logged_files(spark, tmp_path):
    for name in ("a.csv", "b.json", "c.txt"):
        (tmp_path / name).write_text("x\n1\n")
    listing = landing.list_files(spark, str(tmp_path))
    assert listing.count() == 2
    seen = listing.filter(F.col("source_path").endswith("a.csv"))
    assert [r[0].rsplit("/", 1)[1] for r in landing.new_files(listing, seen).collect()] == ["b.json"]


def test_quarantine_keeps_nulls(rows):
    bad = rows([("1", None, "why", "f.csv")], "a string, b string, error_reason string, source_path string")
    out = tables.quarantine(bad, run_id="r", at="2024-01-01").first()
    assert (out.payload, out.error_reason, out.source_file) == ('{"a":"1","b":null}', "why", "f.csv")


def test_rerun_replaces_only_its_own_run(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    df = rows([(1,), (2,)], "a int")
    for run in ("r1", "r2", "r1"):
        tables.write_run(df, path, run, "2024-01-01")
    assert {r.run_id: r["count"] for r in spark.read.parquet(path).groupBy("run_id").count().collect()} == {"r1": 2, "r2": 2}
    tables.write_run(df, path, "r3", "2024-01-01", mode="overwrite")
    assert [r.run_id for r in spark.read.parquet(path).select("run_id").distinct().collect()] == ["r3"]


def test_catalogue_tables(spark, tmp_path):
    from lotwatch.schemas import GOLD, SILVER, schema_of
    spark.sql(f"CREATE DATABASE qa_silver LOCATION '{tmp_path}/s'")
    tables.create_tables(spark, "qa_silver", {**SILVER, **GOLD})
    made = {r.tableName for r in spark.sql("SHOW TABLES IN qa_silver").collect()}
    assert made == set(SILVER) | set(GOLD)
    have = {f.name: f.dataType for f in spark.table("qa_silver.rca_findings").schema}
    assert have == {f.name: f.dataType for f in schema_of("rca_findings")}
    spark.sql("DROP DATABASE qa_silver CASCADE")
