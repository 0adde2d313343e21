"""Registered queries: landing files, validation and table writes."""

from __future__ import annotations

from pyspark.sql import functions as F

from lotwatch.functions.scalars import to_bool
from lotwatch.operators import constraints, validation as V
from lotwatch.params import Domains, IngestParams
from lotwatch.plans.present import present
from lotwatch.plans.registry import query
from lotwatch.plans.sqlparts import part, with_parts
from lotwatch.plans.stages import RunParams, assess, ingest
from lotwatch.schemas import FEED_BY_STEM
from lotwatch.session import landed, scratch_path
from lotwatch.sources import export, feeds, landing, tables, versions
from lotwatch.sources import testdata as D

QC = FEED_BY_STEM["qc_inspection_logs"]
DOMAINS = Domains(skus=tuple(f"SKU-{i}" for i in range(1, 6)), lines=("L1", "L2", "L3", "L4"),
                  channels=("1-URGENT", "2-HIGH", "3-MEDIUM"))
AT = "2024-02-01 00:00:00"

part("qc", "", feeds.QC_SQL)
part("qct", "qc", feeds.QC_TYPED_SQL)
part("rawb", "", feeds.RAW_BATCHES_SQL)


@query("csv_landing_read", with_parts("qc", "SELECT * FROM qc"))
def csv_landing_read(spark, sf):
    rows = landing.read_csv(spark, feeds.qc_folder(spark, sf))
    return rows.select(*feeds.QC_COLUMNS, "flag")


@query("json_array_read", """
SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, c_mktsegment,
       CAST(c_acctbal AS DOUBLE) AS c_acctbal FROM customer""")
def json_array_read(spark, sf):
    rows = landing.read_json(spark, feeds.customer_arrays(spark, sf),
                             ["c_custkey", "c_name", "c_acctbal", "c_mktsegment"])
    return rows.select("c_custkey", "c_name", "c_mktsegment", F.col("c_acctbal").cast("double"))


_STEMS = ("CASE o_orderpriority WHEN '1-URGENT' THEN 'Manufacturing_Batches' WHEN '2-HIGH' THEN 'qc_inspection_logs_new' "
          "WHEN '3-MEDIUM' THEN 'weekly_sales_returns' WHEN '4-NOT SPECIFIED' THEN 'supplier_manifest' ELSE 'readme' END")


@query("route_files", f"""
SELECT path AS source_path, feed, CASE feed WHEN 'manufacturing_batches' THEN 'dim_batch' WHEN 'qc_inspection_logs' THEN 'fact_qc_inspections'
   WHEN 'sales_returns' THEN 'fact_sales_returns' WHEN 'supplier_manifest' THEN 'dim_supplier' END AS table_name,
   CASE WHEN feed IS NULL THEN 'SKIPPED' ELSE 'ROUTED' END AS status
FROM (SELECT '/landing/' || {_STEMS} || '_' || o_orderkey || '.csv' AS path,
             CASE o_orderpriority WHEN '1-URGENT' THEN 'manufacturing_batches' WHEN '2-HIGH' THEN 'qc_inspection_logs'
                  WHEN '3-MEDIUM' THEN 'sales_returns' WHEN '4-NOT SPECIFIED' THEN 'supplier_manifest' END AS feed FROM orders)""")
def route_files(spark, sf):
    paths = D.table(spark, sf, "orders").select(
        F.expr(f"concat('/landing/', {_STEMS}, '_', o_orderkey, '.csv')").alias("source_path"))
    return landing.routed_files(paths)


@query("new_landing_files", "SELECT DISTINCT l_returnflag AS flag FROM lineitem WHERE l_returnflag <> 'A'")
def new_landing_files(spark, sf):
    listing = landing.list_files(spark, feeds.qc_folder(spark, sf))
    seen = listing.filter(F.col("source_path").contains("/flag=A/"))
    fresh = landing.new_files(listing, seen)
    return fresh.select(F.regexp_extract("source_path", "/flag=([A-Z])/", 1).alias("flag")).distinct()


@query("rerun_keeps_table", """
SELECT 'run-1' AS run_id, count(*) AS row_count, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS units FROM lineitem
UNION ALL SELECT 'run-2', count(*), CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) FROM lineitem""")
def rerun_keeps_table(spark, sf):
    path = scratch_path(spark, "rerun")
    rows = D.inspections(spark, sf).select("inspection_id", "units_inspected")
    for run in ("run-1", "run-1", "run-2"):
        tables.write_run(rows, path, run, AT)
    return present(tables.read_table(spark, path).groupBy("run_id").agg(
        F.count(F.lit(1)).alias("row_count"), F.sum("units_inspected").alias("units")))


@query("upsert_by_key", """
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_partkey, l_suppkey, l_quantity, CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS l_shipdate
FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
             ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC) AS n FROM lineitem) WHERE n = 1""")
def upsert_by_key(spark, sf):
    lines = D.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
        F.col("l_shipdate").cast("date").alias("l_shipdate"))
    old = lines.filter(F.col("l_shipdate") < D.CUTOVER)
    new = lines.filter(F.col("l_shipdate") >= D.CUTOVER)
    return present(tables.upsert(old, new, ["l_orderkey", "l_linenumber"],
                                 ["l_shipdate", "l_partkey", "l_suppkey", "l_quantity"]))


@query("filtered_table_read", """
SELECT l_orderkey, l_quantity, l_returnflag FROM lineitem WHERE l_quantity > 45 AND l_shipdate >= TIMESTAMP '2000-01-01'""")
def filtered_table_read(spark, sf):
    return tables.read_table(
        spark, f"{sf}/lineitem.parquet",
        "l_quantity > 45 AND l_shipdate >= TIMESTAMP_NTZ '2000-01-01 00:00:00'",
    ).select("l_orderkey", "l_quantity", "l_returnflag")


_TYPE_REASON = ("CASE WHEN defect_count IS NULL THEN 'Type coercion failure: defect_count' "
                "WHEN units_inspected IS NULL THEN 'Type coercion failure: units_inspected' END")


@query("quarantine_rows", with_parts("qct", f"""
SELECT inspection_id, raw_units AS units_text, raw_defects AS defects_text, {_TYPE_REASON} AS error_reason, 'run-1' AS run_id
FROM qct WHERE defect_count IS NULL OR units_inspected IS NULL"""))
def quarantine_rows(spark, sf):
    _, bad = V.coerce(landing.read_csv(spark, feeds.qc_folder(spark, sf)), QC.types)
    stored = tables.quarantine(bad, run_id=D.RUN_ID, at=AT)
    field = lambda name: F.get_json_object("payload", f"$.{name}")
    return stored.select(
        field("inspection_id").alias("inspection_id"), field("units_inspected").alias("units_text"),
        field("defect_count").alias("defects_text"), "error_reason", "run_id")


@query("ingest_log", with_parts("qct", """
SELECT flag, 'fact_qc_inspections' AS table_name, 'OK' AS status,
       count(*) FILTER (defect_count IS NOT NULL AND units_inspected IS NOT NULL) AS rows_written,
       count(*) FILTER (defect_count IS NULL OR units_inspected IS NULL) AS rows_quarantined FROM qct GROUP BY 1"""))
def ingest_log(spark, sf):
    rows = landing.read_csv(spark, feeds.qc_folder(spark, sf))
    bad = V.coercion_error(rows, QC.types).isNotNull()
    log = tables.ingest_log(rows.withColumn("is_bad", bad), QC.table, D.RUN_ID, AT)
    flag = F.regexp_extract("source_path", "/flag=([A-Z])/", 1).alias("flag")
    return present(log.groupBy(flag, "table_name", "status").agg(
        F.sum("rows_written").alias("rows_written"), F.sum("rows_quarantined").alias("rows_quarantined")))


RULED_REASON = f"""coalesce({_TYPE_REASON}, nullif(array_to_string(list_filter([
  CASE WHEN defect_count < 0 THEN 'defect_count:negative' END,
  CASE WHEN pass_fail NOT IN ('PASS', 'REVIEW', 'FAIL') THEN 'valid_pass_fail' END,
  CASE WHEN defect_count > units_inspected THEN 'defect_count_le_units' END,
  CASE WHEN units_inspected < 10 THEN 'min_units_inspected' END], lambda x: x IS NOT NULL), ', '), ''))"""


@query("missing_column_file", "SELECT 'Missing required columns: [''pass_fail'']' AS error_reason, count(*) AS row_count FROM lineitem")
def missing_column_file(spark, sf):
    rows = landing.read_csv(spark, feeds.qc_folder(spark, sf)).drop("pass_fail")
    rejected = assess(rows, QC, RunParams(domains=DOMAINS))
    return rejected.groupBy("error_reason").agg(F.count(F.lit(1)).alias("row_count"))


@query("mixed_headers", with_parts("qct", """
SELECT flag, count(*) AS row_count, CAST(sum(units_inspected) AS BIGINT) AS units, CAST(sum(defect_count) AS BIGINT) AS defects,
       count(*) FILTER (flag = 'R') AS short_rows, CASE WHEN flag = 'R' THEN 'QUARANTINED' ELSE 'OK' END AS status
FROM qct GROUP BY flag"""))
def mixed_headers(spark, sf):
    """A full, a reordered and a short file in one folder: each read by its own header."""
    rows = assess(landing.read_csv(spark, f"{feeds.mixed_folder(spark, sf)}/*"), QC, RunParams(domains=DOMAINS))
    log = tables.ingest_log(rows.withColumn("is_bad", F.col("error_reason").isNotNull()), QC.table, D.RUN_ID, AT)
    flag = F.regexp_extract("source_path", "/([ANR])/[^/]*$", 1).alias("flag")
    totals = rows.groupBy(flag).agg(
        F.count(F.lit(1)).alias("row_count"), F.sum("units_inspected").alias("units"), F.sum("defect_count").alias("defects"),
        F.count_if(F.col("error_reason") == "Missing required columns: ['pass_fail']").alias("short_rows"))
    return totals.join(log.groupBy(flag).agg(F.max("status").alias("status")), "flag")


part("twice", "qc", feeds.REDELIVERED_SQL)
# Good rows of both drops; of a key, the row of the last drop and file stays.
part("ruled", "twice", f"SELECT *, {RULED_REASON} AS reason FROM twice")
part("perkey", "ruled", """
SELECT * EXCLUDE (n) FROM (SELECT *, row_number() OVER (PARTITION BY delivery, inspection_id ORDER BY flag DESC, batch_id DESC,
  supplier_id DESC, line_id DESC, inspection_date DESC, units_inspected DESC, defect_count DESC) AS n FROM ruled WHERE reason IS NULL) WHERE n = 1""")


def redelivered(spark, sf):
    """A first run, a second that delivers keys of the first again, and the first run repeated,
    which must leave the second run's rows alone. Both queries below read the one table."""
    def write(root):
        folder = feeds.redelivered_folder(spark, sf)
        for run, drop in (("run-1", "first"), ("run-2", "second"), ("run-1", "first")):
            raw = landing.read_csv(spark, f"{folder}/{drop}").drop("flag")
            ingest(raw, QC, root, run, AT, RunParams(domains=DOMAINS))

    return f"{landed(spark, sf, 'redelivered-runs', write)}/silver/{QC.table}"


@query("redelivered_keys", with_parts("perkey", """
SELECT 'run-' || delivery AS run_id, count(*) AS row_count, CAST(sum(units_inspected) AS BIGINT) AS units FROM perkey
WHERE delivery = 2 OR inspection_id NOT IN (SELECT inspection_id FROM perkey WHERE delivery = 2) GROUP BY 1"""))
def redelivered_keys(spark, sf):
    return tables.read_table(spark, redelivered(spark, sf)).groupBy("run_id").agg(
        F.count(F.lit(1)).alias("row_count"), F.sum("units_inspected").alias("units"))


part("tally", "perkey", """
SELECT count(*) FILTER (delivery = 1) AS one, count(*) FILTER (delivery = 2) AS two,
  (SELECT count(*) FROM (SELECT inspection_id FROM perkey GROUP BY 1 HAVING count(*) = 2)) AS again,
  (SELECT coalesce(string_agg(inspection_id, ',' ORDER BY inspection_id), '') FROM (
     SELECT inspection_id FROM perkey GROUP BY 1 HAVING count(*) = 2 ORDER BY 1 LIMIT 20)) AS ids FROM perkey""")


@query("ingest_commits", with_parts("tally", """
SELECT 1::BIGINT AS version, 'run-1' AS run_id, one AS rows_written, 0::BIGINT AS duplicate_count, '' AS duplicate_ids, 0::BIGINT AS parts_read FROM tally
UNION ALL SELECT 2, 'run-2', two, again, ids, 1 FROM tally
UNION ALL SELECT 3, 'run-1', one - again, again, ids, 1 FROM tally"""))
def ingest_commits(spark, sf):
    """What each commit wrote, the keys it delivered again and the parts it had to read."""
    return present(versions.history(spark, redelivered(spark, sf)).drop("committed_at"))


@query("coerced_rows", with_parts("qct", """
SELECT inspection_id, units_inspected, defect_count FROM qct WHERE defect_count IS NOT NULL AND units_inspected IS NOT NULL"""))
def coerced_rows(spark, sf):
    good, _ = V.coerce(landing.read_csv(spark, feeds.qc_folder(spark, sf)), QC.types)
    return good.select("inspection_id", "units_inspected", "defect_count")


_WORDS = ("CASE o_orderpriority WHEN '1-URGENT' THEN ' TRUE' WHEN '2-HIGH' THEN '0' WHEN '3-MEDIUM' THEN 'Yes' "
          "WHEN '4-NOT SPECIFIED' THEN 'maybe' ELSE 'no ' END")


@query("boolean_words", """
SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN TRUE WHEN '2-HIGH' THEN FALSE WHEN '3-MEDIUM' THEN TRUE
       WHEN '4-NOT SPECIFIED' THEN NULL ELSE FALSE END AS flag FROM orders""")
def boolean_words(spark, sf):
    return D.table(spark, sf, "orders").select("o_orderkey", to_bool(F.expr(_WORDS)).alias("flag"))


_GOOD_QC = "(SELECT * FROM qct WHERE defect_count IS NOT NULL AND units_inspected IS NOT NULL)"


def _report_sql(source: str, rules: dict[str, str]) -> str:
    any_rule = " OR ".join(f"({r})" for r in rules.values())
    totals = f"SELECT count(*) AS t, count(*) FILTER ({any_rule}) AS i FROM {source}"
    return " UNION ALL ".join(
        f"SELECT '{name}' AS rule, (SELECT count(*) FROM {source} WHERE {cond}) AS violations, t AS total_rows, "
        f"i AS invalid_rows, round(i::DOUBLE / greatest(t, 1), 4) AS failure_rate FROM ({totals})"
        for name, cond in rules.items())


@query("null_and_range_rules", with_parts("qct", _report_sql("qct", {
    "inspection_id:null_value": "inspection_id IS NULL", "batch_id:null_value": "batch_id IS NULL",
    "defect_count:null_value": "defect_count IS NULL", "units_inspected:null_value": "units_inspected IS NULL",
    "defect_count:negative": "defect_count < 0"})))
def null_and_range_rules(spark, sf):
    rows = landing.read_csv(spark, feeds.qc_folder(spark, sf))
    typed = rows.withColumns({c: V._CASTS[k](c) for c, k in QC.types.items()})
    rules = {**V.not_null_rules(QC.not_null), **V.range_rules(typed.columns)}
    return present(V.rule_report(typed, rules))


@query("inspection_rules", with_parts("qct", _report_sql(_GOOD_QC, {
    "valid_pass_fail": "pass_fail NOT IN ('PASS', 'REVIEW', 'FAIL')",
    "defect_count_le_units": "defect_count > units_inspected", "min_units_inspected": "units_inspected < 10"})))
def inspection_rules(spark, sf):
    good, _ = V.coerce(landing.read_csv(spark, feeds.qc_folder(spark, sf)), QC.types)
    return present(V.rule_report(good, V.business_rules(QC.stem, DOMAINS)))


@query("batch_rules", with_parts("rawb", _report_sql("rawb", {
    "valid_line_id": "line_id NOT IN ('L1', 'L2', 'L3', 'L4')",
    "unit_count_range": "unit_count < 100 OR unit_count > 5000",
    "valid_sku": "sku NOT IN ('SKU-1', 'SKU-2', 'SKU-3', 'SKU-4', 'SKU-5')"})))
def batch_rules(spark, sf):
    return present(V.rule_report(feeds.raw_batches(spark, sf),
                                 V.business_rules("manufacturing_batches", DOMAINS)))


@query("sales_rules", with_parts("sales", _report_sql("sales", {
    "returns_le_sold": "units_returned > units_sold", "positive_revenue": "revenue_usd <= 0",
    "valid_channel": "channel NOT IN ('1-URGENT', '2-HIGH', '3-MEDIUM')"})))
def sales_rules(spark, sf):
    return present(V.rule_report(D.sales_returns(spark, sf), V.business_rules("sales_returns", DOMAINS)))


@query("failed_rules_per_row", with_parts("rawb", """
SELECT batch_id, array_to_string(list_filter([CASE WHEN line_id NOT IN ('L1', 'L2', 'L3', 'L4') THEN 'valid_line_id' END,
  CASE WHEN unit_count < 100 OR unit_count > 5000 THEN 'unit_count_range' END,
  CASE WHEN sku NOT IN ('SKU-1', 'SKU-2', 'SKU-3', 'SKU-4', 'SKU-5') THEN 'valid_sku' END], lambda x: x IS NOT NULL), ',') AS failed_rules
FROM rawb"""))
def failed_rules_per_row(spark, sf):
    rows = V.check_rows(feeds.raw_batches(spark, sf), V.business_rules("manufacturing_batches", DOMAINS))
    return present(rows, "batch_id", "failed_rules")


@query("duplicate_keys", """
WITH d AS (SELECT CAST(l_orderkey AS VARCHAR) AS k FROM lineitem
           WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F'))
SELECT (SELECT count(*) FROM lineitem) AS total_rows, (SELECT count(*) FROM d) AS duplicate_count,
       (SELECT string_agg(k, ',' ORDER BY k) FROM (SELECT k FROM d ORDER BY k LIMIT 20)) AS duplicate_ids""")
def duplicate_keys(spark, sf):
    incoming = D.table(spark, sf, "lineitem").select(F.col("l_orderkey").cast("string").alias("k"))
    stored = D.table(spark, sf, "orders").filter(F.col("o_orderstatus") == "F").select(
        F.col("o_orderkey").cast("string").alias("k"))
    return present(V.duplicate_report(incoming, stored, "k"))


@query("file_gate", with_parts("insp", """
SELECT supplier_id, count(*) AS row_count, count(*) FILTER (units_inspected < 15) AS invalid_rows,
       count(*) FILTER (units_inspected < 15)::DOUBLE / count(*) > 0.30 AS file_quarantined FROM insp GROUP BY 1"""))
def file_gate(spark, sf):
    rows = D.inspections(spark, sf)
    small = F.col("units_inspected") < 15
    gated = V.gate_files(rows, small, IngestParams(), source="supplier_id")
    return gated.groupBy("supplier_id", "file_quarantined").agg(
        F.count(F.lit(1)).alias("row_count"), F.count_if(small).alias("invalid_rows"))


@query("assessed_rows", with_parts("qct", f"""
SELECT inspection_id, {RULED_REASON} AS error_reason FROM qct"""))
def assessed_rows(spark, sf):
    rows = landing.read_csv(spark, feeds.qc_folder(spark, sf))
    return assess(rows, QC, RunParams(domains=DOMAINS)).select("inspection_id", "error_reason")


@query("export_csv", with_parts("alerts", """
SELECT batch_id, alert_status, observed_defect_rate, anomaly_score, CAST(production_date AS VARCHAR) AS production_date FROM alerts"""))
def export_csv(spark, sf):
    path = scratch_path(spark, "export")
    export.export_csv(D.alerts(spark, sf), path)
    back = spark.read.option("header", True).csv(path)
    return back.select("batch_id", "alert_status", F.col("observed_defect_rate").cast("double"),
                       F.col("anomaly_score").cast("double"), "production_date")


@query("labels_stripped", with_parts("lotmeta", "SELECT lot_id, supplier_id, material_type, hours_to_first_alert FROM lotmeta"))
def labels_stripped(spark, sf):
    rows = landing.strip_labels(D.lot_meta(spark, sf))
    return rows.drop("entered_production_date", "defect_root_cause")


@query("unique_test", """
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, count(*) AS copies FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1""")
def unique_test(spark, sf):
    return present(constraints.unique_violations(D.table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"]))


@query("not_null_test", with_parts("qct", """
SELECT 'defect_count' AS column_name, count(*) FILTER (defect_count IS NULL) AS violations FROM qct
UNION ALL SELECT 'units_inspected', count(*) FILTER (units_inspected IS NULL) FROM qct"""))
def not_null_test(spark, sf):
    rows = landing.read_csv(spark, feeds.qc_folder(spark, sf))
    typed = rows.withColumns({c: V._CASTS[k](c) for c, k in QC.types.items()})
    return constraints.null_counts(typed, ["defect_count", "units_inspected"])


@query("accepted_values_test", with_parts("qc", """
SELECT pass_fail AS value, count(*) AS violations FROM qc WHERE pass_fail NOT IN ('PASS', 'REVIEW', 'FAIL') GROUP BY 1"""))
def accepted_values_test(spark, sf):
    return constraints.unaccepted_values(feeds.qc_rows(spark, sf), "pass_fail", DOMAINS.verdicts)


@query("relationships_test", """
SELECT l_orderkey, count(*) AS violations FROM lineitem
WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P') GROUP BY 1""")
def relationships_test(spark, sf):
    done = D.table(spark, sf, "orders").filter(F.col("o_orderstatus") != "P")
    return constraints.orphans(D.table(spark, sf, "lineitem"), "l_orderkey", done, "o_orderkey")


@query("constraint_suite", with_parts("alerts risk", """
SELECT 'not_null(batch_id)' AS test, count(*) FILTER (batch_id IS NULL) AS violations FROM alerts
UNION ALL SELECT 'not_null(anomaly_score)', count(*) FILTER (anomaly_score IS NULL) FROM alerts
UNION ALL SELECT 'accepted_values(alert_status)', count(*) FILTER (alert_status NOT IN ('FLAGGED', 'REVIEW', 'NORMAL')) FROM alerts
UNION ALL SELECT 'unique(batch_id)', count(*) - count(DISTINCT batch_id) FROM alerts
UNION ALL SELECT 'relationships(supplier_id)', count(*) FROM alerts WHERE supplier_id NOT IN (SELECT supplier_id FROM risk WHERE risk_tier = 'NORMAL')"""))
def constraint_suite(spark, sf):
    normal = D.risk_scores(spark, sf).filter(F.col("risk_tier") == "NORMAL")
    return present(constraints.suite(
        D.alerts(spark, sf), unique=[["batch_id"]], not_null=["batch_id", "anomaly_score"],
        accepted={"alert_status": ["FLAGGED", "REVIEW", "NORMAL"]},
        relationships={"supplier_id": (normal, "supplier_id")}))
