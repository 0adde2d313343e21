"""Time headline queries; prints one JSON line.

BENCH_SF_DIR picks the data, BENCH_CPUS the cores, BENCH_RUNS the repeats (median is kept).
Each timed run computes the full result and writes it to the no-op sink. Landing files and stored
tables that several queries read are built first, under names of their own.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from lotwatch.plans.catalog import QUERIES
from lotwatch.session import build_session
from lotwatch.sources import feeds, testdata

HEADLINE = [
    "batch_alerts", "supplier_baselines", "weekly_defect_trend", "lot_defect_rates",
    "first_crossing_supplier", "production_conditions", "fact_qc_inspections",
    "fact_sales_returns", "supplier_defect_history", "inspection_rules", "assessed_rows",
    "upsert_by_key", "outlier_screen", "evidence_bundle", "rca_findings", "lot_traceability",
    "return_rate_variants", "quantile_summary", "roi_curves", "claim_audit", "claims_against_table",
    "stream_weekly_trend",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    names = sys.argv[1:] or HEADLINE
    spark = build_session("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false",
        "spark.driver.memory": os.environ.get("BENCH_MEMORY", "8g"),
        "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> float:
        started = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - started

    # One small pass starts the JVM's code paths and Python workers.
    spark.read.parquet(f"{sf_dir}/lineitem.parquet").groupBy("l_suppkey").count().write.format(
        "noop").mode("overwrite").save()
    shared = {
        "qc_folder": lambda: feeds.qc_folder(spark, sf_dir), "alerts": lambda: testdata.alerts(spark, sf_dir),
        "lot_rates": lambda: testdata.lot_rates(spark, sf_dir), "findings": lambda: testdata.findings(spark, sf_dir),
        "weekly": lambda: testdata.weekly(spark, sf_dir)}
    fixtures = {}
    for name, build in shared.items():
        started = time.perf_counter()
        build()
        fixtures[name] = round(time.perf_counter() - started, 3)
    timings = {n: round(statistics.median(run(n) for _ in range(runs)), 3) for n in names}
    print(json.dumps({
        "metric": "headline queries, total wall time", "value": round(sum(timings.values()), 3),
        "unit": "sec", "queries": timings, "fixtures": fixtures, "sf": os.path.basename(sf_dir).removeprefix("sf"),
        "cpus": int(cpus)}))


if __name__ == "__main__":
    main()
