"""Row and file validation. Rules are plain Columns, so all of them run in one pass."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotwatch.functions.scalars import to_bool, to_double, to_long
from lotwatch.params import Domains, IngestParams
from lotwatch.schemas import LandingFeed
from lotwatch.session import staged

Rules = dict[str, Column]

_CASTS = {"int": to_long, "float": to_double, "bool": to_bool}


def missing_columns(df: DataFrame, feed: LandingFeed) -> list[str]:
    return [c for c in feed.required if c not in df.columns]


def missing_reason(missing: Column) -> Column:
    """Reason for rows of a file that lacks the required columns ``missing``, else null."""
    listed = F.array_join(F.array_sort(missing), "', '")
    return F.when(F.size(missing) > 0, F.concat(F.lit("Missing required columns: ['"), listed, F.lit("']")))


def file_lacks(df: DataFrame, feed: LandingFeed, file_columns: str = "file_columns") -> Column:
    """Required columns that the frame or the row's own file lacks."""
    lacking = F.array(*[F.lit(c) for c in missing_columns(df, feed)]).cast("array<string>")
    if file_columns in df.columns:
        required = F.array(*[F.lit(c) for c in feed.required])
        lacking = F.array_union(lacking, F.array_except(required, F.col(file_columns)))
    return lacking


def coercion_error(df: DataFrame, types: dict[str, str]) -> Column:
    """Reason naming the first column that does not parse; booleans never reject a row."""
    checks = [
        F.when(_CASTS[kind](c).isNull(), F.lit(f"Type coercion failure: {c}"))
        for c, kind in types.items()
        if kind != "bool" and c in df.columns
    ]
    return F.coalesce(*checks) if checks else F.lit(None).cast("string")


def coerce(df: DataFrame, types: dict[str, str]) -> tuple[DataFrame, DataFrame]:
    """Split into typed good rows and raw bad rows carrying ``error_reason``."""
    flagged = df.withColumn("error_reason", coercion_error(df, types))
    typed = {c: _CASTS[kind](c) for c, kind in types.items() if c in df.columns}
    good = flagged.filter(F.col("error_reason").isNull()).drop("error_reason").withColumns(typed)
    return good, flagged.filter(F.col("error_reason").isNotNull())


def violates(condition: Column) -> Column:
    """A comparison with null is no violation."""
    return F.coalesce(condition, F.lit(False))


def outside(c: str, allowed: Sequence[str]) -> Column:
    """Membership in a value set; null is a violation."""
    return ~F.coalesce(F.col(c).isin(*allowed), F.lit(False))


def not_null_rules(columns: Sequence[str]) -> Rules:
    return {f"{c}:null_value": F.col(c).isNull() for c in columns}


def range_rules(columns: Sequence[str]) -> Rules:
    rules = {
        "unit_count:non_positive": ("unit_count", lambda c: c <= 0),
        "defect_count:negative": ("defect_count", lambda c: c < 0),
        "defect_rate:out_of_range_0_1": ("defect_rate", lambda c: (c < 0) | (c > 1)),
        "return_rate:out_of_range_0_1": ("return_rate", lambda c: (c < 0) | (c > 1)),
    }
    return {
        name: violates(test(F.col(c))) for name, (c, test) in rules.items() if c in columns
    }


def business_rules(feed: str, domains: Domains) -> Rules:
    """The named domain rules of a feed (none for other feeds)."""
    if feed == "manufacturing_batches":
        units = F.col("unit_count")
        return {
            "valid_line_id": outside("line_id", domains.lines),
            "unit_count_range": violates(
                ~units.between(domains.min_batch_units, domains.max_batch_units)
            ),
            "valid_sku": outside("sku", domains.skus),
        }
    if feed == "qc_inspection_logs":
        return {
            "valid_pass_fail": outside("pass_fail", domains.verdicts),
            "defect_count_le_units": violates(F.col("defect_count") > F.col("units_inspected")),
            "min_units_inspected": violates(F.col("units_inspected") < domains.min_inspected),
        }
    if feed == "sales_returns":
        return {
            "returns_le_sold": violates(F.col("units_returned") > F.col("units_sold")),
            "positive_revenue": violates(F.col("revenue_usd") <= 0),
            "valid_channel": outside("channel", domains.channels),
        }
    return {}


def failed_rules(rules: Rules) -> Column:
    """Names of the rules a row breaks, in rule order."""
    if not rules:
        return F.array().cast("array<string>")
    return F.array_compact(F.array(*[F.when(bad, F.lit(name)) for name, bad in rules.items()]))


def check_rows(df: DataFrame, rules: Rules) -> DataFrame:
    return df.withColumn("failed_rules", failed_rules(rules))


def rule_report(df: DataFrame, rules: Rules) -> DataFrame:
    """Violations per rule beside table totals: one scan, one aggregate row, unpivoted."""
    names = list(rules)
    invalid = F.lit(False)
    for bad in rules.values():
        invalid = invalid | bad
    totals = df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(invalid).alias("invalid_rows"),
        *[F.count_if(rules[n]).alias(f"_{i}") for i, n in enumerate(names)],
    )
    per_rule = F.explode(F.array(*[
        F.struct(F.lit(n).alias("rule"), F.col(f"_{i}").alias("violations"))
        for i, n in enumerate(names)
    ]))
    rate = F.round(F.col("invalid_rows") / F.greatest("total_rows", F.lit(1)), 4)
    return totals.select(
        "total_rows", "invalid_rows", rate.alias("failure_rate"), per_rule.alias("_r")
    ).select("_r.rule", "_r.violations", "total_rows", "invalid_rows", "failure_rate")


def existing_keys(df: DataFrame, existing: DataFrame, key: str) -> DataFrame:
    """Incoming rows whose key is already stored."""
    return df.join(existing.select(key), key, "left_semi")


def duplicate_report(df: DataFrame, existing: DataFrame, key: str,
                     preview: int = IngestParams.preview_ids) -> DataFrame:
    """Row and duplicate counts with the first ``preview`` duplicate ids in key order.

    Rows are counted per key before the join, so a key held by most rows meets the stored
    keys once. The preview repeats an id as often as it occurs.
    """
    copies = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    duplicates = existing_keys(copies, existing, key)
    nothing, zero = F.array().cast("array<string>"), F.lit(0).cast("bigint")
    repeated = F.array_repeat(F.col(key).cast("string"), F.least("n", F.lit(preview)).cast("int"))
    first_ids = duplicates.orderBy(key).limit(preview).select(repeated.alias("ids"))
    counts = df.agg(F.count(F.lit(1)).alias("total_rows")).select(
        "total_rows", zero.alias("duplicate_count"), nothing.alias("ids"))
    found = duplicates.agg(F.coalesce(F.sum("n"), zero).alias("n")).select(zero, "n", nothing)
    sample = first_ids.agg(F.slice(F.array_sort(F.flatten(F.collect_list("ids"))), 1, preview))
    return counts.union(found).union(sample.select(zero, zero, F.col("*"))).agg(
        F.sum("total_rows").alias("total_rows"),
        F.sum("duplicate_count").alias("duplicate_count"),
        F.flatten(F.collect_list("ids")).alias("duplicate_ids"),
    )


def file_failure_rates(df: DataFrame, invalid: Column, source: str = "source_path") -> DataFrame:
    return df.groupBy(source).agg(
        F.count(F.lit(1)).alias("total_rows"), F.count_if(invalid).alias("invalid_rows")
    ).withColumn("failure_rate", F.col("invalid_rows") / F.col("total_rows"))


def gate_files(df: DataFrame, invalid: Column, params: IngestParams,
               source: str = "source_path") -> DataFrame:
    """Mark the rows of files whose share of invalid rows exceeds the limit.

    The failing files are staged as a list first: as a rule it is short and gets broadcast, so
    the rows themselves are not shuffled; a list beyond the broadcast limit is merge-joined.
    """
    failing = file_failure_rates(df, invalid, source).filter(
        F.col("failure_rate") > params.file_failure_rate
    ).select(source, F.lit(True).alias("file_quarantined"))
    marked = df.join(staged(failing, "failing-files"), source, "left")
    return marked.withColumn("file_quarantined", F.coalesce("file_quarantined", F.lit(False)))
