"""Declarative table tests: unique, not-null, accepted values, relationships."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def unique_violations(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).filter(F.col("copies") > 1)


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counts.unpivot([], list(columns), "column_name", "violations")


def unaccepted_values(df: DataFrame, column: str, allowed: Sequence[str]) -> DataFrame:
    bad = df.filter(F.col(column).isNotNull() & ~F.col(column).isin(*allowed))
    return bad.groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("violations"))


def orphans(child: DataFrame, fk: str, parent: DataFrame, pk: str) -> DataFrame:
    """Foreign-key values without a parent. Child rows are counted per value before the join,
    so a value repeated across most rows crosses the shuffle once per task."""
    values = child.filter(F.col(fk).isNotNull()).groupBy(fk).agg(
        F.count(F.lit(1)).alias("violations")
    )
    return values.join(parent.select(F.col(pk).alias(fk)), fk, "left_anti")


def suite(df: DataFrame, unique: Sequence[Sequence[str]] = (), not_null: Sequence[str] = (),
          accepted: dict[str, Sequence[str]] | None = None,
          relationships: dict[str, tuple[DataFrame, str]] | None = None) -> DataFrame:
    """One row per test with the number of offending rows or keys."""
    row_tests = {f"not_null({c})": F.col(c).isNull() for c in not_null}
    for c, allowed in (accepted or {}).items():
        row_tests[f"accepted_values({c})"] = F.col(c).isNotNull() & ~F.col(c).isin(*allowed)
    parts = []
    if row_tests:
        names = list(row_tests)
        counts = df.agg(*[F.count_if(t).alias(n) for n, t in row_tests.items()])
        parts.append(counts.unpivot([], [f"`{n}`" for n in names], "test", "violations"))
    for keys in unique:
        parts.append(unique_violations(df, keys).agg(
            F.lit(f"unique({', '.join(keys)})").alias("test"),
            F.count(F.lit(1)).alias("violations")))
    for fk, (parent, pk) in (relationships or {}).items():
        parts.append(orphans(df, fk, parent, pk).agg(
            F.lit(f"relationships({fk})").alias("test"),
            F.coalesce(F.sum("violations"), F.lit(0)).alias("violations")))
    return reduce(DataFrame.union, parts)
