"""Column builders for the silver and gold projections."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from lotwatch.params import RootCauseParams


def as_col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def norm_key(c: Column | str) -> Column:
    return F.upper(F.trim(as_col(c)))


def to_long(c: Column | str) -> Column:
    """Whole number from text that may carry decimals; null when it is not a number."""
    number = as_col(c).cast("string").try_cast("double")
    return F.when(~F.isnan(number), number).try_cast("bigint")


def to_double(c: Column | str) -> Column:
    number = as_col(c).cast("string").try_cast("double")
    return F.when(~F.isnan(number), number)


def to_bool(c: Column | str) -> Column:
    word = F.lower(F.trim(as_col(c).cast("string")))
    # Accepted spellings.
    return F.when(word.isin("true", "1", "yes"), F.lit(True)).when(
        word.isin("false", "0", "no"), F.lit(False)
    )


def is_active(c: Column | str) -> Column:
    return F.coalesce(F.lower(F.trim(as_col(c))) == "active", F.lit(False))


def safe_ratio(numerator: Column | str, denominator: Column | str, digits: int = 6) -> Column:
    return F.round(
        F.try_divide(as_col(numerator).cast("double"), as_col(denominator).cast("double")), digits
    )


def dominant(labels: Sequence[str], columns: Sequence[str]) -> Column:
    """Label of the largest count; ties go to the first one listed, no winner to the last."""
    top = F.greatest(*columns)
    hits = [F.when(F.col(c) == top, F.lit(label)) for label, c in zip(labels[:-1], columns[:-1])]
    return F.coalesce(*hits, F.lit(labels[-1]))


def days_between(start: Column | str, end: Column | str) -> Column:
    return F.datediff(as_col(end), as_col(start))


def amount(units: Column | str, price: Column | str) -> Column:
    return F.round(as_col(units).cast("double") * as_col(price).cast("double"), 2)


def steady_round(c: Column | str, digits: int) -> Column:
    """Rounding that the summation order cannot tip: noise past twelve digits goes first."""
    return F.round(F.round(as_col(c), 12), digits)


def pct_above(observed: Column | str, baseline: Column | str, digits: int = 1) -> Column:
    observed, baseline = as_col(observed), as_col(baseline)
    return F.when(baseline > 0, steady_round((observed - baseline) / baseline * 100, digits))


def confidence_tier(c: Column | str, high: float = RootCauseParams.tier_high,
                    medium: float = RootCauseParams.tier_medium) -> Column:
    c = as_col(c)
    return F.when(c >= high, "HIGH").when(c >= medium, "MEDIUM").otherwise("LOW")


def urgency(agent: Column | str, context_json: Column | str) -> Column:
    agent = as_col(agent)
    confidence = F.get_json_object(as_col(context_json), "$.confidence").try_cast("double")
    return (
        F.when((agent == "A-03") & (confidence < 0.50), "HIGH")
        .when(agent.isin("A-01", "A-02"), "MEDIUM")
        .otherwise("LOW")
    )


def elapsed(start: Column | str, end: Column | str, unit_seconds: int, digits: int) -> Column:
    seconds = F.unix_timestamp(as_col(end).cast("timestamp")) - F.unix_timestamp(
        as_col(start).cast("timestamp")
    )
    return F.round(seconds / unit_seconds, digits)


def open_hours(resolved: Column | str, escalated_at: Column | str, as_of: Column) -> Column:
    return F.when(~as_col(resolved), elapsed(escalated_at, as_of, 3600, 1))


def duration_minutes(start: Column | str, end: Column | str) -> Column:
    return elapsed(start, end, 60, 2)


def month_start(c: Column | str) -> Column:
    return F.trunc(as_col(c), "month")


def month_key(c: Column | str) -> Column:
    return F.date_format(as_col(c), "yyyy-MM")


def week_start(c: Column | str) -> Column:
    return F.trunc(as_col(c), "week")


def week_label(monday: Column | str) -> Column:
    monday = as_col(monday)
    return F.concat_ws(
        "/", F.date_format(monday, "yyyy-MM-dd"), F.date_format(F.date_add(monday, 6), "yyyy-MM-dd")
    )


def word_count(c: Column | str) -> Column:
    trimmed = F.regexp_replace(as_col(c), r"^\s+|\s+$", "")
    return F.when(trimmed == "", 0).otherwise(F.size(F.split(trimmed, r"\s+")))


def json_list_size(c: Column | str) -> Column:
    parsed = F.from_json(as_col(c), "array<string>")
    return F.when(parsed.isNotNull(), F.size(parsed))


def kpi_colour(unverified: Column | str) -> Column:
    unverified = as_col(unverified)
    return F.when(unverified == 0, "green").when(unverified <= 2, "amber").otherwise("red")
