"""Numeric-claim extraction and checking, row-local so that no text is ever shuffled."""

from __future__ import annotations

import re
import sys
from bisect import bisect_right, insort

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F

from lotwatch.functions.scalars import as_col

# Workers get these functions by value, so the package need not be installed on them.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Shape of a numeric claim with its optional unit, and the annotation.
CLAIM_PATTERN = r"(?i)(\b\d[\d,]*(?:\.\d+)?(?:\s*(?:units?|batches?|%|percent|USD|\$|million|M|thousand|K|days?|weeks?)\b)?)"
UNVERIFIED_MARK = " [⚠ UNVERIFIED]"

#: Texts that a Python worker holds at a time when they are marked.
BATCH_ROWS = 500


def extract_claims(text: Column | str) -> Column:
    return F.regexp_extract_all(as_col(text), F.lit(CLAIM_PATTERN), 1)


def claim_number(claim: Column) -> Column:
    """Leading number of a claim; magnitude words do not scale it."""
    digits = F.regexp_extract(F.replace(claim, F.lit(","), F.lit("")), r"[\d.]+", 0)
    return digits.try_cast("double")


def claim_holds(claim: Column, trusted: Column, tolerance: float) -> Column:
    number = claim_number(claim)
    near = F.exists(
        trusted,
        lambda v: (v != 0)
        & (F.abs(number - v) / F.greatest(F.abs(v), F.lit(1.0)) <= tolerance),
    )
    exact = F.exists(trusted, lambda v: v.cast("string") == F.trim(claim))
    return F.coalesce(F.when(number.isNotNull(), near).otherwise(exact), F.lit(False))


def judged_claims(claims: Column | str, trusted: Column | str, tolerance: float) -> Column:
    """Every claim with its verdict, in text order."""
    trusted = as_col(trusted)
    return F.transform(as_col(claims), lambda c: F.struct(
        c.alias("claim"), claim_holds(c, trusted, tolerance).alias("holds")))


def claims_where(judged: Column | str, holds: bool) -> Column:
    kept = F.filter(as_col(judged), lambda j: j["holds"] if holds else ~j["holds"])
    return F.transform(kept, lambda j: j["claim"])


def marked_text(text: str | None, claims) -> str | None:
    """``text`` with a mark after the first occurrence of every claim, in claim order.

    Occurrences of all claims are gathered in one pass and the text is put together once. An
    occurrence that an earlier mark has split no longer counts, as if each claim were marked
    in the text that the claims before it left.
    """
    claims = [c for c in claims if c] if claims is not None else []
    if text is None or not claims:
        return text
    places: dict[str, list[int]] = {c: [] for c in claims}
    sizes = sorted({len(c) for c in places})
    for found in re.finditer("[" + re.escape("".join(sorted({c[0] for c in places}))) + "]", text):
        at = found.start()
        for n in sizes:
            where = places.get(text[at:at + n])
            if where is not None:
                where.append(at)
    marks: dict[int, int] = {}
    cuts: list[int] = []
    tried = dict.fromkeys(places, 0)
    for c in claims:
        where = places[c]
        while tried[c] < len(where):
            start, end = where[tried[c]], where[tried[c]] + len(c)
            nearest = bisect_right(cuts, start)
            if nearest < len(cuts) and cuts[nearest] < end:
                tried[c] += 1  # split by a mark, for good
                continue
            if end not in marks:
                insort(cuts, end)
            marks[end] = marks.get(end, 0) + 1
            break
    pieces, last = [], 0
    for cut in cuts:
        pieces += [text[last:cut], UNVERIFIED_MARK * marks[cut]]
        last = cut
    return "".join([*pieces, text[last:]])


def annotate(text: Column | str, unverified: Column | str) -> Column:
    """Mark the first occurrence of every unverified claim, in claim order."""

    @F.pandas_udf("string")
    def marked(texts: pd.Series, claims: pd.Series) -> pd.Series:
        return pd.Series([marked_text(t, c) for t, c in zip(texts, claims)], dtype=object)

    return marked(as_col(text), as_col(unverified))
