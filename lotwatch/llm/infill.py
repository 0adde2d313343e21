"""Fill-in-the-middle transformation of whole texts, in pyarrow.compute over batches."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotwatch.llm.common import SLICE_BYTES, map_slices, texts

#: Text bytes of a window; a longer text is worked on window by window, so that the arrays of
#: single units stay bounded.
WINDOW_BYTES = SLICE_BYTES


@dataclass(frozen=True)
class InfillParams:
    """Marks of the three parts; ``form_of`` percent of the texts are transformed, and
    ``spm_of`` percent of those with the suffix first; ``salt`` precedes the key in the hash."""

    prefix: str = "<P>"
    suffix: str = "<S>"
    middle: str = "<M>"
    form_of: int = 90
    spm_of: int = 20
    salt: str = "1:"


def draws(key: Column, params: InfillParams) -> list[Column]:
    """Four numbers below 2^32 from the salted key; a null key draws as an empty one."""
    digest = F.sha2(F.concat(F.lit(params.salt), F.coalesce(key.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)]


def windows(column: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Texts cut into windows of whole code points, and the n + 1 offsets of each text's windows."""
    data, rows = texts(column)
    size = np.diff(rows)
    per = np.maximum(1, -(-size // WINDOW_BYTES))
    first = np.concatenate([[0], np.cumsum(per)])
    cut = np.repeat(rows[:-1] - WINDOW_BYTES * first[:-1], per) + WINDOW_BYTES * np.arange(first[-1])
    inner = np.ones(len(cut), bool)
    inner[first[:-1]] = False
    # A cut inside a code point moves back to its first byte.
    for _ in range(3):
        inside = inner & (cut < len(data))
        inside[inside] = (data[cut[inside]] & 0xC0) == 0x80
        cut[inside] -= 1
    offsets = np.append(cut, len(data))
    return pa.LargeStringArray.from_buffers(len(cut), pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))), first


def units(column: pa.Array) -> pa.ListArray:
    """Each text as a list of its code points; the bytes are shared, not copied."""
    data, rows = texts(column)
    starts = np.flatnonzero((data & 0xC0) != 0x80)
    lists = np.searchsorted(starts, rows)
    points = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(np.append(starts, len(data))), pa.py_buffer(np.ascontiguousarray(data)))
    return pa.ListArray.from_arrays(pa.array(lists, pa.int32()), points)


def joined(values: pa.Array, offsets: np.ndarray) -> pa.Array:
    """Consecutive strings joined into one for each pair of offsets."""
    return pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values), pa.scalar("", values.type))


def rebuilt(values: pa.Array, parent: pa.Array, n: int) -> pa.Array:
    """Strings of ``n`` parents, joined from the values of each."""
    count = np.bincount(parent.to_numpy(), minlength=n)
    return joined(values, np.concatenate([[0], np.cumsum(count)]))


def lengths(column: pa.Array) -> pa.Array:
    return pc.cast(pc.utf8_length(pc.fill_null(column, "")), pa.int64())


def parts(column: pa.Array, low: pa.Array, high: pa.Array) -> tuple[pa.Array, pa.Array, pa.Array]:
    """The code points of each text before ``low``, up to ``high``, and the rest."""
    pieces, first = windows(column)
    # Code points of a text that stand before a window.
    before = np.concatenate([[0], np.cumsum(pc.utf8_length(pieces).to_numpy())])[:-1]
    owner = np.repeat(np.arange(len(column)), np.diff(first))
    base, owner = pa.array(before - before[first[:-1]][owner]), pa.array(owner)
    step = len(pieces) if len(pieces) == len(column) else 1
    found: list[list[pa.Array]] = [[], [], []]
    for at in range(0, len(pieces), step):
        lists = units(pieces.slice(at, step))
        flat, parent = pc.list_flatten(lists), pc.list_parent_indices(lists)
        start = pc.subtract(lists.offsets.slice(0, step), base.slice(at, step))
        ordinal = pc.subtract(pa.array(np.arange(len(flat))), pc.take(start, parent))
        text = pc.take(owner.slice(at, step), parent)
        in_prefix = pc.less(ordinal, pc.take(low, text))
        in_suffix = pc.greater_equal(ordinal, pc.take(high, text))
        for role, here in enumerate((in_prefix, pc.invert(pc.or_(in_prefix, in_suffix)), in_suffix)):
            found[role].append(rebuilt(pc.filter(flat, here), pc.filter(parent, here), step))
    return tuple(joined(pa.concat_arrays(strings), first) for strings in found)


def transformed(batch: pa.RecordBatch, params: InfillParams) -> pa.RecordBatch:
    """Columns key, text and h1 to h4 in; key, n, form, lengths of prefix and middle, output out."""
    key, column, *draw = batch.columns
    text = pc.cast(pc.fill_null(column, ""), pa.large_string())
    n = lengths(text)
    below = lambda h, m: pc.subtract(h, pc.multiply(pc.divide(h, m), m))
    cuts = [below(h, pc.add(n, 1)) for h in draw[:2]]
    low, high = pc.min_element_wise(*cuts), pc.max_element_wise(*cuts)
    marks = (params.prefix, params.suffix, params.middle)
    plain = pc.or_(pc.equal(n, 0), pc.greater_equal(below(draw[2], 100), params.form_of))
    for mark in marks:
        plain = pc.or_(plain, pc.match_substring(text, mark))
    first = pc.less(below(draw[3], 100), params.spm_of)
    before, inside, after = parts(text, low, high)
    p, s, m = (pa.scalar(x, pa.large_string()) for x in marks)
    empty = pa.scalar("", pa.large_string())
    psm = pc.binary_join_element_wise(p, before, s, after, m, inside, empty)
    spm = pc.binary_join_element_wise(s, after, p, before, m, inside, empty)
    nothing = pa.scalar(None, pa.int64())
    return pa.RecordBatch.from_arrays([
        key, n, pc.if_else(plain, "plain", pc.if_else(first, "spm", "psm")),
        pc.if_else(plain, nothing, low), pc.if_else(plain, nothing, pc.subtract(high, low)),
        pc.cast(pc.if_else(plain, text, pc.if_else(first, spm, psm)), pa.string())],
        ["key", "n", "form", "prefix_chars", "middle_chars", "output"])


def infill(docs: DataFrame, params: InfillParams = InfillParams(), text: str = "text", key: str = "doc_id") -> DataFrame:
    """``key``, ``n`` (code points), ``form`` (plain, psm or spm), ``prefix_chars``,
    ``middle_chars`` and ``output``, one row per input row; other columns are ignored.

    Two draws from the key cut a text into prefix, middle and suffix. Null counts as an empty
    text; empty texts, texts that hold a mark and those not drawn stay plain, without lengths.
    Repeated rows of a key and a text are cut alike, so reruns agree; an empty table gives an
    empty one. Texts of any length are worked on in windows of two megabytes.
    """
    narrow = docs.select(docs[key].alias("key"), docs[text].alias("text"), *[
        h.alias(f"h{i}") for i, h in enumerate(draws(docs[key], params))])
    kind = narrow.schema["key"].dataType.simpleString()
    out = map_slices(narrow, lambda b: transformed(b, params),
                     f"key {kind}, n long, form string, prefix_chars long, middle_chars long, output string")
    return out.withColumnRenamed("key", key)


def restored(output: Column, form: Column, params: InfillParams = InfillParams()) -> Column:
    """The text from which an output was made. No mark occurs in a transformed text, and one that
    begins in a part can't end in the mark after it, so cutting at the marks is exact."""
    p, s, m = map(F.lit, (params.prefix, params.suffix, params.middle))
    one, two = F.lit(1), F.lit(2)
    middle = F.split_part(output, m, two)
    head = F.split_part(output, m, one)
    psm = F.concat(F.split_part(F.split_part(head, p, two), s, one), middle, F.split_part(head, s, two))
    spm = F.concat(F.split_part(head, p, two), middle, F.split_part(F.split_part(head, s, two), p, one))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)
