"""N-gram Jaccard self-join by a size-aware heavy-light scheme, and its connected groups.

Light (small) sets enumerate subsets of the size that a linked partner must share; heavy sets
scan inverted lists, of which a linked pair shares one among each set's rarest shingles. The
boundary is the one of least cost for the sizes at hand. Equal sets are one class throughout.
Within a list or subset bucket every class is compared with two leaders first, then pairwise
where that leaves different groups.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotwatch.llm.common import Written, apart, map_slices, marked, marks, slices, texts
from lotwatch.llm.components import bucketed, grouped
from lotwatch.llm.words import mix, shingle_sets

#: Buckets of the frequency table by which shingles are ordered, and rows that it travels in.
BUCKETS, PARTS = 1 << 24, 64


@dataclass(frozen=True)
class JaccardParams:
    """Links need ``100 * intersection >= percent * union`` of sets of ``words``-word shingles.
    ``scan_cost``: cost of a posting in an inverted list against that of an enumerated subset;
    ``largest_light``: greatest set size that may count as light."""

    words: int = 5
    percent: int = 80
    scan_cost: int = 4
    largest_light: int = 16


def least_shared(a: int, b: int, percent: int) -> int:
    """Smallest intersection of linked sets of sizes ``a`` and ``b``."""
    return -(-percent * (a + b) // (100 + percent))


def prefix(n: int, percent: int) -> int:
    """How many of its first elements (in any common order) a set must list."""
    return n - -(-percent * n // 100) + 1


def subset_sizes(n: int, light: int, percent: int) -> list[int]:
    partners = range(-(-percent * n // 100), min(light, 100 * n // percent) + 1)
    return sorted({least_shared(m, n, percent) for m in partners})


def boundary(sizes: dict[int, int], params: JaccardParams) -> int:
    """Greatest light size: subsets of light sets plus lists of all that may meet a heavy one."""
    def cost(light: int) -> int:
        total = 0
        for n, count in sizes.items():
            if n <= light:
                total += count * sum(comb(n, c) for c in subset_sizes(n, light, params.percent))
            if 100 * n > params.percent * light:
                total += count * prefix(n, params.percent) * params.scan_cost
        return total

    return min(range(params.largest_light + 1), key=cost)


def set_hashes(value: np.ndarray, at: np.ndarray) -> np.ndarray:
    """A hash of each set; the sums of two scramblings make equal hashes of unequal sets rare."""
    one = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(value))])
    two = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(value * np.uint64(3) + np.uint64(1)))])
    size = np.diff(at).astype(np.uint64)
    return mix(mix(one[at[1:]] - one[at[:-1]] + size) + (two[at[1:]] - two[at[:-1]])).view(np.int64)


def sets_of(column: pa.Array, words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    value, at = shingle_sets(*texts(column), words)
    return value, at, set_hashes(value, at)


def parity_sketches(value: np.ndarray, at: np.ndarray) -> list[bytes]:
    """A few bits per element of each set: each element flips the bit that its hash picks.

    Bits that differ between two sketches are at most the elements that only one set has, so
    sketches rule out pairs, and never a linked one. Sizes are powers of two: a longer sketch
    folds to the shorter one's size.
    """
    out = []
    for a, b in zip(at[:-1].tolist(), at[1:].tolist()):
        bits = 1 << max(6, (2 * (b - a) - 1).bit_length())
        place = ((value[a:b] >> np.uint64(21)) & np.uint64(bits - 1)).astype(np.int64)
        out.append(np.packbits((np.bincount(place, minlength=bits) & 1).astype(np.uint8)).tobytes())
    return out


def differing(x: bytes, y: bytes) -> int:
    """Bits in which two sketches differ, folded to the shorter one's size."""
    if len(x) < len(y):
        x, y = y, x
    if len(x) > len(y):
        x = np.bitwise_xor.reduce(np.frombuffer(x, np.uint8).reshape(-1, len(y)), axis=0).tobytes()
    return (int.from_bytes(x) ^ int.from_bytes(y)).bit_count()


#: Longs of a sketch of fixed size, by which pairs are ruled out in the join where they meet.
SHORT = 8


def short_sketches(value: np.ndarray, at: np.ndarray) -> np.ndarray:
    """SHORT longs for each set: parity sketches of one size, so that SQL can count the bits that differ."""
    bits = 64 * SHORT
    row = np.repeat(np.arange(len(at) - 1), np.diff(at))
    place = row * bits + ((value >> np.uint64(21)) & np.uint64(bits - 1)).astype(np.int64)
    odd = np.bincount(place, minlength=bits * (len(at) - 1)) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def packed(counts: np.ndarray) -> bytes:
    """Counts as bytes; mostly empty ones as places and counts."""
    at = np.flatnonzero(counts)
    if 4 * len(at) < len(counts):
        return b"s" + zlib.compress(np.concatenate([at.astype(np.uint32), counts[at]]).tobytes(), 1)
    return b"d" + zlib.compress(counts.tobytes(), 1)


def add_packed(total: np.ndarray, data: bytes) -> None:
    values = np.frombuffer(zlib.decompress(data[1:]), np.uint32)
    if data[:1] == b"s":
        at, counts = np.split(values, 2)
        total[at] += counts
    else:
        total += values


def describe(docs: DataFrame, params: JaccardParams) -> DataFrame:
    """(_key, n, fp, sketch, short) per row; per task also its shingle counts by bucket as (part, counts)."""
    words, kind = params.words, docs.schema["_key"].dataType.simpleString()
    names = ["_key", "n", "fp", "sketch", "short", "part", "counts"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, key_type = np.zeros(BUCKETS, np.uint32), None
        for piece in slices(batches, "_text"):
            value, at, fp = sets_of(piece.column("_text"), words)
            np.add.at(total, (value & np.uint64(BUCKETS - 1)).astype(np.int64), np.uint32(1))
            m, key_type = piece.num_rows, piece.column("_key").type
            yield pa.RecordBatch.from_arrays([
                piece.column("_key"), pa.array(np.diff(at), pa.int64()), pa.array(fp),
                pa.array(parity_sketches(value, at), pa.binary()),
                pa.ListArray.from_arrays(pa.array(SHORT * np.arange(m + 1), pa.int32()), pa.array(short_sketches(value, at))),
                pa.nulls(m, pa.int32()), pa.nulls(m, pa.binary())], names)
        if key_type is not None and total.any():
            rows = [(p, packed(c)) for p, c in enumerate(total.reshape(PARTS, -1)) if c.any()]
            yield pa.RecordBatch.from_arrays([
                pa.nulls(len(rows), key_type), pa.nulls(len(rows), pa.int64()), pa.nulls(len(rows), pa.int64()),
                pa.nulls(len(rows), pa.binary()), pa.nulls(len(rows), pa.list_(pa.int64())),
                pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.binary())], names)

    docs.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "512")
    return docs.mapInArrow(run, f"_key {kind}, n long, fp long, sketch binary, short array<long>, part int, counts binary")


def frequency_levels(tables: DataFrame) -> np.ndarray:
    """One byte per bucket: 0 for ordinary shingles, more for frequent ones.

    The table has a fixed size whatever the input. It only orders shingles, so that lists of
    frequent ones are avoided where a set has rarer ones; results don't depend on it.
    """
    def add(rows: pa.Table) -> tuple[int, np.ndarray]:
        total = np.zeros(BUCKETS // PARTS, np.uint64)
        for c in rows.column("counts"):
            add_packed(total, c.as_py())
        return rows.column("part")[0].as_py(), total

    def partial(rows: pa.Table) -> pa.Table:
        part, total = add(rows)
        total = np.minimum(total, (1 << 32) - 1).astype(np.uint32)
        return pa.table({"part": pa.array([part], pa.int32()), "counts": pa.array([packed(total)], pa.binary())})

    def level(rows: pa.Table) -> pa.Table:
        part, total = add(rows)
        frequent = total > 4 * total.mean() + 8
        out = np.where(frequent, np.log2(np.maximum(total, 1).astype(float)), 0).astype(np.uint8)
        return pa.table({"part": pa.array([part], pa.int32()), "counts": pa.array([out.tobytes()], pa.binary())})

    schema = "part int, counts binary"
    some = tables.withColumn("some", F.pmod(F.xxhash64("counts"), F.lit(32)))
    first = some.groupBy("part", "some").applyInArrow(lambda t: partial(t), schema)
    levels = np.zeros((PARTS, BUCKETS // PARTS), np.uint8)
    for r in first.groupBy("part").applyInArrow(lambda t: level(t), schema).collect():
        levels[r.part] = np.frombuffer(bytes(r.counts), np.uint8)
    return levels.ravel()


def postings(docs: DataFrame, levels: np.ndarray, light: int, params: JaccardParams) -> DataFrame:
    """(key, node, pos): the subsets that light sets enumerate and the lists that sets stand
    in, with the element's place in its set's order (0 for subsets)."""
    words, percent = params.words, params.percent

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        value, at, fp = sets_of(batch.column("_text"), words)
        size = np.diff(at)
        row = np.repeat(np.arange(len(size)), size)
        listed = 100 * size > percent * light
        order = np.lexsort((value, levels[(value & np.uint64(BUCKETS - 1)).astype(np.int64)], row))
        rank = np.arange(len(value)) - np.repeat(at[:-1], size)
        take = (rank < (size - -(-percent * size // 100) + 1)[row]) & listed[row]
        keys, owners, places = [value[order][take]], [row[take]], [rank[take]]
        for r in np.flatnonzero((size > 0) & (size <= light)):
            own = value[at[r]:at[r + 1]]
            for c in subset_sizes(int(size[r]), light, percent):
                subsets = own[np.array(list(combinations(range(len(own)), c)))]
                mixed = np.full(len(subsets), c, np.uint64)
                for j in range(c):
                    mixed = mix(mixed * np.uint64(5) + subsets[:, j])
                keys.append(mixed)
                owners.append(np.full(len(subsets), r))
                places.append(np.zeros(len(subsets), np.int64))
        owner = np.concatenate(owners)
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys).view(np.int64)), pa.array(fp[owner]),
                                           pa.array(np.concatenate(places), pa.int32())],
                                          ["key", "node", "pos"])

    return map_slices(docs, run, "key long, node long, pos int", "_text")


def sets(docs: DataFrame, wanted: DataFrame, params: JaccardParams) -> DataFrame:
    """(fp, elements) of the classes in ``wanted``, and few others.

    Tasks pick sets by marks of bounded size; the joins that follow are exact.
    """
    words, table = params.words, marks(wanted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent: set[int] = set()
        for piece in slices(batches, "_text"):
            value, at, fp = sets_of(piece.column("_text"), words)
            hit = np.flatnonzero(marked(table, fp))
            new = [i for i in hit.tolist() if fp[i] not in sent and not sent.add(fp[i])]
            if new:
                yield pa.RecordBatch.from_arrays([pa.array(fp[new]), pa.array(
                    [value[at[i]:at[i + 1]].tobytes() for i in new], pa.binary())], ["fp", "elements"])

    return docs.mapInArrow(run, "fp long, elements binary").dropDuplicates(["fp"])


def verified(pairs: DataFrame, elements: DataFrame, percent: int) -> DataFrame:
    """The (a, b) of ``pairs`` whose sets link."""
    left, right = elements.toDF("a", "one"), elements.toDF("b", "two")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for one, two in zip(batch.column("one"), batch.column("two")):
                x, y = np.frombuffer(one.as_buffer(), np.uint64), np.frombuffer(two.as_buffer(), np.uint64)
                at = np.minimum(np.searchsorted(y, x), len(y) - 1)
                shared = int((y[at] == x).sum())
                keep.append(100 * shared >= percent * (len(x) + len(y) - shared))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return pairs.join(left, "a").join(right, "b").select("a", "b", "one", "two").mapInArrow(run, "a long, b long")


def linked_groups(docs: DataFrame, params: JaccardParams = JaccardParams(), text: str = "text",
                  key: str = "doc_id") -> DataFrame:
    """(key, n_shingles, component_id) for every row of ``docs``.

    ``component_id`` is the smallest key reachable over links, the own key included. A text
    without words, or null, has size 0 and is its own group. Equal texts and repeated rows are
    one class with all its keys. A row with a null key takes part and its own class's or group's
    id is the smallest non-null key (null if there is none). Other columns are ignored.
    """
    docs = docs.select(docs[key].alias("_key"), docs[text].alias("_text"))
    described = Written(describe(docs, params), "shingles")
    ids = described.df.where("part is null").select("_key", "n", "fp")
    levels = frequency_levels(described.df.where("part is not null").select("part", "counts"))
    small = ids.where((F.col("n") > 0) & (F.col("n") <= 2 * params.largest_light)).groupBy("n").count()
    light = boundary({r["n"]: r["count"] for r in small.collect()}, params)

    posts = postings(docs, levels, light, params)
    members = Written(bucketed(posts), "buckets").df

    sketches = described.df.where("n > 0").select("fp", "n", "sketch").dropDuplicates(["fp"])

    def rule_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bounds = zip(*(batch.column(c).to_pylist() for c in ("x", "y", "size")))
            keep = [(100 + params.percent) * differing(x, y) <= (100 - params.percent) * n for x, y, n in bounds]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    def check(pairs: DataFrame) -> DataFrame:
        both = pairs.join(sketches.toDF("a", "an", "x"), "a").join(sketches.toDF("b", "bn", "y"), "b")
        both = both.select("a", "b", "x", "y", (F.col("an") + F.col("bn")).alias("size"))
        pairs = Written(both.mapInArrow(rule_out, "a long, b long"), "likely").df
        elements = sets(docs, pairs.select(F.explode(F.array("a", "b")).alias("fp")), params)
        return verified(pairs, elements, params.percent)

    differ = " + ".join(f"bit_count(a_short[{i}] ^ b_short[{i}])" for i in range(SHORT))
    near = (f"100 * least(a_n, b_n) >= {params.percent} * greatest(a_n, b_n)"
            f" and {100 + params.percent} * ({differ}) <= {100 - params.percent} * (a_n + b_n)")
    # The first element that linked sets share leaves both enough elements to share with it.
    enough = f"{params.percent} * (a_n + b_n)"
    first = " and ".join(f"{100 + params.percent} * ({x}_n - {x}_pos) >= {enough}" for x in "ab")
    classes = described.df.where("n > 0").select(F.col("fp").alias("node"), "n", "short").dropDuplicates(["node"])
    group = grouped(members, classes, near, check, first)

    # The smallest key of each class, then of each group of classes.
    least = ids.groupBy("fp").agg(F.min("_key").alias("least")).join(group.withColumnRenamed("node", "fp"), "fp", "left")
    least = least.select("fp", "least", F.coalesce("component", "fp").alias("component"))
    groups = least.join(group.select("component").distinct(), "component", "left_semi").groupBy("component").agg(
        F.min("least").alias("group_least"))
    named = least.join(groups, "component", "left").select("fp", F.coalesce("group_least", "least").alias("component_id"))
    return ids.join(named, "fp").select(
        F.col("_key").alias(key), F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("_key")).alias("component_id"))


def keep_one(docs: DataFrame, groups: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """The rows of ``docs``, all columns as they are, that stand for their group.

    ``groups`` is a result of ``linked_groups``. The row with the smallest key of a group stays,
    and of repeated rows of one key and text one. Rows with a null key stay. Only documents that
    share a group or a key are shuffled.
    """
    groups = Written(groups.select(F.col(key).alias("_id"), "component_id"), "groups").df
    gone = groups.where("component_id != _id").select("_id").distinct()
    twice = groups.where("_id is not null").groupBy("_id").count().where("count > 1").select("_id")
    rest, hit = apart(docs, key, gone.union(twice), text)
    hit = hit.join(gone, hit[key] == gone["_id"], "left_anti")
    again = hit.where(hit[key].isNotNull()).dropDuplicates([key, text])
    return rest.unionByName(again).unionByName(hit.where(hit[key].isNull()))
