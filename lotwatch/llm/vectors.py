"""Near-duplicate vectors by an exact metric range join over pivot cells.

On the unit sphere a cosine of at least c is a distance of at most r = sqrt(2 - 2c). A vector
belongs to the cell of its nearest pivot. By the triangle inequality it can have partners in
another pivot's cell only if it lies within r of the plane between the two pivots and within r
of that cell's outermost vector; only then it is copied there. Each pair meets in one cell, and
cells are joined independently, in blocks of bounded size.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotwatch.llm.common import Written
from lotwatch.llm.components import connected

#: Room for rounding in distances; it only lets a few more vectors be copied.
SLACK = 1e-9


@dataclass(frozen=True)
class RangeParams:
    """``cosine``: least cosine of a link; ``cell``: vectors per cell that the number of pivots
    aims at; ``pivots``: pivots in all at most; ``block``: vectors of a cell in one block."""

    cosine: float = 0.93
    cell: int = 2048
    pivots: int = 2048
    block: int = 1024

    @property
    def radius(self) -> float:
        return float(np.sqrt(2 - 2 * self.cosine)) + SLACK


def unit_vectors(vectors: DataFrame) -> DataFrame:
    """(id, label, vec, mark): usable vectors at length one as bytes of doubles, with their md5.

    Left out are rows with a null id or label, and vectors that are null, empty, zero or hold a
    null or a value that isn't finite.
    """
    import hashlib

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, marks = [], []
            for v in batch.column("vec"):
                values = v.values
                x = None
                if values is not None and len(values) and not values.null_count:
                    x = values.to_numpy(zero_copy_only=False).astype(float)
                    largest = np.abs(x).max()
                    if np.isfinite(largest) and largest > 0:
                        x = x / largest
                        x = x / np.sqrt((x * x).sum())
                    else:
                        x = None
                rows.append(None if x is None else x.tobytes())
                marks.append(None if x is None else hashlib.md5(x.tobytes()).digest())
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("label"), pa.array(rows, pa.binary()),
                                              pa.array(marks, pa.binary())], ["id", "label", "vec", "mark"])

    rows = vectors.where("id is not null and label is not null and vec is not null")
    return rows.mapInArrow(run, "id long, label string, vec binary, mark binary").where("vec is not null")


def choose_pivots(classes: DataFrame, params: RangeParams) -> dict[tuple[str, int], np.ndarray]:
    """Pivots by label and vector length: some of its vectors by hash, at most ``pivots`` in all.

    Groups are served by size; those that get no pivot of their own are one cell each.
    """
    groups = classes.groupBy("label", F.length("vec").alias("width")).count().orderBy(
        F.desc("count"), "label", "width").limit(params.pivots).collect()
    total, out = sum(g["count"] for g in groups), {}
    spread = max(params.cell, -(-total // params.pivots))
    wanted = {(g["label"], g["width"]): -(-g["count"] // spread) for g in groups}
    share = F.create_map(*[x for g in groups for x in (
        F.concat_ws("|", F.lit(g["width"]), F.lit(g["label"])), F.lit(min(1.0, 4 * wanted[g["label"], g["width"]] / g["count"])))])
    name = F.concat_ws("|", F.length("vec"), "label")
    if groups:  # about four times as many candidates as pivots, so that none runs short
        chance = F.pmod(F.xxhash64("mark"), F.lit(1 << 30)) / float(1 << 30)
        for r in classes.where(chance < share[name]).select("label", "vec").orderBy("mark").limit(8 * params.pivots + 64).collect():
            got = out.setdefault((r["label"], len(r["vec"])), [])
            if len(got) < wanted.get((r["label"], len(r["vec"])), 0):
                got.append(np.frombuffer(bytes(r["vec"])))
    return {k: np.array(v) for k, v in out.items() if v}


def placed(classes: DataFrame, pivots: dict[tuple[str, int], np.ndarray], params: RangeParams,
           reach: dict[tuple[str, int, int], float] | None) -> DataFrame:
    """(label, width, cell, home, far, id, many, vec): each class at home and, with ``reach``
    (distance of each cell's outermost vector), where it is copied to. Of two cells only the
    later one's vectors are copied, to the earlier one."""
    radius = params.radius

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            label, vec = batch.column("label").to_pylist(), batch.column("vec")
            rows: list[int] = []
            cells: list[int] = []
            homes: list[bool] = []
            fars: list[float] = []
            width = np.array([len(v.as_buffer()) for v in vec])
            keys = list(zip(label, width.tolist()))
            for key in sorted(set(keys)):
                at = np.array([i for i, k in enumerate(keys) if k == key])
                points = pivots.get(key)
                if points is None:
                    rows += at.tolist()
                    cells += [0] * len(at)
                    homes += [True] * len(at)
                    fars += [2.0] * len(at)
                    continue
                x = np.array([np.frombuffer(vec[int(i)].as_buffer()) for i in at])
                square = np.maximum(2 - 2 * (x @ points.T), 0)
                home = square.argmin(1)
                own = square[np.arange(len(at)), home]
                rows += at.tolist()
                cells += home.tolist()
                homes += [True] * len(at)
                fars += np.sqrt(own).tolist()
                if reach is None:
                    continue
                outer = np.array([reach.get((*key, c), -10.0) for c in range(len(points))])
                apart = np.sqrt(np.maximum(2 - 2 * (points @ points.T), 0))[home]
                plane = (square - own[:, None]) <= 2 * radius * apart + SLACK
                ball = np.sqrt(square) <= (outer + radius + SLACK)[None, :]
                i, c = np.nonzero(plane & ball & (np.arange(len(points))[None, :] < home[:, None]))
                rows += at[i].tolist()
                cells += c.tolist()
                homes += [False] * len(i)
                fars += [0.0] * len(i)
            take = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays([
                batch.column("label").take(take), pa.array(width[rows], pa.int32()), pa.array(cells, pa.int32()),
                pa.array(homes, pa.bool_()), pa.array(fars, pa.float64()), batch.column("id").take(take),
                batch.column("many").take(take), vec.take(take)],
                ["label", "width", "cell", "home", "far", "id", "many", "vec"])

    return classes.select("label", "id", "many", "vec").mapInArrow(
        run, "label string, width int, cell int, home boolean, far double, id long, many long, vec binary")


def joined(cells: DataFrame, params: RangeParams) -> DataFrame:
    """(id, links, other): per block, how many vectors each one links to, and enough links to
    connect what is connected in the block.

    A cell's vectors are dealt to blocks by hash; blocks meet pairwise (home with home, home with
    copied), so no task holds more than two blocks, however full the cell.
    """
    least = params.cosine
    counts = cells.groupBy("label", "width", "cell").agg(F.count_if("home").alias("h"), F.count_if(~F.col("home")).alias("g"))
    counts = counts.select("label", "width", "cell", F.ceil(F.col("h") / params.block).alias("hb"), F.ceil(F.col("g") / params.block).alias("gb"))
    rows = cells.join(counts, ["label", "width", "cell"]).where("hb > 0")
    deal = F.xxhash64("id")
    own = F.pmod(deal, F.greatest("hb", F.lit(1)))
    away = F.pmod(deal, F.greatest("gb", F.lit(1)))
    # Meetings (i, j): home block i with home block j >= i, or with copied block j - hb.
    meet = F.when(F.col("home"), F.concat(
        F.transform(F.sequence(F.lit(0).cast("long"), F.col("hb") + F.col("gb") - 1), lambda j: F.struct(F.least(own, j).alias("i"), F.greatest(own, j).alias("j"))),
    )).otherwise(F.transform(F.sequence(F.lit(0).cast("long"), F.col("hb") - 1), lambda i: F.struct(i.alias("i"), (away + F.col("hb")).alias("j"))))
    rows = rows.withColumn("home_block", F.when(F.col("home"), own)).withColumn("m", F.explode(F.array_distinct(meet)))
    rows = rows.select("label", "width", "cell", "m.i", "m.j", "home_block", "id", "many", "vec")

    def run(group: pa.Table) -> pa.Table:
        i, j = group.column("i")[0].as_py(), group.column("j")[0].as_py()
        ids = group.column("id").to_numpy()
        many = group.column("many").to_numpy().astype(np.int64)
        block = np.array([-1 if b is None else b for b in group.column("home_block").to_pylist()])
        x = np.frombuffer(b"".join(group.column("vec").to_pylist())).reshape(len(ids), -1)
        left, right = np.flatnonzero(block == i), np.flatnonzero(block == j) if (block == j).any() else np.flatnonzero(block == -1)
        if i != j:
            right = right[block[right] != i]
        links = (x[left] @ x[right].T) >= least
        if i == j:
            np.fill_diagonal(links, False)
        n = np.zeros(len(ids), np.int64)
        n[left] += links @ many[right]
        if i != j:
            n[right] += links.T @ many[left]
        # Least id reachable inside the block: spread minima until nothing changes.
        root = ids.copy()
        a, b = (side[k] for side, k in zip((left, right), np.nonzero(links)))
        while len(a):
            before = root.copy()
            np.minimum.at(root, a, root[b])
            np.minimum.at(root, b, root[a])
            if (root == before).all():
                break
        keep = np.flatnonzero(n > 0)
        return pa.table({"id": ids[keep], "links": n[keep], "other": root[keep]})

    return rows.groupBy("label", "width", "cell", "i", "j").applyInArrow(lambda t: run(t), "id long, links long, other long")


def near_duplicates(vectors: DataFrame, params: RangeParams = RangeParams(), vector: str = "embedding",
                    label: str = "label", key: str = "vec_id") -> DataFrame:
    """(key, n_links, component_id, kept) for every row of ``vectors``.

    Vectors link when their labels are equal and their cosine, in doubles, is at least
    ``params.cosine``. ``n_links`` counts other vectors linked directly, copies included;
    ``component_id`` is the smallest key reachable, ``kept`` whether that is the own key.
    Rows with a null key or label, and vectors that are null, empty, zero or hold a null or a
    value that isn't finite, link with nothing; vectors of different lengths don't either.
    Repeated rows of one key and vector count as one vector; a key with several vectors reaches
    what any of them reaches. A null key has a null ``component_id`` and isn't kept. Equal
    vectors are one class, compared once. Other columns are ignored.
    """
    rows = vectors.select(vectors[key].cast("long").alias("id"), vectors[label].cast("string").alias("label"),
                          vectors[vector].alias("vec"))
    kind = vectors.schema[key].dataType.simpleString()
    usable = Written(unit_vectors(rows).distinct(), "unit-vectors").df
    named = usable.groupBy("label", "mark").agg(F.min("id").alias("rep"), F.count("*").alias("many"), F.first("vec").alias("vec"))
    # A key may be the least of several classes; classes are numbered by label and mark instead.
    classes = Written(named.withColumn("id", F.xxhash64("label", "mark")), "classes").df
    pivots = choose_pivots(classes, params)
    outer = placed(classes, pivots, params, None).groupBy("label", "width", "cell").agg(F.max("far").alias("far"))
    reach = {(r["label"], r["width"], r["cell"]): r["far"] for r in outer.where("far < 2").collect()}
    cells = Written(placed(classes, pivots, params, reach), "cells").df
    met = Written(joined(cells, params), "met").df
    counts = met.groupBy("id").agg(F.sum("links").alias("links"))
    info = classes.select("id", "label", "mark", "rep", "many").join(counts, "id", "left")
    info = Written(info.select("id", "label", "mark", "rep", (F.coalesce("links", F.lit(0)) + F.col("many") - 1).alias("n_links")), "class-links").df
    member = usable.select(F.col("id").alias("key"), "label", "mark").join(info, ["label", "mark"]).select("key", "id", "rep", "n_links")
    # Components over keys: those of a class are tied to its least, classes through theirs.
    rep = info.select("id", "rep")
    across = (met.where("id != other").select("id", "other").distinct().join(rep.toDF("id", "a"), "id")
              .join(rep.toDF("other", "b"), "other").select("a", "b"))
    group = connected(across.unionByName(member.select(F.col("key").alias("a"), F.col("rep").alias("b"))))
    totals = member.groupBy("key").agg(F.max("n_links").alias("n_links"))
    result = totals.join(group.toDF("key", "component"), "key", "left")
    out = rows.select("id").join(result, rows["id"] == result["key"], "left")
    component = F.coalesce("component", "id")
    return out.select(F.col("id").cast(kind).alias(key), F.coalesce("n_links", F.lit(0)).alias("n_links"),
                      component.cast("long").alias("component_id"),
                      F.coalesce(component == F.col("id"), F.lit(False)).alias("kept"))
