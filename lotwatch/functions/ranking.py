"""Per-key picks and quantiles that stay balanced when one key holds most rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lotwatch.session import staged


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """One row per key, the greatest by ``order``; the other columns settle what is left equal.

    The maximum of a struct combines on the map side, so a key repeated across the whole input
    reaches the shuffle as one row per task.
    """
    named = [o for o in order if isinstance(o, str)]
    rest = [c for c in df.columns if c not in keys and c not in named]
    ordering = [
        F.col(o) if isinstance(o, str) else o.alias(f"_o{i}") for i, o in enumerate(order)
    ]
    picked = F.max(F.struct(*ordering, *rest)).alias("_row")
    return df.groupBy(*keys).agg(picked).select(*keys, "_row.*").select(*df.columns)


def in_ranges(df: DataFrame, order: Sequence[Column], name: str) -> DataFrame:
    """``df`` written in ranges of ``order``, with the number of each row's range as ``_range``.

    Ranges are numbered in the order, and their sizes are bounded by the sampled splits, not by
    any key's share of the rows.
    """
    ranged = df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id())
    return staged(ranged, name)


def global_rank(df: DataFrame, order: Sequence[Column], name: str) -> DataFrame:
    """Place of every row in ``order``, from 1: the rows before its range, and its place there."""
    rows = in_ranges(df, order, "ranged")
    sizes = rows.groupBy("_range").count()
    before = sizes.select("_range", (F.sum("count").over(Window.orderBy("_range")) - F.col("count")).alias("_before"))
    inside = F.row_number().over(Window.partitionBy("_range").orderBy(*order))
    return rows.withColumn("_in", inside).join(before, "_range").withColumn(
        name, (F.col("_before") + F.col("_in")).cast("int")).drop("_range", "_before", "_in")


def exact_quantiles(df: DataFrame, keys: Sequence[str], value: str, probs: Sequence[float],
                    names: Sequence[str], mean: str | None = None) -> DataFrame:
    """Exact interpolated quantiles per group, and the mean on request; null values don't count.

    Equal values are counted before anything is moved, and the distinct ones are written in
    ranges of (keys, value). Counts per range tell which ranges hold the wanted ranks, and only
    these are sorted, each as a group of its own. A group of any size follows the same route,
    and no window spans more than a range.
    """
    shown, keys = list(keys), list(keys)
    if not keys:
        # One group over everything still joins on a key, never as a product.
        df, keys = df.withColumn("_all", F.lit(1)), ["_all"]
    data = df.select(*keys, F.col(value).alias("_v")).filter(F.col("_v").isNotNull())
    counts = data.groupBy(*keys, "_v").agg(F.count(F.lit(1)).alias("_c"))
    ranged = in_ranges(counts, [F.asc(k) for k in keys] + [F.asc("_v")], "ranged-values")
    along = Window.partitionBy(*keys).orderBy("_range")
    sizes = ranged.groupBy(*keys, "_range").agg(F.sum("_c").alias("_in"))
    sizes = sizes.withColumn("_before", F.sum("_in").over(along) - F.col("_in")).withColumn(
        "_n", F.sum("_in").over(Window.partitionBy(*keys)))
    wanted = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(float(p)).alias("p")) for i, p in enumerate(probs)]))
    targets = sizes.withColumn("_w", wanted).withColumn("_rank", (F.col("_n") - 1) * F.col("_w.p")).filter(
        (F.ceil("_rank") >= F.col("_before")) & (F.floor("_rank") < F.col("_before") + F.col("_in")))
    needed = targets.select(*keys, "_range", "_before").distinct()
    rising = Window.partitionBy(*keys, "_range").orderBy("_v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = ranged.join(needed, [*keys, "_range"]).withColumn("_end", F.col("_before") + F.sum("_c").over(rising)).select(
        *keys, "_range", "_v", (F.col("_end") - F.col("_c")).alias("_start"), "_end")

    def at(rank: Column) -> Column:
        return F.max(F.when((rank >= F.col("_start")) & (rank < F.col("_end")), F.col("_v")))

    low, high = at(F.floor("_rank")), at(F.ceil("_rank"))
    weight = F.max(F.col("_rank") - F.floor("_rank"))
    per_prob = placed.join(targets.select(*keys, "_range", F.col("_w.i").alias("_i"), "_rank"), [*keys, "_range"]).groupBy(
        *keys, "_i").agg((low + (high - low) * weight).alias("_q"))
    result = per_prob.groupBy(*keys).agg(*[F.max(F.when(F.col("_i") == i, F.col("_q"))).alias(n) for i, n in enumerate(names)])
    if mean:
        result = result.join(data.groupBy(*keys).agg(F.avg("_v").alias(mean)), keys)
    return result.select(*shown, *([mean] if mean else []), *names)
