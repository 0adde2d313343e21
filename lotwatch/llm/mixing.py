"""Mixing sources to target weights by a low-discrepancy schedule, in DataFrame operations.

Every source's documents are shuffled and laid end to end, and the stream is cut into equal
blocks of words. Slot i of the mix is the point frac(i * golden ratio); cumulative quotas map it
to a source, the slot's rank among the source's slots picks the block, and the join of slots
with blocks is the mix.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lotwatch.llm.common import Written

GOLDEN = 0.6180339887498949


@dataclass(frozen=True)
class MixParams:
    """``weights`` repeat over the sources by name, null last; ``most``: passes over a source at
    most; ``block``: words in a block, or a ``parts``-th of a small source; ``chunk``: slots that
    are ranked together; ``cells``: pieces of the unit interval by which slots find sources."""

    weights: tuple[int, ...] = (1, 2, 3)
    most: int = 3
    block: int = 1024
    parts: int = 64
    chunk: int = 8192
    cells: int = 4096


def size_of(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+``; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def sized(docs: DataFrame, text: str, source: str, key: str) -> DataFrame:
    order = F.md5(F.coalesce(docs[key].cast("string"), F.lit("")))
    return docs.select(docs[key].alias("id"), docs[source].alias("source"), size_of(docs[text]).alias("size"),
                       order.alias("at"), F.substring(order, 1, 3).alias("bucket"))


def targets(rows: DataFrame, params: MixParams) -> DataFrame:
    """Per source: size, weight, target, block size, blocks and quota of slots.

    Sources that would pass ``most`` times their size stop there; the rest shares what is left
    by weight. In order of cap over weight, the first source that its share doesn't fill fixes
    the share per weight for all after it.
    """
    by_name, by_fill = Window.orderBy(F.col("source").asc_nulls_last()), Window.orderBy("fill", "sid")
    before = by_fill.rowsBetween(Window.unboundedPreceding, -1)
    onward = by_fill.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    weights = F.array(*map(F.lit, params.weights))
    t = rows.groupBy("source").agg(F.sum("size").alias("s")).withColumn("sid", F.row_number().over(by_name))
    t = t.withColumn("w", F.get(weights, (F.col("sid") - 1) % len(params.weights)))
    t = t.withColumn("cap", F.col("s") * params.most).withColumn("fill", F.col("cap") / F.col("w"))
    share = (F.sum("s").over(Window.partitionBy()) - F.coalesce(F.sum("cap").over(before), F.lit(0))) / F.sum("w").over(onward)
    t = t.withColumn("share", share)
    first = F.min(F.when(F.col("share") <= F.col("fill"), F.struct("fill", "sid", "share"))).over(Window.partitionBy())
    t = t.withColumn("target", F.least(F.col("cap").cast("double"), first["share"] * F.col("w")))
    t = t.withColumn("blk", F.greatest(F.lit(1).cast("long"), F.least(F.lit(params.block).cast("long"), F.expr(f"s div {params.parts}"))))
    t = t.withColumn("nb", F.expr("(s + blk - 1) div blk"))
    passes = F.when(F.col("s") > 0, F.floor(F.col("target") / F.col("s"))).otherwise(F.lit(0))
    t = t.withColumn("passes", passes.cast("long"))
    quota = F.col("passes") * F.col("nb") + F.floor((F.col("target") - F.col("passes") * F.col("s")) / F.col("blk") + 0.5)
    t = t.withColumn("quota", quota.cast("long"))
    running = Window.orderBy("sid").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (t.withColumn("until", F.sum("quota").over(running))
            .select("sid", "source", "s", "w", "target", "blk", "nb", "quota",
                    (F.col("until") - F.col("quota")).alias("since"), "until",
                    F.sum("quota").over(Window.partitionBy()).alias("slots")))


def placed(rows: DataFrame, sources: DataFrame) -> DataFrame:
    """Each document's word range in its source's shuffled stream.

    The running sum is taken within hash buckets, and bucket totals are summed apart, so that a
    source with most of the rows is spread over all its buckets.
    """
    rows = rows.join(sources, rows["source"].eqNullSafe(sources["source"])).drop(sources["source"])
    inside = Window.partitionBy("sid", "bucket").orderBy("at", "id", "size").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    along = Window.partitionBy("sid").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    ahead = (rows.groupBy("sid", "bucket").agg(F.sum("size").alias("total"))
             .select("sid", "bucket", F.coalesce(F.sum("total").over(along), F.lit(0)).alias("ahead")))
    rows = rows.withColumn("after", F.sum("size").over(inside)).join(ahead, ["sid", "bucket"])
    after = F.col("after") + F.col("ahead")
    return rows.withColumn("first", after - F.col("size")).withColumn("after", after).drop("ahead", "at", "bucket")


def slots(rows: DataFrame, sources: DataFrame, params: MixParams) -> DataFrame:
    """(slot, sid, rank, block): the mix in order, each slot with the block that it takes."""
    spark = rows.sparkSession
    n = sources.agg(F.max("slots")).first()[0] or 0
    cell = lambda x: F.floor(x * params.cells / F.lit(max(n, 1))).cast("long")
    point = F.col("slot") * F.lit(GOLDEN)
    line = spark.range(n).withColumnRenamed("id", "slot").withColumn("v", (point - F.floor(point)) * n)
    line = line.withColumn("cell", cell(F.col("v")))
    spread = sources.where("quota > 0").select("sid", "since", "until", "quota", F.explode(
        F.sequence(cell(F.col("since")), cell(F.col("until")))).alias("cell"))
    line = line.join(spread, "cell").where("v >= since and v < until").select(
        "slot", "sid", "quota", F.expr(f"slot div {params.chunk}").alias("chunk"))
    # Ranks within a source: counts per chunk of slots are summed apart, as for documents.
    along = Window.partitionBy("sid").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    counts = line.groupBy("sid", "chunk").count()
    ahead = counts.select("sid", "chunk", F.coalesce(F.sum("count").over(along), F.lit(0)).alias("ahead"))
    inside = Window.partitionBy("sid", "chunk").orderBy("slot")
    ranked = (line.withColumn("n", F.row_number().over(inside)).join(ahead, ["sid", "chunk"])
              .withColumn("rank", F.col("ahead") + F.col("n") - 1).where("rank < quota").select("slot", "sid", "rank"))
    # The few slots that the sequence leaves short of a quota follow at the end.
    short = (sources.join(counts.groupBy("sid").agg(F.sum("count").alias("have")), "sid", "left")
             .withColumn("have", F.coalesce("have", F.lit(0))).where("have < quota")
             .select("sid", F.explode(F.sequence(F.col("have"), F.col("quota") - 1)).alias("rank"))
             .select((F.col("rank") + n).alias("slot"), "sid", "rank"))
    return (ranked.unionByName(short).join(sources.select("sid", "nb"), "sid")
            .select("slot", "sid", "rank", (F.col("rank") % F.col("nb")).alias("block")))


class Mix:
    """A mix over ``docs``: ``documents`` (word ranges), ``slots`` and their join.

    Documents of null source form a source of their own, last in order. Null and empty texts
    have size 0 and are never taken. Repeated rows are mixed as rows of their own; a null key
    shuffles like an empty one. The order depends on keys alone, so reruns agree. Other columns
    of ``docs`` are ignored. Only the number of slots reaches the driver.
    """

    def __init__(self, docs: DataFrame, params: MixParams = MixParams(), text: str = "text",
                 source: str = "source", key: str = "doc_id") -> None:
        self.key = key
        rows = Written(sized(docs, text, source, key), "mix-sizes").df
        self.sources = Written(targets(rows, params), "mix-sources").df
        self.documents = placed(rows, self.sources)
        self.slots = slots(rows, self.sources, params)

    def pieces(self) -> DataFrame:
        """Each document's share of each block of its source."""
        blocks = F.explode(F.sequence(F.expr("first div blk"), F.expr("(after - 1) div blk")))
        return (self.documents.where("size > 0").withColumn("block", blocks)
                .withColumn("low", F.greatest("first", F.col("block") * F.col("blk")))
                .withColumn("high", F.least("after", (F.col("block") + 1) * F.col("blk"))))

    def sequence(self) -> DataFrame:
        """The mix: in slot order, the words [from_word, to_word) of documents that it takes."""
        return self.slots.join(self.pieces(), ["sid", "block"]).select(
            "slot", "sid", "first", F.col("id").alias(self.key), (F.col("low") - F.col("first")).alias("from_word"),
            (F.col("high") - F.col("first")).alias("to_word"))

    def taken(self) -> DataFrame:
        """Per document: key, source, size, source_size, target and the words that the mix takes."""
        used = (self.sequence().groupBy("sid", "first").agg(F.sum(F.col("to_word") - F.col("from_word")).alias("taken"))
                .withColumn("full", F.lit(True)))
        docs = self.documents.withColumn("full", F.col("size") > 0)
        return docs.join(used, ["sid", "first", "full"], "left").select(
            F.col("id").alias(self.key), "source", "size", F.col("s").alias("source_size"), "target",
            F.coalesce("taken", F.lit(0)).alias("taken"))
