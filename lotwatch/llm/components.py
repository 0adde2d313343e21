"""Connected components of link tables of any size, and groups of what meets in buckets."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotwatch.llm.common import Written, cleaned


def connected(links: DataFrame) -> DataFrame:
    """(node, component) for the long columns ``a``, ``b`` of ``links``.

    ``component`` is the smallest node reachable; nodes that are their own component may be
    missing. Alternates large-star and small-star rounds: each hooks neighbours to the least
    node seen, so a group of any size or shape shrinks to a star in a few rounds. Minima are
    pre-aggregated and joins are plain ones, which adaptive execution splits at hot hubs. Every
    round is written to the shared folder and the one before removed. Self-links, repeated and
    null links are allowed.
    """
    edges = Written(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                    .where("a is not null and b is not null and u > v").distinct(), "edges")
    mark = None
    while True:
        now = edges.df.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if now == mark or not now[0]:
            return edges.df.select(F.col("u").alias("node"), F.col("v").alias("component"))
        mark = now
        both = edges.df.unionByName(edges.df.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        after = Written(small.unionByName(low.select("u", F.col("m").alias("v"))).distinct(), "edges")
        edges.drop()
        edges = after


def bucketed(postings: DataFrame) -> DataFrame:
    """``postings`` (key, node, ...) of buckets with two nodes or more, with two leaders of each."""
    shared = postings.groupBy("key").agg(F.min("node").alias("lo"), F.max("node").alias("hi"),
                                         F.count("*").alias("many")).where("lo < hi")
    return postings.join(shared, "key")


#: Rounds in which nodes of unsettled buckets meet further leaders, and leaders per bucket.
ROUNDS, LEADERS = 3, 4


def led(rest: DataFrame, turn: int) -> DataFrame:
    """(a, b) of nodes and further leaders of their buckets, as far as these are in other groups.

    Buckets of much the same nodes have much the same leaders, so a node that is in many of
    them meets their leaders once.
    """
    order = [F.xxhash64("node", F.lit(turn * LEADERS + k), F.pmod("key", F.lit(2))) for k in range(LEADERS)]
    chosen = rest.groupBy("key").agg(F.array_distinct(F.array(*[
        F.min_by(F.struct("node", "group"), o) for o in order])).alias("leaders"))
    others = rest.join(chosen, "key").select("node", F.expr(
        "array_sort(transform(filter(leaders, x -> x.group != group), x -> x.node))").alias("others"))
    others = others.where(F.size("others") > 0).distinct()
    return others.select(F.col("node").alias("a"), F.explode("others").alias("b")).distinct()


def grouped(members: DataFrame, named: DataFrame, likely: str | Callable[[DataFrame], DataFrame],
            verified: Callable[[DataFrame], DataFrame], here: str = "true", written: list[Written] | None = None,
            parts: int = 1, paired: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Components of the nodes that share a bucket and link.

    ``members`` is a written table as of ``bucketed``, ``named`` one of nodes and columns that
    describe them. ``likely`` is a condition that all linked pairs fulfil, in these columns with
    ``a_`` or ``b_`` before their names; ``verified`` picks from pairs (a, b) those that link. A column
    ``pos`` describes a node's place in the bucket, and ``here`` is a condition on both places
    that every linked pair fulfils in at least one of its buckets. ``likely`` may also pick from such
    pairs itself. ``paired`` then makes the pairs (a, b) of a bucket's nodes, of rows (key, node, group,
    many, ...) where ``many`` is at least the rows of the bucket, by ``likely`` and ``here`` or what they say.

    Every node is compared with its buckets' leaders first. While many pairs of different groups
    remain, their nodes meet a few other leaders, chosen by hash, that are in other groups, for
    some rounds. Nodes of a bucket that are then still in different groups are compared pairwise. So
    a bucket of near copies costs a few comparisons per member, and every link between what would be
    different groups is found. Pairs and unsettled buckets are taken in ``parts``, one after the
    other, so that only one part's shuffle is on disk. The tables written on the way that are not
    dropped here are added to ``written``, for the caller to drop.
    """
    written = [] if written is None else written

    def kept(df: DataFrame, name: str) -> DataFrame:
        written.append(Written(df, name))
        return written[-1].df

    def part(df: DataFrame, column: str, i: int) -> DataFrame:
        return df if parts == 1 else df.where(F.pmod(column, F.lit(parts)) == i)

    def drop(since: int) -> None:
        while len(written) > since:
            written.pop().drop()

    def each(make: Callable[[int], DataFrame], name: str) -> DataFrame:
        """All parts, written; what making one has written is dropped."""
        out = []
        for i in range(parts):
            since = len(written)
            table = Written(make(i), name)
            drop(since)
            written.append(table)
            out.append(table.df)
        return reduce(DataFrame.unionByName, out)

    def gathered(make: Callable[[int], DataFrame]) -> DataFrame:
        """Distinct rows of all parts, written only if there are several."""
        return make(0) if parts == 1 else each(make, "met").distinct()

    spot = [c for c in members.columns if c == "pos"]
    many = ["many"] if paired else []
    side = lambda df, x: df.select(*[F.col(c).alias(x if c == "node" else f"{x}_{c}") for c in df.columns if c != "key"],
                                   *[c for c in df.columns if c == "key"])

    def meeting(pairs: DataFrame, i: int) -> DataFrame:
        """Distinct pairs (a, b) of two nodes that may link, of one part."""
        pairs = pairs.where("a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        pairs = part(pairs, "a", i).distinct()
        pairs = pairs.join(side(named, "a"), "a").join(side(named, "b"), "b")
        return likely(pairs) if callable(likely) else pairs.where(likely).select("a", "b")

    def pairwise(rest: DataFrame, i: int) -> DataFrame:
        """Pairs (a, b) of different groups that may link, from the buckets of one part."""
        if paired:
            return paired(part(rest, "key", i).join(named, "node")).distinct()
        full = kept(part(rest, "key", i).join(named, "node"), "full")
        pairs = side(full, "a").join(side(full, "b"), "key").where(f"a < b and a_group != b_group and {likely} and {here}")
        return pairs.select("a", "b").distinct()

    def unsettled(group: DataFrame, i: int) -> DataFrame:
        """(key, node, group) of the buckets of one part that have nodes of different groups."""
        found = group.withColumnRenamed("node", "other")
        busy = part(members, "key", i).where("many > 2")
        busy = busy.join(found, busy["node"] == found["other"], "left").select(
            "key", "node", *spot, *many, F.coalesce("component", "node").alias("group")).distinct()
        mixed = busy.groupBy("key").agg(F.min("group").alias("x"), F.max("group").alias("y")).where("x < y").select("key")
        return busy.join(mixed, "key", "left_semi")

    leaders = members.select(F.col("node").alias("a"), F.explode(F.array("lo", "hi")).alias("b"))
    tried = each(lambda i: meeting(leaders, i), "stars")
    links = kept(verified(tried), "links")
    group = connected(links)
    before = float("inf")
    for turn in range(ROUNDS + 1):
        since = len(written)
        rest = each(lambda i: unsettled(group, i), "rest")
        with cleaned(rest.sparkSession):
            share = rest.groupBy("key", "group").count().groupBy("key").agg(
                F.sum("count").alias("n"), F.sum(F.col("count") * F.col("count")).alias("inside"))
            rows, pairs_left = share.agg(F.sum("n"), F.sum((F.col("n") * F.col("n") - F.col("inside")).cast("double") / 2)).first()
        if not rows:
            return group
        # Leaders are worth a round as long as the last one settled half of what was left.
        last = turn == ROUNDS or pairs_left <= 4 * LEADERS * rows or pairs_left > before / 2
        before = pairs_left
        if last:
            pairs = gathered(lambda i: pairwise(rest, i))
        else:
            met = gathered(lambda i: led(part(rest, "key", i), turn))
            pairs = gathered(lambda i: meeting(met, i))
        pairs = Written(pairs.join(tried, ["a", "b"], "left_anti"), "pairs")
        drop(since)
        written.append(pairs)
        links = links.unionByName(kept(verified(pairs.df), "links"))
        tried = tried.unionByName(pairs.df)
        group = connected(links)
        if last:
            return group
