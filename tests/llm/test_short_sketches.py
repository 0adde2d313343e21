"""Pairs of sets that are ruled out where they meet: none that links, and nearly all others of a bucket."""

import numpy as np

from lotwatch.llm import components, jaccard


def test_short_sketches_differ_in_no_more_bits_than_sets():
    rng = np.random.default_rng(2)
    for size in (1, 3, 40, 900):
        one = rng.integers(0, 2**63, size, dtype=np.uint64)
        two = np.concatenate([one[size // 5:], rng.integers(0, 2**63, size // 4, dtype=np.uint64)])
        found = jaccard.short_sketches(np.concatenate([one, two]), np.array([0, len(one), len(one) + len(two)]))
        bits = np.unpackbits(found.view(np.uint8)).reshape(2, -1)
        assert len(found) == 2 * jaccard.SHORT
        assert (bits[0] != bits[1]).sum() <= len(set(one.tolist()) ^ set(two.tolist()))
    assert len(jaccard.short_sketches(np.zeros(0, np.uint64), np.array([0, 0]))) == jaccard.SHORT


def test_unlike_texts_of_one_bucket_make_few_pairs(corpus, monkeypatch):
    """60 texts share their rarest passage and little else, so that all meet in its buckets."""
    rng = np.random.default_rng(6)
    words = [f"w{i}" for i in range(12)]
    texts = ["rare passage that all of them hold once " + " ".join(rng.choice(words[:3], 60)) for _ in range(60)]
    texts += [texts[0] + " end", texts[5] + " end"]
    counts, plain = {}, components.Written

    class Counted(plain):
        def __init__(self, df, name):
            super().__init__(df, name)
            counts.setdefault(name, []).append(self.df.count())

    monkeypatch.setattr(components, "Written", Counted)
    got = {r.doc_id: r.component_id for r in jaccard.linked_groups(corpus(texts)).collect()}
    assert got == {**{i: i for i in range(60)}, 60: 0, 61: 5}
    assert sum(counts["stars"]) + sum(counts.get("pairs", [])) < 30


def test_nodes_of_one_group_do_not_meet_again(spark):
    """118 nodes that share 20 buckets link by their remainder of 3; the first leaders settle one group of 40."""
    rows = [(key, node) for key in range(20) for node in range(118)]
    members = spark.createDataFrame([(k, n, 0, 117, 118) for k, n in rows], "key long, node long, lo long, hi long, many long")
    met = []

    def same(pairs):
        met.append([tuple(p) for p in pairs.collect()])
        return pairs.where("a % 3 = b % 3")

    group = components.grouped(members, spark.range(118).withColumnRenamed("id", "node"), "a >= 0", same)
    root = {r.node: r.component for r in group.collect()}
    assert len(met) > 2 and [root.get(n, n) for n in range(118)] == [n % 3 for n in range(118)]
    assert not [p for pairs in met[1:] for p in pairs if p[0] % 3 == p[1] % 3 == 0]
    assert len(set(met[1])) == len(met[1])


def test_a_node_meets_the_leaders_of_like_buckets_once(spark):
    """60 nodes in 3 groups share 40 buckets: a few leaders each, however many buckets."""
    rest = spark.createDataFrame([(key, node, node % 3) for key in range(40) for node in range(60)], "key long, node long, group long")
    got = [tuple(r) for r in components.led(rest, 0).collect()]
    assert got and len(got) == len(set(got)) <= 60 * 2 * components.LEADERS
    assert all(a % 3 != b % 3 for a, b in got)
