"""Decontamination, joins, lines, vectors, mixing and the pipeline against brute force."""

import hashlib
import itertools
import re

import corpus_pipeline
import numpy as np
import pytest
from pyspark.sql import functions as F

from lotwatch.llm import components, contamination, jaccard, lines, vectors
from lotwatch.llm.mixing import Mix, MixParams


def lower(text):
    return "".join(c.lower() if c.isascii() else c for c in text or "")


def reachable(nodes, links):
    root = {n: n for n in nodes}
    changed = True
    while changed:
        changed = False
        for a, b in links:
            low = min(root[a], root[b])
            if root[a] != low or root[b] != low:
                root[a] = root[b] = low
                changed = True
    return root


def vary(rng, words, n):
    out = list(words)
    for _ in range(n):
        out[rng.integers(len(out))] = f"w{rng.integers(10 ** 9)}"
    return out


def test_components(spark):
    rng = np.random.default_rng(1)
    links = [(int(a), int(b)) for a, b in rng.integers(0, 150, (110, 2))] + [(200 + i, 201 + i) for i in range(40)] + [
        (500, i) for i in range(501, 560)] + [(7, 7), (None, 3)]
    got = {r.node: r.component for r in components.connected(spark.createDataFrame(links, "a long, b long")).collect()}
    nodes = {x for p in links for x in p if x is not None}
    want = reachable(nodes, [p for p in links if None not in p])
    assert {n: got.get(n, n) for n in nodes} == want
    assert components.connected(spark.createDataFrame([], "a long, b long")).count() == 0


def passages(docs, items, window=10):
    word = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    windows = {}
    for item, text in items:
        w = word.findall(lower(text))
        n = min(window, len(w))
        for i in range(len(w) - n + 1 if w else 0):
            windows.setdefault(tuple(w[i:i + n]), set()).add(item)
    out = {}
    for key, text in docs:
        w, hit, found = word.findall(lower(text)), set(), set()
        for n in {len(x) for x in windows}:
            for i in range(len(w) - n + 1):
                if (ids := windows.get(tuple(w[i:i + n]))):
                    hit.update(range(i, i + n))
                    found |= ids
        out[key] = (len(w), len(hit), sorted(found, key=lambda x: (x is None, x)))
    return out


@pytest.mark.parametrize("block_bytes", [8 << 20, 300])
def test_decontamination(spark, corpus, by_id, block_bytes):
    rng = np.random.default_rng(2)
    word = [f"w{i}" for i in range(40)] + ["Ünï", "x9"]
    item = lambda n: " ".join(rng.choice(word, n))
    items = [(f"i{i}", item(int(n))) for i, n in enumerate(rng.integers(10, 30, 12))]
    items += [("short", "alpha beta"), ("one", "gamma"), ("same", items[0][1]), ("none", "-- !"), ("null", None), (None, "w1 w2")]
    texts = [item(200) for _ in range(10)] + [f"{item(5)}, {items[3][1].upper()}! {item(3)} {items[5][1]}", "Alpha; BETA gamma", "alpha",
                                             None, "", items[0][1], items[0][1], f"{item(9000)} {items[7][1][5:]} {item(9000)} {items[8][1]}"]
    bench = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id string, text string, n_words string")
    params = contamination.SearchParams(block_bytes=block_bytes)
    docs = corpus(texts)
    got = by_id(contamination.find_passages(docs, bench, params))
    want = passages(list(enumerate(texts)), [x for x in items if x[1] is not None])
    assert any(w[2] for w in want.values())
    for i, (n, hit, found) in want.items():
        assert (got[i].n_words, sum(s.after - s.first for s in got[i].spans), got[i]["items"]) == (n, hit, found), texts[i][:80]
    kept = contamination.drop_contaminated(docs, bench, params)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {i for i, w in want.items() if not w[1]}
    assert contamination.find_passages(docs, bench.limit(0)).where("size(spans) > 0").count() == 0
    assert contamination.find_passages(docs.limit(0), bench).count() == 0


def shingle_groups(docs, percent=80):
    sets = {}
    for key, text in docs:
        w = re.findall("[^\x20\x09-\x0D]+", lower(text))
        sets[key] = {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()
    links = [(a, b) for a, b in itertools.combinations(sets, 2)
             if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    return {k: len(s) for k, s in sets.items()}, reachable(sets, links), links


def near_copies(rng):
    """Groups of near copies, chains of them, sets of all small sizes, and shared passages."""
    word = [f"v{i}" for i in range(400)]
    passage = list(rng.choice(word, 60))
    out = []
    for size in [4, 5, 6, 8, 9, 10, 11, 13, 15, 16, 18, 20, 21, 25, 40, 80, 150]:
        base = list(rng.choice(word, size))
        out += [base, base[:], base[:-1], [*base, "tail"], vary(rng, base, 1), vary(rng, base, 1 + size // 40)]
        if size > 20:
            chain = base
            for _ in range(6):
                chain = vary(rng, chain, max(1, size // 60))
                out.append(chain)
    out += [[*rng.choice(word, 40), *passage, *rng.choice(word, 40)] for _ in range(25)]
    out += [vary(rng, passage, int(n)) for n in rng.integers(0, 4, 25)]
    return [" ".join(x) for x in out]


def test_jaccard_groups(corpus, by_id):
    texts = [*near_copies(np.random.default_rng(3)), None, "", " \n\t", "One", "one", "a b c d", "A B C D", "z " * 20_000, "z " * 9_000]
    docs = corpus(texts)
    sizes, root, links = shingle_groups(list(enumerate(texts)))
    assert len(links) > 100
    groups = jaccard.linked_groups(docs)
    got = by_id(groups)
    assert {i: (r.n_shingles, r.component_id) for i, r in got.items()} == {i: (sizes[i], root[i]) for i in sizes}
    kept = jaccard.keep_one(docs, groups)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == sorted(i for i in root if root[i] == i)


def test_jaccard_edge_cases(spark, corpus, nulls):
    docs = corpus(["a b c d e f"])
    assert jaccard.linked_groups(docs.limit(0)).count() == 0
    twice = docs.union(docs)
    assert [tuple(r) for r in jaccard.linked_groups(twice).collect()] == [(0, 2, 0)] * 2
    assert jaccard.keep_one(twice, jaccard.linked_groups(twice)).count() == 1
    assert [tuple(r) for r in jaccard.linked_groups(nulls).collect()] == [(None, 0, None)]
    assert jaccard.keep_one(nulls, jaccard.linked_groups(nulls)).count() == 1


def test_hot_group_costs_one_comparison_each(spark):
    """A hundred near copies and a hundred that share half of their words: no all-pairs output."""
    rng = np.random.default_rng(4)
    base = [f"b{i}" for i in range(100)]
    texts = [" ".join(vary(rng, base, 1)) for _ in range(100)] + [
        " ".join(base[:50] + [f"u{i}_{j}" for j in range(50)]) for i in range(100)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in jaccard.linked_groups(docs).collect()}
    assert got == shingle_groups(list(enumerate(texts)))[1]


def test_light_and_heavy_meet_at_every_boundary(corpus, by_id):
    texts = near_copies(np.random.default_rng(5))[:70]
    want = shingle_groups(list(enumerate(texts)))[1]
    for cost in (1, 1000):  # all sets heavy, then as many light as may be
        got = by_id(jaccard.linked_groups(corpus(texts), jaccard.JaccardParams(scan_cost=cost)))
        assert {i: r.component_id for i, r in got.items()} == want
    assert jaccard.boundary({5: 10, 100: 1}, jaccard.JaccardParams(scan_cost=1000)) > 5


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j - 1] + (x != y), row[j] + 1, new[-1] + 1))
        row = new
    return row[-1]


def repeated(docs, params):
    """Numbers of removed lines by document, all pairs of lines compared."""
    seen = {}
    for key, text in docs:
        for number, line in enumerate((text or "").split("\n")):
            plain = " ".join(re.findall("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[0-9]", "0", lower(line))))
            if len(plain) >= params.shortest:
                seen.setdefault(plain, []).append((key, number))
    plain = list(seen)
    links = [(a, b) for a, b in itertools.combinations(plain, 2)
             if 10 * abs(len(a) - len(b)) <= max(len(a), len(b)) and 100 * distance(a, b) <= (100 - params.percent) * max(len(a), len(b))]
    root, groups = reachable(plain, links), {}
    for p in plain:
        groups.setdefault(root[p], []).extend(seen[p])
    out = {}
    for places in groups.values():
        for key, number in set(places) - {min(places)}:
            out.setdefault(key, set()).add(number)
    return out, links


def test_line_dedup(corpus, by_id, nulls):
    rng = np.random.default_rng(6)
    line = lambda n: " ".join("".join(rng.choice(list("abcdefgh"), rng.integers(2, 11))) for _ in range(n))
    pool = [line(int(n)) for n in rng.integers(5, 25, 12)]

    def typo(x):
        at = rng.integers(len(x))
        return x[:at] + "z" + x[at + 1:]

    texts = ["\n".join([line(8), typo(pool[i % 12]), pool[(i * 5) % 12].upper(), "", "short"]) for i in range(30)]
    texts += [None, "", "\n\n", "id 1234 seen at the northern gate\nid 9876 seen, at the northern gate!", pool[0] + "\n" + pool[0], pool[1] * 300]
    docs = corpus(texts).drop("_lines")
    params = lines.LineParams()
    want, links = repeated(list(enumerate(texts)), params)
    assert len(links) > 10
    assert {r.doc_id: set(r["lines"]) for r in lines.repeated_lines(docs, params).collect()} == want
    got = by_id(lines.drop_repeated_lines(docs, params))
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        gone = want.get(i, set())
        assert got[i].text == (t and "\n".join(x for k, x in enumerate(t.split("\n")) if k not in gone))
        assert (got[i]._lines, got[i]._removed) == (len(t.split("\n")) if t is not None else 0, len(gone))
    assert lines.drop_repeated_lines(docs.limit(0)).count() == 0
    assert [r.text for r in lines.drop_repeated_lines(nulls).collect()] == [None]
    same = corpus(["the very same line of text here"]).drop("_lines")
    assert lines.drop_repeated_lines(same.union(same)).where("_removed > 0").count() == 0


def test_distance_within():
    rng = np.random.default_rng(11)
    for _ in range(500):
        a = "".join(rng.choice(list("abc"), rng.integers(0, 14)))
        b = "".join(rng.choice(list("abc"), rng.integers(0, 14))) if rng.random() < 0.5 else a[:3] + "x" + a[4:]
        for limit in range(6):
            assert lines.distance_within(a, b, limit) == (distance(a, b) <= limit), (a, b, limit)


def test_vectors(spark):
    rng = np.random.default_rng(8)
    rows, n = [], 0
    for label in (0, 1):
        for _ in range(12):
            base = rng.normal(size=16)
            for scale in rng.choice([0, 0.05, 0.1, 0.2], 12):
                rows.append((n, (base + scale * rng.normal(size=16)).tolist(), label))
                n += 1
    rows += [(n + i, rows[3][1], rows[3][2]) for i in range(5)]
    n += 5
    good = len(rows)
    rows += [(n, None, 0), (n + 1, [0.0] * 16, 0), (n + 2, [1.0, None] + [0.0] * 14, 0), (n + 3, [float("nan")] + [1.0] * 15, 0),
             (n + 4, rows[0][1], None), (n + 5, [float("inf")] + [0.0] * 15, 1), (n + 6, [], 1), (n + 7, rows[0][1], 1)]
    df = spark.createDataFrame([(*r, 9) for r in rows], "vec_id long, embedding array<double>, label int, n_links int").repartition(4)
    units = {r[0]: (r[2], np.array(r[1]) / np.linalg.norm(r[1])) for r in [*rows[:good], rows[-1]]}
    links = [(a, b) for a, b in itertools.combinations(units, 2)
             if units[a][0] == units[b][0] and units[a][1] @ units[b][1] >= 0.93]
    assert len(links) > 200
    root = reachable([r[0] for r in rows], links)
    for params in (vectors.RangeParams(), vectors.RangeParams(cell=20, block=8)):
        got = {r.vec_id: r for r in vectors.near_duplicates(df, params).collect()}
        assert len(got) == len(rows)
        for key in root:
            assert got[key].component_id == root[key] and got[key].kept == (root[key] == key)
            assert got[key].n_links == sum(key in link for link in links), key
    assert vectors.near_duplicates(df.limit(0)).count() == 0


def test_vector_rows_of_one_key_and_null_keys(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0], 0), (1, [1.0, 0.0], 0), (None, [1.0, 0.0], 0), (2, [1.0, 0.1], 0)],
                               "vec_id long, embedding array<double>, label int")
    got = sorted((r.vec_id or 0, r.n_links, r.component_id or 0, r.kept) for r in vectors.near_duplicates(df).collect())
    assert got == [(0, 0, 0, False), (1, 1, 1, True), (1, 1, 1, True), (2, 1, 1, False)]


def water_filling(sizes, weights, most=3):
    target, left, open_ = {}, sum(sizes.values()), set(sizes)
    while True:
        share = left / (sum(weights[s] for s in open_) or 1)
        over = {s for s in open_ if share * weights[s] > most * sizes[s]}
        if not over:
            return target | {s: share * weights[s] for s in open_}
        for s in over:
            target[s] = float(most * sizes[s])
            left -= target[s]
        open_ -= over


def test_mixing(corpus, nulls):
    rng = np.random.default_rng(9)
    texts = ["w " * int(n) for n in rng.integers(0, 300, 200)] + [None, "", "one", "x " * 40_000]
    source = {i: ("big" if i % 3 else f"s{i % 7}") for i in range(len(texts))} | {5: None, 8: None, 11: "tiny", 201: None}
    docs = corpus(texts, source=source)
    sizes = {}
    for i, t in enumerate(texts):
        sizes[source[i]] = sizes.get(source[i], 0) + len((t or "").split())
    names = sorted((s for s in sizes if s is not None)) + [None]
    want = water_filling(sizes, {s: 1 + i % 3 for i, s in enumerate(names)})
    mix = Mix(docs)
    got = mix.taken().collect()
    assert sorted(r.doc_id for r in got) == list(range(len(texts)))
    taken = {}
    for r in got:
        assert r.size == len((texts[r.doc_id] or "").split()) and r.source_size == sizes[r.source]
        assert r.target == pytest.approx(want[r.source]) and 0 <= r.taken <= 3 * r.size
        taken[r.source] = taken.get(r.source, 0) + r.taken
    for s, n in taken.items():
        assert abs(n - want[s]) <= max(1, min(1024, sizes[s] / 64)), s
    assert sorted(map(tuple, got), key=str) == sorted(map(tuple, Mix(docs.repartition(7)).taken().collect()), key=str)
    # The sequence holds the words that are counted, and is well mixed from its start.
    slots = mix.sequence().withColumn("n", F.col("to_word") - F.col("from_word"))
    assert slots.agg(F.sum("n")).first()[0] == sum(taken.values())
    assert slots.where("from_word < 0 or to_word <= from_word").count() == 0
    line = [r.sid for r in mix.slots.orderBy("slot").collect()]
    share = {s: line.count(s) / len(line) for s in set(line)}
    half = line[:len(line) // 2]
    assert all(abs(half.count(s) / len(half) - share[s]) < 0.02 for s in share)
    assert Mix(docs.limit(0)).taken().count() == 0
    assert [r.taken for r in Mix(nulls).taken().collect()] == [0]


def test_mixing_parameters(corpus):
    docs = corpus(["a b c d " * 50] * 9)
    got = Mix(docs, MixParams(weights=(1,), block=16)).taken().collect()
    assert all(r.taken == r.size for r in got)


def test_pipeline_stages_by_brute_force(spark, sf):
    """Each stage on its own input: what it drops and what it keeps."""
    docs = spark.read.parquet(f"{sf}/documents.parquet").cache()
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["language_id", "line_dedup", "jaccard_join", "decontamination", "mixing"]
    rows = lambda df: {r.doc_id: r.text for r in df.collect()}
    all_docs = rows(docs)

    one = stages["language_id"](spark, docs, sf)
    assert one.schema == docs.schema
    assert rows(one) == {i: t for i, t in all_docs.items() if any(c.isalpha() for c in t)}

    two = stages["line_dedup"](spark, docs, sf)
    assert two.columns == docs.columns
    gone, _ = repeated(list(all_docs.items()), lines.LineParams())
    cut = {i: "\n".join(x for k, x in enumerate(t.split("\n")) if k not in gone.get(i, ())) for i, t in all_docs.items()}
    assert rows(two) == {i: t for i, t in cut.items() if t.strip(" \t\n\r\x0b\x0c") or i not in gone}
    assert all(r.n_chars == len(r.text) for r in two.where("doc_id in ({})".format(",".join(map(str, gone)))).collect())

    three = stages["jaccard_join"](spark, docs, sf)
    root = shingle_groups(list(all_docs.items()))[1]
    assert three.schema == docs.schema and rows(three) == {i: t for i, t in all_docs.items() if root[i] == i}

    four = stages["decontamination"](spark, docs, sf)
    bench = [tuple(r) for r in spark.read.parquet(f"{sf}/benchmark.parquet").select("item_id", "text").collect()]
    hit = passages(list(all_docs.items()), [(str(i), t) for i, t in bench])
    assert four.schema == docs.schema and rows(four) == {i: t for i, t in all_docs.items() if not hit[i][1]}

    five = stages["mixing"](spark, docs, sf)
    assert sorted(r.doc_id for r in five.collect()) == sorted(all_docs)


def test_pipeline_runs_all_stages(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf)
    want = sorted(map(tuple, docs.collect()), key=str)
    assert want and sorted(map(tuple, corpus_pipeline.run(spark, sf).collect()), key=str) == want


def test_pipeline_stages_take_nulls_and_empty_tables(spark, sf, nulls):
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, nulls, sf).count() <= 1
        assert stage(spark, nulls.limit(0), sf).count() == 0


def test_items_digest_of_no_items(spark, sf):
    from lotwatch.llm.queries import QUERIES

    row = QUERIES["op3_decontamination"](spark, sf).where("n_items = 0").first()
    assert row.items_sha256 == hashlib.sha256(b"").hexdigest() and not row.contaminated
