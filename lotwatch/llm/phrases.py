"""Phrase collocations: suffix pointers sorted by multikey three-way quicksort, counted by partition.

Words are counted first. Every word then begins a suffix of at most ``longest`` words that ends
with its piece or before a word that is rare in its language, since no phrase with a rare word is
frequent. Suffixes are sent to buckets by their leading words, each bucket's pointers are sorted
word by word, and the size of a partition of equal words is the count of that phrase. Partitions
too small to hold a frequent phrase are abandoned.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lotwatch.llm.common import Written, map_slices, marked, marks, texts
from lotwatch.llm.words import LOWER, find, mix, span_hashes


@dataclass(frozen=True)
class PhraseParams:
    """``least``: occurrences of a phrase that counts; ``longest``: its words; ``covered``: percent
    of a phrase's occurrences that lie inside one longer phrase, at which it is dropped; ``top``:
    phrases reported per language. ``bucket``: words sorted together, about; ``heavy``: occurrences
    of a word from which its phrases are routed by further words."""

    least: int = 30
    longest: int = 4
    covered: int = 80
    top: int = 2000
    bucket: int = 1 << 20
    heavy: int = 1 << 20


PARTING = np.isin(np.arange(256), [ord(c) for c in ".,;:!?\n\x0b\x0c\r"])
#: Bytes of words: neither blanks nor the signs and line ends that part pieces.
INSIDE = ~PARTING & ~np.isin(np.arange(256), [0x20, 0x09])


@dataclass(frozen=True)
class Tokens:
    """Words of a slice: their bytes, row, hash (of word and language), and whether the next word
    follows in the same piece."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    row: np.ndarray
    hashes: np.ndarray
    joined: np.ndarray


def tokens(text: pa.Array, lang: pa.Array) -> Tokens:
    data, rows = texts(text)
    data = LOWER[data]
    starts, ends, row = find(data, rows, INSIDE)
    names, at = texts(lang)
    salt = span_hashes(names, at[:-1], at[1:])
    hashes = mix(span_hashes(data, starts, ends) + salt[row])
    parted = np.concatenate([[0], np.cumsum(PARTING[data])])
    joined = np.zeros(len(starts), bool)
    joined[:-1] = (row[1:] == row[:-1]) & (parted[starts[1:]] == parted[ends[:-1]])
    return Tokens(data, starts, ends, row, hashes.astype(np.int64), joined)


def spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The byte spans as strings."""
    size = ends - starts
    offsets = np.concatenate([[0], np.cumsum(size)])
    at = np.arange(offsets[-1]) + np.repeat(starts - offsets[:-1], size)
    return pa.LargeStringArray.from_buffers(len(size), pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data[at])))


def spaced(t: Tokens) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All words one after the other with one blank behind each, and where they start and end."""
    size = t.ends - t.starts + 1
    after = np.cumsum(size)
    first = after - size
    at = np.arange(after[-1] if len(after) else 0) + np.repeat(t.starts - first, size)
    data = t.data[np.minimum(at, len(t.data) - 1)] if len(at) else t.data[:0]
    data[after - 1] = 0x20
    return data, first, after - 1


def count_words(docs: DataFrame) -> DataFrame:
    """(lang, word, mark, f) of every word, and one row of each language's total with an empty word."""
    def run(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        lang = batch.column("lang")
        t = tokens(batch.column("text"), lang)
        if not len(t.starts):
            return None
        table = pa.table({"lang": lang.take(pa.array(t.row)), "word": spans(t.data, t.starts, t.ends), "mark": pa.array(t.hashes)})
        counts = table.group_by(["lang", "word", "mark"]).aggregate([([], "count_all")]).rename_columns(["lang", "word", "mark", "f"])
        total = counts.group_by("lang").aggregate([("f", "sum")])
        n = total.num_rows
        both = pa.concat_tables([counts.cast(SCHEMA), pa.table({
            "lang": total["lang"], "word": pa.array([""] * n), "mark": pa.array([0] * n), "f": total["f_sum"]}).cast(SCHEMA)])
        return both.combine_chunks().to_batches()[0]

    return map_slices(docs, run, "lang string, word string, mark long, f long").groupBy("lang", "word", "mark").agg(F.sum("f").alias("f"))


SCHEMA = pa.schema([("lang", pa.string()), ("word", pa.string()), ("mark", pa.int64()), ("f", pa.int64())])
ROUTED = "bucket long, lang string, open int, suffixes string, counts binary"


def suffixes(docs: DataFrame, frequent: np.ndarray, heavy: np.ndarray, buckets: int, params: PhraseParams) -> DataFrame:
    """Distinct suffixes of each slice with their counts, packed by bucket.

    A suffix is routed by its words up to the first that isn't heavy, two at least. So all
    suffixes that begin with such words meet in one bucket, and no more than ``heavy`` of them
    have them. Suffixes of heavy words only are routed by all words and by the task, and
    ``open``, the number of leading words that are heavy, tells which counts are still parts.
    """
    def run(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        lang = batch.column("lang")
        t = tokens(batch.column("text"), lang)
        n, longest = len(t.starts), params.longest
        if n < 2:
            return None
        often, hot = marked(frequent, t.hashes), marked(heavy, t.hashes)
        # Words in the suffix, leading heavy words, and the hash of the words that route it.
        size, hots = often.astype(np.int64), hot.astype(np.int64)
        route = mix(t.hashes.astype(np.uint64))
        going, all_hot = often.copy(), hot.copy()
        for d in range(1, min(longest, n)):
            further = np.zeros(n, bool)
            further[:n - d] = going[:n - d] & t.joined[d - 1:n - 1] & often[d:]
            going = further
            size += going
            routes = going & (all_hot | (d == 1))
            nth = np.flatnonzero(routes)
            route[nth] = mix(route[nth] + t.hashes[nth + d].astype(np.uint64))
            next_hot = np.zeros(n, bool)
            next_hot[:n - d] = hot[d:]
            all_hot &= going & next_hot
            hots += all_hot
        keep = np.flatnonzero(size >= 2)
        if not len(keep):
            return None
        size, hots, route = size[keep], hots[keep], route[keep]
        parts = np.uint64(TaskContext.get().partitionId() + 1)
        route = np.where(hots == size, mix(route + parts), route)
        data, first, after = spaced(t)
        table = pa.table({
            "bucket": pa.array((route % np.uint64(buckets)).astype(np.int64)), "lang": lang.take(pa.array(t.row[keep])),
            "open": pa.array(hots.astype(np.int32)), "suffix": spans(data, first[keep], after[keep + size - 1])})
        counts = table.group_by(["bucket", "lang", "open", "suffix"]).aggregate([([], "count_all")])
        counts = counts.sort_by([("bucket", "ascending"), ("lang", "ascending"), ("open", "ascending")]).combine_chunks()
        return packed(counts)

    return map_slices(docs, run, ROUTED)


def packed(counts: pa.Table) -> pa.RecordBatch:
    """One row for each bucket, language and ``open`` of a sorted table: its suffixes by lines."""
    bucket, kind = counts["bucket"].to_numpy(), counts["open"].to_numpy()
    code = pc.dictionary_encode(counts["lang"].combine_chunks()).indices.to_numpy()
    new = np.ones(len(bucket), bool)
    new[1:] = (bucket[1:] != bucket[:-1]) | (kind[1:] != kind[:-1]) | (code[1:] != code[:-1])
    at = np.flatnonzero(new)
    offsets = pa.array(np.append(at, len(bucket)), pa.int32())
    lines = pc.binary_join(pa.ListArray.from_arrays(offsets, counts["suffix"].combine_chunks()), pa.scalar("\n", pa.large_string()))
    raw = counts["count_all"].to_numpy().astype("<i4")
    return pa.RecordBatch.from_arrays([
        pa.array(bucket[at]), counts["lang"].combine_chunks().take(pa.array(at)), pa.array(kind[at]), lines.cast(pa.string()),
        pa.array([raw[a:b].tobytes() for a, b in zip(at, [*at[1:], len(bucket)])], pa.binary())],
        ["bucket", "lang", "open", "suffixes", "counts"])


def equal_partitions(keys: np.ndarray, weights: np.ndarray, opened: np.ndarray, least: int) -> Iterator[tuple[np.ndarray, int, np.ndarray]]:
    """Multikey three-way quicksort of pointers to rows of ``keys`` (words as numbers, -1 at the end).

    All partitions of a round are split together by a pivot of their own into less, equal and
    greater; the equal ones go on with the next word. Yields (first pointers, words, weights) of
    equal partitions. A partition lighter than ``least`` is abandoned unless one of its rows may
    begin a phrase whose other rows are in other buckets: those with ``opened`` beyond its words.
    """
    n, longest = keys.shape
    order = np.arange(n)
    begin, depth = np.array([0]), np.array([0])
    while len(order):
        size = np.diff(np.append(begin, len(order)))
        total = np.add.reduceat(weights[order], begin)
        reach = np.maximum.reduceat(opened[order], begin)
        live = (total >= least) | (reach > np.maximum(depth, 1))
        order = order[np.repeat(live, size)]
        size, depth = size[live], depth[live]
        if not len(order):
            return
        begin = np.cumsum(size) - size
        word = keys[order, np.repeat(depth, size)]
        # The median of the first, middle and last word is the pivot.
        a, b, c = word[begin], word[begin + size // 2], word[begin + size - 1]
        pivot = np.repeat(np.maximum(np.minimum(a, b), np.minimum(np.maximum(a, b), c)), size)
        less, equal = word < pivot, word == pivot
        part = np.repeat(np.arange(len(size)) * 3, size) + np.where(less, 0, np.where(equal, 1, 2))
        count = np.bincount(part, minlength=3 * len(size))
        place = np.empty(len(order), np.int64)
        start = np.cumsum(count) - count
        for side, here in enumerate((less, equal, ~(less | equal))):
            at = np.flatnonzero(here)
            # The n-th pointer of a side, in order, takes the n-th place of that side.
            own = count[side::3]
            place[at] = np.arange(len(at)) + np.repeat(start[side::3] - (np.cumsum(own) - own), own)
        moved = np.empty_like(order)
        moved[place] = order
        order = moved
        depth = np.repeat(depth, 3)
        depth[1::3] += 1
        kept = count > 0
        begin, depth, middle = start[kept], depth[kept], np.tile([False, True, False], len(size))[kept]
        size = count[kept]
        ended = middle & (keys[order[begin], depth - 1] < 0)
        full = middle & ~ended
        total = np.add.reduceat(weights[order], begin)
        for d in range(2, longest + 1):
            at = np.flatnonzero(full & (depth == d))
            if len(at):
                yield order[begin[at]], d, total[at]
        go = ~ended & ~(full & (depth == longest))
        order, depth, size = order[np.repeat(go, size)], depth[go], size[go]
        begin = np.cumsum(size) - size


def sorted_counts(params: PhraseParams):
    def run(table: pa.Table) -> pa.Table:
        """Counts of the phrases of one bucket; those of heavy words alone may be parts."""
        lines = pc.split_pattern(table["suffixes"].combine_chunks().cast(pa.large_string()), "\n")
        suffix = pc.list_flatten(lines)
        whose = pc.list_parent_indices(lines).to_numpy()
        weights = np.concatenate([np.frombuffer(x, "<i4") for x in table["counts"].to_pylist()]).astype(np.int64)
        opened = table["open"].to_numpy()[whose].astype(np.int64)
        lang = table["lang"].combine_chunks().dictionary_encode()
        words = pc.split_pattern(suffix, " ")
        size = pc.list_value_length(words).to_numpy()
        code = pc.list_flatten(words).dictionary_encode().indices.to_numpy().astype(np.int64)
        first = np.cumsum(size) - size
        keys = np.full((len(size), params.longest), -1, np.int64)
        for d in range(params.longest):
            has = size > d
            keys[has, d] = code[first[has] + d]
        # The language comes before the first word.
        spoken = lang.indices.to_numpy()[whose].astype(np.int64)
        keys[:, 0] = keys[:, 0] * max(len(lang.dictionary), 1) + spoken
        found = []
        for pointer, d, f in equal_partitions(keys, weights, opened, params.least):
            use = (f >= params.least) | (opened[pointer] >= d)
            pointer, f = pointer[use], f[use]
            phrase = pc.binary_join(pc.list_slice(words.take(pa.array(pointer)), 0, d), pa.scalar(" ", pa.large_string()))
            found.append(pa.table({"lang": lang.dictionary.take(pa.array(spoken[pointer])), "phrase": phrase.cast(pa.string()),
                                   "words": pa.array(np.full(len(f), d, np.int32)), "f": pa.array(f)}))
        return pa.concat_tables(found) if found else COUNTED.empty_table()

    return run


COUNTED = pa.schema([("lang", pa.string()), ("phrase", pa.string()), ("words", pa.int32()), ("f", pa.int64())])


#: Beyond so many partitions a task takes several buckets, one after the other.
MOST_PARTITIONS = 1 << 16


class Phrases:
    """Counts of all frequent phrases of ``docs``, one word included: ``counts`` (lang, phrase,
    words, f) and ``totals`` (lang, n, all word occurrences).

    Letters A-Z are lower-cased, a null language is ``und``; null and empty texts have no words
    and repeated rows count each. A text is cut at ``[.,;:!?\\x0A-\\x0D]`` into pieces and those at
    blanks and tabs into words. Only the sum of all words and two bit tables of fixed size reach
    the driver.
    """

    def __init__(self, docs: DataFrame, params: PhraseParams = PhraseParams(), text: str = "text", lang: str = "lang") -> None:
        rows = docs.select(F.coalesce(docs[lang].cast("string"), F.lit("und")).alias("lang"), docs[text].alias("text"))
        counted = count_words(rows)
        words = Written(counted.where((F.col("f") >= params.least) | (F.col("word") == "")), "phrase-words").df
        self.totals = words.where("word = ''").select("lang", F.col("f").alias("n"))
        single = words.where("word <> ''")
        frequent = marks(single.select("mark"))
        heavy = marks(single.where(F.col("f") >= params.heavy).select("mark"))
        n = self.totals.agg(F.sum("n")).first()[0] or 0
        buckets = max(1, -(-n // params.bucket))
        # A task takes one bucket, whatever the session's number of partitions.
        tasks = min(buckets, MOST_PARTITIONS)
        routed = suffixes(rows, frequent, heavy, buckets, params).withColumn("task", (F.col("bucket") % tasks).cast("int"))
        longer = routed.repartitionById(tasks, "task").groupBy("task", "bucket").applyInArrow(sorted_counts(params), "lang string, phrase string, words int, f long")
        longer = longer.groupBy("lang", "phrase", "words").agg(F.sum("f").alias("f")).where(F.col("f") >= params.least)
        one = single.select("lang", F.col("word").alias("phrase"), F.lit(1).alias("words"), "f")
        self.counts = Written(one.unionByName(longer), "phrases").df


#: Shares in which the phrases of one first or last word are looked up, as a word may begin very many.
SHARES = 16


def scored(phrases: Phrases) -> DataFrame:
    """Candidates with a, l, r and score of their lowest-scoring cut, the smallest k of equal ones."""
    counts = phrases.counts
    cuts = counts.where("words > 1").select("lang", "phrase", "words", F.col("f").alias("a"), F.explode(
        F.expr("sequence(1, words - 1)")).alias("k"))
    cuts = cuts.select("*", F.expr("substring_index(phrase, ' ', k)").alias("first"),
                       F.expr("substring_index(phrase, ' ', k - words)").alias("rest"))
    share = F.expr(f"if(contains(part, ' '), 0, pmod(hash(phrase), {SHARES}))")
    known = counts.select("lang", F.col("phrase").alias("part"), F.col("f"), F.explode(F.expr(
        f"if(words > 1, array(0), sequence(0, {SHARES - 1}))")).alias("share"))
    for part, name in (("first", "l"), ("rest", "r")):
        cuts = cuts.withColumnRenamed(part, "part").withColumn("share", share).join(
            known.withColumnRenamed("f", name), ["lang", "part", "share"]).drop("part", "share")
    score = F.expr("cast(2000000 as decimal(10,0)) * cast(a as decimal(20,0)) div (cast(l as decimal(20,0)) + cast(r as decimal(20,0)))")
    least = F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut")
    return cuts.groupBy("lang", "phrase", "words", "a").agg(least).select(
        "lang", "phrase", "words", "a", "cut.l", "cut.r", "cut.score")


def covered(phrases: Phrases) -> DataFrame:
    """(lang, phrase, longer_f): of each phrase inside longer ones, the highest count of such a one."""
    longer = phrases.counts.where("words > 2")
    part = F.expr("""flatten(transform(sequence(2, words - 1), k -> transform(sequence(0, words - k),
        i -> array_join(slice(split(phrase, ' ', -1), i + 1, k), ' '))))""")
    return longer.select("lang", "f", F.explode(part).alias("phrase")).groupBy("lang", "phrase").agg(F.max("f").alias("longer_f"))


def collocations(docs: DataFrame, params: PhraseParams = PhraseParams(), text: str = "text", lang: str = "lang") -> DataFrame:
    """Each language's best phrases: lang, rank, phrase, words, a, l, r, n and score.

    ``a`` counts the phrase; cut after its first words, ``l`` and ``r`` count the two parts, and
    the score is floor(2000000 a / (l + r)) of the cut where it is lowest. Phrases that mostly
    occur inside a longer one are left out. Ranked by score, a and phrase. Null texts have no
    words, a null language is ``und``, repeated rows count each, an empty table gives an empty
    one; other columns are ignored.
    """
    phrases = Phrases(docs, params, text, lang)
    mostly = F.expr(f"cast(100 as decimal(10,0)) * cast(longer_f as decimal(20,0)) >= cast({params.covered} as decimal(10,0)) * cast(a as decimal(20,0))")
    found = scored(phrases).join(covered(phrases), ["lang", "phrase"], "left")
    found = found.where(~F.coalesce(mostly, F.lit(False)))
    best = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # A language's phrases are ranked in shares first, so no task sorts them all.
    found = found.withColumn("share", F.expr("pmod(hash(phrase), 64)"))
    for among in (["lang", "share"], ["lang"]):
        found = found.withColumn("rank", F.row_number().over(Window.partitionBy(*among).orderBy(*best))).where(F.col("rank") <= params.top)
    return found.join(phrases.totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", F.col("words").cast("long").alias("words"), "a", "l", "r", "n", "score")
