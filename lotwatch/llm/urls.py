"""URL filtering: host and path rules, and a word classifier for what no rule decides.

Names in a URL are split into words by a unigram Viterbi search, and a multinomial naive Bayes
model scores the words. It is trained on the table's own hosts: a host with a seed word between
its separators is an example to block, one without seeds an example to allow, and one where a
seed only shows after splitting teaches nothing.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotwatch.llm.common import Written, map_slices

NAMES = re.compile(r"[a-z]+")


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path


@dataclass(frozen=True)
class UrlParams:
    """``seeds``: words that mark a host as one to block; ``vocabulary``: most frequent words, of
    page text and of URLs, that the two models know; ``longest``: letters of a word at most;
    ``threshold``: probability from which a URL is blocked; ``smoothing``: words that the common
    distribution is worth in each class."""

    seeds: tuple[str, ...] = (
        "adult", "bet", "bets", "betting", "casino", "escort", "gambling", "jackpot", "malware", "phishing",
        "pills", "poker", "porn", "roulette", "scam", "sex", "slots", "spam", "viagra", "warez", "xxx")
    vocabulary: int = 50_000
    longest: int = 24
    threshold: float = 0.5
    smoothing: float = 10.0


def parts(url: Column) -> tuple[Column, Column]:
    """Host (after the first ``://`` up to ``/ ? #``, A-Z lower-cased) and path (up to ``? #``);
    both empty for null and for a text without ``://``."""
    split = r"^(?s)(?:.*?)://([^/?#]*)([^?#]*)"
    host, path = (F.coalesce(F.regexp_extract(url, split, k), F.lit("")) for k in (1, 2))
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), path


def fitting(rules: tuple[Rule, ...], host: Column, path: Column, value) -> Column:
    """``value`` of the longest rule that fits, else null; a rule fits its host and all
    subdomains, if the path starts with the rule's."""
    found = [F.when(((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path), F.lit(value(r)))
             for r in sorted(rules, key=lambda r: (-len(r.name), r.name))]
    return F.coalesce(*found, F.lit(None).cast("string"))


@dataclass(frozen=True)
class Words:
    """Unigram costs; splits names into the likeliest words."""

    costs: dict[str, float]
    total: float
    longest: int

    def split(self, name: str) -> list[str]:
        best, back = [0.0], [0]
        log_total = math.log(self.total)
        for end in range(1, len(name) + 1):
            options = []
            for start in range(max(0, end - self.longest), end):
                cost = self.costs.get(name[start:end])
                if cost is None:  # unknown strings: the longer, the less likely
                    cost = log_total + 2.3 * (end - start)
                options.append((best[start] + cost, start))
            low = min(options)
            best.append(low[0])
            back.append(low[1])
        out, at = [], len(name)
        while at:
            out.append(name[back[at]:at])
            at = back[at]
        return out[::-1]


def unigrams(pages: DataFrame, params: UrlParams) -> Words:
    """Word counts of the visible text of all pages; the most frequent are kept, seeds always."""
    plain = F.regexp_replace(F.lower("html"), r"(?s)<script.*?</script>|<style.*?</style>|<!--.*?-->|<[^>]*>", " ")
    word = F.explode(F.regexp_extract_all(plain, F.lit(r"([a-z]+)"), 1)).alias("word")
    counts = pages.where("html is not null").select(word).where(F.length("word") <= params.longest).groupBy("word").count()
    top = counts.where("count > 1").orderBy(F.desc("count"), "word").limit(params.vocabulary).collect()
    known = {r["word"]: r["count"] for r in top}
    usual = max(1, sum(known.values()) // max(1, len(known)))
    for seed in params.seeds:
        known[seed] = max(known.get(seed, 0), usual)
    total = float(sum(known.values()))
    return Words({w: math.log(total / n) for w, n in known.items()}, total, params.longest)


@dataclass(frozen=True)
class UrlModel:
    words: Words
    weights: dict[str, float]
    bias: float
    unknown: float
    threshold: float

    def tokens(self, host: str, path: str, known: dict[str, list[str]]) -> list[str]:
        out = []
        for name in NAMES.findall(host) + NAMES.findall(path.lower()):
            if name not in known:
                if len(known) > 100_000:
                    known.clear()
                known[name] = self.words.split(name)
            out += known[name]
        return out

    def score(self, tokens: list[str]) -> float:
        """Probability that the URL is one to block."""
        x = self.bias + sum(self.weights.get(t, self.unknown) for t in tokens)
        return 1 / (1 + math.exp(-max(-500.0, min(500.0, x))))


def fit(pages: DataFrame, params: UrlParams = UrlParams(), url: str = "url") -> UrlModel:
    """Learn from every host of ``pages`` (columns ``url``, ``html``).

    A host counts each of its words once, so neither a host with most of the pages nor a long
    path dominates. Seeds are examples to block even if no host has them. Of the word counts
    the ``vocabulary`` most frequent reach the driver.
    """
    words = unigrams(pages.select("html"), params)
    host, path = parts(pages[url])
    urls = pages.select(host.alias("host"), path.alias("path")).where("host != ''").distinct()
    bare = UrlModel(words, {}, 0.0, 0.0, params.threshold)
    seeds = set(params.seeds)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, list[str]] = {}
        for batch in batches:
            rows = []
            for h, p in zip(batch.column("host").to_pylist(), batch.column("path").to_pylist()):
                bad = not seeds.isdisjoint(NAMES.findall(h))
                if bad or seeds.isdisjoint(bare.tokens(h, "", known)):
                    rows += [(h, bad, t) for t in {*bare.tokens(h, p, known)}]
            h, b, t = zip(*rows) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays([pa.array(h, pa.string()), pa.array(b, pa.bool_()), pa.array(t, pa.string())],
                                             ["host", "bad", "token"])

    seen = urls.mapInArrow(run, "host string, bad boolean, token string").distinct()
    counts = seen.groupBy("token").agg(F.count_if("bad").alias("bad"), F.count_if(~F.col("bad")).alias("good"))
    counts = Written(counts, "url-words").df
    totals = counts.agg(F.sum("bad"), F.sum("good")).first()
    top = counts.orderBy(F.desc(F.col("bad") + F.col("good")), "token").limit(params.vocabulary).collect()
    hosts = urls.select("host", F.col("host").rlike(rf"(^|[^a-z])({'|'.join(params.seeds)})([^a-z]|$)").alias("bad")).distinct()
    have = hosts.agg(F.count_if("bad"), F.count_if(~F.col("bad"))).first()
    bad = {r["token"]: r["bad"] for r in top}
    good = {r["token"]: r["good"] for r in top}
    for seed in params.seeds:
        bad[seed] = bad.get(seed, 0) + 1
    # Each class is smoothed towards the words of all hosts, so words of no class weigh little.
    s, n_bad, n_good = params.smoothing, (totals[0] or 0) + len(seeds), totals[1] or 0
    weights = {}
    for t in sorted(bad | good):
        usual = (bad.get(t, 0) + good.get(t, 0)) / (n_bad + n_good)
        weights[t] = math.log((bad.get(t, 0) + s * usual) / (n_bad + s)) - math.log((good.get(t, 0) + s * usual) / (n_good + s))
    return UrlModel(words, weights, math.log((have[0] + 1) / (have[1] + 1)), 0.0, params.threshold)


def judge(pages: DataFrame, rules: tuple[Rule, ...], model: UrlModel, url: str = "url", key: str = "page_id") -> DataFrame:
    """(key, host, path, rule, verdict, score, words) for every row of ``pages``.

    The longest fitting rule decides; else the model does, for which a URL without words is as
    likely one to block as a host is. Null URLs and texts without ``://`` have empty host and path, fit no
    rule and hold no words. Other columns are ignored.
    """
    host, path = parts(pages[url])
    rows = pages.select(pages[key].alias("_key"), host.alias("host"), path.alias("path"))
    rows = rows.withColumn("rule", fitting(rules, F.col("host"), F.col("path"), lambda r: r.name)).withColumn(
        "verdict", fitting(rules, F.col("host"), F.col("path"), lambda r: r.verdict))
    known: dict[str, list[str]] = {}

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        tokens = [model.tokens(h, p, known) for h, p in zip(batch.column("host").to_pylist(), batch.column("path").to_pylist())]
        score = [model.score(t) for t in tokens]
        verdict = [v or ("block" if s >= model.threshold else "allow") for v, s in zip(batch.column("verdict").to_pylist(), score)]
        return pa.RecordBatch.from_arrays([
            batch.column("_key"), batch.column("host"), batch.column("path"), batch.column("rule"), pa.array(verdict, pa.string()),
            pa.array(score, pa.float64()), pa.array([" ".join(t) for t in tokens], pa.string())],
            [key, "host", "path", "rule", "verdict", "score", "words"])

    kind = rows.schema["_key"].dataType.simpleString()
    return map_slices(rows, run, f"`{key}` {kind}, host string, path string, rule string, verdict string, score double, words string", "path")
