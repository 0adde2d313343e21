"""The numbered queries over the given tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lotwatch.llm import contamination, infill, jaccard, language, licenses, lines, phrases, quality, rules, tokens, urls, vectors
from lotwatch.llm.common import table
from lotwatch.llm.mixing import Mix

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


def fold(key: str, of: int) -> Column:
    """Remainder of the key's checksum, by which rows are held out; null keys are in no fold."""
    return F.coalesce(F.crc32(F.col(key).cast("string")) % of, F.lit(-1))


def language_model(docs: DataFrame) -> language.LanguageModel:
    return language.fit(docs.where(fold("doc_id", 4) != 2))


@query
def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return language.classify(docs, language_model(docs)).select(
        "doc_id", (fold("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score")


@query
def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    trees = quality.fit(docs, labels.where(fold("doc_id", 5) != 0))
    return quality.score(docs, trees).select(
        "doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


@query
def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination.find_passages(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["after"] - s["first"])
    return found.select(
        "doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), (hit > 0).alias("contaminated"))


ORACLES["op3_decontamination"] = r"""
WITH low AS (
  SELECT true AS doc, doc_id AS id, text FROM documents UNION ALL SELECT false, item_id, text FROM benchmark),
split AS (
  SELECT doc, id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM low),
win AS (
  SELECT id, least(10, len(w)) AS n, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i, w FROM split
  WHERE NOT doc AND len(w) > 0),
pattern AS (SELECT DISTINCT id AS item, n, array_to_string(w[i:i + n - 1], ' ') AS words FROM win),
lengths AS (SELECT DISTINCT n FROM pattern),
spot AS (
  SELECT id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM split, lengths WHERE doc AND len(w) >= n),
found AS (
  SELECT s.id, s.i, s.n, p.item FROM (SELECT id, i, n, array_to_string(w[i:i + n - 1], ' ') AS words FROM spot) s
  JOIN pattern p ON s.n = p.n AND s.words = p.words),
hits AS (
  SELECT id, count(DISTINCT k) AS n_hit FROM (SELECT DISTINCT id, unnest(range(i, i + n)) AS k FROM found) GROUP BY id),
ids AS (
  SELECT id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS listed
  FROM (SELECT DISTINCT id, item::VARCHAR AS item FROM found) GROUP BY id)
SELECT id AS doc_id, coalesce(len(w), 0)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
  coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(listed, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM split LEFT JOIN hits USING (id) LEFT JOIN ids USING (id) WHERE doc
"""


@query
def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.linked_groups(table(spark, sf_dir, "documents"))


ORACLES["op4_jaccard_join"] = r"""
WITH RECURSIVE split AS (
  SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
shingle AS (
  SELECT DISTINCT doc_id, md5_number(array_to_string(w[i:i + least(5, len(w)) - 1], ' ')) AS s
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - least(5, len(w)) + 2)) AS i FROM split WHERE len(w) > 0)),
size AS (SELECT doc_id, count(*) AS n FROM shingle GROUP BY doc_id),
link AS (
  SELECT p.a, p.b FROM (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM shingle x JOIN shingle y USING (s)
    WHERE x.doc_id <> y.doc_id GROUP BY ALL) p
  JOIN size m ON m.doc_id = p.a JOIN size n ON n.doc_id = p.b WHERE 100 * c >= 80 * (m.n + n.n - c)),
reach AS (SELECT doc_id AS a, doc_id AS b FROM size UNION SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a),
least AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, coalesce(component_id, doc_id) AS component_id
FROM split LEFT JOIN size USING (doc_id) LEFT JOIN least USING (doc_id)
"""


@query
def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.count_tokens(table(spark, sf_dir, "documents"),
                               public_tokenizers.path("byte_bpe_50k.json"))


@query
def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return lines.drop_repeated_lines(docs).select(
        "doc_id", F.col("_lines").cast("long").alias("n_lines"), F.col("_removed").cast("long").alias("n_removed"), "text")


@query
def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_blocks", F.size("found").cast("long").alias("n_found"),
        F.array_sort(F.array_distinct("found.license")).alias("licenses"), "found")


#: Fixed values of the query: hosts and paths that are decided without a model.
RULES = (
    urls.Rule("org", "/", "allow"), urls.Rule("example.org", "/es/", "block"), urls.Rule("example.org", "/en/1", "block"),
    urls.Rule("com", "/fr/", "allow"), urls.Rule("com", "/de/", "block"))


@query
def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return urls.judge(pages, RULES, urls.fit(pages)).select("page_id", "host", "path", "rule", "verdict", "score", "words")


@query
def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Mix(table(spark, sf_dir, "documents")).taken().select(
        "doc_id", "size", "source_size", "target", "taken")


ORACLES["op9_mixing"] = r"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
    md5(coalesce(doc_id::VARCHAR, '')) AS ord FROM documents),
src AS (
  SELECT source, sum(size)::BIGINT AS s, row_number() OVER (ORDER BY source NULLS LAST) AS sid FROM sized GROUP BY source),
capped AS (SELECT *, [1, 2, 3][((sid - 1) % 3 + 1)::INT] AS w, s * 3 AS cap FROM src),
share AS (
  SELECT *, cap / w AS fill,
    (sum(s) OVER () - coalesce(sum(cap) OVER (ORDER BY cap / w, sid ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
      / sum(w) OVER (ORDER BY cap / w, sid ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS share FROM capped),
goal AS (
  SELECT *, least(cap::DOUBLE, w * (SELECT arg_min(share, (fill, sid)) FROM share WHERE share <= fill)) AS target,
    greatest(1, least(1024, s // 64)) AS blk FROM share),
quotas AS (
  SELECT *, (s + blk - 1) // blk AS nb, CASE WHEN s > 0 THEN floor(target / s)::BIGINT ELSE 0 END AS passes FROM goal),
quota AS (
  SELECT *, passes * nb + floor((target - passes * s) / blk + 0.5)::BIGINT AS quota FROM quotas),
line AS (
  SELECT *, sum(quota) OVER (ORDER BY sid)::BIGINT AS until, (sum(quota) OVER ())::BIGINT AS n FROM quota),
slot AS (
  SELECT k AS slot, (k * 0.6180339887498949::DOUBLE - floor(k * 0.6180339887498949::DOUBLE)) * (SELECT max(n) FROM line) AS v
  FROM range((SELECT max(n) FROM line)) t(k)),
ranked AS (
  SELECT sid, quota, row_number() OVER (PARTITION BY sid ORDER BY slot) - 1 AS rank
  FROM slot JOIN line ON v >= until - quota AND v < until),
used AS (
  SELECT sid, rank FROM ranked WHERE rank < quota
  UNION ALL
  SELECT sid, unnest(range(coalesce(have, 0), quota)) FROM line
  LEFT JOIN (SELECT sid, count(*) AS have FROM ranked GROUP BY sid) USING (sid)),
blocks AS (SELECT sid, rank % nb AS block, count(*) AS uses FROM used JOIN line USING (sid) GROUP BY ALL),
placed AS (
  SELECT d.*, sid, s, target, blk, sum(size) OVER (PARTITION BY sid ORDER BY ord, doc_id, size
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS after
  FROM sized d JOIN line ON d.source IS NOT DISTINCT FROM line.source),
piece AS (
  SELECT *, unnest(range((after - size)::BIGINT // blk, (after - 1)::BIGINT // blk + 1)) AS block FROM placed WHERE size > 0),
taken AS (
  SELECT doc_id, sum(uses * (least(after, (block + 1) * blk) - greatest(after - size, block * blk))) AS taken
  FROM piece JOIN blocks USING (sid, block) GROUP BY doc_id)
SELECT doc_id, size, s AS source_size, target, coalesce(taken, 0)::BIGINT AS taken
FROM placed LEFT JOIN taken USING (doc_id)
"""


@query
def op10_vector_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_duplicates(table(spark, sf_dir, "embeddings"))


ORACLES["op10_vector_dedup"] = """
WITH RECURSIVE usable AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings
  WHERE label IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
unit AS (SELECT vec_id, label, v, sqrt(list_dot_product(v, v)) AS n FROM usable),
link AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM unit a JOIN unit b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE list_dot_product(a.v, b.v) / (a.n * b.n) >= 0.93),
reach AS (SELECT a, a AS b FROM link UNION SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a),
least AS (SELECT a AS vec_id, min(b) AS least FROM reach GROUP BY a),
degree AS (SELECT a AS vec_id, count(*) AS n FROM link GROUP BY a)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, coalesce(least, vec_id) AS component_id,
  coalesce(least, vec_id) = vec_id AS kept
FROM embeddings LEFT JOIN least USING (vec_id) LEFT JOIN degree USING (vec_id)
"""


@query
def op11_infill(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = infill.infill(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                      F.sha2(infill.restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"))


ORACLES["op11_infill"] = """
WITH hashed AS (
  SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, ''))::BIGINT AS n,
    sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS x FROM documents),
draw AS (
  SELECT doc_id, t, n, ('0x' || x[1:8])::BIGINT % (n + 1) AS a, ('0x' || x[9:16])::BIGINT % (n + 1) AS b,
    ('0x' || x[17:24])::BIGINT % 100 AS c, ('0x' || x[25:32])::BIGINT % 100 AS d FROM hashed),
cut AS (
  SELECT *, substr(t, 1, least(a, b)) AS p, substr(t, least(a, b) + 1, abs(a - b)) AS m, substr(t, greatest(a, b) + 1) AS s,
    CASE WHEN n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR c >= 90 THEN 'plain'
      WHEN d < 20 THEN 'spm' ELSE 'psm' END AS form FROM draw)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN least(a, b) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN abs(a - b) END AS middle_chars,
  sha256(CASE form WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
    WHEN 'spm' THEN '<S>' || s || '<P>' || p || '<M>' || m ELSE t END) AS output_sha256,
  sha256(t) AS restored_sha256
FROM cut
"""


@query
def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents")).select(
        "lang", "rank", "phrase", "a", "l", "r", "n", "score")


ORACLES["op12_collocations"] = r"""
WITH piece AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS p FROM documents),
split AS (SELECT lang, regexp_extract_all(p, '[^\x20\x09]+') AS w FROM piece),
total AS (SELECT lang, sum(len(w))::BIGINT AS n FROM split GROUP BY lang),
spot AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM split),
run AS (SELECT lang, w, i, unnest(range(1, least(4, len(w) - i + 1) + 1)) AS k FROM spot),
f AS (
  SELECT lang, phrase, words, count(*) AS f
  FROM (SELECT lang, array_to_string(w[i:i + k - 1], ' ') AS phrase, k AS words FROM run) GROUP BY ALL HAVING count(*) >= 30),
parted AS (SELECT lang, phrase, words, f, string_split(phrase, ' ') AS w FROM f),
cut AS (
  SELECT lang, phrase, words, f, array_to_string(w[1:k], ' ') AS x, array_to_string(w[k + 1:words], ' ') AS y, k
  FROM (SELECT *, unnest(range(1, words)) AS k FROM parted WHERE words > 1)),
rated AS (
  SELECT c.lang, c.phrase, c.f AS a, k, x.f AS l, y.f AS r, (2000000::HUGEINT * c.f // (x.f::HUGEINT + y.f))::BIGINT AS score
  FROM cut c JOIN f x ON x.lang = c.lang AND x.phrase = c.x JOIN f y ON y.lang = c.lang AND y.phrase = c.y),
scored AS (
  SELECT lang, phrase, a, arg_min(l, (score, k)) AS l, arg_min(r, (score, k)) AS r, min(score) AS score
  FROM rated GROUP BY lang, phrase, a),
within AS (
  SELECT DISTINCT lang, array_to_string(w[i:i + k - 1], ' ') AS phrase, f
  FROM (SELECT *, unnest(range(1, words - k + 2)) AS i FROM (SELECT *, unnest(range(2, words)) AS k FROM parted WHERE words > 2))),
kept AS (
  SELECT * FROM scored s WHERE NOT EXISTS (
    SELECT 1 FROM within q WHERE q.lang = s.lang AND q.phrase = s.phrase AND 100::HUGEINT * q.f >= 80::HUGEINT * s.a)),
best AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, rank, phrase, a, l, r, n, score FROM best JOIN total USING (lang) WHERE rank <= 2000
"""


@query
def op13_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.judge(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "failed")


def rule_sql(rule: rules.Rule) -> str:
    """The rule's name where the columns of statistics break it."""
    sides = ([f"({rule.value}) < {rule.least}"] if rule.least is not None else []) + (
        [f"({rule.value}) > {rule.most}"] if rule.most is not None else [])
    return f"CASE WHEN {' OR '.join(sides)} THEN '{rule.name}' END"


ORACLES["op13_quality_rules"] = r"""
WITH split AS (
  SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS t,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM documents),
win AS (SELECT row, w, unnest(range(1, len(w) - 1)) AS i FROM split),
again AS (SELECT row, i, count(*) OVER (PARTITION BY row, w[i], w[i + 1], w[i + 2]) AS uses FROM win),
covered AS (
  SELECT row, count(DISTINCT k) AS n FROM (SELECT row, unnest([i, i + 1, i + 2]) AS k FROM again WHERE uses > 1) GROUP BY row),
stat AS (
  SELECT doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
    len(regexp_extract_all(t, '[#*$%&|<>]'))::BIGINT AS n_symbols, len(l)::BIGINT AS n_lines,
    (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines,
    len(list_filter(l, lambda x: ltrim(x, ' ')[1] IN ('-', '*', '•'))) AS n_bullet_lines,
    len(list_filter(l, lambda x: suffix(rtrim(x, ' '), '...') OR suffix(rtrim(x, ' '), '…'))) AS n_ellipsis_lines,
    len(list_filter(w, lambda x: x IN (STOP))) AS n_stop_words,
    len(list_filter(w, lambda x: regexp_matches(x, '\p{L}'))) AS n_letter_words,
    len(regexp_extract_all(t, '\p{Lu}')) AS n_capitals, coalesce(n, 0)::BIGINT AS n_repeat_words
  FROM split LEFT JOIN covered USING (row)),
judged AS (SELECT *, list_filter([BASE], lambda x: x IS NOT NULL) AS base, list_filter([REST], lambda x: x IS NOT NULL) AS rest FROM stat)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, len(base) > 0 AS base_failed,
  len(base) + len(rest) = 0 AS kept, base || rest AS failed FROM judged
""".replace("STOP", ", ".join(f"'{w}', '{w.capitalize()}'" for w in rules.STOP_WORDS)).replace(
    "BASE", ", ".join(rule_sql(r) for r in rules.RULES if r.base)).replace(
    "REST", ", ".join(rule_sql(r) for r in rules.RULES if not r.base))
