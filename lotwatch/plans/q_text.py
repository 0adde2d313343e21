"""Registered queries: numeric claims in texts, and briefings."""

from __future__ import annotations

from pyspark.sql import functions as F

from lotwatch.functions import text as T
from lotwatch.functions.ranking import latest_per_key
from lotwatch.functions.scalars import kpi_colour, word_count
from lotwatch.operators import briefing, reports, scenarios
from lotwatch.params import SummaryParams
from lotwatch.plans.present import present
from lotwatch.plans.q_scenario import _projections, _scope, _yearly
from lotwatch.plans.registry import query
from lotwatch.plans.sqlparts import part, with_parts
from lotwatch.sources import testdata as D

SUMMARY = SummaryParams()
PATTERN = T.CLAIM_PATTERN.replace("'", "''")

part("texts", "", f"""
SELECT doc_id, lang, text, n_chars, regexp_extract_all(text, '{PATTERN}', 1) AS claims,
       CASE WHEN regexp_replace(text, '^\\s+|\\s+$', '', 'g') = '' THEN 0
            ELSE len(string_split_regex(regexp_replace(text, '^\\s+|\\s+$', '', 'g'), '\\s+')) END AS words
FROM documents""")
part("claims", "texts", """
SELECT doc_id, lang, position, claim, TRY_CAST(regexp_extract(replace(claim, ',', ''), '[\\d.]+') AS DOUBLE) AS num, n_chars, words
FROM (SELECT doc_id, lang, n_chars, words, unnest(claims) AS claim, generate_subscripts(claims, 1) - 1 AS position FROM texts)""")
part("judged", "claims", """
SELECT *, coalesce((n_chars <> 0 AND abs(num - n_chars) / greatest(abs(n_chars), 1) <= 0.05)
                OR (words <> 0 AND abs(num - words) / greatest(abs(words), 1) <= 0.05), FALSE) AS ok FROM claims""")


def _documents(spark, sf):
    return D.table(spark, sf, "documents").select(
        "doc_id", "lang", "text", F.array(
            F.col("n_chars").cast("double"), word_count("text").cast("double")).alias("trusted"))


@query("numeric_claims", with_parts("texts", """
SELECT doc_id, array_to_string(claims, '|') AS claims FROM texts WHERE len(claims) > 0"""))
def numeric_claims(spark, sf):
    claims = T.extract_claims("text")
    rows = D.table(spark, sf, "documents").select("doc_id", claims.alias("claims"))
    return rows.filter(F.size("claims") > 0).select("doc_id", F.array_join("claims", "|").alias("claims"))


@query("claim_audit", with_parts("judged texts", """
SELECT t.doc_id, coalesce(string_agg(claim, '|' ORDER BY position) FILTER (ok), '') AS verified,
       coalesce(string_agg(claim, '|' ORDER BY position) FILTER (NOT ok), '') AS unverified,
       coalesce(bool_and(ok), TRUE) AS all_claims_verified
FROM texts t LEFT JOIN judged j USING (doc_id) GROUP BY t.doc_id"""))
def claim_audit(spark, sf):
    rows = briefing.audit(_documents(spark, sf), "text", "trusted", SUMMARY)
    return rows.select("doc_id", F.array_join("verified_claims", "|").alias("verified"),
                       F.array_join("unverified_claims", "|").alias("unverified"), "all_claims_verified")


@query("annotated_texts", with_parts("judged texts", """
SELECT t.doc_id, md5(list_reduce(coalesce(u.claims, []), lambda acc, c: CASE WHEN instr(acc, c) > 0
   THEN substr(acc, 1, instr(acc, c) + length(c) - 1) || ' [⚠ UNVERIFIED]' || substr(acc, instr(acc, c) + length(c)) ELSE acc END, t.text)) AS revised
FROM texts t LEFT JOIN (SELECT doc_id, list(claim ORDER BY position) AS claims FROM judged WHERE NOT ok GROUP BY 1) u USING (doc_id)"""))
def annotated_texts(spark, sf):
    rows = briefing.audit(_documents(spark, sf), "text", "trusted", SUMMARY)
    return rows.select("doc_id", F.md5("revised_text").alias("revised"))


@query("claims_against_table", with_parts("claims", """
SELECT c.lang, c.doc_id, c.position, c.claim, EXISTS (SELECT 1 FROM documents d WHERE d.lang = c.lang AND d.n_chars <> 0
   AND abs(c.num - d.n_chars) / greatest(abs(d.n_chars), 1) <= 0.05) AS is_verified FROM claims c"""))
def claims_against_table(spark, sf):
    docs = D.table(spark, sf, "documents")
    trusted = docs.select("lang", F.col("n_chars").cast("double").alias("value"))
    return present(briefing.audit_against_table(docs, "text", trusted, "lang", "doc_id", SUMMARY))


@query("text_metrics", with_parts("texts", """
SELECT doc_id, length(text) AS char_count, words AS word_count FROM texts"""))
def text_metrics(spark, sf):
    return present(D.table(spark, sf, "documents").select(
        "doc_id", F.length("text").alias("char_count"), word_count("text").alias("word_count")))


@query("claim_log", with_parts("judged texts", """
SELECT t.doc_id::VARCHAR AS run_id, coalesce(bool_and(ok), TRUE) AS all_claims_verified, count(*) FILTER (ok) AS verified_count,
       count(*) FILTER (NOT ok) AS unverified_count, any_value(length(t.text)) AS briefing_char_count
FROM texts t LEFT JOIN judged j USING (doc_id) GROUP BY t.doc_id"""))
def claim_log(spark, sf):
    rows = briefing.audit(_documents(spark, sf), "text", "trusted", SUMMARY)
    stored = rows.select(
        F.col("doc_id").cast("string").alias("run_id"), "all_claims_verified",
        F.to_json("verified_claims").alias("verified_json"),
        F.to_json("unverified_claims").alias("unverified_json"), F.col("text").alias("briefing_text"))
    return present(reports.claim_log(stored))


def _briefings(spark, sf):
    findings = _yearly(D.findings(spark, sf))
    rca = briefing.run_confidence(findings, ["run_id"], D.RCA)
    top = latest_per_key(findings.select("run_id", "batch_id", "top_confidence", "top_hypothesis"),
                         ["run_id"], ["top_confidence", "batch_id"])
    chosen = scenarios.recommended_by_flag(_projections(spark, sf), F.col("is_recommended"))
    return briefing.briefings(_scope(spark, sf), rca, top, chosen, SUMMARY)


part("brief", "scope finds flagged_proj", """
SELECT s.run_id, s.total_units_flagged, s.flagged_batches, s.affected_suppliers, t.top_hypothesis, t.conf, p.scenario_name,
       p.mean_total_cost_usd, p.mean_timeline_days, p.mean_returns_volume,
       'Quality briefing. Scope: ' || s.total_units_flagged || ' units in ' || s.flagged_batches || ' batches from ' || s.affected_suppliers
       || ' suppliers were flagged. Root cause: ' || t.top_hypothesis || ', confidence ' || printf('%.1f', t.conf * 100) || ' percent. Response: '
       || CASE p.scenario_name WHEN 'do_nothing' THEN 'Do Nothing' WHEN 'full_recall' THEN 'Full Recall' ELSE 'Partial Remediation' END
       || ' at an expected cost of $' || format('{:,}', CAST(round(p.mean_total_cost_usd) AS BIGINT)) || ' USD over ' || printf('%.1f', p.mean_timeline_days) || ' days.' AS draft_text
FROM scope s JOIN (SELECT strftime(production_date, '%Y') AS run_id, max(top_confidence) AS conf,
                          arg_max(top_hypothesis, {'c': top_confidence, 'b': batch_id}) AS top_hypothesis FROM finds GROUP BY 1) t USING (run_id)
JOIN flagged_proj p ON p.run_id = s.run_id AND p.is_recommended AND p.return_rate_assumption = 1.0
WHERE s.total_units_flagged >= 5000 OR s.avg_defect_rate >= 0.03""")


@query("briefings", with_parts("brief", "SELECT run_id, draft_text, scenario_name AS recommended_scenario, conf AS rca_confidence, "
       "total_units_flagged AS units_flagged, flagged_batches FROM brief"))
def briefings(spark, sf):
    return present(_briefings(spark, sf), "run_id", "draft_text", "recommended_scenario", "rca_confidence",
                   "units_flagged", "flagged_batches")


part("bclaims", "brief", f"""
SELECT run_id, position, claim, TRY_CAST(regexp_extract(replace(claim, ',', ''), '[\\d.]+') AS DOUBLE) AS num, trusted
FROM (SELECT run_id, trusted, unnest(claims) AS claim, generate_subscripts(claims, 1) AS position FROM (
  SELECT run_id, regexp_extract_all(draft_text, '{PATTERN}', 1) AS claims, [total_units_flagged::DOUBLE, flagged_batches, affected_suppliers,
    round(conf * 100, 1), mean_total_cost_usd, mean_timeline_days, mean_returns_volume] AS trusted FROM brief))""")
part("bjudged", "bclaims", """
SELECT *, coalesce(len(list_filter(trusted, lambda v: v <> 0 AND abs(num - v) / greatest(abs(v), 1) <= 0.05)) > 0, FALSE) AS ok FROM bclaims""")
part("baudit", "brief bjudged", """
SELECT run_id, CASE WHEN total_units_flagged >= 5000 THEN 'unit_threshold' ELSE 'rate_threshold' END AS trigger_reason,
  CASE WHEN conf >= 0.65 THEN 'COMPLETE' ELSE 'INSUFFICIENT_EVIDENCE' END AS rca_status, scenario_name, verified, unverified,
  list_reduce(unverified, lambda acc, c: CASE WHEN instr(acc, c) > 0 THEN substr(acc, 1, instr(acc, c) + length(c) - 1)
    || ' [⚠ UNVERIFIED]' || substr(acc, instr(acc, c) + length(c)) ELSE acc END, draft_text)
  || CASE WHEN len(unverified) > 0 THEN chr(10) || chr(10) || '[Please check these figures before sharing: ' || array_to_string(unverified, ', ') || '.]' ELSE '' END
  AS briefing_text
FROM brief LEFT JOIN (
  SELECT run_id, coalesce(list(claim ORDER BY position) FILTER (ok), []) AS verified,
    coalesce(list(claim ORDER BY position) FILTER (NOT ok), []) AS unverified FROM bjudged GROUP BY 1) USING (run_id)""")
part("bshown", "baudit", """
SELECT *, len(string_split_regex(trim(briefing_text), '\\s+')) AS word_count FROM baudit""")


@query("briefing_audit", with_parts("bshown", """
SELECT run_id, briefing_text, word_count, array_to_string(verified, ',') AS verified_claims, array_to_string(unverified, ',') AS unverified_claims,
  len(unverified) = 0 AS all_claims_verified, rca_status, trigger_reason FROM bshown"""))
def briefing_audit(spark, sf):
    return present(_briefings(spark, sf), "run_id", "briefing_text", "word_count", "verified_claims",
                   "unverified_claims", "all_claims_verified", "rca_status", "trigger_reason")


@query("latest_briefing", with_parts("brief", "SELECT run_id, scenario_name AS recommended_scenario FROM brief ORDER BY run_id DESC LIMIT 1"))
def latest_briefing(spark, sf):
    return reports.latest_row(_briefings(spark, sf).select("run_id", "recommended_scenario"), ["run_id"])


@query("operations_summary", with_parts("alerts bshown", """
SELECT a.*, b.scenario_name AS recommended_scenario, word_count, len(unverified) = 0 AS all_claims_verified, len(unverified) AS unverified_claim_count,
  CASE WHEN len(unverified) = 0 THEN 'green' WHEN len(unverified) <= 2 THEN 'amber' WHEN len(unverified) > 2 THEN 'red' END AS kpi_colour FROM (
  SELECT strftime(production_date, '%Y') AS run_id, count(*) AS batches_scanned, count(DISTINCT batch_id) FILTER (alert_status = 'FLAGGED') AS flagged,
         count(DISTINCT batch_id) FILTER (alert_status = 'REVIEW') AS borderline FROM alerts GROUP BY 1) a LEFT JOIN bshown b USING (run_id)"""))
def operations_summary(spark, sf):
    return present(reports.operations_summary(_yearly(D.alerts(spark, sf)), _briefings(spark, sf)))


@query("claim_kpi_colours", with_parts("judged texts", """
SELECT n AS unverified_claim_count, CASE WHEN n = 0 THEN 'green' WHEN n <= 2 THEN 'amber' ELSE 'red' END AS kpi_colour, count(*) AS texts
FROM (SELECT t.doc_id, count(*) FILTER (NOT ok) AS n FROM texts t LEFT JOIN judged USING (doc_id) GROUP BY 1) GROUP BY 1, 2"""))
def claim_kpi_colours(spark, sf):
    rows = briefing.audit(_documents(spark, sf), "text", "trusted", SUMMARY)
    counted = rows.select(F.size("unverified_claims").alias("unverified_claim_count"))
    return present(counted.groupBy("unverified_claim_count", kpi_colour("unverified_claim_count").alias("kpi_colour"))
                   .agg(F.count(F.lit(1)).alias("texts")))

