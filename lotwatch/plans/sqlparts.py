"""SQL building blocks of the oracle queries: named CTEs with their dependencies."""

from __future__ import annotations

_PARTS: dict[str, tuple[tuple[str, ...], str]] = {}


def part(name: str, needs: str, sql: str) -> None:
    _PARTS[name] = (tuple(needs.split()), sql.strip())


def with_parts(names: str, body: str) -> str:
    """``body`` preceded by the named CTEs and all they depend on."""
    ordered: list[str] = []

    def visit(name: str) -> None:
        if name not in ordered:
            for need in _PARTS[name][0]:
                visit(need)
            ordered.append(name)

    for name in names.split():
        visit(name)
    head = ",\n".join(f"{n} AS ({_PARTS[n][1]})" for n in ordered)
    return f"WITH {head}\n{body.strip()}"


part("insp", "", """
SELECT 'I-' || l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey AS inspection_id,
       'B-' || l_suppkey || '-' || l_linenumber || '-' || l_orderkey || '-' || strftime(l_shipdate, '%Y%m') AS batch_id,
       'S' || l_suppkey AS supplier_id, 'L' || l_linenumber AS line_id,
       'LOT-' || l_suppkey || '-' || strftime(l_shipdate, '%Y%m') AS material_lot,
       CAST(l_shipdate AS DATE) AS inspection_date, CAST(l_quantity AS BIGINT) AS units_inspected,
       CAST(floor(l_quantity * l_discount) AS BIGINT) AS defect_count,
       CASE l_returnflag WHEN 'R' THEN 'FAIL' WHEN 'A' THEN 'REVIEW' ELSE 'PASS' END AS pass_fail,
       l_partkey
FROM lineitem""")
part("typed", "insp", """
SELECT i.*, CASE p_type WHEN 'ECONOMY' THEN 'seam_bulge' WHEN 'LARGE' THEN 'heat_transfer_failure'
            WHEN 'MEDIUM' THEN 'material_deformation' WHEN 'PROMO' THEN 'minor_thread'
            WHEN 'SMALL' THEN 'minor_color_variation' WHEN 'STANDARD' THEN 'none' END AS defect_type
FROM insp i LEFT JOIN part ON l_partkey = p_partkey""")
part("watched", "insp", "SELECT * FROM insp WHERE inspection_date >= DATE '1998-01-01'")
part("dimb", "watched", """
SELECT batch_id, min(supplier_id) AS supplier_id, min(line_id) AS line_id, min(material_lot) AS material_lot,
       CAST(sum(units_inspected) AS BIGINT) AS unit_count, min(inspection_date) AS production_date
FROM watched GROUP BY batch_id""")
part("hist", "insp", """
SELECT supplier_id, line_id, CAST(date_trunc('month', inspection_date) AS DATE) AS month,
       CAST(sum(units_inspected) AS BIGINT) AS units_inspected,
       avg(CAST(defect_count AS DOUBLE) / units_inspected) AS defect_rate,
       CAST(sum(defect_count) AS BIGINT) AS defects_found
FROM insp WHERE inspection_date < DATE '1998-01-01'
GROUP BY 1, 2, 3""")
part("dimball", "insp", """
SELECT batch_id, min(supplier_id) AS supplier_id, min(line_id) AS line_id, min(material_lot) AS material_lot,
       CAST(sum(units_inspected) AS BIGINT) AS unit_count, min(inspection_date) AS production_date
FROM insp GROUP BY batch_id""")
part("base", "hist", """
SELECT supplier_id, line_id, round(avg(defect_rate), 5) AS mean_rate,
       round(coalesce(stddev_samp(defect_rate), 0), 5) AS std_rate,
       round(max(defect_rate), 5) AS max_rate, count(*) AS months_on_record
FROM hist GROUP BY supplier_id, line_id""")
part("risk", "", """
SELECT *, CASE WHEN composite_risk_score < 0.70 THEN 'HIGH' WHEN composite_risk_score < 0.78 THEN 'ELEVATED'
               ELSE 'NORMAL' END AS risk_tier, composite_risk_score < 0.70 AS would_trigger_audit
FROM (SELECT *, round((historical_defect_score + on_time_delivery_score + audit_score
                       + material_lot_stability_score + capacity_utilization_score) / 5, 4) AS composite_risk_score
      FROM (SELECT 'S' || k AS supplier_id,
                   0.5::DOUBLE + ((k * 7) % 51) / 100.0::DOUBLE AS historical_defect_score,
                   0.5::DOUBLE + ((k * 11 + 3) % 51) / 100.0::DOUBLE AS on_time_delivery_score,
                   0.5::DOUBLE + ((b % 51 + 51) % 51) / 100.0::DOUBLE AS audit_score,
                   0.5::DOUBLE + (((b * 3 + k) % 51 + 51) % 51) / 100.0::DOUBLE AS material_lot_stability_score,
                   0.5::DOUBLE + (((b + k * 5) % 51 + 51) % 51) / 100.0::DOUBLE AS capacity_utilization_score
            FROM (SELECT s_suppkey AS k, CAST(floor(s_acctbal) AS BIGINT) AS b FROM supplier)))""")
part("bq", "watched", """
SELECT *, avg_defect_count / avg_units_inspected AS observed_defect_rate
FROM (SELECT batch_id, supplier_id, line_id, avg(defect_count) AS avg_defect_count,
             avg(units_inspected) AS avg_units_inspected, count(*) AS inspection_count,
             count(*) FILTER (pass_fail = 'FAIL') AS fail_count,
             CAST(sum(units_inspected) AS BIGINT) AS unit_count, min(material_lot) AS material_lot,
             min(inspection_date) AS production_date
      FROM watched WHERE units_inspected >= 10 GROUP BY batch_id, supplier_id, line_id)""")
part("bqall", "insp", """
SELECT *, avg_defect_count / avg_units_inspected AS observed_defect_rate
FROM (SELECT batch_id, supplier_id, line_id, avg(defect_count) AS avg_defect_count,
             avg(units_inspected) AS avg_units_inspected, CAST(sum(units_inspected) AS BIGINT) AS unit_count,
             min(material_lot) AS material_lot
      FROM insp WHERE units_inspected >= 10 GROUP BY batch_id, supplier_id, line_id)""")
part("btypes", "typed", """
SELECT batch_id, list_sort(list(DISTINCT defect_type)) AS defect_types
FROM typed WHERE inspection_date >= DATE '1998-01-01' AND units_inspected >= 10 GROUP BY batch_id""")
part("lotavg", "bq", """
SELECT material_lot, avg(avg_defect_count / greatest(avg_units_inspected, 1)) AS lot_avg_rate
FROM bq GROUP BY material_lot""")
part("scored", "bq base risk lotavg", """
SELECT *, CASE WHEN mean_rate IS NULL THEN 'UNRESOLVED' WHEN z >= threshold THEN 'FLAGGED'
               WHEN z >= 1.8 AND lot_rate >= mean_rate + 1.8 * std_rate THEN 'FLAGGED'
               WHEN z >= 1.8 THEN 'REVIEW' ELSE 'NORMAL' END AS alert_status
FROM (SELECT bq.*, coalesce(r.risk_tier, 'UNKNOWN') AS risk_tier,
             coalesce(r.composite_risk_score, 0.8) AS composite_risk_score,
             b.mean_rate, b.std_rate, b.max_rate, b.months_on_record,
             CASE WHEN b.std_rate = 0 THEN 0.0::DOUBLE ELSE (observed_defect_rate - b.mean_rate) / b.std_rate END AS z,
             2.5::DOUBLE * CASE WHEN r.risk_tier = 'HIGH' THEN 0.85::DOUBLE ELSE 1.0::DOUBLE END AS threshold,
             coalesce(lot_avg_rate, observed_defect_rate) AS lot_rate
      FROM bq LEFT JOIN base b USING (supplier_id, line_id) LEFT JOIN risk r USING (supplier_id)
              LEFT JOIN lotavg USING (material_lot))""")
part("alerts", "scored", """
SELECT batch_id, supplier_id, line_id, round(observed_defect_rate, 6) AS observed_defect_rate,
       unit_count AS units_flagged, round(z, 4) AS anomaly_score, alert_status,
       risk_tier AS supplier_risk_tier, fail_count AS fail_inspections, avg_defect_count,
       material_lot, production_date, mean_rate, std_rate
FROM scored""")
part("lotrates", "bqall", """
SELECT material_lot AS lot_id, supplier_id, avg(observed_defect_rate) AS mean_defect_rate,
       max(observed_defect_rate) AS max_defect_rate, count(*) AS batch_count,
       CAST(sum(unit_count) AS BIGINT) AS total_units, avg(observed_defect_rate) >= 0.038 AS above_threshold
FROM bqall GROUP BY 1, 2""")
part("weekly", "insp", """
SELECT supplier_id, CAST(date_trunc('week', inspection_date) AS DATE) AS production_week,
       avg(CAST(defect_count AS DOUBLE) / greatest(units_inspected, 1)) AS weekly_defect_rate,
       count(*) AS inspections, CAST(sum(units_inspected) AS BIGINT) AS total_units_inspected,
       CAST(sum(defect_count) AS BIGINT) AS total_defects,
       avg(CAST(defect_count AS DOUBLE) / greatest(units_inspected, 1)) >= 0.038 AS above_threshold
FROM insp GROUP BY 1, 2""")
part("trend6", "hist", """
SELECT supplier_id, max(months) AS months_on_record, round(avg(rate), 5) AS recent_avg_defect_rate,
       max(rate) AS max_historical_rate,
       CASE WHEN count(*) > 1 AND max(CASE WHEN n = 1 THEN rate END) > arg_min(rate, month)
            THEN 'increasing' ELSE 'stable' END AS trend
FROM (SELECT *, row_number() OVER (PARTITION BY supplier_id ORDER BY month DESC) AS n,
             count(*) OVER (PARTITION BY supplier_id) AS months
      FROM (SELECT supplier_id, month, avg(defect_rate) AS rate FROM hist GROUP BY 1, 2))
WHERE n <= 6 GROUP BY supplier_id""")
part("cond", "dimball insp", """
SELECT line_id, strftime(production_date, '%Y-%m') AS month, count(*) AS batches_produced,
       CAST(sum(unit_count) AS BIGINT) AS total_units,
       CAST(sum(defects) AS DOUBLE) / sum(n) AS avg_defects_per_inspection, max(most) AS max_defects,
       CAST(coalesce(sum(fails), 0) AS BIGINT) AS fail_inspections
FROM dimball LEFT JOIN (SELECT batch_id, count(*) AS n, sum(defect_count) AS defects, max(defect_count) AS most,
                            count(*) FILTER (pass_fail = 'FAIL') AS fails
                     FROM insp GROUP BY batch_id) USING (batch_id)
GROUP BY 1, 2""")
part("sourcemap", "", """
SELECT * FROM (VALUES ('seam_bulge', 1, 'production_conditions'), ('seam_bulge', 2, 'material_lot'),
  ('seam_bulge', 3, 'supplier_history'), ('heat_transfer_failure', 1, 'material_lot'),
  ('heat_transfer_failure', 2, 'supplier_history'), ('heat_transfer_failure', 3, 'production_conditions'),
  ('material_deformation', 1, 'supplier_history'), ('material_deformation', 2, 'material_lot'),
  ('minor_thread', 1, 'production_conditions'), ('minor_color_variation', 1, 'supplier_history'))
  AS t(defect_type, pos, source)""")
part("sources", "btypes sourcemap", """
SELECT b.batch_id, coalesce(string_agg(s.source, ',' ORDER BY s.first_at) FILTER (s.rank <= 3),
                            'supplier_history,material_lot') AS evidence_sources
FROM btypes b LEFT JOIN (
  SELECT batch_id, source, first_at, row_number() OVER (PARTITION BY batch_id ORDER BY first_at) AS rank
  FROM (SELECT batch_id, source, min(type_at * 10 + pos) AS first_at
        FROM (SELECT batch_id, unnest(defect_types) AS defect_type,
                     generate_subscripts(defect_types, 1) AS type_at FROM btypes)
             JOIN sourcemap USING (defect_type) GROUP BY 1, 2)) s USING (batch_id)
GROUP BY b.batch_id""")
part("finds", "alerts btypes trend6 sources", """
SELECT *, CASE WHEN has_seam THEN seam_conf WHEN has_heat THEN heat_conf ELSE 0.61::DOUBLE END AS top_confidence,
       round(CASE WHEN has_seam AND has_heat THEN (seam_conf + heat_conf) / 2 WHEN has_seam THEN seam_conf
                  WHEN has_heat THEN heat_conf ELSE 0.61::DOUBLE END, 4) AS overall_confidence,
       CASE WHEN has_seam THEN 'material/' || material_lot WHEN has_heat THEN 'pressing/' || line_id
            ELSE 'process/' || line_id END AS top_hypothesis,
       CASE WHEN has_seam AND has_heat THEN 2 ELSE 1 END AS hypothesis_count,
       CASE WHEN (CASE WHEN has_seam THEN seam_conf WHEN has_heat THEN heat_conf ELSE 0.61 END) >= 0.65
            THEN 'COMPLETE' ELSE 'COMPLETE_LOW_CONFIDENCE' END AS rca_status,
       CASE WHEN (CASE WHEN has_seam THEN seam_conf WHEN has_heat THEN heat_conf ELSE 0.61 END) >= 0.70
            THEN 'HIGH' ELSE 'MEDIUM' END AS confidence_tier
FROM (SELECT a.*, evidence_sources, defect_types,
             list_contains(defect_types, 'seam_bulge') OR list_contains(defect_types, 'material_deformation') AS has_seam,
             list_contains(defect_types, 'heat_transfer_failure') AS has_heat,
             CASE WHEN trend = 'increasing' THEN 0.82::DOUBLE ELSE 0.71::DOUBLE END AS seam_conf,
             CASE WHEN avg_defect_count > 40 THEN 0.78::DOUBLE ELSE 0.63::DOUBLE END AS heat_conf
      FROM alerts a JOIN btypes USING (batch_id) LEFT JOIN trend6 USING (supplier_id)
                    LEFT JOIN sources USING (batch_id)
      WHERE alert_status = 'FLAGGED')""")
part("lotmeta", "insp", """
SELECT material_lot AS lot_id, min(supplier_id) AS supplier_id, 'bonded_seam_tape' AS material_type,
       CAST(min(inspection_date) AS TIMESTAMP) AS entered_production_date,
       CAST(count(*) FILTER (pass_fail = 'FAIL') AS DOUBLE) / count(*) > 0.4 AS is_defective,
       date_diff('day', min(inspection_date), min(inspection_date) FILTER (pass_fail = 'FAIL')) * 24.0::DOUBLE AS hours_to_first_alert
FROM insp GROUP BY 1""")
part("trace", "finds lotrates lotmeta", """
SELECT f.lot_id, f.supplier_id, m.material_type, m.entered_production_date, m.is_defective,
       f.cause AS defect_root_cause, m.hours_to_first_alert, coalesce(r.mean_defect_rate, f.rate) AS mean_defect_rate,
       coalesce(r.batch_count, 1) AS batch_count, f.batches_flagged, f.rca_top_confidence, f.rca_status
FROM (SELECT material_lot AS lot_id, arg_min(supplier_id, batch_id) AS supplier_id,
             arg_min(top_hypothesis, batch_id) AS cause, arg_min(observed_defect_rate, batch_id) AS rate,
             arg_min(top_confidence, batch_id) AS rca_top_confidence, arg_min(rca_status, batch_id) AS rca_status,
             count(*) AS batches_flagged
      FROM finds GROUP BY 1) f
LEFT JOIN lotrates r USING (lot_id, supplier_id) LEFT JOIN lotmeta m USING (lot_id)""")
part("sales", "", """
SELECT CAST(l_shipdate AS DATE) AS date, p_type AS sku, o_orderpriority AS channel,
       CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS units_sold,
       CAST(sum(CASE WHEN l_returnflag = 'R' THEN CAST(l_quantity AS BIGINT) ELSE 0 END) AS BIGINT) AS units_returned,
       round(sum(l_extendedprice), 2) AS revenue_usd,
       round(sum(CASE WHEN l_returnflag = 'R' THEN l_extendedprice ELSE 0 END), 2) AS refund_usd,
       round(CAST(sum(CASE WHEN l_returnflag = 'R' THEN CAST(l_quantity AS BIGINT) ELSE 0 END) AS DOUBLE)
             / sum(CAST(l_quantity AS BIGINT)), 6) AS return_rate
FROM lineitem JOIN part ON l_partkey = p_partkey JOIN orders ON l_orderkey = o_orderkey
GROUP BY 1, 2, 3""")
part("costs", "", """
SELECT o_orderpriority AS run_id, CASE o_orderstatus WHEN 'F' THEN 'detect_early' WHEN 'O' THEN 'detect_late'
       ELSE 'do_nothing' END AS scenario, l_linenumber AS stage_sequence, 'Stage ' || l_linenumber AS stage_name,
       CAST(sum(CAST(floor(l_extendedprice * l_tax) AS BIGINT)) AS DOUBLE) AS stage_cost_usd,
       max(CAST(o_orderdate AS DATE)) AS created_at
FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2, 3, 4""")
part("curves", "costs", """
SELECT *, round(cumulative_cost_usd * (1 - 0.08::DOUBLE), 0) AS p10_cumulative_usd,
       round(cumulative_cost_usd * (1 + 0.08::DOUBLE), 0) AS p90_cumulative_usd,
       round(coalesce(max(CASE WHEN scenario = 'detect_late' THEN cumulative_cost_usd END)
             OVER (PARTITION BY run_id, stage_sequence), 0) - cumulative_cost_usd, 0) AS savings_vs_reference
FROM (SELECT *, sum(stage_cost_usd) OVER (PARTITION BY run_id, scenario ORDER BY stage_sequence
                ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cumulative_cost_usd FROM costs)""")

# One line of name=value for what a status rests on; rounded as decimals, so no noise tips a digit.
_STEADY = "round(CAST({} AS DECIMAL(24, 12)), {})::DOUBLE"
_NEAR = "z >= 1.8 AND z < threshold"
part("reasons", "scored", f"""
SELECT batch_id, concat_ws('; ', 'basis=' || CASE WHEN mean_rate IS NULL THEN 'no baseline' WHEN z >= threshold THEN 'score'
    WHEN {_NEAR} AND alert_status = 'FLAGGED' THEN 'lot' WHEN {_NEAR} THEN 'lot not raised' ELSE 'within range' END,
  'tier=' || risk_tier, printf('z=%.1f', {_STEADY.format("z", 1)}), printf('cut=%.3f', {_STEADY.format("threshold", 3)}),
  printf('rate=%.4f', {_STEADY.format("observed_defect_rate", 4)}), printf('mean=%.4f', {_STEADY.format("mean_rate", 4)}),
  printf('sd=%.4f', {_STEADY.format("std_rate", 4)}),
  CASE WHEN {_NEAR} THEN printf('lot_rate=%.4f', {_STEADY.format("lot_rate", 4)}) END) AS reasoning FROM scored""")
part("histall", "insp", """
SELECT supplier_id, line_id, CAST(date_trunc('month', inspection_date) AS DATE) AS month,
       CAST(sum(units_inspected) AS BIGINT) AS units_inspected,
       avg(CAST(defect_count AS DOUBLE) / units_inspected) AS defect_rate,
       CAST(sum(defect_count) AS BIGINT) AS defects_found
FROM insp GROUP BY 1, 2, 3""")
