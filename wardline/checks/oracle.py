"""Independent DuckDB formulations of the registered queries.

Written against the driver's views (region ... conversations).  The fixture
views are rebuilt here as CTEs with DuckDB's own functions, and every
operator is expressed the plain relational way (range joins, GROUP BY,
ordered string_agg) rather than the Spark plan's window tricks, so the two
implementations check each other.
"""

from __future__ import annotations

VARS = ("hr", "map", "lactate", "gcs")
WS = (r"[\t\n\x{0B}\f\r \x{1C}-\x{1F}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
      r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]")


def _r(expr: str, alias: str, digits: int = 6) -> str:
    return f"round(CAST({expr} AS DOUBLE), {digits}) AS {alias}"


def _hours(a: str, b: str) -> str:
    return f"(date_diff('microsecond', {a}, {b}) / 3.6e9)"


FIXTURES = f"""
stays AS (
  WITH e AS (SELECT user_id, event_type, ts,
                    date_diff('microsecond', TIMESTAMP '2024-01-01 00:00:00', ts) / 1e6 AS sec FROM events),
  b AS (SELECT *, CAST(floor(sec / CASE WHEN user_id % 5 = 4 THEN 108000.0 ELSE 518400.0 END) AS BIGINT) AS blk FROM e),
  g AS (SELECT user_id, blk, min(ts) AS intime, max(ts) AS outtime, max_by(event_type, ts) AS last_type
        FROM b GROUP BY user_id, blk)
  SELECT user_id * 100 + blk AS stay_id, user_id AS subject_id,
         CASE WHEN user_id % 25 = 7 THEN NULL ELSE user_id * 100 + blk // 2 END AS hadm_id,
         intime, outtime,
         CASE WHEN last_type = 'error' THEN outtime
              WHEN last_type = 'signup' THEN outtime + INTERVAL '10' HOUR END AS deathtime,
         {_hours('intime', 'outtime')} AS icu_los_hours,
         CAST(18 + user_id % 73 AS DOUBLE) AS age,
         CASE user_id % 4 WHEN 0 THEN 'MICU' WHEN 1 THEN 'SICU' WHEN 2 THEN 'CVICU' END AS first_careunit
  FROM g),
vitals AS (
  SELECT s.stay_id, e.ts AS hour_ts,
         CASE WHEN event_type = 'view' THEN value END AS hr,
         CASE WHEN event_type = 'click' THEN value END AS map,
         CASE WHEN event_type = 'purchase' THEN value END AS lactate,
         CASE WHEN event_type = 'signup' THEN value END AS gcs
  FROM stays s JOIN events e ON e.user_id = s.subject_id
   AND e.ts >= s.intime - INTERVAL '12' HOUR AND e.ts <= s.outtime + INTERVAL '12' HOUR),
notes AS (
  SELECT s.stay_id, n.doc_id AS note_row,
         s.intime + to_hours(CAST(n.doc_id * 37 % (CAST(floor(s.icu_los_hours) AS BIGINT) + 7) - 6 AS BIGINT))
           AS radiology_note_time_max, n.txt AS radiology_note_text
  FROM (SELECT doc_id, doc_id % (SELECT count(DISTINCT user_id) FROM events) AS uid,
               doc_id // (SELECT count(DISTINCT user_id) FROM events) AS turn,
               concat(text, chr(10), '-----', chr(10), 'Impression ', source, chr(10),
                      'Electronically signed by x', chr(10), '---', chr(10), '  ') AS txt
        FROM documents) n
  JOIN (SELECT *, row_number() OVER (PARTITION BY subject_id ORDER BY stay_id) - 1 AS ord,
               count(*) OVER (PARTITION BY subject_id) AS n_stays FROM stays) s
    ON s.subject_id = n.uid AND n.turn % s.n_stays = s.ord),
predictions AS (
  SELECT d.doc_id AS row_id, d.lang AS first_careunit, l.quality AS y1_true,
         least(CAST(1 AS DOUBLE), floor(CAST(d.n_chars AS DOUBLE) / 4) / 1000) AS y1_prob,
         1 - l.toxic AS y2_true, CAST(d.doc_id * 7919 % 1000 AS DOUBLE) / 1000 AS y2_prob, l.quality AS y2_mask
  FROM labels l JOIN documents d ON d.doc_id = l.doc_id),
wide AS (
  SELECT l_orderkey * 10 + l_linenumber AS row_id, o_custkey AS subject_id,
         CASE WHEN l_linenumber % 3 = 0 THEN NULL ELSE l_quantity END AS f1,
         l_extendedprice AS f2, l_discount AS f3,
         CASE WHEN l_orderkey % 5 = 0 THEN NULL ELSE l_tax END AS f4,
         CAST(7 AS DOUBLE) AS f5_const, l_extendedprice * 2.0 + l_linenumber AS f6_dup,
         CASE WHEN l_orderkey % 20 = 0 THEN l_quantity END AS f7_sparse
  FROM lineitem JOIN orders ON o_orderkey = l_orderkey),
kept AS (SELECT * FROM stays WHERE icu_los_hours >= 24),
vrel AS (
  SELECT v.stay_id, {', '.join('v.' + x for x in VARS)},
         CASE WHEN v.hour_ts IS NULL OR k.intime IS NULL THEN NULL
              ELSE greatest({_hours('k.intime', 'v.hour_ts')}, 0.0) END AS relative_hour
  FROM vitals v JOIN kept k ON k.stay_id = v.stay_id),
hourly_r AS (
  SELECT stay_id, CAST(round_even(relative_hour, 0) AS INTEGER) AS hour, {', '.join(f'avg({x}) AS {x}' for x in VARS)}
  FROM vrel WHERE relative_hour IS NOT NULL GROUP BY 1, 2),
hourly_f AS (
  SELECT stay_id, CAST(floor(relative_hour) AS INTEGER) AS hour, {', '.join(f'avg({x}) AS {x}' for x in VARS)}
  FROM vrel WHERE relative_hour IS NOT NULL GROUP BY 1, 2),
spine_r AS (
  SELECT stay_id, CAST(unnest(range(24, max_hour + 1, 12)) AS INTEGER) AS t_end
  FROM (SELECT stay_id, max(hour) AS max_hour FROM hourly_r GROUP BY 1) WHERE max_hour >= 24),
spine_f AS (
  SELECT stay_id, CAST(unnest(range(24, max_hour + 1, 12)) AS INTEGER) AS t_end
  FROM (SELECT stay_id, max(hour) AS max_hour FROM hourly_f GROUP BY 1) WHERE max_hour >= 24),
trail AS (
  SELECT s.stay_id, CAST(s.t_end - 24 AS DOUBLE) AS t_start, CAST(s.t_end AS DOUBLE) AS t_end,
         {', '.join(f'avg(h.{x}) AS {x}_mean' for x in VARS)},
         {', '.join(f'min(h.{x}) AS {x}_min' for x in VARS)},
         {', '.join(f'max(h.{x}) AS {x}_max' for x in VARS)},
         {', '.join(f'max(CASE WHEN h.{x} IS NOT NULL THEN 1.0 ELSE 0.0 END) AS {x}_is_measured' for x in VARS)}
  FROM spine_r s JOIN hourly_r h ON h.stay_id = s.stay_id AND h.hour BETWEEN s.t_end - 23 AND s.t_end
  GROUP BY s.stay_id, s.t_end),
cumul AS (
  SELECT s.stay_id, CAST(0 AS DOUBLE) AS t_start, CAST(s.t_end AS DOUBLE) AS t_end,
         {', '.join(f'avg(h.{x}) AS {x}_cum_mean' for x in VARS)},
         {', '.join(f'coalesce(stddev_samp(h.{x}), 0.0) AS {x}_cum_std' for x in VARS)},
         {', '.join(f'min(h.{x}) AS {x}_cum_min' for x in VARS)},
         {', '.join(f'max(h.{x}) AS {x}_cum_max' for x in VARS)},
         {', '.join(f'arg_max(h.{x}, h.hour) FILTER (WHERE h.{x} IS NOT NULL) AS {x}_last' for x in VARS)},
         {', '.join(f'count(h.{x}) / (s.t_end + 1.0) AS {x}_measured_frac' for x in VARS)}
  FROM spine_f s JOIN hourly_f h ON h.stay_id = s.stay_id AND h.hour <= s.t_end
  GROUP BY s.stay_id, s.t_end),
outcomes AS (
  SELECT stay_id, {_hours('intime', 'outtime')} AS icu_out_hour,
         CAST(coalesce(deathtime <= outtime, false) AS INTEGER) AS icu_death_flag
  FROM kept),
readmit AS (
  SELECT stay_id, CAST(coalesce(gap >= 0 AND gap <= 72, false) AS INTEGER) AS readmit_72h,
         1 - CAST(coalesce(gap >= 0 AND gap <= 72, false) AS INTEGER) AS label_no_return_72h
  FROM (SELECT stay_id, CASE WHEN hadm_id IS NULL THEN NULL ELSE
          {_hours('outtime', 'lead(intime) OVER (PARTITION BY hadm_id ORDER BY intime ASC NULLS LAST, stay_id)')}
          END AS gap FROM kept)),
events_ct AS (
  SELECT stay_id, subject_id, hadm_id,
         CASE WHEN coalesce(deathtime <= outtime, false) THEN 'death' ELSE 'discharge' END AS event_type,
         CASE WHEN coalesce(deathtime <= outtime, false) THEN {_hours('intime', 'deathtime')}
              ELSE {_hours('intime', 'outtime')} END AS event_hour,
         {_hours('intime', 'deathtime')} AS death_hour
  FROM stays),
segs_all AS (
  WITH s1 AS (
    SELECT n.stay_id, n.note_row,
           CASE WHEN n.radiology_note_time_max IS NULL OR k.intime IS NULL THEN NULL
                ELSE greatest({_hours('k.intime', 'n.radiology_note_time_max')}, 0.0) END AS report_time,
           string_split_regex(coalesce(n.radiology_note_text, ''), '-{{3,}}') AS parts
    FROM notes n JOIN kept k ON k.stay_id = n.stay_id),
  s2 AS (SELECT stay_id, note_row, report_time, CAST(unnest(range(0, len(parts))) AS INTEGER) AS pos,
                unnest(parts) AS seg FROM s1),
  s3 AS (SELECT *, regexp_replace(seg, '^{WS}+|{WS}+$', '', 'g') AS st FROM s2),
  s4 AS (SELECT stay_id, note_row, report_time, pos,
                regexp_replace(regexp_replace(regexp_replace(st,
                    '(?is)(Findings|Results){WS}+were{WS}+communicated.*', ''),
                    '(?is)electronically signed.*', ''), '{WS}+', ' ', 'g') AS c
         FROM s3 WHERE length(st) > 0)
  SELECT stay_id, report_time, note_row, pos,
         regexp_replace(c, '^{WS}+|{WS}+$', '', 'g') AS clean_text
  FROM s4 WHERE length(regexp_replace(c, '^{WS}+|{WS}+$', '', 'g')) > 0),
segs AS (SELECT * FROM segs_all WHERE report_time IS NOT NULL),
asof_text AS (
  SELECT s.stay_id, CAST(s.t_end AS DOUBLE) AS t_end,
         coalesce(string_agg(g.clean_text, ' ' ORDER BY g.report_time, g.note_row, g.pos, g.clean_text), '') AS final_text
  FROM (SELECT stay_id, t_end FROM trail) s
  LEFT JOIN segs g ON g.stay_id = s.stay_id AND g.report_time <= s.t_end
  GROUP BY s.stay_id, s.t_end),
master_tr AS (
  SELECT t.*, a.final_text, CAST(length(a.final_text) > 0 AS INTEGER) AS has_text,
         k.subject_id, k.hadm_id, k.age, k.first_careunit, o.icu_out_hour, o.icu_death_flag,
         CAST(o.icu_out_hour - t.t_end <= 24 AS INTEGER) AS discharge_in_24h,
         CAST(o.icu_out_hour - t.t_end <= 24 AND o.icu_death_flag = 0 AS INTEGER) AS label_can_discharge_24h,
         coalesce(r.label_no_return_72h, 0) AS label_no_return_72h,
         CAST(o.icu_out_hour - t.t_end <= 24 AND o.icu_death_flag = 0 AS INTEGER) AS task2_mask
  FROM trail t JOIN asof_text a ON a.stay_id = t.stay_id AND a.t_end = t.t_end
  JOIN kept k ON k.stay_id = t.stay_id JOIN outcomes o ON o.stay_id = t.stay_id
  LEFT JOIN readmit r ON r.stay_id = t.stay_id
  WHERE t.t_end <= o.icu_out_hour),
master_cum AS (
  SELECT t.*, k.subject_id, k.hadm_id, k.age, k.first_careunit, o.icu_out_hour, o.icu_death_flag,
         CAST(o.icu_out_hour - t.t_end <= 24 AS INTEGER) AS discharge_in_24h,
         CAST(o.icu_out_hour - t.t_end <= 24 AND o.icu_death_flag = 0 AS INTEGER) AS label_can_discharge_24h,
         coalesce(r.label_no_return_72h, 0) AS label_no_return_72h,
         CAST(o.icu_out_hour - t.t_end <= 24 AND o.icu_death_flag = 0 AS INTEGER) AS task2_mask
  FROM cumul t JOIN kept k ON k.stay_id = t.stay_id JOIN outcomes o ON o.stay_id = t.stay_id
  LEFT JOIN readmit r ON r.stay_id = t.stay_id
  WHERE t.t_end <= o.icu_out_hour),
lmk AS (
  SELECT m.*, e.event_type, e.event_hour, e.death_hour, e.event_hour - m.t_end AS remaining_hours
  FROM master_cum m JOIN events_ct e ON e.stay_id = m.stay_id
  WHERE e.event_hour IS NOT NULL AND e.event_hour > 0 AND e.subject_id IS NOT NULL
    AND e.event_hour - m.t_end > 0)
"""


def _interval_cols(prefix: str = "") -> str:
    out, lo = [], 0
    for hi in (24, 48, 72):
        ins = f"({prefix}remaining_hours > {lo} AND {prefix}remaining_hours <= {hi})"
        out.append(f"CAST({prefix}event_type = 'discharge' AND {ins} AS INTEGER) AS event_discharge_{lo}_{hi}h")
        out.append(f"CAST({prefix}event_type = 'death' AND {ins} AS INTEGER) AS event_death_{lo}_{hi}h")
        lo = hi
    for hi in (24, 48, 72):
        out.append(f"CAST({prefix}event_type = 'discharge' AND {prefix}remaining_hours <= {hi} AS INTEGER) AS event_discharge_within_{hi}h")
        out.append(f"CAST({prefix}event_type = 'death' AND {prefix}remaining_hours <= {hi} AS INTEGER) AS event_death_within_{hi}h")
    return ", ".join(out)


def _round_all(cols, digits=6, over=None):
    over = over or {}
    return ", ".join(_r(c, c, over.get(c, digits)) for c in cols)


TR_FEATS = ([f"{v}_mean" for v in VARS] + [f"{v}_min" for v in VARS] + [f"{v}_max" for v in VARS]
            + [f"{v}_is_measured" for v in VARS])
CUM_FEATS = ([f"{v}_cum_mean" for v in VARS] + [f"{v}_cum_std" for v in VARS] + [f"{v}_cum_min" for v in VARS]
             + [f"{v}_cum_max" for v in VARS] + [f"{v}_last" for v in VARS] + [f"{v}_measured_frac" for v in VARS])
STD4 = {f"{v}_cum_std": 4 for v in VARS}
LABEL_COLS = "icu_death_flag, discharge_in_24h, label_can_discharge_24h, label_no_return_72h, task2_mask"

QUERIES: dict[str, str] = {
    "los_filter": f"SELECT stay_id, subject_id, hadm_id, {_r('icu_los_hours', 'icu_los_hours')}, "
                  f"{_r('age', 'age')}, first_careunit FROM kept",
    "los_report": "SELECT count(*) AS total_stays, count_if(icu_los_hours < 24) AS short_stays, "
                  + _r("count_if(icu_los_hours < 24) * 100.0 / greatest(count(*), 1)", "short_pct") + " FROM stays",
    "cohort_semi_join": f"SELECT stay_id, {_r('relative_hour', 'relative_hour')}, {_round_all(VARS)} FROM vrel",
    "hour_range": f"SELECT {_r('min(relative_hour)', 'min_hour')}, {_r('max(relative_hour)', 'max_hour')} FROM vrel",
    "hourly_mean_rint": f"SELECT stay_id, hour, {_round_all(VARS)} FROM hourly_r",
    "hourly_mean_floor": f"SELECT stay_id, hour, {_round_all(VARS)} FROM hourly_f",
    "landmark_spine": "SELECT stay_id, t_end FROM spine_r",
    "trailing_features": f"SELECT stay_id, t_start, t_end, {_round_all(TR_FEATS)} FROM trail",
    "task1_label": f"SELECT t.stay_id, t.t_end, {_r('o.icu_out_hour', 'icu_out_hour')}, o.icu_death_flag, "
                   "CAST(o.icu_out_hour - t.t_end <= 24 AS INTEGER) AS discharge_in_24h, "
                   "CAST(o.icu_out_hour - t.t_end <= 24 AND o.icu_death_flag = 0 AS INTEGER) AS label_can_discharge_24h "
                   "FROM trail t JOIN outcomes o ON o.stay_id = t.stay_id WHERE t.t_end <= o.icu_out_hour",
    "icu_death_flag": f"SELECT stay_id, {_r(_hours('intime', 'outtime'), 'icu_out_hour')}, "
                      "CAST(coalesce(deathtime <= outtime, false) AS INTEGER) AS icu_death_flag FROM stays",
    "readmit_labels": "SELECT stay_id, readmit_72h, label_no_return_72h FROM readmit",
    "event_table": f"SELECT stay_id, subject_id, hadm_id, event_type, {_r('event_hour', 'event_hour')}, "
                   f"{_r('death_hour', 'death_hour')} FROM events_ct "
                   "WHERE stay_id IS NOT NULL AND subject_id IS NOT NULL AND event_hour IS NOT NULL AND event_hour > 0",
    "landmark_labels": f"SELECT stay_id, t_end, event_type, {_r('event_hour', 'event_hour')}, "
                       f"{_r('remaining_hours', 'remaining_hours')}, "
                       "CAST(greatest(floor(t_end / 24) * 24, 24) AS INTEGER) AS landmark_bin, "
                       f"{_r('t_end', 'landmark_hour')}, {_r('t_end * t_end', 'landmark_hour_sq')}, "
                       f"{_interval_cols()} FROM lmk",
    "survival_targets": "SELECT m.stay_id, m.subject_id, m.t_end, e.event_type, "
                        f"{_r('e.event_hour', 'event_hour')}, "
                        + ", ".join(
                            f"CASE WHEN e.event_hour - m.t_end > {lo} AND e.event_hour - m.t_end <= {hi} THEN "
                            f"(CASE e.event_type WHEN 'discharge' THEN 1 WHEN 'death' THEN 2 ELSE 0 END) ELSE 0 END "
                            f"AS surv_label_bin{i + 1}" for i, (lo, hi) in enumerate(((0, 24), (24, 48), (48, 72))))
                        + " FROM master_tr m JOIN events_ct e ON e.stay_id = m.stay_id AND e.subject_id = m.subject_id "
                          "WHERE e.event_type IS NOT NULL AND e.event_hour IS NOT NULL",
    "multi_horizon_labels": f"SELECT stay_id, t_end, event_type, {_r('remaining_hours', 'remaining_hours')}, "
                            + ", ".join(
                                f"CAST(event_type = 'discharge' AND remaining_hours <= {h} AS INTEGER) AS event_discharge_within_{h}h, "
                                f"CAST(event_type = 'death' AND remaining_hours <= {h} AS INTEGER) AS event_death_within_{h}h"
                                for h in (6, 12, 18, 24)) + " FROM lmk",
    "cumulative_features": f"SELECT stay_id, t_start, t_end, {_round_all(CUM_FEATS, 6, STD4)} FROM cumul",
    "locf": "SELECT stay_id, hour, " + ", ".join(
        f"round(last_value({v} IGNORE NULLS) OVER (PARTITION BY stay_id ORDER BY hour "
        f"ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 6) AS {v}_locf" for v in VARS) + " FROM hourly_f",
    "master_cumulative": f"SELECT stay_id, t_start, t_end, {_round_all(CUM_FEATS, 6, STD4)}, subject_id, hadm_id, "
                         f"{_r('age', 'age')}, first_careunit, {_r('icu_out_hour', 'icu_out_hour')}, {LABEL_COLS} "
                         "FROM master_cum",
    "landmark_table": f"SELECT stay_id, t_start, t_end, {_round_all(CUM_FEATS, 6, STD4)}, subject_id, hadm_id, "
                      f"{_r('age', 'age')}, first_careunit, {_r('icu_out_hour', 'icu_out_hour')}, {LABEL_COLS}, "
                      f"event_type, {_r('event_hour', 'event_hour')}, {_r('death_hour', 'death_hour')}, "
                      f"{_r('remaining_hours', 'remaining_hours')}, {_interval_cols()}, "
                      "CAST(greatest(floor(t_end / 24) * 24, 24) AS INTEGER) AS landmark_bin, "
                      f"{_r('t_end', 'landmark_hour')}, {_r('t_end * t_end', 'landmark_hour_sq')} FROM lmk",
    "note_segments": f"SELECT stay_id, {_r('report_time', 'report_time')}, note_row, pos, clean_text FROM segs",
    "note_asof_text": "SELECT stay_id, t_end, final_text, CAST(length(final_text) > 0 AS INTEGER) AS has_text FROM asof_text",
    "master_trailing": f"SELECT stay_id, t_start, t_end, {_round_all(TR_FEATS)}, final_text, has_text, subject_id, "
                       f"hadm_id, {_r('age', 'age')}, first_careunit, {_r('icu_out_hour', 'icu_out_hour')}, "
                       f"{LABEL_COLS} FROM master_tr",
}


def with_fixtures(sql: str) -> str:
    for start in ("WITH RECURSIVE ", "WITH "):
        if sql.startswith(start):
            return f"{start}{FIXTURES},\n{sql[len(start):]}"
    return f"WITH {FIXTURES}\n{sql}"


def oracle_sql() -> dict[str, str]:
    return {k: with_fixtures(v) for k, v in QUERIES.items()}


def _task_sql(src: str, y: str, p: str, d: str | None, where: str = "TRUE", group: str | None = None,
              task: str | None = None) -> str:
    """Metrics of one task written the textbook way: Mann-Whitney average
    ranks for AUC, ordered window sums per distinct score for AP."""
    g = group or "1"
    d = d or f"CAST({p} >= 0.5 AS INTEGER)"
    gb = "GROUP BY g" if group else ""
    sel_g = "g AS \"group\", " if group else ""
    join = "USING (g)" if group else "ON TRUE"
    tname = f"'{task}' AS task, " if task else ""
    return f"""(WITH src AS (SELECT {g} AS g, CAST({y} AS INTEGER) AS y, CAST({p} AS DOUBLE) AS p, {d} AS d
                   FROM {src} WHERE {where}),
  tot AS (SELECT {'g, ' if group else ''}count(*) AS n_eval, count_if(y <> 1 AND d <> 1) AS tn,
                 count_if(y <> 1 AND d = 1) AS fp, count_if(y = 1 AND d <> 1) AS fn, count_if(y = 1 AND d = 1) AS tp
          FROM src {gb}),
  rk AS (SELECT g, y, rank() OVER (PARTITION BY g ORDER BY p) + (count(*) OVER (PARTITION BY g, p) - 1) / 2.0 AS ar
         FROM src),
  au AS (SELECT {'g, ' if group else ''}sum(CASE WHEN y = 1 THEN ar END) AS sr, count_if(y = 1) AS np,
                count_if(y <> 1) AS nn FROM rk {gb}),
  dp AS (SELECT g, p, sum(CASE WHEN y = 1 THEN 1 ELSE 0 END) AS pos, count(*) AS cnt FROM src GROUP BY g, p),
  cp AS (SELECT g, pos, sum(pos) OVER (PARTITION BY g ORDER BY p DESC) AS cpos,
                sum(cnt) OVER (PARTITION BY g ORDER BY p DESC) AS ccnt FROM dp),
  ap AS (SELECT {'g, ' if group else ''}sum(pos * cpos / ccnt) AS s FROM cp {gb})
  SELECT {tname}{sel_g}
         round(CASE WHEN np > 0 AND nn > 0 THEN (sr - np * (np + 1) / 2.0) / (np * nn) END, 6) AS auc,
         round(CASE WHEN np > 0 AND nn > 0 THEN ap.s / np END, 6) AS pr_auc,
         round(CASE WHEN tp + fn > 0 THEN tp / (tp + fn) END, 6) AS recall,
         round(CASE WHEN tp + fp > 0 THEN tp / (tp + fp) WHEN n_eval > 0 THEN 0.0 END, 6) AS precision,
         CAST(0.5 AS DOUBLE) AS threshold, n_eval, tn, fp, fn, tp
  FROM tot JOIN au {join} JOIN ap {join})"""


_T1 = dict(src="predictions", y="y1_true", p="y1_prob", d=None)
_T2 = dict(src="predictions", y="y2_true", p="y2_prob", d=None, where="y2_mask = 1")
_TJ = dict(src="predictions", y="CAST(y1_true = 1 AND y2_true = 1 AS INTEGER)", p="y1_prob * y2_prob",
           d="CAST(y1_prob >= 0.5 AND y2_prob >= 0.5 AS INTEGER)")

_LL = ("avg(-(CAST({y} AS DOUBLE) * ln(least(greatest({p}, 2.220446049250313e-16), 1 - 2.220446049250313e-16)) "
       "+ (1 - CAST({y} AS DOUBLE)) * ln(1 - least(greatest({p}, 2.220446049250313e-16), 1 - 2.220446049250313e-16))))")

QUERIES.update({
    "confusion": "SELECT count(*) AS n_eval, count_if(y1_true <> 1 AND y1_prob < 0.5) AS tn, "
                 "count_if(y1_true <> 1 AND y1_prob >= 0.5) AS fp, count_if(y1_true = 1 AND y1_prob < 0.5) AS fn, "
                 "count_if(y1_true = 1 AND y1_prob >= 0.5) AS tp FROM predictions",
    "precision_recall": f"SELECT recall, precision, n_eval FROM {_task_sql(**_T1)}",
    "roc_auc": f"SELECT auc FROM {_task_sql(**_T1)}",
    "average_precision": f"SELECT pr_auc FROM {_task_sql(**_T1)}",
    "roc_points": """SELECT round(p, 6) AS threshold,
            round(CASE WHEN nn > 0 THEN (ccnt - cpos) / nn END, 6) AS fpr,
            round(CASE WHEN np > 0 THEN cpos / np END, 6) AS tpr
        FROM (SELECT p, sum(pos) OVER (ORDER BY p DESC) AS cpos, sum(cnt) OVER (ORDER BY p DESC) AS ccnt,
                     sum(pos) OVER () AS np, sum(cnt) OVER () - sum(pos) OVER () AS nn
              FROM (SELECT y1_prob AS p, sum(CASE WHEN y1_true = 1 THEN 1 ELSE 0 END) AS pos, count(*) AS cnt
                    FROM predictions GROUP BY y1_prob))
        UNION ALL SELECT NULL, CASE WHEN count_if(y1_true <> 1) > 0 THEN 0.0 END, CASE WHEN count_if(y1_true = 1) > 0 THEN 0.0 END
        FROM predictions HAVING count(*) > 0""",
    "log_loss": f"SELECT 'task1_discharge' AS task, round({_LL.format(y='y1_true', p='y1_prob')}, 6) AS log_loss, "
                "count(*) AS n_eval FROM predictions UNION ALL "
                f"SELECT 'task2_no_return72_masked', round({_LL.format(y='y2_true', p='y2_prob')}, 6), count(*) "
                "FROM predictions WHERE y2_mask = 1",
    "brier": "SELECT 'task1_discharge' AS task, round(avg(pow(y1_prob - y1_true, 2)), 6) AS brier, count(*) AS n_eval "
             "FROM predictions UNION ALL SELECT 'task2_no_return72_masked', round(avg(pow(y2_prob - y2_true, 2)), 6), "
             "count(*) FROM predictions WHERE y2_mask = 1",
    "calibration_bins": """SELECT CAST(bin AS INTEGER) AS bin, round(avg(p), 6) AS mean_pred, round(avg(y), 6) AS frac_pos,
            count(*) AS n
        FROM (SELECT p, y, len(list_filter(e, lambda x: x < p)) AS bin
              FROM (SELECT y1_prob AS p, CAST(y1_true AS DOUBLE) AS y FROM predictions),
                   (SELECT quantile_cont(y1_prob, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]) AS e
                    FROM predictions))
        GROUP BY bin""",
    "calibration_task2": """SELECT CAST(bin AS INTEGER) AS bin, round(avg(p), 6) AS mean_pred, round(avg(y), 6) AS frac_pos,
            count(*) AS n
        FROM (SELECT p, y, len(list_filter(e, lambda x: x < p)) AS bin
              FROM (SELECT y2_prob AS p, CAST(y2_true AS DOUBLE) AS y FROM predictions WHERE y2_mask = 1),
                   (SELECT quantile_cont(y2_prob, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]) AS e
                    FROM predictions WHERE y2_mask = 1))
        GROUP BY bin""",
    "subgroup_metrics": "SELECT * FROM " + _task_sql(
        "(SELECT *, coalesce(first_careunit, 'UNKNOWN') AS grp FROM predictions)", "y1_true", "y1_prob", None,
        group="grp", task="task1_discharge") + " UNION ALL SELECT * FROM " + _task_sql(
        "(SELECT *, coalesce(first_careunit, 'UNKNOWN') AS grp FROM predictions)", "y2_true", "y2_prob", None,
        where="y2_mask = 1", group="grp", task="task2_no_return72_masked"),
    "metrics_bundle": f"SELECT * FROM {_task_sql(**_T1, task='task1_discharge')} UNION ALL "
                      f"SELECT * FROM {_task_sql(**_T2, task='task2_no_return72_masked')} UNION ALL "
                      f"SELECT * FROM {_task_sql(**_TJ, task='joint_both_positive')}",
})


def _split_expr(col: str, seed: int = 42) -> str:
    r = lambda s: f"CAST('0x' || substr(md5('{s}:' || CAST({col} AS VARCHAR)), 1, 8) AS BIGINT) % 10000"
    return f"CASE WHEN {r(seed)} >= 8000 THEN 'test' WHEN {r(seed + 1)} >= 8000 THEN 'val' ELSE 'train' END"


WIDE = ("f1", "f2", "f3", "f4", "f5_const", "f6_dup", "f7_sparse")
_WIDE_CTE = (f"ws AS (SELECT *, {_split_expr('subject_id')} AS split FROM wide), "
             "med AS (SELECT " + ", ".join(f"quantile_cont({c}, 0.5) AS {c}" for c in WIDE)
             + " FROM ws WHERE split = 'train'), "
             "imp AS (SELECT ws.row_id, ws.subject_id, ws.split, "
             + ", ".join(f"coalesce(ws.{c}, med.{c}) AS {c}" for c in WIDE) + " FROM ws, med) ")
_CORR_PAIRS = " OR ".join(
    f"coalesce(abs(corr({a}, {b})) > 0.95 AND NOT isnan(corr({a}, {b})), false)" for a in WIDE for b in WIDE
    if WIDE.index(a) < WIDE.index(b))

QUERIES.update({
    "group_split": f"SELECT row_id, subject_id, {_split_expr('subject_id')} AS split FROM wide",
    "aalen_johansen": f"""WITH d AS (
        SELECT t_end, remaining_hours AS t, count(*) AS n, count(*) FILTER (event_type = 'discharge') AS d1,
               count(*) FILTER (event_type = 'death') AS d2 FROM lmk WHERE remaining_hours IS NOT NULL GROUP BY ALL),
      r AS (SELECT *, sum(n) OVER (PARTITION BY t_end ORDER BY t DESC) AS at_risk FROM d),
      s AS (SELECT *, product(1.0 - (d1 + d2) / at_risk) OVER (PARTITION BY t_end ORDER BY t) AS survival FROM r),
      b AS (SELECT *, coalesce(lag(survival) OVER (PARTITION BY t_end ORDER BY t), 1.0) AS before FROM s)
      SELECT t_end, {_r('t', 'remaining_hours')}, CAST(at_risk AS BIGINT) AS at_risk, {_r('survival', 'survival')},
             round(sum(before * d1 / at_risk) OVER w, 6) AS cif_discharge, round(sum(before * d2 / at_risk) OVER w, 6) AS cif_death
      FROM b WINDOW w AS (PARTITION BY t_end ORDER BY t)""",
    "group_split_exact": """WITH g AS (
        SELECT subject_id, row_number() OVER (ORDER BY CAST('0x' || substr(md5('42:' || CAST(subject_id AS VARCHAR)), 1, 8) AS BIGINT), subject_id) AS r1,
               CAST('0x' || substr(md5('43:' || CAST(subject_id AS VARCHAR)), 1, 8) AS BIGINT) AS h2, count(*) OVER () AS n
        FROM (SELECT DISTINCT subject_id FROM wide WHERE subject_id IS NOT NULL)),
      o AS (SELECT subject_id, r1 <= n * 8 // 10 AS kept, n * 8 // 10 AS outer_n,
                   row_number() OVER (PARTITION BY r1 <= n * 8 // 10 ORDER BY h2, subject_id) AS r2 FROM g)
      SELECT row_id, w.subject_id, CASE WHEN o.kept IS NULL THEN NULL WHEN NOT o.kept THEN 'test'
             WHEN r2 <= outer_n * 8 // 10 THEN 'train' ELSE 'val' END AS split
      FROM wide w LEFT JOIN o ON o.subject_id = w.subject_id""",
    "split_summary": f"SELECT split, count(*) AS rows, count(DISTINCT subject_id) AS patients, "
                     f"round(avg(label_can_discharge_24h), 6) AS pos_rate "
                     f"FROM (SELECT *, {_split_expr('subject_id')} AS split FROM master_tr) GROUP BY split",
    "debug_sample": "SELECT stay_id, subject_id FROM kept ORDER BY "
                    "CAST('0x' || substr(md5('42:' || CAST(stay_id AS VARCHAR)), 1, 8) AS BIGINT), stay_id LIMIT 50",
    "leakage_drop": f"SELECT stay_id, subject_id, hadm_id, {_r('age', 'age')}, first_careunit FROM kept",
    "missing_rate": f"WITH {_WIDE_CTE.split(', med AS')[0]} " + " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", round(avg(CASE WHEN {c} IS NULL OR isnan({c}) THEN 1.0 ELSE 0.0 END), 6) "
        f"AS missing_rate FROM ws WHERE split = 'train'" for c in WIDE),
    "median_impute": f"WITH {_WIDE_CTE} SELECT row_id, subject_id, split, "
                     + ", ".join(f"round({c}, 6) AS {c}" for c in WIDE) + " FROM imp",
    "standardize": f"WITH {_WIDE_CTE}, sd AS (SELECT "
                   + ", ".join(f"avg({c}) AS m_{c}, CASE WHEN stddev_pop({c}) = 0 THEN 1 ELSE stddev_pop({c}) END "
                               f"AS s_{c}" for c in WIDE)
                   + " FROM imp WHERE split = 'train') SELECT row_id, split, "
                   + ", ".join(f"round(({c} - m_{c}) / s_{c}, 6) AS {c}" for c in WIDE) + " FROM imp, sd",
    "corr_drop": f"WITH {_WIDE_CTE}, tr AS (SELECT * FROM imp WHERE split = 'train') "
                 + " UNION ALL ".join(
                     (f"SELECT '{b}' AS \"column\", CAST("
                      + " OR ".join(f"coalesce(abs(corr({a}, {b})) > 0.95 AND NOT isnan(corr({a}, {b})), false)"
                                    for a in WIDE[:j])
                      + " AS INTEGER) AS dropped FROM tr") if j else f"SELECT '{b}' AS \"column\", 0 AS dropped"
                     for j, b in enumerate(WIDE)),
    "top_variance": f"WITH {_WIDE_CTE}, v AS (" + " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", var_samp({c}) AS variance FROM imp WHERE split = 'train'" for c in WIDE)
        + ") SELECT \"column\", round(variance, 4) AS variance, "
          "CAST(row_number() OVER (ORDER BY variance DESC, \"column\") AS INTEGER) AS rank FROM v "
          "WHERE variance IS NOT NULL QUALIFY rank <= 12",
})


_TOK = r"regexp_extract_all(lower(coalesce({t}, '')), '[\p{{L}}\p{{N}}_]{{2,}}')"


def _terms_sql(tok: str) -> str:
    """Unigrams then bigrams of an already computed token list column."""
    return (f"list_concat({tok}, CASE WHEN len({tok}) >= 2 THEN "
            f"list_transform(range(1, len({tok})), lambda i: {tok}[i] || ' ' || {tok}[i + 1]) "
            f"ELSE []::VARCHAR[] END)")


QUERIES.update({
    "tfidf": f"""WITH tk AS (SELECT doc_id, {_TOK.format(t='text')} AS tok, {_split_expr('doc_id')} AS split FROM documents),
        dt AS (SELECT doc_id, split, unnest({_terms_sql('tok')}) AS term FROM tk),
        ndoc AS (SELECT count(*) AS n FROM tk WHERE split = 'train'),
        pd AS (SELECT doc_id, split, term, count(*) AS tf FROM dt GROUP BY ALL),
        pt AS (SELECT term, count(*) AS df, sum(tf) AS tf FROM pd WHERE split = 'train' GROUP BY term),
        voc AS (SELECT term, ln((1 + n) / (1 + df)) + 1 AS idf FROM pt, ndoc WHERE df >= 5
                ORDER BY tf DESC, term LIMIT 300),
        raw AS (SELECT pd.doc_id, pd.term, pd.tf * voc.idf AS w FROM pd JOIN voc USING (term))
        SELECT doc_id, term, round(w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)), 6) AS weight FROM raw""",
    "vocab_encode": f"""WITH tok AS (SELECT doc_id, {_TOK.format(t='text')} AS t, {_split_expr('doc_id')} AS split
                             FROM documents),
        voc AS (SELECT w, CAST(row_number() OVER (ORDER BY c DESC, w) + 1 AS INTEGER) AS id
                FROM (SELECT unnest(t) AS w, count(*) AS c FROM tok WHERE split = 'train' GROUP BY 1)),
        ex AS (SELECT doc_id, unnest(t[1:128]) AS w, unnest(range(0, len(t[1:128]))) AS pos FROM tok),
        enc AS (SELECT ex.doc_id, list(coalesce(voc.id, 1) ORDER BY ex.pos) AS ids
                FROM ex LEFT JOIN voc USING (w) GROUP BY ex.doc_id)
        SELECT tok.doc_id, CAST(len(tok.t) AS INTEGER) AS n_tokens,
               array_to_string(list_concat(coalesce(enc.ids, []::INTEGER[]),
                   list_transform(range(128 - len(coalesce(enc.ids, []::INTEGER[]))), lambda x: 0)), ' ') AS input_ids,
               CAST(len(coalesce(enc.ids, []::INTEGER[])) AS INTEGER) AS attention_len
        FROM tok LEFT JOIN enc USING (doc_id)""",
    "history_tensor": "SELECT m.stay_id, m.t_end, CAST(p.pos AS INTEGER) AS pos, "
                      + ", ".join(f"round(h.{v}, 6) AS {v}" for v in VARS)
                      + " FROM master_tr m, (SELECT unnest(range(0, 24)) AS pos) p "
                        "LEFT JOIN hourly_f h ON h.stay_id = m.stay_id AND h.hour = CAST(floor(m.t_end) AS INTEGER) - 23 + p.pos",
    "tensor_normalize": "WITH sl AS (SELECT h.* FROM (SELECT * FROM master_tr WHERE "
                        + _split_expr("subject_id") + " = 'train') m, (SELECT unnest(range(0, 24)) AS pos) p "
                        "LEFT JOIN hourly_f h ON h.stay_id = m.stay_id AND h.hour = CAST(floor(m.t_end) AS INTEGER) - 23 + p.pos) "
                        + " UNION ALL ".join(
                            f"SELECT '{v}' AS variable, round(coalesce(avg({v}), 0.0), 6) AS mean, "
                            f"round(CASE WHEN stddev_pop({v}) > 1e-6 THEN stddev_pop({v}) ELSE 1.0 END, 6) AS std FROM sl"
                            for v in VARS),
    "modality_switch": "SELECT m.stay_id, m.t_end, CAST(p.pos AS INTEGER) AS pos, "
                       + ", ".join(f"0.0 AS {v}" for v in VARS)
                       + " FROM master_tr m, (SELECT unnest(range(0, 24)) AS pos) p",
})


def _softmax_sql(b: int) -> tuple[str, str]:
    n, d, m = (f"(8 * list_avg(list_filter(embedding, lambda x, i: (i - 1) % 9 = {3 * b + k})::DOUBLE[]))"
               for k in range(3))
    mx = f"greatest({n}, {d}, {m})"
    den = f"(exp({n} - {mx}) + exp({d} - {mx}) + exp({m} - {mx}))"
    return f"exp({d} - {mx}) / {den}", f"exp({m} - {mx}) / {den}"


def _cif_sql(rescale: bool) -> str:
    names = ("0_24h", "24_48h", "48_72h")
    hz = [_softmax_sql(b) for b in range(3)]
    cols = []
    for b, (hd, hm) in enumerate(hz):
        cols += [f"{hd} AS hazard_discharge_{names[b]}", f"{hm} AS hazard_death_{names[b]}"]
    inner = f"SELECT vec_id, {', '.join(cols)} FROM embeddings"
    parts, s, cd, cm = [], "1.0", "0.0", "0.0"
    for b in range(3):
        hd, hm = f"hazard_discharge_{names[b]}", f"hazard_death_{names[b]}"
        if rescale:
            k = f"(CASE WHEN {hd} + {hm} > 0.999 THEN 0.999 / greatest({hd} + {hm}, 1e-8) ELSE 1.0 END)"
            hd, hm = f"({hd} * {k})", f"({hm} * {k})"
        cd = f"({cd} + {s} * {hd})"
        cm = f"({cm} + {s} * {hm})"
        parts += [f"round({cd}, 6) AS cif_discharge_{('24h', '48h', '72h')[b]}",
                  f"round({cm}, 6) AS cif_death_{('24h', '48h', '72h')[b]}"]
        s = f"({s} * least(greatest(1.0 - {hd} - {hm}, 0.0), 1.0))"
    hcols = [f"round({c.rsplit(' AS ', 1)[1]}, 6) AS {c.rsplit(' AS ', 1)[1]}" for c in cols]
    return (f"SELECT vec_id, {', '.join(hcols)}, round(hazard_discharge_0_24h, 6) AS task1_prob, "
            f"{', '.join(parts)} FROM ({inner})")


QUERIES.update({
    "class_weight": "WITH tr AS (SELECT * FROM master_tr WHERE " + _split_expr("subject_id") + " = 'train') "
                    + " UNION ALL ".join(
                        f"SELECT '{task}' AS task, count(*) AS n_rows, CAST(coalesce(sum({lab}), 0) AS BIGINT) AS n_pos, "
                        f"count(*) - CAST(coalesce(sum({lab}), 0) AS BIGINT) AS n_neg, "
                        f"round(CASE WHEN coalesce(sum({lab}), 0) > 0 THEN (count(*) - sum({lab})) / sum({lab}) "
                        f"ELSE 1.0 END, 6) AS scale_pos_weight, "
                        f"round(least(greatest(CASE WHEN count(*) > 0 THEN coalesce(sum({lab}), 0) / count(*) "
                        f"ELSE 0.5 END, 1e-6), 1 - 1e-6), 6) AS constant_prob FROM tr {where}"
                        for task, lab, where in (("task1_discharge", "label_can_discharge_24h", ""),
                                                 ("task2_no_return72_masked", "label_no_return_72h",
                                                  "WHERE task2_mask = 1"))),
    "seeded_sample": "SELECT stay_id, t_end FROM master_tr ORDER BY CAST('0x' || substr(md5('42:' || "
                     "concat_ws('|', CAST(stay_id AS VARCHAR), CAST(CAST(t_end AS BIGINT) AS VARCHAR))), 1, 8) AS BIGINT), "
                     "concat_ws('|', CAST(stay_id AS VARCHAR), CAST(CAST(t_end AS BIGINT) AS VARCHAR)) LIMIT 2000",
    "cif": _cif_sql(False),
    "cif_rescaled": _cif_sql(True),
})


_SWAP = ("(SELECT row_id, first_careunit, y1_true, y2_prob AS y1_prob, y2_true, y1_prob AS y2_prob, y2_mask "
         "FROM predictions)")
_FLIP = ("(SELECT row_id, first_careunit, y1_true, 1 - y1_prob AS y1_prob, y2_true, 1 - y2_prob AS y2_prob, "
         "y2_mask FROM predictions)")


def _bundle_sql(src: str) -> str:
    t1 = dict(src=src, y="y1_true", p="y1_prob", d=None)
    t2 = dict(src=src, y="y2_true", p="y2_prob", d=None, where="y2_mask = 1")
    tj = dict(src=src, y="CAST(y1_true = 1 AND y2_true = 1 AS INTEGER)", p="y1_prob * y2_prob",
              d="CAST(y1_prob >= 0.5 AND y2_prob >= 0.5 AS INTEGER)")
    return (f"(SELECT * FROM {_task_sql(**t1, task='task1_discharge')} UNION ALL "
            f"SELECT * FROM {_task_sql(**t2, task='task2_no_return72_masked')} UNION ALL "
            f"SELECT * FROM {_task_sql(**tj, task='joint_both_positive')})")


_MET = ("auc", "pr_auc", "recall", "precision")
_BUNDLES = f"bc AS {_bundle_sql('predictions')}, ba AS {_bundle_sql(_SWAP)}, bb AS {_bundle_sql(_FLIP)}"
_LONG = lambda b: " UNION ALL ".join(f"SELECT task, '{m}' AS metric, {m} AS v FROM {b}" for m in _MET)

QUERIES.update({
    "comparison_long": f"WITH {_BUNDLES}, lc AS ({_LONG('bc')}), la AS ({_LONG('ba')}), lb AS ({_LONG('bb')}) "
                       "SELECT lc.task, lc.metric, lc.v AS candidate, la.v AS baseline_a, lb.v AS baseline_b, "
                       "round(lc.v - la.v, 6) AS delta_vs_baseline_a, round(lc.v - lb.v, 6) AS delta_vs_baseline_b "
                       "FROM lc JOIN la USING (task, metric) JOIN lb USING (task, metric)",
    "comparison_wide": f"WITH {_BUNDLES} SELECT bc.task, "
                       + ", ".join(f"{x}.{m} AS {m}_{n}" for m in _MET
                                   for x, n in (("bc", "candidate"), ("ba", "baseline_a"), ("bb", "baseline_b")))
                       + ", " + ", ".join(f"round(bc.{m} - {x}.{m}, 6) AS {m}_candidate_minus_{n}" for m in _MET
                                          for x, n in (("ba", "baseline_a"), ("bb", "baseline_b")))
                       + " FROM bc JOIN ba USING (task) JOIN bb USING (task)",
})


_LM_FEATS = list(CUM_FEATS) + ["age", "landmark_hour", "landmark_hour_sq"]

QUERIES["interactions"] = (
    "WITH lt AS (SELECT *, t_end AS landmark_hour, t_end * t_end AS landmark_hour_sq, "
    + _split_expr("subject_id") + " AS split FROM lmk), "
    "lg AS (SELECT * FROM (SELECT stay_id, t_end, split, "
    + ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in _LM_FEATS) + " FROM lt) UNPIVOT INCLUDE NULLS (v FOR feature IN ("
    + ", ".join(_LM_FEATS) + "))), "
    "miss AS (SELECT feature, avg(CASE WHEN v IS NULL OR isnan(v) THEN 1.0 ELSE 0.0 END) AS r FROM lg "
    "WHERE split = 'train' GROUP BY feature), "
    "kf AS (SELECT feature FROM miss WHERE r <= 0.9 OR suffix(feature, '_measured_frac')), "
    "med AS (SELECT feature, quantile_cont(v, 0.5) AS m FROM lg WHERE split = 'train' GROUP BY feature), "
    "imp AS (SELECT l.stay_id, l.t_end, l.split, l.feature, coalesce(l.v, med.m) AS v FROM lg l "
    "JOIN kf USING (feature) JOIN med USING (feature) WHERE med.m IS NOT NULL), "
    "vr AS (SELECT feature, var_samp(v) AS s FROM imp WHERE split = 'train' "
    "AND feature NOT IN ('landmark_hour', 'landmark_hour_sq') GROUP BY feature), "
    "top AS (SELECT feature FROM vr WHERE s IS NOT NULL ORDER BY s DESC, feature LIMIT 12) "
    "SELECT i.stay_id, i.t_end, i.feature || '_x_landmark' AS feature, round(i.v * lh.v, 6) AS value "
    "FROM imp i JOIN top USING (feature) "
    "JOIN imp lh ON lh.stay_id = i.stay_id AND lh.t_end = i.t_end AND lh.feature = 'landmark_hour'")


# ---- loss curves: the recursions written as recursive CTEs ---------------------------

def _loss_ctes() -> str:
    clip = lambda p: f"least(greatest(CAST({p} AS DOUBLE), 1e-6), 1 - 1e-6)"
    loss = lambda y, p: f"CASE WHEN {y} THEN -ln({clip(p)}) ELSE -ln(1 - {clip(p)}) END"
    return f"""lrow AS (
  SELECT CAST(l_orderkey % 100 + 1 AS INTEGER) AS epoch, l_suppkey % 5 <> 0 AS train,
         l_linenumber <= (l_orderkey % 100 + 1) % 3 AS valid,
         {loss("l_returnflag = 'R'", "l_discount * 10")} AS l1, {loss("l_linestatus = 'O'", "l_tax * 10")} AS l2
  FROM lineitem),
lt AS (
  SELECT epoch, avg(l1) FILTER (WHERE train) AS train_loss_task1,
         avg(l2) FILTER (WHERE train AND valid) AS train_loss_task2_masked,
         avg(l1) FILTER (WHERE NOT train) AS val_loss_task1,
         avg(l2) FILTER (WHERE NOT train AND valid) AS val_loss_task2_masked,
         count(*) FILTER (WHERE train AND valid) AS train_task2_valid_count
  FROM lrow GROUP BY epoch),
lo AS (SELECT *, row_number() OVER (ORDER BY epoch) AS rn FROM lt)"""


def _lambda_ctes(gated: bool) -> str:
    def step(prev: str) -> str:
        ratio = ("lo.train_loss_task1 / greatest(lo.train_loss_task2_masked, 1e-8)" if gated
                 else "lo.train_loss_task1 / (lo.train_loss_task2_masked + 1e-8)")
        gate = " AND lo.train_task2_valid_count >= 64" if gated else ""
        return (f"CASE WHEN coalesce(lo.train_loss_task2_masked > 0, false){gate} "
                f"THEN least(greatest(0.9 * {prev} + 0.1 * ({ratio}), 0.1), 10.0) ELSE {prev} END")
    return f"""{_loss_ctes()},
lam AS (
  SELECT rn, CAST({step('1.0')} AS DOUBLE) AS lw FROM lo WHERE rn = 1
  UNION ALL SELECT lo.rn, {step('lam.lw')} FROM lam JOIN lo ON lo.rn = lam.rn + 1),
curve AS (
  SELECT epoch, train_loss_task1, train_loss_task2_masked, val_loss_task1, val_loss_task2_masked,
         train_task2_valid_count, lw,
         train_loss_task1 + coalesce(lw * train_loss_task2_masked, 0) AS train_loss_total,
         val_loss_task1 + coalesce(lw * val_loss_task2_masked, 0) AS val_loss_total, lo.rn AS rn
  FROM lo JOIN lam ON lam.rn = lo.rn)"""


def _stop_ctes(name: str, col: str, patience: int = 5) -> str:
    better = f"coalesce(c.{col} + 1e-8 < s.best, false)"
    return f"""{name} AS (
  SELECT CAST(0 AS BIGINT) AS rn, CAST('inf' AS DOUBLE) AS best, CAST(NULL AS INTEGER) AS be, 0 AS nimp,
         CAST(NULL AS INTEGER) AS stop
  UNION ALL
  SELECT c.rn, CASE WHEN {better} THEN c.{col} ELSE s.best END, CASE WHEN {better} THEN c.epoch ELSE s.be END,
         CASE WHEN {better} THEN 0 ELSE s.nimp + 1 END,
         CASE WHEN NOT {better} AND s.nimp + 1 >= {patience} THEN c.epoch END
  FROM {name} s JOIN curve c ON c.rn = s.rn + 1 WHERE s.stop IS NULL),
{name}_end AS (SELECT be AS best_epoch, best, coalesce(stop, (SELECT max(epoch) FROM curve)) AS stopped_epoch
  FROM {name} ORDER BY rn DESC LIMIT 1)"""


_CURVE = ("epoch, " + ", ".join(f"round({c}, 6) AS {c}" for c in (
    "train_loss_task1", "train_loss_task2_masked", "val_loss_task1", "val_loss_task2_masked")))
_CURVE_END = ", round(lw, 6) AS \"lambda\", round(train_loss_total, 6) AS train_loss_total, " \
             "round(val_loss_total, 6) AS val_loss_total FROM curve"

QUERIES.update({
    "loss_table": f"WITH {_loss_ctes()} SELECT {_CURVE}, train_task2_valid_count FROM lt",
    "lambda_curve": f"WITH RECURSIVE {_lambda_ctes(False)} SELECT {_CURVE}{_CURVE_END}",
    "lambda_curve_gated": f"WITH RECURSIVE {_lambda_ctes(True)} SELECT {_CURVE}, train_task2_valid_count{_CURVE_END}",
    "best_round": f"WITH RECURSIVE {_lambda_ctes(False)} SELECT epoch AS best_round, round(lw, 6) AS best_lambda, "
                  "round(val_loss_total, 6) AS best_val_total_loss FROM curve ORDER BY val_loss_total, epoch LIMIT 1",
    "early_stop": f"WITH RECURSIVE {_lambda_ctes(False)}, {_stop_ctes('st', 'val_loss_total')} "
                  "SELECT best_epoch, round(best, 6) AS best_val_total_loss, stopped_epoch FROM st_end",
    "two_monitors": f"WITH RECURSIVE {_lambda_ctes(False)}, {_stop_ctes('sa', 'val_loss_total')}, "
                    f"{_stop_ctes('sb', 'val_loss_task2_masked')}, u AS ("
                    "SELECT 'val_loss_total' AS monitor, * FROM sa_end UNION ALL "
                    "SELECT 'val_loss_task2_masked' AS monitor, * FROM sb_end) "
                    "SELECT monitor, best_epoch, round(best, 6) AS best_loss, stopped_epoch, "
                    "(SELECT max(stopped_epoch) FROM u) AS training_stopped FROM u",
})


# ---- fitted matrices in long form -----------------------------------------------------

_TIDY = ("CASE WHEN contains(feature, '_cum_std') THEN round(v, 3) ELSE round(v, 6) END AS value")


def _matrix_ctes(src: str, feats: list, keep_suffix: str, safe=(), scale: bool = False, interactions: bool = False,
                 text: bool = False) -> str:
    """long values -> missing drop -> train medians -> (interactions) ->
    (standardisation) -> correlation drop; ``fin`` is the result."""
    names = ", ".join(f"('{c}', {i})" for i, c in enumerate(feats))
    out = [f"mt AS (SELECT *, {_split_expr('subject_id')} AS split FROM {src})",
           f"fo(feature, ord) AS (VALUES {names})",
           "lg AS (SELECT * FROM (SELECT stay_id, t_end, split, " + ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in feats)
           + " FROM mt) UNPIVOT INCLUDE NULLS (v FOR feature IN (" + ", ".join(feats) + ")))",
           "kf AS (SELECT feature FROM lg WHERE split = 'train' GROUP BY feature "
           "HAVING avg(CASE WHEN v IS NULL OR isnan(v) THEN 1.0 ELSE 0.0 END) <= 0.9 "
           f"OR suffix(feature, '{keep_suffix}')" + "".join(f" OR feature = '{c}'" for c in safe) + ")",
           "med AS (SELECT feature, quantile_cont(v, 0.5) AS m FROM lg WHERE split = 'train' GROUP BY feature)",
           "imp AS (SELECT l.stay_id, l.t_end, l.split, l.feature, CAST(fo.ord AS BIGINT) AS ord, coalesce(l.v, med.m) AS v "
           "FROM lg l JOIN kf USING (feature) JOIN med USING (feature) JOIN fo USING (feature) WHERE med.m IS NOT NULL)"]
    last = "imp"
    if interactions:
        out += ["vr AS (SELECT feature, var_samp(v) AS s FROM imp WHERE split = 'train' "
                "AND feature NOT IN ('landmark_hour', 'landmark_hour_sq') GROUP BY feature)",
                "top AS (SELECT feature, row_number() OVER (ORDER BY s DESC, feature) AS r FROM vr WHERE s IS NOT NULL "
                "QUALIFY r <= 12)",
                "ia AS (SELECT * FROM imp UNION ALL SELECT i.stay_id, i.t_end, i.split, i.feature || '_x_landmark', "
                "10000 + top.r, i.v * h.v FROM imp i JOIN top USING (feature) JOIN imp h ON h.stay_id = i.stay_id "
                "AND h.t_end = i.t_end AND h.feature = 'landmark_hour')"]
        last = "ia"
    if text:
        out += [f"tk AS (SELECT stay_id, t_end, split, {_TOK.format(t='final_text')} AS tok FROM mt)",
                f"tt AS (SELECT stay_id, t_end, split, unnest({_terms_sql('tok')}) AS term FROM tk)",
                "tc AS (SELECT stay_id, t_end, split, term, count(*) AS tf FROM tt GROUP BY ALL)",
                "tv AS (SELECT term, ln((1 + (SELECT count(*) FROM mt WHERE split = 'train')) / (1 + count(*))) + 1 AS idf "
                "FROM tc WHERE split = 'train' GROUP BY term HAVING count(*) >= 5 ORDER BY sum(tf) DESC, term LIMIT 300)",
                "tw AS (SELECT stay_id, t_end, term, tf * idf AS w FROM tc JOIN tv USING (term))",
                "tn AS (SELECT stay_id, t_end, sqrt(sum(w * w)) AS n FROM tw GROUP BY ALL)",
                "te AS (SELECT mt.stay_id, mt.t_end, mt.split, 'tfidf_' || tv.term AS feature, "
                "1000 + row_number() OVER (PARTITION BY mt.stay_id, mt.t_end ORDER BY tv.term) AS ord, "
                "coalesce(tw.w / tn.n, 0) AS v FROM mt JOIN tv ON TRUE "
                "LEFT JOIN tw ON tw.stay_id = mt.stay_id AND tw.t_end = mt.t_end AND tw.term = tv.term "
                "LEFT JOIN tn ON tn.stay_id = mt.stay_id AND tn.t_end = mt.t_end)",
                "wt AS (SELECT * FROM imp UNION ALL SELECT * FROM te)"]
        last = "wt"
    if scale:
        out += [f"sp AS (SELECT feature, avg(v) AS m, stddev_pop(v) AS s FROM {last} WHERE split = 'train' GROUP BY feature)",
                f"sc AS (SELECT stay_id, t_end, split, feature, ord, (v - m) / CASE WHEN s = 0 THEN 1 ELSE s END AS v "
                f"FROM {last} JOIN sp USING (feature))"]
        last = "sc"
    out += [f"trn AS (SELECT * FROM {last} WHERE split = 'train')",
            "dr AS (SELECT DISTINCT b.feature FROM trn a JOIN trn b ON a.stay_id = b.stay_id AND a.t_end = b.t_end "
            "AND a.ord < b.ord GROUP BY a.feature, b.feature HAVING stddev_pop(a.v) > 0 AND stddev_pop(b.v) > 0 "
            "AND abs(corr(a.v, b.v)) > 0.95)",
            f"fin AS (SELECT * FROM {last} WHERE feature NOT IN (SELECT feature FROM dr))"]
    return ",\n".join(out)


_LANDMARK_SRC = "(SELECT *, t_end AS landmark_hour, t_end * t_end AS landmark_hour_sq FROM lmk)"
_BASE = _matrix_ctes("master_tr", [*TR_FEATS, "has_text", "age"], "_is_measured", ("has_text",), scale=True, text=True)

QUERIES.update({
    "cumulative_matrix": "WITH " + _matrix_ctes("master_cum", [*CUM_FEATS, "age"], "_measured_frac")
                         + f" SELECT stay_id, t_end, split, feature, {_TIDY} FROM fin",
    "landmark_matrix": "WITH " + _matrix_ctes(_LANDMARK_SRC, [*CUM_FEATS, "age", "landmark_hour", "landmark_hour_sq"],
                                              "_measured_frac", scale=True, interactions=True)
                       + f" SELECT stay_id, t_end, split, feature, {_TIDY} FROM fin",
    "base_matrix": f"WITH {_BASE} SELECT stay_id, t_end, split, feature, {_TIDY} FROM fin WHERE NOT prefix(feature, 'tfidf_')",
    "base_matrix_text": f"WITH {_BASE} SELECT split, feature, count(*) AS n, round(avg(v), 6) AS mean_value, "
                        "round(max(v), 6) AS max_value, round(avg(v * v), 6) AS mean_square "
                        "FROM fin WHERE prefix(feature, 'tfidf_') GROUP BY split, feature",
})


def _tensor_dataset_sql() -> str:
    bins = ", ".join(
        f"CASE WHEN rem > {lo} AND rem <= {lo + 24} THEN CASE event_type WHEN 'discharge' THEN 1 ELSE 2 END ELSE 0 END "
        f"AS surv_label_bin{i + 1}" for i, lo in enumerate((0, 24, 48)))
    stats = ", ".join(f"coalesce(avg({v}), 0.0) AS m_{v}, CASE WHEN stddev_pop({v}) > 1e-6 THEN stddev_pop({v}) ELSE 1.0 END AS s_{v}"
                      for v in VARS)
    weighted = ", ".join(f"round(sum(coalesce((h.{v} - m_{v}) / s_{v}, 0.0) * (p.pos + 1)), 4) AS {v}_weighted" for v in VARS)
    return f"""WITH mt AS (SELECT m.*, e.event_type, e.event_hour - m.t_end AS rem, {_split_expr('m.subject_id')} AS split,
                    {_TOK.format(t='m.final_text')} AS tok
             FROM master_tr m JOIN events_ct e ON e.stay_id = m.stay_id AND e.subject_id = m.subject_id
             WHERE e.event_hour IS NOT NULL),
  pos AS (SELECT unnest(range(0, 24)) AS pos),
  tn AS (SELECT {stats} FROM mt, pos p LEFT JOIN hourly_f h
         ON h.stay_id = mt.stay_id AND h.hour = CAST(floor(mt.t_end) AS INTEGER) - 23 + p.pos WHERE mt.split = 'train'),
  tw AS (SELECT mt.stay_id, mt.t_end, {weighted} FROM mt, tn, pos p LEFT JOIN hourly_f h
         ON h.stay_id = mt.stay_id AND h.hour = CAST(floor(mt.t_end) AS INTEGER) - 23 + p.pos GROUP BY ALL),
  ag AS (SELECT quantile_cont(age, 0.5) AS med FROM mt WHERE split = 'train'),
  sa AS (SELECT avg(coalesce(age, med)) AS m, CASE WHEN stddev_pop(coalesce(age, med)) = 0 THEN 1 ELSE stddev_pop(coalesce(age, med)) END AS s
         FROM mt, ag WHERE split = 'train'),
  voc AS (SELECT w, CAST(row_number() OVER (ORDER BY c DESC, w) + 1 AS INTEGER) AS id
          FROM (SELECT unnest(tok) AS w, count(*) AS c FROM mt WHERE split = 'train' GROUP BY 1)),
  ex AS (SELECT stay_id, t_end, unnest(tok[1:128]) AS w, unnest(range(0, len(tok[1:128]))) AS pos FROM mt),
  enc AS (SELECT stay_id, t_end, list(coalesce(voc.id, 1) ORDER BY ex.pos) AS ids FROM ex LEFT JOIN voc USING (w) GROUP BY ALL)
  SELECT mt.stay_id, mt.t_end, split, label_can_discharge_24h, label_no_return_72h, task2_mask, {bins},
         {', '.join(f'{v}_weighted' for v in VARS)}, round((coalesce(age, med) - sa.m) / sa.s, 6) AS static_age, 1 AS n_static,
         array_to_string(list_concat(coalesce(enc.ids, []::INTEGER[]),
             list_transform(range(128 - len(coalesce(enc.ids, []::INTEGER[]))), lambda x: 0)), ' ') AS input_ids,
         CAST(len(coalesce(enc.ids, []::INTEGER[])) AS INTEGER) AS attention_len
  FROM mt JOIN tw USING (stay_id, t_end) CROSS JOIN ag CROSS JOIN sa LEFT JOIN enc USING (stay_id, t_end)"""


QUERIES["tensor_dataset"] = _tensor_dataset_sql()
