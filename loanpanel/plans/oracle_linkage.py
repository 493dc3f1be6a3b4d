"""The linkage in SQL: a recursive query walks the loans of every municipality
and lender in order and carries the reports claimed so far in a list."""

from __future__ import annotations

from .oracle import CLOSE, LINK_ROWS, ORACLE, ORDER_PAIRS, SAME_GROUP

_STORE = "pairs AS" + ORDER_PAIRS.split(", pairs AS", 1)[1].split("), queue AS", 1)[0] + ")"


def _pass(y: int, dry: bool = False) -> str:
    """CTEs of the loans of year ``y`` among the reports of the next one; reads
    state_y, defines fold_y and the next state, which a dry run leaves as it is
    filed."""
    z = y + 1
    kept = " AND false" if dry else ""
    return f"""
loans_{y} AS MATERIALIZED (
  SELECT *, row_number() OVER (PARTITION BY muni_id, lender_ico ORDER BY pos) AS rn FROM (
    SELECT *, count(*) OVER (PARTITION BY muni_id, lender_ico, start_date) AS n FROM state_{y}
  ) WHERE expected AND muni_id IS NOT NULL AND lender_ico IS NOT NULL
), reports_{z} AS MATERIALIZED (
  SELECT *, count(*) OVER (PARTITION BY muni_id, lender_ico, start_date) AS n FROM link_rows WHERE year = {z}
), signals_{y} AS MATERIALIZED (
  SELECT l.pos, c.pos AS c_pos, coalesce({CLOSE.format('l.amount', 'c.amount')}, false) AS amt, d.decision,
         coalesce(date_diff('day', l.mat_date, c.mat_date), 0) AS days,
         levenshtein(l.dates, c.dates) AS dist,
         CASE WHEN coalesce(l.start_date = c.start_date, false) THEN
                CASE WHEN l.n > 1 OR c.n > 1 THEN 'Collision: Multiple loans share this start date.'
                     WHEN days <> 0 AND abs(days) < 30 THEN 'Small duration change (' || days || ' days). Possible typo.'
                     WHEN l.mark = 'Extended' AND days < 0 OR l.mark = 'Shortened' AND days > 0 THEN
                       CASE WHEN dist <= 2 THEN 'Odd Pattern (Was ' || l.mark || ', now '
                         || CASE WHEN days > 0 THEN 'Extended' ELSE 'Shortened' END || ') + Fuzzy Typo Match.' END
                     WHEN days <> 0 THEN 'auto' END
              WHEN dist <= 2 THEN 'Fuzzy Typo Match (Dist: ' || dist || '). Different start dates.' END AS signal
  FROM loans_{y} l JOIN reports_{z} c ON {SAME_GROUP}
  LEFT JOIN latest d ON d.y1_composite_id = l.composite_id AND d.y2_composite_id = c.composite_id
), turns_{y} AS MATERIALIZED (
  SELECT l.muni_id, l.lender_ico, l.rn, l.pos, coalesce(s.cands, []) AS cands
  FROM loans_{y} l LEFT JOIN (
    SELECT pos, list({{'c': c_pos, 'amt': amt, 's': signal, 'd': decision}} ORDER BY c_pos) AS cands
    FROM signals_{y} GROUP BY pos) s ON s.pos = l.pos
), fold_{y} AS (
  SELECT muni_id, lender_ico, CAST(0 AS BIGINT) AS rn, CAST([] AS BIGINT[]) AS claimed, CAST(NULL AS BIGINT) AS pos,
         CAST(NULL AS BIGINT) AS c_pos, CAST(NULL AS VARCHAR) AS outcome,
         CAST([] AS BIGINT[]) AS asked, 0::BIGINT AS answered, false AS alone
  FROM loans_{y} WHERE rn = 1
  UNION ALL
  SELECT muni_id, lender_ico, rn, CASE WHEN choice IS NULL THEN claimed ELSE list_append(claimed, choice) END,
         pos, choice,
         CASE WHEN sole THEN 'amount' WHEN take.s = 'auto' THEN 'dates' WHEN take IS NOT NULL THEN 'decision'
              WHEN len(asked) > 0 THEN 'pending' ELSE 'early' END,
         list_transform(asked, lambda x: x.c),
         CASE WHEN sole THEN 0 ELSE len(list_filter(free,
           lambda x: x.s <> 'auto' AND x.d IS NOT NULL AND (take IS NULL OR x.c <= take.c))) END,
         len(free) = 0
  FROM (
    SELECT *, CASE WHEN sole THEN same[1].c ELSE take.c END AS choice,
           CASE WHEN sole THEN [] ELSE list_filter(free,
             lambda x: x.s <> 'auto' AND x.d IS NULL AND (take IS NULL OR x.c < take.c)) END AS asked
    FROM (
      SELECT *, len(same) = 1 AS sole,
             list_filter(free, lambda x: x.s = 'auto' OR x.s IS NOT NULL AND x.d = 'Y')[1] AS take
      FROM (
        SELECT *, list_filter(free, lambda x: x.amt) AS same
        FROM (
          SELECT t.muni_id, t.lender_ico, t.rn, t.pos, f.claimed,
                 list_filter(t.cands, lambda x: NOT list_contains(f.claimed, x.c)) AS free
          FROM fold_{y} f JOIN turns_{y} t
            ON t.muni_id = f.muni_id AND t.lender_ico = f.lender_ico AND t.rn = f.rn + 1
        )
      )
    )
  )
), result_{y} AS MATERIALIZED (
  SELECT f.pos, f.c_pos, f.outcome, f.asked, f.answered, f.alone,
         CASE WHEN f.c_pos IS NOT NULL THEN s.days END AS days
  FROM fold_{y} f LEFT JOIN signals_{y} s ON s.pos = f.pos AND s.c_pos = f.c_pos WHERE f.pos IS NOT NULL
  UNION ALL
  SELECT pos, NULL, 'early', [], 0, true, NULL FROM state_{y}
  WHERE expected AND (muni_id IS NULL OR lender_ico IS NULL)
), state_{z} AS MATERIALIZED (
  SELECT c.* REPLACE (
           coalesce(l.id, c.id) AS id,
           CASE WHEN l.id IS NULL THEN c.start_date ELSE l.start_date END AS start_date,
           CASE WHEN l.id IS NULL THEN c.mat_date ELSE l.mat_date END AS mat_date,
           coalesce(l.dates, c.dates) AS dates),
         CASE WHEN r.days > 0 THEN 'Extended' WHEN r.days < 0 THEN 'Shortened' ELSE '' END AS mark,
         l.id IS NOT NULL AS claimed
  FROM link_rows c LEFT JOIN (SELECT * FROM result_{y} WHERE c_pos IS NOT NULL{kept}) r ON r.c_pos = c.pos
  LEFT JOIN state_{y} l ON l.pos = r.pos WHERE c.year = {z}
)"""


def _passes(dry: bool = False) -> str:
    return f"""{LINK_ROWS}, {_STORE}, state_2021 AS MATERIALIZED (
  SELECT *, '' AS mark, false AS claimed FROM link_rows WHERE year = 2021
), {_pass(2021, dry)}, {_pass(2022, dry)}, {_pass(2023, dry)}, results AS MATERIALIZED (
  SELECT 2021 AS year, * FROM result_2021 UNION ALL SELECT 2022, * FROM result_2022
  UNION ALL SELECT 2023, * FROM result_2023
)"""


LINKED = f"""{_passes()}, states AS MATERIALIZED (
  SELECT s.*, r.outcome, r.c_pos, r.days FROM (
    SELECT * FROM state_2021 UNION ALL SELECT * FROM state_2022
    UNION ALL SELECT * FROM state_2023 UNION ALL SELECT * FROM state_2024
  ) s LEFT JOIN results r ON r.year = s.year AND r.pos = s.pos
), gap_turns AS MATERIALIZED (
  SELECT l.muni_id, l.lender_ico, l.year, l.pos, l.id,
         row_number() OVER (PARTITION BY l.muni_id, l.lender_ico ORDER BY l.year, l.pos) AS rn, coalesce(g.cands, []) AS cands
  FROM states l LEFT JOIN (
    SELECT l.year, l.pos, list({{'y': c.year, 'c': c.pos, 'd': d.decision}} ORDER BY c.year, c.pos) AS cands
    FROM states l JOIN states c ON c.year > l.year + 1 AND NOT c.claimed AND {SAME_GROUP}
      AND {CLOSE.format('l.amount', 'c.amount')}
    LEFT JOIN latest d ON d.y1_composite_id = l.composite_id AND d.y2_composite_id = c.composite_id
    WHERE l.outcome = 'early' GROUP BY l.year, l.pos
  ) g ON g.year = l.year AND g.pos = l.pos
  WHERE l.outcome = 'early' AND l.muni_id IS NOT NULL AND l.lender_ico IS NOT NULL
), gap_fold AS (
  SELECT muni_id, lender_ico, CAST(0 AS BIGINT) AS rn,
         CAST([] AS STRUCT(y INTEGER, c BIGINT, id VARCHAR, mark VARCHAR)[]) AS links,
         NULL::INTEGER AS year, NULL::BIGINT AS pos, NULL::INTEGER AS stop, NULL::BIGINT AS c_pos,
         NULL::VARCHAR AS id, NULL::VARCHAR AS prev, CAST([] AS BIGINT[]) AS asked
  FROM gap_turns WHERE rn = 1
  UNION ALL
  SELECT muni_id, lender_ico, rn,
         CASE WHEN yes IS NULL THEN links ELSE list_append(links,
           {{'y': stop, 'c': yes.c, 'id': id, 'mark': 'Reporting Gap (' || (stop - year - 1) || 'y)'}}) END,
         year, pos, stop, yes.c, id, prev,
         list_transform(list_filter(here, lambda x: x.d IS NULL AND (yes IS NULL OR x.c < yes.c)), lambda x: x.c)
  FROM (
    SELECT *, list_filter(here, lambda x: x.d = 'Y')[1] AS yes FROM (
      SELECT *, list_filter(free, lambda x: x.y = stop) AS here FROM (
        SELECT *, list_min(list_transform(
                 list_filter(free, lambda x: x.d IS NULL OR x.d = 'Y'), lambda x: x.y)) AS stop
        FROM (
          SELECT t.muni_id, t.lender_ico, t.rn, t.year, t.pos, f.links,
                 coalesce(list_filter(f.links, lambda x: x.y = t.year AND x.c = t.pos)[1].id, t.id) AS id,
                 coalesce(list_filter(f.links, lambda x: x.y = t.year AND x.c = t.pos)[1].mark, 'Repaid Early') AS prev,
                 list_filter(t.cands, lambda x: NOT list_contains(
                   list_transform(f.links, lambda z: z.y::BIGINT * 1000000000 + z.c), x.y::BIGINT * 1000000000 + x.c)) AS free
          FROM gap_fold f JOIN gap_turns t
            ON t.muni_id = f.muni_id AND t.lender_ico = f.lender_ico AND t.rn = f.rn + 1
        )
      )
    )
  )
), gaps AS MATERIALIZED (SELECT * FROM gap_fold WHERE pos IS NOT NULL
), final AS MATERIALIZED (
  SELECT s.year, s.pos, s.composite_id, coalesce(t.id, s.id) AS id, s.dedup_suffix,
         CASE WHEN g.stop IS NOT NULL THEN CASE WHEN g.c_pos IS NULL THEN 'PENDING_REVIEW' ELSE '' END
              WHEN t.id IS NOT NULL THEN 'Reporting Gap (' || (s.year - t.year - 1) || 'y)'
              WHEN s.outcome = 'pending' THEN 'PENDING_REVIEW' WHEN s.outcome = 'early' THEN 'Repaid Early'
              ELSE s.mark END AS yoy_change,
         s.outcome = 'early' AND g.stop IS NULL AS early, s.id AS pair_id
  FROM states s LEFT JOIN gaps g ON g.year = s.year AND g.pos = s.pos
  LEFT JOIN (SELECT * FROM gaps WHERE c_pos IS NOT NULL) t ON t.stop = s.year AND t.c_pos = s.pos
)"""


def over_linked(body: str) -> str:
    return f"WITH RECURSIVE {LINKED}\n{body}"


MOVE = "CASE WHEN days > 0 THEN 'Extended' WHEN days < 0 THEN 'Shortened' ELSE 'No date change' END"
ORACLE["link_outcome"] = over_linked(f"""
SELECT year, year + 1 AS next_year, pos, composite_id, outcome, c_pos, days,
       CASE outcome WHEN 'amount' THEN 'Auto-matched by unique Sjednaná výše match. ' || {MOVE} || ' by ' || abs(days) || ' days.'
            WHEN 'dates' THEN 'Auto-Matched 1:1. ' || {MOVE} || ' by ' || abs(days) || ' days.' END AS reason
FROM states WHERE outcome IS NOT NULL""")
ORACLE["linked_panel"] = over_linked("SELECT year, pos, composite_id, id, dedup_suffix, yoy_change FROM final")
ORACLE["early_payoffs"] = over_linked(
    "SELECT year, pos, composite_id, pair_id AS id, 'Repaid Early' AS yoy_change FROM final WHERE early"
)
STATS = """
SELECT year, year + 1 AS next_year, 'missing_loans' AS kind, count(*) AS n FROM results GROUP BY year
UNION ALL SELECT year, year + 1, 'outcome_' || outcome, count(*) FROM results GROUP BY year, outcome
UNION ALL SELECT year, year + 1, 'no_candidates', count(*) FROM results WHERE alone AND c_pos IS NULL GROUP BY year
UNION ALL SELECT year, year + 1, 'pairs_to_review', CAST(sum(len(asked)) AS BIGINT) FROM results GROUP BY year HAVING sum(len(asked)) > 0
UNION ALL SELECT year, year + 1, 'pairs_decided', CAST(sum(answered) AS BIGINT) FROM results GROUP BY year HAVING sum(answered) > 0"""
ORACLE["link_stats"] = over_linked(STATS)
ORACLE["link_dry_run"] = f"WITH RECURSIVE {_passes(dry=True)}\n{STATS}"
ORACLE["review_reason_counts"] = f"""WITH RECURSIVE {_passes(dry=True)}
SELECT CASE WHEN starts_with(signal, 'Collision') THEN 'Collision (multiple loans share start date)'
            WHEN starts_with(signal, 'Small') THEN 'Small duration change (<30 days, possible typo)'
            WHEN starts_with(signal, 'Odd') THEN 'Odd bounce pattern (Extended<->Shortened) + fuzzy match'
            ELSE 'Fuzzy typo match, different start dates' END AS kind, count(*) AS n
FROM (SELECT year, pos, unnest(asked) AS c_pos FROM results) q JOIN (
  SELECT 2021 AS year, pos, c_pos, signal FROM signals_2021 UNION ALL SELECT 2022, pos, c_pos, signal FROM signals_2022
  UNION ALL SELECT 2023, pos, c_pos, signal FROM signals_2023
) g ON g.year = q.year AND g.pos = q.pos AND g.c_pos = q.c_pos
GROUP BY 1"""
ORACLE["review_queue"] = over_linked(f"""
, asked AS (
  SELECT r.year, r.pos, r.year + 1 AS year_y2, unnest(r.asked) AS c_pos, 0 AS skipped_years,
         s.dates AS y1_id_dates, s.mark AS prev_yoy
  FROM results r JOIN states s ON s.year = r.year AND s.pos = r.pos
  UNION ALL
  SELECT year, pos, stop, unnest(asked), stop - year - 1,
         split_part(id, '-', 3) || '-' || split_part(id, '-', 4), prev FROM gaps
), signals AS (
  SELECT 2021 AS year, * FROM signals_2021 UNION ALL SELECT 2022, * FROM signals_2022
  UNION ALL SELECT 2023, * FROM signals_2023
)
SELECT l.muni_id || '_' || l.lender_ico || '_' || coalesce(strftime(st.start_date, '%Y-%m-%d'), 'NaT') || '__' || q.year_y2 AS group_id,
       q.year AS year_y1, q.year_y2, q.skipped_years, l.composite_id AS y1_composite_id,
       c.composite_id AS y2_composite_id, l.muni_id, l.lender_name, l.lender_ico, q.y1_id_dates,
       c.dates AS y2_id_dates, l.agreed_amount AS y1_agreed, c.agreed_amount AS y2_agreed,
       round_even(abs(l.amount - c.amount) / greatest(abs(l.amount), abs(c.amount), 1e-9) * 100, 3) AS amount_diff_pct,
       l.drawn_amount AS y1_drawn, c.drawn_amount AS y2_drawn, l.purpose AS y1_purpose, c.purpose AS y2_purpose,
       q.prev_yoy,
       CASE WHEN q.skipped_years > 0 THEN 'Reporting-gap candidate (' || q.skipped_years || ' year(s) skipped).'
            ELSE g.signal END AS reason, '' AS decision
FROM asked q JOIN link_rows l ON l.year = q.year AND l.pos = q.pos
JOIN states st ON st.year = q.year AND st.pos = q.pos
JOIN link_rows c ON c.year = q.year_y2 AND c.pos = q.c_pos
LEFT JOIN signals g ON g.year = q.year AND g.pos = q.pos AND g.c_pos = q.c_pos""")
