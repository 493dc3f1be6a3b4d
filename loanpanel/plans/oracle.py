"""The registered queries in SQL, written independently for comparison."""

from __future__ import annotations

from .sample_panel import PANEL_SQL

ORACLE: dict[str, str] = {}

NUMBER_RE = r"^[+-]?([0-9]+([.][0-9]*)?|[.][0-9]+)([eE][+-]?[0-9]+)?$"


def zfill(expr: str) -> str:
    return f"(CASE WHEN length({expr}) < 8 THEN lpad({expr}, 8, '0') ELSE {expr} END)"


def pad(col: str) -> str:
    return zfill(f"coalesce(regexp_replace(trim({col}), '\\.0$', ''), '0')")


def money(col: str) -> str:
    plain = f"replace(replace({col}, ' ', ''), ',', '.')"
    return f"(CASE WHEN regexp_matches({plain}, '{NUMBER_RE}') THEN TRY_CAST({plain} AS DOUBLE) END)"


def hash8(col: str) -> str:
    return f"substr(md5(lower(trim(coalesce({col}, 'nan')))), 1, 8)"


LOAN_ID = (
    f"{pad('borrower_ico')} || '-' || {pad('lender_ico')} || '-' || coalesce(trim(signed_on), 'nan')"
    f" || '-' || coalesce(trim(matures_on), 'nan') || '-' ||"
    f" CAST(CAST(trunc(coalesce({money('agreed_amount')}, 0)) AS BIGINT) AS VARCHAR)"
)

IDENTIFIED = f"""{PANEL_SQL}, keyed AS (
  SELECT *, {LOAN_ID} AS id,
         coalesce({money('agreed_amount')}, 0) AS agreed,
         coalesce({money('drawn_amount')}, 0) AS drawn
  FROM panel
), counted AS (
  SELECT *, count(*) OVER (PARTITION BY source_file, id) > 1 AS dup FROM keyed
), identified AS (
  SELECT *, CASE WHEN dup THEN {hash8('lender_name')} || '-' || {hash8('purpose')} END AS dedup_suffix,
         id || CASE WHEN dup THEN '-' || {hash8('lender_name')} || '-' || {hash8('purpose')} ELSE '' END
            || '-' || year AS composite_id,
         CASE WHEN agreed = 0 THEN 'ZERO_LOAN' WHEN dup THEN 'DEDUP_POPULATED'
              WHEN id IN (SELECT id FROM counted WHERE dup AND agreed <> 0) THEN 'CROSS_REMOVED' END AS reason
  FROM counted
)"""


def over_panel(body: str) -> str:
    return f"WITH {PANEL_SQL}\n{body}"


def over_identified(body: str) -> str:
    return f"WITH {IDENTIFIED}\n{body}"


ORACLE["pad_id"] = over_panel(f"""SELECT year, pos, {pad('borrower_ico')} AS borrower, {pad('lender_ico')} AS lender,
  {zfill("split_part(trim(lender_ico), '.', 1)")} AS registry_key FROM panel""")

ORACLE["parse_money"] = over_panel(f"""SELECT year, pos, {money('agreed_amount')} AS agreed,
  coalesce({money('agreed_amount')}, 0) AS agreed_or_zero, {money('drawn_amount')} AS drawn FROM panel""")

ORACLE["dedup_suffix"] = over_panel(
    f"SELECT year, pos, {hash8('lender_name')} || '-' || {hash8('purpose')} AS suffix FROM panel"
)

ORACLE["loan_id"] = over_panel(f"SELECT year, pos, {LOAN_ID} AS id FROM panel")

ORACLE["duplicate_flag"] = over_identified("SELECT year, pos, dup AS is_duplicate FROM identified")

ORACLE["exclusion_reason"] = over_identified(
    "SELECT year, pos, id, dedup_suffix, composite_id, reason FROM identified"
)

ORACLE["cross_removed"] = over_identified(
    "SELECT year, pos, id FROM identified WHERE reason = 'CROSS_REMOVED'"
)

ORACLE["loss_report"] = over_identified("""
SELECT *, CASE WHEN n_rows > 0 THEN (n_dedup + n_cross) / n_rows * 100 ELSE 0 END AS pct_rows,
       CASE WHEN agreed_total > 0 THEN agreed_lost / agreed_total * 100 ELSE 0 END AS pct_agreed,
       CASE WHEN drawn_total > 0 THEN drawn_lost / drawn_total * 100 ELSE 0 END AS pct_drawn
FROM (
  SELECT source_file, year, count(*) AS n_rows, count(DISTINCT id) AS n_ids,
         count(*) FILTER (reason = 'DEDUP_POPULATED') AS n_dedup,
         count(*) FILTER (reason = 'ZERO_LOAN') AS n_zero,
         count(*) FILTER (reason = 'CROSS_REMOVED') AS n_cross,
         count(reason) AS n_excluded, sum(agreed) AS agreed_total, sum(drawn) AS drawn_total,
         coalesce(sum(agreed) FILTER (reason <> 'ZERO_LOAN'), 0) AS agreed_lost,
         coalesce(sum(drawn) FILTER (reason <> 'ZERO_LOAN'), 0) AS drawn_lost
  FROM identified GROUP BY source_file, year
)""")

ORACLE["amount_histogram"] = over_identified("""
, bins(bin_no, bin, low, high) AS (VALUES
  (0, '0-100k', 0, 1e5), (1, '100-200k', 1e5, 2e5), (2, '200-300k', 2e5, 3e5), (3, '300-400k', 3e5, 4e5),
  (4, '400-500k', 4e5, 5e5), (5, '500-600k', 5e5, 6e5), (6, '600k+', 6e5, 'infinity'::DOUBLE)
), lost AS (SELECT * FROM identified WHERE reason <> 'ZERO_LOAN'
), counts AS (
  SELECT f.source_file, f.year, b.bin_no, b.bin, count(l.id) AS n
  FROM (SELECT DISTINCT source_file, year FROM lost) f CROSS JOIN bins b
  LEFT JOIN lost l ON l.source_file = f.source_file AND l.agreed >= b.low AND l.agreed < b.high
  GROUP BY ALL
)
SELECT source_file, year, bin_no, bin, n,
       repeat('█', CAST(floor(n / max(n) OVER (PARTITION BY source_file) * 30) AS INTEGER)) AS bar
FROM counts""")

ORACLE["control_total"] = over_panel("""
SELECT source_file, year, count(*) FILTER (statement <> 'ZZZ') AS n_rows,
       max(CASE WHEN statement = 'ZZZ' THEN CAST(paid_interest AS BIGINT) END) AS n_stated,
       count(*) FILTER (statement <> 'ZZZ') = max(CASE WHEN statement = 'ZZZ' THEN CAST(paid_interest AS BIGINT) END)
         AS complete
FROM panel GROUP BY source_file, year""")

REGISTRY = """registry AS (
  SELECT CAST(CASE WHEN s_acctbal >= 0 THEN 45000000 ELSE 85000000 END + s_suppkey * 1001 AS VARCHAR) AS ico, s_name AS name,
         ['121', '112', '801', '381', '999', NULL][s_nationkey % 6 + 1] AS form_code
  FROM supplier
), codelist AS (
  SELECT code, arg_max(official, n_nationkey) AS official, arg_max(form_group, n_nationkey) AS form_group
  FROM (SELECT n_nationkey, ['121', '112', '801', '381', '331'][n_nationkey % 5 + 1] AS code,
               n_name AS official, 'group ' || n_regionkey AS form_group FROM nation)
  GROUP BY code
)"""

ABBR = """CASE {0} WHEN '101' THEN 'f.o.' WHEN '102' THEN 'f.o.' WHEN '111' THEN 'v.o.s.' WHEN '112' THEN 's.r.o.'
 WHEN '121' THEN 'a.s.' WHEN '205' THEN 'družstvo' WHEN '331' THEN 'p.o.' WHEN '332' THEN 'státní p.o.'
 WHEN '706' THEN 'z.s.' WHEN '771' THEN 's.o.' WHEN '801' THEN 'obec' WHEN '804' THEN 'kraj'
 WHEN '811' THEN 'MČ / MO' ELSE 'jiná' END"""

ENRICHED = f"""{PANEL_SQL}, {REGISTRY}, lenders AS (
  SELECT i.lender_ico,
         CASE WHEN length(k) <> 8 OR k = '00000000' THEN 'Invalid ICO'
              WHEN r.ico IS NULL THEN 'Not Found' ELSE r.name END AS registry_name,
         CASE WHEN length(k) = 8 AND k <> '00000000' THEN coalesce(r.form_code, '') ELSE '' END AS form_code
  FROM (SELECT lender_ico, {zfill("split_part(trim(lender_ico), '.', 1)")} AS k
        FROM panel WHERE lender_ico IS NOT NULL GROUP BY lender_ico) i
  LEFT JOIN registry r ON r.ico = k
), forms AS (
  SELECT l.*, CASE WHEN form_code = '' THEN 'N/A' ELSE coalesce(c.official, 'Neznámá forma') END AS form_official,
         CASE WHEN form_code = '' THEN 'N/A' ELSE coalesce(c.form_group, 'Neznámá klasifikace') END AS form_group,
         CASE WHEN form_code = '' THEN 'N/A' ELSE {ABBR.format('form_code')} END AS form_abbr
  FROM lenders l LEFT JOIN codelist c ON c.code = l.form_code
), enriched AS (
  SELECT p.*, f.* EXCLUDE (lender_ico) FROM panel p LEFT JOIN forms f ON f.lender_ico = p.lender_ico
), missing AS (
  SELECT DISTINCT source_file, lender_ico AS missing_ico, registry_name AS status
  FROM enriched WHERE registry_name IN ('Not Found', 'Invalid ICO', 'Connection Error')
), reference AS (
  SELECT source_file, lender_ico AS ico, lender_name AS name, min(pos) AS pos FROM panel
  WHERE lender_ico IS NOT NULL AND lender_name IS NOT NULL GROUP BY ALL
)"""

ORACLE["codelist_lookup"] = f"WITH {REGISTRY} SELECT * FROM codelist"
ORACLE["form_abbr"] = (
    f"WITH {REGISTRY} SELECT ico, form_code,"
    f" CASE WHEN form_code IS NULL THEN 'N/A' ELSE {ABBR.format('form_code')} END AS form_abbr FROM registry"
)
ORACLE["registry_status"] = f"WITH {ENRICHED} SELECT * FROM lenders"
ORACLE["enrich"] = f"""WITH {ENRICHED}
SELECT year, pos, lender_ico, registry_name, form_code, form_official, form_group, form_abbr FROM enriched"""
ORACLE["missing_ids"] = f"WITH {ENRICHED} SELECT * FROM missing"
ORACLE["typo_reference"] = f"WITH {ENRICHED} SELECT * FROM reference"


def typo_sql(distance: int) -> str:
    return f"""WITH {ENRICHED}
SELECT m.source_file, m.missing_ico, r.ico, r.name, r.pos FROM missing m
LEFT JOIN reference r ON r.source_file = m.source_file AND levenshtein(m.missing_ico, r.ico) <= {distance}"""


ORACLE["typo_candidates"] = typo_sql(1)
ORACLE["typo_candidates_2"] = typo_sql(2)
ORACLE["typo_wide"] = f"""WITH c AS ({typo_sql(1)}), p AS (
  SELECT *, row_number() OVER (PARTITION BY source_file, missing_ico ORDER BY pos, ico, name) - 1 AS place,
         count(ico) OVER (PARTITION BY source_file, missing_ico) AS n_matches
  FROM c
) SELECT source_file, missing_ico, n_matches, CAST(place // 20 AS INTEGER) AS page, {", ".join(
    f"coalesce(max(CASE WHEN place % 20 = {i} THEN {part} END), '') AS found_{part}_{i + 1}"
    for i in range(20) for part in ("ico", "name")
)} FROM p GROUP BY ALL"""

NO_PA = "regexp_replace(rate_text, 'p\\.?\\s*a\\.?', '', 'gi')"
RATE_TEXT = f"trim(replace(replace(trim({NO_PA}), ',', '.'), '%', ''))"
RATE_SQL = f"""
  CASE WHEN regexp_matches({RATE_TEXT}, '{NUMBER_RE}') THEN TRY_CAST({RATE_TEXT} AS DOUBLE) END AS number,
  CASE WHEN NOT regexp_matches({RATE_TEXT}, '{NUMBER_RE}') THEN lower(trim(rate_text)) END AS words,
  coalesce(regexp_matches({NO_PA}, '[^0-9,. %+-]'), false) AS has_words"""

ORACLE["rate_classify"] = over_panel(f"SELECT year, pos, rate_text, {RATE_SQL} FROM panel")

RATE_PANEL = f"""{IDENTIFIED}, rated AS (
  SELECT id, year, drawn_amount, rate_text, purpose, {RATE_SQL}
  FROM identified WHERE reason IS NULL
), joined AS (
  SELECT coalesce(a.id, b.id, c.id) AS id,
         a.year AS y1, b.year AS y2, c.year AS y3,
         a.drawn_amount AS drawn_2022, b.drawn_amount AS drawn_2023, c.drawn_amount AS drawn_2024,
         a.rate_text AS rate_2022, b.rate_text AS rate_2023, c.rate_text AS rate_2024,
         a.purpose AS purpose_2022, b.purpose AS purpose_2023, c.purpose AS purpose_2024,
         list_filter([coalesce(CAST(a.number AS VARCHAR), a.words), coalesce(CAST(b.number AS VARCHAR), b.words),
                      coalesce(CAST(c.number AS VARCHAR), c.words)], lambda x: x IS NOT NULL) AS keys,
         coalesce(a.has_words, false) OR coalesce(b.has_words, false) OR coalesce(c.has_words, false) AS words
  FROM (SELECT * FROM rated WHERE year = 2022) a
  FULL JOIN (SELECT * FROM rated WHERE year = 2023) b ON a.id = b.id
  FULL JOIN (SELECT * FROM rated WHERE year = 2024) c ON coalesce(a.id, b.id) = c.id
), rate_panel AS (
  SELECT id, drawn_2022, drawn_2023, drawn_2024, rate_2022, rate_2023, rate_2024,
         purpose_2022, purpose_2023, purpose_2024,
         concat_ws(' + ', y1, y2, y3) AS years_reported,
         CASE WHEN regexp_matches(split_part(id, '-', -1), '^[0-9]+$')
              THEN CAST(split_part(id, '-', -1) AS BIGINT) ELSE 0 END AS loan_amount,
         CASE WHEN len(list_distinct(keys)) > 1 THEN 'CHANGED' ELSE 'STABLE' END AS rate_changed,
         CASE WHEN words THEN 'HAS_STRING' ELSE 'NO_STRING' END AS has_string
  FROM joined WHERE coalesce(rate_2022, rate_2023, rate_2024) IS NOT NULL
)"""

ORACLE["rate_panel"] = f"WITH {RATE_PANEL} SELECT * FROM rate_panel"
ORACLE["rate_class_counts"] = f"""WITH {RATE_PANEL}
SELECT 'rate_changed' AS what, rate_changed AS value, count(*) AS n FROM rate_panel GROUP BY ALL
UNION ALL SELECT 'has_string', has_string, count(*) FROM rate_panel GROUP BY ALL"""
ORACLE["suffix_guard"] = over_identified(
    "SELECT source_file, count(*) AS n FROM identified WHERE dedup_suffix IS NOT NULL GROUP BY source_file"
)

DAY = """(CASE WHEN try_strptime({0}, '%Y%m%d') BETWEEN '1677-09-22' AND '2262-04-11'
  AND regexp_matches({0}, '^[0-9]{{8}}$') THEN CAST(try_strptime({0}, '%Y%m%d') AS DATE) END)"""

LINK_ROWS = f"""{IDENTIFIED}, link_rows AS (
  SELECT year, pos, composite_id, id, dedup_suffix, muni_id, lender_ico, lender_name, purpose,
         agreed_amount, drawn_amount, {money('agreed_amount')} AS amount,
         {DAY.format("split_part(id, '-', 3)")} AS start_date, {DAY.format("split_part(id, '-', 4)")} AS mat_date,
         split_part(id, '-', 3) || '-' || split_part(id, '-', 4) AS dates,
         coalesce(TRY_CAST(substr(matures_on, 1, 4) AS DOUBLE) > year AND year < 2024, false) AS expected
  FROM identified WHERE reason IS NULL
)"""

CLOSE = """(({0} = 0 AND {1} = 0) OR (greatest(abs({0}), abs({1})) > 0
  AND abs({0} - {1}) / greatest(abs({0}), abs({1})) <= 0.001))"""

SAME_GROUP = "c.muni_id = l.muni_id AND c.lender_ico = l.lender_ico"

ORACLE["period_pairs"] = over_panel(
    "SELECT * FROM (SELECT year, lead(year) OVER (ORDER BY year) AS next_year FROM (SELECT DISTINCT year FROM panel))"
    " WHERE next_year IS NOT NULL"
)
ORACLE["link_dates"] = f"WITH {LINK_ROWS} SELECT year, pos, start_date, mat_date, dates FROM link_rows"
ORACLE["expected_loans"] = f"WITH {LINK_ROWS} SELECT year, pos, composite_id FROM link_rows WHERE expected"
ORACLE["missing_next_year"] = f"""WITH {LINK_ROWS} SELECT year, pos, id FROM link_rows l
WHERE expected AND NOT EXISTS (FROM link_rows c WHERE c.year = l.year + 1 AND c.id = l.id)"""
ORACLE["link_candidates"] = f"""WITH {LINK_ROWS} SELECT l.year, l.pos, count(c.pos) AS n_candidates
FROM link_rows l LEFT JOIN link_rows c ON c.year = l.year + 1 AND {SAME_GROUP} WHERE l.expected GROUP BY ALL"""
ORACLE["collision_count"] = f"""WITH {LINK_ROWS} SELECT year, muni_id, lender_ico, start_date, count(*) AS n FROM link_rows
WHERE muni_id IS NOT NULL AND lender_ico IS NOT NULL AND start_date IS NOT NULL GROUP BY ALL"""
ORACLE["amount_matches"] = f"""WITH {LINK_ROWS}
SELECT l.year, l.muni_id, l.lender_ico, l.amount AS l_amount, c.amount AS c_amount,
       count(DISTINCT l.pos) AS n_l, count(DISTINCT c.pos) AS n_c
FROM link_rows l JOIN link_rows c ON c.year = l.year + 1 AND {SAME_GROUP} AND {CLOSE.format('l.amount', 'c.amount')}
WHERE l.expected GROUP BY ALL"""
ORACLE["unique_amount_link"] = f"""WITH {LINK_ROWS} SELECT l.year, l.pos, max(c.pos) AS c_pos
FROM link_rows l JOIN link_rows c ON c.year = l.year + 1 AND {SAME_GROUP} AND {CLOSE.format('l.amount', 'c.amount')}
WHERE l.expected GROUP BY ALL HAVING count(*) = 1"""
ORACLE["gap_candidates"] = f"""WITH {LINK_ROWS}
SELECT DISTINCT l.year, l.muni_id, l.lender_ico, l.amount AS l_amount, c.year AS gap_year, c.amount AS c_amount
FROM link_rows l JOIN link_rows c ON c.year > l.year + 1 AND {SAME_GROUP} AND {CLOSE.format('l.amount', 'c.amount')}
WHERE l.expected"""
ORACLE["link_signals"] = f"""WITH {LINK_ROWS}, starts AS (
  SELECT year, muni_id, lender_ico, start_date, count(*) AS n, max(pos) AS pos, max(mat_date) AS mat_date,
         bool_or(expected) AS missing
  FROM link_rows WHERE muni_id IS NOT NULL AND lender_ico IS NOT NULL AND start_date IS NOT NULL GROUP BY ALL
), pairs AS (
  SELECT l.year, l.muni_id, l.lender_ico, l.start_date, l.n AS n_l, c.n AS n_c, l.missing, l.pos AS lp, c.pos AS cp,
         l.n = 1 AND c.n = 1 AND l.missing AS alone, date_diff('day', l.mat_date, c.mat_date) AS days
  FROM starts l JOIN starts c ON c.year = l.year + 1 AND {SAME_GROUP} AND c.start_date = l.start_date
)
SELECT year, muni_id, lender_ico, start_date, n_l, n_c, missing,
       CASE WHEN alone THEN lp END AS l_pos, CASE WHEN alone THEN cp END AS c_pos,
       CASE WHEN NOT alone OR days = 0 THEN NULL
            WHEN abs(days) < 30 THEN 'Small duration change (' || days || ' days). Possible typo.'
            ELSE 'auto' END AS signal
FROM pairs"""

ORDER_PAIRS = f"""{IDENTIFIED}, pairs AS MATERIALIZED (
  SELECT a.pos // 2 AS k, a.year AS y1, b.year AS y2,
         a.composite_id AS y1_composite_id, b.composite_id AS y2_composite_id
  FROM identified a JOIN identified b ON a.pos // 2 = b.pos // 2 AND a.year < b.year
  WHERE a.reason IS NULL AND b.reason IS NULL
), store AS MATERIALIZED (
  SELECT y1_composite_id, y2_composite_id, CASE WHEN (k + y2) % 5 < 2 THEN 'N' ELSE 'Y' END AS decision,
         k * 20 + y2 - y1 AS seq FROM pairs WHERE k % 4 <> 3
  UNION ALL
  SELECT y1_composite_id, y2_composite_id, CASE WHEN (k + y2) % 5 = 0 THEN 'Y' ELSE 'N' END,
         k * 20 + 10 + y2 - y1 FROM pairs WHERE (k + y2) % 5 IN (0, 4) AND k % 4 <> 3
), latest AS (
  SELECT y1_composite_id, y2_composite_id, arg_max(decision, seq) AS decision FROM store GROUP BY ALL
), queue AS MATERIALIZED (
  SELECT y1_composite_id, y2_composite_id, k * 100 + (y1 - 2020) * 10 + y2 - 2020 AS queue_no,
         ['y ', 'N', 'maybe', ' n', 'Y', ''][k % 6 + 1] AS decision FROM pairs
), fresh AS (
  SELECT q.y1_composite_id, q.y2_composite_id, q.queue_no, upper(trim(q.decision)) AS decision
  FROM queue q ANTI JOIN store s ON s.y1_composite_id = q.y1_composite_id AND s.y2_composite_id = q.y2_composite_id
  WHERE upper(trim(q.decision)) IN ('Y', 'N')
)"""
ORACLE["unapplied_reviews"] = f"WITH {ORDER_PAIRS} SELECT * FROM fresh"
ORACLE["ingest_reviews"] = f"""WITH {ORDER_PAIRS}
SELECT y1_composite_id, y2_composite_id, arg_min(decision, queue_no) AS decision,
       (SELECT coalesce(max(seq), 0) FROM store) + min(queue_no) + 1 AS seq
FROM fresh GROUP BY y1_composite_id, y2_composite_id"""
ORACLE["decisions_applied"] = f"""WITH {ORDER_PAIRS}
SELECT q.y1_composite_id, q.y2_composite_id, q.queue_no, l.decision FROM queue q
LEFT JOIN latest l ON l.y1_composite_id = q.y1_composite_id AND l.y2_composite_id = q.y2_composite_id"""

ORACLE["header_normalize"] = over_panel(
    "SELECT 'loans_' || year || '012.csv' AS source_file, year,"
    " row_number() OVER (PARTITION BY year ORDER BY pos) - 1 AS pos, statement, muni_id, borrower_ico, lender_ico, lender_name, purpose, rate_text, signed_on,"
    " matures_on, agreed_amount, drawn_amount, paid_interest FROM panel"
)
