"""DuckDB SQL for every query, written the plain way: one right join per reference,
then one group-by per aggregation stage."""

from __future__ import annotations

from studies.queries import DIGITS
from viewloom.schemas import CALENDAR_COLUMNS, FILTERED_COLUMNS, SIMULATION_COLUMNS
from studies.tables import (

    EVENT_REFERENCES,
    EVENT_TERMS,
    LINEITEM_REFERENCES,
    LINEITEM_TERMS,
    MODELS,
    REGISTRY_CATEGORIES,
)


def _literal(value) -> str:
    if value is None:
        return "NULL"
    return str(value) if isinstance(value, int) else f"'{value}'"


def _values(name: str, columns: str, rows) -> str:
    listed = ", ".join("(" + ", ".join(_literal(v) for v in row) + ")" for row in rows)
    return f"{name}({columns}) AS (VALUES {listed})"


def _study(simulation: str, calendar: str, components: str, connections: str, terms, references) -> str:
    term_rows = [(*row[:5], *((row[5] or []) + [None, None])[:2]) for row in terms]
    reference_rows = [(pos, *reference.split(".", 1)) for pos, reference in enumerate(references)]
    return f"""WITH sim AS ({simulation}),
cal AS ({calendar}),
filtered AS (
  SELECT s.*, c.granular_date FROM sim s JOIN cal c
    ON s.absolute_time_index = c.absolute_time_index AND s.block = c.block
  UNION ALL
  SELECT s.*, CAST(NULL AS TIMESTAMP) FROM sim s WHERE s.absolute_time_index IS NULL),
comps AS ({components}),
conns AS ({connections}),
usable AS (
  SELECT component1, port1, component2, coalesce(port2, port1) AS port2 FROM conns
  WHERE component1 IS NOT NULL AND component2 IS NOT NULL AND port1 IS NOT NULL AND component1 <> component2),
edges AS (
  SELECT component1 AS component, port1 AS port, component2 AS peer FROM usable
  UNION
  SELECT component2, port2, component1 FROM usable),
{_values("models", "library_id, pos, model_id, taxonomy_category", MODELS)},
{_values("terms", "catalog_key, metric_id, term_ord, taxonomy_category, output, port_a, port_b", term_rows)},
{_values("refs", "pos, catalog_key, metric_id", reference_rows)},
structure AS (
  SELECT CAST(r.pos AS BIGINT) AS pos, t.catalog_key, t.metric_id, t.metric_id LIKE '%\\_AVG' ESCAPE '\\' AS is_avg, c.component, t.output,
    CASE WHEN t.port_a IS NULL THEN c.component
         WHEN t.port_b IS NULL THEN a.peer
         ELSE a.peer || '|' || b.peer END AS metric_location
  FROM refs r
  JOIN terms t ON t.catalog_key = r.catalog_key AND t.metric_id = r.metric_id
  JOIN models m ON m.taxonomy_category = t.taxonomy_category
  JOIN comps c ON c.model_ref = m.library_id || '.' || m.model_id
  LEFT JOIN edges a ON a.component = c.component AND a.port = t.port_a
  LEFT JOIN edges b ON b.component = c.component AND b.port = t.port_b),
granular AS (
  SELECT s.pos, s.catalog_key, s.metric_id, s.is_avg, s.metric_location, f.absolute_time_index,
    f.scenario_index AS scenario,
    CASE WHEN s.is_avg THEN avg(f.value) ELSE coalesce(sum(f.value), 0.0) END AS granular_metric_value,
    max(f.granular_date) AS granular_date
  FROM filtered f RIGHT JOIN structure s ON f.component = s.component AND f.output = s.output
  GROUP BY s.pos, s.catalog_key, s.metric_id, s.is_avg, s.metric_location, f.absolute_time_index, f.scenario_index),
temporal AS (
  SELECT pos, catalog_key, metric_id, metric_location, granular_date AS view_date, scenario,
    coalesce(sum(granular_metric_value), 0.0) AS metric_value
  FROM granular GROUP BY ALL)
"""


_LINES = """
  SELECT CAST(CAST(floor(i / 365.0) AS BIGINT) AS VARCHAR) AS block, component, output,
    i AS absolute_time_index, i % 365 AS block_time_index, scenario_index, value, 'BASIC' AS basis_status
  FROM (
    SELECT 's' || l_suppkey AS component, 'qty' AS output, l_quantity AS value,
      CAST(l_linenumber AS BIGINT) AS scenario_index,
      date_diff('day', DATE '1995-01-02', CAST(l_shipdate AS DATE)) AS i FROM lineitem
    UNION ALL
    SELECT 's' || l_suppkey, 'price', l_extendedprice, CAST(l_linenumber AS BIGINT),
      date_diff('day', DATE '1995-01-02', CAST(l_shipdate AS DATE)) FROM lineitem)
  UNION ALL
  SELECT '0', 's' || s_suppkey, 'acctbal', NULL, NULL, NULL, s_acctbal, 'BASIC' FROM supplier"""

LINEITEM = _study(
    simulation=_LINES,
    calendar="""
  SELECT i AS absolute_time_index,
    CASE WHEN i BETWEEN 730 AND 759 THEN '-1' ELSE CAST(i // 365 AS VARCHAR) END AS block,
    CAST(DATE '1995-01-02' + CAST(i AS INTEGER) AS TIMESTAMP) AS granular_date
  FROM range(2000) r(i)""",
    components="""
  SELECT 's' || s_suppkey AS component,
    CASE WHEN s_suppkey % 10 = 9 THEN 'm1' ELSE 'lib.m' || (s_suppkey % 4) END AS model_ref FROM supplier""",
    connections="""
  SELECT n_name AS component1, 'home' AS port1, 's' || s_suppkey AS component2, NULL AS port2
    FROM supplier JOIN nation ON s_nationkey = n_nationkey
  UNION ALL
  SELECT 's' || s_suppkey, 'hub', r_name, 'hub'
    FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
  UNION ALL
  SELECT 's' || s_suppkey, 'aux', unnest([n_name, r_name]), 'aux'
    FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
    WHERE s_suppkey % 25 = 24
  UNION ALL
  SELECT 's' || s_suppkey, 'aux', 's' || s_suppkey, 'aux' FROM supplier WHERE s_suppkey = 1
  UNION ALL
  SELECT 's' || s_suppkey, NULL, n_name, 'aux'
    FROM supplier JOIN nation ON s_nationkey = n_nationkey WHERE s_suppkey = 2""",
    terms=LINEITEM_TERMS,
    references=LINEITEM_REFERENCES,
)

_HOUR = "date_diff('hour', TIMESTAMP '2024-01-01 00:00:00', ts)"
EVENTS = _study(
    simulation=f"""
  SELECT CASE WHEN {_HOUR} < 400 THEN '1' ELSE '2' END AS block, 'u' || user_id AS component,
    event_type AS output, CASE WHEN event_type <> 'signup' THEN {_HOUR} END AS absolute_time_index,
    CASE WHEN event_type <> 'signup' THEN {_HOUR} END AS block_time_index,
    CASE WHEN event_type <> 'signup' THEN event_id % 3 END AS scenario_index,
    value, 'BASIC' AS basis_status FROM events""",
    calendar="""
  SELECT i AS absolute_time_index, CASE WHEN i < 360 THEN '1' ELSE '2' END AS block,
    TIMESTAMP '2024-01-01 00:00:00' + to_hours(CAST(i AS INTEGER)) AS granular_date
  FROM range(600) r(i)""",
    components="""
  SELECT 'u' || c_custkey AS component, 'lib.m' || (c_custkey % 4) AS model_ref FROM customer""",
    connections="""
  SELECT 'u' || c_custkey AS component1, 'home' AS port1, n_name AS component2, NULL AS port2
    FROM customer JOIN nation ON c_nationkey = n_nationkey
  UNION ALL
  SELECT 'u' || c_custkey, 'hub', c_mktsegment, NULL
    FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    terms=EVENT_TERMS,
    references=EVENT_REFERENCES,
)

_REFERENCES = """
  SELECT o_orderkey AS pos, CASE o_orderkey % 50
      WHEN 0 THEN '.' || o_orderstatus WHEN 1 THEN o_orderstatus WHEN 2 THEN o_orderstatus || '.'
      ELSE 'c' || (o_custkey % 7) || '.M' || (o_orderkey % 47) || '.' || o_orderstatus END AS reference
  FROM orders"""
_PARSED = f"""
  SELECT pos, reference, split_part(reference, '.', 1) AS catalog_key,
    substr(reference, strpos(reference, '.') + 1) AS metric_id
  FROM ({_REFERENCES})
  WHERE contains(reference, '.') AND NOT starts_with(reference, '.') AND NOT ends_with(reference, '.')"""
_DEFINITIONS = """
  SELECT 'c' || (p_partkey % 5) AS catalog_key,
    'M' || (p_partkey % 41) || CASE WHEN p_partkey % 2 = 0 THEN '.F' ELSE '.O' END AS metric_id, p_partkey AS pos,
    CASE WHEN p_size = 7 THEN 'max' WHEN p_size % 3 = 0 THEN 'avg' ELSE 'sum' END AS terms_operator,
    CASE WHEN p_size % 10 = 0 THEN 'avg' ELSE 'sum' END AS time_operator
  FROM part"""
_LATEST = f"""
  SELECT catalog_key, metric_id, max(pos) AS pos, arg_max(terms_operator, pos) AS terms_operator,
    arg_max(time_operator, pos) AS time_operator
  FROM ({_DEFINITIONS}) GROUP BY catalog_key, metric_id"""
_CATALOGS = """
  SELECT DISTINCT 'c' || (p_partkey % 5) AS catalog_key,
    CASE WHEN p_partkey % 5 = 3 THEN 'other' ELSE 'tax' END AS taxonomy_id FROM part"""
_TERMS = """
  SELECT 'c' || (p_partkey % 5) AS catalog_key, 'P' || p_partkey AS metric_id,
    CASE WHEN p_size <> 11 THEN lower(p_type) END AS taxonomy_category,
    CASE WHEN p_size <> 13 THEN p_brand END AS output_id,
    CASE p_size % 4 WHEN 1 THEN ['home'] WHEN 2 THEN ['home', 'hub'] WHEN 3 THEN ['hub', 'dock'] END AS location_ports
  FROM part"""
_REGISTRY_MODELS = """
  SELECT p_partkey AS pos, 'p' || (p_partkey // 2) AS model_id,
    CASE WHEN p_size % 7 = 0 THEN NULL WHEN p_size % 6 = 0 THEN '' ELSE lower(p_type) END AS taxonomy_category
  FROM part"""
_CATALOG_MODELS = """
  SELECT DISTINCT lower(p_type) AS taxonomy_category, 'lib.' || lower(p_brand) || '-' || lower(p_type) AS model_ref FROM part"""
_KNOWN = ", ".join(f"'{c}'" for c in REGISTRY_CATEGORIES)
_WITH_HUB = ", ".join(f"'{c}'" for c in REGISTRY_CATEGORIES[:3])

_FILTERED = """SELECT block, component, output, absolute_time_index, block_time_index, scenario_index, value,
  basis_status, granular_date FROM filtered"""
_GRANULAR = f"""SELECT catalog_key, metric_id, metric_location, '' AS breakdown_properties,
  absolute_time_index, scenario, round(granular_metric_value, {DIGITS}) AS granular_metric_value, granular_date
FROM granular WHERE pos <> 1"""
_VIEW = f"""SELECT metric_id, metric_location, '' AS breakdown_properties, view_date, scenario,
  round(metric_value, {DIGITS}) AS metric_value FROM temporal"""
_STRUCTURE = """SELECT pos, metric_id, component, metric_location, '' AS breakdown_properties, output,
  '1' AS weight_output_id, count(*) AS copies FROM structure GROUP BY ALL"""
_PART_DEFINITIONS = """
  SELECT 'k' || p_partkey AS catalog_key, metric_id, term_ord, output_id, lower(p_type) AS taxonomy_category,
    CASE p_size % 3 WHEN 0 THEN '' WHEN 1 THEN 'home' ELSE 'home,hub' END AS location_ports
  FROM (
    SELECT *, 'A' AS metric_id, 0 AS term_ord, CASE WHEN p_size % 2 = 0 THEN 'new' ELSE 'old' END AS output_id FROM part
    UNION ALL SELECT *, 'B', 0, 'first' FROM part
    UNION ALL SELECT *, 'B', 1, p_name FROM part
    UNION ALL SELECT *, 'C', 0, 'new' FROM part WHERE p_size % 2 = 1)"""
_SCOPES = """WITH scopes AS (
  SELECT 'v' || o_orderkey AS id, o_orderstatus,
    CASE WHEN o_orderkey % 5 <> 0 THEN o_orderstatus WHEN o_orderkey % 6 <> 0 THEN 'last' END AS category,
    CASE WHEN o_orderkey % 7 = 1 THEN 'early'
      WHEN o_orderkey % 7 < 5 AND o_orderkey % 6 <> 0 THEN o_orderstatus END AS calendar,
    CASE WHEN o_orderkey % 4 <> 0 THEN CASE WHEN o_orderkey % 11 = 0 THEN 'decade' ELSE 'day' END END AS grain
  FROM orders)"""
_CALENDAR_RULES = """, rules AS (
  SELECT 'calendar_index' AS rule, 'absolute_time_index' AS subject,
    'indexes are not 0 to N-1, each once' AS detail
  FROM (SELECT count(*) AS n, count(DISTINCT absolute_time_index) AS d, min(absolute_time_index) AS lo,
          max(absolute_time_index) AS hi FROM cal) WHERE NOT (d = n AND lo = 0 AND hi = n - 1)
  UNION ALL
  SELECT 'calendar_step', 'granular_date',
    'dates do not advance by one constant step'
  FROM (SELECT count(DISTINCT step) AS steps FROM (
    SELECT granular_date - lag(granular_date) OVER (ORDER BY absolute_time_index) AS step,
      absolute_time_index - lag(absolute_time_index) OVER (ORDER BY absolute_time_index) AS gap FROM cal) WHERE gap = 1)
  WHERE steps > 1)
SELECT rule, subject, detail FROM rules"""
_TICKS = "cal AS (SELECT event_id AS absolute_time_index, ts AS granular_date FROM events)"
_GAPPED = """cal AS (SELECT o_orderkey AS absolute_time_index, DATE '1995-01-01' + CAST(o_orderkey AS INTEGER) AS granular_date
  FROM orders WHERE o_orderkey % 1000 <> 7)"""

ORACLE = {
    "filter_by_calendar": LINEITEM + _FILTERED,
    "filter_by_calendar_hourly": EVENTS + _FILTERED,
    "constant_rows": EVENTS + "SELECT component, output, block, value FROM sim WHERE absolute_time_index IS NULL",
    "calendar_semi_check": LINEITEM
    + """SELECT output, count(*) AS timed, count(*) FILTER (EXISTS (
  SELECT 1 FROM cal c WHERE c.absolute_time_index = f.absolute_time_index AND c.block = f.block)) AS in_calendar
FROM filtered f WHERE absolute_time_index IS NOT NULL GROUP BY output""",
    "calendar_violations": f"WITH {_TICKS}{_CALENDAR_RULES}",
    "calendar_violations_gaps": f"WITH {_GAPPED}{_CALENDAR_RULES}",
    "date_steps": f"""WITH {_TICKS}
SELECT * FROM (SELECT absolute_time_index,
  epoch_us(granular_date) - lag(epoch_us(granular_date)) OVER (ORDER BY absolute_time_index) AS step_us FROM cal)
WHERE step_us IS NOT NULL""",
    "port_edges": LINEITEM + "SELECT component, port, peer FROM edges",
    "peer_cardinality": LINEITEM
    + """SELECT c.component, p.port, CASE WHEN count(e.peer) = 0 THEN 'no_peer' ELSE 'several_peers' END
    || ': ' || c.component || '.' || p.port AS problem
FROM comps c CROSS JOIN (VALUES ('home'), ('hub'), ('aux')) p(port)
LEFT JOIN edges e ON e.component = c.component AND e.port = p.port
GROUP BY c.component, p.port HAVING count(DISTINCT e.peer) <> 1""",
    "components_by_model": LINEITEM + "SELECT model_ref, component FROM comps WHERE contains(model_ref, '.')",
    "models_by_category": f"""SELECT taxonomy_category, model_id FROM ({_REGISTRY_MODELS})
WHERE taxonomy_category IS NOT NULL AND taxonomy_category <> ''""",
    "model_violations": f"""WITH models AS (SELECT * FROM ({_REGISTRY_MODELS}) WHERE pos % 10 <> 3),
latest AS (SELECT model_id, max_by(coalesce(taxonomy_category, '?'), pos) AS category FROM models GROUP BY model_id)
SELECT 'model' AS rule, r.model_id AS subject,
  CASE WHEN l.model_id IS NULL THEN 'unknown model' ELSE 'model without category' END AS detail
FROM (SELECT 'p' || p_partkey AS model_id FROM part) r LEFT JOIN latest l ON l.model_id = r.model_id
WHERE l.model_id IS NULL OR l.category = '?'""",
    "column_violations": f"""WITH contract(subject, name) AS (
  SELECT 'simulation', unnest({list(SIMULATION_COLUMNS)}) UNION ALL
  SELECT 'filtered', unnest({list(FILTERED_COLUMNS)}) UNION ALL
  SELECT 'calendar', unnest({list(CALENDAR_COLUMNS)})),
given(subject, name) AS (
  SELECT 'simulation', unnest({[c for c in SIMULATION_COLUMNS if c != "value"] + ["unit"]}) UNION ALL
  SELECT 'filtered', unnest({list(SIMULATION_COLUMNS) + ["date"]}) UNION ALL
  SELECT 'calendar', unnest(['block', 'absolute_time_index', 'granular_date'])),
size(subject, n) AS (
  SELECT 'simulation', (SELECT 2 * count(*) FROM lineitem) + (SELECT count(*) FROM supplier) UNION ALL
  SELECT 'filtered', (SELECT 2 * count(*) FROM lineitem) + (SELECT count(*) FROM supplier) UNION ALL
  SELECT 'calendar', (SELECT count(*) FROM events)),
found AS (
  SELECT 'column_missing' AS rule, subject, name AS detail FROM contract ANTI JOIN given USING (subject, name) UNION ALL
  SELECT 'column_unknown', subject, name FROM given ANTI JOIN contract USING (subject, name) UNION ALL
  SELECT 'column_order', subject, string_agg(name, ', ') FROM given WHERE subject = 'calendar' GROUP BY subject
  HAVING list(name) <> {list(CALENDAR_COLUMNS)})
SELECT rule, subject, detail, n AS rows FROM found JOIN size USING (subject)""",
    "metric_refs": f"""SELECT min(pos) OVER (PARTITION BY catalog_key) AS catalog_pos, pos, catalog_key, metric_id
FROM ({_PARSED})""",
    "latest_metric_definition": f"SELECT catalog_key, metric_id, pos, terms_operator, time_operator FROM ({_LATEST})",
    "reference_problems": f"""WITH refs AS ({_REFERENCES}), parsed AS ({_PARSED}), latest AS ({_LATEST}),
catalogs AS ({_CATALOGS})
SELECT r.pos, r.reference, p.catalog_key, p.metric_id, l.terms_operator, l.time_operator,
  CASE WHEN p.pos IS NULL THEN 'reference_format' WHEN c.catalog_key IS NULL THEN 'unknown_catalog'
       WHEN l.pos IS NULL THEN 'unknown_metric' WHEN l.terms_operator NOT IN ('sum', 'avg') THEN 'terms_operator'
       WHEN l.time_operator <> 'sum' THEN 'time_operator' END AS problem
FROM refs r LEFT JOIN parsed p ON p.pos = r.pos LEFT JOIN catalogs c ON c.catalog_key = p.catalog_key
LEFT JOIN latest l ON l.catalog_key = p.catalog_key AND l.metric_id = p.metric_id""",
    "skipped_references": f"""WITH parsed AS ({_PARSED}), latest AS ({_LATEST}), catalogs AS ({_CATALOGS})
SELECT p.pos, p.reference FROM parsed p JOIN catalogs c ON c.catalog_key = p.catalog_key
WHERE NOT EXISTS (SELECT 1 FROM latest l WHERE l.catalog_key = p.catalog_key AND l.metric_id = p.metric_id)""",
    "time_operator_violations": f"""WITH parsed AS ({_PARSED}), latest AS ({_LATEST})
SELECT 'time_operator' AS rule, l.catalog_key || '.' || l.metric_id AS subject, l.time_operator AS detail
FROM parsed p JOIN latest l ON l.catalog_key = p.catalog_key AND l.metric_id = p.metric_id
WHERE l.time_operator <> 'sum'""",
    "catalog_violations": f"""WITH terms AS ({_TERMS})
SELECT 'taxonomy_id' AS rule, catalog_key AS subject, taxonomy_id AS detail FROM ({_CATALOGS}) WHERE taxonomy_id <> 'tax'
UNION ALL
SELECT 'unknown_category', catalog_key || '.' || metric_id, coalesce(taxonomy_category, '') FROM terms
  WHERE taxonomy_category IS NULL OR taxonomy_category NOT IN ({_KNOWN})
UNION ALL
SELECT 'unknown_port', catalog_key || '.' || metric_id, taxonomy_category || '.' || port
  FROM (SELECT *, unnest(location_ports) AS port FROM terms)
  WHERE taxonomy_category IN ({_KNOWN}) AND port <> 'home' AND NOT (port = 'hub' AND taxonomy_category IN ({_WITH_HUB}))""",
    "definition_violations": f"""WITH metrics AS ({_DEFINITIONS}), terms AS ({_TERMS})
SELECT 'unknown_operator' AS rule, catalog_key || '.' || metric_id AS subject, 'terms_operator ' || terms_operator AS detail
  FROM metrics WHERE terms_operator NOT IN ('sum', 'avg')
UNION ALL
SELECT 'missing_field', catalog_key || '.' || metric_id, 'taxonomy_category' FROM terms WHERE taxonomy_category IS NULL
UNION ALL
SELECT 'missing_field', catalog_key || '.' || metric_id, 'output_id' FROM terms WHERE output_id IS NULL
UNION ALL
SELECT 'missing_field', catalog_key || '.' || metric_id, 'terms' FROM metrics m
  WHERE NOT EXISTS (SELECT 1 FROM terms t WHERE t.catalog_key = m.catalog_key AND t.metric_id = m.metric_id)""",
    "metric_structure": LINEITEM + _STRUCTURE,
    "terms_sum": LINEITEM + _GRANULAR + " AND NOT is_avg",
    "terms_avg": LINEITEM + _GRANULAR + " AND is_avg",
    "time_sum": LINEITEM
    + f"""SELECT catalog_key, metric_id, metric_location, '' AS breakdown_properties, view_date, scenario,
  round(metric_value, {DIGITS}) AS metric_value FROM temporal WHERE pos <> 1""",
    "unmatched_structure": LINEITEM + _VIEW + " WHERE metric_id = 'GHOST'",
    "build_view": LINEITEM + _VIEW,
    "build_view_events": EVENTS + _VIEW,
    "view_round_trip": LINEITEM + _VIEW,
    "filtered_round_trip": EVENTS + _FILTERED,
    "structure_round_trip": LINEITEM + _STRUCTURE,
    "granular_round_trip": EVENTS
    + f"""SELECT catalog_key, metric_id, metric_location, '' AS breakdown_properties, absolute_time_index, scenario,
  round(granular_metric_value, {DIGITS}) AS granular_metric_value, granular_date FROM granular""",
    "file_simulation": LINEITEM
    + """SELECT block, component, output, absolute_time_index, block_time_index, scenario_index, value, basis_status
FROM sim""",
    "file_filtered": LINEITEM + _FILTERED,
    "file_view": LINEITEM + _VIEW,
    "file_system_components": LINEITEM + "SELECT component, model_ref FROM comps",
    "file_system_edges": LINEITEM + "SELECT component, port, peer FROM edges",
    "view_scopes": f"{_SCOPES} SELECT id, category, calendar, grain, 'c' || o_orderstatus AS catalogs FROM scopes",
    "view_scope_violations": f"""{_SCOPES}
SELECT 'scope_category' AS rule, id AS subject, '' AS detail FROM scopes WHERE category IS NULL
UNION ALL SELECT 'scope_calendar', id, '' FROM scopes WHERE calendar IS NULL
UNION ALL SELECT 'time_grain', id, grain FROM scopes WHERE grain NOT IN ('hour', 'day', 'week', 'month', 'year')""",
    "view_append_by_run": EVENTS + f"SELECT * FROM ({_VIEW}) UNION ALL SELECT * FROM ({_VIEW})",
    "view_append": EVENTS + f"SELECT * FROM ({_VIEW}) UNION ALL SELECT * FROM ({_VIEW})",
    "located_components": LINEITEM
    + """, peers AS (SELECT component, port, min(peer) AS peer, count(*) AS n FROM edges GROUP BY component, port),
found AS (SELECT c.component, v.port, CASE WHEN e.n = 1 THEN e.peer END AS peer,
    CASE WHEN e.n IS NULL THEN 'no_peer' WHEN e.n > 1 THEN 'several_peers' END
      || ': ' || c.component || '.' || v.port AS problem
  FROM comps c CROSS JOIN (VALUES ('home'), ('hub'), ('aux')) v(port)
  LEFT JOIN peers e ON e.component = c.component AND e.port = v.port
  WHERE contains(c.model_ref, '.')),
wide AS (SELECT h.component, h.peer AS home, u.peer AS hub, a.peer AS aux,
    h.problem AS home_problem, coalesce(u.problem, h.problem) AS two_problem,
    coalesce(u.problem, h.problem, a.problem) AS problem
  FROM found h JOIN found u ON h.component = u.component JOIN found a ON h.component = a.component
  WHERE h.port = 'home' AND u.port = 'hub' AND a.port = 'aux')
SELECT component, 0 AS "case", component AS metric_location, NULL AS location_problem FROM wide
UNION ALL SELECT component, 1, home, home_problem FROM wide
UNION ALL SELECT component, 2, CASE WHEN problem IS NULL THEN hub || '|' || home || '|' || aux END, problem FROM wide
UNION ALL SELECT component, 3, CASE WHEN two_problem IS NULL THEN hub || '|' || home || '|' || hub END, two_problem FROM wide""",
    "selected_metrics": f"""WITH refs AS ({_PARSED}), latest AS ({_LATEST})
SELECT refs.catalog_key, refs.metric_id, latest.terms_operator, count(*) AS mentions
FROM refs JOIN latest ON refs.catalog_key = latest.catalog_key AND refs.metric_id = latest.metric_id
GROUP BY refs.catalog_key, refs.metric_id, latest.terms_operator""",
    "terms_with_models": f"""WITH terms AS ({_TERMS})
SELECT t.catalog_key, t.metric_id, t.taxonomy_category, m.model_ref
FROM terms t JOIN ({_CATALOG_MODELS}) m ON m.taxonomy_category = t.taxonomy_category""",
    "taxonomy_categories": """SELECT 't' || p_partkey AS taxonomy_id, lower(p_type) AS category_id,
  CAST(NULL AS VARCHAR) AS parent_category FROM part
UNION ALL SELECT 't' || p_partkey, 'bare', NULL FROM part""",
    "taxonomy_ports": """SELECT lower(p_type) AS category_id, 'home' AS port_id FROM part
UNION ALL SELECT lower(p_type), p_brand FROM part""",
    "document_headers": """SELECT 't' || p_partkey AS id, CASE WHEN p_size % 2 = 0 THEN p_name ELSE '' END AS description
FROM part""",
    "library_models": """SELECT 'l' || p_partkey AS library_id, CAST(0 AS BIGINT) AS pos, 'a' AS model_id,
  lower(p_type) AS taxonomy_category FROM part
UNION ALL SELECT 'l' || p_partkey, 1, 'b', NULL FROM part""",
    "system_components": """SELECT 's' || s_suppkey AS component, 'lib.m' || (s_suppkey % 4) AS model_ref FROM supplier
UNION ALL SELECT 's' || s_suppkey || 'x', NULL FROM supplier""",
    "system_connections": """SELECT 's' || s_suppkey AS component1, 'home' AS port1, 'n' || s_nationkey AS component2,
  CAST(NULL AS VARCHAR) AS port2 FROM supplier""",
    "catalog_metrics": f"""SELECT DISTINCT catalog_key, metric_id,
  CASE WHEN output_id = 'old' THEN 'sum' ELSE 'avg' END AS terms_operator, 'sum' AS time_operator
FROM ({_PART_DEFINITIONS})""",
    "catalog_terms": f"""SELECT catalog_key, metric_id, term_ord, taxonomy_category, output_id, location_ports
FROM ({_PART_DEFINITIONS})""",
    "view_references": """SELECT CAST(0 AS BIGINT) AS pos, 'c.' || o_orderstatus AS reference FROM orders
UNION ALL SELECT 1, 'c' || o_custkey || '.M' FROM orders
UNION ALL SELECT 2, 'c.' || o_orderstatus FROM orders""",
}
