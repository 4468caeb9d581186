"""DuckDB views of the survey data model over the driver's tables.

Written independently of the Spark sources (plain SQL, same recipes as
FIXTURES.md) so that the oracle checks the Spark derivation as well.
``with_views(body)`` prefixes a query with every view; DuckDB only
evaluates the ones the body references.
"""

from __future__ import annotations

from boxscore.sources import lookups as L
from boxscore.sources import tables as T


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _values(rows, cols) -> str:
    def lit(v):
        if v is None:
            return "NULL"
        if isinstance(v, bool):
            return "TRUE" if v else "FALSE"
        if isinstance(v, int):
            return str(v)
        if isinstance(v, list):
            return "[" + ", ".join(_q(x) for x in v) + "]"
        return _q(v)
    body = ",\n    ".join("(" + ", ".join(lit(v) for v in r) + ")" for r in rows)
    return f"(VALUES\n    {body}) AS t({', '.join(cols)})"


_DOMAINS_ARR = "[" + ", ".join(_q(d) for d in T.SETTINGS_DOMAINS) + "]"

VIEWS: dict[str, str] = {}

VIEWS["responses"] = """
SELECT l.l_orderkey AS survey_id,
       CAST(l.l_linenumber AS INTEGER) AS question_id,
       l.l_orderkey AS account_key,
       o.o_custkey AS patient_key,
       CASE l.l_partkey % 5 WHEN 0 THEN 'IN' WHEN 4 THEN 'MD' ELSE 'PD' END AS service_code,
       CAST(o.o_orderdate AS DATE) + CAST(o.o_orderkey % 45 AS INTEGER) AS received_date,
       CAST(o.o_orderdate AS DATE) AS discharge_date,
       CAST(CASE WHEN month(o.o_orderdate) >= 7 THEN year(o.o_orderdate) + 1 ELSE year(o.o_orderdate) END AS INTEGER) AS fy,
       CASE
         WHEN l.l_returnflag = 'R' AND CAST(l.l_quantity AS INTEGER) % 4 = 0 THEN NULL
         WHEN l.l_linenumber = 1 THEN CAST(CAST(l.l_quantity AS INTEGER) % 5 + 1 AS VARCHAR)
         WHEN l.l_linenumber = 2 AND l.l_partkey % 5 = 4 AND CAST(l.l_quantity AS INTEGER) % 11 = 10 THEN '10-Best provider'
         WHEN l.l_linenumber = 2 AND l.l_partkey % 5 = 4 AND CAST(l.l_quantity AS INTEGER) % 11 = 0 THEN '0-Worst provider'
         WHEN l.l_linenumber = 4 AND l.l_partkey % 5 IN (0, 4) THEN CASE WHEN CAST(l.l_quantity AS INTEGER) % 3 = 0 THEN 'Yes' ELSE 'No' END
         WHEN l.l_linenumber = 5 AND l.l_partkey % 5 = 0 THEN CASE WHEN CAST(l.l_quantity AS INTEGER) % 2 = 0 THEN 'Strongly Agree' ELSE 'Disagree' END
         WHEN l.l_linenumber = 2 THEN
           CASE CAST(l.l_quantity AS INTEGER) % 11 WHEN 10 THEN '10-Best possible' WHEN 0 THEN '0-Worst possible'
                ELSE CAST(CAST(l.l_quantity AS INTEGER) % 11 AS VARCHAR) END
         WHEN l.l_linenumber = 3 THEN
           CASE CAST(l.l_quantity AS INTEGER) % 4 WHEN 0 THEN 'Always' WHEN 1 THEN 'Usually'
                WHEN 2 THEN 'Sometimes' ELSE 'Never' END
         WHEN l.l_linenumber = 4 THEN
           CASE CAST(l.l_quantity AS INTEGER) % 3 WHEN 0 THEN 'Yes, definitely' WHEN 1 THEN 'Yes, somewhat' ELSE 'No' END
         WHEN l.l_linenumber = 5 THEN
           CASE CAST(l.l_quantity AS INTEGER) % 2 WHEN 0 THEN 'Definitely Yes' ELSE 'Probably No' END
         WHEN l.l_linenumber = 6 THEN CAST(CAST(l.l_quantity AS INTEGER) AS VARCHAR)
         WHEN l.l_linenumber = 7 THEN 'U' || CAST(l.l_suppkey % 8 AS VARCHAR)
       END AS value,
       CASE WHEN o.o_custkey % 13 = 0 THEN CAST(-1 AS BIGINT) ELSE o.o_custkey % 100 END AS department_key,
       l.l_suppkey % 7 AS physician_key,
       CASE l.l_partkey % 3 WHEN 1 THEN 'PC01' WHEN 2 THEN 'MD01' END AS survey_designator
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey"""

VIEWS["departments"] = """
SELECT s_suppkey AS department_key,
       CAST(s_suppkey + 10000000 AS VARCHAR) AS department_id,
       CASE WHEN s_suppkey % 11 = 0 THEN NULL ELSE s_name END AS department_name,
       CASE WHEN s_suppkey % 5 = 0 THEN NULL ELSE 'EXT ' || s_name END AS external_name
FROM supplier"""

VIEWS["location_master"] = """
SELECT CAST(s.s_suppkey + 10000000 AS VARCHAR) AS department_id,
       CASE WHEN s.s_suppkey % 11 = 0 THEN NULL ELSE s.s_name END AS department_name,
       CASE WHEN s.s_suppkey % 7 = 0 THEN NULL ELSE 'MASTER ' || s.s_name END AS external_name,
       r.r_regionkey AS service_line_id,
       CASE s.s_suppkey % 9 WHEN 0 THEN NULL WHEN 1 THEN 'Unknown' WHEN 2 THEN 'Therapies' ELSE r.r_name END AS service_line,
       CASE WHEN s.s_suppkey % 5 = 0 THEN 'Therapies' ELSE n.n_name || ' OPS' END AS operational_service,
       CASE WHEN s.s_suppkey % 6 = 0 THEN 'Unknown' ELSE n.n_name END AS sub_service_line
FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey"""

VIEWS["patients"] = """
SELECT c_custkey AS patient_key, c_mktsegment AS last_name,
       CASE WHEN c_custkey % 17 = 0 THEN NULL ELSE c_name END AS first_name,
       DATE '1940-01-01' + CAST((c_custkey * 37) % 25000 AS INTEGER) AS birth_date,
       CASE c_custkey % 3 WHEN 0 THEN 'M' WHEN 1 THEN 'F' END AS sex
FROM customer"""

VIEWS["accounts"] = "SELECT o_orderkey AS account_key, o_custkey + 1000000 AS mrn FROM orders"

VIEWS["physicians"] = """
SELECT CAST(n_nationkey AS BIGINT) AS physician_key, 'Dr ' || n_name AS display_name,
       n_name || ' Dept' AS dept, 'Div ' || CAST(n_regionkey AS VARCHAR) AS division, 'Line ' || CAST(n_regionkey AS VARCHAR) AS physician_line,
       CAST(n_nationkey + 1000000000 AS BIGINT) AS npi
FROM nation"""

VIEWS["encounters"] = """
SELECT user_id AS account_key, event_id % 100 AS department_key, ts AS appt_dtm, event_id AS encounter_id
FROM events"""

VIEWS["designator_log"] = """
SELECT user_id AS survey_id,
       CASE WHEN event_type IN ('click', 'view', 'purchase') THEN 'PC0' || CAST(event_id % 3 AS VARCHAR)
            ELSE 'MD0' || CAST(event_id % 3 AS VARCHAR) END AS value,
       ts AS load_dtm, event_id AS log_id
FROM events"""

VIEWS["rules"] = "SELECT * FROM " + _values(
    L.QUESTION_RULES, ["question_id", "varname", "question_text", "question_text_alias", "domain", "scale",
                       "top_values", "top_label", "domain_override", "question_order"])
VIEWS["questions"] = "SELECT question_id, varname, question_text FROM rules"

VIEWS["calendar"] = f"""
SELECT d AS day_date,
       CAST(CASE WHEN month(d) >= 7 THEN year(d) + 1 ELSE year(d) END AS INTEGER) AS fyear_num,
       'Q' || CAST(quarter(d) AS VARCHAR) || ' ' || CAST(year(d) AS VARCHAR) AS quarter_name,
       CAST(month(d) AS INTEGER) AS month_num,
       strftime(d, '%B') AS month_name,
       strftime(d, '%b') || ' ' || CAST(year(d) AS VARCHAR) AS month_short_name,
       CAST(year(d) * 100 + month(d) AS INTEGER) AS month_key,
       CAST(year(d) AS INTEGER) AS year_num
FROM (SELECT CAST(unnest(generate_series(DATE '{T.CALENDAR_START}', DATE '{T.CALENDAR_END}', INTERVAL 1 DAY)) AS DATE) AS d)"""

VIEWS["dept_translation"] = "SELECT * FROM " + _values(
    L.DEPARTMENT_TRANSLATION, ["goal_fiscal_yr", "response_department_id", "goal_department_id"])
VIEWS["domain_translation"] = "SELECT * FROM " + _values(L.GOAL_DOMAIN_TRANSLATION, ["goals_domain", "domain"])
VIEWS["unit_mapping"] = "SELECT * FROM " + _values(L.UNIT_MAPPING, ["unit_name", "department_id", "service_line"])
VIEWS["unit_overrides"] = "SELECT * FROM " + _values(L.UNIT_OVERRIDES, ["unit_name", "department_id"])
VIEWS["unit_aliases"] = "SELECT * FROM " + _values(L.UNIT_ALIASES, ["unit_name", "current_unit"])
VIEWS["dept_groups"] = "SELECT * FROM " + _values(L.DEPARTMENT_GROUPS, ["department_id", "group_id", "group_name"])

_G = "CAST(CAST({} AS DOUBLE) / 100 AS DECIMAL(4,3))"
VIEWS["goal_years"] = f"SELECT CAST(unnest(range({T.GOAL_YEARS[0]}, {T.GOAL_YEARS[1] + 1})) AS INTEGER) AS goal_yr"
VIEWS["goal_domains"] = f"SELECT CAST(i - 1 AS INTEGER) AS di, {_DOMAINS_ARR}[i] AS domain FROM range(1, {len(T.SETTINGS_DOMAINS) + 1}) r(i)"

VIEWS["goal_settings"] = f"""
SELECT 'CHILD_IP' AS service, CAST(s.s_suppkey + 10000000 AS VARCHAR) AS department_id, s.s_name AS department_name,
       y.goal_yr, r.r_name AS service_line, CAST(NULL AS VARCHAR) AS unit, d.domain,
       {_G.format('50 + (s.s_suppkey * 7 + y.goal_yr + d.di * 3) % 45')} AS goal
FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey,
     goal_years y, goal_domains d
WHERE s.s_suppkey % 4 = 0
UNION ALL
SELECT 'CHILD_IP', NULL, NULL, y.goal_yr, NULL, 'All PEDS Units', d.domain,
       CASE WHEN y.goal_yr = 1997 AND d.di = 0 THEN CAST(0 AS DECIMAL(4,3))
            ELSE {_G.format('55 + (y.goal_yr + d.di * 7) % 40')} END
FROM region r, goal_years y, goal_domains d WHERE r.r_regionkey = 0
UNION ALL
SELECT 'CHILD_IP', NULL, NULL, y.goal_yr, r.r_name, 'Retired unit', d.domain, {_G.format('90')}
FROM region r, goal_years y, goal_domains d WHERE r.r_regionkey % 2 = 1
UNION ALL
SELECT 'ADULT_IP', NULL, NULL, y.goal_yr, r.r_name, 'All Units', d.domain,
       {_G.format('50 + (r.r_regionkey * 7 + y.goal_yr + d.di) % 45')}
FROM region r, goal_years y, goal_domains d
UNION ALL
SELECT 'ADULT_IP', NULL, NULL, y.goal_yr, 'All Service Lines', 'All Units', d.domain,
       {_G.format('60 + (y.goal_yr + d.di) % 30')}
FROM region r, goal_years y, goal_domains d WHERE r.r_regionkey = 0"""


def _goal_load(service, svc, label, line_expr, all_lines, load_dtm=T.FIXED_LOAD_DTM):
    base = f"""(SELECT g.goal_yr, {line_expr} AS service_line, g.department_id, g.department_name,
            CASE WHEN g.unit = '{label}' THEN 'All Units' ELSE g.unit END AS unit,
            g.domain AS raw_domain, COALESCE(t.domain, g.domain) AS domain_goals, g.goal
     FROM goal_settings g LEFT JOIN domain_translation t ON t.goals_domain = g.domain
     WHERE g.service = '{service}' AND (g.unit = '{label}' OR g.unit IS NULL))"""
    ts = f"CAST('{load_dtm}' AS TIMESTAMP)"
    arms = [f"""SELECT DISTINCT '{svc}' AS svc_cde, CAST(goal_yr AS INTEGER) AS goal_fiscal_yr, service_line, unit,
        department_id AS epic_department_id, department_name AS epic_department_name, domain_goals AS domain,
        CAST(goal AS DECIMAL(4,3)) AS goal, {ts} AS load_dtm
      FROM {base} s WHERE (unit IS NULL OR unit <> 'All Units') AND raw_domain IS NOT NULL AND goal IS NOT NULL""",
            f"""SELECT DISTINCT '{svc}', CAST(goal_yr AS INTEGER), service_line, CAST(NULL AS VARCHAR), 'All Units',
        CAST(NULL AS VARCHAR), domain_goals, CAST(goal AS DECIMAL(4,3)), {ts}
      FROM {base} s WHERE unit = 'All Units' AND raw_domain IS NOT NULL"""]
    if all_lines:
        arms.append(f"""SELECT DISTINCT '{svc}', CAST(goal_yr AS INTEGER), 'All Service Lines', CAST(NULL AS VARCHAR),
        'All Units', CAST(NULL AS VARCHAR), domain_goals, CAST(goal AS DECIMAL(4,3)), {ts}
      FROM {base} s WHERE unit = 'All Units' AND raw_domain IS NOT NULL""")
    return "\nUNION ALL\n".join(arms)


VIEWS["child_goals"] = _goal_load("CHILD_IP", "PD", "All PEDS Units", _q(L.CHILD_SERVICE_LINE), True)
VIEWS["adult_goals"] = _goal_load("ADULT_IP", "IN", "All Units", "g.service_line", False)

VIEWS["goals_old"] = f"""
SELECT 'PD' AS svc_cde, y.goal_yr, r.r_name AS service_line,
       s.s_name || ' [' || CAST(s.s_suppkey + 10000000 AS VARCHAR) || ']' AS unit, d.domain,
       {_G.format('45 + (s.s_suppkey + y.goal_yr * 3 + d.di) % 50')} AS goal
FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey,
     goal_years y, goal_domains d
WHERE s.s_suppkey % 3 = 0
UNION ALL
SELECT 'PD', y.goal_yr, r.r_name, 'All Units', d.domain,
       {_G.format('50 + (r.r_regionkey * 5 + y.goal_yr + d.di) % 45')}
FROM region r, goal_years y, goal_domains d
UNION ALL
SELECT 'PD', y.goal_yr, 'All Service Lines', 'All Units', d.domain, {_G.format('60 + (y.goal_yr + d.di) % 30')}
FROM region r, goal_years y, goal_domains d WHERE r.r_regionkey = 0"""


def _flat(rows, first, step):
    return f"""
SELECT DISTINCT {rows} COALESCE(t.domain, d.domain) AS domain, {_G.format(f'{first} + (r.r_regionkey * {step} + d.di * 3) % 40')} AS goal
FROM region r CROSS JOIN goal_domains d LEFT JOIN domain_translation t ON t.goals_domain = d.domain"""


VIEWS["adult_unit_goals"] = (_flat("r.r_name AS service_line, 'U' || r.r_regionkey AS unit,", 50, 11) + " UNION ALL "
                             + _flat("'All Service Lines', 'All Units',", 55, 0))
VIEWS["clinic_goals"] = (_flat("r.r_name AS service_line, 'All Clinics' AS unit,", 45, 7) + " UNION ALL "
                         + _flat("'All Service Lines', 'All Clinics',", 60, 0))
VIEWS["service_questions"] = "SELECT * FROM " + _values(L.SERVICE_QUESTIONS, ["question_id", "service_code", "varname"])
_SCALES = [(name, best, closed) for name, (_, best, _, closed) in L.SCALES.items()]
VIEWS["typed_rules"] = "SELECT t.survey_type, t.question_id, t.scale, t.domain, t.domain_override, x.best, x.closed, q.question_text, q.question_text_alias FROM " + _values(
    L.SURVEY_RULES, ["survey_type", "question_id", "scale", "domain", "domain_override"]) + " JOIN " + _values(
    _SCALES, ["scale", "best", "closed"]).replace(" AS t(", " AS x(") + " USING (scale) JOIN rules q USING (question_id)"
VIEWS["scale_tops"] = "SELECT * FROM " + _values([(n, a) for n, (tops, *_) in L.SCALES.items() for a in tops], ["scale", "answer"])
VIEWS["scale_groups"] = "SELECT * FROM " + _values(
    [(n, a, label) for n, (_, _, bands, _) in L.SCALES.items() for label, answers in (bands or [(x, [v]) for v, x in L.FIVE_POINT_LABELS]) for a in answers],
    ["scale", "answer", "grp"])


def with_views(body: str, extra: dict[str, str] | None = None) -> str:
    views = dict(VIEWS)
    if extra:
        views.update(extra)
    ctes = ",\n".join(f"{name} AS ({sql}\n)" for name, sql in views.items())
    return f"WITH {ctes}\n{body}"
