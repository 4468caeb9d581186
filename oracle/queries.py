"""DuckDB oracle SQL, one per registered query (same keys, same column
names). Queries without an entry are checked on row counts only."""

from __future__ import annotations

from boxscore.plans.config import DEFAULT
from boxscore.plans.summaries import window_years
from oracle.fixtures import with_views
from oracle.fixtures import _q
from oracle.stages import (age, band_case, clinic_report, detail_sql, extract_views, five_case, line_display, line_report, line_views, peds, report_days, rpt_prd, sex,
                           survey_report, typed_views, unflagged_report, unit_report)

ORACLE: dict[str, str] = {}

_EXT = extract_views(DEFAULT)


def _score(t: str, v: str) -> str:
    return (f"CAST(CASE WHEN {v} = 0 THEN NULL ELSE CAST((2000 * {t} + {v}) // (2 * {v}) AS DECIMAL(18,0)) "
            f"* CAST(0.001 AS DECIMAL(4,3)) END AS DECIMAL(4,3))")


ORACLE["q_unit_extract"] = with_views(unit_report(DEFAULT), _EXT)

ORACLE["q_score_summary"] = with_views(f"""
SELECT s.*, g.goal FROM (
  SELECT rec_fy, month_num, month_short_name, unit, epic_department_id, epic_department_name, goal_epic_department_id, clinic,
         service_line_id, service_line, domain_goals,
         CAST(SUM(top_box) AS BIGINT) AS top_box, CAST(SUM(val_count) AS BIGINT) AS val_count,
         {_score('SUM(top_box)', 'SUM(val_count)')} AS score, COUNT(*) AS n
  FROM (SELECT x.*, c.month_num, c.month_short_name FROM scored x LEFT JOIN calendar c ON c.day_date = x.received_date)
  WHERE domain_goals IS NOT NULL
    AND domain_goals NOT IN ('Meals', 'Overall Assessment', 'Pediatric ICU/CCU', 'Personal Issues')
  GROUP BY rec_fy, month_num, month_short_name, unit, epic_department_id, epic_department_name, goal_epic_department_id, clinic,
           service_line_id, service_line, domain_goals) s
LEFT JOIN (SELECT DISTINCT rec_fy, goal_epic_department_id, service_line, domain_goals, goal FROM cascade) g
  ON g.rec_fy = s.rec_fy AND g.goal_epic_department_id = s.goal_epic_department_id
 AND g.service_line = s.service_line AND g.domain_goals = s.domain_goals
WHERE s.rec_fy IN (SELECT DISTINCT fyear_num FROM calendar
                   WHERE day_date BETWEEN DATE '{DEFAULT.start}' AND DATE '{DEFAULT.end}')
  AND s.rec_fy IN ({', '.join(str(y) for y in window_years(DEFAULT))})""", _EXT)


def _v(body: str) -> str:
    return with_views(body, _EXT)


ORACLE["q_scan_responses"] = _v("SELECT survey_id, question_id, received_date, value FROM responses")
ORACLE["q_age_per_survey"] = _v("""SELECT survey_id, CAST(MAX(value) AS VARCHAR) AS age FROM responses
WHERE question_id = 6 AND account_key > 0 GROUP BY survey_id""")
ORACLE["q_domain_translation"] = _v("""SELECT g.service, g.goal_yr, g.department_id, g.unit, g.domain,
       COALESCE(t.domain, g.domain) AS domain_goals
FROM goal_settings g LEFT JOIN domain_translation t ON t.goals_domain = g.domain""")
ORACLE["q_goals_conformed"] = _v("SELECT * FROM child_goals UNION ALL SELECT * FROM adult_goals")
ORACLE["q_date_spine"] = _v("""SELECT c.* FROM calendar c,
  (SELECT least(min(received_date), min(discharge_date)) AS lo,
          greatest(max(received_date), max(discharge_date)) AS hi FROM responses) b
WHERE c.day_date BETWEEN b.lo AND b.hi""")
ORACLE["q_filter_questions"] = _v("""SELECT survey_id, question_id, value FROM responses
WHERE question_id IN (1, 2, 3, 4, 5, 2, 3)""")
ORACLE["q_filter_received"] = _v(f"""SELECT survey_id, question_id, received_date FROM responses
WHERE received_date BETWEEN DATE '{DEFAULT.start}' AND DATE '{DEFAULT.end}'""")
ORACLE["q_filter_designator"] = _v("""SELECT survey_id, question_id, substring(survey_designator, 1, 2) AS designator
FROM responses WHERE substring(survey_designator, 1, 2) IS NULL OR substring(survey_designator, 1, 2) = 'PC'""")
ORACLE["q_default_window"] = _v("""SELECT as_of,
       CAST(date_trunc('month', as_of - INTERVAL 24 MONTH) AS DATE) AS window_start,
       last_day(as_of) AS window_end,
       make_date(CAST(CASE WHEN month(as_of) >= 7 THEN year(as_of) + 1 ELSE year(as_of) END AS INTEGER) - 1, 7, 1) AS report_start,
       CAST(as_of - INTERVAL 1 DAY AS DATE) AS report_end, DATE '1995-07-01' AS fixed_report_start
FROM (SELECT DISTINCT received_date AS as_of FROM responses)""")
ORACLE["q_filter_either_date"] = _v("""SELECT survey_id, question_id, received_date, discharge_date FROM responses
WHERE received_date >= DATE '2000-01-01' OR discharge_date >= DATE '2000-01-01'""")
ORACLE["q_filter_known_dept"] = _v("SELECT survey_id, question_id, department_key FROM responses WHERE department_key > 0")
ORACLE["q_filter_service"] = _v("SELECT survey_id, question_id, service_code FROM responses WHERE service_code IN ('IN')")
ORACLE["q_filter_recent"] = _v("""SELECT survey_id, question_id, discharge_date FROM responses
WHERE datediff('day', discharge_date, DATE '2001-08-01') <= 366""")
_RULED = "(SELECT r.survey_id, r.question_id, r.value, x.* EXCLUDE (question_id) FROM responses r LEFT JOIN rules x ON x.question_id = r.question_id)"
ORACLE["q_reportable_domains"] = _v(f"""SELECT survey_id, question_id, COALESCE(domain_override, domain) AS domain_goals
FROM {_RULED} WHERE COALESCE(domain_override, domain) IS NOT NULL
  AND COALESCE(domain_override, domain) NOT IN ('Meals', 'Overall Assessment', 'Pediatric ICU/CCU', 'Personal Issues')""")
ORACLE["q_question_catalog"] = _v("""SELECT DISTINCT r.service_code, q.varname, r.question_id, q.question_text
FROM responses r LEFT JOIN questions q USING (question_id)
WHERE q.varname IN ('CH_1', 'CH_2', 'CH_3', 'AGE', 'UNIT')""")
ORACLE["q_top_box"] = _v(f"""SELECT survey_id, question_id, CAST(value AS VARCHAR) AS value,
       CASE WHEN list_contains(top_values, value) THEN 1 ELSE 0 END AS top_box,
       CASE WHEN value IS NOT NULL THEN 1 ELSE 0 END AS val_count FROM {_RULED}""")
ORACLE["q_top_box_label"] = _v(f"""SELECT DISTINCT question_id, CASE WHEN scale IS NOT NULL THEN top_label END AS top_box_response
FROM {_RULED}""")
ORACLE["q_response_group"] = _v(f"""SELECT question_id, value,
       CASE WHEN scale = '0-10' THEN {band_case('value')} WHEN question_id = 6 THEN value ELSE {five_case('value')} END AS value_resp_grp,
       COUNT(*) AS n
FROM {_RULED} GROUP BY ALL""")
ORACLE["q_goal_domain"] = _v(f"""SELECT question_id, domain, COALESCE(domain_override, domain) AS domain_goals, COUNT(*) AS n
FROM {_RULED} GROUP BY ALL""")
ORACLE["q_patient_attributes"] = _v(f"""SELECT s.survey_id, s.patient_key, s.received_date,
       p.last_name || ', ' || p.first_name AS pat_name,
       {age('p.birth_date', f"DATE '{DEFAULT.as_of}'")} AS pat_age,
       {age('p.birth_date', 's.received_date')} AS pat_age_survey_recvd,
       a.age AS pat_age_survey_answer, {peds('a.age')} AS peds, {sex('p.sex')} AS pat_sex
FROM (SELECT DISTINCT survey_id, patient_key, received_date FROM responses) s
LEFT JOIN patients p ON p.patient_key = s.patient_key
LEFT JOIN ages a ON a.survey_id = s.survey_id""")
ORACLE["q_period_label"] = _v(f"""SELECT DISTINCT received_date AS event_date, {rpt_prd('received_date')} AS rpt_prd FROM responses""")

# -- windows, departments, joins ----------------------------------------------
ORACLE["q_unit_spread"] = _v("""SELECT survey_id, question_id, value,
       MAX(CASE WHEN question_id = 7 THEN COALESCE(value, 'Null Unit') END) OVER (PARTITION BY survey_id) AS unit
FROM responses""")
ORACLE["q_unit_per_survey"] = _v("""SELECT r.survey_id, r.question_id, r.value, u.unit
FROM responses r LEFT JOIN (SELECT DISTINCT survey_id, value AS unit FROM responses WHERE question_id = 7) u
  ON u.survey_id = r.survey_id""")
ORACLE["q_first_encounter"] = _v("""SELECT account_key, department_key AS enc_department_key FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY account_key ORDER BY appt_dtm, encounter_id) AS seq FROM encounters)
WHERE seq = 1""")
ORACLE["q_latest_designator"] = _v("""SELECT survey_id, value, log_id, load_dtm FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY survey_id, value ORDER BY load_dtm DESC, log_id DESC) AS seq
  FROM designator_log) WHERE seq = 1""")
ORACLE["q_unit_recode"] = _v("""SELECT u.survey_id, u.unit, COALESCE(a.current_unit, u.unit) AS der_unit
FROM (SELECT survey_id, MAX(COALESCE(value, 'Null Unit')) AS unit FROM responses WHERE question_id = 7 GROUP BY survey_id) u
LEFT JOIN unit_aliases a ON a.unit_name = u.unit""")
ORACLE["q_dept_translation"] = _v("""SELECT DISTINCT survey_id, department_id AS epic_department_id,
       department_name AS epic_department_name, goal_department_id AS goal_epic_department_id, rec_fy, unit
FROM survey_dept""")

_SUD = {
    "enc_first": """SELECT account_key, department_key AS enc_department_key FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY account_key ORDER BY appt_dtm, encounter_id) AS seq FROM encounters) WHERE seq = 1""",
    "sud_base": """SELECT DISTINCT r.survey_id, r.account_key, r.department_key, e.enc_department_key, r.unit,
       CASE r.unit WHEN 'U4' THEN 'U3' WHEN 'U7' THEN 'U6' ELSE r.unit END AS der_unit,
       CASE r.unit WHEN 'U4' THEN 'U3' WHEN 'U7' THEN 'U6' WHEN 'U2' THEN 'U3' ELSE r.unit END AS goal_unit
FROM (SELECT * FROM answers_f LEFT JOIN survey_unit USING (survey_id)) r LEFT JOIN enc_first e ON e.account_key = r.account_key""",
    "sud_mapped": """SELECT b.*, COALESCE(o.department_id, m.department_id) AS mapped_department_id
FROM sud_base b LEFT JOIN unit_mapping m ON m.unit_name = b.der_unit LEFT JOIN unit_overrides o ON o.unit_name = b.unit""",
    "sud": """SELECT x.*,
       CASE WHEN x.department_key IS NOT NULL AND x.department_key > 0 THEN x.department_key
            WHEN x.der_unit IS NULL THEN x.enc_department_key
            WHEN x.der_unit <> 'U5' THEN x.dep_department_key ELSE x.enc_department_key END AS resolved_department_key,
       CASE WHEN x.goal_department_key IS NOT NULL AND x.goal_department_key > 0 THEN x.goal_department_key
            WHEN x.goal_unit IS NULL THEN x.enc_department_key
            WHEN x.goal_unit <> 'U5' THEN x.dep_department_key ELSE x.enc_department_key END AS goal_resolved_department_key
FROM (SELECT m.*, d.department_key AS dep_department_key,
             CASE WHEN m.unit = 'U2' THEN 40 WHEN m.unit IS NULL AND m.department_key = 7 THEN 8
                  ELSE m.department_key END AS goal_department_key
      FROM sud_mapped m LEFT JOIN departments d ON d.department_id = m.mapped_department_id) x""",
}
_EXT.update(_SUD)
ORACLE["q_dept_by_unit"] = _v("SELECT DISTINCT survey_id, unit, der_unit, mapped_department_id, dep_department_key FROM sud")
ORACLE["q_resolve_department"] = _v("""SELECT survey_id, department_key, unit, der_unit, goal_unit, enc_department_key,
       dep_department_key, resolved_department_key, goal_department_key, goal_resolved_department_key FROM sud""")
ORACLE["q_department_group"] = _v("""SELECT s.survey_id, s.epic_department_id, COALESCE(g.group_id, 0) AS group_id,
       COALESCE(g.group_name, 'Other') AS group_name
FROM (SELECT DISTINCT survey_id, department_id AS epic_department_id, department_name, goal_department_id, rec_fy, unit
      FROM survey_dept) s LEFT JOIN dept_groups g ON g.department_id = s.epic_department_id""")
_KEYS = f"""(SELECT DISTINCT e.rec_fy, '{DEFAULT.service_line}' AS service_line, e.department_id AS epic_department_id,
        e.goal_department_id AS goal_epic_department_id, COALESCE(x.domain_override, x.domain) AS domain_goals
  FROM survey_dept e JOIN answers_f a ON a.survey_id = e.survey_id LEFT JOIN rules x ON x.question_id = a.question_id)"""
ORACLE["q_goal_anti"] = _v(f"""SELECT k.* FROM {_KEYS} k
LEFT JOIN (SELECT * FROM child_goals WHERE epic_department_id <> 'All Units') g
  ON g.goal_fiscal_yr = k.rec_fy AND g.epic_department_id = k.goal_epic_department_id AND g.domain = k.domain_goals
WHERE g.epic_department_id IS NULL""")
ORACLE["q_goal_specific"] = _v(f"""SELECT k.*, g.goal FROM {_KEYS} k
LEFT JOIN (SELECT * FROM child_goals WHERE epic_department_id <> 'All Units') g
  ON g.goal_fiscal_yr = k.rec_fy AND g.epic_department_id = k.goal_epic_department_id AND g.domain = k.domain_goals
WHERE g.epic_department_id IS NOT NULL""")
ORACLE["q_goal_all_lines"] = _v("""SELECT * FROM child_goals WHERE service_line = 'All Service Lines'
  AND goal_fiscal_yr IN (SELECT DISTINCT rec_fy FROM survey_dept)""")
ORACLE["q_zip_domains"] = _v("""SELECT a.idx, a.response_domain, b.goal_domain FROM
  (SELECT ROW_NUMBER() OVER (ORDER BY response_domain) AS idx, response_domain FROM
     (SELECT DISTINCT COALESCE(x.domain_override, x.domain) AS response_domain FROM responses r
      LEFT JOIN rules x ON x.question_id = r.question_id WHERE COALESCE(x.domain_override, x.domain) IS NOT NULL)) a
JOIN (SELECT ROW_NUMBER() OVER (ORDER BY goal_domain) AS idx, goal_domain FROM
     (SELECT DISTINCT domain AS goal_domain FROM child_goals)) b ON a.idx = b.idx""")

# -- goals, roll-ups, report dates -----------------------------------------------
_LINE = f"'{DEFAULT.service_line}'"
_PARSE = """CASE WHEN unit = 'All Units' OR instr(unit, '[') = 0 THEN NULL ELSE substring(unit, instr(unit, '[') + 1, 8) END AS epic_department_id,
       CASE WHEN unit = 'All Units' OR instr(unit, '[') = 0 THEN NULL ELSE substring(unit, 1, instr(unit, '[') - 2) END AS epic_department_name"""
_EXT.update({
    "unit_by_survey": "SELECT survey_id, MAX(COALESCE(value, 'Null Unit')) AS unit FROM answers_f WHERE question_id = 7 GROUP BY survey_id",
    "unit_domains": """SELECT a.survey_id, a.question_id, a.fy, u.unit, COALESCE(x.domain_override, x.domain) AS domain_goals
FROM answers_f a LEFT JOIN unit_by_survey u ON u.survey_id = a.survey_id LEFT JOIN rules x ON x.question_id = a.question_id""",
    "legacy_all": f"""SELECT g.svc_cde, g.goal_yr, g.service_line, g.unit, COALESCE(t.domain, g.domain) AS domain, g.goal, {_PARSE}
FROM goals_old g LEFT JOIN domain_translation t ON t.goals_domain = g.domain""",
    "legacy_1998": f"SELECT *, {_PARSE} FROM goals_old WHERE goal_yr = 1998",
    "line_all_goal": f"""SELECT rec_fy, domain_goals, CASE WHEN goal = 0.0 THEN CAST(NULL AS DECIMAL(4,3)) ELSE goal END AS goal
FROM cascade WHERE service_line = {_LINE} AND goal_epic_department_id = 'All Units'""",
    "scored_g": """SELECT s.*, COALESCE(g.group_id, 0) AS group_id, COALESCE(g.group_name, 'Other') AS group_name
FROM scored s LEFT JOIN dept_groups g ON g.department_id = s.epic_department_id""",
    "dd_src": """SELECT a.survey_id, a.question_id, a.received_date, a.discharge_date,
       CASE WHEN list_contains(x.top_values, a.value) THEN 1 ELSE 0 END AS top_box
FROM answers_f a LEFT JOIN rules x ON x.question_id = a.question_id""",
})
ORACLE["q_goal_cascade"] = _v("SELECT * FROM cascade")
ORACLE["q_goal_cascade_group"] = _v(f"""SELECT DISTINCT * FROM (
  SELECT k.rec_fy, k.service_line, k.goal_epic_department_id, k.domain_goals,
         CASE WHEN g.domain IS NULL THEN ga.goal ELSE g.goal END AS goal, k.group_name
  FROM (SELECT DISTINCT rec_fy, service_line, goal_epic_department_id, domain_goals, group_name FROM scored_g) k
  LEFT JOIN (SELECT * FROM child_goals WHERE epic_department_id <> 'All Units') g
    ON g.goal_fiscal_yr = k.rec_fy AND g.epic_department_id = k.goal_epic_department_id AND g.domain = k.domain_goals
  LEFT JOIN (SELECT * FROM child_goals WHERE epic_department_id = 'All Units' AND service_line = {_LINE}) ga
    ON ga.goal_fiscal_yr = k.rec_fy AND ga.domain = k.domain_goals
  UNION ALL
  SELECT k.rec_fy, k.service_line, 'All Units', k.domain_goals, ga.goal, 'All Groups'
  FROM (SELECT DISTINCT rec_fy, service_line, domain_goals FROM scored_g) k
  LEFT JOIN (SELECT * FROM child_goals WHERE epic_department_id = 'All Units' AND service_line = {_LINE}) ga
    ON ga.goal_fiscal_yr = k.rec_fy AND ga.domain = k.domain_goals
  UNION ALL
  SELECT g.goal_fiscal_yr, 'All Service Lines', 'All Units', g.domain, g.goal, 'All Groups'
  FROM child_goals g JOIN (SELECT DISTINCT rec_fy FROM scored) y ON g.goal_fiscal_yr = y.rec_fy
  WHERE g.epic_department_id = 'All Units' AND g.service_line = 'All Service Lines'
  UNION ALL
  SELECT k.rec_fy, k.service_line, 'All Units', k.domain_goals, ga.goal, k.group_name
  FROM (SELECT DISTINCT rec_fy, service_line, group_name, domain_goals FROM scored_g) k
  LEFT JOIN (SELECT * FROM child_goals WHERE epic_department_id = 'All Units') ga
    ON ga.goal_fiscal_yr = k.rec_fy AND ga.service_line = {_LINE} AND ga.domain = k.domain_goals)""")
ORACLE["q_parse_unit_label"] = _v(f"SELECT DISTINCT unit, {_PARSE} FROM goals_old")
_LEG_COLS = "svc_cde, goal_yr AS goal_fiscal_yr, service_line, CAST(NULL AS VARCHAR) AS unit, {id} AS epic_department_id, epic_department_name, domain, CAST(goal AS DECIMAL(4,3)) AS goal"
ORACLE["q_goals_legacy"] = _v(f"""
SELECT DISTINCT {_LEG_COLS.format(id='epic_department_id')}, 'unit' AS level FROM legacy_1998
WHERE unit <> 'All Units' AND domain IS NOT NULL AND goal IS NOT NULL
UNION ALL SELECT DISTINCT {_LEG_COLS.format(id="'All Units'")}, 'line' FROM legacy_1998
WHERE unit = 'All Units' AND service_line <> 'All Service Lines' AND domain IS NOT NULL
UNION ALL SELECT DISTINCT {_LEG_COLS.format(id="'All Units'")}, 'all_lines' FROM legacy_1998
WHERE unit = 'All Units' AND service_line = 'All Service Lines' AND domain IS NOT NULL""")
_EXT.update({
    "leg_k": """SELECT DISTINCT e.rec_fy, lm.service_line, e.department_id AS goal_unit,
                  COALESCE(x.domain_override, x.domain) AS domain_goals
           FROM survey_dept e JOIN answers_f a ON a.survey_id = e.survey_id
           LEFT JOIN rules x ON x.question_id = a.question_id
           LEFT JOIN location_master lm ON lm.department_id = e.department_id""",
    "leg_ug": "SELECT DISTINCT * FROM legacy_all WHERE unit <> 'All Units' AND domain IS NOT NULL AND goal IS NOT NULL",
    "leg_lg": "SELECT DISTINCT * FROM legacy_all WHERE unit = 'All Units' AND service_line <> 'All Service Lines' AND domain IS NOT NULL",
})
ORACLE["q_goal_legacy"] = _v("""
SELECT k.*, NULLIF(CAST(ug.goal AS DECIMAL(4,3)), 0) AS goal FROM leg_k k
LEFT JOIN leg_ug ug ON ug.goal_yr = k.rec_fy AND ug.service_line = k.service_line
  AND ug.epic_department_id = k.goal_unit AND ug.domain = k.domain_goals
WHERE EXISTS (SELECT 1 FROM leg_ug x WHERE x.service_line = k.service_line AND x.epic_department_id = k.goal_unit)
UNION ALL
SELECT k.*, NULLIF(CAST(lg.goal AS DECIMAL(4,3)), 0) FROM leg_k k
LEFT JOIN leg_lg lg ON lg.goal_yr = k.rec_fy AND lg.service_line = k.service_line AND lg.domain = k.domain_goals
WHERE NOT EXISTS (SELECT 1 FROM leg_ug x WHERE x.service_line = k.service_line AND x.epic_department_id = k.goal_unit)""")
ORACLE["q_goal_mapping"] = _v(f"""SELECT DISTINCT s.rec_fy AS response_received_fy, s.epic_department_id AS response_department_id,
       s.epic_department_name AS response_department_name,
       CASE WHEN g.domain IS NULL THEN 'All Units' ELSE s.goal_epic_department_id END AS goals_department_id,
       CASE WHEN g.domain IS NULL THEN 'All Units' ELSE n.name END AS goals_department_name,
       s.domain_goals AS goals_domain, CASE WHEN g.domain IS NULL THEN ga.goal ELSE g.goal END AS goal
FROM scored s
LEFT JOIN (SELECT * FROM child_goals WHERE epic_department_id <> 'All Units') g
  ON g.goal_fiscal_yr = s.rec_fy AND g.epic_department_id = s.goal_epic_department_id AND g.domain = s.domain_goals
LEFT JOIN (SELECT * FROM child_goals WHERE epic_department_id = 'All Units' AND service_line = {_LINE}) ga
  ON ga.goal_fiscal_yr = s.rec_fy AND ga.domain = s.domain_goals
LEFT JOIN (SELECT epic_department_id, MAX(epic_department_name) AS name FROM scored GROUP BY 1) n
  ON n.epic_department_id = s.goal_epic_department_id
WHERE CASE WHEN g.domain IS NULL THEN ga.goal ELSE g.goal END IS NOT NULL AND s.goal_epic_department_id IS NOT NULL""")
ORACLE["q_vocabulary_diff"] = _v("""SELECT COALESCE(a.value, b.value) AS value, COALESCE(a.in_a, 0) AS in_a, COALESCE(b.in_b, 0) AS in_b
FROM (SELECT DISTINCT COALESCE(x.domain_override, x.domain) AS value, 1 AS in_a FROM responses r
      LEFT JOIN rules x ON x.question_id = r.question_id WHERE COALESCE(x.domain_override, x.domain) IS NOT NULL) a
FULL OUTER JOIN (SELECT DISTINCT domain AS value, 1 AS in_b FROM goal_settings WHERE domain IS NOT NULL) b ON a.value = b.value""")
ORACLE["q_rollup_units"] = _v("""SELECT survey_id, question_id, clinic, domain_goals, goal FROM scored_goal
UNION ALL
SELECT s.survey_id, s.question_id, CASE WHEN s.survey_id IS NOT NULL THEN 'All Units' END, s.domain_goals, ga.goal
FROM scored s LEFT JOIN line_all_goal ga ON ga.rec_fy = s.rec_fy AND ga.domain_goals = s.domain_goals""")
ORACLE["q_rollup_groups"] = _v("""
SELECT s.survey_id, s.question_id, s.clinic, CAST(s.group_id AS VARCHAR) AS group_id, s.group_name, s.domain_goals, g.goal FROM scored_g s
LEFT JOIN (SELECT DISTINCT rec_fy, goal_epic_department_id, service_line, domain_goals, goal
           FROM cascade WHERE goal_epic_department_id <> 'All Units') g
  ON g.rec_fy = s.rec_fy AND g.goal_epic_department_id = s.goal_epic_department_id
 AND g.service_line = s.service_line AND g.domain_goals = s.domain_goals
UNION ALL
SELECT s.survey_id, s.question_id, CASE WHEN s.survey_id IS NOT NULL THEN 'All Units' END, CAST(s.group_id AS VARCHAR), s.group_name, s.domain_goals, ga.goal
FROM scored_g s LEFT JOIN line_all_goal ga ON ga.rec_fy = s.rec_fy AND ga.domain_goals = s.domain_goals
UNION ALL
SELECT s.survey_id, s.question_id, CASE WHEN s.survey_id IS NOT NULL THEN 'All Units' END,
       CASE WHEN s.survey_id IS NOT NULL THEN 'All Groups' END,
       CASE WHEN s.survey_id IS NOT NULL THEN 'All Groups' END, s.domain_goals, ga.goal
FROM scored_g s LEFT JOIN line_all_goal ga ON ga.rec_fy = s.rec_fy AND ga.domain_goals = s.domain_goals""")
_EXT["line_frame"] = "SELECT d.*, COALESCE(m.service_line, 'Other') AS service_line FROM unit_domains d LEFT JOIN unit_mapping m ON m.unit_name = d.unit"
ORACLE["q_rollup_lines"] = _v("""
SELECT f.survey_id, f.question_id, f.fy, f.service_line, f.domain_goals, g.goal FROM line_frame f
LEFT JOIN (SELECT * FROM adult_goals WHERE epic_department_id = 'All Units' AND service_line <> 'All Service Lines') g
  ON g.goal_fiscal_yr = f.fy AND g.service_line = f.service_line AND g.domain = f.domain_goals
UNION ALL
SELECT f.survey_id, f.question_id, f.fy, CASE WHEN f.survey_id IS NOT NULL THEN 'All Service Lines' END, f.domain_goals, g.goal
FROM line_frame f
LEFT JOIN (SELECT * FROM adult_goals WHERE epic_department_id = 'All Units' AND service_line = 'All Service Lines') g
  ON g.goal_fiscal_yr = f.fy AND g.domain = f.domain_goals""")


def _dd(dis_lo: str | None, full: bool, where: str = "TRUE") -> str:
    return _v(f"""SELECT survey_id, question_id, received_date, discharge_date, top_box, rpt_prd, event_date, event_fy, quarter_name,
       month_short_name, event_date_disch FROM {report_days('dd_src', DEFAULT.start, DEFAULT.end, dis_lo, full)} WHERE {where}""")


ORACLE["q_dual_date_left"] = _dd(None, False)
ORACLE["q_dual_date_full"] = _dd(DEFAULT.start, True)
ORACLE["q_dual_date_inner"] = _dd(DEFAULT.start, False, "survey_id IS NOT NULL AND event_date_disch IS NOT NULL")
_EXT["clinic_lines"] = """SELECT DISTINCT s.clinic, m.service_line FROM
  (SELECT DISTINCT survey_id, unit, CASE WHEN department_name IS NOT NULL THEN department_name || ' [' || trim(department_id) || ']'
                                         ELSE 'Unknown [' || trim(department_id) || ']' END AS clinic FROM survey_dept) s
  LEFT JOIN unit_mapping m ON m.unit_name = s.unit"""
_EXT["shared_cl"] = """SELECT clinic, COUNT(DISTINCT service_line) AS n_distinct FROM clinic_lines WHERE clinic <> 'All Units'
GROUP BY clinic HAVING COUNT(DISTINCT service_line) > 1"""
ORACLE["q_shared_clinic_suffix"] = _v("""SELECT f.clinic, f.service_line,
       CASE WHEN f.clinic IN (SELECT clinic FROM shared_cl) THEN f.clinic || ' - ' || f.service_line ELSE f.clinic END AS clinic_label,
       sh.n_distinct
FROM clinic_lines f LEFT JOIN shared_cl sh ON sh.clinic = f.clinic""")

# -- labels, enrichment, reports, audits, benchmarks ---------------------------------
from boxscore.sources.tables import FIXED_LOAD_DTM  # noqa: E402


def _pct(t: str, n: str) -> str:
    return (f"CAST(CASE WHEN {n} = 0 THEN NULL ELSE CAST((200000000 * {t} + {n}) // (2 * {n}) AS DECIMAL(18,0)) "
            f"* CAST(0.000001 AS DECIMAL(7,6)) END AS DECIMAL(12,6))")


def _clinic2(loc, lid, name, did, unknown="Unknown"):
    return (f"CASE WHEN {loc} IS NOT NULL AND {loc} <> 'Unknown' THEN {loc} || ' [' || {lid} || ']' "
            f"WHEN {name} IS NOT NULL THEN {name} || ' [' || {did} || ']' ELSE '{unknown} [' || {did} || ']' END")


def _clinic(name, did):
    return (f"CASE WHEN {name} IS NOT NULL THEN {name} || ' [' || trim({did}) || ']' "
            f"ELSE 'Unknown [' || trim({did}) || ']' END")


_V12 = "CASE WHEN {0} IS NULL OR {0} = 'Unknown' THEN 'Other' ELSE {0} END"
_F8 = "domain_goals IS NOT NULL AND domain_goals NOT IN ('Meals', 'Overall Assessment', 'Pediatric ICU/CCU', 'Personal Issues')"
_LOAD = f"CAST('{FIXED_LOAD_DTM}' AS TIMESTAMP)"

_EXT.update({
    "dept_frame": """SELECT k.department_key, d.department_id, d.department_name, d.external_name,
       lm.department_name AS loc_name, lm.service_line, lm.sub_service_line
FROM (SELECT DISTINCT department_key FROM responses) k
LEFT JOIN departments d ON d.department_key = k.department_key
LEFT JOIN location_master lm ON lm.department_id = d.department_id""",
    "sub_sl": """SELECT department_id, MAX(CASE WHEN sub_service_line = 'Unknown' OR sub_service_line IS NULL THEN NULL
                                  ELSE sub_service_line END) AS sub_service_line
FROM location_master GROUP BY department_id""",
    "rs_a": "SELECT * FROM answers_f WHERE department_key > 0",
    "rs_unit": "SELECT survey_id, MAX(COALESCE(value, 'Null Unit')) AS unit FROM rs_a WHERE question_id = 7 GROUP BY survey_id",
    "rs_rows": f"""SELECT DISTINCT d.department_id, d.department_name, u.unit, x.domain, a.question_id,
       {rpt_prd('a.received_date')} AS rpt_prd, a.received_date AS event_date, a.discharge_date AS event_date_disch,
       c.quarter_name, c.month_short_name
FROM rs_a a JOIN calendar c ON c.day_date = a.received_date
LEFT JOIN departments d ON d.department_key = a.department_key
JOIN rules x ON x.question_id = a.question_id AND x.domain IS NOT NULL
LEFT JOIN rs_unit u ON u.survey_id = a.survey_id""",
    "loc_rows": """SELECT s.*, d.department_id AS epic_department_id, d.department_name AS epic_department_name,
       d.external_name, lm.department_name AS loc_name, lm.external_name AS loc_external_name, lm.service_line AS loc_service_line
FROM (SELECT DISTINCT survey_id, resolved_department_key, unit FROM sud) s
LEFT JOIN departments d ON d.department_key = s.resolved_department_key
LEFT JOIN location_master lm ON lm.department_id = d.department_id""",
    "scored_g_goal": """SELECT s.*, COALESCE(g.group_id, 0) AS group_id, COALESCE(g.group_name, 'Other') AS group_name
FROM scored_goal s LEFT JOIN dept_groups g ON g.department_id = s.epic_department_id""",
    "mp_arms": """SELECT group_name, clinic, domain_goals, question_id, top_box, goal, received_date FROM scored_g_goal
UNION ALL SELECT group_name, 'All Units', domain_goals, question_id, top_box, goal_all, received_date FROM scored_g_goal
UNION ALL SELECT 'All Groups', 'All Units', domain_goals, question_id, top_box, goal_all, received_date FROM scored_g_goal""",
    "mp_src": """SELECT s.*, c.month_short_name AS m_short, c.month_key FROM mp_arms s
LEFT JOIN calendar c ON c.day_date = s.received_date WHERE s.domain_goals IS NOT NULL""",
    "monthly": f"""SELECT group_name, clinic, domain_goals, question_id, m_short AS month_short_name, month_key,
       COUNT(*) AS n, CAST(SUM(top_box) AS BIGINT) AS top_box, MAX(goal) AS goal, {_pct('SUM(top_box)', 'COUNT(*)')} AS score
FROM mp_src GROUP BY group_name, clinic, domain_goals, question_id, m_short, month_key""",
    "question_ranks": """SELECT CAST(CASE t.band WHEN 0 THEN 0 WHEN 5 THEN 100 ELSE t.band * 20 + (p.fy % 3) * 5 - 5 END AS DECIMAL(4,1)) AS value,
       x.domain, CAST(p.question_id AS VARCHAR) AS question_id, CAST(t.band * 20 AS INTEGER) AS percentile_rank,
       make_date(p.fy - 1, 7, 1) AS period_begin, make_date(p.fy, 6, 30) AS period_end, x.question_text_alias
FROM (SELECT DISTINCT question_id, fy FROM responses) p
JOIN rules x ON x.question_id = p.question_id AND x.scale IS NOT NULL, range(0, 6) t(band)""",
    "ranks": """SELECT * FROM question_ranks
UNION ALL SELECT DISTINCT value, domain, 'Domain', percentile_rank, period_begin, period_end, CAST(NULL AS VARCHAR) FROM question_ranks""",
    "bands": """SELECT * EXCLUDE (seq) FROM (
  SELECT r.*, CASE WHEN value = 100.0 THEN CAST(100.1 AS DECIMAL(4,1))
                   ELSE LEAD(value) OVER (PARTITION BY domain, question_id ORDER BY period_end, value) END AS next_value,
         ROW_NUMBER() OVER (PARTITION BY domain, question_id, value ORDER BY period_end DESC) AS seq
  FROM ranks r WHERE question_id <> 'Domain') WHERE seq = 1""",
    "ext_rows": unit_report(DEFAULT),
})

ORACLE["q_star_enrich"] = _v("""SELECT r.survey_id, r.question_id, q.varname, acc.mrn, p.last_name, p.first_name,
       ph.display_name, ph.npi
FROM responses r JOIN questions q ON q.question_id = r.question_id
LEFT JOIN accounts acc ON acc.account_key = r.account_key
LEFT JOIN patients p ON p.patient_key = r.patient_key
LEFT JOIN physicians ph ON ph.physician_key = r.physician_key""")
ORACLE["q_clinic_label"] = _v(f"""SELECT department_key, department_id, {_clinic('department_name', 'department_id')} AS clinic,
       {_clinic2('loc_name', 'department_id', 'department_name', 'department_id')} AS clinic_master,
       CASE WHEN loc_name IS NULL OR loc_name = 'Unknown' THEN 'Other' ELSE loc_name || ' [' || department_id || ']' END AS clinic_outpatient
FROM dept_frame""")
ORACLE["q_service_line"] = _v(f"""SELECT f.department_key, f.department_id, {_V12.format('f.service_line')} AS service_line,
       s.sub_service_line, {line_display(_V12.format('f.service_line'), 's.sub_service_line')} AS service_line_display
FROM dept_frame f LEFT JOIN sub_sl s ON s.department_id = f.department_id""")
ORACLE["q_sub_service_line"] = _v("SELECT * FROM sub_sl")
ORACLE["q_response_summary"] = _v(f"""SELECT {line_display(_q(DEFAULT.service_line), _q(DEFAULT.sub_service_line))} AS service_line,
       {_clinic('department_name', 'department_id')} AS clinic, department_id AS epic_department_id, domain, question_id,
       rpt_prd, event_date, event_date_disch, quarter_name, month_short_name, {_LOAD} AS load_dtm
FROM rs_rows""")
ORACLE["q_locations"] = _v(f"""SELECT DISTINCT {_V12.format('loc_service_line')} AS service_line,
       {_clinic2('loc_name', 'epic_department_id', 'epic_department_name', 'epic_department_id')} AS clinic,
       epic_department_id, {_LOAD} AS load_dtm
FROM loc_rows""")
ORACLE["q_location_external"] = _v(f"""SELECT DISTINCT {_V12.format('loc_service_line')} AS service_line,
       CASE WHEN loc_name IS NOT NULL AND loc_name <> 'Unknown' THEN loc_external_name ELSE external_name END AS clinic,
       epic_department_id, {_LOAD} AS load_dtm
FROM loc_rows""")
ORACLE["q_goal_by_line"] = _v("""SELECT f.*, g.goal FROM line_frame f
LEFT JOIN (SELECT * FROM adult_goals WHERE epic_department_id = 'All Units' AND service_line <> 'All Service Lines') g
  ON g.goal_fiscal_yr = f.fy AND g.service_line = f.service_line AND g.domain = f.domain_goals""")
ORACLE["q_goal_by_unit"] = _v("""SELECT e.survey_id, a.question_id, e.rec_fy, e.department_id AS epic_department_id,
       COALESCE(x.domain_override, x.domain) AS domain_goals, CAST(ug.goal AS DECIMAL(4,3)) AS goal
FROM (SELECT DISTINCT survey_id, department_id, department_name, goal_department_id, rec_fy, unit FROM survey_dept) e
JOIN answers_f a ON a.survey_id = e.survey_id
LEFT JOIN rules x ON x.question_id = a.question_id
LEFT JOIN leg_ug ug ON ug.goal_yr = e.rec_fy AND ug.epic_department_id = e.department_id
 AND ug.domain = COALESCE(x.domain_override, x.domain)""")
ORACLE["q_assignment_audit"] = _v("""SELECT s.department_key, s.enc_department_key, s.dep_department_key,
       s.resolved_department_key, s.unit, s.der_unit, COUNT(*) AS n, CAST(SUM(t.top_box) AS BIGINT) AS top_box
FROM dd_src t JOIN sud s ON s.survey_id = t.survey_id
GROUP BY s.department_key, s.enc_department_key, s.dep_department_key, s.resolved_department_key, s.unit, s.der_unit""")
ORACLE["q_surveys_by_unit"] = _v("""SELECT a.service_code, a.department_key, d.department_id AS epic_department_id,
       d.department_name AS epic_department_name, u.unit, COALESCE(n.current_unit, u.unit) AS der_unit, COUNT(DISTINCT a.survey_id) AS n_surveys
FROM answers_f a LEFT JOIN unit_by_survey u USING (survey_id) LEFT JOIN unit_aliases n ON n.unit_name = u.unit
LEFT JOIN departments d USING (department_key) GROUP BY ALL""")
_EXT["audited"] = """SELECT a.survey_id, c.fyear_num AS rec_fy, c.month_num, c.month_name, c.year_num, a.designator, s.unit, s.der_unit,
       own.department_name AS assigned_department_name, mapped.department_name AS derived_department_name,
       shown.department_name AS dashboard_department_name, CAST(COALESCE(list_contains(x.top_values, a.value), FALSE) AS INTEGER) AS top_box,
       CAST(a.value IS NOT NULL AS INTEGER) AS val_count
FROM answers_f a JOIN calendar c ON c.day_date = a.received_date LEFT JOIN rules x USING (question_id)
LEFT JOIN (SELECT DISTINCT survey_id, account_key, department_key, unit, der_unit, dep_department_key FROM sud) s
  ON s.survey_id = a.survey_id AND s.account_key = a.account_key AND s.department_key IS NOT DISTINCT FROM a.department_key
LEFT JOIN departments own ON own.department_key = a.department_key LEFT JOIN departments mapped ON mapped.department_key = s.dep_department_key
LEFT JOIN departments shown ON shown.department_key = COALESCE(s.dep_department_key, a.department_key)"""
ORACLE["q_survey_audit"] = _v("""SELECT year_num, month_num, month_name, designator, unit, der_unit, assigned_department_name, derived_department_name,
       dashboard_department_name, COUNT(*) AS survey_count, CAST(SUM(top_box) AS BIGINT) AS top_box, CAST(SUM(val_count) AS BIGINT) AS val_count
FROM (SELECT * EXCLUDE (top_box, val_count), SUM(top_box) AS top_box, SUM(val_count) AS val_count FROM audited GROUP BY ALL) GROUP BY ALL""")
ORACLE["q_clinic_year_check"] = _v("""SELECT clinic, rec_fy, COUNT(*) AS n, CAST(SUM(top_box) AS BIGINT) AS top_box
FROM scored WHERE question_id = 2 GROUP BY clinic, rec_fy""")
ORACLE["q_report_dimension"] = _v(f"""SELECT {_q(DEFAULT.event_type)} AS event_type, rec_fy AS event_fy, year_num AS event_cy,
       month_num AS month, month_short_name AS month_name, service_line, epic_department_id AS department_id,
       epic_department_name AS department_name, domain_goals, question_id, question_text_alias
FROM (SELECT DISTINCT s.fy, s.rec_fy, c.quarter_name, c.month_num, c.month_short_name, c.year_num, s.department_key,
             s.epic_department_id, s.epic_department_name, s.goal_epic_department_id, s.service_line_id, s.service_line,
             s.sub_service_line, s.unit, s.clinic, s.domain, s.domain_goals, s.question_id, s.question_text, s.question_text_alias
      FROM scored s LEFT JOIN calendar c ON c.day_date = s.received_date
      WHERE {_F8} AND rec_fy >= 1997)""")
ORACLE["q_value_distribution"] = _v("SELECT clinic, question_id, value, COUNT(*) AS n FROM scored GROUP BY clinic, question_id, value")
ORACLE["q_response_report"] = _v(f"""SELECT e.event_type, e.event_fy, c.year_num AS event_cy, c.month_num AS month,
       c.month_short_name AS month_name, e.service_line, e.epic_department_id AS department_id, d.department_name, e.clinic,
       e.domain_goals, e.question_text_alias, e.goal, CAST(SUM(e.top_box) AS BIGINT) AS top_box,
       CAST(SUM(e.val_count) AS BIGINT) AS val_count, COUNT(DISTINCT e.survey_id) AS n
FROM ext_rows e LEFT JOIN calendar c ON c.day_date = e.event_date
LEFT JOIN departments d ON d.department_id = e.epic_department_id
WHERE {_F8}
GROUP BY e.event_type, e.event_fy, c.year_num, c.month_num, c.month_short_name, e.service_line, e.epic_department_id,
         d.department_name, e.clinic, e.domain_goals, e.question_text_alias, e.goal""")
ORACLE["q_question_summary"] = _v(f"""SELECT rec_fy, month_num, month_short_name, service_line, epic_department_id, clinic,
       question_id, question_text_alias, domain_goals, goal,
       CAST(SUM(top_box) AS BIGINT) AS top_box, CAST(SUM(val_count) AS BIGINT) AS val_count,
       COUNT(DISTINCT survey_id) AS n_surveys
FROM (SELECT s.*, c.month_num, c.month_short_name FROM scored_goal s LEFT JOIN calendar c ON c.day_date = s.received_date)
WHERE {_F8}
GROUP BY rec_fy, month_num, month_short_name, service_line, epic_department_id, clinic, question_id, question_text_alias,
         domain_goals, goal""")
ORACLE["q_monthly_percent"] = _v("SELECT * FROM monthly")
ORACLE["q_rescore"] = _v(f"""SELECT group_name, clinic, domain_goals, question_id, CAST(SUM(n) AS BIGINT) AS n,
       CAST(SUM(top_box) AS BIGINT) AS top_box, {_pct('SUM(top_box)', 'SUM(n)')} AS score
FROM monthly GROUP BY group_name, clinic, domain_goals, question_id""")
ORACLE["q_percentile_bands"] = _v("SELECT * FROM bands")
ORACLE["q_percentile_lookup"] = _v("""SELECT m.*, b.percentile_rank FROM monthly m
LEFT JOIN bands b ON CAST(b.question_id AS INTEGER) = m.question_id AND m.score >= b.value AND m.score < b.next_value
WHERE m.question_id = 2""")

# -- extract variants ------------------------------------------------------------
from boxscore.plans import lines as _lines  # noqa: E402
from boxscore.plans import surveys as _surveys  # noqa: E402

_EXT.update(line_views())
_EXT.update(typed_views(_surveys.ADULT_CFG))
ORACLE["q_line_extract"] = _v(line_report(_lines.LINE_CFG, "placed_goal"))
ORACLE["q_child_extract"] = _v(line_report(_lines.CHILD_CFG, "placed_flat", clipped=False))
ORACLE["q_child_extract_unit_suffix"] = _v(line_report(_lines.CHILD_CFG, "placed_flat", key="unit"))
ORACLE["q_clinic_extract"] = _v(clinic_report(_surveys.CLINIC_CFG))
ORACLE["q_adult_extract"] = _v(survey_report(_surveys.ADULT_CFG, "in_line_goal", "line"))
ORACLE["q_adult_extract_unit"] = _v(survey_report(_surveys.ADULT_CFG, "in_unit_goal", "unit"))
ORACLE["q_without_flagged"] = _v(unflagged_report(_surveys.ADULT_CFG))
ORACLE["q_child_extract_by_unit"] = _v(survey_report(_surveys.CHILD_CFG, "pd_unit_goal", "unit", ", top_box_response"))
ORACLE["q_child_extract_by_line"] = _v(survey_report(_surveys.CHILD_CFG, "pd_line_goal", "line", ", top_box_response"))
ORACLE["q_flat_goals"] = _v("SELECT * FROM flat_goals")
for _name, _service, _type in (("all_child", "PD", "child"), ("all_adult", "IN", "adult"), ("all_clinic", "MD", "clinic")):
    _EXT[f"{_name}_raw"] = f"SELECT * FROM responses WHERE service_code = '{_service}'"
    # every stored answer counts, so repeated rows stay
    _EXT[_name] = (detail_sql(f"{_name}_raw", DEFAULT, _type).replace("SELECT DISTINCT", "SELECT", 1))
ORACLE["q_survey_scales"] = _v("""SELECT r.service_code, r.question_id, r.value, r.value_resp_grp, r.top_box_response, r.top_box, r.domain_goals, count(*) AS n
FROM (SELECT * FROM all_child UNION ALL SELECT * FROM all_adult UNION ALL SELECT * FROM all_clinic) r GROUP BY ALL""")
ORACLE["q_unit_extract_group"] = _v(unit_report(DEFAULT, groups=True))
ORACLE["q_designator_from_log"] = _v(f"""SELECT r.survey_id, r.question_id, r.received_date, l.designator
FROM responses r
LEFT JOIN (SELECT survey_id, substring(value, 1, 2) AS designator FROM (
             SELECT *, ROW_NUMBER() OVER (PARTITION BY survey_id, value ORDER BY load_dtm DESC, log_id DESC) AS seq
             FROM designator_log) WHERE seq = 1) l ON l.survey_id = r.survey_id
WHERE r.question_id IN (1, 2, 3, 4, 5, 6, 7)
  AND r.received_date BETWEEN DATE '{DEFAULT.start}' AND DATE '{DEFAULT.end}'
  AND (l.designator IS NULL OR l.designator = 'PC')""")
ORACLE["q_response_summary_group"] = _v(f"""SELECT {line_display(_q(DEFAULT.service_line), _q(DEFAULT.sub_service_line))} AS service_line,
       {_clinic('r.department_name', 'r.department_id')} AS clinic, r.department_id AS epic_department_id, r.domain,
       r.question_id, r.rpt_prd, r.event_date, r.event_date_disch, r.quarter_name, r.month_short_name,
       COALESCE(g.group_name, 'Other') AS department_group_name, {_LOAD} AS load_dtm
FROM rs_rows r LEFT JOIN dept_groups g ON g.department_id = r.department_id""")
ORACLE["q_department_audit"] = _v("SELECT DISTINCT * EXCLUDE (top_box, val_count) FROM audited")
ORACLE["q_response_summary_mapped"] = _v(f"""SELECT DISTINCT {line_display(_q(DEFAULT.service_line), _q(DEFAULT.sub_service_line))} AS service_line,
       {_clinic2('m.department_name', 'd.department_id', 'd.department_name', 'd.department_id')} AS clinic, d.department_id AS epic_department_id,
       x.domain, a.question_id, {rpt_prd('a.received_date')} AS rpt_prd, a.received_date AS event_date, a.discharge_date AS event_date_disch,
       c.quarter_name, c.month_short_name, {_LOAD} AS load_dtm
FROM answers_f a JOIN rules x USING (question_id)
LEFT JOIN sud s ON s.survey_id = a.survey_id AND s.account_key = a.account_key AND s.department_key IS NOT DISTINCT FROM a.department_key
LEFT JOIN departments d ON d.department_key = s.resolved_department_key LEFT JOIN location_master m ON m.department_id = d.department_id
LEFT JOIN calendar c ON c.day_date = a.received_date WHERE x.domain IS NOT NULL""")
ORACLE["q_load_locations"] = ORACLE["q_locations"]
ORACLE["q_load_response_summary"] = ORACLE["q_response_summary"].replace(
    "rpt_prd, event_date, event_date_disch, quarter_name, month_short_name,",
    "rpt_prd, CAST(event_date AS TIMESTAMP) AS event_date, CAST(event_date_disch AS TIMESTAMP) AS event_date_disch, quarter_name, month_short_name,")
from boxscore.registry import ROLLING as _ROLLING  # noqa: E402

ORACLE["q_unit_extract_rolling"] = with_views(unit_report(_ROLLING, "roll_"), {**_EXT, **extract_views(_ROLLING, "roll_")})
