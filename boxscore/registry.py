"""

Each entry takes (spark, sf_dir) and returns a lazy DataFrame over the
whole given tables.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from boxscore.functions import calendar as C
from boxscore.functions import labels as V
from boxscore.functions import scoring as S
from boxscore.operators import aggregations as A
from boxscore.operators import benchmarks as B
from boxscore.operators import departments as D
from boxscore.operators import filters as Fl
from boxscore.operators import goals as G
from boxscore.operators import joins as J
from boxscore.operators import report_dates as RD
from boxscore.operators import rollups as U
from boxscore.operators import windows as W
from boxscore.operators.ordering import by_count_within, report_order
from boxscore.plans import extract, lines, summaries, surveys
from boxscore.plans.config import DEFAULT, ExtractConfig
from boxscore.plans.summaries import with_month
from boxscore.sources import lookups as L
from boxscore.sources import sinks as SK
from boxscore.sources.tables import Inputs

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def register(name: str):
    def deco(fn):
        QUERIES[name] = lambda spark, sf_dir: fn(Inputs.for_dir(spark, sf_dir))
        return fn
    return deco


@register("q_score_summary")
def q_score_summary(inp: Inputs) -> DataFrame:
    return summaries.score_summary(inp, DEFAULT)


@register("q_unit_extract")
def q_unit_extract(inp: Inputs) -> DataFrame:
    return extract.unit_extract(inp, DEFAULT)


# ---------------------------------------------------------------------------
# Scans, sources, filters (S*, F*)
# ---------------------------------------------------------------------------


@register("q_scan_responses")
def q_scan_responses(inp):
    return inp.responses.select("survey_id", "question_id", "received_date", "value")


@register("q_age_per_survey")
def q_age_per_survey(inp):
    return W.max_answer(inp.responses, L.AGE_QUESTION, "age")


@register("q_domain_translation")
def q_domain_translation(inp):
    dm = L.domain_translation(inp.spark).select(F.col("goals_domain").alias("__gd"), F.col("domain").alias("__td"))
    s = inp.goal_settings
    return (s.join(dm, s["domain"] == dm["__gd"], "left")
            .select("service", "goal_yr", "department_id", "unit", "domain",
                    F.coalesce("__td", "domain").alias("domain_goals")))


@register("q_goals_conformed")
def q_goals_conformed(inp):
    # the ETL itself: computed from the goal settings, not read from the stored tables
    return inp.load_child_goals().unionByName(inp.load_adult_goals())


@register("q_date_spine")
def q_date_spine(inp):
    return C.spine_over(inp.responses, "received_date", "discharge_date")


@register("q_filter_questions")
def q_filter_questions(inp):
    # the list repeats ids, as the reference's does; repeats change nothing
    return Fl.for_questions(inp.responses, [1, 2, 3, 4, 5, 2, 3]).select("survey_id", "question_id", "value")


@register("q_filter_received")
def q_filter_received(inp):
    return Fl.received_between(inp.responses, DEFAULT.start, DEFAULT.end).select(
        "survey_id", "question_id", "received_date")


@register("q_filter_designator")
def q_filter_designator(inp):
    r = inp.responses.select("survey_id", "question_id",
                             Fl.designator_prefix(F.col("survey_designator")).alias("designator"))
    return Fl.designator_ok(r, "PC")


@register("q_default_window")
def q_default_window(inp):
    d = inp.responses.select(F.col("received_date").alias("as_of")).distinct()
    ws, we = C.default_window_cols(F.col("as_of"))
    rs, re_ = C.default_report_window_cols(F.col("as_of"))
    fixed, _ = C.default_report_window_cols(F.col("as_of"), start=DEFAULT.start)
    return d.select("as_of", ws.alias("window_start"), we.alias("window_end"),
                    rs.alias("report_start"), re_.alias("report_end"), fixed.alias("fixed_report_start"))


ROLLING = ExtractConfig.rolling("1998-08-15")


@register("q_unit_extract_rolling")
def q_unit_extract_rolling(inp):
    """P1 over the default window (F4) of an as-of date."""
    return extract.unit_extract(inp, ROLLING)


@register("q_filter_either_date")
def q_filter_either_date(inp):
    return Fl.received_or_discharged_since(inp.responses, "2000-01-01").select(
        "survey_id", "question_id", "received_date", "discharge_date")


@register("q_filter_known_dept")
def q_filter_known_dept(inp):
    return Fl.known_department(inp.responses).select("survey_id", "question_id", "department_key")


@register("q_filter_service")
def q_filter_service(inp):
    return Fl.for_service(inp.responses, "IN").select("survey_id", "question_id", "service_code")


@register("q_filter_recent")
def q_filter_recent(inp):
    return Fl.discharged_within(inp.responses, 366, _dt.date(2001, 8, 1)).select(
        "survey_id", "question_id", "discharge_date")


def _ruled(inp):
    r = inp.responses.select("survey_id", "question_id", "value")
    return S.with_rules(r, inp.rules, extra=["domain"])


@register("q_reportable_domains")
def q_reportable_domains(inp):
    r = _ruled(inp).select("survey_id", "question_id", S.goal_domain().alias("domain_goals"))
    return Fl.reportable_domains(r)


@register("q_question_catalog")
def q_question_catalog(inp):
    return A.question_catalog(inp.responses, inp.questions, ["CH_1", "CH_2", "CH_3", "AGE", "UNIT"])


@register("q_top_box")
def q_top_box(inp):
    v = F.col("value")
    return _ruled(inp).select("survey_id", "question_id", S.as_text(v).alias("value"),
                              S.top_box(v).alias("top_box"), S.answered(v).alias("val_count"))


@register("q_top_box_label")
def q_top_box_label(inp):
    return _ruled(inp).select("question_id", S.top_box_label().alias("top_box_response")).distinct()


@register("q_response_group")
def q_response_group(inp):
    g = S.response_group(F.col("value"), F.col("question_id"), L.AGE_QUESTION)
    return (_ruled(inp).groupBy("question_id", "value", g.alias("value_resp_grp"))
            .agg(F.count(F.lit(1)).alias("n")))


@register("q_goal_domain")
def q_goal_domain(inp):
    return (_ruled(inp).groupBy("question_id", "domain", S.goal_domain().alias("domain_goals"))
            .agg(F.count(F.lit(1)).alias("n")))


@register("q_patient_attributes")
def q_patient_attributes(inp):
    surveys = inp.responses.select("survey_id", "patient_key", "received_date").distinct()
    age = W.max_answer(inp.responses, L.AGE_QUESTION, "pat_age_survey_answer")
    p = surveys.join(inp.patients, "patient_key", "left").join(age, "survey_id", "left")
    return p.select("survey_id", "patient_key", "received_date",
                    V.full_name(F.col("last_name"), F.col("first_name")).alias("pat_name"),
                    V.age_years(F.col("birth_date"), F.lit(DEFAULT.as_of).cast("date")).alias("pat_age"),
                    V.age_years(F.col("birth_date"), F.col("received_date")).alias("pat_age_survey_recvd"),
                    "pat_age_survey_answer",
                    V.peds_flag(F.col("pat_age_survey_answer")).alias("peds"),
                    V.sex_label(F.col("sex")).alias("pat_sex"))


@register("q_period_label")
def q_period_label(inp):
    d = inp.responses.select(F.col("received_date").alias("event_date")).distinct()
    return d.select("event_date", C.period_label(F.col("event_date")).alias("rpt_prd"))


# ---------------------------------------------------------------------------
# Windows, departments, joins (W*, J*, R*)
# ---------------------------------------------------------------------------


@register("q_unit_spread")
def q_unit_spread(inp):
    r = inp.responses.select("survey_id", "question_id", "value")
    return W.spread_attribute(r, L.UNIT_QUESTION, "unit", L.NULL_UNIT)


@register("q_unit_per_survey")
def q_unit_per_survey(inp):
    r = inp.responses.select("survey_id", "question_id", "value")
    attr = r.where(F.col("question_id") == L.UNIT_QUESTION).select("survey_id", F.col("value").alias("unit"))
    return J.attach_survey_attribute(r, attr)


@register("q_first_encounter")
def q_first_encounter(inp):
    return W.first_encounter(inp.encounters)


@register("q_latest_designator")
def q_latest_designator(inp):
    return W.latest_designator(inp.designator_log)


@register("q_unit_recode")
def q_unit_recode(inp):
    unit = W.survey_attribute(inp.responses, L.UNIT_QUESTION, "unit", L.NULL_UNIT)
    return D.recode(unit, "unit", L.unit_aliases(inp.spark), "der_unit")


@register("q_dept_translation")
def q_dept_translation(inp):
    return extract.survey_departments(inp, extract.filtered_answers(inp, DEFAULT), DEFAULT)


@register("q_dept_by_unit")
def q_dept_by_unit(inp):
    s = lines.survey_unit_departments(inp, DEFAULT)
    return s.select("survey_id", "unit", "der_unit", "mapped_department_id", "dep_department_key").distinct()


@register("q_resolve_department")
def q_resolve_department(inp):
    s = lines.survey_unit_departments(inp, DEFAULT)
    return s.select("survey_id", "department_key", "unit", "der_unit", "goal_unit", "enc_department_key",
                    "dep_department_key", "resolved_department_key", "goal_department_key",
                    "goal_resolved_department_key")


@register("q_department_group")
def q_department_group(inp):
    s = extract.survey_departments(inp, extract.filtered_answers(inp, DEFAULT), DEFAULT)
    return J.with_group(s, L.department_groups(inp.spark)).select(
        "survey_id", "epic_department_id", "group_id", "group_name")


def _asked_departments(inp):
    """Departments and years of the surveys with their questions' goal domains."""
    a = S.with_rules(extract.filtered_answers(inp, DEFAULT), inp.rules, extra=["domain"])
    return extract.asked_departments(inp, a.withColumn("asked", F.struct(S.goal_domain().alias("domain_goals"))), DEFAULT)


def _survey_goal_keys(inp):
    """Distinct goal keys from the survey-department stage and the answered
    questions' goal domains (no answer-level detail needed)."""
    return _asked_departments(inp).select(
        "rec_fy", F.lit(DEFAULT.service_line).alias("service_line"), "epic_department_id",
        "goal_epic_department_id", "domain_goals").distinct()


def _specific(inp):
    return inp.child_goals.where(F.col("epic_department_id") != L.ALL_UNITS).select(
        F.col("goal_fiscal_yr").alias("rec_fy"), F.col("epic_department_id").alias("goal_epic_department_id"),
        F.col("domain").alias("domain_goals"), "goal")


@register("q_goal_anti")
def q_goal_anti(inp):
    return J.without_specific_goal(_survey_goal_keys(inp), _specific(inp),
                                   ["rec_fy", "goal_epic_department_id", "domain_goals"])


@register("q_goal_specific")
def q_goal_specific(inp):
    return J.with_specific_goal(_survey_goal_keys(inp), _specific(inp),
                                ["rec_fy", "goal_epic_department_id", "domain_goals"])


@register("q_goal_all_lines")
def q_goal_all_lines(inp):
    s = extract.survey_departments(inp, extract.filtered_answers(inp, DEFAULT), DEFAULT)
    g = inp.child_goals.where(F.col("service_line") == L.ALL_SERVICE_LINES)
    return J.in_loaded_years(g, s)


@register("q_zip_domains")
def q_zip_domains(inp):
    doms = S.with_rules(inp.responses.select("question_id"), inp.rules, extra=["domain"]).select(
        S.goal_domain().alias("response_domain")).where(F.col("response_domain").isNotNull())
    goals = inp.child_goals.select(F.col("domain").alias("goal_domain"))
    return J.zip_sorted(doms, "response_domain", goals, "goal_domain")


# ---------------------------------------------------------------------------
# Extract variants
# ---------------------------------------------------------------------------
@register("q_unit_extract_group")
def q_unit_extract_group(inp):
    return extract.unit_extract_groups(inp, DEFAULT)


@register("q_line_extract")
def q_line_extract(inp):
    return lines.line_extract(inp, lines.LINE_CFG)


@register("q_adult_extract")
def q_adult_extract(inp):
    return surveys.adult_extract(inp, by="line")


@register("q_adult_extract_unit")
def q_adult_extract_unit(inp):
    return surveys.adult_extract(inp, by="unit")


@register("q_child_extract_by_unit")
def q_child_extract_by_unit(inp):
    return surveys.child_extract(inp, by="unit")


@register("q_child_extract_by_line")
def q_child_extract_by_line(inp):
    return surveys.child_extract(inp, by="line")


@register("q_survey_scales")
def q_survey_scales(inp):
    """V1-V3 by survey type: how often each answer of a service's survey stands in which group."""
    kinds = F.create_map(*[F.lit(x) for t in (L.CHILD, L.ADULT, L.CLINIC) for x in (L.SERVICE_OF_TYPE[t], t)])
    a = inp.responses.select("service_code", "question_id", "value")
    a = S.with_survey_rules(a, L.survey_rules(inp.spark), F.element_at(kinds, F.col("service_code")))
    # an inner join to the question dimension: every question of the fact is in it
    return (a.join(F.broadcast(inp.questions.select("question_id")), "question_id")
            .groupBy("service_code", "question_id", "value", "value_resp_grp", "top_box_response", "top_box", "domain_goals")
            .agg(F.count(F.lit(1)).alias("n")))


@register("q_without_flagged")
def q_without_flagged(inp):
    return surveys.adult_without_flagged(inp)


@register("q_child_extract")
def q_child_extract(inp):
    return lines.child_extract(inp, lines.CHILD_CFG)


@register("q_clinic_extract")
def q_clinic_extract(inp):
    return surveys.clinic_extract(inp)


# ---------------------------------------------------------------------------
# Goals, roll-ups, report dates (G*, U*, J7, J8)
# ---------------------------------------------------------------------------


@register("q_goal_cascade")
def q_goal_cascade(inp):
    return extract.goal_cascade(inp, DEFAULT)


@register("q_goal_cascade_group")
def q_goal_cascade_group(inp):
    return extract.goal_cascade(inp, DEFAULT, groups=True)


def _unit_domains(inp):
    a = extract.filtered_answers(inp, DEFAULT)
    unit = W.survey_attribute(a, L.UNIT_QUESTION, "unit", L.NULL_UNIT)
    d = S.with_rules(a.select("survey_id", "question_id", "fy"), inp.rules, extra=["domain"])
    return d.join(unit, "survey_id", "left").select(
        "survey_id", "question_id", "fy", "unit", S.goal_domain().alias("domain_goals"))


@register("q_flat_goals")
def q_flat_goals(inp):
    return surveys.child_flat_goals(inp)


@register("q_parse_unit_label")
def q_parse_unit_label(inp):
    return G.parse_unit_label(inp.goals_old).select("unit", "epic_department_id", "epic_department_name").distinct()


@register("q_goals_legacy")
def q_goals_legacy(inp):
    return G.load_goals_legacy(inp.goals_old, 1998)


def _legacy_keys(inp):
    lm = inp.location_master.select(F.col("department_id").alias("epic_department_id"), "service_line")
    return (_asked_departments(inp).join(lm, "epic_department_id", "left")
            .select("rec_fy", "service_line", F.col("epic_department_id").alias("goal_unit"), "domain_goals")
            .distinct())


@register("q_goal_legacy")
def q_goal_legacy(inp):
    goals = G.load_goals_legacy(inp.goals_old, None, L.domain_translation(inp.spark))
    return G.resolve_goals_legacy(_legacy_keys(inp), goals)


@register("q_goal_mapping")
def q_goal_mapping(inp):
    keys = extract.goal_key_rows(inp, DEFAULT)
    return G.goal_mapping(keys, G.goals_by_arm(keys, inp.child_goals, DEFAULT.service_line))


@register("q_vocabulary_diff")
def q_vocabulary_diff(inp):
    resp = S.with_rules(inp.responses.select("question_id"), inp.rules, extra=["domain"]).select(
        S.goal_domain().alias("d"))
    return G.vocabulary_diff(resp, "d", inp.goal_settings, "domain")


@register("q_rollup_units")
def q_rollup_units(inp):
    staged = extract.scored_answers(inp, DEFAULT)
    return U.rollup_units(staged.select("survey_id", "question_id", "clinic", "domain_goals", "goal",
                                        "goal_all_units"))


def _line_frame(inp):
    """Answers with the unit-mapped service line, goal domain and fiscal year."""
    k = _unit_domains(inp)
    mp = L.unit_mapping(inp.spark).select(F.col("unit_name").alias("unit"), "service_line")
    return k.join(F.broadcast(mp), "unit", "left").withColumn(
        "service_line", F.coalesce("service_line", F.lit(L.OTHER)))


@register("q_rollup_lines")
def q_rollup_lines(inp):
    k = _line_frame(inp)
    g = inp.adult_goals.where(F.col("epic_department_id") == L.ALL_UNITS)
    line = g.where(F.col("service_line") != L.ALL_SERVICE_LINES).select(
        F.col("goal_fiscal_yr").alias("fy"), "service_line", F.col("domain").alias("domain_goals"), "goal")
    alll = g.where(F.col("service_line") == L.ALL_SERVICE_LINES).select(
        F.col("goal_fiscal_yr").alias("fy"), F.col("domain").alias("domain_goals"), F.col("goal").alias("goal_all_lines"))
    staged = k.join(line, ["fy", "service_line", "domain_goals"], "left").join(alll, ["fy", "domain_goals"], "left")
    return U.rollup_lines(staged.select("survey_id", "question_id", "fy", "service_line", "domain_goals", "goal",
                                        "goal_all_lines"))


@register("q_rollup_groups")
def q_rollup_groups(inp):
    staged = extract.scored_answers(inp, DEFAULT, groups=True)
    return U.rollup_groups(staged.select("survey_id", "question_id", "clinic", "group_id", "group_name", "domain_goals",
                                         "goal", "goal_all_units"))


def _dual(inp, mode, discharge_start=None):
    a = extract.filtered_answers(inp, DEFAULT)
    a = S.with_rules(a.select("survey_id", "question_id", "received_date", "discharge_date", "value"), inp.rules)
    a = a.select("survey_id", "question_id", "received_date", "discharge_date", S.top_box(F.col("value")).alias("top_box"))
    out = RD.dual_date(a, inp.calendar, DEFAULT.start, DEFAULT.end, mode=mode, discharge_start=discharge_start)
    return out.select("survey_id", "question_id", "received_date", "discharge_date", "top_box", "rpt_prd",
                      "event_date", "event_fy", "quarter_name", "month_short_name", "event_date_disch")


@register("q_dual_date_left")
def q_dual_date_left(inp):
    return _dual(inp, "left")


@register("q_dual_date_full")
def q_dual_date_full(inp):
    return _dual(inp, "full", DEFAULT.start)


@register("q_dual_date_inner")
def q_dual_date_inner(inp):
    return _dual(inp, "inner", DEFAULT.start)


@register("q_shared_clinic_suffix")
def q_shared_clinic_suffix(inp):
    a = extract.filtered_answers(inp, DEFAULT)
    s = extract.survey_departments(inp, a, DEFAULT).select(
        "survey_id", "unit", V.clinic_label(F.col("epic_department_name"), F.col("epic_department_id")).alias("clinic"))
    mp = L.unit_mapping(inp.spark).select(F.col("unit_name").alias("unit"), "service_line")
    f = s.join(F.broadcast(mp), "unit", "left").select("clinic", "service_line").distinct()
    shared = A.spans_many(f.where(F.col("clinic") != L.ALL_UNITS), "clinic", "service_line")
    out = U.suffix_shared(f.withColumn("clinic_label", F.col("clinic")), key="clinic_label", of="service_line",
                          exclude_col="clinic_label")
    return out.join(shared.select("clinic", "n_distinct"), "clinic", "left")


# ---------------------------------------------------------------------------
# Labels, enrichment, reports, audits, benchmarks (V*, J1/J2, A*, P8-P15)
# ---------------------------------------------------------------------------


@register("q_star_enrich")
def q_star_enrich(inp):
    r = inp.responses.select("survey_id", "question_id", "account_key", "patient_key", "physician_key")
    r = J.with_question(r, inp.questions.select("question_id", "varname"))
    r = J.enrich(r, [(inp.accounts, "account_key"), (inp.patients, "patient_key"), (inp.physicians, "physician_key")])
    return r.select("survey_id", "question_id", "varname", "mrn", "last_name", "first_name", "display_name", "npi")


def _dept_frame(inp):
    keys = inp.responses.select("department_key").distinct()
    d = keys.join(inp.departments, "department_key", "left")
    lm = inp.location_master.select("department_id", F.col("department_name").alias("loc_name"), "service_line",
                                    "sub_service_line")
    return d.join(lm, "department_id", "left")


@register("q_clinic_label")
def q_clinic_label(inp):
    d = _dept_frame(inp)
    return d.select("department_key", "department_id",
                    V.clinic_label(F.col("department_name"), F.col("department_id")).alias("clinic"),
                    V.clinic_label2(F.col("loc_name"), F.col("department_id"), F.col("department_name"),
                                    F.col("department_id")).alias("clinic_master"),
                    V.clinic_label_outpatient(F.col("loc_name"), F.col("department_id")).alias("clinic_outpatient"))


@register("q_service_line")
def q_service_line(inp):
    d = _dept_frame(inp).drop("sub_service_line")
    sub = A.sub_service_line(inp.location_master)
    x = d.join(sub, "department_id", "left").select(
        "department_key", "department_id", V.service_line(F.col("service_line")).alias("service_line"),
        "sub_service_line")
    return x.withColumn("service_line_display", V.service_line_display(F.col("service_line"), F.col("sub_service_line")))


@register("q_sub_service_line")
def q_sub_service_line(inp):
    return A.sub_service_line(inp.location_master)


@register("q_response_summary")
def q_response_summary(inp):
    return lines.response_summary(inp, DEFAULT)


@register("q_locations")
def q_locations(inp):
    return lines.locations(inp, DEFAULT)


@register("q_location_external")
def q_location_external(inp):
    return lines.locations(inp, DEFAULT, external=True)


@register("q_goal_by_line")
def q_goal_by_line(inp):
    k = _line_frame(inp)
    g = inp.adult_goals.where((F.col("epic_department_id") == L.ALL_UNITS)
                              & (F.col("service_line") != L.ALL_SERVICE_LINES))
    return J.attach_goal(k, g, {"fy": "goal_fiscal_yr", "service_line": "service_line", "domain_goals": "domain"})


@register("q_goal_by_unit")
def q_goal_by_unit(inp):
    a = extract.filtered_answers(inp, DEFAULT)
    s = extract.unitless_departments(inp, a, DEFAULT)
    doms = S.with_rules(a.select("survey_id", "question_id"), inp.rules, extra=["domain"]).select(
        "survey_id", "question_id", S.goal_domain().alias("domain_goals"))
    k = s.join(doms, "survey_id").select("survey_id", "question_id", "rec_fy", "epic_department_id", "domain_goals")
    g = G.load_goals_legacy(inp.goals_old, None, L.domain_translation(inp.spark)).where(F.col("level") == "unit")
    return J.attach_goal(k, g, {"rec_fy": "goal_fiscal_yr", "epic_department_id": "epic_department_id",
                                "domain_goals": "domain"})


@register("q_assignment_audit")
def q_assignment_audit(inp):
    a = extract.filtered_answers(inp, DEFAULT)
    sud = lines.survey_unit_departments(inp, DEFAULT, a)
    tb = S.with_rules(a.select("survey_id", "question_id", "value"), inp.rules).select(
        "survey_id", S.top_box(F.col("value")).alias("top_box"))
    x = tb.join(sud, "survey_id", "inner")
    return A.assignment_audit(x, ["department_key", "enc_department_key", "dep_department_key",
                                  "resolved_department_key", "unit", "der_unit"])


@register("q_surveys_by_unit")
def q_surveys_by_unit(inp):
    """Surveys per service, department, reported and present unit; names join the counts."""
    a = extract.filtered_answers(inp, DEFAULT)
    unit = W.survey_attribute(a, L.UNIT_QUESTION, "unit", L.NULL_UNIT)
    unit = D.recode(unit, "unit", L.unit_aliases(inp.spark), "der_unit")
    counts = A.surveys_by(a.select("survey_id", "service_code", "department_key").join(unit, "survey_id", "left"),
                          ["service_code", "department_key", "unit", "der_unit"])
    out = counts.join(inp.departments.select("department_key", F.col("department_id").alias("epic_department_id"),
                                             F.col("department_name").alias("epic_department_name")), "department_key", "left")
    return report_order(out, ["service_code", "department_key", "epic_department_id", "epic_department_name", "unit", "der_unit"])


PERIOD = ("rec_fy", "month_num", "month_name", "year_num", "designator")


def _audited(inp):
    """Answers with the department audit of their survey (R3) and the period of their receipt."""
    a = extract.filtered_answers(inp, DEFAULT)
    keys = ["survey_id", "account_key", "department_key"]
    sud = lines.survey_unit_departments(inp, DEFAULT, a).select(*[F.col(k).alias(f"__{k}") for k in keys], "unit", "der_unit", "dep_department_key").distinct()
    cal = F.broadcast(inp.calendar.select(F.col("day_date").alias("received_date"), F.col("fyear_num").alias("rec_fy"), "month_num", "month_name", "year_num"))
    scored = S.with_rules(a.select(*keys, "question_id", "value", "received_date", "designator"), inp.rules)
    scored = scored.select(*keys, "received_date", "designator", S.top_box(F.col("value")).alias("top_box"), S.answered(F.col("value")).alias("val_count"))
    return (scored.join(sud, [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys], "left").join(cal, "received_date", "left"))


AUDIT_NAMES = ["assigned_department_name", "derived_department_name", "dashboard_department_name"]


@register("q_survey_audit")
def q_survey_audit(inp):
    """A7 at the nine audit keys over the distinct rows of R3, with top-box sums; names join the per-survey sums."""
    deps = inp.departments.select("department_key", "department_name")
    keys = ["survey_id", *PERIOD, "unit", "der_unit", "department_key", "dep_department_key"]
    sums = _audited(inp).groupBy(*keys).agg(F.sum("top_box").alias("top_box"), F.sum("val_count").alias("val_count"))
    named = sums.withColumn("__dash", F.coalesce("dep_department_key", "department_key"))
    for key, name in zip(("department_key", "dep_department_key", "__dash"), AUDIT_NAMES):
        named = named.join(deps.select(F.col("department_key").alias(f"__{name}"), F.col("department_name").alias(name)), F.col(key) == F.col(f"__{name}"), "left")
    rows = ["survey_id", *PERIOD, "unit", "der_unit", *AUDIT_NAMES]
    nine = ["year_num", "month_num", "month_name", "designator", "unit", "der_unit", *AUDIT_NAMES]
    out = A.survey_audit(named, rows, nine)
    return by_count_within(out, ["year_num", "month_num"], "survey_count",
                           ("assigned_department_name", "designator", "unit", "der_unit", "derived_department_name", "dashboard_department_name"))


@register("q_response_summary_mapped")
def q_response_summary_mapped(inp):
    return lines.response_summary_mapped(inp, DEFAULT)


def _loaded(inp, load, schema):
    """A table as its readers see it after two loads into a new folder of the cluster's shared store."""
    folder = SK.scratch_folder(inp.spark)
    load(inp, folder)
    load(inp, folder)
    return SK.read_table(inp.spark, folder, schema)


@register("q_load_locations")
def q_load_locations(inp):
    return _loaded(inp, lines.load_locations, SK.LOCATIONS_SCHEMA)


@register("q_load_response_summary")
def q_load_response_summary(inp):
    return _loaded(inp, lines.load_response_summary, SK.RESPONSE_SUMMARY_SCHEMA)


def _scored(inp):
    return extract.summary_answers(inp, DEFAULT)


@register("q_clinic_year_check")
def q_clinic_year_check(inp):
    s = Fl.probe(_scored(inp), question_id=2)
    return s.groupBy("clinic", "rec_fy").agg(F.count(F.lit(1)).alias("n"),
                                             F.sum("top_box").cast("bigint").alias("top_box"))


def _with_calendar(inp, df):
    """Calendar attributes of the received date (one row per day, broadcast)."""
    cal = inp.calendar.select(F.col("day_date").alias("received_date"), "fyear_num", "year_num", "quarter_name", "month_num", "month_short_name")
    return df.join(F.broadcast(cal), "received_date", "left")


# what the dimension is distinct over
DIMENSION_COLS = ["fy", "rec_fy", "quarter_name", "month_num", "month_short_name", "year_num", "department_key",
                  "epic_department_id", "epic_department_name", "goal_epic_department_id", "service_line_id", "service_line",
                  "sub_service_line", "unit", "clinic", "domain", "domain_goals", "question_id", "question_text",
                  "question_text_alias"]


@register("q_report_dimension")
def q_report_dimension(inp):
    s = Fl.for_fiscal_years(Fl.reportable_domains(_with_calendar(inp, _scored(inp))), min_year=1997)
    out = A.distinct_rows(s, DIMENSION_COLS).select(
        F.lit(DEFAULT.event_type).alias("event_type"), F.col("rec_fy").alias("event_fy"), F.col("year_num").alias("event_cy"),
        F.col("month_num").alias("month"), F.col("month_short_name").alias("month_name"), "service_line",
        F.col("epic_department_id").alias("department_id"), F.col("epic_department_name").alias("department_name"),
        "domain_goals", "question_id", "question_text_alias")
    return report_order(out, ["event_type", "event_fy", "event_cy", "month", "month_name", "service_line", "department_id",
                              "department_name", "domain_goals", "question_text_alias"])


@register("q_value_distribution")
def q_value_distribution(inp):
    return A.value_distribution(_scored(inp), ["clinic", "question_id"])


REPORT_KEYS = ["event_type", "event_fy", "event_cy", "month", "month_name", "service_line", "department_id",
               "department_name", "clinic", "domain_goals", "question_text_alias"]


@register("q_response_report")
def q_response_report(inp):
    """P11 over the unit extract. The department is a key and names the clinic,
    so the 'All Units' copy of a group is the group under another label: the
    answers are aggregated once and the small result is rolled up."""
    staged = _with_calendar(inp, Fl.reportable_domains(extract.summary_answers(inp, DEFAULT)))
    rows = staged.select(
        F.lit(DEFAULT.event_type).alias("event_type"), F.col("fyear_num").alias("event_fy"), F.col("year_num").alias("event_cy"),
        F.col("month_num").alias("month"), F.col("month_short_name").alias("month_name"),
        V.service_line_display(F.col("service_line"), F.col("sub_service_line")).alias("service_line"),
        F.col("epic_department_id").alias("department_id"), F.col("epic_department_name").alias("department_name"),
        "clinic", "domain_goals", "question_text_alias", "goal", "goal_all_units", "top_box", "val_count", "survey_id")
    counts = A.response_report(rows, [*REPORT_KEYS, "goal", "goal_all_units"]).withColumn("survey_id", F.lit(1))
    return report_order(U.rollup_units(counts).drop("survey_id").withColumnRenamed("n_surveys", "n"), REPORT_KEYS)


@register("q_question_summary")
def q_question_summary(inp):
    """Months of a fiscal year (no calendar year) per line, department and question, with the department's goal."""
    s = Fl.reportable_domains(with_month(inp, extract.summary_answers(inp, DEFAULT)))
    return A.response_report(s, ["rec_fy", "month_num", "month_short_name", "service_line", "epic_department_id", "clinic",
                                 "question_id", "question_text_alias", "domain_goals", "goal"])


MONTH_KEYS = ["group_name", "clinic", "domain_goals", "question_id", "month_short_name", "month_key"]


def _monthly(inp):
    staged = extract.summary_answers(inp, DEFAULT, groups=True)
    cal = inp.calendar.select(F.col("day_date").alias("received_date"), "month_short_name", "month_key")
    rows = staged.where(F.col("domain_goals").isNotNull()).join(F.broadcast(cal), "received_date", "left")
    counts = B.monthly_counts(rows, ["group_id", *MONTH_KEYS]).withColumn("survey_id", F.lit(1))  # every count has answers
    return B.monthly_percent(U.rollup_groups(counts), MONTH_KEYS)


@register("q_monthly_percent")
def q_monthly_percent(inp):
    return _monthly(inp)


@register("q_rescore")
def q_rescore(inp):
    return B.rescore_percent(_monthly(inp), ["group_name", "clinic", "domain_goals", "question_id"])


@register("q_percentile_bands")
def q_percentile_bands(inp):
    return B.latest_bands(inp.percentile_ranks)


@register("q_percentile_lookup")
def q_percentile_lookup(inp):
    m = _monthly(inp).where(F.col("question_id") == 2)
    return B.band_lookup(m, B.latest_bands(inp.percentile_ranks))


@register("q_designator_from_log")
def q_designator_from_log(inp):
    """F3 with the warehouse variant's designator source (latest log load)."""
    from dataclasses import replace
    cfg = replace(DEFAULT, designator_source="log")
    return extract.filtered_answers(inp, cfg).select("survey_id", "question_id", "received_date", "designator")


@register("q_response_summary_group")
def q_response_summary_group(inp):
    return lines.response_summary(inp, DEFAULT, groups=True)


@register("q_child_extract_unit_suffix")
def q_child_extract_unit_suffix(inp):
    return lines.child_extract(inp, lines.CHILD_CFG, suffix_col="unit", clipped=True)


@register("q_department_audit")
def q_department_audit(inp):
    deps = inp.departments.select("department_key", "department_name")
    return D.department_audit(_audited(inp), deps, period=PERIOD)
