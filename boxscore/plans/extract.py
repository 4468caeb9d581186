"""Detail extracts (P1, P2): scored answers on a date spine with goals and
'All ...' roll-up rows.

Plan shape (one Spark job per action):

  fact scan (pruned, filters pushed) -> designator filter
     |-- survey-level: unit (partial MAX), department rows (distinct),
     |                 self-reported age (partial MAX over the whole fact)
     `-- answer-level: broadcast dims (questions, rules, translation),
                       size-checked dims (accounts, patients, physicians)
  answers LEFT JOIN survey-level ON the survey keys -> one DISTINCT
  -> J7 spine (broadcast, bounded by the window) -> explode roll-up levels
  -> display columns.

The answers are evaluated and shuffled once, on the survey keys. Goals are
maps (domain -> goal) on the survey's department row, so no answer is joined
on a goal key; the days without answers come from a narrow scan of the dates.
The service line is a constant here, so no clinic has two and the shared-name
suffix (J8) has nothing to do.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from boxscore.functions import labels as V
from boxscore.functions.scoring import score_columns, with_rules
from boxscore.operators import filters as Fl
from boxscore.operators.goals import mapped_goals, resolve_goals, with_goal_maps
from boxscore.operators.joins import on_survey_keys, with_group
from boxscore.operators.report_dates import dual_date
from boxscore.operators.rollups import rollup_groups, rollup_units
from boxscore.operators.windows import max_answer
from boxscore.plans.config import DEFAULT, ExtractConfig
from boxscore.sources import lookups as L
from boxscore.sources.tables import Inputs

ANSWER_COLS = ["survey_id", "question_id", "account_key", "patient_key", "service_code", "received_date",
               "discharge_date", "fy", "value", "department_key", "physician_key"]


def filtered_answers(inp: Inputs, cfg: ExtractConfig = DEFAULT) -> DataFrame:
    """F1 + F2 + F3 over the fact scan.

    ``designator_source="log"`` takes the designator from the raw load log
    instead of the fact's own column: the latest load per (survey, value)
    (W3), so a survey loaded with two designators joins both rows; the
    duplicates this makes collapse in the stage's DISTINCT."""
    if cfg.designator_source == "log":
        from boxscore.operators.windows import latest_designator
        raw = latest_designator(inp.designator_log) if cfg.designator_dedup else inp.designator_log
        log = raw.select("survey_id", F.substring("value", 1, 2).alias("designator"))
        r = inp.responses.select(*ANSWER_COLS)
        r = Fl.for_questions(r, cfg.questions)
        r = Fl.received_between(r, cfg.start, cfg.end)
        r = r.join(log, "survey_id", "left")
    else:
        r = inp.responses.select(*ANSWER_COLS, F.substring("survey_designator", 1, 2).alias("designator"))
        r = Fl.for_questions(r, cfg.questions)
        r = Fl.received_between(r, cfg.start, cfg.end)
    r = Fl.designator_ok(r, cfg.designator_code)
    return r if cfg.keep_null_designator else r.where(F.col("designator").isNotNull())


def survey_departments(inp: Inputs, answers: DataFrame, cfg: ExtractConfig = DEFAULT) -> DataFrame:
    """Survey-level rows: unit (W1), department (J3 translation), REC_FY.

    One row per distinct (survey, unit, department, goal department, FY);
    a survey answered under two departments keeps both rows (fan-out kept).
    The answers are read once: they are reduced to a survey's departments and
    years, each with the unit answered there, and the survey's unit is the
    largest of these few rows.
    """
    value = F.coalesce(F.col("value"), F.lit(L.NULL_UNIT))
    rows = (dated_answers(inp, answers, cfg).groupBy(*DEPARTMENT_KEYS)
            .agg(F.max(F.when(F.col("question_id") == cfg.unit_question, value)).alias("unit"))
            .withColumn("unit", F.max("unit").over(Window.partitionBy("survey_id"))))
    return goal_departments(inp, rows, "survey_id", "unit").distinct()


def unitless_departments(inp: Inputs, answers: DataFrame, cfg: ExtractConfig = DEFAULT) -> DataFrame:
    """``survey_departments`` without the unit; a survey has one unit, so the rows are the same ones."""
    rows = dated_answers(inp, answers, cfg).select(*DEPARTMENT_KEYS).distinct()
    return goal_departments(inp, rows, "survey_id").distinct()


def asked_departments(inp: Inputs, answers: DataFrame, cfg: ExtractConfig = DEFAULT) -> DataFrame:
    """The departments and years of the surveys with each goal domain their surveys
    were asked about, without the survey. ``answers`` have the domain as a struct
    ``asked`` (NULL: not counted). The answers are read once: every department of a
    survey meets every domain of it in the few distinct rows of the survey, and only
    the distinct keys meet the department dimension."""
    rows = dated_answers(inp, answers, cfg).select(*DEPARTMENT_KEYS, "asked").distinct()
    asked = F.collect_set("asked").over(Window.partitionBy("survey_id"))
    keys = (rows.select("department_key", "rec_fy", asked.alias("asked")).select("department_key", "rec_fy", F.explode("asked").alias("asked"))
            .select("department_key", "rec_fy", "asked.domain_goals").distinct())
    return goal_departments(inp, keys, "domain_goals")


DEPARTMENT_KEYS = ["survey_id", "department_key", "rec_fy"]


def dated_answers(inp: Inputs, answers: DataFrame, cfg: ExtractConfig) -> DataFrame:
    """Answers with the fiscal year they count in. The days cover the window that
    the answers lie in, so none is dropped."""
    cal = inp.days(cfg.start, cfg.end).select(F.col("day_date").alias("received_date"), F.col("fyear_num").alias("rec_fy"))
    dated = answers.join(F.broadcast(cal), "received_date", "inner")
    return dated.withColumn("rec_fy", F.col("fy")) if cfg.fy_source == "answer" else dated


def goal_departments(inp: Inputs, rows: DataFrame, *attributes: str) -> DataFrame:
    """Department and goal department (J3) of rows with a department key."""
    deps = inp.departments.select("department_key", "department_id", "department_name")
    trn = L.department_translation(inp.spark)
    rows = rows.join(deps, "department_key", "left")
    rows = rows.join(trn, (rows["rec_fy"] == trn["goal_fiscal_yr"])
                     & (rows["department_id"] == trn["response_department_id"]), "left")
    return rows.select(F.col("department_id").alias("epic_department_id"),
                       F.col("department_name").alias("epic_department_name"),
                       F.coalesce("goal_department_id", "department_id").alias("goal_epic_department_id"),
                       "rec_fy", *attributes)


SURVEY_KEYS = ["survey_id", "account_key", "patient_key", "received_date"]


def survey_detail(inp: Inputs, answers: DataFrame, cfg: ExtractConfig = DEFAULT, extra_keys: tuple = (),
                  age: DataFrame | None = None) -> DataFrame:
    """Survey-level enrichment on the distinct survey keys: account (MRN),
    patient attributes and the self-reported age. Joining the account and
    patient dimensions here - on a frame of one row per survey, not per
    answer - means that when those dimensions exceed the broadcast bound only
    this small frame is shuffled by their keys. ``extra_keys`` widen the key;
    ``age`` replaces the self-reported age (survey_id, pat_age_survey_answer)."""
    keys = answers.select(*SURVEY_KEYS, *extra_keys).distinct()
    if age is None:
        age = max_answer(inp.responses.select("survey_id", "question_id", "account_key", "value"),
                         cfg.age_question, "pat_age_survey_answer")
    as_of = F.lit(cfg.as_of).cast("date")
    s = (keys.join(inp.accounts, "account_key", "left")
         .join(inp.patients, "patient_key", "left")
         .join(age, "survey_id", "left"))
    return s.select(
        *SURVEY_KEYS, *extra_keys, "mrn",
        V.full_name(F.col("last_name"), F.col("first_name")).alias("pat_name"),
        F.col("birth_date").alias("pat_dob"),
        V.age_years(F.col("birth_date"), as_of).alias("pat_age"),
        V.age_years(F.col("birth_date"), F.col("received_date")).alias("pat_age_survey_recvd"),
        "pat_age_survey_answer",
        V.sex_label(F.col("sex")).alias("pat_sex"),
    )


def answer_detail(inp: Inputs, answers: DataFrame, cfg: ExtractConfig = DEFAULT,
                  survey_extra: DataFrame | None = None) -> DataFrame:
    """Answer-level enrichment: ONE join of the stored answer columns to the
    survey-level frame (patient attributes, age and the caller's survey-keyed
    columns in ``survey_extra``), then question (inner), physician, attributes
    and the V1-V5 columns (broadcast literals and a small dimension, no
    shuffle), so that no text is shuffled with the answers. NULL keys match
    null-safely, which is the left-join result the reference's separate joins give."""
    s = survey_detail(inp, answers, cfg)
    if survey_extra is not None:
        s = s.join(survey_extra, "survey_id", "left")
    a = on_survey_keys(answers.select(*ANSWER_COLS), s, SURVEY_KEYS)
    attrs = inp.rules.select("question_id", "domain", "question_text", "question_text_alias")
    a = (a.join(F.broadcast(inp.questions.select("question_id", "varname")), "question_id", "inner")
         .join(inp.physicians, "physician_key", "left")
         .join(F.broadcast(attrs), "question_id", "left"))
    a = score_columns(with_rules(a, inp.rules), cfg.age_question)
    return a.select(
        "survey_id", "account_key", "received_date", "discharge_date", "fy",
        F.col("display_name").alias("phys_name"), F.col("dept").alias("phys_dept"),
        F.col("division").alias("phys_div"), "department_key",
        F.col("value").cast("string").alias("value"), "val_count", "domain", "domain_goals", "value_resp_grp",
        "top_box", "top_box_response", "varname", "service_code", "question_id", "question_text",
        "question_text_alias", "npi", *[c for c in s.columns if c not in SURVEY_KEYS],
    )


def department_rows(inp: Inputs, answers: DataFrame, cfg: ExtractConfig = DEFAULT, groups: bool = False) -> DataFrame:
    """Survey-level department rows with the goals that apply to them and, for P2, their group."""
    rows = survey_departments(inp, answers, cfg)
    if groups:
        rows = with_group(rows, L.department_groups(inp.spark))
    return with_goal_maps(rows, inp.child_goals, cfg.service_line)


def unit_columns(cfg: ExtractConfig):
    return [*V.with_constants(service_line_id=cfg.service_line_id, service_line=cfg.service_line,
                              sub_service_line=cfg.sub_service_line),
            V.clinic_label(F.col("epic_department_name"), F.col("epic_department_id")).alias("clinic"), *mapped_goals()]


GOAL_MAPS = ("department_goals", "line_goals")


def scored_answers(inp: Inputs, cfg: ExtractConfig = DEFAULT, groups: bool = False) -> DataFrame:
    """The scored, enriched answer stage (one row per answer x survey
    department row) with its goals, before the date spine."""
    answers = filtered_answers(inp, cfg)
    out = answer_detail(inp, answers, cfg, survey_extra=department_rows(inp, answers, cfg, groups))
    return out.select("*", *unit_columns(cfg)).drop(*GOAL_MAPS).distinct()


def summary_answers(inp: Inputs, cfg: ExtractConfig = DEFAULT, groups: bool = False) -> DataFrame:
    """The answer stage of the summary reports: no patient, account or
    physician is joined, and the DISTINCT is over the stored answer rows."""
    answers = filtered_answers(inp, cfg)
    attrs = inp.rules.select("question_id", "domain", "question_text", "question_text_alias")
    a = (answers.select(*ANSWER_COLS).distinct().join(F.broadcast(inp.questions.select("question_id")), "question_id", "inner")
         .join(F.broadcast(attrs), "question_id", "left"))
    a = score_columns(with_rules(a, inp.rules), cfg.age_question).select(
        "survey_id", "received_date", "fy", "department_key", "question_id", "question_text", "question_text_alias",
        F.col("value").cast("string").alias("value"), "val_count", "domain", "domain_goals", "top_box")
    rows = department_rows(inp, answers, cfg, groups)
    return a.join(rows, "survey_id", "left").select("*", *unit_columns(cfg)).drop(*GOAL_MAPS)


def answer_dates(inp: Inputs, cfg: ExtractConfig = DEFAULT) -> DataFrame:
    """Received and discharge dates of the stage's answers."""
    a = filtered_answers(inp, cfg).select("question_id", "received_date", "discharge_date")
    return a.join(F.broadcast(inp.questions.select("question_id")), "question_id", "left_semi").drop("question_id")


def goal_key_rows(inp: Inputs, cfg: ExtractConfig = DEFAULT, groups: bool = False) -> DataFrame:
    """Distinct (fiscal year, line, department, goal department, goal domain [, group]) of the answers."""
    domains = F.broadcast(inp.rules.select("question_id", F.struct(F.coalesce("domain_override", "domain").alias("domain_goals")).alias("asked")))
    rows = asked_departments(inp, filtered_answers(inp, cfg).join(domains, "question_id", "left"), cfg)
    if groups:
        rows = with_group(rows, L.department_groups(inp.spark))
    return rows.select("rec_fy", F.lit(cfg.service_line).alias("service_line"), "epic_department_id", "epic_department_name",
                       "goal_epic_department_id", "domain_goals", *(["group_name"] if groups else [])).distinct()


def goal_cascade(inp: Inputs, cfg: ExtractConfig = DEFAULT, groups: bool = False) -> DataFrame:
    """G1 / G1b as a table: every goal key of the answers with its goal."""
    return resolve_goals(goal_key_rows(inp, cfg, groups), inp.child_goals, cfg.service_line, group_col="group_name" if groups else None)


OUTPUT_COLS = [
    "event_type", "survey_id", "clinic", "service_line", "sub_service_line", "epic_department_id",
    "service_line_id", "account_key", "rpt_prd", "event_date", "event_date_disch", "event_fy", "question_id",
    "varname", "question_text", "question_text_alias", "domain", "domain_goals", "recvd_date", "discharge_date",
    "patient_id", "pat_name", "pat_sex", "pat_dob", "pat_age", "pat_age_survey_recvd", "pat_age_survey_answer",
    "peds", "npi", "phys_name", "phys_dept", "phys_div", "goal", "unit", "value", "value_resp_grp", "top_box",
    "top_box_response", "val_count", "quarter_name", "month_short_name",
]


def finish(df: DataFrame, cfg: ExtractConfig, extra_cols=()) -> DataFrame:
    """Spine columns -> result columns (peds is computed after the spine,
    so days without answers read 0, as in the reference)."""
    return df.select(
        F.lit(cfg.event_type).alias("event_type"), "survey_id", "clinic",
        V.service_line_display(F.col("service_line"), F.col("sub_service_line")).alias("service_line"),
        "sub_service_line", "epic_department_id", "service_line_id", "account_key", "rpt_prd", "event_date",
        "event_date_disch", "event_fy", "question_id", "varname", "question_text", "question_text_alias",
        "domain", "domain_goals", F.col("received_date").alias("recvd_date"), "discharge_date",
        F.col("mrn").alias("patient_id"), "pat_name", "pat_sex", "pat_dob", "pat_age", "pat_age_survey_recvd",
        "pat_age_survey_answer", V.peds_flag(F.col("pat_age_survey_answer")).alias("peds"), "npi", "phys_name",
        "phys_dept", "phys_div", "goal", "unit", "value", "value_resp_grp", "top_box", "top_box_response",
        "val_count", "quarter_name", "month_short_name", *extra_cols)


def unit_extract(inp: Inputs, cfg: ExtractConfig = DEFAULT) -> DataFrame:
    """Unit-level extract with empty days and an 'All Units' copy."""
    spined = dual_date(scored_answers(inp, cfg), inp.days(cfg.start, cfg.end), cfg.start, cfg.end, mode=cfg.date_mode,
                       discharge_days=inp.calendar, dates=answer_dates(inp, cfg))
    return finish(rollup_units(spined), cfg)


def unit_extract_groups(inp: Inputs, cfg: ExtractConfig = DEFAULT) -> DataFrame:
    """Unit extract with department groups: unit rows, 'All Units' per
    group and 'All Units' over 'All Groups'."""
    spined = dual_date(scored_answers(inp, cfg, groups=True), inp.days(cfg.start, cfg.end), cfg.start, cfg.end, mode=cfg.date_mode,
                       discharge_days=inp.calendar, dates=answer_dates(inp, cfg))
    return finish(rollup_groups(spined), cfg, extra_cols=("group_id", "group_name"))
