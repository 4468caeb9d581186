"""Extracts of single survey types (P4-P7): adult inpatient by line and by
unit, without flagged samples, child inpatient by line and by unit, and
outpatient clinics.

A survey type has its own service, scales and domains (``lookups.SURVEY_RULES``).
One frame of survey keys carries everything that is not an answer - unit,
line, department, patient, goals as maps - and meets the answers once.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from boxscore.functions import labels as V
from boxscore.functions.scoring import with_survey_rules
from boxscore.operators import departments as D
from boxscore.operators.aggregations import sub_service_line
from boxscore.operators.goals import all_goals, flat_goals, goal_in, goals_by_domain
from boxscore.operators.joins import on_survey_keys, without_flagged
from boxscore.operators.report_dates import dual_date
from boxscore.operators.rollups import label_if_survey, rollup_lines, rollup_unit_label, shared_clinics, suffix_marked, with_shared
from boxscore.plans.config import DEFAULT, ExtractConfig
from boxscore.plans.extract import ANSWER_COLS, SURVEY_KEYS, survey_detail
from boxscore.plans.lines import line_goal_columns, with_line_goals
from boxscore.sources import lookups as L
from boxscore.sources.tables import Inputs

ADULT_CFG = replace(DEFAULT, event_type="Adult Inpatient Survey", date_mode="full")
CHILD_CFG = replace(DEFAULT, event_type="Child Inpatient Survey", date_mode="full")
CLINIC_CFG = replace(DEFAULT, event_type="Outpatient Clinic Survey", date_mode="full")
GOAL = "decimal(4,3)"


def service_answers(inp: Inputs, cfg: ExtractConfig, service: str) -> DataFrame:
    """The answers of one service to the questions of the extract, whenever received."""
    return inp.responses.select(*ANSWER_COLS).where((F.col("service_code") == service) & F.col("question_id").isin(*cfg.questions))


def survey_units(inp: Inputs, cfg: ExtractConfig, recode: bool = True) -> DataFrame:
    """Distinct (survey_id, unit) of the unit question, renamed units under their present label."""
    units = inp.responses.where(F.col("question_id") == cfg.unit_question).select("survey_id", F.col("value").alias("unit")).distinct()
    return D.recode(units, "unit", L.unit_aliases(inp.spark), "unit").distinct() if recode else units


def dates_of(inp: Inputs, answers: DataFrame) -> DataFrame:
    """The two dates of the answers whose question the dimension knows."""
    return (answers.select("question_id", "received_date", "discharge_date")
            .join(F.broadcast(inp.questions.select("question_id")), "question_id", "left_semi").drop("question_id"))


def scored(inp: Inputs, survey_type: str, answers: DataFrame, frame: DataFrame, keys: list[str], columns: dict[str, Column]) -> DataFrame:
    """Answers scored by their survey type, with their survey's frame; ``columns``
    read the frame's maps, which then go, so that rows can be told apart."""
    a = on_survey_keys(answers, frame, keys)
    a = (a.join(F.broadcast(inp.questions.select("question_id", "varname")), "question_id", "inner")
         .join(inp.physicians.withColumnsRenamed({"display_name": "phys_name", "dept": "phys_dept", "division": "phys_div"}), "physician_key", "left"))
    a = with_survey_rules(a, L.survey_rules(inp.spark), F.lit(survey_type)).drop("physician_key", "survey_type")
    out = a.withColumn("value", F.col("value").cast("string")).withColumns(columns)
    maps = [f.name for f in out.schema.fields if f.dataType.typeName() == "map"]
    return out.drop(*maps, "patient_key").distinct()


PATIENT = ["pat_name", "pat_sex", "pat_dob", "pat_age", "pat_age_survey_recvd", "pat_age_survey_answer"]


def finished(df: DataFrame, cfg: ExtractConfig, middle: list, end: list) -> DataFrame:
    return df.select(
        F.lit(cfg.event_type).alias("event_type"), "survey_id", "account_key", "rpt_prd", "event_date", "event_date_disch", "question_id",
        "varname", "question_text_alias", "domain", F.col("received_date").alias("recvd_date"), "discharge_date", F.col("mrn").alias("patient_id"),
        *PATIENT, V.peds_flag(F.col("pat_age_survey_answer")).alias("peds"), "npi", "phys_name", "phys_dept", "phys_div", *middle,
        "value", "value_resp_grp", "top_box", "val_count", "quarter_name", "month_short_name", *end)


# -- inpatient surveys: unit per survey, line by unit mapping ------------------------


def unit_frame(inp: Inputs, cfg: ExtractConfig, answers: DataFrame) -> DataFrame:
    """Survey frame with the unit and the service line it maps to (V19: one
    special unit belongs to a fixed line; surveys without a unit read 'Other')."""
    mapping = F.broadcast(L.unit_mapping(inp.spark).select(F.col("unit_name").alias("unit"), F.col("service_line").alias("mapped_line")))
    frame = survey_detail(inp, answers, cfg).join(survey_units(inp, cfg), "survey_id", "left").join(mapping, "unit", "left")
    line = V.unit_or_other(F.col("unit"), [L.ADULT_SPECIAL_UNIT], L.CHILD_SERVICE_LINE, F.coalesce("mapped_line", F.lit(L.OTHER)))
    return frame.withColumn("service_line", line).withColumn("unit", F.coalesce("unit", F.lit(L.OTHER))).drop("mapped_line")


def display_unit() -> Column:
    shown, label = L.ADULT_DISPLAY_RECODE
    return F.when(F.col("unit") == shown, F.lit(label)).otherwise(F.col("unit"))


def by_unit(spined: DataFrame) -> DataFrame:
    return rollup_unit_label(spined, display_unit(), label_if_survey(L.ALL_UNITS))


def by_line(spined: DataFrame) -> DataFrame:
    rolled = rollup_lines(spined.withColumnRenamed("goal_all", "goal_all_lines"))
    return rolled.withColumn("unit", display_unit())


def adult_extract(inp: Inputs, cfg: ExtractConfig = ADULT_CFG, by: str = "line") -> DataFrame:
    """P4 on the whole calendar, both report dates.

    ``by="line"``: goals of (line, domain) in the answer's fiscal year and an
    'All Service Lines' copy. ``by="unit"``: goals of (unit, domain) without a
    year, and an 'All Units' copy with the goals of all units and lines.
    """
    answers = service_answers(inp, cfg, L.SERVICE_OF_TYPE[L.ADULT])
    frame = unit_frame(inp, cfg, answers)
    if by == "line":
        frame = with_line_goals(frame, inp)
        goals = line_goal_columns()
        columns = {"goal": goals["goal"], "goal_all": goals["goal_all_lines"]}
    else:
        g = inp.adult_unit_goals
        own = goals_by_domain(g.where(F.col("unit") != L.ALL_UNITS), {"unit": "unit"}, "unit_goals")
        every = g.where((F.col("unit") == L.ALL_UNITS) & (F.col("service_line") == L.ALL_SERVICE_LINES))
        frame = frame.join(own, "unit", "left").withColumn("every_goals", all_goals(every))
        columns = {"goal": goal_in("unit_goals"), "goal_all": goal_in("every_goals")}
    s = scored(inp, L.ADULT, answers, frame, SURVEY_KEYS, columns)
    spined = dual_date(s, inp.calendar, None, None, mode="full", dates=dates_of(inp, answers))
    rolled = by_line(spined) if by == "line" else by_unit(spined)
    return finished(rolled, cfg, ["domain_goals", "goal", "unit", "service_line"], [])


def adult_without_flagged(inp: Inputs, cfg: ExtractConfig = ADULT_CFG) -> DataFrame:
    """P5: adult answers of surveys without a flagged answer of the service, by
    unit, without goals. The line is the physician's; surveys without a unit
    read 'No Unit' and have no unit in the 'All Units' copy."""
    service = L.SERVICE_OF_TYPE[L.ADULT]
    answers = without_flagged(service_answers(inp, cfg, service), inp.responses.select("survey_id", "question_id", "service_code", "value"),
                              L.service_questions(inp.spark), L.FLAG_VARNAME, L.FLAG_VALUE, service)
    frame = survey_detail(inp, answers, cfg).join(survey_units(inp, cfg, recode=False), "survey_id", "left")
    frame = frame.withColumn("unit", F.coalesce("unit", F.lit(L.NO_UNIT)))
    s = scored(inp, L.ADULT, answers, frame, SURVEY_KEYS, {"service_line": F.col("physician_line")})
    spined = dual_date(s, inp.calendar, None, None, mode="full", dates=dates_of(inp, answers))
    named = F.when(F.lower("unit") != L.NO_UNIT.lower(), F.lit(L.ALL_UNITS))
    return finished(rollup_unit_label(spined, F.col("unit"), named, own_goal=None), cfg, ["unit", "service_line"], [])


def child_flat_goals(inp: Inputs, cfg: ExtractConfig = CHILD_CFG) -> DataFrame:
    """G3 over the child answers: domains of the inline table, units and lines of the surveys."""
    answers = service_answers(inp, cfg, L.SERVICE_OF_TYPE[L.CHILD_LINE])
    domains = L.survey_rules(inp.spark).where(F.col("survey_type") == L.CHILD_LINE).select("question_id", "domain")
    asked = (answers.select("survey_id", "question_id", "service_code").join(F.broadcast(domains), "question_id", "inner")
             .select("survey_id", "service_code", "domain").distinct())
    mapping = F.broadcast(L.unit_mapping(inp.spark).select(F.col("unit_name").alias("unit"), F.col("service_line").alias("mapped_line")))
    rows = asked.join(survey_units(inp, cfg), "survey_id", "left").join(mapping, "unit", "left")
    line = V.unit_or_other(F.col("unit"), [L.ADULT_SPECIAL_UNIT], L.CHILD_SERVICE_LINE, F.coalesce("mapped_line", F.lit(L.OTHER)))
    rows = rows.withColumn("service_line", line).withColumn("unit", F.coalesce("unit", F.lit(L.OTHER)))
    return flat_goals(rows, L.FLAT_GOAL, L.FLAT_GOAL_YEAR)


def child_extract(inp: Inputs, cfg: ExtractConfig = CHILD_CFG, by: str = "unit") -> DataFrame:
    """P6 on the whole calendar, both report dates: child answers with the inline
    domains and flat goals. ``by="unit"``: the goal of (unit, domain) and an
    'All Units' copy; ``by="line"``: the 'All Units' goal of (line, domain) and
    an 'All Service Lines' copy."""
    answers = service_answers(inp, cfg, L.SERVICE_OF_TYPE[L.CHILD_LINE])
    flat = child_flat_goals(inp, cfg)
    every = flat.where((F.col("unit") == L.ALL_UNITS) & (F.col("service_line") == L.ALL_SERVICE_LINES))
    if by == "unit":
        own, key = flat.where(F.col("unit") != L.ALL_UNITS), "unit"
    else:
        own, key = flat.where((F.col("unit") == L.ALL_UNITS) & (F.col("service_line") != L.ALL_SERVICE_LINES)), "service_line"
    frame = unit_frame(inp, cfg, answers).join(goals_by_domain(own, {key: key}, "own_goals"), key, "left")
    frame = frame.withColumn("every_goals", all_goals(every))
    s = scored(inp, L.CHILD_LINE, answers, frame, SURVEY_KEYS, {"goal": goal_in("own_goals"), "goal_all": goal_in("every_goals")})
    spined = dual_date(s, inp.calendar, None, None, mode="full", dates=dates_of(inp, answers))
    rolled = by_unit(spined) if by == "unit" else by_line(spined)
    return finished(rolled, cfg, ["domain_goals", "goal", "unit", "service_line"], ["top_box_response"])


# -- outpatient clinics: department of the answer -------------------------------------


CLINIC_KEYS = [*SURVEY_KEYS, "department_key"]


def clinic_frame(inp: Inputs, cfg: ExtractConfig, answers: DataFrame) -> DataFrame:
    """Survey and department frame: the location master's line, sub line and clinic of the
    answers' own department, and the self-reported age in answers of the service."""
    service = L.SERVICE_OF_TYPE[L.CLINIC]
    age = (inp.responses.where((F.col("service_code") == service) & (F.col("question_id") == cfg.age_question))
           .groupBy("survey_id").agg(F.max("value").alias("pat_age_survey_answer")))
    own = inp.departments.select("department_key", "department_id")
    master = inp.location_master.select("department_id", F.col("department_id").alias("epic_department_id"),
                                        F.col("department_name").alias("master_name"), "service_line_id", "operational_service",
                                        F.col("service_line").alias("master_line"))
    sub = sub_service_line(inp.location_master)
    frame = (survey_detail(inp, answers, cfg, extra_keys=("department_key",), age=age)
             .join(own, "department_key", "left").join(master, "department_id", "left").join(sub, "department_id", "left"))
    return (frame.withColumn("service_line", V.service_line(F.col("master_line"), F.col("operational_service")))
            .withColumn("clinic", V.clinic_label_outpatient(F.col("master_name"), F.col("epic_department_id")))
            .drop("department_id", "master_name", "master_line", "operational_service"))


def clinic_extract(inp: Inputs, cfg: ExtractConfig = CLINIC_CFG) -> DataFrame:
    """Outpatient answers by service line of their department. Goals are
    those of 'All Clinics' of the line, without a year; the 'All Service Lines'
    copy keeps rows matched on both report dates. Clinics seen in several lines
    get a ' - line' suffix."""
    answers = service_answers(inp, cfg, L.SERVICE_OF_TYPE[L.CLINIC])
    rows = clinic_frame(inp, cfg, answers)
    g = inp.clinic_goals
    own = goals_by_domain(g.where(F.col("unit") == L.ALL_CLINICS), {"service_line": "service_line"}, "line_goals")
    in_window = F.col("received_date").between(F.lit(cfg.start).cast("date"), F.lit(cfg.end).cast("date"))
    asked = answers.join(F.broadcast(inp.questions.select("question_id")), "question_id", "left_semi").where(in_window).select("survey_id", "department_key").distinct()
    seen = rows.where(in_window).join(asked, ["survey_id", "department_key"], "left_semi").select("clinic", "service_line").distinct()
    marked = with_shared(rows, shared_clinics(seen, exclude=L.ALL_SERVICE_LINES))
    frame = marked.join(own, "service_line", "left").withColumn("every_goals", all_goals(g.where(F.col("service_line") == L.ALL_SERVICE_LINES)))
    s = scored(inp, L.CLINIC, answers, frame, CLINIC_KEYS, {"goal": goal_in("line_goals"), "goal_all_lines": goal_in("every_goals")})
    spined = dual_date(s, inp.days(cfg.start, cfg.end), cfg.start, cfg.end, mode="full", discharge_start=cfg.start, dates=dates_of(inp, answers))
    both = F.col("survey_id").isNotNull() & F.col("event_date_disch").isNotNull()
    rolled = suffix_marked(rollup_lines(spined, copy_if=both), skip_value_col="service_line", skip_value=L.ALL_SERVICE_LINES)
    shown = V.service_line_display(F.col("service_line"), F.col("sub_service_line")).alias("service_line")
    return finished(rolled, cfg, ["domain_goals", "goal", "clinic", shown, "sub_service_line", "epic_department_id", "service_line_id"], [])
