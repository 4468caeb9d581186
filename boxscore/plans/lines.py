"""Service-line side of the model: survey -> department via unit mapping
and first encounter (P3, P8, P9 share this stage)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boxscore.operators import departments as D
from boxscore.operators.windows import first_encounter, survey_attribute
from boxscore.plans.config import DEFAULT, ExtractConfig
from boxscore.plans.extract import ANSWER_COLS, filtered_answers
from boxscore.sources import lookups as L
from boxscore.sources.tables import Inputs


def survey_unit_departments(inp: Inputs, cfg: ExtractConfig = DEFAULT, answers: DataFrame | None = None) -> DataFrame:
    """Per (survey, own department key): unit, recoded unit, first-encounter
    department, unit-mapped department, and the resolved keys (R1, R2)."""
    answers = filtered_answers(inp, cfg) if answers is None else answers
    enc = first_encounter(inp.encounters)
    unit = survey_attribute(answers, cfg.unit_question, "unit", L.NULL_UNIT)
    rows = (answers.select("survey_id", "account_key", "department_key").distinct()
            .join(enc, "account_key", "left").join(unit, "survey_id", "left"))
    rows = D.recode(rows, "unit", L.unit_aliases(inp.spark), "der_unit")
    rows = D.recode(rows, "unit", L.goal_unit_aliases(inp.spark), "goal_unit")
    rows = D.department_by_unit(rows, "unit", "der_unit", L.unit_mapping(inp.spark), L.unit_overrides(inp.spark),
                                inp.departments.select("department_id", "department_key"))
    own, enc_k, dep_k = F.col("department_key"), F.col("enc_department_key"), F.col("dep_department_key")
    goal_own = D.goal_department_key(own, F.col("unit"), L.GOAL_UNIT_KEYS, L.GOAL_NO_UNIT_KEYS)
    return rows.select(
        "*",
        D.resolve_department(own, F.col("der_unit"), dep_k, enc_k, L.CLOSED_UNIT).alias("resolved_department_key"),
        goal_own.alias("goal_department_key"),
        D.resolve_department(goal_own, F.col("goal_unit"), dep_k, enc_k, L.CLOSED_UNIT).alias("goal_resolved_department_key"),
    )


# ---------------------------------------------------------------------------
# Service-line extracts by the surveys' locations (P3 and the child form of it)
# ---------------------------------------------------------------------------
from dataclasses import replace  # noqa: E402

from boxscore.functions import labels as V  # noqa: E402
from boxscore.operators.aggregations import sub_service_line  # noqa: E402
from boxscore.operators.goals import all_goals, flat_goals, goal_in, goals_by_domain  # noqa: E402
from boxscore.operators.report_dates import dual_date  # noqa: E402
from boxscore.operators.rollups import rollup_lines, shared_clinics, suffix_marked, with_shared  # noqa: E402
from boxscore.plans.extract import answer_dates, answer_detail, finish  # noqa: E402

LINE_CFG = replace(DEFAULT, event_type="Child Inpatient Survey", date_mode="full")
CHILD_CFG = replace(DEFAULT, event_type="Child Survey by Line", date_mode="full")


def line_locations(inp: Inputs, resolved: DataFrame, outpatient: bool = False) -> DataFrame:
    """Department -> location master -> service line (V12), sub service
    line (A2), clinic label (V11) for each resolved department key. The
    outpatient forms of both labels read the location master only."""
    deps = inp.departments.select(F.col("department_key").alias("resolved_department_key"),
                                  F.col("department_id").alias("epic_department_id"),
                                  F.col("department_name").alias("epic_department_name"))
    lm = inp.location_master.select(F.col("department_id").alias("epic_department_id"),
                                    F.col("department_name").alias("loc_name"), "service_line_id", "operational_service",
                                    F.col("service_line").alias("loc_service_line"))
    mdm = sub_service_line(inp.location_master).withColumnRenamed("department_id", "epic_department_id")
    x = resolved.join(deps, "resolved_department_key", "left").join(lm, "epic_department_id", "left") \
        .join(mdm, "epic_department_id", "left")
    return x.select(
        "*",
        V.service_line(F.col("loc_service_line"), F.col("operational_service") if outpatient else None).alias("service_line"),
        (V.clinic_label_outpatient(F.col("loc_name"), F.col("epic_department_id")) if outpatient else
         V.clinic_label2(F.col("loc_name"), F.col("epic_department_id"), F.col("epic_department_name"),
                         F.col("epic_department_id"))).alias("clinic"),
    ).drop("loc_name", "loc_service_line", "operational_service")


def line_goal_key(year: str, domain: str):
    return F.concat_ws("|", F.col(year).cast("string"), F.col(domain))


def with_line_goals(rows: DataFrame, inp: Inputs) -> DataFrame:
    """Goals of a frame's service lines by (fiscal year, domain), and those of 'All Service Lines', as maps."""
    g = inp.adult_goals.where((F.col("epic_department_id") == L.ALL_UNITS) & F.col("domain").isNotNull())
    g = g.select("service_line", line_goal_key("goal_fiscal_yr", "domain").alias("domain"), "goal")
    of_line = goals_by_domain(g.where(F.col("service_line") != L.ALL_SERVICE_LINES), {"service_line": "service_line"}, "line_goals")
    return (rows.join(of_line, "service_line", "left")
            .withColumn("every_goals", all_goals(g.where(F.col("service_line") == L.ALL_SERVICE_LINES))))


def line_goal_columns():
    key = F.when(F.col("domain_goals").isNotNull(), line_goal_key("fy", "domain_goals"))
    return {"goal": F.try_element_at("line_goals", key), "goal_all_lines": F.try_element_at("every_goals", key)}


def line_surveys(inp: Inputs, cfg: ExtractConfig, answers: DataFrame, outpatient: bool = False) -> DataFrame:
    """Per survey: the department of the R1 cascade, its location and its line."""
    sud = survey_unit_departments(inp, cfg, answers).select("survey_id", "resolved_department_key", "unit")
    return line_locations(inp, sud.distinct(), outpatient)


def line_scored(inp: Inputs, cfg: ExtractConfig = LINE_CFG, outpatient: bool = False, rows: DataFrame | None = None,
                goals: dict | None = None) -> DataFrame:
    """SVC stage: scored answers whose department comes from the R1 cascade.
    ``rows`` are the surveys' locations with whatever maps ``goals`` reads."""
    answers = filtered_answers(inp, cfg)
    rows = line_surveys(inp, cfg, answers, outpatient) if rows is None else rows
    a = answer_detail(inp, answers, cfg, survey_extra=rows)
    return a.withColumns(goals or {}).drop("line_goals", "every_goals").distinct()


def clinics_seen(inp: Inputs, cfg: ExtractConfig, rows: DataFrame, key: str = "clinic") -> DataFrame:
    """(key, line) of the surveys that have an answer in the extract."""
    asked = (filtered_answers(inp, cfg).select("survey_id", "question_id")
             .join(F.broadcast(inp.questions.select("question_id")), "question_id", "left_semi").select("survey_id").distinct())
    return rows.join(asked, "survey_id", "left_semi").select(key, "service_line").distinct()


def shared_keys(inp: Inputs, cfg: ExtractConfig, rows: DataFrame, key: str = "clinic") -> DataFrame:
    """The keys seen in several lines; the surveys are marked by them, so that the answers are not joined to the list."""
    return shared_clinics(clinics_seen(inp, cfg, rows, key), key, "service_line", key, L.ALL_SERVICE_LINES)


def line_extract(inp: Inputs, cfg: ExtractConfig = LINE_CFG, outpatient: bool = False) -> DataFrame:
    """Service-line extract. The own arm reports on both spines (full
    outer, both limited to the window); the 'All Service Lines' copy keeps
    rows matched on both dates (inner). Clinics seen in several lines get
    a ' - line' suffix (not on the roll-up rows)."""
    rows = line_surveys(inp, cfg, filtered_answers(inp, cfg), outpatient)
    marked = with_shared(rows, shared_keys(inp, cfg, rows))
    staged = line_scored(inp, cfg, outpatient, with_line_goals(marked, inp), line_goal_columns())
    return line_result(inp, cfg, staged, clipped=True)


def line_result(inp: Inputs, cfg: ExtractConfig, staged: DataFrame, suffix_col: str = "clinic", clipped: bool = False) -> DataFrame:
    spined = dual_date(staged, inp.days(cfg.start, cfg.end), cfg.start, cfg.end, mode="full", discharge_start=cfg.start, dates=answer_dates(inp, cfg))
    both = F.col("survey_id").isNotNull() & F.col("event_date_disch").isNotNull()
    rolled = rollup_lines(spined, copy_if=both if clipped else None)
    return finish(suffix_marked(rolled, suffix_col, skip_value_col="service_line", skip_value=L.ALL_SERVICE_LINES), cfg)


def child_extract(inp: Inputs, cfg: ExtractConfig = CHILD_CFG, suffix_col: str = "clinic",
                  clipped: bool = False) -> DataFrame:
    """Child survey by the service line of the surveys' locations, with flat goals
    (G3): the own row takes the 'All Units' goal of (line, domain), the roll-up
    the one of 'All Service Lines'.

    The test-copy variant (``suffix_col="unit", clipped=True``) suffixes the
    unit instead of the clinic when it appears in several lines, and keeps
    the roll-up copy only for rows matched on both report dates."""
    answers = filtered_answers(inp, cfg)
    rows = line_surveys(inp, cfg, answers)
    domains = F.broadcast(inp.rules.select("question_id", "domain"))
    asked = answers.select("survey_id", "question_id", "service_code").join(domains, "question_id").select("survey_id", "service_code", "domain").distinct()
    flat = flat_goals(asked.join(rows.select("survey_id", "service_line", "unit"), "survey_id", "left"), L.FLAT_GOAL, L.FLAT_GOAL_YEAR)
    flat = flat.where(F.col("unit") == L.ALL_UNITS)
    of_line = goals_by_domain(flat.where(F.col("service_line") != L.ALL_SERVICE_LINES), {"service_line": "service_line"}, "line_goals")
    mapped = (with_shared(rows, shared_keys(inp, cfg, rows, suffix_col), suffix_col).join(of_line, "service_line", "left")
              .withColumn("every_goals", all_goals(flat.where(F.col("service_line") == L.ALL_SERVICE_LINES))))
    staged = line_scored(inp, cfg, rows=mapped, goals={"goal": goal_in("line_goals"), "goal_all_lines": goal_in("every_goals")})
    return line_result(inp, cfg, staged, suffix_col, clipped)


# ---------------------------------------------------------------------------
# Reporting-table loads
# ---------------------------------------------------------------------------
from boxscore.functions.calendar import period_label  # noqa: E402
from boxscore.sources.tables import FIXED_LOAD_DTM  # noqa: E402


def response_summary(inp: Inputs, cfg: ExtractConfig = DEFAULT, load_dtm: str = FIXED_LOAD_DTM,
                     groups: bool = False) -> DataFrame:
    """Distinct (department, domain, question, day) rows with clinic and
    service-line labels. Known departments only; questions without a domain
    are dropped. ``groups=True`` is the grouped form: the department's group
    name (J14, default 'Other') as an extra column."""
    from boxscore.operators.filters import known_department
    a = known_department(filtered_answers(inp, cfg))
    unit = survey_attribute(a, cfg.unit_question, "unit", L.NULL_UNIT)
    cal = inp.calendar.select(F.col("day_date").alias("received_date"), "quarter_name", "month_short_name")
    deps = inp.departments.select("department_key", "department_id", "department_name")
    dom = inp.rules.select("question_id", "domain").where(F.col("domain").isNotNull())
    rows = (a.select("survey_id", "question_id", "department_key", "received_date", "discharge_date")
            .join(F.broadcast(cal), "received_date", "inner")
            .join(deps, "department_key", "left")
            .join(F.broadcast(dom), "question_id", "inner")
            .join(unit, "survey_id", "left")
            .select("department_id", "department_name", "unit", "domain", "question_id",
                    period_label(F.col("received_date")).alias("rpt_prd"),
                    F.col("received_date").alias("event_date"), F.col("discharge_date").alias("event_date_disch"),
                    "quarter_name", "month_short_name")
            .distinct())
    out = rows.select(
        V.service_line_display(F.lit(cfg.service_line), F.lit(cfg.sub_service_line)).alias("service_line"),
        V.clinic_label(F.col("department_name"), F.col("department_id")).alias("clinic"),
        F.col("department_id").alias("epic_department_id"), "domain", "question_id", "rpt_prd", "event_date",
        "event_date_disch", "quarter_name", "month_short_name")
    if groups:
        from boxscore.operators.joins import with_group
        out = with_group(out, L.department_groups(inp.spark)).drop("group_id") \
            .withColumnRenamed("group_name", "department_group_name")
    return out.withColumn("load_dtm", F.lit(load_dtm).cast("timestamp_ntz"))


def locations(inp: Inputs, cfg: ExtractConfig = DEFAULT, load_dtm: str = FIXED_LOAD_DTM,
              external: bool = False) -> DataFrame:
    """Picklist of (service line, clinic, department) from the
    resolved department of each survey; P10 labels clinics by an external
    name (V18): the location master's where it knows the department, else
    the department's own."""
    sud = survey_unit_departments(inp, cfg).select("survey_id", "resolved_department_key", "unit").distinct()
    loc = line_locations(inp, sud)
    if external:
        ext = inp.departments.select(F.col("department_id").alias("epic_department_id"), "external_name")
        master = inp.location_master.select(F.col("department_id").alias("epic_department_id"),
                                            F.col("department_name").alias("master_name"),
                                            F.col("external_name").alias("master_external_name"))
        loc = (loc.join(ext, "epic_department_id", "left").join(master, "epic_department_id", "left")
               .withColumn("clinic", V.external_name(F.col("master_name"), F.col("master_external_name"), F.col("external_name"))))
    # surveys without a resolved department keep their row (NULL department)
    return (loc.select("service_line", "clinic", "epic_department_id").distinct()
            .withColumn("load_dtm", F.lit(load_dtm).cast("timestamp_ntz")))


def response_summary_mapped(inp: Inputs, cfg: ExtractConfig = DEFAULT, load_dtm: str = FIXED_LOAD_DTM) -> DataFrame:
    """P8, warehouse form: the department is the one the survey resolves to (own
    key, else unit mapping, else first encounter; R1), also where it is unknown.
    The cascade runs on the distinct survey keys; the answers meet it there and
    the department's names join the distinct reporting rows."""
    answers = filtered_answers(inp, cfg)
    keys = ["survey_id", "account_key", "department_key"]
    resolved = survey_unit_departments(inp, cfg, answers).select(*[F.col(k).alias(f"__{k}") for k in keys], "unit", "resolved_department_key").distinct()
    domains = F.broadcast(inp.rules.select("question_id", "domain").where(F.col("domain").isNotNull()))
    a = answers.select(*keys, "question_id", "received_date", "discharge_date").join(domains, "question_id", "inner")
    on = [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys]
    rows = (a.join(resolved, on, "left").select("resolved_department_key", "unit", "domain", "question_id", "received_date", "discharge_date").distinct())
    calendar = F.broadcast(inp.calendar.select(F.col("day_date").alias("received_date"), "quarter_name", "month_short_name"))
    deps = inp.departments.select(F.col("department_key").alias("resolved_department_key"), "department_id", "department_name")
    master = inp.location_master.select("department_id", F.col("department_name").alias("master_name"))
    named = rows.join(calendar, "received_date", "left").join(deps, "resolved_department_key", "left").join(master, "department_id", "left")
    return named.select(
        V.service_line_display(F.lit(cfg.service_line), F.lit(cfg.sub_service_line)).alias("service_line"),
        V.clinic_label2(F.col("master_name"), F.col("department_id"), F.col("department_name"), F.col("department_id")).alias("clinic"),
        F.col("department_id").alias("epic_department_id"), "domain", "question_id", period_label(F.col("received_date")).alias("rpt_prd"),
        F.col("received_date").alias("event_date"), F.col("discharge_date").alias("event_date_disch"), "quarter_name",
        "month_short_name").distinct().withColumn("load_dtm", F.lit(load_dtm).cast("timestamp_ntz"))


def load_response_summary(inp: Inputs, path: str, cfg: ExtractConfig = DEFAULT, mapped: bool = False) -> str:
    """P8 as a load: the summary replaces the table's contents."""
    from boxscore.sources import sinks
    rows = response_summary_mapped(inp, cfg) if mapped else response_summary(inp, cfg)
    return sinks.load_table(rows, path, sinks.RESPONSE_SUMMARY_SCHEMA)


def load_locations(inp: Inputs, path: str, cfg: ExtractConfig = DEFAULT, external: bool = False) -> str:
    """P9 / P10 as a load: the picklist replaces the table's contents."""
    from boxscore.sources import sinks
    return sinks.load_table(locations(inp, cfg, external=external), path, sinks.LOCATIONS_SCHEMA)
