import datetime as dt

from pyspark.sql import functions as F

from boxscore.functions.calendar import date_spine
from boxscore.operators import benchmarks as B
from boxscore.operators import departments as D
from boxscore.operators import filters as Fl
from boxscore.operators import joins as J
from boxscore.operators import rollups as U
from boxscore.operators.report_dates import dual_date


def test_designator_filter_keeps_null_and_code(spark):
    df = spark.createDataFrame([("PC",), (None,), ("MD",)], "designator string")
    assert sorted(str(r.designator) for r in Fl.designator_ok(df).collect()) == ["None", "PC"]


def test_fiscal_year_starts_in_july(spark):
    cal = {r.day_date: r.fyear_num for r in date_spine(spark, "2018-06-30", "2018-07-01").collect()}
    assert cal == {dt.date(2018, 6, 30): 2018, dt.date(2018, 7, 1): 2019}


def _answers(spark):
    return spark.createDataFrame(
        [(1, dt.date(2020, 1, 2), dt.date(2020, 1, 1)), (2, dt.date(2020, 1, 2), dt.date(2019, 12, 1))],
        "survey_id long, received_date date, discharge_date date")


def test_dual_date_modes(spark):
    cal = date_spine(spark, "2019-11-01", "2020-01-31")
    a = _answers(spark)
    left = dual_date(a, cal, "2020-01-01", "2020-01-03", mode="left").collect()
    # 2 answers + 2 empty received days (Jan 1, Jan 3)
    assert len(left) == 4
    empty = [r for r in left if r.survey_id is None]
    assert {r.event_date for r in empty} == {dt.date(2020, 1, 1), dt.date(2020, 1, 3)}
    assert all(r.event_date_disch is None for r in empty)
    assert {r.survey_id: r.event_date_disch for r in left if r.survey_id} == {
        1: dt.date(2020, 1, 1), 2: dt.date(2019, 12, 1)}
    full = dual_date(a, cal, "2020-01-01", "2020-01-03", mode="full", discharge_start="2020-01-01").collect()
    # discharge spine Jan 1..3: Jan 2 and Jan 3 unmatched; survey 2's discharge is outside -> NULL
    assert len(full) == 6
    assert {r.survey_id: r.event_date_disch for r in full if r.survey_id} == {1: dt.date(2020, 1, 1), 2: None}
    inner = dual_date(a, cal, "2020-01-01", "2020-01-03", mode="inner", discharge_start="2020-01-01").collect()
    assert [r.survey_id for r in inner] == [1]


def test_rollup_units_label_null_without_survey(spark):
    df = spark.createDataFrame([(1, "Ward [1]", 0.5, 0.7), (None, None, None, None)],
                               "survey_id long, clinic string, goal double, goal_all_units double")
    rows = U.rollup_units(df).collect()
    assert sorted((r.survey_id or 0, r.clinic or "-", r.goal or 0) for r in rows) == [
        (0, "-", 0), (0, "-", 0), (1, "All Units", 0.7), (1, "Ward [1]", 0.5)]


def test_shared_clinic_suffix(spark):
    df = spark.createDataFrame([("A", "L1"), ("A", "L2"), ("B", "L1"), ("All Units", "L1"), ("All Units", "L2")],
                               "clinic string, service_line string")
    got = sorted(r.clinic for r in U.suffix_shared(df).collect())
    assert got == ["A - L1", "A - L2", "All Units", "All Units", "B"]


def unflagged(spark, fact_rows, surveys=(1, 2, 3, None)):
    fact = spark.createDataFrame(fact_rows, "survey_id long, question_id int, service_code string, value string")
    dim = spark.createDataFrame([(4, "IN", "CH_4"), (4, "PD", "CH_4"), (5, "IN", "CH_5")], "question_id int, service_code string, varname string")
    df = spark.createDataFrame([(s,) for s in surveys], "survey_id long")
    return sorted((r.survey_id is None, r.survey_id) for r in J.without_flagged(df, fact, dim, "CH_4", "No", "IN").collect())


def test_without_flagged_is_by_service(spark):
    flagged = [(1, 4, "IN", "No"), (2, 4, "PD", "No"), (3, 5, "IN", "No"), (3, 4, "IN", "Yes")]
    assert unflagged(spark, flagged) == [(False, 2), (False, 3)]  # a row without an id is neither in nor out


def test_without_flagged_has_the_nulls_of_not_in(spark):
    assert unflagged(spark, [(1, 4, "IN", "No"), (None, 4, "IN", "No")]) == []
    assert unflagged(spark, [(1, 4, "PD", "No")]) == [(False, 1), (False, 2), (False, 3), (True, None)]


def test_resolve_department_cascade(spark):
    df = spark.createDataFrame([(5, "U1", 50, 60), (-1, None, 50, 60), (-1, "U1", 50, 60), (-1, "U5", 50, 60)],
                               "own long, unit string, mapped long, enc long")
    got = [r.k for r in df.select(D.resolve_department(F.col("own"), F.col("unit"), F.col("mapped"), F.col("enc"),
                                                       "U5").alias("k")).collect()]
    assert got == [5, 60, 50, 60]


def test_percentile_band_edges_and_lookup(spark):
    ranks = spark.createDataFrame(
        [("D", "2", "0.0", 0, dt.date(2019, 6, 30)), ("D", "2", "50.0", 50, dt.date(2019, 6, 30)),
         ("D", "2", "100.0", 100, dt.date(2019, 6, 30)), ("D", "2", "0.0", 0, dt.date(2020, 6, 30)),
         ("D", "2", "60.0", 60, dt.date(2020, 6, 30)), ("D", "2", "100.0", 100, dt.date(2020, 6, 30))],
        "domain string, question_id string, v string, percentile_rank int, period_end date"
    ).withColumn("value", F.col("v").cast("decimal(4,1)")).drop("v")
    bands = {(str(r.value), str(r.next_value)) for r in B.latest_bands(ranks).collect()}
    # LEAD runs before keeping the newest period: 50.0 (old) ends at 100.0
    assert bands == {("0.0", "60.0"), ("50.0", "100.0"), ("60.0", "100.0"), ("100.0", "100.1")}
    scores = spark.createDataFrame([(2, "100.0"), (2, "55.0")], "question_id int, s string").withColumn(
        "score", F.col("s").cast("decimal(12,6)"))
    got = sorted((str(r.score), r.percentile_rank) for r in B.band_lookup(scores, B.latest_bands(ranks)).collect())
    # overlapping bands from two periods both match (fan-out kept)
    assert got == [("100.000000", 100), ("55.000000", 0), ("55.000000", 50)]


def test_report_orderings(spark):
    from boxscore.operators.ordering import by_count_within, report_order
    df = spark.createDataFrame([("Feb", 3), ("Jan", 1), ("Jan", 5), (None, 2)], "m string, n long")
    assert [r.n for r in report_order(df, ["m", "n"]).collect()] == [2, 3, 1, 5]
    assert [r.n for r in by_count_within(df, ["m"]).collect()] == [2, 3, 5, 1]


def test_extract_variant_switches(spark):
    """DWU / DWUC variants: designator from the raw log (with and without
    the latest-load dedup), NULL designators dropped, answer fiscal year."""
    import os
    from dataclasses import replace

    import pytest
    from boxscore.plans import extract
    from boxscore.plans.config import DEFAULT
    from boxscore.sources.tables import Inputs
    smoke = "/root/testdata/sf0.001"
    if not os.path.exists(smoke):
        pytest.skip("no smoke data")
    inp = Inputs(spark, smoke)
    base = extract.filtered_answers(inp, replace(DEFAULT, designator_source="log"))
    raw = extract.filtered_answers(inp, replace(DEFAULT, designator_source="log", designator_dedup=False))
    strict = extract.filtered_answers(inp, replace(DEFAULT, keep_null_designator=False))
    # one row per load and value without the dedup, one per (survey, value) with it
    per_value = inp.designator_log.groupBy("survey_id", "value").count()
    assert raw.count() >= base.count() and per_value.where("count > 1").count() > 0
    assert base.select("survey_id", "question_id", "designator").distinct().count() == raw.select("survey_id", "question_id", "designator").distinct().count()
    assert strict.where(F.col("designator").isNull()).count() == 0
    answers = extract.filtered_answers(inp)
    fy = extract.survey_departments(inp, answers, replace(DEFAULT, fy_source="answer")).select("survey_id", "rec_fy")
    assert fy.distinct().exceptAll(answers.select("survey_id", F.col("fy").alias("rec_fy")).distinct()).count() == 0


def plan_of(df):
    import contextlib
    import io

    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("simple")
    return out.getvalue()


def test_unit_extract_evaluates_its_answers_once(spark):
    """With automatic broadcasts off, no join of the answers is on a goal's key, and few scans and shuffles are planned."""
    from boxscore.registry import QUERIES
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        plan = plan_of(QUERIES["q_unit_extract"](spark, "/root/testdata/sf0.001"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    joins = [line for line in plan.splitlines() if "SortMergeJoin" in line]
    assert joins and not any("domain_goals" in line for line in joins)
    assert plan.count("FileScan parquet") <= MOST_SCANS and plan.count("Exchange hashpartitioning") <= MOST_EXCHANGES, (
        plan.count("FileScan parquet"), plan.count("Exchange hashpartitioning"))


MOST_SCANS, MOST_EXCHANGES = 25, 45


def test_default_window_of_an_as_of_date():
    from boxscore.plans.config import ExtractConfig
    cfg = ExtractConfig.rolling("2020-02-10", date_mode="full")
    assert (cfg.start, cfg.end, cfg.as_of, cfg.date_mode) == ("2018-02-01", "2020-02-29", "2020-02-10", "full")


def test_domain_rank_rows_are_no_question_bands(spark):
    ranks = spark.createDataFrame([("D", "Domain", "0.0", 0, dt.date(2020, 6, 30)), ("D", "2", "0.0", 0, dt.date(2020, 6, 30)),
                                   ("D", "2", "100.0", 100, dt.date(2020, 6, 30))],
                                  "domain string, question_id string, v string, percentile_rank int, period_end date"
                                  ).withColumn("value", F.col("v").cast("decimal(4,1)")).drop("v")
    scores = spark.createDataFrame([(2, "55.0")], "question_id int, s string").withColumn("score", F.col("s").cast("decimal(12,6)"))
    assert [r.percentile_rank for r in B.band_lookup(scores, B.latest_bands(ranks)).collect()] == [0]


def test_reports_come_in_their_order(spark):
    from boxscore.registry import QUERIES
    key = lambda r, cols: tuple((r[c] is not None, r[c]) for c in cols)
    rows = QUERIES["q_score_summary"](spark, "/root/testdata/sf0.001").collect()
    cols = ["rec_fy", "unit", "epic_department_id", "epic_department_name", "service_line", "domain_goals", "month_num", "month_short_name"]
    assert len(rows) > 100 and [key(r, cols) for r in rows] == sorted(key(r, cols) for r in rows)
    rows = QUERIES["q_survey_audit"](spark, "/root/testdata/sf0.001").collect()
    order = [(*key(r, ["year_num", "month_num"]), -r["survey_count"]) for r in rows]
    assert len(rows) > 100 and order == sorted(order)


def test_question_catalog_lists_every_service(spark):
    from boxscore.operators.aggregations import question_catalog
    fact = spark.createDataFrame([(1, "PD"), (1, "IN"), (1, "IN"), (2, "MD"), (9, "PD")], "question_id int, service_code string")
    questions = spark.createDataFrame([(1, "CH_1", "one"), (2, "CH_2", "two"), (9, "X", "nine")], "question_id int, varname string, question_text string")
    rows = lambda df: sorted((r.service_code, r.varname) for r in df.collect())
    assert rows(question_catalog(fact, questions, ["CH_1", "CH_2"])) == [("IN", "CH_1"), ("MD", "CH_2"), ("PD", "CH_1")]
    assert rows(question_catalog(fact, questions, ["CH_1", "CH_2"], service="PD")) == [("PD", "CH_1")]


def test_answers_of_line_extracts_are_not_shuffled_wide(spark):
    """No shuffle carries the physician's name or the question's text with the answers, no join deals them out by clinic."""
    from boxscore.registry import QUERIES
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    for name in ("q_line_extract", "q_unit_extract"):
        try:
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "20000")
            plan = plan_of(QUERIES[name](spark, "/root/testdata/sf0.01"))
        finally:
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        shuffles = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
        assert shuffles and not [x for x in shuffles if "phys_name" in x or "question_text" in x]
        assert "SortMergeJoin [clinic" not in plan


def test_on_survey_keys_matches_null_keys(spark):
    a = spark.createDataFrame([(1, None, "x"), (1, 7, "y"), (2, 8, "z")], "survey_id long, patient_key long, v string")
    s = spark.createDataFrame([(1, None, "none"), (1, 7, "seven"), (2, None, "other")], "survey_id long, patient_key long, name string")
    got = {r.v: r.name for r in J.on_survey_keys(a, s, ["survey_id", "patient_key"]).collect()}
    assert got == {"x": "none", "y": "seven", "z": None}


def test_queries_bound_the_bytes_of_a_task(spark):
    """A shuffle of some 100 MB is not dealt to as few tasks as there are cores."""
    from boxscore.sources.tables import Inputs
    Inputs.for_dir(spark, "/root/testdata/sf0.001")
    df = spark.range(1_500_000).select(F.sha2(F.col("id").cast("string"), 256).alias("h")).groupBy("h").count()
    assert df.rdd.getNumPartitions() > 12


def page_holders(plan):
    """Sorts and aggregates of a plan: each holds at least a memory page in its task."""
    return sum(plan.count(name) for name in ("Sort [", "HashAggregate(", "SortAggregate("))


def test_goal_keys_and_departments_read_the_answers_once(spark):
    """What shares a task with the answers' join stays few: one read of the fact, no join of the answers with themselves."""
    from boxscore.plans import extract
    from boxscore.sources.tables import Inputs
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        inp = Inputs.for_dir(spark, "/root/testdata/sf0.001")
        keys = plan_of(extract.goal_key_rows(inp))
        rows = plan_of(extract.survey_departments(inp, extract.filtered_answers(inp)))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    for plan in (keys, rows):
        assert plan.count("FileScan parquet [l_orderkey") == 1
        assert page_holders(plan) <= 11, page_holders(plan)


def test_every_department_of_a_survey_meets_every_domain_of_it(spark):
    """Two departments, an answer without a domain, one to an unknown question; a date outside the days is no key."""
    from boxscore.plans import extract
    from boxscore.sources.tables import Inputs
    inp = Inputs.for_dir(spark, "/root/testdata/sf0.001")
    day = dt.date(1998, 1, 5)
    answers = spark.createDataFrame(
        [(1, 5, day, 1, "2", ("A",)), (1, 5, day, 2, "3", ("A",)), (1, 6, day, 7, None, (None,)), (1, 6, day, 7, "U1", (None,)),
         (2, -1, day, 1, "2", ("B",)), (2, -1, day, 99, "2", None), (3, 5, day, 99, "2", None)],
        "survey_id long, department_key long, received_date date, question_id int, value string, asked struct<domain_goals: string>")
    got = sorted((r.epic_department_id or "", r.domain_goals or "", r.rec_fy) for r in extract.asked_departments(inp, answers).collect())
    assert got == sorted([(d, g, 1998) for d in ("10000005", "10000006") for g in ("A", "")] + [("", "B", 1998)])
    rows = sorted((r.survey_id, r.epic_department_id or "", r.unit or "") for r in extract.survey_departments(inp, answers).collect())
    assert rows == [(1, "10000005", "U1"), (1, "10000006", "U1"), (2, "", ""), (3, "10000005", "")]


def test_goal_departments_are_dealt_out_before_they_multiply(spark):
    """A department becomes a row per year and domain; its file may be one task."""
    from boxscore.sources.tables import Inputs
    inp = Inputs.for_dir(spark, "/root/testdata/sf0.001")
    for rows in (inp.goal_settings.where("department_id is not null"), inp.goals_old.where("unit like '%[%'")):
        plan = plan_of(rows)
        assert "REPARTITION_BY_NUM" in plan and plan.index("Generate") < plan.index("REPARTITION_BY_NUM") < plan.index("FileScan parquet [s_suppkey")
