import datetime as dt

from pyspark.sql import functions as F

from boxscore.functions import labels as V
from boxscore.operators import windows as W


def test_unit_spread_null_label_and_absent(spark):
    df = spark.createDataFrame([(1, 7, None), (1, 1, "5"), (2, 1, "4"), (3, 7, "U2"), (3, 2, "9")],
                               "survey_id long, question_id int, value string")
    got = {(r.survey_id, r.question_id): r.unit for r in W.spread_attribute(df, 7).collect()}
    assert got[(1, 1)] == "Null Unit" and got[(1, 7)] == "Null Unit"
    assert got[(2, 1)] is None
    assert got[(3, 2)] == "U2"
    # the aggregate + join form equals the literal window form
    win = {(r.survey_id, r.question_id): r.unit for r in W.spread_attribute_window(df, 7).collect()}
    assert win == got


def test_age_answer_is_lexical_max(spark):
    df = spark.createDataFrame([(1, 6, 5, "9"), (1, 6, 5, "10"), (2, 6, -1, "40")],
                               "survey_id long, question_id int, account_key long, value string")
    got = {r.survey_id: r.age for r in W.max_answer(df, 6).collect()}
    assert got == {1: "9"}          # '9' > '10'; account -1 ignored


def test_labels(spark):
    df = spark.createDataFrame([("Ward", "100", "Doe", "Jo", "f", "12"), (None, "101", "Doe", None, None, "x"),
                                (None, None, None, "A", "M", None)],
                               "name string, id string, last string, first string, sex string, age string")
    rows = df.select(V.clinic_label(F.col("name"), F.col("id")).alias("c"),
                     V.full_name(F.col("last"), F.col("first")).alias("n"),
                     V.sex_label(F.col("sex")).alias("s"), V.peds_flag(F.col("age")).alias("p")).collect()
    assert [r.c for r in rows] == ["Ward [100]", "Unknown [101]", None]
    assert [r.n for r in rows] == ["Doe, Jo", None, None]
    assert [r.s for r in rows] == ["Female", "Not Specified", "Male"]
    assert [r.p for r in rows] == [1, 0, 0]


def test_age_years_uses_parameter_date(spark):
    df = spark.createDataFrame([(dt.date(2000, 7, 1),)], "b date")
    r = df.select(V.age_years(F.col("b"), F.lit("2018-07-01").cast("date")).alias("a")).first()
    assert r.a == 17


def test_first_encounter_tie_break(spark):
    ts = dt.datetime(2020, 1, 1)
    enc = spark.createDataFrame([(1, 10, ts, 2), (1, 11, ts, 1), (1, 12, dt.datetime(2021, 1, 1), 0)],
                                "account_key long, department_key long, appt_dtm timestamp, encounter_id long")
    assert W.first_encounter(enc).first().enc_department_key == 11


def test_latest_designator_is_per_survey_and_value(spark):
    log = spark.createDataFrame([(1, "PC01", dt.datetime(2020, 1, 1), 1), (1, "PC01", dt.datetime(2020, 2, 1), 2),
                                 (1, "MD01", dt.datetime(2019, 1, 1), 3)],
                                "survey_id long, value string, load_dtm timestamp, log_id long")
    got = sorted((r.value, r.log_id) for r in W.latest_designator(log).collect())
    assert got == [("MD01", 3), ("PC01", 2)]


def test_hot_survey_aggregate_forms_match_window_forms(spark):
    """One survey holds most rows (a hot key): the partial-aggregate forms
    used for W1 and W2 return exactly what the literal window forms do."""
    from pyspark.sql import Window
    hot = [(1, q % 7 + 1, str(q % 5)) for q in range(3000)] + [(1, 7, "U9"), (1, 7, None)]
    rest = [(s, q, str(q)) for s in range(2, 50) for q in range(1, 8)]
    df = spark.createDataFrame(hot + rest, "survey_id long, question_id int, value string")
    agg = {(r.survey_id, r.question_id, r.value, r.unit) for r in W.spread_attribute(df, 7).collect()}
    win = {(r.survey_id, r.question_id, r.value, r.unit) for r in W.spread_attribute_window(df, 7).collect()}
    assert agg == win
    enc = spark.createDataFrame([(1, k % 11, dt.datetime(2020, 1, 1) + dt.timedelta(minutes=k % 97), k)
                                 for k in range(2000)],
                                "account_key long, department_key long, appt_dtm timestamp, encounter_id long")
    w = Window.partitionBy("account_key").orderBy("appt_dtm", "encounter_id")
    first = enc.withColumn("rn", F.row_number().over(w)).where("rn = 1").first().department_key
    assert W.first_encounter(enc).first().enc_department_key == first


def test_outpatient_labels(spark):
    from pyspark.sql import functions as F

    from boxscore.functions import labels as V
    df = spark.createDataFrame([("A", "1", "Surgery", "Therapies"), (None, "2", None, "Therapies"), ("Unknown", "3", "Unknown", "X"), ("B", "4", None, None)],
                               "name string, id string, line string, ops string")
    got = [tuple(r) for r in df.select(V.clinic_label_outpatient(F.col("name"), F.col("id")), V.service_line(F.col("line"), F.col("ops")),
                                       V.service_line(F.col("line"))).collect()]
    assert got == [("A [1]", "Surgery", "Surgery"), ("Other", "Therapies", "Other"), ("Other", "Other", "Other"), ("B [4]", "Other", "Other")]
    names = spark.createDataFrame([("A", "ext", "own"), (None, "ext", "own"), ("Unknown", None, "own")], "m string, me string, o string")
    assert [r[0] for r in names.select(V.external_name(F.col("m"), F.col("me"), F.col("o"))).collect()] == ["ext", "own", "own"]
