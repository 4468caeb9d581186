from pyspark.sql import functions as F

from boxscore.functions import scoring as S
from boxscore.sources import lookups as L


def _score(spark, rows):
    df = spark.createDataFrame(rows, "question_id int, value string")
    df = S.with_rules(df, L.rules(spark), extra=["domain"])
    return {(r.question_id, r.value): r for r in S.score_columns(df, L.AGE_QUESTION).collect()}


def test_null_value_scores_zero_and_unanswered(spark):
    r = _score(spark, [(1, None)])[(1, None)]
    assert (r.top_box, r.val_count, r.value_resp_grp) == (0, 0, None)


def test_rating_bands_and_unlisted_rating(spark):
    out = _score(spark, [(2, "10-Best possible"), (2, "9"), (2, "7"), (2, "0-Worst possible"), (2, "11")])
    assert out[(2, "10-Best possible")].value_resp_grp == "Very Good"
    assert out[(2, "10-Best possible")].top_box == 1
    assert out[(2, "9")].top_box == 1
    assert out[(2, "7")].value_resp_grp == "Good" and out[(2, "7")].top_box == 0
    assert out[(2, "0-Worst possible")].value_resp_grp == "Very Poor"
    assert out[(2, "11")].value_resp_grp is None


def test_five_point_labels_age_passthrough_and_raw(spark):
    out = _score(spark, [(1, "5"), (1, "3"), (6, "5"), (3, "Always"), (7, "U3")])
    assert out[(1, "5")].value_resp_grp == "Very Good" and out[(1, "5")].top_box == 1
    assert out[(1, "3")].value_resp_grp == "Average"
    assert out[(6, "5")].value_resp_grp == "5"          # age answer untouched
    assert out[(3, "Always")].value_resp_grp == "Always" and out[(3, "Always")].top_box == 1
    assert out[(7, "U3")].top_box == 0 and out[(7, "U3")].top_box_response is None


def test_goal_domain_override(spark):
    out = _score(spark, [(2, "9"), (1, "5"), (6, "40")])
    assert out[(2, "9")].domain_goals == "Rate Hospital"
    assert out[(1, "5")].domain_goals == "Nurses Communicate Child"
    assert out[(6, "40")].domain_goals is None


def test_ratio_rounds_half_up_and_guards_zero(spark):
    from boxscore.operators.aggregations import ratio
    df = spark.createDataFrame([(2, 3), (1, 16), (0, 0)], "t long, v long")
    got = [r.s for r in df.select(ratio(F.col("t"), F.col("v")).alias("s")).collect()]
    assert [str(x) if x is not None else None for x in got] == ["0.667", "0.063", None]


def test_same_answer_in_two_survey_types(spark):
    from boxscore.functions import scoring as S
    from boxscore.sources import lookups as L
    rows = [(t, q, v) for t in (L.CHILD, L.ADULT, L.CLINIC) for q, v in
            ((2, "10-Best possible"), (2, "10-Best provider"), (2, "10-Best hosp"), (2, "7"), (4, "Yes"), (4, "Yes, definitely"), (5, "Strongly Agree"),
             (1, "5"), (1, None), (6, "5"))]
    df = spark.createDataFrame([(t, q, v) for t, q, v in rows], "kind string, question_id int, value string")
    got = {(r["kind"], r["question_id"], r["value"]): (r["top_box"], r["value_resp_grp"]) for r in
           S.with_survey_rules(df, L.survey_rules(spark), F.col("kind")).collect()}
    assert got[L.CHILD, 2, "10-Best possible"] == got[L.ADULT, 2, "10-Best possible"] == (1, "Very Good")
    assert got[L.CLINIC, 2, "10-Best possible"] == (0, None) and got[L.CLINIC, 2, "10-Best provider"] == (1, "Very Good")
    assert got[L.CHILD, 2, "10-Best hosp"] == (1, "Very Good") and got[L.ADULT, 2, "10-Best hosp"] == (0, None)
    assert got[L.CHILD, 4, "Yes"] == (0, "Yes") and got[L.ADULT, 4, "Yes"] == got[L.CLINIC, 4, "Yes"] == (1, "Yes")
    assert got[L.CHILD, 4, "Yes, definitely"] == (1, "Yes, definitely") and got[L.ADULT, 4, "Yes, definitely"][0] == 0
    assert got[L.ADULT, 5, "Strongly Agree"][0] == 1 and got[L.CHILD, 5, "Strongly Agree"][0] == 0
    assert all(got[t, 1, "5"] == (1, "Very Good") and got[t, 1, None] == (0, None) and got[t, 6, "5"] == (0, "5") and got[t, 2, "7"] == (0, "Good")
               for t in (L.CHILD, L.ADULT, L.CLINIC))
