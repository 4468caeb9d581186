"""Per-key attribute operators.

W1 and A1 take one answer of a survey and spread it to the survey. They
are written as a partial aggregate (one row per survey, combined map-side)
joined back on ``survey_id`` rather than a window over the survey: a hot
survey then never lands whole in one task - the aggregate is combined
before the shuffle and AQE may split the join's skewed partition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from boxscore.sources.lookups import NULL_UNIT


def survey_attribute(df: DataFrame, question_id: int, name: str, null_label: str | None = None) -> DataFrame:
    """W1 (aggregate form): MAX of the survey's answer to ``question_id``;
    a NULL answer becomes ``null_label``. Surveys without that question are
    absent here (the caller's left join gives them NULL)."""
    v = F.col("value") if null_label is None else F.coalesce(F.col("value"), F.lit(null_label))
    return (df.where(F.col("question_id") == question_id)
            .groupBy("survey_id").agg(F.max(v).alias(name)))


def spread_attribute(df: DataFrame, question_id: int, name: str = "unit",
                     null_label: str | None = NULL_UNIT) -> DataFrame:
    """MAX(CASE question THEN coalesce(value, label)) OVER (PARTITION BY
    survey), expressed as aggregate + join-back."""
    attr = survey_attribute(df, question_id, name, null_label)
    return df.join(attr, "survey_id", "left")


def spread_attribute_window(df: DataFrame, question_id: int, name: str = "unit",
                            null_label: str | None = NULL_UNIT) -> DataFrame:
    """W1 as the literal window (kept for comparison in tests)."""
    v = F.coalesce(F.col("value"), F.lit(null_label)) if null_label else F.col("value")
    return df.withColumn(name, F.max(F.when(F.col("question_id") == question_id, v))
                         .over(Window.partitionBy("survey_id")))


def max_answer(fact: DataFrame, question_id: int, name: str = "age", positive_account: bool = True) -> DataFrame:
    """A1: string MAX of one question's answer per survey (lexical: '9' > '10').
    Reads the whole fact, as the reference does (not only the windowed rows)."""
    f = fact.where(F.col("question_id") == question_id)
    if positive_account:
        f = f.where(F.col("account_key") > 0)
    return f.groupBy("survey_id").agg(F.max("value").cast("string").alias(name))


def first_encounter(enc: DataFrame, key: str = "account_key", order: str = "appt_dtm",
                    tie_break: str = "encounter_id", out: str = "enc_department_key") -> DataFrame:
    """Department of each account's first encounter.

    ``min_by`` over a struct (order, tie-break) is the partial-aggregate form
    of ROW_NUMBER() = 1: it combines map-side, so an account with a huge
    number of encounters does not pile up in one task.
    """
    return enc.groupBy(key).agg(
        F.min_by("department_key", F.struct(F.col(order), F.col(tie_break))).alias(out))


def latest_designator(log: DataFrame) -> DataFrame:
    """Latest load per (survey, value) - per value, not per survey, so a
    survey with two designators keeps both (fan-out preserved)."""
    return (log.groupBy("survey_id", "value")
            .agg(F.max_by("log_id", F.struct("load_dtm", "log_id")).alias("log_id"),
                 F.max("load_dtm").alias("load_dtm")))
