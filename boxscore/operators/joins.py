"""Join operators.

Broadcast policy: literals and calendars (one row per day) are hinted.
Dimensions read from tables carry no hint: Spark broadcasts them by the byte
estimate of its own statistics, AQE by runtime sizes, and beyond the
threshold the join is a shuffle join whose hot keys can be split. Building a
query runs no job.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def with_question(df: DataFrame, questions: DataFrame) -> DataFrame:
    """Inner join to the question dimension (unmatched answers drop)."""
    return df.join(questions, "question_id", "inner")


def enrich(df: DataFrame, dims: list[tuple[DataFrame, str]]) -> DataFrame:
    """Chained LEFT joins; rows with unknown keys (-1) are kept."""
    for dim, key in dims:
        df = df.join(dim, key, "left")
    return df


def without_specific_goal(keys: DataFrame, goals: DataFrame, on: list[str]) -> DataFrame:
    """Rows with no matching goal (LEFT JOIN ... IS NULL), as an anti join."""
    return keys.join(goals.select(*on), on, "left_anti")


def with_specific_goal(keys: DataFrame, goals: DataFrame, on: list[str]) -> DataFrame:
    """Rows with a matching goal (LEFT JOIN ... IS NOT NULL == inner)."""
    return keys.join(goals, on, "inner")


def without_flagged(df: DataFrame, fact: DataFrame, dim: DataFrame, varname: str, value: str, service: str) -> DataFrame:
    """Drop the surveys with a flagged answer, ``survey_id NOT IN (subquery)``.

    The subquery joins the fact to the question dimension on question and
    service, so the same answer to another service's question flags nothing.
    NOT IN is kept as it is with nulls: a flagged answer without a survey id
    leaves no row, and a row without a survey id stays only if nothing is
    flagged at all. Both are scalar subqueries beside an ordinary anti join,
    which shuffles on the survey, where a null-aware anti join would have to
    broadcast the flagged surveys.
    """
    asked = dim.where((F.col("varname") == varname) & (F.col("service_code") == service)).select("question_id", "service_code")
    flagged = fact.where(F.col("value") == value).join(F.broadcast(asked), ["question_id", "service_code"], "left_semi").select("survey_id")
    n_flagged = flagged.agg(F.count(F.lit(1))).scalar()
    n_unnamed = flagged.agg(F.count_if(F.col("survey_id").isNull())).scalar()
    named = flagged.where(F.col("survey_id").isNotNull()).distinct()
    return (df.where((n_flagged == 0) | (F.col("survey_id").isNotNull() & (n_unnamed == 0)))
            .join(named, "survey_id", "left_anti"))


def in_loaded_years(goals: DataFrame, df: DataFrame, year_col: str = "goal_fiscal_yr",
                    df_year_col: str = "rec_fy") -> DataFrame:
    """Keep goal rows of fiscal years present in ``df``."""
    years = df.select(F.col(df_year_col).alias(year_col)).distinct()
    return goals.join(years, year_col, "left_semi")


def attach_survey_attribute(df: DataFrame, attr: DataFrame) -> DataFrame:
    """Attach per-survey attribute rows (distinct) back to answers.
    A survey with two attribute values fans out - that is the semantics."""
    return df.join(attr.distinct(), "survey_id", "left")


def on_survey_keys(answers: DataFrame, surveys: DataFrame, keys: list[str]) -> DataFrame:
    """LEFT join of the answers to a frame of survey keys, null-safe on all ``keys``
    but the first, the survey id, which an answer always has.

    Only the survey id deals the rows out; the other keys are compared within it.
    So answers that lie by survey (as the fact does) are not shuffled again, and
    neither is a DISTINCT over the result. The survey side's keys are dropped."""
    s = surveys.select(*[F.col(c).alias(f"__s_{c}") if c in keys else F.col(c) for c in surveys.columns])
    cond = answers[keys[0]] == s[f"__s_{keys[0]}"]
    for k in keys[1:]:
        cond = cond & F.coalesce(answers[k] == s[f"__s_{k}"], answers[k].isNull() & s[f"__s_{k}"].isNull())
    return answers.join(s, cond, "left").drop(*[f"__s_{k}" for k in keys])


def zip_sorted(a: DataFrame, a_col: str, b: DataFrame, b_col: str) -> DataFrame:
    """J13 with W4: pair the i-th smallest distinct value of ``a`` with the
    i-th smallest of ``b``. Both inputs are distinct vocabularies (tens of
    values), so the global ordering window is over a tiny frame."""
    wa = Window.orderBy(F.col(a_col))
    wb = Window.orderBy(F.col(b_col))
    ia = a.select(a_col).distinct().select(F.row_number().over(wa).alias("idx"), a_col)
    ib = b.select(b_col).distinct().select(F.row_number().over(wb).alias("idx"), b_col)
    return ia.join(ib, "idx", "inner")


def with_group(df: DataFrame, groups: DataFrame, dept_col: str = "epic_department_id",
               default_id: int = 0, default_name: str = "Other") -> DataFrame:
    """Department group by id, defaulting to group 0 / 'Other'."""
    g = groups.select(F.col("department_id").alias("__gid"), "group_id", "group_name")
    out = df.join(F.broadcast(g), df[dept_col] == g["__gid"], "left").drop("__gid")
    return (out.withColumn("group_id", F.coalesce("group_id", F.lit(default_id)))
            .withColumn("group_name", F.coalesce("group_name", F.lit(default_name))))


def attach_goal(df: DataFrame, goals: DataFrame, keys: dict[str, str], goal_col: str = "goal") -> DataFrame:
    """LEFT join of a goal table; ``keys`` maps df column -> goal column."""
    g = goals.select(*[F.col(gk).alias(f"__g_{dk}") for dk, gk in keys.items()], F.col(goal_col).alias("__goal"))
    cond = None
    for dk in keys:
        c = df[dk] == g[f"__g_{dk}"]
        cond = c if cond is None else cond & c
    out = df.join(g, cond, "left")
    return out.drop(*[f"__g_{dk}" for dk in keys]).withColumnRenamed("__goal", "goal")
