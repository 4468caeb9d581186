"""Aggregations (A2-A12). Every aggregate here is decomposable (sum, count,
max) or a two-level distinct, so Spark combines it map-side before the
shuffle; hot groups cost one partial row per task, not one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from boxscore.sources.lookups import UNKNOWN


def ratio(num: Column, den: Column, precision: int = 4, scale: int = 3) -> Column:
    """sum/sum as DECIMAL(p,s), rounded half-up; a zero denominator gives
    NULL (the reference would raise a divide-by-zero error)."""
    n = num.cast("decimal(20,0)")
    d = F.when(den != 0, den).cast("decimal(20,0)")
    return (n / d).cast(f"decimal({precision},{scale})")


def sub_service_line(master: DataFrame, key: str = "department_id") -> DataFrame:
    """A2: MAX of the sub service line per department, ignoring 'Unknown'."""
    s = F.col("sub_service_line")
    return master.groupBy(key).agg(
        F.max(F.when(s.isNull() | (s == UNKNOWN), F.lit(None)).otherwise(s)).alias("sub_service_line"))


def response_report(df: DataFrame, keys: list[str]) -> DataFrame:
    """A3: sum top-box, sum answered and distinct surveys per key set
    (goal included in the keys: a NULL goal is its own group)."""
    return df.groupBy(*keys).agg(
        F.sum("top_box").cast("bigint").alias("top_box"),
        F.sum("val_count").cast("bigint").alias("val_count"),
        F.countDistinct("survey_id").alias("n_surveys"))


def score_summary(df: DataFrame, keys: list[str]) -> DataFrame:
    """A4: top-box score = sum(top)/sum(answered) as DECIMAL(4,3), and n."""
    return df.groupBy(*keys).agg(
        F.sum("top_box").cast("bigint").alias("top_box"),
        F.sum("val_count").cast("bigint").alias("val_count"),
        ratio(F.sum("top_box"), F.sum("val_count")).alias("score"),
        F.count(F.lit(1)).alias("n"))


def rescore(df: DataFrame, keys: list[str], num: str = "top_box", den: str = "val_count",
            precision: int = 4, scale: int = 3) -> DataFrame:
    """A5: roll-up of a roll-up: ratio of summed sums."""
    return df.groupBy(*keys).agg(
        F.sum(num).cast("bigint").alias(num), F.sum(den).cast("bigint").alias(den),
        ratio(F.sum(num), F.sum(den), precision, scale).alias("score"))


def spans_many(df: DataFrame, key: str, of: str) -> DataFrame:
    """Keys with COUNT(DISTINCT of) > 1."""
    return (df.select(key, of).distinct().groupBy(key).agg(F.count(of).alias("n_distinct"))
            .where(F.col("n_distinct") > 1))


def assignment_audit(df: DataFrame, keys: list[str]) -> DataFrame:
    """A7 over answers: row counts and top-box sums by the audit keys."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.sum("top_box").cast("bigint").alias("top_box"))


def survey_audit(df: DataFrame, survey_keys: list[str], keys: list[str]) -> DataFrame:
    """A7 over distinct surveys: the audit rows (R3) of each survey are distinct
    first, with the top-box sum and the number of their answers, then counted by the
    audit keys. Both levels combine before they are shuffled, so a frequent key
    costs one row per task and survey, then one per task."""
    per_survey = df.groupBy(*survey_keys).agg(F.sum("top_box").alias("top_box"), F.sum("val_count").alias("val_count"))
    return per_survey.groupBy(*keys).agg(F.count(F.lit(1)).alias("survey_count"), F.sum("top_box").cast("bigint").alias("top_box"),
                                         F.sum("val_count").cast("bigint").alias("val_count"))


def surveys_by(df: DataFrame, keys: list[str]) -> DataFrame:
    """Distinct surveys per key set, by a two-level aggregate."""
    return df.select(*keys, "survey_id").distinct().groupBy(*keys).agg(F.count("survey_id").alias("n_surveys"))


def question_catalog(fact: DataFrame, questions: DataFrame, varnames: list[str], service: str | None = None) -> DataFrame:
    """the questions of every service's answers (or of one ``service``'s) whose
    variable is in a list. The fact is reduced to its distinct questions before the
    dimension joins."""
    answers = fact if service is None else fact.where(F.col("service_code") == service)
    asked = answers.select("service_code", "question_id").distinct()
    return (asked.join(questions, "question_id", "left").where(F.col("varname").isin(*varnames))
            .select("service_code", "varname", "question_id", "question_text").distinct())


def value_distribution(df: DataFrame, keys: list[str]) -> DataFrame:
    """Answer counts per value within the keys."""
    return df.groupBy(*keys, "value").agg(F.count(F.lit(1)).alias("n"))


def distinct_rows(df: DataFrame, cols: list[str]) -> DataFrame:
    """A10: DISTINCT over a column list."""
    return df.select(*cols).distinct()
