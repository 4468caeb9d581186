"""Row-level scoring (V1-V5, V17) driven by a rules table.

The answer scales live in data (``sources.lookups.QUESTION_RULES``), not in
code: one broadcast join attaches scale, top-box answers, label and
goal-domain override to each answer, and the columns below read them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from boxscore.sources.lookups import AGE_QUESTION, FIVE_POINT_LABELS, RATING_BANDS

RULE_COLS = ["scale", "top_values", "top_label", "domain_override"]


def with_rules(df: DataFrame, rules: DataFrame, extra: list[str] | None = None) -> DataFrame:
    """Attach the rule columns by question (left join; the rules table is a
    fixed inline literal, so broadcasting it is bounded)."""
    cols = ["question_id"] + RULE_COLS + (extra or [])
    return df.join(F.broadcast(rules.select(*cols)), "question_id", "left")


def answered(value: Column) -> Column:
    """V4: 1 when the answer is present."""
    return F.when(value.isNotNull(), 1).otherwise(0)


def top_box(value: Column, top_values: Column | None = None) -> Column:
    """V1: 1 when the answer is one of the scale's top answers; else 0
    (NULL answers and unscaled questions included)."""
    top_values = F.col("top_values") if top_values is None else top_values
    return F.coalesce(F.array_contains(top_values, value).cast("int"), F.lit(0))


def top_box_label(scale: Column | None = None, label: Column | None = None) -> Column:
    """V2: the expected best answer; NULL when the question has no scale."""
    scale = F.col("scale") if scale is None else scale
    label = F.col("top_label") if label is None else label
    return F.when(scale.isNotNull(), label)


def _case(value: Column, pairs, default: Column | None = None) -> Column:
    expr = None
    for answer, label in pairs:
        expr = (F.when(value == answer, label) if expr is None else expr.when(value == answer, label))
    return expr if default is None else expr.otherwise(default)


def response_group(value: Column, question_id: Column, age_question: int,
                   scale: Column | None = None) -> Column:
    """V3: five-level response group.

    0-10 ratings are banded (unlisted answers -> NULL); the age answer is
    passed through; any other answer of 1..5 gets its label, else the raw
    answer.
    """
    scale = F.col("scale") if scale is None else scale
    band = None
    for label, answers in RATING_BANDS:
        cond = value.isin(*answers)
        band = F.when(cond, label) if band is None else band.when(cond, label)
    five = _case(value, FIVE_POINT_LABELS, default=value)
    return (F.when(scale == "0-10", band)
            .when(question_id == age_question, value)
            .otherwise(five))


def goal_domain(domain: Column | None = None, override: Column | None = None) -> Column:
    """V5: questions with their own goal report under the override domain."""
    domain = F.col("domain") if domain is None else domain
    override = F.col("domain_override") if override is None else override
    return F.coalesce(override, domain)


def as_text(c: Column) -> Column:
    """Normalise an answer to text before export."""
    return c.cast("string")


def score_columns(df: DataFrame, age_question: int) -> DataFrame:
    """Apply V1-V5 to a frame that already carries the rule columns."""
    v = F.col("value")
    return df.select(
        "*",
        answered(v).alias("val_count"),
        goal_domain().alias("domain_goals"),
        response_group(v, F.col("question_id"), age_question).alias("value_resp_grp"),
        top_box(v).alias("top_box"),
        top_box_label().alias("top_box_response"),
    )


def with_survey_rules(df: DataFrame, rules: DataFrame, survey_type: Column) -> DataFrame:
    """V1-V3, V5 by survey type: scales, response groups and domains of (survey
    type, question), and the score columns. The rules are an inline literal.

    The same answer may be a top answer in one survey type and not in another
    ("10-Best possible" in a hospital's, "10-Best provider" in a clinic's).
    """
    r = F.broadcast(rules.withColumnRenamed("survey_type", "__type").withColumnRenamed("question_id", "__question"))
    x = df.withColumn("survey_type", survey_type)
    x = x.join(r, (x["survey_type"] == r["__type"]) & (x["question_id"] == r["__question"]), "left")
    v = F.col("value")
    group = F.try_element_at("groups", v)
    is_age = F.col("question_id") == F.lit(AGE_QUESTION)
    return x.select(
        *df.columns, "survey_type", "question_text", "question_text_alias", "domain",
        goal_domain().alias("domain_goals"), answered(v).alias("val_count"),
        F.when(is_age | F.col("groups").isNull(), v).when(F.col("closed"), group).otherwise(F.coalesce(group, v)).alias("value_resp_grp"),
        top_box(v).alias("top_box"), F.col("top_label").alias("top_box_response"))
