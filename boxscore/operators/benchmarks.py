"""Percentile benchmark.

Band edges come from the rank table with LEAD over (domain, question)
ordered by (period end, value) - computed *before* keeping the newest
period per value, as the reference does. The score -> band lookup is an
equi join on the question plus a range residual; the rank table is a
dimension (questions x periods x bands) and the score side a monthly
aggregate, so Spark hashes the equi key and filters the range in-task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

TOP_EDGE = "100.1"
DOMAIN_ROW = "Domain"  # the question id of rank rows for a whole domain


def band_edges(ranks: DataFrame) -> DataFrame:
    """Next band edge per (domain, question); the 100.0 band ends at 100.1."""
    w = Window.partitionBy("domain", "question_id").orderBy("period_end", "value")
    nxt = F.when(F.col("value") == F.lit(100).cast("decimal(4,1)"), F.lit(TOP_EDGE).cast("decimal(4,1)")) \
        .otherwise(F.lead("value").over(w))
    return ranks.withColumn("next_value", nxt)


def latest_bands(ranks: DataFrame) -> DataFrame:
    """W6 (after W5): keep the newest period per (domain, question, value);
    ranks of whole domains are no question's bands."""
    w = Window.partitionBy("domain", "question_id", "value").orderBy(F.col("period_end").desc())
    return band_edges(ranks).where(F.col("question_id") != DOMAIN_ROW).withColumn("seq", F.row_number().over(w)).where(F.col("seq") == 1).drop("seq")


def monthly_counts(df: DataFrame, keys: list[str]) -> DataFrame:
    """A12, first step: answer count, top-box sum and goals of both levels per
    key. Rolling these up is the same as rolling up the answers, and small."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.sum("top_box").cast("bigint").alias("top_box"),
                                 F.max("goal").alias("goal"), F.max("goal_all_units").alias("goal_all_units"))


def monthly_percent(counts: DataFrame, keys: list[str]) -> DataFrame:
    """Monthly answer count, top-box sum, max goal and percent score over
    rolled-up monthly counts."""
    return (counts.groupBy(*keys)
            .agg(F.sum("n").cast("bigint").alias("n"), F.sum("top_box").cast("bigint").alias("top_box"),
                 F.max("goal").alias("goal"))
            .withColumn("score", percent(F.col("top_box"), F.col("n"))))


def percent(num, den):
    """num / den * 100 as DECIMAL(12,6), half-up; NULL on a zero denominator."""
    d = F.when(den != 0, den).cast("decimal(20,0)")
    return (num.cast("decimal(20,0)") * 100 / d).cast("decimal(12,6)")


def rescore_percent(monthly: DataFrame, keys: list[str]) -> DataFrame:
    """A5: roll-up of the monthly rows - percent of the summed sums."""
    return (monthly.groupBy(*keys).agg(F.sum("n").cast("bigint").alias("n"),
                                       F.sum("top_box").cast("bigint").alias("top_box"))
            .withColumn("score", percent(F.col("top_box"), F.col("n"))))


def band_lookup(scores: DataFrame, bands: DataFrame) -> DataFrame:
    """Score in [value, next_value) for the same question (LEFT join:
    scores outside every band keep a NULL rank).

    Both sides are small (monthly aggregates and a benchmark import), so the
    join strategy is left to the runtime sizes AQE sees.
    """
    b = bands.select(F.col("question_id").try_cast("int").alias("__q"), F.col("value").alias("__lo"),
                     F.col("next_value").alias("__hi"), "percentile_rank")
    cond = ((scores["question_id"] == b["__q"]) & (scores["score"] >= b["__lo"]) & (scores["score"] < b["__hi"]))
    return scores.join(b, cond, "left").drop("__q", "__lo", "__hi")
