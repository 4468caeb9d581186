"""Projections and predicates (F1-F12). All of them are plain Catalyst
filters, so they push down into the parquet scan where the column is a
stored one."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from boxscore.sources.lookups import EXCLUDED_REPORT_DOMAINS


def for_questions(df: DataFrame, ids) -> DataFrame:
    """keep the listed questions (duplicates in the list are harmless)."""
    return df.where(F.col("question_id").isin(*sorted(set(ids))))


def received_between(df: DataFrame, start, end, col: str = "received_date") -> DataFrame:
    """inclusive date range."""
    return df.where(F.col(col).between(F.lit(start).cast("date"), F.lit(end).cast("date")))


def designator_prefix(c: Column) -> Column:
    return F.substring(c, 1, 2)


def designator_ok(df: DataFrame, code: str = "PC", col: str = "designator") -> DataFrame:
    """keep rows whose 2-character designator is NULL or equal to ``code``."""
    c = F.col(col)
    return df.where(c.isNull() | (c == code))


def received_or_discharged_since(df: DataFrame, start) -> DataFrame:
    """either date on or after ``start``."""
    s = F.lit(start).cast("date")
    return df.where((F.col("received_date") >= s) | (F.col("discharge_date") >= s))


def known_department(df: DataFrame, col: str = "department_key") -> DataFrame:
    """usable surrogate keys are > 0 (-1 means unknown)."""
    return df.where(F.col(col) > 0)


def for_service(df: DataFrame, *codes: str) -> DataFrame:
    """service-code filter."""
    return df.where(F.col("service_code").isin(*codes))


def reportable_domains(df: DataFrame, col: str = "domain_goals",
                       excluded=tuple(EXCLUDED_REPORT_DOMAINS)) -> DataFrame:
    """F8: drop NULL and excluded domains."""
    c = F.col(col)
    return df.where(c.isNotNull() & ~c.isin(*excluded))


def for_fiscal_years(df: DataFrame, years=None, min_year: int | None = None, col: str = "rec_fy") -> DataFrame:
    """fiscal-year list and/or lower bound."""
    c = F.col(col)
    if years is not None:
        df = df.where(c.isin(*years))
    if min_year is not None:
        df = df.where(c >= min_year)
    return df


def probe(df: DataFrame, **eq) -> DataFrame:
    """equality probes used by the hand checks (one survey, one clinic...)."""
    for k, v in eq.items():
        df = df.where(F.col(k) == v)
    return df


def discharged_within(df: DataFrame, days: int, as_of: dt.date, col: str = "discharge_date") -> DataFrame:
    """discharged at most ``days`` days before the as-of date."""
    return df.where(F.datediff(F.lit(as_of).cast("date"), F.col(col)) <= days)
