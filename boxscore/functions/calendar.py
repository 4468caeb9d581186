"""Calendar spine and date helpers.

Fiscal years start on 1 July: FY2019 runs 2018-07-01 .. 2019-06-30.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

FY_START_MONTH = 7


def fiscal_year(d: Column, fy_start_month: int = FY_START_MONTH) -> Column:
    return F.year(F.add_months(d, (13 - fy_start_month) % 12)).cast("int")


def period_label(d: Column) -> Column:
    """V14: 'Mon d', e.g. 'Jul 1'."""
    return F.concat(F.date_format(d, "MMM"), F.lit(" "), F.dayofmonth(d).cast("string"))


def with_calendar_attributes(days: DataFrame, day_col: str = "day_date") -> DataFrame:
    d = F.col(day_col)
    return days.select(
        d.alias("day_date"),
        fiscal_year(d).alias("fyear_num"),
        F.concat(F.lit("Q"), F.quarter(d).cast("string"), F.lit(" "), F.year(d).cast("string")).alias("quarter_name"),
        F.month(d).alias("month_num"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.concat(F.date_format(d, "MMM"), F.lit(" "), F.year(d).cast("string")).alias("month_short_name"),
        (F.year(d) * 100 + F.month(d)).alias("month_key"),
        F.year(d).alias("year_num"),
    )


def date_spine(spark: SparkSession, start, end) -> DataFrame:
    """One row per day in [start, end] with fiscal attributes.

    The row count is fixed by the two bounds (days between them), so the
    result is a bounded dimension that may be broadcast.
    """
    s, e = dt.date.fromisoformat(str(start)), dt.date.fromisoformat(str(end))
    n = (e - s).days + 1
    days = spark.range(0, n, 1, max(1, min(8, n // 4096 + 1))).select(
        F.date_add(F.lit(s.isoformat()).cast("date"), F.col("id").cast("int")).alias("day_date"))
    return with_calendar_attributes(days)


def spine_over(df: DataFrame, *date_cols: str) -> DataFrame:
    """S8 over the data: the spine spans the earliest to the latest of the
    given date columns. The bounds come from one global aggregate (partial
    min/max per task), never through the driver."""
    lo = F.least(*[F.min(c) for c in date_cols]) if len(date_cols) > 1 else F.min(date_cols[0])
    hi = F.greatest(*[F.max(c) for c in date_cols]) if len(date_cols) > 1 else F.max(date_cols[0])
    bounds = df.agg(lo.alias("lo"), hi.alias("hi"))
    days = bounds.select(F.explode(F.sequence("lo", "hi", F.expr("interval 1 day"))).alias("day_date"))
    return with_calendar_attributes(days)


def default_window(as_of: dt.date, months_back: int = 24) -> tuple[dt.date, dt.date]:
    """first day of the month ``months_back`` months before ``as_of``
    through the last day of ``as_of``'s month. ``as_of`` is a parameter,
    never the wall clock."""
    y, m = as_of.year, as_of.month - months_back
    while m <= 0:
        m += 12
        y -= 1
    start = dt.date(y, m, 1)
    ny, nm = (as_of.year + 1, 1) if as_of.month == 12 else (as_of.year, as_of.month + 1)
    end = dt.date(ny, nm, 1) - dt.timedelta(days=1)
    return start, end


def default_window_cols(as_of: Column, months_back: int = 24) -> tuple[Column, Column]:
    """F4 as columns, for per-row as-of dates."""
    return F.trunc(F.add_months(as_of, -months_back), "MM"), F.last_day(as_of)


def default_report_window_cols(as_of: Column, start: str | None = None, fy_start_month: int = FY_START_MONTH) -> tuple[Column, Column]:
    """A fixed start of a fiscal year .. the day before as-of; without
    ``start``, the fiscal year of as-of itself."""
    fy = fiscal_year(as_of, fy_start_month)
    first = F.make_date(fy - 1, F.lit(fy_start_month), F.lit(1)) if start is None else F.lit(start).cast("date")
    return first, F.date_sub(as_of, 1)
