"""Output ordering (O1, O2). Sorting is applied only to final report
output, never to a stage: a global sort is a range-partitioned shuffle, and
the reference's pre-insert sorts (O3) only served clustered indexes, so
they are dropped."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def report_order(df: DataFrame, keys: list[str]) -> DataFrame:
    """O1: final multi-key report order (ascending, NULLs first as in the
    source database)."""
    return df.orderBy(*[F.col(k).asc_nulls_first() for k in keys])


def by_count_within(df: DataFrame, within: list[str], count_col: str = "n", then: tuple[str, ...] = ()) -> DataFrame:
    """O2: order by count descending inside each group (e.g. month), equal counts by the keys ``then``."""
    return df.orderBy(*[F.col(k).asc_nulls_first() for k in within], F.col(count_col).desc(), *[F.col(k).asc_nulls_first() for k in then])
