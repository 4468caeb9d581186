"""Report answers on a day spine by received date and by discharge date.

The reference writes ``spine LEFT JOIN answers ON received`` and then
``FULL OUTER JOIN spine2 ON discharge`` with a WHERE that decides the
effective join. Spark cannot broadcast the preserved side of an outer
join, so the literal form would shuffle every answer on its date (a skewed
key). We keep the answers as the streamed side and broadcast the spine,
which is bounded by its date range:

* answers INNER JOIN broadcast(received spine)   - answers in the window
* UNION received days with no answer             - spine ANTI JOIN distinct dates
* answers LEFT JOIN broadcast(discharge spine)   - discharge date or NULL
* mode ``full`` also UNIONs discharge days that no answer matched
* mode ``inner`` keeps only answers matched on both dates.

Modes: ``left`` (unit extract), ``full`` (adult / outpatient line
extracts), ``inner`` (service-line roll-up arm).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boxscore.functions.calendar import period_label

SPINE_COLS = ["rpt_prd", "event_date", "event_fy", "quarter_name", "month_short_name"]


def received_spine(calendar: DataFrame, start, end) -> DataFrame:
    """Days of the calendar in [start, end]; a bound of None is open."""
    d = F.col("day_date")
    days = calendar if start is None else calendar.where(d >= F.lit(start).cast("date"))
    days = days if end is None else days.where(d <= F.lit(end).cast("date"))
    return (days.select(period_label(d).alias("rpt_prd"), d.alias("event_date"), F.col("fyear_num").alias("event_fy"),
                    "quarter_name", "month_short_name"))


def discharge_spine(calendar: DataFrame, end, start=None) -> DataFrame:
    d = F.col("day_date")
    c = calendar if end is None else calendar.where(d <= F.lit(end).cast("date"))
    if start is not None:
        c = c.where(d >= F.lit(start).cast("date"))
    return c.select(d.alias("event_date_disch"))


def dual_date(df: DataFrame, calendar: DataFrame, start, end, mode: str = "left",
              discharge_start=None, received_col: str = "received_date",
              discharge_col: str = "discharge_date", dates: DataFrame | None = None, discharge_days: DataFrame | None = None) -> DataFrame:
    """``discharge_days`` is the calendar of the discharge dates where ``calendar``
    has only the received window's days. ``dates`` has the answers' two dates and nothing else, from a narrower
    plan than ``df``: the days without answers are then found without a second
    evaluation of ``df``."""
    if mode not in ("left", "full", "inner"):
        raise ValueError(f"unknown mode {mode}")
    rec = F.broadcast(received_spine(calendar, start, end))
    dis = F.broadcast(discharge_spine(calendar if discharge_days is None else discharge_days, end, discharge_start))

    matched = df.join(rec, df[received_col] == rec["event_date"], "inner")
    if mode == "inner":
        return matched.join(dis, matched[discharge_col] == dis["event_date_disch"], "inner")

    with_dis = matched.join(dis, matched[discharge_col] == dis["event_date_disch"], "left")
    dates = df if dates is None else dates
    answered_days = dates.select(F.col(received_col).alias("__d")).distinct()
    empty_days = rec.join(answered_days, rec["event_date"] == answered_days["__d"], "left_anti")
    out = with_dis.unionByName(empty_days, allowMissingColumns=True)
    if mode == "full":
        hit = (dates.select(received_col, F.col(discharge_col).alias("__d")).distinct()
               .join(rec.select("event_date"), F.col(received_col) == F.col("event_date"), "left_semi").select("__d").distinct())
        empty_dis = dis.join(hit, dis["event_date_disch"] == hit["__d"], "left_anti")
        out = out.unionByName(empty_dis, allowMissingColumns=True)
    return out
