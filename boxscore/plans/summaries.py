"""Summary reports (P11-P14) over the scored answer stage."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boxscore.functions.calendar import fiscal_year
from boxscore.operators import aggregations as A
from boxscore.operators import filters as Fl
from boxscore.operators.joins import in_loaded_years
from boxscore.operators.ordering import report_order
from boxscore.plans.config import DEFAULT, ExtractConfig
from boxscore.plans.extract import summary_answers
from boxscore.sources.tables import Inputs

# survey side first, then the department whose goal applies
SUMMARY_KEYS = ["rec_fy", "month_num", "month_short_name", "unit", "epic_department_id", "epic_department_name",
                "goal_epic_department_id", "clinic", "service_line_id", "service_line", "domain_goals"]


def with_month(inp: Inputs, df: DataFrame, cfg: ExtractConfig = DEFAULT) -> DataFrame:
    """Month attributes of the received date (broadcast calendar: its size
    is fixed by the window, which the answers lie in)."""
    cal = inp.days(cfg.start, cfg.end).select(F.col("day_date").alias("received_date"), "month_num", "month_short_name")
    return df.join(F.broadcast(cal), "received_date", "left")


def window_years(cfg: ExtractConfig) -> list[int]:
    import datetime as dt
    s, e = dt.date.fromisoformat(cfg.start), dt.date.fromisoformat(cfg.end)
    fy = lambda d: d.year + 1 if d.month >= 7 else d.year
    return list(range(fy(s), fy(e) + 1))


def score_summary(inp: Inputs, cfg: ExtractConfig = DEFAULT) -> DataFrame:
    """Monthly top-box score per unit/department/domain with its goal,
    for the fiscal years of the report window."""
    s = Fl.reportable_domains(with_month(inp, summary_answers(inp, cfg), cfg))
    out = A.score_summary(s, [*SUMMARY_KEYS, "goal"])
    cal_years = (inp.calendar.where(F.col("day_date").between(F.lit(cfg.start).cast("date"), F.lit(cfg.end).cast("date")))
                 .select(F.col("fyear_num").alias("rec_fy")))
    out = in_loaded_years(out, cal_years, year_col="rec_fy", df_year_col="rec_fy")
    out = Fl.for_fiscal_years(out, years=window_years(cfg))
    return report_order(out, ["rec_fy", "unit", "epic_department_id", "epic_department_name", "service_line", "domain_goals", "month_num", "month_short_name"])
