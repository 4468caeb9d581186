"""Department resolution (J3 lives in plans.extract; J4, V15, R1-R3 here).

All lookups are inline tables or dimensions; the per-survey inputs (unit,
first encounter) are partial aggregates joined on their keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def recode(df: DataFrame, col: str, mapping: DataFrame, out: str,
           from_col: str = "unit_name", to_col: str = "current_unit") -> DataFrame:
    """Alias recode (closed / renamed units) via a broadcast lookup."""
    m = F.broadcast(mapping.select(F.col(from_col).alias("__f"), F.col(to_col).alias("__t")))
    return df.join(m, df[col] == m["__f"], "left").withColumn(out, F.coalesce("__t", col)).drop("__f", "__t")


def department_by_unit(df: DataFrame, unit_col: str, der_unit_col: str, mapping: DataFrame,
                       overrides: DataFrame, departments: DataFrame, out_key: str = "dep_department_key",
                       out_id: str = "mapped_department_id") -> DataFrame:
    """The department id is an explicit override for the unit, else the
    unit mapping's id (looked up by the recoded unit); then the department
    key by id. The CASE key is computed first, then an equi LEFT join."""
    m = F.broadcast(mapping.select(F.col("unit_name").alias("__mu"), F.col("department_id").alias("__mid")))
    o = F.broadcast(overrides.select(F.col("unit_name").alias("__ou"), F.col("department_id").alias("__oid")))
    x = (df.join(m, df[der_unit_col] == m["__mu"], "left")
         .join(o, df[unit_col] == o["__ou"], "left")
         .withColumn(out_id, F.coalesce("__oid", "__mid"))
         .drop("__mu", "__mid", "__ou", "__oid"))
    d = departments.select(F.col("department_id").alias("__did"), F.col("department_key").alias(out_key))
    return x.join(d, x[out_id] == d["__did"], "left").drop("__did")


def resolve_department(own: Column, unit: Column, mapped: Column, encounter: Column, closed_unit: str) -> Column:
    """Own key when usable (> 0); no unit -> first encounter's
    department; unit other than the closed one -> unit-mapped department;
    otherwise the encounter's."""
    return (F.when(own.isNotNull() & (own > 0), own)
            .when(unit.isNull(), encounter)
            .when(unit != closed_unit, mapped)
            .otherwise(encounter))


def goal_department_key(own: Column, unit: Column, unit_keys: dict[str, int],
                        no_unit_keys: dict[int, int]) -> Column:
    """R2 (first step): goal department overrides - a unit whose goals are
    defined under another department, and surveys without a unit from a
    given department - else the own key."""
    expr = None
    for u, k in unit_keys.items():
        c = unit == u
        expr = F.when(c, F.lit(k)) if expr is None else expr.when(c, F.lit(k))
    for src, k in no_unit_keys.items():
        c = unit.isNull() & (own == src)
        expr = F.when(c, F.lit(k)) if expr is None else expr.when(c, F.lit(k))
    return own if expr is None else expr.otherwise(own)


def department_audit(df: DataFrame, departments: DataFrame, own: str = "department_key",
                     mapped: str = "dep_department_key", period: tuple[str, ...] = ()) -> DataFrame:
    """Per survey, the department the survey was assigned (own key), the
    department its unit maps to, and the one the dashboard shows (mapped key,
    else own key), by name - DISTINCT rows for side-by-side review, with the
    ``period`` columns (fiscal year, month, year, designator) of its answers."""
    names = departments.select("department_key", "department_name")

    def name_of(key_col, alias):
        n = names.select(F.col("department_key").alias(f"__k_{alias}"), F.col("department_name").alias(alias))
        return n, F.col(key_col) == F.col(f"__k_{alias}")

    x = df.withColumn("__dash", F.coalesce(F.col(mapped), F.col(own)))
    for key_col, alias in ((own, "assigned_department_name"), (mapped, "derived_department_name"),
                           ("__dash", "dashboard_department_name")):
        n, cond = name_of(key_col, alias)
        x = x.join(n, cond, "left").drop(f"__k_{alias}")
    return x.select("survey_id", *period, "unit", "der_unit", "assigned_department_name", "derived_department_name",
                    "dashboard_department_name").distinct()
