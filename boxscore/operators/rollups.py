"""Roll-ups by self-union (U1-U3) and the shared-clinic suffix.

The reference appends an "All ..." copy by re-running the whole spine join.
Here the copy is made in one pass with ``explode`` over an array of level
structs, so the answers are read and joined once; the per-level goal is
attached before the explode as a column.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from boxscore.sources.lookups import ALL_GROUPS, ALL_SERVICE_LINES, ALL_UNITS


def explode_levels(df: DataFrame, levels: list[dict[str, Column]],
                   conds: list[Column | None] | None = None) -> DataFrame:
    """Emit one copy of each row per level; each level dict gives the
    overriding expressions for some columns (others keep their value).
    ``conds`` optionally restricts a level to rows where its condition holds."""
    names = sorted({k for lv in levels for k in lv})
    structs = [F.struct(*[(lv.get(n, F.col(n))).alias(n) for n in names]) for lv in levels]
    if conds:
        structs = [s if c is None else F.when(c, s) for s, c in zip(structs, conds)]
        arr = F.filter(F.array(*structs), lambda x: x.isNotNull())
    else:
        arr = F.array(*structs)
    rest = [c for c in df.columns if c not in names]
    return (df.select(*rest, F.explode(arr).alias("__lv"))
            .select(*rest, *[F.col(f"__lv.{n}").alias(n) for n in names]))


def label_if_survey(label: str) -> Column:
    """Roll-up label; NULL on spine rows without a survey."""
    return F.when(F.col("survey_id").isNotNull(), F.lit(label))


def rollup_units(df: DataFrame, own_goal: str = "goal", all_goal: str = "goal_all_units") -> DataFrame:
    """Each row plus an 'All Units' copy (clinic label, line goal)."""
    out = explode_levels(df, [
        {"clinic": F.col("clinic"), "goal": F.col(own_goal)},
        {"clinic": label_if_survey(ALL_UNITS), "goal": F.col(all_goal)},
    ])
    return out.drop(all_goal) if all_goal != "goal" else out


def rollup_lines(df: DataFrame, own_goal: str = "goal", all_goal: str = "goal_all_lines",
                 copy_if: Column | None = None) -> DataFrame:
    """Each row plus an 'All Service Lines' copy (only where ``copy_if``
    holds, when given - e.g. rows matched on both report dates)."""
    out = explode_levels(df, [
        {"service_line": F.col("service_line"), "goal": F.col(own_goal)},
        {"service_line": label_if_survey(ALL_SERVICE_LINES), "goal": F.col(all_goal)},
    ], conds=[None, copy_if] if copy_if is not None else None)
    return out.drop(all_goal) if all_goal != "goal" else out


def rollup_groups(df: DataFrame, own_goal: str = "goal", unit_goal: str = "goal_all_units") -> DataFrame:
    """Unit rows, 'All Units' inside each group, then 'All Units' across
    'All Groups'. The group id is a label too: its roll-up reads 'All Groups'."""
    own_id = F.col("group_id").cast("string")
    out = explode_levels(df, [
        {"clinic": F.col("clinic"), "group_id": own_id, "group_name": F.col("group_name"), "goal": F.col(own_goal)},
        {"clinic": label_if_survey(ALL_UNITS), "group_id": own_id, "group_name": F.col("group_name"), "goal": F.col(unit_goal)},
        {"clinic": label_if_survey(ALL_UNITS), "group_id": label_if_survey(ALL_GROUPS),
         "group_name": label_if_survey(ALL_GROUPS), "goal": F.col(unit_goal)},
    ])
    return out.drop(unit_goal) if unit_goal != "goal" else out


def shared_clinics(df: DataFrame, key: str = "clinic", of: str = "service_line",
                   exclude_col: str = "clinic", exclude: str = ALL_UNITS) -> DataFrame:
    """Clinics seen under more than one service line (COUNT DISTINCT > 1).
    The count is a two-level distinct aggregate: (clinic, line) pairs are
    de-duplicated map-side first, so a hot clinic costs one row per line."""
    return (df.where(F.col(exclude_col) != exclude)
            .select(key, of).distinct()
            .groupBy(key).agg(F.count(of).alias("n_lines"))
            .where(F.col("n_lines") > 1).select(key))


def suffix_shared(df: DataFrame, key: str = "clinic", of: str = "service_line",
                  exclude_col: str = "clinic", exclude: str = ALL_UNITS,
                  skip_value_col: str | None = None, skip_value: str | None = None) -> DataFrame:
    """J8: 'clinic - line' for clinics that appear in several lines.
    CASE WHEN clinic IN (subquery) becomes a left join to the distinct list
    of shared clinics plus a flag. Where the rows are a wide stage of answers,
    ``with_shared`` marks their surveys instead and ``suffix_marked`` reads the mark."""
    return suffix_marked(with_shared(df, shared_clinics(df, key, of, exclude_col, exclude), key), key, of, skip_value_col, skip_value)


def with_shared(df: DataFrame, shared: DataFrame, key: str = "clinic") -> DataFrame:
    """Rows marked (``__shared``) where their key is in the list of shared ones, which
    the departments or units bound, so that it is broadcast."""
    keys = F.broadcast(shared.select(F.col(key).alias("__k"), F.lit(True).alias("__shared")))
    return df.join(keys, df[key] == keys["__k"], "left").drop("__k")


def suffix_marked(df: DataFrame, key: str = "clinic", of: str = "service_line",
                  skip_value_col: str | None = None, skip_value: str | None = None) -> DataFrame:
    """J8 on rows whose key is already marked as shared or not."""
    cond = F.col("__shared").isNotNull()
    if skip_value_col is not None:
        cond = cond & (F.col(skip_value_col) != skip_value)
    return df.withColumn(key, F.when(cond, F.concat(F.col(key), F.lit(" - "), F.col(of))).otherwise(F.col(key))).drop("__shared")


def rollup_unit_label(df: DataFrame, own_unit: Column, all_label: Column, own_goal: str | None = "goal", all_goal: str = "goal_all") -> DataFrame:
    """U1 on the unit: each row under its own unit and under ``all_label``."""
    levels = [{"unit": own_unit}, {"unit": all_label}]
    if own_goal is not None:
        levels[0]["goal"], levels[1]["goal"] = F.col(own_goal), F.col(all_goal)
    out = explode_levels(df, levels)
    return out.drop(all_goal) if own_goal is not None else out
