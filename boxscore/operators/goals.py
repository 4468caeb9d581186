"""Goal operators.

Goal tables are dimensions (fiscal year x department x domain); the
answers side only contributes its distinct goal keys, a small aggregate,
so the cascade never touches answer rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from boxscore.sources.lookups import ALL_GROUPS, ALL_SERVICE_LINES, ALL_UNITS

GOAL_TYPE = "decimal(4,3)"


def zero_to_null(goal: Column) -> Column:
    """A goal of 0.0 means 'no goal'."""
    return F.when(goal == 0, F.lit(None).cast(GOAL_TYPE)).otherwise(goal)


def load_goals(settings: DataFrame, domain_map: DataFrame, service: str, svc_cde: str,
               all_units_label: str, service_line: str | None, years=None,
               all_lines_arm: bool = True, load_dtm: str | None = None) -> DataFrame:
    """Goal-setting rows -> conformed goal table.

    Keep the service's rows whose unit is the all-units label or empty;
    translate goal-file domain names; then three arms: department goals,
    the line's 'All Units' goal and (optionally) the same goal for
    'All Service Lines'. ``service_line`` replaces the file's line when set.
    """
    dm = F.broadcast(domain_map.select(F.col("goals_domain").alias("__gd"), F.col("domain").alias("__td")))
    s = settings.where((F.col("service") == service)
                       & ((F.col("unit") == all_units_label) | F.col("unit").isNull()))
    if years is not None:
        s = s.where(F.col("goal_yr").isin(*years))
    s = (s.join(dm, s["domain"] == dm["__gd"], "left")
         .select(F.col("goal_yr"),
                 (F.lit(service_line) if service_line is not None else F.col("service_line")).alias("service_line"),
                 "department_id", "department_name",
                 F.when(F.col("unit") == all_units_label, F.lit(ALL_UNITS)).otherwise(F.col("unit")).alias("unit"),
                 F.col("domain").alias("raw_domain"),
                 F.coalesce("__td", "domain").alias("domain_goals"),
                 "goal"))
    ts = (F.lit(load_dtm).cast("timestamp_ntz") if load_dtm else F.current_timestamp()).alias("load_dtm")

    def conform(df: DataFrame, line: Column, unit: Column, dept_id: Column, dept_name: Column) -> DataFrame:
        return df.select(
            F.lit(svc_cde).cast("string").alias("svc_cde"),
            F.col("goal_yr").cast("int").alias("goal_fiscal_yr"),
            line.cast("string").alias("service_line"),
            unit.cast("string").alias("unit"),
            dept_id.cast("string").alias("epic_department_id"),
            dept_name.cast("string").alias("epic_department_name"),
            F.col("domain_goals").cast("string").alias("domain"),
            F.col("goal").cast(GOAL_TYPE).alias("goal"),
            ts,
        ).distinct()

    dept = conform(s.where((F.col("unit").isNull() | (F.col("unit") != ALL_UNITS))
                           & F.col("raw_domain").isNotNull() & F.col("goal").isNotNull()),
                   F.col("service_line"), F.col("unit"), F.col("department_id"), F.col("department_name"))
    all_units = s.where((F.col("unit") == ALL_UNITS) & F.col("raw_domain").isNotNull())
    out = dept.unionByName(conform(all_units, F.col("service_line"), F.lit(None), F.lit(ALL_UNITS), F.lit(None)))
    if all_lines_arm:
        out = out.unionByName(conform(all_units, F.lit(ALL_SERVICE_LINES), F.lit(None), F.lit(ALL_UNITS), F.lit(None)))
    return out


def goals_by_domain(goals: DataFrame, keys: dict[str, str], name: str) -> DataFrame:
    """One row per key with its goals as a map (domain -> goal), to be joined to
    a frame of surveys or departments: the answers then look their goal up in
    the row they have, and are never joined on a goal key. ``keys`` maps the
    goal table's columns to the frame's. A key has one goal per domain."""
    g = goals.where(F.col("domain").isNotNull()).select(*[F.col(k).alias(v) for k, v in keys.items()], "domain", F.col("goal").cast(GOAL_TYPE).alias("goal"))
    one = g.groupBy(*keys.values(), "domain").agg(F.max("goal").alias("goal"))
    return one.groupBy(*keys.values()).agg(F.map_from_entries(F.collect_list(F.struct("domain", "goal"))).alias(name))


def goal_in(name: str, domain: str = "domain_goals") -> Column:
    """The goal of a row's domain in a map of goals; NULL without map, domain or entry."""
    return F.try_element_at(F.col(name), F.col(domain))


def with_goal_maps(departments: DataFrame, goals: DataFrame, service_line: str) -> DataFrame:
    """G1 for rows of (rec_fy, goal_epic_department_id): the goals listed for the
    department and those of the line's 'All Units', as maps."""
    own = goals_by_domain(goals.where(F.col("epic_department_id") != ALL_UNITS),
                          {"goal_fiscal_yr": "rec_fy", "epic_department_id": "goal_epic_department_id"}, "department_goals")
    line = goals_by_domain(goals.where((F.col("epic_department_id") == ALL_UNITS) & (F.col("service_line") == service_line)),
                           {"goal_fiscal_yr": "rec_fy"}, "line_goals")
    return departments.join(own, ["rec_fy", "goal_epic_department_id"], "left").join(line, "rec_fy", "left")


def mapped_goals() -> list[Column]:
    """``goal`` (the department's where it lists the domain, else its line's; none
    without a department) and ``goal_all_units`` from the maps."""
    listed = F.map_contains_key("department_goals", F.col("domain_goals"))
    own = F.when(F.col("goal_epic_department_id").isNotNull() & F.col("domain_goals").isNotNull(),
                 F.when(F.col("department_goals").isNotNull() & listed, goal_in("department_goals")).otherwise(goal_in("line_goals")))
    return [own.cast(GOAL_TYPE).alias("goal"), zero_to_null(goal_in("line_goals")).cast(GOAL_TYPE).alias("goal_all_units")]


def goal_keys(scored: DataFrame, extra: list[str] | None = None) -> DataFrame:
    """The distinct goal keys of an answer stage (a small aggregate)."""
    return scored.select("rec_fy", "service_line", "epic_department_id", "goal_epic_department_id",
                         "domain_goals", *(extra or [])).distinct()


def resolve_goals(scored: DataFrame, goals: DataFrame, service_line: str,
                  group_col: str | None = None) -> DataFrame:
    """G1 (U4): goal per (fiscal year, line, goal department, goal domain).

    (a) department-specific goal; (b) keys without one get the line's
    'All Units' goal; (c) the line-level 'All Units' row; (d) the
    'All Service Lines' row for loaded years; then DISTINCT.
    With ``group_col`` (G1b) department rows carry their group, the line and
    all-lines rows read 'All Groups', and an extra arm gives each (line,
    group) the line's 'All Units' goal under the group's name.

    Every arm reads one distinct-keys aggregate of the answers, so the
    answer stage is scanned once for all of them.
    """
    keys = goal_keys(scored, [group_col] if group_col else None)
    specific = goals.where(F.col("epic_department_id") != ALL_UNITS).select(
        F.col("goal_fiscal_yr").alias("rec_fy"), F.col("epic_department_id").alias("goal_epic_department_id"),
        F.col("domain").alias("domain_goals"), "goal")
    line_all = goals.where((F.col("epic_department_id") == ALL_UNITS) & (F.col("service_line") == service_line)).select(
        F.col("goal_fiscal_yr").alias("rec_fy"), F.col("domain").alias("domain_goals"), "goal")
    on = ["rec_fy", "goal_epic_department_id", "domain_goals"]
    group = [group_col] if group_col else []
    all_groups = [F.lit(ALL_GROUPS).alias(group_col)] if group_col else []
    cols = ["rec_fy", "service_line", "goal_epic_department_id", "domain_goals", "goal", *group]
    dept_keys = keys.select("rec_fy", "service_line", "epic_department_id", "goal_epic_department_id",
                            "domain_goals", *group).distinct()

    a = dept_keys.join(specific, on, "inner").select(cols)
    b = (dept_keys.join(specific.select(*on), on, "left_anti")
         .join(line_all, ["rec_fy", "domain_goals"], "left").select(cols))
    line_keys = keys.select("rec_fy", "service_line", "domain_goals").distinct()
    c = (line_keys.join(line_all, ["rec_fy", "domain_goals"], "left")
         .select("rec_fy", "service_line", F.lit(ALL_UNITS).alias("goal_epic_department_id"), "domain_goals", "goal", *all_groups))
    years = keys.select(F.col("rec_fy").alias("goal_fiscal_yr")).distinct()
    d = (goals.where((F.col("epic_department_id") == ALL_UNITS) & (F.col("service_line") == ALL_SERVICE_LINES))
         .join(years, "goal_fiscal_yr", "left_semi")
         .select(F.col("goal_fiscal_yr").alias("rec_fy"), F.lit(ALL_SERVICE_LINES).alias("service_line"),
                 F.lit(ALL_UNITS).alias("goal_epic_department_id"), F.col("domain").alias("domain_goals"), "goal", *all_groups))
    out = a.unionByName(b).unionByName(c).unionByName(d)
    if group_col is not None:
        g = (keys.select("rec_fy", "service_line", group_col, "domain_goals").distinct()
             .join(line_all, ["rec_fy", "domain_goals"], "left")
             .select("rec_fy", "service_line", F.lit(ALL_UNITS).alias("goal_epic_department_id"),
                     "domain_goals", "goal", group_col))
        out = out.unionByName(g)
    return out.distinct()


def all_goals(goals: DataFrame, key: Column | None = None) -> Column:
    """A goal table without a department or line key as one map (key -> goal), as a
    scalar subquery: the same map for every row of a frame. ``key`` is the domain if not given."""
    one = goals.select((F.col("domain") if key is None else key).alias("key"), "goal").where("key is not null")
    one = one.groupBy("key").agg(F.max("goal").cast(GOAL_TYPE).alias("goal"))
    return one.agg(F.map_from_entries(F.collect_list(F.struct("key", "goal"))).alias("goals")).scalar()


def flat_goals(rows: DataFrame, value: str, year: int) -> DataFrame:
    """One synthetic goal per (line, unit, domain) of the answers, per (line,
    'All Units', domain) and per ('All Service Lines', 'All Units', domain). Rows
    without a domain set no goal. The levels are made in one pass over the
    distinct keys (service_code, service_line, unit, domain)."""
    keys = rows.where(F.col("domain").isNotNull()).select("service_code", "service_line", "unit", "domain").distinct()
    level = lambda line, unit: F.struct(line.alias("service_line"), unit.alias("unit"))
    levels = F.array(level(F.col("service_line"), F.col("unit")), level(F.col("service_line"), F.lit(ALL_UNITS)),
                     level(F.lit(ALL_SERVICE_LINES), F.lit(ALL_UNITS)))
    return (keys.select("service_code", "domain", F.explode(levels).alias("level"))
            .select(F.col("service_code").alias("svc_cde"), F.lit(year).alias("goal_yr"), "level.service_line", "level.unit", "domain",
                    F.lit(value).cast(GOAL_TYPE).alias("goal")).distinct())


def parse_unit_label(df: DataFrame, col: str = "unit") -> DataFrame:
    """G5: 'Name [12345678]' -> id (8 characters after '[') and name
    (text before ' ['); 'All Units' gives NULL id and name."""
    c = F.col(col)
    pos = F.instr(c, "[")
    is_all = c == ALL_UNITS
    return df.select(
        "*",
        F.when(is_all | (pos == 0), F.lit(None)).otherwise(F.substring(c, pos + 1, 8)).alias("epic_department_id"),
        F.when(is_all | (pos == 0), F.lit(None)).otherwise(F.expr(f"substring({col}, 1, instr({col}, '[') - 2)"))
        .alias("epic_department_name"),
    )


def load_goals_legacy(goals_old: DataFrame, year: int | None = None,
                      domain_map: DataFrame | None = None) -> DataFrame:
    """Older goal loads: one year (or all), split into unit rows (parsed
    label), the line's 'All Units' rows and 'All Service Lines' rows; goal-file
    domain names translated when a map is given."""
    g = goals_old if year is None else goals_old.where(F.col("goal_yr") == year)
    if domain_map is not None:
        dm = F.broadcast(domain_map.select(F.col("goals_domain").alias("__gd"), F.col("domain").alias("__td")))
        g = g.join(dm, g["domain"] == dm["__gd"], "left").withColumn("domain", F.coalesce("__td", "domain")) \
             .drop("__gd", "__td")
    g = parse_unit_label(g).where(F.col("domain").isNotNull())
    all_units = F.col("unit") == ALL_UNITS
    units = g.where((F.col("unit") != ALL_UNITS) & F.col("goal").isNotNull())
    lines = g.where(all_units & (F.col("service_line") != ALL_SERVICE_LINES))
    all_lines = g.where(all_units & (F.col("service_line") == ALL_SERVICE_LINES))

    def arm(rows: DataFrame, dept_id: Column, level: str) -> DataFrame:
        return rows.select("svc_cde", F.col("goal_yr").alias("goal_fiscal_yr"), "service_line", F.lit(None).cast("string").alias("unit"),
                           dept_id.alias("epic_department_id"), "epic_department_name", "domain",
                           F.col("goal").cast(GOAL_TYPE).alias("goal"), F.lit(level).alias("level")).distinct()

    return (arm(units, F.col("epic_department_id"), "unit").unionByName(arm(lines, F.lit(ALL_UNITS), "line"))
            .unionByName(arm(all_lines, F.lit(ALL_UNITS), "all_lines")))


def resolve_goals_legacy(df: DataFrame, goals: DataFrame, unit_col: str = "goal_unit") -> DataFrame:
    """A unit is listed if its line has any goal row for it. Listed units
    take their unit goal (NULL where the year or domain has none), all others
    their line's 'All Units' goal; a goal of zero is no goal in either arm."""
    unit_rows = goals.where(F.col("level") == "unit")
    unit_goals = unit_rows.select(F.col("goal_fiscal_yr").alias("rec_fy"), "service_line", F.col("epic_department_id").alias(unit_col),
                                  F.col("domain").alias("domain_goals"), zero_to_null(F.col("goal")).alias("goal"))
    line_goals = goals.where(F.col("level") == "line").select(
        F.col("goal_fiscal_yr").alias("rec_fy"), "service_line", F.col("domain").alias("domain_goals"),
        zero_to_null(F.col("goal")).alias("goal"))
    units = unit_goals.select("service_line", unit_col).distinct()
    listed = (df.join(units, ["service_line", unit_col], "left_semi")
              .join(unit_goals, ["rec_fy", "service_line", unit_col, "domain_goals"], "left"))
    rest = (df.join(units, ["service_line", unit_col], "left_anti")
            .join(line_goals, ["rec_fy", "service_line", "domain_goals"], "left"))
    return listed.unionByName(rest)


def goal_mapping(scored: DataFrame, goals: DataFrame) -> DataFrame:
    """Response department -> department whose goal it is measured by.

    ``goals`` has one row per goal key with the goal and ``arm``: a key whose
    goal came from the line reads 'All Units' instead of a department. Keys
    without a goal are left out; department names come from the answers'
    departments where they have one."""
    keys = scored.select("rec_fy", "epic_department_id", "epic_department_name", "goal_epic_department_id", "domain_goals").distinct()
    names = scored.select(F.col("epic_department_id").alias("goal_epic_department_id"),
                          F.col("epic_department_name").alias("goal_epic_department_name")).groupBy("goal_epic_department_id") \
        .agg(F.max("goal_epic_department_name").alias("goal_epic_department_name"))
    joined = (keys.join(goals.where(F.col("goal").isNotNull()), ["rec_fy", "goal_epic_department_id", "domain_goals"])
              .join(names, "goal_epic_department_id", "left"))
    from_line = F.col("arm") == "line"
    return joined.select(
        F.col("rec_fy").alias("response_received_fy"), F.col("epic_department_id").alias("response_department_id"),
        F.col("epic_department_name").alias("response_department_name"),
        F.when(from_line, F.lit(ALL_UNITS)).otherwise(F.col("goal_epic_department_id")).alias("goals_department_id"),
        F.when(from_line, F.lit(ALL_UNITS)).otherwise(F.col("goal_epic_department_name")).alias("goals_department_name"),
        F.col("domain_goals").alias("goals_domain"), "goal").distinct()


def goals_by_arm(scored: DataFrame, goals: DataFrame, service_line: str) -> DataFrame:
    """The goal of each (fiscal year, goal department, domain) of the answers
    and which arm supplied it: 'department', or 'line' where the department
    has no goal row of its own."""
    keys = scored.select("rec_fy", "goal_epic_department_id", "domain_goals").distinct()
    on = ["rec_fy", "goal_epic_department_id", "domain_goals"]
    own = goals.where(F.col("epic_department_id") != ALL_UNITS).select(
        F.col("goal_fiscal_yr").alias("rec_fy"), F.col("epic_department_id").alias("goal_epic_department_id"),
        F.col("domain").alias("domain_goals"), "goal")
    line = goals.where((F.col("epic_department_id") == ALL_UNITS) & (F.col("service_line") == service_line)).select(
        F.col("goal_fiscal_yr").alias("rec_fy"), F.col("domain").alias("domain_goals"), "goal")
    a = keys.join(own, on).withColumn("arm", F.lit("department"))
    b = keys.join(own.select(*on), on, "left_anti").join(line, ["rec_fy", "domain_goals"]).withColumn("arm", F.lit("line"))
    return a.unionByName(b)


def vocabulary_diff(a: DataFrame, a_col: str, b: DataFrame, b_col: str) -> DataFrame:
    """Full outer comparison of two distinct vocabularies."""
    va = a.select(F.col(a_col).alias("value")).where(F.col("value").isNotNull()).distinct().withColumn("in_a", F.lit(1))
    vb = b.select(F.col(b_col).alias("value")).where(F.col("value").isNotNull()).distinct().withColumn("in_b", F.lit(1))
    return (va.join(vb, "value", "full_outer")
            .select("value", F.coalesce("in_a", F.lit(0)).alias("in_a"), F.coalesce("in_b", F.lit(0)).alias("in_b")))
