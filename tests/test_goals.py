from decimal import Decimal

from pyspark.sql import functions as F

from boxscore.operators import goals as G


def _goals(spark):
    rows = [
        ("PD", 2020, "WC", "D1", "Care", "0.800"),
        ("PD", 2020, "WC", "All Units", "Care", "0.700"),
        ("PD", 2020, "WC", "All Units", "Rate", "0.000"),
        ("PD", 2020, "All Service Lines", "All Units", "Care", "0.600"),
    ]
    return spark.createDataFrame(rows, "svc_cde string, goal_fiscal_yr int, service_line string, "
                                       "epic_department_id string, domain string, g string") \
        .withColumn("goal", F.col("g").cast("decimal(4,3)")).drop("g")


def test_goal_cascade_arms(spark):
    scored = spark.createDataFrame(
        [(2020, "WC", "D1", "D1", "Care"), (2020, "WC", "D2", "D2", "Care"), (2020, "WC", "D2", "D2", "Rate")],
        "rec_fy int, service_line string, epic_department_id string, goal_epic_department_id string, domain_goals string")
    got = {(r.service_line, r.goal_epic_department_id, r.domain_goals): r.goal
           for r in G.resolve_goals(scored, _goals(spark), "WC").collect()}
    assert got[("WC", "D1", "Care")] == Decimal("0.800")            # (a) specific
    assert got[("WC", "D2", "Care")] == Decimal("0.700")            # (b) fallback to line
    assert got[("WC", "All Units", "Care")] == Decimal("0.700")     # (c) line level
    assert got[("All Service Lines", "All Units", "Care")] == Decimal("0.600")  # (d)
    assert got[("WC", "D2", "Rate")] == Decimal("0.000")            # zero kept in the cascade


def test_zero_goal_is_null_in_rollup(spark):
    df = spark.createDataFrame([("0.000",), ("0.750",)], "g string").withColumn("g", F.col("g").cast("decimal(4,3)"))
    assert [r.z for r in df.select(G.zero_to_null(F.col("g")).alias("z")).collect()] == [None, Decimal("0.750")]


def test_parse_unit_label(spark):
    df = spark.createDataFrame([("WARD 7 [10243067]",), ("All Units",)], "unit string")
    rows = {r.unit: (r.epic_department_id, r.epic_department_name) for r in G.parse_unit_label(df).collect()}
    assert rows == {"WARD 7 [10243067]": ("10243067", "WARD 7"), "All Units": (None, None)}


def test_legacy_listed_units_never_fall_back(spark):
    """A unit with any goal row of its line keeps its own (missing) goal; zero goals are no goals."""
    goals = spark.createDataFrame(
        [("unit", 2020, "L", "U1", "Care", "0.500"), ("unit", 2020, "L", "U3", "Care", "0.000"), ("line", 2020, "L", None, "Care", "0.600"),
         ("line", 2020, "L", None, "Rate", "0.700"), ("line", 2020, "L", None, "Food", "0.000")],
        "level string, goal_fiscal_yr int, service_line string, epic_department_id string, domain string, g string"
    ).withColumn("goal", F.col("g").cast("decimal(4,3)"))
    keys = spark.createDataFrame([(2020, "L", u, d) for u, d in [("U1", "Care"), ("U1", "Rate"), ("U2", "Care"), ("U2", "Food"), ("U3", "Care")]],
                                 "rec_fy int, service_line string, goal_unit string, domain_goals string")
    got = {(r.goal_unit, r.domain_goals): r.goal for r in G.resolve_goals_legacy(keys, goals).collect()}
    assert got == {("U1", "Care"): Decimal("0.500"), ("U1", "Rate"): None, ("U2", "Care"): Decimal("0.600"),
                   ("U2", "Food"): None, ("U3", "Care"): None}


def test_goal_mapping_names_the_line_where_it_supplied_the_goal(spark):
    scored = spark.createDataFrame([(2020, "D1", "One", "D1", "Care"), (2020, "D2", "Two", "D3", "Care"), (2020, "D1", "One", "D1", "None")],
                                   "rec_fy int, epic_department_id string, epic_department_name string, goal_epic_department_id string, domain_goals string")
    rows = G.goal_mapping(scored, G.goals_by_arm(scored, _goals(spark), "WC")).collect()
    assert {(r.response_department_id, r.goals_department_id, r.goals_department_name, r.goal) for r in rows} == {
        ("D1", "D1", "One", Decimal("0.800")), ("D2", "All Units", "All Units", Decimal("0.700"))}


def test_flat_goals_have_three_levels(spark):
    df = spark.createDataFrame([("PD", "L1", "U1", "A"), ("PD", "L1", "U2", "A"), ("PD", "L2", "U3", None), ("PD", "L1", "U1", "A")],
                               "service_code string, service_line string, unit string, domain string")
    got = sorted((r.service_line, r.unit, r.domain, str(r.goal), r.goal_yr) for r in G.flat_goals(df, "0.750", 2018).collect())
    assert got == [("All Service Lines", "All Units", "A", "0.750", 2018), ("L1", "All Units", "A", "0.750", 2018),
                   ("L1", "U1", "A", "0.750", 2018), ("L1", "U2", "A", "0.750", 2018)]


def test_goal_maps_cascade(spark):
    goals = spark.createDataFrame([(1997, "L", "d1", "A", 0.6), (1997, "L", "All Units", "A", 0.0), (1997, "L", "All Units", "B", 0.5)],
                                  "goal_fiscal_yr int, service_line string, epic_department_id string, domain string, goal double")
    rows = spark.createDataFrame([(1997, "d1"), (1997, "d2"), (1997, None), (1998, "d1")], "rec_fy int, goal_epic_department_id string")
    doms = spark.createDataFrame([("A",), ("B",), (None,)], "domain_goals string")
    x = G.with_goal_maps(rows, goals, "L").join(doms, F.lit(True)).select("rec_fy", "goal_epic_department_id", "domain_goals", *G.mapped_goals())
    got = {(r[0], r[1], r[2]): (None if r[3] is None else float(r[3]), None if r[4] is None else float(r[4])) for r in x.collect()}
    assert got[1997, "d1", "A"] == (0.6, None) and got[1997, "d2", "A"] == (0.0, None) and got[1997, "d1", "B"] == (0.5, 0.5)
    assert got[1997, None, "B"] == (None, 0.5) and got[1997, "d1", None] == (None, None) and got[1998, "d1", "A"] == (None, None)
