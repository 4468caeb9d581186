"""Sources: the survey data model, read from the given parquet tables.

``Inputs`` maps the driver's TPC-H-like tables onto the survey tables the
operators consume (recipes in FIXTURES.md). Every source is a lazy
DataFrame; scans select only the columns they need so parquet column
pruning and filter pushdown reach the files.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from boxscore.functions.calendar import fiscal_year, with_calendar_attributes
from boxscore.session import bound_tasks
from boxscore.sources import lookups as L

# Days the calendar dimension has at least; dates of the fact widen it.
CALENDAR_START = "1990-01-01"
CALENDAR_END = "2030-12-31"

# Goal-file domain vocabulary used by the goal-settings fixture, in order.
SETTINGS_DOMAINS = ["Nurse Comm Child", "Overall Rating", "Environment",
                    "Prepare Child Leave Hospital", "Recommend"]
GOAL_YEARS = (1996, 2002)
FIXED_LOAD_DTM = "2020-01-01 00:00:00"


def read_table(spark: SparkSession, sf_dir: str, name: str, cols: list[str] | None = None) -> DataFrame:
    """Scan one table with an explicit column list (pruned at the scan)."""
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df.select(*cols) if cols else df


def _goal(expr: Column) -> Column:
    return (expr.cast("double") / 100).cast("decimal(4,3)")


class Inputs:
    """Lazily built survey tables for one data directory."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    @classmethod
    def for_dir(cls, spark: SparkSession, sf_dir: str) -> "Inputs":
        """The table definitions of a data directory, shared within one query."""
        bound_tasks(spark)
        return cls(spark, sf_dir)

    def table(self, name: str, cols: list[str] | None = None) -> DataFrame:
        return read_table(self.spark, self.sf_dir, name, cols)

    # -- fact -----------------------------------------------------------------
    @cached_property
    def responses(self) -> DataFrame:
        """Answer fact, one row per survey x question (EAV)."""
        li = self.table("lineitem", ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
                                     "l_quantity", "l_returnflag"])
        od = self.table("orders", ["o_orderkey", "o_custkey", "o_orderdate"])
        q = F.col("l_quantity").cast("int")
        ln = F.col("l_linenumber")
        service = F.when(F.col("l_partkey") % 5 == 0, "IN").when(F.col("l_partkey") % 5 == 4, "MD").otherwise("PD")
        value = (
            F.when((F.col("l_returnflag") == "R") & (q % 4 == 0), F.lit(None).cast("string"))
            .when(ln == 1, (q % 5 + 1).cast("string"))
            .when((ln == 2) & (service == "MD") & (q % 11).isin(0, 10), F.when(q % 11 == 10, F.lit("10-Best provider")).otherwise(F.lit("0-Worst provider")))
            .when((ln == 4) & (service != "PD"), F.when(q % 3 == 0, F.lit("Yes")).otherwise(F.lit("No")))
            .when((ln == 5) & (service == "IN"), F.when(q % 2 == 0, F.lit("Strongly Agree")).otherwise(F.lit("Disagree")))
            .when(ln == 2, F.when(q % 11 == 10, F.lit("10-Best possible"))
                  .when(q % 11 == 0, F.lit("0-Worst possible"))
                  .otherwise((q % 11).cast("string")))
            .when(ln == 3, F.when(q % 4 == 0, "Always").when(q % 4 == 1, "Usually")
                  .when(q % 4 == 2, "Sometimes").otherwise("Never"))
            .when(ln == 4, F.when(q % 3 == 0, "Yes, definitely").when(q % 3 == 1, "Yes, somewhat")
                  .otherwise("No"))
            .when(ln == 5, F.when(q % 2 == 0, "Definitely Yes").otherwise("Probably No"))
            .when(ln == 6, q.cast("string"))
            .when(ln == 7, F.concat(F.lit("U"), (F.col("l_suppkey") % 8).cast("string")))
        )
        discharge = F.col("o_orderdate").cast("date")
        # The answer fact is a lineitem x orders join here (test-data adapter;
        # on a cluster the fact is a stored table). Spark picks the join
        # strategy from the orders side's size.
        return li.join(od, li.l_orderkey == od.o_orderkey).select(
            F.col("l_orderkey").alias("survey_id"),
            ln.cast("int").alias("question_id"),
            F.col("l_orderkey").alias("account_key"),
            F.col("o_custkey").alias("patient_key"),
            service.alias("service_code"),
            F.date_add(discharge, (F.col("o_orderkey") % 45).cast("int")).alias("received_date"),
            discharge.alias("discharge_date"),
            fiscal_year(discharge).alias("fy"),
            value.alias("value"),
            F.when(F.col("o_custkey") % 13 == 0, F.lit(-1).cast("bigint"))
            .otherwise(F.col("o_custkey") % 100).alias("department_key"),
            (F.col("l_suppkey") % 7).alias("physician_key"),
            F.when(F.col("l_partkey") % 3 == 1, "PC01").when(F.col("l_partkey") % 3 == 2, "MD01")
            .alias("survey_designator"),
        )

    # -- dimensions -------------------------------------------------------------
    @cached_property
    def departments(self) -> DataFrame:
        s = self.table("supplier", ["s_suppkey", "s_name"])
        return s.select(
            F.col("s_suppkey").alias("department_key"),
            (F.col("s_suppkey") + 10000000).cast("string").alias("department_id"),
            F.when(F.col("s_suppkey") % 11 == 0, F.lit(None)).otherwise(F.col("s_name")).alias("department_name"),
            F.when(F.col("s_suppkey") % 5 == 0, F.lit(None))
            .otherwise(F.concat(F.lit("EXT "), F.col("s_name"))).alias("external_name"),
        )

    @cached_property
    def location_master(self) -> DataFrame:
        s = self.table("supplier", ["s_suppkey", "s_name", "s_nationkey"])
        n = self.table("nation", ["n_nationkey", "n_name", "n_regionkey"])
        r = self.table("region", ["r_regionkey", "r_name"])
        k = F.col("s_suppkey")
        return (s.join(n, s.s_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey)
                .select(
                    (k + 10000000).cast("string").alias("department_id"),
                    F.when(k % 11 == 0, F.lit(None)).otherwise(F.col("s_name")).alias("department_name"),
                    F.when(k % 7 == 0, F.lit(None)).otherwise(F.concat(F.lit("MASTER "), F.col("s_name"))).alias("external_name"),
                    F.col("r_regionkey").alias("service_line_id"),
                    F.when(k % 9 == 0, F.lit(None)).when(k % 9 == 1, F.lit("Unknown"))
                    .when(k % 9 == 2, F.lit("Therapies")).otherwise(F.col("r_name")).alias("service_line"),
                    F.when(k % 5 == 0, F.lit("Therapies")).otherwise(F.concat(F.col("n_name"), F.lit(" OPS"))).alias("operational_service"),
                    F.when(k % 6 == 0, F.lit("Unknown")).otherwise(F.col("n_name")).alias("sub_service_line"),
                ))

    @cached_property
    def patients(self) -> DataFrame:
        c = self.table("customer", ["c_custkey", "c_name", "c_mktsegment"])
        k = F.col("c_custkey")
        return c.select(
            k.alias("patient_key"),
            F.col("c_mktsegment").alias("last_name"),
            F.when(k % 17 == 0, F.lit(None)).otherwise(F.col("c_name")).alias("first_name"),
            F.date_add(F.lit("1940-01-01").cast("date"), ((k * 37) % 25000).cast("int")).alias("birth_date"),
            F.when(k % 3 == 0, "M").when(k % 3 == 1, "F").alias("sex"),
        )

    @cached_property
    def accounts(self) -> DataFrame:
        o = self.table("orders", ["o_orderkey", "o_custkey"])
        return o.select(F.col("o_orderkey").alias("account_key"),
                        (F.col("o_custkey") + 1000000).alias("mrn"))

    @cached_property
    def physicians(self) -> DataFrame:
        n = self.table("nation", ["n_nationkey", "n_name", "n_regionkey"])
        return n.select(
            F.col("n_nationkey").cast("bigint").alias("physician_key"),
            F.concat(F.lit("Dr "), F.col("n_name")).alias("display_name"),
            F.concat(F.col("n_name"), F.lit(" Dept")).alias("dept"),
            F.concat(F.lit("Div "), F.col("n_regionkey").cast("string")).alias("division"),
            F.concat(F.lit("Line "), F.col("n_regionkey").cast("string")).alias("physician_line"),
            (F.col("n_nationkey") + 1000000000).cast("bigint").alias("npi"),
        )

    @cached_property
    def encounters(self) -> DataFrame:
        e = self.table("events", ["event_id", "ts", "user_id"])
        return e.select(F.col("user_id").alias("account_key"),
                        (F.col("event_id") % 100).alias("department_key"),
                        F.col("ts").alias("appt_dtm"),
                        F.col("event_id").alias("encounter_id"))

    @cached_property
    def designator_log(self) -> DataFrame:
        e = self.table("events", ["event_id", "ts", "user_id", "event_type"])
        return e.select(
            F.col("user_id").alias("survey_id"),
            F.when(F.col("event_type").isin("click", "view", "purchase"),
                   F.concat(F.lit("PC0"), (F.col("event_id") % 3).cast("string")))
            .otherwise(F.concat(F.lit("MD0"), (F.col("event_id") % 3).cast("string"))).alias("value"),
            F.col("ts").alias("load_dtm"),
            F.col("event_id").alias("log_id"),
        )

    @cached_property
    def rules(self) -> DataFrame:
        return L.rules(self.spark)

    @cached_property
    def questions(self) -> DataFrame:
        """Question dimension (varname, text), a bounded inline table."""
        return self.rules.select("question_id", "varname", "question_text")

    @cached_property
    def calendar(self) -> DataFrame:
        """The calendar dimension: its usual days, widened to every date of the
        fact, so that no answer falls outside. One row per day."""
        o = self.table("orders", ["o_orderkey", "o_orderdate"])
        discharge = F.col("o_orderdate").cast("date")
        dates = o.select(discharge.alias("lo"), F.date_add(discharge, (F.col("o_orderkey") % 45).cast("int")).alias("hi"))
        bounds = dates.agg(F.least(F.min("lo"), F.lit(CALENDAR_START).cast("date")).alias("lo"),
                           F.greatest(F.max("hi"), F.lit(CALENDAR_END).cast("date")).alias("hi"))
        days = bounds.select(F.explode(F.sequence("lo", "hi", F.expr("interval 1 day"))).alias("day_date"))
        return with_calendar_attributes(days)

    def days(self, start: str | None, end: str | None) -> DataFrame:
        """The calendar's rows of a window. The usual days need no look at the fact."""
        if start is None or end is None or start < CALENDAR_START or end > CALENDAR_END:
            return self.calendar
        one = self.spark.range(1).select(F.explode(F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"), F.expr("interval 1 day"))).alias("day_date"))
        return with_calendar_attributes(one)

    # -- goals -----------------------------------------------------------------
    def _goal_departments(self, every: int) -> DataFrame:
        """The departments that set goals, with their region. Each becomes a row per year
        and domain, so they are dealt out first: their file may be a single task."""
        s = self.table("supplier", ["s_suppkey", "s_name", "s_nationkey"]).where(F.col("s_suppkey") % every == 0)
        s = s.repartition(int(self.spark.conf.get("spark.sql.shuffle.partitions")), "s_suppkey")
        n = self.table("nation", ["n_nationkey", "n_regionkey"])
        r = self.table("region", ["r_regionkey", "r_name"])
        return s.join(n, s.s_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey)

    @cached_property
    def goal_settings(self) -> DataFrame:
        """Raw goal-setting rows (goal file), one per service/department/year/domain."""
        r = self.table("region", ["r_regionkey", "r_name"])
        years = F.explode(F.sequence(F.lit(GOAL_YEARS[0]), F.lit(GOAL_YEARS[1]))).alias("goal_yr")
        doms = F.posexplode(F.array(*[F.lit(d) for d in SETTINGS_DOMAINS])).alias("di", "domain")
        cols = ["service", "department_id", "department_name", "goal_yr", "service_line", "unit",
                "domain", "goal"]
        k = F.col("s_suppkey")
        dept = (self._goal_departments(4).select("*", years).select("*", doms)
                .select(F.lit("CHILD_IP").alias("service"),
                        (k + 10000000).cast("string").alias("department_id"),
                        F.col("s_name").alias("department_name"), "goal_yr",
                        F.col("r_name").alias("service_line"), F.lit(None).cast("string").alias("unit"),
                        "domain", _goal(50 + (k * 7 + F.col("goal_yr") + F.col("di") * 3) % 45).alias("goal")))
        yr, di, rk = F.col("goal_yr"), F.col("di"), F.col("r_regionkey")
        regions = r.select("*", years).select("*", doms)
        all_units = (regions.where(rk == 0)
                     .select(F.lit("CHILD_IP").alias("service"), F.lit(None).cast("string").alias("department_id"),
                             F.lit(None).cast("string").alias("department_name"), "goal_yr",
                             F.lit(None).cast("string").alias("service_line"),
                             F.lit("All PEDS Units").alias("unit"), "domain",
                             F.when((yr == 1997) & (di == 0), F.lit(0).cast("decimal(4,3)"))
                             .otherwise(_goal(55 + (yr + di * 7) % 40)).alias("goal")))
        retired = (regions.where(rk % 2 == 1)
                   .select(F.lit("CHILD_IP").alias("service"), F.lit(None).cast("string").alias("department_id"),
                           F.lit(None).cast("string").alias("department_name"), "goal_yr",
                           F.col("r_name").alias("service_line"), F.lit("Retired unit").alias("unit"),
                           "domain", _goal(F.lit(90)).alias("goal")))
        adult_lines = (regions
                       .select(F.lit("ADULT_IP").alias("service"), F.lit(None).cast("string").alias("department_id"),
                               F.lit(None).cast("string").alias("department_name"), "goal_yr",
                               F.col("r_name").alias("service_line"), F.lit("All Units").alias("unit"),
                               "domain", _goal(50 + (rk * 7 + yr + di) % 45).alias("goal")))
        adult_all = (regions.where(rk == 0)
                     .select(F.lit("ADULT_IP").alias("service"), F.lit(None).cast("string").alias("department_id"),
                             F.lit(None).cast("string").alias("department_name"), "goal_yr",
                             F.lit(L.ALL_SERVICE_LINES).alias("service_line"), F.lit("All Units").alias("unit"),
                             "domain", _goal(60 + (yr + di) % 30).alias("goal")))
        return (dept.select(cols).unionByName(all_units.select(cols)).unionByName(retired.select(cols))
                .unionByName(adult_lines.select(cols)).unionByName(adult_all.select(cols)))

    def load_child_goals(self) -> DataFrame:
        """The child goals ETL (G4) over the goal settings, as a lazy plan."""
        from boxscore.operators.goals import load_goals
        return load_goals(self.goal_settings, L.domain_translation(self.spark), service="CHILD_IP", svc_cde="PD",
                          all_units_label="All PEDS Units", service_line=L.CHILD_SERVICE_LINE,
                          load_dtm=FIXED_LOAD_DTM)

    def load_adult_goals(self) -> DataFrame:
        """The adult goals ETL (G4): line goals keep the file's service line."""
        from boxscore.operators.goals import load_goals
        return load_goals(self.goal_settings, L.domain_translation(self.spark), service="ADULT_IP", svc_cde="IN",
                          all_units_label="All Units", service_line=None, all_lines_arm=False,
                          load_dtm=FIXED_LOAD_DTM)

    @cached_property
    def child_goals(self) -> DataFrame:
        """The child goal table (a dimension; ETL output as a lazy plan)."""
        return self.load_child_goals()

    @cached_property
    def adult_goals(self) -> DataFrame:
        """The adult goal table (a dimension; ETL output as a lazy plan)."""
        return self.load_adult_goals()

    def _goal_rows(self, line: Column, unit: Column, first: int, step: int) -> DataFrame:
        """(service_line, unit, domain, goal) per region and goal domain, without a year."""
        domains = F.posexplode(F.array(*[F.lit(d) for d in SETTINGS_DOMAINS])).alias("di", "raw")
        t = L.domain_translation(self.spark)
        rows = self.table("region", ["r_regionkey", "r_name"]).select("*", domains).join(t, F.col("raw") == F.col("goals_domain"), "left")
        return rows.select(line.alias("service_line"), unit.alias("unit"), F.coalesce("domain", "raw").alias("domain"),
                           _goal(first + (F.col("r_regionkey") * step + F.col("di") * 3) % 40).alias("goal"))

    @cached_property
    def adult_unit_goals(self) -> DataFrame:
        """Adult goals by unit without a year, and the 'All Units' goals of 'All Service Lines'."""
        units = self._goal_rows(F.col("r_name"), F.concat(F.lit("U"), F.col("r_regionkey").cast("string")), 50, 11)
        every = self._goal_rows(F.lit(L.ALL_SERVICE_LINES), F.lit(L.ALL_UNITS), 55, 0)
        return units.unionByName(every.distinct())

    @cached_property
    def clinic_goals(self) -> DataFrame:
        """Outpatient goals without a year: 'All Clinics' of each line and of 'All Service Lines'."""
        lines = self._goal_rows(F.col("r_name"), F.lit(L.ALL_CLINICS), 45, 7)
        every = self._goal_rows(F.lit(L.ALL_SERVICE_LINES), F.lit(L.ALL_CLINICS), 60, 0)
        return lines.unionByName(every.distinct())

    @cached_property
    def percentile_ranks(self) -> DataFrame:
        """Benchmark bands per scored question and fiscal-year period found in
        the fact: six bands (0, four inner edges that move with the year, 100)."""
        periods = (self.responses.select("question_id", "fy").distinct()
                   .join(F.broadcast(self.rules.where(F.col("scale").isNotNull())
                                     .select("question_id", "domain", "question_text_alias")), "question_id"))
        b = periods.select("*", F.explode(F.sequence(F.lit(0), F.lit(5))).alias("band"))
        band, fy = F.col("band"), F.col("fy")
        value = (F.when(band == 0, F.lit(0)).when(band == 5, F.lit(100))
                 .otherwise(band * 20 + (fy % 3) * 5 - 5))
        rows = b.select(
            value.cast("decimal(4,1)").alias("value"), "domain",
            F.col("question_id").cast("string").alias("question_id"),
            (band * 20).cast("int").alias("percentile_rank"),
            F.make_date(fy - 1, F.lit(7), F.lit(1)).alias("period_begin"),
            F.make_date(fy, F.lit(6), F.lit(30)).alias("period_end"),
            "question_text_alias")
        # the benchmark file also ranks whole domains; their id is a word
        whole = rows.select("value", "domain", F.lit("Domain").alias("question_id"), "percentile_rank",
                            "period_begin", "period_end", F.lit(None).cast("string").alias("question_text_alias")).distinct()
        return rows.unionByName(whole)

    @cached_property
    def goals_old(self) -> DataFrame:
        """Old-shape goal rows: unit label 'Name [id]' or 'All Units'."""
        r = self.table("region", ["r_regionkey", "r_name"])
        years = F.explode(F.sequence(F.lit(GOAL_YEARS[0]), F.lit(GOAL_YEARS[1]))).alias("goal_yr")
        doms = F.posexplode(F.array(*[F.lit(d) for d in SETTINGS_DOMAINS])).alias("di", "domain")
        k = F.col("s_suppkey")
        cols = ["svc_cde", "goal_yr", "service_line", "unit", "domain", "goal"]
        units = (self._goal_departments(3).select("*", years).select("*", doms)
                 .select(F.lit("PD").alias("svc_cde"), "goal_yr", F.col("r_name").alias("service_line"),
                         F.concat(F.col("s_name"), F.lit(" ["), (k + 10000000).cast("string"), F.lit("]")).alias("unit"),
                         "domain", _goal(45 + (k + F.col("goal_yr") * 3 + F.col("di")) % 50).alias("goal")))
        lines = (r.select("*", years).select("*", doms)
                 .select(F.lit("PD").alias("svc_cde"), "goal_yr", F.col("r_name").alias("service_line"),
                         F.lit(L.ALL_UNITS).alias("unit"), "domain",
                         _goal(50 + (F.col("r_regionkey") * 5 + F.col("goal_yr") + F.col("di")) % 45).alias("goal")))
        all_lines = (r.where(F.col("r_regionkey") == 0).select("*", years).select("*", doms)
                     .select(F.lit("PD").alias("svc_cde"), "goal_yr", F.lit(L.ALL_SERVICE_LINES).alias("service_line"),
                             F.lit(L.ALL_UNITS).alias("unit"), "domain",
                             _goal(60 + (F.col("goal_yr") + F.col("di")) % 30).alias("goal")))
        return units.select(cols).unionByName(lines.select(cols)).unionByName(all_lines.select(cols))
