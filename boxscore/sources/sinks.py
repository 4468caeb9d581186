"""Sinks (S5, S6, S7): conform to an output schema, stamp the load time and
replace a table's contents.

A table is a folder with versions and a log. A load writes its rows to a new
version and then appends one row to the log, which names the version; readers
take the version of the newest log row. Until that last small write has
committed, and if the load fails at any point before, readers go on seeing the
old contents, and the failed load can be run again. A load may read the table
that it replaces. One load of a table runs at a time.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

RESPONSE_SUMMARY_SCHEMA = T.StructType([
    T.StructField("service_line", T.StringType()),
    T.StructField("clinic", T.StringType()),
    T.StructField("epic_department_id", T.StringType()),
    T.StructField("domain", T.StringType()),
    T.StructField("question_id", T.IntegerType()),
    T.StructField("rpt_prd", T.StringType()),
    T.StructField("event_date", T.TimestampNTZType()),
    T.StructField("event_date_disch", T.TimestampNTZType()),
    T.StructField("quarter_name", T.StringType()),
    T.StructField("month_short_name", T.StringType()),
    T.StructField("load_dtm", T.TimestampNTZType()),
])

LOCATIONS_SCHEMA = T.StructType([
    T.StructField("service_line", T.StringType()),
    T.StructField("clinic", T.StringType()),
    T.StructField("epic_department_id", T.StringType()),
    T.StructField("load_dtm", T.TimestampNTZType()),
])


def with_load_time(df: DataFrame, ts: str | None = None) -> DataFrame:
    """Explicit load stamp, or the job's current timestamp."""
    return df.withColumn("load_dtm", F.lit(ts).cast("timestamp_ntz") if ts else F.current_timestamp())


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select and cast to the output schema (missing columns -> NULL)."""
    cols = set(df.columns)
    return df.select(*[(F.col(f.name) if f.name in cols else F.lit(None)).cast(f.dataType).alias(f.name)
                       for f in schema.fields])


LOG = "version string, number bigint, load_dtm timestamp_ntz"


def load_log(spark: SparkSession, path: str) -> DataFrame | None:
    """The committed loads of a table, None if there was none yet."""
    try:
        return spark.read.schema(LOG).parquet(f"{path}/log")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def newest(spark: SparkSession, path: str):
    """The log row of the contents that readers see: one row of a log of one row per load."""
    log = load_log(spark, path)
    return None if log is None else log.orderBy(F.desc("number")).first()


def load_table(df: DataFrame, path: str, schema: T.StructType | None = None, partition_by: list[str] | None = None,
               load_dtm: str | None = None) -> str:
    """Replace the table's contents with ``df``, all or nothing; returns the new version's name."""
    spark = df.sparkSession
    out = conform(df, schema) if schema is not None else df
    before = newest(spark, path)
    version = uuid.uuid4().hex
    w = out.write.mode("errorifexists")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(f"{path}/versions/{version}")
    row = spark.range(1).select(F.lit(version).alias("version"), F.lit(before["number"] + 1 if before else 0).cast("bigint").alias("number"),
                                (F.lit(load_dtm).cast("timestamp_ntz") if load_dtm else F.localtimestamp()).alias("load_dtm"))
    row.coalesce(1).write.mode("append").parquet(f"{path}/log")
    return version


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """The contents of the newest load."""
    row = newest(spark, path)
    if row is None:
        raise ValueError(f"no load of {path} has finished")
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(f"{path}/versions/{row['version']}")


def replaced_versions(spark: SparkSession, path: str) -> list[str]:
    """Folders that no new reader takes; the store's own clean-up may delete them once old readers are done."""
    log, row = load_log(spark, path), newest(spark, path)
    return [] if log is None else [f"{path}/versions/{r['version']}" for r in log.where(F.col("version") != row["version"]).collect()]


def overwrite_table(df: DataFrame, path: str, schema: T.StructType | None = None,
                    partition_by: list[str] | None = None) -> None:
    """A plain overwrite of a folder of Parquet files, which deletes before it
    writes: for scratch results. Tables with readers go through ``load_table``."""
    out = conform(df, schema) if schema is not None else df
    w = out.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def scratch_folder(spark: SparkSession) -> str:
    """A new folder below the shared folder the cluster names in
    ``spark.checkpoint.dir``; a local one only where Spark runs on one machine."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        import tempfile
        shared = tempfile.mkdtemp(prefix="boxscore-")
    return f"{shared}/tables-{uuid.uuid4().hex}"
