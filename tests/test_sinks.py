import tempfile

import pytest
from pyspark.sql import functions as F

from boxscore.sources import sinks


def test_overwrite_conform_and_load_time(spark):
    df = spark.createDataFrame([("L", "C [1]", "1", "extra")], "service_line string, clinic string, "
                                                                 "epic_department_id string, x string")
    df = sinks.with_load_time(df, "2020-01-01 00:00:00")
    path = tempfile.mkdtemp(prefix="boxscore-sink-") + "/locations"
    sinks.overwrite_table(df, path, sinks.LOCATIONS_SCHEMA)
    sinks.overwrite_table(df, path, sinks.LOCATIONS_SCHEMA)       # truncate-and-insert: still one row
    back = spark.read.parquet(path)
    assert back.columns == [f.name for f in sinks.LOCATIONS_SCHEMA.fields]
    assert back.count() == 1


def rows(spark, path):
    return sorted(r["clinic"] for r in sinks.read_table(spark, path, sinks.LOCATIONS_SCHEMA).collect())


def located(spark, *clinics):
    return spark.createDataFrame([("L", c, "1", "x") for c in clinics], "service_line string, clinic string, epic_department_id string, x string")


def test_a_failed_load_leaves_the_old_rows(spark):
    path = tempfile.mkdtemp(prefix="boxscore-sink-") + "/locations"
    with pytest.raises(ValueError):
        sinks.read_table(spark, path)
    sinks.load_table(located(spark, "a", "b"), path, sinks.LOCATIONS_SCHEMA)

    halfway = located(spark, *map(str, range(1000))).repartition(4).withColumn(
        "clinic", F.when(F.spark_partition_id() == 3, F.raise_error(F.lit("killed")).cast("string")).otherwise(F.col("clinic")))
    with pytest.raises(Exception, match="killed"):
        sinks.load_table(halfway, path, sinks.LOCATIONS_SCHEMA)
    assert rows(spark, path) == ["a", "b"]
    sinks.load_table(located(spark, "c"), path, sinks.LOCATIONS_SCHEMA)  # the failed load can be run again
    assert rows(spark, path) == ["c"]


def test_a_load_may_read_its_own_table(spark):
    path = tempfile.mkdtemp(prefix="boxscore-sink-") + "/locations"
    first = sinks.load_table(located(spark, "a", "b"), path, sinks.LOCATIONS_SCHEMA)
    old = sinks.read_table(spark, path)
    sinks.load_table(old.where("clinic = 'a'").unionByName(located(spark, "z").drop("x"), allowMissingColumns=True), path, sinks.LOCATIONS_SCHEMA)
    assert rows(spark, path) == ["a", "z"]
    assert old.count() == 2 and sinks.replaced_versions(spark, path) == [f"{path}/versions/{first}"]


def test_loads_keep_the_schema_of_an_empty_result(spark):
    path = tempfile.mkdtemp(prefix="boxscore-sink-") + "/locations"
    sinks.load_table(located(spark, "a").where("false"), path, sinks.LOCATIONS_SCHEMA, load_dtm="2020-01-01 00:00:00")
    back = sinks.read_table(spark, path, sinks.LOCATIONS_SCHEMA)
    assert back.count() == 0 and back.columns == [f.name for f in sinks.LOCATIONS_SCHEMA.fields]
