"""Physical-plan checks: pruning, pushdown, broadcast decisions, no Python UDFs."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

import __spark_entry__ as E
from tests.conftest import SF_SMALL
from tidewater.operators import enrich as EN
from tidewater.operators import views as V
from tidewater.operators.conform import conform_sensor_data, conform_user_activity
from tidewater.session import run_dir
from tidewater.sources import bindings as B
from tidewater.sources import lake as L


def plan(df):
    """Formatted physical plan (the same text as ``df.explain("formatted")``)."""
    mode = df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    return df._jdf.queryExecution().explainString(mode)


def test_read_range_prunes_partitions(spark):
    path = run_dir(spark, "prune") + "/ua"
    L.write_partitioned(conform_user_activity(B.user_activity(spark, SF_SMALL)), path)
    df = L.read_range(spark.read.parquet(path), "2024-01-05 00:00:00", "2024-01-07 00:00:00")
    p = plan(df)
    assert "PartitionFilters: [isnotnull(event_date" in p
    assert "PushedFilters: [IsNotNull(event_time), GreaterThanOrEqual(event_time" in p
    assert df.count() == spark.read.parquet(path).where(
        "event_time >= '2024-01-05' AND event_time < '2024-01-07'").count()


def test_drilldown_pushes_time_and_type_to_scan(spark):
    df = V.filter_drilldown(conform_sensor_data(B.sensor_data(spark, SF_SMALL)),
                            "2024-01-03 00:00:00", "2024-01-10 00:00:00", "click", "facility-3")
    p = plan(df)
    assert "GreaterThanOrEqual(ts" in p and "EqualTo(event_type,click)" in p


def test_drilldown_prunes_days_and_types(spark):
    path = run_dir(spark, "prune") + "/sd"
    L.write_partitioned(conform_sensor_data(B.sensor_data(spark, SF_SMALL)), path, ("event_date", "sensor_type"))
    df = V.filter_drilldown(spark.read.parquet(path), "2024-01-03 00:00:00", "2024-01-10 00:00:00", "click")
    filters = plan(df).split("PartitionFilters: [")[1].split("]\n")[0]
    assert "event_date" in filters and "sensor_type" in filters and df.count() > 0


def test_as_of_prunes_landing_days_and_evolving_read_declares_its_schema(spark):
    path = run_dir(spark, "as_of") + "/ua"
    rows = B.user_activity(spark, SF_SMALL).withColumn("ingest_date", F.to_date("processing_time"))
    rows.write.partitionBy("ingest_date").parquet(path)
    df = L.as_of(spark.read.parquet(path), "2024-01-12 12:00:00")
    assert "ingest_date" in plan(df).split("PartitionFilters: [")[1].split("]\n")[0]
    assert df.count() == rows.where("processing_time <= '2024-01-12 12:00:00'").count()
    wide = L.read_evolving(spark, path, StructType([*rows.schema.fields, StructField("later", LongType())]))
    assert wide.where("later IS NULL").count() == 1000


def test_view_reads_only_needed_columns(spark):
    df = V.hourly_user_activity(conform_user_activity(B.user_activity(spark, SF_SMALL)))
    p = plan(df)
    assert "ReadSchema: struct<ts:timestamp_ntz,event_type:string>\n" in p
    assert "HashAggregate" in p and "partial_count" in p


def test_small_dimension_is_broadcast_and_large_is_not(spark):
    ua = B.user_activity(spark, SF_SMALL)
    dims = [B.read_table(spark, SF_SMALL, t) for t in ("customer", "nation", "region")]
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        small = plan(EN.enrich_user_activity(ua, *dims))
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        big = plan(EN.enrich_user_activity(ua, *dims))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert small.count("BroadcastHashJoin") >= 3 and "SortMergeJoin" not in small
    assert "SortMergeJoin" in big and "BroadcastHashJoin" not in big


BATCH = ["hourly_user_activity", "sensor_stats", "activity_rollup", "enrich_user_activity", "sensor_zscores",
         "view_then_purchase", "latest_by_key", "quality_report", "src_user_activity", "decode_lenient",
         "out_of_range", "hourly_cross_source"]


@pytest.mark.parametrize("name", BATCH)
def test_no_python_in_plans(spark, name):
    p = plan(E.queries()[name](spark, SF_SMALL))
    for node in ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas", "PythonUDF"):
        assert node not in p, f"{name} runs Python: {node}"
