"""Lake tables: DDL, partitioned warehouse writes, pruned range reads, as-of
reads, schema-evolving reads, in-memory tables.

Parquet tables have no hidden ``day(event_time)`` transform, so the day is a
materialised ``event_date`` partition column and :func:`read_range` adds the
matching ``event_date`` bounds to every time-range read; Catalyst then prunes
directories (``PartitionFilters``) and pushes the exact bounds to the files
(``PushedFilters``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidewater.functions.timefn import event_date, event_hour, hour_sql

USER_ACTIVITY_DDL = """
CREATE TABLE IF NOT EXISTS {db}.user_activity (
  user_id STRING, event_type STRING, event_time TIMESTAMP_NTZ, session_id STRING,
  ip_address STRING, user_agent STRING, page_url STRING, total_amount DOUBLE, event_date DATE
) USING parquet PARTITIONED BY (event_date) {location}
"""

SENSOR_DATA_DDL = """
CREATE TABLE IF NOT EXISTS {db}.sensor_data (
  sensor_id STRING, event_time TIMESTAMP_NTZ, latitude DOUBLE, longitude DOUBLE,
  facility STRING, sensor_value DOUBLE, event_date DATE, sensor_type STRING
) USING parquet PARTITIONED BY (event_date, sensor_type) {location}
"""

HOURLY_VIEW_DDL = """
CREATE OR REPLACE {temp} VIEW {name} AS
SELECT {hour} AS hour, event_type, COUNT(*) AS event_count
FROM {source} GROUP BY 1, 2
"""

SENSOR_STATS_VIEW_DDL = """
CREATE OR REPLACE {temp} VIEW {name} AS
SELECT {hour} AS hour, sensor_type, facility,
       COUNT(*) AS reading_count, AVG(sensor_value) AS avg_value,
       MIN(sensor_value) AS min_value, MAX(sensor_value) AS max_value
FROM {source} GROUP BY 1, 2, 3
"""

# Declared keys are table metadata only (Parquet tables reject PRIMARY KEY).
KEY_PROPERTY = "tidewater.primary_key"


def use(spark: SparkSession, catalog: str | None = None, database: str | None = None) -> None:
    """USE CATALOG / USE database."""
    if catalog:
        spark.catalog.setCurrentCatalog(catalog)
    if database:
        spark.catalog.setCurrentDatabase(database)


def create_database(spark: SparkSession, db: str, location: str | None = None) -> None:
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db}{loc}")


def create_tables(spark: SparkSession, db: str, root: str | None = None) -> None:
    """The two warehouse tables (partitioned Parquet) and their declared keys."""
    for name, ddl, key in (("user_activity", USER_ACTIVITY_DDL, "user_id,session_id"),
                           ("sensor_data", SENSOR_DATA_DDL, "sensor_id")):
        loc = f"LOCATION '{root.rstrip('/')}/{name}'" if root else ""
        spark.sql(ddl.format(db=db, location=loc))
        spark.sql(f"ALTER TABLE {db}.{name} SET TBLPROPERTIES ('{KEY_PROPERTY}' = '{key}')")


def create_views(spark: SparkSession, db: str | None = None, temp: bool = False,
                 user_source: str | None = None, sensor_source: str | None = None) -> None:
    pre, hour = f"{db}." if db else "", hour_sql("event_time")
    t = "TEMP" if temp else ""
    spark.sql(HOURLY_VIEW_DDL.format(temp=t, hour=hour, name=f"{'' if temp else pre}hourly_user_activity",
                                     source=user_source or f"{pre}user_activity"))
    spark.sql(SENSOR_STATS_VIEW_DDL.format(temp=t, hour=hour, name=f"{'' if temp else pre}sensor_stats",
                                           source=sensor_source or f"{pre}sensor_data"))


def declared_key(spark: SparkSession, table: str) -> tuple[str, ...]:
    rows = spark.sql(f"SHOW TBLPROPERTIES {table} ('{KEY_PROPERTY}')").collect()
    return tuple(rows[0]["value"].split(",")) if rows else ()


def write_partitioned(df: DataFrame, path: str, partitions: tuple[str, ...] = ("event_date",),
                      mode: str = "append") -> None:
    """Batch write of warehouse rows, adding event_date when absent."""
    if "event_date" in partitions and "event_date" not in df.columns:
        df = df.withColumn("event_date", event_date("event_time"))
    df.write.mode(mode).partitionBy(*partitions).parquet(path)


def read_range(df: DataFrame, lo: str, hi: str, time_col: str = "event_time",
               date_col: str = "event_date", hour_col: str = "event_hour") -> DataFrame:
    """Rows with lo <= time < hi, with the derived partition bounds added so the
    scan reads only the days in range, and inside them, where the table has an hour
    column (folded tables do), only files and row groups that hold hours in range."""
    lo_c, hi_c = F.lit(lo).cast("timestamp_ntz"), F.lit(hi).cast("timestamp_ntz")
    cond = (F.col(time_col) >= lo_c) & (F.col(time_col) < hi_c)
    if date_col in df.columns:
        cond &= (F.col(date_col) >= F.to_date(lo_c)) & (F.col(date_col) <= F.to_date(hi_c))
    if hour_col in df.columns:
        cond &= (F.col(hour_col) >= event_hour(lo_c)) & (F.col(hour_col) <= event_hour(hi_c))
    return df.where(cond)


def as_of(df: DataFrame, t: str, stamp_col: str = "processing_time", date_col: str = "ingest_date") -> DataFrame:
    """Rows stamped by ``t``.  A stamp is taken when a batch begins, so rows of a batch that
    runs at ``t`` come in later; for a read that is the same whenever it is asked, of a
    processor's table, see ``streaming/batches.read_as_of``.  On a table partitioned by the
    day of landing, later days are not read."""
    at = F.lit(t).cast("timestamp_ntz")
    cond = F.col(stamp_col) <= at
    if date_col in df.columns:
        cond &= F.col(date_col) <= F.to_date(at)
    return df.where(cond)


def read_evolving(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Read files written under successive schema versions by the declared current schema:
    columns that a file lacks are NULL.  No file's footer is opened to find the schema."""
    return spark.read.schema(schema).parquet(path)


def register_memory_table(df: DataFrame, name: str) -> DataFrame:
    """Small, hot table kept in executor memory and queryable by name."""
    cached = df.persist()
    cached.createOrReplaceTempView(name)
    return cached


def drop_memory_table(spark: SparkSession, name: str) -> None:
    if spark.catalog.tableExists(name):
        spark.table(name).unpersist()
        spark.catalog.dropTempView(name)
