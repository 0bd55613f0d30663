"""Config/option builders, DDL and catalog helpers, in-memory tables."""

from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from tidewater.config import catalog_conf, kafka_sink_options, kafka_source_options, load_config, read_properties
from tidewater.session import run_dir
from tidewater.sources import bindings as B
from tidewater.sources import lake as L


def test_load_config_local():
    cfg = load_config("local", environ={})
    assert cfg["topics"]["user_activity"]["name"] == "user-activity"
    assert cfg["topics"]["sensor_data"] == {"name": "sensor-data", "partitions": 1, "replicas": 1}
    assert cfg["bootstrap.servers"] == "localhost:9092"
    assert load_config("local", environ={"BOOTSTRAP_SERVERS": "b:1"})["bootstrap.servers"] == "b:1"


def test_properties_parser(tmp_path):
    p = tmp_path / "x.properties"
    p.write_text("# c\n a = 1\nb:2\n\nc\n")
    assert read_properties(p) == {"a": "1", "b": "2", "c": ""}


def test_kafka_options_per_consumer_group():
    cfg = load_config("local", environ={})
    a = kafka_source_options(cfg, "sensor_data", "sensor-data-processor")
    b = kafka_source_options(cfg, "sensor_data", "message-counter-job", stream=False)
    assert a["subscribe"] == b["subscribe"] == "sensor-data" and a["startingOffsets"] == "earliest"
    assert "kafka.group.id" not in a and a["groupIdPrefix"] != b["groupIdPrefix"]
    assert a["kafka.security.protocol"] == "PLAINTEXT" and int(a["maxOffsetsPerTrigger"]) > 0 and "maxOffsetsPerTrigger" not in b
    assert kafka_sink_options(cfg, "user_activity")["topic"] == "user-activity"


def test_catalog_conf_reads_secrets_from_environment():
    conf = catalog_conf("lake", "http://catalog:8181", "s3://warehouse/", s3_endpoint="http://store:9000",
                        region="us-east-1", access_key_env="AK", secret_key_env="SK",
                        environ={"AK": "id", "SK": "secret"})
    assert conf["spark.sql.catalog.lake.uri"] == "http://catalog:8181"
    assert conf["spark.sql.catalog.lake.s3.path-style-access"] == "true"
    assert conf["spark.sql.catalog.lake.s3.access-key-id"] == "id"
    assert "spark.sql.catalog.lake.s3.secret-access-key" not in catalog_conf("lake", "u", "w", environ={})


def test_ddl_tables_views_and_declared_keys(spark):
    root = run_dir(spark, "ddl")
    L.create_database(spark, "tw_test", root + "/db")
    L.create_tables(spark, "tw_test", root + "/tables")
    L.create_tables(spark, "tw_test", root + "/tables")  # IF NOT EXISTS
    assert L.declared_key(spark, "tw_test.user_activity") == ("user_id", "session_id")
    assert L.declared_key(spark, "tw_test.sensor_data") == ("sensor_id",)
    from tidewater.operators.conform import conform_sensor_data
    sd = conform_sensor_data(B.sensor_data(spark, SF_SMALL), with_partition=True)
    cols = spark.table("tw_test.sensor_data").columns
    sd.select(*cols).write.insertInto("tw_test.sensor_data")
    L.create_views(spark, "tw_test")
    n = spark.table("tw_test.sensor_stats").agg(F.sum("reading_count")).first()[0]
    assert n == 1000
    assert spark.table("tw_test.sensor_data").columns[-2:] == ["event_date", "sensor_type"]


def test_memory_table(spark):
    t = L.register_memory_table(B.user_activity(spark, SF_SMALL).groupBy("event_type").count(), "tw_mem")
    assert spark.table("tw_mem").count() == 5 and t.is_cached
    L.drop_memory_table(spark, "tw_mem")
    assert not spark.catalog.tableExists("tw_mem")


def test_data_present_gate(spark):
    from tidewater.operators import views as V
    ua, sd = B.user_activity(spark, SF_SMALL), B.sensor_data(spark, SF_SMALL)
    assert V.data_present(V.table_counts(ua, sd))
    assert not V.data_present(V.table_counts(ua.limit(0), sd))


def test_use_catalog_and_database(spark):
    L.create_database(spark, "tw_use")
    L.use(spark, "spark_catalog", "tw_use")
    assert spark.catalog.currentDatabase() == "tw_use"
    L.use(spark, database="default")


def test_no_shared_folder_off_local_is_an_error():
    import pytest
    from tidewater import session

    class Context:
        master = "spark://h:7077"
        _jsc = type("J", (), {"sc": lambda self: type("S", (), {"getCheckpointDir": lambda self: type("O", (), {"isDefined": lambda self: False})()})()})()

        def getConf(self):
            return {}

    with pytest.raises(RuntimeError):
        session.shared_root(type("Session", (), {"sparkContext": Context()})())
