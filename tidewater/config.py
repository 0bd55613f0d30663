"""Environment configuration: property files -> source/sink/catalog options.

All driver-side and tiny.  Secrets are never stored in files: catalog
credentials are read from environment variables whose names the caller passes.
"""

from __future__ import annotations

import os
from pathlib import Path

# The property files' topic keys; each also has .partitions and .replicas.
TOPIC_KEYS = {"user_activity": "topic.user-activity", "sensor_data": "topic.sensor-data"}

# A first start at the earliest offset takes the backlog in batches of this size.
MAX_OFFSETS_PER_TRIGGER = 5_000_000

CONF_ROOT = Path(__file__).resolve().parent.parent / "conf"


def read_properties(path: str | os.PathLike) -> dict[str, str]:
    out: dict[str, str] = {}
    for raw in Path(path).read_text().splitlines():
        line = raw.strip()
        if not line or line.startswith(("#", "!")):
            continue
        sep = min((i for i in (line.find("="), line.find(":")) if i >= 0), default=-1)
        if sep < 0:
            out[line] = ""
        else:
            out[line[:sep].strip()] = line[sep + 1:].strip()
    return out


def load_config(env: str = "local", conf_root: str | os.PathLike | None = None,
                environ: dict | None = None) -> dict:
    """Merge ``<conf_root>/<env>/{kafka,topics}.properties``; the bootstrap servers
    may be overridden by ``BOOTSTRAP_SERVERS`` in the environment."""
    environ = os.environ if environ is None else environ
    root = Path(conf_root) if conf_root else CONF_ROOT
    d = root / env
    kafka = read_properties(d / "kafka.properties") if (d / "kafka.properties").exists() else {}
    topics = read_properties(d / "topics.properties") if (d / "topics.properties").exists() else {}
    cfg = {"env": env, "bootstrap.servers": environ.get("BOOTSTRAP_SERVERS",
                                                        kafka.get("bootstrap.servers", "")),
           "security.protocol": kafka.get("security.protocol", "PLAINTEXT"),
           "maxOffsetsPerTrigger": MAX_OFFSETS_PER_TRIGGER, "topics": {}}
    for fam, key in TOPIC_KEYS.items():
        if key in topics:
            cfg["topics"][fam] = {
                "name": topics[key],
                "partitions": int(topics.get(f"{key}.partitions", "1")),
                "replicas": int(topics.get(f"{key}.replicas", "1")),
            }
    return cfg


def _kafka_connection(cfg: dict) -> dict[str, str]:
    return {"kafka.bootstrap.servers": cfg["bootstrap.servers"],
            "kafka.security.protocol": cfg.get("security.protocol", "PLAINTEXT")}


def kafka_source_options(cfg: dict, family: str, group_prefix: str,
                         starting: str = "earliest", stream: bool = True) -> dict[str, str]:
    """Options of a Kafka source: one topic, earliest offsets.  Progress is the query's
    checkpoint.  No group id is set: each query makes its own, unique one, as two queries
    sharing a group would each read only part of the topic; the prefix names the job."""
    bound = {"maxOffsetsPerTrigger": str(cfg.get("maxOffsetsPerTrigger", MAX_OFFSETS_PER_TRIGGER))} if stream else {}
    return {
        **_kafka_connection(cfg),
        "subscribe": cfg["topics"][family]["name"],
        "startingOffsets": starting,
        "groupIdPrefix": group_prefix,
        "failOnDataLoss": "true",
        **bound,
    }


def kafka_sink_options(cfg: dict, family: str) -> dict[str, str]:
    return {**_kafka_connection(cfg), "topic": cfg["topics"][family]["name"]}


def catalog_conf(name: str, uri: str, warehouse: str, *, catalog_type: str = "rest",
                 s3_endpoint: str | None = None, path_style: bool = True,
                 region: str | None = None, access_key_env: str | None = None,
                 secret_key_env: str | None = None, environ: dict | None = None) -> dict[str, str]:
    """``spark.sql.catalog.<name>.*`` settings for an external table catalog.

    Needs the catalog's runtime jar on the class path; without it the session
    catalog is used (the default for every job here)."""
    environ = os.environ if environ is None else environ
    p = f"spark.sql.catalog.{name}"
    conf = {p: "org.apache.iceberg.spark.SparkCatalog", f"{p}.type": catalog_type,
            f"{p}.uri": uri, f"{p}.warehouse": warehouse}
    if s3_endpoint:
        conf[f"{p}.io-impl"] = "org.apache.iceberg.aws.s3.S3FileIO"
        conf[f"{p}.s3.endpoint"] = s3_endpoint
        conf[f"{p}.s3.path-style-access"] = str(path_style).lower()
    if region:
        conf[f"{p}.client.region"] = region
    if access_key_env and access_key_env in environ:
        conf[f"{p}.s3.access-key-id"] = environ[access_key_env]
    if secret_key_env and secret_key_env in environ:
        conf[f"{p}.s3.secret-access-key"] = environ[secret_key_env]
    return conf
