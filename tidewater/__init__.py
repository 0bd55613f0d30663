"""tidewater: Spark-native event ingestion and analytics.

Keyed JSON events are decoded leniently against declared schemas, watermarked,
reshaped and appended with exactly-once checkpoints to date-partitioned Parquet
tables, and queried in batch and streaming with built-in DataFrame/SQL operators.
"""

from tidewater.session import get_spark, shared_root, run_dir

__all__ = ["get_spark", "shared_root", "run_dir"]
