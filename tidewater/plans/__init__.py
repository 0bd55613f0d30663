"""Registered queries: each is (spark, sf_dir) -> DataFrame over the driver's
tables, with an equivalent SQL text for an independent engine where one exists.
Importing this package registers everything."""

from tidewater.plans.registry import ORACLE, QUERIES  # noqa: F401
from tidewater.plans import batch, streams, lifecycle, detection  # noqa: F401,E402
