"""Session defaults used by the benchmark and the tests.

On a cluster the session usually exists already; nothing in the library
depends on the values below except for speed.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def build_session(
    name: str = "verdure", master: str | None = None, **settings: str
) -> SparkSession:
    """Get or create a session; ``settings`` use ``__`` in place of dots."""
    builder = SparkSession.builder.appName(name)
    if master is not None:
        builder = builder.master(master)
    overrides = {key.replace("__", "."): value for key, value in settings.items()}
    for key, value in {**DEFAULTS, **overrides}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
