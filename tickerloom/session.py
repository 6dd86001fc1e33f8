"""Session settings the library is tuned for."""

from __future__ import annotations

from pyspark.sql import SparkSession


def build_session(app: str = "tickerloom", master: str | None = None,
                  conf: dict[str, str] | None = None) -> SparkSession:
    """A session with UTC time and adaptive execution.

    Shuffle partitions are left to the cluster: adaptive execution coalesces a
    generous initial number, so set `spark.sql.shuffle.partitions` for the
    largest shuffle and let it shrink. `conf` overrides any of the settings.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    for key, value in (conf or {}).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
