"""Session settings the operators are written for."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Run-time planning does the skew and size work: joins switch to broadcast only
# when the measured side is small, hot join partitions are split, and rebalanced
# writes are cut into files of the advisory size.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def get_session(
    app_name: str = "derrick", master: str | None = None, **extra: str
) -> SparkSession:
    """Session with the settings above; ``extra`` uses ``__`` for dots."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in extra.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()
