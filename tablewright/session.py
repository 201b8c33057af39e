"""Session settings the operators are written for."""

from __future__ import annotations

from pyspark.sql import SparkSession


def build_session(app: str = "tablewright", master: str | None = None, **conf: object) -> SparkSession:
    """A session with a UTC clock and adaptive execution.

    The number of shuffle partitions is only a starting point: adaptive execution
    merges small ones and splits skewed ones from the sizes it measures.  Pass
    Spark settings as ``**{"spark.some.key": value}`` to override anything here.
    """
    settings: dict[str, object] = {
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # A skewed join is split even where that costs one more shuffle behind it.
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    }
    settings.update(conf)
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, str(value))
    return builder.getOrCreate()
