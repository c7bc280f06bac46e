"""Session defaults for standalone runs; a cluster's own settings win."""

from __future__ import annotations

from pyspark.sql import SparkSession


def build_session(app_name: str = "ledgerbrook", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution set up for skewed joins.

    `forceOptimizeSkewedJoin` lets Spark split a hot join key even where a later
    step then needs one more shuffle.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
