"""Session settings the library is meant to run under."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.ui.enabled": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def builder(app: str = "lotwise") -> SparkSession.Builder:
    session = SparkSession.builder.appName(app)
    for key, value in SETTINGS.items():
        session = session.config(key, value)
    return session
