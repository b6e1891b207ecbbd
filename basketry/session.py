"""Session settings that the library relies on."""

from __future__ import annotations

from pyspark.sql import SparkSession


def prepare(spark: SparkSession) -> SparkSession:
    """Read and cut times in UTC. Every plan that touches event times calls this first."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark
