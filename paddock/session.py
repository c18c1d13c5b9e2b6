"""Session settings the library relies on."""

from __future__ import annotations

from pyspark.sql import SparkSession


def configure(spark: SparkSession) -> SparkSession:
    """Turn on the adaptive features the plans count on, and times in UTC; leave all sizing to the cluster.

    These are settings of the caller's session. Every catalogued query and job stage sets them.
    """
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    # Split a skewed join side even where a later operator would have reused its partitioning.
    spark.conf.set("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark
