"""Session settings the jobs are written for."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    # run-time plans: merge small partitions, split hot ones, switch joins by measured size
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # a suite is one wide projection; beyond this size the JVM would interpret the generated method
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # do not record a Python call site for every column expression
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


HUGE_METHOD = "spark.sql.codegen.hugeMethodLimit"


def keep_compiled(spark: SparkSession) -> None:
    """Hold a session, however it was made, to the size of generated methods that the JVM compiles."""
    if int(spark.conf.get(HUGE_METHOD)) > int(SETTINGS[HUGE_METHOD]):
        spark.conf.set(HUGE_METHOD, SETTINGS[HUGE_METHOD])


def configure(builder: SparkSession.Builder) -> SparkSession.Builder:
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    return builder
