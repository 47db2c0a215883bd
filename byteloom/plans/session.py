"""Session settings the decode plans rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession


# A static setting, to be made "false" when the session is built: recording the
# call site of every column operation costs much of the time it takes to build
# a plan of many expressions.
CALL_SITES = "spark.python.sql.dataFrameDebugging.enabled"


def tune(spark: SparkSession) -> SparkSession:
    """Settings that may be changed while a session runs.

    A wide decode puts many expressions into one projection.  Java does not
    compile methods above 8000 bytes of bytecode, so a projection beyond that
    is run with split methods instead of one whole-stage method.
    """
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", "8000")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    return spark
