"""Session settings the jobs here run best with. All are ordinary Spark settings; none is required."""

from __future__ import annotations

from pyspark.sql import SparkSession

RECOMMENDED = {
    # re-plan joins at run time: broadcast what turned out small, split skewed partitions
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # the JVM does not compile methods beyond 8000 bytes; wide projections then run faster in pieces
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # do not record a call site for each column expression
    "spark.sql.dataFrameQueryContext.enabled": "false",
}


def recommended(builder: SparkSession.Builder) -> SparkSession.Builder:
    for key, value in RECOMMENDED.items():
        builder = builder.config(key, value)
    return builder
