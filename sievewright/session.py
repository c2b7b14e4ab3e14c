"""Session settings the jobs rely on. None replaces a value somebody has set."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Cleaning and judging a row is one long projection. A generated method above 8,000 bytes of code is never
# compiled by the JVM's just-in-time compiler; below this limit Spark splits it into small methods instead.
RUNTIME = {
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}

# Fixed when the session starts, so only a launcher can set it: building a plan from Python is twice as fast
# without a call-site record for every column expression.
AT_START = {"spark.python.sql.dataFrameDebugging.enabled": "false"}


def tune(spark: SparkSession) -> None:
    for key, value in RUNTIME.items():
        if spark.conf.get(key, None) is None:
            spark.conf.set(key, value)
