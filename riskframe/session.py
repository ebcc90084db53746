"""Session settings used by tests, the bench and stand-alone scripts.

On a cluster the caller brings its own session; nothing in the library
depends on the values set here except the UTC session zone.
"""

from __future__ import annotations

from pyspark.sql import SparkSession


def local_session(cores: int | str = 8, app: str = "riskframe") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # no call-site capture per expression: it multiplies the cost of building wide plans
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark
