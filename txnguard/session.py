"""Session settings the operators rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession


def local_session(cores: str = "8", app: str = "txnguard", **conf: str) -> SparkSession:
    """A local session for tests and the bench."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", cores)
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")  # no call-site capture per expression
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return prepare(spark)


def prepare(spark: SparkSession) -> SparkSession:
    """Pin the settings results depend on; cluster sizing stays with the caller."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    return spark
