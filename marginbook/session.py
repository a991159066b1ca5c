"""Session settings the library relies on."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Settings that change results or safety at scale; everything else stays at the
# cluster's defaults.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    # Call-site capture costs milliseconds per Column; plans here hold thousands of them.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the library defaults to an existing session and return it; static ones keep the session's value."""
    for key, value in DEFAULTS.items():
        if spark.conf.isModifiable(key):
            spark.conf.set(key, value)
    return spark


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "marginbook") -> SparkSession:
    """A local session for tests and the benchmark."""
    builder = (SparkSession.builder.master(f"local[{cores}]").appName(app)
               .config("spark.ui.enabled", "false")
               .config("spark.driver.memory", "8g")
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions)))
    for key, value in DEFAULTS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
