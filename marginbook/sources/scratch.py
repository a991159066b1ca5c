"""Intermediate data in the folder that all executors share."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``, or the one the session was given; none is made up."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder:
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(folder)
    return context.getCheckpointDir()


def stored(df: DataFrame) -> DataFrame:
    """The frame's rows, computed once and kept in the shared folder, so that later passes read and don't recompute them."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)
