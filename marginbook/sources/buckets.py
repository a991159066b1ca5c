"""Large merge targets, stored in buckets of their key so that an update does not shuffle them."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from ..operators.merge import merge_update


def _save(df: DataFrame, table: str, keys: Sequence[str], buckets: int, location: str) -> None:
    df.write.format("parquet").bucketBy(buckets, *keys).sortBy(*keys).option("path", location).saveAsTable(table)


def create_target(df: DataFrame, table: str, keys: Sequence[str], buckets: int, folder: str) -> None:
    """Store a merge target in ``buckets`` buckets of ``keys`` under ``folder``: the one time that it is shuffled.

    Choose the number so that a bucket fits one task; it stays as it is over all merges.
    """
    _save(df.repartition(buckets, *keys), table, keys, buckets, f"{folder.rstrip('/')}/{uuid.uuid4().hex}")


def buckets_of(spark: SparkSession, table: str) -> tuple[list[str], int]:
    """The key columns and the number of buckets of a table."""
    info = {r[0]: r[1] for r in spark.sql(f"DESCRIBE FORMATTED {table}").collect()}
    if "Num Buckets" not in info:
        raise ValueError(f"{table} is not stored in buckets")
    return [c.strip(" `") for c in info["Bucket Columns"].strip("[]").split(",")], int(info["Num Buckets"])


def merged(spark: SparkSession, table: str, source: DataFrame, cols: Sequence[str], cond: str | None = None, overwrite_nulls: bool = False) -> DataFrame:
    """`merge_update` of a bucketed target: the source is dealt by the target's buckets, and the target is read in place."""
    keys, buckets = buckets_of(spark, table)
    return merge_update(spark.table(table), source.repartition(buckets, *keys), keys, cols, cond, overwrite_nulls)


def merge_into(spark: SparkSession, table: str, source: DataFrame, cols: Sequence[str], folder: str, cond: str | None = None,
               overwrite_nulls: bool = False) -> None:
    """Update a bucketed target and keep it bucketed: rows go from the target's buckets to new ones without an exchange.

    The result is written to a new place under ``folder`` and the table then points there, so a lost job leaves the old rows. The
    target keeps its columns: one of ``cols`` that it lacks is an error.
    """
    missing = [c for c in cols if c not in spark.table(table).columns]
    if missing:
        raise ValueError(f"{table} has no column {', '.join(missing)}")
    keys, buckets = buckets_of(spark, table)
    place, step = f"{folder.rstrip('/')}/{uuid.uuid4().hex}", f"{table}_{uuid.uuid4().hex}"
    _save(merged(spark, table, source, cols, cond, overwrite_nulls), step, keys, buckets, place)
    spark.sql(f"ALTER TABLE {table} SET LOCATION '{place}'")
    spark.sql(f"DROP TABLE {step}")
    spark.catalog.refreshTable(table)
