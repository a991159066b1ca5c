"""Schema-aligned loads into partitioned tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .tables import lower_names


def align_to_schema(df: DataFrame, schema: T.StructType,
                    partitions: Mapping[str, str] | None = None) -> DataFrame:
    """Lower-case names, add missing columns as NULL, set partition literals, drop the rest, reorder."""
    have = lower_names(df)
    fixed = {k.lower(): v for k, v in (partitions or {}).items()}
    out = []
    for field in schema.fields:
        name = field.name.lower()
        if name in fixed:
            value = F.lit(fixed[name])
        elif name in have.columns:
            value = F.col(name)
        else:
            value = F.lit(None)
        out.append(value.cast(field.dataType).alias(field.name))
    return have.select(*out)


def load_aligned(df: DataFrame, schema: T.StructType, path: str, mode: str = "overwrite",
                 partition_by: list[str] | None = None, partitions: Mapping[str, str] | None = None,
                 observe: Observation | None = None) -> None:
    """Write an aligned frame; ``overwrite`` replaces only the partitions the frame contains.

    ``observe`` collects the row count during the write itself.
    """
    out = align_to_schema(df, schema, partitions)
    keys = partition_by or list(partitions or {})
    varying = [k for k in keys if k not in (partitions or {})]
    if varying:
        # Few files per partition; the rebalance splits a partition that is far larger than the rest.
        out = out.hint("rebalance", *varying)
    if observe is not None:
        # Above the rebalance: a shuffle that turns out empty is dropped together with the plan below it.
        out = out.observe(observe, F.count(F.lit(1)).alias("rows"))
    writer = out.write.mode(mode).option("partitionOverwriteMode", "dynamic")
    (writer.partitionBy(*keys) if keys else writer).parquet(path)


def insert_aligned(df: DataFrame, table: str, mode: str = "append",
                   partitions: Mapping[str, str] | None = None) -> None:
    """The same into a catalog table, whose own schema decides columns and order; ``overwrite`` replaces only the
    partitions the frame contains, whatever the session's mode."""
    spark, key = df.sparkSession, "spark.sql.sources.partitionOverwriteMode"
    rows, before = align_to_schema(df, spark.table(table).schema, partitions), spark.conf.get(key)
    spark.conf.set(key, "dynamic")
    try:
        rows.write.insertInto(table, overwrite=mode == "overwrite")
    finally:
        spark.conf.set(key, before)


def purge_partition(spark: SparkSession, table: str, spec: Mapping[str, str]) -> None:
    """Drop one partition before a reload (not needed with dynamic overwrite)."""
    parts = ", ".join(f"{k}='{str(v).replace(chr(39), chr(39) * 2)}'" for k, v in spec.items())
    spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({parts})")
