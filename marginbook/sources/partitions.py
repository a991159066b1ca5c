"""Partitions of catalog tables: append, replace, purge and rolling rebuild, with the rows of each load counted by the load itself.

A replaced partition is written to a folder of its own first. Only when every file is there does the catalog point the partition at the
new folder, so a job that is lost on the way leaves the old rows in place and readable.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .sink import align_to_schema

LOADED = "target string, mode string, partition string, rows long"


def _literal(value) -> str:
    return "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"


def _spec(keys: Mapping[str, str]) -> str:
    return ", ".join(f"`{k}` = {_literal(v)}" for k, v in keys.items())


def partition_keys(spark: SparkSession, table: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(table) if c.isPartition]


def create_table(spark: SparkSession, table: str, schema: T.StructType, keys: Sequence[str], location: str) -> None:
    """A partitioned parquet table whose folder all executors see. Its partitions may lie elsewhere once they are replaced."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet PARTITIONED BY ({', '.join(f'`{k}`' for k in keys)}) LOCATION {_literal(location)}")


def _observed(rows: DataFrame) -> tuple[DataFrame, Observation]:
    seen = Observation()
    return rows.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def append_rows(df: DataFrame, table: str, partitions: Mapping[str, str] | None = None) -> DataFrame:
    """Add the rows of ``df``, aligned to the table, to their partitions. Returns one row of ``LOADED``, counted while they were written."""
    spark = df.sparkSession
    keys = partition_keys(spark, table)
    rows = align_to_schema(df, spark.table(table).schema, partitions)
    # Few files per partition; the rebalance splits a partition that is far larger than the rest. The rows are counted above it: a
    # shuffle that turns out empty is dropped together with the plan below it.
    rows, seen = _observed(rows.hint("rebalance", *keys) if keys else rows)
    rows.write.insertInto(table)
    return spark.createDataFrame([(table, "append", None, int(seen.get["rows"]))], LOADED)


def replace_partitions(df: DataFrame, table: str, partitions: Mapping[str, str] | None = None, staging: str | None = None,
                       keep_old: bool = False) -> DataFrame:
    """Replace the partitions that ``df`` has rows for, and no others. Returns one row of ``LOADED`` per replaced partition.

    The rows are written to a new folder under ``staging`` (by default beside the table's own) and counted there; then each partition
    is pointed at its new folder. Nothing of the table changes before all rows are written. A NULL or empty partition value is an
    error, found before anything changes. The folders of the old rows are deleted last; with ``keep_old`` they stay for readers that
    began earlier, until the partition is purged.
    """
    spark = df.sparkSession
    keys = partition_keys(spark, table)
    if not keys:
        raise ValueError(f"{table} has no partitions")
    base = staging or _location(spark, table) + "-staged"
    folder = f"{base.rstrip('/')}/{uuid.uuid4().hex}"
    schema = spark.table(table).schema
    rows = align_to_schema(df, schema, partitions)
    rows.hint("rebalance", *keys).write.partitionBy(*keys).parquet(folder)
    # Reads the footers only: one row per partition, its count and one of its files.
    staged = spark.read.schema(schema).parquet(folder)
    found = staged.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"), F.min("_metadata.file_path").alias("file")).collect()
    if any(r[k] is None or r[k] == "" for r in found for k in keys):
        raise ValueError(f"rows without {', '.join(keys)} can't replace a partition of {table}")
    loaded = []
    for r in sorted(found, key=lambda r: tuple(str(r[k]) for k in keys)):
        spec, place = _spec({k: r[k] for k in keys}), _literal(unquote(r["file"]).rsplit("/", 1)[0])
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS PARTITION ({spec}) LOCATION {place}")
        old = _location(spark, table, f"PARTITION ({spec})")
        spark.sql(f"ALTER TABLE {table} PARTITION ({spec}) SET LOCATION {place}")
        if not keep_old and old != _location(spark, table, f"PARTITION ({spec})"):
            _delete(spark, old)
        loaded.append((table, "overwrite", "/".join(f"{k}={r[k]}" for k in keys), r["rows"]))
    spark.catalog.refreshTable(table)
    return spark.createDataFrame(loaded, LOADED)


def _location(spark: SparkSession, table: str, spec: str = "") -> str:
    """The folder of a table, or of one partition (named first in what Spark describes)."""
    rows = spark.sql(f"DESCRIBE FORMATTED {table} {spec}").filter("col_name = 'Location'").collect()
    return unquote(rows[0]["data_type"])


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def purge(spark: SparkSession, table: str, spec: Mapping[str, str]) -> int:
    """Drop every partition that agrees with ``spec``, which may name some of the keys only. Returns how many there were.

    The folder goes first, then the catalog's entry: rows of a table that keeps its files (an external one) would otherwise come back
    with the next load into the same partition. A job lost in between leaves an empty partition, which the next purge drops.
    """
    keys = partition_keys(spark, table)
    if not spec or not set(spec) <= set(keys):
        raise ValueError(f"a purge of {table} names some of its keys {keys}")
    # Catalogs differ in whether a drop takes part of a key, so every partition is named, in one statement.
    found = [r[0] for r in spark.sql(f"SHOW PARTITIONS {table} PARTITION ({_spec(spec)})").collect()]
    named = [_spec({k: unquote(v) for k, v in (part.split("=", 1) for part in row.split("/"))}) for row in found]
    for row, n in zip(found, named, strict=True):
        # Where the partition lies, and where the next load of it will.
        _delete(spark, _location(spark, table, f"PARTITION ({n})"))
        _delete(spark, f"{_location(spark, table)}/{row}")
    if named:
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {', '.join(f'PARTITION ({n})' for n in named)}")
    return len(named)


def months_back(month: str, back: int = 3) -> list[str]:
    """The months (yyyyMM) from ``back`` before ``month`` to ``month`` itself."""
    last = int(month[:4]) * 12 + int(month[4:]) - 1
    return [f"{m // 12:04d}{m % 12 + 1:02d}" for m in range(last - back, last + 1)]


def rebuild_months(spark: SparkSession, build: Callable[[list[str]], DataFrame], table: str, month: str, back: int = 3,
                   key: str = "busi_month") -> DataFrame:
    """Compute the last months of a partitioned result again and replace them, leaving all earlier months as they are.

    ``build`` gets the months wanted and returns their rows; it filters its sources by them, so a run reads the window and not the
    history. Rows of other months are dropped. A month of the window for which nothing was built is purged. Returns one row of
    ``LOADED`` per month of the window.
    """
    window = months_back(month, back)
    loaded = replace_partitions(build(window).filter(F.col(key).isin(window)), table)
    written = {r["partition"].split("=", 1)[1] for r in loaded.collect()}
    gone = [m for m in window if m not in written]
    for m in gone:
        purge(spark, table, {key: m})
    return loaded.unionByName(spark.createDataFrame([(table, "purge", f"{key}={m}", 0) for m in gone], LOADED))
