"""Reading tables: pruned, typed, and filtered on the stored column."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.dates import parse_day


def read_table(spark: SparkSession, source: str, columns: Sequence[str] | None = None,
               schema: T.StructType | None = None) -> DataFrame:
    """A parquet path or a catalog table, lower-cased, with only the wanted columns."""
    if "/" in source:
        reader = spark.read.schema(schema) if schema is not None else spark.read
        df = reader.parquet(source)
    else:
        df = spark.table(source)
    df = lower_names(df)
    if schema is not None:
        df = df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields
                         if f.name in df.columns])
    return df.select(*columns) if columns else df


def lower_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.lower() for c in df.columns])


def day_range(column: str, begin: date, end: date, pattern: str | None = None) -> Column:
    """Range filter on a date column as stored.

    For text dates the *bounds* are formatted (``%Y%m%d`` or ``%Y-%m-%d``), never the column,
    so the predicate prunes partitions and row groups.
    """
    low, high = (begin, end) if pattern is None else (begin.strftime(pattern), end.strftime(pattern))
    return F.col(column).between(F.lit(low), F.lit(high))


def with_dates(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Text dates to DATE, once, at load."""
    return df.withColumns({c: parse_day(c) for c in columns})
