"""String aggregation of groups of any size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import stored


def _pieces(df: DataFrame, group: Sequence[str], value: Column, sep: str, values_per_range: int) -> DataFrame:
    """Ordered pieces of each group's text: ``__range`` (in order), ``__text`` and the number of values in it."""
    values = stored(df.select(*group, value.cast("string").alias("__v")).filter(F.col("__v").isNotNull()).distinct())
    ranges = max(1, -(-values.count() // values_per_range))
    # Spark samples the (group, value) pairs for even ranges; a large group spreads over many, small ones share.
    placed = values.repartitionByRange(ranges, *group, "__v").withColumn("__range", F.spark_partition_id())
    return placed.groupBy(*group, "__range").agg(
        F.array_join(F.array_sort(F.collect_list("__v")), sep).alias("__text"), F.count(F.lit(1)).alias("__values"))


def ordered_concat(df: DataFrame, group: Sequence[str], value: Column | str, name: str, sep: str = "/",
                   values_per_range: int = 100_000) -> DataFrame:
    """The different values of each group, sorted and joined by ``sep``, as column ``name``.

    Values are sorted as text by their bytes; NULLs are left out, and a group of NULLs only has no row. Repeats are dropped before
    any shuffle. The values of all groups are cut into ranges of about ``values_per_range``; each range is joined by itself, and a group's
    pieces are joined in order. No task sorts more than a range; only the finished text of a group is one value, as it must be.
    """
    pieces = _pieces(df, group, F.col(value) if isinstance(value, str) else value, sep, values_per_range)
    ordered = F.array_sort(F.collect_list(F.struct("__range", "__text")))
    return pieces.groupBy(*group).agg(F.array_join(F.transform(ordered, lambda p: p["__text"]), sep).alias(name))
