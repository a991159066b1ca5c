"""Exact distinct counts over nested periods, from one scan."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .calendar import period_key

NESTED = ("month", "quarter", "year")


def item_bitmaps(df: DataFrame, keys: Sequence[str], item: str, day: Column | str) -> DataFrame:
    """The items of each key and month as bitmaps: ``keys, __month (its first day), __bucket, __items``.

    An item is a whole number; a bitmap holds the 32,768 numbers of one bucket. Bitmaps of a month can be stored and merged with
    later ones, exactly. They are small where numbers are given out one after the other; numbers scattered over the whole range
    take up to four kilobytes each.
    """
    d = F.col(day) if isinstance(day, str) else day
    rows = df.select(*keys, F.trunc(d, "month").alias("__month"), F.col(item).cast("long").alias("__item")).filter("__item IS NOT NULL AND __month IS NOT NULL")
    return (rows.groupBy(*keys, "__month", F.bitmap_bucket_number("__item").alias("__bucket"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position("__item")).alias("__items")))


def count_bitmaps(bitmaps: DataFrame, keys: Sequence[str], name: str, grains: Sequence[str] = NESTED) -> DataFrame:
    """``keys, grain, period`` and the number of different items, for every grain, from monthly bitmaps.

    Each month's bitmap is or-ed into its quarter and its year; the items themselves are not looked at again.
    """
    unknown = set(grains) - set(NESTED)
    if unknown:
        raise ValueError(f"periods made of whole months are {NESTED}, not {sorted(unknown)}")
    periods = F.array(*[F.struct(F.lit(g).alias("grain"), period_key(g, "__month").alias("period")) for g in grains])
    spread = bitmaps.select(*keys, "__bucket", "__items", F.explode(periods).alias("__p")).select(*keys, "__bucket", "__items", "__p.*")
    merged = spread.groupBy(*keys, "grain", "period", "__bucket").agg(F.bitmap_or_agg("__items").alias("__items"))
    return merged.groupBy(*keys, "grain", "period").agg(F.sum(F.bitmap_count("__items")).alias(name))


def nested_distinct(df: DataFrame, keys: Sequence[str], item: str, day: Column | str, name: str, grains: Sequence[str] = NESTED) -> DataFrame:
    """How many different items each key has in every month, quarter and year. NULL items and days don't count; repeats count once."""
    return count_bitmaps(item_bitmaps(df, keys, item, day), keys, name, grains)
