"""Exact distinct counts as bitmaps that merge over days and ranges.

Keys get numbers from a dictionary; a bitmap holds the numbers of one bucket of 32,768. Bitmaps of a day are built once
and combined by OR, so the products of any range of days are counted without going back to the rows, and several
distinct counts in one aggregate need neither an Expand nor a shuffle of the keys. Days are their own numbers.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKET, BITS = "_bucket", "_bits"


def day_number(date: Column) -> Column:
    return F.datediff(date, F.lit("1970-01-01").cast("date")).cast("long")


def key_ids(rows: DataFrame, key: str) -> DataFrame:
    """The dictionary (key, ``_id``): every distinct non-null key has a number, dense within a partition.

    It is checkpointed, as a lost task that ran again could number its keys otherwise."""
    keys = rows.select(key).filter(F.col(key).isNotNull()).distinct()
    return keys.withColumn("_id", F.monotonically_increasing_id()).checkpoint()


def bitmaps(rows: DataFrame, number: Column, by: Sequence[str] = ()) -> DataFrame:
    """(by…, bucket, bits): the numbers that occur per group; null numbers count for nothing."""
    return rows.filter(number.isNotNull()).groupBy(*by, F.bitmap_bucket_number(number).alias(BUCKET)).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(number)).alias(BITS))


def merge(bits: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Bitmaps of coarser groups."""
    return bits.groupBy(*by, BUCKET).agg(F.bitmap_or_agg(BITS).alias(BITS))


def count(bits: DataFrame, by: Sequence[str] = (), name: str = "n") -> DataFrame:
    """Distinct numbers per group, of bitmaps merged to that group."""
    n = F.coalesce(F.sum(F.bitmap_count(BITS)), F.lit(0)).alias(name)
    return bits.groupBy(*by).agg(n) if by else bits.agg(n)


def trailing_products(alerts: DataFrame, widths: Sequence[int] = (1, 7, 30)) -> DataFrame:
    """Per day with alerts, the distinct products alerted in the ``w`` calendar days that end with it, for every width.

    Each day's bitmaps go to the days whose range holds them; only days with alerts are returned. Alerts without a day or a
    product count for nothing, a day whose alerts all lack a product gives zeros; an empty table gives no row."""
    dated = alerts.filter(F.col("date").isNotNull())
    numbered = dated.select("date", "asin").join(key_ids(dated, "asin"), "asin")
    day = bitmaps(numbered, F.col("_id"), ["date"])
    reach = F.array(*[F.struct(F.lit(w).alias("_width"), F.lit(k).alias("_ago")) for w in widths for k in range(w)])
    moved = day.select("*", F.inline(reach)).withColumn("date", F.date_add("date", F.col("_ago")))
    sums = count(merge(moved, ["date", "_width"]), ["date", "_width"])
    wide = sums.groupBy("date").agg(*[F.max(F.when(F.col("_width") == w, F.col("n"))).alias(f"n_asins_{w}") for w in widths])
    return dated.select("date").distinct().join(wide, "date", "left").na.fill(0)
