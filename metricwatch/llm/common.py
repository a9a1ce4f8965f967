"""Helpers shared by the text operators: tables, lineage cuts and word rules."""

from __future__ import annotations

import gc
import shutil
import tempfile
from functools import lru_cache
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: A word is a run of characters other than the six ASCII white-space characters (fixed value).
WORD = r"[^\x20\x09-\x0D]+"
#: The ASCII white-space characters themselves (fixed value).
SPACES = " \t\n\x0b\f\r"


@lru_cache(maxsize=1)
def _archive() -> str:
    package = Path(__file__).resolve().parents[1]
    return shutil.make_archive(f"{tempfile.mkdtemp(prefix='metricwatch-zip-')}/metricwatch", "zip", package.parent, package.name)


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give Python workers this package (once per application); they may run where it isn't installed."""
    sc = spark.sparkContext
    if sc.applicationId not in _SHIPPED:
        sc.addPyFile(_archive())
        _SHIPPED.add(sc.applicationId)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; where the session names none, one beside its tables, which executors share."""
    sc = spark.sparkContext
    folder = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if not folder:
        folder = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_checkpoints"
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(folder)
    return folder


def cut(df: DataFrame) -> DataFrame:
    """Materialise ``df`` once in the shared checkpoint folder and go on from there."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def release(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files and checkpoints of frames that nothing refers to any more: it learns of them
    when the driver collects its garbage, which it may not need to for a long time."""
    gc.collect()
    spark._jvm.System.gc()


def text_of(col: str = "text") -> Column:
    """The text with null as empty."""
    return F.coalesce(F.col(col), F.lit(""))


def word_count(col: str = "text") -> Column:
    return F.regexp_count(text_of(col), F.lit(WORD)).cast("long")


def parallelism(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


#: Bits of the map in ``likely_in``; its size bounds what is broadcast (1 MB of bits).
MAP_BITS = 1 << 23


def likely_in(df: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """Rows of ``df`` whose ``key`` occurs in ``ids``, and a few others: a cheap cut before an exact join.

    The keys are hashed into a bit map of ``MAP_BITS`` bits (131,072 rows of 64 at most), which is broadcast.
    """
    spot = F.pmod(F.xxhash64(key), F.lit(MAP_BITS))
    word, place = F.floor(spot / 64).alias("__word"), (spot % 64).cast("int").alias("__place")
    bits = ids.select(word, place).groupBy("__word").agg(F.bit_or(F.expr("shiftleft(1L, __place)")).alias("__bits"))
    return df.select("*", word, place).join(F.broadcast(bits), "__word").filter(
        F.expr("shiftright(__bits, __place) & 1") == 1).select(*df.columns)
