"""The snapshot store (S12, S13): landings published whole, later exports replace earlier rows, compaction.

    <store>/commit=<n>/snapshot_date=<day>/part-*.parquet      rows of landing n
    <store>/_commits/part-*.json                               one line per published landing

A landing writes its rows first and then appends one line to the manifest, in one file that Spark's committer moves into
place by a single rename. Readers follow the manifest only, so a landing that was killed half-way is invisible; the next
one takes the same number and overwrites what was left. ``batch`` names a landing: one already in the manifest is not
landed again, so a replayed stream gives the same store. One writer at a time.

``keep="first"``: rows of a (day, product) that the store holds are left out (the first snapshot of a day stays).
``keep="last"``: they are written too, and readers take the last row in load order (``_order``: names below the export
folder, then the row in the file, then the landing), whatever the order in which landings arrived.

``compact`` writes the present rows as one landing that takes the place of all before it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MANIFEST = "commit long, batch string, keep string, base boolean"
ORDER = "_order"


def _missing(e: Exception) -> bool:
    return any(x in str(e) for x in ("PATH_NOT_FOUND", "Unable to infer schema", "does not exist", "UNABLE_TO_INFER_SCHEMA"))


def commits(spark: SparkSession, store: str) -> list:
    """The published landings, oldest first, from the last compaction on: one row per landing."""
    try:
        rows = spark.read.schema(MANIFEST).json(f"{store}/_commits").collect()
    except Exception as e:  # noqa: BLE001 - no landing yet
        if not _missing(e):
            raise
        return []
    rows = sorted(rows, key=lambda r: r["commit"])
    base = max((i for i, r in enumerate(rows) if r["base"]), default=0)
    return rows[base:]


def _key(columns) -> list:
    return [c for c in columns if c.lower() == "asin"]


def _written(spark: SparkSession, store: str, landed: list) -> DataFrame:
    return spark.read.option("mergeSchema", True).option("basePath", store).parquet(
        *[f"{store}/commit={r['commit']}" for r in landed])


def read_store(spark: SparkSession, store: str, date_col: str = "snapshot_date") -> DataFrame | None:
    """The present rows; None where nothing was published."""
    landed = commits(spark, store)
    if not landed:
        return None
    df = _written(spark, store, landed)
    if any(r["keep"] == "last" for r in landed):
        key = [date_col, *_key(df.columns)]
        rest = [c for c in df.columns if c not in key]
        at = [F.col(ORDER)] if ORDER in df.columns else []
        last = df.groupBy(*key).agg(F.max_by(F.struct(*rest), F.struct(*at, "commit")).alias("_last"))   # pre-aggregated
        df = last.select(*key, *[F.col("_last")[c].alias(c) for c in rest]).select(*df.columns)
    return df.drop("commit", ORDER)


def publish(new: DataFrame, store: str, date_col: str = "snapshot_date", keep: str = "first", batch: str | None = None,
            order=None) -> int:
    """Land ``new``, one row per (day, product), whole or not at all; 1 if it was, 0 if it held nothing to land.

    ``order``: load order of the rows for ``keep="last"``, a column or the name of one that isn't stored otherwise."""
    spark, landed = new.sparkSession, None
    landed = commits(spark, store)
    if batch is not None and any(r["batch"] == batch for r in landed):
        return 0
    if order is not None:
        order = F.col(order) if isinstance(order, str) else order
        new = new.withColumn(ORDER, order)
    if keep == "first" and landed:
        keys = [date_col, *_key(new.columns)]
        new = new.join(_written(spark, store, landed).select(*keys).distinct(), keys, "left_anti")
    if new.isEmpty():
        return 0
    _commit(new, store, max((r["commit"] for r in landed), default=0) + 1, date_col, keep, batch, False)
    return 1


def _commit(rows: DataFrame, store: str, number: int, date_col: str, keep: str, batch: str | None, base: bool) -> None:
    rows.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(date_col).parquet(f"{store}/commit={number}")
    rows.sparkSession.createDataFrame([(number, batch, keep, base)], MANIFEST).coalesce(1).write.mode("append").json(
        f"{store}/_commits")


def compact(spark: SparkSession, store: str, date_col: str = "snapshot_date") -> int:
    """Write the present rows as one landing that readers start from; the number of landings it takes the place of.

    The rows keep their load order, so exports that arrive later are still merged by it."""
    landed = commits(spark, store)
    if len(landed) < 2:
        return 0
    df = _written(spark, store, landed)
    if ORDER not in df.columns:
        df = df.withColumn(ORDER, F.lit(None).cast("string"))
    key = [date_col, *_key(df.columns)]
    rest = [c for c in df.columns if c not in (*key, "commit")]
    last = df.groupBy(*key).agg(F.max_by(F.struct(*rest), F.struct(ORDER, "commit")).alias("_last"))
    rows = last.select(*key, *[F.col("_last")[c].alias(c) for c in rest])
    keep = "last" if any(r["keep"] == "last" for r in landed) else "first"
    _commit(rows, store, landed[-1]["commit"] + 1, date_col, keep, landed[-1]["batch"], True)
    return len(landed)


def superseded(spark: SparkSession, store: str) -> list:
    """Folders of published landings that a compaction took the place of and that may be removed."""
    try:
        rows = spark.read.schema(MANIFEST).json(f"{store}/_commits").collect()
    except Exception as e:  # noqa: BLE001
        if not _missing(e):
            raise
        return []
    live = {r["commit"] for r in commits(spark, store)}
    return sorted(f"{store}/commit={r['commit']}" for r in rows if r["commit"] not in live)
