"""Incremental landing of listing-snapshot exports (S12 as a stream).

New export files dropped in a landing folder are picked up once each (the stream checkpoint remembers processed files),
read with the batch reader's parser (columns by each file's own header, quoted fields, encodings, missing values),
stamped with their snapshot day and published to the snapshot store, each micro-batch whole or not at all.
``Trigger.AvailableNow`` processes the backlog and stops, so a scheduled run and a replay produce the same store.

``keep="first"`` keeps the rows that the store holds for a (day, product); ``keep="last"`` lets later exports, in the
load order of their names, replace them, whenever they arrive. Either way a product lands once a day.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.exprs import file_date, key_normalize
from ..operators.standardize import SNAPSHOT_KEEP, SNAPSHOT_TYPES, find_column, named, tolerant
from ..sources import exports as EX
from ..sources import store as ST


def _columns(rows: DataFrame, schema: StructType | None, date_col: str) -> DataFrame:
    """The listing columns (``schema`` None), or the columns of ``schema`` by name in any case; keys normalised."""
    key = find_column(rows, "asin", required=False)
    day = file_date(F.element_at("_src_entry", -1))
    if schema is None:
        if key is None:
            rows, key = rows.withColumn("asin", F.lit(None).cast("string")), "asin"
        return tolerant(rows, SNAPSHOT_KEEP, SNAPSHOT_TYPES, key).withColumn(date_col, day)
    have = {c.lower(): c for c in rows.columns}
    out = []
    for f in schema.fields:
        c = named(have[f.name.lower()]) if f.name.lower() in have else F.lit(None).cast("string")
        c = F.when(c.isNotNull(), key_normalize(c)) if f.name.lower() == "asin" else c
        out.append(c.try_cast(f.dataType).alias(f.name))
    df = rows.select(*out, *[F.col(c) for c in rows.columns if c.startswith("_src_")])
    return df if date_col in schema.fieldNames() else df.withColumn(date_col, day)


def landing_rows(lines: DataFrame, schema: StructType | None = None, date_col: str = "snapshot_date",
                 keep: str = "first") -> tuple[DataFrame, DataFrame]:
    """(rows, rejects) of the lines of some export files: one row per (day, product), the first (or last) in load order,
    with ``_src_entry`` and ``_src_row``; rows without a day or a product are left out."""
    feed = EX.parse(lines)
    df = _columns(feed.rows, schema, date_col)
    key = [c for c in df.columns if c.lower() == "asin"]
    df = df.filter(F.col(date_col).isNotNull()).dropna(subset=key)
    rest = [c for c in df.columns if c not in (date_col, *key)]
    one = F.max_by if keep == "last" else F.min_by
    picked = df.groupBy(date_col, *key).agg(one(F.struct(*rest), F.struct("_src_entry", "_src_row")).alias("_one"))
    return picked.select(*key, *[F.col("_one")[c].alias(c) for c in rest], date_col), feed.rejects


def land_snapshots(spark: SparkSession, landing: str, schema: StructType | None, store: str, checkpoint: str,
                   date_col: str = "snapshot_date", keep: str = "first", rejects: str | None = None):
    """Start an AvailableNow stream from CSV exports in ``landing`` into ``store``.

    ``schema``: the columns to land, found by name in each file's header (strings are fine), or None for the
    standardised listing columns of the batch path. The snapshot day is taken from the column ``date_col`` when
    ``schema`` has it, else from the file name (``yyyy-MM-dd`` / ``Mon d, yyyy``). ``rejects``: a folder to which the
    account of unread records is appended, per batch.
    """
    def _batch(batch: DataFrame, epoch: int) -> None:
        lines = EX.written(batch.withColumn("mid", F.monotonically_increasing_id()))
        rows, bad = landing_rows(lines, schema, date_col, keep)
        if rejects is not None:
            bad.write.mode("overwrite").json(f"{rejects}/batch={epoch}")
        order = F.struct("_src_entry", "_src_row")
        out = rows.withColumn(ST.ORDER, order).drop("_src_entry", "_src_row", "_src_path", "_src_depth")
        ST.publish(out if keep == "last" else out.drop(ST.ORDER), store, date_col, keep, batch=f"{checkpoint}#{epoch}")

    return (EX.with_source(spark.readStream.text(landing)).writeStream.foreachBatch(_batch)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
