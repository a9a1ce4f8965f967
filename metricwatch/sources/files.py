"""Export-folder ingestion (S1–S10, S12–S14) with the DataFrame reader.

A folder holds seller exports directly and in exactly one level of
sub-folders.  File names carry the export day; the listing is itself a
DataFrame (``binaryFile`` scan with only ``path`` selected, so file contents
are not read), so date pruning and the "latest file" fallbacks are plain
filters and window functions over the listing.
"""

from __future__ import annotations

import os
import re
from typing import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.exprs import file_date
from . import exports as EX
from . import store as ST

CSV_ENDINGS = (".csv",)


def _glob_safe(folder: str) -> str:
    """The folder's own name as a glob: its special characters stand for themselves."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", folder)


def list_files(spark: SparkSession, folder: str, endings: Iterable[str] = CSV_ENDINGS) -> DataFrame:
    """Files directly in ``folder`` and one sub-folder level down (dot-entries skipped), by ending in any case.

    Columns: path, name, depth (0 = top level), entry (names below the folder, whose order is the load order),
    file_date (S2)."""
    try:        # of the folder's sub-folders it lists the files directly in them
        df = spark.read.format("binaryFile").load(f"{_glob_safe(folder.rstrip('/'))}/*").select("path")
    except Exception as e:  # noqa: BLE001 - an empty glob is an empty listing
        if "PATH_NOT_FOUND" not in str(e) and "Path does not exist" not in str(e):
            raise
        return spark.createDataFrame([], "path string, name string, depth int, entry array<string>, file_date date")
    root = re.sub("^file:/+", "/", folder if re.match("[a-z][a-z0-9+.-]*:/", folder) else os.path.abspath(folder)).rstrip("/")
    rel = F.substring(EX.no_scheme(F.col("path")), len(root) + 2, 2**31 - 1)      # the prefix goes by length
    df = df.distinct().select("path", F.split(rel, "/").alias("entry"))
    name = F.element_at("entry", -1)
    wanted = F.lit(False)
    for e in endings:
        wanted = wanted | F.lower(name).endswith(e.lower())
    return (df.filter(wanted & (F.size("entry") <= 2) & ~F.exists("entry", lambda x: x.startswith(".")))
            .select("path", name.alias("name"), (F.size("entry") - 1).cast("int").alias("depth"), "entry")
            .withColumn("file_date", file_date(F.col("name"))))


def _day(day) -> Column:
    return day if isinstance(day, Column) else F.lit(day).cast("date")


def files_for_date(listing: DataFrame, day) -> DataFrame:
    """S3: files whose name-date equals ``day``."""
    return listing.filter(F.col("file_date") == _day(day))


def latest_date(listing: DataFrame) -> Column:
    """Newest name-date of a listing, as a scalar subquery column."""
    return listing.agg(F.max("file_date")).scalar()


def select_all_or_day(listing: DataFrame, day) -> DataFrame:
    """S7 (returns): the day's files; if there are none, every file.

    One plan: the day's files, plus every file when the day has none
    (``exists`` as a scalar count)."""
    d = _day(day)
    has_day = listing.filter(F.col("file_date") == d).agg(F.count(F.lit(1))).scalar() > 0
    return listing.filter((F.col("file_date") == d) | ~has_day)


def _load_key(listing: DataFrame) -> Column:
    """Entries of a folder, files and sub-folders together, go by name; listings without ``entry`` by depth and path."""
    return F.col("entry") if "entry" in listing.columns else F.struct("depth", "path")


def select_day_or_latest_one(listing: DataFrame, day) -> DataFrame:
    """S8 (inventory): the day's files; else the single most recently dated file (ties:
    first in load order); else, when nothing is dated, every file.

    Three scalar subqueries over the listing; no window over the whole listing."""
    d = _day(day)
    n_day = listing.filter(F.col("file_date") == d).agg(F.count(F.lit(1))).scalar()
    dated = listing.filter(F.col("file_date").isNotNull())
    newest = dated.agg(F.max("file_date")).scalar()
    first_newest = (dated.filter(F.col("file_date") == newest)
                    .agg(F.min_by(F.col("path"), _load_key(listing))).scalar())
    keep = (F.when(n_day > 0, F.col("file_date") == d)
            .when(newest.isNotNull(), F.col("path") == first_newest)
            .otherwise(F.lit(True)))
    return listing.filter(keep)


def select_day_or_latest_all(listing: DataFrame, day) -> DataFrame:
    """S9 (listing snapshot): every file of the day, or of the newest day when the day is
    not given; a folder without dated files -> every file; dated but no match -> none."""
    n_dated = listing.filter(F.col("file_date").isNotNull()).agg(F.count(F.lit(1))).scalar()
    target = _day(day) if day is not None else listing.agg(F.max("file_date")).scalar()
    return listing.filter(F.when(n_dated > 0, F.col("file_date") == target).otherwise(F.lit(True)))


def read_exports(spark: SparkSession, listing: DataFrame, on_long: str = "file") -> EX.Feed:
    """Every listed CSV as text columns, and what was not read.

    UTF-8 (BOM stripped) or Latin-1 per file; files with different headers are outer-unioned by column name. Each row
    keeps ``_src_entry`` (names below the folder, the load order), ``_src_path``, ``_src_depth`` and ``_src_row`` (record in
    its file; the header is 0). No file: only the ``_src`` columns. The files are scanned once; see ``exports``."""
    files = listing.orderBy(_load_key(listing)).select("path", "depth").collect()      # bounded by the number of export files
    if not files:
        return EX.Feed(spark.createDataFrame([], EX.SRC), spark.createDataFrame([], EX.REJECTS))
    # names above the listed folder's entries
    root_parts = re.sub("^file:/+", "/", files[0]["path"]).count("/") - files[0]["depth"]
    entry = F.slice(F.split(EX.decoded(EX.no_scheme(F.col("path"))), "/"), root_parts + 1, 2**31 - 1)
    return EX.parse(EX.scan_lines(spark, [r["path"] for r in files]), listing, entry, on_long)


def read_csv_files(spark: SparkSession, listing: DataFrame) -> DataFrame:
    """The rows of ``read_exports``."""
    return read_exports(spark, listing).rows


def write_snapshot(df: DataFrame, store: str, snapshot_date, date_col: str = "snapshot_date") -> int:
    """Append one day's listing snapshot to a store partitioned by ``snapshot_date``.

    Idempotent: rows whose (day, product) already exists in the store are dropped by a
    left-anti join, so writing the same day twice keeps
    the first copy.  Returns 1 when written, 0 when skipped."""
    spark = df.sparkSession
    new = df.withColumn(date_col, F.lit(snapshot_date).cast("date"))
    return append_new_days(spark, new, store, date_col)


def append_new_days(spark: SparkSession, new: DataFrame, store: str, date_col: str = "snapshot_date") -> int:
    """Land the rows whose (day, product) the store doesn't hold yet, so that a day's later files, or the rest of a
    landing that broke off, still arrive; frames without a product column go by day. 1 when something landed."""
    return ST.publish(new, store, date_col)


def read_snapshot_history(spark: SparkSession, store: str) -> DataFrame:
    """The whole store (schema merged across days); empty where nothing was landed."""
    rows = ST.read_store(spark, store)
    return rows if rows is not None else spark.createDataFrame([], "asin string, snapshot_date date")


def export_alerts(alerts: DataFrame, path: str, run_date) -> None:
    """The full alert set of a run, 5 numeric columns rounded to 4 places,
    written as Parquet under ``run_date=...`` (replaces the spreadsheet export)."""
    r = alerts_export_frame(alerts, run_date)
    r.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run_date").parquet(path)


def alerts_export_frame(alerts: DataFrame, run_date) -> DataFrame:
    num = ("actual_value", "expected_value", "yoy_baseline", "z_score", "yoy_deviation")
    cols = [F.round(F.col(c), 4).alias(c) if c in num else F.col(c) for c in alerts.columns]
    run = run_date if isinstance(run_date, Column) else F.lit(run_date)
    return alerts.select(*cols, run.cast("date").alias("run_date"))

