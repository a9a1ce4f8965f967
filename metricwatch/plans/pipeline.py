"""End-to-end runs over export folders: the daily digest (L1) and the look-back
backtest (L2).

Both build lazy plans; only file listings (names, bounded by the number of
export files) and the one anchor day are read on the driver.  The master
table and the full-history alerts are cut from their lineage once
(``checkpoint`` into the shared ``spark.checkpoint.dir``) because several
outputs read them: recomputation after a lost executor then restarts from
the checkpoint, not from the raw exports.
"""

from __future__ import annotations

import datetime as dt
from typing import Dict, Optional

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import DEFAULT, Config
from ..operators import alerts as AL
from ..operators import backtest as BT
from ..operators import detect as D
from ..operators import master as MS
from ..operators import snapshot as SN
from ..operators import standardize as ST
from ..session import checkpoint_dir
from ..sources import files as FL

FOLDERS = ("sellerise", "returns", "inventory", "helium10")


def load_sources(spark: SparkSession, folders: Dict[str, str]) -> Dict[str, object]:
    """Anchor day from the listing-snapshot folder, then the four feeds (S6–S9); ``rejects``: what of their files was
    not read (source, path, row, reason, record)."""
    lists = {k: FL.list_files(spark, folders[k]) for k in FOLDERS if folders.get(k)}
    anchor = lists["helium10"].agg(F.max("file_date")).first()[0] if "helium10" in lists else None
    wanted = dict(lists)
    if anchor and "returns" in lists:
        wanted["returns"] = FL.select_all_or_day(lists["returns"], anchor)
    if anchor and "inventory" in lists:
        wanted["inventory"] = FL.select_day_or_latest_one(lists["inventory"], anchor)
    if "helium10" in lists:
        wanted["helium10"] = FL.select_day_or_latest_all(lists["helium10"], anchor)
    feeds = {k: FL.read_exports(spark, listing) for k, listing in wanted.items()}
    rejects = None
    for k, feed in feeds.items():
        bad = feed.rejects.select(F.lit(k).alias("source"), "*")
        rejects = bad if rejects is None else rejects.unionAll(bad)
    return {"reference_date": anchor, "rejects": rejects, **{k: feed.rows for k, feed in feeds.items()}}


def build_master(raw: Dict[str, object], cfg: Config = DEFAULT) -> DataFrame:
    """Standardise the feeds, merge (J4), keep the last row per (asin, date) (W5), tiers (A3)."""
    feed = raw["sellerise"]
    if not _has_rows_schema(feed):           # no export yet: a typed empty master
        feed = feed.select("*", *[F.lit(None).cast("string").alias(c) for c in ST.SALES_RENAME])
    sales = ST.standardize_sales(ST.normalize_pct(feed))
    returns = (ST.standardize_returns(raw["returns"], cfg.distinct_return_rows)
               if _has_rows_schema(raw.get("returns")) else None)
    inventory = ST.standardize_inventory(raw["inventory"]) if _has_rows_schema(raw.get("inventory")) else None
    snapshot = ST.standardize_snapshot(raw["helium10"]) if _has_rows_schema(raw.get("helium10")) else None
    merged = MS.merge_sources(sales, returns, inventory, snapshot)
    master = ST.keep_last(merged, ["asin", "date"])
    return MS.assign_tiers(master.drop(*[c for c in ST.ORDER_COLUMNS if c in master.columns]), cfg)


def _has_rows_schema(df) -> bool:
    """Whether a feed has columns of its own; the reader gives only its ``_src`` columns where there is no file."""
    return df is not None and any(not c.startswith("_src_") for c in df.columns)


def run_pipeline(spark: SparkSession, folders: Dict[str, str], cfg: Config = DEFAULT,
                 run_date: Optional[dt.date] = None, snapshot_store: Optional[str] = None,
                 export_path: Optional[str] = None, checkpoint: bool = True,
                 rejects_path: Optional[str] = None) -> Dict[str, object]:
    """L1: detection over the full history, one anchored day's digest. The account of unread records and files is
    returned as ``rejects`` and, with ``rejects_path``, written under the run day."""
    run_date = run_date or dt.date.today()
    if checkpoint:
        checkpoint_dir(spark)            # the shared folder named by the cluster; error if none
    raw = load_sources(spark, folders)
    if rejects_path and raw["rejects"] is not None:
        raw["rejects"].withColumn("run_date", F.lit(run_date).cast("date")).write.mode("overwrite").option(
            "partitionOverwriteMode", "dynamic").partitionBy("run_date").parquet(rejects_path)
    master = build_master(raw, cfg)
    if checkpoint:
        master = master.checkpoint()
    if snapshot_store and _has_rows_schema(raw.get("helium10")):
        FL.write_snapshot(ST.standardize_snapshot(raw["helium10"]), snapshot_store, run_date)
    alerts = D.detect(master, cfg)
    if snapshot_store:
        hist = FL.read_snapshot_history(spark, snapshot_store)
        if set(hist.columns) - {"asin", "snapshot_date"}:
            alerts = SN.all_alerts(alerts, SN.snapshot_detect(hist.withColumnRenamed("snapshot_date", "date"), master, cfg))
    flagged = D.flagged_rows(alerts)
    if checkpoint:
        flagged = flagged.checkpoint()
    anchor = raw["reference_date"]
    day = D.anchor_filter(flagged, anchor)
    if export_path:
        FL.export_alerts(day, export_path, run_date)
    digest_rows = AL.capped(day, cfg)
    flags = AL.cross_metric_flags(digest_rows)
    with_flags = digest_rows.join(flags, ["date", "asin"], "left")
    top = AL.top_alerts(with_flags, cfg).select("*", AL.explanation(F.col("flags")).alias("explanation"))
    summary = AL.digest_summary(digest_rows)
    subject = summary.select("date", AL.subject(summary, cfg, F.lit(run_date).cast("date")).alias("subject"))
    return {"reference_date": anchor, "rejects": raw["rejects"], "master": master, "alerts": flagged, "day_alerts": day,
            "digest_rows": AL.section_rows(digest_rows), "top_alerts": top, "summary": summary, "subject": subject,
            "newest_sales_date": master.agg(F.max("date")).first()[0]}


def run_backtest(spark: SparkSession, folders: Dict[str, str], cfg: Config = DEFAULT,
                 checkpoint: bool = True) -> Dict[str, DataFrame]:
    """L2: detection over all dates, then the look-back reports A10–A18."""
    if checkpoint:
        checkpoint_dir(spark)
    master = build_master(load_sources(spark, folders), cfg)
    alerts = D.flagged_rows(D.detect(master, cfg))
    if checkpoint:
        alerts = alerts.checkpoint()
    pre = BT.report_counts(alerts)
    if checkpoint:
        pre = pre.checkpoint()
    return {"daily": BT.daily(pre, cfg), "daily_stats": BT.daily_stats(pre, cfg), "verdict": BT.verdict(pre, cfg),
            "by_metric": BT.by_metric(pre, cfg), "by_trigger": BT.by_trigger(pre, cfg),
            "by_tier": BT.by_tier(pre, BT.tier_table(spark), cfg), "noisiest": BT.noisiest(alerts, cfg),
            "floor_audit": BT.floor_audit(pre, cfg), "range": BT.date_range(pre, cfg)}
