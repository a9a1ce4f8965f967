"""Listing-snapshot series: detection (D22, D23, A7), product metadata
and the union with the daily alerts (O5).

The history is unpivoted once to (asin, date, metric, value); NULL values are
dropped *before* the window, so they do not take a frame slot (unlike the
daily feed).  The window is partitioned by (asin, metric), so the work is
spread over four times as many groups as products.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import DEFAULT, Config
from ..functions.exprs import bad_score, escalate, nan_to_null, rank_label, round_score, safe_div, severity_rank
from .detect import ensure_columns


def _per_metric(metrics: Sequence[str], make) -> Column:
    """A CASE over ``metric`` choosing a per-metric expression (literals differ per metric)."""
    out = None
    for m in metrics:
        e = make(m)
        out = F.when(F.col("metric") == m, e) if out is None else out.when(F.col("metric") == m, e)
    return out


def snapshot_gate(history: DataFrame, cfg: Config = DEFAULT) -> Column:
    """A7 as a predicate: at least ``snapshot_min_dates`` distinct snapshot days (scalar subquery)."""
    return history.agg(F.countDistinct("date")).scalar() >= F.lit(cfg.snapshot_min_dates)


def unpivot_history(history: DataFrame, metrics: Sequence[str]) -> DataFrame:
    present = [m for m in metrics if m in history.columns]
    structs = [F.struct(F.lit(m).alias("metric"), nan_to_null(F.col(m).cast("double")).alias("value")) for m in present]
    return history.select("asin", "date", F.inline(F.array(*structs))).filter(F.col("value").isNotNull())


def snapshot_scores(history: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """Rolling mean/std/z and severity per (asin, metric) over non-null snapshot values."""
    metrics = [m for m in cfg.snapshot_metrics if m in history.columns]
    long = unpivot_history(history.filter(snapshot_gate(history, cfg)), metrics)
    w = (Window.partitionBy("asin", "metric").orderBy("date")
         .rowsBetween(-(cfg.rolling_window - 1), Window.currentRow))
    ok = F.count("value").over(w) >= F.lit(cfg.rolling_min_periods)
    mean = _per_metric(metrics, lambda m: F.round(F.when(ok, F.avg("value").over(w)), cfg.digits(m)))
    std = _per_metric(metrics, lambda m: F.round(F.when(ok, F.stddev_samp("value").over(w)), cfg.std_digits(m)))
    df = long.select("*", mean.alias("roll_mean"), std.alias("roll_std"))
    z = round_score(safe_div(F.col("value") - F.col("roll_mean"), F.col("roll_std")), cfg.score_digits)
    df = df.withColumn("z_score", z)
    roll = _per_metric(metrics, lambda m: severity_rank(bad_score(F.col("z_score"), cfg.direction.get(m, "down")),
                                                        cfg.z_thresholds.get(m, (1.5, 2.0, 3.0))))
    trig = F.when(roll.isNotNull(), F.lit("rolling"))
    df = df.select("*", roll.alias("sev"), trig.alias("trig"))
    # Review-rating floor (critical first, then warning; never lowers)
    for floor, level in ((cfg.review_rating_critical, 3), (cfg.review_rating_warning, 2)):
        if floor is not None:
            mask = (F.col("metric") == "review_rating") & (F.col("value") < F.lit(floor))
            df = df.withColumn("trig", F.coalesce(F.col("trig"), F.when(mask, F.lit("absolute_threshold"))))
            df = df.withColumn("sev", escalate(F.col("sev"), mask, level))
    return df


def product_meta(master: DataFrame) -> DataFrame:
    """First row per product in master order (by day): tier, title, is_hero, category_bsr."""
    m = ensure_columns(master, (("tier", "string"), ("title", "string"), ("is_hero", "boolean"),
                                ("category_bsr", "double")))
    first = m.groupBy("asin").agg(F.min_by(F.struct("tier", "title", "is_hero", "category_bsr"), F.col("date")).alias("_m"))
    return first.select("asin", "_m.tier", "_m.title", "_m.is_hero", "_m.category_bsr")


def snapshot_detect(history: DataFrame, master: DataFrame | None, cfg: Config = DEFAULT) -> DataFrame:
    """Alerts on the snapshot metrics, in the alert schema plus ``is_hero``; J7 joins
    product metadata (unmatched keys keep NULL metadata)."""
    s = snapshot_scores(history, cfg).filter(F.col("sev").isNotNull())
    out = s.select("asin", "date", F.lit(False).alias("yoy_available"), "metric",
                   F.col("value").alias("actual_value"), F.col("roll_mean").alias("expected_value"),
                   F.lit(None).cast("double").alias("yoy_baseline"), "z_score",
                   F.lit(None).cast("double").alias("yoy_deviation"),
                   rank_label(F.col("sev")).alias("severity"), F.col("trig").alias("triggered_by"))
    if master is None:
        out = out.select("*", F.lit("less_than_single").alias("tier"), F.lit(None).cast("string").alias("title"),
                         F.lit(None).cast("boolean").alias("is_hero"), F.lit(None).cast("double").alias("category_bsr"))
    else:
        out = out.join(product_meta(master), "asin", "left")
    return out


def all_alerts(alerts: DataFrame, snapshot_alerts: DataFrame) -> DataFrame:
    """Outer union of the daily alerts and the snapshot alerts (missing columns NULL)."""
    return alerts.unionByName(snapshot_alerts, allowMissingColumns=True)
