"""Look-back reports over the full-history alerts.

All reports read one alert DataFrame (cache or checkpoint it once when
several are materialised).  Pivots use explicit value lists, so the plan is
fixed and no distinct-values job runs first.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import DEFAULT, TIER_ORDER, Config
from .distinct import day_number

SEV = ("critical", "warning", "watch")


def lookback(alerts: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """Alerts on or after (newest alert day − lookback days)."""
    newest = alerts.agg(F.max("date")).scalar()
    return alerts.filter(F.col("date") >= F.date_sub(newest, cfg.lookback_days))


REPORT_DIMS = ("metric", "triggered_by", "tier")


def counts(alerts: DataFrame, dims: Sequence[str] = ()) -> DataFrame:
    """Alert counts per (day, dims, severity): the reports' shared pre-aggregate.

    It is small (one row per day and dimension value) and partially aggregated
    before its shuffle; every report filters and folds it further.  ``alerts``
    may itself be such a count table (column ``n``, e.g. ``report_counts``
    materialised once with ``checkpoint()``); it is then re-folded."""
    if "n" in alerts.columns:
        return alerts.groupBy("date", *dims, "severity").agg(F.sum("n").alias("n"))
    return alerts.groupBy("date", *dims, "severity").agg(F.count(F.lit(1)).alias("n"))


def report_counts(alerts: DataFrame) -> DataFrame:
    """The finest pre-aggregate all reports but A16 fold: per (day, metric, trigger, tier,
    severity) — at most a few hundred rows per day, whatever the alert volume."""
    return counts(alerts, REPORT_DIMS)


def recent(pre: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """The look-back slice of a pre-aggregate.  The newest day is taken from the same
    pre-aggregate, so the scalar subquery and the report share one exchange (and
    detection runs once)."""
    newest = pre.agg(F.max("date")).scalar()
    return pre.filter(F.col("date") >= F.date_sub(newest, cfg.lookback_days))


def _pivot(pre: DataFrame, by: str) -> DataFrame:
    """Counts per severity (0-filled) and their total; rows whose alerts are all
    improvements stay, with zeros."""
    p = pre.groupBy(by).agg(*[F.sum(F.when(F.col("severity") == s, F.col("n")).otherwise(F.lit(0))).alias(s)
                              for s in SEV])
    return p.withColumn("total", sum(F.col(s) for s in SEV))


def daily(alerts: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """A10: date × severity counts over the look-back."""
    return _pivot(recent(counts(alerts), cfg), "date")


def daily_stats(alerts: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """Averages of the daily pivot and the maxima of criticals and total."""
    d = daily(alerts, cfg)
    return d.agg(*[F.avg(s).alias(f"avg_{s}") for s in SEV + ("total",)],
                 F.max("critical").alias("max_critical"), F.max("total").alias("max_total"))


def verdict(alerts: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """Volume verdict on the average criticals per day."""
    s = daily_stats(alerts, cfg)
    v = (F.when(F.col("avg_critical") > 20, F.lit("too_loose"))
         .when(F.col("avg_critical") > 10, F.lit("borderline")).otherwise(F.lit("ok")))
    return s.select("avg_critical", v.alias("verdict"))


def by_metric(alerts: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """Metric × severity counts (sort by total desc for display)."""
    return _pivot(recent(counts(alerts, ["metric"]), cfg), "metric")


def by_trigger(alerts: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """triggered_by × severity counts."""
    return _pivot(recent(counts(alerts, ["triggered_by"]), cfg), "triggered_by")


def by_tier(alerts: DataFrame, tiers: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """Criticals per tier, all five tiers 0-filled, with the share of all criticals.

    ``tiers`` is the fixed five-row tier list; the grouped side holds at most
    one row per tier value, and the total is a scalar subquery."""
    crit = (recent(counts(alerts, ["tier"]), cfg).filter(F.col("severity") == "critical")
            .groupBy("tier").agg(F.sum("n").alias("n")))
    j = tiers.join(crit, "tier", "left").select("tier", F.coalesce(F.col("n"), F.lit(0)).alias("critical_count"))
    total = crit.filter(F.col("tier").isin(*TIER_ORDER)).agg(F.sum("n")).scalar()
    return j.select("tier", "critical_count",
                    F.coalesce(F.try_divide(F.col("critical_count") * F.lit(100.0), total.cast("double")),
                               F.lit(0.0)).alias("pct"))


def noisiest(alerts: DataFrame, cfg: Config = DEFAULT, n: int = 10) -> DataFrame:
    """Top-n products by criticals (NULL tier dropped); ties broken by asin."""
    c = (recent(counts(alerts, ["asin", "tier"]), cfg)
         .filter((F.col("severity") == "critical") & F.col("tier").isNotNull())
         .groupBy("asin", "tier").agg(F.sum("n").alias("critical_count")))
    return c.orderBy(F.col("critical_count").desc(), F.col("asin")).limit(n)


def floor_audit(alerts: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """Return-rate alerts: total, from the absolute floor, from the rest (improvements
    count as rest), shares, and the severity split of the floor ones."""
    rr = recent(counts(alerts, ["metric", "triggered_by"]), cfg).filter(F.col("metric") == "return_rate")
    absolute = F.coalesce(F.col("triggered_by") == "absolute_threshold", F.lit(False))
    n = F.col("n")
    a = rr.agg(F.coalesce(F.sum(n), F.lit(0)).alias("total"),
               F.coalesce(F.sum(F.when(absolute, n)), F.lit(0)).alias("by_floor"),
               F.coalesce(F.sum(F.when(~absolute, n)), F.lit(0)).alias("by_stats"),
               *[F.coalesce(F.sum(F.when(absolute & (F.col("severity") == s), n)), F.lit(0)).alias(f"floor_{s}")
                 for s in SEV])
    return a.select("*",
                    F.when(F.col("total") > 0, F.col("by_floor") * 100.0 / F.col("total")).alias("pct_floor"),
                    F.when(F.col("total") > 0, F.col("by_stats") * 100.0 / F.col("total")).alias("pct_stats"))


def date_range(alerts: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """first/last alert day, days with alerts overall and in the look-back.

    Days are counted by bitmaps of their numbers, of which all days of 90 years make one or two."""
    pre = counts(alerts)
    newest = pre.agg(F.max("date")).scalar()
    recent_day = F.col("date") >= F.date_sub(newest, cfg.lookback_days)
    day = day_number(F.col("date"))
    place = F.bitmap_bit_position(day)
    parts = pre.groupBy(F.bitmap_bucket_number(day).alias("_bucket")).agg(
        F.min("date").alias("first_date"), F.max("date").alias("last_date"),
        F.bitmap_count(F.bitmap_construct_agg(place)).alias("n_days"),
        F.bitmap_count(F.bitmap_construct_agg(F.when(recent_day, place))).alias("n_days_lookback"),
        F.sum("n").alias("n_alerts"), F.sum(F.when(recent_day, F.col("n"))).alias("n_alerts_lookback"))
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).alias(c)
    return parts.agg(F.min("first_date").alias("first_date"), F.max("last_date").alias("last_date"), total("n_days"),
                     total("n_days_lookback"), F.sum("n_alerts").alias("n_alerts"), total("n_alerts_lookback"))


def tier_table(spark) -> DataFrame:
    """The five tiers in display order (fixed, five rows)."""
    return spark.createDataFrame([(t, i) for i, t in enumerate(TIER_ORDER)], "tier string, tier_rank int")
