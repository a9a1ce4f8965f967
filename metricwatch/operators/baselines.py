"""Rolling baseline (W1–W3), zero-unit runs (W4), history span (A4) and the
year-over-year baseline (J6/D2).

All per-product windows share one partitioning (``asin``) and one ordering
(``date``), so Catalyst plans a single hash exchange for all of them.  A
product's group is bounded by its number of days: after de-duplication
(asin, date) is unique, so even the hottest key holds at most one row per
calendar day of history.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import Config
from ..functions.exprs import round_score, safe_div


def _frame(cfg: Config, key: str, order: str):
    w = Window.partitionBy(key).orderBy(F.datediff(F.col(order), F.lit("1970-01-01")))
    if cfg.exclude_current:
        return w.rowsBetween(-cfg.rolling_window, -1)
    return w.rowsBetween(-(cfg.rolling_window - 1), Window.currentRow)


def rolling_columns(metrics: Sequence[str], cfg: Config, key: str = "asin", order: str = "date"):
    """Rolling mean / sample std over the last N *rows* (nulls take a slot but are not
    counted), NULL unless at least ``rolling_min_periods`` non-null values."""
    w = _frame(cfg, key, order)
    out = []
    for m in metrics:
        ok = F.count(m).over(w) >= F.lit(cfg.rolling_min_periods)
        out.append(F.round(F.when(ok, F.avg(m).over(w)), cfg.digits(m)).alias(f"{m}_roll_mean"))
        out.append(F.round(F.when(ok, F.stddev_samp(m).over(w)), cfg.std_digits(m)).alias(f"{m}_roll_std"))
    return out


def with_rolling(df: DataFrame, metrics: Sequence[str], cfg: Config, key: str = "asin",
                 order: str = "date") -> DataFrame:
    """Adds ``<m>_roll_mean``, ``<m>_roll_std``, ``<m>_roll_zscore`` (z rounded to
    ``cfg.score_digits``; std 0 -> z NULL)."""
    df = df.select("*", *rolling_columns(metrics, cfg, key, order))
    return df.select("*", *[
        round_score(safe_div(F.col(m) - F.col(f"{m}_roll_mean"), F.col(f"{m}_roll_std")), cfg.score_digits)
        .alias(f"{m}_roll_zscore") for m in metrics])


def with_history_span(df: DataFrame, cfg: Config, key: str = "asin", order: str = "date") -> DataFrame:
    """``yoy_available``: the product's whole span (max - min day) is at least a year."""
    wp = Window.partitionBy(key)
    span = F.datediff(F.max(order).over(wp), F.min(order).over(wp))
    return df.withColumn("yoy_available", span >= F.lit(cfg.min_history_days))


def with_zero_run(df: DataFrame, key: str = "asin", order: str = "date", units: str = "units") -> DataFrame:
    """``zero_run``: length of the current run of successive zero-unit *rows* (0 on other rows).

    Gaps and islands with two windows on the same partitioning: the row number
    minus the row number of the last non-zero row so far.
    """
    w = Window.partitionBy(key).orderBy(F.datediff(F.col(order), F.lit("1970-01-01")))
    running = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    is_zero = F.coalesce(F.col(units), F.lit(0.0)) == 0
    df = df.withColumn("_rn", F.row_number().over(w))
    last_nz = F.max(F.when(~is_zero, F.col("_rn"))).over(running)
    return (df.withColumn("zero_run", F.when(is_zero, F.col("_rn") - F.coalesce(last_nz, F.lit(0))).otherwise(F.lit(0)))
            .drop("_rn"))


def yoy_means(df: DataFrame, metrics: Sequence[str], cfg: Config, key: str = "asin",
              order: str = "date") -> DataFrame:
    """Mean of each metric over the ``yoy_window`` calendar days centred on every day.

    Each history row is replicated to the 2·(w//2)+1 centres it belongs to
    (``explode(sequence)``), then a partial (map-side) aggregation folds the
    copies back to one row per (key, centre).  No range or cross join.
    """
    half = cfg.yoy_window // 2
    hist = df.select(key, order, *metrics).select(
        key, F.explode(F.sequence(F.lit(-half), F.lit(half))).alias("_j"), order, *metrics)
    return hist.groupBy(key, F.date_add(F.col(order), F.col("_j")).alias("_yoy_center")).agg(
        *[F.round(F.avg(m), cfg.digits(m)).alias(f"{m}_yoy_mean") for m in metrics])


def with_yoy_window(df: DataFrame, metrics: Sequence[str], cfg: Config, key: str | Sequence[str] = "asin",
                    order: str = "date") -> DataFrame:
    """``<m>_yoy_mean`` from RANGE windows on the same (asin ↑day) partitioning as the rolling windows: no join and no
    extra shuffle.

    One calendar year back is 365 or 366 days (``add_months(date, -12)``; 29 Feb maps to 28 Feb). Sums and counts are
    taken over both weeks, [day − 365 ± w//2] and [day − 366 ± w//2], and each row picks the one its calendar names. Days
    are unique per product, so a frame holds at most a week of rows, which are added up in day order.
    """
    if "yoy_available" not in df.columns:
        df = with_history_span(df, cfg, key, order)
    half = cfg.yoy_window // 2
    w = Window.partitionBy(key).orderBy(F.datediff(F.col(order), F.lit("1970-01-01")))
    frames = [w.rangeBetween(-(back + half), -(back - half)) for back in (365, 366)]
    df = df.select("*", *[f(m).over(frame).alias(f"_{f.__name__}{i}_{m}") for m in metrics
                          for i, frame in enumerate(frames) for f in (F.sum, F.count)])
    usual = F.datediff(F.col(order), F.add_months(F.col(order), -12)) == 365
    mean = {m: [F.try_divide(F.col(f"_sum{i}_{m}"), F.col(f"_count{i}_{m}")) for i in (0, 1)] for m in metrics}
    return df.select(*[c for c in df.columns if not c.startswith(("_sum0_", "_sum1_", "_count0_", "_count1_"))], *[
        F.when(F.col("yoy_available"), F.round(F.when(usual, a).otherwise(b), cfg.digits(m))).alias(f"{m}_yoy_mean")
        for m, (a, b) in mean.items()])


def with_yoy(df: DataFrame, metrics: Sequence[str], cfg: Config, key: str = "asin",
             order: str = "date", history: DataFrame | None = None) -> DataFrame:
    """Adds ``<m>_yoy_mean``: the same week one *calendar* year earlier
    (``add_months(date, -12)``, so 29 Feb looks at 28 Feb), NULL when the
    product's span is below a year or no value exists in that week.

    ``history`` is the frame the baseline is taken from (default ``df``).
    """
    if "yoy_available" not in df.columns:
        df = with_history_span(df, cfg, key, order)
    means = yoy_means(history if history is not None else df, metrics, cfg, key, order)
    left = df.withColumn("_yoy_center", F.add_months(F.col(order), -12))
    j = left.join(means, [key, "_yoy_center"], "left")
    keep = [c for c in left.columns if c != "_yoy_center"]
    return j.select(*keep, *[F.when(F.col("yoy_available"), F.col(f"{m}_yoy_mean")).alias(f"{m}_yoy_mean")
                             for m in metrics])


def with_yoy_deviation(df: DataFrame, metrics: Sequence[str], cfg: Config) -> DataFrame:
    """``<m>_yoy_deviation`` = (x - yoy) / |yoy|, NULL when yoy is 0 or NULL."""
    return df.select("*", *[
        round_score(safe_div(F.col(m) - F.col(f"{m}_yoy_mean"), F.abs(F.col(f"{m}_yoy_mean"))), cfg.score_digits)
        .alias(f"{m}_yoy_deviation") for m in metrics])
