"""The per-product windows cut into time chunks (W1–W4, A4, J6), for products with a very long history.

The plain windows put a product's whole history in one task. Here a task holds one (product, chunk of ``chunk_days``):

* *Rolling frames* count rows, so a chunk needs the rows just before it. Each (product, chunk) gives its last
  ``rolling_window`` − 1 rows; a window over this small table joins the ends of at most as many chunks before, which is
  enough, as every chunk in it has a row. They enter the chunk as halo rows and leave it after the windows.
* *Zero runs* are a prefix scan: a chunk is summarised by its number of rows and the place of its last row with units,
  and these combine by addition and maximum. A row's run starts after the last such row in its chunk or before it.
* *Year-over-year weeks* look back 362 to 369 days: a row is copied to the chunks that may look at it, one or two
  of a year each.
* *Span*: first and last day per product from the same table.

Results equal those of ``baselines`` digit by digit: frames hold the same rows in the same order.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import DEFAULT, Config
from ..functions.exprs import nan_to_null
from .baselines import with_rolling, with_yoy_deviation, with_yoy_window
from .detect import OPTIONAL_INPUTS, ensure_columns, present_metrics

CHUNK_DAYS = 366


def _day(order: str) -> Column:
    return F.datediff(F.col(order), F.lit("1970-01-01"))


def _chunk(day: Column, days: int) -> Column:
    return F.floor(day / days).cast("long")


def with_yoy_chunked(df: DataFrame, metrics: Sequence[str], cfg: Config, key: str = "asin", order: str = "date",
                     chunk_days: int = CHUNK_DAYS) -> DataFrame:
    """``<m>_yoy_mean`` of ``with_yoy_window``; ``df`` has ``yoy_available`` and ``_chunk``."""
    half = cfg.yoy_window // 2
    seen_from = [_chunk(_day(order) + back, chunk_days) for back in (365 - half, 366 + half)]
    rows = df.withColumn("_own", F.col("_chunk")).withColumn(
        "_chunk", F.explode(F.array_union(F.array("_chunk"), F.sequence(*seen_from))))
    halo = F.col("_chunk") != F.col("_own")
    kept = [key, order, "_chunk", "_own", "yoy_available", *metrics]
    # a halo row is only looked at: its other columns stay behind
    rows = rows.select(*[F.col(c) if c in kept else F.when(~halo, F.col(c)).alias(c) for c in rows.columns])
    out = with_yoy_window(rows, metrics, cfg, [key, "_chunk"], order)
    return out.filter("_chunk = _own").drop("_own")


def chunk_table(df: DataFrame, n_tail: int, metrics: Sequence[str], key: str, order: str, units: str) -> DataFrame:
    """Per (product, chunk): rows before it (``_before``), the place of the last row with units before it
    (``_last_before``), the product's span (``_span``) and the last rows before it (``_halo``)."""
    in_chunk = Window.partitionBy(key, "_chunk")
    place = df.select(key, "_chunk", order, units, *metrics).withColumn(
        "_rn", F.row_number().over(in_chunk.orderBy(_day(order)))).withColumn("_n", F.count("*").over(in_chunk))
    zero = F.coalesce(F.col(units), F.lit(0.0)) == 0
    row = F.struct(order, *metrics)
    summary = place.groupBy(key, "_chunk").agg(
        F.max("_n").alias("_n"), F.max(F.when(~zero, F.col("_rn"))).alias("_last"), F.min(order).alias("_lo"),
        F.max(order).alias("_hi"), F.array_sort(F.collect_list(F.when(F.col("_rn") > F.col("_n") - n_tail, row))).alias("_tail"))
    w = Window.partitionBy(key).orderBy("_chunk")
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(key)
    t = summary.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    t = t.withColumn("_last_before", F.coalesce(F.max(F.col("_before") + F.col("_last")).over(before), F.lit(0)))
    ends = F.flatten(F.collect_list("_tail").over(w.rowsBetween(-max(n_tail, 1), -1)))
    t = t.withColumn("_halo", F.slice(ends, F.greatest(F.size(ends) - n_tail + 1, F.lit(1)), max(n_tail, 1)))
    span = F.datediff(F.max("_hi").over(whole), F.min("_lo").over(whole))
    return t.select(key, "_chunk", "_before", "_last_before", span.alias("_span"), "_halo")


def chunked_baselines(master: DataFrame, cfg: Config = DEFAULT, metrics: Sequence[str] | None = None, key: str = "asin",
                      order: str = "date", units: str = "units", chunk_days: int = CHUNK_DAYS) -> DataFrame:
    """The columns of ``detect.baselines``, with one task per product and chunk in place of one per product."""
    metrics = list(metrics or present_metrics(master))
    df = ensure_columns(master, OPTIONAL_INPUTS)
    df = df.withColumns({c: nan_to_null(F.col(c).cast("double")) for c in [*metrics, units, "available_units"]})
    columns, df = df.columns, df.withColumn("_chunk", _chunk(_day(order), chunk_days))
    n_tail = cfg.rolling_window if cfg.exclude_current else cfg.rolling_window - 1
    table = chunk_table(df, n_tail, metrics, key, order, units)
    halo = table.select(key, "_chunk", F.inline("_halo")).withColumn("_is_halo", F.lit(True))
    rows = df.join(table.drop("_halo"), [key, "_chunk"]).withColumn("_is_halo", F.lit(False))
    df = with_rolling(rows.unionByName(halo, allowMissingColumns=True), metrics, cfg, [key, "_chunk"], order).filter("not _is_halo")
    w = Window.partitionBy(key, "_chunk").orderBy(_day(order))
    zero = F.coalesce(F.col(units), F.lit(0.0)) == 0
    df = df.withColumn("_rn", F.row_number().over(w))
    own = F.max(F.when(~zero, F.col("_rn"))).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    at = F.col("_before") + F.col("_rn")
    run = F.when(zero, at - F.greatest(F.col("_last_before"), F.coalesce(F.col("_before") + own, F.lit(0)))).otherwise(F.lit(0))
    df = df.withColumn("zero_run", run.cast("int")).withColumn("yoy_available", F.col("_span") >= F.lit(cfg.min_history_days))
    df = df.drop("_rn", "_before", "_last_before", "_span", "_is_halo")
    df = with_yoy_chunked(df, metrics, cfg, key, order, chunk_days).drop("_chunk")
    df = with_yoy_deviation(df, metrics, cfg)
    return df.select(*columns, *[c for c in df.columns if c not in columns])
