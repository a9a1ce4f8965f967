"""Master table: J1–J5 joins, A2–A5 revenue tiers."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import DEFAULT, Config


def merge_sources(sales: DataFrame, returns: DataFrame | None = None, inventory: DataFrame | None = None,
                  snapshot: DataFrame | None = None) -> DataFrame:
    """Sales ⟕ returns on (asin, date) ⟕ inventory on asin ⟕ listing snapshot on asin.

    The snapshot feeds hold one row per product; Catalyst/AQE pick broadcast
    from their measured size instead of a forced hint, so the plan stays valid
    when the catalogue grows past the broadcast threshold.
    """
    m = sales
    if returns is not None:
        m = m.join(returns, ["asin", "date"], "left")
    if inventory is not None:
        m = m.join(inventory, ["asin"], "left")
    if snapshot is not None:
        m = m.join(snapshot.drop("date") if "date" in snapshot.columns else snapshot, ["asin"], "left")
    return m


def money_sum(c):
    """Sum of money amounts in 1e-4 fixed point: exact, so independent of the order in
    which partitions are combined."""
    return F.sum(F.round(c * 10000).cast("long")) / F.lit(10000.0)


def trailing_revenue(df: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """A2: per product, sum of sales on days >= (newest day of the table) − 12 months.

    The newest day is a scalar subquery; all-NULL sums count as 0."""
    cutoff = F.add_months(df.agg(F.max("date")).scalar(), -cfg.trailing_months)
    return (df.filter(F.col("date") >= cutoff).groupBy("asin")
            .agg(F.coalesce(money_sum(F.col("sales")), F.lit(0.0)).alias("trailing_12m_revenue")))


def tier_of(revenue, cfg: Config = DEFAULT):
    """``>=`` cut-offs, best tier first; NULL revenue -> less_than_single."""
    e = None
    for name, cut in cfg.tier_thresholds:
        cond = revenue >= F.lit(cut)
        e = F.when(cond, F.lit(name)) if e is None else e.when(cond, F.lit(name))
    return e.otherwise(F.lit("less_than_single"))


def assign_tiers(df: DataFrame, cfg: Config = DEFAULT, newest=None) -> DataFrame:
    """A3: trailing revenue, tier and ``is_hero`` on every row of the product.

    Computed as a window over ``asin`` (no join back), which shares its hash
    exchange with the detection windows downstream.  ``newest`` (a Column, e.g.
    a scalar subquery over a cheaper source) is the table's newest day; by
    default it is ``max(date)`` of ``df`` itself."""
    newest = newest if newest is not None else df.agg(F.max("date")).scalar()
    cutoff = F.add_months(newest, -cfg.trailing_months)
    wp = Window.partitionBy("asin")
    recent = F.when(F.col("date") >= cutoff, F.round(F.coalesce(F.col("sales"), F.lit(0.0)) * 10000).cast("long"))
    rev = F.sum(recent).over(wp) / F.lit(10000.0)
    drop = [c for c in ("tier", "trailing_12m_revenue", "is_hero") if c in df.columns]
    out = df.drop(*drop).withColumn("trailing_12m_revenue", rev)
    return out.select("*", tier_of(F.col("trailing_12m_revenue"), cfg).alias("tier"),
                      F.coalesce(F.col("trailing_12m_revenue") >= F.lit(cfg.hero_revenue), F.lit(False)).alias("is_hero"))


def tier_counts(master: DataFrame) -> DataFrame:
    """A5: products per tier and hero products per tier."""
    per = master.groupBy("asin").agg(F.first("tier").alias("tier"), F.max(F.col("is_hero").cast("int")).alias("hero"))
    return per.groupBy("tier").agg(F.count(F.lit(1)).alias("n_asins"), F.coalesce(F.sum("hero"), F.lit(0)).alias("n_hero"))
