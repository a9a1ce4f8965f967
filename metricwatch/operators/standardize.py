"""Feed standardisation: P1–P12, S11 rate rescale, A1 returns aggregate, W5 keep-last."""

from __future__ import annotations

from typing import Dict, Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import iso_day, key_normalize, mdy_date, try_double

# ---------------------------------------------------------------------------
# Export column names and the internal names they map to.
# ---------------------------------------------------------------------------
SALES_RENAME = {
    "Refund rate %": "return_rate",
    "Conversion": "conversion_rate",
    "Date": "date",
    "ASIN": "asin",
    "Sales": "sales",
    "Margin": "margin",
    "ACoS": "acos",
    "TACoS": "tacos",
    "Net profit": "net_profit",
    "Sessions": "sessions",
    "Orders": "orders",
    "Units": "units",
    "Refunds qty": "refund_qty",
    "Refunds $": "refund_amount",
    "Ad. cost": "ad_cost",
    "Title": "title",
}
SALES_NUMERIC = ("return_rate", "conversion_rate", "sales", "margin", "acos", "tacos", "net_profit",
                 "sessions", "orders", "units", "refund_qty", "refund_amount", "ad_cost")
# raw columns whose values may arrive as percent numbers instead of fractions
SALES_PCT_COLUMNS = ("Refund rate %", "Conversion", "Margin", "ACoS", "TACoS")

INVENTORY_KEEP = {
    "asin": "asin",
    "Total Units": "total_units",
    "available": "available_units",
    "Days of Supply at Amazon Fulfillment Network": "days_of_supply",
    "Alert": "inventory_alert",
    "Recommended replenishment qty": "recommended_replenishment_qty",
}
INVENTORY_TYPES = {"total_units": "double", "available_units": "double", "days_of_supply": "double",
                   "inventory_alert": "string", "recommended_replenishment_qty": "double"}

SNAPSHOT_KEEP = {
    "asin": "asin",
    "Category BSR": "category_bsr",
    "Subcategory BSR": "subcategory_bsr",
    "Keywords Average Rank": "keyword_avg_rank",
    "Keywords Average Rank Trend": "keyword_avg_rank_trend",
    "Organic Top 10": "organic_top10_count",
    "Organic Top 10 Search Volume": "organic_top10_search_volume",
    "Reviews Rating": "review_rating",
    "Review Count": "review_count",
}
SNAPSHOT_TYPES = {v: "double" for k, v in SNAPSHOT_KEEP.items() if v != "asin"}

ORDER_COLUMNS = ("_src_entry", "_src_depth", "_src_path", "_src_row")


def find_column(df: DataFrame, name: str, required: bool = True):
    """First column whose lower-case name equals ``name`` (driver-side schema lookup)."""
    for c in df.columns:
        if c.lower() == name:
            return c
    if required:
        raise KeyError(f"no '{name}' column among {df.columns}")
    return None


def named(c: str):
    """The column of exactly this name, which may hold dots."""
    return F.col("`" + c.replace("`", "``") + "`")


def load_order(df: DataFrame):
    """Load-order key: entry name and sub-entry name where the reader gives them, else folder depth and file path;
    then row inside the file."""
    return F.struct(*[F.col(c) for c in ORDER_COLUMNS if c in df.columns])


def normalize_pct(df: DataFrame, columns: Sequence[str] = SALES_PCT_COLUMNS, by: str = "_src_path") -> DataFrame:
    """Per file and column, divide the column by 100 when any |value| > 1.

    The per-file maxima are a grouped (partially pre-aggregated) table joined
    back on the file path; AQE turns the join into a broadcast at run time
    from the measured size, and splits a hot file on the big side if needed.
    """
    cols = [c for c in columns if c in df.columns]
    if not cols:
        return df
    mx = df.groupBy(by).agg(*[F.max(F.abs(try_double(named(c)))).alias(f"_mx{i}") for i, c in enumerate(cols)])
    j = df.join(mx, by, "left")
    out = []
    for c in df.columns:
        if c in cols:
            i = cols.index(c)
            scaled = try_double(named(c)) / F.lit(100.0)
            if dict(df.dtypes)[c] == "string":   # keep the column's type; text round-trips exactly
                scaled = scaled.cast("string")
            out.append(F.when(F.col(f"_mx{i}") > 1, scaled).otherwise(named(c)).alias(c))
        else:
            out.append(named(c))
    return j.select(*out)


def standardize_sales(raw: DataFrame) -> DataFrame:
    """Key normalise, strict MM-dd-yyyy date, rename, tolerant numeric coercion,
    drop rows without key or date.  Other raw columns are kept."""
    sel = []
    for c in raw.columns:
        new = SALES_RENAME.get(c, c)
        if new == "asin":
            e = F.when(named(c).isNotNull(), key_normalize(named(c)))
        elif new == "date":
            e = mdy_date(named(c))
        elif new in SALES_NUMERIC:
            e = try_double(named(c))
        else:
            e = named(c)
        sel.append(e.alias(new))
    df = raw.select(*sel)
    return df.dropna(subset=["asin", "date"])


def standardize_returns(raw: DataFrame, distinct_rows: bool = False) -> DataFrame:
    """P10 + A1: one row per (asin, day): summed quantity and the most frequent reason
    (NULLs ignored, ties -> smallest, all NULL -> NULL).

    Cumulative exports read together repeat rows, which the reference counts again;
    ``distinct_rows=True`` drops exact duplicate rows first (opt-in)."""
    if distinct_rows:
        raw = raw.drop(*[c for c in ORDER_COLUMNS if c in raw.columns]).distinct()
    key = find_column(raw, "asin")
    df = raw.select(key_normalize(F.col(key)).alias("asin"), iso_day(F.col("return-date")).alias("date"),
                    try_double(F.col("quantity")).try_cast("long").alias("quantity"), F.col("reason").cast("string").alias("reason"))
    df = df.dropna(subset=["asin", "date"])
    return returns_agg(df)


def returns_agg(df: DataFrame) -> DataFrame:
    """A1 as one partially aggregated groupBy: ``mode`` keeps a per-group map of reason
    counts that is combined map-side, so a hot (asin, day) does not reach one task whole."""
    return df.groupBy("asin", "date").agg(
        F.coalesce(F.sum("quantity"), F.lit(0)).cast("long").alias("return_count"),
        F.mode("reason", deterministic=True).alias("top_return_reason"),
    )


def keep_last(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The last row per key in load order, as one aggregate (``max_by`` on the
    load-order struct) — partial aggregation, no window over a hot key."""
    order = load_order(df)
    cols = [c for c in df.columns if c not in keys]
    if not cols:
        return df.dropDuplicates(list(keys))
    agg = df.groupBy(*keys).agg(F.max_by(F.struct(*cols), order).alias("_last"))
    return agg.select(*keys, *[F.col("_last")[c].alias(c) for c in cols])


def tolerant(raw: DataFrame, keep: Dict[str, str], types: Dict[str, str], key_col: str) -> DataFrame:
    sel = [key_normalize(F.col(key_col)).alias("asin")]
    for src, dst in keep.items():
        if dst == "asin":
            continue
        t = types[dst]
        if src in raw.columns:
            e = F.col(src).cast("string") if t == "string" else try_double(F.col(src))
        else:
            e = F.lit(None)
        sel.append(e.cast(t).alias(dst))
    sel += [F.col(c) for c in ORDER_COLUMNS if c in raw.columns]
    return raw.select(*sel)


def standardize_inventory(raw: DataFrame) -> DataFrame:
    """Needs an exact ``asin`` column; tolerant projection; keep last per asin."""
    if "asin" not in raw.columns:
        raise KeyError("inventory feed needs an 'asin' column")
    df = tolerant(raw, INVENTORY_KEEP, INVENTORY_TYPES, "asin")
    return keep_last(df, ["asin"]).drop(*ORDER_COLUMNS)


def standardize_snapshot(raw: DataFrame) -> DataFrame:
    """Case-insensitive key column; tolerant projection; keep last per asin."""
    df = tolerant(raw, SNAPSHOT_KEEP, SNAPSHOT_TYPES, find_column(raw, "asin"))
    return keep_last(df, ["asin"]).drop(*ORDER_COLUMNS)


def source_stats(df: DataFrame, name: str) -> DataFrame:
    """Rows, distinct keys, first and last day of a feed."""
    aggs = [F.count(F.lit(1)).alias("n_rows"), F.countDistinct("asin").alias("n_asins")]
    if "date" in df.columns:
        aggs += [F.min("date").alias("min_date"), F.max("date").alias("max_date")]
    else:
        aggs += [F.lit(None).cast("date").alias("min_date"), F.lit(None).cast("date").alias("max_date")]
    return df.agg(*aggs).select(F.lit(name).alias("source"), "*")
