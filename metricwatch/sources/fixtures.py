"""Feeds derived from the driver's TPC-H-ish parquet tables (FIXTURES.md §3).

The driver tables stand in for the four seller exports: ``lineitem ⋈ part``
becomes a product(brand) × day sales feed, returned line items become the
returns feed, ``part`` becomes the inventory snapshot and ``events`` becomes
the listing-snapshot history.  Every derivation is a plain DataFrame plan
over the whole tables, so the work grows with the scale factor.

Money is carried as exact integers (cents, or 1e-4 dollars for products of
two cent amounts) until the final ratio, so sums do not depend on the order
in which partitions are combined.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values of the fixture derivation.
# ---------------------------------------------------------------------------
SNAPSHOT_KEYS = 25          # events.user_id % 25 -> 'BRAND#1' .. 'BRAND#25' (the brand keys)
NULL_EVERY = 11             # one snapshot metric NULL on every 11th key-day
JUNK_EVERY = 97             # every 97th sales row carries a junk number
REPEAT_DAYS = 7             # days 1..7 of each month are re-exported
LOW_STOCK_EVERY = 5         # brand number % 5 == 0 -> out of stock
SNAPSHOT_EPOCH = "2024-01-01"
SALES_EPOCH = "1995-01-01"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _cents(c: str):
    return F.round(F.col(c) * 100).cast("long")


def brand_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product(brand) × ship-day sales with the six detection metrics."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_partkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_shipdate")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_retailprice")
    j = li.join(part, li.l_partkey == part.p_partkey)  # size-based strategy left to AQE
    ext, disc, tax, retail = _cents("l_extendedprice"), _cents("l_discount"), _cents("l_tax"), _cents("p_retailprice")
    qty = F.round(F.col("l_quantity")).cast("long")
    g = j.groupBy(F.upper("p_brand").alias("asin"), F.to_date("l_shipdate").alias("date")).agg(
        F.sum(ext * (F.lit(100) - disc)).alias("_net4"),          # 1e-4 dollars
        F.sum(qty * retail * F.lit(100)).alias("_cost4"),
        F.sum(ext * tax).alias("_ad4"),
        F.sum(ext).alias("_gross2"),                              # cents
        F.sum(qty).alias("_qty"),
        F.sum(F.when(F.col("l_returnflag") == "R", qty).otherwise(F.lit(0))).alias("_qty_r"),
        F.count(F.lit(1)).alias("orders"),
    )
    net = F.col("_net4").cast("double")
    return g.select(
        "asin", "date",
        (net / F.lit(10000.0)).alias("sales"),
        F.col("_qty").cast("double").alias("units"),
        F.col("orders").cast("double").alias("orders"),
        F.try_divide(F.col("_qty_r").cast("double"), F.col("_qty").cast("double")).alias("return_rate"),
        F.try_divide(F.col("orders").cast("double"), F.col("_qty").cast("double")).alias("conversion_rate"),
        F.try_divide((F.col("_net4") - F.col("_cost4")).cast("double"), net).alias("margin"),
        F.try_divide(F.col("_ad4").cast("double"), net).alias("acos"),
        F.try_divide(F.col("_ad4").cast("double"), (F.col("_gross2") * F.lit(100)).cast("double")).alias("tacos"),
    )


def ship_day_bounds(spark: SparkSession, sf_dir: str):
    """(first, last) ship day of ``lineitem`` as columns of one scalar subquery (a one-column scan)."""
    li = table(spark, sf_dir, "lineitem").select(F.to_date("l_shipdate").alias("d"))
    b = li.agg(F.struct(F.min("d").alias("lo"), F.max("d").alias("hi"))).scalar()
    return b.getField("lo"), b.getField("hi")


def catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The product keys of the catalogue (``part`` brands)."""
    return table(spark, sf_dir, "part").select(F.upper("p_brand").alias("asin")).distinct()


def brand_daily_dense(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every catalogue product on every calendar day of the ship-date range; missing days
    sell 0, rates stay NULL.

    The calendar is generated per product with ``sequence`` (a Generate node) from a
    scalar subquery, not by a cross join or a driver round trip.
    """
    bd = brand_daily(spark, sf_dir)
    lo, hi = ship_day_bounds(spark, sf_dir)
    days = catalogue(spark, sf_dir).select("asin", F.explode(F.sequence(lo, hi)).alias("date"))
    out = days.join(bd, ["asin", "date"], "left")
    return out.select(
        "asin", "date",
        F.coalesce("sales", F.lit(0.0)).alias("sales"),
        F.coalesce("units", F.lit(0.0)).alias("units"),
        "orders", "return_rate", "conversion_rate", "margin", "acos", "tacos",
    )


def _brand_no(c):
    return F.regexp_extract(c, r"(\d+)$", 1).cast("int")


def returns_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per returned line item, as the export would deliver it (mixed-case key column)."""
    li = table(spark, sf_dir, "lineitem").select("l_partkey", "l_quantity", "l_returnflag", "l_shipdate")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_type")
    j = li.filter(F.col("l_returnflag") == "R").join(part, li.l_partkey == part.p_partkey)
    return j.select(
        F.concat(F.lit(" "), F.lower("p_brand")).alias("Asin"),
        F.date_format("l_shipdate", "yyyy-MM-dd'T'HH:mm:ss").alias("return-date"),
        F.round("l_quantity").cast("long").alias("quantity"),
        F.col("p_type").alias("reason"),
    )


def inventory_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Inventory export: two rows per brand (a stale one first), keep-last must pick the second."""
    part = table(spark, sf_dir, "part").select("p_brand", "p_size")
    g = part.groupBy(F.lower("p_brand").alias("asin")).agg(
        F.sum("p_size").cast("double").alias("total"), F.count(F.lit(1)).alias("n"), F.max("p_size").alias("mx"))
    avail = F.when(_brand_no("asin") % LOW_STOCK_EVERY == 0, F.lit(0.0)).otherwise(F.col("total"))
    rows = g.select("asin", "total", "n", "mx", avail.alias("avail"),
                    F.explode(F.array(F.lit(0), F.lit(1))).alias("_src_row"))
    latest = F.col("_src_row") == 1
    return rows.select(
        "asin",
        F.col("total").alias("Total Units"),
        F.when(latest, F.col("avail")).otherwise(F.col("total") + 1).alias("available"),
        F.col("n").cast("double").alias("Days of Supply at Amazon Fulfillment Network"),
        F.when(F.col("avail") == 0, F.lit("out_of_stock")).alias("Alert"),
        F.col("mx").cast("double").alias("Recommended replenishment qty"),
        F.lit("inventory/Restock Inventory.csv").alias("_src_path"),
        F.col("_src_row").cast("long").alias("_src_row"),
    )


def snapshot_hist(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listing snapshots per key and day from ``events``."""
    ev = table(spark, sf_dir, "events").select("ts", "user_id", "value")
    k = (F.col("user_id") % SNAPSHOT_KEYS).cast("int")
    cents = _cents("value")
    clamped = F.least(F.greatest(cents, F.lit(0)), F.lit(5000))   # value/50 clamped to [0, 1], in 1/5000
    g = ev.groupBy(k.alias("_k"), F.to_date("ts").alias("date")).agg(
        F.sum(cents).alias("_cents"), F.sum(clamped).alias("_clamped"), F.count(F.lit(1)).alias("_n"),
        F.countDistinct("user_id").cast("double").alias("organic_top10_count"),
    ).select(
        "_k", "date",
        (F.col("_cents").cast("double") / (F.col("_n") * 100).cast("double")).alias("keyword_avg_rank"),
        (F.lit(1.0) + F.lit(4.0) * (F.col("_clamped").cast("double") / (F.col("_n") * 5000).cast("double"))).alias("review_rating"),
        F.col("_n").cast("double").alias("review_count"),
        "organic_top10_count",
    )
    n = F.datediff("date", F.lit(SNAPSHOT_EPOCH)) * SNAPSHOT_KEYS + F.col("_k")
    hole = F.when(n % NULL_EVERY == 0, F.floor(n / NULL_EVERY) % 4)
    cols = ["keyword_avg_rank", "review_rating", "review_count", "organic_top10_count"]
    return g.select(
        F.concat(F.lit("BRAND#"), (F.col("_k") + 1).cast("string")).alias("asin"),
        "date",
        *[F.when(hole.isNull() | (hole != i), F.col(c)).alias(c) for i, c in enumerate(cols)],
        (F.lit(1000.0) * (F.col("_k") + 1)).alias("category_bsr"),
    )


def listing_snap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Today's listing snapshot: the history at its newest date."""
    h = snapshot_hist(spark, sf_dir)
    newest = h.agg(F.max("date")).scalar()
    return h.filter(F.col("date") == newest).drop("date")


def listing_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Today's listing snapshot as exported (raw column names, lower-case key column ``ASIN``)."""
    s = listing_snap(spark, sf_dir)
    return s.select(
        F.lower("asin").alias("ASIN"),
        F.col("category_bsr").alias("Category BSR"),
        (F.col("category_bsr") / 10).alias("Subcategory BSR"),
        F.col("keyword_avg_rank").alias("Keywords Average Rank"),
        F.lit(None).cast("double").alias("Keywords Average Rank Trend"),
        F.col("organic_top10_count").alias("Organic Top 10"),
        (F.col("organic_top10_count") * 100).alias("Organic Top 10 Search Volume"),
        F.col("review_rating").alias("Reviews Rating"),
        F.col("review_count").alias("Review Count"),
        F.lit("helium10/listing.csv").alias("_src_path"),
        F.lit(0).cast("long").alias("_src_row"),
    )


RATE_RAW = {"return_rate": "Refund rate %", "conversion_rate": "Conversion", "margin": "Margin",
            "acos": "ACoS", "tacos": "TACoS"}


def sales_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """brand_daily as the seller export would deliver it: text columns, one file per year.

    * key padded and lower-cased, date as ``MM-dd-yyyy`` text
    * the five rate columns in percent form (×100) in even years
    * every 97th row carries a junk sales number
    * days 1..7 of every month are exported a second time in a later file
      (``<year>_update.csv``) with sales + 1, so keep-last must pick them
    """
    bd = brand_daily(spark, sf_dir)
    yr = F.year("date")
    scale = F.when(yr % 2 == 0, F.lit(100.0)).otherwise(F.lit(1.0))
    ordinal = F.datediff("date", F.lit(SALES_EPOCH)) * 31 + _brand_no("asin")
    base = bd.select(
        "*",
        F.concat(F.lit("sales/"), yr.cast("string"), F.lit(".csv")).alias("_src_path"),
        (F.datediff("date", F.make_date(yr, F.lit(1), F.lit(1))) * 100 + _brand_no("asin")).cast("long").alias("_src_row"),
        F.lit(0.0).alias("_bump"),
        ordinal.alias("_ord"),
    )
    again = base.filter(F.dayofmonth("date") <= REPEAT_DAYS).select(
        *[c for c in base.columns if c not in ("_src_path", "_bump")],
        F.concat(F.lit("sales/"), yr.cast("string"), F.lit("_update.csv")).alias("_src_path"),
        F.lit(1.0).alias("_bump"),
    )
    u = base.unionByName(again)
    junk = (F.col("_ord") % JUNK_EVERY) == 0
    return u.select(
        F.concat(F.lit("  "), F.lower("asin"), F.lit(" ")).alias("ASIN"),
        F.date_format("date", "MM-dd-yyyy").alias("Date"),
        *[(F.col(c) * scale).cast("string").alias(raw) for c, raw in RATE_RAW.items()],
        F.when(junk, F.lit("n/a")).otherwise((F.col("sales") + F.col("_bump")).cast("string")).alias("Sales"),
        F.col("units").cast("string").alias("Units"),
        F.col("orders").cast("string").alias("Orders"),
        F.concat(F.lit("Product "), F.col("asin")).alias("Title"),
        "_src_path", "_src_row",
    )


def file_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A listing of export files: one per order, named in the four shapes exports use."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    kind = F.col("o_orderkey") % 4
    folder = F.element_at(F.array(F.lit("sellerise"), F.lit("returns"), F.lit("inventory"), F.lit("helium10")),
                          (F.col("o_custkey") % 4 + 1).cast("int"))
    name = (F.when(kind == 0, F.concat(F.lit("My Products"), F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit(".xlsx")))
            .when(kind == 1, F.concat(F.lit("Restock Inventory "), F.date_format("o_orderdate", "MMM dd, yyyy"), F.lit(".csv")))
            .when(kind == 2, F.concat(F.lit("Restock Inventory "), F.date_format("o_orderdate", "MMMM dd, yyyy"), F.lit(".csv")))
            .otherwise(F.concat(F.lit("export_"), F.col("o_orderkey").cast("string"), F.lit(".csv"))))
    return o.select(
        folder.alias("folder"),
        name.alias("name"),
        F.concat(folder, F.lit("/"), F.col("o_orderkey").cast("string"), F.lit("/"), name).alias("path"),
        F.col("o_orderkey").alias("file_id"),
    )


ORDERS_PER_EXPORT = 2048    # order keys of one export file


def order_export_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order exports as text: (file, place, line), one header per file and files of ORDERS_PER_EXPORT keys.

    Every third file has its columns in another order and every third lacks the status; notes hold quotes, separators and
    line breaks; some rows of the first kind lack their note, and one file in seven has rows with a field too many."""
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"), F.col("o_orderstatus").alias("status"))
    o = o.withColumn("file", F.floor(F.col("k") / ORDERS_PER_EXPORT).cast("long"))
    k, kind = F.col("k"), F.col("file") % 3
    text = k.cast("string")
    note = (F.when(k % 53 == 0, F.concat(F.lit('"line one\nline two, of '), text, F.lit('"')))
            .when(k % 31 == 0, F.concat(F.lit('"said ""yes"" to '), text, F.lit('"')))
            .when(k % 29 == 0, F.lit("N/A")).otherwise(F.concat(F.lit("plain "), text)))
    short = (kind == 0) & (k % 37 == 0)
    line = (F.when(short, F.concat_ws(",", text, F.col("status")))
            .when(kind == 0, F.concat_ws(",", text, F.col("status"), note))
            .when(kind == 1, F.concat_ws(",", note, text, F.col("status"))).otherwise(F.concat_ws(",", text, note)))
    line = F.when((F.col("file") % 7 == 2) & (k % 41 == 0), F.concat(line, F.lit(",surplus"))).otherwise(line)
    head = (F.when(kind == 0, F.lit("Order,Status,Note")).when(kind == 1, F.lit("Note,Order,Status")).otherwise(F.lit("Order,Note")))
    heads = o.select("file", head.alias("line")).distinct().select("file", F.lit(-1).cast("long").alias("place"), "line")
    return heads.unionAll(o.select("file", k.alias("place"), line.alias("line")))


def write_order_exports(spark: SparkSession, sf_dir: str, folder: str) -> None:
    """The order exports as files below ``folder``, one sub-folder each."""
    lines = order_export_lines(spark, sf_dir).repartition("file").sortWithinPartitions("file", "place")
    lines.select("file", "line").write.partitionBy("file").option("compression", "none").text(folder)


def write_sales_exports(spark: SparkSession, sf_dir: str, folder: str) -> None:
    """The sales exports as CSV files, a sub-folder per export; re-exports carry no Orders and Title columns."""
    r = sales_raw(spark, sf_dir).withColumnRenamed("_src_row", "Line").withColumn(
        "export", F.regexp_extract("_src_path", r"sales/(.*)\.csv", 1)).drop("_src_path")
    base, update = r.filter(~F.col("export").contains("_update")), r.filter(F.col("export").contains("_update"))
    for df in (base, update.drop("Orders", "Title")):
        df.write.mode("append").partitionBy("export").option("header", True).option(
            "ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(folder)
