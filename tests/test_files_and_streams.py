"""Export folders, snapshot store and the AvailableNow landing stream."""

import datetime as dt
import os
import time

from pyspark.sql import functions as F

from metricwatch.config import DEFAULT
from metricwatch.operators import snapshot as SN
from metricwatch.sources import files as FL


def _write(path, text, encoding="utf-8"):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding=encoding) as f:
        f.write(text)


def test_file_date_extraction(spark):
    names = ["My Products2026-03-23.xlsx", "Restock Inventory Mar 5, 2026.csv", "Restock Inventory March 23, 2026.csv",
             "export.csv", "bad 2026-13-45 Mar 2, 2026.csv"]
    from metricwatch.functions.exprs import file_date
    df = spark.createDataFrame([(n,) for n in names], "name string")
    got = [r[0] for r in df.select(file_date(F.col("name"))).collect()]
    assert got == [dt.date(2026, 3, 23), dt.date(2026, 3, 5), None, None, dt.date(2026, 3, 2)]


def test_listing_levels_encodings_and_union(spark, tmp_dir):
    _write(f"{tmp_dir}/a 2026-01-02.csv", "﻿asin,Sales\nx1,5\n")
    _write(f"{tmp_dir}/sub/b 2026-01-03.csv", "asin,Title\nx2,Café\n", encoding="latin-1")
    _write(f"{tmp_dir}/sub/deeper/c 2026-01-04.csv", "asin\nx3\n")          # two levels down: ignored
    _write(f"{tmp_dir}/.hidden.csv", "asin\nx4\n")
    listing = FL.list_files(spark, tmp_dir)
    names = sorted(r["name"] for r in listing.collect())
    assert names == ["a 2026-01-02.csv", "b 2026-01-03.csv"]
    df = FL.read_csv_files(spark, listing)
    rows = {r["asin"]: r for r in df.collect()}
    assert set(rows) == {"x1", "x2"}
    assert rows["x1"]["Sales"] == "5" and rows["x1"]["Title"] is None
    assert rows["x2"]["Title"] == "Café" and rows["x2"]["_src_depth"] == 1 and rows["x2"]["_src_row"] == 1


def test_fallback_selection(spark):
    rows = [("p/a.csv", "a", 0, dt.date(2026, 1, 1)), ("p/b.csv", "b", 0, dt.date(2026, 1, 3)),
            ("p/s/c.csv", "c", 1, dt.date(2026, 1, 3)), ("p/d.csv", "d", 0, None)]
    listing = spark.createDataFrame(rows, "path string, name string, depth int, file_date date")
    day = dt.date(2026, 1, 1)
    assert [r["path"] for r in FL.select_all_or_day(listing, day).collect()] == ["p/a.csv"]
    assert FL.select_all_or_day(listing, dt.date(2026, 1, 9)).count() == 4
    assert [r["path"] for r in FL.select_day_or_latest_one(listing, dt.date(2026, 1, 9)).collect()] == ["p/b.csv"]
    assert sorted(r["path"] for r in FL.select_day_or_latest_all(listing, None).collect()) == ["p/b.csv", "p/s/c.csv"]
    assert FL.select_day_or_latest_all(listing, dt.date(2026, 1, 9)).count() == 0


def test_snapshot_write_twice_keeps_one_copy(spark, tmp_dir):
    store = f"{tmp_dir}/store"
    snap = spark.createDataFrame([("A", 4.5), ("B", 3.9)], "asin string, review_rating double")
    assert FL.write_snapshot(snap, store, "2026-01-01") == 1
    assert FL.write_snapshot(snap.withColumn("review_rating", F.lit(1.0)), store, "2026-01-01") == 0
    h = FL.read_snapshot_history(spark, store)
    assert h.count() == 2 and h.agg(F.min("review_rating")).first()[0] == 3.9


def test_snapshot_gate(spark):
    def hist(n):
        return spark.createDataFrame([("A", dt.date(2026, 1, 1) + dt.timedelta(days=i), 4.0 + (i % 2) * 0.1)
                                      for i in range(n)], "asin string, date date, review_rating double")
    assert SN.snapshot_scores(hist(6), DEFAULT).count() == 0
    assert SN.snapshot_scores(hist(7), DEFAULT).count() == 7


def test_snapshot_nulls_do_not_take_slots(spark):
    rows = [("A", dt.date(2026, 1, 1) + dt.timedelta(days=i), None if i < 8 else 4.0) for i in range(14)]
    h = spark.createDataFrame(rows, "asin string, date date, review_rating double")
    s = SN.snapshot_scores(h, DEFAULT).orderBy("date").collect()
    assert len(s) == 6 and s[-1]["roll_mean"] is None            # 6 non-null values < min periods
    rows = [("A", dt.date(2026, 1, 1) + dt.timedelta(days=i), None if i % 2 else 3.0) for i in range(14)]
    s = SN.snapshot_scores(spark.createDataFrame(rows, "asin string, date date, review_rating double"), DEFAULT)
    last = s.orderBy(F.col("date").desc()).first()
    assert last["roll_mean"] == 3.0 and last["sev"] == 2 and last["trig"] == "absolute_threshold"


def test_available_now_landing_replays_to_same_store(spark, tmp_dir):
    from pyspark.sql.types import StringType, StructField, StructType
    from metricwatch.streaming.snapshot_landing import land_snapshots
    landing, store, ck = f"{tmp_dir}/landing", f"{tmp_dir}/store", f"{tmp_dir}/ck"
    _write(f"{landing}/listing 2026-01-01.csv", "asin,review_rating\nA,4.5\nB,3.0\n")
    _write(f"{landing}/listing 2026-01-02.csv", "asin,review_rating\nA,4.4\n")
    schema = StructType([StructField("asin", StringType()), StructField("review_rating", StringType())])
    q = land_snapshots(spark, landing, schema, store, ck)
    q.awaitTermination(120)
    first = sorted(tuple(r) for r in FL.read_snapshot_history(spark, store).select("asin", "snapshot_date").collect())
    assert len(first) == 3
    _write(f"{landing}/listing 2026-01-01 again.csv", "asin,review_rating\nA,1.0\n")  # same day again
    q = land_snapshots(spark, landing, schema, store, ck)
    q.awaitTermination(120)
    again = sorted(tuple(r) for r in FL.read_snapshot_history(spark, store).select("asin", "snapshot_date").collect())
    assert again == first


def test_row_in_file_exact_across_splits(spark, tmp_dir):
    _write(f"{tmp_dir}/big 2026-01-01.csv", "asin,n\n" + "".join(f"A{i % 7},{i}\n" for i in range(1, 401)))
    _write(f"{tmp_dir}/small 2026-01-02.csv", "asin,n\nB,1\nB,2\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "512")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        df = FL.read_csv_files(spark, FL.list_files(spark, tmp_dir))
        assert df.rdd.getNumPartitions() > 1
        rows = df.select("_src_path", "n", "_src_row").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert len(rows) == 402
    assert all(int(r["n"]) == r["_src_row"] for r in rows)
