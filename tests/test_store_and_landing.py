"""The snapshot store and its landing stream: whole landings, replay, later exports, compaction, the batch reader's rows."""

import itertools
import os

import pytest
from pyspark.sql import functions as F

from metricwatch.operators import standardize as ST
from metricwatch.sources import files as FL
from metricwatch.sources import store as SS
from metricwatch.streaming.snapshot_landing import land_snapshots


def put(folder, name, text):
    path = os.path.join(folder, name)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)


def held(spark, store, *columns):
    df = SS.read_store(spark, store)
    if df is None:
        return []
    df = df.withColumn("day", F.col("snapshot_date").cast("string"))
    return sorted(tuple(r) for r in df.select(*columns).collect())


def rows(spark, *rows):
    return spark.createDataFrame(rows, "asin string, v long, snapshot_date string").withColumn(
        "snapshot_date", F.col("snapshot_date").cast("date"))


def test_quoted_fields_header_order_and_repeats_land_as_the_batch_reader_reads_them(spark, tmp_dir):
    landing = os.path.join(tmp_dir, "in")
    put(landing, "a 2026-01-02.csv", 'ASIN,Reviews Rating,Title\nA,4.5,"24"" shovel, steel"\nB,4,"two\nlines"\n d ,3,x\n')
    put(landing, "b 2026-01-02.csv", "Title,Review Count,asin\ny,7,C\nz,8, d\nw,9,D \n")
    put(landing, "c 2026-01-03.csv", "asin,Reviews Rating\nA,N/A\nA,4.1\n,5\n")
    put(landing, "undated.csv", "asin,Reviews Rating\nZ,1\n")
    store = os.path.join(tmp_dir, "store")
    land_snapshots(spark, landing, None, store, os.path.join(tmp_dir, "ck"), keep="last",
                   rejects=os.path.join(tmp_dir, "bad")).awaitTermination(300)
    got = held(spark, store, "day", "asin", F.coalesce("review_rating", F.lit(-1.0)), F.coalesce("review_count", F.lit(-1.0)))
    feed = FL.read_csv_files(spark, FL.list_files(spark, landing))
    want = []
    for day in ("2026-01-02", "2026-01-03"):
        one = ST.standardize_snapshot(feed.filter(F.element_at("_src_entry", -1).contains(day)))
        want += [(day, r["asin"], r["review_rating"] or -1.0, r["review_count"] or -1.0) for r in one.dropna(subset=["asin"]).collect()]
    assert got == sorted(want)
    assert [g[1] for g in got] == ["A", "B", "C", "D", "A"] and got[3][3] == 9.0 and got[4][2] == 4.1


def test_columns_of_a_schema_are_found_by_name(spark, tmp_dir):
    landing, store = os.path.join(tmp_dir, "in"), os.path.join(tmp_dir, "store")
    put(landing, "a 2026-01-02.csv", "title,asin\nT,A\n")
    schema = spark.createDataFrame([], "ASIN string, title string, price double").schema
    land_snapshots(spark, landing, schema, store, os.path.join(tmp_dir, "ck")).awaitTermination(300)
    assert held(spark, store, "ASIN", "title", F.col("price").isNull()) == [("A", "T", True)]


def test_a_landing_killed_half_way_is_invisible_and_replayed(spark, tmp_dir):
    store = os.path.join(tmp_dir, "store")
    assert SS.publish(rows(spark, ("A", 1, "2026-01-01")), store, batch="x#0") == 1
    rows(spark, ("B", 9, "2026-01-01"), ("C", 9, "2026-01-02")).write.partitionBy("snapshot_date").parquet(f"{store}/commit=2")
    assert held(spark, store, "asin", "v") == [("A", 1)]                                # rows without a manifest line
    again = rows(spark, ("B", 2, "2026-01-01"))
    assert SS.publish(again, store, batch="x#1") == 1
    assert held(spark, store, "asin", "v", "day") == [("A", 1, "2026-01-01"), ("B", 2, "2026-01-01")]
    assert SS.publish(again, store, batch="x#1") == 0                                   # the same batch again
    assert held(spark, store, "asin", "v") == [("A", 1), ("B", 2)]


@pytest.mark.parametrize("order", list(itertools.permutations(range(3)))[::2])
def test_three_landings_out_of_order_give_the_batch_result(spark, tmp_dir, order):
    """Exports replace each other by name and row, not by arrival; compaction in between changes nothing."""
    store = os.path.join(tmp_dir, "store")
    landings = [("p1", [("A", 1, "2026-01-01"), ("B", 1, "2026-01-01")]), ("p2", [("A", 2, "2026-01-01"), ("C", 2, "2026-01-02")]),
                ("p3", [("B", 3, "2026-01-01"), ("C", 3, "2026-01-02")])]
    for k, i in enumerate(order):
        name, data = landings[i]
        df = rows(spark, *data).withColumn("_order", F.struct(F.array(F.lit(name)).alias("entry"), F.lit(1).cast("long").alias("row")))
        SS.publish(df, store, keep="last", batch=str(k))
        if k == 1:
            assert SS.compact(spark, store) == 2
    want = [("A", 2, "2026-01-01"), ("B", 3, "2026-01-01"), ("C", 3, "2026-01-02")]
    assert held(spark, store, "asin", "v", "day") == want
    assert SS.compact(spark, store) == 2 and held(spark, store, "asin", "v", "day") == want
    assert len(SS.commits(spark, store)) == 1 and len(SS.superseded(spark, store)) == 4


def test_later_exports_of_the_stream_replace_rows(spark, tmp_dir):
    landing, store, ck = (os.path.join(tmp_dir, x) for x in ("in", "store", "ck"))
    put(landing, "p2 2026-01-02.csv", "asin,Review Count\nA,2\nB,2\n")
    land_snapshots(spark, landing, None, store, ck, keep="last").awaitTermination(300)
    put(landing, "p1 2026-01-02.csv", "asin,Review Count\nA,1\nC,1\n")                 # an earlier export, later
    put(landing, "p3 2026-01-02.csv", "asin,Review Count\nB,3\n")
    land_snapshots(spark, landing, None, store, ck, keep="last").awaitTermination(300)
    assert held(spark, store, "asin", "review_count") == [("A", 2.0), ("B", 3.0), ("C", 1.0)]
    n = len(SS.commits(spark, store))
    land_snapshots(spark, landing, None, store, ck, keep="last").awaitTermination(300)  # nothing new
    assert len(SS.commits(spark, store)) == n
