"""Exports as sellers send them: odd names, quoted titles, split days, un-padded dates, missing feeds."""

import os

from pyspark.sql import functions as F

from metricwatch.config import DEFAULT
from metricwatch.functions import exprs as X
from metricwatch.operators import detect as D
from metricwatch.operators import standardize as ST
from metricwatch.plans import pipeline as PL
from metricwatch.sources import files as FL
from metricwatch.streaming.snapshot_landing import land_snapshots


def put(folder, name, text):
    path = os.path.join(folder, name)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)


def test_listing_by_ending_in_any_case_below_an_odd_folder_name(spark, tmp_dir):
    root = os.path.join(tmp_dir, ".hidden", "My (2025) x")
    put(root, "b.CSV", "a\n1\n")
    put(root, "sub folder/c.csv", "a\n2\n")
    put(root, "sub folder/.d.csv", "a\n3\n")
    put(root, "notes.txt", "x")
    got = {r["name"]: (r["depth"], r["entry"]) for r in FL.list_files(spark, root).collect()}
    assert got == {"b.CSV": (0, ["b.CSV"]), "c.csv": (1, ["sub folder", "c.csv"])}


def test_quotes_and_line_breaks_in_fields(spark, tmp_dir):
    put(tmp_dir, "x.csv", 'ASIN,Title,Sales\nA,"24"" shovel, steel",5\nB,plain,6\n')
    put(tmp_dir, "y z+1.csv", 'ASIN,Title,Sales\nC,"two\nlines",7\nD,"q ""x""",8\n')
    rows = {r["ASIN"]: r for r in FL.read_csv_files(spark, FL.list_files(spark, tmp_dir)).collect()}
    assert rows["A"]["Title"] == '24" shovel, steel' and rows["A"]["Sales"] == "5"
    assert rows["C"]["Title"] == "two\nlines" and rows["D"]["Title"] == 'q "x"' and rows["D"]["_src_row"] == 2
    assert rows["C"]["_src_entry"] == ["y z+1.csv"] and len(rows) == 4


def test_the_last_entry_by_name_wins_in_a_mixed_folder(spark, tmp_dir):
    put(tmp_dir, "abrand/x.csv", "ASIN,v\nA,folder\n")
    put(tmp_dir, "zz.csv", "ASIN,v\nA,file\n")
    put(tmp_dir, "a b.csv", "ASIN,v\nB,blank\n")
    put(tmp_dir, "a/x.csv", "ASIN,v\nB,slash\n")
    df = ST.keep_last(FL.read_csv_files(spark, FL.list_files(spark, tmp_dir)), ["ASIN"])
    assert {r["ASIN"]: r["v"] for r in df.collect()} == {"A": "file", "B": "blank"}


def test_tolerant_values(spark):
    row = spark.createDataFrame([("1-5-2025", "  b01x ", "2025-13-01")], "d string, k string, bad string").select(
        X.mdy_date(F.col("d")).cast("string").alias("d"), X.key_normalize(F.col("k")).alias("k"), X.mdy_date(F.col("bad")).alias("bad"))
    assert tuple(row.first()) == ("2025-01-05", "B01X", None)
    raw = spark.createDataFrame([("A", "2025-01-05T00:00:00", "2.0", "r"), ("A", "2025-01-05T01:00:00", "1", "r"),
                                 ("A", "2025-01-05T01:00:00", "n/a", None)], ["asin", "return-date", "quantity", "reason"])
    assert ST.standardize_returns(raw).first()["return_count"] == 3


def test_all_files_of_a_day_land_and_a_late_one_too(spark, tmp_dir):
    landing, store, ck = (os.path.join(tmp_dir, x) for x in ("in", "store", "ck"))
    put(landing, "p1 2025-01-02.csv", "ASIN,Price\nA,1\nB,2\n")
    put(landing, "p2 2025-01-02.csv", "ASIN,Price\nC,3\nA,9\n")
    schema = spark.createDataFrame([], "ASIN string, Price string").schema
    land_snapshots(spark, landing, schema, store, ck).awaitTermination()
    assert sorted((r["ASIN"], r["Price"]) for r in spark.read.parquet(store).collect()) == [("A", "1"), ("B", "2"), ("C", "3")]
    put(landing, "p3 2025-01-02.csv", "ASIN,Price\nD,4\nB,8\n")
    land_snapshots(spark, landing, schema, store, ck).awaitTermination()
    assert sorted(r["ASIN"] for r in spark.read.parquet(store).collect()) == ["A", "B", "C", "D"]


def test_an_empty_sales_feed_gives_a_typed_empty_master(spark, tmp_dir):
    empty = FL.read_csv_files(spark, FL.list_files(spark, tmp_dir))
    master = PL.build_master({"sellerise": empty, "reference_date": None}, DEFAULT)
    assert master.count() == 0 and {"asin", "date", "sales", "tier"} <= set(master.columns)


def test_one_day_equals_the_filtered_history_with_nan_and_gaps(spark):
    rows = [("A", i, float("nan") if i == 25 else 100.0 + i % 3, 0.0 if i > 33 else 5.0) for i in range(40) if i not in (7, 8)]
    rows += [("B", i, 50.0 + (400.0 if i == 30 else 0.0), 3.0) for i in range(40)]
    m = spark.createDataFrame(rows, "asin string, k int, sales double, units double").select(
        "asin", F.date_add(F.lit("2025-01-01").cast("date"), F.col("k")).alias("date"), "sales", "units",
        F.lit("single").alias("tier"))
    every = D.detect(m, DEFAULT, ["sales"])
    for day in ("2025-01-26", "2025-01-30", "2025-01-31", "2025-02-09"):
        want = sorted(map(str, every.filter(F.col("date") == F.lit(day).cast("date")).collect()))
        assert sorted(map(str, D.detect_day(m, day, DEFAULT, ["sales"]).collect())) == want
    newest = sorted(map(str, D.detect_day(m, None, DEFAULT, ["sales"]).collect()))
    assert newest == sorted(map(str, every.filter("date = (select date'2025-02-09')").collect()))
