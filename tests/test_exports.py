"""The one-pass export reader: rejected rows and files, headers per file, quoted fields, missing values; one scan."""

import os
import random

import pytest
from pyspark.sql import functions as F

from metricwatch.sources import exports as EX
from metricwatch.sources import files as FL


def put(folder, name, text, encoding="utf-8"):
    path = os.path.join(folder, name)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as f:
        f.write(text.encode(encoding))


def told(feed):
    return sorted((r["path"].rsplit("/", 1)[1], r["row"], r["reason"], r["record"]) for r in feed.rejects.collect())


def values(feed, *columns):
    return sorted(tuple(r[c] for c in columns) for r in feed.rows.collect())


def order(x):
    return tuple((v is None, v) for v in x)


def test_rejected_rows_and_files_are_reported(spark, tmp_dir):
    put(tmp_dir, "a.csv", "asin,v\nA,1\nB\nC,3\n")                       # a short row stays, with a null
    put(tmp_dir, "b.csv", "asin,v\nD,4\nE,5,6\nF,7\n")                   # a long row: the file can't be read
    put(tmp_dir, "c.csv", "\n \n")                                       # no header; files of length 0 are not listed
    put(tmp_dir, "d.csv", "v,asin\n8,G\n")                               # other order
    put(tmp_dir, "e.csv", 'asin,v\nH,"9\nI,10\n')                        # never closed
    put(tmp_dir, "f.csv", "asin,v\n")                                    # a header only
    put(tmp_dir, "g.csv", 'asin,v\nJ,"1,5",x\n')
    feed = FL.read_exports(spark, FL.list_files(spark, tmp_dir))
    got = sorted(((r["asin"], r["v"]) for r in feed.rows.collect()), key=order)
    assert got == [("A", "1"), ("B", None), ("C", "3"), ("G", "8")]
    name = lambda r: (r["path"].rsplit("/", 1)[1], r["row"], r["reason"], r["record"])
    assert sorted(map(name, feed.rejects.collect()), key=order) == sorted([
        ("a.csv", 2, EX.SHORT, "B"), ("b.csv", 2, EX.LONG, "E,5,6"), ("b.csv", None, EX.LEFT_OUT, None),
        ("c.csv", None, EX.NO_RECORD, None), ("e.csv", 1, EX.UNCLOSED, 'H,"9'), ("g.csv", 1, EX.LONG, 'J,"1,5",x'),
        ("g.csv", None, EX.LEFT_OUT, None)], key=order)
    by_row = FL.read_exports(spark, FL.list_files(spark, tmp_dir), on_long="row")
    assert sorted(r["asin"] for r in by_row.rows.collect()) == ["A", "B", "C", "D", "F", "G"]
    # every line that isn't a header or blank is read or reported
    assert by_row.rows.count() + by_row.rejects.filter(F.col("reason") == EX.LONG).count() == 8


def test_an_unreadable_file_is_reported(spark, tmp_dir):
    put(tmp_dir, "a.csv", "asin,v\nA,1\n")
    put(tmp_dir, "b.csv", "asin,v\nB,2\n")
    listing = FL.list_files(spark, tmp_dir)
    listing = spark.createDataFrame(listing.collect(), listing.schema)
    os.rename(os.path.join(tmp_dir, "b.csv"), os.path.join(tmp_dir, "b.gone"))
    paths = [r["path"] for r in listing.filter("name = 'a.csv'").collect()]
    feed = EX.parse(EX.scan_lines(spark, paths), listing)
    assert [r["asin"] for r in feed.rows.collect()] == ["A"]
    assert [(r["path"].rsplit("/", 1)[1], r["reason"]) for r in feed.rejects.collect()] == [("b.csv", EX.NO_RECORD)]


def test_missing_values_repeated_names_blank_lines_and_encodings(spark, tmp_dir):
    put(tmp_dir, "a.csv", '\n \t\n﻿asin,v,v,,x.y\r\nA,N/A,"NA",null,é\r\n\r\nB,nan,None,ok,-\r\n')
    put(tmp_dir, "b.csv", "ASIN,v\ncafé,#N/A\nC,NAN\n", "latin-1")
    feed = FL.read_exports(spark, FL.list_files(spark, tmp_dir))
    rows = {r[0]: r for r in feed.rows.collect()}
    assert feed.rows.columns[:5] == ["asin", "v", "v.1", "Unnamed: 3", "x.y"]
    assert tuple(rows["A"][1:5]) == (None, None, None, "é") and tuple(rows["B"][1:5]) == (None, None, "ok", "-")
    assert rows["café"]["v"] is None and rows["C"]["v"] == "NAN" and feed.rejects.count() == 0


@pytest.mark.parametrize("split", ["64", "1000000"])
def test_random_files_equal_the_csv_module(spark, tmp_dir, split):
    """Quotes, doubled quotes, separators and line breaks, over several splits a file."""
    import csv
    rng = random.Random(int(split))
    want = []
    for k in range(12):
        names = rng.sample(["id", "title", "note"], 3)
        rows = []
        for i in range(rng.randint(1, 25)):
            cell = lambda: "".join(rng.choice(['a', 'b', ',', '"', ' ', '\n' if k % 2 else 'c']) for _ in range(rng.randint(1, 6)))
            rows.append({"id": f"{k}-{i}", "title": cell() + "z", "note": "y" + cell() + "z"})
        path = os.path.join(tmp_dir, f"f{k:02d}.csv")
        with open(path, "w", newline="", encoding="utf-8") as f:
            w = csv.DictWriter(f, names, lineterminator="\n")
            w.writeheader()
            w.writerows(rows)
        want += [(f"f{k:02d}.csv", i + 1, r["id"], r["title"], r["note"]) for i, r in enumerate(rows)]
    before = {c: spark.conf.get(c) for c in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        feed = FL.read_exports(spark, FL.list_files(spark, tmp_dir))
    finally:
        for c, v in before.items():
            spark.conf.set(c, v)
    got = feed.rows.select(F.element_at("_src_entry", 1).alias("f"), "_src_row", "id", "title", "note").collect()
    quoted = [w for w in want if int(w[0][1:3]) % 2]
    plain = [w for w in want if not int(w[0][1:3]) % 2]
    got = sorted(tuple(r) for r in got)
    assert [g for g in got if not int(g[0][1:3]) % 2] == sorted(plain)
    assert [(g[0], g[2:]) for g in got if int(g[0][1:3]) % 2] == [(w[0], w[2:]) for w in sorted(quoted)]
    assert feed.rejects.count() == 0


def test_the_plan_of_the_rows_scans_no_file(spark, tmp_dir):
    """The one scan is written out before; rates, newest day and rows read what it wrote."""
    from metricwatch.operators import standardize as ST
    from metricwatch.plans import pipeline as PL
    put(tmp_dir, "a 2026-01-02.csv", "ASIN,Date,Sales,ACoS\nA,01-02-2026,5,20\nB,01-03-2026,6,0.5\n")
    feed = FL.read_exports(spark, FL.list_files(spark, tmp_dir))
    master = PL.build_master({"sellerise": feed.rows, "reference_date": None})
    plan = master._jdf.queryExecution().toString()
    assert "FileScan" not in plan.split("== Physical Plan ==")[1]
    assert sorted((r["asin"], r["acos"]) for r in master.collect()) == [("A", 0.2), ("B", 0.005)]
    assert ST.normalize_pct(feed.rows).count() == 2


def test_records_are_parsed_once_for_rows_and_rejects(spark, tmp_dir):
    """Rows, rejects and files left out go on from the parsed records, which are written out."""
    put(tmp_dir, "a.csv", 'asin,v\nA,1\nB\n"C\nc",3\n')
    put(tmp_dir, "x/b.csv", "v,asin\n4,D\n5,E,6\n")
    put(tmp_dir, "x/c.csv", "v,asin\n7,F\n")
    feed = FL.read_exports(spark, FL.list_files(spark, tmp_dir))
    for df in (feed.rows, feed.rejects):
        assert "from_csv" not in df._jdf.queryExecution().toString().split("== Physical Plan ==")[1]
    assert values(feed, "asin", "_src_row") == [("A", 1), ("B", 2), ("C\nc", 3), ("F", 1)]
    assert {(r["_src_depth"], *r["_src_entry"]) for r in feed.rows.collect()} == {(0, "a.csv"), (1, "x", "c.csv")}
    name = lambda r: (r["path"].rsplit("/", 1)[1], r["row"], r["reason"], r["record"])
    assert sorted(map(name, feed.rejects.collect()), key=order) == sorted([("a.csv", 2, EX.SHORT, "B"), ("b.csv", 2, EX.LONG, "5,E,6"),
        ("b.csv", None, EX.LEFT_OUT, None)], key=order)
