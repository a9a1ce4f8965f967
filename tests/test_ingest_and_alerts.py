"""Standardisation, tiers, alert handling and backtest edge cases (FIXTURES.md §4)."""

import datetime as dt

from pyspark.sql import functions as F

from metricwatch.config import DEFAULT
from metricwatch.operators import alerts as AL
from metricwatch.operators import backtest as BT
from metricwatch.operators import master as MS
from metricwatch.operators import standardize as ST

D0 = dt.date(2024, 1, 1)


def test_mode_tie_takes_smallest_and_ignores_nulls(spark):
    rows = [(" a1 ", "2024-01-01T10:00:00", 1, r) for r in ("b", "a", "b", "a", None)]
    raw = spark.createDataFrame(rows, "ASIN string, `return-date` string, quantity long, reason string")
    r = ST.standardize_returns(raw).collect()
    assert len(r) == 1 and r[0]["asin"] == "A1" and r[0]["top_return_reason"] == "a" and r[0]["return_count"] == 5


def test_keep_last_by_file_then_row(spark):
    rows = [("A", "x", "f1.csv", 0), ("A", "y", "f1.csv", 1), ("A", "z", "f0.csv", 7)]
    df = spark.createDataFrame(rows, "asin string, v string, _src_path string, _src_row long")
    assert ST.keep_last(df, ["asin"]).first()["v"] == "y"


def test_rate_rescale_per_file(spark):
    rows = [("f_a", "0.9", "1"), ("f_a", "0.5", "2"), ("f_b", "1.01", "3"), ("f_b", "0.5", "4")]
    df = spark.createDataFrame(rows, "_src_path string, ACoS string, Sales string")
    out = {(r["_src_path"], r["Sales"]): float(r["ACoS"]) for r in ST.normalize_pct(df, ["ACoS"]).collect()}
    assert out[("f_a", "1")] == 0.9 and out[("f_b", "3")] == 0.0101 and out[("f_b", "4")] == 0.005


def test_standardize_sales_drops_unkeyed_and_coerces(spark):
    rows = [(" ab1 ", "01-13-2025", "n/a"), ("ab2", "13-01-2025", "5"), (None, "01-13-2025", "5")]
    df = ST.standardize_sales(spark.createDataFrame(rows, "ASIN string, Date string, Sales string"))
    r = df.collect()
    assert len(r) == 1 and r[0]["asin"] == "AB1" and r[0]["date"] == dt.date(2025, 1, 13) and r[0]["sales"] is None


def test_tier_boundaries(spark):
    rows = [("A", D0, 250_000.0), ("B", D0, 249_999.99), ("C", D0 - dt.timedelta(days=400), 1e9)]
    df = spark.createDataFrame(rows, "asin string, date date, sales double")
    t = {r["asin"]: (r["tier"], r["trailing_12m_revenue"], r["is_hero"]) for r in MS.assign_tiers(df, DEFAULT).collect()}
    assert t["A"] == ("single", 250_000.0, False)
    assert t["B"][0] == "less_than_single"
    assert t["C"] == ("less_than_single", None, False)      # no sales in the trailing year


def _alerts(spark, rows):
    return spark.createDataFrame(rows, "asin string, date date, tier string, metric string, severity string")


def test_suppression_keeps_null_tier(spark):
    a = _alerts(spark, [("A", D0, None, "sales", "watch"), ("B", D0, "less_than_single", "sales", "critical"),
                        ("C", D0, "single", "sales", "improvement")])
    kept = sorted(r["asin"] for r in AL.suppress(a, DEFAULT).collect())
    assert kept == ["A", "C"]


def test_caps_take_first_in_tier_order(spark):
    rows = [(f"P{i:02d}", D0, "homerun" if i % 2 else "single", "sales", "critical") for i in range(16)]
    c = AL.capped(_alerts(spark, rows), DEFAULT)
    got = sorted(r["asin"] for r in c.collect())
    homeruns = sorted(f"P{i:02d}" for i in range(16) if i % 2)
    singles = sorted(f"P{i:02d}" for i in range(16) if not i % 2)
    assert len(got) == 15 and set(homeruns) <= set(got) and singles[-1] not in got


def test_top_alerts_criticals_first(spark):
    rows = [("A", D0, "single", "sales", "warning"), ("B", D0, "single", "sales", "critical"),
            ("C", D0, "homerun", "sales", "watch")]
    t = AL.top_alerts(_alerts(spark, rows), DEFAULT).orderBy("position").collect()
    assert [r["asin"] for r in t] == ["B", "A"]


def test_backtest_day_with_improvements_only(spark):
    rows = [("A", D0, "single", "sales", "improvement"), ("A", D0 + dt.timedelta(days=1), "single", "sales", "critical")]
    a = _alerts(spark, rows).withColumn("triggered_by", F.lit("rolling"))
    d = {r["date"]: (r["critical"], r["warning"], r["watch"], r["total"]) for r in BT.daily(a, DEFAULT).collect()}
    assert d[D0] == (0, 0, 0, 0) and d[D0 + dt.timedelta(days=1)] == (1, 0, 0, 1)


def test_empty_feed_keeps_master(spark):
    sales = spark.createDataFrame([("A", D0, 10.0)], "asin string, date date, sales double")
    returns = ST.standardize_returns(spark.createDataFrame([], "asin string, `return-date` string, quantity long, reason string"))
    m = MS.merge_sources(sales, returns)
    assert m.count() == 1 and "return_count" in m.columns


def test_formatting_matches_python(spark):
    vals = [76808.635, -0.0004, 0.125, 1234.5, None]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    got = [r[0] for r in df.select(AL.fmt_value(F.col("x"), F.lit("sales"))).collect()]
    want = ["N/A" if v is None else f"${v:,.2f}" for v in vals]
    assert got == want
    got = [r[0] for r in df.select(AL.fmt_value(F.col("x"), F.lit("acos"))).collect()]
    assert got == ["N/A" if v is None else f"{v * 100:.1f}%" for v in vals]


def test_distinct_returns_opt_in(spark):
    rows = [("a1", "2024-01-01T10:00:00", 2, "x")] * 2
    raw = spark.createDataFrame(rows, "asin string, `return-date` string, quantity long, reason string")
    assert ST.standardize_returns(raw).first()["return_count"] == 4
    assert ST.standardize_returns(raw, distinct_rows=True).first()["return_count"] == 2
