"""The digest document: nested parts in order, texts, and days without alerts."""

import datetime as dt

from metricwatch.config import DEFAULT
from metricwatch.operators import alerts as AL

DAY = dt.date(2026, 1, 2)


def test_a_days_document(spark):
    rows = [("A", DAY, "homerun", "Spade, steel", "margin", -0.1, 0.2, 0.25, -3.0, "critical", "both", 1000.0, None),
            ("A", DAY, "homerun", "Spade, steel", "acos", 0.6, None, None, None, "critical", "absolute_threshold", None, None),
            ("B", DAY, None, None, "return_rate", 0.2, 0.1, None, 2.5, "warning", "rolling", None, "too small"),
            ("C", DAY, "double", "Rake", "sales", 900.0, 500.0, None, 2.2, "improvement", "rolling", None, None),
            ("D", DAY, "less_than_single", "Hoe", "sales", 1.0, 500.0, None, -9.0, "critical", "rolling", None, None)]
    df = spark.createDataFrame(rows, "asin string, date date, tier string, title string, metric string, actual_value double, "
                               "expected_value double, yoy_baseline double, z_score double, severity string, triggered_by string, "
                               "sales_roll_mean double, top_return_reason string")
    days = spark.createDataFrame([(DAY,), (DAY + dt.timedelta(days=1),)], "date date")
    got = {r["date"]: r for r in AL.digest_documents(AL.capped(df, DEFAULT), days, DEFAULT).collect()}
    quiet = got[DAY + dt.timedelta(days=1)]
    assert quiet["sections"] == [] and quiet["top"] == [] and "Nothing to report" in quiet["subject"]
    assert quiet["body"] == "Data through 2026-01-03"
    d = got[DAY]
    assert [(s["severity"], s["title"], [r["asin"] for r in s["rows"]]) for s in d["sections"]] == [
        ("critical", "CRITICAL (2)", ["A", "A"]), ("warning", "WARNING (1)", ["B"]), ("improvement", "IMPROVEMENT (1)", ["C"])]
    assert [(t["position"], t["asin"], t["metric"]) for t in d["top"]] == [(1, "A", "acos"), (2, "A", "margin"), (3, "B", "return_rate")]
    assert [r["is_group_head"] for r in d["sections"][0]["rows"]] == [True, False]
    lines = d["body"].split("\n")
    assert lines[0] == "Data through 2026-01-02" and lines[4] == "CRITICAL (2)" and lines[5].startswith("  HOMERUN")
    assert "about $350" in lines[2] and "Most returns say: too small." in lines[3]
    assert lines[-1].startswith("    Sales | Rake | $900.00 | +$400.00")
