"""Hand-made edge rows for the detection operators (FIXTURES.md §4)."""

import datetime as dt
import math

from pyspark.sql import functions as F

from metricwatch.config import DEFAULT
from metricwatch.operators import alerts as AL, detect as D
from metricwatch.operators.baselines import with_rolling, with_zero_run
from metricwatch.queries import REGISTRY

D0 = dt.date(2023, 1, 1)


def series(spark, values, metric="sales", asin="A", start=D0, step=1, extra=None):
    rows = []
    for i, v in enumerate(values):
        r = {"asin": asin, "date": start + dt.timedelta(days=i * step), metric: None if v is None else float(v)}
        r.update(extra or {})
        rows.append(r)
    cols = sorted(rows[0].keys())
    return spark.createDataFrame([tuple(r[c] for c in cols) for r in rows],
                                 ", ".join(f"{c} {'string' if c in ('asin', 'tier') else 'date' if c == 'date' else 'boolean' if c == 'is_hero' else 'double'}" for c in cols))


def by_date(df, col):
    return [r[col] for r in df.orderBy("date").select(col).collect()]


def test_min_periods(spark):
    df = with_rolling(series(spark, [1, 2, 3, 4, 5, 6, 7]), ["sales"], DEFAULT)
    means = by_date(df, "sales_roll_mean")
    assert means[:6] == [None] * 6
    assert means[6] == 4.0


def test_row_frame_ignores_calendar_gaps(spark):
    vals = list(range(1, 15))
    df = series(spark, vals, step=30)          # 14 rows spread over > 1 year
    out = by_date(with_rolling(df, ["sales"], DEFAULT), "sales_roll_mean")
    assert out[-1] == sum(vals) / 14


def test_null_takes_a_slot_on_the_daily_feed(spark):
    vals = [1.0] * 6 + [None] + [1.0] * 7     # 13 non-null in the last 14 rows
    df = with_rolling(series(spark, vals), ["sales"], DEFAULT)
    assert by_date(df, "sales_roll_mean")[-1] == 1.0
    vals = [None] * 8 + [1.0] * 6              # only 6 non-null in the frame
    df = with_rolling(series(spark, vals), ["sales"], DEFAULT)
    assert by_date(df, "sales_roll_mean")[-1] is None


def test_constant_series_has_no_z(spark):
    df = with_rolling(series(spark, [5.0] * 14), ["sales"], DEFAULT)
    assert by_date(df, "sales_roll_zscore")[-1] is None


def test_z_bound_with_current_row(spark):
    # 13 equal values, then one far off in the bad direction: |z| = 13/sqrt(14) = 3.474
    conv = series(spark, [0.10] * 13 + [0.01], metric="conversion_rate")
    w = D.scored(conv, DEFAULT, ["conversion_rate"])
    last = w.orderBy(F.col("date").desc()).first()
    assert math.isclose(-last["conversion_rate_roll_zscore"], 13 / math.sqrt(14), rel_tol=1e-6)
    assert last["conversion_rate_sev"] == 2                       # warning, 3.5 can never fire
    rr = series(spark, [0.01] * 13 + [0.03], metric="return_rate")
    last = D.scored(rr, DEFAULT, ["return_rate"]).orderBy(F.col("date").desc()).first()
    assert last["return_rate_sev"] == 3 and last["return_rate_trig"] == "rolling"


def test_leap_day_yoy_looks_at_feb_28(spark):
    start = dt.date(2023, 2, 25)
    days = [start + dt.timedelta(days=i) for i in range(7)]          # 2023-02-25 .. 03-03
    rows = [("A", d, float(i + 1)) for i, d in enumerate(days)]
    rows += [("A", dt.date(2024, 2, 29), 100.0)]
    df = spark.createDataFrame(rows, "asin string, date date, sales double")
    b = D.baselines(df, DEFAULT, ["sales"])
    r = b.filter(F.col("date") == dt.date(2024, 2, 29)).first()
    # centre 2023-02-28: days 02-25 .. 03-03 all inside the week
    assert r["sales_yoy_mean"] == 4.0


def test_yoy_span_364_vs_365(spark):
    for span, ok in ((364, False), (365, True)):
        df = spark.createDataFrame([("A", D0, 1.0), ("A", D0 + dt.timedelta(days=span), 1.0)],
                                   "asin string, date date, sales double")
        r = D.baselines(df, DEFAULT, ["sales"]).orderBy("date").collect()
        assert r[-1]["yoy_available"] is ok


def _yoy_pair(spark, metric, last_year, now, extra=None):
    rows = [("A", D0, float(last_year)), ("A", D0 + dt.timedelta(days=365), float(now))]
    df = spark.createDataFrame(rows, f"asin string, date date, {metric} double")
    for k, v in (extra or {}).items():
        df = df.withColumn(k, F.lit(v))
    return D.scored(df, DEFAULT, [metric]).orderBy("date").collect()[-1]


def test_yoy_zero_baseline_gives_no_deviation(spark):
    r = _yoy_pair(spark, "sales", 0.0, 100.0)
    assert r["sales_yoy_mean"] == 0.0 and r["sales_yoy_deviation"] is None


def test_yoy_suppressors_are_strict(spark):
    # sales below 50 -> cleared; exactly 50 is kept
    assert _yoy_pair(spark, "sales", 200.0, 49.5)["sales_yoy_sev"] is None
    assert _yoy_pair(spark, "sales", 200.0, 50.0)["sales_yoy_sev"] == 3
    # weak acos baseline (< 0.05) cleared; 0.05 kept (sales high enough for the acos gate)
    assert _yoy_pair(spark, "acos", 0.0499, 0.2, {"sales": 1000.0})["acos_yoy_sev"] is None
    assert _yoy_pair(spark, "acos", 0.0625, 0.2, {"sales": 1000.0})["acos_yoy_sev"] == 3
    # return-rate difference below 0.01 cleared, 0.015 kept
    assert _yoy_pair(spark, "return_rate", 0.0100, 0.0195)["return_rate_yoy_sev"] is None
    assert _yoy_pair(spark, "return_rate", 0.0100, 0.0250)["return_rate_yoy_sev"] == 3


def test_low_sales_acos_still_escalated_by_spike_floor(spark):
    acos = [0.10] * 13 + [0.16]                 # +60 % over the rolling mean
    df = series(spark, acos, metric="acos", extra={"sales": 99.0})
    w = D.scored(df, DEFAULT, ["acos", "sales"])
    last = w.orderBy(F.col("date").desc()).first()
    assert last["acos_sev"] == 3 and last["acos_trig"] == "absolute_threshold"


def test_improvement_after_acos_clear(spark):
    # acos far above its rolling mean, but sales rising >5 % -> alert cleared;
    # acos far below last year -> improvement
    rows = [("A", D0, 0.50, 1000.0)]
    rows += [("A", D0 + dt.timedelta(days=352 + i), 0.10, 1000.0) for i in range(13)]
    rows += [("A", D0 + dt.timedelta(days=365), 0.20, 2000.0)]
    df = spark.createDataFrame(rows, "asin string, date date, acos double, sales double")
    out = D.detect(df, DEFAULT, ["acos", "sales"]).filter((F.col("metric") == "acos") &
                                                          (F.col("date") == D0 + dt.timedelta(days=365))).collect()
    assert [r["severity"] for r in out] == ["improvement"]
    assert out[0]["triggered_by"] == "yoy"


def test_zero_run_rules(spark):
    def run(units, stock, hero, yoy_ok=True):
        df = series(spark, [1000.0] * len(units), extra={"is_hero": hero})
        df = df.withColumn("units", F.element_at(F.array(*[F.lit(u).cast("double") for u in units]),
                                                 (F.datediff("date", F.lit(D0)) + 1).cast("int")))
        df = df.withColumn("available_units", F.lit(stock).cast("double"))
        w = D.scored(df, DEFAULT, ["sales"])
        return w.orderBy(F.col("date").desc()).first()["sales_sev"]
    assert run([5, 0, 0], 10, True) == 3
    assert run([0, 5, 0], 10, True) is None
    assert run([None, 0], 10, True) == 3          # NULL units count as zero
    assert run([5, 0, 0], 0, True) is None        # out of stock
    assert run([5, 0, 0], None, True) == 3        # unknown stock counts as in stock
    assert run([5, 0, 0], 10, False) is None      # not a hero


def test_zero_run_length_counts_rows(spark):
    df = series(spark, [1.0] * 6).withColumn("units", F.element_at(
        F.array(*[F.lit(x) for x in (0.0, 0.0, 3.0, 0.0, 0.0, 0.0)]), (F.datediff("date", F.lit(D0)) + 1).cast("int")))
    assert by_date(with_zero_run(df), "zero_run") == [1, 2, 0, 1, 2, 3]


def test_floors_are_strict(spark):
    def floor_sev(metric, value, extra=None):
        df = series(spark, [value], metric=metric, extra=extra)
        return D.scored(df, DEFAULT, [metric]).first()[f"{metric}_sev"]
    assert floor_sev("return_rate", 0.035) is None
    assert floor_sev("return_rate", 0.0351) == 2
    assert floor_sev("return_rate", 0.05) == 2
    assert floor_sev("return_rate", 0.0501) == 3
    assert floor_sev("margin", 0.0) is None
    assert floor_sev("margin", -0.01) == 3
    assert floor_sev("margin", 0.10, {"is_hero": True}) is None
    assert floor_sev("margin", 0.09, {"is_hero": True}) == 2
    assert floor_sev("margin", 0.09, {"is_hero": False}) is None


def test_escalation_keeps_statistical_trigger(spark):
    # rolling watch on return_rate (z between 1.5 and 2) + floor warning -> warning, trigger rolling
    vals = [0.030, 0.034] * 6 + [0.032, 0.0358]            # z = 1.62 and 0.0358 > 0.035
    w = D.scored(series(spark, vals, metric="return_rate"), DEFAULT, ["return_rate"])
    last = w.orderBy(F.col("date").desc()).first()
    assert last["return_rate_roll_sev"] == 1
    assert last["return_rate_sev"] == 2 and last["return_rate_trig"] == "rolling"


def test_nan_behaves_as_null(spark):
    from metricwatch.functions.exprs import nan_to_null
    df = spark.createDataFrame([(float("nan"),), (1.0,)], "x double")
    assert [r[0] for r in df.select(nan_to_null(F.col("x"))).collect()] == [None, 1.0]


def test_escalation_never_lowers_and_alerts_disjoint_from_improvements(spark):
    from metricwatch.plans import derived
    a = derived.alerts(spark, "/root/testdata/sf0.001")
    dup = a.groupBy("asin", "date", "metric").count().filter("count > 1").count()
    assert dup == 0
    assert a.filter(F.abs("z_score") > 13 / math.sqrt(14) + 1e-6).count() == 0


def test_conversion_drop_floor_fires(spark):
    got = REGISTRY["floor_conversion_drop"](spark, "/root/testdata/sf0.001")
    rows = {r["triggered_by"]: r["count"] for r in got.groupBy("triggered_by").count().collect()}
    assert rows["absolute_threshold"] > 0


def test_flags_beside_alerts_equal_the_join(spark):
    rows = [("A", "2025-01-01", "sales", "critical"), ("A", "2025-01-01", "margin", "watch"),
            ("A", "2025-01-01", "acos", "improvement"), ("B", "2025-01-01", "sales", "improvement"),
            ("A", "2025-01-02", "tacos", "warning")]
    df = spark.createDataFrame(rows, "asin string, date string, metric string, severity string")
    joined = df.join(AL.cross_metric_flags(df), ["date", "asin"], "left").select(*df.columns, "flags")
    got = sorted(map(tuple, AL.with_flags(df).select(*df.columns, "flags").collect()), key=str)
    assert got == sorted(map(tuple, joined.collect()), key=str)
    assert ("B", "2025-01-01", "sales", "improvement", None) in got
