"""Plan shape, the driver contract and Spark-vs-DuckDB agreement on the smallest tables."""

import math

import duckdb
import pytest
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events".split()


def _final_plan(df):
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString()


def test_entry_runs(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.count() > 0
    assert set(E.oracle_sql()) <= set(E.queries())


def test_detection_shuffles_once_on_the_product_key(spark):
    from metricwatch.config import fixture_config
    from metricwatch.operators import detect as D
    from metricwatch.plans import derived
    cfg = fixture_config()
    m = derived.master(spark, SF, cfg)
    plan_m = _final_plan(m)
    plan_d = _final_plan(D.detect(m, cfg))
    assert "CartesianProduct" not in plan_d and "BroadcastNestedLoopJoin" not in plan_d
    # detection adds no exchange on top of what building the master needs
    assert plan_d.count("Exchange hashpartitioning") <= plan_m.count("Exchange hashpartitioning")
    assert "Exchange hashpartitioning(asin" in plan_d


def test_filters_and_columns_reach_the_scan(spark):
    from metricwatch.sources import fixtures as FX
    plan = FX.returns_raw(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(l_returnflag), EqualTo(l_returnflag,R)" in plan
    assert "ReadSchema: struct<l_partkey:bigint,l_quantity:double,l_returnflag:string,l_shipdate:timestamp_ntz>" in plan


def test_detect_day_equals_anchor_of_full_detect(spark):
    from metricwatch.config import fixture_config
    from metricwatch.operators import detect as D
    from metricwatch.plans import derived
    cfg = fixture_config()
    m = derived.master(spark, SF, cfg)
    full = D.detect(m, cfg)
    for day in [r[0] for r in m.select("date").distinct().orderBy(F.col("date").desc()).limit(3).collect()]:
        a = sorted(map(tuple, full.filter(F.col("date") == day).collect()), key=str)
        b = sorted(map(tuple, D.detect_day(m, day, cfg).select(*full.columns).collect()), key=str)
        assert a == b


def _norm(v):
    return repr(v) if isinstance(v, float) and not math.isnan(v) else (None if isinstance(v, float) else v)


@pytest.mark.parametrize("name", ["detect", "rolling_flags", "yoy_baseline", "absolute_overrides", "alert_caps",
                                  "top_alerts", "explanations", "digest", "backtest_daily", "backtest_by_tier",
                                  "std_sales", "dedup_keep_last", "returns_agg", "merge_sources", "snapshot_detect",
                                  "all_alerts", "inventory_scan_fallback", "threshold_join"])
def test_matches_duckdb_oracle(spark, name):
    import __spark_entry__ as E
    df = E.queries()[name](spark, SF)
    cols = sorted(df.columns)
    got = sorted((tuple(_norm(r[c]) for c in cols) for r in df.collect()), key=str)
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    cur = con.execute(E.oracle_sql()[name])
    names = [d[0] for d in cur.description]
    assert sorted(names) == cols
    idx = [names.index(c) for c in cols]
    want = sorted((tuple(_norm(r[i]) for i in idx) for r in cur.fetchall()), key=str)
    assert got == want


def test_invariants_on_the_fixture(spark):
    from metricwatch.config import fixture_config
    from metricwatch.operators import alerts as AL
    from metricwatch.operators import detect as D
    from metricwatch.plans import derived
    cfg = fixture_config()
    m = derived.master(spark, SF, cfg)
    assert m.count() == m.select("asin", "date").distinct().count()          # master key unique
    a = D.detect(m, cfg)
    caps = AL.capped(a, cfg).groupBy("date", "severity").count().collect()
    assert all(r["count"] <= cfg.caps[r["severity"]] for r in caps)         # caps hold per day
    # escalation never lowers: the final severity is at least the statistical one
    w = D.scored(m, cfg)
    for mname in ("return_rate", "margin", "sales", "acos"):
        lowered = w.filter(F.col(f"{mname}_roll_sev").isNotNull() & F.col(f"{mname}_sev").isNotNull()
                           & (F.col(f"{mname}_sev") < F.col(f"{mname}_roll_sev")))
        assert lowered.count() == 0


def test_day_filter_stays_above_the_windows(spark):
    from metricwatch.config import fixture_config
    from metricwatch.operators import detect as D
    from metricwatch.plans import derived
    cfg = fixture_config()
    day = D.anchor_filter(D.detect(derived.master(spark, SF, cfg), cfg), "1998-08-02")
    plan = day._jdf.queryExecution().optimizedPlan().toString()
    lines = plan.splitlines()
    first_window = min(i for i, l in enumerate(lines) if "Window [" in l)
    filters = [i for i, l in enumerate(lines) if "Filter" in l and "1998-08-02" in l]
    assert filters and all(i < first_window for i in filters)
