"""Baselines against a direct pandas computation of the same definitions on random series."""

import datetime as dt
import math

import numpy as np
import pandas as pd
import pytest

from metricwatch.config import DEFAULT
from metricwatch.operators import detect as D


def _random_master(seed):
    rng = np.random.default_rng(seed)
    rows = []
    for a in range(3):
        day = dt.date(2022, 12, 20) + dt.timedelta(days=int(rng.integers(0, 5)))
        for _ in range(int(rng.integers(380, 460))):
            day += dt.timedelta(days=int(rng.choice([1, 1, 1, 2, 5])))
            v = float(rng.normal(100, 15))
            units = float(rng.choice([0.0, 0.0, 3.0, 7.0]))
            rows.append((f"P{a}", day, None if rng.random() < 0.08 else round(v, 3), units))
    return pd.DataFrame(rows, columns=["asin", "date", "sales", "units"])


def _expected(pdf, cfg=DEFAULT):
    out = []
    for asin, g in pdf.sort_values("date").groupby("asin"):
        g = g.reset_index(drop=True)
        roll = g["sales"].rolling(cfg.rolling_window, min_periods=cfg.rolling_min_periods)
        g["mean"], g["std"] = roll.mean(), roll.std()
        span = (g["date"].max() - g["date"].min()).days
        lookup = dict(zip(g["date"], g["sales"]))
        yoy = []
        for d in g["date"]:
            if span < cfg.min_history_days:
                yoy.append(None)
                continue
            c = (pd.Timestamp(d) - pd.DateOffset(years=1)).date()
            vals = [lookup.get(c + dt.timedelta(days=k)) for k in range(-3, 4)]
            vals = [v for v in vals if v is not None and not math.isnan(v)]
            yoy.append(sum(vals) / len(vals) if vals else None)
        g["yoy"] = yoy
        run, cur = [], 0
        for u in g["units"]:
            cur = cur + 1 if u == 0 else 0
            run.append(cur)
        g["run"] = run
        out.append(g)
    return pd.concat(out)


def _close(a, b, tol):
    if a is None or (isinstance(a, float) and math.isnan(a)):
        return b is None or (isinstance(b, float) and math.isnan(b))
    return b is not None and abs(a - b) <= tol * max(1.0, abs(a))


@pytest.mark.parametrize("seed", [1, 2])
def test_baselines_match_direct_computation(spark, seed):
    pdf = _random_master(seed)
    sdf = spark.createDataFrame(pdf, "asin string, date date, sales double, units double")
    got = {(r["asin"], r["date"]): r for r in D.baselines(sdf, DEFAULT, ["sales"]).collect()}
    exp = _expected(pdf)
    assert len(got) == len(exp)
    for _, e in exp.iterrows():
        g = got[(e["asin"], e["date"])]
        assert _close(e["mean"], g["sales_roll_mean"], 1e-6)
        assert _close(e["std"], g["sales_roll_std"], 1e-4)
        assert _close(e["yoy"], g["sales_yoy_mean"], 1e-6)
        assert g["zero_run"] == e["run"]


def test_window_yoy_equals_join_yoy(spark):
    from metricwatch.operators.baselines import with_yoy, with_yoy_window
    pdf = _random_master(7)
    sdf = spark.createDataFrame(pdf, "asin string, date date, sales double, units double")
    a = {(r["asin"], r["date"]): r["sales_yoy_mean"] for r in with_yoy_window(sdf, ["sales"], DEFAULT).collect()}
    b = {(r["asin"], r["date"]): r["sales_yoy_mean"] for r in with_yoy(sdf, ["sales"], DEFAULT).collect()}
    assert a.keys() == b.keys()
    assert all(_close(a[k], b[k], 1e-9) for k in a)
