"""Time-chunked baselines and one-day detection from a state equal the plain plans."""

import datetime as dt
import random
import re

import pytest
from pyspark.sql import functions as F

from metricwatch.config import DEFAULT
from metricwatch.operators import chunked as C
from metricwatch.operators import detect as D
from metricwatch.operators import state as S

METRICS = ["sales", "acos", "margin"]
START = dt.date(2023, 11, 20)


def random_master(spark, seed, days=800, products=6):
    """Products with gaps, NaN, nulls, long zero runs, one with a handful of rows and one with a single row."""
    rng, rows = random.Random(seed), []
    for p in range(products):
        zero, chance = 0, (0.97, 0.6, 0.15, 0.03, 0.9, 0.01)[p % 6]
        for i in range(days):
            if rng.random() > chance:
                continue
            zero = max(0, zero - 1) or (rng.choice([0, 0, 0, 0, 0, 40]) if p % 2 else 0)
            units = 0.0 if zero or rng.random() < 0.1 else float(rng.randint(1, 9))
            rows.append((f"P{p}", START + dt.timedelta(days=i), rng.choice([None, float("nan"), *[100 * rng.random()] * 9]),
                         rng.random() * 0.6, rng.random() - 0.2, rng.choice([units, units, units, None]), p == 0))
    rows.append(("ONE", START, 1.0, 0.1, 0.2, 0.0, False))
    return spark.createDataFrame(rows, "asin string, date date, sales double, acos double, margin double, units double, is_hero boolean")


def as_rows(df):
    return sorted(map(str, df.collect()))


@pytest.mark.parametrize("seed, chunk_days, exclude", [(1, 366, False), (2, 30, False), (3, 7, True), (4, 2, False)])
def test_chunked_baselines_equal_the_plain_windows(spark, seed, chunk_days, exclude):
    cfg = DEFAULT.with_(exclude_current=exclude)
    master = random_master(spark, seed)
    plain, cut = D.baselines(master, cfg, METRICS), C.chunked_baselines(master, cfg, METRICS, chunk_days=chunk_days)
    assert set(cut.columns) == set(plain.columns)
    got, want = as_rows(cut.select(*plain.columns)), as_rows(plain)
    assert got == want and len(got) == master.count()


def test_a_long_history_is_spread_over_tasks(spark):
    """No window of the chunked plan is partitioned by the product alone, but for the table of chunks."""
    plan = C.chunked_baselines(random_master(spark, 5), DEFAULT, METRICS)._jdf.queryExecution().optimizedPlan().toString()
    alone = [line for line in plan.splitlines() if "Window [" in line and "_chunk" not in line]
    assert all("max(_hi" in line for line in alone)


def test_days_from_the_state_equal_the_filtered_history(spark, tmp_dir):
    master = random_master(spark, 7)
    days = [r["date"] for r in master.select("date").distinct().orderBy("date").collect()]
    S.write_master(master, tmp_dir)
    S.start_state(spark, tmp_dir, days[-6], DEFAULT)
    for before, day in zip(days[-6:], days[-5:]):
        got = S.run_day(spark, tmp_dir, day, before, DEFAULT)
        want = D.detect(master.filter(F.col("date") <= F.lit(day)), DEFAULT, METRICS).filter(F.col("date") == F.lit(day))
        assert as_rows(got) == as_rows(want.select(*got.columns))
    end = spark.read.parquet(f"{tmp_dir}/state/day={days[-1]}")
    fresh = S.state_of(spark.read.parquet(f"{tmp_dir}/master").drop("month"), DEFAULT)
    assert as_rows(end.select(*fresh.columns)) == as_rows(fresh)


def test_a_days_run_reads_its_day_and_one_week_of_the_year_before(spark, tmp_dir):
    master = random_master(spark, 8)
    S.write_master(master, tmp_dir)
    day = dt.date(2026, 1, 20)
    S.start_state(spark, tmp_dir, day - dt.timedelta(days=1), DEFAULT)
    alerts = S.run_day(spark, tmp_dir, day, day - dt.timedelta(days=1))
    plan = alerts._jdf.queryExecution().executedPlan().toString()
    assert set(re.findall(r"PartitionFilters: \[.*?(\d{4}-\d\d(?:,\d{4}-\d\d)*)", plan)) == {"2026-01", "2025-01"}
    edge = S.read_days(spark, tmp_dir, dt.date(2024, 2, 27), dt.date(2024, 3, 4))
    plan = edge._jdf.queryExecution().executedPlan().toString()
    assert "month#" in plan.split("PartitionFilters: [")[1].split("]")[0] and "PushedFilters: [" in plan
    assert as_rows(edge) == as_rows(master.filter("date between '2024-02-27' and '2024-03-04'").select(*edge.columns))


def test_the_year_before():
    assert S.year_before(dt.date(2024, 2, 29)) == dt.date(2023, 2, 28) and S.year_before(dt.date(2025, 3, 1)) == dt.date(2024, 3, 1)
