"""Distinct counts from bitmaps equal counts of the rows."""

import datetime as dt
import random

from pyspark.sql import functions as F

from metricwatch.operators import backtest as B
from metricwatch.operators import distinct as D

DAY = dt.date(1969, 12, 1)        # day numbers below and above 0 lie in different buckets


def alerts(spark, n=4000, products=300):
    rng = random.Random(5)
    rows = [(DAY + dt.timedelta(days=rng.choice([rng.randint(0, 70), rng.randint(0, 400)])), rng.choice([None, f"P{rng.randint(0, products)}"]),
             rng.choice(["critical", "watch"])) for _ in range(n)]
    return spark.createDataFrame(rows + [(None, "P1", "watch"), (DAY - dt.timedelta(days=90), None, "watch")],
                                 "date date, asin string, severity string").repartition(5)


def test_products_of_trailing_days(spark):
    a = alerts(spark)
    rows = [(r["date"], r["asin"]) for r in a.collect() if r["date"]]
    got = {r["date"]: (r["n_asins_1"], r["n_asins_7"], r["n_asins_30"]) for r in D.trailing_products(a).collect()}
    want = {d: tuple(len({p for e, p in rows if p and 0 <= (d - e).days < w}) for w in (1, 7, 30)) for d, _ in rows}
    assert got == want and got[DAY - dt.timedelta(days=90)] == (0, 0, 0)
    assert D.trailing_products(a.limit(0)).count() == 0


def test_bitmaps_span_buckets_and_merge(spark):
    df = spark.range(0, 100_000, 3).select((F.col("id") - 40_000).alias("k"), (F.col("id") % 7).alias("g"))
    df = df.unionAll(df).unionAll(spark.range(1).select(F.lit(None).cast("long"), F.lit(0).cast("long")))
    bits = D.bitmaps(df, F.col("k"), ["g"])
    assert {r["g"]: r["n"] for r in D.count(bits, ["g"]).collect()} == {
        r["g"]: r["n"] for r in df.groupBy("g").agg(F.countDistinct("k").alias("n")).collect()}
    assert D.count(D.merge(bits)).first()["n"] == df.select(F.countDistinct("k")).first()[0]
    assert D.count(D.merge(bits.limit(0))).first()["n"] == 0


def test_date_range_without_expand(spark):
    a = alerts(spark).filter("date is not null")
    df = B.date_range(a)
    newest = a.agg(F.max("date")).first()[0]
    days = {r["date"] for r in a.select("date").collect()}
    cut = newest - dt.timedelta(days=B.DEFAULT.lookback_days)
    r = df.first()
    assert (r["n_days"], r["n_days_lookback"]) == (len(days), sum(d >= cut for d in days))
    assert (r["first_date"], r["last_date"], r["n_alerts"]) == (min(days), newest, a.count())
    assert "Expand" not in df._jdf.queryExecution().executedPlan().toString()
    empty = B.date_range(a.limit(0)).first()
    assert empty["n_days"] == 0 and empty["n_days_lookback"] == 0 and empty["first_date"] is None
