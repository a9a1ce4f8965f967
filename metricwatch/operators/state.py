"""Detection of one day from a state.

A run over day D needs of the past only, per product: its last rows (one frame less the current row), the length of its
zero run, its first and last day, and the week one year before D. The state holds all but the week, which is read from
the master by its month partitions. So a day's run reads the state and the months of day D and of that week, however
long the history; the frames it scores hold the same rows in the same order as those of a full run.

    <folder>/master/month=<yyyy-MM>/...     the master, sorted by day
    <folder>/state/day=<day>/...            the state after that day

A run writes the state after D as a partition of its own; running D again reads the state before D and overwrites it.
"""

from __future__ import annotations

import datetime as dt
from typing import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import DEFAULT, Config
from ..functions.exprs import nan_to_null
from .baselines import with_rolling, with_yoy_deviation, with_yoy_window
from .detect import OPTIONAL_INPUTS, ensure_columns, present_metrics, to_long, with_floors, with_severities


def _prepared(rows: DataFrame, metrics: Sequence[str]) -> DataFrame:
    df = ensure_columns(rows, OPTIONAL_INPUTS)
    return df.withColumns({c: nan_to_null(F.col(c).cast("double")) for c in [*metrics, "units", "available_units"]})


def _tail_rows(cfg: Config) -> int:
    return cfg.rolling_window if cfg.exclude_current else cfg.rolling_window - 1


def _row(metrics: Sequence[str]) -> Column:
    return F.struct("date", *metrics)


def state_of(history: DataFrame, cfg: Config = DEFAULT, metrics: Sequence[str] | None = None) -> DataFrame:
    """The state after ``history``: (asin, first_day, last_day, n_rows, last_with_units, tail); one pass, to start from.

    The zero run is ``n_rows - last_with_units``: rows since the last one with units."""
    metrics = list(metrics or present_metrics(history))
    df = _prepared(history, metrics)
    w = Window.partitionBy("asin").orderBy("date")
    df = df.withColumn("_rn", F.row_number().over(w)).withColumn("_left", F.row_number().over(
        Window.partitionBy("asin").orderBy(F.desc("date"))))
    sold = F.coalesce(F.col("units"), F.lit(0.0)) != 0
    return df.groupBy("asin").agg(
        F.min("date").alias("first_day"), F.max("date").alias("last_day"), F.count("*").alias("n_rows"),
        F.coalesce(F.max(F.when(sold, F.col("_rn"))), F.lit(0)).cast("long").alias("last_with_units"),
        F.array_sort(F.collect_list(F.when(F.col("_left") <= _tail_rows(cfg), _row(metrics)))).alias("tail"))


def day_alerts(day_rows: DataFrame, week: DataFrame, state: DataFrame, cfg: Config = DEFAULT,
               metrics: Sequence[str] | None = None) -> DataFrame:
    """Alerts and improvements of the rows of one day: ``week`` are the rows one year before it, ``state`` that before it."""
    metrics = list(metrics or present_metrics(day_rows))
    df = _prepared(day_rows, metrics)
    columns = df.columns
    j = df.join(state, "asin", "left")
    sold = F.coalesce(F.col("units"), F.lit(0.0)) != 0
    before = F.coalesce(F.col("n_rows"), F.lit(0)) - F.coalesce(F.col("last_with_units"), F.lit(0))
    first = F.least("first_day", "date")
    last = F.greatest("last_day", "date")
    now = j.withColumn("zero_run", F.when(sold, F.lit(0)).otherwise(before + 1).cast("int")).withColumn(
        "yoy_available", F.datediff(last, first) >= F.lit(cfg.min_history_days)).withColumn("_today", F.lit(True))
    now = now.select(*columns, "zero_run", "yoy_available", "_today")
    # of the past only the key, the day and the metrics; a young product's tail may hold last year's week too
    tail = j.select("asin", F.inline("tail"))
    past = tail.unionByName(_prepared(week, metrics).select("asin", "date", *metrics).join(
        j.select("asin"), "asin", "left_semi")).dropDuplicates(["asin", "date"])
    both = now.unionByName(past.withColumn("_today", F.lit(False)), allowMissingColumns=True)
    both = with_rolling(both, metrics, cfg)
    both = with_yoy_window(both, metrics, cfg).filter("_today").drop("_today")
    scored = with_floors(with_severities(with_yoy_deviation(both, metrics, cfg), metrics, cfg), metrics, cfg)
    return to_long(scored, metrics, cfg)


def next_state(day_rows: DataFrame, state: DataFrame, cfg: Config = DEFAULT, metrics: Sequence[str] | None = None) -> DataFrame:
    """The state after the rows of a day (one per product): products without a row keep theirs."""
    metrics = list(metrics or present_metrics(day_rows))
    df = _prepared(day_rows, metrics).select("asin", F.col("date").alias("_day"), _row(metrics).alias("_row"),
                                             (F.coalesce(F.col("units"), F.lit(0.0)) != 0).alias("_sold"))
    j = state.join(df, "asin", "full")
    has, n = F.col("_row").isNotNull(), F.coalesce(F.col("n_rows"), F.lit(0))
    rows = F.concat(F.coalesce(F.col("tail"), F.array().cast(state.schema["tail"].dataType)), F.array("_row"))
    size = _tail_rows(cfg)
    return j.select(
        "asin", F.least("first_day", "_day").alias("first_day"), F.greatest("last_day", "_day").alias("last_day"),
        F.when(has, n + 1).otherwise(n).alias("n_rows"),
        F.when(has & F.col("_sold"), n + 1).otherwise(F.coalesce(F.col("last_with_units"), F.lit(0))).alias("last_with_units"),
        F.when(has, F.slice(rows, F.greatest(F.size(rows) - size + 1, F.lit(1)), size)).otherwise(F.col("tail")).alias("tail"))


def _month(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM")


def write_master(master: DataFrame, folder: str, files: int = 1) -> None:
    """The master as a table with a partition per month, sorted by day, so that readers of a week skip the row groups of
    other weeks. Months that are written again are replaced; each is written by ``files`` tasks."""
    rows = master.withColumn("month", _month(F.col("date")))
    dealt = rows.repartition("month", F.pmod(F.xxhash64("asin"), F.lit(files))) if files > 1 else rows.repartition("month")
    dealt.sortWithinPartitions("month", "date").write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic").partitionBy("month").parquet(f"{folder}/master")


def read_days(spark: SparkSession, folder: str, first: dt.date, last: dt.date) -> DataFrame:
    """The master's rows from ``first`` to ``last``: only the partitions of their months, days by row-group statistics."""
    months = sorted({(first + dt.timedelta(days=i)).strftime("%Y-%m") for i in range((last - first).days + 1)})
    rows = spark.read.schema(_schema(spark, folder)).parquet(f"{folder}/master").filter(F.col("month").isin(months))
    return rows.filter((F.col("date") >= F.lit(first)) & (F.col("date") <= F.lit(last))).drop("month")


def _schema(spark: SparkSession, folder: str):
    """The master's schema, with months as text (2024-01 would be read as a number or a date otherwise)."""
    fields = [f for f in spark.read.parquet(f"{folder}/master").schema.fields if f.name != "month"]
    return T.StructType([*fields, T.StructField("month", T.StringType())])


def start_state(spark: SparkSession, folder: str, day: dt.date, cfg: Config = DEFAULT) -> None:
    """Write the state after all days up to ``day``, from the whole master: once, before daily runs."""
    history = spark.read.parquet(f"{folder}/master").drop("month").filter(F.col("date") <= F.lit(day))
    state_of(history, cfg).write.mode("overwrite").parquet(f"{folder}/state/day={day}")


def run_day(spark: SparkSession, folder: str, day: dt.date, previous: dt.date, cfg: Config = DEFAULT) -> DataFrame:
    """Score ``day`` with the state after ``previous`` (the run before it) and write the state after ``day``; its alerts."""
    half, back = cfg.yoy_window // 2, year_before(day)
    rows = read_days(spark, folder, day, day)
    week = read_days(spark, folder, back - dt.timedelta(days=half), back + dt.timedelta(days=half))
    state = spark.read.parquet(f"{folder}/state/day={previous}")
    next_state(rows, state, cfg).write.mode("overwrite").parquet(f"{folder}/state/day={day}")
    return day_alerts(rows, week, state, cfg)


def year_before(day: dt.date) -> dt.date:
    """One calendar year back; 29 February has 28 February before it."""
    return day.replace(year=day.year - 1, day=28) if (day.month, day.day) == (2, 29) else day.replace(year=day.year - 1)
