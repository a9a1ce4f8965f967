"""Registry of named queries: ``name -> f(spark, sf_dir) -> DataFrame``.

Each query reads the driver tables (through ``plans.derived`` /
``sources.fixtures``) over their whole extent.
"""

from __future__ import annotations

import uuid
from datetime import timedelta
from typing import Callable, Dict, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .config import DETECTION_METRICS, conversion_drop_config, fixture_config
from .functions import exprs as X
from .functions.exprs import rank_label
from .operators import alerts as AL
from .operators import backtest as BT
from .operators import chunked as CH
from .operators import detect as D
from .operators import distinct as DC
from .operators import master as MS
from .operators import snapshot as SN
from .operators import standardize as ST
from .operators import state as DS
from .plans import derived
from .session import checkpoint_dir, warehouse_checkpoints
from .sources import files as FL
from .sources import fixtures as FX
from .sources import store as ST_

CFG = fixture_config()
M = list(DETECTION_METRICS)
REGISTRY: Dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def finish(df: DataFrame) -> DataFrame:
    """Output as is: doubles are exact fixture arithmetic or statistics already
    rounded on a fixed grid inside the plan (``Config.stat_digits``)."""
    return df


def query(name: str):
    def deco(fn):
        REGISTRY[name] = lambda spark, sf_dir, _fn=fn: finish(_fn(spark, sf_dir))
        REGISTRY[name].__doc__ = fn.__doc__
        return fn
    return deco


def _long(wide: DataFrame, metrics: Sequence[str], cols: Dict[str, str], keep: str) -> DataFrame:
    """Stack per-metric columns ``<m><suffix>`` into rows; keep rows where ``keep`` is not NULL."""
    structs = [F.struct(F.lit(m).alias("metric"),
                        *[F.col(f"{m}{suf}").alias(out) for out, suf in cols.items()]) for m in metrics]
    return wide.select("asin", "date", F.inline(F.array(*structs))).filter(F.col(keep).isNotNull())


# ------------------------------------------------------------------ detection (D*, W*)

def _baselines(spark, sf_dir):
    return D.baselines(derived.master(spark, sf_dir, CFG), CFG, M)


@query("detect")
def q_detect(spark, sf_dir):
    """D21 flagship: all alerts and improvements over the whole history."""
    return derived.alerts(spark, sf_dir, CFG)


@query("rolling_baseline")
def q_rolling_baseline(spark, sf_dir):
    """14-row rolling mean and sample std per metric (min 7 non-null)."""
    b = _baselines(spark, sf_dir)
    return b.select("asin", "date", *[c for m in M for c in (f"{m}_roll_mean", f"{m}_roll_std")])


@query("chunked_baseline")
def q_chunked_baseline(spark, sf_dir):
    """The rolling, year-over-year and zero-run baselines from windows cut into chunks of a year."""
    b = CH.chunked_baselines(derived.master(spark, sf_dir, CFG), CFG, M)
    return b.select("asin", "date", "zero_run", "yoy_available", *[c for m in M for c in (f"{m}_roll_mean", f"{m}_roll_std", f"{m}_yoy_mean")])


@query("rolling_zscore")
def q_rolling_zscore(spark, sf_dir):
    """Z against the rolling baseline; std 0 -> NULL."""
    return _baselines(spark, sf_dir).select("asin", "date", *[f"{m}_roll_zscore" for m in M])


def _sev_raw(spark, sf_dir):
    return D.with_severities(_baselines(spark, sf_dir), M, CFG, suppress=False)


@query("rolling_flags")
def q_rolling_flags(spark, sf_dir):
    """Rolling severity per metric (direction-aware), flagged rows only."""
    w = _sev_raw(spark, sf_dir)
    w = w.select("asin", "date", *[c for m in M for c in (F.col(f"{m}_roll_zscore"),
                                                          rank_label(F.col(f"{m}_roll_sev")).alias(f"{m}_rsev"))])
    return _long(w, M, {"z_score": "_roll_zscore", "severity": "_rsev"}, "severity")


@query("yoy_baseline")
def q_yoy_baseline(spark, sf_dir):
    """Same-week-last-year mean per metric, span gate."""
    return _baselines(spark, sf_dir).select("asin", "date", "yoy_available", *[f"{m}_yoy_mean" for m in M])


@query("yoy_deviation")
def q_yoy_deviation(spark, sf_dir):
    """D3: (x - yoy) / |yoy|."""
    return _baselines(spark, sf_dir).select("asin", "date", *[f"{m}_yoy_deviation" for m in M])


@query("yoy_flags")
def q_yoy_flags(spark, sf_dir):
    """YoY severity before suppressors, flagged rows only."""
    w = _sev_raw(spark, sf_dir)
    w = w.select("asin", "date", *[c for m in M for c in (F.col(f"{m}_yoy_deviation"),
                                                          rank_label(F.col(f"{m}_yoy_sev")).alias(f"{m}_ysev"))])
    return _long(w, M, {"yoy_deviation": "_yoy_deviation", "severity": "_ysev"}, "severity")


@query("yoy_suppressed")
def q_yoy_suppressed(spark, sf_dir):
    """YoY flags and what is left of them after the three suppressors."""
    b = _baselines(spark, sf_dir)
    raw = D.with_severities(b, M, CFG, suppress=False)
    sup = {}
    for m in M:
        sup.update({f"{m}_ysup": D.severity_columns(m, CFG.with_(acos_min_daily_sales=None), True)[f"{m}_yoy_sev"]})
    w = raw.select("asin", "date", *[c for m in M for c in (
        rank_label(F.col(f"{m}_yoy_sev")).alias(f"{m}_yraw"), rank_label(sup[f"{m}_ysup"]).alias(f"{m}_ykept"))])
    return _long(w, M, {"severity_raw": "_yraw", "severity": "_ykept"}, "severity_raw")


@query("acos_low_sales")
def q_acos_low_sales(spark, sf_dir):
    """Acos severities cleared on low-sales days."""
    b = _baselines(spark, sf_dir)
    raw = D.severity_columns("acos", CFG, suppress=False)
    kept = D.severity_columns("acos", CFG, suppress=True)
    low = F.col("sales") < F.lit(CFG.acos_min_daily_sales)
    return b.filter(low & (raw["acos_roll_sev"].isNotNull() | raw["acos_yoy_sev"].isNotNull())).select(
        "asin", "date", "sales", F.col("acos").alias("actual_value"),
        rank_label(raw["acos_roll_sev"]).alias("roll_severity_raw"), rank_label(raw["acos_yoy_sev"]).alias("yoy_severity_raw"),
        rank_label(kept["acos_roll_sev"]).alias("roll_severity"), rank_label(kept["acos_yoy_sev"]).alias("yoy_severity"))


@query("combined_severity")
def q_combined_severity(spark, sf_dir):
    """More severe of rolling and YoY, with triggered_by."""
    w = D.with_severities(_baselines(spark, sf_dir), M, CFG)
    w = w.select("asin", "date", *[c for m in M for c in (rank_label(F.col(f"{m}_sev")).alias(f"{m}_s"), F.col(f"{m}_trig"))])
    return _long(w, M, {"severity": "_s", "triggered_by": "_trig"}, "severity")


@query("zero_run_length")
def q_zero_run_length(spark, sf_dir):
    """Length of the current run of zero-unit rows."""
    return _baselines(spark, sf_dir).select("asin", "date", "units", "zero_run")


def _floor_query(only, metrics, cfg=CFG):
    def run(spark, sf_dir):
        w = D.with_floors(D.with_severities(_baselines(spark, sf_dir), M, cfg), M, cfg, only=only)
        w = w.select("asin", "date", *[c for m in metrics for c in (rank_label(F.col(f"{m}_sev")).alias(f"{m}_s"),
                                                                    F.col(f"{m}_trig"))])
        return _long(w, metrics, {"severity": "_s", "triggered_by": "_trig"}, "severity")
    return run


for _name, _only, _ms in (("floor_return_rate", ["return_rate"], ["return_rate"]),
                          ("floor_margin", ["margin"], ["margin"]),
                          ("floor_zero_sales", ["zero_sales"], ["sales"]),
                          ("floor_acos_spike", ["acos_spike"], ["acos"]),
                          ("acos_gate", ["acos_spike", "acos_clear"], ["acos"])):
    query(_name)(_floor_query(_only, _ms))

query("floor_conversion_drop")(_floor_query(["conversion_drop"], ["conversion_rate"], conversion_drop_config()))


@query("absolute_overrides")
def q_absolute_overrides(spark, sf_dir):
    """Severities and triggers of every metric after all floors, one row per (asin, date)."""
    w = D.scored(derived.master(spark, sf_dir, CFG), CFG, M)
    return w.select("asin", "date", *[c for m in M for c in (rank_label(F.col(f"{m}_sev")).alias(f"{m}_severity"),
                                                             F.col(f"{m}_trig").alias(f"{m}_triggered_by"))])


@query("long_alerts")
def q_long_alerts(spark, sf_dir):
    """Long-format alerts (no improvements)."""
    return D.to_long(D.scored(derived.master(spark, sf_dir, CFG), CFG, M), M, CFG, improvements=False)


@query("improvements")
def q_improvements(spark, sf_dir):
    """Improvements only."""
    return D.to_long(D.scored(derived.master(spark, sf_dir, CFG), CFG, M), M, CFG, alerts=False)


@query("yoy_available")
def q_yoy_available(spark, sf_dir):
    """A4: history span per product and YoY eligibility."""
    m = derived.master(spark, sf_dir, CFG)
    return m.groupBy("asin").agg(F.datediff(F.max("date"), F.min("date")).alias("span_days")).select(
        "asin", "span_days", (F.col("span_days") >= CFG.min_history_days).alias("yoy_available"))


@query("detect_day")
def q_detect_day(spark, sf_dir):
    """One day's alerts (newest day of the feed)."""
    m = derived.master(spark, sf_dir, CFG)
    return D.detect_day(m, None, CFG, M)


# ------------------------------------------------------------------ alerts, digest (P13–P16, W7, O*, E*, A8–A9)



def _materialized(spark, df):
    """Cut lineage with a reliable checkpoint into the shared folder."""
    checkpoint_dir(spark, fallback=warehouse_checkpoints(spark))
    return df.checkpoint(eager=True)


def _alerts(spark, sf_dir):
    return derived.alerts(spark, sf_dir, CFG)


def _capped(spark, sf_dir):
    return AL.capped(_alerts(spark, sf_dir), CFG)


def _flags(day_alerts):
    return AL.cross_metric_flags(day_alerts)


@query("detect_day_state")
def q_detect_day_state(spark, sf_dir):
    """D24 from state: the newest day scored from a state table, its own rows and one week of the year before."""
    folder = _folder(spark, "daily_runs")
    DS.write_master(derived.master(spark, sf_dir, CFG), folder)
    day = spark.read.parquet(f"{folder}/master").agg(F.max("date")).first()[0]
    DS.start_state(spark, folder, day - timedelta(days=1), CFG)
    return DS.run_day(spark, folder, day, day - timedelta(days=1), CFG)


@query("flagged_rows")
def q_flagged_rows(spark, sf_dir):
    """Rows with a severity (improvements stay)."""
    return D.flagged_rows(_alerts(spark, sf_dir))


@query("anchor_filter")
def q_anchor_filter(spark, sf_dir):
    """The alerts of the anchor day (newest alert day; the alerts are materialised once so
    the newest-day subquery does not rerun detection)."""
    return D.anchor_filter(_materialized(spark, _alerts(spark, sf_dir)))


@query("alert_suppress")
def q_alert_suppress(spark, sf_dir):
    """tier/severity suppression."""
    return AL.suppress(_alerts(spark, sf_dir), CFG)


@query("alert_caps")
def q_alert_caps(spark, sf_dir):
    """Per-day, per-severity caps in tier order (after P15)."""
    return _capped(spark, sf_dir)


@query("tier_sort")
def q_tier_sort(spark, sf_dir):
    """O1: display position of each digest row of a day in tier order (capped rows: a day's
    group is bounded by the caps)."""
    return AL.tier_sorted(_capped(spark, sf_dir)).select("date", "asin", "metric", "severity", "tier", "tier_rank", "position")


@query("top_alerts")
def q_top_alerts(spark, sf_dir):
    """O2: per day, the ten most severe capped alerts (criticals first, tier order)."""
    return AL.top_alerts(_capped(spark, sf_dir), CFG).select("date", "position", "asin", "metric", "severity", "tier")


@query("cross_metric_flags")
def q_cross_metric_flags(spark, sf_dir):
    """Per day and product, the flagged metrics of the capped alerts."""
    return _flags(_capped(spark, sf_dir))


_KEYS = ("date", "asin", "metric", "severity")


@query("fmt_value")
def q_fmt_value(spark, sf_dir):
    """Actual, rolling and YoY values in the metric's unit."""
    a = _alerts(spark, sf_dir)
    return a.select(*_KEYS, AL.fmt_value(F.col("actual_value"), F.col("metric")).alias("actual_fmt"),
                    AL.fmt_value(F.col("expected_value"), F.col("metric")).alias("expected_fmt"),
                    AL.fmt_value(F.col("yoy_baseline"), F.col("metric")).alias("yoy_fmt"))


@query("fmt_signed")
def q_fmt_signed(spark, sf_dir):
    """Signed deviation percent and signed z."""
    a = _alerts(spark, sf_dir)
    return a.select(*_KEYS, AL.fmt_deviation(F.col("yoy_deviation")).alias("deviation_fmt"),
                    AL.fmt_zscore(F.col("z_score")).alias("z_fmt"))


@query("display_expected")
def q_display_expected(spark, sf_dir):
    """The baseline shown next to an alert."""
    return _alerts(spark, sf_dir).select(*_KEYS, "triggered_by", AL.display_expected().alias("expected_display"))


@query("display_deviation")
def q_display_deviation(spark, sf_dir):
    """Actual minus shown baseline, in unit."""
    return _alerts(spark, sf_dir).select(*_KEYS, "triggered_by", AL.display_deviation().alias("deviation_display"))


@query("trigger_labels")
def q_trigger_labels(spark, sf_dir):
    """E5: trigger and tier labels."""
    return _alerts(spark, sf_dir).select(*_KEYS, AL.trigger_label(F.col("triggered_by")).alias("trigger_label"),
                                         AL.short_trigger(F.col("triggered_by")).alias("trigger_short"),
                                         AL.tier_label(F.col("tier")).alias("tier_label"))


def _with_flags(spark, sf_dir):
    return AL.with_flags(_capped(spark, sf_dir))


@query("pointed_reason")
def q_pointed_reason(spark, sf_dir):
    """Cross-metric hint per capped alert."""
    return _with_flags(spark, sf_dir).select(*_KEYS, AL.pointed_reason(F.col("flags")).alias("pointed_reason"))


@query("margin_impact")
def q_margin_impact(spark, sf_dir):
    """Daily lost-margin dollars for YoY margin alerts."""
    a = _alerts(spark, sf_dir)
    return a.select(*_KEYS, AL.margin_impact().alias("daily_margin_impact")).filter(F.col("daily_margin_impact").isNotNull())


@query("explanations")
def q_explanations(spark, sf_dir):
    """Plain-English sentence for each of the day's top alerts."""
    top = AL.top_alerts(_with_flags(spark, sf_dir), CFG)
    return top.select("date", "position", "asin", "metric", "severity", AL.explanation(F.col("flags")).alias("explanation"))


@query("digest_summary")
def q_digest_summary(spark, sf_dir):
    """Per-day counts of the capped digest."""
    return AL.digest_summary(_capped(spark, sf_dir))


@query("digest_subject")
def q_digest_subject(spark, sf_dir):
    """Per-day subject line."""
    s = AL.digest_summary(_capped(spark, sf_dir))
    return s.select("date", AL.subject(s, CFG).alias("subject"))


@query("section_rows")
def q_section_rows(spark, sf_dir):
    """Digest body order with tier-group heads."""
    return AL.section_rows(_capped(spark, sf_dir)).select(
        "date", "section", "row_in_section", "is_group_head", "severity", "tier", "asin", "metric")


@query("data_through")
def q_data_through(spark, sf_dir):
    """Data-through day per digest: the data day, else run day − 2."""
    days = _alerts(spark, sf_dir).select("date").distinct()
    run = F.date_add(F.col("date"), CFG.data_lag_days)
    return days.select("date", run.alias("run_date"), AL.data_through(F.col("date"), run, CFG).alias("data_through"),
                       AL.data_through(F.lit(None).cast("date"), run, CFG).alias("data_through_default"))


@query("digest")
def q_digest(spark, sf_dir):
    """One payload row per feed day; days without digest rows say 'No alerts today'."""
    lo, hi = FX.ship_day_bounds(spark, sf_dir)          # the feed's calendar (= master days)
    days = spark.range(1).select(F.explode(F.sequence(lo, hi)).alias("date"))
    s = AL.digest_summary(_capped(spark, sf_dir))
    j = days.join(s, "date", "left")
    rd = F.date_format("date", "yyyy-MM-dd")
    empty = F.coalesce(F.col("n_total"), F.lit(0)) == 0
    return j.select("date",
                    F.when(empty, AL.fill(AL.SENTENCES["no_alerts"], prefix=F.lit(CFG.subject_prefix), day=rd))
                    .otherwise(AL.subject(j, CFG)).alias("subject"),
                    F.coalesce(F.col("n_total"), F.lit(0)).alias("n_rows"),
                    F.coalesce(F.col("n_asins"), F.lit(0)).alias("n_asins"))


@query("digest_document")
def q_digest_document(spark, sf_dir):
    """The document of each feed day: subject, body, and the sizes of its nested parts."""
    lo, hi = FX.ship_day_bounds(spark, sf_dir)
    days = spark.range(1).select(F.explode(F.sequence(lo, hi)).alias("date"))
    d = AL.digest_documents(_capped(spark, sf_dir), days, CFG)
    n_rows = F.aggregate("sections", F.lit(0), lambda n, x: n + F.size(x["rows"]))
    return d.select("date", "subject", "data_through", "body", F.size("top").alias("n_top"), F.size("sections").alias("n_sections"),
                    n_rows.alias("n_rows"))


@query("severity_breakdown")
def q_severity_breakdown(spark, sf_dir):
    """Value counts of severity and of triggered_by over all alerts."""
    both = [F.struct(F.lit(c).alias("dimension"), F.col(c).alias("value")) for c in ("severity", "triggered_by")]
    return _alerts(spark, sf_dir).select(F.inline(F.array(*both))).groupBy("dimension", "value").agg(
        F.count(F.lit(1)).alias("n"))


@query("lookback_window")
def q_lookback_window(spark, sf_dir):
    """Alerts inside the 180-day look-back."""
    return BT.lookback(_materialized(spark, _alerts(spark, sf_dir)), CFG)


def _report_counts(spark, sf_dir):
    """Detection runs once: its small per-(day, dims) count table is materialised and
    every report (and the newest-day subquery inside it) folds that table."""
    return _materialized(spark, BT.report_counts(_alerts(spark, sf_dir)))


for _name, _fn in (("backtest_daily", BT.daily), ("backtest_daily_stats", BT.daily_stats),
                   ("backtest_verdict", BT.verdict), ("backtest_by_metric", BT.by_metric),
                   ("backtest_by_trigger", BT.by_trigger),
                   ("backtest_floor_audit", BT.floor_audit), ("backtest_range", BT.date_range)):
    query(_name)(lambda spark, sf_dir, _f=_fn: _f(_report_counts(spark, sf_dir), CFG))


@query("distinct_products")
def q_distinct_products(spark, sf_dir):
    """Products alerted per day and in the 7 and 30 days that end with it, from merged bitmaps."""
    return DC.trailing_products(_materialized(spark, _alerts(spark, sf_dir).select("date", "asin").distinct()))


@query("backtest_noisiest")
def q_backtest_noisiest(spark, sf_dir):
    """The ten products with most criticals over the look-back."""
    pre = _materialized(spark, BT.counts(_alerts(spark, sf_dir), ["asin", "tier"]))
    return BT.noisiest(pre, CFG)


@query("backtest_by_tier")
def q_backtest_by_tier(spark, sf_dir):
    """Criticals per tier with shares."""
    return BT.by_tier(_report_counts(spark, sf_dir), BT.tier_table(spark), CFG)


# ------------------------------------------------------------------ ingestion (S*, P*, A1, A6, W5)



@query("key_normalize")
def q_key_normalize(spark, sf_dir):
    """Trimmed, upper-cased keys of the raw sales export."""
    r = FX.sales_raw(spark, sf_dir)
    return r.select("_src_path", "_src_row", F.col("ASIN").alias("raw_key"), X.key_normalize(F.col("ASIN")).alias("asin"))


@query("date_parse_mdy")
def q_date_parse_mdy(spark, sf_dir):
    """Strict MM-dd-yyyy parse."""
    r = FX.sales_raw(spark, sf_dir)
    return r.select("_src_path", "_src_row", F.col("Date").alias("raw_date"), X.mdy_date(F.col("Date")).alias("date"))


@query("numeric_coerce")
def q_numeric_coerce(spark, sf_dir):
    """P5: tolerant numeric coercion (junk -> NULL)."""
    r = FX.sales_raw(spark, sf_dir)
    return r.select("_src_path", "_src_row", X.try_double(F.col("Sales")).alias("sales"),
                    X.try_double(F.col("Units")).alias("units"))


@query("pct_scale_normalize")
def q_pct_scale_normalize(spark, sf_dir):
    """Per-file ÷100 of rate columns whose max |value| exceeds 1."""
    n = ST.normalize_pct(FX.sales_raw(spark, sf_dir))
    return n.select("_src_path", "_src_row", *[X.try_double(F.col(c)).alias(ST.SALES_RENAME[c]) for c in ST.SALES_PCT_COLUMNS])


@query("std_sales")
def q_std_sales(spark, sf_dir):
    """The standardised sales feed (after S11), keyed rows only."""
    s = ST.standardize_sales(ST.normalize_pct(FX.sales_raw(spark, sf_dir)))
    return s.select("asin", "date", "sales", "units", "orders", "return_rate", "conversion_rate", "margin", "acos", "tacos",
                    "title", "_src_path", "_src_row")


@query("dedup_keep_last")
def q_dedup_keep_last(spark, sf_dir):
    """One row per (asin, date), the last in load order (re-exports win)."""
    s = ST.standardize_sales(ST.normalize_pct(FX.sales_raw(spark, sf_dir)))
    return ST.keep_last(s.select("asin", "date", "sales", "units", "acos", "_src_path", "_src_row"), ["asin", "date"])


def _folder(spark, name):
    """A fresh folder under the shared checkpoint folder."""
    base = checkpoint_dir(spark, fallback=warehouse_checkpoints(spark))
    return f"{base.rstrip('/')}/{name}_{uuid.uuid4().hex}"


@query("multi_file_union")
def q_multi_file_union(spark, sf_dir):
    """The sales exports written as CSV files and read back: outer union by column name of exports with different
    column sets (re-export files carry no Orders/Title columns)."""
    folder = _folder(spark, "sales_exports")
    FX.write_sales_exports(spark, sf_dir, folder)
    r = FL.read_csv_files(spark, FL.list_files(spark, folder))
    export = F.regexp_extract(F.element_at("_src_entry", 1), "export=(.*)", 1)
    return r.select(F.concat(F.lit("sales/"), export, F.lit(".csv")).alias("_src_path"), F.col("Line").cast("long").alias("_src_row"),
                    "ASIN", "Date", X.try_double(F.col("Sales")).alias("Sales"), X.try_double(F.col("Orders")).alias("Orders"), "Title")


def _order_exports(spark, sf_dir):
    """The order exports read back: rows and rejects."""
    folder = _folder(spark, "order_exports")
    FX.write_order_exports(spark, sf_dir, folder)
    return FL.read_exports(spark, FL.list_files(spark, folder, endings=(".txt",)))


def _export_no(path):
    return F.regexp_extract(path, r"file=(\d+)", 1).cast("long").alias("file")


@query("export_rows")
def q_export_rows(spark, sf_dir):
    """Export files with other column orders, quoted separators, quotes and line breaks, missing values and short
    rows, read in one pass; files with a field too many are left out."""
    r = _order_exports(spark, sf_dir).rows
    return r.select(_export_no(F.element_at("_src_entry", 1)), F.col("_src_row").alias("row"), F.col("Order").cast("long").alias("order_key"),
                    F.col("Status").alias("status"), F.col("Note").alias("note"))


@query("export_rejects")
def q_export_rejects(spark, sf_dir):
    """The account of what was not read: short and long records, and files left out."""
    r = _order_exports(spark, sf_dir).rejects
    return r.select(_export_no(F.col("path")), "row", "reason", "record")


@query("source_stats")
def q_source_stats(spark, sf_dir):
    """Rows, keys and day range of each standardised feed."""
    s = ST.standardize_sales(ST.normalize_pct(FX.sales_raw(spark, sf_dir)))
    r = ST.standardize_returns(FX.returns_raw(spark, sf_dir))
    i = ST.standardize_inventory(FX.inventory_raw(spark, sf_dir))
    h = FX.snapshot_hist(spark, sf_dir)
    return (ST.source_stats(s, "sales").unionByName(ST.source_stats(r, "returns"))
            .unionByName(ST.source_stats(i, "inventory")).unionByName(ST.source_stats(h, "snapshot_history")))


@query("iso_to_date")
def q_iso_to_date(spark, sf_dir):
    """Wall-clock day of the ISO return timestamp."""
    r = FX.returns_raw(spark, sf_dir)
    return r.select(F.col("return-date").alias("raw"), X.iso_day(F.col("return-date")).alias("date")).groupBy("raw", "date").agg(
        F.count(F.lit(1)).alias("n"))


@query("returns_agg")
def q_returns_agg(spark, sf_dir):
    """A1: summed quantity and most frequent reason per (asin, day)."""
    return ST.standardize_returns(FX.returns_raw(spark, sf_dir))


@query("std_returns")
def q_std_returns(spark, sf_dir):
    """P10: standardised returns (case-insensitive key column, day, aggregate)."""
    return ST.standardize_returns(FX.returns_raw(spark, sf_dir)).select("asin", "date", "return_count")


@query("join_returns")
def q_join_returns(spark, sf_dir):
    """Sales ⟕ returns on (asin, date)."""
    bd = FX.brand_daily(spark, sf_dir).select("asin", "date", "sales")
    return MS.merge_sources(bd, ST.standardize_returns(FX.returns_raw(spark, sf_dir)))


@query("std_inventory")
def q_std_inventory(spark, sf_dir):
    """Standardised inventory snapshot, one row per product (keep last)."""
    return ST.standardize_inventory(FX.inventory_raw(spark, sf_dir))


@query("join_inventory")
def q_join_inventory(spark, sf_dir):
    """Sales ⟕ inventory on asin."""
    bd = FX.brand_daily(spark, sf_dir).select("asin", "date", "sales")
    return MS.merge_sources(bd, inventory=ST.standardize_inventory(FX.inventory_raw(spark, sf_dir)))


@query("std_snapshot")
def q_std_snapshot(spark, sf_dir):
    """Standardised listing snapshot (case-insensitive key column, keep last)."""
    return ST.standardize_snapshot(FX.listing_raw(spark, sf_dir))


@query("join_snapshot")
def q_join_snapshot(spark, sf_dir):
    """Sales ⟕ listing snapshot on asin."""
    bd = FX.brand_daily(spark, sf_dir).select("asin", "date", "sales")
    return MS.merge_sources(bd, snapshot=ST.standardize_snapshot(FX.listing_raw(spark, sf_dir)))


@query("merge_sources")
def q_merge_sources(spark, sf_dir):
    """The merged master before tiers (row count = sales rows)."""
    bd = FX.brand_daily(spark, sf_dir)
    return MS.merge_sources(bd, ST.standardize_returns(FX.returns_raw(spark, sf_dir)),
                            ST.standardize_inventory(FX.inventory_raw(spark, sf_dir)),
                            ST.standardize_snapshot(FX.listing_raw(spark, sf_dir)))


@query("trailing_revenue")
def q_trailing_revenue(spark, sf_dir):
    """A2: trailing-12-month revenue per product."""
    return MS.trailing_revenue(FX.brand_daily(spark, sf_dir), CFG)


@query("assign_tiers")
def q_assign_tiers(spark, sf_dir):
    """A3: tier, revenue and hero flag per product."""
    m = MS.assign_tiers(FX.brand_daily(spark, sf_dir), CFG)
    return m.select("asin", "tier", "trailing_12m_revenue", "is_hero").distinct()


@query("tier_counts")
def q_tier_counts(spark, sf_dir):
    """A5: products and heroes per tier."""
    return MS.tier_counts(MS.assign_tiers(FX.brand_daily(spark, sf_dir), CFG))


# ------------------------------------------------------------------ snapshot series

def _hist(spark, sf_dir):
    return FX.snapshot_hist(spark, sf_dir)


@query("snapshot_gate")
def q_snapshot_gate(spark, sf_dir):
    """Distinct snapshot days and whether detection runs."""
    h = _hist(spark, sf_dir)
    return h.agg(F.countDistinct("date").alias("n_dates")).select(
        "n_dates", (F.col("n_dates") >= CFG.snapshot_min_dates).alias("active"))


@query("snapshot_detect")
def q_snapshot_detect(spark, sf_dir):
    """Rolling-only alerts on the snapshot metrics, with product metadata."""
    return SN.snapshot_detect(_hist(spark, sf_dir), derived.master(spark, sf_dir, CFG), CFG)


@query("floor_review_rating")
def q_floor_review_rating(spark, sf_dir):
    """Review-rating alerts (statistical or floor)."""
    s = SN.snapshot_scores(_hist(spark, sf_dir), CFG).filter((F.col("metric") == "review_rating") & F.col("sev").isNotNull())
    return s.select("asin", "date", F.col("value").alias("actual_value"), "z_score",
                    rank_label(F.col("sev")).alias("severity"), F.col("trig").alias("triggered_by"))


@query("snapshot_meta_join")
def q_snapshot_meta_join(spark, sf_dir):
    """Per-product metadata taken from the first master row."""
    return SN.product_meta(derived.master(spark, sf_dir, CFG))


@query("all_alerts")
def q_all_alerts(spark, sf_dir):
    """Daily alerts ∪ snapshot alerts (outer union of columns); both sides read one written master."""
    m = _materialized(spark, derived.master(spark, sf_dir, CFG))
    return SN.all_alerts(D.detect(m, CFG), SN.snapshot_detect(_hist(spark, sf_dir), m, CFG))


@query("threshold_join")
def q_threshold_join(spark, sf_dir):
    """Rolling severity via a join with the (fixed, one row per metric) threshold table."""
    rows = [(m, CFG.direction[m], *CFG.z_thresholds[m]) for m in M]
    thr = spark.createDataFrame(rows, "metric string, direction string, watch double, warning double, critical double")
    b = _baselines(spark, sf_dir)
    long = b.select("asin", "date", F.inline(F.array(*[F.struct(F.lit(m).alias("metric"),
                                                                F.col(f"{m}_roll_zscore").alias("z_score")) for m in M])))
    j = long.filter(F.col("z_score").isNotNull()).join(F.broadcast(thr), "metric")   # 6 rows: bounded by the metric list
    bad = (F.when(F.col("direction") == "both", F.abs("z_score"))
           .when(F.col("direction") == "up", F.col("z_score")).otherwise(-F.col("z_score")))
    sev = (F.when(bad >= F.col("critical"), F.lit("critical")).when(bad >= F.col("warning"), F.lit("warning"))
           .when(bad >= F.col("watch"), F.lit("watch")))
    return j.select("asin", "date", "metric", "z_score", sev.alias("severity")).filter(F.col("severity").isNotNull())


# ------------------------------------------------------------------ file listings (S1–S4, S7–S9) on the export manifest

def _manifest(spark, sf_dir, folder=None):
    m = FX.file_manifest(spark, sf_dir)
    if folder is not None:
        m = m.filter(F.col("folder") == folder)
    return m.select("path", "name", (F.size(F.split("path", "/")) - 2).alias("depth"), "folder",
                    X.file_date(F.col("name")).alias("file_date"))


def _anchor(spark, sf_dir):
    return FL.latest_date(_manifest(spark, sf_dir, "helium10"))


@query("file_date_extract")
def q_file_date_extract(spark, sf_dir):
    """The export day in a file name (yyyy-MM-dd, else short 'Mon d, yyyy')."""
    return _manifest(spark, sf_dir).select("path", "name", "file_date")


@query("file_date_prune")
def q_file_date_prune(spark, sf_dir):
    """S3: the returns files of the anchor day."""
    return FL.files_for_date(_manifest(spark, sf_dir, "returns"), _anchor(spark, sf_dir)).select("path", "file_date")


@query("latest_file_date")
def q_latest_file_date(spark, sf_dir):
    """Newest file day per export folder."""
    return _manifest(spark, sf_dir).groupBy("folder").agg(F.max("file_date").alias("latest_date"))


@query("returns_scan_fallback")
def q_returns_scan_fallback(spark, sf_dir):
    """Returns files of the anchor day, else all returns files."""
    return FL.select_all_or_day(_manifest(spark, sf_dir, "returns"), _anchor(spark, sf_dir)).select("path", "file_date")


@query("inventory_scan_fallback")
def q_inventory_scan_fallback(spark, sf_dir):
    """Inventory files of the day after the anchor (usually none), else the one newest file."""
    day = F.date_add(_anchor(spark, sf_dir), 1)
    return FL.select_day_or_latest_one(_manifest(spark, sf_dir, "inventory"), day).select("path", "file_date")


@query("snapshot_scan")
def q_snapshot_scan(spark, sf_dir):
    """Every listing-snapshot file of the newest day."""
    return FL.select_day_or_latest_all(_manifest(spark, sf_dir, "helium10"), None).select("path", "file_date")


@query("alert_export")
def q_alert_export(spark, sf_dir):
    """The export frame of a run (5 numeric columns rounded to 4 places, run_date)."""
    a = D.anchor_filter(_materialized(spark, _alerts(spark, sf_dir)))
    return FL.alerts_export_frame(a, F.date_add("date", CFG.data_lag_days))


# ------------------------------------------------------------------ snapshot store

def _store(spark, sf_dir):
    return _folder(spark, "snapshot_store")


@query("snapshot_append")
def q_snapshot_append(spark, sf_dir):
    """Land every day of the listing history into a store partitioned by snapshot day,
    twice (the second landing is a no-op), and read the store back."""
    store = _store(spark, sf_dir)
    hist = _hist(spark, sf_dir).withColumnRenamed("date", "snapshot_date")
    FL.append_new_days(spark, hist, store)
    FL.append_new_days(spark, hist.withColumn("review_count", F.lit(-1.0)), store)   # same days: skipped
    return FL.read_snapshot_history(spark, store)


@query("snapshot_history")
def q_snapshot_history(spark, sf_dir):
    """The accumulated store as a (asin, snapshot_date) series."""
    store = _store(spark, sf_dir)
    FL.append_new_days(spark, _hist(spark, sf_dir).withColumnRenamed("date", "snapshot_date"), store)
    h = FL.read_snapshot_history(spark, store)
    return h.select("asin", "snapshot_date", *[m for m in CFG.snapshot_metrics])


@query("snapshot_merge")
def q_snapshot_merge(spark, sf_dir):
    """Four landings in an order other than that of their exports, and a compaction in between; of a product's
    day the last export counts."""
    store = _store(spark, sf_dir)
    hist = _hist(spark, sf_dir).withColumnRenamed("date", "snapshot_date")
    for k, (name, every, bump) in enumerate((("p2", 3, 1000), ("p0", 5, 2000), ("p1", 1, 0), ("p3", 7, 3000))):
        rows = hist.filter(F.dayofmonth("snapshot_date") % every == 0).withColumn("review_count", F.col("review_count") + bump)
        ST_.publish(rows, store, keep="last", batch=str(k), order=F.struct(F.array(F.lit(name)), F.lit(0).cast("long")))
        if k == 2:
            ST_.compact(spark, store)
    return ST_.read_store(spark, store)
