"""Dual-baseline detection.

The detection plan is one wide, lazily built DataFrame:

    master ─► windows on (asin ↑date): rolling stats for all metrics, zero-unit
              run, history span                                  (1 exchange)
           ─► ⟕ YoY week means on (asin, date − 1 year)         (explode + partial agg)
           ─► one projection: severities, suppressions, combination, floors
           ─► inline(array(struct…)) to long format + filter

Severities are carried as ranks (1 watch, 2 warning, 3 critical) so that
escalation is ``greatest`` and never lowers a level.
"""

from __future__ import annotations

from typing import Dict, Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import DEFAULT, DETECTION_METRICS, Config
from ..functions.exprs import bad_score, escalate, nan_to_null, rank_label, safe_div, severity_rank
from .baselines import (with_history_span, with_rolling, with_yoy, with_yoy_deviation, with_yoy_window,
                        with_zero_run)

CONTEXT_COLUMNS = (("asin", "string"), ("date", "date"), ("tier", "string"), ("title", "string"),
                   ("category_bsr", "double"), ("yoy_available", "boolean"), ("top_return_reason", "string"))
OPTIONAL_INPUTS = (("tier", "string"), ("title", "string"), ("category_bsr", "double"),
                   ("top_return_reason", "string"), ("is_hero", "boolean"), ("available_units", "double"),
                   ("units", "double"))


def ensure_columns(df: DataFrame, specs: Iterable) -> DataFrame:
    """Absent optional columns become typed NULL columns so the plan shape is fixed."""
    missing = [F.lit(None).cast(t).alias(c) for c, t in specs if c not in df.columns]
    return df.select("*", *missing) if missing else df


def present_metrics(df: DataFrame, metrics: Sequence[str] = DETECTION_METRICS) -> list:
    return [m for m in metrics if m in df.columns]


# --------------------------------------------------------------------------- stages

def baselines(master: DataFrame, cfg: Config = DEFAULT, metrics: Sequence[str] | None = None) -> DataFrame:
    """Wide frame with rolling stats, zero-unit run, span and YoY means for every metric."""
    metrics = list(metrics or present_metrics(master))
    # Every per-product step is a window on the same (asin ↑date) partitioning:
    # one hash exchange on the product key for the whole detection.
    df = ensure_columns(master, OPTIONAL_INPUTS)
    # NaN is a missing value, never a number (Spark would sort it above every cut)
    df = df.withColumns({c: nan_to_null(F.col(c).cast("double")) for c in list(metrics) + ["units", "available_units"]})
    df = with_rolling(df, metrics, cfg)
    df = with_zero_run(df)
    df = with_history_span(df, cfg)
    df = with_yoy_window(df, metrics, cfg)
    return with_yoy_deviation(df, metrics, cfg)


def severity_columns(m: str, cfg: Config, suppress: bool = True) -> Dict[str, Column]:
    """Rolling severity (D1), YoY severity (D4) with suppressors D5–D8, combined."""
    d = cfg.direction.get(m, "up")
    z, dev = F.col(f"{m}_roll_zscore"), F.col(f"{m}_yoy_deviation")
    x, ym = F.col(m), F.col(f"{m}_yoy_mean")
    roll = severity_rank(bad_score(z, d), cfg.z_thresholds[m])
    yoy = severity_rank(bad_score(dev, d), cfg.yoy_thresholds[m]) if m in cfg.yoy_thresholds else F.lit(None).cast("int")
    if suppress:
        clear_yoy = F.lit(False)
        lo = cfg.yoy_min_absolute.get(m)
        if lo is not None:                                           # D5 low actual
            clear_yoy = clear_yoy | (x.isNotNull() & (x < F.lit(lo)))
        lo = cfg.yoy_min_baseline.get(m)
        if lo is not None:                                           # D6 weak baseline
            clear_yoy = clear_yoy | (ym.isNotNull() & (ym < F.lit(lo)))
        lo = cfg.yoy_min_abs_diff.get(m)
        if lo is not None:                                           # D7 small difference
            diff = F.abs(x - ym)
            clear_yoy = clear_yoy | (diff.isNotNull() & (diff < F.lit(lo)))
        if m == "acos" and cfg.acos_min_daily_sales is not None:     # D8 low sales
            low = F.col("sales").isNotNull() & (F.col("sales") < F.lit(cfg.acos_min_daily_sales))
            roll = F.when(~low, roll)
            clear_yoy = clear_yoy | low
        yoy = F.when(~F.coalesce(clear_yoy, F.lit(False)), yoy)
    sev = F.greatest(roll, yoy)
    trig = (F.when(roll.isNotNull() & yoy.isNotNull(), F.lit("both"))
            .when(roll.isNotNull(), F.lit("rolling")).when(yoy.isNotNull(), F.lit("yoy")))
    return {f"{m}_roll_sev": roll, f"{m}_yoy_sev": yoy, f"{m}_sev": sev, f"{m}_trig": trig}


def with_severities(df: DataFrame, metrics: Sequence[str], cfg: Config = DEFAULT, suppress: bool = True) -> DataFrame:
    cols = {}
    for m in metrics:
        cols.update(severity_columns(m, cfg, suppress))
    return df.select("*", *[c.alias(n) for n, c in cols.items()])


def _bump(sev: str, trig: str, mask: Column, level: int, cols: Dict[str, Column]) -> None:
    """D10 + D17: escalate, and name the absolute threshold only where no trigger is set."""
    mask = F.coalesce(mask, F.lit(False))
    cols[trig] = F.coalesce(cols[trig], F.when(mask, F.lit("absolute_threshold")))
    cols[sev] = escalate(cols[sev], mask, level)


def floor_columns(metrics: Sequence[str], cfg: Config = DEFAULT, only: Sequence[str] | None = None) -> Dict[str, Column]:
    """Absolute business floors D11–D16, in the reference order, as column expressions.

    ``only`` restricts to a subset of {return_rate, conversion_drop, margin,
    zero_sales, acos_spike} (used by the per-floor queries)."""
    cols: Dict[str, Column] = {}
    for m in metrics:
        cols[f"{m}_sev"] = F.col(f"{m}_sev")
        cols[f"{m}_trig"] = F.col(f"{m}_trig")
    use = set(only) if only is not None else {"return_rate", "conversion_drop", "margin", "zero_sales",
                                              "acos_spike", "acos_clear"}

    if "return_rate" in metrics and "return_rate" in use:                       # D11
        rr = F.col("return_rate")
        for floor, level in ((cfg.return_rate_critical, 3), (cfg.return_rate_warning, 2)):
            if floor is not None:
                _bump("return_rate_sev", "return_rate_trig", rr.isNotNull() & (rr > F.lit(floor)), level, cols)

    if "conversion_rate" in metrics and "conversion_drop" in use:               # D12
        mean = F.col("conversion_rate_roll_mean")
        drop = safe_div(mean - F.col("conversion_rate"), mean)
        for floor, level in ((cfg.conversion_drop_critical, 3), (cfg.conversion_drop_warning, 2)):
            if floor is not None:
                _bump("conversion_rate_sev", "conversion_rate_trig",
                      (mean >= F.lit(cfg.conversion_drop_min_mean)) & (drop > F.lit(floor)), level, cols)

    if "margin" in metrics and "margin" in use:                                 # D13
        mg = F.col("margin")
        if cfg.margin_critical_floor is not None:
            _bump("margin_sev", "margin_trig", mg.isNotNull() & (mg < F.lit(cfg.margin_critical_floor)), 3, cols)
        if cfg.margin_hero_warning_floor is not None:
            hero = F.coalesce(F.col("is_hero"), F.lit(False))
            _bump("margin_sev", "margin_trig", hero & mg.isNotNull() & (mg < F.lit(cfg.margin_hero_warning_floor)), 2, cols)

    if "sales" in metrics and "zero_sales" in use:                              # D14
        hero = F.coalesce(F.col("is_hero"), F.lit(False))
        stock = F.coalesce(F.col("available_units"), F.lit(1.0)) > 0
        ym = F.col("sales_yoy_mean")
        meaningful = ym.isNull() | (ym >= F.lit(cfg.zero_sales_min_yoy_baseline))
        _bump("sales_sev", "sales_trig",
              hero & stock & (F.col("zero_run") >= F.lit(cfg.zero_units_consecutive_days)) & meaningful, 3, cols)

    if "acos" in metrics and cfg.acos_gate and use & {"acos_spike", "acos_clear"}:   # D15 + D16
        if "sales" in metrics:
            change = F.coalesce(safe_div(F.col("sales") - F.col("sales_roll_mean"), F.col("sales_roll_mean")), F.lit(0.0))
        else:
            change = F.lit(0.0)
        not_rising = change <= F.lit(cfg.acos_sales_tolerance)
        spike = safe_div(F.col("acos") - F.col("acos_roll_mean"), F.col("acos_roll_mean"))
        if "acos_spike" in use:
            for floor, level in ((cfg.acos_spike_critical, 3), (cfg.acos_spike_warning, 2)):
                if floor is not None:
                    _bump("acos_sev", "acos_trig", not_rising & (spike > F.lit(floor)), level, cols)
        if "acos_clear" in use:
            rising = change > F.lit(cfg.acos_sales_tolerance)
            cols["acos_sev"] = F.when(~rising, cols["acos_sev"])
            cols["acos_trig"] = F.when(~rising, cols["acos_trig"])
    return cols


def with_floors(df: DataFrame, metrics: Sequence[str], cfg: Config = DEFAULT, only=None) -> DataFrame:
    cols = floor_columns(metrics, cfg, only)
    keep = [c for c in df.columns if c not in cols]
    return df.select(*keep, *[c.alias(n) for n, c in cols.items()])


def improvement_columns(m: str, cfg: Config) -> Dict[str, Column]:
    """No bad severity after the floors, and z or deviation in the good direction
    at least the warning cut.  ``both``-direction metrics never improve."""
    d = cfg.direction.get(m, "up")
    z, dev = F.col(f"{m}_roll_zscore"), F.col(f"{m}_yoy_deviation")
    z_warn = cfg.z_thresholds.get(m, (None, 2.0, None))[1]
    y_warn = cfg.yoy_thresholds.get(m, (None, 0.25, None))[1]
    if d == "both":
        r = y = F.lit(False)
    else:
        good = (lambda c: -c) if d == "up" else (lambda c: c)
        r = F.coalesce(good(z) >= F.lit(z_warn), F.lit(False))
        y = F.coalesce(good(dev) >= F.lit(y_warn), F.lit(False))
    imp = F.col(f"{m}_sev").isNull() & (r | y)
    trig = F.when(r & y, F.lit("both")).when(r, F.lit("rolling")).when(y, F.lit("yoy"))
    return {f"{m}_imp": imp, f"{m}_imp_trig": trig}


def scored(master: DataFrame, cfg: Config = DEFAULT, metrics: Sequence[str] | None = None) -> DataFrame:
    """Wide frame after D1–D18 (severity ranks and triggers per metric)."""
    metrics = list(metrics or present_metrics(master))
    df = baselines(master, cfg, metrics)
    df = with_severities(df, metrics, cfg)
    return with_floors(df, metrics, cfg)


ALERT_FIELDS = (("metric", "string"), ("actual_value", "double"), ("expected_value", "double"),
                ("yoy_baseline", "double"), ("z_score", "double"), ("yoy_deviation", "double"),
                ("severity", "string"), ("triggered_by", "string"), ("sales_roll_mean", "double"))


def to_long(wide: DataFrame, metrics: Sequence[str], cfg: Config = DEFAULT, alerts: bool = True,
            improvements: bool = True) -> DataFrame:
    """D19 + D20: one row per flagged (asin, date, metric) via ``inline(array(struct…))``."""
    wide = ensure_columns(wide, CONTEXT_COLUMNS)
    structs = []
    for m in metrics:
        imp = improvement_columns(m, cfg)
        base = [F.lit(m).alias("metric"), F.col(m).cast("double").alias("actual_value"),
                F.col(f"{m}_roll_mean").alias("expected_value"), F.col(f"{m}_yoy_mean").alias("yoy_baseline"),
                F.col(f"{m}_roll_zscore").alias("z_score"), F.col(f"{m}_yoy_deviation").alias("yoy_deviation")]
        if alerts:
            srm = F.col("sales_roll_mean") if (m == "margin" and "sales_roll_mean" in wide.columns) else F.lit(None)
            structs.append(F.struct(*base, rank_label(F.col(f"{m}_sev")).alias("severity"),
                                    F.col(f"{m}_trig").alias("triggered_by"),
                                    srm.cast("double").alias("sales_roll_mean")))
        if improvements:
            structs.append(F.struct(*base, F.when(imp[f"{m}_imp"], F.lit("improvement")).alias("severity"),
                                    imp[f"{m}_imp_trig"].alias("triggered_by"),
                                    F.lit(None).cast("double").alias("sales_roll_mean")))
    ctx = [c for c, _ in CONTEXT_COLUMNS]
    long = wide.select(*ctx, F.inline(F.array(*structs)))
    return long.filter(F.col("severity").isNotNull())


def detect(master: DataFrame, cfg: Config = DEFAULT, metrics: Sequence[str] | None = None) -> DataFrame:
    """D21 ``run_detection``: long-format alerts and improvements over all dates."""
    metrics = list(metrics or present_metrics(master))
    return to_long(scored(master, cfg, metrics), metrics, cfg)


def flagged_rows(alerts: DataFrame) -> DataFrame:
    """Severity assigned (the text 'None' counts as unassigned); improvements stay."""
    return alerts.filter(F.col("severity").isNotNull() & (F.col("severity") != "None"))


def anchor_filter(alerts: DataFrame, anchor=None) -> DataFrame:
    """Keep one day; the anchor defaults to the newest alert day (scalar subquery)."""
    day = F.lit(anchor).cast("date") if anchor is not None else alerts.agg(F.max("date")).scalar()
    return alerts.filter(F.col("date") == day)


def detect_day(master: DataFrame, day=None, cfg: Config = DEFAULT, metrics: Sequence[str] | None = None) -> DataFrame:
    """The alerts of one day (the newest by default), from the same plan as ``detect``: one partitioning by product
    serves all baselines, and rows of other days are dropped before they are made long."""
    metrics = list(metrics or present_metrics(master))
    d = F.lit(day).cast("date") if day is not None else master.agg(F.max("date")).scalar()
    return to_long(scored(master, cfg, metrics).filter(F.col("date") == d), metrics, cfg)
