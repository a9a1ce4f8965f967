"""Alert handling after detection: suppression (P15), caps (W7), tier order (O1),
top alerts (O2), cross-metric flags (J8), display formatting (E1–E8) and the
digest tables (A9, E9–E12).

Everything a digest shows for one day is computed for *every* day at once
(partitioned by ``date``), so a backfill and a daily run are the same plan.
Per-day top-k is two-phase: a salted pre-cut keeps at most k rows per
(day, severity, salt) before the exact per-day cut, so a day holding a third
of all alerts never sorts in one task.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import DEFAULT, Config
from ..functions.exprs import map_lookup, tier_rank

# ---------------------------------------------------------------------------
# Display units, labels and hint texts.
# ---------------------------------------------------------------------------
PCT_METRICS = ("conversion_rate", "return_rate", "acos", "tacos", "margin")
DOLLAR_METRICS = ("sales",)
RANK_METRICS = ("keyword_avg_rank",)
RATING_METRICS = ("review_rating",)
COUNT_METRICS = ("review_count", "organic_top10_count")

TIER_LABELS = (
    ("homerun", "HOMERUN  (>$2.5M)"),
    ("triple", "TRIPLE   ($1.5M–$2.5M)"),
    ("double", "DOUBLE   ($750K–$1.5M)"),
    ("single", "SINGLE   ($250K–$750K)"),
    ("less_than_single", "LESS THAN A SINGLE  (<$250K)"),
)
TRIGGER_LABELS = (
    ("rolling", "Short-term rolling baseline"),
    ("yoy", "Year-over-Year baseline"),
    ("both", "Both baselines"),
    ("absolute_threshold", "Absolute business threshold"),
)
SHORT_TRIGGERS = (
    ("rolling", "14-day avg"),
    ("yoy", "vs last year"),
    ("both", "14-day + YoY"),
    ("absolute_threshold", "Business rule"),
)
METRIC_LABELS = (
    ("conversion_rate", "Conversion rate"),
    ("return_rate", "Return rate"),
    ("acos", "ACoS"),
    ("tacos", "TACoS"),
    ("sales", "Sales"),
    ("margin", "Margin"),
    ("keyword_avg_rank", "Average keyword rank"),
    ("review_rating", "Review rating"),
    ("review_count", "Review count"),
    ("organic_top10_count", "Organic Top-10 keyword count"),
)
SEVERITY_ORDER = ("critical", "warning", "watch", "improvement")

# Cross-metric hints, first match first (fixed values): metric, what else must be there (flagged metrics of the product,
# or a return reason on record), text.
HINTS = (
    ("margin", ("acos", "tacos"), "Ad spend likely driver — both ACoS and TACoS also flagged for this product."),
    ("margin", ("tacos",), "Ad spend likely driver — TACoS also flagged for this product."),
    ("margin", ("acos",), "Ad spend likely driver — ACoS also flagged for this product."),
    ("margin", (), "Check COGS or FBA fees — ad spend looks stable."),
    ("sales", ("conversion_rate",), "Listing or pricing issue — conversion rate also down."),
    ("sales", (), "Check inventory levels, listing visibility, or ad spend."),
    ("return_rate", ("reason",), "Top return reason on record: {reason}."),
    ("return_rate", (), "Check FBA returns report for this ASIN."),
    ("acos", ("sales",), "ACoS rising while sales also declining — check bid strategy or targeting."),
    ("acos", (), "Review keyword bids and ad targeting."),
    ("tacos", ("sales",), "TACoS rising as sales decline — ad spend not generating enough revenue."),
    ("tacos", (), "Check campaign budgets relative to total revenue."),
    ("conversion_rate", ("sales",), "Both conversion and sales down — likely listing or pricing issue."),
    ("conversion_rate", (), "Check listing content, images, or recent pricing changes."),
    ("keyword_avg_rank", (), "Check ad spend on key terms and listing relevance."),
    ("review_rating", (), "Check recent reviews for quality or fulfilment complaints."),
    ("review_count", (), "Check for unusual review activity or Amazon review removals."),
    ("organic_top10_count", (), "Check listing content changes and keyword targeting."),
)

# Sentences of the explanations (placeholders in braces).
SENTENCES = {
    "absolute": "{product}: {label} is {actual}, beyond a fixed business limit.",
    "yoy": "{product}: {label} is {actual}, {diff} {side} the {yoy} of this week a year ago; last 14 days: {expected}.",
    "zscore": "{product}: {label} is {actual}{move}, which is {z} sigma {side} the last 14 days ({expected}).",
    "fallback": "{product}: {label} is {actual}; {expected} was expected.",
    "reason": " Most returns say: {reason}.",
    "impact": " Margin lost per day: about ${impact}.",
    "move_up": " after a sudden rise",
    "move_down": " after a sudden fall",
    "no_alerts": "{prefix} {day} | Nothing to report",
}


def _in(c: Column, values: Sequence[str]) -> Column:
    return c.isin(*values)


def sev_order(c: Column) -> Column:
    out = F.lit(len(SEVERITY_ORDER))
    for i, s in reversed(list(enumerate(SEVERITY_ORDER))):
        out = F.when(c == s, F.lit(i)).otherwise(out)
    return out


# ------------------------------------------------------------------ P15, W7, O1, O2

def suppress(alerts: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """Drop less_than_single (alerts and improvements), else only its watches;
    then optionally every watch.  A NULL tier is kept."""
    lts = F.col("tier").eqNullSafe("less_than_single")
    imp = F.col("severity") == "improvement"
    watch = F.col("severity") == "watch"
    df = alerts
    if cfg.suppress_less_than_single:
        df = df.filter(~lts)
    elif cfg.suppress_watch_for_less_than_single:
        df = df.filter(imp | ~(lts & watch))
    if cfg.suppress_watch:
        df = df.filter(imp | ~watch)
    return df


def top_k_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[Column], k_col: Column,
                    salt_buckets: int = 64, salt_on: str = "asin") -> DataFrame:
    """Rows ranked ``<= k`` within ``keys`` by ``order`` (exact), skew-safe.

    Phase 1 ranks inside (keys, hash(salt_on) % buckets) and keeps <= k per
    bucket; phase 2 ranks the survivors per key.  ``k_col`` NULL = unlimited.
    """
    salt = F.pmod(F.xxhash64(F.col(salt_on)), F.lit(salt_buckets))
    pre = df.withColumn("_salt", salt).withColumn(
        "_r1", F.row_number().over(Window.partitionBy(*keys, "_salt").orderBy(*order)))
    pre = pre.filter(k_col.isNull() | (F.col("_r1") <= k_col))
    ranked = pre.withColumn("rank_in_group", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.filter(k_col.isNull() | (F.col("rank_in_group") <= k_col)).drop("_salt", "_r1")


def _cap_expr(cfg: Config) -> Column:
    out = F.lit(None).cast("int")
    for sev, cap in cfg.caps.items():
        if cap:
            out = F.when(F.col("severity") == sev, F.lit(int(cap))).otherwise(out)
    return out


def tier_order_cols() -> list:
    return [tier_rank(F.col("tier")), F.col("asin"), F.col("metric")]


def capped(alerts: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """P15 then W7: at most cap rows per (day, severity) in tier order; a falsy cap is unlimited."""
    df = suppress(alerts, cfg)
    return top_k_per_group(df, ["date", "severity"], tier_order_cols(), _cap_expr(cfg)).drop("rank_in_group")


def tier_sorted(alerts: DataFrame) -> DataFrame:
    """O1: position of each alert of a day in (tier rank, asin, metric) order.

    Meant for a day's digest rows (after ``capped``), whose size per day is bounded
    by the caps; (asin, metric) is unique within a day, so the order is total."""
    w = Window.partitionBy("date").orderBy(*tier_order_cols())
    return alerts.select("*", tier_rank(F.col("tier")).alias("tier_rank"), F.row_number().over(w).alias("position"))


def top_alerts(alerts: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """O2: per day, criticals in tier order then warnings, the first ``top_n``, numbered."""
    df = alerts.filter(F.col("severity").isin("critical", "warning"))
    order = [sev_order(F.col("severity"))] + tier_order_cols()
    out = top_k_per_group(df, ["date"], order, F.lit(cfg.top_n))
    return out.withColumnRenamed("rank_in_group", "position")


def cross_metric_flags(alerts: DataFrame) -> DataFrame:
    """Per (day, product), the set of flagged metrics (improvements excluded),
    as a sorted comma list."""
    return (alerts.filter(F.col("severity") != "improvement").groupBy("date", "asin")
            .agg(F.concat_ws(",", F.array_sort(F.collect_set("metric"))).alias("flags")))


def with_flags(alerts: DataFrame) -> DataFrame:
    """J8 beside every alert: ``flags`` over the product's alerts of the day, NULL where only improvements are there.
    A (day, product) group holds one row per metric at most."""
    same = Window.partitionBy("date", "asin")
    flagged = F.array_sort(F.collect_set(F.when(F.col("severity") != "improvement", F.col("metric"))).over(same))
    return alerts.withColumn("flags", F.when(F.size(flagged) > 0, F.concat_ws(",", flagged)))


# ------------------------------------------------------------------ E1–E8 formatting

def _grouped(x: Column, d: int) -> Column:
    """Thousands-grouped fixed decimals, rounded half-even on the exact binary value
    (the same digits Python's ``f"{x:,.2f}"`` prints, including ``-0.00``)."""
    return F.format_number(x, d)


def _num(x: Column, d: int) -> Column:
    """Fixed decimals without grouping (Python ``f"{x:.1f}"``)."""
    return F.regexp_replace(F.format_number(x, d), ",", "")


def fmt_value(val: Column, metric: Column) -> Column:
    """Value in the metric's unit; NULL -> 'N/A'."""
    e = (F.when(val.isNull(), F.lit("N/A"))
         .when(_in(metric, PCT_METRICS), F.concat(_num(val * 100, 1), F.lit("%")))
         .when(_in(metric, DOLLAR_METRICS), F.concat(F.lit("$"), _grouped(val, 2)))
         .when(_in(metric, RANK_METRICS), F.concat(F.lit("#"), F.format_number(val.cast("long"), 0)))
         .when(_in(metric, RATING_METRICS), F.concat(_num(val, 1), F.lit("★")))
         .when(_in(metric, COUNT_METRICS), F.format_number(val.cast("long"), 0))
         .otherwise(_grouped(val, 2)))
    return e


def _sign(x: Column) -> Column:
    return F.when(x >= 0, F.lit("+")).otherwise(F.lit(""))


def fmt_deviation(val: Column) -> Column:
    """Signed percent."""
    return F.when(val.isNull(), F.lit("N/A")).otherwise(F.concat(_sign(val), _num(val * 100, 1), F.lit("%")))


def fmt_zscore(val: Column) -> Column:
    """Signed sigma."""
    return F.when(val.isNull(), F.lit("N/A")).otherwise(F.concat(_sign(val), _num(val, 2), F.lit("σ")))


def display_baseline(df_cols=None) -> Column:
    """E3/E4 baseline: YoY baseline for yoy/both triggers when present, else the rolling mean."""
    yoy_first = F.col("triggered_by").isin("yoy", "both") & F.col("yoy_baseline").isNotNull()
    return F.when(yoy_first, F.col("yoy_baseline")).otherwise(F.col("expected_value"))


def display_expected() -> Column:
    """Shown baseline text; a business rule without rolling mean says so."""
    yoy_first = F.col("triggered_by").isin("yoy", "both") & F.col("yoy_baseline").isNotNull()
    return (F.when(yoy_first, fmt_value(F.col("yoy_baseline"), F.col("metric")))
            .when((F.col("triggered_by") == "absolute_threshold") & F.col("expected_value").isNull(), F.lit("Business rule"))
            .otherwise(fmt_value(F.col("expected_value"), F.col("metric"))))


def display_deviation() -> Column:
    """Actual − shown baseline in the metric's unit; missing -> '—'."""
    metric, diff = F.col("metric"), F.col("actual_value") - display_baseline()
    s = _sign(diff)
    return (F.when(diff.isNull(), F.lit("—"))
            .when(_in(metric, PCT_METRICS), F.concat(s, _num(diff * 100, 1), F.lit("pp")))
            .when(_in(metric, DOLLAR_METRICS), F.concat(F.when(diff >= 0, F.lit("+")).otherwise(F.lit("-")),
                                                        F.lit("$"), _grouped(F.abs(diff), 2)))
            .when(_in(metric, RANK_METRICS + COUNT_METRICS), F.concat(s, _grouped(diff, 0)))
            .when(_in(metric, RATING_METRICS), F.concat(s, _num(diff, 2), F.lit("★")))
            .otherwise(F.concat(s, _grouped(diff, 2))))


def trigger_label(c: Column) -> Column:
    return map_lookup(c, TRIGGER_LABELS)


def short_trigger(c: Column) -> Column:
    return map_lookup(c, SHORT_TRIGGERS)


def tier_label(c: Column) -> Column:
    return map_lookup(c, TIER_LABELS)


def metric_label(c: Column) -> Column:
    return F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for kv in METRIC_LABELS for x in kv]), c),
                      F.initcap(F.regexp_replace(c, "_", " ")))


def fill(template: str, **parts) -> Column:
    """A text template with ``{name}`` placeholders as one ``concat`` of literals and columns."""
    import re
    pieces = []
    for i, tok in enumerate(re.split(r"\{(\w+)\}", template)):
        if i % 2:
            pieces.append(parts[tok])
        elif tok:
            pieces.append(F.lit(tok))
    return F.concat(*pieces) if pieces else F.lit("")


def pointed_reason(flags: Column) -> Column:
    """One cross-metric hint per alert (``flags``: comma list of the product's flagged metrics)."""
    has = lambda m: F.array_contains(F.split(F.coalesce(flags, F.lit("")), ","), F.lit(m))
    metric, reason = F.col("metric"), F.col("top_return_reason")
    out = F.when(F.lit(False), F.lit(""))
    for m, others, text in HINTS:
        if others == ("reason",):
            cond, value = (metric == m) & reason.isNotNull(), fill(text, reason=reason)
        else:
            cond = metric == m
            for o in others:
                cond = cond & has(o)
            value = F.lit(text)
        out = out.when(cond, value)
    return out.otherwise(F.lit(""))


def margin_impact() -> Column:
    """Daily margin dollars vs last year for yoy/both margin alerts: |actual − yoy| × sales rolling mean."""
    ok = ((F.col("metric") == "margin") & F.col("triggered_by").isin("yoy", "both") & (F.col("sales_roll_mean") > 0)
          & F.col("actual_value").isNotNull() & F.col("yoy_baseline").isNotNull())
    return F.when(ok, F.abs(F.col("actual_value") - F.col("yoy_baseline")) * F.col("sales_roll_mean"))


def explanation(flags: Column) -> Column:
    """Plain-English sentence (absolute → YoY → z-score → fallback) plus the hints."""
    metric = F.col("metric")
    base = dict(label=metric_label(metric), product=F.coalesce(F.col("title"), F.col("asin")),
                actual=fmt_value(F.col("actual_value"), metric), expected=fmt_value(F.col("expected_value"), metric))
    reason_sfx = F.when((metric == "return_rate") & F.col("top_return_reason").isNotNull(),
                        fill(SENTENCES["reason"], reason=F.col("top_return_reason"))).otherwise(F.lit(""))
    pointed = pointed_reason(flags)
    causes = F.when(pointed != "", F.concat(F.lit(" "), pointed)).otherwise(F.lit(""))
    imp = margin_impact()
    impact_sfx = F.when(imp.isNotNull(), fill(SENTENCES["impact"], impact=_grouped(imp, 0))).otherwise(F.lit(""))
    z = F.col("z_score")
    move = F.when(metric.isin("review_rating", "review_count") & z.isNotNull(),
                  F.when(z > 0, F.lit(SENTENCES["move_up"])).otherwise(F.lit(SENTENCES["move_down"]))).otherwise(F.lit(""))
    diff = F.col("actual_value") - F.col("yoy_baseline")
    abs_diff = (F.when(_in(metric, PCT_METRICS), F.concat(_num(F.abs(diff) * 100, 1), F.lit("pp")))
                .when(_in(metric, DOLLAR_METRICS), F.concat(F.lit("$"), _grouped(F.abs(diff), 2)))
                .otherwise(_grouped(F.abs(diff), 2)))
    absolute = F.concat(fill(SENTENCES["absolute"], **base), reason_sfx, causes)
    yoy = F.concat(fill(SENTENCES["yoy"], **base, diff=abs_diff,
                        side=F.when(diff >= 0, F.lit("above")).otherwise(F.lit("below")),
                        yoy=fmt_value(F.col("yoy_baseline"), metric)), impact_sfx, reason_sfx, causes)
    zs = F.concat(fill(SENTENCES["zscore"], **base, move=move, z=_num(F.abs(z), 1),
                       side=F.when(z > 0, F.lit("above")).otherwise(F.lit("below"))), reason_sfx, causes)
    fallback = F.concat(fill(SENTENCES["fallback"], **base), reason_sfx)
    trig = F.col("triggered_by")
    return (F.when(trig == "absolute_threshold", absolute)
            .when(trig.isin("yoy", "both") & F.col("yoy_baseline").isNotNull() & F.col("actual_value").isNotNull(), yoy)
            .when(z.isNotNull(), zs)
            .otherwise(fallback))


# ------------------------------------------------------------------ digest

def digest_summary(day_alerts: DataFrame) -> DataFrame:
    """Per day, counts per severity, total and distinct products (improvements included)."""
    return day_alerts.groupBy("date").agg(
        *[F.count_if(F.col("severity") == s).alias(f"n_{s}") for s in SEVERITY_ORDER],
        F.count(F.lit(1)).alias("n_total"),
        F.countDistinct("asin").alias("n_asins"))


def subject(summary: DataFrame, cfg: Config = DEFAULT, run_date: Column | None = None) -> Column:
    """One-line subject; the improving part only when > 0."""
    rd = F.date_format(run_date if run_date is not None else F.col("date"), "yyyy-MM-dd")
    base = F.format_string(f"{cfg.subject_prefix} %s | %d Critical | %d Warning | %d Watch", rd,
                           F.col("n_critical"), F.col("n_warning"), F.col("n_watch"))
    return F.when(F.col("n_improvement") > 0, F.concat(base, F.format_string(" | %d Improving", F.col("n_improvement")))).otherwise(base)


def section_rows(day_alerts: DataFrame) -> DataFrame:
    """Digest body order — severity section, then tier groups, then rows; a group
    header where the tier changes inside a section."""
    w = Window.partitionBy("date", "severity").orderBy(*tier_order_cols())
    df = day_alerts.select("*", sev_order(F.col("severity")).alias("section"), F.row_number().over(w).alias("row_in_section"))
    prev = F.lag(F.coalesce(F.col("tier"), F.lit("")), 1).over(w)
    return df.withColumn("is_group_head", prev.isNull() | (prev != F.coalesce(F.col("tier"), F.lit(""))))


def data_through(data_date: Column, run_date: Column, cfg: Config = DEFAULT) -> Column:
    """The data date when known, else run date − lag."""
    return F.coalesce(data_date, F.date_sub(run_date, cfg.data_lag_days))


# ------------------------------------------------------------------ the digest document

def _alert_line() -> Column:
    """One alert as a line: label, product, value, difference to the shown baseline, that baseline."""
    return F.concat_ws(" | ", metric_label(F.col("metric")), F.coalesce("title", "asin"),
                       fmt_value(F.col("actual_value"), F.col("metric")), display_deviation(), display_expected())


def digest_documents(day_alerts: DataFrame, days: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """One nested document per row of ``days`` (date): subject, data_through, top (the most severe alerts with their
    explanations), sections (per severity, in order, its rows in tier order under their tier's head) and the body, the
    same as text. ``day_alerts``: the capped alerts, so the arrays of a day are bounded by the caps. Days without alerts
    have empty arrays and say so in the subject."""
    flagged = with_flags(day_alerts)
    line = _alert_line()
    head = F.when(F.col("is_group_head"), F.concat(F.lit("  "), F.coalesce(tier_label(F.col("tier")), F.lit("no tier")), F.lit("\n")))
    rows = section_rows(flagged).select(
        "date", "section", "severity", F.struct("row_in_section", "asin", "metric", "tier", "is_group_head", F.concat(
            F.coalesce(head, F.lit("")), F.lit("    "), line).alias("text")).alias("row"))
    sections = rows.groupBy("date", "section", "severity").agg(F.array_sort(F.collect_list("row")).alias("rows")).select(
        "date", F.struct("section", "severity", F.concat(F.upper("severity"), F.lit(" ("), F.size("rows").cast("string"),
                                                         F.lit(")")).alias("title"), "rows").alias("section"))
    sections = sections.groupBy("date").agg(F.array_sort(F.collect_list("section")).alias("sections"))
    top = top_alerts(flagged, cfg).select("date", F.struct("position", "asin", "metric", "severity", F.concat(
        F.col("position").cast("string"), F.lit(". ["), F.col("severity"), F.lit("] "), explanation(F.col("flags"))).alias("text")).alias("t"))
    top = top.groupBy("date").agg(F.array_sort(F.collect_list("t")).alias("top"))
    summary = digest_summary(day_alerts)
    heads = summary.select("date", subject(summary, cfg).alias("subject"))
    j = days.join(heads, "date", "left").join(top, "date", "left").join(sections, "date", "left")
    quiet = fill(SENTENCES["no_alerts"], prefix=F.lit(cfg.subject_prefix), day=F.date_format("date", "yyyy-MM-dd"))
    j = j.select("date", F.coalesce("subject", quiet).alias("subject"), data_through(F.col("date"), F.col("date"), cfg).alias("data_through"),
                 F.coalesce("top", F.array().cast(top.schema["top"].dataType)).alias("top"),
                 F.coalesce("sections", F.array().cast(sections.schema["sections"].dataType)).alias("sections"))
    texts = lambda c: F.transform(c, lambda x: x["text"])
    parts = F.concat(F.array(F.concat(F.lit("Data through "), F.date_format("data_through", "yyyy-MM-dd"))), texts(F.col("top")), F.flatten(
        F.transform("sections", lambda x: F.concat(F.array(x["title"]), texts(x["rows"])))))
    return j.withColumn("body", F.array_join(parts, "\n"))
