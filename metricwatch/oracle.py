"""DuckDB oracle SQL for the registered queries.

An independent formulation of the same semantics in plain SQL over the
driver's views (``lineitem``, ``part``, ``orders``, ``events`` …).  The
fixtures are repeated as CTEs, and where the Spark plan uses a different
strategy (e.g. history-side explode for the YoY week) the SQL takes the
direct route (target-side lookup keys), so the two sides check each other.
"""

from __future__ import annotations

from typing import Dict, Iterable, List, Sequence

from .config import DETECTION_METRICS, TIER_ORDER, Config, conversion_drop_config, fixture_config

# ---------------------------------------------------------------------------
# The expected display units, labels and texts (fixed values), stated here once more: the plan's own tables are checked
# against these.
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

# Hints: metric, what else must be there, text.
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

# Sentences.
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

CFG = fixture_config()
M = DETECTION_METRICS


def lit(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return "TRUE" if v else "FALSE"
    if isinstance(v, str):
        return "'" + v.replace("'", "''") + "'"
    return repr(float(v)) if isinstance(v, float) else str(v)


def rounded(sql: str, doubles: Iterable[str] = ()) -> str:
    """Results are compared unrounded: every double is either exact fixture
    arithmetic or a statistic rounded on a fixed grid inside the plan (the
    ``doubles`` lists document which columns are floating point)."""
    return sql


def with_(ctes: Sequence[tuple], final: str) -> str:
    return "WITH " + ",\n".join(f"{n} AS ({q})" for n, q in ctes) + "\n" + final


# --------------------------------------------------------------------------- fixtures

def _c(x: str) -> str:
    return f"CAST(round({x} * 100) AS BIGINT)"


BRAND_DAILY = [
    ("bd_agg", f"""
      SELECT upper(p.p_brand) AS asin, CAST(l.l_shipdate AS DATE) AS date,
             SUM({_c('l.l_extendedprice')} * (100 - {_c('l.l_discount')})) AS net4,
             SUM(CAST(round(l.l_quantity) AS BIGINT) * {_c('p.p_retailprice')} * 100) AS cost4,
             SUM({_c('l.l_extendedprice')} * {_c('l.l_tax')}) AS ad4,
             SUM({_c('l.l_extendedprice')}) AS gross2,
             SUM(CAST(round(l.l_quantity) AS BIGINT)) AS qty,
             SUM(CASE WHEN l.l_returnflag = 'R' THEN CAST(round(l.l_quantity) AS BIGINT) ELSE 0 END) AS qty_r,
             COUNT(*) AS n
      FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
      GROUP BY 1, 2"""),
    ("brand_daily", """
      SELECT asin, date, CAST(net4 AS DOUBLE) / 10000.0 AS sales, CAST(qty AS DOUBLE) AS units,
             CAST(n AS DOUBLE) AS orders,
             CAST(qty_r AS DOUBLE) / NULLIF(CAST(qty AS DOUBLE), 0) AS return_rate,
             CAST(n AS DOUBLE) / NULLIF(CAST(qty AS DOUBLE), 0) AS conversion_rate,
             CAST(net4 - cost4 AS DOUBLE) / NULLIF(CAST(net4 AS DOUBLE), 0) AS margin,
             CAST(ad4 AS DOUBLE) / NULLIF(CAST(net4 AS DOUBLE), 0) AS acos,
             CAST(ad4 AS DOUBLE) / NULLIF(CAST(gross2 * 100 AS DOUBLE), 0) AS tacos
      FROM bd_agg"""),
]

DENSE = BRAND_DAILY + [
    ("bd_days", """
      SELECT CAST(unnest(generate_series(min(CAST(l_shipdate AS DATE)), max(CAST(l_shipdate AS DATE)), INTERVAL 1 DAY)) AS DATE) AS date
      FROM lineitem"""),
    ("dense", """
      SELECT b.asin, d.date, COALESCE(x.sales, 0.0) AS sales, COALESCE(x.units, 0.0) AS units, x.orders,
             x.return_rate, x.conversion_rate, x.margin, x.acos, x.tacos
      FROM (SELECT DISTINCT upper(p_brand) AS asin FROM part) b CROSS JOIN bd_days d
      LEFT JOIN brand_daily x ON x.asin = b.asin AND x.date = d.date"""),
]

RETURNS = [
    ("returns_raw", """
      SELECT ' ' || lower(p.p_brand) AS "Asin", strftime(l.l_shipdate, '%Y-%m-%dT%H:%M:%S') AS "return-date",
             CAST(round(l.l_quantity) AS BIGINT) AS quantity, p.p_type AS reason
      FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey WHERE l.l_returnflag = 'R'"""),
    ("returns_std", """
      SELECT upper(regexp_replace("Asin", '^\\s+|\\s+$', '', 'g')) AS asin,
             TRY_CAST(substr("return-date", 1, 10) AS DATE) AS date, quantity, reason
      FROM returns_raw"""),
    ("ret_reason", """
      SELECT asin, date, reason FROM (
        SELECT asin, date, reason, row_number() OVER (PARTITION BY asin, date ORDER BY count(*) DESC, reason) AS rn
        FROM returns_std WHERE reason IS NOT NULL AND asin IS NOT NULL AND date IS NOT NULL GROUP BY asin, date, reason)
      WHERE rn = 1"""),
    ("returns_agg", """
      SELECT q.asin, q.date, q.return_count, r.reason AS top_return_reason FROM (
        SELECT asin, date, CAST(COALESCE(SUM(quantity), 0) AS BIGINT) AS return_count FROM returns_std
        WHERE asin IS NOT NULL AND date IS NOT NULL GROUP BY asin, date) q
      LEFT JOIN ret_reason r ON r.asin = q.asin AND r.date = q.date"""),
]

INVENTORY = [
    ("inv_g", """
      SELECT lower(p_brand) AS asin, CAST(SUM(p_size) AS DOUBLE) AS total, COUNT(*) AS n, MAX(p_size) AS mx,
             CASE WHEN CAST(regexp_extract(lower(p_brand), '(\\d+)$', 1) AS INTEGER) % 5 = 0 THEN 0.0
                  ELSE CAST(SUM(p_size) AS DOUBLE) END AS avail
      FROM part GROUP BY 1"""),
    ("inventory_raw", """
      SELECT asin, total AS "Total Units", CASE WHEN r = 1 THEN avail ELSE total + 1 END AS "available",
             CAST(n AS DOUBLE) AS "Days of Supply at Amazon Fulfillment Network",
             CASE WHEN avail = 0 THEN 'out_of_stock' END AS "Alert", CAST(mx AS DOUBLE) AS "Recommended replenishment qty",
             'inventory/Restock Inventory.csv' AS _src_path, CAST(r AS BIGINT) AS _src_row
      FROM inv_g, (VALUES (0), (1)) v(r)"""),
    ("inventory", """
      SELECT asin, total_units, available_units, days_of_supply, inventory_alert, recommended_replenishment_qty FROM (
        SELECT upper(regexp_replace(asin, '^\\s+|\\s+$', '', 'g')) AS asin, "Total Units" AS total_units,
               "available" AS available_units, "Days of Supply at Amazon Fulfillment Network" AS days_of_supply,
               "Alert" AS inventory_alert, "Recommended replenishment qty" AS recommended_replenishment_qty,
               row_number() OVER (PARTITION BY upper(regexp_replace(asin, '^\\s+|\\s+$', '', 'g'))
                                  ORDER BY _src_path DESC, _src_row DESC) AS rn
        FROM inventory_raw) WHERE rn = 1"""),
]


def tiers_sql(src: str, cfg: Config = CFG) -> str:
    cases = " ".join(f"WHEN trailing_12m_revenue >= {lit(float(c))} THEN {lit(n)}" for n, c in cfg.tier_thresholds)
    return f"""
      SELECT *, CASE {cases} ELSE 'less_than_single' END AS tier,
             COALESCE(trailing_12m_revenue >= {lit(float(cfg.hero_revenue))}, FALSE) AS is_hero
      FROM (SELECT *, SUM(CASE WHEN date >= CAST((SELECT max(date) FROM {src}) - INTERVAL {cfg.trailing_months} MONTH AS DATE)
                              THEN CAST(round(COALESCE(sales, 0.0) * 10000) AS BIGINT) END) OVER (PARTITION BY asin) / 10000.0
                              AS trailing_12m_revenue
            FROM {src}) _t"""


def _brand_no(c: str) -> str:
    return f"CAST(regexp_extract({c}, '(\\d+)$', 1) AS INTEGER)"


SNAP_COLS = ("keyword_avg_rank", "review_rating", "review_count", "organic_top10_count")
SNAPSHOT = [
    ("ev_g", """
      SELECT CAST(user_id % 25 AS INTEGER) AS k, CAST(ts AS DATE) AS date,
             SUM(CAST(round(value * 100) AS BIGINT)) AS c,
             SUM(least(greatest(CAST(round(value * 100) AS BIGINT), 0), 5000)) AS cl,
             COUNT(*) AS n, COUNT(DISTINCT user_id) AS u
      FROM events GROUP BY 1, 2"""),
    ("ev_h", """
      SELECT *, CASE WHEN (datediff('day', DATE '2024-01-01', date) * 25 + k) % 11 = 0
                     THEN CAST(floor((datediff('day', DATE '2024-01-01', date) * 25 + k) / 11.0) AS BIGINT) % 4 END AS hole
      FROM ev_g"""),
    ("snapshot_hist", """
      SELECT 'BRAND#' || CAST(k + 1 AS VARCHAR) AS asin, date,
             CASE WHEN hole IS NULL OR hole <> 0 THEN CAST(c AS DOUBLE) / CAST(n * 100 AS DOUBLE) END AS keyword_avg_rank,
             CASE WHEN hole IS NULL OR hole <> 1 THEN 1.0 + 4.0 * (CAST(cl AS DOUBLE) / CAST(n * 5000 AS DOUBLE)) END AS review_rating,
             CASE WHEN hole IS NULL OR hole <> 2 THEN CAST(n AS DOUBLE) END AS review_count,
             CASE WHEN hole IS NULL OR hole <> 3 THEN CAST(u AS DOUBLE) END AS organic_top10_count,
             CAST(1000 * (k + 1) AS DOUBLE) AS category_bsr
      FROM ev_h"""),
    ("listing", """
      SELECT asin, category_bsr, category_bsr / 10 AS subcategory_bsr, keyword_avg_rank,
             CAST(NULL AS DOUBLE) AS keyword_avg_rank_trend, organic_top10_count,
             organic_top10_count * 100 AS organic_top10_search_volume, review_rating, review_count
      FROM snapshot_hist WHERE date = (SELECT max(date) FROM snapshot_hist)"""),
]

MERGED_SELECT = """
      SELECT d.*, r.return_count, r.top_return_reason, i.total_units, i.available_units, i.days_of_supply,
             i.inventory_alert, i.recommended_replenishment_qty, l.category_bsr, l.subcategory_bsr, l.keyword_avg_rank,
             l.keyword_avg_rank_trend, l.organic_top10_count, l.organic_top10_search_volume, l.review_rating, l.review_count
      FROM {src} d LEFT JOIN returns_agg r ON r.asin = d.asin AND r.date = d.date
      LEFT JOIN inventory i ON i.asin = d.asin LEFT JOIN listing l ON l.asin = d.asin"""

MASTER = DENSE + RETURNS + INVENTORY + SNAPSHOT + [
    ("merged", MERGED_SELECT.format(src="dense")),
    ("master", tiers_sql("merged")),
]


# --------------------------------------------------------------------------- detection

def sev_case(bad: str, cuts) -> str:
    w, wa, c = cuts
    return f"(CASE WHEN {bad} >= {lit(c)} THEN 3 WHEN {bad} >= {lit(wa)} THEN 2 WHEN {bad} >= {lit(w)} THEN 1 END)"


def bad(x: str, d: str) -> str:
    return f"abs({x})" if d == "both" else (x if d == "up" else f"(-{x})")


def detection_ctes(src: str = "master", cfg: Config = CFG, metrics: Sequence[str] = M,
                   key: str = "asin", only=None) -> List[tuple]:
    use = set(only) if only is not None else {"return_rate", "conversion_drop", "margin", "zero_sales",
                                              "acos_spike", "acos_clear"}
    n, k = cfg.rolling_window, cfg.rolling_min_periods
    frame = f"(PARTITION BY {key} ORDER BY date ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"
    roll = ", ".join(
        f"round(CASE WHEN count({m}) OVER {frame} >= {k} THEN list_sum(list({m}) OVER {frame}) / count({m}) OVER {frame} END, "
        f"{cfg.digits(m)}) + 0.0 AS {m}_roll_mean, "
        f"round(CASE WHEN count({m}) OVER {frame} >= {k} THEN stddev_samp({m}) OVER {frame} END, {cfg.std_digits(m)}) + 0.0 AS {m}_roll_std"
        for m in metrics)
    zs = ", ".join(f"round(({m} - {m}_roll_mean) / NULLIF({m}_roll_std, 0), {cfg.score_digits}) + 0.0 AS {m}_roll_zscore"
                   for m in metrics)
    half = cfg.yoy_window // 2
    # the week's values are summed in day order (as the Spark plan does), so the mean does not
    # depend on how the engine combines partial aggregates
    yoy_avgs = ", ".join(f"round(list_sum(list(h.{m} ORDER BY h.date)) / NULLIF(count(h.{m}), 0), {cfg.digits(m)}) + 0.0"
                         f" AS {m}_yoy_mean" for m in metrics)
    ctes = [
        ("d_roll", f"""
          SELECT *, {roll},
                 row_number() OVER (PARTITION BY {key} ORDER BY date) AS _rn,
                 datediff('day', min(date) OVER (PARTITION BY {key}), max(date) OVER (PARTITION BY {key}))
                   >= {cfg.min_history_days} AS yoy_available
          FROM {src}"""),
        ("d_roll2", f"""
          SELECT *, {zs},
                 CASE WHEN COALESCE(units, 0) = 0 THEN _rn - COALESCE(max(CASE WHEN COALESCE(units, 0) <> 0 THEN _rn END)
                      OVER (PARTITION BY {key} ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 0)
                      ELSE 0 END AS zero_run
          FROM d_roll"""),
        ("d_yoy_keys", f"""
          SELECT t.{key}, t.date, CAST(t.date - INTERVAL 12 MONTH AS DATE) + CAST(r.j AS INTEGER) AS hdate
          FROM d_roll2 t, range({-half}, {half + 1}) r(j) WHERE t.yoy_available"""),
        ("d_yoy", f"""
          SELECT y.{key}, y.date, {yoy_avgs}
          FROM d_yoy_keys y JOIN {src} h ON h.{key} = y.{key} AND h.date = y.hdate GROUP BY y.{key}, y.date"""),
        ("d_base", f"""
          SELECT t.*, {", ".join(f"y.{m}_yoy_mean" for m in metrics)},
                 {", ".join(f"round(({m} - y.{m}_yoy_mean) / NULLIF(abs(y.{m}_yoy_mean), 0), {cfg.score_digits}) + 0.0 AS {m}_yoy_deviation" for m in metrics)}
          FROM d_roll2 t LEFT JOIN d_yoy y ON y.{key} = t.{key} AND y.date = t.date"""),
    ]
    # severities with suppressors
    parts, parts_raw = [], []
    for m in metrics:
        d = cfg.direction.get(m, "up")
        r = sev_case(bad(f"{m}_roll_zscore", d), cfg.z_thresholds[m])
        y = sev_case(bad(f"{m}_yoy_deviation", d), cfg.yoy_thresholds[m]) if m in cfg.yoy_thresholds else "CAST(NULL AS INTEGER)"
        parts_raw.append(f"{r} AS {m}_roll_sev_raw, {y} AS {m}_yoy_sev_raw")
        clear = []
        if cfg.yoy_min_absolute.get(m) is not None:
            clear.append(f"({m} IS NOT NULL AND {m} < {lit(cfg.yoy_min_absolute[m])})")
        if cfg.yoy_min_baseline.get(m) is not None:
            clear.append(f"({m}_yoy_mean IS NOT NULL AND {m}_yoy_mean < {lit(cfg.yoy_min_baseline[m])})")
        if cfg.yoy_min_abs_diff.get(m) is not None:
            clear.append(f"(abs({m} - {m}_yoy_mean) IS NOT NULL AND abs({m} - {m}_yoy_mean) < {lit(cfg.yoy_min_abs_diff[m])})")
        rr = r
        if m == "acos" and cfg.acos_min_daily_sales is not None:
            low = f"(sales IS NOT NULL AND sales < {lit(cfg.acos_min_daily_sales)})"
            clear.append(low)
            rr = f"(CASE WHEN NOT {low} THEN {r} END)"
        yy = f"(CASE WHEN NOT COALESCE({' OR '.join(clear)}, FALSE) THEN {y} END)" if clear else y
        parts.append(f"{rr} AS {m}_roll_sev, {yy} AS {m}_yoy_sev")
    ctes.append(("d_sev0", f"SELECT *, {', '.join(parts_raw)}, {', '.join(parts)} FROM d_base"))
    comb = ", ".join(
        f"greatest({m}_roll_sev, {m}_yoy_sev) AS {m}_sev0, "
        f"CASE WHEN {m}_roll_sev IS NOT NULL AND {m}_yoy_sev IS NOT NULL THEN 'both' WHEN {m}_roll_sev IS NOT NULL "
        f"THEN 'rolling' WHEN {m}_yoy_sev IS NOT NULL THEN 'yoy' END AS {m}_trig0" for m in metrics)
    ctes.append(("d_sev", f"SELECT *, {comb} FROM d_sev0"))
    # floors, one CTE per step
    sev = {m: f"{m}_sev0" for m in metrics}
    trig = {m: f"{m}_trig0" for m in metrics}
    steps = []

    def bump(m, mask, level):
        steps.append((m, mask, level))

    if "return_rate" in metrics and "return_rate" in use:
        for f, lv in ((cfg.return_rate_critical, 3), (cfg.return_rate_warning, 2)):
            if f is not None:
                bump("return_rate", f"(return_rate IS NOT NULL AND return_rate > {lit(f)})", lv)
    if "conversion_rate" in metrics and "conversion_drop" in use:
        for f, lv in ((cfg.conversion_drop_critical, 3), (cfg.conversion_drop_warning, 2)):
            if f is not None:
                bump("conversion_rate", f"(conversion_rate_roll_mean >= {lit(cfg.conversion_drop_min_mean)} AND "
                     f"(conversion_rate_roll_mean - conversion_rate) / NULLIF(conversion_rate_roll_mean, 0) > {lit(f)})", lv)
    if "margin" in metrics and "margin" in use:
        if cfg.margin_critical_floor is not None:
            bump("margin", f"(margin IS NOT NULL AND margin < {lit(cfg.margin_critical_floor)})", 3)
        if cfg.margin_hero_warning_floor is not None:
            bump("margin", f"(COALESCE(is_hero, FALSE) AND margin IS NOT NULL AND margin < {lit(cfg.margin_hero_warning_floor)})", 2)
    if "sales" in metrics and "zero_sales" in use:
        bump("sales", f"(COALESCE(is_hero, FALSE) AND COALESCE(available_units, 1) > 0 AND zero_run >= "
             f"{cfg.zero_units_consecutive_days} AND (sales_yoy_mean IS NULL OR sales_yoy_mean >= "
             f"{lit(cfg.zero_sales_min_yoy_baseline)}))", 3)
    change = "COALESCE((sales - sales_roll_mean) / NULLIF(sales_roll_mean, 0), 0)" if "sales" in metrics else "0"
    if "acos" in metrics and cfg.acos_gate and "acos_spike" in use:
        for f, lv in ((cfg.acos_spike_critical, 3), (cfg.acos_spike_warning, 2)):
            if f is not None:
                bump("acos", f"({change} <= {lit(cfg.acos_sales_tolerance)} AND "
                     f"(acos - acos_roll_mean) / NULLIF(acos_roll_mean, 0) > {lit(f)})", lv)
    prev = "d_sev"
    for i, (m, mask, lv) in enumerate(steps):
        s_new, t_new = f"{m}_sev{i + 1}", f"{m}_trig{i + 1}"
        q = (f"SELECT *, CASE WHEN COALESCE({mask}, FALSE) THEN greatest(COALESCE({sev[m]}, 0), {lv}) ELSE {sev[m]} END AS {s_new}, "
             f"COALESCE({trig[m]}, CASE WHEN COALESCE({mask}, FALSE) THEN 'absolute_threshold' END) AS {t_new} FROM {prev}")
        ctes.append((f"d_f{i + 1}", q))
        prev = f"d_f{i + 1}"
        sev[m], trig[m] = s_new, t_new
    final = []
    for m in metrics:
        s, t = sev[m], trig[m]
        if m == "acos" and cfg.acos_gate and "acos_clear" in use:
            rising = f"({change} > {lit(cfg.acos_sales_tolerance)})"
            s, t = f"CASE WHEN NOT {rising} THEN {s} END", f"CASE WHEN NOT {rising} THEN {t} END"
        final.append(f"{s} AS {m}_sev, {t} AS {m}_trig")
    ctes.append(("d_scored", f"SELECT *, {', '.join(final)} FROM {prev}"))
    return ctes


def label(rank: str) -> str:
    return f"(CASE {rank} WHEN 1 THEN 'watch' WHEN 2 THEN 'warning' WHEN 3 THEN 'critical' END)"


CONTEXT = ("asin", "date", "tier", "title", "category_bsr", "yoy_available", "top_return_reason")
ALERT_DOUBLES = ("category_bsr", "actual_value", "expected_value", "yoy_baseline", "z_score", "yoy_deviation",
                 "sales_roll_mean")


def long_sql(src: str = "d_scored", cfg: Config = CFG, metrics: Sequence[str] = M, alerts: bool = True,
             improvements: bool = True, context: Sequence[str] = CONTEXT,
             has=("tier", "top_return_reason", "category_bsr")) -> str:
    ctx = ", ".join(c if (c in ("asin", "date", "yoy_available") or c in has) else
                    f"CAST(NULL AS {'DOUBLE' if c == 'category_bsr' else 'VARCHAR'}) AS {c}" for c in context)
    sel = []
    for m in metrics:
        common = (f"'{m}' AS metric, CAST({m} AS DOUBLE) AS actual_value, {m}_roll_mean AS expected_value, "
                  f"{m}_yoy_mean AS yoy_baseline, {m}_roll_zscore AS z_score, {m}_yoy_deviation AS yoy_deviation")
        if alerts:
            srm = "sales_roll_mean" if (m == "margin" and "sales" in metrics) else "CAST(NULL AS DOUBLE)"
            sel.append(f"SELECT {ctx}, {common}, {label(m + '_sev')} AS severity, {m}_trig AS triggered_by, "
                       f"{srm} AS sales_roll_mean FROM {src} WHERE {m}_sev IS NOT NULL")
        if improvements:
            d = cfg.direction.get(m, "up")
            if d == "both":
                continue
            zw = cfg.z_thresholds[m][1]
            yw = cfg.yoy_thresholds.get(m, (None, 0.25, None))[1]
            g = (lambda x: f"(-{x})") if d == "up" else (lambda x: x)
            r = f"COALESCE({g(m + '_roll_zscore')} >= {lit(zw)}, FALSE)"
            y = f"COALESCE({g(m + '_yoy_deviation')} >= {lit(yw)}, FALSE)"
            trig = f"CASE WHEN {r} AND {y} THEN 'both' WHEN {r} THEN 'rolling' WHEN {y} THEN 'yoy' END"
            sel.append(f"SELECT {ctx}, {common}, 'improvement' AS severity, {trig} AS triggered_by, "
                       f"CAST(NULL AS DOUBLE) AS sales_roll_mean FROM {src} WHERE {m}_sev IS NULL AND ({r} OR {y})")
    return " UNION ALL ".join(sel)


def alerts_ctes(cfg: Config = CFG) -> List[tuple]:
    return MASTER + detection_ctes("master", cfg) + [("alerts", long_sql("d_scored", cfg))]


# --------------------------------------------------------------------------- registered oracle queries

ORACLE: Dict[str, str] = {}


def _reg(name: str, ctes: Sequence[tuple], final: str, doubles: Iterable[str] = ()) -> None:
    ORACLE[name] = rounded(with_(ctes, final), doubles)


def _stack(src: str, cols: Dict[str, str], keep: str, metrics: Sequence[str] = M, where: str = "") -> str:
    parts = []
    for m in metrics:
        sel = ", ".join(expr.format(m=m) + f" AS {out}" for out, expr in cols.items())
        cond = cols[keep].format(m=m) + " IS NOT NULL" + (f" AND {where.format(m=m)}" if where else "")
        parts.append(f"SELECT asin, date, '{m}' AS metric, {sel} FROM {src} WHERE {cond}")
    return " UNION ALL ".join(parts)


def _build() -> None:
    det = MASTER + detection_ctes("master", CFG)
    _reg("detect", det + [("alerts", long_sql("d_scored", CFG))], "SELECT * FROM alerts", ALERT_DOUBLES)
    _reg("rolling_baseline", det, "SELECT asin, date, " + ", ".join(
        f"{m}_roll_mean, {m}_roll_std" for m in M) + " FROM d_base",
        [c for m in M for c in (f"{m}_roll_mean", f"{m}_roll_std")])
    _reg("rolling_zscore", det, "SELECT asin, date, " + ", ".join(f"{m}_roll_zscore" for m in M) + " FROM d_base",
         [f"{m}_roll_zscore" for m in M])
    _reg("rolling_flags", det, _stack("d_sev0", {"z_score": "{m}_roll_zscore",
                                                 "severity": label("{m}_roll_sev_raw")}, "severity"), ["z_score"])
    _reg("yoy_baseline", det, "SELECT asin, date, yoy_available, " + ", ".join(f"{m}_yoy_mean" for m in M) +
         " FROM d_base", [f"{m}_yoy_mean" for m in M])
    _reg("yoy_deviation", det, "SELECT asin, date, " + ", ".join(f"{m}_yoy_deviation" for m in M) + " FROM d_base",
         [f"{m}_yoy_deviation" for m in M])
    _reg("yoy_flags", det, _stack("d_sev0", {"yoy_deviation": "{m}_yoy_deviation",
                                             "severity": label("{m}_yoy_sev_raw")}, "severity"), ["yoy_deviation"])
    # suppressors D5–D7 only (no low-sales clear)
    no_low = CFG.with_(acos_min_daily_sales=None)
    det_nl = MASTER + detection_ctes("master", no_low)
    _reg("yoy_suppressed", det_nl, _stack("d_sev0", {"severity_raw": label("{m}_yoy_sev_raw"),
                                                     "severity": label("{m}_yoy_sev")}, "severity_raw"))
    low = f"sales < {lit(CFG.acos_min_daily_sales)}"
    _reg("acos_low_sales", det, f"""SELECT asin, date, sales, acos AS actual_value,
        {label('acos_roll_sev_raw')} AS roll_severity_raw, {label('acos_yoy_sev_raw')} AS yoy_severity_raw,
        {label('acos_roll_sev')} AS roll_severity, {label('acos_yoy_sev')} AS yoy_severity
        FROM d_sev0 WHERE {low} AND (acos_roll_sev_raw IS NOT NULL OR acos_yoy_sev_raw IS NOT NULL)""",
         ["sales", "actual_value"])
    _reg("combined_severity", det, _stack("d_sev", {"severity": label("{m}_sev0"), "triggered_by": "{m}_trig0"},
                                          "severity"))
    _reg("zero_run_length", det, "SELECT asin, date, units, CAST(zero_run AS INTEGER) AS zero_run FROM d_base", ["units"])
    for name, only, ms in (("floor_return_rate", ["return_rate"], ["return_rate"]),
                           ("floor_margin", ["margin"], ["margin"]),
                           ("floor_zero_sales", ["zero_sales"], ["sales"]),
                           ("floor_acos_spike", ["acos_spike"], ["acos"]),
                           ("acos_gate", ["acos_spike", "acos_clear"], ["acos"])):
        d2 = MASTER + detection_ctes("master", CFG, only=only)
        _reg(name, d2, _stack("d_scored", {"severity": label("{m}_sev"), "triggered_by": "{m}_trig"}, "severity", ms))
    _reg("floor_conversion_drop", MASTER + detection_ctes("master", conversion_drop_config(), only=["conversion_drop"]),
         _stack("d_scored", {"severity": label("{m}_sev"), "triggered_by": "{m}_trig"}, "severity", ["conversion_rate"]))
    _reg("absolute_overrides", det, "SELECT asin, date, " + ", ".join(
        f"{label(m + '_sev')} AS {m}_severity, {m}_trig AS {m}_triggered_by" for m in M) + " FROM d_scored")
    _reg("long_alerts", det + [("a", long_sql("d_scored", CFG, improvements=False))], "SELECT * FROM a", ALERT_DOUBLES)
    _reg("improvements", det + [("a", long_sql("d_scored", CFG, alerts=False))], "SELECT * FROM a", ALERT_DOUBLES)
    _reg("yoy_available", MASTER, f"""SELECT asin, CAST(datediff('day', min(date), max(date)) AS INTEGER) AS span_days,
        datediff('day', min(date), max(date)) >= {CFG.min_history_days} AS yoy_available FROM master GROUP BY asin""")
    for name in ("detect_day", "detect_day_state"):
        _reg(name, det + [("alerts", long_sql("d_scored", CFG))],
             "SELECT * FROM alerts WHERE date = (SELECT max(date) FROM master)", ALERT_DOUBLES)
    _reg("chunked_baseline", det, "SELECT asin, date, CAST(zero_run AS INTEGER) AS zero_run, yoy_available, " + ", ".join(
        f"{m}_roll_mean, {m}_roll_std, {m}_yoy_mean" for m in M) + " FROM d_base")



# --------------------------------------------------------------------------- alerts / digest / backtest



def _inlist(vals) -> str:
    return "(" + ", ".join(lit(v) for v in vals) + ")"


def tier_rank_sql(c: str = "tier") -> str:
    return "(CASE " + " ".join(f"WHEN {c} = {lit(t)} THEN {i}" for i, t in enumerate(TIER_ORDER)) + f" ELSE {len(TIER_ORDER)} END)"


def sev_order_sql(c: str = "severity") -> str:
    return "(CASE " + " ".join(f"WHEN {c} = {lit(t)} THEN {i}" for i, t in enumerate(SEVERITY_ORDER)) + f" ELSE {len(SEVERITY_ORDER)} END)"


def _num(x: str, d: int) -> str:
    return f"printf('%.{d}f', {x})"


def _grouped(x: str, d: int) -> str:
    return f"format('{{:,.{d}f}}', {x})"


def fmt_sql(v: str, metric: str = "metric") -> str:
    return (f"(CASE WHEN {v} IS NULL THEN 'N/A' "
            f"WHEN {metric} IN {_inlist(PCT_METRICS)} THEN {_num(v + ' * 100', 1)} || '%' "
            f"WHEN {metric} IN {_inlist(DOLLAR_METRICS)} THEN '$' || {_grouped(v, 2)} "
            f"WHEN {metric} IN {_inlist(RANK_METRICS)} THEN '#' || format('{{:,}}', CAST(trunc({v}) AS BIGINT)) "
            f"WHEN {metric} IN {_inlist(RATING_METRICS)} THEN {_num(v, 1)} || '★' "
            f"WHEN {metric} IN {_inlist(COUNT_METRICS)} THEN format('{{:,}}', CAST(trunc({v}) AS BIGINT)) "
            f"ELSE {_grouped(v, 2)} END)")


def _sign(x: str) -> str:
    return f"(CASE WHEN {x} >= 0 THEN '+' ELSE '' END)"


def map_sql(c: str, pairs, passthrough: bool = True) -> str:
    body = " ".join(f"WHEN {c} = {lit(k)} THEN {lit(v)}" for k, v in pairs)
    return f"(CASE {body} ELSE {c if passthrough else 'NULL'} END)"


YOY_FIRST = "(triggered_by IN ('yoy', 'both') AND yoy_baseline IS NOT NULL)"
SHOWN_BASE = f"(CASE WHEN {YOY_FIRST} THEN yoy_baseline ELSE expected_value END)"


def display_deviation_sql() -> str:
    diff = f"(actual_value - {SHOWN_BASE})"
    s = _sign(diff)
    return (f"(CASE WHEN {diff} IS NULL THEN '—' "
            f"WHEN metric IN {_inlist(PCT_METRICS)} THEN {s} || {_num(diff + ' * 100', 1)} || 'pp' "
            f"WHEN metric IN {_inlist(DOLLAR_METRICS)} THEN (CASE WHEN {diff} >= 0 THEN '+' ELSE '-' END) || '$' || {_grouped('abs(' + diff + ')', 2)} "
            f"WHEN metric IN {_inlist(RANK_METRICS + COUNT_METRICS)} THEN {s} || {_grouped(diff, 0)} "
            f"WHEN metric IN {_inlist(RATING_METRICS)} THEN {s} || {_num(diff, 2)} || '★' "
            f"ELSE {s} || {_grouped(diff, 2)} END)")


def fill_sql(template: str, **parts) -> str:
    """A text template with ``{name}`` placeholders as one ``||`` chain."""
    import re
    pieces = []
    for i, tok in enumerate(re.split(r"\{(\w+)\}", template)):
        if i % 2:
            pieces.append(f"({parts[tok]})")
        elif tok:
            pieces.append(lit(tok))
    return "(" + " || ".join(pieces) + ")" if pieces else "''"


def pointed_sql(flags: str = "flags") -> str:
    has = lambda m: f"list_contains(string_split(COALESCE({flags}, ''), ','), {lit(m)})"
    whens = []
    for m, others, text in HINTS:
        if others == ("reason",):
            whens.append(f"WHEN metric = {lit(m)} AND top_return_reason IS NOT NULL THEN {fill_sql(text, reason='top_return_reason')}")
        else:
            cond = " AND ".join([f"metric = {lit(m)}"] + [has(o) for o in others])
            whens.append(f"WHEN {cond} THEN {lit(text)}")
    return "(CASE " + " ".join(whens) + " ELSE '' END)"


MARGIN_IMPACT = ("(CASE WHEN metric = 'margin' AND triggered_by IN ('yoy', 'both') AND sales_roll_mean > 0 "
                 "AND actual_value IS NOT NULL AND yoy_baseline IS NOT NULL "
                 "THEN abs(actual_value - yoy_baseline) * sales_roll_mean END)")


def explanation_sql(flags: str = "flags") -> str:
    base = dict(label=map_sql("metric", METRIC_LABELS), product="COALESCE(title, asin)",
                actual=fmt_sql("actual_value"), expected=fmt_sql("expected_value"))
    reason = (f"(CASE WHEN metric = 'return_rate' AND top_return_reason IS NOT NULL THEN "
              f"{fill_sql(SENTENCES['reason'], reason='top_return_reason')} ELSE '' END)")
    pointed = pointed_sql(flags)
    causes = f"(CASE WHEN {pointed} <> '' THEN ' ' || {pointed} ELSE '' END)"
    impact = (f"(CASE WHEN {MARGIN_IMPACT} IS NOT NULL THEN {fill_sql(SENTENCES['impact'], impact=_grouped(MARGIN_IMPACT, 0))} "
              f"ELSE '' END)")
    move = (f"(CASE WHEN metric IN ('review_rating', 'review_count') AND z_score IS NOT NULL THEN "
            f"(CASE WHEN z_score > 0 THEN {lit(SENTENCES['move_up'])} ELSE {lit(SENTENCES['move_down'])} END) ELSE '' END)")
    diff = "(actual_value - yoy_baseline)"
    abs_diff = (f"(CASE WHEN metric IN {_inlist(PCT_METRICS)} THEN {_num('abs(' + diff + ') * 100', 1)} || 'pp' "
                f"WHEN metric IN {_inlist(DOLLAR_METRICS)} THEN '$' || {_grouped('abs(' + diff + ')', 2)} "
                f"ELSE {_grouped('abs(' + diff + ')', 2)} END)")
    absolute = f"{fill_sql(SENTENCES['absolute'], **base)} || {reason} || {causes}"
    yoy_side = f"CASE WHEN {diff} >= 0 THEN 'above' ELSE 'below' END"
    z_side = "CASE WHEN z_score > 0 THEN 'above' ELSE 'below' END"
    yoy = (fill_sql(SENTENCES["yoy"], **base, diff=abs_diff, side=yoy_side, yoy=fmt_sql("yoy_baseline"))
           + f" || {impact} || {reason} || {causes}")
    zs = (fill_sql(SENTENCES["zscore"], **base, move=move, z=_num("abs(z_score)", 1), side=z_side)
          + f" || {reason} || {causes}")
    fallback = f"{fill_sql(SENTENCES['fallback'], **base)} || {reason}"
    return (f"(CASE WHEN triggered_by = 'absolute_threshold' THEN {absolute} "
            f"WHEN triggered_by IN ('yoy', 'both') AND yoy_baseline IS NOT NULL AND actual_value IS NOT NULL THEN {yoy} "
            f"WHEN z_score IS NOT NULL THEN {zs} ELSE {fallback} END)")


def subject_sql(cfg: Config = CFG) -> str:
    return (f"printf('{cfg.subject_prefix} %s | %d Critical | %d Warning | %d Watch', strftime(date, '%Y-%m-%d'), "
            f"n_critical, n_warning, n_watch) || (CASE WHEN n_improvement > 0 THEN printf(' | %d Improving', n_improvement) ELSE '' END)")


ALERT_COLS = ("asin, date, tier, title, category_bsr, yoy_available, top_return_reason, metric, actual_value, "
              "expected_value, yoy_baseline, z_score, yoy_deviation, severity, triggered_by, sales_roll_mean")


def _caps_case(cfg: Config = CFG) -> str:
    parts = " ".join(f"WHEN severity = {lit(s)} THEN {int(c)}" for s, c in cfg.caps.items() if c)
    return f"(CASE {parts} ELSE NULL END)"


def alert_stage_ctes(cfg: Config = CFG) -> List[tuple]:
    sup = "NOT (tier IS NOT DISTINCT FROM 'less_than_single')" if cfg.suppress_less_than_single else "TRUE"
    return alerts_ctes(cfg) + [
        ("suppressed", f"SELECT * FROM alerts WHERE {sup}"),
        ("capped", f"""SELECT {ALERT_COLS} FROM (
            SELECT *, row_number() OVER (PARTITION BY date, severity ORDER BY {tier_rank_sql()}, asin, metric) AS _r,
                   {_caps_case(cfg)} AS _cap FROM suppressed) WHERE _cap IS NULL OR _r <= _cap"""),
        ("flags", """SELECT date, asin, array_to_string(list_sort(list(DISTINCT metric)), ',') AS flags
                     FROM capped WHERE severity <> 'improvement' GROUP BY date, asin"""),
        ("with_flags", "SELECT c.*, f.flags FROM capped c LEFT JOIN flags f ON f.date = c.date AND f.asin = c.asin"),
        ("summary", f"""SELECT date, {", ".join(f"CAST(count_if(severity = {lit(s)}) AS BIGINT) AS n_{s}" for s in SEVERITY_ORDER)},
                        count(*) AS n_total, count(DISTINCT asin) AS n_asins FROM capped GROUP BY date"""),
    ]


def top_sql(src: str, cfg: Config = CFG, extra: str = "") -> str:
    return f"""SELECT * FROM (
        SELECT *{extra}, CAST(row_number() OVER (PARTITION BY date ORDER BY {sev_order_sql()}, {tier_rank_sql()}, asin, metric) AS INTEGER) AS position
        FROM {src} WHERE severity IN ('critical', 'warning')) WHERE position <= {cfg.top_n}"""


def lookback_sql(cfg: Config = CFG) -> str:
    return f"SELECT * FROM alerts WHERE date >= (SELECT max(date) FROM alerts) - {cfg.lookback_days}"


def pivot_sql(by: str) -> str:
    cnt = ", ".join(f"CAST(count_if(severity = {lit(s)}) AS BIGINT) AS {s}" for s in ("critical", "warning", "watch"))
    return f"SELECT {by}, {cnt}, CAST(count_if(severity = 'critical') AS BIGINT) + CAST(count_if(severity = 'warning') AS BIGINT) + CAST(count_if(severity = 'watch') AS BIGINT) AS total FROM lb GROUP BY {by}"


def _build_alerts(cfg: Config = CFG) -> None:
    A = alert_stage_ctes(cfg)
    keys = "date, asin, metric, severity"
    _reg("flagged_rows", A, "SELECT * FROM alerts WHERE severity IS NOT NULL AND severity <> 'None'")
    _reg("anchor_filter", A, "SELECT * FROM alerts WHERE date = (SELECT max(date) FROM alerts)")
    _reg("alert_suppress", A, "SELECT * FROM suppressed")
    _reg("alert_caps", A, "SELECT * FROM capped")
    _reg("tier_sort", A, f"""SELECT date, asin, metric, severity, tier, {tier_rank_sql()} AS tier_rank,
        CAST(row_number() OVER (PARTITION BY date ORDER BY {tier_rank_sql()}, asin, metric) AS INTEGER) AS position FROM capped""")
    _reg("top_alerts", A, f"SELECT date, position, asin, metric, severity, tier FROM ({top_sql('capped', cfg)})")
    _reg("cross_metric_flags", A, "SELECT * FROM flags")
    _reg("fmt_value", A, f"""SELECT {keys}, {fmt_sql('actual_value')} AS actual_fmt, {fmt_sql('expected_value')} AS expected_fmt,
        {fmt_sql('yoy_baseline')} AS yoy_fmt FROM alerts""")
    _reg("fmt_signed", A, f"""SELECT {keys},
        (CASE WHEN yoy_deviation IS NULL THEN 'N/A' ELSE {_sign('yoy_deviation')} || {_num('yoy_deviation * 100', 1)} || '%' END) AS deviation_fmt,
        (CASE WHEN z_score IS NULL THEN 'N/A' ELSE {_sign('z_score')} || {_num('z_score', 2)} || 'σ' END) AS z_fmt FROM alerts""")
    _reg("display_expected", A, f"""SELECT {keys}, triggered_by, (CASE WHEN {YOY_FIRST} THEN {fmt_sql('yoy_baseline')}
        WHEN triggered_by = 'absolute_threshold' AND expected_value IS NULL THEN 'Business rule'
        ELSE {fmt_sql('expected_value')} END) AS expected_display FROM alerts""")
    _reg("display_deviation", A, f"SELECT {keys}, triggered_by, {display_deviation_sql()} AS deviation_display FROM alerts")
    _reg("trigger_labels", A, f"""SELECT {keys}, {map_sql('triggered_by', TRIGGER_LABELS)} AS trigger_label,
        {map_sql('triggered_by', SHORT_TRIGGERS)} AS trigger_short, {map_sql('tier', TIER_LABELS)} AS tier_label FROM alerts""")
    _reg("pointed_reason", A, f"SELECT {keys}, {pointed_sql()} AS pointed_reason FROM with_flags")
    _reg("margin_impact", A, f"SELECT {keys}, {MARGIN_IMPACT} AS daily_margin_impact FROM alerts WHERE {MARGIN_IMPACT} IS NOT NULL")
    _reg("explanations", A, f"SELECT date, position, asin, metric, severity, {explanation_sql()} AS explanation FROM ({top_sql('with_flags', cfg)})")
    _reg("digest_summary", A, "SELECT * FROM summary")
    _reg("digest_subject", A, f"SELECT date, {subject_sql(cfg)} AS subject FROM summary")
    _reg("section_rows", A, f"""SELECT date, {sev_order_sql()} AS section,
        CAST(row_number() OVER w AS INTEGER) AS row_in_section,
        (lag(COALESCE(tier, '')) OVER w IS NULL OR lag(COALESCE(tier, '')) OVER w <> COALESCE(tier, '')) AS is_group_head,
        severity, tier, asin, metric
        FROM capped WINDOW w AS (PARTITION BY date, severity ORDER BY {tier_rank_sql()}, asin, metric)""")
    _reg("data_through", A, f"""SELECT date, CAST(date + {cfg.data_lag_days} AS DATE) AS run_date, date AS data_through,
        CAST(date + {cfg.data_lag_days} - {cfg.data_lag_days} AS DATE) AS data_through_default FROM (SELECT DISTINCT date FROM alerts)""")
    _reg("digest", A, f"""SELECT d.date,
        CASE WHEN COALESCE(s.n_total, 0) = 0 THEN {fill_sql(SENTENCES['no_alerts'], prefix=lit(cfg.subject_prefix), day="strftime(d.date, '%Y-%m-%d')")}
             ELSE {subject_sql(cfg).replace('date', 's.date').replace("s.s.date", "s.date")} END AS subject,
        COALESCE(s.n_total, 0) AS n_rows, COALESCE(s.n_asins, 0) AS n_asins
        FROM (SELECT DISTINCT date FROM master) d LEFT JOIN summary s ON s.date = d.date""")
    line = (f"concat_ws(' | ', {map_sql('metric', METRIC_LABELS)}, COALESCE(title, asin), {fmt_sql('actual_value')}, {display_deviation_sql()}, "
            f"(CASE WHEN {YOY_FIRST} THEN {fmt_sql('yoy_baseline')} WHEN triggered_by = 'absolute_threshold' AND expected_value IS NULL "
            f"THEN 'Business rule' ELSE {fmt_sql('expected_value')} END))")
    _reg("digest_document", A + [
        ("rows_", f"""SELECT date, severity, {sev_order_sql()} AS section, row_number() OVER w AS r,
             CASE WHEN lag(COALESCE(tier, '')) OVER w IS NULL OR lag(COALESCE(tier, '')) OVER w <> COALESCE(tier, '')
                  THEN '  ' || COALESCE({map_sql('tier', TIER_LABELS)}, 'no tier') || chr(10) ELSE '' END || '    ' || {line} AS txt
             FROM with_flags WINDOW w AS (PARTITION BY date, severity ORDER BY {tier_rank_sql()}, asin, metric)"""),
        ("sections_", """SELECT date, section, count(*) AS n, upper(severity) || ' (' || count(*) || ')' || chr(10)
             || string_agg(txt, chr(10) ORDER BY r) AS txt FROM rows_ GROUP BY date, section, severity"""),
        ("all_", """SELECT date, count(*) AS n_sections, sum(n) AS n_rows, string_agg(txt, chr(10) ORDER BY section) AS txt
             FROM sections_ GROUP BY date"""),
        ("top_", f"""SELECT date, count(*) AS n_top, string_agg(position || '. [' || severity || '] ' || {explanation_sql()}, chr(10)
             ORDER BY position) AS txt FROM ({top_sql('with_flags', cfg)}) GROUP BY date""")],
         f"""SELECT d.date, COALESCE(j.subject, {fill_sql(SENTENCES['no_alerts'], prefix=lit(cfg.subject_prefix), day="strftime(d.date, '%Y-%m-%d')")}) AS subject,
             d.date AS data_through, concat_ws(chr(10), 'Data through ' || strftime(d.date, '%Y-%m-%d'), t.txt, a.txt) AS body,
             CAST(COALESCE(t.n_top, 0) AS INTEGER) AS n_top, CAST(COALESCE(a.n_sections, 0) AS INTEGER) AS n_sections,
             CAST(COALESCE(a.n_rows, 0) AS INTEGER) AS n_rows
             FROM (SELECT DISTINCT date FROM master) d LEFT JOIN (SELECT date, {subject_sql(cfg)} AS subject FROM summary) j ON j.date = d.date
             LEFT JOIN top_ t ON t.date = d.date LEFT JOIN all_ a ON a.date = d.date""")
    _reg("severity_breakdown", A, """SELECT 'severity' AS dimension, severity AS value, count(*) AS n FROM alerts GROUP BY severity
        UNION ALL SELECT 'triggered_by', triggered_by, count(*) FROM alerts GROUP BY triggered_by""")
    L = A + [("lb", lookback_sql(cfg))]
    _reg("lookback_window", L, "SELECT * FROM lb")
    _reg("backtest_daily", L, pivot_sql("date"))
    _reg("backtest_by_metric", L, pivot_sql("metric"))
    _reg("backtest_by_trigger", L, pivot_sql("triggered_by"))
    D_ = L + [("daily", pivot_sql("date"))]
    stats = ("SELECT avg(critical) AS avg_critical, avg(warning) AS avg_warning, avg(watch) AS avg_watch, "
             "avg(total) AS avg_total, max(critical) AS max_critical, max(total) AS max_total FROM daily")
    _reg("backtest_daily_stats", D_, stats)
    _reg("backtest_verdict", D_, f"""SELECT avg_critical, CASE WHEN avg_critical > 20 THEN 'too_loose'
        WHEN avg_critical > 10 THEN 'borderline' ELSE 'ok' END AS verdict FROM ({stats})""")
    tiers = " UNION ALL ".join(f"SELECT {lit(t)} AS tier, {i} AS tier_rank" for i, t in enumerate(TIER_ORDER))
    _reg("backtest_by_tier", L + [("crit", "SELECT tier, count(*) AS n FROM lb WHERE severity = 'critical' GROUP BY tier"),
                                  ("tiers", tiers)],
         f"""SELECT t.tier, COALESCE(c.n, 0) AS critical_count,
             COALESCE(COALESCE(c.n, 0) * 100.0 / NULLIF(CAST((SELECT sum(n) FROM crit WHERE tier IN {_inlist(TIER_ORDER)}) AS DOUBLE), 0), 0.0) AS pct
             FROM tiers t LEFT JOIN crit c ON c.tier = t.tier""")
    _reg("backtest_noisiest", L, """SELECT asin, tier, count(*) AS critical_count FROM lb
        WHERE severity = 'critical' AND tier IS NOT NULL GROUP BY asin, tier ORDER BY critical_count DESC, asin LIMIT 10""")
    _reg("backtest_floor_audit", L, f"""SELECT *, CASE WHEN total > 0 THEN by_floor * 100.0 / total END AS pct_floor,
        CASE WHEN total > 0 THEN by_stats * 100.0 / total END AS pct_stats FROM (
        SELECT count(*) AS total, CAST(count_if(triggered_by = 'absolute_threshold') AS BIGINT) AS by_floor,
               CAST(count_if(NOT COALESCE(triggered_by = 'absolute_threshold', FALSE)) AS BIGINT) AS by_stats,
               {", ".join(f"CAST(count_if(triggered_by = 'absolute_threshold' AND severity = {lit(s)}) AS BIGINT) AS floor_{s}" for s in ("critical", "warning", "watch"))}
        FROM lb WHERE metric = 'return_rate')""")
    _reg("distinct_products", A, """SELECT d.date, count(DISTINCT CASE WHEN a.date = d.date THEN a.asin END) AS n_asins_1,
        count(DISTINCT CASE WHEN a.date > d.date - 7 THEN a.asin END) AS n_asins_7, count(DISTINCT a.asin) AS n_asins_30
        FROM (SELECT DISTINCT date FROM alerts) d JOIN (SELECT DISTINCT date, asin FROM alerts) a
        ON a.date <= d.date AND a.date > d.date - 30 GROUP BY d.date""")
    _reg("backtest_range", A, f"""SELECT min(date) AS first_date, max(date) AS last_date, count(DISTINCT date) AS n_days,
        count(DISTINCT CASE WHEN date >= (SELECT max(date) FROM alerts) - {cfg.lookback_days} THEN date END) AS n_days_lookback,
        count(*) AS n_alerts, CAST(count_if(date >= (SELECT max(date) FROM alerts) - {cfg.lookback_days}) AS BIGINT) AS n_alerts_lookback FROM alerts""")




# --------------------------------------------------------------------------- ingestion / master / snapshot / listings

RATES = ("return_rate", "conversion_rate", "margin", "acos", "tacos")

SALES = BRAND_DAILY + [
    ("sales_base", f"""
      SELECT *, 'sales/' || CAST(year(date) AS VARCHAR) || '.csv' AS _src_path,
             CAST(datediff('day', make_date(year(date), 1, 1), date) * 100 + {_brand_no('asin')} AS BIGINT) AS _src_row,
             0.0 AS _bump, datediff('day', DATE '1995-01-01', date) * 31 + {_brand_no('asin')} AS _ord,
             CASE WHEN year(date) % 2 = 0 THEN 100.0 ELSE 1.0 END AS _scale
      FROM brand_daily"""),
    ("sales_u", """
      SELECT * FROM sales_base UNION ALL
      SELECT * REPLACE ('sales/' || CAST(year(date) AS VARCHAR) || '_update.csv' AS _src_path, 1.0 AS _bump)
      FROM sales_base WHERE day(date) <= 7"""),
    ("sales_rows", f"""
      SELECT asin, date, _src_path, _src_row, '  ' || lower(asin) || ' ' AS raw_key, strftime(date, '%m-%d-%Y') AS raw_date,
             {", ".join(f"{r} * _scale AS {r}_raw" for r in RATES)},
             CASE WHEN _ord % 97 = 0 THEN NULL ELSE sales + _bump END AS sales, units, orders, 'Product ' || asin AS title
      FROM sales_u"""),
    ("pct_max", f"SELECT _src_path, {', '.join(f'max(abs({r}_raw)) AS {r}_mx' for r in RATES)} FROM sales_rows GROUP BY _src_path"),
    ("sales_std", f"""
      SELECT s.asin, s.date, s.sales, s.units, s.orders,
             {", ".join(f"CASE WHEN p.{r}_mx > 1 THEN s.{r}_raw / 100.0 ELSE s.{r}_raw END AS {r}" for r in RATES)},
             s.title, s._src_path, s._src_row
      FROM sales_rows s JOIN pct_max p ON p._src_path = s._src_path"""),
]


def file_date_sql(name: str = "name") -> str:
    return (f"COALESCE(CAST(try_strptime(NULLIF(regexp_extract({name}, '(\\d{{4}}-\\d{{2}}-\\d{{2}})', 1), ''), '%Y-%m-%d') AS DATE), "
            f"CAST(try_strptime(NULLIF(regexp_extract({name}, '([A-Z][a-z]+ \\d{{1,2}}, \\d{{4}})', 1), ''), '%b %d, %Y') AS DATE))")


MANIFEST = [
    ("manifest0", """
      SELECT ['sellerise', 'returns', 'inventory', 'helium10'][CAST(o_custkey % 4 + 1 AS INTEGER)] AS folder,
             CASE o_orderkey % 4 WHEN 0 THEN 'My Products' || strftime(o_orderdate, '%Y-%m-%d') || '.xlsx'
                                 WHEN 1 THEN 'Restock Inventory ' || strftime(o_orderdate, '%b %d, %Y') || '.csv'
                                 WHEN 2 THEN 'Restock Inventory ' || strftime(o_orderdate, '%B %d, %Y') || '.csv'
                                 ELSE 'export_' || CAST(o_orderkey AS VARCHAR) || '.csv' END AS name,
             o_orderkey
      FROM orders"""),
    ("manifest", f"""
      SELECT folder || '/' || CAST(o_orderkey AS VARCHAR) || '/' || name AS path, name, 1 AS depth, folder,
             {file_date_sql()} AS file_date
      FROM manifest0"""),
    ("anchor", "SELECT max(file_date) AS d FROM manifest WHERE folder = 'helium10'"),
]


def snapshot_scores_sql(cfg: Config = CFG, src: str = "snapshot_hist") -> List[tuple]:
    parts = []
    n, k = cfg.rolling_window, cfg.rolling_min_periods
    frame = f"(PARTITION BY asin ORDER BY date ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"
    for m in cfg.snapshot_metrics:
        d = cfg.direction.get(m, "down")
        parts.append(f"""SELECT asin, date, '{m}' AS metric, value, roll_mean, z_score,
               {sev_case(bad('z_score', d), cfg.z_thresholds.get(m, (1.5, 2.0, 3.0)))} AS sev FROM (
            SELECT *, round((value - roll_mean) / NULLIF(roll_std, 0), {cfg.score_digits}) + 0.0 AS z_score FROM (
              SELECT asin, date, {m} AS value,
                     round(CASE WHEN count({m}) OVER {frame} >= {k} THEN list_sum(list({m}) OVER {frame}) / count({m}) OVER {frame} END,
                           {cfg.digits(m)}) + 0.0 AS roll_mean,
                     round(CASE WHEN count({m}) OVER {frame} >= {k} THEN stddev_samp({m}) OVER {frame} END, {cfg.std_digits(m)}) + 0.0 AS roll_std
              FROM {src} WHERE {m} IS NOT NULL AND (SELECT count(DISTINCT date) FROM {src}) >= {cfg.snapshot_min_dates}))""")
    ctes = [("snap_s0", " UNION ALL ".join(parts)), ("snap_s1", "SELECT *, CASE WHEN sev IS NOT NULL THEN 'rolling' END AS trig FROM snap_s0")]
    prev = "snap_s1"
    for i, (floor, level) in enumerate(((cfg.review_rating_critical, 3), (cfg.review_rating_warning, 2))):
        if floor is None:
            continue
        mask = f"(metric = 'review_rating' AND value < {lit(floor)})"
        ctes.append((f"snap_f{i}", f"""SELECT * REPLACE (
            CASE WHEN {mask} THEN greatest(COALESCE(sev, 0), {level}) ELSE sev END AS sev,
            COALESCE(trig, CASE WHEN {mask} THEN 'absolute_threshold' END) AS trig) FROM {prev}"""))
        prev = f"snap_f{i}"
    ctes.append(("snap_scores", f"SELECT * FROM {prev}"))
    return ctes


SNAP_DETECT_SQL = f"""
    SELECT s.asin, s.date, FALSE AS yoy_available, s.metric, s.value AS actual_value, s.roll_mean AS expected_value,
           CAST(NULL AS DOUBLE) AS yoy_baseline, s.z_score, CAST(NULL AS DOUBLE) AS yoy_deviation,
           {label('s.sev')} AS severity, s.trig AS triggered_by, m.tier, m.title, m.is_hero, m.category_bsr
    FROM snap_scores s LEFT JOIN meta m ON m.asin = s.asin WHERE s.sev IS NOT NULL"""
META_SQL = """SELECT asin, arg_min(tier, date) AS tier, CAST(NULL AS VARCHAR) AS title, arg_min(is_hero, date) AS is_hero,
                     arg_min(category_bsr, date) AS category_bsr FROM master GROUP BY asin"""


def _build_ingest(cfg: Config = CFG) -> None:
    S = SALES
    _reg("key_normalize", S, "SELECT _src_path, _src_row, raw_key, upper(regexp_replace(raw_key, '^\\s+|\\s+$', '', 'g')) AS asin FROM sales_rows")
    _reg("date_parse_mdy", S, "SELECT _src_path, _src_row, raw_date, CAST(try_strptime(raw_date, '%m-%d-%Y') AS DATE) AS date FROM sales_rows")
    _reg("numeric_coerce", S, "SELECT _src_path, _src_row, sales, units FROM sales_rows")
    _reg("pct_scale_normalize", S, f"SELECT _src_path, _src_row, {', '.join(RATES)} FROM sales_std")
    _reg("std_sales", S, "SELECT asin, date, sales, units, orders, return_rate, conversion_rate, margin, acos, tacos, title, _src_path, _src_row FROM sales_std")
    _reg("dedup_keep_last", S, """SELECT asin, date, sales, units, acos, _src_path, _src_row FROM (
        SELECT *, row_number() OVER (PARTITION BY asin, date ORDER BY _src_path DESC, _src_row DESC) AS rn FROM sales_std) WHERE rn = 1""")
    _reg("multi_file_union", S, """SELECT _src_path, _src_row, raw_key AS "ASIN", raw_date AS "Date", sales AS "Sales",
        CASE WHEN _src_path LIKE '%_update%' THEN NULL ELSE orders END AS "Orders",
        CASE WHEN _src_path LIKE '%_update%' THEN NULL ELSE title END AS "Title" FROM sales_rows""")
    R = S + RETURNS + INVENTORY + SNAPSHOT
    _reg("source_stats", R, """
        SELECT 'sales' AS source, count(*) AS n_rows, count(DISTINCT asin) AS n_asins, min(date) AS min_date, max(date) AS max_date FROM sales_std
        UNION ALL SELECT 'returns', count(*), count(DISTINCT asin), min(date), max(date) FROM returns_agg
        UNION ALL SELECT 'inventory', count(*), count(DISTINCT asin), CAST(NULL AS DATE), CAST(NULL AS DATE) FROM inventory
        UNION ALL SELECT 'snapshot_history', count(*), count(DISTINCT asin), min(date), max(date) FROM snapshot_hist""")
    _reg("iso_to_date", R, """SELECT "return-date" AS raw, TRY_CAST(substr("return-date", 1, 10) AS DATE) AS date, count(*) AS n
        FROM returns_raw GROUP BY 1, 2""")
    _reg("returns_agg", R, "SELECT * FROM returns_agg")
    _reg("std_returns", R, "SELECT asin, date, return_count FROM returns_agg")
    _reg("join_returns", R, """SELECT b.asin, b.date, b.sales, r.return_count, r.top_return_reason FROM brand_daily b
        LEFT JOIN returns_agg r ON r.asin = b.asin AND r.date = b.date""")
    _reg("std_inventory", R, "SELECT * FROM inventory")
    _reg("join_inventory", R, "SELECT b.asin, b.date, b.sales, i.* EXCLUDE (asin) FROM brand_daily b LEFT JOIN inventory i ON i.asin = b.asin")
    _reg("std_snapshot", R, "SELECT * FROM listing")
    _reg("join_snapshot", R, "SELECT b.asin, b.date, b.sales, l.* EXCLUDE (asin) FROM brand_daily b LEFT JOIN listing l ON l.asin = b.asin")
    _reg("merge_sources", R, MERGED_SELECT.format(src="brand_daily"))
    _reg("trailing_revenue", R, f"""SELECT asin, COALESCE(SUM(CAST(round(sales * 10000) AS BIGINT)) / 10000.0, 0.0) AS trailing_12m_revenue
        FROM brand_daily WHERE date >= CAST((SELECT max(date) FROM brand_daily) - INTERVAL {cfg.trailing_months} MONTH AS DATE) GROUP BY asin""")
    T = R + [("bt", tiers_sql("brand_daily", cfg))]
    _reg("assign_tiers", T, "SELECT DISTINCT asin, tier, trailing_12m_revenue, is_hero FROM bt")
    _reg("tier_counts", T, """SELECT tier, count(*) AS n_asins, CAST(COALESCE(sum(CAST(is_hero AS INTEGER)), 0) AS BIGINT) AS n_hero
        FROM (SELECT DISTINCT asin, tier, is_hero FROM bt) GROUP BY tier""")
    _reg("snapshot_gate", SNAPSHOT, f"SELECT count(DISTINCT date) AS n_dates, count(DISTINCT date) >= {cfg.snapshot_min_dates} AS active FROM snapshot_hist")
    SS = MASTER + snapshot_scores_sql(cfg) + [("meta", META_SQL)]
    _reg("snapshot_detect", SS, SNAP_DETECT_SQL)
    _reg("floor_review_rating", SS, f"""SELECT asin, date, value AS actual_value, z_score, {label('sev')} AS severity, trig AS triggered_by
        FROM snap_scores WHERE metric = 'review_rating' AND sev IS NOT NULL""")
    _reg("snapshot_meta_join", SS, "SELECT * FROM meta")
    _reg("all_alerts", SS + detection_ctes("master", cfg) + [("alerts", long_sql("d_scored", cfg)), ("snap_alerts", SNAP_DETECT_SQL)],
         "SELECT * FROM alerts UNION ALL BY NAME SELECT * FROM snap_alerts")
    rows = " UNION ALL ".join(f"SELECT {lit(m)} AS metric, {lit(cfg.direction[m])} AS direction, {lit(float(w))} AS watch, "
                              f"{lit(float(wa))} AS warning, {lit(float(c))} AS critical" for m in M for (w, wa, c) in [cfg.z_thresholds[m]])
    det = MASTER + detection_ctes("master", cfg)
    zl = " UNION ALL ".join(f"SELECT asin, date, '{m}' AS metric, {m}_roll_zscore AS z_score FROM d_base" for m in M)
    _reg("threshold_join", det + [("thr", rows), ("zl", zl)], """SELECT * FROM (
        SELECT z.asin, z.date, z.metric, z.z_score, CASE
          WHEN (CASE t.direction WHEN 'both' THEN abs(z.z_score) WHEN 'up' THEN z.z_score ELSE -z.z_score END) >= t.critical THEN 'critical'
          WHEN (CASE t.direction WHEN 'both' THEN abs(z.z_score) WHEN 'up' THEN z.z_score ELSE -z.z_score END) >= t.warning THEN 'warning'
          WHEN (CASE t.direction WHEN 'both' THEN abs(z.z_score) WHEN 'up' THEN z.z_score ELSE -z.z_score END) >= t.watch THEN 'watch' END AS severity
        FROM zl z JOIN thr t ON t.metric = z.metric WHERE z.z_score IS NOT NULL) WHERE severity IS NOT NULL""")
    F_ = MANIFEST
    _reg("file_date_extract", F_, "SELECT path, name, file_date FROM manifest")
    _reg("file_date_prune", F_, "SELECT path, file_date FROM manifest WHERE folder = 'returns' AND file_date = (SELECT d FROM anchor)")
    _reg("latest_file_date", F_, "SELECT folder, max(file_date) AS latest_date FROM manifest GROUP BY folder")
    _reg("returns_scan_fallback", F_, """SELECT path, file_date FROM manifest WHERE folder = 'returns' AND (file_date = (SELECT d FROM anchor)
        OR NOT EXISTS (SELECT 1 FROM manifest WHERE folder = 'returns' AND file_date = (SELECT d FROM anchor)))""")
    _reg("inventory_scan_fallback", F_ + [("inv", "SELECT * FROM manifest WHERE folder = 'inventory'"),
                                          ("tgt", "SELECT d + 1 AS d FROM anchor")], """
        SELECT path, file_date FROM inv WHERE CASE
          WHEN EXISTS (SELECT 1 FROM inv WHERE file_date = (SELECT d FROM tgt)) THEN file_date = (SELECT d FROM tgt)
          WHEN EXISTS (SELECT 1 FROM inv WHERE file_date IS NOT NULL) THEN path = (
            SELECT arg_min(path, depth::VARCHAR || '|' || path) FROM inv WHERE file_date = (SELECT max(file_date) FROM inv))
          ELSE TRUE END""")
    _reg("snapshot_scan", F_ + [("h", "SELECT * FROM manifest WHERE folder = 'helium10'")], """
        SELECT path, file_date FROM h WHERE CASE WHEN EXISTS (SELECT 1 FROM h WHERE file_date IS NOT NULL)
          THEN file_date = (SELECT max(file_date) FROM h) ELSE TRUE END""")
    _reg("snapshot_append", SNAPSHOT, "SELECT * EXCLUDE (date), date AS snapshot_date FROM snapshot_hist")
    _reg("snapshot_history", SNAPSHOT, f"SELECT asin, date AS snapshot_date, {', '.join(cfg.snapshot_metrics)} FROM snapshot_hist")
    _reg("snapshot_merge", SNAPSHOT, """SELECT * EXCLUDE (date) REPLACE (review_count + CASE WHEN day(date) % 7 = 0 THEN 3000
        WHEN day(date) % 3 = 0 THEN 1000 ELSE 0 END AS review_count), date AS snapshot_date FROM snapshot_hist""")
    O = [("o", """SELECT o_orderkey AS k, o_orderstatus AS status, o_orderkey // 2048 AS file FROM orders"""),
         ("e", """SELECT *, row_number() OVER (PARTITION BY file ORDER BY k) AS row, file % 3 AS kind,
              file % 3 = 0 AND k % 37 = 0 AS short, file % 7 = 2 AND k % 41 = 0 AS long,
              CASE WHEN k % 53 = 0 THEN 'line one' || chr(10) || 'line two, of ' || k WHEN k % 31 = 0 THEN 'said "yes" to ' || k
                   WHEN k % 29 = 0 THEN 'N/A' ELSE 'plain ' || k END AS note FROM o"""),
         ("f", """SELECT *, CASE WHEN note LIKE 'line%' OR note LIKE 'said%' THEN '"' || replace(note, '"', '""') || '"' ELSE note END AS raw FROM e"""),
         ("x", """SELECT *, CASE WHEN short THEN k || ',' || status WHEN kind = 0 THEN k || ',' || status || ',' || raw
              WHEN kind = 1 THEN raw || ',' || k || ',' || status ELSE k || ',' || raw END || CASE WHEN long THEN ',surplus' ELSE '' END AS line FROM f"""),
         ("whole", "SELECT * FROM x WHERE file NOT IN (SELECT file FROM x WHERE long AND NOT short)")]
    _reg("export_rows", O, """SELECT file, row, k AS order_key, CASE WHEN kind <> 2 THEN status END AS status,
        CASE WHEN short THEN CASE WHEN long THEN 'surplus' END WHEN note <> 'N/A' THEN note END AS note FROM whole""")
    _reg("export_rejects", O, """SELECT file, row, 'more fields than the header' AS reason, line AS record FROM x WHERE long AND NOT short
        UNION ALL SELECT file, row, 'fewer fields than the header (kept)', line FROM x WHERE short AND NOT long
        UNION ALL SELECT DISTINCT file, CAST(NULL AS BIGINT), 'file left out: a record has more fields than the header',
                         CAST(NULL AS VARCHAR) FROM x WHERE long AND NOT short""")
    A = alerts_ctes(cfg)
    _reg("alert_export", A, f"""SELECT * REPLACE (round(actual_value, 4) AS actual_value, round(expected_value, 4) AS expected_value,
        round(yoy_baseline, 4) AS yoy_baseline, round(z_score, 4) AS z_score, round(yoy_deviation, 4) AS yoy_deviation),
        CAST(date + {cfg.data_lag_days} AS DATE) AS run_date FROM alerts WHERE date = (SELECT max(date) FROM alerts)""")


_build()
_build_alerts()
_build_ingest()
