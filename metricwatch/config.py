"""Detection parameters as frozen dataclasses.

Every value is a plain Python scalar that ends up as a literal in the Spark
plan (constant folding does the rest).  ``DEFAULT`` carries the reference
parameter set; ``fixture_config()`` is the variant used on the driver's
TPC-H-derived tables (see FIXTURES.md §3).
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace
from types import MappingProxyType
from typing import Mapping, Optional, Tuple

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference for identical results.
# ---------------------------------------------------------------------------

# Metrics of the daily time-series feed, in processing order.
DETECTION_METRICS = ("conversion_rate", "return_rate", "acos", "tacos", "sales", "margin")

# Metrics of the listing snapshot history.
SNAPSHOT_METRICS = ("keyword_avg_rank", "review_rating", "review_count", "organic_top10_count")

# Severity labels, least to most severe (rank = position + 1).
SEVERITY_LEVELS = ("watch", "warning", "critical")

# Revenue tiers, best first; anything unknown sorts after them.
TIER_ORDER = ("homerun", "triple", "double", "single", "less_than_single")

# z-score cut-offs (watch, warning, critical) per metric.
Z_THRESHOLDS = {
    "conversion_rate": (1.5, 2.5, 3.5),
    "return_rate": (1.5, 2.0, 3.0),
    "acos": (1.5, 2.5, 3.5),
    "tacos": (1.5, 2.5, 3.5),
    "sales": (1.5, 2.0, 3.0),
    "margin": (2.0, 3.0, 4.5),
    "keyword_avg_rank": (1.5, 2.0, 3.0),
    "review_rating": (1.5, 2.0, 3.0),
    "review_count": (1.5, 2.0, 3.0),
    "organic_top10_count": (1.5, 2.0, 3.0),
}

# Year-over-year relative deviation cut-offs (watch, warning, critical).
YOY_THRESHOLDS = {
    "conversion_rate": (0.15, 0.25, 0.40),
    "return_rate": (0.20, 0.50, 1.00),
    "acos": (0.20, 0.30, 0.50),
    "tacos": (0.20, 0.30, 0.50),
    "sales": (0.15, 0.25, 0.40),
    "margin": (0.20, 0.35, 0.55),
}

# Which way is bad: "up", "down" or "both".
DIRECTION = {
    "conversion_rate": "down",
    "return_rate": "up",
    "acos": "up",
    "tacos": "up",
    "sales": "down",
    "margin": "down",
    "keyword_avg_rank": "up",
    "review_rating": "both",
    "review_count": "both",
    "organic_top10_count": "down",
}

# Revenue cut-offs per tier (trailing 12 months), best first.
TIER_THRESHOLDS = (("homerun", 2_500_000.0), ("triple", 1_500_000.0),
                   ("double", 750_000.0), ("single", 250_000.0))

# Per-severity caps on one day's digest.
ALERT_CAPS = {"critical": 15, "warning": 10, "watch": 5, "improvement": 10}


# Decimal places kept for baseline statistics of large-magnitude metrics
# (money, ranks, counts); rates keep ``stat_digits_default``.
STAT_DIGITS = {"sales": 7, "margin": 9, "keyword_avg_rank": 9, "review_rating": 10, "review_count": 9,
               "organic_top10_count": 9}


def _ro(d: Mapping) -> Mapping:
    return MappingProxyType(dict(d))


@dataclass(frozen=True)
class Config:
    # rolling baseline (rows, not days)
    rolling_window: int = 14
    rolling_min_periods: int = 7
    exclude_current: bool = False          # reference includes the current row
    # year-over-year baseline
    yoy_window: int = 7
    min_history_days: int = 365
    # thresholds
    z_thresholds: Mapping[str, Tuple[float, float, float]] = field(default_factory=lambda: _ro(Z_THRESHOLDS))
    yoy_thresholds: Mapping[str, Tuple[float, float, float]] = field(default_factory=lambda: _ro(YOY_THRESHOLDS))
    direction: Mapping[str, str] = field(default_factory=lambda: _ro(DIRECTION))
    # YoY suppressors
    yoy_min_absolute: Mapping[str, float] = field(default_factory=lambda: _ro({"sales": 50.0}))
    yoy_min_baseline: Mapping[str, float] = field(default_factory=lambda: _ro({"acos": 0.05, "tacos": 0.05}))
    yoy_min_abs_diff: Mapping[str, float] = field(default_factory=lambda: _ro({"return_rate": 0.01}))
    acos_min_daily_sales: Optional[float] = 100.0
    zero_sales_min_yoy_baseline: float = 50.0
    # absolute business floors
    return_rate_warning: Optional[float] = 0.035
    return_rate_critical: Optional[float] = 0.05
    conversion_drop_warning: Optional[float] = None
    conversion_drop_critical: Optional[float] = None
    conversion_drop_min_mean: float = 1.0
    margin_critical_floor: Optional[float] = 0.0
    margin_hero_warning_floor: Optional[float] = 0.10
    zero_units_consecutive_days: int = 2
    acos_spike_warning: Optional[float] = 0.30
    acos_spike_critical: Optional[float] = 0.50
    acos_gate: bool = True
    acos_sales_tolerance: float = 0.05
    # tiers
    tier_thresholds: Tuple[Tuple[str, float], ...] = TIER_THRESHOLDS
    hero_revenue: float = 500_000.0
    trailing_months: int = 12
    # snapshot series
    snapshot_min_dates: int = 7
    snapshot_metrics: Tuple[str, ...] = SNAPSHOT_METRICS
    review_rating_warning: Optional[float] = 3.5
    review_rating_critical: Optional[float] = None
    # feeds
    distinct_return_rows: bool = False     # opt-in: drop repeated rows of cumulative return exports
    # digest
    suppress_less_than_single: bool = True
    suppress_watch_for_less_than_single: bool = False
    suppress_watch: bool = False
    caps: Mapping[str, int] = field(default_factory=lambda: _ro(ALERT_CAPS))
    top_n: int = 10
    subject_prefix: str = "[Metric Alerts]"
    data_lag_days: int = 2
    # backtest
    lookback_days: int = 180
    # numerics: window/YoY means and deviations are rounded on a fixed grid
    # (decimal places per metric, sized to the metric's magnitude) before any
    # threshold test, so engines that sum in a different order agree bit for
    # bit on every downstream value; z and deviation are then rounded too
    stat_digits: Mapping[str, int] = field(default_factory=lambda: _ro(STAT_DIGITS))
    stat_digits_default: int = 12
    score_digits: int = 9

    def digits(self, metric: str) -> int:
        return self.stat_digits.get(metric, self.stat_digits_default)

    def std_digits(self, metric: str) -> int:
        """Standard deviations carry two places less (their rounding noise is larger)."""
        return self.digits(metric) - 2

    def with_(self, **kw) -> "Config":
        return replace(self, **kw)


DEFAULT = Config()


def conversion_drop_config() -> Config:
    """The fixture parameters with the conversion-drop floor (D12, off by default) on, over rates as fractions."""
    return fixture_config().with_(conversion_drop_warning=0.30, conversion_drop_critical=0.50,
                                  conversion_drop_min_mean=0.001)


def fixture_config() -> Config:
    """Parameters for the TPC-H-derived fixtures (FIXTURES.md §3)."""
    return DEFAULT.with_(
        tier_thresholds=(("homerun", 20e6), ("triple", 18e6), ("double", 16e6), ("single", 14e6)),
        hero_revenue=17e6,
        return_rate_warning=0.50,
        return_rate_critical=0.90,
        acos_min_daily_sales=16_000.0,
        yoy_min_absolute=_ro({"sales": 16_000.0}),
        zero_sales_min_yoy_baseline=40_000.0,
    )
