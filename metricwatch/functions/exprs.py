"""Reusable Column expressions.

Everything here returns a ``pyspark.sql.Column`` built from
``pyspark.sql.functions`` so it stays inside whole-stage codegen.
"""

from __future__ import annotations

from typing import Iterable, Optional, Tuple

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import SEVERITY_LEVELS, TIER_ORDER

__all__ = [
    "nan_to_null", "safe_div", "round_score", "bad_score", "severity_rank", "rank_label",
    "label_rank", "escalate", "tier_rank", "key_normalize", "try_double", "file_date",
    "mdy_date", "iso_day", "map_lookup",
]


def nan_to_null(c) -> Column:
    """NaN behaves as a missing value (Spark sorts NaN above every number)."""
    c = F.col(c) if isinstance(c, str) else c
    return F.when(~F.isnan(c), c)


def safe_div(num: Column, den: Column) -> Column:
    """num / den, NULL when den is 0 or NULL (ANSI-safe)."""
    return F.try_divide(num, F.nullif(den, F.lit(0.0)))


def round_score(c: Column, digits: Optional[int]) -> Column:
    return c if digits is None else F.round(c, digits)


def bad_score(score: Column, direction: str) -> Column:
    if direction == "both":
        return F.abs(score)
    return score if direction == "up" else -score


def severity_rank(bad: Column, cuts: Tuple[float, float, float]) -> Column:
    """1/2/3 for watch/warning/critical with ``>=`` cuts; NULL below watch or for NULL input."""
    watch, warning, critical = cuts
    return (F.when(bad >= F.lit(critical), F.lit(3))
            .when(bad >= F.lit(warning), F.lit(2))
            .when(bad >= F.lit(watch), F.lit(1)))


def rank_label(rank: Column) -> Column:
    """1/2/3 -> watch/warning/critical, NULL stays NULL."""
    return F.when(rank.isNotNull(), F.element_at(F.array(*[F.lit(s) for s in SEVERITY_LEVELS]), rank))


def label_rank(label: Column) -> Column:
    """watch/warning/critical -> 1/2/3; anything else (incl. the text 'None') -> NULL."""
    return (F.when(label == "watch", 1).when(label == "warning", 2).when(label == "critical", 3))


def escalate(rank: Column, mask: Column, level: int) -> Column:
    """Raise ``rank`` to at least ``level`` where ``mask`` holds; never lowers."""
    return F.when(F.coalesce(mask, F.lit(False)), F.greatest(F.coalesce(rank, F.lit(0)), F.lit(level))).otherwise(rank)


def tier_rank(tier: Column) -> Column:
    """Position of the tier in TIER_ORDER; unknown or NULL -> len(TIER_ORDER)."""
    out = F.lit(len(TIER_ORDER))
    for i, t in reversed(list(enumerate(TIER_ORDER))):
        out = F.when(tier == t, F.lit(i)).otherwise(out)
    return out


def key_normalize(c: Column) -> Column:
    """strip() + upper(): leading/trailing Unicode white space (non-breaking too), then upper case."""
    return F.upper(F.regexp_replace(c.cast("string"), r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$", ""))


def try_double(c: Column) -> Column:
    """Tolerant numeric coercion: text that is not a number -> NULL, NaN -> NULL."""
    return nan_to_null(c.try_cast("double"))


def file_date(name: Column) -> Column:
    """Date in a file name: first yyyy-MM-dd, else first 'Mon d, yyyy' (short month only)."""
    iso = F.regexp_extract(name, r"(\d{4}-\d{2}-\d{2})", 1)
    mon = F.regexp_extract(name, r"([A-Z][a-z]+ \d{1,2}, \d{4})", 1)
    return F.coalesce(
        F.try_to_date(F.nullif(iso, F.lit("")), "yyyy-MM-dd"),
        F.try_to_date(F.nullif(mon, F.lit("")), "MMM d, yyyy"),
    )


def mdy_date(c: Column) -> Column:
    """MM-dd-yyyy text (month and day may lack the leading zero) -> date, anything else -> NULL."""
    return F.try_to_date(c.cast("string"), "M-d-yyyy")


def iso_day(c: Column) -> Column:
    """Wall-clock day of an ISO timestamp text, independent of the session time zone."""
    return F.try_to_date(F.substring(c.cast("string"), 1, 10), "yyyy-MM-dd")


def map_lookup(c: Column, mapping: Iterable[Tuple[str, str]], passthrough: bool = True) -> Column:
    """Label lookup through a literal map; unknown keys pass through unchanged."""
    pairs = []
    for k, v in mapping:
        pairs += [F.lit(k), F.lit(v)]
    looked = F.try_element_at(F.create_map(*pairs), c)
    return F.coalesce(looked, c) if passthrough else looked
