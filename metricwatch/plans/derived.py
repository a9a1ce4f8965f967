"""Inputs of the registered queries, derived by Spark from the driver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..config import Config, fixture_config
from ..operators.detect import detect
from ..operators.master import assign_tiers, merge_sources
from ..operators.standardize import standardize_inventory, standardize_returns, standardize_snapshot
from ..sources import fixtures as fx


def master(spark: SparkSession, sf_dir: str, cfg: Config | None = None) -> DataFrame:
    """brand_daily_dense ⟕ returns ⟕ inventory ⟕ listing snapshot, then revenue tiers:
    the detection input (J4 + A3)."""
    cfg = cfg or fixture_config()
    dense = fx.brand_daily_dense(spark, sf_dir)
    ret = standardize_returns(fx.returns_raw(spark, sf_dir))
    inv = standardize_inventory(fx.inventory_raw(spark, sf_dir))
    lst = standardize_snapshot(fx.listing_raw(spark, sf_dir))
    _, newest = fx.ship_day_bounds(spark, sf_dir)     # = max(date) of the dense calendar
    return assign_tiers(merge_sources(dense, ret, inv, lst), cfg, newest=newest)


def alerts(spark: SparkSession, sf_dir: str, cfg: Config | None = None) -> DataFrame:
    """All alerts and improvements over the whole history of the fixture master."""
    cfg = cfg or fixture_config()
    return detect(master(spark, sf_dir, cfg), cfg)
