"""metricwatch: dual-baseline metric anomaly detection on Spark DataFrames."""

from .config import DEFAULT, Config, fixture_config  # noqa: F401

__all__ = ["Config", "DEFAULT", "fixture_config"]
