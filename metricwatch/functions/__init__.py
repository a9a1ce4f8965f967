"""Column-expression helpers (all built-in Spark functions, no UDFs)."""

from .exprs import *  # noqa: F401,F403
