"""Registry of the runnable queries and their reference SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query; ``sql`` computes the same result independently."""

    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def load_all() -> None:
    """Import every module that registers queries."""
    from shopsight.plans import (  # noqa: F401
        q_clean,
        q_features,
        q_kpi,
        q_lifecycle,
        q_models,
        q_profile,
        q_recommend,
        q_rfm,
        q_sources,
    )


# The two engines may disagree by one float step on values that lie exactly
# between two decimals, so both sides are nudged off that point before rounding.
def _nudge(digits: int) -> float:
    return 0.37 * 10.0 ** -(digits + 3)


def rnd(value: str | Column, digits: int = 4, name: str | None = None) -> Column:
    """Rounded column for a query result."""
    column = F.col(value) if isinstance(value, str) else value
    out = F.round(column.cast("double") + F.lit(_nudge(digits)), digits)
    return out.alias(name or value) if name or isinstance(value, str) else out


def sql_rnd(expr: str, digits: int = 4) -> str:
    """The same rounding as SQL text."""
    return f"round(CAST({expr} AS DOUBLE) + {_nudge(digits):.12f}::DOUBLE, {digits})"
