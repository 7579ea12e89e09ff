"""Where the queries over the benchmark tables register themselves."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def keep(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return keep


# --- SQL text helpers ---------------------------------------------------------
def r(expr: str, digits: int) -> str:
    """Round half away from zero in double arithmetic."""
    factor = 10**digits
    return f"(round(({expr}) * {factor}.0::double) / {factor}.0::double)"


def xsum(expr: str, digits: int = 10) -> str:
    """Sum of doubles taken to ``digits`` digits; read from its decimal digits, so rounded once."""
    whole = f"sum(cast(round(({expr}) * {10**digits}.0::double) as hugeint))"
    return f"cast(cast({whole} as varchar) || 'e-{digits}' as double)"


def xavg(expr: str, digits: int = 10) -> str:
    return f"({xsum(expr, digits)} / nullif(count({expr}), 0))"
