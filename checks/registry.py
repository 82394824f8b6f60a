"""Registration of queries with their output columns and the equivalent SQL.

A column list is a string such as ``SignalID, Date, ~value, n:int``: ``~`` rounds a
double, ``:type`` casts. The same list shapes the frame and wraps the SQL.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.views_sql import with_views
from phasewright.sources.views import Views

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

# Added before rounding on both sides: a mean of two six-digit numbers would otherwise
# lie on a rounding boundary, where the last bit decides.
NUDGE = "3.7e-9"
DIGITS = 6


def _columns(spec: str) -> list[tuple[str, bool, str | None]]:
    out = []
    for token in spec.split(","):
        name, _, kind = token.strip().partition(":")
        out.append((name.lstrip("~"), name.startswith("~"), kind or None))
    return out


def _shape(df: DataFrame, spec: str) -> DataFrame:
    cols = []
    for name, rounded, kind in _columns(spec):
        c = F.col(name)
        if rounded:
            c = F.round(c.cast("double") + F.lit(float(NUDGE)), DIGITS)
        elif kind:
            c = c.cast("string" if kind == "varchar" else kind)
        cols.append(c.alias(name))
    return df.select(*cols)


def _wrap(body: str, spec: str) -> str:
    cols = []
    for name, rounded, kind in _columns(spec):
        q = f'"{name}"'
        if rounded:
            cols.append(f"round(cast({q} as double) + {NUDGE}, {DIGITS}) AS {q}")
        elif kind:
            cols.append(f"cast({q} as {kind}) AS {q}")
        else:
            cols.append(q)
    return with_views(f"SELECT {', '.join(cols)} FROM ({body}) AS result")


def query(name: str, spec: str, sql: str | None = None):
    """Register ``fn(views)`` under a name, with its columns and SQL."""

    def add(fn: Callable[[Views], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = lambda spark, folder: _shape(fn(Views(spark, folder)), spec)
        if sql is not None:
            ORACLES[name] = _wrap(sql, spec)
        return fn

    return add
