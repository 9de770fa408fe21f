"""Where queries and their SQL twins are collected."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from glasswatch.session import configure

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}
_CTES: dict[str, tuple[str, tuple[str, ...]]] = {}

_MODULES = (
    "tables", "functions", "ingest", "staging", "safety", "transparency", "verdicts", "researcher", "metrics",
    "quality", "streams",
)
DIGITS = 8


def cte(name: str, body: str, *needs: str) -> None:
    """Name a piece of SQL that twins can build on."""
    _CTES[name] = (body, needs)


def with_ctes(body: str, *needs: str) -> str:
    """A statement with all pieces it needs in front, each once."""
    ordered: list[str] = []

    def visit(name: str) -> None:
        for n in _CTES[name][1]:
            visit(n)
        if name not in ordered:
            ordered.append(name)

    for n in needs:
        visit(n)
    head = ",\n".join(f"{n} AS ({_CTES[n][0]})" for n in ordered)
    return f"WITH {head}\n{body}" if head else body


def portable(df: DataFrame) -> DataFrame:
    """Dates and times as text and doubles rounded, so that two engines' results compare by value."""
    out = []
    for f in df.schema:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DateType):
            c = c.cast("string")
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        elif isinstance(f.dataType, T.DoubleType):
            c = F.round(c, DIGITS)
        elif isinstance(f.dataType, T.ArrayType):
            c = F.array_join(c.cast("array<string>"), ",")
        out.append(c.alias(f.name))
    return df.select(*out)


def portable_sql(sql: str, rounded: str = "", dates: str = "", times: str = "") -> str:
    """The same for a twin: names of double, date and time columns, separated by blanks."""
    parts = [f"round({c}, {DIGITS}) AS {c}" for c in rounded.split()]
    parts += [f"CAST({c} AS VARCHAR) AS {c}" for c in dates.split()]
    parts += [f"strftime({c}, '%Y-%m-%d %H:%M:%S.%f') AS {c}" for c in times.split()]
    return f"SELECT * REPLACE ({', '.join(parts)}) FROM (\n{sql}\n)" if parts else sql


def register(
    key: str, query: Query, sql: str | None = None, *needs: str, rounded: str = "", dates: str = "", times: str = ""
) -> None:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return portable(query(configure(spark), sf_dir))

    if key in QUERIES:
        raise ValueError(f"{key} is registered twice")
    QUERIES[key] = run
    if sql is not None:
        ORACLES[key] = portable_sql(with_ctes(sql, *needs), rounded, dates, times)


def pct_sql(a: str, b: str) -> str:
    """``round(100 a / b, 2)`` the way Spark rounds: half up on the decimal digits."""
    return (
        f"CASE WHEN {b} > 0 THEN CAST(round(CAST(100 * CAST({a} AS DOUBLE) / {b} AS DECIMAL(30, 10)), 2) AS DOUBLE) END"
    )


def round_sql(x: str, digits: int) -> str:
    return f"CAST(round(CAST({x} AS DECIMAL(30, 10)), {digits}) AS DOUBLE)"


def load_all() -> None:
    """Import the modules that register queries."""
    for name in _MODULES:
        importlib.import_module(f"glasswatch.catalog.{name}")
