"""The registry of named queries and of the SQL that says the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_QUERIES: dict[str, Callable] = {}
_SQL: dict[str, str] = {}


def sql(text: str | None):
    def keep(f):
        _QUERIES[f.__name__] = f
        if text:
            _SQL[f.__name__] = text
        return f

    return keep


def register(name: str, query: Callable, text: str | None = None) -> None:
    """Adds a query of the user's own; a name that is taken is an error."""
    if name in _QUERIES:
        raise ValueError(f"there is a query {name!r} already")
    _QUERIES[name] = query
    if text:
        _SQL[name] = text


def queries() -> dict[str, Callable]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


def table(spark, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def rounded(df: DataFrame, places: int = 4) -> DataFrame:
    """Doubles rounded, integers as longs, so that results compare with SQL's."""
    out = []
    for c, k in df.dtypes:
        out.append(F.round(c, places).alias(c) if k == "double" else F.col(c).cast("long").alias(c) if k in ("int", "bigint", "smallint") else F.col(c))
    return df.select(*out)
