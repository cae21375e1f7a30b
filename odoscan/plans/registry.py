"""Named queries, each with the SQL that must give the same rows where SQL can."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every double for comparison; adding zero turns -0.0 into 0.0."""
    doubles = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({c: F.round(F.col(f"`{c}`"), digits) + F.lit(0.0) for c in doubles}) if doubles else df


def r(expression: str, name: str, digits: int = 6) -> str:
    """The SQL counterpart of ``rounded``."""
    return f'round(CAST({expression} AS DOUBLE), {digits}) + 0.0 AS "{name}"'
