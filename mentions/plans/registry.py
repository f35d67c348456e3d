"""Registry of named queries and their SQL oracles.

A registered query is a function ``(spark, sf_dir) -> DataFrame`` that reads
the driver's tables under ``sf_dir`` (through :mod:`mentions.sources.views`)
and applies one library operator to the whole tables. Its oracle is an SQL
text DuckDB can run over the same parquet files; it must produce the same
column names and values. Doubles are rounded to 9 decimals on both sides
because sums of floats depend on the engine's summation order.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

QueryFn = Callable[[SparkSession, str], DataFrame]


@dataclass
class Registered:
    name: str
    fn: QueryFn
    oracle: str | None
    ids: tuple[str, ...]


REGISTRY: dict[str, Registered] = {}

DIGITS = 9


def register(name: str, oracle: str | None = None, ids: tuple[str, ...] = ()):
    def wrap(fn: QueryFn) -> QueryFn:
        if name in REGISTRY:
            raise KeyError(f"query {name!r} registered twice")
        REGISTRY[name] = Registered(name, fn, oracle, ids)
        return fn
    return wrap


def rounded(df: DataFrame, digits: int = DIGITS) -> DataFrame:
    """Round every double column (the comparison contract with the oracle)."""
    return df.select([
        F.round(F.col(f.name), digits).alias(f.name) if isinstance(f.dataType, T.DoubleType) else F.col(f.name)
        for f in df.schema.fields
    ])


def r(expr: str, digits: int = DIGITS) -> str:
    """SQL side of :func:`rounded`."""
    return f"ROUND(CAST({expr} AS DOUBLE), {digits})"
