"""Registered queries: each a function of (spark, folder), most with the SQL text that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

QUERIES: dict[str, Callable] = {}
SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def keep(function: Callable) -> Callable:
        if name in QUERIES:
            raise ValueError(f"Query {name} is registered twice.")
        QUERIES[name] = function
        if sql is not None:
            SQL[name] = sql
        return function
    return keep


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles rounded, whole numbers as bigint: the form in which two engines can agree exactly."""
    def cell(f: T.StructField):
        name = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            return (F.round(name.cast("double"), digits) + F.lit(0.0)).alias(f.name)
        if isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType)) or (
                isinstance(f.dataType, T.DecimalType) and f.dataType.scale == 0):
            return name.cast("long").alias(f.name)
        return name
    return df.select(*[cell(f) for f in df.schema.fields])
