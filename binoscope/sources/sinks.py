"""Writers of report tables and records."""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed pattern: what may name a run.
RUN_ID = r"[A-Za-z0-9][A-Za-z0-9._-]{0,63}"


class NonFiniteValue(ValueError):
    """A table that must hold strict JSON numbers has NaN or an infinity in it."""


def check_run_id(run_id: str) -> str:
    if re.fullmatch(RUN_ID, run_id) is None or run_id.endswith("."):
        raise ValueError(f"{run_id!r} cannot name a run: it must match {RUN_ID} and not end in a dot.")
    return run_id


def write_report(df: DataFrame, root: str, run_id: str, name: str, file_format: str = "parquet") -> str:
    """Write one result table of one run under root/name/run_id=...; a run's table is never overwritten."""
    check_run_id(run_id)
    path = f"{root.rstrip('/')}/{name}"
    target = f"{path}/run_id={run_id}"
    writer = df.write.mode("error").format(file_format)
    (writer.option("header", True) if file_format == "csv" else writer).save(target)
    return path


def read_report(spark: SparkSession, root: str, name: str, run_id: str | None = None) -> DataFrame:
    """A result table over all runs, or one run by partition pruning."""
    table = spark.read.option("recursiveFileLookup", False).parquet(f"{root.rstrip('/')}/{name}")
    return table if run_id is None else table.where(F.col("run_id") == run_id)


def non_finite(column: Column, kind: T.DataType) -> Column | None:
    """Whether a cell, at any depth, holds NaN or an infinity; None for types that cannot."""
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return F.coalesce(F.isnan(column) | (F.abs(column) == F.lit(float("inf"))), F.lit(False))
    if isinstance(kind, T.StructType):
        parts = [p for p in (non_finite(column[f.name], f.dataType) for f in kind.fields) if p is not None]
        return reduce(lambda a, b: a | b, parts) if parts else None
    if isinstance(kind, T.ArrayType):
        if non_finite(F.lit(None).cast(kind.elementType), kind.elementType) is None:
            return None
        return F.coalesce(F.exists(column, lambda x: non_finite(x, kind.elementType)), F.lit(False))
    if isinstance(kind, T.MapType):
        return non_finite(F.map_values(column), T.ArrayType(kind.valueType))
    return None


def check_finite(df: DataFrame) -> None:
    conditions = [c for c in (non_finite(F.col(f.name), f.dataType) for f in df.schema.fields) if c is not None]
    if conditions and not df.where(reduce(lambda a, b: a | b, conditions)).isEmpty():
        raise NonFiniteValue("The table holds NaN or infinite numbers; nothing was written.")


def write_json_strict(df: DataFrame, path: str) -> None:
    """JSON lines; refused before anything is written when a number is NaN or infinite."""
    check_finite(df)
    df.write.mode("error").option("ignoreNullFields", False).json(path)


def _sorted_keys(column: Column, kind: T.DataType) -> Column:
    """The same value with struct fields and map entries in name order."""
    if isinstance(kind, T.StructType):
        fields = sorted(kind.fields, key=lambda f: f.name)
        made = F.struct(*[_sorted_keys(column[f.name], f.dataType).alias(f.name) for f in fields])
        return F.when(column.isNotNull(), made)
    if isinstance(kind, T.ArrayType):
        return F.transform(column, lambda x: _sorted_keys(x, kind.elementType))
    if isinstance(kind, T.MapType):
        entries = F.array_sort(F.map_entries(column)) if isinstance(kind.valueType, T.AtomicType) else F.transform(
            F.array_sort(F.map_keys(column)), lambda k: F.struct(k.alias("key"), F.try_element_at(column, k).alias("value")))
        return F.map_from_entries(F.transform(entries, lambda e: F.struct(
            e["key"].alias("key"), _sorted_keys(e["value"], kind.valueType).alias("value"))))
    return column


def flatten_nested(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The given columns in the given order; struct, map and array cells become JSON text with sorted keys."""
    def cell(name: str) -> Column:
        kind = df.schema[name].dataType
        if isinstance(kind, (T.StructType, T.MapType, T.ArrayType)):
            return F.to_json(_sorted_keys(F.col(name), kind), {"ignoreNullFields": "false"}).alias(name)
        return F.col(name)
    return df.select(*[cell(c) for c in columns])
