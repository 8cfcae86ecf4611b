"""Readers for the three formats a table may come in."""

from __future__ import annotations

from pathlib import PurePosixPath

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from binoscope.spec import TableSpec


CORRUPT = "_corrupt_record"


class TableNotFound(FileNotFoundError):
    """Nothing to read at the given path."""


class TableUnreadable(ValueError):
    """The path exists but its content does not parse under the schema."""


def load(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One parquet table of a folder."""
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def _reading(path: str, frame):
    try:
        return frame()
    except AnalysisException as error:
        if "PATH_NOT_FOUND" in str(error):
            raise TableNotFound(f"No table at {path}.") from error
        raise TableUnreadable(f"Cannot read {path}: {error}") from error


def read_table(spark: SparkSession, path: str, spec: TableSpec | T.StructType) -> DataFrame:
    """A CSV table with a header under a fixed schema; a row that does not parse fails the read.

    The check is one aggregate over the file. Column order is taken from the header, so the header must name
    the same columns as the schema, in any order; all files of a folder must have the same header.
    """
    schema = spec.struct if isinstance(spec, TableSpec) else spec
    header = _reading(path, lambda: spark.read.csv(path, header=True, inferSchema=False).columns)
    if not header:
        raise TableUnreadable(f"{path} has no header row.")
    known = {f.name: f for f in schema.fields}
    ordered = T.StructType([known.get(c, T.StructField(c, T.StringType())) for c in header]
                           + [T.StructField("_corrupt_record", T.StringType())])
    rows = spark.read.schema(ordered).csv(path, header=True, mode="PERMISSIVE", enforceSchema=False,
                                          columnNameOfCorruptRecord="_corrupt_record")
    counts = rows.agg(F.count("_corrupt_record").alias("n"), F.min("_corrupt_record").alias("first"), F.count(F.lit(1)).alias("rows"),
                      *[F.count(c).alias(f"n_{i}") for i, c in enumerate(header)])
    try:
        bad = counts.first()
    except (PySparkException, Py4JJavaError) as error:
        if "CSV header" in str(error):
            raise TableUnreadable(f"The files of {path} have different headers.") from error
        raise
    if bad["n"]:
        raise TableUnreadable(f"{path}: {bad['n']} rows do not parse, such as {bad['first']!r}.")
    return rows.drop("_corrupt_record")


def read_records(spark: SparkSession, path: str, envelope: str = "records", schema: T.StructType | None = None,
                 whole_file: bool = True) -> DataFrame:
    """CSV, or JSON as one object, an array of objects, or an object that holds the record list under `envelope`.

    A JSON file is one document by default. Large inputs should hold one document per line (`whole_file=False`),
    so that files can be split between tasks. Documents with and without the envelope may stand side by side; a cell that
    only the others have is null. A document that does not parse fails the read.
    """
    if PurePosixPath(path).suffix.lower() == ".csv":
        return _reading(path, lambda: spark.read.csv(path, header=True, inferSchema=schema is None, schema=schema))
    full = None if schema is None else T.StructType([*schema.fields, T.StructField(envelope, T.ArrayType(schema)),
                                                     T.StructField(CORRUPT, T.StringType())])
    rows = _reading(path, lambda: spark.read.json(path, multiLine=whole_file, schema=full, columnNameOfCorruptRecord=CORRUPT))
    if CORRUPT in rows.columns:
        bad = rows.select(F.col(CORRUPT).alias("text"), F.struct(*rows.columns).alias("row")).where(F.col("text").isNotNull()).first()
        if bad is not None:
            raise TableUnreadable(f"{path} holds a document that is not valid JSON, such as {bad['text'][:200]!r}.")
        rows = rows.drop(CORRUPT)
    if envelope not in rows.columns:
        return rows
    listed = rows.select(F.explode(envelope).alias("record")).select("record.*")
    single = rows.where(F.col(envelope).isNull()).drop(envelope)
    return listed.unionByName(single, allowMissingColumns=True) if single.columns else listed
