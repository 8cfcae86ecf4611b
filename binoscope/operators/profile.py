"""Profiles of a table and of its features against the label, one grouping per report."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from binoscope.functions.scalars import melt, same_keys
from binoscope.operators.checks import duplicate_rows
from binoscope.operators.order import exact_quantiles, local_if_small

QUARTILES = {"q25": 0.25, "q50": 0.5, "q75": 0.75}


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def value_counts(df: DataFrame, columns: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """(keep..., feature, value, n) for all columns at once; map-side combined, so frequent values are cheap."""
    return melt(df, keep, columns, "string").groupBy(*keep, "feature", "value").agg(F.count(F.lit(1)).alias("n"))


def distinct_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct non-null values and missing cells per column, from one grouping by (column, value).

    Grouping spreads a column's values over all tasks, unlike one count_distinct per column in a single row.
    """
    counts = melt(df, [], columns, "string", "column").groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    return counts.groupBy("column").agg(F.count("value").alias("n_distinct"),
                                        F.coalesce(F.sum(F.when(F.col("value").isNull(), F.col("n"))), F.lit(0)).alias("n_missing"),
                                        F.sum("n").alias("n_rows"))


def audit(df: DataFrame, approximate: bool = False) -> DataFrame:
    """Per column: type, kind, missing cells, distinct values, and whether it is constant (null counts as a value).

    `approximate` replaces the exact distinct count by a sketch, for tables where only the size class matters.
    """
    numeric = set(numeric_columns(df))
    kinds = F.create_map(*[part for f in df.schema.fields for part in (F.lit(f.name), F.lit(f.dataType.simpleString()))])
    is_numeric = F.col("column").isin(*numeric) if numeric else F.lit(False)
    if approximate:
        wide = df.agg(F.count(F.lit(1)).alias("rows"), *[F.count(c).alias(f"c_{i}") for i, c in enumerate(df.columns)],
                      *[F.approx_count_distinct(c).alias(f"d_{i}") for i, c in enumerate(df.columns)])
        counts = wide.select(F.explode(F.array(*[F.struct(
            F.lit(c).alias("column"), F.col(f"d_{i}").alias("n_distinct"), (F.col("rows") - F.col(f"c_{i}")).alias("n_missing"),
            F.col("rows").alias("n_rows")) for i, c in enumerate(df.columns)])).alias("r")).select("r.*")
    else:
        counts = distinct_counts(df, df.columns)
    levels = F.col("n_distinct") + F.when(F.col("n_missing") > 0, 1).otherwise(0)
    return counts.select("column", kinds[F.col("column")].alias("dtype"),
                         F.when(is_numeric, "numeric").otherwise("categorical").alias("kind"),
                         "n_rows", "n_missing", "n_distinct", (levels == 1).alias("constant"))


def audit_summary(df: DataFrame) -> DataFrame:
    """One row: rows, columns, duplicate rows, missing cells, constant columns."""
    totals = audit(df).agg(F.max("n_rows").alias("n_rows"), F.count(F.lit(1)).alias("n_columns"),
                           F.sum("n_missing").alias("n_missing"),
                           F.sort_array(F.collect_list(F.when(F.col("constant"), F.col("column")))).alias("constants"))
    # Both sides are single rows by construction.
    return totals.join(F.broadcast(duplicate_rows(df)), F.lit(True)).select(
        "n_rows", "n_columns", "duplicate_rows", "n_missing", F.array_join("constants", ",").alias("constant_columns"))


def describe_numeric(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """count, mean, sample SD, min, quartiles, max per column."""
    columns = list(columns or numeric_columns(df))
    long = melt(df, [], columns)
    moments = long.groupBy("feature").agg(F.count("value").alias("count"), F.avg("value").alias("mean"),
                                          F.stddev_samp("value").alias("std"), F.min("value").alias("min"),
                                          F.max("value").alias("max"))
    joined = same_keys(moments, exact_quantiles(long, ["feature"], "value", QUARTILES), ["feature"], "left")
    return joined.select("feature", "count", "mean", "std", "min", *QUARTILES, "max")


def describe_all(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Numeric summary plus unique, top and freq for text columns; the smallest value wins a tie for top."""
    columns = list(columns or df.columns)
    numeric = [c for c in columns if c in set(numeric_columns(df))]
    text = [c for c in columns if c not in numeric]
    parts = []
    if numeric:
        numbers = describe_numeric(df, numeric)
        parts.append(numbers.select("feature", "count", F.lit(None).cast("long").alias("unique"), F.lit(None).cast("string").alias("top"),
                                    F.lit(None).cast("long").alias("freq"), "mean", "std", "min", *QUARTILES, "max"))
    if text:
        counts = value_counts(df, text).where(F.col("value").isNotNull())
        # max_by keeps the first of equals, so the order key must be unique: frequency, then the value from below.
        top = counts.groupBy("feature").agg(F.sum("n").alias("count"), F.count(F.lit(1)).alias("unique"),
                                            F.max("n").alias("freq"), F.min(F.struct((-F.col("n")).alias("k"), "value")).alias("best"))
        empty = [F.lit(None).cast("double").alias(c) for c in ("mean", "std", "min", *QUARTILES, "max")]
        parts.append(top.select("feature", "count", "unique", F.col("best.value").alias("top"), "freq", *empty))
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def iqr_outliers(df: DataFrame, columns: Sequence[str] | None = None, k: float = 1.5) -> DataFrame:
    """Rows strictly outside [q1 - k*iqr, q3 + k*iqr] per column."""
    columns = list(columns or numeric_columns(df))
    long = melt(df, [], columns)
    quartiles = exact_quantiles(long, ["feature"], "value", {"q1": 0.25, "q3": 0.75})
    fenced = same_keys(long, local_if_small(quartiles), ["feature"], "left")
    iqr = F.col("q3") - F.col("q1")
    outside = (F.col("value") < F.col("q1") - k * iqr) | (F.col("value") > F.col("q3") + k * iqr)
    return fenced.groupBy("feature").agg(F.sum(F.when(outside, 1).otherwise(0)).cast("long").alias("outlier_count"))


def target_distribution(df: DataFrame, y: str = "y", by: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*by, y).agg(F.count(F.lit(1)).alias("count"))


def target_rates(df: DataFrame, features: Sequence[str], categorical: Sequence[str], y: str = "y", max_levels: int = 10) -> DataFrame:
    """Rows and label rate per value, for categoricals and for numerics with few levels; null is a value too.

    Values of all columns are counted together once; numerics with too many levels drop out afterwards.
    """
    cells = melt(df, [y], features, "string").groupBy("feature", "value").agg(
        F.count(y).alias("count"), F.avg(y).alias("rate"))
    levels = cells.groupBy("feature").agg(F.count("value").alias("levels"))
    kept = levels.where((F.col("levels") <= max_levels) | F.col("feature").isin(*categorical)).select("feature")
    # One row per feature.
    return cells.join(F.broadcast(kept), "feature", "left_semi").select("feature", "value", "count", "rate")


def numeric_by_target(df: DataFrame, columns: Sequence[str] | None = None, y: str = "y") -> DataFrame:
    columns = list(columns or [c for c in numeric_columns(df) if c != y])
    long = melt(df, [y], columns)
    keys = ["feature", y]
    means = long.groupBy(*keys).agg(F.avg("value").alias("mean"))
    return same_keys(means, exact_quantiles(long, keys, "value", {"median": 0.5}), keys, "left")


def correlation_matrix(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Pearson correlation of every pair over the rows where both are present; one aggregate, mirrored."""
    columns = list(columns or numeric_columns(df))
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i:]]

    def pair_corr(a: str, b: str):
        both = F.col(a).isNotNull() & F.col(b).isNotNull()
        left, right = F.when(both, F.col(a).cast("double")), F.when(both, F.col(b).cast("double"))
        return F.corr(left, right) if a != b else F.when(F.stddev_pop(left) > 0, F.lit(1.0))

    wide = df.agg(*[pair_corr(a, b).alias(f"r_{i}") for i, (a, b) in enumerate(pairs)])
    cells = [F.struct(F.lit(x).alias("feature"), F.lit(z).alias("other"), F.col(f"r_{i}").alias("correlation"))
             for i, (a, b) in enumerate(pairs) for x, z in {(a, b), (b, a)}]
    return wide.select(F.explode(F.array(*cells)).alias("c")).select("c.*")


def histogram_by_class(df: DataFrame, column: str, bins: int = 16, y: str = "y") -> DataFrame:
    """Equal-width bins between each class's own extremes, with the density inside the class."""
    value = F.col(column).cast("double")
    rows = df.where(value.isNotNull()).select(y, value.alias("value"))
    extent = rows.groupBy(y).agg(F.min("value").alias("low"), F.max("value").alias("high"), F.count(F.lit(1)).alias("n_class"))
    # One row per class.
    spread = same_keys(rows, F.broadcast(extent), [y])
    width = (F.col("high") - F.col("low")) / F.lit(float(bins))
    place = F.coalesce(F.least(F.floor(F.try_divide(F.col("value") - F.col("low"), width)).cast("int"), F.lit(bins - 1)), F.lit(0))
    filled = spread.groupBy(y, place.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    spine = extent.withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))))
    joined = same_keys(spine, filled, [y, "bin"], "left")
    count = F.coalesce("n", F.lit(0))
    return joined.select(y, F.col("bin").cast("long").alias("bin"), (F.col("low") + F.col("bin") * width).alias("lower"),
                         (F.col("low") + (F.col("bin") + 1) * width).alias("upper"), count.cast("long").alias("n"),
                         F.try_divide(count.cast("double"), F.col("n_class") * width).alias("density"))


def top_rows(df: DataFrame, column: str, k: int, id: str = "id") -> DataFrame:
    return df.orderBy(F.col(column).desc_nulls_last(), F.col(id)).limit(k)
