"""Feature preparation: statistics come from training rows only and are applied as plain expressions.

`fit_statistics` returns a small table (one row per fold and feature). `apply_statistics` joins it by broadcast,
or, for one fitted set, `literals` turns it into constants so that scoring needs no join at all.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from binoscope.functions.scalars import band_of, mean_of, melt, ratio, same_keys
from binoscope.operators.order import exact_quantiles, local_if_small, split_points

EMPTY_FILL = 0.0
EMPTY_LEVEL = "missing_value"


def fit_median(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """(by..., feature, median): interpolating median; a column without values gets a constant."""
    long = melt(df, by, columns)
    groups = long.groupBy(*by, "feature").agg(F.count("value").alias("n_present"))
    medians = same_keys(groups, exact_quantiles(long, [*by, "feature"], "value", {"median": 0.5}), [*by, "feature"], "left")
    return medians.select(*by, "feature", F.coalesce("median", F.lit(EMPTY_FILL)).alias("median"))


def fit_mode(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """(by..., feature, mode): most frequent value, the smallest on a tie; a column without values gets a constant."""
    cells = melt(df, by, columns, "string").groupBy(*by, "feature", "value").agg(F.count(F.lit(1)).alias("n"))
    return cells.groupBy(*by, "feature").agg(_most_frequent().alias("mode"))


def _most_frequent() -> Column:
    """Aggregate over (value, n) cells: the most frequent value, the smallest on a tie."""
    best = F.min(F.when(F.col("value").isNotNull(), F.struct((-F.col("n")).alias("k"), "value")))
    return F.coalesce(best["value"], F.lit(EMPTY_LEVEL))


def modes_and_levels(cells: DataFrame, by: Sequence[str]) -> DataFrame:
    """(by..., feature, mode, levels) from value counts; a categorical has a closed, short list of levels."""
    return cells.groupBy(*by, "feature").agg(_most_frequent().alias("mode"), F.array_sort(F.collect_list("value")).alias("levels"))


def fit_scale(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """(by..., feature, mean, scale): population SD, with 1 in place of zero."""
    moments = melt(df, by, columns).groupBy(*by, "feature").agg(F.avg("value").alias("mean"), F.stddev_pop("value").alias("sd"))
    return moments.select(*by, "feature", "mean", F.when(F.col("sd") > 0, F.col("sd")).otherwise(1.0).alias("scale"))


def fit_levels(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """(by..., feature, levels): the sorted distinct values of every categorical."""
    cells = melt(df, by, columns, "string").where(F.col("value").isNotNull()).groupBy(*by, "feature", "value").count()
    return cells.groupBy(*by, "feature").agg(F.array_sort(F.collect_list("value")).alias("levels"))


def apply_fill(df: DataFrame, fills: Mapping[str, object]) -> DataFrame:
    return df.select(*[F.coalesce(F.col(c), F.lit(fills[c])).alias(c) if c in fills else F.col(c) for c in df.columns])


def apply_scale(df: DataFrame, scales: Mapping[str, tuple[float, float]]) -> DataFrame:
    return df.select(*[((F.col(c).cast("double") - F.lit(scales[c][0])) / F.lit(scales[c][1])).alias(c) if c in scales else F.col(c)
                       for c in df.columns])


def one_hot(df: DataFrame, levels: Mapping[str, Sequence[str]]) -> DataFrame:
    """Replace each categorical by one 0/1 column per level, named column_level; unseen and null give all zeros."""
    kept = [F.col(c) for c in df.columns if c not in levels]
    coded = [F.coalesce((F.col(c) == F.lit(v)).cast("double"), F.lit(0.0)).alias(f"{c}_{v}") for c, vs in levels.items() for v in vs]
    return df.select(*kept, *coded)


def literals(table: DataFrame, *values: str) -> dict[str, tuple]:
    """A fitted table as {feature: values}; it has one row per feature."""
    return {row["feature"]: tuple(row[v] for v in values) for row in table.collect()}


def fit_statistics(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str], folds: int, fold: str = "fold"
                   ) -> dict[str, DataFrame]:
    """Every statistic once per fold, learned from the rows outside that fold, without repeating the rows.

    Rows are first collapsed per fold - to moments for mean and SD, to (feature, value) counts for median, mode
    and levels - and only those small tables are repeated for the folds they train. Medians are filled in before
    the moments, as in the pipeline, by treating the missing cells as one more group of equal values.
    """
    train_for = F.explode(F.sequence(F.lit(0), F.lit(folds - 1)).cast("array<bigint>"))

    def outside(table: DataFrame) -> DataFrame:
        return table.withColumn("train_fold", train_for).where(F.col("train_fold") != F.col(fold))

    fitted = {}
    if numeric:
        long = melt(df, [fold], numeric)
        cuts, keys, half = split_points(long, "value"), ["train_fold", "feature"], {"median": 0.5}
        if cuts:
            # Ranges are counted on the map side, so the repeated rows never travel.
            medians = exact_quantiles(outside(long), keys, "value", half, cuts=cuts)
        else:
            cells = long.groupBy(fold, "feature", "value").agg(F.count(F.lit(1)).alias("n"))
            medians = exact_quantiles(outside(cells), keys, "value", half, "n", cuts)
        moments = long.groupBy(fold, "feature").agg(F.count(F.lit(1)).alias("n_rows"), F.count("value").alias("n"),
                                                    F.avg("value").alias("mean"), F.var_pop("value").alias("var"))
        # Both tables have one row per fold and feature.
        parts = same_keys(outside(local_if_small(moments)), local_if_small(medians), keys, "left")
        # Moments around the fill: missing cells add nothing there, and it lies within one deviation of the mean.
        fill, total = F.coalesce("median", F.lit(EMPTY_FILL)), F.sum("n_rows")
        off = F.coalesce("mean", fill) - fill
        around = parts.groupBy(*keys).agg(F.max(fill).alias("median"), (F.sum(F.col("n") * off) / total).alias("first"),
                                          (F.sum(F.col("n") * (F.coalesce("var", F.lit(0.0)) + off * off)) / total).alias("second"))
        spread = F.sqrt(F.greatest(F.col("second") - F.col("first") * F.col("first"), F.lit(0.0)))
        fitted["numeric"] = around.select(F.col("train_fold").alias(fold), "feature", "median", (F.col("median") + F.col("first")).alias("mean"),
                                          F.when(spread > 0, spread).otherwise(1.0).alias("scale"))
    if categorical:
        cells = melt(df, [fold], categorical, "string").groupBy(fold, "feature", "value").agg(F.count(F.lit(1)).alias("n"))
        training = outside(cells).groupBy("train_fold", "feature", "value").agg(F.sum("n").alias("n"))
        fitted["categorical"] = modes_and_levels(training, ["train_fold"]).withColumnRenamed("train_fold", fold)
    return fitted


def apply_fold_scaling(df: DataFrame, statistics: DataFrame, numeric: Sequence[str], keep: Sequence[str], fold: str = "fold") -> DataFrame:
    """Long (keep..., fold, feature, value): each row filled and scaled by the statistics of its own held-out fold."""
    long = melt(df, [*keep, fold], numeric)
    tagged = same_keys(long, local_if_small(statistics), [fold, "feature"])
    value = (F.coalesce("value", "median") - F.col("mean")) / F.col("scale")
    return tagged.select(*keep, fold, "feature", value.alias("value"))


def ratio_features(df: DataFrame, formulas: Mapping[str, tuple[str, str, float]]) -> DataFrame:
    """Add name = a / (b + shift) for every (a, b, shift); text that is no number, null, or a zero denominator give null."""
    def number(column: str) -> Column:
        return F.col(column).cast("string").try_cast("double")
    return df.withColumns({name: ratio(number(a), number(b) + F.lit(float(shift))) for name, (a, b, shift) in formulas.items()})


def row_mean(df: DataFrame, columns: Sequence[str], name: str) -> DataFrame:
    return df.withColumn(name, mean_of(columns))


def band(df: DataFrame, column: str, edges: Sequence[float], labels: Sequence[str], name: str) -> DataFrame:
    return df.withColumn(name, band_of(column, edges, labels))
