"""Population stability of new rows against a stored profile of the training rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from binoscope.functions.scalars import melt, ratio, same_keys, same_keys_full, steps_reached
from binoscope.operators.order import exact_quantiles, local_if_small

# Fixed values of the index: decile cuts, share floor, status limits, rows below which it is mostly noise.
DECILES = {f"d{i}": i / 10 for i in range(1, 10)}
SHARE_FLOOR = 1e-4
MODERATE, SHIFT = 0.1, 0.25
RELIABLE_ROWS = 100


def bin_number(value: Column, cuts: Column) -> Column:
    """0 for (-inf, c0], 1 for (c0, c1], ...: the number of cuts below the value."""
    return F.size(F.filter(cuts, lambda c: c < value))


def bin_shares(df: DataFrame, column: str, cuts: Sequence[float], by: Sequence[str] = ()) -> DataFrame:
    """Share of the non-null values in each bin, empty bins kept; no rows at all give null shares."""
    value = F.col(column).cast("double")
    placed = df.select(*by, value.isNotNull().alias("present"), F.coalesce(steps_reached(value, sorted(cuts), strict=True), F.lit(0)).alias("bin"))
    counted = placed.groupBy(*by, "present", "bin").agg(F.count(F.lit(1)).alias("n"))
    packed = counted.groupBy(*by).agg(
        F.map_from_entries(F.collect_list(F.when(F.col("present"), F.struct("bin", "n")))).alias("cells"),
        F.sum(F.when(F.col("present"), F.col("n"))).alias("total"))
    spine = packed.withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(len(cuts)))))
    share = F.when(F.col("total") > 0, F.coalesce(F.try_element_at("cells", F.col("bin")), F.lit(0)) / F.col("total"))
    return spine.select(*by, F.col("bin").cast("long").alias("bin"), share.alias("share"))


def decile_cuts(df: DataFrame, numeric: Sequence[str]) -> DataFrame:
    """(feature, cuts): the distinct interpolated deciles of each numeric feature."""
    deciles = exact_quantiles(melt(df, [], numeric), ["feature"], "value", DECILES)
    return deciles.select("feature", F.array_sort(F.array_distinct(F.array(*DECILES))).alias("cuts"))


def _numeric_places(df: DataFrame, numeric: Sequence[str], cuts: DataFrame) -> DataFrame:
    """(feature, bin) per cell, bin null for missing values; cuts has one row per feature that has values, others have one bin."""
    tagged = same_keys(melt(df, [], numeric), local_if_small(cuts), ["feature"], "left")
    return tagged.select("feature", F.when(F.col("value").isNotNull(), F.coalesce(bin_number(F.col("value"), F.col("cuts")), F.lit(0)).cast("string")).alias("bin"))


def _cells(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str], cuts: DataFrame | None, empty_bins: bool) -> DataFrame:
    """(feature, kind, bin, n): one row per feature and bin or category, bin null for missing values, in one grouping.

    A column with millions of categories is millions of small rows, dealt by (feature, bin). With `empty_bins` every bin of a
    numeric feature has a row.
    """
    parts = []
    if numeric:
        parts.append(_numeric_places(df, numeric, cuts).select("feature", F.lit("numeric").alias("kind"), "bin", F.lit(1).alias("n")))
        if empty_bins:
            bins = F.explode(F.sequence(F.lit(0), F.size("cuts")).cast("array<string>")).alias("bin")
            parts.append(cuts.select("feature", F.lit("numeric").alias("kind"), bins, F.lit(0).alias("n")))
    if categorical:
        parts.append(melt(df, [], categorical, "string").select("feature", F.lit("categorical").alias("kind"), F.col("value").alias("bin"),
                                                                F.lit(1).alias("n")))
    return reduce(DataFrame.unionByName, parts).groupBy("feature", "kind", "bin").agg(F.sum("n").alias("n"))


def _with_totals(cells: DataFrame) -> DataFrame:
    """Cells with n_rows and n_present of their feature; the totals have one row per column of the table."""
    totals = cells.groupBy("feature", "kind").agg(F.sum("n").alias("n_rows"),
                                                  F.coalesce(F.sum(F.when(F.col("bin").isNotNull(), F.col("n"))), F.lit(0)).alias("n_present"))
    return same_keys(cells, F.broadcast(totals), ["feature", "kind"])


def drift_profile(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str]) -> DataFrame:
    """One row per feature and bin or category: kind, cuts (numeric only), bin, share, missing rate, row count.

    A feature without values has one row with a null bin and share. To be stored by the caller: reports read it twice.
    """
    if not numeric and not categorical:
        raise ValueError("A profile needs at least one feature.")
    empty = df.sparkSession.createDataFrame([], "feature string, cuts array<double>")
    cuts = local_if_small(decile_cuts(df, numeric)) if numeric else empty
    placed = same_keys(_with_totals(_cells(df, numeric, categorical, cuts, True)), cuts, ["feature"], "left")
    known = F.col("bin").isNotNull()
    return placed.where(known | (F.col("n_present") == 0)).select(
        "feature", "kind", "cuts", "bin", F.when(known, ratio("n", "n_present")).alias("share"),
        (1 - F.col("n_present") / F.col("n_rows")).alias("missing_rate"), "n_rows")


def psi_term(expected: Column, actual: Column) -> Column:
    e, a = F.greatest(expected, F.lit(SHARE_FLOOR)), F.greatest(actual, F.lit(SHARE_FLOOR))
    return (a - e) * F.ln(a / e)


def psi(shares: DataFrame, by: Sequence[str] = (), expected: str = "expected", actual: str = "actual") -> DataFrame:
    """Population stability index of two share columns, summed over the bins of a group."""
    return shares.groupBy(*by).agg(F.sum(psi_term(F.col(expected), F.col(actual))).alias("psi"))


def drift_status(value: Column) -> Column:
    return F.when(value.isNull(), "no data").when(value >= SHIFT, "shift").when(value >= MODERATE, "moderate").otherwise("stable")


def drift_report(df: DataFrame, profile: DataFrame) -> DataFrame:
    """One row per feature of the profile; values the profile never saw form one more bin of a categorical.

    Both sides are counted cells and meet by (feature, bin), so neither a hot feature nor one with very many categories lands in
    one task. Only the names, kinds and cuts of the features are fetched and broadcast: one row per column.
    """
    features = local_if_small(profile.groupBy("feature", "kind").agg(F.first("cuts", True).alias("cuts"),
                                                                     F.max("missing_rate").alias("reference_missing_rate"),
                                                                     F.count("bin").alias("n_bins")))
    kinds = {row["feature"]: row["kind"] for row in features.select("feature", "kind").collect()}
    numeric = [f for f, kind in kinds.items() if kind == "numeric"]
    categorical = [f for f, kind in kinds.items() if kind == "categorical"]
    cells = _cells(df, numeric, categorical, features.where(F.col("cuts").isNotNull()).select("feature", "cuts"), False)
    totals = cells.groupBy("feature").agg(F.sum("n").alias("n_now"),
                                          F.coalesce(F.sum(F.when(F.col("bin").isNotNull(), F.col("n"))), F.lit(0)).alias("present_now"))
    known = profile.where(F.col("bin").isNotNull()).select("feature", "bin", F.col("share").alias("expected"))
    met = same_keys_full(known, cells.where(F.col("bin").isNotNull()).select("feature", "bin", "n"), ["feature", "bin"])
    actual = ratio(F.coalesce("n", F.lit(0)), "present_now")
    terms = same_keys(met, F.broadcast(totals), ["feature"]).groupBy("feature").agg(
        F.sum(F.when(F.col("expected").isNotNull(), psi_term(F.col("expected"), actual))).alias("known"),
        F.coalesce(F.sum(F.when(F.col("expected").isNull(), F.col("n"))), F.lit(0)).alias("unseen_now"))
    joined = same_keys(same_keys(features, totals, ["feature"], "left"), terms, ["feature"], "left")
    named, some = F.col("kind") == "categorical", F.col("present_now") > 0
    unseen = F.when(named, ratio(F.coalesce("unseen_now", F.lit(0)), "present_now"))
    # A category column that was empty is known to be empty: later values are all unseen.
    value = F.when(some & (named | (F.col("n_bins") > 0)),
                   F.coalesce("known", F.lit(0.0)) + F.when(named, psi_term(F.lit(0.0), unseen)).otherwise(0.0))
    rows = joined.select("feature", "kind", value.alias("psi"), drift_status(value).alias("status"), "reference_missing_rate",
                         (1 - ratio(F.coalesce("present_now", F.lit(0)), "n_now")).alias("current_missing_rate"),
                         unseen.alias("unseen_share"))
    return rows.orderBy(F.col("psi").desc_nulls_last(), "feature")


def drift_gate(report: DataFrame, n_rows: int | None = None) -> DataFrame:
    """Features by status, whether any shifted, and whether the sample is too small to trust."""
    counts = report.agg(*[F.count(F.when(F.col("status") == s, 1)).alias(s.replace(" ", "_"))
                          for s in ("shift", "moderate", "stable", "no data")])
    small = F.lit(None).cast("boolean") if n_rows is None else F.lit(n_rows < RELIABLE_ROWS)
    return counts.select("*", (F.col("shift") > 0).alias("gate_failed"), small.alias("small_sample"))

