"""Reproducible splits and samples in the order of a seeded id hash.

A row's place is decided by comparing its hash with a few cutoffs per class, so assigning a split or a fold
never shuffles the rows; only hash-bucket counts move. The same rows come out under any partitioning.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from binoscope.functions.hashing import hash_hex
from binoscope.operators.order import hash_cutoffs, passed_cuts

DEFAULT_SEED, HOLDOUT_SHARE, FOLDS = 42, 0.2, 5


def stratified_split(df: DataFrame, id: str = "id", y: str = "y", share: float = HOLDOUT_SHARE,
                     seed: int = DEFAULT_SEED) -> DataFrame:
    """Add `partition`: of each class, the first round(share * n) rows in hash order are 'test'."""
    if not 0 < share < 1:
        raise ValueError("The holdout share must lie between 0 and 1.")
    key = hash_hex(seed, "split", F.col(id))
    cutoffs = hash_cutoffs(df, [y], key, lambda total: [F.floor(F.lit(share) * total + 0.5)], df.count())
    return passed_cuts(df, [y], key, cutoffs).withColumn(
        "partition", F.when(F.col("passed") == 0, "test").otherwise("train")).drop("passed")


def split_manifest(split: DataFrame, id: str = "id") -> DataFrame:
    return split.select(id, "partition")


def _fold_ranks(k: int):
    def ranks(total: Column) -> list[Column]:
        return [F.ceil(total * f / F.lit(k)) for f in range(1, k)]
    return ranks


def stratified_folds(df: DataFrame, id: str = "id", y: str = "y", k: int = FOLDS, seed: int | Column = DEFAULT_SEED,
                     within: Sequence[str] = (), name: str = "fold", rows: int | None = None, purpose: str = "folds") -> DataFrame:
    """Add a fold number 0..k-1; inside each class (and `within` group) fold sizes differ by at most one.

    Folds are consecutive stretches of the hash order. `seed` may be a column, for several seeds in one pass; `purpose`
    enters the hash, so that folds inside folds, samples and splits under one seed are independent of each other.
    `rows` saves counting a table whose size is known.
    """
    if k < 2:
        raise ValueError("At least two folds are needed.")
    strata, key = [*within, y], hash_hex(seed, purpose, F.col(id))
    cutoffs = hash_cutoffs(df, strata, key, _fold_ranks(k), df.count() if rows is None else rows)
    return passed_cuts(df, strata, key, cutoffs).withColumnRenamed("passed", name)


def nested_folds(df: DataFrame, id: str = "id", y: str = "y", outer: int = FOLDS, inner: int = FOLDS,
                 seed: int = DEFAULT_SEED) -> DataFrame:
    """Inner folds made anew inside every outer training part: one row per (row, outer fold it trains for)."""
    rows = df.count()
    held_out = stratified_folds(df, id, y, outer, seed, name="own_fold", rows=rows)
    training = held_out.withColumn("outer_fold", F.explode(F.sequence(F.lit(0), F.lit(outer - 1)).cast("array<bigint>"))) \
                       .where(F.col("outer_fold") != F.col("own_fold"))
    return stratified_folds(training, id, y, inner, seed, ["outer_fold"], "inner_fold", rows, "inner").drop("own_fold")


def seeded_folds(df: DataFrame, seeds: Sequence[int], id: str = "id", y: str = "y", k: int = FOLDS) -> DataFrame:
    """The fold rule for several seeds at once, as rows keyed by seed."""
    repeated = df.withColumn("seed", F.explode(F.array(*[F.lit(int(s)).cast("long") for s in seeds])))
    return stratified_folds(repeated, id, y, k, F.col("seed"), ["seed"], rows=df.count())


def sample_n(df: DataFrame, n: int, id: str = "id", seed: int = DEFAULT_SEED) -> DataFrame:
    """At most n rows: the first n in hash order; of rows that share the last id, as many as still fit."""
    if n < 1:
        raise ValueError("A sample needs at least one row.")
    key = hash_hex(seed, "sample", F.coalesce(F.col(id).cast("string"), F.lit("")))
    whole = df.withColumn("__all", F.lit(0))
    found = hash_cutoffs(whole, ["__all"], key, lambda total: [F.least(F.lit(n), total)], df.count()).first()
    if found is None:
        return df
    cut = F.lit(found["cuts"][0])
    below = df.where(key < cut)
    return below.unionByName(df.where(key == cut).limit(n - below.count()))
