"""Row-level arithmetic with the conventions the reports rely on."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MACHINE_EPSILON = 2.220446049250313e-16


def as_col(value) -> Column:
    return value if isinstance(value, Column) else F.col(value)


def ratio(numerator, denominator) -> Column:
    """a / b as a double; null when b is zero or either side is null."""
    return F.try_divide(as_col(numerator).cast("double"), as_col(denominator).cast("double"))


def ratio_or_zero(numerator, denominator) -> Column:
    return F.coalesce(ratio(numerator, denominator), F.lit(0.0))


def count_where(condition: Column) -> Column:
    return F.coalesce(F.sum(F.when(condition, 1).otherwise(0)), F.lit(0)).cast("long")


def steps_reached(value: Column, steps: Sequence[float], strict: bool = False) -> Column:
    """How many of the ascending steps the value reaches (or exceeds, if strict), as plain comparisons."""
    reached = [((F.lit(float(s)) < value) if strict else (F.lit(float(s)) <= value)).cast("int") for s in steps]
    return reduce(lambda a, b: a + b, reached, F.lit(0))


def blank(column: Column) -> Column:
    """Empty or whitespace only."""
    return column.rlike(r"^\s*$")


def mean_of(columns: Sequence) -> Column:
    """Mean over the non-null cells of one row; null when all are null."""
    cells = [as_col(c).cast("double") for c in columns]
    total = reduce(lambda a, b: a + b, [F.coalesce(c, F.lit(0.0)) for c in cells])
    present = reduce(lambda a, b: a + b, [c.isNotNull().cast("int") for c in cells])
    return ratio(total, present)


def band_of(column, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """Right-closed bands (e0, e1], (e1, e2], ...; null outside all of them."""
    if len(labels) != len(edges) - 1:
        raise ValueError("Bands need exactly one label per pair of neighbouring edges.")
    value = as_col(column)
    bands = [(value > low) & (value <= high) for low, high in zip(edges, edges[1:])]
    return reduce(lambda chain, pair: chain.when(*pair), zip(bands[1:], labels[1:]), F.when(bands[0], labels[0]))


def sigmoid(total) -> Column:
    """1 / (1 + exp(-x)) without overflow on either side."""
    x = as_col(total)
    small = F.exp(-F.abs(x))
    return F.when(x >= 0, 1 / (1 + small)).otherwise(small / (1 + small))


def close_to(left, right, rtol: float, atol: float) -> Column:
    """|a - b| <= atol + rtol*|b| for finite numbers; two nulls, two NaN and the same infinity are equal too."""
    a, b = as_col(left).cast("double"), as_col(right).cast("double")
    near = finite(a) & finite(b) & (F.abs(a - b) <= F.lit(atol) + F.lit(rtol) * F.abs(b))
    return F.coalesce(near, F.lit(False)) | a.eqNullSafe(b)


def finite(number: Column) -> Column:
    """Neither NaN nor an infinity; null stays null."""
    return ~F.isnan(number) & (F.abs(number) != F.lit(float("inf")))


def melt(df: DataFrame, keep: Sequence[str], columns: Sequence[str], kind: str = "double",
         name: str = "feature", value: str = "value") -> DataFrame:
    """Wide to long (keep..., name, value), all values cast to one type."""
    wide = df.select(*keep, *[F.col(c).cast(kind).alias(c) for c in columns])
    return wide.unpivot(list(keep), list(columns), name, value)


def same_keys(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join in which a null key equals a null key; the result keeps the left key columns."""
    if not keys:
        raise ValueError("A join needs at least one key.")
    renamed = right.select(*[F.col(k).alias(f"__{k}") for k in keys], *[c for c in right.columns if c not in keys])

    def matches(key: str) -> Column:
        # Where one side has no nulls, plain equality says the same and lets the join use an existing partitioning.
        mine, theirs = left[key], renamed[f"__{key}"]
        both_nullable = left.schema[key].nullable and renamed.schema[f"__{key}"].nullable
        return mine.eqNullSafe(theirs) if both_nullable else mine == theirs

    condition = reduce(lambda a, b: a & b, [matches(k) for k in keys])
    joined = left.join(renamed, condition, how)
    return joined if how in ("left_semi", "left_anti") else joined.drop(*[f"__{k}" for k in keys])


def same_keys_full(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Full outer join in which a null key equals a null key; the keys come from whichever side has the row."""
    mine, theirs = left.withColumn("__left", F.lit(True)), right.select(*[F.col(k).alias(f"__{k}") for k in keys], *[c for c in right.columns if c not in keys])
    joined = mine.join(theirs, reduce(lambda a, b: a & b, [mine[k].eqNullSafe(theirs[f"__{k}"]) for k in keys]), "full_outer")
    own = [F.when(F.col("__left").isNotNull(), F.col(k)).otherwise(F.col(f"__{k}")).alias(k) for k in keys]
    return joined.select(*own, *[c for c in (*left.columns, *right.columns) if c not in keys])
