"""Explanations of fitted scores: permutation importance and additive contributions."""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from hashlib import md5

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from binoscope.functions.hashing import hash_hex
from binoscope.functions.scalars import close_to, melt, same_keys, same_keys_full, sigmoid
from binoscope.operators.metrics import curve_of_cells, score_cells, score_curve, _ap
from binoscope.operators.order import hash_rank
from binoscope.session import materialize

# Tolerance of the additivity check, number of listed contributions.
ADD_RTOL, ADD_ATOL = 1e-5, 1e-6
TOP_CONTRIBUTIONS = 10
# Rounds of a permutation, coefficients of a round's polynomial, and the prime it is taken over.
ROUNDS, DEGREE, PRIME = 4, 4, 2 ** 31 - 1


def grid_of(rows: int) -> tuple[int, int]:
    """Sides (a, b) of a grid of `rows` places or few more: of all a about the square root, the one that leaves fewest over."""
    root = math.isqrt(rows)
    return min(((a, -(-rows // a)) for a in range(max(2, root // 2 + 1), max(2, 2 * root) + 1)), key=lambda sides: (sides[0] * sides[1], sides))


def round_keys(seed: int, repeat: int) -> list[list[int]]:
    """Coefficients of the round polynomials of one repeat, by the same hash as every other seeded choice."""
    def key(i: int) -> int:
        return int(md5(f"{seed}|permute|{repeat}|{i}".encode()).hexdigest()[:8], 16) % PRIME
    return [[key(i * DEGREE + k) for k in range(DEGREE)] for i in range(ROUNDS)]


def moved(place: Column, keys: Column, rows: int) -> Column:
    """The image of a place (0 to rows - 1) under the permutation that `keys`, an array of ROUNDS coefficient arrays, holds.

    The place is cell (l, r) of a grid. A round adds a keyed cubic polynomial of one coordinate, over a prime field, to the
    other, modulo that one's side, so every round is a bijection of the grid. A place that lands behind the last row goes on
    until it does not; as the grid has d such cells, d more passes always end it, and d is 0 to a few. All numbers stay
    below 2^62, so whole batches are moved by 64-bit array arithmetic.
    """
    a, b = grid_of(rows)

    def whole_pass(p: np.ndarray, k: np.ndarray) -> np.ndarray:
        own, other, side, other_side = p // b, p % b, a, b
        for i in range(ROUNDS):
            total = k[:, i * DEGREE]
            for j in range(1, DEGREE):
                total = (total * other + k[:, i * DEGREE + j]) % PRIME
            own, other, side, other_side = other, (own + total) % side, other_side, side
        return own * b + other

    @F.arrow_udf("long")
    def image(places: pa.Array, coefficients: pa.Array) -> pa.Array:
        k = coefficients.flatten().to_numpy(zero_copy_only=False).reshape(-1, ROUNDS * DEGREE)
        p = whole_pass(places.to_numpy(zero_copy_only=False), k)
        behind = np.flatnonzero(p >= rows)
        while len(behind):
            p[behind] = whole_pass(p[behind], k[behind])
            behind = behind[p[behind] >= rows]
        return pa.array(p)

    return image(place, F.flatten(keys))


def permuted(df: DataFrame, columns: Sequence[str], repeats: int, seed: int, id: str = "id") -> DataFrame:
    """Rows keyed by (column, repeat) in which that column carries the value of another row.

    The rows get places once, in a hash order. For each repeat a row sends its values to another place, found by
    arithmetic from its own (`moved`): an exact permutation at any size, with no ranking per repeat. Only the permuted values
    travel that often; the rest of a row travels once. No rows give no rows.
    """
    rest, rows = [c for c in df.columns if c not in columns], df.count()
    placed = hash_rank(df, [], hash_hex(seed, "places", F.col(id)), rows).drop("stratum_rows").withColumn("place", F.col("place") - 1)
    keys = F.array(*[F.struct(F.lit(r).cast("long").alias("repeat"), F.array(*[F.array(*[F.lit(k).cast("long") for k in ks]) for ks in round_keys(seed, r)]).alias("k"))
                     for r in range(repeats)])
    sent = placed.select("place", F.struct(*columns).alias("__d"), F.explode(keys).alias("__r"))
    sent = sent.select(moved(F.col("place"), F.col("__r.k"), rows).alias("place"), "__d", F.col("__r.repeat").alias("repeat"))
    donated = placed.join(sent, ["place"])
    variants = F.array(*[F.struct(F.lit(c).alias("column"), *[(F.col("__d")[k] if k == c else F.col(k)).alias(k) for k in columns])
                         for c in columns])
    return donated.select(*rest, "repeat", F.explode(variants).alias("v")).select(*rest, "repeat", "v.*")


def permutation_importance(df: DataFrame, score: Callable[[DataFrame], DataFrame], columns: Sequence[str], repeats: int = 10,
                           seed: int = 42, id: str = "id") -> DataFrame:
    """AP lost when a column is permuted: mean and population SD over the repeats, per column.

    `score` adds p to a table and keeps the other columns. All (column, repeat) variants are scored in one pass, whose
    counts by score are written once, and evaluated in one grouping.
    """
    base = score_curve(score(df)).groupBy().agg(_ap().alias("base_ap"))
    by = ["column", "repeat"]
    # Ranges, offsets and curve all read the cells; without the cut each would permute and score again.
    cells = materialize(score_cells(score(permuted(df, columns, repeats, seed, id)), by))
    shuffled = curve_of_cells(cells, by).groupBy(*by).agg(_ap().alias("ap"))
    # base is a single row.
    drops = shuffled.join(F.broadcast(base), F.lit(True)).withColumn("drop", F.col("base_ap") - F.col("ap"))
    return drops.groupBy(F.col("column").alias("feature")).agg(F.avg("drop").alias("mean_ap_decrease"),
                                                               F.stddev_pop("drop").alias("std_ap_decrease"))


def linear_contributions(df: DataFrame, coefficients: dict[str, float], background: DataFrame, keep: Sequence[str] = ("id",)) -> DataFrame:
    """(keep..., feature, contribution) = coefficient x (value - background mean).

    Coefficients and background means are O(features), so they become literals in one projection.
    """
    means = background.agg(*[F.avg(c).alias(c) for c in coefficients]).first()
    wide = df.select(*keep, *[((F.col(c) - F.lit(means[c])) * F.lit(float(b))).alias(c) for c, b in coefficients.items()])
    return melt(wide, keep, list(coefficients)).select(*keep, "feature", F.col("value").alias("contribution"))


def base_value(coefficients: dict[str, float], intercept: float, background: DataFrame) -> float:
    means = background.agg(*[F.avg(c).alias(c) for c in coefficients]).first()
    return float(intercept) + sum(float(b) * means[c] for c, b in coefficients.items())


def mean_absolute(contributions: DataFrame) -> DataFrame:
    return contributions.groupBy("feature").agg(F.avg(F.abs("contribution")).alias("mean_absolute"))


def top_contributions(contributions: DataFrame, sources: dict[str, str] | Column | None = None, k: int = TOP_CONTRIBUTIONS,
                      id: str = "id") -> DataFrame:
    """Contributions folded to source columns; the k largest by size per row and the sum of the others.

    `sources` maps an encoded column to its source column; unmapped names stand for themselves. A row's list is
    as long as the feature list, so ranking it inside an array needs no window over the rows.
    """
    if isinstance(sources, dict) and sources:
        mapping = F.create_map(*[F.lit(x) for pair in sources.items() for x in pair])
        source = F.coalesce(F.try_element_at(mapping, F.col("feature")), F.col("feature"))
    else:
        source = sources if isinstance(sources, Column) else F.col("feature")
    folded = contributions.groupBy(id, source.alias("source")).agg(F.sum("contribution").alias("contribution"))
    ranked = folded.groupBy(id).agg(F.array_sort(F.collect_list(F.struct(
        (-F.abs("contribution")).alias("k"), "source", "contribution"))).alias("list"))
    others = F.aggregate(F.slice("list", k + 1, 2 ** 30), F.lit(0.0), lambda a, x: a + x["contribution"])
    listed = ranked.select(id, others.alias("other_contribution"), F.posexplode(F.slice("list", 1, k)).alias("at", "c"))
    value = F.col("c.contribution")
    return listed.select(id, (F.col("at") + 1).cast("long").alias("rank"), F.col("c.source").alias("feature"), value.alias("contribution"),
                         F.when(value > 0, "Higher").when(value < 0, "Lower").otherwise("Neutral").alias("direction"),
                         "other_contribution")


def explained_probability(total, units: str = "log-odds") -> Column:
    column = F.col(total) if isinstance(total, str) else total
    if units == "log-odds":
        return sigmoid(column)
    if units == "probability":
        return column
    raise ValueError("units is 'log-odds' or 'probability'.")


def check_additive(contributions: DataFrame, base: float, expected: DataFrame, id: str = "id", units: str = "log-odds",
                   rtol: float = ADD_RTOL, atol: float = ADD_ATOL) -> DataFrame:
    """Per row: base + contributions, its probability, and whether it reproduces `expected(id, output)`.

    An id that only one side has is not additive: its total or the output it should reproduce is missing.
    """
    sums = contributions.groupBy(id).agg(F.sum("contribution").alias("s")).withColumn("total", F.col("s") + F.lit(float(base)))
    joined = same_keys_full(sums, expected.select(id, "output"), [id])
    return joined.select(id, "total", explained_probability("total", units).alias("probability"),
                         (F.col("total").isNotNull() & F.col("output").isNotNull()
                          & F.coalesce(close_to("total", "output", rtol, atol), F.lit(False))).alias("additive"))
