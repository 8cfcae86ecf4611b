"""Stratified percentile bootstrap as rows keyed by replicate; class sizes stay fixed."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from binoscope.functions.hashing import hash_hex, hash_int, hash_uniform
from binoscope.functions.scalars import count_where, ratio_or_zero, same_keys, steps_reached
from binoscope.operators.metrics import FOLD_METRICS, check_threshold, evaluate, refusing
from binoscope.operators.order import hash_rank, local_if_small, split_points, with_range

# Cumulative Poisson(1) probabilities; the last is 1 to double precision.
POISSON_STEPS = 18
CELLS_AT_ONCE = 4_000_000       # (cell, replicate) pairs that a task draws together


def _replicates(n_boot: int) -> Column:
    return F.explode(F.sequence(F.lit(0), F.lit(n_boot - 1)).cast("array<bigint>"))


def _check(n_boot: int, confidence: float) -> tuple[float, float]:
    if n_boot < 1:
        raise ValueError("A bootstrap without replicates has no interval.")
    if not 0 < confidence < 1:
        raise ValueError("The confidence is a share: above 0, below 1.")
    tail = (1 - confidence) / 2
    return tail, 1 - tail


def class_draws(scored: DataFrame, n_boot: int, seed: int) -> DataFrame:
    """(replicate, y, p) of n_y draws with replacement per class and replicate.

    Every row stands for one draw of each replicate; the drawn row is the one whose place in its class equals a
    hash of (seed, replicate, class, place) modulo the class size. Draws and rows meet in an equi join on
    (class, place), whose keys are uniform.
    """
    ranked = hash_rank(scored.select("id", "y", "p"), ["y"], hash_hex(seed, "bootstrap", F.col("id")))
    places = ranked.select("y", "place", "p")
    drawn = ranked.select("y", "place", "stratum_rows").withColumn("replicate", _replicates(n_boot))
    target = hash_int(seed, F.col("replicate"), F.col("y"), F.col("place"), digits=15) % F.col("stratum_rows") + 1
    draws = drawn.select("replicate", F.col("y").alias("y"), target.alias("place"))
    return draws.join(places, ["y", "place"]).select("replicate", "y", "p")


def poisson_weights(scored: DataFrame, n_boot: int, seed: int) -> DataFrame:
    """(replicate, y, p, weight): independent Poisson(1) weights, for tables too large to draw by place.

    Needs no rank and no join. Class sizes vary a little per replicate; every rate is taken over the replicate's
    own class totals.
    """
    cumulative, term = [], 2.718281828459045 ** -1
    total = 0.0
    for k in range(POISSON_STEPS):
        total += term
        cumulative.append(total)
        term /= k + 1
    spread = scored.select("id", "y", "p").withColumn("replicate", _replicates(n_boot))
    weighted = spread.withColumn("u", hash_uniform(seed, F.col("replicate"), F.col("id")))
    return weighted.select("replicate", "y", "p", steps_reached(F.col("u"), cumulative).alias("weight"))


def _range_draws(ranges: DataFrame, n_boot: int, seed: int) -> DataFrame:
    """(value_range, replicate, pos, neg, tp, fp): draws of each class in a range, and in all ranges of higher scores.

    `ranges` has a row per range and class: value_range, y, n. A replicate draws how its class sizes fall to the ranges from
    a stream of its own, so any task can draw it again.
    """
    rows = sorted((r["value_range"], r["y"], r["n"]) for r in ranges.collect())
    numbers = sorted({r for r, _, _ in rows}, reverse=True)
    size = {y: np.array([sum(n for r, label, n in rows if r == number and label == y) for number in numbers]) for y in (0, 1)}

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for replicate in batch.column(0).to_pylist():
                drawn = {y: np.random.Generator(np.random.PCG64([seed, replicate, y])).multinomial(size[y].sum(), size[y] / size[y].sum()) for y in (0, 1)}
                columns = [numbers, [replicate] * len(numbers), drawn[1], drawn[0], np.cumsum(drawn[1]) - drawn[1], np.cumsum(drawn[0]) - drawn[0]]
                yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int32()), *[pa.array(c, pa.int64()) for c in columns[1:]]],
                                                 names=["value_range", "replicate", "pos", "neg", "tp", "fp"])

    return ranges.sparkSession.range(n_boot).mapInArrow(draw, "value_range int, replicate long, pos long, neg long, tp long, fp long")


def counted_replicates(scored: DataFrame, threshold: float, n_boot: int, seed: int) -> DataFrame:
    """(replicate, pr_auc, roc_auc, precision, recall, f1) of stratified replicates, drawn from counts of equal scores.

    Rows collapse to (class, score) cells, cells are cut into ranges. The number of draws in a range is drawn first, then
    split over its cells inside one task; the draws in higher ranges are known, so every range gives its part of the sums.
    Only cells travel, once; a replicate costs one number per cell and one small row per range.
    """
    cells = scored.groupBy("y", "p").agg(F.count(F.lit(1)).alias("n"))
    ranged = with_range(cells, "p", split_points(scored, "p"))
    draws = _range_draws(ranged.groupBy("value_range", "y").agg(F.sum("n").alias("n")), n_boot, seed)

    def parts(key: tuple, own: pa.Table, drawn: pa.Table) -> pa.Table:
        number = key[0].as_py()
        y, p, n = (own[c].to_numpy() for c in ("y", "p", "n"))
        values, place = np.unique(-p, return_inverse=True)          # highest score first
        count = {label: np.bincount(place[y == label], n[y == label], len(values)) for label in (0, 1)}
        flagged = -values >= threshold
        replicate, pos, neg, tp, fp = (drawn[c].to_numpy() for c in ("replicate", "pos", "neg", "tp", "fp"))
        found: list[np.ndarray] = []
        for begin in range(0, len(replicate), step := max(1, CELLS_AT_ONCE // len(values))):
            some = slice(begin, begin + step)
            split = {}
            for label, total in ((1, pos[some]), (0, neg[some])):
                whole = count[label].sum()
                split[label] = np.stack([
                    np.random.Generator(np.random.PCG64([seed, r, label, number + 2])).multinomial(t, count[label] / whole) if t else np.zeros(len(values), dtype=np.int64)
                    for r, t in zip(replicate[some].tolist(), total.tolist())])
            above = tp[some, None] + np.cumsum(split[1], axis=1)
            false = fp[some, None] + np.cumsum(split[0], axis=1)
            ap = (split[1] * above / np.maximum(above + false, 1)).sum(axis=1)
            auc = (split[0] * (above - split[1] / 2)).sum(axis=1)
            found.append(np.stack([replicate[some], ap, auc, split[1][:, flagged].sum(axis=1), split[0][:, flagged].sum(axis=1)]))
        columns = np.concatenate(found, axis=1)
        return pa.table({"replicate": columns[0].astype(np.int64), "ap": columns[1], "auc": columns[2], "hits": columns[3].astype(np.int64),
                         "false": columns[4].astype(np.int64)})

    summed = ranged.groupBy("value_range").cogroup(draws.groupBy("value_range")).applyInArrow(
        parts, "replicate long, ap double, auc double, hits long, false long")
    sizes = {r["y"]: r["n"] for r in cells.groupBy("y").agg(F.sum("n").alias("n")).collect()}
    n_pos, n_neg = F.lit(float(sizes[1])), F.lit(float(sizes[0]))
    hits, false = F.sum("hits"), F.sum("false")
    return summed.groupBy("replicate").agg(
        (F.sum("ap") / n_pos).alias("pr_auc"), (F.sum("auc") / (n_pos * n_neg)).alias("roc_auc"), ratio_or_zero(hits, hits + false).alias("precision"),
        (hits / n_pos).alias("recall"), ratio_or_zero(2 * hits, n_pos + hits + false).alias("f1"))


def bootstrap_ci(scored: DataFrame, threshold: float, n_boot: int = 1000, confidence: float = 0.95, seed: int = 42,
                 method: str = "draws") -> DataFrame:
    """Estimate and percentile interval of AP, ROC-AUC, precision, recall and F1 for one frozen score and threshold.

    All replicates are evaluated in one grouping by replicate. `method` is 'counts' (exact stratified resampling of counted
    scores: the way for many replicates and for large tables), 'draws' (the same, row by row, with an SQL twin) or 'poisson'
    (weights instead of draws, a map-side step).
    """
    low, high = _check(n_boot, confidence)
    if method not in ("counts", "draws", "poisson"):
        raise ValueError("method is 'counts', 'draws' or 'poisson'.")
    classes = scored.agg(F.min("y").alias("low"), F.max("y").alias("high")).first()
    if (classes["low"], classes["high"]) != (0, 1):
        raise ValueError("Resampling by class needs rows of label 0 and of label 1.")
    # A replicate has about as many rows as the table, so the table's own value ranges fit every replicate.
    cuts = split_points(scored, "p")
    point = evaluate(scored, threshold, cuts=cuts)
    if method == "counts":
        replicas = counted_replicates(refusing(scored), threshold, n_boot, seed)
    elif method == "draws":
        replicas = evaluate(class_draws(scored, n_boot, seed), threshold, ["replicate"], cuts=cuts)
    else:
        replicas = evaluate(poisson_weights(scored, n_boot, seed), threshold, ["replicate"], weight="weight", cuts=cuts)
    long = replicas.select("replicate", *FOLD_METRICS).unpivot(["replicate"], FOLD_METRICS, "metric", "value")
    # n_boot values per metric: the built-in percentile holds no more than that.
    bounds = long.groupBy("metric").agg(F.percentile("value", F.lit(low)).alias("lower"), F.percentile("value", F.lit(high)).alias("upper"))
    estimates = point.select(F.lit(1).alias("__one"), *FOLD_METRICS).unpivot(["__one"], FOLD_METRICS, "metric", "estimate").drop("__one")
    return same_keys(estimates, bounds, ["metric"]).select(
        "metric", "estimate", "lower", "upper", F.lit(float(confidence)).alias("confidence"),
        F.lit(n_boot).cast("long").alias("replicates"), F.lit(float(threshold)).alias("threshold"))


def binomial_steps(n: int, share: float) -> tuple[int, np.ndarray]:
    """(first, cumulative probabilities of first, first + 1, ... successes) of n draws; what lies outside is below 1e-30."""
    if share <= 0 or share >= 1:
        return (n if share >= 1 else 0), np.ones(1)
    spread = (n * share * (1 - share)) ** 0.5
    low, high = max(0, math.floor(n * share - 12 * spread - 40)), min(n, math.ceil(n * share + 12 * spread + 40))
    whole, one, other = math.lgamma(n + 1), math.log(share), math.log1p(-share)
    logs = [whole - math.lgamma(k + 1) - math.lgamma(n - k + 1) + k * one + (n - k) * other for k in range(low, high + 1)]
    return low, np.cumsum(np.exp(logs))


def _counted_hits(sizes: DataFrame, n_boot: int, seed: int) -> DataFrame:
    """(attribute, group, replicate, y, hits, n): one binomial number of flagged draws per group, class and replicate.

    A uniform hash of (seed, replicate, group, class) is looked up in the cumulative probabilities, which are made once per
    group and class, so a replicate costs one search.
    """
    @F.pandas_udf("array<long>")
    def draw(size: pd.Series, hit: pd.Series, uniform: pd.Series) -> pd.Series:
        found = []
        for n, h, u in zip(size, hit, uniform):
            first, steps = binomial_steps(int(n), h / n)
            found.append(np.minimum(first + np.searchsorted(steps, u), n))
        return pd.Series(found)

    replicates = F.sequence(F.lit(0), F.lit(n_boot - 1)).cast("array<bigint>")
    uniform = F.transform(replicates, lambda r: hash_uniform(seed, "subgroups", r, F.col("attribute"), F.col("group"), F.col("y")))
    # The few counted rows are spread before each becomes n_boot rows.
    drawn = sizes.repartition("attribute", "group").withColumn("all", draw("n_class", "n_flagged", uniform))
    return drawn.select("attribute", "group", "y", F.col("n_class").alias("n"), F.posexplode("all").alias("replicate", "hits"))


def subgroup_ci(scored: DataFrame, attributes: Sequence[str], threshold: float, n_boot: int = 1000, confidence: float = 0.95,
                seed: int = 42, method: str = "counts") -> DataFrame:
    """Intervals of recall, false-positive rate and selection rate per group, resampled inside (group, class).

    A rate only needs how many drawn rows are flagged, a binomial number: `method` "counts" draws it from the counted
    groups, whatever their size. "draws" makes every single draw instead: with the flagged rows first, a draw is flagged
    when its hash modulo the class size falls below the flagged count, so no row has to be looked up.
    """
    check_threshold(threshold)
    if method not in ("counts", "draws"):
        raise ValueError("method is 'counts' or 'draws'.")
    low, high = _check(n_boot, confidence)
    flagged = F.col("p") >= threshold
    long = refusing(scored).select("id", "y", flagged.alias("flagged"), *[F.col(a).cast("string").alias(a) for a in attributes]) \
                 .unpivot(["id", "y", "flagged"], list(attributes), "attribute", "group").where(F.col("group").isNotNull())
    keys = ["attribute", "group", "y"]
    sizes = long.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_class"), count_where(F.col("flagged")).alias("n_flagged"))
    if method == "counts":
        hits = _counted_hits(sizes, n_boot, seed)
    else:
        # One row per group and class: the rows of a large group are not shuffled to meet their counts.
        draws = same_keys(long.select("id", *keys), local_if_small(sizes), keys).withColumn("replicate", _replicates(n_boot))
        place = hash_int(seed, F.col("replicate"), F.col("attribute"), F.col("group"), F.col("y"), F.col("id"),
                         digits=15) % F.col("n_class")
        hits = draws.groupBy("attribute", "group", "replicate", "y").agg(
            count_where(place < F.col("n_flagged")).alias("hits"), F.count(F.lit(1)).alias("n"))
    rates = hits.groupBy("attribute", "group", "replicate").agg(
        F.sum(F.when(F.col("y") == 1, F.col("hits") / F.col("n"))).alias("recall"),
        F.sum(F.when(F.col("y") == 0, F.col("hits") / F.col("n"))).alias("false_positive_rate"),
        (F.sum("hits") / F.sum("n")).alias("selection_rate"))
    bounds = [F.percentile(m, F.lit(q)).alias(f"{m}_{side}") for m in ("recall", "false_positive_rate", "selection_rate")
              for side, q in (("lower", low), ("upper", high))]
    return rates.groupBy("attribute", "group").agg(*bounds)
