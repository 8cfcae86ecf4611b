"""Evaluation of scores: input scored(id, y, p, group keys...), one pass per report, groups are rows with a key."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from binoscope.functions.scalars import MACHINE_EPSILON, count_where, ratio, ratio_or_zero, same_keys, steps_reached
from binoscope.operators.order import local_if_small, running_totals, split_points, value_cuts
from binoscope.session import materialize, rows_per_bucket

DEFAULT_THRESHOLD = 0.5
THRESHOLD_GRID = [round(0.05 * i, 2) for i in range(1, 20)]
# Scores that a task packs at once, and of a range of one group and of all groups together.
SCORES_AT_ONCE, SCORES_PER_RANGE, MOST_PER_RANGE = 2_000_000, 1_000_000, 20_000_000
FOLD_METRICS = ["pr_auc", "roc_auc", "precision", "recall", "f1"]


def check_threshold(threshold: float) -> float:
    if not (math.isfinite(threshold) and 0 <= threshold <= 1):
        raise ValueError("The decision threshold must be a finite number from 0 to 1.")
    return float(threshold)


def refusing(scored: DataFrame) -> DataFrame:
    """The scores, with an error instead of p where a row breaks the contract: y is 0 or 1, p a number from 0 to 1.

    The test rides along in the plan and needs no pass of its own; `checks.check_scored` lists the violations.
    """
    y, p = F.col("y"), F.col("p")
    broken = y.isNull() | ~y.isin(0, 1) | p.isNull() | F.isnan(p) | (p < 0) | (p > 1)
    reason = F.concat(F.lit("A score needs a label 0 or 1 and a number from 0 to 1, not y="), F.coalesce(y.cast("string"), F.lit("null")),
                      F.lit(", p="), F.coalesce(p.cast("string"), F.lit("null")))
    return scored.withColumn("p", F.when(broken, F.raise_error(reason)).otherwise(p))


def label_at(scored: DataFrame, threshold: float, yes="Yes", no="No") -> DataFrame:
    """Add predicted_class and decision_threshold; a score equal to the threshold counts as positive."""
    check_threshold(threshold)
    return scored.withColumn("predicted_class", F.when(F.col("p") >= threshold, F.lit(yes)).otherwise(F.lit(no))) \
                 .withColumn("decision_threshold", F.lit(float(threshold)))


def confusion(scored: DataFrame, threshold: float, by: Sequence[str] = ()) -> DataFrame:
    check_threshold(threshold)
    flagged, positive = F.col("p") >= threshold, F.col("y") == 1
    return scored.groupBy(*by).agg(
        count_where(~positive & ~flagged).alias("true_negatives"), count_where(~positive & flagged).alias("false_positives"),
        count_where(positive & ~flagged).alias("false_negatives"), count_where(positive & flagged).alias("true_positives"))


def rate_columns() -> list[Column]:
    """Precision, recall and F1 from confusion counts, zero where the denominator is zero."""
    tp, fp, fn = F.col("true_positives"), F.col("false_positives"), F.col("false_negatives")
    return [ratio_or_zero(tp, tp + fp).alias("precision"), ratio_or_zero(tp, tp + fn).alias("recall"),
            ratio_or_zero(2 * tp, 2 * tp + fp + fn).alias("f1")]


def precision_recall_f1(scored: DataFrame, threshold: float, by: Sequence[str] = ()) -> DataFrame:
    return confusion(scored, threshold, by).select(*by, *rate_columns())


def score_cells(scored: DataFrame, by: Sequence[str] = (), weight: str | None = None) -> DataFrame:
    """One row per group and distinct score with its negatives and positives; ties become one step."""
    amount = F.col(weight) if weight else F.lit(1)
    return scored.groupBy(*by, "p").agg(F.sum(F.when(F.col("y") == 1, amount).otherwise(0)).cast("long").alias("n_pos"),
                                        F.sum(F.when(F.col("y") == 0, amount).otherwise(0)).cast("long").alias("n_neg"))


def score_curve(scored: DataFrame, by: Sequence[str] = (), weight: str | None = None,
                cuts: Sequence[float] | None = None) -> DataFrame:
    """score_cells with cumulative counts from the highest score down: tp, fp, and the totals n_p, n_n.

    Exact for any number of distinct scores and any group size: see running_totals.
    """
    cuts = split_points(scored, "p") if cuts is None else cuts
    return curve_of_cells(score_cells(scored, by, weight), by, cuts)


def curve_of_cells(cells: DataFrame, by: Sequence[str] = (), cuts: Sequence[float] | None = None) -> DataFrame:
    """The curve of a table that score_cells has made."""
    cuts = split_points(cells, "p") if cuts is None else cuts
    run = running_totals(cells, by, "p", ["n_pos", "n_neg"], cuts, descending=True)
    return run.select(*by, "p", "n_pos", "n_neg", F.col("run_n_pos").alias("tp"), F.col("run_n_neg").alias("fp"),
                      F.col("total_n_pos").alias("n_p"), F.col("total_n_neg").alias("n_n"))


def _ap() -> Column:
    """Sum over distinct scores of recall gained times precision there; null unless both classes occur."""
    both = (F.max("n_p") > 0) & (F.max("n_n") > 0)
    return F.when(both, F.sum(ratio(F.col("n_pos") * F.col("tp"), F.col("tp") + F.col("fp")))
                  / F.max("n_p").cast("double"))


def _auc() -> Column:
    """Share of (positive, negative) pairs in the right order, ties counted half; null unless both classes occur."""
    both = (F.max("n_p") > 0) & (F.max("n_n") > 0)
    won = F.sum(F.col("n_neg").cast("double") * (F.col("tp") - F.col("n_pos") / 2))
    return F.when(both, won / (F.max("n_p").cast("double") * F.max("n_n")))


def average_precision(scored: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """AP per group: by the curve of a table that fits one sort, else by ranges of packed scores."""
    sizes = scored.groupBy(*by).agg(F.count(F.lit(1)).alias("n")).agg(F.sum("n").alias("n"), F.max("n").alias("most")).first() if by else None
    if sizes and (sizes["n"] or 0) > rows_per_bucket(scored.sparkSession):
        return _packed_ap(scored, list(by), max(math.ceil(4 * sizes["most"] / SCORES_PER_RANGE), math.ceil(sizes["n"] / MOST_PER_RANGE)))
    return score_curve(scored, by, cuts=[] if sizes else None).groupBy(*by).agg(_ap().alias("pr_auc"))


def _packed_ap(scored: DataFrame, by: list[str], ranges: int) -> DataFrame:
    """AP of many scores: tasks pack those of a (group, value range) into arrays, and these travel in place of rows.

    A range sorts its own scores and needs but the counts of the ranges above it. The ranges shape the work, not the
    result; equal scores are packed as counts. A null score is a range of its own behind all others, as it sorts.
    """
    edges = np.array(value_cuts(scored.select("p"), "p", ranges))
    own = scored.select(*by, F.col("p").cast("double").alias("p"), F.col("y").cast("int").alias("y"))
    keys, fields = [*by, "value_range"], list(scored.select(*by).schema.fields)
    counted = [T.StructField("n_pos", T.LongType()), T.StructField("n_neg", T.LongType())]
    tiled = T.StructType([*fields, T.StructField("value_range", T.IntegerType()), *counted, T.StructField("packed", T.BinaryType())])

    def collapsed(at: np.ndarray, p: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """One entry per (tile, distinct score), from the highest score down: where it begins, the score, its counts. NaN is the highest."""
        order = np.lexsort((p, at))[::-1]
        p, at = p[order], at[order]
        same = (at[1:] == at[:-1]) & ((p[1:] == p[:-1]) | (np.isnan(p[1:]) & np.isnan(p[:-1])))
        first = np.flatnonzero(np.r_[True, ~same])
        return order[first], p[first], np.add.reduceat(counts[order], first, axis=0)

    def tiles(table: pa.Table) -> pa.RecordBatch:
        code = np.zeros(table.num_rows, dtype=np.int64)
        for c in by:
            known = pa.chunked_array(table[c].chunks).combine_chunks().dictionary_encode(null_encoding="encode")
            code = code * max(len(known.dictionary), 1) + known.indices.to_numpy(zero_copy_only=False)
        absent = table["p"].is_null().to_numpy()
        p = table["p"].fill_null(-math.inf).to_numpy() + 0.0            # -0.0 and 0.0 are one score
        place = np.where(absent, 0, 1 + np.searchsorted(edges, p, side="right"))
        at = code * (len(edges) + 2) + place
        y = table["y"].fill_null(-1).to_numpy()
        rows, scores, counts = collapsed(at, p, np.stack([y == 1, y == 0], axis=1).astype(np.int32))
        begin = np.flatnonzero(np.r_[True, np.diff(at[rows]) != 0])
        ends = [*begin[1:], len(rows)]
        heads = table.select(by).take(rows[begin]).combine_chunks()
        totals = np.add.reduceat(counts.astype(np.int64), begin, axis=0)
        parts = [scores[i:j].tobytes() + counts[i:j].astype(np.int32).tobytes() for i, j in zip(begin, ends)]
        return pa.RecordBatch.from_arrays([*[heads[c].combine_chunks() for c in by], pa.array(place[rows[begin]], pa.int32()), pa.array(totals[:, 0]),
                                           pa.array(totals[:, 1]), pa.array(parts, pa.binary())], names=tiled.names)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept, rows = [], 0
        for batch in batches:
            kept.append(batch)
            rows += batch.num_rows
            if rows >= SCORES_AT_ONCE:
                yield tiles(pa.Table.from_batches(kept))
                kept, rows = [], 0
        if rows:
            yield tiles(pa.Table.from_batches(kept))

    def gained(table: pa.Table) -> pa.Table:
        scores, counts = [], []
        for cell in table["packed"]:
            packed = cell.as_py()
            n = len(packed) // 16
            scores.append(np.frombuffer(packed, np.float64, n))
            counts.append(np.frombuffer(packed, np.int32, 2 * n, 8 * n).reshape(n, 2))
        p = np.concatenate(scores)
        _, _, n = collapsed(np.zeros(len(p), dtype=np.int8), p, np.concatenate(counts).astype(np.int64))
        tp, fp = table["tp"][0].as_py() + np.cumsum(n[:, 0]), table["fp"][0].as_py() + np.cumsum(n[:, 1])
        sums = [pa.array([float((n[:, 0] * (tp / np.maximum(tp + fp, 1))).sum())]), *[pa.array([int(k)]) for k in n.sum(axis=0)]]
        return pa.Table.from_arrays([*[table[c].slice(0, 1) for c in by], *sums], names=[*by, "gained", "n_pos", "n_neg"])

    packed = materialize(own.mapInArrow(pack, tiled))
    above = running_totals(packed.groupBy(*keys).agg(F.sum("n_pos").alias("n_pos"), F.sum("n_neg").alias("n_neg")), by, "value_range",
                           ["n_pos", "n_neg"], [], descending=True)
    above = above.select(*keys, (F.col("run_n_pos") - F.col("n_pos")).alias("tp"), (F.col("run_n_neg") - F.col("n_neg")).alias("fp"))
    placed = same_keys(packed.select(*keys, "packed"), above, keys).groupBy(*keys)
    summed = placed.applyInArrow(gained, T.StructType([*fields, T.StructField("gained", T.DoubleType()), *counted])).groupBy(*by)
    both = (F.sum("n_pos") > 0) & (F.sum("n_neg") > 0)
    return summed.agg(F.when(both, F.sum("gained") / F.sum("n_pos").cast("double")).alias("pr_auc"))


def roc_auc(scored: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return score_curve(scored, by).groupBy(*by).agg(_auc().alias("roc_auc"))


def brier(scored: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return scored.groupBy(*by).agg(F.avg((F.col("p") - F.col("y")) * (F.col("p") - F.col("y"))).alias("brier_score"))


def log_loss(scored: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    clipped = F.greatest(F.lit(MACHINE_EPSILON), F.least(F.col("p"), F.lit(1 - MACHINE_EPSILON)))
    loss = -F.when(F.col("y") == 1, F.ln(clipped)).otherwise(F.ln(1 - clipped))
    return scored.groupBy(*by).agg(F.avg(loss).alias("log_loss"))


def evaluate(scored: DataFrame, threshold: float = DEFAULT_THRESHOLD, by: Sequence[str] = (),
             weight: str | None = None, cuts: Sequence[float] | None = None) -> DataFrame:
    """The full metric row per group, all from one collapsed table: ranking metrics, threshold metrics, counts.

    Rows that are no scores (see `refusing`) and, without groups, an empty table are errors.
    """
    check_threshold(threshold)
    scored = refusing(scored)
    flagged = F.col("p") >= threshold
    miss, hit = F.col("p") * F.col("p"), (1 - F.col("p")) * (1 - F.col("p"))
    total = F.max("n_p") + F.max("n_n")
    if not by:
        total = F.coalesce(total, F.raise_error(F.lit("There are no scores to evaluate.")).cast("long"))
    row = score_curve(scored, by, weight, cuts).groupBy(*by).agg(
        _auc().alias("roc_auc"), _ap().alias("pr_auc"),
        (F.sum(F.col("n_neg") * miss + F.col("n_pos") * hit) / total).alias("brier_score"),
        F.sum(F.when(~flagged, F.col("n_neg")).otherwise(0)).alias("true_negatives"),
        F.sum(F.when(flagged, F.col("n_neg")).otherwise(0)).alias("false_positives"),
        F.sum(F.when(~flagged, F.col("n_pos")).otherwise(0)).alias("false_negatives"),
        F.sum(F.when(flagged, F.col("n_pos")).otherwise(0)).alias("true_positives"),
        total.alias("n"), F.max("n_p").alias("positive_count"))
    return row.select(*by, "roc_auc", "pr_auc", *rate_columns(), "brier_score", F.lit(float(threshold)).alias("threshold"),
                      "true_negatives", "false_positives", "false_negatives", "true_positives", "n", "positive_count")


def threshold_table(scored: DataFrame, grid: Sequence[float] | None = None, by: Sequence[str] = ()) -> DataFrame:
    """Confusion counts, precision, recall, F1 and F2 at every threshold of the grid.

    A score only matters through how many thresholds it reaches, so rows collapse to (group, reached) before
    the sweep; the sweep itself runs on at most len(grid) + 1 rows per group.
    """
    grid = sorted(check_threshold(t) for t in (THRESHOLD_GRID if grid is None else grid))
    if not grid:
        raise ValueError("The threshold grid is empty.")
    steps = F.array(*[F.lit(t) for t in grid])
    reached = refusing(scored).withColumn("reached", steps_reached(F.col("p"), grid))
    cells = reached.groupBy(*by, "reached").agg(count_where(F.col("y") == 1).alias("n_pos"),
                                                count_where(F.col("y") == 0).alias("n_neg"))
    swept = cells.select("*", F.posexplode(steps).alias("step", "threshold"))
    flagged = F.col("reached") > F.col("step")
    counts = swept.groupBy(*by, "threshold").agg(
        F.sum(F.when(~flagged, F.col("n_neg")).otherwise(0)).alias("true_negatives"),
        F.sum(F.when(flagged, F.col("n_neg")).otherwise(0)).alias("false_positives"),
        F.sum(F.when(~flagged, F.col("n_pos")).otherwise(0)).alias("false_negatives"),
        F.sum(F.when(flagged, F.col("n_pos")).otherwise(0)).alias("true_positives"))
    rated = counts.select("*", *rate_columns())
    f2 = ratio_or_zero(5 * F.col("precision") * F.col("recall"), 4 * F.col("precision") + F.col("recall"))
    return rated.select(*by, "threshold", "precision", "recall", "f1", f2.alias("f2"), "true_negatives",
                        "false_positives", "false_negatives", "true_positives",
                        (F.col("true_positives") + F.col("false_negatives") + F.col("true_negatives")
                         + F.col("false_positives")).alias("n"),
                        (F.col("true_positives") + F.col("false_negatives")).alias("positive_count"))


def select_threshold(table: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Per group the threshold with the highest F2, then precision, then the higher threshold."""
    choice = F.max_by(F.struct("threshold", "f2", "precision", "recall"), F.struct("f2", "precision", "threshold"))
    return table.groupBy(*by).agg(choice.alias("choice")).select(*by, "choice.*")


def chosen_threshold(table: DataFrame) -> float:
    row = select_threshold(table).first()
    if row is None or row["threshold"] is None:
        raise ValueError("The threshold table is empty.")
    return float(row["threshold"])


def reliability(scored: DataFrame, bins: int = 10, by: Sequence[str] = ()) -> DataFrame:
    """Equal-width bins of the score, empty ones kept, p = 1 in the last."""
    place = F.least((F.col("p") * bins).cast("int"), F.lit(bins - 1))
    filled = scored.groupBy(*by, place.alias("bin")).agg(
        F.count(F.lit(1)).alias("n"), F.avg("p").alias("mean_probability"), F.avg("y").alias("observed_rate"))
    # At most `bins` entries per group: the map is the left side's lookup, so the spine needs no join.
    packed = filled.groupBy(*by).agg(F.map_from_entries(F.collect_list(F.struct(
        F.col("bin"), F.struct("n", "mean_probability", "observed_rate")))).alias("cell"))
    spine = packed.withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))))
    cell = F.try_element_at("cell", F.col("bin"))
    return spine.select(*by, F.col("bin").cast("long").alias("bin"), (F.col("bin") / F.lit(float(bins))).alias("lower"),
                        ((F.col("bin") + 1) / F.lit(float(bins))).alias("upper"),
                        F.coalesce(cell["n"], F.lit(0)).cast("long").alias("n"),
                        cell["mean_probability"].alias("mean_probability"), cell["observed_rate"].alias("observed_rate"))


def calibration_scores(scored: DataFrame, by: Sequence[str] = ("method",)) -> DataFrame:
    """Brier score and log loss per method."""
    clipped = F.greatest(F.lit(MACHINE_EPSILON), F.least(F.col("p"), F.lit(1 - MACHINE_EPSILON)))
    loss = -F.when(F.col("y") == 1, F.ln(clipped)).otherwise(F.ln(1 - clipped))
    return scored.groupBy(*by).agg(F.avg((F.col("p") - F.col("y")) * (F.col("p") - F.col("y"))).alias("brier_score"),
                                   F.avg(loss).alias("log_loss"))


def calibration_report(scored: DataFrame, bins: int = 10, by: Sequence[str] = ("method",)) -> DataFrame:
    """Reliability bins with the scores of their method on every row."""
    return same_keys(reliability(scored, bins, by), calibration_scores(scored, by), list(by))


def capacity(scored: DataFrame, fractions: Sequence[float] = (0.05, 0.10, 0.20), by: Sequence[str] = (),
             tie: str = "id") -> DataFrame:
    """Precision, recall and lift among the ceil(f * n) highest scores, ties in the order of the id.

    Whole score cells above the cut are added up from the cumulative table. Only rows that share the score at
    the cut are ordered by id, again in ranges, since one score may hold much of the table.
    """
    if not fractions or any(not 0 < f <= 1 for f in fractions):
        raise ValueError("Capacity fractions must lie in (0, 1].")
    by = list(by)
    keys = [*by, "capacity_fraction"]
    scored = refusing(scored)
    curve = score_curve(scored, by)
    total = F.col("n_p") + F.col("n_n")
    size = F.ceil(F.col("capacity_fraction") * total).cast("long")
    asked = curve.withColumn("capacity_fraction", F.explode(F.array(*[F.lit(float(f)) for f in fractions])))
    at_cut = asked.where((F.col("tp") + F.col("fp") >= size)
                         & (F.col("tp") - F.col("n_pos") + F.col("fp") - F.col("n_neg") < size))
    cut = local_if_small(at_cut.select(*keys, "p", size.alias("selected_count"), "n_p", total.alias("n"),
                        (F.col("tp") - F.col("n_pos")).alias("tp_above"), "n_pos",
                        (size - (F.col("tp") - F.col("n_pos") + F.col("fp") - F.col("n_neg"))).alias("wanted"),
                        (F.col("n_pos") + F.col("n_neg")).alias("tied")))
    tied = same_keys(scored.select(*by, "p", "y", F.col(tie).alias("tie"), F.lit(1).alias("one")),
                     cut.where(F.col("wanted") < F.col("tied")).select(*keys, "p", "wanted"), [*by, "p"])
    ordered = running_totals(tied, keys, "tie", ["one", "y"], split_points(tied, "tie"))
    inside = ordered.where(F.col("run_one") <= F.col("wanted")).groupBy(*keys).agg(F.sum("y").alias("tp_tied"))
    found = same_keys(cut, inside, keys, "left")
    hits = (F.col("tp_above") + F.coalesce(F.col("tp_tied"),
                                           F.when(F.col("wanted") == F.col("tied"), F.col("n_pos")), F.lit(0))).cast("long")
    counted = found.select(*keys, "selected_count", F.col("n_p").alias("positive_count"), hits.alias("true_positives"), "n")
    precision = ratio("true_positives", "selected_count")
    return counted.select(*keys, "selected_count", "positive_count", "true_positives", precision.alias("precision"),
                          ratio("true_positives", "positive_count").alias("recall"),
                          F.try_divide(precision, ratio("positive_count", "n")).alias("lift"))


def roc_curve(scored: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """One point per distinct score; the origin is added with a null threshold."""
    curve = score_curve(scored, by)
    points = curve.select(*by, F.col("p").alias("threshold"), ratio("fp", "n_n").alias("false_positive_rate"),
                          ratio("tp", "n_p").alias("true_positive_rate"))
    origin = scored.groupBy(*by).agg(F.count(F.lit(1)).alias("n")).select(
        *by, F.lit(None).cast("double").alias("threshold"), F.lit(0.0).alias("false_positive_rate"),
        F.lit(0.0).alias("true_positive_rate"))
    return points.unionByName(origin)


def pr_curve(scored: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Precision and recall at every distinct score, the end point (recall 0, precision 1), and the prevalence."""
    curve = score_curve(scored, by)
    points = curve.select(*by, F.col("p").alias("threshold"), ratio("tp", F.col("tp") + F.col("fp")).alias("precision"),
                          ratio("tp", "n_p").alias("recall"), ratio("n_p", F.col("n_p") + F.col("n_n")).alias("prevalence"))
    end = scored.groupBy(*by).agg(F.avg("y").alias("prevalence")).select(
        *by, F.lit(None).cast("double").alias("threshold"), F.lit(1.0).alias("precision"), F.lit(0.0).alias("recall"),
        "prevalence")
    return points.unionByName(end)


def subgroups(scored: DataFrame, attributes: Sequence[str], threshold: float) -> DataFrame:
    """Rates per value of every attribute in one grouping; null where a group has no row of the needed class."""
    check_threshold(threshold)
    flagged = F.col("p") >= threshold
    long = refusing(scored).select("y", flagged.alias("flagged"), *[F.col(a).cast("string").alias(a) for a in attributes]) \
                 .unpivot(["y", "flagged"], list(attributes), "attribute", "group").where(F.col("group").isNotNull())
    positive, hit = F.col("y") == 1, F.col("flagged")
    counts = long.groupBy("attribute", "group").agg(
        F.count(F.lit(1)).alias("n"), count_where(positive).alias("positive_count"),
        count_where(positive & hit).alias("tp"), count_where(~positive & hit).alias("fp"))
    return counts.select("attribute", "group", "n", "positive_count", ratio("tp", "positive_count").alias("recall"),
                         ratio("fp", F.col("n") - F.col("positive_count")).alias("false_positive_rate"),
                         ratio(F.col("tp") + F.col("fp"), "n").alias("selection_rate"),
                         ratio_or_zero("tp", F.col("tp") + F.col("fp")).alias("precision"))


def fold_metrics(scored: DataFrame, by: Sequence[str] = ("model", "fold"), threshold: float = DEFAULT_THRESHOLD) -> DataFrame:
    return evaluate(scored, threshold, by).select(*by, *FOLD_METRICS)


def fold_summary(folds: DataFrame, by: Sequence[str] = ("model",), metrics: Sequence[str] = tuple(FOLD_METRICS)) -> DataFrame:
    """Mean and population SD of every metric over the folds, one row per (group, metric)."""
    long = folds.select(*by, *[F.col(m).cast("double").alias(m) for m in metrics]).unpivot(
        list(by), list(metrics), "metric", "value")
    return long.groupBy(*by, "metric").agg(F.avg("value").alias("mean"), F.stddev_pop("value").alias("std"))

