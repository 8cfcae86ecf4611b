"""Choices and comparisons over fold, seed and trial tables; every table here is O(models x folds x trials)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from binoscope.functions.scalars import count_where, same_keys
from binoscope.operators.metrics import FOLD_METRICS, fold_metrics, fold_summary, select_threshold, threshold_table

# Fixed values of the selection rules.
SIMPLER_MODELS, BASELINE_MODEL, TOLERANCE = ("logistic_regression", "logistic_balanced"), "dummy", 0.01
ADOPT_GAIN, ADOPT_FOLDS = 0.01, 4
SCORE_DIGITS = 10


def select_model(summary: DataFrame, prefer: Sequence[str] = SIMPLER_MODELS, tolerance: float = TOLERANCE,
                 baseline: str = BASELINE_MODEL, by: Sequence[str] = (), score: str = "mean") -> DataFrame:
    """The first preferred model within `tolerance` of the best mean AP, else the best one; the baseline never wins.

    Equal best means go to the earlier `position` if the summary has one, else to the smaller name.
    """
    order = F.col("position") if "position" in summary.columns else F.col("model")
    eligible = summary.where(F.col("model") != baseline)
    best = eligible.groupBy(*by).agg(
        F.max(score).alias("best_score"),
        F.min(F.struct((-F.col(score)).alias("k"), order.alias("o"), "model")).alias("best"),
        F.map_from_entries(F.collect_list(F.struct("model", score))).alias("scores"))
    reach = [(F.col("best_score") - F.try_element_at("scores", F.lit(m)) <= tolerance, m) for m in prefer]
    chosen = F.coalesce(*[F.when(near, F.lit(m)) for near, m in reach], F.col("best.model"))
    return best.select(*by, F.col("best.model").alias("best_model"), "best_score", chosen.alias("selected_model"),
                       F.try_element_at("scores", chosen).alias("selected_score"))


def ablation(folds: DataFrame, base: str, variants: Sequence[str], metric: str = "pr_auc") -> DataFrame:
    """AP change of each variant against the base on the same folds, with the adoption rule for added columns."""
    reference = folds.where(F.col("model") == base).select("fold", F.col(metric).alias("base"))
    paired = folds.where(F.col("model").isin(*variants)).join(reference, "fold")
    change = F.col(metric) - F.col("base")
    deltas = paired.groupBy("model").agg(F.avg(change).alias("cv_ap_change"), count_where(change > 0).alias("folds_improved"))
    return deltas.withColumn("meets_adoption_rule", (F.col("cv_ap_change") >= ADOPT_GAIN) & (F.col("folds_improved") >= ADOPT_FOLDS))


def seed_choices(scored: DataFrame, prefer: Sequence[str] = SIMPLER_MODELS, tolerance: float = TOLERANCE,
                 baseline: str = BASELINE_MODEL) -> DataFrame:
    """Per seed the chosen model, its CV AP and its threshold; input scored(id, y, p, model, fold, seed)."""
    folds = fold_metrics(scored, ["seed", "model", "fold"])
    means = fold_summary(folds, ["seed", "model"], ["pr_auc"]).select("seed", "model", "mean")
    chosen = select_model(means, prefer, tolerance, baseline, ["seed"])
    thresholds = select_threshold(threshold_table(scored, by=["seed", "model"]), ["seed", "model"])
    return chosen.join(thresholds.withColumnRenamed("model", "selected_model"), ["seed", "selected_model"]).select(
        "seed", "selected_model", "threshold", F.col("selected_score").alias("selected_cv_ap"))


def seed_models(scored: DataFrame) -> DataFrame:
    """(seed, model, mean_ap, std_ap): every candidate's fold APs per seed; input scored(id, y, p, model, fold, seed)."""
    summary = fold_summary(fold_metrics(scored, ["seed", "model", "fold"]), ["seed", "model"], ["pr_auc"])
    return summary.select("seed", "model", F.col("mean").alias("mean_ap"), F.col("std").alias("std_ap"))


def stability_summary(choices: DataFrame) -> DataFrame:
    """How often each model was chosen, and the spread of the thresholds."""
    counts = choices.groupBy("selected_model").agg(F.count(F.lit(1)).alias("n"))
    packed = counts.agg(F.array_sort(F.collect_list(F.struct("selected_model", "n"))).alias("c"))
    spread = choices.agg(F.min("threshold").alias("threshold_min"), F.max("threshold").alias("threshold_max"),
                         F.stddev_pop("threshold").alias("threshold_std"))
    text = F.array_join(F.transform("c", lambda x: F.concat(x["selected_model"], F.lit(":"), x["n"].cast("string"))), ",")
    # Single rows on both sides.
    return spread.join(F.broadcast(packed), F.lit(True)).select(text.alias("selection_counts"), "threshold_min", "threshold_max", "threshold_std")


def tune(trials: DataFrame, by: Sequence[str] = ("model",), score: str = "mean_ap", position: str = "position") -> DataFrame:
    """Best grid entry per group by the mean AP rounded to ten digits; ties keep the earlier entry."""
    rounded = trials.withColumn("__s", F.round(score, SCORE_DIGITS))
    best = F.min(F.struct((-F.col("__s")).alias("k"), F.col(position).alias("position"), F.col("parameters").alias("parameters")))
    return rounded.groupBy(*by).agg(best.alias("best")).select(
        *by, (-F.col("best.k")).alias("best_score"), F.col("best.position").alias("position"), F.col("best.parameters").alias("parameters"))


def nested_summary(folds: DataFrame, metrics: Sequence[str] = tuple(FOLD_METRICS)) -> DataFrame:
    """Per procedure: mean and population SD of every metric, selection counts, threshold range."""
    wide = folds.groupBy("procedure").agg(
        *[stat for m in metrics for stat in (F.avg(m).alias(f"{m}_mean"), F.stddev_pop(m).alias(f"{m}_std"))],
        F.min("threshold").alias("threshold_min"), F.max("threshold").alias("threshold_max"))
    counts = folds.groupBy("procedure", "selected_model").agg(F.count(F.lit(1)).alias("n")).groupBy("procedure").agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("selected_model", "n")))).alias("selection_counts"))
    return wide.join(counts, "procedure")


def best_trial(trials: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The completed trial with the highest value, the earliest on a tie; failed and non-finite ones never win.

    Mean and population SD of its fold scores are recomputed from the array.
    """
    size = F.size("fold_scores")
    mean = F.aggregate("fold_scores", F.lit(0.0), lambda a, x: a + x) / size
    usable = trials.where((F.col("state") == "COMPLETE") & F.col("value").isNotNull() & ~F.isnan("value")
                          & (F.abs("value") != F.lit(float("inf"))))
    described = usable.withColumn("mean_ap", mean).withColumn("std_ap", F.sqrt(F.aggregate(
        F.transform("fold_scores", lambda x: (x - F.col("mean_ap")) * (x - F.col("mean_ap"))), F.lit(0.0), lambda a, x: a + x) / size))
    # Parameters may be a map, which has no order: only value and number decide.
    best = F.min_by(F.struct("number", "model", "parameters", "value", F.round("mean_ap", SCORE_DIGITS).alias("mean_ap"),
                             F.round("std_ap", SCORE_DIGITS).alias("std_ap")), F.struct((-F.col("value")).alias("k"), F.col("number").alias("number")))
    return described.groupBy(*by).agg(best.alias("b")).where(F.col("b").isNotNull()).select(
        *by, *[F.col(f"b.{c}").alias(c) for c in ("number", "model", "parameters", "value", "mean_ap", "std_ap")])


def search_status(trials: DataFrame) -> DataFrame:
    """(completed, total, status) of one search."""
    return trials.agg(count_where(F.col("state") == "COMPLETE").alias("completed"), F.count(F.lit(1)).alias("total")).withColumn(
        "status", F.when(F.col("completed") > 0, "complete").otherwise("no_successful_trials"))


def _paired(folds: DataFrame, first: str, second: str, metrics: Sequence[str]) -> DataFrame:
    long = folds.where(F.col("procedure").isin(first, second)).select(
        "procedure", "outer_fold", *[F.col(m).cast("double").alias(m) for m in metrics]).unpivot(
        ["procedure", "outer_fold"], list(metrics), "metric", "value")

    def side(name: str) -> Column:
        return F.max(F.when(F.col("procedure") == name, F.col("value")))
    return long.groupBy("metric", "outer_fold").agg((side(first) - side(second)).alias("d"))


def paired_differences(folds: DataFrame, first: str, second: str, metrics: Sequence[str] = tuple(FOLD_METRICS)) -> DataFrame:
    """Per metric, how the folds' differences (first arm less second arm) spread, and in how many folds either arm is ahead."""
    return _paired(folds, first, second, metrics).groupBy("metric").agg(
        F.avg("d").alias("mean"), F.stddev_pop("d").alias("std"), F.min("d").alias("min"), F.max("d").alias("max"),
        count_where(F.col("d") > 0).alias("first_higher_folds"), count_where(F.col("d") < 0).alias("second_higher_folds"))


def selection_optimism(folds: DataFrame, procedure: str) -> DataFrame:
    """Mean inner AP of the chosen trials, mean outer AP, and their gap: what choosing by the inner score promises too much."""
    means = folds.where(F.col("procedure") == procedure).agg(F.avg("inner_cv_ap").alias("mean_inner_best_trial_cv_ap"),
                                                             F.avg("pr_auc").alias("mean_outer_ap"))
    return means.withColumn("difference", F.col("mean_inner_best_trial_cv_ap") - F.col("mean_outer_ap"))


def compare_procedures(folds: DataFrame, arms: Sequence[str], metrics: Sequence[str] = tuple(FOLD_METRICS)) -> DataFrame:
    """One wide row per metric: mean and SD of every arm and the mean paired difference of every pair."""
    long = folds.where(F.col("procedure").isin(*arms)).select(
        "procedure", "outer_fold", *[F.col(m).cast("double").alias(m) for m in metrics]).unpivot(
        ["procedure", "outer_fold"], list(metrics), "metric", "value")
    # The arms become columns of a (metric, fold) row; every mean and difference then comes from one more grouping.
    sides = long.groupBy("metric", "outer_fold").agg(*[F.max(F.when(F.col("procedure") == a, F.col("value"))).alias(f"__{i}")
                                                       for i, a in enumerate(arms)])
    stats = [f(f"__{i}").alias(f"{a}_{s}") for i, a in enumerate(arms) for s, f in (("mean", F.avg), ("std", F.stddev_pop))]
    pairs = [F.avg(F.col(f"__{i}") - F.col(f"__{j}")).alias(f"{a}_minus_{b}") for i, a in enumerate(arms) for j, b in enumerate(arms) if i < j]
    return sides.groupBy("metric").agg(*stats, *pairs)


def trial_rows(searches: DataFrame) -> DataFrame:
    """Searches with a nested trial list to one row per trial, ordered by fold, arm and number."""
    flat = searches.select("outer_fold", "arm", F.explode("trials").alias("t")).select("outer_fold", "arm", "t.*")
    return flat.orderBy("outer_fold", "arm", "number")
