"""Evaluation operators on hand vectors."""

import math
import random

import pytest
from pyspark.sql import functions as F

from binoscope.operators import bootstrap, metrics
from binoscope.operators.split import stratified_folds
from binoscope.plans.bindings import labelled


def brute(y, p):
    """Average precision and ROC-AUC by definition."""
    pairs = list(zip(p, y))
    positives = sum(y)
    ap, last = 0.0, 0.0
    for t in sorted(set(p), reverse=True):
        above = [label for score, label in pairs if score >= t]
        recall = sum(above) / positives
        ap, last = ap + (recall - last) * sum(above) / len(above), recall
    won = sum(1.0 if a > b else 0.5 if a == b else 0.0 for a, x in pairs for b, z in pairs if x == 1 and z == 0)
    return ap, won / (positives * (len(y) - positives))


def test_known_vector(scored_of):
    row = metrics.evaluate(scored_of([0, 0, 1, 1], [0.1, 0.4, 0.3, 0.8]), 0.35).first()
    assert (row.true_negatives, row.false_positives, row.false_negatives, row.true_positives) == (1, 1, 1, 1)
    assert row.precision == row.recall == row.f1 == 0.5
    assert row.roc_auc == 0.75 and math.isclose(row.pr_auc, 5 / 6)
    assert (row.n, row.positive_count) == (4, 2)


def test_one_class_has_no_ranking_metrics(scored_of):
    row = metrics.evaluate(scored_of([0, 0, 0], [0.1, 0.2, 0.9]), 0.5).first()
    assert row.roc_auc is None and row.pr_auc is None
    assert row.precision == row.recall == row.f1 == 0.0
    assert (row.true_negatives, row.false_positives, row.false_negatives, row.true_positives) == (2, 1, 0, 0)


def test_score_equal_to_threshold_is_positive(scored_of):
    scored = scored_of([1, 0], [0.5, 0.49])
    assert [r.predicted_class for r in metrics.label_at(scored, 0.5).orderBy("id").collect()] == ["Yes", "No"]
    assert metrics.confusion(scored, 0.5).first().true_positives == 1


@pytest.mark.parametrize("threshold", [-0.1, 1.1, float("nan"), float("inf")])
def test_threshold_must_be_a_share(scored_of, threshold):
    with pytest.raises(ValueError):
        metrics.evaluate(scored_of([0, 1], [0.1, 0.2]), threshold)


def test_constant_score_has_prevalence_as_average_precision(scored_of):
    row = metrics.evaluate(scored_of([1, 0, 0, 0], [0.3] * 4), 0.5).first()
    assert row.pr_auc == 0.25 and row.roc_auc == 0.5


@pytest.mark.parametrize("rows_per_bucket", ["2000000", "40"])
def test_ties_and_groups_against_brute_force(spark, scored_of, rows_per_bucket):
    spark.conf.set("binoscope.rowsPerBucket", rows_per_bucket)
    try:
        rng = random.Random(5)
        y, p, g = [], [], []
        for i in range(900):
            y.append(rng.randint(0, 1))
            # A third of all rows share one score.
            p.append(0.4 if i % 3 == 0 else round(rng.random(), 3))
            g.append("hot" if i % 4 else None)
        found = {r.g: r for r in metrics.evaluate(scored_of(y, p, g=g), 0.5, ["g"]).collect()}
        for key in ("hot", None):
            ap, auc = brute([a for a, k in zip(y, g) if k == key], [a for a, k in zip(p, g) if k == key])
            assert math.isclose(found[key].pr_auc, ap, rel_tol=1e-12) and math.isclose(found[key].roc_auc, auc, rel_tol=1e-12)
    finally:
        spark.conf.unset("binoscope.rowsPerBucket")


def test_result_does_not_depend_on_partitions(spark, scored_of):
    rng = random.Random(7)
    scored = scored_of([rng.randint(0, 1) for _ in range(300)], [round(rng.random(), 2) for _ in range(300)])
    rows = [metrics.evaluate(scored.repartition(n), 0.5).first() for n in (1, 4, 50)]
    assert all(math.isclose(r.pr_auc, rows[0].pr_auc, rel_tol=1e-12) and r.true_positives == rows[0].true_positives for r in rows)


def test_threshold_choice_prefers_precision_then_the_higher_threshold(spark):
    table = spark.createDataFrame([(0.2, 0.6, 0.4, 0.7), (0.3, 0.6, 0.5, 0.6), (0.4, 0.6, 0.5, 0.6), (0.5, 0.2, 0.9, 0.1)],
                                  "threshold double, f2 double, precision double, recall double")
    assert metrics.chosen_threshold(table) == 0.4
    with pytest.raises(ValueError):
        metrics.chosen_threshold(table.where("threshold > 9"))


def test_f2_formula(scored_of):
    row = metrics.threshold_table(scored_of([0, 0, 1, 1], [0.1, 0.4, 0.3, 0.8]), [0.35]).first()
    assert math.isclose(row.f2, 5 * 0.5 * 0.5 / (4 * 0.5 + 0.5))


def test_reliability_keeps_empty_bins(scored_of):
    rows = metrics.reliability(scored_of([0, 1, 1], [0, 0.55, 1])).orderBy("bin").collect()
    assert len(rows) == 10 and rows[0].n == 1 and rows[9].n == 1 and rows[5].observed_rate == 1.0
    assert rows[1].n == 0 and rows[1].mean_probability is None and rows[1].observed_rate is None
    assert (rows[0].lower, rows[9].upper) == (0.0, 1.0)


def test_capacity_breaks_ties_by_id(scored_of):
    rows = metrics.capacity(scored_of([0, 1, 1, 0, 0, 0], [0.8, 0.8, 0.9, 0.2, 0.1, 0])).orderBy("capacity_fraction").collect()
    assert [r.selected_count for r in rows] == [1, 1, 2] and [r.true_positives for r in rows] == [1, 1, 1]
    assert (rows[2].precision, rows[2].recall) == (0.5, 0.5) and math.isclose(rows[2].lift, 1.5)


def test_capacity_of_one_class_and_of_bad_fractions(scored_of):
    row = metrics.capacity(scored_of([0, 0], [0.1, 0.2]), [0.5]).first()
    assert row.recall is None and row.lift is None and row.precision == 0.0
    with pytest.raises(ValueError):
        metrics.capacity(scored_of([0, 1], [0.1, 0.2]), [0.0])


def test_capacity_inside_one_hot_score(scored_of, small_ranges):
    y = [i % 2 for i in range(400)]
    row = metrics.capacity(scored_of(y, [0.5] * 400), [0.25]).first()
    assert row.selected_count == 100 and row.true_positives == sum(y[:100])


def test_subgroup_without_positives_has_no_recall(scored_of):
    rows = {r.group: r for r in metrics.subgroups(scored_of([1, 0, 0, 0], [0.9, 0.1, 0.9, 0.1], g=["a", "a", "b", "b"]), ["g"], 0.5).collect()}
    assert rows["a"].recall == 1.0 and rows["a"].false_positive_rate == 0.0
    assert rows["b"].recall is None and rows["b"].false_positive_rate == 0.5
    assert sum(r.n for r in rows.values()) == 4


def test_bootstrap_interval_encloses_the_estimate(scored_of):
    rng = random.Random(3)
    y = [rng.randint(0, 1) for _ in range(200)]
    scored = scored_of(y, [min(1.0, max(0.0, 0.3 * label + 0.7 * rng.random())) for label in y])
    for method in ("draws", "poisson"):
        rows = bootstrap.bootstrap_ci(scored, 0.5, 60, method=method).collect()
        assert len(rows) == 5 and all(r.lower <= r.estimate <= r.upper for r in rows)


def test_bootstrap_keeps_class_sizes(scored_of):
    y = [1] * 30 + [0] * 70
    draws = bootstrap.class_draws(scored_of(y, [i / 100 for i in range(100)]), 8, 42)
    sizes = {(r.replicate, r.y): r["count"] for r in draws.groupBy("replicate", "y").count().collect()}
    assert len(sizes) == 16 and all(n == (30 if y == 1 else 70) for (_, y), n in sizes.items())


def test_bootstrap_checks_its_input(scored_of):
    with pytest.raises(ValueError):
        bootstrap.bootstrap_ci(scored_of([0, 0], [0.1, 0.2]), 0.5, 5)
    with pytest.raises(ValueError):
        bootstrap.bootstrap_ci(scored_of([0, 1], [0.1, 0.2]), 0.5, 0)
    with pytest.raises(ValueError):
        bootstrap.bootstrap_ci(scored_of([0, 1], [0.1, 0.2]), 0.5, 5, confidence=1.0)


def test_subgroup_interval_of_a_missing_class_is_null(scored_of):
    rows = {r.group: r for r in bootstrap.subgroup_ci(scored_of([1, 0, 0, 0], [0.9, 0.1, 0.9, 0.1], g=["a", "a", "b", "b"]), ["g"], 0.5, 20).collect()}
    assert rows["b"].recall_lower is None and rows["b"].false_positive_rate_lower is not None
    assert 0 <= rows["b"].selection_rate_lower <= rows["b"].selection_rate_upper <= 1


def test_fold_summary_uses_the_population_deviation(spark):
    folds = spark.createDataFrame([("m", 0, 0.2), ("m", 1, 0.4)], "model string, fold long, pr_auc double")
    row = metrics.fold_summary(folds, metrics=["pr_auc"]).first()
    assert math.isclose(row["mean"], 0.3) and math.isclose(row["std"], 0.1)


def test_large_groups_are_ordered_in_ranges(scored_of, small_ranges, capsys):
    scored = scored_of([i % 2 for i in range(300)], [i / 300 for i in range(300)]).withColumn("m", F.lit("x"))
    metrics.score_curve(scored, ["m"]).explain()
    windows = [line for line in capsys.readouterr().out.splitlines() if "Window [" in line]
    assert windows and any("value_range" in line for line in windows)


def test_fold_assignment_shuffles_no_rows(spark, sf_dir, capsys):
    stratified_folds(labelled(spark, sf_dir)).explain()
    assert "Exchange" not in capsys.readouterr().out
