"""Experiments, explanations, drift, integrity, models and whole runs."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from binoscope.operators import checks, drift, experiments, explain, integrity, metrics, models, selection, split
from binoscope.plans import bindings as B
from binoscope.plans import runs
from binoscope.spec import TableSpec
from binoscope.streaming import monitor

FEATURES = models.Features(tuple(B.NUMERIC), tuple(B.CATEGORICAL))


# ---- experiments

def means(spark, **scores):
    return spark.createDataFrame(list(scores.items()), "model string, mean double")


@pytest.mark.parametrize("scores, selected", [
    ({"logistic_regression": 0.60, "logistic_balanced": 0.50, "random_forest": 0.605}, "logistic_regression"),
    ({"logistic_regression": 0.50, "logistic_balanced": 0.60, "random_forest": 0.605}, "logistic_balanced"),
    ({"logistic_regression": 0.50, "logistic_balanced": 0.50, "random_forest": 0.60, "dummy": 0.9}, "random_forest")])
def test_simpler_models_win_within_the_tolerance(spark, scores, selected):
    assert experiments.select_model(means(spark, **scores)).first().selected_model == selected


def test_grid_ties_keep_the_earlier_entry(spark):
    trials = spark.createDataFrame([("m", 1, "b", 0.5), ("m", 0, "a", 0.5 + 1e-12), ("m", 2, "c", 0.4)],
                                   "model string, position long, parameters string, mean_ap double")
    assert experiments.tune(trials).first().parameters == "a"


def test_best_trial_skips_failures_and_non_finite_values(spark):
    trials = spark.createDataFrame([(0, "FAIL", "x", "p", 0.9, [0.9]), (1, "COMPLETE", "x", "p", float("nan"), [0.1]), (2, "COMPLETE", "x", "p", 0.4, [0.3, 0.5]),
                                    (3, "COMPLETE", "x", "p", 0.4, [0.4, 0.4])], "number long, state string, model string, parameters string, value double, fold_scores array<double>")
    row = experiments.best_trial(trials).first()
    assert row.number == 2 and math.isclose(row.std_ap, 0.1)
    assert experiments.best_trial(trials.where("number < 2")).count() == 0
    assert experiments.search_status(trials.where("number = 0")).first().status == "no_successful_trials"


def test_paired_differences_and_optimism(spark):
    rows = [("a", f, 0.5 + 0.1 * f, 0.9) for f in range(3)] + [("b", f, 0.6, 0.7) for f in range(3)]
    folds = spark.createDataFrame(rows, "procedure string, outer_fold long, pr_auc double, inner_cv_ap double")
    row = experiments.paired_differences(folds, "a", "b", ["pr_auc"]).first()
    assert math.isclose(row["mean"], 0.0, abs_tol=1e-12) and row.first_higher_folds == 1 and row.second_higher_folds == 1
    assert math.isclose(experiments.selection_optimism(folds, "a").first().difference, 0.3)


def test_random_search_is_seeded_and_stays_in_its_space():
    drawn = selection.draw_trials(60, 42)
    assert drawn == selection.draw_trials(60, 42) != selection.draw_trials(60, 43)
    assert {family for family, _ in drawn} == set(selection.SPACE)
    for family, parameters in drawn:
        assert set(parameters) == set(selection.SPACE[family])
        if family == "logistic_regression":
            assert 0.01 <= parameters["C"] <= 10
        if family == "random_forest":
            assert parameters["trees"] in range(100, 401, 50)
        assert selection.typed_parameters(family, {k: str(v) for k, v in parameters.items()}) == parameters


# ---- explanations

def test_permuted_column_is_a_permutation_and_the_others_stay(spark):
    rows = spark.range(200).select("id", (F.col("id") * 2).alias("a"), (F.col("id") * 3).alias("b"), F.lit(1).alias("y"))
    made = explain.permuted(rows, ["a", "b"], 2, 42)
    for column, other in (("a", "b"), ("b", "a")):
        part = made.where((F.col("column") == column) & (F.col("repeat") == 1)).collect()
        scale = {"a": 2, "b": 3}
        assert sorted(r[column] for r in part) == [scale[column] * i for i in range(200)]
        assert all(r[other] == scale[other] * r.id for r in part)
        assert sum(r[column] != scale[column] * r.id for r in part) > 150


def test_contributions_add_up(spark):
    rows = spark.createDataFrame([(1, 1.0, 4.0), (2, 3.0, 0.0)], "id long, a double, b double")
    coefficients = {"a": 2.0, "b": -1.0}
    listed = explain.linear_contributions(rows, coefficients, rows)
    base = explain.base_value(coefficients, 0.5, rows)
    output = rows.select("id", (F.col("a") * 2 - F.col("b") + 0.5).alias("output"))
    assert all(r.additive for r in explain.check_additive(listed, base, output).collect())
    top = explain.top_contributions(listed, k=1).orderBy("id").collect()
    assert [r.direction for r in top] == ["Lower", "Higher"] or all(math.isclose(abs(r.contribution), 2.0) for r in top)
    assert all(math.isclose(r.contribution + r.other_contribution, s) for r, s in zip(top, (-4.0, 4.0)))


def test_sigmoid_is_stable(spark):
    rows = spark.createDataFrame([(-2000.0,), (0.0,), (2000.0,)], "x double")
    assert [r[0] for r in rows.select(explain.explained_probability("x")).collect()] == [0.0, 0.5, 1.0]


# ---- drift

@pytest.mark.parametrize("shares, check", [([(0.5, 0.5), (0.5, 0.5)], lambda v: v == 0), ([(0.5, 0.6), (0.5, 0.4)], lambda v: 0 < v < 0.1),
                                           ([(0.5, 0.9), (0.5, 0.1)], lambda v: v > 0.5), ([(1.0, 0.0), (0.0, 1.0)], math.isfinite)])
def test_psi(spark, shares, check):
    assert check(drift.psi(spark.createDataFrame(shares, "expected double, actual double")).first().psi)


def test_same_rows_are_stable_and_changed_ones_shift(spark, sf_dir):
    rows = B.cls(spark, sf_dir).select("id", "totalprice", "acctbal", "segment", "priority")
    stored = drift.drift_profile(rows, ["totalprice", "acctbal"], ["segment", "priority"])
    assert all(r.status == "stable" and r.psi < 1e-9 for r in drift.drift_report(rows, stored).collect())
    moved = rows.withColumn("totalprice", F.col("totalprice") * 3).withColumn("acctbal", F.lit(None).cast("double")) \
        .withColumn("segment", F.lit("NOVEL")).withColumn("priority", F.lit("5-LOW"))
    report = drift.drift_report(moved, stored).collect()
    found = {r.feature: r for r in report}
    assert found["totalprice"].status == found["segment"].status == found["priority"].status == "shift"
    assert found["segment"].unseen_share == 1.0 and found["priority"].unseen_share == 0.0
    assert report[-1].feature == "acctbal" and report[-1].status == "no data" and report[-1].psi is None
    gate = drift.drift_gate(drift.drift_report(moved, stored), 99).first()
    assert gate.gate_failed and gate.small_sample and gate.shift == 3


def test_shares_without_values_are_null(spark):
    rows = spark.createDataFrame([(None,)], "v double")
    assert [r.share for r in drift.bin_shares(rows, "v", [1.0]).collect()] == [None, None]


# ---- integrity

def test_table_diff_tolerates_rounding_and_matches_nulls(spark):
    old = spark.createDataFrame([(1, 1.0, None), (2, 2.0, "b")], "id long, v double, s string")
    assert integrity.table_diff(old, old.withColumn("v", F.col("v") * (1 + 1e-8)), ["id"]).count() == 0
    changed = integrity.table_diff(old, old.withColumn("s", F.lit("b")), ["id"]).collect()
    assert [(r.column, r.n_rows) for r in changed] == [("s", 1)]
    assert integrity.table_diff(old, old.drop("s"), ["id"]).first().problem == "columns differ"


def test_booleans_never_equal_numbers_in_records(spark):
    old = spark.createDataFrame([(1, (True, 1.0))], "id long, r struct<a: boolean, b: double>")
    new = spark.createDataFrame([(1, (1, 1.0 + 1e-9))], "id long, r struct<a: int, b: double>")
    assert [(r.path, r.problem) for r in integrity.record_diff(old, new, "id").collect()] == [("/r/a", "type differs")]
    assert integrity.record_diff(old, new, "id", ignore=["a"]).count() == 0


def test_fingerprint_sees_every_change_but_not_the_order(spark):
    rows = spark.createDataFrame([(1, "a", 0), (2, None, 1)], "id long, v string, y int")
    base = integrity.fingerprint(rows).first()
    assert integrity.fingerprint(rows.orderBy(F.col("id").desc()).repartition(3)).first() == base
    for other in (rows.withColumn("v", F.lit("a")), rows.withColumn("y", 1 - F.col("y")), rows.withColumn("id", F.col("id") + 1),
                  rows.withColumnRenamed("v", "w"), rows.withColumn("v", F.coalesce("v", F.lit("")))):
        assert integrity.fingerprint(other).first() != base


def test_coverage(spark, sf_dir):
    folded = split.stratified_folds(B.labelled(spark, sf_dir)).select("id", "fold")
    assert tuple(integrity.coverage_check(folded, folded).first()) == (0, 0, 0, 0)


# ---- models

@pytest.fixture(scope="module")
def parts(spark, sf_dir):
    rows = B.with_score(B.cls_nulls(spark, sf_dir), "m", name="signal").drop("order_year").withColumnRenamed("signal", "order_year")
    table = split.stratified_split(rows).cache()
    return table.where("partition = 'train'").drop("partition"), table.where("partition = 'test'").drop("partition")


def test_logistic_is_the_minimum_of_the_penalised_loss(spark, parts):
    train, _ = parts
    model = models.fit(train, models.logistic(C=1.0), FEATURES)
    made = model.pipeline.transform(train).select("features", "y").collect()
    x, y = np.array([r.features.toArray() for r in made]), np.array([r.y for r in made], dtype=float)
    w, b = model.estimator.coefficients.toArray(), model.estimator.intercept
    p = 1 / (1 + np.exp(-(x @ w + b)))
    assert np.abs(x.T @ (p - y) + w).max() / len(y) < 1e-3 and abs((p - y).mean()) < 1e-3
    assert np.abs(x[:, :4].mean(axis=0)).max() < 1e-9 and np.allclose(x[:, :4].std(axis=0), 1)


def test_scoring_ignores_column_order_extras_and_accepts_new_categories(spark, parts):
    train, test = parts
    model = models.fit(train, models.logistic(), FEATURES)
    straight = {r.id: r.p for r in models.score_batch(test, model, 0.3, "r", FEATURES).collect()}
    shuffled = test.select(*reversed(test.columns)).withColumn("more", F.lit(1)).repartition(7)
    again = models.score_batch(shuffled, model, 0.3, "r", FEATURES).collect()
    assert {r.id: r.p for r in again} == straight and len(again) == test.count()
    assert all((r.predicted_class == "Yes") == (r.p >= 0.3) for r in again)
    novel = models.score_batch(test.withColumn("segment", F.lit("NEW")), model, 0.3, "r", FEATURES)
    assert novel.where("p IS NULL").count() == 0


def test_saved_model_scores_the_same(spark, parts, tmp_path):
    train, test = parts
    model = models.fit(train, models.logistic(), FEATURES)
    model.save(str(tmp_path / "m"))
    loaded = models.load_model("logistic_regression", str(tmp_path / "m"))
    assert {r.id: r.p for r in loaded.score(test).collect()} == {r.id: r.p for r in model.score(test).collect()}


def test_out_of_fold_scores_cover_each_row_once_and_never_see_their_fold(spark, parts):
    train, _ = parts
    folded = split.stratified_folds(train, k=3)
    scores = models.oof_scores(folded, [models.prior(), models.logistic()], FEATURES)
    manifest = folded.select("id", "fold")
    for name in ("dummy", "logistic_regression"):
        assert tuple(integrity.coverage_check(scores.where(F.col("model") == name), manifest, folds=3).first()) == (0, 0, 0, 0)
    altered = folded.withColumn("y", F.when(F.col("fold") == 1, 1 - F.col("y")).otherwise(F.col("y")))
    again = models.oof_scores(altered, [models.logistic()], FEATURES)

    def of_fold(table, fold):
        return {r.id: round(r.p, 9) for r in table.where((F.col("fold") == fold) & (F.col("model") == "logistic_regression")).collect()}
    assert of_fold(scores, 1) == of_fold(again, 1) and of_fold(scores, 0) != of_fold(again, 0)


def test_calibration_keeps_the_rows_and_the_range(spark, parts):
    train, test = parts
    scored = models.sigmoid_calibration(train, models.logistic(), FEATURES)(test)
    assert scored.count() == test.count() and checks.check_scored(scored).where("n_bad > 0").count() == 0


def test_search_records_failures_and_refit_checks_the_record(spark, parts):
    train, test = parts
    space = {"logistic_regression": {"C": ("log", 0.01, 10.0), "balanced": [False]}}
    records = selection.search(train, FEATURES, n_trials=1, folds=2, space=space)
    assert records[0]["state"] == "COMPLETE" and 0 < records[0]["value"] <= 1
    with pytest.raises(ValueError):
        selection.refit_trial(train, [{**records[0], "value": 0.99}], 0, FEATURES, folds=2, space=space)
    broken = selection.search(train.drop("segment"), models.Features((), ()), n_trials=1, folds=2, space=space)
    assert broken[0]["state"] == "FAIL" and broken[0]["failure"]["message"]
    assert selection.trial_table(spark, [*records, *broken]).count() == 2


# ---- whole runs

def test_training_scoring_and_drift_runs(spark, sf_dir, tmp_path):
    spec = TableSpec(key="id", label="status", bounds={"acctbal": (-1000, None), "order_month": (1, 12)},
                     categories={"segment": B.CLS_SPEC.categories["segment"]}, labels={"open": 0, "done": 1})
    raw = B.cls(spark, sf_dir).select((F.col("id") + 1).alias("id"), F.floor("acctbal").cast("double").alias("acctbal"), "order_month", "segment",
                                      F.when(F.col("y") == 1, "done").otherwise("open").alias("status"))
    plans = [models.prior(), models.logistic(), models.logistic(balanced=True)]
    result = runs.training_run(raw, spec, str(tmp_path), "run-1", plans, attributes=["segment"], seeds=(42,), folds=2, n_boot=10, repeats=1)
    assert result.selected_model == "logistic_regression" and 0 < result.threshold < 1 and result.metrics["n"] > 0
    written = {p.name for p in tmp_path.iterdir()}
    assert {"split_manifest", "cv_fold_metrics", "threshold_analysis", "holdout_bootstrap_ci", "subgroup_metrics", "drift_profile", "models"} <= written
    model = runs.load_run_model(spark, str(tmp_path), "run-1", result.selected_model)
    records = raw.drop("status")
    predictions = runs.scoring_run(records, spec, model, result.threshold, "run-1")
    assert predictions.count() == raw.count() and set(predictions.columns) == {"id", "p", "predicted_class", "decision_threshold", "run_id"}
    report, gate = runs.drift_run(records, spec, str(tmp_path), "run-1")
    assert {r.status for r in report.collect()} == {"stable"} and not gate.first().gate_failed

    records.coalesce(1).write.parquet(str(tmp_path / "arriving"))
    arriving = spark.readStream.schema(records.schema).parquet(str(tmp_path / "arriving"))
    features = models.Features(tuple(spec.numeric), tuple(spec.categorical))
    query = monitor.score_stream(arriving, model, result.threshold, "run-1", features).writeStream.format("parquet").option(
        "checkpointLocation", str(tmp_path / "c1")).trigger(availableNow=True).start(str(tmp_path / "streamed"))
    query.awaitTermination(120)
    assert spark.read.parquet(str(tmp_path / "streamed")).count() == raw.count()
    stored = spark.read.parquet(str(tmp_path / "drift_profile")).drop("run_id")
    check = monitor.drift_per_batch(arriving, stored, str(tmp_path / "reports"), str(tmp_path / "c2"))
    check.awaitTermination(120)
    assert spark.read.parquet(str(tmp_path / "reports")).where("status = 'stable'").count() == 3
