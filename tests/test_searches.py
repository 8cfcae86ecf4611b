"""Searches: together or one by one, resumed from a journal, complete and incomplete results, per-seed tables."""

import pytest
from pyspark.sql import functions as F

from binoscope.operators import experiments, models, selection

FEATURES = models.Features(("a",), ("c",))
SPACE = {"logistic_regression": selection.SPACE["logistic_regression"]}


@pytest.fixture(scope="module")
def rows(spark):
    base = spark.range(240).select("id", (F.pmod(F.xxhash64("id"), F.lit(100)) / 10.0).alias("a"),
                                   F.element_at(F.array(F.lit("x"), F.lit("y")), (F.col("id") % 2 + 1).cast("int")).alias("c"))
    return base.withColumn("y", (F.col("a") + F.pmod(F.xxhash64("id", F.lit(3)), F.lit(8)) > 8).cast("int")).coalesce(2).persist()


def told(records):
    return [{k: v for k, v in r.items() if k != "elapsed_seconds"} for r in records]


def test_trials_together_are_those_one_by_one(rows):
    one = selection.search(rows, FEATURES, n_trials=3, folds=2, space=SPACE, together=1)
    assert told(selection.search(rows, FEATURES, n_trials=3, folds=2, space=SPACE, together=3)) == told(one)
    assert all(r["estimator_class"] and set(r["parameters"]) < set(r["estimator_params"]) | {"balanced"} for r in one)


def test_search_goes_on_behind_its_journal(rows, tmp_path, monkeypatch):
    """Killed after trial 3 of 5, it goes on with the fourth and ends with the same table."""
    want = selection.search(rows, FEATURES, n_trials=5, folds=2, space=SPACE)
    tried, real = [], selection.oof_scores

    def dying(folded, plans, *rest):
        if len(tried) == 3:
            raise KeyboardInterrupt
        tried.extend(p.name for p in plans)
        return real(folded, plans, *rest)
    monkeypatch.setattr(selection, "oof_scores", dying)
    settings = {"n_trials": 5, "folds": 2, "space": SPACE, "journal": str(tmp_path), "together": 1}
    with pytest.raises(KeyboardInterrupt):
        selection.search(rows, FEATURES, **settings)
    monkeypatch.setattr(selection, "oof_scores", lambda folded, plans, *rest: tried.extend(p.name for p in plans) or real(folded, plans, *rest))
    assert told(selection.search(rows, FEATURES, **settings)) == told(want)
    assert tried == ["0", "1", "2", "3", "4"]
    # Other settings have a journal of their own.
    assert len(selection.search(rows, FEATURES, **{**settings, "n_trials": 1, "seed": 7})) == 1 and len(tried) == 6


def test_one_failing_trial_leaves_the_others(rows, monkeypatch):
    real = selection.oof_scores

    def failing(folded, plans, *rest):
        if any(p.name == "1" for p in plans):
            raise ValueError("no")
        return real(folded, plans, *rest)
    monkeypatch.setattr(selection, "oof_scores", failing)
    records = selection.search(rows, FEATURES, n_trials=3, folds=2, space=SPACE)
    assert [r["state"] for r in records] == ["COMPLETE", "FAIL", "COMPLETE"] and records[1]["failure"] == {"type": "ValueError", "message": "no"}


def test_search_report_names_the_best_and_the_reference(rows):
    report = selection.search_report(rows, FEATURES, folds=2, n_trials=2, space=SPACE)
    assert report.status.first().status == "complete"
    best, trials = report.best.first(), report.trials.collect()
    assert best.value == max(r.value for r in trials) and best.estimator_class.endswith("LogisticRegressionModel") and "C" in best.estimator_params
    assert 0 < report.reference.first()["mean"] < best.value


def test_nested_evaluation_without_a_success_is_incomplete(rows):
    plans = [models.prior(), models.logistic()]
    broken = selection.nested_evaluation(rows, plans, models.Features((), ()), n_trials=1, outer=2, inner=2, space=SPACE)
    assert broken.status == "incomplete" and broken.failure["outer_fold"] == 0 and broken.failure["message"]
    assert broken.folds.count() == 0 and broken.comparison is None and broken.searches[0]["trials"][0]["state"] == "FAIL"
    whole = selection.nested_evaluation(rows, plans, FEATURES, n_trials=2, outer=2, inner=2, space=SPACE)
    assert whole.status == "complete" and whole.folds.count() == 4 and whole.comparison.count() == 5
    assert {r.procedure for r in whole.procedures.collect()} == {"search", "baseline_fixed"} and whole.optimism.count() == 1


def test_every_candidate_of_every_seed_is_listed(scored_of):
    y, p = [0, 1] * 8, [0.1, 0.9, 0.4, 0.6, 0.7, 0.3, 0.2, 0.8] * 2
    scored = scored_of(y, p, model=["m"] * 16).withColumn("fold", F.floor((F.col("id") - 1) / 8).cast("long"))
    both = scored.withColumn("seed", F.lit(1)).unionByName(scored.withColumn("seed", F.lit(2)))
    assert [(r.seed, r.model, r.std_ap) for r in experiments.seed_models(both).orderBy("seed").collect()] == [(1, "m", 0.0), (2, "m", 0.0)]
