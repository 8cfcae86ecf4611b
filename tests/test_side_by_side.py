"""Boosted models over few rows, all rounds of one in a task: against common passes, and without jobs for each round."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from binoscope.operators import boost, models, split

FEATURES = models.Features(("a", "b"), ("c", "d"))


@pytest.fixture(scope="module")
def rows(spark):
    """Numbers and categories with gaps, rows that come twice, a label with a signal."""
    def share(salt):
        return F.pmod(F.xxhash64("id", F.lit(salt)), F.lit(997)) / 997.0
    base = spark.range(700).select("id", F.when(F.col("id") % 11 != 0, F.round(share(1) * 90)).alias("a"), F.round(share(2) * 7).alias("b"),
                                   F.when(F.col("id") % 13 != 0, F.element_at(F.array(*map(F.lit, "pqr")), (F.col("id") % 3 + 1).cast("int"))).alias("c"),
                                   F.when(F.col("id") % 2 == 0, "u").otherwise("v").alias("d"))
    base = base.withColumn("y", (share(3) < F.coalesce(F.col("a"), F.lit(40.0)) / 100 + F.when(F.col("c") == "q", 0.3).otherwise(-0.1)).cast("int"))
    return split.stratified_folds(base.union(base.where("id < 100")).repartition(5), k=3).persist()


def told(booster):
    return [([(n, c, goes.tolist(), a, b) for n, (c, goes, a, b) in t.splits.items()], [*t.values]) for t in booster.trees]


@pytest.mark.parametrize("plan", [models.boosting(rounds=8, rate=0.3, leaf=10), models.boosting(rounds=5, leaves=12, leaf=3, l2=1.5, balanced=True),
                                  models.boosting(rounds=3, leaf=2000)])
def test_trees_are_those_of_common_passes(spark, rows, plan):
    alone = models.fit(rows, plan, FEATURES).booster
    spark.conf.set("binoscope.rowsPerBucket", "50")
    try:
        passes = models.fit(rows, plan, FEATURES).booster
    finally:
        spark.conf.unset("binoscope.rowsPerBucket")
    assert told(alone) == told(passes) and len(alone.trees) == plan.params["rounds"]
    assert all(np.allclose([*a.values.values()], [*b.values.values()], atol=1e-9) for a, b in zip(alone.trees, passes.trees))


def test_out_of_fold_scores_are_those_of_common_passes(spark, rows):
    plans = [models.boosting(rounds=4, name="one"), models.boosting(rounds=7, leaves=3, leaf=5, balanced=True, name="two")]
    alone = models.oof_scores(rows, plans, FEATURES).groupBy("model", "id").agg(F.max("p").alias("p")).toPandas().set_index(["model", "id"]).p
    spark.conf.set("binoscope.rowsPerBucket", "50")
    try:
        passes = models.oof_scores(rows, plans, FEATURES).groupBy("model", "id").agg(F.max("p").alias("p")).toPandas().set_index(["model", "id"]).p
    finally:
        spark.conf.unset("binoscope.rowsPerBucket")
    assert len(alone) == 1400 and (alone - passes).abs().max() < 1e-9


def test_few_rows_need_no_jobs_for_each_round(spark, rows):
    def jobs(rounds):
        group = f"rounds-{rounds}"
        spark.sparkContext.setJobGroup(group, group)
        try:
            models.fit(rows, models.boosting(rounds=rounds), FEATURES)
        finally:
            spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    assert 0 < jobs(12) == jobs(2)


def test_histograms_of_joint_columns_add_up():
    """Columns of few bins in one cell, wide ones alone: each column's sums are its own."""
    rng = np.random.default_rng(1)
    layout = boost.Layout(["a", "b"], ["c", "d"], {"a": [float(k) for k in range(300)], "b": [1.0, 2.0]}, {"c": [*"pqr"], "d": [*"uv"]})
    codes = np.stack([rng.integers(0, n, 500) for n in layout.sizes()]).astype(np.uint16)
    g, h, rows = rng.normal(size=500), rng.random(500), np.arange(0, 500, 3)
    counter = boost.Counter(codes, layout)
    assert counter.groups == [[0], [1, 2, 3]]
    for own in (None, rows):
        picked = np.arange(500) if own is None else own
        want = np.concatenate([[np.bincount(codes[k, picked], w, n) for w in (g[picked], h[picked], np.ones(len(picked)))]
                               for k, n in enumerate(layout.sizes())], axis=1)
        assert np.allclose(counter.sums(own, g, h), want)
