"""Rows of one task dealt out, AP by packed ranges, curvatures that models share."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from binoscope.operators import metrics, models, newton
from binoscope.session import held

FEATURES = models.Features(("a", "b"), ("c",))


def _rows(spark, n):
    share = (F.pmod(F.xxhash64("id"), F.lit(1000)) / 1000.0)
    table = spark.range(n, numPartitions=1).select("id", share.alias("a"), F.pmod(F.xxhash64("id", F.lit(3)), F.lit(17)).cast("double").alias("b"),
                                                   F.when(F.col("id") % 2 == 0, "p").otherwise("q").alias("c"), (F.pmod("id", F.lit(5))).alias("fold"))
    return table.withColumn("y", (F.pmod(F.xxhash64("id", F.lit(5)), F.lit(1000)) / 1000.0 < F.col("a")).cast("int"))


def test_rows_of_one_task_are_dealt_out(spark):
    table = _rows(spark, 90_000)
    kept = held(table)
    sizes = [r["n"] for r in kept.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n")).collect()]
    assert len(sizes) >= 4 and max(sizes) < 45_000
    assert kept.exceptAll(table).count() == 0 and kept.count() == 90_000
    kept.unpersist()
    few = held(_rows(spark, 500))
    assert few.rdd.getNumPartitions() == 1
    few.unpersist()


def _ap(rows):
    groups = {}
    for model, p, y in rows:
        groups.setdefault(model, {}).setdefault("null" if p is None else "nan" if math.isnan(p) else p + 0.0, []).append(y)
    found = {}
    for model, cells in groups.items():
        order = sorted(cells, key=lambda p: (p == "null", p != "nan", -p if isinstance(p, float) else 0))
        tp = fp = total = 0
        for p in order:
            pos, neg = cells[p].count(1), cells[p].count(0)
            tp, fp = tp + pos, fp + neg
            total += pos * tp / (tp + fp) if tp + fp else 0
        found[model] = total / tp if tp and fp else None
    return found


def test_packed_scores_have_the_ap_of_their_curve(spark, monkeypatch):
    rng = np.random.default_rng(4)
    rows = [(m, float(round(p, 2)), int(y)) for m in ("m", "n") for p, y in zip(rng.random(300), rng.integers(0, 2, 300))]
    rows += [("m", float("nan"), 1), ("m", -0.0, 1), ("m", 0.0, 0), ("m", None, 1), ("n", 0.5, None), ("one class", 0.3, 1), (None, 0.1, 1), (None, 0.2, 0)]
    table = spark.createDataFrame(rows, "model string, p double, y int").repartition(3)
    want = _ap(rows)
    monkeypatch.setattr(metrics, "rows_per_bucket", lambda _: 10)
    monkeypatch.setattr(metrics, "SCORES_PER_RANGE", 100)
    monkeypatch.setattr(metrics, "SCORES_AT_ONCE", 50)
    found = {r["model"]: r["pr_auc"] for r in metrics.average_precision(table, ["model"]).collect()}
    assert found.keys() == want.keys()
    for model, ap in want.items():
        assert found[model] == (None if ap is None else pytest.approx(ap, abs=1e-12))


def test_a_search_adds_up_one_curvature_for_each_weighting(spark, monkeypatch):
    asked, plain = [], newton._sums

    def counting(rows, design, members, weights, raw, leaders):
        asked.append((len(raw), len(leaders)))
        return plain(rows, design, members, weights, raw, leaders)
    monkeypatch.setattr(newton, "_sums", counting)
    plans = [models.logistic(C=c, balanced=b, name=f"{c}{b}") for c in (0.05, 0.5, 5.0) for b in (False, True)]
    scores = models.oof_scores(_rows(spark, 4_000), plans, FEATURES)
    assert scores.count() == 6 * 4_000 and asked[0] == (30, 2)
    assert sum(leaders for _, leaders in asked) < sum(models for models, _ in asked) / 4


def test_the_penalised_tree_reads_its_rows_once(spark, monkeypatch):
    from binoscope.operators import boost
    from binoscope.plans import catalog_scores

    seen, plain = [], boost.fit_boosters
    rows = spark.range(400).select("id", (F.col("id") % 2).cast("int").alias("y"), *[(F.col("id") % k).cast("double").alias(c) for k, c in zip((7, 11, 13, 5), FEATURE_NUMBERS)],
                                   *[F.when(F.col("id") % 3 == 0, "u").otherwise("v").alias(c) for c in ("priority", "segment", "region")])

    def noting(train, *args, **named):
        seen.append(train.storageLevel.useMemory)
        return plain(train, *args, **named)
    monkeypatch.setattr(boost, "fit_boosters", noting)
    monkeypatch.setattr(catalog_scores, "_parts", lambda *_: (rows.where("id % 4 > 0"), rows.where("id % 4 = 0")))
    assert catalog_scores.penalised_tree(spark, "").count() == 100 and seen == [True]


FEATURE_NUMBERS = ("totalprice", "acctbal", "order_year", "order_month")


def test_leaves_that_wait_are_counted_together(monkeypatch):
    """Sums by hand, and as many counting calls for four leaves as for one."""
    from binoscope.operators import boost

    rng = np.random.default_rng(1)
    layout = boost.Layout(["a", "b"], ["c"], {"a": [0.1, 0.2, 0.3], "b": [1.0]}, {"c": ["p", "q"]})
    size = layout.sizes()
    codes, y, folds = np.stack([rng.integers(0, n, 200) for n in size]).astype(np.uint16), rng.integers(0, 2, 200).astype(np.uint8), rng.integers(0, 3, 200).astype(np.int32)
    view = boost.View([[0, 1, 2], [0], [0, 1]], [0, 0, 0], 0.2, (1.0, 2.0), 1, 0.0, 2)
    tree = boost.Tree({0: (0, np.arange(size[0]) < 2, 1, 2), 1: (1, np.arange(size[1]) < 1, 3, 4), 2: (2, np.arange(size[2]) < 1, 5, 6)})

    class Rows:
        def mapPartitions(self, add):
            return dict(add(iter([(codes, y, folds, np.zeros((1, 200)))])))
    calls, plain = [], np.bincount
    monkeypatch.setattr(np, "bincount", lambda *a, **k: (calls.append(1), plain(*a, **k))[1])
    one = boost._histograms(Rows(), layout, [view], {0: (tree, [5])})
    asked, calls[:] = len(calls), []
    four = boost._histograms(Rows(), layout, [view], {0: (tree, [3, 4, 5, 6])})
    assert len(calls) == asked and (one[0, 5] == four[0, 5]).all()
    at, weight, p = tree.nodes(codes), np.where(y == 1, 2.0, 1.0), 1 / (1 + np.exp(-0.2))
    for leaf in (3, 4, 5, 6):
        rows = np.flatnonzero((at == leaf) & (folds != 2))
        want = np.zeros((3, sum(size)))
        for k, start in enumerate(np.cumsum([0, *size[:-1]])):
            for r in rows:
                want[:, start + codes[k, r]] += ((p - y[r]) * weight[r], p * (1 - p) * weight[r], 1)
        assert np.allclose(four[0, leaf], want)


def test_a_procedure_measures_its_candidates_once(spark, monkeypatch):
    """What the choice reads is a local table, not the metrics of all candidates again."""
    from binoscope.operators import experiments, selection

    seen, plain = [], experiments.select_model
    monkeypatch.setattr(experiments, "select_model", lambda means, *a, **k: (seen.append(means._jdf.queryExecution().optimizedPlan().toString()), plain(means, *a, **k))[1])
    table = _rows(spark, 2_000).drop("fold")
    choice = selection.run_procedure(table, [models.prior(), models.logistic(), models.logistic(balanced=True)], FEATURES, tuned=True)
    assert choice.plan.family == "logistic_regression" and 0 < choice.threshold < 1
    assert "Aggregate" not in seen[0] and "Window" not in seen[0], seen[0]
