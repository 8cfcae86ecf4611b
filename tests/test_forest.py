"""Forests that count all trees of a level together: against trees grown by hand, in parts, saved, on odd rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from binoscope.operators import forest, models

FEATURES = models.Features(("a", "b"), ("c",))


@pytest.fixture(scope="module")
def rows(spark):
    """600 rows in one partition: numbers with gaps, a category with gaps, a label that depends on two of them."""
    def share(salt):
        return F.pmod(F.xxhash64("id", F.lit(salt)), F.lit(997)) / 997.0
    table = spark.range(600, numPartitions=1).select("id", F.when(F.col("id") % 11 != 0, F.round(share(1) * 90)).alias("a"), F.round(share(2) * 7).alias("b"),
                                                     F.when(F.col("id") % 13 != 0, F.element_at(F.array(*map(F.lit, "pqr")), (F.col("id") % 3 + 1).cast("int"))).alias("c"))
    return table.withColumn("y", (share(3) < F.coalesce(F.col("a"), F.lit(40.0)) / 100 + F.when(F.col("c") == "q", 0.3).otherwise(-0.1)).cast("int")).cache()


def _by_hand(x, y, times, cuts, weights, depth, least):
    """The share of label 1 in the leaf of each row, by trying every cut of every slot."""
    def sums(own):
        return np.array([(times * own * (y == k)).sum() for k in (0, 1)])

    def impurity(own):
        own = own * weights
        return own.sum() * (1 - ((own / own.sum()) ** 2).sum())

    def grow(own, left):
        counts, best = sums(own), (0, None)
        for slot, n in enumerate(cuts if left else []):
            for cut in range(n):
                low = own & (x[:, slot] <= cut)
                a, b = sums(low), counts - sums(low)
                if min(a.sum(), b.sum()) >= least:
                    best = max(best, (round((impurity(counts) - impurity(a) - impurity(b)) / (counts * weights).sum(), 12), (slot, cut)), key=lambda f: f[0])
        if best[1] is None or not impurity(counts):
            return {"p": counts * weights, "own": own}
        low = own & (x[:, best[1][0]] <= best[1][1])
        parts = [grow(low, left - 1), grow(own & ~low, left - 1)]
        if all("p" in part for part in parts) and len({part["p"][1] > part["p"][0] for part in parts}) == 1:
            return {"p": counts * weights, "own": own}
        return {"parts": parts}

    found = np.zeros(len(y))

    def put(node):
        if "p" in node:
            found[node["own"]] = node["p"][1] / node["p"].sum()
        for part in node.get("parts", []):
            put(part)
    put(grow(np.ones(len(y), dtype=bool), depth))
    return found


@pytest.mark.parametrize("bytes_", [forest.COUNT_BYTES, 1])
def test_trees_are_those_grown_by_hand(rows, monkeypatch, bytes_):
    monkeypatch.setattr(forest, "COUNT_BYTES", bytes_)
    data = rows.toPandas()
    model = models.fit(rows, models.forest(trees=4, depth=3, leaf=6, features="all"), FEATURES, seed=7)
    found = model.score(rows).toPandas().p.to_numpy()
    layout = model.forest.slots.layout
    mode = sorted(data.c.dropna().unique(), key=lambda v: (-(data.c == v).sum(), v))[0]
    x = [np.searchsorted(layout.edges[c], data[c].fillna(data[c].median())) for c in ("a", "b")]
    x += [(data.c.fillna(mode) != v).to_numpy().astype(int) for v in "pqr"]
    y = data.y.to_numpy()
    weights = np.array([len(y) / (2 * (y == k).sum()) for k in (0, 1)])
    expected = [_by_hand(np.stack(x, axis=1), y, forest.bag(7, tree, 0, 0, len(y)).astype(int), model.forest.slots.cuts, weights, 3, 6) for tree in range(4)]
    assert np.abs(found - np.mean(expected, axis=0)).max() < 1e-9
    assert model.feature_names == ["a", "b", "c_p", "c_q", "c_r"]


def test_a_bag_holds_as_many_rows_as_there_are(rows):
    times = forest.bag(1, 2, 3, 4, 400_000)
    shares = np.bincount(times, minlength=4)[:4] / len(times)
    assert shares == pytest.approx([0.3679, 0.3679, 0.1839, 0.0613], abs=0.004) and times.mean() == pytest.approx(1, abs=0.006)
    assert (times != forest.bag(1, 3, 3, 4, 400_000)).any()


def test_all_trees_of_a_level_are_one_job(spark, rows):
    """Before, Spark ML walked every tree for every row in several jobs a level, and boxed each step."""
    asked = []
    counted = forest._counted
    forest._counted = lambda *a: asked.append(len(a[1].value)) or counted(*a)
    try:
        model = models.fit(rows, models.forest(trees=30, depth=4), FEATURES)
    finally:
        forest._counted = counted
    assert len(asked) == 4 and asked[0] == 30
    importance = model.estimator.featureImportances.toArray()
    assert importance.sum() == pytest.approx(1) and importance.argmax() in (0, 3)


def test_a_saved_forest_scores_the_same(rows, tmp_path):
    model = models.fit(rows, models.forest(trees=5, depth=3, features="0.5", balanced=False), FEATURES)
    model.save(str(tmp_path / "m"))
    again = models.load_model("random_forest", str(tmp_path / "m"))
    assert again.score(rows).orderBy("id").collect() == model.score(rows).orderBy("id").collect()
    odd = rows.limit(3).withColumn("c", F.lit("never seen")).withColumn("a", F.lit(float("nan")))
    assert all(0 <= r.p <= 1 for r in model.score(odd).collect())


def test_labels_that_are_no_labels_are_refused(rows):
    with pytest.raises(Exception, match="0 or 1"):
        models.fit(rows.withColumn("y", F.when(F.col("id") > 5, F.col("y"))), models.forest(trees=2), FEATURES, counts={0: 300, 1: 300})


def test_strategies_are_those_of_spark_ml():
    assert [forest.features_of(s, 19) for s in ("sqrt", "all", "log2", "onethird", "0.3", "4", "40")] == [5, 19, 5, 7, 6, 4, 19]
