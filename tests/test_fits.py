"""Solvers and boosted trees: batches against single fits and brute force, few bytes against reductions, edge cases."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from binoscope.operators import boost, bootstrap, metrics, models, newton, partials, split

FEATURES = models.Features(("a", "b"), ("c",))


@pytest.fixture(scope="module")
def rows(spark):
    """Numbers with gaps, a category with gaps, a label that depends on both."""
    base = spark.range(900).select("id", (F.pmod(F.xxhash64("id"), F.lit(1000)) / 1000.0).alias("u"), (F.pmod(F.xxhash64("id", F.lit(7)), F.lit(40)) / 4.0).alias("b"),
                                   F.pmod(F.xxhash64("id", F.lit(9)), F.lit(3)).alias("k"))
    base = base.withColumn("a", F.when(F.col("id") % 11 != 0, F.round(F.col("u") * 20, 1)))
    base = base.withColumn("c", F.when(F.col("id") % 13 != 0, F.element_at(F.array(F.lit("p"), F.lit("q"), F.lit("r")), (F.col("k") + 1).cast("int"))))
    score = F.col("u") * 3 - 2 + F.when(F.col("k") == 1, 1.0).otherwise(0.0) - F.col("b") / 10
    chance = F.pmod(F.xxhash64("id", F.lit(5)), F.lit(1000)) / 1000.0
    table = base.select("id", "a", "b", "c", (chance < 1 / (1 + F.exp(-score))).cast("int").alias("y")).repartition(6)
    return split.stratified_folds(table, k=3).persist()


def arrays(rows):
    return rows.orderBy("id").toPandas()


def prepared(data, train):
    """Median, mode, scale and one-hot by hand."""
    made = [np.ones(len(data))]
    for c in ("a", "b"):
        fill = train[c].median()
        own = train[c].fillna(fill)
        made.append((data[c].fillna(fill) - own.mean()) / (own.std(ddof=0) or 1))
    mode = sorted(train.c.dropna().unique(), key=lambda v: (-(train.c == v).sum(), v))[0]
    made += [(data.c.fillna(mode) == v).astype(float) for v in sorted(train.c.dropna().unique())]
    return np.stack(made, axis=1).astype(float)


def test_regressions_of_a_batch_solve_their_own_problems(rows, monkeypatch):
    data = arrays(rows)
    plans = [models.logistic(C=0.5, name="one"), models.logistic(C=3.0, balanced=True, name="two")]
    scores = models.oof_scores(rows, plans, FEATURES).toPandas().set_index(["model", "id"]).p
    monkeypatch.setattr(partials, "FETCHED_BYTES", 0)
    monkeypatch.setattr(partials, "SUMMED_AT_ONCE", 2)
    again = models.oof_scores(rows, plans, FEATURES).toPandas().set_index(["model", "id"]).p
    assert (scores - again).abs().max() < 1e-9
    for plan in plans:
        for fold in range(3):
            train, held = data[data.fold != fold], data[data.fold == fold]
            x, y = prepared(train, train), train.y.to_numpy()
            w = np.where(y == 1, len(y) / (2 * y.sum()), len(y) / (2 * (1 - y).sum())) if plan.balanced else np.ones(len(y))
            penalty = np.array([0] + [1 / plan.params["C"]] * (x.shape[1] - 1))
            beta = np.zeros(x.shape[1])
            for _ in range(30):
                p = 1 / (1 + np.exp(-x @ beta))
                beta -= np.linalg.solve(x.T @ (x * (w * p * (1 - p))[:, None]) + np.diag(penalty), x.T @ (w * (p - y)) + penalty * beta)
            want = 1 / (1 + np.exp(-prepared(held, train) @ beta))
            assert np.abs(scores[plan.name].loc[held.id].to_numpy() - want).max() < 1e-8


def test_sigmoids_minimise_their_loss(spark):
    rng = np.random.default_rng(2)
    m = rng.normal(0, 2, 400)
    y = (rng.random(400) < 1 / (1 + np.exp(-(0.7 * m - 0.4)))).astype(int)
    table = spark.createDataFrame([(k % 2, float(a), int(b)) for k, (a, b) in enumerate(zip(m, y))], "g int, margin double, y int")
    for g, (a, b) in newton.fit_sigmoids(table, "g").items():
        own, label = m[g::2], y[g::2]
        t = np.where(label == 1, (label.sum() + 1) / (label.sum() + 2), 1 / ((1 - label).sum() + 2))
        off = 1 / (1 + np.exp(-(a * own + b))) - t
        assert abs((off * own).sum()) < 1e-7 and abs(off.sum()) < 1e-7


def brute_tree(x, names, g, h, leaves, least, l2, rate):
    """Best-first growth over all cuts between distinct values, on prepared columns."""
    parts, values = [np.arange(len(g))], {}

    def best(part):
        found = (0.0, None, None)
        G, H = g[part].sum(), h[part].sum()
        for k in range(x.shape[1]):
            for e in np.unique(x[part, k])[:-1]:
                left = part[x[part, k] <= e]
                if least <= len(left) <= len(part) - least:
                    a, b = g[left].sum(), h[left].sum()
                    gain = a * a / (b + l2) + (G - a) ** 2 / (H - b + l2) - G * G / (H + l2)
                    if gain > found[0] + 1e-9:
                        found = (gain, k, e)
        return found

    gains = [best(parts[0])]
    while len(parts) < leaves and max(f[0] for f in gains) > 0:
        i = max(range(len(parts)), key=lambda i: gains[i][0])
        (_, k, e), part = gains.pop(i), parts.pop(i)
        for own in (part[x[part, k] <= e], part[x[part, k] > e]):
            parts.append(own)
            gains.append(best(own))
    value = np.zeros(len(g))
    for part in parts:
        value[part] = -rate * g[part].sum() / (h[part].sum() + l2)
    return value, len(parts)


@pytest.mark.parametrize("leaves, l2, balanced", [(7, 0.0, False), (5, 2.0, True), (2, 0.0, False)])
def test_trees_match_brute_force(rows, leaves, l2, balanced):
    data = arrays(rows)
    plan = models.boosting(rounds=4, rate=0.3, leaves=leaves, leaf=15, l2=l2, balanced=balanced)
    model = models.fit(rows, plan, FEATURES)
    mode = data.c.mode()[0]
    x = np.stack([data.a.fillna(data.a.median()), data.b, *[(data.c.fillna(mode) == v).astype(float) for v in "pqr"]], axis=1).astype(float)
    y = data.y.to_numpy()
    w = np.where(y == 1, len(y) / (2 * y.sum()), len(y) / (2 * (1 - y).sum())) if balanced else np.ones(len(y))
    margin = np.full(len(y), math.log((w * y).sum() / (w * (1 - y)).sum()))
    for tree in model.booster.trees:
        p = 1 / (1 + np.exp(-margin))
        value, n = brute_tree(x, None, w * (p - y), w * p * (1 - p), leaves, 15, l2, 0.3)
        assert len(tree.values) == n <= leaves
        margin += value
    got = model.margin(rows).orderBy("id").toPandas().margin.to_numpy()
    assert np.abs(got - margin).max() < 1e-6


def test_a_batch_of_boosters_gives_what_single_fits_give(rows, monkeypatch):
    plans = [models.boosting(rounds=3, rate=0.2, leaf=10, name="short"), models.boosting(rounds=6, leaves=4, leaf=30, balanced=True, name="long")]
    scores = models.oof_scores(rows, plans, FEATURES).toPandas().set_index(["model", "id"]).p
    monkeypatch.setattr(boost, "FETCHED_BYTES", 0)
    monkeypatch.setattr(boost, "ROUNDS_HELD", 1)
    monkeypatch.setattr(boost, "ROUNDS_PER_CHECKPOINT", 2)
    for plan in plans:
        for fold in range(3):
            alone = models.fit(rows.where(F.col("fold") != fold), plan, FEATURES).score(rows.where(F.col("fold") == fold)).toPandas()
            assert np.abs(scores[plan.name].loc[alone.id].to_numpy() - alone.p.to_numpy()).max() < 1e-9


def test_saved_booster_scores_unseen_and_missing_cells(spark, rows, tmp_path):
    model = models.fit(rows, models.boosting(rounds=5), models.Features(("a", "b"), ("c",), {"r": ("a", "b", 1)}))
    odd = spark.createDataFrame([(1, None, None, None), (2, float("nan"), 2.0, "new"), (3, 1e9, -1e9, "p")], "id long, a double, b double, c string")
    model.save(str(tmp_path / "boosted"))
    again = models.load_model("gradient_boosting", str(tmp_path / "boosted"))
    one, other = (m.score(odd).orderBy("id").collect() for m in (model, again))
    assert [r.p for r in one] == [r.p for r in other] and all(0 < r.p < 1 for r in one)
    assert model.score(odd.limit(0)).count() == 0


def test_boosting_refuses_what_cannot_be_fitted(rows):
    for plan in (models.boosting(leaves=1), models.boosting(rounds=0)):
        with pytest.raises(ValueError):
            models.fit(rows, plan, FEATURES)
    with pytest.raises(ValueError):
        models.fit(rows.where("y = 1"), models.boosting(rounds=1), FEATURES)


def test_edges_are_values_at_equal_shares(spark):
    table = spark.createDataFrame([(float(v), 1.0) for v in range(1000)] + [(None, 1.0)], "a double, b double")
    edges = boost.bin_edges(table, ["a", "b"], bins=10)[None]
    assert edges["b"] == [] and len(edges["a"]) == 9
    assert edges["a"] == [99.0 + 100 * k for k in range(9)]
    few = boost.bin_edges(table.select((F.col("a") % 7).alias("a")), ["a"], bins=10)[None]
    assert few["a"] == [0.0, 1.0, 2.0, 3.0, 4.0, 5.0]


def test_counted_replicates_spread_like_drawn_ones(spark, scored_of, monkeypatch):
    """Mean and deviation of 400 replicates by either way, and the same draws for any partitioning and with ranges."""
    rng = np.random.default_rng(8)
    y = (rng.random(300) < 0.3).astype(int)
    p = np.round(np.clip(0.3 * y + rng.random(300) * 0.7, 0, 1), 2)
    scored = scored_of(y.tolist(), p.tolist())
    counted = bootstrap.counted_replicates(scored, 0.5, 400, 42).toPandas()
    drawn = metrics.evaluate(bootstrap.class_draws(scored, 400, 42), 0.5, ["replicate"]).toPandas()
    for m in metrics.FOLD_METRICS:
        assert abs(counted[m].mean() - drawn[m].mean()) < 4 * drawn[m].std() / 20
        assert 0.8 < counted[m].std() / drawn[m].std() < 1.25
    again = bootstrap.counted_replicates(scored.repartition(7), 0.5, 400, 42).toPandas()
    assert counted.sort_values("replicate").reset_index(drop=True).equals(again.sort_values("replicate").reset_index(drop=True))
    monkeypatch.setattr(bootstrap, "split_points", lambda *_: [0.2, 0.35, 0.6])
    monkeypatch.setattr(bootstrap, "CELLS_AT_ONCE", 100)
    ranged = bootstrap.counted_replicates(scored, 0.5, 400, 42).toPandas()
    for m in metrics.FOLD_METRICS:
        assert abs(ranged[m].mean() - drawn[m].mean()) < 4 * drawn[m].std() / 20 and 0.8 < ranged[m].std() / drawn[m].std() < 1.25


def test_counted_replicate_of_one_score(scored_of):
    """Ties only: AP is the prevalence and the area one half in every replicate."""
    found = bootstrap.counted_replicates(scored_of([0, 0, 0, 1], [0.5] * 4), 0.5, 20, 1).toPandas()
    assert np.allclose(found.pr_auc, 0.25) and np.allclose(found.roc_auc, 0.5) and (found.recall == 1).all()


def test_binomial_steps():
    for n, share in ((1, 0.5), (40, 0.1), (3_000, 0.9), (10, 0.0), (10, 1.0)):
        first, steps = bootstrap.binomial_steps(n, share)
        mean = sum((first + k) * q for k, q in enumerate(np.diff([0.0, *steps])))
        assert steps[-1] == pytest.approx(1) and mean == pytest.approx(n * share)
