"""Queries on models and scores: fitting, batch scoring, evaluation."""

from __future__ import annotations

from pyspark.sql import functions as F

from binoscope.functions.scalars import same_keys
from binoscope.operators import boost, bootstrap, metrics, models, split
from binoscope.plans import bindings as B
from binoscope.plans import sqlmodels as M
from binoscope.plans import sqltext as S
from binoscope.plans.catalog_tables import SPLIT
from binoscope.plans.registry import register, rounded
from binoscope.session import held

FEATURES = models.Features(tuple(B.NUMERIC), tuple(B.CATEGORICAL))


def _parts(spark, sf_dir):
    """Training and holdout rows of the customer-order view."""
    table = split.stratified_split(B.cls_nulls(spark, sf_dir))
    return table.where("partition = 'train'").drop("partition"), table.where("partition = 'test'").drop("partition")


def _holdout_metrics(spark, sf_dir, plan):
    train, test = _parts(spark, sf_dir)
    model = models.fit(train, plan, FEATURES)
    return metrics.evaluate(models.score_all(test, [model]), by=["model"])


# ---- training and scoring

LOSS = ("avg(-CASE WHEN y = 1 THEN ln(greatest(2.220446049250313e-16, least(p, 1 - 2.220446049250313e-16))) "
        "ELSE ln(1 - greatest(2.220446049250313e-16, least(p, 1 - 2.220446049250313e-16))) END)")

@register("F1_prior_model", f"""WITH {S.LABELLED}, {SPLIT} SELECT id, round((SELECT avg(y) FROM split WHERE partition = 'train'), 6) + 0.0 AS p
  FROM split WHERE partition = 'test'""")
def prior_model(spark, sf_dir):
    train, test = _parts(spark, sf_dir)
    return rounded(models.fit(train, models.prior(), FEATURES).score(test).select("id", "p"))


LEVELS = {"priority": B.CLS_SPEC.categories["priority"], "segment": B.CLS_SPEC.categories["segment"], "region": B.CLS_SPEC.categories["region"]}
WIDTH = M.width(B.NUMERIC, LEVELS)
# Training and holdout rows as the twins see them; the one training set has the number 0.
SIDES = f"""{S.CLS_NULLS}, {M.PARTS}, train AS (SELECT *, 0 AS g FROM parts WHERE partition = 'train'),
test AS (SELECT *, 0 AS g FROM parts WHERE partition = 'test')"""


def _regression_sql(numeric=B.NUMERIC, categorical=LEVELS, balanced=False, name="scored") -> str:
    """CTEs ending in `name`: (id, y, g, margin, p) of the holdout rows by the regression of the training rows."""
    d = M.width(numeric, categorical)
    return ",\n".join([SIDES, M.design("train", "train", numeric, categorical, "xt"), M.design("train", "test", numeric, categorical, "xr"),
                       M.newton("xt", d, "solved", balanced=balanced), M.linear("xr", "solved", d, name)])


def _evaluated_sql(model: str, balanced: bool) -> str:
    return (f"WITH {_regression_sql(balanced=balanced)}, named AS (SELECT y, '{model}' AS model, p FROM scored), {S.evaluation('named', 0.5, ['model'])} "
            + S.rounding("evaluation", S.EVALUATION_DOUBLES))


def _scores(spark, sf_dir, plan, features=None, keep=("id", "p")):
    train, test = _parts(spark, sf_dir)
    return rounded(models.fit(train, plan, features or FEATURES).score(test).select(*keep))


@register("F2_logistic", _evaluated_sql("logistic_regression", False))
def logistic(spark, sf_dir):
    return rounded(_holdout_metrics(spark, sf_dir, models.logistic()))


@register("F2_logistic_scores", f"WITH {_regression_sql()} SELECT id, round(p, 6) + 0.0 AS p FROM scored")
def logistic_scores(spark, sf_dir):
    return _scores(spark, sf_dir, models.logistic())


@register("F3_logistic_balanced", _evaluated_sql("logistic_balanced", True))
def logistic_balanced(spark, sf_dir):
    return rounded(_holdout_metrics(spark, sf_dir, models.logistic(balanced=True)))


@register("F3_logistic_balanced_scores", f"WITH {_regression_sql(balanced=True)} SELECT id, round(p, 6) + 0.0 AS p FROM scored")
def logistic_balanced_scores(spark, sf_dir):
    return _scores(spark, sf_dir, models.logistic(balanced=True))


@register("F4_random_forest")
def random_forest(spark, sf_dir):
    return _holdout_metrics(spark, sf_dir, models.forest())


@register("F5_gradient_boosting")
def gradient_boosting(spark, sf_dir):
    """The default model: 150 rounds of 7 leaves."""
    return _holdout_metrics(spark, sf_dir, models.boosting())


@register("F5_first_trees", f"WITH {SIDES}, {M.boosted('train', 'test', B.NUMERIC, LEVELS, 'scored', rounds=3)} SELECT id, round(p, 6) + 0.0 AS p FROM scored")
def first_trees(spark, sf_dir):
    """Three trees of the default settings, whose splits and leaf values the SQL text finds by itself."""
    return _scores(spark, sf_dir, models.boosting(rounds=3))


@register("F5_penalised_tree", f"WITH {SIDES}, {M.boosted('train', 'test', B.NUMERIC, LEVELS, 'scored', 1, 0.2, 12, 35, 64, 3.5)} SELECT id, round(p, 6) + 0.0 AS p FROM scored")
def penalised_tree(spark, sf_dir):
    """One tree of twelve leaves with a leaf penalty and few bins."""
    train, test = _parts(spark, sf_dir)
    member = boost.Member(rounds=1, rate=0.2, leaves=12, leaf=35, l2=3.5)
    train = held(train.select(*FEATURES.columns, "y"))
    try:
        counts = {r["y"]: r["n"] for r in train.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
        booster = boost.fit_boosters(train, [member], B.NUMERIC, B.CATEGORICAL, {None: models.statistics_of(train, FEATURES)}, {None: counts}, bins=64)[0]
    finally:
        train.unpersist()
    return rounded(booster.score(test).select("id", "p"))


SIGMOID = ",\n".join([SIDES, M.folds("train", "inner_rows", 3, "'42|calibration'"), M.training_sets("(SELECT * EXCLUDE (g) FROM inner_rows)", "sets", 3),
                      "held AS (SELECT * EXCLUDE (g), fold AS g FROM inner_rows)", "asked AS (SELECT * EXCLUDE (g), CAST(range AS BIGINT) AS g FROM test, range(3))",
                      M.design("sets", "sets", B.NUMERIC, LEVELS, "xt"), M.design("sets", "held", B.NUMERIC, LEVELS, "xh"),
                      M.design("sets", "asked", B.NUMERIC, LEVELS, "xr"), M.newton("xt", WIDTH, "solved"), M.linear("xh", "solved", WIDTH, "margins"),
                      M.sigmoids("margins", "sig"), M.linear("xr", "solved", WIDTH, "raw"),
                      "calibrated AS (SELECT id, any_value(y) AS y, 'sigmoid' AS method, avg(1 / (1 + exp(-(a * margin + b)))) AS p FROM raw JOIN sig USING (g) GROUP BY id)"])


@register("F6_sigmoid_calibration", f"WITH {SIGMOID}, scores AS (SELECT method, avg((p - y) * (p - y)) AS brier_score, {LOSS} AS log_loss FROM calibrated GROUP BY method) "
          + S.rounding("scores", ["brier_score", "log_loss"]))
def sigmoid_calibration(spark, sf_dir):
    train, test = _parts(spark, sf_dir)
    score = models.sigmoid_calibration(train, models.logistic(), FEATURES)
    return rounded(metrics.calibration_scores(score(test).withColumn("method", F.lit("sigmoid"))))


@register("F6_calibrated_scores", f"WITH {SIGMOID} SELECT id, round(p, 6) + 0.0 AS p FROM calibrated")
def calibrated_scores(spark, sf_dir):
    train, test = _parts(spark, sf_dir)
    return rounded(models.sigmoid_calibration(train, models.logistic(), FEATURES)(test).select("id", "p"))


@register("F7_batch_scoring", f"""WITH {_regression_sql()} SELECT id, round(p, 6) + 0.0 AS p, CASE WHEN p >= 0.3 THEN 'Yes' ELSE 'No' END AS predicted_class,
  0.3::DOUBLE AS decision_threshold, 'run-1' AS run_id FROM scored""")
def batch_scoring(spark, sf_dir):
    train, test = _parts(spark, sf_dir)
    model = models.fit(train, models.logistic(), FEATURES)
    return rounded(models.score_batch(test, model, 0.3, "run-1", FEATURES))


@register("F8_label_at", f"""WITH {S.SCORED} SELECT id, p, CASE WHEN p >= 0.35 THEN 'Yes' ELSE 'No' END AS predicted_class,
  CAST(0.35 AS DOUBLE) AS decision_threshold FROM scored""")
def label_at(spark, sf_dir):
    return metrics.label_at(B.scored(spark, sf_dir), 0.35).select("id", "p", "predicted_class", "decision_threshold")


@register("F9_oof_prior", f"""WITH {S.LABELLED}, folds AS (SELECT id, y, {S.fold_of()} AS fold FROM labelled),
  rates AS (SELECT o.fold, avg(f.y) AS p FROM (SELECT DISTINCT fold FROM folds) o JOIN folds f ON f.fold <> o.fold GROUP BY o.fold)
  SELECT id, CAST(y AS BIGINT) AS y, folds.fold, 'dummy' AS model, round(p, 6) + 0.0 AS p FROM folds JOIN rates ON folds.fold = rates.fold""")
def oof_prior(spark, sf_dir):
    folded = split.stratified_folds(B.labelled(spark, sf_dir))
    return rounded(models.oof_scores(folded, [models.prior()], models.Features((), ())))


OOF = ",\n".join([S.CLS_NULLS, M.folds("cls_nulls", "folded", 5), M.training_sets("folded", "sets", 5), "held AS (SELECT *, fold AS g FROM folded)",
                  M.design("sets", "sets", B.NUMERIC, LEVELS, "xt"), M.design("sets", "held", B.NUMERIC, LEVELS, "xr", keep=("id", "y", "fold")),
                  M.newton("xt", WIDTH, "solved"), M.linear("xr", "solved", WIDTH, "unseen", ("id", "y", "fold")),
                  "oof AS (SELECT y, fold, 'logistic_regression' AS model, p FROM unseen)"])


@register("F9_oof_scores", f"WITH {OOF}, {S.evaluation('oof', 0.5, ['model', 'fold'])}, report AS (SELECT model, fold, {', '.join(S.FOLD_METRICS)} FROM evaluation) "
          + S.rounding("report", S.FOLD_METRICS))
def oof_scores(spark, sf_dir):
    folded = split.stratified_folds(B.cls_nulls(spark, sf_dir))
    scores = models.oof_scores(folded, [models.logistic()], FEATURES)
    return rounded(metrics.fold_metrics(scores))


@register("F10_score_all", f"""WITH {_regression_sql()} SELECT id, CAST(y AS BIGINT) AS y, 'logistic_regression' AS model, round(p, 6) + 0.0 AS p FROM scored
  UNION ALL SELECT id, CAST(y AS BIGINT), 'dummy', round((SELECT avg(y) FROM train), 6) + 0.0 FROM test""")
def score_all(spark, sf_dir):
    train, test = _parts(spark, sf_dir)
    fitted = [models.fit(train, plan, FEATURES) for plan in (models.prior(), models.logistic())]
    return rounded(models.score_all(test, fitted))


# Engineered columns as the twin sees them; the excluded acctbal still feeds the mean.
ENGINEERED = SIDES.replace("parts AS (SELECT *, CASE", "parts AS (SELECT *, totalprice / nullif(order_month + 1, 0) AS price_per_month, "
                           "(coalesce(acctbal, 0) + coalesce(order_month, 0)) / nullif(CAST(acctbal IS NOT NULL AS INT) + CAST(order_month IS NOT NULL AS INT), 0) AS level, CASE")
PIPELINE_NUMBERS = ["totalprice", "order_year", "order_month", "price_per_month", "level"]
PIPELINE_LEVELS = {c: v for c, v in LEVELS.items() if c != "region"}


@register("E10_full_pipeline", f"WITH {_regression_sql(PIPELINE_NUMBERS, PIPELINE_LEVELS).replace(SIDES, ENGINEERED)} SELECT id, round(p, 6) + 0.0 AS p FROM scored")
def full_pipeline(spark, sf_dir):
    """Normalise, engineer a ratio and a row mean, impute, scale, encode and estimate, without one category and one number."""
    train, test = _parts(spark, sf_dir)
    engineered = models.Features(FEATURES.numeric, FEATURES.categorical, {"price_per_month": ("totalprice", "order_month", 1)},
                                 {"level": ("acctbal", "order_month")})
    model = models.build_pipeline(train, engineered, models.logistic(), exclude=["region", "acctbal"])
    return rounded(model.score(test).select("id", "p"))


# ---- evaluation

EVALUATED = f"WITH {S.SCORED_GROUPS}, {S.evaluation('scored', 0.5, ['segment'])} "


@register("G1_confusion", EVALUATED + "SELECT segment, true_negatives, false_positives, false_negatives, true_positives FROM evaluation")
def confusion(spark, sf_dir):
    return metrics.confusion(B.scored(spark, sf_dir, True), 0.5, ["segment"])


@register("G2_precision_recall_f1", EVALUATED + ", cut AS (SELECT segment, precision, recall, f1 FROM evaluation) "
          + S.rounding("cut", ["precision", "recall", "f1"]))
def precision_recall_f1(spark, sf_dir):
    return rounded(metrics.precision_recall_f1(B.scored(spark, sf_dir, True), 0.5, ["segment"]))


@register("G3_average_precision", EVALUATED + "SELECT segment, round(pr_auc, 6) + 0.0 AS pr_auc FROM evaluation")
def average_precision(spark, sf_dir):
    return rounded(metrics.average_precision(B.scored(spark, sf_dir, True), ["segment"]))


@register("G3_average_precision_rare", f"""WITH imb AS (SELECT labels.doc_id AS id, toxic AS y, lang, n_chars FROM labels JOIN documents USING (doc_id)),
  {S.scored('imb')}, {S.evaluation('scored', 0.5, ['lang'])} SELECT lang, n, positive_count, round(pr_auc, 6) + 0.0 AS pr_auc FROM evaluation""")
def average_precision_rare(spark, sf_dir):
    rare = B.with_score(B.imbalanced(spark, sf_dir))
    return rounded(metrics.evaluate(rare, 0.5, ["lang"]).select("lang", "n", "positive_count", "pr_auc"))


@register("G4_roc_auc", EVALUATED + "SELECT segment, round(roc_auc, 6) + 0.0 AS roc_auc FROM evaluation")
def roc_auc(spark, sf_dir):
    return rounded(metrics.roc_auc(B.scored(spark, sf_dir, True), ["segment"]))


@register("G5_brier", EVALUATED + "SELECT segment, round(brier_score, 6) + 0.0 AS brier_score FROM evaluation")
def brier(spark, sf_dir):
    return rounded(metrics.brier(B.scored(spark, sf_dir, True), ["segment"]))


@register("G6_log_loss", f"WITH {S.SCORED_GROUPS} SELECT segment, round({LOSS}, 6) + 0.0 AS log_loss FROM scored GROUP BY segment")
def log_loss(spark, sf_dir):
    return rounded(metrics.log_loss(B.scored(spark, sf_dir, True), ["segment"]))


@register("G7_evaluate", EVALUATED + S.rounding("evaluation", S.EVALUATION_DOUBLES))
def evaluate(spark, sf_dir):
    return rounded(metrics.evaluate(B.scored(spark, sf_dir, True), 0.5, ["segment"]))


@register("G7_evaluate_models", f"WITH {S.FOLDED_MODELS}, {S.evaluation('folded', 0.4, ['model', 'fold'])} "
          + S.rounding("evaluation", S.EVALUATION_DOUBLES))
def evaluate_models(spark, sf_dir):
    return rounded(metrics.evaluate(B.folded_models(spark, sf_dir), 0.4, ["model", "fold"]))


@register("G8_threshold_table", f"WITH {S.SCORED}, {S.sweep('scored')} " + S.rounding("sweep", ["precision", "recall", "f1", "f2"]))
def threshold_table(spark, sf_dir):
    return rounded(metrics.threshold_table(B.scored(spark, sf_dir)))


@register("G9_select_threshold", f"WITH {S.SCORED_GROUPS}, {S.sweep('scored', ['segment'])}, {S.choice('sweep', ['segment'])} "
          + S.rounding("choice", ["f2", "precision", "recall"]))
def select_threshold(spark, sf_dir):
    return rounded(metrics.select_threshold(metrics.threshold_table(B.scored(spark, sf_dir, True), by=["segment"]), ["segment"]))


BINS = """bins AS (SELECT method, least(CAST(trunc(p * 10) AS BIGINT), 9) AS bin, count(*) AS n, avg(p) AS mean_probability, avg(y) AS observed_rate
  FROM methods GROUP BY ALL), spine AS (SELECT method, range AS bin FROM (SELECT DISTINCT method FROM methods), range(10)),
reliability AS (SELECT s.method, s.bin, s.bin / 10.0::DOUBLE AS lower, (s.bin + 1) / 10.0::DOUBLE AS upper, coalesce(n, 0) AS n,
  mean_probability, observed_rate FROM spine s LEFT JOIN bins b ON s.method = b.method AND s.bin = b.bin)"""
METHODS = f"methods AS (SELECT y, model AS method, CASE WHEN p >= 0.35 AND p < 0.5 THEN 0.25 ELSE p END AS p FROM scored_models)"


def _methods(spark, sf_dir):
    """Two score tables with an emptied stretch, so that empty bins occur."""
    return B.scored_models(spark, sf_dir).withColumnRenamed("model", "method").withColumn(
        "p", F.when((F.col("p") >= 0.35) & (F.col("p") < 0.5), 0.25).otherwise(F.col("p")))


@register("G10_reliability", f"WITH {S.SCORED_MODELS}, {METHODS}, {BINS} " + S.rounding("reliability", ["mean_probability", "observed_rate"]))
def reliability(spark, sf_dir):
    return rounded(metrics.reliability(_methods(spark, sf_dir), 10, ["method"]))


@register("G11_calibration_report", f"""WITH {S.SCORED_MODELS}, {METHODS}, {BINS}, scores AS (
  SELECT method, avg((p - y) * (p - y)) AS brier_score, {LOSS} AS log_loss FROM methods GROUP BY method),
  report AS (SELECT r.*, brier_score, log_loss FROM reliability r JOIN scores s ON r.method = s.method) """
          + S.rounding("report", ["mean_probability", "observed_rate", "brier_score", "log_loss"]))
def calibration_report(spark, sf_dir):
    return rounded(metrics.calibration_report(_methods(spark, sf_dir)))


@register("G12_capacity", f"""WITH {S.SCORED_GROUPS}, coarse AS (SELECT id, y, region, round(p, 1) AS p FROM scored),
  ranked AS (SELECT *, row_number() OVER (PARTITION BY region ORDER BY p DESC, id) AS place, count(*) OVER (PARTITION BY region) AS n FROM coarse),
  asked AS (SELECT region, f AS capacity_fraction, CAST(ceil(f * any_value(n)) AS BIGINT) AS selected_count, CAST(sum(y) AS BIGINT) AS positive_count,
    CAST(sum(CASE WHEN place <= ceil(f * n) THEN y ELSE 0 END) AS BIGINT) AS true_positives, avg(y) AS prevalence
    FROM ranked, (SELECT unnest([0.05::DOUBLE, 0.1::DOUBLE, 0.2::DOUBLE]) AS f) GROUP BY region, f),
  report AS (SELECT region, capacity_fraction, selected_count, positive_count, true_positives, true_positives / selected_count AS precision,
    true_positives / nullif(positive_count, 0) AS recall, true_positives / selected_count / nullif(prevalence, 0) AS lift FROM asked) """
          + S.rounding("report", ["precision", "recall", "lift"]))
def capacity(spark, sf_dir):
    coarse = B.scored(spark, sf_dir, True).select("id", "y", "region", F.round("p", 1).alias("p"))
    return rounded(metrics.capacity(coarse, by=["region"]))


@register("G13_roc_curve", f"WITH {S.SCORED_GROUPS}, {S.curve('scored', ['segment'])}, points AS (SELECT segment, p AS threshold, "
          "fp / n_n AS false_positive_rate, tp / n_p AS true_positive_rate FROM curve UNION ALL "
          "SELECT DISTINCT segment, CAST(NULL AS DOUBLE), 0.0, 0.0 FROM scored) "
          + S.rounding("points", ["false_positive_rate", "true_positive_rate"]))
def roc_curve(spark, sf_dir):
    return rounded(metrics.roc_curve(B.scored(spark, sf_dir, True), ["segment"]))


@register("G14_pr_curve", f"WITH {S.SCORED_GROUPS}, {S.curve('scored', ['segment'])}, points AS (SELECT segment, p AS threshold, "
          "tp / (tp + fp) AS precision, tp / n_p AS recall, n_p / (n_p + n_n) AS prevalence FROM curve UNION ALL "
          "SELECT segment, CAST(NULL AS DOUBLE), 1.0, 0.0, avg(y) FROM scored GROUP BY segment) "
          + S.rounding("points", ["precision", "recall", "prevalence"]))
def pr_curve(spark, sf_dir):
    return rounded(metrics.pr_curve(B.scored(spark, sf_dir, True), ["segment"]))


N_BOOT = 20


def _bootstrap_sql(replicas: str, point: str = "point") -> str:
    return "SELECT * FROM (" + " UNION ALL ".join(
        f"""SELECT '{m}' AS metric, round(any_value(e.{m}), 9) + 0.0 AS estimate, round(quantile_cont(r.{m}, 0.025), 9) + 0.0 AS lower,
      round(quantile_cont(r.{m}, 0.975), 9) + 0.0 AS upper, 0.95::DOUBLE AS confidence, {N_BOOT} AS replicates, 0.5::DOUBLE AS threshold
      FROM {replicas} r, {point} e""" for m in S.FOLD_METRICS) + ")"


@register("G15_bootstrap_ci", f"""WITH {S.SCORED}, ranked AS (SELECT y, p, row_number() OVER (PARTITION BY y ORDER BY {S.hex_of('42', "'bootstrap'", 'id')}) AS place,
  count(*) OVER (PARTITION BY y) AS n_class FROM scored),
  draws AS (SELECT replicate, y, {S.int_of('42', 'replicate', 'y', 'place', digits=15)} % n_class + 1 AS place
    FROM ranked, (SELECT range AS replicate FROM range({N_BOOT}))),
  drawn AS (SELECT d.replicate, d.y, r.p FROM draws d JOIN ranked r ON d.y = r.y AND d.place = r.place),
  {S.evaluation('drawn', 0.5, ['replicate'], 'replicas')}, {S.evaluation('scored', 0.5, [], 'point')} """ + _bootstrap_sql("replicas"))
def bootstrap_ci(spark, sf_dir):
    return rounded(bootstrap.bootstrap_ci(B.scored(spark, sf_dir), 0.5, N_BOOT), 9)


@register("G15_bootstrap_counts")
def bootstrap_counts(spark, sf_dir):
    """All 1,000 replicates, drawn from counted scores."""
    return rounded(bootstrap.bootstrap_ci(B.scored(spark, sf_dir), 0.5, method="counts"), 9)


def _poisson_sql(uniform: str) -> str:
    total, term, steps = 0.0, 2.718281828459045 ** -1, []
    for k in range(bootstrap.POISSON_STEPS):
        total += term
        steps.append(repr(total))
        term /= k + 1
    return f"len(list_filter([{', '.join(f'CAST({s} AS DOUBLE)' for s in steps)}], lambda c: c <= {uniform}))"


@register("G15_bootstrap_poisson", f"""WITH {S.SCORED}, spread AS (SELECT y, p, replicate, CAST({S.int_of('42', 'replicate', 'id')} AS DOUBLE)
  / 4294967296.0::DOUBLE AS u FROM scored, (SELECT range AS replicate FROM range({N_BOOT}))),
  weighted AS (SELECT replicate, y, p, {_poisson_sql('u')} AS w FROM spread), present AS (SELECT * FROM weighted WHERE w > 0),
  {S.evaluation('present', 0.5, ['replicate'], 'replicas', 'w')}, {S.evaluation('scored', 0.5, [], 'point')} """ + _bootstrap_sql("replicas"))
def bootstrap_poisson(spark, sf_dir):
    return rounded(bootstrap.bootstrap_ci(B.scored(spark, sf_dir), 0.5, N_BOOT, method="poisson"), 9)


BANDED = f"""{S.SCORED_GROUPS}, banded AS (SELECT id, y, p, segment, region, CASE WHEN acctbal > -1000 AND acctbal <= 2000 THEN 'low'
  WHEN acctbal > 2000 AND acctbal <= 6000 THEN 'mid' WHEN acctbal > 6000 AND acctbal <= 9500 THEN 'high' END AS balance_band FROM scored),
long AS (SELECT id, y, p >= 0.5 AS flagged, attribute, "group" FROM banded
  UNPIVOT ("group" FOR attribute IN (segment, region, balance_band)))"""


def _banded(spark, sf_dir):
    from binoscope.operators.prepare import band
    return band(B.scored(spark, sf_dir, True), "acctbal", [-1000, 2000, 6000, 9500], ["low", "mid", "high"], "balance_band")


ATTRIBUTES = ["segment", "region", "balance_band"]


@register("G16_subgroups", f"""WITH {BANDED.replace('SELECT id, y, p >= 0.5 AS flagged', 'SELECT y, p >= 0.5 AS flagged')}, report AS (
  SELECT attribute, "group", count(*) AS n, CAST(sum(y) AS BIGINT) AS positive_count,
    sum(CASE WHEN flagged AND y = 1 THEN 1 ELSE 0 END) / nullif(sum(y), 0) AS recall,
    sum(CASE WHEN flagged AND y = 0 THEN 1 ELSE 0 END) / nullif(sum(1 - y), 0) AS false_positive_rate,
    sum(CASE WHEN flagged THEN 1 ELSE 0 END) / count(*) AS selection_rate,
    coalesce(sum(CASE WHEN flagged AND y = 1 THEN 1 ELSE 0 END) / nullif(sum(CASE WHEN flagged THEN 1 ELSE 0 END), 0), 0.0) AS precision
  FROM long GROUP BY attribute, "group") """ + S.rounding("report", ["recall", "false_positive_rate", "selection_rate", "precision"]))
def subgroups(spark, sf_dir):
    return rounded(metrics.subgroups(_banded(spark, sf_dir), ATTRIBUTES, 0.5))


@register("G17_subgroup_ci", f"""WITH {BANDED}, sizes AS (SELECT *, count(*) OVER c AS n_class, sum(CASE WHEN flagged THEN 1 ELSE 0 END) OVER c AS n_flagged
  FROM long WINDOW c AS (PARTITION BY attribute, "group", y)),
  hits AS (SELECT attribute, "group", replicate, y, count(*) AS n,
    sum(CASE WHEN {S.int_of('42', 'replicate', 'attribute', '"group"', 'y', 'id', digits=15)} % n_class < n_flagged THEN 1 ELSE 0 END) AS hits
    FROM sizes, (SELECT range AS replicate FROM range({N_BOOT})) GROUP BY ALL),
  rates AS (SELECT attribute, "group", replicate, sum(CASE WHEN y = 1 THEN hits / n END) AS recall,
    sum(CASE WHEN y = 0 THEN hits / n END) AS false_positive_rate, sum(hits) / sum(n) AS selection_rate FROM hits GROUP BY ALL)
  SELECT attribute, "group", """ + ", ".join(f"round(quantile_cont({m}, {q}), 9) + 0.0 AS {m}_{side}" for m in
                                            ("recall", "false_positive_rate", "selection_rate") for side, q in (("lower", 0.025), ("upper", 0.975)))
          + ' FROM rates GROUP BY attribute, "group"')
def subgroup_ci(spark, sf_dir):
    return rounded(bootstrap.subgroup_ci(_banded(spark, sf_dir), ATTRIBUTES, 0.5, N_BOOT, method="draws"), 9)


BOUNDS = ", ".join(f"round(quantile_cont({m}, {q}), 9) + 0.0 AS {m}_{side}" for m in ("recall", "false_positive_rate", "selection_rate")
                   for side, q in (("lower", 0.025), ("upper", 0.975)))


@register("G17_subgroup_ci_counts", f"""WITH {BANDED}, sizes AS (SELECT attribute, "group", y, count(*) AS n, sum(CASE WHEN flagged THEN 1 ELSE 0 END) AS h
    FROM long GROUP BY attribute, "group", y),
  terms AS (SELECT attribute, "group", y, n, h, k, CASE WHEN h = 0 THEN CASE WHEN k = 0 THEN 1.0 ELSE 0.0 END WHEN h = n THEN CASE WHEN k = n THEN 1.0 ELSE 0.0 END
    ELSE exp(lgamma(n + 1) - lgamma(k + 1) - lgamma(n - k + 1) + k * ln(h / n) + (n - k) * ln(1 - h / n)) END AS t
    FROM (SELECT *, unnest(range(n + 1)) AS k FROM sizes)),
  steps AS (SELECT attribute, "group", y, n, list(c ORDER BY k) AS c FROM (SELECT *, sum(t) OVER (PARTITION BY attribute, "group", y ORDER BY k) AS c FROM terms)
    GROUP BY attribute, "group", y, n),
  hits AS (SELECT attribute, "group", replicate, y, n, least(len(list_filter(c, lambda x: x < u)), n) AS hits FROM (
    SELECT *, CAST({S.int_of('42', "'subgroups'", 'replicate', 'attribute', '"group"', 'y')} AS DOUBLE) / 4294967296.0::DOUBLE AS u
    FROM steps, (SELECT range AS replicate FROM range(1000)))),
  rates AS (SELECT attribute, "group", replicate, sum(CASE WHEN y = 1 THEN hits / n END) AS recall,
    sum(CASE WHEN y = 0 THEN hits / n END) AS false_positive_rate, sum(hits) / sum(n) AS selection_rate FROM hits GROUP BY ALL)
  SELECT attribute, "group", {BOUNDS} FROM rates GROUP BY attribute, "group" """)
def subgroup_ci_counts(spark, sf_dir):
    """The bounds of all 1,000 replicates, each one binomial number per group and class."""
    return rounded(bootstrap.subgroup_ci(_banded(spark, sf_dir), ATTRIBUTES, 0.5), 9)


@register("G18_fold_summary", f"WITH {S.FOLDED_MODELS}, {S.evaluation('folded', 0.5, ['model', 'fold'], 'per_fold')}, "
          "long AS (" + " UNION ALL ".join(f"SELECT model, '{m}' AS metric, {m} AS value FROM per_fold" for m in S.FOLD_METRICS)
          + ") SELECT model, metric, round(avg(value), 6) + 0.0 AS mean, round(stddev_pop(value), 6) + 0.0 AS std FROM long GROUP BY model, metric")
def fold_summary(spark, sf_dir):
    return rounded(metrics.fold_summary(metrics.fold_metrics(B.folded_models(spark, sf_dir))))


# ---- models whose scores are known: with one category and next to no penalty a logistic model gives the category's rate

KNOWN = models.Features((), ("segment",))
KNOWN_SQL = f"""{S.CLS}, parts AS (SELECT *, CASE WHEN row_number() OVER (PARTITION BY y ORDER BY {S.hex_of('42', "'split'", 'id')})
  <= floor(0.2 * count(*) OVER (PARTITION BY y) + 0.5) THEN 'test' ELSE 'train' END AS partition FROM cls), train AS (SELECT * FROM parts WHERE partition = 'train')"""


def _known_parts(spark, sf_dir):
    table = split.stratified_split(B.cls(spark, sf_dir))
    return table.where("partition = 'train'").drop("partition"), table.where("partition = 'test'").drop("partition")


def _agreement(scores, train, by: list[str], expected=None):
    """Per group: rows scored, and whether every score is the training rate of its segment to three digits."""
    keys = [c for c in by if c in train.columns]
    rates = train.groupBy(*keys).agg(F.avg("y").alias("rate"))
    want = F.col("rate") if expected is None else expected(F.col("rate"))
    joined = same_keys(scores, rates, keys) if keys else scores.crossJoin(F.broadcast(rates))
    return joined.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), (F.max(F.abs(F.col("p") - want)) < 1e-3).alias("agrees"))


@register("F2_logistic_known", f"WITH {KNOWN_SQL} SELECT segment, count(*) AS n, true AS agrees FROM parts WHERE partition = 'test' GROUP BY segment")
def logistic_known(spark, sf_dir):
    train, test = _known_parts(spark, sf_dir)
    return _agreement(models.fit(train, models.logistic(C=1e9), KNOWN).score(test), train, ["segment"])


@register("F3_logistic_balanced_known", f"WITH {KNOWN_SQL} SELECT segment, count(*) AS n, true AS agrees FROM parts WHERE partition = 'test' GROUP BY segment")
def logistic_balanced_known(spark, sf_dir):
    train, test = _known_parts(spark, sf_dir)
    share = train.agg(F.avg("y")).first()[0]
    scores = models.fit(train, models.logistic(C=1e9, balanced=True), KNOWN).score(test)
    return _agreement(scores, train, ["segment"], lambda r: (r / share) / (r / share + (1 - r) / (1 - share)))


@register("F7_batch_scoring_known", f"""WITH {KNOWN_SQL}, rates AS (SELECT segment, avg(y) AS rate FROM train GROUP BY segment)
  SELECT id, CASE WHEN rate >= 0.3 THEN 'Yes' ELSE 'No' END AS predicted_class, CAST(0.3 AS DOUBLE) AS decision_threshold, 'run-1' AS run_id
  FROM parts JOIN rates USING (segment) WHERE partition = 'test'""")
def batch_scoring_known(spark, sf_dir):
    train, test = _known_parts(spark, sf_dir)
    return models.score_batch(test, models.fit(train, models.logistic(C=1e9), KNOWN), 0.3, "run-1", KNOWN).drop("p")


@register("F9_oof_scores_known", f"""WITH {S.CLS}, folds AS (SELECT *, {S.fold_of()} AS fold FROM cls)
  SELECT fold, segment, count(*) AS n, true AS agrees FROM folds GROUP BY fold, segment""")
def oof_scores_known(spark, sf_dir):
    folded = split.stratified_folds(B.cls(spark, sf_dir))
    scores = models.oof_scores(folded.select("id", "y", "fold", "segment"), [models.logistic(C=1e9)], KNOWN, keep=("id", "y", "fold", "segment"))
    rest = folded.withColumn("fold", F.explode(F.sequence(F.lit(0), F.lit(4)).cast("array<bigint>"))).join(
        folded.select("id", F.col("fold").alias("own")), "id").where("fold <> own")
    return rounded(_agreement(scores, rest, ["fold", "segment"]))


@register("F10_score_all_known", f"""WITH {KNOWN_SQL}, test AS (SELECT * FROM parts WHERE partition = 'test')
  SELECT 'logistic_regression' AS model, segment, count(*) AS n, true AS agrees FROM test GROUP BY segment
  UNION ALL SELECT 'dummy', segment, count(*), true FROM test GROUP BY segment""")
def score_all_known(spark, sf_dir):
    train, test = _known_parts(spark, sf_dir)
    fitted = [models.fit(train, plan, KNOWN) for plan in (models.prior(), models.logistic(C=1e9))]
    scores = models.score_all(test, fitted, ("id", "segment"))
    alike = _agreement(scores.where("model <> 'dummy'"), train, ["segment"]).withColumn("model", F.lit("logistic_regression"))
    flat = _agreement(scores.where("model = 'dummy'"), train.withColumn("segment", F.explode(F.array(*[
        F.lit(r[0]) for r in test.select("segment").distinct().collect()]))), ["segment"]).withColumn("model", F.lit("dummy"))
    return alike.unionByName(flat).select("model", "segment", "n", "agrees")


@register("E10_full_pipeline_known", f"WITH {KNOWN_SQL} SELECT segment, count(*) AS n, true AS agrees FROM parts WHERE partition = 'test' GROUP BY segment")
def full_pipeline_known(spark, sf_dir):
    train, test = _known_parts(spark, sf_dir)
    wide = models.Features((), ("segment", "region"))
    return _agreement(models.build_pipeline(train, wide, models.logistic(C=1e9), exclude=["region"]).score(test), train, ["segment"])


@register("I1_coefficients_known", f"WITH {KNOWN_SQL} SELECT segment, true AS agrees FROM train GROUP BY segment")
def coefficients_known(spark, sf_dir):
    """Coefficients of a category differ as the log odds of their rates do."""
    train, _ = _known_parts(spark, sf_dir)
    found = models.coefficients(spark, models.fit(train, models.logistic(C=1e9), KNOWN))
    rates = train.groupBy("segment").agg(F.avg("y").alias("rate")).withColumn("odds", F.log(F.col("rate") / (1 - F.col("rate"))))
    # One row per segment on either side.
    both = found.join(rates, F.col("feature").endswith(F.col("segment")))
    means = both.agg(F.avg("coefficient").alias("c"), F.avg("odds").alias("o"))
    near = F.abs((F.col("coefficient") - F.col("c")) - (F.col("odds") - F.col("o"))) < 1e-2
    return both.crossJoin(F.broadcast(means)).select("segment", near.alias("agrees"))


@register("I2_importances_known", f"WITH {KNOWN_SQL} SELECT count(DISTINCT segment) AS n_features, true AS sums_to_one FROM train")
def importances_known(spark, sf_dir):
    train, _ = _known_parts(spark, sf_dir)
    found = models.importances(spark, models.fit(train, models.forest(trees=20), KNOWN))
    return found.agg(F.count(F.lit(1)).alias("n_features"), (F.abs(F.sum("importance") - 1) < 1e-6).alias("sums_to_one"))
