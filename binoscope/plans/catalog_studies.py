"""Queries on experiments, explanations, drift and integrity."""

from __future__ import annotations

from pyspark.sql import functions as F

from binoscope.operators import drift, experiments, explain, integrity, metrics, models, selection, split
from binoscope.plans import bindings as B
from binoscope.plans import sqltext as S
from binoscope.plans.catalog_scores import FEATURES, LEVELS, _parts, _regression_sql
from binoscope.plans.registry import register, rounded
from binoscope.session import materialize
from binoscope.sources.tables import load

RULE = {"prefer": ["model_b"], "tolerance": 0.02, "baseline": "model_c"}


def _selected(means: str, by=()) -> str:
    """SQL of the selection rule over a CTE (by..., model, mean): prefers model_b within 0.02, never takes model_c."""
    return f"""eligible AS (SELECT * FROM {means} WHERE model <> 'model_c'),
best AS (SELECT {S.comma(by)}arg_min(model, (-mean, model)) AS best_model, max(mean) AS best_score,
  max(CASE WHEN model = 'model_b' THEN mean END) AS preferred FROM eligible{S.group_by(*by)}),
selected AS (SELECT {S.comma(by)}best_model, best_score, CASE WHEN best_score - preferred <= 0.02 THEN 'model_b' ELSE best_model END AS selected_model,
  CASE WHEN best_score - preferred <= 0.02 THEN preferred ELSE best_score END AS selected_score FROM best)"""


PER_FOLD = f"{S.FOLDED_MODELS}, {S.evaluation('folded', 0.5, ['model', 'fold'], 'per_fold')}"


@register("H1_select_model", f"WITH {PER_FOLD}, means AS (SELECT model, avg(pr_auc) AS mean FROM per_fold GROUP BY model), {_selected('means')} "
          + S.rounding("selected", ["best_score", "selected_score"]))
def select_model(spark, sf_dir):
    summary = metrics.fold_summary(metrics.fold_metrics(B.folded_models(spark, sf_dir)), metrics=["pr_auc"])
    return rounded(experiments.select_model(summary, **RULE))


@register("H2_ablation", f"""WITH {PER_FOLD}, paired AS (SELECT v.model, v.pr_auc - b.pr_auc AS d FROM per_fold v JOIN per_fold b ON v.fold = b.fold
  WHERE b.model = 'model_c' AND v.model IN ('model_a', 'model_b')), deltas AS (
  SELECT model, avg(d) AS cv_ap_change, CAST(sum(CASE WHEN d > 0 THEN 1 ELSE 0 END) AS BIGINT) AS folds_improved,
    avg(d) >= 0.01 AND sum(CASE WHEN d > 0 THEN 1 ELSE 0 END) >= 4 AS meets_adoption_rule FROM paired GROUP BY model) """
          + S.rounding("deltas", ["cv_ap_change"]))
def ablation(spark, sf_dir):
    return rounded(experiments.ablation(metrics.fold_metrics(B.folded_models(spark, sf_dir)), "model_c", ["model_a", "model_b"]))


SEEDED = f"""{S.SCORED_MODELS}, seeds AS (SELECT unnest([42, 43, 44]) AS seed), seed_folds AS (
  SELECT id, CAST(seed AS BIGINT) AS seed, {S.fold_of(5, 'seed', ['seed'])} AS fold FROM labelled, seeds),
seeded AS (SELECT m.id, m.y, m.model, m.p, f.seed, f.fold FROM scored_models m JOIN seed_folds f ON m.id = f.id),
{S.evaluation('seeded', 0.5, ['seed', 'model', 'fold'], 'per_fold')},
means AS (SELECT seed, model, avg(pr_auc) AS mean FROM per_fold GROUP BY seed, model), {_selected('means', ['seed'])},
{S.sweep('seeded', ['seed', 'model'])}, {S.choice('sweep', ['seed', 'model'])},
choices AS (SELECT s.seed, s.selected_model, c.threshold, s.selected_score AS selected_cv_ap
  FROM selected s JOIN choice c ON s.seed = c.seed AND s.selected_model = c.model)"""


def _seeded(spark, sf_dir):
    wide = split.seeded_folds(B.labelled(spark, sf_dir), [42, 43, 44])
    for name, (salt, noise, signal) in B.MODELS.items():
        wide = B.with_score(wide, salt, noise, signal, name)
    return wide.unpivot(["id", "y", "seed", "fold"], list(B.MODELS), "model", "p")


@register("H3_seed_choices", f"WITH {SEEDED} " + S.rounding("choices", ["selected_cv_ap"]))
def seed_choices(spark, sf_dir):
    return rounded(experiments.seed_choices(_seeded(spark, sf_dir), **RULE))


@register("H3_seed_models", f"""WITH {SEEDED} SELECT seed, model, round(avg(pr_auc), 6) + 0.0 AS mean_ap, round(stddev_pop(pr_auc), 6) + 0.0 AS std_ap
  FROM per_fold GROUP BY seed, model""")
def seed_models(spark, sf_dir):
    return rounded(experiments.seed_models(_seeded(spark, sf_dir)))


@register("H3_stability_summary", f"""WITH {SEEDED}, counts AS (SELECT selected_model, count(*) AS n FROM choices GROUP BY selected_model)
  SELECT (SELECT string_agg(selected_model || ':' || n, ',' ORDER BY selected_model) FROM counts) AS selection_counts,
    min(threshold) AS threshold_min, max(threshold) AS threshold_max, round(stddev_pop(threshold), 6) + 0.0 AS threshold_std FROM choices""")
def stability_summary(spark, sf_dir):
    return rounded(experiments.stability_summary(experiments.seed_choices(_seeded(spark, sf_dir), **RULE)))


TRIAL_MEANS = f"{S.TRIAL_SCORES}, described AS (SELECT *, list_avg(fold_scores) AS mean_ap, list_stddev_pop(fold_scores) AS std_ap FROM trials)"


@register("H4_tune", f"""WITH {TRIAL_MEANS}, picked AS (SELECT model, max(round(mean_ap, 10)) AS best_score,
  arg_min(number, (-round(mean_ap, 10), number)) AS position, arg_min(parameters, (-round(mean_ap, 10), number)) AS parameters
  FROM described GROUP BY model) """ + S.rounding("picked", ["best_score"]))
def tune(spark, sf_dir):
    mean = F.aggregate("fold_scores", F.lit(0.0), lambda a, x: a + x) / F.size("fold_scores")
    table = B.trials(spark, sf_dir).select("model", F.col("number").alias("position"), "parameters", mean.alias("mean_ap"))
    return rounded(experiments.tune(table))


# The regressions among the candidates, whose fits share their passes: all folds, grid entries and trials at production settings.
REGRESSIONS = [models.prior(), models.logistic(), models.logistic(balanced=True)]


@register("H5_run_procedure")
def run_procedure(spark, sf_dir):
    """All five candidates at their defaults on five folds."""
    train, test = _parts(spark, sf_dir)
    choice = selection.run_procedure(train, models.candidates(), FEATURES)
    return metrics.evaluate(choice.model.score(test), choice.threshold)


@register("H5_run_procedure_scores", f"WITH {_regression_sql()} SELECT id, round(p, 6) + 0.0 AS p FROM scored")
def run_procedure_scores(spark, sf_dir):
    """Two candidates within the tolerance: the simpler is chosen, and its scores are those of its refit."""
    train, test = _parts(spark, sf_dir)
    choice = selection.run_procedure(train, [models.prior(), models.logistic()], FEATURES)
    return rounded(choice.model.score(test).select("id", "p"))


@register("H6_nested_cv")
def nested_cv(spark, sf_dir):
    """Five outer folds, five and three inner ones, the full grids of both regressions."""
    train, _ = _parts(spark, sf_dir)
    return selection.nested_cv(train, REGRESSIONS, FEATURES)


PROCEDURES = ["model_a", "model_b", "model_c"]
MEANS = ", ".join(f"round(avg({m}), 6) + 0.0 AS {m}_mean, round(stddev_pop({m}), 6) + 0.0 AS {m}_std" for m in S.FOLD_METRICS)


@register("H7_nested_summary", f"""WITH {S.FOLD_TABLE}, counts AS (SELECT procedure, selected_model, count(*) AS n FROM fold_scores GROUP BY ALL),
  packed AS (SELECT procedure, string_agg(selected_model || ':' || n, ',' ORDER BY selected_model) AS selection_counts FROM counts GROUP BY procedure),
  wide AS (SELECT procedure, {MEANS}, min(threshold) AS threshold_min, max(threshold) AS threshold_max FROM fold_scores GROUP BY procedure)
  SELECT wide.*, selection_counts FROM wide JOIN packed ON wide.procedure = packed.procedure""")
def nested_summary(spark, sf_dir):
    table = experiments.nested_summary(B.fold_scores(spark, sf_dir))
    entries = F.transform(F.map_entries("selection_counts"), lambda e: F.concat(e["key"], F.lit(":"), e["value"].cast("string")))
    return rounded(table.withColumn("selection_counts", F.array_join(entries, ",")))


REGRESSION_SPACE = {"logistic_regression": selection.SPACE["logistic_regression"]}


@register("H8_search")
def search(spark, sf_dir):
    """Thirty trials of the regression family on five folds."""
    train, _ = _parts(spark, sf_dir)
    return selection.trial_table(spark, selection.search(train, FEATURES, space=REGRESSION_SPACE, together=30)).drop("elapsed_seconds")


@register("H9_best_trial", f"""WITH {TRIAL_MEANS}, done AS (SELECT * FROM described WHERE state = 'COMPLETE')
  SELECT number, model, parameters, round(mean_ap, 6) + 0.0 AS value, round(mean_ap, 6) + 0.0 AS mean_ap, round(std_ap, 6) + 0.0 AS std_ap
  FROM done ORDER BY round(mean_ap, 10) DESC, number LIMIT 1""")
def best_trial(spark, sf_dir):
    mean = F.round(F.aggregate("fold_scores", F.lit(0.0), lambda a, x: a + x) / F.size("fold_scores"), 10)
    return rounded(experiments.best_trial(B.trials(spark, sf_dir).withColumn("value", mean)))


@register("H9_search_status", f"""WITH {S.TRIAL_SCORES} SELECT CAST(sum(CASE WHEN state = 'COMPLETE' THEN 1 ELSE 0 END) AS BIGINT) AS completed,
  count(*) AS total, 'complete' AS status FROM trials""")
def search_status(spark, sf_dir):
    return experiments.search_status(B.trials(spark, sf_dir))


@register("H10_nested_search")
def nested_search(spark, sf_dir):
    train, _ = _parts(spark, sf_dir)
    return selection.nested_search(train, REGRESSIONS, FEATURES, space=REGRESSION_SPACE)


def _differences(a: str, b: str) -> str:
    return " UNION ALL ".join(f"""SELECT '{m}' AS metric, f.outer_fold, f.{m} - s.{m} AS d FROM fold_scores f JOIN fold_scores s
    ON f.outer_fold = s.outer_fold WHERE f.procedure = '{a}' AND s.procedure = '{b}'""" for m in S.FOLD_METRICS)


@register("H11_paired_differences", f"""WITH {S.FOLD_TABLE}, d AS ({_differences('model_a', 'model_c')}), report AS (
  SELECT metric, avg(d) AS mean, stddev_pop(d) AS std, min(d) AS min, max(d) AS max,
    CAST(sum(CASE WHEN d > 0 THEN 1 ELSE 0 END) AS BIGINT) AS first_higher_folds,
    CAST(sum(CASE WHEN d < 0 THEN 1 ELSE 0 END) AS BIGINT) AS second_higher_folds FROM d GROUP BY metric) """
          + S.rounding("report", ["mean", "std", "min", "max"]))
def paired_differences(spark, sf_dir):
    return rounded(experiments.paired_differences(B.fold_scores(spark, sf_dir), "model_a", "model_c"))


@register("H12_selection_optimism", f"""WITH {S.FOLD_TABLE} SELECT round(avg(inner_cv_ap), 6) + 0.0 AS mean_inner_best_trial_cv_ap,
  round(avg(pr_auc), 6) + 0.0 AS mean_outer_ap, round(avg(inner_cv_ap) - avg(pr_auc), 6) + 0.0 AS difference FROM fold_scores WHERE procedure = 'model_b'""")
def selection_optimism(spark, sf_dir):
    return rounded(experiments.selection_optimism(B.fold_scores(spark, sf_dir), "model_b"))


def _arms_sql() -> str:
    stats = " UNION ALL ".join(f"SELECT '{m}' AS metric, " + ", ".join(
        f"avg(CASE WHEN procedure = '{a}' THEN {m} END) AS {a}_mean, stddev_pop(CASE WHEN procedure = '{a}' THEN {m} END) AS {a}_std" for a in PROCEDURES)
        + " FROM fold_scores" for m in S.FOLD_METRICS)
    pairs = [(a, b) for i, a in enumerate(PROCEDURES) for b in PROCEDURES[i + 1:]]
    joins = " ".join(f"JOIN (SELECT metric, avg(d) AS {a}_minus_{b} FROM ({_differences(a, b)}) GROUP BY metric) USING (metric)" for a, b in pairs)
    doubles = [f"{a}_{s}" for a in PROCEDURES for s in ("mean", "std")] + [f"{a}_minus_{b}" for a, b in pairs]
    return f"WITH {S.FOLD_TABLE}, stats AS ({stats}), wide AS (SELECT * FROM stats {joins}) " + S.rounding("wide", doubles)


@register("H13_compare_procedures", _arms_sql())
def compare_procedures(spark, sf_dir):
    return rounded(experiments.compare_procedures(B.fold_scores(spark, sf_dir), PROCEDURES))


@register("H14_trial_rows", f"""WITH {S.TRIAL_SCORES}, long AS (SELECT number, state, model, parameters, unnest(fold_scores) AS ap,
  unnest(range(len(fold_scores))) AS outer_fold FROM trials)
  SELECT outer_fold, CASE WHEN number < 3 THEN 'first' ELSE 'second' END AS arm, number, state, parameters, round(ap, 6) + 0.0 AS value FROM long""")
def trial_rows(spark, sf_dir):
    long = B.trials(spark, sf_dir).select("number", "state", "parameters", F.posexplode("fold_scores").alias("outer_fold", "value"))
    nested = long.groupBy(F.col("outer_fold").cast("long").alias("outer_fold"), F.when(F.col("number") < 3, "first").otherwise("second").alias("arm")).agg(
        F.collect_list(F.struct("number", "state", "parameters", "value")).alias("trials"))
    return rounded(experiments.trial_rows(nested))


@register("H15_refit_trial")
def refit_trial(spark, sf_dir):
    train, test = _parts(spark, sf_dir)
    records = selection.search(train, FEATURES, space=REGRESSION_SPACE, together=30)
    best = min((-r["value"], r["number"]) for r in records if r["state"] == "COMPLETE")[1]
    choice = selection.refit_trial(train, records, best, FEATURES, space=REGRESSION_SPACE)
    return metrics.evaluate(choice.model.score(test), choice.threshold)


# ---- explanations

NAMES = [*B.NUMERIC, *[f"{c}_{v}" for c, levels in LEVELS.items() for v in levels]]


@register("I1_coefficients", f"WITH {_regression_sql()} SELECT * FROM (" + " UNION ALL ".join(
    f"SELECT '{name}' AS feature, round(b{i + 1}, 6) + 0.0 AS coefficient FROM solved" for i, name in enumerate(NAMES)) + ")")
def coefficients(spark, sf_dir):
    train, _ = _parts(spark, sf_dir)
    return rounded(models.coefficients(spark, models.fit(train, models.logistic(), FEATURES)))


@register("I2_importances")
def importances(spark, sf_dir):
    train, _ = _parts(spark, sf_dir)
    return models.importances(spark, models.fit(train, models.forest(), FEATURES))


def _formula(df):
    return df.withColumn("p", F.col("signal") * 0.9 + F.col("order_month") / F.lit(120.0))


FORMULA_SQL = "signal * 0.9::DOUBLE + order_month / 120.0::DOUBLE"


def _pass_sql(source: str) -> str:
    """One pass of all rounds over (l, r), then the place it ends in."""
    for i in range(explain.ROUNDS):
        own, other, side = ("l", "r", "a") if i % 2 == 0 else ("r", "l", "b")
        total = "0::BIGINT"
        for k in range(explain.DEGREE):
            total = f"(({total} * {other} + k{i * explain.DEGREE + k}) % {explain.PRIME})"
        source = f"(SELECT * REPLACE (({own} + {total}) % {side} AS {own}) FROM {source})"
    return f"SELECT * REPLACE (l * b + r AS cell) FROM {source}"


ROUND_KEYS_SQL = ", ".join(f"{S.int_of('42', repr('permute'), 'repeat', str(i))} % {explain.PRIME} AS k{i}" for i in range(explain.ROUNDS * explain.DEGREE))


@register("I3_permutation_importance", f"""WITH RECURSIVE {S.CLS}, base_rows AS (SELECT id, y, order_month, order_year, {S.score_of()} AS signal FROM cls),
  placed AS (SELECT *, row_number() OVER (ORDER BY {S.hex_of('42', "'places'", 'id')}) - 1 AS place FROM base_rows),
  sides AS (SELECT n, a, (n + a - 1) // a AS b FROM (SELECT n, unnest(range(greatest(2, s // 2 + 1), greatest(2, 2 * s) + 1)) AS a
    FROM (SELECT count(*) AS n, floor(sqrt(count(*)))::BIGINT AS s FROM base_rows)) ORDER BY a * ((n + a - 1) // a), a LIMIT 1),
  keys AS (SELECT repeat, {ROUND_KEYS_SQL} FROM (SELECT range AS repeat FROM range(10))),
  walk AS ({_pass_sql('(SELECT place, place AS cell, place // b AS l, place % b AS r, n, a, b, keys.* FROM placed, sides, keys)')}
    UNION ALL {_pass_sql('(SELECT * REPLACE (cell // b AS l, cell % b AS r) FROM walk WHERE cell >= n)')}),
  donors AS (SELECT a.*, w.repeat, b.signal AS d_signal, b.order_month AS d_order_month, b.order_year AS d_order_year
    FROM walk w JOIN placed a ON a.place = w.cell JOIN placed b ON b.place = w.place WHERE w.cell < w.n),
  variants AS (SELECT y, repeat, 'signal' AS "column", {FORMULA_SQL.replace('signal', 'd_signal')} AS p FROM donors
    UNION ALL SELECT y, repeat, 'order_month', {FORMULA_SQL.replace('order_month', 'd_order_month')} FROM donors
    UNION ALL SELECT y, repeat, 'order_year', {FORMULA_SQL} FROM donors),
  scored_base AS (SELECT y, {FORMULA_SQL} AS p FROM base_rows), {S.evaluation('scored_base', 0.5, [], 'base')},
  {S.evaluation('variants', 0.5, ['"column"', 'repeat'], 'shuffled')}
  SELECT "column" AS feature, round(avg(b.pr_auc - s.pr_auc), 6) + 0.0 AS mean_ap_decrease,
    round(stddev_pop(b.pr_auc - s.pr_auc), 6) + 0.0 AS std_ap_decrease FROM shuffled s, base b GROUP BY "column" """)
def permutation_importance(spark, sf_dir):
    rows = B.with_score(B.cls(spark, sf_dir), name="signal").select("id", "y", "signal", "order_month", "order_year")
    return rounded(explain.permutation_importance(rows, _formula, ["signal", "order_month", "order_year"]))


COEFFICIENTS = {"totalprice": 1e-5, "acctbal": -1e-4, "order_year": 0.1, "order_month": 0.05}
CONTRIBUTIONS = f"""{S.CLS}, background AS (SELECT * FROM cls ORDER BY {S.hex_of('42', "'sample'", 'id')} LIMIT 100),
  means AS (SELECT {', '.join(f'avg({c}) AS {c}_m' for c in COEFFICIENTS)} FROM background),
  contributions AS (""" + " UNION ALL ".join(
    f"SELECT id, '{c}' AS feature, ({c} - {c}_m) * CAST('{b!r}' AS DOUBLE) AS contribution FROM cls, means" for c, b in COEFFICIENTS.items()) + ")"


def _background(cls):
    return split.sample_n(cls, 100)


@register("I4_linear_contributions", f"WITH {CONTRIBUTIONS} " + S.rounding("contributions", ["contribution"]))
def linear_contributions(spark, sf_dir):
    cls = B.cls(spark, sf_dir)
    return rounded(explain.linear_contributions(cls, COEFFICIENTS, _background(cls)))


@register("I4_mean_absolute", f"WITH {CONTRIBUTIONS} SELECT feature, round(avg(abs(contribution)), 6) + 0.0 AS mean_absolute FROM contributions GROUP BY feature")
def mean_absolute(spark, sf_dir):
    cls = B.cls(spark, sf_dir)
    return rounded(explain.mean_absolute(explain.linear_contributions(cls, COEFFICIENTS, _background(cls))))


@register("I5_top_contributions", f"""WITH {CONTRIBUTIONS}, folded AS (SELECT id, CASE WHEN feature LIKE 'order_%' THEN 'order_date' ELSE feature END AS source,
    sum(contribution) AS contribution FROM contributions GROUP BY 1, 2),
  ranked AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY abs(contribution) DESC, source) AS rank FROM folded)
  SELECT id, rank, source AS feature, round(contribution, 6) + 0.0 AS contribution,
    CASE WHEN contribution > 0 THEN 'Higher' WHEN contribution < 0 THEN 'Lower' ELSE 'Neutral' END AS direction,
    round(sum(CASE WHEN rank > 2 THEN contribution ELSE 0 END) OVER (PARTITION BY id), 6) + 0.0 AS other_contribution
  FROM ranked QUALIFY rank <= 2""")
def top_contributions(spark, sf_dir):
    cls = B.cls(spark, sf_dir)
    listed = explain.linear_contributions(cls, COEFFICIENTS, _background(cls))
    return rounded(explain.top_contributions(listed, {"order_year": "order_date", "order_month": "order_date"}, k=2))


@register("I6_check_additive", f"""WITH {CONTRIBUTIONS}, totals AS (SELECT id, sum(contribution) + (SELECT {' + '.join(
    f"{c}_m * CAST('{b!r}' AS DOUBLE)" for c, b in COEFFICIENTS.items())} - 200 FROM means) AS total FROM contributions GROUP BY id)
  SELECT id, round(total, 6) + 0.0 AS total, round(1 / (1 + exp(-total)), 6) + 0.0 AS probability, id % 10 <> 0 AS additive FROM totals""")
def check_additive(spark, sf_dir):
    cls = B.cls(spark, sf_dir)
    background = _background(cls)
    output = sum((F.col(c) * b for c, b in COEFFICIENTS.items()), F.lit(-200.0)) + F.when(F.col("id") % 10 == 0, 0.5).otherwise(0.0)
    listed = explain.linear_contributions(cls, COEFFICIENTS, background)
    return rounded(explain.check_additive(listed, explain.base_value(COEFFICIENTS, -200.0, background), cls.select("id", output.alias("output"))))


# ---- drift

CUT_DAY = "1998-07-01"
NUMERIC, CATEGORICAL = ["totalprice", "acctbal", "order_month"], ["priority", "segment"]
DRIFT_VIEWS = f"""{S.CLS_NULLS}, dated AS (SELECT c.*, o_orderdate < TIMESTAMP '{CUT_DAY}' AS early FROM cls_nulls c JOIN orders ON id = o_orderkey),
  drift_ref AS (SELECT id, totalprice, acctbal, order_month, priority, segment FROM dated WHERE early AND coalesce(segment, '') <> 'BUILDING'),
  drift_cur AS (SELECT id, CASE WHEN id % 3 = 0 THEN totalprice * 2 ELSE totalprice END AS totalprice, CAST(NULL AS DOUBLE) AS acctbal, order_month,
    priority, segment FROM dated WHERE NOT early)"""


def _drift(spark, sf_dir):
    """Earlier orders without one segment as the reference; later ones with raised prices and no balances as the present."""
    day = load(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), (F.col("o_orderdate") < F.lit(CUT_DAY).cast("timestamp")).alias("early"))
    dated = B.cls_nulls(spark, sf_dir).join(day, "id")
    reference = dated.where(F.col("early") & (F.coalesce("segment", F.lit("")) != "BUILDING"))
    present = dated.where(~F.col("early")).withColumn("totalprice", F.when(F.col("id") % 3 == 0, F.col("totalprice") * 2).otherwise(F.col("totalprice"))) \
        .withColumn("acctbal", F.lit(None).cast("double"))
    columns = ["id", *NUMERIC, *CATEGORICAL]
    return reference.select(*columns), present.select(*columns)


def _cuts(column: str) -> str:
    """The distinct deciles of one numeric column of drift_ref, as a list."""
    deciles = ", ".join(f"quantile_cont({column}, {i / 10})" for i in range(1, 10))
    return f"(SELECT list_sort(list_distinct([{deciles}])) FROM drift_ref)"


def _shares(source: str) -> str:
    """(feature, kind, bin, n) cells of a drift view, missing values as bin NULL."""
    numeric = [f"""SELECT '{c}' AS feature, 'numeric' AS kind, CASE WHEN {c} IS NOT NULL THEN CAST(len(list_filter(cuts_{c}.cuts, lambda x: x < {c})) AS VARCHAR) END AS bin,
      count(*) AS n FROM {source}, cuts_{c} GROUP BY ALL""" for c in NUMERIC]
    text = [f"SELECT '{c}' AS feature, 'categorical' AS kind, {c} AS bin, count(*) AS n FROM {source} GROUP BY ALL" for c in CATEGORICAL]
    return " UNION ALL ".join(numeric + text)


PROFILE = (DRIFT_VIEWS + ", " + ", ".join(f"cuts_{c} AS (SELECT {_cuts(c)} AS cuts)" for c in NUMERIC) + f""", ref_cells AS ({_shares('drift_ref')}),
  ref_totals AS (SELECT feature, kind, sum(n) AS n_rows, sum(CASE WHEN bin IS NOT NULL THEN n END) AS n_present FROM ref_cells GROUP BY ALL),
  spine AS (""" + " UNION ALL ".join(f"SELECT '{c}' AS feature, CAST(unnest(range(len(cuts) + 1)) AS VARCHAR) AS bin FROM cuts_{c}" for c in NUMERIC)
    + """ UNION ALL SELECT feature, bin FROM ref_cells WHERE kind = 'categorical' AND bin IS NOT NULL),
  profile AS (SELECT s.feature, t.kind, s.bin, coalesce(c.n, 0) / t.n_present AS share, 1 - t.n_present / t.n_rows AS missing_rate, CAST(t.n_rows AS BIGINT) AS n_rows
    FROM spine s JOIN ref_totals t ON s.feature = t.feature LEFT JOIN ref_cells c ON s.feature = c.feature AND s.bin = c.bin)""")


@register("J1_drift_profile", f"WITH {PROFILE} " + S.rounding("profile", ["share", "missing_rate"]))
def drift_profile(spark, sf_dir):
    table = drift.drift_profile(_drift(spark, sf_dir)[0], NUMERIC, CATEGORICAL)
    return rounded(table.where(F.col("bin").isNotNull()).select("feature", "kind", "bin", "share", "missing_rate", "n_rows"))


@register("J1_decile_cuts", f"WITH {PROFILE} " + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, unnest(range(len(cuts))) AS position, round(unnest(cuts), 4) + 0.0 AS cut FROM cuts_{c}" for c in NUMERIC))
def decile_cuts(spark, sf_dir):
    cuts = drift.decile_cuts(_drift(spark, sf_dir)[0], NUMERIC)
    return rounded(cuts.select("feature", F.posexplode("cuts").alias("position", "cut")), 4)


FIXED_CUTS = [50_000, 100_000, 200_000, 300_000, 1_000_000]


@register("J2_bin_shares", f"""WITH {S.CLS_NULLS}, cells AS (SELECT region, len(list_filter({FIXED_CUTS}, lambda c: c < totalprice)) AS bin, count(*) AS n
    FROM cls_nulls WHERE totalprice IS NOT NULL GROUP BY ALL), totals AS (SELECT region, sum(n) AS total FROM cells GROUP BY region)
  SELECT t.region, s.bin, round(coalesce(n, 0) / total, 6) + 0.0 AS share FROM totals t CROSS JOIN (SELECT range AS bin FROM range({len(FIXED_CUTS) + 1})) s
  LEFT JOIN cells c ON c.region = t.region AND c.bin = s.bin""")
def bin_shares(spark, sf_dir):
    return rounded(drift.bin_shares(B.cls_nulls(spark, sf_dir), "totalprice", FIXED_CUTS, ["region"]))


def _psi_sql(e: str, a: str) -> str:
    return f"(greatest({a}, 1e-4) - greatest({e}, 1e-4)) * ln(greatest({a}, 1e-4) / greatest({e}, 1e-4))"


SHARE_PAIRS = f"""{S.CLS}, shares AS (SELECT segment, priority, avg(CASE WHEN y = 0 THEN 1.0::DOUBLE ELSE 0 END) AS x,
    sum(CASE WHEN y = 0 THEN 1 ELSE 0 END) / (sum(sum(CASE WHEN y = 0 THEN 1 ELSE 0 END)) OVER (PARTITION BY segment)) AS expected,
    sum(CASE WHEN y = 1 AND priority < '4' THEN 1 ELSE 0 END) / (sum(sum(CASE WHEN y = 1 AND priority < '4' THEN 1 ELSE 0 END)) OVER (PARTITION BY segment)) AS actual
  FROM cls GROUP BY segment, priority)"""


def _share_pairs(spark, sf_dir):
    from pyspark.sql import Window
    counts = B.cls(spark, sf_dir).groupBy("segment", "priority").agg(
        F.sum(1 - F.col("y")).alias("e"), F.sum(F.when((F.col("y") == 1) & (F.col("priority") < "4"), 1).otherwise(0)).alias("a"))
    whole = Window.partitionBy("segment")
    return counts.select("segment", "priority", (F.col("e") / F.sum("e").over(whole)).alias("expected"), (F.col("a") / F.sum("a").over(whole)).alias("actual"))


@register("J3_psi", f"WITH {SHARE_PAIRS} SELECT segment, round(sum({_psi_sql('expected', 'actual')}), 6) + 0.0 AS psi FROM shares GROUP BY segment")
def psi(spark, sf_dir):
    return rounded(drift.psi(_share_pairs(spark, sf_dir), ["segment"]))


@register("J4_drift_status", f"""WITH {SHARE_PAIRS}, terms AS (SELECT segment, priority, {_psi_sql('expected', 'actual')} AS psi FROM shares)
  SELECT segment, priority, CASE WHEN psi >= 0.25 THEN 'shift' WHEN psi >= 0.1 THEN 'moderate' ELSE 'stable' END AS status FROM terms""")
def drift_status(spark, sf_dir):
    terms = drift.psi(_share_pairs(spark, sf_dir), ["segment", "priority"])
    return terms.select("segment", "priority", drift.drift_status(F.col("psi")).alias("status"))


REPORT = (PROFILE + f""", cur_cells AS ({_shares('drift_cur')}), cur_totals AS (
    SELECT feature, sum(n) AS n_now, sum(CASE WHEN bin IS NOT NULL THEN n END) AS present_now FROM cur_cells GROUP BY feature),
  pairs AS (SELECT p.feature, p.share AS expected, coalesce(c.n, 0) / t.present_now AS actual FROM profile p JOIN cur_totals t ON p.feature = t.feature
    LEFT JOIN cur_cells c ON c.feature = p.feature AND c.bin = p.bin
    UNION ALL SELECT t.feature, 0, coalesce((SELECT sum(n) FROM cur_cells c WHERE c.feature = t.feature AND c.bin IS NOT NULL AND c.bin NOT IN (
      SELECT bin FROM profile p WHERE p.feature = t.feature)), 0) / t.present_now FROM cur_totals t WHERE t.feature IN ({', '.join(repr(c) for c in CATEGORICAL)})),
  terms AS (SELECT feature, CASE WHEN count(actual) > 0 THEN sum({_psi_sql('expected', 'actual')}) END AS psi FROM pairs GROUP BY feature),
  report AS (SELECT r.feature, r.kind, psi, CASE WHEN psi IS NULL THEN 'no data' WHEN psi >= 0.25 THEN 'shift' WHEN psi >= 0.1 THEN 'moderate' ELSE 'stable' END AS status,
    1 - r.n_present / r.n_rows AS reference_missing_rate, 1 - coalesce(present_now, 0) / n_now AS current_missing_rate,
    CASE WHEN r.kind = 'categorical' THEN (SELECT actual FROM pairs p WHERE p.feature = r.feature AND expected = 0) END AS unseen_share
    FROM ref_totals r JOIN cur_totals c ON r.feature = c.feature JOIN terms t ON r.feature = t.feature)""")


@register("J5_drift_report", f"WITH {REPORT} " + S.rounding("report", ["psi", "reference_missing_rate", "current_missing_rate", "unseen_share"]))
def drift_report(spark, sf_dir):
    reference, present = _drift(spark, sf_dir)
    return rounded(drift.drift_report(present, materialize(drift.drift_profile(reference, NUMERIC, CATEGORICAL))))


@register("J6_drift_gate", f"""WITH {REPORT} SELECT count(CASE WHEN status = 'shift' THEN 1 END) AS shift, count(CASE WHEN status = 'moderate' THEN 1 END) AS moderate,
  count(CASE WHEN status = 'stable' THEN 1 END) AS stable, count(CASE WHEN status = 'no data' THEN 1 END) AS no_data,
  count(CASE WHEN status = 'shift' THEN 1 END) > 0 AS gate_failed, (SELECT count(*) FROM drift_cur) < 100 AS small_sample FROM report""")
def drift_gate(spark, sf_dir):
    reference, present = _drift(spark, sf_dir)
    report = drift.drift_report(present, materialize(drift.drift_profile(reference, NUMERIC, CATEGORICAL)))
    return drift.drift_gate(report, present.count())


# ---- integrity

CHANGED = f"""{S.CLS_NULLS}, older AS (SELECT id, totalprice, acctbal, segment FROM cls_nulls WHERE id % 23 <> 0),
  newer AS (SELECT id, CASE WHEN id % 7 = 0 THEN totalprice * (1 + 1e-9) WHEN id % 29 = 0 THEN totalprice * 1.01 ELSE totalprice END AS totalprice, acctbal,
    CASE WHEN id % 31 = 0 THEN 'OTHER' ELSE segment END AS segment FROM cls_nulls WHERE id % 37 <> 0)"""


def _versions(spark, sf_dir):
    rows = B.cls_nulls(spark, sf_dir).select("id", "totalprice", "acctbal", "segment")
    newer = rows.where(F.col("id") % 37 != 0).select(
        "id", F.when(F.col("id") % 7 == 0, F.col("totalprice") * (1 + 1e-9)).when(F.col("id") % 29 == 0, F.col("totalprice") * 1.01)
        .otherwise(F.col("totalprice")).alias("totalprice"), "acctbal",
        F.when(F.col("id") % 31 == 0, "OTHER").otherwise(F.col("segment")).alias("segment"))
    return rows.where(F.col("id") % 23 != 0), newer


@register("K1_table_diff", f"""WITH {CHANGED}, joined AS (SELECT o.id AS oid, n.id AS nid, o.totalprice AS op, n.totalprice AS np, o.acctbal AS oa, n.acctbal AS na,
    o.segment AS os, n.segment AS ns FROM older o FULL OUTER JOIN newer n ON o.id = n.id), report AS (
  SELECT 'id' AS "column", 'missing rows' AS problem, count(*) AS n_rows FROM joined WHERE nid IS NULL UNION ALL
  SELECT 'id', 'unexpected rows', count(*) FROM joined WHERE oid IS NULL UNION ALL
  SELECT 'totalprice', 'values differ', count(*) FROM joined WHERE oid IS NOT NULL AND nid IS NOT NULL
    AND NOT coalesce(abs(op - np) <= 1e-9 + 1e-6 * abs(np), op IS NOT DISTINCT FROM np) UNION ALL
  SELECT 'acctbal', 'values differ', count(*) FROM joined WHERE oid IS NOT NULL AND nid IS NOT NULL
    AND NOT coalesce(abs(oa - na) <= 1e-9 + 1e-6 * abs(na), oa IS NOT DISTINCT FROM na) UNION ALL
  SELECT 'segment', 'values differ', count(*) FROM joined WHERE oid IS NOT NULL AND nid IS NOT NULL AND os IS DISTINCT FROM ns)
  SELECT * FROM report WHERE n_rows > 0""")
def table_diff(spark, sf_dir):
    older, newer = _versions(spark, sf_dir)
    return integrity.table_diff(older, newer, ["id"])


@register("K2_record_diff", f"""WITH {S.CLS}, leaves AS (
    SELECT region, '/record/first' AS path, 'value differs' AS problem, CAST(min(id) AS VARCHAR) AS old, CAST(min(id) + 1 AS VARCHAR) AS new FROM cls GROUP BY region
    UNION ALL SELECT region, '/record/flag', 'type differs', 'true', '1' FROM cls GROUP BY region
    UNION ALL SELECT region, '/record/counts/extra', 'unexpected', NULL, '0' FROM cls GROUP BY region
    UNION ALL SELECT region, '/record/span[1]', 'value differs', CAST(max(id) AS VARCHAR), CAST(2 * max(id) AS VARCHAR) FROM cls GROUP BY region)
  SELECT region, path, problem, old, new FROM leaves""")
def record_diff(spark, sf_dir):
    def record(first, flag, counts, last, stamp):
        return F.struct(first.alias("first"), flag.alias("flag"), counts.alias("counts"), F.array(F.min("id"), last).alias("span"), stamp.alias("stamp"))

    groups = B.cls(spark, sf_dir).groupBy("region")
    plain = F.create_map(F.lit("n"), F.count(F.lit(1)))
    more = F.create_map(F.lit("n"), F.count(F.lit(1)), F.lit("extra"), F.lit(0).cast("long"))
    old = groups.agg(record(F.min("id"), F.lit(True), plain, F.max("id"), F.lit("monday")).alias("record"))
    new = groups.agg(record(F.min("id") + 1, F.lit(1), more, F.max("id") * 2, F.lit("tuesday")).alias("record"))
    return integrity.record_diff(old, new, "region", ignore=["stamp"])


@register("K3_set_diff", f"""WITH {CHANGED} SELECT id, 'missing' AS problem FROM older WHERE id NOT IN (SELECT id FROM newer) UNION ALL
  SELECT id, 'unexpected' FROM newer WHERE id NOT IN (SELECT id FROM older)""")
def set_diff(spark, sf_dir):
    older, newer = _versions(spark, sf_dir)
    return integrity.set_diff(older, newer, "id")


PRINTED = {"o_orderkey": "bigint", "o_custkey": "bigint", "o_orderstatus": "string", "o_totalprice": "double", "o_orderdate": "timestamp_ntz",
           "o_orderpriority": "string"}


@register("K4_fingerprint", "WITH cells AS (SELECT md5(" + " || '|' || ".join(
    f"coalesce(length(CAST({c} AS VARCHAR)) || '=' || CAST({c} AS VARCHAR), '~')" for c in PRINTED) + ") AS h FROM orders) SELECT count(*) AS n_rows, "
    + " || '-' || ".join(f"coalesce(CAST(sum(CAST('0x' || substr(h, {at}, 8) AS BIGINT)) AS VARCHAR), '0')" for at in (1, 9, 17, 25)) + " AS digest, "
    + "md5('" + "|".join(f"{c}:{t}" for c, t in PRINTED.items()) + "') AS schema_digest FROM cells")
def fingerprint(spark, sf_dir):
    return integrity.fingerprint(load(spark, sf_dir, "orders"))


@register("K5_coverage_check", f"""WITH {S.LABELLED}, folds AS (SELECT id, {S.fold_of()} AS fold FROM labelled),
  predictions AS (SELECT id, fold FROM folds WHERE fold <> 3 UNION ALL SELECT id, fold FROM folds WHERE fold = 1
    UNION ALL SELECT -id, fold FROM folds WHERE fold = 2), counted AS (SELECT id, count(*) AS got FROM predictions GROUP BY id)
  SELECT (SELECT count(*) FROM labelled l WHERE NOT EXISTS (SELECT 1 FROM predictions p WHERE p.id = l.id)) AS missing,
    (SELECT count(DISTINCT id) FROM predictions p WHERE NOT EXISTS (SELECT 1 FROM labelled l WHERE p.id = l.id)) AS unexpected,
    (SELECT CAST(sum(got - 1) AS BIGINT) FROM counted) AS repeated, 5 - (SELECT count(DISTINCT fold) FROM predictions) AS missing_folds""")
def coverage_check(spark, sf_dir):
    folded = split.stratified_folds(B.labelled(spark, sf_dir)).select("id", "fold")
    predictions = folded.where("fold <> 3").unionByName(folded.where("fold = 1")).unionByName(
        folded.where("fold = 2").withColumn("id", -F.col("id")))
    return rounded(integrity.coverage_check(predictions, folded))


@register("K6_recheck", f"WITH {S.SCORED_GROUPS}, {S.evaluation('scored', 0.5, ['segment'])}, long AS (" + " UNION ALL ".join(
    f"SELECT segment, '{m}' AS metric, {m} AS recomputed FROM evaluation" for m in S.EVALUATION_DOUBLES)
    + """) SELECT segment, metric, round(recomputed + CASE WHEN metric = 'recall' AND segment = 'BUILDING' THEN 0.01 ELSE 0 END, 6) + 0.0 AS recorded,
  round(recomputed, 6) + 0.0 AS recomputed, NOT (metric = 'recall' AND segment = 'BUILDING') AS agrees FROM long""")
def recheck(spark, sf_dir):
    scores = B.scored(spark, sf_dir, True)
    kept = list(S.EVALUATION_DOUBLES)
    recorded = metrics.evaluate(scores, 0.5, ["segment"]).select("segment", *kept).unpivot(["segment"], kept, "metric", "value")
    off = (F.col("metric") == "recall") & (F.col("segment") == "BUILDING")
    return rounded(integrity.recheck(scores, recorded.withColumn("value", F.col("value") + F.when(off, 0.01).otherwise(0.0)), 0.5, ["segment"]))
