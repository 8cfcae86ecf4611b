"""The three whole runs: train and report, score a batch, check drift.

Selection stages get training rows only; the holdout is touched once, after model and threshold are frozen.
Every result is written as a report table under root/<name>/run_id=<run>.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from binoscope.functions.scalars import same_keys
from binoscope.operators import checks, drift, experiments, explain, metrics, models, profile, selection, split
from binoscope.operators.bootstrap import bootstrap_ci, subgroup_ci
from binoscope.sources.sinks import read_report, write_report
from binoscope.spec import TableSpec

PROFILE_TABLE = "drift_profile"


@dataclass
class TrainingResult:
    run_id: str
    selected_model: str
    threshold: float
    model: models.FittedModel
    model_path: str
    metrics: dict


def training_run(raw: DataFrame, spec: TableSpec, root: str, run_id: str, plans: Sequence[models.ModelPlan] | None = None,
                 formulas: Mapping[str, tuple[str, str, float]] | None = None, ablations: Mapping[str, Sequence[str]] | None = None,
                 attributes: Sequence[str] = (), seeds: Sequence[int] = (42, 43, 44), folds: int = 5, n_boot: int = 1000,
                 repeats: int = 10, nested_outer: int = 0, seed: int = 42) -> TrainingResult:
    """Validate, split, profile, compare, choose, diagnose, evaluate the holdout, and write every table and the model."""
    plans = models.candidates() if plans is None else list(plans)
    features = models.Features(tuple(spec.numeric), tuple(spec.categorical))

    def report(name: str, table: DataFrame) -> None:
        write_report(table, root, run_id, name)

    checks.validate(raw, spec)
    encoded = checks.encode_label(checks.normalize_missing(raw), spec.label, spec.labels)
    table = encoded.select(F.col(spec.key).alias("id"), "y", *[c for c in spec.features if c not in ("id", "y")])
    report("data_audit", profile.audit(raw))
    parts = split.stratified_split(table, share=split.HOLDOUT_SHARE, seed=seed).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        checks.check_class_sizes(profile.target_distribution(parts.where("partition = 'train'")))
        checks.check_class_sizes(profile.target_distribution(parts.where("partition = 'test'")))
        report("split_manifest", split.split_manifest(parts))
        train, test = parts.where("partition = 'train'").drop("partition"), parts.where("partition = 'test'").drop("partition")

        # Training rows only from here on.
        report("summary_statistics", profile.describe_numeric(train, spec.numeric))
        report("target_distribution", profile.target_distribution(train))
        report("category_target_rates", profile.target_rates(train, spec.features, spec.categorical))
        report("numeric_by_target", profile.numeric_by_target(train, spec.numeric))
        report("iqr_outlier_counts", profile.iqr_outliers(train, spec.numeric))
        report("numeric_correlations", profile.correlation_matrix(train, spec.numeric))
        report(PROFILE_TABLE, drift.drift_profile(train, spec.numeric, spec.categorical))

        variants: dict[str, models.Features] = {f"logistic_without_{name}": features.without(columns) for name, columns in (ablations or {}).items()}
        if formulas:
            variants["logistic_engineered"] = models.Features(features.numeric, features.categorical, dict(formulas))
        every = [*plans, *[models.logistic(name=name) for name in variants]]
        folded = split.stratified_folds(train, k=folds, seed=seed)
        scores, per_fold = selection.compare_models(folded, every, {p.name: variants.get(p.name, features) for p in every}, seed)
        report("cv_fold_metrics", per_fold)
        summary = metrics.fold_summary(per_fold)
        report("cv_summary", summary)
        if variants:
            report("ablation", experiments.ablation(per_fold, "logistic_regression", list(variants)))
        names = [p.name for p in plans]
        order = F.create_map(*[F.lit(x) for i, name in enumerate(names) for x in (name, i)])
        means = summary.where((F.col("metric") == "pr_auc") & F.col("model").isin(*names)).withColumn("position", order[F.col("model")])
        selected = experiments.select_model(means).first()["selected_model"]
        plan = next(p for p in plans if p.name == selected)
        oof = scores.where(F.col("model") == selected)
        thresholds = metrics.threshold_table(oof)
        threshold = metrics.chosen_threshold(thresholds)
        report("threshold_analysis", thresholds)
        report("oof_predictions", oof.select("id", "y", "fold", "p"))

        calibrated = models.calibration_oof(folded, plan, features, seed=seed)
        report("calibration_metrics", metrics.calibration_scores(calibrated))
        report("calibration_bins", metrics.reliability(calibrated, by=["method"]))
        by_seed = scores.where(F.col("model").isin(*names)).withColumn("seed", F.lit(seed).cast("long"))
        for other in seeds:
            if other != seed:
                again = models.oof_scores(split.stratified_folds(train, k=folds, seed=other), plans, features, seed)
                by_seed = by_seed.unionByName(again.withColumn("seed", F.lit(other).cast("long")))
        choices = experiments.seed_choices(by_seed)
        report("stability_selections", choices)
        report("stability_summary", experiments.stability_summary(choices))
        if nested_outer:
            nested = selection.nested_cv(train, plans, features, nested_outer, seed=seed)
            report("nested_cv_folds", nested)
            report("nested_cv_summary", experiments.nested_summary(nested))

        # Model and threshold are frozen: the holdout is scored.
        fitted = [models.fit(train, p, features, seed=seed) for p in plans]
        model = next(m for m in fitted if m.name == selected)
        held_out = models.score_all(test, fitted, keep=["id", "y"])
        report("model_comparison", metrics.evaluate(held_out, by=["model"]))
        chosen = held_out.where(F.col("model") == selected).select("id", "y", "p")
        final = metrics.evaluate(chosen, threshold)
        report("holdout_metrics", final)
        report("capacity_metrics", metrics.capacity(oof).withColumn("partition", F.lit("training_oof")).unionByName(
            metrics.capacity(chosen).withColumn("partition", F.lit("holdout"))))
        report("holdout_bootstrap_ci", bootstrap_ci(chosen, threshold, n_boot, seed=seed))
        if attributes:
            grouped = chosen.join(test.select("id", *attributes), "id")
            intervals = subgroup_ci(grouped, attributes, threshold, n_boot, seed=seed)
            report("subgroup_metrics", same_keys(metrics.subgroups(grouped, attributes, threshold), intervals, ["attribute", "group"]))
        report("permutation_importance", explain.permutation_importance(
            test.select("id", "y", *features.columns), model.score, features.columns, repeats, seed))
        for m in fitted:
            if hasattr(m.estimator, "coefficients"):
                report(f"{m.name}_coefficients", models.coefficients(raw.sparkSession, m))
            elif hasattr(m.estimator, "featureImportances"):
                report(f"{m.name}_importance", models.importances(raw.sparkSession, m))
        path = f"{root.rstrip('/')}/models/{run_id}"
        model.save(path)
        return TrainingResult(run_id, selected, threshold, model, path, final.first().asDict())
    finally:
        parts.unpersist()


def scoring_run(records: DataFrame, spec: TableSpec, model: models.FittedModel, threshold: float, run_id: str) -> DataFrame:
    """Check the fields, let new categories through, score, label; one row out per row in."""
    checks.validate(records, spec, mode="score")
    features = models.Features(tuple(spec.numeric), tuple(spec.categorical))
    keep = [spec.key] if spec.key in records.columns else []
    return models.score_batch(records, model, threshold, run_id, features, keep)


def drift_run(records: DataFrame, spec: TableSpec, root: str, run_id: str) -> tuple[DataFrame, DataFrame]:
    """(report, gate) of new rows against the profile stored by a training run."""
    checks.validate(records, spec, mode="score")
    stored = read_report(records.sparkSession, root, PROFILE_TABLE, run_id).drop("run_id")
    report = drift.drift_report(checks.normalize_missing(records), stored)
    return report, drift.drift_gate(report, records.count())


def load_run_model(spark: SparkSession, root: str, run_id: str, name: str) -> models.FittedModel:
    return models.load_model(name, f"{root.rstrip('/')}/models/{run_id}")
