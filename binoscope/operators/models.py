"""Fitting and batch scoring with Spark ML; everything fitted is a PipelineModel that saves and loads as one.

The feature part of a pipeline holds only transformers: its statistics are computed by the exact operators of
`prepare` and written into an SQL projection, so scoring needs no join and no Python.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import inheritable_thread_target
from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegressionModel
from pyspark.ml.feature import OneHotEncoder, SQLTransformer, StringIndexerModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from binoscope.functions.scalars import melt, sigmoid
from binoscope.operators import boost, forest as forests, newton
from binoscope.operators.checks import normalize_missing
from binoscope.operators.metrics import check_threshold, label_at
from binoscope.operators.order import exact_quantiles
from binoscope.operators.prepare import EMPTY_LEVEL, fit_statistics, modes_and_levels, ratio_features, row_mean
from binoscope.operators.split import stratified_folds
from binoscope.session import held as kept_rows, materialize

# Independent fits submitted at the same time; each is its own chain of Spark jobs.
PARALLEL_FITS = 4


@dataclass(frozen=True)
class Features:
    """What goes into a model: numeric and categorical columns, and engineered ones.

    formulas: name -> (a, b, shift) = a / (b + shift); means: name -> columns, the mean of their present cells. Their
    sources are read whether or not they are features themselves.
    """

    numeric: tuple[str, ...]
    categorical: tuple[str, ...]
    formulas: Mapping[str, tuple[str, str, float]] = field(default_factory=dict)
    means: Mapping[str, tuple[str, ...]] = field(default_factory=dict)

    def without(self, exclude: Sequence[str]) -> Features:
        """Without these features, engineered ones included; an excluded source still feeds the formulas that use it."""
        return Features(*[tuple(c for c in own if c not in exclude) for own in (self.numeric, self.categorical)],
                        *[{n: v for n, v in own.items() if n not in exclude} for own in (self.formulas, self.means)])

    @property
    def numbers(self) -> list[str]:
        """All numeric features, engineered ones last."""
        return [*self.numeric, *self.formulas, *self.means]

    @property
    def columns(self) -> list[str]:
        """The columns that are read."""
        sources = [c for a, b, _ in self.formulas.values() for c in (a, b)] + [c for own in self.means.values() for c in own]
        return list(dict.fromkeys([*self.numeric, *self.categorical, *sources]))


@dataclass(frozen=True)
class ModelPlan:
    """An unfitted model: family, parameters, and whether numerics are scaled."""

    name: str
    family: str
    params: Mapping[str, object] = field(default_factory=dict)
    scale: bool = False
    balanced: bool = False


def prior() -> ModelPlan:
    return ModelPlan("dummy", "prior")


def logistic(C: float = 1.0, balanced: bool = False, name: str | None = None) -> ModelPlan:
    return ModelPlan(name or ("logistic_balanced" if balanced else "logistic_regression"), "logistic_regression",
                     {"C": C}, scale=True, balanced=balanced)


def forest(trees: int = 250, depth: int = 7, leaf: int = 5, features: str = "sqrt", balanced: bool = True,
           name: str = "random_forest") -> ModelPlan:
    return ModelPlan(name, "random_forest", {"trees": trees, "depth": depth, "leaf": leaf, "features": features}, balanced=balanced)


def boosting(rounds: int = 150, rate: float = 0.05, leaves: int = 7, leaf: int = 20, l2: float = 0.0, balanced: bool = False,
             name: str = "gradient_boosting") -> ModelPlan:
    """Trees of at most `leaves` leaves, the best split first; `l2` penalises leaf values."""
    return ModelPlan(name, "gradient_boosting", {"rounds": rounds, "rate": rate, "leaves": leaves, "leaf": leaf, "l2": l2}, balanced=balanced)


def candidates(trees: int = 250, rounds: int = 150) -> list[ModelPlan]:
    """The fixed models that are compared, simplest first."""
    return [prior(), logistic(), logistic(balanced=True), forest(trees=trees), boosting(rounds=rounds)]


@dataclass
class FittedModel:
    name: str
    pipeline: PipelineModel
    feature_names: list[str]

    def score(self, df: DataFrame) -> DataFrame:
        """The input columns plus p, one row out for every row in."""
        made = self.pipeline.transform(df)
        p = vector_to_array("probability")[1] if "probability" in made.columns else F.col("p")
        return made.select(*[F.col(f"`{c}`") for c in df.columns if c != "p"], p.alias("p"))

    def margin(self, df: DataFrame) -> DataFrame:
        """The input columns plus the raw margin, or the probability for models without one, as forests saved by Spark ML."""
        made = self.pipeline.transform(df)
        raw = vector_to_array("rawPrediction" if self.name_of_stage() != "RandomForestClassificationModel" else "probability")[1]
        return made.select(*df.columns, raw.alias("margin"))

    def name_of_stage(self) -> str:
        return type(self.pipeline.stages[-1]).__name__

    @property
    def estimator(self):
        return self.pipeline.stages[-1]

    def save(self, path: str) -> None:
        self.pipeline.write().save(path)


@dataclass
class FittedBooster(FittedModel):
    """A boosted model: the pipeline makes the engineered columns, the booster reads the raw ones."""

    booster: boost.Booster | None = None

    def score(self, df: DataFrame) -> DataFrame:
        return self.margin(df).select(*[F.col(f"`{c}`") for c in df.columns if c != "p"], sigmoid(F.col("margin")).alias("p"))

    def margin(self, df: DataFrame) -> DataFrame:
        made = self.booster.margin(self.pipeline.transform(df), "__margin")
        return made.select(*[F.col(f"`{c}`") for c in df.columns if c != "margin"], F.col("__margin").alias("margin"))

    @property
    def estimator(self):
        return self.booster

    def name_of_stage(self) -> str:
        return type(self.booster).__name__

    def save(self, path: str) -> None:
        super().save(path)
        self.booster.save(SparkSession.active(), f"{path.rstrip('/')}/{BOOSTER}")


@dataclass
class FittedForest(FittedModel):
    """A forest: the pipeline makes the engineered columns, the forest reads the raw ones."""

    forest: forests.Forest | None = None

    def score(self, df: DataFrame) -> DataFrame:
        made = self.forest.score(self.pipeline.transform(df), "__p")
        return made.select(*[F.col(f"`{c}`") for c in df.columns if c != "p"], F.col("__p").alias("p"))

    def margin(self, df: DataFrame) -> DataFrame:
        """The input columns plus the probability, as a forest has no other margin."""
        made = self.forest.score(self.pipeline.transform(df), "__p")
        return made.select(*[F.col(f"`{c}`") for c in df.columns if c != "margin"], F.col("__p").alias("margin"))

    @property
    def estimator(self):
        return self.forest

    def name_of_stage(self) -> str:
        return type(self.forest).__name__

    def save(self, path: str) -> None:
        super().save(path)
        self.forest.save(SparkSession.active(), f"{path.rstrip('/')}/{FOREST}")


BOOSTER, FOREST = "booster", "forest"


def load_model(name: str, path: str, feature_names: Sequence[str] = ()) -> FittedModel:
    spark = SparkSession.active()
    for folder, kind, own in ((BOOSTER, FittedBooster, boost.Booster), (FOREST, FittedForest, forests.Forest)):
        place = f"{path.rstrip('/')}/{folder}"
        there = spark._jvm.org.apache.hadoop.fs.Path(place)
        if there.getFileSystem(spark._jsc.hadoopConfiguration()).exists(there):
            return kind(name, PipelineModel.load(path), list(feature_names), own.load(spark, place))
    return FittedModel(name, PipelineModel.load(path), list(feature_names))


def _sql_number(value: float) -> str:
    return f"CAST('{float(value)!r}' AS DOUBLE)"


def _sql_text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def with_formulas(df: DataFrame, features: Features) -> DataFrame:
    """NaN to null on the numerics, then the engineered columns."""
    clean = normalize_missing(df)
    clean = ratio_features(clean, features.formulas) if features.formulas else clean
    for name, columns in features.means.items():
        clean = row_mean(clean, columns, name)
    return clean


def statistics_by_fold(df: DataFrame, features: Features, folds: int, fold: str = "fold") -> dict[object, dict[str, dict]]:
    """{fold: {'numeric': {feature: (median, mean, scale)}, 'categorical': {feature: (mode, levels)}}}.

    Each fold's entry is learned from the rows outside it; O(folds x features) numbers reach the driver.
    """
    ready = with_formulas(df, features)
    tables = fit_statistics(ready, features.numbers, features.categorical, folds, fold)
    found: dict[object, dict[str, dict]] = {}
    for row in tables["numeric"].collect() if "numeric" in tables else []:
        found.setdefault(row[fold], {}).setdefault("numeric", {})[row["feature"]] = (row["median"], row["mean"], row["scale"])
    for row in tables["categorical"].collect() if "categorical" in tables else []:
        found.setdefault(row[fold], {}).setdefault("categorical", {})[row["feature"]] = (row["mode"], row["levels"])
    return found


def statistics_of(df: DataFrame, features: Features) -> dict[str, dict]:
    """The same statistics from all the given rows."""
    ready = with_formulas(df, features)
    found: dict[str, dict] = {}
    numeric = features.numbers
    if numeric:
        long = melt(ready, [], numeric)
        medians = {r["feature"]: r["median"] for r in exact_quantiles(long, ["feature"], "value", {"median": 0.5}).collect()}
        filled = ready.agg(*[f(F.coalesce(F.col(c).cast("double"), F.lit(float(medians.get(c) or 0.0)))).alias(f"{k}_{i}")
                             for i, c in enumerate(numeric) for k, f in (("m", F.avg), ("s", F.stddev_pop))]).first()
        found["numeric"] = {c: (medians.get(c) or 0.0, filled[f"m_{i}"], filled[f"s_{i}"] or 1.0) for i, c in enumerate(numeric)}
    if features.categorical:
        cells = melt(ready, [], features.categorical, "string").groupBy("feature", "value").agg(F.count(F.lit(1)).alias("n"))
        found["categorical"] = {r["feature"]: (r["mode"], r["levels"]) for r in modes_and_levels(cells, []).collect()}
    return found


def engineering_stage(features: Features) -> SQLTransformer | None:
    """The engineered columns as a projection of the raw ones, or None without any."""
    made = []
    for name, (a, b, shift) in features.formulas.items():
        made.append(f"try_divide(try_cast(CAST(`{a}` AS STRING) AS DOUBLE), try_cast(CAST(`{b}` AS STRING) AS DOUBLE) "
                    f"+ {_sql_number(shift)}) AS `{name}`")
    for name, columns in features.means.items():
        cells = [f"nanvl(CAST(`{c}` AS DOUBLE), NULL)" for c in columns]
        total = " + ".join(f"coalesce({c}, CAST(0 AS DOUBLE))" for c in cells)
        present = " + ".join(f"CAST({c} IS NOT NULL AS INT)" for c in cells)
        made.append(f"try_divide({total}, {present}) AS `{name}`")
    return SQLTransformer(statement=f"SELECT *, {', '.join(made)} FROM __THIS__") if made else None


def feature_stages(features: Features, statistics: Mapping[str, dict], scale: bool) -> tuple[list, list[str]]:
    """Transformers from raw columns to `features`, and the readable name of every vector slot."""
    numeric, engineered = features.numbers, engineering_stage(features)
    cells = []
    for name in numeric:
        median, mean, spread = statistics["numeric"][name]
        value = f"CAST(`{name}` AS DOUBLE)"
        filled = f"coalesce(CASE WHEN isnan({value}) THEN NULL ELSE {value} END, {_sql_number(median)})"
        cells.append((f"({filled} - {_sql_number(mean)}) / {_sql_number(spread)}" if scale else filled) + f" AS `{name}__x`")
    for name in features.categorical:
        mode, levels = statistics["categorical"][name]
        cells.append(f"coalesce(`{name}`, {_sql_text(mode)}) AS `{name}__c`")
    stages: list = [engineered] if engineered else []
    stages.append(SQLTransformer(statement=f"SELECT *, {', '.join(cells)} FROM __THIS__"))
    names, inputs = list(numeric), [f"{c}__x" for c in numeric]
    if features.categorical:
        levels = [list(statistics["categorical"][c][1]) or [EMPTY_LEVEL] for c in features.categorical]
        stages.append(StringIndexerModel.from_arrays_of_labels(
            levels, inputCols=[f"{c}__c" for c in features.categorical], outputCols=[f"{c}__i" for c in features.categorical],
            handleInvalid="keep"))
        # With handleInvalid=keep the extra slot for unseen values is last, and dropLast removes exactly that one.
        stages.append(OneHotEncoder(inputCols=[f"{c}__i" for c in features.categorical],
                                    outputCols=[f"{c}__h" for c in features.categorical], dropLast=True))
        inputs += [f"{c}__h" for c in features.categorical]
        names += [f"{c}_{v}" for c, vs in zip(features.categorical, levels) for v in vs]
    stages.append(VectorAssembler(inputCols=inputs, outputCol="features"))
    return stages, names


def _with_coefficients(spark: SparkSession, values: Sequence[float]) -> LogisticRegressionModel:
    """A Spark ML model of a solved regression: the intercept first, then the coefficients."""
    jvm = spark._jvm
    vector = jvm.org.apache.spark.ml.linalg.Vectors.dense(float(values[1]), spark._sc._gateway.new_array(jvm.double, 0)) if len(values) == 2 else \
        jvm.org.apache.spark.ml.linalg.Vectors.dense(float(values[1]), _doubles(spark, values[2:]))
    made = LogisticRegressionModel(jvm.org.apache.spark.ml.classification.LogisticRegressionModel(f"newton_{uuid.uuid4().hex[:12]}", vector, float(values[0])))
    return made


def _doubles(spark: SparkSession, values: Sequence[float]):
    array = spark._sc._gateway.new_array(spark._jvm.double, len(values))
    for i, v in enumerate(values):
        array[i] = float(v)
    return array


def _fitted_stages(rows: DataFrame, plan: ModelPlan, features: Features, statistics: Mapping[str, dict]) -> tuple[list, list[str], DataFrame]:
    """Fitted feature transformers, slot names, and the transformed rows."""
    stages, names = feature_stages(features, statistics, plan.scale)
    fitted, made = [], rows
    for stage in stages:
        # The encoder reads the level counts from column metadata; no job runs.
        stage = stage.fit(made) if isinstance(stage, OneHotEncoder) else stage
        fitted.append(stage)
        made = stage.transform(made)
    return fitted, names, made


Fits = Sequence[tuple[ModelPlan, Features, int | None]]         # plans over the same features, with the fold each must not see
Scorer = Callable[[Sequence[pa.Array], int, Sequence[int]], np.ndarray]     # (cells of a batch, its rows, which fits) -> (rows, fits) scores


def _solve(rows: DataFrame, fits: Fits, statistics, counts, fold: str | None) -> tuple[list, Scorer]:
    """Regressions in common Newton passes: their coefficients, and how to score raw cells by them."""
    features = fits[0][1]
    members = [newton.Member(float(plan.params["C"]), plan.balanced, held) for plan, _, held in fits]
    found = newton.fit_logistics(with_formulas(rows, features), members, features.numbers, features.categorical, statistics, counts, fold)
    return found, newton.probabilities(members, found, features.numbers, features.categorical, statistics)


def _solved(rows: DataFrame, fits: Fits, statistics, counts, fold: str | None = None) -> list[FittedModel]:
    found, _ = _solve(rows, fits, statistics, counts, fold)
    models = []
    for (plan, features, held), values in zip(fits, found):
        fitted, names, _ = _fitted_stages(rows, plan, features, statistics[held])
        models.append(FittedModel(plan.name, PipelineModel([*fitted, _with_coefficients(rows.sparkSession, values)]), names))
    return models


def _boost(rows: DataFrame, fits: Fits, statistics, counts, fold: str | None) -> tuple[list[boost.Booster], Scorer]:
    """Boosted models in common passes, and how to score raw cells by them."""
    features = fits[0][1]
    members = [boost.Member(int(p["rounds"]), float(p["rate"]), int(p["leaves"]), int(p["leaf"]), float(p.get("l2", 0)), plan.balanced, held)
               for plan, _, held in fits for p in (plan.params,)]
    found = boost.fit_boosters(with_formulas(rows, features), members, features.numbers, features.categorical, statistics, counts, fold)

    def score(cells: Sequence[pa.Array], rows: int, asked: Sequence[int]) -> np.ndarray:
        codes = found[0].layout.codes(cells)        # one layout for all
        return np.stack([1 / (1 + np.exp(-found[fit].margins(codes))) for fit in asked], axis=1)
    return found, score


def _boosted(rows: DataFrame, fits: Fits, statistics, counts, fold: str | None = None) -> list[FittedModel]:
    features = fits[0][1]
    found, _ = _boost(rows, fits, statistics, counts, fold)
    engineered = engineering_stage(features)
    return [FittedBooster(plan.name, PipelineModel([engineered] if engineered else []), [*features.numbers, *features.categorical], booster)
            for (plan, _, _), booster in zip(fits, found)]


def _held_out_scores(folded: DataFrame, fits: Fits, score: Scorer, keep: Sequence[str]) -> DataFrame:
    """(keep..., model, p) of every row by the fits that did not see its fold, in one pass over the rows.

    A row's scores are computed and checkpointed side by side; only what reads them spreads them out.
    """
    features = fits[0][1]
    ready = with_formulas(folded, features)
    cells = [F.col(f"`{c}`").cast("double").alias(f"__n{i}") for i, c in enumerate(features.numbers)]
    cells += [F.col(f"`{c}`").cast("string").alias(f"__c{i}") for i, c in enumerate(features.categorical)]
    width = len(keep)
    of_fold: dict[int | None, list[int]] = {}           # the fits of a fold, one for each plan
    for k, (_, _, fold) in enumerate(fits):
        of_fold.setdefault(fold, []).append(k)
    names = [fits[k][0].name for k in of_fold[fits[0][2]]]

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            folds = batch.column(width).to_numpy(zero_copy_only=False)
            for held in of_fold.keys() & set(np.unique(folds).tolist()):
                own = batch.filter(pa.array(folds == held))
                p = score(own.columns[width + 1:], own.num_rows, of_fold[held])
                lists = pa.ListArray.from_arrays(pa.array(np.arange(0, p.size + 1, p.shape[1]), pa.int32()), pa.array(p.ravel()))
                yield pa.RecordBatch.from_arrays([*own.columns[:width], lists], names=[*keep, "__scores"])

    asked = ready.select(*[F.col(f"`{c}`") for c in keep], F.col("fold").cast("int").alias("__fold"), *cells)
    schema = T.StructType([*folded.select(*keep).schema.fields, T.StructField("__scores", T.ArrayType(T.DoubleType()))])
    wide = materialize(asked.mapInArrow(scored, schema))
    model = F.array(*[F.lit(name) for name in names])[F.col("at")]
    return wide.select(*keep, F.posexplode("__scores").alias("at", "p")).select(*keep, model.alias("model"), "p")


def _grown(rows: DataFrame, plan: ModelPlan, features: Features, statistics: Mapping[str, dict], counts: Mapping[int, int], seed: int) -> FittedForest:
    p, n = plan.params, sum(counts.values())
    # Without a level, a category has the one slot that an encoder gives it.
    known = statistics | {"categorical": {c: (mode, list(levels) or [EMPTY_LEVEL]) for c, (mode, levels) in statistics.get("categorical", {}).items()}}
    weights = (n / (2 * counts[0]), n / (2 * counts[1])) if plan.balanced else (1.0, 1.0)
    found = forests.fit_forest(with_formulas(rows, features), features.numbers, features.categorical, known, int(p["trees"]), int(p["depth"]),
                               int(p["leaf"]), str(p["features"]), weights, seed)
    names = [*features.numbers, *[f"{c}_{v}" for c in features.categorical for v in known["categorical"][c][1]]]
    engineered = engineering_stage(features)
    return FittedForest(plan.name, PipelineModel([engineered] if engineered else []), names, found)


SOLVERS = {"logistic_regression": _solve, "gradient_boosting": _boost}
TOGETHER = {"logistic_regression": _solved, "gradient_boosting": _boosted}


def fit(train: DataFrame, plan: ModelPlan, features: Features, statistics: Mapping[str, dict] | None = None, seed: int = 42,
        counts: Mapping[int, int] | None = None) -> FittedModel:
    """Fit one plan on (features..., y); statistics and class counts may be given when they are already known."""
    rows = train.select(*features.columns, "y")
    if statistics is None and plan.family != "prior":
        rows = kept_rows(rows)
    if counts is None:
        counts = {row["y"]: row["n"] for row in rows.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    n = sum(counts.values())
    if plan.family == "prior":
        share = counts.get(1, 0) / n
        return FittedModel(plan.name, PipelineModel([SQLTransformer(statement=f"SELECT *, {_sql_number(share)} AS p FROM __THIS__")]), [])
    if not (counts.get(0) and counts.get(1)):
        raise ValueError("Fitting needs both classes.")
    if not (features.numbers or features.categorical):
        raise ValueError("Fitting needs at least one feature.")
    try:
        statistics = statistics_of(rows, features) if statistics is None else statistics
        if plan.family in TOGETHER:
            return TOGETHER[plan.family](rows, [(plan, features, None)], {None: statistics}, {None: counts})[0]
        if plan.family != "random_forest":
            raise ValueError(f"Unknown model family {plan.family!r}.")
        return _grown(rows, plan, features, statistics, counts, seed)
    finally:
        rows.unpersist()


def build_pipeline(train: DataFrame, features: Features, plan: ModelPlan, exclude: Sequence[str] = (), seed: int = 42) -> FittedModel:
    """The full chain - normalise, engineer, impute, scale, encode, estimate - fitted on the given rows only."""
    return fit(train, plan, features.without(exclude), seed=seed)


def assemble(df: DataFrame, features: Features, scale: bool = True, keep: Sequence[str] = ("id",)) -> tuple[DataFrame, list[str]]:
    """(keep..., features vector) and the slot names; other columns are dropped."""
    stages, names = feature_stages(features, statistics_of(df, features), scale)
    for stage in stages:
        stage = stage.fit(df) if isinstance(stage, OneHotEncoder) else stage
        df = stage.transform(df)
    return df.select(*keep, "features"), names


def in_parallel(spark: SparkSession, tasks: Sequence[Callable[[], object]]) -> list:
    """Run independent chains of Spark jobs side by side; results keep the order of the tasks."""
    with ThreadPoolExecutor(max_workers=PARALLEL_FITS) as pool:
        return [job.result() for job in [pool.submit(inheritable_thread_target(spark)(task)) for task in tasks]]


def oof_scores(folded: DataFrame, plans: Sequence[ModelPlan], features: Features | Mapping[str, Features], seed: int = 42,
               keep: Sequence[str] = ("id", "y", "fold")) -> DataFrame:
    """(keep..., model, p): every row scored by the model that never saw its fold, for several plans at once.

    Fold statistics are learned for all folds in one pass; the fold-tagged table is held for the fits and released
    afterwards. The scores are checkpointed, so reports on them do not score again.
    """
    of = (lambda plan: features[plan.name]) if isinstance(features, Mapping) else (lambda plan: features)
    folded = kept_rows(folded)
    try:
        per_fold = {(r["fold"], r["y"]): r["n"] for r in folded.groupBy("fold", "y").agg(F.count(F.lit(1)).alias("n")).collect()}
        folds = sorted({fold for fold, _ in per_fold})
        known: dict[int, dict] = {}
        for plan in plans:
            if plan.family != "prior" and id(of(plan)) not in known:
                known[id(of(plan))] = statistics_by_fold(folded, of(plan), folds[-1] + 1)

        counts = {fold: {y: sum(n for (other, label), n in per_fold.items() if other != fold and label == y) for y in (0, 1)} for fold in folds}

        def scored(model: FittedModel, plan: ModelPlan, fold: int) -> DataFrame:
            return model.score(folded.where(F.col("fold") == fold)).select(*keep, F.lit(plan.name).alias("model"), "p")

        def one(plan: ModelPlan, fold: int) -> list[DataFrame]:
            statistics = None if plan.family == "prior" else known[id(of(plan))].get(fold, {})
            return [scored(fit(folded.where(F.col("fold") != fold), plan, of(plan), statistics, seed, counts[fold]), plan, fold)]

        def together(family: str, own: list[ModelPlan]) -> list[DataFrame]:
            asked = [(plan, of(plan), fold) for plan in own for fold in folds]
            if any(not min(counts[fold].values()) for fold in folds):
                raise ValueError("Fitting needs both classes.")
            if not (asked[0][1].numbers or asked[0][1].categorical):
                raise ValueError("Fitting needs at least one feature.")
            _, score = SOLVERS[family](folded, asked, known[id(of(own[0]))], counts, "fold")
            return [_held_out_scores(folded, asked, score, keep)]

        # Plans of one family over the same features share their passes over the rows, all folds at once.
        groups: dict[tuple[str, int], list[ModelPlan]] = {}
        for plan in plans:
            if plan.family in TOGETHER:
                groups.setdefault((plan.family, id(of(plan))), []).append(plan)
        tasks = [lambda family=family, own=own: together(family, own) for (family, _), own in groups.items()]
        tasks += [lambda plan=plan, fold=fold: one(plan, fold) for plan in plans if plan.family not in TOGETHER for fold in folds]
        found = in_parallel(folded.sparkSession, tasks)
        parts, alone = [p for own in found[:len(groups)] for p in own], [p for own in found[len(groups):] for p in own]
        return reduce(DataFrame.unionByName, [*parts, *([materialize(reduce(DataFrame.unionByName, alone))] if alone else [])])
    finally:
        folded.unpersist()


def score_all(df: DataFrame, models: Sequence[FittedModel], keep: Sequence[str] = ("id", "y")) -> DataFrame:
    """One table scored by several models, in long form (keep..., model, p)."""
    return reduce(DataFrame.unionByName, [m.score(df).select(*keep, F.lit(m.name).alias("model"), "p") for m in models])


def score_batch(df: DataFrame, model: FittedModel, threshold: float, run_id: str, features: Features,
                keep: Sequence[str] = ("id",)) -> DataFrame:
    """Batch prediction: p, label and threshold with the run that produced them; column order and extras do not matter."""
    check_threshold(threshold)
    scored = model.score(df.select(*keep, *features.columns)).select(*keep, "p")
    return label_at(scored, threshold).withColumn("run_id", F.lit(run_id))


def fit_sigmoid(margins: DataFrame) -> tuple[float, float]:
    """Slope and intercept of p = 1 / (1 + exp(-(a m + b))) with smoothed targets, from (margin, y)."""
    return newton.fit_sigmoids(margins.withColumn("__one", F.lit(1)), "__one")[1]


def sigmoid_calibration(train: DataFrame, plan: ModelPlan, features: Features, folds: int = 3, seed: int = 42) -> Callable[[DataFrame], DataFrame]:
    """A scorer that averages `folds` models, each followed by the sigmoid fitted on the rows it did not see."""
    inner = kept_rows(stratified_folds(train.drop("fold"), k=folds, seed=f"{seed}|calibration"))
    try:
        statistics = statistics_by_fold(inner, features, folds)
        if plan.family in TOGETHER:
            per_fold = {(r["fold"], r["y"]): r["n"] for r in inner.groupBy("fold", "y").agg(F.count(F.lit(1)).alias("n")).collect()}
            counts = {fold: {y: sum(n for (other, label), n in per_fold.items() if other != fold and label == y) for y in (0, 1)} for fold in range(folds)}
            fitted = TOGETHER[plan.family](inner, [(plan, features, fold) for fold in range(folds)], statistics, counts, "fold")
        else:
            fitted = in_parallel(train.sparkSession, [lambda fold=fold: fit(inner.where(F.col("fold") != fold), plan, features, statistics[fold], seed)
                                                      for fold in range(folds)])
        margins = reduce(DataFrame.unionByName, [model.margin(inner.where(F.col("fold") == fold)).select("fold", "margin", "y")
                                                 for fold, model in enumerate(fitted)])
        found = newton.fit_sigmoids(margins, "fold")
        members = [(model, *found[fold]) for fold, model in enumerate(fitted)]
    finally:
        inner.unpersist()

    def score(df: DataFrame) -> DataFrame:
        made = df
        for i, (model, slope, intercept) in enumerate(members):
            made = model.margin(made).withColumn(f"__p{i}", 1 / (1 + F.exp(-(F.col("margin") * slope + intercept)))).drop("margin")
        total = reduce(lambda a, b: a + b, [F.col(f"__p{i}") for i in range(len(members))])
        return made.select(*df.columns, (total / len(members)).alias("p"))
    return score


def calibration_oof(folded: DataFrame, plan: ModelPlan, features: Features, inner: int = 3, seed: int = 42) -> DataFrame:
    """(id, y, fold, method, p): out-of-fold scores of the plain and of the sigmoid-calibrated model on the same folds."""
    folded = kept_rows(folded)
    try:
        folds = sorted(r["fold"] for r in folded.select("fold").distinct().collect())
        plain = oof_scores(folded, [plan], features, seed).select("id", "y", "fold", F.lit("uncalibrated").alias("method"), "p")
        parts = []
        for fold in folds:
            score = sigmoid_calibration(folded.where(F.col("fold") != fold), plan, features, inner, seed)
            parts.append(score(folded.where(F.col("fold") == fold)).select("id", "y", "fold", F.lit("sigmoid").alias("method"), "p"))
        return materialize(reduce(DataFrame.unionByName, [plain, *parts]))
    finally:
        folded.unpersist()


def coefficients(spark: SparkSession, model: FittedModel) -> DataFrame:
    """(feature, coefficient), largest first; O(features) values the fitted model already holds."""
    return _model_table(spark, model.feature_names, model.estimator.coefficients.toArray(), "coefficient")


def importances(spark: SparkSession, model: FittedModel) -> DataFrame:
    """(feature, importance) of a tree model, largest first."""
    return _model_table(spark, model.feature_names, model.estimator.featureImportances.toArray(), "importance")


def _model_table(spark: SparkSession, names: Sequence[str], values: Sequence[float], column: str) -> DataFrame:
    rows = [(name, float(value)) for name, value in zip(names, values)]
    return spark.createDataFrame(rows, f"feature string, {column} double").orderBy(F.col(column).desc(), "feature")
