"""The binary-outcome views over the star schema that the registered queries run on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from binoscope.functions.hashing import hash_int
from binoscope.operators import metrics
from binoscope.operators.split import FOLDS, stratified_folds
from binoscope.sources.tables import load
from binoscope.spec import TableSpec

NUMERIC = ["totalprice", "acctbal", "order_year", "order_month"]
CATEGORICAL = ["priority", "segment", "region"]

CLS_SPEC = TableSpec(
    key="id", label="y",
    bounds={"totalprice": (0, None), "acctbal": (-1000, 10000), "order_year": (1992, 1998), "order_month": (1, 12)},
    categories={"priority": ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"),
                "segment": ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"),
                "region": ("AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST")},
    labels={"F": 1, "O": 0, "P": 0})


def cls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders with their customer and region: id, y, four numeric and three categorical features."""
    orders, customer = load(spark, sf_dir, "orders"), load(spark, sf_dir, "customer")
    nation, region = load(spark, sf_dir, "nation"), load(spark, sf_dir, "region")
    placed = (orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))
              .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
              .join(region, F.col("n_regionkey") == F.col("r_regionkey")))
    return placed.select(
        F.col("o_orderkey").alias("id"), (F.col("o_orderstatus") == "F").cast("int").alias("y"),
        F.col("o_totalprice").alias("totalprice"), F.col("c_acctbal").alias("acctbal"),
        F.year("o_orderdate").cast("double").alias("order_year"), F.month("o_orderdate").cast("double").alias("order_month"),
        F.col("o_orderpriority").alias("priority"), F.col("c_mktsegment").alias("segment"), F.col("r_name").alias("region"))


def cls_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """cls with missing cells put in by fixed rules of the id."""
    def hole(column: str, step: int) -> Column:
        return F.when(F.col("id") % step != 0, F.col(column)).alias(column)

    return cls(spark, sf_dir).select("id", "y", hole("totalprice", 17), hole("acctbal", 13), "order_year", "order_month",
                                     hole("priority", 11), hole("segment", 19), "region")


def with_score(df: DataFrame, salt: str | None = None, noise: int = 7, signal: int = 30000, name: str = "p") -> DataFrame:
    """Add a score in [0, 1) that depends on the id hash and, with weight `signal`, on the label."""
    h = (hash_int(F.col("id")) if salt is None else hash_int(salt, F.col("id"))) % 10000
    tenths = F.floor((h * noise + F.col("y").cast("long") * signal) / 10).cast("long")
    return df.withColumn(name, tenths / F.lit(10000.0))


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """id and y straight from orders, for queries that need no group columns."""
    return load(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"),
                                                (F.col("o_orderstatus") == "F").cast("int").alias("y"))


def scored(spark: SparkSession, sf_dir: str, groups: bool = False) -> DataFrame:
    return with_score(cls(spark, sf_dir) if groups else labelled(spark, sf_dir))


def imbalanced(spark: SparkSession, sf_dir: str) -> DataFrame:
    """labels with their document: y = toxic, the rare-positive case."""
    joined = load(spark, sf_dir, "labels").join(load(spark, sf_dir, "documents"), "doc_id")
    return joined.select(F.col("doc_id").alias("id"), F.col("toxic").alias("y"), F.col("n_chars").cast("double").alias("n_chars"),
                         "lang", "source")


# The stand-in models of the registered comparisons: (salt, noise, signal) of with_score.
MODELS = {"model_a": (None, 7, 30000), "model_b": ("b", 7, 30000), "model_c": ("c", 8, 20000)}


def scored_models(spark: SparkSession, sf_dir: str, models: dict | None = None) -> DataFrame:
    """Long table (id, y, model, p); the models are computed side by side from one scan."""
    models = MODELS if models is None else models
    wide = labelled(spark, sf_dir)
    for name, (salt, noise, signal) in models.items():
        wide = with_score(wide, salt, noise, signal, name)
    return wide.unpivot(["id", "y"], list(models), "model", "p")


def folded_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    """scored_models with the five seeded folds, which are assigned before the models are spread out."""
    wide = stratified_folds(labelled(spark, sf_dir))
    for name, (salt, noise, signal) in MODELS.items():
        wide = with_score(wide, salt, noise, signal, name)
    return wide.unpivot(["id", "y", "fold"], list(MODELS), "model", "p")


def other_folds(folded: DataFrame, folds: int = FOLDS) -> DataFrame:
    """Every row once for each fold it trains, as outer_fold."""
    return folded.withColumn("outer_fold", F.explode(F.sequence(F.lit(0), F.lit(folds - 1)).cast("array<bigint>"))) \
                 .where(F.col("outer_fold") != F.col("fold"))


def fold_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fold table of procedures: the models as procedures, each with its threshold and inner score per outer fold."""
    folded = folded_models(spark, sf_dir)
    keys = ["model", "fold"]
    measured = metrics.fold_metrics(folded)
    chosen = metrics.select_threshold(metrics.threshold_table(folded, by=keys), keys).select(*keys, "threshold")
    inner = metrics.average_precision(other_folds(folded), ["model", "outer_fold"]).select(
        "model", F.col("outer_fold").alias("fold"), F.col("pr_auc").alias("inner_cv_ap"))
    joined = measured.join(chosen, keys).join(inner, keys)
    return joined.select(F.col("model").alias("procedure"), F.col("fold").alias("outer_fold"),
                         F.when(F.col("fold") % 2 == 0, F.col("model")).otherwise("model_a").alias("selected_model"),
                         "threshold", "inner_cv_ap", *metrics.FOLD_METRICS)


# Settings (noise, signal) of the stand-in trials; the last two are equal, so that ties occur.
TRIAL_SETTINGS = [(9, 10000), (8, 20000), (7, 30000), (6, 40000), (6, 40000)]


def trials(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A trial table (number, state, model, parameters, fold_scores) from scores of increasing signal; one trial failed."""
    wide = stratified_folds(labelled(spark, sf_dir))
    for i, (noise, signal) in enumerate(TRIAL_SETTINGS):
        wide = with_score(wide, "t", noise, signal, f"p{i}")
    long = wide.unpivot(["id", "y", "fold"], [f"p{i}" for i in range(len(TRIAL_SETTINGS))], "trial", "p")
    numbered = long.withColumn("number", F.substring("trial", 2, 9).cast("long"))
    per_fold = metrics.average_precision(numbered, ["number", "fold"])
    ordered = F.sort_array(F.collect_list(F.struct("fold", F.round("pr_auc", 10).alias("ap"))))
    return per_fold.groupBy("number").agg(ordered.alias("s")).select(
        "number", F.when(F.col("number") == 1, "FAIL").otherwise("COMPLETE").alias("state"),
        F.when(F.col("number") % 2 == 0, "even").otherwise("odd").alias("model"),
        F.concat(F.lit("setting_"), F.col("number").cast("string")).alias("parameters"), F.col("s.ap").alias("fold_scores"))
