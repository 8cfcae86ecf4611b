"""Drift of columns with very many categories, and of features without values."""

import math

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from binoscope.operators import drift

KINDS = 60_000


def _psi(expected, actual):
    total, unseen = 0.0, 0.0
    n_e, n_a = sum(expected.values()), sum(actual.values())
    for name, n in expected.items():
        e, a = max(n / n_e, 1e-4), max(actual.get(name, 0) / n_a, 1e-4)
        total += (a - e) * math.log(a / e)
    unseen = sum(n for name, n in actual.items() if name not in expected) / n_a
    e, a = 1e-4, max(unseen, 1e-4)
    return total + (a - e) * math.log(a / e), unseen


def test_many_categories_against_brute_force(spark):
    before = spark.range(2 * KINDS).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("c"), F.col("id") % KINDS)).alias("c"),
                                           (F.col("id") % 100).cast("double").alias("x"))
    now = spark.range(2 * KINDS).select(F.when(F.col("id") % 4 == 0, "hot").otherwise(F.concat(F.lit("c"), F.col("id") % KINDS + 5000)).alias("c"),
                                        (F.col("id") % 100).cast("double").alias("x"))
    stored = drift.drift_profile(before, ["x"], ["c"])
    assert not any(isinstance(f.dataType, T.MapType) for f in stored.schema.fields)
    assert stored.where("feature = 'c'").count() == before.select("c").distinct().count()

    def counted(df):
        return {r["c"]: r["count"] for r in df.groupBy("c").count().collect()}

    value, unseen = _psi(counted(before), counted(now))
    found = {r["feature"]: r for r in drift.drift_report(now, stored).collect()}
    assert found["c"]["psi"] == pytest.approx(value, rel=1e-9) and found["c"]["unseen_share"] == pytest.approx(unseen, rel=1e-12)
    assert found["x"]["psi"] < 1e-9 and found["x"]["unseen_share"] is None


def test_numeric_feature_without_values_is_no_data(spark):
    empty = spark.createDataFrame([(None, 1.0)] * 5, "x double, z double")
    filled = spark.createDataFrame([(2.0, None), (None, None), (3.0, 1.0), (4.0, 1.0)], "x double, z double")
    found = {r["feature"]: r for r in drift.drift_report(filled, drift.drift_profile(empty, ["x", "z"], [])).collect()}
    assert found["x"]["status"] == "no data" and found["x"]["psi"] is None
    assert found["x"]["reference_missing_rate"] == 1.0 and found["x"]["current_missing_rate"] == 0.25
    assert found["z"]["current_missing_rate"] == 0.5


def test_a_category_named_like_the_old_marker_is_a_category(spark):
    before = spark.createDataFrame([("__unseen__",)] * 10, "c string")
    now = spark.createDataFrame([("__unseen__",)] * 9 + [(None,)], "c string")
    row = drift.drift_report(now, drift.drift_profile(before, [], ["c"])).first()
    assert row["status"] == "stable" and row["unseen_share"] == 0.0 and row["current_missing_rate"] == pytest.approx(0.1)


def test_no_rows_now(spark):
    before = spark.createDataFrame([("a", 1.0), ("b", 2.0)], "c string, x double")
    report = drift.drift_report(before.limit(0), drift.drift_profile(before, ["x"], ["c"])).collect()
    assert {r["feature"] for r in report} == {"c", "x"} and all(r["status"] == "no data" for r in report)
