"""Inputs that the registered tables do not hold: non-finite numbers, look-alike cells, mixed files, ties, text ids."""

import datetime

import pytest
from pyspark.sql import functions as F

from binoscope.operators import bootstrap, checks, drift, explain, integrity, metrics, order, profile, split
from binoscope.sources import tables
from binoscope.spec import TableSpec  # noqa: F401  (the reader takes either kind of schema)

NAN, INF = float("nan"), float("inf")


def test_table_diff_sees_non_finite_numbers(spark):
    old = spark.createDataFrame([(1, 1.0), (2, 2.0), (3, NAN), (4, INF), (5, None), (6, 1.0), (7, INF)], "id long, v double")
    new = spark.createDataFrame([(1, NAN), (2, INF), (3, NAN), (4, INF), (5, None), (6, 1.0 + 1e-9), (7, -INF)], "id long, v double")
    assert [tuple(r) for r in integrity.table_diff(old, new, ["id"]).collect()] == [("v", "values differ", 3)]


def test_record_diff_sees_non_finite_numbers(spark):
    old = spark.createDataFrame([(1, (1.0,)), (2, (2.0,)), (3, (NAN,))], "id long, r struct<v: double>")
    new = spark.createDataFrame([(1, (NAN,)), (2, (INF,)), (3, (NAN,))], "id long, r struct<v: double>")
    assert sorted(r.id for r in integrity.record_diff(old, new, "id").collect()) == [1, 2]


def test_fingerprint_keeps_cells_apart(spark):
    pairs = [("a|=b", "c"), ("a", "b|=c"), ("a|1=b", "c"), ("a", "b|1=c"), (None, "~"), ("~", None)]
    digests = {integrity.fingerprint(spark.createDataFrame([p], "x string, y string")).first()["digest"] for p in pairs}
    assert len(digests) == len(pairs)
    table = spark.createDataFrame(pairs, "x string, y string")
    assert integrity.fingerprint(table).first() == integrity.fingerprint(table.orderBy("y")).first()


def test_duplicate_rows_down_to_a_microsecond(spark):
    at = datetime.datetime(2024, 1, 1, 0, 0, 0, 1)
    rows = [(1, at), (1, at + datetime.timedelta(microseconds=1)), (2, at), (2, at), (3, None), (3, None)]
    assert checks.duplicate_rows(spark.createDataFrame(rows, "k int, t timestamp")).first()[0] == 2


def test_text_keys_are_violations(spark):
    found = {r["rule"]: r["n_bad"] for r in checks.key_violations(spark.createDataFrame([("x",), ("7",), ("7",), (None,)], "k string"), "k").collect()}
    assert found == {"key_null": 1, "key_positive": 0, "key_whole": 1, "key_unique": 1}


def test_csv_files_with_other_headers_are_refused(spark, tmp_path):
    (tmp_path / "one.csv").write_text("a,b\n1,2\n")
    (tmp_path / "two.csv").write_text("b,a\n2,1\n")
    schema = spark.createDataFrame([], "a int, b int").schema
    with pytest.raises(tables.TableUnreadable):
        tables.read_table(spark, str(tmp_path), schema)


def test_json_keeps_documents_without_the_envelope(spark, tmp_path):
    (tmp_path / "one.json").write_text('{"records": [{"a": 1}, {"a": 2}]}')
    (tmp_path / "two.json").write_text('{"a": 7}')
    rows = tables.read_records(spark, str(tmp_path))
    assert sorted(r.a for r in rows.collect()) == [1, 2, 7]
    assert sorted(r.a for r in tables.read_records(spark, str(tmp_path), schema=rows.schema).collect()) == [1, 2, 7]


@pytest.mark.parametrize("with_schema", [False, True])
def test_broken_json_is_refused(spark, tmp_path, with_schema):
    (tmp_path / "one.json").write_text('{"a": 1, ')
    (tmp_path / "two.json").write_text('{"a": 7}')
    schema = spark.createDataFrame([], "a long").schema if with_schema else None
    with pytest.raises(tables.TableUnreadable):
        tables.read_records(spark, str(tmp_path), schema=schema)


def test_drift_from_a_category_that_was_empty(spark):
    before = spark.createDataFrame([(None,)] * 20, "c string")
    now = spark.createDataFrame([("x",)] * 20, "c string")
    row = drift.drift_report(now, drift.drift_profile(before, [], ["c"])).first()
    assert row["status"] == "shift" and row["psi"] == pytest.approx(9.2, abs=0.02)
    assert drift.drift_report(before, drift.drift_profile(before, [], ["c"])).first()["status"] == "no data"


def test_samples_splits_and_folds_are_independent(spark):
    table = spark.range(4000).select("id", (F.col("id") % 2).cast("int").alias("y"))
    both = split.stratified_folds(split.stratified_split(table, share=0.25), k=4)
    drawn = split.sample_n(both, 400)
    assert drawn.count() == 400
    for column, value in (("partition", "test"), ("fold", 0)):
        assert 60 <= drawn.where(F.col(column) == value).count() <= 140
    cells = {(r["partition"], r["fold"]): r["count"] for r in both.groupBy("partition", "fold").count().collect()}
    assert len(cells) == 8 and min(cells.values()) > 180
    nested = split.nested_folds(table, outer=4, inner=4)
    inner = {(r["outer_fold"], r["inner_fold"], r["fold"]): r["count"] for r in nested.join(both.select("id", "fold"), "id")
             .groupBy("outer_fold", "inner_fold", "fold").count().collect()}
    assert len(inner) == 4 * 4 * 3 and min(inner.values()) > 180


@pytest.mark.parametrize("n", [5, 2_000, 10_001])
def test_sample_never_exceeds_its_size(spark, n):
    repeated = spark.range(12_000).select((F.col("id") % 3000).alias("id"), F.col("id").alias("row"))
    assert split.sample_n(repeated, n).count() == n
    assert split.sample_n(repeated.limit(0), n).count() == 0 and split.sample_n(repeated.limit(3), n).count() == 3


def test_ranges_take_nan_and_text(spark, scored_of, small_ranges):
    rows = spark.createDataFrame([(float(k % 97),) for k in range(300)] + [(NAN,), (NAN,), (None,)], "v double")
    cut = profile.describe_numeric(rows, ["v"]).first()
    spark.conf.set("binoscope.rowsPerBucket", "1000000")
    whole = profile.describe_numeric(rows, ["v"]).first()
    assert [str(c) for c in cut] == [str(c) for c in whole]
    spark.conf.set("binoscope.rowsPerBucket", "50")
    scored = scored_of([k % 2 for k in range(400)], [0.5] * 400).withColumn("id", F.concat(F.lit("key"), F.lpad("id", 4, "0")))
    row = metrics.capacity(scored, [0.25]).first()
    assert (row["selected_count"], row["true_positives"]) == (100, 50)
    assert order.split_points(scored, "id")


def test_permutation_has_one_rule_at_every_size(spark):
    rows = spark.range(500).select("id", F.col("id").cast("double").alias("a"), (F.col("id") * 2).alias("b"))
    made = explain.permuted(rows, ["a"], 3, 42)
    for repeat in range(3):
        own = made.where(F.col("repeat") == repeat).collect()
        assert sorted(r.a for r in own) == [float(k) for k in range(500)] and all(r.b == 2 * r.id for r in own)
        assert sum(r.a == r.id for r in own) < 10


@pytest.mark.parametrize("y, p", [(None, 0.5), (2, 0.5), (1, 1.7), (1, None), (0, NAN), (0, -0.1)])
def test_evaluations_refuse_rows_that_are_no_scores(scored_of, y, p):
    scored = scored_of([0, 1, 0], [0.1, 0.9, 0.5]).withColumn("g", F.lit("a"))
    broken = scored.unionByName(scored.limit(1).withColumn("y", F.lit(y).cast("int")).withColumn("p", F.lit(p).cast("double")))
    for report in (lambda t: metrics.evaluate(t, 0.5), lambda t: metrics.threshold_table(t), lambda t: metrics.capacity(t, [0.5]),
                   lambda t: metrics.subgroups(t, ["g"], 0.5), lambda t: bootstrap.subgroup_ci(t, ["g"], 0.5, 10)):
        report(scored).collect()
        with pytest.raises(Exception, match="label 0 or 1"):
            report(broken).collect()


def test_nothing_to_evaluate_is_an_error(scored_of):
    empty = scored_of([0], [0.5]).limit(0)
    with pytest.raises(Exception, match="no scores"):
        metrics.evaluate(empty, 0.5).collect()
    assert metrics.evaluate(empty.withColumn("g", F.lit(1)), 0.5, ["g"]).count() == 0


def test_subgroup_intervals_from_counts(scored_of):
    scored = scored_of([k % 2 for k in range(2000)], [0.9 if k % 3 == 0 else 0.2 for k in range(2000)]).withColumn("g", F.col("id") % 2)
    one, two = (bootstrap.subgroup_ci(scored.repartition(n), ["g"], 0.5, 400).orderBy("group").collect() for n in (1, 7))
    assert one == two
    for row in one:
        rate, n = 1 / 3, 1000
        name = "recall" if row["recall_lower"] is not None else "false_positive_rate"
        assert row[f"{name}_lower"] < rate < row[f"{name}_upper"]
        assert row[f"{name}_upper"] - row[f"{name}_lower"] == pytest.approx(2 * 1.96 * (rate * (1 - rate) / n) ** 0.5, rel=0.25)
    plan = bootstrap.subgroup_ci(scored, ["g"], 0.5, 400)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Generate") == 1
