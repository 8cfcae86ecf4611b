"""Contracts, profiles, splits, preparation, sources and sinks."""

import json
import math

import pytest
from pyspark.sql import functions as F

from binoscope.operators import checks, prepare, profile, split
from binoscope.operators.order import exact_quantiles
from binoscope.plans import bindings as B
from binoscope.sources import sinks, tables
from binoscope.spec import TableSpec

SPEC = TableSpec(key="id", label="y", bounds={"age": (18, 60), "pay": (0, None)}, categories={"city": ("a", "b")},
                 constants={"kind": "x"}, labels={"No": 0, "Yes": 1})
COLUMNS = "age double, pay double, city string, kind string, id long, y string"


def table(spark, *rows):
    return spark.createDataFrame(list(rows), COLUMNS)


GOOD = [(30.0, 1.0, "a", "x", 1, "No"), (60.0, None, "b", "x", 2, "Yes")]


def test_good_table_passes(spark):
    checks.validate(table(spark, *GOOD), SPEC)


@pytest.mark.parametrize("change, rule", [
    ({"age": 17.0}, "bounds age"), ({"age": 61.0}, "bounds age"), ({"age": 35.5}, "whole age"), ({"age": float("inf")}, "finite age"),
    ({"pay": -1.0}, "bounds pay"), ({"city": "  "}, "blank city"), ({"city": "c"}, "known city"), ({"kind": "z"}, "constant kind"),
    ({"kind": None}, "constant kind"), ({"id": 0}, "key_positive id"), ({"id": 2}, "key_unique id"), ({"id": None}, "key_null id"),
    ({"y": None}, "label_null y"), ({"y": "Maybe"}, "label_known y"), ({"y": "Yes"}, "label_classes y")])
def test_one_bad_row_fails_the_table(spark, change, rule):
    names = ["age", "pay", "city", "kind", "id", "y"]
    bad = tuple(change.get(n, v) for n, v in zip(names, GOOD[0]))
    with pytest.raises(checks.ContractError, match=rule):
        checks.validate(table(spark, bad, GOOD[1]), SPEC)


@pytest.mark.parametrize("value", [18.0, 60.0, 35.0, None, float("nan")])
def test_bounds_are_inclusive_and_missing_values_pass(spark, value):
    checks.validate(table(spark, (value, 1.0, "a", "x", 1, "No"), GOOD[1]), SPEC)


def test_open_upper_end_and_novel_category_when_scoring(spark):
    rows = table(spark, (30.0, 1e12, "new", "x", 1, "No")).drop("y")
    checks.validate(rows, SPEC, mode="score")


def test_text_and_boolean_numbers_are_refused(spark):
    rows = table(spark, *GOOD)
    for bad in (F.col("age").cast("string"), F.col("age") > 0):
        found = {(r.rule, r.column): r.n_bad for r in checks.numeric_violations(rows.withColumn("age", bad), SPEC.bounds).collect()}
        assert found[("numeric", "age")] == 2


def test_column_names(spark):
    rows = table(spark, *GOOD)
    for frame in (rows.drop("age"), rows.withColumn("more", F.lit(1)), rows.select("*", F.col("age")), rows.limit(0)):
        with pytest.raises(checks.ContractError):
            checks.check_columns(frame, SPEC)
    with pytest.raises(checks.ContractError, match="unexpected columns: y"):
        checks.check_columns(rows, SPEC, "score")


def test_duplicate_rows_count_later_copies_and_match_nulls(spark):
    rows = spark.createDataFrame([(1, None), (1, None), (1, "a"), (1, None)], "a int, b string")
    assert checks.duplicate_rows(rows).first()[0] == 2


def test_audit_counts_null_as_a_value(spark):
    rows = spark.createDataFrame([(1, None, "k"), (1, 2, "k")], "a int, b int, c string")
    found = {r.column: r for r in profile.audit(rows).collect()}
    assert found["a"].constant and not found["b"].constant and found["b"].n_missing == 1
    assert {r.column: r.constant for r in profile.audit(rows, approximate=True).collect()} == {c: r.constant for c, r in found.items()}


def test_quantiles_interpolate_and_survive_ranges(spark):
    rows = spark.createDataFrame([("g", v) for v in (1.0, 2.0, 3.0, 10.0)], "g string, v double")
    assert exact_quantiles(rows, ["g"], "v", {"m": 0.5}).first().m == 2.5
    many = spark.range(5000).select((F.col("id") % 3).alias("g"), F.when(F.col("id") % 3 == 0, 7.0).otherwise(F.sqrt("id")).alias("v"))
    plain = {r.g: (r.a, r.b) for r in exact_quantiles(many, ["g"], "v", {"a": 0.25, "b": 0.9}).collect()}
    spark.conf.set("binoscope.rowsPerBucket", "100")
    try:
        ranged = {r.g: (r.a, r.b) for r in exact_quantiles(many, ["g"], "v", {"a": 0.25, "b": 0.9}).collect()}
    finally:
        spark.conf.unset("binoscope.rowsPerBucket")
    assert plain == ranged


def test_split_is_exact_disjoint_and_independent_of_partitions(spark, sf_dir):
    rows = B.labelled(spark, sf_dir)
    first = {r.id: r.partition for r in split.stratified_split(rows).collect()}
    again = {r.id: r.partition for r in split.stratified_split(rows.repartition(50)).collect()}
    assert first == again and len(first) == rows.count()
    sizes = {r.y: r["count"] for r in rows.groupBy("y").count().collect()}
    tests = {r.y: r["count"] for r in split.stratified_split(rows).where("partition = 'test'").groupBy("y").count().collect()}
    assert tests == {y: math.floor(0.2 * n + 0.5) for y, n in sizes.items()}


def test_folds_are_balanced_and_tiny_classes_are_handled(spark):
    rows = spark.range(23).select("id", (F.col("id") < 3).cast("int").alias("y"))
    counts = split.stratified_folds(rows, k=5).groupBy("y", "fold").count().collect()
    big = [r["count"] for r in counts if r.y == 0]
    assert sorted(big) == [4, 4, 4, 4, 4] and all(r["count"] == 1 for r in counts if r.y == 1)
    assert split.stratified_split(rows, share=0.1).where("partition = 'test' AND y = 1").count() == 0


def test_folds_with_many_strata_join_instead_of_literals(spark, monkeypatch):
    from binoscope.operators import order
    rows = spark.range(400).select("id", (F.col("id") % 2).cast("int").alias("y"))
    plain = {r.id: r.fold for r in split.stratified_folds(rows).collect()}
    monkeypatch.setattr(order, "LITERAL_STRATA", 1)
    monkeypatch.setattr(order, "ROWS_PER_HASH_BUCKET", 20)
    assert {r.id: r.fold for r in split.stratified_folds(rows).collect()} == plain


def test_nested_folds_leave_the_own_fold_out(spark, sf_dir):
    rows = B.labelled(spark, sf_dir)
    outer = split.stratified_folds(rows).select("id", "fold")
    nested = split.nested_folds(rows, inner=3).join(outer, "id")
    assert nested.where("outer_fold = fold").count() == 0 and nested.count() == 4 * rows.count()


def test_fold_statistics_ignore_the_held_out_rows(spark, sf_dir):
    folded = split.stratified_folds(B.cls_nulls(spark, sf_dir))
    altered = folded.withColumn("totalprice", F.when(F.col("fold") == 2, 1e9).otherwise(F.col("totalprice"))) \
                    .withColumn("segment", F.when(F.col("fold") == 2, "ZZZ").otherwise(F.col("segment")))

    def of(frame):
        tables_ = prepare.fit_statistics(frame, ["totalprice"], ["segment"], 5)
        return ({r.fold: (r.median, round(r["mean"], 6), round(r["scale"], 6)) for r in tables_["numeric"].collect()},
                {r.fold: (r.mode, r.levels) for r in tables_["categorical"].collect()})
    before, after = of(folded), of(altered)
    assert before[0][2] == after[0][2] and before[1][2] == after[1][2]
    assert before[0][1] != after[0][1] and "ZZZ" in after[1][1][1]


def test_scale_of_a_constant_is_one_and_empty_columns_get_a_fill(spark):
    rows = spark.createDataFrame([(3.0, None), (3.0, None)], "a double, b double")
    assert {r.feature: r.scale for r in prepare.fit_scale(rows, ["a"]).collect()} == {"a": 1.0}
    assert {r.feature: r.median for r in prepare.fit_median(rows, ["a", "b"]).collect()} == {"a": 3.0, "b": 0.0}


def test_mode_tie_takes_the_smallest(spark):
    rows = spark.createDataFrame([("b",), ("a",), (None,), (None,), (None,)], "c string")
    assert prepare.fit_mode(rows, ["c"]).first()["mode"] == "a"


def test_engineered_columns(spark):
    rows = spark.createDataFrame([("10", 0.0, 1.0, None), ("x", 4.0, None, None), ("8", None, 3.0, 5.0)], "a string, b double, c double, d double")
    made = prepare.row_mean(prepare.ratio_features(rows, {"r": ("a", "b", 1), "z": ("a", "b", 0)}), ["c", "d"], "m").collect()
    assert [r.r for r in made] == [10.0, None, None] and [r.z for r in made] == [None, None, None] and [r.m for r in made] == [1.0, None, 4.0]


def test_bands_are_closed_on_the_right(spark):
    rows = spark.createDataFrame([(v,) for v in (17.0, 18.0, 29.0, 30.0, 101.0)], "age double")
    banded = prepare.band(rows, "age", [17, 29, 39, 100], ["18-29", "30-39", "40+"], "band")
    assert [r.band for r in banded.collect()] == [None, "18-29", "18-29", "30-39", None]


def test_csv_errors_are_told_apart(spark, tmp_path):
    with pytest.raises(tables.TableNotFound):
        tables.read_table(spark, str(tmp_path / "none.csv"), SPEC)
    bad = tmp_path / "bad.csv"
    bad.write_text("age,pay,city,kind,id,y\n30,1,a,x,one,No\n")
    with pytest.raises(tables.TableUnreadable):
        tables.read_table(spark, str(bad), SPEC)
    good = tmp_path / "good.csv"
    good.write_text("id,y,age,pay,city,kind\n1,No,30,,a,x\n2,Yes,31,5,b,x\n")
    rows = tables.read_table(spark, str(good), SPEC)
    checks.validate(rows, SPEC)
    assert rows.where("pay IS NULL").count() == 1


@pytest.mark.parametrize("document, n", [({"a": 1}, 1), ([{"a": 1}, {"a": 2}], 2), ({"employees": [{"a": 1}, {"a": 2}, {"a": 3}]}, 3)])
def test_json_records_in_three_shapes(spark, tmp_path, document, n):
    path = tmp_path / "records.json"
    path.write_text(json.dumps(document, indent=1))
    rows = tables.read_records(spark, str(path), envelope="employees")
    assert rows.columns == ["a"] and rows.count() == n
    assert tables.read_records(spark, str(path), envelope="employees", schema=rows.schema).count() == n


def test_strict_json_refuses_non_finite_numbers_at_any_depth(spark, tmp_path):
    rows = spark.createDataFrame([({"k": [1.0, float("nan")]},)], "m map<string, array<double>>")
    with pytest.raises(sinks.NonFiniteValue):
        sinks.write_json_strict(rows, str(tmp_path / "out"))
    assert not (tmp_path / "out").exists()


def test_reports_are_never_overwritten(spark, tmp_path):
    rows = spark.range(3)
    sinks.write_report(rows, str(tmp_path), "r1", "t")
    with pytest.raises(Exception, match="already exists"):
        sinks.write_report(rows, str(tmp_path), "r1", "t")
    with pytest.raises(ValueError):
        sinks.write_report(rows, str(tmp_path), "../r1", "t")


def test_nested_cells_have_sorted_keys(spark):
    rows = spark.createDataFrame([({"b": 1, "a": 2}, (2, "x"))], "m map<string, int>, s struct<z: int, c: string>")
    row = sinks.flatten_nested(rows, ["s", "m"]).first()
    assert row.asDict() == {"s": '{"c":"x","z":2}', "m": '{"a":2,"b":1}'}
