"""Every query that has an SQL twin gives the same rows; ordered operators also in their split-range form."""

import pytest
from helpers import compare, connect

import __spark_entry__ as contract

SQL, QUERIES = contract.oracle_sql(), contract.queries()
RANGED = ["C2_describe_numeric", "C4_iqr_outliers", "C7_numeric_by_target", "E1_fit_median", "E6_fit_per_fold", "G3_average_precision",
          "G7_evaluate", "G7_evaluate_models", "G12_capacity", "G13_roc_curve", "G15_bootstrap_ci", "J1_drift_profile", "I3_permutation_importance"]


@pytest.fixture(scope="module")
def db(sf_dir):
    return connect(sf_dir)


def test_every_sql_text_has_its_query():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, sf_dir, db, name):
    assert compare(QUERIES[name](spark, sf_dir), db, SQL[name]) is None


@pytest.mark.parametrize("name", RANGED)
def test_query_matches_sql_in_ranges(spark, sf_dir, db, name, small_ranges):
    assert compare(QUERIES[name](spark, sf_dir), db, SQL[name]) is None


def test_entry_has_a_stable_schema(spark):
    flagship = contract.entry(spark)
    assert {"segment", "pr_auc", "roc_auc", "f1"} <= set(flagship.columns)
    assert flagship.count() == 5
