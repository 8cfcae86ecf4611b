"""The registered queries of the text operators on the smallest tables."""

import re

import pytest
from helpers import compare, connect

import __spark_entry__ as contract
import corpus_pipeline
from binoscope.llm import decontaminate, minhash, pii, queries
from binoscope.llm.shared import written


def test_one_query_for_each_operator():
    numbers = sorted(int(re.match(r"op(\d+)_", n)[1]) for n in queries.QUERIES)
    assert numbers == list(range(1, 14))
    assert {*queries.QUERIES, "pipeline"} <= set(contract.queries()) and set(queries.SQL) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_matches_sql(spark, sf_dir, name):
    assert compare(queries.QUERIES[name](spark, sf_dir), connect(sf_dir), queries.SQL[name]) is None


def test_pipeline_stages(spark, sf_dir):
    """Each stage keeps what it should; the packed pieces are those of the last documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, seen = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        seen[name] = docs = written(stage(spark, docs, sf_dir), name)
        if name != "best_fit_packing":
            assert docs.columns == columns
    bench = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    assert minhash.near_duplicates(seen["near_dedup"]).where("not kept").count() == 0
    assert decontaminate.find_benchmark(seen["decontamination"], bench).where("n_hit > 0").count() == 0
    assert seen["decontamination"].count() == seen["near_dedup"].count() == seen["pii_surrogates"].count()
    old = {c for r in seen["decontamination"].collect() for *_, c in pii.mentions(r.text)}
    new = {c for r in seen["pii_surrogates"].collect() for *_, c in pii.mentions(r.text)}
    assert old and not old & new
    packed = seen["best_fit_packing"]
    assert packed.select("doc_id").distinct().count() == seen["pii_surrogates"].count()
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "near_dedup", "decontamination", "pii_surrogates", "best_fit_packing"]
