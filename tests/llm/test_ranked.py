"""Ranked search by interval bounds against scoring every document."""

import math
import re
from collections import Counter

import numpy as np
import pytest
from helpers_llm import documents, edge_texts, prose

from binoscope.llm import ranked


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items, top=20):
    """{item: [(doc_id, score)]} by scoring all documents; null ids last on ties."""
    held = [(d, Counter(words(t))) for d, t in docs if words(t)]
    total = sum(c.total() for _, c in held)
    df = Counter(w for _, c in held for w in c)
    found = {}
    for item, text in items:
        scores = []
        for d, c in held:
            m = 75 + (25 * c.total() * len(held)) // total
            score = sum(math.floor(1000 * math.log((2 * len(held) + 2) / (2 * df[w] + 1))) * (1_000_000_000 * c[w] // (1_000 * c[w] + 12 * m))
                        for w in words(text) if c[w])
            if score > 0:
                scores.append((d, score))
        best = sorted(scores, key=lambda x: (-x[1], x[0] is None, x[0] or 0))[:top]
        if best:
            found[item] = best
    return found


def got(table):
    rows = {}
    for r in table.orderBy("item_id", "rank").collect():
        rows.setdefault(r.item_id, []).append((r.doc_id, r.score))
        assert r["rank"] == len(rows[r.item_id])
    return rows


@pytest.fixture(scope="module")
def corpus():
    texts = [*edge_texts(), *(prose(5 + 7 * (k % 13), k) for k in range(260)), *["copies of one text, alpha beta"] * 60]
    return [(len(texts) - k, t) for k, t in enumerate(texts)]


@pytest.fixture(scope="module")
def items():
    return [(1, prose(30, 3)), (2, "alpha"), (3, "beta, beta of; the ALPHA copies"), (4, ""), (5, None), (6, "nowhere"), (7, prose(900, 8)),
            (8, "日本語 alpha"), (9, "copies of one text, alpha beta"), (10, "!?")]


@pytest.mark.parametrize("shard, block, splits", [(1_000_000, 200_000, 1_024), (150, 200_000, 3), (400, 10, 1_024), (1, 1, 1)])
def test_ranks_match_brute_force(spark, corpus, items, shard, block, splits, monkeypatch):
    monkeypatch.setattr(ranked, "SHARD_POSTINGS", shard)
    monkeypatch.setattr(ranked, "BLOCK_TERMS", block)
    monkeypatch.setattr(ranked, "_MOST_SPLITS", splits)
    some = corpus if shard > 1 else corpus[:40]
    table = ranked.rank_documents(documents(spark, some), spark.createDataFrame(items, "item_id long, text string"))
    assert table.dtypes == [("item_id", "bigint"), ("rank", "int"), ("doc_id", "bigint"), ("score", "bigint")]
    assert got(table) == brute(some, items)


def test_bounded_cells_give_the_same(spark, corpus, items, monkeypatch):
    monkeypatch.setattr(ranked, "CELLS", 500)
    table = ranked.rank_documents(documents(spark, corpus), spark.createDataFrame(items, "item_id long, text string"))
    assert got(table) == brute(corpus, items)


def test_nulls_repeats_and_clashing_names(spark):
    rows = [(3, "alpha beta", "en", 1, "x"), (3, "alpha beta", "en", 1, "x"), (None, "alpha beta", "en", 1, "x"), (1, "beta gamma gamma", "en", 1, "x"),
            (2, None, "en", 1, "x"), (9, "delta", "en", 1, "x"), (8, "delta", "en", 1, "x"), (7, "delta", "en", 1, "x")]
    docs = documents(spark, rows, ", score int, rank string")
    asked = spark.createDataFrame([(1, "alpha", "y"), (None, "gamma", "y")], "item_id long, text string, id string")
    table = ranked.rank_documents(docs, asked)
    assert [(r.doc_id, r["rank"]) for r in table.where("item_id = 1").orderBy("rank").collect()] == [(3, 1), (3, 2), (None, 3)]
    assert [(r.doc_id, r["rank"]) for r in table.where("item_id is null").collect()] == [(1, 1)]
    twice = ranked.rank_documents(docs, spark.createDataFrame([(1, "gamma"), (1, "gamma")], "item_id long, text string"))
    assert [r.doc_id for r in twice.collect()] == [1, 1]


def test_empty_tables(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    some = spark.createDataFrame([(1, "alpha")], "item_id long, text string")
    assert ranked.rank_documents(documents(spark, []), some).count() == 0
    assert ranked.rank_documents(documents(spark, [(1, "alpha")]), none).count() == 0
    assert ranked.rank_documents(documents(spark, [(1, None), (2, "")]), some).count() == 0


def test_range_maxima_name_the_first_strongest():
    rng = np.random.default_rng(4)
    terms, docs = np.repeat(np.arange(5), 40), np.tile(np.arange(40), 5)
    impacts = rng.integers(1, 6, 200)
    shard = ranked.Shard(terms, docs, impacts, 40)
    low = rng.integers(0, 40, 500)
    high = np.minimum(40, low + rng.integers(0, 41, 500))
    base = 40 * rng.integers(0, 5, 500)
    for a, b, found in zip(low + base, high + base, shard.strongest(low + base, high + base)):
        assert found == (a + int(np.argmax(impacts[a:b])) if b > a else 200)


def test_bounds_leave_most_documents_alone():
    """A rare passage is found after a few splits, not by scoring everything."""
    rng = np.random.default_rng(1)
    size = 20_000
    terms = np.concatenate([np.zeros(size, dtype=np.int64), *(np.full(30, t) for t in range(1, 30))])
    docs = np.concatenate([np.arange(size), *(np.sort(rng.choice(size, 30, replace=False)) for _ in range(1, 30))])
    docs[-1], docs[-31] = size - 1, size - 1
    shard = ranked.Shard(terms, docs, rng.integers(100_000, 400_000, len(docs)), size)
    weights = np.append(10, np.full(29, 7_000))
    best, scores, splits = ranked.best_documents(shard, np.arange(30), weights, 20, 0)
    want = np.zeros(size, dtype=np.int64)
    np.add.at(want, shard.documents, shard.impacts[:-1] * weights[shard.keys // size])
    order = np.lexsort((np.arange(size), -want))[:20]
    assert best.tolist() == order.tolist() and scores.tolist() == want[order].tolist()
    assert splits < size / 5
