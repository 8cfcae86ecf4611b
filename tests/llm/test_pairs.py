"""Near-duplicates against brute force over all pairs."""

import re

import pytest
from helpers_llm import documents, edge_texts, prose

from binoscope.llm import minhash
from binoscope.llm.components import components


def shingle_set(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset(tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def brute(rows):
    """{doc_id: (n, component)} for rows of distinct ids."""
    sets = {i: shingle_set(t) for i, t in rows}
    name = {i: i for i in sets}

    def root(x):
        while name[x] != x:
            x = name[x]
        return x
    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1:]:
            both = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * both >= 85 * (len(sets[a]) + len(sets[b]) - both):
                low, high = sorted((root(a), root(b)))
                name[high] = low
    return {i: (len(sets[i]), root(i)) for i in ids}


def edited(text, places, seed):
    words = text.split()
    for k in range(places):
        words[(seed * 131 + k * 37) % len(words)] = f"edit{seed}x{k}"
    return " ".join(words)


@pytest.fixture(scope="module")
def rows():
    base, other = prose(150, 1), prose(300, 2)
    texts = [*edge_texts(), base, base.upper(), *[edited(base, k % 4, k) for k in range(40)], other,
             *[edited(other, 6, k) for k in range(10)], *[prose(80, 50 + k) for k in range(30)], "", None, "word"]
    return [(7 * k + 3, t) for k, t in enumerate(texts)]


def test_components_match_all_pairs(spark, rows):
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in minhash.near_duplicates(documents(spark, rows)).collect()}
    want = {i: (n, c, i == c) for i, (n, c) in brute(rows).items()}
    assert got == want


@pytest.mark.parametrize("most", [16, 0])
def test_blocks_give_the_same(spark, rows, monkeypatch, most):
    """Groups cut into many blocks, and compared within buckets."""
    monkeypatch.setattr(minhash, "BLOCK_CLASSES", 5)
    monkeypatch.setattr(minhash, "MOST_BLOCKS", most)
    got = {r.doc_id: r.component_id for r in minhash.near_duplicates(documents(spark, rows)).collect()}
    assert got == {i: c for i, (_, c) in brute(rows).items()}


def test_keep_first_keeps_one_of_each(spark, rows):
    kept = minhash.keep_first(documents(spark, [*rows, rows[10], (None, "lone"), (None, None)]))
    assert kept.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    ids = sorted(r.doc_id for r in kept.collect() if r.doc_id is not None)
    assert ids == sorted(i for i, (_, c) in brute(rows).items() if i == c)
    assert kept.where("doc_id is null").count() == 2


def test_null_ids_repeats_and_clashing_names(spark):
    docs = documents(spark, [(5, "same text here", "en", 1, "k"), (5, "same text here", "en", 2, "k"), (None, "same text here", "en", 3, "k"),
                             (2, "same text here", "en", 4, "k")], ", n long, h1 string")
    got = sorted((r.doc_id or 0, r.component_id or 0, r.kept) for r in minhash.near_duplicates(docs).collect())
    assert got == [(0, 0, True), (2, 2, True), (5, 2, False), (5, 2, False)]
    assert [r.doc_id for r in minhash.keep_first(docs).where("doc_id is not null").collect()] == [2]


def test_empty_table(spark):
    empty = documents(spark, [])
    assert minhash.near_duplicates(empty).count() == 0
    assert minhash.keep_first(empty).columns == empty.columns


def test_components_of_a_long_path_and_a_star(spark):
    edges = [(k, k + 1) for k in range(40)] + [(100, 100 + k) for k in range(1, 30)] + [(7, 7)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()}
    assert got == {k: 0 for k in range(41)} | {100 + k: 100 for k in range(30)}
