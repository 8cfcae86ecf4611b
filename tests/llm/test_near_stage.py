"""The pipeline's near-duplicate stage, which links at 0.80, against brute force."""

from helpers_llm import documents, prose
from test_pairs import edited, shingle_set

import corpus_pipeline
from binoscope.llm import minhash


def components_at(rows, percent):
    """{doc_id: component} for rows of distinct ids, smallest first."""
    sets, name = {i: shingle_set(t) for i, t in rows}, {i: i for i, _ in rows}
    for a in sets:
        for b in sets:
            if a < b and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                old, new = sorted((name[a], name[b]), reverse=True)
                name = {i: new if c == old else c for i, c in name.items()}
    return name


def test_stage_keeps_one_of_each_at_80(spark, sf_dir):
    """Copies on both sides of 0.8 and of 0.85, and sets of four and five members."""
    base = prose(300, 3)
    texts = [base, *[edited(base, k, k) for k in range(4, 20)], *["a b c d e f g h" + " i" * k for k in range(3)]]
    rows = list(enumerate(texts))
    docs = documents(spark, rows)
    want, at_85 = components_at(rows, 80), components_at(rows, 85)
    assert want != at_85
    assert sorted(r.doc_id for r in corpus_pipeline.near_dedup(spark, docs, sf_dir).collect()) == [i for i, c in want.items() if i == c]
    assert {r.doc_id: r.component_id for r in minhash.near_duplicates(docs).collect()} == at_85


def test_banding_follows_the_bound():
    assert minhash.banding(85) == (42, 6) and minhash.banding(80) == (50, 5)
    assert minhash.could_link(5, 80) and not minhash.could_link(5)
