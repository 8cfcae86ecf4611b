"""Counterfactuals of the toxicity model change every feature that the swapped text changes."""

from collections import Counter

import numpy as np
from helpers_llm import documents, prose

from binoscope.llm import toxicity


def test_counterfactuals_are_those_of_the_swapped_text():
    text = "Christians, christmas and christians; a woman".encode()
    got = {(out, into): (set(gone), set(come)) for out, into, gone, come in toxicity.counterfactuals(text)}
    assert Counter(out for out, _ in got) == {b"christians": 5, b"woman": 3}
    for (out, into), (gone, come) in got.items():
        new = toxicity.features(text.lower().replace(out, into))
        assert (toxicity.features(text) - gone) | come == new and not gone & new and not come & toxicity.features(text)
    assert {b"^christ*2", b"^christ*3"} <= got[b"christians", b"muslims"][0] and b"^christ*1" not in got[b"christians", b"muslims"][0]
    assert b"^muslim*2" in got[b"christians", b"muslims"][1]
    both = {into: (gone, come) for out, into, gone, come in toxicity.counterfactuals(b"woman man") if out == b"woman"}
    assert both[b"man"] == ([b"woman"], [])


def test_group_weight_does_not_move_to_beginnings(spark):
    rows, labels = [], []
    for k in range(240):
        toxic, group = k % 3 == 0, k % 5
        text = prose(25, k) + (" immigrants" if toxic or group == 0 else " citizens" if group == 1 else "") + (" idiot scum" if toxic and k % 2 else "")
        rows.append((k, " ".join(np.random.default_rng(k).permutation(text.split()).tolist())))
        labels.append((k, int(toxic)))
    model = toxicity.fit(documents(spark, rows), spark.createDataFrame(labels, "doc_id long, toxic int"))
    gap = abs(model.score(b"we met immigrants today") - model.score(b"we met citizens today"))
    assert gap < 0.1
