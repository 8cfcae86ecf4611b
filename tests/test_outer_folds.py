"""Nested evaluations run their outer folds side by side, and give rows and failures in the order of the folds."""

import threading

import pytest

from binoscope.operators import metrics, models, selection

FEATURES = models.Features(("a",), ())


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame([(k, float(k % 7), k % 2) for k in range(40)], "id long, a double, y int")


def told(procedure, fold, choice, held_out):
    return {"procedure": procedure, "outer_fold": fold, "selected_model": choice, "parameters": {}, "threshold": 0.5, "inner_cv_ap": None,
            "trials_completed": None, **{m: float(held_out.count()) for m in metrics.FOLD_METRICS}}


@pytest.fixture
def together(monkeypatch):
    """Procedures that end only if another one runs at the same time."""
    meeting = threading.Barrier(2)

    def run(*_):
        meeting.wait(timeout=60)
        return "chosen"
    monkeypatch.setattr(selection, "run_procedure", lambda *a, **k: run())
    monkeypatch.setattr(selection, "search_procedure", lambda *a, **k: (run(), [{"number": 0}]))
    monkeypatch.setattr(selection, "fold_row", told)


def test_procedures_of_outer_folds_run_side_by_side(rows, together):
    found = selection.nested_cv(rows, [], FEATURES, outer=2).collect()
    assert [(r.outer_fold, r.procedure) for r in found] == [(0, "fixed"), (0, "tuned"), (1, "fixed"), (1, "tuned")]
    assert sum(r.pr_auc for r in found if r.procedure == "fixed") == 40


def test_searches_and_baselines_run_side_by_side(rows, together):
    searches = []
    found = selection.nested_search(rows, [], FEATURES, outer=3, searches=searches).collect()
    assert [(r.outer_fold, r.procedure) for r in found] == [(f, p) for f in range(3) for p in ("search", "baseline_fixed")]
    assert [(s["outer_fold"], s["arm"], len(s["trials"])) for s in searches] == [(f, "search", 1) for f in range(3)]


def test_the_first_fold_without_success_is_told_with_those_before(rows, monkeypatch):
    calls = []

    def searching(*_):
        calls.append(1)
        if len(calls) == 2:
            raise selection.NoSuccessfulSearch([{"number": 0, "state": "FAIL"}])
        return "chosen", [{"number": 0}]
    monkeypatch.setattr(models, "PARALLEL_FITS", 1)
    monkeypatch.setattr(selection, "search_procedure", searching)
    monkeypatch.setattr(selection, "run_procedure", lambda *a, **k: "chosen" if len(calls) < 2 else 1 / 0)
    monkeypatch.setattr(selection, "fold_row", told)
    searches = []
    with pytest.raises(selection.NoSuccessfulSearch) as failure:
        selection.nested_search(rows, [], FEATURES, outer=4, searches=searches)
    assert [(r["outer_fold"], r["procedure"]) for r in failure.value.completed] == [(0, "search"), (0, "baseline_fixed")]
    assert [s["outer_fold"] for s in searches] == [0, 1] and searches[1]["trials"][0]["state"] == "FAIL"
    assert len(calls) == 2
