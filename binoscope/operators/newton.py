"""Penalised logistic regression by Newton steps, for many models in the same passes.

Every model - a penalty, class weights, a held-out fold - has its own medians, modes and scales, yet all read one raw
design: a constant, each numeric with its missing flag, each level with its column's missing flag. A model's prepared
features are a linear map of that design, so a pass adds up gradient and curvature of all models over the raw design,
and the map is applied to the sums. One pass a step: tasks sum, the driver solves systems of the size of a model.

Loss and gradient are every model's own, and a step that no longer moves ends the search; the curvature only shapes the
steps. Models of the same weighting stand close to each other, so one of them, the leader, has its curvature added up, by fold and
label, and the others take it with their own weights, fold and map. A model whose steps do not shrink fast by
that gets its own.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from binoscope.functions.scalars import sigmoid
from binoscope.operators.partials import reduced

MOST_STEPS = 50
LEAST_STEP = 1e-10              # of any coefficient; smaller ones end the search
MOST_HALVINGS = 30
SHRINKING = 0.2                 # a step above this share of the one before asks for a curvature of the model's own


@dataclass(frozen=True)
class Member:
    """One model of a batch: inverse penalty, class weights by frequency or none, and the fold it must not see."""

    C: float = 1.0
    balanced: bool = False
    fold: int | None = None


@dataclass
class Design:
    """The raw design's columns: constant, numerics, their missing flags, levels, the categories' missing flags."""

    numeric: list[str]
    levels: dict[str, list[str]]

    @property
    def width(self) -> int:
        return 1 + 2 * len(self.numeric) + sum(len(v) + 1 for v in self.levels.values())

    def matrix(self, cells: Sequence[pa.Array], rows: int) -> np.ndarray:
        made = np.zeros((rows, self.width))
        made[:, 0] = 1
        d = len(self.numeric)
        for k, column in enumerate(cells[:d]):
            values = column.fill_null(float("nan")).to_numpy(zero_copy_only=False)
            missing = np.isnan(values)
            made[:, 1 + k] = np.where(missing, 0.0, values)
            made[:, 1 + d + k] = missing
        at = 1 + 2 * d
        for (_, levels), column in zip(self.levels.items(), cells[d:]):
            place = pa.compute.index_in(column, value_set=pa.array(levels, pa.string())).fill_null(-1).to_numpy(zero_copy_only=False)
            known = np.flatnonzero(place >= 0)
            made[known, at + place[known]] = 1
            made[:, at + len(levels)] = column.is_null().to_numpy(zero_copy_only=False)
            at += len(levels) + 1
        return made

    def map(self, statistics: Mapping[str, dict], scale: bool = True) -> np.ndarray:
        """(raw columns, prepared columns): fill, scale and code by these statistics; the intercept comes first."""
        d, columns = len(self.numeric), []
        constant = np.zeros(self.width)
        constant[0] = 1
        columns.append(constant)
        for k, name in enumerate(self.numeric):
            median, mean, spread = statistics["numeric"][name]
            mean, spread = (mean, spread) if scale else (0.0, 1.0)
            own = np.zeros(self.width)
            own[1 + k], own[1 + d + k], own[0] = 1 / spread, median / spread, -mean / spread
            columns.append(own)
        at = 1 + 2 * d
        for name, levels in self.levels.items():
            mode, known = statistics["categorical"][name]
            for level in known:
                own = np.zeros(self.width)
                own[at + levels.index(level)] = 1
                own[at + len(levels)] = level == mode
                columns.append(own)
            at += len(levels) + 1
        return np.stack(columns, axis=1)


def _sums(rows: DataFrame, design: Design, members: Sequence[Member], weights: Sequence[tuple[float, float]],
          raw: Mapping[int, np.ndarray], leaders: Mapping[int, np.ndarray]) -> DataFrame:
    """(model, sums) per task: loss and gradient over the raw design at the coefficients `raw`, and, under -1 - model, the
    curvature at those of each leader, unweighted, by held-out fold (those of no model last) and label."""
    width, own_folds = design.width, _folds(members)
    seen = [[k for k in raw if members[k].fold != fold] for fold in own_folds] + [[*raw]]
    at = {k: i for i, k in enumerate(raw)}
    coefficients = np.stack([*raw.values()], axis=1)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        losses, gradients = np.zeros(len(raw)), np.zeros((width, len(raw)))
        curvatures = {k: np.zeros((len(seen), 2, width, width)) for k in leaders}
        for batch in batches:
            y, folds = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            z = design.matrix(batch.columns[2:], batch.num_rows)
            ones, rest = y == 1, np.ones(len(y), dtype=bool)
            for f, models in enumerate(seen):
                inside = folds == own_folds[f] if f < len(own_folds) else rest
                rest = rest & ~inside
                for one in (0, 1):
                    part = np.flatnonzero(inside & (ones == bool(one)))
                    if not len(part):
                        continue
                    own, label = z[part], y[part][:, None]
                    for k, leader in leaders.items():
                        p = 1 / (1 + np.exp(-(own @ leader)))
                        curvatures[k][f, one] += own.T @ (own * (p * (1 - p))[:, None])
                    if models:
                        columns, weight = [at[k] for k in models], np.array([weights[k][one] for k in models])
                        margin = own @ coefficients[:, columns]
                        small = np.exp(-np.abs(margin))
                        p = np.where(margin >= 0, 1.0, small) / (1 + small)
                        losses[columns] += weight * (np.maximum(margin, 0) + np.log1p(small) - label * margin).sum(axis=0)
                        gradients[:, columns] += (own.T @ (p - label)) * weight
        keys = [*raw, *[-1 - k for k in leaders]]
        sums = [np.concatenate([losses[i:i + 1], gradients[:, i]]).tobytes() for i in range(len(raw))] + [c.tobytes() for c in curvatures.values()]
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int32()), pa.array(sums, pa.binary())], names=["model", "sums"])

    return rows.mapInArrow(add, "model int, sums binary")


def _folds(members: Sequence[Member]) -> list[int]:
    return sorted({m.fold for m in members if m.fold is not None})


def probabilities(members: Sequence[Member], coefficients: Sequence[np.ndarray], numeric: Sequence[str], categorical: Sequence[str],
                  statistics: Mapping[int | None, Mapping[str, dict]]) -> Callable[[Sequence[pa.Array], int, Sequence[int]], np.ndarray]:
    """A function (cells, rows, members) -> (rows, members) scores, for the cells of a batch: numerics as doubles, categories as text."""
    levels = {c: sorted({v for m in members for v in statistics[m.fold]["categorical"][c][1]}) for c in categorical}
    design = Design(list(numeric), levels)
    raw = np.stack([design.map(statistics[m.fold]) @ b for m, b in zip(members, coefficients)], axis=1)

    def score(cells: Sequence[pa.Array], rows: int, asked: Sequence[int]) -> np.ndarray:
        return 1 / (1 + np.exp(-(design.matrix(cells, rows) @ raw[:, asked])))
    return score


def _leader(members: Sequence[Member], member: Member) -> int:
    """Of the models of the same weighting, the one with the median penalty."""
    alike = sorted((m.C, k) for k, m in enumerate(members) if m.balanced == member.balanced)
    return alike[len(alike) // 2][1]


def _kept(key: tuple, total: np.ndarray) -> dict:
    return {"model": key[0], "sums": total.tobytes()}


@dataclass
class _Search:
    """A model on its way: where it stands, the step it tries, and the model whose curvature it takes."""

    map: np.ndarray
    penalty: np.ndarray
    at: np.ndarray
    step: np.ndarray
    leader: int
    share: float = 1.0
    moves: int = 0
    loss: float = float("inf")
    done: bool = False
    slow: bool = False

    def told(self, sums: np.ndarray, curvature: np.ndarray) -> None:
        """Take the sums at at + share * step: accept it and solve for the next step, or try half of it."""
        tried = self.at + self.share * self.step
        loss = sums[0] + 0.5 * (self.penalty * tried ** 2).sum()
        if loss > self.loss + 1e-12 * abs(self.loss) and self.share > 0.5 ** MOST_HALVINGS:
            self.share /= 2
            return
        self.at, self.loss, self.share = tried, loss, 1.0
        gradient = self.map.T @ sums[1:] + self.penalty * tried
        last = np.abs(self.step).max()
        self.step = -np.linalg.lstsq(self.map.T @ curvature @ self.map + np.diag(self.penalty), gradient, rcond=None)[0]
        self.done = bool(np.abs(self.step).max() < LEAST_STEP)
        self.moves += 1
        self.slow = self.moves > 2 and bool(np.abs(self.step).max() > SHRINKING * last)


def fit_logistics(rows: DataFrame, members: Sequence[Member], numeric: Sequence[str], categorical: Sequence[str],
                  statistics: Mapping[int | None, Mapping[str, dict]], counts: Mapping[int | None, Mapping[int, int]],
                  fold: str | None = None) -> list[np.ndarray]:
    """Intercept and coefficients of every member, in the order of the prepared features, from (columns..., y, fold).

    `statistics` and `counts` hold, per held-out fold (None: all rows), what was learned from the rows outside it. The loss
    is the weighted sum over rows plus |coefficients|^2 / 2C without the intercept; its minimum is unique, so the result
    does not depend on the steps taken.
    """
    held = {m.fold for m in members}
    levels = {c: sorted({v for f in held for v in statistics[f]["categorical"][c][1]}) for c in categorical}
    design = Design(list(numeric), levels)
    weights, searches = [], []
    for m in members:
        n = counts[m.fold]
        whole = n[0] + n[1]
        weights.append((whole / (2 * n[0]), whole / (2 * n[1])) if m.balanced else (1.0, 1.0))
        made = design.map(statistics[m.fold])
        penalty = np.full(made.shape[1], 1 / m.C)
        penalty[0] = 0
        searches.append(_Search(made, penalty, np.zeros(made.shape[1]), np.zeros(made.shape[1]), _leader(members, m)))
    cells = [F.col(f"`{c}`").cast("double").alias(f"c{i}") for i, c in enumerate(numeric)]
    cells += [F.col(f"`{c}`").cast("string").alias(f"s{i}") for i, c in enumerate(categorical)]
    own = rows.select(F.col("y").cast("int").alias("y"), (F.col(fold).cast("int") if fold else F.lit(-1)).alias("fold"), *cells).persist()
    try:
        partitions = own.rdd.getNumPartitions()
        known: dict[int, np.ndarray] = {}       # curvatures of the leaders, by fold and label
        folds = _folds(members)
        for _ in range(MOST_STEPS):
            waiting = {k: s.map @ (s.at + s.share * s.step) for k, s in enumerate(searches) if not s.done}
            if not waiting:
                break
            # A leader that is done stands where it stood, and so does its curvature.
            leaders = {k: waiting[k] for k in sorted({searches[k].leader for k in waiting}) if k in waiting}
            sums = _sums(own, design, members, weights, waiting, leaders)
            numbers = len(waiting) * (1 + design.width) + len(leaders) * (len(folds) + 1) * 2 * design.width ** 2
            told = {r["model"]: np.frombuffer(r["sums"]) for r in reduced(sums, ["model"], partitions, 1, numbers, _kept, "model int, sums binary")}
            known |= {k: told[-1 - k].reshape(len(folds) + 1, 2, design.width, design.width) for k in leaders}
            for k in waiting:
                s, seen = searches[k], [f for f in range(len(folds) + 1) if f == len(folds) or folds[f] != members[k].fold]
                s.told(told[k], sum(weights[k][one] * known[s.leader][seen, one].sum(axis=0) for one in (0, 1)))
                if s.slow:
                    s.leader = k
    finally:
        own.unpersist()
    return [s.at for s in searches]


def fit_sigmoids(margins: DataFrame, by: str) -> dict[object, tuple[float, float]]:
    """{group: (slope, intercept)} of p = 1 / (1 + exp(-(a m + b))) with smoothed targets, from (by, margin, y).

    Targets are (n1 + 1) / (n1 + 2) for label 1 and 1 / (n0 + 2) for label 0. A Newton step for all groups is one aggregate
    of six sums a group.
    """
    rows = margins.select(F.col(by).alias("g"), F.col("margin").cast("double").alias("m"), "y").persist()
    try:
        sizes = {r["g"]: (r["n0"], r["n1"]) for r in rows.groupBy("g").agg(
            F.count_if(F.col("y") == 0).alias("n0"), F.count_if(F.col("y") == 1).alias("n1")).collect()}
        at = {g: (0.0, float(np.log((n1 + 1) / (n0 + 1)))) for g, (n0, n1) in sizes.items()}
        found = {g: _Sigmoid(np.array(start)) for g, start in at.items()}
        for _ in range(MOST_STEPS):
            waiting = {g: s.at + s.share * s.step for g, s in found.items() if not s.done}
            if not waiting:
                break
            slope, intercept, high, low = (_by_group(waiting, v) for v in (
                lambda g: waiting[g][0], lambda g: waiting[g][1], lambda g: (sizes[g][1] + 1) / (sizes[g][1] + 2), lambda g: 1 / (sizes[g][0] + 2)))
            tried = rows.where(F.col("g").isin(list(waiting))).withColumn("x", slope * F.col("m") + intercept)
            tried = tried.withColumn("p", sigmoid(F.col("x"))).withColumn("t", F.when(F.col("y") == 1, high).otherwise(low))
            off, curve = F.col("p") - F.col("t"), F.col("p") * (1 - F.col("p"))
            loss = F.greatest("x", F.lit(0.0)) + F.log1p(F.exp(-F.abs("x"))) - F.col("t") * F.col("x")
            for r in tried.groupBy("g").agg(*[F.sum(c).alias(n) for n, c in (
                    ("loss", loss), ("ga", off * F.col("m")), ("gb", off), ("haa", curve * F.col("m") ** 2), ("hab", curve * F.col("m")),
                    ("hbb", curve))]).collect():
                found[r["g"]].told(r)
        return {g: (float(s.at[0]), float(s.at[1])) for g, s in found.items()}
    finally:
        rows.unpersist()


def _by_group(groups: Mapping[object, object], value) -> Column:
    chain = F
    for g in groups:
        chain = chain.when(F.col("g") == F.lit(g), F.lit(float(value(g))))
    return chain.otherwise(F.lit(None).cast("double"))


class _Sigmoid:
    def __init__(self, start: np.ndarray):
        self.at, self.step, self.share, self.loss, self.done = start, np.zeros(2), 1.0, float("inf"), False

    def told(self, r) -> None:
        tried = self.at + self.share * self.step
        if r["loss"] > self.loss + 1e-12 * abs(self.loss) and self.share > 0.5 ** MOST_HALVINGS:
            self.share /= 2
            return
        self.at, self.loss, self.share = tried, r["loss"], 1.0
        curvature = np.array([[r["haa"], r["hab"]], [r["hab"], r["hbb"]]])
        self.step = -np.linalg.lstsq(curvature, np.array([r["ga"], r["gb"]]), rcond=None)[0]
        self.done = bool(np.abs(self.step).max() < LEAST_STEP)
