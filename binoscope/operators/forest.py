"""Random forests on binned columns: all trees grow level by level over rows that are coded once.

A row is a few bytes of bin numbers and its label. A level of all trees is one job: each task draws its rows' bags anew from
the seed, walks the bagged rows down to the leaves that wait for a split, and counts them by (leaf, drawn feature, label,
bin). Counts are whole numbers, added up by tree; only the best split of each leaf comes back. Trees whose counts would
be too many for a task take turns. What is computed is what Spark ML's forest computes: Poisson bags, Gini gains on class
weights, rows a leaf by the bag, sibling leaves of the same class merged, importances by weighted gain.
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.ml.linalg import DenseVector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from binoscope.operators.boost import Layout, bin_edges
from binoscope.session import shared_folder

BINS = 32
GAIN_DIGITS = 12                # gains that agree to so many digits are a tie; the earlier drawn feature, then the lower edge wins
ROWS_PER_BLOCK = 65_536
COUNT_BYTES = 64 * 2 ** 20      # of the trees that one job counts, in a task
_BAG, _TAKE = 1, 2              # purposes of random draws
# How often a row is in a bag, by 16 random bits: Poisson of mean 1, each share to 1 / 65,536.
_TIMES = np.searchsorted(np.cumsum([math.exp(-1) / math.factorial(k) for k in range(9)]), (np.arange(2 ** 16) + 0.5) / 2 ** 16).astype(np.uint8)


def drawn(*key: int) -> np.random.Generator:
    return np.random.Generator(np.random.PCG64([k & (2 ** 64 - 1) for k in key]))


def bag(seed: int, tree: int, part: int, block: int, rows: int) -> np.ndarray:
    """How often each row of a block is in the bag of a tree."""
    return _TIMES[np.frombuffer(drawn(seed, _BAG, tree, part, block).bytes(2 * rows), dtype=np.uint16)]


def features_of(strategy: str, slots: int) -> int:
    """How many features a node draws, in the words that Spark ML takes."""
    named = {"auto": math.sqrt(slots), "sqrt": math.sqrt(slots), "all": slots, "onethird": slots / 3, "log2": max(1.0, math.log2(slots))}
    if strategy in named:
        return math.ceil(named[strategy])
    whole = strategy.isdigit() and int(strategy) > 0
    if not whole and not 0 < float(strategy) <= 1:
        raise ValueError(f"Unknown feature strategy {strategy!r}.")
    return min(int(strategy), slots) if whole else math.ceil(float(strategy) * slots)


@dataclass
class Slots:
    """The features: a numeric's bin, or whether a category is one of its levels.

    A slot reads the code of its column XOR its level (0 for numerics): a numeric's bin, or 0 where the level is met. Rows
    with at most `cut` go to the left.
    """

    layout: Layout
    fills: list[int]            # per column, the code that missing cells take

    @property
    def column(self) -> np.ndarray:
        n = len(self.layout.numeric)
        return np.array([*range(n), *[n + k for k, c in enumerate(self.layout.categorical) for _ in self.layout.levels[c]]], dtype=np.int64)

    @property
    def level(self) -> np.ndarray:
        return np.array([0] * len(self.layout.numeric) + [k for c in self.layout.categorical for k in range(len(self.layout.levels[c]))])

    @property
    def cuts(self) -> np.ndarray:
        """How many cuts a slot has."""
        return np.array([len(self.layout.edges[c]) for c in self.layout.numeric] + [1 for c in self.layout.categorical for _ in self.layout.levels[c]])

    @property
    def bins(self) -> int:
        return max(2, *[len(e) + 1 for e in self.layout.edges.values()]) if self.layout.edges else 2

    @property
    def type(self) -> type:
        return np.uint8 if max(self.layout.sizes()) < 2 ** 8 else np.uint16

    def codes(self, cells: Sequence[pa.Array]) -> np.ndarray:
        """(rows, columns) codes without missing ones."""
        found = self.layout.codes(cells)
        for own, size, fill in zip(found, self.layout.sizes(), self.fills):
            own[own == size - 1] = fill
        return np.ascontiguousarray(found.T, dtype=self.type)

    def cells(self) -> list:
        return [F.col(f"`{c}`").cast("double" if c in self.layout.edges else "string") for c in self.layout.columns]


@dataclass
class Walk:
    """A tree as tables by node; a node without a split leads to itself."""

    column: np.ndarray
    level: np.ndarray
    cut: np.ndarray
    left: np.ndarray            # the node to the right follows it
    steps: int

    @classmethod
    def of(cls, slots: Slots, slot: Sequence[int], cut: Sequence[int], left: Sequence[int], steps: int) -> "Walk":
        split, kind = np.array(slot) >= 0, slots.type
        known = np.where(split, slot, 0)
        return cls(slots.column[known], slots.level[known].astype(kind), np.where(split, cut, np.iinfo(kind).max).astype(kind),
                   np.where(split, left, np.arange(len(slot))), steps)

    def nodes(self, codes: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """The nodes of rows that begin at these places of the flat codes."""
        at = np.zeros(len(starts), dtype=np.int64)
        for _ in range(self.steps):
            bins = codes.take(starts + self.column.take(at)) ^ self.level.take(at)
            at = self.left.take(at) + (bins > self.cut.take(at))
        return at


class Growing:
    """A tree in the making: its nodes, and those of the deepest level that wait for a split, with the features they drew."""

    def __init__(self, number: int, seed: int, slots: int, taken: int):
        self.number, self.seed, self.slots, self.taken = number, seed, slots, taken
        self.slot, self.cut, self.left, self.gain, self.counts = [-1], [-1], [-1], [0.0], [(0, 0)]
        self.waiting = [0]

    def subsets(self) -> np.ndarray:
        """(waiting nodes, features) that were drawn."""
        order = drawn(self.seed, _TAKE, self.number, self.waiting[0]).random((len(self.waiting), self.slots))
        return np.argsort(order, axis=1)[:, :self.taken]

    def told(self, found: Sequence[tuple], weights: tuple[float, float], last: bool) -> None:
        """Splits of the waiting nodes; their children wait unless they are pure, or of the last level."""
        waiting, self.waiting = self.waiting, []
        for node, (gain, slot, cut, low, high) in zip(waiting, found):
            self.counts[node] = (low[0] + high[0], low[1] + high[1])
            if slot < 0:
                continue
            self.gain[node], self.slot[node], self.cut[node], self.left[node] = gain, slot, cut, len(self.slot)
            for counts in (low, high):
                if not last and gini(*[c * w for c, w in zip(counts, weights)]) > 0:
                    self.waiting.append(len(self.slot))
                for own, empty in ((self.slot, -1), (self.cut, -1), (self.left, -1), (self.gain, 0.0), (self.counts, counts)):
                    own.append(empty)

    def merge(self, weights: tuple[float, float]) -> None:
        """Sibling leaves that predict the same class become their parent; nodes are numbered from above."""
        def predicts(node: int) -> bool:
            return self.counts[node][1] * weights[1] > self.counts[node][0] * weights[0]
        for node in range(len(self.slot) - 1, -1, -1):
            if self.slot[node] >= 0:
                a, b = self.left[node], self.left[node] + 1
                if self.slot[a] < 0 and self.slot[b] < 0 and predicts(a) == predicts(b):
                    self.slot[node] = -1


def gini(a, b):
    """Impurity of two class weights."""
    total = np.maximum(a + b, np.finfo(float).tiny)
    return 1 - (a / total) ** 2 - (b / total) ** 2


def best_splits(counts: np.ndarray, subsets: np.ndarray, cuts: np.ndarray, least: int, weights: tuple[float, float]) -> list[tuple]:
    """(gain, slot or -1, cut, counts to the left, counts to the right) of each node, from (features, nodes, 2, bins) counts."""
    low = np.cumsum(counts, axis=3)
    whole = low[..., -1:]
    low = low[..., :-1]
    high = whole - low
    w = np.array(weights).reshape(2, 1)
    (a0, a1), (b0, b1) = (np.moveaxis(side * w, 2, 0) for side in (low, high))
    total = np.maximum(a0 + a1 + b0 + b1, np.finfo(float).tiny)
    gain = gini(a0 + b0, a1 + b1) - (a0 + a1) / total * gini(a0, a1) - (b0 + b1) / total * gini(b0, b1)
    allowed = np.arange(low.shape[3]) < cuts[subsets.T][..., None]
    allowed = allowed & (low.sum(axis=2) >= least) & (high.sum(axis=2) >= least)
    gain = np.where(allowed, np.round(gain, GAIN_DIGITS), 0.0).transpose(1, 0, 2)      # (nodes, features, cuts)
    found = []
    for node, own in enumerate(gain):
        k, cut = divmod(int(own.argmax()), own.shape[1])
        sides = [tuple(int(c) for c in side[k, node, :, cut]) for side in (low, high)]
        found.append((float(own[k, cut]), int(subsets[node, k]) if own[k, cut] > 0 else -1, cut, *sides))
    return found


Block = tuple[int, int, np.ndarray, np.ndarray]        # partition, number within it, flat codes, labels


def _blocks(df: DataFrame, slots: Slots) -> RDD:
    """Blocks of coded rows, several Arrow batches each."""
    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                y = batch.column(0)
                if y.null_count or not np.isin(y.to_numpy(), (0, 1)).all():
                    raise ValueError("Fitting needs labels that are 0 or 1.")
                parts = [slots.codes(batch.columns[1:]).tobytes(), y.to_numpy().astype(np.uint8).tobytes()]
                yield pa.RecordBatch.from_arrays([pa.array([p], pa.binary()) for p in parts], names=["codes", "y"])

    def joined(part: int, rows: Iterator) -> Iterator[Block]:
        codes, y, number = [], [], 0

        def block() -> Block:
            return part, number, np.frombuffer(b"".join(codes), dtype=slots.type), np.frombuffer(b"".join(y), dtype=np.uint8)
        for row in rows:
            codes.append(row["codes"])
            y.append(row["y"])
            if sum(map(len, y)) >= ROWS_PER_BLOCK:
                yield block()
                codes, y, number = [], [], number + 1
        if y:
            yield block()

    cells = [c.alias(f"c{i}") for i, c in enumerate(slots.cells())]
    coded = df.select(F.col("y").cast("int").alias("y"), *cells).mapInArrow(code, "codes binary, y binary")
    return coded.rdd.mapPartitionsWithIndex(joined)


def _counted(blocks: RDD, asked, slots: Slots, seed: int) -> RDD:
    """(tree, counts) by (feature drawn, waiting node, label, bin), added up per partition; asked: {tree: (walk, waiting, subsets)}."""
    width, bins = len(slots.layout.columns), slots.bins
    column, level = slots.column, slots.level.astype(slots.type)

    def add(part: Iterator[Block]) -> Iterator[tuple[int, np.ndarray]]:
        total: dict[int, np.ndarray] = {}
        for number, block, codes, y in part:
            for tree, (walk, waiting, subsets) in asked.value.items():
                times = bag(seed, tree, number, block, len(y))
                rows = np.flatnonzero(times)
                starts = rows * width
                at = walk.nodes(codes, starts)
                place = np.full(len(walk.left), -1)
                place[waiting] = np.arange(len(waiting))
                at = place.take(at)
                if (at < 0).any():
                    open_ = at >= 0
                    rows, starts, at = rows[open_], starts[open_], at[open_]
                times, cells = times.take(rows).astype(float), (at * 2 + y.take(rows)) * bins
                own = total.setdefault(tree, np.zeros((subsets.shape[1], len(waiting) * 2 * bins)))
                for k, drawn_ in enumerate(subsets.T):
                    # XOR gives numbers beyond the bins too: all of them are "another level".
                    found = np.minimum(codes.take(starts + column[drawn_].take(at)) ^ level[drawn_].take(at), bins - 1)
                    own[k] += np.bincount(cells + found, times, own.shape[1])
        for tree, own in total.items():
            yield tree, own.astype(np.int64).reshape(len(own), -1, 2, bins)

    return blocks.mapPartitions(add)


@dataclass
class Forest:
    """A fitted forest: per tree its splits by node, and the weighted share of label 1 in every node."""

    slots: Slots
    trees: list[dict]           # slot, cut, left, share (None without rows), importance by slot
    depth: int

    @property
    def featureImportances(self) -> DenseVector:
        """By slot, summing to 1: gains times weights of each tree, as shares of the tree's sum."""
        total = np.zeros(len(self.slots.column))
        for tree in self.trees:
            own = np.array(tree["importance"])
            total += own / own.sum() if own.sum() else 0
        return DenseVector(total / total.sum() if total.sum() else total)

    def probabilities(self, codes: np.ndarray) -> np.ndarray:
        starts, total, counted = np.arange(len(codes)) * codes.shape[1], np.zeros(len(codes)), 0
        codes = codes.ravel()
        for tree in self.trees:
            if tree["share"][0] is not None:
                walk = Walk.of(self.slots, tree["slot"], tree["cut"], tree["left"], self.depth)
                total += np.array(tree["share"]).take(walk.nodes(codes, starts))
                counted += 1
        return total / max(counted, 1)

    def score(self, df: DataFrame, name: str = "p") -> DataFrame:
        """The input columns plus the probability, in one Arrow pass without a shuffle."""
        @F.arrow_udf("double")
        def probability(*cells: pa.Array) -> pa.Array:
            return pa.array(self.probabilities(self.slots.codes(cells)))

        return df.withColumn(name, probability(*self.slots.cells()))

    def save(self, spark: SparkSession, path: str) -> None:
        """One row with the whole model, which is of a size that depends on its settings only."""
        told = {"layout": vars(self.slots.layout), "fills": self.slots.fills, "trees": self.trees, "depth": self.depth}
        spark.createDataFrame([(json.dumps(told),)], "forest string").coalesce(1).write.parquet(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "Forest":
        told = json.loads(spark.read.parquet(path).first()["forest"])
        return cls(Slots(Layout(**told["layout"]), told["fills"]), told["trees"], told["depth"])


def _finished(tree: Growing, slots: Slots, weights: tuple[float, float]) -> dict:
    tree.merge(weights)
    sizes = [(a * weights[0], b * weights[1]) for a, b in tree.counts]
    importance = np.zeros(len(slots.column))
    reached = [0]
    for node in reached:
        if tree.slot[node] >= 0:
            importance[tree.slot[node]] += tree.gain[node] * sum(sizes[node])
            reached += [tree.left[node], tree.left[node] + 1]
    return {"slot": tree.slot, "cut": tree.cut, "left": tree.left, "share": [b / (a + b) if a + b else None for a, b in sizes],
            "importance": importance.tolist()}


def fit_forest(rows: DataFrame, numeric: Sequence[str], categorical: Sequence[str], statistics: Mapping[str, dict], trees: int, depth: int,
               leaf: int, features: str, weights: tuple[float, float] = (1.0, 1.0), seed: int = 42) -> Forest:
    """Fit on (columns..., y); `statistics` hold the medians, modes and levels that missing cells and slots are made of.

    An edge is a value at an equal share of rows, with missing cells filled. Draws depend on the seed and, as in Spark ML, on
    how rows lie in partitions; the coded rows are checkpointed, so that every level sees them in the same places.
    """
    if trees < 1 or depth < 0 or leaf < 1:
        raise ValueError("A forest needs a tree and a row a leaf at least.")
    known = {c: statistics["numeric"][c][0] for c in numeric}
    filled = rows.select(*[F.coalesce(F.nanvl(F.col(f"`{c}`").cast("double"), F.lit(None)), F.lit(float(known[c]))).alias(c) for c in numeric])
    levels = {c: list(statistics["categorical"][c][1]) for c in categorical}
    layout = Layout(list(numeric), list(categorical), bin_edges(filled, numeric, BINS)[None], levels)
    if max(layout.sizes()) > 2 ** 16:
        raise ValueError("A category of a forest has at most 65,534 levels.")
    modes = [statistics["categorical"][c][0] for c in categorical]
    fills = [int(np.searchsorted(layout.edges[c], known[c])) for c in numeric]
    fills += [own.index(mode) if mode in own else len(own) for own, mode in zip(levels.values(), modes)]
    slots = Slots(layout, fills)
    taken, cuts = features_of(features, len(slots.column)), slots.cuts
    grown = [Growing(k, seed, len(cuts), taken) for k in range(trees)]
    blocks = _blocks(rows, slots).persist(StorageLevel.MEMORY_AND_DISK)
    context = blocks.context
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(rows.sparkSession))
    blocks.checkpoint()
    try:
        for step in range(max(depth, 1)):
            left = [t for t in grown if t.waiting]
            while left:
                sizes = np.cumsum([len(t.waiting) * taken * 2 * slots.bins * 8 for t in left])
                now = max(1, int(np.searchsorted(sizes, COUNT_BYTES, side="right")))
                some, left = left[:now], left[now:]
                asked = {t.number: (Walk.of(slots, t.slot, t.cut, t.left, step), t.waiting, t.subsets()) for t in some}
                shared = context.broadcast(asked)
                counted = _counted(blocks, shared, slots, seed).reduceByKey(np.add, min(len(some), blocks.getNumPartitions()))
                found = dict(counted.map(lambda row: (row[0], best_splits(row[1], shared.value[row[0]][2], cuts, leaf, weights))).collect())
                for t in some:
                    t.told(found.get(t.number, []) if depth else [(0.0, -1, -1, *f[3:]) for f in found.get(t.number, [])], weights, step + 1 >= depth)
                shared.destroy()
        return Forest(slots, [_finished(t, slots, weights) for t in grown], depth)
    finally:
        blocks.unpersist()
