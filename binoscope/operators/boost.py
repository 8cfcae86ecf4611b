"""Gradient boosting on binned columns: leaves grow best first up to an exact number, for many models at once.

The table is coded once into blocks: a byte matrix of bin numbers with the label, the fold and the margins of every model.
All models of a batch - settings times held-out folds - share the scans: one job adds up the gradient histograms of all
leaves that wait for a split, by (model, leaf, column, bin), and sends back one best split for each. A model reads only
the rows outside its fold, with its own bin edges, its own median or mode for missing cells, and its own class weights.

A leaf's children are looked at before it is split, for all leaves of the tree in the same job, so a tree takes about as
many jobs as it has levels and still splits in the order of the gains. No row is shuffled; what travels are histograms,
whose size depends on columns, bins and models only.

A round over few rows is all waiting for its small jobs. Models of at most `binoscope.rowsPerBucket` training rows, which a
task may hold by themselves, are grown side by side instead, all rounds of a model in one task over the same blocks.
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from binoscope.functions.scalars import melt, sigmoid
from binoscope.operators.order import running_totals, split_points
from binoscope.operators.partials import FETCHED_BYTES
from binoscope.session import rows_per_bucket, shared_folder

BINS = 255
LEAST_HESSIAN = 1e-3            # of a leaf, as its curvature divides
GAIN_DIGITS = 9                 # gains that agree to so many digits are a tie; the earlier column, then the lower edge wins
ROUNDS_PER_CHECKPOINT = 30      # of the chain of margins
ROUNDS_HELD = 5                 # so many rounds' margins are cached before the older ones are let go
JOINT_CELLS = 1024              # columns of few bins are counted together, up to so many cells
_TINY = 1e-15


@dataclass(frozen=True)
class Member:
    """One model of a batch: its settings, and the fold it must not see (None: it sees every row)."""

    rounds: int = 150
    rate: float = 0.05
    leaves: int = 7
    leaf: int = 20
    l2: float = 0.0
    balanced: bool = False
    fold: int | None = None


@dataclass
class Layout:
    """How raw cells become bin numbers: numerics by the edges of all models together, categories by their levels.

    A numeric has one bin more than edges; behind the bins of a column come one for unseen values and one for missing ones.
    """

    numeric: list[str]
    categorical: list[str]
    edges: dict[str, list[float]]
    levels: dict[str, list[str]]

    @property
    def columns(self) -> list[str]:
        return [*self.numeric, *self.categorical]

    def sizes(self) -> list[int]:
        return [len(self.edges[c]) + 3 for c in self.numeric] + [len(self.levels[c]) + 2 for c in self.categorical]

    def codes(self, cells: Sequence[pa.Array]) -> np.ndarray:
        """(columns, rows) bin numbers."""
        size = self.sizes()
        found = np.empty((len(size), len(cells[0]) if cells else 0), dtype=np.uint16)
        for k, (name, column) in enumerate(zip(self.columns, cells)):
            column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
            if name in self.edges:
                values = column.cast(pa.float64()).fill_null(math.nan).to_numpy(zero_copy_only=False)
                found[k] = np.where(np.isnan(values), size[k] - 1, np.searchsorted(self.edges[name], values))
            else:
                place = pa.compute.index_in(column.cast(pa.string()), value_set=pa.array(self.levels[name], pa.string()))
                known = place.fill_null(size[k] - 2).to_numpy(zero_copy_only=False)
                found[k] = np.where(column.is_null().to_numpy(zero_copy_only=False), size[k] - 1, known)
        return found


@dataclass
class View:
    """What one model makes of the layout: the edges it may cut at, and the bin that missing cells take."""

    cuts: list[list[int]]       # per column: edge numbers, or level numbers
    fills: list[int]            # per column: the bin of the median or mode
    base: float
    weights: tuple[float, float]
    least: int
    l2: float
    fold: int | None


@dataclass
class Node:
    number: int
    sums: tuple[float, float, int] = (0.0, 0.0, 0)          # gradient, curvature, rows
    gain: float | None = None                               # of the best split; None: no split, or not looked at yet
    column: int = -1
    cut: int = -1
    children: tuple["Node", "Node"] | None = None


@dataclass
class Tree:
    """Splits (column, bins that go left, left, right) by node, and the value of every node that is a leaf."""

    splits: dict[int, tuple[int, np.ndarray, int, int]] = field(default_factory=dict)
    values: dict[int, float] = field(default_factory=dict)

    def nodes(self, codes: np.ndarray) -> np.ndarray:
        """The node of each row after all splits."""
        at = np.zeros(codes.shape[1], dtype=np.int32)
        for number, (column, goes, left, right) in self.splits.items():
            rows = np.flatnonzero(at == number)
            at[rows] = np.where(goes[codes[column, rows]], left, right)
        return at

    def margins(self, codes: np.ndarray) -> np.ndarray:
        table = np.zeros(1 + max(self.values))
        table[[*self.values]] = [*self.values.values()]
        return table[self.nodes(codes)]


def bin_edges(df: DataFrame, numeric: Sequence[str], bins: int = BINS, folds: Sequence[int] = (), fold: str = "fold"
              ) -> dict[int | None, dict[str, list[float]]]:
    """{held-out fold, or None for all rows: {column: edges}}, each learned from the rows outside the fold.

    An edge is a value at which the running share of rows passes a multiple of 1 / bins; a column with no more distinct
    values than bins has all of them but the largest. At most bins x columns numbers a fold reach the driver.
    """
    if not numeric:
        return {f: {} for f in (folds or [None])}
    long = melt(df, [fold] if folds else [], numeric)
    long = long.where(F.col("value").isNotNull() & ~F.isnan("value"))
    cuts = split_points(long, "value")
    cells = long.groupBy(*([fold] if folds else []), "feature", "value").agg(F.count(F.lit(1)).alias("n"))
    by = ["feature"]
    if folds:
        others = F.explode(F.array(*[F.lit(f).cast("long") for f in folds])).alias("held_out")
        cells = cells.select("*", others).where(F.col("held_out") != F.col(fold)).groupBy("held_out", "feature", "value").agg(F.sum("n").alias("n"))
        by = ["held_out", "feature"]
    ranked = running_totals(cells.withColumn("one", F.lit(1).cast("long")), by, "value", ["n", "one"], cuts)
    passes = F.expr(f"(run_n * {bins}) div total_n > ((run_n - n) * {bins}) div total_n")
    kept = ranked.where((F.col("run_n") < F.col("total_n")) & (passes | (F.col("total_one") <= bins)))
    found: dict[int | None, dict[str, list[float]]] = {f: {c: [] for c in numeric} for f in (folds or [None])}
    for r in kept.select(*by, "value").collect():
        found[r["held_out"] if folds else None][r["feature"]].append(r["value"])
    return {f: {c: sorted(v) for c, v in columns.items()} for f, columns in found.items()}


Block = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]      # codes (columns, rows), labels, folds, margins (models, rows)


def _blocks(df: DataFrame, layout: Layout, fold: str | None, members: int) -> RDD:
    """Blocks of coded rows, of about an Arrow batch each.

    A round is some five small jobs over the same arrays. As an RDD they start in a tenth of the time that planning
    a query over a cached table takes, and a chain of rounds does not grow a query plan.
    """
    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                folds = batch.column(1).to_numpy(zero_copy_only=False).astype(np.int32)
                parts = [layout.codes(batch.columns[2:]).tobytes(), batch.column(0).to_numpy(zero_copy_only=False).astype(np.uint8).tobytes(), folds.tobytes()]
                yield pa.RecordBatch.from_arrays([pa.array([p], pa.binary()) for p in parts], names=["codes", "y", "fold"])

    def unpacked(row) -> Block:
        y = np.frombuffer(row["y"], dtype=np.uint8)
        return (np.frombuffer(row["codes"], dtype=np.uint16).reshape(-1, len(y)), y, np.frombuffer(row["fold"], dtype=np.int32),
                np.zeros((members, len(y))))

    own = F.col(fold).cast("int") if fold else F.lit(-1)
    cells = [F.col(f"`{c}`").cast("double" if c in layout.edges else "string").alias(f"c{i}") for i, c in enumerate(layout.columns)]
    coded = df.select(F.col("y").cast("int").alias("y"), own.alias("fold"), *cells).mapInArrow(code, "codes binary, y binary, fold binary")
    return coded.rdd.map(unpacked)


def _advanced(blocks: RDD, trees: Sequence[Tree | None]) -> RDD:
    """The blocks with every model's last tree added to its margins."""
    def add(block: Block) -> Block:
        codes, y, folds, margins = block
        return codes, y, folds, np.stack([m if t is None else m + t.margins(codes) for m, t in zip(margins, trees)])

    return blocks.map(add, preservesPartitioning=True)


def _histograms(blocks: RDD, layout: Layout, views: Sequence[View], wanted: Mapping[int, tuple[Tree, list[int]]]) -> RDD:
    """((model, leaf), sums): gradient, curvature and rows by (column, bin), added up per partition."""
    size = layout.sizes()
    starts = np.cumsum([0, *size])

    def add(part: Iterator[Block]) -> Iterator[tuple[tuple[int, int], np.ndarray]]:
        total = {m: np.zeros((len(leaves), 3, starts[-1])) for m, (_, leaves) in wanted.items()}
        for codes, y, folds, margins in part:
            for m, (tree, leaves) in wanted.items():
                view = views[m]
                p = 1 / (1 + np.exp(-(view.base + margins[m])))
                weight = np.where(y == 1, view.weights[1], view.weights[0])
                sums = ((p - y) * weight, p * (1 - p) * weight)
                place = np.full(1 + max([*leaves, *[n for _, _, *ends in tree.splits.values() for n in ends]]), -1)
                place[leaves] = np.arange(len(leaves))
                at = place[tree.nodes(codes)]           # all waiting leaves of a model are counted together
                if view.fold is not None:
                    at[folds == view.fold] = -1
                rows = np.flatnonzero(at >= 0)
                at, gradient, curvature, own = at[rows], sums[0][rows], sums[1][rows], total[m]
                for k, n in enumerate(size):
                    cells, part_ = at * n + codes[k, rows], slice(starts[k], starts[k + 1])
                    for i, found in enumerate((np.bincount(cells, gradient, len(leaves) * n), np.bincount(cells, curvature, len(leaves) * n),
                                               np.bincount(cells, minlength=len(leaves) * n))):
                        own[:, i, part_] += found.reshape(len(leaves), n)
        yield from (((m, leaf), own) for m, (_, leaves) in wanted.items() for leaf, own in zip(leaves, total[m]))

    return blocks.mapPartitions(add)


def best_split(sums: np.ndarray, layout: Layout, view: View) -> tuple[float | None, int, int, tuple, tuple]:
    """(gain, column, cut, left sums, all sums) of the best split of a leaf, or a gain of None if it has none."""
    best: tuple = (None, -1, -1, (0.0, 0.0, 0))
    starts = np.cumsum([0, *layout.sizes()])
    total = sums[:, starts[0]:starts[1]].sum(axis=1)
    for k, name in enumerate(layout.columns):
        own = sums[:, starts[k]:starts[k + 1]].copy()
        own[:, view.fills[k]] += own[:, -1]
        cuts = np.array(view.cuts[k], dtype=np.int64)
        if not len(cuts):
            continue
        if name in layout.edges:
            left = np.cumsum(own[:, :-1], axis=1)[:, cuts]
        else:
            left = total[:, None] - own[:, cuts]
        right = total[:, None] - left
        good = (left[2] >= view.least) & (right[2] >= view.least) & (left[1] >= LEAST_HESSIAN) & (right[1] >= LEAST_HESSIAN)
        if not good.any():
            continue
        loss = left[0] ** 2 / (left[1] + view.l2 + _TINY) + right[0] ** 2 / (right[1] + view.l2 + _TINY)
        gain = np.where(good, np.round(loss - total[0] ** 2 / (total[1] + view.l2 + _TINY), GAIN_DIGITS), -np.inf)
        at = int(gain.argmax())
        if gain[at] > 0 and (best[0] is None or gain[at] > best[0]):
            best = (float(gain[at]), k, int(cuts[at]), (float(left[0, at]), float(left[1, at]), int(left[2, at])))
    return (*best, (float(total[0]), float(total[1]), int(total[2])))


def _splits(histograms: RDD, layout: Layout, views: Sequence[View], leaves: int) -> list[tuple[int, int, tuple]]:
    """(model, leaf, best split) for each waiting leaf.

    Histograms of all tasks that are few bytes are fetched and added up at once. Else tasks add them up, first in groups of
    partitions, so that no task gets those of all of them, and only splits come back.
    """
    partitions = histograms.getNumPartitions()
    if partitions * leaves * 24 * sum(layout.sizes()) <= FETCHED_BYTES:
        totals: dict[tuple[int, int], np.ndarray] = {}
        for key, sums in histograms.collect():
            totals[key] = totals[key] + sums if key in totals else sums
        return [(*key, best_split(sums, layout, views[key[0]])) for key, sums in totals.items()]
    groups = math.ceil(partitions ** 0.5)
    grouped = histograms.mapPartitionsWithIndex(lambda part, rows: (((*key, part % groups), sums) for key, sums in rows))
    added = grouped.reduceByKey(np.add).map(lambda row: (row[0][:2], row[1])).reduceByKey(np.add)
    return added.map(lambda row: (*row[0], best_split(row[1], layout, views[row[0][0]]))).collect()


def goes_left(layout: Layout, view: View, column: int, cut: int) -> np.ndarray:
    """For every bin of the column, whether a row with it goes to the left."""
    size = layout.sizes()[column]
    goes = np.arange(size) <= cut if layout.columns[column] in layout.edges else np.arange(size) != cut
    goes[-1] = goes[view.fills[column]]
    return goes


class Grower:
    """One model's tree in the making: its real leaves, and the looked-at children that no split has taken yet."""

    def __init__(self, layout: Layout, view: View, member: Member):
        self.layout, self.view, self.member = layout, view, member
        self.root = Node(0)
        self.count = 1
        self.leaves = [self.root]
        self.waiting = [self.root]
        self.known = Tree()             # every split that was looked at, for routing rows
        self.done = False

    def told(self, leaf: int, split: tuple) -> None:
        node = next(n for n in self.waiting if n.number == leaf)
        node.gain, node.column, node.cut, _, node.sums = split

    def grow(self) -> None:
        """Split as long as the best leaf's children are known, then ask for those of all leaves."""
        while len(self.leaves) < self.member.leaves:
            best = max((n for n in self.leaves if n.gain is not None), key=lambda n: (n.gain, -n.number), default=None)
            if best is None:
                break
            if best.children is None:
                self.waiting = []
                for node in self.leaves:
                    if node.gain is not None and node.children is None:
                        node.children = (Node(self.count), Node(self.count + 1))
                        self.count += 2
                        goes = goes_left(self.layout, self.view, node.column, node.cut)
                        self.known.splits[node.number] = (node.column, goes, node.children[0].number, node.children[1].number)
                        self.waiting += node.children
                return
            self.leaves.remove(best)
            self.leaves += best.children
        self.waiting, self.done = [], True

    def tree(self) -> Tree:
        """The finished tree: the splits above its leaves."""
        made, open_ = Tree(), [self.root]
        own = {n.number for n in self.leaves}
        while open_:
            node = open_.pop(0)
            if node.number in own:
                g, h, _ = node.sums
                made.values[node.number] = -self.member.rate * g / (h + self.member.l2 + _TINY)
            else:
                made.splits[node.number] = self.known.splits[node.number]
                open_ += node.children
        return made


class Counter:
    """Histograms over rows that one task holds: columns of few bins as one joint cell, of two siblings only the smaller."""

    def __init__(self, codes: np.ndarray, layout: Layout):
        size = layout.sizes()
        self.starts = np.cumsum([0, *size])
        self.groups: list[list[int]] = []
        for k, n in enumerate(size):
            if self.groups and n * math.prod(size[c] for c in self.groups[-1]) <= JOINT_CELLS:
                self.groups[-1].append(k)
            else:
                self.groups.append([k])
        self.shapes = [[size[c] for c in group] for group in self.groups]
        self.cells = [np.ravel_multi_index(tuple(codes[group].astype(np.intp)), shape).astype(np.uint32) for group, shape in zip(self.groups, self.shapes)]

    def sums(self, rows: np.ndarray | None, gradient: np.ndarray, curvature: np.ndarray) -> np.ndarray:
        """Gradient, curvature and rows by (column, bin) of these rows (None: all)."""
        total = np.empty((3, self.starts[-1]))
        if rows is not None:
            gradient, curvature = gradient[rows], curvature[rows]
        for group, shape, cells in zip(self.groups, self.shapes, self.cells):
            own, n = (cells if rows is None else cells[rows]).astype(np.intp), math.prod(shape)
            found = np.stack([np.bincount(own, gradient, n), np.bincount(own, curvature, n), np.bincount(own, minlength=n)]).reshape(3, *shape)
            for at, k in enumerate(group):
                total[:, self.starts[k]:self.starts[k + 1]] = found.sum(axis=tuple(i + 1 for i in range(len(group)) if i != at))
        return total


def _trees(codes: np.ndarray, y: np.ndarray, layout: Layout, view: View, member: Member) -> list[Tree]:
    """All rounds of one model over the rows it sees."""
    counter, made, margin = Counter(codes, layout), [], np.zeros(len(y))
    weight = np.where(y == 1, view.weights[1], view.weights[0])
    for _ in range(member.rounds):
        p = 1 / (1 + np.exp(-(view.base + margin)))
        gradient, curvature = (p - y) * weight, p * (1 - p) * weight
        grower = Grower(layout, view, member)
        rows: dict[int, np.ndarray | None] = {0: None}
        sums = {0: counter.sums(None, gradient, curvature)}
        while not grower.done:
            for node in grower.waiting:
                grower.told(node.number, best_split(sums[node.number], layout, view))
            grower.grow()
            asked = {node.number for node in grower.waiting}
            for parent, (column, goes, *ends) in grower.known.splits.items():
                if asked.isdisjoint(ends):
                    continue
                own = rows[parent]
                left = goes[codes[column] if own is None else codes[column, own]]
                rows |= {end: np.flatnonzero(side) if own is None else own[side] for end, side in zip(ends, (left, ~left))}
                small, large = sorted(ends, key=lambda end: len(rows[end]))
                sums[small] = counter.sums(rows[small], gradient, curvature)
                # What is left of a bin without rows is nothing, not a rounding error: equal cuts stay equal.
                sums[large] = sums[parent] - sums[small]
                sums[large][:2, sums[large][2] == 0] = 0
        tree = grower.tree()
        for leaf, value in tree.values.items():
            if rows[leaf] is None:
                margin += value
            else:
                margin[rows[leaf]] += value
        made.append(tree)
    return made


def _side_by_side(blocks: RDD, layout: Layout, views: Sequence[View], members: Sequence[Member]) -> list[list[Tree]]:
    """The trees of every model, each grown in a task that gets the rows outside the model's fold, in their order."""
    def sent(part: int, own: Iterator[Block]) -> Iterator[tuple[int, tuple]]:
        for number, (codes, y, folds, _) in enumerate(own):
            for m, view in enumerate(views):
                seen = np.flatnonzero(folds != view.fold) if view.fold is not None else np.arange(len(y))
                yield m, (part, number, codes[:, seen], y[seen])

    def grown(own: Iterator[tuple[int, tuple]]) -> Iterator[tuple[int, list[Tree]]]:
        got: dict[int, list[tuple]] = {}
        for m, block in own:
            got.setdefault(m, []).append(block)
        for m in [*got]:
            parts = sorted(got.pop(m), key=lambda block: block[:2])
            codes, y = np.concatenate([p[2] for p in parts], axis=1), np.concatenate([p[3] for p in parts])
            yield m, _trees(codes, y, layout, views[m], members[m])

    return [trees for _, trees in sorted(blocks.mapPartitionsWithIndex(sent).partitionBy(len(members), int).mapPartitions(grown).collect(),
                                         key=lambda found: found[0])]


@dataclass
class Booster:
    """A fitted model: a starting margin and its trees over the layout."""

    layout: Layout
    base: float
    trees: list[Tree]

    def margins(self, codes: np.ndarray) -> np.ndarray:
        total = np.full(codes.shape[1], self.base)
        for tree in self.trees:
            total += tree.margins(codes)
        return total

    def margin(self, df: DataFrame, name: str = "margin") -> DataFrame:
        """The input columns plus the raw margin, in one Arrow pass without a shuffle."""
        layout = self.layout

        @F.arrow_udf("double")
        def margin_of(*cells: pa.Array) -> pa.Array:
            return pa.array(self.margins(layout.codes(cells)))

        cells = [F.col(f"`{c}`").cast("double" if c in layout.edges else "string") for c in layout.columns]
        return df.withColumn(name, margin_of(*cells))

    def score(self, df: DataFrame, name: str = "p") -> DataFrame:
        made = self.margin(df, "__margin")
        return made.withColumn(name, sigmoid(F.col("__margin"))).drop("__margin")

    def dumped(self) -> str:
        trees = [{"splits": [[n, c, goes.astype(int).tolist(), a, b] for n, (c, goes, a, b) in t.splits.items()], "values": list(t.values.items())}
                 for t in self.trees]
        return json.dumps({"layout": vars(self.layout), "base": self.base, "trees": trees})

    @classmethod
    def loaded(cls, text: str) -> "Booster":
        told = json.loads(text)
        trees = [Tree({n: (c, np.array(goes, dtype=bool), a, b) for n, c, goes, a, b in t["splits"]}, {n: v for n, v in t["values"]})
                 for t in told["trees"]]
        return cls(Layout(**told["layout"]), told["base"], trees)

    def save(self, spark: SparkSession, path: str) -> None:
        """One row with the whole model, which is of a size that depends on its settings only."""
        spark.createDataFrame([(self.dumped(),)], "booster string").coalesce(1).write.parquet(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "Booster":
        return cls.loaded(spark.read.parquet(path).first()["booster"])


def fit_boosters(rows: DataFrame, members: Sequence[Member], numeric: Sequence[str], categorical: Sequence[str],
                 statistics: Mapping[int | None, Mapping[str, dict]], counts: Mapping[int | None, Mapping[int, int]], fold: str | None = None,
                 bins: int = BINS) -> list[Booster]:
    """Fit all members together on (columns..., y, fold).

    `statistics` and `counts` hold, per held-out fold (None: all rows), the medians, modes and levels and the class counts
    of the rows outside it. A member stops when its rounds are done; the others go on.
    """
    if any(m.leaves < 2 or m.rounds < 1 or m.leaf < 1 for m in members):
        raise ValueError("Boosting needs a round, two leaves and a row a leaf at least.")
    held_out = sorted({m.fold for m in members if m.fold is not None})
    edges: dict[int | None, dict[str, list[float]]] = {}
    if held_out:
        edges |= bin_edges(rows, numeric, bins, held_out, fold)
    if any(m.fold is None for m in members):
        edges |= bin_edges(rows, numeric, bins)
    levels = {c: sorted({v for f in edges for v in statistics[f]["categorical"][c][1]}) for c in categorical}
    layout = Layout(list(numeric), list(categorical), {c: sorted({e for own in edges.values() for e in own[c]}) for c in numeric}, levels)

    def view(m: Member) -> View:
        told, n = statistics[m.fold], counts[m.fold]
        whole = n[0] + n[1]
        weights = (whole / (2 * n[0]), whole / (2 * n[1])) if m.balanced else (1.0, 1.0)
        cuts = [[layout.edges[c].index(e) for e in edges[m.fold][c]] for c in numeric]
        cuts += [[levels[c].index(v) for v in told["categorical"][c][1]] for c in categorical]
        fills = [int(np.searchsorted(layout.edges[c], told["numeric"][c][0])) for c in numeric]
        fills += [levels[c].index(told["categorical"][c][0]) if told["categorical"][c][0] in levels[c] else len(levels[c]) for c in categorical]
        return View(cuts, fills, math.log(n[1] * weights[1] / (n[0] * weights[0])), weights, m.leaf, m.l2, m.fold)

    views = [view(m) for m in members]
    if max(sum(counts[m.fold].values()) for m in members) <= rows_per_bucket(rows.sparkSession):
        found = _side_by_side(_blocks(rows, layout, fold, 0), layout, views, members)
        return [Booster(layout, v.base, t) for v, t in zip(views, found)]
    trees: list[list[Tree]] = [[] for _ in members]
    state = _blocks(rows, layout, fold, len(members)).persist(StorageLevel.MEMORY_AND_DISK)
    held = [state]
    if state.context.getCheckpointDir() is None:
        state.context.setCheckpointDir(shared_folder(rows.sparkSession))
    try:
        for round_ in range(max(m.rounds for m in members)):
            growers = {k: Grower(layout, views[k], m) for k, m in enumerate(members) if round_ < m.rounds}
            while waiting := {k: g for k, g in growers.items() if not g.done}:
                wanted = {k: (g.known, [n.number for n in g.waiting]) for k, g in waiting.items()}
                asked = sum(len(leaves) for _, leaves in wanted.values())
                for model, leaf, split in _splits(_histograms(state, layout, views, wanted), layout, views, asked):
                    growers[model].told(leaf, split)
                for g in waiting.values():
                    g.grow()
            grown = {k: g.tree() for k, g in growers.items()}
            for k, tree in grown.items():
                trees[k].append(tree)
            state = _advanced(state, [grown.get(k) for k in range(len(members))]).persist(StorageLevel.MEMORY_AND_DISK)
            held.append(state)
            if (round_ + 1) % ROUNDS_PER_CHECKPOINT == 0:
                state.checkpoint()
            if len(held) > ROUNDS_HELD:
                state.count()           # now it is there, and those before it can go
                for earlier in held[:-1]:
                    earlier.unpersist()
                held = [state]
    finally:
        for kept in held:
            kept.unpersist()
    return [Booster(layout, v.base, t) for v, t in zip(views, trees)]
