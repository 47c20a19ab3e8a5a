"""The forests of a whole search, grown side by side, and the same trees that Spark ML grows from the same seed.

Spark ML runs a job per level of every forest, and a search has a forest per setting and fold.  Here all of them take their
levels together: a level is one pass, in which every task finds the best splits of the open nodes of some trees.  Rows
reach the tasks as bin numbers and bags, made once; rows in finished leaves are passed over.  Where a fold has more than
``BLOCK_ROWS`` rows, tasks count blocks of them and the counts of a tree meet afterwards.  The driver holds the trees and
decides what Spark's driver decides: which nodes are split next and which features each may use.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cohort_spark.functions import draws
from cohort_spark.operators.metrics import auroc
from cohort_spark.plans.runs import value_runs
from cohort_spark.session import shared_folder

# Spark ML's defaults.
MAX_BINS = 32
GROUP_BYTES = 256 << 20
CLASSES = 2

BLOCK_ROWS = 1 << 16
UNIT_TREES = 25
UNIT_NODES = 1 << 12


@dataclass(frozen=True)
class Setting:
    """What decides a forest besides its rows and its seed."""

    trees: int
    depth: int
    least: int
    features: int


def features_per_node(strategy: str, width: int) -> int:
    return math.ceil(math.sqrt(width)) if strategy == "sqrt" else max(1, math.ceil(math.log(width) / math.log(2)))


@dataclass
class Forest:
    """A growing forest; nodes are numbered as they are made, the roots first, and the right child follows the left."""

    setting: Setting
    fold: int
    bins: np.ndarray
    seed: int
    tree: np.ndarray = field(init=False)
    level: np.ndarray = field(init=False)
    feature: np.ndarray = field(init=False)
    cut: np.ndarray = field(init=False)
    child: np.ndarray = field(init=False)
    counts: np.ndarray = field(init=False)
    stack: np.ndarray = field(init=False)
    group: np.ndarray = field(init=False)
    subset: np.ndarray = field(init=False)

    def __post_init__(self):
        n = self.setting.trees
        self.tree, self.level = np.arange(n, dtype=np.int32), np.zeros(n, np.int32)
        self.feature, self.cut, self.child = np.zeros(n, np.int16), np.zeros(n, np.int16), np.full(n, -1, np.int32)
        self.counts = np.zeros((n, CLASSES), np.int64)
        self.stack = np.arange(n)[::-1]
        self._state = draws.java_state(self.seed)

    def next_group(self) -> None:
        """The nodes of the next pass, from the top of the stack as far as Spark's memory for them goes, and their features."""
        k, width = self.setting.features, len(self.bins)
        if k < width:
            seeds, states = draws.java_longs(self._state, len(self.stack))
            subset = draws.feature_subsets(seeds, width, k)
        else:
            subset = np.tile(np.arange(width), (len(self.stack), 1))
        used = np.cumsum(self.bins[subset].sum(axis=1)) * CLASSES * 8
        n = max(1, int(np.searchsorted(used, GROUP_BYTES, "right")))
        if k < width:
            self._state = int(states[min(n, len(states) - 1)])  # the node that found no room has drawn, too
        self.group, self.subset, self.stack = self.stack[:n], subset[:n], self.stack[n:]

    def grow(self, found: np.ndarray) -> None:
        """Split the nodes of the group by (feature or -1, bin, left counts, counts) of each."""
        left, whole = found[:, 2:4], found[:, 4:6]
        self.counts[self.group] = whole
        rank = np.zeros(self.setting.trees, np.int64)
        for at, t in enumerate(draws.map_order(np.unique(self.tree[self.group]).tolist())):
            rank[t] = at
        order = np.argsort(rank[self.tree[self.group]], kind="stable")
        order = order[found[order, 0] >= 0]
        nodes, first = self.group[order], len(self.tree)
        self.feature[nodes], self.cut[nodes] = found[order, 0], found[order, 1]
        self.child[nodes] = first + 2 * np.arange(len(nodes))
        counts = np.stack([left[order], whole[order] - left[order]], axis=1).reshape(-1, CLASSES)
        level = np.repeat(self.level[nodes] + 1, 2)
        self.tree, self.level = np.append(self.tree, np.repeat(self.tree[nodes], 2)), np.append(self.level, level)
        none = np.zeros(len(counts), np.int16)
        self.feature, self.cut = np.append(self.feature, none), np.append(self.cut, none)
        self.child, self.counts = np.append(self.child, np.full(len(counts), -1, np.int32)), np.append(self.counts, counts, axis=0)
        opened = first + np.flatnonzero((level < self.setting.depth) & (counts > 0).all(axis=1))
        self.stack = np.append(opened[::-1], self.stack)

    def votes(self) -> tuple[np.ndarray, np.ndarray]:
        """Children after leaves that say the same are merged, and the share of class 1 in each node."""
        child, says = self.child.copy(), self.counts[:, 1] > self.counts[:, 0]
        for level in range(int(self.level.max()), -1, -1):
            inner = np.flatnonzero((self.level == level) & (child >= 0))
            a, b = child[inner], child[inner] + 1
            child[inner[(child[a] < 0) & (child[b] < 0) & (says[a] == says[b])]] = -1
        whole = self.counts.sum(axis=1).astype(float)
        return child, np.divide(self.counts[:, 1], whole, out=np.zeros(len(whole)), where=whole > 0)


def walk_cuts(values: np.ndarray, counts: np.ndarray, before: np.ndarray, rows: int, most: int) -> list[float]:
    """Spark's cuts between distinct values: at most ``most``, at even shares of the rows.

    Of more than ``most + 1`` values only those near a share have to be given; the value before such a one must be there.
    """
    if len(values) <= most + 1:
        return ((values[:-1] + values[1:]) / 2).tolist()
    cuts, stride = [], rows / (most + 1)
    target = stride
    for i in range(1, len(values)):
        if abs(before[i] - target) < abs(before[i] + counts[i] - target):
            cuts.append(float((values[i - 1] + values[i]) / 2))
            target += stride
    return cuts


def find_cuts(rows: DataFrame, sizes: Sequence[int]) -> list[list[np.ndarray]]:
    """Cuts of every feature, for every fold left out, from all rows: what comes back is near the shares alone."""
    folds = range(len(sizes))
    long = rows.select("fold", F.posexplode("x").alias("feature", "v")).withColumn("v", F.col("v") + 0.0)
    runs = value_runs(long, "v", {f"w{f}": (F.col("fold") != f).cast("bigint") for f in folds}, ["feature"])
    most = [min(MAX_BINS, n) - 1 for n in sizes]

    def share(f: int):
        """How many shares end below the middle of the value's rows."""
        steps = np.cumsum([sizes[f] / (most[f] + 1)] * most[f]).tolist()
        middle = 2 * F.col(f"w{f}_before") + F.col(f"w{f}")
        return F.size(F.filter(F.array(*[F.lit(2 * s) for s in steps]).cast("array<double>"), lambda t: t < middle))

    each = F.array(*[
        F.struct(F.lit(f).alias("out"), F.col(f"w{f}").alias("n"), F.col(f"w{f}_before").alias("before"), share(f).alias("share"))
        for f in folds
    ])
    part = runs.select("feature", "v", F.explode(each).alias("e")).select("feature", "v", "e.*").where("n > 0")
    group = W.partitionBy("feature", "out", "share")
    near = part.withColumns({"at": F.row_number().over(group.orderBy("v")), "all": F.count(F.lit(1)).over(group)})
    near = near.where((F.col("at") <= MAX_BINS + 1) | (F.col("at") == F.col("all"))).select("out", "feature", "v", "n", "before")
    got = near.toPandas().sort_values(["out", "feature", "v"])
    width = rows.select(F.size("x")).first()[0]
    cuts = [[np.zeros(0) for _ in range(width)] for _ in folds]
    for (f, feature), g in got.groupby(["out", "feature"]):
        cuts[f][feature] = np.array(walk_cuts(g.v.to_numpy(), g.n.to_numpy(), g.before.to_numpy(), sizes[f], most[f]))
    return cuts


def _arrays(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features, labels and folds of a batch."""
    x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
    return x, batch.column("y").to_numpy().astype(np.int8), batch.column("fold").to_numpy()


def _binned(x: np.ndarray, cuts: Sequence[np.ndarray]) -> np.ndarray:
    return np.stack([np.searchsorted(c, x[:, j]) for j, c in enumerate(cuts)], axis=1).astype(np.uint8)


def _units(trees: Sequence[int], folds: int) -> list[tuple[int, int, int, int]]:
    """(left-out fold, trees of the forest, first tree, end)."""
    return [(f, t, a, min(a + UNIT_TREES, t)) for f in range(folds) for t in trees for a in range(0, t, UNIT_TREES)]


def bag_units(
    rows: DataFrame, cuts: list[list[np.ndarray]], units: list[tuple[int, int, int, int]], before: dict[tuple[int, int], int], seed: int
) -> DataFrame:
    """Bins, labels and bags of every unit in pieces, gathered by block.

    A partition's bags are one series of draws, a row after the other among the rows of the forest.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bags: dict[int, draws.Bags] = {}
        seen: dict[int, int] = {}
        part = -1
        for batch in batches:
            at = batch.column("id").to_numpy() >> 33
            for p in np.unique(at):
                if p != part:
                    part, bags, seen = int(p), {}, {}
                x, y, fold = _arrays(batch.filter(pa.array(at == p)))
                taken: dict[tuple[int, int], np.ndarray] = {}
                kept: dict[int, tuple[np.ndarray, bytes, bytes]] = {}
                for number, (f, t, a, b) in enumerate(units):
                    if f not in kept:
                        use = np.flatnonzero(fold != f)
                        kept[f] = use, _binned(x[use], cuts[f]).tobytes(), y[use].tobytes()
                    use, binned, labels = kept[f]
                    if not len(use):
                        continue
                    if (f, t) not in taken:
                        source = bags.setdefault(t, draws.Bags(seed + part + 1))
                        taken[f, t] = source.take(seen.get(f, 0) * t, len(use) * t).reshape(len(use), t)
                    block = (before[part, f] + seen.get(f, 0)) // BLOCK_ROWS
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([number], pa.int32()), pa.array([block], pa.int32())]
                        + [pa.array([v], pa.binary()) for v in (binned, labels, taken[f, t][:, a:b].tobytes())],
                        names=["unit", "block", "bins", "labels", "bags"],
                    )
                for f, (use, *_) in kept.items():
                    seen[f] = seen.get(f, 0) + len(use)
                for t, source in bags.items():
                    source.forget(min(seen.values()) * t)

    pieces = rows.mapInArrow(run, "unit int, block int, bins binary, labels binary, bags binary")
    tasks = min(len(units), 4 * rows.sparkSession.sparkContext.defaultParallelism)
    dealt = pieces.repartition(tasks, "unit", "block").groupBy("unit", "block")
    return dealt.agg(F.collect_list(F.struct("bins", "labels", "bags")).alias("pieces"))


def _gini(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    n = a + b
    n = np.where(n == 0, 1, n)
    return 1.0 - (a / n) * (a / n) - (b / n) * (b / n)


def best_splits(cells: np.ndarray, counts: np.ndarray, subset: np.ndarray, bins: np.ndarray, least: int) -> np.ndarray:
    """(feature or -1, bin, left counts, counts) of nodes, from their counts per cell of (node, place in subset, bin, class).

    Gains, ties and splits that aren't allowed are Spark's.
    """
    k, each = subset.shape[1], subset.shape[1] * MAX_BINS * CLASSES
    out = np.zeros((len(subset), 6), np.int64)
    order = np.argsort(cells, kind="stable")
    cells, counts = cells[order], counts[order]
    for at in range(0, len(subset), UNIT_NODES):
        some = subset[at : at + UNIT_NODES]
        a, b = np.searchsorted(cells, [at * each, (at + len(some)) * each])
        table = np.bincount(cells[a:b] - at * each, counts[a:b], len(some) * each).reshape(len(some), k, MAX_BINS, CLASSES)
        left = table.cumsum(axis=2)
        whole = left[:, 0, -1]
        l0, l1 = left[..., 0], left[..., 1]
        r0, r1 = whole[:, None, None, 0] - l0, whole[:, None, None, 1] - l1
        nl, nr = l0 + l1, r0 + r1
        n = np.maximum(nl + nr, 1)
        gain = _gini(whole[:, 0], whole[:, 1])[:, None, None] - nl / n * _gini(l0, l1) - nr / n * _gini(r0, r1)
        gain[(nl < least) | (nr < least) | (gain < 0)] = -np.finfo(float).max
        gain[np.arange(MAX_BINS) >= (bins[some] - 1)[..., None]] = -np.inf
        flat = gain.reshape(len(some), -1)
        best, here = flat.argmax(axis=1), np.arange(len(some))
        place, cut = best // MAX_BINS, best % MAX_BINS
        part = out[at : at + len(some)]
        part[:, 0] = np.where(flat[here, best] > 0, some[here, place], -1)
        part[:, 1], part[:, 2:4], part[:, 4:6] = cut, left[here, place, cut], whole
    return out


@dataclass
class Open:
    """What tasks need of a forest at a level; nodes of the group are known by their place in it."""

    feature: np.ndarray
    cut: np.ndarray
    child: np.ndarray
    at: np.ndarray
    tree: np.ndarray
    subset: np.ndarray
    least: int

    def of(self, first: int, end: int) -> np.ndarray:
        return np.flatnonzero((self.tree >= first) & (self.tree < end))


def _cells(o: Open, first: int, end: int, bins: np.ndarray, labels: np.ndarray, bags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Counts per cell of the open nodes of some trees, from a block of rows."""
    mine = o.of(first, end)
    local = np.full(len(o.tree) + 1, -1, np.int64)
    local[mine] = np.arange(len(mine))
    k = o.subset.shape[1]
    row, tree = np.nonzero(bags)
    node, cells, counts = tree + first, [], []
    while len(row):
        here = local[o.at[node]]
        got = here >= 0
        if got.any():
            r, times = row[got], bags[row[got], tree[got]]
            chosen = o.subset[o.at[node[got]]]
            key = ((here[got, None] * k + np.arange(k)) * MAX_BINS + bins[r[:, None], chosen]) * CLASSES + labels[r, None]
            cells.append(key.ravel())
            counts.append(np.repeat(times, k))
        inner = o.child[node] >= 0
        row, tree, node = row[inner], tree[inner], node[inner]
        node = o.child[node] + (bins[row, o.feature[node]] > o.cut[node])
    if not cells:
        return np.zeros(0, np.int64), np.zeros(0)
    return np.concatenate(cells), np.concatenate(counts).astype(float)


def _summed(cells: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    one, at = np.unique(cells, return_inverse=True)
    return one, np.bincount(at, counts, len(one))


def level(units: DataFrame, known: list[tuple[int, int, int, int]], forests: list[Forest], blocks: bool) -> None:
    """Split the nodes of every forest's group, in one pass over the rows.  blocks: some unit has more than one."""
    width = len(forests[0].bins)
    bins = {f.fold: f.bins for f in forests}
    todo: dict[tuple[int, int], list[tuple[int, Open]]] = {}
    for number, f in enumerate(forests):
        at = np.full(len(f.tree), -1)
        at[f.group] = np.arange(len(f.group))
        o = Open(f.feature, f.cut, f.child, at, f.tree[f.group], f.subset.astype(np.int16), f.setting.least)
        todo.setdefault((f.fold, f.setting.trees), []).append((number, o))

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int, int, Open, np.ndarray, np.ndarray]]:
        for batch in batches:
            for r in range(batch.num_rows):
                unit = batch.column("unit")[r].as_py()
                fold, trees, first, end = known[unit]
                if (fold, trees) not in todo:
                    continue
                pieces = batch.column("pieces")[r].values
                part = {c: np.frombuffer(b"".join(pieces.field(c).to_pylist()), np.uint8) for c in ("bins", "labels", "bags")}
                data = part["bins"].reshape(-1, width), part["labels"], part["bags"].reshape(-1, end - first)
                for number, o in todo[fold, trees]:
                    if len(o.of(first, end)):
                        yield unit, number, fold, o, *_cells(o, first, end, *data)

    def split(unit: int, number: int, o: Open, cells: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
        fold, _, first, end = known[unit]
        found = best_splits(cells, counts, o.subset[o.of(first, end)], bins[fold], o.least)
        return pa.RecordBatch.from_arrays(
            [pa.array([unit], pa.int32()), pa.array([number], pa.int32()), pa.array([found.tobytes()], pa.binary())], names=["unit", "forest", "v"]
        )

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for unit, number, _, o, cells, counts in counted(batches):
            yield split(unit, number, o, cells, counts)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for unit, number, _, _, cells, counts in counted(batches):
            cells, counts = _summed(cells, counts)
            yield pa.RecordBatch.from_arrays(
                [pa.array([unit], pa.int32()), pa.array([number], pa.int32()), *[pa.array([v.tobytes()], pa.binary()) for v in (cells, counts)]],
                names=["unit", "forest", "cells", "counts"],
            )

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened = {number: o for some in todo.values() for number, o in some}
        key, held = None, []

        def settled() -> Iterator[pa.RecordBatch]:
            if held:
                yield split(*key, opened[key[1]], *[np.concatenate(v) for v in zip(*held)])

        for batch in batches:  # pieces of a unit and forest follow each other
            for r in range(batch.num_rows):
                now = batch.column("unit")[r].as_py(), batch.column("forest")[r].as_py()
                if now != key:
                    yield from settled()
                    key, held = now, []
                piece = np.frombuffer(batch.column("cells")[r].as_py(), np.int64), np.frombuffer(batch.column("counts")[r].as_py())
                held = [_summed(*[np.concatenate(v) for v in zip(*held, piece)])]
        yield from settled()

    out = "unit int, forest int, v binary"
    if blocks:
        tasks = min(len(known), 4 * units.sparkSession.sparkContext.defaultParallelism)
        parts = units.mapInArrow(partial, "unit int, forest int, cells binary, counts binary")
        splits = parts.repartition(tasks, "unit", "forest").sortWithinPartitions("unit", "forest").mapInArrow(merged, out)
    else:
        splits = units.mapInArrow(whole, out)
    found = [np.zeros((len(f.group), 6), np.int64) for f in forests]
    for f in found:
        f[:, 0] = -1
    for r in splits.collect():  # a row per node
        _, _, first, end = known[r.unit]
        f = forests[r.forest]
        tree = f.tree[f.group]
        found[r.forest][(tree >= first) & (tree < end)] = np.frombuffer(r.v, np.int64).reshape(-1, 6)
    for f, v in zip(forests, found):
        f.grow(v)


def scored_out(rows: DataFrame, forests: list[Forest], cuts: list[list[np.ndarray]]) -> DataFrame:
    """(forest, label, score): every row by the forests that its fold was left out of; the score is the sum of the votes."""
    by_fold: dict[int, list] = {}
    for number, f in enumerate(forests):
        child, vote = f.votes()
        by_fold.setdefault(f.fold, []).append((number, f.setting.trees, f.feature, f.cut, child, vote))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y, fold = _arrays(batch)
            for f in np.unique(fold):
                use = fold == f
                binned, labels = _binned(x[use], cuts[f]), pa.array(y[use].astype(np.int32))
                for number, trees, feature, cut, child, vote in by_fold.get(int(f), []):
                    score = np.zeros(len(binned))
                    for t in range(trees):  # summed in the order of the trees
                        node, row = np.full(len(binned), t), np.arange(len(binned))
                        while len(row := row[child[node[row]] >= 0]):
                            at = node[row]
                            node[row] = child[at] + (binned[row, feature[at]] > cut[at])
                        score += vote[node]
                    number_of = pa.array(np.full(len(score), number, np.int32))
                    yield pa.RecordBatch.from_arrays([number_of, labels, pa.array(score)], names=["forest", "label", "score"])

    return rows.mapInArrow(run, "forest int, label int, score double")


def _checked(rows: DataFrame, folds: int) -> dict[tuple[int, int, int], int]:
    """Rows per (partition, fold, class); bad input is an error, as it is for Spark ML."""
    odd = F.coalesce(F.exists("x", lambda v: F.isnan(v) | (F.abs(v) == float("inf"))), F.lit(True))
    per = rows.groupBy(F.shiftright("id", 33).cast("int").alias("part"), "fold", "y").agg(
        F.count(F.lit(1)).alias("n"), F.max(odd.cast("int")).alias("odd"), F.min(F.size("x")).alias("low"), F.max(F.size("x")).alias("high")
    )
    found = per.collect()  # a row per partition, fold and class
    for r in found:
        if r.fold is None or not 0 <= r.fold < folds:
            raise ValueError(f"fold must be in range [0, {folds}), but is {r.fold}")
        if r.y not in (0.0, 1.0):
            raise ValueError(f"labels must be 0 or 1, but one is {r.y}")
        if r.odd:
            raise ValueError("features must be known and finite")
    if len({v for r in found for v in (r.low, r.high)}) > 1:
        raise ValueError("rows have different numbers of features")
    held = {f: {c: sum(r.n for r in found if r.fold == f and r.y == c) for c in (0, 1)} for f in range(folds)}
    for f in range(folds):
        if not sum(sum(held[g].values()) for g in held if g != f):
            raise ValueError(f"the training data at fold {f} is empty")
        if not sum(held[f].values()):
            raise ValueError(f"the validation data at fold {f} is empty")
        if not any(held[g][1] for g in held if g != f):
            raise ValueError(f"the training data at fold {f} has one class only")
    return {(r.part, r.fold, int(r.y)): r.n for r in found}


def grow_forests(
    rows: DataFrame, settings: Sequence[Setting], held: dict[tuple[int, int, int], int], folds: int, seed: int
) -> tuple[list[Forest], list[list[np.ndarray]]]:
    """A forest per setting and left-out fold from (id, x, y, fold), and the cuts of their bins."""
    sizes = [sum(n for (_, g, _), n in held.items() if g != f) for f in range(folds)]
    before, last = {}, [0] * folds
    for p in sorted({p for p, _, _ in held}):
        for f in range(folds):
            before[p, f] = last[f]
            last[f] += sum(n for (q, g, _), n in held.items() if q == p and g != f)
    cuts = find_cuts(rows, sizes)
    known = _units(sorted({s.trees for s in settings}), folds)
    units = bag_units(rows, cuts, known, before, seed).checkpoint()
    forests = [Forest(s, f, np.array([len(c) + 1 for c in cuts[f]]), seed) for s in settings for f in range(folds)]
    blocks = max(sizes) > BLOCK_ROWS
    while todo := [f for f in forests if len(f.stack)]:
        for f in todo:
            f.next_group()
        level(units, known, todo, blocks)
    return forests, cuts


def search_scores(df: DataFrame, settings: Sequence[Setting], label: str, folds: int, seed: int) -> list[float]:
    """The mean AUROC of every setting over the folds of column ``fold``.  Equal settings are grown once."""
    shared_folder(df.sparkSession)
    kept = df.persist()  # the partitions decide the bags, and kept rows are laid out as CrossValidator's
    whole = kept.checkpoint()
    kept.unpersist()
    rows = whole.select(
        F.monotonically_increasing_id().alias("id"), vector_to_array("features").alias("x"), F.col(label).cast("double").alias("y"), "fold"
    )
    held = _checked(rows, folds)
    single = list(dict.fromkeys(settings))
    forests, cuts = grow_forests(rows, single, held, folds, seed)
    scores = scored_out(rows, forests, cuts).checkpoint()  # read twice
    area = {r.forest: r.auroc for r in auroc(scores, by=["forest"]).collect()}  # a row per forest
    for number, f in enumerate(forests):
        if area[number] is None:  # one class only: Spark's curve keeps to an edge
            area[number] = float(any(n for (_, g, c), n in held.items() if g == f.fold and c))
    mean = {s: float(np.mean([area[i * folds + f] for f in range(folds)])) for i, s in enumerate(single)}
    return [mean[s] for s in settings]
