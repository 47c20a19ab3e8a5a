"""Nearest-neighbour imputation without comparing every gap with every donor.

Donors are cut into cells by a tree of medians: first by which columns they know, then, within one such pattern, again and
again along the column that spreads most there, until a cell holds about ``CELL_ROWS`` donors.  So the number of cells
follows the number of rows, whatever the number of columns.  The cuts come from a sample of ``SAMPLE_ROWS`` rows and only
balance the work.  The cell table has at most ``MOST_CELLS`` rows per split, and one per pattern more, so every task can
hold it.  For a row with gaps it tells which cells can hold one of its ``k`` nearest donors: the cells
whose nearest corner is not farther than the distance within which whole cells already supply ``k``
donors.  Only those cells are searched, so the result is exact.  Cells with many donors or many searching
rows are sliced, and the slices' best ``k`` are merged.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cohort_spark.plans.chunks import attach
from cohort_spark.session import shared_folder

MOST_CELLS = 4096
SAMPLE_ROWS = 65_536
CELL_ROWS = 2_000
SLICE_ROWS = 20_000
BLOCK = 256
BLOCK_ENTRIES = 1 << 21
OWN = 1 << 62


def _tuple_key(split: str, cols: Sequence[str]) -> Column:
    """A key for rows with equal values; all of them get the same neighbours."""
    values = [F.col(split), *[F.col(c).cast("double") for c in cols]]
    return F.md5(F.concat_ws("|", *[F.coalesce(v.cast("string"), F.lit("~")) for v in values]))


class _Tree:
    """Cells of rows: a tree of cuts per pattern of known columns."""

    def __init__(self, sample: np.ndarray, cells: int):
        self.roots: dict[int, int] = {}
        self.column, self.cut, self.below = [], [], []  # per node: the column, the cut, and the first of its two children
        pattern = self.patterns(sample)
        for found in np.unique(pattern):
            rows = sample[pattern == found]
            leaves = max(1, round(cells * len(rows) / len(sample)))
            self.roots[int(found)] = self._grown(rows, np.flatnonzero(~np.isnan(rows[0])).tolist(), leaves)

    @staticmethod
    def patterns(values: np.ndarray) -> np.ndarray:
        """A number below ``OWN`` for the known columns of each row: their bits, or a hash of more columns than it has bits."""
        m = values.shape[1]
        weights = np.random.default_rng(11).integers(1, OWN, m) if m > 62 else np.int64(1) << np.arange(m, dtype=np.int64)
        return (~np.isnan(values) @ weights) & (OWN - 1)

    def _node(self) -> int:
        self.column.append(-1)
        self.cut.append(0.0)
        self.below.append(-1)
        return len(self.column) - 1

    def _grown(self, rows: np.ndarray, columns: list[int], leaves: int) -> int:
        root = self._node()
        waiting = [(root, rows, leaves)]
        while waiting:
            node, part, leaves = waiting.pop()
            if leaves < 2 or len(part) < 2 or not columns:
                continue
            values = part[:, columns]
            widest = columns[int(np.argmax(values.std(axis=0)))]
            cut = float(np.median(part[:, widest]))
            left = part[:, widest] <= cut
            if left.all():  # the upper half is one value
                left = part[:, widest] < cut
                cut = float(np.nextafter(cut, -np.inf))
            if not left.any():
                continue
            children = self._node(), self._node()
            self.column[node], self.cut[node], self.below[node] = widest, cut, children[0]
            half = min(leaves - 1, max(1, round(leaves * left.mean())))
            waiting += [(children[0], part[left], half), (children[1], part[~left], leaves - half)]
        return root

    def cells(self, values: np.ndarray) -> np.ndarray:
        """The cell number of each row; a pattern that the sample lacks is a cell of its own."""
        column, cut, below = np.array(self.column), np.array(self.cut), np.array(self.below)
        pattern = self.patterns(values)
        at = np.array([self.roots.get(int(p), -1) for p in pattern], dtype=np.int64)
        inner = np.flatnonzero((at >= 0) & (below[at] >= 0))
        while len(inner):
            node = at[inner]
            at[inner] = below[node] + (values[inner, column[node]] > cut[node])
            inner = inner[below[at[inner]] >= 0]
        return np.where(at >= 0, at, OWN + pattern)


def _planted(pool: DataFrame, cols: Sequence[str], rows: int, widths: np.ndarray) -> _Tree:
    """The tree over a sample of the pool that a hash chooses."""
    share = min(1.0, SAMPLE_ROWS / max(rows, 1))
    chosen = F.pmod(F.xxhash64(F.lit("cells"), "donor"), F.lit(1 << 30)) < int(share * (1 << 30))
    found = pool.where(chosen).select(*cols).limit(2 * SAMPLE_ROWS).toPandas()
    sample = found.to_numpy(dtype=float, na_value=np.nan).reshape(len(found), len(cols)) / widths
    return _Tree(sample, min(MOST_CELLS, -(-rows // CELL_ROWS)))


def _with_cells(donors: DataFrame, cols: Sequence[str], tree: _Tree, widths: np.ndarray) -> DataFrame:
    """Add the cell number."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            values = batch[list(cols)].to_numpy(dtype=float, na_value=np.nan) / widths
            yield batch.assign(cell=tree.cells(values))

    names = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in donors.schema)
    return donors.mapInPandas(run, f"{names}, cell bigint")


class _Cells:
    """The cell table of one split as arrays, and the search for the cells a row needs."""

    def __init__(self, rows: list, m: int, widths: np.ndarray):
        self.cell = np.array([r["cell"] for r in rows], dtype=np.int64)
        self.count = np.array([r["n"] for r in rows], dtype=np.int64)
        bounds = [[(r[f"lo{i}"], r[f"hi{i}"]) for i in range(m)] for r in rows]
        ends = np.array([[(np.nan, np.nan) if a is None else (a, b) for a, b in row] for row in bounds], dtype=float)
        self.low, self.high = ends[:, :, 0] / widths, ends[:, :, 1] / widths
        self.known = ~np.isnan(self.low)

    def needed(self, x: np.ndarray, gap: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(row, cell index) pairs to search for rows ``x`` that share their missing columns."""
        present = ~np.isnan(x[0])
        shared = self.known & present
        usable = np.flatnonzero(self.known[:, gap] & shared.any(axis=1))
        if not len(usable):
            return np.empty(0, int), np.empty(0, int)
        use = shared[usable]
        factor = x.shape[1] / use.sum(axis=1)
        low, high = self.low[usable], self.high[usable]
        at = x[:, None, :]
        out = np.where(use, np.maximum(np.maximum(low - at, at - high), 0.0), 0.0)
        far = np.where(use, np.maximum(np.abs(at - low), np.abs(at - high)), 0.0)
        nearest = factor * (out**2).sum(axis=2)
        farthest = factor * (far**2).sum(axis=2)
        order = np.argsort(farthest, axis=1)
        supplied = np.cumsum(self.count[usable][order], axis=1)
        place = np.minimum((supplied < k).sum(axis=1), len(usable) - 1)
        reach = np.take_along_axis(farthest, order, axis=1)[np.arange(len(x)), place]
        reach = np.where(supplied[:, -1] < k, np.inf, reach)
        row, col = np.nonzero(nearest <= reach[:, None] * (1 + 1e-9) + 1e-300)
        return row, usable[col]


def _route(targets: DataFrame, summary: list, splits: list, cols: Sequence[str], k: int, widths: list) -> DataFrame:
    """Each (row, missing column) once per cell slice to search."""
    m, width = len(cols), np.array(widths)
    per_split = {s: [r for r in summary if r["split"] == s] for s in splits}

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cells = {s: _Cells(rows, m, width) for s, rows in per_split.items()}
        for batch in batches:
            values = batch[list(cols)].to_numpy(dtype=float, na_value=np.nan)
            missing = np.isnan(values)
            pattern = missing @ (1 << np.arange(m))
            for (split, _), part in batch.groupby([batch["split"], pattern]):
                table = cells.get(split)
                if table is None:
                    continue
                part_rows = batch.index.get_indexer(part.index)
                block = max(1, min(BLOCK, BLOCK_ENTRIES // (len(table.cell) * m)))
                for start in range(0, len(part_rows), block):
                    rows = part_rows[start : start + block]
                    for gap in np.flatnonzero(missing[rows[0]]):
                        row, cell = table.needed(values[rows] / width, int(gap), k)
                        slices = -(-table.count[cell] // SLICE_ROWS)
                        row, cell = np.repeat(row, slices), np.repeat(cell, slices)
                        part_no = np.concatenate([np.arange(n) for n in slices]) if len(slices) else np.empty(0)
                        found = batch.iloc[rows[row]].reset_index(drop=True)
                        yield found.assign(gap=int(gap), cell=table.cell[cell], slice=part_no.astype("int64"))

    rows = targets.select("key", "split", *cols)
    names = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    return rows.mapInPandas(run, f"{names}, gap int, cell bigint, slice bigint")


def _search(cols: Sequence[str], k: int, widths: list):
    """Best ``k`` donors of one cell slice for every row that searches it."""
    names, width = list(cols), np.array(widths)
    m = len(names)

    def run(targets: pd.DataFrame, donors: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(targets) and len(donors):
            donors = donors.sort_values("donor")
            ids, raw = donors["donor"].to_numpy(), donors[names].to_numpy(dtype=float, na_value=np.nan)
            y = raw / width
            for gap, part in targets.groupby("gap"):
                x = part[names].to_numpy(dtype=float, na_value=np.nan) / width
                keys = part["key"].to_numpy()
                for start in range(0, len(x), BLOCK):
                    rows = slice(start, start + BLOCK)
                    distance = _distances(x[rows], y, gap)
                    row, donor = _nearest(distance, k)
                    found.append(
                        pd.DataFrame(
                            {
                                "key": keys[rows][row], "gap": int(gap), "distance": distance[row, donor],
                                "donor": ids[donor], "value": raw[donor, gap],
                            }
                        )
                    )
        return pd.concat(found) if found else pd.DataFrame(columns=["key", "gap", "distance", "donor", "value"])

    return run


def _distances(x: np.ndarray, y: np.ndarray, gap: int) -> np.ndarray:
    """Squared distances over shared columns, infinite where a donor can't serve."""
    m = x.shape[1]
    total, shared = np.zeros((len(x), len(y))), np.zeros((len(x), len(y)))
    for i in range(m):
        step = (x[:, i][:, None] - y[:, i][None, :]) ** 2
        both = ~np.isnan(step)
        total += np.where(both, step, 0.0)
        shared += both
    usable = (shared > 0) & ~np.isnan(y[:, gap])[None, :]
    return np.where(usable, m / np.maximum(shared, 1) * total, np.inf)


def _nearest(distance: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, donor) of the ``k`` nearest of each row.  Donors come sorted by id, so the first of equals wins."""
    k = min(k, distance.shape[1])
    limit = np.partition(distance, k - 1, axis=1)[:, k - 1 : k]
    row, donor = np.nonzero((distance < limit) & np.isfinite(distance))
    room = k - np.bincount(row, minlength=len(distance))
    at_row, at_donor = np.nonzero((distance == limit) & np.isfinite(distance))
    starts = np.searchsorted(at_row, np.arange(len(distance)))
    first = np.arange(len(at_row)) - starts[at_row] < room[at_row]
    return np.concatenate([row, at_row[first]]), np.concatenate([donor, at_donor[first]])


def knn_impute(
    df: DataFrame,
    cols: Sequence[str],
    k: int = 10,
    entity: str = "entity_id",
    split: str | None = None,
    fit_on: DataFrame | None = None,
    scaled: bool = False,
) -> DataFrame:
    """Each missing cell becomes the plain mean of its column over the ``k`` nearest rows that have it.

    The squared distance of two rows is the sum over the columns both have, times all columns by shared
    columns; rows that share no column are not neighbours.  Equal distances go to the smaller entity id; fewer
    than ``k`` donors all count; with none the column mean is used.  Donors come from the same ``split``, a
    column with few values.  Distances are on raw values unless ``scaled``.
    """
    cols, spark = list(cols), df.sparkSession
    part = F.col(split) if split else F.lit(0)

    def shape(frame: DataFrame) -> DataFrame:
        return frame.select(
            F.col(entity).alias("donor"), part.alias("split"), *[F.col(c).cast("double").alias(c) for c in cols]
        )

    rows = shape(df)
    incomplete = F.lit(False)
    for c in cols:
        incomplete = incomplete | F.col(c).isNull()
    same = W.partitionBy("split", *cols).orderBy("donor")
    # of equal rows only the k smallest ids can count; the group limit drops the others before the shuffle
    pool = shape(fit_on) if fit_on is not None else rows
    size = pool.agg(F.count(F.lit(1)).alias("n"), *[F.stddev_pop(c).alias(c) for c in cols]).first()
    widths = [float(size[c] or 0.0) or 1.0 for c in cols] if scaled else [1.0] * len(cols)
    donors = pool.withColumn("__at", F.row_number().over(same)).where(
        F.col("__at") <= k
    ).drop("__at")
    donors = _with_cells(donors, cols, _planted(pool, cols, size["n"], np.array(widths)), np.array(widths))
    summary = donors.groupBy("split", "cell").agg(
        F.count(F.lit(1)).alias("n"),
        *[F.min(c).alias(f"lo{i}") for i, c in enumerate(cols)],
        *[F.max(c).alias(f"hi{i}") for i, c in enumerate(cols)],
    )
    cells = summary.collect()  # at most MOST_CELLS rows per split
    splits = sorted({r["split"] for r in cells})
    targets = rows.where(incomplete).select("split", *cols).distinct().withColumn("key", _tuple_key("split", cols))
    routed = _route(targets, cells, splits, cols, k, widths)
    groups = ["split", "cell", "slice"]
    sized = spark.createDataFrame(
        [(r["split"], r["cell"], -(-r["n"] // SLICE_ROWS)) for r in cells],
        donors.select("split", "cell", F.lit(0).cast("bigint").alias("slices")).schema,
    )
    blocks = donors.join(F.broadcast(sized), ["split", "cell"])  # bounded by MOST_CELLS rows per split
    blocks = blocks.withColumn("slice", F.pmod(F.xxhash64("donor"), F.col("slices"))).drop("slices")
    # many rows may search one cell: seat them in groups of bounded size, each with a copy of the slice
    shared_folder(spark)
    routed = routed.checkpoint()
    crowd = routed.groupBy(*groups).agg(F.ceil(F.count(F.lit(1)) / SLICE_ROWS).cast("bigint").alias("seats"))
    routed = attach(routed, crowd, groups).withColumn("seat", F.pmod(F.xxhash64("key"), F.col("seats"))).drop("seats")
    every = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("seats") - 1))
    blocks = blocks.join(crowd.toDF(*groups, "seats"), groups).withColumn("seat", every).drop("seats")
    groups = [*groups, "seat"]
    donor_type = dict(rows.dtypes)["donor"]
    nearest = (
        routed.groupBy(*groups)
        .cogroup(blocks.groupBy(*groups))
        .applyInPandas(
            _search(cols, k, widths), f"key string, gap int, distance double, donor {donor_type}, value double"
        )
    )
    best = W.partitionBy("key", "gap").orderBy("distance", "donor")
    nearest = nearest.withColumn("__at", F.row_number().over(best)).where(F.col("__at") <= k)
    filled = nearest.groupBy("key").agg(
        *[F.avg(F.when(F.col("gap") == i, F.col("value"))).alias(f"__new_{c}") for i, c in enumerate(cols)]
    )
    means = pool.groupBy("split").agg(*[F.avg(c).alias(f"__mean_{c}") for c in cols])
    means = means.select(F.map_from_entries(F.collect_list(F.struct("split", F.struct("*")))).alias("m")).scalar()

    keyed = df.select("*", part.alias("__split"))
    gaps = keyed.where(incomplete)
    joined = attach(gaps.withColumn("key", _tuple_key("__split", cols)), filled, ["key"])
    mean = F.try_element_at(means, F.col("__split"))
    done = joined.select(
        *[
            F.coalesce(F.col(c).cast("double"), F.col(f"__new_{c}"), mean[f"__mean_{c}"]).alias(c) if c in cols else F.col(c)
            for c in df.columns
        ]
    )
    whole = df.where(~incomplete).select(*[F.col(c).cast("double").alias(c) if c in cols else F.col(c) for c in df.columns])
    return whole.unionByName(done)
