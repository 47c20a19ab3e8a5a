"""Ordered work inside a group without ever putting a whole group into one task.

A plain ``Window.partitionBy(entity)`` sends all rows of an entity to one task.  One entity may hold a
third of the data, so the operators here cut every history into chunks along its order:

1. each (group, chunk) is a window partition of its own;
2. each (group, chunk) is also aggregated to one summary row, with map-side combine;
3. a window over the summary rows of a group, one per chunk, gives what earlier or later chunks hand over;
4. the summary is joined back on (group, chunk), the distribution the row windows use as well.

Chunks are bounded by rows (``with_chunks``): rows are counted per (group, time slice), and a running total opens a
chunk every ``rows`` rows.  A slice that holds more than that by itself is cut further along the order.

``chunk=None`` uses the plain window.  That is right where the rows per entity are bounded already, as on
an hourly panel, whose histories can't be longer than the hours the data spans.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cohort_spark.functions.time import EPOCH, as_ntz, seconds_between

CHUNK = "__chunk"


def time_chunk(ts: str | Column, hours: float) -> Column:
    """Number of the time slice of ``hours`` that holds the time stamp."""
    col = F.col(ts) if isinstance(ts, str) else ts
    return F.floor(seconds_between(as_ntz(EPOCH), col.cast("timestamp_ntz")) / F.lit(hours * 3600.0))


CHUNK_ROWS = 1 << 20
CHUNK_HOURS = 1.0
SLOTS = 4096


@dataclass(frozen=True)
class Chunks:
    """How long histories are cut: counted per slice of ``hours``, with a new chunk every ``rows`` rows."""

    hours: float = CHUNK_HOURS
    rows: int = CHUNK_ROWS


def chunks(hours: float | None, rows: int) -> Chunks | None:
    """The chunks of an operator's arguments; none where ``hours`` is None."""
    return None if hours is None else Chunks(hours, rows)


def with_chunks(df: DataFrame, by: Sequence[str], order: Sequence[str], cut: Chunks) -> DataFrame:
    """Add ``CHUNK``, which never decreases along ``order`` within a group and holds fewer than ``2 * cut.rows`` rows.

    A row's chunk is the number of rows of its group in earlier cells, divided by ``cut.rows``.  Cells are slices of
    ``cut.hours``; a slice with more rows is cut into ``SLOTS`` even parts of the time that its rows span, or, if they share
    one time stamp, of the span of the second order column.  (Rows beyond ``cut.rows`` within one such part share a chunk.)
    Groups of up to ``cut.rows`` rows are one chunk, and only cells of larger ones meet the rows again.
    """
    by = list(by)
    cell, slot = "__cell", "__slot"
    names = df.columns
    rows = df.withColumn(cell, time_chunk(order[0], cut.hours))
    micros = F.timestamp_diff("MICROSECOND", as_ntz(EPOCH), F.col(order[0]).cast("timestamp_ntz"))
    ends = {"t": micros}
    if len(order) > 1 and (dict(df.dtypes)[order[1]] in ("tinyint", "smallint", "int", "bigint")):
        ends["o"] = F.col(order[1]).cast("bigint")
    spans = [edge(at).alias(f"__{name}_{end}") for name, at in ends.items() for end, edge in (("low", F.min), ("high", F.max))]
    group = W.partitionBy(*by)
    counts = rows.groupBy(*by, cell).agg(F.count(F.lit(1)).alias("__n"), *spans)
    before = F.coalesce(F.sum("__n").over(group.orderBy(cell).rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    counts = counts.withColumns({"__before": before, "__total": F.sum("__n").over(group)})
    hot = counts.where(F.col("__total") > cut.rows).drop("__total")
    crowded = F.col("__n") > cut.rows
    span = ["__before", *[f"__{name}_{end}" for name in ends for end in ("low", "high")]]
    rows = attach(rows, hot.select(*by, cell, *[F.when(crowded | (F.lit(c) == "__before"), F.col(c)).alias(c) for c in span]), [*by, cell])

    def part(name: str) -> Column:
        low, width = F.col(f"__{name}_low"), F.col(f"__{name}_high") - F.col(f"__{name}_low")
        return F.floor((ends[name] - low).cast("double") / (width + 1) * SLOTS)

    in_time = part("t")
    rows = rows.withColumn(slot, F.when(F.col("__t_high") > F.col("__t_low"), in_time).otherwise(part("o")) if "o" in ends else in_time)
    inside = rows.where(F.col("__t_low").isNotNull()).groupBy(*by, cell, slot).agg(F.count(F.lit(1)).alias("__n"))
    earlier = W.partitionBy(*by, cell).orderBy(slot).rowsBetween(W.unboundedPreceding, -1)
    inside = inside.select(*by, cell, slot, F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__more"))
    rows = attach(rows, inside, [*by, cell, slot])
    place = F.coalesce(F.col("__before"), F.lit(0)) + F.coalesce(F.col("__more"), F.lit(0))
    return rows.select(*names, F.floor(place / cut.rows).alias(CHUNK))


def attach(
    rows: DataFrame, summary: DataFrame, keys: Sequence[str], how: str = "left", null_safe: bool = False
) -> DataFrame:
    """Join ``summary`` (one row per key) back to ``rows``.

    No hint is given: the summary is broadcast only where Spark sees that it is small; otherwise both
    sides shuffle on the key, and a hot key is split by the adaptive skew join.  Plain equality keeps the
    distribution the row windows on the same keys need; ``null_safe`` lets null keys meet as well.
    """
    extra = [c for c in summary.columns if c not in keys]
    if not null_safe:
        return rows.join(summary, list(keys), how).select(*rows.columns, *extra)
    match = reduce(lambda a, b: a & b, [F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}")) for k in keys])
    joined = rows.alias("l").join(summary.alias("r"), match, how)
    return joined.select("l.*", *[F.col(f"r.{c}") for c in extra])


def attach_salted(
    rows: DataFrame, summary: DataFrame, keys: Sequence[str], spread_by: str, salts: int = 64
) -> DataFrame:
    """Inner join with the one-row-per-key ``summary``, each key cut into ``salts`` parts by the hash of ``spread_by``.

    For joins that are followed by a ``groupBy`` on the same keys: that would lean on the distribution of the
    join, which keeps the adaptive skew join from splitting a hot key.  Here the join is spread by the salt,
    and the ``groupBy`` combines on the map side before its own shuffle.  Keys may be null.
    """
    salted = rows.withColumn("__salt", F.pmod(F.xxhash64(spread_by), F.lit(salts)))
    copies = summary.withColumn("__salt", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(salts - 1).cast("bigint"))))
    return attach(salted, copies, [*keys, "__salt"], "inner", null_safe=True).drop("__salt")


def with_parameters(df: DataFrame, parameters: DataFrame, name: str) -> DataFrame:
    """Add a one-row frame of fitted parameters as one struct column.

    It is a scalar subquery: Spark runs it once and hands the row to every task, without a join.  Refer to
    it through the column, so that it is planned once however many expressions use it.
    """
    return df.withColumn(name, parameters.select(F.struct("*")).scalar())


def number_rows(
    df: DataFrame,
    by: Sequence[str],
    order: Sequence[str],
    name: str,
    chunk: Chunks | Column | None = None,
    total: str | None = None,
) -> DataFrame:
    """1-based position of each row in its group, and with ``total`` the rows of the group.

    An order of even keys (a hash) may be cut by a column that never decreases along it.
    """
    by = list(by)
    whole = W.partitionBy(*by)
    if chunk is None:
        counted = {} if total is None else {total: F.count(F.lit(1)).over(whole)}
        place = F.row_number().over(whole.orderBy(*order)).cast("bigint")
        return df.withColumns({name: place, **counted})
    rows = df.withColumn(CHUNK, chunk) if isinstance(chunk, Column) else with_chunks(df, by, order, chunk)
    sizes = rows.groupBy(*by, CHUNK).agg(F.count(F.lit(1)).alias("__n"))
    earlier = whole.orderBy(CHUNK).rowsBetween(W.unboundedPreceding, -1)
    offsets = sizes.select(
        *by,
        CHUNK,
        F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__offset"),
        *([] if total is None else [F.sum("__n").over(whole).alias(total)]),
    )
    local = F.row_number().over(W.partitionBy(*by, CHUNK).orderBy(*order))
    return (
        attach(rows, offsets, [*by, CHUNK])
        .withColumn(name, (local + F.coalesce("__offset", F.lit(0))).cast("bigint"))
        .drop(CHUNK, "__offset")
    )


def place_of(order: Sequence[str]) -> Column:
    """The place in an order as one comparable column.  A single column stays plain: aggregates over it then use
    fixed-width buffers and hash, where a struct makes Spark sort."""
    return F.col(order[0]) if len(order) == 1 else F.struct(*order)


def _known(col: str, order: Sequence[str]) -> Column:
    """The reading with its place in the order, null where there is no reading."""
    return F.when(
        F.col(col).isNotNull(),
        F.struct(*[F.col(o).alias(f"o{i}") for i, o in enumerate(order)], F.col(col).alias("v")),
    )


def nearest_known(
    df: DataFrame,
    by: Sequence[str],
    order: Sequence[str],
    cols: Sequence[str],
    chunk: Chunks | None,
    ahead: bool = False,
) -> DataFrame:
    """Add ``{c}__prev`` (and ``{c}__next`` if ``ahead``): the nearest reading up to (from) each row.

    The added columns are structs of the order columns ``o0, o1, ..`` and the value ``v``.  The look ahead
    runs as a look back in descending order, because a frame that ends at the last row costs quadratic time.
    """
    by, order = list(by), list(order)
    sides = [("prev", F.asc)] + ([("next", F.desc)] if ahead else [])
    rows = df if chunk is None else with_chunks(df, by, order, chunk)
    groups = by if chunk is None else [*by, CHUNK]

    def over(direction) -> W:
        return W.partitionBy(*groups).orderBy(*[direction(o) for o in order]).rowsBetween(W.unboundedPreceding, 0)

    if chunk is not None:
        rows = attach(rows, _handed_over(rows, by, order, cols, sides), [*by, CHUNK])
    out = rows
    for side, direction in sides:
        found = {}
        for c in cols:
            here = F.last(_known(c, order), ignorenulls=True).over(over(direction))
            found[f"{c}__{side}"] = here if chunk is None else F.coalesce(here, F.col(f"__{side}_{c}"))
        out = out.withColumns(found)
    drop = [] if chunk is None else [CHUNK, *[f"__{side}_{c}" for side, _ in sides for c in cols]]
    return out.drop(*drop)


def _handed_over(rows: DataFrame, by: list[str], order: list[str], cols: Sequence[str], sides: list) -> DataFrame:
    """Per (group, chunk): the nearest reading of earlier and of later chunks."""
    most, of_most = {"prev": F.max, "next": F.min}, {"prev": F.max_by, "next": F.min_by}

    def end(c: str, side: str) -> Column:
        if len(order) > 1:
            return most[side](_known(c, order))
        place = F.when(F.col(c).isNotNull(), F.col(order[0]))
        best = F.struct(most[side](place).alias("o0"), of_most[side](F.col(c), place).alias("v"))
        return F.when(most[side](place).isNotNull(), best)

    ends = rows.groupBy(*by, CHUNK).agg(*[end(c, side).alias(f"__{side}_{c}") for side, _ in sides for c in cols])
    carried = [
        F.last(f"__{side}_{c}", ignorenulls=True)
        .over(W.partitionBy(*by).orderBy(direction(CHUNK)).rowsBetween(W.unboundedPreceding, -1))
        .alias(f"__{side}_{c}")
        for side, direction in sides
        for c in cols
    ]
    return ends.select(*by, CHUNK, *carried)


def lagged(
    df: DataFrame,
    by: Sequence[str],
    order: Sequence[str],
    cols: Sequence[str],
    lags: Sequence[int],
    chunk: Chunks | None,
    suffix: str = "_lag",
) -> DataFrame:
    """Add ``{c}{suffix}{k}``: the value ``k`` rows earlier in the group.

    With chunks only the first ``k`` rows of a chunk look outside it.  They and the last ``k`` rows of every
    chunk are all that is needed to settle them, so only those few rows meet in a per-group window.
    """
    by = list(by)

    def shifts(window) -> dict[str, Column]:
        return {f"{c}{suffix}{k}": F.lag(c, k).over(window) for c in cols for k in lags}

    if chunk is None:
        return df.withColumns(shifts(W.partitionBy(*by).orderBy(*order)))
    reach = max(lags)
    inside = W.partitionBy(*by, CHUNK).orderBy(*order)
    whole = W.partitionBy(*by, CHUNK)
    rows = (
        with_chunks(df, by, order, chunk)
        .withColumn("__at", F.row_number().over(inside))
        .withColumn("__left", F.count(F.lit(1)).over(whole) - F.col("__at"))
    )
    settled = rows.withColumns(shifts(inside)).where(F.col("__at") > reach)
    edges = rows.where((F.col("__at") <= reach) | (F.col("__left") < reach))
    heads = edges.withColumns(shifts(W.partitionBy(*by).orderBy(*order))).where(F.col("__at") <= reach)
    return settled.unionByName(heads).drop(CHUNK, "__at", "__left")
