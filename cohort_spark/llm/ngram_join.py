"""Exact Jaccard self-join on four-word shingles by a token-group matrix.

A document's set holds its distinct shingles as 64-bit hashes; documents with equal sets are one class.

*Groups.*  Similar classes are partitioned into groups: classes that share ``LEAST_KEYS`` of ``KEYS`` minhashes (all of theirs, if
they have fewer) with the first class of a bucket form families, and a family is cut into groups of about ``GROUP_TOKENS`` shingles and ``GROUP_MEMBERS`` classes.  Most classes are a group
of their own.  Groups decide the amount of work, never the result.

*Matrix.*  Shingles have one global order: first by how frequent they are (a fixed-size table of levels, built from counts
over all shingles of all documents), then by hash.  Two sets of n and m shingles that link share at least ``ceil(0.85 * max(n, m))``, so
the first ``n - ceil(0.85 * n) + l`` of one and as many of the other share ``l`` at least.  The matrix has a row per shingle
and group whose members hold the shingle among those first ones; groups that share too few rows, or whose sizes can't
link, are no candidates.

*Opening.*  Where two candidate groups meet, the union of each group's shingles bounds what a query of the other can share with
any member.  Queries below their bound are done; for the others the group is opened and every member is counted on full sets.
Each meeting hands on a forest of its links.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohort_spark.llm.components import components
from cohort_spark.llm.near_dup import SMALL, forest, in_tiles, per_tile, shared_counts
from cohort_spark.llm.near_dup import _small_pairs as small_pairs
from cohort_spark.llm.store import kept
from cohort_spark.llm.text import grams, mix, powers, raw, slices, words_of

SHINGLE = 4
PERCENT = 85
KEYS = 16
LEAST_KEYS = 5
GROUP_TOKENS = 1 << 18
GROUP_MEMBERS = 512
EXTRA = 16
TILE = 512
CELLS = 1 << 22
FREQUENT = 8
BUCKET_TOKENS = 1 << 20
HELD_TOKENS = 1 << 22
STREAM_ROWS = 50_000
QUERIES = 16
QUERY, GROUP, OWN = 0, 1, 2
_FEW = np.uint64(0xA24BAED4963EE407)
_SKETCH = "doc_id bigint, n_shingles bigint, set_id binary, ref bigint, keys array<bigint>"


def least_shared(n):
    """How many shingles a set of ``n`` shares at least with a set it links to."""
    return (PERCENT * n + 99) // 100


def surplus(n):
    """How many of their first shingles two linked sets share, the smaller of which has ``n``."""
    return 1 + n // EXTRA


def first_shingles(n):
    """How many shingles of a set of ``n`` go into the matrix."""
    return np.minimum(n, n - least_shared(n) + surplus(n))


def shingle_sets(data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text; a text of fewer words has its whole sequence as one."""
    words = words_of(data, offsets, lower=True)
    hashes = words.hashes()
    runs = grams(hashes, SHINGLE)
    out = []
    for a, b in zip(words.first[:-1].tolist(), words.first[1:].tolist()):
        if b - a >= SHINGLE:
            out.append(np.unique(runs[a : b - SHINGLE + 1]))
        elif b > a:
            few = hashes[a:b] * powers(_FEW, SHINGLE)[1 : b - a + 1]
            out.append(mix(np.array([few.sum() + np.uint64(b - a)], dtype=np.uint64)))
        else:
            out.append(hashes[:0])
    return out


def set_id(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


def bucket_keys(sets: list[np.ndarray]) -> list[list[int]]:
    """A key per (non-empty) set for each part of the shingles that isn't empty: the minimum of a hash over the part."""
    size = np.array([len(s) for s in sets])
    values = np.concatenate(sets)
    none = np.uint64(2**64 - 1)
    low = np.full(len(sets) * KEYS, none)
    np.minimum.at(low, np.repeat(np.arange(len(sets)) * KEYS, size) + (values & np.uint64(KEYS - 1)).astype(np.int64), mix(values))
    low = low.reshape(len(sets), KEYS)
    return [k[k != none].view(np.int64).tolist() for k in low]


def sketches(docs: DataFrame) -> DataFrame:
    """One row per document: size and id of its set, a short reference to it, and its bucket keys."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = raw(batch.column("text"))
            for a, b in slices(offsets):
                sets = shingle_sets(data, offsets[a : b + 1])
                full = [i for i, s in enumerate(sets) if len(s)]
                ids: list = [None] * len(sets)
                keys: list = [None] * len(sets)
                for i, k in zip(full, bucket_keys([sets[i] for i in full]) if full else []):
                    ids[i], keys[i] = set_id(sets[i]), k
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(a, b - a),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array(ids, pa.binary()),
                        pa.array([None if x is None else reference(x) for x in ids], pa.int64()),
                        pa.array(keys, pa.list_(pa.int64())),
                    ],
                    names=[c.split()[0] for c in _SKETCH.split(", ")],
                )

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(sketch, _SKETCH)


def reference(identity: bytes) -> int:
    """A 64-bit short form of a set's id; sets that share one are candidates for each other's partners."""
    return int.from_bytes(identity[:8], "little", signed=True)


# ---- shingles dealt into buckets ------------------------------------------------------------------------------


def dealt(
    docs: DataFrame,
    buckets: int,
    chosen: Callable[[list[np.ndarray]], np.ndarray],
    written: Callable[[np.ndarray], bytes] = np.ndarray.tobytes,
) -> DataFrame:
    """(bucket, packed): ``chosen(sets)`` gives rows of 64-bit values, the first of which is a shingle; the rows of a bucket
    are ``written`` once per flush."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[np.ndarray] = []
        held, most = 0, min(HELD_TOKENS, 200 * buckets)

        def flush() -> pa.RecordBatch:
            rows = np.concatenate(waiting)
            bucket = (rows[:, 0] % np.uint64(buckets)).astype(np.min_scalar_type(buckets))  # short types sort faster
            order = np.argsort(bucket, kind="stable")
            rows, bucket = rows[order], bucket[order]
            first = np.append(np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])), len(bucket))
            packed = [written(rows[a:b]) for a, b in zip(first[:-1].tolist(), first[1:].tolist())]
            dealt_to = pa.array(bucket[first[:-1]].astype(np.int32))
            return pa.RecordBatch.from_arrays([dealt_to, pa.array(packed, pa.binary())], names=["bucket", "packed"])

        for batch in batches:
            data, offsets = raw(batch.column("text"))
            for a, b in slices(offsets):
                distinct = {s.tobytes(): s for s in shingle_sets(data, offsets[a : b + 1]) if len(s)}
                if not distinct:
                    continue
                rows = chosen(list(distinct.values()))
                waiting.append(rows)
                held += len(rows)
                if held >= most:
                    yield flush()
                    waiting, held = [], 0
        if held:
            yield flush()

    return docs.select("text").mapInArrow(deal, "bucket int, packed binary")


def per_bucket(
    rows: DataFrame, width: int, found: Callable[[np.ndarray], pa.RecordBatch], schema: str, kind: type = np.uint64
) -> DataFrame:
    """Bring the packed rows of each bucket together, one bucket at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, parts = None, []
        for batch in batches:
            for bucket, packed in zip(batch.column("bucket").to_pylist(), batch.column("packed").to_pylist()):
                if bucket != now and parts:
                    yield found(np.frombuffer(b"".join(parts), dtype=kind).reshape(-1, width))
                    parts = []
                now = bucket
                parts.append(packed)
        if parts:
            yield found(np.frombuffer(b"".join(parts), dtype=kind).reshape(-1, width))

    return rows.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(run, schema)


def levels(docs: DataFrame, buckets: int) -> np.ndarray:
    """A table of ``CELLS`` bytes: the level of the most frequent shingle that falls into a cell.

    Every shingle is counted, so one that very many documents hold comes last in all of them.  A bucket gets the upper halves
    of its shingles; two that are equal there count together.  Any table gives exact results, because a shingle's level
    depends on the shingle alone.  If more than half of the cells
    would be taken, the lowest levels are given up, so that the rest still tells frequent shingles from rare ones.
    """

    def every(sets: list[np.ndarray]) -> np.ndarray:
        return np.concatenate(sets)[:, None]

    def upper(rows: np.ndarray) -> bytes:
        return (rows >> np.uint64(32)).astype(np.uint32).tobytes()

    def frequent(rows: np.ndarray) -> pa.RecordBatch:
        halves, often = np.unique(rows, return_counts=True)
        halves, often = halves[often >= FREQUENT], often[often >= FREQUENT]
        cell, level = (halves % np.uint32(CELLS)).astype(np.int32), np.log2(often).astype(np.int32)
        return pa.RecordBatch.from_arrays([pa.array(cell), pa.array(level)], names=["cell", "level"])

    counted = per_bucket(dealt(docs, buckets, every, upper), 1, frequent, "cell int, level int", np.uint32)
    found = counted.groupBy("cell").agg(F.max("level").alias("level"))
    cells = found.toArrow()  # one row per cell at most
    table = np.zeros(CELLS, dtype=np.uint8)
    table[cells.column("cell").to_numpy()] = cells.column("level").to_numpy()
    taken = np.cumsum(np.bincount(table, minlength=64)[::-1])[::-1]  # cells of at least a level
    lowest = int(np.flatnonzero(taken[1:] <= CELLS // 2)[0]) + 1
    table[table < lowest] = 0
    return table


def matrix(docs: DataFrame, groups: DataFrame, table: np.ndarray, buckets: int) -> DataFrame:
    """The token-group matrix over first shingles: (shingle, gid, least, most), without shingles of one set only."""

    def first(sets: list[np.ndarray]) -> np.ndarray:
        out = []
        for s in sets:
            level = table[((s >> np.uint64(32)) % np.uint64(CELLS)).astype(np.int64)]
            head = s[np.argsort(level, kind="stable")[: int(first_shingles(len(s)))]]
            ref = np.full(len(head), np.int64(reference(set_id(s))).view(np.uint64))
            out.append(np.stack([head, ref], axis=1))
        return np.concatenate(out)

    def shared(rows: np.ndarray) -> pa.RecordBatch:
        order = np.lexsort((rows[:, 1], rows[:, 0]))
        shingle, ref = rows[order, 0], rows[order, 1]
        new = np.append(True, shingle[1:] != shingle[:-1])
        single = np.append(True, new[1:] | (ref[1:] != ref[:-1]))
        shingle, ref = shingle[single], ref[single]
        _, place, often = np.unique(shingle, return_inverse=True, return_counts=True)
        often = often[place] > 1
        return pa.RecordBatch.from_arrays(
            [pa.array(shingle[often].view(np.int64)), pa.array(ref[often].view(np.int64))], names=["shingle", "ref"]
        )

    rows = per_bucket(dealt(docs, buckets, first), 2, shared, "shingle bigint, ref bigint")
    members = groups.select("ref", "gid", "n_shingles")
    return (
        rows.join(members, "ref")
        .groupBy("shingle", "gid")
        .agg(F.min("n_shingles").alias("least"), F.max("n_shingles").alias("most"))
    )


# ---- groups and their meetings --------------------------------------------------------------------------------


def in_groups(classes: DataFrame) -> DataFrame:
    """(set_id, ref, first_doc, n_shingles, gid) per class."""
    keyed = classes.select("set_id", F.least(F.lit(LEAST_KEYS), F.size("keys")).alias("least"), F.explode("keys").alias("key"))
    heads = kept(keyed.groupBy("key").agg(F.min("set_id").alias("head"), F.count("*").alias("n")).where("n > 1").drop("n"))
    near = keyed.join(heads, "key").groupBy("set_id", "head", "least").agg(F.count("*").alias("n")).where("n >= least")
    families = components(near.select(F.col("set_id").alias("u"), F.col("head").alias("v")))
    families = families.withColumnRenamed("node", "set_id").join(classes.select("set_id", "n_shingles"), "set_id")
    parts = F.greatest(F.ceil(F.sum("n_shingles") / GROUP_TOKENS), F.ceil(F.count("*") / GROUP_MEMBERS))
    sizes = families.groupBy("component").agg(parts.alias("parts"))
    part = F.pmod(F.xxhash64("set_id"), F.col("parts"))
    cut = families.join(sizes, "component").select("set_id", F.xxhash64("component", part).alias("family"))
    joined = classes.join(cut, "set_id", "left")
    return joined.select("set_id", "ref", "first_doc", "n_shingles", F.coalesce("family", "ref").alias("gid"))


def meetings(rows: DataFrame) -> DataFrame:
    """(a, b): pairs of groups that share enough rows of the matrix for a link between members."""
    counts = kept(rows.groupBy("shingle").agg(F.count("*").alias("__n")).where("__n > 1"))
    tiles = in_tiles(rows.join(counts, "shingle"), ["shingle"], "__n", "gid", TILE)
    tiles = tiles.select("__tile", "gid", "least", "most").repartition("__tile").sortWithinPartitions("__tile", "least")

    def pairs(table: pa.Table) -> Iterator[pa.RecordBatch]:
        tile, gid, least, most = (table.column(c).to_numpy() for c in ("__tile", "gid", "least", "most"))
        first = np.append(np.flatnonzero(np.append(True, tile[1:] != tile[:-1])), len(tile))
        left, right = [], []

        def combined() -> pa.RecordBatch:
            u, v = np.concatenate(left), np.concatenate(right)
            a, b = np.where(gid[u] < gid[v], u, v), np.where(gid[u] < gid[v], v, u)
            order = np.lexsort((gid[b], gid[a]))
            a, b = a[order], b[order]
            new = np.flatnonzero(np.append(True, (gid[a][1:] != gid[a][:-1]) | (gid[b][1:] != gid[b][:-1])))
            often = np.diff(np.append(new, len(a)))
            low = np.minimum.reduceat(np.minimum(least[a], least[b]), new)
            return pa.RecordBatch.from_arrays([pa.array(gid[a[new]]), pa.array(gid[b[new]]), pa.array(often), pa.array(low)], names=["a", "b", "n", "low"])

        def taken(u: np.ndarray, v: np.ndarray) -> int:
            fits = (gid[u] != gid[v]) & (PERCENT * least[v] <= 100 * most[u])
            left.append(u[fits])
            right.append(v[fits])
            return int(fits.sum())

        waiting = taken(*small_pairs(first))
        for begin, end in zip(first[:-1].tolist(), first[1:].tolist()):
            if end - begin <= SMALL:
                continue
            for i in range(begin, end - 1):
                j = np.arange(i + 1, end)
                waiting += taken(np.full(len(j), i), j)
            if waiting > 1 << 20:
                yield combined()
                left, right, waiting = [], [], 0
        if waiting:
            yield combined()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pa.RecordBatch] = []
        rows_held = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            waiting.append(batch)
            rows_held += batch.num_rows
            if rows_held < STREAM_ROWS:
                continue
            table = pa.Table.from_batches(waiting).combine_chunks()
            key = table.column("__tile").to_numpy()
            cut = int(np.searchsorted(key, key[-1], side="left"))
            if cut:
                yield from pairs(table.slice(0, cut))
            waiting, rows_held = table.slice(cut).to_batches(), 0
        if waiting:
            yield from pairs(pa.Table.from_batches(waiting).combine_chunks())

    met = tiles.mapInArrow(run, "a bigint, b bigint, n bigint, low bigint")
    shared = met.groupBy("a", "b").agg(F.sum("n").alias("n"), F.min("low").alias("low"))
    return shared.where(F.col("n") >= 1 + F.floor(F.col("low") / EXTRA)).select("a", "b")


def dealt_meetings(met: DataFrame, groups: DataFrame) -> DataFrame:
    """(__tile, gid, role): each meeting is one of a group and a query group; queries of one group share tiles of about
    ``QUERIES`` of them, so a group that meets very many is copied once per tile.  Groups of several classes meet themselves."""
    ends = met.select(F.explode(F.array("a", "b")).alias("gid")).groupBy("gid").agg(F.count("*").alias("n"))
    a, b = (ends.select(F.col("gid").alias(x), F.struct(F.col("n"), F.col("gid").alias("gid")).alias(f"end_{x}")) for x in "ab")
    both = met.join(a, "a").join(b, "b").select(F.greatest("end_a", "end_b").alias("group"), F.least("end_a", "end_b").alias("query"))
    directed = both.select("group.gid", F.col("query.gid").alias("query"), F.col("group.n").alias("n"))
    part = F.pmod(F.xxhash64("query"), F.ceil(F.col("n") / QUERIES))
    directed = kept(directed.withColumn("__tile", F.xxhash64("gid", part)))
    queries = directed.select("__tile", F.col("query").alias("gid"), F.lit(QUERY).alias("role"))
    opened_for = directed.select("__tile", "gid", F.lit(GROUP).alias("role")).distinct()
    own = groups.groupBy("gid").agg(F.count("*").alias("n")).where("n > 1")
    own = own.select(F.xxhash64("gid", F.lit(-1)).alias("__tile"), "gid", F.lit(OWN).alias("role"))
    return queries.unionByName(opened_for).unionByName(own)


def opened(table: pa.Table, first: np.ndarray) -> tuple[list, list]:
    """Forests of the links in each tile: within its own group, and between its queries and its group."""
    ids = table.column("set_id").to_pylist()
    gid, role = table.column("gid").to_numpy(), table.column("role").to_numpy()
    sets = [np.frombuffer(x, dtype=np.uint64) for x in table.column("shingles").to_pylist()]
    size = np.array([len(s) for s in sets], dtype=np.int64)
    out = []
    for begin, end in zip(first[:-1].tolist(), first[1:].tolist()):
        members, roles = np.arange(begin, end), role[begin:end]
        for g in np.unique(gid[begin:end][roles == OWN]):
            out += _links(members[(roles == OWN) & (gid[begin:end] == g)], sets, size)
        queries = members[roles == QUERY]
        for g in np.unique(gid[begin:end][roles == GROUP]):
            group = members[(roles == GROUP) & (gid[begin:end] == g)]
            union = np.unique(np.concatenate([sets[i] for i in group]))
            smallest = int(size[group].min())
            qualify = []
            for q in queries.tolist():
                place = np.minimum(np.searchsorted(union, sets[q]), len(union) - 1)
                within = int((union[place] == sets[q]).sum())
                if 100 * within >= PERCENT * size[q] and (100 + PERCENT) * within >= PERCENT * (size[q] + smallest):
                    qualify.append(q)
            for i in range(0, len(qualify), GROUP_MEMBERS):
                out += _links(np.concatenate([np.array(qualify[i : i + GROUP_MEMBERS]), group]), sets, size)
    return [ids[x] for x, _ in out], [ids[y] for _, y in out]


def _links(members: np.ndarray, sets: list[np.ndarray], size: np.ndarray) -> list[tuple[int, int]]:
    """A forest of the links among a bounded number of sets, counted exactly."""
    if len(members) == 2:
        a, b = members.tolist()
        both = len(np.intersect1d(sets[a], sets[b], assume_unique=True))
        return [(a, b)] if 100 * both >= PERCENT * (size[a] + size[b] - both) else []
    both, n = shared_counts([sets[i] for i in members]), size[members]
    linked = 100 * both >= PERCENT * (n[:, None] + n[None, :] - both)
    return [(int(members[x]), int(members[y])) for x, y in forest(linked)]


def _with_sets(docs: DataFrame, members: DataFrame) -> DataFrame:
    """(set_id, gid, shingles): the full sets of the members, read from their texts."""
    wanted = members.select(F.col("first_doc").alias("__doc"), "set_id", "gid")
    texts = docs.select(F.col("doc_id").cast("bigint").alias("__doc"), "text").join(wanted, "__doc")

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = raw(batch.column("text"))
            wanted_ids = batch.column("set_id").to_pylist()
            for a, b in slices(offsets):
                found = shingle_sets(data, offsets[a : b + 1])
                right = [i for i, s in enumerate(found) if set_id(s) == wanted_ids[a + i]]  # an id may have other texts
                part = batch.slice(a, b - a).take(pa.array(right, pa.int64()))
                shingles = pa.array([found[i].tobytes() for i in right], pa.binary())
                yield pa.RecordBatch.from_arrays([part.column("set_id"), part.column("gid"), shingles], names=["set_id", "gid", "shingles"])

    return texts.select("text", "set_id", "gid").mapInArrow(sets, "set_id binary, gid bigint, shingles binary").dropDuplicates(["set_id"])


# ---- the operator ---------------------------------------------------------------------------------------------


def ngram_join(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id) per row of ``docs`` (``doc_id``, ``text``; other columns are ignored).

    ``component_id`` is the smallest ``doc_id`` reachable by links of similarity 0.85 or more on four-word shingles.  Null,
    empty and blank texts have no shingles and are linked with nothing; rows without an id are linked with nothing and
    their component is null.  Rows of one id are judged by their own text.  An empty table gives no rows.
    """
    docs = docs.select("doc_id", "text")
    sketch = kept(sketches(docs))
    known = sketch.where("n_shingles > 0 and doc_id is not null")
    same = [F.first(c).alias(c) for c in ("ref", "n_shingles", "keys")]  # equal within a class
    classes = kept(known.groupBy("set_id").agg(F.min("doc_id").alias("first_doc"), *same))
    total = classes.agg(F.sum("n_shingles")).first()[0] or 0
    buckets = max(64, -(-int(total) * 2 // (5 * BUCKET_TOKENS)))
    groups = kept(in_groups(classes))
    named_docs = docs.where("doc_id is not null")
    table = levels(named_docs, buckets)
    rows = kept(matrix(named_docs, groups, table, buckets))
    tiles = kept(dealt_meetings(kept(meetings(rows)), groups))
    members = groups.join(tiles.select("gid").distinct(), "gid")
    full = kept(_with_sets(docs, members))
    links = components(per_tile(full.join(tiles, "gid"), ["set_id", "gid", "role", "shingles"], opened))
    named = links.withColumnRenamed("node", "set_id").join(classes.select("set_id", "first_doc"), "set_id")
    smallest = named.groupBy("component").agg(F.min("first_doc").alias("__least"))
    joined = kept(named.join(smallest, "component").select("set_id", "__least"))
    settled = kept(
        classes.select("set_id", "first_doc")
        .join(joined, "set_id", "left")
        .select("set_id", F.coalesce("__least", "first_doc").alias("__component"))
    )
    component = F.when(F.col("n_shingles") == 0, F.col("doc_id")).when(F.col("doc_id").isNotNull(), F.col("__component"))
    return sketch.select("doc_id", "n_shingles", "set_id").join(settled, "set_id", "left").select(
        "doc_id", "n_shingles", component.alias("component_id")
    )
