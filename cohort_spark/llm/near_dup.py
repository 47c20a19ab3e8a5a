"""Near-duplicate documents by tensored MinHash banding, verified on full sets.

A document's set holds its distinct five-word shingles, as 64-bit hashes.  Documents with equal sets are one class.

*Keys.*  Two collections of ``BANDS`` short hashes are computed per class, each over two minhashes.  A table key is a pair
(first-collection hash i, second-collection hash j): ``BANDS ** 2`` = 256 tables from 64 minhashes instead of 1,024.  Two
sets of similarity 0.75 share no key with probability (1 - 0.75 ** 2) ** 16 * 2 = 4e-6, less above.  Keys are kept in
factored form: classes meet by the first part, and pairs that don't share a second part are no candidates.

*Candidates.*  A candidate pair also agrees in 31 of the 64 minhashes at least (fewer has a probability of 2e-6 at 0.75).
Meetings are cut into tiles of a bounded number of classes.  A tile hands on a forest that spans its
candidate pairs, so candidates form groups of similar documents; the groups are components of that forest.

*Verification.*  Within each group every pair is compared on full sets, again in tiles of bounded size; a tile hands on
a forest that spans its links.  The components of the links are the result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohort_spark.llm.components import components
from cohort_spark.llm.store import kept
from cohort_spark.llm.text import grams, mix, powers, raw, slices, words_of

SHINGLE = 5
BANDS = 16
MINHASHES = 4 * BANDS
LEAST_AGREEING = 31
PERCENT = 75
TILE = 512
SMALL = 16
STREAM_ROWS = 20_000
STREAM_BYTES = 32 << 20
_RNG = np.random.default_rng(20240229)
_MULTIPLY = _RNG.integers(0, 1 << 32, MINHASHES, dtype=np.uint32) | np.uint32(1)
_FLIP = _RNG.integers(0, 1 << 32, MINHASHES, dtype=np.uint32)
_SHORT = np.uint64(0xC2B2AE3D27D4EB4F)
_SKETCH = "doc_id bigint, text_hash bigint, n_shingles bigint, set_id binary, keys array<bigint>, signature binary"
_EDGES = "u binary, v binary"


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
            few = hashes[a:b] * powers(_SHORT, SHINGLE)[1 : b - a + 1]
            out.append(mix(np.array([few.sum() + np.uint64(b - a)], dtype=np.uint64)))
        else:
            out.append(hashes[:0])
    return out


def set_id(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


def minhashes(sets: list[np.ndarray]) -> np.ndarray:
    """``MINHASHES`` minima per (non-empty) set."""
    values = (np.concatenate(sets) >> np.uint64(32)).astype(np.uint32)
    first = np.cumsum([0] + [len(s) for s in sets[:-1]])
    out = np.empty((len(sets), MINHASHES), dtype=np.uint32)
    for k in range(MINHASHES):
        v = (values ^ _FLIP[k]) * _MULTIPLY[k]
        v ^= v >> np.uint32(15)
        v *= np.uint32(0x846CA68B)
        out[:, k] = np.minimum.reduceat(v, first)
    return out


def sketches(docs: DataFrame) -> DataFrame:
    """One row per document: size and id of its set, the first parts of its keys, and a signature of 128 bytes
    (the low byte of every minhash, then the second parts of the keys, 32 bits each)."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = raw(batch.column("text"))
            for a, b in slices(offsets):
                sets = shingle_sets(data, offsets[a : b + 1])
                full = [i for i, s in enumerate(sets) if len(s)]
                ids: list = [None] * len(sets)
                keys: list = [None] * len(sets)
                signature: list = [None] * len(sets)
                if full:
                    low = minhashes([sets[i] for i in full])
                    pairs = mix(low[:, 0::2].astype(np.uint64) << np.uint64(32) | low[:, 1::2].astype(np.uint64))
                    parts = pairs[:, :BANDS].view(np.int64).tolist()
                    second = (pairs[:, BANDS:] >> np.uint64(32)).astype("<u4")
                    signs = np.concatenate([low.astype(np.uint8), second.view(np.uint8)], axis=1)
                    for j, i in enumerate(full):
                        ids[i], keys[i], signature[i] = set_id(sets[i]), parts[j], signs[j].tobytes()
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(a, b - a),
                        batch.column("text_hash").slice(a, b - a),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array(ids, pa.binary()),
                        pa.array(keys, pa.list_(pa.int64())),
                        pa.array(signature, pa.binary()),
                    ],
                    names=[c.split()[0] for c in _SKETCH.split(", ")],
                )

    return docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash")).mapInArrow(sketch, _SKETCH)


# ---- tiles ----------------------------------------------------------------------------------------------------


def in_tiles(members: DataFrame, group: list[str], size: str, node: str, tile: int) -> DataFrame:
    """Deal the rows of each group into tiles: a group of up to ``tile`` rows is one, a larger one is cut into blocks
    and each pair of blocks is a tile.  Adds ``__tile``."""
    blocks = F.ceil(F.col(size) / tile).cast("int")
    own = F.pmod(F.xxhash64(node), F.col("__blocks")).cast("int")
    pair = F.struct(F.least("__own", "__other"), F.greatest("__own", "__other"))
    dealt = members.withColumn("__blocks", blocks).withColumn("__own", own)
    dealt = dealt.withColumn("__other", F.explode(F.sequence(F.lit(0), F.col("__blocks") - 1)))
    return dealt.withColumn("__tile", F.xxhash64(*group, pair)).drop("__blocks", "__own", "__other")


def per_tile(tiles: DataFrame, columns: list[str], edges: Callable[[pa.Table, np.ndarray], tuple[list, list]]) -> DataFrame:
    """Bring the rows of each tile together and let ``edges(rows, first row of each tile)`` name its edges."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pa.RecordBatch] = []
        rows = held = 0

        def flush(table: pa.Table):
            key = table.column("__tile").to_numpy()
            first = np.append(np.flatnonzero(np.append(True, key[1:] != key[:-1])), len(key))
            u, v = edges(table.select(columns), first)
            return pa.RecordBatch.from_arrays([pa.array(u, pa.binary()), pa.array(v, pa.binary())], names=["u", "v"])

        for batch in batches:
            if not batch.num_rows:
                continue
            waiting.append(batch)
            rows, held = rows + batch.num_rows, held + batch.nbytes
            if rows < STREAM_ROWS and held < STREAM_BYTES:
                continue
            table = pa.Table.from_batches(waiting).combine_chunks()
            key = table.column("__tile").to_numpy()
            cut = int(np.searchsorted(key, key[-1], side="left"))
            if cut:
                yield flush(table.slice(0, cut))
            waiting, rows, held = table.slice(cut).to_batches(), 0, 0
        if waiting:
            yield flush(pa.Table.from_batches(waiting).combine_chunks())

    dealt = tiles.select("__tile", *columns).repartition("__tile").sortWithinPartitions("__tile")
    return dealt.mapInArrow(run, _EDGES)


def forest(linked: np.ndarray) -> list[tuple[int, int]]:
    """A star per component of a symmetric boolean matrix."""
    free, out = np.ones(len(linked), dtype=bool), []
    for root in range(len(linked)):
        if not free[root]:
            continue
        free[root] = False
        front = np.flatnonzero(linked[root] & free)
        while len(front):
            free[front] = False
            out += [(root, int(x)) for x in front]
            front = np.flatnonzero(linked[front].any(axis=0) & free)
    return out


def _small_pairs(first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of rows within tiles of at most ``SMALL`` rows."""
    size, left, right = np.diff(first), [], []
    for s in range(2, SMALL + 1):
        base = first[:-1][size == s]
        if len(base):
            a, b = np.triu_indices(s, 1)
            left.append((base[:, None] + a).ravel())
            right.append((base[:, None] + b).ravel())
    none = np.zeros(0, dtype=np.int64)
    return (np.concatenate(left), np.concatenate(right)) if left else (none, none)


def _candidate_edges(table: pa.Table, first: np.ndarray) -> tuple[list, list]:
    ids = table.column("set_id").to_pylist()
    signs = np.frombuffer(b"".join(table.column("signature").to_pylist()), dtype=np.uint8).reshape(len(ids), -1)
    low, second = np.ascontiguousarray(signs[:, :MINHASHES]), np.ascontiguousarray(signs[:, MINHASHES:]).view("<u4")
    a, b = _small_pairs(first)
    same = np.zeros(len(a), dtype=bool)
    for i in range(0, len(a), 1 << 16):
        x, y = a[i : i + (1 << 16)], b[i : i + (1 << 16)]
        same[i : i + len(x)] = ((low[x] == low[y]).sum(axis=1) >= LEAST_AGREEING) & (second[x] == second[y]).any(axis=1)
    pairs = list(zip(a[same].tolist(), b[same].tolist()))
    for begin, end in zip(first[:-1].tolist(), first[1:].tolist()):
        if end - begin > SMALL:
            own, keys = low[begin:end], second[begin:end]
            linked = np.zeros((end - begin, end - begin), dtype=bool)
            for r in range(end - begin):
                linked[r] = ((own == own[r]).sum(axis=1) >= LEAST_AGREEING) & (keys == keys[r]).any(axis=1)
            pairs += [(begin + x, begin + y) for x, y in forest(linked)]
    return [ids[x] for x, _ in pairs], [ids[y] for _, y in pairs]


def shared_counts(sets: list[np.ndarray]) -> np.ndarray:
    """The sizes of all pairwise intersections of a bounded number of sets."""
    values, place, often = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    number = np.cumsum(often > 1) - 1  # elements of one set only add nothing
    shared = (often > 1)[place]
    row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])[shared]
    column = number[place[shared]]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    total, step = np.zeros((len(sets), len(sets)), dtype=np.float64), 2048
    for low in range(0, int(column[-1]) + 1 if len(column) else 0, step):
        a, b = np.searchsorted(column, [low, low + step])
        block = np.zeros((len(sets), step), dtype=np.float32)
        block[row[a:b], column[a:b] - low] = 1
        total += block @ block.T
    return total


def _verified_edges(table: pa.Table, first: np.ndarray) -> tuple[list, list]:
    ids = table.column("set_id").to_pylist()
    sets = [np.frombuffer(x, dtype=np.uint64) for x in table.column("shingles").to_pylist()]
    size = np.array([len(s) for s in sets], dtype=np.int64)
    pairs = []
    for begin, end in zip(first[:-1].tolist(), first[1:].tolist()):
        if end - begin == 2:
            a, b = begin, begin + 1
            if 100 * min(size[a], size[b]) >= PERCENT * max(size[a], size[b]):
                both = len(np.intersect1d(sets[a], sets[b], assume_unique=True))
                if 100 * both >= PERCENT * (size[a] + size[b] - both):
                    pairs.append((a, b))
        elif end - begin > 2:
            both = shared_counts(sets[begin:end])
            n = size[begin:end]
            pairs += [(begin + x, begin + y) for x, y in forest(100 * both >= PERCENT * (n[:, None] + n[None, :] - both))]
    return [ids[x] for x, _ in pairs], [ids[y] for _, y in pairs]


# ---- the operator ---------------------------------------------------------------------------------------------


def _met(rows: DataFrame, key: list[str]) -> DataFrame:
    """Rows whose key occurs more than once, with that number.  Counts are written first: a plain join that can be split."""
    counts = kept(rows.groupBy(*key).agg(F.count("*").alias("__n")).where("__n > 1"))
    return rows.join(counts, key)


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept, text_hash) per row of ``docs`` (``doc_id``, ``text``; other columns are ignored).

    ``component_id`` is the smallest ``doc_id`` reachable by links of similarity 0.75 or more.  Null, empty and blank
    texts have no shingles and are linked with nothing; rows without an id are linked with nothing and kept, their
    component is null.  Rows of one id are judged by their own text.  An empty table gives no rows.
    """
    sketch = kept(sketches(docs))
    known = sketch.where("n_shingles > 0 and doc_id is not null")
    same = [F.first(c).alias(c) for c in ("keys", "signature")]  # equal within a class
    classes = kept(known.groupBy("set_id").agg(F.min("doc_id").alias("first_doc"), *same))
    keyed = classes.select("set_id", F.posexplode("keys").alias("table", "key"))
    met = in_tiles(_met(keyed, ["table", "key"]), ["table", "key"], "__n", "set_id", TILE)
    signed = met.select("set_id", "__tile").join(classes.select("set_id", "signature"), "set_id")
    candidates = per_tile(signed, ["set_id", "signature"], _candidate_edges)
    grouped = components(candidates).withColumnsRenamed({"node": "set_id", "component": "group"})
    members = _met(grouped, ["group"]).join(classes.select("set_id", "first_doc"), "set_id")
    links = components(per_tile(_with_sets(docs, members), ["set_id", "shingles"], _verified_edges))
    named = links.withColumnRenamed("node", "set_id").join(classes.select("set_id", "first_doc"), "set_id")
    smallest = named.groupBy("component").agg(F.min("first_doc").alias("__least"))
    joined = kept(named.join(smallest, "component").select("set_id", "__least"))
    total = kept(
        classes.select("set_id", "first_doc")
        .join(joined, "set_id", "left")
        .select("set_id", F.coalesce("__least", "first_doc").alias("__component"))
    )
    component = F.when(F.col("n_shingles") == 0, F.col("doc_id")).when(F.col("doc_id").isNotNull(), F.col("__component"))
    return sketch.select("doc_id", "text_hash", "n_shingles", "set_id").join(total, "set_id", "left").select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
        "text_hash",
    )


def _with_sets(docs: DataFrame, members: DataFrame) -> DataFrame:
    """The full sets of the members, read from their texts, dealt into tiles."""
    wanted = members.select(F.col("first_doc").alias("__doc"), "set_id", "group", "__n")
    texts = docs.select(F.col("doc_id").alias("__doc"), "text").join(wanted, "__doc")

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = raw(batch.column("text"))
            wanted_ids = batch.column("set_id").to_pylist()
            for a, b in slices(offsets):
                found = shingle_sets(data, offsets[a : b + 1])
                right = [i for i, s in enumerate(found) if set_id(s) == wanted_ids[a + i]]  # an id may have other texts
                part = batch.slice(a, b - a).take(pa.array(right, pa.int64()))
                shingles = pa.array([found[i].tobytes() for i in right], pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [part.column("set_id"), part.column("group"), part.column("__n"), shingles],
                    names=["set_id", "group", "__n", "shingles"],
                )

    full = texts.select("text", "set_id", "group", "__n").mapInArrow(
        sets, "set_id binary, group binary, __n bigint, shingles binary"
    )
    return in_tiles(full, ["group"], "__n", "set_id", TILE)


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """``docs`` without the documents that are near copies of one with a smaller id; all columns as they were."""
    gone = near_duplicates(docs).where(~F.col("kept"))
    gone = gone.select(F.col("doc_id").alias("__gone"), F.col("text_hash").alias("__hash")).distinct()
    return docs.join(gone, (F.col("doc_id") == F.col("__gone")) & (F.xxhash64("text") == F.col("__hash")), "left_anti")
