"""Token ids in binary shard files with a minimal perfect hash index.

Texts are dealt by ranges of ``doc_id``; each range is one shard of two files.  ``.ids`` holds the raw ids, one after
another, as unsigned little-endian integers of ``width`` bytes.  ``.idx`` holds the number of ids per document, the keys in order and the
perfect hash that maps a key to its first document, so a lookup reads one hash, one fingerprint and one
offset.  Files are written under a name of the attempt and renamed when complete: a lost executor leaves no half shard.
"""

from __future__ import annotations

import io
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohort_spark.llm.perfect_hash import PerfectHash
from cohort_spark.llm.store import kept
from cohort_spark.llm.tokens import END_ID, encoder, text_bytes

READ_IDS = 1 << 20
MANIFEST = "shard bigint, name string, n_docs bigint, n_tokens bigint, width int, first_key bigint, last_key bigint"
WHOLE = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"


def file_system(folder: str) -> tuple[fs.FileSystem, str]:
    """The store of a folder or URI, as every executor opens it."""
    return fs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:") else (fs.LocalFileSystem(), folder)


@dataclass
class Shard:
    """The index of one shard: documents in order (those without a key first), and the hash of the distinct keys."""

    keys: np.ndarray  # int64, ascending; only of documents with a key
    without_key: int
    lengths: np.ndarray  # ids per document
    hash: PerfectHash
    firsts: np.ndarray  # number of the key -> its first document

    @classmethod
    def of(cls, keys: np.ndarray, without_key: int, lengths: np.ndarray) -> Shard:
        distinct, first = np.unique(keys, return_index=True)
        made = PerfectHash.build(distinct)
        firsts = np.zeros(len(distinct), dtype=np.int64)
        firsts[made.find(distinct)] = first + without_key
        return cls(keys, without_key, lengths, made, firsts)

    def dump(self) -> bytes:
        out = io.BytesIO()
        np.savez(
            out, keys=self.keys, without_key=self.without_key, lengths=self.lengths, firsts=self.firsts,
            sizes=self.hash.sizes, bits=self.hash.bits, prints=self.hash.prints,
        )
        return out.getvalue()

    @classmethod
    def load(cls, body: bytes) -> Shard:
        with np.load(io.BytesIO(body)) as z:
            made = PerfectHash(z["sizes"], z["bits"], z["prints"])
            return cls(z["keys"], int(z["without_key"]), z["lengths"], made, z["firsts"])

    def offsets(self) -> np.ndarray:
        return np.concatenate([[0], np.cumsum(self.lengths)]).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The first document of each key, -1 for a key that isn't here."""
        number = self.hash.find(keys)
        return np.where(number >= 0, self.firsts[number] if len(self.firsts) else -1, -1)


def write_token_files(docs: DataFrame, folder: str, shards: int | None = None, tokenizer: str | None = None) -> DataFrame:
    """Write all documents in ascending ``doc_id`` order (nulls first, repeated ids by a hash of the text).

    Returns the manifest: one row per shard that has documents.  The manifest is checkpointed, so the files are there
    when this returns.  Null texts are empty; every document ends with the end id.
    """
    spark = docs.sparkSession
    shards = shards or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = (
        docs.select("doc_id", "text", F.xxhash64("text").alias("__text"))
        .repartitionByRange(shards, "doc_id", "__text")
        .sortWithinPartitions("doc_id", "__text")
        .select("doc_id", "text")
    )

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(tokenizer)
        width = 2 if coder.library.get_vocab_size() <= 1 << 16 else 4
        kind, end = f"<u{width}", int(END_ID).to_bytes(4, "little")
        shard = TaskContext.get().partitionId()
        store, root = file_system(folder)
        attempt, name = f"{root}/.{uuid.uuid4().hex}", f"shard-{shard:06d}"
        keys, nulls, lengths, out = [], 0, [], None
        for batch in batches:
            if out is None:
                store.create_dir(root, recursive=True)
                out = store.open_output_stream(f"{attempt}.ids")
            column = batch.column(0)
            keys.append(column.drop_null().to_numpy(zero_copy_only=False).astype(np.int64))
            nulls += column.null_count
            for text in text_bytes(batch.column(1)):
                ids = np.frombuffer(coder.ids(text) + end, dtype="<u4")
                lengths.append(len(ids))
                out.write(ids.astype(kind).tobytes())
        if out is None:
            return
        out.close()
        index = Shard.of(np.concatenate(keys), nulls, np.array(lengths, dtype=np.int64))
        with store.open_output_stream(f"{attempt}.idx") as f:
            f.write(index.dump())
        for part in ("ids", "idx"):
            store.move(f"{attempt}.{part}", f"{root}/{name}.{part}")
        row = [shard, name, len(lengths), int(sum(lengths)), width, *(index.keys[[0, -1]].tolist() if len(index.keys) else (None, None))]
        yield pa.RecordBatch.from_arrays(
            [pa.array([v], t) for v, t in zip(row, [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64()])],
            names=[c.split()[0] for c in MANIFEST.split(", ")],
        )

    return kept(ordered.mapInArrow(write, MANIFEST))


def _with_bases(manifest: DataFrame) -> DataFrame:
    """Shards with the ids in all shards before them; one small row per shard passes through the driver."""
    rows, base = [], 0
    for r in sorted(manifest.collect(), key=lambda r: r["shard"]):
        rows.append((*r, base))
        base += r["n_tokens"]
    spark = manifest.sparkSession
    listed = spark.createDataFrame(rows, MANIFEST + ", base bigint")
    return listed.repartition(max(1, len(rows)), "shard") if rows else listed


def _open(store: fs.FileSystem, root: str, name: str) -> Shard:
    with store.open_input_stream(f"{root}/{name}.idx") as f:
        return Shard.load(f.read())


def read_token_files(manifest: DataFrame, folder: str) -> DataFrame:
    """All documents back from the files: doc_id, start (ids of all documents before), n_tokens, ids_crc32.

    Each key is looked up through the perfect hash, and its ids are read from the place found.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = file_system(folder)
        for batch in batches:
            for row in batch.to_pylist():
                shard, width = _open(store, root, row["name"]), row["width"]
                offsets = shard.offsets()
                first = shard.find(shard.keys)
                if (first < 0).any():
                    raise ValueError(f"{row['name']}: the index doesn't know all of its keys")
                # documents of the same key follow one another
                again = np.arange(len(first)) - np.searchsorted(shard.keys, shard.keys, side="left")
                documents = np.concatenate([np.arange(shard.without_key), first + again])
                keys = pa.array([None] * shard.without_key + shard.keys.tolist(), pa.int64())
                with store.open_input_file(f"{root}/{row['name']}.ids") as f:
                    at = 0
                    while at < len(documents):
                        upto = max(at + 1, int(np.searchsorted(offsets, offsets[at] + READ_IDS, side="right")) - 1)
                        picked = documents[at:upto]
                        low, high = int(offsets[picked.min()]), int(offsets[picked.max() + 1])
                        ids = np.frombuffer(f.read_at((high - low) * width, low * width), dtype=f"<u{width}").astype("<u4")
                        crc = [zlib.crc32(ids[offsets[d] - low : offsets[d + 1] - low].tobytes()) for d in picked]
                        yield pa.RecordBatch.from_arrays(
                            [keys[at:upto], pa.array(offsets[picked] + row["base"]), pa.array(shard.lengths[picked]), pa.array(crc, pa.int64())],
                            names=[c.split()[0] for c in WHOLE.split(", ")],
                        )
                        at = upto

    return _with_bases(manifest).mapInArrow(read, WHOLE)


def fetch(manifest: DataFrame, folder: str, keys: list[int]) -> list[tuple[int, list[int]]]:
    """The ids of some keys, on the caller's machine: one index and one read per document that has the key."""
    store, root = file_system(folder)
    out, opened = [], {}
    listed = manifest.where(F.col("last_key").isNotNull()).collect()
    for key in keys:
        for r in listed:
            if r["first_key"] <= key <= r["last_key"]:
                if r["name"] not in opened:
                    opened[r["name"]] = _open(store, root, r["name"])
                shard = opened[r["name"]]
                at, offsets = int(shard.find(np.array([key]))[0]), shard.offsets()
                with store.open_input_file(f"{root}/{r['name']}.ids") as f:
                    while at >= 0 and at < len(shard.lengths) and shard.keys[at - shard.without_key] == key:
                        body = f.read_at(int(shard.lengths[at]) * r["width"], int(offsets[at]) * r["width"])
                        out.append((key, np.frombuffer(body, dtype=f"<u{r['width']}").tolist()))
                        at += 1
    return out


def token_table(docs: DataFrame, folder: str, shards: int | None = None, tokenizer: str | None = None) -> DataFrame:
    """Write the files below ``folder`` and read them back."""
    return read_token_files(write_token_files(docs, folder, shards, tokenizer), folder)


