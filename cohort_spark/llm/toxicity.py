"""Toxicity by compression distance.

Two zstandard dictionaries are trained on labelled text.  Both start with the common words of ordinary text, and go on with
the segments (words) that occur in more distinct surroundings in one class than in the other: those of toxic text in one,
those of ordinary text in the other.  Counting distinct surroundings keeps copies of one text from deciding.
Windows of one word, one for each, and of ``WINDOW`` words, one from every ``STEP``-th word on, so that each word lies in
two of them, are compressed with both; where the toxic dictionary saves bytes, the window is closer to toxic text.  A match is at least four bytes long, and zstandard finds it by four bytes at every
third place of a dictionary: a window without any such four bytes of the toxic segments, or with such only inside strings (of
up to eight bytes) that the ordinary dictionary holds too, has nothing to gain from them, and counts
as saving nothing without being compressed (what it would save or lose is down to common words that one table has lost).  zstandard finds no match in the last bytes of its input, and a single short
match doesn't pay for its block header: so every window stands between a head and a tail that end both dictionaries.  The score is a logistic function of how many windows of a text save how many bytes, calibrated on
labelled texts that the dictionaries were not trained on.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohort_spark.llm.store import kept

#: Dictionaries and calibration are fitted on at most about this many labelled texts of each class, chosen by a hash.
SAMPLE_TEXTS = 4000
LEVEL = 3
WINDOW = 4
STEP = 2
#: A dictionary holds this many common words, and segments of its class up to this many bytes.
COMMON = 1024
SEGMENT_BYTES = 1 << 15
#: A segment must have this many surroundings: the first number, the second from 60 toxic training texts for each on.
LEAST_COUNT = (3, 6)
LEAST_RATIO = 6.0
STEPS = 9
CUTOFF = 0.7
CACHED_WORDS = 200_000
CACHED_TEXTS = 2_000
#: zstandard's fast double hash enters every third place of a dictionary into its table of short matches.
STRIDE = 3
#: Around every window, and at the end of both dictionaries.
HEAD = b"<|start of window|>"
TAIL = b"<|this is the end of window|>"
SLICE_ROWS = 500
#: Strings around four bytes are told apart by this many bits; two that share them only cost a compression.
CELL_BITS = 20
_MARKS = b".,!?;:*$%&#\"'()"


def _words(text: str | None) -> list[bytes]:
    return (text or "").encode().lower().split()


@dataclass
class Framed:
    """A text as its words with spaces around each; a window of words is a slice of it."""

    body: bytes
    begins: np.ndarray
    ends: np.ndarray

    def windows(self, size: int, step: int) -> tuple[np.ndarray, np.ndarray]:
        """Where the windows of ``size`` words begin and end; the last one ends with the text, a shorter text is one window."""
        last = max(0, len(self.begins) - size)
        first = np.append(np.arange(0, last, step), last)
        return self.begins[first], self.ends[np.minimum(first + size, len(self.ends)) - 1]


def framed(words: list[bytes]) -> Framed:
    if not words:
        return Framed(b"  ", np.zeros(1, dtype=np.int64), np.full(1, 2, dtype=np.int64))
    size = np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 2
    ends = np.cumsum(size)
    return Framed(b" %b " % b"  ".join(words), ends - size, ends)


def _words32(body: np.ndarray) -> np.ndarray:
    x = body.astype(np.uint32)
    return x[:-3] | x[1:-2] << 8 | x[2:-1] << 16 | x[3:] << 24


def _fours(body: np.ndarray) -> np.ndarray:
    """A number below ``1 << 16`` for the four bytes from each place on."""
    return (_words32(body) * np.uint32(0x9E3779B1)) >> np.uint32(16)


def _around(body: np.ndarray, places: np.ndarray) -> np.ndarray:
    """A number below ``1 << CELL_BITS`` for every string of four to eight bytes that holds the four bytes from a place on: a row per place."""
    low = _words32(np.concatenate([np.zeros(4, np.uint8), body, np.zeros(8, np.uint8)])).astype(np.uint64)
    eights = (low[:-4] | low[4:] << np.uint64(32))[places[:, None] + np.arange(4, -1, -1)]
    strings = np.concatenate([eights[:, : size - 3] & np.uint64((1 << 8 * size) - 1) for size in range(4, 9)], axis=1)
    return (strings * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - CELL_BITS)


def _joined(segments: list[bytes]) -> bytes:
    """Segments with spaces around, each starting at a multiple of ``STRIDE``: only there zstandard indexes short matches.

    What parts them occurs in no window, so a match ends with its word and the next one keeps its space.
    """
    return b"".join((b" " + w + b" ").ljust((len(w) + 2 + STRIDE) // STRIDE * STRIDE, b"\n") for w in segments)


@dataclass
class Compressors:
    """A pair of compressors with the two dictionaries; picklable, so tasks make their own."""

    toxic: bytes
    ordinary: bytes
    cache: dict = field(default_factory=dict, repr=False)
    older: dict = field(default_factory=dict, repr=False)
    texts: dict = field(default_factory=dict, repr=False)
    made: list = field(default_factory=list, repr=False)

    def __getstate__(self):
        return {"toxic": self.toxic, "ordinary": self.ordinary, "cache": {}, "older": {}, "texts": {}, "made": []}

    def _matchable(self) -> tuple[np.ndarray, np.ndarray]:
        """Which four bytes a match with a toxic segment can be found by; and which strings around them (``_around``) hold what the
        ordinary dictionary doesn't: strings that aren't in it, and all of eight bytes."""
        if len(self.made) < 3:
            self._both()
            first = len(os.path.commonprefix([self.toxic, self.ordinary])) // STRIDE * STRIDE
            content = np.frombuffer(self.toxic + HEAD, dtype=np.uint8)
            places = np.arange(first, len(self.toxic), STRIDE)
            table = np.zeros(1 << 16, dtype=bool)
            table[_fours(content)[places]] = True
            other = np.frombuffer(self.ordinary + HEAD + TAIL, dtype=np.uint8)
            have = np.zeros(1 << CELL_BITS, dtype=bool)
            have[_around(other, np.arange(len(other)))] = True
            around = _around(content, places)
            new = ~have[around]
            new[:, -5:] = True
            strings = np.zeros(1 << CELL_BITS, dtype=bool)
            strings[around[new]] = True
            self.made.append((table, strings))
        return self.made[2]

    def _gains(self, body: np.ndarray) -> np.ndarray:
        """How many places before each place of a text have something to gain."""
        if len(body) < 4:
            return np.zeros(len(body) + 1, dtype=np.int64)
        fours, strings = self._matchable()
        found = np.zeros(len(body) - 3, dtype=bool)
        places = np.flatnonzero(fours[_fours(body)])
        found[places[strings[_around(body, places)].any(axis=1)]] = True
        return np.append(0, np.cumsum(found))

    def _both(self) -> list:
        if not self.made:
            for content in (self.toxic, self.ordinary):
                dictionary = zstandard.ZstdCompressionDict(content + HEAD + TAIL, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
                dictionary.precompute_compress(level=LEVEL)
                self.made.append(
                    zstandard.ZstdCompressor(
                        level=LEVEL, dict_data=dictionary, write_content_size=False, write_checksum=False, write_dict_id=False
                    ).compress
                )
        return self.made[:2]

    def saved(self, window: bytes) -> int:
        """Bytes that the toxic dictionary saves."""
        toxic, ordinary = self._both()
        window = HEAD + window + TAIL
        return len(ordinary(window)) - len(toxic(window))

    def _of_word(self, word: bytes) -> int:
        """What a word saves by itself, kept with the words of this generation and the one before."""
        value = self.older.get(word)
        if value is None:
            value = self.saved(b" %b " % word)
        if len(self.cache) >= CACHED_WORDS:
            self.older = dict(self.cache)
            self.cache.clear()
        self.cache[word] = value
        return value

    def features(self, text: str | None) -> list[float]:
        """What the windows of a whole text save, the same for equal texts near one another."""
        known = self.texts.get(text)
        if known is None:
            if len(self.texts) >= CACHED_TEXTS:
                self.texts.clear()
            known = self.texts[text] = self._features(_words(text))
        return known

    def _savings(self, text: Framed, size: int, step: int, found: np.ndarray | None = None) -> np.ndarray:
        """What each window of ``size`` words saves; ``found`` are the ``_gains`` of the text, if known."""
        begins, ends = text.windows(size, step)
        out = np.zeros(len(begins), dtype=np.int64)
        if found is None:
            found = self._gains(np.frombuffer(text.body, dtype=np.uint8))
        gains = np.flatnonzero(found[np.maximum(ends - 3, begins)] > found[begins])
        if size == 1:
            known, whole = self.cache.get, text.body
            words = [whole[a:b] for a, b in zip((begins[gains] + 1).tolist(), (ends[gains] - 1).tolist())]
            out[gains] = [v if v is not None else self._of_word(w) for w, v in zip(words, map(known, words))]
        else:
            toxic, ordinary = self._both()
            inputs = [HEAD + text.body[a:b] + TAIL for a, b in zip(begins[gains].tolist(), ends[gains].tolist())]
            out[gains] = [len(b) - len(a) for a, b in zip(map(toxic, inputs), map(ordinary, inputs))]
        return out

    def _features(self, words: list[bytes]) -> list[float]:
        """The number of windows, the largest savings, and how many save 1, 2 .. bytes: of words, and of windows of several."""
        text = framed(words)
        found = self._gains(np.frombuffer(text.body, dtype=np.uint8))
        out: list[float] = []
        for s in (self._savings(text, 1, 1, found), self._savings(text, WINDOW, STEP, found)):
            top = np.sort(s)[::-1][:4]
            out += [len(s), top[0], top[:2].mean(), top.mean()]
            out += (len(s) - np.searchsorted(np.sort(s), np.arange(1, STEPS + 1), side="left")).tolist()
        return out


def _inputs(features: np.ndarray) -> np.ndarray:
    parts = [np.ones((len(features), 1))]
    for f in np.split(features, 2, axis=1):
        n, counts = f[:, :1], f[:, 4:]
        parts += [np.log1p(n), f[:, 1:4] / 4, np.log1p(counts), np.log((counts + 0.05) / (n + 1))]
    return np.hstack(parts)


@dataclass
class Model:
    compressors: Compressors
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray

    def scores(self, texts: list[str | None]) -> np.ndarray:
        if not texts:
            return np.zeros(0)
        x = (_inputs(np.array([self.compressors.features(t) for t in texts], dtype=float)) - self.mean) / self.scale
        return 1 / (1 + np.exp(-np.clip(x @ self.weights, -40, 40)))


def calibrate(features: np.ndarray, label: np.ndarray, weight: np.ndarray, penalty: float = 1.0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Weighted ridge logistic regression by Newton steps: mean, scale and weights of the inputs."""
    x = _inputs(features)
    mean, scale = x.mean(axis=0), x.std(axis=0)
    mean[0], scale[0] = 0, 1
    scale[scale < 1e-9] = 1
    z = (x - mean) / scale
    w = np.zeros(z.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -40, 40)))
        gradient = z.T @ (weight * (p - label)) + penalty * w
        step = np.linalg.solve((z * (weight * p * (1 - p))[:, None]).T @ z + penalty * np.eye(len(w)), gradient)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return mean, scale, w


def labelled_sample(docs: DataFrame, labels: DataFrame, usable: Column, sample: int = SAMPLE_TEXTS) -> DataFrame:
    """(text, toxic, weight, train) of about ``sample`` texts per class; ``train`` parts dictionaries from calibration."""
    known = labels.where(usable & F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1)).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    counts = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    place = F.pmod(F.xxhash64(F.lit("toxicity"), "doc_id"), F.lit(1 << 20))
    shares = {k: min(1.0, sample / n) for k, n in counts.items()}

    def of_class(values: dict) -> Column:
        return F.when(F.col("toxic") == 1, F.lit(values.get(1, 1.0))).otherwise(F.lit(values.get(0, 1.0)))

    chosen = known.where(place < of_class(shares) * (1 << 20)).select(
        F.col("doc_id").alias("__doc"),
        F.col("toxic").alias("__toxic"),
        of_class({k: 1 / s for k, s in shares.items()}).alias("__weight"),
        (F.xxhash64(F.lit("part"), "doc_id") % 2 == 0).alias("__train"),
    )
    # At most about 2 * sample rows of a few numbers: the texts needn't be shuffled to find those of the sample.
    joined = docs.select("doc_id", "text").join(F.broadcast(chosen), F.col("doc_id") == F.col("__doc"))
    rows = joined.select("doc_id", "text", F.col("__toxic").cast("int").alias("toxic"), F.col("__weight").alias("weight"), F.col("__train").alias("train"))
    return rows.distinct().drop("doc_id")  # rows that repeat count once


def segment_counts(sample: DataFrame) -> dict[bytes, tuple[int, int]]:
    """In how many distinct surroundings (words before it) each word occurs in (ordinary, toxic) training texts."""

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = set()
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = [w.strip(_MARKS) for w in _words(text)]
                found.update((a, b, toxic) for a, b in zip([b"", *words], words) if len(b) > 2)
            before, word, toxic = zip(*found) if found else ((), (), ())
            yield pa.RecordBatch.from_arrays([pa.array(before, pa.binary()), pa.array(word, pa.binary()), pa.array(toxic, pa.int32())], names=["before", "word", "toxic"])

    found = sample.where("train").select("text", "toxic").mapInArrow(pairs, "before binary, word binary, toxic int").distinct()
    sums = [F.sum((F.col("toxic") == k).cast("bigint")).alias(f"n{k}") for k in (0, 1)]
    counts = found.groupBy("word").agg(*sums).where(F.col("n0") + F.col("n1") >= LEAST_COUNT[0])
    return {bytes(r["word"]): (r["n0"], r["n1"]) for r in counts.collect()}  # words of a bounded sample


def dictionaries(counts: dict[bytes, tuple[int, int]], toxic_texts: int) -> Compressors:
    """The two dictionaries, equally long."""
    totals = [max(1, sum(c[k] for c in counts.values())) for k in (0, 1)]
    least = min(LEAST_COUNT[1], max(LEAST_COUNT[0], toxic_texts // 60))

    def segments(k: int) -> list[bytes]:
        ratio = {w: (c[k] + 0.5) / (c[1 - k] + 0.5) * totals[1 - k] / totals[k] for w, c in counts.items() if c[k] >= least}
        found = sorted((w for w in ratio if ratio[w] >= LEAST_RATIO), key=lambda w: (-counts[w][k], w))
        upto = np.cumsum([len(_joined([w])) for w in found])
        return found[: int(np.searchsorted(upto, SEGMENT_BYTES, side="right"))]

    bad = segments(1)
    common = sorted(set(counts).difference(bad), key=lambda w: (-counts[w][0], w))  # in a small sample they would hold all words
    base = _joined(common[:COMMON][::-1])
    toxic = _joined(bad[::-1])
    other = _joined(segments(0) + common[COMMON:])[: len(toxic)]
    return Compressors(base + toxic, base + other.ljust(len(toxic), b"\n"))


def fit(docs: DataFrame, labels: DataFrame, usable: Column | None = None, sample: int = SAMPLE_TEXTS) -> Model | None:
    """A model learnt from the labelled rows for which ``usable`` holds; None if a class is missing."""
    texts = kept(labelled_sample(docs, labels, F.lit(True) if usable is None else usable, sample))
    compressors = dictionaries(segment_counts(texts), texts.where(F.col("train") & (F.col("toxic") == 1)).count())
    width = 2 * (4 + STEPS)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [compressors.features(t) for t in batch.column(0).to_pylist()]
            values = pa.array([[float(v) for v in r] for r in rows], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([values, batch.column(1), batch.column(2)], names=["f", "toxic", "weight"])

    measured = texts.where(~F.col("train")).select("text", "toxic", "weight").mapInArrow(measure, "f array<double>, toxic int, weight double")
    rows = sorted((r["toxic"], r["weight"], r["f"]) for r in measured.collect())  # a bounded sample, in a fixed order
    label = np.array([r[0] for r in rows], dtype=float)
    if not 0 < label.sum() < len(label):
        return None
    features = np.array([r[2] for r in rows]).reshape(len(rows), width)
    weight = np.array([r[1] for r in rows])
    return Model(compressors, *calibrate(features, label, weight / weight.mean()))


def with_scores(docs: DataFrame, model: Model | None) -> DataFrame:
    """``docs`` with ``score`` (0 to 1) of the whole text; a column of that name is replaced.

    Null and empty texts get the score of a text without words; without a model all scores are 0.
    """
    docs = docs.drop("score")
    names = docs.columns
    schema = T.StructType([*docs.schema.fields, T.StructField("score", T.DoubleType())])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE_ROWS):
                part = batch.slice(at, SLICE_ROWS)
                scores = model.scores(part.column("text").to_pylist()) if model else np.zeros(part.num_rows)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(scores)], names=[*names, "score"])

    return docs.mapInArrow(score, schema)


def usable_label() -> Column:
    """Rows whose labels may be learnt from."""
    return F.crc32(F.col("doc_id").cast("string")) % 3 != 1


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) per row of ``docs``; only the text enters a score.  An empty table gives no rows."""
    model = fit(docs, labels, usable_label())
    scored = with_scores(docs.select("doc_id", "text"), model)
    return scored.select(
        "doc_id",
        F.coalesce(~usable_label(), F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= CUTOFF).cast("int").alias("predicted"),
    )


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` without those that are predicted to be toxic; all columns as they were."""
    model = fit(docs, labels, usable_label())
    marked = with_scores(docs.select(F.struct("*").alias("row"), "text"), model)
    return marked.where(F.col("score") < CUTOFF).select("row.*")
