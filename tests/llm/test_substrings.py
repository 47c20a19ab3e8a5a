import hashlib
import random
import re
import time

import numpy as np
import pyarrow as pa
import pytest

from cohort_spark.llm import substrings
from cohort_spark.llm.substrings import remove_repeats

WORD = re.compile(r"[^\x20\x09-\x0D]+")
TOP = 2**63


def brute(rows, window):
    """(doc, n_words, n_removed, kept text) of (doc, text) rows."""
    split = [WORD.findall(t or "") for _, t in rows]
    first = {}
    for (doc, _), words in zip(rows, split):
        for i in range(len(words) - window + 1):
            key = tuple(words[i : i + window])
            first[key] = min(first.get(key, TOP), TOP - 1 if doc is None else doc)
    out = []
    for (doc, _), words in zip(rows, split):
        gone = set()
        for i in range(len(words) - window + 1):
            if first[tuple(words[i : i + window])] < (TOP - 1 if doc is None else doc):
                gone.update(range(i, i + window))
        out.append((doc, len(words), len(gone), " ".join(w for i, w in enumerate(words) if i not in gone)))
    return sorted(out, key=repr)


def got(df):
    return sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in df.collect()), key=repr)


def corpus(seed, size):
    rng = random.Random(seed)
    vocabulary = ["w%d" % i for i in range(30)] + ["é", "日本", "A", "a"]
    passages = [[rng.choice(vocabulary) for _ in range(rng.randint(6, 25))] for _ in range(6)]
    rows = []
    for i in range(size):
        words = []
        for _ in range(rng.randint(0, 8)):
            words += rng.choice(passages) if rng.random() < 0.5 else [rng.choice(vocabulary) for _ in range(rng.randint(1, 12))]
        gaps = [rng.choice([" ", "  ", "\n", "\t", "\r\n"]) for _ in words]
        rows.append((rng.choice([i, i, i, -i, None, 5]), "".join(w + g for w, g in zip(words, gaps))))
    rows += [(900, None), (901, ""), (902, " \n"), (903, "x " * 300), (904, "x " * 200), (905, " ".join(passages[0] * 5))]
    return rows + rows[:5] + [(906, rows[7][1]), (907, rows[7][1])]


@pytest.mark.parametrize("seed", [1, 2])
def test_repeats_against_brute_force(docs, seed, monkeypatch):
    rows = corpus(seed, 120)
    monkeypatch.setattr(substrings, "FREQUENT", 1 / 500)
    assert got(remove_repeats(docs(rows).repartition(4), window=8)) == brute(rows, 8)


def test_whole_documents(given):
    rows = [(r.doc_id, r.text) for r in given("documents").select("doc_id", "text").collect()]
    df = remove_repeats(given("documents"))
    assert got(df) == brute(rows, 50)
    assert set(df.columns) == {*given("documents").columns, "n_words", "n_removed", "kept_text"}


def test_equal_hashes_of_other_windows(monkeypatch):
    rows = corpus(4, 40)
    words = [WORD.findall(t or "") for _, t in rows]
    strings = [" ".join(w).encode() for w in words if len(w) >= 8]
    # an equal hash must not be taken for an equal window
    monkeypatch.setattr(substrings, "grams", lambda h, size: np.zeros(max(0, len(h) - size + 1), dtype=np.uint64))
    doc = np.arange(len(strings))
    n = np.array([len(s.split()) - 7 for s in strings])
    at, low, high = substrings._found(pa.array(strings, pa.binary()), doc, n, 8)
    gone = [set() for _ in strings]
    for i, a, b in zip(at, low, high):
        gone[i].update(range(a, b))
    want = brute([(int(i), s.decode()) for i, s in zip(doc, strings)], 8)
    assert sorted((i, len(g)) for i, g in enumerate(gone)) == sorted((d, r) for d, _, r, _ in want)


def test_empty_table_and_clashing_columns(docs):
    assert remove_repeats(docs([])).count() == 0
    df = docs([(1, "a b"), (2, "a b")]).selectExpr("*", "7 as n_words", "'x' as kept_text", "'y' as packed", "1 as doc", "2 as hash")
    row = remove_repeats(df, window=2).orderBy("doc_id").collect()[1]
    assert (row.n_words, row.n_removed, row.kept_text, row.packed, row.doc) == (2, 2, "", "y", 1)
    assert hashlib.sha256(row.kept_text.encode()).hexdigest().startswith("e3b0")


def test_thousands_of_equal_rows_take_time_in_proportion(docs):
    text = " ".join("w%d" % i for i in range(400))
    rows = [(7, text)] * 3000 + [(3, "x " + text[: len(text) // 2]), (9, text + " y"), (None, text), (None, text)]
    start = time.perf_counter()
    got = remove_repeats(docs(rows)).groupBy("doc_id", "n_words", "n_removed").count().collect()
    assert time.perf_counter() - start < 90
    first = len((text[: len(text) // 2]).split()) - 1  # its last word may be cut
    found = {(r.doc_id, r.n_words): (r.n_removed, r["count"]) for r in got}
    assert found[7, 400][1] == 3000 and abs(found[7, 400][0] - first) <= 1 and found[3, first + 2] == (0, 1)
    assert found[9, 401] == (400, 1) and found[None, 400] == (400, 2)


def test_buckets_and_slices_that_meet_in_memory_are_bounded():
    import pyarrow as pa

    from cohort_spark.llm import substrings

    assert substrings.MAP_BYTES <= 1 << 20
    one = lambda k: pa.RecordBatch.from_arrays([pa.array([k] * 100), pa.array([b"x" * 1000] * 100, pa.binary())], names=["bucket", "packed"])
    out = list(substrings._groups(iter([one(k // 2) for k in range(200)]), "bucket", substrings.BUCKET_BYTES))
    assert max(b.nbytes for b in out) <= 2.5 * (1 << 20)
    keys = [set(b.column("bucket").to_pylist()) for b in out]
    assert sum(map(len, keys)) == len(set().union(*keys)) == 100  # every bucket whole, in one batch
    assert sum(b.num_rows for b in out) == 20_000
