import random
import re
from itertools import combinations

import numpy as np
import pytest

from cohort_spark.llm import near_dup
from cohort_spark.llm.components import components
from cohort_spark.llm.near_dup import drop_near_duplicates, forest, near_duplicates, shared_counts

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} or ({tuple(words)} if words else set())


def brute(rows):
    """(doc, set size, component, kept) of (doc, text) rows with distinct ids."""
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in combinations(range(len(rows)), 2):
        if rows[a][0] is not None and rows[b][0] is not None and sets[a] and sets[b]:
            both = len(sets[a] & sets[b])
            if 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                parent[root(a)] = root(b)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[root(i)] = min(doc, least.get(root(i), doc))
    out = []
    for i, (doc, _) in enumerate(rows):
        component = None if doc is None else least[root(i)]
        out.append((doc, len(sets[i]), component, doc is None or doc == component))
    return sorted(out, key=repr)


def got(df):
    return sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in df.collect()), key=repr)


def corpus(seed, groups, copies):
    rng = random.Random(seed)
    vocabulary = ["W%d" % i for i in range(500)] + ["Éa", "日本"]
    line = [rng.choice(vocabulary) for _ in range(12)]
    rows = []
    for _ in range(groups):
        base = [rng.choice(vocabulary) for _ in range(rng.randint(1, 90))]
        for _ in range(rng.randint(1, copies)):
            words = list(base)
            for _ in range(rng.randint(0, max(1, len(base) // 18))):
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
            words = line + words if rng.random() < 0.3 else words
            text = rng.choice([" ", "\n", " \t"]).join(w.lower() if rng.random() < 0.1 else w for w in words)
            rows.append((rng.randint(0, 10**12), text))
    rows += [(-5, None), (-4, ""), (-3, " \n"), (-2, "one"), (-1, "One"), (-6, "one two"), (None, rows[0][1]), (None, None)]
    return rows


@pytest.mark.parametrize(("seed", "groups", "copies", "tile"), [(1, 60, 6, 1024), (2, 4, 120, 32), (3, 4, 60, 17)])
def test_components_against_brute_force(docs, seed, groups, copies, tile, monkeypatch):
    monkeypatch.setattr(near_dup, "TILE", tile)  # large groups are cut into pairs of blocks
    rows = corpus(seed, groups, copies)
    assert got(near_duplicates(docs(rows))) == brute(rows)


def test_whole_documents(given):
    rows = [(r.doc_id, r.text) for r in given("documents").select("doc_id", "text").collect()]
    assert got(near_duplicates(given("documents"))) == brute(rows)


def test_stream_of_tiles_is_cut_between_them(docs, monkeypatch):
    monkeypatch.setattr(near_dup, "STREAM_ROWS", 3)
    rows = corpus(5, 30, 8)
    assert got(near_duplicates(docs(rows))) == brute(rows)


def test_repeated_ids_and_empty_table(docs):
    text = " ".join("w%d" % i for i in range(30))
    other = " ".join("v%d" % i for i in range(30))
    rows = [(1, text), (1, other), (2, text), (2, "lone words here"), (3, other), (3, other), (1, text)]
    kept = drop_near_duplicates(docs(rows)).select("doc_id", "text").collect()
    assert sorted(map(tuple, kept)) == sorted([(1, text), (1, text), (1, other), (2, "lone words here")])
    assert near_duplicates(docs([])).count() == 0 and drop_near_duplicates(docs([])).count() == 0
    df = docs(rows).selectExpr("*", "'x' as text_hash", "1 as key", "2 as component", "3 as __n", "4 as kept")
    assert drop_near_duplicates(df).columns == df.columns and drop_near_duplicates(df).count() == 4


def test_components_of_a_long_path(spark):
    edges = [(bytes([0, i]), bytes([0, i + 1])) for i in range(60)] + [(b"\x01a", b"\x01a"), (b"\x01b", b"\x01c")] * 2
    got = {bytes(r.node): bytes(r.component) for r in components(spark.createDataFrame(edges, "u binary, v binary")).collect()}
    assert got == {bytes([0, i]): b"\x00\x00" for i in range(61)} | {b"\x01b": b"\x01b", b"\x01c": b"\x01b"}


def test_intersections_and_forest():
    rng = np.random.default_rng(4)
    sets = [np.unique(rng.integers(0, 60, rng.integers(1, 50))).astype(np.uint64) for _ in range(40)]
    want = [[len(set(a.tolist()) & set(b.tolist())) for b in sets] for a in sets]
    got = shared_counts(sets)
    off = ~np.eye(len(sets), dtype=bool)
    assert (got[off] == np.array(want)[off]).all()
    linked = rng.random((50, 50)) < 0.02
    linked |= linked.T
    stars = forest(linked)
    parent = {x: r for r, x in stars}
    for a, b in zip(*np.nonzero(linked)):
        if a != b:
            assert parent.get(a, a) == parent.get(b, b)
