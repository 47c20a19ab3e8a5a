import random
import re
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohort_spark.llm import ngram_join
from cohort_spark.llm.ngram_join import first_shingles, least_shared, surplus
from tests.llm.test_near_dup import corpus

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[i : i + 4]) for i in range(len(words) - 3)} or ({tuple(words)} if words else set())


def brute(rows):
    """(doc, set size, component) of (doc, text) rows."""
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
            if 100 * both >= 85 * (len(sets[a]) + len(sets[b]) - both):
                parent[root(a)] = root(b)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[root(i)] = min(doc, least.get(root(i), doc))
    return sorted(((doc, len(sets[i]), None if doc is None else least[root(i)]) for i, (doc, _) in enumerate(rows)), key=repr)


def got(df):
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in df.collect()), key=repr)


@pytest.mark.parametrize(
    ("seed", "groups", "copies", "sizes"),
    [(1, 60, 6, {}), (2, 4, 120, {"TILE": 8, "GROUP_MEMBERS": 5, "QUERIES": 2}), (3, 5, 60, {"GROUP_TOKENS": 300, "FREQUENT": 2, "CELLS": 64}), (4, 40, 6, {"LEAST_KEYS": 9})],
)
def test_components_against_brute_force(docs, seed, groups, copies, sizes, monkeypatch):
    for name, value in sizes.items():  # cut groups and tiles, a full table of levels, no groups at all
        monkeypatch.setattr(ngram_join, name, value)
    rows = corpus(seed, groups, copies)
    assert got(ngram_join.ngram_join(docs(rows))) == brute(rows)


def edits(seed, words, copies, cut):
    """Texts around the threshold: each copy misses or swaps a share of the words."""
    rng = random.Random(seed)
    base = ["a%d" % rng.randrange(10**6) for _ in range(words)]
    out = [" ".join(base)]
    for _ in range(copies):
        n = rng.randint(0, cut)
        at = rng.randrange(words - n + 1)
        out.append(" ".join(base[:at] + ["b%d" % rng.randrange(10**6)] * rng.randint(0, 1) + base[at + n :]))
    return out


def test_links_at_the_threshold(docs, monkeypatch):
    monkeypatch.setattr(ngram_join, "STREAM_ROWS", 100)
    texts = [t for seed in range(12) for t in edits(seed, 8 + 9 * seed, 14, 2 + 2 * seed)]
    rows = list(enumerate(texts))
    assert got(ngram_join.ngram_join(docs(rows))) == brute(rows)


def test_passage_in_every_document(docs):
    rng = random.Random(7)
    passage = ["p%d" % i for i in range(40)]
    rows = []
    for i in range(300):
        own = ["w%d" % rng.randrange(10**7) for _ in range(rng.randint(1, 60))]
        at = rng.randrange(len(own) + 1)
        rows.append((i, " ".join(own[:at] + passage + own[at:])))
    assert got(ngram_join.ngram_join(docs(rows))) == brute(rows)


def test_frequent_shingles_come_last_whatever_their_hash(docs, monkeypatch):
    """Half of every text is one passage: its shingles lie in all groups, and none of them is among the first ones."""
    monkeypatch.setattr(ngram_join, "LEAST_KEYS", 16)  # no families: every class meets the others by the matrix alone
    rng = random.Random(11)
    passage = " ".join("p%d" % i for i in range(60))
    rows = [(i, passage + " " + " ".join("w%d" % rng.randrange(10**7) for _ in range(60))) for i in range(200)]
    rows += [(200 + i, rows[i][1] + " end") for i in range(20)]
    df = docs(rows)
    classes = ngram_join.sketches(df).withColumn("first_doc", F.col("doc_id"))
    groups = ngram_join.in_groups(classes)
    assert groups.select("gid").distinct().count() > 200
    matrix = ngram_join.matrix(df, groups, ngram_join.levels(df, 64), 64)
    assert matrix.groupBy("shingle").count().agg(F.max("count")).first()[0] < ngram_join.FREQUENT
    assert got(ngram_join.ngram_join(df)) == brute(rows)


def test_repeated_rows_clashing_columns_and_empty_table(docs):
    text = " ".join("w%d" % i for i in range(30))
    rows = [(1, text)] * 200 + [(2, text + " x"), (2, "lone words here"), (3, ""), (4, None), (None, text), (None, None)]
    df = docs(rows).selectExpr("*", "'x' as ref", "1 as gid", "2 as set_id", "3 as keys", "4 as __tile", "5 as role", "6 as component_id")
    assert got(ngram_join.ngram_join(df)) == brute(rows)
    assert ngram_join.ngram_join(docs([])).count() == 0 and ngram_join.ngram_join(docs([(1, None), (2, " ")])).count() == 2


def test_one_very_long_text(docs):
    rng = random.Random(3)
    words = ["w%d" % rng.randrange(10**6) for _ in range(300_000)]
    rows = [(1, " ".join(words)), (2, " ".join(words[:280_000])), (3, " ".join(words[:200_000])), (4, "short one of five words")]
    assert got(ngram_join.ngram_join(docs(rows))) == brute(rows)


def test_first_shingles_meet():
    """Sets that link share ``surplus`` of the smaller set's size among their first shingles, in any order of them."""
    rng = np.random.default_rng(2)
    for _ in range(400):
        n = int(rng.integers(1, 120))
        a = rng.permutation(1000)[:n]
        b = np.concatenate([a[rng.random(n) < 0.95], 1000 + np.arange(rng.integers(0, 1 + n // 12))])
        both = len(np.intersect1d(a, b))
        if 100 * both < 85 * (len(a) + len(b) - both):
            continue
        order = rng.permutation(2000)
        heads = [x[np.argsort(order[x])][: first_shingles(len(x))] for x in (a, b)]
        assert both >= least_shared(max(len(a), len(b)))
        assert len(np.intersect1d(*heads)) >= surplus(min(len(a), len(b)))
