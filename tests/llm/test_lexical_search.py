import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from cohort_spark.llm import lexical_search
from cohort_spark.llm.lexical_search import Best, Items, grown, ranked_search, search

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items, k=10):
    found = [(doc, Counter(terms(t)), len(terms(t))) for doc, t in docs]
    found = [d for d in found if d[2]]
    total, df = sum(n for _, _, n in found), Counter(t for _, c, _ in found for t in c)
    out = []
    for item, text in items:
        scores = []
        for doc, counts, n in found:
            m = 100 - 75 + (75 * n * len(found)) // total
            score = 0
            for t in terms(text):
                if t in counts:
                    weight = math.floor(1000 * math.log((2 * len(found) + 2) / (2 * df[t] + 1)))
                    score += weight * ((10**9 * counts[t]) // (1000 * counts[t] + 8 * m))
            if score > 0 and doc is not None:
                scores.append((-score, doc))
        out += [(item, rank, doc, -score) for rank, (score, doc) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out, key=repr)


def got(df):
    return sorted(((r.item_id, r["rank"], r.doc_id, r.score) for r in df.collect()), key=repr)


def corpus(seed, rows):
    rng = random.Random(seed)
    vocabulary = ["W%d" % i for i in range(60)] + ["Éa", "日本", "x1", "don't", "a_b", "q" * 300]
    texts = []
    for _ in range(rows):
        topic = rng.sample(vocabulary, 8)
        words = [rng.choice(topic if rng.random() < 0.7 else vocabulary) for _ in range(rng.randint(0, 60))]
        texts.append(rng.choice([" ", "\n", ", ", "--"]).join(words))
    return texts


@pytest.fixture
def items(spark):
    return lambda rows: spark.createDataFrame(rows, "item_id bigint, text string")


@pytest.mark.parametrize("sizes", [{}, {"LEAF": 2, "TREE_DOCS": 16}, {"LEAF": 1, "TREE_ENTRIES": 40}, {"BLOCK_TERMS": 30}])
def test_ranking_against_brute_force(docs, items, sizes, monkeypatch):
    for name, value in sizes.items():
        monkeypatch.setattr(lexical_search, name, value)
    texts = corpus(3, 160)
    rows = [(i * 7919 % 1000, t) for i, t in enumerate(texts + texts[:40])]  # copies tie
    asked = [(i, t) for i, t in enumerate(corpus(4, 12) + ["w1", "w1 w1 W1 zzz", "日本", "none of these", "", None, "!!! --"])]
    assert got(ranked_search(docs(rows), items(asked))) == brute(rows, asked)


def test_whole_tables(given):
    documents = [(r.doc_id, r.text) for r in given("documents").select("doc_id", "text").collect()]
    benchmark = [(r.item_id, r.text) for r in given("benchmark").select("item_id", "text").collect()]
    assert got(ranked_search(given("documents"), given("benchmark"))) == brute(documents, benchmark)


def test_nulls_repeats_clashing_columns_and_empty_tables(docs, items):
    rows = [(1, "red fox")] * 30 + [(2, "red red dog"), (3, None), (4, ""), (None, "red fox fox"), (5, "dog")]
    asked = [(1, "fox red"), (1, "fox red"), (2, "dog"), (None, "dog")]
    clash = docs(rows).selectExpr("*", "1 as n", "2 as term", "3 as tf", "4 as score", "5 as item_id", "6 as rank")
    more = items(asked).selectExpr("*", "1 as terms", "2 as part", "3 as doc_id", "4 as score", "5 as rank")
    assert got(ranked_search(clash, more)) == brute(rows, asked)
    assert ranked_search(docs([]), items(asked)).count() == 0
    assert ranked_search(docs(rows), items([])).count() == 0
    assert ranked_search(docs(rows), items([(1, None), (2, " ")])).count() == 0


def test_one_very_long_text(docs, items):
    rng = random.Random(1)
    rows = [(1, " ".join("w%d" % rng.randrange(5000) for _ in range(400_000))), (2, "w1 w2"), (3, "w7")]
    asked = [(1, "w1 w2 w3"), (2, " ".join("w%d" % i for i in range(3000)))]
    assert got(ranked_search(docs(rows), items(asked))) == brute(rows, asked)


def test_bounds_hold_and_prune():
    rng = np.random.default_rng(6)
    size, docs = 400, 1200
    topic = rng.integers(0, 8, docs)
    texts = [np.unique(rng.integers(0, 50, 30) + 50 * t) for t in range(8)]
    rows = [texts[t] for t in topic]  # documents of a topic differ in their weights alone
    first = np.cumsum([0] + [len(r) for r in rows])
    term = np.concatenate(rows)
    weight = 10**10 + rng.integers(1, 10**8, len(term))
    asked = [np.unique(rng.integers(0, 50, 6) + 50 * t) for t in range(8)]
    items = Items(list(range(8)), np.arange(size, dtype=np.uint64), np.cumsum([0] + [len(a) for a in asked]), np.concatenate(asked), rng.integers(1, 4, sum(map(len, asked))))
    tree = grown(np.arange(docs), first, term, weight, items)
    dense = np.zeros((docs, size), dtype=np.int64)
    for i in range(docs):
        dense[i, tree.term[tree.first[i] : tree.first[i + 1]]] = tree.weight[tree.first[i] : tree.first[i + 1]]
    queries = np.zeros((8, size), dtype=np.int64)
    for i in range(8):
        queries[i, asked[i]] = items.count[items.first[i] : items.first[i + 1]]
    scores = dense @ queries.T

    def holds(node):
        assert (scores[node.begin : node.end].max(axis=0) <= node.bounds).all()
        return 1 + sum(holds(c) for c in node.children)

    nodes = holds(tree.root)
    best = Best(8, 10)
    opened = search(tree, items, best)
    leaves = (nodes + 1) // 2
    assert opened < 8 * leaves // 2  # the trees do spare work where documents have topics
    for i in range(8):
        want = sorted(((int(s), -int(d)) for s, d in zip(scores[:, i], tree.ids)), reverse=True)[:10]
        assert sorted(best.heaps[i], reverse=True) == want
