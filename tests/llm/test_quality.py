import random
import re
from collections import Counter

from pyspark.sql import functions as F

from cohort_spark.llm import quality
from tests.llm.conftest import DOCS

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def measures(text):
    text = text or ""
    words = WORD.findall(text)
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    covered = {i + k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (
        len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered), len(lines),
    )


def texts():
    rng = random.Random(2)
    vocabulary = ["a", "the", "é", "日本", "x#y", "$$$", "b", "c|d", "<e>", "word"]
    out = [None, "", " \n ", "a b c", "a b c a b c", "a a a a", "a a a", "a b\na b\n\n \na b ", "x " * 4000, "one\rtwo\x0bthree\x0cfour\tfive", "\n\n"]
    for _ in range(200):
        words = [rng.choice(vocabulary[: rng.randint(2, 10)]) for _ in range(rng.randint(0, 120))]
        out.append("".join(w + rng.choice([" ", " ", "  ", "\n", "\t"]) for w in words))
    return out + [" ".join(f"u{i}" for i in range(70_000)) + " u1 u2 u3"]


def bucket(v):
    shift = max(0, v.bit_length() - 5)
    return v >> shift << shift


def cutoffs(rows, keys):
    """Cutoffs per group of ``keys`` from sorted bucket edges."""
    groups = {}
    for r in rows:
        n_words, chars, symbols, dup, repeat, lines = r["m"]
        if n_words:
            for m, v in zip(
                quality.MEASURES,
                [1000 * symbols // chars, 100 * chars // n_words, 100 * chars // n_words, 1000 * repeat // n_words, 1000 * dup // max(lines, 1)],
            ):
                groups.setdefault((tuple(r[k] for k in keys), m), []).append(bucket(v))
    out = {}
    for (key, m), values in groups.items():
        values.sort()
        at = lambda q, values=values: next(v for i, v in enumerate(values) if i + 1 >= q * len(values))
        reach = max(m.reach * abs(at(m.quantile) - at(0.5)), m.slack)
        out[key, m.name] = (len(values), at(m.quantile) + (reach if m.upper else -reach))
    return out


def test_measures_against_brute_force(docs):
    rows = list(enumerate(texts()))
    columns = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines"]
    got = {r.doc_id: tuple(r[c] for c in columns) for r in quality.measure(docs(rows)).collect()}
    for i, text in rows:
        assert got[i] == measures(text), repr(text)[:200]


def test_verdicts_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(quality, "LEAST_TEXTS", 8)
    rng = random.Random(4)
    base = texts()
    rows = []
    for i in range(260):
        text = " ".join(rng.choice(base) or "" for _ in range(rng.randint(1, 3)))
        if rng.random() < 0.3:
            text = " ".join(f"w{rng.randint(0, 999)}" for _ in range(rng.randint(40, 90)))
        rows.append({"doc_id": i, "text": text[:9000], "lang": rng.choice(["en", "de", None, "xx"]) if i else "solo", "source": rng.choice(["s", "t", None])})
    for r in rows:
        r["m"] = measures(r["text"])
    df = spark.createDataFrame([(r["doc_id"], r["text"], r["lang"], r["source"], 0) for r in rows], DOCS)
    own, lang, every = cutoffs(rows, ["lang", "source"]), cutoffs(rows, ["lang"]), cutoffs(rows, [])
    assert any(n < 8 for n, _ in own.values()) and any(n >= 8 for n, _ in own.values())
    for r in quality.judge(df).collect():
        mine = rows[r.doc_id]
        n_words, chars, symbols, dup, repeat, lines = mine["m"]
        assert r.base_failed == (n_words < 50 or 100 * repeat > 50 * n_words)
        kept = not r.base_failed
        values = [1000 * symbols // max(chars, 1), 100 * chars // max(n_words, 1), 100 * chars // max(n_words, 1), 1000 * repeat // max(n_words, 1), 1000 * dup // max(lines, 1)]
        for m, v in zip(quality.MEASURES, values):
            if kept:
                levels = [own[(mine["lang"], mine["source"]), m.name], lang[(mine["lang"],), m.name], every[(), m.name]]
                cut = next(c for n, c in levels if n >= 8)
                kept = v <= cut if m.upper else v >= cut
        assert r.kept == kept, mine
    good = quality.keep_good(df)
    assert good.columns == df.columns
    assert {r.doc_id for r in good.collect()} == {r.doc_id for r in quality.judge(df).where("kept").collect()}


def test_sketches_merge_to_the_sketch_of_all_rows(docs):
    measured = quality.measure(docs(list(enumerate(texts()))))
    left, right = measured.where("doc_id % 2 = 0"), measured.where("doc_id % 2 = 1")
    keys = ["lang", "source", "measure", "bucket"]
    merged = quality.sketches(left).union(quality.sketches(right)).groupBy(*keys).agg(F.sum("n").alias("n"))
    assert sorted(map(tuple, merged.collect())) == sorted(map(tuple, quality.sketches(measured).collect()))


def test_good_documents_stay(given):
    labels = given("labels").where("quality = 1")
    judged = quality.judge(given("documents")).where("not base_failed").join(labels, "doc_id")
    assert judged.where("not kept").count() <= 0.01 * judged.count()


def test_empty_table_and_clashing_columns(docs):
    assert quality.judge(docs([])).count() == 0 and quality.keep_good(docs([])).count() == 0
    df = docs([(1, "a " * 60), (None, None)]).selectExpr("*", "1 as w", "2 as p", "'x' as kept", "3 as n_words")
    assert quality.judge(df).count() == 2 and quality.keep_good(df).count() == 0
