import os
import random
import zlib

import pytest

from cohort_spark.llm import toxicity
from cohort_spark.llm.toxicity import Compressors, classify, drop_toxic

LABELS = "doc_id bigint, quality int, toxic int"
BAD = ["vexling", "grobnak", "skorth", "plimdur"]


@pytest.fixture
def labels(spark):
    return lambda rows: spark.createDataFrame([(i, 1, t) for i, t in rows], LABELS)


def corpus(n):
    rng = random.Random(5)
    syllables = ["ta", "ren", "so", "mi", "lor", "an", "de", "pu"]
    word = lambda: "".join(rng.choice(syllables) for _ in range(rng.randint(1, 4)))
    rows, toxic = [], {}
    for i in range(n):
        words = [word() for _ in range(rng.randint(20, 200))]
        toxic[i] = int(i % 4 == 0)
        if toxic[i]:
            for _ in range(5):
                words.insert(rng.randrange(len(words)), rng.choice(BAD))
        rows.append((i, " ".join(words)))
    return rows, toxic


def test_held_out_accuracy_on_planted_words(docs, labels):
    rows, toxic = corpus(900)
    odd = [(5000, None), (5001, ""), (5002, " \n"), (5003, "x " * 30_000), (None, "word"), (5004, "grobnak " * 20), (5004, "ta ren so")]
    known = [(i, t) for i, t in toxic.items()] + [(0, None), (1, 0), (None, 1), (3, 7)]
    got = classify(docs(rows + odd), labels(known)).collect()
    assert len(got) == len(rows) + len(odd)
    for r in got:
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7)
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
    held = [r for r in got if r.held_out and r.doc_id in toxic]
    bad, good = ([r.score for r in held if toxic[r.doc_id] == t] for t in (1, 0))
    assert min(len(bad), len(good)) > 50
    assert sum((b > g) + 0.5 * (b == g) for b in bad for g in good) >= 0.97 * len(bad) * len(good)
    found = [toxic[r.doc_id] for r in held if r.predicted]
    assert sum(found) >= 0.95 * len(found) and sum(found) >= 0.7 * len(bad)
    kept = drop_toxic(docs(rows + odd), labels(known))
    assert kept.columns == docs([]).columns
    assert sorted(map(repr, (tuple(r)[:2] for r in kept.collect()))) == sorted(
        repr((r.doc_id, t)) for r, (_, t) in zip(got, rows + odd) if not r.predicted
    )


def test_only_usable_labels_and_texts_enter(docs, labels):
    rows, toxic = corpus(300)
    flipped = [(i, 1 - t if zlib.crc32(str(i).encode()) % 3 == 1 else t) for i, t in toxic.items()]
    score = lambda known: {r.doc_id: r.score for r in classify(docs(rows), labels(known)).collect()}
    assert score(flipped) == score(list(toxic.items()))


def test_without_labels_or_rows(docs, labels):
    assert [r.score for r in classify(docs([(1, "a"), (2, None)]), labels([])).collect()] == [0.0, 0.0]
    assert classify(docs([]), labels([(1, 1), (3, 0)])).count() == 0
    assert drop_toxic(docs([]), labels([])).columns == docs([]).columns


def test_dictionaries_save_bytes_on_their_own_words():
    pair = Compressors(b" common words grobnaking ", b" common words ordinary.. ")
    assert pair.saved(b" grobnaking here ") > 0 > pair.saved(b" ordinary.. here ")
    assert pair.saved(b" common words ") == 0
    n = 4 + toxicity.STEPS
    text = "grobnaking common " * 7
    features = pair.features(text)
    assert features[0] == 14 and features[n] == 6 and len(features) == 2 * n
    assert features[4] == sum(pair.saved(b" " + w.encode() + b" ") >= 1 for w in text.split())


@pytest.mark.parametrize("length", range(3, 13))
def test_short_words_are_seen_at_every_place_of_a_window(length):
    rng = random.Random(length)
    word = lambda n: bytes(rng.choice(b"abcdefghijklmnopqrstuvwxyz") for _ in range(n))
    common = [word(rng.randint(2, 9)) for _ in range(500)]
    bad = sorted({word(length) for _ in range(40)})
    counts = {w: (200 - i // 4, 0) for i, w in enumerate(common)} | {w: (0, 50 - i) for i, w in enumerate(bad)}
    pair = toxicity.dictionaries(counts, 600)
    assert len(pair.toxic) == len(pair.ordinary)
    assert pair.saved(b" " + bad[0] + b" ") > 0  # the most frequent one ends its dictionary
    assert sum(pair.saved(b" " + w + b" ") > 0 for w in bad) >= 0.9 * len(bad)
    for place in range(toxicity.WINDOW):
        windows = [[rng.choice(common) for _ in range(toxicity.WINDOW)] for _ in bad]
        for window, w in zip(windows, bad):
            window[place] = w
        seen = [pair._savings(toxicity.framed(window), toxicity.WINDOW, 1)[0] > 0 for window in windows]
        assert sum(seen) >= 0.85 * len(bad), place
    assert sum(pair.saved(b" " + w + b" ") > 0 for w in common) <= 0.05 * len(common)


def test_every_word_lies_in_two_windows():
    def windows(words, size, step):
        text = toxicity.framed(words)
        return [text.body[a:b] for a, b in zip(*text.windows(size, step))]

    words = [b"%d" % i for i in range(15)]
    assert [w.split() for w in windows(words, 4, 2)] == [words[i : i + 4] for i in (0, 2, 4, 6, 8, 10, 11)]
    assert windows(words, 3, 1) == [b" %b  %b  %b " % w for w in zip(words, words[1:], words[2:])]
    assert windows(words, 1, 1) == [b" %b " % w for w in words]
    assert [[w.split() for w in windows(words[:n], 4, 2)] for n in range(5)] == [[[]], [words[:1]], [words[:2]], [words[:3]], [words[:4]]]


def test_only_windows_without_a_match_are_passed_over():
    rng = random.Random(6)
    word = lambda n: bytes(rng.choice(b"abcdefghijklmnopqrstuvwxyz") for _ in range(n))
    common, bad = [word(rng.randint(2, 9)) for _ in range(500)], sorted({word(rng.randint(3, 10)) for _ in range(200)})
    counts = {w: (200 - i // 4, 0) for i, w in enumerate(common)} | {w: (0, 300 - i) for i, w in enumerate(bad)}
    pair = toxicity.dictionaries(counts, 600)
    words = [rng.choice(bad if rng.random() < 0.2 else common) for _ in range(3000)]
    text = toxicity.framed(words)
    for size in (1, 4):
        saved = pair._savings(text, size, 1)
        for i, (a, b) in enumerate(zip(*text.windows(size, 1))):
            if saved[i]:
                assert saved[i] == pair.saved(text.body[a:b])
            elif any(w in bad for w in words[i : i + size]):
                assert pair.saved(text.body[a:b]) == 0  # compressed, and equally long


def test_windows_of_strings_that_ordinary_text_has_too_are_not_compressed():
    rng = random.Random(7)
    word = lambda n: bytes(rng.choice(b"abcdefghijklmnopqrstuvwxyz") for _ in range(n))
    common = [word(rng.randint(6, 9)) for _ in range(500)]
    bad = sorted({w[:5] + word(4) for w in common[:200]})
    counts = {w: (200 - i // 4, 0) for i, w in enumerate(common)} | {w: (0, 300 - i) for i, w in enumerate(bad)}
    pair = toxicity.dictionaries(counts, 600)
    toxic, other = pair._both()
    inputs = []
    pair.made[0] = lambda window: inputs.append(window) or toxic(window)
    text = toxicity.framed([rng.choice(common[:200]) for _ in range(1000)])
    pair._savings(text, toxicity.WINDOW, 1)
    assert len(inputs) <= 500  # of 997
    inputs.clear()
    pair._savings(toxicity.framed(bad), toxicity.WINDOW, 1)
    assert len(inputs) == len(bad) - toxicity.WINDOW + 1  # of each window with bad words


def test_segments_are_cut_by_bytes_alone(monkeypatch):
    counts = {b"common%03d" % i: (90, 0) for i in range(50)} | {b"segment%04d" % i: (0, 2000 - i) for i in range(1500)}
    assert all(b" segment%04d " % i in toxicity.dictionaries(counts, 600).toxic for i in range(1500))
    monkeypatch.setattr(toxicity, "SEGMENT_BYTES", 150)
    pair = toxicity.dictionaries(counts, 600)
    assert pair.toxic[len(os.path.commonprefix([pair.toxic, pair.ordinary])) :].count(b"segment") == 10


def test_repeated_rows_count_once(docs, labels):
    rows, toxic = corpus(300)
    score = lambda rows: {r.doc_id: r.score for r in classify(docs(rows), labels(list(toxic.items()))).collect()}
    assert score(rows + rows[:30] * 20) == pytest.approx(score(rows))


def test_a_score_column_of_its_own_is_replaced(docs, labels):
    rows, toxic = corpus(120)
    df = docs(rows).selectExpr("*", "5.0 as score", "1 as toxic", "2 as weight", "3 as train", "4 as held_out", "'r' as row")
    assert classify(df, labels(list(toxic.items()))).columns == ["doc_id", "held_out", "score", "predicted"]
    assert drop_toxic(df, labels(list(toxic.items()))).columns == df.columns


def test_real_labels(given):
    got = classify(given("documents"), given("labels"))
    assert got.count() == given("documents").count()
