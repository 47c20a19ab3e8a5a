import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given as drawn
from hypothesis import settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from cohort_spark.llm import packing, token_files
from cohort_spark.llm.packing import best_filling, pack_documents, plan_fillings
from cohort_spark.llm.perfect_hash import PerfectHash
from cohort_spark.llm.tokens import VOCABULARY, Encoder, encoder

LIBRARY = Tokenizer.from_file(public_tokenizers.path(VOCABULARY))
ODD = [
    None, "", " \n\t", "Hello, WORLD!! don't 'tis dogs' ('re) it's", "a\x0bb\x0cc\rd\x1ce\x85f\xa0g", "École ÉTÉ café. é!", "x" * 5000,
    "<|endoftext|> the<|startoftext|>end", "İstanbul ΣΑΣ ß. straße, 12.5% $$$ ###!!", "日本語 テスト。 mixed漢字,", "́ start ‍ zero", "n° 5 ª º ² don.'s", "a" * 3 + " word" * 4000,
]


def ids_of(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids + [1]


def crc(ids):
    return zlib.crc32(np.array(ids, dtype="<u4").tobytes())


def test_cached_words_give_the_ids_of_whole_texts(given):
    small = Encoder(public_tokenizers.path(VOCABULARY), most=7)  # the cache turns over all the time
    for text in ODD + [r.text for r in given("documents").select("text").collect()]:
        want = ids_of(text)[:-1]
        for coder in (encoder(), small):
            assert np.frombuffer(coder.ids((text or "").encode()), "<u4").tolist() == want


@settings(max_examples=300, deadline=None)
@drawn(st.text(alphabet=st.characters(codec="utf-8", exclude_categories=["Cs"]), max_size=40) | st.text(alphabet="aAé'sRe,.! 1\n<|", max_size=30))
def test_any_text(text):
    assert np.frombuffer(encoder().ids(text.encode()), "<u4").tolist() == ids_of(text)[:-1]


def test_files_round_trip(spark, docs, given, tmp_path):
    rows = [(i, t) for i, t in enumerate(ODD)] + [(3, "again"), (3, "again"), (None, "no key"), (None, None), (-9, "minus")]
    rows += [(100 + r.doc_id, r.text) for r in given("documents").select("doc_id", "text").collect()]
    folder = str(tmp_path / "files")
    manifest = token_files.write_token_files(docs(rows), folder, shards=5)
    got = [tuple(r) for r in token_files.read_token_files(manifest, folder).orderBy("start").collect()]
    want = sorted((i is not None, i or 0, len(ids_of(t)), crc(ids_of(t))) for i, t in rows)
    assert sorted((i is not None, i or 0, n, c) for i, _, n, c in got) == want
    assert [(i is not None, i or 0) for i, *_ in got] == [(a, b) for a, b, *_ in want]
    total = 0
    for _, start, n, _ in got:
        assert start == total
        total += n
    asked = token_files.fetch(manifest, folder, [3, 5, 10**6, 10**12])
    assert sorted(asked) == sorted([(3, ids_of(ODD[3])), (3, ids_of("again")), (3, ids_of("again")), (5, ids_of(ODD[5]))])
    empty = token_files.token_table(docs([]), str(tmp_path / "none"), 3)
    assert empty.count() == 0 and empty.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]


def test_perfect_hash_numbers_every_key_once():
    keys = np.unique(np.random.default_rng(1).integers(-(2**63), 2**63 - 1, 20_000))
    made = PerfectHash.build(keys)
    assert sorted(made.find(keys).tolist()) == list(range(len(keys)))
    assert (made.find(np.arange(5000)) < 0).all()
    assert len(PerfectHash.build(keys[:0]).find(keys[:3])) == 3


def check_packing(rows, want, capacity):
    by_doc, by_seq = {}, {}
    for r in rows:
        by_doc.setdefault((r.doc_id, r.doc_tokens), []).append(r)
        by_seq.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert sum(r.length for r in rows) == sum(map(len, want))
    assert Counter((r.start, r.length, r.ids_crc32, r.doc_tokens) for r in rows) == Counter(
        (s, len(ids[s : s + capacity]), crc(ids[s : s + capacity]), len(ids)) for ids in want for s in range(0, len(ids), capacity)
    )
    for parts in by_seq.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    assert sorted(by_seq) == list(range(len(by_seq)))
    return len(by_seq)


@pytest.mark.parametrize("capacity", [2048, 64])
def test_packing_places_every_id_once(docs, given, capacity):
    rows = [(i, t) for i, t in enumerate(ODD)] + [(3, ODD[3]), (None, "x y z"), (7, "x y z"), (7, "x y z")]
    rows += [(100 + r.doc_id, r.text) for r in given("documents").select("doc_id", "text").collect()]
    want = [ids_of(t) for _, t in rows]
    got = pack_documents(docs(rows), capacity).collect()
    used = check_packing(got, want, capacity)
    assert used <= -(-sum(map(len, want)) // capacity) + 2  # next to no padding
    assert pack_documents(docs([])).count() == 0


def test_ranks_go_on_over_salted_parts(docs, monkeypatch):
    monkeypatch.setattr(packing, "RANK_ROWS", 3)
    rows = [(i, "same words here") for i in range(700)]
    check_packing(pack_documents(docs(rows), 16).collect(), [ids_of(t) for _, t in rows], 16)


def test_ids_can_be_carried(docs):
    rows = [(1, "hello world " * 50), (2, None)]
    got = pack_documents(docs(rows), 32, with_ids=True).orderBy("doc_id", "start").collect()
    for doc, text in rows:
        assert b"".join(bytes(r.ids) for r in got if r.doc_id == doc) == np.array(ids_of(text), "<u4").tobytes()


def test_filling_is_the_best_subset_sum():
    rng = random.Random(3)
    for _ in range(200):
        counts = {rng.randint(1, 30): rng.randint(1, 4) for _ in range(rng.randint(0, 6))}
        room = rng.randint(0, 60)
        sums = {0}
        for length, n in counts.items():
            sums = {s + length * k for s in sums for k in range(n + 1)}
        got = best_filling(counts, room)
        assert all(got[x] <= counts[x] for x in got)
        assert sum(x * n for x, n in got.items()) == max(s for s in sums if s <= room)


def test_plan_uses_every_piece():
    rng = random.Random(5)
    for _ in range(50):
        histogram = {rng.randint(1, 100): rng.randint(1, 1000) for _ in range(20)}
        plan = plan_fillings(histogram, 100)
        used = Counter()
        for f in plan:
            assert sum(x * n for x, n in f.pieces.items()) <= 100
            for x, n in f.pieces.items():
                used[x] += n * f.times
        assert used == Counter(histogram)
        assert sum(f.times for f in plan) <= -(-sum(x * n for x, n in histogram.items()) // 100) * 1.6 + 2
