import random
import zlib

import numpy as np
import public_tokenizers
import sentencepiece
from hypothesis import given as drawn
from hypothesis import settings
from hypothesis import strategies as st

from cohort_spark.llm import sentencepiece_model as module
from cohort_spark.llm.sentencepiece_model import VOCABULARY, DoubleArray, Pieces, pieces, round_trip

ODD = [
    None, "", " ", "  ", "Hello  world \n\tab", "a\rb\r\n", "▁x ▁▁", "日本語テスト 😀!", "x" * 3000, "naïve café", "end  ", "\n\n", "\x00\x01",
    "1234567890 $%^ <0x41> <s> </s> <unk>", "ÿ̀ ́", "word " * 5000,
]


def ids(data):
    return np.frombuffer(data, "<u4").tolist()


def brute(model, text):
    """Viterbi over the whole text, piece by piece: (ids, sum of scores)."""
    if not text:
        return [], 0.0
    data = b" " + text.replace("▁", "\x00MARK\x00").encode().replace(b"\x00MARK\x00", b"\xff")
    known = {s: i for i, s in enumerate(model.surfaces) if s and i not in set(model.byte_ids.tolist())}
    best = [(0, None, 0)] + [(-(1 << 62), None, 0)] * len(data)
    for i in range(len(data)):
        if best[i][0] == -(1 << 62) or (0x80 <= data[i] < 0xC0):
            continue
        end = i + 1
        while end < len(data) and 0x80 <= data[end] < 0xC0:
            end += 1
        if best[i][0] + model.unknown > best[end][0]:
            best[end] = (best[i][0] + model.unknown, None, i)
        for n in range(1, model.longest + 1):
            number = known.get(data[i : i + n]) if i + n <= len(data) else None
            if number is not None and best[i][0] + model.scores[number] > best[i + n][0]:
                best[i + n] = (best[i][0] + model.scores[number], number, i)
    out, at = [], len(data)
    while at:
        _, number, i = best[at]
        out[:0] = [number] if number is not None else [int(model.byte_ids[c]) for c in data[i:at].replace(b"\xff", "▁".encode())]
        at = i
    return out, best[-1][0]


def test_against_viterbi_over_whole_texts(given):
    model = pieces()
    texts = [t for t in ODD if t is not None and len(t) < 300] + [r.text[:400] for r in given("documents").limit(12).collect()]
    for text, got in zip(texts, model.encode([t.encode() for t in texts])):
        want, _ = brute(model, text)
        assert ids(got) == want, text


@settings(max_examples=60, deadline=None)
@drawn(st.lists(st.text(alphabet=st.characters(codec="utf-8", exclude_categories=["Cs"]) | st.sampled_from(" ▁\n\r\tab"), max_size=30), max_size=5))
def test_any_texts_come_back(texts):
    model = pieces()
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(VOCABULARY))
    for text, got in zip(texts, model.encode([t.encode() for t in texts])):
        assert model.decode(got).decode() == text
        assert ids(got) == brute(model, text)[0]
        if "▁" not in text and "\x00" not in text:
            assert library.decode(ids(got)) == text


def test_small_models_and_blocks(monkeypatch):
    monkeypatch.setattr(module, "BATCH_UNITS", 3)
    monkeypatch.setattr(module, "CACHED_UNITS", 5)
    rng = random.Random(2)
    for _ in range(30):
        words = {"".join(rng.choice("ab c") for _ in range(rng.randint(1, 4))).encode() for _ in range(12)} | {b"a", b" "}
        surfaces = [bytes([i]) for i in range(256)] + sorted(words)
        normal = np.arange(len(surfaces)) >= 256
        scores = np.array([0.0] * 256 + [-rng.randint(1, 40) / 7 for _ in words])
        model = Pieces(surfaces, scores, normal, np.arange(256))
        texts = ["".join(rng.choice("aabbc d\n") for _ in range(rng.randint(0, 25))) for _ in range(20)]
        for text, got in zip(texts, model.encode([t.encode() for t in texts])):
            assert ids(got) == brute(model, text)[0]
            assert model.decode(got).decode() == text


def test_trie_holds_its_keys_and_no_others():
    rng = random.Random(4)
    keys = {bytes(rng.randrange(256) for _ in range(rng.randint(1, 6))): i for i in range(3000)}
    trie = DoubleArray.build(keys)

    def find(key):
        state = np.zeros(1, dtype=np.int64)
        for c in key:
            state = trie.step(state, np.array([c]))
            if state[0] < 0:
                return -1
        return int(trie.value[state[0]])

    assert all(find(k) == i for k, i in keys.items())
    assert all(find(k + bytes([7])) == keys.get(k + bytes([7]), -1) for k in keys)


def test_round_trip_of_tables(docs, given):
    rows = list(enumerate(ODD)) + [(None, "no id"), (3, "again"), (3, "again")]
    got = sorted(((r.doc_id, r.decoded_crc32, r.decoded_chars) for r in round_trip(docs(rows)).collect()), key=repr)
    assert got == sorted(((i, zlib.crc32((t or "").encode()), len(t or "")) for i, t in rows), key=repr)
    whole = {r.doc_id: r.decoded_crc32 for r in round_trip(given("documents")).collect()}
    assert whole == {r.doc_id: zlib.crc32(r.text.encode()) for r in given("documents").collect()}
    assert round_trip(docs([])).count() == 0


def test_workers_stay_small(monkeypatch):
    model = module.load(public_tokenizers.path(VOCABULARY))
    assert model.decode(np.array([300, 301], dtype="<u4").tobytes()) and "trie" not in vars(model)  # decoding needs none
    cells, segment = [], Pieces._segment

    def seen(self, units):
        cells.append(len(units) * (max(map(len, units)) + 1))
        return segment(self, units)

    monkeypatch.setattr(Pieces, "_segment", seen)
    texts = [b" ".join(b"%d" % (i * 977 + j) + b"x" * 300 for j in range(100)) for i in range(60)]
    assert [model.decode(x) for x in model.encode(texts)] == texts
    assert max(cells) <= 1 << 20
