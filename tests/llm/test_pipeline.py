import random
import re
from collections import Counter

import pytest

import corpus_pipeline
from cohort_spark.llm import secrets
from tests.llm import test_near_dup, test_secrets, test_substrings, test_tokens
from tests.llm.conftest import DOCS

WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Documents with toxic words, near copies, shared passages and secrets; nulls, empty texts and repeated rows."""
    rng = random.Random(11)
    vocabulary = ["".join(rng.choice("abcdeghilmnorstu") for _ in range(rng.randint(2, 9))) for _ in range(3000)]
    passage = [rng.choice(vocabulary) for _ in range(70)]
    rows, labels = [], []
    for i in range(420):
        words = [rng.choice(vocabulary) for _ in range(rng.randint(30, 160))]
        toxic = int(i % 3 == 0)
        if toxic:
            for _ in range(8):
                words.insert(rng.randrange(len(words)), rng.choice(["grobnakling", "vexlingor"]))
        elif i % 7 == 1:
            words = words[:20] + passage + words[20:]
        if i % 11 == 5:
            words.insert(9, "token = " + "".join(rng.choice("0123456789abcdef") for _ in range(40)))
        rows.append((i, " ".join(words)))
        labels.append((i, 1, toxic))
    for i in range(60):
        words = rows[i][1].split(" ")
        words[rng.randrange(len(words))] = "changed"
        rows.append((1000 + i, " ".join(words)))
    rows += [(2000, None), (2001, ""), (None, "no id"), rows[4], (2002, rows[5][1]), (2003, "é " * 500)]
    path = str(tmp_path_factory.mktemp("tables"))
    spark.createDataFrame([(i, t, "en", None, 0) for i, t in rows], DOCS).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path


def pairs(df):
    return [(r.doc_id, r.text) for r in df.collect()]


def test_each_stage_against_brute_force(spark, folder, tmp_path):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, stages = docs.columns, dict(corpus_pipeline.STAGES)
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "near_duplicates", "substrings", "secrets", "packing"]
    before = docs
    for name, stage in corpus_pipeline.STAGES:
        after = stage(spark, before, folder)
        path = str(tmp_path / name)
        after.write.parquet(path)
        after = spark.read.parquet(path)
        rows = pairs(before)
        if name != "packing":
            assert after.columns == columns
        if name == "toxicity":
            kept = Counter(pairs(after))
            assert not kept - Counter(rows)
            bad = [r for r in rows if "grobnak" in (r[1] or "") or "vexling" in (r[1] or "")]
            gone = Counter(rows) - kept
            assert sum(gone[r] for r in bad) >= 0.9 * len(bad) and sum(gone.values()) - sum(gone[r] for r in bad) <= 0.02 * len(rows)
        elif name == "near_duplicates":
            distinct = list(dict.fromkeys(rows))
            stay = {d for d, *_, keep in test_near_dup.brute(distinct) if keep}
            assert Counter(pairs(after)) == Counter(r for r in rows if r[0] in stay)
        elif name == "substrings":
            want = {d: (gone, text) for d, _, gone, text in test_substrings.brute(rows, 50)}
            assert Counter(pairs(after)) == Counter((d, want[d][1] if want[d][0] else t) for d, t in rows)
            assert any(gone for gone, _ in want.values())
        elif name == "secrets":
            table = secrets.train(secrets.labelled_strings(before))
            masked = 0
            for r in after.collect():
                text = dict(rows)[r.doc_id]
                spans = test_secrets.added(text or "", table, test_secrets.base(text or ""))
                masked += bool(spans)
                assert r.text == text if not spans else "[SECRET]" in r.text and not test_secrets.base(r.text)
                assert r.n_chars == (None if r.text is None else len(r.text))
            assert masked > 5
        else:
            test_tokens.check_packing(after.collect(), [test_tokens.ids_of(t) for _, t in rows], 2048)
        before = after
    assert set(stages) == {"toxicity", "near_duplicates", "substrings", "secrets", "packing"}


def test_run_applies_all_stages(spark, folder):
    assert corpus_pipeline.ORACLE_SQL is None
    out = corpus_pipeline.run(spark, folder)
    assert out.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    ids = {r.doc_id for r in out.select("doc_id").distinct().collect()}
    assert {1, 2, 2000, 2001, None} <= ids and not {1001, 1002, 2002} & ids


def test_empty_documents(spark, tmp_path):
    spark.createDataFrame([], DOCS).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "doc_id bigint, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
