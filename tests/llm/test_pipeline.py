"""Pipeline against plain Python, stage by stage, each on its own input."""

import hashlib
from collections import Counter

import numpy as np
import pytest

import __spark_entry__
import corpus_pipeline as P
import public_tokenizers
from tallgrass.llm import rules
from tests.llm.test_columnwise import brute_lines, brute_statistics
from tests.llm.test_minhash import brute as brute_near

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark, tmp_path_factory):
    root, docs = tmp_path_factory.mktemp("steps"), spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs]
    for k, (_, stage) in enumerate(P.STAGES):
        stage(spark, docs, SF).write.parquet(f"{root}/{k}")
        docs = spark.read.parquet(f"{root}/{k}")
        out.append(docs)
    return [d.collect() for d in out], out


def test_stages_are_the_asked_ones():
    assert [n for n, _ in P.STAGES] == ["quality rules", "line dedup", "near dedup", "source mix", "encode"]
    assert P.ORACLE_SQL is None and __spark_entry__.queries()["pipeline"] is P.run


def test_columns(steps):
    for df in steps[1][1:5]:
        assert df.columns == steps[1][0].columns


def test_quality(spark, steps):
    rows, frames = steps
    found = rules.fit(frames[0], spark.read.parquet(f"{SF}/labels.parquet"))
    for r in rules.judge(frames[0], found).collect():
        assert r.base_failed == brute_statistics(r.row.text)[5]
        hit = any(all(r[f] >= v if op == ">=" else r[f] < v for f, op, v in rule.tests) for rule in found)
        assert r.kept == (not r.base_failed and not hit)
        assert (r.row in rows[1]) == r.kept


def test_lines(steps):
    got = Counter((r.doc_id, r.text) for r in steps[0][2])
    assert got == Counter((d, text) for d, _, _, text in brute_lines([(r.doc_id, r.text) for r in steps[0][1]]).elements())
    assert all(r.n_chars == len(r.text) for r in steps[0][2])


def test_near(steps):
    classes, _ = brute_near([(r.doc_id, r.text) for r in steps[0][2]])
    assert sorted(r.doc_id for r in steps[0][3]) == sorted({c for _, c in classes})
    assert set(steps[0][3]) <= set(steps[0][2])


def test_mix(steps):
    before = {tuple(r): r for r in steps[0][3]}
    taken = Counter(map(tuple, steps[0][4]))
    assert set(taken) <= set(before) and max(taken.values()) <= 2
    words = {k: brute_statistics(r.text)[0] for k, r in before.items()}
    assert abs(sum(words[k] * n for k, n in taken.items()) - 1.5 * sum(words.values())) <= 20 * max(words.values())


def test_encode(steps):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    texts = {r.doc_id: r.text for r in steps[0][4]}
    assert Counter(r.doc_id for r in steps[0][5]) == Counter(r.doc_id for r in steps[0][4])
    for r in steps[0][5]:
        ids = t.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert np.frombuffer(r.ids, "<u4").tolist() == ids and r.n_tokens == len(ids)
        assert r.decoded_sha256 == hashlib.sha256(t.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_odd_and_empty_documents(spark, odd, empty):
    for docs in (odd.limit(4), empty):
        for _, stage in P.STAGES[:-1]:
            docs = stage(spark, docs, SF)
            assert docs.columns == odd.columns
        assert P.encode(spark, docs, SF).count() == docs.count()
