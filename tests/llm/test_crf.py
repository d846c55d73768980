"""Line CRF: chains against enumeration, statistics against plain Python, held-out accuracy."""

import itertools
import math
import re
import zlib

import numpy as np
import pytest

from tallgrass.llm import crf
from tallgrass.llm.registry import QUERIES

SF = "/root/testdata/sf0.01"


def flat(texts):
    parts = [t.encode() for t in texts]
    return np.frombuffer(b"".join(parts), np.uint8), np.cumsum([len(p) for p in parts])


def test_marginals_against_enumeration():
    rng = np.random.default_rng(2)
    sizes = [1, 5, 2, 7, 1, 4]
    until = np.cumsum(sizes)
    emission, trans = rng.normal(size=sum(sizes)) * 2, rng.normal(size=(2, 2))
    forward, backward = crf._messages(emission, trans, until)
    got = crf._odds(forward + backward)
    for end, size in zip(until, sizes):
        e = emission[end - size:end]
        weight = {y: math.exp(sum(e[t] * y[t] for t in range(size)) + sum(trans[a, b] for a, b in zip(y, y[1:])))
                  for y in itertools.product((0, 1), repeat=size)}
        for t in range(size):
            want = sum(w for y, w in weight.items() if y[t]) / sum(weight.values())
            assert abs(got[end - size + t] - want) < 1e-9


def test_statistics_of_lines():
    texts = ["", "One two two. THREE!\n\none two\r\nOne two two. THREE!", "\n", "é 中\U0001f600 9$ 9$", "", "tail\ntail\n"]
    stats, chars, until = crf.line_statistics(*flat(texts))
    lines = [line for t in texts for line in t.split("\n")]
    assert len(stats) == len(lines) and until.tolist() == np.cumsum([t.count("\n") + 1 for t in texts]).tolist()
    assert chars.tolist() == [len(x) for x in lines]
    name = {n: i for i, n in enumerate(crf.STATISTICS)}
    at = 0
    for t in texts:
        before = []
        for line in t.split("\n"):
            s, words = stats[at], re.findall(r"[^\x20\x09-\x0D]+", line)
            assert s[name["empty"]] == (not words) and s[name["seen_line"]] == (line in before and bool(words))
            assert s[name["repeat"]] == pytest.approx(sum(a == b for a, b in zip(words, words[1:])) / max(len(words), 1))
            assert s[name["known_word"]] == pytest.approx(1 - len(set(words)) / len(words) if words else 0)
            assert s[name["mark"]] == pytest.approx(sum(line.count(c) for c in "!?") / max(len(line), 1))
            letters = [c for c in line if (c.isascii() and c.isalpha())]
            if len(letters) == len(re.sub(r"[\x00-\x40\x5b-\x60\x7b-\x7f]", "", line)):
                assert s[name["upper"]] == pytest.approx(sum(c.isupper() for c in letters) / max(len(letters), 1))
            before.append(line)
            at += 1


def test_held_out_accuracy(spark):
    rows = {r.doc_id: r for r in QUERIES["op11_line_crf"](spark, SF).collect()}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    assert len(rows) == spark.read.parquet(f"{SF}/documents.parquet").count()
    for r in rows.values():
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5)
    held = [(r.score, r.predicted, labels[i]) for i, r in rows.items() if r.held_out and i in labels]
    assert sum(p == y for _, p, y in held) / len(held) >= 0.95
    good, bad = [s for s, _, y in held if y], [s for s, _, y in held if not y]
    assert sum(a > b for a in good for b in bad) / (len(good) * len(bad)) >= 0.97


def test_labels_only_come_from_the_rows_given(spark):
    """Held-out labels turned round change nothing."""
    from pyspark.sql import functions as F

    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(300).select("doc_id", "text").cache()
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1
    a = crf.fit(docs, labels.where(~held), steps=5)
    b = crf.fit(docs.repartition(7), labels.withColumn("quality", F.when(held, 1 - F.col("quality")).otherwise(F.col("quality"))).where(~held), steps=5)
    assert np.array_equal(a.weights, b.weights) and a.offset == b.offset


def test_lines_of_mixed_texts(spark):
    """Texts of good and bad lines: learned from the texts' labels alone, lines are told apart."""
    import random

    rng = random.Random(3)

    def good():
        return " ".join("".join(rng.choice("aeioubdmnst") for _ in range(rng.randint(2, 8))) for _ in range(9)) + "."

    def bad():
        return " | ".join("".join(rng.choice("aeioubdmnst") for _ in range(4)) for _ in range(6)) + " |"

    texts, kinds = [], []
    for i in range(300):
        kind = [False] * rng.randint(1, 8)
        if i % 3 == 0:
            kind = [rng.random() < 0.25 for _ in kind] + [True] * rng.randint(3, 9)
        kinds.append(kind)
        texts.append("\n".join(bad() if k else good() for k in kind))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    labels = spark.createDataFrame([(i, 0 if any(k) else 1) for i, k in enumerate(kinds)], "doc_id long, quality int")
    out = crf.judge(docs, crf.fit(docs, labels), lines=True).select("row.doc_id", "score", "lines").collect()
    pairs = [((x < 0.5), k) for r in out for x, k in zip(r.lines, kinds[r.doc_id], strict=True)]
    assert sum(a == b for a, b in pairs) / len(pairs) > 0.95
    assert all((r.score >= 0.5) == (not any(kinds[r.doc_id])) for r in out)


def test_sample_bounds_the_rows(spark):
    """Many rows of a few ids: one row an id is learned from, and long texts aren't."""
    docs = spark.range(3000).selectExpr("id % 2 as doc_id", "concat('a b ', cast(id as string)) as text")
    labels = spark.createDataFrame([(0, 1), (1, 0), (1, 1), (None, 0)], "doc_id long, quality int")
    seen = []
    original, crf.learn = crf.learn, lambda stats, *a, **k: seen.append(len(stats))
    try:
        crf.fit(docs, labels, sample=10)
        crf.fit(docs, labels, sample=1)
        assert crf.fit(docs, labels, most_lines=0) is None
    finally:
        crf.learn = original
    assert seen == [2, 1]


def test_odd_rows(spark, odd, empty):
    labels = spark.createDataFrame([(0, 1), (1, 1), (5, 0), (6, 0), (None, 0), (2, None)], "doc_id long, quality int")
    field = crf.fit(odd, labels, steps=20)
    out = crf.judge(odd, field, lines=True).collect()
    assert len(out) == odd.count() and out[0].row.asDict().keys() == {"doc_id", "text", "source", "pos", "key", "row"}
    for r in out:
        assert 0 <= r.score <= 1 and len(r.lines) == (r.row.text or "").count("\n") + 1
    assert len({r.score for r in out if not r.row.text}) == 1 and len({r.score for r in out if r.row.doc_id == 1}) == 1
    assert crf.judge(empty, field).count() == 0
    assert crf.fit(odd, labels.where("false")) is None and crf.fit(empty, labels) is None
    assert {r.score for r in crf.judge(odd, None).collect()} == {0.5}
