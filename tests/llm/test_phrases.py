"""Collocations against plain Python; the parse against its own definition."""

import random
import re
from collections import Counter

import pytest

from tallgrass.llm import phrases

SF = "/root/testdata/sf0.001"
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, longest=3, least=10, top=2000):
    f, out = Counter(), []
    for lang, text in rows:
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(LOW)):
            w = re.findall("[^\x20\x09]+", piece)
            for k in range(1, longest + 1):
                for i in range(len(w) - k + 1):
                    f[lang or "und", tuple(w[i:i + k])] += 1
    cand = {x: a for x, a in f.items() if len(x[1]) > 1 and a >= least}
    gone = set()
    for (lang, w), a in cand.items():
        for k in range(2, len(w)):
            for i in range(len(w) - k + 1):
                if 100 * a >= 50 * f[lang, w[i:i + k]]:
                    gone.add((lang, w[i:i + k]))
    for lang in {x[0] for x in f}:
        n = sum(a for x, a in f.items() if x[0] == lang and len(x[1]) == 1)
        got = []
        for (of, w), a in cand.items():
            if of == lang and (of, w) not in gone:
                score, _, l, r = min((1_000_000 * a * a // (f[lang, w[:k]] * f[lang, w[k:]]), k, f[lang, w[:k]], f[lang, w[k:]]) for k in range(1, len(w)))
                got.append((-score, -a, " ".join(w).encode(), l, r))
        out += [(lang, i + 1, p.decode(), -a, l, r, n, -s) for i, (s, a, p, l, r) in enumerate(sorted(got)[:top])]
    return set(out)


def found(df):
    rows = [tuple(r) for r in df.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(4)
    words = ["a", "b", "A", "cc", "é", "x y", "\x00", "中", "dd", "e"]
    marks = [" ", " ", " ", " ", "  ", "\t", ". ", ",", "\n", "\x0b", "!", " ; ", "\x1c"]
    rows = [(rng.choice(["en", "de", None]), "".join(rng.choice(words) + rng.choice(marks) for _ in range(rng.randint(0, 60)))) for _ in range(400)]
    return rows + [("en", " ".join(["same"] * 5000)), ("en", "lead in words " * 40), (None, None), ("fr", ""), ("fr", " .,")]


def test_brute_force(spark, texts):
    docs = spark.createDataFrame(texts, "lang string, text string").repartition(5)
    assert found(phrases.collocations(docs, modulus=3)) == brute(texts)
    assert found(phrases.collocations(docs, modulus=1, bits=1 << 16, top=7)) == brute(texts, top=7)
    assert found(phrases.collocations(docs, longest=4, least=4, modulus=7)) == brute(texts, longest=4, least=4)


def test_equal_passages_share_chunks(spark):
    rng = random.Random(1)
    passage = " ".join(f"w{rng.randint(0, 999)}" for _ in range(3000))
    docs = spark.createDataFrame([("en", f"own {i} {i} " + passage + f" end {i}") for i in range(20)], "lang string, text string")
    freq = [r.freq for r in phrases.parse(docs).collect()]
    assert sorted(freq)[-1] == 20 and sum(f == 20 for f in freq) > 0.9 * len(freq) / 2 and max(freq) == 20


def test_query_equals_brute_force(spark):
    from tallgrass.llm.registry import QUERIES

    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("lang", "text").collect()]
    assert found(QUERIES["op12_phrases"](spark, SF)) == brute(rows)


def test_odd_rows(spark, odd, empty):
    docs = odd.withColumnRenamed("key", "lang")
    rows = [(r.lang, r.text) for r in docs.collect()]
    assert found(phrases.collocations(docs, least=2)) == brute(rows, least=2)
    assert phrases.collocations(empty.withColumnRenamed("key", "lang")).count() == 0
