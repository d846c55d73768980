"""Spelling groups against plain Python."""

import random
import re
import zlib
from collections import Counter, defaultdict

from tallgrass.llm import spelling

SF = "/root/testdata/sf0.001"
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_counts(rows, letters=5, least=3):
    n = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOW)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            n[run if h % 97 else run[:h % len(run)] + run[h % len(run) + 1:]] += 1
    return {w: k for w, k in n.items() if len(w) >= letters and k >= least}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute_groups(n):
    """All near pairs by what is left after deleting one letter or none, then forms and roots."""
    left = defaultdict(set)
    for w in n:
        for cut in {w, *(w[:i] + w[i + 1:] for i in range(len(w)))}:
            left[cut].add(w)
    near = defaultdict(set)
    for group in left.values():
        for a in group:
            near[a] |= {b for b in group if a != b and one_edit(a, b)}
    form = {}
    for w in n:
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= 2 * n[w] else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w

    return {(w, form[w], root(w), n[w], len(near[w]), None if form[w] is None else n[form[w]]) for w in n}


def found(df):
    rows = [tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def test_query_equals_brute_force(spark):
    from tallgrass.llm.registry import QUERIES

    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    want = brute_groups(brute_counts(docs))
    assert found(QUERIES["op13_spelling_groups"](spark, SF)) == want
    assert any(w[1] for w in want)


def test_random_words(spark):
    """Few letters, so that many words are anagrams of one another; long chains of forms."""
    rng = random.Random(3)
    n = {"".join(rng.choice("abß") for _ in range(rng.randint(1, 9))): rng.randint(1, 400) for _ in range(3000)}
    n |= {"a" * k + "é" * (30 - k): 2**k for k in range(28)} | {"x" * 2000 + "y": 5, "x" * 2001: 50, "x" * 2002: 100, "\U0001f600a": 3, "\U0001f601a": 9}
    words = spark.createDataFrame([(w, k) for w, k in n.items()], "word string, n long")
    want = brute_groups(n)
    assert found(spelling.spelling_groups(words)) == want
    assert found(spelling.spelling_groups(words.repartition(3), parts=5)) == want


def test_odd_rows(spark, odd, empty):
    rows = odd.select("doc_id", "text").collect()
    n = {w: r for w, r in brute_counts(rows).items()}
    assert {tuple(r) for r in spelling.word_counts(odd).collect()} == set(n.items())
    assert found(spelling.spelling_groups(spelling.word_counts(odd))) == brute_groups(n)
    assert spelling.spelling_groups(spelling.word_counts(empty)).count() == 0
    twice = spark.createDataFrame([("hello", 2), ("hello", 3), (None, 4), ("", 7), ("hallo", 10)], "word string, n long")
    assert found(spelling.spelling_groups(twice)) == {("hello", "hallo", "hallo", 5, 1, 10), ("hallo", None, "hallo", 10, 1, None)}
