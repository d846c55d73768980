"""Near-duplicate classes against all pairs."""

import random
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tallgrass.llm import minhash as M

SF = "/root/testdata/sf0.01"


def one_of_each(texts, of):
    """Texts that frequencies count: of those whose most common min-hash is the same, the one of the smallest digest."""
    keys = {}
    for d in of:
        values = np.array([s for s, _ in of[d]], np.uint64)
        keys[d] = [int(M.mixed(np.array([M.mixed(values ^ M._SEEDS[220 + k]).min()]) + M._SEEDS[220 + k]).view(np.int64)[0]) for k in range(M.SKETCH)]
    holders = Counter(x for ks in keys.values() for x in ks)
    best = {d: max((holders[x], x) for x in ks) for d, ks in keys.items()}

    def digest(d):
        return int(np.array([xxhash.xxh64(texts[d].encode(), seed=42).intdigest()], np.uint64).view(np.int64)[0])

    first = {}
    for d, (n, x) in best.items():
        if n > 1 and (x not in first or digest(d) < digest(first[x])):
            first[x] = d
    return [d for d in range(len(texts)) if d not in best or best[d][0] == 1 or first[best[d][1]] == d]


def brute(rows, threshold=0.8):
    """Components of exact weighted Jaccard similarity over shingles of words, and the links."""
    texts = sorted({t or "" for _, t in rows})
    sets = []
    for t in texts:
        words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", t.lower()) if w]
        bag = defaultdict(int)
        for i in range(max(1, len(words) - 4) if words else 0):
            bag[tuple(words[i:i + 5])] += 1
        sets.append(bag)
    counted = M.shingles([t.lower().encode() for t in texts])
    frequency = np.zeros(1 << M.BUCKETS)
    of = defaultdict(list)
    for d, s, c in zip(*counted):
        of[d].append((s, c))
    standing = one_of_each(texts, of)
    for d in standing:
        for k in {int(M.bucket_of(np.array([s]))[0]) for s, _ in of[d]}:
            frequency[k] += 1
    idf = np.log1p(len(standing) / np.maximum(1, frequency))
    for d, bag in enumerate(sets):
        assert sorted(bag.values()) == sorted(c for _, c in of[d])
    holders = defaultdict(set)
    weights = []
    for d in range(len(texts)):
        w = {int(s): c * idf[M.bucket_of(np.array([s]))[0]] for s, c in of[d]}
        weights.append(w)
        for s in w:
            holders[s].add(d)
    parent = list(range(len(texts)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    links = 0
    for d, w in enumerate(weights):
        for e in {e for s in w for e in holders[s] if e > d}:
            v = weights[e]
            both = sum(min(w[s], v[s]) for s in w.keys() & v.keys())
            if both / (sum(w.values()) + sum(v.values()) - both) >= threshold:
                links += 1
                parent[find(e)] = find(d)
    classes = defaultdict(list)
    for doc_id, t in rows:
        classes[find(texts.index(t or ""))].append(doc_id)
    out = {}
    for ids in classes.values():
        name = min(ids, key=lambda i: (i is None, i))
        for i in ids:
            out.setdefault((i, name), 0)
            out[i, name] += 1
    return out, links


def got_classes(df):
    out = defaultdict(int)
    for r in df.select("row.doc_id", "class_id").collect():
        out[r.doc_id, r.class_id] += 1
    return dict(out)


def test_real_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    want, links = brute([tuple(r) for r in docs.collect()])
    got = M.near_classes(docs)
    assert links >= 5 and got_classes(got) == want
    kept = got.where("kept").select("row.doc_id").collect()
    assert sorted(r.doc_id for r in kept) == sorted({c for _, c in want})


def near_copies(n, edits, seed, words=120):
    rng = random.Random(seed)
    base = [f"w{rng.randrange(10**6)}" for _ in range(words)]
    out = []
    for _ in range(n):
        copy = list(base)
        for _ in range(rng.randint(*edits)):
            copy[rng.randrange(words)] = f"x{rng.randrange(10**9)}"
        out.append(" ".join(copy))
    return [" ".join(base), *out]


@pytest.mark.parametrize("block", [1024, 40, 3])
def test_large_group_of_near_copies(spark, block):
    texts = near_copies(120, (1, 2), 1) + near_copies(60, (2, 5), 2) + near_copies(30, (20, 40), 3) + near_copies(3, (1, 1), 4) * 40
    passage = " ".join(f"common{i}" for i in range(60))
    texts += [passage + " " + " ".join(f"own{k}_{i}" for i in range(50 + k % 7)) for k in range(80)]
    rows = list(enumerate(texts))
    want, _ = brute(rows)
    assert got_classes(M.near_classes(spark.createDataFrame(rows, "doc_id long, text string"), block=block)) == want


def test_sampling_estimates_weighted_jaccard():
    rng = np.random.default_rng(2)
    a, b, only = (rng.integers(1, 1 << 63, 300, dtype=np.uint64) for _ in range(3))
    shared = {int(s): w for s, w in zip(a, rng.random(300) * 5 + 0.1)}
    one = {**shared, **{int(s): 1.0 for s in b[:80]}}
    two = {s: w * (2 if i % 3 == 0 else 1) for i, (s, w) in enumerate(shared.items())} | {int(s): 0.7 for s in only[:50]}
    doc, shingle, weight = [], [], []
    for d, bag in enumerate((one, two)):
        for s in sorted(bag):
            doc.append(d), shingle.append(s), weight.append(bag[s])
    drawn = M.samples(np.array(doc), np.array(shingle, np.uint64), np.array(weight), 200)
    both = sum(min(one[s], two[s]) for s in one.keys() & two.keys())
    truth = both / (sum(one.values()) + sum(two.values()) - both)
    assert abs((drawn[0] == drawn[1]).mean() - truth) < 0.1


def test_components(spark):
    rng = random.Random(0)
    edges = [(i, i + 1) for i in range(100, 160)] + [(rng.randrange(300, 340), rng.randrange(300, 340)) for _ in range(25)] + [(-5, 7), (7, -9)]
    parent = {x: x for e in edges for x in e}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        x, y = sorted((find(a), find(b)))
        parent[y] = x
    got = M.components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r.node: r.component for r in got} == {x: find(x) for x in parent}


def test_odd_rows(spark, odd, empty):
    got = M.near_classes(odd)
    assert got_classes(got) == brute([(r.doc_id, r.text) for r in odd.collect()])[0]
    assert M.distinct_documents(odd).columns == odd.columns
    assert M.near_classes(empty).count() == 0 and M.distinct_documents(empty).count() == 0


def test_pieces(monkeypatch):
    texts = [b"a b c d e f g", b"", b" \n x", b"a  b\tc d e", b"one two three four", "é ß ü ä ö é ß ü ä ö é".encode()] * 3
    want = M.shingles(texts)
    monkeypatch.setattr(M, "_PIECE", 5)
    for x, y in zip(M.shingles(texts), want):
        assert (x == y).all()


def test_linked_counts_repeats():
    idf = np.ones(1 << M.BUCKETS)
    one, two, three = (np.array(x, np.uint64) for x in ([1, 2, 3], [1, 2, 4], [7]))
    vectors = [(one, np.array([4, 4, 1])), (two, np.array([4, 4, 1])), (one, np.array([1, 1, 9])), (three, np.ones(1)), (np.zeros(0, np.uint64), np.zeros(0))]
    for t, want in ((0.8, [(1, 0)]), (0.81, [])):
        got = [(int(a), int(b)) for a, b in M.linked(vectors, np.arange(5), np.array([1, 2, 3]), np.arange(5) * 10, idf, t)]
        assert got == want
    assert abs(M.weighted_jaccard(vectors[0], vectors[1], idf) - 0.8) < 1e-12


def test_copies_leave_weights_as_they_are(spark):
    """An edited text is in the class of a text that half of the rows have, as it would be of one row."""
    rng = random.Random(6)
    base = [f"w{rng.randrange(10**6)}" for _ in range(400)]
    edited = list(base)
    for i in range(40, 400, 80):
        edited[i] = f"x{i}"
    rows = [" ".join(base)] * 150 + [" ".join(edited)] + [" ".join(f"y{rng.randrange(10**6)}" for _ in range(120)) for _ in range(150)]
    a, b = ({tuple(t[i:i + 5]) for i in range(396)} for t in (base, edited))
    assert 0.85 < len(a & b) / len(a | b) < 0.9
    got = M.near_classes(spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string"))
    assert {r.class_id for r in got.where("row.doc_id <= 150").select("class_id").collect()} == {0}


def test_one_row_of_each_class(spark):
    """Repeated rows, also with other columns, with null ids, and of texts without words."""
    rows = [(1, "a b c d e f", {"x": 1}), (1, "a b c d e f", {"x": 2}), (2, "a b c d e f", None), (None, "q r s t u", None), (None, "q r s t u", None),
            (3, None, None), (3, "", None), (4, "", None), (5, "one two three four five six", None), (5, "six five four three two one", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, m map<string,int>").repartition(4)
    got = M.distinct_documents(docs)
    assert got.columns == docs.columns
    assert sorted(((r.doc_id, r.text or "") for r in got.collect()), key=str) == sorted(
        [(1, "a b c d e f"), (None, "q r s t u"), (3, ""), (5, "one two three four five six"), (5, "six five four three two one")], key=str)


def test_hot_near_copies_keep_their_links(spark):
    """A third of all rows are edits of one text: pairs at a plain similarity of 0.8 or more stay together."""
    rng = random.Random(6)
    base = [f"b{i}" for i in range(220)]
    texts = [" ".join(f"w{rng.randint(0, 4000)}" for _ in range(rng.randint(30, 200))) for _ in range(600)]
    for i in range(300):
        words = list(base)
        for _ in range(rng.randint(1, 4)):
            words[rng.randrange(len(words))] = f"n{i}x{rng.randint(0, 10**6)}"
        texts.append(" ".join(words))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(7)
    names = {r.doc_id: r.class_id for r in M.near_classes(docs).select("row.doc_id", "class_id").collect()}
    sets = [set(zip(*[t.split()[j:] for j in range(5)])) for t in texts]
    pairs = [(a, b) for a in range(600, 900) for b in range(a + 1, 900) if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])]
    caught = sum(names[a] == names[b] for a, b in pairs) / len(pairs)
    assert len(pairs) > 1000 and caught >= 0.99
    assert all(names[a] == a for a in range(600))
