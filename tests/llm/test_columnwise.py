"""Line dedup, token counts, quality rules, fingerprints against plain Python."""

import hashlib
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import public_tokenizers
from tallgrass.llm import fingerprints as FP
from tallgrass.llm import lines, rules, tokens
from tests.util import plan

SPACES = " \t\n\x0b\x0c\r"
SF = "/root/testdata/sf0.001"


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def brute_lines(rows, min_docs=2, min_chars=10):
    holders = defaultdict(set)
    keyed = []
    for doc_id, text in rows:
        parts = [(line, lower(line.strip(SPACES))) for line in (text or "").split("\n")]
        keyed.append((doc_id, parts))
        for _, key in parts:
            if len(key) >= min_chars:
                holders[key].add(doc_id)

    def smallest(ids):
        return min(ids, key=lambda i: (i is None, i))

    out = []
    for doc_id, parts in keyed:
        kept = [line for line, key in parts if len(holders.get(key, ())) < min_docs or smallest(holders[key]) == doc_id]
        out.append((doc_id, len(parts), len(parts) - len(kept), "\n".join(kept)))
    return Counter(out)


def test_line_dedup_equals_brute_force(odd):
    out = lines.drop_shared_lines(odd)
    got = Counter(tuple(r) for r in out.select("row.doc_id", "n_lines", "n_dropped", "kept").collect())
    assert got == brute_lines([(r.doc_id, r.text) for r in odd.collect()])


def test_line_dedup_threshold_and_columns(odd, empty):
    out = lines.drop_shared_lines(odd, min_docs=3, min_chars=3)
    got = Counter(tuple(r) for r in out.select("row.doc_id", "n_lines", "n_dropped", "kept").collect())
    assert got == brute_lines([(r.doc_id, r.text) for r in odd.collect()], 3, 3)
    assert lines.without_shared_lines(odd).columns == odd.columns
    assert lines.without_shared_lines(odd).count() == odd.count()
    assert lines.drop_shared_lines(empty).count() == 0


def test_line_dedup_hot_line(spark):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.concat(F.lit("The same line in all of them\nown line "), F.col("id").cast("string")).alias("text"))
    out = lines.drop_shared_lines(docs).agg(F.sum("n_dropped"), F.count_if(F.col("kept").contains("same line"))).first()
    assert tuple(out) == (2999, 1)


def test_token_counts_equal_library(odd, empty):
    import sentencepiece

    path = public_tokenizers.path("piece_bpe_32k.model")
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    got = tokens.count_tokens(odd, path, limit=100).collect()
    for r in got:
        text = r.row.text or ""
        assert (r.n_bytes, r.n_tokens) == (len(text.encode()), len(model.encode(text)))
        assert r.over_limit == (r.n_tokens > 100)
    assert len(got) == odd.count() and tokens.count_tokens(empty, path).count() == 0


@pytest.mark.parametrize("limit", [1, 2, 7, 40])
def test_token_counts_of_pieces(limit):
    import sentencepiece

    path = public_tokenizers.path("piece_bpe_32k.model")
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    texts = ["a  b c", " lead and trail ", "▁x ▁ y", "tab\tx\n new  line \n ", "e\u0301 é <s> </s> <unk> ok", "\u3000 wide\u00a0blank here", "a" * 50 + " " + "b c " * 20]
    assert list(tokens.count_batches(iter(texts), path, limit, 16)) == [len(x) for x in model.encode(texts)]


def brute_statistics(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = Counter(tuple(words[i:i + 5]) for i in range(len(words) - 4))
    covered = {j for i in range(len(words) - 4) if windows[tuple(words[i:i + 5])] > 1 for j in range(i, i + 5)}
    full = [x for x in (text or "").split("\n") if x.strip(SPACES)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(full) - len(set(full)), len(covered),
            len(words) < 10 or 100 * len(covered) > 20 * len(words))


COLUMNS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def test_statistics_equal_brute_force(spark, odd, empty):
    more = spark.createDataFrame([(i, t) for i, t in enumerate([
        "a b c d e a b c d e", "x x x x x x", "a b c d e f a b c d e g h i j k l", "p q\np q\n \n \np q", "one two three four",
        "a b c d e z a b c d e b c d e a b c d e"])], "doc_id long, text string")
    real = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    for docs in (odd, more, real):
        for r in rules.judge(docs, []).collect():
            assert tuple(r[c] for c in COLUMNS) == brute_statistics(r.row.text), r.row.text
            assert r.kept == (not r.base_failed)
    assert rules.judge(empty, []).count() == 0


def test_learned_rules_hold_out(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    train = labels.where("doc_id % 2 = 0")
    found = rules.fit(docs, train, sample=1500)
    assert found and all(r.tests for r in found)
    held = labels.where("doc_id % 2 = 1").select(F.col("doc_id").alias("id"), "quality")
    seen = rules.judge(docs, found).join(held, F.col("row.doc_id") == F.col("id"))
    good, kept_good, bad, kept_bad = seen.agg(
        *[F.count_if(F.expr(x)) for x in ("quality = 1 and not base_failed", "quality = 1 and kept", "quality = 0", "quality = 0 and kept")]).first()
    assert kept_good >= 0.99 * good and kept_bad <= 0.1 * bad


def test_learner_needs_precision():
    rng = np.random.default_rng(1)
    x = rng.random((3000, len(rules.FEATURES)))
    bad = (x[:, 1] > 0.7) & (x[:, 3] < 0.4)
    found = rules.learn(x, bad)
    hit = np.any([r.covers(x) for r in found], axis=0)
    assert (hit & bad).sum() > 0.9 * bad.sum() and (hit & ~bad).sum() < 0.05 * hit.sum()
    assert rules.learn(x, rng.random(3000) < 0.3) == []


def test_rules_without_labels(odd, empty):
    labels = odd.select("doc_id", F.lit(None).cast("int").alias("quality"))
    assert rules.fit(odd, labels) == []
    assert rules.fit(empty, labels) == []
    assert rules.good_documents(odd, labels).columns == odd.columns


def test_rules_and_fingerprints_stay_native(odd):
    some = [rules.Rule([("symbol_share", ">=", 0.1)])]
    for df in (rules.judge(odd, some), FP.fingerprints(odd)):
        assert not re.search("Python|Pandas|Arrow", plan(df))


def vectors(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, text string")
    return {r.id: (r.checks, r.marks) for r in FP.vectors(df, ["id"], "text").collect()}


def test_fingerprint_is_homomorphic(spark):
    v = vectors(spark, ["One. Two.\nThree four.", "Five six!\n\nSeven", "One. Two.\nThree four.\nFive six!\n\nSeven", "Seven\nThree four.\n\nFive six!\nOne. Two.", "One. Two.\nThree four.\nSeven"])
    one = spark.createDataFrame([(*v[0], *v[1], *v[2])], "a array<long>, b array<long>, c array<long>, d array<long>, e array<long>, f array<long>")
    plus = one.select(*FP.insert(F.col("a"), F.col("b"), F.col("c"), F.col("d"))).first()
    minus = one.select(*FP.delete(F.col("e"), F.col("f"), F.col("c"), F.col("d"))).first()
    assert tuple(plus) == v[2] == v[3] and tuple(minus) == v[0] and v[2] != v[4]
    assert len(v[0][0]) == FP.CHECKS and all(0 <= x < 2**32 for x in v[0][0]) and all(0 <= x < 2**16 for x in v[0][1])


def brute_edits(rows):
    order = sorted(rows, key=lambda r: -r[0])
    out = {}
    for (doc_id, text), (_, other) in zip(order, order[1:] + order[:1]):
        half = len(text) // 2
        out[doc_id] = (len(text), hashlib.sha256((text[:len(text) - half] + other[:half]).encode()).hexdigest())
    return out


@pytest.mark.parametrize("n_ranges", [1, 4, 60])
def test_next_document(spark, n_ranges):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    got = FP.with_next(docs, n_ranges).select("row.doc_id", F.length("text"), F.sha2(FP.edited(F.col("text"), F.col("next_text")), 256)).collect()
    assert {r[0]: (r[1], r[2]) for r in got} == brute_edits([tuple(r) for r in docs.collect()]) and len(got) == docs.count()


def test_fingerprints_odd_rows(odd, empty):
    got = FP.fingerprints(odd).collect()
    assert len(got) == odd.count()
    by_text = defaultdict(set)
    for r in got:
        by_text[r.row.text or ""].add(r.fingerprint)
    assert all(len(s) == 1 for s in by_text.values()) and len({min(s) for s in by_text.values()}) == len(by_text)
    assert FP.fingerprints(empty).count() == 0
    assert FP.with_next(empty).count() == 0
    assert FP.with_next(odd, 3).count() == odd.count()
    alone = odd.where("doc_id = 0")
    assert FP.with_next(alone).where("text = next_text").count() == 1


def test_fingerprint_likeness(spark):
    from tallgrass.llm.registry import QUERIES

    rows = QUERIES["op8_multiset_fingerprints"](spark, SF).collect()
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in rows)
    long = [r for r in rows if r.n_chars > 800]
    assert np.mean([r.near_edited for r in long]) > np.mean([r.near_next for r in long]) + 0.25


def brute_likeness(a, b):
    """Cosine of the counts of three-word shingles inside paragraphs."""
    bags = []
    for text in (a, b):
        bag = Counter()
        for p in text.split("\n"):
            words = re.findall(r"[^\x20\x09-\x0D]{1,16}", p)
            bag.update(tuple(words[i:i + 3]) for i in range(len(words)))
        bags.append(bag)
    x, y = bags
    norm = (sum(v * v for v in x.values()) * sum(v * v for v in y.values())) ** 0.5
    return sum(v * y[k] for k, v in x.items()) / norm if norm else 0.0


def test_likeness_of_each_document(spark):
    """Texts of one line, without sentence marks or without blanks included."""
    rng = np.random.default_rng(5)

    def letters(n):
        return "".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), n))

    texts = [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").select("text").limit(300).collect()]
    texts += [" ".join(letters(5) for _ in range(400)) for _ in range(20)] + ["\n".join(letters(9) for _ in range(200)) for _ in range(5)]
    texts += [letters(3000) for _ in range(10)] + [", ".join(letters(4) for _ in range(300)) for _ in range(10)]
    pairs = [(t, t[:len(t) - len(t) // 2] + u[:len(t) // 2]) for t, u in zip(texts, texts[1:] + texts[:1])]
    pairs += [(t, u) for t, u in zip(texts, texts[7:])]
    df = spark.createDataFrame([(i, w, t) for i, p in enumerate(pairs) for w, t in enumerate(p)], "id int, w int, text string")
    v = FP.vectors(df, ["id", "w"], "text")
    a, b = (v.where(f"w = {w}").select("id", F.col("checks").alias(f"c{w}"), F.col("marks").alias(f"m{w}")) for w in (0, 1))
    got = {r.id: r.x for r in a.join(b, "id").select("id", FP.likeness(F.col("c0"), F.col("m0"), F.col("c1"), F.col("m1")).alias("x")).collect()}
    error = np.array([abs(got[i] - (1.0 if Counter(x.split("\n")) == Counter(y.split("\n")) else brute_likeness(x, y))) for i, (x, y) in enumerate(pairs)])
    assert error.mean() < 0.08 and error.max() < 0.4


def test_marks_of_many_units(spark):
    """A unit found more than 2^15 times in a text doesn't turn its lanes over."""
    text = "same line here\n" * 40_000
    df = spark.createDataFrame([(0, text), (1, text + "more"), (2, "same line here\n" * 3)], "id int, text string")
    v = {r.id: r for r in FP.vectors(df, ["id"], "text").collect()}
    one = spark.createDataFrame([(v[0].checks, v[0].marks, v[2].checks, v[2].marks)], "a array<long>, b array<long>, c array<long>, d array<long>")
    assert one.select(FP.likeness(*[F.col(c) for c in "abcd"])).first()[0] > 0.999
    assert max(v[0].marks) >= 2**16


def test_rules_learn_from_a_bounded_sample(spark):
    """Many rows of a few ids, repeated labels: a row an id reaches the driver, whatever the layout."""
    from tallgrass.llm import rules

    docs = spark.range(20_000).selectExpr("id % 2 as doc_id", "concat('some words ', cast(id as string)) as text")
    labels = spark.createDataFrame([(0, 1), (1, 0), (1, 1), (1, 0), (None, 0), (7, 1)], "doc_id long, quality int")
    seen = []
    original, rules.learn = rules.learn, lambda x, bad: seen.append((x.tolist(), sorted(bad.tolist()))) or []
    try:
        rules.fit(docs, labels, sample=10)
        rules.fit(docs.repartition(9), labels, sample=10)
        rules.fit(docs, labels, sample=1)
    finally:
        rules.learn = original
    assert len(seen[0][0]) == 2 and seen[0] == seen[1] and seen[0][1] == [False, True] and all(len(x) <= 1 for x, _ in seen[2:])


def test_token_query_equals_library(spark):
    import public_tokenizers
    import sentencepiece

    from tallgrass.llm.registry import QUERIES

    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()}
    rows = QUERIES["op9_token_counts"](spark, "/root/testdata/sf0.01").collect()
    assert len(rows) == len(texts)
    for r in rows:
        n = len(model.encode(texts[r.doc_id]))
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(texts[r.doc_id].encode()), n, n > 4096)


def test_pieces_go_by_bytes():
    text = "ab\U0001f600 é中 " * 400 + "x" * 900 + " tail"
    for limit in (1, 7, 64, 1000):
        pieces = list(tokens.safe_pieces(text, limit))
        assert " ".join(pieces) == text
        longest = max(len(w.encode()) for w in text.split(" "))
        assert all(len(p.encode()) <= limit + 2 * longest + 8 for p in pieces)


def test_next_of_rows_without_ids(spark):
    """Rows without a doc_id come last, by their texts' digests, in several ranges."""
    docs = spark.range(120).selectExpr("CASE WHEN id < 20 THEN id END AS doc_id", "concat('text ', id) AS text")
    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("h")).collect()
    order = [r.text for r in sorted(rows, key=lambda r: (r.doc_id is None, -(r.doc_id or 0), r.h))]
    got = FP.with_next(docs, 6)
    assert {r.text: r.next_text for r in got.collect()} == dict(zip(order, order[1:] + order[:1]))
    assert got.where("row.doc_id IS NULL").select("range").distinct().count() == 6
