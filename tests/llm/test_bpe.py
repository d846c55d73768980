"""BPE automaton against the tokenizers library."""

import hashlib
import json
import random

import numpy as np
import pytest

import public_tokenizers
from tallgrass.llm import bpe

PATH = public_tokenizers.path("word_bpe_49k.json")
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(PATH)
    t.no_truncation()
    t.no_padding()
    return t


def test_words_of_all_kinds(library):
    rng = random.Random(5)
    codec = bpe.codec(PATH)
    letters = "aaabcdeeefghiilmnoorsstttuvwyz'éßñ中\U0001f6000189!!..--_😀ıİΣς"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(1, 24))) for _ in range(6000)]
    texts += [t[:k] for t in list(json.load(open(PATH))["model"]["vocab"])[::97] for k in range(1, len(t) + 1)] + ["a" * k for k in range(1, 80)] + ["ab" * k + "!" * k for k in range(1, 60)]
    for text, e in zip(texts, library.encode_batch(texts, add_special_tokens=False)):
        assert np.frombuffer(codec.encode(text), "<u4").tolist() == e.ids, text


def test_whole_texts(library):
    codec = bpe.codec(PATH)
    texts = ["", " ", "Hello World's <|startoftext|>  éa b<|endoftext|>", "<|startoftext|", "<|STARTOFTEXT|>", "ÉTÉ İ ΑΣ ΣΑΣ.", "x y z\x1cw\x85v", "it's we'LL I'd don't'VE",
             "\x00\x01�﻿", "१२३ ٤٥ Ⅷ ½", "ﬁ ǅ ẞ", "à́ ̀b"]
    for text, e in zip(texts, library.encode_batch(texts, add_special_tokens=False)):
        ids = codec.encode(text)
        assert np.frombuffer(ids, "<u4").tolist() == e.ids, text
        assert codec.decode(ids).decode() == library.decode(e.ids, skip_special_tokens=False)


def test_automaton_of_a_few_merges():
    tokens = {t: i for i, t in enumerate(["a", "b", "aa", "ab", "aab", "aaaa"])}
    auto = bpe.Automaton(tokens, [("a", "a"), ("a", "b"), ("aa", "b"), ("aa", "aa")], "")
    names = {i: t for t, i in tokens.items()}

    def merged(word):
        parts = list(word)
        for u, v in [("a", "a"), ("a", "b"), ("aa", "b"), ("aa", "aa")]:
            i = 0
            while i < len(parts) - 1:
                if (parts[i], parts[i + 1]) == (u, v):
                    parts[i:i + 2] = [u + v]
                i += 1
        return parts

    for n in range(1, 11):
        for k in range(2**n):
            word = "".join("ab"[k >> i & 1] for i in range(n))
            assert [names[t] for t in auto.encode(word.encode())] == merged(word), word


def test_query_equals_library(spark, library):
    from tallgrass.llm.registry import QUERIES

    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()}
    rows = QUERIES["op3_bpe_automaton"](spark, SF).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = library.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_odd_rows(odd, empty, library):
    got = bpe.encode(odd, PATH).collect()
    assert len(got) == odd.count()
    for r in got:
        ids = library.encode(r.row.text or "", add_special_tokens=False).ids
        assert np.frombuffer(r.ids, "<u4").tolist() == ids and r.n_tokens == len(ids)
        assert r.decoded == library.decode(ids, skip_special_tokens=False)
    assert bpe.encode(empty, PATH).count() == 0
