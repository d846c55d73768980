"""Phrase collocations: n-grams counted inside the distinct chunks of a prefix-free parse.

A text is parsed into words; a window of ``longest - 1`` words whose hash meets a condition
triggers the end of one chunk and the start of the next, so neighbouring chunks overlap by
that window. A chunk owns the n-grams that start before its closing window, the last chunk
of a text owns all of its: each n-gram lies whole in the one chunk that owns its start. Equal
passages give equal chunks, whatever surrounds them, so n-grams are counted once per distinct
chunk and weighted by how often the parse uses it.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallgrass.llm.common import byte_slices, packed, stored, text_of
from tallgrass.llm.registry import query
from tallgrass.queries import read

#: Bytes of text that a task works on at a time.
_SLICE = 2 << 20
_BLOCK = 16
_MUL = np.uint64(0x9E3779B97F4A7C15)

_KIND = np.zeros(256, np.uint8)  # 0: part of a word, 1: blank, 2: end of a piece
_KIND[list(b" \t")] = 1
_KIND[list(b".,;:!?\n\x0b\x0c\r")] = 2
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _MUL
    return x ^ (x >> np.uint64(29))


class _Words:
    """The words of some texts, with their text, their place and the normal form of their bytes.

    In the normal form words are lower-case, one blank apart, pieces one line feed apart, and
    every text ends with a line feed. ``joined[i]`` says that words i and i+1 are of one piece.
    """

    def __init__(self, data: np.ndarray, ends: np.ndarray):
        kind = _KIND[data]
        word = kind == 0
        edge = np.zeros(len(data) + 1, bool)
        edge[ends] = True
        edge[0] = True
        before = np.empty(len(data), bool)
        before[:1], before[1:] = False, word[:-1]
        self.starts = np.flatnonzero(word & (~before | edge[:-1]))
        after = np.empty(len(data), bool)
        after[-1:], after[:-1] = False, word[1:]
        stops = np.flatnonzero(word & (~after | edge[1:])) + 1
        self.n = len(self.starts)
        self.text = np.searchsorted(ends, self.starts, "right")
        lens = stops - self.starts
        breaks = np.cumsum(kind == 2)
        self.joined = np.zeros(self.n, bool)
        if self.n:
            self.joined[:-1] = (breaks[self.starts[1:]] == breaks[stops[:-1] - 1]) & (self.text[1:] == self.text[:-1])
        letters = _LOWER[data[word]]
        offsets = np.zeros(self.n + 1, np.int64)
        np.cumsum(lens, out=offsets[1:])
        words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), self.n, [None, pa.py_buffer(offsets), pa.py_buffer(letters)])
        coded = pc.dictionary_encode(words)
        self.ids = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        names = coded.dictionary.to_pylist()
        self.n_ids = max(len(names), 1)
        hashes = np.array([zlib.crc32(w) << 32 | zlib.crc32(w, 7) for w in names], np.uint64)
        self.hashes = hashes[self.ids] if self.n else np.zeros(0, np.uint64)
        self.first = offsets[:-1] + np.arange(self.n)  # places in the normal form
        self.last = self.first + lens
        form = np.empty(len(letters) + self.n, np.uint8)
        form[np.arange(len(letters)) + np.repeat(np.arange(self.n), lens)] = letters
        form[self.last] = np.where(self.joined, 32, 10)
        self.form = form.tobytes()

    def windows(self, k: int) -> np.ndarray:
        """Hash of the k words from each place on."""
        out = self.hashes.copy()
        for j in range(1, k):
            out[:self.n - j] = _mixed(out[:self.n - j]) + self.hashes[j:]
        return _mixed(out)


def _parser(window: int, modulus: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lang = batch.column("lang")
            for i, _, data, ends in byte_slices(batch.column("text"), _SLICE):
                w = _Words(data, ends)
                if not w.n:
                    continue
                opens = np.ones(w.n, bool)  # the first word of each text
                opens[1:] = w.text[1:] != w.text[:-1]
                whole = np.zeros(w.n, bool)
                whole[:w.n - window + 1] = w.text[:w.n - window + 1] == w.text[window - 1:]
                begins = np.flatnonzero(opens | (whole & (w.windows(window) % np.uint64(modulus) == 0)))
                final = np.ones(len(begins), bool)
                final[:-1] = opens[begins[1:]]
                nexts = np.append(begins[1:], w.n)
                stops = np.where(final, w.last[nexts - 1] + 1, w.last[np.minimum(nexts + window - 1, w.n - 1)])
                chunks = [w.form[a:b] for a, b in zip(w.first[begins].tolist(), stops.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [lang.take(pa.array(i + w.text[begins])), pa.array(chunks, pa.binary()).cast(pa.string())], ["lang", "chunk"])

    return run


def parse(docs: DataFrame, longest: int = 3, modulus: int = 16) -> DataFrame:
    """Dictionary of the parse of ``docs`` (lang, text): lang, chunk, freq.

    A null text is empty, a null language ``und``. The chunk of a text's end closes with a line
    feed, others don't. The expected chunk has ``modulus`` words; a text in which no window
    triggers is one chunk, so a chunk is never larger than its text.
    """
    texts = packed(docs).select(F.coalesce(F.col("row.lang").cast("string"), F.lit("und")).alias("lang"), text_of().alias("text"))
    chunks = texts.mapInArrow(_parser(longest - 1, modulus), "lang string, chunk string")
    return chunks.groupBy("lang", "chunk").agg(F.count("*").alias("freq"))


def _counter(window: int, lengths: tuple[int, ...], frequent=None):
    """N-grams owned by chunks, summed over some megabytes of chunks at a time.

    ``frequent``, a broadcast bitmap of the hashes of frequent (k-1)-grams, lets an n-gram
    pass only if both of its (k-1)-grams are in it.
    """

    def counted(lang: pa.Array, chunk: pa.Array, freq: np.ndarray) -> Iterator[pa.RecordBatch]:
        langs = pc.dictionary_encode(lang)
        lang_ids = langs.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        names = langs.dictionary
        salts = np.array([zlib.crc32(x.encode()) for x in names.to_pylist()], np.uint64)
        for i, j, data, ends in byte_slices(chunk, _SLICE):
            w = _Words(data, ends)
            final = data[ends - 1] == 10
            of = lang_ids[i:j][w.text]
            weight = freq[i:j][w.text]
            until = np.searchsorted(w.text, np.arange(j - i), "right")  # end of each chunk's words
            own = np.arange(w.n) < np.where(final, until, until - window)[w.text]
            total = np.bincount(of[own], weights=weight[own], minlength=len(names))
            if 1 in lengths:
                yield out(names, np.arange(len(names)), [""] * len(names), total)
            keys, whole = of * w.n_ids + w.ids, np.ones(w.n, bool)
            for k in range(1, max(lengths) + 1):
                if k > 1:
                    _, keys = np.unique(keys[:-1], return_inverse=True)
                    keys = keys * w.n_ids + w.ids[k - 1:]
                    whole = whole[:-1] & w.joined[k - 2:w.n - 1]
                if k not in lengths:
                    continue
                take = whole & own[:len(whole)]
                if frequent is not None:
                    bits = frequent.value
                    place = bitmap_place(w.windows(k - 1), salts[of], len(bits) * 8)
                    there = (bits[place >> 3] >> (place & 7).astype(np.uint8)) & 1 == 1
                    take &= there[:len(take)] & there[1:len(take) + 1]
                at = np.flatnonzero(take)
                if len(at):
                    _, one, which = np.unique(keys[at], return_index=True, return_inverse=True)
                    sums = np.bincount(which, weights=weight[at])
                    places = at[one]
                    texts = [w.form[a:b] for a, b in zip(w.first[places].tolist(), w.last[places + k - 1].tolist())]
                    yield out(names, of[places], texts, sums)

    def out(names, of, texts, sums):
        texts = pa.array(texts, pa.string()) if isinstance(texts[0], str) else pa.array(texts, pa.binary()).cast(pa.string())
        return pa.RecordBatch.from_arrays([names.take(pa.array(of)), texts, pa.array(sums.astype(np.int64))], ["lang", "phrase", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            held.append(batch)
            size += batch.nbytes
            if size >= _SLICE:
                yield from flushed(held)
                held, size = [], 0
        if held:
            yield from flushed(held)

    def flushed(held):
        t = pa.Table.from_batches(held).combine_chunks()
        if t.num_rows:
            yield from counted(t.column("lang").combine_chunks(), t.column("chunk").combine_chunks(), t.column("freq").to_numpy())

    return run


def bitmap_place(windows: np.ndarray, salts: np.ndarray, bits: int) -> np.ndarray:
    return (_mixed(windows + salts * _MUL) & np.uint64(bits - 1)).astype(np.int64)


def _bitmap(phrases: DataFrame, length: int, bits: int):
    """Broadcast bitmap of ``bits`` bits over the phrases' hashes; its size doesn't depend on their number."""

    def places(batches):
        for batch in batches:
            for i, j, data, ends in byte_slices(batch.column("phrase"), _SLICE):
                w = _Words(data, ends)
                salts = np.array([zlib.crc32(x.encode()) for x in batch.column("lang").slice(i, j - i).to_pylist()], np.uint64)
                first = np.searchsorted(w.text, np.arange(j - i))
                place = bitmap_place(w.windows(length)[first], salts, bits)
                yield pa.RecordBatch.from_arrays([pa.array(place >> _BLOCK), pa.array(place & (1 << _BLOCK) - 1)], ["block", "place"])

    def pack(batches):
        for batch in batches:
            out = []
            for block in batch.column("places").to_pylist():
                flags = np.zeros(1 << _BLOCK, np.uint8)
                flags[block] = 1
                out.append(np.packbits(flags, bitorder="little").tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("block"), pa.array(out, pa.binary())], ["block", "bits"])

    blocks = phrases.select("lang", "phrase").mapInArrow(places, "block long, place long").groupBy("block").agg(F.collect_set("place").alias("places"))
    out = np.zeros(bits // 8, np.uint8)
    width = 1 << _BLOCK - 3
    for r in blocks.mapInArrow(pack, "block long, bits binary").toLocalIterator():
        out[r.block * width:(r.block + 1) * width] = np.frombuffer(r.bits, np.uint8)
    return phrases.sparkSession.sparkContext.broadcast(out)


def phrase_counts(docs: DataFrame, longest: int = 3, least: int = 10, modulus: int = 16, bits: int = 1 << 27) -> DataFrame:
    """lang, phrase, n of every phrase of up to ``longest`` words found at least ``least`` times.

    The row with an empty phrase has the number of all words of a language. From three words
    on, only n-grams whose two parts are frequent are counted; the parts are looked up in a
    bitmap of ``bits`` bits (a power of two), whose false hits only cost time.
    """
    chunks = stored(parse(docs, longest, modulus))
    spread = "lang string, phrase string, n long"

    def level(lengths, frequent=None):
        counts = chunks.mapInArrow(_counter(longest - 1, lengths, frequent), spread).groupBy("lang", "phrase").agg(F.sum("n").alias("n"))
        return stored(counts.where((F.col("n") >= least) | (F.col("phrase") == "")))

    out = last = level((1, 2))
    for k in range(3, longest + 1):
        shorter = last.where(_n_words(F.col("phrase")) == k - 1)
        last = level((k,), _bitmap(shorter, k - 1, bits))
        out = out.unionByName(last)
    return out


def _n_words(phrase: Column) -> Column:
    return F.length(phrase) - F.length(F.translate(phrase, " ", "")) + F.lit(1)


def collocations(docs: DataFrame, longest: int = 3, least: int = 10, inside: int = 50, top: int = 2000, salts: int = 8, **settings) -> DataFrame:
    """The ``top`` phrases of 2 to ``longest`` words of each language: lang, rank, phrase, a, l, r, n, score.

    ``docs`` needs lang and text. A phrase found a times is scored by its weakest cut, with l
    and r the counts of both sides: floor(10^6 a² / (l r)), in exact decimals. Phrases inside a
    longer one that has at least ``inside`` percent of their count are dropped. Ties go by count,
    then by phrase. Rows without words add nothing; an empty table gives an empty one; repeated
    rows count as often as they are there.

    One-word sides, which may be part of very many phrases, are joined over ``salts`` copies.
    Only candidates with one more word need be looked at for the dropping: whatever lies in a
    longer one lies in one of those, which is at least as frequent.
    """
    counts = phrase_counts(docs, longest, least, **settings)
    words = F.split("phrase", " ")
    found = counts.where("phrase != ''").select("lang", "phrase", "n", words.alias("words"), F.size(words).alias("k"))
    longer = found.where("k > 2").select("lang", F.col("n").alias("of"), F.explode(F.array(
        F.array_join(F.slice("words", 1, F.col("k") - 1), " "), F.array_join(F.slice("words", 2, F.col("k") - 1), " "))).alias("phrase"))
    longer = longer.groupBy("lang", "phrase").agg(F.max("of").alias("of"))
    kept = found.where("k > 1").join(longer, ["lang", "phrase"], "left").where(
        F.col("of").isNull() | (F.lit(100).cast("decimal(20,0)") * F.col("of") < F.lit(inside).cast("decimal(20,0)") * F.col("n")))
    cuts = kept.select("lang", "phrase", F.col("n").alias("a"), "words", F.explode(F.sequence(F.lit(1), F.col("k") - 1)).alias("cut"))
    cuts = cuts.select("lang", "phrase", "a", "cut", F.array_join(F.slice("words", 1, F.col("cut")), " ").alias("left"),
                       F.array_join(F.slice("words", F.col("cut") + 1, F.size("words")), " ").alias("right"))
    one = F.when(F.col("k") == 1, F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    sides = found.where(F.col("k") < longest).select("lang", F.col("phrase").alias("side"), "n", F.explode(one).alias("salt"))
    for side, name in (("left", "l"), ("right", "r")):
        salt = F.when(F.instr(side, " ") == 0, F.pmod(F.xxhash64("phrase"), F.lit(salts))).otherwise(F.lit(0)).cast("int")
        cuts = cuts.withColumn("salt", salt).withColumnRenamed(side, "side").join(
            sides.withColumnRenamed("n", name), ["lang", "side", "salt"]).drop("side", "salt")
    a, l, r = (f"cast({c} as decimal(18, 0))" for c in "alr")
    cuts = cuts.withColumn("score", F.expr(f"(1000000BD * {a} * {a}) div ({l} * {r})").cast("long"))
    weakest = cuts.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "cut", "l", "r")).alias("w"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("w.score"), F.desc("a"), "phrase"))
    best = weakest.withColumn("rank", rank).where(F.col("rank") <= top)
    total = counts.where("phrase = ''").select("lang", F.col("n").alias("total"))
    return best.join(total, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "w.l", "w.r", F.col("total").alias("n"), "w.score")


_SQL = """
WITH low AS (SELECT coalesce(lang, 'und') AS lang, doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
pieces AS (SELECT lang, row_number() OVER () AS id, regexp_extract_all(piece, '[^ \\t]+') AS w
  FROM (SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\\n\\x0b\\x0c\\r]')) AS piece FROM low)),
places AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM pieces WHERE len(w) > 0),
grams AS (SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase FROM places, (VALUES (1), (2), (3)) AS s(k) WHERE i + k - 1 <= len(w)),
f AS (SELECT lang, k, phrase, count(*) AS n FROM grams GROUP BY ALL),
totals AS (SELECT lang, sum(n)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang),
cand AS (SELECT lang, k, phrase, n AS a, string_split(phrase, ' ') AS w FROM f WHERE k > 1 AND n >= 10),
inside AS (SELECT lang, p AS phrase, max(a) AS of FROM (
  SELECT lang, a, unnest([w[1] || ' ' || w[2], w[2] || ' ' || w[3]]) AS p FROM cand WHERE k = 3) GROUP BY ALL),
kept AS (SELECT c.* FROM cand c LEFT JOIN inside i ON c.lang = i.lang AND c.phrase = i.phrase AND c.k = 2 WHERE i.of IS NULL OR 100 * i.of < 50 * c.a),
cuts AS (SELECT lang, phrase, a, 1 AS cut, w[1] AS lp, array_to_string(w[2:], ' ') AS rp FROM kept
  UNION ALL SELECT lang, phrase, a, 2, w[1] || ' ' || w[2], w[3] FROM kept WHERE k = 3),
scored AS (SELECT c.lang, c.phrase, c.a, c.cut, x.n AS l, y.n AS r, ((1000000::HUGEINT * c.a * c.a) // (x.n::HUGEINT * y.n))::BIGINT AS score
  FROM cuts c JOIN f x ON x.lang = c.lang AND x.phrase = c.lp JOIN f y ON y.lang = c.lang AND y.phrase = c.rp),
weakest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM weakest)
SELECT r.lang, r.rank, r.phrase, r.a, r.l, r.r, t.n, r.score FROM ranked r JOIN totals t ON t.lang = r.lang WHERE r.rank <= 2000
"""


@query("op12_phrases", _SQL)
def op12_phrases(spark, sf_dir):
    """Collocations of two and three words per language."""
    return collocations(read(spark, sf_dir, "documents").select("lang", "text"))
