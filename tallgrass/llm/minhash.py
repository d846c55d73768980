"""Near-duplicate documents: consistent weighted sampling over TF-IDF shingles, banded and verified.

1. A shingle is five words in a row (all words of a shorter text), lower-cased. Its weight in
   a document is its count times ``log(1 + N / df)``. Document frequencies count one text of each
   rough class, so that a large group of near copies doesn't make the shingles it shares light:
   ``SKETCH`` unweighted min-hashes of a text name as many groups, it is of the class of the
   largest, and the smallest text of a class stands for it. They are counted by ``2**BUCKETS``
   hash buckets (the hashing trick), a table of fixed size.
2. Improved consistent weighted sampling draws ``BANDS * ROWS`` shingles of each text; two texts
   draw the same one with the probability of their weighted Jaccard similarity. Rows of a band
   make a bucket, and so does the class of the total weight: texts at 0.8 or more are in the
   same class or the next, and each text goes to both.
3. Equal texts are one node. In every bucket the nodes are verified against a pivot, the one
   with the most company. Links make components; a bucket whose nodes are all in one
   component is done. Weighted Jaccard distance is a metric, so nodes beyond 0.4 from the
   pivot can't link to nodes within 0.2 of it: with none in between, what is left splits into
   two smaller buckets. In each, the nodes outside the pivot's component are tested against
   all others, in blocks; only links that join components leave a block.
4. Classes are the components; a class is named by its smallest doc_id.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallgrass.llm.common import packed, stored, text_of
from tallgrass.llm.registry import query
from tallgrass.queries import read

WORDS, BANDS, ROWS, BUCKETS, SKETCH = 5, 9, 3, 16, 8
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_RNG = np.random.default_rng(11)
_LETTERS = _RNG.integers(1, 1 << 63, 256, dtype=np.uint64)
_PLACES = _RNG.integers(1, 1 << 63, WORDS, dtype=np.uint64) | np.uint64(1)
_SEEDS = _RNG.integers(1, 1 << 63, 256, dtype=np.uint64)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(9, 14)]] = True
_PIECE = 1 << 18
_POWERS: dict = {}
_TABLES: dict = {}


def _powers(base: int, n: int) -> np.ndarray:
    if len(_POWERS.get(base, ())) < n:
        steps = np.full(max(n, _PIECE + 4096), base, np.uint64)
        steps[0] = 1
        _POWERS[base] = np.cumprod(steps, dtype=np.uint64)
    return _POWERS[base][:n]


def mixed(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(31))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


def word_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and start of every word of a text, in pieces that end at white space."""
    hashes, starts, at = [], [], 0
    while at < len(data):
        end = min(len(data), at + _PIECE)
        while end < len(data) and not _SPACE[data[end]]:
            end += 1
        piece = data[at:end]
        word = np.r_[False, ~_SPACE[piece], False]
        edge = np.flatnonzero(word[1:] != word[:-1])
        first, last = edge[::2], edge[1::2]
        sums = np.zeros(len(piece) + 1, np.uint64)
        np.cumsum(_LETTERS[piece] * _powers(_BASE, len(piece)), out=sums[1:])
        hashes.append(mixed((sums[last] - sums[first]) * _powers(_INVERSE, len(piece) + 1)[first]))
        starts.append(first + at)
        at = end
    return (np.concatenate(hashes), np.concatenate(starts)) if hashes else (np.zeros(0, np.uint64), np.zeros(0, np.int64))


def shingles(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text number, shingle and count of every distinct shingle of each text, sorted by both."""
    data = np.frombuffer(b"\n".join(texts), np.uint8)
    begins = np.cumsum([0, *(len(t) + 1 for t in texts)])
    h, starts = word_hashes(data)
    owner = np.searchsorted(begins, starts, side="right") - 1
    words = np.bincount(owner, minlength=len(texts)) if len(owner) else np.zeros(len(texts), np.int64)
    ends = np.cumsum(words)
    # the first word of each shingle; a text of fewer words has one that takes them all
    some = np.flatnonzero(np.arange(len(h)) + WORDS <= ends[owner]) if len(h) else np.zeros(0, np.int64)
    total = np.zeros(len(some), np.uint64)
    for j in range(WORDS):
        total += h[some + j] * _PLACES[j]
    doc = owner[some]
    short = np.flatnonzero((words > 0) & (words < WORDS))
    if len(short):
        brief = np.array([sum(int(h[ends[d] - words[d] + j]) * int(_PLACES[j]) for j in range(words[d])) % (1 << 64) for d in short], np.uint64)
        total, doc = np.r_[total, brief], np.r_[doc, short]
    total = mixed(total)
    order = np.lexsort((total, doc))
    total, doc = total[order], doc[order]
    new = np.flatnonzero(np.r_[True, (total[1:] != total[:-1]) | (doc[1:] != doc[:-1])]) if len(total) else np.zeros(0, np.int64)
    return doc[new], total[new], np.diff(np.r_[new, len(total)])


def bucket_of(shingle: np.ndarray) -> np.ndarray:
    return (shingle >> np.uint64(64 - BUCKETS)).astype(np.int64)


def _tables() -> tuple[np.ndarray, np.ndarray]:
    """Quantiles of the Gamma(2, 1) distribution at 2**16 midpoints, and their logarithms."""
    if not _TABLES:
        x = np.geomspace(1e-4, 40, 400_000)
        at = (np.arange(1 << 16) + 0.5) / (1 << 16)
        gamma = np.interp(at, -np.expm1(-x) - x * np.exp(-x), x)
        _TABLES["gamma"], _TABLES["log"] = gamma, np.log(gamma)
    return _TABLES["gamma"], _TABLES["log"]


def samples(doc: np.ndarray, shingle: np.ndarray, weight: np.ndarray, n: int) -> np.ndarray:
    """Improved consistent weighted samples: a row for each text with shingles, a column for each of ``n`` draws.

    Draw k takes r, c ~ Gamma(2, 1) and b ~ U(0, 1) from the shingle's k-th hash; with
    t = floor(log w / r + b), the text's sample is the (shingle, t) of the least c / exp(r (t - b) + r).
    """
    gamma, log_gamma = _tables()
    first = np.flatnonzero(np.r_[True, doc[1:] != doc[:-1]])
    each = np.diff(np.r_[first, len(doc)])
    log_weight = np.log(weight)
    out = np.empty((len(first), n), np.uint64)
    low, bits = np.uint64(0xFFFF), [np.uint64(b) for b in (16, 32)]
    for k in range(n):
        h = mixed(shingle ^ _SEEDS[k])
        r = gamma[h & low]
        b = ((h >> bits[1]) & low).astype(np.float64) * 2.0**-16
        t = np.floor(log_weight / r + b)
        value = log_gamma[(h >> bits[0]) & low] - r * (t - b + 1)
        best = np.flatnonzero(value == np.repeat(np.minimum.reduceat(value, first), each))
        best = best[np.r_[True, doc[best[1:]] != doc[best[:-1]]]]
        out[:, k] = mixed(shingle[best] + t[best].astype(np.int64).astype(np.uint64) * np.uint64(_BASE))
    return out


def _text_batches(batches: Iterator[pa.RecordBatch], most: int = 1 << 21):
    """(ids, lower-cased texts as bytes) of about ``most`` bytes at a time; one long text may be more."""
    for batch in batches:
        ids, texts, held = [], [], 0
        for i, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            data = text.as_py().lower().encode()
            ids.append(i)
            texts.append(data)
            held += len(data)
            if held >= most:
                yield ids, texts
                ids, texts, held = [], [], 0
        if ids:
            yield ids, texts


def _buckets(batches):
    """The distinct buckets of each text's shingles, two bytes each, and its min-hashes."""
    for ids, texts in _text_batches(batches):
        doc, shingle, _ = shingles(texts)
        pair = np.unique(doc.astype(np.int64) << BUCKETS | bucket_of(shingle))
        cuts = np.searchsorted(pair >> BUCKETS, np.arange(len(ids) + 1))
        held = (pair & ((1 << BUCKETS) - 1)).astype("<u2")
        first = np.flatnonzero(np.r_[True, doc[1:] != doc[:-1]]) if len(doc) else np.zeros(0, np.int64)
        least = np.stack([mixed(np.minimum.reduceat(mixed(shingle ^ _SEEDS[220 + k]), first) + _SEEDS[220 + k]) if len(doc) else np.zeros(0, np.uint64)
                          for k in range(SKETCH)], axis=1)
        has = np.isin(np.arange(len(ids)), doc[first])
        keys = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(has * SKETCH)].astype(np.int32)), pa.array(least.ravel().view(np.int64)))
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array([held[s:e].tobytes() for s, e in zip(cuts, cuts[1:])], pa.binary()), keys],
                                         names=["node", "buckets", "keys"])


def _one_of_each(seen: DataFrame, salts: int = 16) -> DataFrame:
    """``seen`` (node, buckets, keys) without the texts that another one stands for.

    A min-hash may be that of a third of all texts, so how many have it is joined over ``salts`` copies.
    """
    salt = F.pmod(F.xxhash64("node"), F.lit(salts)).cast("int").alias("salt")
    sketch = seen.select("node", salt, F.explode("keys").alias("key"))
    company = sketch.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    company = company.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    rough = stored(sketch.join(company, ["key", "salt"]).groupBy("node").agg(F.max(F.struct("n", "key")).alias("of")).select("node", "of.key"))
    standing = rough.groupBy("key").agg(F.min("node").alias("node")).select("node")
    return seen.join(rough.select("node").join(standing, "node", "left_anti"), "node", "left_anti")


def _frequencies(batches):
    """Texts, and those by bucket, of one task; -1 stands for all of them."""
    n, counts = 0, np.zeros(1 << BUCKETS, np.int64)
    for batch in batches:
        counts += np.bincount(np.frombuffer(b"".join(batch.column("buckets").to_pylist()), "<u2"), minlength=1 << BUCKETS)
        n += batch.num_rows
    some = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(np.r_[-1, some], pa.int32()), pa.array(np.r_[n, counts[some]], pa.int64())], names=["bucket", "n"])


def _banded(idf):
    step = np.log(1.25) * (1 + 1e-9)

    def run(batches):
        weights = idf.value
        for ids, texts in _text_batches(batches):
            doc, shingle, count = shingles(texts)
            if not len(doc):
                continue
            weight = count * weights[bucket_of(shingle)]
            drawn = samples(doc, shingle, weight, BANDS * ROWS)
            first = np.flatnonzero(np.r_[True, doc[1:] != doc[:-1]])
            size = np.floor(np.log(np.add.reduceat(weight, first)) / step).astype(np.int64)
            node = np.array(ids, np.int64)[doc[first]]
            keys = []
            for band in range(BANDS):
                key = np.full(len(first), _SEEDS[200 + band], np.uint64)
                for row in range(ROWS):
                    key = mixed(key * np.uint64(_BASE) + drawn[:, band * ROWS + row])
                keys += [mixed(key + (size + shift).astype(np.uint64) * np.uint64(_BASE)) for shift in (0, 1)]
            yield pa.RecordBatch.from_arrays([pa.array(np.tile(node, len(keys))), pa.array(np.concatenate(keys).view(np.int64))], names=["node", "key"])

    return run


def _vectors(batches):
    for ids, texts in _text_batches(batches):
        doc, shingle, count = shingles(texts)
        cuts = np.searchsorted(doc, np.arange(len(ids) + 1))
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), pa.array([shingle[s:e].tobytes() for s, e in zip(cuts, cuts[1:])], pa.binary()),
             pa.array([b"" if (count[s:e] == 1).all() else count[s:e].astype("<u4").tobytes() for s, e in zip(cuts, cuts[1:])], pa.binary())],
            names=["node", "shingles", "counts"])


def weighted_jaccard(a: tuple, b: tuple, idf: np.ndarray) -> float:
    """Sum of the smaller weights over the sum of the larger; (sorted shingles, counts) each."""
    (sa, ca), (sb, cb) = a, b
    wa, wb = ca * idf[bucket_of(sa)], cb * idf[bucket_of(sb)]
    if not len(sa) or not len(sb):
        return 0.0
    at = np.minimum(np.searchsorted(sb, sa), len(sb) - 1)
    hit = sb[at] == sa
    both = np.minimum(wa[hit], wb[at[hit]]).sum()
    return float(both / (wa.sum() + wb.sum() - both))


def _scored(idf):
    def run(batches):
        for batch in batches:
            got, kept = [], {}
            columns = [batch.column(c).to_pylist() for c in ("a", "b", "sa", "ca", "sb", "cb")]
            for a, b, sa, ca, sb, cb in zip(*columns):
                if b not in kept:
                    kept = {b: _unpacked(sb, cb)}
                got.append(weighted_jaccard(_unpacked(sa, ca), kept[b], idf.value))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(got, pa.float64())], names=["a", "b", "likeness"])

    return run


def _unpacked(s: bytes, c: bytes) -> tuple[np.ndarray, np.ndarray]:
    s = np.frombuffer(s, "<u8")
    return s, np.frombuffer(c, "<u4") if c else np.ones(len(s))


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node of ``links`` (a, b); a component is named by its smallest node.

    Every node takes the smallest name around it, then its name's name, until none changes.
    """
    both = stored(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    names = stored(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("component")))
    while True:
        around = both.join(names.select(F.col("node").alias("b"), "component"), "b").groupBy(F.col("a").alias("node")).agg(F.min("component").alias("near"))
        nearer = names.join(around, "node").select("node", "component", F.least("component", "near").alias("next"))
        further = names.select(F.col("node").alias("next"), F.col("component").alias("jump"))
        moved = stored(nearer.join(further, "next", "left").select("node", "component", F.least("next", "jump").alias("now")))
        done = moved.where("now <> component").isEmpty()
        names = moved.select("node", F.col("now").alias("component"))
        if done:
            return names


def _verified(pairs: DataFrame, vectors: DataFrame, idf) -> DataFrame:
    """Distinct ``pairs`` (a, b) with their weighted Jaccard similarity."""
    a = vectors.select(F.col("node").alias("a"), F.col("shingles").alias("sa"), F.col("counts").alias("ca"))
    b = vectors.select(F.col("node").alias("b"), F.col("shingles").alias("sb"), F.col("counts").alias("cb"))
    return pairs.join(a, "a").join(b, "b").select("a", "b", "sa", "ca", "sb", "cb").mapInArrow(_scored(idf), "a long, b long, likeness double")


def _linker(idf, threshold: float):
    """Links among the members of each group in a unit that join components not joined yet."""

    def run(key, table):
        columns = {c: np.array(table.column(c).to_pylist()) for c in ("group", "role", "node", "component")}
        vectors = [_unpacked(s, c) for s, c in zip(table.column("shingles").to_pylist(), table.column("counts").to_pylist())]
        a, b = [], []
        for group in np.unique(columns["group"]):
            mine = np.flatnonzero(columns["group"] == group)
            mine = mine[np.argsort(columns["node"][mine], kind="stable")]
            rows, tested = mine[columns["role"][mine] != 1], mine[columns["role"][mine] != 0]
            for x, y in linked(vectors, rows, tested, columns["component"], idf.value, threshold):
                a.append(columns["node"][x])
                b.append(columns["node"][y])
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return run


def linked(vectors: list, rows: np.ndarray, tested: np.ndarray, component: np.ndarray, idf: np.ndarray, threshold: float):
    """Pairs of a tested vector and a row at ``threshold`` or more, as long as they join components.

    A shingle found n times is n features of its weight, so the smaller of two counts is a
    product of zeros and ones. Features that only one vector has can't be shared and are left out.
    """
    if not len(rows) or not len(tested):
        return
    every = np.unique(np.r_[rows, tested])
    place = {v: i for i, v in enumerate(every.tolist())}
    shingle = np.concatenate([vectors[v][0] for v in every])
    count = np.concatenate([vectors[v][1] for v in every]).astype(np.int64)
    owner = np.repeat(np.arange(len(every)), [len(vectors[v][0]) for v in every])
    total = np.bincount(owner, weights=count * idf[bucket_of(shingle)], minlength=len(every))
    nth = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    feature, owner = np.repeat(shingle, count) + nth.astype(np.uint64) * np.uint64(_BASE), np.repeat(owner, count)
    weight = np.repeat(idf[bucket_of(shingle)], count)
    _, code, found = np.unique(feature, return_inverse=True, return_counts=True)
    some = found[code] > 1
    _, code = np.unique(code[some], return_inverse=True)
    owner, weight = owner[some], weight[some]
    start = np.searchsorted(owner, np.arange(len(every) + 1))
    at = np.array([place[v] for v in rows.tolist()])
    own = np.concatenate([code[start[i]:start[i + 1]] for i in at])
    whose = np.repeat(np.arange(len(rows)), start[at + 1] - start[at])
    parent: dict = {}

    def find(x):
        while parent.get(x, x) != x:
            x = parent[x]
        return x

    scale = np.zeros(int(code.max()) + 1 if len(code) else 1)
    for t in tested.tolist():
        i = place[t]
        mine = slice(start[i], start[i + 1])
        scale[code[mine]] = weight[mine]
        both = np.bincount(whose, weights=scale[own], minlength=len(rows))
        scale[code[mine]] = 0
        for j in np.flatnonzero(both >= threshold * (total[i] + total[at] - both) * (1 - 1e-12)).tolist():
            x, y = find(int(component[t])), find(int(component[rows[j]]))
            if x != y:
                parent[max(x, y)] = min(x, y)
                yield t, rows[j]


def near_links(nodes: DataFrame, threshold: float = 0.8, block: int = 1024) -> DataFrame:
    """Components of near-duplicate texts: ``nodes`` (node, text; equal texts repeat) as (node, component).

    Nodes without a link have no row. What a bucket's pivot leaves open is finished in units of
    about ``block`` members: those outside the pivot's component are tested against all
    members. Small groups share units; a larger group is cut into blocks, and each block of
    tested members meets each block of members. No candidate is dropped.
    """
    spark = nodes.sparkSession
    seen = stored(nodes.mapInArrow(_buckets, "node long, buckets binary, keys array<long>").dropDuplicates(["node"]))
    counts = {r.bucket: r.n for r in _one_of_each(seen).select("node", "buckets").mapInArrow(_frequencies, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect()}
    frequency = np.zeros(1 << BUCKETS)
    for k, n in counts.items():
        if k >= 0:
            frequency[k] = n
    idf = spark.sparkContext.broadcast(np.log1p(counts.get(-1, 0) / np.maximum(1.0, frequency)))
    drawn = stored(nodes.mapInArrow(_banded(idf), "node long, key long").distinct())
    company = drawn.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    members = drawn.join(company, "key")
    rank = members.groupBy("node").agg(F.sum("n").alias("rank"))
    groups = stored(members.join(rank, "node").select("key", "node", "rank"))
    texts = nodes.dropDuplicates(["node"]).join(groups.select("node").distinct(), "node")
    vectors = stored(texts.select("node", "text").mapInArrow(_vectors, "node long, shingles binary, counts binary"))

    first = groups.groupBy("key").agg(F.max_by("node", F.struct("rank", "node")).alias("pivot"))
    placed = groups.join(first, "key").where("node <> pivot")
    scored = stored(_verified(placed.select(F.col("node").alias("a"), F.col("pivot").alias("b")).distinct(), vectors, idf))
    links = scored.where(F.col("likeness") >= threshold).select("a", "b")
    names = components(links)
    likeness = scored.select(F.col("a").alias("node"), F.col("b").alias("pivot"), "likeness")
    named = placed.join(likeness, ["node", "pivot"]).join(names, "node", "left").withColumn("component", F.coalesce("component", "node"))
    # within reach of the pivot's links, but not linked to it; without such nodes the links and the rest part
    between = (F.col("likeness") >= 2 * threshold - 1) & (F.col("likeness") < threshold)
    parted = named.groupBy("key").agg(F.max(between).alias("whole"))
    half = F.when(F.col("whole"), F.lit(0)).when(F.col("likeness") >= threshold, F.lit(1)).otherwise(F.lit(2))
    left = stored(named.join(parted, "key").select(F.xxhash64("key", half).alias("group"), "node", "rank", "component"))

    main = F.max_by("component", F.struct("rank", "node"))
    found = left.groupBy("group").agg(
        main.alias("main"), F.count(F.lit(1)).alias("n"), F.min("component").alias("lo"), F.max("component").alias("hi"),
        F.bit_xor(F.xxhash64("node")).alias("x"), F.bit_xor(F.xxhash64(F.lit(1), F.col("node"))).alias("y")).where("lo <> hi")
    # bands often leave the same nodes: one group of each set is enough
    found = found.groupBy("n", "x", "y").agg(F.min_by(F.struct("group", "main"), "group").alias("g")).select("g.group", "g.main", "n")
    open_ = stored(left.join(found, "group").select("group", "node", "component", "n", (F.col("component") != F.col("main")).alias("tested")))
    units = max(1, -(-open_.count() // block))
    small = open_.where(F.col("n") <= block).select(
        F.lit(-1).cast("long").alias("of"), F.pmod(F.xxhash64("group"), F.lit(units)).alias("u"), F.lit(0).cast("long").alias("v"),
        "group", "node", "component", F.when(F.col("tested"), F.lit(2)).otherwise(F.lit(0)).alias("role"))
    large = open_.where(F.col("n") > block)
    asked = large.where("tested").groupBy("group").agg(F.ceil(F.count(F.lit(1)) / block).alias("asked"))
    large = large.join(asked, "group").withColumn("held", F.ceil(F.col("n") / block))
    draw = F.xxhash64("node")
    rows = large.select(F.col("group").alias("of"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("asked") - 1)).alias("u"),
                        F.pmod(draw, F.col("held")).alias("v"), "group", "node", "component", F.lit(0).alias("role"))
    tests = large.where("tested").select(F.col("group").alias("of"), F.pmod(draw, F.col("asked")).alias("u"),
                                         F.explode(F.sequence(F.lit(0).cast("long"), F.col("held") - 1)).alias("v"), "group", "node", "component", F.lit(1).alias("role"))
    work = small.unionByName(rows).unionByName(tests).join(vectors, "node")
    more = stored(work.groupBy("of", "u", "v").applyInArrow(_linker(idf, threshold), "a long, b long"))
    return names if more.isEmpty() else components(links.unionByName(more))


def near_classes(docs: DataFrame, **settings) -> DataFrame:
    """``docs`` (doc_id, text) as ``row``, ``class_id``, ``class_size`` and ``kept``.

    Classes are components of weighted Jaccard similarity ``threshold`` (0.8) or more; equal
    texts are always in one class, and texts without a word only with their equals. ``class_id``
    is the smallest doc_id of the class (null ids last), ``class_size`` its number of rows, and
    ``kept`` marks its representative: the rows with that doc_id and the smallest digest of
    their text. A null text counts as an empty one. An empty table gives an empty table.

    Texts are known by a 64-bit digest. Copies meet pre-aggregated, and joins on a digest that
    a third of the rows have are ones that adaptive execution can split.
    """
    return _classes(docs, **settings).select("row", "class_id", "class_size", "kept")


def _classes(docs: DataFrame, **settings) -> DataFrame:
    """As ``near_classes``, with the class's ``component`` and the ``copies`` of its representative among the rows."""
    rows = packed(docs).select("row", F.col("row.doc_id").alias("id"), F.xxhash64(text_of()).alias("node"), text_of().alias("text"))
    linked = near_links(rows.select("node", "text"), **settings)
    # smallest id first, nulls last; then the digest
    best = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "node", "copies"))
    each = rows.groupBy("node", "id").agg(F.count(F.lit(1)).alias("copies")).groupBy("node").agg(best.alias("best"), F.sum("copies").alias("n"))
    named = each.join(linked, "node", "left").withColumn("component", F.coalesce("component", "node"))
    whole = named.groupBy("component").agg(F.min("best").alias("first"), F.sum("n").alias("class_size"))
    classes = named.select("node", "component").join(whole, "component").select(F.col("node").alias("of"), "component", "first", "class_size")
    joined = rows.select("row", "id", "node").join(classes, F.col("node") == F.col("of"))
    kept = F.col("id").eqNullSafe(F.col("first.id")) & (F.col("node") == F.col("first.node"))
    return joined.select("row", F.col("first.id").alias("class_id"), "class_size", kept.alias("kept"), "component", F.col("first.copies").alias("copies"))


def distinct_documents(docs: DataFrame, **settings) -> DataFrame:
    """One document of each class, one row of it; same columns.

    Rows with the same doc_id and text are copies of one document, any one of which stays.
    """
    kept = _classes(docs, **settings).where("kept")
    one = kept.where("copies = 1").select("row.*")
    return one.unionByName(kept.where("copies > 1").dropDuplicates(["component"]).select("row.*"))


@query("op1_minhash_near_dedup")
def op1_minhash_near_dedup(spark, sf_dir):
    """Near-duplicate class of every document."""
    out = near_classes(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("row.doc_id", "class_id", "class_size", "kept")
