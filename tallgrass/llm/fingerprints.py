"""Document fingerprints: a homomorphic multiset hash over paragraphs.

A paragraph's vector has ``CHECKS`` lanes of 32 bits, hashed from the whole paragraph, and
``MARKS`` lanes that count, over its shingles, those whose hash has the lane's bit set; one more
lane counts all shingles. A shingle is a word and the two after it in the paragraph (fewer at
its end); a word of more than ``PIECE`` code points is cut into several, so texts without
blanks have shingles too. A document's vector is the sum over its paragraphs, modulo 2^32.
So the order of paragraphs doesn't matter, and a paragraph is put in or taken out by adding
or subtracting its vector. Equal check lanes mean equal multisets of paragraphs; the cosine of
the mark lanes, as bits set less bits not set, estimates that of the shingles' counts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallgrass.llm.common import packed, same, stored, text_of
from tallgrass.llm.registry import query
from tallgrass.queries import read

CHECKS, MARKS, PIECE = 16, 128, 16
_MASK = (1 << 32) - 1
_PARAGRAPH, _WORD = "\n", f"[^\\x20\\x09-\\x0D]{{1,{PIECE}}}"


def shingles(paragraph: Column) -> Column:
    """Hashes of the shingles of a paragraph."""
    words = F.transform(F.regexp_extract_all(paragraph, F.lit(_WORD), F.lit(0)), lambda w: F.xxhash64(w))
    # as the element of an array, the words' hashes are worked out once
    return F.flatten(F.transform(F.array(words), lambda h: F.transform(h, lambda x, i: F.xxhash64(x, F.get(h, i + 1), F.get(h, i + 2)))))


def _units(text: Column) -> Column:
    """Paragraphs of a text (with no shingle), and their shingles (with no paragraph)."""
    paragraphs = F.split(text, _PARAGRAPH)
    none = F.lit(None)
    return F.concat(F.transform(paragraphs, lambda p: F.struct(p.alias("unit"), none.cast("long").alias("shingle"))),
                    F.transform(F.flatten(F.transform(paragraphs, shingles)), lambda s: F.struct(none.cast("string").alias("unit"), s.alias("shingle"))))


def vectors(texts: DataFrame, keys: list[str], text: str) -> DataFrame:
    """One row per key with ``checks`` and ``marks`` (longs, modulo 2^32).

    Texts are exploded to paragraphs and shingles, hashed and summed per task before the sums
    meet; every key has at least one paragraph, an empty text the empty one. Two mark lanes
    are summed in one long, which is exact below 2^32 shingles a key.
    """
    units = texts.select(*keys, F.explode(_units(F.col(text))).alias("u"))
    unit, shingle = F.col("u.unit"), F.col("u.shingle")
    hashes = [F.when(unit.isNull(), F.lit(0)).otherwise(F.xxhash64(F.lit(i), unit)) for i in range(CHECKS // 2)]
    bits = [F.when(shingle.isNull(), F.lit(0)).otherwise(F.xxhash64(F.lit(i), shingle)) for i in range(MARKS // 64)]
    hashed = units.select(*keys, F.when(shingle.isNull(), F.lit(0)).otherwise(F.lit(1)).alias("one"),
                          *[h.alias(f"h{i}") for i, h in enumerate(hashes)], *[b.alias(f"b{i}") for i, b in enumerate(bits)])
    checks = [F.sum(F.shiftrightunsigned(f"h{i // 2}", 32 * (i % 2)).bitwiseAND(F.lit(_MASK))) for i in range(CHECKS)]
    pairs = [F.sum(F.shiftrightunsigned(f"b{i // 32}", i % 32).bitwiseAND(F.lit(1 << 32 | 1))) for i in range(MARKS // 2)]
    sums = hashed.groupBy(*keys).agg(*[c.alias(f"c{i}") for i, c in enumerate(checks)], *[m.alias(f"m{i}") for i, m in enumerate(pairs)], F.sum("one").alias("n"))
    marks = [F.shiftrightunsigned(f"m{i}", shift) for shift in (0, 32) for i in range(MARKS // 2)]
    return sums.select(*keys, reduced([F.col(f"c{i}") for i in range(CHECKS)]).alias("checks"), reduced([*marks, F.col("n")]).alias("marks"))


def reduced(lanes: list[Column]) -> Column:
    return F.array(*[x.cast("long").bitwiseAND(F.lit(_MASK)) for x in lanes])


def combined(a: Column, b: Column, sign: int = 1) -> Column:
    """Lanes of ``a`` with those of ``b`` put in (``sign`` 1) or taken out (-1)."""
    return F.zip_with(a, b, lambda x, y: (x + sign * y).bitwiseAND(F.lit(_MASK)))


def insert(a_checks: Column, a_marks: Column, b_checks: Column, b_marks: Column) -> tuple[Column, Column]:
    """Vector of a document with the paragraphs of another put in."""
    return combined(a_checks, b_checks), combined(a_marks, b_marks)


def delete(a_checks: Column, a_marks: Column, b_checks: Column, b_marks: Column) -> tuple[Column, Column]:
    """Vector of a document with the paragraphs of another taken out."""
    return combined(a_checks, b_checks, -1), combined(a_marks, b_marks, -1)


def as_text(checks: Column, marks: Column) -> Column:
    """The vector in hexadecimal: 8 digits a lane, check lanes first."""
    return F.concat(F.array_join(F.transform(checks, lambda x: F.lpad(F.hex(x), 8, "0")), ""),
                    F.array_join(F.transform(marks, lambda x: F.lpad(F.hex(x), 8, "0")), ""))


def likeness(a_checks: Column, a_marks: Column, b_checks: Column, b_marks: Column) -> Column:
    """1 for equal check lanes; else the cosine of the mark lanes (bits set less bits not set), 0 at least."""
    def signed(x: Column) -> Column:
        return F.when(x > _MASK // 2, x - (_MASK + 1)).otherwise(x).cast("double")

    def lanes(x: Column) -> Column:
        n = signed(F.element_at(x, -1))
        return F.transform(F.slice(x, 1, MARKS), lambda p: 2 * signed(p) - n)

    def dot(x: Column, y: Column) -> Column:
        return F.aggregate(F.zip_with(x, y, lambda p, q: p * q), F.lit(0.0), lambda s, v: s + v)

    # as the element of an array, the lanes are worked out once
    both = F.element_at(F.transform(F.array(F.struct(lanes(a_marks).alias("a"), lanes(b_marks).alias("b"))), lambda x: F.struct(
        dot(x.a, x.b).alias("shared"), F.sqrt(dot(x.a, x.a) * dot(x.b, x.b)).alias("norm"))), 1)
    cosine = F.when(both["norm"] > 0, both["shared"] / both["norm"]).otherwise(F.lit(0.0))
    return F.when(a_checks == b_checks, F.lit(1.0)).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), cosine)))


def with_next(docs: DataFrame, n_ranges: int | None = None) -> DataFrame:
    """``docs`` (doc_id, text) as ``row``, ``text``, ``next_text`` and a unique key (``range``, ``place``).

    The next document is the one after in descending doc_id (ties by their texts' digests, a
    null doc_id last); the last one's is the first. Documents are cut into ranges of doc_id by
    quantiles, each range is one window partition, and only the first document of each range
    is carried to the range before it. A document alone is its own next.
    """
    spark = docs.sparkSession
    n_ranges = n_ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = packed(docs).select("row", F.col("row.doc_id").cast("long").alias("id"), text_of().alias("text"))
    probs = [i / n_ranges for i in range(1, n_ranges)]
    bounds = sorted(set(docs.select(F.col("doc_id").cast("double").alias("id")).approxQuantile("id", probs, 0.1 / n_ranges))) if probs else []
    # 0 for the largest ids; nulls come after all others
    above = F.size(F.filter(F.array(*[F.lit(b) for b in bounds]), lambda b: b >= F.col("id"))) if bounds else F.lit(0)
    # rows without an id go by their digests, so those are cut into ranges
    among = F.least(F.lit(n_ranges - 1), F.floor((F.xxhash64("text") / F.lit(2.0**64) + 0.5) * n_ranges))
    ranged = rows.select("*", F.when(F.col("id").isNull(), len(bounds) + 1 + among).otherwise(above).cast("int").alias("range"))
    order = [F.col("id").desc_nulls_last(), F.xxhash64("text"), F.col("text")]
    placed = ranged.select("*", F.row_number().over(Window.partitionBy("range").orderBy(*order)).alias("place"))
    firsts = ranged.groupBy("range").agg(F.min_by("text", F.struct((-F.col("id")).alias("id"), F.xxhash64("text").alias("h"), "text")).alias("_first"))
    return following(placed, firsts, "text", "next_text").select("row", "text", "next_text", "range", "place")


def following(placed: DataFrame, firsts: DataFrame, column: str, name: str) -> DataFrame:
    """``placed`` (range, place) with the ``column`` of the document after; the last one's is that of the first.

    ``firsts`` has it (``_first``) for the first document of each range.
    """
    inside = Window.partitionBy("range").orderBy("place")
    led = placed.withColumn("_inner", F.lead(column).over(inside))
    # one row per range
    around = Window.orderBy("range")
    whole = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    after = firsts.select(F.col("range").alias("_of"), F.coalesce(F.lead("_first").over(around), F.first("_first").over(whole)).alias("_outer"))
    joined = led.join(after, led["range"] == after["_of"], "left")
    return joined.withColumn(name, F.coalesce("_inner", "_outer")).drop("_inner", "_outer", "_of")


def edited(text: Column, other: Column) -> Column:
    """The last half of the code points replaced by the first as many (or all) of another text."""
    half = F.floor(F.length(text) / 2).cast("int")
    return F.concat(F.substring(text, F.lit(1), F.length(text) - half), F.substring(other, F.lit(1), half))


def fingerprints(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text) as ``row``, ``fingerprint``; a null text counts as an empty one."""
    rows = packed(docs).select("row", F.col("row.doc_id").alias("id"), text_of().alias("text"))
    keyed = rows.select("row", F.struct("id", F.xxhash64("text").alias("digest")).alias("key"), "text")
    found = vectors(keyed.dropDuplicates(["key"]), ["key"], "text").select(F.col("key").alias("of"), as_text(F.col("checks"), F.col("marks")).alias("fingerprint"))
    return keyed.join(found, same(keyed, found, {"key": "of"})).select("row", "fingerprint")


@query("op8_multiset_fingerprints")
def op8_multiset_fingerprints(spark, sf_dir):
    """Fingerprints of every document and of its edited text, and how alike they are."""
    base = with_next(read(spark, sf_dir, "documents").select("doc_id", "text"))
    change = base.select(F.col("row.doc_id").alias("doc_id"), "range", "place", "text", edited(F.col("text"), F.col("next_text")).alias("edited"))
    two = change.select(
        "range", "place", "doc_id", F.length("text").cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"),
        F.explode(F.array(*[F.struct(F.lit(i).alias("which"), F.col(c).alias("text")) for i, c in enumerate(("text", "edited"))])).alias("t"))
    keys = ["range", "place", "doc_id", "n_chars", "edited_sha256"]
    each = vectors(two.select(*keys, "t.which", "t.text"), [*keys, "which"], "text")

    def one(i: int) -> Column:
        return F.max(F.when(F.col("which") == i, F.struct("checks", "marks")))

    found = stored(each.groupBy(*keys).agg(one(0).alias("a"), one(1).alias("b")))
    sides = following(found, found.where("place = 1").select("range", F.col("a").alias("_first")), "a", "c")
    a, b, c = ((F.col(f"{x}.checks"), F.col(f"{x}.marks")) for x in "abc")
    return sides.select("doc_id", "n_chars", "edited_sha256", as_text(*a).alias("fingerprint"), as_text(*b).alias("edited_fingerprint"),
                        likeness(*a, *b).alias("near_edited"), likeness(*a, *c).alias("near_next"))
