"""Spelling variants: PartEnum signatures of letter multisets, joined and verified."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallgrass.llm.common import ascii_lower, packed, stored, text_of
from tallgrass.llm.registry import query
from tallgrass.queries import read

#: One edit changes at most two elements of a letter multiset.
DISTANCE = 2
_MUL = np.uint64(0x9E3779B97F4A7C15)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _MUL
    x = (x ^ (x >> np.uint64(29))) * _MUL
    return x ^ (x >> np.uint64(32))


def _halves(letters: np.ndarray, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Hash of ``size`` code points from ``begin`` on, for each word: a difference of running sums, moved to place 0."""
    powers = np.cumprod(np.full(len(letters) + 1, _MUL, np.uint64))
    sums = np.zeros(len(letters) + 1, np.uint64)
    np.cumsum(_mixed(letters + _MUL) * powers[:-1], out=sums[1:])
    inverse = np.cumprod(np.full(len(letters) + 1, np.uint64(pow(int(_MUL), -1, 1 << 64)), np.uint64))
    return (sums[begin + size] - sums[begin]) * inverse[begin]


def signatures(words: list[str], parts: int) -> tuple[np.ndarray, np.ndarray]:
    """Join keys of each word: as the shorter (or equally long) word of a pair, and as the longer one.

    A word's letters are a binary vector over (code point, how many before it); its dimensions
    are dealt to ``parts`` by hash. Vectors at a distance of two at most agree on all but two
    parts, so on the projection to one of the enumerated sets of ``parts - 2`` parts. Edits
    leave the first or the last half of the shorter word as it is (without its middle letter),
    so each signature is cut by both halves, and by the length of the shorter word.
    """
    lens = np.array([len(w) for w in words], np.int64)
    letters = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(np.uint64)
    begin = np.cumsum(lens) - lens
    of = np.repeat(np.arange(len(words)), lens)
    order = np.lexsort((letters, of))
    new = np.ones(len(order), bool)
    new[1:] = (letters[order][1:] != letters[order][:-1]) | (of[order][1:] != of[order][:-1])
    place = np.arange(len(order))
    nth = place - np.maximum.accumulate(np.where(new, place, 0))
    element = _mixed(letters[order] << np.uint64(32) | nth.astype(np.uint64))
    part = (element >> np.uint64(40)) % np.uint64(parts)
    sums = [np.add.reduceat(np.where(part == p, element, np.uint64(0)), begin) for p in range(parts)]
    sets = list(combinations(range(parts), parts - DISTANCE))
    projected = [_mixed(sum((_mixed(sums[p] + np.uint64(p)) for p in s), start=np.zeros(len(words), np.uint64)) + np.uint64(k))
                 for k, s in enumerate(sets)]
    out = []
    for longer in (0, 1):
        shorter = lens - longer
        half = shorter // 2
        sides = [_halves(letters, begin, half), _mixed(_halves(letters, begin + lens - half, half))]
        tags = [_mixed(x + _mixed(shorter.astype(np.uint64))) for x in sides]
        out.append(np.stack([_mixed(p + t) for p in projected for t in tags], axis=1).view(np.int64))
    return out[0], out[1]


def _spread(parts: int, longer: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            same, more = signatures(batch.column("word").to_pylist(), parts)
            for keys, flag in ((same, False), (more, True)) if longer else ((same, False),):
                row = pa.array(np.repeat(np.arange(batch.num_rows), keys.shape[1]))
                yield pa.RecordBatch.from_arrays([pa.array(keys.ravel()), batch.column("word").take(row), batch.column("n").take(row),
                                                  pa.array(np.full(len(row), flag))], ["key", "word", "n", "longer"])

    return run


def near_words(words: DataFrame, parts: int = 4) -> DataFrame:
    """Pairs of distinct ``words`` (word, n) that differ by one inserted, deleted or replaced code point.

    Returns word, n, near, near_n, once per unordered pair; the shorter word is on the left, of
    equally long ones the smaller. Candidates come from an equi-join on the signatures and are
    verified by their edit distance. ``words`` must hold each word once, no null, no empty one.
    """
    row = "key long, word string, n long, longer boolean"
    left = words.mapInArrow(_spread(parts, False), row).drop("longer")
    right = words.mapInArrow(_spread(parts, True), row).withColumnsRenamed({"word": "near", "n": "near_n"})
    close = left.join(right, "key").where((F.col("longer") | (F.col("word") < F.col("near"))) & (F.levenshtein("word", "near", 1) == 1))
    return close.select("word", "n", "near", "near_n").distinct()


def spelling_groups(words: DataFrame, ratio: int = 2, parts: int = 4) -> DataFrame:
    """``words`` (word, n) with form, root, n_near and form_n.

    ``form`` is the near word of the largest n (of equal ones the smallest word), if that is at
    least ``ratio`` times the word's n. ``root`` follows the forms to the last one: forms grow by
    ``ratio`` (2 or more), so there are no circles, and doubling the step makes the rounds the
    logarithm of that logarithm. Rows without a word are left out, repeated words are summed;
    an empty table gives an empty one.
    """
    if ratio < 2:
        raise ValueError("ratio must be at least 2")
    words = stored(words.where("word != ''").groupBy("word").agg(F.sum("n").cast("long").alias("n")))
    pairs = stored(near_words(words, parts))
    both = pairs.unionByName(pairs.select(F.col("near").alias("word"), F.col("near_n").alias("n"), F.col("word").alias("near"), F.col("n").alias("near_n")))
    best = both.groupBy("word", "n").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"))
    is_form = -F.col("best.less") >= ratio * F.col("n")
    best = stored(best.select("word", "n_near", F.when(is_form, F.col("best.near")).alias("form"), F.when(is_form, -F.col("best.less")).alias("form_n")))
    roots = best.where("form is not null").select("word", F.col("form").alias("root"))
    while True:
        ahead = roots.select(F.col("word").alias("root"), F.col("root").alias("ahead"))
        step = stored(roots.join(ahead, "root", "left").select("word", F.coalesce("ahead", "root").alias("root"), F.col("ahead").isNotNull().alias("moved")))
        roots = step.select("word", "root")
        if step.where("moved").isEmpty():
            break
    out = words.join(best, "word", "left").join(roots, "word", "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), "form_n")


def word_counts(docs: DataFrame, letters: int = 5, least: int = 3, misspelt: int = 97) -> DataFrame:
    """word, n: the runs of letters of ``docs`` (doc_id, text), A-Z lower-cased, one of ``misspelt`` with a letter taken out.

    Whether and where goes by the crc32 of ``<doc_id>:<run>``; a null doc_id is empty there, a
    null text has no runs. Words of at least ``letters`` code points found ``least`` times are
    returned.
    """
    runs = packed(docs).select(F.coalesce(F.col("row.doc_id").cast("string"), F.lit("")).alias("id"), F.explode(
        F.regexp_extract_all(ascii_lower(text_of()), F.lit("[A-Za-zÀ-ÿ]+"), F.lit(0))).alias("run"))
    runs = runs.select("run", F.crc32(F.concat("id", F.lit(":"), "run").cast("binary")).alias("h"))
    at = F.pmod("h", F.length("run")).cast("int")
    cut = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    words = runs.select(F.when(F.pmod("h", F.lit(misspelt)) == 0, cut).otherwise(F.col("run")).alias("word"))
    return words.where(F.length("word") >= letters).groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least)


@query("op13_spelling_groups")
def op13_spelling_groups(spark, sf_dir):
    """Words with their likeliest right form."""
    return spelling_groups(word_counts(read(spark, sf_dir, "documents").select("doc_id", "text")))
