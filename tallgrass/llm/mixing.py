"""Mixing sources to target weights by balanced sampling (the cube method)."""

from __future__ import annotations

import itertools

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallgrass.llm.common import WORD_CLASS, packed, salted_join, same, stored, text_of
from tallgrass.llm.registry import query
from tallgrass.queries import read

_EPS = 1e-9
_UNIT = "doc_id {kind}, source string, size long, base long, pi double"


def targets(totals: dict, weights: tuple = (3, 1, 2), share: float = 1.5, most: float = 2.0) -> dict:
    """Target size per source: ``share`` of all sizes by weight, at most ``most`` times the source's own.

    Sources take the weights in turn, by code point, a null source last. What a full source
    can't take goes to the others by their weights, until none is above its limit.
    """
    order = sorted(totals, key=lambda s: (s is None, s))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    rest, left, out = share * sum(totals.values()), list(order), {}
    while left:
        unit = rest / sum(weight[s] for s in left)
        full = [s for s in left if unit * weight[s] > most * totals[s]]
        if not full:
            out |= {s: unit * weight[s] for s in left}
            break
        out |= {s: most * totals[s] for s in full}
        rest -= sum(out[s] for s in full)
        left = [s for s in left if s not in out]
    return out


def flight(pi: np.ndarray, size: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Flight phase: move probabilities until at most two are strictly between 0 and 1.

    Three open units at a time move along the null space of the two balancing equations
    (their number, their sizes), so both totals stay what they were; each move rounds one.
    """
    pi, hand = pi.astype(float).tolist(), []
    size, draws = size.tolist(), rng.random(len(pi) + 3).tolist()
    todo = [i for i, p in enumerate(pi) if _EPS < p < 1 - _EPS]
    for i in todo:
        hand.append(i)
        while len(hand) > 2 or (len(hand) == 2 and size[hand[0]] == size[hand[1]]):
            if len(hand) > 2:
                a, b, c = (size[j] for j in hand[:3])
                move = (b - c, c - a, a - b) if not a == b == c else (1, -1, 0)
            else:
                move = (1, -1)
            scale = max(map(abs, move))
            move = [m / scale for m in move]
            up = min((1 - pi[j]) / m if m > 0 else -pi[j] / m for j, m in zip(hand, move) if m)
            down = min(pi[j] / m if m > 0 else (pi[j] - 1) / m for j, m in zip(hand, move) if m)
            step = up if draws.pop() * (up + down) < down else -down
            for j, m in zip(hand, move):
                pi[j] += step * m
            hand = [j for j in hand if _EPS < pi[j] < 1 - _EPS]
            if not draws:
                draws = rng.random(64).tolist()
    return np.array([0.0 if p <= _EPS else 1.0 if p >= 1 - _EPS else p for p in pi])


def landing(pi: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Landing phase: of the few open units, the rounding nearest to the size total they stand for."""
    open_ = np.flatnonzero((pi > 0) & (pi < 1))
    best = min(itertools.product((0.0, 1.0), repeat=len(open_)),
               key=lambda x: (abs(float(np.dot(np.array(x) - pi[open_], size[open_]))), x))
    out = pi.copy()
    out[open_] = best
    return out


def _level(last: bool, seed: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["draw", "doc_id", "size"], na_position="last").reset_index(drop=True)
        rng = np.random.default_rng([seed, int(pdf["draw"].iloc[0]) & 0x7FFFFFFF, len(pdf)])
        size = pdf["size"].to_numpy(dtype=float)
        pi = flight(pdf["pi"].to_numpy(dtype=float), size, rng)
        pdf["pi"] = landing(pi, size) if last else pi
        return pdf.drop(columns=["draw", "block"])

    return run


def decide(sizes: DataFrame, weights: tuple = (3, 1, 2), share: float = 1.5, most: float = 2.0,
           block: int = 4096, seed: int = 0) -> DataFrame:
    """Copies that the mix takes of every document: ``sizes`` (doc_id, source, size) as
    (doc_id, source, copies, source_size, target).

    A source whose target is ``r`` times its size takes floor(r) whole copies of each document;
    the fraction left is each document's inclusion probability for one more. Blocks of about
    ``block`` documents of a source (by a digest of the id, so a hot source has many blocks)
    run the flight phase on their own; the at most two open documents of each block meet in
    the next level's blocks, until one block per source lands. Levels are as many as the
    largest source needs. Same input, same result.

    Rows with the same doc_id and source are one unit and are taken together; nulls are values
    like any other. An empty table gives an empty table; sources of size 0 take nothing.
    Per-source totals are what the driver sees: one row a source, so sources must be few enough
    for it (some millions); joins with them are salted, as one source may hold most rows.
    """
    spark = sizes.sparkSession
    units = sizes.groupBy("doc_id", "source").agg(F.sum("size").alias("size"))
    kind = sizes.schema["doc_id"].dataType.simpleString()
    totals = {r.source: (int(r.total), int(r.n)) for r in units.groupBy("source").agg(
        F.sum("size").alias("total"), F.count(F.lit(1)).alias("n")).collect()}
    target = targets({s: t for s, (t, _) in totals.items()}, weights, share, most)
    table = spark.createDataFrame(
        [(s, t, target[s], int(target[s] // t) if t else 0, (target[s] / t) % 1 if t else 0.0) for s, (t, _) in totals.items()],
        "of string, source_size long, target double, base long, pi double")
    units = salted_join(units, table.select("of", "base", "pi"), {"source": "of"}, F.col("doc_id")).select("doc_id", "source", "size", "base", "pi")
    most_units = max([n for _, n in totals.values()], default=0)
    is_open = (F.col("pi") > 0) & (F.col("pi") < 1)
    done, level = None, 0
    while True:
        n_blocks = -(-most_units // block)
        draw = F.xxhash64(F.lit(seed + level), F.col("doc_id"), F.col("size"))
        # every source gets blocks of a like size: its own number of them, from its own count
        counts = spark.createDataFrame(
            [(s, max(1, -(-n // block) if level == 0 else n_blocks)) for s, (_, n) in totals.items()], "of string, n_blocks long")
        keyed = salted_join(units, counts, {"source": "of"}, F.col("doc_id")).select(
            *units.columns, draw.alias("draw"), F.pmod(draw, F.col("n_blocks")).alias("block"))
        last = n_blocks <= 1
        moved = keyed.groupBy("source", "block").applyInPandas(_level(last, seed), _UNIT.format(kind=kind))
        if last:
            done = moved if done is None else done.unionByName(moved)
            break
        moved = stored(moved)
        settled = moved.where(~is_open)
        done = settled if done is None else done.unionByName(settled)
        units, most_units, level = moved.where(is_open), 2 * n_blocks, level + 1
    copies = done.select("doc_id", "source", (F.col("base") + F.col("pi").cast("long")).alias("copies"))
    named = table.select("of", "source_size", "target")
    return salted_join(copies, named, {"source": "of"}, F.col("doc_id")).drop("of")


def sizes_of(docs: DataFrame) -> DataFrame:
    """(doc_id, source, size) of every row, size being its number of words (a null text has none)."""
    return packed(docs).select(F.col("row.doc_id").alias("doc_id"), F.col("row.source").cast("string").alias("source"),
                               F.regexp_count(text_of(), F.lit(WORD_CLASS)).cast("long").alias("size"))


def mix(docs: DataFrame, **settings) -> DataFrame:
    """``docs`` (doc_id, source, text) as the mix takes them: each row as often as :func:`decide` says."""
    chosen = decide(stored(sizes_of(docs)), **settings)
    chosen = chosen.where("copies > 0").select(F.col("doc_id").alias("id"), F.col("source").alias("of"), "copies")
    rows = packed(docs).select("row", F.col("row.doc_id").alias("key"), F.col("row.source").cast("string").alias("origin"))
    joined = rows.join(chosen, same(rows, chosen, {"key": "id", "origin": "of"}))
    return joined.select("row", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy")).select("row.*")


@query("op2_cube_mix")
def op2_cube_mix(spark, sf_dir):
    """Words that the mix takes of every document."""
    sizes = stored(sizes_of(read(spark, sf_dir, "documents").select("doc_id", "source", "text")))
    chosen = decide(sizes).withColumnsRenamed({"doc_id": "id", "source": "of"})
    return sizes.join(chosen, same(sizes, chosen, {"doc_id": "id", "source": "of"})).select(
        "doc_id", "source", "size", "source_size", "target", "copies", (F.col("size") * F.col("copies")).alias("taken"))
