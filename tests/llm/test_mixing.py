"""Cube-method mixing: totals, limits, determinism."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallgrass.llm import mixing

SF = "/root/testdata/sf0.01"


def test_targets_reshare_the_excess():
    # 390 to share; weights a 3, b 1, c 2, null 3: a (130) and the null source (130) are above twice their size
    got = mixing.targets({"a": 10, "b": 100, "c": 100, None: 50})
    assert got["a"] == 20
    assert got[None] == 100
    assert got["b"] == pytest.approx(90)
    assert got["c"] == pytest.approx(180)
    assert mixing.targets({}) == {}
    assert mixing.targets({"a": 0, "b": 4}) == {"a": 0.0, "b": 6.0}
    # by code point Z, a, null: 4.5 to share by 3, 1, 2; Z is full at 2, then 2.5 by 1 and 2
    got = mixing.targets({"Z": 1, "a": 1, None: 1})
    assert got["Z"] == 2
    assert got["a"] == pytest.approx(2.5 / 3)
    assert got[None] == pytest.approx(5 / 3)


def brute_targets(sizes):
    """Sources fill up one after another: the unit of weight rises until all is shared or all are full."""
    order = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    whole, low, high = 1.5 * sum(sizes.values()), 0.0, 2.0 * sum(sizes.values()) + 1
    for _ in range(200):
        unit = (low + high) / 2
        if sum(min(unit * weight[s], 2 * sizes[s]) for s in order) < whole:
            low = unit
        else:
            high = unit
    return {s: min(high * weight[s], 2 * sizes[s]) for s in order}


def test_targets_of_the_query(spark):
    import re

    from tallgrass.llm.registry import QUERIES

    sizes = {}
    for r in spark.read.parquet(f"{SF}/documents.parquet").select("source", "text").collect():
        sizes[r.source] = sizes.get(r.source, 0) + len(re.findall(r"[^\x20\x09-\x0D]+", r.text or ""))
    want = brute_targets(sizes)
    rows = QUERIES["op2_cube_mix"](spark, SF).select("source", "source_size", "target").distinct().collect()
    assert len(rows) == len(want)
    for r in rows:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source], rel=1e-9)


def test_flight_keeps_both_totals():
    rng = np.random.default_rng(0)
    for n in (1, 2, 3, 50, 2000):
        pi, size = rng.random(n), rng.integers(1, 5000, n).astype(float)
        out = mixing.flight(pi, size, np.random.default_rng(1))
        assert ((out > 0) & (out < 1)).sum() <= 2
        assert abs(out.sum() - pi.sum()) < 1e-6 and abs(out @ size - pi @ size) < 1e-4
        assert set(np.unique(mixing.landing(out, size))) <= {0.0, 1.0}


def test_inclusion_probabilities():
    pi, size = np.array([0.2, 0.5, 0.8, 0.5, 0.4, 0.6]), np.array([3, 7, 5, 2, 9, 4], float)
    mean = np.mean([mixing.flight(pi, size, np.random.default_rng(k)) for k in range(4000)], axis=0)
    assert np.abs(mean - pi).max() < 0.03


def test_taken_words_meet_targets(spark):
    from tallgrass.llm.registry import QUERIES

    out = QUERIES["op2_cube_mix"](spark, SF)
    rows = out.collect()
    assert len(rows) == 1000 and all(r.taken <= 2 * r.size and r.taken == r.size * r.copies for r in rows)
    for r in out.groupBy("source").agg(F.sum("taken").alias("taken"), F.max("target").alias("target"), F.max("size").alias("largest"), F.sum("size").alias("s"), F.max("source_size").alias("all")).collect():
        assert abs(r.taken - r.target) <= 2 * r.largest and r.s == r["all"]
    again = QUERIES["op2_cube_mix"](spark, SF).repartition(3).collect()
    assert {(r.doc_id, r.taken) for r in rows} == {(r.doc_id, r.taken) for r in again}


def test_many_blocks_stay_near(spark):
    sizes = spark.range(20_000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 > 0, "hot").otherwise("cold").alias("source"), (F.xxhash64("id") % 500 + 500).alias("size"))
    for block in (64, 100_000):
        chosen = mixing.decide(sizes, block=block)
        got = chosen.join(sizes, ["doc_id", "source"]).groupBy("source").agg(F.sum(F.col("size") * F.col("copies")).alias("taken"), F.max("target").alias("target")).collect()
        assert all(abs(r.taken - r.target) < 1500 for r in got)


def test_odd_rows(odd, empty):
    sizes = mixing.sizes_of(odd)
    chosen = mixing.decide(sizes)
    assert chosen.count() == odd.select("doc_id", "source").distinct().count()
    mixed = mixing.mix(odd)
    assert mixed.columns == odd.columns
    seen = {tuple(r) for r in odd.collect()}
    assert all(tuple(r) in seen for r in mixed.collect())
    assert mixing.decide(mixing.sizes_of(empty)).count() == 0 and mixing.mix(empty).count() == 0
