"""K-means from a start that doesn't depend on how the rows lie, for several numbers of clusters at once."""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallgrass.session import settled

#: Partial sums are passed on as decimals of this many digits behind the point, which add up alike in any order.
_DIGITS = 9


def _matrix(batch: pa.RecordBatch, dims: int) -> np.ndarray:
    return np.stack([batch.column(f"x{i}").to_numpy(zero_copy_only=False) for i in range(dims)], axis=1)


def _gaps(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distance of each row to each centre."""
    return np.stack([((x - c) ** 2).sum(axis=1) for c in centres], axis=1)


def _sums(points: DataFrame, dims: int, sets: dict[int, np.ndarray]) -> dict[int, tuple[np.ndarray, np.ndarray, float]]:
    """For each set of centres: rows and coordinate sums of each cluster, and the sum of squares; one pass over the points.

    A task adds up its rows in order and passes on a row per cluster. The driver gets a row for
    each cluster of each set.
    """
    total = sum(len(c) for c in sets.values())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((total, dims + 2))
        for batch in batches:
            x, at = _matrix(batch, dims), 0
            for centres in sets.values():
                gaps = _gaps(x, centres)
                own = gaps.argmin(axis=1)
                of = slice(at, at + len(centres))
                for d in range(dims):
                    sums[of, d] += np.bincount(own, weights=x[:, d], minlength=len(centres))
                sums[of, dims] += np.bincount(own, minlength=len(centres))
                sums[of, dims + 1] += np.bincount(own, weights=gaps[np.arange(len(own)), own], minlength=len(centres))
                at += len(centres)
        columns = [pa.array([round(Decimal(v), _DIGITS) for v in sums[:, d].tolist()], pa.decimal128(38, _DIGITS)) for d in range(dims + 2)]
        yield pa.RecordBatch.from_arrays([pa.array(range(total), pa.int32()), *columns], ["c", *[f"v{d}" for d in range(dims + 2)]])

    kind = "c int, " + ", ".join(f"v{d} decimal(38,{_DIGITS})" for d in range(dims + 2))
    rows = points.mapInArrow(run, kind).groupBy("c").agg(*[F.sum(f"v{d}").alias(f"v{d}") for d in range(dims + 2)]).collect()
    found = np.zeros((total, dims + 2))
    for r in rows:
        found[r[0]] = [float(v) for v in r[1:]]
    out, at = {}, 0
    for k, centres in sets.items():
        part = found[at:at + len(centres)]
        out[k] = (part[:, dims], part[:, :dims], float(part[:, dims + 1].sum()))
        at += len(centres)
    return out


def _candidates(points: DataFrame, dims: int, expected: int, rounds: int, seed: int) -> np.ndarray:
    """Points drawn by their digests, each with a probability of ``expected`` times its share of the squared distance to those drawn before."""
    xs = [f"x{i}" for i in range(dims)]
    first = points.orderBy(F.xxhash64(F.lit(seed), "id"), "id").limit(1).select(*xs).collect()
    centres = np.array([[*r] for r in first], float).reshape(len(first), dims)
    for turn in range(rounds if len(first) else 0):
        cost = _sums(points, dims, {0: centres})[0][2]
        if cost <= 0:
            break
        draw = F.pmod(F.xxhash64(F.lit(seed + turn + 1), "id"), F.lit(1 << 52)) / F.lit(float(1 << 52))

        def far(batches: Iterator[pa.RecordBatch], centres=centres, cost=cost) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                x = _matrix(batch, dims)
                take = batch.column("u").to_numpy() * cost < expected * _gaps(x, centres).min(axis=1)
                yield pa.RecordBatch.from_arrays([pa.array(x[take, i]) for i in range(dims)], xs)

        drawn = points.select(*xs, draw.alias("u")).mapInArrow(far, ", ".join(f"{x} double" for x in xs)).distinct().collect()
        centres = np.unique(np.concatenate([centres, np.array([[*r] for r in drawn], float).reshape(len(drawn), dims)]), axis=0)
    return centres


def _reduced(candidates: np.ndarray, weight: np.ndarray, most: int) -> np.ndarray:
    """Up to ``most`` candidates, best first: the heaviest, then each time the one with the largest weighted distance to those taken."""
    order = [int(np.argmax(weight))]
    near = ((candidates - candidates[order[0]]) ** 2).sum(axis=1)
    while len(order) < min(most, len(candidates)):
        order.append(int(np.argmax(weight * near)))
        near = np.minimum(near, ((candidates - candidates[order[-1]]) ** 2).sum(axis=1))
    return candidates[order]


def _settle(centres: np.ndarray, candidates: np.ndarray, weight: np.ndarray, steps: int = 50) -> np.ndarray:
    """Centres moved to the weighted means of their candidates, on the driver."""
    for _ in range(steps):
        own = _gaps(candidates, centres).argmin(axis=1)
        held = np.bincount(own, weights=weight, minlength=len(centres))
        sums = np.stack([np.bincount(own, weights=weight * candidates[:, d], minlength=len(centres)) for d in range(candidates.shape[1])], axis=1)
        moved = np.where(held[:, None] > 0, sums / np.maximum(held, 1e-300)[:, None], centres)
        if np.array_equal(moved, centres):
            break
        centres = moved
    return centres


def kmeans(df: DataFrame, id_col: str, cols: list[str], ks, *, seed: int = 1, rounds: int = 4, steps: int = 20,
           tolerance: float = 1e-4) -> dict[int, tuple[np.ndarray, float]]:
    """Centres and within-cluster sum of squares for each number of clusters in ``ks``.

    The start is shared: a few rounds draw about ``2 * max(ks)`` candidates each, by digests of
    ``id_col`` and in proportion to their squared distance; weighted by the rows nearest to them
    they are reduced to each k on the driver. Then every pass over the rows moves the centres of
    all ks at once, ``steps`` times at most, until none moves more than ``tolerance``. If more
    clusters end up with a larger sum of squares than fewer, they start again from those and one more.

    Rows with a null coordinate are left out. The same rows give the same centres, whatever
    their layout. What the driver holds goes by the ks and dimensions, not by the rows.
    """
    dims = len(cols)
    rows = df.select(F.col(id_col).alias("id"), *[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(cols)]).dropna(subset=[f"x{i}" for i in range(dims)])
    points = settled(rows, "id")
    ks = sorted({int(k) for k in ks})
    candidates = _candidates(points, dims, 2 * ks[-1], rounds, seed)
    if not len(candidates):
        return {k: (np.zeros((0, dims)), 0.0) for k in ks}
    weight = _sums(points, dims, {0: candidates})[0][0]
    order = _reduced(candidates, weight, ks[-1])
    found = _moved(points, dims, {k: _settle(order[:k], candidates, weight) for k in ks}, steps, tolerance)
    for fewer, k in zip(ks, ks[1:]):
        if found[k][1] > found[fewer][1]:
            centres = found[fewer][0]
            far = _gaps(candidates, centres).min(axis=1) * weight
            more = candidates[np.argsort(-far, kind="stable")[:k - len(centres)]]
            found |= _moved(points, dims, {k: np.concatenate([centres, more])}, steps, tolerance)
    return found


def _moved(points: DataFrame, dims: int, sets: dict[int, np.ndarray], steps: int, tolerance: float) -> dict[int, tuple[np.ndarray, float]]:
    done, open_ = {}, dict(sets)
    for step in range(steps + 1):
        for k, (n, sums, cost) in _sums(points, dims, open_).items():
            centres = open_[k]
            moved = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], centres)
            done[k] = (centres, cost)
            if step == steps or ((moved - centres) ** 2).sum(axis=1).max(initial=0) <= tolerance**2:
                open_.pop(k)
            else:
                open_[k] = moved
        if not open_:
            break
    return done


def nearest_centre(cols: list[str], centres: np.ndarray) -> Column:
    """Number of the nearest centre, the first of equally near ones; null where a coordinate is."""
    gaps = [sum(((F.col(c).cast("double") - float(v)) * (F.col(c).cast("double") - float(v)) for c, v in zip(cols, centre)), F.lit(0.0)) for centre in centres]
    return F.array_min(F.array(*[F.struct(g.alias("d"), F.lit(i).alias("i")) for i, g in enumerate(gaps)]))["i"]
