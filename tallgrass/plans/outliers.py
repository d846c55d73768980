"""Outliers by quantile and by local outlier factor."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallgrass.operators.ordered import exact_quantiles, row_number_by, with_position
from tallgrass.session import materialize

_CUTS = [0.25, 0.5, 0.75]  # quantiles at which a cell is cut
_SLACK = 1e-9  # pruning tolerance; distances themselves are exact


def quantile_outliers(df: DataFrame, col: str, *, lo: float = 0.01, hi: float = 0.99) -> DataFrame:
    """Rows outside the exact low and high quantile of a column."""
    edges = exact_quantiles(df, [], col, {"_lo": lo, "_hi": hi})
    marked = df.withColumn("_q", edges.select(F.struct("_lo", "_hi")).scalar())
    return marked.where((F.col(col) < F.col("_q._lo")) | (F.col(col) > F.col("_q._hi"))).drop("_q")


def standardize(df: DataFrame, cols: list[str]) -> DataFrame:
    """Centre and scale with the population deviation; a constant column becomes 0."""
    stats = df.agg(F.struct(*[F.struct(F.avg(c).alias("mu"), F.stddev_pop(c).alias("sd")).alias(c) for c in cols])).scalar()
    scaled = df.withColumn("_s", stats)
    return scaled.select(
        *[c for c in df.columns if c not in cols],
        *[F.coalesce(F.try_divide(F.col(c) - F.col(f"_s.{c}.mu"), F.col(f"_s.{c}.sd")), F.lit(0.0)).alias(c) for c in cols])


def _norm(parts: list[Column]) -> Column:
    return F.sqrt(sum((p * p for p in parts[1:]), parts[0] * parts[0]))


def _box_gaps(dims: int) -> tuple[Column, Column]:
    """Least and greatest distance between points of the boxes ``a`` and ``b``."""
    alo, ahi, blo, bhi = (F.col(n) for n in ("alo", "ahi", "blo", "bhi"))
    near = [F.greatest(blo[i] - ahi[i], alo[i] - bhi[i], F.lit(0.0)) for i in range(dims)]
    return _norm(near), _norm([F.greatest(bhi[i] - alo[i], ahi[i] - blo[i]) for i in range(dims)])


def _point_gaps(dims: int) -> tuple[Column, Column]:
    """Least and greatest distance between a point and the points of the box ``b``."""
    blo, bhi = F.col("blo"), F.col("bhi")
    near = [F.greatest(blo[i] - F.col(f"x{i}"), F.col(f"x{i}") - bhi[i], F.lit(0.0)) for i in range(dims)]
    return _norm(near), _norm([F.greatest(F.abs(F.col(f"x{i}") - blo[i]), F.abs(bhi[i] - F.col(f"x{i}"))) for i in range(dims)])


def _prune(pairs: DataFrame, owner: str, near: Column, far: Column, need: int) -> DataFrame:
    """Drop cells that cannot hold one of the owner's nearest points.

    The owner's ``need`` nearest points lie within the smallest greatest-distance by
    which the cells seen so far hold that many; a cell further off than that is out.
    """
    scored = pairs.withColumn("_near", near).withColumn("_far", far)
    by_far = Window.partitionBy(owner).orderBy("_far", "b")
    held = scored.withColumn("_held", F.sum("n").over(by_far.rowsBetween(Window.unboundedPreceding, 0)))
    reach = F.min(F.when(F.col("_held") >= need, F.col("_far"))).over(Window.partitionBy(owner))
    kept = held.withColumn("_reach", reach).where(
        F.col("_reach").isNull() | (F.col("_near") <= F.col("_reach") * (1 + _SLACK) + _SLACK))
    return kept.drop("_near", "_far", "_held", "_reach")


def _cells(points: DataFrame, dims: int) -> DataFrame:
    """Points with copies (``n``) and without (``m``), box and quantiles of every cell."""
    xs = [f"x{i}" for i in range(dims)]
    return points.groupBy("parent", "cell").agg(
        F.sum("w").alias("n"), F.count(F.lit(1)).alias("m"), F.array(*[F.min(x) for x in xs]).alias("lo"),
        F.array(*[F.max(x) for x in xs]).alias("hi"), F.array(*[F.percentile_approx(x, _CUTS, 100) for x in xs]).alias("cuts"))


def _split(points: DataFrame, cells: DataFrame, dims: int, leaf: int) -> DataFrame:
    """Points moved to the children of their cell, if it holds more than ``leaf`` of them.

    A cell is cut at quantiles of its widest side. If most of its points lie on that side's
    upper end, this end is cut off. Either way every child has fewer points than its parent.
    """
    wide = F.zip_with("hi", "lo", lambda h, l: h - l)
    axis = F.array_position(wide, F.array_max(wide)).cast("int")
    cut = cells.where(F.col("m") > leaf).select(
        F.col("cell"), axis.alias("_axis"), F.element_at("cuts", axis).alias("_cuts"), F.element_at("hi", axis).alias("_hi"))
    x = F.element_at(F.array(*[F.col(f"x{i}") for i in range(dims)]), F.col("_axis"))
    above = F.size(F.filter("_cuts", lambda c: x > c))
    child = F.when(F.element_at("_cuts", 1) >= F.col("_hi"), (x >= F.col("_hi")).cast("int")).otherwise(above)
    moved = points.drop("parent").join(cut, "cell", "left")
    path = F.when(F.col("_axis").isNull(), F.col("cell")).otherwise(F.concat("cell", child.cast("string")))
    return moved.select("pid", "w", *[f"x{i}" for i in range(dims)], F.col("cell").alias("parent"), path.alias("cell"))


def nearest_neighbours(points: DataFrame, dims: int, k: int, *, leaf: int = 16) -> DataFrame:
    """Exact ``k`` nearest neighbours of every distinct point, ties included.

    ``points`` holds ``pid``, copies ``w`` and coordinates ``x*``. Returns ``(p, q, w, d,
    kdist)``, one row per neighbouring distinct point, where ``w`` counts its copies (for the
    point itself, its other copies).

    Space is cut at quantiles of the data, each cell until it holds at most ``leaf`` distinct
    points, so neither dense places nor far outliers change how deep others are cut. Cells are
    matched with cells level by level, dropping at each level those too far off to matter by
    their boxes. The pairs kept per cell depend on ``k`` and the dimension, not on the number
    of points, so no group's points are ever paired with each other.
    """
    xs = [f"x{i}" for i in range(dims)]
    points = points.select("pid", "w", *xs, F.lit("").alias("parent"), F.lit("").alias("cell"))
    cells = materialize(_cells(points, dims))
    pairs = cells.select(F.col("cell").alias("a"), F.col("cell").alias("b"), "n", F.col("lo").alias("blo"), F.col("hi").alias("bhi"))
    while not cells.where(F.col("m") > leaf).isEmpty():
        points = materialize(_split(points, cells, dims, leaf))
        cells = materialize(_cells(points, dims))
        left = cells.select(F.col("parent").alias("a"), F.col("cell").alias("a2"), F.col("lo").alias("alo"), F.col("hi").alias("ahi"))
        right = cells.select(F.col("parent").alias("b"), F.col("cell").alias("b2"), "n", F.col("lo").alias("blo"), F.col("hi").alias("bhi"))
        finer = pairs.select("a", "b").join(left, "a").join(right, "b").drop("a", "b").withColumnsRenamed({"a2": "a", "b2": "b"})
        # One more than k, as an owner's own point is counted in its cell.
        pairs = materialize(_prune(finer, "a", *_box_gaps(dims), k + 1).drop("alo", "ahi"))

    placed = points.withColumn("a", F.col("cell"))
    facing = _prune(placed.join(pairs, "a"), "pid", *_point_gaps(dims), k + 1)
    mine = facing.select(F.col("pid").alias("p"), "b", *[F.col(f"x{i}").alias(f"px{i}") for i in range(dims)])
    theirs = placed.select(F.col("a").alias("b"), F.col("pid").alias("q"), "w", *[f"x{i}" for i in range(dims)])
    met = mine.join(theirs, "b")
    distance = _norm([F.col(f"px{i}") - F.col(f"x{i}") for i in range(dims)])
    others = F.when(F.col("p") == F.col("q"), F.col("w") - 1).otherwise(F.col("w"))
    near_rows = met.select("p", "q", others.alias("w"), distance.alias("d")).where("w > 0")
    return _within_kdist(near_rows, k)


def _within_kdist(near_rows: DataFrame, k: int) -> DataFrame:
    """Of candidate neighbours ``(p, q, w, d)`` those up to the ``k``-th, ties included, with its distance ``kdist``."""
    by_d = Window.partitionBy("p").orderBy("d", "q")
    counted = near_rows.withColumn("_held", F.sum("w").over(by_d.rowsBetween(Window.unboundedPreceding, 0)))
    everyone = Window.partitionBy("p")
    enough = F.min(F.when(F.col("_held") >= k, F.col("d"))).over(everyone)
    kdist = F.coalesce(enough, F.max("d").over(everyone))
    return counted.withColumn("kdist", kdist).where("d <= kdist").select("p", "q", "w", "d", "kdist")


def _directions(dims: int, levels: int, tables: int, seed: int) -> np.ndarray:
    """For each table ``levels`` random directions at right angles."""
    rng = np.random.default_rng(seed)
    return np.stack([np.linalg.qr(rng.normal(size=(dims, dims)))[0][:, :levels].T for _ in range(tables)])


def _block_neighbours(dims: int, k: int):
    def run(table: pa.Table) -> pa.Table:
        pid, w = table.column("pid").to_numpy(), table.column("w").to_numpy()
        x = np.stack([table.column(f"x{i}").to_numpy() for i in range(dims)], axis=1)
        d = np.sqrt(((x[:, None, :] - x[None, :, :]) ** 2).sum(axis=2))
        np.fill_diagonal(d, np.inf)
        reach = np.partition(d, k - 1, axis=1)[:, k - 1] if len(pid) > k else np.full(len(pid), np.finfo(float).max)
        p, q = np.nonzero(d <= reach[:, None])
        return pa.table({"p": pid[p], "q": pid[q], "w": w[q], "d": d[p, q]})

    return run


def indexed_neighbours(points: DataFrame, dims: int, k: int, *, tables: int = 4, block: int = 128, seed: int = 1) -> DataFrame:
    """Approximate ``k`` nearest neighbours of every distinct point, as ``nearest_neighbours`` returns them.

    A locality-sensitive index of random projections. Each of ``tables`` tables hashes a point to
    a cell: its rank along one random direction, cut into equal parts, then its rank along a
    second one (at right angles) within its part. Ranks rather than widths make every cell hold
    ``block`` points at most, in dense places as in thin ones. Near points share a cell in most
    tables; the points of a cell are each other's candidates, and the nearest of all tables stay.

    Work grows with ``tables * block`` per point. A point's neighbours beyond a cell's edge are
    found where another table doesn't cut between them; the test measures the recall.
    """
    levels = min(dims, 2)
    ways = _directions(dims, levels, tables, seed)
    n = points.count()
    parts = max(1, int(np.ceil((n / block) ** (1 / levels))))
    xs = [f"x{i}" for i in range(dims)]

    def along(direction: np.ndarray) -> Column:
        return sum((F.col(x) * float(c) for x, c in zip(xs, direction)), F.lit(0.0))

    hashed = points.select("pid", "w", *xs, F.explode(F.array(*[
        F.struct(F.lit(t).alias("t"), *[along(way).alias(f"s{i}") for i, way in enumerate(ways[t])]) for t in range(tables)])).alias("h"))
    hashed = hashed.select("pid", "w", *xs, "h.*")
    cell = ["t"]
    for level in range(levels):
        size = max(1, int(np.ceil(n / parts ** (level + 1))))
        ranked = row_number_by(hashed, cell, [F.col(f"s{level}"), F.col("pid")], "_rn")
        hashed = ranked.withColumn(f"c{level}", F.floor((F.col("_rn") - 1) / size)).drop("_rn", f"s{level}")
        cell = [*cell, f"c{level}"]
    met = hashed.groupBy(*cell).applyInArrow(_block_neighbours(dims, k), "p long, q long, w long, d double")
    copies = points.where("w > 1").select(F.col("pid").alias("p"), F.col("pid").alias("q"), (F.col("w") - 1).alias("w"), F.lit(0.0).alias("d"))
    return _within_kdist(met.dropDuplicates(["p", "q"]).unionByName(copies), k)


def lof(df: DataFrame, id_col: str, cols: list[str], k: int = 15, *, threshold: float = 1.25,
        scale: bool = True, exact: bool = True, **index) -> DataFrame:
    """Local outlier factor per row, with an outlier flag.

    With ``exact=False`` neighbours come from an index of random projections (settings:
    ``indexed_neighbours``), for large input; factors then differ where it misses a neighbour.

    Rows with a null coordinate are left out and results are keyed by ``id_col``, so a
    factor always belongs to its row. Copies of one point are folded and weighted; a
    point with more than ``k`` copies has factor 1. For a handful of dimensions.
    """
    dims = len(cols)
    rows = df.select(id_col, *[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(cols)]).dropna()
    xs = [f"x{i}" for i in range(dims)]
    if scale:
        rows = standardize(rows, xs)
    rows = materialize(rows)
    points = with_position(rows.groupBy(*xs).agg(F.count(F.lit(1)).alias("w")), xs, "pid")
    if not exact:
        points = materialize(points)
    pairs = materialize(nearest_neighbours(points, dims, k) if exact else indexed_neighbours(points, dims, k, **index))
    kdists = pairs.groupBy(F.col("p").alias("q")).agg(F.max("kdist").alias("kdist_q"))
    reached = F.sum(F.col("w") * F.greatest("d", "kdist_q"))
    density = pairs.join(kdists, "q").groupBy("p").agg(F.sum("w").alias("size"), reached.alias("reach"))
    infinite = F.lit(float("inf"))
    density = materialize(density.select("p", "size", F.coalesce(F.try_divide("size", "reach"), infinite).alias("lrd")))
    theirs = density.select(F.col("p").alias("q"), F.col("lrd").alias("lrd_q"))
    factor = (pairs.join(theirs, "q").groupBy("p").agg(F.sum(F.col("w") * F.col("lrd_q")).alias("total"))
              .join(density, "p"))
    value = F.when(F.col("lrd") == infinite, 1.0).otherwise(F.col("total") / F.col("size") / F.col("lrd"))
    scores = factor.select(F.col("p").alias("pid"), value.alias("lof"))
    keyed = points.join(scores, "pid").select(*xs, "lof")
    return rows.join(keyed, xs).select(id_col, "lof", (F.col("lof") >= threshold).alias("is_outlier"))
