"""Ordered operators that never put one whole group into one task.

A window partitioned by a key sends every row of that key to one task, and an
unpartitioned window sends every row of the table there. The functions here sort
the table with a range shuffle instead, so a hot key is spread over as many tasks
as its share of the rows, and pass on only one carried value per task boundary.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallgrass.session import materialize

_ROW_BITS = 33  # monotonically_increasing_id keeps the partition above bit 33
_ROW_MASK = (1 << _ROW_BITS) - 1


def _sorted_rows(df: DataFrame, order: list) -> DataFrame:
    """Globally sorted rows with their task (``_part``) and place in it (``_idx``)."""
    rows = materialize(df.orderBy(*order).withColumn("_seq", F.monotonically_increasing_id()))
    return (
        rows.withColumn("_part", F.shiftright("_seq", _ROW_BITS))
        .withColumn("_idx", F.col("_seq").bitwiseAND(F.lit(_ROW_MASK)))
        .drop("_seq")
    )


def _same(left: DataFrame, right: DataFrame, names: list[str]) -> Column:
    """Null-safe equality over the named columns."""
    return reduce(lambda a, b: a & b, [left[n].eqNullSafe(right[n]) for n in names])


def _join_back(rows: DataFrame, extra: DataFrame, names: list[str], value: str, how: str = "inner"):
    """Attach ``extra[value]`` by the named columns, nulls matching nulls."""
    renamed = extra.select(*[F.col(n).alias(f"_k{i}") for i, n in enumerate(names)], value)
    cond = reduce(lambda a, b: a & b,
                  [rows[n].eqNullSafe(renamed[f"_k{i}"]) for i, n in enumerate(names)])
    return rows.join(renamed, cond, how).drop(*[f"_k{i}" for i in range(len(names))])


def with_position(df: DataFrame, order: list, name: str = "position") -> DataFrame:
    """0-based place of every row in the given total order."""
    rows = _sorted_rows(df, order)
    # One row per sort task: small enough for a window and a broadcast.
    sizes = rows.groupBy("_part").agg((F.max("_idx") + 1).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    return (
        rows.join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_before") + F.col("_idx"))
        .drop("_part", "_idx", "_before")
    )


def row_number(df: DataFrame, order: list, name: str = "row_number") -> DataFrame:
    """1-based row number over the whole table; ``order`` must be a total order."""
    return with_position(df, order, "_pos").withColumn(name, F.col("_pos") + 1).drop("_pos")


def row_number_by(df: DataFrame, keys: list[str], order: list, name: str = "row_number") -> DataFrame:
    """1-based row number within each key, safe for hot keys."""
    placed = with_position(df, [*keys, *order], "_pos")
    starts = placed.groupBy(*keys).agg(F.min("_pos").alias("_start"))
    joined = _join_back(placed, starts, keys, "_start")
    return joined.withColumn(name, F.col("_pos") - F.col("_start") + 1).drop("_pos", "_start")


def running_total(df: DataFrame, keys: list[str], order: list, value: str, name: str) -> DataFrame:
    """Running sum of ``value`` within each key, row by row in ``order``.

    Each sort task sums its own part of a key; the parts of a key that crosses a
    task boundary are carried on. Only the first and last key of a task can cross
    one, so the carried frame holds at most two rows per task.
    """
    rows = _sorted_rows(df, [*keys, *order])
    part = ["_part", *keys]
    sums = rows.groupBy(*part).agg(
        F.sum(value).alias("_sum"), F.min("_idx").alias("_lo"), F.max("_idx").alias("_hi"))
    fields = F.struct(*part, "_sum")
    edges = (
        sums.groupBy("_part")
        .agg(F.min_by(fields, "_lo").alias("a"), F.max_by(fields, "_hi").alias("b"))
        .select(F.explode(F.array_distinct(F.array("a", "b"))).alias("e"))
        .select("e.*")
    )
    before = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    carry = edges.withColumn("_carry", F.sum("_sum").over(before)).where(F.col("_carry").isNotNull())
    local = Window.partitionBy(*part).orderBy("_idx").rowsBetween(Window.unboundedPreceding, 0)
    summed = rows.withColumn("_local", F.sum(value).over(local))
    joined = _join_back(summed, F.broadcast(carry), part, "_carry", "left")
    # null until the first value, as sum() over a window has it
    total = F.when(F.col("_local").isNotNull() | F.col("_carry").isNotNull(),
                   F.coalesce(F.col("_local"), F.lit(0)) + F.coalesce(F.col("_carry"), F.lit(0)))
    return joined.withColumn(name, total).drop("_part", "_idx", "_local", "_carry")


def cumulative_sum(df: DataFrame, order: str, value: str, name: str) -> DataFrame:
    """``sum(value) over (order by order)``: rows with equal order share one total.

    Rows are first summed per order value, so the sort sees distinct values only.
    """
    per_value = df.groupBy(order).agg(F.sum(value).alias("_v"))
    totals = running_total(per_value, [], [order], "_v", name).select(order, name)
    return _join_back(df, totals, [order], name)


def rank_by(df: DataFrame, keys: list[str], by: str, name: str = "rank", ascending: bool = False) -> DataFrame:
    """``rank()`` of ``by`` within each key; ties share the lowest rank, nulls last."""
    order = F.col(by).asc_nulls_last() if ascending else F.col(by).desc_nulls_last()
    sizes = df.groupBy(*keys, by).agg(F.count(F.lit(1)).alias("_n"))
    ranked = running_total(sizes, keys, [order], "_n", "_upto")
    ranked = ranked.withColumn(name, F.col("_upto") - F.col("_n") + 1)
    return _join_back(df, ranked, [*keys, by], name)


def rows_frame(df: DataFrame, keys: list[str], order: list, before: int, aggs: dict[str, Column],
               block: int = 65_536) -> DataFrame:
    """Aggregates over the current row and the ``before`` rows ahead of it in its key.

    Rows are numbered, cut into blocks, and the last ``before`` rows of a block are
    copied to the next one, so every frame lies inside one block of bounded size.
    """
    size = max(block, before + 1)
    numbered = row_number_by(df, keys, order, "_rn")
    own = F.floor((F.col("_rn") - 1) / F.lit(size))
    last = F.floor((F.col("_rn") - 1 + before) / F.lit(size))
    spread = numbered.withColumn("_own", own).withColumn("_block", F.explode(F.sequence(own, last)))
    frame = Window.partitionBy(*keys, "_block").orderBy("_rn").rowsBetween(-before, 0)
    out = spread.select("*", *[c.over(frame).alias(n) for n, c in aggs.items()])
    return out.where(F.col("_own") == F.col("_block")).drop("_own", "_block", "_rn")


def exact_quantiles(df: DataFrame, keys: list[str], col: str, probs: dict[str, float]) -> DataFrame:
    """Exact linearly interpolated quantiles per key, one column per entry of ``probs``.

    Values are counted first and ranked with a distributed running total, so no
    group's values are ever gathered in one task (unlike ``percentile``).
    """
    sizes = df.where(F.col(col).isNotNull()).groupBy(*keys, col).agg(F.count(F.lit(1)).alias("_n"))
    ranked = running_total(sizes, keys, [F.col(col)], "_n", "_upto")
    if keys:
        totals = ranked.groupBy(*keys).agg(F.max("_upto").alias("_all"))
        ranked = _join_back(ranked, totals, keys, "_all")
    else:
        ranked = ranked.withColumn("_all", ranked.agg(F.max("_upto")).scalar())

    def at(rank: Column) -> Column:
        return F.max(F.when((F.col("_upto") - F.col("_n") <= rank) & (rank < F.col("_upto")),
                            F.col(col).cast("double")))

    picked = []
    for i, p in enumerate(probs.values()):
        h = (F.col("_all") - 1) * F.lit(float(p))
        picked += [at(F.floor(h)).alias(f"_lo{i}"), at(F.ceil(h)).alias(f"_hi{i}"),
                   F.max(h - F.floor(h)).alias(f"_w{i}")]
    rows = ranked.groupBy(*keys).agg(*picked)
    values = [(F.col(f"_lo{i}") + (F.col(f"_hi{i}") - F.col(f"_lo{i}")) * F.col(f"_w{i}")).alias(n)
              for i, n in enumerate(probs)]
    return rows.select(*keys, *values)


def approx_quantiles(df: DataFrame, keys: list[str], col: str, probs: dict[str, float], *, accuracy: int = 10_000) -> DataFrame:
    """Quantiles per key from one pass of mergeable sketches, within a rank error of 1 / ``accuracy``.

    Returns values that occur in the data, without interpolation; memory per key is bounded by ``accuracy``.
    """
    out = df.groupBy(*keys).agg(F.percentile_approx(col, [float(p) for p in probs.values()], accuracy).alias("_q"))
    return out.select(*keys, *[F.col("_q")[i].cast("double").alias(n) for i, n in enumerate(probs)])


def _decayed(decay: float):
    """Rows of each row's key in its task so far; weighted sum, weight and rows up to the last one with a value (0: none)."""
    block = int(min(65_536, max(1, 400 / -np.log2(decay)))) if 0 < decay < 1 else (65_536 if decay else 1)
    falls = decay ** np.arange(block + 1, dtype=float)  # at least 2^-401, so its inverse is a number too

    def scan(x: np.ndarray, total: float) -> np.ndarray:
        """total_i = decay * total_(i-1) + x_i; a block at a time as a running sum of what the block's start would weigh."""
        out = np.empty(len(x))
        for a in range(0, len(x), block):
            part = x[a:a + block]
            f = falls[:len(part)]
            out[a:a + len(part)] = f * np.cumsum(part / f) + total * falls[1:len(part) + 1]
            total = out[a + len(part) - 1]
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, age, state, held = None, 0, [0.0, 0.0], [0.0, 0.0, 0]
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            keys = batch.column("_key")
            x = batch.column("_x").to_numpy(zero_copy_only=False).astype(float)
            seen = batch.column("_x").is_valid().to_numpy(zero_copy_only=False) & ~np.isnan(x)
            x = np.where(seen, x, 0.0)
            cuts = np.flatnonzero(pc.not_equal(keys.slice(1), keys.slice(0, n - 1)).to_numpy(zero_copy_only=False)) + 1
            ages, out = np.empty(n, np.int64), [np.empty(n), np.empty(n), np.empty(n, np.int64)]
            for a, b in zip([0, *cuts], [*cuts, n]):
                if keys[int(a)].as_py() != last:
                    last, age, state, held = keys[int(a)].as_py(), 0, [0.0, 0.0], [0.0, 0.0, 0]
                now = [scan(x[a:b], state[0]), scan(seen[a:b].astype(float), state[1]), np.arange(age + 1, age + 1 + b - a)]
                ages[a:b] = now[2]
                at = np.maximum.accumulate(np.where(seen[a:b], np.arange(b - a), -1))
                for value, row, before in zip(out, now, held):
                    value[a:b] = np.where(at >= 0, row[np.maximum(at, 0)], before)
                age, state, held = age + int(b - a), [now[0][-1], now[1][-1]], [value[b - 1] for value in out]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in ("_row", "_key", "_part", "_idx")], *[pa.array(v) for v in (*out, ages)]],
                ["_row", "_key", "_part", "_idx", "_s", "_w", "_seen", "_age"])

    return run


def ewma(df: DataFrame, keys: list[str], order: list, col: str, *, halflife: float, name: str = "ewma") -> DataFrame:
    """Adjusted exponentially weighted mean, weight halved every ``halflife`` rows; ``order`` must be total.

    A null or NaN has no weight, but the weights of what is before it go on falling. The mean is null
    until the first value.

    Rows are sorted with a range shuffle, so a long series lies in many tasks. Each row is an
    affine map of a weighted sum and a weight; a task scans its rows, and what the rows of a key
    in one task do to a sum and a weight from before them is one such map again. Only the key
    that ends a task can go on in the next, so one row per task is folded and carried on.
    """
    decay = 0.5 ** (1.0 / halflife)
    key = F.to_json(F.struct(*[F.col(k).alias(f"k{i}") for i, k in enumerate(keys)])) if keys else F.lit("")
    flat = df.select(F.struct("*").alias("_row"), key.alias("_key"), *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)],
                     *[(o if isinstance(o, Column) else F.col(o)).alias(f"_o{i}") for i, o in enumerate(order)], F.col(col).cast("double").alias("_x"))
    rows = _sorted_rows(flat, [*[f"_k{i}" for i in range(len(keys))], *[f"_o{i}" for i in range(len(order))]])
    rows = rows.select("_row", "_key", "_x", "_part", "_idx")
    kind = rows.drop("_x").schema.add("_s", "double").add("_w", "double").add("_seen", "long").add("_age", "long")
    local = materialize(rows.mapInArrow(_decayed(decay), kind))
    ends = local.groupBy("_part").agg(F.max_by(F.struct("_key", "_idx", "_s", "_w", "_seen", "_age"), "_idx").alias("e")).select("_part", "e.*")
    carried, key, s, w, mean = [], None, 0.0, 0.0, None
    for e in sorted(ends.collect(), key=lambda r: r["_part"]):  # one row per sort task
        if key is not None:
            carried.append((e["_part"], key, s, w, mean))
        if e["_key"] != key or e["_age"] != e["_idx"] + 1:  # another key, or one that began in this task
            key, s, w, mean = e["_key"], 0.0, 0.0, None
        if e["_seen"]:
            s, w = e["_s"] + s * decay ** e["_seen"], e["_w"] + w * decay ** e["_seen"]
            mean = s / w
        rest = decay ** (e["_age"] - e["_seen"])
        s, w = s * rest, w * rest
    carry = df.sparkSession.createDataFrame(carried, "_p long, _k string, _cs double, _cw double, _cm double")
    joined = local.join(F.broadcast(carry), (F.col("_part") == F.col("_p")) & (F.col("_key") == F.col("_k")) & (F.col("_age") == F.col("_idx") + 1), "left")
    old = F.pow(F.lit(decay), F.col("_seen"))
    s = F.col("_s") + F.coalesce(F.col("_cs") * old, F.lit(0.0))
    w = F.col("_w") + F.coalesce(F.col("_cw") * old, F.lit(0.0))
    return joined.select("_row.*", F.when(F.col("_seen") > 0, F.try_divide(s, w)).otherwise(F.col("_cm")).alias(name))


def trailing_frame(df: DataFrame, keys: list[str], ts: str, *, seconds: int, aggs: dict[str, tuple[str, str]]) -> DataFrame:
    """Aggregates over the rows of a key from ``seconds`` before each row's own instant up to it, ties included.

    ``aggs`` names each result and its (sum, count, min, max or mean, column). Returns every row
    with its results, as ``RANGE BETWEEN INTERVAL ... PRECEDING AND CURRENT ROW`` has them; rows
    without an instant are one another's frame.

    Rows are folded to one per key and instant, and time is cut into blocks as wide as the
    frame. A frame is then the beginning of its own block up to the instant, and the end of the
    block before from the frame's first instant on. Both are running aggregates, one forwards
    and one backwards, so work goes by the rows and not by how many a frame holds, and a hot key
    is spread over as many tasks as it has blocks.
    """
    parts = {"sum": F.sum, "count": F.count, "min": F.min, "max": F.max}
    kind = dict(df.dtypes)[ts]
    epoch = F.lit("1970-01-01").cast("timestamp_ntz")
    micros = F.unix_micros(ts) if kind == "timestamp" else F.timestamp_diff("MICROSECOND", epoch, F.col(ts).cast("timestamp_ntz"))
    rows = df.withColumn("_t", micros)
    needed = sorted({(f, c) for fn, c in aggs.values() for f in (("sum", "count") if fn == "mean" else (fn,))})
    folded = rows.groupBy(*keys, "_t").agg(*[parts[f](c).alias(f"_a{i}") for i, (f, c) in enumerate(needed)])
    width = seconds * 1_000_000

    def running(block: str, order: Column, name: str) -> list[Column]:
        frame = Window.partitionBy(*keys, block).orderBy(order).rangeBetween(Window.unboundedPreceding, 0)
        return [(F.sum if f == "count" else parts[f])(f"_a{i}").over(frame).alias(f"{name}{i}") for i, (f, _) in enumerate(needed)]

    own = folded.withColumn("_block", F.floor(F.col("_t") / F.lit(width)))
    own = own.select("*", *running("_block", F.col("_t").asc(), "_own"))
    given, here = [f"_a{i}" for i in range(len(needed))], [f"_own{i}" for i in range(len(needed))]
    kinds = dict(own.dtypes)
    held = own.select(*keys, "_block", F.col("_t").alias("_at"), F.lit(None).cast("long").alias("_t"), *given, *[F.lit(None).cast(kinds[c]).alias(c) for c in here])
    asking = own.where("_t IS NOT NULL").select(*keys, F.col("_block") - 1, F.col("_t") - width, "_t", *[F.lit(None).cast(kinds[c]).alias(c) for c in given], *here)
    both = held.union(asking).select("*", *running("_block", F.col("_at").desc(), "_before")).where("_t IS NOT NULL").select(
        *keys, "_t", *here, *[f"_before{i}" for i in range(len(needed))])
    alone = own.where("_t IS NULL").select(*keys, "_t", *here, *[F.lit(None).cast(kinds[c]) for c in here])  # one another's frame
    framed = both.union(alone)

    def value(f: str, c: str) -> Column:
        i = needed.index((f, c))
        mine, before = F.col(f"_own{i}"), F.col(f"_before{i}")
        joined = {"min": F.least(mine, before), "max": F.greatest(mine, before)}
        return joined[f] if f in joined else F.when(before.isNull(), mine).when(mine.isNull(), before).otherwise(mine + before)

    values = {n: F.try_divide(value("sum", c).cast("double"), value("count", c)) if fn == "mean" else value(fn, c) for n, (fn, c) in aggs.items()}
    names = [*keys, "_t"]
    renamed = framed.select(*[F.col(n).alias(f"_k{i}") for i, n in enumerate(names)], *[v.alias(n) for n, v in values.items()])
    same = reduce(lambda a, b: a & b, [rows[n].eqNullSafe(renamed[f"_k{i}"]) for i, n in enumerate(names)])
    return rows.join(renamed, same).drop(*[f"_k{i}" for i in range(len(names))], "_t")
