"""Reproducible samples and splits.

Rows are drawn by a digest of their id and a seed, so the same rows are drawn again
after a lost task, on another cluster size, or in another engine.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def digest(id_col: str, seed: int) -> Column:
    return F.md5(F.concat_ws(":", F.col(id_col).cast("string"), F.lit(str(seed))))


def unit_draw(id_col: str, seed: int) -> Column:
    """Number in [0, 1) from the first 32 bits of the digest."""
    return F.conv(F.substring(digest(id_col, seed), 1, 8), 16, 10).cast("bigint") / F.lit(4294967296.0)


def sample_fraction(df: DataFrame, fraction: float, *, id_col: str, seed: int) -> DataFrame:
    """About ``fraction`` of the rows, by the digest of their id."""
    return df.where(unit_draw(id_col, seed) < fraction)


#: Rows a task gathers before it drops all but the smallest of each group, and keeps at most between batches.
_GATHERED, _HELD = 1 << 16, 1 << 20


def _smallest(n: int, key: str, order: list[str]):
    """The ``n`` smallest rows of each ``key`` of a task: sorts what is held with what comes, a bounded number of rows at a time."""

    def cut(tables: list[pa.Table]) -> pa.Table:
        rows = pa.concat_tables(tables).combine_chunks()
        codes = pc.dictionary_encode(rows.column(key).combine_chunks(), null_encoding="encode").indices
        sorting = pa.table({"k": codes, **{f"o{i}": rows.column(c) for i, c in enumerate(order)}})
        placed = pc.sort_indices(sorting, [(c, "ascending") for c in sorting.column_names])
        k = codes.take(placed).to_numpy(zero_copy_only=False)
        new = np.ones(len(k), bool)
        new[1:] = k[1:] != k[:-1]
        nth = np.arange(len(k)) - np.maximum.accumulate(np.where(new, np.arange(len(k)), 0))
        return rows.take(placed.filter(pa.array(nth < n)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows, kept = [], 0, 0
        for batch in batches:
            held.append(pa.Table.from_batches([batch]))
            rows += batch.num_rows
            if rows >= max(_GATHERED, 2 * kept):
                held = [cut(held)]
                rows = kept = held[0].num_rows
                if kept > _HELD:  # very many groups: pass on what there is, the merge takes it from there
                    yield from held[0].to_batches(max_chunksize=10_000)
                    held, rows, kept = [], 0, 0
        if rows:
            yield from cut(held).to_batches(max_chunksize=10_000)

    return run


def bottom_k(df: DataFrame, group: list[str], n: int, order: list[Column], *, fan_in: int = 64) -> DataFrame:
    """The ``n`` smallest rows of each group by ``order`` (columns of text or numbers, together a total order).

    Each task keeps the ``n`` smallest rows it sees of a group and passes on no others; these
    are merged in a tree: first over ``fan_in`` parts of a group, each of them bounded the same
    way, then over those. So nothing is sorted as a whole, and no task holds more than ``n``
    rows a group beside the batch it reads. Null group values are a group.
    """
    if n < 1:
        return df.limit(0)
    names = [f"_o{i}" for i in range(len(order))]
    key = F.to_json(F.struct(*[F.col(g).alias(f"g{i}") for i, g in enumerate(group)])) if group else F.lit("")
    rows = df.select(F.struct("*").alias("_row"), key.alias("_key"), *[c.alias(m) for c, m in zip(order, names)])
    keep = _smallest(n, "_key", names)
    kept = rows.mapInArrow(keep, rows.schema).withColumn("_part", F.pmod(F.spark_partition_id(), F.lit(fan_in)))
    merged = kept.repartition("_key", "_part").drop("_part").mapInArrow(keep, rows.schema)
    nth = F.row_number().over(Window.partitionBy("_key").orderBy(*[F.asc_nulls_last(m) for m in names]))
    return merged.withColumn("_nth", nth).where(F.col("_nth") <= n).select("_row.*")


def sample_n(df: DataFrame, group: list[str], n: int, *, id_col: str, seed: int) -> DataFrame:
    """``n`` rows of each group, those of the smallest digests; see ``bottom_k``."""
    return bottom_k(df, group, n, [digest(id_col, seed), F.col(id_col)])


def sample_by(df: DataFrame, label: str, fractions: dict, *, id_col: str, seed: int) -> DataFrame:
    """Stated fraction of each label; labels not stated are left out."""
    keep = F.lit(False)
    for value, fraction in fractions.items():
        keep = keep | ((F.col(label) == value) & (unit_draw(id_col, seed) < fraction))
    return df.where(keep)


def balance_labels(df: DataFrame, label: str, *, id_col: str, seed: int) -> DataFrame:
    """Draw every label down to the size of the rarest one, in expectation."""
    sizes = df.groupBy(label).agg(F.count(F.lit(1)).alias("_n"))
    fractions = sizes.withColumn("_f", sizes.agg(F.min("_n")).scalar() / F.col("_n")).drop("_n")
    return df.join(fractions, label).where(unit_draw(id_col, seed) < F.col("_f")).drop("_f")


def split_by_hash(df: DataFrame, id_col: str, weights: dict[str, float], *, seed: int, name: str = "split") -> DataFrame:
    """Name of the part each row falls in, parts sized by weight."""
    total, upper = sum(weights.values()), 0.0
    draw, part = unit_draw(id_col, seed), None
    for split, weight in list(weights.items())[:-1]:
        upper += weight / total
        part = F.when(draw < upper, split) if part is None else part.when(draw < upper, split)
    last = list(weights)[-1]
    return df.withColumn(name, F.lit(last) if part is None else part.otherwise(last))
