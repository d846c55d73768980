"""What the operators share.

Every operator takes a DataFrame with at least the columns it names, packs all of its
columns into one struct column ``row`` and adds its own columns beside it, so columns of
any other name pass through and can't clash.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallgrass.session import scratch_path

#: ``[\x20\x09-\x0D]``: the white space of the query contracts.
SPACES = " \t\n\x0b\x0c\r"
SPACE_CLASS = "[\\x20\\x09-\\x0D]"
WORD_CLASS = "[^\\x20\\x09-\\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def packed(df: DataFrame) -> DataFrame:
    """All columns of ``df`` in the one column ``row``."""
    return df.select(F.struct("*").alias("row"))


def text_of(row: str = "row", name: str = "text") -> Column:
    """The row's text, a null as an empty one."""
    return F.coalesce(F.col(f"{row}.{name}").cast("string"), F.lit(""))


def ascii_lower(c: Column) -> Column:
    """A-Z lower-cased, every other letter as it is."""
    return F.translate(c, UPPER, LOWER)


def same(left: DataFrame, right: DataFrame, pairs: dict[str, str]) -> Column:
    """Null-safe equality of the left columns with the right ones."""
    return reduce(lambda a, b: a & b, [left[a].eqNullSafe(right[b]) for a, b in pairs.items()])


def salted_join(left: DataFrame, right: DataFrame, pairs: dict[str, str], spread: Column, salts: int = 32) -> DataFrame:
    """Left rows with their row of ``right``, which is small (one row a key), by null-safe equal columns.

    A key that many left rows share is spread over ``salts`` tasks by a hash of ``spread``; the
    right side is repeated as often.
    """
    left = left.withColumn("_salt", F.pmod(F.xxhash64(spread), F.lit(salts)).cast("int"))
    right = right.withColumn("_of_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return left.join(right, same(left, right, pairs) & (left["_salt"] == right["_of_salt"])).drop("_salt", "_of_salt")


def with_text(row: str, text: Column, columns: list[str]) -> Column:
    """The row with its text replaced, and ``n_chars`` brought up to date where the row has it."""
    changed = F.col(row).withField("text", text)
    return changed.withField("n_chars", F.length(text).cast("long")) if "n_chars" in columns else changed


def stored(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder and read from there.

    Unlike a checkpoint, which keeps the estimates of the plan it cuts, the written table is
    planned by its own size; in loops estimates would multiply without end.
    """
    path = scratch_path(df.sparkSession, "llm")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def byte_slices(column: pa.Array, size: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Rows from, to, their bytes and their ends, of a string column without nulls, by about ``size`` bytes, a row at least."""
    column = column.cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
    i = 0
    while i < len(column):
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + size, "right")) - 1)
        yield i, j, data[offsets[i]:offsets[j]], offsets[i + 1:j + 1] - offsets[i]
        i = j


def drawn(keys: DataFrame, key: str, sample: int, seed: int) -> DataFrame:
    """At most ``sample`` rows of ``keys``, whose ``key`` is unique, by digests of the key; independent of the layout."""
    # one or two times the sample by a residue, so no task passes on many rows; then exactly the lowest digests of these
    some = keys.where(F.pmod(F.xxhash64(F.lit(seed), F.col(key)), F.lit(max(1, keys.count() // sample))) == 0)
    return some.orderBy(F.xxhash64(key), key).limit(sample)
