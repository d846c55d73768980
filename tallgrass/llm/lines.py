"""Line dedup: lines that several documents share stay in one document only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallgrass.llm.common import LOWER, SPACES, UPPER, ascii_lower, packed, same, text_of, with_text
from tallgrass.llm.registry import query
from tallgrass.queries import read


def line_key(line: Column) -> Column:
    """The line without white space at its ends, A-Z lower-cased."""
    return ascii_lower(F.btrim(line, F.lit(SPACES)))


def drop_shared_lines(docs: DataFrame, min_docs: int = 2, min_chars: int = 10) -> DataFrame:
    """``docs`` (doc_id, text) as ``row``, ``n_lines``, ``n_dropped`` and ``kept`` (the text that stays).

    A line's key (:func:`line_key`) of at least ``min_chars`` code points that is found in at
    least ``min_docs`` documents loses its lines in all documents but the smallest doc_id
    holding it. Keys travel as two 64-bit hashes, a document's position lists as integers;
    line texts are never shuffled. Keys are counted once per document, so a line in a third of
    all documents is spread over the tasks by (key, doc_id) and summed per task before its
    counts meet; its join is one that adaptive execution can split.

    A null text is one empty line. Rows with the same doc_id are one document and keep or lose
    lines together; rows with a null doc_id are one document that comes after all others.
    An empty table gives an empty table.
    """
    rows = packed(docs).select("row", F.col("row.doc_id").alias("id"), F.xxhash64(text_of()).alias("digest"))
    lines = (
        rows.select("id", "digest", F.posexplode(F.split(text_of(), "\n")).alias("pos", "line"))
        .select("id", "digest", "pos", line_key(F.col("line")).alias("key"))
        .where(F.length("key") >= min_chars)
        .select("id", "digest", "pos", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), F.col("key")).alias("h2"))
    )
    shared = (
        lines.groupBy("h1", "h2", "id").agg(F.lit(1).alias("one"))
        .groupBy("h1", "h2").agg(F.count("one").alias("n_docs"), F.min("id").alias("keeper"))
        .where(F.col("n_docs") >= min_docs).select("h1", "h2", "keeper")
    )
    lost = (
        lines.join(shared, ["h1", "h2"]).where(~F.col("id").eqNullSafe(F.col("keeper")))
        .groupBy(F.col("id").alias("lost_id"), F.col("digest").alias("lost_digest"))
        .agg(F.collect_list("pos").alias("lost"))
    )
    joined = rows.join(lost, same(rows, lost, {"id": "lost_id", "digest": "lost_digest"}), "left")
    parts = joined.select("row", F.split(text_of(), "\n").alias("lines"), "lost")
    # set difference and lookups by position: linear in the lines of a text
    stay = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.coalesce("lost", F.array().cast("array<int>")))
    picked = parts.select("row", "lines", stay.alias("stay"))
    return picked.select(
        "row",
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size("stay")).cast("long").alias("n_dropped"),
        F.when(F.size("stay") == F.size("lines"), text_of())
        .otherwise(F.array_join(F.transform("stay", lambda i: F.get("lines", i)), "\n")).alias("kept"),
    )


def without_shared_lines(docs: DataFrame, **limits) -> DataFrame:
    """``docs`` with the texts that :func:`drop_shared_lines` keeps; same columns, same rows."""
    out = drop_shared_lines(docs, **limits)
    return out.select(with_text("row", F.col("kept"), docs.columns).alias("row")).select("row.*")


@query("op7_line_dedup", f"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents),
keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '{UPPER}', '{LOWER}') AS key
  FROM lines),
shared AS (
  SELECT key, min(doc_id) AS keeper FROM keyed WHERE length(key) >= 10
  GROUP BY key HAVING count(DISTINCT doc_id) >= 2),
marked AS (
  SELECT k.doc_id, k.pos, k.line, s.key IS NOT NULL AND k.doc_id <> s.keeper AS lost
  FROM keyed k LEFT JOIN shared s ON k.key = s.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (lost) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT lost), '')) AS kept_sha256
FROM marked GROUP BY doc_id""")
def op7_line_dedup(spark, sf_dir):
    """Lines of every document that an earlier document already has, dropped."""
    out = drop_shared_lines(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("row.doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))
