"""Token counts: lengths only, from Arrow batches that are balanced by bytes."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallgrass.llm.common import packed, text_of
from tallgrass.llm.registry import query
from tallgrass.queries import read

#: A single blank between two characters that aren't blanks (nor the model's own sign for one).
_SAFE = re.compile("(?<=[^ ▁]) (?=[^ ▁])")
_MODELS: dict = {}


def _model(path: str):
    """The model of a file, once per Python process.

    A cut at a blank is safe if no piece holds a blank after another character: then no
    merge crosses it, and the model's dummy prefix stands for the blank that the cut takes.
    """
    if path not in _MODELS:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        inner = re.compile("[^▁]▁")
        safe = not any(inner.search(model.id_to_piece(i)) for i in range(model.get_piece_size()))
        safe = safe and model.encode("a") == model.encode("b a")[-len(model.encode("a")):]
        _MODELS[path] = (model, safe)
    return _MODELS[path]


def safe_pieces(text: str, limit: int) -> Iterator[str]:
    """The text cut at safe blanks into pieces of ``limit`` UTF-8 bytes or little more; the blanks go."""
    start = 0
    while True:
        # a code point has one to four bytes: step by what surely fits, until the piece is full
        at, held = start, 0
        while at < len(text) and held < limit:
            step = text[at:at + max(1, (limit - held) // 4)]
            at, held = at + len(step), held + len(step.encode())
        cut = _SAFE.search(text, at) if at < len(text) else None
        if cut is None:
            yield text[start:]
            return
        yield text[start:cut.start()]
        start = cut.end()


def count_batches(texts: Iterator[str], path: str, piece_bytes: int, batch_bytes: int) -> Iterator[int]:
    """Tokens of each text, in order; the library sees about ``batch_bytes`` bytes at a time, and only they are held."""
    model, safe = _model(path)
    counts, batch, owners, held = [0], [], [], 0

    def flush() -> None:
        for owner, ids in zip(owners, model.encode(batch, num_threads=1)):
            counts[owner] += len(ids)

    for text in texts:
        for piece in safe_pieces(text, piece_bytes) if safe else [text]:
            batch.append(piece)
            owners.append(len(counts) - 1)
            held += len(piece.encode())
            if held >= batch_bytes:
                flush()
                yield from counts[:-1]
                counts, batch, owners, held = counts[-1:], [], [], 0
        counts.append(0)
    flush()
    yield from counts[:-1]


def token_count(text: Column, path: str, piece_bytes: int = 1 << 16, batch_bytes: int = 1 << 19) -> Column:
    """Number of tokens of a text column under the SentencePiece model at ``path`` (on every executor)."""

    @F.arrow_udf("long")
    def counted(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield pa.array(count_batches((t.as_py() for t in texts), path, piece_bytes, batch_bytes), pa.int64())

    return counted(text)


def count_tokens(docs: DataFrame, path: str, limit: int = 4096) -> DataFrame:
    """``docs`` (text) as ``row``, ``n_bytes``, ``n_tokens`` and ``over_limit`` (more than ``limit`` tokens).

    Texts go to Python, only lengths come back; there is no shuffle. A null text counts as an
    empty one with no bytes and no tokens, repeated rows are counted each, an empty table gives
    an empty table. Very long texts are cut at blanks where no token can cross.
    """
    out = packed(docs).select("row", F.octet_length(text_of()).cast("long").alias("n_bytes"),
                              token_count(text_of(), path).alias("n_tokens"))
    return out.withColumn("over_limit", F.col("n_tokens") > limit)


@query("op9_token_counts")
def op9_token_counts(spark, sf_dir):
    """Tokens of every whole text under the public 32k SentencePiece vocabulary."""
    import public_tokenizers

    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    out = count_tokens(docs, public_tokenizers.path("piece_bpe_32k.model"))
    return out.select("row.doc_id", "n_bytes", "n_tokens", "over_limit")
