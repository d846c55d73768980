"""Quality classifier: a linear-chain conditional random field over the lines of a text.

Every line is good or bad. Emissions see the statistics of the line and of its two neighbours,
transitions which states follow each other; forward-backward gives each line's probability
of being good, and the mean of these, weighted by length, the quality of the text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallgrass.llm.common import byte_slices, drawn, packed, text_of
from tallgrass.llm.registry import query
from tallgrass.queries import read

_SLICE = 2 << 20

_UPPER, _LETTER, _DIGIT, _BLANK, _MARK, _STOP, _SYMBOL = range(7)
_KIND = np.full(256, _SYMBOL, np.uint8)
_KIND[128:] = _LETTER
for _kind, _bytes in ((_UPPER, b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"), (_LETTER, b"abcdefghijklmnopqrstuvwxyz"), (_DIGIT, b"0123456789"),
                      (_BLANK, b" \t\n\x0b\x0c\r"), (_MARK, b"!?"), (_STOP, b".,;:'\"()-")):
    _KIND[list(_bytes)] = _kind
#: Statistics of a line; the shares also go in as their square roots, which tell a few from none.
STATISTICS = ("size", "upper", "digit", "symbol", "mark", "stop", "blank", "repeat", "known_word", "word_size", "seen_line", "empty")
_SHARES = [1, 2, 3, 4, 5, 7, 8]
WIDTH = len(STATISTICS) + len(_SHARES)


def line_statistics(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Statistics (lines × ``WIDTH``) and sizes in code points of all lines of some texts, and each text's last line (exclusive).

    ``data`` holds the texts' UTF-8 bytes one after another, ``ends`` where each ends. A text
    has a line more than line feeds.
    """
    n = len(data)
    feed = np.flatnonzero(data == 10)
    starts_of_texts = np.concatenate([[0], ends[:-1]])
    begin = np.sort(np.concatenate([starts_of_texts, feed + 1]), kind="stable")
    stop = np.sort(np.concatenate([feed, ends]), kind="stable")
    until = np.searchsorted(feed, ends) + np.arange(1, len(ends) + 1)
    of = np.repeat(np.arange(len(ends)), np.diff(until, prepend=0))

    def count(flags: np.ndarray) -> np.ndarray:
        sums = np.zeros(n + 1, np.int32 if n < 2**31 else np.int64)
        np.cumsum(flags, out=sums[1:])
        return (sums[stop] - sums[begin]).astype(float)

    kind = _KIND[data]
    chars = count((data & 0xC0) != 0x80)
    size = np.maximum(chars, 1)
    solid = kind != _BLANK
    opens = solid.copy()
    opens[1:] &= ~solid[:-1]
    if n:
        opens[starts_of_texts[starts_of_texts < n]] = solid[starts_of_texts[starts_of_texts < n]]
    words = count(opens)
    at = np.flatnonzero(opens)
    offsets = np.zeros(len(at) + 1, np.int64)
    sums = np.concatenate([[0], np.cumsum(solid, dtype=np.int64)])
    offsets[:-1], offsets[-1] = sums[at], sums[-1]
    word = _codes(data[solid], offsets)
    line = np.searchsorted(begin, at, "right") - 1
    repeat = np.bincount(line[1:][(word[1:] == word[:-1]) & (line[1:] == line[:-1])], minlength=len(begin))
    pairs = np.unique(line * (word.max(initial=0) + 1) + word) // (word.max(initial=0) + 1)
    distinct = np.bincount(pairs, minlength=len(begin))
    bounds = np.concatenate([[0], np.cumsum(stop - begin)])
    body = _codes(data[data != 10], bounds)
    _, first = np.unique(of * len(begin) + body, return_index=True)
    seen = np.ones(len(begin))
    seen[first] = 0
    empty = words == 0
    some = np.maximum(words, 1)
    letters = np.maximum(count((kind == _UPPER) | (kind == _LETTER)), 1)
    out = np.stack([
        np.log1p(chars) / 8, count(kind == _UPPER) / letters, count(kind == _DIGIT) / size, count(kind == _SYMBOL) / size,
        count(kind == _MARK) / size, count(kind == _STOP) / size, (count(~solid)) / size, repeat / some, 1 - np.where(empty, 1, distinct / some),
        np.minimum(count(solid & ((data & 0xC0) != 0x80)) / some, 40) / 20, seen * ~empty, empty,
    ], axis=1)
    return np.concatenate([out, np.sqrt(out[:, _SHARES])], axis=1), chars, until


def _codes(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Number of each byte string among the distinct ones."""
    strings = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(data)])
    return pc.dictionary_encode(strings).indices.to_numpy(zero_copy_only=False).astype(np.int64)


def _inputs(stats: np.ndarray, until: np.ndarray) -> np.ndarray:
    """Statistics of each line and its neighbours, whether there are any, and a one."""
    before, after = np.zeros_like(stats), np.zeros_like(stats)
    before[1:], after[:-1] = stats[:-1], stats[1:]
    first, last = np.zeros(len(stats)), np.zeros(len(stats))
    first[np.concatenate([[0], until[:-1]])] = 1
    last[until - 1] = 1
    before[first == 1] = 0
    after[last == 1] = 0
    return np.concatenate([stats, before, after, np.stack([first, last, np.ones(len(stats))], axis=1)], axis=1)


def _messages(emission: np.ndarray, trans: np.ndarray, until: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Log odds of bad for good of the forward and backward messages at each line, all chains side by side."""
    size = np.diff(until, prepend=0)
    order = np.argsort(-size, kind="stable")
    start, size = (until - size)[order], size[order]
    active = np.searchsorted(-size, -np.arange(size[0] if len(size) else 0), "left")  # chains longer than t
    forward, backward = emission.copy(), np.zeros(len(emission))
    for t in range(1, len(active)):
        i = start[:active[t]] + t
        r = forward[i - 1]
        forward[i] += np.logaddexp(trans[0, 1], trans[1, 1] + r) - np.logaddexp(trans[0, 0], trans[1, 0] + r)
    ends = start + size - 1
    for t in range(1, len(active)):
        i = ends[:active[t]] - t
        r = emission[i + 1] + backward[i + 1]
        backward[i] = np.logaddexp(trans[1, 0], trans[1, 1] + r) - np.logaddexp(trans[0, 0], trans[0, 1] + r)
    return forward, backward


def _odds(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -500, 500)))


@dataclass
class LineField:
    """Weights of the emissions and transitions (state 1: bad), scale of the statistics, and the line from goodness to score."""

    weights: np.ndarray
    trans: np.ndarray
    mean: np.ndarray
    scale: np.ndarray
    offset: float = 0.0
    slope: float = 0.0

    def bad(self, stats: np.ndarray, until: np.ndarray) -> np.ndarray:
        """Probability of each line to be bad, given all lines of its text."""
        forward, backward = _messages(_inputs((stats - self.mean) / self.scale, until) @ self.weights, self.trans, until)
        return _odds(forward + backward)

    def goodness(self, bad: np.ndarray, chars: np.ndarray, until: np.ndarray) -> np.ndarray:
        """Mean of the lines' probabilities to be good, weighted by length (and one, so that empty texts have a weight)."""
        start = np.concatenate([[0], until[:-1]])
        return np.add.reduceat((1 - bad) * (chars + 1), start) / np.add.reduceat(chars + 1, start)

    def scores(self, data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Score of each text, each line's probability to be good, and each text's last line."""
        stats, chars, until = line_statistics(data, ends)
        bad = self.bad(stats, until)
        return _odds(self.offset + self.slope * self.goodness(bad, chars, until)), 1 - bad, until


def _ascend(x: np.ndarray, until: np.ndarray, bad: np.ndarray, weights: np.ndarray, trans: np.ndarray, steps: int, decay: float) -> None:
    """Raise the conditional likelihood of the line labels ``bad`` in place, by Adam over all chains at once."""
    inner = np.ones(len(x), bool)
    inner[np.concatenate([[0], until[:-1]])] = False
    here = np.flatnonzero(inner)
    seen = np.zeros((2, 2))
    np.add.at(seen, (bad[here - 1], bad[here]), 1)
    theta = [weights, trans]
    moment = [[np.zeros_like(p), np.zeros_like(p)] for p in theta]
    for step in range(1, steps + 1):
        e = x @ weights
        forward, backward = _messages(e, trans, until)
        p = _odds(forward + backward)
        left, right = forward[here - 1], e[here] + backward[here]
        pair = np.stack([np.full(len(here), trans[0, 0]), trans[0, 1] + right, trans[1, 0] + left, trans[1, 1] + left + right])
        pair = np.exp(pair - pair.max(axis=0, initial=-np.inf)) if len(here) else pair
        pair = (pair / pair.sum(axis=0)).sum(axis=1).reshape(2, 2) if len(here) else np.zeros((2, 2))
        grads = [(x.T @ (bad - p)) / len(x) - decay * weights, (seen - pair) / len(x) - decay * trans]
        for value, grad, (m, v) in zip(theta, grads, moment):
            m += 0.1 * (grad - m)
            v += 0.01 * (grad * grad - v)
            value += 0.1 * (1 - step / (steps + 1)) * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)


def learn(stats: list[np.ndarray], chars: list[np.ndarray], good: np.ndarray, steps: int = 100, rounds: int = 2, decay: float = 1e-4) -> LineField:
    """Field from texts of known quality, whose lines' labels are not known.

    First every line has its text's label, and is learned from on its own, without neighbours:
    so a good line of a bad text is seen to be like those of good texts. Then, ``rounds`` times,
    the lines of bad texts that are likelier good become good, and the whole field learns on.
    Last, a logistic line through the texts' goodness makes the score a probability of the label.
    """
    x, sizes = np.concatenate(stats), np.concatenate(chars)
    until = np.cumsum([len(s) for s in stats])
    of = np.repeat(np.arange(len(stats)), np.diff(until, prepend=0))
    field = LineField(np.zeros(3 * WIDTH + 3), np.zeros((2, 2)), x.mean(axis=0), np.maximum(x.std(axis=0), 1e-3))
    inputs = _inputs((x - field.mean) / field.scale, until)
    alone = inputs.copy()
    alone[:, WIDTH:-1] = 0
    _ascend(alone, np.arange(1, len(x) + 1), (~good[of]).astype(np.int64), field.weights, field.trans, steps, decay)
    found = _odds(alone @ field.weights)
    for _ in range(rounds):
        _ascend(inputs, until, (~good[of] & (found >= 0.5)).astype(np.int64), field.weights, field.trans, steps // 2, decay)
        found = field.bad(x, until)
    goodness = field.goodness(found, sizes, until)
    design = np.stack([np.ones(len(good)), goodness], axis=1)
    line = np.zeros(2)
    for _ in range(50):
        p = _odds(design @ line)
        hessian = (design * (p * (1 - p))[:, None]).T @ design + np.diag([1e-3, 1e-2])
        line += np.clip(np.linalg.solve(hessian, design.T @ (good - p) - np.array([1e-3, 1e-2]) * line), -4, 4)
    field.offset, field.slope = float(line[0]), float(max(line[1], 0.0))
    return field


def fit(docs: DataFrame, labels: DataFrame, sample: int = 2000, most_lines: int = 200, **settings) -> LineField | None:
    """Learn from at most ``sample`` labelled documents of at most ``most_lines`` lines (``labels``: doc_id, quality 0 or 1).

    The sample goes by digests of the ids. A doc_id with several rows counts once (smallest
    text, lowest label), so at most ``sample * most_lines`` lines of ``WIDTH`` numbers reach the
    driver. Rows without a label and labels without a document are left out; None without any.
    """
    known = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    some = F.broadcast(drawn(known, "doc_id", sample, 11).select(F.col("doc_id").alias("id"), "quality"))
    texts = packed(docs.select("doc_id", "text")).select(F.col("row.doc_id").alias("doc_id"), text_of().alias("text"))
    rows = texts.join(some, F.col("doc_id") == F.col("id")).groupBy("doc_id", "quality").agg(F.min("text").alias("text"))
    lines = F.length("text") - F.length(F.translate("text", "\n", "")) + 1

    def numbers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, data, ends in byte_slices(batch.column("text"), _SLICE):
                stats, chars, until = line_statistics(data, ends)
                packed_rows = [[x[a:b].astype("<f8").tobytes() for a, b in zip(np.concatenate([[0], until[:-1]]), until)] for x in (stats, chars)]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(i, j - i).cast(pa.string()), batch.column("quality").slice(i, j - i).cast(pa.int64()),
                                                  *[pa.array(x, pa.binary()) for x in packed_rows]], ["id", "quality", "stats", "chars"])

    got = rows.where(lines <= most_lines).mapInArrow(numbers, "id string, quality long, stats binary, chars binary").collect()
    got.sort(key=lambda r: r.id)
    if not got:
        return None
    return learn([np.frombuffer(r.stats, "<f8").reshape(-1, WIDTH) for r in got], [np.frombuffer(r.chars, "<f8") for r in got],
                 np.array([r.quality == 1 for r in got]), **settings)


def quality_score(text: Column, field: LineField) -> Column:
    """Score of a text column, from 0 to 1; no nulls."""

    @F.arrow_udf("double")
    def scored(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            parts = [field.scores(data, ends)[0] for _, _, data, ends in byte_slices(texts, _SLICE)]
            yield pa.array(np.concatenate(parts) if parts else np.zeros(0))

    return scored(text)


def line_qualities(text: Column, field: LineField) -> Column:
    """Probability of each line to be good, in the order of the lines."""

    @F.arrow_udf("array<double>")
    def scored(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            parts, ends_of = [np.zeros(0)], [np.zeros(1, np.int64)]
            for _, _, data, ends in byte_slices(texts, _SLICE):
                _, good, until = field.scores(data, ends)
                ends_of.append(until + ends_of[-1][-1])
                parts.append(good)
            yield pa.ListArray.from_arrays(pa.array(np.concatenate(ends_of).astype(np.int32)), pa.array(np.concatenate(parts)))

    return scored(text)


def judge(docs: DataFrame, field: LineField | None, lines: bool = False) -> DataFrame:
    """``docs`` (text) as ``row`` with ``score`` (0 to 1, higher: better) and, if asked, ``lines``, each line's probability to be good.

    Only the text goes into the score. A null text is an empty one, which is one empty line;
    repeated rows score alike, an empty table gives an empty one. Without a field, for want of
    labels, every score is 0.5.
    """
    out = packed(docs)
    score = F.lit(0.5) if field is None else quality_score(text_of(), field)
    return out.select("row", score.alias("score"), *([line_qualities(text_of(), field).alias("lines")] if lines else []))


@query("op11_line_crf")
def op11_line_crf(spark, sf_dir):
    """Quality of every document; documents whose id has a crc32 of 1 modulo 3 are not learned from."""
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    out = judge(docs, fit(docs, read(spark, sf_dir, "labels").where(~held_out)))
    rows = out.select("row.doc_id", "score")
    return rows.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
