"""BPE encoding and decoding by a tokenization automaton.

The automaton's arcs are tokens, and its paths are exactly the token sequences that the merges
can leave. It is built by one merge gadget after another. It starts as one state with an arc
to itself for each base token. The gadget of the merge ``(u, v) -> uv`` sends all ``u`` arcs,
which all lead to one state ``s``, to a copy of ``s`` that lacks the ``v`` arc, and gives every
state with a ``u`` arc an arc ``uv`` to where ``v`` led from ``s``.

The finished states and arcs are one table of bits, compiled once on the driver and sent to
the workers; a word is encoded by steps through the table.
"""

from __future__ import annotations

import json
import re
import struct
import unicodedata
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallgrass.llm.common import byte_slices, packed, text_of
from tallgrass.llm.registry import query
from tallgrass.queries import read

#: Bytes of encoded words that a Python process remembers, twice over, and the longest word among them.
_REMEMBERED, _SHORT = 20 << 20, 32
#: Places that note whether a word was met before; a word is remembered the second time.
_MET = 1 << 21
#: Code of the end of a word, beside those of the bytes.
_END = 256
#: Bytes of text encoded before the results are passed on.
_SLICE = 2 << 20


class Automaton:
    """States and arcs compiled from merges.

    All arcs of a token lead to one state, a row of ``table``; row 0, with every arc, is the start.
    A bit of the row, in the token's column, says that the arc of the token is gone. States that
    lack the same arcs are one, as are the columns of tokens that go together.
    """

    def __init__(self, tokens: dict, merges: list, end: str, codes: dict | None = None):
        """``codes`` numbers the letters below 256; without it they are their own code points."""
        size = max(tokens.values()) + 1
        right, born = [-1] * size, [0] * size
        takes: list = [[] for _ in range(size)]  # arcs (token, gadget) that the gadgets of merges with this first part took
        longer: list = [[] for _ in range(size)]  # tokens that begin with this one, in the order of their gadgets
        for step, (u, v) in enumerate(merges, 1):
            a, b, ab = tokens[u], tokens[v], tokens[u + v]
            right[ab], born[ab] = b, step
            takes[a].append((b, step))
            longer[a].append(ab)
        place, after = _places(longer, born, size)
        # A gadget that takes v also takes what later gadgets make of v: tokens beginning with v,
        # by way of one born since. These have places in a row.
        births = [[born[t] for t in ts] for ts in longer]

        def taken(v: int, step: int) -> list[tuple[int, int]]:
            k = bisect_left(births[v], step)
            own = [(place[v], place[v] + 1)]
            return own if k == len(longer[v]) else [*own, (place[longer[v][k]], after[v])]

        final = {i for t, i in tokens.items() if end and t.endswith(end)}  # nothing follows them
        gone: list = [()] * size
        target, numbers, spans = [0] * size, {(): 0}, [[]]
        for t in sorted(tokens.values(), key=lambda i: born[i]):
            if t not in final:
                # the state of its second part as that was when the token was made, then its own gadgets
                gone[t] = (*((x for x in gone[right[t]] if x[1] < born[t]) if right[t] >= 0 else ()), *takes[t])
                if gone[t] not in numbers:
                    numbers[gone[t]] = len(spans)
                    spans.append([span for v, step in gone[t] for span in taken(v, step)])
                target[t] = numbers[gone[t]]
        # Places between two neighbouring ends of any span are taken by the same states: one column.
        bounds = np.array(sorted({x for of in spans for span in of for x in span}), np.int64)
        self.states, self.columns = len(spans), len(bounds) + 1
        self.stride = (self.columns + 7) // 8
        table = np.zeros((self.states, self.stride), np.uint8)
        for state, of in enumerate(spans):
            if of:
                edge = np.zeros(self.columns, np.int32)
                at = np.searchsorted(bounds, np.array(of)) + 1
                np.add.at(edge, at[:, 0], 1)
                np.add.at(edge, at[:, 1], -1)
                table[state] = np.packbits(np.cumsum(edge) > 0, bitorder="little")
        self.table = table.tobytes()
        columns = np.searchsorted(bounds, np.array(place), "right").tolist()
        self.end = [_END] if end else []
        label = {i: [codes[c] if codes else ord(c) for c in (t.removesuffix(end) if i in final else t)] for t, i in tokens.items()}
        self._match([(label[i] + self.end if i in final else label[i], (i, columns[i], target[i] * self.stride)) for i in tokens.values()])

    def _match(self, arcs: list) -> None:
        """The trie of the arcs' labels, with the way back to the longest label that ends alike.

        ``ending[node]`` chains the arcs whose labels end there, longest first: length, place and
        bit of its column, token, target's row, next arc.
        """
        self.step: dict = {}
        arc_of: list = [None]
        depth, before, letter = [0], [0], [0]
        for label, arc in arcs:
            node = 0
            for c in label:
                at = self.step.get(node << 9 | c)
                if at is None:
                    at = self.step[node << 9 | c] = len(depth)
                    depth.append(depth[node] + 1)
                    before.append(node)
                    letter.append(c)
                    arc_of.append(None)
                node = at
            arc_of[node] = arc
        self.back = [0] * len(depth)
        self.ending: list = [None] * len(depth)
        for node in sorted(range(1, len(depth)), key=depth.__getitem__):
            other = before[node]
            while other:
                other = self.back[other]
                found = self.step.get(other << 9 | letter[node])
                if found is not None:
                    self.back[node] = found
                    break
            shorter = self.ending[self.back[node]]
            if arc_of[node]:
                token, column, row = arc_of[node]
                shorter = (depth[node], column >> 3, 1 << (column & 7), token, row, shorter)
            self.ending[node] = shorter

    def encode(self, word: bytes) -> list[int]:
        """The one path whose labels are the word's letters, the last with the end sign.

        From left to right, each place is settled once: a beginning of a word has one path, so
        one arc leads to each place, and its state is that arc's target.
        """
        step, back, ending, table = self.step, self.back, self.ending, self.table
        rows, arcs, node = [0], [(0, 0)], 0
        for c in [*word, *self.end]:
            at = step.get(node << 9 | c)
            while at is None and node:
                node = back[node]
                at = step.get(node << 9 | c)
            node = at or 0
            arc = ending[node]
            while arc is not None:
                length, byte, bit, token, row, arc = arc
                if not table[rows[-length] + byte] & bit:
                    rows.append(row)
                    arcs.append((length, token))
                    break
            else:
                raise ValueError(f"no path for {word!r}")
        path, at = [], len(arcs) - 1
        while at:
            length, token = arcs[at]
            path.append(token)
            at -= length
        return path[::-1]


def _places(longer: list, born: list, size: int) -> tuple[list[int], list[int]]:
    """Preorder place of each token in the trees of what begins with what, and where its tree ends."""
    place, after, n = [0] * size, [0] * size, 0
    made = {t for ts in longer for t in ts}
    for root in (t for t in range(size) if t not in made):
        stack = [(root, iter(longer[root]))]
        place[root], n = n, n + 1
        while stack:
            token, rest = stack[-1]
            child = next(rest, None)
            if child is None:
                after[token] = n
                stack.pop()
            else:
                place[child], n = n, n + 1
                stack.append((child, iter(longer[child])))
    return place, after


def byte_letters() -> list[str]:
    """The printable letter of each byte in byte-level vocabularies: printable Latin-1 stands for
    itself, the other bytes in order for the letters from U+0100 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = iter(range(0x100, 0x200))
    return [chr(b) if b in own else chr(next(rest)) for b in range(256)]


def lowered(text: str) -> str:
    """Each code point's own lower case (no final sigma)."""
    return text.lower() if "Σ" not in text else "Σ".lower().join(x.lower() for x in text.split("Σ"))


class Codec:
    """Encoder and decoder of a vocabulary file of the tokenizers library: NFC, blanks, lower case,
    a splitting pattern, byte letters, BPE with an end-of-word sign, no decoder."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        kinds = [n["type"] for n in spec["normalizer"]["normalizers"]]
        split, letters = spec["pre_tokenizer"]["pretokenizers"]
        if kinds != ["NFC", "Replace", "Lowercase"] or letters["type"] != "ByteLevel" or spec["decoder"] or not split["invert"]:
            raise ValueError(f"{path} needs steps that aren't covered")
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        # a merge of two parts, the second with the end sign, gives a token with that sign
        made = {u + v for u, v in merges}
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        tokens = {t: i for t, i in model["vocab"].items() if t in made or t not in special}
        self.automaton = Automaton(tokens, merges, model["end_of_word_suffix"], {c: b for b, c in enumerate(byte_letters())})
        self.splitting, self.special = split["pattern"]["Regex"], special
        self.labels: list = [b""] * (max([*model["vocab"].values(), *special.values()]) + 1)
        for token, i in [*model["vocab"].items(), *special.items()]:
            self.labels[i] = token.encode()
        self._prepare()

    def _prepare(self) -> None:
        self.pattern = regex.compile(self.splitting)
        self.special_pattern = re.compile("|".join(map(re.escape, sorted(self.special, key=len, reverse=True))))
        self.words: dict = {}
        self.older: dict = {}
        self.held, self.met = 0, bytearray(_MET)

    def __getstate__(self):
        return {k: getattr(self, k) for k in ("automaton", "splitting", "special", "labels")}

    def __setstate__(self, state):
        self.__dict__.update(state)
        self._prepare()

    def word(self, word: str) -> bytes:
        ids = self.older.get(word)
        if ids is None:
            path = self.automaton.encode(word.encode())
            ids = struct.pack(f"<{len(path)}I", *path)
            place = hash(word) & _MET - 1
            if not self.met[place]:
                self.met[place] = 1
                return ids
        if len(word) <= _SHORT:
            if self.held >= _REMEMBERED:
                self.older, self.words, self.held, self.met = self.words, {}, 0, bytearray(_MET)
            self.words[word] = ids
            self.held += 200 + 2 * len(word) + len(ids)  # with what Python needs for the entry
        return ids

    def _plain(self, text: str) -> bytes:
        if not text.isascii():
            text = unicodedata.normalize("NFC", text)
        text = lowered(text)  # white space needn't become blanks: no word holds any
        words, one = self.words, self.word
        if len(text) > _SLICE:  # word by word: a list of all would be many times the text
            return b"".join(one(m[0]) for m in self.pattern.finditer(text))
        return b"".join([words.get(w) or one(w) for w in self.pattern.findall(text)])

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        if "<|" not in text:
            return self._plain(text)
        out, at = [], 0
        for m in self.special_pattern.finditer(text):
            out += [self._plain(text[at:m.start()]), np.array([self.special[m[0]]], "<u4").tobytes()]
            at = m.end()
        return b"".join([*out, self._plain(text[at:])])

    def decode(self, ids: bytes) -> bytes:
        """The labels of the path's arcs, a blank between them, in UTF-8."""
        labels = self.labels
        return b" ".join([labels[i] for i in np.frombuffer(ids, "<u4").tolist()])


_CODECS: dict = {}


def codec(path: str) -> Codec:
    """The codec of a file, compiled once per driver."""
    if path not in _CODECS:
        _CODECS[path] = Codec(path)
    return _CODECS[path]


def coded(text: Column, shared: Broadcast) -> Column:
    """A text column as struct of ``ids`` (little-endian unsigned 32-bit integers) and ``decoded``.

    One function for both, so a task needs one Python process. Results go out every few
    megabytes of text. ``shared`` is a broadcast ``Codec``, whose size goes by the vocabulary.
    """

    @F.arrow_udf("ids binary, decoded string")
    def both(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        one = shared.value
        for texts in batches:
            for i, j, _, _ in byte_slices(texts, _SLICE):
                ids = [one.encode(t) for t in texts.slice(i, j - i).to_pylist()]
                decoded = pa.array([one.decode(x) for x in ids], pa.binary()).cast(pa.string())
                yield pa.StructArray.from_arrays([pa.array(ids, pa.binary()), decoded], ["ids", "decoded"])
                del ids, decoded

    return both(text)


def encode(docs: DataFrame, path: str) -> DataFrame:
    """``docs`` (text) as ``row``, ``ids`` (little-endian unsigned 32-bit integers), ``n_tokens`` and
    ``decoded`` (the text that the library's decode gives for these ids).

    The file is read and compiled on the driver; the table, of a size that goes by the vocabulary,
    is broadcast. Every row is encoded on its own; there is no shuffle. A null text counts as an empty one,
    which has no tokens; repeated rows are encoded each, an empty table gives an empty table.
    Strings of special tokens inside a text are those tokens, as the library has it.
    """
    shared = docs.sparkSession.sparkContext.broadcast(codec(path))
    out = packed(docs).select("row", coded(text_of(), shared).alias("coded"))
    return out.select("row", "coded.ids", (F.octet_length("coded.ids") / 4).cast("long").alias("n_tokens"), "coded.decoded")


@query("op3_bpe_automaton")
def op3_bpe_automaton(spark, sf_dir):
    """Ids and decoded text of every whole text under the public 49k word vocabulary, as digests."""
    import public_tokenizers

    path = public_tokenizers.path("word_bpe_49k.json")
    out = encode(read(spark, sf_dir, "documents").select("doc_id", "text"), path)
    return out.select("row.doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                      F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))
