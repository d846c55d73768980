"""WARC derivatives: metadata and plain-text conversion records linked to their responses."""

from __future__ import annotations

import base64
import hashlib
import html
import re
import uuid
from bisect import bisect_left
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallgrass.llm.registry import query
from tallgrass.queries import read

_DROPPED = re.compile(r"<!--|<(script|style|noscript|template)\b", re.I)
_DROPPED_END = re.compile(r"</(script|style|noscript|template)\s*>", re.I)
_BREAK = re.compile(r"<(?:/?(?:p|div|li|ul|ol|h[1-6]|tr|table|article|section|nav|header|footer|blockquote|pre|title|body|head|html)\b[^>]*|br\s*/?)>", re.I)
_TAG = re.compile(r"</?[a-zA-Z!][^>]*>")
_LINK, _HREF, _BARE = re.compile(r"<a\b", re.I), re.compile(r"\bhref\s*=\s*", re.I), re.compile(r"""[^\s>"']+""")
_TITLE, _TITLE_END = re.compile(r"<title\b", re.I), re.compile(r"</title\s*>", re.I)
_HTML, _LANG = re.compile(r"<html\b", re.I), re.compile(r"""\blang\s*=\s*["']?([A-Za-z-]+)""", re.I)
_BLANKS, _LINES = re.compile(r"[ \t\f\v\r\xa0]+"), re.compile(r" ?\n[ \n]*")

RECORDS = ("page_id {kind}, warc_type string, record_id string, refers_to string, target_uri string, date string, "
           "content_type string, content_length long, block_digest string, payload_digest string, head string, block string")


def digest(data: bytes) -> str:
    """``sha1:`` and the digest in base 32, as WARC files label it."""
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def urn(*parts: str) -> str:
    """Record id from what it stands for: the same parts give the same id in every run."""
    return f"<urn:uuid:{uuid.UUID(bytes=hashlib.sha256(chr(0).join(parts).encode()).digest()[:16], version=4)}>"


class _Page:
    """A page with places asked for in rising order, so that no stretch is searched twice."""

    def __init__(self, text: str):
        self.text, self.found = text, {}

    def find(self, what: str, at: int) -> int:
        """First place of ``what`` from ``at`` on, or the page's end; remembered until it is passed."""
        place = self.found.get(what, -1)
        if place < at:
            place = self.text.find(what, at)
            place = self.found[what] = len(self.text) if place < 0 else place
        return place


def without_dropped(text: str) -> str:
    """The page without comments and without elements whose content is no text; unclosed ones stay."""
    page, n, out, at, pos = _Page(text), len(text), [], 0, 0
    ends: dict = {}
    for m in _DROPPED_END.finditer(text):
        ends.setdefault(m[1].casefold(), ([], []))
        ends[m[1].casefold()][0].append(m.start())
        ends[m[1].casefold()][1].append(m.end())
    while m := _DROPPED.search(text, pos):
        if m[1] is None:
            stop = page.find("-->", m.end()) + 3
        else:
            starts, stops = ends.get(m[1].casefold(), ((), ()))
            k = bisect_left(starts, page.find(">", m.end()) + 1)
            stop = stops[k] if k < len(starts) else n + 1
        if stop > n:
            pos = m.end()
            continue
        out.append(text[at:m.start()])
        at = pos = stop
    return "".join([*out, text[at:]])


def _tags_replaced(pattern: re.Pattern, by: str, text: str) -> str:
    """Behind the last ``>`` there is no tag to look for."""
    last = text.rfind(">") + 1
    return pattern.sub(by, text[:last]) + text[last:]


def plain_text(page: str) -> str:
    """A page's text: scripts, styles and comments go, block tags break lines, character references resolve.

    Takes time in proportion to the page, also where elements, tags or quotes never close.
    """
    text = _tags_replaced(_TAG, "", _tags_replaced(_BREAK, "\n", without_dropped(page)))
    return _LINES.sub("\n", _BLANKS.sub(" ", html.unescape(text))).strip()


def title_of(text: str) -> str | None:
    """What the first title element that closes holds."""
    page, ends = _Page(text), [(m.start(), m) for m in _TITLE_END.finditer(text)]
    starts = [s for s, _ in ends]
    for m in _TITLE.finditer(text):
        begin = page.find(">", m.end()) + 1
        k = bisect_left(starts, begin)
        if k == len(starts):
            return None
        return text[begin:starts[k]]
    return None


def language_of(text: str) -> str | None:
    """The ``lang`` of the first html tag that has one."""
    page, pos = _Page(text), 0
    while m := _HTML.search(text, pos):
        pos = page.find(">", m.end())
        if lang := _LANG.search(text, m.end(), pos):
            return lang[1]
    return None


def links_of(text: str) -> Iterator[str]:
    """The href of each link, quoted or bare; one whose quote never closes is none."""
    page, n, pos = _Page(text), len(text), 0
    while m := _LINK.search(text, pos):
        pos = end = page.find(">", m.end())
        h = _HREF.search(text, m.end(), end)
        while h:
            quote = text[h.end():h.end() + 1]
            if quote in ('"', "'") and quote:
                stop = page.find(quote, h.end() + 1)
                value = text[h.end() + 1:stop] if stop < n else None
                stop += 1
            else:
                bare = _BARE.match(text, h.end())
                value, stop = (bare[0], bare.end()) if bare else (None, 0)
            if value is not None:
                yield value
                pos = stop
                break
            h = _HREF.search(text, h.end(), end)


def one_line(text: str) -> str:
    return " ".join(text.split())


def record(kind: str, record_id: str, source: dict, content_type: str, block: bytes) -> tuple[str, str]:
    """Head of a derived record, and the digest of its block; what links it to its response comes first."""
    block_digest = digest(block)
    fields = [("WARC-Type", kind), ("WARC-Record-ID", record_id), ("WARC-Refers-To", source["record_id"]),
              ("WARC-Target-URI", source["target_uri"]), ("WARC-Date", source["date"]),
              ("WARC-Block-Digest", block_digest), ("Content-Type", content_type), ("Content-Length", str(len(block)))]
    return "WARC/1.0\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n", block_digest


def metadata_block(source: dict, page: str, payload_digest: str, text: str) -> str:
    """``application/warc-fields``: the response's own headers and digests, then what its page says of itself."""
    fields = [("source-record-id", source["record_id"]), ("source-payload-digest", payload_digest),
              *[(f"source-http-{k.strip().lower()}", v.strip()) for k, _, v in (x.partition(":") for x in source["http_head"].split("\r\n")[1:] if ":" in x)],
              ("source-http-status", source["http_head"].split("\r\n")[0])]
    if (title := title_of(page)) is not None:
        fields.append(("title", one_line(html.unescape(title))))
    if lang := language_of(page):
        fields.append(("language", lang))
    fields += [("outlink", one_line(html.unescape(link))) for link in links_of(page)]
    fields.append(("text-digest", digest(text.encode())))
    return "".join(f"{k}: {v}\r\n" for k, v in fields)


def _derived(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    names = ["page_id", "warc_type", "record_id", "refers_to", "target_uri", "date", "content_type", "content_length",
             "block_digest", "payload_digest", "head", "block"]
    for pdf in batches:
        out = []
        for page_id, record_id, uri, date, http_head, payload in zip(*(pdf[c] for c in ("page_id", "record_id", "target_uri", "date", "http_head", "payload"))):
            source = {"record_id": record_id, "target_uri": uri, "date": date, "http_head": http_head}
            whole = payload.encode()
            payload_digest, text = digest(whole), plain_text(payload)
            for kind, content_type, block in (("metadata", "application/warc-fields", metadata_block(source, payload, payload_digest, text)),
                                              ("conversion", "text/plain; charset=utf-8", text)):
                own, data = urn(record_id, kind), block.encode()
                head, block_digest = record(kind, own, source, content_type, data)
                out.append((page_id, kind, own, record_id, uri, date, content_type, len(data), block_digest, payload_digest, head, block))
        frame = pd.DataFrame(out, columns=names)
        frame["page_id"] = frame["page_id"].astype(pdf["page_id"].dtype)
        yield frame


def derivatives(responses: DataFrame) -> DataFrame:
    """A metadata and a conversion record for every response.

    ``responses`` has page_id, record_id, target_uri, date, http_head (status line and header
    lines) and payload (the page). Record ids come from the response's id, so a rerun after a
    lost executor writes the same records; repeated responses give repeated records. Null
    texts count as empty ones, an empty table gives an empty table, other columns are left out.
    Every response is worked on alone; there is no shuffle.
    """
    texts = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("record_id", "target_uri", "date", "http_head", "payload")]
    narrow = responses.select("page_id", *texts)
    return narrow.mapInPandas(_derived, RECORDS.format(kind=narrow.schema["page_id"].dataType.simpleString()))


def responses_of(pages: DataFrame, date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """Pages (page_id, url, html) as responses; the id is made of page_id and url, line ends in a url go."""
    uri = F.regexp_replace(F.coalesce(F.col("url").cast("string"), F.lit("")), "[\\r\\n]+", "")
    key = F.sha2(F.concat_ws("\x00", F.coalesce(F.col("page_id").cast("string"), F.lit("")), uri), 256)
    parts = [F.substring(key, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return pages.select("page_id", F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">")).alias("record_id"), uri.alias("target_uri"),
                        F.lit(date).alias("date"), F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8").alias("http_head"),
                        F.col("html").alias("payload"))


def write_warc(records: DataFrame, path: str) -> None:
    """Records as gzip WARC files, one a task, below ``path`` (any file system that Spark writes)."""
    lines = records.select(F.concat("head", "block", F.lit("\r\n")).alias("value"))
    lines.write.mode("overwrite").option("lineSep", "\r\n").option("compression", "gzip").text(path)


def parse_warc(data: bytes) -> Iterator[tuple[dict, bytes]]:
    """Headers and block of each record of an unpacked WARC file."""
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        lines = data[at:end].decode().split("\r\n")
        if lines[0] != "WARC/1.0":
            raise ValueError(f"no WARC record at byte {at}")
        headers = dict(x.split(": ", 1) for x in lines[1:])
        size = int(headers["Content-Length"])
        if data[end + 4 + size:end + 8 + size] != b"\r\n\r\n":
            raise ValueError(f"record at byte {at} doesn't end as it should")
        yield headers, data[end + 4:end + 4 + size]
        at = end + 8 + size


@query("op6_warc_derivatives")
def op6_warc_derivatives(spark, sf_dir):
    """Both derived records of every page, their blocks as digests and lengths."""
    out = derivatives(responses_of(read(spark, sf_dir, "pages")))
    return out.select("page_id", "warc_type", "record_id", "refers_to", "target_uri", "date", "content_type", "content_length",
                      "block_digest", "payload_digest", F.sha2(F.concat("head", "block"), 256).alias("record_sha256"))
