"""URL rules and WARC derivatives."""

import gzip
import glob

import pytest
from pyspark.sql import functions as F

from tallgrass.llm import urls, warc

SF = "/root/testdata/sf0.01"


def brute(url, rules, default="allow"):
    rest = url.split("://", 1)[1] if url and "://" in url else None
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest)) if rest is not None else 0
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut]) if rest is not None else ""
    path = rest[cut:].split("?")[0].split("#")[0] if rest is not None else ""
    fits = [(len(h + p), len(h), v == "block", h + p, v) for h, p, v in rules
            if (h == "" or (host and (host == h or host.endswith("." + h)))) and path.startswith(p)]
    best = max(fits, default=None)
    return host, path, best[3] if best else None, best[4] if best else default


URLS = ["http://EXAMPLE.net/en/x", "https://a.b.example.net/en/?q#f", "x://example.net", "http://example.net?/en/", "http://net/", "http://notexample.net/en/",
        "ftp://Example.com/de/1#t", "http://example.com/deep", "http://x.org/fr/", "http://org/fr/a?b", "no scheme", "", None, "://", "http://",
        "http://a-b.example.net/en/", "http://example.net./en/", "http://www.example.org/fr/é", "http://user@h.net:80/en/", "http://x.org\n/fr/", "a://b://c.net/d"]
RULES = [*urls.RULES, ("example.net", "/en/x", "block"), ("a.b.example.net", "", "allow"), ("com", "", "block"), ("com", "", "allow"), ("", "/deep", "block")]


@pytest.mark.parametrize("n_parts", [1, 3, 16])
@pytest.mark.parametrize("given", [RULES, urls.RULES, []])
def test_judged_as_brute_force(spark, n_parts, given):
    pages = spark.createDataFrame([(i, u, u, i) for i, u in enumerate(URLS * 3)], "page_id int, url string, host string, part int")
    rules = spark.createDataFrame(given, "host string, path string, verdict string")
    got = urls.judge_urls(pages, rules, n_parts=n_parts).collect()
    assert len(got) == 3 * len(URLS)
    for r in got:
        assert (r.host, r.path, r.rule, r.verdict) == brute(r.row.url, given), r.row.url
    kept = urls.allowed_pages(pages, rules, n_parts=n_parts)
    assert kept.columns == pages.columns and kept.count() == sum(brute(u, given)[3] != "block" for u in URLS * 3)


def test_no_pages(spark):
    pages = spark.createDataFrame([], "page_id int, url string")
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    assert urls.judge_urls(pages, rules).count() == 0


def test_one_hot_url_uses_all_parts(spark):
    pages = spark.range(4000).select("id", F.lit("http://a.example.net/en/1").alias("url"))
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    out = urls.judge_urls(pages, rules, n_parts=8)
    assert out.where("rule = 'example.net/en/'").count() == 4000
    assert out.select(F.spark_partition_id()).distinct().count() > 2


def test_derivatives_link_and_round_trip(spark, tmp_path):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    records = warc.derivatives(warc.responses_of(pages)).cache()
    rows = {(r.page_id, r.warc_type): r for r in records.collect()}
    assert len(rows) == 2 * pages.count() and len({r.record_id for r in rows.values()}) == len(rows)
    for p in pages.collect():
        meta, text = rows[p.page_id, "metadata"], rows[p.page_id, "conversion"]
        assert meta.refers_to == text.refers_to and meta.target_uri == p.url and meta.payload_digest == warc.digest(p.html.encode())
        assert text.block == warc.plain_text(p.html) and text.block_digest == warc.digest(text.block.encode())
        assert "<" not in text.block and "track(" not in text.block and "margin" not in text.block
        fields = [x.split(": ", 1) for x in meta.block.split("\r\n")[:-1]]
        assert ["source-payload-digest", meta.payload_digest] in fields and ["source-http-content-type", "text/html; charset=utf-8"] in fields
        assert sum(k == "outlink" for k, _ in fields) == p.html.count("<a href=")
    warc.write_warc(records, str(tmp_path / "w"))
    read = [r for f in glob.glob(f"{tmp_path}/w/*.gz") for r in warc.parse_warc(gzip.open(f).read())]
    assert len(read) == len(rows)
    by_id = {r.record_id: r for r in rows.values()}
    for headers, block in read:
        r = by_id[headers["WARC-Record-ID"]]
        assert block == r.block.encode() and headers["WARC-Refers-To"] == r.refers_to and headers["WARC-Block-Digest"] == warc.digest(block)
        assert headers["WARC-Type"] == r.warc_type and headers["WARC-Target-URI"] == r.target_uri
    records.unpersist()


def test_plain_text():
    page = "<!doctype html><html><head><title>A &amp; B</title><style>p{}</style><script>if (a<b) '</p>'</script></head><body>x<b>y</b>&nbsp;z<br>2 &lt; 3<!-- no --><p>p\n\n q</p></body>"
    assert warc.plain_text(page) == "A & B\nxy z\n2 < 3\np\nq"
    assert warc.plain_text("") == "" and warc.plain_text("plain < text") == "plain < text"


def test_odd_pages(spark):
    pages = spark.createDataFrame([(1, None, None, "x"), (None, "http://a/\r\nX: y", "<p>a", "y"), (None, "http://a/\r\nX: y", "<p>a", "y"), (2, "", "", None)],
                                  "page_id long, url string, html string, head string")
    got = warc.derivatives(warc.responses_of(pages)).collect()
    assert len(got) == 8
    for r in got:
        assert [b for _, b in warc.parse_warc((r.head + r.block + "\r\n\r\n").encode())] == [r.block.encode()]
    assert warc.derivatives(warc.responses_of(pages.where("false"))).count() == 0


def test_urls_beside_columns_of_any_type(spark):
    """Maps and nested columns pass through; many parts, so bounds are searched in two steps."""
    from tallgrass.llm import urls

    pages = spark.range(400).selectExpr("id", "concat('https://h', id % 37, '.example.net/en/', id) AS url", "map('k', id) AS m", "named_struct('a', array(id)) AS s")
    pages = pages.unionByName(spark.createDataFrame([(1000, None, None, None)], "id long, url string, m map<string,bigint>, s struct<a:array<bigint>>"))
    rules = spark.createDataFrame([("net", "/", "block"), ("h7.example.net", "/en/", "allow"), ("", "/zz", "block")], "host string, path string, verdict string")
    wants = {f"h{k}.example.net": ("allow", "h7.example.net/en/") if k == 7 else ("block", "net/") for k in range(37)} | {"": ("allow", None)}
    for parts in (1, 2, 3, 50, 211):
        got = urls.judge_urls(pages, rules, n_parts=parts).select("row.id", "row.m", "host", "verdict", "rule").collect()
        assert len(got) == 401 and all((r.verdict, r.rule) == wants[r.host] and (r.m is None or r.m == {"k": r.id}) for r in got)
