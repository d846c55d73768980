"""Page scanners: what they find against plain (quadratic) patterns, and their time on pages that never close anything."""

import html
import random
import re
import time

import pytest

from tallgrass.llm import warc

DROPPED = re.compile(r"<!--.*?-->|<(script|style|noscript|template)\b[^>]*>.*?</\1\s*>", re.S | re.I)
LINK = re.compile(r"""<a\b[^>]*?\bhref\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+))""", re.I)
TITLE = re.compile(r"<title\b[^>]*>(.*?)</title\s*>", re.S | re.I)
LANG = re.compile(r"""<html\b[^>]*?\blang\s*=\s*["']?([A-Za-z-]+)""", re.I)
PARTS = ["<!--", "-->", "<script", "</script>", "</script >", "<STYLE>", "</style>", ">", "<", " a ", "<a ", "<a href=", "href=", "href = '", '"', "'", "<title>",
         "</title>", "<title", "<html lang=en>", "<html ", "lang=", "lang='de'", "<p>", "<br/>", "<br ", "x", "\n", "&amp;", "<b", "/>", "<template>", "</template\n>", " "]


def test_random_pages_against_patterns():
    rng = random.Random(1)
    for _ in range(8000):
        page = "".join(rng.choice(PARTS) for _ in range(rng.randint(0, 25)))
        text = re.sub(r"</?[a-zA-Z!][^>]*>", "", warc._BREAK.sub("\n", DROPPED.sub("", page)))
        text = re.sub(r" ?\n[ \n]*", "\n", re.sub(r"[ \t\f\v\r\xa0]+", " ", html.unescape(text))).strip()
        assert warc.plain_text(page) == text, page
        assert list(warc.links_of(page)) == [next((g for g in m.groups() if g), "") for m in LINK.finditer(page)], page
        title, lang = TITLE.search(page), LANG.search(page)
        assert warc.title_of(page) == (title and title[1]) and warc.language_of(page) == (lang and lang[1]), page


@pytest.mark.parametrize("piece", ["<script>", "<!--", "<a ", "<title>", '<a href="', "<a href='x", "<html ", "<p ", "<style", "</script", "<script>x</script ", "< ", "<br "])
def test_a_megabyte_of_unclosed_markup(piece):
    page = piece * (1_000_000 // len(piece))
    began = time.process_time()
    warc.plain_text(page)
    warc.metadata_block({"record_id": "r", "http_head": ""}, page, "d", "")
    assert time.process_time() - began < 1
