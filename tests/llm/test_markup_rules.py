"""Attributes and elements by the rules of HTML, and what belongs to an article by where it stands."""

import time

import pytest
from pyspark.sql import functions as F

from pricebeam.llm.html_text import blocks_of, extract_text, main_text

LONG = "text of the article that is long enough to count"


@pytest.mark.parametrize("page,expected", [
    ("<p data-x=it's>A</p><p>second don't B</p><p>third C</p>", "A\n\nsecond don't B\n\nthird C"),
    ("<p title=\"a>b's\">A</p><p title = 'x\">y'>B</p><p a=\"=>\" b=c=d'e>C</p>", "A\n\nB\n\nC"),
    ("<aside data-u=/x/>advert</aside><p>kept</p>", "kept"),
    ("<div class=ad data-u=/x/>advert</div><p>kept</p>", "kept"),
    ("<div><span class=ad data-u=/x/>advert</span><p>kept</p></div>", "kept"),
    ("<div><p>a <a name=\"x\"/>b<br/>c<img src=/y/>d</p></div>", "a b cd"),
    ("<div title='class=ad' data-class=ad>kept</div>", "kept"),
    ("<div><svg viewbox='0 0'/><p>kept</p><svg><text>no</text></svg><select-box>too</select-box></div>", "kept\n\ntoo"),
    ("<div><script data-x='>'>no</script>yes</div>", "yes"),
    ("<p =x>A</p><p x=>B</p><p 'y>C</p>", "A\n\nB\n\nC"),
])
def test_attributes(page, expected):
    assert main_text(page) == expected


def test_parts_of_an_article_stay():
    page = (f"<body><header><h1>Site</h1></header><article><header class=header><h1>Title</h1><p>By someone</p><nav><h2>Menu</h2></nav></header>"
            f"<p>{LONG}</p><figure><img src=x><figcaption>Caption</figcaption></figure><blockquote class=reply><p>{LONG} quoted</p></blockquote>"
            f"<p class=share>A share of the work</p><p class=share><a href=x>Share this page</a></p><div class=related>Other pages</div>"
            f"<p class=notice>Read the notice</p><p>{LONG}</p><section class=comments><article><p>{LONG} {LONG} {LONG}</p>"
            f"<blockquote class=reply>no</blockquote></article></section></article><article class=comment><p>{LONG} reader</p></article>"
            f"<figcaption>elsewhere</figcaption></body>")
    assert main_text(page) == "\n\n".join(["Title", LONG, "Caption", f"{LONG} quoted", "A share of the work", LONG])


def test_outside_an_article_words_decide():
    page = f"<body><div class=text><p>{LONG}</p><p class=share>Share</p><blockquote class=reply>Reply</blockquote></div></body>"
    assert main_text(page) == LONG


def test_depth_and_length_are_linear():
    def seconds(page):
        start = time.perf_counter()
        found = blocks_of(page)
        return time.perf_counter() - start, found

    spent, found = seconds("<div>" * 20_000 + LONG + "</div>" * 20_000)
    assert [x[2] for x in found] == [LONG] and spent < 2
    spent, found = seconds(f"<p title=it's>{LONG}</p>" * 40_000)
    assert len(found) == 40_000 and spent < 8


def test_odd_tables(spark):
    page = f"<body><div class=post><p>{LONG}</p></div></body>"
    rows = [(1, "http://h.example/", page, "t", 5, "p", "h")] * 2 + [(None, None, None, None, None, None, None), (2, "http://h.example/", "", "t", 6, "p", "h")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string, n_chars long, path string, host string")
    got = extract_text(pages)
    assert sorted(got.columns) == sorted(pages.columns)
    assert [tuple(x) for x in got.filter("page_id = 1").select("text", "n_chars", "path", "host", "html").collect()] == [
        (LONG, len(LONG), "p", "h", page)] * 2
    assert [tuple(x) for x in got.filter("page_id IS NULL").select("text", "n_chars", "path", "url").collect()] == [("", 0, None, None)]
    assert got.filter(F.col("page_id") == 2).first()["text"] == ""
