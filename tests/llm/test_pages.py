"""HTML extraction and WARC archives."""

import base64
import hashlib
import random

import pytest
from pyspark.sql import functions as F

from pricebeam.llm import warc
from pricebeam.llm.html_text import blocks_of, extract_text, host_paths, main_text
from pricebeam.llm.warc import LoserTree, archived_history, merged_index, read_archives, records_of, url_key, write_archives

LONG = "text of the article that is long enough to count"


@pytest.mark.parametrize("page,expected", [
    ("", ""), ("<", "<"), ("plain &amp; simple", "plain & simple"), ("<div><script>x</div>", ""),
    ("<p hidden>no</p><p>yes", "yes"), ("<ul><li>one<li>two</ul>", "one\n\ntwo"),
    ("<table><tr><td>a<td>b</table>", "a\n\nb"), ("</div></p>x<p", "x<p"),
    ("<p>a <span class='ad'>buy <b>now</b></span> b</p><p>c</p>", "a b\n\nc"),
    ("<p>one<br>two&nbsp;  three\n four</p>", "one two three four"), ("<p>&amp;amp; &#233; &unknown;</p>", "&amp; é &unknown;"),
    ("<p title='a>b'>c</p><!-- no --><p>d</p>", "c\n\nd"),
])
def test_blocks(page, expected):
    assert main_text(page) == expected


def test_everything_beside_the_article_goes():
    page = (f"<html><body><header><h1>Site</h1></header><nav><a href=x>Home</a></nav><div id='wrap'>"
            f"<div class='sidebar'><p>{LONG} beside</p></div><div class='post-12 content has-sidebar'><h2>Title</h2>"
            f"<p><b>{LONG}<br><p>More <a href=y>link</a> {LONG}<form>Name</form><div class='ad-box'>Buy</div>"
            f"<div class='comments'><p>{LONG} {LONG} {LONG} {LONG}</p></div></div></div>"
            f"<div class='cookie-notice'>We use cookies</div><aside>See</aside><footer>(c)</footer></body></html>")
    assert main_text(page) == f"Title\n\n{LONG}\n\nMore link {LONG}"


def test_paths_are_general():
    (path, dropped, text, linked), = blocks_of('<body><div class="post-12 b"><p>a <a href=x>bc</a></div>')
    assert (path, dropped, text, linked) == (("body", "div.b.post-#", "p"), False, "a bc", 2)


def test_hosts_agree_on_a_path(spark):
    page = f"<body><div class=story><p>{LONG} {LONG}</p></div><div class=list><p>{LONG}</p></div></body>"
    odd = f"<body><div class=story><p>{LONG}</p></div><div class=list>" + f"<p>{LONG}</p>" * 5 + "</div></body>"
    pages = spark.createDataFrame([(i, f"http://h.example/{i}", page) for i in range(4)]
                                  + [(9, "HTTP://user@H.example:80/x", odd), (10, None, odd), (11, "nonsense", None), (None, "http://h.example", "")],
                                  "page_id long, url string, html string")
    won = {x.host: (x.path, x.votes, x.pages) for x in host_paths(pages).collect()}
    assert won == {"h.example": ("body/div.story", 4, 5), "": ("body/div.list", 1, 1)}
    got = {x.page_id: (x.text, x.n_chars) for x in extract_text(pages).collect()}
    assert got[9] == (LONG, len(LONG))  # the host's path, against the page's own best
    assert got[10][0] == "\n\n".join([LONG] * 5)
    assert got[11] == ("", 0) and got[None] == ("", 0)
    assert extract_text(pages.limit(0)).collect() == []


def test_articles_of_the_test_pages(spark):
    import html
    import re
    rows = extract_text(spark.read.parquet("/root/testdata/sf0.01/pages.parquet")).collect()
    assert len(rows) == 250
    for x in rows:
        inner = x.html[x.html.index("<article>") + 9 : x.html.index("</article>")]
        blocks = (" ".join(html.unescape(re.sub("<[^>]*>", " ", b)).split()) for b in re.split(r"</?(?:p|h1)>", inner))
        assert x.text == "\n\n".join(b for b in blocks if b)


PAGES = [(1, "http://a.b/c", "x\r\n\r\ny"), (2, None, None), (3, "u\r\nv", ""), (4, "http://a.b/c", "x\r\n\r\ny"),
         (4, "http://[bad", "é"), (None, "http://a.b/c", "x\r\n\r\ny"), (None, "", "only"), (5, "https://www.a.b/?z=1&a=2#t", "x" * 50000)]


@pytest.fixture
def pages(spark):
    own = spark.createDataFrame(PAGES, "page_id long, url string, html string")
    given = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    return given.withColumn("page_id", F.col("page_id") + 100).union(own)


def test_archives(pages, monkeypatch):
    monkeypatch.setattr(warc, "RECORDS_PER_FILE", 9)
    given = pages.collect()
    first = {}
    for x in given:
        if x.page_id is not None:
            first[x.html or ""] = min(first.get(x.html or "", x.page_id), x.page_id)
    expected = []
    for x in given:
        body, least = (x.html or "").encode(), first.get(x.html or "")
        again = least is not None and (x.page_id is None or x.page_id > least)
        expected.append((x.page_id, len(body), base64.b32encode(hashlib.sha1(body).digest()).decode(),
                         "revisit" if again else "response", least if again else None))
    rows = archived_history(pages).orderBy("range", "place").collect()
    got = [(x.page_id, x.payload_bytes, x.payload_digest, x.record_type, x.refers_to) for x in rows]
    assert sorted(map(repr, got)) == sorted(map(repr, expected))
    keys = [(x.urlkey, x.timestamp, x.page_id is None, x.page_id or 0) for x in rows]
    assert keys == sorted(keys)
    assert len({x.file for x in rows}) > 3


def test_records_are_where_the_index_says(spark, pages, scratch):
    path = scratch("archives")
    write_archives(pages, path)
    files = {x.path: bytes(x.content) for x in spark.read.format("binaryFile").load(path).collect()}
    for x in read_archives(spark, path).collect():
        record = files[x.run][x.offset : x.offset + x.length]
        (_, length, fields, content), = records_of(record + b"\r\n\r\n")
        assert length == x.length and fields["warc-payload-digest"] == f"sha1:{x.payload_digest}"
        if x.record_type == "response":
            assert len(bytes(content).partition(b"\r\n\r\n")[2]) == x.payload_bytes
    assert archived_history(pages.limit(0)).collect() == []


def test_damaged_archives_fail():
    with pytest.raises(ValueError):
        list(records_of(b"WARC/1.1\r\nContent-Length: 5\r\n\r\nabc\r\n\r\n"))


@pytest.mark.parametrize("runs", [0, 1, 2, 3, 7, 16])
def test_loser_tree(runs):
    rng = random.Random(runs)
    given = [sorted([(f"r{i}", str(rng.randrange(20)), "t", rng.randrange(5), "", None, 0, "", j, 0, "") for j in range(rng.randrange(30))],
                    key=warc._order) for i in range(runs)]
    assert list(LoserTree([iter(x) for x in given])) == sorted((y for x in given for y in x), key=warc._order)


def test_one_url_is_parted_between_tasks(spark):
    rows = [("run", "k", f"2024{i:010d}", i, "response", None, 1, "D", i, 1, "u") for i in range(2000)]
    index = merged_index(spark.createDataFrame(rows, warc.INDEX_SCHEMA))
    assert index.select("range").distinct().count() > 1
    assert [x.page_id for x in index.orderBy("range", "place").collect()] == list(range(2000))


def test_url_keys():
    assert url_key("HTTPS://www.A.example:443/Path?b=2&a=1#x") == "example,a)/path?a=1&b=2"
    assert url_key("http://a.example:8080") == "example,a:8080)/"
    assert url_key("http://[bad") == "http://[bad"
