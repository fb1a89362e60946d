"""Articles whose text lies in several sections."""

import pytest

from pricebeam.llm.html_text import best_container, extract_text, main_text


def words(n, letter):
    return " ".join([letter * 9] * (n // 10))


H, LEAD, BODY, MORE = "Title of the page", words(200, "b"), words(2000, "c"), words(700, "d")
MENU = "<ul>" + "".join(f"<li><a href={i}>another page of this site {i}</a>" for i in range(9)) + "</ul>"
WHOLE = "\n\n".join([H, LEAD, BODY])


@pytest.mark.parametrize("page,expected", [
    (f"<body><article><h1>{H}</h1><div class=lead>{LEAD}</div><div class=body>{BODY}</div></article></body>", WHOLE),
    (f"<body><div class=post><h1>{H}</h1><div class=lead>{words(400, 'b')}</div><div class=body>{words(800, 'c')}</div></div></body>",
     "\n\n".join([H, words(400, "b"), words(800, "c")])),
    (f"<body><main><section class=a>{LEAD}</section><section class=b><p>{BODY}</section><section class=c>{MORE}</section></main>",
     "\n\n".join([LEAD, BODY, MORE])),
    (f"<body><div class=page><div class=box><h1>{H}</h1><div class=in><p>{LEAD}</p><div class=deep>{BODY}</div></div></div></div>", WHOLE),
    (f"<body><h1>{H}</h1><p>{LEAD}</p><div class=text>{BODY}</div></body>", WHOLE),
    # What is dropped, and sections of links, stay outside.
    (f"<body><div class=page><div class=links>{MENU}</div><div class=post><h1>{H}</h1><div class=sidebar>{MORE}</div>"
     f"<div class=lead>{LEAD}</div><div class=body>{BODY}</div></div></div></body>", WHOLE),
])
def test_whole_articles(page, expected):
    assert main_text(page) == expected


def test_pages_of_a_host_may_lack_parts(spark):
    bare = f"<body><div class=post><div class=body>{BODY}</div></div></body>"
    full = f"<body><div class=post><h1>{H}</h1><div class=lead>{LEAD}</div><div class=body>{BODY}</div></div></body>"
    assert best_container(bare)[0] == "body/div.post/div.body" and best_container(full)[0] == "body/div.post"
    pages = spark.createDataFrame([(i, "http://h.example/", full if i == 3 else bare) for i in range(4)]
                                  + [(10 + i, "http://i.example/", bare if i == 3 else full) for i in range(4)],
                                  "page_id long, url string, html string")
    got = {x.page_id: x.text for x in extract_text(pages).collect()}
    assert got == {i: WHOLE if i in (3, 10, 11, 12) else BODY for i in (0, 1, 2, 3, 10, 11, 12, 13)}
