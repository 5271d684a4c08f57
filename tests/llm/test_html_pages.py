"""Main text: no markup stops the query, depth costs nothing, and class names do not take the article away."""

import time

import pytest

from loomvault.llm import html_text

BODY = "<p>Body of the article with quite some words in it.</p>"
PLAIN = "Body of the article with quite some words in it."


@pytest.mark.parametrize("page,text", [
    ("<![foo[x]]><p>hello</p>", "hello"), ("<!foo bar><p>x</p>", "x"), ("<![if IE]><p>a</p><![endif]><p>b</p>", "a\nb"), ("<p>abc <![foo", "abc <![foo"),
    (f"<div class='site has-sidebar'><article><h1>T</h1>{BODY}</article></div>", "T\n" + PLAIN),
    (f"<div class='no-sidebar'>{BODY}</div>", PLAIN), (f"<div class='widget'><article>{BODY}</article></div>", PLAIN),
    (f"<article>{BODY}<div class='ad'>Buy this now, it is cheap and good.</div></article>", PLAIN),
    (f"<article>{BODY}</article><section class='comments'><article>I liked it very much, dear author of it.</article></section>", PLAIN),
    (f"<section class='comments'><article>I liked it very much.</article></section><div>{BODY}{BODY}</div>", PLAIN + "\n" + PLAIN),
    (f"<main><article>{BODY}{BODY}</article><article><p>short</p></article></main>", PLAIN + "\n" + PLAIN + "\nshort"),
    (f"<body><h1>The Title</h1><div>{BODY}{BODY}</div></body>", "The Title\n" + PLAIN + "\n" + PLAIN),
    (f"<body><header><h1>Site</h1></header><div>{BODY}{BODY}</div></body>", PLAIN + "\n" + PLAIN),
    ("", ""), (None, ""), ("<p> \n </p>", ""), ("no markup at all", "no markup at all"),
])
def test_pages(page, text):
    assert html_text.main_text(page) == text


def test_deep_pages_cost_in_proportion():
    began = time.perf_counter()
    text = html_text.main_text("<div>x" * 40_000)
    assert text.count("x") == 36_000  # the region is the deepest element with nine tenths of the text
    assert time.perf_counter() - began < 15
    assert html_text.main_text("<ul><li>a" * 20_000).count("a") == 18_000


def test_one_broken_page_leaves_the_others(spark):
    rows = [(1, "<p>ok</p>"), (2, "<![foo[x]]><p>hello</p>"), (3, None), (3, None)]
    got = html_text.extract_main_text(spark.createDataFrame(rows, "page_id long, html string")).collect()
    assert sorted((r.page_id, r.main_text) for r in got) == [(1, "ok"), (2, "hello"), (3, ""), (3, "")]
    assert html_text.extract_main_text(spark.createDataFrame([], "page_id long, html string")).collect() == []
