import re
import time
from html import unescape

import duckdb
import pytest
from llm_cases import SF

from snaptrack.llm import mainpage
from snaptrack.llm.queries import QUERIES

SENTENCE = "A first paragraph, with commas, and words enough to count as the text of an article."
CASES = {
    "": "",
    "just text, no tags": "just text, no tags",
    "<p>a<p>b<!-- x": "a\nb",
    "<b>bold": "bold",
    "a < b and c > d": "a < b and c > d",
    "<div><script>if(a<b){'</p>'}</script>x &lt;y&gt; &amp;amp;&nbsp;z</div>": "x <y> &amp; z",
    "<table><tr><td>c1<td>c2<tr><td>c3</table>": "c1\nc2\nc3",
    "<article>t<br>u\n\t v<p>w</article>": "t u v\nw",
    "<ul><li><p>a<li><p>b<ul><li>c</ul>d</ul>e": "a\nb\nc\nd\ne",
    "<article><table><tr><td><p>a<td>b<tr><td>c<tbody><tr><td>d</table>e</article>f": "a\nb\nc\nd\ne",
    "<article><header><h1>T</h1></header><p>x</p><form><p>no</p></form><section class='comments'><p>c</p></section>"
    "<aside>s</aside><footer>f</footer></article>": "T\nx",
    f"<body><header>Site</header><div class='post with-sidebar'><h2>T</h2><p>{SENTENCE}<ul><li>one<li>two</ul>"
    f"<div class='ad-box'>Buy!</div></div><div class=sidebar><p>{SENTENCE}</div><div id=comments><p>{SENTENCE * 3}</div>":
        f"T\n{SENTENCE}\none\ntwo",
    f"<main><div><p>{SENTENCE}</div><div><p>{SENTENCE} More, more, more, and more of it.</div><div><a href=x>{SENTENCE}</a></div></main>":
        f"{SENTENCE}\n{SENTENCE} More, more, more, and more of it.",
    f"<div role=navigation><p>{SENTENCE}</div><div hidden>{SENTENCE}</div><div style='display: none'>{SENTENCE}</div><p>x": "x",
    "<div>" * 3000 + "deep": "deep",
    "<p>" * 2000 + "x": "x",
}


#: Ids and classes made from titles cut nothing of an article; what they name is cut if it is short or mostly links.
TITLED = {
    f"<article><h2 id='related-work'>Related work</h2><p>{SENTENCE}</p><section id=discussion><h2>Discussion</h2>"
    f"<p>{SENTENCE}</p></section></article>": f"Related work\n{SENTENCE}\nDiscussion\n{SENTENCE}",
    f"<article><div class='article-header'><h1>Title</h1></div><p>{SENTENCE}</p></article>": f"Title\n{SENTENCE}",
    f"<body><section id='hidden-costs'><h2 id='ad-hoc'>T</h2><p>{SENTENCE}</p></section>": f"T\n{SENTENCE}",
    f"<main><p>{SENTENCE}</p><div id='ad-hoc-networks'><p>{SENTENCE}</p></div></main>": f"{SENTENCE}\n{SENTENCE}",
    f"<article><p>{SENTENCE}</p><div class='ad'><p>{SENTENCE}</p></div><div class=social>Share this</div>"
    f"<div class=related><a href=x>{SENTENCE}</a> and <a href=y>{SENTENCE}</a></div></article>": SENTENCE,
    f"<article><p>{SENTENCE}</p><div class='sidebar'><p>{SENTENCE}</p></div><div id='related'>Short.</div></article>": SENTENCE,
    f"<div class=post><p>{SENTENCE}</p></div><div class=comments><p>{SENTENCE * 3}</p></div>": SENTENCE,
}


LONG = SENTENCE * 3
ONE = f"<div class=author>Ann, 3 May</div><p>{LONG}</p>"
#: Readers' comments and notices inside the article or main element.
PARTS = {
    "section": f"<article><p>{SENTENCE}</p><section class='comments' id='comments'><h2>Comments</h2><p>{LONG}</p></section></article>",
    "id": f"<main><p>{SENTENCE}</p><div id='comments'><p>{LONG}</p></div></main>",
    "articles": f"<article><p>{SENTENCE}</p><article class='comment'>{ONE}</article><article class='comment even'>{ONE}</article></article>",
    "cookie": f"<article><div class='cookie-notice'><p>{LONG}</p></div><p>{SENTENCE}</p></article>",
    "notice": f"<main><div class='notice'><p>{LONG}</p></div><p>{SENTENCE}</p></main>",
    "siblings": f"<main><article><p>{SENTENCE}</p></article><article class='comment-body'>{ONE}</article><article class=reply>{ONE}</article></main>",
    "schema": f"<article><p>{SENTENCE}</p><div itemprop='comment' itemscope>{ONE}</div><div itemtype='https://schema.org/Comment'>{ONE}</div></article>",
    "thread": f"<article><p>{SENTENCE}</p><div id='disqus_thread'>{ONE}</div><ol id=comment-list><li>{ONE}</ol></article>",
    "consent": f"<main><p>{SENTENCE}</p><div id='cookie-consent'><p>{LONG}</p></div><div id='newsletter-signup'><p>{LONG}</p></div></main>",
    "open": f"<article class='post comments-open'><div class='entry comments-closed'><p>{SENTENCE}</p></div></article>",
    "titles": f"<article><section id='cookies'><p>{SENTENCE}</p></section></article>",
    "reply": f"<main><div id='reply-to-critics'><p>{SENTENCE}</p></div></main>",
}


@pytest.mark.parametrize("part", PARTS)
def test_parts_inside_the_article_go_and_titles_stay(part):
    assert mainpage.main_text(PARTS[part]) == SENTENCE


BAD = {
    "signs": "<" * 200_000, "spans": "<pre>" + "<span>x, </span>" * 300_000 + "</pre>", "open spans": "<span>" * 100_000 + "<div>x</div>" * 50_000,
    "ends": "<i>" * 100_000 + "</b>" * 100_000 + "x", "deep": "<div>x" * 60_000, "classes": "<div class=post>x" * 30_000,
    "deep inline": "<b>x" * 100_000, "blank parts": "<p>" + "<b> </b>" * 100_000 + "x", "quotes": "<a '\"" * 50_000, "cells": "<td><p>x" * 60_000, "heads": "<head>" * 50_000 + "<p>x" * 50_000,
}


@pytest.mark.parametrize("kind", BAD)
def test_time_grows_with_the_length(kind):
    began = time.process_time()
    assert mainpage.main_text(BAD[kind]) or kind in ("quotes", "heads")
    assert time.process_time() - began < 30


@pytest.mark.parametrize("html", TITLED, ids=range(len(TITLED)))
def test_words_of_titles_cut_nothing(html):
    assert mainpage.main_text(html) == TITLED[html]


def test_lists_of_links_between_paragraphs_are_the_articles():
    sources = "<ul><li><a href=x>First source, a book</a> 1999<li><a href=y>Second source, a paper</a></ul>"
    names = "<dl><dt><a href=x>Name of one thing</a><dd>is one</dl><table><tr><td><a href=z>A linked name</a></table>"
    menu = "<div><a href=x>Home</a> <a href=y>News</a></div>"
    page = f"<article>{menu}<p>{SENTENCE}</p>{sources}{names}<p>{SENTENCE}</p>{menu}</article>"
    kept = f"{SENTENCE}\nFirst source, a book 1999\nSecond source, a paper\nName of one thing\nis one\nA linked name\n{SENTENCE}"
    assert mainpage.main_text(page) == kept
    assert mainpage.main_text(f"<main><div>{page[9:-10]}</div></main>") == kept


@pytest.mark.parametrize("html", CASES, ids=range(len(CASES)))
def test_cases(html):
    assert mainpage.main_text(html) == CASES[html]


def test_op8_keeps_the_articles(spark):
    rows = {r.page_id: r for r in QUERIES["op8_main_text"](spark, SF).collect()}
    for i, url, html in duckdb.sql(f"select * from '{SF}/pages.parquet'").fetchall():
        article = html[html.index("<article>") + 9 : html.index("</article>")].replace("<br>", " ")
        blocks = [" ".join(unescape(re.sub("<[^>]+>", "", x)).split()) for x in re.split("</?(?:p|h1)>", article)]
        want = "\n".join(x for x in blocks if x)
        assert (rows[i].url, rows[i].text, rows[i].n_chars) == (url, want, len(want))


def test_edges(spark):
    rows = [(1, "u", None, "k"), (1, "u", None, "k"), (None, None, "<p>x", "k"), (3, "u", "<p>" + "word, " * 100_000, "k")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    assert mainpage.extract(df).columns == [*df.columns, "text_"]
    found = mainpage.op8(df).collect()
    assert sorted(((r.page_id, r.n_chars) for r in found), key=str) == [(1, 0), (1, 0), (3, 599_999), (None, 1)]
    assert mainpage.op8(df.limit(0)).collect() == []
