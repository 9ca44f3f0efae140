"""Main text against a plain reading of the test pages, held-out pages of other shapes, and odd markup."""

import html
import re
import time

import pytest

from millrace.llm import page_text
from millrace.llm.queries import QUERIES


@pytest.fixture(scope="module")
def tree(spark):
    return page_text.train(page_text.labelled(spark))


def slow_article(page):
    """The test pages hold their text in one article of headings, paragraphs, breaks and bold type."""
    inside = page.partition("<article>")[2].partition("</article>")[0]
    spaced = re.sub(r"</?(?:h1|p|br)>", " ", inside).replace("<b>", "").replace("</b>", "")
    return " ".join(html.unescape(spaced).split())


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_page_query(spark, sf):
    table = spark.read.parquet(f"/root/testdata/{sf}/pages.parquet").collect()
    got = {r["page_id"]: r for r in QUERIES["op12_page_text"](spark, f"/root/testdata/{sf}").collect()}
    assert len(got) == len(table)
    for r in table:
        assert got[r["page_id"]]["text"] == slow_article(r["html"]) and got[r["page_id"]]["url"] == r["url"]
        assert got[r["page_id"]]["n_chars"] == len(got[r["page_id"]]["text"])


def words(n, name="text"):
    return " ".join(f"{name}{i}" for i in range(n))


# Shapes that the labelled table does not have; KEEP is main text, drop is not.
HELD_OUT = [
    f"<header class=top><h1>drop site</h1></header><main><h1>KEEP title</h1><p>KEEP {words(30)}<p>KEEP<p>KEEP {words(80)}</main><nav><a href=a>drop</a></nav>",
    f"<div id=wrap><ul class='nav'><li><a href=a>drop one</a><li><a href=b>drop</a></ul><div class='post-content'><h2>KEEP head</h2><p>KEEP {words(25)}</p>"
    f"<div class='ad-slot'>drop {words(20)}</div><p>KEEP {words(3)}</p></div><div class='commentList'><p>drop {words(60)}</p></div></div>",
    f"<form id=f><div role=navigation>drop a</div><article><p>KEEP {words(40)}</p></article><aside><article><p>drop {words(50)}</p></article></aside>"
    f"<form><label>drop name</label><input><select><option>drop</select><button>drop</button></form></form><footer><p>drop {words(30)}</p></footer>",
    f"<div><a href=a>drop a</a> <a href=b>drop b</a></div><p>KEEP {words(55)}</p><p>KEEP {words(60)}</p><p>KEEP {words(45)} <a href=c>KEEP</a></p><div><a href=d>drop c</a></div>",
    f"<div class=cookie-consent>drop {words(35)}</div><section class='article'><p>KEEP {words(14)}</p><table><tr><td>KEEP 1<td>KEEP 2</table></section><div id=comments><article><p>drop {words(45)}</p></article></div>",
    f"<body class=with-sidebar><article class='has-sidebar'><p>KEEP {words(20)}</p></article><div class=sidebar><p>drop {words(70)}</p></div><script>KEEP()</script><!-- KEEP --><style>KEEP{{}}</style>",
]


def test_held_out_pages(tree):
    for page in HELD_OUT:
        text = page_text.main_text(page, tree)
        visible = re.sub(r"<script.*?</script>|<!--.*?-->|<style.*?</style>", "", page)
        assert text.count("KEEP") == visible.count("KEEP") and "drop" not in text, page


def test_block_text(tree):
    cases = {
        "<article><p>a&amp;b &lt;x&gt; &#233;&nbsp;c<b>d</b>e<br>f\n\t g</p>h</article>": "a&b <x> é cde f g h",
        "<article>1 < 2 and a<b>c</b> <3 &am": "1 < 2 and ac <3 &am",
        "<article>one<p>two<td>three</article>four": "one two three",
        "<article>x<script>if (a</b) </p></script>y<textarea>no</textarea><noscript><p>no</p></noscript>z</article>": "xy z",
        "<article>x <!-- > <p> -->y<!doctype z>w<?php a ?>v</article>": "x ywv",
        "<article title='a>b' data-x=\"</article>\">kept</article>": "kept",
        "<article>kept <a title=it's>too</a> and 'so'</article>": "kept too and 'so'",
        "<article>kept<a href='unclosed>gone": "keptgone",
        "<article>kept<script>never ends": "kept",
        "<ARTICLE>Kept</ARTICLE><FOOTER>no</FOOTER>": "Kept",
        "": "",
    }
    for page, want in cases.items():
        assert page_text.main_text(page, tree) == want, page
    assert page_text.main_text(None, tree) == ""


def test_long_and_broken_markup_is_linear(tree):
    for piece in ("<", "<a ", "<a x=\"", "<p>", "<!--", "<div class=a>", "</p>", "<a x='", "<script>", "</div>", "&am", "<li><a>x", "<table><td>y"):
        began = time.monotonic()
        page_text.main_text(piece * 100_000, tree)
        assert time.monotonic() - began < 5, piece
    assert page_text.main_text(f"<article>{words(200_000)}</article>", tree) == words(200_000)


def test_tables_of_odd_rows(spark, tree):
    rows = [(1, "u", None, "x", None), (1, "u", "", "x", None), (None, None, "<article>a b</article>", "x", 2), (1, "u", "<article>a b</article>", "y", 3)]
    table = spark.createDataFrame(rows, "page_id long, url string, html string, text string, n_chars long")
    got = [tuple(r) for r in page_text.extract(table, tree).collect()]
    assert sorted(got, key=repr) == sorted([(1, "u", "", 0), (1, "u", "", 0), (None, None, "a b", 3), (1, "u", "a b", 3)], key=repr)
    assert page_text.extract(table.limit(0), tree).collect() == []
    nothing = page_text.train(spark.createDataFrame([], "html string"))
    assert page_text.extract(table, nothing).where("n_chars > 0").collect() == []


def test_neighbours_decide_without_regions(spark, tree):
    """The tree uses words and links of a block and of those beside it, where a page marks no region."""
    assert {page_text.FEATURES.index("words"), page_text.FEATURES.index("words_after")} <= set(tree.feature)
    page = f"<p>{words(60, 'a')}</p><p>short one</p><p>{words(70, 'b')}</p>"
    assert page_text.main_text(page, tree) == f"{words(60, 'a')} short one {words(70, 'b')}"
    assert page_text.main_text("<p>short one</p><p>also short</p>", tree) == ""
