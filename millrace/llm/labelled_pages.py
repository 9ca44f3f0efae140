"""A small labelled table for ``page_text``: invented pages whose main text is marked by ``data-main``.

``{n}`` stands for n words; only their number matters. About 150 blocks in all.
"""

from __future__ import annotations

import re

_PAGES = (
    # Sections by element.
    """<header><p>{3}</p><p>{9}</p></header><nav><ul><li><a href=a>{1}</a></li><li><a href=b>{2}</a></li><li><a href=c>{1}</a></li></ul></nav>
    <div class="ad">{8}</div><article data-main><h1>{7}</h1><p>{45}</p><p>{60} <a href=x>{3}</a> {20}</p><h2>{3}</h2><p>{2}</p><p>{38}</p>
    <ul><li>{4}</li><li>{9}</li></ul><blockquote>{25}</blockquote><p>{1}</p></article><aside><h3>{2}</h3><p>{30}</p><p><a href=y>{4}</a></p></aside>
    <section id="comments"><h3>{2}</h3><p>{2}</p><p>{35}</p><p>{18}</p></section><footer>&copy; {9}</footer>""",
    # The same by names only.
    """<div id="masthead"><p>{2}</p><p>{6}</p></div><div class="main-menu"><a href=a>{1}</a> <a href=b>{1}</a> <a href=c>{2}</a></div>
    <div id="content" class="entry" data-main><h1>{6}</h1><p>{52}</p><p>{3}</p><p>{71}</p><table><tr><td>{2}</td><td>{1}</td></tr></table><p>{12}</p></div>
    <div class="sidebar"><h4>{2}</h4><ul><li><a href=d>{4}</a></li><li><a href=e>{5}</a></li></ul><p>{28}</p></div>
    <div class="comment-list"><div class="comment"><p>{24}</p></div><div class="comment"><p>{3}</p></div></div>
    <div id="footer"><p>{11}</p><a href=f>{1}</a> <a href=g>{2}</a></div>""",
    # One form around the whole page.
    """<form action="/"><div class="topnav"><a href=a>{1}</a><a href=b>{1}</a></div><div class="article-body" data-main><p>{40}</p><p>{2}</p>
    <p>{66}</p></div><form class="search"><label>{2}</label></form><div class="newsletter"><p>{14}</p><label>{2}</label></div>
    <div class="legal">{19}</div></form>""",
    # No section marked at all: words and links decide.
    """<div><a href=a>{1}</a> | <a href=b>{1}</a> | <a href=c>{2}</a> | <a href=d>{1}</a></div><div><p data-main>{48}</p><p data-main>{35} <a href=x>{2}</a></p>
    <p data-main>{4}</p><p data-main>{57}</p><p data-main>{22}</p><p data-main>{44}</p></div><div><a href=e>{3}</a></div><div>&copy; {5}</div>""",
    """<table><tr><td><a href=a>{2}</a></td></tr><tr><td><a href=b>{1}</a></td></tr></table><p>{5}</p><h1 data-main>{6}</h1><p data-main>{61}</p>
    <p data-main>{27}</p><p data-main>{33}</p><p><a href=c>{2}</a> <a href=d>{2}</a></p><p>{3} <a href=e>{3}</a></p><p>&copy; {4}</p>""",
    """<div>{2}</div><div><a href=a>{1}</a></div><div><a href=b>{1}</a></div><div data-main>{90}</div><div data-main>{16}</div><div data-main>{75}</div>
    <div><a href=c>{6}</a></div><div><a href=d>{7}</a></div><div><a href=e>{5}</a></div><div>{3}</div>""",
    # Notices, sharing, related pages.
    """<div class="cookie-notice"><p>{32}</p><a href=a>{1}</a></div><header class="site-header"><p>{2}</p></header><main><article data-main><header><h1>{8}</h1></header>
    <p>{54}</p><p>{12}</p></article><div class="share"><a href=b>{1}</a> <a href=c>{1}</a></div><div class="related"><h3>{2}</h3><p><a href=d>{9}</a></p><p>{26}</p></div>
    </main><div class="promo"><p>{10}</p></div><footer><p>{8}</p><p>{40}</p></footer>""",
    # Parts that interrupt the article.
    """<nav><p>{1}</p></nav><article><div data-main><h1>{5}</h1><p>{39}</p></div><div class="advert">{13}</div><div data-main><p>{47}</p><p>{1}</p></div>
    <aside>{31}</aside><p data-main>{64}</p><form><p>{7}</p><label>{3}</label></form><section class="comments"><article><p>{42}</p><p>{3}</p></article>
    <article class="comment"><p>{2}</p></article></section><aside><article><h3>{3}</h3><p>{33}</p></article></aside></article><footer>{12}</footer>""",
    # One long text, one very short one, and none.
    """<div class="banner">{6}</div><div role="main" data-main><h1>{3}</h1><p>{400}</p><p>{350}</p><p>{5}</p></div><div class="breadcrumbs"><a href=a>{1}</a> {1}</div>
    <div role="contentinfo">{25}</div>""",
    """<nav><a href=a>{1}</a></nav><div class="ads">{9}</div><article data-main><h1>{1}</h1><p>{2}</p></article><footer>&copy; {7}</footer>""",
    """<nav><ul><li><a href=a>{1}</a></li><li><a href=b>{1}</a></li></ul></nav><div><a href=c>{7}</a></div><div><a href=d>{9}</a></div><div><a href=e>{8}</a></div>
    <footer>&copy; {3}</footer>""",
    # Article with links in most of its blocks, and lists.
    """<header>{4}</header><article data-main><h1>{9}</h1><p><a href=a>{5}</a> {4}</p><ul><li><a href=b>{6}</a></li><li><a href=c>{4}</a></li><li>{11}</li></ul>
    <p><a href=d>{3}</a></p><p>{17}</p></article><div class="widget"><p>{16}</p></div><div class="pagination"><a href=e>{1}</a> <a href=f>{1}</a></div>""",
    # Again no section marked, with long lines around the text.
    """<p><a href=a>{2}</a> <a href=b>{3}</a> <a href=c>{2}</a> {1}</p><p data-main>{30}</p><p data-main>{2}</p><p data-main>{41}</p><p data-main>{19}</p>
    <p data-main>{36}</p><p><a href=d>{8}</a></p><p><a href=e>{11}</a></p><p>{1} <a href=f>{4}</a></p>""",
)


def pages() -> list[str]:
    return [re.sub(r"\{(\d+)\}", lambda m: " ".join(["word"] * int(m[1])), page) for page in _PAGES]
