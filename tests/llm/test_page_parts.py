"""Articles in layouts with telling names, and in markup with omitted or missing end tags."""

from __future__ import annotations

import pytest

from stayledger.llm import html_blocks

ARTICLE = "<article><h1>Title</h1><p>One two three.</p></article>"
TEXT = "Title\nOne two three."


@pytest.fixture(scope="module")
def tree():
    return html_blocks.train()


@pytest.mark.parametrize("page", [
    f"<div class='layout has-sidebar'>{ARTICLE}</div>",
    f"<div id='page-nav-open'>{ARTICLE}</div>",
    f"<div class='container right-sidebar'>{ARTICLE}</div>",
    f"<div class='sidebar-layout'>{ARTICLE}</div>",
    f"<div class='with-comments'>{ARTICLE}</div>",
    "<article><header class='entry-header'><h1>Title</h1></header><p>One two three.</p></article>",
    f"<html><head><title>T</title>{ARTICLE}",
    f"<html><head><meta charset=x><title>T</title></head>{ARTICLE}",
    f"<noscript><img src=x>{ARTICLE}",
    f"<noscript><img src=x>{ARTICLE}<noscript>no</noscript>",
    f"<body><svg><path d='x'>{ARTICLE}",
    f"<script src=x>{ARTICLE}",
    f"<form id=aspnetForm>{ARTICLE}</form>",
    f"<form id=main-form><header><p>Our site</p></header><div>{ARTICLE}</div><footer>Imprint</footer></form>",
    "<form><div class=content><h1>Title</h1><p>One two three.</p></div><label>Name</label><button>Go</button></form>",
    "<main><form><h1>Title</h1><p>One two three.</p></form></main>",
    f"<div role=dialog>{ARTICLE}</div>",
    f"<dialog open>{ARTICLE}</dialog>",
    f"<div class=related-layout>{ARTICLE}</div>",
    f"<form><dialog>{ARTICLE}</dialog></form>",
    "<article><div class=social-science><h1>Title</h1></div><p class=share-price-table>One two three.</p></article>",
])
def test_article_is_whole(tree, page):
    assert html_blocks.main_text(page, tree) == TEXT


@pytest.mark.parametrize("page", [
    f"<div class='sidebar'>side words here</div>{ARTICLE}",
    f"<div id='sidebar-left'><p>{'side words ' * 9}</p></div>{ARTICLE}",
    f"<div class='site-nav'><p>{'nav words ' * 9}</p></div>{ARTICLE}",
    f"{ARTICLE}<div id='comments'><article class='comment'>A reader says</article></div>",
    f"{ARTICLE}<div class='related-posts'><article>Another one</article></div>",
    f"<nav><article>Menu card</article></nav>{ARTICLE}",
    f"{ARTICLE}<form><p>{'Tell us what you think of it. ' * 9}</p></form>",
    f"<article><h1>Title</h1><p>One two three.</p><form><p>{'Leave a reply here. ' * 9}</p></form></article>",
    f"{ARTICLE}<dialog><article>{'Special offer now. ' * 9}</article></dialog>",
    f"{ARTICLE}<div role=dialog><p>{'We use cookies here. ' * 9}</p></div>",
    f"<div class=content><h1>Title</h1><p>One two three.</p></div><dialog><p>{'We use cookies here. ' * 9}</p></dialog>",
    f"{ARTICLE}<form class=newsletter><p>Subscribe now</p></form>",
    "<article><h1>Title</h1><p>One two three.</p><div class=social-links>Follow us</div><p class=share>Tell all</p>"
    "<p class=post-share>Pass on</p><p class=social-share-buttons>Like it</p></article>",
    f"{ARTICLE}<script>document.write('<p>code {'more ' * 20}</p>')",
])
def test_furniture_stays_out(tree, page):
    assert html_blocks.main_text(page, tree) == TEXT


def test_deep_forms_take_linear_time(tree):
    page = "<form><p>x" * 60_000
    assert html_blocks.main_text(page, tree).count("x") == 60_000


def test_many_unclosed_elements_take_linear_time(tree):
    page = "<noscript><p>x" * 60_000 + "<noscript></noscript>"
    assert html_blocks.main_text(f"<article>{page}</article>", tree).count("x") == 60_000
