"""Pages whose names mislead, implied end tags, text beside the container, and pages of odd depth."""

from __future__ import annotations

import time

import pytest

from tidelog.llm.html_tree import extract

LINES = [f"Paragraph {i} of the article, with commas, and enough words to read like running text." for i in range(6)]
ARTICLE = "".join(f"<p>{x}</p>" for x in LINES)
TEXT = "\n".join(LINES)
MENU = '<div class="menu"><a href=/>Home</a> <a href=/a>About</a></div>'


@pytest.mark.parametrize("wrapper", [
    'class="content has-sidebar"', 'id="main" class="with-sidebar"', 'class="elementor-widget-wrap"',
    'class="post-content social-share"', 'class="text-widget"', 'class="notice"',
])
def test_a_wrapper_of_the_article_stays(wrapper):
    assert extract(f"<body>{MENU}<div {wrapper}>{ARTICLE}<div class=share>Share this page with all of your friends</div></div></body>") == TEXT
    assert extract(f"<body><div class=widget><div {wrapper}>{ARTICLE}</div></div>{MENU}</body>") == TEXT


@pytest.mark.parametrize("name", ["notice", "sidebar", "related", "promo", "share", "widget", "cookie-banner"])
def test_named_parts_beside_the_article_go(name):
    side = f"<div class={name}><p>Some other words that stand here, beside the article, on each page.</p></div>"
    assert extract(f"<body>{side}<div>{ARTICLE}</div>{side}</body>") == TEXT
    assert extract(f"<body><div class=content>{ARTICLE}{side}</div></body>") == TEXT


def test_comments_go_even_if_longer_than_the_article():
    said = "".join(f"<p>A reader says number {i}, at some length, that this is so and not otherwise.</p>" for i in range(90))
    assert extract(f"<body><div>{ARTICLE}</div><div class=comments>{said}</div></body>") == TEXT
    assert extract(f"<body><div class=comments>{said}</div></body>") == ""


def test_end_tags_that_html_implies():
    page = f"<body><div>{ARTICLE}<ul><li class=share>Share<li>Real item</ul><p>tail of the page</div></body>"
    assert extract(page) == TEXT + "\nReal item\ntail of the page"
    assert extract(f"<body><div>{ARTICLE}<p class=ad>Ad<p>tail of the page</div>") == TEXT + "\ntail of the page"


def test_text_beside_the_container_stays():
    page = f"<body><div id=a>Loose words.<div>{ARTICLE}</div><section><p>Short.</p></section><ul><li>One<li>Two</ul>{MENU}</div></body>"
    assert extract(page) == "Loose words.\n" + TEXT + "\nShort.\nOne\nTwo"


def test_hidden_parts_go():
    assert extract(f"<body><div hidden>{ARTICLE}</div><div style='display: none'>{ARTICLE}</div><p>{LINES[0]}</p></body>") == LINES[0]


@pytest.mark.parametrize("opening, closing", [("<div>", "</section>"), ("<i>", "</b>"), ("<b><div><i>", "</b>"), ("<nav><i>", "</b>")])
def test_stray_end_tags_take_linear_time(opening, closing):
    began = time.perf_counter()
    extract(opening * 20000 + "text" + closing * 20000)
    assert time.perf_counter() - began < 10


@pytest.mark.parametrize("page", ["<div class=ad>" * 3000 + ARTICLE, "<div class=widget><p>x</p>" * 2000 + ARTICLE])
def test_deep_wrappers_end(page):
    began = time.perf_counter()
    assert LINES[0] in extract(page)
    assert time.perf_counter() - began < 10


@pytest.mark.parametrize("around", ["article", "div"])
def test_an_advert_longer_than_a_short_article_goes(around):
    page = f"<body><nav><a href=/>Home</a></nav><div class=ad>{LINES[0]}</div><{around}><h1>A title.</h1><p><b>Short text.<br></{around}>"
    assert extract(page) == "A title.\nShort text."
