"""What names of attributes and words of class and id leave out of a page."""

from __future__ import annotations

import pytest

from depotlens.llm.html_consensus import Page, _attributes


def text(body: str) -> str:
    page = Page(f"<html><body>{body}</body></html>")
    return page.extract(page.best()[0])


def test_only_names_of_attributes_count():
    assert _attributes(' href="/articles/hidden-gems" title="Hidden costs" data-id=x') == {"href": "/articles/hidden-gems", "title": "Hidden costs", "data-id": "x"}
    assert _attributes(" HIDDEN class='a b' id = c") == {"hidden": "", "class": "a b", "id": "c"}
    assert text("<section title='Hidden costs'><p>one <a href='/hidden'>two</a> and more</p></section>") == "one two and more"
    assert text("<p>one</p><p hidden>two</p>") == "one"


@pytest.mark.parametrize("wrapper", ["layout has-sidebar", "no-sidebar", "page_with-search", "sidebar layout", "site-header"])
@pytest.mark.parametrize("tag", ["article", "main"])
def test_wrappers_of_the_article_stay(wrapper, tag):
    body = f"<div class='{wrapper}'><{tag} class='post category-social tag-search'><p>The whole text.</p><p class=share>no</p></{tag}></div>"
    assert text(body + "<div id=comments><article><p>short</p></article></div>") == "The whole text."


def test_other_articles_stay_out_where_they_did():
    post = "<article class='tag-search'><p>A post of many words.</p><div class=comments><article class=comment><p>nice</p></article></div></article>"
    related = "<div class=related><article><p>teaser</p></article></div>"
    assert text(f"{related}<div class='has-ads'>{post}</div>{related}") == "A post of many words."
    assert text("<div class='no-sidebar'><p>kept</p><div class='sidebar no-print'>gone</div></div>") == "kept"


@pytest.mark.parametrize("name", ["search-engine", "alert-system", "social-history", "menu-planning", "cookie-recipes", "share-prices", "review"])
def test_names_of_another_sense_stay(name):
    assert text(f"<article><p>One.</p><p class='{name}'>Two.</p><div id='{name}'>Three.</div></article>") == "One.\nTwo.\nThree."


@pytest.mark.parametrize("name", ["reviews", "comments-list", "share-buttons", "search-form", "ad-slot-3", "related-posts", "site-alert", "cookie-notice"])
def test_boilerplate_names_go(name):
    assert text(f"<article><p>One and more words.</p><section id='{name}'><p>gone</p></section><div class='x {name}'>gone</div></article>") == "One and more words."


def test_ties_go_to_the_first_and_repeats_are_equal():
    body = "<div class=a><p>same size</p></div><div class=b><p>size same</p></div>"
    page = Page(body)
    assert page.best()[0] == "div.a" and page.extract("div.b") == "size same" == Page(body).extract("div.b")
    assert page.extract("div.absent") == "same size" and Page("").extract("div") == "" and Page("bare text").extract(None) == "bare text"
    odd = Page("<div class='x>y'><div class=z><p>within</p></div></div><div class=x><p>other words</p></div>")
    assert odd.extract("div.x>y>div.z") == "within"


@pytest.mark.parametrize(
    "source",
    [
        "<div>" * 200_000 + "deep text" + "</div>" * 200_000,
        "<div class=ad>" * 100_000 + "gone" + "</div>" * 100_000 + "<p>deep text",
        "<b>" * 100_000 + "<p>deep text" + "</i>" * 100_000,
        "<div class='a b'>" * 60_000 + "<p>deep text</p>",
    ],
)
def test_deep_and_unclosed_pages_take_linear_work(source):
    import time
    import tracemalloc

    tracemalloc.start()
    start = time.process_time()
    page = Page(source)
    path, _ = page.best()
    assert page.extract(path) == "deep text"
    assert time.process_time() - start < 60 and tracemalloc.get_traced_memory()[1] < 400e6
    tracemalloc.stop()
