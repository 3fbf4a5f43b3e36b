"""Main text against a plain version of the tag-path ratios, and pages that lost text or time."""

from __future__ import annotations

import random
import time

import pytest

from trialweave.llm import html_text

from . import brute

LONG = "Long text, with many words, and marks. " * 6
PARTS = ("p", "p", "p", "h2", "li", "div", "figcaption", "blockquote")


def given(last):
    if last in html_text.HEADINGS:
        return html_text.WITHIN_HEADING
    return html_text.WITHIN_TEXT if last in html_text.TEXTS else html_text.WITHIN_BARE


def page_of(seed):
    """A well-formed page of random blocks, some linked, with or without an article."""
    chance = random.Random(seed)

    def block(name):
        words = " ".join(chance.choice(["word", "a", "longer,", "end.", "&amp;", "<b>bold</b>"]) for _ in range(chance.choice([1, 3, 12, 60])))
        words = f"<a href=x>{words}</a>" if chance.random() < 0.25 else words
        return f"<ul><li>{words}</li><li>More of it</li></ul>" if name == "li" else f"<{name}>{words}</{name}>"

    def run(n):
        return "".join(block(chance.choice(PARTS)) for _ in range(n))

    body = run(chance.randrange(1, 9))
    if chance.random() < 0.6:
        body = f"<article><p>{LONG}</p>{body}</article>"
    return f"<html><body><nav><p>Home</p></nav><div>{run(chance.randrange(4))}{body}</div><footer>End</footer></body></html>"


@pytest.mark.parametrize("seed", range(150))
def test_main_text_equals_the_plain_ratios(seed):
    page = page_of(seed)
    expected = brute.main_text(page, html_text.SHARE, given, html_text.BEYOND, html_text.PUNCTUATION)
    assert html_text.main_blocks(page) == expected


def test_the_plain_version_and_markup_alone_differ():
    """The ratios decide: on some pages they leave out blocks of the article that markup would keep."""
    decided = 0
    for seed in range(150):
        blocks, articles = html_text.blocks_of(page_of(seed))
        within = [b.text for b in blocks if b.scope in articles]
        kept = html_text.main_blocks(page_of(seed))
        decided += bool(articles) and any(text not in kept for text in within)
    assert decided > 8


@pytest.mark.parametrize("page, expected", [
    ("<article><h1><a href=x>Head of it</a></h1><p>{long}</article>", ["Head of it", "{long}"]),
    ("<article><p>{long}<figure><img><figcaption><a href=x>A view</a></figcaption></figure><p>{long}</article>",
     ["{long}", "A view", "{long}"]),
    ("<article><p>{long}</p><p class='related-work'>{long}</p><p id=comment-3>{long}</article>", ["{long}"] * 3),
    ("<article><h2 class=notice>Part two</h2><p>{long}</article>", ["Part two", "{long}"]),
    ("<article><p>{long}</p><div class=related><p>{long}</p></div></article>", ["{long}"]),
    ("<div class=promo><p>{long}</p></div><article><p>{long}</article>", ["{long}"]),
])
def test_article_text_is_not_lost_to_links_and_names(page, expected):
    assert html_text.main_blocks(page.replace("{long}", LONG)) == [e.replace("{long}", LONG.strip()) for e in expected]


@pytest.mark.parametrize("page", [
    "<div>" * 50_000 + "x", "<div>some text, here." * 50_000, "<article><p>text." * 50_000, "<div class=ad>t" * 50_000,
    "<div>" * 20_000 + "</x></p></span></li>" * 50_000, "<ul><li>x" * 50_000, "<span hidden>" * 50_000 + "x",
    "<a href=x>" * 50_000 + "x", "<table><tr><td>x" * 30_000,
], ids=lambda page: page[:14])
def test_deep_pages_take_linear_time(page):
    began = time.perf_counter()
    html_text.main_blocks(page)
    assert time.perf_counter() - began < 6
