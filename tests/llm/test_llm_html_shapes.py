"""Page shapes that hide an article from careless rules, and the two passes against a plain version."""

from __future__ import annotations

import random
import time

import brute
import pytest

from basketry.llm import html

PROSE = "The first of all the words that are here, and there is more of them to be had for you and for us."
OTHER = "When the water was high they would go to the mill with their horses, and it was all one to them."
MENU = "<ul class='main-nav'><li><a href=/>Home</a></li><li><a href=/a>All of the news</a></li></ul>"


@pytest.mark.parametrize(
    "page",
    [
        f"<article><p>{PROSE}</p><svg width=1 /><p>{OTHER}</p></article>",
        f"<article><p>{PROSE}</p><svg><path d=x /></svg><p>{OTHER}</p></article>",
        f"<article><p>{PROSE}</p><svg viewBox='0 0 1 1'><p>{OTHER}</p></article>",
        f"<article><p>{PROSE}</p><video-player src=x></video-player><p>{OTHER}</p></article>",
        f"<article><button-group><p>{PROSE}</p></button-group><title-bar></title-bar><p>{OTHER}</p></article>",
        f"<main class='page nav-open'><p>{PROSE}</p><p>{OTHER}</p></main>",
        f"<article class='post comments-open'><p>{PROSE}</p><p>{OTHER}</p></article>",
        f"<article class='post comments'><p>{PROSE}</p><p>{OTHER}</p></article>",
        f"<div class='layout layout--sidebar'><p>{PROSE}</p><p>{OTHER}</p></div>",
        f"<div class='page search-enabled'><p>{PROSE}</p><p>{OTHER}</p></div>",
        f"<div id='related-work'><p>{PROSE}</p><p>{OTHER}</p></div>",
        f"<div class='page with-sidebar'><p>{PROSE}</p><p>{OTHER}</p></div>",
        f"<form action=/ method=post><div>{MENU}<p>{PROSE}</p><p>{OTHER}</p></div></form>",
        f"<form class='search'><div class='widget'><p>{PROSE}</p><p>{OTHER}</p></div></form>",
        f"<article><p>Short teaser.</p></article><div><p>{PROSE}</p><p>{OTHER}</p></div>",
        f"<div class='left-sidebar'>Hints of the day</div><div><p>{PROSE}</p><p>{OTHER}</p></div>",
    ],
)
def test_article_is_found(page):
    text = html.main_text(f"<html><body>{MENU}{page}<footer>All of it is ours.</footer></body></html>")
    lines = text.split("\n")
    assert PROSE in lines and OTHER in lines
    assert not {"Home", "All of it is ours.", "Hints of the day"} & set(lines)


@pytest.mark.parametrize(
    "mark", ["sidebar", "left-sidebar", "comments-list", "cookie-banner", "ad-slot-3", "widget_area", "site-footer", "no-ads ads"]
)
def test_regions_named_by_a_class_go(mark):
    page = f"<body><div><p>{PROSE}</p></div><div class='{mark}'><p>{OTHER}</p></div></body>"
    assert html.main_text(page) == PROSE


@pytest.mark.parametrize("mark", ["comments", "cookie-notice", "newsletter", "ad"])
def test_notices_alone_are_no_article(mark):
    assert html.main_text(f"<body>{MENU}<div class='{mark}'><p>{PROSE}</p></div></body>") == ""


@pytest.mark.parametrize(
    "page",
    ["<div>{}</p>", "<svg>x{}", "<a title='x>{}", "<div class=sidebar>x{}", "<object>{}<p>x", "<!-- {}<p", "<{}"],
)
def test_time_grows_with_the_page(page):
    head, tail = page.split("{}")
    start = time.process_time()
    html.main_text(head * 40_000 + tail * 40_000)
    assert time.process_time() - start < 10  # four times the tags took sixteen times as long: minutes


def tree(rng, depth, skipped, inside, linked):
    """Markup of a random region, and its blocks as the plain version wants them."""
    markup, blocks = "", []
    for _ in range(rng.randint(1, 4)):
        kind = rng.random()
        if kind < 0.45 and depth:
            name, mark = rng.choice([("div", ""), ("section", " class=story"), ("nav", ""), ("div", " class=sidebar"), ("article", "")])
            skip = name == "nav" or "sidebar" in mark or (skipped and name != "article")
            inner, found = tree(rng, depth - 1, skip, inside or (name == "article" and not skip), linked)
            markup += f"<{name}{mark}>{inner}</{name}>"
            blocks += found
        else:
            words = rng.choices(["the", "of", "and", "mill", "horse", "river", "x&amp;y"], k=rng.choice([2, 6, 20, 60]))
            text = " ".join(words)
            is_link = rng.random() < 0.25
            markup += f"<p>{'<a href=/>' * is_link}{text}{'</a>' * is_link}\n</p>"
            plain = text.replace("&amp;", "&")
            blocks.append((plain, len(plain) if is_link else 0, inside, skipped))
    return markup, blocks


def test_two_passes_against_a_plain_version():
    rng = random.Random(21)
    texts = set()
    for _ in range(600):
        markup, blocks = tree(rng, 3, False, False, False)
        text = html.main_text(f"<html><body>{markup}</body></html>")
        again = brute.main_blocks(blocks, html.STOP_WORDS)
        if again or not any(b[3] for b in blocks):
            assert text == "\n".join(again), markup
        texts.add(text)
    assert len(texts) > 400


def test_clashing_names_are_replaced(spark):
    rows = [(1, "u", f"<p>{PROSE}</p>", "old", 5)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string, _html int")
    found = html.extract(pages, ["page_id", "text", "_html"])
    assert found.columns == ["page_id", "_html", "text"]
    assert found.first() == (1, 5, PROSE)
