"""Pages whose article is known: class names of themes, text beside articles, deep tags."""

from __future__ import annotations

import random
import time
import tracemalloc

import pytest

from sensorstar.llm.html_paths import _says, extract_pages, main_text
from sensorstar.llm.html_paths import BOILERPLATE_NAMES as NAMES

BODY = "<h1>Title</h1><p>One two, four. Five!</p><p>Six seven, eight.</p>"
TEXT = "Title One two, four. Five! Six seven, eight."
OTHER = "<div><p>Other, long text. It goes on and on, for ever, without end.</p></div>"


@pytest.mark.parametrize("theme", [
    'class="content no-sidebar"', 'class="site has-sidebar"', 'class="post social-history"', 'id="page" class="comments-open"',
    'class="with-menu"', 'id="notice-of-motion"', 'class="hasComments"', 'class="recommended-reading"',
])
def test_themes_mark_nothing(theme):
    assert main_text(f"<body><div {theme}>{BODY}</div></body>") == TEXT
    assert main_text(f"<body><div {theme}>{BODY}</div>{OTHER}</body>").startswith(TEXT)


@pytest.mark.parametrize("name", [
    "sidebar", "site-footer", "main_nav", "siteFooter", "comment-list", "related-posts", "ad", "ad-slot-3", "cookie-banner", "share-buttons", "breadcrumbs",
])
def test_names_of_boilerplate(name):
    assert _says(name, NAMES)
    page = f"<body><div>{BODY}</div><div class='x {name}'><p>Buy this, now. It is cheap!</p></div></body>"
    assert main_text(page) == TEXT
    # The whole page in it: nothing else is there, so it is no boilerplate.
    assert main_text(f"<body><div class='{name}'>{BODY}</div></body>") == TEXT


def test_paragraphs_with_class_words():
    page = f"<article>{BODY}<p class='share-price'>The price, 5.</p><p class='notice'>Notice this.</p></article>"
    assert main_text(page) == f"{TEXT} The price, 5."


def test_a_form_around_the_page():
    page = f"<form id='aspnetForm'><nav><a href=x>Home</a></nav><div class=menu><a href=x>Home</a></div><article>{BODY}</article></form>"
    assert main_text(page) == TEXT
    assert main_text(f"<body><article>{BODY}</article><form><p>Your name, please.</p></form></body>") == TEXT


def test_large_comments_and_small_teasers():
    comment = "<article class='comment-body'><p>" + "Nice, really. " * 80 + "</p></article>"
    assert main_text(f"<body><div>{BODY}</div><section id=comments>{comment * 5}</section></body>") == TEXT
    teaser = "<aside><article><p>Teaser, short.</p></article></aside>"
    assert main_text(f"<body>{teaser}<div>{BODY}</div></body>") == TEXT
    assert main_text(f"<body><div class=banner><h1>My site</h1></div><div>{BODY.replace('h1', 'h2')}</div></body>") == TEXT


@pytest.mark.parametrize("length", [1, 3, 10, 40])
def test_text_beside_an_article_stays_whatever_its_share(length):
    """However much of the text the article holds, a paragraph beside it stays."""
    article = "<p>" + "Long text, with commas, and more. " * length + "</p>"
    found = main_text(f"<body><nav><a>Home</a></nav><article>{article}</article>{OTHER}<div class=footer><p>Imprint, here.</p></div></body>")
    assert found == "Long text, with commas, and more. " * length + "Other, long text. It goes on and on, for ever, without end."


def test_hidden_text_never_counts():
    assert main_text(f"<div hidden>{BODY}</div>") == "" and main_text(f"<div aria-hidden=true>{BODY}</div><p>Seen.</p>") == "Seen."


def words(rng, low, high):
    return " ".join("".join(rng.choices("abcdefghij", k=rng.randrange(2, 9))) for _ in range(rng.randrange(low, high)))


@pytest.mark.parametrize("seed", range(40))
def test_labelled_pages(seed):
    """Pages of several shapes: the blocks of the article come back, in order, and nothing else."""
    rng = random.Random(seed)
    blocks = [("h1", words(rng, 2, 6).capitalize())]
    for _ in range(rng.randrange(3, 12)):
        tag = rng.choice(["p", "p", "p", "blockquote", "li", "h2"])
        text = words(rng, 3, 8).capitalize() if tag == "h2" else ", ".join(words(rng, 3, 20) for _ in range(3)).capitalize() + "."
        blocks.append((tag, text))
    shown = "".join(f"<ul><li>{t}</li></ul>" if tag == "li" else f"<{tag}>{t}</{tag}>" for tag, t in blocks)
    around = rng.choice(["article", "main", "div class='post'", "div class='content no-sidebar'", "section", "td"])
    inner = f"<{around}>{shown}</{around.split()[0]}>"
    inner = f"<table><tr>{inner}</tr></table>" if around == "td" else inner
    for _ in range(rng.randrange(4)):
        inner = f"<div class='{rng.choice(['wrap', 'has-menu', 'page', 'row'])}'>{inner}</div>"
    menu = "<ul>" + "".join(f"<li><a href=x>{words(rng, 1, 3)}</a></li>" for _ in range(rng.randrange(2, 9))) + "</ul>"
    before = rng.choice([f"<nav>{menu}</nav>", f"<div class='main-menu'>{menu}</div>", f"<header>{menu}</header>", menu])
    notice = f"<div class='cookie-notice'><p>We use cookies, {words(rng, 5, 30)}.</p></div>"
    comments = f"<div id=comments><p>First, {words(rng, 3, 60)}.</p><p>Second, {words(rng, 3, 60)}.</p></div>"
    after = "".join(rng.sample([notice, comments, f"<footer><p>Imprint, {words(rng, 3, 9)}.</p></footer>", "<aside><p>Read more, too.</p></aside>"], 3))
    page = f"<html><head><title>x</title></head><body>{before}{inner}{after}<script>var a = '<p>';</script></body></html>"
    assert main_text(page) == " ".join(t for _, t in blocks)


@pytest.mark.parametrize("page", ["<div>{}", "<b>{}", "<div><b></i>{}", "<p><b>{}", "<ul><li>{}", "<div class='no-sidebar'>{}"])
def test_deep_pages(page):
    """50,000 open tags take little memory, and time in proportion."""
    start = time.perf_counter()
    assert main_text(page.format("") * 50_000 + "word, text.").endswith("word, text.")
    assert time.perf_counter() - start < 10
    tracemalloc.start()
    main_text(page.format("x ") * 50_000)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 200e6


def test_tables_of_pages(spark):
    schema = "page_id long, url string, html string, text string, n_chars long"
    rows = [(1, "u", f"<div>{BODY}</div>", "clash", -1), (1, "u", f"<div>{BODY}</div>", "clash", -1), (None, None, None, None, None), (2, "v", "", "", 0)]
    got = extract_pages(spark.createDataFrame(rows, schema)).collect()
    assert sorted((r["page_id"] or 0, r["text"], r["n_chars"]) for r in got) == [(0, "", 0), (1, TEXT, len(TEXT)), (1, TEXT, len(TEXT)), (2, "", 0)]
    assert extract_pages(spark.createDataFrame([], schema)).columns == ["page_id", "url", "text", "n_chars"]
    long = "<p>" + "Long text, with commas, and more. " * 100_000 + "</p>"
    assert extract_pages(spark.createDataFrame([(3, "w", long, "", 0)], schema)).first()["n_chars"] == 3_399_999
