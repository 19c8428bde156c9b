"""Pages on which a shorter path would lose text or leave the template."""

import pytest

from shelfwise.llm import extract as ex

from .test_extract import PAGES, _page, _text


@pytest.mark.parametrize(
    "page, want",
    [
        ('<article class="post category-social"><p>kept</p></article>', "kept"),
        ('<main class="content no-sidebar"><p>kept</p></main>', "kept"),
        ('<article class="promo"><p>kept</p></article>', "kept"),
        ('<article><h2 id="related-work">Related work</h2><p>kept</p></article>', "Related work\n\nkept"),
        ('<article><section id="search"><p>kept</p></section><p id="notice">too</p><p class="alert">three</p></article>', "kept\n\ntoo\n\nthree"),
        ('<article><div class="share-buttons">Share</div><aside>x</aside><div class="ad">Buy</div><p>kept</p></article>', "kept"),
        ('<div class="overlay">Menu<article><p>kept</p><div class="ad">Buy</div></article>End</div><p>free</p>', "kept"),
        ('<div class="comments"><article><p>first</p></article></div><article><p>kept</p></article>', "kept"),
        ('<div id="cookie-notice">We use</div><p>kept</p>', "kept"),
        ('<h2 id="comments">On comments</h2><p>kept</p>', "On comments\n\nkept"),
    ],
)
def test_names_drop_no_article_text(page, want):
    assert _text(page) == want


def _extract(spark, pages):
    rows = [(k, url, page, "c", "c", 1) for k, (url, page) in enumerate(pages)]
    return [r.text for r in ex.extract(spark.createDataFrame(rows, PAGES).repartition(3)).orderBy("page_id").collect()]


def test_pages_of_one_path_are_paired(spark):
    tale = "told at more length than its template"
    pages = [(f"http://one.org/index.php?id={k}", _page([f"story {k} {tale}"])) for k in range(5)]
    other = [("http://two.org/a/b", "<p>Other layout</p>"), ("http://two.org/a/c?id=1", _page([f"1 {tale}"])), ("http://two.org/a/c?id=2", _page([f"2 {tale}"])), ("http://two.org/a/d", "<p>End</p>")]
    assert _extract(spark, pages + other) == [f"story {k} {tale}" for k in range(5)] + ["Other layout", f"1 {tale}", f"2 {tale}", "End"]


def test_a_short_article_in_a_large_template():
    top = "template " * 200
    one, two, three = (_page([f"short story {k}"], top=top) for k in range(3))
    assert _text(one, two) == _text(one, two, three) == "short story 0"
    assert _text(one, two, "<p>Another layout</p>") == "short story 0"


def test_a_near_copy_is_not_the_template():
    story = "the long story " * 40
    one, near, other = _page([story, "seen 3 times"]), _page([story, "seen 4 times"]), _page(["another story " * 40])
    assert _text(one, near, other) == f"{story.strip()}\n\nseen 3 times"


def test_runs_of_copies_find_the_next_page(spark):
    copies = [(f"http://c.org/a/{k}", f"<nav>{k}</nav>" + _page(["one story, copied"])) for k in range(5)]
    other = [("http://c.org/b/1", _page(["another one"])), ("http://d.org/a", _page(["alone"])), ("http://d.org/b", _page(["alone"]))]
    same = "Top line\n\nMenu A\n\nalone\n\nFoot line"
    assert _extract(spark, copies + other) == ["one story, copied"] * 5 + ["another one", same, same]


def test_teasers_are_not_the_story():
    one, two = (f"<div>Top</div><div><p>{f'story {k} at length ' * 9}</p></div><article>teaser {k}</article><article>card {k}</article>" for k in range(2))
    assert _text(one, two) == f"{('story 0 at length ' * 9).strip()}\n\nteaser 0\n\ncard 0"


@pytest.mark.parametrize(
    "block",
    [
        '<div id="comments">GONE</div>',
        '<div class="user-comments">GONE</div>',
        '<section id="user-comments"><p>GONE</p></section>',
        '<div id="responses"><p>GONE</p></div>',
        '<ol><li class="comment">GONE</li></ol>',
        '<p class="advert">GONE</p>',
        '<p class="ad">GONE</p>',
        '<div class="ad-slot">GONE</div>',
        '<div class="site-notice">GONE</div>',
        '<div style="color: red; display: none">GONE</div>',
        '<p style="display:none">GONE</p>',
        '<span style="visibility:hidden">GONE</span>',
    ],
)
@pytest.mark.parametrize("around", ["article", "main"])
def test_comments_adverts_and_hidden_text_in_an_article(block, around):
    page = f"<html><body><nav>menu</nav><{around}><h1>Title</h1><p>First.</p>{block}<p>Last.</p></{around}><footer>end</footer></body></html>"
    assert ex.main_text(ex.read_lines(page), [ex.line_hash(t) for t, _ in ex.read_lines(page)], [])[0] == "Title\n\nFirst.\n\nLast."


@pytest.mark.parametrize(
    "block, text",
    [
        ('<h2 id="related-work">Kept</h2>', "Kept"),
        ('<h2 id="comments">Kept</h2>', "Kept"),
        ('<section id="search"><p>Kept</p></section>', "Kept"),
        ('<p id="notice">Kept</p>', "Kept"),
        ('<p id="ad">Kept</p>', "Kept"),
        ('<p class="address">Kept</p>', "Kept"),
        ('<p class="comment-theory">Kept</p>', "Kept"),
        ('<div class="badge ads-history">Kept</div>', "Kept"),
        ('<pre><code>x <i class="comment"># Kept</i></code></pre>', "x # Kept"),
        ('<p style="display: block">Kept</p>', "Kept"),
        ('<p class="response">Kept</p>', "Kept"),
    ],
)
def test_names_that_only_look_like_boilerplate(block, text):
    page = f"<html><body><article><p>First.</p>{block}<p>Last.</p></article></body></html>"
    lines = ex.read_lines(page)
    assert ex.main_text(lines, [ex.line_hash(t) for t, _ in lines], [])[0] == f"First.\n\n{text}\n\nLast."
