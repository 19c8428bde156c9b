"""Page reading, line alignment, and extraction."""

import random

import pytest

from shelfwise.llm import extract as ex

PAGES = "page_id long, url string, html string, host string, path string, lines int"

ARTICLE = """<!DOCTYPE html><html><head><title>T &amp; t</title><style>p{}</style><script>var a="</p><p>no";</script></head><body class="sidebar-left">
<nav><ul><li>Home</li><li>News</li></ul></nav><div class="ad">Buy   now</div><header><h2>Site</h2></header>
<article><header><h1>A&nbsp;head   line</h1></header><p>First <b>bold</b> &lt;tag&gt;<br>more.<p>Second&#33;<!-- <p>no --><div class="comments"><p>Nice!</p></div>
<form><label>Mail</label><input></form><p hidden>no</p><ul><li>one<li>two</ul><p></p></article>
<aside>Related</aside><div id="cookie-notice">We use cookies</div><section class="comment-list"><article><p>first!</p></article></section><footer>&copy; x</footer></body></html>"""


def _page(main, top="Top line", foot="Foot line"):
    return f"<html><body><div>{top}</div><div>Menu A</div>{''.join(f'<p>{m}</p>' for m in main)}<div>{foot}</div></body></html>"


def _text(page, *others):
    lines = ex.read_lines(page)
    return ex.main_text(lines, [ex.line_hash(t) for t, _ in lines], [[ex.line_hash(t) for t, _ in ex.read_lines(o)] for o in others])[0]


def test_article_without_the_rest():
    assert _text(ARTICLE) == "A head line\n\nFirst bold <tag> more.\n\nSecond!\n\none\n\ntwo"


@pytest.mark.parametrize(
    "page, want",
    [
        (None, ""),
        ("", ""),
        ("plain &amp; simple", "plain & simple"),
        ("<p>a<p>b", "a\n\nb"),
        ("<article><p>kept", "kept"),
        ("<article><p>kept</p></div></span></article> tail", "kept"),
        ("<p>a < b and c > d</p>", "a < b and c > d"),
        ("<script>if (a < b) {}</script", ""),
        ("<!-- never closed <p>x", ""),
        ("<p title='a > b'>x</p>", "x"),
        ('<p title="never closed>x</p><p>y</p>', "x\n\ny"),
        ("<main><p>m</p></main><p>out</p>", "m"),
        ("<div class=ad><div>x</div>y</div><p>z</p>", "z"),
        ("<P>Upper</P><BR>case", "Upper\n\ncase"),
        ("<p>one<span class='share-buttons'>Share</span> two</p>", "one\n\ntwo"),
    ],
)
def test_pages(page, want):
    assert _text(page) == want


def test_long_page():
    page = "<body>" + "<p>x</p><b>" * 20_000 + "word " * 100_000
    assert _text(page).startswith("x\n\nx") and _text(page).endswith("word")


def _lcs(a, b):
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
    return table[-1][-1]


def test_alignment_is_a_longest_common_subsequence():
    rng = random.Random(2)
    for _ in range(1500):
        a, b = ([rng.randrange(6) for _ in range(rng.randrange(14))] for _ in range(2))
        flags = ex.shared_lines(a, b)
        rest = iter(b)
        assert sum(flags) == _lcs(a, b) and all(x in rest for x, f in zip(a, flags, strict=True) if f)


def test_alignment_of_many_lines():
    a, b = list(range(30_000)), list(range(0, 60_000, 2))
    assert sum(ex.shared_lines(a, b)) == 15_000
    assert sum(ex.shared_lines([1, 2] * 20_000, [2, 1] * 20_000)) == 39_999


def test_shared_lines_go_and_copies_say_nothing():
    one, two, copy = _page(["alpha text", "beta text", "Menu A"]), _page(["gamma text"]), _page(["alpha text", "beta text", "Menu A"])
    assert _text(one, two) == "alpha text\n\nbeta text\n\nMenu A"
    assert _text(one, copy, two) == "alpha text\n\nbeta text\n\nMenu A"
    assert _text(one, copy) == "Top line\n\nMenu A\n\nalpha text\n\nbeta text\n\nMenu A\n\nFoot line"


def test_lines_of_an_article_stay_even_if_shared():
    page = "<article><p>quoted passage</p><p>own words</p></article>"
    assert _text(page, "<article><p>quoted passage</p></article>") == "quoted passage\n\nown words"


def _brute(rows):
    keys = {}
    for page_id, url, page in rows:
        host, path = ex.url_key(url)
        if host is not None:
            h = [ex.line_hash(t) for t, _ in ex.read_lines(page)]
            old = keys.get((host, path))
            if old is None or (page_id is not None and (old[0] is None or (page_id, h) < old)):
                keys[host, path] = (page_id, h)
    order = sorted(keys)
    out = []
    for page_id, url, page in rows:
        key = ex.url_key(url)
        around = [(None, None), (None, None)]
        if key in keys:
            k = order.index(key)
            around = [(order[j][1], keys[order[j]][1]) if 0 <= j < len(order) and order[j][0] == key[0] else (None, None) for j in (k - 1, k + 1)]
        lines = ex.read_lines(page)
        text, n = ex.main_text(lines, [ex.line_hash(t) for t, _ in lines], ex._nearest_first(key[1], around))
        out.append((page_id, url, text, len(text), len(lines), n))
    return out


def test_extract_against_brute_force(spark):
    rng = random.Random(6)
    rows = [(k, f"http://h{rng.choice([0, 0, 0, 1, 2])}.org/{rng.choice('ab')}/{rng.randrange(25)}{rng.choice(['', '/', '.html', '?q=1'])}", _page([f"text {rng.randrange(40)}" for _ in range(3)], top=f"top {k % 2}")) for k in range(150)]
    rows += [(200, None, ARTICLE), (201, "not a url", ARTICLE), (202, "http://[bad", "x"), (203, "http://alone.net/1", _page(["solo"])), (None, "http://h0.org/a/3", None), (5, rows[5][1], rows[5][2])]
    got = ex.extract(spark.createDataFrame([(*r, "c", "c", 1) for r in rows], PAGES).repartition(5))
    assert got.columns == ["page_id", "url", "text", "n_chars", "n_lines", "n_shared"]
    got = sorted(map(tuple, got.collect()), key=repr)
    assert got == sorted(_brute(rows), key=repr)
    assert any(r[5] for r in got)


def test_no_rows(spark):
    assert ex.extract(spark.createDataFrame([], PAGES)).count() == 0
