import html
import random
import re
import time

import pytest
from samples import SF

from themewell.llm import page_text
from themewell.llm.page_text import BARE, MAIN, ODD, SHELL, aligned, lines_of

PAGES = "page_id long, url string, html string, text string, block int, lines string"


@pytest.fixture
def pages_of(spark):
    def make(rows, partitions=3):
        return spark.createDataFrame([(*r, "clash", 1, "clash") for r in rows], PAGES).repartition(partitions)

    return make


def texts(pages):
    return {r.page_id: r.text for r in page_text.extract(pages).collect()}


def subsequence_length(a, b):
    last = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(last[j] + 1 if x == y else max(last[j + 1], new[j]))
        last = new
    return last[-1]


def test_alignment_is_a_longest_common_subsequence():
    rng = random.Random(4)
    for _ in range(200):
        k = rng.randint(1, 6)
        a, b = ([rng.randrange(k) for _ in range(rng.randint(0, 40))] for _ in range(2))
        found = aligned(a, b)
        rest = iter(b)
        assert all(a[i] in rest for i in found) and len(found) == subsequence_length(a, b)


def test_alignment_of_very_many_lines():
    rng = random.Random(5)
    a, b = ([rng.randrange(3) for _ in range(20_000)] for _ in range(2))
    began = time.time()
    assert len(aligned(a, b)) > 12_000 and time.time() - began < 30


def test_lines():
    page = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="</p><p>x";</script></head>
    <body class="has-sidebar"><nav><a href="/">Home</a></nav><div class="site-notice">We use <b>cookies</b></div>
    <article class="post"><header><h1>A &amp; B</h1><span>by me</span></header><p>One<br>two&nbsp;three <b>four
    <p class="lead">Five <a href=x>six</a><ul><li><a>l</a><li>plain item</ul><form><p>Send</p></form>
    <blockquote>Quote</blockquote><aside>Side</aside><div hidden>no</div><section id="comments"><p>First!</p></section>
    </article><p>Bare</p><footer>&copy; us</footer>"""
    assert lines_of(page) == [
        (SHELL, "Home"), (SHELL, "We use cookies"), (MAIN, "A & B"), (ODD, "by me"), (MAIN, "One two three four"), (ODD, "Five six"),
        (ODD, "l"), (MAIN, "plain item"), (SHELL, "Send"), (MAIN, "Quote"), (SHELL, "Side"), (SHELL, "no"), (SHELL, "First!"),
        (BARE, "Bare"), (SHELL, "© us"),
    ]


@pytest.mark.parametrize(
    "broken, want",
    [
        (None, []), ("", []), ("just text", [(BARE, "just text")]), ("a < b & c", [(BARE, "a < b & c")]),
        ("<p>open <a href='x", [(BARE, "open")]), ("<p>x<!-- never closed <p>y", [(BARE, "x")]),
        ("<b><article>in</b> still</article> out", [(MAIN, "in still"), (BARE, "out")]),
        ("</div></p>x<p>y</div>z", [(BARE, "x"), (BARE, "yz")]), ("<script>x", []), ("&lt;p&gt; &am &#x41;", [(BARE, "<p> &am A")]),
    ],
)
def test_broken_markup(broken, want):
    assert lines_of(broken) == want


@pytest.mark.parametrize("piece", ['<a "', "<p>x", "</", "<i></b>", "<i><div></i>", "<!--", "<a href='", "&lt", "<li><ul>"])
def test_long_pages_take_linear_time(piece):
    began = time.time()
    lines_of(piece * 100_000)
    assert time.time() - began < 20


def test_given_pages(spark):
    """Article by regular expressions, for the well-formed pages of the tables."""
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    got = texts(pages)
    for r in pages.collect():
        article = re.search("<article>(.*?)</article>", r.html, re.S)[1]
        blocks = [" ".join(html.unescape(re.sub("<[^>]*>", "", x)).split()) for x in re.split("</?p>|</?h1>", article)]
        assert got[r.page_id] == "\n\n".join(b for b in blocks if b)


def site(own, extra=""):
    return f"<div>Start</div><div>All topics</div>{extra}" + "".join(f"<p>{x}</p>" for x in own) + "<div>Read more</div><div>Imprint</div>"


def test_shared_lines_go_where_markup_tells_nothing(pages_of):
    rows = [(i, f"http://h.example/{'ab'[i % 2]}/{i}", site([f"own {i}", "quoted", f"more {i}"])) for i in range(6)]
    rows.append((6, "http://lone.example/", site(["alone"])))
    got = texts(pages_of(rows))
    assert got[0] == "own 0\n\nmore 0" and got[5] == "own 5\n\nmore 5"
    assert got[6] == "Start\n\nAll topics\n\nalone\n\nRead more\n\nImprint"


def test_quoted_passages_of_articles_stay(pages_of):
    page = "<article><h1>Same</h1><p>licence line</p><p>own {0}</p><div class=x>Print this</div></article>"
    got = page_text.extract(pages_of([(i, f"http://h/{i}", page.format(i)) for i in range(3)])).collect()
    for r in got:
        assert r.text == f"Same\n\nlicence line\n\nown {r.page_id}"
        assert r.n_chars == len(r.text) and r.n_deleted == 1 and r.partner_id is not None


def test_partner_is_near_by_path_and_no_copy(pages_of):
    rows = [
        (0, "http://h/a/1", site(["first"], "<div>In a</div>")), (1, "http://h/a/2", site(["second"], "<div>In a</div>")),
        (2, "http://h/b/1", site(["third"], "<div>In b</div>")), (3, "http://h/b/2", site(["fourth"], "<div>In b</div>")),
        (4, "http://H/b/2?x=1", site(["fourth"], "<div>In b</div>")),
    ]
    got = {r.page_id: r for r in page_text.extract(pages_of(rows)).collect()}
    assert [got[i].partner_id for i in range(3)] == [1, 0, 3] or got[2].partner_id == 4
    assert [got[i].text for i in range(5)] == ["first", "second", "third", "fourth", "fourth"]


def test_only_copies(pages_of):
    rows = [(i, f"http://h/{i}", site(["the same long text of them all"])) for i in range(4)]
    assert {r.partner_id for r in page_text.extract(pages_of(rows)).collect()} == {None}


def test_odd_and_empty(pages_of):
    rows = [(1, None, "<p>a</p>"), (None, "http://[", "<p>b</p>"), (2, "http://h", None), (2, "http://h", None), (3, "", ""), (4, "http://h/x", "<p>" + "long " * 200_000)]
    got = page_text.extract(pages_of(rows)).collect()
    assert sorted((r.text[:4], r.n_chars) for r in got) == [("", 0)] * 3 + [("a", 1), ("b", 1), ("long", 999_999)]
    assert page_text.extract(pages_of([])).collect() == []


def test_layout_does_not_matter(pages_of, monkeypatch):
    monkeypatch.setattr(page_text, "BLOCK_PAGES", 8)
    rng = random.Random(6)
    rows = [(i, f"http://h{rng.randrange(3)}/{rng.randrange(9)}/{rng.randrange(50)}", site([f"own {rng.randrange(60)}", "x"])) for i in range(120)]
    one, many = (sorted(page_text.extract(pages_of(rows, n)).collect(), key=str) for n in (1, 9))
    assert one == many and sum(r.partner_id is not None for r in one) > 100
