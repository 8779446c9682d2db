from __future__ import annotations

import random
import time

import pytest

from logscore.llm import wrappers
from tests.llm.helpers import rows_of

PAGES = "page_id bigint, url string, html string, host string, text string"


def page(i: int, body: str, main: str = "article", tail: str = "</body></html>") -> str:
    return (
        f"<!DOCTYPE html><html><head><title>T{i}</title><style>p{{}}</style><script>var a='</p>';</script></head>"
        f"<body class='x'><header><h2>Site name</h2></header><nav><ul><li><a href=/{i}>Menu {i}</a><li>Home</ul></nav>"
        f"<div class='cookie-notice'>We use cookies {i}</div><p>Fixed line of the site</p>"
        f"<{main}>{body}</{main}><div class=ad>Buy {i}</div><section id='comments'><p>Reader {i}: nice</p></section>"
        f"<form><p>Write</p><input></form><aside>Side {i}</aside><footer>&copy; {i}</footer>{tail}"
    )


def body(i: int) -> tuple[str, str]:
    rng = random.Random(i)
    words = [" ".join(rng.choice("abcdefg") * 3 for _ in range(20)) for _ in range(3)]
    html = f"<h1>Title <em>no {i}</em></h1><p><b>{words[0]}<br>A &amp; B&nbsp;&lt;c&gt;\n  d<p>{words[1]}</p>Shared words<ul><li>{words[2]}<li>two</ul>"
    text = [f"Title no {i}", f"{words[0]} A & B <c> d", words[1], "Shared words", words[2], "two"]
    return html, "\n\n".join(text)


@pytest.mark.parametrize("main", ["article", "main", "div"])
def test_main_text(main):
    """Also where the content is a plain element that only alignment can find."""
    pages = [page(i, body(i)[0], main) for i in range(8)]
    wrapper = wrappers.Wrapper.load(wrappers.induce(pages).dump())
    for i in range(20):
        assert wrappers.extract(page(i, body(i)[0], main), wrapper) == body(i)[1]
        cut = page(i, body(i)[0], main, tail="")
        assert wrappers.extract(cut, wrapper) == body(i)[1]


def test_a_paragraph_that_pages_share_stays():
    pages = [page(i, f"<p>All say this</p><p>Only {i}</p>") for i in range(6)]
    assert wrappers.extract(pages[2], wrappers.induce(pages)) == "All say this\n\nOnly 2"
    copies = [page(1, "<p>Same page</p>")] * 6
    assert wrappers.extract(copies[0], wrappers.induce(copies)) == "Same page"


def test_repeated_sections_are_all_content():
    def sections(i: int) -> str:
        return "".join(f"<div class=section><h2>Head {i} {k}</h2><p>Text {i} {k}</p></div>" for k in range(5))

    pages = [f"<div class=top>Site</div>{sections(i)}<div class=end>The end</div>" for i in range(8)]
    wrapper = wrappers.Wrapper.load(wrappers.induce(pages).dump())
    expected = "\n\n".join(f"Head 3 {k}\n\nText 3 {k}" for k in range(5))
    assert wrappers.extract(pages[3], wrapper) == expected


@pytest.mark.parametrize("between", ["", "<div class=ad>Buy</div>"])
@pytest.mark.parametrize("outer", ["main", "div"])
def test_sibling_articles_are_all_content(outer, between):
    def articles(i: int) -> str:
        two = between.join(f"<article><p>Story {i} {k}</p></article>" for k in "ab")
        return f"<p>Site</p><{outer}>{two}</{outer}>"

    pages = [articles(i) for i in range(8)]
    for wrapper in (wrappers.induce(pages), None):
        assert wrappers.extract(pages[3], wrapper) == "Story 3 a\n\nStory 3 b"


def test_constant_nodes_become_template():
    """Without an element for the content, text that all pages have goes."""
    pages = [f"<div><p class=t>Welcome to the site</p></div><h1>Title {i}</h1><p>Text {i}</p>" for i in range(6)]
    wrapper = wrappers.induce(pages)
    assert wrappers.extract(pages[3], wrapper) == "Title 3\n\nText 3"
    other = "<div><p class=t>Another line</p></div><h1>X</h1><p>Y</p>"
    assert wrappers.extract(other, wrapper) == "Another line\n\nX\n\nY"


def test_pages_that_do_not_fit(spark):
    wrapper = wrappers.induce([page(i, body(i)[0]) for i in range(5)])
    assert wrappers.extract("<table><tr><td>cell<td>next</table>", wrapper) == "cell\n\nnext"
    assert wrappers.extract("plain &eacute; text <", wrapper) == "plain é text <"
    assert wrappers.extract("", wrapper) == wrappers.extract("", None) == ""
    assert wrappers.extract(page(1, "<p>a</p>"), None) == "a"
    assert wrappers.extract("<article hidden>no</article><p style='display: none'>no</p>yes", None) == "yes"
    assert wrappers.induce([]) is None


def folded(text: str) -> wrappers.Shape:
    return wrappers.shape_of(wrappers.parse(text))[0]


def test_simple_tree_matching():
    a = folded("<div><h1>x</h1><p>a</p><p>b</p><hr></div>")
    b = folded("<div><p>c</p><hr><h2>z</h2></div>")
    assert [k.sign for k in a.kids[0].kids] == ["h1.", "p.", "hr."]
    assert wrappers.matched(a, b)[0] == 4  # html, div, p, hr
    merged = wrappers.merge(a, b).kids[0]
    assert [(k.sign, k.text, k.pages) for k in merged.kids] == [
        ("h1.", "x", 1), ("p.", None, 2), ("hr.", "", 2), ("h2.", "z", 1),
    ]


def brute_size(a: wrappers.Shape, b: wrappers.Shape) -> int:
    """Simple tree matching as it is defined, by recursion over all choices of kids in order."""
    if a.sign != b.sign:
        return 0

    def best(x: tuple, y: tuple) -> int:
        if not x or not y:
            return 0
        return max(best(x[1:], y), best(x, y[1:]), brute_size(x[0], y[0]) + best(x[1:], y[1:]))

    return 1 + best(tuple(a.kids), tuple(b.kids))


@pytest.mark.parametrize("seed", range(8))
def test_tree_matching_against_brute_force(seed):
    rng = random.Random(seed)

    def tree(depth: int) -> str:
        tags = rng.sample(["div", "ul", "section", "p", "table"], rng.randint(0, 4)) if depth else []
        return "".join(f"<{t}>{tree(depth - 1)}</{t}>" for t in tags)

    for _ in range(20):
        a, b = folded(tree(3)), folded(tree(3))
        assert wrappers.matched(a, b)[0] == brute_size(a, b)


@pytest.mark.parametrize(
    "html",
    [
        "<p title='hidden costs'>text</p>", "<p aria-hidden='false'>text</p>",
        "<div data-class='nav'><p>text</p></div>", "<body class='has-sidebar'><p>text</p></body>",
        "<body class='no-comments'><p>text</p></body>", "<div id='ad-astra'><p>text</p></div>",
        "<article class='post search-result'><p>text</p></article>", "<body class=nav><p>text</p>",
        "<article class=comment><p>text</p></article>", "<main id=search role=search>text</main>",
        "<p data-x=\"class='ad'\">text</p>", "<p alt='style=display:none'>text</p>",
    ],
)
def test_attributes_that_say_nothing(html):
    assert wrappers.extract(html, None) == "text"
    pages = [html.replace("text", f"text {i}") for i in range(5)]
    assert wrappers.extract(pages[2], wrappers.induce(pages)) == "text 2"


@pytest.mark.parametrize("text", ["<div class='x ad y'>no</div>", "<p role=Navigation>no</p>", "<p id=cookie-banner>no",
                                  "<div style='display : none'>no</div>", "<p hidden=''>no</p>"])
def test_attributes_that_count(text):
    assert wrappers.extract(f"{text}<p>yes</p>", None) == "yes"


@pytest.mark.parametrize("tag,times", [("font", 1500), ("div", 1200), ("div", 10_000), ("b", 10_000), ("ul", 3000)])
def test_deep_pages(tag, times):
    deep = f"<{tag}>" * times + "text"
    assert wrappers.extract(deep, None) == "text"
    pages = [f"{deep} {i}" for i in range(3)]
    wrapper = wrappers.Wrapper.load(wrappers.induce(pages).dump())
    assert wrappers.extract(pages[1], wrapper) == "text 1"


def test_matching_takes_time_in_proportion():
    pages = ["<div><p>a</p>" * 60 + f"text {i}" for i in range(3)]
    start = time.perf_counter()
    wrappers.induce(pages)
    assert time.perf_counter() - start < 0.1


def test_wrapper_finds_what_rules_do_not():
    """The content is a plain element, in a page full of other plain ones."""
    def plain(i: int) -> str:
        fixed = "".join(f"<div><p>Line {k} of the site, always the same</p></div>" for k in range(4))
        return f"{fixed}<section><div>By us</div><p>Story {i}</p><p>More of {i}</p></section>{fixed}"

    pages = [plain(i) for i in range(6)]
    wrapper = wrappers.Wrapper.load(wrappers.induce(pages).dump())
    assert wrappers.extract(pages[3], wrapper) == "By us\n\nStory 3\n\nMore of 3"
    assert wrappers.extract(pages[3], None) != wrappers.extract(pages[3], wrapper)


def test_second_layout_of_a_host(spark):
    """Few pages of a large host have another layout; their fixed lines are found too."""
    first = [f"<div class=a><p>Top</p></div><div class=b><div><p>Text {i}</p><p>x</p></div></div>" for i in range(300)]
    second = [f"<section><p>Other top</p><div class=c><p>Rare {i}</p><p>y {i}</p></div></section>" for i in range(6)]
    rows = [(i, "http://h.example/", x, "", "") for i, x in enumerate(first + second)]
    rows += [(1000 + i, "http://h.example/", first[0], "", "") for i in range(200)]
    pages = wrappers.outlined(spark.createDataFrame(rows, PAGES).repartition(4))
    found = {r.page_id: r.text for r in wrappers.extract_main_text(pages, wrappers.induce_wrappers(pages)).collect()}
    assert found[7] == "Text 7\n\nx" and found[1100] == "Text 0\n\nx"
    assert [found[300 + i] for i in range(6)] == [f"Rare {i}\n\ny {i}" for i in range(6)]


def test_table(spark):
    rows = [(i, f"http://h{i % 2}.example/{i}", page(i, body(i)[0]), "h", "t") for i in range(30)]
    rows += [(100, None, None, None, None), (101, "no url", "", "", ""), (0, *rows[0][1:]), (None, "http://h0.example", page(3, "<p>x</p>" * 2000), "", "")]
    table = spark.createDataFrame(rows, PAGES).repartition(3)
    pages = wrappers.outlined(table)
    found = rows_of(wrappers.extract_main_text(pages, wrappers.induce_wrappers(pages)), "page_id", "url", "text", "n_chars")
    expected = [(i, f"http://h{i % 2}.example/{i}", body(i)[1], len(body(i)[1])) for i in [*range(30), 0]]
    many = "\n\n".join("x" * 2000)
    expected += [(100, None, "", 0), (101, "no url", "", 0), (None, "http://h0.example", many, len(many))]
    assert found == sorted(expected, key=repr)
    empty = wrappers.outlined(table.where("false"))
    assert wrappers.extract_main_text(empty, wrappers.induce_wrappers(empty)).collect() == []
