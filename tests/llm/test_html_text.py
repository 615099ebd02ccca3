import random
import time
from collections import Counter

import pyarrow.parquet as pq
import pytest

from tablewright.llm import html_text
from tablewright.llm.html_text import Page, extract, main_text, path_scores, said

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="</p>";</script></head>
<body class="with-sidebar"><header><h1>Site</h1></header><nav><ul><li><a href="/">Home</a></li></ul></nav>
<!-- ad --><div class="ad">Buy &amp; smile.</div><div class="cookie-notice">We use cookies, do you agree?</div>
%s
<aside>Latest news, and more.</aside><form><label>Your mail</label><input></form>
<section id="comments"><p>First! I liked it, really.</p></section><footer>&copy; someone</footer></body></html>"""

ARTICLE = "<h1>A  title</h1><p>It <b>begins</b>, and\n goes&nbsp;on &lt;here&gt;.<p>Second part, caf&eacute;.<ul><li>one<li>two</ul>"
TEXT = "A title\nIt begins, and goes on <here>.\nSecond part, café.\none\ntwo"


def test_marked_article():
    assert main_text(PAGE % f"<article>{ARTICLE}</article>") == TEXT
    assert main_text(PAGE % f"<main><div>{ARTICLE}</div></main>") == TEXT
    assert main_text(PAGE % f'<article class="post"><header>{ARTICLE}</header></article>') == TEXT


def test_article_found_by_its_paths():
    paragraphs = "".join(f"<p>Sentence {i}, with some words in it. And another one; longer.</p>" for i in range(8))
    links = "<div>" + "".join(f'<a href="{i}">link {i}</a> ' for i in range(9)) + "</div>"
    text = main_text(PAGE % f'<div id="wrap">{links}<div class="body">{paragraphs}</div></div>')
    assert text.split("\n") == [f"Sentence {i}, with some words in it. And another one; longer." for i in range(8)]


def test_unmarked_page_with_unnamed_parts():
    body = "".join(f"<p>Here is paragraph {i}, which says a little. It goes on; and on.</p>" for i in range(6))
    page = f"""<body><div><div>Log in, or register now.</div></div><div><div><h2>Heading</h2>{body}</div>
    <div class="commentlist"><p>Great, thanks. Really!</p></div></div><div>All rights, reserved.</div></body>"""
    lines = main_text(page).split("\n")
    assert lines[0] == "Heading" and len(lines) == 7


def test_marks_are_weighed_by_path_scores():
    body = "".join(f"<p>Here is paragraph {i}, which says a little. It goes on; and on.</p>" for i in range(9))
    cards = '<article class="card"><h3>Next</h3><p>A short story, in a card.</p></article>' * 3
    assert main_text(f"<body><div><div>{body}</div><div>{cards}</div></div></body>").count("goes on") == 9
    links = "<ul>" + "".join(f'<li><a href="{i}">link {i}</a></li>' for i in range(9)) + "</ul>"
    assert main_text(f"<body><main>{links}{body}</main><p>Beside.</p></body>").count("\n") == 8
    assert main_text(f"<body><main><div>{body}</div>{cards}</main></body>").count("goes on") == 9


def test_names_take_out_no_whole_article():
    for name in ("category-social", "tag-cookies", "tag-advertising", "category-sharing", "social"):
        assert main_text(PAGE % f'<article class="post {name}">{ARTICLE}</article>') == TEXT
    body = "".join(f"<p>Here is paragraph {i}, which says a little. It goes on.</p>" for i in range(6))
    column = f'<div class="column">{body}</div><div class="sidebar"><p>Something else, beside it.</p></div>'
    comments = '<div id="comments">' + '<div class="comment"><p>I liked it, really; thank you.</p></div>' * 20 + "</div>"
    for page in (
        PAGE % f'<div class="content-sidebar-wrap">{column}</div>',
        PAGE % f'<div class="content-sidebar-wrap"><main>{column}</main></div>',
        f'<body><form id="f" action="/"><input>{column}{comments}</form></body>',
        f'<body><form id="f"><div class="content-sidebar-wrap">{column}</div>{comments}</form></body>',
    ):
        lines = main_text(page).split("\n")
        assert len(lines) == 6 and lines[0].startswith("Here is paragraph 0")
    cards = '<div class="related">' + '<article class="card"><p>Another story, in short.</p></article>' * 3 + "</div>"
    assert main_text(f"<body><div>{body}</div>{cards}</body>").count("\n") == 5
    assert main_text(f'<body><div>{body}</div><div style="display:none">{body * 3}</div></body>').count("\n") == 5


def test_article_in_unequal_siblings():
    long = "<p>" + "A long paragraph, with marks. " * 70 + "</p>"
    short = "".join(f"<p>Part {i} of the second section, which is short. It ends.</p>" for i in range(10))
    page = "<body><div>Log in.</div><div><section><h2>One</h2>%s</section><section><h2>Two</h2>%s</section></div></body>"
    assert len(main_text(page % (long, short)).split("\n")) == 13
    assert len(main_text(page % (short, long)).split("\n")) == 13
    lead = "The lead lies in a division of its own, before the body."
    lines = main_text(f"<body><div><div>{lead}</div><div>{long}{short}</div></div></body>").split("\n")
    assert lines[0] == lead and len(lines) == 12


def test_one_long_paragraph_among_short_ones():
    page = "<body><div><p>Short, first.</p><p>" + "Long text, with marks. " * 90 + "</p><p>Short, last.</p></div></body>"
    assert main_text(page).count("\n") == 2


def test_scores_prefer_sentences():
    page = Page("<div><p>Many words, and marks. Really, many.</p><h5>x</h5></div>")
    scores = {path.labels(): s for path, s in path_scores([(b, said(b)) for b in page.blocks]).items()}
    assert scores[("div", "p")] > scores[("div", "h5")]


def shared_words(a, b):
    """F1 of the words of two texts."""
    a, b = Counter(a.split()), Counter(b.split())
    return 2 * sum((a & b).values()) / max(1, a.total() + b.total())


def test_pages_without_marks_and_names_by_their_paths_alone(monkeypatch):
    """No article element, no telling class: the path scores decide, and equal scores do worse."""
    pages = pq.read_table("/root/testdata/sf0.01/pages.parquet")["html"].to_pylist()
    expected = [main_text(page) for page in pages]
    plain = [
        page.replace("<article>", '<div class="x2">').replace("</article>", "</div>").replace('class="ad"', 'class="x1"')
        for page in pages
    ]
    found = [main_text(page) for page in plain]
    assert sum(a == b for a, b in zip(expected, found)) > 0.9 * len(pages)
    assert sum(map(shared_words, expected, found)) / len(pages) > 0.98
    monkeypatch.setattr(html_text, "path_scores", lambda blocks: {b.element.path: 1.0 for b, _ in blocks})
    alike = [main_text(page) for page in plain]
    assert sum(a == b for a, b in zip(expected, alike)) < 0.1 * len(pages)
    assert sum(map(shared_words, expected, alike)) < sum(map(shared_words, expected, found))


@pytest.mark.parametrize(
    "page",
    ["<div>word " * 50_000, "<b>" * 50_000 + "x", "<i><div>" + "<b>" * 50_000 + "</i>" * 50_000, "<p>x</q>" * 50_000,
     "<div>" * 50_000 + "</p>" * 50_000, "<ul><li>a" * 30_000, '<div class="a">t ' * 50_000, "<table><tr><td>x" * 20_000,
     "<a href='x" * 50_000, "</div>" * 50_000, "<article>t<nav>" * 20_000],
)
def test_unclosed_elements_take_linear_time(page):
    begun = time.process_time()
    main_text(page)
    half = time.process_time() - begun
    assert half < 3, half


def test_broken_and_odd_pages():
    for html in ("", "   ", "<", "<p", "</p></div>", "<!--", "<script>x", "<article>", "a < b", "<p title='x>y"):
        assert isinstance(main_text(html), str)
    assert main_text("plain words only") == "plain words only"
    assert main_text("<article><p>a<p>b</article>") == "a\nb"
    assert main_text("<article><p>x <b>y<br>z</p></article>") == "x y\nz"
    assert main_text("<article><p hidden>no</p><p style='display: none'>no</p><p>yes, it is.</p></article>") == "yes, it is."
    assert main_text("<article>" + "<div>" * 3000 + "deep, text." + "</div>" * 3000 + "</article>") == "deep, text."
    assert main_text("<article><p>" + "word, " * 100_000 + "</p></article>") == ("word, " * 100_000).strip()
    rng = random.Random(1)
    bits = ["<p>", "</p>", "<div class=ad>", "</div>", "<b", ">", "x", "&amp", "&#0;", "&#x110000;", "<li>", "</ul>", '="', "'"]
    for _ in range(200):
        main_text("".join(rng.choice(bits) for _ in range(60)))


def test_table(spark):
    rows = [(1, "u", PAGE % f"<article>{ARTICLE}</article>", "t"), (None, None, None, None), (1, "u", "", "t")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = sorted((r.page_id or 0, r.url or "", r.text, r.n_chars) for r in extract(pages).collect())
    assert got == [(0, "", "", 0), (1, "u", "", 0), (1, "u", TEXT, len(TEXT))]
    assert extract(pages.limit(0)).collect() == []
