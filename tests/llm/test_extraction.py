"""Main text of pages: what recurs on a host goes, copies and shared passages stay; the reader against odd markup."""

import random

from hypothesis import given, settings
from hypothesis import strategies as st

from tidewire.llm import extraction

from .conftest import prose

SCHEMA = "page_id bigint, url string, html string, host string, blocks int, node string"


def texts(spark, rows):
    df = spark.createDataFrame([(i, u, h, "x", 1, "y") for i, u, h in rows], SCHEMA).repartition(3)
    return {r.page_id: r for r in extraction.extract(df).collect()}


def said(source):
    return extraction.Page(source).parts()[1]


def test_unmarked_templates_go_by_recurrence(spark):
    menu, foot = "<div><a href=/a>News</a> <a href=/b>Sport</a></div>", "<div><p>All rights <b>reserved</b></p><p>Imprint</p></div>"
    body = {i: [prose(900 + i, 30), prose(950 + i, 25)] for i in range(8)}
    page = lambda i, extra="": f"<html><title>t{i}</title><body>{menu}<div><h1>Head {i}</h1>{extra}" + "".join(f"<p>{b}</p>" for b in body[i]) + f"</div>{foot}</body>"
    own = lambda i: "\n\n".join([f"Head {i}", *body[i]])
    rows = [(i, f"https://www.a.example/{i}", page(i)) for i in range(8)]
    # Copies of one page are one article: their text is no template. A host of two articles shows no recurrence.
    rows += [(100 + i, f"http://b.example/{i}", page(i % 2)) for i in range(6)]
    rows += [(200 + i, None if i % 2 else "no url", page(i)) for i in range(6)]
    # A passage of two articles in eight stays; one of all of them goes.
    rows += [(300 + i, f"http://c.example/{i}", page(i, "<p>Often said.</p>" + ("<p>Twice said.</p>" if i < 2 else ""))) for i in range(8)]
    got = texts(spark, rows)
    assert len(got) == len(rows)
    for i in range(8):
        assert got[i].text == own(i) and got[i].n_template == 3 and got[i].n_chars == len(own(i)) and got[i].n_blocks == 3
        assert got[300 + i].text == own(i).replace(f"Head {i}", f"Head {i}\n\nTwice said." if i < 2 else f"Head {i}")
    whole = lambda i: "\n\n".join(["News Sport", own(i), "All rights reserved", "Imprint"])
    assert all(got[100 + i].text == whole(i % 2) for i in range(6)) and all(got[200 + i].text == whole(i) for i in range(6))


def test_elements_that_say_what_they_are():
    source = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body class="ad menu">
      <header><h1>Site</h1></header><nav><ul><li>Menu</ul></nav><!-- <p>no</p> --><div class="cookie-notice">Cookies</div>
      <article class="post"><header><h2>Head &amp; line</h2>By me</header><p>One <b>bold<br>word</b> &lt;x&gt; &copy; &#x41; caf&eacute;&nbsp;&nbsp;.<p>Two <span class="share">Share</span> parts
      <form>Mail <input> <button>Go</button></form><aside>More</aside><div id="userComments"><article class="comment"><p>Nice</p></article></div>
      <ul><li>a<li>b <p>c</ul><table><tr><td>d<td>e</table><div hidden>h</div><div style="display: none">i</div></article>
      <div>outside</div><footer>F</footer>"""
    assert said(source) == ["Head & line", "One bold word <x> © A café .", "Two parts", "a", "b", "c", "d", "e"]
    # Most of the text and the heading: the name doesn't count.
    assert said(f'<body><form class="sidebar"><h1>H</h1><p>{"word " * 30}</p></form><div role=navigation>m</div>') == ["H", ("word " * 30).strip()]
    # A heading outside the article is the article's if that has none.
    assert said("<body><h1>H</h1><div>x</div><main><p>t</p></main>") == ["H", "t"]


def test_odd_markup():
    assert said("") == [] and said("<p>") == [] and said("plain &amp; text") == ["plain & text"]
    assert said("<p>a < b and <3 c</p><p>cut <a href='x") == ["a < b and <3 c", "cut"]
    assert said("<p>one<script>alert('<p>no')</script> two</p><script>never closed <p>x</p>") == ["one two"]
    assert said("<textarea>no end<p>kept</p>") == ["no end", "kept"]
    assert said('<p>a<img alt="x>y">b</p><p title="unclosed>c</p><p>d</p>') == ["ab", "c", "d"]
    assert said("<p>a</p></div></p></section>b<br/>c<hr>d") == ["a", "b c", "d"]
    deep = said("<div>" * 3000 + "<p>in</p>" + "</div>" * 3000 + "<p>after</p>")
    assert deep == ["in", "after"]


@settings(max_examples=200, deadline=None)
@given(st.text(st.sampled_from(list("<>/\"'=&;!- apdivlist")), max_size=80))
def test_any_input_is_read(source):
    page = extraction.Page(source)
    name, kept, nodes, gone = page.parts()
    assert len(kept) + gone == len(page.blocks) and all(0 <= a < b <= max(len(kept), b if k == 2 else 0) for _, a, b, k in nodes)


def test_reading_is_linear():
    import time

    for piece in ("<a '\">", "<p class=\"x", "<div><li>", "<!-- ", "<textarea>", "<p>a&amp;b</p>", "<", "</div>"):
        began = time.time()
        said(piece * (600_000 // len(piece)))
        assert time.time() - began < 12, piece


def test_nulls_repeats_long_pages_and_none(spark):
    long = "<article><h1>L</h1>" + "".join(f"<p>{random.Random(i).random()}</p>" for i in range(20_000)) + "</article>"
    same = (7, "http://h.example/x", "<nav>m</nav><article><p>t</p></article>")
    rows = [(1, "http://h.example/1", None), (2, "http://h.example/2", ""), (None, None, "<p>t</p>"), (3, "http://h.example/3", long), same, same]
    df = spark.createDataFrame([(i, u, h, "x", 1, "y") for i, u, h in rows], SCHEMA)
    got = extraction.extract(df).collect()
    assert sorted(((r.page_id or -1, r.text) for r in got if r.page_id != 3)) == [(-1, "t"), (1, ""), (2, ""), (7, "t"), (7, "t")]
    assert next(r for r in got if r.page_id == 3).n_blocks == 20_001
    assert extraction.extract(spark.createDataFrame([], SCHEMA)).count() == 0
