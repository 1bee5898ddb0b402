"""Wrappers of pages: what is inferred, and the text they extract, on pages with known articles."""

from __future__ import annotations

import html
import json
import re

import pytest

from somnolake.llm.queries import QUERIES
from somnolake.llm.shipping import ship
from somnolake.llm.wrappers import _absorb, _rules, expression, extracted, folded, host_wrappers, main_text, page_tree, rules_of

SCHEMA = "page_id long, url string, html string, text string, host string, wrapper string, pages int"


def page(i, paragraphs, before="", after="", inside=""):
    body = "".join(f"<p>{p}</p>" for p in paragraphs)
    return (
        f'<!DOCTYPE html><html lang="en"><head><title>T{i}</title><style>p{{}}</style><script>var t="</p><p>no</p>";</script></head>'
        f'<body class="has-sidebar"><header><h2>Site</h2></header><nav><ul>{"".join(f"<li><a href=/{k}>n{k}</a></li>" for k in range(i % 4 + 1))}</ul></nav>'
        f'{before}<article><header><h1>Title {i}</h1></header>{body}{inside}</article>{after}<footer>&copy; {i}</footer></body></html>'
    )


def text_of(*lines):
    return "\n".join(lines)


CASES = [
    # (host, html, text)
    ("a.org", page(1, ["one", "two  \n words"]), text_of("Title 1", "one", "two words")),
    ("a.org", page(2, ["x &lt;y&gt; &amp;amp; &eacute;"], before='<div class="ad">buy</div>'), text_of("Title 2", "x <y> &amp; é")),
    ("a.org", page(3, ["a<b>b</b>c", "<i>d</i> e"], after='<aside>side</aside><div id="comments"><p>nice</p></div>'), text_of("Title 3", "abc", "d e")),
    ("a.org", page(4, ["p", "q"], inside='<div class="share-buttons">share</div><section class="comment-list"><p>me too</p></section>'), text_of("Title 4", "p", "q")),
    ("a.org", page(5, ["<b>open<br><p>closed", "r"], before='<div class="cookie-banner"><form><p>ok?</p></form></div>'), text_of("Title 5", "open", "closed", "r")),
    ("a.org", page(6, ["cut off here"])[:-52], None),
    ("b.org", '<div class="menu"><a href="/">home</a></div><div class="content"><h2>H</h2><p>text</p></div><div class="sidebar">s</div>', text_of("H", "text")),
    ("b.org", '<div class="menu"><a href="/">home</a></div><div class="content"><h2>I</h2><p>more</p><ul><li>1<li>2</ul></div>', text_of("I", "more", "1", "2")),
    ("c.org", "<main><h1>M</h1><dl><dt>a<dd>b<dt>c<dd>d</dl><table><tr><td>1<td>2<tr><td>3</table></main><p>outside", text_of("M", "a", "b", "c", "d", "1", "2", "3")),
    ("d.org", "plain text\n\nwithout  markup 1 < 2 &copy 2020", "plain text without markup 1 < 2 © 2020"),
    ("e.org", None, ""), ("e.org", "", ""), ("e.org", "<", "<"), ("e.org", "<p", ""), ("e.org", "<!-- all -->", ""),
    ("f.org", "<article>" + "<div>" * 3000 + "deep" + "</div>" * 3000 + "<p>end</p></article>", text_of("deep", "end")),
    ("g.org", '<article class="post"><p>kept</p><article class="comment"><p>not kept</p></article></article>', "kept"),
    ("h.org", '<article><p title="a>b">kept</p><p>also</p></article>', text_of("kept", "also")),
]


@pytest.fixture(scope="module")
def pages(spark):
    rows = [(i, f"https://{host}/p/{i}?q=1#top", text, "x", "y", "z", 1) for i, (host, text, _) in enumerate(CASES)]
    rows += [(100, None, "<article><p>no address</p></article>", "x", "y", "z", 1), (None, "no host", page(7, ["n"]), None, None, None, None)]
    return ship(spark).createDataFrame(rows, SCHEMA).repartition(5)


def test_articles_are_extracted(pages):
    found = {r["page_id"]: r for r in extracted(pages).collect()}
    assert len(found) == len(CASES) + 2
    for i, (_, _, want) in enumerate(CASES):
        assert want is None or found[i]["text"] == want, (i, found[i])
        assert found[i]["n_chars"] == len(found[i]["text"])
    assert found[100]["text"] == "no address" and found[None]["text"] == "Title 7\nn"
    assert found[5]["text"].startswith("Title 6\ncut off here")


def test_repeated_rows_and_no_rows(pages, spark):
    twice = pages.unionByName(pages)
    assert sorted(map(repr, extracted(twice).collect())) == sorted(2 * list(map(repr, extracted(pages).collect())))
    assert extracted(pages.where("false")).count() == 0


def test_expression_has_repeats_options_and_slots():
    one, two = (folded(page_tree(x)) for x in ("<ul><li>a<li>b</ul><p>same<p>x", "<ul><li>c</ul><div>d</div><p>same<p>y<p>z"))
    _absorb(one, two)
    assert expression(one) == "<ul> (<li> # </>)+ </> (<div> \"d\" </>)? (<p> # </>)+"
    three = folded(page_tree("<h1>t</h1>" + "<h2>a</h2><p>b</p>" * 3))
    assert expression(three) == '<h1> "t" </> (<h2> "a" </> <p> "b" </>)+'
    _absorb(three, folded(page_tree("<h1>u</h1><h2>c</h2><p>d</p>")))
    assert expression(three) == "<h1> # </> (<h2> # </> <p> # </>)+"


def test_wrapper_does_not_depend_on_the_parts(pages, spark):
    """However pages are dealt to tasks, slots get the same verdicts."""
    one, many = ({r["page_id"]: r["text"] for r in extracted(pages.repartition(n)).collect()} for n in (1, 7))
    assert one == many


def test_one_wrapper_a_host(pages):
    from somnolake.llm.wrappers import host_of

    found = host_wrappers(pages.select("html", host_of("url").alias("host"))).collect()
    hosts = [r["host"] for r in found]
    assert sorted(hosts) == sorted({h for h, _, _ in CASES} | {""})
    assert {r["host"]: r["pages"] for r in found}["a.org"] == 6


def test_every_page_alone_has_its_text_by_its_own_wrapper():
    for _, text, want in CASES:
        tree = folded(page_tree(text or ""))
        rules = _rules(json.loads(rules_of(tree)))
        assert want is None or main_text(folded(page_tree(text or "")), rules) == want


def by_hand(page):
    """For pages of h1 and p in one article: what stands between its tags."""
    inner = re.search(r"<article>(.*?)(?:</article>|$)", page or "", re.S)
    blocks = re.split(r"</?(?:h1|p)>", inner[1]) if inner else []
    lines = [" ".join(html.unescape(re.sub(r"</?(?:b|br)>", " ", b)).split()) for b in blocks]
    return "\n".join(line for line in lines if line)


def test_query_on_a_whole_table(spark, small):
    import duckdb

    pages = dict(duckdb.sql(f"SELECT page_id, html FROM '{small}/pages.parquet'").fetchall())
    found = {r["page_id"]: r["text"] for r in QUERIES["op11_html_text"](spark, small).collect()}
    assert found == {i: by_hand(p) for i, p in pages.items()}
