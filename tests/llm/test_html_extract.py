import html
import itertools
import re

import numpy as np
import pyarrow.parquet as pq
import pytest

from llm_helpers import SF_SMALL
from recengine.llm import html_extract as h

LONG = "This is a long paragraph of plain prose that goes on for quite a number of words, as articles do, until it stops."
LONG2 = "Another paragraph follows the first one, and it too has enough words to look like prose to any reader of it."


def pages(spark, sources):
    return spark.createDataFrame([(i, f"http://x/{i}", s) for i, s in enumerate(sources)], "page_id long, url string, html string")


def test_whole_table(spark):
    rows = {r["page_id"]: r["html"] for r in pq.read_table(f"{SF_SMALL}/pages.parquet").to_pylist()}
    got = h.op9_html_extract(spark, SF_SMALL).collect()
    assert len(got) == len(rows)
    for r in got:
        article = re.search("<article>(.*?)</article>", rows[r.page_id], re.S)[1]
        blocks = (" ".join(html.unescape(re.sub("<[^>]*>", " ", b)).split()) for b in re.split("</?(?:h1|p)>", article))
        assert r.text == "\n\n".join(b for b in blocks if b) and r.n_chars == len(r.text)


CASES = [
    (None, ""), ("", ""), ("   ", ""), ("<", "<"), (f"{LONG} No markup at all.", f"{LONG} No markup at all."), ("<html><body></body></html>", ""),
    (f"<body><nav><ul><li><a href=x>Home</a><li><a href=y>About us</a></ul></nav><div id=content><h1>Title</h1><p>{LONG}<p>{LONG2}</div>"
     f"<footer><p>&copy; 2020 Someone. {LONG}</p></footer>", f"Title\n\n{LONG}\n\n{LONG2}"),
    (f"<main><article><h2>A &amp; B &lt;c&gt;</h2><p>{LONG}</p><div class='ad'>{LONG2}</div><p>x  y\n z&nbsp;.</p><aside>{LONG2}</aside></article>"
     f"<section id=comments><h3>Comments</h3><div><p>{LONG2}</p></div></section></main>", f"A & B <c>\n\n{LONG}\n\nx y z ."),
    (f"<body><header><h1>Site name</h1><p>Our motto is this.</p></header><article><p>{LONG}</article><div class='cookie-notice'><p>{LONG2}</p></div>"
     f"<form><p>{LONG2}</p><input><button>Send</button></form>", LONG),
    (f"<article><script>var a = '</p><p>{LONG}';</script><style>p {{}}</style><!-- <p>{LONG2}</p> --><p title='a>b'>{LONG}</p>"
     f"<noscript><p>no</p></noscript><p hidden>{LONG2}</p></article>", LONG),
    (f"<ARTICLE><P>{LONG}<BR>{LONG2}</P><UL><LI>One thing to know.<LI>Two things to know.</UL></ARTICLE>",
     f"{LONG} {LONG2}\n\nOne thing to know.\n\nTwo things to know."),
    (f"<article><p>{LONG}</p><div class=comments><p>{LONG2}</p></div><p>The last one is here.</p></article>", f"{LONG}\n\nThe last one is here."),
    (f"<body class='has-sidebar'><div class='page with-comments'><div class=sidebar><p>{LONG2}</p></div><article><p>{LONG}</p></article>"
     f"<div class=comments>" + f"<article class=comment><p>{LONG2}</p></article>" * 30 + "</div></div>", LONG),
    (f"<body><div><p>{LONG}</p><p>{LONG2}</p></div><div><a href=1>One</a> <a href=2>Two</a> <a href=3>Three</a></div><footer>"
     + f"<p>{LONG}</p>" * 20 + "</footer>", f"{LONG}\n\n{LONG2}"),
    (f"<div><div><p>{LONG}</p><p>{LONG2}</p></div></div>", f"{LONG}\n\n{LONG2}"),
    # text of formulas, buttons and drawings; form fields hold none
    (f"<article><p>{LONG}</p><p>Let <math><mi>x</mi><annotation>\\\\x</annotation></math> be a number.</p><p>Then press <button>OK</button> now.</p>"
     f"<p>See <svg><text>figure</text></svg> here.</p><p>Pick <select><option>none</option></select>one.</p></article>",
     f"{LONG}\n\nLet x be a number.\n\nThen press OK now.\n\nSee figure here.\n\nPick one."),
    # anchors, and words that are only a part of a name or vague, don't decide
    (f"<body><nav><a href=x>Home</a></nav><article><h2 id=search-options>Search options</h2><section id=discussion><p>{LONG}</p><p>{LONG2}</p></section>"
     f"<div class=more><p>{LONG}</p></div><p class=notice-period>{LONG2}</p><p>{LONG}</p></article></body>",
     f"Search options\n\n{LONG}\n\n{LONG2}\n\n{LONG}\n\n{LONG2}\n\n{LONG}"),
    # hidden inline elements end with their own end tag
    (f"<article><p>{LONG} <span hidden>x <span>y</span> z</span><i>It goes on.</i></p></article>", f"{LONG} It goes on."),
]


def test_layouts(spark):
    got = {r.page_id: r for r in h.extract(pages(spark, [c[0] for c in CASES] * 2).selectExpr("*", "'x' as text", "1 as n")).collect()}
    for i, (source, want) in enumerate(CASES * 2):
        assert got[i].text == want, source
        assert got[i].n_chars == len(want)


def test_training_takes_labelled_pages_and_counts_copies(spark):
    one = f"<body><article><p>{LONG}</p></article><nav>x</nav></body>"
    rows = pages(spark, [one] * 300 + [f"<div>{LONG}</div>"] * 700)
    root = lambda m: float(np.exp(m.logs[m.place["tag", "nav"], h.OTHER]))
    few, all_ = h.learn(rows, 60), h.learn(rows, 1000)
    plain = h.TreeModel({}, np.zeros((3, 3)), np.zeros(3))
    assert root(plain) != root(few) != root(all_)  # copies are sampled one by one: neither none nor all of them


def test_empty_table_and_long_page(spark):
    assert h.extract(pages(spark, [])).collect() == []
    long = "<article>" + f"<p>{LONG}</p>" * 20000 + "<div>" * 3000 + "</article>" + "<b" * 2000
    got = h.extract(pages(spark, [long, long])).collect()
    assert [r.text for r in got] == ["\n\n".join([LONG] * 20000)] * 2


def test_marginals_equal_enumeration():
    source = f"<div><nav>x</nav><p>{LONG}</p></div>"
    page = h.Page(source)
    model = h.TreeModel({}, np.zeros((3, 3)), np.zeros(3))
    n, total, content = len(page.parent), 0.0, np.zeros(len(page.parent))
    none = len(model.logs) - 1
    for states in itertools.product(range(5), repeat=n):
        if any(t is not None and s in (h.FRAME, h.MARKED) for t, s in zip(page.text, states)):
            continue
        w = 0.0
        for i, s in enumerate(states):
            w += sum(model.logs[model.place.get(f, none), s] for f in page.features[i])
            w += model.root[s] if page.parent[i] < 0 else model.edges[states[page.parent[i]], s]
        total += np.exp(w)
        content += np.exp(w) * (np.array(states) == h.CONTENT)
    assert np.allclose(model.content([page, page])[1], content / total, rtol=1e-9)


def test_labels_follow_the_markup():
    page = h.Page("<body><nav>x</nav><article><p>a</p><aside><p>b</p></aside></article></body>")
    state = dict(zip([t for t in page.text if t], [s for s, t in zip(page.labels(), page.text) if t]))
    assert state == {"x": h.OTHER, "a": h.CONTENT, "b": h.OTHER}
    assert h.Page("<article>a</article><article>b</article>").labels() is None and h.Page("<p>x").labels() is None


@pytest.mark.parametrize("seed", range(3))
def test_any_markup_is_parsed(seed):
    rng = np.random.default_rng(seed)
    parts = ["<p>", "</p>", "<div", " class='", "'>", ">", "</div>", "<script>", "</script>", "<!--", "-->", "a b", "&amp;", "&", "<", "</", "<li>",
             "<table>", "<td>", "</table>", "<a href=x>", "</a>", "<![CDATA[", "]]>", "\"", "<br/>", "<svg>", "</svg>", "İ", "</body>", "<html>"]
    for _ in range(400):
        page = h.Page("".join(rng.choice(parts, rng.integers(1, 40))))
        assert all(p < i for i, p in enumerate(page.parent))
