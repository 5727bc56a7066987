"""HTML extraction (operator 9): sum-product message passing over the DOM tree.

A page becomes a tree of elements with its runs of text (blocks) as leaves. Every node has one of five states:
  frame    a container around parts of any kind (never a block)
  content  the article
  other    menus, headers, footers, sidebars, notices, adverts
  marked   an element that its markup names as none of the article (forms, reader comments, adverts, ...)
  inside   anything inside a marked element
Node potentials are P(feature | state) of its tag, of hints in its class, id and role, and for a block of its length, share of
linked words, last character and kind of element; edge potentials are P(state | state of the parent). Only
elements with a naming tag or a strong hint can be marked. A hint is strong where a whole class, role or id names the element by words that leave no
doubt, other than the id of a heading or paragraph (an anchor); other matches are weak: a feature with mild potentials, which prose outweighs. Inside, an element's potential is the greater of content's and other's, and a
block's is content's: prose there is no evidence that the part belongs to the article. Messages pass from
the leaves to the root and back, which gives every block's exact marginal; blocks with P(content) >= 1/2 are kept.

The potentials are counted on labelled pages and smoothed with the prior counts below. Labelled pages are those whose markup says what is
the article (one outermost article or main element, or role main): what lies inside is content, apart from subtrees
with a strong hint of another kind; its ancestors are frame; the rest is other. At most MAX_TRAIN_PAGES pages with such markup are learned from, picked
by a hash of page_id, url and html; every page is parsed and labelled by the model alone, whole.

Scripts, styles, comments, head, form fields and similar elements hold no text; formulas, drawings, buttons and embedded objects hold theirs, as inline
elements. Character references are decoded, white space in a block
becomes one blank, blocks are joined by an empty line in page order. br is white space. Open elements are closed as browsers do in
the usual cases (p before a block, li, table cells, end of page). Null or empty html, and pages without content, give ''.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recengine.llm.common import batches_of, table

MAX_TRAIN_PAGES = 2000
FRAME, CONTENT, OTHER, MARKED, INSIDE = range(5)

#: Element kinds of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SILENT = frozenset("script style head title noscript template iframe select datalist textarea annotation annotation-xml".split())
RAW = frozenset("script style title textarea noscript iframe template".split())
BLOCK = frozenset("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form "
                  "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre section summary table "
                  "tbody td tfoot th thead tr ul caption".split())
#: A start tag closes these open elements, up to the nearest element that holds them.
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"),
          "tbody": ("tbody", "thead", "tfoot", "tr", "td", "th"), "tfoot": ("tbody", "thead", "tfoot", "tr", "td", "th"),
          "body": ("head",), "option": ("option",)}
HOLDS = frozenset("ul ol menu dl table html body div section article main aside nav form td th".split())

#: Words in class, id or role that hint at the kind of an element.
HINTS = {
    OTHER: frozenset("nav navbar navigation menu breadcrumb breadcrumbs header masthead banner footer sidebar aside ad ads advert adverts "
                     "advertisement sponsor sponsored promo promoted promotion cookie cookies consent gdpr notice alert popup modal overlay "
                     "share sharing social comment comments reply replies respond discussion disqus related recommended more newsletter "
                     "subscribe subscription signup login search form widget pagination pager toolbar copyright legal disclaimer tags "
                     "contentinfo complementary dialog hidden skip teaser trending popular feedback rating contact author-box".split()),
    CONTENT: frozenset("article content post entry story main body text maincontent articlebody page-content".split()),
}

#: Words that alone are no more than a weak hint, and words beside a hint that leave it whole.
VAGUE = frozenset("more discussion search tags rating legal form alert notice skip share popular feedback contact promotion trending text body".split())
BESIDE = frozenset("box wrapper wrap container section block list area inner outer bar item items site page top bottom left right main global primary "
                   "secondary widget widgets links link panel module group holder div row col column".split())
#: Elements whose id is an anchor.
ANCHORED = frozenset("h1 h2 h3 h4 h5 h6 p li dt dd a".split())

#: Prior counts (frame, content, other) of each feature's values; unlisted values start from (1, 1, 1).
PRIOR = {
    ("tag", "article"): (0.1, 60, 0.02), ("tag", "main"): (40, 40, 1), ("tag", "nav"): (0.02, 0.02, 200), ("tag", "footer"): (0.02, 0.02, 200),
    ("tag", "aside"): (0.02, 0.02, 200), ("tag", "form"): (0.1, 0.02, 200), ("tag", "header"): (0.5, 1, 60), ("tag", "dialog"): (0.02, 0.02, 100),
    ("tag", "menu"): (0.02, 0.02, 100), ("tag", "html"): (100, 0.1, 0.1), ("tag", "body"): (100, 0.1, 0.1), ("tag", "hidden"): (0.01, 0.01, 200),
    ("tag", "p"): (0.1, 60, 20), ("tag", "div"): (60, 40, 60), ("tag", "section"): (30, 40, 30), ("tag", "text"): (0.01, 60, 60),
    ("tag", "inline"): (1, 60, 60), ("tag", "list"): (5, 30, 60), ("tag", "heading"): (0.1, 40, 20), ("tag", "table"): (10, 30, 20),
    ("hint", "other"): (0.5, 0.02, 300), ("hint", "content"): (30, 100, 0.5), ("hint", "both"): (5, 5, 30),
    ("marked", True): (1, 1, 1), ("weak", True): (10, 20, 60),
    ("words", 0): (1, 6, 30), ("words", 1): (1, 15, 30), ("words", 2): (1, 30, 20), ("words", 3): (1, 40, 8),
    ("links", 0): (1, 90, 40), ("links", 1): (1, 12, 8), ("links", 2): (1, 4, 60),
    ("end", "stop"): (1, 70, 25), ("end", "none"): (1, 30, 70),
}
#: Prior counts of a child's state by its parent's, and of the root's.
PRIOR_EDGES = ((60, 10, 30), (0.01, 500, 5), (0.001, 0.001, 500))
PRIOR_ROOT = (20, 1, 1)
#: Potentials of the edges into the marked state, from frame, content and other, and of the root.
INTO_MARKED, ROOT_MARKED = (0.3, 0.01, 0.01), 0.001
NEVER = 1e-12
#: Tags that name a part; header does outside of articles.
MARKING = frozenset("nav footer aside form dialog menu".split())

# possessive, so that a match is tried in linear time
_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+(?:>|\Z)"
                  r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>", re.S)
_ATTRIBUTE = re.compile(r"(?:^|\s)(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?", re.I)
_RAW_END = {tag: re.compile(rf"</{tag}(?=[\s/>])", re.I) for tag in RAW}
_HINT_WORD = re.compile(r"[a-z]+")
#: A class with one of these words says what a container has or lacks, not what it is.
_ABOUT = frozenset("with has have no not without show hide enable enabled disable disabled is".split())


def tag_kind(tag: str) -> str:
    if re.fullmatch("h[1-6]|hgroup", tag):
        return "heading"
    if tag in ("ul", "ol", "dl", "li", "dt", "dd"):
        return "list"
    if tag in ("table", "tbody", "thead", "tfoot", "tr", "td", "th", "caption"):
        return "table"
    known = ("article", "main", "nav", "footer", "aside", "form", "header", "dialog", "menu", "html", "body", "p", "div", "section")
    return tag if tag in known else "block" if tag in BLOCK else "inline"


def token_hints(token: str, anchor: bool) -> tuple[set[int], bool]:
    """(states that a token of class, id or role hints at, whether the hint at other is weak)."""
    parts = _HINT_WORD.findall(token)
    words = {token, *parts}
    if words & _ABOUT:
        return set(), False
    found = {state for state, known in HINTS.items() if words & known}
    whole = token in HINTS[OTHER] - VAGUE or any(p in HINTS[OTHER] - VAGUE for p in parts) and all(
        p in HINTS[OTHER] or p in BESIDE for p in parts)
    return found, OTHER in found and (anchor or not whole)


def hint_of(tag: str, attributes: str) -> tuple[str | None, bool, bool, bool]:
    """(hint, weak hint at other, hidden, says that it is the main part) of an element."""
    found, weak, hidden, main = set(), False, False, tag in ("article", "main")
    for name, value in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), value.strip("\"'").lower()
        if name == "hidden" or name == "aria-hidden" and value == "true" or name == "style" and "display:none" in value.replace(" ", ""):
            hidden = True
        elif name in ("class", "id", "role"):
            main |= name == "role" and value in ("main", "article")
            anchor = name == "id" and tag in ANCHORED
            for token in value.split():
                states, slight = token_hints(token, anchor)
                weak |= slight
                found |= states - {OTHER} if slight else states
    hint = None if not found else "both" if len(found) > 1 else "content" if CONTENT in found else "other"
    return hint, weak and OTHER not in found, hidden, main


class Page:
    """The nodes of a page: parents come before children; blocks carry their text."""

    def __init__(self, source: str | None):
        self.parent, self.features, self.text, self.main = [], [], [], []
        self.stack: list[tuple[str, int]] = []  # open elements: tag, node
        self.pieces: list[str] = []
        self.linked, self.links = 0, 0
        if source:
            self._parse(source)

    def _node(self, features: list[tuple[str, object]], text: str | None = None, main: bool = False) -> int:
        self.parent.append(self.stack[-1][1] if self.stack else -1)
        self.features.append(features)
        self.text.append(text)
        self.main.append(main)
        return len(self.parent) - 1

    def _flush(self) -> None:
        """Ends a block."""
        if not self.pieces:
            return
        words = html.unescape("".join(self.pieces)).split()
        self.pieces = []
        linked, self.linked = self.linked, 0
        if words:
            n = len(words)
            holder = next((t for t, _ in reversed(self.stack) if t in BLOCK), "body")
            share = 0 if linked == 0 else 1 if 2 * linked < n else 2
            size = 0 if n < 3 else 1 if n < 8 else 2 if n < 20 else 3
            end = "stop" if words[-1][-1] in ".!?…:;\"”»)" else "none"
            self._node([("tag", "text"), ("words", size), ("links", share), ("end", end), ("holder", tag_kind(holder))], " ".join(words))

    def _open(self, tag: str, attributes: str) -> None:
        if tag not in BLOCK:  # inline elements are no parts of a page
            self.stack.append((tag, self.stack[-1][1] if self.stack else self._node([("tag", "body")])))
            return
        self._flush()
        hint, weak, hidden, main = hint_of(tag, attributes) if attributes or tag in ("article", "main") else (None, False, False, False)
        features = [("tag", "hidden" if hidden else tag_kind(tag)), *([("hint", hint)] if hint else []), *([("weak", True)] if weak else [])]
        if hidden or hint == "other" or tag in MARKING or tag == "header" and not any(t in ("article", "main") for t, _ in self.stack):
            features.append(("marked", True))
        self.stack.append((tag, self._node(features, main=main)))

    def _close(self, names: tuple[str, ...], within: frozenset[str]) -> None:
        for i in range(len(self.stack) - 1, -1, -1):
            tag = self.stack[i][0]
            if tag in names:
                self._cut(i)
                return
            if tag in within:
                return

    def _cut(self, i: int) -> None:
        closed = self.stack[i:]
        if any(t in BLOCK for t, _ in closed):
            self._flush()
        self.links -= sum(t == "a" for t, _ in closed)
        del self.stack[i:]

    def _say(self, text: str) -> None:
        if text:
            self.pieces.append(text)
            if self.links:
                self.linked += len(text.split())

    def _parse(self, source: str) -> None:
        at, size, silent = 0, len(source), []
        last = max(source.rfind(">"), source.rfind("<!"))  # no tag ends beyond
        while at < size:
            m = _TAG.search(source, at) if at <= last else None
            if not m:
                if not silent:
                    self._say(source[at:])
                break
            if m.start() > at and not silent:
                self._say(source[at:m.start()])
            at = m.end()
            tag = m[2] or m[5]
            if tag is None:
                if m[0].startswith("<![CDATA[") and not silent:
                    self._say(html.escape(m[0][9:].removesuffix("]]>")))
                continue
            tag, closing, attributes = tag.lower(), m[1] or m[4], (m[3] or m[6] or "")
            if closing:
                if silent:
                    if tag in silent:  # the innermost of its name
                        del silent[len(silent) - 1 - silent[::-1].index(tag):]
                    continue
                if tag == "br":
                    self._say(" ")
                    continue
                for i in range(len(self.stack) - 1, -1, -1):
                    if self.stack[i][0] == tag:
                        self._cut(i)
                        break
                continue
            if tag in RAW or silent and tag in SILENT:
                if tag in RAW:
                    end = _RAW_END[tag].search(source, at)
                    at = size if not end else (source.find(">", end.start()) + 1 or size)
                elif not attributes.endswith("/"):
                    silent.append(tag)
                continue
            if silent:
                if tag == "body" and "head" in silent:
                    silent = []
                else:
                    if tag in silent and not attributes.endswith("/"):
                        silent.append(tag)
                    continue
            if tag in SILENT:
                if tag not in VOID and not attributes.endswith("/"):
                    silent.append(tag)
                continue
            if tag in VOID:
                if tag == "hr":
                    self._flush()
                elif tag == "br":
                    self._say(" ")
                continue
            if tag in BLOCK and tag not in ("html", "body"):
                self._close(("p",), HOLDS)
            if tag in CLOSES:
                self._close(CLOSES[tag], HOLDS - {"td", "th"} if tag in ("td", "th", "tr", "tbody", "tfoot") else HOLDS)
            if tag in ("html", "body") and any(t == tag for t, _ in self.stack):
                continue
            if tag not in BLOCK and attributes and hint_of(tag, attributes)[2]:
                silent.append(tag)  # a hidden inline element
                continue
            if tag == "a":
                self.links += 1
            self._open(tag, attributes)
        self._flush()
        # what holds the page's first article is named for something else that it has too
        first = next((i for i, m in enumerate(self.main) if m and ("hint", "other") not in self.features[i]), -1)
        while first >= 0 and (first := self.parent[first]) >= 0:
            self.features[first] = [f for f in self.features[first] if f not in (("hint", "other"), ("marked", True))]

    def labels(self) -> list[int] | None:
        """States by what the markup says, or None if it doesn't say."""
        inside = [False] * len(self.parent)
        tops = []
        for i, p in enumerate(self.parent):
            inside[i] = self.main[i] or p >= 0 and inside[p]
            if self.main[i] and not (p >= 0 and inside[p]):
                tops.append(i)
        if len(tops) != 1:
            return None
        state = [OTHER] * len(self.parent)
        for i, p in enumerate(self.parent):
            if inside[i]:
                kinds = dict(self.features[i])
                strange = i != tops[0] and (kinds.get("hint") == "other" or kinds["tag"] in ("nav", "footer", "aside", "form", "hidden", "dialog"))
                state[i] = OTHER if strange or i != tops[0] and state[p] == OTHER else CONTENT
        i = self.parent[tops[0]]
        while i >= 0:
            state[i] = FRAME
            i = self.parent[i]
        return state


class TreeModel:
    """Logarithms of the potentials; values never counted are as likely in every state."""

    def __init__(self, features: dict[tuple[str, object], np.ndarray], edges: np.ndarray, root: np.ndarray):
        for key, n in PRIOR.items():
            features[key] = features.get(key, np.zeros(3)) + np.array(n)
        total: dict[str, np.ndarray] = {}
        features = {k: n + (0 if k in PRIOR else 1) for k, n in features.items()}
        for (name, _), n in features.items():
            total[name] = total.get(name, np.zeros(3)) + n
        self.place = {k: i for i, k in enumerate(features)}
        logs = np.array([np.log(n / total[k[0]]) for k, n in features.items()] + [np.zeros(3)])
        inside = logs[:, [CONTENT, OTHER]].max(1)
        for (name, _), i in self.place.items():
            if name in ("words", "links", "end", "holder"):
                inside[i] = logs[i, CONTENT]
        self.logs = np.column_stack([logs, inside, inside])
        self.logs[self.place["marked", True]] = 0, 0, 0, -np.log(NEVER), 0
        edges = edges + np.array(PRIOR_EDGES)
        self.edges = np.full((5, 5), np.log(NEVER))
        self.edges[:3, :3] = np.log(edges / edges.sum(1, keepdims=True))
        self.edges[:3, MARKED] = np.log(INTO_MARKED) + np.log(NEVER)  # which the feature "marked" makes up for
        self.edges[[MARKED, INSIDE], INSIDE] = 0.0
        root = root + np.array(PRIOR_ROOT)
        self.root = np.array([*np.log(root / root.sum()), np.log(ROOT_MARKED * NEVER), -np.inf])

    def content(self, pages: list[Page]) -> list[np.ndarray]:
        """P(content) of every node of each page, by sum-product over all pages' trees at once."""
        size = [len(p.parent) for p in pages]
        base = np.cumsum([0, *size])
        n = int(base[-1])
        parent = np.array([q + b if q >= 0 else -1 for p, b in zip(pages, base) for q in p.parent], np.int64)
        depth = np.zeros(n, np.int64)
        for i in range(n):  # parents come first
            if parent[i] >= 0:
                depth[i] = depth[parent[i]] + 1
        none = len(self.logs) - 1
        flat = np.array([self.place.get(f, none) for p in pages for fs in p.features for f in fs], np.int64)
        owner = np.repeat(np.arange(n), [len(fs) for p in pages for fs in p.features])
        up = np.zeros((n, 5))
        np.add.at(up, owner, self.logs[flat])
        block = np.array([t is not None for p in pages for t in p.text], bool)
        up[np.ix_(block, [FRAME, MARKED])] = -np.inf
        order = np.argsort(depth, kind="stable")
        levels = np.split(order, np.cumsum(np.bincount(depth))[:-1]) if n else []
        message = np.zeros((n, 5))
        for nodes in reversed(levels[1:]):
            message[nodes] = np.logaddexp.reduce(self.edges[None] + up[nodes][:, None, :], axis=2)
            np.add.at(up, parent[nodes], message[nodes])
        belief = up.copy()
        if levels:
            belief[levels[0]] += self.root
        for nodes in levels[1:]:
            # what the parent knows without this child, carried over the edge
            rest = belief[parent[nodes]] - message[nodes]
            belief[nodes] = up[nodes] + np.logaddexp.reduce(rest[:, :, None] + self.edges[None], axis=1)
        p = np.exp(belief - np.logaddexp.reduce(belief, axis=1, keepdims=True))[:, CONTENT] if n else np.empty(0)
        return [p[i:j] for i, j in zip(base[:-1], base[1:])]


def learn(pages: DataFrame, max_pages: int = MAX_TRAIN_PAGES) -> TreeModel:
    """Counts features and edges of labelled pages (page_id, url, html); at most about ``max_pages`` of those with the markup that
    labels are taken from, picked by hash."""
    d = pages.where(F.col("html").rlike("(?i)<(article|main)[\\s>]|role\\s*=\\s*[\"']?(article|main)")).select("page_id", "url", "html")
    n = d.count()
    if n > max_pages:
        d = d.where(F.pmod(F.xxhash64("page_id", "url", "html"), F.lit(1 << 40)) < int(max_pages / n * (1 << 40)))
    d = d.select("html")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple[str, str, int], int] = {}

        def add(kind, value, state):
            sums[kind, value, state] = sums.get((kind, value, state), 0) + 1

        for b in batches:
            for source in b["html"].to_pylist():
                page = Page(source)
                state = page.labels()
                for i, s in enumerate(state or []):
                    for name, value in page.features[i]:
                        add(name, str(value), s)
                    p = page.parent[i]
                    add("edge" if p >= 0 else "root", str(state[p] if p >= 0 else ""), s)
        yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in sums], pa.string()), pa.array([k[1] for k in sums], pa.string()),
                                          pa.array([k[2] for k in sums], pa.int64()), pa.array(list(sums.values()), pa.int64())],
                                         names=["kind", "value", "state", "n"])

    features: dict[tuple[str, object], np.ndarray] = {}
    edges, root = np.zeros((3, 3)), np.zeros(3)
    # one row per feature value and state: bounded by the model
    rows = d.mapInArrow(run, "kind string, value string, state long, n long").groupBy("kind", "value", "state").agg(F.sum("n").alias("n"))
    for kind, value, state, n in rows.collect():
        if kind == "edge":
            edges[int(value), state] += n
        elif kind == "root":
            root[state] += n
        else:
            key = (kind, int(value) if kind in ("words", "links") else value)
            features.setdefault(key, np.zeros(3))[state] += n
    return TreeModel(features, edges, root)


def extract(pages: DataFrame, model: TreeModel | None = None) -> DataFrame:
    """(page_id, url, text, n_chars, n_blocks, n_kept) per row of ``pages`` (page_id, url, html)."""
    model = model or learn(pages)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches_of(batches, 200):
            parsed = [Page(x) for x in b["html"].to_pylist()]
            texts, blocks, kept = [], [], []
            for page, p in zip(parsed, model.content(parsed)):
                good = [t for t, q in zip(page.text, p.tolist()) if t is not None and q >= 0.5]
                texts.append("\n\n".join(good))
                blocks.append(sum(t is not None for t in page.text))
                kept.append(len(good))
            yield pa.RecordBatch.from_arrays(
                [b["page_id"], b["url"], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64()),
                 pa.array(blocks, pa.int64()), pa.array(kept, pa.int64())],
                names=["page_id", "url", "text", "n_chars", "n_blocks", "n_kept"])

    d = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html")
    return d.mapInArrow(run, "page_id long, url string, text string, n_chars long, n_blocks long, n_kept long")


def op9_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars")
