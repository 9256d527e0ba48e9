"""Main text of HTML pages: boosted trees over DOM nodes, decoded down the tree.

A page is parsed into a tree of elements. Every element gets features (text,
link and tag density of its subtree, tokens of its tag and attributes, depth,
place among its siblings), and gradient-boosted trees give the odds that its
text belongs to the article. Decoding gives every element one of three states:
all of it in, all of it out, or mixed. Below an element that is in or out all
is alike, so an ancestor and its descendants never contradict each other; a
mixed element costs ``SPLIT``. Of all such choices the one with the highest
summed log odds is found from the leaves up.

The trees are trained on the table's own pages: a bounded sample of pages
(``SAMPLE_PAGES``, by hash of id) is set into a family of page layouts, in which
the label of each element is known by construction.

Defined results: null and empty html, and pages without text, give the empty text;
an unclosed or cut-off page is read as far as it goes; repeated rows give
repeated rows; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import html as html_lib
import re

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from worklake.llm.common import text_or_empty

SAMPLE_PAGES = 400
TREES, DEPTH, STEP, SEED = 24, 5, 0.3, 11
#: Log odds that a mixed element must win by.
SPLIT = 1.5

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN = frozenset("head script style template iframe select button textarea".split())
RAW = frozenset(("script", "style", "textarea", "title"))
BLOCK = frozenset("address article aside blockquote body br caption center dd details dialog div dl dt fieldset figcaption figure "
                  "footer form h1 h2 h3 h4 h5 h6 header hr html li main menu nav ol option p pre section summary table tbody td "
                  "tfoot th thead tr ul".split())
# Elements that end when one of the listed starts inside the same container.
CLOSES = {"p": BLOCK - {"br", "html", "body"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr"},
          "td": {"td", "th", "tr"}, "th": {"td", "th", "tr"}, "option": {"option"}}
#: Attribute words by what they speak of; a feature each.
TOKENS = {
    "article": "article post story content entry main body text prose maincontent articlebody hentry blogpost",
    "menu": "nav menu navbar navigation breadcrumb breadcrumbs toolbar tabs pagination pager toc skip topbar",
    "edge": "header footer masthead banner colophon copyright foot head sitefooter siteheader bottom legal brand logo",
    "side": "sidebar aside side rail widget related recommended trending popular more links promo teaser also tags",
    "notice": "cookie consent notice alert gdpr popup modal overlay subscribe newsletter signup login paywall warning message dialog",
    "advert": "ad ads advert adverts advertisement sponsor sponsored promoted dfp banner adsense commercial",
    "comment": "comment comments reply replies discussion disqus respond feedback reviews thread",
    "share": "share social sharing follow facebook twitter button buttons tools print meta byline author date timestamp",
    "form": "form search field input captcha contact",
}
TAGS = ("article", "main", "nav", "footer", "header", "aside", "form", "section", "div", "p", "headline", "list", "item", "a", "table", "inline")
INHERITED = ("article", "main", "nav", "footer", "header", "aside", "form")
FEATURES = (*[f"tag_{t}" for t in TAGS], *[f"says_{t}" for t in TOKENS], *[f"in_tag_{t}" for t in INHERITED],
            *[f"in_{t}" for t in TOKENS], "log_chars", "link_share", "chars_per_tag", "points", "own_share", "depth",
            "before", "after", "likes", "page_share", "has_inputs", "paragraphs")

_MARKUP = re.compile(r"<(?:(/?)([a-zA-Z][^\s/>]*)|[!?])")
_TAG_STOP = re.compile("[>\"']")
_CUT_OFF = re.compile(r"</?[a-zA-Z!?]|</?$")
# An attribute and its value, if any: a name inside another name or inside a value is none.
_ATTRIBUTE = re.compile(r"""([^\s/>][^\s/>=]*)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]*))?""")
_NAMING = re.compile(r"class|id|role|itemprop|data-[a-z]+|aria-label")
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_SPACE = re.compile(r"\s+")


class Node:
    __slots__ = ("tag", "words", "parent", "items", "hidden", "stats", "index", "depth", "place")

    def __init__(self, tag: str, words=frozenset(), parent=None, hidden=False):
        self.tag, self.words, self.parent, self.hidden = tag, words, parent, hidden
        self.items: list = []  # texts and nodes, in page order
        self.depth = parent.depth + 1 if parent else 0


def attribute_words(raw: str) -> tuple[frozenset, bool]:
    """Lower-case words of the naming attributes, and whether the element is hidden."""
    words, hidden = set(), False
    for name, value in _ATTRIBUTE.findall(raw):
        name, value = name.lower(), value.strip("\"'")
        if name == "hidden":
            hidden = True
        elif name == "style":
            hidden = hidden or bool(re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.IGNORECASE))
        elif _NAMING.fullmatch(name):
            words.update(w.lower() for w in _WORD.findall(value))
    return frozenset(words), hidden


def parse(page: str) -> Node:
    """The page's tree. Unclosed elements end with their parent; stray end tags are skipped."""
    root = top = Node("html")
    at, size, open_tags = 0, len(page), {"html": 1}
    for match in _iterate(page):
        start, end, closing, tag, rest = match
        if start > at:
            top.items.append(page[at:start])
        at = end
        if not tag:
            continue
        if closing:
            if open_tags.get(tag) and tag not in ("html", "body"):
                while top.tag != tag:
                    open_tags[top.tag] -= 1
                    top = top.parent
                open_tags[tag] -= 1
                top = top.parent or root
            elif tag == "p" or tag == "br":
                top.items.append(Node("br", parent=top))
            continue
        if tag in ("html", "body"):
            continue
        while top.tag in CLOSES and tag in CLOSES[top.tag]:
            open_tags[top.tag] -= 1
            top = top.parent
        if tag in BLOCK and open_tags.get("p") and top.tag in INLINE:  # an inline element left open in a paragraph
            up = top
            while up.tag in INLINE:
                up = up.parent
            if up.tag == "p" and tag in CLOSES["p"]:
                while top is not up.parent:
                    open_tags[top.tag] -= 1
                    top = top.parent
        words, hidden = attribute_words(rest) if rest.strip(" /") else (frozenset(), False)
        node = Node(tag, words, top, hidden or tag in HIDDEN)
        top.items.append(node)
        if tag not in VOID and not rest.endswith("/"):
            top = node
            open_tags[tag] = open_tags.get(tag, 0) + 1
    if at < size:
        tail = page[at:]
        cut = tail.find("<")  # a tag that is cut off is no text
        while cut >= 0 and not _CUT_OFF.match(tail, cut):
            cut = tail.find("<", cut + 1)
        top.items.append(tail if cut < 0 else tail[:cut])
    return root


INLINE = frozenset("a abbr b bdi bdo big cite code data dfn em font i ins kbd label mark q rp rt ruby s samp small span strong sub sup "
                   "time tt u var".split())


def _iterate(page: str):
    """(start, end, closing, tag, attributes) of each markup piece; raw text is part of its piece.

    Goes forward only: a search that found nothing is not repeated further on.
    """
    at, ends, last = 0, _TagEnds(page), page.rfind(">")
    while True:
        match = _MARKUP.search(page, at)
        if match is None:
            return
        start = match.start()
        if match[2] is None:
            comment = page.startswith("<!--", start)
            end = page.find("-->", start + 4) if comment else page.find(">", start)
            at = len(page) if end < 0 else end + (3 if comment else 1)
            yield start, at, "", "", ""
            continue
        if last < match.end():
            return  # cut off: no tag ends any more
        end = ends.after(match.end())
        tag, rest, at = match[2].lower(), page[match.end():end], end + 1
        if tag in RAW and not match[1] and not rest.endswith("/"):
            end = re.compile(f"</{tag}[\\s>/]|</{tag}$", re.IGNORECASE).search(page, at)
            if end is None:
                yield start, len(page), "", "", ""
                return
            close = page.find(">", end.start())
            at = len(page) if close < 0 else close + 1
            yield start, at, "", "", ""  # its content is no text
        else:
            yield start, at, match[1], tag, rest


class _TagEnds:
    """Where tags end: at the next ``>`` outside quotes.

    A quote that no other one closes is a character like others; once no ``>`` is
    found outside quotes, the page's quotes say nothing and the first ``>`` counts.
    """

    def __init__(self, page: str):
        self.page, self.alone, self.broken = page, set(), False

    def after(self, at: int) -> int:
        place = at
        while not self.broken:
            stop = _TAG_STOP.search(self.page, place)
            if stop is None:
                self.broken = True
                break
            if stop[0] == ">":
                return stop.start()
            place = stop.end()
            if stop[0] not in self.alone:
                close = self.page.find(stop[0], place)
                if close < 0:
                    self.alone.add(stop[0])
                else:
                    place = close + 1
        return self.page.find(">", at)


def nodes_of(root: Node) -> list[Node]:
    """Visible elements in page order, with the statistics of their subtrees and their places."""
    order: list[Node] = []
    root.place = (0, 0, 1)
    stack = [root]
    while stack:
        node = stack.pop()
        node.index = len(order)
        order.append(node)
        kids = [x for x in node.items if isinstance(x, Node) and not x.hidden]
        likes: dict[str, int] = {}
        for x in kids:
            likes[x.tag] = likes.get(x.tag, 0) + 1
        for k, x in enumerate(kids):
            x.place = (k, len(kids) - k - 1, likes[x.tag])
        stack.extend(reversed(kids))
    for node in reversed(order):
        texts = [x for x in node.items if isinstance(x, str)]
        own = sum(len(x.strip()) for x in texts)
        chars, links, tags, inputs, paragraphs = own, 0, 1, int(node.tag in ("input", "label")), int(node.tag == "p")
        points = sum(x.count(".") + x.count(",") for x in texts)
        for x in node.items:
            if isinstance(x, Node):
                if x.hidden:
                    inputs += x.tag in ("button", "textarea", "select")
                    continue
                c = x.stats
                chars, links, tags, points = chars + c[0], links + c[1], tags + c[2], points + c[3]
                inputs, paragraphs = inputs + c[5], paragraphs + c[6]
        if node.tag == "a":
            links = chars
        node.stats = (chars, links, tags, points, own, inputs, paragraphs)
    return order


_KIND = {**{f"h{k}": "headline" for k in range(1, 7)}, **dict.fromkeys(("ul", "ol", "dl", "menu"), "list"),
         **dict.fromkeys(("li", "dt", "dd"), "item"), **dict.fromkeys(("table", "tr", "td", "th", "tbody", "thead"), "table"),
         **dict.fromkeys(INLINE, "inline"), **{t: t for t in TAGS}}
_SETS = [frozenset(v.split()) for v in TOKENS.values()]


def features_of(order: list[Node]) -> np.ndarray:
    """One row per visible element; ``order`` has parents before children."""
    out = np.zeros((len(order), len(FEATURES)), np.float32)
    total = max(1, order[0].stats[0])
    n_tags, n_says, n_up = len(TAGS), len(TOKENS), len(INHERITED)
    first = n_tags + n_says
    last = first + n_up + n_says
    for node in order:
        row = out[node.index]
        kind = _KIND.get(node.tag)
        if kind:
            row[TAGS.index(kind)] = 1
        if node.parent is not None:
            row[first:last] = out[node.parent.index, first:last]
        if node.tag in INHERITED:
            row[first + INHERITED.index(node.tag)] = 1
        if node.words:
            for k, words in enumerate(_SETS):
                if not words.isdisjoint(node.words):
                    row[n_tags + k] = row[first + n_up + k] = 1
        chars, links, tags, points, own, inputs, paragraphs = node.stats
        before, after, likes = node.place
        row[last:] = (min(np.log1p(chars), 8.0), links / max(1, chars), min(chars / tags, 300), min(100 * points / max(1, chars), 20),
                      own / max(1, chars), min(node.depth, 8), min(before, 8), min(after, 8), min(likes, 8),
                      chars / total, min(inputs, 3), min(paragraphs, 8))
    return out


class Trees:
    """Boosted trees as arrays, for whole batches of nodes at once."""

    def __init__(self, trees, weights):
        self.trees, self.weights = trees, weights  # a tree: (feature, threshold, left, right, value) arrays

    @classmethod
    def of_model(cls, model) -> Trees:
        """From a fitted ``GBTClassificationModel``; all its splits are at thresholds."""
        out = []
        for tree in model._java_obj.trees():
            rows: list[list] = []

            def walk(node, rows=rows):
                at = len(rows)
                rows.append([-1, 0.0, 0, 0, node.prediction()])
                if node.subtreeDepth() > 0:
                    split = node.split()
                    rows[at][:2] = [split.featureIndex(), split.threshold()]
                    rows[at][2] = walk(node.leftChild())
                    rows[at][3] = walk(node.rightChild())
                return at

            walk(tree.rootNode())
            f, t, left, right, value = zip(*rows, strict=True)
            out.append((np.array(f), np.array(t, np.float64), np.array(left), np.array(right), np.array(value, np.float64)))
        return cls(out, list(model.treeWeights))

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        margin = np.zeros(len(x))
        rows = np.arange(len(x))
        for (feature, threshold, left, right, value), weight in zip(self.trees, self.weights, strict=True):
            at = np.zeros(len(x), np.int64)
            for _ in range(DEPTH):
                f = feature[at]
                down = np.where(x[rows, np.maximum(f, 0)] <= threshold[at], left[at], right[at])
                at = np.where(f < 0, at, down)
            margin += weight * value[at]
        return 2 * margin


def decode(order: list[Node], odds) -> list[bool]:
    """Per visible element whether its own text is kept.

    Inline elements within text (links, emphasis) share the fate of the text around them.
    """
    n = len(order)
    total, best, state = [0.0] * n, [0.0] * n, [0] * n  # state 1: in, -1: out, 0: mixed
    side = [True] * n  # of the own text, where mixed
    kids: list[list[int]] = [[] for _ in range(n)]
    for node in order[1:]:
        kids[node.parent.index].append(node.index)
    glued = [bool(i and node.tag in INLINE and node.parent.stats[4]) for i, node in enumerate(order)]
    for i in range(n - 1, -1, -1):
        node = order[i]
        own = float(odds[i]) if node.stats[0] and i else 0.0  # the root says nothing about its parts
        total[i] = own + sum(total[k] for k in kids[i])
        text = own + sum(total[k] for k in kids[i] if glued[k])
        side[i] = i == 0 or text > 0
        mixed = (abs(text) if node.stats[4] else 0.0) + sum(best[k] for k in kids[i] if not glued[k]) - SPLIT
        best[i] = max(total[i], -total[i], mixed)
        state[i] = 1 if best[i] == total[i] else -1 if best[i] == -total[i] else 0
    keep = [False] * n
    given = [0] * n
    for i in range(n):
        s = given[i] or state[i]
        keep[i] = s > 0 or (s == 0 and side[i])
        for k in kids[i]:
            given[k] = (1 if keep[i] else -1) if glued[k] else s
    return keep


def text_of(root: Node, keep: list[bool]) -> str:
    """Kept texts: one blank for white space inside a block, blocks joined by one blank."""
    blocks, inside = [], []

    def end():
        block = _SPACE.sub(" ", html_lib.unescape("".join(inside))).strip()
        if block:
            blocks.append(block)
        inside.clear()

    stack: list = [(root, 0)]
    while stack:
        node, k = stack.pop()
        if not k and node.tag in BLOCK:
            end()
        while k < len(node.items):
            item = node.items[k]
            k += 1
            if isinstance(item, str):
                if keep[node.index]:
                    inside.append(item)
            elif not item.hidden:
                stack.append((node, k))
                stack.append((item, 0))
                break
        else:
            if node.tag in BLOCK:
                end()
    end()
    return " ".join(blocks)


# --- training ------------------------------------------------------------------

_MARK = "\ue000"  # stands before texts of the article in a training page


def snippets(root: Node) -> tuple[list[str], list[str]]:
    """(long, short) texts of a page, whatever they are there."""
    long, short = [], []
    for node in nodes_of(root):
        text = _SPACE.sub(" ", html_lib.unescape("".join(x for x in node.items if isinstance(x, str)))).strip()
        if len(text) > 60 and node.tag != "a":
            long.append(text[:2000])
        elif text:
            short.append(text[:60])
    return long or ["."], short or ["."]


def training_page(long: list[str], short: list[str], draw: np.random.Generator) -> str:
    """A page of a random layout; texts of its article are marked."""
    pick = lambda options: options[int(draw.integers(len(options)))]
    some = lambda share: draw.random() < share
    esc = html_lib.escape
    words = lambda: esc(pick(short))
    sentence = lambda: esc(pick(long)[:int(draw.integers(40, 200))])
    links = lambda n: "".join(f"<li><a href='/{k}'>{words()}</a></li>" for k in range(n))
    named = lambda tag, names, body: f"<{tag} {pick(('class', 'id'))}='{pick(names)}'>{body}</{tag}>"

    def advert():
        return named(pick(("div", "div", "aside", "section")), ("ad", "ad-slot", "advert", "sponsored-box", "promo banner", "adsbox"),
                     pick((sentence(), f"<p>{sentence()}</p>", f"<a href='/x'>{words()}</a> {sentence()}")))

    def menu():
        body = f"<ul>{links(int(draw.integers(3, 9)))}</ul>"
        return pick((f"<nav>{body}</nav>", named("div", ("menu", "main-nav", "breadcrumbs", "navbar", "pagination"), body),
                     named("ul", ("nav", "menu", "tabs"), links(5))))

    def edge(top):
        tag, names = ("header", ("header", "site-header", "masthead")) if top else ("footer", ("footer", "site-footer", "copyright"))
        body = pick((f"&copy; {words()} &middot; {sentence()}", f"<p>{sentence()}</p>", f"{words()}<ul>{links(3)}</ul>",
                     f"<h2>{words()}</h2><p>{sentence()}</p>"))
        return pick((f"<{tag}>{body}</{tag}>", named("div", names, body)))

    def side():
        body = f"<h3>{words()}</h3>" + pick((f"<ul>{links(5)}</ul>", f"<p>{sentence()}</p><p>{sentence()}</p>", f"<p>{esc(pick(long))}</p>"))
        return pick((f"<aside>{body}</aside>", named(pick(("div", "aside", "section")), ("sidebar", "related", "widget", "more-stories", "trending"), body)))

    def notice():
        body = f"<p>{sentence()}</p>" + pick(("", f"<button>{words()}</button>", f"<a href='/ok'>{words()}</a>"))
        return named(pick(("div", "section", "aside")), ("cookie-notice", "consent", "notice", "alert", "newsletter", "subscribe-box", "popup"), body)

    def form():
        return f"<form action='/s'><label>{words()}</label><input name='q'><p>{sentence()}</p><button>{words()}</button></form>"

    def comments():
        one = lambda: named(pick(("div", "li", "article")), ("comment", "reply", "comment-body"),
                            f"<b>{words()}</b><p>{esc(pick(long)[:400])}</p>")
        body = f"<h3>{words()}</h3>" + "".join(one() for _ in range(int(draw.integers(1, 6))))
        return named(pick(("div", "section")), ("comments", "comment-list", "discussion", "responses comments"), body)

    def share():
        return named("div", ("share", "social", "byline", "post-meta", "tags"), pick((f"<a href='/f'>{words()}</a> <a href='/t'>{words()}</a>", words())))

    def article():
        own = lambda text: _MARK + esc(text)
        parts = [f"<h1>{own(pick(short + long)[:60])}</h1>"] if some(0.8) else []
        for _ in range(int(draw.integers(1, 12) if some(0.8) else draw.integers(12, 40))):
            text = own(" ".join(pick(long) for _ in range(int(draw.integers(2, 5)))) if some(0.15)
                       else pick(long + short) if some(0.8) else pick(short))
            parts.append(pick((f"<p>{text}</p>",) * 8 + (
                f"<p><b>{text}<br><p>{own(pick(long))}</p>", f"<h2>{own(pick(short))}</h2>", f"<blockquote>{text}</blockquote>",
                f"<ul><li>{text}</li><li>{own(pick(short))}</li></ul>", f"<div>{text}</div>", f"<pre>{text}</pre>",
                f"<table><tr><td>{own(pick(short))}</td><td>{own(pick(short))}</td></tr></table>",
                f"<p>{text} <a href='/l'>{own(pick(short))}</a> {own(pick(short))}</p>",
                f"<figure><figcaption>{own(pick(short))}</figcaption></figure>")))
        for extra in (advert, side, share, notice, form):
            if some(0.2):
                parts.insert(int(draw.integers(len(parts) + 1)), extra())
        body = "".join(parts)
        return pick((f"<article>{body}</article>",) * 4 + (f"<main>{body}</main>", f"<div>{body}</div>", f"<div>{body}</div>", body,
                    named("div", ("article-body", "post-content", "entry-content", "story", "content", "main"), body),
                    named("section", ("post", "article", "content"), body),
                    f"<article><header>{parts[0]}</header>{''.join(parts[1:])}</article>",
                    f"<main><article>{body}</article></main>"))

    top = [p() for p, share_ in ((lambda: edge(True), 0.4), (menu, 0.9), (notice, 0.3), (advert, 0.5), (form, 0.2)) if some(share_)]
    below = [p() for p, share_ in ((share, 0.3), (comments, 0.4), (side, 0.4), (advert, 0.3), (notice, 0.2), (form, 0.2)) if some(share_)]
    draw.shuffle(below)
    middle = "".join([*(["" if some(0.7) else side()]), article(), *below])
    if some(0.5):
        middle = named("div", ("page", "wrapper", "container", "row", "layout"), middle)
    return f"<html><head><title>{words()}</title></head><body>{''.join(top)}{middle}{edge(False) if some(0.9) else ''}</body></html>"


def training_rows(page: str) -> tuple[np.ndarray, np.ndarray]:
    """(features, labels) of the elements that are wholly article or wholly not."""
    order = nodes_of(parse(page))
    x = features_of(order)
    marked, all_ = np.zeros(len(order)), np.zeros(len(order))
    for node in reversed(order):
        for item in node.items:
            if isinstance(item, str):
                if item.strip():
                    all_[node.index] += 1
                    marked[node.index] += _MARK in item
            elif not item.hidden:
                all_[node.index] += all_[item.index]
                marked[node.index] += marked[item.index]
    pure = (all_ > 0) & ((marked == 0) | (marked == all_))
    return x[pure], (marked[pure] > 0).astype(float)


def train(pages: DataFrame, sample_pages: int = SAMPLE_PAGES, id_col: str = "page_id", html_col: str = "html") -> Trees | None:
    """Trees fitted on layouts made of the texts of a bounded sample of pages; None without pages."""
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.functions import array_to_vector

    spark: SparkSession = pages.sparkSession
    hashed = pages.select(F.xxhash64(F.col(id_col)).alias("h"), text_or_empty(html_col).alias("html"))
    # Only hashes are sorted, not pages; rows of one hash (repeated ids) count once.
    bound = hashed.select("h").distinct().orderBy("h").limit(sample_pages).agg(F.max("h")).first()[0]
    if bound is None:
        return None
    sample = hashed.where(F.col("h") <= bound).groupBy("h").agg(F.min("html").alias("html"))

    def run(batches):
        import pandas as pd

        for batch in batches:
            for h, page in zip(batch["h"], batch["html"], strict=True):
                long, short = snippets(parse(page))
                draw = np.random.default_rng([SEED, int(h) & 0xFFFFFFFF])
                for _ in range(2):
                    # The mark is a character, so that features see texts of the same make with and without it.
                    x, y = training_rows(training_page(long, short, draw))
                    yield pd.DataFrame({"label": y, "x": list(x.astype("f8"))})

    rows = sample.repartition(spark.sparkContext.defaultParallelism).mapInPandas(run, "label double, x array<double>")
    rows = rows.select("label", array_to_vector("x").alias("features")).persist()
    try:
        if rows.select("label").distinct().count() < 2:
            return None
        model = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, stepSize=STEP, seed=SEED, maxBins=32,
                              minInstancesPerNode=8).fit(rows)
    finally:
        rows.unpersist()
    return Trees.of_model(model)


def extract_batch(pages: list[str], trees: Trees | None) -> list[str]:
    roots = [parse(p) for p in pages]
    orders = [nodes_of(r) for r in roots]
    if trees is None:
        return ["" for _ in pages]
    odds = trees.log_odds(np.concatenate([features_of(o) for o in orders])) if orders else np.zeros(0)
    out, at = [], 0
    for root, order in zip(roots, orders, strict=True):
        out.append(text_of(root, decode(order, odds[at:at + len(order)])))
        at += len(order)
    return out


def extract_text(pages: DataFrame, trees: Trees | None = None, id_col: str = "page_id", url_col: str = "url",
                 html_col: str = "html") -> DataFrame:
    """page_id, url, text and its length in code points; trains on the table unless trees are given."""
    trees = train(pages, id_col=id_col, html_col=html_col) if trees is None else trees

    def run(batches):
        import pyarrow as pa

        for whole in batches:
            for at in range(0, whole.num_rows, 200):
                batch = whole.slice(at, 200)
                texts = extract_batch(batch.column(2).to_pylist(), trees)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                    ["page_id", "url", "text", "n_chars"])

    return (pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"),
                         text_or_empty(html_col).alias("html"))
            .mapInArrow(run, "page_id long, url string, text string, n_chars long"))
