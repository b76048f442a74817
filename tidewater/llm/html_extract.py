"""Main text of web pages by a graphical model on the DOM tree.

Each block-level element of a page is content or not. A node has a potential
from its own features (tag, words in class and id, the frame that it
stands in, text length, share of linked text); a parent and a child have a joint potential. Messages sum over
the labels upward and downward (sum-product), which is exact on a tree, and
give each node's marginal. Weights are trained on the labelled pages below.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass, field
from functools import lru_cache
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import column_named

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span "
                   "strike strong sub sup time tt u var".split())
#: Never text of the article.
MUTE = frozenset("script style noscript template head title iframe object svg math select option button textarea form".split())
#: Start tags that end an open paragraph, and the tags that end one of their own kind.
ENDS_PARAGRAPH = frozenset("address article aside blockquote center details dialog dd div dl dt fieldset figcaption figure footer "
                           "form h1 h2 h3 h4 h5 h6 header hr li main menu nav ol p pre section table ul".split())
ENDS_OWN = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
            "th": {"td", "th"}, "option": {"option"}}
#: What an open head may hold; any other start tag, and text, ends it.
HEAD_CONTENT = frozenset("base basefont bgsound link meta title noscript noframes style script template head".split())
#: Elements whose inside is not HTML, the elements inside that hold HTML again, and the start tags that end them.
FOREIGN = frozenset(("svg", "math"))
HOLDS_HTML = frozenset("foreignobject desc title annotation-xml mi mo mn ms mtext".split())
ENDS_FOREIGN = frozenset("b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 head hr i img li listing menu "
                         "meta nobr ol p pre ruby s small span strong strike sub sup table tt u ul var".split())
CONTAINERS = frozenset("ul ol dl table tbody thead tfoot div section article main aside nav body html".split())

# Words that class and id attributes are searched for: exact words, then beginnings of words.
BOILER_WORDS = frozenset("ad ads adv nav sns toc tags bar respond".split())
BOILER_STARTS = ("advert", "banner", "bottom", "breadcrumb", "byline", "comment", "consent", "cookie", "copyright", "disqus", "foot",
                 "gdpr", "header", "login", "menu", "masthead", "meta", "modal", "navi", "newsletter", "notice", "pager",
                 "paginat", "paywall", "popup", "promo", "recommend", "related", "reply", "search", "share", "sharing",
                 "sidebar", "signup", "social", "sponsor", "subscri", "toolbar", "widget", "alert", "warning", "skip")
CONTENT_STARTS = ("article", "body", "content", "entry", "main", "post", "story", "text", "prose")


@dataclass
class Page:
    """Nodes in page order (a parent before its children) and pieces of text."""
    parent: list[int] = field(default_factory=lambda: [-1])
    tag: list[str] = field(default_factory=lambda: ["root"])
    named: list[str] = field(default_factory=lambda: [""])
    given: list[int | None] = field(default_factory=lambda: [None])  # labels of training pages
    pieces: list[tuple[int, int, str, bool]] = field(default_factory=list)  # node, block, text, linked


class _Builder(HTMLParser):
    """DOM-like tree from any tag soup: missing and stray end tags are mended as browsers do."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.page, self.stack, self.block = Page(), [("root", 0)], 0
        self.foreign = [False]  # of each open element: is its inside not HTML?
        self.linked = [False]  # of each open element: is it in a link?
        self.open: dict[str, int] = {}  # open elements by tag

    def parse_marked_section(self, i, report=1):
        """``<![...`` is a comment up to ``>``, as browsers have it."""
        end = self.rawdata.find(">", i + 3)
        return end + 1 if end >= 0 else -1

    def handle_starttag(self, tag, attrs):
        if tag in ENDS_FOREIGN:
            while self.foreign[-1]:
                self._cut(len(self.stack) - 1)
        if tag == "head" and self.stack[-1][0] == "head":
            return
        if tag not in HEAD_CONTENT:
            self._end_head(tag)
        if tag == "br":
            self.page.pieces.append((self.stack[-1][1], self.block, " ", False))
        if tag in VOID:
            return
        if tag in ENDS_PARAGRAPH:
            self._close({"p"}, CONTAINERS)
        if tag in ENDS_OWN:
            self._close(ENDS_OWN[tag], CONTAINERS - {"tbody", "thead", "tfoot"})
        node = self.stack[-1][1]
        words = " ".join(v or "" for k, v in attrs if k in ("class", "id", "role")).lower()
        if tag not in INLINE or _boiler(words):
            node = len(self.page.parent)
            self.page.parent.append(self.stack[-1][1])
            self.page.tag.append(tag)
            self.page.named.append(words)
            marks = dict(attrs)
            self.page.given.append(1 if "keep" in marks else 0 if "drop" in marks else None)
        if tag not in INLINE:
            self.block += 1
        self.stack.append((tag, node))
        self.open[tag] = self.open.get(tag, 0) + 1
        self.linked.append(tag == "a" or self.linked[-1])
        self.foreign.append(tag in FOREIGN or self.foreign[-1] and tag not in HOLDS_HTML)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)  # HTML ignores the slash
        if tag not in VOID and (tag in FOREIGN or self.foreign[-2:-1] == [True]):
            self.handle_endtag(tag)

    def _pop(self, k):
        for tag, _ in self.stack[k:]:
            self.open[tag] -= 1
        del self.stack[k:], self.foreign[k:], self.linked[k:]

    def _cut(self, k):
        self._pop(k)
        self.block += 1

    def _end_head(self, tag):
        """A body ends a head with all that is open in it, but not from inside a template."""
        k = len(self.stack) - 1
        if tag == "body":
            while k and self.stack[k][0] not in ("head", "template"):
                k -= 1
        if self.stack[k][0] == "head":
            self._cut(k)

    def _close(self, tags, until):
        if not any(self.open.get(t) for t in tags):
            return
        for k in range(len(self.stack) - 1, 0, -1):
            if self.stack[k][0] in tags:
                self._cut(k)
                return
            if self.stack[k][0] in until:
                return

    def handle_endtag(self, tag):
        if self.open.get(tag):
            for k in range(len(self.stack) - 1, 0, -1):
                if self.stack[k][0] == tag:
                    self._pop(k)
                    break
        if tag not in INLINE:
            self.block += 1

    def handle_data(self, data):
        if self.stack[-1][0] == "head" and data.strip():
            self._end_head("")
        self.page.pieces.append((self.stack[-1][1], self.block, data, self.linked[-1]))


def parse(html: str) -> Page:
    builder = _Builder()
    builder.feed(html)
    builder.close()
    page = builder.page
    if "form" in page.tag:
        _unwrap(page)
    return page


def _unwrap(page: Page) -> None:
    """A form around the page's headline or article, with most of its text, is a frame like any other."""
    n = len(page.parent)
    chars, holds = [0] * n, [t in ("h1", "article", "main") for t in page.tag]
    for node, _, text, _ in page.pieces:
        chars[node] += len(text.strip()) * (page.tag[node] not in ("script", "style"))
    for k in range(n - 1, 0, -1):
        chars[page.parent[k]] += chars[k]
        holds[page.parent[k]] |= holds[k]
    for k in range(n):
        if page.tag[k] == "form" and holds[k] and 2 * chars[k] > chars[0]:
            page.tag[k] = "div"


def _words(named: str) -> list[str]:
    return re.findall(r"[a-z0-9]+", named)


@lru_cache(4096)
def _boiler(named: str) -> bool:
    return any(w in BOILER_WORDS or w.startswith(BOILER_STARTS) for w in _words(named))


@lru_cache(4096)
def _content(named: str) -> bool:
    return any(w.startswith(CONTENT_STARTS) for w in _words(named))


#: Elements that frame what stands inside.
FRAMES = frozenset("article main nav header footer aside form".split())
GROUPS = {t: t for t in "root html body nav header footer aside form article main section div p li blockquote pre figure "
                        "figcaption table".split()}
GROUPS |= {t: "heading" for t in ("h1", "h2", "h3", "h4", "h5", "h6")} | {t: "list" for t in ("ul", "ol", "dl")}
GROUPS |= {t: "item" for t in ("dt", "dd")} | {t: "cell" for t in ("tr", "td", "th", "tbody", "thead", "tfoot")}
GROUPS |= {t: "mute" for t in MUTE}


def node_features(page: Page) -> list[list[str]]:
    n = len(page.parent)
    chars, linked = [0] * n, [0] * n
    for node, _, text, link in page.pieces:
        size = len(text.strip())
        chars[node] += size
        linked[node] += size * link
    for k in range(n - 1, 0, -1):
        chars[page.parent[k]] += chars[k]
        linked[page.parent[k]] += linked[k]
    out, frame = [], []
    for k in range(n):
        size, named = chars[k], page.named[k]
        frame.append("boiler" if _boiler(named) else page.tag[k] if page.tag[k] in FRAMES else "content" if _content(named)
                     else frame[page.parent[k]] if k else "none")
        f = ["tag:" + GROUPS.get(page.tag[k], "other"),
             "size:" + ("none" if not size else "short" if size < 40 else "middle" if size < 160 else "long"),
             "links:" + ("none" if not linked[k] else "some" if 2 * linked[k] < size else "most"),
             "in:" + frame[k]]
        if _boiler(named):
            f.append("named:boiler")
        elif _content(named):
            f.append("named:content")
        out.append(f)
    return out


@dataclass
class Model:
    unary: dict[str, float] = field(default_factory=dict)
    #: Joint potentials of (parent, child) labels.
    pair: list[list[float]] = field(default_factory=lambda: [[0.0, 0.0], [0.0, 0.0]])


def _log_sum(a: float, b: float) -> float:
    high = a if a > b else b
    return high + math.log(math.exp(a - high) + math.exp(b - high))


def marginals(model: Model, page: Page, feats: list[list[str]]):
    """P(content) of each node, and P(parent, child) of each edge, by messages up and down."""
    n, par, m = len(page.parent), page.parent, model.pair
    own = [(0.0, sum(model.unary.get(x, 0.0) for x in f)) for f in feats]
    up = [list(o) for o in own]  # potentials of the part below, the node included
    message = [(0.0, 0.0)] * n
    for k in range(n - 1, 0, -1):
        a, b = up[k]
        message[k] = (_log_sum(m[0][0] + a, m[0][1] + b), _log_sum(m[1][0] + a, m[1][1] + b))
        up[par[k]][0] += message[k][0]
        up[par[k]][1] += message[k][1]
    belief = [None] * n
    edges = [None] * n
    belief[0] = up[0]
    for k in range(1, n):
        p = belief[par[k]]
        rest = (p[0] - message[k][0], p[1] - message[k][1])  # the parent without this child
        joint = [[rest[i] + m[i][j] + up[k][j] for j in (0, 1)] for i in (0, 1)]
        belief[k] = [_log_sum(joint[0][0], joint[1][0]), _log_sum(joint[0][1], joint[1][1])]
        edges[k] = joint
    prob = [math.exp(b[1] - _log_sum(b[0], b[1])) for b in belief]
    for k in range(1, n):
        j = edges[k]
        z = _log_sum(_log_sum(j[0][0], j[0][1]), _log_sum(j[1][0], j[1][1]))
        edges[k] = [[math.exp(v - z) for v in row] for row in j]
    return prob, edges


# Labelled pages: the text of a ``keep`` element is the article, that of a ``drop`` element inside is not.
LABELLED = [
    """<html><head><title>A title</title><style>p{}</style></head><body><nav><ul><li><a href=1>Home</a><li><a href=2>News</a></ul></nav>
    <article keep><h1>The river in spring</h1><p>The water rose in March and stayed high for a week. Farmers moved their herds.</p>
    <p>By April the meadows were dry again.</p></article><footer>&copy; 2020 The Paper. All rights reserved.</footer></body></html>""",
    """<body><header><a href=/>Site</a> <p>Your daily news</p></header><div class="ad">Buy new shoes today. Half price only this week, in all our stores.</div>
    <main keep><h1>Bread</h1><p>Mix flour, water and salt, then leave the dough overnight in a cool place until it has doubled.</p>
    <ul><li>flour</li><li>water</li></ul><aside drop><p>Read more about cakes and other sweet things in our shop.</p></aside>
    <p>Bake it hot.</p></main><aside class=sidebar><h3>Popular</h3><ul><li><a href=3>Ten best ovens of the year</a></li></ul></aside></body>""",
    """<body><div id="menu"><a href=1>One</a> <a href=2>Two</a></div><div id="content" keep><h2>Minutes</h2><div class="post-text"><p>The meeting
    began at nine with a report by the treasurer on the accounts of the past year, which were approved.</p><p>Closed.</p></div></div>
    <div id="sidebar"><p>About the club: founded long ago by friends of music and good food in this town.</p></div>
    <div id="footer"><p>Contact us at the office during the week, or send a letter to the address given below.</p></div></body>""",
    """<body><div class="cookie-notice"><p>We use cookies to make this site better for you. By going on you agree to our terms.</p></div>
    <article class="story" keep><h1>Storm</h1><p>Trees fell on the line near the station and trains stood still for most of the day.</p>
    <div class="ad" drop>Insurance from one a month</div><p>Repairs went on at night.</p><blockquote>We had never seen such wind before, said the
    station master.</blockquote></article><section class="comments"><h3>Comments</h3><p>Great article, thank you for writing about this!</p>
    <div class="comment"><p>I was on that train and it took nine hours to get home in the end.</p></div></section></body>""",
    """<body><p keep>A page without any frame holds just this text, which is long enough to be what the reader came for.</p>
    <p keep>And a second paragraph, shorter.</p></body>""",
    """<body><nav class="breadcrumb"><a href=1>Home</a> &gt; <a href=2>Science</a></nav><div class="main-content" keep><h1>Bees</h1><p>Bees dance
    to tell others where flowers are. The angle gives the direction, the length the distance.</p><form drop><p>Get our letter every week</p>
    <input name=mail><button>Send</button></form><figure><img src=1><figcaption>A hive in summer</figcaption></figure><p>They sleep too.</p>
    <div class="share" drop><a href=5>Share</a> <a href=6>Send</a></div></div><div class="related"><h4>Related</h4><a href=7>Why wasps sting and
    bees do not</a></div><footer><ul><li><a href=1>Imprint</a></li></ul></footer></body>""",
    """<body><div class="header"><h1>The Company</h1></div><div class="wrap"><div class="text" keep><p>Our machines are used on farms in many lands.
    They are built in one place by people who know them well.</p><table><tr><td>Weight</td><td>900 kg</td></tr></table><p>Ask for a
    list.</p></div></div><div class="notice"><p>The office is closed on Monday because of works in the street, we are sorry.</p></div>
    <script>var a = "<p>no</p>";</script></body>""",
    """<body><div><a href=1>Start</a> <a href=2>Forum</a></div><div keep><p>Is it safe to drink the water from the well behind the old mill? We
    had it tested and the result was good on all counts.</p><p>The <a href=9>report</a> is public.</p><h2>Method</h2><p>Three samples.</p></div>
    <div id="disqus_thread"><p>First! And thanks for the test, we drink from it every day and feel fine.</p></div></body>""",
    """<body><header><nav><a href=1>A</a></nav></header><article keep><h1>Short note</h1><p>Yes.</p><p><b>Bold start of an open paragraph that
    nobody closes, with quite a lot of words in it.<br><p>Next one.</p><ol><li>first step of the plan</li><li>second step</li></ol><pre>code
    sample</pre></article><footer><p>Text of the footer with the name of the site and a long line of words about its history.</p></footer></body>""",
    """<body><section class="content" keep><h1>Two towns</h1><p>One is on the hill and one in the valley, and every year in June they play
    football against each other.</p><section><h2>History</h2><p>It began long ago.</p></section><div class="comments" drop><h3>Readers say</h3>
    <p>The valley always wins, this is well known and needs no further words.</p></div></section><section class="newsletter"><p>Subscribe and
    get the best of the week straight into your box, free of charge.</p></section></body>""",
    """<html><head><title>Rain</title></head><body><nav><ul><li><a href=1>Rain</a></li><li><a href=2>Sun</a></li></ul></nav><div class="ad">Umbrellas
    for all.</div><article keep><h1>Rain</h1><p>Rain.</p></article><footer>&copy; weather.example &middot; All about rain.</footer></body></html>""",
    """<html><body><nav><ul><li><a href=1>a</a></li></ul></nav><div class="ad">Cheap flights to the south, book today and save a lot.</div>
    <article keep><h1>A title that is cut</h1><p><b>One paragraph only, which is long, for it holds all that was to be said about the matter,
    and so it goes on and on until at last it comes to an end here, after many words.<br></article><footer>&copy; a &middot; b</footer></body></html>""",
    """<body><nav><a href=1>Home</a></nav><article keep><p>Few words.</p></article><footer><p>Few words at the end of the page.</p></footer></body>""",
    """<body><div class="ad">One two three.</div><article keep><h1>Only a title</h1></article><footer>&copy; Name</footer></body>""",
    """<body><nav><a href=1>Home</a> <a href=2>Away</a></nav><p keep>Plain text under a list of links, written by hand a long time ago and never
    put into any frame, as was the custom.</p><p keep>It ends soon.</p><h2 keep>Sources</h2><ul keep><li>my aunt</li></ul></body>""",
    """<body><main keep><h1>Soup</h1><p>Cut the leeks and boil them with salt for half an hour, then add cream and serve.</p><aside drop><h4>Advice</h4>
    <p>Also try our potato soup with bacon, liked by all.</p></aside><div class="notice" drop>This recipe was moved from the old site.</div>
    <p>Good with bread.</p><form drop><label>Rate this</label><p>How did you like the soup that we made?</p></form></main>
    <footer><div><p>Made by cooks in the north of the country since the year nineteen hundred and five.</p></div></footer></body>""",
]


def _labels(page: Page) -> list[int]:
    out = []
    for k, given in enumerate(page.given):
        out.append(given if given is not None else out[page.parent[k]] if k else 0)
    return [0 if page.tag[k] in MUTE else v for k, v in enumerate(out)]


def fit(pages: list[str] = LABELLED, rounds: int = 400, rate: float = 0.15, decay: float = 0.001) -> Model:
    """Maximum likelihood: observed less expected counts of features and label pairs."""
    model, data = Model(), []
    for html in pages:
        page = parse(html)
        data.append((page, node_features(page), _labels(page)))
    for _ in range(rounds):
        unary: dict[str, float] = {}
        pair = [[0.0, 0.0], [0.0, 0.0]]
        for page, feats, labels in data:
            prob, edges = marginals(model, page, feats)
            for k, f in enumerate(feats):
                for x in f:
                    unary[x] = unary.get(x, 0.0) + labels[k] - prob[k]
                if k:
                    pair[labels[page.parent[k]]][labels[k]] += 1
                    for i in (0, 1):
                        for j in (0, 1):
                            pair[i][j] -= edges[k][i][j]
        for x, g in unary.items():
            w = model.unary.get(x, 0.0)
            model.unary[x] = w + rate * (g / len(data) - decay * w)
        for i in (0, 1):
            for j in (0, 1):
                model.pair[i][j] += rate * (pair[i][j] / len(data) - decay * model.pair[i][j])
    return model


def main_text(model: Model, html: str) -> str:
    """Blocks of content nodes in page order, white space in a block as one blank, joined by line ends."""
    page = parse(html)
    if "<" not in html:  # text alone
        prob = [1.0]
    else:
        prob, _ = marginals(model, page, node_features(page))
    muted = [False] * len(page.parent)
    for k in range(1, len(muted)):
        muted[k] = muted[page.parent[k]] or page.tag[k] in MUTE
    blocks: dict[int, list[str]] = {}
    for node, block, text, _ in page.pieces:
        if prob[node] >= 0.5 and not muted[node]:
            blocks.setdefault(block, []).append(text)
    lines = (" ".join("".join(parts).split()) for _, parts in sorted(blocks.items()))
    return "\n".join(x for x in lines if x)


def extract(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", carry: tuple[str, ...] = ("url",),
            model: Model | None = None) -> DataFrame:
    """Per page: the id, the columns in ``carry``, ``text`` (empty if there is none) and ``n_chars``.

    Null html is empty. Rows are independent; repeated rows repeat their
    results, and each page is parsed whole. The model is a few dozen weights.
    """
    model = model or fit()

    def run(batches):
        for batch in batches:
            html = batch.column(batch.schema.get_field_index(html_col))
            texts = [main_text(model, h.as_py() or "") for h in html]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(batch.schema.get_field_index(c)) for c in (id_col, *carry)],
                 pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                [id_col, *carry, "text", "n_chars"])

    kinds = ", ".join(f"`{c}` {pages.schema[c].dataType.simpleString()}" for c in (id_col, *carry))
    return column_named(pages, id_col, html_col, *carry).mapInArrow(run, f"{kinds}, text string, n_chars long")
