"""Main text of web pages by a tree-structured graphical model.

The parsed page is a tree of block elements with text blocks as leaves; every node is content (1) or
boilerplate (0). Node potentials come from the tag, class / id / role words and, for leaves, length and
link share (never from wording); parent-child potentials tie labels along the tree. Sum-product messages go
up (children to parents) and down, giving the exact content marginal of every node; leaves with a
marginal of at least one half are the article. Potentials are smoothed counts over labelled pages.

Scripts, styles, forms' controls, comments in markup, the head and fallbacks that browsers never show
(canvas, audio, video, iframe) hold no text; formulas, drawn text (svg) and object fallbacks do. Character
references are decoded, white space inside a block becomes one blank, blocks are joined by one newline in
page order; nothing is shortened. Null and empty pages give an empty text; unclosed and stray tags are
repaired as browsers do (a block start ends an open paragraph; what may not stand in a head ends it; an
HTML tag ends an open formula or drawing). Row-local: no shuffle.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HIDDEN = {"script", "style", "noscript", "template", "head", "title", "iframe", "canvas", "audio", "video",
          "select", "option", "button", "textarea", "datalist"}
HEAD = {"html", "head", "base", "basefont", "bgsound", "link", "meta", "noframes", "noscript", "script", "style", "template", "title"}
# Formulas and drawings: their own tags are no blocks; some hold no shown text, in some HTML is allowed again.
FOREIGN = {"math", "svg"}
FOREIGN_HIDDEN = {"annotation", "annotation-xml", "defs", "desc", "metadata", "symbol"}
FOREIGN_HTML = {"foreignobject", "desc", "title", "mi", "mo", "mn", "ms", "mtext", "annotation-xml"}
BREAKOUT = {"b", "big", "blockquote", "body", "br", "center", "code", "dd", "div", "dl", "dt", "em", "embed", "h1", "h2", "h3", "h4", "h5",
            "h6", "head", "hr", "i", "img", "li", "listing", "menu", "meta", "nobr", "ol", "p", "pre", "ruby", "s", "small", "span",
            "strong", "strike", "sub", "sup", "table", "tt", "u", "ul", "var"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
# Elements that begin and end a block; every other element, known or not, is part of a line.
BLOCKS = {"address", "article", "aside", "blockquote", "body", "caption", "colgroup", "dd", "details", "dialog", "dir", "div", "dl", "dt",
          "fieldset", "figcaption", "figure", "footer", "form", "frameset", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hgroup", "html",
          "legend", "li", "listing", "main", "menu", "nav", "noframes", "ol", "optgroup", "p", "plaintext", "pre", "search", "section",
          "summary", "symbol", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul", "xmp", "head", "desc"} - HIDDEN
# A start tag on the left ends an open element on the right, if no element of the stop set is in between.
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}
STOPS = {"ul", "ol", "dl", "table", "tbody", "thead", "article", "section", "main", "body", "object", "foreignobject"}
SECTIONS = {f"tag={t}" for t in ("nav", "header", "footer", "aside", "form", "article", "main", "section", "dialog")}
WORDS = re.compile(r"[a-z]+|[0-9]+")


class Page(HTMLParser):
    """Block tree of a page in document order: ``nodes`` are (parent, feature list, text or None)."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.nodes: list[tuple[int, list[str], str | None]] = [(-1, ["tag=root"], None)]
        self.labels: list[int | None] = [None]
        self.stack: list[tuple[str, int, bool]] = [("root", 0, False)]  # tag, node of the nearest block, hides its text
        self.places: dict[str, list[int]] = {}  # of open elements in the stack, by tag
        self.hidden = 0
        self.foreign = 0
        self.in_body = False  # a head may no longer start
        self.text: list[str] = []
        self.linked = 0
        self.in_link = 0

    def flush(self) -> None:
        text = " ".join("".join(self.text).split())
        if text:
            share = self.linked / max(1, len(text))
            feats = ["leaf", f"len={min(6, len(text).bit_length() // 2)}", f"links={'all' if share > 0.8 else 'some' if share > 0.2 else 'few'}"]
            self.nodes.append((self.stack[-1][1], feats, text))
            self.labels.append(None)
        self.text, self.linked = [], 0

    def close_to(self, at: int) -> None:
        if self.stack[-1][1] != self.stack[at - 1][1]:  # a block ends
            self.flush()
        for tag, _, hides in self.stack[at:]:
            self.hidden -= hides
            self.foreign -= tag in FOREIGN
            self.in_link -= tag == "a"
            self.places[tag].pop()
        del self.stack[at:]

    def push(self, tag: str, node: int, hides: bool) -> None:
        self.places.setdefault(tag, []).append(len(self.stack))
        self.stack.append((tag, node, hides))

    def last(self, tags: set[str]) -> int:
        """Place of the innermost open element of these tags; 0 if none is open."""
        return max((self.places[t][-1] for t in tags if self.places.get(t)), default=0)

    def open_within(self, tag: str, hides: bool) -> None:
        """An element without a block of its own."""
        self.push(tag, self.stack[-1][1], hides)
        self.hidden += hides
        self.foreign += tag in FOREIGN
        self.in_link += tag == "a"

    def leave_head(self) -> None:
        """Body content starts: an open head ends, unless the content is inside one of the head's elements."""
        if self.stack[-1][0] == "head":
            self.close_to(len(self.stack) - 1)
        self.in_body = self.in_body or self.stack[-1][0] in ("root", "html")

    def in_foreign(self, tag: str) -> bool:
        """Whether a start tag belongs to an open formula or drawing; an HTML tag there ends it."""
        if not self.foreign:
            return False
        if self.last(FOREIGN_HTML) > self.last(FOREIGN):
            return False
        if tag in BREAKOUT:
            self.close_to(min(self.places[t][0] for t in FOREIGN if self.places.get(t)))
            return False
        return True

    def handle_starttag(self, tag, attrs):
        if tag == "head" and (self.in_body or self.places.get("head")):
            return
        if tag not in HEAD:
            self.leave_head()
        if self.in_foreign(tag):
            if tag == "text":
                self.text.append(" ")
            self.open_within(tag, tag in HIDDEN or tag in FOREIGN_HIDDEN)
            return
        if tag in VOID:
            if tag in ("br", "hr"):
                self.text.append(" ")
            return
        if tag not in BLOCKS:
            self.open_within(tag, tag in HIDDEN)
            return
        self.flush()
        over = {"p"} | ENDS.get(tag, set())
        at = self.last(over)
        if at > self.last(STOPS):
            self.close_to(at)
        feats = [f"tag={tag}"]
        label = None
        for k, v in attrs:
            if k in ("class", "id", "role", "itemprop") and v:
                feats += [f"word={w}" for w in dict.fromkeys(WORDS.findall(v.lower()))]
            elif k == "data-label" and v in ("0", "1"):
                label = int(v)
        self.nodes.append((self.stack[-1][1], feats, None))
        self.labels.append(label)
        self.push(tag, len(self.nodes) - 1, False)

    def handle_endtag(self, tag):
        at = self.last({tag})
        if not at:
            return
        inline = tag not in BLOCKS or self.foreign and tag in FOREIGN_HIDDEN
        if inline and tag not in HIDDEN and tag not in FOREIGN and self.stack[-1][1] != self.stack[at][1]:
            return  # a block is open inside: the stray end is dropped
        self.close_to(at)
        self.in_body = self.in_body or tag == "head"

    def handle_data(self, data):
        if data.strip():
            self.leave_head()
        if not self.hidden:
            self.text.append(data)
            if self.in_link:
                self.linked += len(data.strip())


def parse(html: str | None) -> Page:
    page = Page()
    if html:
        page.feed(html)
        page.close()
        page.flush()
    return page


def labelled_pages() -> list[str]:
    """Small labelled pages made by rule: every block of a page carries ``data-label`` (1: article)."""
    sentence = "The report describes how the plan was made and what the people of the town think about it today"
    content = [("article", ""), ("main", ""), ("div", "content"), ("div", "post body"), ("section", "entry content"), ("div", "article body"), ("div", ""), ("section", "story text"), ("article", "post main"), ("div", "main"), ("div", "main text column")]
    boiler = [("nav", ""), ("nav", "menu top"), ("header", "site header"), ("header", ""), ("footer", ""), ("footer", "site footer"), ("aside", ""), ("aside", "sidebar"),
              ("div", "ad"), ("div", "ads banner"), ("div", "advert promo"), ("div", "sidebar widget"), ("div", "cookie notice"), ("div", "notice banner"), ("div", "consent popup"),
              ("div", "comments"), ("section", "comments list"), ("div", "comment reply"), ("div", "share social"), ("div", "related links"), ("div", "breadcrumb"),
              ("div", "pagination pager"), ("form", "search"), ("form", ""), ("div", "newsletter subscribe"), ("div", "login modal"), ("div", "header masthead"), ("div", "footer copyright"),
              ("div", "menu navigation"), ("ul", "menu"), ("div", "sponsored"), ("div", "toolbar")]
    inner = ["p", "ul", "p", "h2", "ul", "blockquote", "pre", "p", "table", "p", "div"]

    def text(n: int, i: int) -> str:
        words = (sentence + " ") * 6
        return " ".join(words.split()[i % 7 : i % 7 + n]) + "."

    def block(tag: str, i: int) -> str:
        if tag == "ul":
            return "<ul data-label=1>" + "".join(f"<li data-label=1>{text(1 + 2 * j, i)}</li>" for j in range(3)) + "</ul>"
        if tag == "table":
            return f"<table data-label=1><tr data-label=1><td data-label=1>{text(1, i)}</td><td data-label=1>{text(4, i)}</td></tr></table>"
        if tag == "h2":
            return f"<h2 data-label=1>{text(5, i)[:-1]}</h2>"
        return f"<{tag} data-label=1>{text(1 + (7 * i) % 40 * (i % 3 > 0), i)}</{tag}>"

    def junk(kind: tuple[str, str], i: int) -> str:
        tag, words = kind
        body = [
            "<ul data-label=0>" + "".join(f'<li data-label=0><a href="/">{text(1 + j % 2, i + j)[:-1]}</a></li>' for j in range(4)) + "</ul>",
            f"<p data-label=0>{text(4 + i % 12, i)}</p>",
            text(4 + i % 16, i),
            f'<a href="/">Home</a> <a href="/">{text(2, i)[:-1]}</a>',
            f"<p data-label=0>© 2020 {text(3, i)[:-1]}</p>",
            f"<div data-label=0><p data-label=0>{text(10, i)}</p></div>",
            f"<h1 data-label=0>{text(2, i)[:-1]}</h1>",
            f"<h3 data-label=0>{text(2, i)[:-1]}</h3><p data-label=0>{text(1 + i % 9, i)}</p>",
        ][(i + i // 8) % 8]
        return f'<{tag} class="{words}" data-label=0>{body}</{tag}>'

    pages = []
    for i in range(8 * len(boiler)):
        tag, words = content[i % len(content)]
        kids = [block(inner[(i + j) % len(inner)], i + j) for j in range(1 + i % 6)]
        if i % 5 == 0:
            kids.insert(len(kids) // 2, junk(boiler[(3 * i) % len(boiler)], i))
        main = f'<{tag} class="{words}" data-label=1><h1 data-label=1>{text(6, i)[:-1]}</h1>{"".join(kids)}</{tag}>'
        if i % 4 == 1:
            main = f'<div class="{["wrapper", "container", "page"][i % 3]}" data-label=1>{main}</div>'
        before = "".join(junk(boiler[(i + 11 * j) % len(boiler)], i + j) for j in range(1 + i % 3))
        after = "".join(junk(boiler[(i + 5 * j + 2) % len(boiler)], i + j) for j in range(1 + i % 2))
        pages.append(f"<html data-label=1><head><title>t</title></head><body data-label=1>{before}{main}{after}</body></html>")
    for i in range(2 * len(boiler)):  # plain pages: unnamed blocks right under the body
        kids = "".join(block(inner[(i + j) % len(inner)], i + j) for j in range(2 + i % 4))
        kids = [kids, f"<div data-label=1>{kids}</div>", f"<div data-label=1>{text(8, i)}</div>{kids}", f"<p data-label=1>{text(2, i)}</p>"][i % 4]
        pages.append(f"<body data-label=1>{kids}{junk(boiler[i % len(boiler)], i) if i % 2 else ''}</body>")
    parts = [
        lambda i: f"<figure data-label=1><img><figcaption data-label=1>{text(3 + i % 9, i)}</figcaption></figure>",
        lambda i: f"<details data-label=1><summary data-label=1>{text(3, i)}</summary><p data-label=1>{text(12, i)}</p></details>",
        lambda i: f"<dl data-label=1><dt data-label=1>{text(2, i)}</dt><dd data-label=1>{text(9, i)}</dd></dl>",
        lambda i: f"<section data-label=1><h2 data-label=1>{text(4, i)[:-1]}</h2>{block('p', i)}{block('ul', i)}</section>",
    ]
    for i in range(len(boiler)):  # articles with figures, details, definitions and sections of their own
        tag, words = content[i % len(content)]
        kids = "".join([block("p", i), parts[i % 4](i), block("p", i + 1), parts[(i + 1) % 4](i + 2)])
        main = f'<{tag} class="{words}" data-label=1><h1 data-label=1>{text(6, i)[:-1]}</h1>{kids}</{tag}>'
        pages.append(f"<body data-label=1>{junk(boiler[i], i)}{main}{junk(boiler[(i + 7) % len(boiler)], i + 1)}</body>")
    return pages


def tie(feats: list[str], text: str | None) -> str:
    """Kind of a node's bond to its parent: text, a named or sectioning block, or a plain block."""
    if text is not None:
        return "leaf"
    return "named" if feats[0] in SECTIONS or any(f.startswith("word=") for f in feats) else "plain"


class TreeModel:
    """Potentials of the labelled tree, as logs: ``node[feature] = (boilerplate, content)`` and
    ``edge[tie][parent][child]``."""

    def __init__(self, node: dict, edge: dict, prior: tuple[float, float]):
        self.node, self.edge, self.prior = node, edge, prior

    def marginals(self, nodes: list[tuple[int, list[str], str | None]]) -> list[float]:
        """Content probability of every node: one upward and one downward sweep."""
        n = len(nodes)
        own0, own1 = [0.0] * n, [0.0] * n
        for i, (_, feats, _) in enumerate(nodes):
            for f in feats:
                p = self.node.get(f)
                if p:
                    own0[i] += p[0]
                    own1[i] += p[1]
        own0[0] += self.prior[0]
        own1[0] += self.prior[1]
        up = [(0.0, 0.0)] * n
        for i in range(n - 1, 0, -1):  # children come after their parents
            parent, feats, text = nodes[i]
            e = self.edge[tie(feats, text)]
            m0 = _logadd(e[0][0] + own0[i], e[0][1] + own1[i])
            m1 = _logadd(e[1][0] + own0[i], e[1][1] + own1[i])
            up[i] = (m0, m1)
            own0[parent] += m0
            own1[parent] += m1
        out = [0.0] * n
        down = [(0.0, 0.0)] * n
        for i in range(n):
            b0, b1 = own0[i] + down[i][0], own1[i] + down[i][1]
            if i:
                parent, feats, text = nodes[i]
                e = self.edge[tie(feats, text)]
                p0 = own0[parent] + down[parent][0] - up[i][0]
                p1 = own1[parent] + down[parent][1] - up[i][1]
                d0, d1 = _logadd(p0 + e[0][0], p1 + e[1][0]), _logadd(p0 + e[0][1], p1 + e[1][1])
                top = max(d0, d1)
                down[i] = (d0 - top, d1 - top)
                b0, b1 = own0[i] + down[i][0], own1[i] + down[i][1]
            out[i] = 1.0 / (1.0 + math.exp(min(700.0, b0 - b1))) if b0 - b1 < 700 else 0.0
        return out

    def text(self, html: str | None) -> str:
        page = parse(html)
        if len(page.nodes) == 1:
            return ""
        p = self.marginals(page.nodes)
        return "\n".join(t for (_, _, t), q in zip(page.nodes, p) if t is not None and q >= 0.5)


def _logadd(a: float, b: float) -> float:
    hi, lo = (a, b) if a > b else (b, a)
    return hi + math.log1p(math.exp(lo - hi)) if lo - hi > -700 else hi


def fit(pages: list[str], smooth: float = 0.5) -> TreeModel:
    """Potentials from labelled pages; a leaf or unlabelled block has the label of its parent."""
    seen = defaultdict(lambda: [0, 0])
    total = {"leaf": [0, 0], "block": [0, 0]}
    edge = {k: [[smooth, smooth], [smooth, smooth]] for k in ("leaf", "plain", "named")}
    prior = Counter()
    for html in pages:
        page = parse(html)
        y = page.labels
        y[0] = 1
        for i, (parent, feats, text) in enumerate(page.nodes):
            if y[i] is None:
                y[i] = y[parent]
            total["leaf" if text is not None else "block"][y[i]] += 1
            for f in feats:
                seen[f][y[i]] += 1
            if i:
                edge[tie(feats, text)][y[parent]][y[i]] += 1
            else:
                prior[y[0]] += 1
    node = {}
    for f, (a, b) in seen.items():
        t = total["leaf" if f.split("=")[0] in ("leaf", "len", "links") else "block"]
        node[f] = (math.log((a + smooth) / (t[0] + 2 * smooth)), math.log((b + smooth) / (t[1] + 2 * smooth)))
    logs = {k: [[math.log(x / sum(row)) for x in row] for row in v] for k, v in edge.items()}
    return TreeModel(node, logs, (math.log(smooth), math.log(prior[1] + smooth)))


def extract(df: DataFrame, model: TreeModel, keep: list[str], html: str = "html") -> DataFrame:
    """The ``keep`` columns, ``text`` and ``n_chars`` (code points), one row per input row; other columns
    are ignored."""
    src = df.select(*keep, F.col(html).alias("_in"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*keep).schema) + ", text string, n_chars bigint"

    def run(batches):
        for b in batches:
            texts = [model.text(h) for h in b.column(len(keep)).to_pylist()]
            arrays = [*(b.column(i) for i in range(len(keep))), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, names=[*keep, "text", "n_chars"])

    return src.mapInArrow(run, schema)
