"""Main text of raw HTML pages from flat text blocks.

A page is cut into text blocks at block-level tags. Each block has its word
count and link density and those of its neighbours, and what its enclosing tags
and their class and id names say; a wrapper around the article or most of the
words says nothing. A decision tree, trained by Spark ML on a small labelled
table (the blocks of LABELLED_PAGES made-up pages of many layouts), tells main
text from the rest; it is a few dozen nodes and is applied where the page is cut.

Defined results: a null or empty page has the empty text; unclosed and
unmatched tags, a page cut off in a tag, comment or script, and plain text
without tags are read as far as they go; repeated rows agree; a null id or url
is returned as it is; an empty table gives an empty result; extra columns are
ignored.
"""

from __future__ import annotations

import html
import random
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*+(?:>|\Z)|</[^a-zA-Z>][^>]*+(?:>|\Z)"
    # A quote opens a value only after an equals sign.
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')|=)*+)(?:>|\Z)",
    re.S,
)
_ATTR = re.compile(r"(?:^|[\s\"'/])(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_SPACE = re.compile(r"\s+")
#: Tags whose content is never text of the page.
RAW = {"script", "style", "template", "svg", "iframe", "textarea", "select", "button", "head", "title", "canvas", "audio", "video"}
INLINE = {
    "a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img", "ins", "kbd", "label", "mark", "q", "ruby", "rt", "rp", "s", "samp", "small",
    "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr", "input", "br", "noscript", "object",
    "math", "mi", "mn", "mo", "ms", "mtext", "mrow", "mfrac", "msqrt", "mroot", "msub", "msup", "msubsup", "semantics", "annotation",
}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
#: Elements that stand beside the article, and names that mark such parts as a whole word of a class or id:
#: alone, after a word of place or before a word of make-up, so that has-sidebar or no-comments mark nothing.
BESIDE = {"nav", "header", "footer", "aside", "form", "menu", "dialog", "fieldset"}
HINT = re.compile(
    r"(?:(?:site|page|main|top|bottom|left|right|global|primary|secondary|sticky|mobile|the|js|post|entry|article|blog|user|reader|google|block)-)*"
    r"(?:ads?|adverts?|advertisement|advertising|adsbygoogle|sponsor(?:ed)?|promo(?:tion)?s?|banner|cookies?|consent|gdpr|notice|notification|alert|popup|modal|overlay"
    r"|nav|navbar|navigation|menu|breadcrumbs?|header|masthead|footer|foot|sidebar|side|aside|widgets?|related|recommended|recommendations|share|sharing|social"
    r"|comments?|commentlist|replies|respond|discussion|disqus|newsletter|subscribe|subscription|signup|login|search|toolbar|pagination|pager|tags|copyright|legal|disclaimer"
    r"|outbrain|taboola|complementary|contentinfo)"
    r"(?:-?(?:list|box|bar|section|area|block|wrap|wrapper|container|inner|outer|left|right|top|bottom|links?|menu|main|nav|body|content|form|thread|item|panel|message|text|slot|unit|posts?|articles?|stories|\d+))*"
)
#: Names of an article's own header, which holds its title.
OWN_HEADER = re.compile(r"(?:post|entry|article|story)-(?:header|head)(?:-(?:inner|wrap|wrapper|container|content))?")
GOOD = {"article", "main"}
HEADING = {"h1", "h2", "h3", "h4", "h5", "h6"}
#: Tags an open p ends at, and the tags that a repeated one of them closes.
ENDS_P = {"p", "div", "ul", "ol", "dl", "table", "section", "article", "aside", "header", "footer", "nav", "form", "blockquote", "pre", "h1", "h2", "h3", "h4", "h5", "h6", "hr", "main", "figure", "figcaption"}
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
#: Pages of the labelled table that the tree is trained on.
LABELLED_PAGES = 400
FEATURES = ("words", "density", "words_before", "density_before", "words_after", "density_after", "beside", "hinted", "in_article", "heading", "page_has_article")


def hinted(attributes: str) -> bool:
    names = [word for _, *values in _ATTR.findall(attributes) for word in "".join(values).lower().replace("_", "-").split()]
    return any(HINT.fullmatch(word) and not OWN_HEADER.fullmatch(word) for word in names)


class Element:
    """An open element: its tag, its place among all elements, what its names say, the first block in it and the open links, headings and so on in it."""

    __slots__ = ("tag", "beside", "hinted", "good", "parent", "begin", "end")

    def __init__(self, tag: str, beside: bool, is_hinted: bool, good: bool, parent: int, begin: int):
        self.tag, self.beside, self.hinted, self.good, self.parent, self.begin, self.end = tag, beside, is_hinted, good, parent, begin, -1


class Cutter:
    """Cuts a page into text blocks; every step takes time in proportion to the page."""

    def __init__(self) -> None:
        self.out: list[dict] = []
        self.elements: list[Element] = []
        self.stack: list[int] = []  # numbers of the open elements
        self.outer: list[int] = []  # places in the stack of those that are not inline
        self.open: dict[str, int] = {}
        self.headings = 0
        self.missing: set[str] = set()  # patterns that do not occur further on
        self.text: list[tuple[str, bool]] = []

    def flush(self) -> None:
        joined = _SPACE.sub(" ", "".join(t for t, _ in self.text)).strip()
        if joined:
            linked = sum(len(t.split()) for t, inside in self.text if inside)
            words = len(joined.split())
            self.out.append({"text": joined, "words": float(words), "density": min(1.0, linked / words), "heading": float(self.headings > 0), "inside": self.stack[-1] if self.stack else -1})
        self.text.clear()

    def push(self, tag: str, attributes: str) -> None:
        inside = self.open.get("article", 0) + self.open.get("main", 0)
        # An article's own header holds its title.
        beside = tag in BESIDE and not (inside and tag == "header")
        known = hinted(attributes) and tag not in ("body", "html", "main") if attributes and tag not in INLINE else False
        if tag not in INLINE:
            self.outer.append(len(self.stack))
        self.elements.append(Element(tag, beside, known, tag in GOOD, self.stack[-1] if self.stack else -1, len(self.out)))
        self.stack.append(len(self.elements) - 1)
        self.open[tag] = self.open.get(tag, 0) + 1
        self.headings += tag in HEADING

    def pop(self) -> str:
        element = self.elements[self.stack.pop()]
        element.end = len(self.out)
        if self.outer and self.outer[-1] == len(self.stack):
            self.outer.pop()
        self.open[element.tag] -= 1
        self.headings -= element.tag in HEADING
        return element.tag

    def close(self, tag: str) -> None:
        if self.open.get(tag):
            while self.pop() != tag:
                pass

    def close_implied(self, tags: tuple[str, ...]) -> None:
        """End the innermost element that is not inline if it is one of tags."""
        while self.outer and self.elements[self.stack[self.outer[-1]]].tag in tags:
            self.close(self.elements[self.stack[self.outer[-1]]].tag)

    def ahead(self, pattern: str, page: str, at: int) -> re.Match | None:
        """The next match; where there was none once, there is none further on."""
        found = None if pattern in self.missing else re.compile(pattern, re.I).search(page, at)
        if not found:
            self.missing.add(pattern)
        return found

    def skip_open(self, name: str, page: str, at: int) -> int:
        """Where an element without an end tag ends: a head at the body, a script or style at the page's end, a button at once."""
        body = self.ahead(r"<(?:body|article|main|div|p|h1|nav|header)\b", page, at) if name == "head" else None
        if body:
            return body.start()
        return at if name in ("head", "button", "title") else len(page)

    def cut(self, page: str) -> None:
        at, end = 0, len(page)
        while at < end:
            m = _TOKEN.search(page, at)
            stop = m.start() if m else end
            if stop > at:
                self.text.append((html.unescape(page[at:stop]), self.open.get("a", 0) > 0))
            if not m:
                break
            at = m.end()
            tag = (m[2] or "").lower()
            if not tag:
                continue
            if tag in RAW:
                if not m[1]:
                    if tag not in ("button", "svg"):
                        self.flush()
                    ends = self.ahead(f"</{tag}(?=[\\s/>])[^>]*>", page, at)
                    at = ends.end() if ends else self.skip_open(tag, page, at)
                continue
            if tag == "br":
                self.text.append((" ", False))
            if tag not in INLINE:
                self.flush()
            if m[1]:
                self.close(tag)
                continue
            if tag in VOID:
                continue
            if tag in ENDS_P:
                self.close_implied(("p",))
            elif tag in CLOSES:
                self.close_implied(("p", *CLOSES[tag]))
            elif tag == "a":
                self.close("a")  # links do not nest
            self.push(tag, m[3])
        self.flush()
        while self.stack:
            self.pop()


def blocks(page: str) -> list[dict]:
    """The text blocks of a page in order, with the features of FEATURES."""
    cutter = Cutter()
    cutter.cut(page.replace("\x00", ""))
    out, elements = cutter.out, cutter.elements
    sums = [0.0]
    for b in out:
        sums.append(sums[-1] + b["words"] * (1 - b["density"]))
    titles = [e for e in elements if e.good or e.tag == "h1"]
    opening, closing = sorted(e.begin for e in titles), sorted(e.end for e in titles)
    flags: list[tuple[bool, bool, bool]] = []
    for e in elements:
        beside, known, inside = flags[e.parent] if e.parent >= 0 else (False, False, False)
        if e.beside or e.hinted:
            # A wrapper around the article or most of the page's words says nothing about what is in it.
            outside = any(x.begin < e.begin or x.end > e.end for x in titles) if len(titles) <= 8 else opening[0] < e.begin or closing[-1] > e.end
            wrapper = not outside and (sums[e.end] - sums[e.begin]) * 2 > sums[-1]
            beside, known = beside or (e.beside and not wrapper), known or (e.hinted and not wrapper)
        flags.append((beside, known, inside or (e.good and not beside and not known)))
    has_article = float(any(f[2] for f in flags))
    none = {"words": 0.0, "density": 0.0}
    for i, b in enumerate(out):
        before, after = out[i - 1] if i else none, out[i + 1] if i + 1 < len(out) else none
        beside, known, inside = flags[b["inside"]] if b["inside"] >= 0 else (False, False, False)
        b |= {
            "words_before": before["words"], "density_before": before["density"], "words_after": after["words"], "density_after": after["density"],
            "beside": float(beside), "hinted": float(known), "in_article": float(inside), "page_has_article": has_article,
        }
    return out


def _prose(draw: random.Random, words: int) -> str:
    """So many made-up words, now and then with a stop."""
    return " ".join("".join(draw.choices(("ka", "lo", "mi", "ten", "ra", "sul", "o"), k=draw.randint(1, 4))) + draw.choice(("", "", "", "", "", "", ",", ".")) for _ in range(words))


def labelled_page(draw: random.Random) -> str:
    """A made-up page of one of many layouts; main blocks begin with *."""
    few, some, many = (lambda: _prose(draw, draw.randint(1, 5))), (lambda: _prose(draw, draw.randint(6, 20))), (lambda: _prose(draw, draw.randint(20, 160)))
    links = lambda: "".join(f'<li><a href="/{i}">{few()}</a></li>' for i in range(draw.randint(2, 9)))
    main = [f"<h1>*{few() if draw.random() < 0.5 else some()}</h1>"] if draw.random() < 0.9 else []
    for _ in range(draw.randint(2, 14)):
        main.append(draw.choice((
            lambda: f"<p>*{many()}</p>", lambda: f"<p>*{many()}</p>", lambda: f"<p>*{many()}<br>{some()}</p>", lambda: f"<p>*{some()}</p>", lambda: f"<p>*{few()}</p>",
            lambda: f"<h2>*{few()}</h2><p>*{many()}</p>", lambda: f"<ul><li>*{few()}</li><li>*{some()}</li></ul>", lambda: f"<blockquote>*{some()}</blockquote>",
            lambda: f"<p>*{many()} <a href='/x'>{few()}</a> {some()}</p>", lambda: f"<figure><img src='x'><figcaption>*{some()}</figcaption></figure>", lambda: f"<pre>*{some()}</pre>",
            lambda: f"<table><tr><td>*{few()}</td><td>*{few()}</td></tr></table>",
        ))())
    aside = draw.choice((
        lambda: f"<aside><h3>{few()}</h3><p>{some()}</p></aside>", lambda: f"<div class='related-posts'><ul>{links()}</ul></div>", lambda: f"<div class='ad'>{some()}</div>",
        lambda: f"<div class='newsletter-box'><p>{some()}</p></div>", lambda: "", lambda: "", lambda: f"<form><p>{few()}</p><label>{few()}</label></form>",
    ))
    if draw.random() < 0.4:
        main.insert(draw.randint(1, len(main)), aside())
    body = "".join(main)
    comments = "".join(f"<li><div><p>{few()}</p><p>{draw.choice((some, many))()}</p></div></li>" for _ in range(draw.randint(1, 6)))
    after = draw.choice(("", "", f"<section id='comments'><h3>{few()}</h3><ol class='comment-list'>{comments}</ol></section>", f"<div class='share'>{few()}</div>", f"<div id='disqus_thread'><p>{many()}</p></div>"))
    top = draw.choice((f"<nav><ul>{links()}</ul></nav>", f"<header><a href='/'>{few()}</a><p>{few()}</p></header><nav>{links()}</nav>", f"<div id='menu'><ul>{links()}</ul></div>", f"<ul>{links()}</ul>", f"<header><p>{some()}</p></header>"))
    top += draw.choice(("", "", f"<div class='cookie-notice'><p>{draw.choice((some, many))()}</p></div>", f"<div class='ad'>{some()}</div>", f"<div class='sidebar'><h3>{few()}</h3><p>{some()}</p></div>"))
    bottom = draw.choice(("", f"<footer><p>{draw.choice((few, some, many))()}</p></footer>", f"<div class='footer'><p>{some()}</p><ul>{links()}</ul></div>", f"<footer>{few()} <a href='/'>{few()}</a></footer>"))
    wrap = draw.choice(("<article>{}</article>{}", "<article class='post no-comments'>{}{}</article>", "<main>{}</main>{}", "<main><article>{}</article>{}</main>", "<div class='content'>{}</div>{}", "<div>{}</div>{}", "<section>{}</section>{}"))
    return draw.choice(("{}{}{}", "{}{}{}", "<div class='layout has-sidebar'>{}{}{}</div>", "<form id='page'>{}{}{}</form>")).format(top, wrap.format(body, after), bottom)


def labelled_blocks(pages: int = LABELLED_PAGES, seed: int = 1) -> list[tuple[list[float], float]]:
    """The features and labels of the blocks of so many made-up pages."""
    rows, draw = [], random.Random(seed)
    for _ in range(pages):
        for b in blocks(labelled_page(draw)):
            rows.append(([b[f] for f in FEATURES], float(b["text"].startswith("*"))))
    return rows


def train(spark: SparkSession, depth: int = 8) -> list[tuple[int, float, int, int, float]]:
    """The tree's nodes (feature, threshold, left, right, label); a leaf has feature -1."""
    from pyspark.ml.classification import DecisionTreeClassifier
    from pyspark.ml.linalg import Vectors

    rows = spark.createDataFrame([(Vectors.dense(x), y) for x, y in labelled_blocks()], ["features", "label"])
    model = DecisionTreeClassifier(maxDepth=depth, minInstancesPerNode=3, seed=7).fit(rows.coalesce(1))
    nodes: list[tuple[int, float, int, int, float]] = []

    def walk(node) -> int:
        me = len(nodes)
        nodes.append((-1, 0.0, -1, -1, node.prediction()))
        if "InternalNode" in node.getClass().getSimpleName():
            split = node.split()
            left, right = walk(node.leftChild()), walk(node.rightChild())
            nodes[me] = (split.featureIndex(), split.threshold(), left, right, node.prediction())
        return me

    walk(model._java_obj.rootNode())
    return nodes


def is_main(nodes: list[tuple], block: dict) -> bool:
    k = 0
    while nodes[k][0] >= 0:
        feature, threshold, left, right, _ = nodes[k]
        k = left if block[FEATURES[feature]] <= threshold else right
    return nodes[k][4] > 0.5


def main_text(nodes: list[tuple], page: str | None) -> str:
    return "\n\n".join(b["text"] for b in blocks(page) if is_main(nodes, b)) if page else ""


def extract(pages: DataFrame, nodes: list[tuple] | None = None) -> DataFrame:
    """page_id, url, text and n_chars of every page; nodes: a tree of train()'s form."""
    tree = nodes or train(pages.sparkSession)
    rows = pages.select("page_id", "url", F.col("html").cast("string").alias("html"))
    schema = rows.select("page_id", "url").schema.add("text", "string").add("n_chars", "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(tree, p) for p in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], names=schema.names
            )

    return rows.mapInArrow(run, schema)
