"""Main text of web pages by a site style tree.

The element trees of all pages of a host are merged by style: an element's path of tags and class names. For each node
of the merged tree two entropies tell how much it varies over the pages that have it, each divided by the largest
possible one. Its presentation has the entropy of the sequence of styles below it. Its content is made of features: the
text runs between tags, cut at sentence ends and separators. A feature of a leaf has the entropy of its occurrences over
the leaf's pages, so that one on every page has importance 0 and one on a single page 1; a leaf's content importance is
the mean over all occurrences, and a node's the mean over those of all leaves below it. One varying word or link thus
does not make a menu look unique. The importance of a node is a mixture of the two; a node that looks and reads the same
on page after page has one near 0. Branches in which every node is of low importance are removed from each page, inside articles too. A prior by tag, role and class or id words is the other
input: chrome (navigation, footers, adverts, forms, reader comments) has importance 0, prose tags without class inside an
article 1, so that a passage repeated in many articles of a host stays; where the article as a whole repeats, nothing in
it can be told apart, and it stays whole. A class or id word alone is a hint that a high importance overrules, except
words for parts that differ from page to page by nature (comments, related, adverts).

The articles of a page count if they hold text. An article is not chrome because of what it stands in, unless that is a
list of other articles (comments, related, nav, aside, footer); those count last, when nothing else on the page is left.
Without articles the rest of the page is judged. An article element with nothing in it at all gives an empty text.

Styles are told apart down to DEPTH nested elements; what is nested deeper counts to its ancestor there. Its text is read
like any other, in time in proportion to the page.

Inside a block white space becomes one space; blocks are joined by line breaks in page order. Null or empty pages give
an empty text, broken markup is read up to its end, pages without a host are judged by the prior alone. Repeated rows
give repeated results. A hot host's features are counted on the way, one row per page and node; its pages stay spread.
"""

from __future__ import annotations

import hashlib
import html
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from loanscope.llm.shared import written

#: Share of the content entropy in the mixture; importance below LOW on at least PAGES pages removes a node.
CONTENT, LOW, PAGES = 0.9, 0.2, 4
#: Importance from which a node is text although a class or id word calls it chrome.
HIGH = 0.8

#: Nested elements whose styles are told apart, and the characters of class names from which a digest stands for them.
DEPTH, LONG = 100, 200

# Fixed word lists of the prior.
CHROME_TAGS = frozenset("nav footer aside form button select input textarea option dialog menu head title script style noscript template iframe svg canvas object math audio video".split())
CHROME_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies footer header "
    "login masthead menu modal nav navbar navigation newsletter notice notices popup promo related search share sharing sidebar social "
    "sponsor sponsored subscribe widget".split()
)
#: Words for parts that differ from page to page, so that entropies say nothing against them.
VARYING = frozenset("ad ads advert adverts advertisement advertising breadcrumb breadcrumbs comment comments promo related sponsor sponsored".split())
CHROME_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert form menu".split())
ARTICLE_TAGS = frozenset(("article", "main"))
#: Chrome that may stand around a page's own article, and tags that are prose inside one.
WRAPPERS = frozenset("form header dialog".split())
PROSE = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe xmp".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split()
)
#: Elements that an opening tag ends, up to the nearest of the second list.
ENDS = {
    **dict.fromkeys(
        "p div ul ol dl table h1 h2 h3 h4 h5 h6 section article aside nav header footer main form blockquote pre address figure hr".split(), ({"p"}, {"article", "section", "div", "td", "th", "li", "blockquote", "body", "main", "button"})
    ),
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"}),
}
_TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<[!?][^>]*+(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)(?:>|\Z)""", re.S
)
_ATTRIBUTE = re.compile(r"""\b(class|id|role)\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s>"']++))""", re.I)
_PARTS = re.compile(r"[^a-z0-9]+")
#: Where one content feature ends in a run with single spaces: sentence ends, and signs that stand alone between entries.
_FEATURE = re.compile(r" (?:(?<=[.!?…] )|[|·•»›–—/-]+ )")


class Element:
    """hard, soft: chrome since the innermost article, for good or by a word of the style paths listed.

    article: the path of the innermost article; outer: that article stands in a list of other articles (boxed).
    """

    __slots__ = ("tag", "path", "depth", "hard", "soft", "article", "boxed", "outer", "chrome")

    def __init__(self, tag: str, attributes: str, parent: Element | None):
        words, role, classes = set(), "", ""
        for m in _ATTRIBUTE.finditer(attributes):
            value = (m[2] or m[3] or m[4] or "").lower()
            if m[1].lower() == "role":
                role = value.strip()
            else:
                words.update(_PARTS.split(value))
                if m[1].lower() == "class":
                    classes = " ".join(sorted(value.split()))
        within = parent is not None and parent.article is not None
        article, page = tag in ARTICLE_TAGS or role in ARTICLE_TAGS, tag in ("body", "html")
        # the body's class names speak of the page as a whole; an article's only where they name another kind of article
        own = set() if page else words & (VARYING if article else CHROME_WORDS)
        if within:
            own.discard("header")  # like the tag
        hints = own - VARYING
        named = not page and not article and role in CHROME_ROLES
        hard = tag in CHROME_TAGS or named or (tag == "header" and not within) or bool(own & VARYING)
        self.tag, self.depth = tag, parent.depth + 1 if parent else 1
        if parent and parent.depth >= DEPTH:
            self.path = parent.path
        else:
            classes = re.sub("[0-9]+", "#", classes).replace("/", "|")
            if len(classes) > LONG:
                classes = hashlib.blake2b(classes.encode("utf-8", "surrogatepass"), digest_size=8).hexdigest()
            style = f"{tag[:LONG]}.{classes}" if classes else tag[:LONG]
            if hints:
                style += "!" + "-".join(sorted(hints))
            self.path = f"{parent.path}/{style}" if parent else style
        boxed = parent is not None and parent.boxed
        if article and not own:
            self.hard, self.soft, self.article = False, (), self.path
            self.outer = boxed or (parent is not None and parent.outer)
        else:
            self.hard = hard or (parent is not None and parent.hard)
            self.soft = parent.soft if parent else ()
            if hints and self.path not in self.soft:
                self.soft += (self.path,)
            self.article, self.outer = (parent.article, parent.outer) if parent else (None, False)
        self.boxed = boxed or (hard and tag not in WRAPPERS and role != "form")
        self.chrome = self.outer or self.hard or bool(self.soft)


def blocks(page: str, articles: list[Element] | None = None) -> Iterator[tuple[Element, str, list[str]]]:
    """The text blocks of a page with the innermost block element each stands in, and the block's text runs as written.

    `articles` takes the article elements.
    """
    root = Element("body", "", None)
    stack: list[Element] = [root]
    around: list[Element] = [root]  # those of the stack that are no inline elements
    opened: Counter[str] = Counter()  # tags in the stack but for the root
    text: list[str] = []
    outside: list[str] = []  # of the block around an inline element that goes
    at, low = 0, None

    def flush() -> Iterator[tuple[Element, str, list[str]]]:
        words = " ".join(html.unescape("".join(text)).split())
        runs = text[:] if words else []
        text.clear()
        if words:
            yield around[-1], words, runs

    def push(element: Element) -> None:
        stack.append(element)
        opened[element.tag] += 1
        if element.tag not in INLINE:
            around.append(element)

    def cut(k: int) -> None:
        while len(stack) > k:
            element = stack.pop()
            opened[element.tag] -= 1
            if element.tag not in INLINE:
                around.pop()

    def innermost(tags: set[str]) -> int:
        return next(k for k in range(len(stack) - 1, 0, -1) if stack[k].tag in tags)

    while at < len(page):
        m = _TOKEN.search(page, at)
        if m is None:
            text.append(page[at:])
            break
        text.append(page[at : m.start()])
        at = m.end()
        tag = (m[2] or m[5] or "").lower()
        closing, attributes = m[1] or m[4], m[3] or m[6] or ""
        if not tag:
            continue
        if tag in INLINE:
            if tag in ("br", "img", "wbr"):
                text.append(" " if tag == "br" else "")
            elif not closing:
                element = Element(tag, attributes, stack[-1])
                if element.chrome and not stack[-1].chrome:
                    outside, text = text, outside
                push(element)
            elif opened[tag] and stack[-1].tag in INLINE:
                k = len(stack) - 1
                while stack[k].tag != tag and stack[k].tag in INLINE:
                    k -= 1
                if stack[k].tag == tag:
                    if stack[-1].chrome and not stack[k - 1].chrome:
                        text.clear()
                        outside, text = text, outside
                    cut(k)
            continue
        if outside:
            text = outside
            outside = []
        yield from flush()
        if closing:
            if opened[tag]:
                cut(innermost({tag}))
            continue
        if tag in ("html", "body"):
            continue
        ended, limit = ENDS.get(tag, ((), ()))
        if any(opened[x] for x in ended):
            near = next(x.tag for x in reversed(around) if x.tag in ended or x.tag in limit)
            if near in ended:
                cut(innermost({near}))
        if tag in VOID:
            continue
        if tag in RAW:
            low = page.lower() if low is None else low
            low = low if len(low) == len(page) else re.sub("[A-Z]", lambda c: c[0].lower(), page)
            end = low.find(f"</{tag}", at)
            at = len(page) if end < 0 else end
            push(Element(tag, attributes, stack[-1]))
            continue
        if not attributes.endswith("/") or tag in ARTICLE_TAGS:
            push(Element(tag, attributes, stack[-1]))
            if articles is not None and stack[-1].article == stack[-1].path and not stack[-1].outer:
                articles.append(stack[-1])
    text = outside or text
    yield from flush()


def _digest(text: str) -> int:
    return _signed(xxhash.xxh3_64_intdigest(text.encode("utf-8", "surrogatepass")))


def _signed(number: int) -> int:
    return number - (1 << 64) if number >> 63 else number


def features(runs: list[str]) -> list[str]:
    """The content features of a block's text runs."""
    found: list[str] = []
    for run in runs:
        if words := " ".join((html.unescape(run) if "&" in run else run).split()):
            found += _FEATURE.split(words)
    return [x for x in found if x]


def node_features(page: str) -> tuple[dict[str, int], dict[str, Counter[int]]]:
    """For each style path of a page a hash of its presentation, and for each leaf how often it has which features."""
    looks: dict[str, xxhash.xxh3_64] = {}
    reads: dict[str, list[str]] = {}
    over: dict[str, tuple[bytes, list[xxhash.xxh3_64]]] = {}
    for element, _, runs in blocks(page):
        path = element.path
        if path not in over:
            nodes = [path[: m.start()] for m in re.finditer("/", path)] + [path]
            over[path] = _digest(path).to_bytes(8, "little", signed=True), [looks.setdefault(n, xxhash.xxh3_64()) for n in nodes]
        style, nodes = over[path]
        for node in nodes:
            node.update(style)
        reads.setdefault(path, []).extend(features(runs))
    return {node: _signed(h.intdigest()) for node, h in looks.items()}, {leaf: Counter(map(_digest, found)) for leaf, found in reads.items()}


def main_text(page: str, removed: frozenset[str] = frozenset(), kept: frozenset[str] = frozenset()) -> str:
    """The blocks that stay: those of articles if these hold any, none below a chrome element or a removed style.

    removed, kept: the host's style paths of low importance, and those that a word calls chrome but are of high one.
    """
    articles: list[Element] = []
    every = [(e, w) for e, w, _ in blocks(page, articles)]

    known: dict[tuple[str, str], bool] = {}

    def gone(e: Element) -> bool:
        key = e.path, e.article or ""
        if key not in known:
            known[key] = below(*key)
        return known[key]

    def below(path: str, top: str) -> bool:
        if top in removed:  # the article as a whole repeats
            return False
        while len(path) > len(top):
            if path in removed and not (top and path.rpartition("/")[2] in PROSE):
                return True
            path = path.rpartition("/")[0]
        return False

    clear = [(e, w) for e, w in every if not e.hard and not any(s not in kept for s in e.soft)]
    found = [(e, w) for e, w in clear if not e.outer and not gone(e)]
    inside = [w for e, w in found if e.article]
    if inside or articles and not any(e.article and not e.outer for e, _ in every):
        return "\n".join(inside)
    return "\n".join([w for _, w in found] or [w for e, w in clear if e.outer and not gone(e)])


def host_of(url: str) -> Column:
    """The host of a URL column in lower case; an empty text if there is none."""
    return F.lower(F.regexp_extract(F.coalesce(F.col(url).cast("string"), F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))


def _features(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of kind 0: pages n of a node with a presentation. Of kind 1: occurrences n of a feature, and sum n ln n over pages."""
    for batch in source:
        places: dict[tuple[str, str], int] = {}
        looked: Counter[tuple[int, int]] = Counter()
        read: Counter[tuple[int, int]] = Counter()
        within: dict[tuple[int, int], float] = {}
        for host, page in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            looks, reads = node_features(page or "")
            for node, value in looks.items():
                looked[places.setdefault((host, node), len(places)), value] += 1
            for node, found in reads.items():
                place = places[host, node]
                for value, c in found.items():
                    key = place, value
                    read[key] += c
                    if c > 1:
                        within[key] = within.get(key, 0.0) + c * math.log(c)
        hosts, nodes = (pa.array([p[k] for p in places], pa.string()) for k in (0, 1))
        for kind, n in enumerate((looked, read)):
            at = pa.array([place for place, _ in n], pa.int64())
            yield pa.record_batch(
                [
                    hosts.take(at), nodes.take(at), pa.array([kind] * len(n), pa.int32()), pa.array([value for _, value in n], pa.int64()),
                    pa.array(n.values(), pa.int64()), pa.array([within.get(key, 0.0) if kind else 0.0 for key in n], pa.float64()),
                ],
                names=["host", "node", "kind", "value", "n", "s"],
            )


def above(node: str) -> Column:
    """The paths of a node and of all nodes it stands in."""
    steps = F.split(node, "/")
    return F.transform(F.sequence(F.lit(1), F.size(steps)), lambda k: F.array_join(F.slice(steps, 1, k), "/"))


def importance(pages: DataFrame, url: str = "url", page: str = "html") -> DataFrame:
    """(host, node, pages, importance, most) of the merged style tree of every host; most: the largest of the leaves below."""
    rows = pages.select(host_of(url).alias("host"), F.col(page).cast("string").alias("html")).filter("host != ''")
    seen = rows.mapInArrow(_features, "host string, node string, kind int, value long, n long, s double")
    counts = seen.groupBy("host", "node", "kind", "value").agg(F.sum("n").alias("n"), F.sum("s").alias("s"))
    n_log_n = F.col("n") * F.log("n")
    nodes = counts.groupBy("host", "node").agg(
        F.sum(F.when(F.col("kind") == 0, F.col("n")).otherwise(0)).alias("m"),
        F.sum(F.when(F.col("kind") == 0, n_log_n).otherwise(0.0)).alias("same"),
        F.sum(F.when(F.col("kind") == 1, F.col("n")).otherwise(0)).alias("weight"),
        F.sum(F.when(F.col("kind") == 1, n_log_n - F.col("s")).otherwise(0.0)).alias("spread"),
    )
    # -sum p ln p over values is ln m - (sum n ln n) / m, over the pages of a feature ln n - s / n, both divided by ln m;
    # a node of one page is as important as can be
    many = F.col("m") > 1
    looks = F.when(many, 1 - F.col("same") / (F.col("m") * F.log("m"))).otherwise(1.0)
    reads = F.col("weight") - F.when(many, F.col("spread") / F.log("m")).otherwise(0.0)

    def mixed() -> Column:
        return CONTENT * F.try_divide("reads", "weight") + (1 - CONTENT) * F.col("looks")

    # each node once for every node above it, so that the pages are read once only
    own = nodes.select("host", "node", "m", looks.alias("looks"), reads.alias("reads"), "weight").withColumn("most", F.when(F.col("weight") > 0, mixed()))
    up = own.withColumn("over", F.explode(above("node")))
    mine = (F.max(F.when(F.col("node") == F.col("over"), F.col(c))).alias(c) for c in ("m", "looks"))
    found = up.groupBy("host", F.col("over").alias("node")).agg(*mine, F.sum("reads").alias("reads"), F.sum("weight").alias("weight"), F.max("most").alias("most"))
    # a run of signs only may be no feature; such a node reads the same everywhere
    return found.select("host", "node", F.col("m").alias("pages"), F.coalesce(mixed(), (1 - CONTENT) * F.col("looks")).alias("importance"), "most")


def main_texts(pages: DataFrame, key: str = "page_id", url: str = "url", page: str = "html", low: float = LOW, least: int = PAGES) -> DataFrame:
    """page_id, url, text, n_chars of every row of `pages`."""
    known = importance(pages, url, page).filter(F.col("pages") >= least)
    # a branch goes if all of it is of low importance
    is_low, hint = F.col("most") < low, F.col("node").rlike("![a-z-]+$")
    nodes = known.filter(is_low | (hint & (F.col("importance") >= HIGH)))
    # written, so that its size is known before the pages are read and a small table goes to them
    lists = (F.collect_set(F.when(is_low, F.col("node"))).alias("removed"), F.collect_set(F.when(~is_low, F.col("node"))).alias("kept"))
    removed = written(nodes.groupBy("host").agg(*lists))
    rows = pages.select(F.col(key).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"), host_of(url).alias("host"), F.col(page).cast("string").alias("html"))

    def task(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            columns = (batch.column(k).to_pylist() for k in (2, 3, 4))
            texts = [main_text(p or "", frozenset(r or ()), frozenset(k or ())) for p, r, k in zip(*columns)]
            yield pa.record_batch(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=["page_id", "url", "text", "n_chars"],
            )

    joined = rows.join(removed, "host", "left").select("page_id", "url", "html", "removed", "kept")
    return joined.mapInArrow(task, "page_id long, url string, text string, n_chars long")
