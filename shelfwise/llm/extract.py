"""Main text of web pages by tree scoring.

Paragraphs pass points to all elements around them, for their length and their commas: all of them
to the parent, half to the grandparent, half of that to each one above. An element's points are
discounted by the share of its text that is in links. From the best container the choice goes up to
the element that holds all parts of the text. It and those of its siblings that also score are kept.
"""

from __future__ import annotations

import html as references
import re

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from shelfwise.llm.common import map_text, strings

# Attributes as HTML reads them: a quote opens a string only right after "="; elsewhere it is an
# ordinary character. So is one whose string never ends, lest it take the rest of the page.
_VALUE = r""""([^"]*+)"|'([^']*+)'|([^\s>]*+)"""
_ATTRIBUTE = re.compile(rf"([^\s/>][^\s/>=]*+)(?:\s*+=\s*+(?:{_VALUE}))?+")
_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)"
    r"((?:[\s/]++|[^\s/>][^\s/>=]*+(?:\s*+=\s*+(?:\"[^\"]*+\"|'[^']*+'|[^\s>]*+))?+)*+)(?:>|\Z)",
    re.S,
)
_SPACE = re.compile(r"\s+")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# Elements whose content is text up to their own end tag.
RAW = frozenset("script style textarea title noscript xmp iframe noframes".split())
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption"
    " figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre section"
    " summary table tbody td tfoot th thead tr ul caption".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
PARAGRAPHS = frozenset("p pre td blockquote li dd".split())
DROPPED = frozenset(
    "head nav header footer aside script style noscript template iframe object button select"
    " textarea input svg canvas title menu dialog noframes option".split()
)
# A start tag of the key ends an open element of the values, up to the nearest of the fences.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
CLOSES_P = BLOCKS - {"html", "body", "tr", "td", "th", "tbody", "thead", "tfoot", "caption"}
INLINE = frozenset(
    "a abbr b bdi bdo big cite code del dfn em font i ins kbd mark q s samp small span strike strong"
    " sub sup tt u var time".split()
)

# Left out like elements with a name of boilerplate, but a page may stand in a form as a whole. Such
# a form has more points than an invitation to fill it in.
FORMS = frozenset(["form", "label"])
FORM_NAME, FORM_POINTS = "signup", 5.0

# Words in class, id or role that tell what an element is for.
_WORDS = (
    r"ad|ads|advert\w*|adbox|adsense|banner|breadcrumbs?|byline-share|combx|comments?|"
    r"commentlist|contentinfo|cookies?|consent|disqus|foot|footer|gdpr|header|legal|masthead|menu|"
    r"modal|nav|navbar|navigation|newsletter|notice|outbrain|pager|pagination|popup|promo\w*|"
    r"related\w*|replies|reply|respond|rss|share|sharing|shoutbox|sidebar\w*|skyscraper|social|"
    r"sponsor\w*|subscribe|taboola|toolbar|widgets?|complementary|dialog|alert|search|"
    r"signup|login|remark\w*"
)
_BOILERPLATE = re.compile(
    rf"(?<![^\s_-])(?:{_WORDS})(?![^\s_-])|sidebar|comment|cookie|advert|newsletter", re.I
)
_EXACT = re.compile(rf"(?<!\S)(?:{_WORDS})(?!\S)", re.I)
# Readers' words, adverts and consents, which may well be longer than the text of the page.
_FOREIGN = re.compile(
    r"(?<![^\s_-])(?:ads?|adbox|adsense|\w*advert\w*|\w*comment(?!ar)\w*|\w*cookies?|consent|gdpr|disqus|"
    r"outbrain|taboola|replies|reply|respond|sponsor\w*)(?![^\s_-])",
    re.I,
)
# Parts of a class that tell what is in or beside an element, or what a post is about.
_MODIFIER = re.compile(
    r"(?<![^\s_-])(?:(?:has|no|with|without|category|tag)[_-]\S+"
    r"|comments?[_-](?:open|closed|enabled|disabled|off)(?!\S))",
    re.I,
)
_SAYS_CONTENT = re.compile(
    r"(?<![^\s_-])(?:article|content|main|post|entry|story"
    r"|(?:article|main|post|entry|story)(?:content|body|text))(?![^\s_-])",
    re.I,
)
_CONTENT = re.compile(r"(?:^|[\s_-])(?:article|content|main|body|entry|post|story|text|column)(?:$|[\s_-])", re.I)
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)

# A sibling is kept with this share of the best score, at least this many points.
SIBLING_SHARE, SIBLING_POINTS = 0.2, 2.0
PARAGRAPH_CHARS = 25
# A block with this share of its text in links is no part of the text.
LINKED_SHARE = 0.5
# An element named as boilerplate that holds more of the page's points is a wrapper of its text; the
# second share is for those that have such a name for themselves or stand in an article, and for
# names of several elements.
WRAPPER_SHARE, SURE_SHARE = 0.5, 0.8


class Node:
    __slots__ = ("tag", "attributes", "parent", "children", "score", "size", "linked", "commas")

    def __init__(self, tag: str, attributes: str, parent: Node | None):
        self.tag, self.attributes, self.parent = tag, attributes, parent
        self.children: list = []
        self.score, self.size, self.linked, self.commas = 0.0, 0, 0, 0


def attributes(text: str) -> dict[str, str]:
    found = {}
    for m in _ATTRIBUTE.finditer(text):
        found.setdefault(m[1].lower(), references.unescape(m[2] or m[3] or m[4] or ""))
    return found


def tree(page: str) -> Node:
    """The element tree of a page. Missing end tags are put in, stray ones are left out."""
    root = here = Node("#root", "", None)
    at = 0
    depth: dict[str, int] = {}

    def close(to: Node) -> Node:
        nonlocal here
        while here is not to:
            depth[here.tag] -= 1
            here = here.parent
        return here

    while True:
        m = _TAG.search(page, at)
        if m is None:
            break
        if m.start() > at:
            here.children.append(references.unescape(page[at:m.start()]))
        at = m.end()
        if m[2] is None:
            continue
        tag = m[2].lower()
        if m[1]:
            if depth.get(tag):
                node = here
                while node.tag != tag:
                    # An inline end tag does not reach out of its block.
                    if tag in INLINE and node.tag in BLOCKS:
                        node = None
                        break
                    node = node.parent
                if node is not None:
                    close(node.parent)
            continue
        if tag in CLOSES_P and depth.get("p"):
            node = here
            while node.tag != "p" and (node.tag in INLINE or node.tag == "#root"):
                if node.parent is None:
                    break
                node = node.parent
            if node.tag == "p":
                close(node.parent)
        if tag in HEADINGS and here.tag in HEADINGS:
            close(here.parent)
        if tag in CLOSES:
            closed, fences = CLOSES[tag]
            node, last = here, None
            while node.parent is not None and node.tag not in fences:
                if node.tag in closed:
                    last = node
                node = node.parent
            if last is not None:
                close(last.parent)
        node = Node(tag, m[3], here)
        here.children.append(node)
        if tag in VOID or m[3].endswith("/") and tag in ("svg", "path"):
            continue
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*(?:>|\Z)", re.I).search(page, at)
            at = end.end() if end else len(page)
            continue
        here = node
        depth[tag] = depth.get(tag, 0) + 1
    if at < len(page):
        here.children.append(references.unescape(page[at:]))
    return root


def _boilerplate(node: Node) -> bool | str:
    """True for what is never main text; else the element's names if they say boilerplate."""
    if node.tag == "header" and node.parent.tag in ("article", "main", "section"):
        # It holds the headline, unless it says that it belongs to the site.
        return bool(re.search("masthead|site|nav|banner|menu|top", node.attributes, re.I))
    if node.tag in DROPPED:
        return True
    if not node.attributes or node.tag in ("html", "body"):
        return FORM_NAME if node.tag in FORMS else False
    found = attributes(node.attributes)
    if "hidden" in found or found.get("aria-hidden") == "true":
        return True
    if "style" in found and _HIDDEN.search(found["style"]):
        return True
    if node.tag in ("article", "main"):
        return bool(re.search("comment|reply", f"{found.get('class', '')} {found.get('id', '')}", re.I))
    said = " ".join(found.get(k, "") for k in ("class", "id", "role"))
    if node.tag in FORMS:
        return f"{FORM_NAME} {said}"
    if not _BOILERPLATE.search(said):
        return False
    said = _MODIFIER.sub("", said)
    return said if _BOILERPLATE.search(said) else False


def prune(root: Node) -> None:
    """Takes out what is never main text: menus, forms, adverts, scripts and the like.

    An element that is only named so stays if it also says that it is content, or wraps the main
    element, the longest article or most of the page's paragraphs. So does a form around the page.
    """
    named: dict[int, str] = {}
    pending = [root]
    while pending:
        node = pending.pop()
        kept = []
        for c in node.children:
            if isinstance(c, str):
                kept.append(c)
            elif (says := _boilerplate(c)) is not True:
                kept.append(c)
                pending.append(c)
                if says:
                    named[id(c)] = says
        node.children = kept
    if named:
        spared = _spared(_ordered(root), named)
        pending = [root]
        while pending:
            node = pending.pop()
            node.children = [
                c for c in node.children if isinstance(c, str) or id(c) not in named or id(c) in spared
            ]
            pending += [c for c in node.children if not isinstance(c, str)]


def _spared(nodes: list[Node], named: dict[int, str]) -> set[int]:
    """Those of the named elements that hold the text of the page."""
    _measure(nodes)
    spared = set()
    texts = [n for n in nodes if n.tag == "main" and n.size]
    texts += sorted((n for n in nodes if n.tag == "article"), key=lambda n: -n.size)[:1]
    for node in texts:
        while node is not None and id(node) not in spared:
            spared.add(id(node))
            node = node.parent
    foreign = {i for i, said in named.items() if i not in spared and _FOREIGN.search(said)}
    for i, said in named.items():
        if i not in foreign and not _EXACT.search(said) and any(
            _SAYS_CONTENT.search(x) and not _BOILERPLATE.search(x) for x in said.split()
        ):
            spared.add(i)
    points = {id(n): _points(n) for n in nodes}
    held = _held(nodes, points, foreign)
    if not held[id(nodes[0])]:
        # Nothing is left without them.
        foreign = set()
        held = _held(nodes, points, foreign)
    total = held[id(nodes[0])]
    within: set[int] = set()
    forms = {id(n) for n in nodes if n.tag in FORMS}
    for node in nodes:
        if node.tag == "article" or id(node.parent) in within:
            within.add(id(node))
    for i, said in named.items():
        share = SURE_SHARE if i in within or _EXACT.search(said) else WRAPPER_SHARE
        if i not in foreign and held[i] > share * total and (
            i not in forms or held[i] >= FORM_POINTS
        ):
            spared.add(i)
    # A word that would take out most of the page in pieces tells nothing on this page.
    taken: dict[str, float] = {}
    over: dict[int, frozenset] = {}
    words = {
        i: frozenset(m[0].lower() for m in _BOILERPLATE.finditer(said))
        for i, said in named.items() if i not in spared and i not in foreign and not _EXACT.search(said)
    }
    if words:
        outside = {id(nodes[0])}
        for node in nodes:
            i, up = id(node), id(node.parent)
            if node.parent is not None and (up not in outside or i in foreign):
                continue
            outside.add(i)
            over[i] = over.get(up, frozenset()) | words.get(i, frozenset())
            for word in over[i]:
                taken[word] = taken.get(word, 0.0) + points[i]
        spared.update(
            i for i, all_of in words.items() if all(taken.get(w, 0.0) > SURE_SHARE * total for w in all_of)
        )
    return spared


def _ordered(root: Node) -> list[Node]:
    """All nodes, parents first."""
    found, pending = [], [root]
    while pending:
        node = pending.pop()
        found.append(node)
        pending += [c for c in node.children if not isinstance(c, str)]
    return found


def _measure(nodes: list[Node]) -> None:
    """Sizes of text and of linked text, and commas, of every node."""
    for node in reversed(nodes):
        node.size = node.linked = node.commas = 0
        for c in node.children:
            if isinstance(c, str):
                node.size += len(_SPACE.sub(" ", c).strip())
                node.commas += c.count(",")
            else:
                node.size += c.size
                node.commas += c.commas
                node.linked += c.size if c.tag == "a" else c.linked


def link_density(node: Node) -> float:
    return node.linked / node.size if node.size else 0.0


def _is_paragraph(node: Node) -> bool:
    return node.tag in PARAGRAPHS and not any(
        not isinstance(c, str) and c.tag in BLOCKS for c in node.children
    )


def _points(node: Node) -> float:
    """The points of a paragraph, or of the text that stands in a container without one."""
    if _is_paragraph(node):
        size, commas = node.size, node.commas
    elif node.tag in ("div", "section", "article", "main", "body", "form", "#root"):
        own = [c for c in node.children if isinstance(c, str)]
        size, commas = sum(len(x.strip()) for x in own), sum(x.count(",") for x in own)
    else:
        return 0.0
    if size < PARAGRAPH_CHARS:
        return 0.0
    return (1 + commas + min(size / 100, 3)) * (1 - link_density(node))


def _held(nodes: list[Node], points: dict[int, float], without: set[int]) -> dict[int, float]:
    """The points inside every node, less those of nodes of ``without`` further down."""
    held = dict(points)
    for node in reversed(nodes):
        if node.parent is not None and id(node) not in without:
            held[id(node.parent)] += held[id(node)]
    return held


def _score(nodes: list[Node]) -> dict[int, float]:
    """Scores all nodes; gives the points of all paragraphs inside each."""
    for node in nodes:
        if node.tag == "article":
            node.score += 10
        elif node.tag == "main" or node.attributes and node.tag in ("div", "section") and _CONTENT.search(
            " ".join(attributes(node.attributes).get(k, "") for k in ("class", "id"))
        ):
            node.score += 5
    points = {id(n): _points(n) for n in nodes}
    passed = dict.fromkeys(points, 0.0)
    for node in reversed(nodes):
        own, up = points[id(node)], node.parent
        if own and not _is_paragraph(node):
            passed[id(node)] += own
        node.score += passed[id(node)]
        if up is not None:
            passed[id(up)] += passed[id(node)] / 2
            if own and _is_paragraph(node):
                passed[id(up)] += own
    for node in nodes:
        node.score *= 1 - link_density(node)
    return _held(nodes, points, set())


def _widened(best: Node, held: dict[int, float]) -> Node:
    """The highest element around the best one whose other parts hold a fair share of the points.

    In the main element, and beside parts of the same kind (sections, or equal attributes), any
    share is fair. Parts that are mostly links are taken out of it.
    """
    top, inside, node = best, held[id(best)], best
    levels = []
    main = best.parent
    while main is not None and main.tag != "main":
        main = main.parent
    while node.parent is not None:
        up = node.parent
        levels.append((node, up))
        others = held[id(up)] - held[id(node)]
        linked = sum(held[id(c)] for c in up.children if c is not node and _is_links(c))
        fair = main is not None or others - linked >= SIBLING_SHARE * inside or any(
            _alike(node, c) and held[id(c)] >= SIBLING_POINTS and not _is_links(c) for c in up.children
        )
        if others - linked > 1e-6 and fair:
            top = up
            for child, parent in levels:
                parent.children = [c for c in parent.children if c is child or not _is_links(c)]
            levels.clear()
            inside += others - linked
        if up is main:
            main = None
        node = up
    top.score = max(top.score, best.score)
    return top


def _alike(node: Node, other) -> bool:
    return other is not node and not isinstance(other, str) and other.tag == node.tag and (
        node.tag == "section" or bool(node.attributes) and other.attributes == node.attributes
    )


def _is_links(node) -> bool:
    return (
        not isinstance(node, str) and node.tag in BLOCKS and node.tag not in HEADINGS
        and link_density(node) >= LINKED_SHARE
    )


def _joins(best: Node, sibling) -> bool:
    """Whether a sibling of the best container belongs to the text."""
    if sibling is best:
        return True
    if isinstance(sibling, str):
        return False
    if sibling.score >= max(SIBLING_POINTS, SIBLING_SHARE * best.score):
        return True
    if sibling.tag in HEADINGS:
        return True
    density = link_density(sibling)
    return sibling.tag in PARAGRAPHS and (
        sibling.size > 80 and density < 0.25 or 0 < sibling.size <= 80 and not sibling.linked
    )


def _blocks(roots: list, out: list[str]) -> None:
    """The text of blocks in page order: white space as one space, empty blocks left out."""
    parts: list[str] = []

    def flush():
        text = _SPACE.sub(" ", "".join(parts)).strip()
        parts.clear()
        if text:
            out.append(text)

    pending = [(c, False) for c in reversed(roots)]
    while pending:
        node, ended = pending.pop()
        if isinstance(node, str):
            parts.append(node)
        elif ended:
            flush()
        elif node.tag == "br":
            parts.append(" ")
        else:
            if node.tag in BLOCKS:
                flush()
                pending.append((node, True))
            pending += [(c, False) for c in reversed(node.children)]
    flush()


def main_text(page: str) -> str:
    """The main text of a page, its blocks joined by a line feed; empty if there is none."""
    root = tree(page)
    prune(root)
    nodes = _ordered(root)
    _measure(nodes)
    held = _score(nodes)
    articles = [n for n in nodes if n.tag == "article" and n.size]
    places = {id(n): i for i, n in enumerate(nodes)}
    best = max(
        (n for n in nodes if n.size and (n.tag in BLOCKS or n.tag == "#root")),
        key=lambda n: (n.score, -places[id(n)]),
        default=None,
    )
    if best is None:
        return ""
    # A part of an article stands for the whole article.
    if articles:
        up = best
        while up is not None and up.tag != "article":
            up = up.parent
        best = up or best
    if best.tag != "article":
        best = _widened(best, held)
    roots = [best]
    if best.parent is not None and best.tag != "article":
        roots = [c for c in best.parent.children if _joins(best, c)]
    elif best.parent is not None:
        roots = [c for c in best.parent.children if c is best or not isinstance(c, str) and (
            c.tag == "article" and _joins(best, c) or c.tag in HEADINGS
        )]
    out: list[str] = []
    _blocks(roots, out)
    return "\n".join(out)


def extract(
    pages: DataFrame, html: str = "html", key: str = "page_id", url: str = "url"
) -> DataFrame:
    """One row per row of ``pages``: key, url, ``text``, ``n_chars`` (code points of the text).

    A null or empty page, and one without text outside menus, headers, footers, forms and the like,
    gives the empty text. Repeated rows are extracted each; other columns are not read. Pages are
    taken whole, however long or broken they are.
    """
    rows = pages.select(
        F.col(f"`{key}`").alias("key"), F.col(f"`{url}`").alias("url"), F.col(f"`{html}`").alias("html")
    )

    def run(batch):
        texts = [main_text(x) for x in strings(batch, "html")]
        return pa.RecordBatch.from_arrays(
            [batch.column("key"), batch.column("url"), pa.array(texts, pa.string())],
            ["key", "url", "text"],
        )

    schema = f"key {rows.schema['key'].dataType.simpleString()}, url string, text string"
    found = map_text(rows, "html", schema, lambda: run)
    return found.select(
        F.col("key").alias(key), F.col("url").alias(url), "text",
        F.length("text").cast("long").alias("n_chars"),
    )
