"""Main text of web pages by tag-path ratios."""

from __future__ import annotations

import html
import math
import re
from collections import defaultdict

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
ITEMS = frozenset("li dt dd td th caption figcaption blockquote pre".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong"
    " sub sup time tt u var".split()
)
#: Elements that never hold the article.
NEVER = frozenset(
    "script style noscript template head title nav footer aside button select option textarea input iframe svg"
    " canvas object menu dialog datalist audio video map math".split()
)
#: Class, id or role tokens that speak against a subtree. They remove it only if it holds
#: a small share of the page's text, see SMALL.
BESIDE = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr"
    " notice notices alert warning popup modal overlay nav navbar navigation menu submenu breadcrumb breadcrumbs sidebar"
    " aside rail complementary footer foot contentinfo copyright masthead comment comments commentlist disqus replies reply"
    " responses discussion share sharing social related recommended recommendations newsletter subscribe subscription signup"
    " login search searchbox form widget widgets toolbar pagination pager skip hidden outbrain taboola".split()
)
ARTICLE = frozenset("article main".split())
#: Of these, words that also name sections of articles: alone they only remove what the path ratios don't choose.
AMBIGUOUS = frozenset("discussion search notice notices related warning alert social form responses share".split())
#: An element with a name of BESIDE goes if it holds at most this share of the text that no tag removes.
SMALL = 0.4
#: Text outside of article elements goes if those hold at least this share of the chosen text.
ARTICLES = 0.5
#: Names of reader comments: parts that say so, and parts that may stand beside them in one token.
COMMENTS = frozenset("comment comments commentlist disqus replies respond".split())
_COMMENT_PARTS = COMMENTS | frozenset(
    "user users reader readers list listing section area thread threads wrapper wrap container box block item items body content"
    " post page the count form author meta reply child children nested feed stream tree wp fb main inner outer group".split()
)
#: A start of one of these ends an open one of the second.
CLOSES = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
    "option": {"option"}, "thead": {"tr", "td", "th"}, "tbody": {"thead", "tr", "td", "th"}, "tfoot": {"tbody", "tr", "td", "th"},
}
SCOPES = frozenset("html body table ul ol dl article main section div td th".split())
SMOOTHING = 1.0
#: A path is content from this share of the page's mean fused ratio, weighted by text, on.
THRESHOLD = 0.25
#: The content's container is the deepest element with this share of the selected text.
HELD = 0.75

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    # A tag that is not closed ends at the next one, or with the page: no part of it is searched again.
    r"|<(/?)([a-zA-Z][^\s/<>]*)((?:[^<>\"']|\"[^\"]*\"|'[^']*')*+)(?:>|(?=<)|\Z)|([^<]+|<)",
    re.DOTALL,
)
_ATTRIBUTE = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_RAW_ENDS = {tag: re.compile(f"</{tag}", re.I | re.A) for tag in RAW}
_NAME = re.compile(r"[a-z]+")
_PUNCTUATION = re.compile(r"[,.;:!?…。，、；：！？]")
_HIDING = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


class Paths:
    """Numbers for the root-to-leaf tag paths of one page: a path is its parent's number and the last label."""

    def __init__(self):
        self.known: dict[tuple[int, str], int] = {}

    def number(self, parent: int, label: str) -> int:
        return self.known.setdefault((parent, label), len(self.known) + 1)


class Element:
    """An element of the page; what a node needs of its ancestors is known when it is made."""

    __slots__ = ("tag", "parent", "path", "beside", "named", "article", "block", "link", "kind", "chars", "text", "high", "inner", "mark")

    def __init__(self, tag, parent, path=0, beside=False, named=""):
        self.tag, self.parent, self.path = tag, parent, path
        self.article = tag in ARTICLE or bool(parent and parent.article)
        own = tag in NEVER or (tag == "header" and not self.article) or beside
        self.beside = own or bool(parent and parent.beside)
        self.named = named or ("beside" if tag == "form" else "")
        inline = parent is not None and tag in INLINE
        self.block = parent.block if inline and tag != "a" else self  # what inline elements stand in, links aside
        self.link = tag == "a" or bool(parent and parent.link)
        if tag in HEADINGS:
            self.kind = "heading"
        elif tag in ITEMS:
            self.kind = "item"
        else:
            self.kind = parent.kind if parent and (tag in INLINE or tag == "p") else ""
        self.chars = self.text = self.high = self.inner = 0
        self.mark = False


def _marked(tag: str, attributes: str) -> tuple[str, bool, str]:
    """Path label of a start tag, whether its attributes hide it, and whether its names speak against it.

    The last is "comments", "beside", "ambiguous" or empty; a name counts if all its parts between hyphens and the like are
    listed, one of comments also beside some plain words.
    """
    if not attributes or tag in ("html", "body"):
        return tag, False, ""
    label, beside, named, seen = tag, False, "", set()
    for name, a, b, c in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), (a or b or c).lower()
        if name in seen:
            continue  # the first of a name counts
        seen.add(name)
        if name in ("class", "id", "role"):
            if name == "class":
                label += "." + ".".join(value.split())
            for token in value.split():
                parts = set(_NAME.findall(token))
                if parts & COMMENTS and parts <= _COMMENT_PARTS:
                    named = "comments"
                elif named != "comments" and parts and parts <= (BESIDE if tag not in ARTICLE else {"comment", "comments", "ad", "related", "reply", "teaser"}):
                    named = "ambiguous" if parts <= AMBIGUOUS and named != "beside" else "beside"
        elif name == "hidden":
            beside = True
        elif name == "aria-hidden":
            beside |= value == "true"
        elif name == "style":
            beside |= bool(_HIDING.search(value))
    return label, beside, "" if re.fullmatch("h[1-6]", tag) else named


def text_nodes(page: str):
    """(element, block number, text) of each text node, in page order, and all elements, parents first."""
    root, paths = Element("", None), Paths()
    stack, block, found, at, elements = [root], 0, [], 0, [root]
    opened: dict[str, int] = defaultdict(int)  # open elements by tag, so that a stray end isn't searched in the stack

    def cut(i):
        for element in stack[i:]:
            opened[element.tag] -= 1
        del stack[i:]

    while match := _TOKEN.match(page, at):
        at = match.end()
        closing, name, attributes, text = match.groups()
        if text is not None:
            found.append((stack[-1], block, text))
            continue
        if name is None:
            continue
        tag = name.lower()
        if closing:
            for i in range(len(stack) - 1, 0, -1) if opened[tag] else ():
                if stack[i].tag == tag:
                    cut(i)
                    break
                if tag in INLINE and stack[i].tag not in INLINE or tag not in INLINE and tag == "p" and stack[i].tag in SCOPES:
                    break
            block += tag not in INLINE and tag not in RAW
            continue
        if tag not in INLINE and tag not in RAW:
            block += tag not in VOID or tag == "hr"
            if tag not in VOID:
                ends = {"p"} | CLOSES.get(tag, set())
                if any(opened[t] for t in ends):
                    _end_open(stack, ends, cut)
        if tag in VOID:
            if tag in ("br", "hr"):
                found.append((stack[-1], block, " "))
            continue
        label, beside, named = _marked(tag, attributes)
        element = Element(tag, stack[-1], paths.number(stack[-1].path, label), beside, named)
        elements.append(element)
        if tag in RAW:
            end = _RAW_ENDS[tag].search(page, at)
            at = end.start() if end else len(page)
            if tag == "textarea":
                element.beside = True
            continue
        if not attributes.rstrip().endswith("/"):
            stack.append(element)
            opened[tag] += 1
    return found, elements


def _end_open(stack, tags, cut):
    for at in range(len(stack) - 1, 0, -1):
        if stack[at].tag in tags:
            cut(at)
            return
        if stack[at].tag in SCOPES:
            return


def path_ratios(nodes) -> dict:
    """Fused ratio of each tag path: mean text length times mean punctuation, each smoothed over the page's nodes.

    ``nodes`` has (path, characters, punctuation marks) in page order.
    """
    sums = defaultdict(lambda: [0, 0, 0])
    for path, chars, marks in nodes:
        total = sums[path]
        total[0] += 1
        total[1] += chars
        total[2] += marks
    order = [path for path, _, _ in nodes]
    weights = [math.exp(-(d * d) / (2 * SMOOTHING * SMOOTHING)) for d in (-2, -1, 0, 1, 2)]

    def smoothed(ratio):
        row = [ratio[path] for path in order]
        held = defaultdict(lambda: [0.0, 0])
        for i, path in enumerate(order):
            top = bottom = 0.0
            for w, j in zip(weights, range(i - 2, i + 3)):
                if 0 <= j < len(row):
                    top, bottom = top + w * row[j], bottom + w
            held[path][0] += top / bottom
            held[path][1] += 1
        return {path: (total / count + ratio[path]) / 2 for path, (total, count) in held.items()}

    lengths = smoothed({p: chars / n for p, (n, chars, _) in sums.items()})
    marks = smoothed({p: 1 + m / n for p, (n, _, m) in sums.items()})
    return {path: lengths[path] * marks[path] for path in sums}


def _chosen(nodes):
    """(path, characters, marks) of each node, the nodes with text, and those of them whose path is content."""
    sized = [(e.path, len(" ".join(t.split())), len(_PUNCTUATION.findall(t))) for e, _, t in nodes]
    full = [i for i, s in enumerate(sized) if s[1]]
    if not full:
        return sized, [], []
    ratios = path_ratios([sized[i] for i in full])
    bar = THRESHOLD * sum(ratios[sized[i][0]] * sized[i][1] for i in full) / sum(sized[i][1] for i in full)
    return sized, full, [i for i in full if ratios[sized[i][0]] >= bar]


def _summed(elements, *names) -> None:
    """Add each element's counts to its ancestors; ``elements`` lists parents first."""
    for element in reversed(elements):
        if element.parent is not None:
            for n in names:
                setattr(element.parent, n, getattr(element.parent, n) + getattr(element, n))


def _without_named(nodes, elements):
    """The nodes less those of named elements the page speaks against, and _chosen of them.

    Comments go wherever they stand, if other text is chosen. Other names remove an element that holds a small share of the
    text, or outside of which all article elements lie; ambiguous ones one that holds nothing chosen.
    """
    sized, full, chosen = _chosen(nodes)
    if not any(e.named for e in elements):
        return nodes, sized, full, chosen
    high, total = set(chosen), sum(sized[i][1] for i in full)
    for i in full:
        element = nodes[i][0]
        element.text += sized[i][1]
        element.high += sized[i][1] * (i in high)
        element.inner += sized[i][1] * element.article
    _summed(elements, "text", "high", "inner")
    articles, selected = elements[0].inner, elements[0].high

    def out(element):
        if element.named == "comments":
            return element.high < selected or not element.high
        if element.named == "beside":
            if element.text <= SMALL * total or articles and not element.inner:
                return True
        return bool(element.named) and not element.high

    for element in elements:
        element.mark = out(element) or bool(element.parent and element.parent.mark)
    nodes = [n for n in nodes if not n[0].mark]
    return nodes, *_chosen(nodes)


def main_text(page: str | None) -> str:
    """The article's text: blocks in page order, joined by one space; empty where there is none."""
    if not page:
        return ""
    nodes, elements = text_nodes(page)
    nodes = [(e, b, html.unescape(t)) for e, b, t in nodes if not e.beside]
    nodes, sized, full, chosen = _without_named(nodes, elements)
    if not full:
        return ""
    within = [i for i in chosen if nodes[i][0].article]
    if sum(sized[i][1] for i in within) >= ARTICLES * sum(sized[i][1] for i in chosen):
        chosen = within
    total = sum(sized[i][1] for i in chosen)
    for i in chosen:
        nodes[i][0].chars += sized[i][1]
    _summed(elements, "chars")
    element = container = nodes[max(chosen, key=lambda i: sized[i][1])][0]
    while element is not None:
        container = element
        if element.chars >= HELD * total and element.tag not in INLINE and element.tag not in ("p", "li"):
            break
        element = element.parent
    whole = next((e for e in _up(container) if e.tag in ARTICLE), None) or container
    for element in elements:
        element.mark = element is whole or bool(element.parent and element.parent.mark)
    blocks: dict[int, list] = {}
    picked = {nodes[i][0].block.path for i in chosen}
    for i, (e, block, text) in enumerate(nodes):
        if e.mark:
            held = blocks.setdefault(block, [[], 0, 0, e])
            held[0].append(text)
            held[1] += sized[i][1] * (1 if e.block.path in picked else -1)
            held[2] += sized[i][1] * (1 if e.link else -1)
    found = [(" ".join("".join(parts).split()), *rest) for parts, *rest in blocks.values()]
    return " ".join(_smoothed([f for f in found if f[0]]))


def _smoothed(blocks) -> list[str]:
    """Texts of chosen blocks, and of headings, items and cells that lead to or stand between them.

    ``blocks`` has (text, characters on chosen paths less others, characters in links less others, element) each.
    """
    kinds = [element.kind for *_, element in blocks]
    kept = [sign >= 0 for _, sign, _, _ in blocks]
    first, last = (kept.index(True), len(kept) - 1 - kept[::-1].index(True)) if any(kept) else (0, -1)
    for i, (_, _, links, _) in enumerate(blocks):
        kept[i] = kept[i] or first < i < last and kinds[i] == "item" and links < 0
    for i in reversed(range(len(blocks) - 1)):
        kept[i] = kept[i] or kinds[i] == "heading" and kept[i + 1]
    return [text for (text, *_), keep in zip(blocks, kept) if keep]


def _up(element):
    while element is not None:
        yield element
        element = element.parent


def _extract(batches):
    for batch in batches:
        texts = [main_text(p.as_py()) for p in batch.column(2)]
        counts = pa.array((len(t) for t in texts), pa.int64())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(texts, pa.string()), counts], ["page_id", "url", "text", "n_chars"]
        )


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every row.

    Each text node of a page belongs to a root-to-leaf tag path, classes included. Text length and punctuation are
    summed per path; their means per node are smoothed over neighbouring nodes, fused, and paths above a share of
    the page's mean are content. The article is what the content's container holds on
    these paths, with headings before them and items and cells between them that aren't mostly links, less subtrees whose
    element says menu, header, footer or form. Names that say so remove a subtree only if it holds a small share of the
    text outside of articles, or nothing with a chosen path. Character references are
    decoded, white space within a block becomes one space. Null and empty pages, and pages without an article,
    give an empty text. Unclosed and misnested tags are closed as browsers do for paragraphs, lists and tables. Each
    row stands alone: repeated rows repeat, no rows give none, further columns aren't read.
    """
    return pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.col("html").cast("string").alias("html"),
    ).mapInArrow(_extract, "page_id long, url string, text string, n_chars long")
