"""Main text of web pages by composite text density.

The page is read into a small tree of its elements. What a page says itself to be no article (menus,
forms, scripts, adverts and so on, by element, role, class or id) is taken out: by class or id never what holds
an article or a main, and by a name that may as well tell of the layout (sidebar-left), or as a form, only what does not hold
the densest core either. Reader comments go even where they are longer than the article. Every remaining element
gets a density: its characters per tag, adjusted for how much of them are links. An element's sum is that
of its children's densities; the largest sum marks the core of the article. The least density on the way
from the core up to the body is the threshold: the chosen subtree is the lowest one that holds the core, the
article by name around it and every element of the page that reaches the threshold, by this density or by
plain characters per tag. Where the core is in a ``main``, only elements in a ``main`` count.

Text: character references decoded, white space within a block as one space, blocks in page order, joined by
a newline. Defined cases: NULL or empty html gives an empty text; unclosed elements end where an enclosing
element ends; a page cut off in the middle of a tag loses only that tag; repeated pages are rows of their
own; an empty table gives no rows. Only the named columns are read.
"""

from __future__ import annotations

import html
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed values of the HTML language.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s"
    " samp small span strike strong sub sup time tt u var wbr".split()
)
CLOSES_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer"
    " form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul".split()
)
SIBLINGS = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
    "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"},
}
SIBLING_SCOPE = frozenset("ul ol menu dl table tbody thead tfoot select body html article div section".split())

# What is no part of an article.
DROPPED = frozenset(
    "head script style nav footer aside button iframe noscript template select textarea svg dialog"
    " object embed canvas audio video menu noembed noframes xmp title".split()
)
DROPPED_ROLES = frozenset("navigation banner contentinfo complementary search alert dialog menu".split())
DROPPED_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent"
    " cookie cookies disqus footer gdpr header masthead menu modal nav navbar navigation newsletter notice"
    " notices notification pagination popup promo promoted related replies respond share sharing sidebar"
    " signup social sponsor sponsored subscribe toolbar widget".split()
)
# Last parts of a class or id that name boilerplate only after a word that does (cookie-notice, site-header).
AFTER_NAMES = frozenset("header notice notices notification share".split())
BEFORE_THEM = DROPPED_NAMES | frozenset({"global", "privacy", "site", "top"})
# Words that only say what kind of box the noun before them stands in (comment-list, share-buttons).
BOXES = frozenset(
    "area articles bar block body box button buttons col column container content entries form group holder icons inner"
    " item items link links list outer panel post posts region row section slot strip text thread title unit"
    " widget widgets wrap wrapper zone".split()
)
# And where it stands; then it may be the page's layout that is named.
PLACES = frozenset("bottom left primary right secondary top".split())
OTHERWISE = frozenset("free has hide hides hidden no non not with without".split())
ARTICLES = frozenset({"article", "main"})
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())

_TAG = re.compile(
    r"<!--.*?(?:--!?>|\Z)|<[!?][^>]*(?:>|\Z)|</?([a-zA-Z][^\s/>]*)((?>[^>\"']+|\"[^\"]*\"|'[^']*')*+)>"
    r"|</?([a-zA-Z][^\s/>]*)([^>]*)>|</?[a-zA-Z][^>]*\Z",
    re.S,
)
# One attribute after the other, each with its value, so that nothing inside a name or value counts.
_ATTRIBUTE = re.compile(r"([^\s/=>\"'][^\s/=>]*+)(?:\s*+=\s*+(?:\"([^\"]*)\"|'([^']*)'|([^\s>]++)))?|\"[^\"]*\"|'[^']*'")
_NAME = re.compile(r"[a-z0-9]+")


# How an element is named: not as boilerplate, perhaps, or surely.
PLAIN, PERHAPS, SURELY = 0, 1, 2


def _split_box(part: str) -> list[str]:
    """A part and the box written to its end (commentlist), if what is before it is boilerplate."""
    for end in range(len(part) - 1, 1, -1):
        if part[:end] in DROPPED_NAMES and part[end:] in BOXES:
            return [part[:end], part[end:]]
    return [part]


def _names_boilerplate(token: str) -> int:
    """Whether a class or id as a whole, or the noun of its parts, is in DROPPED_NAMES. Boxes and places behind the noun
    do not count, but with a place it is only perhaps."""
    parts = [p for part in _NAME.findall(token.split("--")[0]) for p in _split_box(part)]
    sure = SURELY
    while len(parts) > 1 and parts[-1] not in DROPPED_NAMES and (parts[-1] in BOXES or parts[-1] in PLACES or parts[-1].isdigit()):
        if parts.pop() in PLACES:
            sure = PERHAPS
    *before, last = parts or [""]
    if last not in DROPPED_NAMES or not OTHERWISE.isdisjoint(before):
        return PLAIN
    if before and last in AFTER_NAMES and BEFORE_THEM.isdisjoint(before):
        return PLAIN
    return sure


def _judged(tag: str, attributes: str, in_article: bool) -> tuple[bool, int]:
    """Whether an element is no part of an article for certain, and how its class or id names it."""
    if tag in DROPPED or (tag == "header" and not in_article):
        return True, PLAIN
    named = PERHAPS if tag == "form" else PLAIN
    if not attributes or tag in ("body", "html"):
        return False, named
    for match in _ATTRIBUTE.finditer(attributes):
        name = (match[1] or "").lower()
        value = (match[2] or match[3] or match[4] or "").lower()
        if name == "role" and value in DROPPED_ROLES:
            return True, PLAIN
        if name == "hidden" or (name == "aria-hidden" and value == "true"):
            return True, PLAIN
        if name in ("class", "id") and tag not in ARTICLES and tag not in ("header", "form"):
            for token in value.split():
                if not in_article or "header" not in _NAME.findall(token):
                    named = max(named, _names_boilerplate(token))
    return False, named


class Tree:
    """Elements in page order; parents come before their children. Element 0 is the root."""

    def __init__(self) -> None:
        self.tags = ["body"]
        self.parents = [-1]
        self.items: list[list] = [[]]  # texts and the numbers of child elements, in order
        self.named = [PLAIN]  # whether a class or id says that the element is no part of an article

    def add(self, tag: str, parent: int, named: int = PLAIN) -> int:
        number = len(self.tags)
        self.tags.append(tag)
        self.parents.append(parent)
        self.items.append([])
        self.named.append(named)
        self.items[parent].append(number)
        return number

    def without(self, dropped: set[int]) -> Tree:
        """The same tree without some elements and all below them."""
        tree = Tree()
        tree.items[0] = list(self.items[0])
        numbers = {0: 0}
        for i in range(1, len(self.tags)):
            if i not in dropped and self.parents[i] in numbers:
                numbers[i] = len(tree.tags)
                tree.tags.append(self.tags[i])
                tree.parents.append(numbers[self.parents[i]])
                tree.items.append(self.items[i])
                tree.named.append(self.named[i])
        tree.items = [
            [item if isinstance(item, str) else numbers[item] for item in items if isinstance(item, str) or item in numbers]
            for items in tree.items
        ]
        return tree


class OpenElements:
    """The elements that are open at a place of the page, and where each name stands among them; nothing walks them."""

    def __init__(self) -> None:
        self.stack: list[tuple[str, int]] = [("", 0)]  # number -1: within a dropped element
        self.depths: dict[str, list[int]] = {}

    def push(self, tag: str, number: int) -> None:
        self.depths.setdefault(tag, []).append(len(self.stack))
        self.stack.append((tag, number))

    def any(self, names: frozenset) -> bool:
        return any(self.depths.get(name) for name in names)

    def close(self, tag: str, scope: frozenset = frozenset()) -> None:
        """Close the last open ``tag`` and all within it, if there is one and no element of ``scope`` lies within it."""
        depths = self.depths.get(tag)
        if not depths:
            return
        depth = depths[-1]
        if any((self.depths.get(name) or (0,))[-1] > depth for name in scope):
            return
        while len(self.stack) > depth:
            self.depths[self.stack.pop()[0]].pop()


_HEADER = frozenset({"header"})
_CLOSES_P_SCOPE = CLOSES_P - {"p"}


def build_tree(page: str) -> Tree:
    """The elements of a page, without those that are no part of an article for certain."""
    tree = Tree()
    open_ = OpenElements()
    position = 0

    def text(piece: str) -> None:
        number = open_.stack[-1][1]
        if not piece or number < 0:
            return
        # Of a header inside an article only its headings belong to the text.
        if open_.any(_HEADER) and not open_.any(HEADINGS):
            return
        tree.items[number].append(html.unescape(piece))

    while position < len(page):
        match = _TAG.search(page, position)
        if match is None:
            text(page[position:])
            break
        text(page[position : match.start()])
        position = match.end()
        tag = (match[1] or match[3] or "").lower()
        if not tag:
            continue
        if page[match.start() + 1] == "/":
            open_.close(tag)
            continue
        attributes = match[2] or match[4] or ""
        if tag in CLOSES_P:
            open_.close("p", _CLOSES_P_SCOPE)
        for sibling in SIBLINGS.get(tag, ()):
            open_.close(sibling, SIBLING_SCOPE)
        parent = open_.stack[-1][1]
        if tag in RAW:
            end = re.compile(rf"</{tag}\b[^>]*>", re.I).search(page, position)
            position = end.end() if end else len(page)
            continue
        dropped, named = (True, PLAIN) if parent < 0 else _judged(tag, attributes, open_.any(ARTICLES))
        if dropped:
            number = -1
        elif tag in ("html", "body"):
            number = 0
        else:
            number = tree.add(tag, parent, named)
        if tag not in VOID:
            open_.push(tag, number)
    return tree


def densities(tree: Tree) -> tuple[list[float], list[float], list[float]]:
    """Composite text density of every element, the sum over its children, and unlinked characters per tag."""
    n = len(tree.tags)
    chars, tags, link_chars, link_tags = [0] * n, [0] * n, [0] * n, [0] * n
    for i in range(n - 1, -1, -1):
        chars[i] += sum(len("".join(item.split())) for item in tree.items[i] if isinstance(item, str))
        if tree.tags[i] == "a":
            link_chars[i], link_tags[i] = chars[i], tags[i] + 1
        if i:
            parent = tree.parents[i]
            chars[parent] += chars[i]
            tags[parent] += tags[i] + 1
            link_chars[parent] += link_chars[i]
            link_tags[parent] += link_tags[i]
    body_links = link_chars[0] / max(1, chars[0])
    density = []
    for c, t, lc, lt in zip(chars, tags, link_chars, link_tags):
        if not c:
            density.append(0.0)
            continue
        base = math.log(c * lc / max(1, c - lc) + body_links * c + math.e)
        ratio = c / max(1, lc) * max(1, t) / max(1, lt)
        density.append(c / max(1, t) * math.log(1 + ratio) / math.log(1 + base))
    sums = [0.0] * n
    for i in range(1, n):
        sums[tree.parents[i]] += density[i]
    return density, sums, [(c - lc) / max(1, t) for c, t, lc in zip(chars, tags, link_chars)]


WRAPPER_SHARE, WRAPPER_REST = 0.1, 250


def _holding(tree: Tree, held: list[int]) -> set[int]:
    """Some elements and all that hold them."""
    kept: set[int] = set()
    for i in held:
        while i >= 0 and i not in kept:
            kept.add(i)
            i = tree.parents[i]
    return kept


def _characters(tree: Tree) -> int:
    return sum(len("".join(item.split())) for items in tree.items for item in items if isinstance(item, str))


def without_boilerplate(tree: Tree) -> Tree:
    """The tree without the elements whose class or id names boilerplate.

    What holds an article or a main stays whatever its name. Of the rest, what is surely named goes first, so that text without
    such a name wins even over denser comments; only if next to nothing were left (less than ``WRAPPER_SHARE`` of
    what goes, and ``WRAPPER_REST`` characters), the name is that of a wrapper, and counts as perhaps. What is perhaps named
    goes if it does not hold the densest core of what is left. Where the page has an article or main with text,
    the core is that of their elements. If nothing would be left, all stays.
    """
    if not any(tree.named):
        return tree
    n = len(tree.tags)
    kept = _holding(tree, [i for i in range(n) if tree.tags[i] in ARTICLES])
    surely = {i for i in range(n) if tree.named[i] == SURELY and i not in kept}
    left = tree.without(surely) if surely else tree
    rest = _characters(left)
    if surely and rest < WRAPPER_REST and rest < WRAPPER_SHARE * (_characters(tree) - rest):
        left = tree
    if not any(left.named):
        return left
    sums = densities(left)[1]
    n = len(left.tags)
    inside = [False] * n
    for i in range(n):
        inside[i] = left.tags[i] in ARTICLES or (i > 0 and inside[left.parents[i]])
    among = [i for i in range(n) if inside[i] and sums[i] > 0] or range(n)
    held = [i for i in range(n) if left.tags[i] in ARTICLES]
    kept = _holding(left, [*held, max(among, key=lambda i: (sums[i], -i))])
    last = left.without({i for i in range(n) if left.named[i] and i not in kept})
    return last if _characters(last) else left


def chosen(tree: Tree) -> int:
    """The element that holds the article."""
    density, sums, plain = densities(tree)
    core = max(range(len(sums)), key=lambda i: (sums[i], -i))
    path = [core]
    while path[-1] > 0:
        path.append(tree.parents[path[-1]])
    # Without links the composite density grows with an element's size, so a smaller part as dense as the
    # path falls below it; the plain density does not.
    threshold, plain_threshold = min(density[i] for i in path), min(plain[i] for i in path)
    dense = [d > 0 and (d >= threshold or q >= plain_threshold > 0) for d, q in zip(density, plain)]
    height = {element: k for k, element in enumerate(path)}
    # The lowest element of the path above each element, and whether a main is on the way to it.
    joins, in_main = [0] * len(sums), [False] * len(sums)
    for i in range(len(sums)):
        above = tree.parents[i]
        joins[i] = height[i] if i in height else joins[above]
        in_main[i] = tree.tags[i] == "main" or (above >= 0 and in_main[above])
    # Whatever is as dense belongs to the same article, outside a main that holds the core only if in a main too.
    start = next((k for k, i in enumerate(path) if tree.tags[i] not in INLINE and tree.tags[i] != "p"), len(path) - 1)
    for name in ("article", "main"):
        named = [k for k, i in enumerate(path) if tree.tags[i] == name]
        if named:
            start = named[-1]
            break
    top = max(
        (joins[i] for i in range(len(sums))
         if i not in height and dense[i] and (in_main[i] or not in_main[core])),
        default=start,
    )
    return path[max(start, top)]


def blocks(tree: Tree, top: int) -> list[str]:
    """The texts of the blocks under an element, in page order."""
    found: list[list[str]] = [[]]
    stack: list = [top]
    while stack:
        item = stack.pop()
        if isinstance(item, str):
            found[-1].append(item)
            continue
        if item is None:
            found.append([])
            continue
        tag = tree.tags[item]
        inline = tag in INLINE
        if tag == "br":
            found[-1].append(" ")
        if not inline:
            found.append([])
            stack.append(None)
        stack.extend(reversed(tree.items[item]))
    texts = (" ".join("".join(parts).split()) for parts in found)
    return [t for t in texts if t]


def main_text(page: str | None) -> str:
    if not page:
        return ""
    tree = without_boilerplate(build_tree(page))
    return "\n".join(blocks(tree, chosen(tree)))


def extract_text(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Per page: its id, url, the main text and its number of code points."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(page.as_py()) for page in batch.column(2)]
            counts = pa.array([len(t) for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), counts],
                ["page_id", "url", "text", "n_chars"],
            )

    source = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"), F.col(html).alias("html"))
    kind = source.schema["page_id"].dataType.simpleString()
    return source.mapInArrow(run, f"page_id {kind}, url string, text string, n_chars bigint").withColumnRenamed("page_id", page_id)
