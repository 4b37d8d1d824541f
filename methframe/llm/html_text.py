"""Main text of web pages by tag-path ratios.

A page is read into text blocks, each with the path of its block elements from the root
(names with their class and id words, which tell paths apart and mean nothing here).  Per path the text
length and punctuation of its blocks are added up and divided by the number of blocks (text-to-path and
punctuation-to-path ratios); both are smoothed over the blocks in page order with a Gaussian kernel and fused:
a path's score is the geometric mean of the product of its own ratios and of the smoothed
ones, times the share of its text outside links.  Paths above a fraction of the strongest one are content.

The content paths' text then leads to the article's container: the deepest element that holds HOLD of it.  What else
stands in an article's own container (short paragraphs, headings, lists of links) stays; of a wider one
only the parts with content, and what lies between them, do.

A header inside an article or main element gives its headings to the article, and nothing else.

Names come last.  Elements that are named as something else (menus, forms, notices, readers' comments, ...) have no
say in the choice of the container and are left out of it, unless they hold the page's article (a page in one form, most of
whose text is whole sentences, a class word that tells of the layout).  An article or main element counts double, a level-one heading
settles which of two containers it is.

Reading and choosing take time in proportion to the page, whatever is broken in it.
"""

from __future__ import annotations

import html
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .arrowmap import add_columns

SMOOTHING = 1.0  # standard deviation of the kernel, in blocks
SHARE = 0.15  # of the strongest path's fused ratio
HOLD = 0.75  # of the content paths' text is in the container
NESTED = 64  # elements ruled out by words inside one another; what is nested deeper counts to the innermost of these
FORM_SHARE = 0.5  # of a form's plain text that is whole sentences if it holds the article

# Fixed values of the page format.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
RAW = ("script", "style", "textarea", "title", "noscript", "template", "iframe", "svg", "math", "select", "object", "canvas", "xmp", "noembed", "noframes")
CLOSES_P = frozenset(
    "address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split()
)
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
SCOPES = frozenset("html body ul ol dl table article section div main aside nav header footer form td th blockquote".split())
TRACKED = frozenset(("p", *CLOSES))
TEXT_PARTS = frozenset(("p", "li", "ul", "ol", "dl", "dt", "dd", "blockquote", "pre", "td", "th", "tr", "tbody", "table", *HEADINGS))  # no containers of an article

# Elements without article text: by name, and by words of class, id and role.
OTHER_TAGS = frozenset("nav header footer aside head menu button".split())
FORM_TAGS = frozenset("form fieldset dialog".split())
OTHER_WORDS = re.compile(
    r"(?:^|[-_ ])(?:ad|ads|advert\w*|adverti[sz]ing|banner|breadcrumbs?|comments?|commentlist|consent|cookies?|discussion|disqus|disclaimer|feedback|footer|gdpr|guestbook|header|masthead|menu|modal|nav|navbar|"
    r"navigation|newsletter|notes|notices?|pagination|pager|popup|opinions?|promo\w*|reactions|readers?|recommend\w*|related|replies|respond|responses|share|sharing|sidebar|signup|skip|social|sponsor\w*|subscribe|subscription|"
    r"tags?|talkback|teasers?|thread|toolbar|voices|widgets?|complementary|contentinfo|search)(?:$|[-_ ])"
)
# Words before one of these that tell of the page's layout ("with-sidebar").
LAYOUT_STATES = re.compile(r"(?:^|[-_])(?:with|without|has|have|no|not|non|hide|hides|show|shows|is|single)[-_]$")
# Parts of words that name elements with running text of their own, such as readers' comments.
OWN_TEXT = re.compile(
    r"ad|ads|advert\w*|adverti[sz]ing|comments?|commentlist|consent|cookies?|discussion|disqus|disclaimer|feedback|gdpr|guestbook|newsletter|notes|notices?|opinions?|promo\w*|reactions|readers?|recommend\w*|related|replies|respond|responses|"
    r"sponsor\w*|talkback|teasers?|thread|voices"
)
WHOLE, LAYOUT, TEXT, FORM = 1, 2, 3, 4  # ruled out by a whole word, by part of one that names a layout or text of its own, or as a form
MAIN_TAGS = frozenset(("article", "main"))

_NAME = re.compile(r"[a-zA-Z][^\s/>]*")
_ATTRIBUTE = re.compile(r"[\s/]*([^\s/>=][^\s/>=]*)(?:\s*=\s*([\"']|[^\s>\"'][^\s>]*)?)?")
_SPACE = re.compile(r"[ \t\n\x0b\f\r]+")
_PUNCTUATION = re.compile(r"[.,;:!?…。，；：！？،؛؟]")
_SENTENCE = re.compile(r"[.!?…。！？؟][\"'”’»)\]]*$")
_RAW_END = {name: re.compile(rf"</{name}\b[^>]*>", re.I) for name in RAW}
_USED = frozenset(("class", "id", "role", "hidden", "aria-hidden", "style"))


class Block:
    __slots__ = ("text", "path", "node", "linked", "other", "main", "ruled", "article")

    def __init__(self, text: str, path: int, node: int, linked: int, other: bool, main: bool, ruled: int, article: int):
        self.text, self.path, self.node, self.linked, self.other, self.main, self.ruled, self.article = text, path, node, linked, other, main, ruled, article


class Node:
    """An element: its own name, its path's number, and what holds for all that is in it."""

    __slots__ = ("name", "label", "up", "depth", "path", "other", "main", "only_main", "article", "ruled", "kind", "near", "chain", "titled")

    def __init__(self, name: str, label: str, up: int, depth: int, path: int):
        self.name, self.label, self.up, self.depth, self.path = name, label, up, depth, path
        self.other = self.main = self.only_main = self.titled = False  # named as something else; in an article or main; in a main; in an article's own header
        self.article, self.ruled, self.kind, self.chain = -1, 0, 0, 0  # depth of the outermost article or main; innermost element that words rule out
        self.near: dict[str, int] = {}  # places in the stack of open elements that a start tag may close


class Page:
    """Blocks in page order and the elements that they are in; element 0 is the page."""

    def __init__(self, blocks: list[Block], nodes: list[Node]):
        self.blocks, self.nodes = blocks, nodes


def _ruled_out(word: str) -> int:
    """WHOLE, LAYOUT or TEXT for a word that marks something other than article text, else 0."""
    kind, at = 0, 0
    while (m := OTHER_WORDS.search(word, at)) is not None:
        part = m[0].strip("-_ ")
        start = m.start() + m[0].index(part)
        at = start + len(part)
        if part == word:
            return WHOLE
        if not LAYOUT_STATES.search(word[:start]):
            kind = TEXT if kind == TEXT or OWN_TEXT.fullmatch(part) else LAYOUT
    return kind


def _label(name: str, attributes: dict[str, str]) -> tuple[str, bool, int]:
    """(name with class and id words, whether name or state mark something other than article text, and how words do)."""
    kind, other, words = FORM if name in FORM_TAGS else 0, name in OTHER_TAGS, []
    for key, value in attributes.items():
        value = html.unescape(value).lower()
        if key in ("class", "id", "role"):
            words += value.split()
        elif key == "hidden" or key == "aria-hidden" and value == "true" or key == "style" and re.search(r"display\s*:\s*none", value):
            other = True
    kinds = [k for k in map(_ruled_out, words) if k] if name not in ("html", "body") else []
    if kinds:
        kind = WHOLE if WHOLE in kinds else max(kinds)
    return ".".join([name, *words]), other, kind


class _Tags:
    """Where tags end.  A quote that is never closed ends with its tag at the next '>'; that there is none is found out once."""

    def __init__(self, page: str):
        self.page, self.none_after = page, {'"': len(page) + 1, "'": len(page) + 1}

    def read(self, at: int, wanted: bool) -> tuple[dict[str, str], bool, int]:
        """(attributes in use, whether the tag closes itself, one past its end) from the end of its name on; the end is -1 if there is none."""
        page, found = self.page, {}
        while True:
            m = _ATTRIBUTE.match(page, at)
            if m is None:
                end = page.find(">", at)
                return found, end > 0 and page[end - 1] == "/", end + 1 if end >= 0 else -1
            key, value = m[1], m[2] or ""
            at = m.end()
            if value in ('"', "'") and value:
                end = page.find(value, at) if at < self.none_after[value] else -1
                if end < 0:
                    self.none_after[value] = min(at, self.none_after[value])
                    end = page.find(">", at)
                    return found, False, end + 1 if end >= 0 else -1
                value, at = page[at:end], end + 1
            if wanted and (key := key.lower()) in _USED:
                found.setdefault(key, value)


def _let_in(nodes: list[Node], ruled: list[int], held: dict[int, list[tuple[int, bool, int, int]]]) -> set[int]:
    """Elements ruled out by words, or as forms, that hold the page's article all the same.

    ruled: these elements; held: of each of them (0: the rest of the page) its own blocks as (depth of the outermost
    article or main or -1, whether a main is around it, plain text, that which ends as a sentence).
    Inner elements come first.  What is outside of one are the blocks that nothing but the elements around it rules out.
    """
    out = set()
    total = {n: [sum(b[2] for b in own), sum(b[2] for b in own if b[0] >= 0)] for n, own in held.items()}  # plain text, and that in an article
    for at_node in sorted(ruled, key=lambda n: -nodes[n].depth):
        own = held.get(at_node)
        if not own:
            continue
        node = nodes[at_node]
        up = nodes[node.up].ruled
        rest, named, at = *total.get(0, (0, 0)), up
        while at:
            rest, named, at = rest + total.get(at, (0, 0))[0], named + total.get(at, (0, 0))[1], nodes[nodes[at].up].ruled
        mass, article, kind = total[at_node][0], sum(b[2] for b in own if b[0] > node.depth), node.kind
        keep = any(b[1] and b[0] > node.depth for b in own)
        keep = keep or article > named and (kind in (LAYOUT, FORM) or article > rest)
        keep = keep or kind == LAYOUT and mass > rest or kind == TEXT and not rest
        keep = keep or kind == FORM and mass > rest and not named and sum(b[3] for b in own) >= FORM_SHARE * mass
        if keep:
            out.add(at_node)
            held.setdefault(up, []).extend(own)
            total[up] = [x + y for x, y in zip(total.get(up, (0, 0)), total[at_node], strict=True)]
    return out


def read(page: str) -> Page:
    """The page's text blocks, in order."""
    out: list[Block] = []
    nodes = [Node("", "", 0, 0, 0)]
    paths: dict[tuple[int, str], int] = {}
    stack = [0]  # open elements
    opened: dict[str, list[int]] = {}  # by name, their places in the stack
    ruled: list[int] = []
    held: dict[int, list[tuple[int, bool, int, int]]] = {}
    parts: list[str] = []
    linked = links = 0
    tags = _Tags(page)

    def flush() -> None:
        nonlocal linked
        if parts:
            text = _SPACE.sub(" ", "".join(parts)).strip(" ")
            if text:
                n = nodes[stack[-1]]
                b = Block(text, n.path, stack[-1], min(linked, len(text)), n.other, n.main, n.ruled, n.article)
                out.append(b)
                if not b.other:
                    plain = len(text) - b.linked
                    held.setdefault(n.ruled, []).append((n.article, n.only_main, plain, plain if _SENTENCE.search(text) else 0))
            parts.clear()
        linked = 0

    def add(raw: str) -> None:
        nonlocal linked
        text = html.unescape(raw)
        parts.append(text)
        if links:
            linked += len(text.strip())

    def close(place: int) -> None:
        """Closes the open elements from a place in the stack on."""
        flush()
        for n in stack[place:]:
            opened[nodes[n].name].pop()
        del stack[place:]

    def open_(name: str, attributes: dict[str, str]) -> None:
        label, other, kind = _label(name, attributes)
        up = nodes[stack[-1]]
        n = Node(name, label, stack[-1], up.depth + 1, paths.setdefault((up.path, label), len(paths) + 1))
        n.other = up.other or other
        if name == "header" and up.article >= 0 and not up.other:
            n.titled = True  # of an article: its headings are the article's
        elif name in HEADINGS and up.titled:
            n.other = False
        else:
            n.titled = up.titled
        n.main, n.only_main = up.main or name in MAIN_TAGS, up.only_main or name == "main"
        n.article = up.article if up.article >= 0 or name not in MAIN_TAGS else n.depth
        n.ruled, n.chain = up.ruled, up.chain
        number = len(nodes)
        if kind and up.chain < NESTED:
            n.ruled, n.kind, n.chain = number, kind, up.chain + 1
            ruled.append(number)
        n.near = {} if name in SCOPES else up.near
        if name in TRACKED:
            n.near = {**n.near, name: len(stack)}
        opened.setdefault(name, []).append(len(stack))
        nodes.append(n)
        stack.append(number)

    at, text_from = 0, 0
    while True:
        at = page.find("<", at)
        if at < 0:
            add(page[text_from:])
            break
        begin, c = at, page[at + 1 : at + 2]
        if c == "!" or c == "?":
            end = page.find("-->", at + 4) + 3 if page.startswith("<!--", at) else page.find(">", at) + 1
            add(page[text_from:begin])
            at = text_from = end if end > 2 else len(page)
            continue
        m = _NAME.match(page, at + (2 if c == "/" else 1))
        if m is None:
            at += 1
            continue
        name = m[0].lower()
        attributes, alone, end = tags.read(m.end(), c != "/" and name not in INLINE)
        add(page[text_from:begin])
        if end < 0:  # the page ends within a tag
            break
        at = text_from = end
        if c == "/":
            if name == "a":
                links = max(0, links - 1)
            elif name not in INLINE and name not in VOID and opened.get(name):
                close(opened[name][-1])
            continue
        if name in _RAW_END:
            if not alone:
                m = _RAW_END[name].search(page, at)
                at = text_from = m.end() if m else len(page)
            continue
        if name == "br":
            parts.append(" ")
            continue
        if name in INLINE:
            if name == "a":
                links += 1
            continue
        if name in VOID:
            flush()
            continue
        near = nodes[stack[-1]].near
        if name in CLOSES_P and "p" in near:
            close(near["p"])
            near = nodes[stack[-1]].near
        if name in CLOSES:
            places = [near[x] for x in CLOSES[name] if x in near]
            if places:
                close(max(places))
        flush()
        links = 0 if name in CLOSES_P else links
        open_(name, attributes)
    flush()
    let_in = _let_in(nodes, ruled, held) if ruled else set()
    # Ancestors have smaller numbers, so one pass settles all.
    shut = {0: False}
    for n in ruled:
        shut[n] = n not in let_in or shut[nodes[nodes[n].up].ruled]
    for b in out:
        b.other = b.other or shut[b.ruled]
    return Page(out, nodes)


def path_scores(blocks: list[Block]) -> tuple[np.ndarray, np.ndarray]:
    """(each block's path, numbered from 0; each path's fused ratio)."""
    _, path = np.unique([b.path for b in blocks], return_inverse=True)
    length = np.array([len(b.text) for b in blocks], float)
    number = np.bincount(path)
    by_text = np.bincount(path, length) / number
    by_mark = 1 + np.bincount(path, [len(_PUNCTUATION.findall(b.text)) for b in blocks]) / number
    plain = 1 - np.bincount(path, [b.linked for b in blocks]) / np.bincount(path, length)
    radius = int(3 * SMOOTHING)
    kernel = np.exp(-0.5 * (np.arange(-radius, radius + 1) / SMOOTHING) ** 2)
    weight = np.convolve(np.ones(len(path)), kernel, "full")[radius : radius + len(path)]
    smooth = [np.convolve(x[path], kernel, "full")[radius : radius + len(path)] / weight for x in (by_text, by_mark)]
    smoothed = np.bincount(path, smooth[0] * smooth[1]) / number
    return path, np.sqrt(by_text * by_mark * smoothed) * plain


def _plain(b: Block, other: bool) -> Block:
    """b as text outside links."""
    return Block(b.text, b.path, b.node, 0, other, b.main, b.ruled, b.article)


def select(page: Page) -> list[Block]:
    """The blocks of the main text."""
    found, nodes = page.blocks, page.nodes
    open_ = np.array([not b.other for b in found], bool)
    if not open_.any():
        return []
    path, score = path_scores(found)
    fused = score[path] * open_
    top = fused.max()
    if top <= 0:
        # Nothing but links: an article's own stand, and whole sentences, but no lists of links.
        told = [not b.other and (b.main or _SENTENCE.search(b.text) is not None) for b in found]
        return select(Page([_plain(b, not t) for b, t in zip(found, told, strict=True)], nodes)) if any(told) else []
    strong = fused >= SHARE * top
    weight = np.array([(len(b.text) - b.linked) * (2 if b.main else 1) for b in found], float) * strong
    mass = np.bincount([b.node for b in found], weight, len(nodes))
    up = [n.up for n in nodes]
    for k in range(len(nodes) - 1, 0, -1):  # elements come after those around them
        mass[up[k]] += mass[k]

    def holder(least: float, within: int) -> int:
        """The deepest element in another (or itself) that holds so much; never a mere part of a text."""
        inside = {within}
        best = within
        for k in range(within + 1, len(nodes)):
            if up[k] in inside and mass[k] >= least:
                inside.add(k)
                if nodes[k].depth > nodes[best].depth:
                    best = k
        while best and nodes[best].name in TEXT_PARTS:
            best = up[best]
        return best

    def chain(k: int) -> list[int]:
        out = [k]
        while k:
            k = up[k]
            out.append(k)
        return out

    container = holder(HOLD * mass[0], 0)
    # A page's level-one heading stands in its article, if anything of that is beside it.
    title = next((b.node for b, ok in zip(found, open_, strict=True) if ok and nodes[b.node].name == "h1"), None)
    if title is not None and container not in (around := chain(title)):
        outer = set(chain(container))
        branch = [k for k in around if k not in outer]
        if branch and nodes[branch[-1]].name not in TEXT_PARTS and 10 * mass[branch[-1]] >= mass[0]:
            container = holder(HOLD * mass[branch[-1]], branch[-1])
    # The part of the container that each block is in: one of its child elements, or itself.
    part_of = np.full(len(nodes), -1)
    part_of[container] = container
    for k in range(container + 1, len(nodes)):
        if part_of[up[k]] >= 0:
            part_of[k] = k if up[k] == container else part_of[up[k]]
    part = np.array([part_of[b.node] for b in found])
    inner = (part >= 0) & open_
    own = any(nodes[k].name in TEXT_PARTS or k == container for k in part[inner & strong].tolist())
    if own and nodes[container].name not in ("", "html", "body"):
        return [b for b, ok in zip(found, inner, strict=True) if ok]
    # A wider element: its parts with content, what lies between them and is not mostly links, and headings before.
    parts = set(part[inner & strong].tolist())
    places = np.flatnonzero(inner & strong)
    first, last = int(places[0]), int(places[-1])
    while first and inner[first - 1] and nodes[found[first - 1].node].name in HEADINGS:
        first -= 1
    heavy = np.bincount(np.maximum(part, 0), [2 * b.linked - len(b.text) for b in found], len(nodes)) > 0
    keep = inner & (strong | np.isin(part, [k for k in parts if k != container and nodes[k].name not in TEXT_PARTS]))
    between = np.arange(len(found))
    keep |= inner & (between >= first) & (between <= last) & ~heavy[np.maximum(part, 0)]
    return [b for b, ok in zip(found, keep, strict=True) if ok]


def main_text(page: str | None) -> str:
    """The main text: white space of HTML (space, tab, line feed, vertical tab, form feed, carriage return) inside a block as one space, blocks joined by one space.

    A no-break space is no such white space and stays.
    """
    return " ".join(b.text for b in select(read(page or "")))


def extract(df: DataFrame, html_col: str = "html", text_out: str = "text", chars_out: str = "n_chars") -> DataFrame:
    """df with each page's main text and its length in code points.

    Null and empty pages, and pages without article text, give an empty text.  Columns of the
    output names are replaced, all others pass through; repeated rows get equal texts.
    """

    def make():
        def run(batch: pa.RecordBatch) -> list:
            texts = [main_text(p) for p in batch.column(html_col).to_pylist()]
            return [texts, [len(t) for t in texts]]

        return run

    return add_columns(df, [(text_out, T.StringType()), (chars_out, T.LongType())], make)
