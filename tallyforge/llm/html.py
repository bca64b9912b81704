"""Main text of web pages by composite text density."""

from __future__ import annotations

import html as entities
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

# Element names of HTML by their role on a page.
RAW = frozenset("script style noscript template textarea title xmp iframe noembed noframes".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
NOT_TEXT = frozenset(
    "script style noscript template head nav header footer aside form button select option textarea input"
    " iframe object embed canvas svg annotation annotation-xml menu dialog audio video map title noembed noframes".split()
)
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp"
    " small span strike strong sub sup time tt u var wbr"
    " math semantics mrow mi mn mo ms mtext mspace mfrac msqrt mroot mstyle mpadded msub msup msubsup munder mover munderover".split()
)
# Blocks that belong to the text beside them.
PLAIN = frozenset("h1 h2 h3 h4 h5 h6 hgroup p blockquote pre ul ol dl table figure".split())
# An element of the first kind that opens ends open elements of the second kind, up to a container.
CLOSES_P = frozenset(
    "address article aside blockquote center details dir div dl fieldset figcaption figure footer form h1 h2 h3 h4"
    " h5 h6 header hgroup hr main menu nav ol p pre section table ul".split()
)
ENDS = {
    "li": frozenset(("li",)), "dt": frozenset(("dt", "dd")), "dd": frozenset(("dt", "dd")),
    "tr": frozenset(("tr", "td", "th")), "td": frozenset(("td", "th")), "th": frozenset(("td", "th")),
    "option": frozenset(("option",)),
}
HOLDS = frozenset("article aside blockquote body div dl footer form header html main nav ol section table tbody thead ul".split())
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert form menu menubar toolbar".split())
# Words in class and id that name what is not the article, where they lead a token or follow a place; words of
# what readers and other pages add; and words that make a token a setting of the page ("no-sidebar", "share-enabled").
CHROME = frozenset(
    "ad ads advert advertisement adsense sponsored sponsor promo promotion banner nav navbar navigation menu breadcrumb"
    " breadcrumbs sidebar side footer header masthead cookie cookies consent gdpr notice notification alert popup modal"
    " overlay newsletter subscribe signup login share sharing social comment comments commentlist disqus discussion"
    " replies reply respond related recommended recommendations toolbar pagination pager widget copyright disclaimer".split()
)
ADDED = frozenset("comment comments commentlist disqus discussion replies reply respond related recommended recommendations".split())
# Nouns that make any token one of additions or adverts, wherever they stand in it ("user-comments", "google-ad").
NOUNS = ADDED - {"reply", "respond", "related", "recommended", "discussion"} | frozenset("ad ads adsbygoogle advert advertisement adsense".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
PLACES = frozenset("site page main top bottom left right primary secondary global".split())
SETTINGS = frozenset("has have no not with without by on off enabled disabled open closed inside free".split())

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))*)(?:>|\Z)|<[!?/][^>]*(?:>|\Z)", re.S
)
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)\s*=\s*(?:\"([^\"]*)\"?|'([^']*)'?|([^\s\"'>]+))|([^\s=/\"'>]+)")
_WORDS = re.compile(r"[a-z]+|[0-9]+")


class Node:
    """One element: its place, what its subtree holds and its density."""

    __slots__ = (
        "name", "parent", "children", "parts", "skip", "doubt", "prose", "article", "inside",
        "chars", "tags", "link_chars", "link_tags", "sum", "density",
    )

    def __init__(self, name: str, parent: Node | None, skip: bool, doubt: str = ""):
        self.name, self.parent, self.skip, self.doubt = name, parent, skip, doubt
        self.prose, self.article = 0, False  # text outside links, and whether an article or main is inside
        self.inside = name == "article" or parent is not None and parent.inside  # an article or in one
        self.children: list[Node] = []
        self.parts: list[str | Node] = []  # text and elements in page order
        self.chars = self.tags = self.link_chars = self.link_tags = 0
        self.sum = self.density = 0.0


def _named(value: str) -> str:
    """The word in a class or id that names something else than the article."""
    for token in value.split():
        words = _WORDS.findall(token)
        if not words or not SETTINGS.isdisjoint(words):
            continue
        if words[0] in CHROME:
            return words[0]
        if len(words) == 2 and words[0] in PLACES and words[1] in CHROME:
            return words[1]
        for word in words:
            if word in NOUNS:
                return word
    return ""


def _is_chrome(name: str, attributes: str) -> tuple[bool, str]:
    """Whether an element is no part of an article for sure, and the word that makes it doubtful."""
    if name in NOT_TEXT:
        return True, ""
    if not attributes or name in ("html", "body"):
        return False, ""
    doubt = ""
    for m in _ATTRIBUTE.finditer(attributes):
        key = (m[1] or m[5]).lower()
        value = entities.unescape(m[2] or m[3] or m[4] or "").lower()
        if key in ("class", "id"):
            doubt = doubt or _named(value)
        elif name in ("article", "main"):
            continue
        elif key == "role" and value.strip() in ROLES or key == "hidden" or key == "aria-hidden" and value == "true":
            return True, ""
        elif key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
            return True, ""
    return False, doubt


def _decide(root: Node) -> None:
    """Settle which doubtful elements are left out: not those that hold the page's article or main, where
    none stands outside of them, nor those that hold most of the body's text outside links, unless they
    stand beside an article or main. What readers and other pages add may well be most of a page."""
    order = _nodes(root)
    outside, clear, within = False, {id(root): True}, {id(root): False}  # no doubtful element around; an article around
    for node in order[1:]:
        within[id(node)] = within[id(node.parent)] or node.parent.name in ("article", "main")
        clear[id(node)] = clear[id(node.parent)] and (not node.doubt or node.name in ("article", "main"))
        if node.name in ("article", "main") and not node.skip and node.doubt not in ADDED:
            node.article = True
            outside = outside or clear[id(node)]
    for node in reversed(order):
        if not node.skip and node.name != "a":
            node.prose += sum(len(p.strip()) for p in node.parts if isinstance(p, str))
            if node.parent is not None:
                node.parent.prose += node.prose
                node.parent.article = node.parent.article or node.article
    body = next((n for n in order if n.name == "body"), root)
    for node in order[1:]:
        holds = node.name in ("article", "main") or node.article and not outside
        most = node.doubt not in ADDED and 2 * node.prose > body.prose and (within[id(node)] or not outside)
        node.skip = node.parent.skip or node.skip or bool(node.doubt) and not (holds or most)


def parse(page: str) -> Node:
    """The page as a tree. Unclosed elements end where HTML's rules say; text in elements that are not
    part of any article is left out of the tree's counts."""
    root = at = Node("#page", None, False)
    titles: list[Node] = []
    end = 0
    while m := _TAG.search(page, end):
        if m.start() > end:
            at.parts.append(page[end:m.start()])
        end = m.end()
        name = m[2]
        if not name:
            continue
        name = name.lower()
        if m[1]:
            node = at
            while node is not root and node.name != name and not (name in INLINE and node.name in HOLDS):
                node = node.parent
            if node is not root and node.name == name:
                at = node.parent
            continue
        if name in CLOSES_P or name in ENDS:
            ends = ENDS.get(name, frozenset(("p",)))
            node = at
            while node is not root and node.name not in HOLDS and node.name not in ends:
                node = node.parent
            if node.name in ends:
                at = node.parent
                if name == "tr" and at.name == "tr":  # the loop met an open cell of the row first
                    at = at.parent
        chrome, doubt = _is_chrome(name, m[3])
        title = name == "header" and at.inside and not at.skip
        if title:
            chrome, doubt = _is_chrome("div", m[3])
        node = Node(name, at, at.skip or chrome, doubt)
        at.children.append(node)
        at.parts.append(node)
        if title:
            titles.append(node)
        if name in RAW:
            close = re.compile(rf"</{name}(?=[\s/>]|\Z)[^>]*(?:>|\Z)", re.I).search(page, end)
            end = close.end() if close else len(page)
        elif name not in VOID:
            at = node
    if end < len(page):
        at.parts.append(page[end:])
    for node in titles:
        _only_headings(node)
    _decide(root)
    return root


def _only_headings(header: Node) -> None:
    """Of the header of an article its headings stay; names, dates and buttons around them go."""
    found, stack = [], [header]
    while stack:
        node = stack.pop()
        if node.name in HEADINGS and not node.skip:
            found.append(node)
        else:
            stack.extend(reversed(node.children))
    for node in found:
        node.parent = header
    header.children, header.parts = found, list(found)


def _nodes(root: Node) -> list[Node]:
    """All elements, parents before children."""
    out, stack = [], [root]
    while stack:
        node = stack.pop()
        out.append(node)
        stack.extend(reversed(node.children))
    return out


def _flat(order: list[Node]) -> set[int]:
    """Inline elements (by id) without a block inside."""
    flat: set[int] = set()
    for node in reversed(order):
        if node.name in INLINE and all(c.skip or id(c) in flat for c in node.children):
            flat.add(id(node))
    return flat


def _runs(node: Node, flat: set[int]) -> Iterator[tuple[Node | None, list[str | Node]]]:
    """The parts of an element in page order: (block, [block]), or (None, text and inline elements between blocks)."""
    run: list[str | Node] = []
    for part in node.parts:
        if isinstance(part, str) or part.skip or id(part) in flat:
            run.append(part)
            continue
        if run:
            yield None, run
        yield part, [part]
        run = []
    if run:
        yield None, run


def _held(run: list[str | Node]) -> tuple[int, int, int, int]:
    """Characters, elements, characters in links and links of a run; line breaks do not count as elements."""
    chars = tags = link_chars = link_tags = 0
    for part in run:
        if isinstance(part, str):
            chars += len(part.strip())
        elif not part.skip:
            chars, tags = chars + part.chars, tags + part.tags + (part.name != "br")
            link_chars, link_tags = link_chars + part.link_chars, link_tags + part.link_tags
    return chars, tags, link_chars, link_tags


def weigh(root: Node) -> None:
    """Composite text density of every element, and the sum over its blocks. Text and inline elements
    between blocks count like a block of their own, so that a container of bare text can be the core."""
    order = _nodes(root)
    for node in reversed(order):
        if node.skip:
            continue
        node.chars += sum(len(p.strip()) for p in node.parts if isinstance(p, str))
        if node.name == "a":
            node.link_chars = node.chars
            node.link_tags += 1
        if node.parent is not None:
            up = node.parent
            up.chars, up.tags = up.chars + node.chars, up.tags + node.tags + 1
            up.link_chars, up.link_tags = up.link_chars + node.link_chars, up.link_tags + node.link_tags
    body = next((n for n in order if n.name == "body"), root)
    share = body.link_chars / body.chars if body.chars else 0.0

    def density(chars: int, tags: int, link_chars: int, link_tags: int) -> float:
        other = max(1, chars - link_chars)
        base = math.log(chars / other * max(1, link_chars) + share * chars + math.e)
        tags = max(1, tags)
        ratio = (chars / max(1, link_chars)) * (tags / max(1, link_tags))
        return chars / tags * max(0.0, math.log(ratio)) / math.log(max(base, 1.0) + 1.0)

    for node in order:
        if not node.skip and node.chars:
            node.density = density(node.chars, node.tags, node.link_chars, node.link_tags)
    flat = _flat(order)
    for node in order:
        if node.skip or id(node) in flat:
            continue
        for block, run in _runs(node, flat):
            if block is not None:
                node.sum += block.density
            elif (held := _held(run))[0]:
                node.sum += density(*held)


def _blocks(top: Node, out: list[list[str]], chosen=lambda node: node.parts) -> None:
    """Texts of the subtree, one list a block; ``chosen`` picks the parts of an element."""
    stack: list = [top]
    while stack:
        item = stack.pop()
        if item is None:
            out.append([])
        elif isinstance(item, str):
            out[-1].append(item)
        elif item.name == "br":
            out[-1].append(" ")
        elif not item.skip:
            block = item.name not in INLINE
            if block:
                out.append([])
                stack.append(None)
            stack.extend(reversed(chosen(item)))


def main_text(page: str | None) -> str:
    """The article of a page: blocks in page order, one line each.

    The element whose children's densities sum highest is the core. It is sought inside the page's articles
    or, where none has text of its own, in ``main``; the outermost one around it is the answer, together with
    the articles beside it in one ``main``, unless they are mostly links. Otherwise every subtree that is at least as dense as the thinnest
    element on the path from the body to the core belongs to it, and so do text straight in the elements
    of the path, their ``h1`` and, beside the core, headings and plain blocks that are not mostly links.
    """
    if not page or not page.strip():
        return ""
    root = parse(page)
    weigh(root)
    order = [n for n in _nodes(root) if not n.skip]
    body = next((n for n in order if n.name == "body"), root)
    inside = _nodes(body)
    live = [n for n in inside if not n.skip and n.chars]
    if not live:
        return ""
    mostly_text = lambda n: 2 * n.link_chars <= n.chars
    sought: set[int] = set()
    for name in ("article", "main"):
        for node in live:  # parents before children
            if id(node.parent) in sought or node.name == name and mostly_text(node):
                sought.add(id(node))
        if sought:
            break
    core = max((n for n in live if not sought or id(n) in sought), key=lambda n: n.sum)  # the first of equals
    if not core.sum and not sought:
        core = body
    path = [core]
    while path[-1] is not body:
        path.append(path[-1].parent)
    named = [n for n in path if n.name == "article"] or [n for n in path if n.name == "main"]
    out: list[list[str]] = [[]]
    if named:
        top = named[-1]
        beside = [top]
        if top.name == "article" and any(n.name == "main" for n in path):
            beside = [n for n in top.parent.children if n is top or n.name == "article" and not n.skip and mostly_text(n)]
        for node in beside:
            _blocks(node, out)
    elif core is body:
        _blocks(body, out)
    else:
        least = min(n.density for n in path)
        on_path = set(map(id, path))
        flat = _flat(inside)

        def chosen(node: Node) -> list[str | Node]:
            if id(node) not in on_path or node is core:
                return node.parts
            beside, out = node is core.parent, []
            for block, run in _runs(node, flat):
                if block is None:
                    chars, _, link_chars, _ = _held(run)
                    keep = 2 * link_chars <= chars
                else:
                    simple = block.name == "h1" or beside and (block.name in PLAIN or all(c.skip or id(c) in flat for c in block.children))
                    keep = id(block) in on_path or block.chars and (
                        block.density >= least or simple and 2 * block.link_chars <= block.chars
                    )
                out += run if keep else []
            return out

        _blocks(body, out, chosen)
    lines = (" ".join(entities.unescape("".join(b)).split()) for b in out)
    return "\n".join(line for line in lines if line)


def extract(pages: DataFrame, *, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """The main text of every page: page_id, url, text, n_chars (code points).

    Every page is one row's work and no row meets another, so nothing is shuffled. A null or empty page
    gives an empty text; null or repeated ids and repeated rows stay as they are; an empty table gives an
    empty result; other columns are left out, whatever their names.
    """
    picked = pages.select(
        pages[id_col].alias("page_id"), pages[url_col].alias("url"), pages[html_col].alias("html")
    )
    kind = picked.schema["page_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # Lone halves of a surrogate pair, which &#55357; and the like decode to, are no UTF-8.
            text = [main_text(h).encode("utf-8", "replace").decode("utf-8") for h in batch.column("html").to_pylist()]
            columns = [batch.column("page_id"), batch.column("url"), pa.array(text, pa.string()), pa.array(map(len, text), pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["page_id", "url", "text", "n_chars"])

    return picked.mapInArrow(run, f"page_id {kind}, url string, text string, n_chars long")
