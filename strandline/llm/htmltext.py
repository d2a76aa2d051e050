"""Main text of web pages, with subtrees removed that recur across a host's pages."""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandline.llm.lineage import cut, map_arrow

#: A subtree is template if it is on at least so many distinct pages of its host, and on this share of them or on so many in all.
PAGES = 3
SHARE = 0.3
MANY = 1000
#: A paragraph, or a part of an article, is template only with so many different neighbours, on this share of the pages.
NEIGHBOURS = 5
NEIGHBOURS_SHARE = 0.5
#: Template hashes that may be broadcast (8 bytes each, with hosts of up to 253 bytes).
BROADCAST_HASHES = 1_000_000

# Fixed values of HTML: kinds of elements.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea noscript iframe template svg math xmp noembed noframes".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q s samp small span strike "
    "strong sub sup time tt u var wbr".split()
)
CLOSES_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 "
    "h4 h5 h6 header hgroup hr main menu nav ol p pre search section summary table ul".split()
)
CLOSES_SAME = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
    "th": {"td", "th"}, "option": {"option"}, "thead": {"tr", "td", "th"}, "tbody": {"thead", "tr", "td", "th"},
}
PARAGRAPHS = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre li dd dt td th figcaption".split())
NO_TEXT = frozenset(
    "head script style noscript template iframe svg math canvas object embed audio video map nav footer aside form "
    "button select option textarea input dialog menu search noembed noframes".split()
)
NO_ARTICLE_ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert menu menubar".split())
#: Whole names of a class, or whole ids, that say what is left out by contract; words within longer names say nothing.
NO_ARTICLE_NAMES = frozenset(
    "ad ads advert adverts advertisement comment comments footer menu nav navigation notice notices sidebar".split()
)
#: Elements at which implied end tags stop.
SCOPE = frozenset("table td th button object template article main section div nav aside footer header".split())
LISTS = frozenset("ul ol dl menu table article main nav body".split())
INLINE_SCOPE = frozenset("article main td th".split())

_QUOTED = re.compile(r"""["'>]""")
_ATTRIBUTE = re.compile(r"(?:^|\s)(class|id|role|hidden|aria-hidden)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
_NAME = re.compile(r"[a-zA-Z][^\s/>]*")
_HOST = r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/:?#]*)"


class Node:
    """An element: its name, what marks it as no article, and its children (texts and elements)."""

    __slots__ = ("name", "marks", "children", "digest", "main")

    def __init__(self, name: str, attributes: str = ""):
        self.name, self.children, self.digest, self.main = name, [], 0, False
        self.marks = _marks(name, attributes) if attributes else frozenset()


def _marks(name: str, attributes: str) -> frozenset:
    names = set()
    for key, *values in _ATTRIBUTE.findall(attributes):
        key, value = key.lower(), next((v for v in values if v), "").lower()
        if key == "role":
            names.update(f"role={x}" for x in value.split())
        elif key == "hidden" or (key == "aria-hidden" and value == "true"):
            names.add("role=hidden")
        else:
            names.update(value.split())
    return frozenset(names)


def _tag_end(text: str, at: int, closed: dict[str, int]) -> int:
    """Place of the '>' of the tag at a place, or -1. A quote after '=' hides what it encloses if it is closed.

    ``closed`` keeps the last place of each kind of quote, so that none is looked for in vain twice.
    """
    while found := _QUOTED.search(text, at):
        if found[0] == ">":
            return found.start()
        value = text[at : found.start()].rstrip().endswith("=")
        at = found.end()
        if value and found.start() < closed[found[0]]:
            at = text.index(found[0], at) + 1
    return -1


class _Open:
    """The open elements of a page, and where the last one of each name is."""

    def __init__(self, root: Node):
        self.stack, self.places = [root], {root.name: [0]}

    def push(self, node: Node) -> None:
        self.places.setdefault(node.name, []).append(len(self.stack))
        self.stack.append(node)

    def last(self, names: frozenset | set) -> int:
        return max((own[-1] for n in names if (own := self.places.get(n))), default=-1)

    def close(self, names: frozenset | set, stop: frozenset | set) -> None:
        """Close the innermost element of the names and all in it, unless an element to stop at is in between."""
        depth = self.last(names)
        if depth > 0 and depth > self.last(stop - names):
            while len(self.stack) > depth:
                self.places[self.stack.pop().name].pop()


def parse(text: str) -> Node:
    """A lenient tree of a page: end tags that are missing are implied, unknown ones ignored.

    One way through the text, in time in proportion to its length whatever is broken in it. A comment or a tag
    that is never closed takes in the rest.
    """
    root = Node("html")
    opened, at, size = _Open(root), 0, len(text)
    closed = {quote: text.rfind(quote) for quote in "\"'"}
    ends: dict[str, re.Pattern] = {}

    def add(child: str | Node) -> None:
        opened.stack[-1].children.append(child)

    while at < size:
        start = text.find("<", at)
        if start < 0:
            add(text[at:])
            break
        if start > at:
            add(text[at:start])
        following = text[start + 1 : start + 3]
        if following[:1] in ("!", "?"):
            mark = "-->" if text.startswith("<!--", start) else ">"
            end = text.find(mark, start + (4 if mark == "-->" else 1))
            at = size if end < 0 else end + len(mark)
            continue
        ending = following[:1] == "/"
        name_match = _NAME.match(text, start + 1 + ending)
        if name_match is None:
            add("<")
            at = start + 1
            continue
        end = _tag_end(text, name_match.end(), closed)
        if end < 0:
            break
        at, name, attributes = end + 1, name_match[0].lower(), text[name_match.end() : end]
        if ending:
            if name == "br":
                add(Node("br"))
            elif name not in ("html", "body"):
                opened.close({name}, INLINE_SCOPE if name in INLINE else frozenset())
            continue
        if name in ("html", "body"):
            continue
        if name in CLOSES_P:
            opened.close({"p"}, SCOPE)
        if name in CLOSES_SAME:
            opened.close(CLOSES_SAME[name], LISTS - {name})
        node = Node(name, attributes)
        add(node)
        if name in VOID or attributes.endswith("/") and name in RAW:
            continue
        if name in RAW:
            if name not in ends:
                ends[name] = re.compile(rf"</{re.escape(name)}(?=[\s/>])[^>]*>?|\Z", re.I)
            at = ends[name].search(text, at).end()
        else:
            opened.push(node)
    return root


def _no_article(node: Node, inside: bool) -> bool:
    """Whether an element is by its kind or marks no part of an article."""
    if node.name in NO_TEXT or (node.name == "header" and not inside):
        return True
    for mark in node.marks:
        if mark.startswith("role="):
            if mark[5:] in NO_ARTICLE_ROLES or mark == "role=hidden":
                return True
        elif mark in NO_ARTICLE_NAMES or (mark == "header" and not inside):
            return True
    return False


def _is_main(node: Node) -> bool:
    return node.name in ("article", "main") or "role=main" in node.marks or "role=article" in node.marks


def digest(root: Node) -> None:
    """Hash every subtree (name, marks, texts with white space as one blank, children), and note articles."""
    order, stack = [], [root]
    while stack:
        node = stack.pop()
        order.append(node)
        stack.extend(c for c in node.children if isinstance(c, Node))
    for node in reversed(order):
        state = xxhash.xxh64(f"{node.name} {' '.join(sorted(node.marks))}".encode())
        node.main = _is_main(node)
        filled = False
        for child in node.children:
            if isinstance(child, Node):
                node.main |= child.main
                if child.digest:
                    state.update(b"\1%d" % child.digest)
                    filled = True
            elif words := " ".join(child.split()):
                state.update(b"\2" + words.encode("utf-8", "replace"))
                filled = True
        node.digest = (state.intdigest() or 1) if filled else 0


def candidates(root: Node) -> set[tuple[int, int]]:
    """(hash, neighbours) of each subtree that could be template; 0 where neighbours do not matter.

    A copied article brings its paragraphs with their neighbours, a notice that a site puts into all its
    articles has others each time. So what may be an article's own text, in an article or as a paragraph
    anywhere, goes with a hash of the nearest siblings.
    """
    found, stack = set(), [(root, False)]
    while stack:
        node, inside = stack.pop()
        own = [c.digest if isinstance(c, Node) else 2 for c in node.children if (c.digest if isinstance(c, Node) else c.strip())]
        place = 0
        for child in node.children:
            if not isinstance(child, Node):
                place += bool(child.strip())
                continue
            if not child.digest:
                continue
            place += 1
            if child.name == "head":
                continue
            text = inside or child.name in PARAGRAPHS
            if not child.main and not (text and child.name in INLINE):
                around = (own[place - 2] if place > 1 else 1, own[place] if place < len(own) else 1)
                found.add((child.digest, xxhash.xxh64(b"%d %d" % around).intdigest() or 1 if text else 0))
            if child.name not in PARAGRAPHS:
                stack.append((child, inside or _is_main(child)))
    return found


def main_text(root: Node, template: set[int]) -> str:
    """Blocks of the article, one to a line; of the whole page if it has no article. Template subtrees are deleted first."""
    mains: list[Node] = []
    stack = [root]
    while stack:
        node = stack.pop()
        if node is not root and (node.digest in template or not node.main and _no_article(node, False)):
            continue
        if node is not root and node.name == "article" and not _no_article(node, True):
            mains.append(node)
            continue
        stack.extend(c for c in reversed(node.children) if isinstance(c, Node))
    if not mains:
        stack = [root]
        while stack:
            node = stack.pop()
            if node is not root and node.digest in template:
                continue
            if node is not root and _is_main(node) and not _no_article(node, True):
                mains.append(node)
                continue
            stack.extend(c for c in reversed(node.children) if isinstance(c, Node))
    blocks: list[str] = []
    text: list[str] = []

    def end() -> None:
        joined = " ".join(html.unescape("".join(text)).split())
        text.clear()
        if joined:
            blocks.append(joined)

    for top in mains or [root]:
        todo: list = [top]
        while todo:
            item = todo.pop()
            if item is None:
                end()
            elif isinstance(item, str):
                text.append(item)
            elif item.name == "br":
                text.append(" ")
            elif item is not top and (item.name in RAW or _no_article(item, bool(mains)) or item.digest in template):
                if item.name not in INLINE:
                    end()
            else:
                if item.name not in INLINE:
                    end()
                    todo.append(None)
                todo.extend(reversed(item.children))
        end()
    return "\n".join(blocks)


def _subtrees(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(host, html) -> (host, page, hash, around); around is 0 where pages are counted, else a hash of neighbours."""
    for frame in frames:
        hosts, pages, hashes, around = [], [], [], []
        for host, page in zip(frame.column(0).to_pylist(), frame.column(1).to_pylist()):
            root = parse(page or "")
            digest(root)
            own = xxhash.xxh64(str(root.digest).encode()).intdigest() - (1 << 63)
            for value, beside in [(0, 0), *candidates(root)]:
                hosts.append(host)
                pages.append(0 if beside else own)
                hashes.append(value - (1 << 63) if value else 0)
                around.append(beside - (1 << 63) if beside else 0)
        yield pa.RecordBatch.from_arrays(
            [pa.array(hosts, pa.string()), pa.array(pages, pa.int64()), pa.array(hashes, pa.int64()), pa.array(around, pa.int64())],
            names=["host", "page", "hash", "around"],
        )


def _extracted(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for frame in frames:
        texts = []
        for page, template in zip(frame.column(2).to_pylist(), frame.column(3).to_pylist()):
            root = parse(page or "")
            digest(root)
            texts.append(main_text(root, {x + (1 << 63) for x in template or ()}))
        yield pa.RecordBatch.from_arrays(
            [frame.column(0), frame.column(1), pa.array(texts, pa.string())], names=["page_id", "url", "text"]
        )


def extract_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Main text of each page, from its whole HTML.

    Returns the id, the url, ``text`` (blocks in page order, one to a line, white space within a
    block as one blank) and ``n_chars`` (code points). Subtrees are hashed and counted over the distinct
    pages of each host, and those on PAGES and on SHARE of them, or on MANY, are deleted. Paragraphs and parts of
    articles are counted by their different neighbours instead (NEIGHBOURS, NEIGHBOURS_SHARE): a copied article is
    no template. Then what by its element, role, or whole class name is no article goes, and if an article (or
    main) element is left, the text outside.

    A null or empty page, and a page without text, gives an empty text. A null or unusual url has the
    host ''. Repeated rows repeat their result but count once as pages; other columns are ignored; an
    empty table gives no rows.
    """
    host = F.lower(F.coalesce(F.regexp_extract(F.col(url_col), _HOST, 1), F.lit("")))
    source = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), host.alias("host"), F.col(html_col).alias("html"))
    found = map_arrow(source.select("host", "html"), _subtrees, "host string, page long, hash long, around long")
    by_neighbours = (F.col("around") != 0).alias("beside")
    counts = found.distinct().groupBy("host", "hash", by_neighbours).agg(F.count("*").alias("n"))
    counts = cut(counts.where((F.col("hash") == 0) | (F.col("n") >= PAGES)))
    totals = counts.where("hash = 0").select("host", F.col("n").alias("all"))
    often = F.when(F.col("beside"), (F.col("n") >= NEIGHBOURS) & (F.col("n") >= F.col("all") * NEIGHBOURS_SHARE)).otherwise(
        (F.col("n") >= F.col("all") * SHARE) | (F.col("n") >= MANY)
    )
    template = counts.where("hash != 0").join(totals, "host").where(often)
    hosts = cut(template.groupBy("host").agg(F.collect_set("hash").alias("template")))
    size = hosts.agg(F.sum(F.size("template"))).first()[0] or 0
    hosts = F.broadcast(hosts) if size <= BROADCAST_HASHES else hosts
    known = source.join(hosts, "host", "left").select("page_id", "url", "html", "template")
    texts = map_arrow(known, _extracted, f"page_id {dict(source.dtypes)['page_id']}, url string, text string")
    return texts.select(F.col("page_id").alias(id_col), F.col("url").alias(url_col), "text", F.length("text").cast("long").alias("n_chars"))
