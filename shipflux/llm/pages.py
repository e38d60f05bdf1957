"""Main text of web pages: site templates and page furniture are removed, then blocks are joined.

A template is a subtree that many pages of one host have outside their article, or a block
that many otherwise different articles of one host have inside. Subtrees are hashed in
every page and counted per host in Spark.
"""

from __future__ import annotations

import hashlib
import html
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cached_property

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shipflux.session import staged

# A subtree is a template of a host if so many of its pages, and this share of them, have it.
MIN_PAGES = 5
MIN_SHARE = 0.3
# Inside articles so many of them are enough, whatever their share, for a block of so many characters.
MANY_ARTICLES = 50
LONG = 20
# A task hands its counts on when it holds so many.
HELD_COUNTS = 500_000
# Template lists of all hosts are broadcast up to so many bytes; beyond, a host's pages meet them in so many tasks.
SMALL_LISTS = 32 << 20
SALTS = 64

# Fixed values of the markup language.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes".split())
INLINE = frozenset(
    "a abbr b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span"
    " strike strong sub sup time tt u var wbr img".split()
)
# A new one of these ends an open one of the same group.
CLOSES = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option"}, "tr": {"tr", "td", "th"},
    "td": {"td", "th"}, "th": {"td", "th"}, "thead": {"tr", "td", "th"}, "tbody": {"thead", "tr", "td", "th"},
}
# These end an open paragraph, unless one of the second list lies between.
ENDS_P = frozenset(
    "address article aside blockquote center dd details dialog dir div dl dt fieldset figcaption figure footer form"
    " h1 h2 h3 h4 h5 h6 header hgroup hr li listing main menu nav ol p plaintext pre search section summary table ul".split()
)
P_SCOPE = frozenset("applet button caption html marquee object table td template th".split())
SCOPES = frozenset("ul ol dl table select article section main aside nav div body html td th blockquote".split())

# Inside an article these go only with a larger block: alike cells, items and headings are no templates.
PARTS = frozenset("tr td th thead tbody tfoot caption dt dd li pre h1 h2 h3 h4 h5 h6".split())

# Elements that are never main text, whatever they hold.
FURNITURE = frozenset(
    "head script style noscript template nav header footer aside form button input select textarea option iframe"
    " svg canvas object embed dialog menu audio video map title".split()
)
# Elements that cannot hold the page's article, whatever else it says; a form or a named block may wrap all of it.
CLOSED = FURNITURE - {"form"}
ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog menu menubar form".split())
# Words of class and id names that mark furniture.
MARKS = frozenset(
    "ad ads advert adverts advertisement advertising banner banners sponsor sponsored promo promoted"
    " nav navbar navigation menu menus breadcrumb breadcrumbs header footer sidebar sidebars aside"
    " cookie cookies consent gdpr notice notices popup modal newsletter subscribe subscription signup login"
    " comment comments commentlist disqus respond replies share sharing social related widget toolbar pagination"
    " pager skip copyright".split()
)
# Attributes as the HTML tokenizer reads them: a quote opens a value only directly after the equals sign,
# anywhere else it is an ordinary character. The parts are possessive, so a tag is read once.
GAP = r"[\t\n\f\r ]*+"
VALUE = r"""(?:"([^"]*+)(?:"|\Z)|'([^']*+)(?:'|\Z)|([^\t\n\f\r >"'][^\t\n\f\r >]*+))"""
NAME = r"([^\t\n\f\r />][^\t\n\f\r />=]*+)"
ATTRIBUTE = re.compile(rf"{NAME}(?:{GAP}={GAP}{VALUE}?+)?+")
PIECE = re.compile(
    r"<!--(?:-?>|.*?(?:--!?>|\Z))|<[!?][^>]*(?:>|\Z)|<(?P<end>/?)(?P<tag>[a-zA-Z][^\t\n\f\r />]*+)"
    rf"(?P<attributes>(?:[\t\n\f\r /]++|{ATTRIBUTE.pattern})*+)(?P<close>>|\Z)",
    re.DOTALL,
)
NAMES = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


@dataclass
class Element:
    tag: str
    attributes: str = ""
    children: list = field(default_factory=list)

    def names(self) -> dict[str, str]:
        """Values by name; of several attributes of one name the first counts."""
        found: dict[str, str] = {}
        for m in ATTRIBUTE.finditer(self.attributes):
            found.setdefault(m[1].lower(), html.unescape(m[2] or m[3] or m[4] or ""))
        return found

    @cached_property
    def furniture(self) -> bool:
        if self.tag in FURNITURE:
            return True
        if not self.attributes.strip():
            return False
        names = self.names()
        if "hidden" in names or names.get("aria-hidden") == "true" or names.get("role", "").lower() in ROLES:
            return True
        words = {w.lower() for key in ("class", "id") for w in NAMES.findall(names.get(key, ""))}
        return bool(words & MARKS) and self.tag not in ("html", "body", "article", "main") or (
            self.tag == "article" and bool(words & {"comment", "comments", "related", "promo"})
        )

    @cached_property
    def articles(self) -> list[Element]:
        return outermost(self)


def parse(source: str | None) -> Element:
    """The element tree of a page. Missing end tags are supplied, stray ones are skipped."""
    root = Element("")
    stack, at, source = [root], 0, source or ""

    def text(value: str) -> None:
        if value:
            stack[-1].children.append(html.unescape(value))

    while True:
        match = PIECE.search(source, at)
        if match is None:
            text(source[at:])
            return root
        text(source[at : match.start()])
        at = match.end()
        if not match["tag"]:
            continue
        if not match["close"]:  # a tag that the end of the page cuts off
            return root
        tag = match["tag"].lower()
        if match["end"]:
            if any(e.tag == tag for e in stack):
                while stack.pop().tag != tag:
                    pass
            continue
        if tag in ENDS_P:
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth].tag == "p":
                    del stack[depth:]
                    break
                if stack[depth].tag in P_SCOPE:
                    break
        ends = CLOSES.get(tag, ())
        for depth in range(len(stack) - 1, 0, -1):
            if stack[depth].tag in ends:
                del stack[depth:]
                break
            if stack[depth].tag in SCOPES and stack[depth].tag not in ends:
                break
        element = Element(tag, match["attributes"])
        stack[-1].children.append(element)
        if tag in VOID:
            continue
        if tag in RAW:
            end = re.compile(rf"</{tag}\b[^>]*(?:>|\Z)", re.IGNORECASE).search(source, at)
            at = end.end() if end else len(source)
            continue
        stack.append(element)


def walk(root: Element) -> Iterator[tuple[Element, bool]]:
    """Elements in page order, each when it begins (True) and when it ends (False); depth costs no recursion."""
    stack: list = [(root, False)]
    while stack:
        node, begun = stack.pop()
        yield node, not begun
        if not begun:
            stack.append((node, True))
            stack.extend((c, False) for c in reversed(node.children) if isinstance(c, Element))


def articles(root: Element) -> list[Element]:
    """The outermost article elements, or the main elements of a page without, that are no furniture."""
    return root.articles


def outermost(root: Element) -> list[Element]:
    """The articles outside furniture, or else those that only forms and blocks with furniture's names or roles wrap."""
    for wrapped in (False, True):
        for tag in ("article", "main"):
            found, inside, barred = [], 0, 0
            for node, begins in walk(root):
                step = 1 if begins else -1
                fits = node.tag == tag and not node.furniture
                if node.tag in CLOSED if wrapped else node.furniture:
                    barred += step
                if fits and not barred:
                    if begins and not inside:
                        found.append(node)
                    inside += step
            if found:
                return found
    return []


def subtree_hashes(root: Element) -> dict[int, int]:
    """A hash for every element outside the articles, by identity: tag, attributes, text and children."""
    held = {id(a) for a in articles(root)}
    hashes: dict[int, int] = {}
    inside = 0
    for node, begins in walk(root):
        if id(node) in held:
            inside += 1 if begins else -1
            hashes.pop(id(node), None)
        elif not inside and not begins and node.tag:
            parts = [node.tag, node.attributes.strip()]
            for child in node.children:
                parts.append(" ".join(child.split()) if isinstance(child, str) else str(hashes.get(id(child), 0)))
            hashes[id(node)] = digest(*parts)
    return hashes


def digest(*parts: str) -> int:
    made = hashlib.blake2b("\0".join(parts).encode("utf-8", "replace"), digest_size=8).digest()
    return int.from_bytes(made, "little", signed=True)


@dataclass
class Block:
    """A block inside an article: its hash, whether it is LONG, and texts at three places of the rest of the article."""

    element: Element
    hash: int
    long: bool
    rest: tuple[int, int, int]
    texts: range


def article_blocks(root: Element) -> tuple[int, int, list[Block]]:
    """The hash of what the articles say, the number of their texts, and the blocks inside that are not all of it.

    A text is what a block holds itself and in inline elements. Attributes are left
    out of the hashes, as they often number the copies of one block.
    """
    texts: list[list[str]] = []
    found: list[tuple[Element, int, int, int]] = []
    for article in articles(root):
        stack: list = [(article, False)]
        path: list[tuple[int, list[int]]] = []
        while stack:
            node, begun = stack.pop()
            if isinstance(node, str):
                texts[path[-1][0]].append(node)
                continue
            block = node.tag not in INLINE or node is article
            if begun:
                at, children = path.pop()
                made = digest(node.tag, " ".join("".join(texts[at]).split()), *map(str, children))
                if path:
                    path[-1][1].append(made)
                    if node.tag not in PARTS:
                        found.append((node, made, at, len(texts)))
                continue
            if node.furniture and node is not article:
                continue
            if block:
                path.append((len(texts), []))
                texts.append([])
                stack.append((node, True))
            elif node.tag == "br":
                texts[path[-1][0]].append(" ")
            stack.extend((c, False) for c in reversed(node.children))
    said = [" ".join("".join(t).split()) for t in texts]
    held = [at for at, t in enumerate(said) if t]
    hashes = [digest("text", said[at]) for at in held]
    blocks = []
    for node, made, start, stop in found:
        first, last = bisect_left(held, start), bisect_left(held, stop)
        others = len(held) - (last - first)
        if first == last or not others:
            continue
        rest = tuple(hashes[k if k < first else k + last - first] for k in (0, (others - 1) // 2, others - 1))
        long = sum(len(said[at]) for at in held[first:last]) >= LONG
        blocks.append(Block(node, made, long, rest, range(first, last)))
    return digest("article", *map(str, hashes)), len(held), blocks


def main_text(source: str | None, templates: frozenset[int] = frozenset()) -> str:
    """The blocks of the article (of the page, if it has none) without furniture and templates.

    Articles of which templates would leave nothing are copies and stay whole.
    """
    root = parse(source)
    removed = set()
    if templates and not articles(root):
        removed = {key for key, value in subtree_hashes(root).items() if value in templates}
    elif templates:
        _, texts, blocks = article_blocks(root)
        known = [b for b in blocks if b.hash in templates]
        if len({at for b in known for at in b.texts}) < texts:
            removed.update(id(b.element) for b in known)
    parts: list[str] = []
    for start in articles(root) or [root]:
        stack: list = [start]
        parts.append(" ")
        while stack:
            node = stack.pop()
            if isinstance(node, str):
                parts.append(node)
                continue
            block = node.tag not in INLINE
            if block:
                parts.append(" ")
            if id(node) not in removed and not (node.furniture and node is not start):
                stack.extend([" ", *reversed(node.children)] if block else reversed(node.children))
    return " ".join("".join(parts).split())


def templates(pages: DataFrame, min_pages: int = MIN_PAGES, min_share: float = MIN_SHARE) -> DataFrame:
    """(host, templates): the hashes that recur on a host; pages has host and html.

    Outside articles pages are counted. Inside, different articles are, and
    two of three places in the rest of them must differ too (half as many texts as
    articles): blocks of near copies of one article are no templates. A task adds up
    its pages before the shuffle.
    """
    names = ["host", "subtree", "article", "first", "middle", "last", "long"]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()
        types = [pa.string(), *[pa.int64()] * 5, pa.bool_()]

        def flush():
            columns = [pa.array([k[i] for k in held], t) for i, t in enumerate(types)]
            columns.append(pa.array(list(held.values()), pa.int64()))
            held.clear()
            return pa.RecordBatch.from_arrays(columns, names=[*names, "n"])

        def key(host, subtree, article=None, rest=(None, None, None), long=False):
            return (host, subtree, article, *rest, long)

        for batch in batches:
            for host, source in zip(batch.column("host").to_pylist(), batch.column("html"), strict=True):
                root = parse(source.as_py())
                held[key(host, None)] += 1
                held.update({key(host, h) for h in subtree_hashes(root).values()})
                article, _, blocks = article_blocks(root)
                held.update({key(host, b.hash, article, b.rest, b.long) for b in blocks})
                if len(held) >= HELD_COUNTS:
                    yield flush()
        yield flush()

    # A block that an article has twice counts once.
    once = ["host", "subtree", "article"]
    differ = [F.approx_count_distinct(place, 0.2).alias(place) for place in ("first", "middle", "last")]
    apart = sum((F.col(place) >= F.col("n_articles") / 2).cast("int") for place in ("first", "middle", "last"))
    counted = (
        pages.filter("host <> ''")
        .select("host", "html")
        .mapInArrow(
            count, "host string, subtree long, article long, first long, middle long, last long, long boolean, n long"
        )
        .groupBy(*once)
        .agg(F.sum("n").alias("n"), *(F.min(c).alias(c) for c in names[3:]))
        .groupBy("host", "subtree")
        .agg(
            F.sum(F.when(F.col("article").isNull(), F.col("n"))).alias("n"),
            F.count("article").alias("n_articles"),
            F.max("long").alias("long"),
            *differ,
        )
        .filter((F.col("n") >= min_pages) | F.col("subtree").isNull() | ((F.col("n_articles") >= min_pages) & (apart >= 2)))
    )
    counted = staged(counted, "subtrees")
    # Only what recurs on the host is collected: the share comes first.
    sizes = counted.filter("subtree IS NULL").select("host", F.col("n").alias("pages"))
    often = F.greatest(F.coalesce("n", F.lit(0)), "n_articles") >= F.col("pages") * min_share
    many = F.col("long") & (F.col("n_articles") >= MANY_ARTICLES)
    kept = counted.filter("subtree IS NOT NULL").join(sizes, "host").filter(often | many)
    return staged(kept.groupBy("host").agg(F.collect_list("subtree").alias("templates")), "templates")


def with_templates(rows: DataFrame, lists: DataFrame, small: int = SMALL_LISTS) -> DataFrame:
    """`rows` with the templates of their host, or null.

    Lists of at most `small` bytes, measured in the written table, are broadcast, so
    no page is shuffled. Larger ones are repeated for every salt, and the pages of a
    host meet them in as many tasks.
    """
    size = F.sum(F.length("host") * 4 + F.size("templates") * 8 + 64)
    if (lists.agg(size).first()[0] or 0) <= small:
        return rows.join(F.broadcast(lists), "host", "left")
    salted = lists.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    spread = rows.withColumn("salt", F.pmod(F.xxhash64("page_id", "url"), F.lit(SALTS)).cast("int"))
    return spread.join(salted.hint("merge"), ["host", "salt"], "left").drop("salt")


def extract(
    pages: DataFrame, host, page_id: str = "page_id", url: str = "url", source: str = "html"
) -> DataFrame:
    """page_id, url, text and n_chars of every page row; `host(url)` gives the column of the host.

    Main text is what the articles hold (the main element, or the body, of a page
    without articles), without furniture, comments and templates. Character references are decoded, white space becomes one
    space, blocks are joined by one. Null and empty pages have an empty text;
    pages without a host have no templates; repeated rows are extracted alike.
    """
    id_type = pages.schema[page_id].dataType.simpleString()
    rows = pages.select(
        F.col(page_id).alias("page_id"), F.col(url).alias("url"), F.col(source).alias("html"), host(F.col(url)).alias("host")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [
                main_text(s.as_py(), frozenset(t.as_py() or ()))
                for s, t in zip(batch.column("html"), batch.column("templates"), strict=True)
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("page_id"),
                    batch.column("url"),
                    pa.array(texts, pa.string()),
                    pa.array([len(t) for t in texts], pa.int64()),
                ],
                names=["page_id", "url", "text", "n_chars"],
            )

    joined = with_templates(rows, templates(rows)).select("page_id", "url", "html", "templates")
    return joined.mapInArrow(run, f"page_id {id_type}, url string, text string, n_chars long")
