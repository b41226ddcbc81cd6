"""Main text of web pages by consensus host paths.

Each page is read into a light tree and its containers are scored by the blocks of prose
below them. The lowest container that holds them all, or the article element around it, is
the page's own (of several parts that reader comments divide at the level of the page, the
largest counts), and the page votes for its generalised tag-class path. Spark sums the
votes of every host; a path with a quarter of them wins, and the first one always does.
Each page is then extracted again: from its own container if that lies on a winning
path, else from the first winning path that it has text on, else from its own container.
A page whose article is short or odd so profits from the others of its host.

Markup is read by the attribute states of HTML in time linear in the page, however deep
its elements are nested. As in browsers, a tag that is never closed swallows the rest.

Results, by case: a NULL or empty html, or one without prose, has an empty text; a page
without a host in its url votes for itself only; repeated rows are extracted each;
NULL ids pass through; markup that breaks off is read as far as it goes; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import html as references
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retail_lake.workspace import stage

#: A path wins if it has this share of its host's votes.
LEAST_SHARE = 0.25
#: Characters outside links from which a block is prose; a first-level heading always is.
LEAST_PROSE = 20

# Fixed values of HTML: elements without content, with raw content, and in blocks.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe svg xmp".split())
BLOCKS = frozenset(
    "html body address article aside blockquote center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr li main menu nav ol p pre "
    "section summary table tbody td tfoot th thead tr ul".split()
)
#: Elements that a start tag of the same group closes.
CLOSED_BY = {
    "li": {"li"},
    "dt": {"dt", "dd"},
    "dd": {"dt", "dd"},
    "tr": {"tr", "td", "th"},
    "td": {"td", "th"},
    "th": {"td", "th"},
    "option": {"option"},
}
#: Elements past which no end tag is implied.
SCOPES_OF_P = frozenset("button caption html object table td th".split())
SCOPES_OF_ITEMS = frozenset("table ul ol dl select".split())
# Elements and words in classes and ids that are no article text.
NOISE = frozenset("nav header footer aside form button select dialog menu".split()) | RAW
NOISE_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert".split())
NOISE_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner "
    "cookie cookies consent gdpr notice notification newsletter subscribe subscription signup "
    "login popup modal overlay sidebar side menu nav navbar navigation breadcrumb breadcrumbs "
    "footer header masthead comment comments disqus respond reply share sharing social related "
    "recommended recommendations widget toolbar pagination pager skip search".split()
)
#: Words that tell that a container is the article, and a header with them its title.
ARTICLE_WORDS = frozenset("article post entry story".split())
#: First words of classes that describe a layout, not the element that has them.
LAYOUT_WORDS = frozenset("has no with without".split())
#: Noise that is reader comments; at the level of the page an article doesn't go on after it.
REPLY_WORDS = frozenset("comment comments disqus respond".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Blocks that are no containers by themselves.
LEAVES = HEADINGS | frozenset("p pre blockquote ul ol dl li dt dd tr thead tbody tfoot".split())

_MARKUP = re.compile(r"<(?=[a-zA-Z/!?])")
_TAG_NAME = re.compile(r"[a-zA-Z][^\s/>]*+")
_ATTRIBUTE = re.compile(
    r"""[\s/]*+([^\s/>][^\s/>=]*+)(?:\s*+=\s*+("[^"]*+"|'[^']*+'|(?!["'])[^\s>]*+))?+"""
)
_TAG_END = re.compile(r"[\s/]*+>")
_COMMENT = re.compile(r"<!--(?:-?>|.*?(?:--!?>|\Z))", re.DOTALL)
_RAW_END = {tag: re.compile(rf"</{tag}(?=[\s/>])", re.IGNORECASE) for tag in RAW}
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
_WORD = re.compile(r"[a-z]+")
_DIGITS = re.compile(r"\d+")


class Node:
    """An element, or the document: its children are nodes and texts."""

    __slots__ = (
        "article", "children", "held", "linked", "noise", "prose", "replies", "size", "step", "tag"
    )

    def __init__(self, tag: str, step: str = "", noise: bool = False, article: bool = False):
        self.tag, self.step, self.noise, self.article = tag, step, noise, article
        self.children: list = []
        self.replies = False
        # Characters directly in this block and in links there; from here down, blocks of
        # prose and their characters.
        self.size = self.linked = self.held = self.prose = 0


def _attributes(source: str, at: int) -> tuple[dict[str, str], int]:
    """Attributes from a place in a tag, and where the tag ends; -1 if it does not."""
    out: dict[str, str] = {}
    if source.startswith(">", at):
        return out, at + 1
    while True:
        end = _TAG_END.match(source, at)
        if end is not None:
            return out, end.end()
        m = _ATTRIBUTE.match(source, at)
        if m is None or m.end() == at:
            return out, -1
        value = m[2] or ""
        if value[:1] in ('"', "'"):
            value = value[1:-1]
        elif m[2] is None and source[m.end() : m.end() + 64].lstrip()[:1] == "=":
            return out, -1  # a quote that is never closed
        out.setdefault(m[1].lower(), value)
        at = m.end()


def _names(attributes: dict[str, str]) -> list[set[str]]:
    """Words of every class and of the id."""
    names = f"{attributes.get('class', '')} {attributes.get('id', '')}".split()
    words = [_WORD.findall(_CAMEL.sub("-", name).lower()) for name in names]
    return [set(w) for w in words if w and w[0] not in LAYOUT_WORDS]


def _is_noise(tag: str, attributes: dict[str, str]) -> bool:
    if tag in NOISE:
        return True
    if not attributes or tag in ("body", "html", "article", "main"):
        return False
    if attributes.get("role", "").lower() in NOISE_ROLES or "hidden" in attributes:
        return True
    if attributes.get("aria-hidden") == "true" or "display:none" in attributes.get(
        "style", ""
    ).replace(" ", ""):
        return True
    words: set[str] = set().union(*_names(attributes))
    found = words & NOISE_WORDS
    if tag in HEADINGS or words & ARTICLE_WORDS:
        found -= {"header"}
    return bool(found)


def _is_article(tag: str, attributes: dict[str, str]) -> bool:
    if tag in ("article", "main") or attributes.get("role") in ("article", "main"):
        return True
    return tag in ("div", "section") and any(w & ARTICLE_WORDS for w in _names(attributes))


def _step(tag: str, attributes: dict[str, str]) -> str:
    classes = sorted({_DIGITS.sub("#", c) for c in attributes.get("class", "").lower().split()})
    return ".".join([tag, *classes])


class _Open:
    """Open elements, and for every tag the depths it is open at."""

    def __init__(self, root: Node):
        self.nodes = [root]
        self.depths: dict[str, list[int]] = {}
        self.blocks = [0]

    def push(self, node: Node) -> None:
        self.depths.setdefault(node.tag, []).append(len(self.nodes))
        if node.tag in BLOCKS:
            self.blocks.append(len(self.nodes))
        self.nodes.append(node)

    def last(self, tags: frozenset[str] | set[str]) -> int:
        return max((self.depths[t][-1] for t in tags if self.depths.get(t)), default=0)

    def cut(self, depth: int) -> None:
        while len(self.nodes) > depth:
            tag = self.nodes.pop().tag
            self.depths[tag].pop()
            if tag in BLOCKS:
                self.blocks.pop()

    def close(self, tags: frozenset[str] | set[str], scopes: frozenset[str] | set[str]) -> bool:
        """Closes the last open element of some tags, unless a scope lies within it."""
        depth = self.last(tags)
        if not depth or self.last(scopes) > depth:
            return False
        self.cut(depth)
        return True


def parse(source: str) -> Node:
    """The tree of a page. End tags without a start are skipped, missing ones implied."""
    root = Node("")
    stack = _Open(root)
    at, size = 0, len(source)
    while at < size:
        m = _MARKUP.search(source, at)
        begin = size if m is None else m.start()
        if begin > at:
            stack.nodes[-1].children.append(source[at:begin])
        if m is None:
            break
        closing = source[begin + 1] == "/"
        name = _TAG_NAME.match(source, begin + 1 + closing)
        if name is None:
            at = _after_declaration(source, begin)
            continue
        tag = name[0].lower()
        attributes, at = _attributes(source, name.end())
        if at < 0:
            break
        if closing:
            _end_tag(stack, tag)
        elif tag in RAW:
            end = _RAW_END[tag].search(source, at)
            at = size if end is None else end.start()
        else:
            _start_tag(stack, tag, attributes)
    return root


def _after_declaration(source: str, begin: int) -> int:
    """The end of a comment or of what browsers take for one."""
    comment = _COMMENT.match(source, begin)
    if comment is not None:
        return comment.end()
    end = source.find(">", begin)
    return len(source) if end < 0 else end + 1


def _start_tag(stack: _Open, tag: str, attributes: dict[str, str]) -> None:
    if tag in BLOCKS:
        stack.close({"p"}, SCOPES_OF_P)
    if tag in CLOSED_BY:
        stack.close(CLOSED_BY[tag], SCOPES_OF_ITEMS)
    parent = stack.nodes[-1]
    node = Node(
        tag,
        _step(tag, attributes),
        parent.noise or _is_noise(tag, attributes),
        _is_article(tag, attributes),
    )
    if attributes and node.noise and not parent.noise:
        node.replies = any(words & REPLY_WORDS for words in _names(attributes))
    parent.children.append(node)
    if tag not in VOID:
        stack.push(node)


def _end_tag(stack: _Open, tag: str) -> None:
    if tag in RAW:
        return
    if tag == "p":
        if not stack.close({"p"}, SCOPES_OF_P):
            stack.nodes[-1].children.append(Node("p", "p", stack.nodes[-1].noise))
        return
    depth = stack.last({tag})
    # The end of a mere format does not end blocks.
    if depth and (tag in BLOCKS or depth >= stack.blocks[-1]):
        stack.cut(depth)


def _plain(raw: str) -> str:
    return references.unescape(raw) if "&" in raw else raw


def text_blocks(node: Node, left_out: set[int] | frozenset[int] = frozenset()) -> list[str]:
    """Texts of the blocks below a node in page order, without noise."""
    out: list[str] = []
    pieces: list[str] = []

    def flush() -> None:
        text = " ".join("".join(pieces).split())
        pieces.clear()
        if text:
            out.append(text)

    stack: list = [node]
    while stack:
        item = stack.pop()
        if item is None:
            flush()
        elif isinstance(item, str):
            pieces.append(_plain(item))
        elif (item.noise or id(item) in left_out) and item is not node:
            continue
        elif item.tag == "br":
            pieces.append(" ")
        else:
            block = item.tag in BLOCKS
            if block:
                flush()
                stack.append(None)
            stack += reversed(item.children)
    flush()
    return out


def _measure(root: Node) -> list[tuple[Node, int]]:
    """Elements outside noise in page order, each with its parent's place; sizes of blocks."""
    order: list[tuple[Node, int]] = []
    stack: list = [(root, -1, root, False)]
    while stack:
        item, parent, block, link = stack.pop()
        if isinstance(item, str):
            size = len(_plain(item.strip()).strip())
            block.size += size
            block.linked += size if link else 0
            continue
        if item.noise:
            continue
        if item.tag in BLOCKS:
            block = item
        link = link or item.tag == "a"
        order.append((item, parent))
        place = len(order) - 1
        stack += [(child, place, block, link) for child in reversed(item.children)]
    return order


def score_containers(root: Node) -> bool:
    """Sets ``held``, the blocks of prose in an element; whether there are any.

    Where no block is long enough, all with more text than links count.
    """
    order = _measure(root)
    for least in (LEAST_PROSE, 1):
        for node, _ in order:
            prose = node.size - 2 * node.linked
            node.held = int(prose >= (1 if node.tag == "h1" else least))
            node.prose = prose * node.held
        if any(node.held and node.tag not in HEADINGS for node, _ in order) or least == 1:
            break
    for node, parent in reversed(order):
        if parent >= 0:
            order[parent][0].held += node.held
            order[parent][0].prose += node.prose
    return root.held > 0


def _beyond_comments(node: Node) -> list[Node]:
    """Children of the body that reader comments part from those with most of the prose."""
    regions: list[list[Node]] = [[]]
    for child in node.children:
        if isinstance(child, Node):
            if child.replies:
                regions.append([])
            regions[-1].append(child)
    best = max(regions, key=lambda region: sum(c.prose for c in region))
    return [c for region in regions if region is not best for c in region if c.held]


def own_container(root: Node) -> tuple[list[Node], set[int]]:
    """Elements from the document down to the one with the article, or none; and ids of
    elements below that are no part of it.

    That is the lowest container of all prose, and where it lies in an article or in an
    element that is named so, the outermost of those.
    """
    left_out: set[int] = set()
    if not score_containers(root):
        return [], left_out
    chain, held = [root], root.held
    while True:
        node = chain[-1]
        inner = [c for c in node.children if isinstance(c, Node) and c.held]
        if node.tag in ("", "html", "body") and sum(c.held for c in inner) == held:
            beyond = _beyond_comments(node)
            left_out.update(map(id, beyond))
            held -= sum(c.held for c in beyond)
            inner = [c for c in inner if id(c) not in left_out]
        inner = [c for c in inner if c.held == held]
        if not inner:
            break
        chain.append(inner[0])
    while len(chain) > 1 and (chain[-1].tag in LEAVES or chain[-1].tag not in BLOCKS):
        chain.pop()
    for tags in (("article",), ("main",), ("div", "section")):
        for depth, node in enumerate(chain):
            if node.article and node.tag in tags:
                return chain[: depth + 1], left_out
    return chain, left_out


def path_of(chain: list[Node]) -> str:
    """Steps down to the last element; neither tags nor classes have white space."""
    return " ".join(node.step for node in chain[1:])


def vote_of(source: str) -> str | None:
    """The path that a page votes for; None without prose."""
    chain, _ = own_container(parse(source))
    return path_of(chain) if chain else None


def _on_path(root: Node, path: str) -> list[Node]:
    level = [root]
    for step in path.split():
        level = [
            c
            for node in level
            for c in node.children
            if isinstance(c, Node) and c.step == step and not c.noise
        ]
    return level


def extract(source: str, winners: list[str]) -> str:
    """The main text of a page, given the winning paths of its host."""
    root = parse(source)
    chain, left_out = own_container(root)
    if not chain:
        return ""
    if path_of(chain) not in winners:
        for path in winners:
            found = [block for node in _on_path(root, path) for block in text_blocks(node)]
            if found:
                return "\n".join(found)
    return "\n".join(text_blocks(chain[-1], left_out))


def _with_host(pages: DataFrame) -> DataFrame:
    host = F.lower(F.regexp_extract("url", r"//(?:[^/@]*@)?([^/:?#]+)", 1))
    return pages.select(
        "page_id",
        "url",
        F.coalesce("html", F.lit("")).alias("html"),
        F.when(host != "", host).alias("host"),
    )


def host_votes(pages: DataFrame) -> DataFrame:
    """``host``, ``path`` and the sum of ``votes`` over all its pages."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            paths = [vote_of(source) for source in batch["html"]]
            yield pd.DataFrame({"host": batch["host"], "path": paths})

    cast = _with_host(pages).where("host IS NOT NULL").select("host", "html")
    each = cast.mapInPandas(run, "host string, path string").where("path IS NOT NULL")
    return each.groupBy("host", "path").agg(F.count("*").alias("votes"))


def winning_paths(votes: DataFrame) -> DataFrame:
    """``host`` and its ``winners``, by falling votes: five at most."""
    totals = votes.groupBy("host").agg(
        F.sum("votes").alias("total"), F.min(F.struct(-F.col("votes"), "path"))["path"].alias("first")
    )
    good = votes.join(totals, "host").where(
        (F.col("votes") >= LEAST_SHARE * F.col("total")) | (F.col("path") == F.col("first"))
    )
    ranked = F.array_sort(F.collect_list(F.struct((-F.col("votes")).alias("low"), "path")))
    return good.groupBy("host").agg(F.transform(ranked, lambda x: x["path"]).alias("winners"))


def main_text(pages: DataFrame) -> DataFrame:
    """``page_id``, ``url``, ``text`` and ``n_chars`` of every page."""
    # A written table, so that a host with very many pages can be split in the join.
    winners = stage(winning_paths(host_votes(pages)), "hosts").rows

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = [
                extract(source, [] if paths is None else list(paths))
                for source, paths in zip(batch["html"], batch["winners"], strict=True)
            ]
            yield pd.DataFrame({"page_id": batch["page_id"], "url": batch["url"], "text": texts})

    rows = _with_host(pages).join(winners, "host", "left")
    # As text: beside a NULL, pandas would make long ids fractions and round them.
    kind = pages.schema["page_id"].dataType
    own = F.col("page_id").cast("string").alias("page_id")
    found = rows.select(own, "url", "html", "winners").mapInPandas(
        run, "page_id string, url string, text string"
    )
    return found.select(
        F.col("page_id").cast(kind).alias("page_id"),
        "url",
        "text",
        F.length("text").cast("long").alias("n_chars"),
    )
