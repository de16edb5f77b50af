"""Main text of web pages by site template removal (operator 10).

A page is parsed into elements (implied ends, unclosed and stray tags as browsers treat
them; time grows linearly with the page).  Every element's subtree is hashed from its tag and its content; Spark counts on how many pages of
a host each subtree occurs.  Subtrees that recur on ``min_pages`` different pages of their host, whatever the
host's size, are template: they are deleted.  A subtree inside one that recurs recurs as well, so a block needs
to know only the innermost element that holds it.  Elements that never hold main text (menus, headers, footers, sidebars, notices,
adverts, forms, scripts, styles, reader comments) are left out by their tag, role or class; they still
count as subtrees.  A class or id names such an element if it is one of the marks as a whole, or made of marks and words of place and form only
(``site-footer``, not ``no-sidebar`` or ``header-fixed``).

If at least half of the text that is left lies in main elements (``article`` or ``main``), the text is theirs alone; otherwise all blocks
stay, so a teaser in an ``article`` does not take the page's place.  An article's own paragraphs and headings are never
template, however often they occur: inside a main element only containers (``div``, ``section``, ``ul`` ...) can be.

Blocks are the text between block-level tags, character references decoded, white space turned into one
space and trimmed; the text is the blocks in page order, joined by one line break.

Input: ``page_id``, ``url``, ``html``; other columns are ignored.  Null html is the empty page, its text
"".  A page without host (null or odd url) has no template.  Repeated rows give repeated results; pages
with the same subtrees, copies under other urls included, count as one page.  A tag that the page's end cuts off is no text.
An empty table gives an empty table.
"""

from __future__ import annotations

import html as references
import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

from essayspark.llm.common import map_batches, written

MIN_PAGES = 5

# ---- fixed values: HTML element classes -------------------------------------------
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title noscript iframe xmp noembed noframes".split())
BLOCK = set("""
address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer
form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre section select summary table tbody td tfoot
th thead title tr ul
""".split())
LEAVES = set("p h1 h2 h3 h4 h5 h6 blockquote pre li dt dd td th figcaption".split())
NEVER = set("""
head nav footer aside form script style noscript textarea title iframe template button select input option label
dialog menu svg canvas object map audio video
""".split())
MAIN = {"article", "main"}
ROLES = set("navigation banner contentinfo complementary search form dialog alert menu menubar".split())
MARKS = set("""
ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments cookie cookies consent disqus
footer gdpr header masthead menu modal nav navbar navigation newsletter notice pagination paywall popup promo promoted related
share sharing sidebar signup social sponsor sponsored subscribe subscription toolbar widget
""".split())
#: A class word made of a mark and any of these marks as well.
PLACES = set("""
site page main global top bottom left right upper lower inner outer primary secondary list box bar slot unit area container wrapper wrap
block links link icons form thread section inline sticky mobile desktop
""".split())
#: Marks that name an ordinary paragraph or heading of an article too.
PLAIN_MARKS = {"notice", "header", "banner"}
#: A start tag of the key ends these open elements.
ENDS = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
    "option": {"option"}, "tbody": {"tr", "td", "th", "thead", "tbody"},
    "thead": {"tr", "td", "th", "thead", "tbody"}, "tfoot": {"tr", "td", "th", "tbody"},
}
#: ... unless one of these lies between.
SCOPE = set("ul ol dl table select body article main section div td".split())

#: Elements at which the search for an implied end looks.
WATCHED = SCOPE | {"p"} | set().union(*ENDS.values())

_NAME = re.compile(r"[a-zA-Z][^\s/>]*")
#: The tag's end, or one attribute: a quote counts only after "=", any other value ends at white space or ">".
_PART = re.compile(r"""[\s/]*(?:(>)|([^\s/>][^\s/>=]*)(?:\s*=\s*("[^"]*"|'[^']*'|(?!["'])[^\s>]*))?)""")
_RAW_END = {name: re.compile(rf"</{name}(?=[\s/>])", re.I | re.A) for name in sorted(RAW)}
_USED = {"class", "id", "role", "style", "hidden", "aria-hidden"}
_UNSEEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden")
_HOST = re.compile(r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)")


class Node:
    """An element; ``watched`` is the nearest watched element from here upwards, ``inline`` counts the open inline
    elements since the last block began."""

    __slots__ = ("tag", "parent", "pieces", "skip", "main", "hash", "watched", "inline")

    def __init__(self, tag, parent, skip):
        self.tag, self.parent, self.pieces, self.skip, self.hash = tag, parent, [], skip, 0
        self.main = tag in MAIN or (parent is not None and parent.main)
        self.watched = self if tag in WATCHED else parent and parent.watched
        self.inline = {} if parent is None or tag in BLOCK else parent.inline


def _tag_end(page: str, at: int) -> tuple[int, dict[str, str]]:
    """Place behind the tag's ">" (-1: the page ends before it) and the attributes that matter, from behind its name."""
    attrs: dict[str, str] = {}
    while m := _PART.match(page, at):
        at = m.end()
        if m.group(1):
            return at, attrs
        name = m.group(2).lower()
        if name in _USED:  # the first of equal names counts
            attrs.setdefault(name, (m.group(3) or "").strip("\"'").lower())
    return -1, attrs


def _is_mark(word: str, plain: bool) -> bool:
    parts = [p for p in re.split(r"[-_]+", word) if p]
    marks = MARKS - PLAIN_MARKS if plain else MARKS
    return word in marks or any(p in marks for p in parts) and all(p in marks or p in PLACES for p in parts)


def _left_out(tag: str, attrs: dict[str, str], inside_main: bool) -> bool:
    """Whether an element never holds main text, by its tag, role, class and id."""
    if tag in NEVER:
        return True
    if tag == "header":
        return not inside_main  # an article's own header holds its title
    if tag in ("html", "body", *MAIN) or not attrs:
        return False
    if "hidden" in attrs or attrs.get("aria-hidden") == "true" or attrs.get("role") in ROLES or _UNSEEN.search(attrs.get("style", "")):
        return True
    words = f"{attrs.get('class', '')} {attrs.get('id', '')}".split()
    return any(_is_mark(w, inside_main and tag in LEAVES) for w in words)


def parse(page: str) -> tuple[Node, list[Node]]:
    """Root and all elements in page order; an element's pieces are texts and elements."""
    root = here = Node("", None, False)
    nodes, at, size = [], 0, len(page)
    open_blocks: dict[str, int] = {}

    def leave(node):
        """The element that is open once ``node`` and all in it have ended."""
        inner = here
        while True:
            counts = open_blocks if inner.tag in BLOCK else inner.inline
            counts[inner.tag] -= 1
            if inner is node:
                return node.parent
            inner = inner.parent

    def add_text(start, end):
        if start < end:
            here.pieces.append(page[start:end])

    while at < size:
        start, at = at, page.find("<", at)
        if at < 0:
            add_text(start, size)
            break
        after = page[at + 1:at + 2]
        if after in ("!", "?"):
            add_text(start, at)
            if page.startswith("<!--", at):
                end = page.find("-->", at + 2)  # "<!-->" is a whole comment
                at = size if end < 0 else end + 3
            else:
                end = page.find(">", at)
                at = size if end < 0 else end + 1
            continue
        closes = after == "/"
        m = _NAME.match(page, at + 1 + closes)
        if not m:  # a plain "<"
            add_text(start, at + 1)
            at += 1
            continue
        add_text(start, at)
        name = m.group().lower()
        at, attrs = _tag_end(page, m.end())
        if at < 0:
            break
        if closes:
            counts = open_blocks if name in BLOCK else here.inline  # the end of an inline element does not end a block
            if counts.get(name):
                node = here
                while node.tag != name:
                    node = node.parent
                here = leave(node)
            elif name in BLOCK:
                here.pieces.append(None)  # a stray end still parts blocks
            continue
        closing = ENDS.get(name, set()) | ({"p"} if name in BLOCK else set())
        if closing:
            node, end = here.watched, None
            while node is not None:
                if node.tag in closing:
                    end = node
                elif node.tag in SCOPE and node.tag not in ENDS.get(name, ()):
                    break
                node = node.parent.watched
            if end is not None:
                here = leave(end)
        node = Node(name, here, here.skip or _left_out(name, attrs, here.main))
        here.pieces.append(node)
        nodes.append(node)
        if name in RAW:
            m = _RAW_END[name].search(page, at)
            end = m.start() if m else size
            node.pieces.append(page[at:end])
            close = page.find(">", end)
            at = size if close < 0 else close + 1
        elif name not in VOID:
            counts = open_blocks if name in BLOCK else node.inline
            counts[name] = counts.get(name, 0) + 1
            here = node
    return root, nodes


def extract(page: str | None) -> tuple[list[str], list[int | None], list[bool], list[int]]:
    """Blocks of text; for each the innermost subtree whose recurrence deletes it, if any, and whether it lies in a main element;
    and all subtrees of the page."""
    if not page:
        return [], [], [], []
    root, nodes = parse(page)
    for node in reversed(nodes):  # children come after their parents
        parts = [node.tag]
        for piece in node.pieces:
            parts.append(str(piece.hash) if isinstance(piece, Node) else " ".join((piece or "").split()))
        node.hash = xxh3_64_intdigest("\x00".join(parts)) - (1 << 63)
    filled = [n.hash for n in nodes if n.pieces and n.tag not in ("html", "body", "head")]
    blocks: list[str] = []
    holders: list[int | None] = []
    inside: list[bool] = []
    held: list[str] = []
    chain: list[int] = []

    def end_block(node):
        text = " ".join("".join(held).split())
        if text:
            blocks.append(text)
            holders.append(chain[-1] if chain else None)
            inside.append(node.main)
        held.clear()

    stack = [(root, 0)]
    while stack:
        node, k = stack.pop()
        if k == 0 and node.tag in BLOCK:
            end_block(node.parent)
        if k == 0 and node.tag == "br":
            held.append(" ")
        template = node.tag in BLOCK and node.tag not in ("html", "body", *MAIN) and not (node.main and node.tag in LEAVES)
        if k == 0 and template:
            chain.append(node.hash)
        pieces = node.pieces
        while k < len(pieces):
            piece = pieces[k]
            k += 1
            if isinstance(piece, Node):
                if piece.skip:
                    if piece.tag in BLOCK:
                        end_block(node)
                    continue
                stack.append((node, k))
                stack.append((piece, 0))
                break
            if piece is None:
                end_block(node)
            else:
                held.append(references.unescape(piece))
        else:
            if node.tag in BLOCK or node.parent is None:
                end_block(node)
            if template:
                chain.pop()
    return blocks, holders, inside, sorted(set(filled))


def host(url: str | None) -> str | None:
    m = _HOST.match(url or "")
    return m.group(1).lower() if m else None


def _length(blocks):
    return F.aggregate(blocks, F.lit(0).cast("bigint"), lambda n, b: n + F.length(b["blocks"]))


def _joined(blocks):
    """The text of the main elements if they hold at least half of it, else of all blocks."""
    main = F.filter(blocks, lambda b: b["inside"])
    chosen = F.when(2 * _length(main) >= _length(blocks), main).otherwise(blocks)
    return F.array_join(F.transform(chosen, lambda b: b["blocks"]), "\n").alias("text")


def main_text(pages: DataFrame, min_pages: int = MIN_PAGES) -> DataFrame:
    """page_id, url, text.  A subtree is template if it occurs on at least ``min_pages`` different pages of its
    host."""

    def make():
        def step(cols):
            out = {n: [] for n in ("blocks", "holders", "inside", "subtrees")}
            for page in cols["html"]:
                for name, v in zip(out, extract(page)):
                    out[name].append(v)
            return {"page_id": cols["page_id"], "url": cols["url"], "k": cols["k"], "host": [host(u) for u in cols["url"]]} | out

        return step

    named = pages.select("page_id", "url", "html", F.xxhash64("page_id", "url", "html").alias("k"))
    parsed = written(map_batches(named, make, "page_id long, url string, k long, host string, blocks array<string>, "
                                              "holders array<long>, inside array<boolean>, subtrees array<long>", rows=128))
    # copies of a page are no recurrence
    pages_of = parsed.filter("host is not null").groupBy("host", F.xxhash64("subtrees").alias("page")).agg(F.first("subtrees").alias("subtrees"))
    held = pages_of.select("host", F.explode("subtrees").alias("subtree"))
    template = held.groupBy("host", "subtree").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= min_pages).select("host", "subtree")
    # only subtrees that hold a block decide anything on a page
    deciding = F.array_compact(F.array_distinct("holders"))
    open_ = parsed.filter("host is not null").select("host", "k", F.explode(deciding).alias("subtree"))
    deleted = open_.join(template, ["host", "subtree"]).groupBy("k").agg(F.collect_set("subtree").alias("deleted"))
    blocks = F.arrays_zip("blocks", "holders", "inside")
    kept = F.filter(blocks, lambda b: ~F.coalesce(F.array_contains("deleted", b["holders"]), F.lit(False)))
    # pages without a subtree that could go keep all blocks: their texts need not be shuffled
    undecided = F.col("host").isNotNull() & (F.size(deciding) > 0)
    settled = parsed.filter(~undecided).select("page_id", "url", _joined(blocks))
    looked_up = parsed.filter(undecided).join(deleted, "k", "left").select("page_id", "url", _joined(kept))
    return settled.unionByName(looked_up)
