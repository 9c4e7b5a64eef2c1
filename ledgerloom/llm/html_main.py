"""Main text of web pages by removal of site templates.

Each page is parsed once into a tree of elements. Every element with text is hashed with all that is below it, before
anything else; Spark counts on how many pages of its host each hash occurs, and elements that recur are deleted.
Pages count by their distinct main texts, near-copies of one text as one, so an article that is published many times,
with changes or without, is one page and not a template. Only pieces of running text (a bold word) are never candidates. Besides, the markup says of some elements
that they are no content (menus, headers, footers, sidebars, notices, adverts, forms, comments, scripts).

A page's text is that of its articles if they hold most of it, or of its main element, or else of its body. Its pieces are kept with the elements
that they are in, so pages are read, and moved, no second time.

Defined cases: a null or blank html has no text; a url without a host counts as the host ''; broken
markup is repaired (elements left open end with their parent, an unclosed script or comment takes the rest, after a quote that never
ends a tag ends at the next >); repeated rows are pages of their own; an empty table gives an empty result; other columns are ignored.
A very long or very deep page takes time and memory in proportion to its length, in one task.
"""

from __future__ import annotations

import hashlib
import html as entities
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm import common as C

#: An element is a template of a host if it is on this many of its distinct pages at least, whatever the host's size.
MIN_PAGES = 4
#: Keys (of eight) that near-copies of a text share with others at least.
SHARED = 6
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe svg object canvas".split())
DROPPED = frozenset("head script style noscript template iframe svg object canvas nav header footer aside form button input select textarea dialog menu title annotation annotation-xml".split())
BLOCKS = frozenset("address article aside blockquote body br center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
#: Class names and ids of furniture; those that content has too count only beside another (cookie-notice) and else when they recur on the host.
STRONG = re.compile(r"ads?|advert\w*|breadcrumbs?|comments?|cookies?|consent|disqus|footer|masthead|menu|nav|navbar|navigation|newsletter|pagination|popup|promo|related|share|sharing|sidebar|social|sponsor\w*|subscribe|toolbar")
WEAK = frozenset("banner header modal notice widget".split())
HEADING = re.compile(r"h[1-6]")
#: Parts that may stand before a name without changing what it says.
LEADING = frozenset("site main page top bottom global".split())
#: Elements that end an open p, and those that end one of their own kind.
ENDS_P = frozenset("address article aside blockquote center details dialog div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
SELF_ENDING = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
SCOPES = frozenset("ul ol dl table div section article main body html td".split())

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*+(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>", re.S)
UNQUOTED = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>")
TAG = re.compile(r"</?[a-zA-Z]")
ATTRIBUTE = re.compile(r"([^\s=\"'<>/]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'=<>`]+)))?")


class Node:
    __slots__ = ("tag", "attrs", "kids", "parent", "dropped", "within", "digest", "hash", "size", "holds", "headed", "inside")

    def __init__(self, tag: str, attrs: str = "", parent: "Node | None" = None):
        self.tag, self.attrs, self.parent, self.kids = tag, attrs, parent, []
        self.dropped, self.within, self.digest, self.hash, self.size, self.holds = False, False, None, b"", 0, False
        self.headed, self.inside = False, False  # a heading is below it; it is below an article or main


class Open:
    """The elements that are open, with counts by tag, of all and of those since each one that ends a search."""

    def __init__(self, root: Node):
        self.nodes, self.all, self.scopes = [root], Counter(), [Counter()]

    def push(self, node: Node) -> None:
        self.nodes.append(node)
        self.all[node.tag] += 1
        if node.tag in SCOPES:
            self.scopes.append(Counter())
        self.scopes[-1][node.tag] += 1

    def pop(self) -> str:
        tag = self.nodes.pop().tag
        self.all[tag] -= 1
        self.scopes[-1][tag] -= 1
        if tag in SCOPES:
            self.scopes.pop()
        return tag

    def close(self, tag: str) -> None:
        """An end tag: it ends the innermost element of its name and all within, if there is one."""
        if self.all[tag]:
            while self.pop() != tag:
                pass

    def imply(self, tags: tuple[str, ...]) -> None:
        """A start tag that ends one of ``tags``, unless another list, table or section has been opened in it."""
        if any(self.scopes[-1][t] for t in tags):
            while self.pop() not in tags:
                pass


def parse(page: str) -> list[Node]:
    """The elements in the order of their start tags, the tree's root first; texts are str among an element's kids."""
    root = Node("#")
    nodes, open_ = [root], Open(root)
    at, end, token = 0, len(page), TOKEN
    while at < end:
        spot = page.find("<", at)
        m = token.match(page, spot) if spot >= 0 else None
        if spot >= 0 and not m and TAG.match(page, spot):  # a quote that never ends
            token = UNQUOTED
            m = token.match(page, spot)
            if not m:
                spot = -1  # nor does any tag end any more
        if spot >= 0 and not m and token is UNQUOTED:
            m = TOKEN.match(page, spot) if page[spot + 1 : spot + 2] in ("!", "?") else None
        if spot < 0:
            open_.nodes[-1].kids.append(page[at:])
            break
        if not m:  # a bare <
            open_.nodes[-1].kids.append(page[at : spot + 1])
            at = spot + 1
            continue
        if spot > at:
            open_.nodes[-1].kids.append(page[at:spot])
        at = m.end()
        if not m[2]:
            continue
        tag = m[2].lower()
        if m[1]:
            open_.close(tag)
            continue
        if tag in ENDS_P:
            open_.imply(("p",))
        elif tag in SELF_ENDING:
            open_.imply(SELF_ENDING[tag])
        node = Node(tag, m[3], open_.nodes[-1])
        nodes.append(node)
        node.parent.kids.append(node)
        if tag in VOID or m[3].endswith("/") and tag in RAW:
            continue
        if tag in RAW:  # no markup inside: it goes on to its end tag
            close = re.compile(rf"</{re.escape(tag)}[\s/>]", re.I).search(page, at)
            stop = close.start() if close else end
            node.kids.append(page[at:stop])
            at = page.find(">", stop) + 1 or end if close else end
            continue
        open_.push(node)
    return nodes


def attributes(raw: str) -> dict[str, str]:
    return {m[1].lower(): entities.unescape(m[2] or m[3] or m[4] or "") for m in ATTRIBUTE.finditer(raw)}


def furniture(node: Node, half: float) -> bool:
    """Whether markup says that an element is no content; a name says so of no heading, and of nothing that holds an article or most of the text."""
    if node.tag == "form" and (node.holds or node.size > half):
        return False  # some sites wrap the whole page in a form
    if node.tag == "header" and node.inside and node.headed:
        return False  # an article's own head, with its headline
    if node.tag in DROPPED:
        return True
    if node.tag in ("article", "main", "body", "html") or not node.attrs.strip():
        return False
    a = attributes(node.attrs)
    if "hidden" in a or a.get("aria-hidden", "").lower() == "true" or a.get("role", "").lower() in ROLES:
        return True
    if re.search(r"display\s*:\s*none", a.get("style", "")):
        return True
    if HEADING.fullmatch(node.tag) or node.holds or node.size > half:
        return False
    return any(named(name) for name in f"{a.get('class', '')} {a.get('id', '')}".lower().split())


def named(name: str) -> bool:
    """Whether a whole class name or id says furniture: each part does, at least one surely."""
    parts = [x for x in re.split(r"[-_]+", name) if x]
    while len(parts) > 1 and parts[0] in LEADING:
        parts = parts[1:]
    sure = [bool(STRONG.fullmatch(x)) for x in parts]
    return any(sure) and all(ok or x in WEAK for ok, x in zip(sure, parts, strict=True))


def prune(nodes: list[Node]) -> None:
    """Marks what the markup says is no content; what is within that is not looked at."""
    half = nodes[0].size / 2
    for node in nodes[1:]:
        node.within = node.parent.within or node.parent.dropped
        node.inside = node.parent.inside or node.parent.tag in ("article", "main")
        node.dropped = not node.within and furniture(node, half)


def outermost(tree: Node, tag: str) -> list[Node]:
    found: list[Node] = []
    stack = [tree]
    while stack:
        node = stack.pop()
        if node.tag == tag:
            found.append(node)
        else:
            stack += [k for k in reversed(node.kids) if isinstance(k, Node) and not k.dropped]
    return found


def kept_size(tops: list[Node]) -> int:
    """Characters of text below ``tops`` that the markup does not drop."""
    total, stack = 0, list(tops)
    while stack:
        for kid in stack.pop().kids:
            if isinstance(kid, str):
                total += len(" ".join(kid.split()))
            elif not kid.dropped and kid.tag not in RAW:
                stack.append(kid)
    return total


def roots(tree: Node) -> list[Node]:
    """The outermost articles if they hold most of the text of main (without a main, of the page), so that a teaser is not taken for the text; else main; else everything."""
    main = outermost(tree, "main")
    articles = outermost(tree, "article")
    if articles and 2 * kept_size(articles) >= kept_size(main or [tree]):
        return articles
    return main or [tree]


def hashed(nodes: list[Node]) -> None:
    """The hash of each element with its tag, attributes and all that is below it, and ``digest`` of the candidates, with size and holds.

    Every element with text is a candidate, whatever the markup says of it, but for pieces of running text:
    elements within a line that has text of its own beside them, and what is within those up to the next block.
    """
    beside: set[int] = set()
    for node in reversed(nodes):  # what is within an element starts after it
        h = hashlib.blake2b(f"{node.tag} {' '.join(node.attrs.split())}\n".encode("utf-8", "surrogatepass"), digest_size=8)
        words, lines = False, [[]]  # of each line its elements, and None for text beside them
        for kid in node.kids:
            if isinstance(kid, str):
                if text := " ".join(kid.split()):
                    h.update(b"t" + text.encode("utf-8", "surrogatepass"))
                    words = True
                    node.size += len(text)
                    lines[-1].append(None)
            elif kid.tag not in RAW:
                h.update(b"e" + kid.hash)
                words = words or kid.size > 0
                node.size += kid.size
                node.holds = node.holds or kid.holds or kid.tag in ("article", "main")
                node.headed = node.headed or kid.headed or HEADING.fullmatch(kid.tag) is not None
                if kid.tag in BLOCKS:
                    lines.append([])
                else:
                    lines[-1].append(kid)
        for line in lines:
            if None in line:
                beside.update(id(kid) for kid in line if kid is not None)
        node.hash, node.digest = h.digest(), int.from_bytes(h.digest(), "little", signed=True) if words else None
    spared: set[int] = set()
    for node in nodes[1:]:
        if node.tag not in RAW and (id(node) in beside or id(node.parent) in spared and node.tag not in BLOCKS):
            spared.add(id(node))
            node.digest = None


class Pieces:
    """A page's text in pieces: ``raw`` texts, the block of each, and the innermost candidate that each is in (-1: none).

    ``up`` and ``hash``: of each candidate the one that it is in, and its hash.
    """

    def __init__(self, tops: list[Node]):
        parts: list[list[str]] = []
        self.block: list[int] = []
        self.of: list[int] = []
        self.up: list[int] = []
        self.hash: list[int] = []
        block = 0
        for top in tops:
            stack = [(top, iter(top.kids), self._candidate(top, -1))]
            block += 1
            while stack:
                node, kids, own = stack[-1]
                kid = next(kids, None)
                if kid is None:
                    stack.pop()
                    block += node.tag in BLOCKS
                elif isinstance(kid, str):
                    if parts and (self.block[-1], self.of[-1]) == (block, own):
                        parts[-1].append(kid)
                    else:
                        parts.append([kid])
                        self.block.append(block)
                        self.of.append(own)
                else:
                    block += kid.tag in BLOCKS
                    if not kid.dropped:
                        stack.append((kid, iter(kid.kids), self._candidate(kid, own)))
        self.raw = list(map("".join, parts))

    def _candidate(self, node: Node, own: int) -> int:
        if node.digest is None:
            return own
        self.up.append(own)
        self.hash.append(node.digest)
        return len(self.hash) - 1


def joined(raw, block, of, up, hashes, deleted) -> str:
    """The text without the pieces in deleted elements, white space in a block collapsed, blocks joined by one space."""
    gone = [False] * (len(hashes) + 1)  # the last stands for -1
    for k, (u, h) in enumerate(zip(up, hashes, strict=True)):
        gone[k] = gone[u] or h in deleted
    out: dict[int, list[str]] = {}
    for text, b, o in zip(raw, block, of, strict=True):
        if not gone[o]:
            out.setdefault(b, []).append(text)
    return " ".join(x for parts in out.values() if (x := " ".join(entities.unescape("".join(parts)).split())))


def prepared(page: str) -> tuple[list[Node], Pieces]:
    """The elements with hashes and marks, and the pieces of the page's text."""
    nodes = parse(page)
    hashed(nodes)
    prune(nodes)
    return nodes, Pieces(roots(nodes[0]))


#: Columns of a parsed page: its text's hash and keys, all its candidates' hashes, and its pieces.
PARSED = "page_id long, url string, host long, rid long, text long, keys array<int>, blocks array<long>, raw array<string>, block array<int>, of array<int>, up array<int>, hash array<long>"


def parsed(rows: DataFrame) -> DataFrame:
    """PARSED of each page; rows: page_id, url, host, rid, html."""
    whole, number = pa.list_(pa.int32()), pa.list_(pa.int64())
    kinds = dict(zip(("text", "keys", "blocks", "raw", "block", "of", "up", "hash"), (pa.int64(), whole, number, pa.list_(pa.string()), whole, whole, whole, number), strict=True))

    def run(batches):
        for batch in C.slices(batches, "html"):
            out: dict[str, list] = {k: [] for k in kinds}
            for page in C.strings(batch.column("html")):
                nodes, p = prepared(page)
                main = joined(p.raw, p.block, p.of, p.up, p.hash, ()).encode("utf-8", "surrogatepass")
                own = int.from_bytes(hashlib.blake2b(main, digest_size=8).digest(), "little", signed=True)
                every = list({n.digest: None for n in nodes[1:] if n.digest is not None})
                for k, x in zip(kinds, (own, C.sketch(main.split()), every, p.raw, p.block, p.of, p.up, p.hash), strict=True):
                    out[k].append(x)
            yield pa.record_batch([*(batch.column(c) for c in ("page_id", "url", "host", "rid")), *(pa.array(out[k], t) for k, t in kinds.items())], names=["page_id", "url", "host", "rid", *kinds])

    return rows.mapInArrow(run, PARSED)


def near_copies(pages: DataFrame) -> DataFrame:
    """``own`` hashes (host and text) of the texts that share SHARED of their keys with texts before them in the order of the hash: they are no pages of their own."""
    texts = pages.select(F.xxhash64("host", "text").alias("own"), "host", "keys").dropDuplicates(["own"])
    posted = C.stage(texts.select("own", "host", F.posexplode("keys").alias("k", "x")).select("own", F.xxhash64("host", "k", "x").alias("key")), "html-keys", "zstd")
    firsts = C.stage(posted.groupBy("key").agg(F.min("own").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n"), "html-firsts")
    found = C.lookup(posted, "key", firsts).where("first < own").groupBy("own").agg(F.count(F.lit(1)).alias("n")).where(f"n >= {SHARED}").select("own", F.lit(True).alias("copy"))
    found = C.stage(found, "html-copies")
    C.unstage(posted, firsts)
    return found


def templates(pages: DataFrame, copies: DataFrame) -> DataFrame:
    """``key`` (host and hash) of the elements on MIN_PAGES distinct pages of a host at least; pages: as ``parsed``.

    Pages are told apart by their texts, of which near-copies of another do not count; they may be three quarters of the texts at most.
    """
    seen = C.lookup(pages.select("host", F.xxhash64("host", "text").alias("own"), "blocks"), "own", copies)
    seen = seen.select("own", F.coalesce("copy", F.lit(False)).alias("copy"), "host", F.explode("blocks").alias("b")).select(F.xxhash64("host", "b").alias("key"), "own", "copy")
    texts = seen.groupBy("key", "own").agg(F.max("copy").alias("copy"))
    counts = texts.groupBy("key").agg(F.count(F.lit(1)).alias("texts"), F.count_if(~F.col("copy")).alias("pages"))
    return counts.where(f"pages >= {MIN_PAGES} and pages >= 0.25 * texts").select("key")


def extract(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """page_id, url, text, n_chars of every row of ``pages``."""
    host = F.lower(F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]*)", 1))
    rows = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).alias("url"), F.xxhash64(host).alias("host"), F.monotonically_increasing_id().alias("rid"), F.col(html).alias("html"))
    found = C.stage(parsed(rows), "html-parsed", "zstd")
    copies = near_copies(found.select("host", "text", "keys"))
    bad = C.stage(templates(found.select("host", "text", "blocks"), copies), "html-templates", "zstd")
    C.unstage(copies)
    # a page meets the templates among its own elements only, so no list follows the host
    own = found.select("rid", "host", F.explode("hash").alias("h")).select("rid", "h", F.xxhash64("host", "h").alias("key"))
    lists = C.stage(C.semi(own, "key", bad).groupBy("rid").agg(F.collect_set("h").alias("deleted")), "html-lists", "zstd")
    C.unstage(bad)

    def run(batches):
        for batch in batches:
            pieces = (batch.column(c).to_pylist() for c in ("raw", "block", "of", "up", "hash", "deleted"))
            texts = [joined(*x, frozenset(bad or ())) for *x, bad in zip(*pieces, strict=True)]
            yield pa.record_batch([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    kept = found.select("rid", "page_id", "url", "raw", "block", "of", "up", "hash")
    return C.lookup(kept, "rid", lists).mapInArrow(run, "page_id long, url string, text string, n_chars long")
