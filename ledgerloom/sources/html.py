"""What a listing page tells by its markup: head fields, headings, links, coordinates, questions, paragraphs."""

from __future__ import annotations

import json
import re
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as S

from ledgerloom.functions import text as T

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset("address article aside blockquote body br button dd details div dl dt figure footer form h1 h2 h3 h4 h5 h6 header hr li main nav ol p pre section summary table td th tr ul".split())
#: Where pages state a map point, in order of trust.
COORDINATES = (
    r"(?i)destination=(-?\d+\.?\d*),(-?\d+\.?\d*)",
    r"(?i)[?&]q=(-?\d+\.?\d*),(-?\d+\.?\d*)",
    r'(?i)"latitude"\s*:\s*(-?\d+\.?\d*).{0,80}"longitude"\s*:\s*(-?\d+\.?\d*)',
    r'(?i)"lat"\s*:\s*(-?\d+\.?\d*).{0,40}"lng"\s*:\s*(-?\d+\.?\d*)',
)
NOISE = ("authorize company", "disclaimer", "copyright", "enter your details", "request callback", "get in touch")
ASKING = ("what ", "when ", "how ", "who ")
LEAST_OVERVIEW, LEAST_ANSWER = 120, 12
_FAQ = S.StructType([S.StructField("question", S.StringType()), S.StructField("answer", S.StringType())])
EXTRAS = S.StructType(
    [S.StructField(n, S.StringType()) for n in ("title", "meta_description", "canonical", "h1")]
    + [S.StructField("faqs", S.ArrayType(_FAQ)), S.StructField("paragraphs", S.ArrayType(S.StringType())), S.StructField("links", S.ArrayType(S.StringType()))]
)


class Element:
    __slots__ = ("tag", "attrs", "kids", "parent")

    def __init__(self, tag: str, attrs: dict, parent):
        self.tag, self.attrs, self.kids, self.parent = tag, attrs, [], parent

    def text(self) -> str:
        parts: list[str] = []
        stack = [self]
        while stack:
            x = stack.pop()
            if isinstance(x, str):
                parts.append(x)
            elif x.tag not in ("script", "style") or x is self:
                parts.append(" ")
                stack += ["\n" if x.tag in BLOCK else "", *reversed(x.kids)]
        return "".join(parts)

    def every(self, *tags: str):
        stack = [self]
        while stack:
            x = stack.pop()
            if isinstance(x, Element):
                if x.tag in tags:
                    yield x
                stack += reversed(x.kids)


class Tree(HTMLParser):
    """Elements of a page. Nothing that a page holds is an error: an odd declaration is no element and no text."""

    def __init__(self, page: str):
        super().__init__(convert_charrefs=True)
        self.root = self.at = Element("#", {}, None)
        self.open: dict[str, int] = {}
        self.feed(page)
        self.close()

    def parse_html_declaration(self, i):
        """Declarations that the parser knows go its way, others end with their bracket."""
        if self.rawdata[i : i + 3] == "<![" or self.rawdata[i : i + 9].lower() != "<!doctype" and self.rawdata[i : i + 4] != "<!--":
            end = self.rawdata.find(">", i + 2)
            return end + 1 if end >= 0 else -1
        return super().parse_html_declaration(i)

    def handle_starttag(self, tag, attrs):
        if tag == "p" and self.at.tag == "p":
            self._leave()
        x = Element(tag, {k: v or "" for k, v in attrs}, self.at)
        self.at.kids.append(x)
        if tag not in VOID:
            self.at = x
            self.open[tag] = self.open.get(tag, 0) + 1

    def _leave(self):
        self.open[self.at.tag] -= 1
        self.at = self.at.parent

    def handle_startendtag(self, tag, attrs):
        self.at.kids.append(Element(tag, {k: v or "" for k, v in attrs}, self.at))

    def handle_endtag(self, tag):
        if self.open.get(tag):  # an end without a beginning would walk all the way up each time
            while self.at.tag != tag:
                self._leave()
            self._leave()

    def handle_data(self, data):
        self.at.kids.append(data)


def whole_characters(text: str) -> str:
    """``text`` without halves of characters, which embedded JSON can name and no column holds."""
    return text if text.isascii() else text.encode("utf-8", "replace").decode("utf-8")


def squeeze(text: str | None) -> str:
    return whole_characters(" ".join((text or "").split()))


def ld_json(tree: Element) -> list[dict]:
    """Objects of all JSON-LD scripts, lists flattened."""
    out = []
    for s in tree.every("script"):
        if "ld+json" in s.attrs.get("type", "").lower():
            try:
                data = json.loads("".join(k for k in s.kids if isinstance(k, str)))
            except (ValueError, RecursionError):
                continue
            out += [x for x in (data if isinstance(data, list) else [data]) if isinstance(x, dict)]
    return out


def questions(tree: Element) -> list[dict]:
    """Questions and answers: disclosure elements, question-like headings, lines of text, structured data; first of each question."""
    found: dict[str, dict] = {}

    def add(q, a):
        if not all(x is None or isinstance(x, str) for x in (q, a)):
            return
        q, a = squeeze(q), squeeze(a)
        if q and len(a) >= LEAST_ANSWER and not any(n in a.lower() for n in NOISE):
            found.setdefault(q.lower(), {"question": q, "answer": a})

    for d in tree.every("details"):
        head = next(d.every("summary"), None)
        if head is not None:
            add(head.text(), " ".join(k if isinstance(k, str) else k.text() for k in d.kids if k is not head))
    after_of: dict[Element, tuple[dict, list]] = {}  # of a parent: places of its children, and the next element after each place

    def following(h):
        if h.parent not in after_of:
            kids, nearest, then = h.parent.kids, None, [None] * len(h.parent.kids)
            for k in range(len(kids) - 1, -1, -1):
                then[k] = nearest
                nearest = kids[k] if isinstance(kids[k], Element) else nearest
            after_of[h.parent] = {id(x): k for k, x in enumerate(kids)}, then
        places, then = after_of[h.parent]
        return then[places[id(h)]]

    for h in tree.every("h2", "h3", "h4", "button"):
        q = squeeze(h.text())
        if "?" not in q and not q.lower().startswith(ASKING) or not (q.endswith("?") or q.lower().startswith((*ASKING, "is ", "are ", "why "))):
            continue
        nearest = following(h)
        answer = squeeze(nearest.text()) if nearest is not None else squeeze(h.parent.text()).replace(q, "", 1)
        add(q if q.endswith("?") else q + "?", answer)
    lines = "\n".join(x for x in map(squeeze, tree.text().split("\n")) if x)
    for m in re.finditer(r"(?i)(What [^?\n]{8,120}\?)\n([^\n]{20,500})", lines):
        add(m[1], m[2])
    for node in ld_json(tree):
        main = node.get("mainEntity") or []
        for item in main if isinstance(main, list) else [main]:
            if isinstance(item, dict):
                answer = item.get("acceptedAnswer") or item.get("answer")
                add(item.get("name") or item.get("question"), answer.get("text") if isinstance(answer, dict) else answer)
    return list(found.values())


def page_extras(page: str | None, tree: Element | None = None) -> dict:
    """What the markup tells; ``tree``: the page's elements, if they are known already."""
    tree = tree or Tree(page or "").root
    meta = {}
    for m in tree.every("meta"):
        meta.setdefault((m.attrs.get("name") or m.attrs.get("property") or "").lower(), m.attrs.get("content", ""))
    first = lambda tag: next((squeeze(x.text()) for x in tree.every(tag)), "")
    paragraphs = [p for p in (squeeze(x.text()) for x in tree.every("p")) if len(p) >= LEAST_OVERVIEW and not any(n in p.lower() for n in NOISE)]
    return {
        "title": first("title") or None, "meta_description": squeeze(meta.get("description") or meta.get("og:description")) or None,
        "canonical": next((x.attrs.get("href") for x in tree.every("link") if x.attrs.get("rel", "").lower() == "canonical"), None) or None, "h1": first("h1") or None,
        "faqs": questions(tree), "paragraphs": paragraphs, "links": [a.attrs["href"] for a in tree.every("a") if a.attrs.get("href")],
    }


@F.pandas_udf(EXTRAS)
def _extras(pages: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([page_extras(p) for p in pages], columns=EXTRAS.names)


def extras(pages: DataFrame, html: str = "html") -> DataFrame:
    """``pages`` with the head fields, questions, long paragraphs and links in place of the html."""
    return pages.withColumn("_x", _extras(html)).select(*[c for c in pages.columns if c != html], "_x.*", coordinates(html).alias("point"))


def coordinates(html) -> Column:
    """(latitude, longitude) by the first pattern that matches, placeholders removed."""
    x = F.col(html) if isinstance(html, str) else html
    get = lambda g: F.coalesce(*[F.nullif(F.regexp_extract(x, p, g), F.lit("")).try_cast("double") for p in COORDINATES])
    return T.sanitize_coords(get(1), get(2))


def overview(paragraphs: Column, project: Column) -> Column:
    """The longest paragraph, of those that name the project if any does."""
    named = F.filter(paragraphs, lambda p: F.lower(p).contains(F.lower(project)))
    pick = F.when(F.size(named) > 0, named).otherwise(paragraphs)
    ranked = F.array_sort(F.transform(pick, lambda p, i: F.struct((-F.length(p)).alias("n"), i.alias("i"), p.alias("p"))))
    return F.try_element_at(ranked, F.lit(1))["p"]


def raw_title(html: str) -> Column:
    """What stands between the title's tags, as it is."""
    return F.regexp_extract(html, r"(?s)<title>(.*?)</title>", 1)


def hrefs(html: str) -> Column:
    return F.regexp_extract_all(html, F.lit(r'(?s)<a [^>]*href="([^"]*)"'), F.lit(1))


def links(pages: DataFrame, pattern: str, most: int, page: str = "page_id", html: str = "html") -> DataFrame:
    """(page, pos, url): addresses that match ``pattern``, in order, once each, at most ``most`` a page."""
    found = F.transform(F.regexp_extract_all(html, F.lit(pattern), F.lit(0)), lambda u: F.regexp_replace(u, r"[?#].*$", ""))
    return pages.select(page, F.posexplode(F.slice(F.array_distinct(found), 1, most)).alias("pos", "url"))


def project_links(pages: DataFrame, host: str, url: str = "url", page: str = "html") -> DataFrame:
    """(url, project): canonical project addresses of listing pages, from pushed data if it names any, else from anchors."""
    from ledgerloom.functions import urls as U
    from ledgerloom.sources.portals import pushed_strings

    @F.pandas_udf(S.ArrayType(S.StringType()))
    def pushed(p: pd.Series) -> pd.Series:
        return p.map(lambda x: [m for s in pushed_strings(x or "") for m in re.findall(r'"projectUrl"\s*:\s*"([^"]+)"', s)])

    found = pages.select(url, pushed(page).alias("_pushed"), hrefs(page).alias("_anchors"))
    canonical = lambda c: F.array_distinct(F.array_compact(F.transform(c, lambda h: U.project_url(h, host))))
    both = found.select(url, canonical(F.col("_pushed")).alias("_p"), canonical(F.col("_anchors")).alias("_a"))
    return both.select(url, F.explode(F.sort_array(F.when(F.size("_p") > 0, F.col("_p")).otherwise(F.col("_a")))).alias("project"))


def pagination_links(pages: DataFrame, host: str, url: str = "url", page: str = "html") -> DataFrame:
    """(url, next): further listing pages of a page's own category, from anchors and from quoted addresses."""
    from ledgerloom.functions import urls as U

    quoted = F.regexp_extract_all(page, F.lit(r"[\"']((?:https?://[^/\"'\s<>]+)?/projects/[a-z]+/?\?[^\"'\s<>]*page=\d+)"), F.lit(1))
    every = pages.select(url, F.explode(F.array_distinct(F.concat(hrefs(page), quoted))).alias("_h"))
    absolute = F.when(F.col("_h").rlike("^https?://"), F.col("_h")).when(F.col("_h").startswith("/"), F.concat(F.lit(f"https://www.{host}"), F.col("_h")))
    own, theirs = U.listing_category(url), U.listing_category("next")
    kept = every.select(url, F.regexp_replace(absolute, "#.*$", "").alias("next")).where(U.host_contains("next", host) & theirs.isNotNull())
    return kept.where(own.isNull() | (own == theirs)).distinct()
