"""Keys of unit rows, their richness, and the soft match of project names."""

from __future__ import annotations

from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from ledgerloom.functions import arrays as A
from ledgerloom.functions import lookups as L
from ledgerloom.functions.text import slugify

#: Columns that say nothing about how rich a row is.
UNCOUNTED = ("sources", "sourceUrl", "sourceSite", "scrapedAt", "slug", "title", "listingType", "status", "seoTitle", "seoDescription", "seoKeywords", "h1", "ord")
AREA = "superBuiltUpArea"


def _slug(name: str) -> Column:
    return slugify(F.coalesce(F.col(name), F.lit("")))


def _bhk() -> Column:
    """A missing count is a value of its own, so two of them match."""
    return F.coalesce(F.col("bhk").cast("long").cast("string"), F.lit("None"))


def _area() -> Column:
    return F.coalesce(F.col(AREA).cast("long").cast("string"), F.lit(""))


def match_key(loose: bool = False) -> Column:
    """project|city|locality|bhk[|area]; '' without a project."""
    parts = [_slug("projectName"), _slug("city"), _slug("locality"), _bhk(), *([] if loose else [_area()])]
    return F.when(_slug("projectName") == "", F.lit("")).otherwise(F.concat_ws("|", *parts))


def unit_signature(loose: bool = False) -> Column:
    return F.concat_ws("|", _slug("city"), _slug("locality"), _bhk(), *([] if loose else [_area()]))


def legacy_identity(columns: list[str]) -> Column:
    """url|bhk|area, else the slug, else the whole row."""
    url = F.regexp_replace(F.lower(F.trim(F.coalesce(F.col("sourceUrl"), F.lit("")))), "/+$", "") if "sourceUrl" in columns else F.lit("")
    slug = F.lower(F.trim(F.coalesce(F.col("slug"), F.lit("")))) if "slug" in columns else F.lit("")
    area = F.coalesce(F.col(AREA).cast("long").cast("string"), F.lit("None"))
    return F.when(url != "", F.concat(F.lit("url:"), F.concat_ws("|", url, _bhk(), area))).when(slug != "", F.concat(F.lit("slug:"), slug)).otherwise(F.to_json(F.struct(*[c for c in sorted(columns) if c != "ord"])))


def fullness(df: DataFrame, skip=UNCOUNTED) -> Column:
    """A text counts 1 and 1 for each 50 of its first 200 characters, an array its length up to 8, other values 1."""
    total = F.lit(0)
    for name, kind in df.dtypes:
        if name in skip or name.startswith("_"):
            continue
        x = F.col(name)
        if kind.startswith("array"):
            worth = F.least(F.size(x), F.lit(8))
        elif kind == "string":
            worth = 1 + F.floor(F.least(F.length(x), F.lit(200)) / 50)
        else:
            worth = F.lit(1)
        total = total + F.when(A.is_empty(x, kind), F.lit(0)).otherwise(worth)
    return total.cast("long")


def infer_site(sites: dict[str, str], columns: list[str]) -> Column:
    """sourceSite, else the first of sources, else the first host of ``sites`` (site to host) in the url."""
    own = F.lower(F.nullif(F.trim(F.col("sourceSite")), F.lit(""))) if "sourceSite" in columns else F.lit(None).cast("string")
    listed = F.lower(F.try_element_at(F.filter(F.col("sources.site"), lambda s: F.trim(s) != ""), F.lit(1))) if "sources" in columns else F.lit(None).cast("string")
    url = F.lower(F.coalesce(F.col("sourceUrl"), F.lit("")))
    return F.coalesce(own, listed, *[F.when(url.contains(host), F.lit(site)) for site, host in sites.items()])


def guard_key(slug: Column) -> Column:
    """First token, tokens with digits, marker tokens: equal for slugs that match softly."""
    tokens = F.split(slug, "-")
    kept = lambda keep: F.concat_ws(",", F.filter(tokens, keep))
    return F.concat_ws("|", tokens[0], kept(lambda t: t.rlike("[0-9]")), kept(lambda t: t.isin(*L.PROJECT_MARKERS)))


def soft_guard(a: Column, b: Column) -> Column:
    """What two different slugs must share before their letters are compared."""
    token = lambda s: F.split(s, "-")
    digits = lambda s: F.filter(token(s), lambda t: t.rlike("[0-9]"))
    marks = lambda s: F.filter(token(s), lambda t: t.isin(*L.PROJECT_MARKERS))
    return (F.least(F.length(a), F.length(b)) >= 8) & (token(a)[0] == token(b)[0]) & (digits(a) == digits(b)) & (marks(a) == marks(b)) & (F.abs(F.length(a) - F.length(b)) <= 3)


def ratio(a: str, b: str) -> float:
    return SequenceMatcher(None, a, b).ratio()


@F.pandas_udf(DoubleType())
def slug_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([ratio(x, y) for x, y in zip(a, b, strict=True)])


def guard_of(slug: str) -> tuple:
    """As ``guard_key``, for folds."""
    tokens = slug.split("-")
    return tokens[0], tuple(w for w in tokens if any(c.isdigit() for c in w)), tuple(w for w in tokens if w in L.PROJECT_MARKERS)


def soft_match(a: str, b: str) -> bool:
    """The same decision for two slugs in Python, for folds."""
    if not a or not b:
        return False
    if a == b:
        return True
    if min(len(a), len(b)) < 8 or abs(len(a) - len(b)) > 3:
        return False
    return guard_of(a) == guard_of(b) and ratio(a, b) >= 0.92


def soft_pairs(pairs: DataFrame, a: str, b: str) -> DataFrame:
    """Rows of ``pairs`` whose slugs ``a`` and ``b`` match softly; letters are compared only behind the guard."""
    x, y = F.col(a), F.col(b)
    same = pairs.where((x == y) & (x != ""))
    near = pairs.where((x != y) & (x != "") & (y != "") & soft_guard(x, y)).where(slug_ratio(x, y) >= 0.92)
    return same.unionByName(near)
