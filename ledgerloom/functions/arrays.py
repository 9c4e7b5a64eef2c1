"""Ordered sets and image arrays as higher-order functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerloom.functions import text as T

IMAGE = "struct<url: string, type: string, is_primary: boolean, order: int>"


def first_by(array: Column, key) -> Column:
    """Elements whose key has not occurred before."""
    keys = F.transform(array, key)
    return F.filter(array, lambda x, i: F.array_position(keys, key(x)) == i + 1)


def distinct_ignoring_case(array: Column) -> Column:
    return first_by(array, F.lower)


def clean_amenities(array: Column) -> Column:
    """Clean names, first spelling of each; NULL gives an empty array."""
    kept = F.filter(F.transform(array, T.clean_amenity), F.isnotnull)
    return F.coalesce(distinct_ignoring_case(kept), F.array().cast("array<string>"))


def in_order(rank: Column, array: Column) -> Column:
    """Aggregate: many arrays one after the other, in the order of ``rank``; empty ones are left out."""
    full = F.when(F.size(array) > 0, F.struct(rank.alias("r"), array.alias("a")))
    return F.flatten(F.transform(F.array_sort(F.collect_list(full), lambda p, q: F.when(p["r"] < q["r"], -1).when(p["r"] > q["r"], 1).otherwise(0)), lambda x: x["a"]))


def by_rank(rank: Column, **fields: Column) -> Column:
    """Aggregate: structs of ``fields`` in the order of ``rank`` (r)."""
    rows = F.collect_list(F.struct(rank.alias("r"), *[c.alias(n) for n, c in fields.items()]))
    return F.array_sort(rows, lambda p, q: F.when(p["r"] < q["r"], -1).when(p["r"] > q["r"], 1).otherwise(0))


def images_folded(rank: Column, array: Column, urls: Column) -> Column:
    """Aggregate: images in the order of ``rank``, with the bare ones that older rows have: of the first two rows after the images of both."""
    first = F.min_by(urls, rank)
    return F.flatten(F.transform(by_rank(rank, a=array, u=urls), lambda x, i: F.when(i == 0, x["a"]).when(i == 1, F.concat(x["a"], first, x["u"])).otherwise(F.concat(x["a"], x["u"]))))


def sources_folded(rank: Column, array: Column, url: Column, site: Column) -> Column:
    """Aggregate: sources in the order of ``rank``. A merge adds the single address and site that the merged row has by then, and the next row's."""
    known = lambda x: F.when(F.coalesce(F.trim(x), F.lit("")) != "", rank)
    first = [(F.min_by(x, known(x)), F.min(known(x))) for x in (site, url)]
    pair = lambda s, u: F.array(F.struct(s.alias("site"), u.alias("url")))
    so_far = lambda x: pair(*[F.when(at < x["r"], value) for value, at in first])
    return F.flatten(F.transform(by_rank(rank, a=array, s=site, u=url), lambda x, i: F.when(i == 0, x["a"]).otherwise(F.concat(x["a"], so_far(x), pair(x["s"], x["u"])))))


def union_in_order(rank: Column, array: Column) -> Column:
    """Aggregate: the union of many arrays, in the order of ``rank``."""
    return F.array_distinct(in_order(rank, array))


def running_names(ladders: Column) -> Column:
    """A name for each ladder of candidates, in order: the first candidate that no ladder before took, else the last with the least number from 2 on that is free."""

    def pick(taken, ladder):
        free = lambda c: ~F.array_contains(taken, c)
        numbered = F.transform(F.sequence(F.lit(2), F.size(taken) + 2), lambda n: F.concat(F.element_at(ladder, -1), F.lit("-"), n.cast("string")))
        return F.coalesce(F.try_element_at(F.filter(ladder, free), F.lit(1)), F.try_element_at(F.filter(numbered, free), F.lit(1)))

    return F.aggregate(ladders, F.array().cast("array<string>"), lambda taken, ladder: F.concat(taken, F.array(pick(taken, ladder))))


def images(array: Column) -> Column:
    """Images renumbered: one for each url, order by place, the first is primary and never a mere gallery image."""
    named = F.filter(F.transform(array, lambda x: F.struct(F.trim(x["url"]).alias("url"), x["type"].alias("type"))), lambda x: x["url"] != "")
    one_each = first_by(named, lambda x: x["url"])
    out = F.transform(one_each, lambda x, i: F.struct(
        x["url"].alias("url"),
        F.when((i == 0) & (F.coalesce(F.trim(x["type"]), F.lit("GALLERY")).isin("GALLERY", "")), F.lit("EXTERIOR")).otherwise(F.coalesce(F.nullif(F.trim(x["type"]), F.lit("")), F.lit("GALLERY"))).alias("type"),
        (i == 0).alias("is_primary"),
        i.cast("int").alias("order"),
    ))
    return F.coalesce(out, F.array().cast(f"array<{IMAGE}>"))


def images_of_urls(array: Column) -> Column:
    return images(F.transform(array, lambda u: F.struct(u.alias("url"), F.lit(None).cast("string").alias("type"))))


def merge_sources(array: Column) -> Column:
    """{site, url} pairs, one each; no url, no pair; a missing site is 'unknown'."""
    full = F.filter(array, lambda x: F.coalesce(F.trim(x["url"]), F.lit("")) != "")
    return F.array_distinct(F.transform(full, lambda x: F.struct(F.coalesce(F.nullif(F.trim(x["site"]), F.lit("")), F.lit("unknown")).alias("site"), F.trim(x["url"]).alias("url"))))


def is_empty(x: Column, kind: str) -> Column:
    """None, blank text and empty arrays are empty; 0 and false are not."""
    if kind.startswith("array") or kind.startswith("map"):
        return x.isNull() | (F.size(x) <= 0)
    if kind == "string":
        return x.isNull() | (F.trim(x) == "")
    return x.isNull()
