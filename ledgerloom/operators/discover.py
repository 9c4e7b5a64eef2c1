"""Discovery: known addresses, caps for each source, seeds, and the frontier of listing pages."""

from __future__ import annotations

from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerloom.functions import urls as U
from ledgerloom.plans.lineage import drop, keep


def known_urls(archive: DataFrame) -> DataFrame:
    """url_key of every address that the archive has, from sourceUrl and sources."""
    own = archive.select(U.url_key("sourceUrl").alias("url_key"))
    listed = archive.select(F.explode("sources.url").alias("u")).select(U.url_key("u").alias("url_key")) if "sources" in archive.columns else own.limit(0)
    return own.union(listed).where("url_key is not null and url_key != ''").distinct()


def new_urls(urls: DataFrame, known: DataFrame, url: str = "url") -> DataFrame:
    """Rows of ``urls`` that are not known yet."""
    return urls.withColumn("url_key", U.url_key(url)).join(known, "url_key", "left_anti")


def seeds_of(lattice: DataFrame, category: str | None) -> DataFrame:
    """(url): the seeds of a category, in order, each once; ``all`` or nothing names all. ``lattice``: (ord, category, url), a seed may be in several categories."""
    wanted = (category or "all").strip().lower()
    if wanted != "all" and lattice.where(F.col("category") == wanted).limit(1).isEmpty():
        raise ValueError(f"unknown category: {category!r}")
    rows = lattice if wanted == "all" else lattice.where(F.col("category") == wanted)
    return rows.groupBy("url").agg(F.min("ord").alias("ord"))


def seed_forms(seeds: DataFrame, url: str = "url") -> DataFrame:
    """(url): how an address may name a seed: without and with a final slash, and both with the seed's query if it has one."""
    bare = F.regexp_replace(F.regexp_replace(F.col(url), r"[?#].*$", ""), "/+$", "")
    query = F.nullif(F.regexp_extract(url, r"[?]([^#]*)", 1), F.lit(""))
    forms = F.array(bare, F.concat(bare, F.lit("/")), F.concat(bare, F.lit("?"), query), F.concat(bare, F.lit("/?"), query))
    return seeds.select(F.explode(F.array_compact(forms)).alias("url")).distinct()


def without_seeds(urls: DataFrame, seeds: DataFrame, url: str = "url") -> DataFrame:
    """Rows whose address, without query and final slash, is not one of the listing seeds in any form."""
    bare = F.regexp_replace(F.regexp_replace(F.col(url), r"[?#].*$", ""), "/+$", "")
    forms = seed_forms(seeds).select(F.regexp_replace("url", "/+$", "").alias("_k")).distinct()
    return urls.withColumn("_k", bare).join(forms, "_k", "left_anti").drop("_k")


def both_forms(seeds: DataFrame, url: str = "url") -> DataFrame:
    bare = F.regexp_replace(F.col(url), "/+$", "")
    return seeds.select(F.explode(F.array(bare, F.concat(bare, F.lit("/")))).alias("url")).distinct()


def first_of_each(df: DataFrame, key: str, order: str = "ord") -> DataFrame:
    """Ordered distinct: the first row of each key, by an aggregate, so a very common key is no hot window."""
    return df.groupBy(F.col(key).alias("_key")).agg(F.min_by(F.struct(*df.columns), order).alias("_row")).select("_row.*")


def concat_distinct(parts: list[DataFrame], key: str) -> DataFrame:
    """Several ordered lists one after the other, first occurrences only."""
    whole = None
    for i, p in enumerate(parts):
        q = p.withColumn("_place", F.struct(F.lit(i).alias("part"), F.col("ord")))
        whole = q if whole is None else whole.unionByName(q)
    return first_of_each(whole, key, "_place").drop("_place")


def cap(df: DataFrame, by: str, most: int, order: str = "ord") -> DataFrame:
    """The first ``most`` rows of each group; put it after the known addresses are gone."""
    return df.withColumn("_n", F.row_number().over(W.partitionBy(by).orderBy(order))).where(F.col("_n") <= most).drop("_n")


def discover(urls: DataFrame, archive: DataFrame, by: str = "site", most: int | None = None) -> DataFrame:
    """New addresses in order, then the cap, so that a cap never spends itself on known ones."""
    fresh = new_urls(urls, known_urls(archive))
    return fresh if most is None else cap(fresh, by, most)


def refresh(urls: DataFrame, archive: DataFrame, by: str = "site", most: int = 50) -> DataFrame:
    """Known addresses to be read again, in order, ``most`` of each source: what they tell can fill gaps only."""
    known = urls.withColumn("url_key", U.url_key("url")).join(known_urls(archive), "url_key", "left_semi")
    return cap(known, by, most)


def frontier(links: DataFrame, seeds: DataFrame, most_depth: int = 30) -> DataFrame:
    """(node, depth) of all nodes that the links (src, dst) reach from the seeds (node), breadth first. A level is written once and never again."""
    edge = keep(seeds.select("node").distinct().withColumn("depth", F.lit(0)))
    levels = [edge]
    for depth in range(1, most_depth + 1):
        step = edge.join(links, edge["node"] == links["src"]).select(F.col("dst").alias("node")).distinct()
        edge = keep(step.join(reduce(DataFrame.unionAll, levels), "node", "left_anti").withColumn("depth", F.lit(depth)))
        if edge.isEmpty():
            drop(edge)
            break
        levels.append(edge)
    return reduce(DataFrame.unionAll, levels)


def crawl(links: DataFrame, finds: DataFrame, seeds: DataFrame, most_pages: int = 30, most: int | None = None) -> DataFrame:
    """(item, seed, visit, rank): what the listing pages reached from each seed name, in the order in which a crawler finds it, each item once.

    ``links``: (page, next); ``finds``: (page, item); ``seeds``: (seed, page), seeds in order. From each seed pages are visited first in, first out, the
    next pages of a page in their order, none twice, ``most_pages`` at most; a page's items come in their order. A seed's
    search ends once ``most`` different items are found, those of earlier seeds included. All seeds are searched at once, level by level; since no more than
    the budget can be visited, at most so many pages of a seed are kept waiting. A page that is not there names nothing and counts as visited.
    """
    order = W.partitionBy("seed").orderBy("parent", "page")
    edge = keep(seeds.groupBy("seed").agg(F.min("page").alias("page")).select("seed", "page", F.lit(1).cast("long").alias("visit")))
    levels = [edge]
    links = links.where("next is not null").distinct()
    while True:
        seen = reduce(DataFrame.unionAll, levels)
        step = edge.join(links, "page").groupBy("seed", F.col("next").alias("page")).agg(F.min("visit").alias("parent")).join(seen.select("seed", "page"), ["seed", "page"], "left_anti")
        before = seen.groupBy("seed").agg(F.max("visit").alias("last"))
        placed = step.withColumn("n", F.row_number().over(order)).where(F.col("n") < most_pages).join(before, "seed")
        edge = keep(placed.select("seed", "page", (F.col("last") + F.col("n")).cast("long").alias("visit")).where(F.col("visit") <= most_pages))
        if edge.isEmpty():
            drop(edge)
            break
        levels.append(edge)
    visits = reduce(DataFrame.unionAll, levels)
    own = visits.join(finds.where("item is not null").distinct(), "page").groupBy("seed", "item").agg(F.min("visit").alias("visit"))
    if most is not None:
        own = own.withColumn("n", F.row_number().over(W.partitionBy("seed").orderBy("visit", "item"))).where(F.col("n") <= most).drop("n")
        kind = finds.schema["item"].dataType.simpleString()
        # seed after seed: what is left for one depends on those before; rows come sorted, and only the ``most`` items found are remembered
        return own.repartition(1).sortWithinPartitions("seed", "visit", "item").mapInPandas(lambda frames: _within(frames, most), f"item {kind}, seed long, visit long, rank long")
    first = own.groupBy("item").agg(F.min(F.struct("seed", "visit")).alias("at")).select("item", "at.*")
    # the rank is the place within a seed after the items of the seeds before
    sizes = first.groupBy("seed").agg(F.count(F.lit(1)).alias("n"))
    shift = F.coalesce(F.sum("n").over(W.orderBy("seed").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    place = F.row_number().over(W.partitionBy("seed").orderBy("visit", "item"))
    return first.withColumn("n", place).join(sizes.select("seed", shift.alias("shift")), "seed").select("item", F.col("seed").cast("long").alias("seed"), "visit", (F.col("n") + F.col("shift")).cast("long").alias("rank"))


def _within(frames, most: int):
    """The items that a crawler finds before it has ``most``: a seed may take as many as are missing when it begins, known ones included."""
    found: dict = {}
    seed, left = None, 0
    for frame in frames:
        out = []
        for r in frame.to_dict("records"):
            if r["seed"] != seed:
                seed, left = r["seed"], most - len(found)
            if left <= 0:
                continue
            left -= 1
            if r["item"] not in found:
                found[r["item"]] = len(found) + 1
                out.append((r["item"], r["seed"], r["visit"], found[r["item"]]))
        yield pd.DataFrame(out, columns=["item", "seed", "visit", "rank"])
