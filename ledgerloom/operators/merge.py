"""Null-fill merge of the rows of a group, tiered matching, and upsert."""

from __future__ import annotations

from bisect import insort

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions import arrays as A
from ledgerloom.operators import identity as I
from ledgerloom.operators import similar as S
from ledgerloom.operators.blocks import components, labels
from ledgerloom.plans.lineage import keep

#: Columns of an archive row that a merge treats apart.
LAST = ("scrapedAt",)


def _merged(name: str, kind: str, rank: Column, columns: list[str]) -> Column:
    x = F.col(name)
    full = ~A.is_empty(x, kind)
    if name in LAST:
        return F.max_by(x, F.when(full, rank))
    if name == "imageUrls":
        return F.lit(None).cast(kind)
    if name == "images":
        pictures = lambda y: F.coalesce(y, F.array().cast("array<struct<url: string, type: string>>"))
        own = pictures(F.transform(x, lambda v: F.struct(v["url"].alias("url"), v["type"].alias("type"))))
        old = F.transform("imageUrls", lambda u: F.struct(u.alias("url"), F.lit(None).cast("string").alias("type"))) if "imageUrls" in columns else F.lit(None)
        return A.images(A.images_folded(rank, own, pictures(old)))
    if name == "sources":
        own = F.coalesce(F.transform(x, lambda v: F.struct(v["site"].alias("site"), v["url"].alias("url"))), F.array().cast("array<struct<site: string, url: string>>"))
        single = lambda c: F.col(c) if c in columns else F.lit(None).cast("string")
        return A.merge_sources(A.sources_folded(rank, own, single("sourceUrl"), single("sourceSite")))
    if kind.startswith("array"):
        return A.union_in_order(rank, x)
    return F.coalesce(F.min_by(x, F.when(full, rank)), F.min_by(x, rank))


def null_fill(df: DataFrame, by: list[str], rank: str) -> DataFrame:
    """One row for each group: of every column the first value that is not empty, in the order of ``rank`` (any type with an order), else the first row's.

    Arrays are united in that order; scrapedAt is the last value; older forms of sources and images are folded in. A group of one row stays as it
    is. The columns ``by`` and ``rank`` are not in the result but for ``by``; ``ord`` is the first row's.
    """
    r, alone = F.col(rank), F.count(F.lit(1)) == 1
    own = [(n, k) for n, k in df.dtypes if n not in (*by, rank, "ord")]
    # a merged array has the fields of the column, whatever their order
    fields = {n: df.schema[n].dataType.elementType.fieldNames() for n in ("images", "sources") if n in df.columns}
    shaped = lambda n, x: F.transform(x, lambda v: F.struct(*[v[f].alias(f) for f in fields[n]])) if n in fields else x
    merged = [F.when(alone, F.any_value(n)).otherwise(shaped(n, _merged(n, k, r, df.columns))).alias(n) for n, k in own]
    return df.groupBy(*by).agg(F.min_by("ord", r).alias("ord"), F.count(F.lit(1)).alias("_rows"), *merged)


def changed(before: DataFrame, after: DataFrame, key: str = "ord") -> DataFrame:
    """Rows of ``after`` that differ from those of ``before`` in anything but scrapedAt."""
    cols = [c for c in before.columns if c not in (*LAST, key)]
    b = before.select(F.col(key).alias("_k"), F.struct(*cols).alias("_b"))
    return after.join(b, F.col(key) == F.col("_k")).where(~F.struct(*cols).eqNullSafe(F.col("_b"))).drop("_k", "_b")


def _keys(df: DataFrame, prefix: str) -> DataFrame:
    return df.select(
        F.col("ord").alias(f"{prefix}ord"), I._slug("projectName").alias(f"{prefix}slug"), (I._slug("locality") != "").alias(f"{prefix}local"), F.col(I.AREA).alias(f"{prefix}area"),
        I.match_key().alias(f"{prefix}strict"), I.match_key(loose=True).alias(f"{prefix}loose"), I.unit_signature().alias(f"{prefix}sig"), I.unit_signature(loose=True).alias(f"{prefix}loose_sig"),
        I.legacy_identity(df.columns).alias(f"{prefix}legacy"), I.fullness(df).alias(f"{prefix}full"),
    )


def match_tiers(archive: DataFrame, incoming: DataFrame, tiers: tuple[int, ...] = (1, 2, 3, 4, 5)) -> DataFrame:
    """For every incoming row: ord, tier (1 strict to 5 legacy) and target, or no row if nothing matches; only ``tiers`` are looked at.

    The first tier that decides wins; a loose tier decides only if it has exactly one candidate. Incoming rows
    do not see each other (``upsert`` folds those that must).
    """
    a, b = _keys(archive, "a_"), _keys(incoming, "b_")
    c = F.col
    # the archive is summed up by each kind of key first, so a key that very many rows share is one row of a join
    densest = F.max(F.struct("a_full", (-c("a_ord")).alias("o"))).alias("m")
    tier = lambda df, n, target: df.select("b_ord", F.lit(n).alias("tier"), target.alias("a_ord"))
    by_key = a.where("a_strict != ''").groupBy("a_strict").agg(densest)
    same_row = a.where("a_strict != ''").groupBy(c("a_strict").alias("s2"), "a_legacy").agg(F.min("a_ord").alias("own"))
    strict = b.join(by_key, c("b_strict") == c("a_strict")).join(same_row, (c("b_strict") == c("s2")) & (c("b_legacy") == c("a_legacy")), "left")
    bare = F.when(c("a_area").isNull(), c("a_ord"))
    by_loose = a.where("a_loose != ''").groupBy("a_loose").agg(F.count("a_ord").alias("all_n"), F.min("a_ord").alias("all_ord"), F.count(bare).alias("bare_n"), F.min(bare).alias("bare_ord"))
    loose = b.join(by_loose, c("b_loose") == c("a_loose"))
    loose = loose.where(F.when(c("b_area").isNull(), c("all_n") == 1).otherwise(c("bare_n") == 1))
    local_a, local_b = a.where("a_local"), b.where("b_local")
    # candidates for soft matches come from an equi-join of segments, never from all names of a block
    slugs = lambda df, p, sig: df.select(c(f"{p}_{sig}").alias("k"), c(f"{p}_slug").alias("slug")).distinct()
    pairs = lambda sig: S.soft_join(slugs(local_a, "a", sig), slugs(local_b, "b", sig))
    near = pairs("sig")
    soft = local_a.groupBy(c("a_sig").alias("k"), "a_slug").agg(densest).join(near, ["k", "a_slug"]).groupBy("k", "b_slug").agg(F.max("m").alias("m"))
    soft = local_b.withColumn("k", c("b_sig")).join(soft, ["k", "b_slug"])
    near = pairs("loose_sig")
    sized = F.when(c("a_area").isNotNull(), c("a_ord"))
    other = local_a.groupBy(c("a_loose_sig").alias("k"), "a_slug").agg(F.count(sized).alias("sized_n"), F.min(sized).alias("sized_ord"), F.count(bare).alias("bare_n"), F.min(bare).alias("bare_ord"))
    other = other.join(near, ["k", "a_slug"]).groupBy("k", "b_slug").agg(F.sum("sized_n").alias("sized_n"), F.min("sized_ord").alias("sized_ord"), F.sum("bare_n").alias("bare_n"), F.min("bare_ord").alias("bare_ord"))
    soft_loose = local_b.withColumn("k", c("b_loose_sig")).join(other, ["k", "b_slug"]).where(F.when(c("b_area").isNull(), c("sized_n") == 1).otherwise(c("bare_n") == 1))
    legacy = b.join(a.groupBy("a_legacy").agg(F.min("a_ord").alias("first")), c("b_legacy") == c("a_legacy"))
    found = {
        1: (strict, F.coalesce("own", -c("m.o"))), 2: (loose, F.when(c("b_area").isNull(), c("all_ord")).otherwise(c("bare_ord"))), 3: (soft, -c("m.o")),
        4: (soft_loose, F.when(c("b_area").isNull(), c("sized_ord")).otherwise(c("bare_ord"))), 5: (legacy, c("first")),
    }
    hits = [tier(found[n][0], n, found[n][1]) for n in sorted(tiers)]
    every = hits[0]
    for more in hits[1:]:
        every = every.unionByName(more)
    return every.groupBy(F.col("b_ord").alias("ord")).agg(F.min(F.struct("tier", "a_ord")).alias("m")).select("ord", "m.tier", F.col("m.a_ord").alias("target"))


class Fold:
    """Compact rows that may meet, folded in order; what the key columns and the richness become is kept.

    ``held`` has the keys by which a row could be found after it absorbed others, but for those that its own rows brought along.
    """

    FIELDS = ("slug", "city", "locality", "bhk", "area", "legacy_url", "legacy_slug")

    def __init__(self):
        self.rows: list[dict] = []
        self.known: list[dict] = []
        self.entries: list[set] = []
        self.index: dict[tuple[str, str], list[int]] = {}
        self.held: dict[int, set] = {}

    def add(self, r: dict) -> int:
        self.rows.append(r)
        self.known.append({})
        self.entries.append(set())
        self._note(len(self.rows) - 1)
        return len(self.rows) - 1

    def _note(self, i: int) -> None:
        """Keep the places of row ``i``'s keys, each list in the order of the rows."""
        r = self.rows[i]
        now = self.keys(r)
        if now == self.known[i]:
            return
        entries = {x for x in now.items() if x[1]}
        if r["slug"] and r["locality"]:
            at = f"{now['loose_sig']}#{link_guard(r['slug'])}#"
            entries |= {("soft", at + x) for x in S.posts(r["slug"])} | {("soft", at + "=" + r["slug"])}
        for x in self.entries[i] - entries:
            self.index[x].remove(i)
        for x in entries - self.entries[i]:
            insort(self.index.setdefault(x, []), i)
        self.known[i], self.entries[i] = now, entries

    def at(self, kind: str, value: str) -> list[int]:
        return self.index.get((kind, value), [])

    @staticmethod
    def keys(r: dict) -> dict:
        bhk, area = ("None" if r["bhk"] is None else str(r["bhk"])), ("" if r["area"] is None else str(r["area"]))
        sig = f"{r['city']}|{r['locality']}|{bhk}"
        legacy = f"url:{r['legacy_url']}|{bhk}|{area or 'None'}" if r["legacy_url"] else f"slug:{r['legacy_slug']}" if r["legacy_slug"] else f"row:{r['hash']}"
        return {"strict": f"{r['slug']}|{sig}|{area}" if r["slug"] else "", "loose": f"{r['slug']}|{sig}" if r["slug"] else "", "sig": f"{sig}|{area}", "loose_sig": sig, "legacy": legacy}

    @staticmethod
    def full(r: dict) -> int:
        return sum(r["scalars"].values()) + sum(min(len(v), 8) for v in r["lists"].values())

    def near(self, r: dict, k: dict) -> list[int]:
        """Rows of the same city, locality and count whose names match softly, in order."""
        at = f"{k['loose_sig']}#{link_guard(r['slug'])}#"
        found = set(self.at("soft", at + "=" + r["slug"])).union(*[self.at("soft", at + x) for x in S.probes(r["slug"])])
        return sorted(i for i in found if I.soft_match(r["slug"], self.rows[i]["slug"]))

    def find(self, r: dict) -> int | None:
        k = self.keys(r)
        densest = lambda hits: max(hits, key=lambda i: self.full(self.rows[i]))
        if k["strict"]:
            hits = self.at("strict", k["strict"])
            if hits:
                return next((i for i in hits if len(hits) > 1 and self.known[i]["legacy"] == k["legacy"]), densest(hits))
            loose = [i for i in self.at("loose", k["loose"]) if r["area"] is None or self.rows[i]["area"] is None]
            if len(loose) == 1:
                return loose[0]
        if r["slug"] and r["locality"]:
            near = self.near(r, k)
            soft = [i for i in near if self.known[i]["sig"] == k["sig"]]
            if soft:
                return densest(soft)
            other = [i for i in near if (self.rows[i]["area"] is None) != (r["area"] is None)]
            if len(other) == 1:
                return other[0]
        return next(iter(self.at("legacy", k["legacy"])), None)

    def absorb(self, i: int, r: dict) -> None:
        x = self.rows[i]
        for f in self.FIELDS:
            if x[f] in (None, ""):
                x[f] = r[f]
        x["scalars"] = r["scalars"] | x["scalars"]
        both = {name: x["lists"].get(name, []) + r["lists"].get(name, []) for name in x["lists"] | r["lists"]}
        if "imageUrls" in both:  # the older form of images goes into them
            both["images"] = both.get("images", []) + both.pop("imageUrls")
        # a merge unites equal elements; until then they count one by one
        x["lists"] = {name: list(dict.fromkeys(v for v in items if v)) for name, items in both.items()}
        self._note(i)
        self.held.setdefault(i, set()).update(links_of(x))


def link_guard(slug: str) -> str:
    """As ``identity.guard_key``, for folds."""
    first, digits, marks = I.guard_of(slug)
    return "|".join((first, ",".join(digits), ",".join(marks)))


def links_of(r: dict) -> list[str]:
    """As ``block_links``, for folds: no row is found but by one of these."""
    k = Fold.keys(r)
    return [k["legacy"], *([f"b:{k['loose_sig']}|{link_guard(r['slug'])}"] if r["slug"] else [])]


def compact(df: DataFrame) -> DataFrame:
    """Key columns, and for each column what it adds to the richness."""
    scalars, lists = [], []
    for name, kind in df.dtypes:
        if name in I.UNCOUNTED or name.startswith("_"):
            continue
        x = F.col(name)
        full = ~A.is_empty(x, kind)
        if kind.startswith("array"):
            address = {"images": lambda v: F.nullif(F.trim(v["url"]), F.lit("")), "imageUrls": lambda v: F.nullif(F.trim(v), F.lit(""))}.get(name)
            value = (lambda v, address=address: F.when(address(v).isNotNull(), F.xxhash64(address(v))).otherwise(0)) if address else (lambda v: F.xxhash64(v))
            lists += [F.lit(name), F.when(full, F.transform(x, value))]
        else:
            worth = 1 + F.floor(F.least(F.length(x), F.lit(200)) / 50) if kind == "string" else F.lit(1)
            scalars += [F.lit(name), F.when(full, worth.cast("long"))]
    blank = lambda c: F.coalesce(F.lower(F.trim(F.col(c))), F.lit("")) if c in df.columns else F.lit("")
    return df.select(
        "ord", I._slug("projectName").alias("slug"), I._slug("city").alias("city"), I._slug("locality").alias("locality"), F.col("bhk").cast("long").alias("bhk"), F.col(I.AREA).cast("long").alias("area"),
        F.regexp_replace(blank("sourceUrl"), "/+$", "").alias("legacy_url"), blank("slug").alias("legacy_slug"), F.xxhash64(*[c for c in df.columns if c != "ord"]).alias("hash"),
        F.map_filter(F.create_map(*scalars), lambda k, v: v.isNotNull()).alias("scalars"), F.map_filter(F.create_map(*lists) if lists else F.create_map().cast("map<string,array<bigint>>"), lambda k, v: v.isNotNull()).alias("lists"),
    )


def _plain(record: dict) -> dict:
    """A compact row as pandas gives it, with plain values."""
    number = lambda v: None if v is None or v != v else int(v)
    return {**record, "bhk": number(record["bhk"]), "area": number(record["area"]), "scalars": dict(record["scalars"]), "lists": {k: list(v) for k, v in dict(record["lists"]).items()}}


PLAN = "ord long, side int, target long, target_side int, seq long, keys array<string>"


def _plan(rows: list[dict], looks) -> pd.DataFrame:
    """Fold ``rows`` in order; those that ``looks`` names look for a row to go into. Keys that none of them had are told with the row that has them now."""
    fold, out, place = Fold(), [], {}
    for r in rows:
        i = fold.find(r) if looks(r) else None
        if i is None:
            i = fold.add(dict(r))
            place[i] = len(out)
        else:
            fold.absorb(i, r)
        out.append([r["ord"], r["side"], fold.rows[i]["ord"], fold.rows[i]["side"], len(out), []])
    own = {x for r in rows for x in links_of(r)} if fold.held else set()
    for i, keys in fold.held.items():
        out[place[i]][-1] = sorted(keys - own)
    return pd.DataFrame(out, columns=["ord", "side", "target", "target_side", "seq", "keys"])


def assign(frame: pd.DataFrame) -> pd.DataFrame:
    """Fold the rows of a component, archive first; those of the batch look for a row to go into."""
    rows = [_plain(r) for r in frame.sort_values(["side", "ord"], kind="stable").to_dict("records")]
    return _plan(rows, lambda r: r["side"] == 1)


def block_links(small: DataFrame) -> DataFrame:
    """(side, ord, key) of compact rows: a row is found only by what it has in common with another.

    That is its legacy identity, or city, locality, count and guard of the name, which strict, loose and soft matches all share.
    """
    bhk = F.coalesce(F.col("bhk").cast("string"), F.lit("None"))
    area = F.coalesce(F.col("area").cast("string"), F.lit("None"))
    legacy = F.when(F.col("legacy_url") != "", F.concat(F.lit("url:"), F.concat_ws("|", "legacy_url", bhk, area))).when(F.col("legacy_slug") != "", F.concat(F.lit("slug:"), "legacy_slug")).otherwise(F.concat(F.lit("row:"), F.col("hash").cast("string")))
    block = F.when(F.col("slug") != "", F.concat(F.lit("b:"), F.concat_ws("|", "city", "locality", bhk, I.guard_key(F.col("slug")))))
    return small.select("side", "ord", F.explode(F.array_compact(F.array(legacy, block))).alias("key"))


def settled(small: DataFrame, fold) -> DataFrame:
    """(ord, side, target, target_side, seq): ``fold`` over the components of compact rows that may meet.

    Rows take on what they lack from rows that they absorb, and may then be found by keys that none of them had. If such a key belongs to
    another component, too, the two are united and folded again, until all components keep to themselves; then the fold is that of all rows in order.
    """
    links = keep(block_links(small))
    part = keep(components(links))
    todo, plan = part, None
    while True:
        rows = small.join(todo, ["side", "ord"])
        out = keep(rows.groupBy("component").applyInPandas(lambda f: fold(f.drop(columns="component")), PLAN))
        plan = out if plan is None else plan.unionAll(out)
        new = keep(out.select("side", "ord", F.explode("keys").alias("key")))
        if new.isEmpty():
            return plan.drop("keys")
        links = links.unionAll(new)
        owners = keep(links.join(part, ["side", "ord"]).select("key", "component").distinct())
        hubs = owners.groupBy("key").agg(F.min("component").alias("v"), F.count(F.lit(1)).alias("n")).where("n > 1")
        united = keep(labels(owners.join(hubs, "key").select(F.col("component").alias("u"), "v")))
        if united.isEmpty():
            return plan.drop("keys")
        part = keep(part.join(united, F.col("component") == F.col("node"), "left").select("side", "ord", F.coalesce("label", "component").alias("component")))
        todo = part.join(united.select(F.col("label").alias("component")).distinct(), "component", "left_semi").select("side", "ord", "component")
        plan = keep(plan.join(todo.select("side", "ord"), ["side", "ord"], "left_anti").select("ord", "side", "target", "target_side", "seq", "keys"))


def largest_group(small: DataFrame) -> int:
    """Rows of the largest component that a fold takes as one."""
    return components(block_links(small)).groupBy("component").count().agg(F.max("count")).first()[0] or 0


def touched(archive: DataFrame, incoming: DataFrame) -> DataFrame:
    """Compact rows of the batch (side 1) and of the archive rows (side 0) that share a key with one of them; no other can take part."""
    new = compact(incoming).withColumn("side", F.lit(1))
    old = compact(archive).withColumn("side", F.lit(0))
    known = block_links(old).join(block_links(new).select("key").distinct(), "key", "left_semi").select("ord").distinct()
    return old.join(known, "ord", "left_semi").unionByName(new)


def upsert(archive: DataFrame, incoming: DataFrame, only_changes: bool = False) -> DataFrame:
    """Merge a batch into the archive: all rows, with ``_status`` kept, updated or added; ``only_changes``: those that the batch met, and the new ones.

    Work starts from the batch: only archive rows that share a key with it are folded, in order, so rows see those that came before them in the
    batch. Only compact rows go through Python; the wide columns are merged by ``null_fill`` in the order of the fold. Other rows go through as they are.
    """
    small = keep(touched(archive, incoming))
    plan = keep(settled(small, assign))
    both = archive.withColumn("_side", F.lit(0)).unionByName(incoming.withColumn("_side", F.lit(1)), allowMissingColumns=True)
    both = both.withColumn("_id", F.struct("_side", "ord"))
    ranked = both.join(plan.select(F.struct(F.col("side").alias("_side"), "ord").alias("_id"), "target", "target_side", "seq"), "_id").drop("_id")
    old = F.max(F.when(F.col("_side") == 0, F.struct(*[c for c in archive.columns if c not in LAST]))).alias("_before")
    states = ranked.groupBy("target", "target_side").agg(old)
    merged = null_fill(ranked.drop("_side"), ["target", "target_side"], "seq")
    out = merged.join(states, ["target", "target_side"])
    now = F.struct(*[c for c in archive.columns if c not in LAST])
    status = F.when(F.col("target_side") == 1, F.lit("added")).when((F.col("_rows") > 1) & ~now.eqNullSafe(F.col("_before")), F.lit("updated")).otherwise(F.lit("kept"))
    out = out.withColumn("_status", status).drop("target", "target_side", "_before", "_rows")
    if only_changes:
        return out
    rest = archive.join(plan.where("side = 0").select("ord"), "ord", "left_anti").withColumn("_status", F.lit("kept"))
    return out.unionByName(rest, allowMissingColumns=True)
