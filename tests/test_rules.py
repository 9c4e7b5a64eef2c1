"""Random archives: merge, consolidation passes, tiers and upsert against a plain sequential statement of the rules."""

import random
from collections import Counter, defaultdict

import pandas as pd
import pytest

from ledgerloom.operators import dedupe, identity, merge

SHAPE = "ord long, projectName string, city string, locality string, bhk long, superBuiltUpArea long, price long, description string, amenities array<string>, sources array<struct<site: string, url: string>>, sourceUrl string, sourceSite string, slug string"
NAMES = [f.strip() for f in SHAPE.replace("array<struct<site: string, url: string>>", "sources").split(",")]
FIELDS = [f.split()[0] for f in NAMES]
KEYS = ("projectName", "city", "locality", "bhk", "superBuiltUpArea")


def rows(rng, n, first=0, mark=""):
    """Random rows; those of another ``mark`` share no city, address or slug with them."""
    urls = [None, None, "", f"http://x{mark}/a", f"http://x{mark}/A/", f"http://x{mark}/b"]
    out = []
    for i in range(n):
        url = rng.choice(urls)
        out.append(dict(zip(FIELDS, (
            first + i, rng.choice(["gaurs atulayam", "gaurs atulayam", "gaurs atulyam", "gaurs atulayamm", "lodha park", "gaur city 2", "gaur city 3", None]), f"noida{mark}" if mark or rng.random() < 0.9 else None, rng.choice(["s16", "s16", "s17", None]), rng.choice([2, 3, 3, None]), rng.choice([900, 1500, None, None]),
            rng.choice([None, 0, 5, 7]), rng.choice([None, "", "x" * rng.randint(1, 260)]), rng.choice([None, [], ["Pool", "Pool"], ["Gym"], ["Gym", "Lift"]]), rng.choice([None, [("p", "http://s/1")], [("p", "http://s/1"), ("q", "http://s/2")]]), url, rng.choice([None, "site"]), f"u{mark}-{first + i if rng.random() < 0.7 else rng.randrange(4)}",
        ), strict=True)))
    return out


def empty(v):
    return v is None or v == [] or isinstance(v, str) and not v.strip()


def full(r):
    worth = lambda v: 0 if empty(v) else 1 + min(len(v), 200) // 50 if isinstance(v, str) else min(len(v), 8) if isinstance(v, list) else 1
    return sum(worth(r[f]) for f in FIELDS if f not in identity.UNCOUNTED)


def merged(a, b):
    out = {f: b[f] if empty(a[f]) and not empty(b[f]) else a[f] for f in FIELDS}
    out["amenities"] = list(dict.fromkeys((a["amenities"] or []) + (b["amenities"] or [])))
    pairs = (a["sources"] or []) + (b["sources"] or []) + [(r["sourceSite"] or "unknown", r["sourceUrl"]) for r in (a, b) if r["sourceUrl"]]
    out["sources"] = list(dict.fromkeys(pairs))
    return out | {"ord": a["ord"]}


def slug(v):
    return (v or "").replace(" ", "-")


def key(r, loose=False):
    parts = (slug(r["projectName"]), r["city"], slug(r["locality"]), r["bhk"])
    return None if not r["projectName"] else parts if loose else (*parts, r["superBuiltUpArea"])


def unit(r):
    return r["city"], slug(r["locality"]), r["bhk"]


def legacy(r):
    url = (r["sourceUrl"] or "").strip().lower().rstrip("/")
    return (url, r["bhk"], r["superBuiltUpArea"]) if url else r["slug"]


def tier(archive, r):
    """(tier, place) of the archive row that takes ``r``, or None."""
    places = range(len(archive))
    richest = lambda hits: max(hits, key=lambda i: full(archive[i]))
    area = lambda i: archive[i]["superBuiltUpArea"]
    if key(r):
        hits = [i for i in places if key(archive[i]) == key(r)]
        if hits:
            return 1, next((i for i in hits if len(hits) > 1 and legacy(archive[i]) == legacy(r)), richest(hits))
        hits = [i for i in places if key(archive[i], True) == key(r, True) and (r["superBuiltUpArea"] is None or area(i) is None)]
        if len(hits) == 1:
            return 2, hits[0]
    if r["projectName"] and r["locality"]:
        near = [i for i in places if archive[i]["locality"] and unit(archive[i]) == unit(r) and identity.soft_match(slug(r["projectName"]), slug(archive[i]["projectName"]))]
        hits = [i for i in near if area(i) == r["superBuiltUpArea"]]
        if hits:
            return 3, richest(hits)
        hits = [i for i in near if (area(i) is None) != (r["superBuiltUpArea"] is None)]
        if len(hits) == 1:
            return 4, hits[0]
    return next(((5, i) for i in places if legacy(archive[i]) == legacy(r)), None)


def frame(spark, data):
    return spark.createDataFrame([tuple(r[f] for f in FIELDS) for r in data], SHAPE)


def plain(df):
    return Counter(repr([[tuple(s) for s in r[f]] if f == "sources" and r[f] is not None else r[f] for f in FIELDS if f != "ord"]) for r in df.collect())


def expected(data):
    return Counter(repr([r[f] for f in FIELDS if f != "ord"]) for r in data)


def upserted(archive, batch):
    out = list(archive)
    for r in batch:
        t = tier(out, r)
        if t:
            out[t[1]] = merged(out[t[1]], r)
        else:
            out.append(r)
    return out


def attached(data):
    out = [r for r in data if r["superBuiltUpArea"] is not None]
    return upserted(out, sorted((r for r in data if r["superBuiltUpArea"] is None), key=lambda r: (-full(r), r["ord"])))


def compacted(data, side=0):
    """What ``merge.compact`` gives, without Spark."""
    out = []
    for r in data:
        counted = {f: r[f] for f in FIELDS if f not in identity.UNCOUNTED and not empty(r[f])}
        lists = {f: [hash(x) or 1 for x in v] for f, v in counted.items() if isinstance(v, list)}
        scalars = {f: 1 + min(len(v), 200) // 50 if isinstance(v, str) else 1 for f, v in counted.items() if f not in lists}
        out.append({"ord": r["ord"], "side": side, "slug": slug(r["projectName"]), "city": slug(r["city"]), "locality": slug(r["locality"]), "bhk": r["bhk"], "area": r["superBuiltUpArea"], "legacy_url": (r["sourceUrl"] or "").strip().lower().rstrip("/"), "legacy_slug": r["slug"], "hash": r["ord"], "scalars": scalars, "lists": lists})
    return out


def executed(plan, *data):
    """Rows merged as a plan (ord, side, target, target_side, seq) says."""
    own = {(r["ord"], side): r for side, rows_ in enumerate(data) for r in rows_}
    out = {}
    for x in plan.sort_values("seq").to_dict("records"):
        at, r = (x["target"], x["target_side"]), own[x["ord"], x["side"]]
        out[at] = merged(out[at], r) if at in out else r
    return list(out.values())


@pytest.mark.parametrize("part", range(3))
def test_folds_on_300_random_archives(part):
    for seed in range(100 * part, 100 * part + 100):
        rng = random.Random(seed)
        data, batch = rows(rng, 30), rows(rng, 25, 100)
        assert expected(executed(dedupe._attach(pd.DataFrame(compacted(data))), data)) == expected(attached(data)), seed
        assert expected(executed(merge.assign(pd.DataFrame(compacted(data) + compacted(batch, 1))), data, batch)) == expected(upserted(data, batch)), seed


def many(seeds, n, first=0):
    """Rows of many independent archives, each with its own mark and order."""
    out = []
    for seed in seeds:
        out += rows(random.Random(seed + first), n, first + 1000 * seed, f"m{seed}")
    return out


def by_mark(data):
    parts = defaultdict(list)
    for r in data:
        parts[r["city"]].append(r)
    return parts


def test_tiers_and_upsert(spark):
    archive, batch = many(range(20), 25), many(range(20), 25, 100_000)
    old, new = by_mark(archive), by_mark(batch)
    got = {r["ord"]: (r["tier"], r["target"]) for r in merge.match_tiers(frame(spark, archive), frame(spark, batch)).collect()}
    assert got == {r["ord"]: (t[0], old[m][t[1]]["ord"]) for m in new for r in new[m] if (t := tier(old[m], r))}
    out = [r for m in new for r in upserted(old[m], new[m])]
    assert plain(merge.upsert(frame(spark, archive), frame(spark, batch))) == expected(out)


@pytest.mark.parametrize("seed", [4, 5])
def test_upsert_of_mixed_blocks(spark, seed):
    rng = random.Random(seed)
    archive, batch = rows(rng, 25), rows(rng, 25, 100)  # without a city, too: rows change their blocks as they merge
    assert plain(merge.upsert(frame(spark, archive), frame(spark, batch))) == expected(upserted(archive, batch))


def test_upsert_leaves_what_it_does_not_meet(spark):
    archive, batch = rows(random.Random(1), 40, mark="one") + rows(random.Random(2), 40, 500, mark="two"), rows(random.Random(3), 10, 900, mark="two")
    small = merge.touched(frame(spark, archive), frame(spark, batch)).collect()
    assert {r["ord"] for r in small if r["side"] == 0} <= {r["ord"] for r in archive if r["city"] == "noidatwo"}
    changes = merge.upsert(frame(spark, archive), frame(spark, batch), only_changes=True)
    whole = merge.upsert(frame(spark, archive), frame(spark, batch))
    assert whole.count() == changes.count() + 80 - sum(r["side"] == 0 for r in small)


def test_passes(spark):
    data = many(range(30, 50), 30)
    groups = {}
    for r in sorted(data, key=lambda r: (-full(r), r["ord"])):
        k = key(r) or ("#", r["ord"])
        groups[k] = merged(groups[k], r) if k in groups else r
    assert plain(dedupe.exact(frame(spark, data))) == expected(groups.values())
    assert plain(dedupe.attach_null_areas(frame(spark, data))) == expected(r for part in by_mark(data).values() for r in attached(part))
    bare = [r | {"superBuiltUpArea": None} for r in data]
    assert plain(dedupe.attach_null_areas(frame(spark, bare))) == expected(bare)


def test_one_address_does_not_chain_blocks(spark):
    """Rows of one address but other counts or areas are no longer one group."""
    data = [r | {"sourceUrl": "http://all", "bhk": k, "projectName": f"project {'abcdefghij'[k % 10]}", "slug": f"s{k}"} for k, r in enumerate(rows(random.Random(7), 200))]
    assert merge.largest_group(merge.compact(frame(spark, data)).selectExpr("*", "0 as side")) == 1


def test_rows_that_merge_with_nothing_stay_as_they_are(spark):
    data = [dict(zip(FIELDS, (0, "lodha park", "noida", "s16", 2, 900, None, "", ["Pool", "Pool"], [("p", "u"), ("p", "u")], "http://x", None, "a"), strict=True))]
    for step in (dedupe.exact, dedupe.soft, dedupe.attach_null_areas, dedupe.attach_sole_null, lambda d: merge.upsert(d, d.limit(0))):
        assert plain(step(frame(spark, data))) == expected(data)
