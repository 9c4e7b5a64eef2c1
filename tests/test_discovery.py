"""Crawling with budgets, seeds, running names, the limiter over a stream, and the audit of untyped rows."""

import datetime
import json
import random

import pytest
from pyspark.sql import functions as F

from ledgerloom.functions import arrays as A
from ledgerloom.operators import audit, discover
from ledgerloom.streaming import limiter


def crawled(links, finds, seeds, most_pages, most):
    """One seed after the other, one page after the other."""
    nexts, items = {}, {}
    for a, b in (x for x in links if x[1] is not None):
        nexts.setdefault(a, set()).add(b)
    for a, b in (x for x in finds if x[1] is not None):
        items.setdefault(a, set()).add(b)
    out = {}
    for seed, start in sorted(seeds):
        left = None if most is None else most - len(out)
        if left is not None and left <= 0:
            break
        queue, visited, own = [start], [], []
        while queue and len(visited) < most_pages:
            page = queue.pop(0)
            visited.append(page)
            for item in sorted(items.get(page, ())):
                if item not in [x for x, _ in own]:
                    own.append((item, len(visited)))
            queue += [x for x in sorted(nexts.get(page, ())) if x not in visited and x not in queue]
        for item, visit in own[:left]:
            out.setdefault(item, (seed, visit, len(out) + 1))
    return {(item, *at) for item, at in out.items()}


@pytest.mark.parametrize(("seed", "most_pages", "most"), [(1, 30, None), (2, 4, None), (3, 30, 12), (4, 3, 7), (5, 30, 1)])
def test_crawl(spark, seed, most_pages, most):
    rng = random.Random(seed)
    links = [(rng.randrange(60), rng.randrange(70)) for _ in range(150)] + [(5, None), (7, 7)]
    finds = [(rng.randrange(70), rng.randrange(40)) for _ in range(120)] + [(3, None)]
    seeds = [(k, rng.randrange(60)) for k in range(4)]
    found = discover.crawl(spark.createDataFrame(links, "page long, next long"), spark.createDataFrame(finds, "page long, item long"), spark.createDataFrame(seeds, "seed long, page long"), most_pages, most)
    assert {(r["item"], r["seed"], r["visit"], r["rank"]) for r in found.collect()} == crawled(links, finds, seeds, most_pages, most)


def test_seeds(spark):
    lattice = spark.createDataFrame([(0, "residential", "https://x.example/r/"), (1, "commercial", "https://x.example/c/?page=2"), (2, "commercial", "https://x.example/c"), (3, "residential", "https://x.example/c")], "ord int, category string, url string")
    urls = lambda c: [r["url"] for r in discover.seeds_of(lattice, c).orderBy("ord").collect()]
    assert urls(None) == ["https://x.example/r/", "https://x.example/c/?page=2", "https://x.example/c"] and urls(" Residential") == ["https://x.example/r/", "https://x.example/c"]
    with pytest.raises(ValueError):
        discover.seeds_of(lattice, "farms")
    forms = {r["url"] for r in discover.seed_forms(discover.seeds_of(lattice, "commercial")).collect()}
    assert forms == {"https://x.example/c", "https://x.example/c/", "https://x.example/c?page=2", "https://x.example/c/?page=2"}
    left = discover.without_seeds(spark.createDataFrame([("https://x.example/c/?page=9",), ("https://x.example/r",), ("https://x.example/sky/",)], "url string"), discover.seeds_of(lattice, "all"))
    assert [r["url"] for r in left.collect()] == ["https://x.example/sky/"]


def test_refresh_takes_known_addresses_only(spark):
    urls = spark.createDataFrame([(k, f"s{k % 2}", f"http://x/{k}/") for k in range(12)], "ord int, site string, url string")
    archive = spark.createDataFrame([(f"http://X/{k}",) for k in range(8)], "sourceUrl string")
    assert sorted(r["ord"] for r in discover.refresh(urls, archive, most=3).collect()) == [0, 1, 2, 3, 4, 5]


def test_running_names(spark):
    rng = random.Random(2)
    lists = [[[rng.choice(["a", "a-2", "b"]), *([rng.choice(["a-2", "c"])] if rng.random() < 0.5 else [])] for _ in range(rng.randrange(9))] for _ in range(60)] + [[["a"], ["a-2"], ["a"]]]

    def named(ladders):
        used = []
        for ladder in ladders:
            free = [c for c in ladder if c not in used] or [f"{ladder[-1]}-{n}" for n in range(2, 99) if f"{ladder[-1]}-{n}" not in used]
            used.append(free[0])
        return used

    frame = spark.createDataFrame([(k, x) for k, x in enumerate(lists)], "k int, x array<array<string>>")
    assert {r["k"]: r["n"] for r in frame.select("k", A.running_names(F.col("x")).alias("n")).collect()} == {k: named(x) for k, x in enumerate(lists)}


def test_limiter_over_a_stream(spark, tmp_path):
    rng = random.Random(4)
    start = datetime.datetime(2026, 1, 1)
    rows = [(k, rng.choice(["a", "b", "hot", "hot", "hot"]), start + datetime.timedelta(seconds=rng.randrange(4000) / 4)) for k in range(300)]
    whole = {r["event_id"]: r["accepted"] for r in limiter.accepted(spark.createDataFrame(rows, "event_id long, client string, ts timestamp")).collect()}
    recent, plain = {}, {}
    for k, c, t in sorted(rows, key=lambda r: (r[1], r[2], r[0])):
        own = recent.setdefault(c, [])
        own[:] = [x for x in own if t - x < datetime.timedelta(seconds=60)]
        plain[k] = len(own) < 5
        if plain[k]:
            own.append(t)
    assert whole == plain
    rng.shuffle(rows)
    path, shape = f"file://{tmp_path}/in", "event_id long, client string, ts timestamp"
    before = {k: spark.conf.get(k, None) for k in ("spark.sql.streaming.stateStore.providerClass", "spark.sql.shuffle.partitions")}
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", limiter.ROCKS)
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    try:
        for part in (rows[:140], rows[140:], [(999, "end", start + datetime.timedelta(days=9))]):
            spark.createDataFrame(part, shape).coalesce(1).write.mode("append").parquet(path)
            stream = limiter.accepted_stream(spark.readStream.schema(shape).parquet(path), late="2 hours")
            stream.writeStream.format("parquet").option("path", f"file://{tmp_path}/out").option("checkpointLocation", f"file://{tmp_path}/marks").trigger(availableNow=True).start().awaitTermination()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    out = spark.read.parquet(f"file://{tmp_path}/out").collect()
    assert {r["event_id"]: r["accepted"] for r in out if r["client"] != "end"} == whole and len(out) == 300


def test_audit_of_untyped_rows(spark):
    good = {"title": "t", "city": "Pune", "listingType": "BUY", "status": "ACTIVE", "price": 3, "images": [{"url": "u"}]}
    cases = [
        (good, set()), ([1], {("", "structure", "not_object:list")}), (None, {("", "structure", "not_object:none")}), ("x", {("", "structure", "not_object:str")}),
        (good | {"title": 0}, {("title", "required", "0")}), ({k: v for k, v in good.items() if k != "city"}, {("city", "required", None)}), (good | {"status": None}, {("status", "enum", None)}), (good | {"status": ["ACTIVE"]}, {("status", "enum", '["ACTIVE"]')}),
        (good | {"facing": "UP"}, {("facing", "enum", "UP")}), (good | {"facing": None, "furnishing": None}, set()), (good | {"price": "3", "bhk": True}, {("price", "number", "str: 3")}), (good | {"latitude": {"a": 1}}, {("latitude", "number", 'dict: {"a":1}')}),
        (good | {"images": {}}, {("images", "images", "dict: {}")}), (good | {"images": [{"url": "u"}, None, {"url": 0}]}, {("images[1]", "images", "null")}), (good | {"images": []}, set()), (good | {"images": [{"url": 5}]}, set()),
        (good | {"amenities": ["+2 more", 3, "Gym", " + 11 MORE "]}, {("amenities", "junk", "+2 more"), ("amenities", "junk", " + 11 MORE ")}), (good | {"amenities": "+2 more"}, set()),
    ]
    rows = [(k, json.dumps(x)) for k, (x, _) in enumerate(cases)] + [(100, "{broken"), (101, None), (102, "")]
    found = {}
    for r in audit.audit(spark.createDataFrame(rows, "ord long, json string")).collect():
        found.setdefault(r["ord"], set()).add((r["field"], r["rule"], r["value"]))
    assert {k: found.get(k, set()) for k, _ in enumerate(cases)} == {k: x for k, (_, x) in enumerate(cases)}
    assert all(found[k] == {("", "structure", "not_json")} for k in (100, 101, 102))
