"""Late and repeated pages fill gaps and change nothing else; helpers that had no test."""

import datetime
import json

import pytest
from pyspark.sql import functions as F

from ledgerloom.functions import text as T
from ledgerloom.functions import urls as U
from ledgerloom.operators import dedupe, media, merge, quality, schema
from ledgerloom.sources import archive, html, portals
from ledgerloom.streaming import enrich

DAY = datetime.datetime(2026, 1, 1)
SHAPE = "sourceUrl string, bhk long, superBuiltUpArea long, price long, city string, amenities array<string>, at timestamp"


def test_filled():
    old = {"price": None, "city": "Pune", "amenities": ["Gym"], "note": " "}
    assert enrich.filled(old, {"price": 5, "city": "Delhi", "amenities": ["Pool", "Gym"], "note": "x", "more": 1}) == {"price": 5, "city": "Pune", "amenities": ["Gym", "Pool"], "note": "x", "more": 1}
    assert enrich.filled(old, {"amenities": None, "price": ""}) == old and enrich.filled({"a": 0}, {"a": 7}) == {"a": 0}


def test_late_and_repeated_pages(spark, tmp_path):
    known, pages = f"file://{tmp_path}/known", f"file://{tmp_path}/pages"
    rows = lambda *x: spark.createDataFrame([(u, 2, a, p, c, m, DAY + datetime.timedelta(days=d)) for u, a, p, c, m, d in x], SHAPE).coalesce(1)
    batches = [
        (known, rows(("http://x/a", 900, None, "Pune", ["Gym"], 0), ("http://x/b", None, 3, None, None, 0))),
        (pages, rows(("http://X/a/", 900, 5, "Delhi", ["Pool"], 9), ("http://x/new", 1, 1, "Goa", None, 9))),
        (pages, rows(("http://x/a", 900, 7, None, None, 3), ("http://x/a", 900, 5, "Delhi", ["Pool"], 9), ("http://x/b", None, 4, "Agra", ["Lift"], 1))),
    ]
    settings = {"spark.sql.streaming.stateStore.providerClass": enrich.ROCKS, "spark.sql.shuffle.partitions": "2"}
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    rows().write.mode("append").parquet(pages)
    told = []
    try:
        for path, batch in batches:
            batch.write.mode("append").parquet(path)
            streams = [spark.readStream.schema(SHAPE).parquet(p) for p in (known, pages)]
            query = enrich.enriched(*streams).writeStream.outputMode("update").foreachBatch(lambda df, n: told.extend(df.collect())).option("checkpointLocation", f"file://{tmp_path}/marks").trigger(availableNow=True).start()
            query.awaitTermination()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    last = {(r["url_key"], r["unit"]): json.loads(r["json"]) for r in told}
    assert set(last) == {("http://x/a", "2|900"), ("http://x/b", "2|")} and [r["first"] for r in told].count(True) == 2
    a, b = last["http://x/a", "2|900"], last["http://x/b", "2|"]
    assert (a["price"], a["city"], a["amenities"], a["sourceUrl"]) == (5, "Pune", ["Gym", "Pool"], "http://x/a")  # the first value that came stays
    assert (b["price"], b["city"], b["amenities"]) == (3, "Agra", ["Lift"]) and len(told) == 4


def test_helpers_without_a_query(spark, tmp_path):
    assert portals.parse_sites(" a, B ,", {"a": 1, "b": 2}) == ["a", "b"] and portals.parse_sites(None, {"a": 1}) == ["a"]
    with pytest.raises(ValueError):
        portals.parse_sites("c", {"a": 1})
    df = spark.createDataFrame([(0, "s", [("http://i/1",), ("http://i/2",)], "t0"), (1, "s", [], "t1"), (2, "z", None, None)], "ord long, slug string, images array<struct<url: string>>, title string")
    [r] = archive.find_slug(df, "s").collect()
    assert (r["ord"], r["image_urls"]) == (0, ["http://i/1", "http://i/2"]) and archive.find_slug(df, "none").count() == 0
    assert [r["ord"] for r in archive.tail(df, most=2).collect()] == [2, 1]
    archive.write_jsonl(df.select("ord", "title"), f"file://{tmp_path}/lines")
    assert sorted(json.dumps(json.loads(r["value"])) for r in spark.read.text(f"file://{tmp_path}/lines").collect())[2] == '{"ord": 2, "title": null}'
    assert archive.latest_path("a/b/out.json") == "a/b/latest" and archive.stats_path("a/b/out.json") == "a/b/run-stats"
    urls = spark.createDataFrame([("https://x.example/projects/residential/?page=2",), ("https://x.example/about",), ("https%3A%2F%2Fx%2Fa%20b",)], "u string")
    assert [r[0] for r in urls.select(U.listing_category("u")).collect()] == ["residential", None, None]
    assert urls.select(U.decoded("u")).collect()[2][0] == "https://x/a b"
    texts = spark.createDataFrame([("sco plots", "Upcoming", "GURUGRAM"), (" Villa ", "ready to-move", "Pune"), (None, "", None)], "k string, p string, c string")
    assert [tuple(r) for r in texts.select(T.bulk_type("k"), T.bulk_possession("p"), T.bulk_city("c")).collect()] == [("SCO", "NEW_LAUNCH", "Gurgaon"), ("Villa", "READY_TO_MOVE", "Pune"), (None, None, None)]
    raw = spark.createDataFrame([(0, "n.a."), (1, "1,500"), (2, None)], "ord long, price string")
    assert [tuple(r) for r in quality.repair(raw, raw=True).orderBy("ord").collect()] == [(0, None, "n.a."), (1, 1500.0, None), (2, None, None)]


def test_stamps_and_public_columns(spark):
    df = schema.conform(spark.createDataFrame([(0, "Sky Park", "Pune")], "ord long, projectName string, city string"))
    stamped = schema.stamp(df, DAY)
    assert stamped.select("scrapedAt").distinct().count() == 1 and stamped.first()["scrapedAt"] is not None
    sourced = schema.with_source(spark.createDataFrame([("http://x/a", None), ("http://x/b", "own")], "sourceUrl string, sourceSite string"), "site", "sourceUrl")
    assert [(r["sourceSite"], [tuple(x) for x in r["sources"]]) for r in sourced.collect()] == [("site", [("site", "http://x/a")]), ("own", [("site", "http://x/b")])]
    public = schema.public(df)
    assert not set(schema.PROVENANCE) & set(public.columns)
    assert dedupe.dedupe_if_needed(df.select("ord", "projectName", "city", "locality", "bhk", "superBuiltUpArea"), always=False).count() == 1
    counts = media.image_counts(spark.createDataFrame([(0, [("http://store/u",), ("http://other/v",)]), (1, None), (2, [])], "ord long, images array<struct<url: string>>"), "store").first()
    assert tuple(counts) == (1, 1)


def test_listing_links(spark):
    pages = spark.createDataFrame([("https://www.p.example/projects/residential/", '<a class="x" href="/sky-park/">s</a><a href="/projects/residential/?page=2">2</a><a href="/projects/commercial/?page=2">c</a> "/projects/residential/?page=3" <a href="#top">t</a>')], "url string, html string")
    assert sorted(r["next"] for r in html.pagination_links(pages, "p.example").collect()) == ["https://www.p.example/projects/residential/?page=2", "https://www.p.example/projects/residential/?page=3"]
    assert "https://www.p.example/sky-park/" in {r["project"] for r in html.project_links(pages, "p.example").collect()}
