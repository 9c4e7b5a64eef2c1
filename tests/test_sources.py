"""Pages, portals, archives, limiter and streaming upsert."""

import datetime
import json

from pyspark.sql import functions as F
from pyspark.sql import types as S

from ledgerloom.operators import discover, quality, schema
from ledgerloom.sources import archive, html, portals
from ledgerloom.streaming import limiter
from ledgerloom.streaming.upsert import Archive

LONG = "The project stands near the expressway and " + "has many gardens with old trees and quiet paths, " * 4


def page(body, head=""):
    return f"<html><head><title>Sky Park | Portal</title>{head}</head><body><h1>Sky Park</h1>{body}</body></html>"


def units(spark, kind, text):
    pages = spark.createDataFrame([("https://p.example/sky-park/", text)], "url string, html string")
    return portals.units(pages, portals.registry({kind: "p.example"})[kind]).collect()


def test_pushed_portal(spark):
    data = {"projectName": "Sky Park", "projectUrl": "sky-park", "builderName": "Acme", "city": "gurugram", "projectAddress": "Plot 2, Sector 16B 122001", "project_Status": "Upcoming", "projectReraNo": "GGM/HRERA/1",
            "BhK_Details": [{"bhk_type": "3 BHK", "bhk_Area": "1,500", "price": 2.5, "priceUnit": "Cr"}, {"bhk_type": "3 BHK", "bhk_Area": "1,500"}], "Amenities": ["Gym", {"name": "Pool"}, "+2 More"], "frontImage": "http://i/1.jpg"}
    script = f"<script>self.__x.push([1,{json.dumps(json.dumps(data))}])</script>"
    rows = units(spark, "pushed", page(f"<p>{LONG}</p>{script}"))
    assert [(r["bhk"], r["superBuiltUpArea"], r["price"], r["slug"]) for r in rows] == [(3, 1500, 25_000_000, "sky-park-3bhk"), (3, 1500, None, "sky-park-3bhk-1500sqft")]
    r = rows[0]
    assert (r["city"], r["locality"], r["pincode"], r["possessionStatus"], r["reraState"], r["developer"]) == ("Gurgaon", "Sector 16B", "122001", "NEW_LAUNCH", "Haryana", "Acme")
    assert r["amenities"] == ["Gym", "Pool"] and r["images"][0]["url"] == "http://i/1.jpg" and r["description"].startswith("The project stands")


def test_plans_portal(spark):
    plans = {"data": {"configurations": [{"bedroom": "2", "bathroom": "2", "tuples": [{"areaType": [{"id": "CARPET", "area": {"min": 800}}, {"id": "SBA", "area": {"min": 1100}}], "price": 7_500_000}] * 2}]}}
    head = '<script type="application/ld+json">{"@type": "Product", "name": "Sky Park", "brand": {"name": "Acme"}}</script>'
    rows = units(spark, "plans", page(f"<script>var a={{\"floorPlans\":{json.dumps(plans)}}}</script>" + "x" * 5000, head))
    assert [(r["projectName"], r["developer"], r["bhk"], r["carpetArea"], r["superBuiltUpArea"], r["bathrooms"], r["price"]) for r in rows] == [("Sky Park", "Acme", 2, 800, 1100, 2, 7_500_000)]
    assert units(spark, "plans", "short") == []


def test_state_inline_and_text_portals(spark):
    state = {"props": {"page": {"name": "Sky Park", "developer_name": "Acme", "city": "pune", "inventory_configs": [{"apartment_type": "2 BHK", "carpet_area": 700, "built_up_area": "900", "price": 5_000_000}]}}}
    [r] = units(spark, "state", page(f'<script id="__NEXT_DATA__" type="application/json">{json.dumps(state)}</script>'))
    assert (r["bhk"], r["carpetArea"], r["superBuiltUpArea"], r["city"]) == (2, 700, 900, "Pune")
    [r] = units(spark, "inline", page('<script>x={"projectName":"Sky Park","devName":"Acme","cityName":"Delhi","psmLatitude":"28.7","psmLongitude":"77.1"}</script><p>3 BHK Flat 1,500 sq ft</p>'))
    assert (r["bhk"], r["superBuiltUpArea"], r["latitude"]) == (3, 1500, 28.7)
    rows = units(spark, "text", page("<p>2 BHK homes from 1,150 Sq. Ft</p>" + "y" * 5000))
    assert [(r["projectName"], r["bhk"], r["superBuiltUpArea"]) for r in rows] == [("Sky Park", 2, 1150)]
    [r] = units(spark, "inline", page("<p>nothing</p>"))
    assert r["bhk"] is None and r["projectName"] == "Sky Park"


def one(spark, kind, url, text, **more):
    return portals.units(spark.createDataFrame([(url, text)], "url string, html string"), portals.registry({kind: "p.example"})[kind], **more).collect()


def test_plans_portal_in_full(spark):
    plans = {"data": {"configurations": [{"bedroom": "2", "tuples": [{"areaType": [{"id": "CARPET", "area": {"min": 800}}]}, {"areaType": [{"id": "SBA", "area": {"min": 1500}}], "price": {"value": 9_000_000}}]}]}}
    head = '<script type="application/ld+json">{"@type": "Product", "name": "Sky Park", "offers": {"lowPrice": "7500000"}, "image": "http://i/0.jpg"}</script>'
    body = f"<script>var a={{\"floorPlans\":{json.dumps(plans)}, \"builderName\": \"Acme\"}}; [{{\"amenityName\": \"Gym\"}}, {{\"amenityName\": \"Pool\"}}]</script><p>HRERA/12/2024 Possession : Dec 2027</p><img src='//img.p.example/1.jpg'><img src='http://other/2.jpg'>" + "x" * 5000
    url = "https://www.p.example/sky-park-sector-16b-gurgaon-npxid-r1"
    rows = sorted(one(spark, "plans", url, page(body, head)), key=lambda r: r["carpetArea"] or 0)
    r = rows[1]
    assert (r["projectName"], r["developer"], r["city"], r["locality"], r["bhk"], r["carpetArea"], r["superBuiltUpArea"], r["price"], r["price_is_project_level"]) == ("Sky Park", "Acme", "Gurgaon", "Sector 16B", 2, 800, None, None, False)
    assert (str(r["possessionDate"]), r["possessionStatus"], r["amenities"], [x["url"] for x in r["images"]], r["reraNumber"]) == ("2027-12-01", "UNDER_CONSTRUCTION", ["Gym", "Pool"], ["http://i/0.jpg", "https://img.p.example/1.jpg"], "HRERA/12/2024")
    assert r["slug"] == "sky-park-sector-16b-gurgaon-npxid-r1-2bhk-800sqft" and rows[0]["price"] == 9_000_000
    assert sorted((x["price"], x["price_is_project_level"]) for x in one(spark, "plans", url, page(body, head), project_price=True)) == [(7_500_000, True), (9_000_000, False)]
    listing = f"<a href='/a-b-npxid-r2?x=1'>a</a> {url}?y <a href='{url}'>b</a>" + "z" * 5000
    found = portals.listed(spark.createDataFrame([(1, listing), (2, "Access Denied" + listing), (3, "/a-b-npxid-r9")], "page_id long, html string"), portals.registry({"plans": "p.example"})["plans"])
    assert sorted((r["page_id"], r["url"]) for r in found.collect()) == [(1, "https://www.p.example/a-b-npxid-r2"), (1, url)]


def test_text_portal_in_full(spark):
    body = "<h1>Sky Park Sector 86, Noida</h1><h2>About Acme Homes</h2><p>2 BHK homes from 1,150 Sq. Ft, Starting from ₹ 1.25 Cr, Possession - Mar 2026, UPRERAPRJ123456</p><div class='x-amenities'><ul><li>Gym</li><li>Pool</li></ul></div><img src='https://static.p.example/a.png'>" + "y" * 5000
    [r] = one(spark, "text", "https://www.p.example/noida-commercial-property/sky-park/12/project", f"<html><body>{body}</body></html>", project_price=True)
    assert (r["projectName"], r["developer"], r["city"], r["locality"], r["bhk"], r["superBuiltUpArea"], r["propertyType"], r["price"], r["price_is_project_level"]) == ("Sky Park", "Acme Homes", "Noida", "Sector 86", 2, 1150, "Commercial", 12_500_000, True)
    assert (str(r["possessionDate"]), r["possessionStatus"], r["amenities"], r["images"][0]["url"], r["reraNumber"]) == ("2026-03-01", "UNDER_CONSTRUCTION", ["Gym", "Pool"], "https://static.p.example/a.png", "UPRERAPRJ123456")


def test_inline_portal_possession(spark):
    [r] = one(spark, "inline", "https://p.example/x-pdpid-1", page('<script>x={"projectName":"Sky Park","lmtDName":"Sector 4","minPrice":"5000000"}</script><p>Possession Dec\'27</p>'), project_price=True)
    assert (r["locality"], str(r["possessionDate"]), r["possessionStatus"], r["price"], r["price_is_project_level"]) == ("Sector 4", "2027-12-01", "UNDER_CONSTRUCTION", 5_000_000, True)


def test_questions_and_points():
    text = page('<details><summary>What is it?</summary>A very tall tower.</details><h3>When is it ready?</h3><p>In the year after next.</p><script type="application/ld+json">{"mainEntity": [{"name": "what is it?", "acceptedAnswer": {"text": "another answer"}}]}</script>')
    assert [f["question"] for f in html.page_extras(text)["faqs"]] == ["What is it?", "When is it ready?"]
    assert html.page_extras(None)["h1"] is None and html.page_extras("<p>unclosed <b>x")["faqs"] == []


def test_archive_scans(spark, tmp_path):
    shape = S.StructType.fromDDL("title string, bhk long")
    for name, text, n in (("a", '[{"title": "x", "bhk": 2}, 3, {"title": "y"}]', 2), ("b", '{"properties": [{"title": "x"}]}', 1), ("c", '{"items": [{"title": "x"}]}', 1), ("d", '{"title": "x"}', 1), ("e", "{broken", 0)):
        (tmp_path / name).write_text(text)
        assert archive.read_archive(spark, f"file://{tmp_path}/{name}", shape).count() == n, name
    assert archive.read_archive(spark, f"file://{tmp_path}/none", shape).count() == 0
    (tmp_path / "urls").write_text("# seeds\nsky-park\n\nhttps://www.p.example/sky-park/\nhttps://odd.example/x?y\n")
    assert [r["url"] for r in archive.read_urls(spark, f"file://{tmp_path}/urls", "p.example").orderBy("ord").collect()] == ["https://www.p.example/sky-park/", "https://odd.example/x?y"]


def test_archive_of_more_than_128_mb(spark, tmp_path):
    with (tmp_path / "big").open("w") as f:
        f.write("[")
        for i in range(70_000):
            f.write(("," if i else "") + json.dumps({"title": f"t{i}", "bhk": i, "more": "x" * 2000}))
        f.write("]")
    assert (tmp_path / "big").stat().st_size > 130 << 20
    shape = S.StructType.fromDDL("title string, bhk long")
    got = archive.read_archive(spark, f"file://{tmp_path}/big", shape).agg(F.count("title"), F.sum("bhk"), F.max("ord"), F.count_if(F.col("ord") == F.col("bhk"))).first()
    assert tuple(got) == (70_000, 70_000 * 69_999 // 2, 69_999, 70_000)


def test_sinks(spark, tmp_path):
    path = f"file://{tmp_path}/archive"
    df = spark.createDataFrame([(1, None)], "a int, b string")
    for a in range(3):
        archive.write_atomic(df.withColumn("a", F.lit(a)), path)
        assert spark.read.text(archive.current(spark, path)).collect()[0][0] == f'{{"a":{a},"b":null}}'
    assert len([x for x in (tmp_path / "archive").iterdir() if x.name.startswith("v-")]) == 2
    shape = S.StructType.fromDDL("a int, b string")
    assert [(r["a"], r["b"], r["ord"]) for r in archive.read_archive(spark, path, shape).collect()] == [(2, None, 0)]
    # a crash after the rows are written and before the pointer turns leaves the table as it was
    df.withColumn("a", F.lit(9)).write.json(f"{path}/v-crashed")
    assert archive.read_archive(spark, path, shape).first()["a"] == 2
    archive.write_stats(spark.createDataFrame([("s", 3)], "site string, events long"), path, "r1", datetime.datetime(2026, 1, 1))
    archive.write_stats(spark.createDataFrame([("s", 4)], "site string, events long"), path, "r2", datetime.datetime(2026, 1, 2))
    assert sorted((r["runId"], r["events"]) for r in spark.read.json(archive.stats_path(path)).collect()) == [("r1", 3), ("r2", 4)]
    errors = spark.createDataFrame([("u", "e")], "url string, error string")
    for run in ("r1", "r2"):
        archive.append_errors(errors, f"file://{tmp_path}/errors", run, datetime.datetime(2026, 1, 1))
    assert spark.read.json(f"file://{tmp_path}/errors").count() == 2


def test_schema_and_quality(spark):
    df = spark.createDataFrame([(0, "t", "ncr", "1,500", ["Gym", "gym", "+2 more"], "BAD")], "ord long, title string, city string, price string, amenities array<string>, listingType string")
    c = schema.conform(df)
    assert [x for x in c.columns if x != "ord"] == [*schema.SCHEMA, *schema.PROVENANCE]
    assert {r["field"]: r["rule"] for r in quality.violations(df).collect()} == {"listingType": "enum", "price": "number", "amenities": "junk"}
    [r] = quality.repair(df).collect()
    assert (r["city"], r["price"], r["amenities"]) == ("Delhi NCR", 1500.0, ["Gym"])
    assert "missing:slug" in df.select(schema.problems(df).alias("p")).first()["p"]


def test_discovery_filters_before_it_caps(spark):
    urls = spark.createDataFrame([(0, "a", "http://x/1"), (1, "a", "http://x/2/"), (2, "a", "http://x/3")], "ord int, site string, url string")
    known = spark.createDataFrame([("http://X/1/",)], "sourceUrl string")
    assert [r["url"] for r in discover.discover(urls, known, most=1).collect()] == ["http://x/2/"]


def test_limiter(spark):
    start = datetime.datetime(2026, 1, 1)
    rows = [(i, "c", start + datetime.timedelta(seconds=s)) for i, s in enumerate([0, 1, 2, 3, 4, 5, 59, 60, 61])]
    got = {r["event_id"]: r["accepted"] for r in limiter.accepted(spark.createDataFrame(rows, "event_id long, client string, ts timestamp")).collect()}
    assert got == {0: True, 1: True, 2: True, 3: True, 4: True, 5: False, 6: False, 7: True, 8: True}


def test_streaming_upsert(spark, tmp_path):
    shape = S.StructType.fromDDL("ord long, projectName string, city string, locality string, bhk long, superBuiltUpArea long, price long")
    for k, rows in enumerate(([(0, "Sky Park", "Pune", "A", 2, 900, None)], [(1, "Sky Park", "Pune", "A", 2, 900, 5), (2, "Else", "Pune", "B", 1, 500, None)])):
        spark.createDataFrame(rows, shape).coalesce(1).write.mode("append").parquet(f"file://{tmp_path}/in")
        store = Archive(spark, f"file://{tmp_path}/store", shape)
        store.run(spark.readStream.schema(shape).parquet(f"file://{tmp_path}/in"), f"file://{tmp_path}/marks")
    assert sorted((r["projectName"], r["price"]) for r in store.read(1).collect()) == [("Else", None), ("Sky Park", 5)]
    assert store.latest(1).count() == 2
    # a new checkpoint goes on from the archive
    again = Archive(spark, f"file://{tmp_path}/store", shape)
    again.run(spark.readStream.schema(shape).parquet(f"file://{tmp_path}/in"), f"file://{tmp_path}/marks2")
    assert again.last() == 2 and sorted((r["projectName"], r["price"]) for r in again.read(2).collect()) == [("Else", None), ("Sky Park", 5)]


def test_repeated_rows_and_frontier(spark):
    links = spark.createDataFrame([(1, 2), (2, 3), (3, 1), (3, 4), (4, 5)], "src long, dst long")
    got = {r["node"]: r["depth"] for r in discover.frontier(links, spark.createDataFrame([(1,), (1,)], "node long"), 3).collect()}
    assert got == {1: 0, 2: 1, 3: 2, 4: 3}
    assert discover.concat_distinct([spark.sql("select 'a' as k, 0 as ord"), spark.sql("select 'a' as k, 5 as ord")], "k").count() == 1
    assert F is not None
