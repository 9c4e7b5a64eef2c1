"""Keys, soft match, merge, consolidation and upsert on small archives."""

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import dedupe, identity, merge

SHAPE = "ord long, projectName string, city string, locality string, bhk long, superBuiltUpArea long, carpetArea long, bathrooms long, price long, amenities array<string>, reraRegistered boolean, sourceUrl string, slug string"


def unit(ord, **more):
    base = {"ord": ord, "projectName": "Gaurs Atulayam", "city": "Greater Noida", "locality": "Sector 16", "bhk": 3, "superBuiltUpArea": 1500, "carpetArea": None, "bathrooms": None, "price": None, "amenities": [], "reraRegistered": None, "sourceUrl": None, "slug": f"s{ord}"}
    return base | more


def frame(spark, *rows):
    return spark.createDataFrame([tuple(r.values()) for r in rows], SHAPE)


def out(df):
    return sorted((r.asDict() for r in df.collect()), key=lambda r: r["ord"])


@pytest.mark.parametrize(("a", "b", "same"), [("Gaurs Atulayam", "Gaurs Atulyam", True), ("Gaur City 1st Avenue", "Gaur City 4th Avenue", False), ("Gaur Grandeur", "Gaur Grandeur 2", False), ("Alpha One", "Alpha Two", False), ("Lodha Park", "Godrej Park", False)])
def test_soft_match(spark, a, b, same):
    slug = lambda x: x.lower().replace(" ", "-")
    assert identity.soft_match(slug(a), slug(b)) is same
    pairs = spark.createDataFrame([(slug(a), slug(b))], "a string, b string")
    assert (identity.soft_pairs(pairs, "a", "b").count() == 1) is same


def test_null_fill_keeps_concrete_values(spark):
    a, b = unit(0, price=8_000_000, amenities=["Pool"], reraRegistered=False), unit(1, price=9_000_000, carpetArea=1200, amenities=["Gym", "Pool"], reraRegistered=True)
    [r] = out(merge.null_fill(frame(spark, a, b).withColumn("_g", F.lit(1)).withColumn("_r", F.col("ord")), ["_g"], "_r"))
    assert (r["price"], r["carpetArea"], r["amenities"], r["reraRegistered"]) == (8_000_000, 1200, ["Pool", "Gym"], False)


def test_exact_collapse_takes_the_densest(spark):
    rows = out(dedupe.exact(frame(spark, unit(0, amenities=["A"]), unit(1, amenities=["B"], carpetArea=1000, price=5), unit(2, bhk=2))))
    assert len(rows) == 2 and rows[0]["ord"] == 1 and rows[0]["amenities"] == ["B", "A"] and rows[0]["carpetArea"] == 1000


def test_soft_cluster(spark):
    [r] = out(dedupe.dedupe(frame(spark, unit(0, amenities=["Pool"]), unit(1, projectName="Gaurs Atulyam", carpetArea=1200, bathrooms=2))))
    assert r["carpetArea"] == 1200 and r["bathrooms"] == 2 and r["amenities"] == ["Pool"]


def test_soft_needs_a_locality(spark):
    assert dedupe.dedupe(frame(spark, unit(0, locality=None), unit(1, locality=None, projectName="Gaurs Atulyam"))).count() == 2


def test_soft_is_not_transitive(spark):
    rows = frame(spark, unit(0, projectName="Gaurs Atulayamxx", price=1, carpetArea=2), unit(1, projectName="Gaurs Atulayamx"), unit(2, projectName="Gaurs Atulayam"))
    plan = dedupe.soft(rows)
    assert plan.count() == len({0} | ({2} if not identity.soft_match("gaurs-atulayamxx", "gaurs-atulayam") else set()))


def test_null_area_goes_to_the_only_candidate(spark):
    assert dedupe.attach_null_areas(frame(spark, unit(0), unit(1, superBuiltUpArea=None, price=7))).count() == 1
    assert dedupe.attach_null_areas(frame(spark, unit(0), unit(1, superBuiltUpArea=1800), unit(2, superBuiltUpArea=None))).count() == 3


def test_sole_null_into_densest(spark):
    rows = out(dedupe.attach_sole_null(frame(spark, unit(0), unit(1, superBuiltUpArea=1800, price=9, carpetArea=3), unit(2, superBuiltUpArea=None, bathrooms=4))))
    assert [(r["ord"], r["bathrooms"]) for r in rows] == [(0, None), (1, 4)]


def test_tiers(spark):
    archive = frame(spark, unit(0), unit(1, projectName="Other Place", superBuiltUpArea=None), unit(2, projectName="Third Towers", sourceUrl="http://x/a/"))
    batch = frame(spark, unit(10), unit(11, projectName="Other Place"), unit(12, projectName="Gaurs Atulyam"), unit(13, projectName="New Name", city="Pune", sourceUrl="http://x/a"), unit(14, projectName="None of them", city="Pune"))
    got = {r["ord"]: (r["tier"], r["target"]) for r in merge.match_tiers(archive, batch).collect()}
    assert got == {10: (1, 0), 11: (2, 1), 12: (3, 0), 13: (5, 2)}


def test_null_counts_match(spark):
    got = merge.match_tiers(frame(spark, unit(0, bhk=None)), frame(spark, unit(5, bhk=None))).collect()
    assert [(r["tier"], r["target"]) for r in got] == [(1, 0)]


def test_upsert(spark):
    got = out(merge.upsert(frame(spark, unit(0)), frame(spark, unit(0, projectName="Gaurs Atulyam", carpetArea=1100, bathrooms=2, slug="b0"), unit(1, projectName="Brand New", slug="b1"), unit(2, projectName="Brand New", price=5, slug="b2"))))
    assert sorted((r["projectName"], r["_status"], r["carpetArea"], r["price"]) for r in got) == [("Brand New", "added", None, 5), ("Gaurs Atulayam", "updated", 1100, None)]


def test_empty_archive(spark):
    empty = frame(spark, unit(0)).limit(0)
    assert dedupe.dedupe(empty).count() == 0
    assert merge.upsert(empty, frame(spark, unit(1))).select("_status").collect()[0][0] == "added"
