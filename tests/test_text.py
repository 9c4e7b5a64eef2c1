"""Scalar functions (N1-N24) on the inputs that their branches tell apart."""

import datetime

import pytest
from pyspark.sql import functions as F

from ledgerloom.functions import arrays as A
from ledgerloom.functions import text as T
from ledgerloom.functions import urls as U


def values(spark, column, inputs):
    rows = spark.createDataFrame([(i, x) for i, x in enumerate(inputs)], "i int, x string").select("i", column("x").alias("v")).collect()
    return [r["v"] for r in sorted(rows)]


CASES = [
    (T.clean_text, {" a \t b\n": "a b", " x y ": "x y", "  ": None, None: None}),
    (T.strip_decorative, {"✨ Grand — Park 🏠 ": "Grand — Park", "- x -": "x", "🏠": None}),
    (T.clean_rera_number, {"$undefined": None, "Applied": None, "RERA Reg No. X dated 1/2/20": "X", "rera no: AB/1.": "AB/1", None: None}),
    (T.slugify, {" Gaur City, 1st Ave. ": "gaur-city-1st-ave", "--": ""}),
    (T.normalize_city, {"GURUGRAM": "Gurgaon", "navi mumbai": "Navi Mumbai", "NCR": "NCR", "Greater Noida West": "Greater Noida West"}),
    (T.map_property_type, {"Flats": "Apartment", "sco-plot": "Sco-Plot", None: None}),
    (T.map_possession, {"Upcoming": "NEW_LAUNCH", "ready_to_move": "READY_TO_MOVE", "nearly-done": "NEARLY_DONE", " ": None}),
    (T.parse_bhk, {"2.5 BHK": 2, "Type 4": 4, "Studio": None, "3": 3, "2.5": 2}),
    (T.price_to_inr, {"Price on Request": None, "Call For Price today": None, "2.5 Cr": 25_000_000, "85 Lakh": 8_500_000, "1,25,00,000": 12_500_000, "999": 9_990_000_000, "1000": 1000, "": None}),
    (T.parse_area, {"1,500 sq ft": 1500, "3710-3763": None, "900 to 1100": None, "abc": None, "2.5": 2, "3.5": 4}),
    (T.parse_bathrooms, {"0": None, "3 baths": 3}),
    (T.extract_pincode, {"x 122001 y": "122001", "012345": None}),
    (T.derive_rera_state, {"MAHARERA/1": "Maharashtra", "HRERA-1": "Haryana", "x": None}),
    (T.is_registered_rera, {"Applied": False, "na": None, "GGM/1": True, None: None}),
    (lambda x: T.extract_city(x), {"near greater noida west": "Greater Noida", "new delhi road": "Delhi", "nowhere": None}),
    (lambda x: T.extract_locality(x), {"Plot 1, sector-16b, X": "Sector 16B", "none": None}),
    (T.bulk_city, {"NCR": "Delhi NCR", " Pune ": "Pune"}),
    (lambda x: T.about_section(x, 12), {"One. Two. Three.": "One. Two.", "short": "short"}),
    (U.sanitize_segment, {" A b--c! ": "a-b-c", None: "unknown"}),
    (U.extension, {"http://a/b.JPEG?x": ".jpg", "http://a/b.webp": ".webp", "http://a/b": ".jpg"}),
    (lambda x: U.project_url(x, "portal.example"), {"gaur-city": "https://www.portal.example/gaur-city/", "/blog/": None, "https://other.example/x/": None, "#top": None, "projects-in-delhi": None, "/abc?utm=1": "https://www.portal.example/abc/"}),
]


@pytest.mark.parametrize("k", range(len(CASES)))
def test_scalar(spark, k):
    column, cases = CASES[k]
    assert values(spark, column, list(cases)) == list(cases.values())


def test_dates(spark):
    day = datetime.date(2033, 8, 1)
    cases = {"2033-08-01T00:00:00.000Z": day, "2033-8-1": day, "Aug 2033": day, "august 2033": day, "5 Aug 2033": datetime.date(2033, 8, 5), "Aug 5, 2033": datetime.date(2033, 8, 5), "2033": None, "On Request": None, None: None}
    assert values(spark, T.parse_date, list(cases)) == list(cases.values())


def test_price_unit(spark):
    rows = spark.sql("select * from values ('2.5', 'cr'), ('2.5', 'lakh'), ('2500', cast(null as string)) as t(x, u)").select(T.price_to_inr("x", "u").alias("v")).collect()
    assert [r["v"] for r in rows] == [25_000_000, 250_000, 2500]


def test_coordinates(spark):
    rows = spark.sql("select * from values (28.4595D, 77.0266D), (28.459502D, 77.0266D), (null, 1D) as t(a, b)").select(T.sanitize_coords("a", "b").alias("p")).collect()
    assert [r["p"]["latitude"] for r in rows] == [None, 28.459502, None]


def test_arrays(spark):
    df = spark.createDataFrame([(["Gym", "gym ", "+21 More", "", None, "Pool"],), (None,)], "a array<string>")
    assert [r[0] for r in df.select(A.clean_amenities(F.col("a"))).collect()] == [["Gym", "Pool"], []]
    urls = spark.createDataFrame([(["u1", " u1", "u2", ""],)], "a array<string>").select(A.images_of_urls(F.col("a")).alias("i")).first()["i"]
    assert [(x["url"], x["type"], x["is_primary"], x["order"]) for x in urls] == [("u1", "EXTERIOR", True, 0), ("u2", "GALLERY", False, 1)]


def test_challenge(spark):
    df = spark.sql("select * from values ('Access Denied', 200), ('fine', 403), ('a listing page', 200), (null, cast(null as int)) as t(h, s)").select(T.is_challenge("h", "s").alias("v"))
    assert [r["v"] for r in df.collect()] == [True, True, False, False]
