"""Profile and repair of a bulk export."""

from __future__ import annotations


from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions import arrays as A
from ledgerloom.functions import lookups as L
from ledgerloom.functions import text as T
from ledgerloom.operators.schema import SCHEMA

NUMBERS = ("bhk", "bathrooms", "carpetArea", "builtUpArea", "superBuiltUpArea", "price", "latitude", "longitude", "maintenancePerMonth", "stampDuty", "registrationCharges", "propertyAge", "floor", "totalFloors", "totalUnits", "parkingSpaces")
TYPED = NUMBERS[:8]
HISTOGRAMS = ("city", "furnishing", "possessionStatus", "facing", "listingType", "status", "propertyType")


def violations(df: DataFrame) -> DataFrame:
    """(ord, field, rule, value, title): one row for each rule that a row breaks."""
    title = F.substring(F.coalesce(F.col("title"), F.lit("")), 1, 60) if "title" in df.columns else F.lit("")
    found = []
    broken = lambda name, rule, when, value: found.append(F.when(when, F.struct(F.lit(name).alias("field"), F.lit(rule).alias("rule"), value.cast("string").alias("value"))))
    for name in ("title", "city"):
        if name in df.columns:
            broken(name, "required", F.coalesce(F.col(name), F.lit("")) == "", F.col(name))
    for name, (allowed, optional) in L.ENUMS.items():
        if name in df.columns:
            x = F.col(name)
            broken(name, "enum", F.when(x.isNull(), F.lit(not optional)).otherwise(~x.isin(*allowed)), x)
    for name in TYPED:
        if dict(df.dtypes).get(name) == "string":
            x = F.col(name)
            broken(name, "number", x.isNotNull() & x.try_cast("double").isNull(), x)
    if "amenities" in df.columns:
        junk = F.filter(F.col("amenities"), lambda a: F.trim(a).rlike(r"(?i)^\+\s*\d+\s*more$"))
        broken("amenities", "junk", F.size(junk) > 0, F.array_join(junk, "|"))
    return df.select("ord", title.alias("title"), F.explode(F.array_compact(F.array(*found))).alias("v")).select("ord", "v.*", "title")


def counts(df: DataFrame) -> DataFrame:
    """Rows, rows without a price, rows without a locality."""
    price = F.col("price").cast("string")
    return df.agg(F.count(F.lit(1)).alias("row_count"), F.count_if(price.isNull() | price.isin("0", "")).alias("prices_null"), F.count_if(F.coalesce(F.col("locality"), F.lit("")) == "").alias("locality_null"))


def histograms(df: DataFrame, fields=HISTOGRAMS) -> DataFrame:
    """(field, value, rows) for every value of the fields, in one pass; NULL is 'None'."""
    own = [f for f in fields if f in df.columns]
    cells = F.array(*[F.struct(F.lit(f).alias("field"), F.coalesce(F.col(f).cast("string"), F.lit("None")).alias("value")) for f in own])
    return df.select(F.explode(cells).alias("c")).groupBy("c.field", "c.value").agg(F.count(F.lit(1)).alias("rows"))


def extra_keys(raw: DataFrame, column: str = "json") -> DataFrame:
    """(key, rows) of the keys of JSON rows that the schema does not have."""
    return raw.select(F.explode(F.json_object_keys(column)).alias("key")).where(~F.col("key").isin(*SCHEMA)).groupBy("key").agg(F.count(F.lit(1)).alias("rows"))


def repair(df: DataFrame, raw: bool = False) -> DataFrame:
    """Known aliases, numbers from text, clean amenities and images; columns outside the schema go.

    A text that is no number becomes NULL; with ``raw`` it is kept in a column <name>_raw.
    """
    fixes = {"city": T.bulk_city, "propertyType": T.bulk_type, "possessionStatus": T.bulk_possession}
    out = {n: f(n) for n, f in fixes.items() if n in df.columns}
    out |= {n: T.coerce_number(n) for n, k in df.dtypes if n in NUMBERS and k == "string"}
    if "amenities" in df.columns:
        out["amenities"] = F.when(F.col("amenities").isNotNull(), A.clean_amenities(F.col("amenities")))
    if "images" in df.columns:
        out["images"] = F.when(F.col("images").isNotNull(), A.images(F.transform("images", lambda x: F.struct(x["url"].alias("url"), x["type"].alias("type")))))
    lost = {f"{n}_raw": F.when(T.coerce_number(n).isNull(), F.col(n)) for n, k in df.dtypes if raw and n in NUMBERS and k == "string"}
    return df.withColumns(out | lost).select(*[c for c in df.columns if c in SCHEMA or c == "ord"], *lost)


def run_counters(events: DataFrame, site: str, outcomes: dict[str, str], outcome: str = "outcome") -> DataFrame:
    """Counters for each site, and for all of them as site 'TOTAL'; outcomes: column to value."""
    made = [F.count_if(F.col(outcome) == value).alias(name) for name, value in outcomes.items()]
    return events.rollup(site).agg(F.count(F.lit(1)).alias("events"), *made, F.grouping(site).alias("_all")).withColumn(site, F.when(F.col("_all") == 1, F.lit("TOTAL")).otherwise(F.col(site))).drop("_all")


def summary(df: DataFrame) -> DataFrame:
    """Rows and the first row's scrapedAt."""
    return df.agg(F.count(F.lit(1)).alias("count"), F.min_by("scrapedAt", "ord").alias("latest_scraped_at"))
