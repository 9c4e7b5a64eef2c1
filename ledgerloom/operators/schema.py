"""The 57 columns of a unit row, their defaults, and the checks of a row against them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions import arrays as A
from ledgerloom.functions import text as T

TEXT, LONG, BOOL, DOUBLE, LIST = "string", "bigint", "boolean", "double", "array<string>"
SCHEMA = {
    "title": TEXT, "slug": TEXT, "propertyType": TEXT, "listingType": TEXT, "status": TEXT, "projectName": TEXT, "developer": TEXT, "city": TEXT, "locality": TEXT, "pincode": TEXT,
    "address": TEXT, "description": TEXT, "featured": BOOL, "hotDeal": BOOL, "exclusive": BOOL, "bhk": LONG, "bathrooms": LONG, "carpetArea": LONG, "builtUpArea": LONG,
    "superBuiltUpArea": LONG, "propertyAge": LONG, "floor": LONG, "totalFloors": LONG, "totalUnits": LONG, "parkingSpaces": LONG, "parkingType": TEXT, "furnishing": TEXT,
    "possessionStatus": TEXT, "possessionDate": "date", "launchDate": "date", "facing": TEXT, "vastuCompliant": BOOL, "latitude": DOUBLE, "longitude": DOUBLE, "price": LONG,
    "maintenancePerMonth": LONG, "stampDuty": LONG, "registrationCharges": LONG, "reraNumber": TEXT, "reraState": TEXT, "reraRegistered": BOOL, "reraVerified": BOOL,
    "bankApprovals": LIST, "amenities": LIST, "overlooking": LIST, "images": f"array<{A.IMAGE}>", "seoTitle": TEXT, "seoDescription": TEXT, "seoKeywords": LIST, "h1": TEXT,
    "aboutSection": TEXT, "highlights": LIST, "locationAdvantages": TEXT, "whyInvest": TEXT, "whyConsider": TEXT, "addressSection": TEXT, "faqs": "array<struct<question: string, answer: string>>",
}
PROVENANCE = {"sourceUrl": TEXT, "sourceSite": TEXT, "sources": "array<struct<site: string, url: string>>", "scrapedAt": "timestamp"}
DEFAULTS = {"listingType": "BUY", "status": "ACTIVE"}


def conform(df: DataFrame, more: tuple[str, ...] = ()) -> DataFrame:
    """Exactly the schema's columns in order, then provenance, then ``more``; a missing column gets its default, a present NULL stays."""
    out = []
    for name, kind in (SCHEMA | PROVENANCE).items():
        if name not in df.columns:
            value = F.array().cast(kind) if kind.startswith("array") and name in SCHEMA else F.lit(DEFAULTS.get(name)).cast(kind)
        elif name == "images":
            urls = F.transform(F.col("imageUrls"), lambda u: F.struct(u.alias("url"), F.lit(None).cast("string").alias("type"))) if "imageUrls" in df.columns else None
            own = F.transform(F.col("images"), lambda x: F.struct(x["url"].alias("url"), x["type"].alias("type")))
            value = A.images(own if urls is None else F.concat(F.coalesce(own, F.array().cast("array<struct<url: string, type: string>>")), F.coalesce(urls, F.array().cast("array<struct<url: string, type: string>>"))))
        elif name == "amenities":
            value = A.clean_amenities(F.col(name))
        else:
            value = F.col(name).cast(kind)
        out.append(value.alias(name))
    ord_ = [F.col("ord")] if "ord" in df.columns else []
    return df.select(*ord_, *out, *more)


def public(df: DataFrame) -> DataFrame:
    """The export: no provenance, the catalogue's city names, mapped types and possession."""
    c = conform(df)
    return c.drop(*PROVENANCE).withColumns({"city": T.export_city("city"), "propertyType": T.map_property_type("propertyType"), "possessionStatus": T.map_possession("possessionStatus")})


def problems(df: DataFrame) -> Column:
    """What is wrong with a row's columns: missing ones, unknown ones, and the first image without a url."""
    missing = [F.lit(f"missing:{c}") for c in SCHEMA if c not in df.columns]
    extra = [F.lit(f"extra:{c}") for c in df.columns if c not in SCHEMA and c not in PROVENANCE and c not in ("imageUrls", "ord")]
    found = [*missing, *extra]
    types = dict(df.dtypes)
    found += [F.lit(f"not_array:{c}") for c, k in SCHEMA.items() if k.startswith("array") and c in types and not types[c].startswith("array")]
    if types.get("images", "").startswith("array<struct"):
        bad = F.filter(F.transform(F.col("images"), lambda x, i: F.when(F.coalesce(F.trim(x["url"]), F.lit("")) == "", i)), F.isnotnull)
        found.append(F.concat(F.lit("bad_image:"), F.try_element_at(bad, F.lit(1)).cast("string")))
    return F.array_compact(F.array(*found)) if found else F.array().cast(LIST)


def stamp(df: DataFrame, ts) -> DataFrame:
    """One scrapedAt for the whole batch."""
    return df.withColumn("scrapedAt", F.lit(ts).cast("timestamp"))


def with_source(df: DataFrame, site: str, url: str) -> DataFrame:
    """Provenance where it is missing, and the pair (site, url) among the sources."""
    pair = F.array(F.struct(F.lit(site).alias("site"), F.col(url).alias("url")))
    listed = F.coalesce(F.col("sources"), F.array().cast(PROVENANCE["sources"])) if "sources" in df.columns else F.array().cast(PROVENANCE["sources"])
    own = lambda name, value: F.coalesce(F.nullif(F.col(name), F.lit("")), value) if name in df.columns else value
    return df.withColumns({"sources": A.merge_sources(F.concat(listed, pair)), "sourceSite": own("sourceSite", F.lit(site)), "sourceUrl": own("sourceUrl", F.col(url))})


def backfill_sources(df: DataFrame, sites: dict[str, str]) -> DataFrame:
    """sourceSite and sources of old rows, from what their address tells; sites: site to host."""
    from ledgerloom.operators.identity import infer_site

    site, url = infer_site(sites, df.columns), F.trim(F.coalesce(F.col("sourceUrl"), F.lit("")))
    listed = F.coalesce(F.col("sources"), F.array().cast(PROVENANCE["sources"])) if "sources" in df.columns else F.array().cast(PROVENANCE["sources"])
    pair = F.when(site.isNotNull() & (url != ""), F.array(F.struct(site.alias("site"), url.alias("url")))).otherwise(F.array().cast(PROVENANCE["sources"]))
    own = F.nullif(F.trim(F.col("sourceSite")), F.lit("")) if "sourceSite" in df.columns else F.lit(None).cast("string")
    return df.withColumns({"sources": A.merge_sources(F.concat(listed, pair)), "sourceSite": F.coalesce(own, site)})


def select_listings(df: DataFrame, source=None, city=None, kind=None, possession=None, price=(None, None)) -> DataFrame:
    """Rows by source, city, type, possession and a price range; what is None does not filter."""
    for name, value in (("sourceSite", source), ("city", city), ("propertyType", kind), ("possessionStatus", possession)):
        df = df if value is None else df.where(F.col(name) == value)
    low, high = price
    df = df if low is None else df.where(F.col("price") >= low)
    return df if high is None else df.where(F.col("price") <= high)
