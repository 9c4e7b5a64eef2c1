"""Audit of rows as they came: JSON of any shape, read as VARIANT, so wrong types are seen before a schema hides them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions import lookups as L
from ledgerloom.operators.quality import TYPED

#: Names of types in reports, by how the type of a VARIANT begins.
KINDS = {"STRING": "str", "ARRAY": "list", "OBJECT": "dict", "BOOLEAN": "bool", "BIGINT": "int", "DOUBLE": "float", "FLOAT": "float", "DECIMAL": "float", "VOID": "none"}
JUNK = r"(?i)^\+\s*\d+\s*more$"


def _kind(v: Column) -> Column:
    """str, list, dict, bool, int, float or none; a missing value is none."""
    shape = F.schema_of_variant(v)
    kind = F.lit("other")
    for begins, name in reversed(KINDS.items()):
        kind = F.when(F.startswith(shape, F.lit(begins)), F.lit(name)).otherwise(kind)
    return F.when(v.isNull(), F.lit("none")).otherwise(kind)


def _shown(v: Column, kind: Column, most: int = 80) -> Column:
    """A value as text: a text itself, else its JSON, the first characters."""
    text = F.when(kind == "str", F.try_variant_get(v, "$", "string")).otherwise(F.to_json(v))
    return F.substring(text, 1, most)


def audit(rows: DataFrame, column: str = "json") -> DataFrame:
    """(ord, field, rule, value, title), a row a violation, of rows (ord, ``column``) of JSON text.

    Rules: structure (no JSON, or no object), required, enum, number (a value that is neither number nor truth value), images (no
    list, and ``images[j]`` for the first element that is no object with an address), junk (each amenity like "+3 more"). A missing field is null. A text
    that is no JSON is a violation of structure; a null text is, too.
    """
    x = rows.select("ord", F.try_parse_json(column).alias("v"))
    get = lambda name: F.try_variant_get("v", f"$.{name}", "variant")
    fields = {n: get(n) for n in ("title", "city", *L.ENUMS, *TYPED, "images", "amenities")}
    x = x.select("ord", "v", _kind(F.col("v")).alias("_kind"), *[c.alias(n) for n, c in fields.items()])
    x = x.withColumns({f"{n}_kind": _kind(F.col(n)) for n in fields})
    kind = lambda n: F.col(f"{n}_kind")
    text = lambda n: F.when(kind(n) == "str", F.try_variant_get(n, "$", "string"))
    title = F.substring(F.coalesce(F.when(kind("title") != "none", _shown(F.col("title"), kind("title"), 60)), F.lit("")), 1, 60)
    found = []

    def broken(field, rule, when, value):
        field = F.lit(field) if isinstance(field, str) else field
        found.append(F.array(F.when(F.coalesce(when, F.lit(False)), F.struct(field.alias("field"), F.lit(rule).alias("rule"), value.alias("value")))))

    for n in ("title", "city"):
        bare = (kind(n) == "none") | (text(n) == "") | F.to_json(n).isin("0", "0.0", "false", "[]", "{}") & (kind(n) != "str")
        broken(n, "required", bare, F.when(kind(n) != "none", _shown(F.col(n), kind(n))))
    for n, (allowed, optional) in L.ENUMS.items():
        missing = F.lit(not optional)
        broken(n, "enum", F.when(kind(n) == "none", missing).otherwise(~F.coalesce(text(n).isin(*allowed), F.lit(False))), F.when(kind(n) != "none", _shown(F.col(n), kind(n))))
    for n in TYPED:
        broken(n, "number", ~kind(n).isin("none", "bool", "int", "float"), F.concat_ws(": ", kind(n), _shown(F.col(n), kind(n))))
    broken("images", "images", ~kind("images").isin("none", "list"), F.concat_ws(": ", kind("images"), _shown(F.col("images"), kind("images"))))
    each = F.try_variant_get("images", "$", "array<variant>")
    address = lambda v: F.try_variant_get(v, "$.url", "variant")
    held = lambda v: (_kind(v) == "dict") & ~F.coalesce(F.to_json(address(v)).isin('""', "null", "0", "0.0", "false", "[]", "{}"), F.lit(True))
    bad = F.filter(F.transform(F.when(kind("images") == "list", each), lambda v, j: F.struct(held(v).alias("ok"), j.alias("j"), F.substring(F.coalesce(F.to_json(v), F.lit("null")), 1, 80).alias("shown"))), lambda p: ~p["ok"])
    first = F.try_element_at(bad, F.lit(1))
    broken(F.concat(F.lit("images["), first["j"].cast("string"), F.lit("]")), "images", F.size(bad) > 0, first["shown"])
    junk = F.filter(F.transform(F.when(kind("amenities") == "list", F.try_variant_get("amenities", "$", "array<variant>")), lambda v: F.when(_kind(v) == "str", F.try_variant_get(v, "$", "string"))), lambda a: F.trim(a).rlike(JUNK))
    junk = F.transform(F.coalesce(junk, F.array().cast("array<string>")), lambda a: F.struct(F.lit("amenities").alias("field"), F.lit("junk").alias("rule"), a.alias("value")))
    structure = F.array(F.struct(F.lit("").alias("field"), F.lit("structure").alias("rule"), F.when(F.col("v").isNull(), F.lit("not_json")).otherwise(F.concat(F.lit("not_object:"), F.col("_kind"))).alias("value")))
    every = F.when(F.col("_kind") != "dict", structure).otherwise(F.concat(*found, junk))
    return x.select("ord", title.alias("title"), F.explode(F.filter(every, lambda v: v.isNotNull())).alias("_v")).select("ord", "_v.*", "title")
