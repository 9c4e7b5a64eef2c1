"""Listing-like views over the given tables, for the queries and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions import text as T
from ledgerloom.sources.tables import table

#: The same text serves both engines but for the name of the string type.
RAW = {
    "ord": "p_partkey",
    "project_raw": "p_name",
    "city_raw": "case p_partkey % 4 when 0 then 'gurugram' when 1 then ' Gurgaon ' when 2 then 'Bengaluru' else 'noida' end",
    "address_raw": "concat('Plot 7, sector-', cast(p_size % 9 as {S}), 'a, 1220', cast(10 + p_size as {S}))",
    "bhk_raw": "concat(cast(p_size % 4 + 1 as {S}), ' BHK')",
    "area_raw": "case when p_partkey % 7 = 0 then null else concat(cast((p_size % 3 + 1) * 500 as {S}), ' sq ft') end",
    "price_raw": "case p_partkey % 5 when 0 then null when 1 then 'Price on Request' when 2 then concat(cast(p_size as {S}), ' Cr') when 3 then concat(cast(p_size as {S}), ' Lakh') else cast(p_size * 100000 as {S}) end",
    "type_raw": "case p_partkey % 6 when 0 then 'Flats' when 1 then 'SCO Plots' when 2 then ' villa' when 3 then 'farm-house stay' when 4 then null else 'independent floor' end",
    "possession_raw": "case p_partkey % 6 when 0 then 'Under Construction' when 1 then 'new-launch' when 2 then 'Upcoming' when 3 then 'ready_to_move' when 4 then 'part ready' else '' end",
    "date_raw": "case p_partkey % 7 when 0 then concat('20', cast(10 + p_size as {S}), '-8-1') when 1 then concat('Aug 20', cast(10 + p_size as {S})) when 2 then concat('5 August 20', cast(10 + p_size as {S})) when 3 then 'On Request' when 4 then concat('20', cast(10 + p_size as {S}), '-08-01T00:00:00.000Z') when 5 then concat('20', cast(10 + p_size as {S})) else concat('Aug 5, 20', cast(10 + p_size as {S})) end",
    "rera_raw": "case p_partkey % 6 when 0 then '$undefined' when 1 then 'Applied' when 2 then concat('RERA Reg No. GGM/', cast(p_size as {S}), '/HARERA dated 1/2/20') when 3 then concat('MAHARERA/', cast(p_size as {S})) when 4 then concat('rera no: UPRERA', cast(p_size as {S}), ' .') else null end",
}


def raw_sql(string: str) -> str:
    return "select " + ", ".join(f"{e.format(S=string)} as {n}" for n, e in RAW.items()) + " from part"


def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").selectExpr(*[f"{e.format(S='string')} as {n}" for n, e in RAW.items()])


def units(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw(spark, sf_dir).select(
        "ord", F.col("project_raw").alias("projectName"), T.normalize_city("city_raw").alias("city"), T.extract_locality("address_raw").alias("locality"),
        T.parse_bhk("bhk_raw").alias("bhk"), T.parse_area("area_raw").alias("superBuiltUpArea"), T.price_to_inr("price_raw").alias("price"),
    )


SLUG = "regexp_replace(regexp_replace(lower(trim({x})), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g')"
CITY = "case lower(trim(city_raw)) when 'gurugram' then 'Gurgaon' when 'gurgaon' then 'Gurgaon' when 'bengaluru' then 'Bangalore' else 'Noida' end"
PRICE = "case when price_raw like '%Request' then null when price_raw like '%Cr' then cast(regexp_extract(price_raw, '[0-9]+') as bigint) * 10000000 when price_raw like '%Lakh' then cast(regexp_extract(price_raw, '[0-9]+') as bigint) * 100000 when cast(price_raw as bigint) < 1000 then cast(price_raw as bigint) * 10000000 else cast(price_raw as bigint) end"
UNITS = f"""raw as ({raw_sql("varchar")}), units as (select ord, project_raw as "projectName", {CITY} as city, 'Sector ' || upper(regexp_extract(address_raw, 'sector-([0-9]+a)', 1)) as locality,
    cast(regexp_extract(bhk_raw, '[0-9]+') as bigint) as bhk, cast(regexp_extract(area_raw, '[0-9]+') as bigint) as "superBuiltUpArea", {PRICE} as price from raw)"""
_K = {n: SLUG.format(x=f'coalesce("{c}", \'\')') for n, c in (("p", "projectName"), ("c", "city"), ("l", "locality"))}
TOKENS = f"{_K['c']} || '|' || {_K['l']} || '|' || coalesce(cast(bhk as varchar), 'None')"
AREA = "coalesce(cast(\"superBuiltUpArea\" as varchar), '')"
STRICT, LOOSE = f"{_K['p']} || '|' || {TOKENS} || '|' || {AREA}", f"{_K['p']} || '|' || {TOKENS}"
FULL = "(1 + least(length(\"projectName\"), 200) // 50) + (1 + least(length(city), 200) // 50) + (1 + least(length(locality), 200) // 50) + 1 + (case when \"superBuiltUpArea\" is null then 0 else 1 end) + (case when price is null then 0 else 1 end)"
KEYED = f"{UNITS}, keyed as (select *, {STRICT} as match_key, {LOOSE} as loose_key, {TOKENS} || '|' || {AREA} as signature, {FULL} as fullness from units)"
