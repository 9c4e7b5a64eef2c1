"""The engine's queries over the given tables, each with its SQL where SQL can tell the same."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerloom.functions import arrays as A
from ledgerloom.functions import text as T
from ledgerloom.functions import urls as U
from ledgerloom.operators import audit, dedupe, discover, identity, media, merge, quality, schema
from ledgerloom.plans import views as V
from ledgerloom.sources import html
from ledgerloom.sources.tables import table
from ledgerloom.streaming import limiter

QUERIES: dict = {}
ORACLES: dict[str, str] = {}
BUCKET, REGION = "media-store", "ap-south-1"


def query(oracle: str | None = None):
    def keep(f):
        QUERIES[f.__name__] = f
        if oracle:
            ORACLES[f.__name__] = oracle
        return f

    return keep


def scalar(name: str, column, sql: str):
    """A query of one scalar function over the raw view: ord and value."""
    QUERIES[name] = lambda spark, sf_dir: V.raw(spark, sf_dir).select("ord", column().alias("value"))
    ORACLES[name] = f"with raw as ({V.raw_sql('varchar')}) select ord, {sql} as value from raw"


_TITLE = "case type_raw when 'Flats' then 'Apartment' when 'SCO Plots' then 'SCO' when ' villa' then 'Villa' when 'farm-house stay' then 'Farm-House Stay' when 'independent floor' then 'Independent Floor' end"
_RERA = "case ord % 6 when 2 then 'GGM/' || regexp_extract(rera_raw, 'GGM/([0-9]+)', 1) || '/HARERA' when 3 then rera_raw when 4 then regexp_extract(rera_raw, 'UPRERA[0-9]+') end"
_ISO = "cast(regexp_extract(date_raw, '20[0-9]+') as varchar)"
scalar("n01_clean_text", lambda: T.clean_text(F.concat(F.lit(" \t"), "city_raw", F.lit("\n\n x "))), "trim(city_raw) || ' x'")
scalar("n02_strip_decorative", lambda: T.strip_decorative(F.concat(F.lit("★ - "), "project_raw", F.lit(" – "))), "project_raw")
scalar("n03_clean_rera", lambda: T.clean_rera_number("rera_raw"), _RERA)
scalar("n04_slugify", lambda: T.slugify("address_raw"), V.SLUG.format(x="address_raw"))
scalar("n05_normalize_city", lambda: T.normalize_city("city_raw"), V.CITY)
scalar("n06_export_city", lambda: T.export_city(F.when(F.col("ord") % 3 == 0, F.lit(" New  Delhi")).otherwise(F.col("city_raw"))), "case when ord % 3 = 0 then 'Delhi NCR' else trim(city_raw) end")
scalar("n09_property_type", lambda: T.map_property_type("type_raw"), _TITLE)
scalar("n10_possession", lambda: T.map_possession("possession_raw"), "case ord % 6 when 0 then 'UNDER_CONSTRUCTION' when 1 then 'NEW_LAUNCH' when 2 then 'NEW_LAUNCH' when 3 then 'READY_TO_MOVE' when 4 then 'PART_READY' end")
scalar("n11_possession_date", lambda: F.date_format(T.parse_date("date_raw"), "yyyy-MM-dd"), "case ord % 7 when 0 then replace(date_raw, '-8-1', '-08-01') when 1 then right(date_raw, 4) || '-08-01' when 2 then right(date_raw, 4) || '-08-05' when 4 then left(date_raw, 10) when 6 then right(date_raw, 4) || '-08-05' end")
scalar("n12_parse_bhk", lambda: T.parse_bhk("bhk_raw"), "cast(regexp_extract(bhk_raw, '[0-9]+') as bigint)")
scalar("n13_price_to_inr", lambda: T.price_to_inr("price_raw"), V.PRICE)
scalar("n14_parse_area", lambda: T.parse_area(F.when(F.col("ord") % 3 == 0, F.lit("900 to 1100 sq ft")).otherwise(F.col("area_raw"))), "case when ord % 3 = 0 then null else cast(regexp_extract(area_raw, '[0-9]+') as bigint) end")
scalar("n15_parse_bathrooms", lambda: T.parse_bathrooms(F.concat((F.col("ord") % 4).cast("string"), F.lit(" baths"))), "nullif(ord % 4, 0)")
scalar("n17_locality", lambda: T.extract_locality("address_raw"), "'Sector ' || upper(regexp_extract(address_raw, 'sector-([0-9]+a)', 1))")
scalar("n18_pincode", lambda: T.extract_pincode("address_raw"), "nullif(regexp_extract(address_raw, '\\b[1-9][0-9]{5}\\b'), '')")
scalar("n19_city_in_text", lambda: T.extract_city("address_raw", "city_raw"), "case trim(city_raw) when 'gurugram' then 'Gurgaon' when 'Gurgaon' then 'Gurgaon' when 'Bengaluru' then 'Bangalore' else 'Noida' end")
scalar("n20_rera_state", lambda: T.derive_rera_state("rera_raw"), "case ord % 6 when 2 then 'Haryana' when 3 then 'Maharashtra' when 4 then 'Uttar Pradesh' end")
scalar("n21_rera_registered", lambda: T.is_registered_rera("rera_raw"), "case ord % 6 when 1 then false when 2 then true when 3 then true when 4 then true end")
scalar("n22_address", lambda: T.build_address("project_raw", T.extract_locality("address_raw"), "address_raw", "city_raw", T.extract_pincode("address_raw")), "'Sector ' || upper(regexp_extract(address_raw, 'sector-([0-9]+a)', 1)) || ', ' || address_raw || case trim(city_raw) when 'gurugram' then ', Gurugram, Haryana' when 'Gurgaon' then ', Gurugram, Haryana' when 'Bengaluru' then ', Bangalore' else ', Noida' end")
scalar("n23_coerce_number", lambda: T.coerce_number(F.concat(F.lit("1,"), F.lpad((F.col("ord") % 1000).cast("string"), 3, "0"))), "1000 + ord % 1000 + 0.0::double")
scalar("n24_bulk_city", lambda: T.bulk_city("city_raw"), "case trim(city_raw) when 'gurugram' then 'Gurgaon' else trim(city_raw) end")
scalar("n33_seo_keywords", lambda: F.array_join(T.seo_keywords("project_raw", T.normalize_city("city_raw"), F.lit(None), T.parse_bhk("bhk_raw"), F.lit("Apartment")), "; "), f"project_raw || ' ' || {V.CITY} || '; Luxury Apartments ' || {V.CITY} || '; ' || bhk_raw || ' ' || {V.CITY}")
scalar("n41_title", lambda: T.join_title("project_raw", "area_raw", "bhk_raw"), "concat_ws(' - ', project_raw, area_raw, bhk_raw)")
scalar("u04_segment", lambda: U.sanitize_segment("address_raw"), "regexp_replace(regexp_replace(lower(trim(address_raw)), '[^a-z0-9._-]+', '-', 'g'), '^[-._]+|[-._]+$', '', 'g')")

scalar("n34_page_title", lambda: T.page_title(F.when(F.col("ord") % 2 == 0, F.concat(F.col("project_raw"), F.lit(" flats | Portal One"))), "portal one", "project_raw", F.lit("Sector 1"), F.lit("Noida"), F.lit(None)), "case when ord % 2 = 0 then project_raw || ' flats' else project_raw || ' Sector 1 Noida | Luxury Apartments' end")
scalar("n35_page_heading", lambda: T.page_heading(F.lit(None).cast("string"), "project_raw", F.lit(None).cast("string"), F.lit("Noida"), T.parse_bhk("bhk_raw"), F.when(F.col("ord") % 2 == 0, F.array(F.lit(4), F.lit(3), F.lit(4))).otherwise(F.array(F.lit(2)))), "project_raw || ' Noida \u2014 Luxury ' || case when ord % 2 = 0 then '3 & 4' else regexp_extract(bhk_raw, '[0-9]+') end || ' BHK Residences'")
scalar("n38_address_section", lambda: T.address_section("project_raw", "address_raw", F.array(F.lit("Near a park"), F.lit("Metro at 1 km"))), "project_raw || ', ' || address_raw || '. Nearest transit: Metro at 1 km.'")
scalar("p12_soft_error", lambda: T.is_soft_error(F.concat(F.lit("status "), (F.col("ord") % 5 + 402).cast("string"))), "ord % 5 in (1, 4)")
scalar("p07_reserved_slug", lambda: U.is_non_project_slug(F.when(F.col("ord") % 3 == 0, F.lit("Contact-us")).when(F.col("ord") % 3 == 1, F.lit("new-projects-in-pune")).otherwise(T.slugify("project_raw"))), "ord % 3 < 2")
_LINK = "concat('https://cdn', cast(ord % 4 as {S}), '.example.com/a/', cast(ord as {S}), case ord % 3 when 0 then '.JPEG?x=1' when 1 then '.webp' else '' end)"
_link = lambda: F.expr(_LINK.format(S="string"))
_SQL = _LINK.format(S="varchar")
scalar("u01_project_url", lambda: U.project_url(F.when(F.col("ord") % 3 == 0, T.slugify("project_raw")).when(F.col("ord") % 3 == 1, F.concat(F.lit("/blog/"), T.slugify("project_raw"))).otherwise(F.concat(F.lit("https://www.portal.example/"), T.slugify("project_raw"), F.lit("?x=1"))), "portal.example"), "case when ord % 3 = 1 then null else 'https://www.portal.example/' || " + V.SLUG.format(x="project_raw") + " || '/' end")
scalar("u02_with_slash", lambda: U.with_slash(_link()), _SQL + " || '/'")
scalar("u05_extension", lambda: U.extension(_link()), "case ord % 3 when 1 then '.webp' else '.jpg' end")
_HEADER = "case ord % 4 when 0 then 'image/png; charset=x' when 1 then 'application/x-none' when 2 then 'image/x-odd' else null end"
scalar("u05_extension_by_header", lambda: U.extension(_link(), F.expr(_HEADER)), "case when ord % 3 = 1 then '.webp' when ord % 3 = 0 then '.jpg' when ord % 4 = 0 then '.png' else '.jpg' end")
scalar("u06_content_type_by_header", lambda: U.content_type(U.extension(_link()), F.expr(_HEADER)), "case ord % 4 when 0 then 'image/png' when 2 then 'image/x-odd' else case ord % 3 when 1 then 'image/webp' else 'image/jpeg' end end")
scalar("u06_content_type", lambda: U.content_type(U.extension(_link())), "case ord % 3 when 1 then 'image/webp' else 'image/jpeg' end")
scalar("u07_object_key", lambda: U.object_key(F.lit("f"), _link()), "'properties/f/' || left(sha256(" + _SQL + "), 16) || case ord % 3 when 1 then '.webp' else '.jpg' end")
scalar("u10_file_name", lambda: U.file_name(_link()), "cast(ord as varchar) || case ord % 3 when 0 then '.JPEG' when 1 then '.webp' else '.jpg' end")
scalar("p11_host_allowed", lambda: U.host_allowed(_link(), ["cdn1.example.com", "other.example"]), "ord % 4 = 1")
scalar("p09_host_contains", lambda: U.host_contains(_link(), "cdn2"), "ord % 4 = 2")
scalar("n25_markers", lambda: identity.guard_key(T.slugify(F.concat(F.col("project_raw"), F.lit(" Phase II 2nd Avenue")))), "split_part(" + V.SLUG.format(x="project_raw") + ", '-', 1) || '|2nd|phase,ii'")
scalar("n24_bulk_type", lambda: T.bulk_type("type_raw"), "case when trim(type_raw) = 'SCO Plots' then 'SCO' else trim(type_raw) end")
scalar("n24_bulk_possession", lambda: T.bulk_possession("possession_raw"), "case ord % 6 when 0 then 'UNDER_CONSTRUCTION' when 1 then 'NEW_LAUNCH' when 2 then 'NEW_LAUNCH' when 3 then 'READY_TO_MOVE' when 4 then 'PART_READY' else null end")
scalar("u03_listing_category", lambda: U.listing_category(F.concat(F.lit("https://x.example/Projects/"), F.when(F.col("ord") % 3 == 0, F.lit("commercial/")).when(F.col("ord") % 3 == 1, F.lit("Residential")).otherwise(F.lit("other")))), "case ord % 3 when 0 then 'commercial' when 1 then 'residential' end")
scalar("u11_decoded", lambda: U.decoded(F.concat(F.lit("a%20b%2F"), F.col("ord").cast("string"))), "'a b/' || cast(ord as varchar)")


@query("select p_partkey as ord, case p_partkey % 3 when 0 then 'one' when 1 then 'two' end as site from part")
def n31_infer_site(spark, sf_dir):
    host = F.when(F.col("ord") % 3 == 0, F.lit("https://www.one.example/a")).when(F.col("ord") % 3 == 1, F.lit("http://two.example/b"))
    rows = V.raw(spark, sf_dir).select("ord", host.alias("sourceUrl"))
    return schema.backfill_sources(rows, {"one": "one.example", "two": "two.example"}).select("ord", F.col("sourceSite").alias("site"))


@query(f"with {V.KEYED}, f as (select match_key, min(ord) as first_ord, max(ord) as ord from keyed group by match_key) select first_ord, ord from f")
def w03_latest_of_each(spark, sf_dir):
    return dedupe.latest_of_each(V.units(spark, sf_dir)).select("first_ord", "ord")


@query(f"with {V.UNITS} select ord, price from units where city = 'Noida' and price >= 1000000 and price <= 50000000")
def p17_select_listings(spark, sf_dir):
    return schema.select_listings(V.units(spark, sf_dir), city="Noida", price=(1_000_000, 50_000_000)).select("ord", "price")


@query("select cast(count(*) as bigint) as count, min(p_partkey) as first from part")
def a17_summary(spark, sf_dir):
    rows = V.raw(spark, sf_dir).select("ord", F.col("ord").alias("scrapedAt"))
    return quality.summary(rows).select("count", F.col("latest_scraped_at").alias("first"))


@query("with s as (select distinct regexp_replace(url, '/+$', '') as b from pages) select b as url from s union select b || '/' from s")
def t05_both_forms(spark, sf_dir):
    return discover.both_forms(table(spark, sf_dir, "pages").select("url"))


@query()
def n16_coordinates(spark, sf_dir):
    raw = V.raw(spark, sf_dir)
    lat = F.when(F.col("ord") % 3 == 0, F.lit(28.4595)).when(F.col("ord") % 3 == 1, F.lit(28.4595 + 2e-6)).otherwise(F.lit(None).cast("double"))
    return raw.select("ord", T.sanitize_coords(lat, F.lit(77.0266)).alias("p")).select("ord", F.col("p.latitude").isNotNull().alias("has_latitude"), F.col("p.longitude").isNotNull().alias("has_longitude"))


ORACLES["n16_coordinates"] = "select p_partkey as ord, p_partkey % 3 = 1 as has_latitude, p_partkey % 3 = 1 as has_longitude from part"


@query(f"""with {V.KEYED}, r as (select *, row_number() over (partition by match_key order by fullness desc, ord) as rank from keyed)
    select match_key, arg_min(ord, rank) as ord, arg_min(price, rank) filter (where price is not null) as price, cast(count(*) as bigint) as n from r group by match_key""")
def consolidate_units_strict(spark, sf_dir):
    """The flagship: null-fill consolidation of units by their strict key, the richest row first."""
    u = V.units(spark, sf_dir)
    return merge.null_fill(u.withColumns({"match_key": identity.match_key(), "_rank": dedupe.richest_first(u)}), ["match_key"], "_rank").select("match_key", "ord", "price", F.col("_rows").alias("n"))


@query(f"with {V.KEYED} select ord, match_key, loose_key, signature, cast(fullness as bigint) as fullness from keyed")
def identity_keys(spark, sf_dir):
    u = V.units(spark, sf_dir)
    return u.select("ord", identity.match_key().alias("match_key"), identity.match_key(loose=True).alias("loose_key"), identity.unit_signature().alias("signature"), identity.fullness(u).alias("fullness"))


@query(f"with {V.KEYED} select match_key, cast(count(*) as bigint) as rows from keyed group by 1 having count(*) > 1")
def duplicate_key_groups(spark, sf_dir):
    return dedupe.duplicate_groups(V.units(spark, sf_dir))


@query(f"""with {V.KEYED}, r as (select *, row_number() over (partition by match_key order by fullness desc, ord) as rank from keyed)
    select arg_min(ord, rank) as ord, arg_min("projectName", rank) as "projectName", arg_min(city, rank) as city, arg_min(locality, rank) as locality, arg_min(bhk, rank) as bhk,
           arg_min("superBuiltUpArea", rank) filter (where "superBuiltUpArea" is not null) as "superBuiltUpArea", arg_min(price, rank) filter (where price is not null) as price from r group by match_key""")
def dedupe_exact(spark, sf_dir):
    return dedupe.exact(V.units(spark, sf_dir))


@query(f"""with {V.KEYED}, w as (select *, count(*) filter (where "superBuiltUpArea" is null) over p as nulls, count("superBuiltUpArea") over p as sized from keyed window p as (partition by loose_key)),
    t as (select ord, loose_key, row_number() over (partition by loose_key order by fullness desc, ord) as k from keyed where "superBuiltUpArea" is not null),
    s as (select w.loose_key, w.ord as src, t.ord as dst, w.price as src_price from w join t on t.loose_key = w.loose_key and t.k = 1 where w."superBuiltUpArea" is null and nulls = 1 and sized > 0)
    select k.ord, "projectName", city, locality, bhk, "superBuiltUpArea", coalesce(k.price, s.src_price) as price from keyed k left join s on s.dst = k.ord where k.ord not in (select src from s)""")
def dedupe_sole_null(spark, sf_dir):
    return dedupe.attach_sole_null(V.units(spark, sf_dir))


def drifted(spark, sf_dir):
    """Units some of whose project names lack an inner letter."""
    u = V.units(spark, sf_dir)
    name = F.col("projectName")
    return u.withColumn("projectName", F.when((F.col("ord") % 11 == 0) & (F.length(name) > 8), F.concat(F.substring(name, 1, 3), F.expr("substring(projectName, 5)"))).otherwise(name))


@query()
def dedupe_soft(spark, sf_dir):
    return dedupe.soft(dedupe.exact(drifted(spark, sf_dir)))


@query()
def dedupe_null_areas(spark, sf_dir):
    return dedupe.attach_null_areas(dedupe.exact(V.units(spark, sf_dir)))


@query()
def dedupe_full(spark, sf_dir):
    return dedupe.dedupe(drifted(spark, sf_dir))


def _split(spark, sf_dir):
    u = V.units(spark, sf_dir).withColumn("slug", T.slugify(F.concat_ws("-", "projectName", "ord")))
    return u.where("ord % 5 != 0"), u.where("ord % 5 = 0")


@query(f"""with {V.KEYED} select b.ord, (select a.ord from keyed a where a.ord % 5 <> 0 and a.match_key = b.match_key order by a.fullness desc, a.ord limit 1) as target from keyed b
    where b.ord % 5 = 0 and exists (select 1 from keyed a where a.ord % 5 <> 0 and a.match_key = b.match_key)""")
def match_strict(spark, sf_dir):
    archive, batch = _split(spark, sf_dir)
    return merge.match_tiers(archive, batch, tiers=(1,)).select("ord", "target")


@query(f"""with {V.KEYED}, b as (select * from keyed where ord % 5 = 0), a as (select * from keyed where ord % 5 <> 0),
    s as (select distinct b.ord from a join b using (match_key)), l as (select b.ord, min(a.ord) as target, count(*) as n from a join b using (loose_key) where a."superBuiltUpArea" is null or b."superBuiltUpArea" is null group by b.ord)
    select ord, target from l where n = 1 and ord not in (select ord from s)""")
def match_loose_unique(spark, sf_dir):
    archive, batch = _split(spark, sf_dir)
    return merge.match_tiers(archive, batch, tiers=(1, 2)).where("tier = 2").select("ord", "target")


@query()
def match_tiered(spark, sf_dir):
    archive, batch = _split(spark, sf_dir)
    return merge.match_tiers(archive, batch)


@query()
def upsert_batch(spark, sf_dir):
    archive, batch = _split(spark, sf_dir)
    return merge.upsert(archive, batch)


_PAGES = "select page_id, regexp_replace(regexp_replace(lower(url), '[?#].*$', ''), '/+$', '') as url_key from pages"


@query(f"with p as ({_PAGES}), k as (select distinct url_key from p where page_id % 3 = 0) select page_id, url_key from p where url_key not in (select url_key from k)")
def known_url_anti_join(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    known = pages.where("page_id % 3 = 0").select(U.with_slash(F.regexp_replace("url", r"[?#].*$", "")).alias("sourceUrl"))
    return discover.new_urls(pages.select("page_id", "url"), discover.known_urls(known)).select("page_id", "url_key")


@query("select page_id, url, site from (select page_id, url, regexp_extract(url, '^https?://([^/?#]+)', 1) as site, row_number() over (partition by regexp_extract(url, '^https?://([^/?#]+)', 1) order by page_id) as n from pages) where n <= 3")
def per_site_cap(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", "url", U.part("url", "HOST").alias("site"))
    return discover.cap(pages, "site", 3, "page_id")


@query("with recursive f(node, depth) as (select 1::bigint, 0 union select e.dst, f.depth + 1 from f join (select l_partkey as src, (l_partkey * 7 + l_linenumber) % 500 as dst from lineitem where l_partkey < 500) e on e.src = f.node where f.depth < 3) select node, min(depth) as depth from f group by node")
def frontier(spark, sf_dir):
    links = table(spark, sf_dir, "lineitem").selectExpr("l_partkey as src", "(l_partkey * 7 + l_linenumber) % 500 as dst")
    return discover.frontier(links, spark.sql("select 1L as node"), 3)


_CRAWL = """links as (select distinct l_orderkey as page, l_partkey as next from lineitem), finds as (select distinct l_orderkey as page, l_suppkey as item from lineitem),
    seeds as (select n_nationkey as seed, n_nationkey * 7 + 1 as page from nation), adj as (select page, list(next order by next) as kids from links group by page)"""


@query(f"""with recursive {_CRAWL}, st(seed, visited, queue, n) as (
        select seed, []::bigint[], [page::bigint], 0 from seeds
        union all select seed, list_append(visited, queue[1]), list_concat(queue[2:], list_filter(coalesce(kids, []), lambda x: not list_contains(visited, x) and not list_contains(queue, x))), n + 1 from st left join adj on adj.page = queue[1] where len(queue) > 0 and n < 30),
    done as (select seed, arg_max(visited, n) as visited from st group by seed), v as (select seed, visited, unnest(range(1, len(visited) + 1)) as visit from done),
    own as (select seed, item, min(visit) as visit from v join finds on finds.page = visited[visit] group by seed, item),
    f as (select *, row_number() over (partition by item order by seed, visit) as k from own)
    select item, seed::bigint as seed, visit::bigint as visit, row_number() over (order by seed, visit, item) as rank from f where k = 1""")
def crawl_with_budget(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    seeds = table(spark, sf_dir, "nation").selectExpr("n_nationkey as seed", "n_nationkey * 7 + 1 as page")
    return discover.crawl(lines.selectExpr("l_orderkey as page", "l_partkey as next"), lines.selectExpr("l_orderkey as page", "l_suppkey as item"), seeds)


_SEEDS = "select page_id as ord, case page_id % 3 when 0 then 'residential' else 'commercial' end as category, case page_id % 4 when 0 then url || '?page=2' when 1 then url || '/' else url end as url from pages"


@query(f"""with s as ({_SEEDS}), b as (select regexp_replace(regexp_replace(url, '[?#].*$', ''), '/+$', '') as bare, nullif(regexp_extract(url, '[?]([^#]*)', 1), '') as q from s where category = 'commercial')
    select bare as url from b union select bare || '/' from b union select bare || '?' || q from b where q is not null union select bare || '/?' || q from b where q is not null""")
def seed_forms(spark, sf_dir):
    table(spark, sf_dir, "pages").createOrReplaceTempView("pages")
    return discover.seed_forms(discover.seeds_of(spark.sql(_SEEDS), "commercial"))


@query(f"""with s as ({_SEEDS}), b as (select distinct regexp_replace(regexp_replace(url, '[?#].*$', ''), '/+$', '') as bare from s where category = 'residential')
    select page_id, url from pages where regexp_replace(regexp_replace(url, '[?#].*$', ''), '/+$', '') not in (select bare from b)""")
def without_seeds(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    pages.createOrReplaceTempView("pages")
    return discover.without_seeds(pages, discover.seeds_of(spark.sql(_SEEDS), " Residential "))


_LADDERS = "select l_orderkey, l_linenumber, l_partkey, l_suppkey, 'u' || cast(l_partkey % 2 as {S}) || case when l_linenumber % 3 = 0 then '-2' else '' end as name, case when l_suppkey % 2 = 0 then 'u' || cast(l_partkey % 2 as {S}) || '-sized' end as sized from lineitem"


@query(f"""with recursive l as ({_LADDERS.format(S="varchar")}), n as (select *, row_number() over (partition by l_orderkey order by l_linenumber, l_partkey, l_suppkey) as k from l),
    f(l_orderkey, k, taken) as (
        select l_orderkey, 0, []::varchar[] from (select distinct l_orderkey from n)
        union all select f.l_orderkey, f.k + 1, list_append(taken, case when not list_contains(taken, name) then name when sized is not null and not list_contains(taken, sized) then sized
            else list_filter(list_transform(range(2, len(taken) + 3), lambda x: coalesce(sized, name) || '-' || x::varchar), lambda y: not list_contains(taken, y))[1] end)
        from f join n on n.l_orderkey = f.l_orderkey and n.k = f.k + 1)
    select l_orderkey, array_to_string(arg_max(taken, k), '|') as names from f group by l_orderkey""")
def running_names(spark, sf_dir):
    table(spark, sf_dir, "lineitem").createOrReplaceTempView("lineitem")
    rows = spark.sql(_LADDERS.format(S="string"))
    ladder = F.array_compact(F.array("name", "sized"))
    lists = rows.groupBy("l_orderkey").agg(F.transform(F.sort_array(F.collect_list(F.struct("l_linenumber", "l_partkey", "l_suppkey", ladder.alias("ladder")))), lambda x: x["ladder"]).alias("ladders"))
    return lists.select("l_orderkey", F.array_join(A.running_names(F.col("ladders")), "|").alias("names"))


@query("select page_id, url_key from (select *, row_number() over (partition by url_key order by page_id) as n from (" + _PAGES + ")) where n = 1")
def ordered_distinct(spark, sf_dir):
    return discover.first_of_each(table(spark, sf_dir, "pages").select("page_id", U.url_key("url").alias("url_key")), "url_key", "page_id")


_NAMES = "select l_orderkey, l_linenumber, l_partkey, case when l_linenumber % 5 = 0 then '+21 More' when l_linenumber % 3 = 0 then upper(p_name) when l_linenumber % 3 = 1 then lower(p_name) else concat(' ', p_name, '  ') end as name from lineitem join part on p_partkey = l_partkey"


def _lists(spark, sf_dir):
    table(spark, sf_dir, "lineitem").createOrReplaceTempView("lineitem")
    table(spark, sf_dir, "part").createOrReplaceTempView("part")
    rows = spark.sql(_NAMES)
    return rows.groupBy("l_orderkey").agg(F.transform(F.sort_array(F.collect_list(F.struct("l_linenumber", "l_partkey", "name"))), lambda x: x["name"]).alias("names"))


@query(f"""with n as (select l_orderkey, row_number() over (partition by l_orderkey order by l_linenumber, l_partkey) as k, trim(name) as name from ({_NAMES}) where name not like '+%'),
    d as (select *, row_number() over (partition by l_orderkey, lower(name) order by k) as r from n)
    select o.l_orderkey, coalesce(string_agg(name, '|' order by k), '') as names from (select distinct l_orderkey from lineitem) o left join d on d.l_orderkey = o.l_orderkey and r = 1 group by o.l_orderkey""")
def amenities_ci_distinct(spark, sf_dir):
    return _lists(spark, sf_dir).select("l_orderkey", F.array_join(A.clean_amenities(F.col("names")), "|").alias("names"))


@query("""with i as (select l_orderkey, 'http://img/' || cast(l_partkey % 9 as varchar) as url, min(l_linenumber) as k from lineitem group by 1, 2),
    o as (select *, row_number() over (partition by l_orderkey order by k, url) - 1 as n from i)
    select l_orderkey, string_agg(url || ':' || case when n = 0 then 'EXTERIOR' else 'GALLERY' end || ':' || cast(n as varchar), '|' order by n) as images from o group by 1""")
def images_renumber(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").selectExpr("l_orderkey", "l_linenumber", "concat('http://img/', cast(l_partkey % 9 as string)) as url")
    lists = rows.groupBy("l_orderkey").agg(F.transform(F.sort_array(F.collect_list(F.struct("l_linenumber", "url"))), lambda x: x["url"]).alias("urls"))
    shown = F.transform(A.images_of_urls(F.col("urls")), lambda x: F.concat_ws(":", x["url"], x["type"], x["order"].cast("string")))
    return lists.select("l_orderkey", F.array_join(shown, "|").alias("images"))


_MEDIA = """q as (select o_orderkey as ord, l_linenumber as line, case when l_partkey % 10 = 0 then 'https://media-store.s3.ap-south-1.amazonaws.com/k.jpg' else 'https://cdn.example.com/p/' || cast(l_partkey as varchar) || '.jpeg?w=1' end as url,
    o_orderpriority as p from orders join lineitem on l_orderkey = o_orderkey), m as (select *, row_number() over (partition by ord order by line, url) as pos from q), f as (select *, url like 'https://media-store%' as own from m),
    n as (select *, case when not own then row_number() over (partition by url, own order by ord, pos) end as nth from f)"""


def _gallery(spark, sf_dir):
    items = table(spark, sf_dir, "lineitem").selectExpr("l_orderkey", "l_linenumber", "case when l_partkey % 10 = 0 then 'https://media-store.s3.ap-south-1.amazonaws.com/k.jpg' else concat('https://cdn.example.com/p/', cast(l_partkey as string), '.jpeg?w=1') end as url")
    image = lambda x, i: F.struct(x["url"].alias("url"), F.lit("GALLERY").alias("type"), (i == 0).alias("is_primary"), i.cast("int").alias("order"))
    lists = items.groupBy("l_orderkey").agg(F.transform(F.sort_array(F.collect_list(F.struct("l_linenumber", "url"))), image).alias("images"))
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("ord"), F.col("o_orderpriority").alias("projectName"))
    blank = {"city": F.lit("Pune"), "locality": F.lit(None).cast("string"), "bhk": F.lit(2).cast("long"), "superBuiltUpArea": F.lit(None).cast("long")}
    return orders.join(lists, F.col("ord") == F.col("l_orderkey")).drop("l_orderkey").withColumns(blank)


@query(f"with {_MEDIA} select cast(count(distinct ord) as bigint) as records_touched, cast(count(*) as bigint) as urls_seen, cast(count(*) filter (where nth = 1) as bigint) as urls_uploaded, cast(count(*) filter (where own) as bigint) as urls_skipped, cast(count(*) filter (where nth > 1) as bigint) as urls_reused from n")
def upload_counters(spark, sf_dir):
    return media.counters(_gallery(spark, sf_dir), BUCKET, REGION)


@query(f"""with {_MEDIA}, t as (select url, 'https://media-store.s3.ap-south-1.amazonaws.com/properties/' || {V.SLUG.format(x="p")} || '-pune-2' || '/' || left(sha256(url), 16) || '.jpg' as target from n where nth = 1)
    select ord, string_agg(u, '|' order by k) as urls from (select n.ord, coalesce(target, n.url) as u, min(pos) as k from n left join t using (url) group by 1, 2) group by ord""")
def image_url_rewrite(spark, sf_dir):
    out = media.rewrite(_gallery(spark, sf_dir), BUCKET, REGION)
    return out.select("ord", F.array_join(F.transform("images", lambda x: x["url"]), "|").alias("urls"))


def _export(spark, sf_dir):
    return table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey as ord", "case when o_orderkey % 50 = 0 then '' else concat('Order ', cast(o_orderkey as string)) end as title", "case when o_orderkey % 9 = 0 then null else o_orderpriority end as city", "o_orderstatus as listingType",
        "case o_orderstatus when 'F' then 'SOLD' when 'O' then 'ACTIVE' else 'OPEN' end as status", "cast(null as string) as facing", "case when o_orderkey % 4 = 0 then '1,500' when o_orderkey % 4 = 1 then 'n.a.' else null end as price", "cast(null as string) as locality",
    )


_X = "x as (select o_orderkey as ord, case when o_orderkey % 50 = 0 then '' else 'Order ' || cast(o_orderkey as varchar) end as title, case when o_orderkey % 9 = 0 then null else o_orderpriority end as city, o_orderstatus as lt, case o_orderstatus when 'F' then 'SOLD' when 'O' then 'ACTIVE' else 'OPEN' end as status, case when o_orderkey % 4 = 0 then '1,500' when o_orderkey % 4 = 1 then 'n.a.' else null end as price from orders)"


@query(f"""with {_X}, v as (select ord, 'title' as field, 'required' as rule, title as value, title from x where title = '' union all select ord, 'city', 'required', city, title from x where city is null
    union all select ord, 'listingType', 'enum', lt, title from x union all select ord, 'status', 'enum', status, title from x where status = 'OPEN' union all select ord, 'price', 'number', price, title from x where price is not null)
    select ord, field, rule, value, left(title, 60) as title from v""")
def enum_and_type_violations(spark, sf_dir):
    return quality.violations(_export(spark, sf_dir))


_RAW_ROWS = """select p_partkey as ord, case p_partkey % 9 when 0 then '[1, 2]' when 1 then '"text"' when 2 then '{"title": ' else concat('{"title": "', p_name, '", "city": ', case p_partkey % 5 when 0 then 'null' when 1 then '""' when 2 then '0' else '"Pune"' end,
    ', "listingType": ', case p_partkey % 4 when 0 then '"BUY"' when 1 then '"LEND"' when 2 then '7' else 'null' end, ', "status": "ACTIVE", "price": ', case p_partkey % 6 when 0 then '"1,500"' when 1 then '12.5' when 2 then '[3]' when 3 then 'true' else '900' end,
    ', "bhk": ', case p_partkey % 7 when 0 then '{"n": 2}' else '2' end, ', "images": ', case p_partkey % 8 when 0 then '"http://i"' when 1 then '[{"url": "http://i"}, {"url": ""}, 3]' when 2 then '[{"type": "x"}]' when 3 then '[]' else '[{"url": "http://i"}]' end,
    ', "amenities": ', case p_partkey % 3 when 0 then '["Gym", "+3 More", " + 2 more "]' else '"Gym"' end, '}') end as json from part"""


@query(f"""with r as ({_RAW_ROWS}), j as (select ord, case when json_valid(json) then json::json end as j from r), k as (select ord, j, json_type(j) as kind from j),
    o as (select ord, j, left(coalesce(j ->> '$.title', ''), 60) as title from k where kind = 'OBJECT'),
    im as (select ord, title, e.i - 1 as i, json_extract(j, '$.images[' || (e.i - 1)::varchar || ']') as x from o, lateral (select unnest(range(1, coalesce(json_array_length(j, '$.images'), 0)::bigint + 1)) as i) e where json_type(j, '$.images') = 'ARRAY'),
    bad as (select ord, title, min(i) as i, arg_min(x, i) as x from im where json_type(x) <> 'OBJECT' or coalesce(x ->> '$.url', '') = '' group by all),
    am as (select ord, title, trim(unnest(from_json(json_extract(j, '$.amenities'), '["VARCHAR"]'))) as a, unnest(from_json(json_extract(j, '$.amenities'), '["VARCHAR"]')) as whole from o where json_type(j, '$.amenities') = 'ARRAY')
    select ord, '' as field, 'structure' as rule, case when j is null then 'not_json' else 'not_object:' || case kind when 'ARRAY' then 'list' else 'str' end end as value, '' as title from k where kind is null or kind <> 'OBJECT'
    union all select ord, 'city', 'required', j ->> '$.city', title from o where coalesce(j ->> '$.city', '') in ('', '0')
    union all select ord, 'listingType', 'enum', j ->> '$.listingType', title from o where coalesce(j ->> '$.listingType', '') <> 'BUY'
    union all select ord, 'price', 'number', case json_type(j, '$.price') when 'ARRAY' then 'list: ' else 'str: ' end || (j ->> '$.price'), title from o where json_type(j, '$.price') in ('ARRAY', 'VARCHAR')
    union all select ord, 'bhk', 'number', 'dict: ' || replace(json_extract(j, '$.bhk')::varchar, ' ', ''), title from o where json_type(j, '$.bhk') = 'OBJECT'
    union all select ord, 'images', 'images', 'str: ' || (j ->> '$.images'), title from o where json_type(j, '$.images') = 'VARCHAR'
    union all select ord, 'images[' || i::varchar || ']', 'images', left(replace(x::varchar, ' ', ''), 80), title from bad
    union all select ord, 'amenities', 'junk', whole, title from am where regexp_matches(a, '(?i)^\\+\\s*[0-9]+\\s*more$')""")
def audit_untyped_rows(spark, sf_dir):
    table(spark, sf_dir, "part").createOrReplaceTempView("part")
    return audit.audit(spark.sql(_RAW_ROWS))


@query(f"with {_X} select cast(count(*) as bigint) as row_count, cast(count(*) filter (where price is null) as bigint) as prices_null, cast(count(*) as bigint) as locality_null from x")
def null_counts(spark, sf_dir):
    return quality.counts(_export(spark, sf_dir))


@query(f"with {_X}, c as (select 'city' as field, coalesce(city, 'None') as value from x union all select 'facing', 'None' from x union all select 'listingType', lt from x union all select 'status', status from x) select field, value, cast(count(*) as bigint) as rows from c group by 1, 2")
def value_histograms(spark, sf_dir):
    return quality.histograms(_export(spark, sf_dir))


@query(f"with {_X} select ord, trim(city) as city, case when price = '1,500' then 1500.0::double end as price from x")
def repair_rows(spark, sf_dir):
    return quality.repair(_export(spark, sf_dir)).select("ord", "city", "price")


@query("select key, cast(count(*) as bigint) as rows from (select unnest(json_keys(props)) as key from events) group by 1")
def extra_key_histogram(spark, sf_dir):
    return quality.extra_keys(table(spark, sf_dir, "events").select("props"), "props")


@query("select coalesce(cast(user_id as varchar), 'TOTAL') as site, cast(count(*) as bigint) as events, cast(count(*) filter (where event_type = 'click') as bigint) as clicks, cast(count(*) filter (where event_type = 'view') as bigint) as views from events group by rollup (user_id)")
def site_rollup_stats(spark, sf_dir):
    events = table(spark, sf_dir, "events").withColumn("site", F.col("user_id").cast("string"))
    return quality.run_counters(events, "site", {"clicks": "click", "views": "view"}, "event_type")


@query("select page_id, regexp_extract(html, '(?s)<title>(.*?)</title>', 1) as raw_title from pages")
def page_raw_title(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", html.raw_title("html").alias("raw_title"))


@query()
def page_extras(spark, sf_dir):
    return html.extras(table(spark, sf_dir, "pages").select("page_id", "html"))


@query("select page_id, cast(len(regexp_extract_all(html, '(?s)<a [^>]*href=\"([^\"]*)\"', 1)) as bigint) as links from pages")
def page_link_counts(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    return pages.select("page_id", F.size(html.hrefs("html")).cast("long").alias("links"))


@query("""with recursive e as (select event_id, cast(user_id as varchar) as client, ts, epoch_us(ts) as t, row_number() over (partition by user_id order by ts, event_id) as n from events),
    f(client, n, recent, event_id, ts, accepted) as (
        select client, n, [t], event_id, ts, true from e where n = 1
        union all select e.client, e.n, case when len(g.kept) < 2 then list_append(g.kept, e.t) else g.kept end, e.event_id, e.ts, len(g.kept) < 2
        from (select f.client, f.n, f.recent, x.t as now, list_filter(f.recent, lambda r: x.t - r < 86400000000) as kept from f join e x on x.client = f.client and x.n = f.n + 1) g join e on e.client = g.client and e.n = g.n + 1
    ) select event_id, client, ts, accepted from f""")
def rate_limiter(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", F.col("user_id").cast("string").alias("client"), F.col("ts").cast("timestamp").alias("ts"))
    return limiter.accepted(events, window_seconds=86_400, most=2)


@query("select event_id, cast(count(*) over (partition by user_id order by epoch(ts) range between 60 preceding and current row) as bigint) as recent from events")
def sliding_count(spark, sf_dir):
    events = table(spark, sf_dir, "events").withColumn("t", F.unix_micros(F.col("ts").cast("timestamp")) / 1e6)
    return events.select("event_id", F.count(F.lit(1)).over(W.partitionBy("user_id").orderBy("t").rangeBetween(-60, 0)).alias("recent"))


@query("select p_partkey as ord, 57::bigint as n_columns, 'BUY' as \"listingType\", 'ACTIVE' as status, 0 as n_amenities from part")
def schema_projection(spark, sf_dir):
    c = schema.conform(V.units(spark, sf_dir))
    return c.select("ord", F.lit(len([x for x in c.columns if x in schema.SCHEMA])).cast("long").alias("n_columns"), "listingType", "status", F.size("amenities").alias("n_amenities"))
