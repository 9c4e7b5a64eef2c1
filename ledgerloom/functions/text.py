"""Scalar normalisers, each from Column to Column and inside the JVM. Blank input gives NULL unless stated."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerloom.functions import lookups as L

SPACES = r"(?U)\s+"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def _lookup(key: Column, table: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for pair in table.items() for x in pair])[key]


def _blank(x: Column) -> Column:
    return F.nullif(x, F.lit(""))


def _found(x: Column, pattern: str, group: int = 1) -> Column:
    """A group of the first match, or NULL."""
    return _blank(F.regexp_extract(x, pattern, group))


def clean_text(x) -> Column:
    return _blank(F.trim(F.regexp_replace(_c(x), SPACES, " ")))


def strip_decorative(x) -> Column:
    bare = F.regexp_replace(clean_text(x), r"[\x{1F300}-\x{1F9FF}\x{2600}-\x{27BF}\x{1FA00}-\x{1FAFF}\x{FE00}-\x{FE0F}\x{200D}]+", "")
    return _blank(F.regexp_replace(F.regexp_replace(bare, SPACES, " "), "^[ \\-\u2013\u2014]+|[ \\-\u2013\u2014]+$", ""))


def title_case(x) -> Column:
    """Upper case at the start of every run of letters, lower case within."""
    return F.array_join(F.transform(F.regexp_extract_all(F.lower(_c(x)), F.lit(r"(\p{L}+|\P{L}+)"), F.lit(1)), F.initcap), "")


def slugify(x) -> Column:
    return F.regexp_replace(F.regexp_replace(F.lower(F.trim(_c(x))), "[^a-z0-9]+", "-"), "^-+|-+$", "")


def clean_rera_number(x) -> Column:
    text = clean_text(x)
    plain = F.trim(F.regexp_replace(F.lower(text), r"^\$+", ""))
    out = F.regexp_replace(text, r"(?i)^rera\s*reg(?:istration)?\s*no\.?\s*", "")
    out = F.regexp_replace(out, r"(?i)^rera\s*(?:no\.?|number)\s*[:\-]?\s*", "")
    out = F.regexp_replace(out, r"(?i)\bdated\s+\d{1,2}[/-]\d{1,2}[/-]\d{2,4}\b", "")
    out = F.regexp_replace(F.regexp_replace(out, SPACES, " "), r"^[ .,:;\-]+|[ .,:;\-]+$", "")
    return F.when(~plain.isin(*L.RERA_PLACEHOLDERS), _blank(out))


def derive_rera_state(x) -> Column:
    text = F.upper(F.coalesce(clean_rera_number(x), clean_text(x)))
    return F.coalesce(*[F.when(text.contains(hint), F.lit(state)) for hint, state in L.RERA_STATES.items()])


def is_registered_rera(x) -> Column:
    """Three-valued: applied or pending is false, a placeholder NULL, a number true."""
    plain, cleaned = F.regexp_replace(F.lower(clean_text(x)), r"^\$+", ""), clean_rera_number(x)
    return F.when(plain.isin("applied", "pending"), F.lit(False)).when(cleaned.isNull(), F.lit(None).cast("boolean")).otherwise(~F.lower(cleaned).isin("applied", "na", "n/a", "pending", "on request"))


def normalize_city(x) -> Column:
    text = clean_text(x)
    return F.coalesce(_lookup(F.lower(text), L.CITIES), F.when(text == F.lower(text), title_case(text)), text)


def export_city(x) -> Column:
    text = clean_text(x)
    return F.coalesce(_lookup(F.lower(text), L.EXPORT_CITIES), text)


def extract_city(*parts) -> Column:
    text = F.lower(F.concat_ws(" ", *[_c(p) for p in parts]))
    return F.coalesce(*[F.when(text.contains(city.lower()), F.lit(L.CITIES.get(city.lower(), city))) for city in L.TEXT_CITIES])


def extract_locality(address, title=None) -> Column:
    pattern = r"(?i)\bSector\s*-?\s*([0-9]+[A-Za-z]?)\b"
    found = [F.upper(_found(_c(x), pattern)) for x in (address, title) if x is not None]
    return F.concat(F.lit("Sector "), F.coalesce(*found))


def extract_pincode(x) -> Column:
    return _found(_c(x), r"\b([1-9][0-9]{5})\b")


def build_address(project, locality, address, city, pincode) -> Column:
    """Locality, address, city, state and pin, each only where what stands before does not have it."""
    base, town, place, pin = F.coalesce(clean_text(address), F.lit("")), normalize_city(city), _c(locality), _c(pincode)
    has = lambda text, part: F.lower(text).contains(F.lower(part))
    first = F.array_compact(F.array(F.when(~has(base, place), place), _blank(base)))
    so_far = F.array_join(first, " ")
    second = F.array_compact(F.array(F.when(~has(so_far, town), F.when(town == "Gurgaon", F.lit("Gurugram")).otherwise(town))))
    joined = F.array_join(F.concat(first, second), " ")
    third = F.array_compact(F.array(F.when((town == "Gurgaon") & ~joined.contains("Haryana"), F.lit("Haryana"))))
    joined = F.array_join(F.concat(first, second, third), " ")
    fourth = F.array_compact(F.array(F.when(~joined.contains(pin), _blank(pin))))
    parts = F.transform(F.concat(first, second, third, fourth), lambda p: F.regexp_replace(p, "^[ ,]+|[ ,]+$", ""))
    return _blank(F.array_join(F.array_distinct(parts), ", "))


def clean_amenity(x) -> Column:
    text = clean_text(x)
    return F.when(~text.rlike(r"(?i)^\+\s*\d+\s*more$"), text)


def map_property_type(x) -> Column:
    text = clean_text(x)
    return F.coalesce(_lookup(F.lower(text), L.PROPERTY_TYPES), title_case(text))


def map_possession(x) -> Column:
    key = F.trim(F.regexp_replace(F.lower(clean_text(x)), r"[\s_\-]+", " "))
    return F.coalesce(_lookup(key, L.POSSESSION), _blank(F.upper(F.replace(key, F.lit(" "), F.lit("_")))))


def parse_date(x) -> Column:
    """A date from ISO text, month and year, or day, month and year; a year alone is NULL."""
    text = F.trim(_c(x))
    bare = F.regexp_replace(F.regexp_replace(text, r"\+00:00$", "Z"), "Z$", "")
    bare = F.regexp_replace(F.when(bare.contains("T"), F.split_part(bare, F.lit("."), F.lit(1))).otherwise(bare), SPACES, " ")
    iso = _found(bare, r"^(\d{4}-\d{1,2}-\d{1,2})(?:T\d{1,2}:\d{1,2}:\d{1,2})?$")
    formats = ("MMM yyyy", "MMMM yyyy", "d MMM yyyy", "d MMMM yyyy", "MMM d yyyy", "MMMM d yyyy", "MMM d, yyyy", "MMMM d, yyyy")
    written = F.initcap(bare)
    return F.when(~F.lower(text).isin(*L.DATE_PLACEHOLDERS), F.coalesce(F.try_to_date(iso, "yyyy-M-d"), *[F.try_to_date(written, f) for f in formats]))


def parse_bhk(x) -> Column:
    text = _c(x).cast("string")
    return F.coalesce(_found(text, r"(?i)(\d+(?:\.\d+)?)\s*BHK").try_cast("double").try_cast("long"), _found(text, r"^\s*(\d+)\.\d+\s*$").try_cast("long"), _found(text, r"(\d+)").try_cast("long"))


def price_to_inr(x, unit=None) -> Column:
    """Whole rupees from text with or without crore and lakh; on-request phrases are NULL, never a number."""
    text = F.replace(F.trim(_c(x).cast("string")), F.lit(","), F.lit(""))
    plain = F.lower(text)
    times = lambda number, factor: F.bround(number.try_cast("decimal(28,8)") * factor).try_cast("long")
    bare = text.try_cast("decimal(28,8)")
    scale = F.lit(1)
    if unit is not None:
        u = F.lower(F.trim(_c(unit)))
        scale = F.when(u.isin("cr", "crore", "crores"), F.lit(10_000_000)).when(u.isin("l", "lac", "lakh", "lakhs"), F.lit(100_000)).when(bare < 1000, F.lit(10_000_000)).otherwise(F.lit(1))
        scale = F.coalesce(scale, F.when(bare < 1000, F.lit(10_000_000)).otherwise(F.lit(1)))
    else:
        scale = F.when(bare < 1000, F.lit(10_000_000)).otherwise(scale)
    value = F.coalesce(times(_found(text, r"(?i)([\d.]+)\s*(?:cr|crore)s?"), 10_000_000), times(_found(text, r"(?i)([\d.]+)\s*(?:l|lac|lakh)s?"), 100_000), F.bround(bare * scale).try_cast("long"))
    asked = plain.isin(*L.PRICE_ON_REQUEST) | plain.rlike(r"\b(call\s+for\s+pric|price\s+on\s+(call|request)|on\s+request)\b")
    return F.when(~asked & (text != ""), value)


def parse_area(x) -> Column:
    """The first number, rounded half to even; a range is NULL."""
    text = F.replace(_c(x).cast("string"), F.lit(","), F.lit(""))
    return F.when(~text.rlike(r"(?i)[\d.]+\s*[\-\u2013\u2014to]+\s*[\d.]+"), F.bround(_found(text, r"(\d+(?:\.\d+)?)").try_cast("decimal(28,8)")).try_cast("long"))


def parse_bathrooms(x) -> Column:
    n = _found(_c(x).cast("string"), r"(\d+)").try_cast("long")
    return F.when(n > 0, n)


def sanitize_coords(lat, lng) -> Column:
    """A struct (latitude, longitude): both NULL if either is, or if the point is a placeholder."""
    a, b = _c(lat), _c(lng)
    placeholder = F.lit(False)
    for x, y in L.PLACEHOLDER_POINTS:
        placeholder = placeholder | ((F.abs(a - x) < 1e-6) & (F.abs(b - y) < 1e-6))
    ok = a.isNotNull() & b.isNotNull() & ~placeholder
    return F.struct(F.when(ok, a).alias("latitude"), F.when(ok, b).alias("longitude"))


def coerce_number(x) -> Column:
    """A number from text with commas; NULL where there is none (the raw column stays for the report)."""
    return F.replace(F.trim(_c(x)), F.lit(","), F.lit("")).try_cast("double")


def bulk_city(x) -> Column:
    text = F.trim(_c(x))
    return F.coalesce(_lookup(F.lower(text), L.BULK_CITIES), text)


def bulk_type(x) -> Column:
    text = F.trim(_c(x))
    return F.coalesce(_lookup(F.lower(text), L.BULK_TYPES), text)


def bulk_possession(x) -> Column:
    text = _blank(F.trim(_c(x)))
    key = F.trim(F.regexp_replace(F.lower(text), r"[\s_\-]+", " "))
    return F.coalesce(_lookup(key, L.BULK_POSSESSION), F.upper(F.translate(text, " -", "__")))


def seo_keywords(project, city, locality, bhk, kind) -> Column:
    """At most eight phrases, in order of first use."""
    p, c, l, b, k = (_blank(_c(x).cast("string")) for x in (project, city, locality, bhk, kind))
    blank = F.lit(" ")
    sort = F.when(k == "Apartment", F.lit("Luxury Apartments")).otherwise(k)
    phrases = F.array(F.concat(p, blank, c), F.concat(p, blank, l), F.concat(sort, blank, c), F.concat(b, F.lit(" BHK "), c))
    return F.slice(F.array_distinct(F.array_compact(phrases)), 1, 8)


def about_section(x, limit: int = 700) -> Column:
    """Text cut at the last full stop within ``limit`` characters."""
    text = clean_text(x)
    head = F.substring(text, 1, limit)
    return F.when(F.length(text) <= limit, text).otherwise(F.coalesce(_blank(F.regexp_extract(head, r"(?s)^.*\.", 0)), head))


def trim_faq_dates(x) -> Column:
    return F.regexp_replace(_c(x), r"(\d{4}-\d{2}-\d{2})T[0-9:.]+Z", "$1")


def first_token(x, tokens: dict[str, str]) -> Column:
    """The value of the first token, in order, that the text contains."""
    text = F.lower(_c(x))
    return F.coalesce(*[F.when(text.contains(t), F.lit(v)) for t, v in tokens.items()])


def join_title(*parts) -> Column:
    return F.concat_ws(" - ", *[_c(p) for p in parts])


def is_challenge(html, status) -> Column:
    """A bot challenge rather than content, by its status, or its words in a short body, or at the head of a long one."""
    body = F.lower(F.trim(F.coalesce(_c(html), F.lit(""))))
    short = (F.length(body) < 800) & body.rlike("access denied|captcha|cf-browser|attention required")
    head = F.substring(body, 1, 2000)
    return F.coalesce(_c(status).isin(403, 406, 417, 451), F.lit(False)) | short | (head.contains("access denied") & head.contains("permission to access"))


def is_soft_error(message) -> Column:
    """Whether an error message tells of a block rather than of a fault."""
    return _c(message).rlike("417|403|406|451|Access Denied|Challenge|anti-bot")


def page_title(html_title, portal: str, project, locality, city, kind) -> Column:
    """The page's own title if it names the project (cut at a bar where the portal's name is in it), else one made of parts."""
    raw, p = F.coalesce(_c(html_title), F.lit("")), _c(project)
    own = F.when(F.lower(raw).contains(portal.lower()), F.trim(F.split_part(raw, F.lit("|"), F.lit(1)))).otherwise(F.trim(raw))
    own = F.coalesce(strip_decorative(own), own)
    made = F.concat(F.concat_ws(" ", p, _blank(_c(locality)), _blank(_c(city))), F.lit(" | Luxury "), F.coalesce(_blank(_c(kind)), F.lit("Apartments")))
    return F.when((raw != "") & F.lower(own).contains(F.lower(p)), own).otherwise(made)


def page_heading(html_h1, project, locality, city, bhk, all_bhks) -> Column:
    """Project, place and sizes; without sizes the page's own heading. ``all_bhks``: the project's sizes, an array."""
    p, n = _c(project), F.array_sort(F.array_distinct(F.array_compact(_c(all_bhks))))
    place = F.concat_ws(" ", _blank(_c(locality)), _blank(_c(city)))
    sized = lambda label: F.trim(F.concat(p, F.lit(" "), place, F.lit(" — Luxury "), label, F.lit(" BHK Residences")))
    own = strip_decorative(html_h1)
    rest = F.regexp_replace(F.substring(own, F.length(p) + 1, F.length(own)), "^[ ,\\-]+", "")
    own = F.when(own.startswith(p) & (rest != ""), F.concat(p, F.lit(" "), rest)).otherwise(own)
    return F.when(F.size(n) > 1, sized(F.array_join(F.transform(n, lambda x: x.cast("string")), " & "))).when(F.coalesce(_c(bhk), F.lit(0)) > 0, sized(_c(bhk).cast("string"))).when(F.length(own) > 5, own).otherwise(F.trim(F.concat(p, F.lit(" "), place)))


def location_advantages(blurbs, overview) -> Column:
    """The blurbs, else the first sentence that tells of connections."""
    told = F.filter(F.split(_c(overview), r"\."), lambda s: F.lower(s).rlike("connect|located|proximity|metro|airport|expressway"))
    return F.when(F.size(_c(blurbs)) > 0, clean_text(F.array_join(_c(blurbs), " "))).otherwise(clean_text(F.concat(F.try_element_at(told, F.lit(1)), F.lit("."))))


def address_section(project, address, blurbs) -> Column:
    """Project and address, then the nearest transit."""
    dotted = lambda x: F.when(x.endswith("."), x).otherwise(F.concat(x, F.lit(".")))
    p, a = _c(project), _blank(_c(address))
    first = F.when(F.lower(a).contains(F.lower(p)), dotted(a)).otherwise(F.concat(p, F.lit(", "), a, F.lit(".")))
    metro = dotted(F.try_element_at(F.filter(_c(blurbs), lambda b: F.lower(b).contains("metro")), F.lit(1)))
    metro = F.when(F.lower(metro).contains("nearest"), metro).otherwise(F.concat(F.lit("Nearest transit: "), metro))
    return clean_text(F.concat_ws(" ", first, metro))
