"""URL canonicalisation, predicates and object keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerloom.functions import lookups as L
from ledgerloom.functions.text import _c

SUFFIXES = (".jpg", ".jpeg", ".png", ".webp", ".gif", ".bmp", ".svg")
TYPES = {".jpg": "image/jpeg", ".png": "image/png", ".webp": "image/webp", ".gif": "image/gif", ".bmp": "image/bmp", ".svg": "image/svg+xml"}


def part(url, name: str) -> Column:
    return F.try_parse_url(_c(url), F.lit(name))


def with_slash(url) -> Column:
    u = F.trim(_c(url))
    return F.concat(F.regexp_replace(u, "/+$", ""), F.lit("/"))


def url_key(url) -> Column:
    """What two spellings of one address share: no query, fragment, case of the host, or final slash."""
    bare = F.regexp_replace(F.trim(_c(url)), r"[?#].*$", "")
    return F.regexp_replace(F.lower(bare), "/+$", "")


def is_non_project_slug(slug) -> Column:
    s = F.lower(_c(slug))
    return (F.coalesce(s, F.lit("")) == "") | s.isin(*L.RESERVED_SLUGS) | s.contains(L.HUB_MARKER)


def project_url(href, host: str) -> Column:
    """The canonical address of a project page of ``host``, or NULL."""
    h = F.trim(_c(href))
    inner = F.regexp_replace(h, "^/+|/+$", "")
    h = F.when(~inner.contains("/"), F.concat(F.lit("/"), inner, F.lit("/"))).otherwise(h)
    site = F.coalesce(F.nullif(F.regexp_extract(h, r"^(?:[a-zA-Z][a-zA-Z0-9+.\-]*:)?//([^/?#]*)", 1), F.lit("")), F.lit(host))
    path = F.regexp_replace(F.regexp_replace(h, r"^(?:[a-zA-Z][a-zA-Z0-9+.\-]*:)?//[^/?#]*", ""), r"[?#].*$", "")
    path = F.when(path.startswith("/"), path).otherwise(F.concat(F.lit("/"), path))
    low = F.lower(path)
    bad = F.lit(False)
    for p in L.EXCLUDED_PREFIXES:
        bad = bad | low.startswith(p)
    ok = ~_c(href).rlike(r"^\s*(#|mailto:|tel:)") & site.contains(host) & ~path.isin(*L.EXCLUDED_PATHS) & ~bad & path.rlike(L.PROJECT_PATH) & ~is_non_project_slug(F.regexp_replace(low, "^/+|/+$", ""))
    return F.when(ok, F.concat(F.lit(f"https://www.{host}"), F.regexp_replace(path, "/$", ""), F.lit("/")))


def listing_category(url) -> Column:
    path = F.lower(F.coalesce(part(url, "PATH"), F.lit("")))
    return F.when(path.contains("/projects/commercial"), F.lit("commercial")).when(path.contains("/projects/residential"), F.lit("residential"))


def host_contains(url, literal: str) -> Column:
    return F.coalesce(F.lower(part(url, "HOST")).contains(literal), F.lit(False))


def host_allowed(url, allowed: list[str]) -> Column:
    """http or https, and a host that is allowed or below one that is."""
    host = F.lower(part(url, "HOST"))
    below = F.exists(F.array(*map(F.lit, allowed)), lambda a: (host == a) | F.endswith(host, F.concat(F.lit("."), a)))
    return F.coalesce(F.lower(part(url, "PROTOCOL")).isin("http", "https") & below, F.lit(False))


#: Suffixes of the content types that servers name.
HEADER_SUFFIXES = {"image/jpeg": ".jpg", "image/png": ".png", "image/webp": ".webp", "image/gif": ".gif", "image/bmp": ".bmp", "image/svg+xml": ".svg", "image/tiff": ".tiff", "image/avif": ".avif", "image/heic": ".heic", "image/heif": ".heif", "text/html": ".html", "text/plain": ".txt", "application/json": ".json", "application/pdf": ".pdf", "application/octet-stream": ".bin", "image/vnd.microsoft.icon": ".ico"}


def in_bucket(url, bucket: str, region: str) -> Column:
    host, b = F.lower(part(url, "HOST")), bucket.lower()
    known = host.isin(f"{b}.s3.{region}.amazonaws.com", f"{b}.s3.amazonaws.com", f"s3.{region}.amazonaws.com", "s3.amazonaws.com")
    return F.coalesce(known & (host.contains(b) | part(url, "PATH").contains(f"/{b}/")), F.lit(False))


def sanitize_segment(x, most: int = 80) -> Column:
    s = F.regexp_replace(F.lower(F.trim(F.coalesce(_c(x), F.lit("")))), "[^a-z0-9._-]+", "-")
    s = F.regexp_replace(F.regexp_replace(s, "-{2,}", "-"), r"^[\-._]+|[\-._]+$", "")
    return F.substring(F.coalesce(F.nullif(s, F.lit("")), F.lit("unknown")), 1, most)


def _media_type(header) -> Column:
    return F.lower(F.trim(F.split_part(_c(header), F.lit(";"), F.lit(1))))


def extension(url, header=None) -> Column:
    """The suffix of an image address, else that of the content type that its server named, else .jpg."""
    found = F.regexp_extract(F.lower(F.regexp_replace(_c(url), r"[?#].*$", "")), r"(\.[a-z0-9]+)$", 1)
    own = F.when(found == ".jpeg", F.lit(".jpg")).when(found.isin(*SUFFIXES), found)
    if header is None:
        return F.coalesce(own, F.lit(".jpg"))
    pairs = [F.lit(x) for kv in HEADER_SUFFIXES.items() for x in kv]
    return F.coalesce(own, F.create_map(*pairs)[_media_type(header)], F.lit(".jpg"))


def content_type(ext, header=None) -> Column:
    """The content type that the server named if it is an image's, else that of the suffix."""
    pairs = [F.lit(x) for kv in TYPES.items() for x in kv]
    guessed = F.coalesce(F.create_map(*pairs)[_c(ext)], F.lit("application/octet-stream"))
    return guessed if header is None else F.when(F.startswith(_c(header), F.lit("image/")), F.trim(F.split_part(_c(header), F.lit(";"), F.lit(1)))).otherwise(guessed)


def object_key(folder, url) -> Column:
    return F.concat(F.lit("properties/"), _c(folder), F.lit("/"), F.substring(F.sha2(_c(url), 256), 1, 16), extension(url))


def public_url(bucket: str, region: str, key) -> Column:
    return F.concat(F.lit(f"https://{bucket}.s3.{region}.amazonaws.com/"), _c(key))


def file_name(url) -> Column:
    last = F.element_at(F.split(F.regexp_replace(_c(url), r"[?#].*$", ""), "/"), -1)
    clean = F.regexp_replace(last, r"[^\w.\-]+", "_")
    return F.when(F.coalesce(clean, F.lit("")) == "", F.lit("image.jpg")).when(clean.contains("."), clean).otherwise(F.concat(clean, F.lit(".jpg")))


def decoded(x) -> Column:
    return F.coalesce(F.try_url_decode(_c(x)), _c(x))
