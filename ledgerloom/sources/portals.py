"""Listing portals: a page's embedded data to unit rows.

A portal has its own way to find the data (``find``), and a table of the names under which the fields lie. Python
only finds and reads JSON; all values are normalised in Catalyst, the same way for every portal.
"""

from __future__ import annotations

import json
import re
from bisect import bisect_left
from collections.abc import Callable
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as S

from ledgerloom.functions import arrays as A
from ledgerloom.functions import text as T
from ledgerloom.operators.schema import conform
from ledgerloom.sources import html as H

UNKNOWN = "Unknown Project"
UNIT_FIELDS = ("bhk", "carpet", "super", "bathrooms", "price", "price_unit")
PROJECT_FIELDS = ("project", "slug", "developer", "city", "locality", "address", "kind", "possession", "possession_date", "rera", "latitude", "longitude", "least_price")
LIST_FIELDS = ("amenities", "highlights", "images", "blurbs")
PAYLOAD = ", ".join([*(f"{f} string" for f in PROJECT_FIELDS), *(f"{f} array<string>" for f in LIST_FIELDS), f"units array<struct<{', '.join(f'{f}: string' for f in UNIT_FIELDS)}>>"])
READ = S.StructType([S.StructField("_p", S.StringType()), *H.EXTRAS.fields])
BATHS = ("bathroom", "bathrooms", "number_of_bathrooms", "bath", "Bath", "washroom", "washrooms")
BLURBS = ("connectivity", "business", "education", "entertainment", "hospital", "shopping", "nearbyPlaces")

#: Tokens of addresses and headings and the city each names, the first that occurs counts; months; registrations as pages write them.
CITY_TOKENS = {"gurgaon": "Gurgaon", "gurugram": "Gurgaon", "noida": "Noida", "greater-noida": "Greater Noida", "new-delhi": "New Delhi", "delhi": "Delhi"}
MORE_CITY_TOKENS = {"gurgaon": "Gurgaon", "noida": "Noida", "greater-noida": "Greater Noida", "new-delhi": "New Delhi", "delhi": "Delhi", "mumbai": "Mumbai", "bangalore": "Bangalore", "bengaluru": "Bangalore"}
MONTH = "(?:Jan|Feb|Mar|Apr|May|Jun|Jul|Aug|Sep|Oct|Nov|Dec)[a-z]*"
WRITTEN_RERA = r"(?i)\b((?:GGM|UPRERAPRJ|HRERA)[A-Z0-9/.\-]{6,})\b"
WRITTEN_PRICE = r"(?i)(?:Prices?\s+begin\s+at|Starting\s+(?:price|from)|Entry\s+price)\s*(?:is\s*)?(?:₹|Rs\.?)\s*([\d.,]+\s*(?:Crore|Cr|Lakh|Lac)?)"
#: Pictures and amenities that are taken from the page's elements at most, as the portals' rules have it.
MOST_PICTURES, MOST_AMENITIES = 12, 40
#: Units that the text portal's rules take from a page; the inline portal's take all.
MOST_WRITTEN = 30

_decoder = json.JSONDecoder()


def json_at(text: str, start: int):
    """The JSON value that starts at ``start``, or None."""
    try:
        return _decoder.raw_decode(text, start)[0]
    except (ValueError, RecursionError):  # broken, or nested too deeply to be any portal's data
        return None


def listing(value) -> list:
    """The value if it is a list, else no elements."""
    return value if isinstance(value, list) else []


def value_after(text: str, key: str):
    m = re.search(rf'"{re.escape(key)}"\s*:\s*', text)
    return json_at(text, m.end()) if m else None


def pushed_strings(page: str) -> list[str]:
    """Long string literals that scripts push, unescaped."""
    out = []
    for m in re.finditer(r"\.push\(\[(.*?)\]\)\s*</script>", page, re.S):
        for s in re.finditer(r'"(?:[^"\\]|\\.){100,}"', m[1]):
            value = json_at(s[0], 0)
            out.append(value if isinstance(value, str) else s[0][1:-1].replace("\\/", "/").replace('\\"', '"'))
    return out


#: Texts and braces: what the nesting of objects follows from.
NESTING = re.compile(r'"[^"\\]*(?:\\.[^"\\]*)*"|[{}]', re.S)


def objects_before(text: str, marker: str, reach: int = 8000):
    """Objects that hold ``marker`` as a key and begin within ``reach`` characters before it, outermost first, each once.

    One pass tells which braces are open at each marker, so only those are read, and none twice. Where a page's quotes do not pair, a marker is
    taken for text there; then each brace within reach is tried, from the nearest.
    """
    markers = [m.start() for m in re.finditer(re.escape(marker), text)]
    if not markers:
        return
    seen: set[int] = set()
    known: dict[int, object] = {}

    def read(start: int):
        if start not in known:
            known[start] = json_at(text, start)
        return known[start]

    key, spots, stack, open_at = marker.strip('"'), set(markers), [], {}
    for m in NESTING.finditer(text):
        if m[0] == "{":
            stack.append(m.start())
        elif m[0] == "}":
            if stack:
                stack.pop()
        elif m.start() in spots:
            open_at[m.start()] = stack[bisect_left(stack, m.start() - reach) :]
    for at in markers:
        holds = [s for s in open_at.get(at, ()) if isinstance(v := read(s), dict) and key in v]
        back = at
        while not holds and (back := text.rfind("{", max(0, at - reach), back)) >= 0:
            if isinstance(v := read(back), dict) and key in v:
                holds = [back]
        for s in holds:
            if s not in seen:
                seen.add(s)
                yield known[s]


def richest(values, weigh: Callable[[dict], int]) -> dict:
    """The value of the largest weight, the first of equals."""
    best, top = {}, -1
    for v in values:
        if (w := weigh(v)) > top:
            best, top = v, w
    return best


def deepest_first(value, accept: Callable[[dict], bool]) -> dict:
    stack = [value]
    while stack:
        x = stack.pop()
        if isinstance(x, dict):
            if accept(x):
                return x
            stack += x.values()
        elif isinstance(x, list):
            stack += x
    return {}


def pick(value: dict, names):
    """The first truthy value among alternative names; a name with a dot goes into an object."""
    for n in names:
        x = value
        for part in n.split("."):
            x = x.get(part) if isinstance(x, dict) else None
        if x not in (None, "", 0, [], {}):
            return x
    return None


def words_of(value, *names) -> list[str]:
    """Texts of a list whose elements are texts or objects with one of ``names``."""
    out = []
    for x in value if isinstance(value, list) else []:
        x = pick(x, names) if isinstance(x, dict) else x
        if isinstance(x, str) and x.strip():
            out.append(x.strip())
    return list(dict.fromkeys(out))


def numeral(value) -> str | None:
    """A number as it is compared: that of ``3``, ``'3 BHK'`` and ``'1,500 sq ft'``; the text itself where there is none."""
    if isinstance(value, bool) or value is None:
        return None
    if isinstance(value, (int, float)):
        return f"{value:g}"
    if not isinstance(value, str):
        return None
    m = re.search(r"\d[\d,]*\.?\d*", value)
    try:
        return f"{float(m[0].replace(',', '')):g}" if m else value.strip().lower()
    except ValueError:
        return value.strip().lower()


def image_urls(*values) -> list[str]:
    flat = []
    for v in values:
        for x in v if isinstance(v, list) else [v]:
            x = pick(x, ("url", "cdn_url", "src", "image")) if isinstance(x, dict) else x
            if isinstance(x, str) and x.startswith("http"):
                flat.append(x)
    return list(dict.fromkeys(flat))


class Page(str):
    """A page's text, with its elements parsed once, when they are first asked for."""

    @property
    def root(self) -> H.Element:
        if not hasattr(self, "_root"):
            self._root = H.Tree(self).root
        return self._root


@dataclass(frozen=True)
class Portal:
    """One source: its host, how to find its data, and what its fields are called."""

    site: str
    host: str
    find: Callable[[str], dict]
    names: dict[str, tuple[str, ...]]
    units: Callable[[str, dict], list[dict]]
    default_kind: str = "Apartment"
    blocked: str | None = None
    least_length: int = 0
    patterns: dict[str, str] = field(default_factory=dict)
    #: City by the first token in the address (and heading, if ``headed``); locality and slug from the address too.
    cities: dict[str, str] = field(default_factory=dict)
    headed: bool = False
    #: Whether pictures of the host are taken from the page, and where amenities stand there.
    pictures: bool = False
    amenity: Callable[[str], list[str]] | None = None
    #: Type of a project by a word in its address.
    kinds: dict[str, str] = field(default_factory=dict)
    #: Addresses of projects on listing pages; {host} is the portal's.
    listing: str | None = None
    #: Whether a unit's size is part of its slug only where the slug without it is taken.
    ladder: bool = False

    def pictured(self, page: "Page") -> list[str]:
        """Addresses of the page's own pictures at this portal's host."""
        found = ("https:" + u if u.startswith("//") else u for x in page.root.every("img") if (u := x.attrs.get("src") or ""))
        return list(dict.fromkeys(u for u in found if u.startswith("http") and self.host.removeprefix("www.") in u))

    def payload(self, page: str | None) -> str | None:
        """The page's fields as JSON; None for a page that is blocked or none of this portal's projects."""
        return self.read(page)[0]

    def read(self, page: str | None) -> tuple[str | None, dict | None]:
        """The payload, and what the markup tells (``html.page_extras``), from one parse of the page."""
        page = Page(page or "")
        text = self._payload(page)
        return text, None if text is None else H.page_extras(page, page.root)

    def _payload(self, page: "Page") -> str | None:
        if len(page) < self.least_length or self.blocked and self.blocked in page:
            return None
        data = self.find(page)
        out: dict = {f: pick(data, self.names[f]) for f in PROJECT_FIELDS if f in self.names}
        for f, p in self.patterns.items():
            if not out.get(f) and (m := re.search(p, page)):
                out[f] = m[1]
        highlight = data.get("highlight") if isinstance(data.get("highlight"), dict) else {}
        out["amenities"] = words_of(pick(data, self.names.get("amenities", ())), "name", "title", "label") or (self.amenity(page) if self.amenity else [])
        out["highlights"] = words_of(highlight.get("highlights"), "highlight_Point", "highlight_point") + words_of(data.get("highlights"), "highlight_Point")
        out["blurbs"] = list(dict.fromkeys(b for k in BLURBS for b in words_of(highlight.get(k), "name", "title")))
        out["images"] = image_urls(*(data.get(n) for n in self.names.get("images", ())))
        if self.pictures and len(out["images"]) < MOST_PICTURES:
            out["images"] = list(dict.fromkeys(out["images"] + self.pictured(page)))[:MOST_PICTURES]
        out["units"] = self.units(page, data)
        clean = lambda v: v if v is None or isinstance(v, str) else json.dumps(v)
        out = {k: v if k in LIST_FIELDS else [{f: clean(u.get(f)) for f in UNIT_FIELDS} for u in v] if k == "units" else clean(v) for k, v in out.items()}
        return H.whole_characters(json.dumps(out, ensure_ascii=False))


def _listed(*paths, bhk=(), carpet=(), super_=(), price=("price",), unit=("priceUnit", "price_unit")):
    def units(page: str, data: dict) -> list[dict]:
        rows = pick(data, paths)
        return [{"bhk": pick(r, bhk), "carpet": pick(r, carpet), "super": pick(r, super_), "bathrooms": pick(r, BATHS), "price": pick(r, price), "price_unit": pick(r, unit)} for r in (rows if isinstance(rows, list) else []) if isinstance(r, dict)]

    return units


AREA_KINDS = {"CARPET": "carpet", "SUPER": "super", "SUPER_BUILTUP": "super", "SBA": "super", "BUILTUP": "super", "BUILT_UP": "super"}


def _floor_plans(page: str, data: dict) -> list[dict]:
    """Nested plans: configurations hold tuples, tuples hold areas by kind; units that are equal as numbers once, whatever their price.

    What is not of the expected shape, at whatever level, is passed over.
    """
    plans, out = value_after(page, "floorPlans"), {}
    for c in listing(pick(plans, ("data.configurations",))) if isinstance(plans, dict) else []:
        for t in listing(c.get("tuples")) if isinstance(c, dict) else []:
            if not isinstance(t, dict):
                continue
            areas = {}
            for a in listing(t.get("areaType")):
                if isinstance(a, dict):
                    areas[AREA_KINDS.get(str(a.get("id") or "").upper(), "other")] = pick(a, ("area.min",))
            price = pick(t, ("price.value", "price.min", "price", "minPrice.value", "minPrice"))
            unit = {"bhk": pick(c, ("bedroom", "label", "configLabel")), "carpet": areas.get("carpet"), "super": areas.get("super"), "bathrooms": pick(t, BATHS) or pick(c, BATHS), "price": price}
            out.setdefault(tuple(numeral(unit[k]) for k in ("bhk", "carpet", "super", "bathrooms")), unit)
    return list(out.values())


def _written(pattern: str, most: int | None = None):
    def units(page: str, data: dict) -> list[dict]:
        found = dict.fromkeys((m[1], m[2].replace(",", "")) for m in re.finditer(pattern, page))
        return [{"bhk": b, "super": a} for b, a in list(found)[:most]]

    return units


def _pushed(page: str) -> dict:
    found = (o for s in pushed_strings(page) if "projectName" in s for o in objects_before(s + " ", '"projectName"'))
    return richest(found, lambda o: len(o) + 100 * bool(o.get("projectName")) + 10 * len(listing(o.get("BhK_Details"))) + 20 * bool(o.get("Amenities")))


def _next_data(page: str) -> dict:
    m = re.search(r'<script id="__NEXT_DATA__"[^>]*>', page)
    return deepest_first(json_at(page, m.end()), lambda o: bool((o.get("name") or o.get("projectName")) and (o.get("inventory_configs") or o.get("configs") or o.get("developer_name")))) if m else {}


def _product(page: str) -> dict:
    return next((x for x in H.ld_json(page.root) if x.get("@type") == "Product"), {})


def _inline(page: str) -> dict:
    return richest(objects_before(page, '"projectName"'), len)


def _headed(page: str) -> dict:
    """A page that is written text: the project is its heading, cut before the sector."""
    heading = next((H.squeeze(x.text()) for x in page.root.every("h1")), "")
    cut = re.match(r"(?i)(.+?)\s+Sector\s+\d+[A-Za-z]?\s*,", heading)
    return {"heading": cut[1] if cut else heading, "about": _about(page)}


def _about(page: str) -> str | None:
    """The name in the first text that begins with "About", from the element that holds it."""
    for x in page.root.every(*"h1 h2 h3 h4 h5 h6 p div span strong b a li".split()):
        if any(isinstance(k, str) and re.match(r"(?i)\s*About\s+", k) for k in x.kids):
            m = re.match(r"About\s+([A-Za-z0-9 &.]{2,60})", H.squeeze(x.text()))
            return m[1].strip() if m else None
    return None


def _named_amenities(page: str) -> list[str]:
    found = (H.squeeze(x) for x in re.findall(r'(?i)"amenit(?:y|ies)Name"\s*:\s*"([^"]+)"', page))
    return list(dict.fromkeys(x for x in found if x))[:MOST_AMENITIES]


def _listed_amenities(page: str) -> list[str]:
    """Items of lists within an element whose class tells of amenities."""
    out: dict[str, None] = {}
    for item in page.root.every("li"):
        x = item.parent
        while x is not None and "amenit" not in x.attrs.get("class", "").lower():
            x = x.parent
        if x is not None and (name := H.squeeze(item.text())):
            out[name] = None
    return list(out)[:MOST_AMENITIES]


#: The five kinds of portals; hosts and site names are the caller's.
def registry(hosts: dict[str, str]) -> dict[str, Portal]:
    """Portals by kind (pushed, plans, state, inline, text) for (kind to host)."""
    kinds = {
        "pushed": lambda h: Portal("pushed", h, _pushed, {
            "project": ("projectName",), "slug": ("projectUrl",), "developer": ("builderName", "builder.name"), "city": ("city",), "address": ("projectAddress",), "kind": ("propertyTypeName", "projectType", "type", "propertyType.typeName"),
            "possession": ("project_Status",), "possession_date": ("possessionDate",), "rera": ("projectReraNo",), "amenities": ("Amenities", "amenities"), "images": ("frontImage", "projectGallery")},
            _listed("BhK_Details", bhk=("bhk_type",), carpet=("carpet_Area", "carpet_area", "carpetArea", "Carpet_Area"), super_=("bhk_Area", "bhk_area", "area")), ladder=True),
        "plans": lambda h: Portal("plans", h, _product, {"project": ("name",), "developer": ("brand.name",), "images": ("image",), "least_price": ("offers.lowPrice",)}, _floor_plans, blocked="Access Denied", least_length=5000,
            patterns={"project": r'"projectName"\s*:\s*"([^"]+)"', "developer": r'"builderName"\s*:\s*"([^"]+)"', "rera": WRITTEN_RERA, "possession_date": rf"(?i)Possession[^A-Za-z0-9]{{0,20}}({MONTH}\s+\d{{4}}|\d{{4}})"},
            cities=CITY_TOKENS, pictures=True, amenity=_named_amenities, listing=r"(?i)(?:https?://(?:www\.)?{host})?/[a-z0-9\-]+-npxid-[a-z0-9]+"),
        "state": lambda h: Portal("state", h, _next_data, {
            "project": ("name", "projectName"), "developer": ("developer_name", "builderName"), "city": ("city", "city_name"), "locality": ("locality", "locality_name"), "rera": ("rera_id", "rera"), "possession_date": ("possession_date",)},
            _listed("inventory_configs", "configs", bhk=("apartment_type", "bhk", "title"), carpet=("carpet_area",), super_=("built_up_area", "super_built_up_area")), blocked="Security Alert", patterns={"rera": r"(?i)RERA[^\n<:]{0,10}[:\s]+([A-Z0-9/.\-]+)"},
            listing=r"(?i)(?:https?://(?:www\.)?{host})?/in/buy/projects/page/[^\"'\s<>]+"),
        "inline": lambda h: Portal("inline", h, _inline, {
            "project": ("projectName",), "developer": ("devName",), "city": ("cityName",), "locality": ("localityName", "lmtDName"), "latitude": ("psmLatitude",), "longitude": ("psmLongitude",), "images": ("image",), "least_price": ("minPrice", "schemaPriceMin")},
            _written(r"(?i)(\d+)\s*BHK\s*(?:Flat|Apartment|Villa)?\s*([\d,]+)\s*sq\.?\s*ft"), patterns={"rera": r"(?i)RERA\s*ID\s*:\s*([A-Z0-9/.\-]+(?:\s+DATED\s+[0-9.]+)?)", "possession_date": r"(?i)Possession\s+([A-Za-z]{3}'?\d{2})"},
            listing=r"(?i)(?:https?://(?:www\.)?{host})?/[a-z0-9\-]+-pdpid-[a-z0-9]+"),
        "text": lambda h: Portal("text", h, _headed, {"project": ("heading",), "developer": ("about",)}, _written(r"(?is)(\d+)\s*BHK.{0,80}?([\d,.]{3,6})\s*(?:Sq\.?\s*Ft|sqft)", MOST_WRITTEN), least_length=5000,
            patterns={"rera": WRITTEN_RERA, "possession_date": rf"(?i)Possession[^A-Za-z0-9]{{0,40}}({MONTH}\s+\d{{4}})", "least_price": WRITTEN_PRICE},
            cities=MORE_CITY_TOKENS, headed=True, pictures=True, amenity=_listed_amenities, kinds={"commercial-property": "Commercial"}, listing=r"(?i)(?:https?://(?:www\.)?{host})?/[a-z\-]+-(?:residential|commercial)-property/[a-z0-9\-]+/\d+/project"),
    }
    unknown = set(hosts) - set(kinds)
    if unknown:
        raise ValueError(f"unknown kinds of portal: {sorted(unknown)}")
    return {k: kinds[k](h) for k, h in hosts.items()}


def parse_sites(raw: str | None, known: dict) -> list[str]:
    """Names of a comma list, all if it is blank; an unknown one is an error."""
    names = [x.strip().lower() for x in (raw or "").split(",") if x.strip()] or list(known)
    if bad := [x for x in names if x not in known]:
        raise ValueError(f"unknown sites: {bad}")
    return names


def listed(pages: DataFrame, portal: Portal, page: str = "page_id", html: str = "html") -> DataFrame:
    """(page, pos, url): the projects that a portal's listing pages name, in order, once each; blocked and short pages name none."""
    if portal.listing is None:
        raise ValueError(f"{portal.site} names its projects in its data: see project_links")
    x = F.col(html)
    sound = pages.where((F.length(x) >= portal.least_length) & (~F.contains(x, F.lit(portal.blocked)) if portal.blocked else F.lit(True)))
    found = H.links(sound, portal.listing.replace("{host}", re.escape(portal.host.removeprefix("www."))), 1 << 30, page, html)
    absolute = F.when(F.startswith("url", F.lit("/")), F.concat(F.lit(f"https://www.{portal.host.removeprefix('www.')}"), "url")).otherwise(F.col("url"))
    return found.withColumn("url", absolute).groupBy(page, "url").agg(F.min("pos").alias("pos")).select(page, "pos", "url")


def _place(portal: Portal, url: str) -> tuple[Column, Column]:
    """City and locality that a project's address, or its heading, names."""
    none, path = F.lit(None).cast("string"), F.lower(F.regexp_replace(F.col(url), "^[a-zA-Z]+://[^/]*", ""))
    if not portal.cities:
        return none, none
    heading = F.lower(F.coalesce("h1", F.lit("")))
    spots = F.concat_ws("\n", path, heading, F.regexp_replace(heading, " ", "-")) if portal.headed else path
    sector = r"(?i)sector[-\s]?(\d+[a-z]?)"
    number = F.coalesce(F.nullif(F.regexp_extract("h1", r"(?i)Sector\s+(\d+[A-Za-z]?)", 1), F.lit("")) if portal.headed else none, F.nullif(F.regexp_extract(path, sector, 1), F.lit("")))
    return T.normalize_city(T.first_token(spots, portal.cities)), F.concat(F.lit("Sector "), F.upper(number))


def units(pages: DataFrame, portal: Portal, url: str = "url", html: str = "html", project_price: bool = False) -> DataFrame:
    """Unit rows of a portal's pages, in the schema; a project without units is one row without unit fields.

    A project's least price is no unit's price: only with ``project_price`` does it stand in for a missing one, and then the column
    price_is_project_level is true.
    """

    @F.pandas_udf(READ)
    def read(p: pd.Series) -> pd.DataFrame:
        rows = [{"_p": text, **(told or dict.fromkeys(H.EXTRAS.names))} for text, told in map(portal.read, p)]
        return pd.DataFrame(rows, columns=READ.names)

    told = pages.withColumns({"_r": read(html), "point": H.coordinates(html)}).where("_r._p is not null")
    x = told.select(*[c for c in pages.columns if c != html], "_r.*", "point").withColumn("p", F.from_json("_p", PAYLOAD))
    project = F.coalesce(T.clean_text("p.project"), T.strip_decorative("h1"), F.lit(UNKNOWN))
    x = x.withColumns({"_project": project, "_overview": H.overview(F.col("paragraphs"), project)})
    path = F.regexp_replace(F.col(url), "^[a-zA-Z]+://[^/]*|[?#].*$", "")
    base = T.slugify(F.coalesce(F.nullif(F.col("p.slug"), F.lit("")), F.nullif(F.regexp_replace(path, "^/+|/+$", ""), F.lit("")) if portal.cities else F.lit(None), project))
    ladder = _ladder if portal.ladder else _one_name
    x = x.withColumn("_base", base)
    x = x.withColumn("_names", A.running_names(F.transform("p.units", lambda v: ladder(F.col("_base"), T.parse_bhk(v["bhk"]), T.parse_area(v["super"]), T.parse_area(v["carpet"])))))
    x = x.withColumn("_units", F.col("p.units"))
    u = x.select("*", F.posexplode_outer(F.arrays_zip("_units", "_names")).alias("_pos", "_z")).withColumns({"_u": F.col("_z._units"), "_name": F.col("_z._names")})
    told_city, told_locality = _place(portal, url)
    kind = F.coalesce(*[F.when(F.lower(path).contains(word), F.lit(k)) for word, k in portal.kinds.items()], F.lit(portal.default_kind))
    # a month and a year of two digits, as in Dec'27
    ready = T.parse_date(F.regexp_replace("p.possession_date", r"^([A-Za-z]{3})'?(\d{2})$", "$1 20$2"))
    least = T.price_to_inr("p.least_price")
    own_price = T.price_to_inr("_u.price", "_u.price_unit")
    city = F.coalesce(T.normalize_city("p.city"), told_city, T.extract_city("title", "p.address", "meta_description", "_overview", url))
    locality = F.coalesce(T.clean_text("p.locality"), told_locality, T.extract_locality("p.address", "title"), T.extract_locality("_overview"))
    u = u.withColumns({
        "projectName": F.col("_project"), "developer": T.clean_text("p.developer"), "city": city, "locality": locality, "bhk": T.parse_bhk("_u.bhk"), "bathrooms": T.parse_bathrooms("_u.bathrooms"),
        "carpetArea": T.parse_area("_u.carpet"), "superBuiltUpArea": T.parse_area("_u.super"), "price": F.coalesce(own_price, least) if project_price else own_price,
        "price_is_project_level": own_price.isNull() & least.isNotNull() if project_price else F.lit(False),
        "propertyType": F.coalesce(T.map_property_type("p.kind"), kind), "possessionStatus": F.coalesce(T.map_possession("p.possession"), F.when(ready.isNotNull(), T.map_possession(F.lit("under construction")))) if portal.patterns.get("possession_date") else T.map_possession("p.possession"), "possessionDate": ready,
        "pincode": F.coalesce(T.extract_pincode("p.address"), T.extract_pincode("_overview")), "reraNumber": T.clean_rera_number("p.rera"), "reraState": T.derive_rera_state("p.rera"), "reraRegistered": T.is_registered_rera("p.rera"),
        "reraVerified": T.is_registered_rera("p.rera"), "amenities": F.col("p.amenities"), "highlights": F.array_distinct("p.highlights"), "description": T.clean_text("_overview"), "aboutSection": T.about_section("_overview"),
        "images": A.images_of_urls(F.col("p.images")), "seoDescription": F.col("meta_description"), "sourceUrl": F.col(url), "sourceSite": F.lit(portal.site),
        "faqs": F.transform("faqs", lambda f: F.struct(f["question"].alias("question"), T.trim_faq_dates(f["answer"]).alias("answer"))),
        "_lat": F.coalesce(F.col("p.latitude").try_cast("double"), F.col("point.latitude")), "_lng": F.coalesce(F.col("p.longitude").try_cast("double"), F.col("point.longitude")),
    })
    u = u.withColumns({
        "latitude": F.col("_lat"), "longitude": F.col("_lng"), "address": T.build_address("projectName", "locality", "p.address", "city", "pincode"),
        "sources": F.array(F.struct(F.col("sourceSite").alias("site"), F.col("sourceUrl").alias("url"))), "seoKeywords": T.seo_keywords("projectName", "city", "locality", "bhk", "propertyType"),
        "title": T.page_title("title", portal.host, "projectName", "locality", "city", "propertyType"), "seoTitle": F.col("title"),
        "h1": T.page_heading("h1", "projectName", "locality", "city", "bhk", F.transform("p.units", lambda u: T.parse_bhk(u["bhk"]))),
        "locationAdvantages": T.location_advantages("p.blurbs", "_overview"), "addressSection": T.address_section("projectName", "p.address", "p.blurbs"),
    }).withColumn("slug", F.coalesce("_name", "_base"))
    return conform(u, ("price_is_project_level",))


def _one_name(base: Column, bhk: Column, area: Column, carpet: Column) -> Column:
    """base[-Nbhk][-Asqft], which is numbered if it is taken."""
    return F.array(F.concat_ws("-", base, F.concat(bhk.cast("string"), F.lit("bhk")), F.concat(F.coalesce(area, carpet).cast("string"), F.lit("sqft"))))


def _ladder(base: Column, bhk: Column, area: Column, carpet: Column) -> Column:
    """base-Nbhk, and only if that is taken base-Nbhk-Asqft; without a count base alone."""
    room = F.coalesce(bhk, F.lit(0)) > 0
    named = F.concat(base, F.lit("-"), bhk.cast("string"), F.lit("bhk"))
    sized = F.concat(named, F.lit("-"), area.cast("string"), F.lit("sqft"))
    return F.when(room & (F.coalesce(area, F.lit(0)) > 0), F.array(named, sized)).when(room, F.array(named)).otherwise(F.array(base))
