"""Pages and payloads that are cut, mixed up, nested too deeply or of the wrong types: nothing fails, and time stays in proportion."""

import json
import random
import time

import pytest
from pyspark.sql import functions as F

from ledgerloom.sources import html, portals

LONG = "The project stands near the expressway and " + "has many gardens with old trees and quiet paths, " * 4
PUSHED = {"projectName": "Sky Park", "projectUrl": "sky-park", "builder": {"name": "Acme"}, "BhK_Details": [{"bhk_type": "3 BHK", "bhk_Area": "1,500", "price": 2.5, "priceUnit": "Cr"}], "Amenities": ["Gym", {"name": "Pool"}], "projectGallery": [{"url": "http://i/1.jpg"}], "highlight": {"highlights": [{"highlight_Point": "near"}], "education": [{"name": "school"}]}}
PLANS = {"data": {"configurations": [{"bedroom": "2", "tuples": [{"areaType": [{"id": "CARPET", "area": {"min": 800}}, {"id": "SBA", "area": {"min": 1100}}], "price": {"value": 7_500_000}}]}]}}
STATE = {"props": {"page": {"name": "Sky Park", "developer_name": "Acme", "inventory_configs": [{"apartment_type": "2 BHK", "carpet_area": 700, "price": 5_000_000}]}}}
LD = {"@type": "Product", "name": "Sky Park", "brand": {"name": "Acme"}, "offers": {"lowPrice": "7500000"}, "mainEntity": [{"name": "What is it?", "acceptedAnswer": {"text": "A very tall tower."}}]}
ODD = [None, 5, -1.5, True, "", "text", [], {}, [None], ["CARPET"], {"min": None}, [[1]], float("nan"), "\ud800", 10**30]


def changed(rng, value):
    """``value`` with a part of it replaced by something else."""
    if not isinstance(value, (dict, list)) or not value or rng.random() < 0.15:
        return rng.choice(ODD)
    if isinstance(value, list):
        k = rng.randrange(len(value))
        return [changed(rng, x) if i == k else x for i, x in enumerate(value)]
    k = rng.choice(list(value))
    return {n: changed(rng, x) if n == k else x for n, x in value.items()}


def page_of(rng):
    data = [changed(rng, x) if rng.random() < 0.9 else x for x in (PUSHED, PLANS, STATE, LD)]
    pushed, plans, state, ld = (json.dumps(x) for x in data)
    text = f"<html><head><title>t</title><script type='application/ld+json'>{ld}</script></head><body><h1>Sky Park Sector 8, Noida</h1><h2>What is it?</h2><p>{LONG}</p><script>self.__x.push([1,{json.dumps(pushed)}])</script><script>var a={{\"floorPlans\":{plans}}}; x={pushed}</script><script id=\"__NEXT_DATA__\" type=\"j\">{state}</script><div class='amenities'><ul><li>Gym</li></ul></div><img src='//img.p.example/1.jpg'>2 BHK flat 900 sq ft About Acme Homes</body></html>" + "y" * 5000
    for _ in range(rng.randrange(4)):  # and of the text
        a = rng.randrange(len(text) + 1)
        text = rng.choice([text[:a], text[:a] + rng.choice(["<![foo bar]>", "<!x", "<!--", "<![CDATA[", "</p></div></div>", '"', "{", "[" * 2000, "\\", "<a", "&#xD800;", "\x00", "<?php", "</"]) + text[a:], text[:a] + text[a + rng.randrange(40) :]])
    return text


@pytest.mark.parametrize("kind", ["pushed", "plans", "state", "inline", "text"])
def test_a_thousand_changed_pages(kind):
    rng, portal = random.Random(kind), portals.registry({kind: "p.example"})[kind]
    for _ in range(1000):
        payload, extras = portal.read(page_of(rng))
        assert (payload is None) == (extras is None)
        if payload is not None:
            json.loads(payload)
            payload.encode()
            json.dumps(extras, ensure_ascii=False).encode()


def test_changed_pages_in_spark(spark):
    rng = random.Random(9)
    pages = spark.createDataFrame([(f"https://p.example/x-{k}", page_of(rng)) for k in range(60)] + [("https://p.example/none", None)], "url string, html string")
    for kind, portal in portals.registry(dict.fromkeys(("pushed", "plans", "state", "inline", "text"), "p.example")).items():
        portals.units(pages, portal).write.format("noop").mode("overwrite").save()
        assert kind
    html.extras(pages).write.format("noop").mode("overwrite").save()


def test_odd_payloads():
    deep = "[" * 100_000
    read = lambda kind, text: json.loads(portals.registry({kind: "p.example"})[kind].payload(text + " " * 5000))
    plans = lambda x: f'<script>{{"floorPlans":{json.dumps({"data": {"configurations": x}})}}}</script>'
    assert read("plans", plans([{"tuples": [None]}, None, {"tuples": 3}, {"bedroom": "2", "tuples": [{"areaType": ["CARPET"]}]}]))["units"] == [{"bhk": "2", "carpet": None, "super": None, "bathrooms": None, "price": None, "price_unit": None}]
    assert read("plans", f'{{"floorPlans":{deep}')["units"] == []
    # equal as numbers: one unit
    area = lambda x: [{"id": "CARPET", "area": {"min": x}}]
    assert len(read("plans", plans([{"bedroom": 3, "tuples": [{"areaType": area(900)}]}, {"bedroom": "3 BHK", "tuples": [{"areaType": area("900")}]}, {"bedroom": "3", "tuples": [{"areaType": area("901")}]}]))["units"]) == 2
    assert read("pushed", f"<script>self.x.push([1,{json.dumps(json.dumps({'projectName': 'Sky Park', 'BhK_Details': 5, 'pad': 'x' * 100}))}])</script>")["units"] == []
    assert html.page_extras("<p>a</p><![foo bar]><h1>b</h1>")["h1"] == "b"
    # the inline portal takes every written unit, the text portal the first 30
    many = '{"projectName":"Sky Park"}' + "".join(f" {k} BHK Flat {k + 500} sq ft," for k in range(1, 60))
    assert len(read("inline", many)["units"]) == 59 and len(read("text", "<h1>x</h1>" + many)["units"]) == 30


def test_time_in_proportion():
    def seconds(work, n):
        began = time.time()
        work(n)
        return time.time() - began

    headings = lambda n: html.page_extras("<div>" + "<h2>What is it?</h2><p>some answer of a few words</p>" * n + "</div>")
    markers = lambda n: portals._inline("".join(f'{{"projectName":"p{k}","a":{{"b":[1,2,{{"c":"{"z" * 50}"}}]}}}} ' for k in range(n)))
    ends = lambda n: html.page_extras("<b>" * n + "</i>" * n)
    for work, n in ((headings, 2000), (markers, 400), (ends, 4000)):
        assert seconds(work, 4 * n) < 12 * max(0.05, seconds(work, n))


def test_objects_before_as_by_every_brace():
    """Against the plain rule: each brace within reach of each marker."""
    rng = random.Random(8)
    for _ in range(300):
        text = page_of(rng)
        plain = {json.dumps(v, sort_keys=True) for m in range(len(text)) if text.startswith('"projectName"', m) for b in range(max(0, m - 8000), m) if text[b] == "{" and isinstance(v := portals.json_at(text, b), dict) and "projectName" in v}
        assert {json.dumps(v, sort_keys=True) for v in portals.objects_before(text, '"projectName"')} == plain
    assert F is not None
