"""What removal of templates must find, and what it must leave."""

from ledgerloom.llm import html_main


def texts(spark, pages):
    return {r["page_id"]: r["text"] for r in html_main.extract(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}


def test_recurring_running_text_and_items_are_templates(spark):
    end = "<h3>More from us</h3><p>Subscribe to our letter</p><ul><li><a href='/x'>Sport</a></li><li>Only {i}</li></ul><blockquote>Follow us</blockquote>"
    pages = [(i, "http://h.example/p", f"<article><h1>Title {i}</h1><p>Text {i} is <b>very</b> long</p>{end.format(i=i)}</article>") for i in range(30)]
    got = texts(spark, pages)
    assert got == {i: f"Title {i} Text {i} is very long Only {i}" for i in range(30)}


def test_few_pages_are_enough_on_hosts_of_any_size(spark):
    """A section's menu on 8 pages goes, whether its host has 8 pages or 808."""
    words = lambda i: " ".join(f"w{i}x{k}" for k in range(12))
    menu = "<div><ul><li>Football</li><li>Tennis</li></ul></div>"
    small = [(i, "http://small.example/p", f"<body><p>{words(i)}</p>{menu}</body>") for i in range(8)]
    large = [(1000 + i, "http://large.example/p", f"<body><p>{words(i)}</p>{menu if i < 8 else ''}</body>") for i in range(808)]
    got = texts(spark, small + large)
    assert all("Football" not in t for t in got.values()) and got[3] == got[1003] == words(3) and len(got) == 816


def test_near_copies_are_no_template(spark):
    body = [f"word{k}" for k in range(100)]
    pages = [(i, "http://h.example/p", f"<article><h1>The headline</h1><p>{' '.join(body[:50])}</p><p>{' '.join(body[50 : 50 + i] + ['changed'] + body[51 + i :])}</p></article>") for i in range(12)]
    assert all(t.startswith("The headline word0") for t in texts(spark, pages).values())


def test_names_that_only_contain_furniture_words_are_content(spark):
    body = "<p>All of the text that this page has to tell</p>"
    pages = ["<body><div class='layout has-sidebar'>{}</div></body>", "<body><div class='content no-sidebar'>{}</div></body>", "<body><p>a few words of something else which is longer than what follows here</p><div class='elementor-widget'>{}</div></body>",
             "<body><h1 class='entry-header'>Head</h1><p>x</p>{}</body>", "<body><h1 class='header footer'>Head</h1>{}</body>", "<body><div id='menu'>{}</div></body>", "<body><div class='sidebar'><article>{}</article></div></body>", "<body><p>intro of more words than the menu</p>{}<div class='site-footer'>gone</div><div class='cookie-notice big'>gone</div><div id='nav'>gone</div></body>"]
    got = texts(spark, [(i, f"http://h{i}.example/", p.format(body)) for i, p in enumerate(pages)])
    assert all("All of the text" in t and "gone" not in t for t in got.values()) and got[3].startswith("Head") and got[4].startswith("Head")


def test_deep_and_broken_pages_take_linear_time(spark):
    """100,000 nested, unclosed or unmatched elements and 1 MB of unbalanced quotes; extra columns with clashing names."""
    pages = ["<div>x" * 100_000, "<font>x" * 100_000 + "</b>" * 50_000, "<p>" + "<font>y" * 50_000 + "<div>z" * 50_000, '<a "' * 250_000 + "<p>", "<" * 300_000, "<table>" + "<tr><td>a" * 50_000]
    rows = [(i, "http://h.example/", p, 1, "c") for i, p in enumerate(pages)]
    got = html_main.extract(spark.createDataFrame(rows, "page_id long, url string, html string, rid long, text string").repartition(3))
    found = {r["page_id"]: r["text"] for r in got.collect()}
    assert found[0] == " ".join("x" * 100_000) and found[1] == "x" * 100_000 and found[2] == "y" * 50_000 + " z" * 50_000 and found[4] == "<" * 300_000 and found[5] == " ".join("a" * 50_000)


def test_text_around_a_deleted_block_stays_apart(spark):
    menu = "<div><ul><li>Football</li><li>Tennis</li></ul></div>"
    words = lambda i, n: " ".join(f"{n}w{i}x{k}" for k in range(12))
    got = texts(spark, [(i, "http://h.example/", f"<body>{words(i, 'a')}{menu}{words(i, 'b')}<nav>x</nav>end</body>") for i in range(6)])
    assert got == {i: f"{words(i, 'a')} {words(i, 'b')} end" for i in range(6)}


def test_template_counts_against_brute_force(spark):
    """Keys of elements on four distinct texts of a host or more, copies of a text once; blocks counted by hand."""
    import random
    from collections import defaultdict

    from pyspark.sql import functions as F

    rng = random.Random(4)
    boxes = [f"<div>box {k} {' '.join(rng.choice('abcdefgh') * 4 for _ in range(5))}</div>" for k in range(12)]
    pages = []
    for i in range(60):
        text = " ".join(f"t{i if i % 6 else 6}x{k}" for k in range(40))
        pages.append((i, f"http://h{i % 3}.example/", f"<body><p>{text}</p>{''.join(b for k, b in enumerate(boxes) if (i // 3) % (k + 1) == 0)}</body>"))
    rows = spark.createDataFrame(pages, "page_id long, url string, html string").select("page_id", "url", F.xxhash64("url").alias("host"), F.col("page_id").alias("rid"), "html")
    found = html_main.parsed(rows)
    got = {r["key"] for r in html_main.templates(found, html_main.near_copies(found)).collect()}
    on = defaultdict(set)
    copies = {r["own"] for r in html_main.near_copies(found).collect()}
    for r in found.select("host", "text", F.xxhash64("host", "text").alias("own"), F.explode("blocks").alias("b")).withColumn("key", F.xxhash64("host", "b")).collect():
        on[r["key"]].add(r["own"])
    assert got == {k for k, x in on.items() if len(x - copies) >= 4 and len(x - copies) >= 0.25 * len(x)} and got


def test_roots_forms_heads_and_formulas(spark):
    """A teaser is not the text, a form around a page is no form, an article's own head stays, and so does a formula."""
    long = "All of the text that this page has to tell, in a good many words."
    pages = {
        f"<main><p>{long}</p><article>teaser</article></main>": f"{long} teaser",
        f"<body><form id='aspnetForm'><div>{long}</div><input value='x'><button>Go</button></form></body>": long,
        f"<body><form><main><p>{long}</p></main></form><form>Search <input></form></body>": long,
        f"<body><header>Site</header><article><header><h1>Head</h1><nav>menu</nav></header><p>{long}</p></article><footer>end</footer></body>": f"Head {long}",
        f"<article><p>{long} <math><mi>x</mi><mo>=</mo><mn>2</mn><annotation>x=2</annotation></math> holds</p></article>": f"{long} x=2 holds",
        f"<body><article><p>{long}</p></article><aside><article>other</article></aside><p>by</p></body>": long,
        f"<main><article><p>{long}</p></article><article><p>{long}</p></article></main>": f"{long} {long}",
        f"<main><aside>{long} {long} {long}</aside><article>short</article></main>": "short",
        f"<body><header><h1>Site</h1></header><p>{long}</p></body>": long,
    }
    got = texts(spark, [(i, f"http://h{i}.example/", p) for i, p in enumerate(pages)])
    assert got == dict(enumerate(pages.values()))


def test_a_megabyte_in_one_page_and_clashing_columns(spark):
    words = " ".join(f"w{k % 5000}" for k in range(200_000))
    rows = [(1, "http://h.example/", f"<article><p>{words}</p></article>", "x", 5), (2, None, None, "y", 6), (None, "", "  ", "z", 7)]
    found = html_main.extract(spark.createDataFrame(rows, "page_id long, url string, html string, text string, host long")).collect()
    assert {r["page_id"]: (r["text"], r["n_chars"]) for r in found} == {1: (words, len(words)), 2: ("", 0), None: ("", 0)}
