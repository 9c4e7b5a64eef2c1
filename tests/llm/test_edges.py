"""Every corpus operator on nulls, blanks, ties, repeated rows, clashing columns, and empty tables, against brute force."""

import binascii
import hashlib
import math
import random
import re
import struct
import zlib
from collections import Counter

import pytest

from ledgerloom.llm import chains, common, exact_dedup, html_main, langid, lm_scoring, mixing, near_dedup, packing, quality, toxicity, warc

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SHAPE = "doc_id long, text string, lang string, source string, n_chars long, kept boolean, rid long, score double, word string"


def corpus():
    rng = random.Random(5)
    vocabulary = {"en": ["the", "and", "of", "thing", "other", "there", "when", "house", "tree", "river"], "de": ["der", "und", "ist", "schön", "haus", "straße", "wald", "über", "nicht", "auch"]}
    docs = []
    for i in range(60):
        lang = "en" if i % 3 else "de"
        text = " ".join(rng.choice(vocabulary[lang]) + rng.choice(["", "s", "x", "er"]) for _ in range(rng.randint(20, 120)))
        docs.append((i, text.replace(" thing", "\nthing"), lang, f"s{i % 4}"))
    base = docs[7][1].split(" ")
    docs += [(100 + k, " ".join(base[:k] + ["changed"] + base[k + 1 :]), "en", "s0") for k in (3, 9)]  # near copies
    docs += [(200, docs[5][1], "en", "s1"), (201, docs[5][1].replace(" ", "\n "), "en", None), (5, docs[5][1], "en", "s1"), (5, docs[5][1], "en", "s1")]  # copies, a repeated row
    docs += [(300, None, None, None), (301, "", "en", "s2"), (302, " \t\r\n", "de", "s2"), (None, "one row without an id", "en", "s3"), (303, "word", "en", "s3"), (304, "<|endoftext|> a  b  c\n\n d 漢字 émile'll 12,5", "en", "s0")]
    docs += [(305, " ".join(f"w{j % 977}" for j in range(20_000)), "en", "s1"), (306, "x" * 30_000, "de", "s1")]  # long ones
    return [(*d, 1, True, 7, 0.5, "w") for d in docs]


@pytest.fixture(scope="module")
def rows():
    return corpus()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SHAPE).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SHAPE)


def remainder(doc_id, m):
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % m


def test_packing(docs, rows, empty):
    from tokenizers import Tokenizer

    import public_tokenizers

    whole = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    pieces = packing.pack(docs, range_tokens=20_000).collect()
    expected = Counter((d[0], tuple(whole.encode(d[1] or "", add_special_tokens=False).ids) + (1,)) for d in rows)
    by_doc = {}
    for p in pieces:
        by_doc.setdefault((p["doc_id"], p["doc_tokens"]), Counter())[(p["start"], p["length"], p["ids_crc32"])] += 1
    for (doc, ids), copies in expected.items():
        found = by_doc[(doc, len(ids))]
        covered = Counter()
        for (start, length, crc), n in found.items():
            assert binascii.crc32(struct.pack(f"<{length}I", *ids[start : start + length])) == crc
            covered.update({k: n for k in range(start, start + length)})
        assert all(covered[k] == copies for k in range(len(ids)))
    sequences = {}
    for p in pieces:
        sequences.setdefault(p["sequence_id"], []).append((p["offset"], p["length"]))
    sizes = []
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        sizes.append(at)
    assert max(sizes) <= packing.SEQ and sum(s == packing.SEQ for s in sizes) >= len(sizes) - 6
    assert packing.pack(empty).count() == 0


def test_hilbert_neighbours_touch():
    import numpy as np

    side = np.arange(8)
    grid = np.stack(np.meshgrid(side, side, side), axis=-1).reshape(-1, 3)
    path = grid[np.argsort(packing.hilbert(grid, 3))]
    assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


def test_quality_counts(docs, rows, empty, spark):
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(40)] + [(None, 1, 0), (41, None, None)], "doc_id long, quality int, toxic int")
    got = Counter((r["doc_id"], r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]) for r in quality.judged(docs, labels).collect())
    expected = Counter()
    for d in rows:
        text = d[1] or ""
        words = WORD.findall(text)
        lines = [x for x in text.split("\n") if WORD.search(x)]
        seen = Counter(tuple(words[k : k + 8]) for k in range(len(words) - 7))
        covered = {k + j for k in range(len(words) - 7) if seen[tuple(words[k : k + 8])] > 1 for j in range(8)}
        expected[(d[0], len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered), len(words) < 20 or 100 * len(covered) > 30 * len(words))] += 1
    assert got == expected
    assert quality.judged(empty, labels).count() == 0
    assert {r["kept"] for r in quality.judged(docs, labels.limit(0)).where("not base_failed").collect()} == {True}


def test_lm_scores(docs, rows, empty):
    got = lm_scoring.score(docs).collect()
    assert len(got) == len(rows)
    tokens = {id(d): (d[1] or "").encode().lower().split() + [lm_scoring.END] for d in rows}
    counts = Counter()
    for d in rows:
        if remainder(d[0], 7) != 2:
            counts.update(tokens[id(d)])
    n, v = sum(counts.values()), len(counts)
    expected = Counter((d[0], remainder(d[0], 7) == 2, len(t), sum(counts[w] > 0 for w in t), n, round(sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in t), 6)) for d in rows for t in [tokens[id(d)]])
    assert Counter((r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in got) == expected
    assert all(r["score"] < 0 for r in got)
    again = {r["doc_id"]: r["score"] for r in lm_scoring.score(docs).collect()}
    assert all(abs(again[r["doc_id"]] - r["score"]) < 1e-6 for r in got)
    assert lm_scoring.score(empty).count() == 0


def test_lm_bits_are_probabilities():
    """Over all continuations of a byte, the model's probabilities sum to one."""
    import numpy as np

    tables = np.random.default_rng(0).integers(0, 9, (len(lm_scoring.ORDERS), lm_scoring.SLOTS, 2)).astype(np.float16)
    model = lm_scoring.Model(tables, lm_scoring.start_weights(), lm_scoring.start_curve())
    total = sum(10 ** model.log10([bytes([b])], np.zeros(1, np.int64))[0] * 10 ** -_blank(model, b) for b in range(255))
    end = 10 ** model.log10([lm_scoring.END], np.zeros(1, np.int64))[0]
    assert abs(total + end - 1) < 1e-6


def _blank(model, b):
    """log10 probability of the blank after byte b."""
    import numpy as np

    parts = lm_scoring.segments([bytes([b])], np.zeros(1, np.int64))
    next(parts)
    [(_, slots, bits)] = parts
    _, gate, z = model.mix(slots, bits, False)
    p = model.refined(z, gate)
    return float(np.log10(np.where(bits, p, 1 - p))[8:].sum())


def test_shared_beginnings():
    """Counts spread over shared nodes and values gathered from them are those of each token alone."""
    import numpy as np

    rng = random.Random(8)
    words = sorted({bytes(rng.choice(b"ab") for _ in range(rng.randint(1, 5))) for _ in range(40)} | {b"a" * 31, b"a" * 40, b"a" * 40 + b"b", b"a" * 50})
    pairs = sorted((k % 2, w) for k in range(2) for w in words)
    classes, tokens = np.array([k for k, _ in pairs]), [w for _, w in pairs]
    counts = np.arange(1, len(tokens) + 1)
    shared = lm_scoring.Shared(tokens, classes)
    prefixes = Counter()
    for (k, w), c in zip(pairs, counts.tolist(), strict=True):
        for n in range(1, len(w) + 2):
            prefixes[(k, (w + b" ")[:n])] += c
    data, at = b"".join(w + b" " for w in tokens), 0
    nodes = []
    for i, (k, w) in enumerate(pairs):
        nodes += [(k, (w + b" ")[: n + 1]) for n in range(len(w) + 1) if n >= shared.lcp[i]]
        at += len(w) + 1
    assert at == len(data)
    totals = Counter()
    for node, n in zip(nodes, shared.spread(counts).tolist(), strict=True):
        totals[node] += n
    assert totals == prefixes
    values = {node: float(v) for v, node in enumerate(dict.fromkeys(nodes))}
    got = shared.gathered(np.array([values[n] for n in nodes]))
    assert got.tolist() == [sum(values[(k, (w + b" ")[:n])] for n in range(1, len(w) + 2)) for k, w in pairs]


def test_languages(docs, rows, empty):
    got = {r["doc_id"]: (r["held_out"], r["lang_pred"], r["score"]) for r in langid.identified(docs).collect()}
    for d in rows[:60]:
        assert got[d[0]][0] == (remainder(d[0], 4) == 2) and got[d[0]][1] == d[2] and 0 <= got[d[0]][2] <= 1
    assert [got[i][1] for i in (300, 301, 302)] == ["und"] * 3
    assert langid.identified(empty).count() == 0


def test_language_counts_by_hand():
    import numpy as np

    hashes, owners = langid.grams(["Ab a", "", "É1é"])
    doc, _, n = langid.counted(hashes, owners)
    plain = [Counter(), Counter(), Counter()]
    for k, text in enumerate([" ab a ", "", " é é "]):
        for size in (1, 2, 3):
            plain[k].update(text[i : i + size] for i in range(len(text) - size + 1) if text[i : i + size].strip() and " " not in text[i + 1 : i + size - 1])
    assert [sorted(n[doc == k].tolist()) for k in range(3)] == [sorted(c.values()) for c in plain]
    assert np.all(n > 0)


def test_languages_against_brute_force(spark):
    """Ranks and distances by plain counting (of sums, as ties in rank go by a hash)."""
    import numpy as np

    rng = random.Random(6)
    texts = [" ".join("".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 7))) for _ in range(40)) for _ in range(6)]
    learned = langid.profiles(spark.createDataFrame([(i, t, "xy"[i % 2]) for i, t in enumerate(texts)], "doc_id long, text string, lang string"))
    train = {k: Counter() for k in "xy"}
    for i, t in enumerate(texts):
        if remainder(i, 4) != 2:
            h, o = langid.grams([t])
            train["xy"[i % 2]].update(dict(zip(*(x.tolist() for x in langid.counted(h, o)[1:]), strict=True)))
    ranks = {k: {g: r for r, (g, _) in enumerate(sorted(c.items(), key=lambda x: (-x[1], x[0]))[: langid.TOP])} for k, c in train.items()}
    assert {(a, b): c for a, b, c in learned} == {(k, g): r for k, v in ranks.items() for g, r in v.items()}
    names, scores = langid.Profiles(learned).predict(texts)
    for t, name, score in zip(texts, names, scores, strict=True):
        _, g, n = langid.counted(*langid.grams([t]))
        own = [k for k, _ in sorted(zip(g.tolist(), n.tolist(), strict=True), key=lambda x: (-x[1], x[0]))[: langid.TOP]]
        away = {k: sum(abs(v[x] - r) if x in v else langid.TOP for r, x in enumerate(own)) for k, v in ranks.items()}
        best = min(away, key=lambda k: (away[k], k))
        assert name == best and abs(score - (1 - away[best] / (len(own) * langid.TOP))) < 1e-12
    assert isinstance(scores, np.ndarray)


def test_long_texts_are_counted_in_parts(monkeypatch):
    import numpy as np

    rng = random.Random(7)
    texts = [" ".join("".join(rng.choice("abcd") for _ in range(5)) for _ in range(n)) for n in (300, 3, 900)] + ["", "x" * 700]
    whole = [x.tolist() for x in langid.summed(np.arange(5), texts)]
    monkeypatch.setattr(langid, "SLICE_BYTES", 64)
    monkeypatch.setattr(langid.parts, "__defaults__", (32,))
    assert [x.tolist() for x in langid.summed(np.arange(5), texts)] == whole


def shingles(text, words):
    w = (text or "").encode().lower().split()
    return frozenset(tuple(w[k : k + words]) for k in range(len(w) - words + 1)) if len(w) >= words else frozenset([tuple(w)] if w else [])


@pytest.mark.parametrize("words", [4, 5])
def test_near_dups(docs, rows, empty, words):
    sets = [shingles(d[1], words) for d in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= 80 * len(a | sets[j]):
                parent[root(i)] = root(j)
    least = {}
    for i, d in enumerate(rows):
        r = root(i)
        least[r] = min(least.get(r, (True, 0)), (d[0] is None, d[0] or 0))
    expected = Counter((d[0], len(sets[i]), None if least[root(i)][0] else least[root(i)][1]) for i, d in enumerate(rows))
    got = near_dedup.near_dups(docs, words=words).collect()
    assert Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got) == expected
    assert sum(r["kept"] for r in got) == len({root(i) for i in range(len(rows))})
    assert near_dedup.near_dups(empty, words=words).count() == 0
    assert near_dedup.kept_only(docs, words=words).columns == docs.columns


def test_near_dup_chain_and_open_lists(spark):
    """A chain of slowly changing texts is one component, though its ends are unlike; blocks must find what pivots miss."""
    rng = random.Random(1)
    words = [f"w{rng.randrange(9999)}" for _ in range(200)]
    rows = []
    for i in range(60):
        rows.append((i * 7 % 60, " ".join(words)))
        words = words[2:] + [f"n{i}a", f"n{i}b"]
    got = near_dedup.near_dups(spark.createDataFrame(rows, "doc_id long, text string"), words=4).collect()
    assert {r["component_id"] for r in got} == {0} and sum(r["kept"] for r in got) == 1


def test_html(spark):
    nav = '<div class="x7"><ul><li>Home page of the site</li></ul></div>'
    pages = [(i, "http://h.example/p", f'<html><body>{nav}<article><h1>T{i} &amp; co</h1><p>Body {i}\n  text<br>more <b>bold</b><div class="box"><p>All rights</p></div></article><footer>foot</footer></body>') for i in range(12)]
    pages += [(50, "http://other.example/", f"<body>{nav}<p>Plain &lt;b&gt; page"), (51, None, None), (52, "x", ""), (53, "http://h.example/q", "<script>var a = '<p>no</p>'"), (54, "u", "<p>a<p>b<table><tr><td>c<td>d</table>")]
    got = {r["page_id"]: (r["text"], r["n_chars"]) for r in html_main.extract(spark.createDataFrame(pages, "page_id long, url string, html string").repartition(2)).collect()}
    assert got[3] == ("T3 & co Body 3 text more bold", 29)
    assert got[50][0] == "Home page of the site Plain <b> page" and got[51] == ("", 0) and got[52] == ("", 0) and got[53][0] == "" and got[54][0] == "a b c d"
    assert html_main.extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_copied_articles_are_no_template(spark):
    pages = [(i, "http://h.example/p", "<article><div class='text'><p>The same article</p></div></article>") for i in range(30)]
    got = html_main.extract(spark.createDataFrame(pages, "page_id long, url string, html string"))
    assert {r["text"] for r in got.collect()} == {"The same article"}


def test_exact_dedup(docs, rows, empty):
    groups = {}
    for d in rows:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", d[1] or ""), []).append(d)
    expected = Counter()
    for norm, members in groups.items():
        keep = min(members, key=lambda d: (-len(d[1] or ""), d[0] is None, d[0] or 0))
        expected.update((d[0], keep[0], len(members), hashlib.sha256(norm.encode()).hexdigest()) for d in members)
    got = exact_dedup.exact_dedup(docs.select("doc_id", "text"), files_per_batch=1).collect()
    assert Counter((r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in got) == expected
    assert sum(r["kept"] for r in got) == len(groups)
    assert exact_dedup.exact_dedup(empty).count() == 0 and exact_dedup.kept_only(docs).count() == len(groups)


def test_digest_collisions_are_split(spark, docs):
    """Rows of one digest but different bytes become groups of their own."""
    from pyspark.sql import functions as F

    rows = spark.createDataFrame([(1, "aa"), (2, "b b"), (3, "bb"), (4, "a a")], "doc_id long, text string")
    staged = common.stage(exact_dedup.keyed(rows).withColumn("_sha", F.lit("same")), "collide")
    groups = common.stage(staged.groupBy("_sha").agg(F.count(F.lit(1)).alias("_n"), F.max(F.struct("_len", F.bitwise_not("doc_id").alias("_not_id"), F.bitwise_not("_rid").alias("_not_rid"))).alias("_best")), "groups")
    got = exact_dedup.judged(staged, groups, ["doc_id"], "doc_id", "text").collect()
    assert {r["doc_id"]: (r["keep_id"], r["group_size"]) for r in got} == {1: (4, 2), 4: (4, 2), 2: (2, 2), 3: (2, 2)}


def test_clashing_names_pass_through(spark):
    """Columns that bear the operators' internal names come back as they were."""
    docs = spark.createDataFrame([(1, "a b c d e", "s", 5, 6, "x", 7), (2, "a b c d e", "s", 8, 9, "y", 3)], "doc_id long, text string, source string, _rid long, _sha long, _maybe string, tox_score long")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    first = {tuple(r) for r in docs.where("doc_id = 1").collect()}
    assert {tuple(r) for r in exact_dedup.kept_only(docs).collect()} == first == {tuple(r) for r in near_dedup.kept_only(docs).collect()}
    assert {tuple(r) for r in toxicity.clean_only(docs, labels).collect()} == {tuple(r) for r in docs.collect()} == {tuple(r) for r in mixing.mixed(docs).collect()}
    got = exact_dedup.exact_dedup(docs)
    assert got.columns == ["doc_id", "source", "_rid", "_sha", "_maybe", "tox_score", "keep_id", "group_size", "kept", "text_sha256"] and {r["_sha"] for r in got.collect()} == {6, 9}


def test_warc_round_trip(spark):
    big = "<p>" + "päge " * 50
    pages = [(i, f"http://h/{i % 3} \r\nx", big if i % 4 == 0 else f"<p>page {i}" + "z" * 200) for i in range(40)] + [(90, None, None), (91, "u", ""), (92, "u", "short"), (93, "u", "short"), (None, "u", big), (4, "u", big), (4, "u", big)]
    df = spark.createDataFrame([(*p, "clash") for p in pages], "page_id long, url string, html string, digest string").repartition(3)
    folders = []
    for _ in range(2):
        out = common.new_path(spark, "warc-test")
        warc.write_warc(df, out, shard_bytes=3000, roll_bytes=900)
        folders.append(out)
    got = warc.read_warc(spark, folders[0], payloads=True).collect()
    head = min(p[0] for p in pages if p[2] == big and p[0] is not None)
    expected = Counter()
    for p in pages:
        body = (p[2] or "").encode()
        first = body == big.encode() and p[0] == head
        revisit = body == big.encode() and not first
        expected[(p[0], len(body), hashlib.sha256(body).hexdigest(), "revisit" if revisit else "response", head if revisit else None)] += 1
    assert Counter((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in got) == expected
    assert all(hashlib.sha256(r["payload"]).hexdigest() == r["payload_digest"] for r in got if r["record_type"] == "response")
    listing = []
    for out in folders:
        store, root = warc._fs(out)
        with store.open_input_stream(f"{root}/manifest.json") as f:
            listing.append(f.read())
    assert listing[0] == listing[1] and listing[0].count(b'"name"') > 5
    # an id that very many rows have, and rows without an id, fill several shards, whatever the partitions
    many = spark.createDataFrame([(k, f"u{i}", f"{i} " + "y" * 300) for i in range(60) for k in (None, 7)] + [(7, "same", "z" * 300)] * 30, "page_id long, url string, html string")
    listing = []
    for n in (2, 5):
        out = common.new_path(spark, "warc-test")
        warc.write_warc(many.repartition(n), out, shard_bytes=3000)
        store, root = warc._fs(out)
        with store.open_input_stream(f"{root}/manifest.json") as f:
            listing.append(f.read())
    assert listing[0] == listing[1] and listing[0].count(b'"name"') > 10
    back = warc.read_warc(spark, out).collect()
    assert len(back) == 150 and sum(r["record_type"] == "revisit" for r in back) == 89 and sum(r["page_id"] is None for r in back) == 60
    none = common.new_path(spark, "warc-test")
    warc.write_warc(df.limit(0), none)
    assert warc.read_warc(spark, none).count() == 0


def test_mixing(docs, rows, empty):
    got = mixing.sizes_taken(docs).collect()
    assert Counter((r["doc_id"], r["size"]) for r in got) == Counter((d[0], len(WORD.findall(d[1] or ""))) for d in rows)
    again = mixing.sizes_taken(docs).collect()
    assert Counter(map(tuple, got)) == Counter(map(tuple, again))
    total = Counter()
    taken = Counter()
    target = {}
    source = {(d[0], d[1]): d[3] for d in rows}
    by_id = {d[0]: d[3] for d in rows}
    for r in got:
        s = by_id[r["doc_id"]]
        total[s] += r["size"]
        taken[s] += r["taken"]
        target[s] = r["target"]
        assert r["taken"] in (0, r["size"], 2 * r["size"])
    expected = {s: t for s, _, t in mixing.targets(list(total.items()))}
    assert source and all(abs(target[s] - expected[s]) < 1e-6 for s in total)
    for s in total:  # as near as any choice of up to two copies of each document
        sums = 1
        for size in [r["size"] for r in got if by_id[r["doc_id"]] == s] * 2:
            sums |= sums << size
        best = min(abs(k - round(target[s])) for k in range(sums.bit_length()) if sums >> k & 1)
        assert abs(taken[s] - round(target[s])) == best, s
    assert mixing.sizes_taken(empty).count() == 0
    assert mixing.mixed(docs).columns == docs.columns


def test_small_sources_are_fitted_as_near_as_can_be():
    import itertools

    import numpy as np

    rng = random.Random(3)
    for _ in range(200):
        lengths, counts = np.array(sorted(rng.sample(range(1, 30), 4))), np.array([2 * rng.randint(0, 2) for _ in range(4)])
        budget = rng.randint(0, int((lengths * counts).sum()) + 3)
        take = mixing.fit(lengths, counts, budget)
        best = min(abs(int((lengths * t).sum()) - budget) for t in itertools.product(*[range(c + 1) for c in counts]))
        assert (take >= 0).all() and (take <= counts).all() and abs(int((lengths * take).sum()) - budget) == best


def test_a_source_of_few_long_documents_takes_some_twice():
    import numpy as np

    lengths = np.array([20, 900, 1500, 1579])  # once each: 4,019 or less
    assert int((lengths * mixing.fit(lengths, np.array([2, 2, 2, 2]), 2440)).sum()) == 2440
    lengths, counts = np.array([70_000, 600_000, 610_001]), np.array([6, 4, 4])
    nearest = min(abs(70_000 * a + 600_000 * b + 610_001 * c - 2_500_000) for a in range(7) for b in range(5) for c in range(5))
    assert abs(int((lengths * mixing.fit(lengths, counts, 2_500_000)).sum()) - 2_500_000) == nearest


def test_a_row_repeated_very_often_is_cut_by_row(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BUCKET_ROWS", 50)
    docs = spark.createDataFrame([(1, "a b c", "s", 1)] * 700 + [(i, f"d{i} e f", "s", 1) for i in range(2, 300)] + [(i, f"x{i} y", None, 2) for i in range(400, 600)], "doc_id long, text string, source string, copies long").repartition(4)
    got = mixing.sizes_taken(docs).collect()
    for s in ({1, *range(2, 300)}, set(range(400, 600))):
        own = [r for r in got if r["doc_id"] in s]
        assert abs(sum(r["taken"] for r in own) - own[0]["target"]) <= 1.5 and {r["taken"] // r["size"] for r in own} <= {0, 1, 2}
    assert mixing.mixed(docs).columns == docs.columns and mixing.mixed(docs).groupBy("copies").count().count() == 2


def test_targets():
    got = mixing.targets([("b", 100), (None, 100), ("a", 10)])
    assert [g[0] for g in got] == ["a", "b", None] and got[0][2] == 20 and abs(sum(g[2] for g in got) - 315) < 1e-9 and abs(got[1][2] - 2 * got[2][2]) < 1e-9 or got[1][2] == 200


def test_toxicity(spark, empty):
    rng = random.Random(2)
    plain = [f"p{k}" for k in range(60)]
    rows, labels = [], []
    for i in range(300):
        words = [rng.choice(plain) for _ in range(30)]
        if i % 4 == 0:
            for _ in range(3):
                words[rng.randrange(30)] = rng.choice(["vile!", "Nasty", "rotten"])
        rows.append((i, " ".join(words)))
        labels.append((i, 0, int(i % 4 == 0)))
    rows += [(900, None), (901, ""), (902, "élan vile,\nNasty p1 " + "p2 " * 5000), (None, "p1 p2")]
    docs, marks = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels + [(None, 0, 1), (900, 0, None)], "doc_id long, quality int, toxic int")
    got = {r["doc_id"]: r for r in toxicity.judged(docs, marks).collect()}
    right = [got[i]["predicted"] == int(i % 4 == 0) for i in range(300) if remainder(i, 3) == 1]
    assert sum(right) >= 0.98 * len(right) and got[902]["predicted"] == 1 and got[900]["predicted"] == got[901]["predicted"] == got[None]["predicted"] == 0
    text = rows[302][1]
    assert [text[s["start"] : s["end"]].split()[0] for s in got[902]["spans"]][0] == "vile,"
    assert toxicity.judged(docs.limit(0), marks).count() == 0
    assert toxicity.judged(docs, marks.limit(0)).where("predicted = 1").count() == 0
    clean = toxicity.clean_only(docs.selectExpr("*", "1 as tox_score"), marks)
    assert clean.columns == ["doc_id", "text", "tox_score"]


def test_chains_against_all_paths():
    import itertools

    import numpy as np

    rng = np.random.default_rng(4)
    lengths = np.array([4, 1, 6, 2])
    emit, trans = rng.standard_normal(13), rng.standard_normal((2, 2))
    c = chains.Chains(lengths)
    m, states = c.marginals(emit, trans), c.viterbi(emit, trans)
    at = 0
    for n in lengths:
        scores = {}
        for path in itertools.product((0, 1), repeat=int(n)):
            scores[path] = sum(emit[at + k] * s + trans[(0, *path)[k], s] for k, s in enumerate(path))
        total = sum(map(math.exp, scores.values()))
        for k in range(n):
            assert abs(m[at + k] - sum(math.exp(v) for p, v in scores.items() if p[k]) / total) < 1e-9
        assert tuple(states[at : at + n].tolist()) == max(scores, key=scores.get)
        at += n


def test_row_filters(spark):
    df = spark.createDataFrame([(i, i) for i in range(200)] + [(None, -1)], "k long, v long")
    keys = spark.createDataFrame([(i,) for i in range(0, 400, 3)] + [(3,)], "x long")
    assert {r["v"] for r in common.semi(df, "k", keys).collect()} == set(range(0, 200, 3))
    assert {r["v"] for r in common.anti(df, "k", keys).collect()} == {-1} | {i for i in range(200) if i % 3}


@pytest.mark.parametrize("between", ["\n", "\t", " ", ", ", "3", "\u3000"])
def test_long_texts_are_cut_at_any_character_that_is_no_letter(between):
    words = [f"{'abcdefghij'[k % 10]}{'xyzäöü'[k % 6]}{'klmno'[k % 5]}" for k in range(5000)]
    text = between.join(words)
    cut = langid.parts(text, 1000)
    assert len(cut) > 10 and max(map(len, cut)) < 1100
    whole = langid.counted(*langid.grams([text]))
    pieces = Counter()
    for x in cut:
        for _, h, n in zip(*langid.counted(*langid.grams([x])), strict=True):
            pieces[int(h)] += int(n)
    assert pieces == Counter({int(h): int(n) for h, n in zip(*whole[1:], strict=True)})
