"""Decontamination, the conversation trie and phrase mining against brute force, and on odd rows."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from ledgerloom.llm import common, decontamination, phrases, prefix_trie

SHA = lambda s: hashlib.sha256(s.encode()).hexdigest()


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


# --- decontamination -------------------------------------------------------------------------------------------------


def leak_rows():
    rng = random.Random(3)
    words = [f"w{k}" for k in range(60)] + ["É", "Ü2", "naïve"]
    say = lambda n: " ".join(rng.choice(words) for _ in range(n))
    items = [(k, say(rng.randint(11, 40))) for k in range(12)] + [(12, "short Item, here"), (13, "One"), (14, None), (15, " .,- "), (None, say(15)), (3, say(12))]
    items.append((16, items[0][1]))  # two items with one text
    docs = []
    for k in range(80):
        text = say(rng.randint(0, 30))
        if k % 3 == 0:
            t = items[rng.randrange(12)][1].split(" ")
            a = rng.randrange(len(t))
            text += ", " + "  ".join(x.upper() if x[0] == "w" else x for x in t[a : a + rng.randint(5, 25)]) + "! " + say(rng.randint(0, 10))
        docs.append((k, text, 7, "x"))
    docs += [(900, None, 7, "x"), (901, "", 7, "x"), (902, "a SHORT item\there and one more one", 7, "x"), (None, items[1][1], 7, "x"), (5, items[2][1], 7, "x"), (5, items[2][1], 7, "x"), (903, " ".join([items[4][1]] * 800), 7, "x")]
    docs += [(1000 + k, items[5][1] + f" tail {k}", 7, "x") for k in range(200)]  # one passage in very many documents
    return docs, items


def leaks(docs, items, size=10):
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    held = defaultdict(set)
    for item, text in items:
        w = word.findall(lowered(text))
        for k in range(max(1, len(w) - size + 1) if w else 0):
            held[tuple(w[k : k + size])].add("" if item is None else str(item))
    sizes = {len(k) for k in held}
    out = []
    for doc, text, *_ in docs:
        w, hit, found = word.findall(lowered(text)), set(), set()
        for n in sizes:
            for k in range(len(w) - n + 1):
                if (own := held.get(tuple(w[k : k + n]))) is not None:
                    hit.update(range(k, k + n))
                    found |= own
        out.append((doc, len(w), len(hit), len(found), SHA(",".join(sorted(found))), bool(hit), hit))
    return out


@pytest.mark.parametrize("set_bytes", [decontamination.SET_BYTES, 0])
def test_decontamination(spark, set_bytes):
    docs, items = leak_rows()
    frame = spark.createDataFrame(docs, "doc_id long, text string, words int, _rid string").repartition(5)
    bench = spark.createDataFrame(items, "item_id long, text string")
    expected = leaks(docs, items)
    found = decontamination.judged(frame, bench, set_bytes=set_bytes).collect()
    assert Counter(map(tuple, found)) == Counter(x[:6] for x in expected)
    assert sum(x[5] for x in expected) > 200
    clean = decontamination.clean(frame, bench, set_bytes=set_bytes)
    assert clean.columns == frame.columns
    assert Counter((r[0], r[1]) for r in clean.collect()) == Counter((d[0], d[1]) for d, x in zip(docs, expected, strict=True) if not x[5])


def test_spans_are_cut(spark):
    docs, items = leak_rows()
    frame = spark.createDataFrame(docs, "doc_id long, text string, words int, _rid string").repartition(3)
    cut = decontamination.clean(frame, spark.createDataFrame(items, "item_id long, text string"), remove="spans").collect()
    pieces = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
    expected = Counter()
    for d, x in zip(docs, leaks(docs, items), strict=True):
        text, out, at, inside = d[1], [], 0, False
        for k, m in enumerate(pieces.finditer(text or "")):
            if k in x[6]:
                if not inside:
                    out.append(text[at : m.start()])
                inside, at = True, m.end()
            else:
                inside = False
        expected[d[0], text if not x[5] else "".join(out) + text[at:]] += 1
    assert Counter((r[0], r[1]) for r in cut) == expected
    with pytest.raises(ValueError):
        decontamination.clean(frame, frame, remove="lines")


def test_decontamination_empty(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    none = spark.createDataFrame([], "item_id long, text string")
    assert {tuple(r) for r in decontamination.judged(docs, none).collect()} == {(1, 2, 0, 0, SHA(""), False), (2, 0, 0, 0, SHA(""), False)}
    assert decontamination.judged(docs.limit(0), docs.withColumnRenamed("doc_id", "item_id")).count() == 0
    assert decontamination.clean(docs, none, "spans").count() == 2


# --- the trie of conversations ----------------------------------------------------------------------------------------


def talk(seed, convs=160):
    rng = random.Random(seed)
    rows = []
    for c in range(convs):
        if rng.random() < 0.08:
            continue
        own = [("user", "hello there")] if rng.random() < 0.6 else []
        own += [(rng.choice(["user", "assistant", None]), rng.choice(["yes", "no  thanks", None, "", f"once {rng.randrange(4)}"])) for _ in range(rng.choice([0, 1, 2, 3, 5]))]
        if c % 20 == 7:
            own = [("user", "hello there"), ("assistant", "long")] * 30 + [("user", str(rng.randrange(3)))]
        rows += [(c, None if k == 0 and c % 3 == 0 else k, role, text, 1) for k, (role, text) in enumerate(own)]
    rows += [(None, 1, "user", "nobody", 1), (3, 2, "user", "tie", 1), (3, 2, "user", "tie", 1), (3, 2, "assistant", "tie", 1)]
    rng.shuffle(rows)
    return rows


def nodes_of(rows):
    convs = defaultdict(list)
    for c, turn, role, text, _ in rows:
        if c is not None:
            convs[c].append(((turn is not None, turn or 0), role or "", text or ""))
    order = lambda t: (t[0], t[1], t[2][:64], hashlib.md5(f"{len(t[1].encode())}:{t[1]}{t[2]}".encode()).hexdigest())
    own = {c: [t[1:] for t in sorted(x, key=order)] for c, x in convs.items()}
    whole = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 4
        whole[c] = tuple(own.get(c - c % 20, [])[:h] + own[c][h:])
    members = defaultdict(list)
    for c, s in whole.items():
        for d in range(len(s) + 1):
            members[s[:d]].append(c)
    kids = Counter(s[:-1] for s in members if s)
    leaves, saved = Counter(), Counter()
    for s, m in members.items():
        for d in range(len(s) + 1):
            leaves[s[:d]] += not kids[s]
            saved[s[:d]] += (len(m) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", s[-1][1])) if s else 0
    return Counter((min(m), len(s), min(members[s[:-1]]) if s else None, len(m), kids[s], leaves[s], saved[s], SHA(",".join(str(c) for c in sorted(m) if whole[c] == s))) for s, m in members.items())


@pytest.mark.parametrize("seed, cells, turns", [(1, prefix_trie.CELLS, prefix_trie.RANGE_TURNS), (2, 200, 300), (3, 16, 100), (4, 16, 1 << 30)])
def test_trie(spark, seed, cells, turns):
    rows = talk(seed)
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, seq int").repartition(4)
    found = prefix_trie.trie(frame, cells=cells, range_turns=turns)
    assert Counter(map(tuple, found.collect())) == nodes_of(rows)


def test_trie_of_one_hot_conversation(spark):
    rows = [(c, 0, "user", "the same first turn", 0) for c in range(3000)] + [(c, 1, "user", f"x{c % 7}", 0) for c in range(0, 3000, 3)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, seq int")
    assert prefix_trie.distinct_rows(frame.drop("seq")).count() < 60
    assert Counter(map(tuple, prefix_trie.trie(frame, cells=64).collect())) == nodes_of(rows)


def test_trie_empty(spark):
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert prefix_trie.trie(none).collect() == []
    assert [tuple(r) for r in prefix_trie.trie(spark.createDataFrame([(20, 1, "u", "a b")], none.schema)).orderBy("depth").collect()][1][1] == 1
    common.sweep(spark)


# --- phrases ----------------------------------------------------------------------------------------------------------


def sayings(seed):
    rng = random.Random(seed)
    rows = []
    for k in range(400):
        lang = rng.choice(["en", "en", "de", None])
        words = [rng.choice(["The", "cat", "sat", "on", "a", "mat", "x", "É", f"rare{rng.randrange(300)}"]) for _ in range(rng.randrange(12))]
        text = " ".join(words)
        if rng.random() < 0.5:
            text += rng.choice([". ", "\n", " ", "\t"]) + "new york city hall" + rng.choice(["", " tour", "! tour", ","])
        rows.append((k, text, lang, "key"))
    return [*rows, (1000, None, "en", "key"), (1001, " .,;", "en", "key"), (1002, "a a a a a a a", "de", "key"), (1, rows[1][1], rows[1][2], "key")]


def collocated(rows, least, top):
    f, n = defaultdict(Counter), Counter()
    for _, text, lang, *_ in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered(text)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang or "und"] += len(w)
            for m in range(1, 6):
                for i in range(len(w) - m + 1):
                    f[lang or "und"][tuple(w[i : i + m])] += 1
    out = []
    for lang, own in f.items():
        cands = {p: a for p, a in own.items() if len(p) > 1 and a >= least}
        inner = {q for p, a in cands.items() for m in range(2, len(p)) for i in range(len(p) - m + 1) if a >= cands[q := p[i : i + m]]}
        scored = []
        for p, a in cands.items():
            if p not in inner:
                s, k = min((1000 * a * n[lang] // (own[p[:k]] * own[p[k:]]), k) for k in range(1, len(p)))
                scored.append((-s, -a, " ".join(p).encode(), own[p[:k]], own[p[k:]]))
        out += [(lang, r, p.decode(), -a, le, ri, n[lang], -s) for r, (s, a, p, le, ri) in enumerate(sorted(scored)[:top], 1)]
    return out


@pytest.mark.parametrize("more", [{}, {"keys": 3, "buffer": 50}, {"top": 7, "key_bytes": 10}])
def test_phrases(spark, more):
    rows = sayings(6)
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, key string").repartition(3)
    found = phrases.collocations(frame, least=8, **more).collect()
    expected = collocated(rows, 8, more.get("top", phrases.TOP))
    assert sorted(map(tuple, found)) == sorted(expected) and len(expected) > 15
    assert any(len(x[2].split()) == 5 for x in expected) == any(len(r["phrase"].split()) == 5 for r in found)


def test_tiles():
    rng = np.random.default_rng(1)
    a = np.concatenate((rng.integers(0, 3000, 20_000), rng.integers(0, 5, 20_000), [2047, 2048, 0, 255, 256]))
    b = np.concatenate((rng.integers(0, 3000, 20_000), rng.integers(0, 5, 20_000), [2047, 0, 2048, 256, 255]))
    keys, n = phrases.counted(a << 32 | b)
    assert dict(zip(keys.tolist(), n.tolist(), strict=True)) == Counter((a << 32 | b).tolist()) and len(set(keys.tolist())) == len(keys)


def test_packed_ids():
    for ids, kept in (([], []), ([1], []), ([1, -1, 2], []), ([1, 2, -1, -1, 3, -1, 4, 5, 6], [1, 2, -1, 4, 5, 6]), ([-1, 7, 8, -1], [7, 8, -1])):
        assert np.frombuffer(phrases.packed(np.array(ids, np.int64)), "<i4").tolist() == kept


def test_scores_beyond_64_bits(spark):
    huge = 3 * 10**12
    before = spark.createDataFrame([("en", 0, huge, ["a"], [huge], [huge]), ("en", 1, huge, ["b"], [huge], [huge])], "lang string, id long, f long, words array<string>, pre array<long>, suf array<long>")
    [r] = phrases.longer(spark.createDataFrame([("en", 0, 1, 2 * 10**12)], "lang string, id long, key long, f long"), before).collect()
    assert (r["words"], r["pre"], r["suf"]) == (["a", "b"], [huge, 2 * 10**12], [huge, 2 * 10**12])
    rows = spark.createDataFrame([("x", 2 * 10**12, 4 * 10**13, r["pre"], r["suf"])], "phrase string, f long, n long, pre array<long>, suf array<long>")
    score = rows.select(phrases.lowest_cut("f", "n").alias("x")).first()["x"]
    assert score["score"] == 1000 * 2 * 10**12 * 4 * 10**13 // (huge * huge)


def test_long_texts_and_no_rows(spark, monkeypatch):
    text = ". ".join(["one two three"] * 30)
    whole = sorted(phrases.tokens([text.encode()]))
    monkeypatch.setattr(common, "SLICE_BYTES", 40)
    cut = phrases.parts(text.encode())
    assert len(cut) > 5 and sorted(t for p in cut for t in phrases.tokens([p]) if t != b".") == [t for t in whole if t != b"."]
    assert phrases.collocations(spark.createDataFrame([], "text string, lang string")).count() == 0
    assert phrases.collocations(spark.createDataFrame([("rare words here", "en")], "text string, lang string")).count() == 0
