"""The index of names that match softly misses none, and components by star contraction are those of a plain search."""

import random
import time

from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerloom.operators import blocks, dedupe, identity, similar


@settings(max_examples=600, deadline=None)
@given(st.text("abc-", min_size=4, max_size=45), st.lists(st.tuples(st.integers(0, 60), st.sampled_from(["", "a", "b", "ab", "zz"]), st.integers(0, 2)), max_size=4))
def test_no_match_is_missed(rest, edits):
    a = "gaurs-" + rest.strip("-")
    b = a
    for at, put, gone in edits:
        at = 6 + at % max(1, len(b) - 5)
        b = b[:at] + put + b[at + gone :]
    if a != b and identity.soft_match(a, b):
        assert set(similar.posts(a)) & set(similar.probes(b))
        assert set(similar.posts(b)) & set(similar.probes(a))


def test_soft_join(spark):
    rng = random.Random(2)
    base = ["gaurs-" + "".join(rng.choice("abcdefgh") for _ in range(rng.randint(3, 30))) for _ in range(60)]
    slugs = sorted({s[:p] + rng.choice("xyz") + s[p + rng.randrange(2) :] for s in base for p in (len(s) - 1, len(s) // 2, 7)} | set(base) | {"", "short"})
    frame = spark.createDataFrame([(k, s) for s in slugs for k in ("one", "two") if (len(s) + (k == "one")) % 3], "k string, slug string")
    found = {tuple(r) for r in similar.soft_join(frame, frame).collect()}
    rows = [tuple(r) for r in frame.collect()]
    assert found == {(k, a, b) for k, a in rows for j, b in rows if j == k and a and b and identity.soft_match(a, b)}
    assert sum(a != b for _, a, b in found) > 50


def test_many_names_of_one_signature(spark):
    """30,000 names of one unit signature and first token; comparing all would take 450 million comparisons."""
    rng = random.Random(4)
    names = ["gaurs " + "".join(rng.choice("abcdefghijklmnoprstuv") for _ in range(rng.randint(9, 16))) for _ in range(30_000)]
    names += [n[:-2] + "w" + n[-1] for n in names[:300]]
    shape = "ord long, projectName string, city string, locality string, bhk long, superBuiltUpArea long, price long"
    data = [(k, n, "noida", "s16", 3, 900, 1) for k, n in enumerate(names)]
    began = time.time()
    left = dedupe.soft(spark.createDataFrame(data, shape)).count()
    assert 29_000 < left <= 30_000 and time.time() - began < 300


def test_components(spark):
    rng = random.Random(6)
    rows = [(rng.randrange(2), o, f"k{rng.randrange(150)}") for o in range(120) for _ in range(rng.choice([1, 1, 2]))]
    rows += [(0, 1000 + k, f"chain{k + j}") for k in range(70) for j in (0, 1)] + [(1, 2000 + k, "hot") for k in range(300)]
    found = {(r["side"], r["ord"]): r["component"] for r in blocks.components(spark.createDataFrame(rows, "side int, ord long, key string")).collect()}
    label = {}
    for side, o, k in rows:
        label[side, o] = (side, o)
    def root(x):
        while label[x] != x:
            x = label[x]
        return x
    first = {}
    for side, o, k in rows:
        label[root((side, o))] = root(first.setdefault(k, (side, o)))
    groups, expected = {}, {}
    for x in label:
        groups.setdefault(found[x], set()).add(x)
        expected.setdefault(root(x), set()).add(x)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, expected.values()))
