"""The archive in buckets: the same rows as one upsert after another, repeats, crashes, and what a batch writes."""

import random
from collections import Counter

from ledgerloom.operators import merge
from ledgerloom.sources.bucketed import FULL, Buckets
from ledgerloom.streaming.upsert import Archive

FIELDS = "ord long, projectName string, city string, locality string, bhk long, superBuiltUpArea long, price long, sourceUrl string, slug string"


def batch(rng, n, first):
    names = ["gaurs atulayam", "gaurs atulyam", "lodha park", "gaur city 2", None]
    return [(first + i, rng.choice(names), rng.choice(["noida", "pune", None]), rng.choice(["s16", None]), rng.choice([2, 3]), rng.choice([900, None]), rng.choice([None, 5, 7]), rng.choice([None, None, "http://x/a", f"http://x/{rng.randrange(9)}"]), f"u{rng.randrange(40)}") for i in range(n)]


def plain(df):
    return Counter(tuple(r[c] for c in df.columns if c != "ord") for r in df.collect())


def test_same_rows_as_plain_upserts(spark, tmp_path):
    rng = random.Random(3)
    shape = spark.createDataFrame([], FIELDS).schema
    store, whole = Archive(spark, f"file://{tmp_path}/store", shape, bucket_rows=8), []
    for k in range(3):
        # ord begins anew in each batch: new rows take numbers of their own
        rows = batch(rng, 20, 0) if k != 1 else []
        store.put(spark.createDataFrame(rows, shape), k)
        store.put(spark.createDataFrame(batch(rng, 3, 0), shape), 0)  # a repeat of a batch that counts changes nothing
        shifted = [(1000 * (k + 1) + r[0], *r[1:]) for r in rows]
        whole = [tuple(r)[:-1] for r in merge.upsert(spark.createDataFrame(whole, shape), spark.createDataFrame(shifted, shape)).select(*shape.names, "_status").collect()] if rows else whole
        whole.sort()
        # the order of the archive decides ties, so both are held against the same numbers
        assert plain(store.read()) == plain(spark.createDataFrame(whole, shape)), k
        assert store.state()["rows"] == len(whole) and store.read().select("ord").distinct().count() == len(whole)
    assert store.state()["buckets"] > 1 and store.last() == 2
    assert 0 < store.read(1).count() <= 20  # the version before stays


def test_a_batch_writes_what_it_touches(spark, tmp_path):
    shape = spark.createDataFrame([], FIELDS).schema
    store = Archive(spark, f"file://{tmp_path}/store", shape, bucket_rows=64)
    many = [(i, f"project {'abcdefghijklmnop'[i % 16]}{chr(97 + i // 16 % 26)}", f"city {i % 211}", "l", 2, 900, None, f"http://x/{i}", f"s{i}") for i in range(3000)]
    store.put(spark.createDataFrame(many, shape), 0)
    first = store.rows.bytes_of(0)
    assert store.state()["buckets"] >= 32
    store.put(spark.createDataFrame([(0, "brand new", "nowhere", "l", 1, 1, 5, None, "n1"), (1, *many[77][1:6], 9, None, "n2")], shape), 1)
    assert store.rows.bytes_of(1) < first / 10
    assert sorted((r["_status"], r["price"]) for r in store.latest().collect()) == [("added", 5), ("updated", 9)]
    assert store.read().count() == 3001 and store.read(0).count() == 3000
    # a crash leaves rows of a version that does not count; its number is written again
    store.rows.write(2, spark.createDataFrame([(99, *many[0][1:], 0)], FIELDS + ", _bucket long"))
    assert store.read().count() == 3001
    store.rows.write(2, store.rows.read(1, [0]))
    assert store.rows.read(2).count() == 3001


def test_buckets_over_many_versions(spark, tmp_path):
    table = Buckets(spark, f"file://{tmp_path}/t", spark.createDataFrame([], "k long, v long").schema)
    expected = {}
    for version in range(FULL + 3):
        b = version % 3
        expected[b] = version
        table.write(version, spark.createDataFrame([(b, version)], "k long, v long").selectExpr("*", "k as _bucket"))
        table.clean(version - 1)
    assert {r["k"]: r["v"] for r in table.read(version).collect()} == expected
    assert {r["k"]: r["v"] for r in table.read(version, [0, 1, 7]).collect()} == {k: v for k, v in expected.items() if k < 2}
    left = [v for v in range(version + 1) if table._made(v)]
    assert len(left) <= 5  # three buckets, and what the last versions replaced
    table.write(version + 1, spark.createDataFrame([(0, 100)], "k long, v long").selectExpr("*", "k as _bucket"), whole=True)
    assert [tuple(r) for r in table.read(version + 1).select("k", "v").collect()] == [(0, 100)] and table.read(version + 1, [0, 1]).count() == 1
