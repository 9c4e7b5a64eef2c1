"""What the contexts of the language model must hold."""

import os
import random
from collections import Counter

import numpy as np
import pytest

from ledgerloom.llm import lm_scoring


def test_whole_token_is_a_context_without_the_class_too():
    """Six contexts were cut to four once, all tied to the class."""
    assert {(1, True), (2, True), (3, True), (4, True), (0, False), (0, True)} <= set(lm_scoring.ORDERS) and lm_scoring.ORDERS[-1] == (0, True)


def test_kinds_come_from_all_training_texts(spark):
    """The markers are exact document frequencies of more texts than the 3,000 that were sampled once."""
    texts = [" ".join(f"w{k:02}" for k in range(80) if i < 4000 + 20 * k) for i in range(5600)]
    docs = spark.createDataFrame([(i, False, t) for i, t in enumerate(texts)] + [(9000 + i, True, "unseen") for i in range(6000)], "doc_id long, held_out boolean, text string")
    assert set(lm_scoring.learn_kinds(docs).place) == {f"w{k:02}".encode() for k in range(16, 80)}


def test_markers_are_exact_though_rare_words_stay_in_their_tasks(spark):
    """Every word of every text was sent and summed up; now a slice tells of frequent words, with a bound for the others."""
    rng = random.Random(6)
    texts = [" ".join([f"r{i}x{k}" for k in range(20)] + [f"w{k:02}" for k in range(90) if rng.random() < 0.3 + k / 300]) for i in range(1200)]
    texts[:300] = ["only here " + t for t in texts[:300]]
    docs = spark.createDataFrame([(i, i % 7 == 2, t) for i, t in enumerate(texts)] + [(9000, False, None)], "doc_id long, held_out boolean, text string").repartition(3)
    count = Counter(w for i, t in enumerate(texts) if i % 7 != 2 for w in set(t.encode().split()))
    want = [w for w, _ in sorted(count.items(), key=lambda x: (-x[1], x[0]))[: lm_scoring.MARKERS]]
    for rare in (0, 1, 2, 4, 256):
        assert lm_scoring.find_markers(docs, rare) == want
    assert lm_scoring.document_counts(docs, 100).count() < 200 < 20_000 < len(count)
    assert lm_scoring.find_markers(docs.limit(0)) == []


def test_words_and_classes_of_many_texts_are_those_of_each():
    texts = ["  A b\tC\x0b\x0cthe ", None, "", " ", "\u00e9\x01 \x85x THE the", "one\r\nof of"]
    words, size = lm_scoring.split(lm_scoring.pa.array(texts))
    plain = [(t or "").encode().lower().split() for t in texts]
    assert lm_scoring.raw_of(words) == [w for t in plain for w in t] and size.tolist() == [len(t) for t in plain]
    assert lm_scoring.raw_of(words.slice(2, 3)) == [w for t in plain for w in t][2:5]
    kinds = lm_scoring.Kinds([b"the", b"of", b"none"], np.log(np.array([[0.6, 0.2], [0.1, 0.7], [0.3, 0.1], [0.5, 0.5]])))
    words = words.dictionary_encode()
    assert kinds.of(words.indices.to_numpy(), np.repeat(np.arange(len(size)), size), len(size), words.dictionary).tolist() == [kinds(t) for t in plain]


def test_a_rare_kind_has_a_class_of_its_own(spark):
    rare, common = "la lo li lu le", "the of and to in"
    docs = spark.createDataFrame([(i, False, rare if i < 4 else " ".join([common] * (1 + i % 5))) for i in range(8000)], "doc_id long, held_out boolean, text string")
    kinds = lm_scoring.learn_kinds(docs)
    assert kinds(rare.encode().split()) != kinds(common.encode().split())


def test_context_counts_are_exact_and_grow(spark):
    """Whatever the number of contexts, none shares its counts with another: checked by hand against all prefixes."""
    rng = random.Random(3)
    words = sorted({bytes(rng.choice(b"abcdefgh") for _ in range(rng.randint(1, 7))) for _ in range(30_000)})
    table = [(i % 2, i % 3, w, i % 5) for i, w in enumerate(words)]
    table += [(k, 7, w, 2) for k in range(2) for w in words[:20_000]]  # one word before that has many chunks
    rows = spark.createDataFrame([(k, b, bytearray(w), n) for k, b, w, n in table], "class long, before long, word binary, train long")
    crossed = lm_scoring.followed(rows, 3)
    chunks = lm_scoring.count_contexts(lm_scoring.chunked(crossed, 3, "class", "word", "before"), 5).collect()
    count, across = Counter(), Counter()
    for k, b, w, n in table:
        for end in range(len(w) + 2):
            count[(k, (w + b" ")[:end])] += n
            across[(b, (w + b" ")[:end])] += n
    assert sum(len(r["words"]) for r in chunks) == len(table) and len(chunks) > 5
    for r in chunks:
        found = np.frombuffer(lm_scoring.zlib.decompress(r["found"]), np.int64).reshape(-1, 9)
        tokens = [bytes(w) for w in r["words"]]
        classes, before = np.frombuffer(r["classes"], "<i8"), np.frombuffer(r["before"], "<i8")
        chunk = lm_scoring.Chunk(tokens, classes, found, [bytes(x) for x in r["back"]])
        exact = chunk.found[chunk.tokens.at[-1]][:, 8][chunk.node]
        at = 0
        for w, k, b in zip(tokens, classes.tolist(), before.tolist(), strict=True):
            for n in range(len(w) + 1):
                assert exact[at] == count[(k, (w + b" ")[: n + 1])]
                assert chunk.total[at, 0] == across[(b, (w + b" ")[:n])] and chunk.hit[at, 7] == across[(b, (w + b" ")[: n + 1])]
                at += 1
        assert at == len(exact)


def test_counts_keep_64_bits():
    """Runs of counts survive packing whatever their size; a float of 32 bits would lose the last ones."""
    runs = [[2**30 + 3, 2**30, 3, 3], [0], [2**40 + 1, 2**40 + 1, 7], [255, 256 - 1], [256, 1, 0, 0, 0], [2**62 + 1, 1]]
    size = np.array([len(r) for r in runs])
    values = np.array([x for r in runs for x in r], np.int64)
    back = lm_scoring.packed(values, size).to_pylist()
    assert lm_scoring.unpacked(back, size).tolist() == values.tolist() and len(back[1]) == 2
    none = lm_scoring.packed(values[:0], size[:0])
    assert len(none) == 0 and len(lm_scoring.unpacked([], size[:0])) == 0
    found = lm_scoring.paths(np.array([1, 1], np.uint64), np.array([97, 98]), np.array([2**30 + 1, 3]))
    assert found[0].tolist()[0] == 2**30 + 4 and found[:, 8].tolist() == [2**30 + 1, 3]


def test_word_order_counts(spark):
    """A phrase that all texts repeat is likelier than the same words in another order."""
    phrase = "north wind blows over cold water every winter morning".split()
    rng = random.Random(4)
    other = [" ".join(rng.sample(phrase, 9)) for _ in range(2)]
    ids = [i for i in range(600) if lm_scoring.zlib.crc32(str(i).encode()) % 7 != 2]
    rows = [(i, " ".join(phrase)) for i in ids] + [(i, t) for i, t in zip([k for k in range(600, 700) if lm_scoring.zlib.crc32(str(k).encode()) % 7 == 2], [" ".join(phrase), *other])]
    got = {r["doc_id"]: r["score"] for r in lm_scoring.score(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    held = [got[i] for i, _ in rows[len(ids) :]]
    assert len(held) == 3 and held[0] > held[1] + 1 and held[0] > held[2] + 1


TABLES = "/root/testdata/sf0.01"


@pytest.mark.skipif(not os.path.isdir(TABLES), reason="the tables are not there")
def test_held_out_texts_are_likelier_than_by_the_base(spark):
    got = lm_scoring.score(spark.read.parquet(f"{TABLES}/documents.parquet")).where("held_out").agg({"score": "sum", "base_score": "sum"}).first()
    assert got["sum(score)"] > 0.95 * got["sum(base_score)"]
