"""The pipeline's stages on the smallest tables, each against brute force on its own input."""

import os
import re
from collections import Counter

import pytest

import corpus_pipeline
from ledgerloom.llm import mixing, toxicity

TABLES = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.mark.skipif(not os.path.isdir(TABLES), reason="the tables are not there")
def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{TABLES}/documents.parquet")
    columns = docs.columns
    before, after = docs.toPandas(), None
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, TABLES).write.parquet(f"file://{tmp_path}/{k}")
        docs = spark.read.parquet(f"file://{tmp_path}/{k}")
        after = docs.toPandas()
        texts, left = before["text"].fillna(""), after
        if name == "toxicity":
            judged = toxicity.judged(spark.read.parquet(f"{TABLES}/documents.parquet"), spark.read.parquet(f"{TABLES}/labels.parquet")).toPandas()
            assert set(left["doc_id"]) == set(judged.loc[judged["predicted"] == 0, "doc_id"])
        elif name == "exact_dedup":
            bare = texts.str.replace(r"[\x20\x09-\x0D]+", "", regex=True)
            assert len(left) == bare.nunique() and left["text"].fillna("").str.replace(r"[\x20\x09-\x0D]+", "", regex=True).nunique() == len(left)
        elif name == "near_dedup":
            sets = {}
            for i, t in zip(before["doc_id"], texts, strict=True):
                w = t.encode().lower().split()
                sets[i] = frozenset(tuple(w[j : j + 5]) for j in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])
            parent = {i: i for i in sets}

            def root(x, parent=parent):
                while parent[x] != x:
                    x = parent[x]
                return x

            ids = sorted(sets)
            for a, i in enumerate(ids):
                for j in ids[:a]:
                    if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                        p, q = root(i), root(j)
                        parent[max(p, q)] = min(p, q)
            assert sorted(left["doc_id"]) == sorted({root(i) for i in ids})
        elif name == "mixing":
            size = lambda f: f["text"].fillna("").map(lambda t: len(WORD.findall(t)))
            assert max(Counter(left["doc_id"]).values()) <= 2
            had, has = Counter(), Counter()
            for f, c in ((before, had), (left, has)):
                for s, n in zip(f["source"], size(f), strict=True):
                    c[s] += n
            for s, _, t in mixing.targets(list(had.items())):
                assert abs(has[s] - t) <= max(60, 0.05 * t)
        else:
            pieces = Counter()
            for r in after.itertuples():
                pieces[r.doc_id] += r.length
            copies, tokens = Counter(before["doc_id"]), dict(zip(after["doc_id"], after["doc_tokens"], strict=True))
            assert pieces == Counter({i: n * int(tokens[i]) for i, n in copies.items()})
        if name != "packing":
            assert list(after.columns) == columns
        before = after


SHAPE = "doc_id long, text string, lang string, source string, n_chars long, _rid long, _sha string, copies long, tox_score string, label long"


def test_stages_on_odd_rows(spark, tmp_path):
    """Nulls in every column, blanks, copies, a long text and clashing names; all columns come through every stage but the last."""
    spark.createDataFrame([(None, None, None)], "doc_id long, quality int, toxic int").write.parquet(f"file://{tmp_path}/labels.parquet")
    long = " ".join(f"w{k}" for k in range(30_000))
    rows = [(None,) * 10, (1, None, None, None, None, 1, "a", 1, "x", 2), (2, "", "en", "s", 0, 2, "b", 2, "y", 3), (3, " \n", "en", "s", 2, 3, "c", 3, "z", 4), (4, long, "en", "s", 9, 4, "d", 4, "u", 5), (5, long + " more", "en", "t", 9, 5, "e", 5, "v", 6), (6, "one two three four five six", "en", "t", 9, 6, "f", 6, "w", 7), (6, "one two three four five six", "en", "t", 9, 6, "f", 6, "w", 7)]
    for data, name in ((rows, "odd"), ([], "empty")):
        docs = spark.createDataFrame(data, SHAPE)
        for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
            stage(spark, docs, f"file://{tmp_path}").write.parquet(f"file://{tmp_path}/{name}{k}")
            docs = spark.read.parquet(f"file://{tmp_path}/{name}{k}")
            if k < 4:
                assert docs.columns == [c.split()[0] for c in SHAPE.split(", ")]
            if name == "odd" and k == 0:
                assert docs.count() == len(rows)
            if name == "odd" and k == 1:
                assert sorted(r["_rid"] or 0 for r in docs.collect()) == [3, 4, 5, 6]
            if name == "odd" and k == 2:
                assert sorted((r["doc_id"], r["copies"], r["tox_score"]) for r in docs.collect()) == [(3, 3, "z"), (4, 4, "u"), (6, 6, "w")]
        assert docs.count() == 0 if name == "empty" else docs.count() > 0


def test_results_of_others_outlive_the_pipeline(spark):
    from ledgerloom.llm import common

    held = common.stage(spark.range(5).toDF("x"), "held")
    corpus_pipeline.drop_copies(spark, spark.createDataFrame([(1, "a")], "doc_id long, text string"), "")
    common.sweep(spark, "pipeline")
    assert held.count() == 5
