"""Pairs of words in shards: counts, costs and disk."""

import os
import random
import subprocess
from collections import Counter

import numpy as np
import pytest

from ledgerloom.llm import common, lm_scoring
from ledgerloom.llm import lm_shards as S

LONG = "x" * 90


def _texts():
    rng = random.Random(5)
    words = ["".join(rng.choice("abc\x01~") for _ in range(rng.randint(1, 5))) for _ in range(300)] + ["the"] * 90 + [LONG, LONG + "yz", "X" * 70]
    return [(i, i % 7 == 2, " ".join(rng.choices(words, k=rng.randint(0, 30)))) for i in range(400)] + [(None, False, None), (400, True, "new the unseen")]


def _kinds():
    """Two classes."""
    return lm_scoring.Kinds([b"the"], np.log(np.array([[0.9, 0.1], [0.5, 0.5]])))


def _bounds():
    h = lm_scoring.Hashes()
    return sorted([(b"ab ", 0), (b"the ", h[b"the"] % (1 << 64)), (b"the ", max(h[b"a"] % (1 << 64), 1 << 63)), (b"~a ", 3)])


def _informed(spark, bounds):
    docs = spark.createDataFrame(_texts(), "doc_id long, held_out boolean, text string")
    found = S.pieces(docs.repartition(3), _kinds(), bounds).cache()
    shards = S.merged(found)
    return found, S.informed(shards, S.answers(S.asks(shards, bounds, len(bounds) + 1)))


@pytest.mark.parametrize("bounds", [[], _bounds()])
def test_contexts_of_shards_count_all_shards(spark, bounds):
    _, informed = _informed(spark, bounds)
    hashes, kinds, pairs = lm_scoring.Hashes(), _kinds(), Counter()
    across, prefix, classed, short = Counter(), Counter(), Counter(), Counter()
    for _, held, text in _texts():
        tokens = (text or "").encode().lower().split()
        k = kinds(tokens)
        for h, w in lm_scoring.joined([*tokens, lm_scoring.END], hashes):
            t = lm_scoring.token_bytes(w)
            pairs[(k, h % (1 << 64), t)] += not held
            for n in range(len(t) + 1):
                across[(h % (1 << 64), t[:n])] += not held
                prefix[t[:n]] += not held
                classed[(k, t[:n])] += not held
                if n >= 2:
                    short[(k, t[n - 2 : n])] += not held
    rows, seen = Counter(), 0
    for shard, _ in S.shards_of(informed.toArrow().to_batches(), bounds, len(bounds) + 1):
        texts = [bytes(shard.bytes[a : a + n]) for a, n in zip(shard.start, shard.size)]
        for t, b, k, n in zip(shard.t, shard.b, shard.k, shard.n):
            rows[(int(k), int(shard.befores[b]), texts[t])] += int(n)
        bytes_left = np.zeros(len(shard.t), np.int64)
        for a, b in shard.batches():
            depth = Counter()
            for own, *told in shard.followed(a, b):
                for i, r in enumerate(own.tolist()):
                    t, h = texts[shard.t[r]], int(shard.befores[shard.b[r]])
                    if len(told) == 2:
                        assert told[0] == depth[r] and told[1][i] == across[(h, t[: told[0]])] <= 1 and across[(h, t)] == told[1][i]
                        bytes_left[r] += len(t) - told[0]
                    else:
                        each, nodes, path, _ = told
                        assert path[each[i], 0] == across[(h, t[: depth[r]])] and path[each[i], 8] == across[(h, t[: depth[r] + 1])]
                        assert shard.data[nodes[each[i]]] == t[depth[r]]
                        depth[r] += 1
                        bytes_left[r] += 1
                        seen += 1
        assert (bytes_left == shard.size[shard.t]).all()
        for i, (t, k) in enumerate(zip(*shard.last)):
            for j in range(shard.size[t]):
                node = shard.nodes[shard.shared.start[i] + j]
                for row, table in ((-1, classed), (-2, prefix)):
                    path = shard.found[shard.at[row, node]]
                    key = (lambda n: (int(k), texts[t][:n])) if row == -1 else (lambda n: texts[t][:n])
                    assert path[0] == table[key(j)] and path[8] == table[key(j + 1)]
                if j:
                    assert shard.found[shard.at[0, node], 8] == short[(int(k), texts[t][j - 1 : j + 1])]
    assert rows == pairs and seen > 1000


def test_costs_do_not_depend_on_shards(spark):
    """A frequent token that several shards hold, and one shard, give the same sums."""
    got = []
    for bounds in ([], _bounds()):
        found, informed = _informed(spark, bounds)
        told = S.costs(informed, bounds, len(bounds) + 1, lm_scoring.start_weights(), lm_scoring.start_curve())
        rows = S.scored(found, told, [0.0] * lm_scoring.CLASSES, 10, 10, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, bits_per_byte double").collect()
        totals = S.learned(informed, bounds, len(bounds) + 1)[2:]
        got.append(({r["doc_id"]: (r["held_out"], r["n_tokens"], r["n_known"], round(r["base_score"], 6), round(r["score"], 2)) for r in rows}, totals[0], totals[1], totals[2].tolist()))
    assert got[0] == got[1] and len(got[0][0]) == len(_texts())


TABLES = "/root/testdata/sf0.01"


@pytest.mark.skipif(not os.path.isdir(TABLES), reason="the tables are not there")
def test_what_is_staged_follows_the_pairs(spark, monkeypatch):
    """Staged in all were 35 MB for these texts, as each pair was a row with a hash of 8 bytes, once for each context and block."""
    sizes, stage = [], common.stage

    def weighed(df, *a):
        out = stage(df, *a)
        sizes.append(int(subprocess.run(["du", "-sk", out._staged_path.removeprefix("file://")], capture_output=True, text=True, check=True).stdout.split()[0]))
        return out

    monkeypatch.setattr(common, "stage", weighed)
    assert lm_scoring.score(spark.read.parquet(f"{TABLES}/documents.parquet")).count() == 1000
    assert sum(sizes) < 20_000


@pytest.mark.skipif(not os.path.isdir(TABLES), reason="the tables are not there")
def test_shards_are_put_together_in_rounds(spark, monkeypatch):
    """Shards, answers and what is made of them were all staged, and shuffled, at once; more rounds, more of them are gone by then."""
    held, stage = {}, common.stage

    def weighed(df, name, *a):
        out = stage(df, name, *a)
        held[out._staged_path] = name
        here = [p for p in held if os.path.isdir(p.removeprefix("file://"))]
        at.append((name, Counter(held[p] for p in here)))
        return out

    at = []
    monkeypatch.setattr(common, "stage", weighed)
    monkeypatch.setattr(S, "SHARD_BYTES", 200_000)
    assert lm_scoring.score(spark.read.parquet(f"{TABLES}/documents.parquet")).count() == 1000
    made = [here for name, here in at if name == "lm-contexts"]
    assert len(made) == S.ROUNDS and [x["lm-shards"] for x in made] == list(range(S.ROUNDS, 0, -1))
    assert at[-1] == ("lm-costs", Counter({"lm-contexts": S.ROUNDS, "lm-costs": 1}))


def test_parts_of_keys_keep_contexts_whole():
    """Keys are dealt by range, a slice a part, so a shard is not searched once for each of them; hashes that rise survive their planes."""
    key = np.unique(np.random.default_rng(2).integers(0, 1 << 64, 5000, np.uint64) | np.uint64(3))
    key = np.unique(np.concatenate((key, key ^ np.uint64(1), key ^ np.uint64(200))))
    for parts in (1, 2, 7, 300):
        ends = S._ends(key, parts)
        assert ends[0] == 0 and ends[-1] == len(key) and len(ends) == parts + 1 and ends == sorted(ends)
        assert all((key[e - 1] >> np.uint64(8)) != (key[e] >> np.uint64(8)) for e in ends[1:-1] if 0 < e < len(key))
    assert (S.unplaned(S.planes(key)) == key).all() and len(S.unplaned(S.planes(key[:0]))) == 0


def test_a_context_within_the_token_is_weighed_once(spark, monkeypatch):
    """Logits of contexts within a token were taken anew for each node and order that meets them."""
    _, informed = _informed(spark, _bounds())
    weighed, leaning = [], lm_scoring.leaning

    def counted(path, leave_out):
        weighed.append(len(path))
        return leaning(path, leave_out)

    monkeypatch.setattr(lm_scoring, "leaning", counted)
    for shard, _ in S.shards_of(informed.toArrow().to_batches(), _bounds(), len(_bounds()) + 1):
        weighed.clear()
        told = [x for a, b in shard.batches() for x in shard.followed(a, b)]
        across = sum(int((x[3 + 1] > 0).sum()) for x in told if len(x) == 5)
        S.learn(shard)
        assert sum(weighed) <= len(shard.key) + across + len(shard.data)
