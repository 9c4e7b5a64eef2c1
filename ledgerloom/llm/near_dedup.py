"""MinHash near-duplicates by an inverted join over signature coordinates.

Every class of equal shingle sets has a signature of ``K`` MinHash coordinates and is posted under its
(coordinate, value) pairs. Two sets of similarity 0.8 agree in at least ``MATCHES`` coordinates but for
about one pair in 10**8, and then share a posting among the rarest s - MATCHES + 1 of each one's s
pairs that occur twice or more (prefix filter). Classes are linked only after a comparison of their
full sets.

Links that join what is joined already are never looked for (skip merging). First each class is
compared with one partner, the pivot with which it shares most postings; that joins most of a large
group in linear work (ROUNDS repeats it with other pivots). Posting lists that still hold several components are then merged
exactly: all their members outside the list's largest component against all members, in blocks of
about ``BLOCK`` by ``BLOCK`` classes or ``BLOCK_BYTES`` of sets, each pair under the first coordinate that
it shares. A block reports at most one link for each member. That is linear for copies of one text; for many
*unlike* texts that share a value (a common passage) and are no copies, the comparisons of signatures grow with the
square of their number, in blocks that run side by side.

Defined cases: a null or blank text has no shingles, is linked with nothing and is its own
component; fewer words than a shingle make one shingle of all words; copies share a class; repeated
rows (same doc_id) keep one; a null doc_id counts as the largest; an empty table gives an empty
result. A very long text is hashed whole in one task (about 30 bytes of memory a byte of text) and its set, 8 bytes
a shingle, is one row.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm import common as C
from ledgerloom.llm.components import components

K, MATCHES = 48, 22
ROUNDS = 1
BLOCK, BLOCK_BYTES = 2048, 16 << 20

_M = np.uint64


def _constants(seed: int, n: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(0, 1 << 64, n, dtype=np.uint64)


def _mix(x: np.ndarray) -> np.ndarray:
    x ^= x >> _M(32)
    x *= _M(0xD6E8FEB86659FD93)
    x ^= x >> _M(32)
    return x


def shingle_hashes(texts: list[bytes], words: int, memo: C.Memo) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all shingles of all texts one after the other, and how many each text has; ``memo``: hashes of words."""
    lists = [x.lower().split() for x in texts]
    n = np.array([len(x) for x in lists], np.int64)
    total = int(n.sum())
    look = memo.__getitem__
    h = np.fromiter((look(w) for x in lists for w in x), np.uint64, total)
    factors = _constants(words, words) | _M(1)
    long_enough = n >= words
    counts = np.where(long_enough, n - words + 1, (n > 0).astype(np.int64))
    starts = np.concatenate(([0], np.cumsum(n)[:-1])) if len(n) else np.zeros(0, np.int64)
    rolled = np.zeros(max(0, total - words + 1), np.uint64)
    for k in range(words):
        rolled += h[k : k + len(rolled)] * factors[k]
    out = np.zeros(int(counts.sum()), np.uint64)
    at = np.concatenate(([0], np.cumsum(counts)))
    # positions of the shingles of texts that are long enough
    if long_enough.any():
        s, c = starts[long_enough], counts[long_enough]
        inner = np.arange(int(c.sum())) - np.repeat(np.cumsum(c) - c, c)
        out[np.repeat(at[:-1][long_enough], c) + inner] = _mix(rolled[np.repeat(s, c) + inner])
    for i in np.flatnonzero(~long_enough & (n > 0)):
        digest = hashlib.blake2b(b" ".join(lists[i]), digest_size=8, person=b"short").digest()
        out[at[i]] = int.from_bytes(digest, "little")
    return out, counts


def signatures(docs: DataFrame, words: int, seed: int) -> DataFrame:
    """rid, doc_id, n, set_hash (null for an empty set), sig of every row."""
    flip, mult = _constants(seed, K), _constants(seed + 1, K) | _M(1)
    schema = pa.schema([("rid", pa.int64()), ("doc_id", pa.int64()), ("n", pa.int64()), ("set_hash", pa.binary()), ("sig", pa.list_(pa.int32()))])

    def run(batches):
        memo = C.Memo(xxhash.xxh64_intdigest)
        for batch in C.slices(batches):
            hashes, counts = shingle_hashes(C.raw(batch.column("text")), words, memo)
            at = np.concatenate(([0], np.cumsum(counts)))
            n, keys = [], []
            for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
                own = np.unique(hashes[a:b])
                n.append(len(own))
                keys.append(hashlib.blake2b(own.tobytes(), digest_size=16).digest() if b > a else None)
            full = np.flatnonzero(counts)
            sig = np.zeros((len(counts), K), np.int32)
            if len(full):
                for k in range(K):
                    v = (((hashes ^ flip[k]) * mult[k]) >> _M(32)).astype(np.uint32)
                    sig[full, k] = np.minimum.reduceat(v, at[:-1][full]).view(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(counts) + 1, dtype=np.int32) * K), pa.array(sig.ravel()))
            yield pa.record_batch([batch.column("rid"), batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(keys, pa.binary()), lists], schema=schema)

    return docs.mapInArrow(run, "rid long, doc_id long, n long, set_hash binary, sig array<int>")


def shingle_sets(docs: DataFrame, words: int) -> DataFrame:
    """rid and the sorted distinct shingle hashes, 8 bytes each."""
    schema = pa.schema([("rid", pa.int64()), ("set", pa.binary())])

    def run(batches):
        memo = C.Memo(xxhash.xxh64_intdigest)
        for batch in C.slices(batches):
            hashes, counts = shingle_hashes(C.raw(batch.column("text")), words, memo)
            at = np.concatenate(([0], np.cumsum(counts))).tolist()
            yield pa.record_batch([batch.column("rid"), pa.array([np.unique(hashes[a:b]).tobytes() for a, b in zip(at[:-1], at[1:], strict=True)], pa.binary())], schema=schema)

    return docs.mapInArrow(run, "rid long, set binary")


def similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """100 * intersection >= percent * union, for sorted distinct arrays."""
    if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    both = np.concatenate((a, b))
    both.sort()
    common = int(np.count_nonzero(both[1:] == both[:-1]))
    return 100 * common >= percent * (len(a) + len(b) - common)


def _confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets are similar."""
    x = pairs.join(sets.select(F.col("rid").alias("a"), F.col("set").alias("set_a")), "a")
    x = x.join(sets.select(F.col("rid").alias("b"), F.col("set").alias("set_b")), "b")

    def run(batches):
        for batch in batches:
            ok = [similar(np.frombuffer(p, np.uint64), np.frombuffer(q, np.uint64), percent) for p, q in zip(batch.column("set_a").to_pylist(), batch.column("set_b").to_pylist(), strict=True)]
            yield batch.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))

    return x.select("a", "b", "set_a", "set_b").mapInArrow(run, "a long, b long")


def _merge_block(percent: int):
    def run(frame: pd.DataFrame) -> pd.DataFrame:
        """Links between the outer members (side 0) and all members (side 1) of a posting list, one for each merge."""
        outer, inner = frame[frame["side"] == 0], frame[frame["side"] == 1]
        parent: dict[int, int] = {}

        def root(x: int) -> int:
            while parent.setdefault(x, x) != x:
                parent[x] = x = parent[parent[x]]
            return x

        links = []
        if len(outer) and len(inner):
            coordinate = int(frame["k"].iloc[0])
            sig_a, sig_b = np.stack(outer["sig"].to_numpy()), np.stack(inner["sig"].to_numpy())
            posted = lambda f: (f["mask"].to_numpy(np.int64)[:, None] >> np.arange(K) & 1).astype(bool)
            pos_a, pos_b = posted(outer), posted(inner)
            lab_a, lab_b = outer["label"].tolist(), inner["label"].tolist()
            cid_a, cid_b = outer["cid"].tolist(), inner["cid"].tolist()
            set_b = [np.frombuffer(s, np.uint64) for s in inner["set"]]
            size_b = np.array([len(s) for s in set_b])
            for i in range(len(cid_a)):
                own = np.frombuffer(outer["set"].iloc[i], np.uint64)
                equal = sig_b == sig_a[i]
                first = (equal & pos_b & pos_a[i]).argmax(axis=1)
                n = equal.sum(axis=1)
                fit = (n >= MATCHES) & (first == coordinate) & (100 * np.minimum(size_b, len(own)) >= percent * np.maximum(size_b, len(own)))
                some = np.flatnonzero(fit)
                for j in some[np.argsort(-n[some], kind="stable")].tolist():
                    p, q = root(lab_a[i]), root(lab_b[j])
                    if p != q and similar(own, set_b[j], percent):
                        parent[max(p, q)] = min(p, q)
                        links.append((cid_a[i], cid_b[j]))
        return pd.DataFrame(links, columns=["a", "b"]).astype("int64")

    return run


def _relabel(postings: DataFrame, labels: DataFrame) -> DataFrame:
    joined = postings.join(labels.select(F.col("node").alias("cid"), F.col("label").alias("_l")), "cid", "left")
    return joined.select("k", "v", "cid", F.coalesce("_l", "cid").alias("label"))


def near_dups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = 5, percent: int = 80, seed: int = 3) -> DataFrame:
    """Per row of ``docs``: doc_id, _rid, n_shingles, component_id, kept."""
    rows = docs.select(F.monotonically_increasing_id().alias("rid"), F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return _near_dups(C.stage(rows, "near-rows", "zstd"), words, percent, seed)


def _near_dups(rows: DataFrame, words: int, percent: int, seed: int) -> DataFrame:
    """``rows``: rid, doc_id, text; they are read twice, so they are staged and rid is the same each time."""
    signed = C.stage(signatures(rows, words, seed), "near-signatures")
    order = F.struct(F.col("doc_id").isNull().alias("x"), F.col("doc_id"), F.col("rid"))
    classes = C.stage(signed.where("set_hash is not null").groupBy("set_hash").agg(F.min("rid").alias("cid"), F.min(order).alias("best")), "near-classes")
    reps = signed.join(classes.select("cid"), F.col("rid") == F.col("cid"), "left_semi")
    pairs = C.stage(reps.select(F.col("rid").alias("cid"), F.posexplode("sig").alias("k", "v")), "near-pairs")
    # what a (k, v) pair has in all is staged before it meets its rows again: then Spark can split a pair with very many rows
    twice = C.stage(pairs.groupBy("k", "v").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "near-twice")
    posted = pairs.join(twice, ["k", "v"]).groupBy("cid").agg(F.sort_array(F.collect_list(F.struct("n", "k", "v"))).alias("p")).where(F.size("p") >= MATCHES)  # at most K a class
    posted = posted.select("cid", F.expr(f"slice(p, 1, size(p) - {MATCHES - 1})").alias("p"))
    posted = C.stage(posted, "near-posted")
    C.unstage(pairs, twice)
    postings = posted.select("cid", F.explode("p").alias("p")).select("p.k", "p.v", "cid")
    shared = C.stage(postings.groupBy("k", "v").agg(F.count(F.lit(1)).alias("n")).where("n > 1").drop("n"), "near-shared")
    postings = C.stage(postings.join(shared, ["k", "v"]).select("k", "v", "cid"), "near-postings")
    C.unstage(shared)
    links = None
    if not postings.isEmpty():
        links = _link(rows, signed, posted, postings, words, percent)
    C.unstage(postings, posted)
    first = signed.select("rid", "doc_id", "n", "set_hash").join(classes, "set_hash", "left")
    if links is not None:
        labels = C.stage(components(links), "near-labels")
        named = classes.select("cid", "best").join(labels.select(F.col("node").alias("cid"), "label"), "cid")
        heads = named.groupBy("label").agg(F.min("best").alias("head"))
        names = named.join(heads, "label").select("cid", "head")
        first = first.join(names, "cid", "left").withColumn("best", F.coalesce("head", "best"))
    best = F.coalesce("best", order)
    return first.select(F.col("doc_id"), F.col("rid").alias("_rid"), F.col("n").alias("n_shingles"), best["doc_id"].alias("component_id"), (best["rid"] == F.col("rid")).alias("kept"))


def _link(rows: DataFrame, signed: DataFrame, posted: DataFrame, postings: DataFrame, words: int, percent: int) -> DataFrame:
    """Links between classes (a, b) that join all that are similar."""
    some = postings.select("cid").distinct()
    sets = C.stage(shingle_sets(C.semi(rows.select("rid", "text"), "rid", some), words), "near-sets")
    current = postings.withColumn("label", F.col("cid"))
    links = None
    for r in range(ROUNDS):
        # one pivot for each posting list, another each round; a class meets the pivot with which it shares most lists
        lot = F.col("cid") if r == 0 else F.xxhash64(F.lit(r), "cid")
        pivots = current.groupBy("k", "v").agg(F.min(F.struct(lot.alias("lot"), F.col("cid"), F.col("label"))).alias("p"), F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo != hi")
        pivots = C.stage(pivots.select("k", "v", "p"), "near-pivots")
        meet = current.join(pivots, ["k", "v"]).where("label != p.label").groupBy("cid", F.col("p.cid").alias("b")).agg(F.count(F.lit(1)).alias("n"))
        one = meet.groupBy("cid").agg(F.max(F.struct("n", F.bitwise_not("b").alias("nb"))).alias("m")).select(F.col("cid").alias("a"), F.bitwise_not("m.nb").alias("b"))
        found = C.stage(_confirm(one, sets, percent), "near-links")
        C.unstage(pivots)
        links = found if links is None else links.unionAll(found)
        labels = components(links)
        new = C.stage(_relabel(postings, labels), "near-current")
        if r:
            C.unstage(current)
        current = new
    # lists with several components; of lists with the same members, the first
    members = F.sum(F.expr("cast(xxhash64(cid) as decimal(38))"))
    lists = current.groupBy("k", "v").agg(F.min("label").alias("lo"), F.max("label").alias("hi"), F.count(F.lit(1)).alias("n"), members.alias("h1"), F.min("cid").alias("h2")).where("lo != hi")
    lists = C.stage(lists.groupBy("n", "h1", "h2").agg(F.min(F.struct("k", "v")).alias("l")).select("l.k", "l.v"), "near-lists")
    sizes = signed.select(F.col("rid").alias("cid"), (8 * F.col("n")).alias("bytes"))
    open_lists = C.stage(current.join(lists, ["k", "v"]).join(sizes, "cid"), "near-open")
    parts = open_lists.groupBy("k", "v", "label").agg(F.count(F.lit(1)).alias("n"), F.sum("bytes").alias("bytes"))
    largest = F.max(F.struct("n", "label", "bytes"))
    parts = parts.groupBy("k", "v").agg(largest.alias("m"), F.sum("n").alias("size"), F.sum("bytes").alias("all"))
    spots = lambda n, size: F.greatest(F.lit(1), F.ceil(n / BLOCK), F.ceil(size / BLOCK_BYTES)).cast("long")
    parts = parts.select("k", "v", F.col("m.label").alias("main"), spots(F.col("size"), F.col("all")).alias("spots"), spots(F.col("size") - F.col("m.n"), F.col("all") - F.col("m.bytes")).alias("outer_spots"))
    parts = C.stage(parts, "near-parts")
    mask = F.aggregate("p", F.lit(0).cast("long"), lambda m, x: m.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), x["k"])))
    facts = posted.select("cid", mask.alias("mask")).join(signed.select(F.col("rid").alias("cid"), "sig"), "cid").join(sets.withColumnRenamed("rid", "cid"), "cid")
    members = open_lists.join(parts, ["k", "v"])
    spot = lambda seed, n: F.pmod(F.xxhash64(F.lit(seed), "cid"), F.col(n))
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    outer = members.where("label != main").select("k", "v", F.lit(0).alias("side"), "cid", "label", spot(6, "outer_spots").alias("i"), every("spots").alias("j"))
    inner = members.select("k", "v", F.lit(1).alias("side"), "cid", "label", every("outer_spots").alias("i"), spot(5, "spots").alias("j"))
    blocks = outer.unionByName(inner).join(facts, "cid").groupBy("k", "v", "i", "j")
    more = C.stage(blocks.applyInPandas(_merge_block(percent), "a long, b long"), "near-links")
    C.unstage(open_lists, lists, parts, current, sets)
    return links.unionAll(more)


def classes_of(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every row."""
    return near_dups(docs, words=words, percent=percent).drop("_rid")


def kept_only(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` but those that are near copies of one that stays."""
    held, named = C.aside(docs, "_rid", "_maybe", "_key", "_x", "_bits", "_bucket")
    staged = C.stage(held.withColumn("_rid", F.monotonically_increasing_id()), "near-rows", "zstd")
    rows = staged.select(F.col("_rid").alias("rid"), F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    dropped = C.stage(_near_dups(rows, words, percent, 3).where("not kept").select("_rid"), "near-dropped")
    return named(C.anti(staged, "_rid", dropped))
