"""Mixing sources to target weights by subset-sum budget fitting.

Documents are counted by exact length within each source. A source's budget is first filled with the
same share of every length, then with single documents from long to short, and what remains by
bounded-knapsack dynamic programming over the copies that are left; a document may be taken up to ``MOST`` times. Where the sum
is not met exactly, documents are given back until ``DP_WORDS`` words and four times the longest document are open, and the
nearer sum counts; a source of up to so many words is thus fitted as near as can be. How many copies of each length to take is known then; which documents give
them is decided by a seeded hash, so reruns agree.

Documents of one source and length may be a third of all rows: they are ranked in hash buckets of
about ``BUCKET_ROWS`` rows, of which only the one at the border is ever sorted for a decision. A bucket that a row
repeated very often has made large is cut once more, by row.

Defined cases: a null text has size 0; a null source is a source, last in order; documents of size 0
are never taken; an empty table gives an empty result; repeated rows each count; other columns pass
through, whatever their names; a very long text counts with its full length, and the dynamic programme needs 5 bytes of
memory for each of twice the words that are open.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerloom.llm import common as C

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2
DP_WORDS = 1 << 14
BUCKET_ROWS = 20_000
WORD = r"[^\x20\x09-\x0D]+"


def targets(sizes: list[tuple[str | None, int]], weights=WEIGHTS, share=SHARE, most=MOST) -> list[tuple[str | None, int, float]]:
    """(source, size, target): ``share`` of all sizes dealt by weight, none above ``most`` times its size."""
    rows = sorted(sizes, key=lambda r: (r[0] is None, (r[0] or "").encode("utf-32-be")))
    total = float(share) * sum(n for _, n in rows)
    weight = {i: float(weights[i % len(weights)]) for i in range(len(rows))}
    out: dict[int, float] = {}
    free, left = set(weight), total
    while free:
        per = left / sum(weight[i] for i in free)
        full = {i for i in free if weight[i] * per > most * rows[i][1]}
        if not full:
            out |= {i: weight[i] * per for i in free}
            break
        out |= {i: float(most * rows[i][1]) for i in full}
        free -= full
        left = total - sum(out.values())
    return [(s, n, out[i]) for i, (s, n) in enumerate(rows)]


def knapsack(lengths: np.ndarray, counts: np.ndarray, budget: int) -> np.ndarray:
    """Of each length up to ``counts``, so that the sum is as near to ``budget`` as can be; of two as near, the lower.

    For each sum up to twice the budget (above it, taking nothing is nearer) the item that reached it first is kept; counts
    are split in powers of two, so the way back from a sum uses each item once.
    """
    take = np.zeros(len(lengths), np.int64)
    limit = 2 * budget
    reached, first, items = np.zeros(limit + 1, bool), np.full(limit + 1, -1, np.int32), []
    reached[0] = True
    for i in np.argsort(-lengths, kind="stable"):
        size, n, k = int(lengths[i]), int(counts[i]), 1
        n = min(n, limit // size) if size > 0 else 0
        while n and not reached[budget]:
            k = min(k, n)
            new = reached[: limit + 1 - k * size] & ~reached[k * size :]
            first[k * size :][new] = len(items)
            reached[k * size :] |= new
            items.append((i, k))
            n -= k
            k *= 2
    sums = np.flatnonzero(reached)
    at = int(sums[np.lexsort((sums, np.abs(sums - budget)))[0]])
    while at:
        i, k = items[first[at]]
        take[i] += k
        at -= k * int(lengths[i])
    return take


def fit(lengths: np.ndarray, counts: np.ndarray, budget: int, dp_words: int = DP_WORDS) -> np.ndarray:
    """How many copies of each length to take, at most ``counts``, so that the sum comes as near to ``budget`` as can be."""
    total = int((lengths * counts).sum())
    if budget >= total:
        return counts.copy()
    if budget <= 0 or not total:
        return np.zeros(len(lengths), np.int64)
    take = np.array([int(c) * budget // total for c in counts], np.int64)
    left = budget - int((lengths * take).sum())
    for i in np.argsort(-lengths, kind="stable"):
        if left <= dp_words:
            break
        if 0 < lengths[i] <= left:
            more = min(int(counts[i] - take[i]), (left - dp_words) // int(lengths[i]) + 1, left // int(lengths[i]))
            take[i] += more
            left -= more * int(lengths[i])
    best = take + knapsack(lengths, counts - take, left)
    room = max(dp_words, 4 * int(lengths[counts > 0].max()))
    if int((lengths * best).sum()) != budget and left < room:
        for i in np.argsort(lengths, kind="stable"):
            if left >= room:
                break
            if lengths[i] > 0:
                back = min(int(take[i]), -((left - room) // int(lengths[i])))
                take[i] -= back
                left += back * int(lengths[i])
        other = take + knapsack(lengths, counts - take, left)
        best = min(best, other, key=lambda t: abs(int((lengths * t).sum()) - budget))
    return best


def _fit_source(frame: pd.DataFrame) -> pd.DataFrame:
    """One source's histogram of lengths: copies that every document of a length gets, and how many get one more."""
    frame = frame.sort_values("_size", kind="stable")
    lengths, counts = frame["_size"].to_numpy(np.int64), frame["_docs"].to_numpy(np.int64)
    budget = int(np.floor(float(frame["target"].iloc[0]) + 0.5))
    take = fit(lengths, counts * np.where(lengths > 0, MOST, 0), budget)
    return pd.DataFrame({"_source": frame["_source"], "_size": lengths, "_base": take // counts, "_extra": take % counts})


#: Columns that the operator adds for itself.
INTERNAL = ("_rid", "_lot", "_group", "_times", "_bucket", "_sub", "copies")


def _rows(docs: DataFrame, doc_id: str, text: str, source: str, seed: int) -> DataFrame:
    """``docs`` with a row number, a seeded lot of 31 bits and the group (source, size)."""
    size = F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")
    lot = F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.col(doc_id), F.col(text)), 33).cast("long")
    return docs.withColumns({"_rid": F.monotonically_increasing_id(), "_lot": lot, "_group": F.struct(F.col(source).cast("string").alias("_source"), size.alias("_size"))})


def _deal(lot, parts):
    """The one of ``parts`` buckets that a lot of 31 bits falls into."""
    return F.floor(lot * parts / F.lit(1 << 31)).cast("long")


def _running(counts: DataFrame, order: list[str]) -> DataFrame:
    """``counts`` (_group, the columns of ``order``, _in) with the rows of the group that come before as _before."""
    before = F.sum("_in").over(W.partitionBy("_group").orderBy(*order).rowsBetween(W.unboundedPreceding, -1))
    return counts.withColumn("_before", F.coalesce(before, F.lit(0).cast("long")))


def copies(rows: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """For staged ``_rows``: doc_id, _rid, size, source_size, target and copies (0 to MOST).

    What is known of a group or a bucket is staged before its rows meet it, so Spark can split the large ones.
    """
    spark = rows.sparkSession
    slim = rows.select(doc_id, "_rid", "_lot", "_group")
    hist = C.stage(slim.groupBy("_group").agg(F.count(F.lit(1)).alias("_docs")).select("_group._source", "_group._size", "_docs"), "mix-lengths")
    per_source = hist.groupBy("_source").agg(F.sum(F.col("_size") * F.col("_docs")).alias("n")).collect()  # a row for each source
    plan = spark.createDataFrame(targets([(r["_source"], r["n"]) for r in per_source]), "_s string, _source_size long, target double")
    h = hist.join(plan, F.col("_source").eqNullSafe(F.col("_s"))).drop("_s")
    fitted = h.groupBy("_source").applyInPandas(_fit_source, "_source string, _size long, _base long, _extra long")
    fitted = fitted.select(F.struct("_source", "_size").alias("_group"), "_base", "_extra")
    rules = h.select(F.struct("_source", "_size").alias("_g"), "_docs", "_source_size", "target").join(fitted, F.col("_g").eqNullSafe(F.col("_group"))).drop("_g")
    rules = C.stage(rules.withColumn("_buckets", F.ceil(F.col("_docs") / BUCKET_ROWS).cast("long")), "mix-rules")
    same = F.col("_group").eqNullSafe(F.col("_g"))
    dealt = slim.withColumnRenamed("_group", "_g").join(rules, same).drop("_g").withColumn("_bucket", _deal(F.col("_lot"), F.col("_buckets")))
    dealt = C.stage(dealt, "mix-dealt")
    filled = C.stage(dealt.groupBy("_group", "_bucket").agg(F.count(F.lit(1)).alias("_in")), "mix-filled")
    cuts = filled.where(F.col("_in") > 2 * BUCKET_ROWS).select(F.col("_group").alias("_g"), F.col("_bucket").alias("_b"), F.ceil(F.col("_in") / BUCKET_ROWS).cast("long").alias("_cuts"))
    cuts = C.stage(cuts, "mix-cuts")
    own = F.shiftrightunsigned(F.xxhash64(F.lit(1), "_rid"), 33).cast("long")
    dealt = dealt.join(cuts, same & (F.col("_bucket") == F.col("_b")), "left").withColumn("_sub", _deal(own, F.coalesce("_cuts", F.lit(1)))).drop("_g", "_b", "_cuts")
    # whole buckets below the border are taken as they are; a row's rank within its bucket decides in the one at the border
    before = _running(dealt.groupBy("_group", "_bucket", "_sub").agg(F.count(F.lit(1)).alias("_in")), ["_bucket", "_sub"])
    before = C.stage(before.select(F.col("_group").alias("_g"), F.col("_bucket").alias("_b"), F.col("_sub").alias("_s"), "_before"), "mix-before")
    ranked = dealt.withColumn("_rank", F.row_number().over(W.partitionBy("_group", "_bucket", "_sub").orderBy("_lot", doc_id, "_rid")))
    out = ranked.join(before, same & (F.col("_bucket") == F.col("_b")) & (F.col("_sub") == F.col("_s")))
    taken = F.col("_base") + (F.col("_before") + F.col("_rank") <= F.col("_extra")).cast("long")
    return out.select(doc_id, "_rid", F.col("_group._size").alias("size"), F.col("_source_size").alias("source_size"), "target", F.when(F.col("_group._size") > 0, taken).otherwise(0).cast("long").alias("copies"))


def sizes_taken(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", seed: int = 7) -> DataFrame:
    """Per row of ``docs``: doc_id, size, source_size, target, taken (words, repeats counted)."""
    rows = C.stage(_rows(docs.select(doc_id, text, source), doc_id, text, source, seed).drop(text, source), "mix-rows")
    return copies(rows, doc_id).select(doc_id, "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def mixed(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", seed: int = 7) -> DataFrame:
    """The mix itself: the rows of ``docs``, each as often as it is taken."""
    held, named = C.aside(docs, *INTERNAL)
    rows = C.stage(_rows(held, doc_id, text, source, seed), "mix-rows")
    often = copies(rows, doc_id).where("copies > 0").select("_rid", F.sequence(F.lit(1), F.col("copies").cast("int")).alias("_times"))
    return named(rows.select(*held.columns, "_rid").join(often, "_rid").select(*held.columns, F.explode("_times")))
