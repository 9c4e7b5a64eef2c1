"""Language by rank-order profiles of character n-grams (out-of-place distance).

A profile is the ``TOP`` most frequent n-grams (1 to ``LONGEST`` letters, words padded by one blank
on either side) in rank order: of all training text of a language, or of a document. The distance is
the sum, over the document's n-grams, of how far each is from its place in the language's profile,
or ``TOP`` if it is not in it. The nearest language is predicted; the score is one less the distance
over the largest possible one.

N-grams are counted as hashes of 40 bits, sorted per document. Training counts are summed by Spark over
all training documents; only the profiles, ``TOP`` rows a language, come to the driver.

Defined cases: a null text, or one without a letter, is ``und`` with score 0, as is every text if no
language could be learned; a null lang is not learned from; ties go to the smaller language name and
the smaller hash; repeated rows are predicted each; an empty table gives an empty result; other
columns are ignored. A very long text is counted part by part, cut between words, so memory follows its distinct n-grams; only a
text without any blank is counted whole.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerloom.llm import common as C

TOP, LONGEST = 300, 3
HASH_BITS = 40
#: Text at a time: its n-grams take about a hundred times as much memory.
SLICE_BYTES = 1 << 20
_letters: list[np.ndarray] = []


def letters() -> np.ndarray:
    """For each code point the lower-case letter, or 0."""
    if not _letters:
        _letters.append(np.array([ord(low[0]) if (c := chr(x)).isalpha() and (low := c.lower()) else 0 for x in range(0x110000)], np.uint32))
    return _letters[0]


def grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed n-grams of all texts and the text of each."""
    table = letters()
    points = [table[np.frombuffer(x.encode("utf-32-le", "surrogatepass"), np.uint32)] for x in texts]
    size = np.array([len(x) + 2 for x in points], np.int64)
    flat = np.zeros(int(size.sum()), np.uint64)
    at = np.concatenate(([0], np.cumsum(size)))
    for k, x in zip(at[:-1].tolist(), points, strict=True):
        flat[k + 1 : k + 1 + len(x)] = x
    doc = np.repeat(np.arange(len(texts), dtype=np.uint64), size)
    # one blank between words; each text starts and ends with one of its own
    keep = np.ones(len(flat), bool)
    keep[1:] = (flat[1:] != 0) | (flat[:-1] != 0) | (doc[1:] != doc[:-1])
    flat, doc = flat[keep], doc[keep]
    hashes, owners = [], []
    for n in range(1, LONGEST + 1):
        m = len(flat) - n + 1
        if m < 1:
            break
        ok = doc[:m] == doc[n - 1 :]
        if n == 1:
            ok &= flat != 0
        elif n == 2:
            ok &= (flat[:m] != 0) | (flat[1:] != 0)
        for k in range(1, n - 1):
            ok &= flat[k : k + m] != 0
        h = np.full(m, n, np.uint64)
        for k in range(n):
            h = (h ^ flat[k : k + m]) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(29)
        hashes.append((h >> np.uint64(64 - HASH_BITS))[ok])
        owners.append(doc[:m][ok])
    if not hashes:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    return np.concatenate(hashes), np.concatenate(owners)


def counted(hashes: np.ndarray, owners: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(owner, hash, count) in order of owner and hash."""
    both = np.sort(owners << np.uint64(HASH_BITS) | hashes)
    first = np.flatnonzero(np.concatenate(([True], both[1:] != both[:-1]))) if len(both) else np.zeros(0, np.int64)
    count = np.diff(np.concatenate((first, [len(both)])))
    own = both[first]
    return (own >> np.uint64(HASH_BITS)).astype(np.int64), (own & np.uint64((1 << HASH_BITS) - 1)).astype(np.int64), count


def parts(text: str, size: int = SLICE_BYTES // 2) -> list[str]:
    """A text in parts of about ``size`` characters, cut at what is no letter: every n-gram lies within one, as words are padded by blanks."""
    out, at, table = [], 0, letters()
    while len(text) - at > size:
        cut = at + size
        while cut < len(text) and table[ord(text[cut])]:
            cut += 1
        if cut == len(text):
            break
        out.append(text[at:cut])
        at = cut + 1
    return [*out, text[at:]]


def summed(kinds: np.ndarray, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(kind, hash, count) of the n-grams of texts, each of the kind at its place, in order of kind and hash; long texts part by part."""
    found, of, now, size = [], [], [], 0

    def count():
        hashes, owners = grams(now)
        found.append(counted(hashes, np.array(of, np.uint64)[owners.astype(np.int64)]))
        of.clear()
        now.clear()

    for kind, text in zip(kinds.tolist(), texts, strict=True):
        for part in parts(text):
            of.append(kind)
            now.append(part)
            size += len(part)
            if size >= SLICE_BYTES // 2:
                count()
                size = 0
    if now or not found:
        count()
    if len(found) == 1:
        return found[0]
    kind, key, n = (np.concatenate(x) for x in zip(*found, strict=True))
    both = kind.astype(np.uint64) << np.uint64(HASH_BITS) | key.astype(np.uint64)
    order = np.argsort(both, kind="stable")
    first = np.flatnonzero(np.concatenate(([True], np.diff(both[order]) != 0))) if len(both) else np.zeros(0, np.int64)
    total = np.add.reduceat(n[order], first) if len(both) else n
    return kind[order][first], key[order][first], total


def profiles(docs: DataFrame) -> list[tuple[str, int, int]]:
    """(lang, hash, rank from 0) over the training rows of ``docs`` (doc_id, text, lang)."""

    def run(batches):
        for batch in C.slices(batches, size=SLICE_BYTES):
            langs = batch.column("lang").to_pylist()
            names = sorted(set(langs))
            place = {x: i for i, x in enumerate(names)}
            lang, key, n = summed(np.array([place[x] for x in langs]), C.strings(batch.column("text")))
            yield pa.record_batch([pa.array(np.array(names, object)[lang], pa.string()), pa.array(key), pa.array(n, pa.int64())], names=["lang", "key", "n"])

    train = docs.where(F.col("text").isNotNull() & F.col("lang").isNotNull() & (C.crc_mod("doc_id", 4) != 2)).select("text", "lang")
    counts = train.mapInArrow(run, "lang string, key long, n long").groupBy("lang", "key").agg(F.sum("n").alias("n"))
    ranked = counts.withColumn("rank", F.row_number().over(W.partitionBy("lang").orderBy(F.desc("n"), "key")) - 1).where(F.col("rank") < TOP)
    return [(r["lang"], r["key"], r["rank"]) for r in ranked.select("lang", "key", "rank").collect()]  # TOP rows a language


class Profiles:
    def __init__(self, rows: list[tuple[str, int, int]]):
        self.langs = sorted({x for x, _, _ in rows})
        place = {x: i for i, x in enumerate(self.langs)}
        self.keys = np.unique(np.array([k for _, k, _ in rows], np.int64))
        self.ranks = np.full((len(self.keys) + 1, len(self.langs)), TOP * 2, np.int64)  # the last row: in no profile
        for x, k, r in rows:
            self.ranks[np.searchsorted(self.keys, k), place[x]] = r

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        names, scores = ["und"] * len(texts), np.zeros(len(texts))
        if not self.langs:
            return names, scores
        doc, key, n = summed(np.arange(len(texts)), texts)
        order = np.lexsort((key, -n, doc))
        doc, key = doc[order], key[order]
        rank = np.arange(len(doc)) - np.searchsorted(doc, doc)
        own = rank < TOP
        doc, key, rank = doc[own], key[own], rank[own]
        if not len(doc):
            return names, scores
        spot = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        known = self.ranks[np.where(self.keys[spot] == key, spot, len(self.keys))]
        away = np.where(known < TOP, np.abs(known - rank[:, None]), TOP)
        first = np.flatnonzero(np.concatenate(([True], doc[1:] != doc[:-1])))
        total = np.add.reduceat(away, first, axis=0)
        most = np.diff(np.concatenate((first, [len(doc)]))) * TOP
        best = total.argmin(axis=1)
        for d, b in zip(doc[first].tolist(), best.tolist(), strict=True):
            names[d] = self.langs[b]
        scores[doc[first]] = 1 - total.min(axis=1) / most
        return names, scores


def identify(docs: DataFrame, learned: list[tuple[str, int, int]]) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every row of ``docs`` (doc_id, text)."""

    def run(batches):
        known = Profiles(learned)
        for batch in C.slices(batches, size=SLICE_BYTES):
            names, scores = known.predict(C.strings(batch.column("text")))
            yield pa.record_batch([batch.column("doc_id"), batch.column("held_out"), pa.array(names, pa.string()), pa.array(scores)], names=["doc_id", "held_out", "lang_pred", "score"])

    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (C.crc_mod("doc_id", 4) == 2).alias("held_out"), "text")
    return slim.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double")


def identified(docs: DataFrame) -> DataFrame:
    return identify(docs, profiles(docs.select("doc_id", "text", "lang")))
