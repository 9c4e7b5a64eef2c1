"""Toxic spans by a linear-chain conditional random field, aggregated to document scores.

Labels are given for documents, so tokens are labelled first: in a toxic document, a token is toxic if
its word, or a prefix of it, is found almost only in toxic documents. A chain with the states plain
and toxic is then fitted to the lines of a bounded sample of labelled documents (``TOXIC_DOCS`` and
``CLEAN_DOCS``, in the order of a hash of doc_id) by gradient steps on its likelihood. Its features
are hashed words, prefixes, suffixes and lengths. Scoring runs forward-backward over every line of
every text; a logistic curve over the marginals' sum, maximum and share gives the document's score,
and runs of tokens with a marginal of a half or more are the offending spans.

Defined cases: a null, empty or blank text has no tokens and gets the score of a text without any
toxic token; labels that are null are ignored, and of several labels of one doc_id the largest
counts; with no labels of one kind the share of toxic ones is everyone's score; an empty table gives an
empty result; repeated rows are scored each; other columns pass through. A very long text is scored whole in one task, with about
150 bytes of memory a byte of text.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.llm import common as C
from ledgerloom.llm.chains import Chains, fit_chain

TOXIC_DOCS, CLEAN_DOCS = 1000, 1500
#: And bytes of text of either kind; the document that crosses the bound is the last.
SAMPLE_BYTES = 6 << 20
THRESHOLD = 0.7
SLOTS = 1 << 18
#: A word or prefix is a toxic cue if it is in this many toxic documents at least, and so many times likelier there.
CUE_DOCS, CUE_ODDS = 4, 20.0
PREFIXES, SUFFIXES = (4, 5, 6, 7, 8), (3, 4)
EDGE = b".,;:!?\"'()[]{}|*%&$#<>-_/\\~^=+`@"
#: Words whose emission a task remembers at most, none above C.MEMO_BYTES.
MEMO = 250_000
WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def cues(word: bytes) -> list[bytes]:
    return [word, *(word[:n] + b"*" for n in PREFIXES if len(word) > n)]


def features(word: bytes) -> list[int]:
    """Hashed features of a token, always as many; slot 0 is the bias and fills the rest."""
    bare = word.strip(EDGE) or word
    names = [*cues(bare), *(b"*" + bare[-n:] for n in SUFFIXES if len(bare) > n), b"#%d" % min(len(bare), 12)]
    ids = [1 + zlib.crc32(x) % (SLOTS - 1) for x in names]
    return ids + [0] * (len(PREFIXES) + len(SUFFIXES) + 2 - len(ids))


def lines_of(text: bytes) -> list[list[bytes]]:
    return [w for line in text.lower().split(b"\n") if (w := line.split())]


class Model:
    """Weights of the chain and of the document's curve; works on whole texts."""

    def __init__(self, weights: np.ndarray, trans: np.ndarray, curve: np.ndarray, prior: float):
        self.weights, self.trans, self.curve, self.prior = weights, trans, curve, prior
        self.memo: dict[bytes, float] = {}

    def __getstate__(self):
        used = np.flatnonzero(self.weights)
        return {"used": used, "values": self.weights[used], "trans": self.trans, "curve": self.curve, "prior": self.prior}

    def __setstate__(self, s):
        weights = np.zeros(SLOTS)
        weights[s["used"]] = s["values"]
        self.__init__(weights, s["trans"], s["curve"], s["prior"])

    def emissions(self, words) -> np.ndarray:
        """Each word's emission score, from memory where it is known."""
        memo, w = self.memo, self.weights
        own = set(words)
        new = [x for x in own if x not in memo]
        if new:
            if len(memo) + len(new) > MEMO:
                memo.clear()
                new = list(own)
            memo.update(zip(new, w[np.array([features(x) for x in new])].sum(axis=1).tolist(), strict=True))
        out = np.fromiter(map(memo.__getitem__, words), np.float64, len(words))
        for x in new:
            if len(x) > C.MEMO_BYTES:
                del memo[x]
        return out

    def marginals(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Of all tokens of all texts, one after the other, and how many each text has."""
        parts = [lines_of(x) for x in texts]
        words = [w for lines in parts for line in lines for w in line]
        lengths = np.array([len(line) for lines in parts for line in lines], np.int64)
        counts = np.array([sum(map(len, lines)) for lines in parts], np.int64)
        return Chains(lengths).marginals(self.emissions(words), self.trans), counts

    def scores(self, m: np.ndarray, counts: np.ndarray) -> np.ndarray:
        if self.curve is None:
            return np.full(len(counts), self.prior)
        return 1 / (1 + np.exp(-np.clip(documents(m, counts) @ self.curve, -30, 30)))


def documents(m: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Per document: 1, log of the expected toxic tokens, the largest marginal, both against the log of the length."""
    full = np.flatnonzero(counts)
    total, most = np.zeros(len(counts)), np.zeros(len(counts))
    if len(full):
        at = (np.cumsum(counts) - counts)[full]
        total[full], most[full] = np.add.reduceat(m, at), np.maximum.reduceat(m, at)
    x = np.log1p(total)
    size = np.log(2.0 + counts)
    return np.stack([np.ones(len(counts)), x, most, x / size, most * size], axis=1)


def first_met(docs: list[np.ndarray]) -> list[np.ndarray]:
    """Each document's distinct words that stand between two words between which no earlier document, nor an earlier place, has them."""
    size = np.array([len(x) for x in docs], np.int64)
    flat = np.concatenate(docs).astype(np.uint64) + np.uint64(1)
    ends = np.cumsum(size)
    before, after = np.concatenate(([np.uint64(0)], flat[:-1])), np.concatenate((flat[1:], [np.uint64(0)]))
    before[(ends - size)[size > 0]] = 0
    after[ends[size > 0] - 1] = 0
    between = (flat * np.uint64(0x9E3779B97F4A7C15) ^ before) * np.uint64(0xD6E8FEB86659FD93) ^ after
    new = np.zeros(len(flat), bool)
    new[np.unique(between, return_index=True)[1]] = True
    return [np.unique(x[n]) for x, n in zip(docs, np.split(new, ends[:-1]), strict=True)]


def token_labels(vocabulary: list[bytes], docs: list[np.ndarray], toxic: list[int]) -> np.ndarray:
    """Of each word, whether it or a prefix is a toxic cue; docs: the words of each document.

    A passage that several toxic documents share counts for the first only, or its rare words were cues.
    """
    own = np.empty((len(vocabulary), len(PREFIXES) + 1), np.uint64)
    for i, w in enumerate(vocabulary):
        names = cues(w.strip(EDGE) or w)
        own[i] = [xxhash.xxh64_intdigest(c) for c in names] + [xxhash.xxh64_intdigest(names[0])] * (own.shape[1] - len(names))
    names, own = np.unique(own, return_inverse=True)
    own = own.reshape(len(vocabulary), -1).astype(np.int32)
    n, found = [1.0, 1.0], np.zeros((2, len(names)))
    for y in (0, 1):
        kind = [x for x, t in zip(docs, toxic, strict=True) if t == y]
        n[y] += len(kind)
        for ids in first_met(kind) if y else map(np.unique, kind):
            found[y, np.unique(own[ids])] += 1
    bad = (found[1] >= CUE_DOCS) & (found[1] / n[1] > CUE_ODDS * (found[0] + 0.5) / n[0])
    return bad[own].any(axis=1)


def fit(docs: list[tuple[bytes, int]], steps: int = 60, ridge: float = 1e-6) -> Model:
    """The chain and the curve, from (text, toxic) of the sample; near-copies of a text count once, or else its rare words were cues."""
    docs = C.unlike(docs)
    toxic = [y for _, y in docs]
    share = sum(toxic) / len(docs) if docs else 0.0
    if not 0 < share < 1:
        return Model(np.zeros(SLOTS), np.zeros((2, 2)), None, share)
    vocabulary: dict[bytes, int] = {}
    ids, lengths, counts = [], [], []
    for text, _ in docs:  # words as numbers at once: the sample's words are never all held as objects
        lines = lines_of(text)
        ids.append(np.array([vocabulary.setdefault(w, len(vocabulary)) for line in lines for w in line], np.int32))
        lengths += [len(line) for line in lines]
        counts.append(len(ids[-1]))
    cue = token_labels(list(vocabulary), ids, toxic)
    labels = np.concatenate([cue[x] * float(y) for x, y in zip(ids, toxic, strict=True)])
    feats = np.array([features(w) for w in vocabulary], np.int32)
    flat, lengths, counts = np.concatenate(ids), np.array(lengths, np.int64), np.array(counts, np.int64)
    w, trans = fit_chain(feats, flat, labels, lengths, SLOTS, steps, ridge)
    m = Chains(lengths).marginals(w[feats].sum(axis=1)[flat], trans)
    x, target = documents(m, counts), np.array(toxic, float)
    curve = np.zeros(x.shape[1])
    for _ in range(50):  # Newton steps for the curve
        p = 1 / (1 + np.exp(-np.clip(x @ curve, -30, 30)))
        h = (x * (p * (1 - p))[:, None]).T @ x + np.eye(x.shape[1])
        curve += np.linalg.solve(h, x.T @ (target - p) - curve)
    return Model(w, trans, curve, share)


def learn(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic") -> Model:
    """Fit on the bounded sample of the labelled documents that may be learnt from (crc32 of doc_id mod 3 not 1)."""
    known = labels.where(F.col(label).isNotNull() & F.col(doc_id).isNotNull()).groupBy(doc_id).agg(F.max(label).cast("int").alias("y"))
    known = known.where(C.crc_mod(doc_id, 3) != 1)
    lot = F.xxhash64(F.lit(10), doc_id)
    known = known.join(docs.select(doc_id).distinct(), doc_id, "left_semi")
    take = lambda y, n: known.where(F.col("y") == y).orderBy(lot, doc_id).limit(n)
    sample = C.stage(take(1, TOXIC_DOCS).unionAll(take(0, CLEAN_DOCS)).select(F.col(doc_id).alias("_id"), "y"), "tox-sample")
    texts = C.semi(docs.select(doc_id, text), doc_id, sample.select("_id")).join(sample, F.col(doc_id) == F.col("_id")).groupBy("_id", "y").agg(F.min(text).alias("t"))
    rows = C.bounded(texts.select("_id", "y", F.coalesce("t", F.lit("")).alias("t")), "y", lot=F.xxhash64(F.lit(10), "_id"), size=SAMPLE_BYTES)
    C.unstage(sample)
    return fit([(t, y) for _, y, t in rows])


def spans(text: bytes, m: np.ndarray) -> list[dict]:
    """Runs of tokens with a marginal of a half or more: code points from start to end, mean marginal."""
    places = [(x.start(), x.end()) for x in WORD.finditer(text)]
    out, k = [], 0
    while k < len(places):
        if m[k] < 0.5:
            k += 1
            continue
        first = k
        while k < len(places) and m[k] >= 0.5:
            k += 1
        a, b = places[first][0], places[k - 1][1]
        start = len(text[:a].decode())
        out.append({"start": start, "end": start + len(text[a:b].decode()), "score": float(m[first:k].mean())})
    return out


SPANS = "array<struct<start: long, end: long, score: double>>"


ADDED = ("tox_score", "tox_predicted", "tox_spans")


def score(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with tox_score, tox_predicted and tox_spans, which replace columns of their names."""
    docs = docs.drop(*ADDED)
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())]))
    held = C.broadcast(docs.sparkSession, model)  # SLOTS weights at most

    def run(batches):
        model = held.value
        for batch in C.slices(batches, text):
            texts = C.raw(batch.column(text))
            m, counts = model.marginals(texts)
            s = model.scores(m, counts)
            ends = np.cumsum(counts)
            hot = np.zeros(len(counts), bool)
            hot[np.searchsorted(ends, np.flatnonzero(m >= 0.5), side="right")] = True
            found = [spans(t, m[e - n : e]) if h else [] for t, n, e, h in zip(texts, counts.tolist(), ends.tolist(), hot.tolist(), strict=True)]
            new = [pa.array(s), pa.array((s >= THRESHOLD).astype(np.int32)), pa.array(found, span)]
            yield pa.record_batch([*batch.columns, *new], names=[*batch.schema.names, *ADDED])

    schema = T.StructType([*(T.StructField(f.name, f.dataType, True) for f in docs.schema), T.StructField("tox_score", T.DoubleType()), T.StructField("tox_predicted", T.IntegerType()), *T.StructType.fromDDL(f"tox_spans {SPANS}")])
    return docs.mapInArrow(run, schema)


def judged(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted and spans of every row of ``docs``."""
    docs = docs.select("doc_id", "text")
    scored = score(docs, learn(docs, labels))
    return scored.select("doc_id", (C.crc_mod("doc_id", 3) == 1).alias("held_out"), F.col("tox_score").alias("score"), F.col("tox_predicted").alias("predicted"), F.col("tox_spans").alias("spans"))


def clean_only(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are not predicted to be toxic."""
    model = learn(docs.select("doc_id", "text"), labels)
    held, named = C.aside(docs, *ADDED)
    return named(score(held, model).where("tox_predicted = 0"))
