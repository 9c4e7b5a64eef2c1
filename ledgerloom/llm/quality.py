"""Quality rules and a chain model that labels lines as content or boilerplate.

The base rules count words, symbols, repeated lines and repeated windows. Beyond them, the lines of a
document that hold a word are one sequence of a linear-chain conditional random field over features
of form (length, symbols, case, ends, repetition); Viterbi decoding marks each as content or
boilerplate, and the share of words in content lines decides whether the document is kept.

The model is fitted to a bounded sample of documents with a quality label (``SAMPLE`` of either label,
in the order of a hash of doc_id): lines of low-quality documents, and lines that repeat an earlier
one, are boilerplate, other lines of good ones content. With no labels of one kind all lines count
as content.

Defined cases: a null, empty or blank text has no words, fails the base rules and is not kept;
repeated rows are judged each; an empty table gives an empty result; other columns are ignored. A very long text is judged
whole in one task, with about 40 bytes of memory a byte of text.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm import common as C
from ledgerloom.llm.chains import Chains, fit_chain

MIN_WORDS, REPEAT_PERCENT, WINDOW = 20, 30, 8
SYMBOLS = b"#*$%&|<>"
SAMPLE = 1500
#: And bytes of text of either label; the document that crosses the bound is the last.
SAMPLE_BYTES = 8 << 20
CONTENT_SHARE = 0.5
#: Slots of the line features: the bias, then a block for each.
BLOCKS = (("words", 9), ("symbols", 8), ("upper", 8), ("digits", 6), ("long", 8), ("distinct", 8), ("end", 2), ("copy", 2), ("bars", 4), ("place", 4))
SLOTS = 1 + sum(n for _, n in BLOCKS)
_FIRST = dict(zip((b for b, _ in BLOCKS), np.cumsum([1, *(n for _, n in BLOCKS)])[:-1].tolist(), strict=True))
_COPY = 1 + [b for b, _ in BLOCKS].index("copy")
_UPPER = bytes(range(65, 91))
_DIGITS = b"0123456789"


def _share(part: int, whole: int, slots: int) -> int:
    return min(slots - 1, part * slots // max(whole, 1))


def line_features(lines: list[bytes]) -> list[list[int]]:
    """Feature slots of each line, in the order of BLOCKS."""
    out, seen = [], set()
    for k, line in enumerate(lines):
        words = line.split()
        n, size = len(words), max(1, len(line))
        symbols, upper, digits = (len(line) - len(line.translate(None, s)) for s in (SYMBOLS, _UPPER, _DIGITS))
        place = 0 if k == 0 else 3 if k == len(lines) - 1 else 1 + (2 * k >= len(lines))
        values = (min(8, n.bit_length()), _share(symbols, size, 32) if symbols else 0, _share(upper, size, 8), _share(digits, size, 6), min(7, size // n // 2), _share(len(set(words)) - 1, n, 8), int(line.rstrip()[-1:] in (b".", b"!", b"?", b":", b";", b'"', b"'", b")")), int(line in seen), min(3, line.count(b" | ").bit_length()), place)
        out.append([0, *(_FIRST[b] + min(v, m - 1) for (b, m), v in zip(BLOCKS, values, strict=True))])
        seen.add(line)
    return out


def worded(text: bytes) -> list[bytes]:
    return [line for line in text.split(b"\n") if line.split(None, 1)]


class Model:
    def __init__(self, weights: np.ndarray | None, trans: np.ndarray | None):
        self.weights, self.trans = weights, trans

    def content(self, parts: list[list[bytes]]) -> list[np.ndarray]:
        """Per text, whether each of its lines is content."""
        if self.weights is None:
            return [np.ones(len(x), bool) for x in parts]
        feats = np.array([f for lines in parts for f in line_features(lines)], np.int64).reshape(-1, len(BLOCKS) + 1)
        lengths = np.array([len(x) for x in parts], np.int64)
        state = Chains(lengths[lengths > 0]).viterbi(self.weights[feats].sum(axis=1), self.trans)
        return np.split(state.astype(bool), np.cumsum(lengths)[:-1])


def fit(docs: list[tuple[bytes, int]]) -> Model:
    """From (text, quality) of the sample."""
    if len({q for _, q in docs}) < 2:
        return Model(None, None)
    feats, y, lengths = [], [], []
    for text, quality in docs:
        lines = worded(text)
        if not lines:
            continue
        own = line_features(lines)
        feats += own
        y += [float(quality and f[_COPY] == _FIRST["copy"]) for f in own]
        lengths.append(len(lines))
    if not lengths:
        return Model(None, None)
    rows, ids = np.unique(np.array(feats, np.int64), axis=0, return_inverse=True)
    return Model(*fit_chain(rows, ids.ravel(), np.array(y), np.array(lengths, np.int64), SLOTS, 80, 1e-5))


def learn(docs: DataFrame, labels: DataFrame) -> Model:
    known = labels.where("quality is not null and doc_id is not null").groupBy("doc_id").agg(F.min("quality").cast("int").alias("q"))
    known = known.join(docs.select("doc_id").distinct(), "doc_id", "left_semi")
    take = lambda q: known.where(F.col("q") == q).orderBy(F.xxhash64(F.lit(2), "doc_id"), "doc_id").limit(SAMPLE)
    sample = C.stage(take(1).unionAll(take(0)).select(F.col("doc_id").alias("_id"), "q"), "quality-sample")
    texts = C.semi(docs.select("doc_id", "text"), "doc_id", sample.select("_id")).join(sample, F.col("doc_id") == F.col("_id")).groupBy("_id", "q").agg(F.min("text").alias("t"))
    rows = C.bounded(texts.select("_id", "q", F.coalesce("t", F.lit("")).alias("t")), "q", lot=F.xxhash64(F.lit(2), "_id"), size=SAMPLE_BYTES)
    C.unstage(sample)
    return fit([(t, q) for _, q, t in rows])


def repeated_words(lists: list[list[bytes]], memo: C.Memo, window: int = WINDOW) -> np.ndarray:
    """Per list, the words that lie in a window found twice or more in the list; ``memo``: hashes of words."""
    n = np.array([len(x) for x in lists], np.int64)
    total, out = int(n.sum()), np.zeros(len(lists), np.int64)
    if total < window:
        return out
    look = memo.__getitem__
    h = np.fromiter((look(w) for x in lists for w in x), np.uint64, total)
    factors = np.random.default_rng(window).integers(0, 1 << 64, window + 1, dtype=np.uint64) | np.uint64(1)
    doc = np.repeat(np.arange(len(lists)), n)
    m = total - window + 1
    keys = doc[:m].astype(np.uint64) * factors[window]
    for k in range(window):
        keys += h[k : k + m] * factors[k]
    keys ^= keys >> np.uint64(31)
    keys *= factors[0]
    inside = doc[:m] == doc[window - 1 :]
    own = np.sort(keys[inside])
    twice = own[1:][own[1:] == own[:-1]]
    if not len(twice):
        return out
    twice = twice[np.concatenate(([True], twice[1:] != twice[:-1]))]
    spot = np.searchsorted(twice, keys)
    again = inside & (twice[np.minimum(spot, len(twice) - 1)] == keys)
    edge = np.zeros(total + 1, np.int64)
    at = np.flatnonzero(again)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + window, -1)
    covered = np.cumsum(edge)[:total] > 0
    return np.bincount(doc[covered], minlength=len(lists))


OUT = pa.schema([("doc_id", pa.int64()), *((c, pa.int64()) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")), ("base_failed", pa.bool_()), ("kept", pa.bool_()), ("content_share", pa.float64()), ("n_lines", pa.int64()), ("n_content_lines", pa.int64())])


def judge(docs: DataFrame, model: Model) -> DataFrame:
    """The counts, base_failed and kept of every row of ``docs`` (doc_id, text)."""
    held = C.broadcast(docs.sparkSession, model)  # SLOTS weights

    def run(batches):
        model, memo = held.value, C.Memo(xxhash.xxh64_intdigest)
        for batch in C.slices(batches):
            texts = C.raw(batch.column("text"))
            lists = [x.split() for x in texts]
            n = np.array([len(x) for x in lists], np.int64)
            chars = [len(x.translate(None, C.SPACE).decode()) for x in texts]
            symbols = [len(x) - len(x.translate(None, SYMBOLS)) for x in texts]
            parts = [worded(x) for x in texts]
            copies = [len(x) - len(set(x)) for x in parts]
            repeats = repeated_words(lists, memo)
            failed = (n < MIN_WORDS) | (100 * repeats > REPEAT_PERCENT * n)
            content = model.content(parts)
            good = np.array([sum(len(line.split()) for line, c in zip(lines, marks, strict=True) if c) for lines, marks in zip(parts, content, strict=True)], np.int64)
            share = good / np.maximum(n, 1)
            columns = [batch.column("doc_id"), n, chars, symbols, copies, repeats, failed, ~failed & (share >= CONTENT_SHARE), share, [len(x) for x in parts], [int(x.sum()) for x in content]]
            yield pa.record_batch([c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, OUT, strict=True)], schema=OUT)

    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    names = {pa.int64(): "long", pa.bool_(): "boolean", pa.float64(): "double"}
    return slim.mapInArrow(run, ", ".join(f"{f.name} {names[f.type]}" for f in OUT))


def judged(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return judge(docs, learn(docs.select("doc_id", "text"), labels))
