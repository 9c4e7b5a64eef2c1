"""Language-model scores by logistic context mixing over bits.

A text is its words in lower case (A-Z only), each followed by a blank, and an end mark. Every bit of a
token is predicted from eight hashed contexts: the word before with the whole token so far, the document's class with the 1 to 5 bytes before it
within the token, and the whole token so far with and without the class, each with the bits of the
byte that are known. The class stands for what documents of one kind (a language, say) have in
common: a mixture of ``CLASSES`` multinomials over the ``MARKERS`` most frequent words, both taken from all
training texts. It is a function of the text, and its own probability is part of
the score. A predictor is a pair of counts in a Spark table by the 64 bit hash of the context. Their logits are combined by weights that a gate selects (how many
contexts have been seen, how often the longest has, and whether it saw both bits); the result is refined by an adaptive
probability map. The sum over the bits is the text's log-probability.

Learning covers all training texts. Distinct pairs of a word and the word before are counted and scored in shards (``lm_shards``), each row
of (class, word before, bits so far) once. Weights and map are learned online, shard by shard in mini-batches in random order, with each
token's own occurrence left out of the counts, and averaged by mass. Scoring uses the frozen model,
so that a score depends neither on the order of the documents nor on partitions. No vocabulary is broadcast.

``followed`` and ``count_contexts`` count the same contexts with one row a pair; they are the plain form, which a table of any order takes.

Defined cases: a null, empty or blank text is the end mark alone; a null doc_id counts as the empty
text in the split; repeated rows are scored each; an empty table gives an empty result; with no
training text every context is unseen and the base score is taken with N = V = 0; other columns are
ignored. A very long text is tokenised whole in one task, with about 60 bytes of memory a byte of text.
"""

from __future__ import annotations

import time
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm import common as C

#: Bytes of context (0: the whole token so far, ACROSS: that and the word before), and whether the class is part of it; the last one sets the gate.
ACROSS = -1
ORDERS = ((ACROSS, False), (1, True), (2, True), (3, True), (4, True), (5, True), (0, False), (0, True))
#: Bytes over which tokens share their beginnings.
WIDE = 32
#: Classes, marker words, and passes of the mixture over the texts (fewer when it stands).
CLASSES, MARKERS, PASSES = 6, 64, 40
#: Parts in which what tasks have summed up comes to the driver.
PARTS = 8
#: Slots of ``segments``, for tables in one process.
SLOT_BITS = 21
SLOTS = 1 << SLOT_BITS
CHUNK = 1 << 13
END = b"\xff"
#: Gates: how many contexts have been seen, how often the longest one was (by powers of two), whether it saw both bits.
SEEN, OFTEN = len(ORDERS) + 1, 12
GATES = SEEN * OFTEN * 2
CURVE = 33
PRIOR = 0.1
RATE = 0.05
#: A slice of texts does not tell of words that at most one in so many of them have, but for their bound.
RARE = 256
SEGMENT = 1 << 13

_U = np.uint64
_A, _B = _U(0x9E3779B97F4A7C15), _U(0xD6E8FEB86659FD93)
_NODE = np.arange(8)


def token_bytes(word: bytes) -> bytes:
    return word if word == END else word + b" "


def contexts(words: list[bytes], classes: np.ndarray, before: np.ndarray | None = None, new: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of all tokens, the token of each, and a hash of each order's context; ``before``: hash of the word before each; ``new``: which of the bytes are told of."""
    parts = [token_bytes(w) for w in words]
    data = np.frombuffer(b"".join(parts), np.uint8)
    size = np.array([len(p) for p in parts], np.int64)
    at = np.arange(len(data)) if new is None else np.flatnonzero(new)
    owner = np.repeat(np.arange(len(parts)), size)[at]
    starts = (np.cumsum(size) - size)[owner]
    place = at - starts
    out = np.empty((len(ORDERS), len(at)), np.uint64)
    wide = data.astype(np.uint64) + _U(1)
    kind = (classes.astype(np.uint64) + _U(1))[owner] * _B
    back = []
    for k in range(1, 1 + max(n for n, _ in ORDERS)):
        back.append(wide[np.maximum(at - k, 0)])
        back[-1][place < k] = 0
    power = np.full(len(data) + 1, _A, np.uint64)
    power[0] = 1
    power = np.cumprod(power, dtype=np.uint64)
    inverse = _U(pow(int(_A), -1, 1 << 64))
    undo = np.full(len(data) + 1, inverse, np.uint64)
    undo[0] = 1
    undo = np.cumprod(undo, dtype=np.uint64)
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(wide * power[:-1], dtype=np.uint64)))
    for row, (order, classed) in enumerate(ORDERS):
        if order > 0:
            h = np.full(len(at), order, np.uint64)
            for x in back[:order]:
                h = (h ^ x) * _A
                h ^= h >> _U(31)
        else:  # the prefix as a polynomial from the token's start, and its length
            h = ((total[at] - total[starts]) * undo[starts] ^ place.astype(np.uint64)) * _B
            if order == ACROSS and before is not None:
                h ^= h >> _U(29)
                h = (h ^ before.astype(np.int64).view(np.uint64)[owner]) * _A
            h ^= h >> _U(31)
        out[row] = (h ^ kind if classed else h) + _U((row + 1) * int(_B) & (1 << 64) - 1)
    for row, (order, _) in enumerate(ORDERS):  # near the start these are the whole token so far, which is asked about once
        out[row, place < order] = out[-1, place < order]
    return data[at], owner, out


class Shared:
    """Tokens in order, of which each beginning that several share is one node a byte.

    ``new``: the bytes (of all tokens one after the other) that are a node's first; ``spread`` sums token counts
    up to nodes, ``gathered`` sums node values down to tokens. Beginnings are shared over ``WIDE`` bytes at most.
    """

    def __init__(self, words: list[bytes], classes: np.ndarray):
        parts = [token_bytes(w) for w in words]
        self.size = np.array([len(p) for p in parts], np.int64)
        self.start = np.cumsum(self.size) - self.size
        head = np.array(parts, f"S{WIDE}").view(np.uint8).reshape(len(parts), WIDE) if parts else np.zeros((0, WIDE), np.uint8)
        equal = np.zeros((len(parts), WIDE), bool)
        equal[1:] = (head[1:] == head[:-1]) & (classes[1:] == classes[:-1])[:, None]
        self.lcp = np.minimum(np.where(equal.all(axis=1), WIDE, (~equal).argmax(axis=1)), self.size)
        self.lcp[1:] = np.minimum(self.lcp[1:], self.size[:-1])
        place = np.arange(int(self.size.sum())) - np.repeat(self.start, self.size)
        self.new = place >= np.repeat(self.lcp, self.size)
        self.at = np.cumsum(self.new) - 1  # the node of each byte that is new

    def levels(self):
        for j in range(min(WIDE, int(self.size.max(initial=0)))):
            first = np.flatnonzero(self.lcp <= j)
            yield j, first, self.size[first] > j

    def spread(self, counts: np.ndarray) -> np.ndarray:
        total = np.repeat(counts, self.size).astype(np.float64)
        for j, first, has in self.levels():
            total[self.start[first[has]] + j] = np.add.reduceat(counts, first)[has]
        return total[self.new]

    def nodes(self) -> np.ndarray:
        """The node of each byte."""
        out = np.zeros(len(self.new), np.int64)
        out[self.new] = np.arange(int(self.new.sum()))
        rows = np.arange(len(self.size))
        for j, _, _ in self.levels():
            source = np.maximum.accumulate(np.where(self.lcp <= j, rows, 0))
            has = self.size > j
            out[self.start[has] + j] = out[self.start[source[has]] + j]
        return out

    def gathered(self, values: np.ndarray) -> np.ndarray:
        every = np.zeros(len(self.new))
        every[self.new] = values
        long = self.size > WIDE
        place = np.arange(len(self.new)) - np.repeat(self.start, self.size)
        out = np.bincount(np.repeat(np.arange(len(self.size)), self.size), every * (place >= WIDE), len(self.size)) if long.any() else np.zeros(len(self.size))
        rows = np.arange(len(self.size))
        for j, _, _ in self.levels():
            source = np.maximum.accumulate(np.where(self.lcp <= j, rows, 0))
            has = self.size > j
            out[has] += every[self.start[source[has]] + j]
        return out


def tree(words: list[bytes], groups: np.ndarray, classes: np.ndarray, before: np.ndarray | None = None):
    """The Shared tokens (within groups), the byte of each node and the hashes of its contexts by order."""
    shared = Shared(words, groups)
    data, _, ctx = contexts(words, classes, before, shared.new)
    return shared, data.astype(np.int64), ctx


def segments(words: list[bytes], classes: np.ndarray):
    """For tables in one process: the Shared tokens, then (first node, slots by order, bits) for a stretch of nodes at a time."""
    shared, data, ctx = tree(words, classes, classes)
    yield shared
    for a in range(0, len(data), SEGMENT):
        byte = data[a : a + SEGMENT].astype(np.int64)
        node = (1 << _NODE) | (byte[:, None] >> (8 - _NODE))
        bits = (byte[:, None] >> (7 - _NODE) & 1).astype(np.int64)
        step = node.astype(np.uint64) * _B
        slots = np.empty((len(ORDERS), byte.size * 8), np.int64)
        for row in range(len(ORDERS)):
            h = (ctx[row, a : a + SEGMENT, None] ^ step) * _A
            h ^= h >> _U(32)
            slots[row] = ((h * _B) >> _U(64 - SLOT_BITS)).astype(np.int64).ravel()
        yield a, slots, bits.ravel()


def questions(data: np.ndarray, ctx: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (context, byte) pairs of a chunk's nodes, and the pair of each order and node."""
    pairs = np.empty(ctx.size, [("h", "<u8"), ("byte", "<i8")])
    pairs["h"], pairs["byte"] = ctx.ravel(), np.tile(data, len(ctx))
    order = np.lexsort((pairs["byte"], pairs["h"]))
    pairs = pairs[order]
    first = np.ones(len(pairs), bool)
    first[1:] = pairs[1:] != pairs[:-1]
    at = np.empty(ctx.size, np.int64)
    at[order] = np.cumsum(first) - 1
    return pairs["h"][first], pairs["byte"][first], at.reshape(ctx.shape)


def paths(h: np.ndarray, byte: np.ndarray, n: np.ndarray) -> np.ndarray:
    """For rows sorted by (context, byte): how often the context went on with the first 0 to 8 bits of the row's byte."""
    kind = np.int32 if n.sum() < 1 << 31 else np.int64
    first = np.ones(len(h) + 1, bool)
    first[1:-1] = h[1:] != h[:-1]
    out = np.repeat(n.astype(kind)[:, None], 9, axis=1)  # as it is where a context has gone on with one byte
    some = np.flatnonzero(~(first[:-1] & first[1:]))
    if len(some):
        byte, n, other = byte[some], n[some], first[some]
        apart = np.full(len(some), 256)
        apart[1:][~other[1:]] = (byte[1:] ^ byte[:-1])[~other[1:]]
        part = np.empty((9, len(some)), kind)
        for d in range(9):
            at = np.flatnonzero(apart >= 1 << (8 - d))
            part[d] = np.repeat(np.add.reduceat(n, at), np.diff(at, append=len(n)))
        out[some] = part.T
    return out


def packed(values: np.ndarray, size: np.ndarray) -> pa.Array:
    """Runs of ``size`` counts that never rise, each up to where it stays as it is, in the least width of 1, 2, 4 or 8 bytes."""
    end = np.cumsum(size)
    last = values[end - 1]
    more = values > np.repeat(last, size)
    lens = np.add.reduceat(more, end - size, dtype=np.int64) + 1 if len(size) else np.zeros(0, np.int64)
    start = np.cumsum(lens) - lens
    kept = np.empty(int(lens.sum()), np.int64)
    final = np.zeros(len(kept), bool)
    final[start + lens - 1] = True
    kept[final], kept[~final] = last, values[more]
    width = 1 << np.searchsorted([1 << 8, 1 << 16, 1 << 32], kept[start], "right")
    offset = np.concatenate((np.zeros(1, np.int64), np.cumsum(1 + lens * width)))
    data = np.empty(int(offset[-1]), np.uint8)
    data[offset[:-1]] = width
    each, at = np.repeat(width, lens), _places(offset[:-1], lens, width)
    raw = kept.astype("<i8").view(np.uint8).reshape(-1, 8)
    for b in range(8):
        data[at[each > b] + b] = raw[each > b, b]
    return pa.Array.from_buffers(pa.binary(), len(size), [None, pa.py_buffer(offset.astype(np.int32)), pa.py_buffer(data)])


def _places(offset: np.ndarray, lens: np.ndarray, width: np.ndarray) -> np.ndarray:
    """Where each count of each run is."""
    within = np.arange(int(lens.sum())) - np.repeat(np.cumsum(lens) - lens, lens)
    return np.repeat(offset + 1, lens) + within * np.repeat(width, lens)


def unpacked(runs: list[bytes] | pa.Array, size: np.ndarray | int) -> np.ndarray:
    """The counts that ``packed`` took."""
    runs = runs if isinstance(runs, pa.Array) else pa.array(runs, pa.binary())
    size = np.broadcast_to(size, len(runs))
    offset = np.frombuffer(runs.buffers()[1], np.int32)[runs.offset : runs.offset + len(runs) + 1].astype(np.int64) if len(runs) else np.zeros(1, np.int64)
    data = np.frombuffer(runs.buffers()[2] or b"", np.uint8)[offset[0] : offset[-1]]
    taken, offset = np.diff(offset), offset[:-1] - offset[0]
    width = data[offset].astype(np.int64)
    lens = (taken - 1) // np.maximum(width, 1)
    each, at = np.repeat(width, lens), _places(offset, lens, width)
    raw = np.zeros((len(at), 8), np.uint8)
    for b in range(8):
        raw[each > b, b] = data[at[each > b] + b]
    kept = raw.view("<i8").ravel()
    first = np.cumsum(size) - size
    out = np.repeat(kept[np.cumsum(lens) - 1], size)
    out[np.repeat(first, lens) + np.arange(len(kept)) - np.repeat(np.cumsum(lens) - lens, lens)] = kept
    return out


def firsts(words: list[bytes], *keys: np.ndarray) -> np.ndarray:
    """Which rows, in order, differ from the row before in word or keys."""
    new = np.fromiter((k == 0 or w != words[k - 1] for k, w in enumerate(words)), bool, len(words))
    for key in keys:
        new[1:] |= key[1:] != key[:-1]
    return new


class Tokens:
    """The distinct (class, word) of a chunk: shared beginnings, and the question of each order within the token and node."""

    def __init__(self, words: list[bytes], classes: np.ndarray):
        new = firsts(words, classes)
        self.first = np.flatnonzero(new)
        self.own = np.cumsum(new) - 1  # the token of each row
        self.shared, self.data, ctx = tree([words[k] for k in self.first], classes[self.first], classes[self.first])
        self.h, self.byte, self.at = questions(self.data, ctx[1:])
        self.once = ctx[1:] != ctx[-1]  # orders that are the whole token so far there count once, with the last
        self.once[-1] = True

    def spread(self, train: np.ndarray) -> np.ndarray:
        """Counts of rows, summed up for each question."""
        nodes = self.shared.spread(np.add.reduceat(train, self.first) if len(train) else train)
        return np.bincount(self.at.ravel(), (self.once * nodes).ravel(), len(self.h)).astype(np.int64)


class Chunk:
    """Rows of (class, word, word before) in order: counts of the contexts within each token, and of those that reach back for each row."""

    def __init__(self, words: list[bytes], classes: np.ndarray, found: np.ndarray, back: list[bytes]):
        self.tokens, self.found = Tokens(words, classes), found
        self.size = self.tokens.shared.size[self.tokens.own]
        self.start = np.cumsum(self.size) - self.size
        self.owner = np.repeat(np.arange(len(words)), self.size)
        place = np.arange(len(self.owner)) - self.start[self.owner]
        self.node = self.tokens.shared.nodes()[self.tokens.shared.start[self.tokens.own][self.owner] + place]
        run = unpacked(back, 8 * self.size + 1)
        skip = np.ones(len(run), bool)
        ends = np.cumsum(8 * self.size + 1)
        skip[ends - 1] = False
        self.total = run[skip].reshape(-1, 8)
        skip[ends - 1] = True
        skip[ends - 8 * self.size - 1] = False
        self.hit = run[skip].reshape(-1, 8)


def leaning(path: np.ndarray, leave_out: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of ``paths``, bit by bit: logit of the bit at hand, how often its context was seen, and whether with both bits."""
    run = np.ascontiguousarray(path.T)
    hit, miss = run[1:], run[:-1] - run[1:]
    if leave_out:
        hit = np.maximum(hit - 1, 0)
    x, y = (np.log(c.astype(np.float32) + np.float32(PRIOR)) for c in (hit, miss))
    x -= y
    return np.ascontiguousarray(x.T), np.ascontiguousarray((hit + miss).T), np.ascontiguousarray(((hit > 0) & (miss > 0)).T)


def opinion(hit: np.ndarray, total: np.ndarray, bits: np.ndarray, leave_out: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Logit of a 1, how often the context was seen, and whether with both bits; hit: how often it went on with the bit at hand."""
    miss = total - hit
    if leave_out:
        hit = np.maximum(hit - 1, 0)
    x, y = (np.log((c + PRIOR).astype(np.float32)) for c in (hit, miss))
    x -= y
    np.negative(x, out=x, where=bits == 0)
    return x, hit + miss, (hit > 0) & (miss > 0)


class Model:
    """Gated weights and the map; tables (order, slot, bit) only where one process holds them."""

    def __init__(self, tables: np.ndarray | None, weights: np.ndarray, curve: np.ndarray):
        self.tables, self.weights, self.curve = tables, weights, curve

    def mix(self, slots, bits, leave_out: bool):
        """``blend`` of the tables' slots."""
        return self.blend([self.tables[row][slots[row]].astype(np.float32) for row in range(len(slots))], bits, leave_out)

    def blend(self, pairs, bits, leave_out: bool):
        """Logits by order, gates, and the mixed logit, from pairs of counts by order."""
        logits = np.empty((len(pairs), len(bits)), np.float32)
        seen = np.zeros(len(bits), np.int64)
        for row, pair in enumerate(pairs):
            total = pair.sum(axis=1)
            logits[row], n, both = opinion(pair[np.arange(len(bits)), bits], total, bits, leave_out)
            seen += n > 0
        gate = (seen * OFTEN + often_of(n)) * 2 + both
        z = np.clip((self.weights[gate].T * logits).sum(axis=0), -12, 12)
        return logits, gate, z

    def refined(self, z, gate):
        """Half the mixed probability, half what the map has seen near it."""
        x = (np.clip(z, -8, 8) + 8) * ((CURVE - 1) / 16)
        lo = np.minimum(x.astype(np.int64), CURVE - 2)
        part = x - lo
        at, curve = gate * CURVE + lo, self.curve.ravel()
        mapped = curve[at] * (1 - part) + curve[at + 1] * part
        return np.clip(0.5 / (1 + np.exp(-z)) + 0.5 * mapped, 1e-6, 1 - 1e-6)

    def log10(self, words: list[bytes], classes: np.ndarray) -> np.ndarray:
        parts = segments(words, classes)
        shared, out = next(parts), []
        for _, slots, bits in parts:
            _, gate, z = self.mix(slots, bits, False)
            p = self.refined(z, gate)
            out.append(np.log10(np.where(bits, p, 1 - p)).reshape(-1, 8).sum(axis=1))
        return shared.gathered(np.concatenate(out) if out else np.zeros(0))


def often_of(n: np.ndarray) -> np.ndarray:
    return np.minimum(np.log2(n + 1.0).astype(np.int64), OFTEN - 1)


def start_weights() -> np.ndarray:
    return np.full((GATES, len(ORDERS)), 0.3)


def start_curve() -> np.ndarray:
    z = np.linspace(-8, 8, CURVE)
    return np.tile(1 / (1 + np.exp(-z)), (GATES, 1))


def split(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of all texts in lower case, one after the other, and how many each text has; a null text has none."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts.cast(pa.string()) if pa.types.is_large_string(texts.type) else texts))
    words, size = lists.flatten().cast(pa.binary()), pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    real = np.asarray(pc.binary_length(words)) > 0  # white space at an end of a text leaves an empty word there
    if not real.all():
        size = np.bincount(np.repeat(np.arange(len(size)), size)[real], minlength=len(size))
        words = words.filter(pa.array(real))
    return words, size


def raw_of(words: pa.Array) -> list[bytes]:
    """Bytes of a binary array without nulls."""
    ends = np.frombuffer(words.buffers()[1], np.int32)[words.offset : words.offset + len(words) + 1].tolist() if len(words) else [0]
    data = words.buffers()[2].to_pybytes() if len(words) and words.buffers()[2] else b""
    return [data[a:b] for a, b in zip(ends, ends[1:], strict=False)]


class Kinds:
    """The class of a document: the likeliest component of a mixture over marker words."""

    def __init__(self, markers: list[bytes], logs: np.ndarray):
        self.place, self.logs = {w: i for i, w in enumerate(markers)}, logs

    def __call__(self, tokens: list[bytes]) -> int:
        if not self.place:
            return 0
        n = Counter(filter(self.place.__contains__, tokens))
        total = self.logs[-1].copy()
        for w, k in n.items():
            total += k * self.logs[self.place[w]]
        return int(total.argmax())

    def of(self, seq: np.ndarray, doc: np.ndarray, docs: int, words: pa.Array) -> np.ndarray:
        """The class of each text: ``seq`` has its tokens as places in ``words``, ``doc`` the text of each."""
        if not self.place:
            return np.zeros(docs, np.int64)
        place = pc.fill_null(pc.index_in(words, value_set=pa.array(list(self.place), pa.binary())), -1).to_numpy(zero_copy_only=False)[seq]
        has, width = place >= 0, len(self.place)
        n = np.bincount(doc[has] * width + place[has], minlength=docs * width).reshape(docs, width)
        return (n @ self.logs[:-1] + self.logs[-1]).argmax(axis=1)


def document_counts(docs: DataFrame, rare: int, only: pa.Array | None = None) -> DataFrame:
    """(word, n, low) of words: how many training texts have each, as far as slices of the texts told of it, and the ``low`` of these slices; at a null word that of all slices; docs: held_out, text.

    A slice tells of words that more than ``low`` of its texts have, which is one in ``rare`` (0: of every word); ``only``: of these alone, whatever their number.
    """

    def run(batches):
        for batch in C.slices(batches):
            words, size = split(batch.column("text"))
            words = words.dictionary_encode()
            width = max(1, len(words.dictionary))
            pairs = np.sort(np.repeat(np.arange(len(size)), size) * width + words.indices.to_numpy())
            n = np.bincount(pairs[np.diff(pairs, prepend=-1) > 0] % width, minlength=width)[: len(words.dictionary)]
            low = batch.num_rows // rare if rare and only is None else 0
            kept = np.flatnonzero(n > low if only is None else pc.is_in(words.dictionary, value_set=only).to_numpy(zero_copy_only=False))
            yield pa.record_batch([pa.array([*raw_of(words.dictionary.take(pa.array(kept))), None], pa.binary()), pa.array([*n[kept].tolist(), 0], pa.int64()), pa.array([low] * (len(kept) + 1), pa.int64())], names=["word", "n", "low"])

    return docs.where("not held_out").select("text").mapInArrow(run, "word binary, n long, low long").groupBy("word").agg(F.sum("n").alias("n"), F.sum("low").alias("low"))


def find_markers(docs: DataFrame, rare: int = RARE) -> list[bytes]:
    """The MARKERS words that the most training texts have, ties by the word; docs: held_out, text.

    Slices tell of frequent words only, with a bound for the others. Words that could be among the first by these bounds are
    counted once more if a slice did not tell of one of them, and where the bounds decide nothing, all words are counted.
    """
    found = C.stage(document_counts(docs, rare), "lm-words")
    low = (found.where("word is null").first() or {"low": 0})["low"]  # at most so many texts have a word that no slice tells of
    near = found.where("word is not null")
    if low:
        top = [r["n"] for r in near.orderBy(F.desc("n")).limit(MARKERS).select("n").collect()]  # MARKERS numbers
        if len(top) == MARKERS and top[-1] > low:
            near = near.where(F.col("n") + F.lit(low) - F.col("low") >= top[-1])
            if near.where(F.col("low") < low).limit(1).count():
                # each of these is in more texts than top[-1] - low, so they are few beside the texts' words
                near = document_counts(docs, rare, pa.array([bytes(r["word"]) for r in near.select("word").collect()], pa.binary())).where("word is not null")
        else:
            near = document_counts(docs, 0).where("word is not null")
    out = [bytes(r["word"]) for r in near.orderBy(F.desc("n"), "word").limit(MARKERS).collect()]  # MARKERS words
    C.unstage(found)
    return out


def marker_counts(docs: DataFrame, markers: list[bytes]) -> DataFrame:
    """(x, n): how often a training text has each marker (4 byte integers), and how many texts have just these counts."""
    own = pa.array(markers, pa.binary())

    def run(batches):
        for batch in C.slices(batches):
            words, size = split(batch.column("text"))
            place = pc.fill_null(pc.index_in(words, value_set=own), -1).to_numpy(zero_copy_only=False)
            at = (np.repeat(np.arange(len(size)), size) * len(markers) + place)[place >= 0]
            x = np.bincount(at, minlength=len(size) * len(markers)).reshape(len(size), len(markers)).astype("<u4")
            yield pa.record_batch([pa.array([r.tobytes() for r in x[x.any(axis=1)]], pa.binary())], names=["x"])

    return docs.where("not held_out").select("text").mapInArrow(run, "x binary").groupBy("x").agg(F.count(F.lit(1)).alias("n"))


def summed(rows: DataFrame, width: int, step, add) -> bytes:
    """What ``step`` makes of the square roots of the counts and the numbers of texts, put together two by two with ``add``, first within tasks, so that PARTS results reach the driver whatever the input."""

    def within(found):
        total = None
        for x in found:
            total = x if total is None else add(total, x)
        if total is not None:
            yield pa.record_batch([pa.array([total], pa.binary())], names=["s"])

    def run(batches):
        def each():
            for batch in batches:
                if batch.num_rows:
                    x = np.frombuffer(b"".join(batch.column("x").to_pylist()), "<u4").reshape(batch.num_rows, width)
                    yield step(x, np.sqrt(x), np.asarray(batch.column("n"), np.float64))

        yield from within(each())

    def again(batches):
        yield from within(s for batch in batches for s in batch.column("s").to_pylist())

    sums = rows.mapInArrow(run, "s binary")
    if rows.rdd.getNumPartitions() > PARTS:
        sums = sums.repartition(PARTS).mapInArrow(again, "s binary")
    found = [bytes(r["s"]) for r in sums.collect()]
    # sums of rounded numbers depend on their order: the driver's is fixed by value
    total = None
    for x in sorted(found):
        total = x if total is None else add(total, x)
    return total


def farthest(rows: DataFrame, width: int, heads: list[np.ndarray]) -> np.ndarray:
    """Counts of the text that is least like the heads (without heads: the one with most markers), ties by the counts."""
    top = np.sqrt(np.array(heads, np.float64)).reshape(len(heads), width)
    top = top / np.sqrt((top * top).sum(axis=1))[:, None]

    def near(root):
        return (root / np.sqrt((root * root).sum(axis=1))[:, None] @ top.T).max(axis=1).round(9) if heads else -root.sum(axis=1)

    def step(x, root, n):
        value = near(root)
        return min(x[i].tobytes() for i in np.flatnonzero(value == value.min()))

    def least(a: bytes, b: bytes) -> bytes:
        return min(a, b, key=lambda r: (near(np.sqrt(np.frombuffer(r, "<u4"))[None])[0], r))

    return np.frombuffer(summed(rows, width, step, least), "<u4")


def learn_kinds(docs: DataFrame) -> Kinds:
    """From all training texts: each pass over them sends sums by class to the driver; docs: held_out, text."""
    none = Kinds([], np.zeros((1, 1)))
    markers = find_markers(docs)
    if not markers:
        return none
    rows = C.stage(marker_counts(docs, markers), "lm-markers", "zstd")
    width, k = len(markers), min(CLASSES, rows.limit(CLASSES).count())
    if k < 2:
        C.unstage(rows)
        return none
    heads: list[np.ndarray] = []
    while len(heads) < k:  # start from texts that are far from each other
        heads.append(farthest(rows, width, heads))
    unit = np.sqrt(np.array(heads, np.float64))
    unit = unit / np.sqrt((unit * unit).sum(axis=1))[:, None]
    logs = prior = last = None
    for _ in range(PASSES):

        def step(x, root, n, logs=logs, prior=prior):
            if logs is None:
                weight = np.eye(k)[(root @ unit.T).argmax(axis=1)]
                fit = 0.0
            else:
                z = root @ logs + prior
                high = z.max(axis=1)[:, None]
                weight = np.exp(z - high)
                fit = float((n * (high[:, 0] + np.log(weight.sum(axis=1)))).sum())
                weight /= weight.sum(axis=1)[:, None]
            weight *= n[:, None]
            return np.concatenate((weight.sum(axis=0), (weight.T @ root).ravel(), [fit])).tobytes()

        total = np.frombuffer(summed(rows, width, step, lambda a, b: (np.frombuffer(a) + np.frombuffer(b)).tobytes()))
        share, words, fit = total[:k] + 1, total[k:-1].reshape(k, width) + 0.1, total[-1]
        logs, prior = np.log(words / words.sum(axis=1)[:, None]).T, np.log(share / share.sum())
        if last is not None and abs(fit - last) <= 1e-6 * abs(last):
            break
        last = fit if fit else None
    C.unstage(rows)
    return Kinds(markers, np.vstack((logs, prior)))


class Hashes(dict):
    """Hashes of words, each made once."""

    def __missing__(self, word: bytes) -> int:
        h = self[word] = int(hashed([word])[0].astype(np.int64))
        return h


def hashed(words: list[bytes]) -> np.ndarray:
    """64 bits of each word."""
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def joined(tokens: list[bytes], hashes: Hashes) -> zip:
    """(hash of the word before, 0 at a text's start; word) of each token."""
    return zip([0, *map(hashes.__getitem__, tokens[:-1])], tokens, strict=True)


_CHUNK = "chunk long, classes binary, before binary, train binary, words array<binary>"


def chunked(rows: DataFrame, tasks: int, *order: str) -> DataFrame:
    """Rows (class, before, word, train, and perhaps ``back``) in ``order``, up to CHUNK of them in one."""
    back = "back" in rows.columns

    def run(batches):
        part, k = TaskContext.get().partitionId() << 32, 0
        for batch in C.slices(batches, "word"):
            for a in range(0, batch.num_rows, CHUNK):
                own = batch.slice(a, CHUNK)
                numbers = [pa.array([np.asarray(own.column(c), "<i8").tobytes()], pa.binary()) for c in ("class", "before", "train")]
                lists = [pa.array([own.column(c).to_pylist()], pa.list_(pa.binary())) for c in ("word", "back")[: 1 + back]]
                yield pa.record_batch([pa.array([part + k], pa.int64()), *numbers, *lists], names=["chunk", "classes", "before", "train", "words", "back"][: 5 + back])
                k += 1

    return rows.repartitionByRange(tasks, *order).sortWithinPartitions(*order).mapInArrow(run, _CHUNK + ", back array<binary>" * back)


def opened(batch, i: int) -> tuple[list[bytes], np.ndarray, np.ndarray, np.ndarray]:
    """words, classes, words before, counts of a chunk."""
    return batch.column("words")[i].as_py(), *(np.frombuffer(batch.column(c)[i].as_py(), "<i8") for c in ("classes", "before", "train"))


class Followers:
    """The words after each word before, in a chunk in the order (before, word): the context across is a stretch of rows."""

    def __init__(self, words: list[bytes], before: np.ndarray, train: np.ndarray):
        new = firsts(words, before)
        first = np.flatnonzero(new)
        self.own = np.cumsum(new) - 1
        self.shared, data, ctx = tree([words[k] for k in first], before[first], np.zeros(len(first), np.int64), before[first])
        self.h, self.byte, self.at = questions(data, ctx[:1])
        self.n = np.bincount(self.at[0], self.shared.spread(np.add.reduceat(train, first)), len(self.h)).astype(np.int64)
        # only a context of the first or the last word can go on in other chunks
        self.edge = np.isin(self.h, np.unique(self.h[self.at[0][self._path(0) + self._path(-1)]]))

    def _path(self, k: int) -> list[int]:
        nodes, start = self.shared.nodes(), self.shared.start[k]
        return nodes[start : start + self.shared.size[k]].tolist()

    def back(self, h: np.ndarray, byte: np.ndarray, n: np.ndarray) -> pa.Array:
        """``packed`` counts of each row's contexts; h, byte, n: the counts of the contexts at the edges over all chunks."""
        every = [np.concatenate((own[~self.edge], new)) for own, new in ((self.h, h), (self.byte, byte), (self.n, n))]
        order = np.lexsort((every[1], every[0]))
        every = [x[order] for x in every]
        keys = np.empty(len(order), [("h", "<u8"), ("byte", "<i8")])
        keys["h"], keys["byte"] = every[:2]
        want = np.empty(len(self.h), keys.dtype)
        want["h"], want["byte"] = self.h, self.byte
        path = paths(*every)[np.searchsorted(keys, want)][self.at[0]][self.shared.nodes()]
        size = 8 * self.shared.size + 1
        begin = np.zeros(int(size.sum()), bool)
        begin[np.cumsum(size) - size] = True
        values = np.empty(len(begin), np.int64)
        values[begin], values[~begin] = path[self.shared.start, 0], path[:, 1:].ravel()
        return packed(values, size).take(pa.array(self.own))


def followed(vocabulary: DataFrame, tasks: int) -> DataFrame:
    """(class, before, word, train, back) of the rows of ``vocabulary``: the ``packed`` counts of the contexts that reach back to the word before.

    Rows in the order (before, word) hold each context as a stretch, so it is counted where it is; only for stretches at the edges of
    chunks are sums of all chunks put together, so a very common word before is spread over many chunks.
    """
    chunks = C.stage(chunked(vocabulary, tasks, "before", "word", "class"), "lm-followers", "zstd")

    def edges(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                words, _, before, train = opened(batch, i)
                own = Followers(words, before, train)
                yield pa.record_batch([pa.array(np.full(int(own.edge.sum()), batch.column("chunk")[i].as_py())), pa.array(own.h[own.edge].view(np.int64)), pa.array(own.byte[own.edge]), pa.array(own.n[own.edge])], names=["chunk", "h", "byte", "n"])

    found = C.stage(chunks.select("chunk", "classes", "before", "train", "words").mapInArrow(edges, "chunk long, h long, byte long, n long"), "lm-edges", "zstd")
    sums = found.groupBy("h", "byte").agg(F.sum("n").alias("n"))
    told = found.select("chunk", "h").distinct().join(sums, "h")
    schema = pa.schema([("class", pa.int64()), ("before", pa.int64()), ("word", pa.binary()), ("train", pa.int64()), ("back", pa.binary())])

    def finish(own: pa.Table, rows: pa.Table) -> pa.Table:
        words, classes, before, train = opened(own, 0)
        h, byte, n = (rows.column(c).to_numpy() for c in ("h", "byte", "n"))
        back = Followers(words, before, train).back(h.view(np.uint64), byte, n)
        return pa.table([pa.array(classes), pa.array(before), pa.array(words, pa.binary()), pa.array(train), back], schema=schema)

    out = C.stage(chunks.groupBy("chunk").cogroup(told.groupBy("chunk")).applyInArrow(finish, "class long, before long, word binary, train long, back binary"), "lm-followed", "zstd")
    C.unstage(chunks, found)
    return out


def count_contexts(chunks: DataFrame, tasks: int) -> DataFrame:
    """The chunks with ``found``: the paths of the questions of their tokens over all training tokens.

    The counts are a table by the 64 bit hash of a context, so it grows with the contexts and nothing shares an entry. They are
    summed up by context and byte before the rows of a context meet, so these are 256 at most, however many chunks ask for it.
    """

    def asking(counts: bool):
        def ask(batches):
            for batch in batches:
                for i in range(batch.num_rows):
                    words, classes, _, train = opened(batch, i)
                    own = Tokens(words, classes)
                    n = own.spread(train) if counts else None
                    for a in range(0, len(own.h), 1 << 16):
                        part = slice(a, a + (1 << 16))
                        h = own.h[part].view(np.int64)
                        key = [pa.array(h), pa.array(own.byte[part].astype(np.int16))]
                        if counts:
                            yield pa.record_batch([*key, pa.array(n[part])], names=["h", "byte", "n"])
                        else:
                            yield pa.record_batch([*key, pa.array(np.full(len(h), batch.column("chunk")[i].as_py())), pa.array(np.arange(a, a + len(h), dtype=np.int32))], names=["h", "byte", "chunk", "spot"])

        return ask

    def answer(batches):
        kept: list = []

        def flush():
            rows = pa.Table.from_batches(kept).combine_chunks()
            path = paths(*(rows.column(c).to_numpy() for c in ("h", "byte", "n")))
            yield from pa.table([rows.column("h"), rows.column("byte"), packed(path.ravel(), np.full(len(path), 9))], names=["h", "byte", "path"]).to_batches(max_chunksize=1 << 16)
            kept.clear()

        for batch in batches:  # a context's rows may go on in the next batch
            if not batch.num_rows:
                continue
            h = batch.column("h").to_numpy()
            cut = int(np.flatnonzero(h != h[-1])[-1]) + 1 if h[0] != h[-1] else 0
            if kept and kept[-1].column("h")[0].as_py() != h[0]:
                yield from flush()
            if cut:
                kept.append(batch.slice(0, cut))
                yield from flush()
            kept.append(batch.slice(cut))
        if kept:
            yield from flush()

    def gather(own: pa.Table, rows: pa.Table) -> pa.Table:
        path = np.empty((rows.num_rows, 9), np.int64)
        path[rows.column("spot").to_numpy()] = unpacked(rows.column("path").to_pylist(), np.full(rows.num_rows, 9)).reshape(-1, 9)
        return own.append_column("found", pa.array([zlib.compress(path.tobytes(), 1)], pa.binary()))

    tokens = chunks.select("chunk", "classes", "before", "train", "words")
    sums = tokens.mapInArrow(asking(True), "h long, byte short, n long").groupBy("h", "byte").agg(F.sum("n").alias("n"))
    answers = sums.repartition(tasks, "h").sortWithinPartitions("h", "byte").mapInArrow(answer, "h long, byte short, path binary")
    asked = tokens.mapInArrow(asking(False), "h long, byte short, chunk long, spot int")
    told = asked.join(answers, ["h", "byte"]).select("chunk", "spot", "path")
    return chunks.groupBy("chunk").cogroup(told.groupBy("chunk")).applyInArrow(gather, _CHUNK + ", back array<binary>, found binary")


def merge(parts) -> tuple[np.ndarray, np.ndarray]:
    """Weights averaged by the mass that each gate has seen, from sums; the map from all hits."""
    total, weighed, hits = np.zeros(GATES), np.zeros((GATES, len(ORDERS))), np.zeros((2, GATES, CURVE))
    for own, mass, seen in parts:
        total += mass
        weighed += own
        hits += seen
    weights = np.where(total[:, None] > 1, weighed / np.maximum(total, 1e-12)[:, None], start_weights())
    curve = (hits[1] + 20 * start_curve()) / (hits[0] + 20)
    return weights, curve


def score(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte of every row of ``docs``."""
    from ledgerloom.llm import lm_shards as S

    spark = docs.sparkSession
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    dealt = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (C.crc_mod("doc_id", 7) == 2).alias("held_out"), "text")
    kinds, bounds = learn_kinds(dealt.select("held_out", "text")), S.bounds_of(dealt, int(size))
    shards = len(bounds) + 1
    parts, rounds = 1 + shards // 2, min(S.ROUNDS, shards)
    path = S.apart(S.pieces(dealt, kinds, bounds), shards, rounds)
    # round by round, so that what a shuffle holds and what it is made of lie on disk together for a part of the shards only
    whole, informed = [], []
    for k in range(rounds):
        whole.append(C.stage(S.merged(S.read(spark, path, k)), "lm-shards"))
        C.delete(spark, f"{path}/round={k}")
        _settle(spark)
    told = C.stage(S.by_round(S.answers(S.asks(S.union(whole), bounds, parts)), shards, rounds), "lm-answers", "snappy", "round")
    _settle(spark)
    for k in range(rounds):
        informed.append(C.stage(S.informed(whole[k], told.where(F.col("round") == k).drop("round")), "lm-contexts"))
        C.unstage(whole[k])
        C.delete(spark, f"{told._staged_path}/round={k}")
        _settle(spark)
    C.unstage(told)
    weights, curve, n, known, ends = S.learned(S.union(informed), bounds, parts)
    kind_cost = np.log10((ends + 1) / (ends.sum() + CLASSES)).tolist()
    costs = C.stage(S.costs(S.union(informed), bounds, parts, weights, curve), "lm-costs")
    C.unstage(*informed)
    return S.scored(S.read(spark, path, S.TEXTS), costs, kind_cost, n, known, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, bits_per_byte double")


def _settle(spark) -> None:
    for _ in range(2):  # what the first lets go of, the second finds as garbage
        C.release(spark)
        time.sleep(0.3)
