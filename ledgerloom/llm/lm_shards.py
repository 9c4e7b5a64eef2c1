"""Pairs of words for ``lm_scoring``, in shards: what its contexts counted, and what each pair costs.

Tasks that read texts cut them into pieces. A piece has its distinct rows (token, word before, class, training count) in order, as
blobs by shard, and for each text the rows it is made of. Shards are ranges of (token, hash of the word before), cut at quantiles of a
bounded sample that sets their balance alone, so a frequent token is spread over shards. As a shard has a range of tokens, a context that starts at the token's
first byte is complete in it, unless the token at either bound of the shard begins with it; those, and the contexts of 1 to 5 bytes, are
summed up over shards by their key. A prediction depends on (class, word before, bits so far), so rows that share these share it, and where the word
before has been seen with no other continuation only (class, bits so far) is left of it.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left
from functools import reduce
from itertools import count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm import common as C
from ledgerloom.llm import lm_scoring as M

#: Bytes of text in a piece, and of text for each shard.
PIECE_BYTES, SHARD_BYTES = 8 << 20, 6 << 20
#: Bytes of text of the sample that sets the bounds of shards; one of so many of its pairs is taken, with tokens shorter than LONG.
SAMPLE_BYTES, SAMPLED, LONG = 8 << 20, 64, 64
#: Rounds in which shards are put together, so that only a part of them is on disk twice, and the number that stands for the texts.
ROUNDS, TEXTS = 6, -1
#: Rows whose contexts are followed at a time, and nodes in a step.
ROWS, STEP = 1 << 16, 1 << 13

_U = np.uint64
_LOW = _U(255)


def blob(**columns) -> bytes:
    """Columns of one length, compressed."""
    table = pa.table(columns)
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_table(table)
    return sink.getvalue().to_pybytes()


def opened(data: bytes) -> list[np.ndarray]:
    return [c.to_numpy(zero_copy_only=False) if pa.types.is_boolean(c.type) else c.to_numpy() for c in pa.ipc.open_stream(data).read_all().columns]


def tokens_of(data: bytes) -> pa.Array:
    return pa.ipc.open_stream(data).read_all().column(0).combine_chunks()


def steps(x: np.ndarray) -> np.ndarray:
    """Differences of numbers that rise, from 0; cumsum gives them back."""
    return np.diff(x, prepend=0).astype(np.int32)


def places(key: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """grouped for numbers below ``size``."""
    has = np.zeros(size, bool)
    has[key] = True
    return np.flatnonzero(has), (np.cumsum(has) - 1)[key]


def slim(n: np.ndarray) -> np.ndarray:
    """Counts in the least width."""
    return n.astype(np.min_scalar_type(int(n.max(initial=0))))


def planes(key: np.ndarray) -> np.ndarray:
    """Hashes that rise, as bytes of their differences by place: the high ones are short when compressed."""
    return np.ascontiguousarray(np.diff(key, prepend=_U(0)).astype("<u8").view(np.uint8).reshape(-1, 8).T).ravel()


def unplaned(data: np.ndarray) -> np.ndarray:
    return np.cumsum(np.ascontiguousarray(data.reshape(8, -1).T).view("<u8").ravel(), dtype=np.uint64)


class Piece:
    """Texts of a task, as rows of their distinct (token, word before, class)."""

    def __init__(self):
        self.texts, self.docs, self.bytes = [], [], 0

    def add(self, ids: list, held: list[bool], texts: pa.Array) -> None:
        self.texts.append(M.split(texts))
        self.docs += zip(ids, held, strict=True)
        self.bytes += texts.nbytes

    def rows(self, kinds):
        """tokens in order, hashes of words before in order (0: none), then token, before, class, training count of the distinct rows in order, the row of each token of the texts, and tokens, class and bytes of each text."""
        words = pa.concat_arrays([w for w, _ in self.texts]).dictionary_encode()
        size = np.concatenate([n for _, n in self.texts])
        plain = M.raw_of(words.dictionary)
        doc = np.repeat(np.arange(len(size)), size)
        seq = words.indices.to_numpy().astype(np.int64)
        kind = kinds.of(seq, doc, len(size), words.dictionary)
        length = np.bincount(doc, np.asarray(pc.binary_length(words.dictionary))[seq] + 1, len(size)).astype(np.int64)
        last = np.cumsum(size + 1) - 1  # each text ends with the end mark
        every = [M.token_bytes(w) for w in plain] + [M.END]
        whole = np.full(len(seq) + len(size), len(plain))
        whole[np.arange(len(seq)) + doc] = seq
        size, seq = size + 1, whole
        order = sorted(range(len(every)), key=every.__getitem__)
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        hashed = M.hashed([*plain, M.END])
        befores, place = np.unique(np.concatenate((np.zeros(1, np.uint64), hashed)), return_inverse=True)
        before = np.concatenate((np.zeros(1, np.int64), place[1:][seq[:-1]]))
        before[last - size + 1] = 0
        train = np.repeat([not d[1] for d in self.docs], size)
        key, row = grouped((rank[seq] * len(befores) + before) * M.CLASSES + np.repeat(kind, size))
        pair, k = np.divmod(key, M.CLASSES)
        token, before = np.divmod(pair, len(befores))
        return [every[i] for i in order], befores, token, before, k, np.bincount(row, train, len(key)).astype(np.int64), row, (size, kind, length)

    def told(self, number: int, bounds: list[tuple[bytes, int]], kinds):
        """(piece, shard, blobs) of each shard, and with shard -1 the texts."""
        tokens, befores, token, before, kind, train, row, (size, own, length) = self.rows(kinds)
        pair, words = token * len(befores) + before, pa.array(tokens, pa.binary())
        cuts = [0]
        for t, h in bounds:
            at = bisect_left(tokens, t)
            at = at * len(befores) + (int(np.searchsorted(befores, _U(h))) if at < len(tokens) and tokens[at] == t else 0)
            cuts.append(int(np.searchsorted(pair, at)))
        for shard, (a, b) in enumerate(zip(cuts, [*cuts[1:], len(pair)], strict=True)):
            if a < b:
                new = np.ones(b - a, bool)
                new[1:] = token[a + 1 : b] != token[a : b - 1]
                met, x = places(before[a:b], len(befores))
                yield number, shard, blob(t=words.take(pa.array(token[a:b][new]))), blob(h=planes(befores[met])), blob(t=new, b=x.astype(np.int32), k=kind[a:b].astype(np.int8), n=slim(train[a:b]))
        ids, held = zip(*self.docs, strict=True)
        yield number, -1, blob(i=pa.array(ids, pa.int64()), held=pa.array(held, pa.bool_()), n=size, k=own, s=np.maximum(length, 1)), b"", blob(row=row.astype(np.int32))


_PIECES = "piece long, shard int, first binary, second binary, third binary"


def bounds_of(docs: DataFrame, size: int) -> list[tuple[bytes, int]]:
    """(token, hash of the word before) at which shards begin but for the first."""
    shards, share = 1 + size // SHARD_BYTES, 1 + size // SAMPLE_BYTES

    def run(batches):
        found, hashes = set(), M.Hashes()
        for batch in C.slices(batches):
            for text in C.raw(batch.column("text")):
                if len(text) < PIECE_BYTES:
                    found.update((M.token_bytes(w), h) for h, w in M.joined([*text.lower().split(), M.END], hashes) if len(w) < LONG and (h ^ zlib.crc32(w)) % SAMPLED == 0)
        yield pa.record_batch([pa.array([t for t, _ in found], pa.binary()), pa.array([h for _, h in found], pa.int64())], names=["t", "h"])

    if shards == 1:
        return []
    sample = docs.where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(share)) == 0).select("text").mapInArrow(run, "t binary, h long")
    found = sorted({(bytes(r["t"]), r["h"] % (1 << 64)) for r in sample.collect()})  # of some SAMPLE_BYTES
    return sorted({found[len(found) * k // shards] for k in range(1, shards)}) if found else []


def pieces(docs: DataFrame, kinds, bounds) -> DataFrame:
    """Texts (doc_id, held_out, text) as pieces."""

    def run(batches):
        part, k, own = TaskContext.get().partitionId() << 32, 0, Piece()

        def flush():
            for row in own.told(part + k, bounds, kinds):
                yield pa.record_batch([pa.array([x]) for x in row[:1]] + [pa.array([row[1]], pa.int32())] + [pa.array([x], pa.binary()) for x in row[2:]], names=["piece", "shard", "first", "second", "third"])

        for batch in C.slices(batches, size=PIECE_BYTES >> 3):
            own.add(batch.column("doc_id").to_pylist(), batch.column("held_out").to_pylist(), batch.column("text"))
            if own.bytes >= PIECE_BYTES:
                yield from flush()
                own, k = Piece(), k + 1
        if own.docs:
            yield from flush()
        del own
        C.trim()

    return docs.mapInArrow(run, _PIECES)


def by_round(found: DataFrame, shards: int, rounds: int) -> DataFrame:
    """``found`` with the round of its shard; texts have their own."""
    return found.withColumn("round", F.when(F.col("shard") < 0, TEXTS).otherwise(F.expr(f"cast(shard * bigint({rounds}) div {shards} as int)")))


def apart(found: DataFrame, shards: int, rounds: int) -> str:
    """Pieces staged with texts and each round's pairs in folders of their own, so that each can go when it has been read."""
    path = C.new_path(found.sparkSession, "lm-pieces")
    by_round(found, shards, rounds).write.partitionBy("round").parquet(path)
    return path


def read(spark, path: str, k: int) -> DataFrame:
    return spark.read.schema(f"{_PIECES}, round int").parquet(path).where(F.col("round") == k).drop("round")


def union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionAll, frames)


_MERGED = "shard int, tokens binary, befores binary, rows binary, members array<binary>, pieces array<long>"


def merged(found: DataFrame) -> DataFrame:
    """The distinct rows of each shard over all pieces, and which of them each piece has."""

    def run(table: pa.Table) -> pa.Table:
        parts = sorted(zip(*(table.column(c).to_pylist() for c in ("piece", "first", "second", "third")), strict=True))
        lists = [tokens_of(p[1]) for p in parts]
        every = pa.concat_arrays(lists).dictionary_encode()
        plain = M.raw_of(every.dictionary)
        order = sorted(range(len(plain)), key=plain.__getitem__)
        place, tokens = np.empty(len(order), np.int64), [plain[i] for i in order]
        place[order] = np.arange(len(order))
        own = np.split(place[every.indices.to_numpy()], np.cumsum([len(x) for x in lists])[:-1])
        hashes = [unplaned(opened(p[2])[0]) for p in parts]
        befores = np.unique(np.concatenate(hashes))
        keys, counts = [], []
        for spots, h, p in zip(own, hashes, parts, strict=True):
            t, b, k, n = opened(p[3])
            t = spots[np.cumsum(t) - 1]
            keys.append((t * len(befores) + np.searchsorted(befores, h)[b]) * M.CLASSES + k)
            counts.append(n)
        key, row = grouped(np.concatenate(keys), "stable")
        n = np.zeros(len(key), np.int64)
        np.add.at(n, row, np.concatenate(counts))
        pair, k = np.divmod(key, M.CLASSES)
        t, b = np.divmod(pair, len(befores))
        members = [blob(row=steps(x)) for x in np.split(row, np.cumsum([len(x) for x in keys])[:-1])]
        values = [table.column("shard")[0].as_py(), blob(t=pa.array(tokens, pa.binary())), blob(h=planes(befores)), blob(t=steps(t), b=b.astype(np.int32), k=k.astype(np.int8), n=slim(n)), members, [p[0] for p in parts]]
        kinds = [pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.list_(pa.binary()), pa.list_(pa.int64())]
        return pa.table([pa.array([v], kind) for v, kind in zip(values, kinds, strict=True)], names=["shard", "tokens", "befores", "rows", "members", "pieces"])

    return found.where("shard >= 0").groupBy("shard").applyInArrow(run, _MERGED)


def keyed(h: np.ndarray, byte: np.ndarray) -> np.ndarray:
    """56 bits of a context's hash, and the byte after it."""
    return (h & ~_LOW) | byte.astype(np.uint64)


def grouped(key: np.ndarray, how: str | None = None):
    """np.unique with the inverse; ``how``: stable where the keys are runs in order."""
    order = np.argsort(key, kind=how)
    key = key[order]
    first = np.ones(len(key), bool)
    first[1:] = key[1:] != key[:-1]
    at = np.empty(len(key), np.int64)
    at[order] = np.cumsum(first) - 1
    return key[first], at


class Shard:
    """Rows of a shard by (word before, token, class), and the nodes of its tokens: the bytes of (class, token), beginnings shared; ``ends``: its bounds."""

    def __init__(self, tokens: bytes, befores: bytes, rows: bytes, ends: list[tuple[bytes, int]]):
        words = M.raw_of(tokens_of(tokens))
        self.befores = unplaned(opened(befores)[0])
        t, b, k, n = opened(rows)
        self.n = n.astype(np.int64)
        t, b, k = np.cumsum(t, dtype=np.int64), b.astype(np.int64), k.astype(np.int64)
        self.order = np.sort((b << 32) | np.arange(len(b))) & (1 << 32) - 1  # rows are in the order (token, word before, class)
        self.t, self.b, self.k, self.n = t[self.order], b[self.order], k[self.order], self.n[self.order]
        kind, self.own = places(self.k * len(words) + self.t, M.CLASSES * len(words))  # the (class, token) of each row
        k, t = np.divmod(kind, len(words))
        self.last = t, k
        plain = [words[i] if words[i] == M.END else words[i][:-1] for i in t.tolist()]
        self.shared, self.data, ctx = M.tree(plain, k, k)
        self.nodes = self.shared.nodes()
        size = np.array([len(w) for w in words])
        head = np.array(words, f"S{LONG}").view(np.uint8).reshape(-1, LONG)
        depth = np.full(len(words), -1)
        for end, _ in ends:
            same = (head[:, : len(end)] == np.frombuffer(end, np.uint8)[:LONG]).cumprod(axis=1).sum(axis=1)
            depth = np.maximum(depth, np.minimum(same, size))
        start = np.cumsum(size) - size
        self.size, self.start, self.depth, self.bytes = size, start, depth, np.frombuffer(b"".join(words), np.uint8)
        long = np.repeat(self.shared.size, self.shared.size)
        place = np.arange(len(long)) - np.repeat(self.shared.start, self.shared.size)
        place, deep = place[self.shared.new], np.repeat(depth[t], self.shared.size)[self.shared.new]
        self.prefix = ctx[-2].copy()  # by the bytes so far alone
        # whole beginnings of tokens that no other shard can have are complete here
        shut = np.array([(order <= 0) | (place < order) for order, _ in M.ORDERS[1:]]) & (place > deep)
        once = ctx[1:] != ctx[-1]
        once[-1] = True
        key, at = grouped(keyed(ctx[1:], np.broadcast_to(self.data, once.shape))[once])
        self.at = np.empty(once.shape, np.int32)
        self.at[once] = at
        self.at[:-1] = np.where(once[:-1], self.at[:-1], self.at[-1])
        self.key, self.open = key, np.ones(len(key), bool)
        self.open[self.at[shut]] = False
        train = np.bincount(self.own, self.n, len(kind))
        weight = np.broadcast_to(self.shared.spread(train), once.shape)[once]
        self.count = np.bincount(at, weight, len(key)).astype(np.int64)

    def level(self, rows: np.ndarray, context: np.ndarray, j: int):
        """Of rows that go on at byte j: their bytes, the first row of each (context, byte), and the (context, byte) of each."""
        byte = self.bytes[self.start[self.t[rows]] + j].astype(np.int64)
        new = np.ones(len(rows), bool)
        new[1:] = (context[1:] != context[:-1]) | (byte[1:] != byte[:-1])
        return byte, np.flatnonzero(new), np.cumsum(new) - 1

    def across(self, rows: np.ndarray, byte: np.ndarray, j: int) -> np.ndarray:
        """Keys of the contexts of rows that reach back to the word before."""
        h = self.prefix[self.nodes[self.shared.start[self.own[rows]] + j]]
        h = (h ^ h >> _U(29) ^ self.befores[self.b[rows]]) * M._A
        return keyed(h ^ h >> _U(31), byte)

    def asked(self) -> tuple[np.ndarray, np.ndarray]:
        """Keys in order of what other shards may have counted too, and counts of this one."""
        keys, counts = [self.key[self.open]], [self.count[self.open]]
        self.wide = []  # by level: rows that are the first of a (context, byte), and the place of its key
        rows, context = np.arange(len(self.t)), self.b
        for j in count():
            go = (self.depth[self.t[rows]] >= j) & (self.size[self.t[rows]] > j)
            rows, context = rows[go], context[go]
            if not len(rows):
                break
            byte, first, context = self.level(rows, context, j)
            keys.append(self.across(rows[first], byte[first], j))
            counts.append(np.add.reduceat(self.n[rows], first))
            self.wide.append(rows[first])
        key, at = grouped(np.concatenate(keys))
        self.told, *spots = np.split(at, np.cumsum([len(x) for x in keys])[:-1])
        self.wide = list(zip(self.wide, spots, strict=True))
        return key, np.bincount(at, np.concatenate(counts), len(key)).astype(np.int64)

    def answered(self, path: np.ndarray) -> None:
        """``path``: of each key that ``asked`` named."""
        self.asked_path, shut = path, ~self.open
        closed = self.key[shut]
        own = M.paths(closed & ~_LOW, (closed & _LOW).astype(np.int64), self.count[shut])
        self.found = np.empty((len(self.key), 9), np.promote_types(own.dtype, path.dtype))
        self.found[shut], self.found[self.open] = own, path[self.told]

    def known(self) -> np.ndarray:
        """How often training texts have the token of each (class, token)."""
        last = self.nodes[self.shared.start + self.shared.size - 1]
        return self.found[self.at[-2][last], 8]

    def followed(self, a: int, b: int):
        """Rows a to b, byte by byte: (rows, their class's node, node of each row, node among the tokens', path of each, its count) of those whose context tells; then (rows, byte, how often seen) of those whose context has seen no other."""
        rows, context = np.arange(a, b), self.b[a:b]
        for j in count():
            go = self.size[self.t[rows]] > j
            rows, context = rows[go], context[go]
            if not len(rows):
                return
            byte, first, at = self.level(rows, context, j)
            if j >= M.WIDE:  # where a context is left with one token, it goes on to its end at once
                token, top = self.t[rows], np.flatnonzero(np.diff(context, prepend=-1))
                single = (np.minimum.reduceat(token, top) == np.maximum.reduceat(token, top)) & (self.depth[token[top]] < j)
                done = np.repeat(single, np.diff(top, append=len(rows)))
                if done.any():
                    seen = np.repeat(np.add.reduceat(self.n[rows], top), np.diff(top, append=len(rows)))[done]
                    left = self.size[token[done]] - j
                    each = np.arange(int(left.sum())) - np.repeat(np.cumsum(left) - left, left)
                    nodes = self.nodes[np.repeat(self.shared.start[self.own[rows[done]]] + j, left) + each]
                    yield np.repeat(rows[done], left), np.arange(len(nodes)), nodes, np.repeat(seen, left)[:, None].repeat(9, axis=1), np.repeat(self.n[rows[done]], left)
                rows, context = rows[~done], context[~done]
                if not len(rows):
                    return
                byte, first, at = self.level(rows, context, j)
            own, last = np.add.reduceat(self.n[rows], first), np.append(first[1:], len(at)) - 1
            path = M.paths(context[first], byte[first], own)
            wide = np.flatnonzero(self.depth[self.t[rows[first]]] >= j)
            if len(wide):
                path = path.astype(np.promote_types(path.dtype, self.asked_path.dtype), copy=False)
                leads, spot = self.wide[j]
                path[wide] = self.asked_path[spot[np.searchsorted(leads, rows[first[wide]])]]
            # seen once, by the one token that is left: a held-out token may still leave the way of the other
            alone = ((path[:, 0] == 0) | (path[:, 0] == 1) & (own == 1) & (self.t[rows[first]] == self.t[rows[last]]))[at]
            if alone.any():
                yield rows[alone], j, path[at[alone], 0]
            rows, context = rows[~alone], at[~alone]
            if len(rows):
                spot, each = places(context * M.CLASSES + self.k[rows], len(path) * M.CLASSES)
                one = np.empty(len(spot), np.int64)
                one[each] = np.arange(len(rows))
                yield rows, each, self.nodes[self.shared.start[self.own[rows[one]]] + j], path[spot // M.CLASSES], np.bincount(each, self.n[rows], len(one))

    def batches(self):
        """Stretches of about ROWS rows, each with all rows of a word before."""
        ends = np.flatnonzero(np.diff(self.b, append=-1)) + 1
        a = 0
        while a < len(self.b):
            b = int(ends[min(np.searchsorted(ends, a + ROWS), len(ends) - 1)])
            yield a, b
            a = b

    def logits(self, leave_out: bool) -> tuple[np.ndarray, np.ndarray]:
        """Of each key of a context within the token, bit by bit: the logit of the bit at hand, and whether the context was seen."""
        x, has = np.empty((len(self.key), 8), np.float32), np.empty((len(self.key), 8), np.int8)
        for a in range(0, len(x), STEP):
            x[a : a + STEP], n, _ = M.leaning(self.found[a : a + STEP], leave_out)
            has[a : a + STEP] = n > 0
        return x, has

    def gates(self, has: np.ndarray, leave_out: bool) -> np.ndarray:
        """Gates of all nodes, for a context across that has seen nothing."""
        out = np.empty((len(self.data), 8), np.int16)
        for a in range(0, len(out), STEP):
            part = slice(a, a + STEP)
            seen = np.zeros((len(out[part]), 8), np.int16)
            for at in self.at:
                seen += has.take(at[part], axis=0)
            run = np.ascontiguousarray(self.found.take(self.at[-1, part], axis=0).T)
            hit, miss = np.maximum(run[1:] - leave_out, 0), run[:-1] - run[1:]
            out[part] = (seen * M.OFTEN + M.often_of(hit + miss).T) * 2 + ((hit > 0) & (miss > 0)).T
        return out

    def bits(self) -> np.ndarray:
        return (self.data[:, None] >> (7 - M._NODE) & 1).astype(np.int8)


def shard_of(batch, i: int, bounds: list) -> Shard:
    k = batch.column("shard")[i].as_py()
    return Shard(*(batch.column(c)[i].as_py() for c in ("tokens", "befores", "rows")), bounds[max(k - 1, 0) : k + 1])


def asks(shards: DataFrame, bounds: list, parts: int) -> DataFrame:
    """(part, shard, blob of keys and counts), by key."""

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                key, n = shard_of(batch, i, bounds).asked()
                n, ends = slim(n), _ends(key, parts)
                own = [p for p in range(parts) if ends[p] < ends[p + 1]]
                told = [[blob(key=planes(key[ends[p] : ends[p + 1]])), blob(n=n[ends[p] : ends[p + 1]])] for p in own]
                yield pa.record_batch([pa.array(own, pa.int32()), pa.array([batch.column("shard")[i].as_py()] * len(own), pa.int32()), *(pa.array([x[c] for x in told], pa.binary()) for c in range(2))], names=["part", "shard", "asked", "counts"])

    return shards.select("shard", "tokens", "befores", "rows").mapInArrow(run, "part int, shard int, asked binary, counts binary")


def _ends(key: np.ndarray, parts: int) -> list[int]:
    """Where each part of keys in order begins, and the end: parts are ranges, and no context lies in two of them."""
    cuts = np.array([(p << 64) // parts >> 8 << 8 for p in range(parts)], np.uint64)
    return [*np.searchsorted(key, cuts).tolist(), len(key)]


def answers(asked: DataFrame) -> DataFrame:
    """(shard, part, packed paths of what it asked, in order; null where no other shard has the context)."""

    def run(table: pa.Table) -> pa.Table:
        C.trim()
        parts = [(unplaned(opened(x)[0]), opened(n)[0]) for x, n in zip(table.column("asked").to_pylist(), table.column("counts").to_pylist(), strict=True)]
        key, at = grouped(np.concatenate([p[0] for p in parts]), "stable")
        n = np.bincount(at, np.concatenate([p[1] for p in parts]), len(key)).astype(np.int64)
        h = key & ~_LOW
        path, context = M.paths(h, (key & _LOW).astype(np.int64), n), np.cumsum(np.diff(h, prepend=h[:1]) != 0)
        lists = np.split(at, np.cumsum([len(p[0]) for p in parts])[:-1])
        askers = np.zeros(int(context[-1]) + 1, np.int64)
        for x in lists:  # each is in order
            own = context[x]
            askers[own[np.diff(own, prepend=-1) > 0]] += 1
        told = []
        for x in lists:
            shared = askers[context[x]] > 1
            runs = M.packed(path[x[shared]].ravel(), np.full(int(shared.sum()), 9))
            told.append(blob(path=runs.take(pa.array(np.cumsum(shared) - 1, mask=~shared))))
        return pa.table([table.column("shard"), table.column("part"), pa.array(told, pa.binary())], names=["shard", "part", "path"])

    return asked.groupBy("part").applyInArrow(run, "shard int, part int, path binary")


def informed(shards: DataFrame, told: DataFrame) -> DataFrame:
    """The shards with ``found``: the answers by part."""

    def run(own: pa.Table, rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("part")
        return own.append_column("parts", pa.array([rows.column("part").to_pylist()], pa.list_(pa.int32()))).append_column("found", pa.array([rows.column("path").to_pylist()], pa.list_(pa.binary())))

    return shards.groupBy("shard").cogroup(told.groupBy("shard")).applyInArrow(run, f"{_MERGED}, parts array<int>, found array<binary>")


def told_shard(batch, i: int, bounds: list, parts: int) -> Shard:
    own = shard_of(batch, i, bounds)
    key, n = own.asked()
    path, ends = M.paths(key & ~_LOW, (key & _LOW).astype(np.int64), n), _ends(key, parts)
    for p, data in zip(batch.column("parts")[i].as_py(), batch.column("found")[i].as_py(), strict=True):
        runs = pa.ipc.open_stream(data).read_all().column(0).combine_chunks()
        told = M.unpacked(runs.drop_null(), 9).reshape(-1, 9)
        if told.max(initial=0) >= 1 << 31:
            path = path.astype(np.int64)
        path[ends[p] + np.flatnonzero(runs.is_valid().to_numpy(zero_copy_only=False))] = told
    own.answered(path)
    return own


def shards_of(batches, bounds: list, parts: int):
    """(Shard, row of the batch) with the counts of all shards; none is kept here while the next is made."""
    C.trim()
    for batch in batches:
        for i in range(batch.num_rows):
            yield told_shard(batch, i, bounds, parts), batch.slice(i, 1)


def learn(shard: Shard) -> list[np.ndarray]:
    """One online pass over the nodes of a shard in random order, each token's own occurrence left out: weights times mass, mass by gate, hits of the map."""
    weights, average, scale = M.start_weights(), np.zeros((M.GATES, len(M.ORDERS))), np.zeros((M.GATES, len(M.ORDERS)))
    mass, hits = np.zeros(M.GATES), np.zeros((2, M.GATES, M.CURVE))
    nodes, paths, counts, spots, seen = [], [], [], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for a, b in shard.batches():
        for rows, *told in shard.followed(a, b):
            if len(told) == 2:
                spots.append(shard.shared.start[shard.own[rows]] + told[0])
                seen.append(shard.n[rows])
            else:
                has = told[3] > 0
                nodes.append(told[1][has].astype(np.int32))
                paths.append(told[2][has])
                counts.append(told[3][has])
    # where the context across has seen nothing else, its bits are those of the node, down to the token's end
    alone = np.bincount(np.concatenate(spots), np.concatenate(seen), len(shard.nodes))
    ends = np.cumsum(alone)
    begin = shard.shared.start
    alone = np.bincount(shard.nodes, ends - np.repeat(ends[begin] - alone[begin], shard.shared.size), len(shard.data))
    some = np.flatnonzero(alone > 0.5)
    nodes, counts = np.concatenate((*nodes, some.astype(np.int32))), np.concatenate((*counts, alone[some]))
    paths = np.concatenate(paths) if paths else np.zeros((0, 9), np.int64)
    used, nodes = places(nodes, len(shard.data))
    every, has = shard.logits(True)
    bits, gates = shard.bits()[used], shard.gates(has, True)[used]
    every = [every.take(row[used], axis=0) for row in shard.at]
    del has, spots, ends
    lot = np.random.default_rng(0).permutation(len(nodes))
    for a in range(0, len(lot), STEP):
        own = lot[a : a + STEP]
        at = nodes[own]
        path = np.zeros((len(own), 9), paths.dtype)
        path[own < len(paths)] = paths[own[own < len(paths)]]
        x, n, _ = M.leaning(path, True)
        # the sign of a logit of 1 and of its error is the bit's, so both go without
        x = [x.ravel(), *(y.take(at, axis=0).ravel() for y in every)]
        gate = (gates.take(at, axis=0) + (n > 0) * np.int16(2 * M.OFTEN)).ravel().astype(np.intp)
        z = np.zeros(len(gate), np.float32)
        for w, y in zip(np.ascontiguousarray(weights.T, np.float32), x, strict=True):
            z += w.take(gate, mode="clip") * y
        np.clip(z, -12, 12, out=z)
        c, bit = np.repeat(counts[own], 8).astype(np.float32), bits.take(at, axis=0).ravel()
        error = c / (1 + np.exp(z))
        z *= 2 * bit - 1
        cell = (gate * M.CURVE + np.rint((np.clip(z, -8, 8) + 8) * np.float32((M.CURVE - 1) / 16)).astype(np.intp)) * 2 + bit
        hit = np.bincount(cell, c, 2 * M.GATES * M.CURVE).reshape(M.GATES, M.CURVE, 2)
        hits[0] += hit.sum(axis=2)
        hits[1] += hit[:, :, 1]
        seen = np.maximum(hit.sum(axis=(1, 2)), 1e-9)
        for row, y in enumerate(x):
            step = np.bincount(gate, error * y, M.GATES) / seen
            scale[:, row] += step * step
            weights[:, row] += M.RATE * step / (np.sqrt(scale[:, row]) + 1e-3)
        mass += seen
        average += weights * seen[:, None]
    return [average, mass, hits]


def learned(shards: DataFrame, bounds: list, parts: int):
    """Weights and map by an online pass over each shard, averaged by mass; training tokens, known tokens, ends by class."""

    def run(batches):
        for shard, _ in shards_of(batches, bounds, parts):
            known, end = shard.known()[shard.own], shard.bytes[shard.start[shard.t]] == M.END[0]
            # a token counts as one over all its rows, wherever they are
            totals = [[shard.n.sum(), (shard.n / np.maximum(known, 1)).sum()], np.bincount(shard.k[end], shard.n[end], M.CLASSES)]
            yield pa.record_batch([pa.array([np.concatenate([np.ravel(x) for x in (*learn(shard), *totals)]).tobytes()], pa.binary())], names=["s"])
            del shard

    def add(batches):
        found = [np.frombuffer(x) for batch in batches for x in batch.column("s").to_pylist()]
        if found:
            yield pa.record_batch([pa.array([sum(found).tobytes()], pa.binary())], names=["s"])

    rows = shards.mapInArrow(run, "s binary").repartition(M.PARTS).mapInArrow(add, "s binary").collect()  # sums of fixed size
    total = sum((np.frombuffer(x) for x in sorted(bytes(r["s"]) for r in rows)), np.zeros(M.GATES * (len(M.ORDERS) + 1 + 2 * M.CURVE) + 2 + M.CLASSES))
    average, mass, hits, totals = np.split(total, np.cumsum([M.GATES * len(M.ORDERS), M.GATES, 2 * M.GATES * M.CURVE]))
    weights, curve = M.merge([(average.reshape(M.GATES, -1), mass, hits.reshape(2, M.GATES, M.CURVE))])
    return weights, curve, int(round(totals[0])), int(round(totals[1])), np.round(totals[2:])


def cost(shard: Shard, model) -> np.ndarray:
    """log10 of the probability of each row of a shard, in the order of (token, before, class)."""
    logits, has = shard.logits(False)
    bits, gates = shard.bits(), shard.gates(has, False)
    met = 2 * M.OFTEN
    weights = np.ascontiguousarray(model.weights.T, np.float32)
    sums = np.zeros((2, *bits.shape), np.float32)  # of the orders within the token, where the context across has seen nothing, and where it has
    for a in range(0, len(bits), STEP):
        part = slice(a, a + STEP)
        gate = gates[part].astype(np.intp)
        for w, row in zip(weights[1:], shard.at, strict=True):
            x = logits.take(row[part], axis=0)
            for state in range(2):
                sums[state, part] += w.take(gate + state * met, mode="clip") * x
    del logits, has
    # of the bit at hand: the map as it is for a 1, and the other way round for a 0
    curve = np.stack((1 - model.curve[:, ::-1], model.curve))
    slope = np.diff(curve, axis=2, append=0).ravel()
    curve = curve.ravel()
    gates, first = gates + bits * np.int16(M.GATES), np.tile(weights[0], 2)

    def priced(gate, total, own):
        z = np.clip(total + first.take(gate, mode="clip") * own, -12, 12)
        x = (np.clip(z, -8, 8) + 8) * np.float32((M.CURVE - 1) / 16)
        lo = np.minimum(x.astype(np.intp), M.CURVE - 2)
        at = gate * M.CURVE + lo
        p = np.clip(0.5 / (1.0 + np.exp(-z).astype(np.float64)) + 0.5 * (curve.take(at, mode="clip") + slope.take(at, mode="clip") * (x - lo)), 1e-6, 1 - 1e-6)
        value = p[:, 0].copy()
        for d in range(1, 8):
            value *= p[:, d]
        return np.log10(value)

    bare = np.empty((2, len(bits)))
    for a in range(0, len(bits), STEP):
        part = slice(a, a + STEP)
        for state in range(2):
            bare[state, part] = priced(gates[part].astype(np.intp) + state * met, sums[state, part], M.leaning(np.full((1, 9), state), False)[0])
    # costs of a token's bytes up to each, for contexts across that have seen nothing or this once
    ends = [np.concatenate((np.zeros(1), np.cumsum(x[shard.nodes]))) for x in bare]
    out = np.zeros(len(shard.t))
    for a, b in shard.batches():
        for rows, *told in shard.followed(a, b):
            start = shard.shared.start[shard.own[rows]]
            if len(told) == 2:
                last = start + shard.shared.size[shard.own[rows]]
                out[rows] += np.where(told[1] == 1, ends[1][last] - ends[1][start + told[0]], ends[0][last] - ends[0][start + told[0]])
                continue
            each, nodes, path, _ = told
            value = np.empty(len(nodes))
            for c in range(0, len(nodes), STEP):
                own = nodes[c : c + STEP]
                x, n, _ = M.leaning(path[c : c + STEP], False)
                has = n > 0
                value[c : c + STEP] = priced(gates.take(own, axis=0).astype(np.intp) + has * met, np.where(has, sums[1].take(own, axis=0), sums[0].take(own, axis=0)), x)
            out[a:b] += np.bincount(rows - a, value[each], b - a)
    back = np.empty(len(out))
    back[shard.order] = out
    return back


def costs(shards: DataFrame, bounds: list, parts: int, weights: np.ndarray, curve: np.ndarray) -> DataFrame:
    """(piece, shard, costs and training counts of the rows that the piece has in the shard, in order)."""

    def run(batches):
        model = M.Model(None, weights, curve)
        for shard, row in shards_of(batches, bounds, parts):
            value = cost(shard, model).astype(np.float32)
            known = np.empty(len(value), np.int64)
            known[shard.order] = shard.known()[shard.own]
            del shard
            for piece, data in zip(row.column("pieces")[0].as_py(), row.column("members")[0].as_py(), strict=True):
                own = np.cumsum(opened(data)[0], dtype=np.int64)
                yield pa.record_batch([pa.array([piece]), row.column("shard"), pa.array([blob(cost=value[own], known=slim(known[own]))], pa.binary())], names=["piece", "shard", "cost"])

    return shards.mapInArrow(run, "piece long, shard int, cost binary")


def scored(found: DataFrame, told: DataFrame, kind_cost: list[float], n: int, known: int, kind: str) -> DataFrame:
    """The texts of all pieces with their sums; told: costs of the rows."""
    names = kind.replace(",", "").split()[::2]

    def run(texts: pa.Table, rows: pa.Table) -> pa.Table:
        docs = pa.ipc.open_stream(texts.column("first")[0].as_py()).read_all()
        row = opened(texts.column("third")[0].as_py())[0]
        value, count_ = (np.concatenate(x) for x in zip(*map(opened, rows.sort_by("shard").column("cost").to_pylist()), strict=True))
        size, k, length = (docs.column(c).to_numpy() for c in ("n", "k", "s"))
        start = np.cumsum(size) - size
        base = np.add.reduceat(np.log10((count_ + 1.0) / (n + known + 1.0))[row], start)
        total = np.add.reduceat(value.astype(np.float64)[row], start) + np.array(kind_cost)[k]
        seen = np.add.reduceat((count_ > 0).astype(np.int64)[row], start)
        return pa.table([docs.column("i"), docs.column("held"), pa.array(size), pa.array(seen), pa.array(np.full(len(size), n)), pa.array(base), pa.array(total), pa.array(-total * 3.321928094887362 / length)], names=names)

    return found.where("shard < 0").groupBy("piece").cogroup(told.groupBy("piece")).applyInArrow(run, kind)
