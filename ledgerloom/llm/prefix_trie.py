"""The prefix trie of conversations from padded matrices of turn ids.

A conversation is one row: the digests of its turns (16 bytes each) one after the other. Equal conversations are summed up first,
so a conversation that a third of all rows repeat is one row with a weight. The distinct rows are dealt out in ranges of their bytes,
and each range is worked through in blocks of about ``CELLS`` cells. A block is a padded matrix of turn ids: numpy sorts its rows
(lexsort), marks where a column or any before it changes (OR-accumulated), which is where a node of that depth starts, and sums
every depth with reduceat. Nodes away from a block's first and last row are whole. Those on its first or last row may go on in
the next block: they are handed on as two rows with the sums so far at each depth, and go through the same function again, until one
block holds all that is left. So what is handed on shrinks by the number of rows in a block each time.

The list of conversations that end in a node is hashed as a stream, in order, from pieces of at most ``PIECE`` ids.

Defined cases: a null role or text is empty; a null turn comes first; ties of turn go by role, then the first 64 characters of the
text, then its digest; rows without conv_id belong to no conversation and are left out; a conversation without turns ends in the root;
repeated rows are turns of their own; an empty table has no nodes; other columns are ignored. A very long conversation is one row of 16
bytes a turn and a matrix of ``LEAST_ROWS`` rows of its length.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm import common as C

GROUP, HEADS = 20, 4
#: Cells of a block's matrix, and its rows at least.
CELLS, LEAST_ROWS = 1 << 20, 16
#: Conversation ids in a piece of a node's list; turns in a range.
PIECE, RANGE_TURNS = 256, 4 << 20
WORD = r"[^\x20\x09-\x0D]+"
NOTHING = hashlib.sha256(b"").hexdigest()
TOP = np.iinfo(np.int64).max

#: What is known of each depth 0..len of a row, summed over the conversations that pass: all, the least, and of finished nodes below: children, leaves, saved.
SUMS = ("convs", "least", "kids", "leaves", "saved")
ROW = pa.schema([("seq", pa.binary()), ("words", pa.list_(pa.int64())), ("ends", pa.list_(pa.string())), *[(c, pa.list_(pa.int64())) for c in SUMS]])
NODE = pa.schema([("conv_id", pa.int64()), ("depth", pa.int64()), ("parent_conv_id", pa.int64()), ("n_convs", pa.int64()), ("n_children", pa.int64()), ("n_leaves", pa.int64()), ("saved_tokens", pa.int64()), ("ends_sha256", pa.string()), ("_parent", pa.binary()), ("_key", pa.binary())])
OUT = pa.schema([("node", pa.struct(list(NODE))), ("row", pa.struct(list(ROW)))])


def ddl(schema: pa.Schema) -> str:
    kinds = {pa.int64(): "long", pa.string(): "string", pa.binary(): "binary", pa.list_(pa.int64()): "array<long>", pa.list_(pa.string()): "array<string>"}
    return ", ".join(f"{f.name} {kinds[f.type]}" for f in schema)


OUT_DDL = f"node struct<{ddl(NODE).replace(' ', ': ').replace(',: ', ', ')}>, row struct<{ddl(ROW).replace(' ', ': ').replace(',: ', ', ')}>"


def turns(conversations: DataFrame) -> DataFrame:
    """conv_id and its turns in order: (turn, role, start, digest, n). Of a text only its digest, its words and its first characters are shuffled."""
    text, role = F.coalesce("text", F.lit("")), F.coalesce("role", F.lit(""))
    digest = F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text))
    turn = F.struct(F.col("turn"), role.alias("role"), F.substring(text, 1, 64).alias("start"), digest.alias("digest"), F.regexp_count(text, F.lit(WORD)).cast("long").alias("n"))
    return conversations.where("conv_id is not null").groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))


def rebuilt(conversations: DataFrame) -> DataFrame:
    """conv_id, seq (hexadecimal digests), words: the first h turns of the group's first conversation, then its own from the h-th on."""
    own = C.stage(turns(conversations).select("conv_id", F.transform("turns", lambda t: F.struct(t["digest"].alias("digest"), t["n"].alias("n"))).alias("turns")), "trie-turns", "zstd")
    base = F.col("conv_id") - F.col("conv_id") % GROUP
    heads = own.where(F.col("conv_id") % GROUP == 0).select(F.col("conv_id").alias("base"), F.slice("turns", 1, HEADS - 1).alias("head"))
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEADS).cast("int")
    joined = own.withColumns({"base": base, "h": h}).join(heads, "base", "left")
    first = F.coalesce(F.slice("head", F.lit(1), F.col("h")), F.array().cast("array<struct<digest: string, n: long>>"))
    whole = F.concat(first, F.slice("turns", F.col("h") + 1, F.size("turns")))
    return joined.select("conv_id", whole.alias("turns")).select("conv_id", F.array_join("turns.digest", "").alias("seq"), F.col("turns.n").alias("words"))


def _hashed(batches):
    """seq, n, least, ends: the pieces of each row's conversations, in order, hashed as one text."""
    schema = pa.schema([("seq", pa.string()), ("words", pa.list_(pa.int64())), ("n", pa.int64()), ("least", pa.int64()), ("ends", pa.string())])
    now, words, n, least, state = None, None, 0, 0, None
    rows = []

    def close():
        rows.append((now, words, n, least, state.hexdigest()))

    for batch in batches:
        for seq, w, count, low, ids in zip(*(batch.column(c).to_pylist() for c in ("seq", "words", "n", "least", "ids")), strict=True):
            if seq != now:
                if state is not None:
                    close()
                now, words, n, least, state = seq, w, 0, low, hashlib.sha256()
            state.update((("," if n else "") + ids).encode())
            n += count
        if len(rows) >= 4096:
            yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), schema.types, strict=True)], schema=schema)
            rows.clear()
    if state is not None:
        close()
    if rows:
        yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), schema.types, strict=True)], schema=schema)


def distinct_rows(conversations: DataFrame) -> DataFrame:
    """seq, words, n, least, ends of every distinct conversation."""
    piece = F.floor(F.col("conv_id") / PIECE)
    # ids of one piece are summed up before they meet their row's others, so a hot row brings few and short rows
    pieces = rebuilt(conversations).groupBy("seq", piece.alias("piece")).agg(F.any_value("words").alias("words"), F.sort_array(F.collect_list("conv_id")).alias("ids"))
    pieces = pieces.select("seq", "piece", "words", F.size("ids").cast("long").alias("n"), F.col("ids")[0].alias("least"), F.array_join("ids", ",").alias("ids"))
    ordered = pieces.repartition(F.col("seq")).sortWithinPartitions("seq", "piece")
    return ordered.mapInArrow(_hashed, "seq string, words array<long>, n long, least long, ends string")


def _start(rows: DataFrame) -> DataFrame:
    """Rows of ROW from distinct conversations: nothing below is finished yet, and the only end is the row's own."""
    each = lambda x: F.array_repeat(x, F.size("words") + 1)
    ends = F.concat(F.array_repeat(F.lit(None).cast("string"), F.size("words")), F.array("ends"))
    zero = each(F.lit(0).cast("long"))
    return rows.select(F.unhex("seq").alias("seq"), "words", ends.alias("ends"), each(F.col("n")).alias("convs"), each(F.col("least")).alias("least"), zero.alias("kids"), zero.alias("leaves"), zero.alias("saved"))


def dense(seqs: list[bytes]) -> np.ndarray:
    """A padded matrix of turn ids, 1 for the least digest of the block and 0 where a row has ended."""
    n = np.array([len(s) // 16 for s in seqs], np.int64)
    flat = np.frombuffer(b"".join(seqs), ">u8").reshape(-1, 2).astype(np.uint64)
    ids = np.zeros(len(flat), np.int64)
    if len(flat):
        order = np.lexsort((flat[:, 1], flat[:, 0]))
        step = np.concatenate(([True], (flat[order][1:] != flat[order][:-1]).any(axis=1)))
        ids[order] = np.cumsum(step)
    out = np.zeros((len(seqs), int(n.max(initial=0))), np.int32)
    out[np.arange(out.shape[1]) < n[:, None]] = ids
    return out


def _padded(lists: list[list], width: int, fill: int) -> np.ndarray:
    out = np.full((len(lists), width), fill, np.int64)
    for k, x in enumerate(lists):
        out[k, : len(x)] = x
    return out


def key_of(seq: bytes) -> bytes:
    return hashlib.blake2b(seq, digest_size=16).digest()


def block(rows: list[dict], last: bool, named: bool) -> tuple[list[tuple], list[dict]]:
    """Finished nodes of a block, and the rows that hand on what its first and last row have begun.

    ``last``: this is all there is. ``named``: its nodes were handed on before, so others may ask for them by their key.
    """
    ids = dense([r["seq"] for r in rows])
    order = np.lexsort(ids.T[::-1]) if ids.shape[1] else np.arange(len(rows))
    ids, rows = ids[order], [rows[k] for k in order]
    size = np.array([len(r["words"]) for r in rows], np.int64)
    wide = ids.shape[1] + 1
    changes = np.ones((len(rows), wide), bool)  # column d: a node of depth d starts here
    changes[1:, 0] = False
    if wide > 1:
        np.logical_or.accumulate(ids[1:] != ids[:-1], axis=1, out=changes[1:, 1:])
    held = {c: _padded([r[c] for r in rows], wide, TOP if c == "least" else 0) for c in SUMS}
    words = _padded([[0, *r["words"]] for r in rows], wide, 0)
    end_of = _padded([[-1 if e is None else k for e in r["ends"]] for k, r in enumerate(rows)], wide, -1)
    levels, above = [], None
    for d in range(wide):
        live = np.flatnonzero(size >= d)  # sorted rows: those of one node stay neighbours
        at = live[changes[live, d]]
        cut = np.searchsorted(live, at)
        node = {c: (np.minimum if c == "least" else np.add).reduceat(held[c][live, d], cut) for c in SUMS}
        ends = [None if k < 0 else rows[k]["ends"][d] for k in np.maximum.reduceat(end_of[live, d], cut).tolist()]
        spot = np.searchsorted(at, live, side="right") - 1
        open_ = np.zeros(len(at), bool)
        if not last:
            for edge in (0, len(rows) - 1):
                if size[edge] >= d:
                    open_[spot[np.searchsorted(live, edge)]] = True
        parent = None if above is None else np.searchsorted(above, at, side="right") - 1
        levels.append({**node, "ends": ends, "at": at, "open": open_, "parent": parent, "words": words[at, d]})
        above = at
    for d in range(wide - 1, -1, -1):  # from the leaves up: finished nodes add to their parents
        x = levels[d]
        done = ~x["open"]
        x["total_leaves"] = np.where(x["kids"] == 0, 1, x["leaves"])
        x["total_saved"] = x["saved"] + (x["convs"] - 1) * x["words"]
        if d:
            up, p = levels[d - 1], x["parent"][done]
            np.add.at(up["kids"], p, 1)
            np.add.at(up["leaves"], p, x["total_leaves"][done])
            np.add.at(up["saved"], p, x["total_saved"][done])
    return _finished(levels, rows, named), [] if last else _handed(levels, rows, size)


def _finished(levels: list[dict], rows: list[dict], named: bool) -> list[tuple]:
    out = []
    for d, x in enumerate(levels):
        for k in np.flatnonzero(~x["open"]).tolist():
            parent = key = None
            up = levels[d - 1] if d else None
            if d and up["open"][x["parent"][k]]:
                key = key_of(rows[x["at"][k]]["seq"][: 16 * (d - 1)])
            elif d:
                parent = int(up["least"][x["parent"][k]])
            out.append((int(x["least"][k]), d, parent, int(x["convs"][k]), int(x["kids"][k]), int(x["total_leaves"][k]), int(x["total_saved"][k]), x["ends"][k] or NOTHING, key, key_of(rows[x["at"][k]]["seq"][: 16 * d]) if named else None))
    return out


def _handed(levels: list[dict], rows: list[dict], size: np.ndarray) -> list[dict]:
    """The first and the last row with the sums of their nodes; a node on both is told once."""
    out, told = [], set()
    for edge in dict.fromkeys((0, len(rows) - 1)):
        row = {"seq": rows[edge]["seq"], "words": rows[edge]["words"], "ends": [], **{c: [] for c in SUMS}}
        for d in range(int(size[edge]) + 1):
            x = levels[d]
            k = int(np.searchsorted(x["at"], edge, side="right") - 1)
            new = (d, k) not in told
            told.add((d, k))
            row["ends"].append(x["ends"][k] if new else None)
            for c in SUMS:
                row[c].append(int(x[c][k]) if new else TOP if c == "least" else 0)
        out.append(row)
    return out


def blocks(rows, cells: int):
    """Lists of neighbouring rows whose matrix has about ``cells`` cells, or of LEAST_ROWS rows."""
    held, wide = [], 0
    for r in rows:
        wider = max(wide, len(r["words"]) + 1)
        if len(held) >= LEAST_ROWS and wider * (len(held) + 1) > cells:
            yield held
            held, wider = [], len(r["words"]) + 1
        held.append(r)
        wide = wider
    if held:
        yield held


def _batch(nodes: list[tuple], rows: list[dict]):
    n, m = len(nodes), len(rows)
    own = pa.StructArray.from_arrays([pa.array([x[k] for x in nodes] + [None] * m, f.type) for k, f in enumerate(NODE)], fields=list(NODE), mask=pa.array([False] * n + [True] * m))
    row = pa.StructArray.from_arrays([pa.array([None] * n + [r[f.name] for r in rows], f.type) for f in ROW], fields=list(ROW), mask=pa.array([True] * n + [False] * m))
    return pa.record_batch([own, row], schema=OUT)


def _worked(rows: DataFrame, cells: int, last: bool, named: bool) -> DataFrame:
    """Rows in the order of their bytes, a block at a time: (node, row), one of them null."""

    def run(batches):
        for held in blocks((r for batch in batches for r in batch.to_pylist()), 1 << 62 if last else cells):
            nodes, handed = block(held, last, named)
            for k in range(0, len(nodes), 8192):
                yield _batch(nodes[k : k + 8192], [])
            for r in handed:
                yield _batch([], [r])

    return C.stage(rows.select(*ROW.names).mapInArrow(run, OUT_DDL), "trie-level", "zstd")


def trie(conversations: DataFrame, cells: int = CELLS, range_turns: int = RANGE_TURNS) -> DataFrame:
    """A row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    rows = _start(C.stage(distinct_rows(conversations.select("conv_id", "turn", "role", "text")), "trie-rows", "zstd"))
    nodes, named, single = None, False, False
    while True:
        n, widest, total = rows.agg(F.count(F.lit(1)), F.max(F.size("words") + 1), F.sum(F.size("words") + 1)).first()
        last = not n or n * widest <= cells or n <= LEAST_ROWS
        if last or single:
            ordered = rows.repartition(1).sortWithinPartitions("seq")  # a few rows that blocks have handed on, or a small table
        else:
            ordered = rows.repartitionByRange(max(1, min(total // range_turns, n // (4 * LEAST_ROWS))), "seq").sortWithinPartitions("seq")
        out = _worked(ordered, cells, last, named)
        own = out.where("node is not null").select("node.*")
        nodes = own if nodes is None else nodes.unionAll(own)
        if last:
            break
        rows = out.where("row is not null").select("row.*")
        single, named = named and 2 * rows.count() > n, True
    sure = nodes.where("_parent is null").drop("_parent", "_key")
    keys = nodes.where("_key is not null").select(F.col("_key").alias("_k"), F.col("conv_id").alias("_p"))
    asked = nodes.where("_parent is not null").join(keys, F.col("_parent") == F.col("_k")).withColumn("parent_conv_id", F.col("_p")).drop("_parent", "_key", "_k", "_p")
    return sure.unionByName(asked)
