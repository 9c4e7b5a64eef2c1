"""Collocations of two to five words, counted in tiles of a table that ranks address directly.

Everything is per language. Words that occur often enough get their rank by frequency as id, and texts become rows of ids with -1
where a piece ends or a word is too rare. A pair of neighbouring ids is a cell of a square table. Its corner of the ``DENSE`` most
frequent ids on either side is cut into tiles of ``TILE`` by ``TILE`` cells that are counted with bincount; pairs outside are
sorted and counted as coordinates. Each task sends one row a cell, and Spark sums them up. Frequent pairs are ranked again and
become the ids of the next round, in which a pair of overlapping neighbours is a phrase one word longer: no phrase is
frequent unless both phrases within it are.

The ids of a round go to all tasks if there are at most ``KEYS`` of them, of ``KEY_BYTES`` together; else each chunk of text asks for the ids of its own
distinct words or pairs by a join, with the same result. Counts are 64 bit, scores are computed with 38 digits.

Defined cases: a null text is empty, a null lang is ``und``; repeated rows count as often as they occur; ties go by score, count and phrase in the
order of UTF-8 bytes; an empty table, or one without frequent phrases, gives an empty result; other columns are ignored. A very long text is worked through in
parts between marks; one piece without any mark is held whole by one task (about 100 bytes a word).
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerloom.llm import common as C

LONGEST, LEAST, TOP = 5, 100, 2000
TILE, DENSE = 256, 2048
#: Pairs that a task holds before it counts them; distinct words that it holds before it hands their counts on.
BUFFER, WORDS = 8 << 20, 1 << 19
#: Ids of a round that are sent to all tasks, and bytes of their words.
KEYS, KEY_BYTES = 1 << 20, 16 << 20
MARKS = b".,;:!?\n\x0b\x0c\r"
END = b"."
TABLE = bytes.maketrans(MARKS + b"\t", END * len(MARKS) + b" ")


def parts(text: bytes) -> list[bytes]:
    """A text, or if it is very long its pieces put together to parts of about SLICE_BYTES."""
    if len(text) <= C.SLICE_BYTES:
        return [text]
    out, size = [[]], 0
    for piece in text.translate(TABLE).split(END):
        if size > C.SLICE_BYTES:
            out.append([])
            size = 0
        out[-1].append(piece)
        size += len(piece) + 1
    return [END.join(x) for x in out]


def tokens(texts: list[bytes]) -> list[bytes]:
    """Words in lower case, and END between pieces and texts."""
    return b" . ".join(texts).lower().translate(TABLE).replace(END, b" . ").split()


def _by_lang(batches):
    """(lang, tokens) of slices of text; what is held at once is bounded."""
    for batch in batches:
        for part in C.slices([batch]):
            own: dict[str, list[bytes]] = {}
            for lang, text in zip(part.column("lang").to_pylist(), C.raw(part.column("text")), strict=True):
                if len(text) <= C.SLICE_BYTES:
                    own.setdefault(lang, []).append(text)
                else:
                    for x in parts(text):
                        yield lang, tokens([x])
            for lang, texts in own.items():
                yield lang, tokens(texts)


def word_counts(docs: DataFrame) -> DataFrame:
    """(lang, key, f) of all words."""
    schema = pa.schema([("lang", pa.string()), ("key", pa.string()), ("f", pa.int64())])

    def told(lang, held):
        held.pop(END, None)
        yield from C.batches_of(schema, {"lang": pa.repeat(lang, len(held)), "key": pa.array(held.keys(), pa.binary()).cast(pa.string()), "f": pa.array(held.values(), pa.int64())})

    def run(batches):
        held: dict[str, Counter] = {}
        for lang, found in _by_lang(batches):
            held.setdefault(lang, Counter()).update(found)
            if sum(map(len, held.values())) > WORDS:
                for x in held.items():
                    yield from told(*x)
                held.clear()
        for x in held.items():
            yield from told(*x)

    return docs.mapInArrow(run, "lang string, key string, f long").groupBy("lang", "key").agg(F.sum("f").alias("f"))


def ranked(table: DataFrame, name: str) -> DataFrame:
    """(lang, id, key, f), staged: ids 0, 1, ... of a language by falling frequency. The rank is a row's place in its range plus the rows of its language before."""
    order = [F.col("lang"), F.col("f").desc(), F.col("key")]
    parts_ = max(1, table.sparkSession.sparkContext.defaultParallelism)
    rows = C.stage(table.repartitionByRange(parts_, *order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id()), name)
    span = rows.groupBy("lang", F.shiftright("at", 33).alias("part")).agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n"))
    before = F.coalesce(F.sum("n").over(W.partitionBy("lang").orderBy("part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    base = span.select("lang", "part", (before - F.col("first")).alias("shift"))  # a row for each range and language
    out = rows.withColumn("part", F.shiftright("at", 33)).join(base, ["lang", "part"]).select("lang", (F.col("at") + F.col("shift")).alias("id"), "key", "f")
    done = C.stage(out, name)
    C.unstage(rows)
    return done


def packed(ids: np.ndarray) -> bytes:
    """32 bit ids, without those that have no neighbour; -1 between runs."""
    v = ids >= 0
    near = v.copy()
    near[:1] = False
    near[1:] &= v[:-1]
    near[:-1] |= v[1:] & v[:-1]
    stop = ~near
    stop[1:] &= near[:-1]
    stop[:1] = False
    return np.where(near, ids, -1)[near | stop].astype("<i4").tobytes()


def _words_of(batches):
    """(lang, local numbers, keys) of the words of each slice."""
    for lang, found in _by_lang(batches):
        local = dict.fromkeys(found)
        for k, word in enumerate(local):
            local[word] = k
        yield lang, np.fromiter(map(local.__getitem__, found), np.int64, len(found)), list(local)


def _keys_of(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where pairs of neighbours start, and their keys."""
    at = np.flatnonzero((ids[:-1] >= 0) & (ids[1:] >= 0))
    return at, ids[at].astype(np.int64) << 32 | ids[at + 1]


def _pairs_of(batches):
    """(lang, local numbers, keys) of the pairs of each row of ids."""
    for batch in batches:
        for lang, raw in zip(batch.column("lang").to_pylist(), batch.column("ids").to_pylist(), strict=True):
            ids = np.frombuffer(raw, "<i4")
            at, keys = _keys_of(ids)
            own, number = np.unique(keys, return_inverse=True)
            local = np.full(len(ids), -1, np.int64)
            local[at] = number
            yield lang, local, own


def _taken(local: np.ndarray, ids: np.ndarray) -> np.ndarray:
    return np.append(ids, -1)[local]  # -1 stays -1


def encoded(rows: DataFrame, table: DataFrame, keys_of, kind: str, most: int, size: int) -> DataFrame:
    """(lang, ids): the ids of ``table`` (lang, id, key, f) in place of words or pairs; staged."""
    spark = rows.sparkSession
    n, took = table.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length(F.col("key").cast("string"))), F.lit(0))).first()
    schema = pa.schema([("lang", pa.string()), ("ids", pa.binary())])
    row = lambda lang, ids: pa.record_batch([pa.array([lang]), pa.array([ids], pa.binary())], schema=schema)
    if n <= most and took <= size:
        known: dict[str, tuple[list, list]] = {}
        for r in table.select("lang", "id", "key").toLocalIterator():  # ``most`` rows at most
            own = known.setdefault(r["lang"], ([], []))
            own[0].append(r["key"].encode() if kind == "string" else r["key"])
            own[1].append(r["id"])
        if kind == "string":
            held = C.broadcast(spark, known)
        else:
            held = C.broadcast(spark, {x: ((a := np.array(keys, np.int64))[o := np.argsort(a)], np.array(ids, np.int64)[o]) for x, (keys, ids) in known.items()})

        def look(lang, keys, now):
            if kind == "string":
                if lang not in now:
                    now[lang] = dict(zip(*held.value.get(lang, ([], [])), strict=True))
                get = now[lang].get
                return np.fromiter((get(k, -1) for k in keys), np.int64, len(keys))
            own, ids = held.value.get(lang, (np.zeros(0, np.int64), np.zeros(0, np.int64)))
            if not len(own):
                return np.full(len(keys), -1)
            spot = np.minimum(np.searchsorted(own, keys), len(own) - 1)
            return np.where(own[spot] == keys, ids[spot], -1)

        def direct(batches):
            now: dict = {}
            for lang, local, keys in keys_of(batches):
                if ids := packed(_taken(local, look(lang, keys, now))):
                    yield row(lang, ids)

        return C.stage(rows.mapInArrow(direct, "lang string, ids binary"), "phrase-ids", "zstd")

    def asking(batches):
        from pyspark import TaskContext

        chunk = TaskContext.get().partitionId() << 33
        for lang, local, keys in keys_of(batches):
            made = pa.array([keys], pa.list_(pa.binary())).cast(pa.list_(pa.string())) if kind == "string" else pa.array([keys], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array([chunk]), pa.array([lang]), pa.array([local.astype("<i4").tobytes()], pa.binary()), made], names=["chunk", "lang", "local", "keys"])
            chunk += 1

    def answered(batches):
        for batch in batches:
            for lang, local, at, ids in zip(*(batch.column(c).to_pylist() for c in ("lang", "local", "at", "ids")), strict=True):
                local = np.frombuffer(local, "<i4")
                found = np.full(int(local.max(initial=-1)) + 1, -1, np.int64)
                found[np.array(at, np.int64)] = ids
                if ids := packed(_taken(local, found)):
                    yield row(lang, ids)

    chunks = C.stage(rows.mapInArrow(asking, f"chunk long, lang string, local binary, keys array<{'string' if kind == 'string' else 'long'}>"), "phrase-chunks", "zstd")
    asks = chunks.select("chunk", "lang", F.posexplode_outer("keys").alias("at", "key"))
    told = asks.join(table.select("lang", "key", "id"), ["lang", "key"]).groupBy("chunk").agg(F.collect_list(F.struct("at", "id")).alias("x"))
    whole = chunks.select("chunk", "lang", "local").join(told, "chunk").select("lang", "local", F.col("x.at").alias("at"), F.col("x.id").alias("ids"))
    out = C.stage(whole.mapInArrow(answered, "lang string, ids binary"), "phrase-ids", "zstd")
    C.unstage(chunks)
    return out


def counted(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys and their counts: dense tiles for frequent ids, sorted coordinates for the rest."""
    a, b = keys >> 32, keys & 0xFFFFFFFF
    dense = (a < DENSE) & (b < DENSE)
    rest, n = np.unique(keys[~dense], return_counts=True)
    found, counts = [rest], [n]
    a, b = a[dense], b[dense]
    side = DENSE // TILE
    tile = a // TILE * side + b // TILE
    order = np.argsort(tile.astype(np.int16), kind="stable")  # a radix sort
    cell = (a % TILE * TILE + b % TILE)[order]
    edges = np.searchsorted(tile[order], np.arange(side * side + 1))
    for t in np.flatnonzero(np.diff(edges)).tolist():
        sums = np.bincount(cell[edges[t] : edges[t + 1]], minlength=TILE * TILE)
        full = np.flatnonzero(sums)
        found.append((full // TILE + t // side * TILE) << 32 | full % TILE + t % side * TILE)
        counts.append(sums[full])
    return np.concatenate(found), np.concatenate(counts)


def pair_counts(rows: DataFrame, least: int, buffer: int) -> DataFrame:
    """(lang, key, f) of pairs of neighbouring ids that occur ``least`` times or more."""
    schema = pa.schema([("lang", pa.string()), ("key", pa.int64()), ("f", pa.int64())])

    def told(lang, held):
        keys, n = counted(np.concatenate(held))
        yield from C.batches_of(schema, {"lang": pa.repeat(lang, len(keys)), "key": pa.array(keys), "f": pa.array(n)})

    def run(batches):
        held: dict[str, list[np.ndarray]] = {}
        total = 0
        for batch in batches:
            for lang, raw in zip(batch.column("lang").to_pylist(), batch.column("ids").to_pylist(), strict=True):
                keys = _keys_of(np.frombuffer(raw, "<i4"))[1]
                held.setdefault(lang, []).append(keys)
                total += len(keys)
                if total > buffer:
                    for x in held.items():
                        yield from told(*x)
                    held.clear()
                    total = 0
        for x in held.items():
            yield from told(*x)

    return rows.mapInArrow(run, "lang string, key long, f long").groupBy("lang", "key").agg(F.sum("f").alias("f")).where(F.col("f") >= least)


def longer(table: DataFrame, before: DataFrame) -> DataFrame:
    """(lang, id, f, p, q, words, pre, suf): what the two shorter phrases know, and the count as the last of both ``pre`` (of the first 1, 2, ... words) and ``suf`` (of the last)."""
    x = table.select("lang", "id", "f", F.shiftright("key", 32).alias("p"), F.col("key").bitwiseAND(F.lit(0xFFFFFFFF)).alias("q"))
    left = before.select("lang", F.col("id").alias("p"), F.col("words").alias("first"), "pre")
    right = before.select("lang", F.col("id").alias("q"), F.element_at("words", -1).alias("last"), "suf")
    both = x.join(left, ["lang", "p"]).join(right, ["lang", "q"])
    own = F.array("f")
    return both.select("lang", "id", "f", "p", "q", F.concat("first", F.array("last")).alias("words"), F.concat("pre", own).alias("pre"), F.concat("suf", own).alias("suf"))


def lowest_cut(f: str, n: str):
    """(score, k, l, r) of the cut with the lowest score, ties to the first, by columns pre and suf; products have 38 digits."""
    big = lambda x: x.cast("decimal(19,0)")
    m = F.size("pre")

    def cut(k):
        left, right = F.col("pre")[k - 1], F.col("suf")[m - k - 1]
        score = F.call_function("div", big(F.col(f)) * big(F.col(n)) * F.lit(1000).cast("decimal(4,0)"), big(left) * big(right))
        return F.struct(score.alias("score"), k.alias("k"), left.alias("l"), right.alias("r"))

    return F.array_min(F.transform(F.sequence(F.lit(1), m - 1), cut))


def collocations(docs: DataFrame, text: str = "text", lang: str = "lang", longest: int = LONGEST, least: int = LEAST, top: int = TOP, keys: int = KEYS, key_bytes: int = KEY_BYTES, buffer: int = BUFFER) -> DataFrame:
    """The first ``top`` phrases of each language: lang, rank, phrase, a, l, r, n, score.

    A phrase whose words lie within a longer one that occurs as often is dropped; it is enough to look one word further, as
    every phrase between the two occurs as often, too.
    """
    docs = docs.select(F.coalesce(F.col(lang), F.lit("und")).alias("lang"), F.col(text).alias("text"))
    words = C.stage(word_counts(docs), "phrase-words", "zstd")
    totals = words.groupBy("lang").agg(F.sum("f").alias("n"))
    table = ranked(words.where(F.col("f") >= least), "phrase-ranks")
    known = table.select("lang", "id", "f", F.array("key").alias("words"), F.array("f").alias("pre"), F.array("f").alias("suf"))
    rows = encoded(docs, table, _words_of, "string", keys, key_bytes)
    levels = []
    for size in range(2, longest + 1):
        table = ranked(pair_counts(rows, least, buffer), "phrase-ranks")
        C.release(docs.sparkSession)
        known = C.stage(longer(table, known), "phrase-known")
        levels.append(known)
        if size < longest:
            before, rows = rows, encoded(rows, table, _pairs_of, "long", keys, key_bytes)
            C.unstage(before)
    C.unstage(rows)
    found = None
    for k, own in enumerate(levels):
        if k + 1 < len(levels):
            over = levels[k + 1].select("lang", F.explode(F.array("p", "q")).alias("id"), "f").groupBy("lang", "id").agg(F.max("f").alias("over"))
            own = own.join(over, ["lang", "id"], "left").where("over is null or over < f")
        own = own.select("lang", F.array_join("words", " ").alias("phrase"), "f", "pre", "suf")
        found = own if found is None else found.unionAll(own)
    scored = found.join(totals, "lang")
    best = scored.select("lang", "phrase", F.col("f").alias("a"), "n", lowest_cut("f", "n").alias("x")).select("lang", "phrase", "a", "x.l", "x.r", "n", "x.score")
    place = F.row_number().over(W.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase"))
    return best.withColumn("rank", place.cast("long")).where(F.col("rank") <= top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
