"""Splittable scan of a JSON array in one file of any size.

Spark reads the file in byte ranges (blocks) as pieces that end with a closing brace, so each task has a part of the file and no text is held
whole. A first scan tells of each block how it changes the state (within a text or not, depth, elements passed), for either
state in which it may begin; these few numbers are put one after the other, a row for each block. A second scan, which knows the state that each block begins in,
cuts out the elements that are objects. Elements that cross blocks come as fragments and are put together by their place.

Defined cases: blanks, tabs and line ends before the array and a byte order mark are passed over; elements that are no objects go, but count in
``ord``; an empty array has no rows. A file that breaks off, or has more after its array, is broken, which is never the same as empty. An
element must fit into a row (2 GB), and so must what stands between two closing braces.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Texts, structure, and anything else that is not blank.
TOKEN = re.compile(r'"(?:[^"\\]|\\.)*(?P<end>"|\Z)|[\[\]{},]|[^\s"\[\]{},]+', re.DOTALL)
CLOSES = re.compile(r'(?:[^"\\]|\\.)*"', re.DOTALL)
MARK = "\ufeff"
BLOCK = "block long, inside boolean, ends boolean, delta int, low int, more boolean, again boolean, blank boolean, commas map<int, long>, opens string"
OUT = "block long, ord long, kind string, row string"


def tokens(text: str, inside: bool):
    """(token, place, still within a text) of a piece; ``inside``: it begins within a text, whose end is no token."""
    at = 0
    if inside:
        end = CLOSES.match(text)
        if end is None:
            yield "", len(text), True
            return
        at = end.end()
    for m in TOKEN.finditer(text, at):
        yield m[0], m.start(), m["end"] == ""


class State:
    """What a block does to the depth, if it begins ``inside`` a text or not; the depth counts from the block's beginning."""

    def __init__(self, inside: bool):
        self.began = self.inside = inside
        self.depth = self.low = 0
        self.more = self.again = False  # something comes after the lowest depth was reached; after the depth was back where it began
        self.blank = not inside
        self.opens, self.commas = None, {}

    def take(self, text: str, closed: bool) -> None:
        open_ = False
        for t, _, open_ in tokens(text, self.inside):
            self._step(t)
        self.inside = open_
        if closed and not self.inside:
            self._step("}")

    def _step(self, t: str) -> None:
        if not t:
            return
        self.again = self.again or (self.depth == 0 and self.opens is not None)
        self.blank = False
        self.opens = self.opens or t[0]
        self.more = self.more or self.depth == self.low < 0
        if t in "[{":
            self.depth += 1
        elif t in "]}":
            self.depth -= 1
            if self.depth < self.low:
                self.low, self.more = self.depth, False
        elif t == ",":
            self.commas[self.depth] = self.commas.get(self.depth, 0) + 1

    def row(self, block: int) -> tuple:
        return (block, self.began, self.inside, self.depth, self.low, self.more, self.again, self.blank, list(self.commas.items()), self.opens)


def _pieces(batches):
    """(block, text, closed) of the pieces of a task, in order; only the last piece of a file is not closed by a brace."""
    for batch in batches:
        yield from zip(batch.column("block").to_pylist(), batch.column("value").to_pylist(), batch.column("closed").to_pylist(), strict=True)


def _scan(batches):
    schema = pa.schema([("block", pa.int64()), ("inside", pa.bool_()), ("ends", pa.bool_()), ("delta", pa.int32()), ("low", pa.int32()), ("more", pa.bool_()), ("again", pa.bool_()), ("blank", pa.bool_()), ("commas", pa.map_(pa.int32(), pa.int64())), ("opens", pa.string())])
    now, states = None, []

    def told():
        rows = [s.row(now) for s in states]
        return pa.record_batch([pa.array([r[k] for r in rows], f.type) for k, f in enumerate(schema)], schema=schema)

    for block, text, closed in _pieces(batches):
        if block != now:
            if states:
                yield told()
            now, states = block, [State(False), State(True)]
        for s in states:
            s.take(text.removeprefix(MARK) if block == 0 and s.blank else text, closed)
    if states:
        yield told()


def _cut(batches):
    """Elements of the blocks of a task; the columns ``inside``, ``depth`` and ``passed`` tell how a block begins."""
    schema = pa.schema([("block", pa.int64()), ("ord", pa.int64()), ("kind", pa.string()), ("row", pa.string())])
    held, out = None, []

    def flush():
        rows = [*out]
        out.clear()
        return pa.record_batch([pa.array([r[k] for r in rows], f.type) for k, f in enumerate(schema)], schema=schema)

    for batch in batches:
        for block, text, closed, inside, depth, passed in zip(*(batch.column(c).to_pylist() for c in ("block", "value", "closed", "inside", "depth", "passed")), strict=True):
            if held is None or held["block"] != block:
                if held and held["parts"] is not None:
                    out.append((held["block"], held["ord"], held["kind"], "".join(held["parts"])))
                held = {"block": block, "inside": inside, "depth": depth, "ord": passed, "parts": [] if depth > 1 else None, "kind": "middle"}
            start, open_ = 0, False
            for t, at, open_ in tokens(text, held["inside"]):
                if t == "," and held["depth"] == 1:
                    held["ord"] += 1
                elif t in ("[", "{"):
                    if t == "{" and held["depth"] == 1:
                        held["parts"], held["kind"], start = [], "head", at
                    held["depth"] += 1
                elif t == "]":
                    held["depth"] -= 1
                    if held["depth"] == 1:
                        held["parts"] = None  # an element that is an array
            held["inside"] = open_
            if held["parts"] is not None:
                held["parts"].append(text[start:] + ("}" if closed else ""))
            if closed and not held["inside"]:
                held["depth"] -= 1
                if held["depth"] == 1 and held["parts"] is not None:
                    out.append((block, held["ord"], "whole" if held["kind"] == "head" else "tail", "".join(held["parts"])))
                    held["parts"] = None
        if out:
            yield flush()
    if held and held["parts"] is not None:
        out.append((held["block"], held["ord"], held["kind"], "".join(held["parts"])))
    if out:
        yield flush()


def pieces(spark: SparkSession, path: str) -> DataFrame:
    """(block, value, closed): the file up to each closing brace. Only its last piece may stand without one, which the file's last byte tells."""
    rows = spark.read.option("lineSep", "}").text(path).select(F.col("_metadata.file_block_start").alias("block"), "value").withColumn("at", F.monotonically_increasing_id())
    last = None if ends_with_brace(spark, path) else rows.agg(F.max(F.struct("block", "at"))).first()[0]
    closed = F.lit(True) if last is None else ~((F.col("block") == last[0]) & (F.col("at") == last[1]))
    return rows.select("block", "value", closed.alias("closed"))


def joined(rows: list) -> tuple[list[tuple], str]:
    """(block, inside, depth, passed) where each block begins, and what the file is: array, object, other, blank or broken."""
    out, inside, depth, passed, opens, over = [], False, 0, 0, None, False
    by = {(r["block"], r["inside"]): r for r in rows}
    for block in sorted({r["block"] for r in rows}):
        out.append((block, inside, depth, passed))
        r = by[block, inside]
        opens = opens or r["opens"]
        if over and not r["blank"]:
            return out, "broken"
        if depth + r["low"] < 0 or depth == 0 and r["again"]:
            return out, "broken"
        if r["low"] < 0 and depth + r["low"] == 0:
            over = True
            if r["more"]:
                return out, "broken"
        passed += (r["commas"] or {}).get(1 - depth, 0)
        inside, depth = r["ends"], depth + r["delta"]
        over = over or (depth == 0 and opens is not None)
    if opens is None:
        return out, "blank"
    if inside or depth:
        return out, "broken"
    return out, {"[": "array", "{": "object"}.get(opens, "other")


def scan(spark: SparkSession, path: str) -> tuple[DataFrame, list[tuple], str]:
    """The pieces, where each block begins, and what the file is. A row a block comes to the driver: 128 MB of the file each."""
    parts = pieces(spark, path)
    return parts, *joined(parts.mapInArrow(_scan, BLOCK).collect())


def ends_with_brace(spark: SparkSession, path: str) -> bool:
    """Whether the file's last byte is a closing brace, which the line reader swallows without a trace."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    size = fs.getFileStatus(p).getLen()
    if not size:
        return False
    stream = fs.open(p)
    try:
        stream.seek(size - 1)
        return stream.read() == ord("}")
    finally:
        stream.close()


def elements(spark: SparkSession, parts: DataFrame, begins: list[tuple]) -> DataFrame:
    """(ord, row): the objects of the array, each as its text."""
    starts = spark.createDataFrame(begins or [(0, False, 0, 0)], "block long, inside boolean, depth int, passed long")
    cut = parts.join(F.broadcast(starts), "block").mapInArrow(_cut, OUT)
    whole = cut.where("kind = 'whole'").select("ord", "row")
    pieces_ = cut.where("kind != 'whole'").groupBy("ord").agg(F.sort_array(F.collect_list(F.struct("block", "kind", "row"))).alias("x"))
    crossed = pieces_.where(F.exists("x", lambda p: p["kind"] == "head") & F.exists("x", lambda p: p["kind"] == "tail")).select("ord", F.array_join("x.row", "").alias("row"))
    return whole.unionAll(crossed)
