"""Deterministic sharded WARC writer and reader.

Pages are ordered by (page_id, digest, url, row). Exact running sums of the payload bytes over that order cut the
rows into shards, whatever partitions Spark sampled on the way; rows of one id, or without one, may fill many. Each task
writes the records of one shard as gzip members into files under temporary names and starts a new file when the compressed
size reaches ``roll_bytes``; it returns a manifest row for each file. Only files in the manifest of
the attempt that succeeded are renamed to their final names, and the manifest itself appears last, by
a rename too, so readers see all of a run or nothing. Equal pages give equal bytes.

Of equal payloads of ``MIN_REVISIT`` bytes or more, the page with the smallest id is a response and
the others are revisits of it, found by digest; the group's minimum is pre-aggregated, so a payload
that a third of all pages share is no hot key.

Defined cases: a null html is an empty payload; a null page_id sorts first, has no id in its headers
and comes back null, but never stands for others if a page with an id can; a null url leaves the
target out; control characters and blanks in a url are percent-encoded; repeated rows are records of
their own; no pages make an empty manifest; other columns are ignored. A very long page is one record, held whole by one task.
"""

from __future__ import annotations

import hashlib
import json
import uuid
import zlib
from bisect import bisect_right

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerloom.llm import common as C

MIN_REVISIT = 100
SHARD_BYTES = 32 << 20
ROLL_BYTES = 32 << 20
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: The tables have no fetch time; a caller that knows it passes it on.
DATE = "1970-01-01T00:00:00Z"
CHUNK = 1 << 20

MANIFEST = pa.schema([("shard", pa.int64()), ("seq", pa.int64()), ("temp", pa.string()), ("name", pa.string()), ("records", pa.int64()), ("bytes", pa.int64()), ("sha256", pa.string())])
RECORDS = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary())])


def _fs(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")


def _ddl(schema: pa.Schema) -> str:
    names = {pa.int64(): "long", pa.string(): "string", pa.binary(): "binary"}
    return ", ".join(f"{f.name} {names[f.type]}" for f in schema)


def record_id(page_id: int | None, digest: str, nth: int | str) -> str:
    return f"<urn:uuid:{uuid.UUID(bytes=hashlib.sha256(f'{page_id}/{digest}/{nth}'.encode()).digest()[:16], version=5)}>"


def _target(url: str) -> str:
    return "".join(c if c > " " and c != "\x7f" else f"%{ord(c):02X}" for c in url)


def record(page_id, url, payload: bytes, nth: int | str, refers_to=None, refers_nth: int = 0, date: str = DATE) -> bytes:
    """One WARC record; a revisit if ``refers_to`` names a page."""
    digest = hashlib.sha256(payload).hexdigest()
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = head if refers_to is not None else head + payload
    lines = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: {record_id(page_id, digest, nth)}", f"WARC-Date: {date}"]
    lines += [f"WARC-Target-URI: {_target(url)}"] if url is not None else []
    lines += [f"WARC-Payload-Digest: sha256:{digest}", f"WARC-Block-Digest: sha256:{hashlib.sha256(block).hexdigest()}", "Content-Type: application/http; msgtype=response"]
    lines += [f"X-Page-ID: {page_id}"] if page_id is not None else []
    if refers_to is not None:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {record_id(refers_to, digest, refers_nth)}", f"X-Refers-To-Page-ID: {refers_to}"]
    return "\r\n".join([*lines, f"Content-Length: {len(block)}", "", ""]).encode() + block + b"\r\n\r\n"


class _Roller:
    """Files of one shard, one after the other."""

    def __init__(self, uri: str, shard: int, roll_bytes: int):
        self.fs, self.root = _fs(uri)
        self.shard, self.roll, self.seq, self.file, self.done = shard, roll_bytes, 0, None, []

    def add(self, data: bytes) -> None:
        if self.file is None:
            self.temp = f"_temporary/{self.shard:06d}-{self.seq:04d}-{uuid.uuid4().hex}"
            self.fs.create_dir(f"{self.root}/_temporary", recursive=True)
            self.file, self.n, self.size, self.hash = self.fs.open_output_stream(f"{self.root}/{self.temp}", compression=None), 0, 0, hashlib.sha256()
        z = zlib.compressobj(6, zlib.DEFLATED, 31)
        member = z.compress(data) + z.flush()
        self.file.write(member)
        self.hash.update(member)
        self.n, self.size = self.n + 1, self.size + len(member)
        if self.size >= self.roll:
            self.close()

    def close(self) -> None:
        if self.file is not None:
            self.file.close()
            self.done.append((self.shard, self.seq, self.temp, f"pages-{self.shard:06d}-{self.seq:04d}.warc.gz", self.n, self.size, self.hash.hexdigest()))
            self.file, self.seq = None, self.seq + 1


ORDER = ("page_id", "digest", "lot", "rid")


def _bounds(slim: DataFrame, shard_bytes: int) -> list[tuple]:
    """The ORDER of the first row of each shard but the first."""
    parts = int(slim.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = C.stage(slim.repartitionByRange(parts, *ORDER).withColumn("part", F.spark_partition_id()), "warc-order", "zstd")
    sums = sorted((r["part"], r["n"]) for r in ordered.groupBy("part").agg(F.sum("n").alias("n")).collect())  # a row for each partition
    before, total = [], 0
    for part, n in sums:
        before.append((part, total))
        total += n
    if not before:
        return []
    start = slim.sparkSession.createDataFrame(before, "part int, before long")
    run = F.sum("n").over(W.partitionBy("part").orderBy(*ORDER).rowsBetween(W.unboundedPreceding, -1))
    shards = ordered.withColumn("run", F.coalesce(run, F.lit(0))).join(F.broadcast(start), "part").withColumn("shard", F.floor((F.col("before") + F.col("run")) / shard_bytes))
    firsts = shards.groupBy("shard").agg(F.min(F.struct(*ORDER)).alias("first")).orderBy("shard").select("first.*").collect()  # a row for each shard
    C.unstage(ordered)
    return [tuple(r) for r in firsts[1:]]


def _placed(page_id, *rest) -> tuple:
    """A row's place in ORDER; rows without an id come first."""
    return (page_id is not None, page_id or 0, *rest)


class Shards:
    """The shard of each row, by the first rows of the shards."""

    def __init__(self, bounds: list[tuple]):
        self.firsts = [_placed(*b) for b in bounds]
        self.ids = np.array([-(1 << 63) if b[0] is None else b[0] for b in bounds], np.int64)

    def __call__(self, ids: pd.Series, digests: pd.Series, lots: pd.Series, rids: pd.Series) -> np.ndarray:
        known = ids.notna().to_numpy()
        number = np.where(known, ids.fillna(0).to_numpy(np.int64), -(1 << 63))
        low, high = np.searchsorted(self.ids, number, side="left"), np.searchsorted(self.ids, number, side="right")
        for i in np.flatnonzero(low < high):  # a shard begins among the rows of this id
            high[i] = bisect_right(self.firsts, _placed(int(number[i]) if known[i] else None, digests[i], int(lots[i]), int(rids[i])))
        return high


def write_warc(pages: DataFrame, out: str, page_id: str = "page_id", url: str = "url", html: str = "html", shard_bytes: int = SHARD_BYTES, roll_bytes: int = ROLL_BYTES) -> None:
    """Write ``pages`` to the folder ``out``, which all executors share."""
    spark = pages.sparkSession
    rows = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"), F.coalesce(F.col(html).cast("string"), F.lit("")).cast("binary").alias("payload"))
    rows = C.stage(rows.withColumns({"rid": F.monotonically_increasing_id(), "digest": F.sha2("payload", 256), "n": F.octet_length("payload").cast("long"), "lot": F.xxhash64("url")}), "warc-rows", "zstd")
    slim = rows.select(*ORDER, "n")
    bounds = _bounds(slim, shard_bytes)

    @F.pandas_udf("long")
    def shard_of(ids: pd.Series, digests: pd.Series, lots: pd.Series, rids: pd.Series) -> pd.Series:
        return pd.Series(Shards(bounds)(ids, digests, lots, rids))

    order = F.struct(F.col("page_id").isNull().alias("x"), F.col("page_id"), F.col("lot"), F.col("rid"))
    heads = slim.where(F.col("n") >= MIN_REVISIT).groupBy("digest").agg(F.min(order).alias("head"), F.count(F.lit(1)).alias("k")).where("k > 1 and head.page_id is not null")
    heads = C.stage(heads.select("digest", F.col("head.page_id").alias("refers_to"), F.col("head.rid").alias("head")), "warc-heads")
    refs = slim.where(F.col("n") >= MIN_REVISIT).join(heads, "digest").where("rid != head").select(*ORDER, "refers_to")
    nothing = lambda t: F.lit(None).cast(t)
    both = rows.select(*ORDER, F.lit(1).alias("kind"), "url", "payload", nothing("long").alias("refers_to")).unionAll(refs.select(*ORDER, F.lit(0).alias("kind"), nothing("string"), nothing("binary"), "refers_to"))
    dealt = both.withColumn("shard", shard_of(*ORDER)).repartitionById(len(bounds) + 1, F.col("shard").cast("int")).sortWithinPartitions("shard", *ORDER, "kind")

    def run(batches):
        roller, refers, last, nth = None, None, object(), 0
        done = []
        for batch in batches:
            for shard, page, kind, target, payload, ref in zip(*(batch.column(c).to_pylist() for c in ("shard", "page_id", "kind", "url", "payload", "refers_to")), strict=True):
                if roller is None or roller.shard != shard:
                    if roller:
                        roller.close()
                        done += roller.done
                    roller = _Roller(out, shard, roll_bytes)
                if kind == 0:  # comes just before the row that it tells about
                    refers = ref
                    continue
                nth, last = (nth + 1 if page == last else 0), page
                first = page is not None and refers is None and len(payload or b"") >= MIN_REVISIT  # the only one of its digest
                roller.add(record(page, target, payload or b"", 0 if first else f"{shard}-{nth}", refers))
                refers = None
        if roller:
            roller.close()
            done += roller.done
        yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*done, strict=True) if done else [[]] * len(MANIFEST), MANIFEST, strict=True)], schema=MANIFEST)

    files = C.stage(dealt.mapInArrow(run, _ddl(MANIFEST)), "warc-files")
    _commit(spark, files, out)
    C.unstage(files, rows, heads)


def _commit(spark: SparkSession, files: DataFrame, out: str) -> None:
    """Rename the manifest's files; a repeated attempt finds its work done."""
    from pyarrow import fs

    def rename(batches):
        store, root = _fs(out)
        for batch in batches:
            for temp, name in zip(batch.column("temp").to_pylist(), batch.column("name").to_pylist(), strict=True):
                if store.get_file_info(f"{root}/{temp}").type != fs.FileType.NotFound:
                    store.move(f"{root}/{temp}", f"{root}/{name}")
            yield batch

    renamed = files.mapInArrow(rename, _ddl(MANIFEST)).select("shard", "seq", "name", "records", "bytes", "sha256").orderBy("shard", "seq").collect()  # a row for each file
    store, root = _fs(out)
    store.create_dir(root, recursive=True)
    with store.open_output_stream(f"{root}/_manifest.tmp") as f:
        f.write(json.dumps({"files": [r.asDict() for r in renamed]}, indent=1).encode())
    store.move(f"{root}/_manifest.tmp", f"{root}/manifest.json")
    store.delete_dir(f"{root}/_temporary") if store.get_file_info(f"{root}/_temporary").type == fs.FileType.Directory else None


def records(stream):
    """(headers, block) of each gzip member of a WARC file, read in chunks."""
    z, data, rest = zlib.decompressobj(31), [], b""
    while True:
        rest = rest or stream.read(CHUNK)
        if not rest:
            if data and any(data):
                raise ValueError("a WARC file ends within a record")
            return
        data.append(z.decompress(rest))
        rest = z.unused_data
        if z.eof:
            head, _, block = b"".join(data).partition(b"\r\n\r\n")
            lines = head.decode().split("\r\n")
            headers = dict(x.split(": ", 1) for x in lines[1:])
            size = int(headers["Content-Length"])
            if lines[0] != "WARC/1.1" or block[size:] != b"\r\n\r\n":
                raise ValueError("not a WARC record of its stated length")
            yield headers, block[:size]
            z, data = zlib.decompressobj(31), []


def read_warc(spark: SparkSession, out: str, payloads: bool = False) -> DataFrame:
    """The records of a committed folder, digests checked."""
    store, root = _fs(out)
    with store.open_input_stream(f"{root}/manifest.json") as f:
        names = [x["name"] for x in json.loads(f.read())["files"]]
    if not names:
        return spark.createDataFrame([], _ddl(RECORDS))

    def run(batches):
        store, root = _fs(out)
        for batch in batches:
            for name in batch.column("name").to_pylist():
                rows, size = [], 0
                with store.open_input_stream(f"{root}/{name}", compression=None) as f:
                    for headers, block in records(f):
                        if hashlib.sha256(block).hexdigest() != headers["WARC-Block-Digest"].removeprefix("sha256:"):
                            raise ValueError(f"{name}: a block does not have its digest")
                        http, _, payload = block.partition(b"\r\n\r\n")
                        digest, kind = headers["WARC-Payload-Digest"].removeprefix("sha256:"), headers["WARC-Type"]
                        if kind == "response" and hashlib.sha256(payload).hexdigest() != digest:
                            raise ValueError(f"{name}: a payload does not have its digest")
                        length = int(http.rsplit(b"Content-Length: ", 1)[1])
                        number = lambda k: int(headers[k]) if k in headers else None  # noqa: B023, E731
                        rows.append((number("X-Page-ID"), headers.get("WARC-Target-URI"), length, digest, kind, number("X-Refers-To-Page-ID"), payload if payloads and kind == "response" else None))
                        size += len(block)
                        if size >= C.SLICE_BYTES:
                            yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), RECORDS, strict=True)], schema=RECORDS)
                            rows, size = [], 0
                if rows:
                    yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), RECORDS, strict=True)], schema=RECORDS)

    files = spark.createDataFrame([(n,) for n in names], "name string").repartition(len(names))
    return files.mapInArrow(run, _ddl(RECORDS))


def archived(pages: DataFrame) -> DataFrame:
    """Write ``pages`` to a new folder in the shared one and read them back."""
    out = C.new_path(pages.sparkSession, "warc")
    write_warc(pages, out)
    return read_warc(pages.sparkSession, out)
