"""What the corpus operators share: staged tables, bounded row filters, Arrow helpers."""

from __future__ import annotations

import contextlib
import gc
import tempfile
import uuid
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: ASCII white space, the only separators of words: [\x20\x09-\x0D]. bytes.split() uses the same six.
SPACE = b" \t\n\x0b\x0c\r"
#: Rows of text are handled in slices of about so many bytes, so that memory does not follow the batch.
SLICE_BYTES = 4 << 20
#: Bits of the row filter of ``maybe_in``: eight for each key, from 2**20 up to 2**26 (8 MB). With more keys than the last has room
#: for, the filter lets more rows pass to the join that follows; the result is the same.
FILTER_BITS = (1 << 20, 1 << 26)
#: A worker remembers what it found out about words of so many bytes at most, and about so many of them.
MEMO_BYTES, MEMO_WORDS = 32, 200_000

#: Multipliers of the keys of ``sketch``.
KEYS = np.array([0x9E3779B1, 0x85EBCA6B, 0xC2B2AE35, 0x27D4EB2F, 0x165667B1, 0xD3A2646D, 0xFD7046C5, 0xB55A4F09], np.uint32)

_made: dict[tuple[str, str], list] = {}
_owner = ["session"]


class Memo(dict):
    """What ``make`` gives for each word; only short words are remembered, and a bounded number, so memory is bounded too.

    Made by each task for itself, so that it goes when the task ends.
    """

    def __init__(self, make):
        super().__init__()
        self.make = make

    def __missing__(self, word):
        value = self.make(word)
        if len(word) <= MEMO_BYTES:
            if len(self) >= MEMO_WORDS:
                self.clear()
            self[word] = value
        return value


@contextlib.contextmanager
def owner(name: str):
    """What is staged or broadcast within belongs to ``name`` and can be swept without touching what others hold."""
    before, _owner[0] = _owner[0], name
    try:
        yield
    finally:
        _owner[0] = before


def _own(spark: SparkSession, name: str | None = None) -> list:
    return _made.setdefault((spark.sparkContext.applicationId, name or _owner[0]), [])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors share: ``spark.checkpoint.dir``.

    Only where the session names none and runs in one process (tests) is a temporary folder made.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return base
    if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    base = "file://" + tempfile.mkdtemp(prefix="ledgerloom-")
    spark.conf.set("spark.checkpoint.dir", base)
    spark.sparkContext.setCheckpointDir(base)
    return base


def new_path(spark: SparkSession, name: str) -> str:
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    _own(spark).append(path)
    return path


def broadcast(spark: SparkSession, value):
    """A value of bounded size for all tasks; destroyed by ``sweep``."""
    held = spark.sparkContext.broadcast(value)
    _own(spark).append(held)
    return held


def stage(df: DataFrame, name: str, codec: str = "snappy", *by: str) -> DataFrame:
    """Write ``df`` to the shared folder, in folders by the last columns ``by``, and read it back: lineage ends there, lost executors cost nothing."""
    path = new_path(df.sparkSession, name)
    df.write.option("compression", codec).partitionBy(*by).parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._staged_path = path
    return out


def aside(docs: DataFrame, *internal: str):
    """``docs`` with its columns out of the way of the operator's internal names, and a function that gives them their own names back."""
    taken = {x.lower() for x in internal}
    held = [f"own{k}_{c}" if c.lower() in taken else c for k, c in enumerate(docs.columns)]
    return docs.toDF(*held), lambda df, own=docs.columns: df.select(*[F.col(f"`{h}`").alias(c) for h, c in zip(held, own, strict=True)])


def delete(spark: SparkSession, path: str) -> None:
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def unstage(*frames: DataFrame) -> None:
    """Delete staged tables that nothing reads any more."""
    for df in frames:
        spark, path = df.sparkSession, df._staged_path
        for own in _made.values():
            if path in own:
                own.remove(path)
                delete(spark, path)


def trim() -> None:
    """Give memory that is free back to the system: a worker that goes on to other tasks would hold it."""
    gc.collect()
    for pool in (pa.default_memory_pool(), pa.system_memory_pool()):
        pool.release_unused()


def release(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of tables that are staged by now: it does so when their plans are collected as garbage."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def sweep(spark: SparkSession, name: str = "session") -> None:
    """Delete the staged tables and broadcasts of one owner, which must have written every result it holds."""
    own = _own(spark, name)
    while own:
        x = own.pop()
        delete(spark, x) if isinstance(x, str) else x.destroy()


def _filter_table(keys: DataFrame, bits: int) -> DataFrame:
    spot = F.pmod(F.xxhash64(F.lit(17), keys.columns[0]), F.lit(bits)) + 1
    return keys.select(spot.alias("x")).groupBy(F.expr("bitmap_bucket_number(x)").alias("_bucket")).agg(F.expr("bitmap_construct_agg(bitmap_bit_position(x))").alias("_bits"))


def maybe_in(df: DataFrame, column: str, keys: DataFrame) -> DataFrame:
    """``df`` with ``_maybe``: false where ``column`` is surely not among ``keys`` (one column; best a staged table, as it is read twice).

    A bitmap over hashed keys is broadcast; its size follows the number of keys between the bounds of FILTER_BITS.
    """
    least, most = FILTER_BITS
    bits = min(most, max(least, 1 << (8 * keys.count()).bit_length()))
    x = F.pmod(F.xxhash64(F.lit(17), F.col(column)), F.lit(bits)) + 1
    small = F.broadcast(_filter_table(keys, bits))
    spot = df.withColumn("_x", x).withColumn("_bucket", F.expr("bitmap_bucket_number(_x)"))
    bit = F.expr("shiftright(cast(conv(hex(substring(_bits, cast(bitmap_bit_position(_x) div 8 as int) + 1, 1)), 16, 10) as int), cast(bitmap_bit_position(_x) % 8 as int)) & 1")
    return spot.join(small, "_bucket", "left").withColumn("_maybe", F.coalesce(bit == 1, F.lit(False))).drop("_x", "_bucket", "_bits")


def semi(df: DataFrame, column: str, keys: DataFrame) -> DataFrame:
    """Rows of ``df`` whose ``column`` is among ``keys``; only rows that may match are shuffled."""
    kept = [c for c in df.columns]
    near = maybe_in(df, column, keys).where("_maybe").select(*kept)
    return near.join(keys.select(F.col(keys.columns[0]).alias("_key")).distinct(), F.col(column) == F.col("_key"), "left_semi")


def anti(df: DataFrame, column: str, keys: DataFrame) -> DataFrame:
    """Rows of ``df`` whose ``column`` is null or not among ``keys``; only rows that may match are shuffled."""
    kept = [c for c in df.columns]
    marked = maybe_in(df, column, keys)
    sure = marked.where("not _maybe").select(*kept)
    near = marked.where("_maybe").select(*kept)
    return sure.unionAll(near.join(keys.select(F.col(keys.columns[0]).alias("_key")).distinct(), F.col(column) == F.col("_key"), "left_anti"))


def sketch(words: list[bytes]) -> list[int]:
    """MinHash of a text's runs of three words, a key for each of KEYS: near-copies share most of them."""
    x = np.array([zlib.crc32(b" ".join(words[k : k + 3])) for k in range(max(1, len(words) - 2))], np.uint32)
    x = (x ^ x >> np.uint32(15))[:, None] * KEYS
    return (x ^ x >> np.uint32(13)).min(axis=0).view(np.int32).tolist()


def unlike(docs: list[tuple[bytes, int]]) -> list[tuple[bytes, int]]:
    """The (text, label) of a bounded sample without those that share half of their keys with an earlier one of the label."""
    out, index = [], {}
    for text, label in docs:
        own = [(label, k, x) for k, x in enumerate(sketch(text.lower().split()))]
        met = Counter(d for key in own for d in index.get(key, ()))
        if not met or max(met.values()) < len(KEYS) // 2:
            for key in own:
                index.setdefault(key, []).append(len(out))
            out.append((text, label))
    return out


def lookup(df: DataFrame, column: str, table: DataFrame) -> DataFrame:
    """``df`` with the other columns of ``table`` where its first column, in which no value recurs, equals ``column``, else nulls; only rows that may match are shuffled."""
    key, *values = table.columns
    marked = maybe_in(df, column, table.select(key))
    kept = [F.col(c) for c in df.columns]
    sure = marked.where("not _maybe").select(*kept, *[F.lit(None).cast(table.schema[v].dataType).alias(v) for v in values])
    near = marked.where("_maybe").select(*kept).join(table.withColumnRenamed(key, "_key"), F.col(column) == F.col("_key"), "left")
    return sure.unionAll(near.select(*kept, *values))


def bounded(sample: DataFrame, kind: str, lot, size: int) -> list[tuple]:
    """(_id, kind, UTF-8 text) of a sample (_id, kind, t), at most ``size`` bytes of each kind and the document that crosses them, by _id.

    ``lot``: the order in which the sample's rows are taken.
    """
    staged = stage(sample.withColumn("_lot", lot), "sample")
    before = F.coalesce(F.sum(F.octet_length("t")).over(W.partitionBy(kind).orderBy("_lot", "_id").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    rows = staged.select("_id", kind, "t", before.alias("_before")).where(F.col("_before") < size).collect()
    unstage(staged)
    return sorted((r["_id"], r[kind], r["t"].encode()) for r in rows)


def crc_mod(doc_id: str, m: int):
    """crc32(doc_id as text) mod m, as a column; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % m


def slices(batches, text: str = "text", size: int = SLICE_BYTES):
    """Arrow batches cut so that each holds about ``size`` bytes of text (one row at least)."""
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        sizes = np.asarray(pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
        part = np.cumsum(sizes) // size
        edges = np.flatnonzero(np.diff(part)) + 1
        for a, b in zip(np.concatenate(([0], edges)), np.concatenate((edges, [n])), strict=True):
            if b > a:
                yield batch.slice(int(a), int(b - a))


def raw(column) -> list[bytes]:
    """UTF-8 bytes of a string column; null as empty."""
    return [x or b"" for x in column.cast(pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()).to_pylist()]


def strings(column) -> list[str]:
    return [x or "" for x in column.to_pylist()]


def batches_of(schema: pa.Schema, columns: dict, rows: int = 1 << 16):
    """Output columns as Arrow batches of at most ``rows`` rows."""
    whole = pa.table(columns, schema=schema)
    yield from whole.to_batches(max_chunksize=rows)
