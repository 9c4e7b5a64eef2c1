"""Exact deduplication as a stream with keyed state on disk.

Rows are staged with a digest of their normalised text, and a Structured Streaming query over the
staged files keeps, per digest and without expiry, the row count and the best row so far: length,
stable identifier and locator (the staged row's number). The state lives in RocksDB and is saved to
the shared checkpoint folder after every micro-batch, so a later run may go on from it. Every hit
is then checked byte by byte against the text that its locator names; a digest shared by different
texts is split by the texts themselves.

The partial aggregation before the shuffle sends one row per digest and task, so a group of copies
that holds a third of all rows is no hot key. The byte check is an aggregate too: a digest's least and greatest
normalised text are equal if and only if all are, and each task sends one row a digest. What is known of a digest then
meets its rows in a join of two staged tables, whose large keys Spark splits.

Defined cases: a null text counts as empty, so null and blank texts are one group; a row without
doc_id can be kept, but loses a tie against any row that has one; repeated rows (same doc_id, same
text) keep one; an empty table gives an empty result; other columns pass through, whatever their names. A very long
text is held whole by one task at a time.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm import common as C

#: Everything that the normalised text leaves out.
BLANKS = r"[\x20\x09-\x0D]+"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: Session settings while the stream runs. Space for logs is not set aside: there is a store for each shuffle partition. All stores of
#: an executor share one bounded memory, and those that a stream has left are closed soon.
SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": ROCKS,
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "128",
    "spark.sql.streaming.stateStore.rocksdb.writeBufferSizeMB": "4",
    "spark.sql.streaming.stateStore.maintenanceInterval": "10s",
}
#: Columns that the operator adds for itself.
INTERNAL = ("_rid", "_sha", "_len", "_n", "_best", "_norm", "_keep_rid", "keep_id", "group_size", "_maybe", "_key", "_x", "_bits", "_bucket")


def normalised(text: str):
    return F.regexp_replace(F.coalesce(F.col(text), F.lit("")), BLANKS, "")


def keyed(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with a row number, the digest of the normalised text and the code points of the original."""
    return docs.withColumns({
        "_rid": F.monotonically_increasing_id(),
        "_sha": F.sha2(normalised(text), 256),
        "_len": F.coalesce(F.length(text), F.lit(0)).cast("long"),
    })


def stream_state(staged_path: str, spark, schema, doc_id: str, files_per_batch: int) -> DataFrame:
    """Run the stream over the staged rows to its end; per digest: ``_n``, ``_best`` (len, ~doc_id, ~rid)."""
    sink, marks = C.new_path(spark, "dedup-state"), C.new_path(spark, "dedup-marks")
    before = {k: spark.conf.get(k, None) for k in SETTINGS}
    for k, v in SETTINGS.items():
        spark.conf.set(k, v)
    try:
        rows = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(staged_path)
        # ~x turns the order round without overflow, so that max() prefers the smallest doc_id, then the first row
        best = F.struct(F.col("_len"), F.bitwise_not(F.col(doc_id).cast("long")).alias("_not_id"), F.bitwise_not("_rid").alias("_not_rid"))
        state = rows.groupBy("_sha").agg(F.count(F.lit(1)).alias("_n"), F.max(best).alias("_best"))

        def put(batch: DataFrame, number: int) -> None:
            batch.withColumn("_batch", F.lit(number).cast("long")).write.mode("overwrite").parquet(f"{sink}/part={number}")

        query = state.writeStream.outputMode("update").foreachBatch(put).option("checkpointLocation", marks).trigger(availableNow=True).queryName(f"dedup-{uuid.uuid4().hex[:8]}").start()
        query.awaitTermination()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    shape = "_sha string, _n long, _best struct<_len: long, _not_id: long, _not_rid: long>, _batch long"
    found = spark.read.schema(shape).parquet(sink) if query.lastProgress or _exists(spark, sink) else spark.createDataFrame([], shape)
    return found.groupBy("_sha").agg(F.max_by(F.struct("_n", "_best"), "_batch").alias("_s")).select("_sha", "_s._n", "_s._best")


def _exists(spark, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def _staged(docs: DataFrame, doc_id: str, text: str, files_per_batch: int) -> tuple[DataFrame, DataFrame]:
    """The staged rows with their keys, and (_sha, _n, _best) of the digests that several rows have."""
    spark = docs.sparkSession
    staged = C.stage(keyed(docs, text), "dedup-rows", "zstd")
    if staged.limit(1).isEmpty():
        groups = spark.createDataFrame([], "_sha string, _n long, _best struct<_len: long, _not_id: long, _not_rid: long>")
    else:
        slim = staged.select(doc_id, "_rid", "_sha", "_len")
        groups = stream_state(staged._staged_path, spark, slim.schema, doc_id, files_per_batch).where("_n > 1")
    return staged, C.stage(groups, "dedup-groups")


def _joined(rows: DataFrame, groups: DataFrame, by: list[str], how: str = "inner") -> DataFrame:
    """``rows`` with what is known of their group: keep_id, _keep_rid, group_size."""
    best = F.col("_best")
    return rows.join(groups, by, how).withColumns({"keep_id": F.bitwise_not(best["_not_id"]), "_keep_rid": F.bitwise_not(best["_not_rid"]), "group_size": F.col("_n")}).drop("_n", "_best")


def judged(staged: DataFrame, groups: DataFrame, kept: list[str], doc_id: str, text: str) -> DataFrame:
    """``kept`` columns, _rid, _sha and _joined's of every row that shares its normalised text; and for rows that pass the digests' filter by chance, nulls."""
    slim = staged.select(*kept, "_rid", "_sha")
    near = C.maybe_in(slim, "_sha", groups.select("_sha")).where("_maybe").drop("_maybe")
    found = _joined(near, groups, ["_sha"], "left")
    wrong = _collisions(staged, groups, text)
    if wrong is None:
        return found
    mixed = C.semi(staged, "_sha", wrong).withColumn("_norm", normalised(text))
    order = F.struct("_len", F.bitwise_not(F.col(doc_id).cast("long")).alias("_not_id"), F.bitwise_not("_rid").alias("_not_rid"))
    apart = mixed.groupBy("_sha", "_norm").agg(F.count(F.lit(1)).alias("_n"), F.max(order).alias("_best"))
    fixed = _joined(mixed.select(*kept, "_rid", "_sha", "_norm"), apart, ["_sha", "_norm"]).drop("_norm")
    return found.join(wrong, "_sha", "left_anti").unionByName(fixed)


def _collisions(staged: DataFrame, groups: DataFrame, text: str) -> DataFrame | None:
    """Check the full bytes of every hit: the digests that hide different texts, None if there are none."""
    rows = C.semi(staged.select("_sha", text), "_sha", groups.select("_sha"))
    texts = rows.select("_sha", normalised(text).alias("_norm")).groupBy("_sha").agg(F.min("_norm").alias("lo"), F.max("_norm").alias("hi"))
    wrong = C.stage(texts.where("lo != hi").select("_sha"), "dedup-wrong")
    if wrong.isEmpty():
        C.unstage(wrong)
        return None
    return wrong


def exact_dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", files_per_batch: int = 64) -> DataFrame:
    """``docs`` without its text, with keep_id, group_size, kept and text_sha256 for every row, dropped ones too; these replace columns of their names.

    The staged table stays readable until ``common.sweep``; the result is lazy over it.
    """
    docs = docs.drop("keep_id", "group_size", "kept", "text_sha256")
    held, _ = C.aside(docs, *INTERNAL)
    names = {h: c for h, c in zip(held.columns, docs.columns, strict=True) if c != text}
    staged, groups = _staged(held, doc_id, text, files_per_batch)
    shared = judged(staged, groups, list(names), doc_id, text)
    alone = C.maybe_in(staged.select(*names, "_rid", "_sha"), "_sha", groups.select("_sha")).where("not _maybe").drop("_maybe")
    nothing = F.lit(None).cast("long")
    every = shared.unionByName(alone.withColumns({"keep_id": nothing, "_keep_rid": nothing, "group_size": nothing}))
    single = F.col("_keep_rid").isNull()
    return every.select(
        *[F.col(f"`{h}`").alias(c) for h, c in names.items()], F.when(single, F.col(doc_id).cast("long")).otherwise(F.col("keep_id")).alias("keep_id"), F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
        (single | (F.col("_rid") == F.col("_keep_rid"))).alias("kept"), F.col("_sha").alias("text_sha256"),
    )


def kept_only(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows that stay, with the columns of ``docs``."""
    held, named = C.aside(docs, *INTERNAL)
    staged, groups = _staged(held, doc_id, text, 64)
    dropped = C.stage(judged(staged, groups, [], doc_id, text).where("_rid != _keep_rid").select("_rid"), "dedup-dropped")
    return named(C.anti(staged, "_rid", dropped))
