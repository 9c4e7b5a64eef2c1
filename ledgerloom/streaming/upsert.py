"""Incremental archive: each micro-batch of unit rows is merged into a table of buckets, of which it rewrites those that it changes."""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ledgerloom.operators import merge
from ledgerloom.plans.lineage import drop, keep
from ledgerloom.sources import archive as A
from ledgerloom.sources.bucketed import Buckets, bucket_of

#: Rows of a bucket before the number of buckets is doubled, and keys of a bucket of the index.
BUCKET_ROWS, BUCKET_KEYS = 4096, 1 << 16


class Archive:
    """Unit rows below ``root``, with an index from what a row can be found by (its legacy identity, its block) to its bucket.

    A batch looks up its own keys in the index, reads the buckets that they name, merges, and writes the buckets with a change: time and
    bytes follow the batch. The index may name a bucket too many (a key that a row no longer has), never one too few. A commit is one rename of the pointer, which has
    the version, the numbers of buckets, of rows and of the next row. When the rows outgrow the buckets, these are doubled in one rewrite, whose
    cost is a constant a row over time. The version before the current one stays readable; older ones go.
    """

    def __init__(self, spark, root: str, schema: StructType, bucket_rows: int = BUCKET_ROWS):
        self.spark, self.root, self.schema, self.bucket_rows = spark, root, schema, bucket_rows
        self.rows = Buckets(spark, f"{root}/units", schema)
        self.keys = Buckets(spark, f"{root}/keys", StructType().add("key", "long").add("bucket", "long"))
        self.start = 0

    def state(self) -> dict:
        text = A.pointed(self.spark, self.root)
        return json.loads(text) if text else {"version": -1, "buckets": 1, "key_buckets": 1, "rows": 0, "next": 0}

    def last(self) -> int:
        """The last version that counts, -1 if there is none."""
        return self.state()["version"]

    def read(self, version: int | None = None) -> DataFrame:
        version = self.last() if version is None else version
        return self.rows.read(version).select(*self.schema.names) if version >= 0 else self.spark.createDataFrame([], self.schema)

    def latest(self, version: int | None = None) -> DataFrame:
        """What a version added or updated, with ``_status``."""
        return self.spark.read.parquet(f"{self.root}/latest/version={self.last() if version is None else version}")

    def _index(self, rows: DataFrame, count: int) -> DataFrame:
        """(key, bucket, _bucket) of rows that have a ``_bucket``: what each can be found by, in the index's own bucket."""
        links = merge.block_links(merge.compact(rows.drop("_bucket")).withColumn("side", F.lit(0))).select("ord", F.xxhash64("key").alias("key"))
        named = links.join(rows.select("ord", F.col("_bucket").alias("bucket")), "ord").select("key", "bucket").distinct()
        return named.withColumn("_bucket", bucket_of(F.col("key"), count))

    @staticmethod
    def _numbers(df: DataFrame, column: str) -> list[int]:
        """Distinct numbers of buckets: as many as a batch has keys, at most."""
        return sorted(r[0] for r in df.select(column).distinct().collect())

    def put(self, batch: DataFrame, number: int) -> None:
        """foreachBatch sink: batch ``number`` of this stream is version ``start + number``; one that counts already is not put again."""
        now, version = self.state(), self.start + number
        if version <= now["version"]:
            return
        first = batch.agg(F.min("ord"), F.max("ord")).first()
        shift = 0 if first[0] is None else now["next"] - first[0]  # rows that are new take numbers that no row has
        new = keep(batch.select(*self.schema.names).withColumn("ord", F.col("ord") + shift))
        own = merge.block_links(merge.compact(new).withColumn("side", F.lit(1))).select("ord", F.xxhash64("key").alias("key"))
        asked = keep(own.select("key").distinct().withColumn("_bucket", bucket_of(F.col("key"), now["key_buckets"])))
        known = self.keys.read(now["version"], self._numbers(asked, "_bucket")).drop("_bucket")
        hit = known.join(asked.select("key"), "key", "left_semi")
        home = keep(own.groupBy("ord").agg(F.min("key").alias("key")).select("ord", bucket_of(F.col("key"), now["buckets"]).alias("home")))
        touched = self._numbers(hit.select(F.col("bucket").alias("b")).unionAll(home.select(F.col("home").alias("b"))), "b")
        held = keep(self.rows.read(now["version"], touched))
        out = merge.upsert(held.select(*self.schema.names), new).select(*self.schema.names, "_status")
        placed = out.join(held.select("ord", F.col("_bucket").alias("was")), "ord", "left").join(home, "ord", "left")
        done = keep(placed.select(*self.schema.names, "_status", F.coalesce("was", "home").alias("_bucket")))
        changed = done.where("_status != 'kept'")
        changed.drop("_bucket").write.mode("overwrite").parquet(f"{self.root}/latest/version={version}")
        written = done.join(changed.select("_bucket").distinct(), "_bucket", "left_semi")
        self.rows.write(version, written)
        told = keep(self._index(changed.drop("_status"), now["key_buckets"]))
        index = keep(told.join(self.keys.read(now["version"], self._numbers(told, "_bucket")), ["key", "bucket", "_bucket"], "left_anti"))
        fresh = self._numbers(index, "_bucket")
        self.keys.write(version, index.unionByName(self.keys.read(now["version"], fresh)))
        added = done.where("_status = 'added'").count()
        after = now | {"version": version, "rows": now["rows"] + added, "next": max(now["next"], 0 if first[1] is None else first[1] + shift + 1)}
        if after["rows"] > 2 * after["buckets"] * self.bucket_rows:
            after = self._grow(after)
        A.point(self.spark, self.root, json.dumps(after))
        for table in (self.rows, self.keys):
            table.clean(version - 1)  # the version before stays readable
        A.delete(self.spark, f"{self.root}/latest/version={version - 2}")
        drop(new, asked, home, held, done, told, index)

    def _grow(self, state: dict) -> dict:
        """Deal all rows out to more buckets, under the version that is about to count."""
        version, buckets = state["version"], state["buckets"]
        while state["rows"] > buckets * self.bucket_rows:
            buckets *= 2
        key_buckets = max(1, 4 * state["rows"] // BUCKET_KEYS)
        rows = self.rows.read(version).drop("_bucket")
        links = merge.block_links(merge.compact(rows).withColumn("side", F.lit(0))).select("ord", F.xxhash64("key").alias("key"))
        home = links.groupBy("ord").agg(bucket_of(F.min("key"), buckets).alias("_bucket"))
        dealt = keep(rows.join(home, "ord"))
        self.rows.write(version, dealt, whole=True)
        self.keys.write(version, self._index(dealt, key_buckets), whole=True)
        drop(dealt)
        return state | {"buckets": buckets, "key_buckets": key_buckets}

    def _started(self, checkpoint: str) -> int:
        note = f"{self.root}/starts/{hashlib.sha256(checkpoint.encode()).hexdigest()[:16]}"
        if A.exists(self.spark, f"{checkpoint}/offsets") and A.exists(self.spark, f"{note}/_SUCCESS"):
            return int(self.spark.read.text(note).first()[0])
        start = self.last() + 1
        self.spark.createDataFrame([(str(start),)], "value string").coalesce(1).write.mode("overwrite").text(note)
        return start

    def run(self, stream: DataFrame, checkpoint: str) -> None:
        self.start = self._started(checkpoint)
        query = stream.writeStream.foreachBatch(self.put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        query.awaitTermination()
