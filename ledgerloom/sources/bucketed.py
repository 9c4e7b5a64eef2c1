"""Tables in buckets that a change rewrites one by one (copy-on-write).

A version's rows are below ``rows/version=V/_bucket=B``, and only the buckets that it changed. ``manifest/version=V`` tells where the buckets that
V changed are now; every ``FULL``-th manifest tells of all. What the table is follows from a number alone, the last version that counts, which the owner keeps: a version
that a crash left half written is never looked at, and is written again under its number.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructType

FULL = 16


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


class Buckets:
    def __init__(self, spark: SparkSession, root: str, schema: StructType):
        self.spark, self.root = spark, root
        self.plain = schema
        self.schema = StructType([*schema.fields]).add("_bucket", LongType()).add("version", LongType())

    def place(self, version: int, bucket: int) -> str:
        return f"{self.root}/rows/version={version}/_bucket={bucket}"

    def manifest(self, version: int) -> DataFrame:
        """(_bucket, version) of every bucket that is not empty, as of ``version``."""
        paths = [p for v in range(version - version % FULL, version + 1) if self._exists(p := f"{self.root}/manifest/version={v}")]
        if not paths:
            return self.spark.createDataFrame([], "_bucket long, version long")
        told = self.spark.read.schema("_bucket long, place long").option("basePath", f"{self.root}/manifest").parquet(*paths)
        return told.groupBy("_bucket").agg(F.max("place").alias("version"))

    def read(self, version: int, buckets: list[int] | None = None) -> DataFrame:
        """Rows with their ``_bucket``: of all buckets, or of some, whose files alone are listed and read."""
        now = self.manifest(version)
        if buckets is not None:
            now = now.where(F.col("_bucket").isin(buckets)) if buckets else now.limit(0)
            places = [self.place(r["version"], r["_bucket"]) for r in now.collect()]  # as many as the change touches
            paths = [p for p in places if self._exists(p)]
            if not paths:
                return self.spark.createDataFrame([], self.schema).drop("version")
            return self.spark.read.schema(self.schema).option("basePath", f"{self.root}/rows").parquet(*paths).drop("version")
        if not self._exists(f"{self.root}/rows"):
            return self.spark.createDataFrame([], self.schema).drop("version")
        return self.spark.read.schema(self.schema).parquet(f"{self.root}/rows").join(now, ["_bucket", "version"], "left_semi").select(*self.plain.names, "_bucket")

    def write(self, version: int, rows: DataFrame, whole: bool = False) -> list[int]:
        """Write the buckets of ``rows``, which has all rows of each; ``whole``: there are no others. The buckets that were written."""
        path = f"{self.root}/rows/version={version}"
        rows.select(*self.plain.names, F.col("_bucket").cast("long").alias("_bucket")).repartition("_bucket").write.mode("overwrite").partitionBy("_bucket").parquet(path)
        made = self._made(version)
        before = self.manifest(version - 1)
        own = self.spark.createDataFrame([(b,) for b in made], "_bucket long")
        told = own.withColumn("place", F.lit(version).cast("long"))
        others = before.join(own, "_bucket", "left_anti")
        if whole:  # buckets that are gone must not come back from older manifests
            told = told.unionAll(others.select("_bucket", F.lit(version).cast("long")))
        elif version % FULL == 0:
            told = told.unionAll(others)
        told.coalesce(1).write.mode("overwrite").parquet(f"{self.root}/manifest/version={version}")
        replaced = before if whole else before.join(own, "_bucket", "left_semi")
        replaced.coalesce(1).write.mode("overwrite").parquet(f"{self.root}/replaced/version={version}")
        return made

    def clean(self, version: int) -> None:
        """Delete what ``version`` replaced, which only the version before it shows, and notes that nothing needs any more."""
        fs, note = _fs(self.spark, f"{self.root}/replaced/version={version}")
        if fs.exists(note):
            for r in self.spark.read.schema("_bucket long, version long").option("basePath", str(note)).parquet(str(note)).collect():  # as many as the change touched
                p = _fs(self.spark, self.place(r["version"], r["_bucket"]))[1]
                fs.delete(p, True)
                if not self._made(r["version"]):
                    fs.delete(p.getParent(), True)
            fs.delete(note, True)
        old = version - version % FULL - 1  # the window that ``version`` reads begins after it
        for v in range(max(0, old - FULL + 1), old + 1) if version % FULL == 0 else ():
            fs.delete(_fs(self.spark, f"{self.root}/manifest/version={v}")[1], True)

    def bytes_of(self, version: int) -> int:
        """What a version wrote."""
        fs, p = _fs(self.spark, f"{self.root}/rows/version={version}")
        return fs.getContentSummary(p).getLength() if fs.exists(p) else 0

    def _exists(self, path: str) -> bool:
        fs, p = _fs(self.spark, path)
        return fs.exists(p)

    def _made(self, version: int) -> list[int]:
        fs, p = _fs(self.spark, f"{self.root}/rows/version={version}")
        names = [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []
        return sorted(int(n.partition("=")[2]) for n in names if n.startswith("_bucket="))


def bucket_of(key: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("long")
