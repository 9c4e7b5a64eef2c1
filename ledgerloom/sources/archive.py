"""Scans and sinks of archives, deltas, run statistics and error logs."""

from __future__ import annotations

import contextlib
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ledgerloom.functions import urls as U
from ledgerloom.sources import json_array as J


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def delete(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


#: White space of JSON.
BLANKS = r"^[ \t\r\n\ufeff]+"


def read_archive(spark: SparkSession, path: str, schema: StructType, broken: str = "empty") -> DataFrame:
    """Rows of a JSON array file of any size, or of what ``write_atomic`` wrote as JSON, with their place as ``ord``.

    A missing file has no rows and neither has a broken one, unless ``broken`` is "error"; elements that are no objects go. An array is read in
    many tasks; a wrapper object ({properties: []}, {items: []}) or a single object is one text in one task, 2 GB at most.
    """
    now = current(spark, path)
    none = spark.createDataFrame([], schema)
    none = none if "ord" in schema.names else none.withColumn("ord", F.lit(0).cast("long"))
    if now is None:
        return none
    if now != path:
        return spark.read.schema(schema).json(now) if "ord" in schema.names else spark.read.schema(schema).json(now).withColumn("ord", F.monotonically_increasing_id())
    parts, begins, kind = J.scan(spark, path)
    if kind == "array":
        rows = J.elements(spark, parts, begins)
        if broken == "error" and not rows.where(_unsound("row")).isEmpty():
            raise ValueError(f"{path} has elements that are no JSON")
        return rows.select("ord", F.from_json("row", schema).alias("r")).select("ord", "r.*")
    if kind == "object":
        return unwrap(spark.read.text(path, wholetext=True), schema)
    if broken == "error":
        raise ValueError(f"{path} is no archive: {kind}")
    return none.select("ord", *[c for c in none.columns if c != "ord"])


def archive_state(spark: SparkSession, path: str) -> str:
    """missing, table, array, empty (an array without elements), object, other, blank or broken."""
    now = current(spark, path)
    if now is None or now != path:
        return "missing" if now is None else "table"
    parts, begins, kind = J.scan(spark, path)
    if kind != "array":
        return kind
    rows = J.elements(spark, parts, begins)
    if not rows.where(_unsound("row")).isEmpty():
        return "broken"
    bare = F.regexp_replace(F.concat_ws("", F.collect_list("value")), r"[\s\ufeff]+", "")
    return "empty" if rows.isEmpty() and parts.limit(2).agg(bare).first()[0] == "[]" else "array"


def _unsound(row: str):
    """A row that is no JSON object."""
    whole = F.from_json(F.col(row), "struct<_corrupt_record: string>", {"columnNameOfCorruptRecord": "_corrupt_record"})
    return whole.isNull() | whole["_corrupt_record"].isNotNull()


def unwrap(texts: DataFrame, schema: StructType, column: str = "value") -> DataFrame:
    """Rows of JSON documents: an array, {properties: []}, {items: []}, or a single object; ``ord`` is the place.

    A document is split into its elements' texts first, so one that is no object spoils no other.
    """
    bare = lambda x: F.regexp_replace(x, BLANKS, "")
    text = bare(F.col(column))
    elements = lambda x: F.from_json(x, "array<string>", {"mode": "PERMISSIVE"})
    whole = F.from_json(text, "struct<properties: string, items: string, _corrupt_record: string>", {"columnNameOfCorruptRecord": "_corrupt_record"})
    sound = whole["_corrupt_record"].isNull() & whole.isNotNull()
    inner = lambda name: F.when(F.startswith(bare(whole[name]), F.lit("[")), elements(whole[name]))
    # a present list wins over the object that holds it
    rows = F.when(F.startswith(text, F.lit("[")), elements(text)).when(F.startswith(text, F.lit("{")) & sound, F.coalesce(inner("properties"), inner("items"), F.array(text)))
    each = texts.select(F.posexplode(rows).alias("ord", "row")).where(F.startswith(bare(F.col("row")), F.lit("{")))
    return each.select(F.col("ord").cast("long").alias("ord"), F.from_json("row", schema).alias("r")).select("ord", "r.*")


def read_object(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """One JSON object as a row, or no row if the file is missing, broken or something else. It is one text, 2 GB at most."""
    if not exists(spark, path):
        return spark.createDataFrame([], schema)
    text = F.regexp_replace("value", BLANKS, "")
    x = spark.read.text(path, wholetext=True).select(text.alias("value")).where(F.startswith("value", F.lit("{")) & ~_unsound("value"))
    return x.select(F.from_json("value", schema).alias("r")).select("r.*")


def read_urls(spark: SparkSession, path: str, host: str) -> DataFrame:
    """(ord, url): the canonical addresses of a text file, comments and blanks left out, first of each."""
    lines = spark.read.text(path, wholetext=True).select(F.posexplode(F.split("value", "\r?\n")).alias("ord", "line"))
    kept = lines.select("ord", F.trim("line").alias("line")).where("line != '' and not startswith(line, '#')")
    named = kept.select("ord", F.coalesce(U.project_url("line", host), F.when(F.col("line").rlike("^https?://"), F.col("line"))).alias("url")).where("url is not null")
    return named.groupBy("url").agg(F.min("ord").alias("ord"))


def latest_path(path: str) -> str:
    return f"{path.rsplit('/', 1)[0]}/latest"


def stats_path(path: str) -> str:
    return f"{path.rsplit('/', 1)[0]}/run-stats"


def _pointer(path: str) -> str:
    return f"{path}/_current"


def pointed(spark: SparkSession, path: str) -> str | None:
    """What the pointer of ``path`` says, or None if there is none."""
    fs, p = _fs(spark, _pointer(path))
    if not fs.exists(p):
        return None
    with contextlib.closing(fs.open(p)) as f:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(f, "UTF-8").strip()


def point(spark: SparkSession, path: str, text: str) -> None:
    """Turn the pointer of ``path`` by one rename, so that readers see what it said before or what it says now."""
    fs, p = _fs(spark, path)
    jvm = spark._jvm
    note = jvm.org.apache.hadoop.fs.Path(f"{path}/_current.{uuid.uuid4().hex}.tmp")
    out = fs.create(note, True)
    out.write(bytearray(text.encode()))
    out.close()
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration()).rename(fs.makeQualified(note), fs.makeQualified(_fs(spark, _pointer(path))[1]), options)


def current(spark: SparkSession, path: str) -> str | None:
    """Where the rows of ``path`` are now: the version that it points to, or the path itself, or None if there is nothing."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return None
    if (name := pointed(spark, path)) is not None:
        return f"{path}/{name}"
    return None if fs.getFileStatus(p).isDirectory() and not fs.exists(_fs(spark, f"{path}/_SUCCESS")[1]) else path


def write_atomic(df: DataFrame, path: str, fmt: str = "json") -> None:
    """Write a new version below ``path`` and turn the pointer to it by one rename, so that readers see the old table or the new one.

    What a crash leaves half written is never pointed to; of the versions before, the last stays for those who still read it.
    """
    spark = df.sparkSession
    name, before = f"v-{uuid.uuid4().hex}", current(spark, path)
    writer = df.write.format(fmt)
    (writer.option("ignoreNullFields", "false") if fmt == "json" else writer).save(f"{path}/{name}")
    point(spark, path, name)
    fs, p = _fs(spark, path)
    kept = {name, (before or "").rsplit("/", 1)[-1]}
    for status in fs.listStatus(p):
        own = status.getPath().getName()
        if own.startswith("v-") and own not in kept:
            fs.delete(status.getPath(), True)


def write_jsonl(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def write_stats(counters: DataFrame, path: str, run_id: str, ts) -> None:
    """Append a run's counters (a row for each site, and the total) beside the archive, with the run and its time."""
    counters.withColumns({"runId": F.lit(run_id), "ts": F.lit(ts).cast("timestamp")}).write.mode("append").option("ignoreNullFields", "false").json(stats_path(path))


def append_errors(errors: DataFrame, path: str, run_id: str | None, ts) -> None:
    """Append (url, error, ts, runId) rows; the time is one for the whole run."""
    errors.select("url", "error", F.lit(ts).cast("timestamp").alias("ts"), F.lit(run_id).cast("string").alias("runId")).write.mode("append").json(path)


def find_slug(df: DataFrame, slug: str) -> DataFrame:
    """The first row of a slug, with its image addresses."""
    return df.where(F.col("slug") == slug).orderBy("ord").limit(1).withColumn("image_urls", F.transform("images", lambda x: x["url"]))


def tail(df: DataFrame, order: str = "ord", most: int = 80) -> DataFrame:
    return df.orderBy(F.desc(order)).limit(most)
