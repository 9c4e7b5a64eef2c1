"""Rewrite of image addresses to content-addressed object keys, without any transfer."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions import arrays as A
from ledgerloom.functions import urls as U
from ledgerloom.operators import identity as I


def folder(df: DataFrame):
    slug = F.lower(F.trim(F.coalesce(F.col("slug"), F.lit("")))) if "slug" in df.columns else F.lit("")
    key = F.coalesce(F.nullif(I.match_key(), F.lit("")), F.nullif(slug, F.lit("")))
    return F.when(key.isNotNull(), U.sanitize_segment(F.replace(key, F.lit("|"), F.lit("-")), 120)).otherwise(U.sanitize_segment(F.coalesce(F.col("projectName"), F.lit("property"))))


def occurrences(df: DataFrame, bucket: str, region: str) -> DataFrame:
    """(ord, pos, url, type, own, folder): every image with a url."""
    flat = df.withColumn("_folder", folder(df)).select("ord", F.col("_folder").alias("folder"), F.posexplode("images").alias("pos", "image"))
    return flat.select("ord", "pos", "folder", F.trim("image.url").alias("url"), F.col("image.type").alias("type")).where("url != ''").withColumn("own", U.in_bucket("url", bucket, region))


def first_mappings(seen: DataFrame) -> DataFrame:
    """(url, folder): the folder of the first row that shows a foreign image; a picture that all rows share is one group, aggregated in part."""
    return seen.where("not own").groupBy("url").agg(F.min_by("folder", F.struct("ord", "pos")).alias("folder"))


def rewrite(df: DataFrame, bucket: str, region: str) -> DataFrame:
    """``df`` with images at their public object addresses; the first mapping of an address serves all rows."""
    seen = occurrences(df, bucket, region)
    first = first_mappings(seen).select("url", U.public_url(bucket, region, U.object_key("folder", "url")).alias("target"))
    moved = seen.join(first, "url", "left").select("ord", "pos", F.coalesce("target", "url").alias("url"), "type")
    again = moved.groupBy("ord").agg(F.sort_array(F.collect_list(F.struct("pos", "url", "type"))).alias("i"))
    images = A.images(F.transform("i", lambda x: F.struct(x["url"].alias("url"), x["type"].alias("type"))))
    return df.drop("images").join(again.select("ord", images.alias("images")), "ord", "left").withColumn("images", F.coalesce("images", F.array().cast(f"array<{A.IMAGE}>"))).select(*df.columns)


def counters(df: DataFrame, bucket: str, region: str) -> DataFrame:
    """Rows with images, images, and of these: first of their address, own already, met before."""
    seen = occurrences(df, bucket, region)
    rows = seen.groupBy("ord").agg(F.count(F.lit(1)).alias("n"), F.count_if("own").alias("own")).agg(F.count(F.lit(1)).alias("records_touched"), F.coalesce(F.sum("n"), F.lit(0)).alias("urls_seen"), F.coalesce(F.sum("own"), F.lit(0)).alias("urls_skipped"))
    new = first_mappings(seen).agg(F.count(F.lit(1)).alias("urls_uploaded"))
    both = rows.unionByName(new, allowMissingColumns=True).agg(*[F.sum(c).alias(c) for c in (*rows.columns, "urls_uploaded")])
    return both.select("records_touched", "urls_seen", "urls_uploaded", "urls_skipped", (F.col("urls_seen") - F.col("urls_skipped") - F.col("urls_uploaded")).alias("urls_reused"))


def image_counts(df: DataFrame, literal: str) -> DataFrame:
    return df.agg(F.count_if(F.size("images") > 0).alias("rows_with_images"), F.coalesce(F.sum(F.size(F.filter("images", lambda x: x["url"].contains(literal)))), F.lit(0)).alias("urls_with_literal"))
