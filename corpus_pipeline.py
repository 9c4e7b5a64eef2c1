"""The corpus pipeline: documents to packed training sequences.

Every stage takes (spark, docs, sf_dir) and works on all rows that its predecessor kept. Its result is
written as Parquet and read again before the next stage starts, so tables that earlier stages staged
in the shared folder can go then.

Defined cases are those of the operators; a stage with no rows gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerloom.llm import common, exact_dedup, mixing, near_dedup, packing, toxicity


def _alone(spark: SparkSession, work) -> DataFrame:
    """Run a stage whose predecessor's result is written: what that staged goes first. Tables of other callers stay."""
    common.sweep(spark, "pipeline")
    common.release(spark)
    with common.owner("pipeline"):
        return work()


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the chain model predicts to be toxic go."""
    return _alone(spark, lambda: toxicity.clean_only(docs, common.table(spark, sf_dir, "labels")))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One of each group of equal texts stays."""
    return _alone(spark, lambda: exact_dedup.kept_only(docs))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One of each group of near-duplicates stays (five-word shingles, similarity 0.8)."""
    return _alone(spark, lambda: near_dedup.kept_only(docs))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return _alone(spark, lambda: mixing.mixed(docs))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences."""
    return _alone(spark, lambda: packing.pack(docs.select("doc_id", "text")))


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: Fitting a chain model, MinHash and packing along a curve have no SQL form; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``; each result is written to the shared folder and read again."""
    docs = common.table(spark, sf_dir, "documents")
    before = None
    for name, stage in STAGES:
        path = f"{common.shared_dir(spark)}/pipeline-{name}-{spark.sparkContext.applicationId}-{id(docs)}"
        stage(spark, docs, sf_dir).write.mode("overwrite").parquet(path)
        docs = spark.read.parquet(path)
        if before:
            common.delete(spark, before)
        before = path
    return docs
