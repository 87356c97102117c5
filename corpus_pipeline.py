"""Corpus pipeline: toxicity, quality, near duplicates, benchmark decontamination, packing.

Every stage is a function of (spark, docs, sf_dir) and works on all documents that the one before kept; all but the last
return the columns of documents. Rows with a null doc_id are judged by the classifiers and kept by the other filters. Repeated rows stay repeated until the near-duplicate stage, which keeps one row of each group.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stayspark.llm import decontamination, jaccard, packing, quality, toxicity
from stayspark.llm.common import materialise, table

ORACLE_SQL = None
COPY, ROW = "corpus pipeline: id", "corpus pipeline: row"  # names that no table is likely to have


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the string-kernel machine does not call toxic."""
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the subword classifier does not reject."""
    return quality.drop_low(docs, table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates: that of the least id. Of rows that share an id, whatever their words, one stays
    (the longest text, then the least text, source and language); rows with a null id all stay."""
    groups = jaccard.near_duplicates(docs)
    copies = materialise(groups.where(F.col("component_id") != F.col("doc_id")).select(F.col("doc_id").alias(COPY)).distinct(), "copies")
    kept = docs.join(copies, docs["doc_id"] == copies[COPY], "left_anti")
    several = materialise(kept.where(F.col("doc_id").isNotNull()).groupBy("doc_id").count().where("count > 1").select(F.col("doc_id").alias(COPY)), "repeated")
    if several.isEmpty():
        return kept
    # One row of each repeated id by an aggregate that combines before the shuffle; all columns ride along.
    order = F.struct((-F.coalesce(F.length("text"), F.lit(-1))).alias("a"), *[F.coalesce(F.col(c), F.lit("")) for c in ("text", "source", "lang") if c in docs.columns])
    repeated = kept.join(several, kept["doc_id"] == several[COPY], "left_semi")
    one = repeated.groupBy(F.col("doc_id").alias(COPY)).agg(F.min_by(F.struct(*docs.columns), order).alias(ROW)).select(f"{ROW}.*")
    return kept.join(several, kept["doc_id"] == several[COPY], "left_anti").unionByName(one)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    found = decontamination.contaminated(docs, table(spark, sf_dir, "benchmark")).select(F.col("doc_id").alias(COPY)).distinct()
    return docs.join(found, docs["doc_id"] == found[COPY], "left_anti")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Placed pieces of the documents that are left."""
    return packing.packed(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("quality", drop_low_quality),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_benchmark),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written as Parquet into the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
