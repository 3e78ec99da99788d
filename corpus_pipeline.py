"""From raw documents to packed training sequences, in five stages.

Each stage works on all rows its predecessor kept and returns them with the
columns of ``documents``; the last one returns the packed pieces.  ``run``
writes each result as Parquet to the shared folder and reads it back, so a
lost executor never reaches behind the stage at work.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.llm import best_fit, content_sort, icws, leak_simhash, toxic_kernel
from larder.llm.common import stored, table
from larder.llm.encode import tokenizer_path


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: documents predicted toxic go."""
    return toxic_kernel.without_toxic(docs, table(spark, sf_dir, "labels"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: of equal texts the row with the largest doc_id stays."""
    return content_sort.distinct_contents(docs, keep="max")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9: one document of each class of near copies stays."""
    return icws.one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7: documents that hold a benchmark item go."""
    return leak_simhash.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1: the pieces of all remaining documents, placed in sequences."""
    pieces = best_fit.token_pieces(docs, tokenizer_path("byte_bpe_50k.json"))
    return best_fit.pack(pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


STAGES = [("toxicity", toxicity), ("exact_dedup", exact_dedup), ("near_dedup", near_dedup),
          ("decontamination", decontamination), ("packing", packing)]

#: The toxicity and near-duplicate stages have no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
