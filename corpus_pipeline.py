"""The corpus pipeline: five operators of ``tracemill.llm`` one after the other, each over all that its predecessor kept.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as
Parquet and read again as the next stage's documents.  All stages but the last return
the columns of documents:

1. quality rules: documents beyond the compression bands or the base rules go;
2. line dedup: lines that many documents share stay in one of them;
3. SimHash near-dedup: one document of each class of near copies (five words, similarity 0.8 or more) stays;
4. benchmark decontamination: documents that overlap a benchmark item go;
5. SentencePiece: the ids of each document (doc_id, n_tokens, ids).

SQL has neither zstandard nor SentencePiece, so there is no ORACLE_SQL; the stages
are tested against brute force.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracemill.llm import decontaminate, line_dedup, near_copies, pieces, quality, shared


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs)


def line_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return line_dedup.drop_lines(docs)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_copies.keep_one(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pieces.encode(docs).select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids")


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_deduplication),
    ("simhash near-dedup", simhash_near_dedup),
    ("benchmark decontamination", benchmark_decontamination),
    ("sentencepiece", sentencepiece),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; between stages the rows are a table in the shared folder, and what led to it is deleted."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    begun = shared.mark()
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            path = shared.new_path(spark, f"stage-{k}")
            docs.write.option("compression", "zstd").parquet(path)
            docs = spark.read.schema(docs.schema).parquet(path)
            shared.release(spark, begun, path)
    return docs
