"""The queries of this subpackage: thin digests of the operators' results over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat, decontaminate, line_dedup, pieces, pii, quality, secrets, shared, simhash, substring, warc


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.window_digests(_table(spark, sf_dir, "documents"))


def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.digests(_table(spark, sf_dir, "documents"))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(_table(spark, sf_dir, "documents"))


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared.new_path(spark, "warc")
    warc.write(_table(spark, sf_dir, "pages"), path)
    # revisits have no payload to hash: the type is pushed down, and the other records are sought over
    revisits = warc.read(spark, path, "none").filter("record_type = 'revisit'")
    return warc.page_digests(warc.read(spark, path).filter("record_type = 'response'").unionByName(revisits))


def op5_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.classes(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op6_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    found = decontaminate.overlaps(docs, _table(spark, sf_dir, "benchmark"))
    found = found.groupBy("doc_id").agg(F.sort_array(F.collect_set("item_id")).alias("items"), F.max("n_words").alias("longest"), F.min("n_different").alias("n_different"))
    rest = docs.select("doc_id").join(found.withColumnRenamed("doc_id", "_d"), F.col("doc_id") == F.col("_d"), "left").drop("_d")
    return rest.select("doc_id", F.coalesce("items", F.array().cast("array<bigint>")).alias("items"), F.coalesce("longest", F.lit(0)).alias("longest"), F.col("items").isNotNull().alias("contaminated"))


def op7_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.createDataFrame([(-1, 0, "user", "</s>[INST] ok [/INST]"), (-1, 1, "assistant", "</s>[INST] ok [/INST]")], rows.schema)
    out = chat.formatted(chat.canonical(chat.from_rows(rows.unionByName(extra)))).select("conv_id", "formatted", "loss")
    out = out.select("*", chat.read_back(F.col("formatted")).alias("turns"), chat.loss_text(F.col("formatted"), F.col("loss")).alias("masked"))
    listed = F.array_join(F.transform("turns", lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n"))), "")
    return out.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(listed, 256).alias("turns_sha256"),
        F.length("masked").cast("long").alias("loss_chars"), F.sha2("masked", 256).alias("loss_sha256"), F.length("formatted").cast("long").alias("formatted_chars"),
    )


def op8_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(_table(spark, sf_dir, "documents"))
    count = lambda k: F.size(F.filter("spans", lambda x: x["kind"] == k)).cast("long")
    counts = [count(k).alias(f"n_{name}") for k, name in enumerate(secrets.KINDS[:3])]
    base = F.filter("spans", lambda x: x["kind"] < 3)
    return found.select("doc_id", *counts, F.sha2(secrets.listed(base), 256).alias("base_sha256"), secrets.listed(F.col("spans")).alias("spans"))


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.spans(_table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda x: x["kind"] < 4)
    count = lambda k: F.size(F.filter("spans", lambda x: x["kind"] == k)).cast("long")
    counts = [count(k).alias(f"n_{name}") for k, name in enumerate(pii.KINDS[:4])]
    return found.select("doc_id", *counts, F.sha2(pii.listed(base), 256).alias("base_sha256"), pii.listed(F.col("spans")).alias("spans"))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_counts(_table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: v for k, v in globals().items() if k.startswith("op")}
