"""The queries of this folder, by name, and the SQL that DuckDB compares them with."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers

from . import bpe, chat, hilbert, jaccard, mixing, multiindex, perplexity, phrases, repeats, rolling, search, toxicity, warc
from .common import read, shared_dir


def op1_perplexity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return perplexity.quality(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    out = toxicity.classify(docs, read(spark, sf_dir, "labels"), into="score", keep_text=False)
    return out.select("doc_id", toxicity.held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), F.col("score_threshold").alias("threshold"), F.col("score_flagged").alias("flagged"))


def op3_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.remove(read(spark, sf_dir, "documents"))


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode(read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


def op5_multiindex(spark: SparkSession, sf_dir: str) -> DataFrame:
    return multiindex.dedup(read(spark, sf_dir, "embeddings"))


def op6_bm25(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return search.top(docs, docs.where("doc_id % 20 = 0").select(F.col("doc_id").alias("query_id"), "text"))


def op7_preferences(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = chat.preference(chat.neighbours(read(spark, sf_dir, "conversations")))
    trained = lambda side: F.aggregate(f"{side}_mask", F.lit(0), lambda a, m: a + F.when(m["train"], m["end"] - m["start"]).otherwise(0)).cast("long").alias(f"{side}_trained")
    mask = lambda side: F.array_join(F.transform(f"{side}_mask", lambda m: F.concat(m["start"].cast("string"), F.lit("-"), m["end"].cast("string"), F.lit(":"), m["train"].cast("string"))), ",").alias(f"{side}_mask")
    return out.select("pair_id", "chosen_id", "rejected_id", "common_turns", "prompt", "chosen_completion", "rejected_completion", mask("chosen"), mask("rejected"), trained("chosen"), trained("rejected"))


def op8_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(read(spark, sf_dir, "documents"))


def op9_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.join(read(spark, sf_dir, "documents"))


def op10_hilbert(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = hilbert.shard(read(spark, sf_dir, "documents"))
    return placed.withColumn("law", F.lit("rows")).withColumn("grown_shard", F.lit(None).cast("int")).select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard", "hilbert")


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(read(spark, sf_dir, "documents"))


def op12_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{shared_dir(spark)}/paperlake/warc-{uuid.uuid4().hex}"
    warc.write(read(spark, sf_dir, "pages"), path)
    found = warc.records(spark, path, payload=False)
    return found.select(warc.page_key(F.col("record_id")).alias("page_id"), "payload_bytes", "payload_digest", F.col("kind").alias("record_type"), warc.page_key(F.col("refers_to")).alias("refers_to"))


def op13_rolling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rolling.rolling(read(spark, sf_dir, "clicks"), "click_id", "kind", "ts", "value")


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_perplexity": op1_perplexity,
    "op2_toxicity": op2_toxicity,
    "op3_suffixes": op3_suffixes,
    "op4_bpe": op4_bpe,
    "op5_multiindex": op5_multiindex,
    "op6_bm25": op6_bm25,
    "op7_preferences": op7_preferences,
    "op8_mix": op8_mix,
    "op9_jaccard": op9_jaccard,
    "op10_hilbert": op10_hilbert,
    "op11_collocations": op11_collocations,
    "op12_warc": op12_warc,
    "op13_rolling": op13_rolling,
    "pipeline": pipeline,
}

ORACLES: dict[str, str] = {"op8_mix": mixing.SQL, "op7_preferences": chat.SQL, "op11_collocations": phrases.SQL, "op12_warc": warc.SQL, "op13_rolling": rolling.SQL}
