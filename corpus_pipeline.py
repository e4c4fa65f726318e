"""A training corpus from the table `documents`, in stages that are each written and read again.

Counted with paperlake.llm: it needs that folder and says so when it is imported without.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paperlake.llm import bpe, jaccard, mixing, repeats, toxicity
from paperlake.llm.common import read, save


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score is under the threshold of their language. Null and empty texts have one score, that of no
    word; repeated rows are judged alike; an empty table stays empty."""
    return toxicity.keep_clean(docs, read(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each group linked at a Jaccard similarity of 0.8 of five-word runs. Null
    and empty texts and rows without id are in no group and stay; of rows that agree in id and text one stays (see
    jaccard.keep_one); an empty table stays empty."""
    return jaccard.keep_one(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the bytes of 200-byte strings that also start elsewhere; n_chars is counted again. All rows stay,
    those whose whole text repeats with an empty text; a null text stays null, an empty table empty."""
    out = repeats.remove(docs, keep_text=True)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them. A null source is a source of its own; null and empty texts
    have size 0 and follow their source's whole epochs; repeated rows are taken alike; an empty table stays empty."""
    return mixing.mixed(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, and digests of ids and of the bytes decoded from them: one row a row of docs. A null or
    empty text has no ids; an empty table gives none."""
    return bpe.encode(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN, keep_ids=True)


STAGES = [
    ("toxicity", drop_toxic),
    ("near duplicates", drop_near_duplicates),
    ("repeated strings", cut_repeats),
    ("mix", mix_sources),
    ("encode", encode),
]

#: The first three stages and the last can't be written as SQL; tests/llm compares the pipeline with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = save(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
