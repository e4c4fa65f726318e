"""Reading and writing the tables of a corpus."""

from __future__ import annotations

import math
import os
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.ids import path_to_id
from ..operators.metadata import METADATA, RECORD, flat


@dataclass(frozen=True)
class Settings:
    """Where a corpus is. Resolved when asked for, never at import: an argument, else PAPERLAKE_DATA, else a folder
    below the working one."""

    root: str

    @classmethod
    def resolve(cls, root: str | None = None) -> Settings:
        return cls(root or os.environ.get("PAPERLAKE_DATA") or f"{os.getcwd()}/paperlake-data")

    def at(self, name: str) -> str:
        return f"{self.root}/{name}"


def metadata(spark: SparkSession, path: str) -> DataFrame:
    """JSON lines, gzip or not. A gzip file is one task's work, so what is read is dealt out again."""
    rows = spark.read.schema(METADATA).json(path)
    return rows.repartition(spark.sparkContext.defaultParallelism) if path.endswith(".gz") else rows


def newest(spark: SparkSession, pattern: str) -> str | None:
    """The last path, in the order of names, that a pattern matches."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(pattern)
    found = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(path)
    return max((str(x.getPath()) for x in found or []), default=None)


def harvested_xml(spark: SparkSession, path: str) -> DataFrame:
    """Metadata of XML files, record by record; files are split at records."""
    return spark.read.format("xml").option("rowTag", "arXivRaw").schema(RECORD).load(path).select(*flat())


def manifest_xml(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("xml").option("rowTag", "file").schema("filename STRING, md5sum STRING, first_item STRING, last_item STRING").load(path)


def fulltext(spark: SparkSession, folder: str, glob: str = "*txt*") -> DataFrame:
    """id, text of a tree of text files, one an article."""
    files = spark.read.text(folder, wholetext=True, pathGlobFilter=glob, recursiveFileLookup=True)
    return files.select(path_to_id(F.input_file_name()).alias("id"), F.col("value").alias("text"))


def write_fulltext(texts: DataFrame, path: str, parts: int = 16) -> None:
    """Parquet by year and month of the identifier, so that readers of some months read these only; a month is written by
    up to `parts` tasks."""
    month = F.regexp_extract("id", r"(?:^|/)(\d{4})", 1)
    texts.withColumn("yymm", month).repartition("yymm", F.pmod(F.xxhash64("id"), F.lit(parts))).write.mode("append").partitionBy("yymm").parquet(path)


def with_text(articles: DataFrame, texts: DataFrame, limit: int | None = None) -> DataFrame:
    """Metadata rows of articles whose text is there, in the order of ids; at most `limit` of them if it is given."""
    out = articles.join(texts.select("id"), "id", "left_semi")
    return out.orderBy("id").limit(limit) if limit is not None else out


def uniform(seed: int) -> Column:
    """A number from 0 to 1, under it, from a hash of the id and the seed: the same in every run and for every size."""
    return F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string"))), 1, 12), 16, 10).cast("double") / float(1 << 48)


def shuffled_split(rows: DataFrame, share: float, seed: int = 0) -> DataFrame:
    """rows with `train`: about that share, chosen by a hash of the id."""
    return rows.withColumn("train", uniform(seed) < share)


def sampled(rows: DataFrame, share: float, seed: int = 0, most: int = 12) -> DataFrame:
    """A sample with replacement: each row as often as a Poisson variable of mean `share` says (at most `most` times),
    whose value is read off a hash of the id."""
    total, p, times = 0.0, math.exp(-share), F.lit(0)
    for k in range(most):
        total += p
        p *= share / (k + 1)
        times = times + F.when(uniform(seed) >= total, 1).otherwise(0)
    return rows.withColumn("__times", times).where("__times > 0").withColumn("__times", F.explode(F.sequence(F.lit(1), F.col("__times")))).drop("__times")


def archives(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").load(path)


def integers(spark: SparkSession, path: str) -> DataFrame:
    """One integer a line."""
    return spark.read.text(path).select(F.trim("value").cast("int").alias("i"))


def padded_rows(rows: DataFrame, dim: int) -> DataFrame:
    """i, features: rows for every index from the least to the greatest, zeros where there was none."""
    a, b = rows.agg(F.min("i"), F.max("i")).first()
    every = rows.sparkSession.range(a or 0, (b or 0) + 1 if b is not None else 0).select(F.col("id").cast("int").alias("i"))
    return every.join(rows, "i", "left").select("i", F.coalesce("features", F.array_repeat(F.lit(0.0), dim)).alias("features"))
