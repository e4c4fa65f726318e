"""Bulk archives to text: members with their content, extraction jobs that go on where they stopped."""

from __future__ import annotations

import io
import tarfile
from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.ids import path_to_id
from ..sources import tars
from . import extraction, manifest
from .shared import parts


def packed(files: DataFrame) -> DataFrame:
    """tar, content: an archive for every value of tar, its members in the order of names. files: tar, member, content."""

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        out = io.BytesIO()
        with tarfile.open(fileobj=out, mode="w") as t:
            for name, content in sorted(zip(frame["member"], frame["content"], strict=True)):
                info = tarfile.TarInfo(name)
                info.size = len(content)
                t.addfile(info, io.BytesIO(content))
        return pd.DataFrame({"tar": [frame["tar"].iloc[0]], "content": [out.getvalue()]})

    return files.groupBy("tar").applyInPandas(run, "tar string, content binary")


def contents(archives: DataFrame, wanted: DataFrame | None = None, at_once: int = 64 << 20) -> DataFrame:
    """tar, member, content, error: the members of archives (tar, content), all or the wanted ones (tar, pdfs).

    Members leave as they are read, `at_once` bytes at a time, so a task holds its archives and these; archives are dealt
    out in as many parts as their files ask for, so a task's share doesn't grow with the table. An archive that can't be
    read further gives the members before, and a row with the error and no member. Archives of which nothing is wanted
    aren't opened.
    """
    rows = archives.select("tar", "content")
    rows = rows.withColumn("pdfs", F.lit(None).cast("array<string>")) if wanted is None else rows.join(wanted.select("tar", "pdfs"), "tar")

    def batch(held: list) -> pa.RecordBatch:
        kinds = [pa.string(), pa.string(), pa.binary(), pa.string()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held, strict=True), kinds, strict=True)], names=["tar", "member", "content", "error"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for tar, content, pdfs in zip(*b.columns, strict=True):
                tar, only = tar.as_py(), None if pdfs.as_py() is None else set(pdfs.as_py())
                held, size = [], 0
                try:
                    with tarfile.open(fileobj=io.BytesIO(content.as_py())) as t:
                        for m in t:
                            if m.isfile() and (only is None or m.name in only):
                                held.append((tar, m.name, t.extractfile(m).read(), None))
                                size += m.size
                                if size > at_once:
                                    yield batch(held)
                                    held, size = [], 0
                except (tarfile.TarError, OSError, EOFError) as e:
                    held.append((tar, None, None, f"{type(e).__name__}: {e}"))
                if held:
                    yield batch(held)

    dealt = rows.select("tar", "content", "pdfs").repartition(parts(archives), "tar")
    return dealt.mapInArrow(run, "tar string, member string, content binary, error string")


def texts(archives: DataFrame, extractors: list[extraction.Extractor], wanted: DataFrame | None = None, **settings) -> DataFrame:
    """id, text, error of the members of archives (see contents and extraction.extract). Members are dealt out again
    before they are extracted, so a large archive is many tasks' work."""
    return extracted(contents(archives, wanted), extractors, **settings)


def extracted(members: DataFrame, extractors: list[extraction.Extractor], **settings) -> DataFrame:
    """id, text, error of members (member, content) of archives."""
    m = members.where("member IS NOT NULL").select(path_to_id(F.col("member")).alias("id"), "content")
    return extraction.extract(m.repartition("id"), extractors, **settings)


def pending(index: DataFrame, done: DataFrame) -> DataFrame:
    """tar, pdfs: what is still to be extracted, archives with the largest backlog first. index: tar, pdf; done: id."""
    missing = manifest.missing(index, index.join(done, path_to_id(F.col("pdf")) == F.col("id"), "left_semi").select("pdf"))
    return missing.join(manifest.rerun_order(missing).select("tar", "position"), "tar").orderBy("position").select("tar", "pdfs")


def process(archives: DataFrame, index: DataFrame, path: str, extractors: list[extraction.Extractor], **settings) -> int:
    """Extracts what isn't in the table at `path` yet and appends id, text, error to it; returns how many rows it has
    added. Run again after a failure or with more archives, it does the rest; files that failed are tried again only
    after their rows are removed."""
    return _append(archives.sparkSession, index, path, lambda wanted: texts(archives, extractors, wanted, **settings))


def process_parts(members: DataFrame, path: str, extractors: list[extraction.Extractor], at_once: int = 64 << 20, **settings) -> int:
    """The same for archives of which only an index was read (see tars.members): what isn't done yet is read by byte
    ranges, many tasks an archive, and no archive is held whole."""
    name = F.substring_index("tar", "/", -1).alias("tar")
    index = members.where("member IS NOT NULL").select(name, F.col("member").alias("pdf"))
    return _append(members.sparkSession, index, path, lambda wanted: extracted(tars.contents(members, wanted, at_once), extractors, **settings))


def _append(spark: SparkSession, index: DataFrame, path: str, rows: Callable[[DataFrame], DataFrame]) -> int:
    done = spark.read.parquet(path).select("id") if exists(spark, path) else spark.createDataFrame([], "id string")
    before = done.count()
    rows(pending(index, done)).write.mode("append").parquet(path)
    return spark.read.parquet(path).count() - before


def exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)
