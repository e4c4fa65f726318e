"""Bulk archives: manifests, members, completeness and checksums."""

from __future__ import annotations

import io
import tarfile

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from .shared import positions

FIELDS = ("filename", "md5sum", "first_item", "last_item")


def parse(lines: DataFrame, column: str = "xml") -> DataFrame:
    """One row a file of a manifest: the four fields in use."""
    kind = "`file` ARRAY<STRUCT<" + ", ".join(f"`{n}`: STRING" for n in FIELDS) + ">>"
    return lines.select(F.explode(F.from_xml(column, kind)["file"]).alias("f")).select("f.*")


def wanted_by_tar(ids: DataFrame, index: DataFrame) -> DataFrame:
    """tar, pdfs: members to fetch, by archive. ids: pdf; index: tar, pdf (of a member in several archives the last)."""
    last = index.groupBy("pdf").agg(F.max("tar").alias("tar"))
    return ids.select("pdf").distinct().join(last, "pdf").groupBy("tar").agg(F.array_sort(F.collect_list("pdf")).alias("pdfs"))


def missing(index: DataFrame, done: DataFrame) -> DataFrame:
    """tar, pdfs without text; archives that lack nothing are left out."""
    return index.join(done.select("pdf"), "pdf", "left_anti").groupBy("tar").agg(F.array_sort(F.collect_set("pdf")).alias("pdfs"))


def rerun_order(missing_by_tar: DataFrame) -> DataFrame:
    """tar, backlog, position: larger backlogs first, of equal ones the later archive first."""
    return positions(missing_by_tar.select("tar", F.size("pdfs").alias("backlog")), F.desc("backlog"), F.desc("tar"))


def processed(manifest: DataFrame, done: DataFrame) -> DataFrame:
    """tar, processed: an archive counts as done if its first and its last member are."""
    d = done.select("pdf", F.lit(True).alias("ok")).distinct()
    m = manifest.join(d.select(F.col("pdf").alias("first_item"), F.col("ok").alias("a")), "first_item", "left").join(d.select(F.col("pdf").alias("last_item"), F.col("ok").alias("b")), "last_item", "left")
    return m.select("tar", F.expr("a IS NOT NULL AND b IS NOT NULL").alias("processed"))


def checksum_mismatches(files: DataFrame, manifest: DataFrame) -> DataFrame:
    """Names of files whose content has another md5 than the manifest says. files: name, content."""
    return files.select("name", F.md5("content").alias("own")).join(manifest.select("name", "md5sum"), "name").where("own <> md5sum").select("name")


@F.udtf(returnType=StructType().add("member", StringType()))
class TarMembers:
    """Names of the PDF members of a tar archive given as bytes; use with a lateral join over binaryFile rows."""

    def eval(self, content: bytes):
        if content is not None:
            with tarfile.open(fileobj=io.BytesIO(content)) as t:
                for m in t:
                    if m.name.endswith(".pdf"):
                        yield (m.name,)


def inventory(archives: DataFrame) -> DataFrame:
    """tar, pdf of archives read by spark.read.format("binaryFile")."""
    return archives.select(F.substring_index("path", "/", -1).alias("tar"), "content").lateralJoin(TarMembers(F.col("content").outer())).select("tar", F.col("member").alias("pdf"))
