"""Article metadata: shredding harvested XML, hashing, checking, merging."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RECORD = (
    "`id` STRING, `submitter` STRING, `authors` STRING, `title` STRING, `comments` STRING, `journal-ref` STRING, `doi` STRING, "
    "`abstract` STRING, `report-no` STRING, `categories` ARRAY<STRING>, `version` ARRAY<STRUCT<`_version`: STRING, `date`: STRING>>"
)
METADATA = (
    "id STRING, submitter STRING, authors STRING, title STRING, comments STRING, journal_ref STRING, doi STRING, abstract STRING, "
    "report_no STRING, categories ARRAY<STRING>, versions ARRAY<STRING>, versions_dates ARRAY<STRING>"
)
PAGE = f"`ListRecords` STRUCT<`record`: ARRAY<STRUCT<`metadata`: STRUCT<`arXivRaw`: STRUCT<{RECORD.replace('` ', '`: ')}>>>>, `resumptionToken`: STRING>, `error` STRING"


def flat(r: str = "") -> list[Column]:
    """The twelve metadata fields of a shredded record."""
    c = lambda n: F.col(f"{r}`{n}`")
    many = lambda x: F.coalesce(x, F.array().cast("array<string>"))
    plain = [c(n).alias(n) for n in ("id", "submitter", "authors", "title", "comments")]
    return [*plain, c("journal-ref").alias("journal_ref"), c("doi").alias("doi"), c("abstract").alias("abstract"), c("report-no").alias("report_no"), many(c("categories")).alias("categories"), many(F.transform(c("version"), lambda v: v["_version"])).alias("versions"), many(F.transform(c("version"), lambda v: v["date"])).alias("versions_dates")]


def records(pages: DataFrame, column: str = "xml") -> DataFrame:
    """One row a record of harvested pages. A page that carries an error fails the query."""
    shredded = pages.select(F.from_xml(column, PAGE).alias("p"))
    listed = F.when(F.col("p.error").isNotNull(), F.raise_error(F.concat(F.lit("harvest error: "), F.col("p.error")))).otherwise(F.col("p.ListRecords.record"))
    return shredded.select(F.explode(listed).alias("r")).select(*flat("r.metadata.arXivRaw."))


def tokens(pages: DataFrame, column: str = "xml") -> DataFrame:
    """Each page's resumption token; null: the last page."""
    return pages.select(F.nullif(F.from_xml(column, PAGE)["ListRecords"]["resumptionToken"], F.lit("")).alias("token"))


def hash_abstracts(metadata: DataFrame) -> DataFrame:
    return metadata.withColumn("abstract_md5", F.md5("abstract")).drop("abstract")


def hashes_valid(metadata: DataFrame, hashed: DataFrame) -> DataFrame:
    """One row: whether every abstract has the hash on record, by id; true of nothing at all."""
    both = metadata.select("id", F.md5("abstract").alias("own")).join(hashed.select("id", "abstract_md5"), "id")
    return both.agg(F.coalesce(F.bool_and(F.col("own").eqNullSafe(F.col("abstract_md5"))), F.lit(True)).alias("valid"))


def latest(rows: DataFrame, key: str, order: str) -> DataFrame:
    """One row a key, that of the greatest order: a replayed or resumed load adds nothing."""
    names = [c for c in rows.columns if c != key]
    return rows.groupBy(key).agg(F.max_by(F.struct(*names), F.struct(order, *[n for n in names if n != order])).alias("r")).select(key, "r.*")


def slice_by(metadata: DataFrame, keep: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """A user's predicate over the whole table."""
    return metadata.transform(keep)
