"""The newest version of every article, kept as state of a stream; and citations of a growing tree of texts."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery
from pyspark.sql.types import StructType

from ..operators import citations
from ..operators.metadata import METADATA, latest, records

STORE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}
VALUES = METADATA.removeprefix("id STRING, ")


def rank(value) -> tuple:
    """A key that orders values as Spark does: null first, strings by their bytes, lists item by item."""
    if value is None:
        return (0,)
    return (1, value.encode()) if isinstance(value, str) else (1, tuple(rank(v) for v in value))


class Newest(StatefulProcessor):
    """Keeps, for an article, its record of the highest versions, and passes a record on if it is above what was kept."""

    def __init__(self, kept: StructType, expire_after: int | None):
        self.schema, self.names, self.expire_after = kept, kept.names, expire_after

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.kept = handle.getValueState("kept", self.schema, self.expire_after)

    def place(self, values: dict) -> tuple:
        return rank(values["versions"]), *(rank(values[n]) for n in self.names if n != "versions")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        before = dict(zip(self.names, self.kept.get(), strict=True)) if self.kept.exists() else None
        best = before
        for r in rows:
            values = {n: r[n] for n in self.names}
            if best is None or self.place(values) > self.place(best):
                best = values
        if best is not None and best is not before:
            self.kept.update(tuple(best[n] for n in self.names))
            yield Row(id=key[0], **best)

    def close(self) -> None:
        pass


def newest_versions(pages: DataFrame, expire_after: int | None = None) -> DataFrame:
    """A stream of the records in a stream of pages that are above all earlier ones of their article, by versions, then by
    the other fields.

    Pages may be repeated or out of order: what is old adds nothing, and latest() of all rows that came out is latest() of
    all records. The state has one record an article, in RocksDB, partitioned by article; `expire_after`: milliseconds
    after its last change until an article is forgotten (if it comes again it is passed on once more); such a query has no
    end of its own, so it takes a trigger by time. Records without id are left out.
    """
    spark = pages.sparkSession
    for name, value in STORE.items():
        spark.conf.set(name, value)
    rows = records(pages).where("id IS NOT NULL")
    return rows.groupBy("id").transformWithState(Newest(StructType.fromDDL(VALUES), expire_after), StructType.fromDDL(METADATA), "Append", "None" if expire_after is None else "ProcessingTime")


def keep_versions(pages: DataFrame, path: str, checkpoint: str, expire_after: int | None = None, trigger: dict | None = None) -> StreamingQuery:
    """Appends the records that newest_versions() passes on to Parquet, by year and month of the identifier, each once
    (the checkpoint and the sink's log agree on what is written)."""
    month = F.coalesce(F.nullif(F.regexp_extract("id", r"(?:^|/)(\d{4})", 1), F.lit("")), F.lit("none"))
    out = newest_versions(pages, expire_after).withColumn("yymm", month).writeStream.format("parquet").partitionBy("yymm")
    return out.option("path", path).option("checkpointLocation", checkpoint).outputMode("append").trigger(**(trigger or {"availableNow": True})).start()


def articles(spark: SparkSession, path: str) -> DataFrame:
    """The newest record of every article that keep_versions() has written."""
    return latest(spark.read.schema(f"{METADATA}, yymm STRING").parquet(path).drop("yymm"), "id", "versions")


def cited(spark: SparkSession, folder: str, path: str, checkpoint: str, glob: str = "*txt*", files_at_once: int = 10_000, max_age: str = "36500d", trigger: dict | None = None) -> StreamingQuery:
    """Appends id, refs, error (see citations.extract_files) of the text files below `folder` to Parquet: of those that no
    earlier run with this checkpoint has done. The checkpoint is the record of what is done, so nothing is compared with
    what was written; a file that changes after it was read isn't read again, one older than the newest by more than
    `max_age` never is (the source remembers names for that long). A file of no bytes gives no row, here as in a batch."""
    files = spark.readStream.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true").option("maxFileAge", max_age).option("maxFilesPerTrigger", files_at_once)
    files = files.schema("path STRING, modificationTime TIMESTAMP, length LONG, content BINARY").load(folder)
    out = citations.extract_files(files.select("path", "content")).writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
    return out.outputMode("append").trigger(**(trigger or {"availableNow": True})).start()
