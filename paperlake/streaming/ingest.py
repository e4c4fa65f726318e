"""Harvested pages into a metadata table, once each."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.archives import exists
from ..operators.metadata import latest, records


def into_table(pages: DataFrame, path: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Writes new records of a stream of pages to Parquet, by year and month of the identifier. A page may come again
    after a failure between its write and the offset's; records whose id is there already are left out, and a batch has
    one row an id. Of the table, a batch reads the ids of its own months only."""

    def write(batch: DataFrame, _: int) -> None:
        new = latest(records(batch), "id", "versions").withColumn("yymm", F.coalesce(F.nullif(F.regexp_extract("id", r"(?:^|/)(\d{4})", 1), F.lit("")), F.lit("none")))
        spark = batch.sparkSession
        if exists(spark, path):
            months = [r[0] for r in new.select("yymm").distinct().collect()]
            there = spark.read.schema("id string, yymm string").parquet(path).where(F.col("yymm").isin(months)).select("id")
            new = new.join(there, "id", "left_anti")
        new.write.mode("append").partitionBy("yymm").parquet(path)

    return pages.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(**(trigger or {"processingTime": "1 second"})).start()
