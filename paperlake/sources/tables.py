"""Tables that are replaced or added to as a whole: a data source whose writer commits what all tasks have written.

A table is a folder with one Parquet file a task and the file `_current.json`, which names those that count. A job's files
are none of the table until its commit puts a new `_current.json` in place of the old; a job that fails removes its own.
What a lost driver, or a task that hadn't ended yet, leaves behind goes with the next commit. Tables lie wherever pyarrow.fs
writes.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage
from pyspark.sql.types import StructType

from .tars import located

CURRENT = "_current.json"


def current(store: fs.FileSystem, folder: str) -> dict:
    """What the table is made of: schema (as Spark's JSON) and parts (name, rows)."""
    if store.get_file_info(f"{folder}/{CURRENT}").type != fs.FileType.File:
        return {"schema": None, "parts": []}
    with store.open_input_stream(f"{folder}/{CURRENT}") as f:
        return json.loads(f.read())


@dataclass
class Written(WriterCommitMessage):
    name: str
    rows: int


class _Writer(DataSourceArrowWriter):
    def __init__(self, path: str, schema: StructType, replace: bool):
        self.path, self.schema, self.replace, self.run = path, schema, replace, uuid.uuid4().hex

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        store, folder = located(self.path)
        store.create_dir(folder)
        name, rows, out = f"{self.run}-{uuid.uuid4().hex}.parquet", 0, None
        for batch in iterator:
            if out is None:
                out = pq.ParquetWriter(f"{folder}/{name}", batch.schema, filesystem=store, compression="zstd")
            out.write_batch(batch)
            rows += batch.num_rows
        if out is not None:
            out.close()
        return Written(name if out is not None else "", rows)

    def commit(self, messages: list[Written | None]) -> None:
        store, folder = located(self.path)
        store.create_dir(folder)
        before = current(store, folder)
        parts = [] if self.replace else before["parts"]
        now = {"schema": self.schema.json(), "parts": [*parts, *({"name": m.name, "rows": m.rows} for m in messages if m and m.name)]}
        with store.open_output_stream(f"{folder}/{CURRENT}.{self.run}") as f:
            f.write(json.dumps(now).encode())
        store.move(f"{folder}/{CURRENT}.{self.run}", f"{folder}/{CURRENT}")
        self.sweep(store, folder, {p["name"] for p in now["parts"]} | {CURRENT})

    def abort(self, messages: list[Written | None]) -> None:
        store, folder = located(self.path)
        for f in store.get_file_info(fs.FileSelector(folder, allow_not_found=True)):
            if self.run in f.base_name:
                store.delete_file(f.path)

    def sweep(self, store: fs.FileSystem, folder: str, kept: set[str]) -> None:
        for f in store.get_file_info(fs.FileSelector(folder)):
            if f.type == fs.FileType.File and f.base_name not in kept and not f.base_name.startswith("."):
                store.delete_file(f.path)


class _Part(InputPartition):
    def __init__(self, name: str):
        self.name = name


class _Reader(DataSourceReader):
    def __init__(self, path: str):
        self.path = path

    def partitions(self) -> list[InputPartition]:
        return [_Part(p["name"]) for p in current(*located(self.path))["parts"]] or [_Part("")]

    def read(self, partition: _Part) -> Iterator[pa.RecordBatch]:
        if partition.name:
            store, folder = located(self.path)
            with store.open_input_file(f"{folder}/{partition.name}") as f:
                yield from pq.ParquetFile(f).iter_batches()


class Whole(DataSource):
    """spark.read.format("whole_table").load(path) and df.write.format("whole_table").mode(...).save(path); the mode is
    overwrite or append."""

    @classmethod
    def name(cls) -> str:
        return "whole_table"

    def schema(self) -> StructType:
        kind = current(*located(self.options["path"]))["schema"]
        if kind is None:
            raise ValueError(f"no table at {self.options['path']}")
        return StructType.fromJson(json.loads(kind))

    def reader(self, schema: StructType) -> DataSourceReader:
        return _Reader(self.options["path"])

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceArrowWriter:
        return _Writer(self.options["path"], schema, overwrite)


def write(df: DataFrame, path: str, append: bool = False) -> None:
    """Replaces the table at `path`, or adds to it, once all of df is written; if that fails it stays as it was. One job
    at a time may write a table."""
    df.sparkSession.dataSource.register(Whole)
    df.write.format("whole_table").mode("append" if append else "overwrite").save(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    spark.dataSource.register(Whole)
    return spark.read.format("whole_table").load(path)
