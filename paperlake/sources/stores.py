"""Tables that jobs leave behind: embeddings, citations, authors, results, degrees, slices and splits."""

from __future__ import annotations

import io
import json
import pickle
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.citations import as_json, from_json


def write_embeddings(fulltext: DataFrame, path: str, encode: Callable[[DataFrame], DataFrame], headers: dict | None = None) -> None:
    """The embeddings of fulltext (id, text) as Parquet, and headers (what made them) as JSON beside them."""
    encode(fulltext).write.parquet(f"{path}/rows")
    rows = [(k, json.dumps(v)) for k, v in (headers or {}).items()]
    fulltext.sparkSession.createDataFrame(rows, "name string, value string").coalesce(1).write.json(f"{path}/headers")


def read_embeddings(spark: SparkSession, path: str) -> tuple[dict, DataFrame]:
    """Headers, and id, embedding."""
    headers = spark.read.schema("name string, value string").json(f"{path}/headers").collect()
    return {r["name"]: json.loads(r["value"]) for r in headers}, spark.read.parquet(f"{path}/rows")


class _Arrays(pickle.Unpickler):
    """Reads numbers, lists and numpy arrays, and nothing that could run."""

    SAFE = {("numpy", "ndarray"), ("numpy", "dtype")} | {(f"numpy.{core}.multiarray", f) for core in ("core", "_core") for f in ("_reconstruct", "scalar")} | {("numpy._core.numeric", "_frombuffer"), ("numpy.core.numeric", "_frombuffer")}

    def find_class(self, module: str, name: str):
        if (module, name) not in self.SAFE:
            raise pickle.UnpicklingError(f"{module}.{name} is not read")
        return super().find_class(module, name)


def import_pickled(files: DataFrame, headers: int = 0) -> DataFrame:
    """path, batch, row, embedding of files (read as binaryFile) that hold pickled batches one after the other, the first
    `headers` objects of a file left out. A file is one task's work."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for path, content in zip(f["path"], f["content"], strict=True):
                stream, batch = io.BytesIO(content), -headers
                while stream.tell() < len(content):
                    rows = _Arrays(stream).load()
                    if batch >= 0:
                        rows = np.asarray(rows, np.float32).reshape(len(rows), -1)
                        yield pd.DataFrame({"path": path, "batch": batch, "row": range(len(rows)), "embedding": list(rows)})
                    batch += 1

    return files.select("path", "content").mapInPandas(run, "path string, batch int, row int, embedding array<float>")


def write_citations(citations: DataFrame, path: str) -> None:
    """Gzipped JSON lines of {id: refs}, which split at lines; also what from_json reads."""
    as_json(citations).write.option("compression", "gzip").text(path)


def read_citations(spark: SparkSession, path: str) -> DataFrame:
    return from_json(spark.read.text(path))


def write_json(rows: DataFrame, path: str) -> None:
    """Results, author tables and slices of metadata: gzipped JSON lines."""
    rows.write.option("compression", "gzip").option("ignoreNullFields", "false").json(path)


def read_json(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).json(path)


def write_lines(rows: DataFrame, path: str) -> None:
    """One line a row, its values with a space between: dumps of degrees and of coefficients."""
    rows.select(F.concat_ws(" ", *[F.col(c).cast("string") for c in rows.columns]).alias("value")).write.text(path)


def read_lines(spark: SparkSession, path: str, **kinds: str) -> DataFrame:
    parts = F.split("value", " ")
    return spark.read.text(path).select(*[F.get(parts, F.lit(i)).cast(kind).alias(name) for i, (name, kind) in enumerate(kinds.items())])


def write_split(rows: DataFrame, path: str) -> None:
    """Rows by their column `split`, a folder each, so that a reader of one split reads no other."""
    rows.write.partitionBy("split").parquet(path)


def read_split(spark: SparkSession, path: str, split: str) -> DataFrame:
    return spark.read.parquet(path).where(F.col("split") == split).drop("split")
