"""Tar archives in parts: an index of members by seeks, and a data source whose partitions are byte ranges.

Nothing holds an archive: the index reads headers only, a part at most `at_once` bytes of members (or one larger member).
Archives lie wherever pyarrow.fs reads: local paths, file:, hdfs:, s3:, gs: and the like. They aren't compressed: in a gzip
stream no task could begin in the middle.
"""

from __future__ import annotations

import io
import json
import re
import tarfile
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..operators.shared import save

#: How many byte ranges are a task each; and the bytes that a task of several reads.
MOST, SHARE = 1000, 64 << 20
BAD = (tarfile.TarError, OSError, EOFError)


def located(uri: str) -> tuple[fs.FileSystem, str]:
    """The store and the path in it of an address as Spark writes it: blanks and the like stand there as they are."""
    if "://" in uri and not uri.startswith("file:"):
        return fs.FileSystem.from_uri(quote(uri, safe=":/?&=@%+~"))
    return fs.LocalFileSystem(), re.sub("^file:/+", "/", uri)


class Span(io.RawIOBase):
    """The bytes from `start` to `end` of a file, as a file of their own."""

    def __init__(self, uri: str, start: int = 0, end: int | None = None):
        self.file = None
        store, path = located(uri)
        self.file = store.open_input_file(path)
        self.start, self.end, self.at = start, self.file.size() if end is None else end, 0

    def readable(self) -> bool:
        return True

    def seekable(self) -> bool:
        return True

    def seek(self, to: int, whence: int = 0) -> int:
        self.at = max(0, to + (0, self.at, self.end - self.start)[whence])
        return self.at

    def tell(self) -> int:
        return self.at

    def readinto(self, b) -> int:
        n = max(0, min(len(b), self.end - self.start - self.at))
        if n:
            self.file.seek(self.start + self.at)
            data = self.file.read(n)
            b[: len(data)] = data
            n = len(data)
        self.at += n
        return n

    def close(self) -> None:
        if self.file:
            self.file.close()
        super().close()


def opened(uri: str, start: int = 0, end: int | None = None) -> tarfile.TarFile:
    return tarfile.open(fileobj=io.BufferedReader(Span(uri, start, end), 1 << 16), mode="r:")


def walked(uri: str, start: int = 0, end: int | None = None) -> Iterator[tuple[tarfile.TarFile, tarfile.TarInfo]]:
    """The members of an archive, or of a part of it that begins with one; they aren't gathered."""
    with opened(uri, start, end) as t:
        while (m := t.next()) is not None:
            t.members = []
            yield t, m


def members(spark: SparkSession, path: str) -> DataFrame:
    """tar (its address), member, start, end (bytes of its headers and content), size, error: the files in all archives
    that `path` names, one task an archive, which seeks from header to header. Where an archive can't be read further
    there is a row with the error and no member. A written table."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select(F.col("path").alias("tar"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["tar", "member", "start", "end", "size", "error"]
        kinds = [pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string()]
        batch = lambda rows: pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)
        for b in batches:
            for uri in b.column(0).to_pylist():
                rows = []
                try:
                    for t, m in walked(uri):
                        if m.isfile():
                            if m.offset_data + m.size > t.fileobj.raw.end:
                                raise tarfile.ReadError("unexpected end of data")
                            rows.append((uri, m.name, m.offset, m.offset_data + -(-m.size // 512) * 512, m.size, None))
                        if len(rows) >= 10_000:
                            yield batch(rows)
                            rows = []
                except BAD as e:
                    rows.append((uri, None, None, None, None, f"{type(e).__name__}: {e}"))
                if rows:
                    yield batch(rows)

    each = files.repartition(F.col("tar"))
    return save(each.mapInArrow(run, "tar string, member string, start bigint, end bigint, size bigint, error string"), "members")


class _Part(InputPartition):
    def __init__(self, ranges: list):
        self.ranges = ranges


class _Parts(DataSourceReader):
    def __init__(self, parts: list):
        self.parts = parts

    def partitions(self) -> list[InputPartition]:
        return [_Part(p) for p in self.parts] or [_Part([])]

    def read(self, partition: _Part) -> Iterator[tuple]:
        for tar, start, end in partition.ranges:
            for t, m in walked(tar, start, end):
                if m.isfile():
                    yield tar, start + m.offset, m.name, t.extractfile(m).read()


class Parts(DataSource):
    """spark.read.format("tar_parts"): tar, start, member, content of the byte ranges in the option `parts`, a JSON list of
    lists of [tar, start, end]; each list is a partition, which reads its ranges one after the other."""

    @classmethod
    def name(cls) -> str:
        return "tar_parts"

    def schema(self) -> str:
        return "tar STRING, start BIGINT, member STRING, content BINARY"

    def reader(self, schema) -> DataSourceReader:
        return _Parts(json.loads(self.options["parts"]))


def ranges(index: DataFrame, at_once: int = 64 << 20) -> DataFrame:
    """tar, start, end: byte ranges that hold the members of an index, some `at_once` bytes each; where an archive has
    whole ranges without any, none is made."""
    cell = (F.col("start") / at_once).cast("long")
    return index.where("member IS NOT NULL").groupBy("tar", cell.alias("cell")).agg(F.min("start").alias("start"), F.max("end").alias("end")).select("tar", "start", "end")


def dealt(found: list, most: int = MOST, share: int = SHARE) -> list[list]:
    """Ranges [tar, start, end], in order, as lists of a partition's: each its own up to `most` of them; beyond that `most`
    lists of like bytes, or more, so that one has `share` bytes or little over. Neighbours in a list are joined."""
    if len(found) <= most:
        return [[r] for r in found]
    each = min(share, -(-sum(end - start for _, start, end in found) // most))
    out, size = [], each
    for tar, start, end in found:
        if size >= each:
            out.append([])
            size = 0
        if out[-1] and out[-1][-1][0] == tar and out[-1][-1][2] == start:
            out[-1][-1] = [tar, out[-1][-1][1], end]
        else:
            out[-1].append([tar, start, end])
        size += end - start
    return out


def contents(index: DataFrame, wanted: DataFrame | None = None, at_once: int = 64 << 20, name=None) -> DataFrame:
    """tar, member, content, error of the members of an index (see members), all or the wanted ones (tar, pdfs).

    Many tasks read one archive, each a range of it (or several, see dealt); ranges without wanted members aren't read. `name`: what becomes of an
    archive's address (a function of a column), in the result and for `wanted`; else the name after the last slash. Only
    the ranges come to the driver, one in `at_once` bytes of archives. Rows with an error are the index's own.
    """
    spark = index.sparkSession
    spark.dataSource.register(Parts)
    known = index.withColumn("__tar", (name or (lambda c: F.substring_index(c, "/", -1)))(F.col("tar")))
    some = known
    if wanted is not None:
        asked = wanted.select(F.col("tar").alias("__tar"), F.explode("pdfs").alias("member")).distinct()
        some = known.join(asked, ["__tar", "member"], "left_semi")
        bad = known.where("member IS NULL").join(wanted.select(F.col("tar").alias("__tar")), "__tar", "left_semi")
    else:
        bad = known.where("member IS NULL")
    parts = [[r["tar"], r["start"], r["end"]] for r in ranges(some, at_once).orderBy("tar", "start").collect()]
    read = spark.read.format("tar_parts").option("parts", json.dumps(dealt(parts))).load()
    if wanted is not None:
        read = read.join(some.select("tar", "start"), ["tar", "start"], "left_semi")
    rows = read.select((name or (lambda c: F.substring_index(c, "/", -1)))(F.col("tar")).alias("tar"), "member", "content", F.lit(None).cast("string").alias("error"))
    return rows.unionByName(bad.select(F.col("__tar").alias("tar"), "member", F.lit(None).cast("binary").alias("content"), "error"))


def write(files: DataFrame, path: str) -> DataFrame:
    """Archives of files (tar, member, content) in the folder `path`: tar, members, bytes of each. An archive's members are
    written one after the other, in the order of names, under another name until the archive is whole; so a repeated task
    leaves no half. Null contents are empty; rows without tar or member are left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, folder = located(path)
        store.create_dir(folder)
        now, out, count = None, None, 0

        def done() -> pa.RecordBatch:
            out.close()
            stream.close()
            size = store.get_file_info(part).size
            store.move(part, f"{folder}/{now}")
            return pa.RecordBatch.from_arrays([pa.array([now]), pa.array([count], pa.int64()), pa.array([size], pa.int64())], names=["tar", "members", "bytes"])

        for b in batches:
            for tar, member, content in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2), strict=True):
                if tar != now:
                    if out:
                        yield done()
                    now, count, part = tar, 0, f"{folder}/.{tar}.{TaskContext.get().taskAttemptId()}"
                    stream = store.open_output_stream(part)
                    out = tarfile.open(fileobj=stream, mode="w|")
                data = content.as_py() or b""
                info = tarfile.TarInfo(member)
                info.size = len(data)
                out.addfile(info, io.BytesIO(data))
                out.members = []
                count += 1
        if out:
            yield done()

    rows = files.where("tar IS NOT NULL AND member IS NOT NULL").select("tar", "member", "content")
    return save(rows.repartition("tar").sortWithinPartitions("tar", "member").mapInArrow(run, "tar string, members bigint, bytes bigint"), "archives")
