"""Suffix-array dedup: removes every byte covered by a long string that also starts elsewhere."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import finish, lean, save
from .hashing import U, mix
from .suffixes import common_prefixes, suffix_array

#: Bytes of an anchor; bytes of text that are looked at together; bytes of a suffix array's shard; bytes up to which
#: neighbouring segments travel as one piece.
ANCHOR, BUFFER, SHARD, PIECE = 24, 1 << 18, 1 << 20, 1 << 16


def lowest(key: np.ndarray, w: int) -> np.ndarray:
    """Minimum of each w neighbours, by running minima from both sides of blocks of w."""
    n = len(key)
    whole = np.full(-(-n // w) * w, 2**64 - 1, U)
    whole[:n] = key
    blocks = whole.reshape(-1, w)
    left = np.minimum.accumulate(blocks, 1).ravel()
    right = np.minimum.accumulate(blocks[:, ::-1], 1)[:, ::-1].ravel()
    return np.minimum(right[: n - w + 1], left[w - 1 : n])


class Anchors:
    """Cuts texts into the segments that one anchor stands for.

    A window is a string of `length` bytes; its anchor is the string of ANCHOR bytes in it with the smallest hash (the
    leftmost of equals). The anchor depends on the window's content alone, so equal windows have equal anchors wherever
    they are. A segment is a run of windows, each starting a byte after the last, with equal anchors.
    """

    def __init__(self, length: int):
        self.length = length

    def __call__(self, texts: list[bytes]) -> list[tuple[np.ndarray, ...]]:
        """(text, first byte, bytes, anchor, digest of the content, whether the anchor stands in it more than once) of
        segments. The digest has 128 bits of blake2b: no two contents are known or can be made to share one."""
        out, held, size = [], [], 0
        for d, t in enumerate(texts):
            # longer texts go in parts that overlap by a window less a byte; each part has windows of its own
            for a in range(0, max(len(t) - self.length + 1, 0), BUFFER):
                part = t[a : a + BUFFER + self.length - 1]
                if size and size + len(part) > BUFFER:
                    out.append(self._cut(held))
                    held, size = [], 0
                held.append((d, a, part))
                size += len(part)
        if held:
            out.append(self._cut(held))
        return out

    def _cut(self, parts: list[tuple[int, int, bytes]]) -> tuple[np.ndarray, ...]:
        b = np.frombuffer(b"".join(p for _, _, p in parts), np.uint8)
        n, w = len(b), self.length - ANCHOR + 1
        word = np.ndarray(n + 1, "<u8", np.concatenate([b, np.zeros(8, np.uint8)]), strides=(1,))
        m = n - ANCHOR + 1
        h = mix(mix(word[:m] * U(0x9E3779B97F4A7C15) + word[8 : m + 8] * U(0xC2B2AE3D27D4EB4F)) + word[16 : m + 16] * U(0x165667B19E3779F9))
        place = U((1 << 24) - 1)
        best = (lowest((h & ~place) | np.arange(m, dtype=U), w) & place).astype(np.int64)
        chosen = h[best]
        sizes = np.array([len(p) for _, _, p in parts])
        ends = np.cumsum(sizes)
        starts = ends - sizes
        which = np.repeat(np.arange(len(parts)), sizes)[: len(best)]
        valid = which == np.repeat(np.arange(len(parts)), sizes)[self.length - 1 : self.length - 1 + len(best)]
        s = np.flatnonzero(valid)
        c, p = chosen[s], which[s]
        cut = np.concatenate([[True], (c[1:] != c[:-1]) | (p[1:] != p[:-1])])
        first = s[cut]
        last = s[np.concatenate([cut[1:], [True]])]
        end = last + self.length
        view, blake = memoryview(b), hashlib.blake2b
        digest = [blake(view[x:y], digest_size=16).digest() for x, y in zip(first.tolist(), end.tolist(), strict=True)]
        own = which[first]
        return np.array([d for d, _, _ in parts])[own], first - starts[own] + np.array([a for _, a, _ in parts])[own], end - first, h[best[first]], digest, best[first] != best[last]


def windows(spans: np.ndarray, n: int, length: int) -> list[tuple[int, int]]:
    """Bytes covered by the windows that start at the sorted positions spans."""
    if not len(spans):
        return []
    cut = np.flatnonzero(np.diff(spans) > length)
    return list(zip(spans[np.concatenate([[0], cut + 1])].tolist(), (spans[np.concatenate([cut, [len(spans) - 1]])] + length).tolist(), strict=True))


def repeated(contents: list[bytes], length: int, several: np.ndarray | None = None) -> list[np.ndarray]:
    """Of each byte string, where windows start that also start elsewhere among all of them, by a suffix array of all
    and its permuted common prefixes. 0xFF, which UTF-8 never has, stands between them. several: which of them stand
    for more than one copy, so that all their windows start elsewhere too."""
    raw = np.frombuffer(b"\xff".join(contents) + b"\xff", np.uint8)
    t = np.zeros(len(raw) + 1, np.int16)
    t[:-1] = raw
    t[:-1] += 1
    sa = suffix_array(t, 257)
    shared, before = common_prefixes(raw, sa)
    sizes = np.array([len(c) for c in contents]) + 1
    ends = np.cumsum(sizes)
    room = np.repeat(ends - 1, sizes)
    room -= np.arange(len(raw))
    hit = np.flatnonzero((shared >= length) & (room >= length))
    mark = np.zeros(len(raw), bool)
    mark[hit] = True
    mark[before[hit]] = True
    if several is not None:
        mark |= np.repeat(several, sizes) & (room >= length)
    starts = (ends - sizes).tolist()
    return [np.flatnonzero(mark[a : a + n]) for a, n in zip(starts, sizes.tolist(), strict=True)]


KEY = "k1 bigint, k2 bigint"


def keyed(docs: DataFrame, key: str, text: str, passed: list[str]) -> DataFrame:
    """k1 (the id) and k2 (a hash of the text, which tells rows apart that repeat an id), the text as bytes, whether it
    is null, and the columns to pass on as one struct, where their names clash with none."""
    of = lambda c: F.col(f"`{c}`")
    return docs.select(F.coalesce(of(key).cast("long"), F.lit(-1)).alias("k1"), F.xxhash64(of(text)).alias("k2"), F.coalesce(F.encode(of(text), "UTF-8"), F.lit("").cast("binary")).alias("bytes"), of(text).isNull().alias("null"), F.struct(*map(of, passed)).alias("row"))


def segments(docs: DataFrame, length: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors = Anchors(length)
        for whole in batches:
            for at in range(0, whole.num_rows, 1000):
                batch = whole.slice(at, 1000)
                k1, k2 = batch.column(0).to_numpy(), batch.column(1).to_numpy()
                for d, first, n, h, digest, inner in anchors(batch.column(2).to_pylist()):
                    cols = [k1[d], k2[d], first.astype(np.int64), n.astype(np.int32), h.view(np.int64), pa.array(digest, pa.binary()), inner]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names=["k1", "k2", "first", "n", "anchor", "digest", "inner"])

    return docs.select("k1", "k2", "bytes").mapInArrow(lean(run), f"{KEY}, first bigint, n int, anchor bigint, digest binary, inner boolean")


MEMBERS = "members array<struct<anchor:bigint,digest:binary,offset:int,n:int>>"


def fetch(docs: DataFrame, lists: DataFrame, length: int) -> DataFrame:
    """Bytes of segments, by key: lists has k1, k2, w (array of first, n, anchor, digest, copies, alone, hot).

    Segments whose anchor stands in different surroundings come one by one, their key being the anchor. Those whose
    surroundings are always the same (alone) need not meet others; where they follow each other in a text they come as
    one piece of PIECE bytes at most, so its bytes aren't read once for each of them.
    """
    kind = pa.list_(pa.struct([("anchor", pa.int64()), ("digest", pa.binary()), ("offset", pa.int32()), ("n", pa.int32())]))

    def one(b: bytes, segments: list[dict]) -> Iterator[tuple]:
        run: list[dict] = []
        for x in [*sorted((x for x in segments if x["alone"]), key=lambda x: x["first"]), None]:
            if run and (x is None or x["first"] != run[-1]["first"] + run[-1]["n"] - length + 1 or x["first"] - run[0]["first"] > PIECE):
                a = run[0]["first"]
                yield False, run[0]["anchor"], 2, b[a : run[-1]["first"] + run[-1]["n"]], [{"anchor": r["anchor"], "digest": r["digest"], "offset": r["first"] - a, "n": r["n"]} for r in run]
                run = []
            run.append(x)
        for x in segments:
            if not x["alone"]:
                yield x["hot"], x["anchor"], x["copies"], b[x["first"] : x["first"] + x["n"]], [{"anchor": x["anchor"], "digest": x["digest"], "offset": 0, "n": x["n"]}]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 100):
                batch = whole.slice(at, 100)
                out = [y for b, w in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True) for y in one(b, w)]
                cols = list(zip(*out, strict=True)) or [[], [], [], [], []]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.bool_(), pa.int64(), pa.int64(), pa.binary(), kind), strict=True)], names=["hot", "key", "copies", "content", "members"])

    rows = docs.select("k1", "k2", "bytes").join(lists, ["k1", "k2"]).select("bytes", "w")
    return rows.mapInArrow(lean(run), f"hot boolean, key bigint, copies bigint, content binary, {MEMBERS}")


SPANS = "anchor bigint, digest binary, spans array<struct<a:int,b:int>>"


def sharded(contents: DataFrame, length: int) -> DataFrame:
    """Spans of repeated windows, by suffix arrays of shards. All segments of a key are in one shard; of copies one is
    entered. A task cuts its share into shards of about SHARD bytes."""
    kind = pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())]))

    def solve(held: list[tuple]) -> pa.RecordBatch:
        anchor, digest, spans = [], [], []
        for h, starts in zip(held, repeated([h[2] for h in held], length, np.array([h[1] > 1 for h in held])), strict=True):
            for m in h[3]:
                lo, hi = np.searchsorted(starts, [m["offset"], m["offset"] + m["n"] - length + 1])
                if hi > lo:
                    anchor.append(m["anchor"])
                    digest.append(m["digest"])
                    spans.append([{"a": x, "b": y} for x, y in windows(starts[lo:hi] - m["offset"], m["n"], length)])
        return pa.RecordBatch.from_arrays([pa.array(anchor, pa.int64()), pa.array(digest, pa.binary()), pa.array(spans, kind)], names=["anchor", "digest", "spans"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for whole in batches:
            for at in range(0, whole.num_rows, 1000):
                for row in zip(*(c.to_pylist() for c in whole.slice(at, 1000).columns), strict=True):
                    if size + len(row[2]) > SHARD and held and row[0] != held[-1][0]:
                        yield solve(held)
                        held, size = [], 0
                    held.append(row)
                    size += len(row[2])
        if held:
            yield solve(held)

    n = int(contents.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return contents.repartition(n, "key").sortWithinPartitions("key").mapInArrow(lean(run), SPANS)


def counted(contents: DataFrame, length: int) -> DataFrame:
    """The same for an anchor whose different surroundings are more than a shard holds: the shard would sort their
    windows, and here 128-bit digests of these windows are counted instead, which spreads the anchor over all tasks and
    combines equal windows before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, d, n, c in zip(*(x.to_pylist() for x in batch.columns), strict=True):
                for lo in range(0, len(c) - length + 1, 5000):
                    at = range(lo, min(lo + 5000, len(c) - length + 1))
                    yield pa.RecordBatch.from_arrays([pa.array([a] * len(at)), pa.array([d] * len(at), pa.binary()), pa.array([n] * len(at)), pa.array(at, pa.int32()), pa.array([hashlib.blake2b(c[i : i + length], digest_size=16).digest() for i in at], pa.binary())], names=["anchor", "digest", "copies", "at", "window"])

    contents = contents.select(F.col("members")[0]["anchor"].alias("anchor"), F.col("members")[0]["digest"].alias("digest"), "copies", "content")
    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = [[{"a": a, "b": b} for a, b in windows(np.sort(np.array(at)), 0, length)] for at in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(spans, pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())])))], names=["anchor", "digest", "spans"])

    rows = save(contents.mapInArrow(lean(run), "anchor bigint, digest binary, copies bigint, at int, window binary"), "windows")
    twice = rows.groupBy("window").agg(F.sum("copies").alias("n")).where("n > 1").select("window")
    marks = rows.join(twice, "window", "left_semi").groupBy("anchor", "digest").agg(F.collect_list("at").alias("at"))
    spans = save(marks.mapInArrow(lean(merge), SPANS), "spans")
    finish(rows)
    return spans


def find(docs: DataFrame, length: int) -> DataFrame:
    """k1, k2, spans: byte ranges (a, b) to remove, not merged, of documents (see keyed) that have any; written."""
    every = save(segments(docs, length), "segments")
    often = every.groupBy("anchor").agg(F.count("*").alias("all"), F.max("inner").alias("inner")).where("all > 1 OR inner").select("anchor")
    rows = save(every.join(often, "anchor", "left_semi"), "segments")
    finish(every)
    # of equal segments the one of smallest place stands for all, so that neighbours in a text are found together
    kinds = rows.groupBy("anchor", "digest").agg(F.count("*").alias("copies"), F.max("inner").alias("inner"), F.min(F.struct("k1", "k2", "first", "n")).alias("at"))
    kinds = save(kinds.select("anchor", "digest", "copies", "inner", "at.*"), "kinds")
    several = kinds.groupBy("anchor").agg(F.count("*").alias("kinds"), (F.sum(F.col("n").cast("long")) > SHARD).alias("hot")).where("kinds > 1 OR hot")
    wanted = kinds.join(several, "anchor", "left").withColumn("alone", F.expr("kinds IS NULL AND copies > 1")).withColumn("hot", F.coalesce("hot", F.lit(False)))
    lists = wanted.groupBy("k1", "k2").agg(F.collect_list(F.struct("first", "n", "anchor", "digest", "copies", "alone", "hot")).alias("w"))
    contents = save(fetch(docs, lists, length), "contents")
    finish(kinds)
    spans = save(sharded(contents.where("NOT hot").drop("hot"), length), "spans")
    parts = [counted(contents.where("hot"), length)] if contents.where("hot").limit(1).count() else []
    found = reduce(DataFrame.unionByName, [spans, *parts])
    found = rows.join(found, ["anchor", "digest"]).select("k1", "k2", F.explode(F.transform("spans", lambda s: F.struct((s["a"] + F.col("first")).alias("a"), (s["b"] + F.col("first")).alias("b")))).alias("s"))
    found = save(found.groupBy("k1", "k2").agg(F.collect_set("s").alias("spans")), "found")
    finish(rows, contents, spans, *parts)
    return found


def remove(docs: DataFrame, length: int = 200, key: str = "doc_id", text: str = "text", keep_text: bool = False) -> DataFrame:
    """Removes from every text each byte covered by a string of `length` bytes that also starts anywhere else.

    Strings are judged on the input, in all documents, and never cross documents; overlapping starts count. Equal
    windows share their anchor (see Anchors), so it is enough to compare, by suffix arrays of shards, the segments of
    anchors that occur more than once. Before texts are read for that, segments are counted by anchor and digest with
    map-side combine: of a group of copies each segment is read once.

    Returns doc_id, n_bytes, n_removed, n_spans (maximal removed runs), kept_sha256; with keep_text instead docs with
    the text replaced by its kept bytes (what is left of a character that is cut is dropped; null stays null). Null and
    empty texts have nothing to remove. Rows that repeat in id and text are copies of each other; rows of one id with
    different texts, and rows without id, are documents of their own. Other columns may have any name. Empty table: no
    rows.
    """
    passed = [c for c in docs.columns if c != text] if keep_text else [key]
    rows = keyed(docs, key, text, passed)
    rows = rows.join(find(rows, length), ["k1", "k2"], "left").select("row", "null", "bytes", "spans")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 500):
                batch = whole.slice(at, 500)
                out = []
                for null, b, spans in zip(*(batch.column(i).to_pylist() for i in (1, 2, 3)), strict=True):
                    kept, runs, gone, last = [], 0, 0, 0
                    for a, e in sorted((s["a"], s["b"]) for s in spans or []):
                        if a > last or not runs:
                            kept.append(b[last:a])
                            runs += 1
                            gone += e - a
                            last = e
                        elif e > last:
                            gone += e - last
                            last = e
                    kept.append(b[last:])
                    left = b"".join(kept)
                    out.append((None if null else left.decode("utf-8", "ignore"),) if keep_text else (len(b), gone, runs, hashlib.sha256(left).hexdigest()))
                kinds = [pa.string()] if keep_text else [pa.int64(), pa.int64(), pa.int64(), pa.string()]
                made = [pa.array([o[i] for o in out], t) for i, t in enumerate(kinds)]
                yield pa.RecordBatch.from_arrays([batch.column(0), *made], names=names)

    names = ["row", "text"] if keep_text else ["row", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    schema = T.StructType([rows.schema["row"]])
    schema = schema.add("text", "string") if keep_text else schema.add("n_bytes", "long").add("n_removed", "long").add("n_spans", "long").add("kept_sha256", "string")
    done = rows.mapInArrow(lean(run), schema)
    if keep_text:
        return done.select(*[F.col("text").alias(c) if c == text else F.col("row").getField(c).alias(c) for c in docs.columns])
    return done.select(F.col("row").getField(key).alias("doc_id"), *names[1:])
