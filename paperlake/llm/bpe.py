"""Byte-level BPE encoding and decoding with the ranks of a public vocabulary."""

from __future__ import annotations

import base64
import hashlib
import heapq
import json
import re
import unicodedata
import uuid
import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import lean, settle, shared_dir, trim

#: Parts of the rank map, by CRC of the piece: a map value in Spark is found by going through its keys.
PARTS = 1 << 14
#: Text, in characters, that one chunk stands for at most (a longer text has one for itself).
CHUNK = 16 << 20
#: Words that are merged as one row.
PART = 2048
#: The longest word, in bytes, that is merged by higher-order functions, whose work grows with the square of the length;
#: longer ones, which are single strings of base64 and the like, are merged with a heap.
LONG = 256
#: White space by Unicode, spelt out because regex libraries differ on U+001C to U+001F.
SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"


@cache
def ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def splitter(pattern: str) -> regex.Pattern:
    r"""The pattern with \s and \S replaced by explicit classes, inside brackets and out."""
    out, inside, i = [], False, 0
    while i < len(pattern):
        two = pattern[i : i + 2]
        if two == r"\s":
            out.append(SPACE if inside else f"[{SPACE}]")
        elif two == r"\S":
            out.append(f"[^{SPACE}]")
        elif two[0] == "\\":
            out.append(two)
        else:
            inside = two[0] == "[" or inside and two[0] != "]"
            out.append(two[0])
            i -= 1
        i += 2
    return regex.compile("".join(out))


def latin(pattern: str) -> re.Pattern:
    r"""The pattern for texts of characters under U+0250, with \p{L}, \p{N} and \s as explicit classes, for the faster
    library of the two."""
    def of(kind: str) -> str:
        return "".join(f"\\u{c:04x}" for c in range(0x250) if unicodedata.category(chr(c))[0] == kind)

    space = "".join(f"\\u{c:04x}" for c in range(0x250) if regex.match(f"[{SPACE}]", chr(c)))
    out, inside, i = [], False, 0
    while i < len(pattern):
        token = next((x for x in (r"\p{L}", r"\p{N}", r"\s", r"\S") if pattern.startswith(x, i)), pattern[i])
        if len(token) > 1:
            body = of(token[3]) if token[1] == "p" else space
            out.append(f"[^{body}]" if token == r"\S" else body if inside else f"[{body}]")
        else:
            inside = token == "[" or inside and token != "]"
            out.append(token)
        i += len(token)
    return re.compile("".join(out))


BEYOND = re.compile("[^\u0000-\u024f]")


def finder(pattern: str):
    plain, quick = splitter(pattern).findall, latin(pattern).findall
    return lambda t: plain(t) if BEYOND.search(t) else quick(t)


def rank_map(table: dict[bytes, int]) -> Column:
    """The ranks as a literal: an array of maps from piece to rank. A piece's bytes are the characters U+0000 to U+00FF
    of a string; its place in the array is a CRC of that string. Folded to a constant once, when a query is planned."""
    parts: list[dict[str, int]] = [{} for _ in range(PARTS)]
    for piece, rank in table.items():
        p = piece.decode("latin-1")
        parts[zlib.crc32(p.encode()) % PARTS][p] = rank
    return F.from_json(F.lit(json.dumps(parts, ensure_ascii=False, separators=(",", ":"))), "array<map<string,int>>")


def merged(word: Column, maps: Column) -> Column:
    """Ids of one word: a fold over its pieces, single bytes at first, that joins the pair of lowest rank (the leftmost
    of equals) until no pair has a rank. Carries the pairs' ranks, so a step looks up the two new ones only."""
    rank = lambda p: F.get(maps, (F.crc32(p) % PARTS).cast("int"))[p]
    let = lambda value, f: F.get(F.transform(F.array(value), f), F.lit(0))
    none = F.array().cast("array<int>")

    def join(s: Column, p: Column) -> Column:
        pieces, by = s["p"], s["r"]
        one = F.concat(F.get(pieces, p - 1), F.get(pieces, p))
        fewer = F.transform(F.sequence(F.lit(0), F.size(by) - 1), lambda k: F.when(k < p - 1, F.get(pieces, k)).when(k > p - 1, F.get(pieces, k + 1)).otherwise(one))
        again = lambda q: F.transform(F.sequence(F.lit(0), F.size(by) - 2), lambda k: F.when(k < p - 2, F.get(by, k)).when(k > p - 1, F.get(by, k + 1)).otherwise(rank(F.concat(F.get(q, k), F.get(q, k + 1)))))
        return let(fewer, lambda q: F.struct(q.alias("p"), F.when(F.size(by) > 1, again(q)).otherwise(none).alias("r")))

    n = F.length(word)
    first = F.transform(F.sequence(F.lit(1), n), lambda i: F.substr(word, i, F.lit(1)))
    pairs = F.when(n > 1, F.transform(F.sequence(F.lit(1), n - 1), lambda i: rank(F.substr(word, i, F.lit(2))))).otherwise(none)
    step = lambda s, _: let(F.array_min(s["r"]), lambda m: F.when(m.isNull(), s).otherwise(let(F.array_position(s["r"], m).cast("int"), lambda p: join(s, p))))
    folded = F.aggregate(F.sequence(F.lit(1), n), F.struct(first.alias("p"), pairs.alias("r")), step, lambda s: F.transform(s["p"], rank))
    return folded


def merge_long(word: bytes, table: dict[bytes, int]) -> list[int]:
    """The same for one long word, with a heap of pairs: n log n."""
    n = len(word)
    ends, prev = list(range(1, n + 1)), list(range(-1, n - 1))  # piece i is word[i:ends[i]]; the next piece starts there
    heap = [(r, i, i + 2) for i in range(n - 1) if (r := table.get(word[i : i + 2])) is not None]
    heapq.heapify(heap)
    alive = [True] * n
    while heap:
        _, i, end = heapq.heappop(heap)
        if not alive[i] or ends[i] >= n or ends[ends[i]] != end:
            continue
        j = ends[i]
        alive[j], ends[i] = False, end
        if end < n:
            prev[end] = i
            if (r := table.get(word[i : ends[end]])) is not None:
                heapq.heappush(heap, (r, i, ends[end]))
        if prev[i] >= 0 and (r := table.get(word[prev[i] : end])) is not None:
            heapq.heappush(heap, (r, prev[i], end))
    out, i = [], 0
    while i < n:
        out.append(table[word[i : ends[i]]])
        i = ends[i]
    return out


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices starts[0] .. starts[0]+lengths[0]-1, starts[1] .. and so on."""
    ends = np.cumsum(lengths)
    return np.repeat(starts - ends + lengths, lengths) + np.arange(ends[-1] if len(ends) else 0)


def bound(table: dict[bytes, int], f) -> Column:
    """f of the rank map, which the plan then holds once."""
    return F.get(F.transform(F.array(rank_map(table)), f), F.lit(0))


CHUNKS = "chunk bigint, shard int, docs array<bigint>, counts binary, stream binary, sizes binary, ids binary, words binary"


def planes(x: np.ndarray) -> bytes:
    """Numbers under 2**32, their low bytes first, then the next ones, as many as are needed: this compresses well."""
    k = 3 if not len(x) or x.max() < 1 << 24 else 4
    return b"".join((x >> 8 * j).astype(np.uint8).tobytes() for j in range(k))


def unplaned(b: bytes, n: int) -> np.ndarray:
    out, k = np.zeros((n, 4), np.uint8), len(b) // max(n, 1)
    out[:, :k] = np.frombuffer(b, np.uint8).reshape(k, n).T
    return out.view("<u4").reshape(-1)


def chunks(docs: DataFrame, shards: int, find, table) -> DataFrame:
    """One row a chunk of texts, with the texts' words as numbers, and one for each shard that holds words of the chunk.

    A chunk's distinct words are numbered: first those that are ranks themselves or too long for the fold, whose ids
    (sizes, ids) its own row has, then the others by shard, in the order in which the shard's row lists them (words, one
    after the other, and their sizes). docs: doc_id, text. table: the ranks, as a broadcast.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = table.value

        def rows() -> pa.RecordBatch:
            words = [w.encode("utf-8", "surrogatepass") for w in seen]
            seen.clear()
            to = np.full(len(words), -1, np.int32)
            own, sizes = [], []
            for i, w in enumerate(words):
                r = ranks.get(w)
                if r is not None:
                    own.append(r)
                    sizes.append(1)
                elif len(w) > LONG:
                    own += (got := merge_long(w, ranks))
                    sizes.append(len(got))
                else:
                    to[i] = zlib.crc32(w) % shards
            order = np.argsort(to, kind="stable")
            number = np.empty(len(words), np.uint32)
            number[order] = np.arange(len(words))
            name = uuid.uuid4().int >> 65
            out = [(name, None, ids, np.array(counts, np.uint32).tobytes(), planes(number[np.concatenate(stream)]), np.array(sizes, np.uint32).tobytes(), np.array(own, np.uint32).tobytes(), None)]
            asked = order[len(sizes) :]
            for part in np.split(asked, np.flatnonzero(np.diff(to[asked])) + 1):
                if len(part):
                    own = [words[i] for i in part.tolist()]
                    out.append((name, int(to[part[0]]), None, None, None, np.array([len(w) for w in own], np.uint16).tobytes(), None, b"".join(own)))
            kinds = [pa.int64(), pa.int32(), pa.list_(pa.int64()), *[pa.binary()] * 5]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)], names=["chunk", "shard", "docs", "counts", "stream", "sizes", "ids", "words"])

        ids, seen, stream, counts, size = [], {}, [], [], 0
        for whole in batches:
            for lo in range(0, whole.num_rows, 200):
                batch = whole.slice(lo, 200)
                for i, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                    t = t or ""
                    if size and size + len(t) > CHUNK:
                        yield rows()
                        ids, seen, stream, counts, size = [], {}, [], [], 0
                        trim()
                    got = np.array([seen.setdefault(w, len(seen)) for w in find(t)], np.uint32)
                    ids.append(i)
                    stream.append(got)
                    counts.append(len(got))
                    size += len(t)
        if ids:
            yield rows()

    return docs.mapInArrow(lean(cut), CHUNKS)


def gathered(asked: DataFrame, shards: int) -> DataFrame:
    """Rows of a shard, one after the other: its distinct words, PART to a row, then for each chunk that asks for some
    (chunk, at) their numbers."""
    kind = pa.list_(pa.struct([("chunk", pa.int64()), ("at", pa.binary())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, seen, asks, new = None, {}, [], []

        def row(last: bool) -> pa.RecordBatch:
            out = [pa.array([shard], pa.int32()), pa.array([new], pa.list_(pa.string())), pa.array([asks if last else None], kind)]
            return pa.RecordBatch.from_arrays(out, names=["shard", "words", "asks"])

        for batch in batches:
            for i in range(batch.num_rows):
                chunk, s, sizes, words = (c[i].as_py() for c in batch.columns)
                if s != shard:
                    if asks:
                        yield row(True)
                    shard, seen, asks, new = s, {}, [], []
                ends = np.cumsum(np.frombuffer(sizes, np.uint16), dtype=np.int64).tolist()
                at = np.empty(len(ends), np.uint32)
                for k, (a, b) in enumerate(zip([0, *ends], ends, strict=False)):
                    w = words[a:b]
                    n = seen.get(w)
                    if n is None:
                        n = seen[w] = len(seen)
                        new.append(w.decode("latin-1"))
                        if len(new) == PART:
                            yield row(False)
                            new = []
                    at[k] = n
                asks.append({"chunk": chunk, "at": at.tobytes()})
        if asks:
            yield row(True)

    return asked.repartition(shards, "shard").sortWithinPartitions("shard").mapInArrow(lean(run), "shard int, words array<string>, asks array<struct<chunk:bigint,at:binary>>")


def answers(merged: DataFrame) -> DataFrame:
    """chunk, shard, sizes, ids: the ids of the words that a chunk asked a shard for, in the order of its list. merged:
    the rows of gathered(), in its order, with ids in place of words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizes, ids = [], []
        for batch in batches:
            for b in range(batch.num_rows):
                lists = batch.column(1).slice(b, 1).flatten()
                sizes.append(np.diff(lists.offsets.to_numpy()).astype(np.int64))
                ids.append(lists.flatten().to_numpy(zero_copy_only=False).astype(np.uint32))
                if not batch.column(2)[b].is_valid:
                    continue
                lengths, values = np.concatenate(sizes), np.concatenate(ids)
                starts, shard, sizes, ids = np.cumsum(lengths) - lengths, batch.column(0)[b].as_py(), [], []
                for ask in batch.column(2)[b].as_py():
                    at = np.frombuffer(ask["at"], np.uint32)
                    out = (ask["chunk"], shard, lengths[at].astype(np.uint16).tobytes(), values[ragged(starts[at], lengths[at])].tobytes())
                    yield pa.RecordBatch.from_arrays([pa.array([c], t) for c, t in zip(out, (pa.int64(), pa.int32(), pa.binary(), pa.binary()), strict=True)], names=["chunk", "shard", "sizes", "ids"])

    return merged.mapInArrow(lean(run), "chunk bigint, shard int, sizes binary, ids binary")


def encode(docs: DataFrame, path: str, pattern: str, key: str = "doc_id", text: str = "text", keep_ids: bool = False) -> DataFrame:
    """Encodes every whole text and decodes it again.

    A task cuts its texts into words and writes, for each chunk of texts, the words as numbers (see chunks), bucketed by
    chunk, so that texts are not shuffled. The distinct words of a chunk go to their shards, where the distinct words of
    the whole corpus are merged once each by Spark's higher-order functions with the literal rank map; what returns to a
    chunk is ids in the order in which it asked. Each text's ids are then put together, and its bytes again by
    concatenating the binary pieces of its ids. A lost executor costs the chunks of its tasks.

    Returns doc_id, n_tokens, ids_sha256 (ids as little-endian unsigned 32-bit integers), decoded_sha256, and with
    keep_ids the ids. Null or empty text: no ids. Ids that are null or repeat are kept row by row; ties and repeated
    rows are encoded alike. Empty table: no rows. Other columns of docs are not read.
    """
    table, spark = ranks(path), docs.sparkSession
    shared, find = spark.sparkContext.broadcast(table), finder(pattern)
    shards = int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"bpe_chunks_{uuid.uuid4().hex}"
    rows = chunks(docs.select(F.col(f"`{key}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text")), shards, find, shared)
    rows.write.format("parquet").option("compression", "zstd").bucketBy(shards, "chunk").option("path", f"{shared_dir(spark)}/paperlake/{name}").saveAsTable(name)
    settle(spark)
    rows = spark.table(name)
    asked = gathered(rows.where("shard IS NOT NULL").select("chunk", "shard", "sizes", "words"), shards)
    done = answers(asked.select("shard", bound(table, lambda m: F.transform("words", lambda w: merged(w, m))).alias("merged"), "asks"))
    done = done.groupBy("chunk").agg(F.sort_array(F.collect_list(F.struct("shard", F.col("sizes").alias("s"), F.col("ids").alias("i")))).alias("done"))
    whole = rows.where("shard IS NULL").select("chunk", "docs", "counts", "stream", "sizes", "ids").join(done, "chunk", "left")

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = [b""] * (max(shared.value.values(), default=-1) + 1)
        for p, r in shared.value.items():
            pieces[r] = p
        for batch in batches:
            for b in range(batch.num_rows):
                parts = batch.column(6)[b].as_py() or []
                lengths = np.concatenate([np.frombuffer(batch.column(4)[b].as_py(), np.uint32), *[np.frombuffer(p["s"], np.uint16) for p in parts]]).astype(np.int64)
                values = np.frombuffer(batch.column(5)[b].as_py() + b"".join(p["i"] for p in parts), np.uint32)
                ends = np.cumsum(lengths)
                starts, decoded = ends - lengths, [pieces[x] for x in values.tolist()]
                words = [b"".join(decoded[x:y]) for x, y in zip(starts.tolist(), ends.tolist(), strict=True)]
                del parts, decoded
                ids = batch.column(1).slice(b, 1).flatten()
                trim()
                counts, at = np.frombuffer(batch.column(2)[b].as_py(), np.uint32), 0
                stream = unplaned(batch.column(3)[b].as_py(), int(counts.sum()))
                for lo in range(0, len(counts), 1000):
                    made = []
                    for n in counts[lo : lo + 1000].tolist():
                        own = stream[at : at + n]
                        at += n
                        got = values[ragged(starts[own], lengths[own])]
                        text = b"".join([words[x] for x in own.tolist()])
                        made.append((len(got), hashlib.sha256(got.astype("<u4").tobytes()).hexdigest(), hashlib.sha256(text).hexdigest(), got.astype(np.int32) if keep_ids else None))
                    out = [ids.slice(lo, 1000), *[pa.array([m[k] for m in made], t) for k, t in ((0, pa.int64()), (1, pa.string()), (2, pa.string()))]]
                    if keep_ids:
                        out.append(pa.array([m[3] for m in made], pa.list_(pa.int32())))
                    yield pa.RecordBatch.from_arrays(out, names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids"][: len(out)])

    return whole.mapInArrow(lean(put), "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * keep_ids)
