"""Collocations: phrases found by a sketch of all of them, counted exactly by automata, scored by their worst cut."""

from __future__ import annotations

import re
import time
from collections import defaultdict
from collections.abc import Iterator
from hashlib import blake2b
from zlib import crc32

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Run, finish, lean, save, settle, small_enough
from .hashing import U, mix

#: Bytes of text in a block, and of a row of it; n-grams that a shard of the sketch is meant for, and its cells (a power of
#: two); the most phrases of one automaton.
BLOCK, ROW, SHARD, CELLS, AUTOMATON = 16 << 20, 1 << 20, 1 << 22, 1 << 24, 250_000
#: What ends a piece becomes a line end, a tab a space, A to Z small letters.
PLAIN = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ.,;:!?\n\x0b\x0c\r\t", b"abcdefghijklmnopqrstuvwxyz" + b"\n" * 10 + b" ")
STEP = U(0x9E3779B97F4A7C15)
LONG = 512


def pieces(text: bytes) -> bytes:
    """Words parted by single spaces, pieces by a line end between spaces."""
    text = re.sub(rb"[ \n]*\n[ \n]*", b" \n ", text.translate(PLAIN))
    return re.sub(rb"  +", b" ", text).strip(b" \n")


def segments(text: bytes) -> Iterator[bytes]:
    """text in parts of ROW bytes at most, cut between pieces; a longer piece is a part of its own."""
    while len(text) > ROW:
        at = text.rfind(b" \n ", 0, ROW)
        at = at if at >= 0 else text.find(b" \n ")
        if at < 0:
            break
        yield text[:at]
        text = text[at + 3 :]
    if text:
        yield text


def blocks() -> Run:
    """A step from lang, text to block, lang, n (words), size, text: pieces of texts of one language, some ROW bytes (size) a
    row, packed. Blocks are numbered by task, so this step's result is written before anything refers to them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[bytes]] = defaultdict(list)
        sizes: dict[str, int] = defaultdict(int)
        block, filled = TaskContext.get().partitionId() << 24, 0

        def row(lang: str) -> pa.RecordBatch:
            text = b" \n ".join(held.pop(lang))
            sizes.pop(lang)
            n = text.count(b" ") - text.count(b"\n") + 1
            data = pa.Codec("zstd").compress(text, asbytes=True)
            return pa.RecordBatch.from_arrays([pa.array([block], pa.int64()), pa.array([lang]), pa.array([n], pa.int64()), pa.array([len(text)], pa.int64()), pa.array([data], pa.binary())], names=["block", "lang", "n", "size", "text"])

        for batch in batches:
            for lang, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                for part in segments(pieces(text)):
                    held[lang].append(part)
                    sizes[lang] += len(part)
                    filled += len(part)
                    if sizes[lang] >= ROW:
                        yield row(lang)
                    if filled >= BLOCK:
                        for one in sorted(held):
                            yield row(one)
                        block, filled = block + 1, 0
        for lang in sorted(held):
            yield row(lang)

    return lean(run)


def unpacked(rows: pa.RecordBatch | pa.Table) -> Iterator[tuple[int, str, bytes]]:
    """block, lang, text of rows that blocks() has made."""
    for block, lang, size, text in zip(*(rows.column(c) for c in ("block", "lang", "size", "text")), strict=True):
        yield block.as_py(), lang.as_py(), pa.Codec("zstd").decompress(text.as_py(), size.as_py(), asbytes=True)


def packed(cells: np.ndarray) -> bytes:
    """Ascending numbers: the bytes of their differences, place by place."""
    return pa.Codec("zstd").compress(np.diff(cells, prepend=np.uint32(0)).astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes(), asbytes=True)


def cells_of(data: bytes, n: int) -> np.ndarray:
    planes = np.frombuffer(pa.Codec("zstd").decompress(data, 4 * n, asbytes=True), np.uint8).reshape(4, n)
    return np.cumsum(np.ascontiguousarray(planes.T).view("<u4").ravel(), dtype=np.uint32)


class Grams:
    """Runs of words of normalised texts as 64-bit numbers. A word's number is a polynomial of its bytes (a longer one's,
    for whose patterns polynomials of this kind may agree, a digest)."""

    def __init__(self, longest: int):
        self.longest, self.powers, self.inverses = longest, np.ones(1, U), np.ones(1, U)

    def __call__(self, lang: str, text: bytes) -> tuple[np.ndarray, np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
        """Where words begin and end; and for 1 to `longest` words the numbers of runs and the places of their first words."""
        a = np.frombuffer(text, np.uint8)
        if len(self.powers) <= len(a):
            self.powers = np.concatenate([[U(1)], np.cumprod(np.full(len(a) + 1, STEP | U(1)))])
            self.inverses = np.concatenate([[U(1)], np.cumprod(np.full(len(a) + 1, U(pow(int(STEP | U(1)), -1, 2**64))))])
        edge = np.flatnonzero(np.diff(np.concatenate([[False], (a != 32) & (a != 10), [False]])))
        begin, end = edge[::2], edge[1::2]
        sums = np.concatenate([[U(0)], np.cumsum((a.astype(U) + U(1)) * self.powers[: len(a)])])
        words = mix((sums[end] - sums[begin]) * self.inverses[begin] + (end - begin).astype(U))
        for i in np.flatnonzero(end - begin > LONG):
            words[i] = int.from_bytes(blake2b(text[begin[i] : end[i]], digest_size=8).digest(), "little")
        lines = np.flatnonzero(a == 10)
        piece = np.searchsorted(lines, begin)
        seed = U(int.from_bytes(blake2b(lang.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little"))
        now, places, out = mix(words ^ seed), np.arange(len(begin)), []
        for n in range(1, self.longest + 1):
            out.append((now, places))
            more = np.flatnonzero(places + n < len(begin))
            more = more[piece[places[more]] == piece[places[more] + n]]
            places = places[more]
            now = mix(now[more] * U(3) + mix(words[places + n] + U(n)))
        return begin, end, out


def sketch(longest: int, shards: int) -> Run:
    """A step from block, lang, n, size, text to block, shard, cells, counts (a byte each): how often runs of words fall into
    the sketch's cells, summed a block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams, held, now = Grams(longest), [], None

        def counted() -> Iterator[pa.RecordBatch]:
            keys, counts = np.unique(np.concatenate(held), return_counts=True)
            held.clear()
            shard = (keys // U(CELLS)).astype(np.int64)
            edges = np.concatenate([[0], np.flatnonzero(np.diff(shard)) + 1, [len(shard)]]).tolist()
            cells, counts = (keys % U(CELLS)).astype(np.uint32), np.minimum(counts, 255).astype(np.uint8)
            spans = list(zip(edges[:-1], edges[1:], strict=True))
            for at in range(0, len(spans), 256):
                part = spans[at : at + 256]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([now] * len(part), pa.int64()), pa.array([int(shard[i]) for i, _ in part], pa.int64()), pa.array([packed(cells[i:j]) for i, j in part], pa.binary()), pa.array([counts[i:j].tobytes() for i, j in part], pa.binary())],
                    names=["block", "shard", "cells", "counts"],
                )

        for batch in batches:
            for block, lang, text in unpacked(batch):
                if held and block != now:
                    yield from counted()
                now = block
                for h, _ in grams(lang, text)[2]:
                    held.append(place(h, shards))
        if held:
            yield from counted()

    return lean(run)


def place(h: np.ndarray, shards: int) -> np.ndarray:
    """The cell, among those of all shards, of a run of words."""
    return (h >> U(32)) % U(shards) * U(CELLS) + h % U(CELLS)


def heavy(least: int):
    """A step for one shard: which of each block's cells hold `least` or more over all blocks."""

    def run(t: pa.Table) -> pa.Table:
        total = np.zeros(CELLS, np.uint16)
        counts = [np.frombuffer(x.as_py(), np.uint8) for x in t.column("counts")]
        cells = [cells_of(x.as_py(), len(n)) for x, n in zip(t.column("cells"), counts, strict=True)]
        for c, n in zip(cells, counts, strict=True):
            total[c] = np.minimum(total[c] + n, 60_000)
        enough = total >= least
        kept = [c[enough[c]] for c in cells]
        return pa.table({"block": t.column("block"), "shard": t.column("shard"), "n": pa.array([len(c) for c in kept], pa.int64()), "cells": pa.array(list(map(packed, kept)), pa.binary())})

    return run


def counting(longest: int, shards: int, parts: int):
    """A step for one block: its texts, and the keys of its heavy cells. The runs of words in these cells are its
    candidates; automata of AUTOMATON of them at most, guarded by spaces, find all places where they occur. What it has
    counted leaves in `parts` parts by the phrase, packed: part, lang, n (phrases), size, phrases, counts."""

    def run(texts: pa.Table, marks: pa.Table) -> pa.Table:
        out = []
        bits = np.zeros(1 << 24, np.uint8)
        for shard, n, cells in zip(*(marks.column(c).to_pylist() for c in ("shard", "n", "cells")), strict=True):
            k = mix(cells_of(cells, n).astype(U) + U(shard) * U(CELLS))
            np.bitwise_or.at(bits, (k >> U(3) & U((1 << 24) - 1)).astype(np.int64), (1 << (k & U(7)).astype(np.uint8)).astype(np.uint8))
        grams, of = Grams(longest), defaultdict(list)
        for _, lang, text in unpacked(texts):
            of[lang].append(text)
        for lang in sorted(of):
            known, found = np.zeros(0, U), []
            for text in of[lang]:
                begin, end, runs = grams(lang, text)
                for n, (h, first) in enumerate(runs):
                    k = mix(place(h, shards))
                    marked = np.flatnonzero(bits[(k >> U(3) & U((1 << 24) - 1)).astype(np.int64)] >> (k & U(7)).astype(np.uint8) & 1)
                    new, at = np.unique(h[marked], return_index=True)
                    fresh = ~np.isin(new, known, assume_unique=True)
                    known = np.concatenate([known, new[fresh]])
                    first = first[marked[at[fresh]]]
                    found += [text[a:b] for a, b in zip(begin[first].tolist(), end[first + n].tolist(), strict=True)]
            found = sorted(set(found))
            whole = f" {b' \n '.join(of.pop(lang)).decode('utf-8', 'surrogateescape')} "
            for a in range(0, len(found), AUTOMATON):
                some = found[a : a + AUTOMATON]
                automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
                for i, p in enumerate(some):
                    automaton.add_word(f" {p.decode('utf-8', 'surrogateescape')} ", i)
                automaton.make_automaton()
                times = np.bincount(np.fromiter((i for _, i in automaton.iter(whole)), np.int64), minlength=len(some)).astype("<u4")
                part = np.fromiter((crc32(p) % parts for p in some), np.int64, len(some))
                order = np.argsort(part, kind="stable")
                for rows in np.split(order, np.flatnonzero(np.diff(part[order])) + 1):
                    data = b"\n".join([some[i] for i in rows.tolist()])
                    out.append((int(part[rows[0]]), lang, len(rows), len(data), pa.Codec("zstd").compress(data, asbytes=True), times[rows].tobytes()))
        kinds = {"part": pa.int64(), "lang": pa.string(), "n": pa.int64(), "size": pa.int64(), "phrases": pa.binary(), "counts": pa.binary()}
        return pa.table({c: pa.array([r[i] for r in out], t) for i, (c, t) in enumerate(kinds.items())})

    return run


def summing(least: int):
    """A step for one part of a language's phrases: phrase and f of those that were counted `least` times or more."""

    def run(t: pa.Table) -> pa.Table:
        names = [p for size, data in zip(t.column("size").to_pylist(), t.column("phrases"), strict=True) for p in pa.Codec("zstd").decompress(data.as_py(), size, asbytes=True).split(b"\n")]
        counts = np.concatenate([np.frombuffer(c.as_py(), "<u4") for c in t.column("counts")]).astype(np.int64)
        sums = pa.table({"phrase": pa.array(names, pa.binary()), "f": pa.array(counts)}).group_by("phrase").aggregate([("f", "sum")])
        sums = sums.filter(pa.compute.greater_equal(sums.column("f_sum"), least))
        return pa.table({"lang": pa.array([t.column("lang")[0].as_py()] * len(sums), pa.string()), "phrase": sums.column("phrase"), "f": sums.column("f_sum")})

    return run


def frequencies(docs: DataFrame, least: int, longest: int, text: str, lang: str) -> tuple[DataFrame, DataFrame]:
    """lang, phrase, f of all runs of 1 to `longest` words that occur `least` times or more in a language, a written table;
    and lang, n (words of it)."""
    of = lambda c: F.col(f"`{c}`")
    rows = docs.select(F.coalesce(of(lang).cast("string"), F.lit("und")).alias("lang"), of(text).cast("string").cast("binary").alias("text")).where("text IS NOT NULL")
    texts = save(rows.mapInArrow(blocks(), "block bigint, lang string, n bigint, size bigint, text binary"), "texts")
    words = save(texts.groupBy("lang").agg(F.sum("n").alias("n")), "words")
    shards = max(1, -(-longest * (words.agg(F.sum("n")).first()[0] or 0) // SHARD))
    cells = texts.mapInArrow(sketch(longest, shards), "block bigint, shard bigint, cells binary, counts binary")
    marks = save(cells.groupBy("shard").applyInArrow(heavy(least), "block bigint, shard bigint, n bigint, cells binary"), "marks")
    time.sleep(1)  # until the end of that step has been told to all who listen, and none refers to it
    settle(docs.sparkSession)  # the cells have been summed; what they took of the disk goes
    parts = -(-shards // 4)
    counted = texts.groupBy("block").cogroup(marks.groupBy("block")).applyInArrow(counting(longest, shards, parts), "part bigint, lang string, n bigint, size bigint, phrases binary, counts binary")
    summed = counted.groupBy("part", "lang").applyInArrow(summing(least), "lang string, phrase binary, f bigint")
    out = save(summed.select("lang", F.col("phrase").cast("string").alias("phrase"), "f"), "phrases")
    finish(texts, marks)
    return out, words


def part(a: Column | int, n: Column | int) -> Column:
    """n words of a phrase from its a-th (from 1) on."""
    return F.array_join(F.slice("words", a, n), " ")


def collocations(docs: DataFrame, least: int = 10, longest: int = 3, cover: int = 50, top: int = 2000, text: str = "text", lang: str = "lang") -> DataFrame:
    """The best phrases of each language: lang, rank (from 1), phrase, a, l, r, n, score.

    A-Z are lower-cased, [.,;:!?] and line ends part pieces, spaces and tabs part words. a is how often a phrase of 2 to
    `longest` words occurs within pieces, overlaps counted, `least` at least; l and r are those counts of the two parts of
    its lowest-scoring cut (of equals the first), n the language's words, and score floor(1000000 a a / (l r)). Phrases
    that a longer one holds which occurs `cover` percent as often are left out. The first `top` of a language by score, a
    (both descending) and phrase (bytes) are returned.

    Each block of texts sums its runs of words into a sketch whose shards grow in number with the corpus; a cell of
    `least` or more goes back to the blocks that filled it. So a block's automata hold its own candidates only, none that
    is frequent enough is missing, and the counts that are summed are exact, whatever shares a cell.

    A null language is `und`, a null or empty text has no words; repeated rows count as often as they stand there; an empty
    table gives no rows. Other columns are not read.
    """
    f, words = frequencies(docs, least, longest, text, lang)
    named = lambda c, n: f.select(F.col("lang").alias(f"{n}_lang"), F.col("phrase").alias(c), F.col("f").alias(n))
    candidates = f.withColumn("words", F.split("phrase", " ")).withColumn("size", F.size("words")).where("size > 1")
    cuts = candidates.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1)))
    cuts = cuts.select("lang", "phrase", F.col("f").alias("a"), "k", part(F.lit(1), F.col("k")).alias("first"), part(F.col("k") + 1, F.col("size")).alias("rest"))
    cuts = cuts.join(named("p", "l"), (F.col("lang") == F.col("l_lang")) & (F.col("first") == F.col("p"))).drop("p")
    cuts = cuts.join(named("p", "r"), (F.col("lang") == F.col("r_lang")) & (F.col("rest") == F.col("p")))
    exact = lambda c: F.col(c).cast("decimal(38,0)")
    cuts = cuts.withColumn("top", exact("a") * exact("a") * F.lit(1_000_000)).withColumn("under", exact("l") * exact("r"))
    scored = cuts.withColumn("score", F.expr("top DIV under")).groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut")).select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
    inner = candidates.where("size > 2").withColumn("m", F.explode(F.sequence(F.lit(2), F.col("size") - 1))).withColumn("i", F.explode(F.sequence(F.lit(1), F.col("size") - F.col("m") + 1)))
    covers = inner.select("lang", part(F.col("i"), F.col("m")).alias("phrase"), "f").groupBy("lang", "phrase").agg(F.max("f").alias("most"))
    kept = scored.join(covers, ["lang", "phrase"], "left").where(F.col("most").isNull() | (F.col("most") * 100 < F.col("a") * cover)).drop("most")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # a language may hold most phrases: its best are first sought in 64 parts
    some = kept.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(64))).withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))).where(F.col("rank") <= top)
    best = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)
    return best.join(small_enough(words), "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, doc_id, generate_subscripts(ps, 1) AS piece, unnest(ps) AS piece_text
  FROM (SELECT *, regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\n\x0b\x0c\r]') AS ps FROM documents)),
lists AS (SELECT lang, list_filter(regexp_split_to_array(piece_text, '[ \t]+'), lambda x: x <> '') AS w FROM pieces),
totals AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM lists GROUP BY lang),
runs AS (
  SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS phrase
  FROM lists, (VALUES (1), (2), (3)) AS sizes(k) WHERE len(w) >= k),
f AS (SELECT lang, phrase, k, count(*) AS f FROM runs GROUP BY lang, phrase, k HAVING count(*) >= 10),
cuts AS (
  SELECT lang, phrase, f AS a, unnest(range(1, k)) AS cut, string_split(phrase, ' ') AS w FROM f WHERE k > 1),
scores AS (
  SELECT c.lang, c.phrase, c.a, c.cut, x.f AS l, y.f AS r, (1000000::HUGEINT * c.a * c.a) // (x.f::HUGEINT * y.f) AS score
  FROM cuts c JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[:c.cut], ' ')
  JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[c.cut + 1:], ' ')),
worst AS (SELECT * FROM scores QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
inner_runs AS (
  SELECT lang, f, unnest([array_to_string(string_split(phrase, ' ')[1:2], ' '), array_to_string(string_split(phrase, ' ')[2:3], ' ')]) AS phrase FROM f WHERE k = 3),
covers AS (SELECT lang, phrase, max(f) AS most FROM inner_runs GROUP BY lang, phrase),
kept AS (SELECT w.* FROM worst w LEFT JOIN covers c ON c.lang = w.lang AND c.phrase = w.phrase WHERE c.most IS NULL OR 100 * c.most < 50 * w.a)
SELECT k.lang, rank, phrase, a, l, r, t.n, CAST(score AS BIGINT) AS score
FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept) k JOIN totals t ON t.lang = k.lang
WHERE rank <= 2000
"""
