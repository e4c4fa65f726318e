"""N-gram Jaccard join by chosen paths, with exact links."""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import connected, finish, lean, save, settle, small_enough
from .hashing import U, WordHashes, mix, shingles

#: Share of the pairs at the least similarity that must meet in a bucket of the deepest level; the recursion's depth; and
#: the largest bucket that is compared pair by pair where it stands.
TARGET, DEPTH, SMALL = 0.9999, 3, 2048
#: Coordinates of a sketch (one byte each); how many must agree before two sets are looked at closely; and from how many
#: on a set is alike enough to its bucket's head to be left to it in this bucket. That happens at 0.8 or so; what links to
#: such a set at 0.8 is then at 0.6 or so to the head (by the triangle inequality), where fewer than NEAR agree in one of
#: 100,000 pairs, and at 0.8 in none of 10**12.
SKETCH, NEAR, SURE = 64, 22, 52
#: Sets that one task compares with as many others at a time, and about how many of their n-grams are held for it.
BLOCK, SLICE = 128, 1 << 18


def runs_needed(target: float = TARGET, depth: int = DEPTH) -> int:
    """Runs until a pair at the least similarity meets at the last level with probability `target`. At a node the two take
    one shared token on average in the worst case (one set within the other), so a run fails with exp(-(1 - fail of the
    levels below))."""
    fail = 0.0
    for _ in range(depth):
        fail = math.exp(fail - 1)
    return math.ceil(math.log(1 - target) / math.log(fail))


def children(tokens: np.ndarray, parents: np.ndarray, level: int, similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """Which of the nodes a set goes on from, and the nodes it goes to. At each node it takes the tokens whose hash,
    seeded by the node's own path, is under 1 / (similarity * size): two similar sets share one such token on average,
    whereas unlike sets share few tokens to take. So the recursion needs the set alone and not the others in its bucket."""
    top = U(int(min(2.0**64 / (similarity * len(tokens)), 2.0**64 - 2048)))
    by, found = (mix(parents) | U(1))[:, None], []
    for a in range(0, len(tokens), 4096):
        p, t = np.nonzero(tokens[None, a : a + 4096] * by < top)
        found.append((p, t + a))
    p, t = (np.concatenate(x) for x in zip(*found, strict=True))
    return p, mix(parents[p] + mix(tokens[t] + U(level + 1)))


MULTIPLIERS = mix(np.arange(1, SKETCH + 1, dtype=U) * U(0xA0761D6478BD642F)) | U(1)


def sketch(tokens: np.ndarray) -> bytes:
    """The last byte of each of SKETCH minima under different hash functions."""
    best = np.full(SKETCH, 2**64 - 1, U)
    for a in range(0, len(tokens), 4096):
        best = np.minimum(best, (MULTIPLIERS[:, None] * tokens[None, a : a + 4096]).min(1))
    return mix(best).astype(np.uint8).tobytes()


def keyed(docs: DataFrame, key: str, text: str) -> DataFrame:
    """doc_id, th (a hash of the text, which tells rows apart that repeat an id), text."""
    of = F.col(f"`{text}`").cast("string")
    return docs.select(F.col(f"`{key}`").cast("long").alias("doc_id"), F.xxhash64(of).alias("th"), of.alias("text"))


def signatures(docs: DataFrame, similarity: float, words: int, runs: int) -> DataFrame:
    """doc_id, th, same (hash of the set; null: no words), sketch, nodes of the first level."""
    roots = mix(np.arange(1, runs + 1, dtype=U) * U(0x9E3779B97F4A7C15))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for whole in batches:
            for at in range(0, whole.num_rows, 500):
                batch = whole.slice(at, 500)
                same, sketches, nodes = [], [], []
                for t in batch.column(2).to_pylist():
                    s = shingles(hashes(t), words)
                    same.append(blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None)
                    sketches.append(sketch(s) if len(s) else None)
                    nodes.append(np.unique(children(s, roots, 0, similarity)[1]).view(np.int64) if len(s) else np.zeros(0, np.int64))
                offsets = pa.array(np.cumsum([0, *map(len, nodes)]), pa.int32())
                flat = pa.array(np.concatenate([np.zeros(0, np.int64), *nodes]))
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(same, pa.binary()), pa.array(sketches, pa.binary()), pa.ListArray.from_arrays(offsets, flat)], names=["doc_id", "th", "same", "sketch", "nodes"])

    return docs.mapInArrow(lean(run), "doc_id bigint, th bigint, same binary, sketch binary, nodes array<bigint>")


def deeper(texts: DataFrame, level: int, similarity: float, words: int) -> DataFrame:
    """rid, node: where sets go from the nodes they are at. texts: rid, text, parents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes(100_000)
        for batch in batches:
            for rid, t, parents in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                nodes = np.unique(children(shingles(hashes(t), words), np.array(parents, np.int64).view(U), level, similarity)[1])
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(nodes), rid, np.int64)), pa.array(nodes.view(np.int64))], names=["rid", "node"])

    return texts.select("rid", "text", "parents").mapInArrow(lean(run), "rid bigint, node bigint")


def groups(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.Table]:
    """Runs of rows that agree in their first columns, of input sorted by them."""
    held: list[pa.RecordBatch] = []
    for b in batches:
        if not b.num_rows:
            continue
        change = np.zeros(b.num_rows, bool)
        for k in range(keys):
            x = b.column(k).to_numpy(zero_copy_only=False)
            change[1:] |= x[1:] != x[:-1]
            if held and held[-1].column(k)[-1] != b.column(k)[0]:
                change[0] = True
        cuts = np.flatnonzero(change).tolist()
        for a, e in zip([0, *cuts], [*cuts, b.num_rows], strict=True):
            if a in cuts and held:
                yield pa.Table.from_batches(held)
                held = []
            if e > a:
                held.append(b.slice(a, e - a))
    if held:
        yield pa.Table.from_batches(held)


def spanning(n: int, a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
    """Edges among (a, b) that connect as much as all of them."""
    up = list(range(n))

    def root(x: int) -> int:
        while up[x] != x:
            up[x] = x = up[up[x]]
        return x

    out = []
    for x, y in zip(a.tolist(), b.tolist(), strict=True):
        p, q = root(x), root(y)
        if p != q:
            up[max(p, q)] = min(p, q)
            out.append((x, y))
    return out


def agreeing(s: np.ndarray) -> np.ndarray:
    """In how many coordinates each two of some sketches agree."""
    if len(s) <= 32:
        return (s[:, None, :] == s[None, :, :]).sum(2)
    out = np.zeros((len(s), len(s)), np.uint8)
    for c in np.ascontiguousarray(s.T):
        out += c[:, None] == c[None, :]
    return out


def stars(near: np.ndarray) -> list[tuple[int, int]]:
    """From the first of all that a symmetric matrix connects to each of the others."""
    np.fill_diagonal(near, False)
    left, out = near.any(1), []
    for x in np.flatnonzero(left).tolist():
        front = [x] if left[x] else []
        left[x] = False
        while len(front):
            front = np.flatnonzero(near[front].any(0) & left)
            left[front] = False
            out += [(x, y) for y in front.tolist()]
    return out


def alike(rows: DataFrame) -> DataFrame:
    """rows: node, rid, sketch, in buckets of at most SMALL. Edges (src, dst) between sets whose sketches agree enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        src, dst, up = [], [], {}

        def root(x: int) -> int:
            while up.setdefault(x, x) != x:
                up[x] = x = up[up[x]]
            return x

        for t in groups(batches, 1):
            if t.num_rows > 1:
                rid = t.column(1).to_numpy()
                s = np.frombuffer(b"".join(t.column(2).to_pylist()), np.uint8).reshape(-1, SKETCH)
                for x, y in stars(agreeing(s) >= NEAR):
                    a, b = root(int(rid[x])), root(int(rid[y]))
                    if a != b:  # not yet connected by this task's other buckets
                        up[max(a, b)] = min(a, b)
                        src.append(rid[x])
                        dst.append(rid[y])
            if len(src) > 5000:
                yield pa.RecordBatch.from_arrays([pa.array(src, pa.int64()), pa.array(dst, pa.int64())], names=["src", "dst"])
                src, dst = [], []
        yield pa.RecordBatch.from_arrays([pa.array(src, pa.int64()), pa.array(dst, pa.int64())], names=["src", "dst"])

    n = rows.sparkSession.conf.get("spark.sql.shuffle.partitions")
    return rows.select("node", "rid", "sketch").repartition(int(n), "node").sortWithinPartitions("node").mapInArrow(lean(run), "src bigint, dst bigint").distinct()


def candidates(sets: DataFrame, texts, similarity: float, words: int, depth: int = DEPTH) -> tuple[DataFrame, list[DataFrame]]:
    """Edges (src, dst) that connect all sets worth comparing, and the written tables that they come from.

    sets: rid, sketch, nodes; texts: a function that joins texts to a table with rid. Level by level: buckets of at most
    SMALL sets are compared by their sketches. In each larger bucket all sets are compared with its smallest, the head;
    those that are alike for sure leave this bucket to it. Then all edges so far are joined to groups: a bucket whose sets
    are of one group has done its work, since a group is compared exactly, each with each, in the end. Only what is open in
    a bucket of several groups goes on to the next level from there. What is still in large buckets at the last level is
    compared in blocks, each with each. So neither a group of near copies nor a passage that its sets mostly consist of
    makes a set recurse, and nothing but its own bucket's sets speaks for leaving it. Sketches are fetched only for sets
    that share a bucket.
    """
    sketches, found, used = sets.select("rid", "sketch"), [], []
    keep = lambda df, name: used.append(save(df, name)) or used[-1]
    rows = sets.select("rid", F.explode("nodes").alias("node"))
    for level in range(depth):
        counts = small_enough(keep(rows.groupBy("node").agg(F.count("*").alias("n")).where("n > 1"), "buckets"))
        shared = keep(rows.join(counts, "node").join(sketches, "rid"), "shared")
        found.append(keep(alike(shared.where(F.col("n") <= SMALL)), "pairs"))
        large = shared.where(F.col("n") > SMALL)
        if not large.limit(1).count():
            break
        heads = keep(large.groupBy("node").agg(F.min(F.struct("rid", "sketch")).alias("h")).select("node", F.col("h.rid").alias("first"), F.col("h.sketch").alias("head")), "heads")
        same = F.size(F.filter(F.sequence(F.lit(1), F.lit(SKETCH)), lambda i: F.substring("sketch", i, F.lit(1)) == F.substring("head", i, F.lit(1))))
        compared = keep(large.join(small_enough(heads), "node").withColumn("agree", same).where("rid <> first").select("node", "rid", "sketch", "first", "agree"), "compared")
        found.append(compared.where(F.col("agree") >= NEAR).select(F.col("first").alias("src"), F.col("rid").alias("dst")).distinct())
        parts = keep(connected(reduce(DataFrame.unionByName, found)).withColumnRenamed("node", "rid"), "groups")
        found = [parts.select(F.col("component").alias("src"), F.col("rid").alias("dst"))]
        members = compared.select("node", "rid").unionByName(heads.select("node", F.col("first").alias("rid"))).join(parts, "rid", "left").withColumn("of", F.coalesce("component", "rid"))
        mixed = keep(members.groupBy("node").agg(F.min("of").alias("a"), F.max("of").alias("b")).where("a <> b").select("node"), "mixed")
        open_ = keep(compared.where(F.col("agree") < SURE).join(small_enough(mixed), "node", "left_semi").select("node", "rid", "sketch"), "open")
        if level < depth - 1:
            parents = open_.groupBy("rid").agg(F.collect_list("node").alias("parents"))
            rows = keep(deeper(texts(parents), level + 1, similarity, words), "nodes")
        else:
            sizes = open_.groupBy("node").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
            rest = open_.join(sizes, "node").withColumn("own", F.pmod(F.xxhash64("node", "rid"), "blocks").cast("int"))
            rest = rest.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
            found.append(keep(alike(rest.select(F.xxhash64("node", F.least("own", "other"), F.greatest("own", "other")).alias("node"), "rid", "sketch")), "pairs"))
    settle(sets.sparkSession)
    return reduce(DataFrame.unionByName, found), used


def verified(members: DataFrame, similarity: float, words: int) -> DataFrame:
    """members: comp, x, y (a pair of blocks), own (block), rid, copies, text. Compares the sets of block x with those
    of block y exactly. Rows: (rid, links) with the copies of sets linked to it, and (rid, to) for edges that connect
    all that is linked."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes(100_000)
        rid, links, to = [], [], []
        for t in groups(batches, 3):
            x, y = t.column(1)[0].as_py(), t.column(2)[0].as_py()
            own, ids, copies = (t.column(c).to_numpy() for c in (3, 4, 5))
            sets = [shingles(hashes(s), words) for s in t.column(6).to_pylist()]
            n = np.array([len(s) for s in sets])
            both = np.zeros((len(sets), len(sets)), np.float32)
            # sets are sorted: a range of hashes, SLICE of them or so, is a slice of each
            ranges = int(n.sum()) // SLICE + 1
            ends = [np.searchsorted(s, np.array([2**64 * k // ranges for k in range(1, ranges)], U)) for s in sets]
            ends = np.array([[0, *e, m] for e, m in zip(ends, n.tolist(), strict=True)])
            for k in range(ranges):
                part = [s[a:b] for s, a, b in zip(sets, ends[:, k], ends[:, k + 1], strict=True)]
                _, which = np.unique(np.concatenate(part), return_inverse=True)
                row = np.repeat(np.arange(len(sets)), ends[:, k + 1] - ends[:, k])
                order = np.argsort(which, kind="stable")
                which, row = which[order], row[order]
                width, top = 4096, which[-1] + 1 if len(which) else 0
                for a in range(0, top, width):
                    lo, hi = np.searchsorted(which, [a, a + width])
                    m = np.zeros((len(sets), width), np.float32)
                    m[row[lo:hi], which[lo:hi] - a] = 1
                    both += m @ m.T
            linked = both >= similarity * (n[:, None] + n[None, :] - both) - 1e-6
            np.fill_diagonal(linked, False)
            if x != y:
                linked &= own[:, None] != own[None, :]
            count = linked @ copies
            for i in np.flatnonzero(count):
                rid.append(ids[i])
                links.append(count[i])
                to.append(None)
            for a, b in spanning(len(ids), *np.nonzero(np.triu(linked))):
                rid.append(ids[a])
                links.append(0)
                to.append(ids[b])
            if len(rid) > 5000:
                yield pa.RecordBatch.from_arrays([pa.array(rid, pa.int64()), pa.array(links, pa.int64()), pa.array(to, pa.int64())], names=["rid", "links", "to"])
                rid, links, to = [], [], []
        yield pa.RecordBatch.from_arrays([pa.array(rid, pa.int64()), pa.array(links, pa.int64()), pa.array(to, pa.int64())], names=["rid", "links", "to"])

    n = members.sparkSession.conf.get("spark.sql.shuffle.partitions")
    return members.select("comp", "x", "y", "own", "rid", "copies", "text").repartition(int(n), "comp", "x", "y").sortWithinPartitions("comp", "x", "y").mapInArrow(lean(run), "rid bigint, links bigint, to bigint")


def classes(docs: DataFrame, similarity: float, words: int, key: str, text: str) -> DataFrame:
    """One row a document: doc_id, th, class_id, class_th (those of the class's smallest doc_id and th), n_links."""
    docs, runs = keyed(docs, key, text), runs_needed()
    rows = save(signatures(docs, similarity, words, runs), "signatures")
    usable = rows.where("doc_id IS NOT NULL AND same IS NOT NULL")
    # a set is known by a number; of its copies the smallest lends it the text
    sets = save(usable.groupBy("same").agg(F.min(F.struct("doc_id", "th")).alias("at"), F.count("*").alias("copies")).select("same", "at.*", "copies").withColumn("rid", F.monotonically_increasing_id()), "sets")
    whole = save(usable.join(small_enough(sets).select("rid", "same", "doc_id", "th"), ["same", "doc_id", "th"]).select("rid", "sketch", "nodes").dropDuplicates(["rid"]), "firsts")

    def texts(some: DataFrame) -> DataFrame:
        named = save(some.join(sets.select("rid", "doc_id", "th"), "rid"), "wanted")
        return docs.join(small_enough(named), ["doc_id", "th"]).dropDuplicates(["rid"])

    edges, used = candidates(whole, texts, similarity, words)
    comps = save(connected(edges).withColumnRenamed("node", "rid").withColumnRenamed("component", "comp"), "groups")
    finish(whole, *used)
    sizes = comps.groupBy("comp").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    members = comps.join(sizes, "comp").join(sets.select("rid", "copies"), "rid")
    members = members.withColumn("own", F.pmod(F.xxhash64("rid"), "blocks").cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    members = members.select("comp", F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y"), "own", "rid", "copies")
    found = save(verified(members.join(texts(comps.select("rid")).select("rid", "text"), "rid"), similarity, words), "links")
    linked = connected(found.where("to IS NOT NULL").select(F.col("rid").alias("src"), F.col("to").alias("dst")))
    ends = sets.select("rid", F.struct("doc_id", "th").alias("at"))
    final = save(linked.withColumnRenamed("node", "rid").join(ends, "rid"), "classes")
    final = final.join(final.groupBy("component").agg(F.min("at").alias("head")), "component").select("rid", "head")
    links = found.where("to IS NULL").groupBy("rid").agg(F.sum("links").alias("links"))
    out = sets.join(final, "rid", "left").join(links, "rid", "left")
    out = save(out.select("same", F.coalesce("head", F.struct("doc_id", "th")).alias("head"), (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links")), "classes")
    settle(docs.sparkSession)
    named = rows.select("doc_id", "th", F.when(F.col("doc_id").isNotNull(), F.col("same")).alias("same")).join(small_enough(out), "same", "left")
    return named.select("doc_id", "th", F.coalesce("head.doc_id", "doc_id").alias("class_id"), F.coalesce("head.th", "th").alias("class_th"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))


def join(docs: DataFrame, similarity: float = 0.8, words: int = 5, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row a document: doc_id, class_id (smallest doc_id that links lead to), n_links (documents linked directly).

    Two documents link if the Jaccard similarity of their sets of word n-grams is `similarity` or more. Documents with
    equal sets are one set with a count. Chosen paths find what is worth comparing (see children, candidates): runs are
    as many as bring a pair at 0.8 together with probability TARGET even if only buckets of the deepest level compare
    it. Each group so connected is then compared exactly, all sets with all sets in blocks of BLOCK, so links are
    counted without writing pairs, those that no path found included; only edges that connect a group are passed on.

    Nulls and empty texts have no words and link with nothing. A text of fewer words than `words` is one n-gram. Rows
    without an id take no part and are returned with null class and 0 links. Rows that repeat an id, with equal texts or
    others, count as documents of their own in n_links. Empty table: no rows. Other columns are not read.
    """
    return classes(docs, similarity, words, key, text).select("doc_id", "class_id", "n_links")


def keep_one(docs: DataFrame, similarity: float = 0.8, words: int = 5, key: str = "doc_id", text: str = "text") -> DataFrame:
    """docs without the documents whose class has one of smaller id (of equal ids: of smaller hash of the text). Rows
    without id stay. Of rows that agree in id and text one stays, that whose other columns come first as JSON."""
    of = classes(docs, similarity, words, key, text).where("doc_id = class_id AND th = class_th")
    kept = save(of.groupBy("doc_id", "th").agg((F.count("*") > 1).alias("more")), "kept")
    names = lambda more: small_enough(save(kept.where("more" if more else "NOT more").select(F.col("doc_id").alias("__near_id"), F.col("th").alias("__near_th")), "kept"))
    own = (F.col(f"`{key}`").cast("long") == F.col("__near_id")) & (F.xxhash64(F.col(f"`{text}`").cast("string")) == F.col("__near_th"))
    rest = docs.join(names(True), own, "inner")
    order = F.to_json(F.struct(*[F.col(f"`{c}`") for c in docs.columns]))
    rest = rest.withColumn("__near_at", F.row_number().over(Window.partitionBy("__near_id", "__near_th").orderBy(order))).where("__near_at = 1")
    rest = rest.select(*[F.col(f"`{c}`") for c in docs.columns])
    return docs.join(names(False), own, "left_semi").unionByName(rest).unionByName(docs.where(F.col(f"`{key}`").isNull()))
