"""Embedding near-dedup with an inverted multi-index."""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import connected, save
from .hashing import U, mix
from .jaccard import groups, spanning

#: Bound of the sample (vectors of smallest id hash) on which codebooks and the number of visits are fitted.
SAMPLE = 20_000
#: Vectors of a cell, or of a group, that are compared with others at a time.
BLOCK = 128
#: Share of the sampled vectors' links, to any vector of the table, that traversals must reach from either end; the
#: fewest cells that they visit; and those that they visit at least where fewer than FEW links say how many are needed.
RECALL, LEAST, MOST, FEW = 0.999, 4, 64, 1000


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.sqrt((x * x).sum(1))[:, None]


def kmeans(x: np.ndarray, k: int, rounds: int = 10, seed: int = 0) -> np.ndarray:
    """Lloyd's algorithm from k distinct rows; an empty cluster keeps its centre."""
    x0 = np.unique(x, axis=0)
    centres = x0[np.random.default_rng(seed).permutation(len(x0))[:k]]
    for _ in range(rounds):
        own = distances(x, centres).argmin(1)
        for c in range(len(centres)):
            if (own == c).any():
                centres[c] = x[own == c].mean(0)
    return centres


def distances(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum((x * x).sum(1)[:, None] - 2 * x @ centres.T + (centres * centres).sum(1)[None], 0))


def traverse(d1: np.ndarray, d2: np.ndarray, visits: int, reach: float) -> list[int]:
    """Cells (i * len(d2) + j) by growing squared distance: a heap over two sorted sequences, each cell entering after
    its neighbours. Ends after `visits` cells, or where no vector within `reach` of this one can be (each half of such
    a vector is nearer to its own centre than this one's half is to it by twice the half's share of reach at most)."""
    o1, o2 = d1.argsort(kind="stable"), d2.argsort(kind="stable")
    a, b = d1[o1], d2[o2]
    a, b = a[a - a[0] <= 2 * reach + 1e-4], b[b - b[0] <= 2 * reach + 1e-4]
    # what is out of reach has nothing within reach behind it in either sequence
    near = lambda i, j: ((a[i] - a[0]) ** 2 + (b[j] - b[0]) ** 2) / 4 <= reach * reach + 1e-9
    heap, out, done = [(a[0] ** 2 + b[0] ** 2, 0, 0)], [], set()
    while heap and len(out) < visits:
        _, i, j = heapq.heappop(heap)
        out.append(int(o1[i]) * len(d2) + int(o2[j]))
        done.add((i, j))
        if i + 1 < len(a) and (j == 0 or (i + 1, j - 1) in done) and near(i + 1, j):
            heapq.heappush(heap, (a[i + 1] ** 2 + b[j] ** 2, i + 1, j))
        if j + 1 < len(b) and (i == 0 or (i - 1, j + 1) in done) and near(i, j + 1):
            heapq.heappush(heap, (a[i] ** 2 + b[j + 1] ** 2, i, j + 1))
    return out


class Index:
    """Two codebooks over the halves of unit vectors of one dimension, and how many cells to visit."""

    def __init__(self, x: np.ndarray, k: int, cosine: float):
        self.dim, self.reach = x.shape[1], float(np.sqrt(max(2 - 2 * cosine, 0)))
        h = self.dim // 2
        self.books = [kmeans(x[:, :h], k), kmeans(x[:, h:], k)]
        self.n, self.recall = MOST, None

    def fit(self, x: np.ndarray, y: np.ndarray) -> None:
        """Visits enough for RECALL of the links between the rows of x and y, however many they are; for all of these
        links, and MOST at least, if they are fewer than FEW."""
        ranks = np.minimum(self.ranks(x, y), self.ranks(y, x)) if len(x) else np.zeros(0, int)
        self.n = max(LEAST, int(np.quantile(ranks, RECALL, method="higher"))) if len(ranks) >= FEW else max([MOST, *ranks.tolist()])
        self.recall = float((ranks <= self.n).mean()) if len(ranks) else None

    def ranks(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """The cells that each row of x visits until it meets the home of that row of y."""
        out = np.zeros(len(x), int)
        for at in range(0, len(x), 1000):
            d1, d2 = self.split(x[at : at + 1000])
            for i, home in enumerate(self.homes(y[at : at + 1000]).tolist()):
                a, b = d1[i], d2[i]
                far = np.add.outer(a * a, b * b)
                near = np.add.outer((a - a.min()) ** 2, (b - b.min()) ** 2) / 4 <= self.reach**2 + 1e-9
                out[at + i] = np.count_nonzero(near & (far <= far.flat[home] + 1e-12))
        return np.maximum(out, 1)

    def split(self, x: np.ndarray) -> list[np.ndarray]:
        h = self.dim // 2
        return [distances(x[:, :h], self.books[0]), distances(x[:, h:], self.books[1])]

    def homes(self, x: np.ndarray) -> np.ndarray:
        d1, d2 = self.split(x)
        return d1.argmin(1) * d2.shape[1] + d2.argmin(1)

    def visits(self, x: np.ndarray, n: int) -> list[tuple[list[int], int]]:
        d1, d2 = self.split(x)
        home = d1.argmin(1) * d2.shape[1] + d2.argmin(1)
        return [(traverse(a, b, n, self.reach), int(c)) for a, b, c in zip(d1, d2, home, strict=True)]


def prepare(vectors: DataFrame, key: str, vector: str, label: str) -> DataFrame:
    """vec_id, label, dim, same (hash of label and components; null: links with nothing), x (components as doubles)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            same, dims, xs = [], [], []
            for v, lab in zip(b.column(1), b.column(2).to_pylist(), strict=True):
                x = np.array([] if not v.is_valid else v.values.to_numpy(zero_copy_only=False), np.float64) + 0.0
                ok = lab is not None and len(x) and np.isfinite(x).all() and (x != 0).any() and np.isfinite((x * x).sum()) and (x * x).sum() > 0
                same.append(blake2b(repr(lab).encode() + b"|" + x.tobytes(), digest_size=16).digest() if ok else None)
                xs.append(x.tobytes() if ok else None)
                dims.append(len(x))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(dims, pa.int32()), pa.array(same, pa.binary()), pa.array(xs, pa.binary())], names=["vec_id", "label", "dim", "same", "x"])

    return vectors.select(F.col(key).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("v"), F.col(label).cast("string").alias("label")).mapInArrow(run, "vec_id bigint, label string, dim int, same binary, x binary")


def matrix(column: pa.ChunkedArray) -> np.ndarray:
    rows = column.to_pylist()
    return unit(np.frombuffer(b"".join(rows)).reshape(len(rows), -1))


#: Cosines nearer to the limit than this are computed again, each sum rounded once.
CLOSE = 1e-9


def pairs(x: np.ndarray, y: np.ndarray, cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """Rows of x and of y (unit vectors) whose cosine is `cosine` or more. Products of matrices round by the order of their
    sums; where that could matter the cosine is taken from exact sums, so a pair links wherever it is compared."""
    c = x @ y.T
    i, j = np.nonzero(c >= cosine - CLOSE)
    for k in np.flatnonzero(c[i, j] < cosine + CLOSE).tolist():
        a, b = x[i[k]], y[j[k]]
        if math.fsum(a * b) / math.sqrt(math.fsum(a * a) * math.fsum(b * b)) < cosine:
            i[k] = -1
    return i[i >= 0], j[i >= 0]


def linked(sets: DataFrame, sample: dict[str, tuple[np.ndarray, np.ndarray, np.ndarray]], dim: int, cosine: float) -> DataFrame:
    """q, rid: for each sampled vector that links with any vector of the table one of these, by the smallest hash.

    sample: by label, the numbers, ids and rows of sampled vectors. Every row of the table meets them, in blocks; a task
    passes on one neighbour of each, packed in a few rows.
    """
    shared, parts = sets.sparkSession.sparkContext.broadcast(sample), 16
    total = sum(len(q) for q, _, _ in sample.values())
    last = np.iinfo(U).max

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best, who = np.full(total, last), np.zeros(total, np.int64)
        for batch in batches:
            t = pa.Table.from_batches([batch])
            labels, dims = np.array(t.column(1).to_pylist(), object), t.column(2).to_numpy()
            for lab in sorted(set(labels[dims == dim])):
                if lab not in shared.value:
                    continue
                q, ids, y = shared.value[lab]
                own = np.flatnonzero((labels == lab) & (dims == dim))
                for at in range(0, len(own), 256):
                    part = t.take(pa.array(own[at : at + 256]))
                    rid = part.column(0).to_numpy()
                    i, j = pairs(matrix(part.column(3)), y, cosine)
                    other = rid[i] != ids[j]
                    i, j = i[other], j[other]
                    h = mix(mix(rid[i].view(U)) + ids[j].view(U))
                    np.minimum.at(best, q[j], h)
                    first = best[q[j]] == h
                    who[q[j[first]]] = rid[i[first]]
        for n in range(parts):
            q = np.flatnonzero(best[n::parts] != last) * parts + n
            if len(q):
                yield pa.RecordBatch.from_arrays([pa.array([n], pa.int32()), *[pa.array([x.tobytes()], pa.binary()) for x in (q, best[q], who[q])]], names=["part", "q", "h", "rid"])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best, who = np.full(total, last), np.zeros(total, np.int64)
        for batch in batches:
            for row in zip(*[c.to_pylist() for c in batch.columns[1:]], strict=True):
                q, h, rid = (np.frombuffer(x, t) for x, t in zip(row, (np.int64, U, np.int64), strict=True))
                less = h < best[q]
                best[q[less]], who[q[less]] = h[less], rid[less]
        q = np.flatnonzero(best != last)
        yield pa.RecordBatch.from_arrays([pa.array(q), pa.array(who[q])], names=["q", "rid"])

    rows = sets.select("rid", "label", "dim", "x").mapInArrow(meet, "part int, q binary, h binary, rid binary")
    return rows.repartition(parts, "part").mapInArrow(merge, "q bigint, rid bigint")


def near(sets: DataFrame, index: Index | None, cosine: float) -> DataFrame:
    """Edges (src, dst) between vectors that link, enough to connect all links found in visited cells.

    Every vector lives in its nearest cell and visits others; those of one label and dimension that meet in a cell are
    compared. A cell's residents go in blocks of BLOCK, and whoever visits it meets each block.
    """
    shared = sets.sparkSession.sparkContext.broadcast(index)

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        for whole in batches:
            for at in range(0, whole.num_rows, 1000):
                b = whole.slice(at, 1000)
                dims = b.column(2).to_numpy()
                cells = [([0], 0)] * b.num_rows
                own = np.flatnonzero(dims == index.dim) if index else []
                if len(own):
                    for i, c in zip(own.tolist(), index.visits(matrix(b.column(3).take(pa.array(own))), index.n), strict=True):
                        cells[i] = c
                rows = [(i, c, c == home) for i, (seen, home) in enumerate(cells) for c in sorted({*seen, home})]
                take = pa.array([r[0] for r in rows])
                yield pa.RecordBatch.from_arrays([*[b.column(k).take(take) for k in range(4)], pa.array([r[1] for r in rows], pa.int32()), pa.array([r[2] for r in rows])], names=["rid", "label", "dim", "x", "cell", "home"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        src, dst = [], []
        for t in groups(batches, 2):
            rid, home = t.column(2).to_numpy(), t.column(4).to_numpy(zero_copy_only=False)
            lives = np.flatnonzero(home)
            if len(lives) and len(rid) > 1:
                x = matrix(t.column(3))
                for a in range(0, len(rid), 2048):
                    p, q = pairs(x[a : a + 2048], x[lives], cosine)
                    for i, j in spanning(len(rid), p + a, lives[q]):
                        src.append(rid[i])
                        dst.append(rid[j])
            if len(src) > 5000:
                yield pa.RecordBatch.from_arrays([pa.array(src, pa.int64()), pa.array(dst, pa.int64())], names=["src", "dst"])
                src, dst = [], []
        yield pa.RecordBatch.from_arrays([pa.array(src, pa.int64()), pa.array(dst, pa.int64())], names=["src", "dst"])

    n = int(sets.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = save(sets.select("rid", "label", "dim", "x").mapInArrow(spread, "rid bigint, label string, dim int, x binary, cell int, home boolean"), "visits")
    rows = rows.withColumn("cell", F.xxhash64("label", "dim", "cell"))
    blocks = save(rows.where("home").groupBy("cell").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks")), "cells")
    # a cell where none lives is not met
    rows = rows.join(blocks, "cell")
    own = F.pmod(F.xxhash64("rid"), "blocks").cast("int")
    rows = rows.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select("cell", "block", "rid", "x", (F.col("home") & (F.col("block") == own)).alias("home"))
    return rows.repartition(n, "cell", "block").sortWithinPartitions("cell", "block").mapInArrow(compare, "src bigint, dst bigint")


def counted(members: DataFrame, cosine: float) -> DataFrame:
    """members: comp, x, y (a pair of blocks), own (block), rid, copies, v. Rows (rid, links)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in groups(batches, 3):
            x, y = t.column(1)[0].as_py(), t.column(2)[0].as_py()
            own, rid, copies = (t.column(c).to_numpy() for c in (3, 4, 5))
            v = matrix(t.column(6))
            linked = np.zeros((len(v), len(v)), bool)
            linked[pairs(v, v, cosine)] = True
            np.fill_diagonal(linked, False)
            if x != y:
                linked &= own[:, None] != own[None, :]
            yield pa.RecordBatch.from_arrays([pa.array(rid), pa.array(linked @ copies)], names=["rid", "links"])

    n = int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return members.select("comp", "x", "y", "own", "rid", "copies", "v").repartition(n, "comp", "x", "y").sortWithinPartitions("comp", "x", "y").mapInArrow(run, "rid bigint, links bigint")


def dedup(vectors: DataFrame, cosine: float = 0.98, key: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """One row a vector: vec_id, n_links, component_id (smallest vec_id that links lead to), kept (it is that one), recall
    (the share of the sampled vectors' links, one of each with any vector of the table, that traversals reach; null
    without any).

    Vectors link if their labels are equal and their cosine, in double precision, is `cosine` or more. Equal vectors of
    a label are one with a count. Codebooks of both halves are fitted on a bounded sample; the number of cells to visit
    is fitted on links of the sampled vectors with the whole table, one of each. Every vector is indexed and visits cells
    in the order of a multi-sequence traversal. Groups so connected
    are then compared exactly in blocks, so links are counted without writing pairs, and those between members of a
    group that no visit found are counted too.

    Null labels, and vectors that are null, empty, zero or hold null or non-finite components, link with nothing and
    are components of their own. Vectors of different length don't link. A null vec_id links with nothing (component
    null, kept). Rows that repeat an id are vectors of their own, alike or not; ties are broken by the smaller id. Empty
    table: no rows. Other columns are not read.
    """
    rows = save(prepare(vectors, key, vector, label), "vectors")
    usable = rows.where("vec_id IS NOT NULL AND same IS NOT NULL")
    # equal vectors are one set, known by a number
    sets = usable.groupBy("same").agg(F.min("vec_id").alias("first"), F.first("label").alias("label"), F.first("dim").alias("dim"), F.first("x").alias("x"), F.count("*").alias("copies"))
    sets = save(sets.withColumn("rid", F.monotonically_increasing_id()), "vector-sets")
    sample = sets.orderBy(F.xxhash64("first"), "same").limit(SAMPLE).select("dim", "label", "x", "rid").toLocalIterator()
    sample = [(r["dim"], r["label"], bytes(r["x"]), r["rid"]) for r in sample]
    index = None
    if sample:
        dims = [r[0] for r in sample]
        dim = max(sorted(set(dims)), key=dims.count)
        if dim > 1:
            own = [r for r in sample if r[0] == dim]
            x, ids = unit(np.frombuffer(b"".join(r[2] for r in own)).reshape(len(own), -1)), np.array([r[3] for r in own], np.int64)
            labels = {}
            for i, r in enumerate(own):
                labels.setdefault(r[1], []).append(i)
            k = int(np.clip(np.sqrt(sets.count() / 100), 4, 256))
            index = Index(x, k, cosine)
            found = save(linked(sets, {lab: (np.array(q), ids[q], x[q]) for lab, q in labels.items()}, dim, cosine), "vector-links")
            found = [(r["q"], bytes(r["x"])) for r in sets.select("rid", "x").join(F.broadcast(found), "rid").select("q", "x").toLocalIterator()]
            if found:
                index.fit(x[[q for q, _ in found]], unit(np.frombuffer(b"".join(y for _, y in found)).reshape(len(found), -1)))
    comps = save(connected(near(sets, index, cosine)).withColumnRenamed("node", "rid").withColumnRenamed("component", "comp"), "vector-groups")
    sizes = comps.groupBy("comp").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    members = comps.join(sizes, "comp").join(sets.select("rid", "copies", F.col("x").alias("v")), "rid")
    members = members.withColumn("own", F.pmod(F.xxhash64("rid"), "blocks").cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    members = members.select("comp", F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y"), "own", "rid", "copies", "v")
    links = counted(members, cosine).groupBy("rid").agg(F.sum("links").alias("links"))
    least = comps.join(sets.select("rid", "first"), "rid").groupBy("comp").agg(F.min("first").alias("least"))
    classes = sets.select("same", "rid", "first", "copies").join(comps.join(least, "comp"), "rid", "left").join(links, "rid", "left")
    classes = classes.select("same", F.coalesce("least", "first").alias("component"), (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n"))
    out = rows.select("vec_id", F.when(F.col("vec_id").isNotNull(), F.col("same")).alias("same")).join(classes, "same", "left")
    out = out.select("vec_id", F.coalesce("n", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component", "vec_id").alias("component_id"))
    recall = F.lit(index.recall if index else None).cast("double")
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True))).withColumn("recall", recall)
