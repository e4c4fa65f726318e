"""Triangles of large graphs, counted on lists of neighbours.

Nodes have one of some colours, and a task counts the triangles of three of them: it needs the links between these colours
only, so a link goes to as many tasks as there are colours, and no path of two links is ever written or shuffled.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import drop, parts, save

#: Links that a task holds, about; colours at the least; paths of two links looked at, and bytes of marks, at a time.
HELD, COLOURS, PATHS, MARKS = 16 << 20, 6, 1 << 18, 2 << 20


def _listed(batches: Iterator[pa.RecordBatch], colours: int, each: int) -> Iterator[pa.RecordBatch]:
    """u, colour, to, w: a node's neighbours of a colour, and how many rows link each. batches: u, v; all rows of a u."""
    keys = [np.zeros(0, np.int64)]
    for b in batches:
        u, v = (b.column(c).to_numpy().astype(np.int64) for c in range(2))
        keys.append((u << 32) + v % colours * each + v // colours)
    key, w = np.unique(np.concatenate(keys), return_counts=True)
    place = key & 0xFFFFFFFF
    row = (key >> 32) * colours + place // each
    first = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]])) if len(row) else np.zeros(0, np.int64)
    to = (place % each * colours + place // each).astype(np.int32)
    ends = np.append(first, len(row))
    for a in range(0, len(first), 4096):
        lo, hi = ends[a], ends[min(a + 4096, len(first))]
        cuts = pa.array(ends[a : a + 4097] - lo, pa.int32())
        got = row[first[a : a + 4096]]
        lists = [pa.ListArray.from_arrays(cuts, pa.array(x[lo:hi], t)) for x, t in ((to, pa.int32()), (w, pa.int32()))]
        yield pa.RecordBatch.from_arrays([pa.array(got // colours, pa.int32()), pa.array(got % colours, pa.int32()), *lists], names=["u", "colour", "to", "w"])


class Links:
    """Links between the nodes of three colours (task: the three, ascending), each from u to a greater v: add() rows, then
    sums() of the triangles whose nodes have just these colours."""

    def __init__(self, task: tuple[int, int, int], colours: int, each: int):
        self.total, self.known, self.colours, self.each = sum(task), np.array(sorted(set(task))), colours, each
        self.slot = np.full(colours, -1)
        self.slot[self.known] = np.arange(len(self.known))
        self.rows: list[tuple[np.ndarray, ...]] = []

    def local(self, n: np.ndarray) -> np.ndarray:
        return self.slot[n % self.colours] * self.each + n // self.colours

    def add(self, b: pa.RecordBatch) -> None:
        u, to, w = b.column(1).to_numpy().astype(np.int64), b.column(3), b.column(4)
        self.rows.append((self.local(u), self.slot[b.column(2).to_numpy()], to.value_lengths().to_numpy().astype(np.int64), self.local(to.flatten().to_numpy()).astype(np.int32), w.flatten().to_numpy()))

    def sums(self) -> tuple[np.ndarray, np.ndarray]:
        """Nodes and, over their triangles, the sum of the products of the links' weights."""
        u, slot, n, to, w = (np.concatenate(x) for x in zip(*self.rows, strict=True))
        self.rows = []
        size, slots = len(self.known) * self.each, len(self.known)
        row = u * slots + slot
        begin = np.cumsum(n) - n
        at, count = np.zeros(size * slots, np.int64), np.zeros(size * slots, np.int64)
        at[row], count[row] = begin, n
        # each link, by node: its place among the lists, and the list of its end that leads to the third colour
        order = np.argsort(row, kind="stable")
        where = np.repeat(begin[order] - np.cumsum(n[order]) + n[order], n[order]) + np.arange(len(to))
        source, end, weight = np.repeat(u[order], n[order]), to[where], w[where]
        third = self.slot[self.total - self.known[source // self.each] - self.known[end // self.each]]
        listed = end.astype(np.int64) * slots + third
        paths = np.cumsum(count[listed])
        found = np.zeros(size)
        marks = np.zeros(max(1, MARKS // size) * size, w.dtype)
        nodes, start = np.unique(source, return_index=True)
        start = np.append(start, len(source))
        upto = np.concatenate([[0], paths])[start]
        i = 0
        while i < len(nodes):
            j = max(i + 1, min(int(np.searchsorted(upto, upto[i] + PATHS, "right")) - 1, i + max(1, MARKS // size), len(nodes)))
            a, b = start[i], start[j]
            mark = np.repeat(np.arange(j - i) * size, np.diff(start[i : j + 1]))
            marks[mark + end[a:b]] = weight[a:b]
            # a node with more paths than are looked at together is gone through in pieces
            lo = a
            while lo < b:
                hi = max(lo + 1, min(b, int(np.searchsorted(paths, (paths[lo - 1] if lo else 0) + 2 * PATHS, "right"))))
                k = count[listed[lo:hi]]
                place = np.repeat(at[listed[lo:hi]] - np.cumsum(k) + k, k) + np.arange(k.sum())
                x = to[place]
                hit = marks[np.repeat(mark[lo - a : hi - a], k) + x]
                met = np.flatnonzero(hit)
                if len(met):
                    link = lo + np.searchsorted(np.cumsum(k), met, "right")
                    value = hit[met].astype(np.float64) * w[place[met]] * weight[link]
                    found += np.bincount(np.concatenate([source[link], end[link], x[met]]), np.tile(value, 3), size)
                lo = hi
            marks[mark + end[a:b]] = 0
            i = j
        some = np.flatnonzero(found)
        return some % self.each * self.colours + self.known[some // self.each], found[some].astype(np.int64)


def _counted(batches: Iterator[pa.RecordBatch], colours: int, each: int) -> Iterator[pa.RecordBatch]:
    now, links = None, None

    def done() -> pa.RecordBatch:
        n, t = links.sums()
        return pa.RecordBatch.from_arrays([pa.array(n, pa.int32()), pa.array(t, pa.int64())], names=["n", "t"])

    for batch in batches:
        task = batch.column(0).to_numpy()
        cuts = [0, *(np.flatnonzero(task[1:] != task[:-1]) + 1).tolist(), len(task)]
        for i, j in zip(cuts[:-1], cuts[1:], strict=True):
            if i == j:
                continue
            if task[i] != now:
                if links:
                    yield done()
                now = task[i]
                links = Links((int(now) // colours**2, int(now) // colours % colours, int(now) % colours), colours, each)
            links.add(batch.slice(i, j - i))
    if links:
        yield done()


def triangles(pairs: DataFrame, count: int, least: int = COLOURS, held: int = HELD) -> tuple[DataFrame, DataFrame]:
    """Two tables of the nodes in some triangle and those in some pair that two rows link: n, t, the sum over the node's
    triangles of the products of their links' weights; and n, m, the number of such pairs. pairs: u, v (ints from 0 to
    count - 1, u < v), a row for each link between them; a pair's weight is the number of its rows.

    Triangles are found once each, from their smallest number: numbers in order of degree bound the paths from a node by
    the links' number. There are as many colours as it takes for a task to hold about `held` links, `least` at least.
    """
    deal = parts(pairs)
    colours = max(least, math.ceil(math.sqrt(6 * pairs.count() / held)))
    each = max(1, -(-count // colours))
    lists = save(pairs.select("u", "v").repartition(deal, "u").mapInArrow(lambda b: _listed(b, colours, each), "u int, colour int, to array<int>, w array<int>"), "lists")
    a, z = F.array_sort(F.array((F.col("u") % colours).cast("int"), "colour", F.col("x"))), F.explode(F.sequence(F.lit(0), F.lit(colours - 1)))
    sent = lists.withColumn("x", z).select((a[0] * colours**2 + a[1] * colours + a[2]).alias("task"), "u", "colour", "to", "w")
    tasks = colours * (colours + 1) * (colours + 2) // 6
    sums = save(sent.repartition(tasks, "task").sortWithinPartitions("task").mapInArrow(lambda b: _counted(b, colours, each), "n int, t bigint").groupBy("n").agg(F.sum("t").alias("t")), "triangles")
    twice = lists.select("u", F.explode(F.filter(F.arrays_zip("to", "w"), lambda x: x["w"] == 2)).alias("v")).select(F.explode(F.array("u", "v.to")).alias("n"))
    mutual = save(twice.groupBy("n").agg(F.count("*").alias("m")), "mutual")
    drop(lists)
    return sums, mutual
