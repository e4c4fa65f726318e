"""Exact medians and median deviations in windows that roll over time, from wavelet matrices of haloed chunks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Run, lean, save

#: Rows of a chunk, unless one slot (a window's length) has more; and the most slots of a chunk.
ROWS, SPAN = 1 << 18, 16
#: Cents at or beyond this, either way, count as none, as do those of NaN and the infinities.
LARGEST = 1 << 57


class WaveletMatrix:
    """Numbers under 2**levels in an order; counts and quantiles of any of its ranges, for many ranges at a time."""

    def __init__(self, numbers: np.ndarray, levels: int):
        self.levels, self.zeros = levels, []
        now = numbers.astype(np.int32)
        for b in range(levels - 1, -1, -1):
            one = (now >> b & 1).astype(bool)
            self.zeros.append(np.concatenate([[0], np.cumsum(~one, dtype=np.int32)]).astype(np.int32))
            now = np.concatenate([now[~one], now[one]])

    def quantile(self, a: np.ndarray, e: np.ndarray, k: np.ndarray) -> np.ndarray:
        """The k-th smallest number (from 0) of each range [a, e)."""
        out = np.zeros(len(a), np.int32)
        for zeros in self.zeros:
            za, ze = zeros[a], zeros[e]
            up = k >= ze - za
            k = np.where(up, k - (ze - za), k)
            a, e = np.where(up, zeros[-1] + a - za, za), np.where(up, zeros[-1] + e - ze, ze)
            out = out << 1 | up
        return out

    def below(self, a: np.ndarray, e: np.ndarray, x: np.ndarray) -> np.ndarray:
        """How many numbers of each range [a, e) are under x, which is at most 2**levels."""
        out = np.where(x >> self.levels, e - a, 0)
        x = np.where(x >> self.levels, 0, x)
        for b, zeros in zip(range(self.levels - 1, -1, -1), self.zeros, strict=True):
            za, ze = zeros[a], zeros[e]
            up = (x >> b & 1).astype(bool)
            out = out + np.where(up, ze - za, 0)
            a, e = np.where(up, zeros[-1] + a - za, za), np.where(up, zeros[-1] + e - ze, ze)
        return out


def medians(values: np.ndarray, a: np.ndarray, e: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each range [a, e) of values, of two or more each: its doubled median m, and the doubled median of
    |2 * value - m| over it. Radii are found by bisection on range counts, between the distances of two quantiles: half
    of the range lies between these, so the larger distance is enough and what is nearer than the smaller isn't."""
    distinct, ranks = np.unique(values, return_inverse=True)
    matrix = WaveletMatrix(ranks, max(1, int(len(distinct) - 1).bit_length()))
    n = e - a
    low, high = (n - 1) // 2, n // 2
    at = lambda rows, k: distinct[matrix.quantile(a[rows], e[rows], k)]
    every, even = np.arange(len(a)), np.flatnonzero(low != high)
    m = at(every, low) * 2
    m[even] = m[even] // 2 + at(even, high[even])

    def within(rows: np.ndarray, radius: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """How many of a range are before, and how many not after, the values at most `radius` from m."""
        first = np.searchsorted(distinct, -((radius - m[rows]) // 2))
        last = np.searchsorted(distinct, (m[rows] + radius) // 2, "right")
        return matrix.below(a[rows], e[rows], first), matrix.below(a[rows], e[rows], last)

    left, right = m - 2 * at(every, n // 4), 2 * at(every, n // 4 + low) - m
    lo, hi = np.maximum(np.minimum(left, right), 0), np.maximum(left, right)
    while len(rows := np.flatnonzero(lo < hi)):
        mid = (lo[rows] + hi[rows]) // 2
        before, upto = within(rows, mid)
        enough = upto - before > low[rows]
        hi[rows] = np.where(enough, mid, hi[rows])
        lo[rows] = np.where(enough, lo[rows], mid + 1)
    deviation = lo * 2
    before, upto = within(even, lo[even])
    more = upto - before <= high[even]  # the upper of the two middle ones is the next nearest value on either side
    even, before, upto = even[more], before[more], upto[more]
    far = np.int64(4 * LARGEST)
    under = np.where(before > 0, m[even] - 2 * at(even, np.maximum(before - 1, 0)), far)
    over = np.where(upto < n[even], 2 * at(even, np.minimum(upto, n[even] - 1)) - m[even], far)
    deviation[even] = lo[even] + np.minimum(under, over)
    return m, deviation


def micros(rows: DataFrame, column: str) -> Column:
    """Microseconds since 1970 as they are written, whatever zone the session has."""
    c = F.col(f"`{column}`")
    if dict(rows.dtypes)[column] == "timestamp_ntz":
        day = F.unix_date(c.cast("date")).cast("long") * 86_400_000_000
        return day + (F.hour(c) * 3600 + F.minute(c) * 60).cast("long") * 1_000_000 + (F.date_part(F.lit("SECOND"), c) * 1_000_000).cast("long")
    return F.unix_micros(c.cast("timestamp"))


def chunked(window: int, span: int, rows: int) -> Run:
    """A step over rows in the order of (name, chunk, us): columns id, series, name, chunk (first microsecond), us, cents,
    own. Whole chunks are taken together until they have `rows` rows; one matrix answers for all of them."""

    def answers(t: pa.Table) -> pa.RecordBatch:
        new = np.zeros(t.num_rows, bool)
        chunk, us, own = (t.column(c).to_numpy() for c in ("chunk", "us", "own"))
        new[1:] = (chunk[1:] != chunk[:-1]) | differs(t.column("name"))
        place = np.cumsum(new) * np.int64((span + 2) * window) + (us - chunk) + window
        has = t.column("cents").is_valid().to_numpy()
        cents = t.column("cents").fill_null(0).to_numpy()
        points, values, q = place[has], cents[has], np.flatnonzero(own)
        a, e = np.searchsorted(points, place[q] - window, "right"), np.searchsorted(points, place[q], "right")
        n = e - a
        enough = np.flatnonzero(n >= 2)
        m, d, far = (np.zeros(len(q), x) for x in (np.int64, np.int64, bool))
        if len(enough):
            m[enough], d[enough] = medians(values, a[enough].astype(np.int32), e[enough].astype(np.int32))
        far = 2 * np.abs(2 * cents[q] - m) > 3 * d
        picked, few = t.take(pa.array(q)), n < 2
        return pa.RecordBatch.from_arrays(
            [picked.column("id").combine_chunks(), picked.column("series").combine_chunks(), pa.array(n.astype(np.int64)), pa.array(m, mask=few), pa.array(d, mask=few), pa.array(far, mask=few | ~has[q])],
            names=["id", "series", "n", "median2", "mad4", "far"],
        )

    def differs(names: pa.ChunkedArray) -> np.ndarray:
        ids = names.combine_chunks().dictionary_encode()
        ids = (ids.combine_chunks() if isinstance(ids, pa.ChunkedArray) else ids).indices.to_numpy()
        return ids[1:] != ids[:-1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for b in batches:
            if not b.num_rows:
                continue
            held.append(b)
            size += b.num_rows
            if size < rows:
                continue
            t = pa.Table.from_batches(held)
            chunk = t.column("chunk").to_numpy()
            cuts = np.flatnonzero((chunk[1:] != chunk[:-1]) | differs(t.column("name")))
            if len(cuts):
                yield answers(t.slice(0, int(cuts[-1]) + 1))
                held = t.slice(int(cuts[-1]) + 1).combine_chunks().to_batches()
                size = sum(x.num_rows for x in held)
        if held:
            yield answers(pa.Table.from_batches(held))

    return lean(run)


def rolling(rows: DataFrame, key: str, series: str, at: str, value: str, minutes: int = 60, chunk: int = ROWS) -> DataFrame:
    """What a robust outlier test needs, for each event: its key and series, n, median2, mad4, far.

    An event's window holds the cents, floor(100 * value + 0.5), of its series' events later than `minutes` before its
    own time and not later than that time. n counts them; median2 is the sum of the two middle ones, or twice the only
    middle one; mad4 is the same of |2 * cents - median2| over the window; far tells whether 2 * |2 * c - median2| is more
    than 3 * mad4, c the event's own cents. With n under 2 the last three are null; far is, too, without own cents.

    Events are cut by series and time into chunks of whole slots (a slot is a window long), up to SPAN of them and to
    `chunk` rows where a slot has fewer; a chunk also gets what the slot before it still has in its windows. So a task
    holds a chunk and a slot before it; how long chunks are depends on the fullest slot alone, one number. An event is
    in two chunks at most.

    Nulls: an event without time is left out; a null series is one; a null value has no cents, nor has one that is NaN
    or whose cents reach 2**57. Rows that repeat a key are one event (a null key is a key): the one that comes first by
    time, series, value, nulls after all times. Ties in time see each other. Empty table: no rows. Other columns are not
    read.
    """
    window = minutes * 60_000_000
    of = lambda c: F.col(f"`{c}`")
    cents = of(value).cast("double") * 100 + 0.5
    cents = F.when(F.abs(cents) < float(LARGEST), F.floor(cents))
    firsts = rows.select(of(key).alias("id"), micros(rows, at).alias("us"), of(series).alias("series"), cents.cast("long").alias("cents"))
    firsts = firsts.groupBy("id").agg(F.min(F.struct(F.col("us").isNull().alias("later"), "us", "series", "cents")).alias("e")).select("id", "e.us", "e.series", "e.cents").where("us IS NOT NULL")
    slot = lambda c: c - F.pmod(c, F.lit(window))
    events = save(firsts, "events")
    fullest = events.groupBy("series", slot(F.col("us")).alias("s")).agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 1
    span = max(1, min(SPAN, 1 << max(0, (chunk // fullest).bit_length() - 1)))
    start = lambda c: c - F.pmod(c, F.lit(span * window))
    own, last = start(F.col("us")), start(F.col("us") + window - 1)
    places = F.when((last == own) | F.col("cents").isNull(), F.array(own)).otherwise(F.array(own, last))
    dealt = events.select("id", "series", F.coalesce(F.concat(F.lit("v"), F.col("series").cast("string")), F.lit("n")).alias("name"), "us", "cents", F.explode(places).alias("chunk"))
    dealt = dealt.select("id", "series", "name", "chunk", "us", "cents", (F.col("chunk") <= F.col("us")).alias("own"))
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = dealt.repartition(parts, "name", "chunk").sortWithinPartitions("name", "chunk", "us")
    kinds = dict(events.dtypes)
    out = dealt.mapInArrow(chunked(window, span, chunk), f"id {kinds['id']}, series {kinds['series']}, n bigint, median2 bigint, mad4 bigint, far boolean")
    return out.select(F.col("id").alias(key), F.col("series").alias(series), "n", "median2", "mad4", "far")


SQL = """
WITH firsts AS (
  SELECT click_id, min(struct_pack(later := ts IS NULL, ts := ts, kind := kind, cents := CASE WHEN isfinite(value) THEN CAST(floor(100 * value + 0.5) AS BIGINT) END)) AS e
  FROM clicks GROUP BY click_id),
events AS (SELECT click_id, e.ts AS ts, coalesce('v' || e.kind, 'n') AS name, e.kind AS kind, e.cents AS c FROM firsts WHERE e.ts IS NOT NULL),
windows AS (
  SELECT x.click_id, any_value(x.kind) AS kind, any_value(x.c) AS c, list_sort(list(y.c)) AS w
  FROM events x JOIN events y ON x.name = y.name AND y.ts <= x.ts AND y.ts > x.ts - INTERVAL 60 MINUTE
  GROUP BY x.click_id),
centred AS (
  SELECT click_id, kind, c, list_filter(w, lambda v: v IS NOT NULL) AS w FROM windows),
medians AS (
  SELECT *, len(w) AS n, CASE WHEN len(w) >= 2 THEN w[(len(w) - 1) // 2 + 1] + w[len(w) // 2 + 1] END AS median2 FROM centred),
spread AS (
  SELECT *, list_sort(list_transform(w, lambda v: abs(2 * v - median2))) AS d FROM medians)
SELECT click_id, kind, CAST(n AS BIGINT) AS n, median2, CASE WHEN n >= 2 THEN d[(n - 1) // 2 + 1] + d[n // 2 + 1] END AS mad4,
  CASE WHEN n >= 2 THEN 2 * abs(2 * c - median2) > 3 * (d[(n - 1) // 2 + 1] + d[n // 2 + 1]) END AS far
FROM spread
"""
