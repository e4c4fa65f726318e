"""Sharding along a Hilbert curve over several metadata dimensions, with DataFrame functions only."""

from __future__ import annotations

from functools import cache

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import drop, save, small_enough

BITS = 5


def position(point: list[int], bits: int = BITS) -> int:
    """Where a Hilbert curve over a grid of 2**bits cells a side visits the point (axes to transposed index, Gray code)."""
    x, top = list(point), 1 << (bits - 1)
    q = top
    while q > 1:
        low = q - 1
        for i in range(len(x)):
            if x[i] & q:
                x[0] ^= low
            else:
                t = (x[0] ^ x[i]) & low
                x[0] ^= t
                x[i] ^= t
        q >>= 1
    for i in range(1, len(x)):
        x[i] ^= x[i - 1]
    t, q = 0, top
    while q > 1:
        if x[-1] & q:
            t ^= q - 1
        q >>= 1
    at = 0
    for b in range(bits - 1, -1, -1):
        for v in x:
            at = at << 1 | ((v ^ t) >> b & 1)
    return at


@cache
def curve(dims: int, bits: int = BITS) -> str:
    """The positions of all cells, in the order of the cells' own numbers."""
    side = range(1 << bits)
    cells = [[]]
    for _ in range(dims):
        cells = [[*c, v] for c in cells for v in side]
    return ",".join(str(position(c, bits)) for c in cells)


def string_cuts(rows: DataFrame, column: str, levels: int) -> list[str]:
    """The least value of every level but the lowest, by the places of the distinct values: a value's level is how many of
    the rows are before it, in levels of equal size. Values are counted with map-side combine and sorted by ranges; what
    comes to the driver is a value a level."""
    values = save(rows.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("v")).agg(F.count("*").alias("n")).orderBy("v").withColumn("part", F.spark_partition_id()), "hilbert-values")
    parts = values.groupBy("part").agg(F.sum("n").alias("n"))
    parts = parts.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("base"), F.sum("n").over(Window.partitionBy()).alias("total"))
    before = F.col("base") + F.sum("n").over(Window.partitionBy("part").orderBy("v")) - F.col("n")
    least = values.join(F.broadcast(parts), "part").select("v", F.floor(before * levels / F.col("total")).alias("level")).groupBy("level").agg(F.min("v").alias("v"))
    cuts = sorted((r["level"], r["v"]) for r in least.collect())
    drop(values)
    return [v for _, v in cuts[1:]]


def shard(docs: DataFrame, dims: tuple[str, ...] = ("source", "lang", "size"), shards: int = 8, key: str = "doc_id", text: str = "text", bits: int = BITS) -> DataFrame:
    """Each document's place on the curve, its shard (0 to shards-1) and its slot in the shard.

    Every dimension is cut into at most 2**bits levels, numbers at their approximate quantiles, strings by the places of
    their distinct values among all rows (null: level 0); a literal table, built by rule, gives the curve index of a cell. Rows are ordered by (index, hash of id, id) and cut into runs whose
    counts differ by one at most. Returns doc_id, size (UTF-8 bytes + 1), text_crc32, hilbert, shard, slot.

    The order's row numbers come without a global sort: counts by (index, 8 hash bits) are map-side combined, their
    prefix sums are taken within 256 ranges of the curve and over the 256 ranges, and rows are numbered within (index,
    8 hash bits). A cell with a third of all rows is thus spread over 256 groups.

    Nulls: a null text has size 1 and crc 0; a null id is a value. Rows that agree in id are ordered by size and crc.
    Empty table: no rows. Of docs only key, text and dims are read ("size" is the size just defined).
    """
    of = lambda c: F.col(f"`{c}`")
    size = (F.coalesce(F.octet_length(of(text)), F.lit(0)) + 1).cast("long")
    rows = docs.select(of(key).cast("long").alias("doc_id"), size.alias("size"), F.crc32(F.coalesce(F.encode(of(text), "UTF-8"), F.lit("").cast("binary"))).alias("text_crc32"), *[(size if d == "size" else of(d)).alias(f"c{i}") for i, d in enumerate(dims)])
    kinds = dict(rows.dtypes)
    rows = save(rows.select("doc_id", "size", "text_crc32", *[F.col(f"c{i}") if kinds[f"c{i}"] == "string" else F.col(f"c{i}").cast("double").alias(f"c{i}") for i in range(len(dims))]), "hilbert-rows")
    levels = 1 << bits
    numbers = [f"c{i}" for i in range(len(dims)) if kinds[f"c{i}"] != "string"]
    cuts = rows.agg(F.lit(0), *[F.percentile_approx(c, [j / levels for j in range(1, levels)], 10_000).alias(c) for c in numbers]).first()
    cell = F.lit(0)
    for i in range(len(dims)):
        c, level = F.col(f"c{i}"), F.lit(0)
        above = [c > v for v in sorted({*(cuts[f"c{i}"] or [])})] if f"c{i}" in numbers else [c >= v for v in string_cuts(rows, f"c{i}", levels)]
        for x in above:
            level = level + F.when(x, 1).otherwise(0)
        cell = cell * levels + level
    table = F.split(F.lit(curve(len(dims), bits)), ",").cast("array<int>")  # folded to a constant array
    rows = rows.select("doc_id", "size", "text_crc32", cell.cast("int").alias("cell"), F.xxhash64(F.coalesce("doc_id", F.lit(-1))).alias("h"))
    rows = rows.select("doc_id", "size", "text_crc32", "h", F.get(table, "cell").alias("hilbert"), F.shiftrightunsigned("h", 56).cast("int").alias("sub"))
    wide = len(dims) * bits - 8
    counts = save(rows.groupBy("hilbert", "sub").agg(F.count("*").alias("n")), "hilbert-counts").withColumn("range", F.shiftright("hilbert", wide) if wide > 0 else F.col("hilbert"))
    ranges = counts.groupBy("range").agg(F.sum("n").alias("n"))
    ranges = ranges.select("range", (F.sum("n").over(Window.orderBy("range")) - F.col("n")).alias("base"), F.sum("n").over(Window.partitionBy()).alias("total"))
    starts = counts.withColumn("own", F.sum("n").over(Window.partitionBy("range").orderBy("hilbert", "sub")) - F.col("n")).join(F.broadcast(ranges), "range").select("hilbert", "sub", (F.col("base") + F.col("own")).alias("start"), "total")
    rank = F.row_number().over(Window.partitionBy("hilbert", "sub").orderBy(F.col("h").bitwiseXOR(F.lit(-1 << 63)), "doc_id", "size", "text_crc32")) - 1
    out = rows.withColumn("rank", rank).join(small_enough(save(starts, "hilbert-starts")), ["hilbert", "sub"]).withColumn("at", F.col("start") + F.col("rank"))
    out = out.withColumn("shard", F.expr(f"CAST(at * {shards} DIV total AS INT)"))
    return out.select("doc_id", "size", "text_crc32", "hilbert", "shard", F.expr(f"at - (shard * total + {shards - 1}) DIV {shards}").cast("long").alias("slot"))


def write(placed: DataFrame, path: str, files: int = 8) -> None:
    """A folder a shard, each of about `files` files that follow each other on the curve, so that file statistics prune
    every dimension; that many tasks write a shard."""
    shards = placed.agg(F.max("shard")).first()[0]
    placed.repartitionByRange(((shards or 0) + 1) * files, "shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
