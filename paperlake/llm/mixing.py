"""Mixing sources to target weights by capped water-filling, with DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import bits, save, small_enough

#: Bits of the hash that orders a source's documents, and of its leading part that is summed first.
HASH, LEAD = 52, 12


def words(text):
    """Runs of characters other than ASCII white space; null: 0."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def fill(sources: DataFrame, weights: tuple[int, ...], epochs: int) -> DataFrame:
    """Targets by capped water-filling.

    sources: skey, source, source_size. Sources by code point, null last, take the weights in turn. A target is
    min(epochs * size, weight * level); the level is where the targets sum to all sizes, which is the point that
    repeated proportional sharing of the excess reaches. It is read off prefix sums over the sources in the order in
    which they fill up. The windows run over one row a source.
    """
    w = F.element_at(F.array(*map(F.lit, weights)), ((F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1) % len(weights) + 1).cast("int"))
    s = sources.withColumn("weight", w.cast("double")).withColumn("cap", F.lit(float(epochs)) * F.col("source_size"))
    order = Window.orderBy(F.col("cap") / F.col("weight"), "skey")
    before, whole = order.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    s = s.withColumn("level", (F.sum("source_size").over(whole) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / (F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))))
    s = s.withColumn("level", F.max(F.when(F.col("level") <= F.col("cap") / F.col("weight"), F.col("level"))).over(whole))
    return s.select("skey", "source", "source_size", F.least("cap", F.col("weight") * F.col("level")).alias("target"))


def ready(docs: DataFrame, seed: int, key: str, source: str, text: str) -> DataFrame:
    """row (a struct of all columns of docs, where their names clash with none), and what the mix reads of it: id, size,
    key of the source, hash."""
    of = lambda c: F.col(f"`{c}`")
    h = bits(F.concat(F.lit(f"{seed}:"), F.coalesce(of(key).cast("long").cast("string"), F.lit(""))), HASH)
    return docs.select(F.struct(*map(of, docs.columns)).alias("row"), F.coalesce(of(key).cast("long"), F.lit(-1)).alias("__id"), words(of(text)).alias("__size"), F.coalesce(F.concat(F.lit("s"), of(source)), F.lit("n")).alias("__skey"), h.alias("__h"))


def plan(rows: DataFrame, weights: tuple[int, ...], epochs: int) -> DataFrame:
    """One row a source: how often all its documents are taken, and the last document, in the order of (hash, id, size),
    that is taken once more.

    A source's cumulated sizes are not computed over its rows: sizes are summed by source and LEAD leading hash bits
    (map-side combined), the cut is found among these sums, and only the documents in the bucket that holds the cut are
    ordered one by one. A source with a third of all rows is thus spread over all tasks.
    """
    sums = save(rows.groupBy("__skey", F.shiftright("__h", HASH - LEAD).alias("bucket")).agg(F.sum("__size").alias("part")), "mix-sums")
    targets = fill(sums.groupBy(F.col("__skey").alias("skey")).agg(F.sum("part").alias("source_size")).withColumn("source", F.when(F.col("skey") != "n", F.substr("skey", F.lit(2)))), weights, epochs)
    targets = targets.withColumn("whole", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(1).cast("int"))
    targets = save(targets.withColumn("rest", F.when(F.col("source_size") > 0, F.col("target") - F.col("whole") * F.col("source_size")).otherwise(0.0)).withColumnRenamed("skey", "__skey"), "mix-targets")
    run = F.sum("part").over(Window.partitionBy("__skey").orderBy("bucket"))
    cut = sums.withColumn("run", run).join(targets.select("__skey", "rest"), "__skey").where((F.col("rest") > 0) & (F.col("run") >= F.col("rest")))
    cut = small_enough(save(cut.groupBy("__skey").agg(F.min_by(F.struct("bucket", (F.col("run") - F.col("part")).alias("before"), "rest"), "bucket").alias("cut")).select("__skey", "cut.*"), "mix-cuts"))
    order = Window.partitionBy("__skey").orderBy("__h", "__id", "__size").rowsBetween(Window.unboundedPreceding, -1)
    edge = rows.select("__skey", "__h", "__id", "__size").join(cut, "__skey").where(F.shiftright("__h", HASH - LEAD) == F.col("bucket"))
    edge = edge.withColumn("prior", F.coalesce(F.sum("__size").over(order), F.lit(0))).where(F.col("before") + F.col("prior") + F.col("__size") / 2 <= F.col("rest"))
    last = edge.groupBy("__skey").agg(F.max(F.struct("__h", "__id", "__size")).alias("__last"))
    return save(targets.join(cut.select("__skey", "bucket"), "__skey", "left").join(last, "__skey", "left").select("__skey", F.col("source_size").alias("__source_size"), F.col("target").alias("__target"), F.col("whole").alias("__whole"), F.col("bucket").alias("__bucket"), "__last"), "mix-plan")


def repeats(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """rows with __repeats, decided row by row: how often each is taken."""
    out = rows.join(small_enough(plan), "__skey")
    own = F.shiftright("__h", HASH - LEAD)
    more = (own < F.col("__bucket")) | ((own == F.col("__bucket")) & (F.struct("__h", "__id", "__size") <= F.col("__last")))
    return out.withColumn("__repeats", F.col("__whole") + F.when(more, 1).otherwise(0))


def mix(docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), epochs: int = 3, seed: int = 0, key: str = "doc_id", source: str = "source", text: str = "text") -> DataFrame:
    """How often each document goes into the mix.

    Returns doc_id, size, source_size, target, repeats, taken (= repeats * size). A source's documents are all taken
    floor(target / source_size) times; the rest of its target is filled by documents in the order of a seeded hash of
    their id, each one more time, until the next would lead away from the target. So a source misses its target by
    half a document at most, no document exceeds `epochs` times, and a rerun gives the same rows.

    Nulls: a null text has size 0; a null source is a source of its own; a null id is hashed as a value of its own.
    Empty texts: size 0, taken 0. A source without any word is repeated once. Ties: rows of one id are ordered by size,
    and rows that agree in both are taken alike. Empty table: no rows. Other columns of docs are ignored.
    """
    rows = save(ready(docs, seed, key, source, text).select(F.col("row").getField(key).alias("doc_id"), "__id", "__size", "__skey", "__h"), "mix-rows")
    out = repeats(rows, plan(rows, weights, epochs))
    return out.select("doc_id", F.col("__size").alias("size"), F.col("__source_size").alias("source_size"), F.col("__target").alias("target"), F.col("__repeats").cast("int").alias("repeats"), (F.col("__repeats") * F.col("__size")).cast("long").alias("taken"))


def mixed(docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), epochs: int = 3, seed: int = 0, key: str = "doc_id", source: str = "source", text: str = "text") -> DataFrame:
    """docs as mixed: every row as often as mix() takes it. Texts are not shuffled; each row decides for itself."""
    rows = ready(docs, seed, key, source, text)
    slim = save(rows.select("__id", "__size", "__skey", "__h"), "mix-rows")
    out = repeats(rows, plan(slim, weights, epochs)).where("__repeats > 0")
    return out.select("row", F.explode(F.sequence(F.lit(1), F.col("__repeats"))).alias("__copy")).select(*[F.col("row").getField(c).alias(c) for c in docs.columns])


SQL = r"""
WITH d AS (SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
                  (('0x' || substr(md5('v0:' || coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT >> 8) AS h FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, ([5, 2, 1])[((row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 + 1)::INT]::DOUBLE AS weight, 3.0::DOUBLE * source_size AS cap FROM s),
l AS (SELECT *, ((sum(source_size) OVER ())::DOUBLE - coalesce(sum(cap) OVER (ORDER BY cap / weight, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
              / (sum(weight) OVER () - coalesce(sum(weight) OVER (ORDER BY cap / weight, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS lev FROM w),
t AS (SELECT source, source_size, least(cap, weight * max(CASE WHEN lev <= cap / weight THEN lev END) OVER ()) AS target FROM l),
p AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 1 END AS whole FROM t),
r AS (SELECT d.doc_id, d.size, p.source_size, p.target, p.whole, p.target - p.whole * p.source_size AS rest,
             coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY h, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS prior
      FROM d JOIN p ON d.source IS NOT DISTINCT FROM p.source)
SELECT doc_id, size, source_size, target, (whole + CASE WHEN rest > 0 AND prior + size / 2.0 <= rest THEN 1 ELSE 0 END)::INT AS repeats,
       ((whole + CASE WHEN rest > 0 AND prior + size / 2.0 <= rest THEN 1 ELSE 0 END)::BIGINT * size)::BIGINT AS taken FROM r
"""
