"""Web archives: writing records, with revisits of equal payloads, and reading them back by verified boundaries.

Records are written by Spark's text writer, whose line end is here the end of a record, and found by its text reader,
whose line end is here the magic that records begin with: each task so gets the candidates of its byte range, wherever the
archives lie. A candidate becomes a record only if a chain of lengths leads to it from the start of its file.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import drop, save, small_enough

MAGIC, BREAK = "WARC/1.", "\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
NAME = "urn:x-page:"


def base32_sha1(data: Column) -> Column:
    """The SHA-1 of bytes in upper-case base32: ten hexadecimal digits are eight of base 32."""
    digits = [F.lpad(F.conv(F.substring(F.sha1(data), i, 10), 16, 32), 8, "0") for i in (1, 11, 21, 31)]
    return F.translate(F.concat(*digits), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def revisits(pages: DataFrame, key: str, url: str, payload: str, least: int = 0) -> DataFrame:
    """key, uri, body (bytes), digest, kind, first: one row a page. Of pages with equal bodies of at least `least` bytes
    that of the smallest (key, url) is the response, nulls after all others, and `first` is its key in the others' rows.
    Digests are counted with map-side combine; only what repeats is joined, and rows that repeat the response's own key
    and url are counted, so no group meets in one task."""
    of = lambda c: F.col(f"`{c}`")
    rows = pages.select(of(key).cast("long").alias("key"), of(url).cast("string").alias("uri"), F.coalesce(of(payload).cast("binary"), F.lit("").cast("binary")).alias("body"))
    rows = rows.withColumn("digest", base32_sha1(F.col("body")))
    order = F.struct(F.col("key").isNull().alias("k"), "key", F.col("uri").isNull().alias("u"), "uri")
    same = save(rows.where(F.octet_length("body") >= least).groupBy("digest").agg(F.min(order).alias("head"), F.count("*").alias("n")).where("n > 1").select("digest", "head.key", "head.uri"), "repeated")
    same = small_enough(same).select(F.col("digest").alias("__digest"), F.col("key").alias("first"), F.col("uri").alias("__uri"))
    told = rows.join(same, F.col("digest") == F.col("__digest"), "left")
    heading = F.col("key").eqNullSafe(F.col("first")) & F.col("uri").eqNullSafe(F.col("__uri"))
    alone = F.col("__digest").isNull()
    others = told.where(alone | ~heading).select("key", "uri", "body", "digest", F.when(alone, "response").otherwise("revisit").alias("kind"), F.when(~alone, F.col("first")).alias("first"))
    heads = rows.join(same, F.col("digest") == F.col("__digest")).where(heading).groupBy("key", "uri", "digest").agg(F.first("body").alias("body"), F.count("*").alias("n"))
    heads = heads.withColumn("i", F.explode(F.sequence(F.lit(1), F.col("n"))))
    return others.unionByName(heads.select("key", "uri", "body", "digest", F.when(F.col("i") == 1, "response").otherwise("revisit").alias("kind"), F.when(F.col("i") > 1, F.col("key")).alias("first")))


def write(pages: DataFrame, path: str, key: str = "page_id", url: str = "url", payload: str = "html", least: int = 0, date: str | None = None) -> None:
    """One record a page, in as many files as there are tasks: `response` with the payload as the body of an HTTP answer,
    or `revisit` (see revisits) with the answer's header only.

    Record ids name the page's key (rows that repeat a key repeat it). A null payload is an empty one; a null key or url
    leaves its field empty; line ends in a url are written as %0D and %0A. `date`: an ISO time, else now. An empty table
    gives archives without records. Other columns are not read.
    """
    text = lambda c: F.coalesce(c.cast("string"), F.lit(""))
    size = F.octet_length("body")
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), size.cast("string"), F.lit(BREAK))
    revisit = F.col("kind") == "revisit"
    when = F.lit(date) if date else F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    uri = F.replace(F.replace(text(F.col("uri")), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    fields = [
        F.lit("WARC/1.1\r\nWARC-Type: "), F.col("kind"), F.lit(f"\r\nWARC-Record-ID: <{NAME}"), text(F.col("key")), F.lit(">\r\nWARC-Date: "), when,
        F.lit("\r\nWARC-Target-URI: "), uri, F.lit("\r\nWARC-Payload-Digest: sha1:"), F.col("digest"),
        F.when(revisit, F.concat(F.lit(f"\r\nWARC-Profile: {PROFILE}\r\nWARC-Refers-To: <{NAME}"), text(F.col("first")), F.lit(">"))).otherwise(""),
        F.lit("\r\nContent-Type: application/http; msgtype=response\r\nContent-Length: "), (F.octet_length("http") + F.when(revisit, 0).otherwise(size)).cast("string"), F.lit(BREAK),
    ]
    head = revisits(pages, key, url, payload, least).withColumn("http", http).withColumn("head", F.concat(*fields, F.col("http")))
    # bytes are bytes: neither the cast nor the writer looks into them
    record = F.concat(F.col("head").cast("binary"), F.when(revisit, F.lit("").cast("binary")).otherwise(F.col("body"))).cast("string")
    head.select(record.alias("value")).write.option("lineSep", BREAK).text(path)


def scanned(spark: SparkSession, path: str) -> DataFrame:
    """file, block (its byte range), at (order within it), file_size, value: what stands between one magic and the next."""
    lines = spark.read.option("lineSep", MAGIC).text(path)
    return lines.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at"), F.col("_metadata.file_size").alias("file_size"), "value")


def fields(lines: DataFrame) -> DataFrame:
    """lines with `size` (bytes to the next magic), `extent` (bytes of the record that it would be; null: of none) and what
    a record's header and block say, for a value that is a whole record without its first magic."""
    field = lambda name: F.regexp_extract("head", rf"(?i)\r\n{name}:[ \t]*([^\r]*)", 1)
    out = lines.withColumn("head", F.concat(F.substring_index("value", BREAK, 1), F.lit("\r\n")))
    begins = F.octet_length("head") + 2
    length = F.when(F.col("head").rlike(r"^\d\r\n") & (begins < F.octet_length("value") + 1), field("Content-Length").try_cast("long"))
    out = out.withColumn("size", F.octet_length("value").cast("long") + len(MAGIC)).withColumn("length", length)
    out = out.withColumn("extent", F.col("length") + begins + len(MAGIC) + len(BREAK))
    out = out.withColumn("block_bytes", F.substring(F.col("value").cast("binary"), begins + 1, F.least("length", F.lit(2**31 - 1)).cast("int")))
    out = out.withColumn("answer", F.substring_index(F.col("block_bytes").cast("string"), BREAK, 1))
    http = F.lower(field("Content-Type")).startswith("application/http")
    payload = F.when(http, F.substring(F.col("block_bytes"), F.octet_length("answer") + 1 + len(BREAK), F.lit(2**31 - 1))).otherwise(F.col("block_bytes"))
    told = F.regexp_extract(F.concat(F.lit("\r\n"), F.col("answer"), F.lit("\r\n")), r"(?i)\r\nContent-Length:[ \t]*(\d+)", 1).try_cast("long")
    name = lambda c: F.nullif(F.regexp_extract(field(c), "^<?(.*?)>?$", 1), F.lit(""))
    out = out.withColumn("kind", F.lower(field("WARC-Type"))).withColumn("payload", F.when(F.col("kind") != "revisit", payload))
    declared = F.nullif(F.regexp_extract(field("WARC-Payload-Digest"), "(?i)^sha1:(.*)$", 1), F.lit(""))
    digest = F.when(F.col("kind") == "revisit", declared).otherwise(base32_sha1(F.col("payload")))
    return out.select(
        *lines.columns, "size", "extent", "kind", name("WARC-Record-ID").alias("record_id"), F.nullif(field("WARC-Target-URI"), F.lit("")).alias("uri"), field("WARC-Date").alias("date"), name("WARC-Refers-To").alias("refers_to"),
        F.when(F.col("kind") == "revisit", told).otherwise(F.octet_length("payload")).cast("long").alias("payload_bytes"), digest.alias("payload_digest"), (digest.eqNullSafe(declared) | declared.isNull()).alias("intact"), "payload",
    )


def ends(starts: np.ndarray, to: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each candidate of a byte range, the last one of its chain within the range; and its successor's place there, or
    its own if the successor is elsewhere. Pointers jump: each round doubles how far they reach."""
    place = np.minimum(np.searchsorted(starts, to), len(starts) - 1)
    step = np.where(starts[place] == to, place, np.arange(len(starts)))
    last = step
    while (further := last[last]).tolist() != last.tolist():
        last = further
    return last, step


def leaving(t: pa.Table) -> pa.Table:
    """file, start, exit: where the chain of each candidate leaves its byte range."""
    t = t.sort_by("start")
    starts, to = t.column("start").to_numpy(), t.column("next").fill_null(-1).to_numpy()
    return pa.table({"file": t.column("file"), "start": t.column("start"), "exit": to[ends(starts, to)[0]]})


def following(t: pa.Table) -> pa.Table:
    """file, start, real: whether a chain from a candidate of the range that is reached (entry) leads there."""
    t = t.sort_by("start")
    starts, to = t.column("start").to_numpy(), t.column("next").fill_null(-1).to_numpy()
    real, step = t.column("entry").to_numpy().copy(), ends(starts, to)[1]
    while True:
        was = int(real.sum())
        real[step[real]] = True
        step = step[step]
        if int(real.sum()) == was and (step == step[step]).all():
            return pa.table({"file": t.column("file"), "start": t.column("start"), "real": real})


def chained(lines: DataFrame) -> DataFrame:
    """lines (file, block, at, file_size, size, extent and more), a written table, with start (byte offset) and real. The
    candidates of a byte range are followed within it; what is joined and doubled round after round are the few places
    where chains enter a range, so rounds are the logarithm of a file's ranges."""
    within = Window.partitionBy("file", "block").orderBy("at")
    totals = lines.groupBy("file", "block").agg(F.sum("size").alias("total"))
    totals = totals.select("file", "block", (F.sum("total").over(Window.partitionBy("file").orderBy("block")) - F.col("total")).alias("base"))
    placed = lines.withColumn("before", F.sum("size").over(within) - F.col("size")).join(totals, ["file", "block"])
    placed = placed.withColumn("start", F.col("base") + F.col("before") - len(MAGIC)).drop("before", "base")
    placed = save(placed.withColumn("next", F.col("start") + F.col("extent")), "candidates")
    slim = placed.where("start >= 0").select("file", "block", "start", "next")
    hops = save(slim.groupBy("file", "block").applyInArrow(leaving, "file string, start bigint, exit bigint"), "hops")
    targets = hops.select("file", F.col("exit").alias("start")).unionByName(hops.select("file", F.lit(0).cast("long").alias("start"))).distinct()
    jumps = save(hops.join(targets, ["file", "start"], "left_semi"), "jumps")
    reached = save(jumps.where("start = 0").select("file", "start"), "reached")
    most = placed.groupBy("file").agg(F.countDistinct("block").alias("n")).agg(F.max("n")).first()[0] or 1
    for _ in range(int(most - 1).bit_length()):
        more = reached.unionByName(reached.join(jumps, ["file", "start"]).select("file", F.col("exit").alias("start"))).distinct()
        far = jumps.join(jumps.select("file", F.col("start").alias("exit"), F.col("exit").alias("on")), ["file", "exit"]).select("file", "start", F.col("on").alias("exit"))
        more, far = save(more, "reached"), save(far, "jumps")
        drop(reached, jumps)
        reached, jumps = more, far
    entered = slim.join(reached.withColumn("entry", F.lit(True)), ["file", "start"], "left").fillna(False, ["entry"])
    real = entered.groupBy("file", "block").applyInArrow(following, "file string, start bigint, real boolean")
    out = save(placed.join(real, ["file", "start"], "left"), "chained")
    drop(placed, hops, jumps, reached)
    return out


def records(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    """The records of the archives at `path`: file, kind, record_id, uri, date, refers_to, payload_bytes, payload_digest,
    intact, and the payload (bytes; of a revisit null) if it is wanted.

    Digests and lengths are those of what was read; a revisit has them from its own header. `intact`: the digest is the
    declared one, if any is. A file's records are those that a chain of lengths from its start leads to; magic inside
    payloads is rejected, whole records there included. A file without such a chain to its very end is damaged: ValueError
    names one. Files that hold magic inside payloads are read once more, into a table of their lines; the others' payloads
    come straight from the archives. Files of no bytes have no records. Archives must not be compressed.
    """
    found = save(fields(scanned(spark, path)).drop("value", "payload"), "found")
    chain = chained(found)
    drop(found)
    whole = F.max(F.when(F.col("real"), F.col("next"))).alias("end")
    damaged = chain.groupBy("file").agg(whole, F.max("file_size").alias("file_size")).where("end IS NULL OR end <> file_size").select("file").limit(1).collect()
    if damaged:
        raise ValueError(f"no chain of records leads to the end of {damaged[0]['file']}")
    odd = save(chain.where("start >= 0 AND (NOT real OR extent <> size)").select("file").distinct(), "odd")
    names = ["file", "kind", "record_id", "uri", "date", "refers_to", "payload_bytes", "payload_digest", "intact"]
    if not odd.limit(1).count():
        if not payload:
            return chain.where("real").select(*names)
        return fields(scanned(spark, path)).where("extent IS NOT NULL").select(*names, "payload")
    some = small_enough(odd)
    lines = save(fields(scanned(spark, path).join(some, "file", "left_semi")).select("file", "block", "at", "file_size", "size", "extent", "value"), "lines")
    owned = F.max(F.when(F.col("real"), F.col("start"))).over(Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, 0))
    parts = chained(lines).where("start >= 0")
    simple = parts.where("real AND extent = size").select("file", "value")
    pieces = save(parts.where("NOT real OR extent <> size").withColumn("owner", owned), "pieces")
    joined = pieces.groupBy("file", "owner").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("start", "value"))), lambda p: p["value"]), MAGIC).alias("value")).select("file", "value")
    rest = scanned(spark, path).join(some, "file", "left_anti").select("file", "value")
    columns = [*names, "payload"] if payload else names
    plain = fields(rest).where("extent IS NOT NULL") if payload else chain.join(some, "file", "left_anti").where("real")
    return reduce(DataFrame.unionByName, [plain.select(*columns), *(fields(x).select(*columns) for x in (simple, joined))])


def page_key(name: Column) -> Column:
    """The page that a record id written by write() names."""
    return F.regexp_extract(name, f"^{NAME}(-?[0-9]+)$", 1).try_cast("long")


SQL = """
WITH bodies AS (SELECT page_id, encode(coalesce(html, '')) AS body FROM pages),
hashed AS (SELECT page_id, octet_length(body) AS payload_bytes, sha1(body) AS h, body FROM bodies),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY body ORDER BY page_id NULLS LAST) AS place, first_value(page_id) OVER (PARTITION BY body ORDER BY page_id NULLS LAST) AS head
  FROM hashed)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes,
  list_aggregate(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    CAST(('0x' || substr(h, CAST(5 * (i // 4) + 1 AS BIGINT), 5))::BIGINT >> CAST(5 * (3 - i % 4) AS BIGINT) & 31 AS BIGINT) + 1, 1)), 'string_agg', '') AS payload_digest,
  CASE WHEN place = 1 THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN place > 1 THEN head END AS refers_to
FROM ranked
"""
