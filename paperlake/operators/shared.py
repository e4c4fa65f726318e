"""Written tables in the shared folder, size-checked broadcasts, and connected components."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors see, which the cluster names in spark.checkpoint.dir. Only where
    driver and executors are one process is a temporary folder made when it is unset."""
    at = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not at:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        at = "file://" + tempfile.mkdtemp(prefix="paperlake-")
        spark.sparkContext.setCheckpointDir(at)
    return at.rstrip("/")


def save(df: DataFrame, name: str) -> DataFrame:
    """Write df to the shared folder and read it back: lineage ends there, so a lost executor costs one task's work."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/paperlake/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.saved_at = path
    return out


def _folder(df: DataFrame):
    path = df.sparkSession.sparkContext._jvm.org.apache.hadoop.fs.Path(df.saved_at)
    return path, path.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration())


def drop(*saved: DataFrame) -> None:
    """Remove tables written by save() once nothing reads them any more."""
    for df in saved:
        path, store = _folder(df)
        store.delete(path, True)


def small_enough(df: DataFrame, size: int = 4 << 20) -> DataFrame:
    """df, a table written by save(), marked for broadcast if its files hold at most `size` bytes, else as it is: Spark
    then shuffles it and splits skew. Only the files' sizes are asked for."""
    path, store = _folder(df)
    return F.broadcast(df) if store.getContentSummary(path).getLength() <= size else df


#: Bytes of the files of a vector of nodes that is broadcast, at most.
VECTOR = 64 << 20


def parts(df: DataFrame, size: int = 4 << 20, most: int = 1000) -> int:
    """How many partitions to deal df to, so that a task's share stays the same as tables grow: one for each `size` bytes
    of the files that df is read from (of more than `most` files, as if the others were like these), and no fewer than
    shuffles have."""
    spark, files = df.sparkSession, df.inputFiles()
    path, conf = spark.sparkContext._jvm.org.apache.hadoop.fs.Path, spark.sparkContext._jsc.hadoopConfiguration()
    total = sum((p := path(f)).getFileSystem(conf).getFileStatus(p).getLen() for f in files[:most])
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total * max(1, len(files)) // (max(1, min(most, len(files))) * size)))


def positions(rows: DataFrame, *order, into: str = "position") -> DataFrame:
    """rows with their place, from 1, in an order: a sort by ranges, whose parts number their rows on their own; what is
    summed in one task is one number a part."""
    at = F.monotonically_increasing_id()
    placed = save(rows.orderBy(*order).withColumn("__at", at).withColumn("__part", F.shiftright("__at", 33)), "sorted")
    parts = placed.groupBy("__part").agg(F.count("*").alias("n"))
    before = parts.select("__part", (F.sum("n").over(Window.orderBy("__part")) - F.col("n")).alias("__before"))
    place = F.col("__before") + F.col("__at").bitwiseAND((1 << 33) - 1) + 1
    return placed.join(F.broadcast(before), "__part").withColumn(into, place.cast("int")).drop("__part", "__at", "__before")


class Union:
    """Numbers joined into sets, each known by its smallest member."""

    def __init__(self):
        self.up: dict[int, int] = {}

    def root(self, x: int) -> int:
        up = self.up
        while (y := up.setdefault(x, x)) != x:
            up[x] = x = up[y]
        return x

    def join(self, a: int, b: int) -> bool:
        """Whether the two were apart."""
        a, b = self.root(a), self.root(b)
        if a == b:
            return False
        self.up[max(a, b)] = min(a, b)
        return True


def forest(edges: DataFrame, most: int = 500_000) -> DataFrame:
    """Edges (src, dst: longs) that connect what all of them connect: edges are dealt by src, and a task passes on those
    that its own haven't connected yet. After `most` nodes a task starts anew, which costs edges but no connection."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets = Union()
        for batch in batches:
            if len(sets.up) > most:
                sets = Union()
            a, b = batch.column(0), batch.column(1)
            kept = np.fromiter((sets.join(x, y) for x, y in zip(a.to_pylist(), b.to_pylist(), strict=True)), bool, batch.num_rows)
            yield batch.filter(pa.array(kept))

    return edges.select("src", "dst").repartition("src").mapInArrow(run, "src bigint, dst bigint")


def connected(edges: DataFrame, a: str = "src", b: str = "dst", rounds: int = 60, few: int = 250_000) -> DataFrame:
    """Components of an undirected graph by alternating large-star and small-star steps.

    edges: two long columns; rows with a null in either are left out. Returns (node, component): component is the
    smallest node reachable, for every node that has an edge to another one. Edges are first thinned within tasks (see
    forest), dealt by either end. Each round is two aggregations with map-side combine and two equi-joins, its result is
    written to the shared folder; nothing is collected but the number of changed rows. Where no more than `few` edges are
    left by the tasks (half of what a task holds to thin them, see forest), one more task joins them and no round is needed.
    """

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets = Union()
        for batch in batches:
            for x, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                sets.join(x, y)
        nodes = list(sets.up)
        yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array([sets.root(x) for x in nodes], pa.int64())], names=["node", "component"])

    def star(e: DataFrame, large: bool) -> DataFrame:
        both = e.unionByName(e.select(F.col("dst").alias("src"), F.col("src").alias("dst"))) if large else e
        low = both.groupBy("src").agg(F.least(F.min("dst"), F.col("src")).alias("low"))
        got = both.join(low, "src")
        if large:
            return got.where("dst > src").select(F.col("dst").alias("src"), F.col("low").alias("dst")).where("src <> dst").distinct()
        # the node itself hangs below its smallest neighbour too
        return got.select(F.col("dst").alias("src"), F.col("low").alias("dst")).unionByName(low.select("src", F.col("low").alias("dst"))).where("src <> dst").distinct()

    ends = edges.select(F.greatest(a, b).alias("src"), F.least(a, b).alias("dst")).where("src <> dst").where(F.col(a).isNotNull() & F.col(b).isNotNull())
    thin = forest(ends.distinct())
    now = save(forest(thin.select(F.col("dst").alias("src"), F.col("src").alias("dst"))).select(F.col("dst").alias("src"), F.col("src").alias("dst")), "edges")
    if now.count() <= few:
        return now.select("src", "dst").coalesce(1).mapInArrow(joined, "node bigint, component bigint")
    last = None
    for _ in range(rounds):
        new = save(star(star(now, True), False), "edges")
        state = new.agg(F.count("*"), F.sum(F.xxhash64("src", "dst").cast("decimal(38,0)"))).first()
        drop(now)
        now = new
        if state == last:
            break
        last = state
    else:
        raise RuntimeError("components did not settle")
    return now.select(F.col("src").alias("node"), F.col("dst").alias("component")).unionByName(now.select(F.col("dst").alias("node"), F.col("dst").alias("component")).distinct())
