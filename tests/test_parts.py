"""Shares of tasks as tables grow."""

from paperlake.operators import graph
from paperlake.operators.shared import parts


def test_parts_grow_with_files(spark, tmp_path):
    spark.range(20_000).selectExpr("cast(id as string) id", "array(cast(id * 7 % 1000 as string)) refs").repartition(3).write.parquet(f"{tmp_path}/c")
    c = spark.read.parquet(f"{tmp_path}/c")
    size = sum(f.stat().st_size for f in (tmp_path / "c").glob("*.parquet"))
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert parts(c) == least and parts(c, size=size // 50) in (50, 51)
    assert abs(parts(c, size=size // 50, most=1) - 50) < 10
    assert parts(spark.createDataFrame([("a",)], "id string")) == least


def test_edges_are_told_apart_first(spark):
    """Pairs are dealt by both ends before targets are looked up, whatever the number of rows that repeat them."""
    c = spark.createDataFrame([("a", ["b", "b", "a", "x"]), ("a", ["b"]), ("b", ["a"]), ("c", None)], "id string, refs array<string>")
    n = spark.createDataFrame([("a",), ("b",), ("b",), ("c",)], "id string")
    assert sorted(map(tuple, graph.edges(c, n).collect())) == [("a", "b"), ("b", "a")]
    assert sorted(map(tuple, graph.edges(c, n, directed=False).collect())) == [("a", "b")]
    plan = graph.edges(c, n)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("LeftSemi") < plan.index("Aggregate") < plan.index("Repartition")
