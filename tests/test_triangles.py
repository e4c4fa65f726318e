"""Triangles counted by colours, against all triples."""

from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from paperlake.operators import graph, triangles


@pytest.mark.parametrize("colours", [1, 2, 5])
def test_triangles_by_colours(spark, monkeypatch, tmp_path, colours):
    monkeypatch.setattr(triangles, "PATHS", 16)
    rng = np.random.default_rng(3)
    n = 40
    links = {(int(a), int(b)): int(w) for a, b, w in zip(rng.integers(0, n, 500), rng.integers(0, n, 500), rng.integers(1, 3, 500), strict=True) if a < b}
    spark.createDataFrame([p for p, w in links.items() for _ in range(w)], "u int, v int").write.parquet(str(tmp_path / "pairs"))
    want = np.zeros(n, int)
    for a, b, c in combinations(range(n), 3):
        w = links.get((a, b), 0) * links.get((a, c), 0) * links.get((b, c), 0)
        want[[a, b, c]] += w
    t, m = triangles.triangles(spark.read.parquet(str(tmp_path / "pairs")), n, least=colours)
    assert {r["n"]: r["t"] for r in t.collect()} == {i: x for i, x in enumerate(want.tolist()) if x}
    twice = [i for p, w in links.items() if w == 2 for i in p]
    assert {r["n"]: r["m"] for r in m.collect()} == {i: twice.count(i) for i in set(twice)}


def test_clustering_writes_no_paths(spark, monkeypatch):
    """A star of 300 leaves has 44,850 paths of two links; links, not paths, are what the steps pass on."""
    nodes = spark.range(301).select(F.col("id").cast("string"))
    e = spark.range(1, 301).select(F.lit("0").alias("src"), F.col("id").cast("string").alias("dst"))
    e = e.unionByName(spark.createDataFrame([("1", "2"), ("2", "1")], "src string, dst string"))
    plain, rows = triangles.triangles, []

    def seen(pairs, count, **settings):
        rows.append(pairs.count())
        return plain(pairs, count, **settings)

    monkeypatch.setattr(graph, "triangles", seen)
    got = {r["id"]: r["clustering"] for r in graph.clustering(nodes, e).collect()}
    assert rows == [302] and len(got) == 301
    # nodes 1 and 2 have three links each and one triangle, its links' weights 1, 1 and 2
    assert got["1"] == got["2"] == pytest.approx(4 / (2 * (3 * 2 - 2))) and got["3"] == 0 and got["0"] == pytest.approx(4 / (2 * 300 * 299))
