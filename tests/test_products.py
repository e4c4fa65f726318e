"""Products of sparse matrices and vectors of nodes: the vector is sent, the matrix stays where it is."""

import numpy as np
import pytest

from paperlake.operators import features, graph, networks


@pytest.fixture
def plans(spark, monkeypatch):
    """Of every table that features.py and networks.py write, its name and plan; nothing is broadcast but what is marked."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    seen, put = [], features.save

    def kept(df, name):
        seen.append((name, df._jdf.queryExecution().executedPlan().toString()))
        return put(df, name)

    monkeypatch.setattr(features, "save", kept)
    monkeypatch.setattr(networks, "save", kept)
    yield seen
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def ring(spark, n=12):
    nodes = spark.createDataFrame([(f"n{i:02}",) for i in range(n)], "id string")
    return nodes, spark.createDataFrame([(f"n{i:02}", f"n{(i + 1) % n:02}") for i in range(n)], "src string, dst string")


def test_chebyshev_moves_vectors_only(spark, plans):
    numbers, nodes, e = graph.by_number(*ring(spark))
    laplacian = features.rescaled_laplacian(nodes, e)
    x = nodes.selectExpr("id", "id % 2 AS k", "1.0D AS x")
    got = features.chebyshev(laplacian, x, 2)[2]
    products = [p for name, p in plans if name in ("lanczos", "features") and "Join" in p]
    assert products and all("BroadcastHashJoin" in p and "SortMergeJoin" not in p for p in products)
    # an even ring's Laplacian goes up to 2, so the rescaled one is -A / 2
    place = {r["n"]: int(r["id"][1:]) for r in numbers.collect()}
    m = np.zeros((12, 12))
    for i in range(12):
        m[i, (i + 1) % 12] = m[(i + 1) % 12, i] = -0.5
    start = np.zeros((12, 2))
    for r in x.collect():
        start[place[r["id"]], r["k"]] = 1
    want, out = 2 * m @ m @ start - start, np.zeros((12, 2))
    for r in got.collect():
        out[place[r["id"]], r["k"]] = r["x"]
    assert np.allclose(out, want, atol=1e-6)


def test_layers_move_rows_only(spark, plans):
    _, nodes, e = graph.by_number(*ring(spark))
    matrix = features.by_row(features.adjacency_normalised(nodes, e, repeats=False), e, "matrix")
    rows = nodes.selectExpr("id", "array(1.0D, 2.0D) AS v")
    for product in (networks.spread, networks.gathered):
        used = []
        out = product(matrix, rows, "v", 2, used)
        assert "SortMergeJoin" not in out._jdf.queryExecution().executedPlan().toString() and len(used) == 1
        assert all(np.allclose(r["v"], [1, 2]) for r in out.collect()) and out.count() == 12
