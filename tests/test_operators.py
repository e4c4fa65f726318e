"""Graph, features, metadata and archives on small tables worked out by hand."""

import io
import tarfile

import pytest
from pyspark.sql import functions as F

from paperlake.operators import citations, extraction, features, graph, manifest, metadata

REFS = [("a", ["b", "c", "a", "z", "b"]), ("b", ["c"]), ("c", ["a"]), ("d", [])]


@pytest.fixture
def small(spark):
    nodes = spark.createDataFrame([("a",), ("b",), ("c",), ("d",)], "id string")
    return nodes, spark.createDataFrame(REFS, "id string, refs array<string>")


def rows(df):
    return sorted(map(tuple, df.collect()))


def test_graph(spark, small):
    nodes, refs = small
    e = graph.edges(refs, nodes)
    assert rows(e) == [("a", "b"), ("a", "c"), ("b", "c"), ("c", "a")]
    assert rows(graph.edges(refs, nodes, directed=False)) == [("a", "b"), ("a", "c"), ("b", "c")]
    assert rows(graph.unknown_ids(refs, nodes)) == [("z",)]
    assert rows(graph.degrees(nodes, e)) == [("a", 1, 2), ("b", 1, 1), ("c", 2, 1), ("d", 0, 0)]
    assert rows(graph.components(nodes, e)) == [("a", "a"), ("b", "a"), ("c", "a"), ("d", "d")]
    assert rows(graph.clustering(nodes, e)) == [("a", 0.5), ("b", 1.0), ("c", 0.5), ("d", 0.0)]
    s = graph.summary(nodes, e).first()
    assert (s["nodes"], s["edges"], s["mean_degree"], s["mean_clustering"], s["largest_share"], s["isolated_share"]) == (4, 4, 2.0, 0.5, 0.75, 0.25)
    inside, kept = graph.largest(nodes, e)
    assert inside.count() == 3 and kept.count() == 4


def test_long_chain_and_star(spark):
    n = 300
    chain = spark.range(n - 1).select(F.format_string("%04d", "id").alias("src"), F.format_string("%04d", F.col("id") + 1).alias("dst"))
    nodes = spark.range(n).select(F.format_string("%04d", "id").alias("id"))
    assert graph.components(nodes, chain).select("component").distinct().collect()[0][0] == "0000"
    star = spark.range(1, n).select(F.lit("0000").alias("dst"), F.format_string("%04d", "id").alias("src"))
    assert graph.components(nodes, star).select("component").distinct().count() == 1


def test_empty_graph(spark):
    nodes, e = spark.createDataFrame([], "id string"), spark.createDataFrame([], "src string, dst string")
    assert graph.components(nodes, e).count() == 0 and graph.clustering(nodes, e).count() == 0


def test_features(spark):
    split = spark.createDataFrame([("a", 0, True), ("b", 1, True), ("c", 1, True), ("d", 0, False)], "id string, label int, train boolean")
    refs = spark.createDataFrame([("a", ["b", "c", "a"]), ("b", ["c", "d"]), ("c", []), ("d", ["a", "b"])], "id string, refs array<string>")
    m = features.citation_matrix(refs, split)
    assert rows(m) == [("a", "b", 0.5), ("a", "c", 0.5), ("b", "c", 1.0), ("d", "a", 0.5), ("d", "b", 0.5)]
    f = features.dense(features.citation_feature(m, split), split, 2)
    assert rows(f) == [("a", [0.0, 1.0]), ("b", [0.0, 1.0]), ("c", [0.0, 0.0]), ("d", [0.5, 0.5])]


def test_metrics(spark):
    s = spark.createDataFrame([(0, [0.5, 0.3, 0.2]), (0, [0.2, 0.3, 0.5])], "label int, probability array<double>")
    m = features.metrics(s).first()
    assert (m["top1"], m["top3"]) == (0.5, 1.0) and m["loglikelihood"] == pytest.approx(-2.302585, abs=1e-6) and m["perplexity"] == pytest.approx(3.162278, abs=1e-6)
    tie = spark.createDataFrame([([0.4, 0.4, 0.2],)], "p array<double>")
    assert tie.select(features.in_top(F.col("p"), F.lit(1), 1), features.in_top(F.col("p"), F.lit(0), 1)).first()[:] == (True, False)


PAGE = """<OAI-PMH xmlns="http://www.openarchives.org/OAI/2.0/"><ListRecords><record><metadata>
<arXivRaw xmlns="http://arxiv.org/OAI/arXivRaw/"><id>1501.00001</id><authors>A. One, B. Two</authors>
<title>T</title><categories>cs.LG stat.ML</categories><version version="v1"><date>d1</date></version>
<version version="v2"><date>d2</date></version><abstract>abc</abstract></arXivRaw>
</metadata></record><resumptionToken>tok|1001</resumptionToken></ListRecords></OAI-PMH>"""


def test_metadata(spark):
    pages = spark.createDataFrame([(PAGE,)], "xml string")
    r = metadata.records(pages).first()
    assert (r["id"], r["submitter"], r["doi"], r["categories"], r["versions"], r["versions_dates"]) == ("1501.00001", None, None, ["cs.LG stat.ML"], ["v1", "v2"], ["d1", "d2"])
    assert metadata.tokens(pages).first()[0] == "tok|1001"
    assert metadata.records(pages).select(features.main_category(features.primary_category(F.col("categories")))).first()[0] == "cs"
    bad = spark.createDataFrame([("<OAI-PMH><error>badVerb</error></OAI-PMH>",)], "xml string")
    with pytest.raises(Exception, match="badVerb"):
        metadata.records(bad).collect()
    hashed = metadata.hash_abstracts(metadata.records(pages))
    assert metadata.hashes_valid(metadata.records(pages), hashed).first()[0] is True
    assert metadata.hashes_valid(metadata.records(pages).limit(0), hashed).first()[0] is True


def test_archives(spark, tmp_path):
    buffer = io.BytesIO()
    with tarfile.open(fileobj=buffer, mode="w") as t:
        for name in ("0001/a.pdf", "0001/b.txt", "0001/c.pdf"):
            t.addfile(tarfile.TarInfo(name), io.BytesIO())
    (tmp_path / "x.tar").write_bytes(buffer.getvalue())
    got = manifest.inventory(spark.read.format("binaryFile").load(str(tmp_path)))
    assert rows(got) == [("x.tar", "0001/a.pdf"), ("x.tar", "0001/c.pdf")]
    lacking = spark.createDataFrame([("t1", ["x"] * 1), ("t2", ["x"] * 3), ("t3", ["x"] * 1)], "tar string, pdfs array<string>")
    assert [r["tar"] for r in manifest.rerun_order(lacking).orderBy("position").collect()] == ["t2", "t3", "t1"]


def test_extraction(spark):
    def first(content):
        if content.startswith(b"!"):
            raise ValueError("damaged")
        return content.decode()

    files = spark.createDataFrame([("a", bytearray(b"some words")), ("b", bytearray(b"!x")), ("c", None), ("d", bytearray(b"x" * 200))], "id string, content binary")
    got = {r["id"]: (r["text"], r["error"]) for r in extraction.extract(files, [first]).collect()}
    assert got == {"a": ("some words", None), "b": (None, "ValueError: damaged"), "c": (None, "empty file"), "d": (None, "no words")}
    texts = spark.createDataFrame([("a", "x y"), ("b", None)], "id string, text string")
    assert {r["id"]: len(r["embedding"]) for r in extraction.embed(texts).collect()} == {"a": 64, "b": 64}


def test_contexts(spark):
    t = spark.createDataFrame([("a", "0123456789 1503.01017 1612.00001!")], "id string, text string")
    from paperlake.functions.ids import PATTERNS

    assert [r["context"] for r in citations.contexts(t, PATTERNS["simple"], 3).collect()] == ["89 1503.01017 16", " 1612.00001!"]


def test_chebyshev_of_the_rescaled_laplacian(spark, monkeypatch):
    """T_0 to T_2, and the query, against dense matrices; node 30 has no edge."""
    import numpy as np

    from paperlake.plans import catalogue

    rng = np.random.default_rng(4)
    pairs = sorted({(int(a), int(b)) for a, b in rng.integers(0, 30, (60, 2)) if a < b} | {(0, 1), (1, 2), (0, 2)})
    a = np.zeros((31, 31))
    for i, j in pairs:
        a[i, j] = a[j, i] = 1
    d = a.sum(1)
    root = np.where(d > 0, 1 / np.sqrt(np.maximum(d, 1)), 0)
    laplacian = np.eye(31) - root[:, None] * a * root
    scaled = 2 / np.linalg.eigvalsh(laplacian)[-1] * laplacian - np.eye(31)
    x = np.zeros((31, 3))
    x[np.arange(31), np.arange(31) % 3] = 1
    nodes = spark.createDataFrame([(i, i % 3) for i in range(31)], "id long, label int")
    e = spark.createDataFrame(pairs, "src long, dst long")
    rows = nodes.select("id", F.col("label").alias("k"), F.lit(1.0).alias("x"))

    def dense(df):
        out = np.zeros((31, 3))
        for r in df.collect():
            out[r["id"], r["k"]] = r["x"]
        return out

    want = [x, scaled @ x, 2 * scaled @ scaled @ x - x]
    got = features.chebyshev(features.rescaled_laplacian(nodes, e), rows, 2)
    for g, w in zip(got, want, strict=True):
        assert np.allclose(dense(g), w, atol=1e-6)
    monkeypatch.setattr(catalogue, "_graph", lambda *_: (nodes, e))
    assert np.allclose(dense(catalogue.graph_chebyshev(spark, "")), want[2], atol=1e-6)


def test_ablation_trains_fully_on_both_halves(spark, monkeypatch):
    from conftest import SF

    from paperlake.plans import catalogue

    seen, scores = [], spark.createDataFrame([(0, [0.6, 0.4])], "label int, probability array<double>")
    monkeypatch.setattr(features, "train_and_score", lambda rows, names, iterations=50: seen.append((rows, iterations)) or scores)
    catalogue.ablation_metrics(spark, SF)
    assert {n for _, n in seen} == {50}
    whole = {r["vec_id"]: r["embedding"] for r in spark.read.parquet(f"{SF}/embeddings.parquet").limit(5).collect()}
    assert all(r["head"] + r["tail"] == whole[r["id"]] for r in seen[0][0].where(F.col("id").isin(list(whole))).collect())
