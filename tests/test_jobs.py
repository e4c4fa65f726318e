"""Downloads, extraction with time limits, archives, stores and networks."""

import gzip
import hashlib
import http.server
import pickle
import threading
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from paperlake.operators import archives, extraction, features, networks
from paperlake.operators.shared import positions
from paperlake.sources import harvest, remote, stores


@pytest.fixture(scope="module")
def server(tmp_path_factory):
    """Files of a folder, and a harvest of three pages whose second is refused once."""
    folder, refused = tmp_path_factory.mktemp("served"), []
    (folder / "a.tar").write_bytes(b"a" * 3_000_000)
    (folder / "b.tar").write_bytes(b"b")

    class Handler(http.server.BaseHTTPRequestHandler):
        def log_message(self, *_):
            pass

        def do_GET(self):
            if "verb=" in self.path:
                page = int(self.path.split("=")[-1]) if "resumptionToken" in self.path else 0
                if page == 1 and not refused:
                    refused.append(page)
                    self.send_response(503)
                    self.send_header("Retry-After", "2")
                    self.end_headers()
                    return
                body = f"<x><id>{page}</id><resumptionToken n='1'>{page + 1 if page < 2 else ''}</resumptionToken></x>".encode()
                body = b"<x><error code='badArgument'>no</error></x>".replace(b"'", b'"') if page == 9 else body
            else:
                at = folder / self.path.rsplit("/", 1)[-1]
                if not at.exists():
                    self.send_error(404)
                    return
                body = at.read_bytes()
            self.send_response(200)
            self.end_headers()
            self.wfile.write(body)

    s = http.server.ThreadingHTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=s.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{s.server_port}"
    s.shutdown()


def test_harvest_over_http(server):
    waited = []
    fetch = harvest.polite(remote.http(server), waited.append, remote.busy)
    token, pages = None, []
    while True:
        xml, token = fetch(token)
        pages.append(xml.split("<id>")[1][0])
        if not token:
            break
    assert pages == ["0", "1", "2"] and waited == [3.0]
    with pytest.raises(RuntimeError, match="badArgument: no"):
        fetch("9")


def test_downloads(spark, server, tmp_path):
    a = hashlib.md5(b"a" * 3_000_000).hexdigest()
    files = spark.createDataFrame([("x/a.tar", a), ("x/b.tar", "told otherwise"), ("x/none.tar", "")], "filename string, md5sum string")
    got = {r["filename"]: r for r in remote.downloads(files, server, str(tmp_path)).collect()}
    assert got["x/a.tar"]["md5sum"] == a and got["x/b.tar"]["md5sum"] != got["x/b.tar"]["expected"] and "404" in got["x/none.tar"]["error"]
    assert gzip.open(tmp_path / "a.tar.gz").read() == b"a" * 3_000_000 and sorted(p.name for p in tmp_path.iterdir()) == ["a.tar.gz", "b.tar.gz"]
    # what is there is hashed and not fetched; a dry run does neither
    assert remote.download("http://127.0.0.1:1/nothing", str(tmp_path / "a.tar.gz")) == a
    assert remote.download("http://127.0.0.1:1/nothing", str(tmp_path / "c.gz"), dry=True) == hashlib.md5(b"").hexdigest()


def test_manifest_is_fetched_once(spark, server, tmp_path):
    target = tmp_path / "m.xml.gz"
    with gzip.open(target, "wb") as f:
        f.write(b"<all><file><filename>f</filename><md5sum>s</md5sum><first_item>a</first_item><last_item>b</last_item></file></all>")
    assert [tuple(r) for r in remote.manifest(spark, "http://127.0.0.1:1/m.xml", str(target)).collect()] == [("f", "s", "a", "b")]


def test_time_limits():
    def slow(content):
        time.sleep(30)

    began = time.time()
    with pytest.raises(TimeoutError):
        extraction.within(slow, 0.3)(b"")
    assert time.time() - began < 10 and extraction.within(lambda b: b.decode(), 10)(b"ok") == "ok"
    with pytest.raises(RuntimeError, match="UnicodeDecodeError"):
        extraction.within(lambda b: b.decode(), 10)(b"\xff")
    assert extraction.command("cp", "IN", "OUT", seconds=10)(b"text") == "text"
    with pytest.raises(RuntimeError):
        extraction.command("false", seconds=10)(b"")
    with pytest.raises(Exception, match="timed out"):
        extraction.command("sleep", "20", seconds=0.2)(b"")
    assert len(extraction.pdf_tools()) == 3


def test_archives(spark):
    files = spark.createDataFrame([("t1", "1501.00001.pdf", bytearray(b"one")), ("t1", "1501.00002.pdf", bytearray(b"two")), ("t2", "1501.00003.pdf", bytearray(b""))], "tar string, member string, content binary")
    packed = archives.packed(files)
    assert sorted(map(tuple, archives.contents(packed).collect())) == [("t1", "1501.00001.pdf", b"one", None), ("t1", "1501.00002.pdf", b"two", None), ("t2", "1501.00003.pdf", b"", None)]
    wanted = spark.createDataFrame([("t1", ["1501.00002.pdf", "no.pdf"])], "tar string, pdfs array<string>")
    assert [r["member"] for r in archives.contents(packed, wanted).collect()] == ["1501.00002.pdf"]
    broken = spark.createDataFrame([("x", bytearray(b"not a tar")), ("y", bytearray(b""))], "tar string, content binary")
    assert {(r["tar"], r["member"], r["error"] is not None) for r in archives.contents(broken).collect()} == {("x", None, True), ("y", None, True)}
    cut = packed.where("tar = 't1'").select("tar", F.substring("content", 1, 1100).alias("content"))
    assert [(r["member"], r["error"] is None) for r in archives.contents(cut).collect()][0] == ("1501.00001.pdf", True)


def test_pickled_batches(spark, tmp_path):
    with (tmp_path / "e.pkl").open("wb") as f:
        for x in ("a header", np.ones((2, 3), np.float32), [[1.0, 2.0, 3.0]]):
            pickle.dump(x, f)
    rows = stores.import_pickled(spark.read.format("binaryFile").load(str(tmp_path)), headers=1).collect()
    assert sorted((r["batch"], r["row"], r["embedding"]) for r in rows) == [(0, 0, [1, 1, 1]), (0, 1, [1, 1, 1]), (1, 0, [1, 2, 3])]
    bad = tmp_path / "bad"
    bad.mkdir()
    with (bad / "x.pkl").open("wb") as f:
        pickle.dump(time.sleep, f)
    with pytest.raises(Exception, match="is not read"):
        stores.import_pickled(spark.read.format("binaryFile").load(str(bad))).collect()


def test_positions(spark):
    rows = spark.range(1000).select((F.col("id") * 7 % 1000).alias("x")).repartition(5)
    assert all(r["position"] == r["x"] + 1 for r in positions(rows, "x").collect()) and positions(rows.limit(0), "x").count() == 0


def dense_network(s, spread, x, y, train, epochs):
    """The same network in numpy, with its gradients by finite differences."""
    rng = np.random.default_rng(s.seed)
    w = [rng.uniform(-1, 1, z) * np.sqrt(6 / sum(z)) for z in ((x.shape[1], s.hidden), (s.hidden, y.max() + 1))]

    def cost(w, rows, decay=0.0):
        z = spread @ np.maximum(spread @ x @ w[0], 0) @ w[1]
        z = z - z.max(1, keepdims=True)
        logp = z - np.log(np.exp(z).sum(1, keepdims=True))
        return -logp[np.arange(len(y)), y][rows].mean() + decay / 2 * (w[0] ** 2).sum()

    m, v, costs = [0, 0], [0, 0], []
    for t in range(1, epochs + 1):
        costs.append((cost(w, train), cost(w, ~train)))
        new = []
        for k in range(2):
            g = np.zeros_like(w[k])
            for at in np.ndindex(g.shape):
                up, down = [a.copy() for a in w], [a.copy() for a in w]
                up[k][at] += 1e-6
                down[k][at] -= 1e-6
                g[at] = (cost(up, train, s.decay) - cost(down, train, s.decay)) / 2e-6
            m[k], v[k] = 0.9 * m[k] + 0.1 * g, 0.999 * v[k] + 0.001 * g * g
            new.append(w[k] - s.rate * (m[k] / (1 - 0.9**t)) / (np.sqrt(v[k] / (1 - 0.999**t)) + 1e-8))
        w = new
    return w, costs


@pytest.mark.parametrize("with_graph", [True, False])
def test_network(spark, tmp_path, with_graph):
    rng, n = np.random.default_rng(1), 12
    a = np.triu(rng.random((n, n)) < 0.3, 1)
    nodes = spark.createDataFrame([(str(i),) for i in range(n)], "id string")
    e = spark.createDataFrame([(str(i), str(j)) for i, j in np.argwhere(a).tolist()], "src string, dst string")
    matrix = features.adjacency_normalised(nodes, e)
    full = a + a.T + np.eye(n)
    d = full.sum(1)
    spread = full / np.sqrt(np.outer(d, d)) if with_graph else np.eye(n)
    x, y, train = rng.normal(size=(n, 3)), rng.integers(0, 3, n), np.arange(n) < 8
    y[:3] = [0, 1, 2]
    rows = spark.createDataFrame([(str(i), x[i].tolist(), int(y[i]), "train" if train[i] else "valid") for i in range(n)], "id string, x array<double>, label int, split string")
    s = networks.Settings(hidden=4, epochs=3, rate=0.05)
    got = networks.Network(s).fit(rows, matrix if with_graph else None)
    w, costs = dense_network(s, spread, x, y, train, 3)
    assert np.allclose(got.costs, costs, atol=1e-5) and all(np.allclose(p, q, atol=1e-4) for p, q in zip(got.weights, w, strict=True))
    got.save(spark, str(tmp_path / "model"))
    p = {r["id"]: r["probability"] for r in networks.Network.load(spark, str(tmp_path / "model")).predict(rows, matrix if with_graph else None).collect()}
    z = np.exp(spread @ np.maximum(spread @ x @ w[0], 0) @ w[1])
    assert np.allclose([p[str(i)] for i in range(n)], z / z.sum(1, keepdims=True), atol=1e-4)


@pytest.mark.parametrize("drop", [0.0, 0.4])
def test_network_with_several_supports(spark, drop):
    """Chebyshev's polynomials as supports, entries of both layers' inputs dropped: equal to a dense network with gradients
    by finite differences."""
    rng, n, width = np.random.default_rng(2), 9, 2
    a = np.triu(rng.random((n, n)) < 0.4, 1)
    nodes = spark.createDataFrame([(str(i),) for i in range(n)], "id string")
    e = spark.createDataFrame([(str(i), str(j)) for i, j in np.argwhere(a).tolist()], "src string, dst string")
    laplacian = features.rescaled_laplacian(nodes, e)
    square = np.zeros((n, n))
    for r in laplacian.collect():
        square[int(r["i"]), int(r["j"])] = r["value"]
    supports = [np.eye(n), square, 2 * square @ square - np.eye(n)]
    x, y, train = rng.normal(size=(n, width)), rng.integers(0, 3, n), np.arange(n) < 6
    y[:3] = [0, 1, 2]
    rows = spark.createDataFrame([(str(i), x[i].tolist(), int(y[i]), "train" if train[i] else "valid") for i in range(n)], "id string, x array<double>, label int, split string")
    s = networks.Settings(hidden=3, epochs=2, rate=0.05, drop=drop, seed=4, activation="tanh")
    matrix = networks.several(*features.chebyshev_matrices(laplacian))
    got = networks.Network(s).fit(rows, matrix)

    def factors(size, layer, epoch):
        ones = spark.createDataFrame([(str(i), [1.0] * size) for i in range(n)], "id string, x array<double>")
        m = {r["id"]: r["x"] for r in networks.dropped(ones, "x", drop, 4, layer, epoch).collect()}
        return np.array([m[str(i)] for i in range(n)])

    start = np.random.default_rng(4)
    w = [start.uniform(-1, 1, z) * np.sqrt(6 / sum(z)) for z in ((3 * width, 3), (9, 3))]
    side = lambda h: np.concatenate([t @ h for t in supports], 1)

    def cost(w, at, masks, decay=0.0):
        z = side(np.tanh(side(x * masks[0]) @ w[0]) * masks[1]) @ w[1]
        logp = z - np.log(np.exp(z).sum(1, keepdims=True))
        return -logp[np.arange(n), y][at].mean() + decay / 2 * (w[0] ** 2).sum()

    m, v, costs, none = [0, 0], [0, 0], [], [np.ones((n, width)), np.ones((n, 3))]
    for t in (1, 2):
        masks = [factors(width, 0, t), factors(3, 1, t)]
        costs.append((cost(w, train, masks), cost(w, ~train, none)))
        new = []
        for k in range(2):
            g = np.zeros_like(w[k])
            for at in np.ndindex(g.shape):
                up, down = [u.copy() for u in w], [u.copy() for u in w]
                up[k][at] += 1e-6
                down[k][at] -= 1e-6
                g[at] = (cost(up, train, masks, s.decay) - cost(down, train, masks, s.decay)) / 2e-6
            m[k], v[k] = 0.9 * m[k] + 0.1 * g, 0.999 * v[k] + 0.001 * g * g
            new.append(w[k] - s.rate * (m[k] / (1 - 0.9**t)) / (np.sqrt(v[k] / (1 - 0.999**t)) + 1e-8))
        w = new
    assert (drop == 0) == bool((masks[0] == 1).all())
    assert np.allclose(got.costs, costs, atol=1e-5) and all(np.allclose(p, q, atol=1e-4) for p, q in zip(got.weights, w, strict=True))
    z = np.exp(side(np.tanh(side(x) @ w[0])) @ w[1])
    p = {r["id"]: r["probability"] for r in got.predict(rows, matrix).collect()}
    assert np.allclose([p[str(i)] for i in range(n)], z / z.sum(1, keepdims=True), atol=1e-4)


def test_network_ends_early(spark):
    rows = spark.createDataFrame([(str(i), [float(i % 2), 1.0], i % 2, "train") for i in range(6)] + [(str(i), [float(i % 2), 1.0], 1 - i % 2, "valid") for i in range(6, 10)], "id string, x array<double>, label int, split string")
    got = networks.Network(networks.Settings(hidden=3, epochs=30, rate=0.3, patience=2, activation="tanh")).fit(rows)
    assert 3 <= len(got.costs) < 30 and got.costs[-1][0] < got.costs[0][0]
