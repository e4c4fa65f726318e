"""The command line, command by command, on small folders."""

import gzip
import io
import json
import tarfile

import pytest

from paperlake import __main__ as command
from paperlake.operators import extraction


def page(ids):
    rows = "".join(f'<record><metadata><arXivRaw><id>{i}</id><authors>A. Bee, C. Dee</authors><version version="v1"><date>d</date></version></arXivRaw></metadata></record>' for i in ids)
    return f"<OAI-PMH><ListRecords>{rows}</ListRecords></OAI-PMH>"


def test_metadata_then_authors(spark, tmp_path):
    (tmp_path / "pages").mkdir()
    for n, ids in enumerate((["1501.00001", "b"], ["b", "c"])):
        (tmp_path / "pages" / f"{n}.xml").write_text(page(ids))
    command.main(["metadata", str(tmp_path / "pages"), str(tmp_path / "m")])
    assert sorted(r["id"] for r in spark.read.parquet(str(tmp_path / "m")).collect()) == ["1501.00001", "b", "c"]
    (tmp_path / "m.json").write_text("\n".join(json.dumps({"id": i, "authors": a}) for i, a in (("x", "A. Bee, C. Dee"), ("y", None))))
    command.main(["authorsplit", str(tmp_path / "m.json"), str(tmp_path / "a")])
    got = {r["id"]: r["authors"] for r in spark.read.parquet(str(tmp_path / "a")).collect()}
    assert [a["keyname"] for a in got["x"]] == ["Bee", "Dee"] and not got["y"]


def test_texts_then_citations_then_graph(spark, tmp_path):
    tree = tmp_path / "tree" / "arxiv" / "1501"
    tree.mkdir(parents=True)
    for i, text in enumerate(("see 1501.00002", "see 1501.00001 and 1501.00003v2", "nothing")):
        (tree / f"1501.0000{i + 1}.txt").write_text(text)
    command.main(["fulltext", str(tmp_path / "tree"), str(tmp_path / "t")])
    command.main(["citations", str(tmp_path / "t"), str(tmp_path / "c")])
    refs = {r["id"]: sorted(r["refs"]) for r in spark.read.parquet(str(tmp_path / "c")).collect()}
    assert refs == {"1501.00001": ["1501.00002"], "1501.00002": ["1501.00001", "1501.00003"], "1501.00003": []}
    command.main(["graph", str(tmp_path / "c"), str(tmp_path / "g")])
    row = spark.read.json(str(tmp_path / "g")).first()
    assert (row["nodes"], row["edges"], row["largest_share"]) == (3, 3, 1.0)


def test_archives(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(extraction, "pdf_tools", lambda: [lambda content: content.decode("ascii")])
    out = io.BytesIO()
    with tarfile.open(fileobj=out, mode="w") as t:
        for name, data in (("1501/1501.00001.pdf", b"one word"), ("1501/1501.00002.pdf", b"\xff")):
            info = tarfile.TarInfo(name)
            info.size = len(data)
            t.addfile(info, io.BytesIO(data))
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.tar").write_bytes(out.getvalue())
    for _ in range(2):
        command.main(["archives", str(tmp_path / "in"), str(tmp_path / "out")])
        got = {r["id"]: (r["text"], r["error"] is None) for r in spark.read.parquet(str(tmp_path / "out")).collect()}
        assert got == {"1501.00001": ("one word", True), "1501.00002": (None, False)}


def test_download(spark, tmp_path, monkeypatch):
    """Files that can't be fetched are told, all of them."""
    (tmp_path / "to").mkdir()
    entries = "".join(f"<file><filename>f{i}.tar</filename><md5sum>x</md5sum><first_item>a</first_item><last_item>b</last_item></file>" for i in range(3))
    with gzip.open(tmp_path / "to" / "manifest.xml.gz", "wb") as f:
        f.write(f"<all>{entries}</all>".encode())
    command.main(["pdfdownload", "http://127.0.0.1:1/m.xml", str(tmp_path / "to")])
    assert sorted(r["filename"] for r in spark.read.json(str(tmp_path / "to" / "failed")).collect()) == ["f0.tar", "f1.tar", "f2.tar"]


def test_unknown(spark):
    with pytest.raises(SystemExit):
        command.main(["nothing", "a", "b"])
