"""Sources and the harvest stream, on local files."""

import json

from paperlake.operators.metadata import records
from paperlake.sources import corpora, harvest
from paperlake.streaming.ingest import into_table


def page(ids, token):
    rows = "".join(f'<record><metadata><arXivRaw><id>{i}</id><version version="v1"><date>d</date></version></arXivRaw></metadata></record>' for i in ids)
    return f"<OAI-PMH><ListRecords>{rows}<resumptionToken>{token}</resumptionToken></ListRecords></OAI-PMH>"


def test_batch_and_stream(spark, tmp_path):
    pages = tmp_path / "pages"
    pages.mkdir()
    for n, ids in enumerate((["1501.00001", "b"], ["c", "b"], ["1501.00001", "hep-th/9901001"])):
        (pages / f"p{n}.xml").write_text(page(ids, "x"))
    harvest.register(spark, "paged", harvest.folder(str(pages)))
    assert [r["page"] for r in spark.read.format("paged").load().orderBy("page").collect()] == [0, 1, 2]
    assert sorted(r["id"] for r in records(spark.read.format("paged").load()).collect()) == ["1501.00001", "1501.00001", "b", "b", "c", "hep-th/9901001"]
    out, check = str(tmp_path / "out"), str(tmp_path / "check")
    for _ in range(5):  # each run takes one page; the last finds none
        into_table(spark.readStream.format("paged").load(), out, check, {"availableNow": True}).awaitTermination(120)
    assert sorted(r["id"] for r in spark.read.parquet(out).collect()) == ["1501.00001", "b", "c", "hep-th/9901001"]


def test_requests():
    assert harvest.request("http://x", None) == "http://x?verb=ListRecords&metadataPrefix=arXivRaw"
    assert harvest.request("http://x", "t|1") == "http://x?verb=ListRecords&resumptionToken=t%7C1"
    waits, calls = [], []

    def fetch(token):
        calls.append(token)
        if len(calls) < 3:
            raise RuntimeError("busy")
        return "x", None

    assert harvest.polite(fetch, waits.append, lambda e: 20)("t") == ("x", None)
    assert waits == [30, 30] and calls == ["t"] * 3


def test_files(spark, tmp_path):
    (tmp_path / "m.json").write_text("\n".join(json.dumps({"id": str(i), "categories": ["a b"]}) for i in range(3)))
    m = corpora.metadata(spark, str(tmp_path / "m.json"))
    assert m.count() == 3 and len(m.columns) == 12
    tree = tmp_path / "t" / "hep-ph" / "0001"
    tree.mkdir(parents=True)
    (tree / "hep-ph0001001.txt").write_text("one\ntwo")
    (tree / "other.pdf").write_text("no")
    texts = corpora.fulltext(spark, str(tmp_path / "t"))
    assert [tuple(r) for r in texts.collect()] == [("hep-ph/0001001", "one\ntwo")]
    corpora.write_fulltext(texts, str(tmp_path / "w"))
    assert spark.read.parquet(str(tmp_path / "w")).columns == ["id", "text", "yymm"]
    assert corpora.newest(spark, str(tmp_path / "m*.json")).endswith("m.json") and corpora.newest(spark, str(tmp_path / "none*")) is None
    assert corpora.Settings.resolve("/x").at("y") == "/x/y"
