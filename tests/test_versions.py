"""Streams with state and of growing folders against one batch over everything."""

import glob
import random
import time

from paperlake.operators import citations
from paperlake.operators.metadata import latest, records
from paperlake.sources import harvest
from paperlake.streaming import versions


def page(rows, token="x"):
    out = "".join(f'<record><metadata><arXivRaw><id>{i}</id><title>{t}</title>{"".join(f"""<version version="v{k}"><date>d{k}</date></version>""" for k in range(1, v + 1))}</arXivRaw></metadata></record>' for i, v, t in rows)
    return f"<OAI-PMH><ListRecords>{out}<resumptionToken>{token}</resumptionToken></ListRecords></OAI-PMH>"


def plain(df):
    return sorted((r["id"], r["title"], tuple(r["versions"]), tuple(r["versions_dates"])) for r in df.collect())


def pages_of(rng, n):
    ids = ["1501.00001", "hep-th/9901001", "b", "é"]
    return [page([(rng.choice(ids), rng.randrange(0, 4), rng.choice("pqé")) for _ in range(5)]) for _ in range(n)]


def test_versions_out_of_order(spark, tmp_path):
    """Pages out of order and replayed, a query that is started anew after each, and lost progress of the last batch."""
    at, out, check = tmp_path / "pages", str(tmp_path / "out"), str(tmp_path / "check")
    at.mkdir()
    source = lambda: spark.readStream.option("wholetext", "true").option("maxFilesPerTrigger", 1).schema("xml STRING").text(str(at))
    everything = pages_of(random.Random(3), 4)
    for n, text in enumerate([*everything, everything[0], everything[2]]):
        (at / f"{n}.xml").write_text(text)
        if n in (1, 5):
            versions.keep_versions(source(), out, check).awaitTermination(200)
        if n == 1:
            # a batch whose commit was lost runs again
            last = max((tmp_path / "check" / "commits").glob("[0-9]*"), key=lambda p: int(p.name))
            last.unlink()
            (last.parent / f".{last.name}.crc").unlink(missing_ok=True)
    want = latest(records(spark.createDataFrame([(x,) for x in everything], "xml string")), "id", "versions")
    assert plain(versions.articles(spark, out)) == plain(want)
    rows = spark.read.parquet(out)
    assert rows.count() == rows.select("id", "title", "versions").distinct().count()  # nothing twice


def test_expired_articles_come_again(spark, tmp_path):
    """Forgotten some seconds after its last change, an article is passed on again."""
    at, out = tmp_path / "pages", str(tmp_path / "out")
    at.mkdir()
    (at / "0.xml").write_text(page([("1501.00001", 1, "t"), ("", 1, "t")]))
    stream = spark.readStream.option("wholetext", "true").schema("xml STRING").text(str(at))
    query = versions.keep_versions(stream, out, str(tmp_path / "check"), expire_after=2000, trigger={"processingTime": "1 second"})

    def written(n):
        for _ in range(120):
            time.sleep(0.5)
            if glob.glob(f"{out}/_spark_metadata/*") and spark.read.schema("id string, yymm string").parquet(out).where("id = '1501.00001'").count() == n:
                return True
        return False

    try:
        assert written(1)
        time.sleep(3)
        (at / "1.xml").write_text(page([("1501.00001", 1, "t")]))
        assert written(2)
    finally:
        query.stop()


def test_harvest_into_state(spark, tmp_path):
    """The paged source as input."""
    at = tmp_path / "pages"
    at.mkdir()
    for n in range(3):
        (at / f"p{n}.xml").write_text(page([("a", n, "t")]))
    harvest.register(spark, "versioned", harvest.folder(str(at)))
    for _ in range(4):
        versions.keep_versions(spark.readStream.format("versioned").load(), str(tmp_path / "out"), str(tmp_path / "check")).awaitTermination(200)
    assert plain(versions.articles(spark, str(tmp_path / "out"))) == [("a", "t", ("v1", "v2"), ("d1", "d2"))]


def test_citations_of_a_growing_tree(spark, tmp_path):
    """Two runs with files added between equal one batch; a file that isn't text has an error; a third run adds nothing."""
    tree, out, check = tmp_path / "tree", str(tmp_path / "out"), str(tmp_path / "check")
    made = {"arxiv/1501/1501.00001.txt": b"see hep-th/9901001 and 1203.4567v2", "hep-th/9901/hep-th9901001.txt": b"", "arxiv/1501/1501.00002.txt": b"\xff\xfe"}
    more = {"arxiv/1502/1502.00003.txt": "é arXiv:1501.00001".encode(), "arxiv/1502/notes.pdf": b"1501.00001"}
    for files in (made, more, {}):
        for name, data in files.items():
            (tree / name).parent.mkdir(parents=True, exist_ok=True)
            (tree / name).write_bytes(data)
        versions.cited(spark, f"file://{tree}", out, check, files_at_once=2).awaitTermination(200)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*txt*").option("recursiveFileLookup", "true").load(str(tree))
    rows = lambda df: sorted((r["id"], sorted(r["refs"] or []), r["error"]) for r in df.collect())
    assert rows(spark.read.parquet(out)) == rows(citations.extract_files(files)) and len(rows(spark.read.parquet(out))) == 3  # nothing of no bytes
