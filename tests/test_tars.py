"""Archives in parts."""

import io
import tarfile

import pytest
from pyspark.sql import functions as F

from paperlake.operators import archives
from paperlake.sources import tars

BIG = bytes(range(256)) * 9000


def packed(files, form=tarfile.PAX_FORMAT):
    out = io.BytesIO()
    with tarfile.open(fileobj=out, mode="w", format=form) as t:
        for name, data in files:
            info = tarfile.TarInfo(name)
            if data is None:
                info.type = tarfile.DIRTYPE
            info.size = len(data or b"")
            t.addfile(info, io.BytesIO(data or b""))
    return out.getvalue()


INNER = packed([("inner.pdf", b"an archive within")])
FILES = [("1501", None), *[(f"1501/{i:05}.pdf", f"text {i}".encode() * (i % 7)) for i in range(300)], ("é" * 150 + ".pdf", b"long name"), ("1501/inner.tar", INNER), ("1501/big.pdf", BIG), ("1501/00007.pdf", b"again")]


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    at = tmp_path_factory.mktemp("tars")
    (at / "a b.tar").write_bytes(packed(FILES))
    (at / "gnu.tar").write_bytes(packed(FILES[:40] + FILES[301:302], tarfile.GNU_FORMAT))
    (at / "none.tar").write_bytes(packed([]))
    (at / "cut.tar").write_bytes(packed(FILES)[: 512 * 100 + 10])
    (at / "empty.tar").write_bytes(b"")
    (at / "wrong.tar").write_bytes(b"not a tar" * 500)
    return at


def found(rows):
    return sorted((r["tar"], r["member"], bytes(r["content"])) for r in rows if r["member"] is not None)


@pytest.mark.parametrize("at_once", [64 << 20, 20_000, 1])
def test_members_by_ranges(spark, folder, at_once):
    """However small the ranges are, members are those of the whole archive; archives within archives are files."""
    index = tars.members(spark, f"file://{folder}")
    df = tars.contents(index, at_once=at_once)
    rows = df.collect()
    cut = []
    with tarfile.open(folder / "cut.tar") as t:
        try:
            for m in t:
                data = t.extractfile(m).read() if m.isfile() else None
                if data is not None:
                    cut.append(("cut.tar", m.name, data))
        except tarfile.ReadError:
            pass
    want = [("a b.tar", n, d) for n, d in FILES if d is not None] + [("gnu.tar", n, d) for n, d in FILES[:40] + FILES[301:302] if d is not None] + cut
    names = {r["tar"].replace("%20", " ") for r in rows}
    assert found([{**r.asDict(), "tar": r["tar"].replace("%20", " ")} for r in rows]) == sorted(want)
    assert {r["tar"] for r in rows if r["error"]} == {"cut.tar", "wrong.tar"} and not names & {"none.tar", "empty.tar"}
    assert df.rdd.getNumPartitions() >= (300 if at_once == 1 else 1)


def test_only_what_is_wanted_is_read(spark, folder):
    index = tars.members(spark, f"file://{folder}/gnu.tar")
    wanted = spark.createDataFrame([("gnu.tar", ["1501/00003.pdf", "1501/00038.pdf", "no.pdf"]), ("other.tar", ["x"])], "tar string, pdfs array<string>")
    got = tars.contents(index, wanted, at_once=1)
    assert found(got.collect()) == [("gnu.tar", n, d) for n, d in FILES[4:5] + FILES[39:40]]
    assert tars.contents(index, wanted.where("tar = 'other.tar'")).collect() == []


def test_round_trip(spark, tmp_path):
    rows = [("x.tar", f"m{i}", bytearray(b"z" * i)) for i in range(50)] + [("y.tar", "n", None), (None, "lost", bytearray(b"1")), ("y.tar", None, bytearray(b"1"))]
    files = spark.createDataFrame(rows, "tar string, member string, content binary").withColumn("error", F.lit(1))
    made = tars.write(files, f"file://{tmp_path}/t").collect()
    assert {(r["tar"], r["members"]) for r in made} == {("x.tar", 50), ("y.tar", 1)} and sorted(p.name for p in (tmp_path / "t").iterdir() if not p.name.endswith(".crc")) == ["x.tar", "y.tar"]
    got = found(tars.contents(tars.members(spark, f"file://{tmp_path}/t"), at_once=3000).collect())
    assert got == sorted([("x.tar", f"m{i}", b"z" * i) for i in range(50)] + [("y.tar", "n", b"")])


def test_jobs_over_parts_go_on(spark, folder, tmp_path):
    """The first run does what its index has, the second the rest; failures are rows."""
    def text(content):
        return content.decode("ascii")

    index, out = tars.members(spark, f"file://{folder}/gnu.tar"), str(tmp_path / "out")
    first = archives.process_parts(index.where("member < '1501/00020.pdf'"), out, [text], at_once=3000, most=1e9)
    again = archives.process_parts(index, out, [text], at_once=3000, most=1e9)
    files = [d for _, d in FILES[:40] + FILES[301:302] if d is not None]
    assert (first, first + again, archives.process_parts(index, out, [text])) == (20, len(files), 0)
    got = spark.read.parquet(out).collect()
    assert sorted(r["text"] for r in got if r["text"] is not None) == sorted(d.decode() for d in files if d)


def test_many_ranges_share_a_task(spark, folder, monkeypatch):
    """Beyond a number of ranges a task reads several, one after the other, and neighbours as one; the members are the same."""
    index, deal = tars.members(spark, f"file://{folder}/gnu.tar"), tars.dealt
    one = found(tars.contents(index, at_once=1).collect())
    monkeypatch.setattr(tars, "dealt", lambda ranges: deal(ranges, 5, 1 << 30))
    df = tars.contents(index, at_once=1)
    assert found(df.collect()) == one and len(one) > 20 and df.rdd.getNumPartitions() <= 6
    a = [["x", 0, 10], ["x", 10, 20], ["x", 30, 40], ["y", 0, 10], ["y", 10, 20]]
    assert deal(a, 5) == [[r] for r in a]
    assert deal(a, 1) == [[["x", 0, 20], ["x", 30, 40], ["y", 0, 20]]]
    assert deal(a, 1, 20) == [[["x", 0, 20]], [["x", 30, 40], ["y", 0, 10]], [["y", 10, 20]]]
    assert deal([]) == []
