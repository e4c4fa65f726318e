"""Archives are dealt out by size, and what leaves an extractor is what came in."""

import os

from paperlake.operators import archives, extraction, shared


def test_archives_are_dealt_out_by_size(spark):
    rows = [(f"t{i}", f"1501.{k:05d}.txt", bytearray(os.urandom(1 << 20))) for i in range(20) for k in range(i * 2, i * 2 + 2)]
    packed = shared.save(archives.packed(spark.createDataFrame(rows, "tar string, member string, content binary")).coalesce(1), "archives")
    out = archives.contents(packed)
    assert out.rdd.getNumPartitions() >= 10
    assert {(r["tar"], r["member"], bytes(r["content"]), r["error"]) for r in out.collect()} == {(t, m, bytes(c), None) for t, m, c in rows}


def test_extract_keeps_rows_that_fail_or_are_empty(spark):
    files = [("a", bytearray(b"some text")), (None, bytearray(b"no id")), ("b", None), ("c", bytearray(b"\xff")), ("d", bytearray(b"x " * 3_000_000)), ("e", bytearray(b"more"))]
    out = extraction.extract(spark.createDataFrame(files, "id string, content binary").coalesce(1), [lambda b: b.decode("utf-8")], most=1e9).collect()
    assert [(r["id"], r["text"] and len(r["text"])) for r in out] == [("a", 9), (None, 5), ("b", None), ("c", None), ("d", 6_000_000), ("e", 4)]
    assert [r["error"] is None for r in out] == [True, True, False, False, True, True]
