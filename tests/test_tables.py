"""Tables that are replaced as a whole."""

import pytest
from pyspark.sql import functions as F

from paperlake.sources import tables


def rows(spark, path):
    return sorted((r["id"], r["refs"]) for r in tables.read(spark, path).collect())


def frame(spark, n, tag):
    return spark.range(n).select(F.col("id").cast("string").alias("id"), F.array(F.lit(tag), F.lit(None).cast("string")).alias("refs")).repartition(3)


def test_a_failed_job_leaves_the_table(spark, tmp_path):
    path = f"file://{tmp_path}/t"
    tables.write(frame(spark, 20, "old"), path)
    want = sorted((str(i), ["old", None]) for i in range(20))
    assert rows(spark, path) == want
    before = {p.name for p in (tmp_path / "t").iterdir()}

    def dies(batches):
        for b in batches:
            yield b
            if "7" in b.column(0).to_pylist():
                raise RuntimeError("lost")

    bad = frame(spark, 20, "new")
    with pytest.raises(Exception, match="lost"):
        tables.write(bad.mapInArrow(dies, bad.schema), path)
    assert rows(spark, path) == want and before <= {p.name for p in (tmp_path / "t").iterdir()}
    with pytest.raises(Exception, match="lost"):
        tables.write(bad.mapInArrow(dies, bad.schema), path, append=True)
    assert rows(spark, path) == want and before <= {p.name for p in (tmp_path / "t").iterdir()}


def test_a_killed_worker_is_tried_again_or_aborts(spark, tmp_path):
    """The process of a task ends without a word."""
    path = f"file://{tmp_path}/t"
    tables.write(frame(spark, 5, "old"), path)

    def killed(batches):
        import os

        for b in batches:
            yield b
        os._exit(9)

    bad = frame(spark, 5, "new")
    with pytest.raises(Exception):
        tables.write(bad.mapInArrow(killed, bad.schema), path)
    assert rows(spark, path) == sorted((str(i), ["old", None]) for i in range(5))


def test_replace_append_and_leftovers(spark, tmp_path):
    path = f"file://{tmp_path}/t"
    tables.write(frame(spark, 4, "a"), path)
    tables.write(frame(spark, 2, "b"), path, append=True)
    assert rows(spark, path) == sorted([(str(i), ["a", None]) for i in range(4)] + [(str(i), ["b", None]) for i in range(2)])
    (tmp_path / "t" / "left-by-a-lost-driver.parquet").write_bytes(b"half")
    tables.write(frame(spark, 3, "c"), path)
    assert rows(spark, path) == [(str(i), ["c", None]) for i in range(3)]
    names = {p.name for p in (tmp_path / "t").iterdir() if not p.name.startswith(".")}
    assert "_current.json" in names and len(names) <= 4 and "left-by-a-lost-driver.parquet" not in names
    tables.write(frame(spark, 0, "d"), path)
    assert rows(spark, path) == [] and tables.read(spark, path).columns == ["id", "refs"]


def test_no_table(spark, tmp_path):
    with pytest.raises(Exception, match="no table"):
        tables.read(spark, f"file://{tmp_path}/none").collect()
