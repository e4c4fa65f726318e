"""Encoders that workers load."""

import os
import uuid

import numpy as np
from pyspark.sql import functions as F

from paperlake.operators import extraction


def test_loaded_once_a_worker(spark, tmp_path):
    """Over several tasks and two jobs a process loads the model once; order, values and batches are as they should be."""
    at = str(tmp_path)

    def load():
        (open(f"{at}/{os.getpid()}-{uuid.uuid4().hex}", "w")).close()

        def encode(texts):
            assert len(texts) == 1 or max(map(len, texts)) * len(texts) <= 500
            return np.array([[len(t), sum(map(ord, t))] for t in texts], np.float32)

        return encode

    rows = spark.range(400).select(F.col("id").cast("string").alias("id"), F.when(F.col("id") % 11 != 0, F.repeat(F.lit("aé"), ((F.col("id") * 37) % 300).cast("int"))).alias("text")).repartition(8).cache()
    order = [(r["id"], r["text"] or "") for r in rows.collect()]
    for _ in range(2):
        got = [(r["id"], r["embedding"]) for r in extraction.embed_loaded(rows, "m1", load, most=500).collect()]
        assert got == [(i, [float(len(t)), float(sum(map(ord, t)))]) for i, t in order]
    pids = [n.split("-")[0] for n in os.listdir(at)]
    assert pids and len(pids) == len(set(pids))
    extraction.embed_loaded(rows, "m2", load, most=500).collect()
    assert len(os.listdir(at)) > len(pids)
    rows.unpersist()


def test_batches_by_length():
    texts = ["", "a" * 9, "b" * 3, "c" * 100, "d" * 3, "e" * 4]
    assert [[texts[i] for i in b] for b in extraction.by_length(texts, 9)] == [["", "b" * 3, "d" * 3], ["e" * 4], ["a" * 9], ["c" * 100]]
    assert list(extraction.by_length([], 9)) == []
