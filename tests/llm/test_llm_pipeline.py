"""The pipeline against a plain version of its stages, and on edge cases."""


import collections
import hashlib
import struct

import corpus_pipeline
import public_tokenizers
import pytest
import tiktoken
from conftest import SF
from test_llm_operators import EDGES, RANKS, SCHEMA, brute_jaccard, removed

from paperlake.llm import bpe, common, mixing, queries


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    toxic, near, cut, mix, encode = (f for _, f in corpus_pipeline.STAGES)
    a = toxic(spark, docs, SF)
    marks = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    left = {r["doc_id"]: r["text"] for r in a.collect()}
    clean = [d for d, t in marks.items() if not t]
    assert a.columns == docs.columns and sum(d in left for d in clean) >= 0.97 * len(clean)
    b = near(spark, a, SF)
    roots, _ = brute_jaccard(left)
    assert {r["doc_id"] for r in b.collect()} == {d for d, c in roots.items() if c == d}
    rows = b.collect()
    cut_docs = common.save(cut(spark, b, SF), "cut")
    c = {r["doc_id"]: r for r in cut_docs.collect()}
    for r, (n, gone, _, _) in zip(rows, removed([r["text"].encode() for r in rows], 200), strict=True):
        assert n - gone - 3 * 20 <= len(c[r["doc_id"]]["text"].encode()) <= n - gone and c[r["doc_id"]]["n_chars"] == len(c[r["doc_id"]]["text"])
    # as often as the mix says, and ids as the public library gives them
    mixed = common.save(mix(spark, cut_docs, SF), "mixed")
    taken = collections.Counter(tuple(r) for r in mixed.collect())
    times = {r["doc_id"]: r["repeats"] for r in mixing.mix(cut_docs).collect()}
    assert taken == collections.Counter({tuple(r): times[d] for d, r in c.items() if times[d]})
    encoder = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.ranks(RANKS), special_tokens={})
    made = collections.Counter((r["doc_id"], r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in encode(spark, mixed, SF).collect())
    want = {}
    for d, r in c.items():
        ids = encoder.encode_ordinary(r["text"])
        want[d, len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(), hashlib.sha256(r["text"].encode()).hexdigest()] = times[d]
    assert made == collections.Counter({k: n for k, n in want.items() if n})
    assert queries.QUERIES["pipeline"](spark, SF).count() == sum(times.values())


def test_toxic_documents_go(spark):
    """Of the toxic documents on which nothing was learnt most go, and hardly a clean one."""
    sf = SF.replace("sf0.001", "sf0.1")
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    left = {r["doc_id"] for r in corpus_pipeline.drop_toxic(spark, docs, sf).select("doc_id").collect()}
    held = docs.join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("crc32(cast(doc_id AS string)) % 5 = 0").collect()
    toxic, clean = ([r["doc_id"] in left for r in held if r["toxic"] == k] for k in (1, 0))
    assert len(toxic) > 3 and sum(toxic) <= 0.4 * len(toxic) and sum(clean) >= 0.97 * len(clean)


@pytest.mark.parametrize("rows", [EDGES, []])
def test_edges(spark, rows):
    docs = spark.createDataFrame(rows, SCHEMA)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == docs.columns
            docs = spark.createDataFrame(out.collect(), out.schema)
    assert out.count() == docs.count() and (bool(rows) == bool(docs.count()))


def test_names():
    assert [q.split("_")[0] for q in queries.QUERIES if q.startswith("op")] == [f"op{i}" for i in range(1, 11)]
