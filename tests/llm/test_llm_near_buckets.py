"""Near duplicates: what is compared where it stands, and components of few edges."""

import random

import numpy as np
import pytest
from test_llm_operators import components, test_jaccard_loses_no_link_within_a_passage as passage


from paperlake.llm import jaccard
from paperlake.operators import shared


@pytest.mark.parametrize("few", [0, 250_000])
def test_connected_with_and_without_rounds(spark, monkeypatch, few):
    rng = random.Random(5)
    pairs = [(rng.randrange(400), rng.randrange(400)) for _ in range(200)] + [(i, i + 1) for i in range(1000, 1100)] + [(None, 3), (7, 7)]
    whole = [p for p in pairs if p[0] is not None]
    want = {i: c for i, c in components(range(1101), whole).items() if any(i in p and p[0] != p[1] for p in whole)}
    written, save = [], shared.save
    monkeypatch.setattr(shared, "save", lambda df, name: written.append(name) or save(df, name))
    rows = shared.connected(spark.createDataFrame(pairs, "src long, dst long"), few=few).collect()
    assert {r["node"]: r["component"] for r in rows} == want and len(rows) == len(want)
    assert (len(written) == 1) == (few > 0)


def test_bucket_of_some_hundreds_is_compared_where_it_stands(spark, monkeypatch):
    rng = np.random.default_rng(3)
    s = rng.integers(0, 256, (600, jaccard.SKETCH)).astype(np.uint8)
    for i in range(1, 300):
        s[i, : jaccard.NEAR + 8] = s[i % 7, : jaccard.NEAR + 8]
    near = np.array([(x == s).sum(1) >= jaccard.NEAR for x in s])
    want = {i: c for i, c in components(range(600), list(zip(*np.nonzero(near), strict=True))).items() if near[i].sum() > 1}
    sets = spark.createDataFrame([(i, bytearray(s[i].tobytes()), [77]) for i in range(600)], "rid long, sketch binary, nodes array<long>")
    edges, used = jaccard.candidates(sets, None, 0.8, 5)
    assert {r["node"]: r["component"] for r in shared.connected(edges).collect()} == want
    assert not any("heads" in t.saved_at for t in used)


def test_deeper_levels_lose_no_link_within_a_passage(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "SMALL", 64)
    passage(spark)
