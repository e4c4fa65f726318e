"""Every query of the catalogue against its twin in SQL."""

import math

import duckdb
import pytest
from conftest import SF

from paperlake.plans import catalogue

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else v
    return tuple(map(plain, v)) if isinstance(v, (list, tuple)) else v


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(set(catalogue.QUERIES) - {"ablation_metrics"}))
def test_query(spark, db, name):
    df = catalogue.QUERIES[name](spark, SF)
    order = sorted(df.columns)
    got = sorted((tuple(plain(r[c]) for c in order) for r in df.collect()), key=repr)
    if name not in catalogue.ORACLES:
        assert got
        return
    cur = db.execute(catalogue.ORACLES[name])
    names = [d[0] for d in cur.description]
    assert sorted(names) == order
    at = [names.index(c) for c in order]
    assert got == sorted((tuple(plain(r[i]) for i in at) for r in cur.fetchall()), key=repr)
