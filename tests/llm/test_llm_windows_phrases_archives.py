"""Collocations, web archives and rolling medians against brute force, and on hand-made edge cases."""

import base64
import collections
import datetime
import hashlib
import math
import random
import re
import statistics

import duckdb
import numpy as np
import pytest
from conftest import SF
from pyspark.sql import functions as F

from paperlake.llm import phrases, queries, rolling, warc

TABLES = "documents pages clicks".split()


@pytest.mark.parametrize("name", ["op11_collocations", "op12_warc", "op13_rolling"])
def test_query_against_sql(spark, name):
    db = duckdb.connect()
    for t in TABLES:
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    df = queries.QUERIES[name](spark, SF)
    cur = db.execute(queries.ORACLES[name])
    names = [d[0] for d in cur.description]
    assert sorted(names) == sorted(df.columns)
    want = sorted((tuple(r[names.index(c)] for c in df.columns) for r in cur.fetchall()), key=repr)
    assert sorted((tuple(r) for r in df.collect()), key=repr) == want


# --- 11 collocations -------------------------------------------------------------------------------------------------


def plain_collocations(rows, least, longest, cover, top):
    f, n = collections.Counter(), collections.Counter()
    for text, lang in rows:
        lang = lang or "und"
        text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", text):
            w = re.findall("[^ \t]+", piece)
            n[lang] += len(w)
            f.update((lang, *w[i : i + k]) for k in range(1, longest + 1) for i in range(len(w) - k + 1))
    f = {p: c for p, c in f.items() if c >= least}
    out = []
    for (lang, *w), a in f.items():
        if len(w) < 2:
            continue
        score, k = min((10**6 * a * a // (f[(lang, *w[:k])] * f[(lang, *w[k:])]), k) for k in range(1, len(w)))
        longer = [c for (other, *v), c in f.items() if other == lang and len(v) > len(w) and any(v[i : i + len(w)] == w for i in range(len(v)))]
        if not any(100 * c >= cover * a for c in longer):
            out.append((lang, " ".join(w), a, f[(lang, *w[:k])], f[(lang, *w[k:])], n[lang], score))
    got = []
    for lang in n:
        best = sorted((r for r in out if r[0] == lang), key=lambda r: (-r[6], -r[2], r[1].encode()))[:top]
        got += [(r[0], i + 1, *r[1:]) for i, r in enumerate(best)]
    return sorted(got)


def random_rows(seed):
    rng = random.Random(seed)
    words = ["a", "B", "été", "aa", "x\x01", "ÄÖ", "\U0001f600", "q" * 700, "-"]
    gaps = [" ", "  ", "\t", ". ", ",\n", "\r\n", " ! ", "\x0b"]
    return [("".join(rng.choice(words) + rng.choices(gaps, [30, 3, 3, 2, 1, 1, 1, 1])[0] for _ in range(rng.randrange(40))), rng.choice(["en", "de", None, "und"])) for _ in range(80)]


@pytest.mark.parametrize("longest, top, cover", [(3, 2000, 50), (4, 5, 80)])
def test_collocations_against_counting(spark, monkeypatch, longest, top, cover):
    """Small blocks, rows and automata give what large ones do; a null language is the language `und`."""
    rows = random_rows(longest) + [(None, "en"), ("", None), ("!?.", "fr"), ("one two " * 30, "es"), ("one two " * 30, "es")]
    df = spark.createDataFrame(rows, "text string, lang string").withColumn("words", F.lit(1)).withColumn("f", F.lit("n")).repartition(3)
    got = phrases.collocations(df, 4, longest, cover, top).collect()
    assert sorted(tuple(r) for r in got) == plain_collocations(rows, 4, longest, cover, top)


def test_collocations_in_parts():
    """A sketch of few cells marks more than is frequent and nothing less; texts are cut between pieces only."""
    import pyarrow as pa

    rng = random.Random(2)
    text = phrases.pieces(" ".join(rng.choice("abcdefgh") + rng.choice(["", "", ",", "\n"]) for _ in range(5000)).encode())
    was = phrases.ROW
    phrases.ROW = 100
    try:
        cut = list(phrases.segments(text))
    finally:
        phrases.ROW = was
    assert b" \n ".join(cut) == text and max(map(len, cut)) <= 100
    packed = pa.Codec("zstd").compress(text, asbytes=True)
    row = pa.RecordBatch.from_arrays([pa.array([7]), pa.array(["en"]), pa.array([1]), pa.array([len(text)]), pa.array([packed], pa.binary())], names=["block", "lang", "n", "size", "text"])
    marks = []
    for t in phrases.sketch(3, 2)(iter([row])):
        for i in range(t.num_rows):
            marks.append(phrases.heavy(10)(pa.Table.from_batches([t.slice(i, 1)])))
    got = phrases.summing(1)(phrases.counting(3, 2, 1)(pa.Table.from_batches([row]), pa.concat_tables(marks)))
    words = [p.split() for p in text.decode().split("\n")]
    want = collections.Counter(" ".join(w[i : i + k]).encode() for w in words for k in (1, 2, 3) for i in range(len(w) - k + 1))
    got = dict(zip(got.column("phrase").to_pylist(), got.column("f").to_pylist(), strict=True))
    assert all(want[p] == c for p, c in got.items())
    assert {p for p, c in want.items() if c >= 10} <= set(got)


def test_long_words_that_polynomials_confuse():
    """Thue and Morse's words have equal polynomials modulo 2**64; they are told apart all the same."""
    one, other = b"a", b"b"
    for _ in range(11):
        one, other = one + other, other + one
    (h, _), *_ = phrases.Grams(1)("en", one + b" " + other + b" " + one)[2]
    assert h[0] != h[1] and h[0] == h[2]


def test_collocations_of_nothing(spark):
    assert phrases.collocations(spark.createDataFrame([], "text string, lang string")).collect() == []
    assert phrases.collocations(spark.createDataFrame([(None, None), ("a", "en")], "text string, lang string")).collect() == []


# --- 12 archives -----------------------------------------------------------------------------------------------------

INNER = (
    "x\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:x-page:77>\r\nContent-Type: application/http\r\nContent-Length: 20\r\n\r\n"
    "HTTP/1.1 200 OK\r\n\r\nA\r\n\r\nWARC/1.0\r\nContent-Length: 999999\r\n\r\nWARC/1.1\r\n\r\nWARC/1."
)
PAGES = [
    (1, "u1", "hello"), (2, "u2", "hello"), (3, "u3", None), (4, None, ""), (None, "u5", "hello"), (6, "u\r\n6", INNER), (6, "u\r\n6", INNER), (7, "é", "WARC/1.1\r\n"),
    (8, "u8", "é" * 5000 + "WARC/1.1\r\nContent-Length: 5\r\n\r\n" + "z" * 3000), (2, "u2", "hello"), (1, "u1", "hello"), (9, "u9", INNER * 5), (None, None, "none"), (None, None, "none"),
]


def sha1(data):
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


@pytest.fixture(scope="module")
def archives(spark, tmp_path_factory):
    path = f"file://{tmp_path_factory.mktemp('warc')}/w"
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string").withColumn("digest", F.lit("clash")).withColumn("key", F.lit(1))
    warc.write(pages.repartition(3), path, date="2024-01-01T00:00:00Z")
    return path


@pytest.mark.parametrize("split", ["128m", "4k", "60"])
def test_records_come_back(spark, archives, split):
    """Whatever the byte ranges are, magic and whole records inside payloads are no records."""
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        got = warc.records(spark, archives).collect()
        slim = warc.records(spark, archives, payload=False).drop("payload").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    bodies = [(a, (c or "").encode()) for a, _, c in PAGES]
    want = sorted((f"urn:x-page:{'' if a is None else a}", sha1(b), len(b)) for a, b in bodies)
    for rows in (got, slim):
        assert sorted((r["record_id"], r["payload_digest"], r["payload_bytes"]) for r in rows) == want
    assert all(r["intact"] for r in got)
    assert sorted(bytes(r["payload"]) for r in got if r["kind"] == "response") == sorted({b for _, b in bodies})
    first = {}
    for a, b in sorted(bodies, key=lambda x: (x[0] is None, x[0] or 0)):
        first.setdefault(b, a)
    for r in got:
        assert (r["kind"] == "revisit") == (r["refers_to"] is not None)
    assert {(r["payload_digest"], r["refers_to"]) for r in got if r["kind"] == "revisit"} == {(sha1(b), f"urn:x-page:{'' if first[b] is None else first[b]}") for b, c in collections.Counter(b for _, b in bodies).items() if c > 1}


def test_small_payloads_are_no_revisits(spark, tmp_path):
    pages = spark.createDataFrame([(i, "u", t) for i, t in enumerate(["", "", "long enough", "long enough", "ab", "ab"])], "page_id long, url string, html string")
    warc.write(pages, f"file://{tmp_path}/w", least=5)
    got = {warc_id.removeprefix("urn:x-page:"): kind for warc_id, kind in ((r["record_id"], r["kind"]) for r in warc.records(spark, f"file://{tmp_path}/w").collect())}
    assert got == {"0": "response", "1": "response", "2": "response", "3": "revisit", "4": "response", "5": "response"}


def test_archives_of_others(spark, tmp_path):
    """Other versions, fields in other cases and orders, blocks that are no HTTP answers; damage is found."""
    a = b"WARC/1.0\r\nContent-Length: 4\r\nWARC-Type: resource\r\nwarc-record-id: <urn:x>\r\n\r\n\xff\x00\r\n\r\n\r\n"
    b = b"WARC/1.1\r\nwarc-type: warcinfo\r\ncontent-length: 0\r\nContent-Type: application/warc-fields\r\n\r\n\r\n\r\n"
    c = b"WARC/1.1\r\nWARC-Type: response\r\nContent-Type: application/http; msgtype=response\r\nWARC-Payload-Digest: sha1:WRONG\r\nContent-Length: 23\r\n\r\nHTTP/1.0 200 OK\r\n\r\nbody\r\n\r\n"
    (tmp_path / "a.warc").write_bytes(b + a + c)
    got = sorted(warc.records(spark, f"file://{tmp_path}/a.warc").collect(), key=lambda r: r["kind"])
    assert [(r["kind"], r["record_id"], bytes(r["payload"]), r["intact"]) for r in got] == [("resource", "urn:x", b"\xff\x00\r\n", True), ("response", None, b"body", False), ("warcinfo", None, b"", True)]
    for bad in (b + a + c[:-9], b + a[:-1] + c, b"junk" + b, a.replace(b"4", b"9")):
        (tmp_path / "b.warc").write_bytes(bad)
        with pytest.raises(ValueError, match="b.warc"):
            warc.records(spark, f"file://{tmp_path}/b.warc").collect()


def test_archives_of_nothing(spark, tmp_path):
    warc.write(spark.createDataFrame([], "page_id long, url string, html string"), f"file://{tmp_path}/w")
    assert warc.records(spark, f"file://{tmp_path}/w").collect() == []


# --- 13 rolling medians ----------------------------------------------------------------------------------------------


def plain_windows(rows, minutes):
    """rows: key, series, us, cents, each key once."""
    out = {}
    for key, series, us, cents in rows:
        w = [c for _, s, u, c in rows if s == series and us - minutes * 60_000_000 < u <= us and c is not None]
        m = d = far = None
        if len(w) > 1:
            m = int(2 * statistics.median(w)) if len(w) % 2 else sum(sorted(w)[len(w) // 2 - 1 : len(w) // 2 + 1])
            gaps = sorted(abs(2 * c - m) for c in w)
            d = gaps[(len(w) - 1) // 2] + gaps[len(w) // 2]
            far = None if cents is None else 2 * abs(2 * cents - m) > 3 * d
        out[key] = (series, len(w), m, d, far)
    return out


START = datetime.datetime(2024, 3, 10, 1, 30)  # a clock is put forward in some zones an hour later


def events(seed, n=400):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        ts = START + datetime.timedelta(microseconds=rng.choice([rng.randrange(6 * 3600 * 10**6), 60 * 60 * 10**6 * rng.randrange(6), 3600 * 10**6 + 1]))
        out.append((i, ts, rng.choice(["a", "a", "a", "b", None]), rng.choice([None, rng.randrange(5) / 4, rng.gauss(0, 100), -0.005, 1e9])))
    return out


@pytest.mark.parametrize("seed, chunk, zone", [(1, 1 << 18, "UTC"), (2, 20, "America/New_York"), (3, 1, "Asia/Kolkata")])
def test_rolling_against_plain(spark, seed, chunk, zone):
    """Chunks of any size, ties in time, clocks that are put forward, repeated, null and broken rows."""
    rows = events(seed)
    more = [(1000, None, "a", 1.0), (1001, START, "b", math.nan), (1002, START, "b", math.inf), (1003, START, "b", 1e300), (None, START, "a", 3.0)]
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.createDataFrame(rows + rows[:50] + more, "k long, t timestamp_ntz, s string, v double").withColumn("id", F.lit("x")).withColumn("us", F.lit(0)).repartition(3)
        got = rolling.rolling(df, "k", "s", "t", "v", 60, chunk).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    cents = lambda v: math.floor(100 * v + 0.5) if v is not None and abs(v) < 1e15 else None
    plain = [(k, s, (t - datetime.datetime(1970, 1, 1)) // datetime.timedelta(microseconds=1), cents(v)) for k, t, s, v in rows + more if t]
    assert {r["k"]: (r["s"], r["n"], r["median2"], r["mad4"], r["far"]) for r in got} == plain_windows(plain, 60)
    assert len(got) == len(plain)


def test_one_key_with_different_rows(spark):
    """The first by time stays, nulls last."""
    rows = [(1, None, "a", 5.0), (1, START, "b", 2.0), (1, START, "a", 3.0), (2, START, "a", 4.0)]
    got = {r["k"]: tuple(r) for r in rolling.rolling(spark.createDataFrame(rows, "k long, t timestamp_ntz, s string, v double"), "k", "s", "t", "v").collect()}
    assert got == {1: (1, "a", 2, 700, 200, False), 2: (2, "a", 2, 700, 200, False)}
    assert rolling.rolling(spark.createDataFrame([], "k long, t timestamp_ntz, s string, v double"), "k", "s", "t", "v").collect() == []


def test_wavelet_matrix():
    rng = np.random.default_rng(4)
    x = rng.integers(0, 37, 300)
    matrix = rolling.WaveletMatrix(x, 6)
    a = rng.integers(0, 299, 200).astype(np.int32)
    e = (a + rng.integers(1, 300 - a)).astype(np.int32)
    k = rng.integers(0, e - a)
    assert matrix.quantile(a, e, k).tolist() == [sorted(x[i:j])[n] for i, j, n in zip(a, e, k, strict=True)]
    y = rng.integers(0, 65, 200)
    assert matrix.below(a, e, y).tolist() == [int((x[i:j] < v).sum()) for i, j, v in zip(a, e, y, strict=True)]
