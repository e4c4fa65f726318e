"""Identifiers, TeX, author lines and text: values worked out by hand."""

import re

import pytest
from pyspark.sql import functions as F

from paperlake.functions import authors, ids, tex, text

# Citations as they stand in papers, and what is to be found in them.
CITED = {
    "arXiv:quant-ph 1503.01017v3": ["1503.01017v3"],
    "math. RT/0903.2992": ["0903.2992"],
    "arXiv, 1511.03262": ["1511.03262"],
    "Math. Phys. 255, 577 (2005), hep-th/0306165": ["hep-th/0306165"],
    "Kuzovlev, arXiv:cond-mat/9903350 ": ["cond-mat/9903350"],
    "arXiv:math.RT/1206.5933,": ["1206.5933"],
    "arXiv e-prints 1306.1595": ["1306.1595"],
    "ays, JHEP 07 (2009) 055, [ 0903.0883]": ["0903.0883"],
    "available at: http://arxiv.org/abs/1511.08977": ["1511.08977"],
    "cond-mat/0309488.decays, 1701.01871 LHCB-PAPE": ["cond-mat/0309488", "1701.01871"],
    "doi: 10.1145/ 321105.321114 ": ["1105.32111"],
    "eprint 1503.01017, 1612.00001": ["1612.00001"],
    "cond-mat.mes-hall/9903350": [],
    "2001.01234": [],
    "": [],
}


def test_found(spark):
    rows = spark.createDataFrame([(k,) for k in CITED] + [(None,)], "t string")
    got = {r["t"]: r["f"] for r in rows.select("t", ids.found(F.col("t"), ids.PATTERNS["flexible"]).alias("f")).collect()}
    assert {k: got[k] for k in CITED} == CITED
    assert got[None] is None
    for t, want in CITED.items():
        assert ["".join(g) for g in re.findall(ids.PATTERNS["flexible"], t)] == want or len(want) == 0


def test_later_years():
    assert re.search(ids.patterns(25)["simple"], "2001.01234") and not re.search(ids.patterns(25)["simple"], "2601.01234")


CLEAN = {"1501.2198": "1501.02198", "1412.1234": "1412.1234", "9901.1234": "9901.01234", "math.RT/0612139v2": "math/0612139", "condmat/9903350": "cond-mat/9903350", "solv-int/9901001": "solv-int/9901001", "1501.21981v1": "1501.21981"}


def test_clean_is_idempotent(spark):
    rows = spark.createDataFrame([(k,) for k in CLEAN], "t string").select("t", ids.clean(F.col("t")).alias("c"))
    got = {r["t"]: (r["c"], r["d"]) for r in rows.select("t", "c", ids.clean(F.col("c")).alias("d")).collect()}
    assert got == {k: (v, v) for k, v in CLEAN.items()}


@pytest.mark.parametrize(("path", "name"), [("x/hep-ph0001001.txt", "hep-ph/0001001"), ("1501.13851.txt", "1501.13851"), ("math0612139v2.txt", "math/0612139")])
def test_path_to_id(spark, path, name):
    assert spark.range(1).select(ids.path_to_id(F.lit(path))).first()[0] == name


TEX = {r"\"{o}": "ö", r"\'e": "é", r"\c{c}": "ç", r"\v{s}": "š", r"S\o ren": "Søren", r"\L{}ukasz": "Łukasz", r"{\ss}": "ß", r"\upsilon": r"\upsilon", r"\c{x}": "cx", "{{x}}": "{x}", "plain": "plain", "": "", None: None}


MORE_TEX = {
    r"\alpha_1 \alpha1": r"α_1 \alpha1",
    r'G\"odel, \L\'od\'z': "Gödel, Łódź",
    r'\"{{o}}': "ö",
    r"{\'e}": "{é}",
    r"\'b": "b",
    r"\t{x} \j x": "x jx",
    r"Erd\H{o}s, P\'olya": "Erdős, Pólya",
    r"\AA\ ngstrom": "Å ngstrom",
    r"a } b { c \'e": "a } b { c é",
    r"\unknown{x} \'{ab}": r"\unknown{x} \'{ab}",
    "\\": "\\",
}


def test_tex_by_tokens():
    assert {k: tex.decode(k) for k in MORE_TEX} == MORE_TEX
    assert tex.decode(r"\o \'o", letters=False) == r"\o ó"


def test_tex(spark):
    assert {k: tex.decode(k) for k in TEX} == TEX
    assert len(tex.ACCENTED) == 185 and all(len(v) == 1 for v in tex.ACCENTED.values())
    rows = spark.createDataFrame([(k,) for k in TEX], "t string")
    assert {r["t"]: r["u"] for r in rows.select("t", tex.tex_to_utf("t").alias("u")).collect()} == TEX


# Author lines as they stand in records.
LINES = {
    "A. Losev, S. Shadrin, I. Shneiberg": "Losev, A.; Shadrin, S.; Shneiberg, I.",
    r"C. Bal\'azs, E. L. Berger, P. M. Nadolsky, C.-P. Yuan": "Balázs, C.; Berger, E. L.; Nadolsky, P. M.; Yuan, C. -P.",
    "Stephen C. Power (Lancaster University), Baruch Solel (Technion)": "Power, Stephen C.; Solel, Baruch",
    "Juan de la Cruz": "de la Cruz, Juan",
    "Plato": "Plato",
    "": "",
    None: "",
}


def test_author_lines(spark):
    rows = spark.createDataFrame([(k,) for k in LINES], "t string").select("t", authors.parse_authors("t").alias("p"))
    got = {r["t"]: (r["line"], r["e"]) for r in rows.select("t", authors.author_line(F.col("p.authors")).alias("line"), F.col("p.error").alias("e")).collect()}
    assert got == {k: (v, None) for k, v in LINES.items()}


def test_affiliations():
    line = "L. Scheck (1), H.-Th. Janka (1), T. Foglizzo (2), and K. Kifonidis (1)\n  ((1) MPI for Astrophysics, Garching; (2) Service d'Astrophysique, CEA-Saclay)"
    assert [a.affiliations[0][:7] for a in authors.parse(line)] == ["MPI for", "MPI for", "Service", "MPI for"]
    assert [a.affiliations for a in authors.parse("a. first, c. second (affil)")] == [["affil"], ["affil"]]
    group = authors.parse("ATLAS Collaboration: A. One, B. Two (X)")
    assert [(a.keyname, a.affiliations) for a in group] == [("ATLAS Collaboration", []), ("One", ["X"]), ("Two", ["X"])]
    assert [a.suffix for a in authors.parse("X. Y. Jr, Someone (1, 2)")] == ["Jr", ""]
    assert "".join(authors.split_line("A. B (x (y)), C")) == "A. B(x (y)),C"


TEXTS = {"ﬁn": "fin", "Æ": "AE", "x²": "x2", "“a” ‘b’": "\"a\" 'b'", "äß ß Straße ßß": "äss ß Strasse ßss", "\xad—·\xa0.": "--* .", "": "", None: None}


def test_fix_unicode(spark):
    rows = spark.createDataFrame([(k,) for k in TEXTS], "t string")
    assert {r["t"]: r["u"] for r in rows.select("t", text.fix_unicode(F.col("t")).alias("u")).collect()} == TEXTS


def test_text_measures(spark):
    row = spark.range(1).select(text.average_word_length(F.lit("ab cd")), text.average_word_length(F.lit("")), text.passes_gate(F.lit("")), text.remove_stamp(F.lit("arXiv:1203.0023v2 [math.RT] 29 Jan 2012 Title")), text.remove_stamp(F.lit("x" * 10 + "2102 naJ 92 ]TR.htam[ 2v3200.3021:viXra y"))).first()
    assert row[0] == pytest.approx(5 / 3) and row[1] == 0 and row[2] is True and row[3] == " Title" and row[4] == "xxxxxxxxxx y"
