"""Patterns as Spark runs them against the plain ones, and how often a step of theirs is worked out."""

import random
import re

from pyspark.sql import functions as F

from paperlake.functions import ids


def test_trees_match_like_lists():
    rng = random.Random(1)
    for names in (ids.ARCHIVES, ids.CLASSES):
        a, b = re.compile(ids._any(names)), re.compile(ids._tree(names))
        for _ in range(20_000):
            w = rng.choice(names).replace("-", rng.choice(["", "-"]))
            w = w[: rng.randint(0, len(w))] + rng.choice(["", "-", "ph", "-ph", "th", "."]) + rng.choice(["", *names])
            x, y = a.match(w), b.match(w)
            assert (x and x.group()) == (y and y.group()), w


def test_identifiers_found(spark):
    """Every pattern on odd lines: what Python finds with the plain pattern."""
    rng = random.Random(2)
    some = ["arXiv:", "e-print ", "http://arxiv.org/abs/", "hep-th/", "hepth/", "mathph/", "math.AG/", "math/", "condmat.str-el/", "9901123", "0703045v2", "1203.0023", "1203.00231V3", "[", "(", ")", "] ", " ", "abs/", "Eprint: ", "q-alg", "x", "$1", "é", "HEP-TH "]
    lines = ["".join(rng.choices(some, k=rng.randint(1, 9))) for _ in range(1500)]
    rows = spark.createDataFrame(list(enumerate(lines)), "i int, t string").repartition(4)
    for pattern in ids.PATTERNS.values():
        got = dict(map(tuple, rows.select("i", ids.found(F.col("t"), pattern)).collect()))
        for i, line in enumerate(lines):
            want = [next(filter(None, m.groups())) for m in re.finditer(pattern, line)]
            assert got[i] == want, line


def test_a_name_is_cleaned_once():
    """Steps of clean() aren't nested in one another, where each would be worked out anew wherever it is named."""
    text = str(ids.references(F.col("t"), ids.PATTERNS["strict"]))
    assert text.count("[vV][1-9]") - text.count("(?:[vV][1-9]") == 1
