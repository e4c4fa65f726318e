"""What of a batch of texts goes to Python, and what comes back."""

import unicodedata

from pyspark.sql import functions as F

from paperlake.functions import text


def test_plain_texts_stay_out_of_python(spark, monkeypatch):
    sent = []
    monkeypatch.setattr(text, "compose", lambda c: sent.append(c) or c)
    text.fix_unicode(F.col("t"))
    rows = spark.createDataFrame([("plain",), ("é",), (None,)], "t string")
    assert [r[0] for r in rows.select(sent[0]).collect()] == [None, "é", None]


def test_batches_longer_than_a_slice(spark):
    texts = [None if i % 7 == 0 else f"{i} é ﬁ" if i % 3 else f"{i} plain" for i in range(350)]
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, t string").coalesce(1)
    got = [r[0] for r in rows.orderBy("i").select(text.compose(F.col("t"))).collect()]
    assert got == [t and unicodedata.normalize("NFKC", t) for t in texts]
