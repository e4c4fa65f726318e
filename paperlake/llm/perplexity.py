"""Quality by perplexity: an interpolated modified Kneser-Ney n-gram model over words, trained on trusted text."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import finish, lean, save, small_enough
from .hashing import U, WordHashes, mix

#: Bytes of text that are counted at once.
BUFFER = 4 << 20
#: Words of an n-gram, and what stands before and after a text's words.
WORDS, START, END = 3, 1, 2
#: Letters of scripts that put no space between words are words of their own.
LETTER = re.compile("([\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003ffff])")


def pieces(texts: list[str | None], size: int) -> Iterator[list[bytes]]:
    held, n = [], 0
    for t in texts:
        b = (t or "").encode("utf-8", "surrogatepass")
        if held and n + len(b) > size:
            yield held
            held, n = [], 0
        held.append(b)
        n += len(b)
    if held:
        yield held


class Table:
    """Numbers by key: open addressing with linear probing, looked up many at a time."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        size = 1 << max(4, int(np.ceil(np.log2(2 * len(keys) + 1))))
        self.mask = size - 1
        self.keys, self.values = np.full(size, -1, np.int64), np.zeros(size, np.float32)
        left, at = np.arange(len(keys)), self.slot(keys)
        while len(left):
            free = self.keys[at] == -1
            _, first = np.unique(at[free], return_index=True)
            put = np.flatnonzero(free)[first]
            self.keys[at[put]] = keys[left[put]]
            self.values[at[put]] = values[left[put]]
            rest = np.ones(len(left), bool)
            rest[put] = False
            left, at = left[rest], (at[rest] + 1) & self.mask

    def slot(self, keys: np.ndarray) -> np.ndarray:
        return (mix(keys.view(U)) & U(self.mask)).astype(np.int64)

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        """0 for keys that are not there."""
        at = self.slot(keys)
        wrong = np.flatnonzero((self.keys[at] != keys) & (self.keys[at] != -1))
        while len(wrong):
            at[wrong] = (at[wrong] + 1) & self.mask
            wrong = wrong[(self.keys[at[wrong]] != keys[wrong]) & (self.keys[at[wrong]] != -1)]
        return self.values[at]


def word_grams(texts: list[str | None], words: WordHashes) -> tuple[np.ndarray, np.ndarray]:
    """The hashed words that end at each word of each text and at its end, WORDS to a row, and the texts' rows; a text
    without words has none."""
    parts, sizes = [], []
    for t in texts:
        w = words(LETTER.sub(r" \1 ", t) if t else t).view(np.int64)
        if len(w):
            parts.append(np.lib.stride_tricks.sliding_window_view(np.concatenate([[START] * (WORDS - 1), w, [END]]), WORDS))
        sizes.append(len(w) + 1 if len(w) else 0)
    return np.concatenate(parts) if parts else np.zeros((0, WORDS), np.int64), np.array(sizes, np.int64)


def word_keys(g: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each row of words."""
    h = np.full(len(g), g.shape[1], U)
    for j in range(g.shape[1]):
        h = mix(mix(h) + np.ascontiguousarray(g[:, j]).view(U))
    return h


def word_model(docs: DataFrame) -> tuple[DataFrame, float]:
    """key, f, and the log probability of a word that was not trained. docs: text, trained.

    The log probability of a text is that number for each of its words, and f of all its n-grams of one to three words
    that are in the model: what an n-gram adds to backing off, and the weight of backing off from it where it is a
    context. Counts are combined within a task and then summed, and joined, in shards by n-gram.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordHashes()
        for batch in batches:
            for part in pieces(batch.column(0).to_pylist(), BUFFER):
                g = word_grams([t.decode("utf-8", "surrogatepass") for t in part], words)[0]
                _, at, n = np.unique(word_keys(g), return_index=True, return_counts=True)
                yield pa.RecordBatch.from_arrays([*[pa.array(g[at, j]) for j in range(WORDS)], pa.array(n, pa.int64())], names=["u", "v", "w", "n"])

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            g = np.stack([c.to_numpy() for c in batch.columns[:-1]], 1)
            yield pa.RecordBatch.from_arrays([pa.array(word_keys(g).view(np.int64)), batch.columns[-1]], names=["key", "f"])

    rows = docs.where("trained").select("text").mapInArrow(lean(run), "u bigint, v bigint, w bigint, n bigint")
    used = [save(rows.groupBy("u", "v", "w").agg(F.sum("n").alias("c")), "kn-counts")]
    used.append(save(used[0].groupBy("v", "w").agg(F.count("*").alias("c")), "kn-counts"))
    used.append(save(used[1].groupBy("w").agg(F.count("*").alias("c")), "kn-counts"))

    def less(c: DataFrame) -> DataFrame:
        """With what the discount leaves of c, and the discount."""
        n1, n2, n3, n4 = (x or 0 for x in c.agg(*[F.sum((F.col("c") == i).cast("long")) for i in range(1, 5)]).first())
        y = n1 / (n1 + 2 * n2) if n1 and n2 else 0.5
        cut = [max(0.01, min(i, i - (i + 1) * y * b / a)) if a and b else y for i, a, b in ((1, n1, n2), (2, n2, n3), (3, n3, n4))]
        cut = F.when(F.col("c") == 1, cut[0]).when(F.col("c") == 2, cut[1]).otherwise(cut[2])
        return c.withColumn("cut", cut).withColumn("less", F.col("c") - F.col("cut"))

    def contexts(c: DataFrame, *by: str) -> DataFrame:
        back = F.sum("cut") / F.sum("c")
        return c.groupBy(*by).agg(F.sum("c").alias("total"), back.alias("back"), F.log(back).alias("logb"))

    c3, c2, c1 = map(less, used)
    n, total, held = c1.agg(F.count("*"), F.sum("c"), F.sum("cut")).first()
    unknown = (held / total if n else 1.0) / (n + 1)
    b1, b2 = save(contexts(c2, "v"), "kn-contexts"), save(contexts(c3, "u", "v"), "kn-contexts")
    p1 = save(c1.select("w", (F.col("less") / F.lit(float(total or 1)) + F.lit(unknown)).alias("p1")), "kn-p")
    p2 = c2.join(small_enough(b1), "v").join(small_enough(p1), "w")
    p2 = p2.select("v", "w", (F.col("less") / F.col("total") + F.col("back") * F.col("p1")).alias("p2"), (F.col("logb") + F.log("p1")).alias("low"))
    p2 = save(p2, "kn-p")
    f3 = c3.join(b2, ["u", "v"]).select("u", "v", "w", (F.col("less") / F.col("total")).alias("own"), "back").join(p2.select("v", "w", "p2"), ["v", "w"])
    f3 = f3.select("u", "v", "w", F.log1p(F.col("own") / (F.col("back") * F.col("p2"))).cast("float").alias("f"))
    f2 = p2.select("v", "w", (F.log("p2") - F.col("low")).alias("f")).unionByName(b2.select(F.col("u").alias("v"), F.col("v").alias("w"), F.col("logb").alias("f")))
    f1 = p1.select("w", (F.log("p1") - F.lit(float(np.log(unknown)))).alias("f")).unionByName(b1.select(F.col("v").alias("w"), F.col("logb").alias("f")))
    f2, f1 = (f.groupBy(*f.columns[:-1]).agg(F.sum("f").cast("float").alias("f")) for f in (f2, f1))
    out = [f.mapInArrow(lean(keyed), "key bigint, f float") for f in (f3, f2, f1)]
    out = save(out[0].unionByName(out[1]).unionByName(out[2]), "kn-f")
    finish(*used, b1, b2, p1, p2)
    return out, float(np.log(unknown))


def word_entries(texts: list[bytes], words: WordHashes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """text (its place), key, k (occurrences): the n-grams of one to WORDS words of every text; and the texts' words."""
    g, sizes = word_grams([t.decode("utf-8", "surrogatepass") for t in texts], words)
    own = np.repeat(np.arange(len(texts)), sizes)
    some = np.flatnonzero(sizes)
    at, keys = [own] * WORDS, [word_keys(g[:, j:]) for j in range(WORDS)]
    # the contexts of the first word end in no word
    for j in range(1, WORDS):
        at.append(some)
        keys.append(np.repeat(word_keys(np.full((1, j), START, np.int64)), len(some)))
    at, keys = np.concatenate(at), np.concatenate(keys)
    order = np.lexsort((keys, at))
    at, keys = at[order], keys[order]
    first = np.flatnonzero(np.concatenate([[True], (at[1:] != at[:-1]) | (keys[1:] != keys[:-1])])) if len(at) else np.zeros(0, np.int64)
    return at[first], keys[first], np.diff(np.append(first, len(at))), sizes


def word_score(docs: DataFrame, logs: DataFrame, unknown: float) -> DataFrame:
    """text_hash, mean (of the log probability of the text's words and its end): the distinct texts that have words.

    N-grams of the texts travel to the model's shards packed, six bytes and a count each (with the two bytes that choose
    the shard, a key is whole), and sums return.
    """
    docs = docs.select(F.xxhash64("text").alias("text_hash"), "text")
    shards = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    kind = "shard int, kind int, texts binary, sizes binary, keys binary, data binary"

    def short(keys: np.ndarray) -> bytes:
        return np.ascontiguousarray(keys.view(np.uint8).reshape(-1, 8)[:, :6]).tobytes()

    def long(keys: bytes) -> np.ndarray:
        out = np.zeros((len(keys) // 6, 8), np.uint8)
        out[:, :6] = np.frombuffer(keys, np.uint8).reshape(-1, 6)
        return out.reshape(-1).view(np.int64)

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int32(), pa.int32(), *[pa.binary()] * 4), strict=True)], names=["shard", "kind", "texts", "sizes", "keys", "data"])

    def dealt(keys: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        to = ((keys >> U(48)) % U(shards)).astype(np.int64)
        order = np.argsort(to, kind="stable")
        for own in np.split(order, np.flatnonzero(np.diff(to[order])) + 1):
            if len(own):
                yield int(to[own[0]]), own

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, f = batch.column(0).to_numpy().view(U), batch.column(1).to_numpy()
            rows = [(s, 0, b"", b"", short(keys[own]), f[own].tobytes()) for s, own in dealt(keys)]
            if rows:
                yield batch_of(rows)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordHashes()
        for batch in batches:
            at = 0
            for part in pieces(batch.column(1).to_pylist(), BUFFER):
                names = batch.column(0).slice(at, len(part)).to_numpy()
                at += len(part)
                text, keys, k, sizes = word_entries(part, words)
                rows = [(int(names[0]) % shards, 1, names.tobytes(), sizes.tobytes(), b"", b"")]
                for s, own in dealt(keys):
                    seen, first = np.unique(text[own], return_index=True)
                    rows.append((s, 2, names[seen].tobytes(), np.diff(np.append(first, len(own))).tobytes(), short(keys[own]), k[own].astype(np.int32).tobytes()))
                yield batch_of(rows)

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, held, table = None, [], None
        for batch in batches:
            for at in range(batch.num_rows):
                s, what, texts, sizes, keys, data = (c[at].as_py() for c in batch.columns)
                if s != shard:
                    shard, held, table = s, [], None
                if what == 0:
                    held.append((long(keys), np.frombuffer(data, np.float32)))
                    continue
                names, sizes = np.frombuffer(texts, np.int64), np.frombuffer(sizes, np.int64)
                sums = np.zeros(len(names))
                if what == 2 and held:
                    table = Table(*map(np.concatenate, zip(*held, strict=True)))
                    held = []
                if what == 2 and table:
                    sums = np.add.reduceat(table(long(keys)) * np.frombuffer(data, np.int32).astype(np.float64), np.cumsum(sizes) - sizes)
                words = sizes if what == 1 else np.zeros(len(names), np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(names), pa.array(sums), pa.array(words)], names=["text_hash", "f", "n"])

    rows = logs.select("key", "f").mapInArrow(lean(pack), kind).unionByName(docs.mapInArrow(lean(cut), kind))
    sums = rows.repartition(shards, "shard").sortWithinPartitions("shard", "kind").mapInArrow(lean(look_up), "text_hash bigint, f double, n bigint")
    # equal texts have one mean
    return sums.groupBy("text_hash").agg(F.sum("f").alias("f"), F.sum("n").alias("n")).where("n > 0").select("text_hash", (F.col("f") / F.col("n") + F.lit(unknown)).alias("mean"))


def quality(docs: DataFrame, labels: DataFrame, quantile: float = 0.99, key: str = "doc_id") -> DataFrame:
    """Perplexity of every whole text, a word and the text's end, and whether it is kept.

    Trusted are documents labelled quality 1; the model is trained on those whose crc32(id) mod 5 is not 0. A language's
    threshold is the given quantile of the perplexity of its other trusted documents (if it has none, of all
    languages'; if there are none at all, everything is kept). N-grams of WORDS hashed words are counted in shards by
    n-gram after a map-side combine, and grow with the input; counts, contexts and texts meet by joins at every size.

    Returns doc_id, lang, n_bytes, perplexity, threshold, kept. Null and empty texts, and those without any word:
    perplexity null, not kept. Null languages have a threshold of their own. Rows that repeat an id are scored row by row;
    one labelled twice is trusted if one label says so. Ties with the threshold are kept. Empty table: no rows. Other
    columns are not read.
    """
    trusted = labels.where((F.col("quality") == 1) & F.col(key).isNotNull()).select(F.col(key).cast("long").alias("row"), F.lit(True).alias("trusted")).distinct()
    held = F.crc32(F.coalesce(F.col("row").cast("string"), F.lit(""))) % 5 == 0
    rows = docs.select(F.col(key).cast("long").alias("row"), F.col("lang").cast("string").alias("lang"), "text").join(small_enough(save(trusted, "trusted")), "row", "left")
    rows = rows.select("row", "lang", F.coalesce("trusted", F.lit(False)).alias("trusted"), held.alias("held"), "text").withColumn("trained", F.expr("trusted AND NOT held"))
    model, unknown = word_model(rows)
    slim = rows.select("row", "lang", "trusted", "held", F.xxhash64("text").alias("text_hash"), F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"))
    scored = slim.join(word_score(rows, model, unknown), "text_hash", "left").select("row", "lang", "trusted", "held", "n_bytes", F.exp(-F.col("mean")).alias("perplexity"))
    scored = save(scored.withColumn("lkey", F.coalesce(F.concat(F.lit("s"), F.col("lang")), F.lit("n"))), "perplexities")
    finish(model)
    cuts = save(thresholds(scored.where("trusted AND held AND perplexity IS NOT NULL"), quantile), "cuts")
    every = cuts.where("lkey = ''").select(F.col("threshold").alias("every"))
    out = scored.join(small_enough(cuts), "lkey", "left").crossJoin(F.broadcast(every)).withColumn("threshold", F.coalesce("threshold", "every", F.lit(float("inf"))))
    return out.select(F.col("row").alias("doc_id"), "lang", "n_bytes", "perplexity", "threshold", F.coalesce(F.col("perplexity") <= F.col("threshold"), F.lit(False)).alias("kept"))


def thresholds(good: DataFrame, quantile: float) -> DataFrame:
    """lkey, threshold: the quantile of each language's perplexities, and, by the empty lkey, of all (null of none). good:
    lkey, perplexity."""
    cut = F.percentile_approx("perplexity", quantile, 10_000).alias("threshold")
    return good.groupBy("lkey").agg(cut).unionByName(good.agg(cut).select(F.lit("").alias("lkey"), "threshold"))
