"""Toxicity: a convolutional text classifier over hashed word embeddings, trained in numpy."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import lean, save, settle, small_enough

WORD = re.compile(r"\w+")
#: Features of a word: itself, its first and its last four letters.
FEATURES = 3


@dataclass(frozen=True)
class Settings:
    buckets: int = 1 << 15
    dim: int = 12
    filters: int = 8
    widths: tuple[int, ...] = (1, 2, 3)
    epochs: int = 6
    batch: int = 64
    rate: float = 0.01
    seed: int = 0
    #: Bounds of the training sample: labelled documents of either class, those of smallest id hash, and bytes of their
    #: (whole) texts together.
    sample: int = 3000
    sample_bytes: int = 8 << 20
    #: Words that go through the convolution at once; a longer text goes in overlapping parts.
    window: int = 50_000


    @property
    def kind(self) -> type:
        """The numbers that buckets, and one more for padding, fit into."""
        return np.uint16 if self.buckets < 1 << 16 else np.uint32


@dataclass
class Model:
    settings: Settings
    emb: np.ndarray
    conv: list[np.ndarray] = field(default_factory=list)
    bias: np.ndarray = None
    out: np.ndarray = None
    out_bias: float = 0.0


def features(word: str, buckets: int) -> list[int]:
    return [zlib.crc32(x.encode("utf-8", "surrogatepass")) % buckets for x in (word, f"<{word[:4]}", f">{word[-4:]}")]


class Words:
    """Numbers words within a task; forgets them all when there are too many, so memory stays bounded."""

    def __init__(self, most: int = 150_000):
        self.most, self.seen = most, {}

    def __call__(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Flat word numbers and the number of words of each text."""
        seen = self.seen
        lists = [np.array([seen.setdefault(w, len(seen)) for w in WORD.findall((t or "").lower())], np.int32) for t in texts]
        return np.concatenate([np.zeros(0, np.int32), *lists]), np.array([len(x) for x in lists], np.int64)


def train(texts: list[np.ndarray], labels: np.ndarray, s: Settings) -> Model:
    """texts: arrays (words, FEATURES) of bucket numbers. Adam on the mean logistic loss; of each filter's activations
    over a text only the largest counts, and only there its gradient goes."""
    rng = np.random.default_rng(s.seed)
    shapes = [(s.buckets + 1, s.dim), *[(w, s.dim, s.filters) for w in s.widths], (len(s.widths) * s.filters,), (len(s.widths) * s.filters,), (1,)]
    p = [rng.normal(0, sd, shape).astype(np.float32) for shape, sd in zip(shapes, [0.3, *[0.3 / np.sqrt(w) for w in s.widths], 0, 0.3, 0], strict=True)]
    p[0][-1] = 0  # padding
    m, v, t = [np.zeros_like(x) for x in p], [np.zeros_like(x) for x in p], 0
    widest, k = max(s.widths), len(s.widths)
    pad = np.full((widest - 1, FEATURES), s.buckets, s.kind)
    for _ in range(s.epochs):
        order = rng.permutation(len(texts))
        for at in range(0, len(order), s.batch):
            own = order[at : at + s.batch]
            parts = [texts[i] if len(texts[i]) else pad[:1] for i in own]
            starts = np.cumsum([0, *[len(x) + widest - 1 for x in parts]])[:-1]
            f = np.concatenate([y for x in parts for y in (x, pad)])
            e = p[0][f].sum(1)
            pooled, where = [], []
            for c, w in enumerate(s.widths):
                z = sum(e[j : len(e) - widest + 1 + j] @ p[1 + c][j] for j in range(w))
                best = np.stack([a + z[a : a + len(x)].argmax(0) for a, x in zip(starts, parts, strict=True)])
                where.append(best)
                pooled.append(np.take_along_axis(z, best, 0))
            h = np.concatenate(pooled, 1) + p[k + 1]
            act = np.maximum(h, 0)
            prob = 1 / (1 + np.exp(-np.clip(act @ p[k + 2] + p[k + 3][0], -30, 30)))
            d = ((prob - labels[own]) / len(own)).astype(np.float32)
            g = [np.zeros_like(x) for x in p]
            g[k + 2], g[k + 3] = act.T @ d, np.array([d.sum()], np.float32)
            dh = np.outer(d, p[k + 2]) * (h > 0)
            g[k + 1] = dh.sum(0)
            for c, w in enumerate(s.widths):
                dz = dh[:, c * s.filters : (c + 1) * s.filters]
                for j in range(w):
                    at_word = where[c] + j
                    g[1 + c][j] = np.einsum("bfd,bf->df", e[at_word], dz)
                    de = np.einsum("bf,df->bfd", dz, p[1 + c][j])
                    np.add.at(g[0], f[at_word].reshape(-1), np.repeat(de.reshape(-1, s.dim), FEATURES, 0))
            g[0][-1] = 0
            t += 1
            for i in range(len(p)):
                m[i] += 0.1 * (g[i] - m[i])
                v[i] += 0.001 * (g[i] ** 2 - v[i])
                p[i] -= s.rate * (m[i] / (1 - 0.9**t)) / (np.sqrt(v[i] / (1 - 0.999**t)) + 1e-8)
    return Model(s, p[0], p[1 : 1 + k], p[k + 1], p[k + 2], float(p[k + 3][0]))


class Scorer:
    """Scores whole texts. Products of embeddings and filters are tabulated by bucket, so a word costs a few row sums."""

    def __init__(self, model: Model):
        s = self.s = model.settings
        self.model = model
        self.table = np.concatenate([model.emb @ c[j] for c in model.conv for j in range(len(c))], 1).astype(np.float32)
        self.words, self.known, self.rows = Words(), 0, np.zeros((1 << 12, self.table.shape[1]), np.float32)

    def _known(self) -> None:
        """Rows of words that are new, which are the last of those seen."""
        n = len(self.words.seen)
        if n > len(self.rows):
            more = np.zeros((n + n // 2 - len(self.rows), self.rows.shape[1]), np.float32)
            self.rows = np.concatenate([self.rows, more])
        new = list(islice(reversed(self.words.seen), n - self.known))[::-1]
        for a in range(0, len(new), 5000):
            f = np.array([features(w, self.s.buckets) for w in new[a : a + 5000]], np.int64)
            self.rows[self.known + a : self.known + a + len(f)] = self.table[f].sum(1)
        self.known = n

    def __call__(self, texts: list[str | None]) -> np.ndarray:
        s, model = self.s, self.model
        if len(self.words.seen) > self.words.most:
            self.words.seen.clear()
            self.known = 0
        flat, counts = self.words(texts)
        self._known()
        starts = np.cumsum(counts) - counts
        best = np.full((len(texts), len(s.widths) * s.filters), -np.inf, np.float32)
        spans = [(d, a, min(a + s.window, n)) for d, n in enumerate(counts.tolist()) for a in range(0, n, s.window)]
        i = 0
        while i < len(spans):
            j, size = i, 0
            while j < len(spans) and (j == i or size + spans[j][2] - spans[j][1] <= s.window):
                size += spans[j][2] - spans[j][1]
                j += 1
            self._pool(flat, starts, counts, spans[i:j], best)
            i = j
        h = np.where(np.isfinite(best), best + model.bias, 0)
        return 1 / (1 + np.exp(-np.clip(np.maximum(h, 0).astype(np.float64) @ model.out.astype(np.float64) + model.out_bias, -30, 30)))

    def _pool(self, flat, starts, counts, spans, best) -> None:
        s, extra = self.s, max(self.s.widths) - 1
        pad = np.zeros((extra, self.table.shape[1]), np.float32)
        parts, at, edges = [], 0, []
        for d, a, b in spans:
            own = self.rows[flat[starts[d] + a : starts[d] + min(b + extra, counts[d])]]
            parts += [own, pad]
            edges += [at, at + b - a]
            at += len(own) + extra
        x = np.concatenate(parts)
        docs, col = [d for d, _, _ in spans], 0
        for c, w in enumerate(s.widths):
            z = sum(x[j : len(x) - extra + j, (col + j) * s.filters : (col + j + 1) * s.filters] for j in range(w))
            col += w
            top = np.maximum.reduceat(z, np.minimum(edges, len(z) - 1), axis=0)[::2]
            np.maximum.at(best[:, c * s.filters : (c + 1) * s.filters], docs, top)


def fold(key: str = "doc_id"):
    """0: held out; 1: for thresholds, which come from a model that the others trained; 1 to 4: for training."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit(""))) % 5


def held_out(key: str = "doc_id"):
    return fold(key) == 0


def labelled(labels: DataFrame, label: str, key: str, folds: tuple[int, ...]) -> DataFrame:
    """doc_id, label of some folds; a document labelled twice is 1 if one label says so."""
    known = labels.where(F.col(key).isNotNull() & F.col(label).isin(0, 1)).groupBy(F.col(key).alias("doc_id")).agg(F.max(F.col(label).cast("int")).alias("label"))
    return known.where(fold().isin(*folds))


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", settings: Settings = Settings(), key: str = "doc_id", folds: tuple[int, ...] = (1, 2, 3, 4)) -> Model:
    """Trains on labelled documents of the given folds (see fold): of either class at most settings.sample of those
    whose id has the smallest hash, as far as settings.sample_bytes reach. What comes to the driver is bucket numbers of
    their words. Labels of one class or none: a model that says the same, under 0.5, to everything."""
    s = settings
    known = labelled(labels, label, key, folds)
    counts = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count("*").alias("n")).collect()}
    chosen = [known.where(F.col("label") == c).orderBy(F.xxhash64("doc_id"), "doc_id").limit(s.sample) for c in (0, 1)]
    rows = docs.select(F.col(key).alias("doc_id"), F.col("text")).join(F.broadcast(chosen[0].unionByName(chosen[1])), "doc_id")
    order = Window.partitionBy("label").orderBy(F.xxhash64("doc_id"), "doc_id", F.xxhash64("text"))
    rows = rows.withColumn("bytes", F.sum(F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")).over(order)).where(F.col("bytes") <= s.sample_bytes).select("doc_id", "text", "label").repartition(16)

    def bucket(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 500):
                b, words = whole.slice(at, 500), Words()
                flat, n = words(b.column(1).to_pylist())
                f = np.array([features(w, s.buckets) for w in words.seen], s.kind).reshape(-1, FEATURES)
                ends = np.cumsum(n)
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array([f[flat[e - k : e]].tobytes() for e, k in zip(ends, n, strict=True)], pa.binary())], names=["doc_id", "label", "f"])

    got = sorted((r["doc_id"], bytes(r["f"]), r["label"]) for r in rows.mapInArrow(lean(bucket), "doc_id bigint, label int, f binary").toLocalIterator())
    y = np.array([r[2] for r in got], np.float32)
    if not 0 < y.sum() < len(y):
        return Model(s, np.zeros((s.buckets + 1, s.dim), np.float32), [np.zeros((w, s.dim, s.filters), np.float32) for w in s.widths], np.zeros(len(s.widths) * s.filters, np.float32), np.zeros(len(s.widths) * s.filters, np.float32), float(min(np.log((counts.get(1, 0) + 0.5) / (counts.get(0, 0) + 1)), np.log(0.5))))
    texts = [np.frombuffer(f, s.kind).reshape(-1, FEATURES) for _, f, _ in got]
    del got
    model = train(texts, y, s)
    # the sample has the classes about even; shift to their true odds
    model.out_bias += float(np.log(counts[1] / counts[0]) - np.log(y.sum() / (len(y) - y.sum())))
    return model


#: Texts, and characters of them together, that are scored at a time.
TOGETHER, CHARACTERS = 512, 1 << 20


def score(docs: DataFrame, model: Model, text: str = "text", into: str = "score", keep_text: bool = True, within: str | None = None) -> DataFrame:
    """docs with a column of scores; all other columns pass through. Reads nothing but the text, which is a column or, with
    `within`, a field of the struct of that name."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(within or text)
    kept = [i for i, c in enumerate(docs.columns) if keep_text or c != text]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value)
        for b in batches:
            texts = b.column(at).field(text) if within else b.column(at)
            sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
            start, held = 0, 0
            for i, n in enumerate(sizes.tolist()):
                held += n
                if held >= CHARACTERS or i + 1 - start == TOGETHER or i + 1 == b.num_rows:
                    part = b.slice(start, i + 1 - start)
                    scores = pa.array(scorer(texts.slice(start, i + 1 - start).to_pylist()), pa.float64())
                    yield pa.RecordBatch.from_arrays([*[part.column(k) for k in kept], scores], names=[*[part.schema.names[k] for k in kept], into])
                    start, held = i + 1, 0

    return docs.mapInArrow(lean(run), T.StructType([docs.schema[i] for i in kept]).add(into, "double"))


def thresholds(scored: DataFrame, labels: DataFrame, label: str = "toxic", key: str = "doc_id", bins: int = 1000, least: int = 10) -> DataFrame:
    """lkey, threshold: for each language the cut with the best F1 over its labelled documents of fold 1, on which the model
    that scored them wasn't trained (the highest of equal cuts). Histograms of the scores by language are summed map-side.
    A language with fewer than `least` toxic labels among these has the cut over all languages, which the empty lkey has
    too; if all together have fewer, it is 0.5. scored: doc_id, lkey, score."""
    known = labelled(labels, label, key, (1,))
    rows = scored.select("doc_id", "lkey", F.least(F.floor(F.col("score") * bins), F.lit(bins - 1)).alias("bin"))
    hist = save(rows.join(known, "doc_id", "left").groupBy("lkey", "bin").agg(F.coalesce(F.sum("label"), F.lit(0)).alias("pos"), F.count("label").alias("n")), "histograms")

    def best(h: DataFrame) -> DataFrame:
        down, every = Window.partitionBy("lkey").orderBy(F.desc("bin")), Window.partitionBy("lkey")
        f1 = F.try_divide(2 * F.sum("pos").over(down), F.sum("n").over(down) + F.sum("pos").over(every))
        h = h.withColumn("f1", f1).withColumn("all", F.sum("pos").over(every))
        return h.groupBy("lkey").agg(F.when(F.max("all") >= least, F.max_by("bin", F.struct(F.round("f1", 9), "bin")) / bins).alias("threshold"))

    pooled = hist.agg(F.lit("").alias("lkey")).select("lkey")
    pooled = pooled.join(best(hist.groupBy("bin").agg(F.sum("pos").alias("pos"), F.sum("n").alias("n")).withColumn("lkey", F.lit(""))), "lkey", "left")
    pooled = pooled.select("lkey", F.coalesce("threshold", F.lit(0.5)).alias("threshold"))
    all_of = F.broadcast(pooled.select(F.col("threshold").alias("pooled")))
    return best(hist).crossJoin(all_of).select("lkey", F.coalesce("threshold", "pooled").alias("threshold")).unionByName(pooled)


def judged(docs: DataFrame, labels: DataFrame, passed: list[str], label: str = "toxic", settings: Settings = Settings(), model: Model | None = None, key: str = "doc_id", lang: str = "lang") -> DataFrame:
    """row (a struct of the columns of docs that are passed on, where their names clash with none), score, threshold,
    flagged."""
    of = lambda c: F.col(f"`{c}`")
    lkey = F.coalesce(F.concat(F.lit("s"), of(lang)), F.lit("n")).alias("lkey")
    settle(docs.sparkSession)
    trial = model or fit(docs, labels, label, settings, key, (2, 3, 4))
    settle(docs.sparkSession)
    known = docs.select(of(key).alias("doc_id"), lkey, of("text").alias("text")).join(labelled(labels, label, key, (1,)).select("doc_id"), "doc_id", "left_semi")
    cuts = save(thresholds(score(known, trial, keep_text=False), labels, label, key), "cuts")
    settle(docs.sparkSession)
    model = model or fit(docs, labels, label, settings, key)
    settle(docs.sparkSession)
    rows = docs.select(F.struct(*map(of, passed)).alias("row"), lkey, *([] if "text" in passed else [of("text").alias("text")]))
    scored = score(rows, model, keep_text=False, within="row" if "text" in passed else None)
    other = cuts.where("lkey = ''").select(F.col("threshold").alias("pooled"))
    out = scored.join(small_enough(cuts), "lkey", "left").crossJoin(F.broadcast(other))
    return out.select("row", "score", F.coalesce("threshold", "pooled").alias("threshold")).withColumn("flagged", F.col("score") >= F.col("threshold"))


def classify(docs: DataFrame, labels: DataFrame, label: str = "toxic", settings: Settings = Settings(), model: Model | None = None, into: str = "score", keep_text: bool = True) -> DataFrame:
    """docs with `into`, the threshold of its language (`into`_threshold) and whether the score reaches it (`into`_flagged).

    Scores cover whole texts; a null or empty text has the score of no activation. Null or unknown languages have
    thresholds of their own. Ties and repeated rows are scored alike. Other columns pass through whatever their names;
    one named like a result needs another `into`. Empty table: no rows.
    """
    passed = [c for c in docs.columns if keep_text or c != "text"]
    out = judged(docs, labels, passed, label, settings, model)
    return out.select(*[F.col("row").getField(c).alias(c) for c in passed], F.col("score").alias(into), F.col("threshold").alias(f"{into}_threshold"), F.col("flagged").alias(f"{into}_flagged"))


def keep_clean(docs: DataFrame, labels: DataFrame, label: str = "toxic", settings: Settings = Settings()) -> DataFrame:
    """docs without those that reach their language's threshold (see classify); no column is added."""
    out = judged(docs, labels, docs.columns, label, settings).where("NOT flagged")
    return out.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])
