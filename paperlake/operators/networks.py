"""Small networks on node features, with or without a graph: two layers, trained on all nodes at a time.

The graph's products are joins and sums (see spread); what a layer does to a row is an Arrow step; weights, and the sums of
their gradients, are all that the driver holds.
"""

from __future__ import annotations

import io
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import VECTOR, drop, save, small_enough

#: Activations of the hidden layer, each with its derivative by its own value.
ACTIVATIONS: dict[str, tuple[Callable, Callable]] = {
    "relu": (lambda z: np.maximum(z, 0), lambda h: (h > 0).astype(float)),
    "tanh": (np.tanh, lambda h: 1 - h * h),
    "identity": (lambda z: z, np.ones_like),
}


@dataclass
class Settings:
    hidden: int = 16
    epochs: int = 200
    rate: float = 0.01
    #: Weight of the first layer's squared weights.
    decay: float = 5e-4
    #: Epochs after which a validation cost above their mean ends the training.
    patience: int = 10
    activation: str = "relu"
    seed: int = 0
    #: Share of the entries of each layer's input that an epoch of training does without.
    drop: float = 0.0


def rows_of(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_numpy()).astype(float) if len(column) else np.zeros((0, 0))


@dataclass
class Supports:
    """Several matrices (i, j, value; symmetric), through each of which a layer sees its input: see several()."""

    pairs: DataFrame
    count: int


def several(*matrices: DataFrame) -> Supports:
    """Matrices as one table of i, j and their values there, so a layer is one join however many they are."""
    rows = [m.select("i", "j", *[(F.col("value") if k == n else F.lit(0.0)).alias(f"v{k}") for k in range(len(matrices))]) for n, m in enumerate(matrices)]
    sums = reduce(DataFrame.unionByName, rows).groupBy("i", "j").agg(*[F.sum(f"v{k}").alias(f"v{k}") for k in range(len(matrices))])
    return Supports(save(sums.select("i", "j", F.array(*[f"v{k}" for k in range(len(matrices))]).alias("values")), "supports"), len(matrices))


def _pairs(matrix: DataFrame | Supports) -> tuple[DataFrame, int]:
    return (matrix.pairs, matrix.count) if isinstance(matrix, Supports) else (matrix.select("i", "j", F.array("value").alias("values")), 1)


def _summed(rows: DataFrame, parts: list[Column], into: str) -> DataFrame:
    """id, into: sums, an entry a part, combined before the shuffle, so hubs are no long lists."""
    sums = rows.select("i", *[x.alias(f"x{k}") for k, x in enumerate(parts)]).groupBy(F.col("i").alias("id")).agg(*[F.sum(f"x{k}").alias(f"x{k}") for k in range(len(parts))])
    return sums.select("id", F.array(*[f"x{k}" for k in range(len(parts))]).alias(into))


def one_a_node(rows: DataFrame, column: str, width: int) -> DataFrame:
    """id, column: the sum of the arrays of rows that share an id, so that a product joins each node once."""
    return _summed(rows.select(F.col("id").alias("i"), column), [F.get(column, F.lit(c)) for c in range(width)], column)


def _sent(rows: DataFrame, column: str, used: list[DataFrame]) -> DataFrame:
    """j, v: rows as a written table, which is broadcast if it is small: then the matrix stays where it is."""
    used.append(save(rows.select(F.col("id").alias("j"), F.col(column).alias("v")), "sent"))
    return small_enough(used[-1], VECTOR)


def spread(matrix: DataFrame | Supports, rows: DataFrame, column: str, width: int, used: list[DataFrame] | None = None) -> DataFrame:
    """id, column: the products of a sparse matrix (i, j, value), or of each of several, and rows of arrays, side by side.
    used: gets the table written on the way, to be dropped after the result."""
    pairs, count = _pairs(matrix)
    both = pairs.join(_sent(rows, column, [] if used is None else used), "j")
    return _summed(both, [F.get("values", F.lit(k)) * F.get("v", F.lit(c)) for k in range(count) for c in range(width)], column)


def gathered(matrix: DataFrame | Supports, rows: DataFrame, column: str, width: int, used: list[DataFrame] | None = None) -> DataFrame:
    """id, column: what spread() passes back: of rows of as many parts as there are matrices, the sum of the products of
    each matrix and its part."""
    pairs, count = _pairs(matrix)
    both = pairs.join(_sent(rows, column, [] if used is None else used), "j")
    return _summed(both, [reduce(Column.__add__, [F.get("values", F.lit(k)) * F.get("v", F.lit(k * width + c)) for k in range(count)]) for c in range(width)], column)


def kept(rate: float, seed: int, layer: int, epoch: int, place: Column) -> Column:
    """What a layer's input at a place of a node's row is multiplied by: 0 in a share of `rate` of all, else 1 / (1 - rate);
    read off a hash, so that it is the same on the way back and whenever a task runs again."""
    uniform = F.pmod(F.xxhash64(F.col("id"), F.lit(seed), F.lit(layer), F.lit(epoch), place), F.lit(1 << 30)) / float(1 << 30)
    return F.when(uniform < rate, 0.0).otherwise(1 / (1 - rate))


def dropped(rows: DataFrame, column: str, rate: float, seed: int, layer: int, epoch: int) -> DataFrame:
    """rows (id, column, ...) with the entries of column that this layer keeps in this epoch."""
    return rows.withColumn(column, F.transform(F.col(column).cast("array<double>"), lambda x, k: x * kept(rate, seed, layer, epoch, k))) if rate else rows


def dense(rows: DataFrame, column: str, weights: np.ndarray, into: str, activation: str = "identity") -> DataFrame:
    """rows (id, column, ...) with a layer's output: activation of column times weights."""
    act = ACTIVATIONS[activation][0]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            f[into] = list(act(rows_of(f[column]) @ weights)) if len(f) else []
            yield f

    return rows.mapInPandas(run, rows.select("*", F.lit(None).cast("array<double>").alias(into)).schema)


@dataclass
class Network:
    """A perceptron (matrix=None) or a graph convolution network (matrix: i, j, value, symmetric; see
    features.adjacency_normalised): softmax(S act(S X W0) W1), S being that matrix or nothing. Of several matrices (see
    several, features.chebyshev_matrices) a layer sums over all of them, each with weights of its own."""

    settings: Settings = field(default_factory=Settings)
    weights: list[np.ndarray] = field(default_factory=list)
    costs: list[tuple[float, float]] = field(default_factory=list)
    #: Tables written for products, until fit() drops them after an epoch.
    used: list[DataFrame] = field(default_factory=list, repr=False)

    def _start(self, width: int, classes: int, supports: int) -> None:
        rng, s = np.random.default_rng(self.settings.seed), self.settings
        sizes = [(supports * width, s.hidden), (supports * s.hidden, classes)]
        self.weights = [rng.uniform(-1, 1, z) * np.sqrt(6 / sum(z)) for z in sizes]

    def forward(self, inputs: DataFrame, matrix: DataFrame | Supports | None, epoch: int | None = None) -> DataFrame:
        """id, x, q: what the last layer sees of every node. inputs: id, x, spread already; without a matrix their other
        columns stay. epoch: that of training, whose entries are dropped."""
        hidden = dense(inputs, "x", self.weights[0], "q", self.settings.activation)
        if epoch is not None:
            hidden = dropped(hidden, "q", self.settings.drop, self.settings.seed, 1, epoch)
        if matrix is None:
            return hidden
        return inputs.select("id", "x").join(spread(matrix, hidden.select("id", "q"), "q", self.settings.hidden, self.used), "id")

    def fit(self, rows: DataFrame, matrix: DataFrame | Supports | None = None, classes: int | None = None) -> Network:
        """rows: id, x (array of doubles), label, split ('train', 'valid' or another). Adam on the mean cross-entropy of the
        training nodes; ends early when the cost of the validation nodes, for which nothing is dropped, rises over the mean
        of the last epochs'. Of rows that share an id each counts: without a matrix nothing is joined, so their number never
        multiplies; with one their x are summed before the product."""
        s = self.settings
        width = rows.agg(F.max(F.size("x"))).first()[0] or 0
        classes = classes or (rows.agg(F.max("label")).first()[0] or 0) + 1
        self._start(width, classes, matrix.count if isinstance(matrix, Supports) else 1)
        marked = "split IN ('train', 'valid') AND label IS NOT NULL"
        marks = rows.select("id", "label", "split").where(marked)
        plain = rows.select("id", F.col("x").cast("array<double>").alias("x"), *([] if matrix is not None else ["label", "split"]))
        shown = lambda x: save(spread(matrix, one_a_node(x, "x", width), "x", width, self.used) if matrix is not None else x, "inputs")
        labelled = lambda x: x.select("id", "q").join(marks, "id") if matrix is not None else x.where(marked)
        inputs = whole = shown(plain)
        counts = {r["split"]: r["n"] for r in marks.groupBy("split").agg(F.count("*").alias("n")).collect()}
        m, v = [np.zeros_like(w) for w in self.weights], [np.zeros_like(w) for w in self.weights]
        for epoch in range(1, s.epochs + 1):
            if s.drop:
                inputs = shown(dropped(plain, "x", s.drop, s.seed, 0, epoch))
            seen = save(labelled(self.forward(inputs, matrix, epoch)), "seen")
            gradients, cost = self._gradients(seen, inputs, matrix, max(counts.get("train", 0), 1), epoch)
            drop(seen)
            if s.drop:
                drop(inputs)
                cost["valid"] = self._cost(labelled(self.forward(whole, matrix)).where("split = 'valid'").select("q", "label"))
            gradients[0] += s.decay * self.weights[0]
            for k, g in enumerate(gradients):
                m[k] += 0.1 * (g - m[k])
                v[k] += 0.001 * (g * g - v[k])
                self.weights[k] = self.weights[k] - s.rate * (m[k] / (1 - 0.9**epoch)) / (np.sqrt(v[k] / (1 - 0.999**epoch)) + 1e-8)
            drop(*self.used)
            self.used.clear()
            self.costs.append((cost["train"] / max(counts.get("train", 0), 1), cost["valid"] / max(counts.get("valid", 0), 1)))
            last = [c for _, c in self.costs[-s.patience - 1 : -1]]
            if counts.get("valid") and len(last) == s.patience and self.costs[-1][1] > np.mean(last):
                break
        drop(whole)
        return self

    def _cost(self, seen: DataFrame) -> float:
        """The summed cross-entropy of nodes (q, label)."""
        weights = self.weights[1]

        def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            total = 0.0
            for f in frames:
                if len(f):
                    z = rows_of(f["q"]) @ weights
                    z = z - z.max(1, keepdims=True)
                    total += float((np.log(np.exp(z).sum(1)) - z[np.arange(len(z)), f["label"].to_numpy()]).sum())
            yield pd.DataFrame({"cost": [total]})

        return seen.mapInPandas(run, "cost double").agg(F.sum("cost")).first()[0] or 0.0

    def _gradients(self, seen: DataFrame, inputs: DataFrame, matrix: DataFrame | Supports | None, n: int, epoch: int) -> tuple[list[np.ndarray], dict[str, float]]:
        s, weights, slope = self.settings, self.weights, ACTIVATIONS[self.settings.activation]
        hidden, classes = weights[1].shape

        def loss(f: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            q = rows_of(f["q"])
            z = q @ weights[1]
            p = np.exp(z - z.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            y = f["label"].to_numpy()
            cost = -np.log(p[np.arange(len(y)), y] + 1e-300)
            p[np.arange(len(y)), y] -= 1
            return q, p, cost

        def last(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            g, cost = np.zeros((hidden, classes)), {"train": 0.0, "valid": 0.0}
            for f in frames:
                if len(f):
                    q, d, c = loss(f)
                    train = (f["split"] == "train").to_numpy()
                    g += q[train].T @ d[train]
                    cost["train"] += c[train].sum()
                    cost["valid"] += c[~train].sum()
            yield pd.DataFrame({"g": [g.ravel()], "train": [cost["train"]], "valid": [cost["valid"]]})

        def back(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for f in frames:
                if len(f):
                    f["d"] = list(loss(f)[1] @ weights[1].T)
                    yield f[carried]

        def first(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            g = np.zeros_like(weights[0])
            for f in frames:
                if len(f):
                    x = rows_of(f["x"])
                    g += x.T @ (rows_of(f["d"]) * slope[1](slope[0](x @ weights[0])))
            yield pd.DataFrame({"g": [g.ravel()]})

        total = lambda parts, shape: np.sum([np.array(r["g"]) for r in parts] or [np.zeros(np.prod(shape))], 0).reshape(shape) / n
        parts = seen.mapInPandas(last, "g array<double>, train double, valid double").collect()
        carried = ["id", "d"] if matrix is not None else ["id", "x", "d"]
        d = seen.where("split = 'train'").mapInPandas(back, seen.withColumn("d", F.col("q")).select(*carried).schema)
        if matrix is not None:
            d = gathered(matrix, one_a_node(d, "d", hidden), "d", s.hidden, self.used)
        d = dropped(d, "d", s.drop, s.seed, 1, epoch)
        both = d if matrix is None else inputs.select("id", "x").join(d, "id")
        lower = both.select("x", "d").mapInPandas(first, "g array<double>").collect()
        return [total(lower, weights[0].shape), total(parts, weights[1].shape)], {k: sum(r[k] for r in parts) for k in ("train", "valid")}

    def predict(self, rows: DataFrame, matrix: DataFrame | Supports | None = None) -> DataFrame:
        """id, probability of every node. rows: id, x."""
        width = self.weights[0].shape[0] // (matrix.count if isinstance(matrix, Supports) else 1)
        plain = rows.select("id", F.col("x").cast("array<double>").alias("x"))
        inputs = save(spread(matrix, one_a_node(plain, "x", width), "x", width), "inputs") if matrix is not None else plain
        z = dense(self.forward(inputs, matrix).select("id", "q"), "q", self.weights[1], "z").select("id", "z")
        e = F.transform("z", lambda x: F.exp(x - F.array_max("z")))
        return z.select("id", e.alias("e")).select("id", F.transform("e", lambda x: x / F.aggregate("e", F.lit(0.0), lambda a, b: a + b)).alias("probability"))

    def save(self, spark: SparkSession, path: str) -> None:
        out = io.BytesIO()
        np.savez(out, *self.weights)
        spark.createDataFrame([(bytearray(out.getvalue()), self.settings.activation)], "weights binary, activation string").coalesce(1).write.parquet(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> Network:
        row = spark.read.parquet(path).first()
        stored = np.load(io.BytesIO(bytes(row["weights"])))
        weights = [stored[f"arr_{k}"] for k in range(len(stored.files))]
        return cls(Settings(hidden=weights[0].shape[1], activation=row["activation"]), weights)
