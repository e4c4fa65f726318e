"""Features and labels from the citation graph, embeddings, and classifier metrics."""

from __future__ import annotations

import numpy as np
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import VECTOR, drop, parts, positions, save, small_enough


def primary_category(categories: Column) -> Column:
    """First of the space-separated names in the first element."""
    return F.get(F.split(F.get(categories, F.lit(0)), r"\s+"), F.lit(0))


def main_category(name: Column) -> Column:
    return F.split_part(name, F.lit("."), F.lit(1))


def label_cut_compat(label: Column) -> Column:
    """First name, cut at its dot; without a dot it loses its last character, as trained models in use expect."""
    first = F.get(F.split(label, r"\s+"), F.lit(0))
    dot = F.instr(first, ".")
    return F.substr(first, F.lit(1), F.when(dot > 0, dot - 1).otherwise(F.length(first) - 1))


def encode_labels(rows: DataFrame, column: str, into: str = "label") -> DataFrame:
    """Numbers by sorted label, the same in every run; and the one-hot form. The vocabulary is numbered in a table of its
    own, which is broadcast if it is small."""
    names = save(positions(rows.select(column).distinct(), column, into="place"), "labels")
    width = names.count()
    out = rows.join(small_enough(names), column).withColumn(into, F.col("place") - 1).drop("place")
    return out.withColumn("one_hot", F.transform(F.sequence(F.lit(0), F.lit(max(width - 1, 0))), lambda i: (i == F.col(into)).cast("int")))


def counts_by_category(rows: DataFrame, column: str) -> DataFrame:
    return rows.groupBy(column).agg(F.count("*").alias("n")).orderBy(F.desc("n"), column)


def citation_matrix(refs: DataFrame, split: DataFrame, normalize: bool = True) -> DataFrame:
    """src, dst, value: who cites whom, by share of the row's kept references. Training rows may cite training rows only,
    others all; none cites itself; repeats add up. refs: id, refs; split: id, train. Rows of split that share an id cite
    and are cited each: they are counted by id, and pairs of them are products of these counts."""
    e = refs.select(F.col("id").alias("src"), F.explode("refs").alias("dst")).where("src <> dst").groupBy("src", "dst").agg(F.count("*").alias("n"))
    kinds = small_enough(save(split.groupBy("id").agg(F.count("*").alias("all"), F.count_if("train").alias("train"), F.count_if(~F.col("train")).alias("other")), "split"))
    e = e.join(kinds.select(F.col("id").alias("src"), F.col("all").alias("from_all"), F.col("other").alias("from_other")), "src").join(kinds.select(F.col("id").alias("dst"), "all", "train"), "dst")
    pairs = F.col("train") * F.col("from_all") + (F.col("all") - F.col("train")) * F.col("from_other")
    m = e.select("src", "dst", (F.col("n") * pairs).alias("c")).where("c > 0")
    value = F.col("c") / F.sum("c").over(Window.partitionBy("src")) if normalize else F.col("c").cast("double")
    return m.select("src", "dst", value.alias("value"))


def citation_feature(matrix: DataFrame, labels: DataFrame) -> DataFrame:
    """src, label, value: how much of a row's citations goes to each label; of labels that share an id each counts."""
    each = small_enough(save(labels.groupBy(F.col("id").alias("dst"), "label").agg(F.count("*").alias("n")), "labels"))
    return matrix.join(each, "dst").groupBy("src", "label").agg(F.sum(F.col("value") * F.col("n")).alias("value"))


def dense(feature: DataFrame, rows: DataFrame, width: int) -> DataFrame:
    """id, features: arrays of `width` values, zeros where a row cites nothing."""
    wide = feature.groupBy(F.col("src").alias("id")).agg(F.map_from_entries(F.collect_list(F.struct("label", "value"))).alias("m"))
    return rows.select("id").join(wide, "id", "left").select("id", F.transform(F.sequence(F.lit(0), F.lit(width - 1)), lambda i: F.coalesce(F.try_element_at("m", i), F.lit(0.0))).alias("features"))


def fill_zeros(rows: DataFrame, embeddings: DataFrame, dim: int) -> DataFrame:
    """rows with their embedding, zeros where there is none."""
    return rows.join(embeddings, "id", "left").withColumn("embedding", F.coalesce("embedding", F.array_repeat(F.lit(0.0).cast("float"), dim)))


def concat_features(left: DataFrame, right: DataFrame) -> DataFrame:
    return left.join(right.withColumnRenamed("embedding", "__right"), "id").select("id", F.concat("embedding", "__right").alias("embedding"))


def in_top(probability: Column, label: Column, n: int) -> Column:
    """Whether the label is among the n most probable; of equal probabilities the higher label comes first."""
    own = F.get(probability, label)
    before = F.filter(F.transform(probability, lambda p, i: (p > own) | ((p == own) & (i > label))), lambda x: x)
    return F.size(before) < n


def metrics(scores: DataFrame, label: str = "label", probability: str = "probability") -> DataFrame:
    """One row: top1, top3, top5, summed log-likelihood, perplexity."""
    p, y = F.col(probability), F.col(label)
    ll = F.log(F.get(p, y))
    top = [F.avg(in_top(p, y, n).cast("double")).alias(f"top{n}") for n in (1, 3, 5)]
    return scores.agg(*top, F.sum(ll).alias("loglikelihood"), F.exp(-F.avg(ll)).alias("perplexity"))


def train_and_score(rows: DataFrame, features: list[str], iterations: int = 50, regularization: float = 1e-7, classifier=None) -> DataFrame:
    """Scores of the rows outside the training split by one model per label, normalised to sum to one. rows: id, label,
    train, and array columns of features. classifier: makes an estimator of names of columns (labelCol, featuresCol,
    probabilityCol, rawPredictionCol, predictionCol); a logistic model unless given."""
    classifier = classifier or (lambda **names: LogisticRegression(maxIter=iterations, regParam=regularization, **names))
    vectors = rows.select("id", "label", "train", *[array_to_vector(F.transform(f, lambda x: x.cast("double"))).alias(f) for f in features])
    vectors = VectorAssembler(inputCols=features, outputCol="all").transform(vectors)
    scaled = StandardScaler(inputCol="all", outputCol="features", withMean=False).fit(vectors.where("train")).transform(vectors).select("id", "label", "train", "features")
    train, out = scaled.where("train").cache(), scaled.where("NOT train")
    labels = sorted(r[0] for r in train.select("label").distinct().collect())
    width = max(labels) + 1
    for k in labels:
        one = classifier(labelCol="own", featuresCol="features", probabilityCol=f"p{k}", rawPredictionCol=f"r{k}", predictionCol=f"y{k}")
        out = one.fit(train.withColumn("own", (F.col("label") == k).cast("double"))).transform(out)
    train.unpersist()
    odds = out.select("id", "label", F.array(*[vector_to_array(f"p{k}")[1] if k in labels else F.lit(0.0) for k in range(width)]).alias("odds"))
    total = F.aggregate("odds", F.lit(0.0), lambda a, b: a + b)
    return odds.select("id", "label", F.transform("odds", lambda x: x / total).alias("probability"))


def experiments(names: list[str]) -> dict[str, list[str]]:
    """Each feature alone, all, and all but each."""
    return {n: [n] for n in names} | {"all": names} | {f"all-{n}": [m for m in names if m != n] for n in names}


def ablation(rows: DataFrame, names: list[str], iterations: int = 50) -> DataFrame:
    """model, and its metrics: one row an experiment."""
    out = None
    for model, features in experiments(names).items():
        m = metrics(train_and_score(rows, features, iterations)).withColumn("model", F.lit(model))
        out = m if out is None else out.unionByName(m)
    return out


def row_normalised(matrix: DataFrame) -> DataFrame:
    """value / row sum; rows that sum to zero become zeros. matrix: i, j, value."""
    s = F.sum("value").over(Window.partitionBy("i"))
    return matrix.select("i", "j", F.when(s == 0, 0.0).otherwise(F.col("value") / s).alias("value"))


def adjacency_normalised(nodes: DataFrame, e: DataFrame, loops: bool = True, repeats: bool = True) -> DataFrame:
    """i, j, value of D^-1/2 (A + I) D^-1/2 over undirected edges. Nodes that share an id have a loop each, in a row each
    or, without `repeats`, summed in one. Degrees are a row a node, broadcast if they are small."""
    pairs = save(e.select(F.least("src", "dst").alias("i"), F.greatest("src", "dst").alias("j")).repartition(parts(e), "i", "j").distinct(), "pairs")
    turned = F.explode(F.array_distinct(F.array(F.struct("i", "j"), F.struct(F.col("j").alias("i"), F.col("i").alias("j")))))
    a = pairs.select(turned.alias("p")).select("p.i", "p.j", F.lit(1).cast("long").alias("n"))
    if loops:
        a = a.unionByName(nodes.groupBy(F.col("id").alias("i")).agg(F.count("*").alias("n")).select("i", F.col("i").alias("j"), "n"))
    d = small_enough(save(a.groupBy("i").agg(F.sum("n").alias("d")), "degrees"))
    value = 1 / F.sqrt(F.col("d") * F.col("dj"))
    a = a.join(d, "i").join(d.select(F.col("i").alias("j"), F.col("d").alias("dj")), "j")
    if not repeats or not loops:
        return a.select("i", "j", (value * F.col("n")).alias("value"))
    return a.select("i", "j", value.alias("value"), F.explode(F.array_repeat(F.lit(0), F.when(F.col("i") == F.col("j"), F.col("n")).otherwise(1).cast("int")))).select("i", "j", "value")


def by_row(matrix: DataFrame, e: DataFrame, name: str) -> DataFrame:
    """matrix (i, j, value) of the links e as a written table: entries of an i are together and added up, so that a product
    sums a row before anything is shuffled."""
    return save(matrix.repartition(2 * parts(e), "i").groupBy("i", "j").agg(F.sum("value").alias("value")), name)


def times(matrix: DataFrame, features: DataFrame) -> DataFrame:
    """Product of a sparse matrix (i, j, value) and node features (id, k, x): a join and a sum."""
    return matrix.join(features.withColumnRenamed("id", "j"), "j").groupBy(F.col("i").alias("id"), "k").agg(F.sum(F.col("value") * F.col("x")).alias("x"))


def _one_a_node(features: DataFrame) -> DataFrame:
    """Features (id, k, x), those that several rows give a node added up before a product."""
    return features.groupBy("id", "k").agg(F.sum("x").alias("x"))


def propagated(matrix: DataFrame, features: DataFrame, hops: int = 2) -> DataFrame:
    """Features spread over `hops` steps of the normalised graph: the linear form of a graph convolution network."""
    features = _one_a_node(features)
    for _ in range(hops):
        features = times(matrix, features)
    return features


def largest_eigenvalue(matrix: DataFrame, tolerance: float = 1e-7, rounds: int = 300) -> float:
    """The largest eigenvalue of a symmetric matrix (i, j, value; every i has a row) by power iteration in Lanczos' form,
    which keeps what earlier steps tell. A step is a join and a sum; two vectors are written, and broadcast while they are
    small enough, so the matrix stays where it is (see by_row); only numbers are collected.
    Ends when an eigenvalue is within `tolerance` for sure."""
    zero = F.lit(0.0)
    now = held = save(matrix.select(F.col("i").alias("id")).distinct().select("id", (F.xxhash64("id") / F.lit(2.0**63)).alias("q"), zero.alias("p")), "lanczos")
    norm = now.agg(F.sqrt(F.sum(F.col("q") * F.col("q")))).first()[0]
    if not norm:
        return 0.0
    now = small_enough(held, VECTOR).withColumn("q", F.col("q") / norm)
    diagonal, off = [], []
    for _ in range(rounds):
        product = matrix.join(now.select(F.col("id").alias("j"), "q"), "j").select(F.col("i").alias("id"), zero.alias("q"), zero.alias("p"), (F.col("value") * F.col("q")).alias("y"))
        before, held = held, save(now.select("id", "q", "p", zero.alias("y")).unionByName(product).groupBy("id").agg(*[F.sum(c).alias(c) for c in "qpy"]), "lanczos")
        drop(before)
        now = small_enough(held, VECTOR)
        diagonal.append(now.agg(F.sum(F.col("q") * F.col("y"))).first()[0])
        rest = F.col("y") - diagonal[-1] * F.col("q") - (off[-1] if off else 0.0) * F.col("p")
        beta = now.agg(F.sqrt(F.sum(rest * rest))).first()[0]
        values, vectors = np.linalg.eigh(np.diag(diagonal) + np.diag(off, 1) + np.diag(off, -1))
        if beta * abs(vectors[-1, -1]) <= tolerance:
            return float(values[-1])
        off.append(beta)
        now = now.select("id", (rest / beta).alias("q"), F.col("q").alias("p"))
    raise RuntimeError("the largest eigenvalue did not settle")


def rescaled_laplacian(nodes: DataFrame, e: DataFrame) -> DataFrame:
    """i, j, value of 2/lambda L - I: L = I - D^-1/2 A D^-1/2 over undirected edges without self loops, lambda its largest
    eigenvalue. A node without edges has 1 in L."""
    own = nodes.select(F.col("id").alias("i"), F.col("id").alias("j"), F.lit(1.0).alias("value")).distinct()
    a = adjacency_normalised(nodes, e, loops=False).select("i", "j", (-F.col("value")).alias("value"))
    laplacian = by_row(own.unionByName(a), e, "laplacian")
    scale = 2 / (largest_eigenvalue(laplacian) or 1.0)
    return laplacian.select("i", "j", (scale * F.col("value") - F.when(F.col("i") == F.col("j"), 1.0).otherwise(0.0)).alias("value"))


def chebyshev_matrices(laplacian: DataFrame, order: int = 2) -> list[DataFrame]:
    """T_0 .. T_order of a rescaled Laplacian (i, j, value) as matrices, for layers with several supports: products are
    joins and sums, and T_k has entries between nodes at most k links apart only."""
    ids = laplacian.select("i").distinct()
    out = [save(ids.select("i", F.col("i").alias("j"), F.lit(1.0).alias("value")), "chebyshev"), laplacian.select("i", "j", "value")]
    for _ in range(2, order + 1):
        product = laplacian.select("i", F.col("j").alias("k"), F.col("value").alias("a")).join(out[-1].select(F.col("i").alias("k"), "j", F.col("value").alias("b")), "k").select("i", "j", (2 * F.col("a") * F.col("b")).alias("value"))
        both = product.unionByName(out[-2].select("i", "j", (-F.col("value")).alias("value")))
        out.append(save(both.groupBy("i", "j").agg(F.sum("value").alias("value")), "chebyshev"))
    return out[: order + 1]


def chebyshev(laplacian: DataFrame, features: DataFrame, order: int = 2) -> list[DataFrame]:
    """T_0 x .. T_order x of a rescaled Laplacian by the recurrence T_k = 2 L T_(k-1) - T_(k-2)."""
    sent = lambda x: small_enough(save(x, "features"), VECTOR)
    out = [features, sent(times(laplacian, sent(_one_a_node(features))))]
    for _ in range(2, order + 1):
        step = times(laplacian, out[-1]).select("id", "k", (2 * F.col("x")).alias("x")).unionByName(out[-2].select("id", "k", (-F.col("x")).alias("x")))
        out.append(sent(step.groupBy("id", "k").agg(F.sum("x").alias("x"))))
    return out[: order + 1]


def masked(rows: DataFrame, index: DataFrame, into: str = "mask", key: str = "i") -> DataFrame:
    """rows with a flag: whether their key is in index (a column of that name)."""
    known = index.select(key).distinct().withColumn(into, F.lit(True))
    return rows.join(known, key, "left").withColumn(into, F.coalesce(into, F.lit(False)))


def split_by_place(rows: DataFrame, train: int, valid: int, test: DataFrame, key: str = "i") -> DataFrame:
    """rows with `split`: the test set is listed; of the others the first by key train, the next validate, the rest have
    none."""
    tested = masked(rows, test, "__test", key)
    free = positions(tested.where("NOT __test").select(key), key)
    split = F.when(F.col("__test"), "test").when(F.col("position") <= train, "train").when(F.col("position") <= train + valid, "valid").otherwise("none")
    return tested.join(free, key, "left").withColumn("split", split).drop("__test", "position")


def masked_accuracy(scores: DataFrame, mask: str = "mask") -> DataFrame:
    """Accuracy and mean cross-entropy over the rows of a mask."""
    p, y = F.col("probability"), F.col("label")
    return scores.where(mask).agg(F.avg(in_top(p, y, 1).cast("double")).alias("accuracy"), F.avg(-F.log(F.get(p, y))).alias("cross_entropy"))
