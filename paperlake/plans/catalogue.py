"""Queries by name, and the SQL that DuckDB compares them with."""

from __future__ import annotations

import math
import re
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import authors, ids, tex, text
from ..operators import archives, citations, extraction, features, graph, manifest, metadata, networks, paths
from ..operators.shared import positions, save, shared_dir
from ..sources import corpora, stores, tars
from . import views
from .views import SQL, SQL_ID, read

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None, views: bool = True):
    """Registers a query by its function's name, with its twin in SQL."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = f"WITH {SQL} {sql}" if views else sql
        return f

    return add


def _quoted(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _sql_clean(x: str, pad: bool = True) -> str:
    """Canonical form of an identifier."""
    names = " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in sorted(ids.HYPHENS.items()))
    bare = f"regexp_replace({x}, '[vV][1-9][0-9]*.*$', '')"
    archive = f"split_part(split_part({bare}, '/', 1), '.', 1)"
    old = f"CASE {archive} {names} ELSE {archive} END || '/' || split_part({bare}, '/', 2)"
    new = f"CASE WHEN try_cast(split_part({bare}, '.', 1) AS INT) > 1500 AND length(split_part({bare}, '.', 2)) < 5 THEN split_part({bare}, '.', 1) || '.0' || split_part({bare}, '.', 2) ELSE {bare} END" if pad else bare
    return f"CASE WHEN contains({bare}, '/') THEN {old} ELSE {new} END"


def _sql_found(pattern: str) -> str:
    groups = re.compile(pattern).groups
    lists = ", ".join(f"regexp_extract_all(text, {_quoted(pattern)}, {g})" for g in range(1, groups + 1))
    return f"list_filter(flatten([{lists}]), lambda x: x <> '')"


def _sql_refs(pattern: str) -> str:
    return f"SELECT id, list_sort(list_distinct(list_transform({_sql_found(pattern)}, lambda x: {_sql_clean('x')}))) AS refs FROM fulltext"


# --- identifiers and citations ---------------------------------------------------------------------------------------


@query(_sql_refs(ids.PATTERNS["flexible"]))
def cite_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return citations.extract(views.fulltext(spark, sf_dir))


@query(_sql_refs(ids.PATTERNS["simple"]))
def cite_extract_simple(spark: SparkSession, sf_dir: str) -> DataFrame:
    return citations.extract(views.fulltext(spark, sf_dir), ids.PATTERNS["simple"])


@query(_sql_refs(ids.PATTERNS["strict"]))
def cite_extract_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    return citations.extract(views.fulltext(spark, sf_dir), ids.PATTERNS["strict"])


@query(f"SELECT {_sql_clean('r')} AS id, count(DISTINCT id) AS cited_by FROM (SELECT id, unnest(refs) AS r FROM ({_sql_refs(ids.PATTERNS['flexible'])})) WHERE r IN (SELECT id FROM nodes) AND r <> id GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 20")
def top_cited(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = citations.extract(views.fulltext(spark, sf_dir))
    e = graph.edges(found, views.nodes(spark, sf_dir), cleaned=False)
    return e.groupBy(F.col("dst").alias("id")).agg(F.count("*").alias("cited_by")).orderBy(F.desc("cited_by"), "id").limit(20)


def _loose(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    return read(spark, sf_dir, "orders").select(k.alias("k"), views.loose_id(k).alias("raw"))


@query("SELECT k, regexp_replace(raw, '[vV][1-9][0-9]*.*$', '') AS name FROM loose")
def id_strip_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _loose(spark, sf_dir).select("k", ids.strip_version(F.col("raw")).alias("name"))


@query(f"SELECT k, {_sql_clean('name', False)} AS name FROM (SELECT k, regexp_replace(raw, '[vV][1-9][0-9]*.*$', '') AS name FROM loose)")
def id_format_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _loose(spark, sf_dir).select("k", ids.format_archive(ids.strip_version(F.col("raw"))).alias("name"))


@query("SELECT k, CASE WHEN NOT contains(raw, '/') AND try_cast(split_part(raw, '.', 1) AS INT) > 1500 AND length(split_part(raw, '.', 2)) < 5 THEN split_part(raw, '.', 1) || '.0' || split_part(raw, '.', 2) ELSE raw END AS name FROM loose")
def id_zeropad(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _loose(spark, sf_dir).select("k", ids.pad_number(F.col("raw")).alias("name"))


@query(f"SELECT k, {_sql_clean('raw')} AS name FROM loose")
def id_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _loose(spark, sf_dir).select("k", ids.clean(F.col("raw")).alias("name"))


@query(f"SELECT k, {_sql_clean('raw', False)} AS name FROM loose")
def id_clean_node(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _loose(spark, sf_dir).select("k", ids.clean_node(F.col("raw")).alias("name"))


@query("""SELECT id, CASE WHEN contains(id, '.') THEN 'arxiv/' || split_part(id, '.', 1) || '/' || id || '.txt' ELSE split_part(id, '/', 1) || '/' || substr(split_part(id, '/', 2), 1, 4) || '/' || replace(id, '/', '') || '.txt' END AS path,
       CASE WHEN contains(id, '.') THEN split_part(id, '.', 1) || '/' || id || '.pdf' ELSE substr(split_part(id, '/', 2), 1, 4) || '/' || replace(id, '/', '') || '.pdf' END AS member, id AS back,
       'tarpdfs/t.tar.gz' AS tar, CASE WHEN contains(id, '.') THEN split_part(id, '.', 1) || '.txt' ELSE id || '.txt' END AS text_name FROM nodes""")
def id_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = F.col("id")
    return views.nodes(spark, sf_dir).select("id", ids.id_to_path(i).alias("path"), ids.id_to_member(i).alias("member"), ids.path_to_id(ids.id_to_path(i)).alias("back"), ids.archive_file(F.lit("a/b/t.tar")).alias("tar"), ids.with_extension(i, "txt").alias("text_name"))


@query(f"SELECT count(*) AS matches, avg((n.id IS NULL)::INT::DOUBLE) AS error_rate FROM (SELECT {_sql_clean('m')} AS id FROM (SELECT unnest({_sql_found(ids.PATTERNS['simple'])}) AS m FROM fulltext)) c LEFT JOIN nodes n ON c.id = n.id")
def extraction_error_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return citations.error_rate(views.fulltext(spark, sf_dir), views.nodes(spark, sf_dir))


@query(f"""SELECT id, right(b[i], 10) || m[i] || left(b[i + 1] || coalesce(m[i + 1] || b[i + 2], ''), 10) AS context FROM (
  SELECT id, m, b, unnest(range(1, len(m) + 1)) AS i FROM (SELECT id, regexp_extract_all(text, {_quoted(ids.PATTERNS['simple'])}) AS m, regexp_split_to_array(text, {_quoted(ids.PATTERNS['simple'])}) AS b FROM fulltext))""")
def context_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return citations.contexts(views.fulltext(spark, sf_dir), ids.PATTERNS["simple"])


@query("SELECT id, list_sort(list(ref)) AS refs FROM refs GROUP BY id")
def citation_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    return citations.from_json(citations.as_json(views.citations(spark, sf_dir))).select("id", F.array_sort("refs").alias("refs"))


@query("SELECT id, CASE WHEN n % 2 = 0 THEN refs ELSE list_sort(list_concat(refs, ['x'])) END AS refs FROM (SELECT id, list_sort(list(ref)) AS refs, count(*) AS n FROM refs GROUP BY id)")
def citation_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of two extractions of an article the longer list counts; equal ones are one."""
    c = views.citations(spark, sf_dir).select("id", F.array_sort("refs").alias("refs"))
    longer = c.where("size(refs) % 2 = 1").select("id", F.array_sort(F.concat("refs", F.array(F.lit("x")))).alias("refs"))
    return citations.merged(c.unionByName(longer).unionByName(c.select("id", F.slice("refs", 1, 1).alias("refs"))))


@query(f"""SELECT id, CASE WHEN NOT bad THEN list_sort(list_distinct(list_transform({_sql_found(ids.PATTERNS['simple'])}, lambda x: {_sql_clean('x')}))) END AS refs, CASE WHEN bad THEN 'not UTF-8' END AS error
  FROM (SELECT id, text, length(text) % 7 = 0 AS bad FROM fulltext)""")
def citation_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Citations of files, some of which aren't text."""
    t = views.fulltext(spark, sf_dir)
    content = F.concat(F.when(F.length("text") % 7 == 0, F.unhex(F.lit("FF"))).otherwise(F.lit("").cast("binary")), F.encode("text", "UTF-8"))
    return citations.extract_files(t.select(ids.id_to_path(F.col("id")).alias("path"), content.alias("content")), ids.PATTERNS["simple"])


@query(f"SELECT k, CASE WHEN contains(n, '/') THEN CASE split_part(split_part(n, '/', 1), '.', 1) {' '.join(f"WHEN '{a}' THEN '{b}'" for a, b in sorted(ids.HYPHENS.items()))} ELSE split_part(split_part(n, '/', 1), '.', 1) END || '/' || split_part(n, '/', 2) WHEN try_cast(split_part(n, '.', 1) AS INT) > 1500 AND length(split_part(n, '.', 2)) < 5 THEN split_part(n, '.', 1) || '.0' || split_part(n, '.', 2) ELSE n END AS name FROM (SELECT k, split_part(raw, 'v', 1) AS n FROM loose)")
def id_clean_variant(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _loose(spark, sf_dir).select("k", ids.clean_variant(F.col("raw")).alias("name"))


@query("SELECT replace(id, '/', '') || '.txt' AS file, CASE WHEN contains(id, '.') THEN 'arxiv/' || split_part(id, '.', 1) || '/' || id || '.txt' ELSE split_part(id, '/', 1) || '/' || substr(split_part(id, '/', 2), 1, 4) || '/' || replace(id, '/', '') || '.txt' END AS path FROM nodes")
def id_file_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    file = F.concat(F.replace(F.col("id"), F.lit("/"), F.lit("")), F.lit(".txt"))
    return views.nodes(spark, sf_dir).select(file.alias("file")).select("file", ids.file_to_path(F.col("file")).alias("path"))


# --- citation graph --------------------------------------------------------------------------------------------------


def _graph(spark: SparkSession, sf_dir: str, directed: bool = True) -> tuple[DataFrame, DataFrame]:
    n = views.nodes(spark, sf_dir)
    return n, graph.edges(views.references(spark, sf_dir), n, directed)


def _named(rows: DataFrame, numbers: DataFrame) -> DataFrame:
    """rows with ids instead of their numbers (see graph.by_number)."""
    return rows.join(numbers.select("n", F.col("id").alias("name")), F.col("id") == F.col("n")).select("name", *[c for c in rows.columns if c != "id"]).withColumnRenamed("name", "id")


@query("SELECT src, dst FROM edges")
def graph_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _graph(spark, sf_dir)[1]


@query("SELECT DISTINCT least(src, dst) AS src, greatest(src, dst) AS dst FROM edges")
def graph_edges_undirected(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _graph(spark, sf_dir, False)[1]


_DEGREES = "(SELECT n.id, (SELECT count(*) FROM edges e WHERE e.dst = n.id)::BIGINT AS in_degree, (SELECT count(*) FROM edges e WHERE e.src = n.id)::BIGINT AS out_degree FROM nodes n)"


@query(f"SELECT * FROM {_DEGREES}")
def graph_degrees(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.degrees(*_graph(spark, sf_dir))


@query(f"SELECT CASE WHEN hi = lo THEN 0 ELSE least(floor((in_degree - lo) * 30 / (hi - lo)), 29) END::INT AS bin, count(*) AS n FROM {_DEGREES}, (SELECT min(in_degree)::DOUBLE AS lo, max(in_degree)::DOUBLE AS hi FROM {_DEGREES}) GROUP BY 1")
def graph_degree_hist(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.histogram(graph.degrees(*_graph(spark, sf_dir)), "in_degree")


@query(f"SELECT CASE WHEN hi = lo THEN 0 ELSE least(floor((x - lo) * 50 / (hi - lo)), 49) END::INT AS bin, count(*) AS n FROM (SELECT log10(in_degree) AS x FROM {_DEGREES} WHERE in_degree > 0), (SELECT min(log10(in_degree)) AS lo, max(log10(in_degree)) AS hi FROM {_DEGREES} WHERE in_degree > 0) GROUP BY 1")
def graph_degree_log_hist(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.log_histogram(graph.degrees(*_graph(spark, sf_dir)), "in_degree")


@query("SELECT DISTINCT id FROM (SELECT " + SQL_ID("(l_partkey + 14500)") + " AS id FROM lineitem) WHERE id NOT IN (SELECT id FROM nodes)")
def graph_bad_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.unknown_ids(views.references(spark, sf_dir, 14500), views.nodes(spark, sf_dir))


_COMPONENTS = """, num AS (SELECT id, row_number() OVER (ORDER BY id) AS k FROM nodes),
sym AS (SELECT a.k AS u, b.k AS v FROM edges JOIN num a ON a.id = src JOIN num b ON b.id = dst UNION SELECT b.k, a.k FROM edges JOIN num a ON a.id = src JOIN num b ON b.id = dst),
cc AS (SELECT id, k FROM num)"""


def _components_sql(rest: str) -> str:
    views_ = SQL.strip()
    return f"WITH RECURSIVE {views_}{_COMPONENTS}, walk(v, c) USING KEY (v) AS (SELECT k AS v, k AS c FROM num UNION (SELECT s.v, min(w.c) AS c FROM walk w JOIN sym s ON s.u = w.v JOIN recurring.walk r ON r.v = s.v WHERE w.c < r.c GROUP BY s.v)), comp AS (SELECT n.id, m.id AS component FROM walk w JOIN num n ON n.k = w.v JOIN num m ON m.k = w.c) {rest}"


@query(_components_sql("SELECT id, component FROM comp"), views=False)
def graph_wcc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.components(*_graph(spark, sf_dir))


@query(_components_sql("SELECT id FROM comp WHERE component = (SELECT component FROM comp GROUP BY component ORDER BY count(*) DESC, component LIMIT 1)"), views=False)
def graph_largest_wcc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.largest(*_graph(spark, sf_dir))[0]


_CLUSTERING = f""", w AS (SELECT src AS u, dst AS v FROM edges UNION ALL SELECT dst, src FROM edges), ww AS (SELECT u, v, count(*)::BIGINT AS c FROM w GROUP BY u, v),
tri AS (SELECT a.u AS id, sum(a.c * b.c * c.c)::DOUBLE AS t FROM ww a JOIN ww b ON a.v = b.u JOIN ww c ON b.v = c.u AND c.v = a.u GROUP BY a.u),
mut AS (SELECT u AS id, count(*) AS m FROM ww WHERE c = 2 GROUP BY u), deg AS (SELECT id, in_degree + out_degree AS d FROM {_DEGREES}),
clu AS (SELECT deg.id, CASE WHEN t > 0 THEN t / (2.0 * (d * (d - 1) - 2 * coalesce(m, 0))) ELSE 0.0 END::DOUBLE AS clustering FROM deg LEFT JOIN tri USING (id) LEFT JOIN mut USING (id))"""


@query(f"WITH {SQL.strip()}{_CLUSTERING} SELECT id, round(clustering, 9) AS clustering FROM clu", views=False)
def graph_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.clustering(*_graph(spark, sf_dir)).select("id", F.round("clustering", 9).alias("clustering"))


@query(_components_sql("")[: -len(" ")] + _CLUSTERING + f""" SELECT (SELECT count(*) FROM nodes) AS nodes, (SELECT count(*) FROM edges) AS edges, round((SELECT 2 * avg(in_degree) FROM {_DEGREES}), 6) AS mean_degree,
  round((SELECT avg(clustering) FROM clu), 6) AS mean_clustering, round((SELECT max(n) / sum(n) FROM (SELECT count(*)::DOUBLE AS n FROM comp GROUP BY component)), 2) AS largest_share,
  round((SELECT sum((n = 1)::INT) / sum(n) FROM (SELECT count(*)::DOUBLE AS n FROM comp GROUP BY component)), 2) AS isolated_share""", views=False)
def graph_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = graph.summary(*_graph(spark, sf_dir))
    return s.select("nodes", "edges", F.round("mean_degree", 6).alias("mean_degree"), F.round("mean_clustering", 6).alias("mean_clustering"), F.round("largest_share", 2).alias("largest_share"), F.round("isolated_share", 2).alias("isolated_share"))


def graph_distances(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sketched: mean distance and effective diameter of the citation graph, links followed either way."""
    d = paths.distances(paths.neighbourhoods(*_graph(spark, sf_dir)))
    return d.select(F.round("mean_distance", 6).alias("mean_distance"), F.round("effective_diameter", 6).alias("effective_diameter"))


QUERIES["graph_distances"] = graph_distances


def graph_diameter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return paths.diameter(*graph.largest(*_graph(spark, sf_dir))).select("diameter", "nodes")


QUERIES["graph_diameter"] = graph_diameter


def _sql_betweenness(pivots: int, levels: int = 12) -> str:
    """Levels outward from the pivots with counts of paths, and back with shares of them."""
    out = f"""sym AS MATERIALIZED (SELECT src AS u, dst AS v FROM edges UNION SELECT dst, src FROM edges), ids AS (SELECT DISTINCT id FROM nodes),
    p0 AS MATERIALIZED (SELECT id AS s, id AS v, 1.0::DOUBLE AS n FROM ids ORDER BY md5('0:' || id), id LIMIT {pivots})"""
    for t in range(levels):
        known = " UNION ALL ".join(f"SELECT s, v FROM p{k}" for k in range(t + 1))
        out += f", p{t + 1} AS MATERIALIZED (SELECT s, v, n FROM (SELECT p.s, e.v, sum(p.n) AS n FROM p{t} p JOIN sym e ON e.u = p.v GROUP BY p.s, e.v) q ANTI JOIN ({known}) USING (s, v))"
    out += f", b{levels} AS MATERIALIZED (SELECT s, v, n, 0.0::DOUBLE AS share FROM p{levels})"
    for t in range(levels - 1, 0, -1):
        out += f", b{t} AS MATERIALIZED (SELECT p.s, p.v, p.n, coalesce(p.n * g.part, 0) AS share FROM p{t} p LEFT JOIN (SELECT b.s, e.u AS v, sum((b.share + 1) / b.n) AS part FROM b{t + 1} b JOIN sym e ON e.v = b.v GROUP BY b.s, e.u) g ON g.s = p.s AND g.v = p.v)"
    shares = " UNION ALL ".join(f"SELECT v, share FROM b{t}" for t in range(1, levels + 1))
    return f"{out} SELECT id, round(coalesce(sum(share), 0) * (SELECT count(*) FROM ids) / (SELECT count(*) FROM p0) / 2, 6) AS betweenness FROM ids LEFT JOIN ({shares}) ON v = id GROUP BY id"


@query(f"WITH {SQL.strip()}, {_sql_betweenness(16)}", views=False)
def graph_betweenness(spark: SparkSession, sf_dir: str) -> DataFrame:
    return paths.betweenness(*_graph(spark, sf_dir), pivots=16).select("id", F.round("betweenness", 6).alias("betweenness"))


@query(f"SELECT 2 AS xmin, count(*) AS tail, round(1 + count(*) / sum(ln(out_degree / 2.0)), 8) AS alpha FROM {_DEGREES} WHERE out_degree >= 2")
def powerlaw_fixed_xmin(spark: SparkSession, sf_dir: str) -> DataFrame:
    fit = graph.power_law(graph.degrees(*_graph(spark, sf_dir)), "out_degree", 2)
    return fit.select("xmin", "tail", F.round("alpha", 8).alias("alpha"))


@query(f"""SELECT xmin::DOUBLE AS xmin, round(alpha, 6) AS alpha, round(distance, 6) AS distance FROM (
  SELECT xmin, alpha, max(greatest(abs(below / n - 1 + pow(x / xmin, 1 - alpha)), abs((below + c) / n - 1 + pow(x / xmin, 1 - alpha)))) AS distance FROM (
    SELECT a.x AS xmin, b.x, b.c, sum(b.c) OVER (PARTITION BY a.x) AS n, 1 + sum(b.c) OVER (PARTITION BY a.x) / sum(b.c * ln(b.x / a.x)) OVER (PARTITION BY a.x) AS alpha, sum(b.c) OVER (PARTITION BY a.x ORDER BY b.x) - b.c AS below
    FROM (SELECT in_degree::DOUBLE AS x FROM {_DEGREES} WHERE in_degree > 0 GROUP BY 1) a JOIN (SELECT in_degree::DOUBLE AS x, count(*)::DOUBLE AS c FROM {_DEGREES} WHERE in_degree > 0 GROUP BY 1) b ON b.x >= a.x
    WHERE a.x < (SELECT max(in_degree) FROM {_DEGREES})) GROUP BY xmin, alpha) ORDER BY distance, xmin LIMIT 1""")
def powerlaw_best(spark: SparkSession, sf_dir: str) -> DataFrame:
    fit = graph.best_power_law(graph.degrees(*_graph(spark, sf_dir)), "in_degree")
    return fit.select("xmin", F.round("alpha", 6).alias("alpha"), F.round("distance", 6).alias("distance"))


_FIRST = ", few AS (SELECT id, (row_number() OVER (ORDER BY id) - 1)::INT AS i FROM (SELECT id FROM comp WHERE component = (SELECT component FROM comp GROUP BY component ORDER BY count(*) DESC, component LIMIT 1) ORDER BY id LIMIT 500))"


@query(_components_sql("")[: -len(" ")] + _FIRST + " SELECT a.i AS src, b.i AS dst FROM edges JOIN few a ON a.id = src JOIN few b ON b.id = dst", views=False)
def graph_first_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.first_nodes(*_graph(spark, sf_dir), 500)[1]


@query(_components_sql("")[: -len(" ")] + _FIRST + " SELECT few.id, few.i, label, train, refs FROM few JOIN nodes USING (id) LEFT JOIN (SELECT id, list_sort(list(ref)) AS refs FROM refs GROUP BY id) USING (id)", views=False)
def graph_first_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    n, e = _graph(spark, sf_dir)
    return graph.aligned(graph.first_nodes(n, e, 500)[0], n, views.citations(spark, sf_dir).select("id", F.array_sort("refs").alias("refs")))


@query(r"SELECT label::VARCHAR || ' & ' || count(*)::VARCHAR || ' \\' AS line FROM nodes GROUP BY label")
def report_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.latex_rows(views.nodes(spark, sf_dir).groupBy("label").agg(F.count("*").alias("n")))


_ADJ = ", adj AS (SELECT src AS i, dst AS j FROM edges UNION SELECT dst, src FROM edges UNION ALL SELECT id, id FROM nodes), ad AS (SELECT i, count(*) AS d FROM adj GROUP BY i)"


@query(f"WITH {SQL.strip()}{_ADJ} SELECT adj.i, adj.j, round(1 / sqrt(a.d * b.d), 9) AS value FROM adj JOIN ad a ON a.i = adj.i JOIN ad b ON b.i = adj.j", views=False)
def adj_normalised(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.adjacency_normalised(*_graph(spark, sf_dir, False)).select("i", "j", F.round("value", 9).alias("value"))


@query(f"WITH {SQL.strip()}{_ADJ} SELECT adj.i AS id, n.label AS k, round(sum(1 / sqrt(a.d * b.d)), 8) AS x FROM adj JOIN ad a ON a.i = adj.i JOIN ad b ON b.i = adj.j JOIN nodes n ON n.id = adj.j GROUP BY 1, 2", views=False)
def graph_propagated(spark: SparkSession, sf_dir: str) -> DataFrame:
    n, e = _graph(spark, sf_dir, False)
    x = n.select("id", F.col("label").alias("k"), F.lit(1.0).alias("x"))
    return features.propagated(features.adjacency_normalised(n, e, repeats=False), x, 1).select("id", "k", F.round("x", 8).alias("x"))


@query()
def graph_chebyshev(spark: SparkSession, sf_dir: str) -> DataFrame:
    numbers, n, e = graph.by_number(*_graph(spark, sf_dir, False))
    x = n.select("id", F.col("label").alias("k"), F.lit(1.0).alias("x"))
    return _named(features.chebyshev(features.rescaled_laplacian(n, e), x, 2)[2], numbers)


# --- features and models ---------------------------------------------------------------------------------------------

_MATRIX = ", m0 AS (SELECT r.id AS src, r.ref AS dst, count(*) AS c FROM refs r JOIN nodes a ON a.id = r.id JOIN nodes b ON b.id = r.ref WHERE r.id <> r.ref AND (b.train OR NOT a.train) GROUP BY 1, 2), m AS (SELECT src, dst, c / sum(c) OVER (PARTITION BY src) AS value FROM m0)"


@query(f"WITH {SQL.strip()}{_MATRIX} SELECT src, dst, round(value, 9) AS value FROM m", views=False)
def cocitation_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = features.citation_matrix(views.references(spark, sf_dir), views.nodes(spark, sf_dir))
    return m.select("src", "dst", F.round("value", 9).alias("value"))


@query(f"WITH {SQL.strip()}{_MATRIX} SELECT src, label, round(sum(value), 9) AS value FROM m JOIN nodes n ON n.id = m.dst GROUP BY 1, 2", views=False)
def cocitation_feature(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = views.nodes(spark, sf_dir)
    f = features.citation_feature(features.citation_matrix(views.references(spark, sf_dir), n), n)
    return f.select("src", "label", F.round("value", 9).alias("value"))


@query("SELECT o_orderpriority AS category, count(*) AS n FROM orders GROUP BY 1", views=False)
def category_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.counts_by_category(read(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias("category")), "category")


@query("SELECT p_partkey AS k, split_part(p_type, ' ', 1) AS first_name, split_part(replace(p_type, ' ', '.'), '.', 1) AS main, substr(split_part(p_type, ' ', 1), 1, length(split_part(p_type, ' ', 1)) - 1) AS cut FROM part", views=False)
def primary_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read(spark, sf_dir, "part")
    return p.select(F.col("p_partkey").alias("k"), features.primary_category(F.array("p_type")).alias("first_name"), features.main_category(F.replace(F.col("p_type"), F.lit(" "), F.lit("."))).alias("main"), features.label_cut_compat(F.col("p_type")).alias("cut"))


@query("SELECT o_orderkey AS k, (r - 1)::INT AS label, [(r = 1)::INT, (r = 2)::INT, (r = 3)::INT, (r = 4)::INT, (r = 5)::INT] AS one_hot FROM (SELECT *, dense_rank() OVER (ORDER BY o_orderpriority) AS r FROM orders)", views=False)
def label_one_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.encode_labels(read(spark, sf_dir, "orders"), "o_orderpriority").select(F.col("o_orderkey").alias("k"), "label", "one_hot")


def _scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A score table that both engines compute alike: labels 0 to 4, probabilities from the first components."""
    e = read(spark, sf_dir, "embeddings")
    raw = F.transform(F.slice("embedding", 1, 5), lambda x: F.round(F.abs(x.cast("double")), 3) + 0.001)
    total = F.aggregate(raw, F.lit(0.0), lambda a, b: a + b)
    return e.select("vec_id", (F.col("label") % 5).alias("label"), F.transform(raw, lambda x: x / total).alias("probability"))


_SCORES = "(SELECT vec_id, (label % 5)::INT AS label, list_transform(raw, lambda x: x / list_sum(raw)) AS probability FROM (SELECT vec_id, label, list_transform(embedding[1:5], lambda x: round(abs(x::DOUBLE), 3) + 0.001::DOUBLE) AS raw FROM embeddings))"
_TOP = "(len(list_filter(probability, lambda p, i: p > probability[label + 1] OR (p = probability[label + 1] AND i - 1 > label))) < {n})"


@query(f"SELECT vec_id, {_TOP.format(n=1)} AS top1, {_TOP.format(n=3)} AS top3, {_TOP.format(n=5)} AS top5 FROM {_SCORES}", views=False)
def topn_membership(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = _scores(spark, sf_dir)
    return s.select("vec_id", *[features.in_top(F.col("probability"), F.col("label"), n).alias(f"top{n}") for n in (1, 3, 5)])


@query(f"SELECT round(avg({_TOP.format(n=1)}::INT), 9) AS top1, round(avg({_TOP.format(n=3)}::INT), 9) AS top3, round(avg({_TOP.format(n=5)}::INT), 9) AS top5, round(sum(ln(probability[label + 1])), 6) AS loglikelihood, round(exp(-avg(ln(probability[label + 1]))), 8) AS perplexity FROM {_SCORES}", views=False)
def classifier_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = features.metrics(_scores(spark, sf_dir))
    return m.select(*[F.round(c, d).alias(c) for c, d in (("top1", 9), ("top3", 9), ("top5", 9), ("loglikelihood", 6), ("perplexity", 8))])


@query(f"SELECT round(avg({_TOP.format(n=1)}::INT), 9) AS accuracy, round(avg(-ln(probability[label + 1])), 8) AS cross_entropy FROM {_SCORES} WHERE vec_id % 10 >= 8", views=False)
def masked_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = features.masked_accuracy(_scores(spark, sf_dir).withColumn("mask", F.col("vec_id") % 10 >= 8))
    return m.select(F.round("accuracy", 9).alias("accuracy"), F.round("cross_entropy", 8).alias("cross_entropy"))


@query()
def ablation_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), (F.col("label") % 5).alias("label"), (F.col("vec_id") % 10 < 8).alias("train"), F.slice("embedding", 1, 32).alias("head"), F.slice("embedding", 33, 32).alias("tail"))
    return features.ablation(e, ["head", "tail"])


@query("SELECT doc_id AS id, coalesce(embedding, list_transform(range(64), lambda i: 0.0::FLOAT)) AS embedding FROM documents LEFT JOIN embeddings ON doc_id = vec_id", views=False)
def embedding_fill_zeros(spark: SparkSession, sf_dir: str) -> DataFrame:
    d, e = read(spark, sf_dir, "documents").select(F.col("doc_id").alias("id")), read(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), "embedding")
    return features.fill_zeros(d, e, 64)


@query("SELECT a.vec_id AS id, list_concat(a.embedding, list_reverse(b.embedding)) AS embedding FROM embeddings a JOIN embeddings b USING (vec_id)", views=False)
def embedding_concat(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), "embedding")
    return features.concat_features(e, e.select("id", F.reverse("embedding").alias("embedding")))


@query("SELECT l_orderkey AS i, l_linenumber AS j, round(CASE WHEN s = 0 THEN 0 ELSE v / s END, 9) AS value FROM (SELECT l_orderkey, l_linenumber, l_quantity AS v, sum(l_quantity) OVER (PARTITION BY l_orderkey) AS s FROM lineitem)", views=False)
def features_row_normalised(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = read(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("i"), F.col("l_linenumber").alias("j"), F.col("l_quantity").alias("value"))
    return features.row_normalised(m).select("i", "j", F.round("value", 9).alias("value"))


@query("SELECT p_partkey AS i, p_size, p_partkey IN (SELECT l_partkey FROM lineitem WHERE l_quantity >= 50) AS mask FROM part", views=False)
def sample_mask(spark: SparkSession, sf_dir: str) -> DataFrame:
    big = read(spark, sf_dir, "lineitem").where("l_quantity >= 50").select(F.col("l_partkey").alias("i"))
    return features.masked(read(spark, sf_dir, "part").select(F.col("p_partkey").alias("i"), "p_size"), big)


@query("SELECT p_partkey AS i, CASE WHEN p_size = 1 THEN 'test' WHEN row_number() OVER (PARTITION BY p_size = 1 ORDER BY p_partkey) <= 100 THEN 'train' WHEN row_number() OVER (PARTITION BY p_size = 1 ORDER BY p_partkey) <= 150 THEN 'valid' ELSE 'none' END AS split FROM part", views=False)
def split_by_place(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read(spark, sf_dir, "part").select(F.col("p_partkey").alias("i"), "p_size")
    return features.split_by_place(p.select("i"), 100, 50, p.where("p_size = 1"))


def _network(spark: SparkSession, sf_dir: str, with_graph: bool) -> DataFrame:
    n = views.nodes(spark, sf_dir)
    if with_graph:
        numbers, n, e = graph.by_number(*_graph(spark, sf_dir, False))
        matrix = features.by_row(features.adjacency_normalised(n, e, repeats=False), e, "matrix")
    rows = n.select("id", F.transform(F.sequence(F.lit(0), F.lit(4)), lambda k: (k == F.col("label")).cast("double")).alias("x"), "label", F.when(F.col("train"), "train").otherwise("valid").alias("split"))
    model = networks.Network(networks.Settings(epochs=3, rate=0.1))
    return _named(model.fit(rows, matrix, 5).predict(rows, matrix), numbers) if with_graph else model.fit(rows, None, 5).predict(rows)


@query()
def network_graph_convolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Probabilities of a graph convolution network after three epochs over all nodes."""
    return _network(spark, sf_dir, True)


@query()
def network_perceptron(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _network(spark, sf_dir, False)


# --- text ------------------------------------------------------------------------------------------------------------

_WORDS = r"len(list_filter(regexp_split_to_array(text, '\s+'), lambda w: w <> ''))"


@query(f"SELECT doc_id, round(length(text) / ({_WORDS} + 1), 9) AS word_length FROM documents", views=False)
def text_word_length(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "documents").select("doc_id", F.round(text.average_word_length(F.col("text")), 9).alias("word_length"))


@query(f"SELECT doc_id, length(t) / (len(list_filter(regexp_split_to_array(t, '\\s+'), lambda w: w <> '')) + 1) <= 45 AS passes FROM (SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN replace(text, ' ', '') ELSE text END AS t FROM documents)", views=False)
def text_quality_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = F.when(F.col("doc_id") % 2 == 0, F.replace(F.col("text"), F.lit(" "), F.lit(""))).otherwise(F.col("text"))
    return read(spark, sf_dir, "documents").select("doc_id", text.passes_gate(t).alias("passes"))


_ODD = "concat('ﬁn æther “a” ‘b’ —·', chr(160), '(cid:12) ..... ', text)"
_FIXED = "(SELECT doc_id, " + "replace(" * len(text.MANY) + _ODD + "".join(f", '{a}', '{b}')" for a, b in text.MANY.items()) + " AS t FROM documents)"
_PLAIN = "translate(regexp_replace(regexp_replace(t, '([\\p{L}\\p{N}_])ß', '\\1ss', 'g'), '([\\p{L}\\p{N}_])ß', '\\1ss', 'g'), " + _quoted("".join(text.PLAIN)) + ", " + _quoted("".join(text.PLAIN.values())) + ")"


def _odd(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "documents").select("doc_id", F.concat(F.lit("ﬁn æther “a” ‘b’ —·\xa0(cid:12) ..... "), F.col("text")).alias("text"))


@query(f"SELECT doc_id, md5({_PLAIN}) AS text_md5 FROM {_FIXED}", views=False)
def text_fix_unicode_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _odd(spark, sf_dir).select("doc_id", F.md5(text.fix_rules(F.col("text"))).alias("text_md5"))


@query(f"SELECT doc_id, md5(nfc_normalize({_PLAIN})) AS text_md5 FROM {_FIXED}", views=False)
def text_fix_unicode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _odd(spark, sf_dir).select("doc_id", F.md5(text.fix_unicode(F.col("text"))).alias("text_md5"))


@query(f"SELECT doc_id, md5(regexp_replace({_ODD}, {_quoted(text.JUNK)}, '', 'g')) AS text_md5 FROM documents", views=False)
def text_junk_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _odd(spark, sf_dir).select("doc_id", F.md5(text.without_junk(F.col("text"))).alias("text_md5"))


#: Banners by a document's id modulo their number; the last is none.
_STAMPS = ["arXiv:1203.0023v2 [math.RT] 29 Jan 2012", "a r X i v : 1 2 0 3 . 0 0 2 3 [ cs . L G ] 1 Feb 19", "arXiv:0903123V1 [hep-th] 3 Mar 99", "2102 naJ 92 ]TR.htam[ 2v3200.3021:viXra", "arXiv 1203.0023 [none] 2012"]
_STRIP = "regexp_replace({}, '^\\s+|\\s+$', '', 'g')"


@query("SELECT doc_id, md5(CASE WHEN doc_id % 5 = 4 THEN t ELSE " + _STRIP.format("substr(text, 1, 5)") + " || ' ' || " + _STRIP.format("substr(text, 6, 1000 - 5 - length(s))") + " || substr(t, 1001) END) AS text_md5 FROM (SELECT doc_id, text, s, substr(text, 1, 5) || s || substr(text, 6) AS t FROM (SELECT doc_id, '(x) ' || chr(10) || ' ' || text AS text, ([" + ", ".join(map(_quoted, _STAMPS)) + "])[(doc_id % 5 + 1)::INT] AS s FROM documents))", views=False)
def text_remove_stamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    stamp = F.get(F.array(*map(F.lit, _STAMPS)), (F.col("doc_id") % 5).cast("int"))
    made = F.concat(F.lit("(x) \n"), stamp, F.lit(" "), "text")
    return read(spark, sf_dir, "documents").select("doc_id", F.md5(text.remove_stamp(made)).alias("text_md5"))


@query("SELECT page_id, url, row_number() OVER (ORDER BY list_transform(regexp_extract_all(url, '\\d+'), lambda d: regexp_replace(d, '^0+(\\d)', '\\1')), url, page_id)::INT AS position FROM pages", views=False)
def file_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read(spark, sf_dir, "pages")
    return positions(p.select("page_id", "url"), *text.numeric_order(F.col("url")), "page_id")


#: Marked-up names by a customer's key modulo their number, # standing for the key, and what they are without markup.
_TEX = [
    (r"Bal\'azs # \O{}re \L{}ukasz {\ss} \~{n}", "Balázs # Øre Łukasz ß ñ"),
    (r"G\"odel \"{{o}} # {\'e}", "Gödel ö # {é}"),
    (r"Erd\H{o}s \v{s}\c{c}\c{x} \'b #", "Erdős šçcx b #"),
    (r"$\alpha_1$ \alpha1 \upsilon \Omega{}# \copyright x", r"$α_1$ \alpha1 \upsilon Ω# ©x"),
    (r"\t{o} \unknown{#} \'{ab} } { \AA\ ng", r"o \unknown{#} \'{ab} } { Å ng"),
    ("plain # name", "plain # name"),
]


@query("SELECT c_custkey, CASE c_custkey % " + str(len(_TEX)) + " " + " ".join(f"WHEN {t} THEN replace({_quoted(plain)}, '#', c_custkey::VARCHAR)" for t, (_, plain) in enumerate(_TEX)) + " END AS name FROM customer", views=False)
def tex_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = F.replace(F.get(F.array(*[F.lit(t) for t, _ in _TEX]), (F.col("c_custkey") % len(_TEX)).cast("int")), F.lit("#"), F.col("c_custkey").cast("string"))
    return read(spark, sf_dir, "customer").select("c_custkey", tex.tex_to_utf(made).alias("name"))


def _author_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey").cast("string")
    plain = F.concat(F.lit("A. B. Name"), k, F.lit(", Clara van der Surname"), k, F.lit(" and D. Other"), F.col("c_nationkey").cast("string"))
    return read(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", plain.alias("plain"), F.concat(plain, F.lit(" (1), E. Last (2) ((1) Lab "), k, F.lit("; (2) Elsewhere)")).alias("full"))


#: Author lines by a customer's key modulo their number, # standing for the key, and the authors in them: surname, first
#: names, suffix, affiliations.
_AUTHORS = [
    ("A. B. Name# (1), Clara van der Surname# and D. Other (2) ((1) Lab #, Town.; (2) Elsewhere)", [("Name#", "A. B.", "", ["Lab #, Town.;"]), ("van der Surname#", "Clara", "", ["Elsewhere"]), ("Other", "D.", "", ["Elsewhere"])]),
    ("BIG# Collaboration: A. One#, B. Two (Lab (x) of #)", [("BIG# Collaboration", "", "", []), ("One#", "A.", "", ["Lab"]), ("Two", "B.", "", ["Lab"])]),
    ("X. Y. Name#, Jr, Someone#,, E.-F. Third &  G. Fourth#, et al.", [("Name#,", "X. Y.", "Jr", []), ("Someone#", "", "", []), ("Third", "E. -F.", "", []), ("Fourth#", "G.", "", [])]),
    (r"J\'er\^ome de la Cruz# (A & B, #), S\o ren Ek III", [("de la Cruz#", "Jérôme", "", ["A & B, #"]), ("Ek", "Søren", "III", [])]),
    ("Plato#", [("Plato#", "", "", [])]),
    ("H. Name# (1,2,9), I. Last ((1) First #; (2) Second)", [("Name#", "H.", "", ["First #;", "Second"]), ("Last", "I.", "", [])]),
]


def _sql_of(v) -> str:
    if isinstance(v, list):
        return "[" + ", ".join(map(_sql_of, v)) + "]::VARCHAR[]"
    return "replace(" + _quoted(v) + ", '#', c_custkey::VARCHAR)"


_AUTHORS_SQL = " UNION ALL ".join(f"SELECT c_custkey, {i}::INT AS place, {_sql_of(key)} AS keyname, {_sql_of(first)} AS firstnames, {_sql_of(suffix)} AS suffix, {_sql_of(said)} AS affiliations FROM customer WHERE c_custkey % {len(_AUTHORS)} = {t}" for t, (_, people) in enumerate(_AUTHORS) for i, (key, first, suffix, said) in enumerate(people))


@query(_AUTHORS_SQL, views=False)
def author_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = F.replace(F.get(F.array(*[F.lit(t) for t, _ in _AUTHORS]), (F.col("c_custkey") % len(_AUTHORS)).cast("int")), F.lit("#"), F.col("c_custkey").cast("string"))
    p = read(spark, sf_dir, "customer").select("c_custkey", authors.parse_authors(line).alias("p"))
    return p.where("p.error IS NULL").select("c_custkey", F.posexplode("p.authors").alias("place", "a")).select("c_custkey", "place", "a.*")


@query("SELECT c_custkey, 'Name' || c_custkey || ', A. B.; van der Surname' || c_custkey || ', Clara; Other' || c_nationkey || ', D.' AS line FROM customer", views=False)
def author_line(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _author_lines(spark, sf_dir).select("c_custkey", authors.author_line(authors.parse_authors("plain")["authors"]).alias("line"))


@query("SELECT c_custkey, unnest(['Name' || c_custkey, 'van der Surname' || c_custkey, 'Other' || c_nationkey, 'Last']) AS keyname, unnest(['Lab ' || c_custkey || ';', 'Lab ' || c_custkey || ';', 'Lab ' || c_custkey || ';', 'Elsewhere']) AS affiliation FROM customer", views=False)
def author_backprop(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _author_lines(spark, sf_dir).select("c_custkey", F.explode(authors.parse_authors("full")["authors"]).alias("a"))
    return p.select("c_custkey", "a.keyname", F.get("a.affiliations", F.lit(0)).alias("affiliation"))


# --- metadata --------------------------------------------------------------------------------------------------------


def _pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Harvested pages of one record an order, ten a page."""
    o = read(spark, sf_dir, "orders")
    k = F.col("o_orderkey").cast("string")
    record = F.concat(F.lit('<record><metadata><arXivRaw xmlns="http://arxiv.org/OAI/arXivRaw/"><id>'), views.article_id(F.col("o_orderkey")), F.lit("</id><authors>A. One</authors><title>T "), k, F.lit("</title><categories>"), F.col("o_orderpriority"), F.lit(' x</categories><version version="v1"><date>'), F.col("o_orderdate").cast("date").cast("string"), F.lit('</date></version><version version="v2"><date>d2</date></version></arXivRaw></metadata></record>'))
    body = o.groupBy(F.floor(F.col("o_orderkey") / 10).cast("int").alias("page")).agg(F.array_join(F.array_sort(F.collect_list(record)), "").alias("b"))
    return body.select("page", F.concat(F.lit('<OAI-PMH xmlns="http://www.openarchives.org/OAI/2.0/"><ListRecords>'), "b", F.lit("<resumptionToken>tok|"), F.col("page").cast("string"), F.lit("</resumptionToken></ListRecords></OAI-PMH>")).alias("xml"))


@query(f"SELECT {SQL_ID('o_orderkey')} AS id, 'A. One' AS authors, 'T ' || o_orderkey AS title, NULL::VARCHAR AS abstract, [o_orderpriority || ' x'] AS categories, ['v1', 'v2'] AS versions, [o_orderdate::DATE::VARCHAR, 'd2'] AS versions_dates FROM orders", views=False)
def meta_parse_xml(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metadata.records(_pages(spark, sf_dir)).select("id", "authors", "title", "abstract", "categories", "versions", "versions_dates")


@query("SELECT DISTINCT 'tok|' || (o_orderkey // 10) AS token FROM orders", views=False)
def meta_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metadata.tokens(_pages(spark, sf_dir))


def _abstracts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "lang", F.col("text").alias("abstract"))


@query("SELECT doc_id AS id, lang, md5(text) AS abstract_md5 FROM documents", views=False)
def meta_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metadata.hash_abstracts(_abstracts(spark, sf_dir))


@query("SELECT coalesce(bool_and(md5(text) = md5(CASE WHEN doc_id = 7 THEN 'x' ELSE text END)), true) AS valid FROM documents", views=False)
def meta_validate_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = _abstracts(spark, sf_dir)
    changed = d.withColumn("abstract", F.when(F.col("id") == 7, F.lit("x")).otherwise(F.col("abstract")))
    return metadata.hashes_valid(d, metadata.hash_abstracts(changed))


@query("SELECT user_id, event_id, event_type FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1", views=False)
def meta_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metadata.latest(read(spark, sf_dir, "events").select("user_id", "event_id", "event_type"), "user_id", "event_id")


@query("SELECT doc_id AS id, lang FROM documents WHERE lang IN ('de', 'fr') AND length(text) > 100", views=False)
def meta_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metadata.slice_by(_abstracts(spark, sf_dir), lambda d: d.where("lang IN ('de', 'fr') AND length(abstract) > 100")).select("id", "lang")


@query("SELECT doc_id AS id, lang FROM documents JOIN (SELECT DISTINCT vec_id FROM embeddings) ON doc_id = vec_id ORDER BY doc_id LIMIT 50", views=False)
def meta_with_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = read(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "lang")
    return corpora.with_text(d, read(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id")), 50)


_UNIFORM = "(('0x' || substr(md5('{seed}:' || doc_id), 1, 12))::BIGINT::DOUBLE / 281474976710656)"


@query(f"SELECT doc_id AS id, lang, {_UNIFORM.format(seed=0)} < 0.9 AS train FROM (SELECT *, unnest(range(" + " + ".join(f"(u >= {math.exp(-0.5) * sum(0.5**j / math.factorial(j) for j in range(k + 1))!r}::DOUBLE)::INT" for k in range(12)) + f")) FROM (SELECT *, {_UNIFORM.format(seed=1)} AS u FROM documents))", views=False)
def split_and_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = read(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "lang")
    return corpora.sampled(corpora.shuffled_split(d, 0.9), 0.5, 1)


_BAG = """(SELECT doc_id, k, s, sqrt(sum(s * s) OVER (PARTITION BY doc_id)) AS norm FROM (SELECT doc_id, (h // 2) % 64 AS k, sum(CASE WHEN h % 2 = 1 THEN 1 ELSE -1 END)::DOUBLE AS s FROM (
  SELECT doc_id, ('0x' || substr(md5(w), 1, 15))::BIGINT AS h FROM (SELECT doc_id, unnest(regexp_split_to_array(lower(text), '\\s+')) AS w FROM documents) WHERE w <> '') GROUP BY 1, 2))"""


@query(f"SELECT doc_id::VARCHAR AS id, k::INT AS place, round((s / norm)::FLOAT::DOUBLE, 5) AS x FROM {_BAG} WHERE s <> 0", views=False)
def text_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = extraction.embed(read(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("id"), "text"))
    return e.select("id", F.posexplode("embedding").alias("place", "x")).where("x <> 0").select("id", "place", F.round(F.col("x").cast("double"), 5).alias("x"))


@query("SELECT doc_id AS id, pos::INT AS position, tok AS token FROM (SELECT doc_id, unnest(l) AS tok, generate_subscripts(l, 1) - 1 AS pos FROM (SELECT doc_id, [doc_id * 3, doc_id + 1] AS l FROM documents))", views=False)
def token_coordinates(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = read(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), F.array(F.col("doc_id") * 3, F.col("doc_id") + 1).alias("ids"))
    return extraction.token_triples(d)


@query("SELECT o_orderkey AS id FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)", views=False)
def text_pending(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extraction.pending(read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id")), read(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("id")))


@query("SELECT i::INT AS i, CASE WHEN (i - lo) % 3 = 0 THEN [i::DOUBLE] ELSE [0.0::DOUBLE] END AS features FROM (SELECT unnest(range(lo, hi + 1)) AS i, lo FROM (SELECT min(p_partkey) AS lo, min(p_partkey) + 3 * ((max(p_partkey) - min(p_partkey)) // 3) AS hi FROM part))", views=False)
def padded_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read(spark, sf_dir, "part").select(F.col("p_partkey").cast("int").alias("i"), F.array(F.col("p_partkey").cast("double")).alias("features"))
    return corpora.padded_rows(p.where("i % 3 = 0"), 1)


# --- bulk archives ---------------------------------------------------------------------------------------------------


def _index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("tar"), F.col("l_orderkey").alias("pdf"))


def _done(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "orders").where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("pdf"))


_MISSING = "(SELECT l_suppkey AS tar, list_sort(list(DISTINCT l_orderkey)) AS pdfs FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F') GROUP BY 1)"


@query("SELECT tar, list_sort(list(pdf)) AS pdfs FROM (SELECT l_orderkey AS pdf, max(l_suppkey) AS tar FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F') GROUP BY 1) GROUP BY tar", views=False)
def tar_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.wanted_by_tar(_done(spark, sf_dir), _index(spark, sf_dir))


@query(f"SELECT * FROM {_MISSING}", views=False)
def tar_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.missing(_index(spark, sf_dir), _done(spark, sf_dir))


@query(f"SELECT tar, len(pdfs)::INT AS backlog, row_number() OVER (ORDER BY len(pdfs) DESC, tar DESC)::INT AS position FROM {_MISSING}", views=False)
def tar_rerun_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.rerun_order(manifest.missing(_index(spark, sf_dir), _done(spark, sf_dir)))


@query("WITH d AS (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F') SELECT l_suppkey AS tar, min(l_orderkey) IN (SELECT o_orderkey FROM d) AND max(l_orderkey) IN (SELECT o_orderkey FROM d) AS processed FROM lineitem GROUP BY 1", views=False)
def tar_processed(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = _index(spark, sf_dir).groupBy("tar").agg(F.min("pdf").alias("first_item"), F.max("pdf").alias("last_item"))
    return manifest.processed(m, _done(spark, sf_dir))


@query("SELECT doc_id AS name FROM documents WHERE doc_id % 97 = 0", views=False)
def checksum_mismatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = read(spark, sf_dir, "documents").select(F.col("doc_id").alias("name"), F.encode("text", "UTF-8").alias("content"))
    told = d.select("name", F.md5(F.when(F.col("name") % 97 == 0, F.concat("content", F.lit("!").cast("binary"))).otherwise(F.col("content"))).alias("md5sum"))
    return manifest.checksum_mismatches(d, told)


@query("SELECT 'a' || c_custkey || '.tar' AS filename, md5(c_name) AS md5sum, c_custkey::VARCHAR AS first_item, (c_custkey + 9)::VARCHAR AS last_item FROM customer", views=False)
def manifest_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey").cast("string")
    one = F.concat(F.lit("<file><filename>a"), k, F.lit(".tar</filename><md5sum>"), F.md5("c_name"), F.lit("</md5sum><first_item>"), k, F.lit("</first_item><last_item>"), (F.col("c_custkey") + 9).cast("string"), F.lit("</last_item><size>1</size></file>"))
    xml = read(spark, sf_dir, "customer").groupBy(F.floor(F.col("c_custkey") / 50)).agg(F.concat(F.lit("<manifest>"), F.array_join(F.collect_list(one), ""), F.lit("</manifest>")).alias("xml"))
    return manifest.parse(xml)


def _members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text files of documents, fifty ids an archive; files whose id is a multiple of nine aren't text."""
    d = read(spark, sf_dir, "documents")
    content = F.when(F.col("doc_id") % 9 == 0, F.unhex(F.lit("FFFE"))).otherwise(F.encode("text", "UTF-8"))
    return d.select(F.concat(F.lit("t"), F.floor(F.col("doc_id") / 50).cast("string")).alias("tar"), F.concat(F.lit("1501."), F.lpad(F.col("doc_id").cast("string"), 6, "0"), F.lit(".txt")).alias("member"), content.alias("content"))


_TEXT_ID = "'1501.' || lpad(doc_id::VARCHAR, 6, '0')"


@query(f"SELECT 't' || (doc_id // 50) AS tar, {_TEXT_ID} || '.txt' AS member, CASE WHEN doc_id % 9 = 0 THEN md5(unhex('FFFE')) ELSE md5(text) END AS content_md5, NULL::VARCHAR AS error FROM documents", views=False)
def archive_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archives that tasks write to the shared folder, indexed and read again by byte ranges of 64 KB."""
    path = _at(spark, "tars")
    tars.write(_members(spark, sf_dir), path)
    m = tars.contents(tars.members(spark, path), at_once=64 << 10)
    return m.select("tar", "member", F.md5("content").alias("content_md5"), "error")


@query(f"SELECT {_TEXT_ID} AS id, CASE WHEN doc_id % 9 <> 0 THEN md5(text) END AS text_md5, doc_id % 9 = 0 AS failed FROM documents WHERE doc_id % 3 <> 1", views=False)
def archive_resumed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An extraction job over archives that ran for a part of them first and then for the rest; a second extractor is
    tried where the first fails, and neither may take long."""

    def refuses(content: bytes) -> str:
        raise ValueError("not my kind of file")

    m, path = _members(spark, sf_dir), f"{shared_dir(spark)}/paperlake/texts-{uuid.uuid4().hex}"
    packed = save(archives.packed(m), "archives")
    index = m.where("int(substr(member, 6, 6)) % 3 <> 1").select("tar", F.col("member").alias("pdf"))
    for part in (packed.where("tar IN ('t0', 't1')"), packed):
        archives.process(part, index, path, [refuses, lambda b: b.decode("utf-8")], most=1e9)
    return spark.read.parquet(path).select("id", F.md5("text").alias("text_md5"), F.col("error").isNotNull().alias("failed"))


def _at(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/paperlake/{name}-{uuid.uuid4().hex}"


@query(f"SELECT doc_id::VARCHAR AS id, k::INT AS place, round((s / norm)::FLOAT::DOUBLE, 5) AS x, 'hashed_bag' AS encoder FROM {_BAG} WHERE s <> 0", views=False)
def store_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _at(spark, "embeddings")
    stores.write_embeddings(read(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("id"), "text"), path, extraction.embed, {"encoder": "hashed_bag"})
    headers, e = stores.read_embeddings(spark, path)
    return e.select("id", F.posexplode("embedding").alias("place", "x")).where("x <> 0").select("id", "place", F.round(F.col("x").cast("double"), 5).alias("x"), F.lit(headers["encoder"]).alias("encoder"))


@query("SELECT id, list_sort(list(ref)) AS refs FROM refs GROUP BY id")
def store_citations(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _at(spark, "citations")
    stores.write_citations(views.citations(spark, sf_dir), path)
    return stores.read_citations(spark, path).select("id", F.array_sort("refs").alias("refs"))


@query(_AUTHORS_SQL, views=False)
def store_authors(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _at(spark, "authors")
    stores.write_json(author_parse(spark, sf_dir), path)
    return stores.read_json(spark, path, "c_custkey bigint, place int, keyname string, firstnames string, suffix string, affiliations array<string>")


@query(ORACLES["classifier_metrics"], views=False)
def store_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _at(spark, "results")
    stores.write_json(classifier_metrics(spark, sf_dir), path)
    return stores.read_json(spark, path, "top1 double, top3 double, top5 double, loglikelihood double, perplexity double")


@query(f"SELECT * FROM {_DEGREES}")
def store_degrees(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _at(spark, "degrees")
    stores.write_lines(graph.degrees(*_graph(spark, sf_dir)), path)
    return stores.read_lines(spark, path, id="string", in_degree="bigint", out_degree="bigint")


@query(ORACLES["meta_slice"], views=False)
def store_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _at(spark, "slice")
    stores.write_json(meta_slice(spark, sf_dir), path)
    return stores.read_json(spark, path, "id bigint, lang string")


@query("SELECT id, label FROM nodes WHERE NOT train")
def store_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _at(spark, "split")
    stores.write_split(views.nodes(spark, sf_dir).select("id", "label", F.when(F.col("train"), "train").otherwise("test").alias("split")), path)
    return stores.read_split(spark, path, "test")
