"""Queries of the matrix operators, each with its SQL."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortloom.operators import annotate, design, enrich, matrix, modules, normalize
from cohortloom.operators.correlate import correlate, pairwise
from cohortloom.session import cut_lineage, table

QUERIES: dict = {}
ORACLES: dict[str, str] = {}

#: Neighbours for the modules of the test matrix: with the usual number all its genes are one component.
MODULE_NEIGHBOURS = 3
VECTOR_SIZE = 64


def query(sql: str | None = None):
    """Register a query, with the SQL that gives the same rows."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def _counts(spark: SparkSession, sf: str) -> DataFrame:
    """Counts of brands (genes) by suppliers (samples)."""
    items, parts = table(spark, sf, "lineitem"), table(spark, sf, "part")
    joined = items.select("l_partkey", "l_suppkey", "l_quantity").join(parts.select(F.col("p_partkey").alias("l_partkey"), "p_brand"), "l_partkey")
    return joined.groupBy(F.col("p_brand").alias("gene_id"), F.col("l_suppkey").alias("sample_id")).agg(F.sum("l_quantity").alias("value"))


def _samples(spark: SparkSession, sf: str) -> DataFrame:
    s, n, r = table(spark, sf, "supplier"), table(spark, sf, "nation"), table(spark, sf, "region")
    return s.join(n, s.s_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey).select(F.col("s_suppkey").alias("sample_id"), F.col("r_name").alias("batch"), F.col("s_acctbal").alias("age"))


def _count_vectors(spark: SparkSession, sf: str) -> tuple[DataFrame, list]:
    long = cut_lineage(_counts(spark, sf))  # read for the samples and for the vectors
    samples = matrix.sample_order(long)
    return matrix.to_vectors(long, samples, missing=0.0), samples


def _ordered(vectors: DataFrame) -> DataFrame:
    return vectors.join(matrix.with_order(vectors), "gene_id")


def _embedding_vectors(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "embeddings").select(F.col("vec_id").alias("gene_id"), F.transform("embedding", lambda x: x.cast("double")).alias("values"))
    return _ordered(rows)


def _embedding_long(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "embeddings").select(F.col("vec_id").alias("gene_id"), F.posexplode("embedding").alias("sample_id", "v"))
    return rows.select("gene_id", "sample_id", F.col("v").cast("double").alias("value"))


_COUNTS = """
cells AS (SELECT p_brand AS gene_id, l_suppkey AS sample_id, sum(l_quantity) AS value FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY ALL),
mx AS (SELECT g.gene_id, s.sample_id, coalesce(c.value, 0) AS value FROM (SELECT DISTINCT gene_id FROM cells) g CROSS JOIN (SELECT DISTINCT sample_id FROM cells) s LEFT JOIN cells c ON g.gene_id = c.gene_id AND s.sample_id = c.sample_id),
samples AS (SELECT s_suppkey AS sample_id, r_name AS batch, s_acctbal AS age FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)
"""
_VECTORS = "mx AS (SELECT vec_id AS gene_id, unnest(range(64)) AS sample_id, CAST(unnest(embedding) AS DOUBLE) AS value FROM embeddings)"
_RANKED = "rk AS (SELECT gene_id, sample_id, rank() OVER (PARTITION BY gene_id ORDER BY value) + (count(*) OVER (PARTITION BY gene_id, value) - 1) / 2.0 AS value FROM mx)"
_UNIT = """
lists AS (SELECT gene_id, list(value ORDER BY sample_id) AS v FROM {source} GROUP BY gene_id),
cent AS (SELECT gene_id, list_transform(v, lambda x: x - list_avg(v)) AS c FROM lists),
unit AS (SELECT gene_id, row_number() OVER (ORDER BY gene_id) AS ord, list_transform(c, lambda x: x / sqrt(list_inner_product(c, c))) AS u FROM cent WHERE list_inner_product(c, c) > 1e-18),
prs AS (SELECT a.gene_id AS gene_a, b.gene_id AS gene_b, a.ord AS ord_a, b.ord AS ord_b, round(list_inner_product(a.u, b.u), 9) AS r FROM unit a JOIN unit b ON a.ord < b.ord),
both_ways AS (SELECT * FROM prs UNION ALL SELECT gene_b, gene_a, ord_b, ord_a, r FROM prs)
"""


def _r6(df: DataFrame, *names: str) -> DataFrame:
    """Figures to six places, without a negative zero."""
    return df.withColumns({n: F.round(n, 6) + F.lit(0.0) for n in names})


# --- genes ----------------------------------------------------------------------------------------


@query(f"WITH {_COUNTS} SELECT gene_id, row_number() OVER (ORDER BY v DESC, gene_id) AS place FROM (SELECT gene_id, var_pop(value) AS v FROM mx GROUP BY 1) ORDER BY v DESC, gene_id LIMIT 10")
def geneset_topvar(spark: SparkSession, sf: str) -> DataFrame:
    return matrix.select_genes(_counts(spark, sf), "topvar:10")


@query(f"WITH {_COUNTS} SELECT gene_id, row_number() OVER (ORDER BY gene_id) AS place FROM (SELECT gene_id FROM mx GROUP BY 1 HAVING avg(value) > (SELECT 0.5 * max(l_quantity) FROM lineitem))")
def geneset_mean_gt(spark: SparkSession, sf: str) -> DataFrame:
    half = table(spark, sf, "lineitem").agg((F.max("l_quantity") * 0.5).alias("m")).first()["m"]
    return matrix.select_genes(_counts(spark, sf), f"mean_gt:{half}")


@query(f"WITH {_COUNTS} SELECT gene_id, row_number() OVER (ORDER BY gene_id) AS place FROM (SELECT DISTINCT gene_id FROM mx WHERE gene_id IN (SELECT p_brand FROM part WHERE p_size = 7))")
def geneset_genes(spark: SparkSession, sf: str) -> DataFrame:
    listed = table(spark, sf, "part").where("p_size = 7").select(F.concat(F.lit(" "), "p_brand", F.lit(" ")).alias("gene_id"))
    return matrix.select_genes(_counts(spark, sf), "genes:listed", listed)


@query(f"WITH {_COUNTS} SELECT gene_id, row_number() OVER (ORDER BY gene_id) AS place FROM (SELECT DISTINCT gene_id FROM mx WHERE regexp_matches(gene_id, '[13]$'))")
def geneset_regex(spark: SparkSession, sf: str) -> DataFrame:
    return matrix.select_genes(_counts(spark, sf), "regex:[13]$")


@query(f"WITH {_VECTORS} SELECT gene_id, sample_id, value FROM mx")
def matrix_long(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "embeddings").select(F.col("vec_id").alias("gene_id"), F.transform("embedding", lambda x: x.cast("double")).alias("values"))
    return matrix.to_long(rows, list(range(VECTOR_SIZE)))


@query("SELECT p_brand AS gene_id, sum(l_quantity) FILTER (l_returnflag = 'A') AS A, sum(l_quantity) FILTER (l_returnflag = 'N') AS N, sum(l_quantity) FILTER (l_returnflag = 'R') AS R FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1")
def matrix_dense(spark: SparkSession, sf: str) -> DataFrame:
    items, parts = table(spark, sf, "lineitem"), table(spark, sf, "part")
    long = items.join(parts, items.l_partkey == parts.p_partkey).select(F.col("p_brand").alias("gene_id"), F.col("l_returnflag").alias("sample_id"), F.col("l_quantity").alias("value"))
    return matrix.dense(long)


@query(f"WITH {_COUNTS}, {_RANKED} SELECT gene_id, sample_id, value AS rank FROM rk")
def average_ranks(spark: SparkSession, sf: str) -> DataFrame:
    vectors, samples = _count_vectors(spark, sf)
    return matrix.average_rank(matrix.to_long(vectors, samples), ["gene_id"], "value").select("gene_id", "sample_id", "rank")


# --- residuals ------------------------------------------------------------------------------------


def _adjusted(spark: SparkSession, sf: str, formula: str) -> DataFrame:
    vectors, samples = _count_vectors(spark, sf)
    return _r6(matrix.to_long(design.adjust(vectors, _samples(spark, sf), samples, formula), samples), "value")


_FACTOR = "res AS (SELECT gene_id, sample_id, value - avg(value) OVER (PARTITION BY gene_id, batch) AS value FROM mx JOIN samples USING (sample_id))"
_NUMERIC = """
fit AS (SELECT gene_id, avg(value) AS my, avg(age) AS mx_, covar_pop(value, age) / var_pop(age) AS b FROM mx JOIN samples USING (sample_id) GROUP BY 1),
res AS (SELECT m.gene_id, m.sample_id, m.value - f.my - f.b * (s.age - f.mx_) AS value FROM mx m JOIN samples s USING (sample_id) JOIN fit f USING (gene_id))
"""
_BOTH = """
wthn AS (SELECT gene_id, sample_id, value - avg(value) OVER w AS y, age - avg(age) OVER w AS a FROM mx JOIN samples USING (sample_id) WINDOW w AS (PARTITION BY gene_id, batch)),
fit AS (SELECT gene_id, sum(y * a) / sum(a * a) AS b FROM wthn GROUP BY 1),
res AS (SELECT gene_id, sample_id, y - b * a AS value FROM wthn JOIN fit USING (gene_id))
"""
_RES = " SELECT gene_id, sample_id, round(value, 6) + 0.0 AS value FROM res"


@query(f"WITH {_COUNTS}, {_FACTOR}" + _RES)
def residualize_factor(spark: SparkSession, sf: str) -> DataFrame:
    return _adjusted(spark, sf, "~ batch")


@query(f"WITH {_COUNTS}, {_NUMERIC}" + _RES)
def residualize_numeric(spark: SparkSession, sf: str) -> DataFrame:
    return _adjusted(spark, sf, "~ age")


@query(f"WITH {_COUNTS}, {_BOTH}" + _RES)
def residualize_factor_numeric(spark: SparkSession, sf: str) -> DataFrame:
    return _adjusted(spark, sf, "~ batch + age")


# --- correlation ----------------------------------------------------------------------------------


def _edges(df: DataFrame) -> DataFrame:
    return _r6(df, "r").select("gene_a", "gene_b", "r")


@query(f"WITH {_VECTORS}, {_UNIT.format(source='mx')} SELECT gene_a, gene_b, round(r, 6) + 0.0 AS r FROM both_ways QUALIFY row_number() OVER (PARTITION BY ord_a ORDER BY abs(r) DESC, ord_b) <= 50")
def corr_pearson_topk(spark: SparkSession, sf: str) -> DataFrame:
    return _edges(correlate(_embedding_vectors(spark, sf), "pearson", "edges:topk=50", VECTOR_SIZE))


@query(f"WITH {_VECTORS}, {_UNIT.format(source='mx')} SELECT gene_a, gene_b, round(r, 6) + 0.0 AS r FROM prs WHERE abs(r) >= 0.3")
def corr_pearson_threshold(spark: SparkSession, sf: str) -> DataFrame:
    return _edges(correlate(_embedding_vectors(spark, sf), "pearson", "edges:threshold=0.3", VECTOR_SIZE))


@query(f"WITH {_COUNTS}, {_UNIT.format(source='mx')} SELECT gene_a, gene_b, round(r, 6) + 0.0 AS r FROM both_ways UNION ALL SELECT gene_id, gene_id, 1.0 FROM unit")
def corr_pearson_dense(spark: SparkSession, sf: str) -> DataFrame:
    vectors, samples = _count_vectors(spark, sf)
    return _edges(correlate(_ordered(vectors), "pearson", "dense", len(samples)))


@query(f"WITH {_VECTORS}, {_RANKED}, {_UNIT.format(source='rk')} SELECT gene_a, gene_b, round(r, 6) + 0.0 AS r FROM both_ways QUALIFY row_number() OVER (PARTITION BY ord_a ORDER BY abs(r) DESC, ord_b) <= 10")
def corr_spearman_topk(spark: SparkSession, sf: str) -> DataFrame:
    return _edges(correlate(_embedding_vectors(spark, sf), "spearman", "edges:topk=10", VECTOR_SIZE))


@query(f"WITH {_COUNTS}, {_RANKED}, {_UNIT.format(source='rk')} SELECT gene_a, gene_b, round(r, 6) + 0.0 AS r FROM prs WHERE abs(r) >= 0.1")
def corr_spearman_threshold(spark: SparkSession, sf: str) -> DataFrame:
    vectors, samples = _count_vectors(spark, sf)
    return _edges(correlate(_ordered(vectors), "spearman", "edges:threshold=0.1", len(samples)))


@query(
    f"""WITH {_COUNTS}, sg AS (SELECT a.gene_id, a.sample_id AS i, b.sample_id AS j, sign(a.value - b.value) AS s FROM mx a JOIN mx b ON a.gene_id = b.gene_id AND a.sample_id < b.sample_id)
SELECT a.gene_id AS gene_a, b.gene_id AS gene_b, round(sum(a.s * b.s) / sqrt(sum(a.s * a.s) * sum(b.s * b.s)), 6) + 0.0 AS r FROM sg a JOIN sg b ON a.i = b.i AND a.j = b.j AND a.gene_id < b.gene_id GROUP BY ALL"""
)
def corr_kendall(spark: SparkSession, sf: str) -> DataFrame:
    vectors, samples = _count_vectors(spark, sf)
    return _edges(pairwise(_ordered(vectors), "kendall", len(samples)))


@query(
    f"""WITH {_COUNTS}, md AS (SELECT gene_id, median(value) AS m FROM mx GROUP BY 1), dv AS (SELECT gene_id, m, median(abs(value - m)) AS d FROM mx JOIN md USING (gene_id) GROUP BY ALL),
w AS (SELECT gene_id, sample_id, (value - m) * CASE WHEN abs((value - m) / (9 * d)) < 1 THEN pow(1 - pow((value - m) / (9 * d), 2), 2) ELSE 0 END AS x FROM mx JOIN dv USING (gene_id))
SELECT a.gene_id AS gene_a, b.gene_id AS gene_b, round(sum(a.x * b.x) / sqrt(sum(a.x * a.x) * sum(b.x * b.x)), 6) + 0.0 AS r FROM w a JOIN w b ON a.sample_id = b.sample_id AND a.gene_id < b.gene_id GROUP BY ALL"""
)
def corr_bicor(spark: SparkSession, sf: str) -> DataFrame:
    vectors, samples = _count_vectors(spark, sf)
    return _edges(pairwise(_ordered(vectors), "bicor", len(samples)))


@query(
    f"""WITH {_COUNTS}, {_RANKED}, size AS (SELECT count(DISTINCT sample_id) AS n FROM rk), u AS (SELECT gene_id, sample_id, value / (n + 1) AS u FROM rk, size),
pr AS (SELECT a.gene_id AS ga, b.gene_id AS gb, a.sample_id AS s, a.u AS x, b.u AS y FROM u a JOIN u b ON a.sample_id = b.sample_id AND a.gene_id < b.gene_id),
near AS (SELECT p.ga, p.gb, p.s, min((p.x - q.x) * (p.x - q.x) + (p.y - q.y) * (p.y - q.y)) AS d FROM pr p JOIN pr q ON p.ga = q.ga AND p.gb = q.gb AND p.s <> q.s GROUP BY ALL),
aff AS (SELECT ga, gb, least(1.0, 2 * sqrt(any_value(n) - 1.0) / any_value(n) * sum(sqrt(d))) AS b FROM near, size GROUP BY ga, gb)
SELECT ga AS gene_a, gb AS gene_b, round(CASE WHEN b > 0 THEN least(1.0, 2 / (b * b) * sqrt(greatest(0.0, pow(b, 4) + sqrt(greatest(0.0, 4 - 3 * pow(b, 4))) - 2))) ELSE 1.0 END, 6) + 0.0 AS r FROM aff"""
)
def corr_hellcor(spark: SparkSession, sf: str) -> DataFrame:
    vectors, samples = _count_vectors(spark, sf)
    return _edges(pairwise(_ordered(vectors), "hellcor", len(samples)))


def _adjusted_edges(spark: SparkSession, sf: str) -> DataFrame:
    long = cut_lineage(_counts(spark, sf))
    samples = matrix.sample_order(long)
    chosen = matrix.select_genes(long, "topvar:20")
    vectors = matrix.to_vectors(matrix.subset(long, chosen), samples, missing=0.0)
    adjusted = design.adjust(vectors, _samples(spark, sf), samples, "~ batch + age")
    ordered = adjusted.join(chosen.select("gene_id", F.col("place").alias("ord")), "gene_id")
    return correlate(ordered, "pearson", "edges:topk=5", len(samples))


_TYPES = "ann AS (SELECT p_brand AS gene_id, min(p_type) AS gene_biotype FROM part WHERE p_size < 20 GROUP BY 1)"
_ADJUSTED = f"""
WITH cells AS (SELECT p_brand AS gene_id, l_suppkey AS sample_id, sum(l_quantity) AS value FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY ALL),
chosen AS (SELECT gene_id, row_number() OVER (ORDER BY v DESC, gene_id) AS ord FROM (SELECT gene_id, var_pop(value) AS v FROM cells GROUP BY 1) QUALIFY ord <= 20),
mx AS (SELECT g.gene_id, s.sample_id, coalesce(c.value, 0) AS value FROM chosen g CROSS JOIN (SELECT DISTINCT sample_id FROM cells) s LEFT JOIN cells c ON g.gene_id = c.gene_id AND s.sample_id = c.sample_id),
samples AS (SELECT s_suppkey AS sample_id, r_name AS batch, s_acctbal AS age FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey), {_BOTH},
{_UNIT.format(source='res')}, {_TYPES},
top AS (SELECT b.* FROM both_ways b JOIN chosen ca ON b.gene_a = ca.gene_id JOIN chosen cb ON b.gene_b = cb.gene_id QUALIFY row_number() OVER (PARTITION BY b.gene_a ORDER BY abs(r) DESC, cb.ord) <= 5)
"""


@query(
    _ADJUSTED
    + "SELECT gene_a, gene_b, round(r, 6) + 0.0 AS r, coalesce(x.gene_biotype, '') AS a_gene_biotype, coalesce(y.gene_biotype, '') AS b_gene_biotype FROM top LEFT JOIN ann x ON gene_a = x.gene_id LEFT JOIN ann y ON gene_b = y.gene_id"
)
def adjusted_corr_edges(spark: SparkSession, sf: str) -> DataFrame:
    """The flagship: most variable genes, covariates removed, correlated, best neighbours, annotated."""
    ann = table(spark, sf, "part").where("p_size < 20").groupBy(F.col("p_brand").alias("gene_id")).agg(F.min("p_type").alias("gene_biotype"))
    return _r6(annotate.annotate_edges(_adjusted_edges(spark, sf), ann), "r").select("gene_a", "gene_b", "r", "a_gene_biotype", "b_gene_biotype")


@query(f"WITH {_COUNTS}, {_TYPES}, m AS (SELECT gene_id, round(avg(value), 6) AS mean FROM mx GROUP BY 1) SELECT m.gene_id, mean, coalesce(gene_biotype, '') AS gene_biotype FROM m LEFT JOIN ann USING (gene_id)")
def gene_table_annotated(spark: SparkSession, sf: str) -> DataFrame:
    ann = table(spark, sf, "part").where("p_size < 20").groupBy(F.col("p_brand").alias("gene_id")).agg(F.min("p_type").alias("gene_biotype"))
    vectors, samples = _count_vectors(spark, sf)
    stats = matrix.gene_stats(matrix.to_long(vectors, samples)).select("gene_id", F.round("mean", 6).alias("mean"))
    return annotate.annotate(stats, ann)


# --- modules --------------------------------------------------------------------------------------


def _mutual(spark: SparkSession, sf: str) -> DataFrame:
    return cut_lineage(modules.mutual_edges(_embedding_vectors(spark, sf), VECTOR_SIZE, MODULE_NEIGHBOURS))


_MUTUAL = f"""
WITH RECURSIVE {_VECTORS}, {_RANKED}, {_UNIT.format(source='rk')},
knn AS (SELECT * FROM both_ways WHERE r > 0 QUALIFY row_number() OVER (PARTITION BY ord_a ORDER BY r DESC, ord_b) <= {MODULE_NEIGHBOURS}),
edg AS (SELECT a.* FROM knn a JOIN knn b ON a.ord_a = b.ord_b AND a.ord_b = b.ord_a WHERE a.ord_a < a.ord_b),
und AS (SELECT ord_a AS u, ord_b AS v FROM edg UNION SELECT ord_b, ord_a FROM edg),
reach AS (SELECT u, u AS c FROM (SELECT DISTINCT u FROM und) UNION SELECT und.v, reach.c FROM reach JOIN und ON reach.u = und.u WHERE reach.c < und.v),
comp AS (SELECT u AS node, min(c) AS component FROM reach GROUP BY 1),
conn AS (SELECT a.node, sum(greatest(r, 0)) AS connectivity FROM comp a JOIN comp b ON a.component = b.component AND a.node <> b.node JOIN both_ways w ON w.ord_a = a.node AND w.ord_b = b.node GROUP BY 1),
rnk AS (SELECT c.component, c.node, n.connectivity, row_number() OVER (PARTITION BY c.component ORDER BY n.connectivity DESC, c.node) AS k FROM comp c JOIN conn n USING (node) QUALIFY k <= 20),
siz AS (SELECT component, count(*) AS module_size FROM rnk GROUP BY 1),
nam AS (SELECT component, module_size, 'M' || lpad(CAST(row_number() OVER (ORDER BY module_size DESC, component) AS VARCHAR), 4, '0') AS module_id FROM siz),
mem AS (SELECT module_id, module_size, gene_id AS gene, node AS ord, k AS rank_in_module, connectivity FROM rnk JOIN nam USING (component) JOIN unit ON unit.ord = node),
eig AS (SELECT module_id, sample_id, avg(value) AS value FROM mem JOIN mx ON gene = gene_id GROUP BY ALL)
"""


@query(_MUTUAL + "SELECT gene_a, gene_b, round(r, 6) AS r FROM edg")
def mutual_knn_edges(spark: SparkSession, sf: str) -> DataFrame:
    return _edges(_mutual(spark, sf))


@query(_MUTUAL + "SELECT node, component FROM comp")
def module_components(spark: SparkSession, sf: str) -> DataFrame:
    return modules.components(_mutual(spark, sf))


def _ranked(spark: SparkSession, sf: str) -> DataFrame:
    members = cut_lineage(modules.modules(_mutual(spark, sf), min_size=2))
    connected = modules.component_connectivity(_embedding_vectors(spark, sf), members)
    return modules.ranked_modules(members, connected, top=20)


@query(_MUTUAL + "SELECT module_id, module_size, gene, ord, rank_in_module, round(connectivity, 5) AS connectivity FROM mem")
def module_members(spark: SparkSession, sf: str) -> DataFrame:
    return _ranked(spark, sf).withColumn("connectivity", F.round("connectivity", 5))


@query(_MUTUAL + "SELECT module_id, CAST(sample_id AS BIGINT) AS sample_id, round(value, 6) + 0.0 AS value FROM eig")
def module_eigengenes(spark: SparkSession, sf: str) -> DataFrame:
    return _r6(modules.eigengenes(_ranked(spark, sf), _embedding_long(spark, sf)), "value").withColumn("sample_id", F.col("sample_id").cast("long"))


@query()
def module_members_usual(spark: SparkSession, sf: str) -> DataFrame:
    """Modules with the operators' usual settings (20 neighbours, least size 25, top 500), where one component has nearly all genes."""
    vectors = cut_lineage(_embedding_vectors(spark, sf))
    edges = cut_lineage(modules.mutual_edges(vectors, VECTOR_SIZE, modules.neighbour_count(vectors.count())))
    members = cut_lineage(modules.modules(edges))
    return modules.ranked_modules(members, modules.component_connectivity(vectors, members)).withColumn("connectivity", F.round("connectivity", 5))


@query(
    f"""WITH {_VECTORS}, {_RANKED}, prof AS (SELECT 'L' || label AS module_id, sample_id, avg(value) AS value FROM mx JOIN embeddings ON gene_id = vec_id GROUP BY ALL),
pr AS (SELECT module_id, sample_id, rank() OVER (PARTITION BY module_id ORDER BY value) + (count(*) OVER (PARTITION BY module_id, value) - 1) / 2.0 AS value FROM prof),
c AS (SELECT module_id, gene_id, corr(rk.value, pr.value) AS r FROM rk JOIN pr USING (sample_id) GROUP BY ALL)
SELECT module_id, gene_id, round(r, 6) + 0.0 AS r, round(r * sqrt(62 / (1 - r * r)), 5) + 0.0 AS t FROM c"""
)
def module_tstats(spark: SparkSession, sf: str) -> DataFrame:
    long = _embedding_long(spark, sf)
    labels = table(spark, sf, "embeddings").select(F.col("vec_id").alias("gene"), F.concat(F.lit("L"), F.col("label").cast("string")).alias("module_id"))
    profiles = matrix.to_vectors(modules.eigengenes(labels, long), list(range(VECTOR_SIZE)), "module_id")
    rows = table(spark, sf, "embeddings").select(F.col("vec_id").alias("gene_id"), F.col("embedding").cast("array<double>").alias("values"))
    stats = modules.module_tstats(rows, profiles, VECTOR_SIZE)
    return stats.select("module_id", "gene_id", (F.round("r", 6) + 0.0).alias("r"), (F.round("t", 5) + 0.0).alias("t"))


# --- enrichment -----------------------------------------------------------------------------------


def _gene_scores(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Vectors ranked by two of their coordinates, and their labels as gene sets."""
    e = table(spark, sf, "embeddings")
    score = lambda i: e.select(F.lit(f"M{i}").alias("module_id"), F.col("vec_id").alias("gene_id"), F.element_at("embedding", i + 1).cast("double").alias("t"))
    sets = e.select(F.concat(F.lit("set_"), F.col("label").cast("string")).alias("pathway"), F.col("vec_id").alias("gene_id"))
    return score(0).unionByName(score(1)), sets


@query(
    """WITH s AS (SELECT 'M0' AS module_id, vec_id AS gene_id, CAST(embedding[1] AS DOUBLE) AS t FROM embeddings UNION ALL SELECT 'M1', vec_id, CAST(embedding[2] AS DOUBLE) FROM embeddings),
p AS (SELECT *, row_number() OVER (PARTITION BY module_id ORDER BY t DESC, gene_id) AS place, count(*) OVER (PARTITION BY module_id) AS n FROM s),
l AS (SELECT DISTINCT 'set_' || label AS pathway FROM embeddings),
x AS (SELECT p.module_id, l.pathway, p.place, p.n, e.vec_id IS NOT NULL AS hit, abs(p.t) AS w FROM p CROSS JOIN l LEFT JOIN embeddings e ON e.vec_id = p.gene_id AND 'set_' || e.label = l.pathway),
k AS (SELECT *, count(*) FILTER (hit) OVER (PARTITION BY module_id, pathway) AS size, sum(w) FILTER (hit) OVER (PARTITION BY module_id, pathway) AS total FROM x),
r AS (SELECT module_id, pathway, size, sum(CASE WHEN hit THEN w / total ELSE -1.0 / (n - size) END) OVER (PARTITION BY module_id, pathway ORDER BY place) AS run FROM k)
SELECT module_id, pathway, any_value(size) AS size, round(CASE WHEN max(run) >= -min(run) THEN max(run) ELSE min(run) END, 6) AS es FROM r GROUP BY ALL"""
)
def gsea_es(spark: SparkSession, sf: str) -> DataFrame:
    return _r6(enrich.running_scores(*_gene_scores(spark, sf)), "es")


@query()
def gsea_permutation(spark: SparkSession, sf: str) -> DataFrame:
    return enrich.permutation_test(*_gene_scores(spark, sf))


@query(
    """WITH t AS (SELECT o_orderkey % 7 AS grp, o_orderkey AS k, (o_orderkey * 7919 % 9973) / 10000.0 AS p FROM orders),
r AS (SELECT *, p * count(*) OVER (PARTITION BY grp) / row_number() OVER (PARTITION BY grp ORDER BY p, k) AS q, row_number() OVER (PARTITION BY grp ORDER BY p, k) AS n FROM t)
SELECT grp, k, round(least(1.0, min(q) OVER (PARTITION BY grp ORDER BY n ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)), 6) AS padj FROM r"""
)
def bh_adjusted(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("o_orderkey")
    rows = table(spark, sf, "orders").select((k % 7).alias("grp"), k.alias("k"), ((k * 7919 % 9973) / F.lit(10000.0)).alias("p_value"))
    return enrich.bh_adjust(rows, ["grp"], order=["k"]).select("grp", "k", F.round("padj", 6).alias("padj"))


# --- normalization --------------------------------------------------------------------------------

_FACTORS = """
lg AS (SELECT gene_id, avg(ln(value)) AS m FROM cells GROUP BY 1 HAVING min(value) > 0),
sfac AS (SELECT sample_id, exp(quantile_cont(ln(value) - m, 0.5)) AS size_factor FROM cells JOIN lg USING (gene_id) GROUP BY 1)
"""


@query(f"WITH {_COUNTS}, {_FACTORS} SELECT sample_id, round(size_factor, 6) AS size_factor FROM sfac")
def size_factors(spark: SparkSession, sf: str) -> DataFrame:
    return _r6(normalize.size_factors(_counts(spark, sf)), "size_factor")


@query(f"WITH {_COUNTS}, {_FACTORS} SELECT gene_id, sample_id, round(value / size_factor, 6) AS value FROM cells JOIN sfac USING (sample_id)")
def norm_counts(spark: SparkSession, sf: str) -> DataFrame:
    long = _counts(spark, sf)
    return _r6(normalize.normalized(long, normalize.size_factors(long)), "value").select("gene_id", "sample_id", "value")


@query(f"WITH {_COUNTS}, {_FACTORS}, q AS (SELECT gene_id, sample_id, value / size_factor AS q FROM cells JOIN sfac USING (sample_id)) SELECT gene_id, sample_id, round(log2((1 + 1.5 + 2 * 0.1 * q + 2 * sqrt(0.1 * q * (1 + 1.5 + 0.1 * q))) / (4 * 0.1)), 6) AS value FROM q")
def vst_closed_form(spark: SparkSession, sf: str) -> DataFrame:
    long = _counts(spark, sf)
    norm = normalize.normalized(long, normalize.size_factors(long))
    return norm.select("gene_id", "sample_id", F.round(normalize.vst(F.col("value"), 0.1, 1.5), 6).alias("value"))


@query(
    """WITH tx AS (SELECT p_brand AS gene_id, l_suppkey AS sample_id, sum(l_quantity) AS counts, sum(l_extendedprice) AS tpm, avg(l_partkey) + 100 AS len FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY l_partkey, ALL),
g AS (SELECT gene_id, sample_id, sum(counts) AS counts, sum(tpm) AS tpm, sum(tpm * len) / sum(tpm) AS length FROM tx GROUP BY ALL),
m AS (SELECT gene_id, avg(length) AS ml FROM g GROUP BY 1), r AS (SELECT *, tpm * ml AS raw FROM g JOIN m USING (gene_id))
SELECT gene_id, sample_id, round(raw * sum(counts) OVER w / sum(raw) OVER w, 5) AS value FROM r WINDOW w AS (PARTITION BY sample_id)""".replace("GROUP BY l_partkey, ALL", "GROUP BY p_brand, l_suppkey, l_partkey")
)
def length_scaled_counts(spark: SparkSession, sf: str) -> DataFrame:
    return normalize.gene_counts(_abundance(spark, sf)).select("gene_id", "sample_id", F.round("value", 5).alias("value"))


def _abundance(spark: SparkSession, sf: str) -> DataFrame:
    """Transcripts of the parts, summed to their brands."""
    items, parts = table(spark, sf, "lineitem"), table(spark, sf, "part")
    name = F.concat(F.lit("T"), F.col("l_partkey").cast("string"), F.lit(".2"))
    tx = items.groupBy(name.alias("tx"), F.col("l_suppkey").alias("sample_id")).agg(F.sum("l_quantity").alias("counts"), F.sum("l_extendedprice").alias("tpm"), (F.avg("l_partkey") + 100).alias("eff_length"))
    genes = parts.select(F.concat(F.lit("T"), F.col("p_partkey").cast("string"), F.lit(".1")).alias("tx"), F.col("p_brand").alias("gene_id"))
    return normalize.gene_abundance(tx, genes)


@query(
    """WITH g AS (SELECT p_brand AS gene_id, l_suppkey AS sample_id, sum(l_quantity) AS counts, sum(l_extendedprice) AS tpm FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY ALL)
SELECT gene_id, sample_id, counts AS raw, round(tpm * sum(counts) OVER w / sum(tpm) OVER w, 5) AS scaled FROM g WINDOW w AS (PARTITION BY sample_id)"""
)
def scaled_counts(spark: SparkSession, sf: str) -> DataFrame:
    genes = _abundance(spark, sf)
    raw = normalize.gene_counts(genes, "no").withColumnRenamed("value", "raw")
    return raw.join(normalize.gene_counts(genes, "scaledTPM"), ["gene_id", "sample_id"]).select("gene_id", "sample_id", "raw", F.round("value", 5).alias("scaled"))


def _sized(spark: SparkSession, sf: str) -> tuple[DataFrame, list, np.ndarray]:
    """Count vectors, their samples in order and the samples' size factors."""
    long = cut_lineage(_counts(spark, sf))
    samples = matrix.sample_order(long)
    factors = {r["sample_id"]: r["size_factor"] for r in normalize.size_factors(long).collect()}
    return matrix.to_vectors(long, samples, missing=0.0), samples, np.array([factors[s] for s in samples])


@query(
    f"""WITH {_COUNTS}, {_FACTORS}, all_cells AS (SELECT gene_id, sample_id, size_factor, coalesce(value, 0) AS value FROM (SELECT DISTINCT gene_id FROM cells) CROSS JOIN sfac LEFT JOIN cells USING (gene_id, sample_id)),
q AS (SELECT gene_id, round_even(value, 0) / size_factor AS q, size_factor FROM all_cells), m AS (SELECT gene_id, avg(q) AS mean, var_samp(q) AS v, avg(1 / size_factor) AS inv FROM q GROUP BY 1)
SELECT gene_id, round(mean, 5) AS mean, round(greatest(1e-8, (v - mean * inv) / (mean * mean)), 7) AS dispersion FROM m"""
)
def gene_dispersions(spark: SparkSession, sf: str) -> DataFrame:
    vectors, samples, sizes = _sized(spark, sf)
    moments = normalize.dispersion_moments(vectors, sizes, np.ones((len(samples), 1)))
    return moments.select("gene_id", F.round("mean", 5).alias("mean"), F.round("dispersion", 7).alias("dispersion"))


@query()
def vst_fitted(spark: SparkSession, sf: str) -> DataFrame:
    """Both transformations with the trend fit to these counts."""
    long = cut_lineage(_counts(spark, sf))
    factors, samples = normalize.size_factors(long), matrix.sample_order(long)
    made = [normalize.stabilized(long, factors, samples, m).select(F.lit(m).alias("method"), "gene_id", "sample_id", "value") for m in ("vst", "rlog")]
    return made[0].unionByName(made[1])


@query()
def de_wald(spark: SparkSession, sf: str) -> DataFrame:
    """Each region against the first, and the last against the one before."""
    vectors, samples, sizes = _sized(spark, sf)
    normalize.check_runs(len(samples), "deseq2")
    sheet = _samples(spark, sf)
    x, names = design.design_for(sheet, samples, "~ batch")
    levels = sorted(r[0] for r in table(spark, sf, "region").select("r_name").collect())
    held = [v for v in levels if v == levels[0] or f"batch={v}" in names]
    wanted = [normalize.contrast(f"batch|{v}|{held[0]}") for v in held[1:]] + ([normalize.contrast(f"batch|{held[-1]}|{held[-2]}|last_two")] if len(held) > 2 else [])
    normalize.check_contrasts(wanted, sheet.columns)
    return normalize.wald_test(vectors, sizes, x, {name: normalize.contrast_vector(names, f, a, b, held) for f, a, b, name in wanted})
