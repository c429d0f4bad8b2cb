"""Neighbours, clusters, anomalies, balancing: queries and oracle SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import anomaly, balance, cluster, metrics, neighbors
from . import roles as R
from .registry import query, r6, rounded, sql6
from .roles import with_roles

K = 5

_PAIRS = """pairs AS (SELECT a.vec_id AS id, b.vec_id AS neighbor_id, a.cluster AS ca, b.cluster AS cb,
  list_distance(a.vec, b.vec) AS d FROM vectors a JOIN vectors b ON a.vec_id <> b.vec_id)"""
_CENTS = """x AS (SELECT vec_id, cluster, unnest(vec) AS v, generate_subscripts(vec, 1) AS i FROM vectors),
cm AS (SELECT cluster, i, avg(v) AS m FROM x GROUP BY 1, 2),
cents AS (SELECT cluster, list(m ORDER BY i) AS centroid FROM cm GROUP BY 1),
sizes AS (SELECT cluster, count(*) AS n FROM vectors GROUP BY 1),
dist AS (SELECT vec_id, v.cluster, vec, list_distance(vec, centroid) AS distance FROM vectors v JOIN cents c ON v.cluster = c.cluster),
spread AS (SELECT d.cluster, max(n) AS n, avg(distance) AS s, sum(distance * distance) AS w
  FROM dist d JOIN sizes z ON d.cluster = z.cluster GROUP BY 1)"""


@query("knn_join", with_roles(f"""
WITH {_PAIRS} SELECT id, cast(rk AS INTEGER) AS rank, neighbor_id, {sql6('d', 'distance')} FROM
  (SELECT *, row_number() OVER (PARTITION BY id ORDER BY d, neighbor_id) AS rk FROM pairs) WHERE rk <= {K}""", "vectors"))
def knn_join(spark, sf):
    v = R.vectors(spark, sf)
    return rounded(neighbors.knn_join(v, v, K, "vec_id", exclude_self=True))


@query("knn_regress", with_roles(f"""
WITH {_PAIRS} SELECT id, {sql6('avg(cb)', 'pred')} FROM
  (SELECT *, row_number() OVER (PARTITION BY id ORDER BY d, neighbor_id) AS rk FROM pairs WHERE neighbor_id % 5 <> 0)
WHERE rk <= {K} AND id % 5 = 0 GROUP BY 1""", "vectors"))
def knn_regress(spark, sf):
    from ..operators.models import knn_regress as predict

    v = R.vectors(spark, sf)
    test, train = v.where(F.col("vec_id") % 5 == 0), v.where(F.col("vec_id") % 5 != 0)
    return rounded(predict(test, train, K, "vec_id", "cluster"))


@query("centroids", with_roles(f"""
WITH {_CENTS} SELECT cm.cluster, i - 1 AS dim, n AS size, {sql6('m', 'value')} FROM cm JOIN sizes ON cm.cluster = sizes.cluster""", "vectors"))
def centroid_rows(spark, sf):
    c = cluster.centroids(R.vectors(spark, sf))
    return rounded(c.select("cluster", "size", F.posexplode("centroid").alias("p", "value")).select(
        "cluster", F.col("p").cast("bigint").alias("dim"), "size", "value"))


@query("distance_to_centroid", with_roles(f"""
WITH {_CENTS} SELECT vec_id, cluster, {sql6('distance', 'distance')} FROM dist""", "vectors"))
def distance_to_centroid(spark, sf):
    v = R.vectors(spark, sf)
    return rounded(cluster.distance_to_centroid(v, cluster.centroids(v)).select("vec_id", "cluster", "distance"))


def _outliers(spark, sf):
    v = R.vectors(spark, sf)
    return cluster.distance_outliers(cluster.distance_to_centroid(v, cluster.centroids(v)).drop("vec"))


_OUT = """o AS (SELECT vec_id, dist.cluster, distance, distance > edge AS is_outlier FROM dist JOIN
  (SELECT cluster, quantile_cont(distance, 0.9) AS edge FROM dist GROUP BY 1) e ON dist.cluster = e.cluster)"""


@query("cluster_distance_outlier", with_roles(f"""
WITH {_CENTS}, {_OUT} SELECT vec_id, cluster, {sql6('distance', 'distance')}, is_outlier FROM o""", "vectors"))
def cluster_distance_outlier(spark, sf):
    return rounded(_outliers(spark, sf).select("vec_id", "cluster", "distance", "is_outlier"))


@query("anomaly_share_by_cluster", with_roles(f"""
WITH {_CENTS}, {_OUT} SELECT cluster, count(*) FILTER (WHERE is_outlier) AS flagged, count(*) AS rows,
  {sql6('count(*) FILTER (WHERE is_outlier) * 100.0 / count(*)', 'percent')} FROM o GROUP BY 1""", "vectors"))
def anomaly_share_by_cluster(spark, sf):
    return rounded(cluster.flag_share_by_cluster(_outliers(spark, sf), "is_outlier"))


@query("assign_nearest_centroid", with_roles(f"""
WITH {_CENTS} SELECT vec_id, arg_min(c.cluster, list_distance(vec, centroid)) AS assigned
FROM vectors v CROSS JOIN cents c GROUP BY 1""", "vectors"))
def assign_nearest_centroid(spark, sf):
    v = R.vectors(spark, sf)
    return cluster.assign_nearest(v, cluster.centroids(v)).select("vec_id", "assigned")


@query("cluster_sizes", f"""
SELECT cast(label AS BIGINT) AS cluster, count(*) AS rows, {sql6('count(*) * 100.0 / sum(count(*)) OVER ()', 'percent')}
FROM embeddings GROUP BY 1""")
def cluster_sizes(spark, sf):
    return rounded(cluster.cluster_sizes(R.vectors(spark, sf)))


@query("cluster_profile", f"""
SELECT o_orderstatus AS cluster, {sql6('avg(o_totalprice)', 'o_totalprice')}, {sql6('avg(o_custkey)', 'o_custkey')}
FROM orders GROUP BY 1""")
def cluster_profile(spark, sf):
    from ..sources.tables import read_table

    df = read_table(spark, sf, "orders").withColumnRenamed("o_orderstatus", "cluster")
    return rounded(cluster.cluster_profile(df, ["o_totalprice", "o_custkey"]))


@query("inertia", with_roles(f"WITH {_CENTS} SELECT {sql6('sum(w)', 'inertia')} FROM spread", "vectors"))
def inertia(spark, sf):
    return rounded(cluster.inertia(R.vectors(spark, sf)))


_CH = """(SELECT b * (n - k) / (w * (k - 1)) FROM (SELECT sum(n) AS n, count(*) AS k, sum(w) AS w FROM spread),
  (SELECT sum(z.n * (m - g) ** 2) AS b FROM cm JOIN sizes z ON cm.cluster = z.cluster
     JOIN (SELECT i, avg(v) AS g FROM x GROUP BY 1) t ON cm.i = t.i))"""
_DB = """(SELECT avg(r) FROM (SELECT a.cluster, max((a.s + b.s) / list_distance(p.centroid, q.centroid)) AS r
  FROM spread a JOIN spread b ON a.cluster <> b.cluster JOIN cents p ON a.cluster = p.cluster
  JOIN cents q ON b.cluster = q.cluster GROUP BY 1))"""


@query("calinski_harabasz", with_roles(f"WITH {_CENTS} SELECT {sql6(_CH, 'calinski_harabasz')}", "vectors"))
def calinski_harabasz(spark, sf):
    return rounded(cluster.calinski_harabasz(R.vectors(spark, sf)))


@query("davies_bouldin", with_roles(f"WITH {_CENTS} SELECT {sql6(_DB, 'davies_bouldin')}", "vectors"))
def davies_bouldin(spark, sf):
    return rounded(cluster.davies_bouldin(R.vectors(spark, sf)))


def _sil_sql(value: str) -> str:
    return f"""means AS (SELECT id, ca, cb, avg({value}) AS m FROM pairs GROUP BY 1, 2, 3),
sil AS (SELECT id, ca, CASE WHEN max(m) FILTER (WHERE ca = cb) IS NULL THEN 0 ELSE
  (min(m) FILTER (WHERE ca <> cb) - max(m) FILTER (WHERE ca = cb)) /
  greatest(min(m) FILTER (WHERE ca <> cb), max(m) FILTER (WHERE ca = cb)) END AS s FROM means GROUP BY 1, 2)"""


@query("silhouette", with_roles(f"""
WITH {_PAIRS}, {_sil_sql('d')} SELECT id AS vec_id, ca AS cluster, {sql6('s', 'silhouette')} FROM sil""", "vectors"))
def silhouette(spark, sf):
    return rounded(cluster.silhouette_samples(R.vectors(spark, sf), "vec_id"))


@query("silhouette_squared", with_roles(f"""
WITH {_PAIRS}, {_sil_sql('d * d')} SELECT {sql6('avg(s)', 'silhouette_squared')} FROM sil""", "vectors"))
def silhouette_squared(spark, sf):
    return rounded(cluster.silhouette_squared(R.vectors(spark, sf)))


@query("ab_scorecard", with_roles(f"""
WITH {_CENTS}, {_PAIRS}, {_sil_sql('d')}, a AS (SELECT (SELECT avg(s) FROM sil) AS si, {_CH} AS ch, {_DB} AS db),
g AS (SELECT vec_id % 4 AS k, vec_id, vec FROM vectors), gx AS (SELECT k, vec_id, unnest(vec) AS v, generate_subscripts(vec, 1) AS i FROM g),
gm AS (SELECT k, i, avg(v) AS m FROM gx GROUP BY 1, 2), gc AS (SELECT k, list(m ORDER BY i) AS centroid FROM gm GROUP BY 1),
gd AS (SELECT g.k, list_distance(vec, centroid) AS d FROM g JOIN gc ON g.k = gc.k),
gs AS (SELECT k, count(*) AS n, avg(d) AS s, sum(d * d) AS w FROM gd GROUP BY 1),
gp AS (SELECT id, id % 4 AS ka, neighbor_id % 4 AS kb, avg(d) AS m FROM pairs GROUP BY 1, 2, 3),
gl AS (SELECT id, (min(m) FILTER (WHERE ka <> kb) - max(m) FILTER (WHERE ka = kb)) /
  greatest(min(m) FILTER (WHERE ka <> kb), max(m) FILTER (WHERE ka = kb)) AS s FROM gp GROUP BY 1),
b AS (SELECT (SELECT avg(s) FROM gl) AS si,
  (SELECT z * (n - k) / (w * (k - 1)) FROM (SELECT sum(n) AS n, count(*) AS k, sum(w) AS w FROM gs),
     (SELECT sum(gs.n * (m - t.g) ** 2) AS z FROM gm JOIN gs ON gm.k = gs.k JOIN (SELECT i, avg(v) AS g FROM gx GROUP BY 1) t ON gm.i = t.i)) AS ch,
  (SELECT avg(r) FROM (SELECT p.k, max((p.s + q.s) / list_distance(e.centroid, f.centroid)) AS r FROM gs p JOIN gs q ON p.k <> q.k
     JOIN gc e ON p.k = e.k JOIN gc f ON q.k = f.k GROUP BY 1)) AS db),
s AS (SELECT cast((a.si > b.si)::INT + (a.ch > b.ch)::INT + (a.db < b.db)::INT AS BIGINT) AS a_points FROM a, b)
SELECT a_points, 3 - a_points AS b_points, CASE WHEN a_points > 3 - a_points THEN 'a' ELSE 'b' END AS overall FROM s""", "vectors"))
def ab_scorecard(spark, sf):
    v = R.vectors(spark, sf)
    names = ["silhouette", "calinski_harabasz", "davies_bouldin"]
    a = metrics.as_long(cluster.quality_row(v, "vec_id"), names)
    b = metrics.as_long(cluster.quality_row(v.withColumn("cluster", F.col("vec_id") % 4), "vec_id"), names)
    both = a.withColumnRenamed("value", "a").join(b.withColumnRenamed("value", "b"), "metric")
    return metrics.scorecard(both, ["davies_bouldin"])


_LOF = """nn AS (SELECT id, neighbor_id, d FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY d, neighbor_id) AS rk FROM pairs) WHERE rk <= 20),
kd AS (SELECT id, max(d) AS kd FROM nn GROUP BY 1),
lrd AS (SELECT nn.id, 1 / (avg(greatest(kd.kd, nn.d)) + 1e-10) AS v FROM nn JOIN kd ON nn.neighbor_id = kd.id GROUP BY 1),
lof AS (SELECT nn.id, -avg(o.v) / max(m.v) AS score FROM nn JOIN lrd o ON nn.neighbor_id = o.id JOIN lrd m ON nn.id = m.id GROUP BY 1)"""


@query("lof_score", with_roles(f"""
WITH {_PAIRS}, {_LOF} SELECT id AS vec_id, {sql6('score', 'lof_score')},
  score < (SELECT quantile_cont(score, 0.1) FROM lof) AS is_anomaly FROM lof""", "vectors"))
def lof_score(spark, sf):
    scored = anomaly.lof_scores(R.vectors(spark, sf), "vec_id").select("vec_id", "lof_score")
    return rounded(anomaly.flag_lowest(scored, "lof_score"))


def _flagged(spark, sf):
    """Three cheap flags per vector: distance, norm, and first component."""
    v = R.vectors(spark, sf)
    df = cluster.distance_outliers(cluster.distance_to_centroid(v, cluster.centroids(v)))
    norm = F.aggregate("vec", F.lit(0.0), lambda a, x: a + x * x)
    df = df.withColumns({"norm": norm, "first": F.get("vec", F.lit(0))})
    df = anomaly.flag_lowest(df, "norm", 0.1, "low_norm")
    return anomaly.flag_lowest(df, "first", 0.4, "low_first")


_FLAGS = """n AS (SELECT vec_id, list_sum(list_transform(vec, lambda q: q * q)) AS norm, vec[1] AS f FROM vectors),
fl AS (SELECT o.vec_id, o.cluster, is_outlier, norm < (SELECT quantile_cont(norm, 0.1) FROM n) AS low_norm,
  f < (SELECT quantile_cont(f, 0.4) FROM n) AS low_first FROM o JOIN n ON o.vec_id = n.vec_id),
vt AS (SELECT *, is_outlier::INT + low_norm::INT + low_first::INT AS anomaly_votes FROM fl)"""
_METHODS = ("is_outlier", "low_norm", "low_first")


@query("anomaly_consensus", with_roles(f"""
WITH {_CENTS}, {_OUT}, {_FLAGS} SELECT vec_id, anomaly_votes, anomaly_votes >= 2 AS is_anomaly_final FROM vt""", "vectors"))
def anomaly_consensus(spark, sf):
    return anomaly.consensus(_flagged(spark, sf), _METHODS).select("vec_id", "anomaly_votes", "is_anomaly_final")


@query("anomaly_report", with_roles(f"""
WITH {_CENTS}, {_OUT}, {_FLAGS} SELECT vec_id, cluster, anomaly_votes FROM vt WHERE anomaly_votes >= 2""", "vectors"))
def anomaly_report(spark, sf):
    df = anomaly.consensus(_flagged(spark, sf), _METHODS)
    return anomaly.anomaly_report(df, "vec_id").select("vec_id", "cluster", "anomaly_votes")


@query("anomaly_summary", with_roles(f"""
WITH {_CENTS}, {_OUT}, {_FLAGS} SELECT method, flagged, {sql6('flagged * 100.0 / n', 'percent')} FROM (
  SELECT count(*) AS n, unnest(['is_outlier', 'low_norm', 'low_first']) AS method,
    unnest([count(*) FILTER (WHERE is_outlier), count(*) FILTER (WHERE low_norm), count(*) FILTER (WHERE low_first)]) AS flagged FROM vt)""", "vectors"))
def anomaly_summary(spark, sf):
    return rounded(anomaly.method_summary(_flagged(spark, sf), _METHODS))


@query("isolation_samples", with_roles("""
WITH b AS (SELECT vec_id, ('0x' || substr(md5(concat(vec_id::VARCHAR, '42')), 1, 8))::UBIGINT::HUGEINT AS base FROM vectors),
p AS (SELECT t.i AS tree, vec_id, (base * (CASE WHEN (t.i * 2654435761 + 1) % 4294967291 = 0 THEN 1 ELSE (t.i * 2654435761 + 1) % 4294967291 END)
  + (t.i * 40503 + 7) % 4294967291) % 4294967291 AS place FROM b CROSS JOIN range(0, 100) t(i))
SELECT cast(tree AS INTEGER) AS tree, vec_id, place::BIGINT AS place FROM p
QUALIFY row_number() OVER (PARTITION BY tree ORDER BY place, vec_id) <= 256""", "vectors"))
def isolation_samples(spark, sf):
    return anomaly.isolation_samples(R.vectors(spark, sf), "vec_id").select("tree", F.col("id").alias("vec_id"), "place")


# random draws cannot be said in SQL: rows only, invariants are unit-tested
@query("isolation_flag")
def isolation_flag(spark, sf):
    scored = anomaly.isolation_scores(R.vectors(spark, sf), "vec_id")
    return anomaly.flag_lowest(scored, "isolation_score").select("vec_id", r6("isolation_score").alias("isolation_score"), "is_anomaly")


def _minority(spark, sf):
    return R.vectors(spark, sf).withColumn("label", (F.col("cluster") == 0).cast("int"))


def _digest(seed: str) -> str:
    return f"('0x' || substr(md5(tag || '{seed}'), 1, 8))::BIGINT"


@query("smote_rows", with_roles(f"""
WITH m AS (SELECT vec_id AS id, vec FROM vectors WHERE cluster = 0),
n AS (SELECT id, list(o ORDER BY d, o) AS near FROM (SELECT a.id, b.id AS o, list_distance(a.vec, b.vec) AS d,
    row_number() OVER (PARTITION BY a.id ORDER BY list_distance(a.vec, b.vec), b.id) AS rk
  FROM m a JOIN m b ON a.id <> b.id) WHERE rk <= 5 GROUP BY 1),
s AS (SELECT count(*) FILTER (WHERE cluster = 0) AS few,
  cast(floor(0.5 * count(*) FILTER (WHERE cluster <> 0)) AS BIGINT) - count(*) FILTER (WHERE cluster = 0) AS missing FROM vectors),
t AS (SELECT id, row_number() OVER (ORDER BY md5(id::VARCHAR || '42'), id) AS turn FROM m),
c AS (SELECT id, unnest(range(1, missing // few + (turn <= missing % few)::INT + 1)) AS copy FROM t, s),
p AS (SELECT c.id, copy, near[{_digest('42n')} % len(near) + 1] AS neighbor_id, {_digest('42u')} / 4294967296.0::DOUBLE AS u
  FROM (SELECT *, id::VARCHAR || '-' || copy::VARCHAR AS tag FROM c) c JOIN n ON c.id = n.id),
x AS (SELECT p.id, copy, neighbor_id, u, unnest(a.vec) AS va, unnest(b.vec) AS vb, generate_subscripts(a.vec, 1) - 1 AS dim
  FROM p JOIN m a ON p.id = a.id JOIN m b ON p.neighbor_id = b.id)
SELECT id AS base_id, cast(copy AS INTEGER) AS copy, neighbor_id, 1 AS label, cast(dim AS INTEGER) AS dim,
  {sql6('va + u * (vb - va)', 'value')} FROM x""", "vectors"))
def smote_rows(spark, sf):
    rows = balance.smote_rows(_minority(spark, sf), "vec_id", "vec", "label")
    cols = ["base_id", F.col("copy").cast("int").alias("copy"), "neighbor_id", "label"]
    return rounded(rows.select(*cols, F.posexplode("vec").alias("dim", "value")))


@query("union_synthetic", with_roles(f"""
WITH s AS (SELECT count(*) FILTER (WHERE cluster <> 0) AS a, count(*) FILTER (WHERE cluster = 0) AS b FROM vectors)
SELECT 0 AS label, false AS synthetic, a AS rows FROM s UNION ALL SELECT 1, false, b FROM s
UNION ALL SELECT 1, true, cast(floor(0.5 * a) AS BIGINT) - b FROM s""", "vectors"))
def union_synthetic(spark, sf):
    df = _minority(spark, sf)
    both = balance.union_synthetic(df, balance.smote_rows(df, "vec_id", "vec", "label"), "vec", "label")
    return both.groupBy("label", "synthetic").agg(F.count(F.lit(1)).alias("rows"))
