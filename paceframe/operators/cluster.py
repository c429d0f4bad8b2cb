"""Cluster profiles, centroids and internal quality measures over vector columns.

Centroid tables have one row per cluster, so they are tiny beside the points;
measures that compare clusters with each other read them as one array.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.ml.feature import PCA, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import euclid, share, sq_distance
from .entity import group_means
from .joins import left_join
from .neighbors import BLOCK_ROWS, beside, cluster_silhouettes
from .quantiles import EXACT_ROWS, group_quantiles
from ..session import materialise


def to_vector_column(df: DataFrame, cols: Sequence[str], name: str = "vec") -> DataFrame:
    return df.withColumn(name, F.array(*[F.col(c).cast("double") for c in cols]))


def centroids(df: DataFrame, cluster: str = "cluster", vec: str = "vec") -> DataFrame:
    """(cluster, size, centroid): the mean vector of every cluster, combined on the map side."""
    v = df.where(F.col(cluster).isNotNull()).select(cluster, array_to_vector(vec).alias("__v"))
    return v.groupBy(cluster).agg(F.count(F.lit(1)).alias("size"), Summarizer.mean(F.col("__v")).alias("__m")).select(
        cluster, "size", vector_to_array("__m").alias("centroid")
    )


def distance_to_centroid(
    df: DataFrame, cents: DataFrame, cluster: str = "cluster", vec: str = "vec", name: str = "distance"
) -> DataFrame:
    joined = left_join(df, cents, cluster, {"centroid": "__centroid"})
    return joined.withColumn(name, euclid(vec, "__centroid")).drop("__centroid")


def distance_outliers(
    df: DataFrame, cluster: str = "cluster", distance: str = "distance", p: float = 0.9, name: str = "is_outlier",
    exact_rows: int = EXACT_ROWS,
) -> DataFrame:
    """Rows farther from their centroid than the p-quantile of their cluster."""
    edges = group_quantiles(df.select(cluster, distance), cluster, distance, [p], ["__edge"], exact_rows)
    joined = left_join(df, edges, cluster, null_safe=True)
    return joined.withColumn(name, F.coalesce(F.col(distance) > F.col("__edge"), F.lit(False))).drop("__edge")


def _as_array(cents: DataFrame, *cols: str) -> Column:
    return cents.agg(F.collect_list(F.struct(*cols)).alias("c")).select("c").scalar()


def assign_nearest(df: DataFrame, cents: DataFrame, cluster: str = "cluster", vec: str = "vec", name: str = "assigned") -> DataFrame:
    """Cluster of the nearest centroid, the smaller id on ties."""
    scored = F.transform(
        "__cents", lambda c: F.struct(sq_distance(F.col(vec), c["centroid"]).alias("d"), c[cluster].alias("k"))
    )
    listed = df.withColumn("__cents", _as_array(cents, cluster, "centroid"))
    return listed.withColumn(name, F.array_min(scored)["k"]).drop("__cents")


def _spread(df: DataFrame, cluster: str, vec: str) -> DataFrame:
    """Per cluster: size, centroid, mean distance and sum of squared distances."""
    cents = centroids(df, cluster, vec)
    d = distance_to_centroid(df.select(cluster, vec), cents, cluster, vec, "__d")
    agg = d.groupBy(cluster).agg(F.avg("__d").alias("mean_distance"), F.sum(F.col("__d") * F.col("__d")).alias("within"))
    return left_join(cents, agg, cluster)


def inertia(df: DataFrame, cluster: str = "cluster", vec: str = "vec", spread: DataFrame | None = None) -> DataFrame:
    return (_spread(df, cluster, vec) if spread is None else spread).agg(F.sum("within").alias("inertia"))


def calinski_harabasz(df: DataFrame, cluster: str = "cluster", vec: str = "vec", spread: DataFrame | None = None) -> DataFrame:
    """(between / (k - 1)) / (within / (n - k)). ``spread`` is that of the clusters where the caller has it."""
    s = _spread(df, cluster, vec) if spread is None else spread
    mean = s.agg(
        vector_to_array(Summarizer.mean(array_to_vector("centroid"), F.col("size").cast("double"))).alias("m")
    ).select("m").scalar()
    t = s.withColumn("__mean", mean).agg(
        F.sum(F.col("size") * sq_distance("centroid", "__mean")).alias("b"), F.sum("within").alias("w"),
        F.count(F.lit(1)).alias("k"), F.sum("size").alias("n"),
    )
    return t.select(
        share(F.col("b") * (F.col("n") - F.col("k")), F.col("w") * (F.col("k") - 1)).alias("calinski_harabasz")
    )


def davies_bouldin(df: DataFrame, cluster: str = "cluster", vec: str = "vec", spread: DataFrame | None = None) -> DataFrame:
    """Mean over clusters of the worst (s_i + s_j) / d_ij."""
    s = _spread(df, cluster, vec) if spread is None else spread
    others = F.filter("__all", lambda o: o[cluster] != F.col(cluster))
    # clusters with the same centroid have no ratio and count as 0
    worst = F.array_max(F.transform(others, lambda o: F.coalesce(F.try_divide(
        F.col("mean_distance") + o["mean_distance"], euclid(F.col("centroid"), o["centroid"])), F.lit(0.0))))
    listed = s.withColumn("__all", _as_array(s, cluster, "centroid", "mean_distance"))
    return listed.agg(F.avg(worst).alias("davies_bouldin"))


def silhouettes(
    df: DataFrame, id_col: str, clusters: Sequence[str], vec: str = "vec", block_rows: int = BLOCK_ROWS, prefix: str = "silhouette_"
) -> DataFrame:
    """Euclid silhouettes of every row in several clusterings, from one set of distances: (id, ``prefix`` + clustering, ...).

    Rows alone in their cluster get 0, rows in no cluster of a clustering NULL.
    """
    found, codes = cluster_silhouettes(df, id_col, vec, clusters, block_rows)
    numbers = [f"k{i}" for i in range(len(clusters))]
    rows = df.select(F.col(id_col).alias("rid"), F.col(vec).cast("array<double>").alias("vec"), *[c.alias(k) for c, k in zip(codes, numbers)])
    scores = [F.col(f"s{i}").alias(f"{prefix}{c}") for i, c in enumerate(clusters)]
    return beside(rows, found, ["vec", *numbers]).select(F.col("rid").alias(id_col), *scores)


def silhouette_samples(
    df: DataFrame, id_col: str, cluster: str = "cluster", vec: str = "vec", block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """Euclid silhouette of every row; rows alone in their cluster get 0."""
    found, (code,) = cluster_silhouettes(df, id_col, vec, [cluster], block_rows)
    rows = df.select(id_col, cluster, F.col(vec).cast("array<double>").alias("vec"), code.alias("k0")).where(F.col(cluster).isNotNull())
    return beside(rows, found, ["vec", "k0"]).select(id_col, cluster, F.col("s0").alias("silhouette"))


def silhouette(df: DataFrame, id_col: str, cluster: str = "cluster", vec: str = "vec", block_rows: int = BLOCK_ROWS) -> DataFrame:
    return silhouette_samples(df, id_col, cluster, vec, block_rows).agg(F.avg("silhouette").alias("silhouette"))


def mean_silhouettes(df: DataFrame, id_col: str, clusters: Sequence[str], vec: str = "vec") -> dict[str, float | None]:
    """Mean Euclid silhouette of several clusterings of the same rows."""
    row = silhouettes(df, id_col, clusters, vec, prefix="").agg(*[F.avg(c).alias(c) for c in clusters]).first()
    return row.asDict()


def silhouette_squared(df: DataFrame, cluster: str = "cluster", vec: str = "vec") -> DataFrame:
    """Silhouette on squared distances, linear in the rows.

    The mean squared distance from x to a cluster is |x - centroid|^2 plus the
    cluster's variance, so no pair of rows is ever looked at.
    """
    s = _spread(df, cluster, vec).withColumn("var", F.col("within") / F.col("size"))
    listed = _as_array(s, cluster, "centroid", "size", "var")
    means = F.transform("__all", lambda c: F.struct(
        c[cluster].alias("k"), c["size"].alias("n"), (sq_distance(F.col(vec), c["centroid"]) + c["var"]).alias("m")
    ))
    rows = df.where(F.col(cluster).isNotNull()).withColumn("__all", listed).select(cluster, means.alias("__m"))
    own = F.get(F.filter("__m", lambda c: c["k"] == F.col(cluster)), F.lit(0))
    b = F.array_min(F.transform(F.filter("__m", lambda c: c["k"] != F.col(cluster)), lambda c: c["m"]))
    a = own["m"] * own["n"] / (own["n"] - 1)
    value = F.when(own["n"] <= 1, F.lit(0.0)).otherwise(F.coalesce(F.try_divide(b - a, F.greatest(a, b)), F.lit(0.0)))
    return rows.agg(F.avg(value).alias("silhouette_squared"))


def quality_row(
    df: DataFrame, id_col: str, cluster: str = "cluster", vec: str = "vec", exact: bool = True, known: float | None = None
) -> DataFrame:
    """All internal measures in one row; ``known`` is the exact silhouette where the caller has it already."""
    if known is not None:
        score = df.sparkSession.range(1).select(F.lit(known).alias("silhouette"))
    else:
        score = silhouette(df, id_col, cluster, vec) if exact else silhouette_squared(df, cluster, vec)
    spread = materialise(_spread(df, cluster, vec))  # a row per cluster, for all measures
    parts = {
        "silhouette": score,
        "calinski_harabasz": calinski_harabasz(df, cluster, vec, spread),
        "davies_bouldin": davies_bouldin(df, cluster, vec, spread),
        "inertia": inertia(df, cluster, vec, spread),
    }
    long = reduce(DataFrame.unionByName, [
        p.select(F.lit(n).alias("metric"), F.col(p.columns[0]).alias("value")) for n, p in parts.items()
    ])
    return long.agg(*[F.max(F.when(F.col("metric") == n, F.col("value"))).alias(n) for n in parts])


def cluster_profile(df: DataFrame, cols: Sequence[str], cluster: str = "cluster") -> DataFrame:
    return group_means(df, cluster, cols)


def cluster_sizes(df: DataFrame, cluster: str = "cluster") -> DataFrame:
    counts = df.groupBy(cluster).agg(F.count(F.lit(1)).alias("rows"))
    total = counts.agg(F.sum("rows").alias("t")).select("t").scalar()
    return counts.withColumn("percent", F.col("rows") * 100.0 / total)


def flag_share_by_cluster(df: DataFrame, flag: str, cluster: str = "cluster") -> DataFrame:
    out = df.groupBy(cluster).agg(F.count_if(F.col(flag)).alias("flagged"), F.count(F.lit(1)).alias("rows"))
    return out.withColumn("percent", F.col("flagged") * 100.0 / F.col("rows"))


def name_clusters(df: DataFrame, names: dict[int, str], cluster: str = "cluster", name: str = "cluster_name") -> DataFrame:
    listed = F.create_map(*[F.lit(v) for pair in names.items() for v in pair])
    return df.withColumn(name, F.try_element_at(listed, F.col(cluster)))


def pca_project(df: DataFrame, cols: Sequence[str], k: int = 2, prefix: str = "pca_") -> tuple[DataFrame, list[float]]:
    """Centred projection on k components, signs fixed so the largest loading is positive.

    Returns the rows with their scores and the explained variance ratios.
    """
    cols = list(cols)
    row = df.agg(*[F.avg(c).alias(c) for c in cols]).first()
    centre = [float(row[c] or 0.0) for c in cols]
    flat = df.withColumns({f"__c_{i}": F.col(c).cast("double") - F.lit(m) for i, (c, m) in enumerate(zip(cols, centre))})
    packed = VectorAssembler(
        inputCols=[f"__c_{i}" for i in range(len(cols))], outputCol="__v", handleInvalid="skip"
    ).transform(flat)
    model = PCA(k=k, inputCol="__v", outputCol="__p").fit(packed)
    loadings = model.pc.toArray()
    signs = [1.0 if loadings[abs(loadings[:, j]).argmax(), j] >= 0 else -1.0 for j in range(k)]
    score = vector_to_array(F.col("__p"))
    out = model.transform(packed).withColumns(
        {f"{prefix}{j + 1}": F.get(score, F.lit(j)) * F.lit(s) for j, s in enumerate(signs)}
    )
    return out.select(*df.columns, *[f"{prefix}{j + 1}" for j in range(k)]), [float(v) for v in model.explainedVariance]


def best_k(table: DataFrame, metric: str = "silhouette", k: str = "k") -> DataFrame:
    """Row of the first best k; the table has one row per k."""
    w = Window.orderBy(F.desc_nulls_last(metric), F.asc(k))
    return table.withColumn("__r", F.row_number().over(w)).where(F.col("__r") == 1).drop("__r")
