"""Segmentation flow: profiles, robust scaling, clusters, quality, anomalies."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import anomaly, cluster, kmeans, scale, ward
from ..session import materialise


def scaled_vectors(df: DataFrame, cols: Sequence[str], name: str = "vec") -> DataFrame:
    """Robust-scaled copy of the columns as one vector; the columns stay as they are."""
    fitted = scale.fit_robust(df, cols)
    parts = [(F.col(c) - F.lit(m)) / F.lit(fitted.width[c]) for c, m in fitted.centre.items()]
    return df.withColumn(name, F.array(*[F.coalesce(p.cast("double"), F.lit(0.0)) for p in parts]))


def fit_kmeans(df: DataFrame, k: int, vec: str = "vec", seed: int = 42, restarts: int = 10) -> kmeans.Centres:
    """Best of several seeded starts by cost, all of them in common scans."""
    return kmeans.fit_many(df, [k], vec, seed, restarts)[k]


def label_rows(model: kmeans.Centres, df: DataFrame, vec: str = "vec", name: str = "cluster") -> DataFrame:
    return df.withColumn(name, model.nearest(F.col(vec).cast("array<double>")))


def sweep(
    df: DataFrame, id_col: str, ks: Iterable[int], vec: str = "vec", seed: int = 42, restarts: int = 10, exact: bool = True
) -> DataFrame:
    """Internal measures for every k, whose starts all take part in the same scans.

    ``exact`` uses the Euclid silhouette, quadratic in the rows and meant for
    entity tables; otherwise the squared one, which is linear.
    """
    df, rows = materialise(df), []
    models = kmeans.fit_many(df, list(ks), vec, seed, restarts)
    labelled = df.select(id_col, vec)
    for k, model in models.items():
        labelled = label_rows(model, labelled, vec, f"k_{k}")
    labelled = materialise(labelled)
    known = cluster.mean_silhouettes(labelled, id_col, [f"k_{k}" for k in models], vec) if exact else {}
    for k in models:
        own = labelled.select(id_col, vec, F.col(f"k_{k}").alias("cluster"))
        row = cluster.quality_row(own, id_col, "cluster", vec, exact, known.get(f"k_{k}")).first()
        rows.append((k, row["silhouette"], row["calinski_harabasz"], row["davies_bouldin"], row["inertia"]))
    return df.sparkSession.createDataFrame(
        rows, "k int, silhouette double, calinski_harabasz double, davies_bouldin double, inertia double"
    )


def hierarchical_check(df: DataFrame, id_col: str, k: int = 4, vec: str = "vec", seed: int = 42) -> DataFrame:
    """Silhouette of Ward clusters beside k-means, from one set of distances."""
    df = materialise(df.select(id_col, vec))
    both = label_rows(fit_kmeans(df, k, vec, seed), ward.linkage(df, vec, seed=seed).label(k, "ward"), vec, "kmeans")
    found = cluster.mean_silhouettes(materialise(both), id_col, ["ward", "kmeans"], vec)
    return df.sparkSession.createDataFrame([(found[m], m) for m in ("ward", "kmeans")], "silhouette double, method string")


def train_segments(
    profiles: DataFrame, cols: Sequence[str], k: int = 3, seed: int = 42, restarts: int = 10
) -> tuple[kmeans.Centres, DataFrame]:
    """Model and profiles with cluster, scaled vector and two principal components."""
    df = materialise(scaled_vectors(materialise(profiles), cols))
    model = fit_kmeans(df, k, "vec", seed, restarts)
    labelled = label_rows(model, df)
    wide = labelled.select("*", *[F.get("vec", F.lit(i)).alias(f"__s_{i}") for i in range(len(cols))])
    projected, _ = cluster.pca_project(wide, [f"__s_{i}" for i in range(len(cols))])
    return model, projected.drop(*[f"__s_{i}" for i in range(len(cols))])


def evaluate_segments(labelled: DataFrame, id_col: str, cols: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Quality row and mean profile per cluster."""
    return cluster.quality_row(labelled, id_col), cluster.cluster_profile(labelled, cols)


def detect_anomalies(labelled: DataFrame, id_col: str, seed: int = 42, neighbours: int = 20) -> DataFrame:
    """Isolation, distance and density flags with their vote.

    Later steps fit thresholds on the columns of earlier ones, so the table is
    written between them.
    """
    df = materialise(anomaly.isolation_scores(labelled, id_col, seed=seed))
    df = anomaly.flag_lowest(df, "isolation_score", name="is_anomaly_isolation")
    df = cluster.distance_to_centroid(df, cluster.centroids(df), name="distance_to_centroid")
    df = cluster.distance_outliers(df, distance="distance_to_centroid", name="is_anomaly_distance")
    df = materialise(anomaly.lof_scores(materialise(df), id_col, k=neighbours))
    df = anomaly.flag_lowest(df, "lof_score", name="is_anomaly_lof")
    return anomaly.consensus(df, ("is_anomaly_isolation", "is_anomaly_distance", "is_anomaly_lof"))


def misplaced(model: kmeans.Centres, labelled: DataFrame) -> DataFrame:
    """One row: labelled rows, whether at most k clusters are used, and rows that are not with their nearest centre."""
    centres = labelled.sparkSession.createDataFrame(
        [(i, [float(x) for x in c]) for i, c in enumerate(model.clusterCenters())], "cluster long, centroid array<double>"
    )
    near = cluster.assign_nearest(labelled, centres)
    return near.agg(
        F.count(F.lit(1)).alias("rows"), (F.count_distinct("cluster") <= model.getK()).alias("within_k"),
        F.count_if(F.col("assigned") != F.col("cluster")).alias("misplaced"),
    )
