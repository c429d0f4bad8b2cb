"""Model fitting, tuning, clustering and end-to-end flows."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import balance, cluster, entity, fold_statistics, metrics, models, split, ward
from ..plans import classification, defaults, laps, regression, scoring, segments
from ..session import materialise, scratch_folder
from . import roles as R
from .features import unit_sql
from .flow_sql import CLASSIFICATION_PREP, LAP_PREP, REGRESSION_PREP
from .registry import ORACLES, query, rounded, sql6
from .relational import regression_rows
from .roles import with_roles

ERA = (1995, 2001)
CUT = "2000-01-01"


def tables(spark, sf):
    facts = R.results(spark, sf)
    return {
        "results": facts.drop("date", "year", "round"), "schedule": R.schedule(spark, sf),
        "qualifying": R.qualifying(spark, sf), "driver_standings": R.driver_standings(spark, sf),
        "team_standings": R.team_standings(spark, sf), "circuits": R.circuits(spark, sf),
        "drivers": R.drivers(spark, sf), "teams": R.teams(spark, sf), "laps": R.laps(spark, sf),
        "calendar": R.calendar(spark, sf),
    }


# one feature: closed forms check the penalty mapping
_ONE = "s AS (SELECT count(*) AS n, regr_sxx(y, x) AS sxx, regr_sxy(y, x) AS sxy, avg(x) AS mx, avg(y) AS my FROM t)"
_XY = "t AS (SELECT position_order::DOUBLE AS y, points::DOUBLE AS x FROM entries)"


@query("linear_models", with_roles(f"""
WITH {_XY}, {_ONE} SELECT 'linear' AS model, {sql6('sxy / sxx', 'slope')}, {sql6('my - mx * sxy / sxx', 'intercept')} FROM s
UNION ALL SELECT 'ridge', {sql6('sxy / (sxx + 5000)', 'slope')}, {sql6('my - mx * sxy / (sxx + 5000)', 'intercept')} FROM s""", "entries"))
def linear_models(spark, sf):
    df = R.entries(spark, sf).select(F.col("position_order").cast("double").alias("label"), "points", F.lit("train").alias("split"))
    fitted = models.fit_regressors(df, ["points"], "label", names=("linear", "ridge"), params={"ridge": {"alpha": 5000.0}})
    rows = [(n, float(m.coefficients[0]), float(m.intercept)) for n, m in fitted.models.items()]
    return rounded(spark.createDataFrame(rows, "model string, slope double, intercept double"))


def _regression(spark, sf):
    return regression.encode_flow(regression.prepare(tables(spark, sf), ERA))


@query("regression_prep", REGRESSION_PREP)
def regression_prep(spark, sf):
    return rounded(_regression(spark, sf)[0])


@query("fit_regressors")
def fit_regressors(spark, sf):
    df, fitted = _regression(spark, sf)
    return models.fit_regressors(df, fitted.columns, "position").table.drop("seconds")


@query("regression_train")
def regression_train(spark, sf):
    """Fit all regressors, tune the best five over their grids, rank the tuned ones."""
    df, fitted = _regression(spark, sf)
    return regression.train(df, fitted.columns)[2].drop("seconds")


@query("classification_prep", CLASSIFICATION_PREP)
def classification_prep(spark, sf):
    return rounded(classification.encode_flow(classification.prepare(tables(spark, sf), CUT))[0])


@query("fit_classifiers")
def fit_classifiers(spark, sf):
    df, names = classification.encode_flow(classification.prepare(tables(spark, sf), CUT))
    df = classification.weighted(materialise(df))
    return models.fit_classifiers(df, names, "target", weight="weight").table.drop("seconds")


@query("classification_train")
def classification_train(spark, sf):
    """Balance, fit all classifiers, tune the best five over their grids, rank the tuned ones."""
    df, names = classification.encode_flow(classification.prepare(tables(spark, sf), CUT))
    return classification.train(df, names)[2].drop("seconds")


def _plain_rows(spark, sf):
    df = R.entries(spark, sf).where(F.col("position").isNotNull())
    df = df.select("result_id", F.col("position").cast("double").alias("y"), F.coalesce("grid", F.lit(20)).alias("grid"),
                   "points", "laps", "round")
    return split.split_hash(df, "result_id"), ["grid", "points", "laps", "round"]


@query("tune_regressor")
def tune_regressor(spark, sf):
    df, names = _plain_rows(spark, sf)
    df = df.where(F.col("split") == "train")
    grids = defaults.REGRESSION_GRIDS
    return models.tune_many(df, names, "y", list(grids), grids, "result_id")[1]


@query("tune_classifier")
def tune_classifier(spark, sf):
    df, names = _plain_rows(spark, sf)
    df = classification.weighted(materialise(df.withColumn("target", (F.col("y") <= 3).cast("double")).drop("y")))
    df = df.where(F.col("split") == "train")
    ratios = [r for r in balance.class_weight_ratio(df, "target").first() if r]
    grids = {n: {**g, "positive": ratios} if n in models.POSITIVE_WEIGHTED else g for n, g in defaults.CLASSIFICATION_GRIDS.items()}
    return models.tune_many(df, names, "target", list(grids), grids, "result_id", "classification", weight="weight")[1]


_ALPHAS = (0.01, 10.0, 5000.0)


# one feature: every penalty and held-out fold in closed form
@query("ridge_fold_scores", with_roles(f"""
WITH t AS (SELECT cast(floor({unit_sql('result_id', '42-fold')} * 5) AS INTEGER) AS fold, position_order::DOUBLE AS y, points::DOUBLE AS x
  FROM entries WHERE position_order IS NOT NULL AND points IS NOT NULL),
c AS (SELECT k.i AS held_out, fold = k.i AS test, count(*) AS n, avg(x) AS mx, avg(y) AS my, regr_sxx(y, x) AS sxx, regr_sxy(y, x) AS sxy, regr_syy(y, x) AS syy
  FROM t CROSS JOIN range(0, 5) k(i) GROUP BY ALL),
b AS (SELECT held_out, alpha, sxy / (sxx + alpha) AS b, my - mx * sxy / (sxx + alpha) AS a
  FROM c CROSS JOIN (SELECT unnest([0.01, 10.0, 5000.0])::DOUBLE AS alpha) WHERE NOT test)
SELECT alpha, cast(c.held_out AS INTEGER) AS held_out,
  {sql6('1 - (n * (my - a - b * mx) * (my - a - b * mx) + syy - 2 * b * sxy + b * b * sxx) / syy', 'r2')}
FROM b JOIN c ON c.held_out = b.held_out AND c.test""", "entries"))
def ridge_fold_scores(spark, sf):
    """R2 of every penalty on every held-out fold, from one pass over the rows."""
    df = R.entries(spark, sf).select("result_id", F.col("position_order").cast("double").alias("y"), F.col("points").cast("double").alias("x")).dropna()
    df = split.hash_folds(df, "result_id").withColumn("features", F.array("x"))
    parts = fold_statistics.moments(df, "features", "y", "fold")
    return rounded(spark.createDataFrame(fold_statistics.fold_scores(parts, "ridge", _ALPHAS, 5), "alpha double, held_out int, r2 double"))


@query("ward_segments", f"SELECT count(*) AS rows, 4::BIGINT AS clusters, true AS heights_rise FROM ({ORACLES['driver_features']})")
def ward_segments(spark, sf):
    """Drivers in four Ward clusters: rows that have one, clusters in use, and whether no merge is lower than one before."""
    df = segments.scaled_vectors(_profiles(spark, sf), entity.SEGMENT_FEATURES)
    tree = ward.linkage(df)
    heights = [h for _, _, h, _ in tree.merges]
    return tree.label(4).agg(F.count("cluster").alias("rows"), F.count_distinct("cluster").alias("clusters")).withColumn(
        "heights_rise", F.lit(all(a <= b for a, b in zip(heights, heights[1:]))))


@query("feature_importance")
def feature_importance(spark, sf):
    df, names = _plain_rows(spark, sf)
    fitted = models.fit_regressors(df, names, "y", names=("random_forest",))
    return models.feature_importance(fitted.models["random_forest"], names, 10)


@query("sample_then_full")
def sample_then_full(spark, sf):
    df, names = _plain_rows(spark, sf)
    return models.sample_then_full(df, names, "y", "result_id", names=models.REGRESSORS)[1].table.drop("seconds")


@query("learning_curve")
def learning_curve(spark, sf):
    df, names = _plain_rows(spark, sf)
    return models.learning_curve(df, names, "y", "result_id")


@query("lap_prep", LAP_PREP)
def lap_prep(spark, sf):
    t = tables(spark, sf)
    facts = R.results(spark, sf).select("race_id", "driver_id", "team_id", "grid", "position", "year")
    from ..operators.joins import left_join

    facts = left_join(facts, t["schedule"], "race_id", ["circuit_id"])
    return rounded(laps.prepare({**t, "results": facts}))


# --- scoring: fixed weights make it checkable -----------------------------------------

_W = {"grid": 2.0, "quali_position": 1.5, "driver_id": 0.5, "log_team_points": -1.0, "circuit_country_land 1": 0.25}
_SCORE_ROWS = """b AS (SELECT r.result_id, r.driver_id, r.grid, r.position, q.position AS qp, t.points AS tp, c.country
FROM results r LEFT JOIN schedule s ON r.race_id = s.race_id
LEFT JOIN qualifying q ON r.race_id = q.race_id AND r.driver_id = q.driver_id
LEFT JOIN team_standings t ON r.race_id = t.race_id AND r.team_id = t.team_id
LEFT JOIN circuits c ON s.circuit_id = c.circuit_id),
f AS (SELECT result_id, driver_id, coalesce(grid, qp, NULL)::DOUBLE AS grid, coalesce(qp, grid)::DOUBLE AS quali_position,
  ln(1 + tp) AS ltp, (country = 'land 1')::INT AS land1, position::DOUBLE AS position, result_id % 5 <> 0 AS is_train FROM b),
tr AS (SELECT * FROM f WHERE is_train AND position IS NOT NULL),
pr AS (SELECT avg(position) AS prior FROM tr),
te AS (SELECT driver_id, avg(position) AS m, 1 / (1 + exp(-(count(*) - 20.0::DOUBLE) / 10.0::DOUBLE)) AS w FROM tr GROUP BY 1),
e AS (SELECT f.result_id, is_train, position, coalesce(grid, 0) AS grid, coalesce(quali_position, 0) AS qp, coalesce(ltp, 0) AS ltp,
  coalesce(land1, 0) AS land1, coalesce(w * m + (1 - w) * prior, prior) AS enc FROM f CROSS JOIN pr LEFT JOIN te ON f.driver_id = te.driver_id),
st AS (SELECT avg(grid) AS ga, stddev_pop(grid) AS gs, avg(qp) AS qa, stddev_pop(qp) AS qs, avg(ltp) AS la, stddev_pop(ltp) AS ls,
  avg(land1) AS ca, stddev_pop(land1) AS cs, avg(enc) AS ea, stddev_pop(enc) AS es FROM e WHERE is_train AND position IS NOT NULL)"""
_PRED = """(9.0::DOUBLE + 2.0::DOUBLE * (({g}) - ga) / gs + 1.5::DOUBLE * (({q}) - qa) / qs + 0.5::DOUBLE * (enc - ea) / es
  - (ltp - la) / ls + 0.25::DOUBLE * (land1 - ca) / cs)"""
_INTERVAL = """cast(round_even(pred, 0) AS BIGINT) AS rounded, cast(greatest(1, floor(pred - 2.5)) AS BIGINT) AS low,
  cast(least(24, ceil(pred + 2.5)) AS BIGINT) AS high"""
_SCORE_ROLES = ("results", "schedule", "qualifying", "team_standings", "circuits")


def _score_setup(spark, sf):
    rows = materialise(regression_rows(spark, sf))
    ready = scoring.clean.with_defaults(rows, {"grid": "quali_position", "quali_position": "grid"}, {})
    train = scoring.features.advanced_features(ready).where(
        (F.col("result_id") % 5 != 0) & F.col("position").isNotNull()
    )
    fitted = regression.fit_encoders(train, "position", keys=("driver_id",), ignore=("result_id", "race_id", "laps"))
    return rows, fitted


@query("score_batch", with_roles(f"""
WITH {_SCORE_ROWS}, p AS (SELECT result_id, {_PRED.format(g='grid', q='qp')} AS pred FROM e, st)
SELECT result_id, {sql6('pred', 'pred')}, {_INTERVAL} FROM p""", *_SCORE_ROLES))
def score_batch(spark, sf):
    rows, fitted = _score_setup(spark, sf)
    return rounded(scoring.score_linear(rows, fitted, _W, 9.0, ["result_id"]))


@query("score_scenarios", with_roles(f"""
WITH {_SCORE_ROWS}, z AS (SELECT *, unnest(['base', 'front row', 'ten back']) AS scenario FROM f WHERE grid IS NOT NULL),
h AS (SELECT z.result_id, scenario, CASE scenario WHEN 'front row' THEN 1 WHEN 'ten back' THEN z.grid + 10 ELSE z.grid END AS g,
  coalesce(z.quali_position, CASE scenario WHEN 'front row' THEN 1 WHEN 'ten back' THEN z.grid + 10 ELSE z.grid END) AS q,
  e.ltp, e.land1, e.enc FROM z JOIN e ON z.result_id = e.result_id),
p AS (SELECT result_id, scenario, {_PRED.format(g='g', q='q')} AS pred FROM h, st)
SELECT result_id, scenario, {sql6('pred', 'pred')}, {_INTERVAL} FROM p""", *_SCORE_ROLES))
def score_scenarios(spark, sf):
    rows, fitted = _score_setup(spark, sf)
    rows = scoring.clean.with_defaults(rows, {"grid": "quali_position", "quali_position": "grid"}, {})
    rows = rows.where(F.col("grid").isNotNull())
    both = scoring.with_scenarios(rows, {"base": {}, "front row": {"grid": F.lit(1)}, "ten back": {"grid": F.col("grid") + 10}})
    return rounded(scoring.score_linear(both, fitted, _W, 9.0, ["result_id", "scenario"]))


@query("score_saved_model", with_roles(f"""
WITH {_XY}, {_ONE} SELECT result_id, {sql6('my + (coalesce(points, 0) - mx) * sxy / sxx', 'pred')} FROM entries CROSS JOIN s""", "entries"))
def score_saved_model(spark, sf):
    """Fit, save, load and score: every row by the model that came back from its folder."""
    rows = R.entries(spark, sf).select("result_id", F.col("position_order").cast("double").alias("label"), "points", F.lit("train").alias("split"))
    model = models.fit_regressors(rows, ["points"], "label", names=("linear",)).models["linear"]
    again = models.load_model(spark, models.save_model(model, scratch_folder(spark), "1"))
    scored = again.transform(models.assemble(rows, ["points"], ["result_id"]))
    return rounded(scored.select("result_id", F.col("prediction").alias("pred")))


# --- clustering --------------------------------------------------------------------------

def _profiles(spark, sf):
    return entity.driver_features(R.entries(spark, sf), R.drivers(spark, sf), 12)


@query("kmeans_fit")
def kmeans_fit(spark, sf):
    _, rows = segments.train_segments(_profiles(spark, sf), entity.SEGMENT_FEATURES, 3)
    return rows.select("driver_id", "cluster")


# any k-means result puts each row with its nearest centre; SQL states the counts
@query("kmeans_nearest", f"SELECT count(*) AS rows, true AS within_k, 0::BIGINT AS misplaced FROM ({ORACLES['driver_features']})")
def kmeans_nearest(spark, sf):
    model, rows = segments.train_segments(_profiles(spark, sf), entity.SEGMENT_FEATURES, 3)
    return segments.misplaced(model, rows)


@query("team_segments", f"SELECT count(*) AS rows, true AS within_k, 0::BIGINT AS misplaced FROM ({ORACLES['constructor_features']})")
def team_segments(spark, sf):
    """Teams, scaled robustly and clustered into three."""
    model, rows = segments.train_segments(entity.constructor_features(R.results(spark, sf), R.teams(spark, sf)), entity.TEAM_FEATURES, 3)
    return segments.misplaced(model, rows)


@query("team_sweep")
def team_sweep(spark, sf):
    """Internal measures of the team clusters for k 3 to 7."""
    df = segments.scaled_vectors(entity.constructor_features(R.results(spark, sf), R.teams(spark, sf)), entity.TEAM_FEATURES)
    return rounded(segments.sweep(df, "team_id", range(3, 8)))


@query("pca_2d")
def pca_2d(spark, sf):
    rows, _ = cluster.pca_project(_profiles(spark, sf), entity.SEGMENT_FEATURES)
    return rounded(rows.select("driver_id", "pca_1", "pca_2"))


@query("explained_variance", with_roles(f"""
WITH c AS (SELECT var_samp(position_order) AS a, var_samp(laps) AS b, covar_samp(position_order, laps) AS k FROM entries),
l AS (SELECT (a + b) / 2 + sqrt((a - b) * (a - b) / 4 + k * k) AS hi, a + b AS s FROM c)
SELECT unnest([1, 2]) AS component, round(unnest([hi / s, 1 - hi / s]), 6) + 0.0 AS explained FROM l""", "entries"))
def explained_variance(spark, sf):
    _, shares = cluster.pca_project(R.entries(spark, sf).select("position_order", "laps"), ["position_order", "laps"])
    return rounded(spark.createDataFrame(list(enumerate(shares, 1)), "component int, explained double"))


@query("cluster_sweep")
def cluster_sweep(spark, sf):
    df = segments.scaled_vectors(_profiles(spark, sf), entity.SEGMENT_FEATURES)
    return rounded(segments.sweep(df, "driver_id", range(3, 10)))


@query("cluster_report")
def cluster_report(spark, sf):
    _, rows = segments.train_segments(_profiles(spark, sf), entity.SEGMENT_FEATURES, 3)
    return rounded(segments.evaluate_segments(rows, "driver_id", entity.SEGMENT_FEATURES)[1])


@query("hierarchical_check")
def hierarchical_check(spark, sf):
    df = segments.scaled_vectors(_profiles(spark, sf), entity.SEGMENT_FEATURES)
    return rounded(segments.hierarchical_check(df, "driver_id"))


@query("driver_anomalies")
def driver_anomalies(spark, sf):
    _, rows = segments.train_segments(_profiles(spark, sf), entity.SEGMENT_FEATURES, 3)
    out = segments.detect_anomalies(rows, "driver_id")
    return out.select("driver_id", "cluster", "anomaly_votes", "is_anomaly_final")


_F_RATIO = """g AS (SELECT k, vec_id % k AS c, count(*) AS n, avg(v) AS m, var_pop(v) * count(*) AS w
  FROM (SELECT vec_id, vec[1] AS v FROM vectors), range(2, 7) r(k) GROUP BY 1, 2),
t AS (SELECT k, sum(n) AS n, sum(w) AS w, sum(n * m) / sum(n) AS gm FROM g GROUP BY 1),
ch AS (SELECT cast(g.k AS INTEGER) AS k, sum(g.n * (m - gm) * (m - gm)) / (g.k - 1) / (max(t.w) / (max(t.n) - g.k)) AS score
  FROM g JOIN t ON g.k = t.k GROUP BY g.k)"""


@query("best_k", with_roles(f"WITH {_F_RATIO} SELECT k, {sql6('score', 'score')} FROM ch ORDER BY score DESC, k LIMIT 1", "vectors"))
def best_k(spark, sf):
    """Best of five groupings of the first coordinate by their between/within ratio."""
    first = F.get("vec", F.lit(0))
    rows = R.vectors(spark, sf).select("vec_id", first.alias("v"), F.explode(F.sequence(F.lit(2), F.lit(6))).alias("k"))
    g = rows.groupBy("k", F.col("vec_id") % F.col("k")).agg(
        F.count(F.lit(1)).alias("n"), F.avg("v").alias("m"), F.var_pop("v").alias("w"))
    t = g.groupBy("k").agg(
        F.sum("n").alias("n"), F.sum(F.col("w") * F.col("n")).alias("within"),
        (F.sum(F.col("n") * F.col("m") * F.col("m")) - F.sum(F.col("n") * F.col("m")) ** 2 / F.sum("n")).alias("between"))
    score = F.col("between") / (F.col("k") - 1) / (F.col("within") / (F.col("n") - F.col("k")))
    return rounded(cluster.best_k(t.select("k", score.alias("score")), "score"))


@query("best_row", f"""
SELECT o_orderpriority, o_orderkey, o_totalprice FROM orders
QUALIFY row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_totalprice DESC, o_orderkey) = 1""")
def best_row(spark, sf):
    from ..sources.tables import read_table

    df = read_table(spark, sf, "orders").select("o_orderpriority", "o_orderkey", "o_totalprice")
    return metrics.best_row(df, "o_totalprice", ["o_orderpriority"], tie="o_orderkey")


