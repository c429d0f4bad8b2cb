"""Metrics, rankings, reports, profiling: queries and oracle SQL."""

from __future__ import annotations

import itertools

from pyspark.sql import functions as F

from ..operators import metrics, profile
from ..session import scratch_folder
from ..sources import tables as src
from . import roles as R
from .registry import query, rounded, sql6
from .roles import with_roles


# --- regression metrics -----------------------------------------------------------

def _split_predictions(spark, sf):
    return R.predicted(spark, sf).withColumn("split", F.when(F.col("result_id") % 5 == 0, "test").otherwise("train"))


_REG = """count(*) AS rows, 1 - sum((y - pred) ** 2) / (var_pop(y) * count(*)) AS r2,
  avg(abs(y - pred)) AS mae, sqrt(avg((y - pred) ** 2)) AS rmse"""
_SPLIT = "s AS (SELECT *, CASE WHEN result_id % 5 = 0 THEN 'test' ELSE 'train' END AS split FROM predicted)"


@query("metrics_regression", with_roles(f"""
WITH {_SPLIT} SELECT split, rows, {sql6('r2', 'r2')}, {sql6('mae', 'mae')}, {sql6('rmse', 'rmse')}
FROM (SELECT split, {_REG} FROM s GROUP BY 1)""", "predicted"))
def metrics_regression(spark, sf):
    return rounded(metrics.regression_metrics(_split_predictions(spark, sf), "y", "pred", ["split"]))


@query("residual_stats", with_roles(f"""
SELECT {sql6('avg(y - pred)', 'mean_residual')}, {sql6('stddev_samp(y - pred)', 'std_residual')},
  {sql6('median(y - pred)', 'median_residual')} FROM predicted""", "predicted"))
def residual_stats(spark, sf):
    return rounded(metrics.residual_stats(R.predicted(spark, sf), "y", "pred"))


def model_predictions(spark, sf):
    """Predictions of four simple models over the classified entries, in long form."""
    e = R.entries(spark, sf).where(F.col("position").isNotNull())
    grid = F.coalesce(F.col("grid"), F.lit(20))
    options = {
        "grid_only": grid * 1.0, "middle": F.lit(12.5), "near_exact": F.col("position") * 0.9 + 1.0,
        "blend": F.col("position") * 0.5 + grid * 0.25 + 3.0,
    }
    models = F.array(*[F.struct(F.lit(n).alias("model"), p.cast("double").alias("pred")) for n, p in options.items()])
    return e.select(
        "result_id", F.col("position").cast("double").alias("y"), F.explode(models).alias("m"),
        F.when(F.col("result_id") % 5 == 0, "test").otherwise("train").alias("split"),
    ).select("result_id", "y", "split", "m.*")


_MODELS = """e AS (SELECT result_id, position, coalesce(grid, 20) AS g FROM entries WHERE position IS NOT NULL),
m AS (SELECT result_id, position::DOUBLE AS y, 'grid_only' AS model, g * 1.0::DOUBLE AS pred FROM e
  UNION ALL SELECT result_id, position::DOUBLE, 'middle', 12.5::DOUBLE FROM e
  UNION ALL SELECT result_id, position::DOUBLE, 'near_exact', position * 0.9::DOUBLE + 1.0::DOUBLE FROM e
  UNION ALL SELECT result_id, position::DOUBLE, 'blend', position * 0.5::DOUBLE + g * 0.25::DOUBLE + 3.0::DOUBLE FROM e),
k AS (SELECT model, CASE WHEN result_id % 5 = 0 THEN 'test' ELSE 'train' END AS split,
  1 - sum((y - pred) ** 2) / (var_pop(y) * count(*)) AS r2, avg(abs(y - pred)) AS mae, sqrt(avg((y - pred) ** 2)) AS rmse
  FROM m GROUP BY 1, 2),
t AS (SELECT model, max(r2) FILTER (WHERE split = 'train') AS r2_train, max(r2) FILTER (WHERE split = 'test') AS r2_test,
  max(mae) FILTER (WHERE split = 'test') AS mae_test, max(rmse) FILTER (WHERE split = 'test') AS rmse_test FROM k GROUP BY 1)"""
_T_COLS = ", ".join(sql6(c, c) for c in ("r2_train", "r2_test", "mae_test", "rmse_test")) + ", " + sql6(
    "r2_train - r2_test", "overfit_gap")


def _model_table(spark, sf):
    return metrics.overfit_table(model_predictions(spark, sf), "y", "pred", by=["model"])


@query("rank_models", with_roles(f"""
WITH {_MODELS} SELECT model, {_T_COLS}, cast(row_number() OVER (ORDER BY r2_test DESC, model) AS INTEGER) AS rank FROM t""", "entries"))
def rank_models(spark, sf):
    return rounded(metrics.rank_models(_model_table(spark, sf), "r2_test"))


@query("top_models", with_roles(f"""
WITH {_MODELS} SELECT model, {sql6('r2_test', 'r2_test')} FROM t ORDER BY r2_test DESC, model LIMIT 5""", "entries"))
def top_models(spark, sf):
    ranked = metrics.rank_models(_model_table(spark, sf), "r2_test")
    return rounded(ranked.where(F.col("rank") <= 5).select("model", "r2_test"))


@query("best_model", with_roles(f"""
WITH {_MODELS} SELECT model, {_T_COLS} FROM t ORDER BY r2_test DESC, model LIMIT 1""", "entries"))
def best_model(spark, sf):
    return rounded(metrics.best_row(_model_table(spark, sf), "r2_test", tie="model"))


@query("metrics_json", with_roles(f"""
WITH {_MODELS} SELECT model, {_T_COLS} FROM t""", "entries"))
def metrics_json(spark, sf):
    """Metric table through the JSON sink and back."""
    table = rounded(_model_table(spark, sf))
    path = scratch_folder(spark)
    src.write_metrics_json(table, path)
    return spark.read.schema(table.schema).json(path)


@query("goal_checks", with_roles(f"""
WITH {_MODELS} SELECT model, {_T_COLS}, r2_test >= 0.8 AS meets_goal, {sql6('0.8::DOUBLE - r2_test', 'gap_to_goal')},
  r2_test > 0.5 AND r2_train - r2_test < 0.15 AS viable FROM t""", "entries"))
def goal_checks(spark, sf):
    return rounded(metrics.goal_checks(_model_table(spark, sf)))


# --- classification metrics ----------------------------------------------------------

@query("metrics_classification", with_roles(f"""
SELECT count(*) AS rows, {sql6('tp / s', 'precision')}, {sql6('tp / p', 'recall')}, {sql6('2 * tp / (p + s)', 'f1')},
  {sql6('ok / n', 'accuracy')}
FROM (SELECT count(*) FILTER (WHERE label = 1 AND pred = 1) AS tp, sum(label) AS p, sum(pred) AS s,
  count(*) FILTER (WHERE label = pred) AS ok, count(*) AS n FROM scored), scored GROUP BY tp, p, s, ok, n""", "scored"))
def metrics_classification(spark, sf):
    return rounded(metrics.binary_metrics(R.scored(spark, sf), "label", "pred"))


_RUNS = """d AS (SELECT score, sum(label) AS pos, sum(1 - label) AS neg FROM scored GROUP BY 1),
c AS (SELECT *, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp FROM d WINDOW w AS (ORDER BY score DESC)),
n AS (SELECT sum(pos) AS p, sum(neg) AS n FROM d)"""


@query("roc_auc", with_roles(f"""
WITH r AS (SELECT label, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2.0::DOUBLE AS rk FROM scored)
SELECT {sql6('(sum(rk) FILTER (WHERE label = 1) - p * (p + 1) / 2.0::DOUBLE) / (p * q::DOUBLE)', 'roc_auc')},
  p AS positives, q AS negatives
FROM r, (SELECT cast(sum(label) AS BIGINT) AS p, cast(sum(1 - label) AS BIGINT) AS q FROM scored) GROUP BY p, q""", "scored"))
def roc_auc(spark, sf):
    return rounded(metrics.roc_auc(R.scored(spark, sf), "label", "score"))


@query("roc_curve", with_roles(f"""
WITH {_RUNS} SELECT score AS threshold, {sql6('fp / n.n', 'fpr')}, {sql6('tp / n.p', 'tpr')} FROM c, n""", "scored"))
def roc_curve(spark, sf):
    return rounded(metrics.roc_curve(R.scored(spark, sf), "label", "score"), ("threshold",))


@query("pr_curve", with_roles(f"""
WITH {_RUNS} SELECT score AS threshold, {sql6('tp / (tp + fp)', 'precision')}, {sql6('tp / n.p', 'recall')} FROM c, n""", "scored"))
def pr_curve(spark, sf):
    return rounded(metrics.pr_curve(R.scored(spark, sf), "label", "score"), ("threshold",))


@query("average_precision", with_roles(f"""
WITH {_RUNS} SELECT {sql6('sum(pos * tp / (tp + fp)) / max(n.p)', 'average_precision')} FROM c, n""", "scored"))
def average_precision(spark, sf):
    return rounded(metrics.average_precision(R.scored(spark, sf), "label", "score"))


@query("roc_null_scores", with_roles(f"""
WITH g AS (SELECT CASE WHEN event_id % 10 <> 0 THEN score END AS score, label FROM scored),
s AS (SELECT score, count(*) FILTER (WHERE label = 1) AS pos, count(*) FILTER (WHERE label <> 1) AS neg FROM g GROUP BY 1),
c AS (SELECT score, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp FROM s WINDOW w AS (ORDER BY score DESC NULLS LAST)),
n AS (SELECT sum(pos) AS p, sum(neg) AS n FROM s)
SELECT score AS threshold, {sql6('fp / n.n', 'fpr')}, {sql6('tp / n.p', 'tpr')} FROM c, n""", "scored"))
def roc_null_scores(spark, sf):
    """The curve in many bins, over scores of which some are NULL (the lowest threshold)."""
    rows = R.scored(spark, sf).withColumn("score", F.when(F.col("event_id") % 10 != 0, F.col("score")))
    return rounded(metrics.roc_curve(rows, "label", "score", rows_per_bin=300), ("threshold",))


@query("confusion_matrix", with_roles("SELECT label, pred, count(*) AS rows FROM scored GROUP BY 1, 2", "scored"))
def confusion_matrix(spark, sf):
    return metrics.confusion(R.scored(spark, sf), "label", "pred")


@query("classification_report", with_roles(f"""
WITH k AS (SELECT c, count(*) FILTER (WHERE label = c AND pred = c) AS tp, count(*) FILTER (WHERE label = c) AS r,
    count(*) FILTER (WHERE pred = c) AS s FROM scored CROSS JOIN (SELECT unnest([0, 1]) AS c) GROUP BY 1),
f AS (SELECT c::VARCHAR AS class, tp / s AS precision, tp / r AS recall, 2 * tp / (r + s) AS f1, r AS support FROM k),
u AS (SELECT * FROM f UNION ALL SELECT 'macro avg', avg(precision), avg(recall), avg(f1), cast(sum(support) AS BIGINT) FROM f
  UNION ALL SELECT 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support),
  sum(f1 * support) / sum(support), cast(sum(support) AS BIGINT) FROM f)
SELECT class, {sql6('precision', 'precision')}, {sql6('recall', 'recall')}, {sql6('f1', 'f1')}, support FROM u""", "scored"))
def classification_report(spark, sf):
    return rounded(metrics.classification_report(R.scored(spark, sf), "label", "pred"))


@query("class_weight_ratio", with_roles(f"""
SELECT {sql6('n / p', 'ratio')}, {sql6('n / p * 0.8::DOUBLE', 'ratio_low')}, {sql6('n / p * 1.2::DOUBLE', 'ratio_high')}
FROM (SELECT sum(label) AS p, sum(1 - label) AS n FROM scored)""", "scored"))
def class_weight_ratio(spark, sf):
    from ..operators.balance import class_weight_ratio as ratio

    return rounded(ratio(R.scored(spark, sf), "label"))


@query("class_weights", with_roles(f"""
SELECT event_id, label, {sql6('count(*) OVER () / (2.0::DOUBLE * count(*) OVER (PARTITION BY label))', 'weight')} FROM scored""", "scored"))
def class_weights(spark, sf):
    from ..operators.balance import class_weights as weights

    return rounded(weights(R.scored(spark, sf).select("event_id", "label"), "label"))


@query("smote_target_count", with_roles("""
SELECT maj AS majority, mi AS minority, cast(greatest(floor(0.9::DOUBLE * maj) - mi, 0) AS BIGINT) AS synthetic
FROM (SELECT max(n) AS maj, min(n) AS mi FROM (SELECT count(*) AS n FROM scored GROUP BY label))""", "scored"))
def smote_target_count(spark, sf):
    from ..operators.balance import smote_target_count as count

    return count(R.scored(spark, sf), "label", 0.9)


# --- reports -----------------------------------------------------------------------

_BY_ERA = "e AS (SELECT p.*, year FROM predicted p JOIN entries USING (result_id))"


def _era_metrics(spark, sf, keep):
    years = R.entries(spark, sf).select("result_id", "year")
    df = R.predicted(spark, sf).join(years, "result_id").where(keep)
    return metrics.as_long(metrics.regression_metrics(df, "y", "pred"), ["r2", "mae", "rmse"])


def _long_sql(where: str) -> str:
    return f"""(SELECT unnest(['r2', 'mae', 'rmse']) AS metric, unnest([r2, mae, rmse]) AS value
FROM (SELECT {_REG} FROM e WHERE {where}))"""


@query("metric_delta", with_roles(f"""
WITH {_BY_ERA}, c AS {_long_sql('year >= 1999')}, p AS {_long_sql('year < 1999')}
SELECT c.metric, {sql6('c.value', 'current')}, {sql6('p.value', 'previous')}, {sql6('c.value - p.value', 'delta')},
  c.value - p.value > 0 AS improved FROM c LEFT JOIN p ON c.metric = p.metric""", "predicted", "entries"))
def metric_delta(spark, sf):
    now = _era_metrics(spark, sf, F.col("year") >= 1999)
    before = _era_metrics(spark, sf, F.col("year") < 1999)
    return rounded(metrics.metric_delta(now, before))


@query("consolidated_report", with_roles(f"""
WITH x AS (SELECT unnest(['clustering', 'regression', 'ties']) AS flow),
m AS (SELECT 'regression' AS flow, {_REG} FROM predicted
  UNION ALL SELECT 'ties', {_REG} FROM predicted WHERE y = pred HAVING count(*) > 0)
SELECT x.flow, rows, {sql6('r2', 'r2')}, {sql6('mae', 'mae')}, {sql6('rmse', 'rmse')},
  CASE WHEN m.flow IS NULL THEN 'FAILED' ELSE 'SUCCESS' END AS status FROM x LEFT JOIN m ON x.flow = m.flow""", "predicted"))
def consolidated_report(spark, sf):
    df = R.predicted(spark, sf)
    flows = spark.createDataFrame([("clustering",), ("regression",), ("ties",)], "flow string")
    a = metrics.regression_metrics(df, "y", "pred").withColumn("flow", F.lit("regression"))
    b = metrics.regression_metrics(df.where(F.col("y") == F.col("pred")), "y", "pred").where(F.col("rows") > 0)
    return rounded(metrics.consolidated_report(flows, a.unionByName(b.withColumn("flow", F.lit("ties")))))


# --- profiling ------------------------------------------------------------------------

_DESC = ("l_quantity", "l_extendedprice", "l_discount")


@query("describe_numeric", " UNION ALL ".join(f"""
SELECT '{c}' AS column_name, count({c}) AS count, {sql6(f'avg({c})', 'mean')}, {sql6(f'stddev_samp({c})', 'std')},
  {sql6(f'min({c})', 'min')}, {sql6(f'quantile_cont({c}, 0.25)', 'p25')}, {sql6(f'quantile_cont({c}, 0.5)', 'p50')},
  {sql6(f'quantile_cont({c}, 0.75)', 'p75')}, {sql6(f'max({c})', 'max')} FROM lineitem""" for c in _DESC))
def describe_numeric(spark, sf):
    return rounded(profile.describe_numeric(src.read_table(spark, sf, "lineitem"), _DESC))


@query("null_profile", with_roles(f"""
SELECT * FROM (SELECT 'grid' AS column_name, count(*) FILTER (WHERE grid IS NULL) AS nulls,
  {sql6('count(*) FILTER (WHERE grid IS NULL) * 100.0 / count(*)', 'percent')} FROM entries
UNION ALL SELECT 'position', count(*) FILTER (WHERE position IS NULL),
  round(count(*) FILTER (WHERE position IS NULL) * 100.0 / count(*), 6) + 0.0 FROM entries) WHERE nulls > 0""", "entries"))
def null_profile(spark, sf):
    return rounded(profile.null_profile(R.entries(spark, sf)))


@query("type_profile", " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, '{t}' AS type, count({c}) AS non_null FROM orders"
    for c, t in (("o_orderkey", "bigint"), ("o_custkey", "bigint"), ("o_orderstatus", "string"),
                 ("o_totalprice", "double"), ("o_orderdate", "timestamp"), ("o_orderpriority", "string"))))
def type_profile(spark, sf):
    df = src.read_table(spark, sf, "orders")
    kinds = F.when(F.col("type") == "timestamp_ntz", "timestamp").otherwise(F.col("type"))
    return profile.type_profile(df).withColumn("type", kinds)


@query("outlier_filter_iqr", """
SELECT event_id, value FROM events, (SELECT quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM events)
WHERE value BETWEEN q1 - 3 * (q3 - q1) AND q3 + 3 * (q3 - q1)""")
def outlier_filter_iqr(spark, sf):
    return profile.drop_outliers_iqr(src.read_table(spark, sf, "events").select("event_id", "value"), "value")


@query("target_checks", with_roles(f"""
WITH s AS (SELECT count(*) FILTER (WHERE position IS NULL) / count(*) AS nulls, count(DISTINCT position) AS d FROM entries)
SELECT 'numeric' AS check, 1.0::DOUBLE AS value, true AS ok UNION ALL SELECT 'null_share', round(nulls, 6), nulls < 0.1 FROM s
UNION ALL SELECT 'distinct', d::DOUBLE, d > 100 FROM s""", "entries"))
def target_checks(spark, sf):
    return rounded(profile.target_checks(R.entries(spark, sf), "position"))


@query("quality_checks", with_roles(f"""
WITH s AS (SELECT count(*) AS n, count(*) - count(race_id) + count(*) - count(lap) AS nulls,
  stddev_samp(milliseconds) / avg(milliseconds) AS cv, count(*) FILTER (WHERE milliseconds NOT BETWEEN 30000 AND 300000) AS o,
  count(DISTINCT milliseconds) AS d FROM laps),
u AS (SELECT count(*) AS k FROM (SELECT DISTINCT * FROM laps))
SELECT 'duplicates' AS check, (n - k)::DOUBLE AS value, n = k AS ok FROM s, u
UNION ALL SELECT 'critical_nulls', nulls::DOUBLE, nulls = 0 FROM s
UNION ALL SELECT 'variation', round(cv, 6), cv > 0.05 AND cv < 1 FROM s
UNION ALL SELECT 'numeric_columns', 4.0, true UNION ALL SELECT 'out_of_range', o::DOUBLE, o = 0 FROM s
UNION ALL SELECT 'rows', n::DOUBLE, n > 10000 FROM s UNION ALL SELECT 'distinct_target', d::DOUBLE, d > 100 FROM s""", "laps"))
def quality_checks(spark, sf):
    return rounded(profile.quality_checks(R.laps(spark, sf), "milliseconds", ["race_id", "lap", "absent"]))


_CORR = ("grid", "position", "position_order", "points", "laps")


@query("corr_matrix", with_roles(" UNION ALL ".join(
    f"SELECT '{a}' AS left_column, '{b}' AS right_column, {sql6(f'corr({a}, {b})', 'corr')} FROM entries"
    for a, b in itertools.combinations_with_replacement(_CORR, 2)), "entries"))
def corr_matrix(spark, sf):
    return rounded(profile.corr_matrix(R.entries(spark, sf), _CORR))


@query("corr_matrix_complete", with_roles(" UNION ALL ".join(
    f"SELECT '{a}' AS left_column, '{b}' AS right_column, {sql6(f'corr({a}, {b})', 'corr')} FROM entries "
    "WHERE grid IS NOT NULL AND position IS NOT NULL"
    for a, b in itertools.combinations_with_replacement(_CORR, 2)), "entries"))
def corr_matrix_complete(spark, sf):
    return rounded(profile.corr_matrix(R.entries(spark, sf), _CORR, complete=True))


@query("corr_with_target", with_roles(" UNION ALL ".join(
    f"SELECT '{c}' AS column_name, {sql6(f'corr({c}, position)', 'corr')}, {sql6(f'abs(corr({c}, position))', 'strength')}, "
    f"abs(corr({c}, position)) > 0.1 AS significant FROM entries"
    for c in ("grid", "points", "laps", "round")), "entries"))
def corr_with_target(spark, sf):
    return rounded(profile.corr_with_target(R.entries(spark, sf), ["grid", "points", "laps", "round"], "position"))


@query("collinear_pairs", with_roles("SELECT * FROM (" + " UNION ALL ".join(
    f"SELECT '{a}' AS left_column, '{b}' AS right_column, {sql6(f'corr({a}, {b})', 'corr')} FROM entries"
    for a, b in itertools.combinations(_CORR, 2)) + ") WHERE abs(corr) > 0.8", "entries"))
def collinear_pairs(spark, sf):
    return rounded(profile.collinear_pairs(R.entries(spark, sf), _CORR))


_GRAM = ("grid", "laps", "round")


@query("gram_matrix", with_roles(" UNION ALL ".join(
    f"SELECT '{a}' AS left_column, '{b}' AS right_column, sum({a} * {b})::DOUBLE AS dot FROM entries WHERE grid IS NOT NULL"
    for a, b in itertools.combinations_with_replacement(_GRAM, 2)), "entries"))
def gram_matrix(spark, sf):
    return profile.gram_matrix(R.entries(spark, sf), _GRAM)


# two features: VIF = 1 / (1 - uncentred squared correlation)
@query("vif", with_roles(f"""
WITH g AS (SELECT sum(grid * laps)::DOUBLE AS xy, sum(grid * grid)::DOUBLE AS xx, sum(laps * laps)::DOUBLE AS yy
  FROM entries WHERE grid IS NOT NULL)
SELECT unnest(['grid', 'laps']) AS column_name, {sql6('1 / (1 - xy * xy / (xx * yy))', 'vif')} FROM g""", "entries"))
def vif(spark, sf):
    return rounded(profile.vif(R.entries(spark, sf), ["grid", "laps"]))


@query("histogram", f"""
WITH s AS (SELECT min(value) AS a, (max(value) - min(value)) / 20 AS w FROM events)
SELECT cast(least(floor((value - a) / w), 19) AS INTEGER) AS bin, {sql6('min(a) + least(floor((value - a) / w), 19) * min(w)', 'bin_start')},
  count(*) AS rows FROM events, s GROUP BY least(floor((value - a) / w), 19)""")
def histogram(spark, sf):
    return rounded(profile.histogram(src.read_table(spark, sf, "events"), "value", 20))


@query("box_stats", f"""
SELECT event_type, {sql6('q1', 'q1')}, {sql6('m', 'median')}, {sql6('q3', 'q3')}, lo AS min, hi AS max, rows,
  {sql6('q1 - 1.5 * (q3 - q1)', 'low_fence')}, {sql6('q3 + 1.5 * (q3 - q1)', 'high_fence')}
FROM (SELECT event_type, quantile_cont(value, 0.25) AS q1, median(value) AS m, quantile_cont(value, 0.75) AS q3,
  min(value) AS lo, max(value) AS hi, count(value) AS rows FROM events GROUP BY 1)""")
def box_stats(spark, sf):
    return rounded(profile.box_stats(src.read_table(spark, sf, "events"), "event_type", "value"))
