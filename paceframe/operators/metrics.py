"""Model quality as DataFrame aggregates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import share
from .joins import left_join
from .quantiles import column_quantiles
from .scan import ROWS_PER_BIN, running_totals


def _ratio0(num: Column, den: Column) -> Column:
    return F.coalesce(share(num, den), F.lit(0.0))


def regression_metrics(df: DataFrame, y: str, pred: str, by: Sequence[str] = ()) -> DataFrame:
    """R2, MAE, RMSE and rows, overall or per group."""
    err = F.col(y) - F.col(pred)
    out = df.groupBy(*by).agg(
        F.count(err).alias("rows"), F.sum(err * err).alias("__sse"), F.var_pop(y).alias("__var"),
        F.avg(F.abs(err)).alias("mae"), F.sqrt(F.avg(err * err)).alias("rmse"),
    )
    r2 = 1.0 - share(F.col("__sse"), F.col("__var") * F.col("rows"))
    return out.select(*by, "rows", r2.alias("r2"), "mae", "rmse")


def overfit_table(df: DataFrame, y: str, pred: str, split: str = "split", by: Sequence[str] = ()) -> DataFrame:
    """Test metrics with train R2 and the gap between both."""
    parts = regression_metrics(df, y, pred, [*by, split])
    pick = lambda part, c: F.max(F.when(F.col(split) == part, F.col(c)))
    wide = parts.groupBy(*by).agg(
        pick("train", "r2").alias("r2_train"), pick("test", "r2").alias("r2_test"),
        pick("test", "mae").alias("mae_test"), pick("test", "rmse").alias("rmse_test"),
    )
    return wide.withColumn("overfit_gap", F.col("r2_train") - F.col("r2_test"))


def residual_stats(df: DataFrame, y: str, pred: str) -> DataFrame:
    res = df.select((F.col(y) - F.col(pred)).alias("residual"))
    mid = column_quantiles(res, ["residual"], [0.5])["residual"][0]
    return res.agg(
        F.avg("residual").alias("mean_residual"), F.stddev_samp("residual").alias("std_residual"),
    ).withColumn("median_residual", F.lit(mid).cast("double"))


def confusion(df: DataFrame, label: str, pred: str) -> DataFrame:
    return df.groupBy(label, pred).agg(F.count(F.lit(1)).alias("rows"))


def binary_metrics(df: DataFrame, label: str, pred: str, by: Sequence[str] = ()) -> DataFrame:
    """Precision, recall, F1 of class 1, and accuracy; undefined ratios are 0."""
    hit, real, said = (F.col(label) == 1) & (F.col(pred) == 1), F.col(label) == 1, F.col(pred) == 1
    n = df.groupBy(*by).agg(
        F.count_if(hit).alias("__tp"), F.count_if(real).alias("__p"), F.count_if(said).alias("__s"),
        F.count_if(F.col(label) == F.col(pred)).alias("__ok"), F.count(F.lit(1)).alias("rows"),
    )
    return n.select(
        *by, "rows", _ratio0(F.col("__tp"), F.col("__s")).alias("precision"),
        _ratio0(F.col("__tp"), F.col("__p")).alias("recall"),
        _ratio0(2 * F.col("__tp"), F.col("__p") + F.col("__s")).alias("f1"),
        _ratio0(F.col("__ok"), F.col("rows")).alias("accuracy"),
    )


def classification_report(df: DataFrame, label: str, pred: str) -> DataFrame:
    """Per class precision, recall, F1 and support, with macro and weighted averages."""
    cells = confusion(df, label, pred)
    sides = F.array(
        F.struct(F.col(label).alias("c"), F.col("rows").alias("real"), F.lit(0).cast("bigint").alias("said")),
        F.struct(F.col(pred).alias("c"), F.lit(0).cast("bigint").alias("real"), F.col("rows").alias("said")),
    )
    hit = F.when(F.col(label) == F.col(pred), F.col("rows")).otherwise(0)
    long = cells.select(F.explode(sides).alias("s"), hit.alias("hit"))
    per = long.groupBy(F.col("s.c").cast("string").alias("class")).agg(
        F.sum("s.real").alias("support"), F.sum("s.said").alias("__said"),
        F.sum(F.when(F.col("s.real") > 0, F.col("hit")).otherwise(0)).alias("__tp"),
    )
    per = per.select(
        "class", _ratio0(F.col("__tp"), F.col("__said")).alias("precision"),
        _ratio0(F.col("__tp"), F.col("support")).alias("recall"),
        _ratio0(2 * F.col("__tp"), F.col("__said") + F.col("support")).alias("f1"), "support",
    )
    names = ("precision", "recall", "f1")
    macro = per.agg(*[F.avg(c).alias(c) for c in names], F.sum("support").alias("support"))
    weighted = per.agg(
        *[share(F.sum(F.col(c) * F.col("support")), F.sum("support")).alias(c) for c in names],
        F.sum("support").alias("support"),
    )
    cols = ["class", *names, "support"]
    return (
        per.unionByName(macro.withColumn("class", F.lit("macro avg")).select(*cols))
        .unionByName(weighted.withColumn("class", F.lit("weighted avg")).select(*cols))
    )


def threshold_counts(df: DataFrame, label: str, score: str, descending: bool, rows_per_bin: int = ROWS_PER_BIN) -> DataFrame:
    """Per distinct score: positives and negatives, own and running.

    Ties collapse before the scan, and the scan itself runs bin by bin.
    """
    per = df.groupBy(F.col(score).alias("score")).agg(
        F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) != 1).alias("neg")
    )
    return running_totals(per, "score", {"pos": "tp", "neg": "fp"}, descending=descending, rows_per_bin=rows_per_bin)


def roc_auc(df: DataFrame, label: str, score: str, rows_per_bin: int = ROWS_PER_BIN) -> DataFrame:
    """Area under the ROC curve in its rank form, ties counted half."""
    runs = threshold_counts(df, label, score, False, rows_per_bin)
    below = F.col("fp") - F.col("neg")
    pairs = F.sum(F.col("pos").cast("double") * (below + F.col("neg") * 0.5))
    return runs.agg(
        share(pairs, F.sum("pos").cast("double") * F.sum("neg").cast("double")).alias("roc_auc"),
        F.sum("pos").alias("positives"), F.sum("neg").alias("negatives"),
    )


def _totals(df: DataFrame, label: str) -> Column:
    both = F.struct(
        F.count_if(F.col(label) == 1).cast("double").alias("p"), F.count_if(F.col(label) != 1).cast("double").alias("n")
    )
    return df.agg(both.alias("t")).select("t").scalar()


def roc_curve(df: DataFrame, label: str, score: str, rows_per_bin: int = ROWS_PER_BIN) -> DataFrame:
    """False and true positive rate at every score threshold."""
    t = _totals(df, label)
    runs = threshold_counts(df, label, score, True, rows_per_bin)
    return runs.select(
        F.col("score").alias("threshold"), F.try_divide(F.col("fp"), t["n"]).alias("fpr"),
        F.try_divide(F.col("tp"), t["p"]).alias("tpr"),
    )


def pr_curve(df: DataFrame, label: str, score: str, rows_per_bin: int = ROWS_PER_BIN) -> DataFrame:
    t = _totals(df, label)
    runs = threshold_counts(df, label, score, True, rows_per_bin)
    return runs.select(
        F.col("score").alias("threshold"), share(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"),
        F.try_divide(F.col("tp"), t["p"]).alias("recall"),
    )


def average_precision(df: DataFrame, label: str, score: str, rows_per_bin: int = ROWS_PER_BIN) -> DataFrame:
    """Sum of recall steps times precision over thresholds."""
    runs = threshold_counts(df, label, score, True, rows_per_bin)
    area = F.sum(F.col("pos") * share(F.col("tp"), F.col("tp") + F.col("fp")))
    return runs.agg(share(area, F.sum("pos")).alias("average_precision"))


def rank_models(table: DataFrame, metric: str, model: str = "model", rank: str = "rank") -> DataFrame:
    """Metric table ranked best first. One row per model, so one window is enough."""
    w = Window.orderBy(F.desc_nulls_last(metric), F.asc(model))
    return table.withColumn(rank, F.row_number().over(w))


def best_row(table: DataFrame, metric: str, by: Sequence[str] = (), largest: bool = True, tie: str | None = None) -> DataFrame:
    """Whole row of the best metric value, per group if wanted; ties take the smallest tie column."""
    value = F.col(metric) if largest else -F.col(metric)
    tie = tie or next(c for c in table.columns if c not in (metric, *by))
    order = F.struct(F.isnull(metric), -value, F.col(tie))
    return table.groupBy(*by).agg(F.min_by(F.struct(*[c for c in table.columns if c not in by]), order).alias("r")).select(*by, "r.*")


def goal_checks(
    table: DataFrame, goal: float = 0.80, min_r2: float = 0.5, max_gap: float = 0.15, max_mae: float | None = None
) -> DataFrame:
    """Goal and viability of every model as booleans, with the distance to the goal."""
    viable = (F.col("r2_test") > min_r2) & (F.col("overfit_gap") < max_gap)
    if max_mae is not None:
        viable = viable & (F.col("mae_test") < max_mae)
    return table.withColumns({
        "meets_goal": F.col("r2_test") >= goal, "gap_to_goal": F.lit(goal) - F.col("r2_test"), "viable": viable,
    })


def scorecard(metrics: DataFrame, lower_better: Sequence[str]) -> DataFrame:
    """One point per metric for the better of two candidates (columns a and b); a tie goes to b."""
    low = F.col("metric").isin(*lower_better)
    a_wins = F.when(low, F.col("a") < F.col("b")).otherwise(F.col("a") > F.col("b"))
    rows = metrics.withColumn("winner", F.when(a_wins, "a").otherwise("b"))
    points = rows.agg(F.count_if(F.col("winner") == "a").alias("a_points"), F.count_if(F.col("winner") == "b").alias("b_points"))
    return points.withColumn("overall", F.when(F.col("a_points") > F.col("b_points"), "a").otherwise("b"))


def metric_delta(current: DataFrame, previous: DataFrame, key: str = "metric", value: str = "value") -> DataFrame:
    old = previous.select(key, F.col(value).alias("previous"))
    both = left_join(current.select(key, F.col(value).alias("current")), old, key)
    delta = F.col("current") - F.col("previous")
    return both.withColumns({"delta": delta, "improved": delta > 0})


def consolidated_report(expected: DataFrame, metrics: DataFrame, key: str = "flow") -> DataFrame:
    """Every expected flow with its metrics; a flow without metrics is FAILED."""
    marked = metrics.withColumn("__seen", F.lit(True))
    out = left_join(expected, marked, key)
    return out.withColumn("status", F.when(F.col("__seen"), "SUCCESS").otherwise("FAILED")).drop("__seen")


def as_long(df: DataFrame, cols: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Metric columns of a one-row-per-group table as (metric, value) rows."""
    pairs = F.array(*[F.struct(F.lit(c).alias("metric"), F.col(c).cast("double").alias("value")) for c in cols])
    return df.select(*keep, F.explode(pairs).alias("m")).select(*keep, "m.metric", "m.value")
