"""Fitting, tuning, ranking and applying Spark ML models.

Training rows are assembled once and persisted for the loop over estimators;
every fit, cross-validation and metric is a distributed job, and only metric
rows and fitted models reach the driver.
"""

from __future__ import annotations

import itertools
import logging
import math
import time
from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass, field, replace

from py4j.protocol import Py4JError
from pyspark import StorageLevel
from pyspark.errors import PySparkException, PySparkValueError
from pyspark.ml import Model
from pyspark.ml.base import Estimator
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator, RegressionEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol, HasSeed, HasWeightCol
from pyspark.ml.regression import DecisionTreeRegressor, LinearRegression
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel
from pyspark.ml.util import DefaultParamsReader
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import boosting, fold_statistics, forest, logistic
from .boosting import Boosted, Spec
from .forest import Forest, Plant
from .metrics import binary_metrics, overfit_table, rank_models, roc_auc
from .neighbors import knn_join
from ..session import materialise
from .split import hash_folds, nested_subsets, sample_share, stratified_folds

log = logging.getLogger(__name__)

DEEPEST = 30  # the depth limit of Spark trees stands for "no limit", here and in ``forest``

# Defaults of the estimators. The boosting presets take the public
# default rate and depth of the three well-known boosting libraries they stand for.
DEFAULTS: dict[str, dict] = {
    "linear": {}, "ridge": {"alpha": 1.0}, "lasso": {"alpha": 1.0}, "elastic_net": {"alpha": 1.0},
    "decision_tree": {"depth": 10}, "random_forest": {"rounds": 100, "depth": None},
    "gradient_boosting": {"rounds": 100, "step": 0.1, "depth": 3},
    "boosting_depthwise": {"rounds": 100, "step": 0.3, "depth": 6, "l2": 1.0},
    "boosting_leafwise": {"rounds": 100, "step": 0.1, "leaves": 31, "min_leaf": 20},
    "boosting_oblivious": {"rounds": 100, "step": 0.03, "depth": 6, "l2": 3.0},
    "logistic_regression": {"c": 1.0, "max_iter": 1000},
}
REGRESSORS = (
    "linear", "ridge", "lasso", "elastic_net", "decision_tree", "random_forest", "gradient_boosting",
    "boosting_depthwise", "boosting_leafwise", "boosting_oblivious",
)
CLASSIFIERS = (
    "logistic_regression", "random_forest", "boosting_depthwise", "boosting_leafwise", "boosting_oblivious",
    "gradient_boosting",
)


#: How the trees of the boosting presets grow.
GROWTH = {
    "gradient_boosting": "level", "boosting_depthwise": "level", "boosting_leafwise": "leaf", "boosting_oblivious": "oblivious",
}
#: Linear models whose whole grid follows from the statistics of the folds.
LINEAR = ("linear", "ridge", "lasso", "elastic_net")
#: Hyper-parameters Spark's trees have no counterpart for; the tuning table names those it left out.
IGNORED = ("min_split",)
#: Hyper-parameters that choose the weight column of a fit.
WEIGHING = ("balanced", "positive")
#: Presets that weigh the positive class by a tuned factor.
POSITIVE_WEIGHTED = ("boosting_depthwise",)


def spark_params(name: str, params: Mapping, rows: int, label_std: float = 1.0) -> dict:
    """Neutral hyper-parameters in terms of the Spark estimator.

    Ridge and logistic penalties are per training row in Spark, and its linear
    regression divides the squared penalty (not the absolute one) by the standard
    deviation of the label. Spark trees know no minimum split size, so that is
    left out.
    """
    out: dict = {}
    for k, v in params.items():
        if k == "alpha":
            absolute = {"ridge": 0.0, "lasso": v, "elastic_net": 0.5 * v}[name]
            squared = {"ridge": v / rows, "lasso": 0.0, "elastic_net": 0.5 * v}[name] * label_std
            total = absolute + squared
            out["regParam"], out["elasticNetParam"] = total, (absolute / total if total else 0.0)
        elif k == "c":
            out["regParam"] = 1.0 / (v * rows)
        elif k == "max_iter":
            out["maxIter"] = v
        elif k == "rounds":
            out["numTrees"] = v
        elif k == "depth":
            out["maxDepth"] = DEEPEST if v is None else v
        elif k == "min_leaf":
            out["minInstancesPerNode"] = v
        elif k == "features":
            out["featureSubsetStrategy"] = v
        elif k not in IGNORED:
            raise ValueError(f"unknown hyper-parameter {k}")
    return out


def make_estimator(
    name: str, task: str, rows: int, seed: int = 42, label: str = "label", weight: str | None = None,
    label_std: float = 1.0, **params,
) -> Estimator | None:
    """Spark estimator by name with its defaults; an unknown name gives None, and so does a boosting preset (``boosting_spec``)."""
    if name in GROWTH or name not in (REGRESSORS if task == "regression" else CLASSIFIERS):
        return None
    chosen = {**DEFAULTS[name], **params}
    weighted = weight is not None and chosen.pop("balanced", True)
    chosen.pop("positive", None)
    common = {"featuresCol": "features", "labelCol": label, **({"weightCol": weight} if weighted else {})}
    opts = spark_params(name, chosen, rows, label_std)
    if name in ("linear", "ridge", "lasso", "elastic_net"):
        return LinearRegression(standardization=False, **common, **opts)
    if name == "logistic_regression":
        return LogisticRegression(standardization=False, **common, **opts)
    if name == "random_forest":
        return ForestEstimator(task)._set(seed=seed, **common, **opts)
    return DecisionTreeRegressor(seed=seed, **common, **opts)


class ForestEstimator(Estimator, HasFeaturesCol, HasLabelCol, HasWeightCol, HasSeed):
    """Random forest with the parameters of Spark's, grown by ``forest``. Labels of more than two classes go to Spark's own."""

    numTrees = Param(Params._dummy(), "numTrees", "number of trees", TypeConverters.toInt)
    maxDepth = Param(Params._dummy(), "maxDepth", "depth of a tree", TypeConverters.toInt)
    minInstancesPerNode = Param(Params._dummy(), "minInstancesPerNode", "least drawn rows of a child", TypeConverters.toInt)
    featureSubsetStrategy = Param(Params._dummy(), "featureSubsetStrategy", "features a node may split by", TypeConverters.toString)

    def __init__(self, task: str):
        super().__init__()
        self.task = task
        self._setDefault(numTrees=20, maxDepth=5, minInstancesPerNode=1, featureSubsetStrategy="auto")

    def plant(self, features: int, held_out: int | None = None) -> Plant:
        get = self.getOrDefault
        depth, strategy = get("maxDepth"), get("featureSubsetStrategy")
        if not 0 <= depth <= DEEPEST:
            raise PySparkValueError(errorClass="VALUE_NOT_ALLOWED", messageParameters={"arg_name": "maxDepth", "allowed_values": f"0 to {DEEPEST}"})
        if strategy == "auto":
            strategy = "all" if get("numTrees") == 1 else "sqrt" if self.task == "classification" else "onethird"
        count = {"all": features, "sqrt": math.ceil(math.sqrt(features)), "onethird": math.ceil(features / 3),
                 "log2": max(1, math.ceil(math.log2(features)))}.get(strategy)
        if count is None:  # a share of the features, or their number
            count = int(strategy) if strategy.isdigit() else math.ceil(float(strategy) * features)
        weight = get("weightCol") if self.isDefined("weightCol") else None
        return Plant(get("numTrees"), depth, max(1, min(count, features)), get("minInstancesPerNode"), weight, held_out)

    def check(self, data: DataFrame, weights: Sequence[str]) -> bool:
        """Fail as Spark's trees do on rows that nothing can be learned from; tells whether ``forest`` can take the labels."""
        label = F.col(self.getOrDefault("labelCol"))
        wrong = [F.count_if(F.col(w).isNull() | F.isnan(w) | (F.col(w) < 0)).alias(w) for w in weights]
        r = data.agg(
            F.count(F.lit(1)).alias("n"), F.count_if(label.isNull() | F.isnan(label)).alias("empty"),
            F.count_if(~label.isin(0.0, 1.0)).alias("more"), *wrong).first()
        for column, found in [(self.getOrDefault("labelCol"), r["empty"] or not r["n"]), *((w, r[w]) for w in weights)]:
            if found:
                raise PySparkValueError(errorClass="VALUE_NOT_ALLOWED", messageParameters={"arg_name": column, "allowed_values": "numbers in every row, weights from 0 up"})
        return self.task == "regression" or not r["more"]

    def _fit(self, data: DataFrame) -> Forest | Model:
        features = data.select(F.size(vector_to_array(self.getOrDefault("featuresCol"))).alias("n")).first()
        plant = self.plant(features["n"] if features else 1)
        weights = [plant.weight] if plant.weight else []
        if not self.check(data, weights):
            params = {p.name: v for p, v in self.extractParamMap().items() if RandomForestClassifier().hasParam(p.name)}
            return RandomForestClassifier(cacheNodeIds=True, **params).fit(data)
        names = [str(i) for i in range(features["n"])]
        rows, cuts = forest.table_rows(data, self.getOrDefault("featuresCol"), self.getOrDefault("labelCol"), names, None, weights)
        return Forest(forest.fit_many(rows, cuts, [plant], self.getOrDefault("seed"), weights), self.task)


def boosting_spec(name: str, task: str, seed: int = 42, weight: str | None = None, held_out: int | None = None, **params) -> Spec:
    """Ensemble of a boosting preset with its defaults; unknown hyper-parameters raise."""
    chosen = {k: v for k, v in {**DEFAULTS[name], **params}.items() if k not in WEIGHING}
    loss = "squared" if task == "regression" else "logistic"
    try:
        return Spec(growth=GROWTH[name], loss=loss, seed=seed, weight=weight, held_out=held_out, **chosen)
    except TypeError:
        raise ValueError(f"unknown hyper-parameter among {sorted(chosen)}") from None


class _Together:
    """Boosting presets of one table, fitted in common passes when the first of them is asked for."""

    def __init__(self, train: DataFrame, names: Sequence[str], features: Sequence[str], label: str, task: str, seed: int,
                 weight: str | None, params: Mapping[str, Mapping]):
        known = REGRESSORS if task == "regression" else CLASSIFIERS
        self.names = [n for n in names if n in GROWTH and n in known]
        self.args = train, features, label, task, seed, weight, params
        self.models: dict[str, Boosted] | None = None

    def __getitem__(self, name: str) -> Boosted:
        if self.models is None:
            train, features, label, task, seed, weight, params = self.args
            specs = [
                boosting_spec(n, task, seed, weight if params.get(n, {}).get("balanced", True) else None, **params.get(n, {}))
                for n in self.names
            ]
            fitted, _ = boosting.fit_many(train, "features", label, specs, features)
            self.models = dict(zip(self.names, fitted))
        return self.models[name]


def expand_grid(grid: Mapping[str, Sequence]) -> list[dict]:
    """Every combination of a parameter grid."""
    return [dict(zip(grid, values)) for values in itertools.product(*grid.values())]


def assemble(df: DataFrame, features: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Feature vector column; missing values count as 0, as before scaling."""
    ready = df.select(*keep, *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in features])
    out = VectorAssembler(inputCols=list(features), outputCol="features").transform(ready)
    return out.select(*keep, "features")


def _size_and_spread(df: DataFrame, label: str) -> tuple[int, float]:
    row = df.agg(F.count(label).alias("n"), F.stddev_pop(label).alias("s")).first()
    return row["n"], row["s"] or 1.0


@dataclass
class Fitted:
    """Models by name, their metric table (failed ones with their status and no metrics), and the failures."""

    models: dict[str, Model | Boosted | Forest] = field(default_factory=dict)
    table: DataFrame | None = None
    failed: dict[str, str] = field(default_factory=dict)


def _metric_frame(spark: SparkSession, rows: list[dict], names: Sequence[str]) -> DataFrame:
    schema = "model string, status string, " + ", ".join(f"{n} double" for n in names)
    return spark.createDataFrame([(r["model"], r.get("status", "ok"), *(r.get(n) for n in names)) for r in rows], schema)


def _loop(train: DataFrame, names: Sequence[str], build: Callable, measure: Callable, together: _Together) -> tuple[dict, list, dict]:
    models, rows, failed = {}, [], {}
    for name in names:
        start = time.perf_counter()
        try:
            if name in together.names:
                model = together[name]
            else:
                estimator = build(name)
                if estimator is None:
                    raise PySparkValueError(errorClass="VALUE_NOT_ALLOWED", messageParameters={"arg_name": "model", "allowed_values": str(CLASSIFIERS + REGRESSORS)})
                model = estimator.fit(train)
            rows.append({"model": name, **measure(model), "seconds": time.perf_counter() - start})
            models[name] = model
        except (PySparkException, Py4JError) as e:  # a model that cannot be fitted must not stop the others
            log.warning("model %s failed: %s", name, e)
            failed[name] = str(e)
            rows.append({"model": name, "status": "failed: " + str(e).strip().split("\n")[0]})
    return models, rows, failed


def fit_regressors(
    df: DataFrame, features: Sequence[str], label: str, split: str = "split", names: Sequence[str] = REGRESSORS,
    seed: int = 42, params: Mapping[str, Mapping] | None = None,
) -> Fitted:
    """Fit every regressor on the train part and measure both parts."""
    data = assemble(df.withColumn(label, F.col(label).cast("double")), features, [label, split])
    data = data.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        train = data.where(F.col(split) == "train")
        n, spread = _size_and_spread(train, label)
        build = lambda name: make_estimator(
            name, "regression", n, seed, label, label_std=spread, **(params or {}).get(name, {}))
        measure = lambda m: overfit_table(m.transform(data), label, "prediction", split).first().asDict()
        together = _Together(train, names, features, label, "regression", seed, None, params or {})
        models, rows, failed = _loop(train, names, build, measure, together)
    finally:
        data.unpersist()
    cols = ["r2_train", "r2_test", "mae_test", "rmse_test", "overfit_gap", "seconds"]
    return Fitted(models, rank_models(_metric_frame(df.sparkSession, rows, cols), "r2_test"), failed)


def classifier_metrics(model: Model | Boosted | Forest, data: DataFrame, label: str) -> dict:
    scored = model.transform(data).select(
        label, F.col("prediction"), vector_to_array("probability").alias("p")
    ).select(label, "prediction", F.get("p", F.lit(1)).alias("score"))
    out = binary_metrics(scored, label, "prediction").first().asDict()
    out.pop("rows")
    return {**out, "roc_auc": roc_auc(scored, label, "score").first()["roc_auc"]}


def fit_classifiers(
    df: DataFrame, features: Sequence[str], label: str, split: str = "split", names: Sequence[str] = CLASSIFIERS,
    seed: int = 42, weight: str | None = None, params: Mapping[str, Mapping] | None = None,
) -> Fitted:
    """Fit every classifier on the train part and measure F1, precision, recall and AUC on test."""
    keep = [label, split] + ([weight] if weight else [])
    data = assemble(df.withColumn(label, F.col(label).cast("double")), features, keep).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        train, test = data.where(F.col(split) == "train"), data.where(F.col(split) == "test")
        n = train.count()
        build = lambda name: make_estimator(name, "classification", n, seed, label, weight, **(params or {}).get(name, {}))
        together = _Together(train, names, features, label, "classification", seed, weight, params or {})
        models, rows, failed = _loop(train, names, build, lambda m: classifier_metrics(m, test, label), together)
    finally:
        data.unpersist()
    cols = ["precision", "recall", "f1", "accuracy", "roc_auc", "seconds"]
    return Fitted(models, rank_models(_metric_frame(df.sparkSession, rows, cols), "f1"), failed)


def select_top(table: DataFrame, k: int = 5, rank: str = "rank") -> list[str]:
    """Names of the k best models, fewer if there are fewer."""
    fitted = table.where(F.col("status") == "ok") if "status" in table.columns else table
    return [r["model"] for r in fitted.orderBy(rank).limit(k).select("model").collect()]


def _weight_column(combo: Mapping, weight: str | None) -> str | None:
    """Weight column that a combination asks for: the caller's, none (all ones), or one for a positive factor."""
    if combo.get("positive"):
        return f"__w_{str(float(combo['positive'])).replace('.', '_')}"
    if weight is None:
        return None
    return weight if combo.get("balanced", True) else "__w_one"


TUNED = "combination int, model string, params map<string,string>, score double"


@dataclass
class Tuned:
    """The best model of a grid, refitted on all rows, and one row per combination."""

    bestModel: Model | Boosted
    table: DataFrame
    params: dict


def _table(spark: SparkSession, name: str, combos: Sequence[Mapping], scores: Sequence[float | None]) -> DataFrame:
    rows = [
        (i, name, {k: str(v) + (" (no counterpart)" if k in IGNORED and name not in GROWTH else "") for k, v in combo.items()}, score)
        for i, (combo, score) in enumerate(zip(combos, scores))
    ]
    return spark.createDataFrame(rows, TUNED)


def _folded(df: DataFrame, key: str, label: str, task: str, folds: int, seed: int) -> DataFrame:
    return hash_folds(df, key, folds, seed) if task == "regression" else stratified_folds(df, key, label, folds, seed)


def _best(scores: Sequence[float | None]) -> int:
    """The first combination with the highest score."""
    return max(range(len(scores)), key=lambda i: (-math.inf if scores[i] is None else scores[i], -i))


def _with_weights(data: DataFrame, label: str, combos: Iterable[Mapping]) -> DataFrame:
    """One column per weighing that the combinations ask for, next to the caller's."""
    factors = sorted({c["positive"] for c in combos if c.get("positive")})
    return data.withColumns({
        "__w_one": F.lit(1.0),
        **{_weight_column({"positive": f}, None): F.when(F.col(label) == 1, F.lit(float(f))).otherwise(1.0) for f in factors},
    })


def tune_boosting(
    df: DataFrame, features: Sequence[str], label: str, grids: Mapping[str, Mapping[str, Sequence]], key: str,
    task: str = "regression", folds: int = 5, seed: int = 42, weight: str | None = None,
) -> dict[str, Tuned]:
    """Grid search of boosting presets: all combinations of all presets and folds grow in common passes.

    Combinations that differ in ``rounds`` alone are prefixes of the longest. The best
    combination of each preset is then refitted on all rows, again together.
    """
    data = _folded(df.where(F.col(label).isNotNull()).withColumn(label, F.col(label).cast("double")), key, label, task, folds, seed)
    keep = [key, label, "fold"] + ([weight] if weight else [])
    combos = {name: expand_grid(grid) for name, grid in grids.items()}
    ready = materialise(_with_weights(assemble(data, features, keep), label, [c for own in combos.values() for c in own]))

    def spec(name: str, combo: Mapping, fold: int | None) -> Spec:
        return boosting_spec(name, task, seed, _weight_column(combo, weight), fold, **combo)

    longest: dict[Spec, int] = {}
    for name, own in combos.items():
        for s in (spec(name, c, k) for c in own for k in range(folds)):
            root = replace(s, rounds=0)
            longest[root] = max(longest.get(root, 0), s.rounds)
    roots = list(longest)
    fitted, plain = boosting.fit_many(ready, "features", label, [replace(r, rounds=longest[r]) for r in roots], features, key, "fold")
    wanted: dict[Spec, list[int]] = {r: [] for r in roots}
    for name, own in combos.items():
        for s in (spec(name, c, k) for c in own for k in range(folds)):
            wanted[replace(s, rounds=0)].append(s.rounds)
    found = dict(zip(roots, boosting.prefix_scores(plain, fitted, [wanted[r] for r in roots])))

    def score(name: str, combo: Mapping) -> float | None:
        each = [spec(name, combo, k) for k in range(folds)]
        # a fold in which the measure is undefined says nothing about a regression, and 0 about classes
        got = [found[replace(s, rounds=0)].get(s.rounds) for s in each]
        got = [g for g in got if g is not None] if task == "regression" else [g or 0.0 for g in got]
        return sum(got) / len(got) if got else None

    scores = {name: [score(name, c) for c in own] for name, own in combos.items()}
    best = {name: combos[name][_best(scores[name])] for name in combos}
    finals, _ = boosting.fit_many(ready, "features", label, [spec(n, c, None) for n, c in best.items()], features, key, "fold")
    return {
        name: Tuned(model, _table(df.sparkSession, name, combos[name], scores[name]), best[name]) for (name, model) in zip(best, finals)
    }


def tune_linear(
    df: DataFrame, features: Sequence[str], label: str, name: str, grid: Mapping[str, Sequence], key: str, folds: int = 5, seed: int = 42,
) -> Tuned:
    """Grid search of a linear model from one pass: every penalty and held-out fold is a small solve."""
    data = hash_folds(df.where(F.col(label).isNotNull()).withColumn(label, F.col(label).cast("double")), key, folds, seed)
    data = materialise(assemble(data, features, [label, "fold"]))
    parts = fold_statistics.moments(data, "features", label, "fold")
    combos = expand_grid(grid)
    alphas = [{**DEFAULTS[name], **c}.get("alpha", 0.0) for c in combos]
    found = fold_statistics.grid_scores(parts, name, sorted(set(alphas)), folds)
    scores = [found[a] for a in alphas]
    best = combos[_best(scores)]
    n, spread = _size_and_spread(data, label)
    model = make_estimator(name, "regression", n, seed, label, label_std=spread, **best).fit(data)
    return Tuned(model, _table(df.sparkSession, name, combos, scores), best)


def _tune_forest(
    data: DataFrame, count: int, base: ForestEstimator, maps: Sequence[Mapping], weights: Sequence[str], label: str, task: str, folds: int, seed: int,
) -> CrossValidatorModel:
    """Grid search of a forest: combinations that differ in trees or depth alone are parts of the same trees, and all plants and folds grow together."""
    rows, cuts = forest.table_rows(data, "features", label, [str(i) for i in range(count)], "fold", weights)
    each = [[base.copy(m).plant(count, k) for k in range(folds)] for m in maps]
    whole: dict[Plant, Plant] = {}
    for p in itertools.chain(*each):
        root = replace(p, trees=0, depth=0)
        old = whole.get(root, root)
        whole[root] = replace(root, trees=max(old.trees, p.trees), depth=max(old.depth, p.depth))
    place = {root: i for i, root in enumerate(whole)}
    grown = forest.fit_many(rows, cuts, list(whole.values()), seed, weights)
    wanted = [(place[replace(p, trees=0, depth=0)], p.trees, p.depth) for p in itertools.chain(*each)]
    found = iter(forest.held_out_scores(rows, grown, wanted, task))
    scores = []
    for own in ([next(found) for _ in range(folds)] for _ in maps):
        # a fold in which the measure is undefined says nothing about a regression, and 0 about classes
        got = [s for s in own if s is not None] if task == "regression" else [s or 0.0 for s in own]
        scores.append(sum(got) / len(got) if got else None)
    best = base.copy(maps[_best(scores)]).plant(count)
    model = Forest(forest.fit_many(rows, cuts, [best], seed, weights), task)
    search = CrossValidator(estimator=base, estimatorParamMaps=list(maps), numFolds=folds, foldCol="fold", seed=seed)
    return search._copyValues(CrossValidatorModel(model, scores))


def _tune_logistic(
    data: DataFrame, count: int, base: LogisticRegression, maps: Sequence[Mapping], label: str, folds: int, seed: int,
) -> CrossValidatorModel | None:
    """Grid search of logistic regression: all penalties and folds take the same passes. None for tables or grids that Spark's own search must judge."""
    fits = [base.copy(m) for m in maps]
    if any(p.name not in ("regParam", "weightCol") for m in maps for p in m) or any(e.getOrDefault("regParam") <= 0 for e in fits):
        return None
    named = [e.getOrDefault("weightCol") if e.isDefined("weightCol") else None for e in fits]
    if not logistic.sound(data, label, "fold", sorted({w for w in named if w}), folds):
        return None
    asks = [logistic.Ask(e.getOrDefault("regParam"), w, k) for e, w in zip(fits, named) for k in range(folds)]
    points = logistic.fit_many(data, "features", label, "fold", asks, count)
    if points is None:
        return None
    found = logistic.held_out_f1(data, "features", label, "fold", asks, points)
    scores = [sum(found[i:i + folds]) / folds for i in range(0, len(found), folds)]
    search = CrossValidator(estimator=base, estimatorParamMaps=list(maps), numFolds=folds, foldCol="fold", seed=seed)
    return search._copyValues(CrossValidatorModel(fits[_best(scores)].fit(data), scores))


def tune(
    df: DataFrame, features: Sequence[str], label: str, name: str, grid: Mapping[str, Sequence], key: str,
    task: str = "regression", folds: int = 5, seed: int = 42, weight: str | None = None, parallelism: int = 4,
) -> tuple[Tuned | CrossValidatorModel, DataFrame]:
    """Grid search with fixed folds; returns what holds the ``bestModel`` and one row per combination.

    Folds are hash folds for regression and stratified ones for classification. Linear
    regressions, boosting presets, forests and logistic regressions of two classes have ways
    of their own (``tune_linear``, ``tune_boosting``, ``_tune_forest``, ``_tune_logistic``);
    other models are cross-validated fit by fit, and combinations that are the same for Spark
    are fitted once.
    """
    if name in GROWTH:
        found = tune_boosting(df, features, label, {name: grid}, key, task, folds, seed, weight)[name]
        return found, found.table
    if name in LINEAR and task == "regression":
        found = tune_linear(df, features, label, name, grid, key, folds, seed)
        return found, found.table
    keep = [label, "fold"] + ([weight] if weight else [])
    data = assemble(_folded(df, key, label, task, folds, seed).withColumn(label, F.col(label).cast("double")), features, keep)
    data = data.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        n, spread = _size_and_spread(data, label)
        base = make_estimator(name, task, n, seed, label, weight, spread)
        combos: dict[tuple, dict] = {}
        for combo in expand_grid(grid):
            plain = {k: v for k, v in combo.items() if k not in WEIGHING}
            column = _weight_column(combo, weight)
            known = {**spark_params(name, plain, n, spread), **({"weightCol": column} if column else {})}
            combos.setdefault(tuple(sorted(known.items())), combo)
        ready = _with_weights(data, label, combos.values())
        maps = [{base.getParam(p): v for p, v in c} for c in combos]
        weights = sorted({e.getOrDefault("weightCol") for e in map(base.copy, maps) if e.isDefined("weightCol")}) if name == "random_forest" else []
        if name == "random_forest" and base.check(ready, weights):
            model = _tune_forest(ready, len(features), base, maps, weights, label, task, folds, seed)
            return model, _table(df.sparkSession, name, list(combos.values()), model.avgMetrics)
        if name == "logistic_regression" and (model := _tune_logistic(ready, len(features), base, maps, label, folds, seed)):
            return model, _table(df.sparkSession, name, list(combos.values()), model.avgMetrics)
        score = (
            RegressionEvaluator(labelCol=label, metricName="r2") if task == "regression"
            else MulticlassClassificationEvaluator(labelCol=label, metricName="fMeasureByLabel", metricLabel=1.0)
        )
        model = CrossValidator(
            estimator=base, estimatorParamMaps=maps, evaluator=score, numFolds=folds, foldCol="fold",
            parallelism=parallelism, seed=seed,
        ).fit(ready)
    finally:
        data.unpersist()
    return model, _table(df.sparkSession, name, list(combos.values()), [float(s) for s in model.avgMetrics])


def tune_many(
    df: DataFrame, features: Sequence[str], label: str, names: Sequence[str], grids: Mapping[str, Mapping], key: str,
    task: str = "regression", folds: int = 5, seed: int = 42, weight: str | None = None,
) -> tuple[dict[str, Model | Boosted | Forest], DataFrame | None]:
    """Grid search for several models: best model per name, and all combinations.

    Without a grid a regressor is skipped, and a classifier is validated with
    its defaults. Boosting presets are searched together.
    """
    wanted = {n: grids.get(n, {}) for n in names if n in grids or task != "regression"}
    boosted = {n: g for n, g in wanted.items() if n in GROWTH}
    found = tune_boosting(df, features, label, boosted, key, task, folds, seed, weight) if boosted else {}
    best, rows = {}, None
    for name, grid in wanted.items():
        own = found.get(name)
        own, table = (own, own.table) if own else tune(df, features, label, name, grid, key, task, folds, seed, weight)
        best[name] = own.bestModel
        rows = table if rows is None else rows.unionByName(table)
    return best, rows


def evaluate_models(
    fitted: Mapping[str, Model | Boosted | Forest], df: DataFrame, features: Sequence[str], label: str, split: str = "split",
    task: str = "regression",
) -> DataFrame:
    """Ranked metric table of fitted models over the split parts of a table."""
    data = assemble(df.withColumn(label, F.col(label).cast("double")), features, [label, split])
    data = data.persist(StorageLevel.MEMORY_AND_DISK)
    rows = []
    try:
        for name, model in fitted.items():
            if task == "regression":
                m = overfit_table(model.transform(data), label, "prediction", split).first().asDict()
            else:
                m = classifier_metrics(model, data.where(F.col(split) == "test"), label)
            rows.append({"model": name, **m})
    finally:
        data.unpersist()
    cols, metric = (
        (["r2_train", "r2_test", "mae_test", "rmse_test", "overfit_gap"], "r2_test") if task == "regression"
        else (["precision", "recall", "f1", "accuracy", "roc_auc"], "f1")
    )
    return rank_models(_metric_frame(df.sparkSession, rows, cols), metric)


def feature_importance(model: Model | Forest, features: Sequence[str], k: int = 20) -> DataFrame:
    """Importance per feature, largest first."""
    spark = SparkSession.active()
    rows = [(f, float(v)) for f, v in zip(features, model.featureImportances.toArray())]
    return spark.createDataFrame(rows, "feature string, importance double").orderBy(F.desc("importance"), "feature").limit(k)


def learning_curve(
    df: DataFrame, features: Sequence[str], label: str, key: str, names: Sequence[str] = LINEAR, steps: int = 10, folds: int = 5,
    seed: int = 42, params: Mapping[str, Mapping] | None = None,
) -> DataFrame:
    """R2 on the held-out fold for growing shares of the other folds.

    Linear models take one pass for all folds, steps and models (sums per fold and step);
    boosting presets grow for all folds and steps in common passes.
    """
    data = nested_subsets(df.where(F.col(label).isNotNull()).withColumn(label, F.col(label).cast("double")), key, steps, folds, seed)
    data = materialise(assemble(data, features, [key, label, "fold", "step"]))
    parts = fold_statistics.moments(data, "features", label, "fold", "step")
    rows = []
    for name in names:
        if name not in LINEAR:
            continue
        alpha = {**DEFAULTS[name], **(params or {}).get(name, {})}.get("alpha", 0.0)
        rows += [(name, *r) for r in fold_statistics.curve(parts, name, alpha, folds, steps)]
    boosted = [n for n in names if n in GROWTH]
    if boosted:
        sizes = {(r[1], r[2]): r[3] for r in ((LINEAR[0], *c) for c in fold_statistics.curve(parts, LINEAR[0], 0.0, folds, steps))}
        rows += _boosted_curve(data, features, label, key, boosted, steps, folds, seed, params or {}, sizes)
    return df.sparkSession.createDataFrame(rows, "model string, held_out int, curve_step int, train_rows long, r2 double")


def _boosted_curve(
    data: DataFrame, features: Sequence[str], label: str, key: str, names: Sequence[str], steps: int, folds: int, seed: int,
    params: Mapping[str, Mapping], sizes: Mapping[tuple[int, int], int],
) -> list[tuple]:
    """Later steps weigh nothing in a step's ensemble, so all of them learn from the same written rows."""
    data = data.withColumns({f"__s_{s}": (F.col("step") <= s).cast("double") for s in range(1, steps + 1)})
    asked = [(n, k, s) for n in names for k in range(folds) for s in range(1, steps + 1)]
    specs = [boosting_spec(n, "regression", seed, f"__s_{s}", k, **params.get(n, {})) for n, k, s in asked]
    fitted, plain = boosting.fit_many(data, "features", label, specs, features, key, "fold")
    scores = boosting.prefix_scores(plain, fitted, [[s.rounds] for s in specs])
    return [(n, k, s, sizes[k, s], got.get(spec.rounds)) for (n, k, s), spec, got in zip(asked, specs, scores)]


def sample_then_full(
    df: DataFrame, features: Sequence[str], label: str, key: str, split: str = "split",
    names: Sequence[str] = ("ridge", "random_forest"), share: float = 0.2, seed: int = 42,
    params: Mapping[str, Mapping] | None = None,
) -> tuple[str, Fitted]:
    """Compare models on a sample of the training rows, then refit the winner on all of them."""
    train = sample_share(df.where(F.col(split) == "train"), key, share, seed)
    first = fit_regressors(train.unionByName(df.where(F.col(split) == "test")), features, label, split, names, seed, params)
    winner = select_top(first.table, 1)[0]
    return winner, fit_regressors(df, features, label, split, [winner], seed, params)


def save_model(model: Model | Boosted | Forest, path: str, version: str) -> str:
    target = f"{path}/v={version}"
    if isinstance(model, Boosted | Forest):
        model.save(SparkSession.active(), target)
    else:
        model.write().overwrite().save(target)
    return target


def load_model(spark: SparkSession, path: str, boosted: bool = False, grown: bool = False) -> Model | Boosted | Forest:
    if boosted:
        return Boosted.load(spark, path)
    if grown:
        return Forest.load(spark, path)
    return DefaultParamsReader.loadParamsInstance(path, spark)


def knn_regress(test: DataFrame, train: DataFrame, k: int, id_col: str, label: str, vec: str = "vec") -> DataFrame:
    """Mean label of the k nearest training rows."""
    near = knn_join(test, train, k, id_col, vec)
    labels = train.select(F.col(id_col).alias("neighbor_id"), F.col(label).alias("__y"))
    return near.join(labels, "neighbor_id").groupBy("id").agg(F.avg("__y").alias("pred"))
