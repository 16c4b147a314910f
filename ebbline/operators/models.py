"""Tree ensembles: training, validation, tuning, scoring."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce
from itertools import product
from multiprocessing.pool import ThreadPool

from pyspark.ml import Model, PipelineModel
from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbline.operators import metrics
from ebbline.operators.sampling import SAMPLERS, SEED, stratified_folds, stratified_split
from ebbline.session import durable

# Tuned boosting parameters per horizon, with the resampling used before the
# final fit.  Names follow Spark but for ``gamma``, the least loss reduction of a split, summed over
# the node's rows; L1 and L2 weights have no Spark counterpart.  Rounds: the tuned number never
# reached the library, whose default held.
FINAL_PARAMS = {
    "3m": {"maxDepth": 6, "minInstancesPerNode": 12, "gamma": 0.008, "subsamplingRate": 0.9, "featureSubsetStrategy": "0.95"},
    "6m": {"maxDepth": 4, "minInstancesPerNode": 8, "gamma": 0.0, "subsamplingRate": 0.65, "featureSubsetStrategy": "0.55"},
    "1y": {"maxDepth": 6, "minInstancesPerNode": 3, "gamma": 0.15, "subsamplingRate": 0.7, "featureSubsetStrategy": "0.9"},
}
FINAL_SAMPLER = {"3m": "random", "6m": "none", "1y": "adasyn"}
ROUNDS = 100
LEARNING_RATE = 0.1

# Order in which parameters are tuned, with the first grid of each step (the
# steps for L1 and L2 weights have no Spark counterpart).
TUNING_STEPS = (
    {"maxDepth": [4, 5, 6, 7], "minInstancesPerNode": [1, 2, 3, 4, 5]},
    {"gamma": [0.0, 0.1, 0.2, 0.3, 0.4]},
    {"subsamplingRate": [0.6, 0.7, 0.8, 0.9], "featureSubsetStrategy": ["0.6", "0.7", "0.8", "0.9"]},
    {"maxIter": [1000, 3000, 5000, 7000], "stepSize": [0.001, 0.01, 0.1]},
)

CHECKPOINT_ROUNDS = 10


def random_forest(**params) -> RandomForestClassifier:
    return RandomForestClassifier(featuresCol="_vector", labelCol="label", seed=SEED).setParams(
        **{"numTrees": 100, "checkpointInterval": CHECKPOINT_ROUNDS, **params}
    )


def boosted_trees(gamma: float = 0.0, rows: int = 1, **params) -> GBTClassifier:
    """Gradient boosting with default depth.

    ``gamma`` is a sum over rows and Spark's least gain a mean, so it is divided by ``rows``.
    """
    params = {"minInfoGain": gamma / max(rows, 1), **params}
    defaults = {"maxIter": 100, "stepSize": LEARNING_RATE, "maxDepth": 3, "checkpointInterval": CHECKPOINT_ROUNDS}
    return GBTClassifier(featuresCol="_vector", labelCol="label", seed=SEED).setParams(**{**defaults, **params})


def deep_boosted_trees(**params) -> GBTClassifier:
    """Second boosting configuration: deeper trees and a higher rate."""
    return boosted_trees(**{"maxDepth": 6, "stepSize": 0.3, **params})


MODELS: dict[str, Callable] = {
    "random_forest": random_forest,
    "gradient_boosting": boosted_trees,
    "deep_gradient_boosting": deep_boosted_trees,
}


def as_vectors(df: DataFrame) -> DataFrame:
    return df.withColumn("_vector", array_to_vector("features"))


def frame(mart: DataFrame, features: Sequence[str], id_col: str = "code", label: str = "bankruptcy") -> DataFrame:
    """Model frame (id, features, label) of a feature mart; booleans count 0 or 1."""
    values = F.array(*[F.col(c).cast("double") for c in features])
    return mart.select(F.col(id_col).alias("id"), values.alias("features"), F.col(label).cast("int").alias("label"))


def fit(df: DataFrame, estimator) -> Model:
    return estimator.fit(as_vectors(df))


def predict(model: Model, df: DataFrame) -> DataFrame:
    """Add ``prediction`` (0/1) and ``p1``, the probability of class 1."""
    scored = model.transform(as_vectors(df))
    return scored.select(
        *df.columns,
        F.col("prediction").cast("int").alias("prediction"),
        vector_to_array("probability")[1].alias("p1"),
    )


def _fit_and_report(train: DataFrame, test: DataFrame, estimator) -> DataFrame:
    """Train and test reports of one fit."""
    model = fit(train, estimator)
    scored = [
        predict(model, part).select(F.lit(name).alias("part"), "label", "prediction")
        for name, part in (("train", train), ("test", test))
    ]
    return metrics.class_report(reduce(DataFrame.unionByName, scored), "label", "prediction", ["part"])


def _resampled(df: DataFrame, is_test: Column, sampler: str) -> tuple[DataFrame, DataFrame]:
    """Training rows, resampled and written once for all fits that use them, and test rows."""
    rows = df.select("id", "features", "label", is_test.alias("_test"))
    train, test = (rows.where(F.col("_test") == flag).drop("_test") for flag in (False, True))
    return durable(SAMPLERS[sampler](train)), test


def _rows(spark_rows: Sequence, extra: Mapping) -> list[dict]:
    return [{**extra, **r.asDict()} for r in spark_rows]


def compare(
    df: DataFrame,
    models: Sequence[str] = tuple(MODELS),
    samplers: Sequence[str] = tuple(SAMPLERS),
    n_splits: int = 30,
    parallelism: int = 4,
    params: Mapping[str, Mapping] | None = None,
) -> DataFrame:
    """Scoreboard of every model and sampler over repeated splits, train and test.

    The driver only starts fits and holds the score rows (two per fit); every fit is a
    Spark job.
    """
    spark = df.sparkSession
    base = durable(df)
    split = durable(stratified_split(base, "id", "label", n_splits, keep=["features"]))

    def run(job):
        i, s = job
        train, test = _resampled(split.where(F.col("split") == i), F.col("is_test"), s)
        found = []
        for m in models:
            report = _fit_and_report(train, test, MODELS[m](**(params or {}).get(m, {})))
            found += _rows(report.collect(), {"model": m, "sampler": s, "split": i})
        return found

    jobs = list(product(range(1, n_splits + 1), samplers))
    with ThreadPool(parallelism) as pool:
        found = [r for rows in pool.map(run, jobs) for r in rows]
    return metrics.scoreboard(spark.createDataFrame(found), ["model", "sampler", "part"])


def best_combination(board: DataFrame) -> DataFrame:
    """Highest test F1 of the default class."""
    return board.where("part = 'test'").orderBy(F.desc("f1_1"), F.desc("accuracy"), "model", "sampler").limit(1)


def grid_search(
    df: DataFrame,
    build: Callable,
    grid: Mapping[str, Sequence],
    fixed: Mapping | None = None,
    folds: int = 4,
    sampler: str = "none",
    scoring: str = "f1",
    parallelism: int = 4,
) -> DataFrame:
    """(params..., mean_test_score, mean_train_score), best first.

    ``scoring`` is ``f1`` of the default class or ``f1_micro`` (accuracy).  Equal test scores
    go to the lower train score, the less overfitted choice.
    """
    spark = df.sparkSession
    folded = durable(stratified_folds(df, "id", "label", folds))
    if "gamma" in grid or "gamma" in (fixed or {}):
        fixed = {"rows": folded.count(), **(fixed or {})}
    score = {"f1": "f1_1", "f1_micro": "accuracy"}[scoring]
    points = [dict(zip(grid, values)) for values in product(*grid.values())]

    with ThreadPool(parallelism) as pool:
        sides = pool.map(lambda k: _resampled(folded, F.col("fold") == k, sampler), range(folds))

        def run(job):
            point, k = job
            report = _fit_and_report(*sides[k], build(**{**(fixed or {}), **point}))
            return [{**point, "fold": k, "part": r["part"], "score": float(r[score])} for r in report.collect()]

        found = [r for rows in pool.map(run, list(product(points, range(folds)))) for r in rows]
    scores = spark.createDataFrame(found).groupBy(*grid).agg(
        F.expr("avg(score) FILTER (WHERE part = 'test') AS mean_test_score"),
        F.expr("avg(score) FILTER (WHERE part = 'train') AS mean_train_score"),
    )
    return scores.orderBy(F.desc("mean_test_score"), F.asc("mean_train_score"), *grid)


def tune_stepwise(df: DataFrame, build: Callable, steps: Sequence[Mapping[str, Sequence]] = TUNING_STEPS, **search) -> dict:
    """Tune one group of parameters after the other, keeping each winner."""
    chosen: dict = dict(search.pop("fixed", {}))
    for grid in steps:
        best = grid_search(df, build, grid, fixed=chosen, **search).first().asDict()
        chosen.update({name: best[name] for name in grid})
    return chosen


def final_model(df: DataFrame, horizon: str, **params) -> Model:
    """Fit on all rows, resampled as the horizon asks, with its tuned parameters."""
    settings = {"maxIter": ROUNDS, "stepSize": LEARNING_RATE, **FINAL_PARAMS[horizon], **params}
    rows = durable(SAMPLERS[FINAL_SAMPLER[horizon]](df))
    return fit(rows, boosted_trees(rows=rows.count(), **settings))


def final_models(frames: Mapping[str, DataFrame]) -> dict[str, Model]:
    """One final model per horizon, fitted side by side."""
    with ThreadPool(len(frames)) as pool:
        return dict(zip(frames, pool.map(lambda h: final_model(frames[h], h), frames)))


def save(model: Model, path: str) -> None:
    PipelineModel([model]).write().overwrite().save(path)


def load(path: str) -> Model:
    return PipelineModel.load(path).stages[0]


def importance(model: Model, names: Sequence[str], spark) -> DataFrame:
    """(feature, importance), highest first."""
    pairs = list(zip(names, [float(v) for v in model.featureImportances.toArray()]))
    return spark.createDataFrame(pairs, "feature string, importance double").orderBy(F.desc("importance"), "feature")


def _percent(p: Column) -> Column:
    return F.round(p * 100, 2)


def score(df: DataFrame, models: Mapping[str, Model], keep: Sequence[str] = ("id",)) -> DataFrame:
    """Label and both class probabilities in percent per horizon, in one pass over the rows."""
    scored = as_vectors(df)
    for horizon, model in models.items():
        columns = {"predictionCol": f"_label_{horizon}", "probabilityCol": f"_p_{horizon}", "rawPredictionCol": f"_raw_{horizon}"}
        scored = model.copy({getattr(model, n): v for n, v in columns.items()}).transform(scored)
    out = []
    for horizon in models:
        p = vector_to_array(f"_p_{horizon}")
        out += [
            (F.col(f"_label_{horizon}") == 1).alias(f"result_{horizon}"),
            _percent(p[0]).alias(f"proba_{horizon}_false"),
            _percent(p[1]).alias(f"proba_{horizon}_true"),
        ]
    return scored.select(*keep, *out)
