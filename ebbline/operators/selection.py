"""Choice of boosted models: repeated splits, grids and stepwise tuning, all models of a step in one pass.

Splits and folds are whole-number weights of the rows of one binned frame (see ``boosting``): a test
row weighs nothing, a row drawn again by oversampling weighs more.  No row is copied, and a grid
over the number of rounds costs one fit of the most rounds, scored after each.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import replace
from itertools import product

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbline.functions.numbers import hash_int
from ebbline.operators import boosting, metrics
from ebbline.operators.boosting import Forest, Settings
from ebbline.operators.ranking import before_cut, hash_cut, hash_rank, hashed
from ebbline.operators.sampling import SEED, SPLITS, stratified_folds, stratified_split
from ebbline.session import durable

# Tuned boosting parameters per horizon, L1 and L2 weights included.
FINAL_SETTINGS = {
    "3m": Settings(depth=6, least_child=12, gamma=0.008, rows=0.9, columns=0.95, l1=0.01, l2=1.0),
    "6m": Settings(depth=4, least_child=8, gamma=0.0, rows=0.65, columns=0.55, l1=0.0, l2=1.0),
    "1y": Settings(depth=6, least_child=3, gamma=0.15, rows=0.7, columns=0.9, l1=0.01, l2=0.0),
}
# The order in which parameters are tuned, coarse grids followed by finer ones.
TUNING_STEPS = (
    {"depth": [4, 5, 6, 7], "least_child": [1, 2, 3, 4, 5]},
    {"least_child": [6, 8, 10, 12]},
    {"gamma": [0.0, 0.1, 0.2, 0.3, 0.4]},
    {"rows": [0.6, 0.7, 0.8, 0.9], "columns": [0.6, 0.7, 0.8, 0.9]},
    {"rows": [0.6, 0.65, 0.7, 0.75, 0.8], "columns": [0.5, 0.55, 0.6, 0.65, 0.7]},
    {"l1": [1e-5, 0.01, 0.1, 1, 100]},
    {"l1": [0, 1e-6, 1e-5, 1e-4, 1e-3]},
    {"l2": [1e-5, 0.01, 0.1, 1, 100]},
)


def split_copies(df: DataFrame, n_splits: int = SPLITS, seed: int = SEED) -> DataFrame:
    """(split, id, label, is_test, n_copies): how often each row counts after random oversampling.

    Test rows count 0 times, training rows once and minority rows once more for each draw.  Draws are
    those of ``sampling.random_oversample`` on the split's training rows, for all splits together.
    """
    rows = durable(stratified_split(df, "id", "label", n_splits, seed=seed))
    train = hashed(rows.where(~F.col("is_test")).select("split", "id", "label"), "id", F.lit(seed))
    sizes = train.where("label = 1").groupBy("split").agg(F.count("*").alias("n1"))
    counted = train.where("label = 0").join(F.broadcast(sizes), "split")  # one row per split
    # Every split has the same number of minority rows, so the cut can use it as a plain number.
    n1 = sizes.agg(F.max("n1")).first()[0] or 0
    cut = F.broadcast(hash_cut(counted, ["split"], "id", F.greatest(F.col("_total") - n1, F.lit(0))))
    draws = counted.join(cut, "split", "left").where(before_cut("id"))
    picks = draws.select("split", (hash_int(F.col("id"), F.lit(seed), F.lit("base")) % F.col("n1") + 1).alias("rank"))
    drawn = picks.groupBy("split", "rank").agg(F.count("*").alias("n_drawn"))
    ranked = hash_rank(train.where("label = 1"), ["split"], "id").select("split", "id", "rank")
    more = ranked.join(drawn, ["split", "rank"]).select("split", "id", "n_drawn")
    copies = F.when(F.col("is_test"), 0).otherwise(1 + F.coalesce("n_drawn", F.lit(0))).cast("bigint")
    return rows.join(more, ["split", "id"], "left").select("split", "id", "label", "is_test", copies.alias("n_copies"))


def _weighted(df: DataFrame, copies: DataFrame, n: int, value: Column) -> DataFrame:
    """``df`` with an array of ``n`` numbers per row from (id, place, ...) rows."""
    arrays = copies.groupBy("id").agg(F.map_from_entries(F.collect_list(F.struct("place", value.alias("w")))).alias("_by"))
    array = F.transform(F.sequence(F.lit(1), F.lit(n)), lambda i: F.coalesce(F.col("_by")[i], F.lit(0)).cast("int"))
    return df.join(arrays, "id").withColumn("weights", array).drop("_by")


def _predictions(forests: Sequence[Forest], stages: Sequence[int]) -> Column:
    """Predicted classes of every model after each of ``stages`` rounds: models x stages in one array."""

    @F.pandas_udf("array<int>")
    def predicted(features: pd.Series) -> pd.Series:
        bins = boosting.binned_matrix(features, forests[0].edges)
        return pd.Series(list(np.concatenate([f.margins(bins, stages) > 0 for f in forests], axis=1).astype(np.int32)))

    return predicted(F.col("features"))


def compare(df: DataFrame, settings: Mapping[str, Settings], n_splits: int = SPLITS) -> DataFrame:
    """Scoreboard (model, sampler, part, scores) over repeated splits, unsampled and randomly oversampled.

    ``len(settings) * 2 * n_splits`` models are grown in one pass over (id, features, label).
    """
    base = durable(df.select("id", "features", "label"))
    copies = durable(split_copies(base, n_splits))
    once = copies.select("id", F.col("split").alias("place"), F.least("n_copies", F.lit(1)).alias("w"))
    again = copies.select("id", (F.col("split") + n_splits).alias("place"), F.col("n_copies").alias("w"))
    names = list(settings)
    rows = _weighted(base, once.union(again), 2 * n_splits, F.col("w"))
    rows = durable(rows.withColumn("weights", F.flatten(F.array_repeat("weights", len(names)))))
    forests = boosting.fit_many(rows, [settings[m] for m in names for _ in range(2 * n_splits)])
    predicted = rows.select("id", "label", "weights", _predictions(forests, [max(s.rounds for s in settings.values())]).alias("_p"))
    each = predicted.select("label", F.posexplode(F.arrays_zip("weights", "_p")).alias("at", "_x"))
    place = F.col("at") % (2 * n_splits)
    named = each.select(
        F.element_at(F.array(*[F.lit(m) for m in names]), (F.floor(F.col("at") / (2 * n_splits)) + 1).cast("int")).alias("model"),
        F.when(place < n_splits, "none").otherwise("random").alias("sampler"), (place % n_splits + 1).alias("split"),
        F.when(F.col("_x.weights") == 0, "test").otherwise("train").alias("part"), "label", F.col("_x._p").alias("prediction"),
        F.greatest(F.lit(1), F.col("_x.weights")).alias("times"),
    )
    # Training scores are those of the resampled rows: a row drawn again counts again.
    counted = named.withColumn("times", F.explode(F.sequence(F.lit(1), F.col("times"))))
    return metrics.scoreboard(metrics.class_report(counted, "label", "prediction", ["model", "sampler", "split", "part"]), ["model", "sampler", "part"])


def grid_search(
    df: DataFrame, grid: Mapping[str, Sequence], fixed: Settings = Settings(), folds: int = 4, scoring: str = "f1"
) -> DataFrame:
    """(params..., mean_test_score, mean_train_score), best first; all points and folds in one pass.

    A grid over ``rounds`` is read off one fit of the most rounds.  ``scoring`` is ``f1`` of the rare
    class or ``f1_micro`` (accuracy).  Equal test scores go to the lower train score.
    """
    score = {"f1": "f1_1", "f1_micro": "accuracy"}[scoring]
    stages = sorted(int(r) for r in grid.get("rounds", [fixed.rounds]))
    others = {k: v for k, v in grid.items() if k != "rounds"}
    points = [dict(zip(others, values)) for values in product(*others.values())]
    rows = stratified_folds(df.select("id", "features", "label"), "id", "label", folds)
    weights = F.flatten(F.array_repeat(F.array(*[(F.col("fold") != k).cast("int") for k in range(folds)]), len(points)))
    rows = durable(rows.withColumn("weights", weights))
    forests = boosting.fit_many(rows, [replace(fixed, rounds=stages[-1], **p) for p in points for _ in range(folds)])
    each = rows.select("fold", "label", F.posexplode(_predictions(forests, stages)).alias("at", "prediction"))
    model = F.floor(F.col("at") / len(stages))
    named = each.select(
        F.floor(model / folds).cast("int").alias("point"), (F.col("at") % len(stages)).cast("int").alias("stage"), (model % folds).alias("k"),
        F.when(F.col("fold") == model % folds, "test").otherwise("train").alias("part"), "label", "prediction",
    )
    reports = metrics.class_report(named, "label", "prediction", ["point", "stage", "k", "part"])
    means = reports.groupBy("point", "stage").agg(
        F.avg(F.when(F.col("part") == "test", F.col(score))).alias("mean_test_score"),
        F.avg(F.when(F.col("part") == "train", F.col(score))).alias("mean_train_score"),
    )
    table = df.sparkSession.createDataFrame(
        [(i, j, *[float(p[k]) for k in others], r) for i, p in enumerate(points) for j, r in enumerate(stages)],
        ", ".join(["point int, stage int", *[f"{k} double" for k in others], "rounds int"]),
    )
    names = [*others, "rounds"]
    scored = means.join(F.broadcast(table), ["point", "stage"]).select(*names, "mean_test_score", "mean_train_score")  # the grid
    return scored.orderBy(F.desc("mean_test_score"), F.asc("mean_train_score"), *names)


def tune_stepwise(df: DataFrame, steps: Sequence[Mapping[str, Sequence]] = TUNING_STEPS, fixed: Settings = Settings(), **search) -> Settings:
    """Tune one group of parameters after the other, keeping each winner."""
    for grid in steps:
        best = grid_search(df, grid, fixed, **search).first()
        fixed = replace(fixed, **{k: int(best[k]) if k in ("depth", "rounds") else best[k] for k in grid})
    return fixed
