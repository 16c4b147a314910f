"""Many models in one pass against one fit after the other."""

import pytest
from pyspark.sql import functions as F

from ebbline.operators import boosting, metrics, sampling, selection
from ebbline.operators.boosting import Settings
from tests.test_boosting import data, table


@pytest.fixture(scope="module")
def frame(spark):
    x, y = data(160, 3)
    return table(spark, x, y).cache()


def test_copies_are_those_of_random_oversampling(spark, frame):
    found = {(r.split, r.id): r.n_copies for r in selection.split_copies(frame, 3).collect()}
    rows = sampling.stratified_split(frame, "id", "label", 3, keep=["features"])
    for i in (1, 3):
        split = rows.where(F.col("split") == i)
        made = sampling.random_oversample(split.where("not is_test").select("id", "features", "label"))
        want = {r.id: r["count"] for r in made.groupBy("id").count().collect()}
        want |= {r.id: 0 for r in split.where("is_test").collect()}
        assert {k: n for (s, k), n in found.items() if s == i} == want


def test_comparison_equals_single_fits(spark, frame):
    s = Settings(rounds=3, depth=2)
    board = {(r.sampler, r.part): r for r in selection.compare(frame, {"boosted": s}, 2).collect()}
    assert set(board) == {(a, b) for a in ("none", "random") for b in ("train", "test")}
    edges = boosting.quantile_edges(frame, 3)
    reports = []
    for i in (1, 2):
        split = sampling.stratified_split(frame, "id", "label", 2, keep=["features"]).where(F.col("split") == i)
        train, test = (split.where(c).select("id", "features", "label") for c in ("not is_test", "is_test"))
        copied = sampling.random_oversample(train).select("id", "features", "label")
        forest = boosting.fit(copied, s, edges=edges)
        for part, rows in (("train", copied), ("test", test)):
            scored = rows.select("label", (boosting.probability(forest, F.col("features")) > 0.5).cast("int").alias("prediction"))
            reports.append(metrics.class_report(scored, "label", "prediction").withColumn("part", F.lit(part)))
    union = reports[0]
    for r in reports[1:]:
        union = union.unionByName(r)
    for r in metrics.scoreboard(union, ["part"]).collect():
        got = board["random", r.part].asDict()
        assert {k: got[k] for k in r.asDict() if k != "part"} == {k: v for k, v in r.asDict().items() if k != "part"}


def test_grid_reads_rounds_off_one_fit(spark, frame):
    board = selection.grid_search(frame, {"rounds": [1, 3], "l2": [0.0, 50.0]}, Settings(depth=2, rate=0.5), folds=2).collect()
    assert [(-r.mean_test_score, r.mean_train_score) for r in board] == sorted((-r.mean_test_score, r.mean_train_score) for r in board)
    assert len(board) == 4
    short = selection.grid_search(frame, {"l2": [0.0, 50.0]}, Settings(rounds=1, depth=2, rate=0.5), folds=2).collect()
    assert {(r.l2, r.mean_test_score) for r in board if r.rounds == 1} == {(r.l2, r.mean_test_score) for r in short}
    best = selection.tune_stepwise(frame, [{"depth": [1, 2]}, {"l1": [0.0, 100.0]}], Settings(rounds=2), folds=2)
    assert best.depth in (1, 2) and best.l1 == 0.0
