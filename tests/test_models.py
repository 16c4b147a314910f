"""Resampling, neighbours, metrics and models."""

import math
import tracemalloc

import numpy as np
import pytest
from pyspark.sql import functions as F

from ebbline.operators import metrics, models, neighbours, sampling


def vectors(spark, points):
    return spark.createDataFrame([(i, [float(x) for x in p]) for i, p in enumerate(points)], "id bigint, features array<double>")


def brute(points, ids, k):
    out = {}
    for q in ids:
        d = [(sum((a - b) ** 2 for a, b in zip(points[q], p)), i) for i, p in enumerate(points) if i != q]
        out[q] = [i for _, i in sorted(d)[:k]]
    return out


def found(df):
    out = {}
    for r in df.collect():
        out.setdefault(r.id, {})[r["rank"]] = r.neighbour
    return {i: [n for _, n in sorted(hits.items())] for i, hits in out.items()}


@pytest.mark.parametrize("cells", [1, 6])
def test_neighbours_equal_brute_force(spark, monkeypatch, cells):
    """Clusters, a third of exact copies, blocks and query groups smaller than the data."""
    monkeypatch.setattr(neighbours, "BLOCK_ROWS", 40)
    monkeypatch.setattr(neighbours, "QUERY_ROWS", 50)
    rng = np.random.default_rng(7)
    points = [tuple(np.round(rng.normal(c, 0.3, 3), 2)) for c in rng.integers(0, 5, 120) * 3]
    points += [(1.0, 1.0, 1.0)] * 60
    df = vectors(spark, points)
    assert found(neighbours.nearest(df, df, 4, cells)) == brute(points, range(len(points)), 4)
    some = df.where("id % 7 = 0")
    assert found(neighbours.nearest(some, df, 4, cells)) == brute(points, range(0, len(points), 7), 4)


@pytest.mark.parametrize("scale", [1.0, 1e-170, 1e200])
def test_screened_rows_equal_measured_ones(monkeypatch, scale):
    """Ties, near ties, tiny and overflowing values, NaN: the same places and bits as measuring everything."""
    monkeypatch.setattr(neighbours, "SCREENED", 700)
    rng = np.random.default_rng(5)
    points = np.concatenate([rng.integers(0, 3, (60, 4)), rng.normal(1, 1e-9, (40, 4)), [[np.nan, 0, 0, 0], [np.inf, 0, 0, 0]]]) * scale
    queries = points[::3]
    with np.errstate(all="ignore"):
        d = neighbours.squared_distances(queries, points)
    order = np.argsort(d, axis=1, kind="stable")[:, :6]
    place, distance = neighbours.closest_rows(queries, points, 6)
    assert (place == order).all()
    np.testing.assert_array_equal(distance, np.take_along_axis(d, order, 1))


def test_a_full_block_is_searched_in_little_memory():
    rng = np.random.default_rng(6)
    points = rng.normal(size=(neighbours.BLOCK_ROWS, 16))
    tracemalloc.start()
    neighbours.closest_rows(points[:600], points, 6)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 100e6  # distances of 512 rows to a block, their differences and their order took 330 MB


def test_neighbours_of_tiny_sets(spark):
    df = vectors(spark, [(0.0,), (1.0,)])
    assert found(neighbours.nearest(df, df, 5)) == {0: [1], 1: [0]}
    assert neighbours.nearest(df, df.limit(0), 5).count() == 0


@pytest.fixture(scope="module")
def frame(spark):
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in rng.normal(2.0 * (i % 6 == 0), 1.0, 4)], int(i % 6 == 0)) for i in range(180)]
    return spark.createDataFrame(rows, "id bigint, features array<double>, label int").cache()


def test_splits_keep_class_shares(spark, frame):
    split = sampling.stratified_split(frame, "id", "label", n_splits=3)
    sizes = {(r.split, r.label): r.n for r in split.where("is_test").groupBy("split", "label").agg(F.count("*").alias("n")).collect()}
    assert sizes == {(s, c): n for s in (1, 2, 3) for c, n in ((0, 38), (1, 8))}
    assert split.where("is_test").groupBy("id").count().where("count < 3").count() > 0


def test_folds_partition_every_class(spark, frame):
    folds = sampling.stratified_folds(frame, "id", "label", 4).groupBy("fold", "label").count()
    by = {}
    for r in folds.collect():
        by.setdefault(r.label, []).append(r["count"])
    assert {c: (sum(v), max(v) - min(v) <= 1) for c, v in by.items()} == {0: (150, True), 1: (30, True)}


@pytest.mark.parametrize("name", ["random", "smote"])
def test_samplers_reach_parity_and_keep_given_rows(spark, frame, name):
    out = sampling.SAMPLERS[name](frame)
    assert {r.label: r["count"] for r in out.groupBy("label").count().collect()} == {0: 150, 1: 150}
    assert out.where("token IS NULL").select("id").subtract(frame.select("id")).count() == 0
    assert sorted(out.where("token IS NOT NULL").collect()) == sorted(sampling.SAMPLERS[name](frame).where("token IS NOT NULL").collect())


def test_smote_points_lie_between_minority_rows(spark, frame):
    rare = {r.id: np.array(r.features) for r in frame.where("label = 1").collect()}
    for r in sampling.smote(frame).where("token IS NOT NULL").collect():
        base, point = rare[r.id], np.array(r.features)
        gaps = [np.linalg.norm(base - o) - np.linalg.norm(base - point) - np.linalg.norm(point - o) for o in rare.values()]
        assert max(gaps) > -1e-9


def test_adasyn_adds_where_the_majority_is_near(spark, frame):
    wanted = {r.id: r.n_new for r in sampling.adasyn_allocation(frame).collect()}
    made = {r.id: r["count"] for r in sampling.adasyn(frame).where("token IS NOT NULL").groupBy("id").count().collect()}
    assert made == {i: n for i, n in wanted.items() if n}
    assert abs(sum(wanted.values()) - 120) <= 15


def test_adasyn_splits_long_runs(spark, frame, monkeypatch):
    monkeypatch.setattr(sampling, "DRAWS_PER_ROW", 2)
    made = sampling.adasyn(frame).where("token IS NOT NULL")
    assert made.count() == made.select("token").distinct().count() == sampling.adasyn_allocation(frame).agg(F.sum("n_new")).first()[0]


def test_samplers_on_balanced_or_single_class(spark, frame):
    even = frame.where("label = 1").unionByName(frame.where("label = 0").orderBy("id").limit(30))
    assert sampling.random_oversample(even).count() == 60
    assert sampling.random_oversample(frame.where("label = 0")).count() == 150


def test_report_identities(spark):
    rows = [(0, 0)] * 5 + [(0, 1)] * 2 + [(1, 1)] * 3
    r = metrics.class_report(spark.createDataFrame(rows, "label int, prediction int"), "label", "prediction").first()
    assert math.isclose(r.precision_1, 0.6) and r.recall_1 == 1.0 and math.isclose(r.f1_1, 0.75) and r.accuracy == 0.8
    never = metrics.class_report(spark.createDataFrame([(1, 0)], "label int, prediction int"), "label", "prediction").first()
    assert (never.precision_1, never.recall_0, never.f1_1) == (0.0, 0.0, 0.0)


def test_scoreboard_rounds_half_to_even(spark):
    reports = spark.createDataFrame([("a", 0.0005), ("a", 0.0005), ("b", 0.0015), ("b", 0.0015)], "part string, accuracy double")
    assert {r.part: r.accuracy for r in metrics.scoreboard(reports, ["part"]).collect()} == {"a": 0.0, "b": 0.002}


def test_fit_save_load_score(spark, frame, tmp_path):
    model = models.fit(frame, models.boosted_trees(maxIter=3))
    models.save(model, str(tmp_path / "m"))
    again = models.load(str(tmp_path / "m"))
    both = models.score(frame, {"3m": model, "6m": again}).collect()
    assert all(r.proba_3m_true == r.proba_6m_true and abs(r.proba_3m_true + r.proba_3m_false - 100) <= 0.011 for r in both)
    top = models.importance(model, ["a", "b", "c", "d"], spark).collect()
    assert math.isclose(sum(r.importance for r in top), 1.0, abs_tol=1e-9) and top[0].importance >= top[-1].importance


def test_comparison_and_choice(spark, frame):
    board = models.compare(frame, ["gradient_boosting"], ["none", "random"], n_splits=2, params={"gradient_boosting": {"maxIter": 2}})
    rows = board.collect()
    assert len(rows) == 4 and all(0 <= r.accuracy <= 1 for r in rows)
    best = models.best_combination(board).first()
    assert best.part == "test" and best.f1_1 == max(r.f1_1 for r in rows if r.part == "test")


def test_grid_order_and_stepwise_choice(spark, frame):
    board = models.grid_search(frame, models.boosted_trees, {"maxDepth": [1, 3]}, {"maxIter": 1}, folds=2, scoring="f1_micro")
    rows = board.collect()
    assert rows == sorted(rows, key=lambda r: (-r.mean_test_score, r.mean_train_score))
    chosen = models.tune_stepwise(frame, models.boosted_trees, [{"maxDepth": [1]}, {"minInstancesPerNode": [1, 40]}], fixed={"maxIter": 1}, folds=2)
    assert chosen["maxDepth"] == 1 and chosen["minInstancesPerNode"] in (1, 40) and chosen["maxIter"] == 1


def test_tuned_trees_split(spark):
    """Gamma is a sum over rows, Spark's least gain a mean: carried over as it is, no tree would split."""
    rows = [(i, [float(i % 17), float(i % 5), float(i * 7 % 11)], int(i % 17 > 13)) for i in range(400)]
    df = spark.createDataFrame(rows, "id bigint, features array<double>, label int")
    assert all(t.numNodes > 1 for t in models.final_model(df, "1y", maxIter=3).trees[:2])
