"""Second-order boosting against plain loops."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from ebbline.operators import boosting
from ebbline.operators.boosting import UNIT, Settings


def data(n=500, width=6, seed=3):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, width)).round(2)
    x[:, 1] = rng.integers(0, 4, n)
    y = ((x[:, 0] + 0.5 * x[:, 1] + rng.normal(size=n)) > 1).astype(int)
    return x, y


def table(spark, x, y, weights=None):
    rows = [(i, [float(v) for v in r], int(t), *([] if weights is None else [weights[i]])) for i, (r, t) in enumerate(zip(x, y))]
    schema = "id bigint, features array<double>, label int" + ("" if weights is None else ", weights array<int>")
    return spark.createDataFrame(rows, schema)


def plain_trees(x, y, w, edges, s):
    """Row by row and split by split; returns per round {node: (feature, threshold) or leaf value}."""
    margin, out = np.zeros(len(y)), []
    soft = lambda g: np.sign(g) * max(abs(g) - s.l1, 0.0)
    for _ in range(s.rounds):
        g, h = boosting.gradients(margin, y)
        g, h = g * w / UNIT, h * w / UNIT
        tree, todo = {}, [(0, 0, np.arange(len(y)))]
        while todo:
            node, level, rows = todo.pop()
            best = None
            score = lambda r: soft(g[r].sum()) ** 2 / (h[r].sum() + s.l2) if h[r].sum() + s.l2 > 0 else 0.0
            for f in range(x.shape[1]) if level < s.depth else ():
                for t in edges[f]:
                    left, right = rows[x[rows, f] <= t], rows[x[rows, f] > t]
                    if min(h[left].sum(), h[right].sum()) < s.least_child or not len(left) or not len(right) or not h[left].sum() or not h[right].sum():
                        continue
                    gain = 0.5 * (score(left) + score(right) - score(rows)) - s.gamma
                    if gain > 1e-9 and (best is None or gain > best[0] + 1e-12):
                        best = gain, f, t, left, right
            if best is None:
                tree[node] = -s.rate * soft(g[rows].sum()) / (h[rows].sum() + s.l2) if h[rows].sum() + s.l2 > 0 else 0.0
                margin[rows] += tree[node]
            else:
                tree[node] = best[1], float(best[2])
                todo += [(2 * node + 1, level + 1, best[3]), (2 * node + 2, level + 1, best[4])]
        out.append(tree)
    return out, margin


def trees_of(forest, spark):
    found = {}
    for r in boosting.tree_table(forest, spark).collect():
        found.setdefault(r.round, {})[r.node] = (r.feature, r.threshold) if r.feature >= 0 else r.value
    return found


def assert_same(forest, spark, want):
    got = trees_of(forest, spark)
    for r, tree in enumerate(want):
        assert set(got[r]) == set(tree)
        for node, x in tree.items():
            assert got[r][node] == x if isinstance(x, tuple) else got[r][node] == pytest.approx(x, abs=1e-9)


def test_every_split_and_leaf_as_plain_loops(spark):
    x, y = data()
    weights = [[1, i % 3, 2 if i % 5 else 0] for i in range(len(y))]
    settings = [
        Settings(rounds=3, depth=3), Settings(rounds=2, depth=2, l1=0.7, l2=0.0, gamma=0.4, rate=0.3),
        Settings(rounds=2, depth=4, l1=0.01, l2=5.0, least_child=6.0),
    ]
    df = table(spark, x, y, weights).repartition(3)
    edges = boosting.quantile_edges(df, x.shape[1], 12)
    forests = boosting.fit_many(df, settings, edges)
    bins = boosting.binned_matrix(df.toPandas().sort_values("id")["features"], edges)
    for m, (forest, s) in enumerate(zip(forests, settings)):
        want, margin = plain_trees(x, y, np.array([w[m] for w in weights]), edges, s)
        assert_same(forest, spark, want)
        assert np.allclose(forest.margins(bins)[:, 0], margin, atol=1e-9)


def test_same_trees_on_any_partitions_and_after_writes(spark, monkeypatch):
    monkeypatch.setattr(boosting, "WRITE_EVERY", 2)
    x, y = data(300)
    s = Settings(rounds=5, depth=3, rows=0.7, columns=0.6)
    a, b = (boosting.fit(table(spark, x, y).repartition(n), s) for n in (2, 7))
    assert (a.feature == b.feature).all() and (a.cut == b.cut).all() and (a.value == b.value).all()
    assert len({tuple(sorted(set(t[t >= 0]))) for t in a.feature}) > 1


def test_one_pass_of_many_models_equals_single_fits(spark, monkeypatch):
    x, y = data(200)
    weights = [[int(i % 4 != k) for k in range(4)] for i in range(200)]
    s = Settings(rounds=2, depth=2)
    many = boosting.fit_many(table(spark, x, y, weights), [s] * 4)
    monkeypatch.setattr(boosting, "CELLS", 1)
    grouped = boosting.fit_many(table(spark, x, y, weights), [s] * 4)
    for k in range(4):
        edges = many[k].edges
        alone = boosting.fit(table(spark, x, y, [[w[k]] for w in weights]), s, edges=edges)
        for other in (alone, grouped[k]):
            assert (many[k].feature == other.feature).all() and (many[k].value == other.value).all()


def test_staged_scores_equal_separate_fits(spark):
    x, y = data(200)
    df = table(spark, x, y)
    long = boosting.fit(df, Settings(rounds=4, depth=2))
    short = boosting.fit(df, Settings(rounds=2, depth=2))
    rows = df.select(
        boosting.staged_probabilities(long, F.col("features"), [4, 0, 2]).alias("staged"),
        boosting.probability(long, F.col("features")).alias("all"), boosting.probability(short, F.col("features")).alias("two"),
    ).collect()
    assert all(r.staged == [r["all"], 0.5, r.two] for r in rows)
    loss = [-np.mean(np.log(np.where(y == 1, [r.staged[k] for r in rows], [1 - r.staged[k] for r in rows]))) for k in (1, 2, 0)]
    assert loss[0] > loss[1] > loss[2]


def test_awkward_frames(spark):
    nothing = boosting.fit(spark.createDataFrame([], "id bigint, features array<double>, label int"), Settings(rounds=2))
    assert (nothing.feature == -1).all()
    one_class = boosting.fit(table(spark, np.ones((5, 2)), np.ones(5, int)), Settings(rounds=2, depth=2))
    assert (one_class.feature == -1).all() and one_class.value[0, 0] > 0
    gaps = spark.createDataFrame([(i, [None if i % 2 else float(i), 1.0], i % 2) for i in range(40)], "id bigint, features array<double>, label int")
    split = boosting.fit(gaps, Settings(rounds=1, depth=1))
    assert split.feature[0, 0] == 0 and split.importance()[0] == 1.0
