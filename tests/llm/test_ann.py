import numpy as np

from ebbline.llm import ann

SCHEMA = "vec_id bigint, embedding array<float>, label int, score double, rank int"


def brute(rows, every, k):
    rows = [(i, np.array(v, np.float64)) for i, v in rows]
    out = {}
    for q, a in rows:
        if q % every == 0:
            found = sorted(((-float((a * b).sum()), i) for i, b in rows if i != q))[:k]
            out[q] = [(i, -s) for s, i in found]
    return out


def test_same_neighbours_as_brute_force(spark, monkeypatch):
    monkeypatch.setattr(ann, "BLOCK", 100)
    monkeypatch.setattr(ann, "CHUNK", 20)
    monkeypatch.setattr(ann, "SAMPLE", 256)
    rng = np.random.default_rng(3)
    vectors = rng.normal(size=(900, 16)).astype(np.float32)
    vectors[300:600] = vectors[300]  # a third of all rows is one vector
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)]
    bad = [(1_000, None), (1_001, [0.0] * 16), (1_020, [1.0, None] + [0.0] * 14), (1_040, [float("nan")] * 16), (1_060, [1.0, 2.0]), (None, [1.0] * 16), (1_080, [])]
    table = spark.createDataFrame([(i, v, 0, 1.0, 2) for i, v in rows + bad + rows[:3]], SCHEMA)
    got = {}
    for r in ann.search(table, 20, 10).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    want = brute(rows, 20, 10)
    assert set(got) == set(want)
    for q in want:
        assert np.allclose([s for _, s in got[q]], [s for _, s in want[q]], rtol=1e-12)
        assert [i for i, _ in got[q]] == [i for i, _ in want[q]]


def test_few_and_no_rows(spark):
    table = spark.createDataFrame([(0, [1.0, 0.0], 0, 0.0, 0), (3, [2.0, 1.0], 0, 0.0, 0), (4, [2.0, 1.0], 0, 0.0, 0)], SCHEMA)
    assert [tuple(r) for r in ann.search(table).collect()] == [(0, 1, 3, 2.0), (0, 2, 4, 2.0)]
    assert ann.search(table.limit(0)).count() == 0


def test_bounds_hold():
    rng = np.random.default_rng(9)
    rows, queries = rng.normal(size=(2_000, 32)), rng.normal(size=(50, 32))
    centre, turn = rows.mean(0, keepdims=True), ann.rotation(32)
    code = ann.encode(rows, centre, turn)
    mean, bound = ann.estimate(queries, code, centre[0], turn)
    error = np.abs(mean - queries @ rows.T)
    assert (error <= bound).mean() > 0.995 and abs((mean - queries @ rows.T).mean()) < 0.05
