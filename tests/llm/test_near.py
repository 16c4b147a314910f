import random
import re

from ebbline.llm import graph, near
from tests.llm.cases import awkward, empty, plain


def sets_of(text, width):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if w]
    if not words:
        return set()
    n = min(width, len(words))
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)}


def brute(rows, width=4):
    sets = {i: sets_of(t, width) for i, t in rows}
    parent = {i: i for i, _ in rows}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a in sets:
        for b in sets:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return {(i, len(sets[i]), root(i), root(i) == i) for i in sets}


def chains(seed, n=240):
    """Groups whose copies change little by little, so that links form chains and stars."""
    rng = random.Random(seed)
    word = lambda: "w%d" % rng.randrange(5_000)
    out, shared = [], [word() for _ in range(40)]
    for _ in range(12):
        base = [word() for _ in range(rng.randrange(30, 90))]
        for _ in range(n // 12):
            text = list(base if rng.random() < 0.6 else (out[-1].split() if out else base))
            for _ in range(rng.randrange(3)):
                text[rng.randrange(len(text))] = word()
            if rng.random() < 0.2:
                text = shared + text
            out.append(" ".join(text))
    rng.shuffle(out)
    return out


def test_same_components_as_all_pairs(spark):
    texts = chains(3) + ["one two", "One  TWO", "", None, "one two three four", "short"]
    got = {tuple(r) for r in near.near_duplicates(plain(spark, texts)).collect()}
    assert got == brute(list(enumerate(texts)))


def test_awkward_rows(spark):
    rows = near.near_duplicates(awkward(spark)).collect()
    assert len(rows) == 11
    assert [r.kept for r in rows if r.doc_id == 1] == [True] * 3
    assert all(r.n_shingles == 0 and r.kept for r in rows if r.doc_id in (2, 3, 5))
    assert near.near_duplicates(empty(spark)).count() == 0


def test_filter_keeps_one_of_each_group_and_all_columns(spark):
    docs = awkward(spark)
    left = near.drop_near_duplicates(docs)
    assert left.columns == docs.columns
    rows = left.collect()
    assert sorted(r.doc_id for r in rows if r.doc_id is not None) == [1, 2, 3, 4, 5, 6, 7]
    assert sum(r.doc_id is None for r in rows) == 2


def test_components(spark):
    rng = random.Random(1)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(1_000 + i, 1_001 + i) for i in range(60)] + [(5, 5)]
    got = {r.node: r.component for r in graph.connected_components(spark.createDataFrame(edges, "src bigint, dst bigint")).collect()}
    want = {n: n for e in edges for n in e if e[0] != e[1]}
    for _ in range(400):
        for a, b in edges:
            if a != b:
                want[a] = want[b] = min(want[a], want[b])
    assert got == want
