import random
import re
from collections import Counter

import numpy as np
import pytest

from ebbline.llm import superkmers
from tests.llm.cases import awkward, documents, empty, plain


def words_of(text):
    return [w for w in re.split(r"[\x20\x09-\x0D]+", text or "") if w]


def brute(rows, width=35):
    words = [(i, words_of(t)) for i, t in rows]
    seen = Counter(tuple(w[j : j + width]) for _, w in words for j in range(len(w) - width + 1))
    out = []
    for i, w in words:
        gone = {j + k for j in range(len(w) - width + 1) if seen[tuple(w[j : j + width])] > 1 for k in range(width)}
        out.append((i, len(w), len(gone), " ".join(x for j, x in enumerate(w) if j not in gone)))
    return sorted(out, key=str)


def result(docs, **options):
    rows = superkmers.remove_repeats(docs, **options).collect()
    for r in rows:
        assert sum(s.stop - s.start for s in r.removed) == r.n_removed
    return sorted(((r.doc_id, r.n_words, r.n_removed, r.kept) for r in rows), key=str)


def passages(seed, n=150):
    """Texts that share passages of all lengths, in part and at all places, with copies."""
    rng = random.Random(seed)
    word = lambda: "w%d" % rng.randrange(4_000)
    shared = [[word() for _ in range(rng.randrange(20, 90))] for _ in range(8)]
    out = []
    for _ in range(n):
        text = []
        for _ in range(rng.randrange(1, 5)):
            text += [word() for _ in range(rng.randrange(40))]
            if rng.random() < 0.5:
                p = rng.choice(shared)
                a, b = sorted(rng.sample(range(len(p) + 1), 2))
                text += p if rng.random() < 0.5 else p[a:b]
        out.append(rng.choice([" ", "\n", "\t  "]).join(text))
    return out + out[:7] + [" ".join(["a"] * 80), " ".join(["a"] * 34), " ".join(["b"] * 35), " ".join(["a", "b"] * 40)]


@pytest.fixture
def all_heavy(monkeypatch):
    """Every bucket is counted window by window, and every key is a hot one."""
    monkeypatch.setattr(superkmers, "HEAVY", 0)
    monkeypatch.setattr(superkmers, "HOT", 2)


def test_same_as_all_windows(spark):
    texts = passages(1)
    assert result(plain(spark, texts)) == brute(list(enumerate(texts)))


def test_heavy_buckets_give_the_same(spark, all_heavy):
    texts = passages(2, 60)
    assert result(plain(spark, texts)) == brute(list(enumerate(texts)))


def test_hot_keys_beyond_the_broadcast_bound(spark, all_heavy, monkeypatch):
    monkeypatch.setattr(superkmers, "bounded", lambda t: t)
    texts = passages(3, 30)
    assert result(plain(spark, texts)) == brute(list(enumerate(texts)))


def test_given_documents(spark):
    docs = documents(spark)
    found = result(docs)
    assert found == brute([(r.doc_id, r.text) for r in docs.collect()])
    assert sum(r[2] for r in found) > 0


def test_awkward_rows(spark):
    docs = awkward(spark)
    assert result(docs) == brute([(r.doc_id, r.text) for r in docs.collect()])
    assert result(empty(spark)) == []


def test_minimisers_and_ranks_against_plain_code():
    rng = np.random.default_rng(4)
    hashes = rng.integers(0, 2**63, 6, dtype=np.uint64)[rng.integers(0, 6, 300)]
    value, moved = superkmers.minimisers(hashes, 12, 3)
    core = {tuple(hashes[i : i + 3]): superkmers.minimisers(hashes[i : i + 3], 3, 3)[0][0] for i in range(298)}
    cores = [core[tuple(hashes[i : i + 3])] for i in range(298)]
    places = [min(range(i, i + 10), key=lambda j: (cores[j], j)) for i in range(289)]
    assert [cores[p] for p in places] == list(value)
    assert [True] + [a != b for a, b in zip(places, places[1:])] == list(moved)
    ids = rng.integers(0, 2, 400)
    ranks = superkmers.window_ranks(ids, 7)
    names = {}
    for i, r in enumerate(ranks):
        assert names.setdefault(r, tuple(ids[i : i + 7])) == tuple(ids[i : i + 7])
    assert len(names) == len({tuple(ids[i : i + 7]) for i in range(394)})
