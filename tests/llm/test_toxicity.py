import random

import numpy as np
import pytest

from ebbline.llm import toxicity
from tests.llm.cases import awkward, empty, plain


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(2)
    sentence = lambda: " ".join("w%s" % "".join(rng.choices("abcdefg", k=2)) for _ in range(8)) + "."
    texts, labels = [], []
    for i in range(900):
        body = [sentence() for _ in range(rng.randrange(1, 12))]
        bad = i % 6 == 0
        if bad:
            at = rng.randrange(len(body))
            body[at] = body[at].replace(".", f" {rng.choice(['vileness', 'nastywords', 'nastying'])}.")
        texts.append(" ".join(body))
        labels.append((i, int(bad)))
    return texts, labels


def test_held_out_accuracy_and_location(spark, corpus):
    texts, labels = corpus
    known = spark.createDataFrame(labels, "doc_id bigint, toxic int")
    rows = toxicity.toxicity(plain(spark, texts), known).collect()
    truth = dict(labels)
    held = [r for r in rows if r.held_out]
    assert 200 < len(held) < 400
    assert sum(r.predicted == truth[r.doc_id] for r in held) >= 0.97 * len(held)
    for r in held:
        for s in r.offending if truth[r.doc_id] and r.predicted else []:
            assert any(w in texts[r.doc_id][s.start : s.end] for w in ("vile", "nasty"))


def test_awkward_rows(spark, corpus):
    texts, labels = corpus
    known = spark.createDataFrame(labels + [(1, None), (1, 0), (None, 1)], "doc_id bigint, toxic int")
    rows = toxicity.toxicity(awkward(spark).union(awkward(spark)), known).collect()
    assert len(rows) == 22 and all(0 <= r.score <= 1 for r in rows)
    assert toxicity.toxicity(empty(spark), known).count() == 0
    assert toxicity.toxicity(awkward(spark), spark.createDataFrame([], "doc_id bigint, toxic int")).where("predicted = 1").count() == 0
    left = toxicity.drop_toxic(awkward(spark), known)
    assert left.columns == awkward(spark).columns


def test_gradient_is_the_slope_of_the_noisy_or():
    """Loss in plain loops: P(toxic) = 1 - prod over sentences of (1 - sigmoid(bias + weights))."""
    rng = np.random.default_rng(3)
    texts = [[list(rng.choice(6, rng.integers(0, 4), replace=False)) for _ in range(rng.integers(1, 5))] for _ in range(20)]
    toxic = rng.integers(0, 2, 20)
    balance = rng.uniform(0.5, 2, 20)

    def loss(w):
        total = 0.0
        for sentences, label, weight in zip(texts, toxic, balance):
            clean = 1.0
            for words in sentences:
                clean *= 1 - 1 / (1 + np.exp(-(w[-1] + sum(w[i] for i in words))))
            total -= weight * np.log(1 - clean if label else clean)
        return total

    flat = [words for sentences in texts for words in sentences]
    sentence = np.array([k for k, words in enumerate(flat) for _ in words])
    word = np.array([i for words in flat for i in words])
    w = rng.normal(0, 1, 7)
    got = toxicity.noisy_or_gradient(toxic, balance, np.array([len(t) for t in texts]), sentence, word, w)
    step = np.eye(7) * 1e-6
    assert np.allclose(got, [(loss(w + s) - loss(w - s)) / 2e-6 for s in step], atol=1e-5)


def test_labelled_ids_pass_the_filter(spark, corpus):
    """Weights don't depend on which texts a filter keeps out before the join."""
    texts, labels = corpus
    known = spark.createDataFrame(labels, "doc_id bigint, toxic int")
    docs = plain(spark, texts)
    model = toxicity.train(docs, known)
    extra = docs.union(docs.selectExpr("doc_id + 100000", "text", "lang", "source", "n_chars"))
    again = toxicity.train(extra, known)
    assert model.weights == again.weights and model.bias == again.bias
