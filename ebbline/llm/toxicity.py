"""Toxicity by multiple-instance learning: a text is toxic if any of its sentences is.

Sentences have scores of their own, p = sigmoid(b + sum of the weights of its distinct words), a
word weighing what itself and its beginnings of 4 to 8 letters do (so inflected forms share), and
a text's score is their noisy-or, 1 - prod(1 - p).  Only whole texts are labelled, so the
weights are learned through the noisy-or; afterwards they point at the offending sentences.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbline.llm.bloom import Bloom, bloom_of
from ebbline.session import bounded, discard, written

#: Words and beginnings that may have weights: those whose share of toxic texts is the least
#: likely to be chance.
VOCABULARY = 2_048
STEMS = range(4, 9)
#: Each needs this many different labelled texts.
LEAST_TEXTS = 12
#: Texts of either class that the weights are fitted on, on average (chosen by hash); the word
#: statistics that select the vocabulary cover every labelled text.
FIT_TEXTS = 5_000
REJECT = 0.7
STEPS, RATE, SHRINK, L1, EPS = 500, 0.1, 1e-5, 2e-4, 1e-6
FLUSH = 200_000
CACHE = 60_000
_WORD = re.compile(r"[^\W\d_]+")
_SENTENCE = re.compile(r"[^.!?\n]+")


def parts(word: str) -> set[str]:
    """The word and its beginnings."""
    return {word, *(word[:k] for k in STEMS)} if len(word) >= STEMS.start else {word}


class _Weights(dict):
    """Word to the sum of its parts' weights; starts anew when it holds ``CACHE`` words."""

    def __init__(self, weights: dict[str, float]):
        self.weights = weights

    def __missing__(self, word: str) -> float:
        if len(self) >= CACHE:
            self.clear()
        self[word] = x = sum(self.weights.get(p, 0.0) for p in parts(word))
        return x


@dataclass(frozen=True)
class Model:
    bias: float
    weights: dict[str, float]

    def sentences(self, text: str | None, cache: _Weights) -> tuple[list[tuple[int, int]], np.ndarray]:
        """Code-point spans of the sentences that hold a word, and the logit of each.

        A text without words is one empty sentence.
        """
        spans, logits = [], []
        for m in _SENTENCE.finditer(text or ""):
            found = _WORD.findall(m[0].lower())
            if found:
                spans.append(m.span())
                logits.append(sum(map(cache.__getitem__, set(found))))
        if not spans:
            spans, logits = [(0, 0)], [0.0]
        return spans, np.asarray(logits) + self.bias


def held_out(doc_id: Column) -> Column:
    """Rows that never teach: crc32 of the id as text leaves 1 when divided by 3 (null id: false)."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def _counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    def out():
        frame = pd.DataFrame([(w, y, n) for (w, y), n in seen.items()], columns=["word", "toxic", "n"])
        seen.clear()
        return frame

    seen: Counter = Counter()
    for batch in batches:
        for text, toxic in zip(batch["text"], batch["toxic"]):
            seen.update((p, toxic) for p in set().union(*map(parts, set(_WORD.findall(text.lower())))))
            if len(seen) > FLUSH:
                yield out()
    if seen:
        yield out()


def _features(batches: Iterator[pd.DataFrame], words: list[str]) -> Iterator[pd.DataFrame]:
    ids = {w: i for i, w in enumerate(words)}
    for batch in batches:
        rows = []
        for text, toxic in zip(batch["text"], batch["toxic"]):
            n, at, which = 0, [], []
            for m in _SENTENCE.finditer(text):
                found = _WORD.findall(m[0].lower())
                if found:
                    known = sorted(ids[p] for w in set(found) for p in parts(w) if p in ids)
                    at += [n] * len(known)
                    which += known
                    n += 1
            rows.append((toxic, max(n, 1), at, which))
        yield pd.DataFrame(rows, columns=["toxic", "n", "at", "which"])


def noisy_or_gradient(toxic: np.ndarray, balance: np.ndarray, sizes: np.ndarray, sentence: np.ndarray, word: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Slope of the weighted loss -log P(label) of the noisy-or in the weights ``w``, whose last is the bias."""
    bounds = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    owner = np.repeat(np.arange(len(sizes)), sizes)
    z = w[-1] + np.bincount(sentence, w[word], minlength=len(owner))
    mass = np.add.reduceat(np.logaddexp(0, z), bounds)  # -log of the chance that no sentence is toxic
    slope = balance * np.where(toxic == 1, -1 / np.expm1(np.clip(mass, 1e-9, 500)), 1.0)
    by_sentence = slope[owner] / (1 + np.exp(-z))
    return np.append(np.bincount(word, by_sentence[sentence], minlength=len(w) - 1), by_sentence.sum())


def noisy_or_fit(toxic: np.ndarray, sizes: np.ndarray, sentence: np.ndarray, word: np.ndarray, n_words: int) -> tuple[float, np.ndarray]:
    """Bias and weights that minimise the class-balanced loss of the noisy-or over texts.

    ``sizes``: sentences of each text; ``sentence``/``word``: the words present in each sentence.
    """
    balance = np.where(toxic == 1, 0.5 / max(1, toxic.sum()), 0.5 / max(1, (1 - toxic).sum()))
    w = np.zeros(n_words + 1)
    w[-1] = -5.0
    first, second = np.zeros_like(w), np.zeros_like(w)
    for step in range(1, STEPS + 1):
        gradient = noisy_or_gradient(toxic, balance, sizes, sentence, word, w)
        gradient[:-1] += SHRINK * w[:-1]
        first = 0.9 * first + 0.1 * gradient
        second = 0.99 * second + 0.01 * gradient**2
        pace = RATE / (np.sqrt(second / (1 - 0.99**step)) + EPS)
        w -= pace * first / (1 - 0.9**step)
        w[:-1] = np.sign(w[:-1]) * np.maximum(np.abs(w[:-1]) - pace[:-1] * L1, 0)
    return float(w[-1]), w[:-1]


def _maybe(hashes: Column, known: Bloom) -> Column:
    """False only where a hash can't be among the known ones."""

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for h in batches:
            yield pd.Series(known.holds(h.to_numpy().view(np.uint64)))

    return F.pandas_udf(run, "boolean")(hashes)


def train(docs: DataFrame, labels: DataFrame) -> Model:
    """Learn from the labelled rows of ``docs`` that aren't held out.

    Rows with a null text or a null label teach nothing; a doc_id labelled twice is toxic if
    either says so; texts that occur repeatedly count once.  Only texts that pass a Bloom filter of the
    chosen ids are shuffled to meet their labels.  Without texts of both classes the
    model has no words, and its bias follows the class it has seen.
    """
    known = labels.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic")).where("toxic is not null")
    ids = docs.where(F.col("text").isNotNull() & ~held_out(F.col("doc_id"))).select("doc_id", F.xxhash64("text").alias("key"))
    chosen = ids.join(known, "doc_id").groupBy("key").agg(F.max("toxic").alias("toxic"), F.min("doc_id").alias("doc_id"))
    chosen = chosen_ids = written(chosen.select("doc_id", "toxic", F.xxhash64("doc_id").alias("h")))
    sizes = {r["toxic"]: r["n"] for r in chosen.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if not (sizes.get(0) and sizes.get(1)):
        return Model(4.0 if sizes.get(1) else -8.0, {})
    share = F.when(F.col("toxic") == 1, F.lit(FIT_TEXTS / sizes[1])).otherwise(F.lit(FIT_TEXTS / sizes[0]))
    chosen = chosen.select("doc_id", "toxic", (F.pmod("h", F.lit(1_000_003)) < share * 1_000_003).alias("fit"))
    likely = docs.where(F.col("text").isNotNull() & ~held_out(F.col("doc_id"))).select("doc_id", "text")
    likely = likely.where(_maybe(F.xxhash64("doc_id"), bloom_of(chosen_ids, "h")))
    texts = written(likely.join(bounded(chosen), "doc_id"))
    counted = texts.select("text", "toxic").mapInPandas(_counts, "word string, toxic int, n bigint").groupBy("word").agg(
        F.sum(F.when(F.col("toxic") == 1, F.col("n")).otherwise(0)).alias("t"),
        F.sum(F.when(F.col("toxic") == 1, 0).otherwise(F.col("n"))).alias("c"),
    )
    base = sizes[1] / (sizes[0] + sizes[1])
    n, expected = F.col("t") + F.col("c"), (F.col("t") + F.col("c")) * base
    surprise = (F.col("t") - expected) / F.sqrt(expected * (1 - base))
    top = counted.where(n >= LEAST_TEXTS).select("word", F.abs(surprise).alias("z")).orderBy(F.desc("z"), "word").limit(VOCABULARY)
    words = sorted(r["word"] for r in top.collect())
    sample = (
        texts.where("fit").select("text", "toxic")
        .mapInPandas(lambda b: _features(b, words), "toxic int, n int, at array<int>, which array<int>").toPandas()
    )
    if sample["toxic"].nunique() < 2:
        return Model(-8.0, {})
    discard(chosen_ids, texts)
    toxic, n = sample["toxic"].to_numpy(), sample["n"].to_numpy()
    start = np.cumsum(n) - n
    sentence = np.concatenate([np.asarray(a, np.int64) + s for a, s in zip(sample["at"], start)])
    word = np.concatenate([np.asarray(a, np.int64) for a in sample["which"]])
    bias, weights = noisy_or_fit(toxic, n, sentence, word, len(words))
    return Model(bias, {w: float(x) for w, x in zip(words, weights) if abs(x) > 1e-3})


def scored(text: Column, model: Model) -> Column:
    """Struct of score, n_sentences and the offending sentences (start, end, score) of a text.

    Offending: sentences more likely toxic than not.  Spans are code points, end exclusive.
    Null and empty texts are one empty sentence.
    """

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        cache = _Weights(model.weights)
        for texts in batches:
            rows = []
            for t in texts:
                spans, z = model.sentences(t, cache)
                bad = np.flatnonzero(z > 0)
                found = [{"start": spans[i][0], "end": spans[i][1], "score": float(1 / (1 + np.exp(-z[i])))} for i in bad]
                rows.append((float(-np.expm1(-np.logaddexp(0, z).sum())), len(spans), found))
            yield pd.DataFrame(rows, columns=["score", "n_sentences", "offending"])

    kind = "score double, n_sentences int, offending array<struct<start: int, end: int, score: double>>"
    return F.pandas_udf(run, kind)(text)


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted, n_sentences and offending of every row of ``docs``.

    Every row is scored, also those with null or empty text (as one empty sentence); repeated rows
    score alike; columns other than doc_id and text are ignored; an empty table gives no rows.
    """
    model = train(docs, labels)
    found = docs.select("doc_id", scored(F.col("text"), model).alias("s"))
    return found.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col("s.score").alias("score"),
        (F.col("s.score") >= REJECT).cast("int").alias("predicted"), "s.n_sentences", "s.offending",
    )


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` without the rows that score ``REJECT`` or more; all columns stay as they are."""
    name = "_" + "_".join(docs.columns)
    return docs.withColumn(name, scored(F.col("text"), train(docs, labels))["score"]).where(F.col(name) < REJECT).drop(name)
