from collections import Counter

import numpy as np
import public_tokenizers
from pyspark.sql import functions as F

from ebbline.llm import pieces
from tests.llm.cases import LONG, awkward, documents, empty

PATH = public_tokenizers.path("piece_bpe_32k.model")


def segmentations(text, v, known):
    """Every path through the lattice with its weight."""
    if not text:
        yield (), 1.0
    for n in range(1, len(text) + 1):
        if text[:n] in known:
            for rest, w in segmentations(text[n:], v, known):
                yield (known[text[:n]], *rest), w * v.weights[known[text[:n]]]
        elif n == 1:
            raw = text[0].encode()
            for rest, w in segmentations(text[1:], v, known):
                yield (*(int(v.of_byte[b]) for b in raw), *rest), w * v.byte_weight ** len(raw)


def test_samples_follow_the_weights():
    v = pieces.vocabulary(PATH)
    known = {r.decode(): i for i, r in enumerate(v.raw) if r and i not in set(v.of_byte.tolist())}
    for text in (" the", " aon1", " x\U0001f9ff"):
        want = dict(segmentations(text, v, known))
        total = sum(want.values())
        n = 20_000
        got = Counter(tuple(x.tolist()) for x in pieces.encode_batch([text[1:]] * n, np.arange(n, dtype=np.uint64), v))
        assert set(got) <= set(want)
        for ids, w in want.items():
            p = w / total
            assert abs(got[ids] / n - p) < 5 * (p * (1 - p) / n) ** 0.5 + 1e-3


def test_decoding_is_lossless_and_sampling_reproducible(spark):
    docs = awkward(spark).select("doc_id", "text").union(documents(spark).select("doc_id", "text"))
    ids = pieces.sampled_ids(F.col("text"), F.col("doc_id"), PATH)
    once = docs.withColumn("ids", ids).withColumn("back", pieces.decoded(F.col("ids"), PATH))
    assert once.where(~F.col("back").eqNullSafe(F.col("text"))).count() == 0
    hashes = lambda df: sorted((r.doc_id or -1, r.h) for r in df.select("doc_id", F.xxhash64("ids", "text").alias("h")).collect())
    assert hashes(once) == hashes(docs.repartition(7).withColumn("ids", ids))
    assert hashes(once) != hashes(docs.withColumn("ids", pieces.sampled_ids(F.col("text"), F.col("doc_id") + 1, PATH)))
    assert empty(spark).withColumn("ids", ids).count() == 0


def test_long_and_odd_texts():
    v = pieces.vocabulary(PATH)
    for text in ("", " ", "\n", "  a \n\n ▁b  ", "a\tb\r\n日本語 😀 ▁▁ ", "é" * 3_000, " " * 500 + "z", LONG, "\x00\x7f"):
        ids = pieces.encode_batch([text], np.array([5], np.uint64), v)[0]
        assert v.decode(ids.tolist()) == text


def test_places_lie_together_and_are_drawn_from_their_own_chances():
    """Longer units first at every place; each row's chances are those of the paths that end there."""
    v = pieces.vocabulary(PATH)
    units = [" b", " banking", " ab\U0001f9ff", "\n", " lend"]
    made = pieces.Lattices(units, v)
    assert made.width.tolist() == [sum(len(u) >= j for u in units) for j in range(max(map(len, units)) + 1)]
    known = {r.decode(): i for i, r in enumerate(v.raw) if r and i not in set(v.of_byte.tolist())}
    for unit, rank in zip(units, made.rank):
        for j in range(1, len(unit) + 1):
            ends = [0.0] * v.longest
            for n in range(1, min(j, v.longest) + 1):
                piece = unit[j - n : j]
                byte = v.byte_weight ** len(piece.encode()) if n == 1 else 0.0
                weight = v.weights[known[piece]] if piece in known else byte
                ends[n - 1] = weight * sum(w for _, w in segmentations(unit[: j - n], v, known))
            want = np.cumsum(ends) / sum(ends)
            want[want >= 1 - 1e-6] = 2.0
            np.testing.assert_allclose(made.cum[made.first[j] + rank], want, rtol=1e-5)
