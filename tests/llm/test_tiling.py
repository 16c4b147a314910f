import random

import numpy as np

from ebbline.llm import tiling
from tests.llm.cases import awkward, empty, plain


def greedy(item, doc, least):
    """The definition, word by word: all longest matches of unmarked words, from the left."""
    used_i, used_d, out = [False] * len(item), [False] * len(doc), []
    while True:
        best, found = least - 1, []
        for i in range(len(item)):
            for j in range(len(doc)):
                k = 0
                while i + k < len(item) and j + k < len(doc) and item[i + k] == doc[j + k] and not used_i[i + k] and not used_d[j + k]:
                    k += 1
                if k > best:
                    best, found = k, [(i, j)]
                elif k == best and k >= least:
                    found.append((i, j))
        if not found:
            return out
        for i, j in found:
            if not any(used_i[i : i + best]) and not any(used_d[j : j + best]):
                used_i[i : i + best] = used_d[j : j + best] = [True] * best
                out.append((best, i, j))


def test_tiles_are_greedy():
    rng = random.Random(5)
    for size in (2, 3, 8, 40):
        for _ in range(40):
            item = [rng.randrange(size) for _ in range(rng.randrange(30))]
            doc = [rng.randrange(size) for _ in range(rng.randrange(50))]
            assert tiling.tiles(np.array(item), np.array(doc), 3) == greedy(item, doc, 3)


def test_reordered_passages_are_caught(spark):
    rng = random.Random(6)
    words = lambda n: ["v%d" % rng.randrange(3_000) for _ in range(n)]
    items = [words(40) for _ in range(6)]
    bench = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(items)] + [(9, None), (10, "too short"), (11, "")], "item_id bigint, text string")
    halves = items[2][20:] + words(30) + items[2][:20]
    texts = [" ".join(words(50) + items[0] + words(9)), " ".join(halves).upper(), " ".join(words(80) + items[1][:8]), " ".join(words(99)), "", None]
    rows = {(r.doc_id, r.item_id): r for r in tiling.contamination(plain(spark, texts), bench).collect()}
    assert set(rows) == {(0, 0), (1, 2)}
    assert rows[1, 2].n_tiles == 2 and rows[1, 2].coverage == 1.0
    assert {r.doc_id for r in tiling.drop_contaminated(plain(spark, texts), bench).collect()} == {2, 3, 4, 5}


def test_join_finds_what_holding_every_text_against_every_item_finds(spark):
    rng = random.Random(7)
    words = lambda n: ["v%d" % rng.randrange(40) for _ in range(n)]
    items = [(i % 9, " ".join(words(rng.choice((3, 6, 12, 30))))) for i in range(30)] + [(0, "a b c d e f g")] * 2
    texts = []
    for _ in range(120):
        part = rng.choice(items)[1].split()
        at = rng.randrange(len(part))
        texts.append(" ".join(words(rng.randrange(40)) + part[at:] + words(rng.randrange(9)) + part[:at]))
    texts += [texts[0], "x " * 9 + "A b, c D e f g", None, ""]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    got = sorted((r.doc_id, r.item_id, r.n_tiles, r.covered, r.item_words) for r in tiling.contamination(plain(spark, texts), bench, 0.4).collect())
    block = tiling.Block(items)
    want = sorted((i, x["item_id"], x["n_tiles"], x["covered"], x["item_words"]) for i, t in enumerate(texts) for x in block.leaks(t, 0.4))
    assert got == want and len(got) > 40
    left = {r.doc_id for r in tiling.drop_contaminated(plain(spark, texts), bench, 0.4).collect()}
    assert left == set(range(len(texts))) - {row[0] for row in want}


def test_awkward_rows(spark):
    bench = spark.createDataFrame([(None, "the first text has some words in it")], "item_id bigint, text string")
    assert tiling.contamination(awkward(spark), bench).count() == 2
    assert tiling.drop_contaminated(awkward(spark), bench).count() == 9
    assert tiling.contamination(empty(spark), bench).count() == 0
    assert tiling.drop_contaminated(awkward(spark), bench.limit(0)).count() == 11
