import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from ebbline.llm import bloom, collocations
from tests.llm.cases import SCHEMA, awkward, documents, empty


def pieces(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
        yield [w for w in re.split(r"[\x20\x09]+", piece) if w]


def counts(rows, longest=5):
    found, totals = defaultdict(Counter), Counter()
    for lang, text in rows:
        for words in pieces(text):
            totals[lang or "und"] += len(words)
            for size in range(1, longest + 1):
                for i in range(len(words) - size + 1):
                    found[lang or "und"][tuple(words[i : i + size])] += 1
    return found, totals


def brute(rows, least, top=2000, longest=5):
    found, totals = counts(rows, longest)
    out = []
    for lang, f in found.items():
        candidates = {p: a for p, a in f.items() if len(p) >= 2 and a >= least}
        hidden = {
            p[i:j] for p, a in candidates.items() for i in range(len(p)) for j in range(i + 2, len(p) + 1)
            if j - i < len(p) and 100 * a >= 100 * f[p[i:j]]
        }
        best = []
        for p, a in candidates.items():
            if p in hidden:
                continue
            score, _, l, r = min((1000 * a * totals[lang] // (f[p[:k]] * f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
            best.append((-score, -a, " ".join(p).encode(), l, r))
        for rank, (s, a, p, l, r) in enumerate(sorted(best)[:top], 1):
            out.append((lang, rank, p.decode(), -a, l, r, totals[lang], -s))
    return sorted(out)


def texts(seed, n=400):
    rng = random.Random(seed)
    weights = [1 / (i + 1) for i in range(60)]
    fixed = ["in the long run", "on the other hand side", "New York City hall", "a a a a a"]
    out = []
    for i in range(n):
        words = rng.choices([f"w{k}" for k in range(60)], weights, k=rng.randrange(60))
        for _ in range(rng.randrange(3)):
            words.insert(rng.randrange(len(words) + 1), rng.choice(fixed))
        for _ in range(rng.randrange(6)):
            words.insert(rng.randrange(len(words) + 1), rng.choice([".", ", ", "\n", "\t", ":", "\r\n", "Ünd"]))
        out.append((i, " ".join(words), rng.choice(["en", "en", "en", "de", None]), "s", 1))
    return out


def result(docs, **options):
    return sorted(tuple(r) for r in collocations.collocations(docs, **options).collect())


@pytest.mark.parametrize("sample", [1, 4, 100_000])
def test_same_as_plain_counts_whatever_the_sample(spark, sample):
    """An empty sample proposes nothing, so all phrases are found by expansion."""
    rows = texts(sample)
    assert result(spark.createDataFrame(rows, SCHEMA), least=20, sample=sample) == brute([(r[2], r[1]) for r in rows], 20)


def test_last_pass_has_tasks_by_cores_not_by_files(spark):
    """Each task passes on nearly all frequent phrases, so more tasks mean more partial counts."""
    docs = spark.createDataFrame(texts(3, 100), SCHEMA).repartition(200)
    held = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.col("text").cast("binary").alias("text"))
    found = bloom.bloom_of(spark.range(1).select(F.col("id").alias("h")), "h")
    counted = collocations._counted_texts(held, 3, found)
    plan = counted._jdf.queryExecution().executedPlan().toString()
    assert f"Coalesce {collocations.TASKS * spark.sparkContext.defaultParallelism}" in plan
    words = {r.lang: r.n for r in counted.where("size = 0").collect()}
    assert sum(words.values()) == sum(len(w) for t in texts(3, 100) for w in [[x for x in collocations.piece_words(t[1].encode()) if x != b"\n"]])


def test_a_full_filter_changes_nothing(spark, monkeypatch):
    monkeypatch.setattr(bloom, "MOST_BITS", 64)
    rows = texts(9, 150)
    assert result(spark.createDataFrame(rows, SCHEMA), least=8, top=25) == brute([(r[2], r[1]) for r in rows], 8, 25)


def test_given_documents(spark):
    docs = documents(spark)
    want = brute([(r.lang, r.text) for r in docs.collect()], 30)
    assert result(docs, least=30) == want and want


def test_awkward_rows(spark):
    docs = awkward(spark)
    many = docs.withColumn("i", F.explode(F.sequence(F.lit(1), F.lit(3)))).drop("i")
    assert result(many, least=3) == brute([(r.lang, r.text) for r in many.collect()], 3)
    assert result(empty(spark)) == []


def test_scores_beyond_64_bits(spark):
    big = 10**14
    rows = [("en", 0, "", 9 * 10**15), ("en", 1, "a", big + 7), ("en", 1, "b", big + 9), ("en", 2, "a b", big - 1)]
    found = collocations.scored(spark.createDataFrame(rows, "lang string, size int, phrase string, n bigint")).first()
    assert found.score == 1000 * (big - 1) * 9 * 10**15 // ((big + 7) * (big + 9))


def test_filter_holds_what_went_in(spark):
    rng = np.random.default_rng(0)
    inside, other = (rng.integers(-(2**63), 2**63, 5_000) for _ in range(2))
    made = bloom.bloom_of(spark.createDataFrame([(int(h),) for h in inside], "h bigint"), "h")
    assert made.holds(inside.view(np.uint64)).all() and made.holds(other.view(np.uint64)).mean() < 0.01
