"""Collocations by Toivonen's mining: a sample proposes phrases, full passes count exactly.

Phrases are runs of words inside a piece of a text.  A phrase can only be frequent if the phrases
without its last and without its first word are, so:

1. phrases that are frequent in a sample of the documents, at a lowered threshold, are proposed;
2. one pass over all documents counts every proposed phrase and the negative border: occurring
   phrases that were not proposed while both shorter phrases were (single words: all of them);
3. border phrases that turn out frequent are failures of the sample.  If there are any, an expansion
   pass counts, length after length, the phrases one of whose shorter parts is a failure or is
   counted in this pass while the other is known.  A frequent phrase that is still not counted
   would have a part that is neither known nor counted, and so on down to single words, which
   were all counted: one expansion closes the border;
4. a last pass counts the words of what was found as text.

Passes 1 to 3 count 64-bit hashes, so the border, which is long and nearly all rare, travels as two
numbers a phrase; phrases that share a hash can only make it look more frequent.  The last pass
compares the words themselves, so counts are exact and every frequent phrase is counted, whatever
the sample.  Passes know phrases as Bloom filters of bounded size; what these let through by
mistake is counted like the rest, costs time and changes nothing.  Counts are added up per part of
a task and then per phrase, so a frequent phrase is no hot key.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbline.llm.bloom import Bloom, bloom_of
from ebbline.operators.ranking import latest_n_skewed, salted_join
from ebbline.session import bounded, discard, written

LEAST, LONGEST, TOP = 100, 5, 2_000
#: One document in ``SAMPLE`` proposes what it has at half the rate of a phrase that is just frequent.
SAMPLE, LOWERED = 16, 0.5
#: Bytes of text that a task works on at once, and phrases it adds up before it passes them on.
PART, HELD = 4 << 20, 200_000
#: Tasks of the last pass, as a multiple of the cores.
TASKS = 2
SEED = 11
#: The low bits of a hash hold the phrase's number of words.
SIZE_BITS = 7
_LETTERS = bytes(range(65, 91))
_ENDS = b".,;:!?\n\x0b\x0c\r"
_PLAIN = bytes.maketrans(_LETTERS + _ENDS + b"\t", _LETTERS.lower() + b"\n" * len(_ENDS) + b" ")
_MULTIPLY = np.uint64(0x9E3779B97F4A7C15)


def piece_words(text: bytes) -> list[bytes]:
    """Words of ``text`` in order, A-Z in lower case, with a line feed wherever a piece ends."""
    return [w for w in text.translate(_PLAIN).replace(b"\n", b" \n ").split(b" ") if w]


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(29))) * _MULTIPLY
    return h ^ (h >> np.uint64(32))


def _sized(h: np.ndarray, size: int) -> np.ndarray:
    return (h & ~np.uint64(SIZE_BITS)) | np.uint64(size)


class _Phrases:
    """Hashes of the phrases that start at each word of some texts of one language."""

    def __init__(self, words: list[bytes], lang: str):
        number, distinct = pd.factorize(np.array(words, dtype=object))
        self.number = number.astype(np.int64)
        hashes = np.fromiter((xxhash.xxh3_64_intdigest(w, SEED) for w in distinct), np.uint64, len(distinct))
        self.words = hashes[number]
        self.inside = np.array([w != b"\n" for w in distinct], bool)[number]
        self.h = np.full(len(words), xxhash.xxh3_64_intdigest(lang.encode(), SEED + 1), np.uint64)

    def grown(self, at: np.ndarray, size: int) -> np.ndarray:
        """Hashes of the phrases of ``size`` words at the places ``at``, known there for one word less."""
        longer = _mixed(self.h[at] ^ self.words[at + size - 1])
        self.h[at] = longer
        return _sized(longer, size)


def _hash_counts(words: list[bytes], lang: str, longest: int, known: Bloom | None, fresh: Bloom | None):
    """``(hashes, counts)`` per length of the phrases to count, each once.

    Without ``known`` every phrase counts, else those of which both shorter parts are in it.  With
    ``fresh`` a phrase counts if one of them is in that or counts itself, and the other is known too.
    """
    phrases = _Phrases(words, lang)
    alive = new = None
    for size in range(1, longest + 1):
        if size == 1:
            at = np.flatnonzero(phrases.inside)
        else:
            at = np.flatnonzero(alive[:-1] & alive[1:])
        if not len(at):
            return
        h, first, which, n = np.unique(phrases.grown(at, size), return_index=True, return_inverse=True, return_counts=True)
        lives = np.ones(len(h), bool) if known is None else known.holds(h)
        if fresh is None:
            yield h, n
        else:
            counted = (new[:-1] | new[1:])[at[first]] if size > 1 else np.zeros(len(h), bool)
            yield h[counted], n[counted]
            lives |= counted
            new = np.zeros(len(words), bool)
            new[at] = (counted | fresh.holds(h))[which]
        alive = np.zeros(len(words), bool)
        alive[at] = lives[which]


def _add_texts(counts: dict, words: list[bytes], lang: str, longest: int, found: Bloom) -> None:
    """Add the occurrences of phrases in ``found`` to ``counts`` by (lang, phrase)."""
    phrases = _Phrases(words, lang)
    counts[lang, b""] = counts.get((lang, b""), 0) + int(phrases.inside.sum())
    alive, rank = None, phrases.number
    for size in range(1, longest + 1):
        at = np.flatnonzero(phrases.inside if size == 1 else alive[:-1] & alive[1:])
        if not len(at):
            return
        held = found.holds(phrases.grown(at, size))
        alive = np.zeros(len(words), bool)
        alive[at] = held
        at = at[held]
        # Numbers of equal phrases are equal because their words are, not their hashes.
        pairs = rank[at] * (len(words) + 1) + phrases.number[at + size - 1]
        first, ids, n = np.unique(pairs, return_index=True, return_inverse=True, return_counts=True)[1:]
        rank = np.zeros(len(words), np.int64)
        rank[at] = ids
        for i, c in zip(at[first].tolist(), n.tolist()):
            key = lang, b" ".join(words[i : i + size])
            counts[key] = counts.get(key, 0) + c


def _parts(batch: pd.DataFrame) -> Iterator[tuple[str, list[bytes]]]:
    """Words of a batch's texts by language, some megabytes at a time."""
    for lang, rows in batch.groupby("lang"):
        part = rows["text"].str.len().cumsum().to_numpy() // PART
        for _, texts in rows["text"].groupby(part):
            yield lang, [w for t in texts for w in (*piece_words(t), b"\n")]


def _counted(texts: DataFrame, longest: int, known: Bloom | None = None, fresh: Bloom | None = None) -> DataFrame:
    """``(h, n)``: occurrences over ``texts`` of the phrases that the filters let through, by hash."""
    filters = texts.sparkSession.sparkContext.broadcast((known, fresh))

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known, fresh = filters.value
        for batch in batches:
            for lang, words in _parts(batch):
                for h, n in _hash_counts(words, lang, longest, known, fresh):
                    yield pd.DataFrame({"h": h.view(np.int64), "n": n})

    return texts.mapInPandas(count, "h bigint, n bigint").groupBy("h").agg(F.sum("n").alias("n"))


def _counted_texts(texts: DataFrame, longest: int, found: Bloom) -> DataFrame:
    """``(lang, size, phrase, n)``: exact occurrences of the phrases in ``found``, and of all words as size 0."""
    held = texts.sparkSession.sparkContext.broadcast(found)

    def rows(counts: dict) -> pd.DataFrame:
        table = pd.DataFrame([(lang, p.decode(), n) for (lang, p), n in counts.items()], columns=["lang", "phrase", "n"])
        counts.clear()
        return table

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts: dict[tuple[str, bytes], int] = {}
        for batch in batches:
            for lang, words in _parts(batch):
                _add_texts(counts, words, lang, longest, held.value)
                if len(counts) > HELD:
                    yield rows(counts)
        yield rows(counts)

    size = F.when(F.col("phrase") == "", 0).otherwise(F.size(F.split("phrase", " ")))
    # Nearly every task meets nearly every frequent phrase, so tasks are as many as cores keep busy and no
    # more: partial counts grow with the phrases then, not with phrases times tasks.
    few = texts.coalesce(TASKS * texts.sparkSession.sparkContext.defaultParallelism)
    found_rows = few.mapInPandas(count, "lang string, phrase string, n bigint").groupBy("lang", "phrase").agg(F.sum("n").alias("n"))
    return found_rows.select("lang", size.alias("size"), "phrase", "n")


def frequent_phrases(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, sample: int = SAMPLE) -> DataFrame:
    """``(lang, size, phrase, n)`` of all phrases of up to ``longest`` words with at least ``least`` occurrences.

    The row of size 0 and empty phrase counts all words of the language.
    """
    texts = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).cast("binary").alias("text"))
    some = texts.where(F.pmod(F.xxhash64(*[docs[c] for c in ("doc_id", "text")]), F.lit(sample)) == 0)
    enough = max(1, int(least * LOWERED / sample))
    short = F.col("h").bitwiseAND(SIZE_BITS) < longest
    proposed = written(_counted(some, longest).where((F.col("n") >= enough) & short).select("h"))
    frequent = written(_counted(texts, longest, bloom_of(proposed, "h")).where(F.col("n") >= least).select("h"))
    failures = written(frequent.where(short).join(proposed, "h", "left_anti"))
    discard(proposed)
    if not failures.isEmpty():
        found = _counted(texts, longest, bloom_of(frequent.where(short), "h"), bloom_of(failures, "h"))
        more = written(frequent.union(found.where(F.col("n") >= least).select("h")).distinct())
        discard(frequent)
        frequent = more
    discard(failures)
    counts = _counted_texts(texts, longest, bloom_of(frequent, "h"))
    discard(frequent)
    return written(counts.where((F.col("n") >= least) | (F.col("size") == 0)))


def scored(frequent: DataFrame, percent: int = 100) -> DataFrame:
    """Candidates (two words and more) with their weakest cut: lang, phrase, a, l, r, n, score.

    Candidates inside a longer one that occurs at least ``percent`` per cent as often are left out:
    then the phrase one word longer in between does so too, and that is what is looked up.
    """
    words = F.split("phrase", " ")
    candidates = frequent.where("size >= 2")
    cuts = candidates.select(
        "lang", "phrase", F.col("n").alias("a"), words.alias("_words"), F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("cut")
    )
    cuts = cuts.select(
        "lang", "phrase", "a", "cut", F.concat_ws(" ", F.slice("_words", F.lit(1), F.col("cut"))).alias("_first"),
        F.concat_ws(" ", F.slice("_words", F.col("cut") + 1, F.lit(LONGEST * LONGEST))).alias("_rest"),
    )
    parts = frequent.where("size >= 1")
    for name, side in (("l", "_first"), ("r", "_rest")):
        cuts = salted_join(cuts, parts.select("lang", F.col("phrase").alias(side), F.col("n").alias(name)), ["lang", side], ["phrase"])
    totals = written(frequent.where("size = 0").select("lang", F.col("n").alias("total")))
    near = bounded(totals)
    cuts = salted_join(cuts, totals, ["lang"], ["phrase"]) if near is totals else cuts.join(near, "lang")
    big = "CAST({} AS DECIMAL(19, 0))".format
    score = F.expr(f"1000 * ({big('a')} * {big('total')}) div ({big('l')} * {big('r')})")
    weakest = F.min_by(F.struct("a", "l", "r", F.col("total").alias("n"), "score"), F.struct("score", "cut"))
    best = cuts.withColumn("score", score).groupBy("lang", "phrase").agg(weakest.alias("_"))
    longer = candidates.where("size >= 3").select("lang", "n", words.alias("_words"), "size").select(
        "lang", F.col("n").alias("_longer"),
        F.explode(F.array(*[F.concat_ws(" ", F.slice("_words", F.lit(at), F.col("size") - 1)) for at in (1, 2)])).alias("phrase"),
    ).groupBy("lang", "phrase").agg(F.max("_longer").alias("_longer"))
    kept = best.select("lang", "phrase", "_.*").join(longer, ["lang", "phrase"], "left")
    inside = F.coalesce(100 * F.col("_longer") >= percent * F.col("a"), F.lit(False))
    return kept.where(~inside).drop("_longer")


def collocations(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, top: int = TOP, sample: int = SAMPLE) -> DataFrame:
    """The ``top`` collocations of every language: lang, rank, phrase, a, l, r, n, score.

    A phrase of 2 to ``longest`` words with a >= ``least`` occurrences scores
    floor(1000 * a * n / (l * r)) at its weakest cut into parts of l and r occurrences (the first one
    of equal cuts), n being all words of the language.  Ties go to the larger a, then to the smaller
    phrase by UTF-8 bytes.

    A null lang is ``und``.  Null and empty texts and texts of marks only have no words.  Rows that
    repeat a text or doc_id count each.  Other columns are ignored; an empty table gives no rows.
    """
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    found = scored(frequent_phrases(docs.select("doc_id", "lang", "text"), least, longest, sample))
    ranked = latest_n_skewed(found, ["lang"], order, top, "rank")
    return ranked.select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")
