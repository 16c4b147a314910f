"""Benchmark decontamination by greedy string tiling.

A document leaks a benchmark item if tiles - runs of words the two share, in any order, no word
used twice - cover enough of the item.  Words are what lies between ASCII white space, control
characters and punctuation, in lower case.

Documents meet items by a join on shared ``LEAST``-word seeds.  A document's seeds pass a Bloom filter
of all item seeds (at most 16 MB) first, so texts without a leak send next to nothing.  Pairs whose seeds
could cover enough of the item are tiled, a row per pair; benchmark and documents stay in Spark.
A text's leaks depend on its words only, so equal texts are tiled once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbline.llm.bloom import Bloom, bloom_of
from ebbline.operators.ranking import salted_join
from ebbline.session import bounded, written

LEAST = 5
COVERAGE = 0.5
#: Words whose hashes a task remembers, and item texts prepared for tiling.
WORDS, ITEMS = 1 << 17, 256
_APART = bytes(c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))
TEXT, ITEM = ("_t1", "_t2"), ("_i1", "_i2")


def tokens(text: str | None) -> list[bytes]:
    return text.lower().encode("utf-8", "surrogatepass").translate(_APART).split() if text else []


class Rolling:
    """Karp-Rabin hashes of the windows of a sequence, from sums of its terms' powers mod 2**64."""

    def __init__(self, values: np.ndarray):
        n = len(values)
        noise = (values.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)
        noise ^= noise >> np.uint64(32)
        up = np.concatenate([[np.uint64(1)], np.full(n, _BASE)]).cumprod(dtype=np.uint64)
        self.down = np.concatenate([[np.uint64(1)], np.full(n, _INVERSE)]).cumprod(dtype=np.uint64)
        self.sums = np.concatenate([[np.uint64(0)], (noise * up[:n]).cumsum(dtype=np.uint64)])

    def windows(self, length: int) -> np.ndarray:
        n = len(self.sums) - length
        return (self.sums[length:] - self.sums[:n]) * self.down[:n]


def _free(marked: np.ndarray, length: int) -> np.ndarray:
    """Starts of the windows without a marked word."""
    sums = np.concatenate([[0], np.cumsum(marked)])
    return np.flatnonzero(sums[length:] == sums[:-length])


def tiles(item: np.ndarray, doc: np.ndarray, least: int = LEAST) -> list[tuple[int, int, int]]:
    """Greedy tiling: ``(length, item start, doc start)``, longest first, ties from the left.

    The longest match among unmarked words is found by bisecting on window lengths, all matches
    of that length are marked unless they overlap, and so on down to ``least``.  Equal hashes
    count only if the words are equal.
    """
    out: list[tuple[int, int, int]] = []
    if min(len(item), len(doc)) < least:
        return out
    used_item, used_doc = np.zeros(len(item), bool), np.zeros(len(doc), bool)
    hash_item, hash_doc = Rolling(item), Rolling(doc)

    def matches(length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        at, there = _free(used_item, length), _free(used_doc, length)
        h, g = hash_item.windows(length)[at], hash_doc.windows(length)[there]
        order = np.argsort(g, kind="stable")
        return at[np.isin(h, g)], there[order], g[order]

    top = min(len(item), len(doc))
    while top >= least:
        low, high = least - 1, top
        while low < high:
            middle = (low + high + 1) // 2
            low, high = (middle, high) if len(matches(middle)[0]) else (low, middle - 1)
        if low < least:
            break
        at, there, g = matches(low)
        grown = False
        for i in at:
            if used_item[i] or used_item[i + low - 1]:
                continue
            h = hash_item.windows(low)[i]
            spots = there[np.searchsorted(g, h) : np.searchsorted(g, h, "right")]
            for j in spots[~(used_doc[spots] | used_doc[spots + low - 1])]:
                if np.array_equal(item[i : i + low], doc[j : j + low]):
                    used_item[i : i + low] = used_doc[j : j + low] = grown = True
                    out.append((low, int(i), int(j)))
                    break
        top = low if grown else low - 1
    return out


class Block:
    """Some items and their seeds: for each ``LEAST``-word window, the items and places that have it."""

    def __init__(self, items: list[tuple[int, str]], least: int = LEAST):
        self.least, self.ids, self.items, self.names = least, {}, [], []
        hashes, which, places = [], [], []
        for name, text in items:
            words = np.array([self.ids.setdefault(w, len(self.ids) + 1) for w in tokens(text)], np.int64)
            if len(words) >= least:
                seeds = Rolling(words).windows(least)
                hashes.append(seeds)
                which.append(np.full(len(seeds), len(self.items)))
                places.append(np.arange(len(seeds)))
                self.items.append(words)
                self.names.append(name)
        joined = np.concatenate(hashes) if hashes else np.empty(0, np.uint64)
        order = np.argsort(joined, kind="stable")
        self.seeds = joined[order]
        self.which = np.concatenate(which)[order] if hashes else order
        self.places = np.concatenate(places)[order] if hashes else order

    def leaks(self, text: str | None, coverage: float) -> list[dict]:
        get = self.ids.get
        doc = np.array([get(w, 0) for w in tokens(text)], np.int64)
        if len(doc) < self.least or not len(self.seeds):
            return []
        known = _free(doc == 0, self.least)
        if not len(known):
            return []
        h = Rolling(doc).windows(self.least)[known]
        low, high = np.searchsorted(self.seeds, h), np.searchsorted(self.seeds, h, "right")
        places, low, counts = known[high > low], low[high > low], (high - low)[high > low]
        if not len(places):
            return []
        # One row per seed of the document and item that has it.
        at = np.repeat(places, counts)
        row = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts) + np.repeat(low, counts)
        found = []
        for k in np.unique(self.which[row]):
            item, mine = self.items[k], self.which[row] == k
            span = np.arange(self.least)
            possible = np.zeros(len(item), bool)
            possible[(self.places[row[mine]][:, None] + span).ravel()] = True
            if possible.sum() < coverage * len(item):
                continue
            near = np.zeros(len(doc) + 1, bool)
            near[(at[mine][:, None] + span).ravel()] = True
            # Runs of words that lie in seeds, a word that matches nothing after each.
            ends = np.flatnonzero(near[:-1] & ~near[1:]) + 1
            near[ends] = True
            runs = np.append(doc, 0)
            runs[ends] = 0
            done = tiles(item, runs[near], self.least)
            covered = sum(t[0] for t in done)
            if covered >= coverage * len(item):
                found.append({"item_id": self.names[k], "n_tiles": len(done), "covered": covered, "item_words": len(item)})
        return found


class Seeds:
    """Hashes of the ``LEAST``-word windows of texts; hashes of words met often are remembered."""

    def __init__(self):
        self.known: dict[bytes, int] = {}

    def of(self, text: str | None) -> np.ndarray:
        words = tokens(text)
        if len(words) < LEAST:
            return np.empty(0, np.uint64)
        if len(self.known) > WORDS:
            self.known.clear()
        known, digest = self.known, xxhash.xxh64_intdigest
        for w in set(words).difference(known):
            known[w] = digest(w)
        return Rolling(np.fromiter((known[w] for w in words), np.uint64, len(words))).windows(LEAST)


def _text_key(text: str, salt: str, names: tuple[str, str], *more: str) -> list[Column]:
    return [F.xxhash64(text, F.lit(f"{salt}{i}"), *more).alias(n) for i, n in enumerate(names)]


def _item_seeds(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Per item and seed: in how many places, and the item's words."""
    seeds = Seeds()
    for batch in batches:
        for text, i1, i2 in zip(batch["text"], batch["_i1"], batch["_i2"]):
            found, n = np.unique(seeds.of(text), return_counts=True)
            if len(found):
                yield pd.DataFrame({"seed": found.view(np.int64), "_i1": i1, "_i2": i2, "places": n, "words": int(n.sum()) + LEAST - 1})


def _doc_seeds(bloom: Bloom):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seeds = Seeds()
        for batch in batches:
            for text, t1, t2 in zip(batch["text"], batch["_t1"], batch["_t2"]):
                found = seeds.of(text)
                found = np.unique(found[bloom.holds(found)])
                if len(found):
                    yield pd.DataFrame({"seed": found.view(np.int64), "_t1": t1, "_t2": t2})

    return run


def _tiled(coverage: float):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        kept: dict[str, Block] = {}
        for batch in batches:
            rows = []
            for t1, t2, i1, i2, text, item in batch[[*TEXT, *ITEM, "text", "item"]].itertuples(index=False):
                if item not in kept:
                    if len(kept) >= ITEMS:
                        kept.clear()
                    kept[item] = Block([(0, item)])
                rows += [(t1, t2, i1, i2, x["n_tiles"], x["covered"], x["item_words"]) for x in kept[item].leaks(text, coverage)]
            if rows:
                yield pd.DataFrame(rows, columns=[*TEXT, *ITEM, "n_tiles", "covered", "item_words"])

    return run


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.where("text IS NOT NULL").select(*_text_key("text", "text", TEXT), "text")


def _leaks(docs: DataFrame, benchmark: DataFrame, coverage: float) -> tuple[DataFrame, DataFrame]:
    """Leaks by text key and item key, and the items with their keys and how often each is given."""
    given = benchmark.where("text IS NOT NULL").select(F.col("item_id").cast("bigint").alias("item_id"), "text")
    items = written(given.groupBy("item_id", "text").agg(F.count("*").cast("int").alias("times")).select(*_text_key("text", "item", ITEM, "item_id"), "*"))
    seeds = written(items.select("text", *ITEM).mapInPandas(_item_seeds, "seed bigint, _i1 bigint, _i2 bigint, places int, words int"))
    bloom = bloom_of(seeds.select("seed").distinct(), "seed")
    # Equal texts give equal rows, which are counted as one.
    sent = _keyed(docs).mapInPandas(_doc_seeds(bloom), "seed bigint, _t1 bigint, _t2 bigint").distinct()
    # Salted: a third of all texts may share a passage.
    met = salted_join(sent, seeds, ["seed"], list(TEXT)).groupBy(*TEXT, *ITEM).agg(F.sum("places").alias("places"), F.max("words").alias("words"))
    enough = F.least(F.col("places") * LEAST, F.col("words")) >= coverage * F.col("words")
    pairs = written(met.where(enough).select(*TEXT, *ITEM))
    wanted = written(pairs.select(*TEXT).distinct())
    # One row of each text that is in a pair; the others are not shuffled where the wanted keys are few.
    texts = _keyed(docs).join(bounded(wanted), [*TEXT], "left_semi").dropDuplicates([*TEXT])
    both = pairs.join(items.select(*ITEM, F.col("text").alias("item")), [*ITEM]).join(texts, [*TEXT])
    schema = "_t1 bigint, _t2 bigint, _i1 bigint, _i2 bigint, n_tiles int, covered int, item_words int"
    return written(both.select(*TEXT, *ITEM, "text", "item").mapInPandas(_tiled(coverage), schema)), items


def contamination(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE) -> DataFrame:
    """One row per document and item it leaks: doc_id, item_id, n_tiles, covered, item_words, coverage.

    Null and empty texts leak nothing; items without text or of fewer than ``LEAST`` words can't
    be located and are never leaked; repeated documents and items give repeated rows; other
    columns are ignored; empty tables give no rows.
    """
    found, items = _leaks(docs, benchmark, coverage)
    named = found.join(items.select(*ITEM, "item_id", "times"), [*ITEM])
    ids = docs.where("text IS NOT NULL").select("doc_id", *_text_key("text", "text", TEXT))
    # Keys of leaking texts, written and small, save the shuffle of all ids.
    leaking = ids.join(bounded(written(found.select(*TEXT).distinct())), [*TEXT], "left_semi")
    return leaking.join(named, [*TEXT]).select(
        "doc_id", "item_id", "n_tiles", "covered", "item_words", F.round(F.col("covered") / F.col("item_words"), 6).alias("coverage"),
        F.explode(F.array_repeat(F.lit(0), F.col("times"))).alias("_again"),
    ).drop("_again")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE) -> DataFrame:
    """``docs`` without those that leak an item; all columns stay as they are."""
    found = written(_leaks(docs, benchmark, coverage)[0].select(*TEXT).distinct())
    clash = "_" + "_".join(docs.columns)
    names = tuple(clash + n for n in TEXT)
    keyed = docs.select("*", *_text_key("text", "text", names))
    leaking = found.toDF(*names)
    return keyed.join(bounded(leaking), list(names), "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])
