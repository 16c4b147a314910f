"""MinHash near-duplicates through an inverted index over signature coordinates.

Every document's set of word shingles becomes a signature of ``COORDS`` minima.  A document is
posted under each coordinate-value pair of its signature; two documents collide once for every
posting list that holds both, and pairs with at least ``MATCHES`` collisions are confirmed on
their full sets.  Lists are merged the cheap way round:

* a value that only one document has can't collide, so documents with fewer than ``MATCHES``
  shared values leave at once;
* with its ``s`` shared values in order of list length, a document that reaches ``MATCHES``
  collisions meets its partner in the first ``s - MATCHES + 1`` lists (prefix); the longer lists
  are skipped and only probed, by comparing signatures, for pairs the short ones brought up.

Exact copies are one class from the start.  Inside a list every class is first compared with the
list's most connected class only, so a group of thousands of near copies costs its size.  What is
still apart then is compared pair by pair, but a pair leaves the list only if two bitmaps of the
sets allow the similarity (each bit that one set has alone is a shingle the other lacks).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbline.llm.graph import connected_components
from ebbline.session import bounded, written

SEED = 20_240_607
#: A pair at similarity 0.8 agrees in 32 of 40 coordinates on average and misses 21 with p < 2e-5.
COORDS, MATCHES = 40, 21
#: Longs of 64 bits in a set's bitmap.
MAP = 16
BLOCK = 8_192
_rng = np.random.default_rng(SEED)
_MULTIPLIERS = _rng.integers(0, 2**63, COORDS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_MIX = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB)]


class _Words(dict):
    """Word to 64-bit hash; forgets everything when it holds ``size`` words."""

    size = 200_000

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.size:
            self.clear()
        self[word] = h = xxhash.xxh3_64_intdigest(word, SEED)
        return h


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * _MIX[1]
    h = (h ^ (h >> np.uint64(27))) * _MIX[2]
    return h ^ (h >> np.uint64(31))


def shingle_set(text: bytes | None, width: int, words: dict[bytes, int]) -> np.ndarray:
    """Sorted distinct hashes of the ``width``-word shingles of ``text``.

    Words are runs of anything but ASCII white space, A-Z in lower case.  A text of fewer words
    is one shingle; a text without words has none.
    """
    if text is None:
        return np.empty(0, np.uint64)
    parts = text.lower().split()
    if not parts:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(words.__getitem__, parts), np.uint64, len(parts))
    n = min(width, len(parts))
    rolled = np.full(len(h) - n + 1, n, np.uint64)
    for k in range(n):
        rolled = (rolled ^ h[k : len(h) - n + 1 + k]) * _MIX[0]
        rolled ^= rolled >> np.uint64(29)
    return np.unique(_mixed(rolled))


def signature(shingles: np.ndarray) -> np.ndarray:
    """``COORDS`` minima, each with its coordinate in the low bits; empty for an empty set."""
    if not len(shingles):
        return np.empty(0, np.int64)
    least = np.full(COORDS, np.iinfo(np.uint64).max, np.uint64)
    for start in range(0, len(shingles), BLOCK):
        block = shingles[start : start + BLOCK]
        np.minimum(least, (_MULTIPLIERS[:, None] * block).min(axis=1), out=least)
    return ((least >> np.uint64(7) << np.uint64(6)) | np.arange(COORDS, dtype=np.uint64)).astype(np.int64)


def _describe(batches: Iterator[pd.DataFrame], width: int) -> Iterator[pd.DataFrame]:
    words = _Words()
    for batch in batches:
        digests, sizes, signatures = [], [], []
        for text in batch["text"]:
            s = shingle_set(text, width, words)
            digests.append(xxhash.xxh3_128_hexdigest(s.tobytes()) if len(s) else None)
            sizes.append(len(s))
            signatures.append(signature(s))
        yield pd.DataFrame(
            {
                "doc_id": batch["doc_id"].astype("Int64"), "key": batch["key"], "n_shingles": sizes, "class": digests,
                "signature": signatures,
            }
        )


def _sets(batches: Iterator[pd.DataFrame], width: int) -> Iterator[pd.DataFrame]:
    words = _Words()
    for batch in batches:
        found = [shingle_set(t, width, words) for t in batch["text"]]
        yield pd.DataFrame(
            {
                "class": batch["class"], "n": [len(s) for s in found], "bits": [bitmap(s) for s in found],
                "shingles": [s.astype(np.int64) for s in found],
            }
        )


def bitmap(shingles: np.ndarray) -> np.ndarray:
    """``MAP`` longs with the bit of each shingle's low digits set."""
    bits = np.zeros(64 * MAP, np.uint8)
    bits[(shingles % np.uint64(64 * MAP)).astype(np.int64)] = 1
    return np.packbits(bits).view(np.int64)


def _may_link(percent: int) -> str:
    """SQL: bitmaps ``bits, _bits`` of sets of ``n, _n`` shingles allow the similarity."""
    alone = " + ".join(f"bit_count(bits[{i}] & ~_bits[{i}])" for i in range(MAP))
    other = " + ".join(f"bit_count(_bits[{i}] & ~bits[{i}])" for i in range(MAP))
    return f"{100 + percent} * least(n - ({alone}), _n - ({other})) >= {percent} * (n + _n)"


def _bytes(docs: DataFrame) -> DataFrame:
    """The id, a hash of the text to tell rows of one id apart, and the text's UTF-8 bytes."""
    return docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64("text").alias("key"), F.col("text").cast("binary").alias("text")
    )


def near_classes(docs: DataFrame, width: int = 4, percent: int = 80) -> tuple[DataFrame, DataFrame]:
    """``(rows, links)`` of near-duplicate documents.

    ``rows``: doc_id, n_shingles and ``class`` (same set of shingles, null if empty) of every row.
    ``links``: ``src, dst`` classes of a spanning set of pairs with
    ``100 * intersection >= percent * union``.  Every such pair lies in one component of ``links``.
    """
    rows = written(
        _bytes(docs).mapInPandas(
            lambda b: _describe(b, width), "doc_id bigint, key bigint, n_shingles bigint, class string, signature array<bigint>"
        )
    )
    classes = rows.where(F.col("class").isNotNull()).groupBy("class").agg(
        F.min(F.struct("doc_id", "key")).alias("one"), F.first("signature").alias("signature")
    )
    posts = classes.select("class", F.explode("signature").alias("value"))
    shared = posts.groupBy("value").agg(F.count("*").alias("n")).where("n > 1")
    lists = posts.join(shared, "value").groupBy("class").agg(F.sort_array(F.collect_list(F.struct("n", "value"))).alias("lists"))
    # A class that may have a partner: the values of its short lists, and how connected it is.
    prefix = written(
        lists.where(F.size("lists") >= MATCHES).select(
            "class",
            F.transform(F.slice("lists", 1, F.size("lists") - (MATCHES - 1)), lambda x: x["value"]).alias("prefix"),
            F.aggregate("lists", F.lit(0.0), lambda acc, x: acc + F.log2(x["n"].cast("double"))).alias("weight"),
        )
    )
    posted = prefix.select("class", "weight", F.explode("prefix").alias("value"))
    heads = posted.groupBy("value").agg(
        F.count("*").alias("n"), F.max_by("class", F.struct("weight", "class")).alias("head")
    ).where("n > 1")
    members = written(posted.join(heads, "value").select("class", "value", "head", "n"))
    wanted = written(classes.join(members.select("class"), "class", "left_semi"))
    one = wanted.select("class", F.col("one.doc_id").alias("_id"), F.col("one.key").alias("_key"))
    texts = _bytes(docs).join(one, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("key") == F.col("_key")))
    sets = written(
        texts.select("class", "text").dropDuplicates(["class"])
        .mapInPandas(lambda b: _sets(b, width), "class string, n bigint, bits array<bigint>, shingles array<bigint>")
    )

    def confirmed(pairs: DataFrame) -> DataFrame:
        """The pairs with enough collisions whose full sets are similar enough."""
        left = wanted.select(F.col("class").alias("src"), F.col("signature").alias("_s"))
        right = wanted.select(F.col("class").alias("dst"), F.col("signature").alias("_d"))
        many = (
            pairs.join(left, "src").join(right, "dst")
            .where(F.size(F.array_intersect("_s", "_d")) >= MATCHES)
            .select("src", "dst")
        )
        left = sets.select(F.col("class").alias("src"), F.col("shingles").alias("_s"))
        right = sets.select(F.col("class").alias("dst"), F.col("shingles").alias("_d"))
        common = F.size(F.array_intersect("_s", "_d"))
        return (
            many.join(left, "src").join(right, "dst")
            .select("src", "dst", common.cast("bigint").alias("_i"), F.size("_s").alias("_n"), F.size("_d").alias("_m"))
            .where(100 * F.col("_i") >= percent * (F.col("_n") + F.col("_m") - F.col("_i")))
            .select("src", "dst")
        )

    a, b = F.col("src"), F.col("dst")
    first = members.where(F.col("class") != F.col("head")).select(
        F.least("class", "head").alias("src"), F.greatest("class", "head").alias("dst")
    ).distinct()
    found = written(confirmed(first))
    parts = connected_components(found)
    placed = written(
        members.where("n > 2").select("class", "value", "head").join(parts, F.col("class") == F.col("node"), "left")
        .select("class", "value", "head", F.coalesce("component", "class").alias("component"))
    )
    open_lists = placed.groupBy("value").agg(F.countDistinct("component").alias("parts")).where("parts > 1").select("value")
    rest = (
        placed.where(F.col("class") != F.col("head")).join(open_lists, "value", "left_semi")
        .join(sets.select("class", "n", "bits"), "class").join(prefix.select("class", "prefix"), "class")
        .select("value", F.col("class").alias("src"), "component", "n", "bits", "prefix")
    )
    other = rest.toDF("value", "dst", "_component", "_n", "_bits", "_prefix")
    # A pair meets in many lists and leaves only the first of them.
    second = rest.join(other, "value").where(
        (a < b) & (F.col("component") != F.col("_component")) & F.expr(_may_link(percent))
        & (F.array_min(F.array_intersect("prefix", "_prefix")) == F.col("value"))
    ).select("src", "dst")
    links = found.union(written(confirmed(second)))
    return rows, links


def near_duplicates(docs: DataFrame, width: int = 4, percent: int = 80) -> DataFrame:
    """Every row of ``docs`` with its group of near duplicates.

    Returns doc_id, n_shingles, component_id (smallest doc_id reachable over links), kept
    (doc_id = component_id).  A null, empty or blank text has no shingles, links with nothing and
    is kept.  Rows that repeat a doc_id with the same text share a result; a row without doc_id
    takes its group's smallest id and is not kept.  Other columns are ignored; an empty table
    gives no rows.
    """
    rows, links = near_classes(docs, width, percent)
    parts = connected_components(links).select(F.col("node").alias("class"), "component")
    least = rows.where(F.col("class").isNotNull()).groupBy("class").agg(F.min("doc_id").alias("first"))
    named = least.join(parts, "class", "left").select("class", "first", F.coalesce("component", "class").alias("component"))
    group = named.groupBy("component").agg(F.min("first").alias("component_id"))
    lookup = written(named.join(group, "component").select("class", "component_id", "first"))
    # Most classes are one row: only what differs from the row's own id has to be looked up.
    moved = lookup.join(
        rows.where(F.col("class").isNotNull()).groupBy("class").agg(F.count("*").alias("n")), "class"
    ).where((F.col("n") > 1) | (F.col("component_id") != F.col("first")) | F.col("first").isNull())
    return (
        rows.join(moved.select("class", "component_id"), "class", "left")
        .select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))
        .select("*", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)).alias("kept"))
    )


def drop_near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one document of each near-duplicate group: the one with the smallest doc_id.

    Rows that repeat a kept doc_id are one document and leave one row; rows without doc_id or
    without shingles stay.
    """
    found = near_duplicates(docs.select("doc_id", "text"), width, percent)
    gone = found.where(~F.col("kept") & F.col("doc_id").isNotNull()).select("doc_id").distinct()
    repeated = written(docs.groupBy("doc_id").agg(F.count("*").alias("_n")).where("_n > 1 and doc_id is not null").select("doc_id"))
    left = docs.join(bounded(written(gone)), "doc_id", "left_anti")
    if repeated.isEmpty():
        return left.select(docs.columns)
    once = left.join(repeated, "doc_id", "left_semi").dropDuplicates(["doc_id"])
    return left.join(repeated, "doc_id", "left_anti").select(docs.columns).union(once.select(docs.columns))
