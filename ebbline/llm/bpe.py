"""Token counts by byte-pair merging, without making tokens.

A word's symbols form a linked list; a heap holds the ranks of adjacent pairs.  The lowest rank is
popped and merged until none is left; the count is the symbols at first less the merges.
"""

from __future__ import annotations

import functools
import json
import unicodedata
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Words whose counts a Python worker keeps.
CACHE = 500_000
LIMIT = 2_048
_SHIFT = 20


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = iter(range(256))
    return [chr(b) if b in shown else chr(256 + next(rest)) for b in range(256)]


class Merges(dict):
    """Word to number of tokens for a byte-level merge vocabulary with word ends."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        ids, end = model["vocab"], model["end_of_word_suffix"]
        alphabet = byte_alphabet()
        self.inner = [ids[c] for c in alphabet]
        self.last = [ids[c + end] for c in alphabet]
        self.ranks = {ids[a] << _SHIFT | ids[b]: (rank, ids[a + b]) for rank, (a, b) in enumerate(map(self._pair, model["merges"]))}
        self.special = regex.compile("|".join(regex.escape(t["content"]) for t in spec["added_tokens"]))
        self.words = regex.compile(spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"])

    @staticmethod
    def _pair(merge) -> tuple[str, str]:
        return tuple(merge.split(" ")) if isinstance(merge, str) else tuple(merge)

    def __missing__(self, word: str) -> int:
        if len(self) >= CACHE:
            self.clear()
        n = self.merged(word.encode())
        if len(word) <= 64:
            self[word] = n
        return n

    def merged(self, raw: bytes) -> int:
        """Symbols that are left of a word when no pair can be merged any more."""
        n, ranks = len(raw), self.ranks
        symbol = [*map(self.inner.__getitem__, raw[:-1]), self.last[raw[-1]]]
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = []
        for i in range(n - 1):
            found = ranks.get(symbol[i] << _SHIFT | symbol[i + 1])
            if found:
                heap.append((found[0], i, found[1], symbol[i], symbol[i + 1]))
        heapify(heap)
        left = n
        while heap:
            _, i, new, a, b = heappop(heap)
            j = after[i]
            if symbol[i] != a or j >= n or symbol[j] != b:
                continue  # one of the pair has gone
            symbol[i], symbol[j] = new, -1
            left -= 1
            k = after[i] = after[j]
            h = before[i]
            if k < n:
                before[k] = i
                found = ranks.get(new << _SHIFT | symbol[k])
                if found:
                    heappush(heap, (found[0], i, found[1], new, symbol[k]))
            if h >= 0:
                found = ranks.get(symbol[h] << _SHIFT | new)
                if found:
                    heappush(heap, (found[0], h, found[1], symbol[h], new))
        return left

    def count(self, text: str | None) -> int:
        """Tokens of a text; strings of special tokens are a token each, as the library takes them."""
        if not text:
            return 0
        total, parts = 0, [text]
        if "<|" in text:
            parts = self.special.split(text)
            total = len(parts) - 1
        for part in parts:
            words = self.words.findall(lowered(unicodedata.normalize("NFC", part)))
            total += sum(map(self.__getitem__, words))
        return total


def lowered(text: str) -> str:
    """Lower case character by character: a final sigma is no different."""
    return (text.replace("Σ", "σ") if "Σ" in text else text).lower()


@functools.lru_cache(maxsize=2)
def merges(path: str) -> Merges:
    return Merges(path)


def token_count(text: Column, path: str) -> Column:
    """Tokens of ``text`` under the vocabulary file; 0 for null."""

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([merges(path).count(t) for t in texts], dtype="int64")

    return F.pandas_udf(run, "bigint")(text)


def token_counts(docs: DataFrame, path: str, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit of every row.

    Null and empty texts have no bytes and no tokens; repeated rows count alike; other columns are
    ignored; an empty table gives no rows.
    """
    return docs.select(
        "doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint").alias("n_bytes"), token_count(F.col("text"), path).alias("n_tokens")
    ).withColumn("over_limit", F.col("n_tokens") > limit)
