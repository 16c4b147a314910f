"""Sampled SentencePiece segmentations and lossless decoding.

All segmentations of a text into the model's pieces form a lattice.  A forward pass sums up the
weight of the paths to each place (filtering); a backward pass then draws a path from its end, an
arc in proportion to the weight of the paths through it (sampling), so segmentations come out in
proportion to their weight.  The draw depends on a row's key and the places in its text only.

The model is a merge model: it has ranks, not probabilities, so a piece weighs
``1 / (rank + 2) ** alpha``.  No piece runs across the start of a word, so the lattice is a chain
of small lattices, one per word, which are built once and shared.
"""

from __future__ import annotations

import functools
import itertools
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import sentencepiece
from pyspark.sql import Column
from pyspark.sql import functions as F

SPACE = "▁"
ALPHA = 1.0
#: Units that are drawn at once, and rows whose ids a task holds before it passes them on.
UNITS, ROWS = 40_000, 200
_UNIT = re.compile(r" *[^ \n]+| +|\n")
_SLOTS = 21
_A, _B, _C = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))


def _noise(x: np.ndarray) -> np.ndarray:
    """Uniform doubles in [0, 1) from counters."""
    x = (x ^ (x >> np.uint64(30))) * _B
    x = (x ^ (x >> np.uint64(27))) * _C
    return ((x ^ (x >> np.uint64(31))) >> np.uint64(11)) * 2.0**-53


class Vocabulary:
    """Pieces of a model file with their weights, and the bytes each id stands for.

    All beginnings of pieces are in a hash table, so many strings are looked up in one go.
    """

    def __init__(self, path: str, alpha: float = ALPHA):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        self.raw: list[bytes] = [b""] * n
        self.of_byte = np.zeros(256, np.int32)
        self.weights = np.zeros(n)
        pieces: dict[str, int] = {}
        for i in range(n):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                self.of_byte[int(piece[1:-1], 16)] = i
                self.raw[i] = bytes([int(piece[1:-1], 16)])
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                text = piece.replace(SPACE, " ")
                pieces[text] = i
                self.weights[i] = (min(-model.get_score(i), n) + 2.0) ** -alpha
                self.raw[i] = text.encode()
        if any(re.search(r"[^ ] |\n", p) for p in pieces):
            raise ValueError("pieces run across word starts")
        self.longest = max(map(len, pieces))
        self.byte_weight = (n + 2.0) ** -alpha
        self._table(pieces)

    def _table(self, pieces: dict[str, int]) -> None:
        self.hashes = np.zeros(1 << _SLOTS, np.uint64)
        self.found = np.full(1 << _SLOTS, -1, np.int32)
        for p in {p[:k] for p in pieces for k in range(1, len(p) + 1)}:
            h = 0
            for c in p:
                h = (h * int(_A) + (ord(c) + 1) * int(_C)) & 0xFFFFFFFFFFFFFFFF
            at = h >> 64 - _SLOTS
            while self.hashes[at]:
                at = (at + 1) % len(self.hashes)
            self.hashes[at], self.found[at] = h, pieces.get(p, -1)

    def lookup(self, h: np.ndarray) -> np.ndarray:
        """For hashes of strings: the piece, -1 for a mere beginning of one, -2 for neither."""
        at = (h >> np.uint64(64 - _SLOTS)).astype(np.int64)
        seen = self.hashes[at]
        hit = seen == h
        out = np.where(hit, self.found[at], np.int32(-2))
        open_ = np.flatnonzero(~hit & (seen != 0))  # few: their place holds another string
        while len(open_):
            at[open_] = (at[open_] + 1) % len(self.hashes)
            seen = self.hashes[at[open_]]
            hit = seen == h[open_]
            out[open_[hit]] = self.found[at[open_[hit]]]
            open_ = open_[~hit & (seen != 0)]
        return out

    def decode(self, ids: list[int]) -> str:
        """The text of ids: byte pieces are bytes, and the space put before a text goes."""
        return b"".join(map(self.raw.__getitem__, ids)).decode("utf-8", "surrogatepass")[1:]


@functools.lru_cache(maxsize=2)
def vocabulary(path: str, alpha: float = ALPHA) -> Vocabulary:
    return Vocabulary(path, alpha)


class Lattices:
    """Filtered lattices of some units, one row per place and one column per piece length.

    Rows of the units' j-th places lie together, longer units first, so a step reads and writes slices.
    ``cum``: chances of the arcs of up to so many characters that end at a place; ``piece``: their
    pieces, or -1 - the character where only its bytes will do.
    """

    def __init__(self, units: list[str], v: Vocabulary):
        chars = np.frombuffer("".join(units).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        self.sizes = np.fromiter(map(len, units), np.int64, len(units))
        starts = np.cumsum(self.sizes) - self.sizes
        self.rank = np.empty(len(units), np.int64)
        self.rank[np.argsort(-self.sizes, kind="stable")] = np.arange(len(units))
        # Units that have a j-th place, and the row of the first one's.
        self.width = len(units) - np.cumsum(np.bincount(self.sizes + 1))
        self.width = np.concatenate([[len(units)], self.width[1:-1]]) if len(units) else np.zeros(1, np.int64)
        self.first = np.cumsum(self.width) - self.width
        places = len(chars) + len(units)
        weight = np.zeros((places, v.longest), np.float32)
        self.piece = np.zeros((places, v.longest), np.int32)
        unit = np.repeat(self.rank, self.sizes)
        before = np.arange(len(chars)) - np.repeat(starts, self.sizes)  # a character's place
        left = np.repeat(self.sizes, self.sizes) - before
        codes = (chars + 1).astype(np.uint64) * _C
        live, h = np.arange(len(chars)), np.zeros(len(chars), np.uint64)
        for n in range(1, v.longest + 1):
            h = h * _A + codes[live + (n - 1)]
            found = v.lookup(h)
            whole = found >= 0
            at, pieces = live[whole], found[whole]
            row = self.first[before[at] + n] + unit[at]
            weight[row, n - 1] = v.weights[pieces]
            self.piece[row, n - 1] = pieces
            if n == 1:
                alone = live[~whole]
                size = 1 + (chars[alone] >= 0x80) + (chars[alone] >= 0x800) + (chars[alone] >= 0x10000)
                row = self.first[before[alone] + 1] + unit[alone]
                weight[row, 0] = v.byte_weight**size
                self.piece[row, 0] = -1 - chars[alone]
            more = (found > -2) & (left[live] > n)
            live, h = live[more], h[more]
        self._filter(weight)

    def _filter(self, weight: np.ndarray) -> None:
        longest = weight.shape[1]
        mass = np.zeros(len(weight))  # weight of all paths from the unit's start
        mass[: self.width[0]] = 1.0
        self.cum = np.full(weight.shape, 2.0, np.float32)
        for j in range(1, len(self.width)):
            rows, n = slice(self.first[j], self.first[j] + self.width[j]), min(j, longest)
            # One row per arc length; sums run down the rows.
            sums = np.empty((n, self.width[j]))
            for k in range(n):
                start = self.first[j - k - 1]
                np.multiply(mass[start : start + self.width[j]], weight[rows, k], out=sums[k])
                if k:
                    sums[k] += sums[k - 1]
            mass[rows] = total = sums[-1].copy()
            share = np.divide(sums, total, out=sums)
            share[share >= 1 - 1e-6] = 2.0
            self.cum[rows, :n] = share.T
            low = np.flatnonzero(total < 1e-150)
            if len(low):  # only ratios of near places matter
                for k in range(min(j, longest) + 1):
                    mass[self.first[j - k] + low] *= 1e150

    def draw(self, which: np.ndarray, seeds: np.ndarray, v: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the units ``which`` in order, and how many each has; a seed for each unit."""
        live, steps, counts = np.arange(len(which)), [], np.zeros(len(which), np.int64)
        unit, place = self.rank[which], self.sizes[which]
        while len(live):
            u = _noise(seeds[live] + _C * counts[live].astype(np.uint64))
            row = self.first[place] + unit
            n = (u[:, None] < self.cum[row]).argmax(axis=1)  # chances ascend and end beyond 1
            steps.append((live, self.piece[row, n]))
            counts[live] += 1
            place = place - n - 1
            more = place > 0
            live, place, unit = live[more], place[more], unit[more]
        last = np.cumsum(counts)
        ids = np.empty(last[-1] if len(last) else 0, np.int32)
        for k, (places, pieces) in enumerate(steps):
            ids[last[places] - 1 - k] = pieces
        return self._spelled(ids, counts, v) if len(ids) and ids.min() < 0 else (ids, counts)

    def _spelled(self, ids: np.ndarray, counts: np.ndarray, v: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
        """Characters that only bytes stand for become their bytes."""
        owner = np.repeat(np.arange(len(counts)), counts)
        odd = np.flatnonzero(ids < 0)
        raw = [chr(-1 - c).encode("utf-8", "surrogatepass") for c in ids[odd]]
        times = np.ones(len(ids), np.int64)
        times[odd] = [len(r) for r in raw]
        out, start = np.repeat(ids, times), np.cumsum(times) - times
        for at, r in zip(start[odd], raw):
            out[at : at + len(r)] = v.of_byte[list(r)]
        return out, np.bincount(np.repeat(owner, times), minlength=len(counts))


def encode_batch(texts: list[str | None], keys: np.ndarray, v: Vocabulary) -> list[np.ndarray | None]:
    """Sampled ids of each text; ``keys``: 64-bit row keys."""
    out: list[np.ndarray | None] = [None] * len(texts)
    units: list[str] = []
    seeds: list[np.ndarray] = []
    owners: list[tuple[int, int]] = []

    def flush() -> None:
        if owners:
            seen = dict(zip(dict.fromkeys(units), itertools.count()))
            which = np.fromiter(map(seen.__getitem__, units), np.int64, len(units))
            ids, counts = Lattices(list(seen), v).draw(which, np.concatenate(seeds), v)
            bounds = np.concatenate([[0], np.cumsum(counts)])
            at = 0
            for row, n in owners:
                part = ids[bounds[at] : bounds[at + n]]
                out[row] = part if out[row] is None else np.concatenate([out[row], part])
                at += n
        units.clear(), seeds.clear(), owners.clear()

    for row, text in enumerate(texts):
        if text is None:
            continue
        out[row] = np.empty(0, np.int32)
        mine = _UNIT.findall(" " + text) if text else []
        start = _noise_key(keys[row]) + _A * np.arange(len(mine), dtype=np.uint64)
        for a in range(0, len(mine), UNITS):
            units += mine[a : a + UNITS]
            seeds.append(start[a : a + UNITS])
            owners.append((row, len(mine[a : a + UNITS])))
            if len(units) >= UNITS:
                flush()
    flush()
    return out


def _noise_key(key: int) -> np.uint64:
    return np.uint64((int(key) * int(_B) ^ int(key) >> 29) & 0xFFFFFFFFFFFFFFFF)


def sampled_ids(text: Column, key: Column, path: str, alpha: float = ALPHA) -> Column:
    """array<int> of a sampled segmentation of ``text``, reproducible for the row's ``key``.

    Null text: null.  Empty text: no ids.  Equal keys and texts give equal ids; a null key is 0.
    """

    def run(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for texts, keys in batches:
            seeds = keys.to_numpy().astype(np.int64).view(np.uint64)
            for a in range(0, len(texts), ROWS):
                part = encode_batch(list(texts.iloc[a : a + ROWS]), seeds[a : a + ROWS], vocabulary(path, alpha))
                yield pd.Series(part, dtype=object)

    return F.pandas_udf(run, "array<int>")(text, F.coalesce(key.cast("bigint"), F.lit(0)))


def decoded(ids: Column, path: str) -> Column:
    """The text that ``ids`` stand for (null for null)."""

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        v = vocabulary(path)
        for rows in batches:
            for a in range(0, len(rows), ROWS):
                yield pd.Series([None if r is None else v.decode(r.tolist()) for r in rows.iloc[a : a + ROWS]], dtype=object)

    return F.pandas_udf(run, "string")(ids)
