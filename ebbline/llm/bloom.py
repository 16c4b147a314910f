"""A Bloom filter of 64-bit hashes whose size is bounded, built by Spark."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bits per hash, places per hash, and bits of the largest filter (16 MB).
BITS, PLACES, MOST_BITS = 16, 4, 1 << 27


class Bloom:
    """Holds every hash that went in, and by mistake some others: few up to ``MOST_BITS / BITS`` hashes,
    more and more beyond that.  Users must be right whatever it lets through."""

    def __init__(self, size: int):
        self.n_bits = min(MOST_BITS, 1 << max(16, (size * BITS - 1).bit_length()))
        self.words = np.zeros(self.n_bits // 64, np.uint64)

    def places(self, h: np.ndarray) -> Iterator[np.ndarray]:
        step = (h >> np.uint64(32)) | np.uint64(1)
        for k in range(PLACES):
            yield (h + np.uint64(k) * step) & np.uint64(self.n_bits - 1)

    def holds(self, h: np.ndarray) -> np.ndarray:
        found = np.ones(len(h), bool)
        for place in self.places(h):
            found &= (self.words[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63)) & np.uint64(1)).astype(bool)
        return found


def bloom_of(hashes: DataFrame, column: str) -> Bloom:
    """Filter of a bigint column; Spark puts the bits together and the driver gets at most 32 MB."""
    made = Bloom(hashes.count())
    # Steps are shortened to what the mask keeps, so that sums stay in 64 bits.
    base = F.col(column).bitwiseAND(made.n_bits - 1)
    step = F.shiftrightunsigned(column, 32).bitwiseOR(F.lit(1).cast("bigint")).bitwiseAND(made.n_bits - 1)
    place = F.explode(F.array(*[(base + F.lit(k) * step).bitwiseAND(made.n_bits - 1) for k in range(PLACES)]))
    bit = F.expr("bit_or(shiftleft(1L, CAST(place & 63 AS INT)))")
    words = hashes.select(place.alias("place")).groupBy(F.shiftright("place", 6).alias("word")).agg(bit.alias("bits")).toArrow()
    made.words[words["word"].to_numpy()] = words["bits"].to_numpy().astype(np.int64).view(np.uint64)
    return made
