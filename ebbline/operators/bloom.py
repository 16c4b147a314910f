"""Bloom filters as small tables, built and probed by Spark expressions only.

A filter has a row per 64-bit word in use: each key sets ``PLACES`` bits of the one word that its hash
picks, so building is one grouped ``bit_or`` and probing one equality join with a broadcast table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits per key, bits that a key sets, and words of the largest filter (some 20 MB as a broadcast table).
BITS, PLACES, MOST_WORDS = 16, 4, 1 << 19


def words_for(n_keys: int) -> int:
    return max(1, min(MOST_WORDS, n_keys * BITS // 64))


def _word(key: str, n_words: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(n_words)).cast("bigint")


def _bits(key: str) -> Column:
    """The key's bits within its word, from a hash of its own."""
    h = F.xxhash64(key, F.lit("bits"))
    out = F.lit(0).cast("bigint")
    for k in range(PLACES):
        place = F.shiftrightunsigned(h, 6 * k).bitwiseAND(F.lit(63)).cast("int")
        out = out.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("bigint"), place))
    return out


def key_filter(keys: DataFrame, key: str, n_words: int) -> DataFrame:
    """(_word, _bits) of the non-null keys; at most ``n_words`` rows."""
    known = keys.where(F.col(key).isNotNull())
    return known.select(_word(key, n_words).alias("_word"), _bits(key).alias("_b")).groupBy("_word").agg(F.bit_or("_b").alias("_bits"))


def probed(df: DataFrame, key: str, made: DataFrame, n_words: int, out: str) -> DataFrame:
    """``df`` with ``out``: False for keys that surely did not go into the filter; no row moves."""
    held = df.withColumn("_word", _word(key, n_words)).join(F.broadcast(made), "_word", "left")
    mine = _bits(key)
    return held.withColumn(out, F.coalesce(F.col("_bits").bitwiseAND(mine) == mine, F.lit(False))).drop("_word", "_bits")
