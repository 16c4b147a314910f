"""Ordered selections that stay whole and balanced when one key holds most of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SALTS = 64
COPIES = 16  # times the small side of a salted join is repeated
BUCKET_DIGITS = 4  # 65,536 hash prefixes per group


def latest_n(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int, rank: str = "rn") -> DataFrame:
    """First ``n`` rows per key where a key has few rows by construction (days, years)."""
    ranked = df.withColumn(rank, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.where(F.col(rank) <= n)


def latest_n_skewed(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int, rank: str = "rn", salts: int = SALTS
) -> DataFrame:
    """First ``n`` rows per key for keys of any size; the result equals one ranking per key.

    Rows are ranked within (key, group of input tasks) first.  Spark limits each task to its
    own first ``n`` per key before the shuffle, groups of tasks share the merging, and at most
    ``n * salts`` rows per key meet in the last ranking.  Any assignment of rows to groups
    gives the same answer, so the task number serves as the group.
    """
    grouped = df.withColumn("_salt", F.spark_partition_id() % salts)
    part = latest_n(grouped, [*keys, "_salt"], order, n, "_part_rank")
    return latest_n(part.drop("_salt", "_part_rank"), keys, order, n, rank)


def run_heads(df: DataFrame, key: str, chunk: Column, newest_first: Sequence[tuple[str, bool]], label: str) -> DataFrame:
    """Rows whose label differs from the next newer row of the same key.

    ``chunk`` must follow the order (the day of the first order column, say), so a key of any
    size is read in calendar-sized pieces.  A piece's first row is compared with
    the last label of the next newer piece; the table of pieces has one row per key and
    chunk.  ``newest_first`` lists (column, descending) pairs that order rows totally.
    """
    order = [F.col(c).desc() if down else F.col(c).asc() for c, down in newest_first]
    tagged = df.withColumn("_chunk", chunk)
    inside = Window.partitionBy(key, "_chunk").orderBy(*order)
    position = F.struct(*[c for c, _ in newest_first])
    oldest = F.min_by if newest_first[0][1] else F.max_by
    pieces = tagged.groupBy(key, "_chunk").agg(oldest(F.struct(F.col(label)), position).alias("_last"))
    by_piece = Window.partitionBy(key).orderBy(F.col("_chunk").desc())
    edges = pieces.select(key, "_chunk", F.lag("_last").over(by_piece).alias("_edge"))
    before = F.coalesce(F.col("_before"), F.col("_edge"))
    return (
        tagged.withColumn("_before", F.lag(F.struct(F.col(label))).over(inside))
        .join(edges, [key, "_chunk"])
        .where(before.isNull() | ~before[label].eqNullSafe(F.col(label)))
        .drop("_chunk", "_before", "_edge")
    )


def hashed(df: DataFrame, id_col: str, *seeds: Column, out: str = "_h") -> DataFrame:
    """Add the md5 that defines the random order of rows."""
    text = F.concat_ws("|", F.col(id_col).cast("string"), *[s.cast("string") for s in seeds])
    return df.withColumn(out, F.md5(text))


def hash_cut(df: DataFrame, by: Sequence[str], id_col: str, take: Column, cut: str = "cut") -> DataFrame:
    """Per group, the hash of the ``take``-th row in hash order (one row per group).

    For few groups (classes, splits, folds) of any size.
    ``take`` may use the group's size ``_total``.  Groups whose ``take`` is zero give no row.
    """
    return _boundaries(df, by, id_col, [take]).select(*by, F.col("_cut").alias(cut))


def hash_cuts(df: DataFrame, by: Sequence[str], id_col: str, takes: Sequence[Column], cuts: str = "cuts") -> DataFrame:
    """Per group, the hashes of several rows in hash order as an array, found in one walk over the data.

    A row that several ``takes`` number is there several times; a take of zero is left out.
    """
    return _boundaries(df, by, id_col, takes).groupBy(*by).agg(F.flatten(F.collect_list(F.array_repeat("_cut", F.col("_times")))).alias(cuts))


def _boundaries(df: DataFrame, by: Sequence[str], id_col: str, takes: Sequence[Column]) -> DataFrame:
    """``by, _cut, _times``: hash and id of the rows that ``takes`` number, and how many of them do.

    Rows are counted per hash prefix, so only the prefixes that hold a boundary are ordered; no
    group is ever sorted as a whole.
    """
    prefixed = df.select(*by, id_col, "_h", F.substring("_h", 1, BUCKET_DIGITS).alias("_prefix"))
    counts = prefixed.groupBy(*by, "_prefix").agg(F.count("*").alias("_n"))
    up_to = Window.partitionBy(*by).orderBy("_prefix").rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy(*by)
    walked = counts.select(
        *by,
        "_prefix",
        F.sum("_n").over(up_to).alias("_upto"),
        (F.sum("_n").over(up_to) - F.col("_n")).alias("_before"),
        F.sum("_n").over(whole).alias("_total"),
    ).withColumn("_takes", F.array(*[t.cast("bigint") for t in takes]))
    here = F.filter("_takes", lambda t: (t > F.col("_before")) & (t <= F.col("_upto")))
    # One row per group and boundary, and groups are classes, splits or folds: small enough for every task.
    boundary = walked.select(*by, "_prefix", "_before", here.alias("_takes")).where(F.size("_takes") > 0)
    near = prefixed.join(F.broadcast(boundary), [*by, "_prefix"])
    order = Window.partitionBy(*by, "_prefix").orderBy("_h", id_col)
    return (
        near.withColumn("_rn", F.row_number().over(order) + F.col("_before"))
        .withColumn("_times", F.size(F.filter("_takes", lambda t: t == F.col("_rn"))))
        .where("_times > 0")
        .select(*by, F.struct(F.col("_h").alias("h"), F.col(id_col).alias("id")).alias("_cut"), "_times")
    )


def before_cut(id_col: str, cut: str = "cut") -> Column:
    """True for rows at or before their group's cut; False where the group has none."""
    here = F.struct(F.col("_h").alias("h"), F.col(id_col).alias("id"))
    return F.coalesce(here <= F.col(cut), F.lit(False))


def cuts_ahead(id_col: str, cuts: str = "cuts") -> Column:
    """How many of a group's cuts a row is at or before; 0 where the group has none."""
    here = F.struct(F.col("_h").alias("h"), F.col(id_col).alias("id"))
    return F.size(F.filter(F.coalesce(cuts, F.array()), lambda cut: here <= cut))


def hash_rank(df: DataFrame, by: Sequence[str], id_col: str, rank: str = "rank") -> DataFrame:
    """Dense 1-based position of every row in its group's hash order.

    Positions are counted per hash prefix and shifted by the rows of smaller prefixes, so a
    group is ordered by many tasks at once.
    """
    prefixed = df.withColumn("_prefix", F.substring("_h", 1, BUCKET_DIGITS))
    counts = prefixed.groupBy(*by, "_prefix").agg(F.count("*").alias("_n"))
    up_to = Window.partitionBy(*by).orderBy("_prefix").rowsBetween(Window.unboundedPreceding, 0)
    shifts = counts.select(*by, "_prefix", (F.sum("_n").over(up_to) - F.col("_n")).alias("_before"))
    order = Window.partitionBy(*by, "_prefix").orderBy("_h", id_col)
    return (
        prefixed.withColumn("_rn", F.row_number().over(order))
        .join(shifts, [*by, "_prefix"])
        .withColumn(rank, F.col("_rn") + F.col("_before"))
        .drop("_prefix", "_rn", "_before")
    )


def salted_join(big: DataFrame, small: DataFrame, on: Sequence[str], salt_on: Sequence[str], salts: int = COPIES) -> DataFrame:
    """Equi-join for hot keys on the big side: the small side is repeated once per salt."""
    left = big.withColumn("_salt", F.pmod(F.xxhash64(*salt_on), F.lit(salts)).cast("int"))
    right = small.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return left.join(right, [*on, "_salt"]).drop("_salt")
