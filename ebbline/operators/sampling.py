"""Splits and resampling of imbalanced frames (id, features, label with label 1 the rare class).

Every random choice is a hash of row ids and the seed, so a recomputed task repeats it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbline.functions.numbers import hash_int
from ebbline.operators.neighbours import nearest
from ebbline.operators.ranking import before_cut, cuts_ahead, hash_cut, hash_cuts, hash_rank, hashed, salted_join
from ebbline.session import durable

# Fixed values of the validation scheme.
SPLITS = 30
TEST_SHARE = 0.25
SEED = 20
NEIGHBOURS = 5
DRAWS_PER_ROW = 1000
HASH_RANGE = float(2**32)


def stratified_split(
    df: DataFrame, id_col: str, label: str, n_splits: int = SPLITS, test_share: float = TEST_SHARE, seed: int = SEED,
    keep: Sequence[str] = (),
) -> DataFrame:
    """(split, id, label, is_test) and the columns to ``keep`` for repeated splits with exact class shares.

    In each split and class the first ``round(share * n)`` rows in hash order are the test
    set.  Only the boundary hash of each class is looked up; rows are then labelled in place,
    without moving them.  The boundary table has one row per split and class.
    """
    spread = df.select(
        F.explode(F.sequence(F.lit(1), F.lit(n_splits))).alias("split"), F.col(id_col), F.col(label), *keep
    )
    tagged = hashed(spread, id_col, F.lit(seed), F.col("split"))
    cuts = hash_cut(tagged, ["split", label], id_col, F.round(F.col("_total") * test_share))
    return tagged.join(F.broadcast(cuts), ["split", label], "left").select(
        "split", id_col, label, *keep, before_cut(id_col).alias("is_test")
    )


def stratified_folds(df: DataFrame, id_col: str, label: str, folds: int = 4, seed: int = SEED) -> DataFrame:
    """Add ``fold`` (0-based): equal consecutive stretches of each class in hash order."""
    tagged = hashed(df, id_col, F.lit(seed))
    takes = [F.round(F.col("_total") * i / folds) for i in range(1, folds)]
    cuts = hash_cuts(tagged.select(label, id_col, "_h"), [label], id_col, takes)
    placed = tagged.join(F.broadcast(cuts), label, "left")
    return placed.withColumn("fold", F.lit(folds - 1) - cuts_ahead(id_col)).drop("_h", "cuts")


def _draws(df: DataFrame, seed: int) -> DataFrame:
    """One draw (token) per missing minority row: the first majority rows in hash order lend their ids."""
    sizes = df.agg(F.count_if(F.col("label") == 0).alias("n0"), F.count_if(F.col("label") == 1).alias("n1"))
    tagged = hashed(df.where("label = 0").select("label", "id"), "id", F.lit(seed))
    missing = sizes.select(F.greatest(F.col("n0") - F.col("n1"), F.lit(0))).scalar()
    cut = F.broadcast(hash_cut(tagged, ["label"], "id", missing))
    drawn = tagged.join(cut, "label", "left").where(before_cut("id"))
    return drawn.select(F.col("id").alias("token"))


def _unit(*parts: Column) -> Column:
    """Hash as a number in [0, 1)."""
    return hash_int(*parts) / HASH_RANGE


def _minority_by_rank(df: DataFrame, seed: int) -> DataFrame:
    return hash_rank(hashed(df.where("label = 1"), "id", F.lit(seed)), ["label"], "id").drop("_h")


def _picked(draws: DataFrame, minority: DataFrame, seed: int) -> DataFrame:
    """Each draw with the minority row it picked."""
    n = minority.agg(F.count("*")).scalar()
    picks = draws.withColumn("_n", n).where("_n > 0")
    picks = picks.withColumn("rank", hash_int(F.col("token"), F.lit(seed), F.lit("base")) % F.col("_n") + 1)
    # Salted: a minority of a few rows is picked again and again.
    return salted_join(picks, minority.select("rank", "id", "features"), ["rank"], ["token"]).drop("rank", "_n")


def _with_synthetic(df: DataFrame, synthetic: DataFrame) -> DataFrame:
    """Given rows plus the added ones; ``token`` is NULL for given rows."""
    return unsampled(df).unionByName(synthetic.select("id", "token", "features", F.lit(1).alias("label")))


def random_oversample(df: DataFrame, seed: int = SEED) -> DataFrame:
    """Repeat random minority rows until both classes have the same size."""
    picked = _picked(_draws(df, seed), _minority_by_rank(df, seed), seed)
    return _with_synthetic(df, picked)


def _between(base: Column, other: Column, gap: Column) -> Column:
    return F.zip_with(base, other, lambda x, y: x + gap * (y - x))


def _interpolated(picked: DataFrame, neighbours: DataFrame, minority: DataFrame, seed: int) -> DataFrame:
    """Points between each picked row and one of its minority neighbours.

    A row with fewer neighbours than asked for (tiny classes) chooses among those it has.
    Both joins are salted by draw: one row may be picked, or be the neighbour, most of the time.
    """
    ordered = F.sort_array(F.collect_list(F.struct("rank", "neighbour")))
    lists = neighbours.groupBy("id").agg(ordered.alias("_near"))
    choice = hash_int(F.col("token"), F.lit(seed), F.lit("neighbour"))
    position = (choice % F.size("_near")).cast("int")
    chosen = salted_join(picked, lists, ["id"], ["token"]).withColumn("neighbour", F.get("_near", position)["neighbour"])
    others = minority.select(F.col("id").alias("neighbour"), F.col("features").alias("_other"))
    gap = _unit(F.col("token"), F.lit(seed), F.lit("gap"))
    return (
        salted_join(chosen.drop("_near"), others, ["neighbour"], ["token"])
        .withColumn("_gap", gap)
        .withColumn("features", _between(F.col("features"), F.col("_other"), F.col("_gap")))
        .select("id", "token", "features")
    )


def smote(df: DataFrame, k: int = NEIGHBOURS, seed: int = SEED) -> DataFrame:
    """Add points between minority rows and their nearest minority neighbours, up to parity."""
    minority = df.where("label = 1").select("id", "features")
    near = nearest(minority, minority, k)
    picked = _picked(_draws(df, seed), _minority_by_rank(df, seed), seed)
    return _with_synthetic(df, _interpolated(picked, near, minority, seed))


def adasyn_allocation(df: DataFrame, k: int = NEIGHBOURS) -> DataFrame:
    """(id, n_new): synthetic points per minority row, by the share of majority neighbours."""
    minority = df.where("label = 1").select("id", "features")
    around = nearest(minority, df.select("id", "features"), k)
    labels = df.select(F.col("id").alias("neighbour"), (F.col("label") == 0).cast("int").alias("_other"))
    # Written once: the rows and their total both come from it.
    shares = durable(around.join(labels, "neighbour").groupBy("id").agg(F.sum("_other").cast("double").alias("r")))
    missing = df.agg(F.greatest(F.count_if(F.col("label") == 0) - F.count_if(F.col("label") == 1), F.lit(0))).scalar()
    total = shares.agg(F.sum("r")).scalar()
    weighted = shares.select("id", "r", total.alias("_total"), missing.alias("_missing"))
    wanted = F.bround(F.try_divide(F.col("r"), F.col("_total")) * F.col("_missing"))
    return weighted.select("id", F.coalesce(wanted, F.lit(0.0)).cast("bigint").alias("n_new"))


def adasyn(df: DataFrame, k: int = NEIGHBOURS, seed: int = SEED) -> DataFrame:
    """Add more points where the minority is outnumbered.

    A row's draws are made in runs of bounded length, so one row that receives most of them
    does not build one long array.
    """
    minority = df.where("label = 1").select("id", "features")
    wanted = adasyn_allocation(df, k).where("n_new > 0")
    runs = wanted.select("id", "n_new", F.explode(F.sequence(F.lit(0), F.floor((F.col("n_new") - 1) / DRAWS_PER_ROW))).alias("run"))
    here = F.least(F.lit(DRAWS_PER_ROW), F.col("n_new") - F.col("run") * DRAWS_PER_ROW)
    draws = runs.select("id", "run", F.explode(F.sequence(F.lit(1), here.cast("int"))).alias("i"))
    token = F.xxhash64(F.lit(seed), "id", "run", "i")
    picked = salted_join(draws.withColumn("token", token), minority, ["id"], ["token"]).select("id", "token", "features")
    near = nearest(minority, minority, k)
    return _with_synthetic(df, _interpolated(picked, near, minority, seed))


def unsampled(df: DataFrame, seed: int = SEED) -> DataFrame:
    return df.select("id", F.lit(None).cast("bigint").alias("token"), "features", "label")


SAMPLERS = {"none": unsampled, "random": random_oversample, "smote": smote, "adasyn": adasyn}
