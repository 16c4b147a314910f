"""Companies and their cut-off dates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HORIZONS = ("3m", "6m", "1y")


def horizons(companies: DataFrame) -> DataFrame:
    """One row per company and horizon: (code, horizon, as_of)."""
    pairs = F.array(*[F.struct(F.lit(h).alias("horizon"), F.col(f"pre_{h}").alias("as_of")) for h in HORIZONS])
    return companies.select("code", F.inline(pairs))


def single_horizon(companies: DataFrame, horizon: str) -> DataFrame:
    return companies.select("code", F.lit(horizon).alias("horizon"), F.col(f"pre_{horizon}").alias("as_of"))


def live_horizon(companies: DataFrame, as_of: Column) -> DataFrame:
    """Every active company with one common cut-off date."""
    active = companies.where(~F.col("delisted_check"))
    return active.select("code", F.lit("live").alias("horizon"), as_of.alias("as_of"))


def within_reach(facts: DataFrame, day: str, dim: DataFrame, months: int = 0, days: int = 0) -> DataFrame:
    """Keep facts no older than the oldest look-back and no newer than the newest cut-off.

    The two bounds are looked up first (one row of the company table): as plain dates they pass
    through the casts of the domain tables and reach the file scan as filters on the stored column.
    """
    first = F.date_sub(F.add_months(F.min("as_of"), -months), days)
    oldest, newest = dim.agg(first, F.max("as_of")).first()
    return facts.where(F.col(day).between(F.lit(oldest).cast("date"), F.lit(newest).cast("date")))
