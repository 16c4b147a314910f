"""Macro-economic series as known at each cut-off."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbline.functions.dates import newest_public_month

MONTHS = 12
GDP_YEARS = 3
MONTHLY_SERIES = ("oil_price", "oil_price_yoy", "cd91", "bond3y", "usdkrw")


def macro_columns(series: Sequence[str] = MONTHLY_SERIES) -> list[str]:
    return [f"m{k}_{s}" for s in series for k in range(1, MONTHS + 1)]


def _lagged_by_month(monthly: DataFrame, series: Sequence[str]) -> DataFrame:
    """One row per anchor month with the values of that month and the eleven before it.

    Each value is sent to the twelve anchors that see it, so nothing multiplies on the company
    side.  The grouping by calendar month bounds the result: twelve rows per year of history.
    """
    spread = monthly.withColumn("k", F.explode(F.sequence(F.lit(1), F.lit(MONTHS)))).withColumn(
        "anchor", F.expr("add_months(month, k - 1)")
    )
    cells = [F.expr(f"max({s}) FILTER (WHERE k = {k}) AS m{k}_{s}") for s in series for k in range(1, MONTHS + 1)]
    return spread.groupBy("anchor").agg(*cells)


def macro_asof(monthly: DataFrame, dim: DataFrame, rule: str = "train", series: Sequence[str] = MONTHLY_SERIES) -> DataFrame:
    """Twelve newest public values of every series per company and horizon.

    ``monthly`` has one row per ``month``.  Companies meet the lagged table by equality on the
    newest public month.  That table is broadcast: it cannot exceed one row per calendar
    month, while a shuffle on so few distinct months could not be balanced.  With one common
    cut-off day the month is a constant: Spark then filters the table to one row up front.
    """
    anchored = dim.withColumn("anchor", newest_public_month(F.col("as_of"), rule))
    lagged = F.broadcast(_lagged_by_month(monthly, series))
    return anchored.join(lagged, "anchor", "left").select("code", "horizon", *macro_columns(series))


def gdp_lags(yearly: DataFrame, dim: DataFrame) -> DataFrame:
    """Growth of the three calendar years before the cut-off's year."""
    spread = yearly.withColumn("k", F.explode(F.sequence(F.lit(1), F.lit(GDP_YEARS)))).withColumn(
        "anchor_year", F.col("year") + F.col("k")
    )
    cells = [F.expr(f"max(gdp_growth) FILTER (WHERE k = {k}) AS y{k}_gdp_growth") for k in (1, 2, 3)]
    lagged = F.broadcast(spread.groupBy("anchor_year").agg(*cells))
    anchored = dim.withColumn("anchor_year", F.year("as_of"))
    return anchored.join(lagged, "anchor_year", "left").select(
        "code", "horizon", *[f"y{k}_gdp_growth" for k in (1, 2, 3)]
    )
