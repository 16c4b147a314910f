"""Daily prices: look-back slice, investor-share changes and return snapshot.

The input has one row per (code, date), so a company never has more rows than there are
trading days; joins and groupings by company stay balanced.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbline.operators.asof import within_reach
from ebbline.operators.quality import complete_rows

INVESTORS = ("foreign", "inst", "indiv")
RETURNS = ("ret_1m", "ret_3m", "ret_6m")

# First and last age in days of the four windows.  Training windows leave out
# both end points; live windows include them.
SHARE_WINDOWS = {
    "train": ((1, 29), (32, 59), (62, 89), (92, 119)),
    "live": ((0, 30), (31, 60), (61, 90), (91, 120)),
}

# Age of the day whose returns are taken.
SNAPSHOT_AGE = {"train": 1, "live": 0}

# Feature order: foreign before institutional, sell before buy, newest change first.
SHARE_DELTAS = [
    f"{investor}_{side}_r{k}_r{k + 1}"
    for investor in ("foreign", "inst")
    for side in ("sell", "buy")
    for k in (1, 2, 3)
]


def look_back(prices: DataFrame, dim: DataFrame, days: int = 1096) -> DataFrame:
    """Price rows of the ``days`` + 1 days that end the day before each cut-off."""
    last = F.date_sub("as_of", 1)
    near = within_reach(prices, "date", dim, days=days + 1)
    return near.join(dim, "code").where(F.col("date").between(F.date_sub(last, days), last))


def _window_share(side: str, investor: str, first: int, last: int) -> str:
    """Share of one investor class in the trades of one window; NULL without trades."""
    traded = f"age BETWEEN {first} AND {last} AND close IS NOT NULL"
    total = {i: f"coalesce(sum({side}_{i}) FILTER (WHERE {traded}), 0D)" for i in INVESTORS}
    return f"try_divide({total[investor]}, {' + '.join(total.values())})"


def price_features(prices: DataFrame, dim: DataFrame, bounds: str = "train") -> DataFrame:
    """Share changes and the return snapshot from one grouped pass over the days in reach.

    Missing windows or a missing snapshot day leave NULLs.
    """
    windows = SHARE_WINDOWS[bounds]
    reach = within_reach(prices, "date", dim, days=windows[-1][1])
    aged = (
        reach.join(dim, "code")
        .withColumn("age", F.datediff("as_of", "date"))
        .where(F.col("age").between(windows[0][0], windows[-1][1]))
    )
    pairs = [(investor, side) for investor in ("foreign", "inst") for side in ("sell", "buy")]
    shares = [
        F.expr(f"{_window_share(s, i, *window)} AS {i}_{s}_{k}")
        for i, s in pairs
        for k, window in enumerate(windows, start=1)
    ]
    returns = [F.expr(f"max({r}) FILTER (WHERE age = {SNAPSHOT_AGE[bounds]}) AS {r}") for r in RETURNS]
    wide = aged.groupBy("code", "horizon").agg(*shares, *returns)
    deltas = [f"{i}_{s}_{k} - {i}_{s}_{k + 1} AS {i}_{s}_r{k}_r{k + 1}" for i, s in pairs for k in (1, 2, 3)]
    return wide.selectExpr("code", "horizon", *deltas, *RETURNS)


def share_deltas(prices: DataFrame, dim: DataFrame, bounds: str = "train") -> DataFrame:
    """Change of foreign and institutional trading shares between four windows.

    Companies lacking trades in any window are dropped.
    """
    return complete_rows(price_features(prices, dim, bounds).select("code", "horizon", *SHARE_DELTAS))


def return_snapshot(prices: DataFrame, dim: DataFrame, days_before: int = 1) -> DataFrame:
    """Returns on the day ``days_before`` the cut-off; companies without that day are absent."""
    day = dim.select("code", "horizon", F.date_sub("as_of", days_before).alias("date"))
    return prices.select("code", "date", *RETURNS).join(day, ["code", "date"]).select("code", "horizon", *RETURNS)
