"""Indicator queries of the company page, for every active company in one run.

Prices have one row per company and day, so ranking a company's days is a small group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbline.functions.dates import is_weekday, month_label, month_start
from ebbline.functions.numbers import share
from ebbline.operators import asof, audit, news
from ebbline.operators.finance import with_debt_ratio
from ebbline.operators.prices import INVESTORS
from ebbline.operators.ranking import latest_n

# Lengths of the page's charts and tables.
DAYS = 365
CHART_MONTHS = 13
STATEMENTS = 4
THOUSANDS_PER_UNIT = 100_000


def publish(rows: DataFrame, target: str) -> None:
    """Write a page table so that one company's rows lie together and can be found by code."""
    rows.repartition("code").sortWithinPartitions("code").write.mode("overwrite").parquet(target)


def lookup(spark: SparkSession, target: str, code) -> DataFrame:
    """One company's rows; file statistics on the code skip all other parts."""
    return spark.read.parquet(target).where(F.col("code") == code)


def active(companies: DataFrame, names: Sequence[str] | None = None) -> DataFrame:
    """Listed companies, optionally only some names."""
    listed = companies.where(~F.col("delisted_check"))
    return listed.where(F.col("name").isin(*names)) if names else listed


def _of_active(facts: DataFrame, companies: DataFrame, names: Sequence[str] | None) -> DataFrame:
    return facts.join(active(companies, names).select("code", "name"), "code")


def daily_measure(prices: DataFrame, companies: DataFrame, measure: str, names: Sequence[str] | None = None) -> DataFrame:
    """Latest 365 weekday values of one measure."""
    days = _of_active(prices.select("code", "date", measure), companies, names).where(is_weekday(F.col("date")))
    return latest_n(days, ["code"], [F.desc("date")], DAYS).select("code", "name", "rn", "date", measure)


def _shares(side: str, total: bool) -> list[Column]:
    value = {i: F.sum(f"{side}_{i}") if total else F.col(f"{side}_{i}") for i in INVESTORS}
    return [
        F.round(share(value[i], *[v for j, v in value.items() if j != i]), 3).alias(f"{i}_{side}_share")
        for i in INVESTORS
    ]


def daily_shares(prices: DataFrame, companies: DataFrame, side: str, names: Sequence[str] | None = None) -> DataFrame:
    days = _of_active(prices, companies, names).where(is_weekday(F.col("date")))
    latest = latest_n(days, ["code"], [F.desc("date")], DAYS)
    return latest.select("code", "rn", "date", *_shares(side, total=False))


def monthly_shares(prices: DataFrame, companies: DataFrame, side: str, names: Sequence[str] | None = None) -> DataFrame:
    """Latest 13 months of trading shares per investor class."""
    days = _of_active(prices, companies, names).where(is_weekday(F.col("date")))
    months = days.groupBy("code", month_start(F.col("date")).alias("month")).agg(*_shares(side, total=True))
    latest = latest_n(months, ["code"], [F.desc("month")], CHART_MONTHS)
    return latest.select("code", "rn", month_label(F.col("month")).alias("month"), *[f"{i}_{side}_share" for i in INVESTORS])


def company_news(tables, as_of: Column, names: Sequence[str] | None = None) -> DataFrame:
    """Twelve monthly ratios and counts (normal, related, both) per company, long form."""
    dim = asof.live_horizon(active(tables.companies(), names), as_of)
    mart = news.news_ratio(tables.links(), tables.articles(), dim)
    months = F.array(
        *[
            F.struct(
                F.lit(k).alias("month_back"),
                F.round(f"m{k}", 3).alias("ratio"),
                F.col(f"m{k}_normal_num").alias("n_normal"),
                F.col(f"m{k}_bankruptcy_related_num").alias("n_related"),
                (F.col(f"m{k}_normal_num") + F.col(f"m{k}_bankruptcy_related_num")).alias("n_total"),
            )
            for k in range(1, news.MONTHS + 1)
        ]
    )
    return mart.select("code", F.inline(months))


def cohort_news(tables) -> DataFrame:
    companies = tables.companies()
    mart = news.news_ratio(tables.links(), tables.articles(), asof.horizons(companies))
    return news.cohort_ratio(mart, companies)


def chart_series(points: DataFrame, key: str, x: str, y: str) -> DataFrame:
    """Points per key packed as ``{"x": [...], "y": [...]}``, newest first.

    Input rows per key are bounded by the chart length, so the lists are small.
    """
    packed = points.groupBy(key).agg(
        F.sort_array(F.collect_list(F.struct(F.col(x).cast("string").alias("x"), F.col(y).alias("y"))), asc=False).alias("p")
    )
    series = F.to_json(F.struct(F.col("p.x").alias("x"), F.col("p.y").alias("y")), {"ignoreNullFields": "false"})
    return packed.select(key, series.alias("series"))


def statements(finance: DataFrame, companies: DataFrame, names: Sequence[str] | None = None) -> DataFrame:
    """Four newest fiscal years in units of 100 million."""
    rows = _of_active(with_debt_ratio(finance), companies, names)
    latest = latest_n(rows, ["code"], [F.desc("fiscal_year"), F.desc("closing_month")], STATEMENTS)

    def unit(c: str) -> Column:
        return F.round(F.col(c) / THOUSANDS_PER_UNIT, 2).alias(c)

    return latest.select(
        "code",
        "rn",
        "fiscal_year",
        unit("sales"),
        unit("net_income"),
        unit("operating_income"),
        F.round("net_margin", 6).alias("net_margin"),
        F.round("operating_margin", 6).alias("operating_margin"),
        unit("total_assets"),
        unit("total_debt"),
        F.col("debt_ratio_text").alias("debt_ratio"),
        F.round("debt_to_assets", 2).alias("debt_to_assets"),
    )


def latest_audits(audits: DataFrame, companies: DataFrame, order: list[str], names: Sequence[str] | None = None) -> DataFrame:
    return audit.latest_reports(_of_active(audits, companies, names), order)


def prediction_panel(companies: DataFrame, scores: DataFrame) -> DataFrame:
    """Scores as display text per active company, '-' where there is none."""
    panel = active(companies).select("code", "name").join(scores, "code", "left")
    shown = [F.coalesce(F.col(c).cast("string"), F.lit("-")).alias(c) for c in scores.columns if c != "code"]
    return panel.select("code", "name", *shown)
