"""News marts: default-news ratio and counts per month before the cut-off."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbline.functions.numbers import count_where, share
from ebbline.operators.asof import within_reach

MONTHS = 12
RATIO_COLUMNS = [f"m{k}" for k in range(1, MONTHS + 1)]
NORMAL_COLUMNS = [f"m{k}_normal_num" for k in range(1, MONTHS + 1)]
RELATED_COLUMNS = [f"m{k}_bankruptcy_related_num" for k in range(1, MONTHS + 1)]


def daily_article_counts(links: DataFrame, articles: DataFrame) -> DataFrame:
    """Articles per company and day: all, default-related, normal.

    Duplicate links collapse before the join (map side first), and the result has at most one
    row per company and calendar day, however many articles one company attracts.
    """
    pairs = links.select("code", "url").distinct()
    facts = articles.select("url", "published_date", "related")
    return (
        pairs.join(facts, "url")
        .groupBy("code", "published_date")
        .agg(
            F.count("*").alias("n_all"),
            count_where(F.col("related")).alias("n_related"),
            count_where(~F.col("related")).alias("n_normal"),
        )
    )


def news_ratio(links: DataFrame, articles: DataFrame, dim: DataFrame) -> DataFrame:
    """Twelve monthly ratios and counts per company and horizon.

    Month k covers ``[as_of - k months, as_of - (k-1) months]`` with both ends included, so an
    article on a boundary day counts in two months.  Days join cut-offs on the company code;
    the months are conditional sums of one grouping, without a row per month.
    """
    recent = within_reach(articles, "published_date", dim, months=MONTHS)
    days = daily_article_counts(links, recent).join(dim, "code")
    days = days.where(F.expr(f"published_date BETWEEN add_months(as_of, -{MONTHS}) AND as_of"))
    inside = "published_date BETWEEN add_months(as_of, -{k}) AND add_months(as_of, 1 - {k})"
    sums = [
        F.expr(f"sum({n}) FILTER (WHERE {inside.format(k=k)}) AS {n}_{k}")
        for n in ("n_all", "n_related", "n_normal")
        for k in range(1, MONTHS + 1)
    ]
    sparse = days.groupBy("code", "horizon").agg(*sums)
    filled = dim.select("code", "horizon").join(sparse, ["code", "horizon"], "left")
    months = range(1, MONTHS + 1)
    return filled.selectExpr(
        "code",
        "horizon",
        *[f"coalesce(try_divide(n_related_{k}, n_all_{k}), 0D) AS m{k}" for k in months],
        *[f"coalesce(n_normal_{k}, 0) AS m{k}_normal_num" for k in months],
        *[f"coalesce(n_related_{k}, 0) AS m{k}_bankruptcy_related_num" for k in months],
    )


def cohort_ratio(mart: DataFrame, companies: DataFrame) -> DataFrame:
    """Ratio of summed counts per horizon and outcome class, 3 digits."""
    labelled = mart.join(companies.select("code", "bankruptcy"), "code")
    ratios = [
        F.round(share(F.sum(f"m{k}_bankruptcy_related_num"), F.sum(f"m{k}_normal_num")), 3).alias(f"m{k}_ratio")
        for k in range(1, MONTHS + 1)
    ]
    return labelled.groupBy("horizon", "bankruptcy").agg(*ratios)
