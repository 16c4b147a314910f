"""Training mart and live scoring rows: the same operators, two sets of bounds."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbline.operators import asof, audit, finance, macro, news, prices
from ebbline.operators.quality import complete_rows

GDP_COLUMNS = [f"y{k}_gdp_growth" for k in range(1, macro.GDP_YEARS + 1)]
AUDIT_ORDER = ["order_key", "line_number"]


def feature_columns(years: int = 2) -> list[str]:
    """Feature order of the model frame: 125 names for two statement years."""
    return [
        *finance.statement_columns(years),
        *prices.SHARE_DELTAS,
        *prices.RETURNS,
        *news.RATIO_COLUMNS,
        "n_opinion_in_r3",
        *macro.macro_columns(),
        *GDP_COLUMNS,
    ]


def _joined(parts: list[DataFrame], how: str = "inner") -> DataFrame:
    """All parts are grouped by (code, horizon), so these joins reuse that partitioning."""
    return reduce(lambda a, b: a.join(b, ["code", "horizon"], how), parts)


def training_mart(tables, years: int = 2, horizon: str | None = None) -> DataFrame:
    """Complete feature rows with label for every company and horizon.

    ``tables`` offers companies, finance, prices, links, articles, audits, monthly_series and
    gdp.  Companies missing in any part, or with any NULL, drop out.
    """
    companies = tables.companies()
    dim = asof.single_horizon(companies, horizon) if horizon else asof.horizons(companies)
    mart = _joined(
        [
            complete_rows(finance.latest_statements(tables.finance(), dim, years)),
            prices.price_features(tables.prices(), dim),
            news.news_ratio(tables.links(), tables.articles(), dim).select("code", "horizon", *news.RATIO_COLUMNS),
            audit.any_recent_doubt(tables.audits(), dim, AUDIT_ORDER),
            macro.macro_asof(tables.monthly_series(), dim),
            macro.gdp_lags(tables.gdp(), dim),
        ]
    )
    labelled = mart.join(companies.select("code", "bankruptcy"), "code")
    return complete_rows(labelled.select("code", "horizon", *feature_columns(years), "bankruptcy"))


def live_features(tables, as_of: Column, years: int = 2) -> DataFrame:
    """One feature row per active company as of one day; any missing feature stays NULL.

    Write the rows (``session.durable``) before filtering on completeness: see ``model_queries``.
    """
    dim = asof.live_horizon(tables.companies(), as_of)
    traded = prices.price_features(tables.prices(), dim, bounds="live")
    # A company lacking one window has no share feature at all.
    whole = F.expr(" AND ".join(f"{c} IS NOT NULL" for c in prices.SHARE_DELTAS))
    shares = traded.select(
        "code", "horizon", *[F.when(whole, F.col(c)).alias(c) for c in prices.SHARE_DELTAS], *prices.RETURNS
    )
    live = _joined(
        [
            dim.select("code", "horizon"),
            finance.latest_statements(tables.finance(), dim, years, published_only=False),
            shares,
            news.news_ratio(tables.links(), tables.articles(), dim).select("code", "horizon", *news.RATIO_COLUMNS),
            audit.any_recent_doubt(tables.audits(), dim, AUDIT_ORDER, published_only=False),
            macro.macro_asof(tables.monthly_series(), dim, rule="live"),
            macro.gdp_lags(tables.gdp(), dim),
        ],
        "left",
    )
    known = live.withColumn("n_opinion_in_r3", F.coalesce("n_opinion_in_r3", F.lit(False)))
    return known.select("code", *feature_columns(years))
