"""Annual statements: publication date, ratios and the latest-N pivot."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ebbline.functions.dates import filing_deadline

# The measures of a statement used as features, in feature order.
STATEMENT_MEASURES = (
    "total_assets", "cash", "total_debt", "equity", "sales", "net_income",
    "pretax_income", "operating_income", "gross_profit", "borrowing_dependence",
    "net_margin", "pretax_margin", "operating_margin", "gross_margin",
    "asset_turnover", "asset_growth", "debt_to_assets",
)


def with_deadline(finance: DataFrame) -> DataFrame:
    return finance.withColumn("deadline", filing_deadline(F.col("fiscal_year"), F.col("closing_month")))


def with_debt_ratio(finance: DataFrame) -> DataFrame:
    return finance.withColumn("debt_to_assets", F.try_divide("total_debt", "total_assets"))


def statement_columns(years: int) -> list[str]:
    return [f"y{k}_{m}" for k in range(1, years + 1) for m in STATEMENT_MEASURES]


def latest_statements(finance: DataFrame, dim: DataFrame, years: int, published_only: bool = True) -> DataFrame:
    """The newest ``years`` statements known at the cut-off, one wide row per company.

    Statements join their company first (a company has one row per year), then one shuffle on
    (code, horizon) serves the ranking and the pivot.  ``published_only=False`` is the live
    rule: newest years without a date filter.  Companies with any gap are kept here; see
    :func:`ebbline.operators.quality.complete_rows`.
    """
    known = with_debt_ratio(with_deadline(finance))
    joined = known.join(dim, "code")
    if published_only:
        joined = joined.where(F.col("deadline") < F.col("as_of"))
    newest = Window.partitionBy("code", "horizon").orderBy(F.desc("fiscal_year"), F.desc("closing_month"))
    ranked = joined.withColumn("rn", F.row_number().over(newest)).where(F.col("rn") <= years)
    cells = [
        F.expr(f"max({m}) FILTER (WHERE rn = {k}) AS y{k}_{m}")
        for k in range(1, years + 1)
        for m in STATEMENT_MEASURES
    ]
    return ranked.groupBy("code", "horizon").agg(*cells)
