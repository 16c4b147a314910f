"""Audit reports: recent doubts and the selection of filings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbline.operators.ranking import latest_n, latest_n_skewed, run_heads, salted_join

REPORTS = 3
FILINGS = 10
CORRECTION = "정정"  # fixed value: marks a corrected filing


def any_recent_doubt(audits: DataFrame, dim: DataFrame, tie_break: list[str], published_only: bool = True) -> DataFrame:
    """True when one of the three newest reports doubts the company's survival.

    Reports without a date are allowed and rank last.  All-NULL opinions give False.
    ``published_only=False`` is the live rule: no date filter.

    A report is not repeated per horizon.  Reports that the same cut-offs of a company can see
    form a stretch; the three newest of each stretch are found first, and only those are
    matched with the horizons.
    """
    order = [F.desc_nulls_last("report_date"), *[F.asc(c) for c in tie_break]]
    visible = F.lit(True)
    stretch = F.lit(0)
    if published_only:
        visible = F.col("report_date").isNull() | (F.col("report_date") < F.col("as_of"))
        seen_by = F.size(F.filter("cuts", lambda cut: F.col("report_date") < cut))
        stretch = F.when(F.col("report_date").isNotNull(), seen_by).otherwise(-1)
    cuts = dim.groupBy("code").agg(F.collect_list("as_of").alias("cuts"))
    known = salted_join(audits, cuts, ["code"], tie_break).withColumn("stretch", stretch).drop("cuts")
    if published_only:
        known = known.where(F.col("stretch") != 0)
    newest = latest_n_skewed(known, ["code", "stretch"], order, REPORTS).drop("rn")
    seen = newest.join(dim, "code").where(visible)
    return latest_n(seen, ["code", "horizon"], order, REPORTS).groupBy("code", "horizon").agg(
        F.coalesce(F.bool_or("n_opinion"), F.lit(False)).alias("n_opinion_in_r3")
    )


def latest_reports(audits: DataFrame, tie_break: list[str], n: int = REPORTS) -> DataFrame:
    """Newest reports per company with their display form."""
    order = [F.desc_nulls_last("report_date"), *[F.asc(c) for c in tie_break]]
    newest = latest_n_skewed(audits, ["code"], order, n)
    year_month = F.concat(F.year("report_date").cast("string"), F.lit("-"), F.month("report_date").cast("string"))
    return newest.select(
        "code",
        "rn",
        F.coalesce(year_month, F.lit("-")).alias("year_month"),
        F.when(F.col("n_opinion"), F.lit("예")).otherwise(F.lit("아니오")).alias("n_opinion"),
    )


def select_filings(filings: DataFrame, companies: DataFrame, base_url: str) -> DataFrame:
    """Ten newest filings per company, numbered A-1..A-10.

    Corrections never count.  For delisted companies, filings after the delisting date are
    dropped and of consecutive filings for one period only the newest stays.
    """
    counted = filings.where(~F.contains(F.col("rpt_nm"), F.lit(CORRECTION))).withColumn("filed_on", F.to_date("rcp_dt", "yyyyMMdd"))
    # Salted: one company may hold a third of all filings.
    dated = salted_join(counted, companies.select("code", "delisted_date"), ["code"], ["rcp_no"])
    # The eight characters before the closing bracket name the period.
    period = F.substring(F.substring(F.col("rpt_nm"), -9, 9), 1, 8)
    active = dated.where(F.col("delisted_date").isNull())
    gone = dated.where(F.col("filed_on") <= F.col("delisted_date")).withColumn("period", period)
    heads = run_heads(
        gone, "code", F.col("filed_on"), [("filed_on", True), ("rcp_no", True)], "period"
    ).drop("period")
    order = [F.desc("filed_on"), F.desc("rcp_no")]
    kept = latest_n_skewed(active.unionByName(heads), ["code"], order, FILINGS)
    return kept.select(
        "code",
        F.concat(F.lit("A-"), F.col("rn").cast("string")).alias("report_name"),
        "rpt_nm",
        "filed_on",
        F.concat(F.lit(base_url), F.col("rcp_no")).alias("url"),
    )
