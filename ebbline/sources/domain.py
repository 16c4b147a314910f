"""Domain tables built from the given star-schema tables.

Every table covers its whole source.  Money and rates are summed as integers, so sums do not
depend on the order in which tasks finish.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

DATA_END = "2001-06-30"


class Domain:
    """Lazily built domain tables of one data folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder
        self._read: dict[str, DataFrame] = {}

    def raw(self, name: str) -> DataFrame:
        """A given table; its footer is read once however many domain tables use it."""
        if name not in self._read:
            self._read[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return self._read[name]

    @property
    def data_end(self) -> Column:
        return F.lit(DATA_END).cast("date")

    def companies(self) -> DataFrame:
        failed = F.col("s_suppkey") % 7 == 0
        end = F.date_sub(self.data_end, (F.col("s_suppkey") % 365).cast("int"))
        return (
            self.raw("supplier")
            .select(
                F.col("s_suppkey").alias("code"),
                F.col("s_name").alias("name"),
                failed.alias("bankruptcy"),
                failed.alias("delisted_check"),
                F.when(failed, end).alias("delisted_date"),
                end.alias("_end"),
            )
            .withColumns({f"pre_{h}": F.add_months("_end", -m) for h, m in (("3m", 3), ("6m", 6), ("1y", 12))})
            .drop("_end")
        )

    def _lines(self) -> DataFrame:
        """Line items with day and integer money."""
        return self.raw("lineitem").select(
            F.col("l_suppkey").alias("code"),
            F.col("l_orderkey").alias("order_key"),
            F.col("l_linenumber").alias("line_number"),
            F.col("l_shipdate").cast("date").alias("date"),
            F.round("l_quantity").cast("bigint").alias("qty"),
            F.round(F.col("l_extendedprice") * 100).cast("bigint").alias("cents"),
            F.round(F.col("l_discount") * 100).cast("bigint").alias("disc"),
            F.round(F.col("l_tax") * 100).cast("bigint").alias("tax"),
            F.col("l_returnflag").alias("flag"),
        )

    def prices(self) -> DataFrame:
        """One row per company and day."""
        kinds = (("foreign", "A"), ("inst", "N"), ("indiv", "R"))
        sells = [F.sum(F.when(F.col("flag") == f, F.col("qty"))).cast("double").alias(f"sell_{i}") for i, f in kinds]
        buys = [(F.sum(F.when(F.col("flag") == f, F.col("cents"))) / 100000.0).alias(f"buy_{i}") for i, f in kinds]
        close = F.when(F.max("line_number") != 1, F.sum("cents") / F.sum("qty") / 100.0)
        n = F.count("*") * 100.0
        return (
            self._lines()
            .groupBy("code", "date")
            .agg(
                close.alias("close"),
                F.sum("qty").cast("double").alias("volume"),
                *sells,
                *buys,
                (F.sum("disc") / n).alias("ret_1m"),
                (F.sum("tax") / n).alias("ret_3m"),
                (F.sum(F.col("disc") - F.col("tax")) / n).alias("ret_6m"),
            )
        )

    def finance(self) -> DataFrame:
        """One row per company and fiscal year; two ratios arrive as text with markers."""
        cents, disc, tax = F.col("cents"), F.col("disc"), F.col("tax")
        sums = (
            self._lines()
            .groupBy("code", F.year("date").alias("fiscal_year"))
            .agg(
                F.sum("cents").alias("p"),
                F.sum(cents * disc).alias("pd"),
                F.sum(cents * tax).alias("pt"),
                F.sum(F.when(F.col("flag") == "R", cents).otherwise(0)).alias("pr"),
                F.sum(F.when(F.col("flag") == "A", cents).otherwise(0)).alias("pa"),
                F.sum("qty").alias("q"),
                F.count("*").alias("n"),
            )
        )
        p, pd, pt, pr = F.col("p"), F.col("pd"), F.col("pt"), F.col("pr")
        earlier = F.lag("p").over(Window.partitionBy("code").orderBy("fiscal_year"))
        growth = F.round((p - earlier) * 10000.0 / earlier).cast("bigint")
        text_growth = F.when(earlier.isNull(), F.lit("N/A(no prior year)")).otherwise(growth.cast("string"))
        leverage = F.floor(pd * 10 / p).cast("bigint")
        return sums.select(
            "code",
            "fiscal_year",
            F.when(F.col("code") % 5 == 0, 3).otherwise(12).alias("closing_month"),
            (p / 100.0).alias("total_assets"),
            (F.col("pa") / 100.0).alias("cash"),
            ((p * 100 - pd) * 0.6 / 10000.0).alias("total_debt"),
            (p / 100.0 - (p * 100 - pd) * 0.6 / 10000.0).alias("equity"),
            F.col("q").cast("double").alias("sales"),
            ((pt - pd) / 10000.0).alias("net_income"),
            (pt / 10000.0).alias("pretax_income"),
            (pd / 10000.0).alias("operating_income"),
            (pr / 100.0).alias("gross_profit"),
            (F.col("pa") / p).alias("borrowing_dependence"),
            ((pt - pd) / p).alias("net_margin"),
            (pt / p).alias("pretax_margin"),
            (pd / p).alias("operating_margin"),
            (pr / p).alias("gross_margin"),
            (F.col("n") * 1000000.0 / p).alias("asset_turnover"),
            text_growth.alias("asset_growth_text"),
            F.when(leverage > 52, F.lit("완전잠식")).otherwise(leverage.cast("string")).alias("debt_ratio_text"),
        ).withColumn("asset_growth", F.col("asset_growth_text").try_cast("double"))

    def audits(self) -> DataFrame:
        """One report per line item; the date is missing where the discount is 10 %."""
        opinion = F.when(F.col("flag") == "A", True).when(F.col("flag") == "N", False)
        return self._lines().select(
            "code",
            F.when(F.col("disc") != 10, F.col("date")).alias("report_date"),
            opinion.alias("n_opinion"),
            "order_key",
            "line_number",
        )

    def filings(self) -> DataFrame:
        """Filing list: returned lines are corrections, the period is the month shipped."""
        fixed = F.when(F.col("flag") == "R", F.lit("[기재정정]")).otherwise(F.lit(""))
        number = F.concat(F.lpad(F.col("order_key").cast("string"), 12, "0"), F.col("line_number").cast("string"))
        return self._lines().select(
            "code",
            F.concat(fixed, F.lit("감사보고서 ("), F.date_format("date", "yyyy.MM"), F.lit(")")).alias("rpt_nm"),
            F.date_format("date", "yyyyMMdd").alias("rcp_dt"),
            F.concat(F.date_format("date", "yyyyMMdd"), number).alias("rcp_no"),
        )

    def articles(self) -> DataFrame:
        urgent = F.col("o_orderpriority") == "1-URGENT"
        unknown = (F.col("o_orderstatus") == "P") & (F.col("o_totalprice") < 50000)
        return self.raw("orders").select(
            F.col("o_orderkey").alias("url"),
            F.col("o_orderdate").cast("date").alias("published_date"),
            F.when(~unknown, urgent).alias("related"),
        )

    def links(self) -> DataFrame:
        return self.raw("lineitem").select(F.col("l_suppkey").alias("code"), F.col("l_orderkey").alias("url"))

    def monthly_series(self) -> DataFrame:
        """One row per month; months are few, so the year-on-year lag is a small window."""
        orders = self.raw("orders").select(
            F.trunc(F.col("o_orderdate").cast("date"), "month").alias("month"),
            F.round(F.col("o_totalprice") * 100).cast("bigint").alias("cents"),
        )
        oil = orders.groupBy("month").agg((F.sum("cents") / F.count("*") / 100.0).alias("oil_price"))
        before = oil.select(F.add_months("month", 12).alias("month"), F.col("oil_price").alias("_before"))
        oil = oil.join(before, "month", "left").withColumn(
            "oil_price_yoy", F.col("oil_price") / F.col("_before") - 1
        )
        rates = (
            self._lines()
            .groupBy(F.trunc("date", "month").alias("month"))
            .agg(
                (F.sum("disc") / F.count("*")).alias("cd91"),
                (F.sum("tax") / F.count("*")).alias("bond3y"),
                (F.sum("qty") / F.count("*")).alias("usdkrw"),
            )
        )
        return oil.drop("_before").join(rates, "month", "full")

    def gdp(self) -> DataFrame:
        cents = F.round(F.col("o_totalprice") * 100).cast("bigint")
        totals = self.raw("orders").groupBy(F.year(F.col("o_orderdate").cast("date")).alias("year")).agg(F.sum(cents).alias("t"))
        before = totals.select((F.col("year") + 1).alias("year"), F.col("t").alias("_before"))
        return totals.join(before, "year", "left").select("year", (F.col("t") / F.col("_before") - 1).alias("gdp_growth"))

    def prices_long(self) -> DataFrame:
        """(code, date, item, value) per company, day and item."""
        return (
            self.raw("events")
            .groupBy(
                F.col("user_id").alias("code"),
                F.col("ts").cast("date").alias("date"),
                F.col("event_type").alias("item"),
            )
            .agg(F.sum(F.round(F.col("value") * 100).cast("bigint")).alias("value"))
        )

    def ml_frame(self) -> DataFrame:
        """(id, features, label)."""
        return self.raw("embeddings").select(
            F.col("vec_id").alias("id"),
            F.col("embedding").cast("array<double>").alias("features"),
            (F.col("label") == 0).cast("int").alias("label"),
        )
