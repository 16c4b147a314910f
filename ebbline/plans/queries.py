"""Every query by name: ``name -> (spark, folder) -> DataFrame``."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType

from ebbline.functions import html as H
from ebbline.functions import text as T
from ebbline.operators import articles as A
from ebbline.operators import asof, audit, finance, macro, news, prices, quality, ranking, reshape, terms
from ebbline.plans import features, serving
from ebbline.session import shared_dir
from ebbline.sources import files, keyed
from ebbline.sources.domain import Domain

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Terms that do occur in the given documents, in the roles of the fixed Korean terms.
DOC_TERMS = ("oueaux", "nicht", "thereth", "ción", "erund")
DOC_SUBJECT = "the"
DOC_DOUBTS = ("ation", "erre")
VIEWER = "http://viewer.example/report"
VIEWER_ARGS = ["rcpNo", "dcmNo", "eleId", "offset", "length", "dtd"]
ITEMS = {"view": "views", "click": "clicks", "signup": "signups", "purchase": "purchases", "error": "errors"}


def query(build: Callable[[Domain], DataFrame]) -> Callable[[Domain], DataFrame]:
    QUERIES[build.__name__] = lambda spark, folder: build(Domain(spark, folder))
    return build


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    return df.selectExpr(*[f"round({c}, {digits}) AS {c}" if t == "double" else c for c, t in df.dtypes])


# -- point-in-time marts -----------------------------------------------------------------


@query
def horizons(d: Domain) -> DataFrame:
    return asof.horizons(d.companies())


@query
def finance_deadline(d: Domain) -> DataFrame:
    return finance.with_deadline(d.finance()).select("code", "fiscal_year", "closing_month", "deadline")


@query
def debt_ratio(d: Domain) -> DataFrame:
    return rounded(finance.with_debt_ratio(d.finance()).select("code", "fiscal_year", "debt_to_assets", "asset_growth"))


@query
def finance_asof_pivot(d: Domain) -> DataFrame:
    wide = finance.latest_statements(d.finance(), asof.horizons(d.companies()), years=2)
    return rounded(quality.complete_rows(wide))


@query
def finance_asof_pivot_3y(d: Domain) -> DataFrame:
    wide = finance.latest_statements(d.finance(), asof.horizons(d.companies()), years=3)
    return rounded(quality.complete_rows(wide))


@query
def stock_lookback(d: Domain) -> DataFrame:
    rows = prices.look_back(d.prices(), asof.horizons(d.companies()))
    return rounded(rows.select("code", "horizon", "date", "close", "volume"))


@query
def trade_share_delta(d: Domain) -> DataFrame:
    return rounded(prices.share_deltas(d.prices(), asof.horizons(d.companies())))


@query
def trade_share_delta_live(d: Domain) -> DataFrame:
    return rounded(prices.share_deltas(d.prices(), asof.live_horizon(d.companies(), d.data_end), bounds="live"))


@query
def return_snapshot(d: Domain) -> DataFrame:
    return rounded(prices.return_snapshot(d.prices(), asof.horizons(d.companies())))


@query
def return_snapshot_live(d: Domain) -> DataFrame:
    return rounded(prices.return_snapshot(d.prices(), asof.live_horizon(d.companies(), d.data_end), days_before=0))


@query
def news_ratio_12m(d: Domain) -> DataFrame:
    return rounded(news.news_ratio(d.links(), d.articles(), asof.horizons(d.companies())))


@query
def news_ratio_live(d: Domain) -> DataFrame:
    return rounded(news.news_ratio(d.links(), d.articles(), asof.live_horizon(d.companies(), d.data_end)))


@query
def macro_asof_12m(d: Domain) -> DataFrame:
    return rounded(macro.macro_asof(d.monthly_series(), asof.horizons(d.companies())))


@query
def macro_asof_live(d: Domain) -> DataFrame:
    return rounded(macro.macro_asof(d.monthly_series(), asof.live_horizon(d.companies(), d.data_end), rule="live"))


@query
def gdp_lag_3y(d: Domain) -> DataFrame:
    return rounded(macro.gdp_lags(d.gdp(), asof.horizons(d.companies())))


@query
def audit_any_doubt_r3(d: Domain) -> DataFrame:
    return audit.any_recent_doubt(d.audits(), asof.horizons(d.companies()), features.AUDIT_ORDER)


@query
def training_mart(d: Domain) -> DataFrame:
    return rounded(features.training_mart(d))


@query
def live_features(d: Domain) -> DataFrame:
    return rounded(features.live_features(d, d.data_end))


# -- serving -----------------------------------------------------------------------------


@query
def closing_price_365(d: Domain) -> DataFrame:
    return rounded(serving.daily_measure(d.prices(), d.companies(), "close"))


@query
def volume_365(d: Domain) -> DataFrame:
    return serving.daily_measure(d.prices(), d.companies(), "volume")


@query
def sell_share_daily(d: Domain) -> DataFrame:
    return serving.daily_shares(d.prices(), d.companies(), "sell")


@query
def sell_share_monthly(d: Domain) -> DataFrame:
    return serving.monthly_shares(d.prices(), d.companies(), "sell")


@query
def buy_share_monthly(d: Domain) -> DataFrame:
    return serving.monthly_shares(d.prices(), d.companies(), "buy")


@query
def news_ratio_company(d: Domain) -> DataFrame:
    return serving.company_news(d, d.data_end)


@query
def news_ratio_cohort(d: Domain) -> DataFrame:
    return serving.cohort_news(d)


@query
def chart_series(d: Domain) -> DataFrame:
    points = serving.daily_measure(d.prices(), d.companies(), "volume").withColumn("volume", F.col("volume").cast("bigint"))
    return serving.chart_series(points, "code", "date", "volume")


@query
def finance_4y(d: Domain) -> DataFrame:
    return serving.statements(d.finance(), d.companies())


@query
def audit_latest3(d: Domain) -> DataFrame:
    return serving.latest_audits(d.audits(), d.companies(), features.AUDIT_ORDER)


# -- shaping -----------------------------------------------------------------------------


@query
def stock_unpivot_pivot(d: Domain) -> DataFrame:
    """Long facts to the vendor's form (dates as columns) and back to one row per day."""
    long = d.prices_long()
    vendor = long.groupBy("code", "item").pivot("date").agg(F.max("value"))
    daily = reshape.vendor_to_daily(vendor, ["code", "item"], "item", ITEMS)
    present = [F.col(c).isNotNull() for c in ITEMS.values()]
    return daily.where(F.array_contains(F.array(*present), True))


@query
def fk_filter(d: Domain) -> DataFrame:
    """Prices of companies that are in the list of delisted ones."""
    gone = d.companies().where("delisted_check")
    return rounded(reshape.known_keys_only(d.prices(), gone, "code").select("code", "date", "close", "volume"))


@query
def filing_select(d: Domain) -> DataFrame:
    return audit.select_filings(d.filings(), d.companies(), f"{VIEWER}?rcpNo=")


@query
def lookback_windows(d: Domain) -> DataFrame:
    whole = A.lookback_years(d.companies(), d.data_end).withColumn("slice", F.lit(0))
    return whole.unionByName(A.lookback_slices(d.companies(), d.data_end))


@query
def articles_in_window(d: Domain) -> DataFrame:
    return A.in_window(d.links(), d.articles(), A.lookback_years(d.companies(), d.data_end))


@query
def article_tags(d: Domain) -> DataFrame:
    tagged = A.article_tags(d.articles().select("url"), d.links())
    return tagged.select("url", F.size("tags").alias("n_tags"), F.array_join(F.col("tags").cast("array<string>"), ",").alias("tags"))


@query
def article_tags_json(d: Domain) -> DataFrame:
    return A.tags_as_json(A.article_tags(d.articles(), d.links()))


@query
def array_membership(d: Domain) -> DataFrame:
    """Articles tagged with the first company of the list."""
    first = d.companies().select(F.min("code")).scalar()
    return A.tagged_with(d.articles(), d.links(), first).select("url", "published_date")


@query
def pending_urls(d: Domain) -> DataFrame:
    """Linked articles whose order is not finished."""
    done = d.raw("orders").where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("url"))
    return A.pending(d.links(), done, "url")


@query
def article_bodies(d: Domain) -> DataFrame:
    """Article list merged with fetched bodies on their common column, incomplete rows dropped."""
    listed = d.articles()
    bodies = d.raw("documents").select(F.col("doc_id").alias("url"), F.col("n_chars"), F.md5("text").alias("body_md5"))
    return A.merge_on_common(listed, bodies)


@query
def union_sources(d: Domain) -> DataFrame:
    """Three article lists with different headers under one schema."""
    docs = d.raw("documents").select(F.col("doc_id").alias("article_id"), F.col("lang").alias("press"), F.col("n_chars").alias("size"))
    pages = d.raw("pages").select(F.col("page_id").alias("no"), F.lit("web").alias("journal"), F.length("html").cast("bigint").alias("len"))
    talks = d.raw("conversations").select(F.col("conv_id").alias("key"), F.col("role").alias("source"), F.length("text").cast("bigint").alias("chars"))
    return A.union_sources(
        [
            (docs, {"article_id": "url", "press": "news_comp", "size": "n_chars"}),
            (pages, {"no": "url", "journal": "news_comp", "len": "n_chars"}),
            (talks, {"key": "url", "source": "news_comp", "chars": "n_chars"}),
        ],
        ["url", "news_comp", "n_chars"],
    )


@query
def split_halves(d: Domain) -> DataFrame:
    return A.halves(d.raw("orders").select("o_orderkey"), "o_orderkey")


@query
def dq_report(d: Domain) -> DataFrame:
    """Keys, references, NULLs and sizes of three tables: four scans, one grouping per shared key."""
    links = d.links()
    by_url = quality.key_report(
        quality.Checked("articles", d.articles(), "url", nulls=["related"]), quality.Checked("links", links, "url"),
        unique=["articles", "links"], orphans=[("articles", "links")], sizes=["links"],
    )
    by_code = quality.key_report(
        quality.Checked("companies", d.companies(), "code", nulls=["delisted_date"], labels=["bankruptcy"]),
        quality.Checked("links", links, "code"), unique=["companies"], orphans=[("links", "companies")], sizes=["companies"],
    )
    return by_url.unionByName(by_code)


@query
def csv_round_trip(d: Domain) -> DataFrame:
    """Orders written as CSV parts of bounded length and read back with typed keys."""
    orders = d.raw("orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    target = f"{shared_dir(d.spark)}/csv-{uuid.uuid4().hex}"
    files.split_csv(orders, target)
    return files.scan_csv(d.spark, target, {"o_orderkey": LongType(), "o_orderstatus": StringType()})


def _target(d: Domain, kind: str) -> str:
    return f"{shared_dir(d.spark)}/{kind}-{uuid.uuid4().hex}"


@query
def bulk_load_and_append(d: Domain) -> DataFrame:
    """Orders loaded as a table partitioned by status, in two goes: open ones first, the rest appended."""
    orders = d.raw("orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    target = _target(d, "table")
    files.load_table(orders.where("o_orderstatus = 'O'"), target)
    files.append_table(orders.where("o_orderstatus <> 'O'"), target)
    return d.spark.read.schema(orders.schema).parquet(target)


@query
def merge_upsert(d: Domain) -> DataFrame:
    """Orders until 1995 stored by key; those since 1995 merged in: 1995's get new values, later ones are added."""
    orders = d.raw("orders").select("o_orderkey", "o_orderdate", "o_orderstatus", "o_totalprice")
    target = _target(d, "merged")
    keyed.store(orders.where("o_orderdate < '1996-01-01'"), target, "o_orderkey")
    changes = orders.where("o_orderdate >= '1995-01-01'").withColumns({"o_orderstatus": F.lit("N"), "o_totalprice": F.col("o_totalprice") * 2})
    keyed.merge(d.spark, target, "o_orderkey", changes)
    return keyed.read(d.spark, target)


@query
def added_column(d: Domain) -> DataFrame:
    """A stored customer table gets a column: the orders of each customer; those without any stay NULL."""
    target = _target(d, "widened")
    keyed.store(d.raw("customer").select("c_custkey", "c_name"), target, "c_custkey")
    counts = d.raw("orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").alias("n_orders"))
    keyed.merge(d.spark, target, "c_custkey", counts, insert=False)
    return keyed.read(d.spark, target)


@query
def csv_export(d: Domain) -> DataFrame:
    """Customers exported as CSV and then more of them appended, read back with typed keys."""
    customers = d.raw("customer").select("c_custkey", "c_name", "c_acctbal")
    target = _target(d, "csv")
    files.export_csv(customers.where("c_custkey % 2 = 0"), target)
    files.export_csv(customers.where("c_custkey % 2 = 1"), target, mode="append")
    return files.scan_csv(d.spark, target, {"c_custkey": LongType(), "c_name": StringType()})


@query
def relabel_units(d: Domain) -> DataFrame:
    """Order sums per customer under given names, percent signs written as p."""
    sums = d.raw("orders").groupBy("o_custkey").agg(F.count("*").alias("a"), F.sum(F.when(F.col("o_orderstatus") == "O", 1).otherwise(0)).alias("b"))
    shares = sums.select("o_custkey", "a", F.round(F.col("b") * 100.0 / F.col("a"), 6))
    return reshape.ascii_units(reshape.relabel(shares, ["code", "orders", "open%"]))


@query
def missing_marks(d: Domain) -> DataFrame:
    """Toxicity marks of all documents as booleans: 0 and missing are False."""
    docs = d.raw("documents").select("doc_id").join(d.raw("labels").select("doc_id", "toxic"), "doc_id", "left")
    return files.fill_missing_bool(docs, ["toxic"])


# -- relational basics -------------------------------------------------------------------


@query
def month_group(d: Domain) -> DataFrame:
    day = F.col("published_date")
    return (
        d.articles()
        .groupBy(F.trunc(day, "month").alias("month"))
        .agg(
            F.count("*").alias("n_all"),
            F.count_if(F.col("related")).alias("n_related"),
            F.count_if(F.col("related").isNull()).alias("n_unknown"),
        )
        .withColumn("label", F.date_format("month", "yyyy-MM"))
    )


@query
def latest_n_per_key(d: Domain) -> DataFrame:
    """Three newest reports per company with the salted ranking."""
    order = [F.desc_nulls_last("report_date"), F.asc("order_key"), F.asc("line_number")]
    return ranking.latest_n_skewed(d.audits(), ["code"], order, 3)


@query
def anti_join_keys(d: Domain) -> DataFrame:
    """Documents without a label."""
    return A.pending(d.raw("documents"), d.raw("labels"), "doc_id")


@query
def distinct_count(d: Domain) -> DataFrame:
    """Links with and without duplicates."""
    links = d.links()
    total = links.agg(F.count("*").alias("n_links"), F.countDistinct("url").alias("n_urls"), F.countDistinct("code").alias("n_codes"))
    pairs = links.distinct().agg(F.count("*"))
    return total.withColumn("n_pairs", pairs.scalar())


@query
def left_join_null_semantics(d: Domain) -> DataFrame:
    """Articles per company for all companies; none gives zero, an unknown flag counts only in the total."""
    counts = (
        d.links().distinct().join(d.articles(), "url").groupBy("code").agg(
            F.count("*").alias("n_all"), F.sum(F.when(F.col("related"), 1).otherwise(0)).alias("n_related")
        )
    )
    joined = d.companies().select("code").join(counts, "code", "left")
    n_all, n_related = F.coalesce("n_all", F.lit(0)), F.coalesce("n_related", F.lit(0))
    return joined.select(
        "code",
        n_all.alias("n_all"),
        n_related.alias("n_related"),
        F.round(F.coalesce(F.try_divide(n_related, n_all), F.lit(0.0)), 6).alias("ratio"),
    )


@query
def class_share(d: Domain) -> DataFrame:
    return rounded(quality.class_share(d.companies(), "bankruptcy"))


# -- text --------------------------------------------------------------------------------


@query
def text_cleanse(d: Domain) -> DataFrame:
    return d.raw("documents").select("doc_id", T.cleanse(F.col("text")).alias("text"))


@query
def press_cleanse(d: Domain) -> DataFrame:
    return d.raw("pages").select("page_id", T.cleanse_press(F.col("html"), [*T.PRESS_MARKS, "###", "***"]).alias("body"))


@query
def keyword_flag(d: Domain) -> DataFrame:
    docs = d.raw("documents").select("doc_id", "text")
    flagged = A.flag_articles(docs, "text", DOC_TERMS)
    fixed = T.contains_any(F.col("text"), T.DISTRESS_TERMS)
    return flagged.select("doc_id", "related", fixed.alias("related_fixed_terms"))


@query
def going_concern_flag(d: Domain) -> DataFrame:
    doubt = T.going_concern(F.col("text"), DOC_SUBJECT, DOC_DOUBTS)
    return d.raw("documents").select("doc_id", doubt.alias("n_opinion"), T.going_concern(F.col("text")).alias("n_opinion_fixed_terms"))


@query
def tokenize(d: Domain) -> DataFrame:
    tokens = terms.tokenize(d.raw("documents"), "text", "tokens")
    return tokens.select("doc_id", F.size("tokens").alias("n_tokens"), F.array_join("tokens", " ").alias("tokens"))


@query
def similar_terms(d: Domain) -> DataFrame:
    """Nearest 30 vectors of the first one by cosine."""
    vectors = d.raw("embeddings").select("vec_id", "embedding")
    return rounded(terms.nearest_by_cosine(vectors, "vec_id", "embedding", F.lit(0)), 5)


@query
def html_extract(d: Domain) -> DataFrame:
    page = H.visible(F.col("html"))
    paragraphs = H.element_texts(F.col("page"), "p")
    return (
        d.raw("pages")
        .select("page_id", page.alias("page"))
        .select(
            "page_id",
            H.first_element(F.col("page"), "title").alias("title"),
            H.first_element(F.col("page"), "h1").alias("headline"),
            F.array_join(H.attribute_values(F.col("page"), "a", "href"), " ").alias("links"),
            F.array_join(paragraphs, "\n").alias("body"),
        )
    )


@query
def body_by_selector(d: Domain) -> DataFrame:
    """Article body and advertisement of a page, each the text of a whole element."""
    pages = d.raw("pages").select("page_id", H.visible(F.col("html")).alias("page"))
    return pages.select("page_id", H.selected_text(F.col("page"), "article").alias("body"), H.selected_text(F.col("page"), "div", "class", "ad").alias("ad"))


@query
def article_list_extract(d: Domain) -> DataFrame:
    """Entries of the lists of a page: title and link, by position."""
    entries = d.raw("pages").select("page_id", F.posexplode(H.list_entries(H.visible(F.col("html")))).alias("position", "entry"))
    return entries.select("page_id", "position", "entry.title", "entry.link")


@query
def link_rebuild(d: Domain) -> DataFrame:
    """Viewer links from the scripts of filing pages; one page per filing."""
    number = F.col("rcp_no")
    call = F.concat(
        F.lit("var t = ({ text: '정관', click: viewDoc('0', '0', '0', '0', '0', 'x') });\n\tvar t = ({ text: \"감사보고서\",\n\tclick: function() { viewDoc('"),
        number, F.lit("', '"), F.substring(number, 9, 12), F.lit("', '"), F.substring(number, 21, 1),
        F.lit("', '"), F.col("rcp_dt"), F.lit("', '"), F.col("code").cast("string"), F.lit("', 'dart3.xsd'); } });"),
    )
    pages = d.filings().select("rcp_no", call.alias("html"))
    return pages.select("rcp_no", H.viewer_link(F.col("html"), VIEWER, VIEWER_ARGS, "viewDoc", "감사보고서").alias("url"))
