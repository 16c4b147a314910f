"""Article links: windows, tags, pending work, source union."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbline.functions import text as T
from ebbline.operators import bloom
from ebbline.operators.quality import complete_rows
from ebbline.operators.ranking import before_cut, hash_cut, hashed, salted_join
from ebbline.session import written

# Look-back of a company's news search.
LOOKBACK_YEARS = 3
SLICE_DAYS = 183
SLICES = 6


def _window_end(data_end: Column) -> Column:
    return F.coalesce(F.col("delisted_date"), data_end)


def lookback_years(companies: DataFrame, data_end: Column) -> DataFrame:
    """(code, start, end): three calendar years up to delisting or the end of the data."""
    end = _window_end(data_end)
    return companies.select(
        "code", F.add_months(end, -12 * LOOKBACK_YEARS).alias("start_date"), end.alias("end_date")
    )


def lookback_slices(companies: DataFrame, data_end: Column) -> DataFrame:
    """(code, slice, start, end): six half-year slices, newest first."""
    sliced = companies.select("code", _window_end(data_end).alias("_end"), F.explode(F.sequence(F.lit(1), F.lit(SLICES))).alias("slice"))
    return sliced.select(
        "code",
        "slice",
        F.date_sub("_end", F.col("slice") * SLICE_DAYS - 1).alias("start_date"),
        F.date_sub("_end", (F.col("slice") - 1) * SLICE_DAYS).alias("end_date"),
    )


def in_window(links: DataFrame, articles: DataFrame, windows: DataFrame) -> DataFrame:
    """Distinct company articles published inside the company's window."""
    dated = links.select("code", "url").distinct().join(articles.select("url", "published_date"), "url")
    inside = F.col("published_date").between(F.col("start_date"), F.col("end_date"))
    # Salted: one company may be linked with a third of all articles.
    return salted_join(dated, windows, ["code"], ["url"]).where(inside).select("code", "url", "published_date")


def article_tags(articles: DataFrame, links: DataFrame) -> DataFrame:
    """Articles with the sorted array of their company codes; no company gives an empty array.

    Links are made distinct first, so an array never holds more entries than there are
    companies and a hot article is spread over the distinct step by (url, code).
    """
    tags = links.select("url", "code").distinct().groupBy("url").agg(F.sort_array(F.collect_list("code")).alias("tags"))
    empty = F.array().cast(dict(tags.dtypes)["tags"])
    return articles.join(tags, "url", "left").withColumn("tags", F.coalesce("tags", empty))


def tags_as_json(tagged: DataFrame) -> DataFrame:
    return tagged.withColumn("tags", F.to_json("tags"))


def with_tag(tagged: DataFrame, code: Column) -> DataFrame:
    """Articles that carry one tag."""
    return tagged.where(F.array_contains("tags", code))


def tagged_with(articles: DataFrame, links: DataFrame, code: Column) -> DataFrame:
    """Articles linked to one company; its links are filtered before any tag list is built."""
    return articles.join(links.where(F.col("code") == code).select("url"), "url", "left_semi")


def pending(wanted: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Distinct non-null keys that are wanted but not done.

    Wanted keys that the done ones' Bloom filter does not hold are pending at once.  The others' filter is
    probed by the done keys, so of a long history only what may matter is shuffled for the anti join.
    """
    keys, past = wanted.select(key).where(F.col(key).isNotNull()).distinct(), done.select(key)
    n_words = bloom.words_for(past.count())
    held = written(bloom.probed(keys, key, bloom.key_filter(past, key, n_words), n_words, "_maybe"))
    maybe = held.where("_maybe").select(key)
    n_words = bloom.words_for(maybe.count())
    hits = bloom.probed(past, key, bloom.key_filter(maybe, key, n_words), n_words, "_maybe").where("_maybe")
    return held.where("NOT _maybe").select(key).unionByName(maybe.join(hits.select(key), key, "left_anti"))


def merge_on_common(left: DataFrame, right: DataFrame) -> DataFrame:
    """Inner join on all common columns, rows with any NULL dropped."""
    common = [c for c in left.columns if c in right.columns]
    return complete_rows(left.join(right, common))


def union_sources(sources: Sequence[tuple[DataFrame, Mapping[str, str]]], columns: Sequence[str]) -> DataFrame:
    """Union of frames with differing headers; each mapping is ``{source name: common name}``."""
    frames = [df.withColumnsRenamed(dict(names)).select(*columns) for df, names in sources]
    return reduce(DataFrame.unionByName, frames)


def halves(df: DataFrame, key: str) -> DataFrame:
    """Label rows 1 or 2: the first half plus one row, and the rest, in hash order of a unique key."""
    whole = hashed(df, key).withColumn("_all", F.lit(1))
    take = F.floor(F.col("_total") / 2) + 1
    cut = hash_cut(whole, ["_all"], key, F.least(take, F.col("_total"))).select("cut").scalar()
    part = F.when(before_cut(key), F.lit(1)).otherwise(F.lit(2))
    return whole.withColumn("cut", cut).withColumn("part", part).drop("_all", "_h", "cut")


def flag_articles(articles: DataFrame, body: str, terms: Sequence[str] = T.DISTRESS_TERMS) -> DataFrame:
    """Cleaned body and the default-news flag."""
    cleaned = articles.withColumn(body, T.cleanse(F.col(body)))
    return cleaned.withColumn("related", T.contains_any(F.col(body), terms))
