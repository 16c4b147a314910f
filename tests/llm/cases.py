"""Awkward rows for every operator: nulls, empty and very long texts, repeats, clashing columns."""

from pyspark.sql import SparkSession, DataFrame
from pyspark.sql import functions as F

LONG = "lorem ipsum dolor sit amet " * 8_000
AWKWARD = [
    (1, "the first text has some words in it", "en", "a", 35), (1, "the first text has some words in it", "en", "a", 35),
    (2, None, None, None, None), (3, "", "en", "b", 0), (None, "a text without an id but with words", None, "b", 1),
    (None, None, None, None, None), (4, LONG, "en", "a", len(LONG)), (5, " \n\t\n ", "de", None, 5), (6, "x" * 70_000, "fr", "c", 1),
    (7, "Ünïcödé 日本語 😀 ▁ text\nwith lines\n\nand more", "xx", "c", 9), (1, "another text under the same id", "en", "a", 1),
]
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def awkward(spark: SparkSession) -> DataFrame:
    """The rows above with extra columns whose names operators might use themselves."""
    docs = spark.createDataFrame(AWKWARD, SCHEMA)
    return docs.select("*", *[F.lit(i).alias(c) for i, c in enumerate(("score", "id", "key", "class", "value", "n", "row", "_n", "ids", "lines"))])


def empty(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], SCHEMA)


def documents(spark: SparkSession) -> DataFrame:
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")


def plain(spark: SparkSession, texts: list) -> DataFrame:
    return spark.createDataFrame([(i, t, "en", f"s{i % 4}", len(t or "")) for i, t in enumerate(texts)], SCHEMA)
