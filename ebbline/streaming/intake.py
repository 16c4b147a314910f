"""Intake of crawled article lists that resumes where it stopped.

Crawlers append CSV files; each run takes the files it has not seen (the checkpoint remembers
them) and adds only articles that are not stored yet.  A batch writes its own folder and
replaces it when repeated, so a restart neither loses nor doubles articles.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

LINKS = T.StructType(
    [
        T.StructField("news_comp", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("code", T.StringType()),
        T.StructField("published_date", T.StringType()),
        T.StructField("title", T.StringType()),
        T.StructField("url", T.StringType()),
    ]
)


def read_crawl(spark: SparkSession, folder: str, schema: T.StructType = LINKS) -> DataFrame:
    return spark.readStream.schema(schema).option("header", True).option("escape", '"').csv(folder)


def stored(spark: SparkSession, target: str) -> DataFrame:
    """Articles stored so far, with the batch that brought them."""
    return spark.read.parquet(target)


def take_new(links: DataFrame, target: str, checkpoint: str, keys: tuple[str, ...] = ("code", "url")) -> StreamingQuery:
    """Store links not stored before; ends when all present files are taken."""

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        fresh = batch.where(F.col("url").isNotNull()).dropDuplicates(list(keys))
        if batch_id > 0:
            earlier = stored(spark, target).where(F.col("batch_id") < batch_id)
            fresh = fresh.join(earlier.select(*keys), list(keys), "left_anti")
        fresh.write.mode("overwrite").parquet(f"{target}/batch_id={batch_id}")

    return links.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
