"""Stored tables that are changed by key: replaced, merged into, widened by columns.

Rows lie in folders by a hash of their key, so a key never moves between folders and a merge
rewrites only the folders that its changes fall into.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbline.session import discard, written

#: Folder column, and folders a table has unless told otherwise.
FOLDER, FOLDERS = "_folder", 64


def _folder(key: str, folders: int) -> Column:
    return F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(folders)).cast("int")


def _write(df: DataFrame, target: str, mode: str) -> None:
    df.repartition(FOLDER).write.partitionBy(FOLDER).mode("overwrite").option("partitionOverwriteMode", mode).parquet(target)


def store(df: DataFrame, target: str, key: str, folders: int = FOLDERS) -> None:
    """Write ``df`` as a keyed table, replacing what was there."""
    _write(df.withColumn(FOLDER, _folder(key, folders)), target, "static")


def read(spark: SparkSession, target: str) -> DataFrame:
    """The table with all columns that any of its files has; NULL where a row was written before its column."""
    return spark.read.option("mergeSchema", True).parquet(target).drop(FOLDER)


def merge(spark: SparkSession, target: str, key: str, changes: DataFrame, insert: bool = True, folders: int = FOLDERS) -> None:
    """Rows of ``changes`` (one per key) update the stored rows of their key; others are added if ``insert``.

    Only the columns that ``changes`` has are set, to NULL as well; those that the table lacks are added to
    it.  Changes without a key are left out.  ``folders`` must be what the table was stored with.  The new
    folders are written aside before they replace the old ones, and a merge that is run again gives
    the same table.
    """
    new = written(changes.where(F.col(key).isNotNull()).withColumn(FOLDER, _folder(key, folders)))
    if new.groupBy(key).count().where("count > 1").limit(1).count():
        discard(new)
        raise ValueError(f"changes repeat a {key}")
    touched = [r[0] for r in new.select(FOLDER).distinct().collect()]  # at most ``folders``
    old = spark.read.option("mergeSchema", True).parquet(target).where(F.col(FOLDER).isin(touched))
    names = [c for c in old.columns if c != FOLDER] + [c for c in new.columns if c not in old.columns]
    a, b = old.withColumn("_old", F.lit(True)).alias("a"), new.withColumn("_new", F.lit(True)).alias("b")
    # The folder is part of the condition, so both sides keep to the folders touched.
    both = a.join(b, (F.col(f"a.{FOLDER}") == F.col(f"b.{FOLDER}")) & (F.col(f"a.{key}") == F.col(f"b.{key}")), "full" if insert else "left")

    def value(name: str) -> Column:
        if name not in new.columns:
            return F.col(f"a.{name}")
        if name not in old.columns:
            return F.col(f"b.{name}")
        return F.when(F.col("_new"), F.col(f"b.{name}")).otherwise(F.col(f"a.{name}"))

    folder = F.coalesce(f"a.{FOLDER}", f"b.{FOLDER}").alias(FOLDER)
    merged = written(both.select(*[value(n).alias(n) for n in names], folder))
    _write(merged, target, "dynamic")
    discard(new, merged)
