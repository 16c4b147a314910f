"""CSV and columnar files: scan, bulk load, export, append, split."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql import functions as F

# Fixed value: lines per file when a link list is split for several crawlers.
SPLIT_LINES = 15_909


def _csv_reader(spark: SparkSession, multi_line: bool):
    reader = spark.read.option("header", True).option("escape", '"').option("quote", '"')
    return reader.option("multiLine", multi_line)


def header_of(spark: SparkSession, path: str) -> list[str]:
    """Column names of a CSV with header."""
    return _csv_reader(spark, False).option("inferSchema", False).csv(path).columns


def scan_csv(
    spark: SparkSession,
    path: str,
    keys: Mapping[str, T.DataType],
    columns: Sequence[str] | None = None,
    multi_line: bool = False,
) -> DataFrame:
    """CSV scan with typed key columns; every further column of the header is a double.

    Codes stay strings, so leading zeros survive.  ``columns`` prunes the scan.
    ``multi_line`` is for article bodies with line breaks.
    """
    fields = [T.StructField(c, keys.get(c, T.DoubleType())) for c in header_of(spark, path)]
    df = _csv_reader(spark, multi_line).schema(T.StructType(fields)).csv(path)
    return df.select(*columns) if columns else df


def load_table(df: DataFrame, target: str, partition_by: Sequence[str] = ()) -> None:
    """Bulk load into a columnar table folder (replaces it)."""
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(target)


def append_table(df: DataFrame, target: str) -> None:
    df.write.mode("append").parquet(target)


def export_csv(df: DataFrame, target: str, mode: str = "overwrite") -> None:
    """CSV files with a header each; ``mode="append"`` adds files to the folder."""
    df.write.mode(mode).option("header", True).option("escape", '"').csv(target)


def split_csv(df: DataFrame, target: str, lines: int = SPLIT_LINES) -> None:
    """CSV files of at most ``lines`` rows, header in each."""
    df.write.mode("overwrite").option("header", True).option("maxRecordsPerFile", lines).csv(target)


def read_database(spark: SparkSession, url: str, table: str, properties: Mapping[str, str], **partitioning) -> DataFrame:
    """Table of an external database; pass column, bounds and count to read in parallel."""
    return spark.read.jdbc(url, table, properties=dict(properties), **partitioning)


def nan_as_null(df: DataFrame) -> DataFrame:
    """NaN marks of dataframe exports become NULL."""
    floats = [c for c, t in df.dtypes if t in ("double", "float")]
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in floats})


def fill_missing_bool(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """0/1 marks as booleans: 0 and NULL are False, anything else is True."""
    return df.withColumns({c: F.coalesce(F.col(c).cast("double") != 0, F.lit(False)) for c in columns})
