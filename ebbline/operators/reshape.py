"""Wide and long forms of vendor files, and key filters."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def dates_to_rows(wide: DataFrame, ids: Sequence[str], value: str = "value") -> DataFrame:
    """One row per id and date column; every column outside ``ids`` is named by its date."""
    days = [c for c in wide.columns if c not in ids]
    long = wide.unpivot(list(ids), [f"`{d}`" for d in days], "date", value)
    return long.withColumn("date", F.to_date("date", "yyyy-MM-dd"))


def items_to_columns(
    long: DataFrame, keys: Sequence[str], item: str, value: str, items: Mapping[str, str]
) -> DataFrame:
    """One row per key with a column per item (``items``: item text -> column name)."""
    pivoted = long.groupBy(*keys).pivot(item, list(items)).agg(F.max(value))
    return pivoted.withColumnsRenamed(dict(items))


def vendor_to_daily(wide: DataFrame, ids: Sequence[str], item: str, items: Mapping[str, str]) -> DataFrame:
    """The vendor's file (rows: company and item, columns: dates) as one row per company and day."""
    keys = [c for c in ids if c != item]
    return items_to_columns(dates_to_rows(wide, ids), [*keys, "date"], item, "value", items)


def known_keys_only(facts: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """Facts whose key is in the dimension."""
    return facts.join(dim.select(key), key, "left_semi")


def relabel(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """New column names by position."""
    return df.toDF(*names)


def ascii_units(df: DataFrame) -> DataFrame:
    """Write the percent sign of column names as ``p``."""
    return df.withColumnsRenamed({c: c.replace("%", "p") for c in df.columns if "%" in c})
