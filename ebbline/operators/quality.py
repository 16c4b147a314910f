"""Constraint checks as one report: (check, table_name, column_name, n)."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def complete_rows(df: DataFrame) -> DataFrame:
    """Rows without any NULL.

    One condition per column: a single test over all columns would be rewritten by the
    optimizer once per combination of computed columns.
    """
    return df.where(" AND ".join(f"`{c}` IS NOT NULL" for c in df.columns))


@dataclass(frozen=True)
class Checked:
    """A table, its key column, columns to count NULLs in and boolean labels to count."""

    table: str
    df: DataFrame
    key: str
    nulls: Sequence[str] = ()
    labels: Sequence[str] = ()


def key_counts(*sides: Checked) -> DataFrame:
    """One row per key value: how many rows of each table have it (``_0``, ``_1``, ...) and their counts.

    A scan per table and one grouping, summed up before the shuffle, so a hot key is one row a task.
    """
    marked = [
        s.df.select(
            F.col(s.key).alias("key"), F.lit(i).alias("side"), *[F.col(c).isNull().alias(f"_{i}_nulls_{c}") for c in s.nulls],
            *[F.col(c).alias(f"_{i}_labels_{c}") for c in s.labels],
        )
        for i, s in enumerate(sides)
    ]
    every = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), marked)
    return every.groupBy("key").agg(
        *[F.count_if(F.col("side") == i).alias(f"_{i}") for i in range(len(sides))],
        *[F.count_if(F.col(c)).alias(c) for c in every.columns if c not in ("key", "side")],
    )


def key_report(*sides: Checked, orphans: Sequence[tuple[str, str]] = (), sizes: Sequence[str] = (), unique: Sequence[str] = ()) -> DataFrame:
    """Checks of tables that share a key, from one pass over each.

    ``unique``: tables whose repeated key values (NULL is one) are counted; ``orphans``: (table, dimension)
    pairs, rows whose key the dimension lacks, NULL keys included; ``sizes``: tables whose rows and distinct
    keys (without NULL) are counted.
    """
    at = {s.table: i for i, s in enumerate(sides)}
    has = lambda t: F.col(f"_{at[t]}")
    total = lambda n: F.coalesce(F.sum(n), F.lit(0))
    rows = [("duplicate_keys", t, sides[at[t]].key, F.count_if(has(t) > 1)) for t in unique]
    for t, dim in orphans:
        lost = (has(dim) == 0) | F.col("key").isNull()
        rows.append(("orphans", t, sides[at[t]].key, total(F.when(lost, has(t)).otherwise(0))))
    for i, s in enumerate(sides):
        rows += [("nulls", s.table, c, total(f"_{i}_nulls_{c}")) for c in s.nulls]
        rows += [("positives", s.table, c, total(f"_{i}_labels_{c}")) for c in s.labels]
    for t in sizes:
        rows += [("rows", t, sides[at[t]].key, total(has(t))), ("distinct", t, sides[at[t]].key, F.count_if((has(t) > 0) & F.col("key").isNotNull()))]
    cells = [F.struct(F.lit(c).alias("check"), F.lit(t).alias("table_name"), F.lit(k).alias("column_name"), n.cast("bigint").alias("n")) for c, t, k, n in rows]
    return key_counts(*sides).agg(F.array(*cells).alias("rows")).selectExpr("inline(rows)")


def class_share(df: DataFrame, label: str) -> DataFrame:
    return df.agg(F.avg(F.col(label).cast("int")).alias("share"))
