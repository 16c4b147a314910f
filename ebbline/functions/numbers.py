"""Null-safe arithmetic (ANSI mode raises on division by zero)."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F


def share(part: Column, *others: Column) -> Column:
    """``part / (part + others)``; NULL when the total is zero or any term is NULL."""
    return F.try_divide(part, reduce(add, others, part))


def count_where(cond: Column) -> Column:
    """Rows for which ``cond`` is true; NULL counts as false."""
    return F.count_if(F.coalesce(cond, F.lit(False)))


def hash_int(*parts: Column) -> Column:
    """32 hash bits as a bigint; the same on every engine that has md5."""
    text = F.concat_ws("|", *[p.cast("string") for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")
