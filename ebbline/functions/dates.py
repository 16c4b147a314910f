"""Calendar expressions for point-in-time features."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# A report is public 90 days after its closing month, a monthly series one
# month and one week after the month starts.
FILING_LAG_DAYS = 90
SERIES_LAG_DAYS = 7


def filing_deadline(fiscal_year: Column, closing_month: Column) -> Column:
    """Day on which the statement of a fiscal year is certainly public."""
    return F.date_add(F.last_day(F.make_date(fiscal_year, closing_month, F.lit(1))), FILING_LAG_DAYS)


def month_start(day: Column) -> Column:
    return F.trunc(day, "month")


def month_label(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM")


def newest_public_month(as_of: Column, rule: str) -> Column:
    """First day of the newest month whose series value is public on ``as_of``.

    ``rule="train"``: month M is public on the 8th of M+1.  ``rule="live"``: on the 1st of
    M+1.  Because the lag is a whole month plus a constant, the k-th value back is simply the
    month ``k - 1`` months before this one, so no range join is needed.
    """
    if rule == "train":
        return F.add_months(month_start(F.date_sub(as_of, SERIES_LAG_DAYS)), -1)
    if rule == "live":
        return F.add_months(month_start(as_of), -1)
    raise ValueError(f"unknown publication rule: {rule}")


def is_weekday(day: Column) -> Column:
    return F.weekday(day) < 5
