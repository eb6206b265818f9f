"""Date parsing and year arithmetic."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def strict_date(c: Column) -> Column:
    """Date of a text; bad text fails the query under ANSI mode."""
    return F.to_date(c)


def lenient_date(c: Column) -> Column:
    """Date of a text; bad text gives null."""
    return F.try_to_date(c)


def date_or(c: Column, as_of: dt.date | str) -> Column:
    """Lenient date with null (still in office) replaced by ``as_of``."""
    return F.coalesce(lenient_date(c), F.lit(str(as_of)).cast("date"))


def tenure_years(start: Column, end: Column) -> Column:
    """Difference of the calendar years."""
    return F.year(end) - F.year(start)
