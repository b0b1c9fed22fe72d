"""Date helpers over the canonical ``date_key`` text (``yyyy-MM-dd``)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the only accepted date text layout.
DATE_PATTERN = "yyyy-MM-dd"
DATE_SHAPE = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"


def parse_date(col: str | Column) -> Column:
    """DATE for well-formed text, NULL otherwise (never an error under ANSI)."""
    c = F.col(col) if isinstance(col, str) else col
    # of this shape the cast accepts what the pattern does, at a fraction of the time; $ would let a line end follow
    return F.when((F.length(c) == len(DATE_PATTERN)) & c.rlike(DATE_SHAPE), c.try_cast("date"))


def valid_date(col: str | Column) -> Column:
    return parse_date(col).isNotNull()


def bill_month(col: str | Column = "date_key") -> Column:
    """``yyyy-MM`` partition value of a canonical date key."""
    c = F.col(col) if isinstance(col, str) else col
    return F.substring(c, 1, 7)


def year_bounds(year: int | str) -> tuple[str, str]:
    """Inclusive ``date_key`` range of one calendar year (text order equals date order)."""
    y = int(year)
    return f"{y:04d}-01-01", f"{y:04d}-12-31"


def month_bounds(year: int | str) -> tuple[str, str]:
    y = int(year)
    return f"{y:04d}-01", f"{y:04d}-12"
