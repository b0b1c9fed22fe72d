"""Exact money arithmetic without a range limit.

DOUBLE sums depend on the order rows meet, so a report could change with the partitioning; sums of wide decimals
make an object for every row. Each cost that DECIMAL(38,16) holds without loss (up to 16 decimals, below 10^13) is
therefore split into four whole numbers, its units and 6, 5 and 5 decimals, which are summed as BIGINTs in generated
code and put together to a decimal once a group. Most costs are few digits: they are split in DOUBLE and BIGINT
arithmetic alone; the others by way of a decimal. Any cost beyond (more decimals, larger, infinite, NaN) is the *rest*, summed as
DOUBLE beside it. No row is left out, and a total is exact sum + rest sum. With no such rows, which loads count and report
(``inexact_cost``), every partial sum is exact, so sums can be pre-aggregated at any level and still agree to the
cent. A group's sums of decimals have room for 9 * 10^12 rows, that of units for 9 * 10^18; beyond, Spark's ANSI arithmetic
fails rather than wraps. Results are rounded half-up and returned as DOUBLE.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MONEY = "decimal(38,16)"
EXACT_BELOW = 1e13
#: Decimals a cost is tested for, and below what amount: the product stays below 2^50, so rounding it is right.
SCALES = ((7, 1e8), (14, 10.0), (10, 1e5), (2, 1e13))


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _scaled(c: Column, decimals: int) -> Column:
    return F.rint(c * (10.0 ** decimals))


def _div(a: Column, b: int) -> Column:
    """Whole division towards zero, as ``div``."""
    return F.call_function("div", a, F.lit(b).cast("long"))


def _by_scale(c: Column, value, by_decimal: Column) -> Column:
    """``value(decimals)`` of the first scale at which the cost is the DOUBLE nearest to a number of so many decimals, else
    ``by_decimal`` if DECIMAL(38,16) holds it; NULL for none. (NaN compares above every number.)"""
    out = F
    for decimals, below in SCALES:
        out = out.when((F.abs(c) < below) & (_scaled(c, decimals) / F.lit(10.0 ** decimals) == c), value(decimals))
    return out.when((F.abs(c) < EXACT_BELOW) & (c.try_cast(MONEY).cast("double") == c), by_decimal)


def is_exact(col: str | Column) -> Column:
    """True for a cost that is summed exactly; NULL stays NULL."""
    c = _col(col)
    return F.when(c.isNotNull(), F.coalesce(_by_scale(c, lambda _: F.lit(True), F.lit(True)), F.lit(False)))


def parts(col: str | Column) -> tuple[Column, Column]:
    """Units and decimals (in units of 10^-16) of a cost, both of its sign; NULL for a cost that isn't exact."""
    c = _col(col)
    exact = c.try_cast(MONEY)
    units = _by_scale(c, lambda k: _div(_scaled(c, k).cast("long"), 10 ** k), exact.cast("long"))
    decimals = _by_scale(c, lambda k: _scaled(c, k).cast("long") % F.lit(10 ** k) * F.lit(10 ** (16 - k)),
                         ((exact % F.expr("1BD")) * F.expr("10000000000000000BD")).cast("long"))
    return units, decimals


def limbs(units: Column, decimals: Column) -> list[Column]:
    """The four numbers that are summed."""
    return [units, _div(decimals, 10 ** 10), _div(decimals, 10 ** 5) % F.lit(10 ** 5), decimals % F.lit(10 ** 5)]


def rest(col: str | Column) -> Column:
    """The cost where it is not exact."""
    c = _col(col)
    return F.when(c.isNull() | is_exact(c), F.lit(0.0)).otherwise(c)


def joined_sums(sums: list[Column]) -> Column:
    """The sums of the limbs as one decimal; 0 where there was none."""
    units, *low = (F.coalesce(s, F.lit(0).cast("long")) for s in sums)
    out = units.cast("decimal(35,16)")
    for s, weight in zip(low, ("0.000001BD", "0.00000000001BD", "0.0000000000000001BD")):
        out = out + (s.cast("decimal(19,0)") * F.expr(weight)).cast("decimal(30,16)")
    return out.cast(MONEY)


_PARTS = ("_units", "_decimals", "_rest")


def with_limbs(df: DataFrame, col: str = "cost_usd") -> DataFrame:
    """``df`` with the parts of a cost as columns, made once a row however many sums use them (``limb_sums``)."""
    return df.withColumns(dict(zip(_PARTS, [*parts(col), rest(col)])))


def limb_sums(exact: str = "s", other: str = "x", rows: Column | None = None) -> list[Column]:
    """The exact and the other sum over ``with_limbs`` rows, or over those that meet a condition."""
    def chosen(c: Column) -> Column:
        return F.sum(F.when(rows, c) if rows is not None else c)

    sums = [chosen(x) for x in limbs(F.col("_units"), F.col("_decimals"))]
    return [joined_sums(sums).alias(exact), F.coalesce(chosen(F.col("_rest")), F.lit(0.0)).alias(other)]


def money_sums(col: str | Column, exact: str = "s", other: str = "x") -> list[Column]:
    """The exact and the other sum of a cost column (combine partial sums with ``F.sum`` again)."""
    return [joined_sums([F.sum(x) for x in limbs(*parts(col))]).alias(exact), F.sum(rest(col)).alias(other)]


def total(digits: int, exact: str = "s", other: str = "x") -> Column:
    """Half-up rounded total of the two sums, as DOUBLE."""
    s, x = F.col(exact), F.col(other)
    return F.when(x == 0, F.round(s, digits).cast("double")).otherwise(F.round(s.cast("double") + x, digits))


def amount(exact: Column, other: Column) -> Column:
    """The two sums as one DOUBLE."""
    return exact.cast("double") + other


def rounded_ratio(numerator: Column, denominator: Column, digits: int) -> Column:
    """``round(num / den, digits)`` for an average or a share.

    The quotient is taken in DOUBLE (as SQL engines do for decimal division), fixed to 10 decimal
    places and then rounded half-up on that decimal, so two engines agree on the last digit; a
    quotient that is no decimal (NaN, infinite) is returned as it is. A zero denominator gives NULL,
    not an error.
    """
    q = numerator.cast("double") / F.nullif(denominator.cast("double"), F.lit(0.0))
    return F.coalesce(F.round(q.try_cast("decimal(38,10)"), digits).cast("double"), q)
