"""Space-filling layout: rows near each other in several columns at once lie in the same files.

A sort serves filters on its first column only. Here each column's value becomes its rank among approximate quantiles of the
month (so that skew and gaps don't matter), the ranks' bits are interleaved to one number, and rows are range-partitioned by month and
that number. A file then covers a small range in every one of the columns, and Parquet's minima and maxima let a filter on any of them
skip files.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

DEFAULT_BITS = 5


def _shared_prefix(a: Column, b: Column) -> Column:
    """How many leading characters two texts share."""
    longest = F.least(F.length(a), F.length(b))
    return F.when(longest > 0, F.size(F.filter(
        F.sequence(F.lit(1), longest), lambda i: F.substring(a, F.lit(1), i) == F.substring(b, F.lit(1), i)))).otherwise(0)


def _number(name: str, text: bool) -> Column:
    """A number that keeps the column's order: of texts, the seven bytes behind the prefix that all the month's values share."""
    if not text:
        return F.col(name).cast("double")
    head = F.encode(F.substring(F.col(name), F.col(f"_skip_{name}") + 1, F.lit(7)), "UTF-8")
    return F.conv(F.rpad(F.substring(F.hex(head), 1, 14), 14, "0"), 16, 10).cast("double")


def _below(bounds: str, end: str) -> Column:
    """The bounds that are smaller than ``end``."""
    return F.filter(bounds, lambda b: b < F.col(end))


def with_z_order(rows: DataFrame, columns: tuple[str, ...], within: str = "bill_month", bits: int = DEFAULT_BITS) -> DataFrame:
    """``rows`` with ``_z``: the interleaved ranks of ``columns`` (texts or numbers; NULL ranks lowest).

    Two aggregates over ``within`` and the columns give each month's smallest and greatest values and ``2^bits - 1`` quantiles per column: a row
    per month, joined back by whatever means the planner picks.
    """
    if not columns or bits < 1 or bits * len(columns) > 62:
        raise ValueError("give one column or more, and at most 62 bits in all")
    text = {c: isinstance(rows.schema[c].dataType, StringType) for c in columns}
    ends = rows.groupBy(within).agg(*[f(c).alias(f"_{n}_{c}") for c in columns for n, f in (("min", F.min), ("max", F.max))])
    skip = ends.select(within, *[_shared_prefix(F.col(f"_min_{c}"), F.col(f"_max_{c}")).alias(f"_skip_{c}") for c in columns if text[c]])
    if not any(text.values()):
        skip = None

    def numbered(df: DataFrame) -> DataFrame:
        df = df if skip is None else df.join(skip, within)
        return df.withColumns({f"_n_{c}": _number(c, text[c]) for c in columns})

    steps = 1 << bits
    shares = F.array(*[F.lit(i / steps) for i in range(1, steps)])
    aggs = [F.percentile_approx(f"_n_{c}", shares, F.lit(20 * steps)).alias(f"_q_{c}") for c in columns]
    aggs += [F.max(f"_n_{c}").alias(f"_top_{c}") for c in columns]
    # a bound at the greatest value separates nothing
    bounds = numbered(rows.select(within, *columns)).groupBy(within).agg(*aggs).select(within, *[
        F.array_distinct(_below(f"_q_{c}", f"_top_{c}")).alias(f"_q_{c}") for c in columns])
    ranked = numbered(rows).join(bounds, within).select(*rows.columns, *[
        F.floor(F.size(_below(f"_q_{c}", f"_n_{c}")) * steps / (F.size(f"_q_{c}") + 1)).cast("long").alias(f"_r_{c}")
        for c in columns])
    k = len(columns)
    z = [F.shiftleft(F.shiftright(F.coalesce(f"_r_{c}", F.lit(0).cast("long")), i).bitwiseAND(F.lit(1).cast("long")), i * k + (k - 1 - j))
         for i in range(bits) for j, c in enumerate(columns)]
    return ranked.select(*rows.columns, reduce(lambda a, b: a.bitwiseOR(b), z).alias("_z"))


def z_ordered(rows: DataFrame, columns: tuple[str, ...], num_ranges: int, within: str = "bill_month", spread: str = "cost_id",
              bits: int = DEFAULT_BITS) -> DataFrame:
    """``rows`` in about ``num_ranges`` ranges of month and z-order, sorted for the month-partitioned write. ``spread``, hashed, cuts
    a cell that holds many rows into as many ranges as it needs."""
    return (with_z_order(rows, columns, within, bits)
            .repartitionByRange(max(1, num_ranges), within, "_z", F.xxhash64(spread))
            .sortWithinPartitions(within, "_z", *columns).drop("_z"))
