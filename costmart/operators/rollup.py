"""Daily rollup of the fact: the reports' aggregate table.

Every report sums costs and counts line items by dimension keys, dates and tags. The rollup keeps
exactly those partial sums per (date, provider, service, account, region, team tag, environment
tag), so every report gives the same result from it as from the fact (decimal partial sums add
exactly), while reading a table whose size is bounded by key combinations per day rather than by
line items. At 100 TB of line items the reports then scan gigabytes, not terabytes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pyspark.sql.types import DecimalType, DoubleType, LongType, StringType, StructField, StructType

from costmart.functions.keys import account_key, region_key, service_key
from costmart.functions.money import limb_sums, with_limbs

ROLLUP_KEYS = ["date_key", "cloud_provider", "service_key", "account_key", "region_key", "tag_team",
               "tag_environment"]
ROLLUP_MEASURES = ["cost_sum", "cost_rest", "gross_sum", "gross_rest", "credit_sum", "credit_rest", "line_items",
                   "credit_items"]

#: What the keys of all dimensions are made of, and the tags.
LINE_KEYS = ["date_key", "cloud_provider", "service_name", "region_code", "account_id", "account_name", "team", "environment"]

_MEASURE_TYPES = {"sum": DecimalType(38, 16), "rest": DoubleType(), "items": LongType()}
#: The stored form, whose partial sums may come in more than one row per key.
ROLLUP_SCHEMA = StructType([*[StructField(k, StringType()) for k in ROLLUP_KEYS],
                            *[StructField(m, _MEASURE_TYPES[m.rsplit("_")[-1]]) for m in ROLLUP_MEASURES], StructField("bill_month", StringType())])


def is_rollup(df: DataFrame) -> bool:
    return "cost_sum" in df.columns


def _measures() -> list[Column]:
    c = F.col("cost_usd")
    return [
        *limb_sums("cost_sum", "cost_rest"),
        *limb_sums("gross_sum", "gross_rest", c > 0),
        *limb_sums("credit_sum", "credit_rest", c < 0),
        F.count(F.lit(1)).alias("line_items"),
        F.count_if(c < 0).alias("credit_items"),
    ]


def daily_rollup(fact: DataFrame) -> DataFrame:
    """One aggregate (map-side combine, so a hot key costs one row per task in the shuffle)."""
    keys = [F.col(k) for k in ROLLUP_KEYS[:5]] + [F.col("tags")["team"].alias("tag_team"),
                                                  F.col("tags")["environment"].alias("tag_environment")]
    if "bill_month" in fact.columns:
        keys.append(F.col("bill_month"))
    return with_limbs(fact).groupBy(*keys).agg(*_measures())


def line_sums(rows: DataFrame) -> DataFrame:
    """The rollup's measures of canonical rows by what the dimension keys are made of: the rollup's rows (``rollup_of_sums``) and the
    natural keys of all dimensions come from it, so that neither goes through the rows, nor makes keys of each."""
    return with_limbs(rows).groupBy(*LINE_KEYS).agg(*_measures())


def rollup_of_sums(sums: DataFrame) -> DataFrame:
    """``daily_rollup`` of ``line_sums``. An account that has two names in a day has a row for each, which readers add up."""
    return sums.select("date_key", "cloud_provider", service_key().alias("service_key"), account_key().alias("account_key"),
                       region_key().alias("region_key"), F.col("team").alias("tag_team"), F.col("environment").alias("tag_environment"),
                       *ROLLUP_MEASURES)
