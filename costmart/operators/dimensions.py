"""The four dimensions, derived from canonical line items.

Each builder starts with a grouping on the dimension's natural key. Spark aggregates map side
first, so the shuffle carries at most (distinct keys x map tasks) rows whatever the input size
or skew. The two enrichments join an inline lookup of fixed size (28 and 17 rows), which is
the only thing broadcast explicitly.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from costmart.functions.dates import parse_date
from costmart.functions.keys import account_key, region_key, service_key
from costmart.functions.lookups import (
    DEFAULT_GEOGRAPHY,
    DEFAULT_REGION_NAME,
    DEFAULT_SERVICE_CATEGORY,
    region_meta_lookup,
    service_category_lookup,
)
from costmart.schemas import (
    DIM_ACCOUNT_SCHEMA,
    DIM_DATE_SCHEMA,
    DIM_REGION_SCHEMA,
    DIM_SERVICE_SCHEMA,
    assert_schema,
)


def date_attributes(dates: DataFrame) -> DataFrame:
    """Calendar columns for a frame of distinct ``date_key`` text values."""
    d = parse_date("date_key")
    out = dates.select(
        "date_key",
        F.year(d).cast("string").alias("year"),
        F.lpad(F.month(d).cast("string"), 2, "0").alias("month"),
        F.lpad(F.dayofmonth(d).cast("string"), 2, "0").alias("day"),
        F.concat(F.lit("Q"), F.quarter(d).cast("string")).alias("quarter"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.date_format(d, "EEEE").alias("day_of_week"),
        # dayofweek: 1 = Sunday ... 7 = Saturday
        F.when(F.dayofweek(d).isin(1, 7), F.lit("true")).otherwise(F.lit("false")).alias("is_weekend"),
    )
    return assert_schema(out, DIM_DATE_SCHEMA)


def _service_rows(pairs: DataFrame) -> DataFrame:
    """dim_service rows from distinct (cloud_provider, service_name) pairs."""
    categories = F.broadcast(service_category_lookup(pairs.sparkSession))
    out = (pairs.join(categories, on="service_name", how="left")
           .select(service_key().alias("service_key"), "cloud_provider", "service_name",
                   F.coalesce("service_category", F.lit(DEFAULT_SERVICE_CATEGORY)).alias("service_category")))
    return assert_schema(out, DIM_SERVICE_SCHEMA)


def _region_rows(pairs: DataFrame) -> DataFrame:
    """dim_region rows from distinct (cloud_provider, region_code) pairs."""
    meta = F.broadcast(region_meta_lookup(pairs.sparkSession))
    out = (pairs.join(meta, on="region_code", how="left")
           .select(region_key().alias("region_key"), "cloud_provider", "region_code",
                   F.coalesce("region_name", F.lit(DEFAULT_REGION_NAME)).alias("region_name"),
                   F.coalesce("geography", F.lit(DEFAULT_GEOGRAPHY)).alias("geography")))
    return assert_schema(out, DIM_REGION_SCHEMA)


def _account_rows(variants: DataFrame, keep_last_seen: bool = False) -> DataFrame:
    """dim_account rows from attribute variants with their ``last_seen`` date: per account the
    latest variant, ties broken by the larger value (a small aggregate). ``keep_last_seen`` adds
    the date of that variant (the stored form uses it to merge loads by data date)."""
    latest = (variants.groupBy("cloud_provider", "account_id")
              .agg(F.max(F.struct("last_seen", "account_name", "team", "environment")).alias("v")))
    out = latest.select(account_key().alias("account_key"), "cloud_provider", "account_id",
                        F.col("v.account_name").alias("account_name"), F.col("v.team").alias("team"),
                        F.col("v.environment").alias("environment"),
                        *([F.col("v.last_seen").alias("last_seen")] if keep_last_seen else []))
    if keep_last_seen:
        assert_schema(out.drop("last_seen"), DIM_ACCOUNT_SCHEMA)
        return out
    return assert_schema(out, DIM_ACCOUNT_SCHEMA)


def build_dim_date(combined: DataFrame) -> DataFrame:
    return date_attributes(combined.select("date_key").distinct())


def build_dim_service(combined: DataFrame) -> DataFrame:
    return _service_rows(combined.select("cloud_provider", "service_name").distinct())


def build_dim_account(combined: DataFrame, keep_last_seen: bool = False) -> DataFrame:
    """One row per (provider, account_id).

    Names, teams and environments can drift over time; the row keeps the attributes seen on the
    latest ``date_key`` (ties broken by the larger value), so joining the fact to this dimension
    never multiplies rows. Step 1 is a hash aggregate on the full data that keeps one row per
    attribute variant; step 2 picks the latest variant on that small result.
    """
    variants = (combined.groupBy("cloud_provider", "account_id", "account_name", "team", "environment")
                .agg(F.max(F.col("date_key").cast("date")).alias("last_seen")))
    return _account_rows(variants, keep_last_seen)


def build_dim_region(combined: DataFrame) -> DataFrame:
    return _region_rows(combined.select("cloud_provider", "region_code").distinct())


def build_dimensions(combined: DataFrame) -> dict[str, DataFrame]:
    """The four dimensions, each with its own aggregate over ``combined`` (lazy)."""
    return {
        "dim_date": build_dim_date(combined),
        "dim_service": build_dim_service(combined),
        "dim_account": build_dim_account(combined),
        "dim_region": build_dim_region(combined),
    }


_KEY_COLUMNS = ["date_key", "cloud_provider", "service_name", "region_code", "account_id",
                "account_name", "team", "environment"]
_KEY_SETS = {
    "dim_date": ["date_key"],
    "dim_service": ["cloud_provider", "service_name"],
    "dim_region": ["cloud_provider", "region_code"],
    "dim_account": ["cloud_provider", "account_id", "account_name", "team", "environment"],
}


def _grouping_id(columns: list[str]) -> int:
    """``grouping_id()`` of a grouping set: bit i (from the left) is 1 if column i is absent."""
    gid = 0
    for c in _KEY_COLUMNS:
        gid = (gid << 1) | (0 if c in columns else 1)
    return gid


def dimension_keys(combined: DataFrame, names=tuple(_KEY_SETS)) -> DataFrame:
    """Natural keys of the dimensions (all four, or ``names``) in one pass: one scan, one grouping-sets
    aggregate (partial aggregation map side), one small shuffle. ``gid`` tells the sets apart."""
    # the date is made before the rows are multiplied by the number of sets
    rows = combined.select(*_KEY_COLUMNS, F.col("date_key").cast("date").alias("_day"))
    return (rows.groupingSets([_KEY_SETS[n] for n in names], *_KEY_COLUMNS)
            .agg(F.max("_day").alias("last_seen"), F.grouping_id().alias("gid")))


def dimensions_from_keys(keys: DataFrame, keep_last_seen: bool = False) -> dict[str, DataFrame]:
    """The four dimensions from ``dimension_keys`` (small input; lazy)."""
    part = {n: keys.where(F.col("gid") == _grouping_id(cols)).select(*cols, "last_seen")
            for n, cols in _KEY_SETS.items()}
    return {
        "dim_date": date_attributes(part["dim_date"].select("date_key")),
        "dim_service": _service_rows(part["dim_service"].drop("last_seen")),
        "dim_account": _account_rows(part["dim_account"], keep_last_seen),
        "dim_region": _region_rows(part["dim_region"].drop("last_seen")),
    }
