"""Raw export rows -> canonical line items.

One function serves every provider: the layout says which raw column feeds which canonical
column. Everything is a single filter + projection, so each source is one whole-stage-codegen
stage with no shuffle; the drop predicate reaches the Parquet/CSV scan as a pushed filter.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from costmart.functions.dates import valid_date
from costmart.functions.lookups import DEFAULT_ENVIRONMENT, DEFAULT_REGION, DEFAULT_TEAM
from costmart.schemas import CANONICAL_COLUMNS, CANONICAL_SCHEMA, assert_schema
from costmart.sources.billing_csv import INPUT_COLUMNS
from costmart.sources.layouts import SourceLayout


def keep_condition(layout: SourceLayout) -> Column:
    """The drop rule: every required field present and a well-formed date.

    A date that does not parse has no calendar attributes and no month; a load writes such a row,
    like any other it drops, to the quarantine and counts it (see ``operators.quality``). Costs are
    kept whatever their size or number of decimals.
    """
    present = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in layout.required])
    return present & valid_date(layout.raw("date_key"))


def canonical_columns(layout: SourceLayout) -> list[Column]:
    c = lambda name: F.col(layout.raw(name))
    region = F.regexp_replace(c("region_code"), layout.region_pattern, layout.region_replacement)
    if layout.region_plain_ends:
        region = F.when(F.substring(c("region_code"), -1, 1).isin(*layout.region_plain_ends), c("region_code")).otherwise(region)
    return [
        c("date_key").alias("date_key"),
        F.lit(layout.provider).alias("cloud_provider"),
        c("account_id").alias("account_id"),
        F.coalesce(c("account_name"), c("account_id")).alias("account_name"),
        c("service_name").alias("service_name"),
        F.coalesce(region, F.lit(DEFAULT_REGION)).alias("region_code"),
        c("usage_quantity").cast("double").alias("usage_quantity"),
        c("usage_unit").alias("usage_unit"),
        c("cost_usd").cast("double").alias("cost_usd"),
        F.coalesce(c("environment"), F.lit(DEFAULT_ENVIRONMENT)).alias("environment"),
        F.coalesce(c("team"), F.lit(DEFAULT_TEAM)).alias("team"),
        c("resource_id").alias("resource_id"),
    ]


def normalize(raw: DataFrame, layout: SourceLayout) -> DataFrame:
    """Canonical rows of one provider: drop rule, zone cut, defaults, renames.

    Credits (negative costs) are kept, so every sum over the result is net spend.
    """
    out = raw.where(keep_condition(layout)).select(*canonical_columns(layout))
    return assert_schema(out, CANONICAL_SCHEMA)


def normalize_with_files(raw: DataFrame, layout: SourceLayout) -> DataFrame:
    """``normalize``, and each row's input file where ``raw`` has it."""
    files = [c for c in INPUT_COLUMNS if c in raw.columns]
    return raw.where(keep_condition(layout)).select(*canonical_columns(layout), *files)


def combine(*frames: DataFrame) -> DataFrame:
    """Union by column name of canonical frames (no shuffle: partitions are concatenated)."""
    return reduce(lambda a, b: a.unionByName(b), [f.select(*CANONICAL_COLUMNS) for f in frames])


def dedupe_line_items(combined: DataFrame) -> DataFrame:
    """Remove exact copies (opt-in). Map-side partial aggregation collapses a hot group of copies
    inside each task before the shuffle, so even a group holding a third of all rows moves only
    one row per task."""
    return combined.dropDuplicates(list(CANONICAL_COLUMNS))
