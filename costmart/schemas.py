"""Table contracts of the mart and a check that a DataFrame meets one.

Raw schemas are the CSV read schemas. They are declared nullable on purpose: Spark file sources
return every column nullable anyway, and the drop rule (``REQUIRED`` in each source layout) is what
removes incomplete rows. Every stage boundary calls :func:`assert_schema`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.types import DoubleType, MapType, StringType, StructField, StructType

S, D = StringType(), DoubleType()


def _struct(*cols: tuple) -> StructType:
    return StructType([StructField(name, dtype, True) for name, dtype in cols])


AWS_RAW_SCHEMA = _struct(
    ("bill_date", S), ("account_id", S), ("account_name", S), ("service_name", S),
    ("region", S), ("usage_type", S), ("usage_quantity", D), ("usage_unit", S),
    ("cost_usd", D), ("environment", S), ("team", S), ("resource_id", S),
)

GCP_RAW_SCHEMA = _struct(
    ("usage_date", S), ("project_id", S), ("project_name", S), ("service_description", S),
    ("sku_description", S), ("location_region", S), ("usage_amount", D), ("usage_unit", S),
    ("cost", D), ("environment", S), ("team", S), ("resource_name", S),
)

CANONICAL_SCHEMA = _struct(
    ("date_key", S), ("cloud_provider", S), ("account_id", S), ("account_name", S),
    ("service_name", S), ("region_code", S), ("usage_quantity", D), ("usage_unit", S),
    ("cost_usd", D), ("environment", S), ("team", S), ("resource_id", S),
)
CANONICAL_COLUMNS = tuple(f.name for f in CANONICAL_SCHEMA.fields)

DIM_DATE_SCHEMA = _struct(
    ("date_key", S), ("year", S), ("month", S), ("day", S), ("quarter", S),
    ("month_name", S), ("day_of_week", S), ("is_weekend", S),
)

DIM_SERVICE_SCHEMA = _struct(
    ("service_key", S), ("cloud_provider", S), ("service_name", S), ("service_category", S),
)

DIM_ACCOUNT_SCHEMA = _struct(
    ("account_key", S), ("cloud_provider", S), ("account_id", S), ("account_name", S),
    ("team", S), ("environment", S),
)

DIM_REGION_SCHEMA = _struct(
    ("region_key", S), ("cloud_provider", S), ("region_code", S), ("region_name", S),
    ("geography", S),
)

FACT_SCHEMA = _struct(
    ("cost_id", S), ("date_key", S), ("service_key", S), ("account_key", S), ("region_key", S),
    ("cloud_provider", S), ("cost_usd", D), ("usage_quantity", D), ("usage_unit", S),
    ("tags", MapType(S, S, True)),
)

# Stored form of the fact: the contract plus the month partition column.
FACT_STORED_SCHEMA = StructType(FACT_SCHEMA.fields + [StructField("bill_month", S, True)])

MART_SCHEMAS = {
    "fact_cloud_costs": FACT_STORED_SCHEMA,
    "dim_date": DIM_DATE_SCHEMA,
    "dim_service": DIM_SERVICE_SCHEMA,
    "dim_account": DIM_ACCOUNT_SCHEMA,
    "dim_region": DIM_REGION_SCHEMA,
}


class SchemaMismatch(ValueError):
    pass


def assert_schema(df: DataFrame, schema: StructType, *, ordered: bool = True) -> DataFrame:
    """Refuse a DataFrame whose column names or types differ from ``schema``.

    Nullability is not compared (file sources make everything nullable). Returns ``df`` so the
    check can sit inside a chain. It reads only the analysed schema; no job runs.
    """
    want = [(f.name, f.dataType.simpleString()) for f in schema.fields]
    have = [(f.name, f.dataType.simpleString()) for f in df.schema.fields]
    if not ordered:
        want, have = sorted(want), sorted(have)
    if want != have:
        missing = [c for c in want if c not in have]
        extra = [c for c in have if c not in want]
        raise SchemaMismatch(f"schema mismatch: missing {missing}, unexpected {extra}")
    return df


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Select ``schema``'s columns in order, cast to its types, then assert it."""
    from pyspark.sql import functions as F

    out = df.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])
    return assert_schema(out, schema)
