"""Per-provider export layouts.

A layout is data: the raw schema, which raw column feeds each canonical column, the drop rule and
the zone-suffix rule. A third provider is one more ``SourceLayout`` value, not new code.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql.types import StructType

from costmart.schemas import AWS_RAW_SCHEMA, GCP_RAW_SCHEMA


@dataclass(frozen=True)
class SourceLayout:
    provider: str
    raw_schema: StructType
    # canonical column -> raw column; cloud_provider is the literal ``provider``
    columns: dict
    # raw columns that must be non-NULL (the drop rule)
    required: tuple
    # zone suffix rule applied to the raw region column (Java regex, replacement)
    region_pattern: str
    region_replacement: str
    # last characters of region codes that the rule leaves alone, so that most aren't searched; "" where there are none
    region_plain_ends: str = ""

    def raw(self, canonical: str) -> str:
        return self.columns[canonical]


# Provider names, column mappings, drop rules and zone patterns of the two
# export layouts (these must equal the reference's for identical results).
AWS = SourceLayout(
    provider="AWS",
    raw_schema=AWS_RAW_SCHEMA,
    columns={
        "date_key": "bill_date",
        "account_id": "account_id",
        "account_name": "account_name",
        "service_name": "service_name",
        "region_code": "region",
        "usage_quantity": "usage_quantity",
        "usage_unit": "usage_unit",
        "cost_usd": "cost_usd",
        "environment": "environment",
        "team": "team",
        "resource_id": "resource_id",
    },
    required=("bill_date", "cost_usd", "service_name", "account_id"),
    region_pattern=r"([a-z]{2}-[a-z]+-\d)[a-z]$",
    region_replacement="$1",
    region_plain_ends="0123456789",
)

GCP = SourceLayout(
    provider="GCP",
    raw_schema=GCP_RAW_SCHEMA,
    columns={
        "date_key": "usage_date",
        "account_id": "project_id",
        "account_name": "project_name",
        "service_name": "service_description",
        "region_code": "location_region",
        "usage_quantity": "usage_amount",
        "usage_unit": "usage_unit",
        "cost_usd": "cost",
        "environment": "environment",
        "team": "team",
        "resource_id": "resource_name",
    },
    required=("usage_date", "cost", "service_description", "project_id"),
    region_pattern=r"-[a-z]$",
    region_replacement="",
    region_plain_ends="0123456789",
)

LAYOUTS = {"AWS": AWS, "GCP": GCP}
