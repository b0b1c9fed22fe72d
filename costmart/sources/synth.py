"""Synthetic billing exports, generated as a Spark job.

Rows come from ``spark.range(n)``; every value is a pure function of (row id, seed, field), picked
with ``xxhash64``, so the output is the same whatever the number of partitions or executors, and
generation scales out with ``spark.range``. Edge cases the pipeline must handle (missing dates,
costs, regions and teams, zone suffixes, unknown services, credits, exact copies) are injected
at parameterised rates.

This is a data generator for tests and load runs; it reads none of the driver tables, so it is
not registered as a query in ``__spark_entry__``.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from costmart.functions.lookups import REGION_META, SERVICE_CATEGORIES
from costmart.schemas import AWS_RAW_SCHEMA, GCP_RAW_SCHEMA, conform

# Value domains of our own, but for the services and regions, which are those of the lookups.
USAGE_TYPES = ["on-demand", "reserved", "spot", "transfer", "request"]
UNITS = ["hour", "gb-month", "million-requests"]
#: Costs per line item: between these, drawn evenly on a logarithmic scale.
COST_RANGE = (0.0005, 180.0)
USAGE_RANGE = (0.5, 750.0)
CREDIT_RATE, CREDIT_RANGE = 0.025, (0.05, 8.0)
#: (account, name, team, environment)
ACCOUNTS = {
    "AWS": [("900010001", "storefront", "checkout", "prod"), ("900010002", "warehouse", "bi", "prod"),
            ("900010003", "sandbox", "checkout", "dev"), ("900010004", "recommender", "ranking", "prod"),
            ("900010005", "rehearsal", "bi", "staging"), ("900010006", "archive", "platform", "prod")],
    "GCP": [("search-eu", "search", "ranking", "prod"), ("lake-us", "lake", "ingest", "prod"),
            ("search-lab", "search-lab", "ranking", "dev"), ("maps-asia", "maps", "platform", "prod")],
}
FIRST_DAY, DAYS = "2024-01-01", 366


def _services(provider: str) -> list[str]:
    """Of the lookup: a provider's services."""
    own = [name for name, _ in SERVICE_CATEGORIES if name.startswith(("Amazon ", "AWS "))]
    return own if provider == "AWS" else [name for name, _ in SERVICE_CATEGORIES if name not in own]


def _regions(provider: str) -> list[str]:
    """Of the lookup: a provider's regions (one ends in a hyphen and a digit, the other's in a digit alone)."""
    return [code for code, *_ in REGION_META if bool(re.search(r"-[0-9]$", code)) == (provider == "AWS") and code != "global"]


@dataclass(frozen=True)
class EdgeRates:
    """Share of rows carrying each edge case (all 0: clean rows only)."""
    null_date: float = 0.0
    null_cost: float = 0.0
    null_region: float = 0.0
    null_team: float = 0.0
    zone_suffix: float = 0.0
    unknown_service: float = 0.0
    exact_copy: float = 0.0


def _u(src: Column, seed: int, field: str) -> Column:
    """Uniform double in [0, 1) from (row, seed, field)."""
    h = F.xxhash64(src, F.lit(seed), F.lit(field))
    return (F.pmod(h, F.lit(1 << 53)).cast("double")) / float(1 << 53)


def _pick(values: list, u: Column) -> Column:
    arr = F.array(*[F.lit(v) for v in values])
    return F.element_at(arr, (F.floor(u * len(values)) + 1).cast("int"))


def _uniform(lo: float, hi: float, u: Column, digits: int) -> Column:
    return F.round(F.lit(lo) + u * (hi - lo), digits)


def _when_rate(rate: float, u: Column, value: Column) -> Column:
    return F.when(u >= rate, value) if rate > 0 else value


def synthesize_billing(spark: SparkSession, n: int, provider: str = "AWS", seed: int = 42,
                       rates: EdgeRates = EdgeRates(), partitions: int | None = None) -> DataFrame:
    """``n`` raw export rows of one provider's layout (AWS or GCP)."""
    ids = spark.range(0, n, 1, partitions) if partitions else spark.range(0, n)
    # an exact copy repeats the content of the previous row id
    src = F.when(_u(F.col("id"), seed, "copy") < rates.exact_copy, F.greatest(F.col("id") - 1, F.lit(0))) \
        .otherwise(F.col("id")) if rates.exact_copy > 0 else F.col("id")
    rows = ids.select(src.alias("src"))
    s = F.col("src")
    u = lambda field: _u(s, seed, field)

    if provider not in ACCOUNTS:
        raise ValueError(f"unknown provider {provider!r}")
    service = _pick(_services(provider), u("service"))
    usage_type, unit = _pick(USAGE_TYPES, u("usage_type")), _pick(UNITS, u("unit"))
    low, high = COST_RANGE
    cost = F.round(F.lit(low) * F.pow(F.lit(high / low), u("cost")), 6)
    accounts = ACCOUNTS[provider]
    acc_i = F.floor(u("account") * len(accounts)).cast("int") + 1
    acc = lambda k: F.element_at(F.array(*[F.lit(x[k]) for x in accounts]), acc_i)
    day = F.date_format(F.date_add(F.lit(FIRST_DAY).cast("date"), F.floor(u("date") * DAYS).cast("int")),
                        "yyyy-MM-dd")
    service_name = F.when(u("unknown") < rates.unknown_service, F.lit("Unlisted Service")).otherwise(service) \
        if rates.unknown_service > 0 else service
    region = _pick(_regions(provider), u("region"))
    suffix = "a" if provider == "AWS" else "-b"
    region = F.when(u("zone") < rates.zone_suffix, F.concat(region, F.lit(suffix))).otherwise(region)
    region = _when_rate(rates.null_region, u("null_region"), region)
    team = _when_rate(rates.null_team, u("null_team"), acc(2))
    date_col = _when_rate(rates.null_date, u("null_date"), day)
    hexid = F.lpad(F.lower(F.hex(F.xxhash64(s, F.lit(seed), F.lit("resource")))), 16, "0")

    if provider == "AWS":
        cost_col = _when_rate(rates.null_cost, u("null_cost"), cost)
        out = rows.select(
            date_col.alias("bill_date"), acc(0).alias("account_id"), acc(1).alias("account_name"),
            service_name.alias("service_name"), region.alias("region"), usage_type.alias("usage_type"),
            _uniform(*USAGE_RANGE, u("usage"), 4).alias("usage_quantity"), unit.alias("usage_unit"),
            cost_col.alias("cost_usd"), acc(3).alias("environment"), team.alias("team"),
            F.concat(F.lit("i-"), hexid).alias("resource_id"))
        return conform(out, AWS_RAW_SCHEMA)
    credit = -_uniform(*CREDIT_RANGE, u("credit_amount"), 6)
    cost_col = _when_rate(rates.null_cost, u("null_cost"), F.when(u("credit") < CREDIT_RATE, credit).otherwise(cost))
    out = rows.select(
        date_col.alias("usage_date"), acc(0).alias("project_id"), acc(1).alias("project_name"),
        service_name.alias("service_description"), usage_type.alias("sku_description"),
        region.alias("location_region"), _uniform(*USAGE_RANGE, u("usage"), 4).alias("usage_amount"),
        unit.alias("usage_unit"), cost_col.alias("cost"), acc(3).alias("environment"),
        team.alias("team"), F.concat(F.lit("res/"), acc(0), F.lit("/"), hexid).alias("resource_name"))
    return conform(out, GCP_RAW_SCHEMA)
