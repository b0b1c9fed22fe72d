"""Billing exports derived from the driver's tables.

The test tables hold no billing data, so both export layouts are projected from them with fixed
rules (FIXTURES.md section 4): source A (AWS layout) from ``lineitem``, source B (GCP layout) from
``events``. These are plain projections: one export row per input row, no shuffle, and every
input column not named here is pruned from the Parquet scan.
"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from costmart.schemas import AWS_RAW_SCHEMA, GCP_RAW_SCHEMA, conform

# Fixed values of the derivation rules (our fixture contract, FIXTURES.md section 4).
A_ACCOUNT_NAMES = ["prod-account", "data-account", "dev-account", "ml-account", None]
A_ENVIRONMENTS = ["prod", "prod", "dev", "prod", None]
A_TEAMS = ["platform", "data-engineering", "platform", "ml-platform", "data-engineering"]
A_SERVICES = [
    "Amazon EC2", "Amazon S3", "Amazon RDS", "AWS Lambda", "Amazon CloudFront", "Amazon EKS",
    "Amazon Redshift", "Amazon DynamoDB", "AWS Glue", "Amazon SageMaker", "Amazon Bedrock",
    "Amazon VPC", "Amazon Route 53", "AWS Data Transfer", "Unlisted Service",
]
A_REGIONS = [
    "us-east-1", "us-east-2", "us-west-1", "us-west-2", "eu-west-1", "eu-central-1",
    "ap-southeast-1", "ap-northeast-1", None,
]
B_PROJECT_NAMES = ["p0", "p1", "p2", "p3", None]
B_ENVIRONMENTS = ["prod", "prod", "dev", "prod", "staging"]
B_TEAMS = ["platform", "data-engineering", "platform", "ml-platform", None]
B_SERVICES = [
    "Compute Engine", "Cloud Storage", "BigQuery", "Cloud SQL", "Google Kubernetes Engine",
    "Cloud Run", "Vertex AI", "Cloud Pub/Sub", "Cloud Dataflow", "Cloud Spanner", "Cloud Logging",
    "Cloud CDN", "Cloud Load Balancing", "Networking",
]
B_REGIONS = [
    "us-central1", "us-east1", "us-west1", "us-west2", "europe-west1", "europe-west2",
    "asia-east1", "mars-north1",
]
A_FIRST_DAY = "2024-01-01"
A_DAY_SPAN = 400
A_NULL_DATE_MOD, A_NULL_COST_MOD = 101, 97
B_NULL_COST_MOD, B_CREDIT_MOD = 89, 50


def _pick(values: list, index: Column) -> Column:
    """``values[index]`` (0-based) as a literal array lookup; NULL entries stay NULL."""
    arr = F.array(*[F.lit(v).cast("string") for v in values])
    return F.element_at(arr, (index + 1).cast("int"))


def _day(days: Column) -> Column:
    """The text of the date so many days, below the span either way, from the first: looked up, since what reads the export asks for
    it more than once a row and the planner makes it anew each time."""
    first = date.fromisoformat(A_FIRST_DAY)
    texts = ",".join((first + timedelta(days=d)).isoformat() for d in range(1 - A_DAY_SPAN, A_DAY_SPAN))
    return F.element_at(F.split(F.lit(texts), ","), (days + A_DAY_SPAN).cast("int"))


def aws_export(lineitem: DataFrame) -> DataFrame:
    """Source A rows (AWS layout) from ``lineitem``."""
    ok, pk, sk, ln = (F.col(c) for c in ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"))
    day = _day(ok % A_DAY_SPAN)
    region = _pick(A_REGIONS, sk % len(A_REGIONS))
    out = lineitem.select(
        F.when(ok % A_NULL_DATE_MOD != 0, day).alias("bill_date"),
        F.concat(F.lit("1234567890"), F.lpad((sk % 5 + 1).cast("string"), 2, "0")).alias("account_id"),
        _pick(A_ACCOUNT_NAMES, sk % 5).alias("account_name"),
        _pick(A_SERVICES, pk % len(A_SERVICES)).alias("service_name"),
        F.when(ln % 3 == 0, F.concat(region, F.lit("a"))).otherwise(region).alias("region"),
        F.lit("Usage").alias("usage_type"),
        F.col("l_quantity").alias("usage_quantity"),
        F.lit("Hrs").alias("usage_unit"),
        F.when(pk % A_NULL_COST_MOD != 0, F.col("l_extendedprice") / 1000.0).alias("cost_usd"),
        _pick(A_ENVIRONMENTS, sk % 5).alias("environment"),
        _pick(A_TEAMS, sk % 5).alias("team"),
        F.concat(F.lit("i-"), ok.cast("string")).alias("resource_id"),
    )
    return conform(out, AWS_RAW_SCHEMA)


def gcp_export(events: DataFrame) -> DataFrame:
    """Source B rows (GCP layout) from ``events``."""
    eid, uid, value = F.col("event_id"), F.col("user_id"), F.col("value")
    region = _pick(B_REGIONS, eid % len(B_REGIONS))
    out = events.select(
        F.col("ts").cast("date").cast("string").alias("usage_date"),
        F.concat(F.lit("proj-"), (uid % 5).cast("string")).alias("project_id"),
        _pick(B_PROJECT_NAMES, uid % 5).alias("project_name"),
        _pick(B_SERVICES, uid % len(B_SERVICES)).alias("service_description"),
        F.lit("Standard").alias("sku_description"),
        F.when(eid % 3 == 0, F.concat(region, F.lit("-b"))).otherwise(region).alias("location_region"),
        value.alias("usage_amount"),
        F.lit("GiB").alias("usage_unit"),
        F.when(eid % B_NULL_COST_MOD == 0, F.lit(None).cast("double"))
         .when(eid % B_CREDIT_MOD == 1, -value)
         .otherwise(value).alias("cost"),
        _pick(B_ENVIRONMENTS, uid % 5).alias("environment"),
        _pick(B_TEAMS, uid % 5).alias("team"),
        F.concat(F.lit("projects/"), eid.cast("string")).alias("resource_name"),
    )
    return conform(out, GCP_RAW_SCHEMA)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def load_exports(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(source A raw rows, source B raw rows) for one test-data folder."""
    return (aws_export(read_table(spark, sf_dir, "lineitem")),
            gcp_export(read_table(spark, sf_dir, "events")))
