"""Inline lookup relations (service category, region metadata).

Both are fixed-size relations built on the driver from constants: 28 and 17 rows. Their size does
not grow with the data, which is the bound that makes broadcasting them safe.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StringType, StructField, StructType

# ---------------------------------------------------------------------------------------------
# These must equal the reference's lookups for identical results.
# Service name -> category (the key is the service name alone, without the provider).
# Anything not listed gets the category "Other".
# ---------------------------------------------------------------------------------------------
SERVICE_CATEGORIES = [
    ("Amazon EC2", "Compute"),
    ("Amazon EKS", "Compute"),
    ("AWS Lambda", "Compute"),
    ("Amazon RDS", "Database"),
    ("Amazon DynamoDB", "Database"),
    ("Amazon Redshift", "Analytics"),
    ("AWS Glue", "Analytics"),
    ("Amazon S3", "Storage"),
    ("Amazon CloudFront", "Network"),
    ("Amazon VPC", "Network"),
    ("Amazon Route 53", "Network"),
    ("AWS Data Transfer", "Network"),
    ("Amazon SageMaker", "AI/ML"),
    ("Amazon Bedrock", "AI/ML"),
    ("Compute Engine", "Compute"),
    ("Google Kubernetes Engine", "Compute"),
    ("Cloud Run", "Compute"),
    ("Cloud SQL", "Database"),
    ("Cloud Spanner", "Database"),
    ("BigQuery", "Analytics"),
    ("Cloud Dataflow", "Analytics"),
    ("Cloud Storage", "Storage"),
    ("Networking", "Network"),
    ("Cloud CDN", "Network"),
    ("Cloud Load Balancing", "Network"),
    ("Vertex AI", "AI/ML"),
    ("Cloud Pub/Sub", "Messaging"),
    ("Cloud Logging", "Operations"),
]
DEFAULT_SERVICE_CATEGORY = "Other"

# Region code -> (region name, geography). Anything not listed gets
# ("Unknown", "Other").
REGION_META = [
    ("us-east-1", "US East (N. Virginia)", "US"),
    ("us-east-2", "US East (Ohio)", "US"),
    ("us-west-1", "US West (N. California)", "US"),
    ("us-west-2", "US West (Oregon)", "US"),
    ("eu-west-1", "EU (Ireland)", "EU"),
    ("eu-central-1", "EU (Frankfurt)", "EU"),
    ("ap-southeast-1", "Asia Pacific (Singapore)", "APAC"),
    ("ap-northeast-1", "Asia Pacific (Tokyo)", "APAC"),
    ("us-central1", "US Central (Iowa)", "US"),
    ("us-east1", "US East (South Carolina)", "US"),
    ("us-west1", "US West (Oregon)", "US"),
    ("us-west2", "US West (Los Angeles)", "US"),
    ("europe-west1", "EU West (Belgium)", "EU"),
    ("europe-west2", "EU West (London)", "EU"),
    ("asia-east1", "Asia East (Taiwan)", "APAC"),
    ("asia-southeast1", "Asia Southeast (Singapore)", "APAC"),
    ("global", "Global / Multi-region", "Global"),
]
DEFAULT_REGION_NAME = "Unknown"
DEFAULT_GEOGRAPHY = "Other"

# Defaults applied by the normalisers.
DEFAULT_ENVIRONMENT = "unknown"
DEFAULT_TEAM = "unknown"
DEFAULT_REGION = "global"
# ---------------------------------------------------------------------------------------------

_CATEGORY_SCHEMA = StructType([
    StructField("service_name", StringType(), False),
    StructField("service_category", StringType(), False),
])
_REGION_SCHEMA = StructType([
    StructField("region_code", StringType(), False),
    StructField("region_name", StringType(), False),
    StructField("geography", StringType(), False),
])


def service_category_lookup(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(SERVICE_CATEGORIES, _CATEGORY_SCHEMA)


def region_meta_lookup(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(REGION_META, _REGION_SCHEMA)
