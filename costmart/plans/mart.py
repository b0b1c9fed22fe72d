"""The mart as a whole: exports -> canonical rows -> dimensions + fact -> reports.

Each step is a function with explicit inputs and outputs, so any scheduler can run the steps
as separate jobs that hand over Parquet folders (``sinks.mart_store``), or in one session.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from costmart.functions.dates import bill_month
from costmart.functions.money import limbs, parts, rest
from costmart.operators.dimensions import build_dimensions
from costmart.operators.fact import build_fact, fact_lines
from costmart.operators.normalize import combine, normalize
from costmart.schemas import CANONICAL_SCHEMA, assert_schema
from costmart.plans.loads import full_load
from costmart.sinks.mart_store import load_mart_tables, read_landing, read_rollup, write_mart
from costmart.sources.billing_csv import read_export
from costmart.sources.driver_tables import load_exports
from costmart.sources.layouts import AWS, GCP

DIMENSIONS = ("dim_date", "dim_service", "dim_account", "dim_region")


@dataclass
class Mart:
    fact: DataFrame
    dims: dict
    rollup: DataFrame | None = None  # daily rollup, when stored; reports accept it for ``fact``

    def tables(self) -> dict[str, DataFrame]:
        return {"fact_cloud_costs": self.fact, **self.dims}


def transform_aws(spark: SparkSession, path: str) -> DataFrame:
    """Source A CSV export -> canonical rows."""
    return normalize(read_export(spark, path, AWS), AWS)


def transform_gcp(spark: SparkSession, path: str) -> DataFrame:
    """Source B CSV export -> canonical rows."""
    return normalize(read_export(spark, path, GCP), GCP)


def combined_from_driver_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Canonical rows of both sources over the test tables in ``sf_dir``."""
    aws_raw, gcp_raw = load_exports(spark, sf_dir)
    return combine(normalize(aws_raw, AWS), normalize(gcp_raw, GCP))


def read_canonical(spark: SparkSession, *paths: str) -> DataFrame:
    """Canonical rows handed over as Parquet by an earlier step."""
    frames = [assert_schema(spark.read.parquet(p), CANONICAL_SCHEMA) for p in paths]
    return combine(*frames)


def build_mart(combined: DataFrame, *, with_ids: bool = True, keys: str = "derive") -> Mart:
    dims = build_dimensions(combined)
    if with_ids:
        fact = build_fact(combined, keys=keys, dims=dims if keys == "lookup" else None)
    else:
        fact = fact_lines(combined)
    return Mart(fact=fact, dims=dims)


def load_mart(spark: SparkSession, base: str) -> Mart:
    """The stored mart: fact month folders plus the current rows of each dimension."""
    fact, dims = load_mart_tables(spark, base)
    return Mart(fact=fact, dims=dims, rollup=read_rollup(spark, base))


def landed_rows(spark: SparkSession, base: str) -> DataFrame:
    """The canonical rows that the stored fact must have one row for each."""
    return read_landing(spark, base)


def store_mart(mart: Mart, base: str) -> None:
    write_mart(mart.fact, mart.dims, base)


def run_pipeline(spark: SparkSession, aws_path: str, gcp_path: str, base: str) -> Mart:
    """CSV exports -> stored mart at ``base``; returns the stored mart (read back).

    A full load: whatever the mart held before is replaced. Each export is parsed once; dropped and
    partly read lines go to ``base/quarantine``, one row of counts per provider to ``base/load_counts``,
    and the canonical rows to ``base/landing``, to which incremental loads add theirs.
    """
    exports = [(AWS, read_export(spark, aws_path, AWS, keep_corrupt=True)),
               (GCP, read_export(spark, gcp_path, GCP, keep_corrupt=True))]
    full_load(spark, exports, base)
    return load_mart(spark, base)


def report_views(spark: SparkSession, mart: Mart) -> None:
    """Register the five tables as temp views for SQL reports (``spark.sql``). The date view has each day's
    ``bill_month`` beside its columns, and the fact view
    always has ``bill_month`` (derived from ``date_key`` for an in-memory fact) so SQL can
    bound it and prune month folders of the stored table, and the parts of each cost
    (``cost_units``, ``cost_d6``, ``cost_d11``, ``cost_d16``, ``cost_rest``), computed when a report asks for them."""
    for name, df in mart.tables().items():
        if name == "fact_cloud_costs":
            if "bill_month" not in df.columns:
                df = df.withColumn("bill_month", bill_month("date_key"))
            df = df.withColumns({**dict(zip(("cost_units", "cost_d6", "cost_d11", "cost_d16"), limbs(*parts("cost_usd")))), "cost_rest": rest("cost_usd")})
        if name == "dim_date":
            df = df.withColumn("bill_month", bill_month("date_key"))
        df.createOrReplaceTempView(name)


def fact_with_flat_tags(fact: DataFrame) -> DataFrame:
    """Fact columns with the ``tags`` map flattened (for comparisons and exports)."""
    return fact.select(
        *[c for c in fact.columns if c != "tags"],
        F.col("tags")["environment"].alias("tag_environment"),
        F.col("tags")["team"].alias("tag_team"),
    ).drop("tags")
