"""Synthetic billing generator: partition independence, domains, edge-case rates, pipeline fit."""

from pyspark.sql import functions as F

from costmart.operators.normalize import combine, normalize
from costmart.operators.quality import drop_counts
from costmart.plans import reports as R
from costmart.operators.fact import fact_lines
from costmart.sources.layouts import AWS, GCP
from costmart.sources import synth
from costmart.sources.synth import EdgeRates, synthesize_billing


def test_same_rows_for_any_partitioning(spark):
    a = sorted(synthesize_billing(spark, 2000, "AWS", seed=7, partitions=1).collect())
    b = sorted(synthesize_billing(spark, 2000, "AWS", seed=7, partitions=13).collect())
    assert a == b
    c = sorted(synthesize_billing(spark, 2000, "AWS", seed=8, partitions=13).collect())
    assert a != c


def test_clean_by_default_and_in_domain(spark):
    df = synthesize_billing(spark, 5000, "AWS")
    r = drop_counts(df, AWS).first()
    assert r.dropped_rows == 0 and r.kept_rows == 5000
    stats = df.agg(F.min("bill_date"), F.max("bill_date"), F.min("cost_usd"), F.max("cost_usd"),
                   F.countDistinct("service_name"), F.countDistinct("region")).first()
    assert stats[0] >= "2024-01-01" and stats[1] <= "2024-12-31"
    low, high = synth.COST_RANGE
    assert stats[2] >= low and stats[3] <= high
    assert stats[4] == len(synth._services("AWS")) and stats[5] == len(synth._regions("AWS"))


def test_gcp_credits(spark):
    df = synthesize_billing(spark, 20000, "GCP")
    credits = df.where("cost < 0")
    share = credits.count() / 20000
    assert 0.8 * synth.CREDIT_RATE < share < 1.2 * synth.CREDIT_RATE
    lo, hi = credits.agg(F.min("cost"), F.max("cost")).first()
    assert -lo <= synth.CREDIT_RANGE[1] and -hi >= synth.CREDIT_RANGE[0]


def test_edge_rates(spark):
    rates = EdgeRates(null_date=0.05, null_cost=0.05, null_region=0.1, null_team=0.1,
                      zone_suffix=0.3, unknown_service=0.05, exact_copy=0.1)
    df = synthesize_billing(spark, 20000, "AWS", rates=rates)
    r = drop_counts(df, AWS).first()
    assert 700 < r.null_date < 1300 and 700 < r.null_cost < 1300
    assert df.where(F.col("region").endswith("a")).count() > 4000
    assert df.count() - df.distinct().count() > 1000          # exact copies
    canon = normalize(df, AWS)
    assert canon.where("region_code = 'global'").count() > 1000
    assert canon.where("team = 'unknown'").count() > 1000


def test_pipeline_over_synthetic_exports(spark):
    a = normalize(synthesize_billing(spark, 3000, "AWS"), AWS)
    g = normalize(synthesize_billing(spark, 3000, "GCP"), GCP)
    out = {r.cloud_provider: r.num_line_items for r in R.spend_by_provider(fact_lines(combine(a, g))).collect()}
    assert out == {"AWS": 3000, "GCP": 3000}
