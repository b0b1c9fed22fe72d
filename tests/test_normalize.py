"""Source normalisers: one row per rule, CSV reading, quarantine, drop counts."""

import pytest
from pyspark.sql import functions as F

from costmart.operators.normalize import combine, dedupe_line_items, normalize
from costmart.operators.quality import drop_counts, quarantine
from costmart.plans.mart import transform_aws, transform_gcp
from costmart.schemas import AWS_RAW_SCHEMA, CANONICAL_COLUMNS
from costmart.sources.billing_csv import read_export, write_export
from costmart.sources.layouts import AWS, GCP
from tests import fixtures as fx


def _aws_csv(spark, scratch, rows=None):
    path = scratch("aws-csv")
    write_export(fx.aws_raw(spark, rows), path)
    return path


def _gcp_csv(spark, scratch, rows=None):
    path = scratch("gcp-csv")
    write_export(fx.gcp_raw(spark, rows), path)
    return path


# --- source A -------------------------------------------------------------------------------------
def test_aws_drops_rows_without_a_required_field(spark, scratch):
    out = transform_aws(spark, _aws_csv(spark, scratch))
    assert out.count() == fx.AWS_KEPT and out.where("resource_id LIKE 'no-%'").count() == 0


def test_aws_adds_provider(spark, scratch):
    out = transform_aws(spark, _aws_csv(spark, scratch))
    assert [r[0] for r in out.select("cloud_provider").distinct().collect()] == ["AWS"]


def test_aws_zone_suffix_cut(spark, scratch):
    rows = [fx.aws_row(region="us-east-1a")]
    assert transform_aws(spark, _aws_csv(spark, scratch, rows)).first().region_code == "us-east-1"


def test_aws_canonical_columns(spark, scratch):
    assert transform_aws(spark, _aws_csv(spark, scratch)).columns == list(CANONICAL_COLUMNS)


def test_aws_defaults(spark):
    r = normalize(fx.aws_raw(spark), AWS).where("account_id = '7002'").first()
    assert (r.account_name, r.region_code, r.team, r.environment) == ("7002", "global", "unknown", "unknown")


@pytest.mark.parametrize("region,expected", [
    ("us-gov-west-1b", "us-gov-west-1"),      # pattern not anchored at the start
    ("us-west-2-lax-1a", "us-west-2-lax-1a"),
    ("US-EAST-1A", "US-EAST-1A"),
    ("us-central1-a", "us-central1-a"),       # a GCP zone is not cut by the AWS rule
    ("eu-central-1", "eu-central-1"),
])
def test_aws_zone_rule_edges(spark, region, expected):
    out = normalize(fx.aws_raw(spark, [fx.aws_row(region=region)]), AWS)
    assert out.first().region_code == expected


# --- source B -------------------------------------------------------------------------------------
def test_gcp_keeps_credits(spark, scratch):
    out = transform_gcp(spark, _gcp_csv(spark, scratch))
    assert out.count() == fx.GCP_KEPT
    assert out.where(F.col("cost_usd") < 0).first().cost_usd == -3.25


def test_gcp_adds_provider(spark, scratch):
    out = transform_gcp(spark, _gcp_csv(spark, scratch))
    assert [r[0] for r in out.select("cloud_provider").distinct().collect()] == ["GCP"]


def test_gcp_project_becomes_account(spark, scratch):
    out = transform_gcp(spark, _gcp_csv(spark, scratch))
    ids = {r.account_id for r in out.select("account_id").distinct().collect()}
    assert ids == {"search-eu", "lake-us"}
    assert out.where("account_id = 'lake-us'").first().account_name == "lake-us"


@pytest.mark.parametrize("region,expected", [
    ("us-central1-a", "us-central1"),
    ("us-east-1a", "us-east-1a"),             # an AWS zone is not cut by the GCP rule
    (None, "global"),
])
def test_gcp_zone_rule_edges(spark, region, expected):
    out = normalize(fx.gcp_raw(spark, [fx.gcp_row(location_region=region)]), GCP)
    assert out.first().region_code == expected


# --- CSV reading, quarantine, header check ----------------------------------------------------------
def test_csv_malformed_cost_is_quarantined(spark, scratch):
    path = scratch("bad-csv")
    spark.sparkContext  # noqa: B018  (classic session)
    header = ",".join(AWS_RAW_SCHEMA.fieldNames())
    good = "2024-01-02,111,acct,Amazon EC2,us-east-1,Box,1.0,Hrs,5.5,prod,platform,i-1"
    bad = "2024-01-03,111,acct,Amazon EC2,us-east-1,Box,1.0,Hrs,abc,prod,platform,i-2"
    quoted_empty = '2024-01-04,111,"",Amazon EC2,us-east-1,Box,1.0,Hrs,2.0,prod,platform,i-3'
    spark.createDataFrame([(header,), (good,), (bad,), (quoted_empty,)], "value string") \
        .coalesce(1).write.text(path)
    raw = read_export(spark, path, AWS, keep_corrupt=True)
    clean = normalize(raw.drop("_corrupt_record"), AWS)
    assert sorted(r.resource_id for r in clean.collect()) == ["i-1", "i-3"]
    assert clean.where("resource_id = 'i-3'").first().account_name == "111"  # quoted empty -> NULL
    q = quarantine(raw, AWS).collect()
    assert [(r.reason, r.resource_id) for r in q] == [("malformed", "i-2")]
    assert "abc" in q[0].raw_line


def test_csv_header_in_other_order_is_refused(spark, scratch):
    path = scratch("swapped-csv")
    names = AWS_RAW_SCHEMA.fieldNames()
    swapped = [names[1], names[0]] + names[2:]
    row = "111,2024-01-02,acct,Amazon EC2,us-east-1,Box,1.0,Hrs,5.5,prod,platform,i-1"
    spark.createDataFrame([(",".join(swapped),), (row,)], "value string").coalesce(1).write.text(path)
    with pytest.raises(Exception):
        read_export(spark, path, AWS).collect()


@pytest.mark.parametrize("date", ["2024-13-45", " 2024-01-05", "2024-1-5", "not a date"])
def test_bad_dates_are_quarantined_not_fatal(spark, date):
    raw = fx.aws_raw(spark, [fx.aws_row(bill_date=date), fx.aws_row(bill_date="2024-01-05")])
    assert normalize(raw, AWS).count() == 1
    assert [r.reason for r in quarantine(raw, AWS).collect()] == ["bad_date"]


@pytest.mark.parametrize("cost", [float("nan"), float("inf"), -float("inf"), 1e15, 1e300, 1.2345678901234567e-9])
def test_cost_of_any_size_is_kept_and_counted(spark, cost):
    import math

    from costmart.operators.fact import fact_lines
    from costmart.plans.reports import geography_spend, spend_by_provider
    from costmart.operators.dimensions import build_dim_region

    raw = fx.aws_raw(spark, [fx.aws_row(cost_usd=cost, resource_id="odd"), fx.aws_row(cost_usd=2.5)])
    clean = normalize(raw, AWS)
    assert clean.count() == 2 and quarantine(raw, AWS).count() == 0
    assert drop_counts(raw, AWS).first().inexact_cost == 1
    total = spend_by_provider(fact_lines(clean)).first().total_cost_usd  # no ANSI cast error
    want = cost + 2.5
    assert math.isnan(total) if math.isnan(want) else total == round(want, 2)
    assert geography_spend(fact_lines(clean), build_dim_region(clean)).count() == 1


def test_small_and_large_costs_add_up(spark):
    from costmart.functions.money import money_sums, total

    c = fx.combined(spark, [fx.canon_row(cost_usd=4e-7)] * 3000 + [fx.canon_row(cost_usd=2e12)] * 41)
    r = c.agg(*money_sums("cost_usd")).select(total(4).alias("t")).first()
    assert r.t == 41 * 2e12 + 0.0012


def test_malformed_optional_field_is_kept_and_listed(spark, scratch):
    path = scratch("optional-csv")
    header = ",".join(AWS_RAW_SCHEMA.fieldNames())
    line = "2024-01-03,111,acct,Amazon EC2,us-east-1,Box,lots,Hrs,5.5,prod,platform,i-2"
    spark.createDataFrame([(header,), (line,)], "value string").coalesce(1).write.text(path)
    raw = read_export(spark, path, AWS, keep_corrupt=True)
    assert normalize(raw.drop("_corrupt_record"), AWS).first().usage_quantity is None
    q = quarantine(raw, AWS).first()
    assert (q.reason, q.kept, "lots" in q.raw_line) == ("malformed", True, True)
    # a load counts while it lands the rows (over text alone, a count would parse only the columns it needs)
    from costmart.plans.loads import full_load
    from costmart.sinks.mart_store import read_load_counts

    base = scratch("optional-mart")
    full_load(spark, [(AWS, raw)], base)
    assert read_load_counts(spark, base).first().malformed_rows == 1


def test_drop_counts_by_reason(spark):
    r = drop_counts(fx.aws_raw(spark), AWS).first()
    assert (r.raw_rows, r.null_date, r.null_cost, r.null_service, r.null_account) == (7, 1, 1, 1, 1)
    assert (r.dropped_rows, r.kept_rows, r.inexact_cost, r.malformed_rows) == (4, fx.AWS_KEPT, 0, 0)


def test_union_and_dedupe(spark):
    c = combine(normalize(fx.aws_raw(spark), AWS), normalize(fx.gcp_raw(spark), GCP))
    assert c.count() == fx.AWS_KEPT + fx.GCP_KEPT
    assert dedupe_line_items(c.unionByName(c)).count() == fx.AWS_KEPT + fx.GCP_KEPT


def test_dates_are_cast_not_parsed_by_a_pattern(spark):
    from costmart.functions.dates import parse_date

    texts = ["2024-02-29", "2023-02-29", "2024-1-1", "2024-01-01\n", " 2024-01-01", "2024-01-01 ", "2024-01-01T00:00:00", "0000-01-01",
             "9999-12-31", "2024-13-01", "+2024-1-01", "", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i INT, t STRING").select("i", "t", parse_date("t").cast("string").alias("d"))
    assert {r.t for r in df.collect() if r.d is not None} == {"2024-02-29", "0000-01-01", "9999-12-31"}
    assert "gettimestamp" not in df._jdf.queryExecution().optimizedPlan().toString().lower()


def test_regions_that_end_in_a_digit_are_not_searched(spark):
    from costmart.operators.normalize import canonical_columns
    from costmart.sources.layouts import AWS, GCP

    for layout, column, codes in ((AWS, "region", {"us-east-1": "us-east-1", "us-east-1a": "us-east-1", "us-east-1a\n": "us-east-1\n", "": "", None: "global"}),
                                  (GCP, "location_region", {"us-west2": "us-west2", "us-west2-b": "us-west2", "us-west2-b\n": "us-west2\n", None: "global"})):
        raw = spark.createDataFrame([(k,) for k in codes], f"{column} STRING").select(
            column, *[F.lit(None).cast(f.dataType).alias(f.name) for f in layout.raw_schema.fields if f.name != column])
        out = raw.select(column, *canonical_columns(layout))
        assert {r[0]: r.region_code for r in out.collect()} == codes
        assert "substring" in str(canonical_columns(layout)[5])


def test_export_days_are_looked_up(spark):
    """Each line item's day is its order key's, whatever the key, and is no date put into words for every use of it."""
    from costmart.sources import driver_tables as dt

    columns = "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double"
    keys = [None, 0, 1, 100, 399, 400, 799, 2 ** 62, -1, -399, -400, -2 ** 62, *range(-1000, 1000, 7)]
    lines = spark.createDataFrame([(k, 1, 1, 1, 1.0, 1.0) for k in keys], columns)
    out = dt.aws_export(lines).select("bill_date", "resource_id").collect()
    day = F.date_add(F.lit(dt.A_FIRST_DAY).cast("date"), (F.col("l_orderkey") % dt.A_DAY_SPAN).cast("int")).cast("string")
    made = lines.select(F.when(F.col("l_orderkey") % dt.A_NULL_DATE_MOD != 0, day), F.concat(F.lit("i-"), F.col("l_orderkey").cast("string")))
    assert sorted(map(str, map(tuple, out))) == sorted(map(str, map(tuple, made.collect())))
    plan = dt.aws_export(lines)._jdf.queryExecution().optimizedPlan().toString()
    assert "date_add" not in plan and "split(" not in plan
