"""Dimension builders: date parts, weekends, leap day, lookups, unknowns, drift."""

import pytest

from costmart.operators import dimensions as D
from costmart.operators.fact import build_fact
from tests import fixtures as fx


@pytest.fixture
def combined(spark):
    return fx.combined(spark)


def test_dim_date_parts(spark, combined):
    rows = {r.date_key: r for r in D.build_dim_date(combined).collect()}
    assert len(rows) == 3  # two line items share a day
    r = rows["2024-11-30"]
    assert (r.year, r.month, r.day, r.quarter, r.month_name) == ("2024", "11", "30", "Q4", "November")
    assert rows["2023-12-31"].is_weekend == "true" and rows["2024-02-29"].is_weekend == "false"


@pytest.mark.parametrize("day,name,weekend", [
    ("2024-01-13", "Saturday", "true"), ("2024-01-14", "Sunday", "true"), ("2024-01-15", "Monday", "false"),
])
def test_dim_date_weekend(spark, day, name, weekend):
    r = D.build_dim_date(fx.combined(spark, [fx.canon_row(date_key=day)])).first()
    assert (r.day_of_week, r.is_weekend) == (name, weekend)


def test_dim_date_leap_day(spark):
    r = D.build_dim_date(fx.combined(spark, [fx.canon_row(date_key="2024-02-29")])).first()
    assert (r.quarter, r.month, r.day, r.month_name) == ("Q1", "02", "29", "February")


def test_dim_service_category(spark, combined):
    found = {r.service_name: r.service_category for r in D.build_dim_service(combined).collect()}
    assert found == {"Amazon Redshift": "Analytics", "Vertex AI": "AI/ML", "Amazon S3": "Storage", "BigQuery": "Analytics"}


def test_dim_service_key_is_bit_exact(spark, combined):
    expected = spark.sql("SELECT md5('AWS|Amazon EC2') AS k").first().k
    assert expected == "c785ec3a6472e95f27d6686f8764ac5b"
    c = fx.combined(spark, [fx.canon_row(service_name="Amazon EC2")])
    assert D.build_dim_service(c).first().service_key == expected


def test_dim_service_unknown_is_other(spark):
    r = D.build_dim_service(fx.combined(spark, [fx.canon_row(service_name="Quantum Thing")])).first()
    assert r.service_category == "Other"


def test_dim_region_geography(spark, combined):
    assert {r.geography for r in D.build_dim_region(combined).collect()} == {"EU", "US"}


def test_dim_region_unknown(spark):
    r = D.build_dim_region(fx.combined(spark, [fx.canon_row(region_code="mars-north1")])).first()
    assert (r.region_name, r.geography) == ("Unknown", "Other")


def test_dim_account_drift_keeps_one_row(spark):
    rows = [fx.canon_row(date_key="2024-01-01", account_name="old-name", team="a"),
            fx.canon_row(date_key="2024-02-01", account_name="new-name", team="b"),
            fx.canon_row(date_key="2024-01-15", account_name="old-name", team="a")]
    c = fx.combined(spark, rows)
    dim = D.build_dim_account(c).collect()
    assert len(dim) == 1 and (dim[0].account_name, dim[0].team) == ("new-name", "b")
    # the lookup-mode fact does not multiply rows through the account join
    fact = build_fact(c, keys="lookup", dims=D.build_dimensions(c))
    assert fact.count() == 3


def test_dimension_keys_unique(spark):
    c = fx.combined(spark)
    for name, key in [("dim_date", "date_key"), ("dim_service", "service_key"),
                      ("dim_account", "account_key"), ("dim_region", "region_key")]:
        dim = D.build_dimensions(c)[name]
        assert dim.count() == dim.select(key).distinct().count()


def test_one_pass_equals_separate_builders(spark):
    from costmart.plans.mart import combined_from_driver_tables
    from tests.conftest import SF_SMALL

    c = combined_from_driver_tables(spark, SF_SMALL)
    separate = D.build_dimensions(c)
    one_pass = D.dimensions_from_keys(D.dimension_keys(c))
    for name in separate:
        assert sorted(separate[name].collect()) == sorted(one_pass[name].collect()), name
