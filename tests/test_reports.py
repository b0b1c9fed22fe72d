"""Reports: semantics the oracle cannot show (parameters, NULL shares, ties, SQL form) and plans."""

import pytest
from pyspark.sql import functions as F

from costmart.operators import dimensions as D
from costmart.operators.fact import fact_lines
from costmart.plans import reports as R
from costmart.plans.catalog import REPORT_QUERIES, SQL_QUERIES
from costmart.plans.mart import combined_from_driver_tables
from tests import fixtures as fx
from tests.conftest import SF_SMALL


@pytest.fixture(scope="module")
def mart(spark):
    c = combined_from_driver_tables(spark, SF_SMALL)
    return fact_lines(c), D.build_dimensions(c)


def test_category_shares_sum_to_100(spark, mart):
    f, d = mart
    out = R.category_share(f, d["dim_service"])
    for r in out.groupBy("cloud_provider").agg(F.sum("pct_of_provider_spend").alias("p")).collect():
        assert abs(r.p - 100.0) < 1.0


def test_zero_spend_provider_share_is_null(spark):
    rows = [fx.canon_row(cost_usd=5.0), fx.canon_row(cost_usd=-5.0, resource_id="credit")]
    c = fx.combined(spark, rows)
    out = R.category_share(fact_lines(c), D.build_dim_service(c)).collect()
    assert out[0].total_cost_usd == 0.0 and out[0].pct_of_provider_spend is None


def test_monthly_trend_year_and_last_months(spark, mart):
    f, d = mart
    y = R.monthly_trend(f, d["dim_date"], year=2025).collect()
    assert y and {r.year for r in y} == {"2025"}
    last = R.monthly_trend(f, d["dim_date"], year=None, last_months=3, as_of_month="2024-06").collect()
    assert {r.month for r in last} == {"04", "05", "06"}
    assert len(R.monthly_trend(f, d["dim_date"], limit=5).collect()) == 5


def test_top_services_limit_and_order(spark, mart):
    f, d = mart
    out = R.top_services(f, d["dim_service"]).collect()
    assert len(out) == 10
    totals = [r.total_cost_usd for r in out]
    assert totals == sorted(totals, reverse=True)


def test_weekend_rows_come_first(spark, mart):
    f, d = mart
    out = R.weekend_weekday(f, d["dim_date"]).collect()
    flags = [r.is_weekend for r in out]
    assert flags == sorted(flags, reverse=True)


def test_reports_exact_under_repartitioning(spark):
    c = combined_from_driver_tables(spark, SF_SMALL)
    a = R.spend_by_provider(fact_lines(c.repartition(1))).collect()
    b = R.spend_by_provider(fact_lines(c.repartition(37))).collect()
    assert a == b


@pytest.mark.parametrize("name", [k[len("sql_"):] for k in SQL_QUERIES])
def test_sql_form_equals_dataframe_form(spark, name):
    df = REPORT_QUERIES[name](spark, SF_SMALL).collect()
    sql = SQL_QUERIES[f"sql_{name}"](spark, SF_SMALL).collect()
    assert df == sql


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_python_evaluation_in_report_plans(spark, mart):
    f, d = mart
    for name, df in R.run_reports(f, d).items():
        p = _plan(df)
        assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p, name


def test_fact_is_aggregated_before_the_dimension_join(spark, mart):
    f, d = mart
    df = R.top_services(f, d["dim_service"])
    df.collect()
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    # the join's fact side is an Aggregate on service_key, not the raw fact rows
    join_at = plan.index("Join Inner")
    assert "Aggregate [service_key" in plan[join_at:]


def test_aiml_spend_orders_years_then_months(spark, mart):
    f, d = mart
    out = [(r.year, r.month) for r in R.aiml_spend(f, d["dim_service"], d["dim_date"]).collect()]
    assert out == sorted(out) and {y for y, _ in out} == {"2024", "2025"}


def test_last_months_on_empty_fact(spark, mart):
    f, d = mart
    out = R.monthly_trend(f.where(F.lit(False)), d["dim_date"], year=None, last_months=6)
    assert out.collect() == [] and out.columns == ["year", "month", "month_name", "cloud_provider",
                                                   "monthly_cost_usd"]


def test_rows_joined_with_a_dimension_stay_where_they_are(spark):
    """The planner knows how small a dimension is that rows are joined with: the rows are not exchanged by its few keys."""
    from costmart.plans.catalog import all_queries
    from tests.conftest import SF_SMALL

    threshold = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(threshold)
    spark.conf.set(threshold, "30k")  # below the size of the tables
    try:
        for name in ("sql_aiml_spend", "aiml_spend", "fact_lookup"):
            plan = all_queries()[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
            assert "SortMergeJoin" not in plan and "ShuffledHashJoin" not in plan, name
    finally:
        spark.conf.set(threshold, before)
