"""The reports as Spark SQL text over the five mart views.

Same results as ``plans.reports``. Each statement sums the fact per join key in a CTE before
joining the dimension (Catalyst does not push an aggregate below a join by itself), so the fact
is aggregated map side and never shuffled whole; the year-bounded report also bounds the month
partition column, so month folders outside the year are pruned. Register the views with
``plans.mart.report_views``, whose fact and date views have the month (joined beside the day, so that a filter on the
calendar prunes month folders, too) and whose fact view also has the parts of each cost that
``functions.money`` adds up (``cost_units``, ``cost_d6``, ``cost_d11``, ``cost_d16`` and ``cost_rest``), and call ``run_sql_report``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def _sum(part: str, rows: str = "") -> str:
    """The sum of a part of the costs, of the rows that meet a condition."""
    return f"COALESCE(SUM({part}) FILTER (WHERE {rows}), 0)" if rows else f"COALESCE(SUM({part}), 0)"


def _exact(rows: str = "") -> str:
    out = f"CAST({_sum('cost_units', rows)} AS DECIMAL(35,16))"
    for part, weight in (("cost_d6", "0.000001BD"), ("cost_d11", "0.00000000001BD"), ("cost_d16", "0.0000000000000001BD")):
        out += f" + CAST(CAST({_sum(part, rows)} AS DECIMAL(19,0)) * {weight} AS DECIMAL(30,16))"
    return f"CAST({out} AS DECIMAL(38,16))"


S = f"{_exact()} AS s, SUM(cost_rest) AS x"


def _total(s: str, x: str, digits: int) -> str:
    return f"CASE WHEN {x} = 0 THEN CAST(ROUND({s}, {digits}) AS DOUBLE) ELSE ROUND(CAST({s} AS DOUBLE) + {x}, {digits}) END"


T2 = _total("SUM(f.s)", "SUM(f.x)", 2)
AMOUNT = "(CAST(SUM(f.s) AS DOUBLE) + SUM(f.x))"
PROVIDER_AMOUNT = ("(CAST(SUM(SUM(f.s)) OVER (PARTITION BY f.cloud_provider) AS DOUBLE) "
                   "+ SUM(SUM(f.x)) OVER (PARTITION BY f.cloud_provider))")


def _ratio(num: str, den: str, digits: int) -> str:
    q = f"CAST({num} AS DOUBLE) / NULLIF(CAST({den} AS DOUBLE), 0)"
    return f"COALESCE(CAST(ROUND(TRY_CAST({q} AS DECIMAL(38,10)), {digits}) AS DOUBLE), {q})"


SQL_REPORTS = {
    "spend_by_provider": f"""
SELECT cloud_provider, {_total(_exact(), 'SUM(cost_rest)', 2)} AS total_cost_usd, COUNT(*) AS num_line_items
FROM fact_cloud_costs
GROUP BY cloud_provider
ORDER BY total_cost_usd DESC, cloud_provider""",

    "top_services": f"""
WITH f AS (SELECT service_key, {S} FROM fact_cloud_costs GROUP BY service_key)
SELECT d.cloud_provider, d.service_name, d.service_category, {T2} AS total_cost_usd
FROM f JOIN dim_service d ON f.service_key = d.service_key
GROUP BY d.cloud_provider, d.service_name, d.service_category
ORDER BY total_cost_usd DESC, d.cloud_provider, d.service_name, d.service_category
LIMIT 10""",

    "monthly_trend": f"""
WITH f AS (SELECT date_key, bill_month, cloud_provider, {S} FROM fact_cloud_costs
           WHERE date_key BETWEEN '2024-01-01' AND '2024-12-31'
             AND bill_month BETWEEN '2024-01' AND '2024-12'
           GROUP BY date_key, bill_month, cloud_provider)
SELECT d.year, d.month, d.month_name, f.cloud_provider, {T2} AS monthly_cost_usd
FROM f JOIN dim_date d ON f.date_key = d.date_key AND f.bill_month = d.bill_month
WHERE d.year = '2024'
GROUP BY d.year, d.month, d.month_name, f.cloud_provider
ORDER BY d.year, d.month, f.cloud_provider""",

    "team_environment": f"""
WITH f AS (SELECT account_key, {S} FROM fact_cloud_costs GROUP BY account_key)
SELECT a.team, a.environment, a.cloud_provider, {T2} AS total_cost_usd
FROM f JOIN dim_account a ON f.account_key = a.account_key
GROUP BY a.team, a.environment, a.cloud_provider
ORDER BY total_cost_usd DESC, a.team, a.environment, a.cloud_provider""",

    "region_spend": f"""
WITH f AS (SELECT region_key, cloud_provider, {S} FROM fact_cloud_costs
           GROUP BY region_key, cloud_provider)
SELECT r.geography, r.region_name, f.cloud_provider, {T2} AS total_cost_usd
FROM f JOIN dim_region r ON f.region_key = r.region_key
GROUP BY r.geography, r.region_name, f.cloud_provider
ORDER BY total_cost_usd DESC, r.geography, r.region_name, f.cloud_provider""",

    "geography_spend": f"""
WITH f AS (SELECT region_key, cloud_provider, {S}, COUNT(*) AS n FROM fact_cloud_costs
           GROUP BY region_key, cloud_provider)
SELECT r.geography, f.cloud_provider, {T2} AS total_cost_usd,
       {_ratio(AMOUNT, 'SUM(f.n)', 4)} AS avg_cost_per_line_item
FROM f JOIN dim_region r ON f.region_key = r.region_key
GROUP BY r.geography, f.cloud_provider
ORDER BY total_cost_usd DESC, r.geography, f.cloud_provider""",

    "weekend_weekday": f"""
WITH f AS (SELECT date_key, bill_month, cloud_provider, {S}, COUNT(*) AS n FROM fact_cloud_costs
           GROUP BY date_key, bill_month, cloud_provider)
SELECT d.is_weekend, d.day_of_week, f.cloud_provider, {T2} AS total_cost_usd,
       {_ratio(AMOUNT, 'SUM(f.n)', 4)} AS avg_line_item_cost, SUM(f.n) AS num_line_items
FROM f JOIN dim_date d ON f.date_key = d.date_key AND f.bill_month = d.bill_month
GROUP BY d.is_weekend, d.day_of_week, f.cloud_provider
ORDER BY d.is_weekend DESC, total_cost_usd DESC, d.day_of_week, f.cloud_provider""",

    "category_share": f"""
WITH f AS (SELECT service_key, cloud_provider, {S} FROM fact_cloud_costs
           GROUP BY service_key, cloud_provider)
SELECT s.service_category, f.cloud_provider, {T2} AS total_cost_usd,
       {_ratio(AMOUNT + ' * 100', PROVIDER_AMOUNT, 1)} AS pct_of_provider_spend
FROM f JOIN dim_service s ON f.service_key = s.service_key
GROUP BY s.service_category, f.cloud_provider
ORDER BY f.cloud_provider, total_cost_usd DESC, s.service_category""",

    "tags_lookup": f"""
SELECT tags['team'] AS team, {_total(_exact(), 'SUM(cost_rest)', 2)} AS total_cost_usd, COUNT(*) AS num_line_items
FROM fact_cloud_costs
GROUP BY tags['team']
ORDER BY total_cost_usd DESC, team""",

    "net_gross_credits": f"""
SELECT cloud_provider,
       {_total(_exact('cost_usd > 0'), _sum('cost_rest', 'cost_usd > 0'), 2)} AS gross_cost_usd,
       {_total(_exact('cost_usd < 0'), _sum('cost_rest', 'cost_usd < 0'), 2)} AS credits_usd,
       {_total(_exact(), 'SUM(cost_rest)', 2)} AS net_cost_usd,
       COUNT_IF(cost_usd < 0) AS num_credit_items
FROM fact_cloud_costs
GROUP BY cloud_provider
ORDER BY cloud_provider""",

    "aiml_spend": f"""
WITH f AS (SELECT service_key, date_key, bill_month, cloud_provider, {S} FROM fact_cloud_costs
           LEFT SEMI JOIN (SELECT service_key FROM dim_service WHERE service_category = 'AI/ML') USING (service_key)
           GROUP BY service_key, date_key, bill_month, cloud_provider)
SELECT d.year, d.month, d.month_name, s.service_name, f.cloud_provider, {T2} AS ai_spend_usd
FROM f
JOIN dim_service s ON f.service_key = s.service_key
JOIN dim_date d ON f.date_key = d.date_key AND f.bill_month = d.bill_month
WHERE s.service_category = 'AI/ML'
GROUP BY d.year, d.month, d.month_name, s.service_name, f.cloud_provider
ORDER BY d.year, d.month, ai_spend_usd DESC, s.service_name, f.cloud_provider""",
}


def run_sql_report(spark: SparkSession, name: str, limit: int | None = None, days: str | None = None) -> DataFrame:
    """Run one report over the registered views (lazy: returns the planned DataFrame), or its first
    ``limit`` rows. ``days`` is a condition on ``dim_date``'s columns, such as ``quarter = 'Q1'``; only reports that join
    the calendar take one."""
    sql = SQL_REPORTS[name]
    if days:
        if "JOIN dim_date" not in sql:
            raise ValueError(f"{name} has no calendar to restrict")
        sql = sql.replace("WITH ", f"WITH dim_date AS (SELECT * FROM dim_date WHERE {days}),\n", 1)
    return spark.sql(sql + (f"\nLIMIT {int(limit)}" if limit else ""))


def run_queries(spark: SparkSession, base: str, names: list[str] | None = None) -> dict[str, DataFrame]:
    """Load the stored mart at ``base``, register its five tables as views and plan the SQL
    reports (all, or ``names``). Returns lazy DataFrames; nothing is printed or collected."""
    from costmart.plans.mart import load_mart, report_views

    report_views(spark, load_mart(spark, base))
    return {n: run_sql_report(spark, n) for n in (names or list(SQL_REPORTS))}
