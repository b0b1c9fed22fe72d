"""Cost reports as DataFrame plans.

Every report joins the fact to a dimension and then groups by dimension attributes. Each
dimension has exactly one row per key, so the fact can be summed per key *before* the join: the
fact side is aggregated map side down to (keys x tasks) rows, the join is between two small
frames, and the fact itself is never shuffled or broadcast, whatever its size. Sums are exact
decimals (``functions.money``), so pre-aggregation does not change a single cent.

``fact`` is any frame with the fact columns: the stored table (with its ``bill_month`` partition
column, which the date-bounded reports use for partition pruning) or ``operators.fact.fact_lines``,
or the daily rollup (``operators.rollup``), from which every report gives the same result.
Inner joins, as in the reference SQL: a fact row whose key has no dimension row is not reported.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from costmart.functions.dates import bill_month, year_bounds
from costmart.functions.money import amount, limb_sums, money_sums, rounded_ratio, total, with_limbs
from costmart.operators.rollup import is_rollup

COST = "cost_usd"


def _sum_by(fact: DataFrame, *keys: str, with_count: bool = False) -> DataFrame:
    if is_rollup(fact):  # partial sums already: add them up
        aggs = [F.sum("cost_sum").alias("s"), F.sum("cost_rest").alias("x")]
        aggs += [F.sum("line_items").alias("n")] if with_count else []
    else:
        aggs = money_sums(COST) + ([F.count(F.lit(1)).alias("n")] if with_count else [])
    return fact.groupBy(*keys).agg(*aggs)


def _regroup(pre: DataFrame, *keys, with_count: bool = False) -> DataFrame:
    aggs = [F.sum("s").alias("s"), F.sum("x").alias("x")]
    if with_count:
        aggs.append(F.sum("n").alias("n"))
    return pre.groupBy(*keys).agg(*aggs)


def restrict_dates(fact: DataFrame, first_day: str, last_day: str) -> DataFrame:
    """Keep ``first_day <= date_key <= last_day``; on the stored table also bound ``bill_month``
    so whole month folders are skipped (Catalyst cannot derive one predicate from the other)."""
    out = fact.where(F.col("date_key").between(first_day, last_day))
    if "bill_month" in fact.columns:
        out = out.where(F.col("bill_month").between(first_day[:7], last_day[:7]))
    return out


def _month_key(fact: DataFrame) -> list[str]:
    """The month of a stored table's rows, which the day implies: as a grouping key it adds no group."""
    return ["bill_month"] if "bill_month" in fact.columns else []


def _with_month(days: DataFrame) -> DataFrame:
    return days if "bill_month" in days.columns else days.withColumn("bill_month", bill_month("date_key"))


def _join_days(pre: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Join sums per day with the calendar; over a stored table by month as well, so that whatever filter ``dim_date``
    has (a quarter, weekends of one month) prunes the table's month folders at run time."""
    if "bill_month" not in pre.columns:
        return pre.join(dim_date, "date_key")
    return pre.join(_with_month(dim_date), ["date_key", "bill_month"])


def on_days(fact: DataFrame, days: DataFrame) -> DataFrame:
    """The rows of a fact or rollup on the days that ``days`` (a filtered ``dim_date``) has, for reports that have no
    calendar of their own. Of a stored table only the months of those days are read. ``days`` has at most a row per calendar
    day; how it is joined is left to the planner."""
    keys = ["date_key", *_month_key(fact)]
    return fact.join(_with_month(days).select(*keys).distinct(), keys, "left_semi")


# R1 ------------------------------------------------------------------------------------------
def spend_by_provider(fact: DataFrame) -> DataFrame:
    return (_sum_by(fact, "cloud_provider", with_count=True)
            .select("cloud_provider", total(2).alias("total_cost_usd"),
                    F.col("n").alias("num_line_items"))
            .orderBy(F.desc("total_cost_usd"), "cloud_provider"))


# R2 ------------------------------------------------------------------------------------------
def top_services(fact: DataFrame, dim_service: DataFrame, n: int = 10) -> DataFrame:
    pre = _sum_by(fact, "service_key").join(dim_service, "service_key")
    return (_regroup(pre, "cloud_provider", "service_name", "service_category")
            .select("cloud_provider", "service_name", "service_category",
                    total(2).alias("total_cost_usd"))
            .orderBy(F.desc("total_cost_usd"), "cloud_provider", "service_name", "service_category")
            .limit(n))


# R3 ------------------------------------------------------------------------------------------
def monthly_trend(fact: DataFrame, dim_date: DataFrame, year: int | None = 2024,
                  last_months: int | None = None, as_of_month: str | None = None,
                  limit: int | None = None) -> DataFrame:
    """Spend per month and provider, for one calendar year (the reference's filter) or, with
    ``last_months``, for the months ``as_of_month - last_months + 1 .. as_of_month``
    (``as_of_month`` defaults to the latest month in ``dim_date``, which has a row for every day of
    the fact, so finding it does not scan the fact)."""
    d = dim_date
    if last_months:
        if as_of_month is None:
            latest = dim_date.agg(F.max("date_key")).first()[0]  # one scalar
            if latest is None:  # no data: an empty report of the same shape
                return monthly_trend(fact, dim_date.where(F.lit(False)), year=2000, limit=limit)
            as_of_month = latest[:7]
        y, m = int(as_of_month[:4]), int(as_of_month[5:7])
        k = y * 12 + (m - 1) - (last_months - 1)
        first = f"{k // 12:04d}-{k % 12 + 1:02d}"
        f = restrict_dates(fact, first + "-01", as_of_month + "-31")
        d = d.where(F.substring("date_key", 1, 7).between(first, as_of_month))
    else:
        lo, hi = year_bounds(year)
        f = restrict_dates(fact, lo, hi)
        d = d.where(F.col("year") == F.lit(str(year)))
    pre = _join_days(_sum_by(f, "date_key", *_month_key(f), "cloud_provider"), d)
    out = (_regroup(pre, "year", "month", "month_name", "cloud_provider")
           .select("year", "month", "month_name", "cloud_provider", total(2).alias("monthly_cost_usd"))
           .orderBy("year", "month", "cloud_provider"))
    return out.limit(limit) if limit else out


# R4 ------------------------------------------------------------------------------------------
def team_environment(fact: DataFrame, dim_account: DataFrame) -> DataFrame:
    pre = _sum_by(fact, "account_key").join(dim_account, "account_key")
    return (_regroup(pre, "team", "environment", "cloud_provider")
            .select("team", "environment", "cloud_provider", total(2).alias("total_cost_usd"))
            .orderBy(F.desc("total_cost_usd"), "team", "environment", "cloud_provider"))


# R5a -----------------------------------------------------------------------------------------
def region_spend(fact: DataFrame, dim_region: DataFrame) -> DataFrame:
    pre = (_sum_by(fact, "region_key", "cloud_provider")
           .join(dim_region.drop("cloud_provider"), "region_key"))
    return (_regroup(pre, "geography", "region_name", "cloud_provider")
            .select("geography", "region_name", "cloud_provider", total(2).alias("total_cost_usd"))
            .orderBy(F.desc("total_cost_usd"), "geography", "region_name", "cloud_provider"))


# R5b -----------------------------------------------------------------------------------------
def geography_spend(fact: DataFrame, dim_region: DataFrame) -> DataFrame:
    pre = (_sum_by(fact, "region_key", "cloud_provider", with_count=True)
           .join(dim_region.drop("cloud_provider"), "region_key"))
    return (_regroup(pre, "geography", "cloud_provider", with_count=True)
            .select("geography", "cloud_provider", total(2).alias("total_cost_usd"),
                    rounded_ratio(amount(F.col("s"), F.col("x")), F.col("n"), 4).alias("avg_cost_per_line_item"))
            .orderBy(F.desc("total_cost_usd"), "geography", "cloud_provider"))


# R6 ------------------------------------------------------------------------------------------
def weekend_weekday(fact: DataFrame, dim_date: DataFrame) -> DataFrame:
    pre = _join_days(_sum_by(fact, "date_key", *_month_key(fact), "cloud_provider", with_count=True), dim_date)
    return (_regroup(pre, "is_weekend", "day_of_week", "cloud_provider", with_count=True)
            .select("is_weekend", "day_of_week", "cloud_provider",
                    total(2).alias("total_cost_usd"),
                    rounded_ratio(amount(F.col("s"), F.col("x")), F.col("n"), 4).alias("avg_line_item_cost"),
                    F.col("n").alias("num_line_items"))
            .orderBy(F.desc("is_weekend"), F.desc("total_cost_usd"), "day_of_week", "cloud_provider"))


# R7 ------------------------------------------------------------------------------------------
def category_share(fact: DataFrame, dim_service: DataFrame) -> DataFrame:
    """Category spend and its share of the provider's net spend, in percent (NULL when the
    provider's spend sums to zero). The window runs on the grouped rows only."""
    pre = (_sum_by(fact, "service_key", "cloud_provider")
           .join(dim_service.drop("cloud_provider"), "service_key"))
    by_cat = _regroup(pre, "service_category", "cloud_provider")
    provider = Window.partitionBy("cloud_provider")
    provider_total = amount(F.sum("s").over(provider), F.sum("x").over(provider))
    return (by_cat
            .select("service_category", "cloud_provider", total(2).alias("total_cost_usd"),
                    rounded_ratio(amount(F.col("s"), F.col("x")) * 100, provider_total, 1).alias("pct_of_provider_spend"))
            .orderBy("cloud_provider", F.desc("total_cost_usd"), "service_category"))


# R8 ------------------------------------------------------------------------------------------
def aiml_spend(fact: DataFrame, dim_service: DataFrame, dim_date: DataFrame,
               category: str = "AI/ML") -> DataFrame:
    svc = dim_service.where(F.col("service_category") == category).select("service_key", "service_name")
    # the few matching services first, so only their line items reach the aggregate
    of_services = fact.join(svc.select("service_key"), "service_key", "left_semi")
    pre = _join_days(_sum_by(of_services, "service_key", "date_key", *_month_key(fact), "cloud_provider").join(svc, "service_key"), dim_date)
    return (_regroup(pre, "year", "month", "month_name", "service_name", "cloud_provider")
            .select("year", "month", "month_name", "service_name", "cloud_provider",
                    total(2).alias("ai_spend_usd"))
            .orderBy("year", "month", F.desc("ai_spend_usd"), "service_name", "cloud_provider"))


# E9: tag-based spend ---------------------------------------------------------------------------
def tag_spend(fact: DataFrame, tag: str = "team") -> DataFrame:
    """Spend by one key of the ``tags`` map (the line item's own tag, not the account's)."""
    if is_rollup(fact):
        grouped = (fact.groupBy(F.col(f"tag_{tag}").alias(tag))
                   .agg(F.sum("cost_sum").alias("s"), F.sum("cost_rest").alias("x"),
                        F.sum("line_items").alias("num_line_items")))
    else:
        grouped = (fact.groupBy(F.col("tags")[tag].alias(tag))
                   .agg(*money_sums(COST), F.count(F.lit(1)).alias("num_line_items")))
    return (grouped
            .select(tag, total(2).alias("total_cost_usd"), "num_line_items")
            .orderBy(F.desc("total_cost_usd"), tag))


# E8: net against gross -------------------------------------------------------------------------
def net_gross_credits(fact: DataFrame) -> DataFrame:
    """Gross spend (positive items), credits (negative items) and net spend per provider."""
    c = F.col(COST)
    parts = {"gross": c > 0, "credit": c < 0, "cost": None}
    if is_rollup(fact):
        aggs = [F.sum(f"{p}_{k}").alias(f"{p}_{k}") for p in parts for k in ("sum", "rest")]
        aggs.append(F.sum("credit_items").alias("num_credit_items"))
    else:
        fact = with_limbs(fact)
        aggs = [a for p, rows in parts.items() for a in limb_sums(f"{p}_sum", f"{p}_rest", rows)]
        aggs.append(F.count_if(c < 0).alias("num_credit_items"))
    return (fact.groupBy("cloud_provider").agg(*aggs)
            .select("cloud_provider", total(2, "gross_sum", "gross_rest").alias("gross_cost_usd"),
                    total(2, "credit_sum", "credit_rest").alias("credits_usd"),
                    total(2, "cost_sum", "cost_rest").alias("net_cost_usd"), "num_credit_items")
            .orderBy("cloud_provider"))


def run_reports(fact: DataFrame, dims: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """All reports over one fact and its dimensions (lazy; nothing runs until an action)."""
    return {
        "spend_by_provider": spend_by_provider(fact),
        "top_services": top_services(fact, dims["dim_service"]),
        "monthly_trend": monthly_trend(fact, dims["dim_date"]),
        "team_environment": team_environment(fact, dims["dim_account"]),
        "region_spend": region_spend(fact, dims["dim_region"]),
        "geography_spend": geography_spend(fact, dims["dim_region"]),
        "weekend_weekday": weekend_weekday(fact, dims["dim_date"]),
        "category_share": category_share(fact, dims["dim_service"]),
        "aiml_spend": aiml_spend(fact, dims["dim_service"], dims["dim_date"]),
    }
