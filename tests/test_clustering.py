"""Pruning by calendar, z-order layout and the content check of the stored mart."""

import glob

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from costmart.operators import quality
from costmart.operators.clustering import with_z_order
from costmart.operators.fact import build_fact
from costmart.plans import loads, reports
from costmart.plans.mart import load_mart, report_views
from costmart.plans.sql_reports import run_sql_report
from costmart.session import local_path
from costmart.sinks import mart_store as store
from costmart.sources.layouts import AWS, GCP
from tests import fixtures as fx


def year_of_rows(spark, n=3_000):
    """Line items of two providers on every day of a year."""
    aws = [fx.aws_row(bill_date=f"2024-{1 + i % 12:02d}-{1 + i // 12 % 28:02d}", resource_id=f"r{i}", cost_usd=1.0 + i / 8) for i in range(n)]
    gcp = [fx.gcp_row(usage_date=f"2024-{1 + i % 12:02d}-{1 + i // 12 % 28:02d}", resource_name=f"g{i}", cost=2.0 + i / 4) for i in range(n // 4)]
    return [(AWS, fx.aws_raw(spark, aws)), (GCP, fx.gcp_raw(spark, gcp))]


@pytest.fixture(scope="module")
def base(spark):
    from costmart.session import scratch_path

    base = scratch_path(spark, "year")
    loads.full_load(spark, year_of_rows(spark), base)
    return base


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def months_read(df):
    """The month folders that the executed scan of the fact has read, by its own count."""
    df.collect()
    scans, todo = [], [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            todo.append(node.executedPlan())
        elif name.endswith("QueryStageExec"):
            todo.append(node.plan())
        elif name == "FileSourceScanExec" and "bill_month" in node.toString() and node.metrics().contains("numPartitions"):
            scans.append(node.metrics().apply("numPartitions").value())
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    return scans


@pytest.mark.parametrize("table", ["fact", "rollup"])
def test_calendar_filter_prunes_months(spark, base, table):
    mart = load_mart(spark, base)
    rows, days = getattr(mart, table), mart.dims["dim_date"].where("quarter = 'Q1'")
    for report in (reports.weekend_weekday(rows, days), reports.monthly_trend(rows, days),
                   reports.aiml_spend(rows, mart.dims["dim_service"], days),
                   reports.category_share(reports.on_days(rows, days), mart.dims["dim_service"])):
        assert max(months_read(report)) == 3
    # (a plan's text is cut where it has more filters)
    assert "dynamicpruningexpression" in plan_of(reports.weekend_weekday(rows, days))


def test_calendar_filter_prunes_months_in_sql(spark, base):
    report_views(spark, load_mart(spark, base))
    for name in ("weekend_weekday", "monthly_trend", "aiml_spend"):
        df = run_sql_report(spark, name, days="quarter = 'Q1'")
        assert max(months_read(df)) == 3
    with pytest.raises(ValueError):
        run_sql_report(spark, "top_services", days="quarter = 'Q1'")


def test_calendar_filter_keeps_results(spark, base):
    mart = load_mart(spark, base)
    days = mart.dims["dim_date"].where("is_weekend = 'true' AND month IN ('03', '04')")
    keys = [r.date_key for r in days.collect()]
    plain = mart.fact.where(F.col("date_key").isin(keys)).drop("bill_month")
    for on in (mart.fact, mart.rollup):
        assert reports.weekend_weekday(on, days).collect() == reports.weekend_weekday(plain, mart.dims["dim_date"]).collect()
        assert reports.spend_by_provider(reports.on_days(on, days)).collect() == reports.spend_by_provider(plain).collect()
    # an in-memory fact has no month; a calendar without a day gives no row
    assert reports.spend_by_provider(reports.on_days(plain, days)).collect() == reports.spend_by_provider(plain).collect()
    assert reports.weekend_weekday(mart.fact, days.where("month = '13'")).collect() == []


# --- layout --------------------------------------------------------------------------------------
def opened(base, column, value):
    """Files of a month whose minimum and maximum let a filter on ``column`` open them, and all its files."""
    files = glob.glob(local_path(base) + "/fact_cloud_costs/bill_month=2024-05/*.parquet")
    hits = 0
    for f in files:
        meta = pq.ParquetFile(f).metadata
        groups = [meta.row_group(g) for g in range(meta.num_row_groups)]
        stats = [g.column(i).statistics for g in groups for i in range(g.num_columns) if g.column(i).path_in_schema == column]
        hits += any(s.min <= value <= s.max for s in stats)
    return hits, len(files)


def one_month(spark, n=4_000):
    rows = [fx.canon_row(date_key=f"2024-05-{1 + i % 31:02d}", cloud_provider="GCP" if i // 31 % 4 == 0 else "AWS", resource_id=f"r{i}") for i in range(n)]
    return fx.combined(spark, rows)


def test_z_order_opens_fewer_files_for_each_column(spark, scratch):
    base = scratch("z")
    fact = build_fact(one_month(spark))
    by_day = fact.withColumn("bill_month", F.substring("date_key", 1, 7)).repartitionByRange(16, "date_key", F.xxhash64("cost_id"))
    by_day.write.partitionBy("bill_month").parquet(f"{base}/fact_cloud_costs")
    provider_before, files_before = opened(base, "cloud_provider", "GCP")
    assert provider_before == files_before == 16  # a sort by day serves no other column
    before = sorted(map(str, store.read_fact(spark, base).collect()))
    store.optimize_fact(spark, base, rows_per_file=250)
    assert sorted(map(str, store.read_fact(spark, base).collect())) == before
    provider_after, files_after = opened(base, "cloud_provider", "GCP")
    day_after, _ = opened(base, "date_key", "2024-05-09")
    assert files_after <= 20
    assert provider_after <= files_after / 2 and day_after <= files_after / 2
    assert store.unfinished_loads(spark, base) == []


def test_z_order_merges_appended_files(spark, scratch):
    base = scratch("merge")
    for number in range(1, 5):
        raw = fx.aws_raw(spark, [fx.aws_row(bill_date="2024-05-03", resource_id=f"{number}-{i}") for i in range(20)])
        loads.load_exports_into(spark, [(AWS, raw)], base, "daily", number)
    files = lambda: glob.glob(local_path(base) + "/fact_cloud_costs/*/*.parquet")
    ids = lambda: sorted(r.cost_id for r in store.read_fact(spark, base).collect())
    before, many = ids(), len(files())
    store.optimize_fact(spark, base, months=["2024-05"])
    assert ids() == before and len(files()) == 1 < many
    # a load behind it appends as before
    loads.load_exports_into(spark, [(AWS, fx.aws_raw(spark, [fx.aws_row(bill_date="2024-05-03", resource_id="new")]))], base, "daily", 9)
    assert len(ids()) == 81 and len(files()) == 2


def test_layout_run_that_broke_off_is_rebuilt(spark, scratch):
    """Broken off between removing a month and putting its new files there: the next load brings the month back."""
    base = scratch("broken-layout")
    loads.load_exports_into(spark, [(AWS, fx.aws_raw(spark, [fx.aws_row(bill_date="2024-05-03", resource_id=f"a{i}") for i in range(9)]))], base, "daily", 1)
    before = sorted(r.cost_id for r in store.read_fact(spark, base).collect())
    store.write_manifest(spark, base, store.LAYOUT_RUN, 0, {("-", "2024-05"): 9}, "begun")
    store.drop_months(spark, base, ["2024-05"])
    loads.load_exports_into(spark, [(AWS, fx.aws_raw(spark, [fx.aws_row(bill_date="2024-06-03")]))], base, "daily", 2)
    fact = store.read_fact(spark, base)
    assert sorted(r.cost_id for r in fact.where("bill_month = '2024-05'").collect()) == before
    assert fact.count() == 10 and store.unfinished_loads(spark, base) == []


def test_z_order_ranks(spark):
    """Texts with a shared beginning, skewed and NULL values, a constant column, and an empty table."""
    rows = spark.range(1_000).select(
        F.lit("m").alias("bill_month"), F.concat(F.lit("shared/prefix/"), F.lpad(F.col("id").cast("string"), 4, "0")).alias("a"),
        F.when(F.col("id") % 10 == 0, F.lit(None)).otherwise(F.col("id") % 2).cast("double").alias("b"), F.lit("same").alias("c"))
    z = with_z_order(rows, ("a",), bits=3)
    groups = z.groupBy("_z").agg(F.count("*").alias("n"), F.min("a").alias("lo"), F.max("a").alias("hi")).orderBy("_z").collect()
    assert len(groups) == 8 and all(100 <= g.n <= 150 for g in groups)
    assert all(x.hi < y.lo for x, y in zip(groups, groups[1:]))
    both = with_z_order(rows, ("b", "c"), bits=2).groupBy("b").agg(F.min("_z").alias("lo"), F.max("_z").alias("hi")).collect()
    assert {r.b: (r.lo, r.hi) for r in both}[None][0] == 0 and {r.b: r.lo for r in both}[1.0] > {r.b: r.hi for r in both}[0.0]
    assert with_z_order(rows, ("c",)).where("_z <> 0").count() == 0
    assert with_z_order(rows.where("false"), ("a", "b")).collect() == []
    with pytest.raises(ValueError):
        with_z_order(rows, ())


# --- content -------------------------------------------------------------------------------------
def check(fact, mart, landed):
    rules = {(r.table_name, r.rule): r for r in quality.validate_mart(fact, mart.dims, expected_fact_rows=landed, content=True).collect()}
    return rules["fact_cloud_costs", "one_row_per_line_item"].passed, rules["fact_cloud_costs", "same_content_per_month"]


def test_content_check_finds_a_swapped_row(spark, base):
    mart, landed = load_mart(spark, base), store.read_landing(spark, base)
    counts, rule = check(mart.fact, mart, landed)
    assert counts and rule.passed and rule.observed == 0
    # one row of May replaced by a second copy of another: as many rows, all keys known
    two = [r.cost_id for r in mart.fact.where("bill_month = '2024-05'").orderBy("cost_id").limit(2).collect()]
    swapped = mart.fact.where(F.col("cost_id") != two[0]).unionByName(mart.fact.where(F.col("cost_id") == two[1]))
    counts, rule = check(swapped, mart, landed)
    assert counts and not rule.passed and rule.observed == 1
    with pytest.raises(quality.ValidationFailed, match="same_content_per_month"):
        quality.raise_on_failures(quality.validate_mart(swapped, mart.dims, expected_fact_rows=landed, content=True))
    assert [tuple(r) for r in quality.months_with_other_content(swapped, landed).collect()] == [("2024-05", 313, 313)]


def test_content_check_finds_lost_doubled_and_missing_months(spark, base):
    mart, landed = load_mart(spark, base), store.read_landing(spark, base)
    lost = mart.fact.where("bill_month <> '2024-07'")
    assert [r.bill_month for r in quality.months_with_other_content(lost, landed).collect()] == ["2024-07"]
    doubled = mart.fact.unionByName(mart.fact.where("bill_month = '2024-02'"))
    found = quality.months_with_other_content(doubled, landed).collect()
    assert [(r.bill_month, r.fact_rows) for r in found] == [("2024-02", 2 * found[0].expected_rows)]
    extra = landed.where("date_key < '2024-12-01'")
    assert [tuple(r)[:1] for r in quality.months_with_other_content(mart.fact, extra).collect()] == [("2024-12",)]
    with pytest.raises(ValueError):
        quality.validate_mart(mart.fact, mart.dims, content=True)


def test_z_order_cuts_files_in_the_writer(spark, scratch, monkeypatch):
    """Files of few rows need no task each: one range here, cut into files of at most so many rows, compressed by zstd."""
    base, asked = scratch("cut"), []
    store.write_fact_months(build_fact(one_month(spark, 1_000)), base)
    from costmart.operators import clustering

    ordered = clustering.z_ordered
    monkeypatch.setattr(clustering, "z_ordered", lambda rows, columns, n, **k: asked.append(n) or ordered(rows, columns, n, **k))
    store.optimize_fact(spark, base, rows_per_file=30)
    files = [pq.ParquetFile(f).metadata for f in glob.glob(local_path(base) + "/fact_cloud_costs/*/*.parquet")]
    assert asked == [1] and sum(m.num_rows for m in files) == 1_000 and max(m.num_rows for m in files) <= 30
    assert {m.row_group(0).column(0).compression for m in files} == {"ZSTD"}
