"""Stored mart: round trip, layout, pruning, month reload, upsert, incremental ingest."""

import glob
import os

import pytest

from costmart.operators import dimensions as D
from costmart.operators.fact import build_fact
from costmart.plans import reports as R
from costmart.plans.mart import combined_from_driver_tables, load_mart
from costmart.schemas import DIM_DATE_SCHEMA, SchemaMismatch, assert_schema
from costmart.session import local_path
from costmart.sinks import mart_store
from costmart.sources.billing_csv import write_export
from costmart.sources.driver_tables import load_exports
from costmart.sources.layouts import AWS, GCP
from costmart.streaming.ingest import ingest_new_files
from tests import fixtures as fx
from tests.conftest import SF_SMALL


@pytest.fixture(scope="module")
def stored(spark):
    from costmart.session import scratch_path

    base = scratch_path(spark, "stored")
    c = combined_from_driver_tables(spark, SF_SMALL)
    mart_store.write_dimensions(c, base)
    mart_store.write_fact_months(build_fact(c), base)
    return base, c


def test_round_trip(spark, stored):
    base, c = stored
    mart = load_mart(spark, base)
    assert mart.fact.count() == c.count()
    assert sorted(mart.dims["dim_service"].collect()) == sorted(D.build_dim_service(c).collect())


def test_fact_is_month_partitioned_and_sorted(spark, stored):
    base, _ = stored
    months = sorted(os.path.basename(p) for p in glob.glob(local_path(base) + "/fact_cloud_costs/bill_month=*"))
    assert months[0] == "bill_month=2024-01" and len(months) > 12
    # inside each file, rows are in date order
    for path in glob.glob(local_path(base) + "/fact_cloud_costs/bill_month=*/*.parquet")[:5]:
        keys = [r.date_key for r in spark.read.parquet(path).select("date_key").collect()]
        assert keys == sorted(keys)


def test_month_filter_prunes_partitions(spark, stored):
    base, _ = stored
    mart = load_mart(spark, base)
    df = R.monthly_trend(mart.fact, mart.dims["dim_date"], year=2024)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(bill_month" in plan and "2024-01" in plan


def test_month_reload_leaves_mart_unchanged(spark, stored):
    from costmart.session import scratch_path

    _, c = stored
    base = scratch_path(spark, "reload")
    mart_store.write_fact_months(build_fact(c), base)
    before = sorted(mart_store.read_fact(spark, base).select("cost_id", "bill_month").collect())
    mart_store.write_fact_months(build_fact(c.where("date_key LIKE '2024-03-%'")), base)
    after = sorted(mart_store.read_fact(spark, base).select("cost_id", "bill_month").collect())
    assert before == after


def test_late_rows_change_only_their_month(spark, stored):
    from costmart.session import scratch_path

    _, c = stored
    base = scratch_path(spark, "late")
    mart_store.write_fact_months(build_fact(c), base)
    before = mart_store.read_fact(spark, base)
    other = sorted(before.where("bill_month <> '2024-02'").select("cost_id").collect())
    late = fx.combined(spark, [fx.canon_row(date_key="2024-02-03", resource_id="late-1")])
    mart_store.write_fact_months(build_fact(c.where("date_key LIKE '2024-02-%'").unionByName(late)), base)
    after = mart_store.read_fact(spark, base)
    assert sorted(after.where("bill_month <> '2024-02'").select("cost_id").collect()) == other
    assert after.where("bill_month = '2024-02'").count() == c.where("date_key LIKE '2024-02-%'").count() + 1


def test_upsert_latest_load_wins(spark, scratch):
    base = scratch("upsert")
    old = fx.combined(spark, [fx.canon_row(account_name="old")])
    new = fx.combined(spark, [fx.canon_row(date_key="2024-03-01", account_name="new"),
                              fx.canon_row(account_id="999", account_name="other")])
    mart_store.write_dimension(D.build_dim_account(old, True), base, "dim_account")
    mart_store.upsert_dimension(D.build_dim_account(new, True), base, "dim_account", load_id=1)
    rows = {r.account_id: r.account_name for r in mart_store.read_dimension(spark, base, "dim_account").collect()}
    assert rows == {"7001": "new", "999": "other"}
    # replaying the same load replaces itself
    mart_store.upsert_dimension(D.build_dim_account(new, True), base, "dim_account", load_id=1)
    assert mart_store.read_dimension(spark, base, "dim_account").count() == 2


def test_late_file_does_not_override_newer_account_attributes(spark, scratch):
    base = scratch("late-dim")
    newer = fx.combined(spark, [fx.canon_row(date_key="2024-05-01", account_name="renamed")])
    older = fx.combined(spark, [fx.canon_row(date_key="2024-01-01", account_name="original")])
    mart_store.write_dimension(D.build_dim_account(newer, True), base, "dim_account")
    mart_store.upsert_dimension(D.build_dim_account(older, True), base, "dim_account", load_id=1)
    assert mart_store.read_dimension(spark, base, "dim_account").first().account_name == "renamed"


def test_schema_assertion_refuses_wrong_schema(spark):
    with pytest.raises(SchemaMismatch):
        assert_schema(fx.combined(spark), DIM_DATE_SCHEMA)
    with pytest.raises(SchemaMismatch):
        mart_store.write_dimension(fx.combined(spark), "/nonexistent", "dim_date")


def test_incremental_ingest_takes_only_new_files(spark, scratch):
    root = scratch("ingest")
    base, state = f"{root}/mart", f"{root}/state"
    a, b = load_exports(spark, SF_SMALL)
    write_export(a.where("bill_date < '2024-06-01'"), f"{root}/inbox/aws/1")
    ingest_new_files(spark, AWS, f"{root}/inbox/aws/*/*.csv", base, state)
    n1 = mart_store.read_fact(spark, base).count()
    # a run with no new file changes nothing
    ingest_new_files(spark, AWS, f"{root}/inbox/aws/*/*.csv", base, state)
    assert mart_store.read_fact(spark, base).count() == n1
    write_export(a.where("bill_date >= '2024-06-01' OR bill_date IS NULL"), f"{root}/inbox/aws/2")
    write_export(b, f"{root}/inbox/gcp/1")
    ingest_new_files(spark, AWS, f"{root}/inbox/aws/*/*.csv", base, state)
    ingest_new_files(spark, GCP, f"{root}/inbox/gcp/*/*.csv", base, state)
    full = build_fact(combined_from_driver_tables(spark, SF_SMALL))
    got = mart_store.read_fact(spark, base).drop("bill_month")
    assert sorted(got.select("cost_id").collect()) == sorted(full.select("cost_id").collect())
    dims = load_mart(spark, base).dims
    assert dims["dim_account"].count() == 10


def test_validation_passes_and_fails(spark):
    from costmart.operators.quality import ValidationFailed, raise_on_failures, validate_mart

    c = fx.combined(spark)
    dims = D.build_dimensions(c)
    rows = raise_on_failures(validate_mart(build_fact(c), dims, expected_fact_rows=c))
    assert len(rows) == 16 and all(r.passed for r in rows)
    empty = {**dims, "dim_region": dims["dim_region"].where("false")}
    with pytest.raises(ValidationFailed, match="dim_region.not_empty"):
        raise_on_failures(validate_mart(build_fact(c), empty))


def test_compaction_keeps_current_rows(spark, scratch):
    base, new_base = scratch("compact-src"), scratch("compact-dst")
    for i, name in enumerate(["a", "b", "c"]):
        rows = fx.combined(spark, [fx.canon_row(date_key=f"2024-0{i + 1}-01", account_name=name)])
        mart_store.write_dimension(D.build_dim_account(rows, True), base, "dim_account", load_id=i)
    mart_store.compact_dimension(spark, base, "dim_account", new_base)
    assert mart_store.read_dimension(spark, new_base, "dim_account").first().account_name == "c"
    loads = spark.read.parquet(f"{new_base}/dim_account").select("load_id").distinct().count()
    assert loads == 1
    # a late load with older data still does not win after compaction
    old = fx.combined(spark, [fx.canon_row(date_key="2023-12-01", account_name="stale")])
    mart_store.upsert_dimension(D.build_dim_account(old, True), new_base, "dim_account", load_id=5)
    assert mart_store.read_dimension(spark, new_base, "dim_account").first().account_name == "c"


def test_run_pipeline_end_to_end(spark, scratch):
    from costmart.plans.mart import run_pipeline

    root = scratch("pipeline")
    a, b = load_exports(spark, SF_SMALL)
    write_export(a, f"{root}/aws")
    write_export(b, f"{root}/gcp")
    mart = run_pipeline(spark, f"{root}/aws", f"{root}/gcp", f"{root}/mart")
    got = R.spend_by_provider(mart.fact).collect()
    from costmart.operators.fact import fact_lines
    want = R.spend_by_provider(fact_lines(combined_from_driver_tables(spark, SF_SMALL))).collect()
    assert got == want
    assert {n: df.count() for n, df in mart.dims.items()}["dim_service"] == 29


def test_run_queries_over_stored_mart(spark, stored):
    from costmart.plans.sql_reports import run_queries

    base, c = stored
    out = run_queries(spark, base)
    assert set(out) == {"spend_by_provider", "top_services", "monthly_trend", "team_environment",
                        "region_spend", "geography_spend", "weekend_weekday", "category_share", "aiml_spend",
                        "tags_lookup", "net_gross_credits"}
    mart = load_mart(spark, base)
    assert out["category_share"].collect() == R.category_share(mart.fact, mart.dims["dim_service"]).collect()
    assert out["monthly_trend"].collect() == R.monthly_trend(mart.fact, mart.dims["dim_date"]).collect()


def test_replayed_micro_batch_replaces_itself(spark, scratch):
    """foreachBatch may run a batch again after a failure; the end state must not change."""
    from costmart.streaming.ingest import _process_batch, landed_rows

    base = f"{scratch('replay')}/mart"
    a, _ = load_exports(spark, SF_SMALL)
    run = _process_batch(spark, AWS, base, load_offset=0)
    run(a, 0)
    fact1 = sorted(mart_store.read_fact(spark, base).select("cost_id").collect())
    dims1 = {n: sorted(df.collect()) for n, df in load_mart(spark, base).dims.items()}
    run(a, 0)  # the same batch again
    assert sorted(mart_store.read_fact(spark, base).select("cost_id").collect()) == fact1
    assert {n: sorted(df.collect()) for n, df in load_mart(spark, base).dims.items()} == dims1
    assert landed_rows(spark, base).count() == normalize_count(a)
    assert mart_store.read_load_counts(spark, base).count() == 1


def normalize_count(raw):
    from costmart.operators.normalize import normalize

    return normalize(raw, AWS).count()


def test_reports_from_rollup_equal_reports_from_fact(spark, stored):
    base, _ = stored
    mart_store.write_rollup_months(spark, base)
    mart = load_mart(spark, base)
    assert mart.rollup is not None and mart.rollup.count() < mart.fact.count()
    from_fact = R.run_reports(mart.fact, mart.dims)
    from_rollup = R.run_reports(mart.rollup, mart.dims)
    for name in from_fact:
        assert from_fact[name].collect() == from_rollup[name].collect(), name
    assert R.tag_spend(mart.fact).collect() == R.tag_spend(mart.rollup).collect()
    assert R.net_gross_credits(mart.fact).collect() == R.net_gross_credits(mart.rollup).collect()
    # the year-bounded report prunes rollup month folders too
    plan = R.monthly_trend(mart.rollup, mart.dims["dim_date"])._jdf.queryExecution().executedPlan().toString()
    import re
    assert re.search(r"PartitionFilters: \[[^\]]*bill_month[^\]]*2024-01", plan)


def test_ingest_keeps_rollup_in_step(spark, scratch):
    root = scratch("ingest-rollup")
    base, state = f"{root}/mart", f"{root}/state"
    a, b = load_exports(spark, SF_SMALL)
    write_export(a.where("bill_date < '2024-06-01'"), f"{root}/inbox/aws/1")
    ingest_new_files(spark, AWS, f"{root}/inbox/aws/*/*.csv", base, state)
    write_export(a.where("bill_date >= '2024-06-01' OR bill_date IS NULL"), f"{root}/inbox/aws/2")
    write_export(b, f"{root}/inbox/gcp/1")
    from costmart.streaming.ingest import ingest_all

    ingest_all(spark, [(AWS, f"{root}/inbox/aws/*/*.csv"), (GCP, f"{root}/inbox/gcp/*/*.csv")], base, state)
    mart = load_mart(spark, base)
    assert R.spend_by_provider(mart.rollup).collect() == R.spend_by_provider(mart.fact).collect()
    assert R.net_gross_credits(mart.rollup).collect() == R.net_gross_credits(mart.fact).collect()


def test_validation_scans_the_fact_once(spark, stored):
    from costmart.operators.quality import validate_mart

    base, c = stored
    mart = load_mart(spark, base)
    df = validate_mart(mart.fact, mart.dims, expected_fact_rows=c)
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("cost_id") == 1  # the one relation that has it; no operator above asks for it


def test_validation_finds_orphans_and_repeated_keys(spark):
    from costmart.operators.quality import validate_mart

    c = fx.combined(spark)
    dims = D.build_dimensions(c)
    fact = build_fact(c)
    dims["dim_service"] = dims["dim_service"].where("service_name <> 'Amazon S3'")
    dims["dim_region"] = dims["dim_region"].unionAll(dims["dim_region"])
    rows = {(r.table_name, r.rule): r for r in validate_mart(fact, dims, c.limit(0)).collect()}
    assert not rows["fact_cloud_costs", "no_orphans_dim_service"].passed
    assert not rows["dim_region", "unique_keys"].passed
    assert not rows["fact_cloud_costs", "one_row_per_line_item"].passed
    assert rows["fact_cloud_costs", "no_orphans_dim_date"].passed


def test_late_file_after_a_batch_load_keeps_the_batch_rows(spark, scratch):
    from costmart.plans.loads import full_load

    base = scratch("late-file")
    a, b = load_exports(spark, SF_SMALL)
    full_load(spark, [(AWS, a), (GCP, b)], base)
    n = mart_store.read_fact(spark, base).count()
    january = mart_store.read_fact(spark, base).where("bill_month = '2024-01'").count()
    write_export(fx.aws_raw(spark, [fx.aws_row(bill_date="2024-01-09", resource_id=f"late-{i}") for i in range(5)]), f"{base}-in/1")
    ingest_new_files(spark, AWS, f"{base}-in/*/*.csv", base, f"{base}-state")
    assert mart_store.read_fact(spark, base).count() == n + 5
    assert mart_store.read_fact(spark, base).where("bill_month = '2024-01'").count() == january + 5


def test_export_without_a_kept_row_does_not_block_the_stream(spark, scratch):
    base = scratch("all-dropped")
    write_export(fx.aws_raw(spark, [fx.aws_row(cost_usd=None)]), f"{base}-in/1")
    ingest_new_files(spark, AWS, f"{base}-in/*/*.csv", base, f"{base}-state")
    write_export(fx.aws_raw(spark, [fx.aws_row()]), f"{base}-in/2")
    ingest_new_files(spark, AWS, f"{base}-in/*/*.csv", base, f"{base}-state")
    assert mart_store.read_fact(spark, base).count() == 1
    counts = sorted((r.load, r.kept_rows, r.dropped_rows) for r in mart_store.read_load_counts(spark, base).collect())
    assert counts == [(1, 0, 1), (2, 1, 0)]
    assert [r.reason for r in mart_store.read_quarantine(spark, base).collect()] == ["null_cost"]


def test_incremental_load_refuses_a_fact_without_landed_rows(spark, scratch):
    from costmart.plans.loads import load_exports_into

    base = scratch("no-landing")
    mart_store.write_fact_months(build_fact(fx.combined(spark)), base)
    with pytest.raises(ValueError, match="landed"):
        load_exports_into(spark, [(AWS, fx.aws_raw(spark))], base, source="x", load=1)


def test_rollup_is_not_used_while_it_disagrees(spark, scratch):
    base = scratch("rollup-state")
    mart_store.write_fact_months(build_fact(fx.combined(spark)), base)
    assert mart_store.read_rollup(spark, base) is None
    mart_store.write_rollup_months(spark, base)
    assert mart_store.read_rollup(spark, base) is not None
    mart_store._mark_rollup(spark, base, False)  # as after a load that broke off in between
    assert mart_store.read_rollup(spark, base) is None


def test_same_day_ties_do_not_depend_on_the_order_of_loads(spark, scratch):
    alpha = fx.combined(spark, [fx.canon_row(team="alpha")])
    zeta = fx.combined(spark, [fx.canon_row(team="zeta")])
    want = D.build_dim_account(alpha.unionByName(zeta)).first().team
    for first, second in ((alpha, zeta), (zeta, alpha)):
        base = scratch("ties")
        mart_store.write_dimension(D.build_dim_account(first, True), base, "dim_account", load_id=1, source="a")
        mart_store.write_dimension(D.build_dim_account(second, True), base, "dim_account", load_id=1, source="b")
        assert mart_store.read_dimension(spark, base, "dim_account").first().team == want


def test_a_day_lies_in_few_files_of_its_month(spark, scratch):
    """A month written by many tasks: each day's rows of a provider are in one or two files."""
    from pyspark.sql import functions as F

    base = scratch("layout")
    rows = [fx.canon_row(date_key=f"2024-01-{1 + i % 30:02d}", resource_id=f"r{i}") for i in range(3000)]
    confs = {"spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k) for k in confs}
    for k, v in confs.items():
        spark.conf.set(k, v)
    try:
        mart_store.write_fact_months(build_fact(fx.combined(spark, rows)), base)
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    fact = mart_store.read_fact(spark, base).withColumn("file", F.input_file_name())
    assert fact.select("file").distinct().count() > 4
    per_day = fact.groupBy("date_key", "cloud_provider").agg(F.countDistinct("file").alias("n"))
    assert per_day.agg(F.max("n")).first()[0] <= 2
