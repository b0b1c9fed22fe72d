"""Loads by file and by difference: appended, replayed, broken off, delivered twice."""

import glob
import os
import shutil
from functools import reduce

import pytest
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from costmart.operators.fact import build_fact, repeated_fingerprints
from costmart.plans import loads, reports
from costmart.plans.mart import load_mart
from costmart.session import local_path
from costmart.sinks import mart_store as store
from costmart.sources.billing_csv import write_export
from costmart.sources.layouts import AWS
from costmart.streaming.ingest import ingest_new_files
from tests import fixtures as fx


def rows(spark, n, month="2024-01", copies=1, first=0):
    return fx.aws_raw(spark, [fx.aws_row(bill_date=f"{month}-{1 + i % 28:02d}", resource_id=f"r{i}") for i in range(first, first + n)] * copies)


def load(spark, base, raw, number, source="daily"):
    return loads.load_exports_into(spark, [(AWS, raw)], base, source, number)


def ids(spark, base):
    return sorted(r.cost_id for r in store.read_fact(spark, base).select("cost_id").collect())


def check_against_full_build(spark, base):
    full = build_fact(store.read_landing(spark, base))
    assert ids(spark, base) == sorted(r.cost_id for r in full.select("cost_id").collect())
    mart = load_mart(spark, base)
    assert mart.rollup is not None
    assert reports.spend_by_provider(mart.rollup).collect() == reports.spend_by_provider(mart.fact).collect()


def fact_files(base):
    return {p: os.path.getmtime(p) for p in glob.glob(local_path(base) + "/fact_cloud_costs/*/*.parquet")}


def test_append_keeps_files_and_numbers_copies(spark, scratch):
    base = scratch("append")
    load(spark, base, rows(spark, 40, copies=2), 1)
    before = fact_files(base)
    # copies of stored rows, copies among themselves, new rows, and another month
    load(spark, base, rows(spark, 60, copies=3, first=20).unionByName(rows(spark, 5, "2024-02")), 2)
    after = fact_files(base)
    assert {p: after.get(p) for p in before} == before and len(after) > len(before)
    assert store.read_fact(spark, base).count() == 80 + 180 + 5
    check_against_full_build(spark, base)


def test_append_without_stored_counts(spark, scratch):
    """A mart whose earlier loads have no stored fingerprint counts: they are taken from the landed rows."""
    base = scratch("old-mart")
    load(spark, base, rows(spark, 10), 1)
    shutil.rmtree(local_path(f"{base}/{store.COPIES}"))
    load(spark, base, rows(spark, 15), 2)
    assert store.read_fact(spark, base).count() == 25
    check_against_full_build(spark, base)


def test_shorter_replay_takes_back_everything(spark, scratch):
    base = scratch("shorter")
    bad = fx.aws_raw(spark, [fx.aws_row(cost_usd=None)])
    load(spark, base, rows(spark, 8).unionByName(rows(spark, 9, "2024-02")).unionByName(rows(spark, 3, "2024-03")).unionByName(bad), 1)
    load(spark, base, rows(spark, 4, "2024-02"), 2)
    assert store.read_quarantine(spark, base).count() == 1
    load(spark, base, rows(spark, 8), 1)
    assert {r.bill_month: r["count"] for r in store.read_fact(spark, base).groupBy("bill_month").count().collect()} == {"2024-01": 8, "2024-02": 4}
    assert store.read_quarantine(spark, base).count() == 0
    assert [(r.load, r.raw_rows) for r in store.read_load_counts(spark, base).orderBy("load").collect()] == [(1, 8), (2, 4)]
    manifest = store.read_manifest(spark, base).where("bill_month IS NOT NULL").orderBy("load")
    assert [(r.load, r.bill_month, r.rows, r.state) for r in manifest.collect()] == [(1, "2024-01", 8, "done"), (2, "2024-02", 4, "done")]
    check_against_full_build(spark, base)
    load(spark, base, bad, 2)  # now without a kept row
    assert store.read_fact(spark, base).count() == 8 and store.read_quarantine(spark, base).count() == 1


@pytest.mark.parametrize("step", ["write_load_record", "write_copies", "write_fact_months", "append_rollup"])
def test_a_load_that_broke_off_is_taken_back_by_the_next(spark, scratch, monkeypatch, step):
    base = scratch("broken")
    load(spark, base, rows(spark, 10), 1)

    def fail(*args, **kwargs):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(store, step, fail)
        with pytest.raises(RuntimeError, match="lost"):
            load(spark, base, rows(spark, 7, "2024-02"), 2)
    assert store.unfinished_loads(spark, base) == [("daily", 2)]
    load(spark, base, rows(spark, 5, "2024-03"), 3)
    assert store.unfinished_loads(spark, base) == []
    assert store.read_fact(spark, base).count() == 15
    check_against_full_build(spark, base)
    load(spark, base, rows(spark, 7, "2024-02"), 2)
    assert store.read_fact(spark, base).count() == 22
    check_against_full_build(spark, base)


def test_files_are_taken_once_whoever_takes_them(spark, scratch):
    root = scratch("files")
    base = f"{root}/mart"
    write_export(rows(spark, 12).coalesce(1), f"{root}/one/a")
    write_export(rows(spark, 6, "2024-02").coalesce(1), f"{root}/two/a")
    ingest_new_files(spark, AWS, f"{root}/one/*/*.csv", base, f"{root}/state-1")
    ingest_new_files(spark, AWS, f"{root}/two/*/*.csv", base, f"{root}/state-2")
    assert store.read_fact(spark, base).count() == 18
    # delivered again: elsewhere, and twice at once; then with the same name and size, but another content
    part = os.path.basename(glob.glob(local_path(f"{root}/one/a/*.csv"))[0])
    text = open(local_path(f"{root}/one/a/{part}")).read()
    for folder, content in (("b", text), ("c", text), ("d", text.replace("r11", "x11"))):
        os.makedirs(local_path(f"{root}/two/{folder}"))
        open(local_path(f"{root}/two/{folder}/{part}"), "w").write(content)
    ingest_new_files(spark, AWS, f"{root}/two/*/*.csv", base, f"{root}/state-2")
    assert store.read_fact(spark, base).count() == 18 + 12
    found = store.read_input_files(spark, base).select(F.element_at(F.split("input_file", "/"), -2).alias("f"), "outcome")
    assert sorted((r.f, r.outcome) for r in found.collect()) == [("a", "loaded"), ("a", "loaded"), ("b", "copy"), ("c", "copy"), ("d", "loaded")]
    # a lost checkpoint: everything comes again
    ingest_new_files(spark, AWS, f"{root}/*/*/*.csv", base, f"{root}/state-3")
    assert store.read_fact(spark, base).count() == 30
    check_against_full_build(spark, base)


def test_full_load_forgets_earlier_loads(spark, scratch):
    base = scratch("full")
    load(spark, base, rows(spark, 9), 1)
    loads.full_load(spark, [(AWS, rows(spark, 4, "2024-05"))], base)
    assert store.read_fact(spark, base).count() == 4
    assert [(r.source, r.load) for r in store.read_manifest(spark, base).select("source", "load").distinct().collect()] == [("batch", 0)]
    load(spark, base, rows(spark, 9), 1)
    assert store.read_fact(spark, base).count() == 13
    check_against_full_build(spark, base)


def test_export_is_read_at_most_twice(spark, scratch):
    """Rows that pass the export's own plan: once for the landing and its counts, once for the quarantine."""
    base, seen = scratch("reads"), spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    raw = rows(spark, 30).unionByName(fx.aws_raw(spark, [fx.aws_row(cost_usd=None)]))
    path = scratch("export")
    raw.write.parquet(path)
    stored = spark.read.parquet(path)
    loads.load_exports_into(spark, [(AWS, stored.mapInArrow(count, stored.schema))], base, "daily", 1)
    assert seen.value == 2 * 31
    assert store.read_load_counts(spark, base).first().dropped_rows == 1


def test_fact_of_a_load_crosses_no_second_exchange(spark, scratch):
    """Landed rows lie by day and provider: the fact made of them is not exchanged again, and the fingerprints are
    written as they come."""
    base = scratch("landed")
    loads.load_exports_into(spark, [(AWS, rows(spark, 12))], base, "daily", 1)
    landed = store.read_landing(spark, base)
    fact = loads.build_fact(landed, copies=store.read_copies(spark, base, ["2024-01"]), clustered=True)
    union = fact._jdf.queryExecution().optimizedPlan().toString()
    assert "Rebalance" not in union[:union.index("Union")]  # of the counted rows only, below
    counts = store.read_copies(spark, base, ["2024-01"]).collect()
    assert len(counts) == 12 and {r.copies for r in counts} == {1}


def test_fact_of_landed_rows_is_neither_sorted_nor_exchanged(spark, scratch):
    """Each month's fact is written as its rows lie, by day, so that no task holds, or spills, its rows to sort them; a replay's, too."""
    base = scratch("by-month")
    load(spark, base, rows(spark, 40).unionByName(rows(spark, 9, "2024-02")), 1)
    load(spark, base, rows(spark, 20, first=10), 2)
    landed = store.read_landing(spark, base)
    by_month = {m: store.read_landing(spark, base, [m]) for m in ("2024-01", "2024-02")}
    facts = loads._fact(landed, by_month, store.read_copies(spark, base, list(by_month)))
    assert sorted(facts) == ["2024-01", "2024-02"]
    for fact in facts.values():
        plan = fact._jdf.queryExecution().executedPlan().toString()
        assert "Sort" not in plan
        union = fact._jdf.queryExecution().optimizedPlan().toString()
        assert "Rebalance" not in union[:union.index("Union")]
    assert ids(spark, base) == sorted(r.cost_id for f in facts.values() for r in f.select("cost_id").collect())
    for path in glob.glob(local_path(base) + "/landing/bill_month=*/provider=*/source=*/load=*/*.parquet"):
        days = [r.date_key for r in spark.read.parquet(path).coalesce(1).collect()]
        assert days == sorted(days)


def test_landing_is_sorted_in_small_parts(spark, scratch, monkeypatch):
    """What a task of the landing sorts is bounded by the landing's own size, not by the session's; each file stays sorted by day and
    no row is lost; the session's size is as it was."""
    monkeypatch.setattr(store, "LANDING_PART_BYTES", 1 << 10)
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    was, base = spark.conf.get(size), scratch("small-parts")
    days = reduce(DataFrame.unionByName, [rows(spark, 60, f"2024-0{m}") for m in (1, 2)])
    load(spark, base, days, 1)
    assert spark.conf.get(size) == was
    files = glob.glob(local_path(base) + "/landing/bill_month=*/provider=*/source=*/load=*/*.parquet")
    assert len(files) > 2  # one task for all of it would write a file a month
    for path in files:
        keys = [r.date_key for r in spark.read.parquet(path).coalesce(1).collect()]
        assert keys == sorted(keys)
    check_against_full_build(spark, base)


def test_repeated_rows_are_found_by_month(spark, scratch, monkeypatch):
    """Each month's counts are added up by a job of its own, so that a task's groups don't grow with the number of months; copies in an
    earlier load and within one are both found, for their month only."""
    asked = []
    monkeypatch.setattr(loads, "repeated_fingerprints", lambda *a: asked.append(repeated_fingerprints(*a)) or asked[-1])
    base = scratch("repeated-by-month")
    load(spark, base, rows(spark, 6, copies=2).unionByName(rows(spark, 3, "2024-02")), 1)
    load(spark, base, rows(spark, 2).unionByName(rows(spark, 5, "2024-02")), 2)
    found = [sorted((r.bill_month, r.copies, r.repeated_after) for r in x.collect()) for x in asked]
    assert found == [[("2024-01", 2, 0)] * 6, [("2024-01", 1, 2)] * 2 + [("2024-02", 1, 1)] * 3]
    check_against_full_build(spark, base)


def test_quarantine_is_written_without_a_sort(spark, scratch, monkeypatch):
    """Quarantined rows go straight to their provider's folder, as they come: by a write that deals them out each task would sort its own."""
    dealt_out = []
    write = store._write
    monkeypatch.setattr(store, "_write", lambda df, path, *a, **k: dealt_out.append(path.rsplit("/", 1)[1]) or write(df, path, *a, **k))
    base = scratch("rejected")
    bad = rows(spark, 4).unionByName(fx.aws_raw(spark, [fx.aws_row(cost_usd=None)] * 3))
    loads.load_exports_into(spark, [(AWS, bad)], base, "daily", 1)
    loads.load_exports_into(spark, [(AWS, rows(spark, 4, first=4))], base, "daily", 2, refused=[("AWS", "a.csv: x"), ("AWS", "b.csv: y")])
    assert store.LOAD_COUNTS in dealt_out and store.QUARANTINE not in dealt_out and store.QUARANTINE_FIELDS not in dealt_out
    found = store.read_quarantine(spark, base).select("provider", "cloud_provider", "source", "load", "reason").collect()
    assert sorted(map(tuple, found)) == [("AWS", "AWS", "daily", 1, "null_cost")] * 3 + [("AWS", "AWS", "daily", 2, "missing_columns")] * 2
    loads.full_load(spark, [(AWS, rows(spark, 4))], base)
    assert store.read_quarantine(spark, base).count() == 0


def test_loads_with_many_repeated_rows(spark, scratch, monkeypatch):
    """Where too many rows are repeated to mark them, the fact is dealt out anew in one frame: the same ids."""
    base = scratch("many")
    monkeypatch.setattr(loads, "FEW_REPEATED", 0)
    load(spark, base, rows(spark, 20, copies=2).unionByName(rows(spark, 5, "2024-02")), 1)
    load(spark, base, rows(spark, 12, copies=3), 2)
    assert store.read_fact(spark, base).count() == 45 + 36
    check_against_full_build(spark, base)
    load(spark, base, rows(spark, 30), 1)
    assert store.read_fact(spark, base).count() == 30 + 36
    check_against_full_build(spark, base)
    loads.full_load(spark, [(AWS, rows(spark, 8, "2024-03", copies=2))], base)
    assert store.read_fact(spark, base).count() == 16
    check_against_full_build(spark, base)


def test_full_load_replaces_months_that_it_does_not_have(spark, scratch):
    base = scratch("full")
    loads.full_load(spark, [(AWS, rows(spark, 8).unionByName(rows(spark, 6, "2024-02")))], base)
    loads.full_load(spark, [(AWS, rows(spark, 5, "2024-03"))], base)
    assert {r.bill_month for r in store.read_fact(spark, base).select("bill_month").collect()} == {"2024-03"}
    check_against_full_build(spark, base)


def test_an_appended_load_sums_its_rows_once(spark, scratch, monkeypatch):
    """Rollup and dimensions of an appended load, and of a mart's first one, come from one aggregate over its rows, and are those of the fact;
    a replay's are rebuilt as before."""
    dims, rebuilt = [], []
    write, rebuild = store.write_dimensions, store.write_rollup_months
    monkeypatch.setattr(store, "write_dimensions", lambda df, *a: dims.append(df) or write(df, *a))
    monkeypatch.setattr(store, "write_rollup_months", lambda *a, **k: rebuilt.append(a) or rebuild(*a, **k))
    base = scratch("sums")
    drifted = fx.aws_raw(spark, [fx.aws_row(bill_date="2024-01-02", account_name=n, team=t) for n, t in (("a", "x"), ("b", "x"), ("b", None))])
    load(spark, base, rows(spark, 9, copies=4), 1)
    load(spark, base, rows(spark, 9, copies=2).unionByName(drifted).unionByName(rows(spark, 3, "2024-02")), 2)
    assert ["line_items" in d.columns for d in dims] == [True, True] and not rebuilt
    assert dims[0].agg(F.sum("line_items")).first()[0] == 36 and dims[0].count() < 36
    check_against_full_build(spark, base)

    def summed(rollup):
        measures = [c for c in rollup.columns if c.rsplit("_", 1)[-1] in ("sum", "rest", "items")]
        keys = sorted(set(rollup.columns) - set(measures))
        return sorted(map(str, rollup.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in sorted(measures)]).collect()))

    from costmart.operators.dimensions import build_dim_account, build_dim_service
    from costmart.operators.rollup import daily_rollup

    assert summed(store.read_rollup(spark, base)) == summed(daily_rollup(store.read_fact(spark, base)))
    landed = store.read_landing(spark, base)
    for name, built in (("dim_account", build_dim_account(landed)), ("dim_service", build_dim_service(landed))):
        assert sorted(store.read_dimension(spark, base, name).collect()) == sorted(built.collect())
    load(spark, base, rows(spark, 5), 2)
    assert "line_items" not in dims[-1].columns and rebuilt
    check_against_full_build(spark, base)


def test_counts_before_and_now_meet_in_one_aggregate(spark, monkeypatch):
    """The copies of a load's rows, its own and those numbered before, are added up in one aggregate: no join of two."""
    counts = "fp_hi long, fp_lo long, copies long"
    own = spark.createDataFrame([(1, 1, 1), (2, 2, 1), (2, 2, 1), (3, 3, 1), (4, 4, 2)], counts)
    before = spark.createDataFrame([(3, 3, 1), (3, 3, 2), (4, 4, 1), (5, 5, 9), (1, 2, 1)], counts)
    with monkeypatch.context() as m:
        m.setattr(type(own), "join", None)
        found = repeated_fingerprints(own, before, own)
    assert sorted(map(tuple, found.collect())) == [(2, 2, 2, 0), (3, 3, 1, 3), (4, 4, 2, 1)]
