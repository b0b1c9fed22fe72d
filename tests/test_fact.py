"""Fact builder: row counts, ids, partition independence, hot groups of copies, invariants."""

from pyspark.sql import functions as F

from costmart.operators import dimensions as D
from costmart.operators import fact as operators_fact
from costmart.operators.fact import build_fact, fact_lines, number_copies
from costmart.plans.mart import combined_from_driver_tables
from costmart.schemas import CANONICAL_COLUMNS, FACT_SCHEMA
from tests import fixtures as fx
from tests.conftest import SF_SMALL


def test_one_fact_row_per_line_item(spark):
    c = fx.combined(spark)
    assert build_fact(c).count() == len(fx.COMBINED_ROWS)


def test_no_null_cost(spark):
    assert build_fact(fx.combined(spark)).where(F.col("cost_usd").isNull()).count() == 0


def test_fact_schema_and_tags(spark):
    f = build_fact(fx.combined(spark))
    assert [x.name for x in f.schema.fields] == FACT_SCHEMA.fieldNames()
    r = f.where("date_key = '2024-11-30'").first()
    assert r.tags == {"environment": "staging", "team": "ranking"}


def test_identical_line_items_get_distinct_stable_ids(spark):
    row = fx.canon_row()
    c = fx.combined(spark, [row, row, fx.canon_row(resource_id="other")])
    first = sorted(r.cost_id for r in build_fact(c).collect())
    again = sorted(r.cost_id for r in build_fact(c).collect())
    assert len(set(first)) == 3 and first == again


def test_ids_do_not_depend_on_partitioning(spark):
    c = combined_from_driver_tables(spark, SF_SMALL)
    c = c.unionByName(c.where("date_key < '2024-03-01'"))  # some exact copies
    sets = []
    for n in (1, 7, 64):
        ids = build_fact(c.repartition(n)).select("cost_id", "date_key", "cost_usd").collect()
        sets.append(sorted(ids))
    assert sets[0] == sets[1] == sets[2]
    assert len({r.cost_id for r in sets[0]}) == len(sets[0])


def test_hot_group_of_copies_is_chunked(spark):
    """A group of 10 copies with chunk=3 goes through the chunked path: occurrences 1..10."""
    row = fx.canon_row()
    c = fx.combined(spark, [row] * 10 + [fx.canon_row(resource_id="x")] * 2)
    out = number_copies(c, chunk=3)
    occ = sorted(r.occurrence for r in out.where("resource_id = 'node-7'").collect())
    assert occ == list(range(1, 11))
    ids = build_fact(c, chunk=3).select("cost_id").collect()
    assert len({r.cost_id for r in ids}) == 12
    # the same ids as without chunking
    assert sorted(build_fact(c, chunk=3).collect()) == sorted(build_fact(c).collect())


def test_fingerprint_separates_null_positions(spark):
    a = fx.canon_row(account_name=None, team="x")
    b = fx.canon_row(account_name="x", team=None)
    ids = build_fact(fx.combined(spark, [a, b])).select("cost_id").collect()
    assert len({r.cost_id for r in ids}) == 2


def test_derived_keys_equal_lookup_keys(spark):
    c = combined_from_driver_tables(spark, SF_SMALL)
    cols = ["cost_id", "service_key", "account_key", "region_key"]
    derived = build_fact(c).select(*cols)
    looked = build_fact(c, keys="lookup", dims=D.build_dimensions(c)).select(*cols)
    assert derived.exceptAll(looked).count() == 0 and looked.exceptAll(derived).count() == 0
    assert looked.where(F.col("account_key").isNull()).count() == 0


def test_invariants_over_driver_tables(spark):
    c = combined_from_driver_tables(spark, SF_SMALL)
    fact = build_fact(c)
    dims = D.build_dimensions(c)
    assert fact.count() == c.count()
    for name, key in [("dim_service", "service_key"), ("dim_account", "account_key"),
                      ("dim_region", "region_key"), ("dim_date", "date_key")]:
        # every fact key has exactly one dimension row
        joined = fact.select(key).distinct().join(dims[name], key, "left_anti")
        assert joined.count() == 0, name
    s_fact = fact.agg(F.sum(F.col("cost_usd").cast("decimal(18,6)"))).first()[0]
    s_comb = c.agg(F.sum(F.col("cost_usd").cast("decimal(18,6)"))).first()[0]
    assert s_fact == s_comb


def test_number_copies_keeps_all_rows(spark):
    c = combined_from_driver_tables(spark, SF_SMALL)
    doubled = c.unionByName(c)
    out = number_copies(doubled)
    assert out.count() == doubled.count()
    assert out.groupBy(*CANONICAL_COLUMNS).agg(F.max("occurrence").alias("m")).where("m <> 2").count() == 0


def test_fact_lines_is_a_projection(spark):
    plan = fact_lines(fx.combined(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan


def _exchanges(plan: str) -> list[str]:
    return [x.strip() for x in plan.splitlines() if " Exchange " in x or x.strip().startswith("Exchange")]


def test_unique_rows_cross_one_exchange(spark):
    """Rows that occur once are only laid out: the repeated fingerprints (none here) are broadcast, and the
    one other exchange belongs to the aggregate over repeated rows."""
    c = combined_from_driver_tables(spark, SF_SMALL)
    df = build_fact(c)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan
    found = _exchanges(plan)
    assert sum("REBALANCE" in x for x in found) == 1
    assert len(found) == 2
    union = df._jdf.queryExecution().optimizedPlan().toString()
    alone = union[union.index("Union"):].split("Aggregate")[0]
    assert "isnull(repeated" in alone  # the branch of unique rows holds no aggregate


def test_many_repeated_rows_are_counted_without_a_join(spark):
    """Above ``few`` repeated fingerprints all rows cross one exchange by fingerprint and meet no join; a hot group is counted
    map side there; the numbers are the same."""
    row = fx.canon_row()
    c = fx.combined(spark, [row] * 10 + [fx.canon_row(resource_id=f"x{i % 4}") for i in range(8)] + [fx.canon_row(resource_id="alone")])
    got = [sorted(number_copies(c, chunk=k, few=n).collect()) for k, n in ((3, 100), (3, 0), (100, 0))]
    assert got[0] == got[1] == got[2] and len(got[0]) == 19
    plan = number_copies(c, few=0)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan
    assert len(_exchanges(plan)) == 2  # by fingerprint, and the layout


def test_exchanges_carry_only_what_the_fact_is_made_of(spark):
    c = fx.combined(spark, [fx.canon_row()] * 2)
    number = lambda **k: number_copies(c, few=0, **k)
    assert "resource_id" in number().columns
    full = build_fact(c)
    ids = build_fact(c, ids_only=True)
    assert sorted(r.cost_id for r in ids.collect()) == sorted(r.cost_id for r in full.collect())
    assert "resource_id" not in number(columns=("cost_usd",)).columns


def test_doubled_rows_cross_one_exchange_by_day(spark, monkeypatch):
    """Rows known to be repeated are dealt out by day and counted where they lie: one exchange, which carries no fingerprint that the
    other columns give, and no set of repeated fingerprints before it; a day of many rows is cut, a hot group counted map side."""
    days = [fx.canon_row(resource_id=f"x{i % 9}", date_key=f"2024-11-{1 + i % 3:02d}") for i in range(54)]
    c = fx.combined(spark, days + [fx.canon_row()] * 10 + [fx.canon_row(date_key="2024-11-02", cost_usd=None, team=None)] * 2)
    expected = sorted(number_copies(c, few=0).collect(), key=str)
    looked = []
    monkeypatch.setattr(operators_fact, "repeated_fingerprints", lambda *a: looked.append(a))
    for rows_per_part, chunk in ((1 << 18, 100), (7, 100), (7, 3), (1, 1)):
        monkeypatch.setattr(operators_fact, "ROWS_PER_DAY_PART", rows_per_part)
        assert sorted(number_copies(c, chunk=chunk, by_day=True).collect(), key=str) == expected
    monkeypatch.setattr(operators_fact, "ROWS_PER_DAY_PART", 20)
    df = number_copies(c, by_day=True)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and len([x for x in _exchanges(plan) if "BroadcastExchange" not in x]) == 1
    dealt = df._jdf.queryExecution().optimizedPlan().toString().split("RepartitionByExpression")[1].splitlines()[1]
    assert " AS part" in dealt and "fp_hi" not in dealt and " AS fp_lo" not in dealt
    lying = df.withColumn("part", F.spark_partition_id()).groupBy("date_key").agg(F.collect_set("part").alias("parts")).collect()
    assert len(lying) == 4 and all(len(r.parts) == 1 for r in lying)
    assert not looked
    ids = build_fact(c, ids_only=True, by_day=True)
    monkeypatch.undo()
    assert sorted(r.cost_id for r in ids.collect()) == sorted(r.cost_id for r in build_fact(c).collect())
    empty = number_copies(c.where("date_key IS NULL"), by_day=True)
    assert empty.columns == df.columns and empty.count() == 0
    lost = c.withColumn("date_key", F.lit(None).cast("string"))
    assert number_copies(lost, by_day=True).count() == c.count()


def test_row_ids_query_looks_for_no_repeated_rows(spark, monkeypatch):
    from costmart.plans.catalog import fact_row_ids

    monkeypatch.setattr(operators_fact, "repeated_fingerprints", None)
    out = fact_row_ids(spark, SF_SMALL)
    assert [r.n for r in out.groupBy("occurrence").agg(F.count("*").alias("n")).collect()] == [combined_from_driver_tables(spark, SF_SMALL).count()] * 2
