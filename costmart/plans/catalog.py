"""Named queries over a test-data folder: ``(spark, sf_dir) -> DataFrame``.

Each one starts from the driver's ``lineitem`` and ``events`` tables (the billing exports are
projected from them, ``sources.driver_tables``), runs the mart steps it needs and returns a flat
result. Nothing is capped or sampled: every query reads both tables whole.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from costmart.functions.dates import bill_month
from costmart.functions.money import money_sums, total
from costmart.operators import dimensions as dims_ops
from costmart.operators import quality
from costmart.operators.fact import build_fact, fact_lines, number_copies
from costmart.operators.normalize import dedupe_line_items, keep_condition, normalize
from costmart.plans import reports
from costmart.plans.mart import (
    Mart,
    build_mart,
    combined_from_driver_tables,
    fact_with_flat_tags,
    load_mart,
    read_canonical,
    report_views,
    run_pipeline,
    transform_aws,
    transform_gcp,
)
from costmart.plans.loads import full_load, load_exports_into
from costmart.plans.sql_reports import SQL_REPORTS, run_queries, run_sql_report
from costmart.schemas import CANONICAL_COLUMNS
from costmart.session import scratch_path, together
from costmart.sinks import mart_store
from costmart.sinks.compaction import compact_landing
from costmart.sources.billing_csv import read_export, write_export
from costmart.sources.driver_tables import load_exports
from costmart.sources.layouts import AWS, GCP
from costmart.streaming.ingest import ingest_new_files as _ingest


def _combined(spark: SparkSession, sf_dir: str) -> DataFrame:
    return combined_from_driver_tables(spark, sf_dir)


def _doubled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The canonical rows twice over: every line item arrives as two exact copies."""
    c = _combined(spark, sf_dir)
    return c.unionByName(c)


def _stored_dimensions(spark: SparkSession, rows: DataFrame) -> dict[str, DataFrame]:
    """The dimensions of ``rows``, stored, for joins of the rows themselves: so the planner knows how small they are. Those that are
    built in the same plan it takes to be as large as the rows, and exchanges these by the few keys of a dimension."""
    base = scratch_path(spark, "dimensions")
    mart_store.write_dimensions(rows, base)
    return {name: mart_store.read_dimension(spark, base, name) for name in mart_store.DIM_KEYS}


# --- stages --------------------------------------------------------------------------------------
def normalize_aws(spark, sf_dir):
    return normalize(load_exports(spark, sf_dir)[0], AWS)


def normalize_gcp(spark, sf_dir):
    return normalize(load_exports(spark, sf_dir)[1], GCP)


def combined(spark, sf_dir):
    return _combined(spark, sf_dir)


def dim_date(spark, sf_dir):
    return dims_ops.build_dim_date(_combined(spark, sf_dir))


def dim_service(spark, sf_dir):
    return dims_ops.build_dim_service(_combined(spark, sf_dir))


def dim_account(spark, sf_dir):
    return dims_ops.build_dim_account(_combined(spark, sf_dir))


def dim_region(spark, sf_dir):
    return dims_ops.build_dim_region(_combined(spark, sf_dir))


def fact(spark, sf_dir):
    """Derive-mode fact with ids; ``cost_id`` is checked by tests (unique, partition-independent)."""
    return fact_with_flat_tags(build_fact(_combined(spark, sf_dir))).drop("cost_id")


def fact_lookup(spark, sf_dir):
    c = _combined(spark, sf_dir)
    built = build_fact(c, keys="lookup", dims=_stored_dimensions(spark, c))
    return fact_with_flat_tags(built).drop("cost_id")


def fact_row_ids(spark, sf_dir):
    return number_copies(_doubled(spark, sf_dir), by_day=True).select(*CANONICAL_COLUMNS, "occurrence")


def dedupe(spark, sf_dir):
    return dedupe_line_items(_doubled(spark, sf_dir))


def quality_dropped(spark, sf_dir):
    a, b = load_exports(spark, sf_dir)
    return quality.drop_counts(a, AWS).unionByName(quality.drop_counts(b, GCP))


def _id_counts(fact: DataFrame, *keys: str) -> DataFrame:
    """How often each id occurs within ``keys``; the ids as 16 bytes, half of what their hex digits take in the exchange."""
    return fact.groupBy(*keys, F.unhex("cost_id").alias("id")).agg(F.count(F.lit(1)).alias("rows"))


def fact_ids(spark, sf_dir):
    """Row ids per provider: how many, how many distinct, and whether other partitions give the same
    ids. Every line item is there twice."""
    def ids(rows: DataFrame, name: str) -> DataFrame:
        text = F.lower(F.hex("id"))
        found = _id_counts(build_fact(rows, ids_only=True), "cloud_provider").groupBy("cloud_provider").agg(
            F.sum("rows").alias(f"{name}_rows"), F.count("id").alias(f"{name}_ids"),
            F.sum((F.xxhash64(text).cast("decimal(20,0)") * F.col("rows")).cast("decimal(38,0)")).alias(f"{name}_sum"))
        # stored, so that the exchanges of one build are gone when the other begins
        path = scratch_path(spark, "ids")
        found.coalesce(1).write.parquet(path)
        return spark.read.schema(found.schema).parquet(path)

    c = _doubled(spark, sf_dir)
    # the rows in other partitions are read more than once and so stored, not exchanged each time
    path = scratch_path(spark, "other-partitions")
    c.repartition(13, "resource_id").write.option("compression", "zstd").parquet(path)
    both = ids(c, "a").join(ids(read_canonical(spark, path), "b"), "cloud_provider")
    return both.select("cloud_provider", F.col("a_rows").alias("num_rows"), F.col("a_ids").alias("distinct_ids"),
                       ((F.col("a_sum") == F.col("b_sum")) & (F.col("a_ids") == F.col("b_ids"))).alias("same_ids"))


# --- reports -------------------------------------------------------------------------------------
def _report(fn, *dim_names, joins_rows: bool = False):
    def run(spark, sf_dir):
        c = _combined(spark, sf_dir)
        # one pass over the raw tables gives the natural keys of every dimension the report needs
        dims = (_stored_dimensions(spark, c) if joins_rows
                else dims_ops.dimensions_from_keys(dims_ops.dimension_keys(c, dim_names)) if dim_names else {})
        return fn(fact_lines(c), *[dims[n] for n in dim_names])
    run.__name__ = fn.__name__
    return run


REPORT_QUERIES = {
    "spend_by_provider": _report(reports.spend_by_provider),
    "top_services": _report(reports.top_services, "dim_service"),
    "monthly_trend": _report(reports.monthly_trend, "dim_date"),
    "team_environment": _report(reports.team_environment, "dim_account"),
    "region_spend": _report(reports.region_spend, "dim_region"),
    "geography_spend": _report(reports.geography_spend, "dim_region"),
    "weekend_weekday": _report(reports.weekend_weekday, "dim_date"),
    "category_share": _report(reports.category_share, "dim_service"),
    "aiml_spend": _report(reports.aiml_spend, "dim_service", "dim_date", joins_rows=True),
    "monthly_trend_last_6_months": _report(lambda f, d: reports.monthly_trend(f, d, year=None, last_months=6),
                                           "dim_date"),
    "monthly_trend_limit": _report(lambda f, d: reports.monthly_trend(f, d, limit=10), "dim_date"),
    "tags_lookup": _report(reports.tag_spend),
    "net_gross_credits": _report(reports.net_gross_credits),
}

def rollup(spark, sf_dir):
    """The daily rollup of the fact (sums as DOUBLE of six decimals for comparison)."""
    from costmart.operators.rollup import ROLLUP_KEYS, daily_rollup

    r = daily_rollup(fact_lines(_combined(spark, sf_dir)))
    sums = [total(6, f"{m}_sum", f"{m}_rest").alias(f"{m}_sum") for m in ("cost", "gross", "credit")]
    return r.select(*ROLLUP_KEYS, *sums, "line_items", "credit_items")


# --- sources, sinks and storage --------------------------------------------------------------------
# These write to a fresh folder under the session's checkpoint root and read the result back.

def _export(rows: DataFrame, path: str) -> None:
    """The export files that a query reads, compressed: as text they would be most of what it writes."""
    write_export(rows, path, compression="gzip")


def scan_aws_csv(spark, sf_dir):
    path = scratch_path(spark, "aws-export")
    _export(load_exports(spark, sf_dir)[0], path)
    return transform_aws(spark, path)


def scan_gcp_csv(spark, sf_dir):
    path = scratch_path(spark, "gcp-export")
    _export(load_exports(spark, sf_dir)[1], path)
    return transform_gcp(spark, path)


def scan_parquet(spark, sf_dir):
    """Hand canonical rows over as Parquet (one folder per source) and read them back."""
    path = scratch_path(spark, "canonical")
    a, b = load_exports(spark, sf_dir)
    normalize(a, AWS).write.parquet(f"{path}/aws")
    normalize(b, GCP).write.parquet(f"{path}/gcp")
    return read_canonical(spark, f"{path}/aws", f"{path}/gcp")


def _stored_mart(spark, sf_dir) -> str:
    base = scratch_path(spark, "mart")
    c = _combined(spark, sf_dir)
    together(lambda: mart_store.write_dimensions(c, base), lambda: mart_store.write_fact_months(build_fact(c), base))
    return base


def _month_stats(fact, **more):
    """Per month and provider of the fact; with ``more`` aggregates of the same pass, by name."""
    keys = ["bill_month", "cloud_provider"]
    # the distinct ids apart from the sums, which would cross the exchange with each id
    ids = _id_counts(fact, *keys).groupBy(*keys).agg(F.count("id").alias("distinct_ids"))
    sums = fact.groupBy(*keys).agg(F.count(F.lit(1)).alias("num_line_items"), *money_sums("cost_usd"),
                                   *[a.alias(name) for name, a in more.items()])
    return sums.join(ids, keys).select(*keys, "num_line_items", "distinct_ids", total(2).alias("total_cost_usd"), *more)


def write_mart(spark, sf_dir):
    return quality.mart_summary(load_mart(spark, _stored_mart(spark, sf_dir)).tables())


def scan_mart(spark, sf_dir):
    return fact_with_flat_tags(load_mart(spark, _stored_mart(spark, sf_dir)).fact).drop("cost_id", "bill_month")


def cluster_layout(spark, sf_dir):
    """Per day and provider of the stored fact: its line items, and whether they lie in at most two of
    the month's files (two where the layout exchange cut a large day)."""
    fact = mart_store.read_fact(spark, _stored_mart(spark, sf_dir))
    per_day = (fact.withColumn("file", F.input_file_name()).groupBy("bill_month", "date_key", "cloud_provider")
               .agg(F.count(F.lit(1)).alias("num_line_items"), F.countDistinct("file").alias("files")))
    return per_day.select("bill_month", "date_key", "cloud_provider", "num_line_items", (F.col("files") <= 2).alias("clustered"))


def month_reload(spark, sf_dir, month: str = "2024-03"):
    """Reload one month into a stored mart; the stored fact must come out unchanged."""
    base = _stored_mart(spark, sf_dir)
    rows = _combined(spark, sf_dir).where(bill_month("date_key") == month)
    mart_store.write_fact_months(build_fact(rows), base)
    return _month_stats(mart_store.read_fact(spark, base))


def quarter_weekend_spend(spark, sf_dir):
    """Weekend report of one quarter over the stored fact: only the quarter's months are read."""
    mart = load_mart(spark, _stored_mart(spark, sf_dir))
    return reports.weekend_weekday(mart.fact, mart.dims["dim_date"].where("year = '2024' AND quarter = 'Q1'"))


def weekend_category_share(spark, sf_dir):
    """Category shares on the weekends of one month, over the stored fact."""
    mart = load_mart(spark, _stored_mart(spark, sf_dir))
    days = mart.dims["dim_date"].where("month_name = 'January' AND is_weekend = 'true'")
    return reports.category_share(reports.on_days(mart.fact, days), mart.dims["dim_service"])


def sql_quarter_ai_spend(spark, sf_dir):
    """The SQL report of AI/ML spend, over the stored mart and one quarter."""
    report_views(spark, load_mart(spark, _stored_mart(spark, sf_dir)))
    return run_sql_report(spark, "aiml_spend", days="year = '2024' AND quarter = 'Q2'")


def zorder_fact(spark, sf_dir):
    """Two loads into one mart, its fact then written anew by z-order: the same rows and ids."""
    base = scratch_path(spark, "zorder")
    a, b = load_exports(spark, sf_dir)
    load_exports_into(spark, [(AWS, a)], base, "daily", 1)
    load_exports_into(spark, [(GCP, b)], base, "daily", 2)
    mart_store.optimize_fact(spark, base, rows_per_file=2_000)
    return _month_stats(mart_store.read_fact(spark, base))


def validate_content(spark, sf_dir):
    """The months whose stored lines differ from the landed ones: none of the mart as loaded, and those of a fact in which the
    costs of the two providers' lines of a January day were changed, with as many rows as before."""
    base = scratch_path(spark, "content")
    a, b = load_exports(spark, sf_dir)
    full_load(spark, [(AWS, a), (GCP, b)], base)
    fact, landed = mart_store.read_fact(spark, base), mart_store.read_landing(spark, base)
    changed = fact.withColumn("cost_usd", F.when(F.col("date_key") == "2024-01-05", -F.col("cost_usd")).otherwise(F.col("cost_usd")))
    found = [quality.months_with_other_content(f, landed).withColumn("fact", F.lit(n)) for n, f in (("stored", fact), ("changed", changed))]
    return found[0].unionByName(found[1])


def reports_after_month_reload(spark, sf_dir, month: str = "2024-01"):
    """Replace one month of a mart that has a rollup by its AWS rows only; spend by provider from the
    source that the command line reads."""
    base = _stored_mart(spark, sf_dir)
    mart_store.write_rollup_months(spark, base)
    rows = normalize_aws(spark, sf_dir).where(bill_month("date_key") == month)
    mart_store.write_fact_months(build_fact(rows), base)
    mart = load_mart(spark, base)
    return reports.spend_by_provider(mart.rollup if mart.rollup is not None else mart.fact)


def stored_sql_reports(spark, sf_dir):
    """SQL reports over the stored mart, one row per report and group."""
    out = run_queries(spark, _stored_mart(spark, sf_dir),
                      ["spend_by_provider", "top_services", "team_environment", "geography_spend"])
    groups = {"spend_by_provider": ["cloud_provider"], "top_services": ["cloud_provider", "service_name"],
              "team_environment": ["team", "environment", "cloud_provider"], "geography_spend": ["geography", "cloud_provider"]}
    parts = [out[n].select(F.lit(n).alias("report"), F.concat_ws("/", *g).alias("grp"), "total_cost_usd") for n, g in groups.items()]
    return reduce(DataFrame.unionByName, parts)


def full_reload(spark, sf_dir, split: str = "2024-07-01"):
    """Load everything, then only the line items before ``split``, into one mart: rows of each table, and
    the line items that the rollup counts."""
    base = scratch_path(spark, "reload")
    a, b = load_exports(spark, sf_dir)
    full_load(spark, [(AWS, a), (GCP, b)], base)
    full_load(spark, [(AWS, a.where(F.col("bill_date") < split)), (GCP, b.where(F.col("usage_date") < split))], base)
    mart = load_mart(spark, base)
    rollup = mart_store.read_rollup(spark, base).agg(F.sum("line_items").alias("row_count"))
    return quality.mart_summary(mart.tables()).unionByName(
        rollup.select(F.lit("daily_rollup").alias("table_name"), "row_count"))


def upsert_dimension(spark, sf_dir, split: str = "2024-07-01"):
    """Initial load from the line items before ``split``, upsert from those after it."""
    base = scratch_path(spark, "dims")
    c = _combined(spark, sf_dir)
    mart_store.write_dimension(dims_ops.build_dim_account(c.where(F.col("date_key") < split), True),
                               base, "dim_account")
    mart_store.upsert_dimension(dims_ops.build_dim_account(c.where(F.col("date_key") >= split), True),
                                base, "dim_account", load_id=1)
    return mart_store.read_dimension(spark, base, "dim_account")


def ingest_new_files(spark, sf_dir, split: str = "2024-07-01"):
    """Two arrivals of export files, each picked up by an ``availableNow`` stream run: first the
    AWS rows before ``split``; then the rest of AWS and all of GCP (GCP is January, a late file
    for a month already in the mart)."""
    root = scratch_path(spark, "ingest")
    base, state = f"{root}/mart", f"{root}/state"
    a, b = load_exports(spark, sf_dir)
    early = F.coalesce(F.col("bill_date"), F.lit("")) < split
    _export(a.where(early), f"{root}/inbox/aws/arrival-1")
    _ingest(spark, AWS, f"{root}/inbox/aws/*/*.csv.gz", base, state)
    _export(a.where(~early), f"{root}/inbox/aws/arrival-2")
    _export(b, f"{root}/inbox/gcp/arrival-2")
    _ingest(spark, AWS, f"{root}/inbox/aws/*/*.csv.gz", base, state)
    _ingest(spark, GCP, f"{root}/inbox/gcp/*/*.csv.gz", base, state)
    return fact_with_flat_tags(mart_store.read_fact(spark, base)).drop("cost_id", "bill_month")


def ingest_after_batch(spark, sf_dir):
    """A batch load of about half of each source, then stream runs over an export of which every row is
    dropped and over the rest: the fact must hold every line item once."""
    root = scratch_path(spark, "late")
    base, state = f"{root}/mart", f"{root}/state"
    a, b = load_exports(spark, sf_dir)
    in_batch = F.pmod(F.xxhash64("resource_id"), F.lit(2)) == 0
    bad = F.col("bill_date").isNull()
    _export(a.where(in_batch), f"{root}/batch/aws")
    in_batch_gcp = F.pmod(F.xxhash64("resource_name"), F.lit(2)) == 0
    _export(b.where(in_batch_gcp), f"{root}/batch/gcp")
    run_pipeline(spark, f"{root}/batch/aws", f"{root}/batch/gcp", base)
    _export(a.where(~in_batch & bad), f"{root}/inbox/aws/1")
    _ingest(spark, AWS, f"{root}/inbox/aws/*/*.csv.gz", base, state)
    _export(a.where(~in_batch & ~bad), f"{root}/inbox/aws/2")
    _export(b.where(~in_batch_gcp), f"{root}/inbox/gcp/2")
    _ingest(spark, AWS, f"{root}/inbox/aws/*/*.csv.gz", base, state)
    _ingest(spark, GCP, f"{root}/inbox/gcp/*/*.csv.gz", base, state)
    return fact_with_flat_tags(mart_store.read_fact(spark, base)).drop("cost_id", "bill_month")


def _copy_files(spark, source: str, target: str) -> None:
    """Files delivered again elsewhere, under their own names."""
    jvm, conf = spark._jvm, spark._jsparkSession.sessionState().newHadoopConf()
    src, dst = jvm.org.apache.hadoop.fs.Path(source), jvm.org.apache.hadoop.fs.Path(target)
    fs = src.getFileSystem(conf)
    fs.mkdirs(dst)
    for f in fs.globStatus(jvm.org.apache.hadoop.fs.Path(f"{source}/*.csv.gz")):
        jvm.org.apache.hadoop.fs.FileUtil.copy(fs, f.getPath(), fs, dst, False, conf)


def ingest_two_inboxes(spark, sf_dir, split: str = "2024-07-01"):
    """Two inboxes with a state folder each, for one mart and provider; then the first one's files are delivered again
    in the second, and the first one's checkpoint is lost: the fact must hold every line item once."""
    root = scratch_path(spark, "inboxes")
    base = f"{root}/mart"
    a, b = load_exports(spark, sf_dir)
    early = F.coalesce(F.col("bill_date"), F.lit("")) < split
    _export(a.where(early), f"{root}/one/1")
    _export(a.where(~early), f"{root}/two/1")
    _export(b, f"{root}/gcp/1")
    _ingest(spark, AWS, f"{root}/one/*/*.csv.gz", base, f"{root}/state-one")
    _ingest(spark, AWS, f"{root}/two/*/*.csv.gz", base, f"{root}/state-two")
    _copy_files(spark, f"{root}/one/1", f"{root}/two/2")
    _ingest(spark, AWS, f"{root}/two/*/*.csv.gz", base, f"{root}/state-two")
    _ingest(spark, GCP, f"{root}/gcp/*/*.csv.gz", base, f"{root}/state-gcp")
    _ingest(spark, AWS, f"{root}/one/*/*.csv.gz", base, f"{root}/state-new")
    return fact_with_flat_tags(mart_store.read_fact(spark, base)).drop("cost_id", "bill_month")


def shorter_replay(spark, sf_dir, split: str = "2024-07-01"):
    """Two loads, then the first one again under its number with only the rows before ``split``: months and rows that
    the new run doesn't bring must go."""
    base = scratch_path(spark, "replay")
    a, b = load_exports(spark, sf_dir)
    load_exports_into(spark, [(AWS, a)], base, "daily", 1)
    load_exports_into(spark, [(GCP, b)], base, "daily", 2)
    load_exports_into(spark, [(AWS, a.where(F.col("bill_date") < split))], base, "daily", 1)
    return fact_with_flat_tags(mart_store.read_fact(spark, base)).drop("cost_id", "bill_month")


def compacted_landing(spark, sf_dir, split: str = "2024-07-01"):
    """The even and the odd days of a provider in two loads, whose landed folders are then merged; then the second one again with
    only the rows before ``split``, which are taken out of the merged folders and land anew."""
    base = scratch_path(spark, "compacted")
    a, b = load_exports(spark, sf_dir)
    even = F.substring("bill_date", 10, 1).isin("0", "2", "4", "6", "8")
    load_exports_into(spark, [(AWS, a.where(even)), (GCP, b)], base, "daily", 1)
    load_exports_into(spark, [(AWS, a.where(~even))], base, "daily", 2)
    compact_landing(spark, base)
    load_exports_into(spark, [(AWS, a.where(~even & (F.col("bill_date") < split)))], base, "daily", 2)
    return fact_with_flat_tags(mart_store.read_fact(spark, base)).drop("cost_id", "bill_month")


def appended_loads(spark, sf_dir):
    """Every line item arrives twice, in four loads that share months and copies: per month and provider the items,
    distinct ids and costs of the appended fact, and whether its ids are those of one full build."""
    base = scratch_path(spark, "appended")
    a, b = load_exports(spark, sf_dir)
    part = F.pmod(F.xxhash64("resource_id"), F.lit(3))
    loads = [[(AWS, a.where(part < 2)), (GCP, b)], [(AWS, a.where(part > 0))], [(AWS, a.where(part == 0)), (GCP, b)], [(AWS, a.where(part == 2))]]
    for number, exports in enumerate(loads, 1):
        load_exports_into(spark, exports, base, "daily", number)
    keys = ["bill_month", "cloud_provider"]

    # the ids' hashes as a multiset: their 16-bit parts are summed as longs, exact up to 2^47 rows, and not as wide decimals
    hashed = F.xxhash64("cost_id")
    ids = F.array(*[F.sum(F.shiftrightunsigned(hashed, shift).bitwiseAND(F.lit(0xFFFF))) for shift in (0, 16, 32, 48)])
    stats = _month_stats(mart_store.read_fact(spark, base), appended=ids)
    full = build_fact(_doubled(spark, sf_dir), ids_only=True, by_day=True).withColumn("bill_month", bill_month("date_key"))
    return (stats.join(full.groupBy(*keys).agg(ids.alias("built")), keys)
            .select(*stats.columns[:-1], (F.col("appended") == F.col("built")).alias("same_ids")))


def empty_mart_summary(spark, sf_dir):
    """A full load of exports of which no row is kept, over a mart that had rows: the tables can be read and are empty."""
    base = scratch_path(spark, "empty")
    a, b = load_exports(spark, sf_dir)
    full_load(spark, [(AWS, a), (GCP, b)], base)
    full_load(spark, [(AWS, a.where(F.col("cost_usd").isNull())), (GCP, b.where(F.col("cost").isNull()))], base)
    return quality.mart_summary(load_mart(spark, base).tables())


def quarantine_empty(spark, sf_dir):
    """The quarantine, by reason, of a load that rejected nothing, and that of the load before it."""
    base = scratch_path(spark, "clean")
    a, b = load_exports(spark, sf_dir)
    full_load(spark, [(AWS, a), (GCP, b)], base)
    before = mart_store.read_quarantine(spark, base).agg(F.count(F.lit(1)).alias("rejected")).first()["rejected"]
    full_load(spark, [(AWS, a.where(keep_condition(AWS))), (GCP, b.where(keep_condition(GCP)))], base)
    return mart_store.read_quarantine(spark, base).agg(F.count(F.lit(1)).alias("rejected_after"), F.lit(before).cast("long").alias("rejected_before"))


def account_drift_incremental(spark, sf_dir):
    """Accounts whose team differs between the rows of a batch load and those of a later file, on the same
    days: the current rows must be those of a full build."""
    root = scratch_path(spark, "drift")
    base = f"{root}/mart"
    a, b = load_exports(spark, sf_dir)
    odd = F.substring("resource_id", 3, 20).cast("long") % 2 == 1
    drifted = a.withColumn("team", F.when(odd, F.lit("zeta")).otherwise(F.lit("alpha")))
    _export(drifted.where(odd), f"{root}/batch/aws")
    _export(b, f"{root}/batch/gcp")
    run_pipeline(spark, f"{root}/batch/aws", f"{root}/batch/gcp", base)
    _export(drifted.where(~odd), f"{root}/inbox/aws/1")
    _ingest(spark, AWS, f"{root}/inbox/aws/*/*.csv.gz", base, f"{root}/state")
    return mart_store.read_dimension(spark, base, "dim_account")


def _dirty_mart(spark, sf_dir) -> str:
    """A mart loaded from exports with odd AWS lines (rules by order number, as in the oracle): costs that
    are no number, of 2e12 and of 4e-7, and quantities that are no number."""
    root = scratch_path(spark, "dirty")
    a, b = load_exports(spark, sf_dir)
    order = F.substring("resource_id", 3, 20).cast("long")
    cost = F.col("cost_usd")
    dirty = a.withColumns({
        "cost_usd": F.when(order % 29 == 0, F.lit("n/a")).when(cost.isNotNull() & (order % 31 == 0), F.lit("2000000000000.25"))
                     .when(cost.isNotNull() & (order % 37 == 0), F.lit("0.0000004")).otherwise(cost.cast("string")),
        "usage_quantity": F.when(order % 41 == 0, F.lit("abc")).otherwise(F.col("usage_quantity").cast("string"))})
    _export(dirty, f"{root}/aws")
    _export(b, f"{root}/gcp")
    run_pipeline(spark, f"{root}/aws", f"{root}/gcp", f"{root}/mart")
    return f"{root}/mart"


def load_drop_counts(spark, sf_dir):
    """The counts that a load wrote."""
    return mart_store.read_load_counts(spark, _dirty_mart(spark, sf_dir)).drop("provider", "source", "load")


def quarantine_stored(spark, sf_dir):
    """The rows that a load quarantined; of the line's text, whether it was kept."""
    q = mart_store.read_quarantine(spark, _dirty_mart(spark, sf_dir))
    return q.withColumn("has_line", F.col("raw_line").isNotNull()).drop("raw_line", "provider", "source", "load")


def quarantine_fields_stored(spark, sf_dir):
    """The malformed fields that a load quarantined, by name and text."""
    q = mart_store.read_quarantine_fields(spark, _dirty_mart(spark, sf_dir))
    return q.groupBy("cloud_provider", "field", "text").agg(F.count(F.lit(1)).alias("num_fields"))


def reordered_headers(spark, sf_dir):
    """Files of one inbox with their columns in order, in reverse with one more, without an optional one that is empty anyway, and
    without the cost; then one more good file. The fact must hold every line item but the refused file's."""
    root = scratch_path(spark, "headers")
    base, state, inbox = f"{root}/mart", f"{root}/state", f"{root}/inbox/*/*.csv.gz"
    a, b = load_exports(spark, sf_dir)
    part = F.pmod(F.substring("resource_id", 3, 20).cast("long"), F.lit(3))
    _export(a.where(part == 0), f"{root}/inbox/1")
    _export(a.where(part == 1).select(F.lit("x, y").alias("note"), *reversed(a.columns)), f"{root}/inbox/2")
    _export(a.drop("cost_usd"), f"{root}/inbox/3")
    _ingest(spark, AWS, inbox, base, state)
    _export(a.where(part == 2).drop("usage_type"), f"{root}/inbox/4")
    _ingest(spark, AWS, inbox, base, state)
    return fact_with_flat_tags(mart_store.read_fact(spark, base)).drop("cost_id", "bill_month")


def extreme_costs(spark, sf_dir):
    """Sums over very large and very small costs: per provider all, and the items below a thousandth."""
    fact = load_mart(spark, _dirty_mart(spark, sf_dir)).fact
    small = F.when(F.abs("cost_usd") < 0.001, F.col("cost_usd"))
    return (fact.groupBy("cloud_provider")
            .agg(F.count(F.lit(1)).alias("num_line_items"), *money_sums("cost_usd"), *money_sums(small, "ss", "sx"))
            .select("cloud_provider", "num_line_items", total(2).alias("total_cost_usd"), total(9, "ss", "sx").alias("small_cost_usd")))


def quarantine_rows(spark, sf_dir):
    """Rows each source's drop rule removes, with the reason, read from CSV exports."""
    path = scratch_path(spark, "quarantine")
    a, b = load_exports(spark, sf_dir)
    _export(a, f"{path}/aws")
    _export(b, f"{path}/gcp")
    qa = quality.quarantine(read_export(spark, f"{path}/aws", AWS, keep_corrupt=True), AWS)
    qb = quality.quarantine(read_export(spark, f"{path}/gcp", GCP, keep_corrupt=True), GCP)
    return qa.unionByName(qb)


def validate_mart(spark, sf_dir):
    c = _combined(spark, sf_dir)
    mart = build_mart(c)
    return quality.validate_mart(mart.fact, mart.dims, expected_fact_rows=c)


def mart_summary(spark, sf_dir):
    return quality.mart_summary(build_mart(_combined(spark, sf_dir)).tables())


def _sql_report(name):
    def run(spark, sf_dir):
        c = _combined(spark, sf_dir)
        dims = _stored_dimensions(spark, c) if "LEFT SEMI JOIN" in SQL_REPORTS[name] else dims_ops.build_dimensions(c)
        report_views(spark, Mart(fact=fact_lines(c), dims=dims))
        return run_sql_report(spark, name)
    run.__name__ = f"sql_{name}"
    return run


SQL_QUERIES = {f"sql_{name}": _sql_report(name) for name in SQL_REPORTS}

STORAGE_QUERIES = {
    "scan_aws_csv": scan_aws_csv,
    "scan_gcp_csv": scan_gcp_csv,
    "scan_parquet": scan_parquet,
    "write_mart": write_mart,
    "scan_mart": scan_mart,
    "cluster_layout": cluster_layout,
    "month_reload": month_reload,
    "quarter_weekend_spend": quarter_weekend_spend,
    "weekend_category_share": weekend_category_share,
    "sql_quarter_ai_spend": sql_quarter_ai_spend,
    "zorder_fact": zorder_fact,
    "validate_content": validate_content,
    "reports_after_month_reload": reports_after_month_reload,
    "stored_sql_reports": stored_sql_reports,
    "full_reload": full_reload,
    "ingest_after_batch": ingest_after_batch,
    "account_drift_incremental": account_drift_incremental,
    "ingest_two_inboxes": ingest_two_inboxes,
    "shorter_replay": shorter_replay,
    "appended_loads": appended_loads,
    "compacted_landing": compacted_landing,
    "empty_mart_summary": empty_mart_summary,
    "quarantine_empty": quarantine_empty,
    "load_drop_counts": load_drop_counts,
    "quarantine_stored": quarantine_stored,
    "quarantine_fields": quarantine_fields_stored,
    "reordered_headers": reordered_headers,
    "extreme_costs": extreme_costs,
    "upsert_dimension": upsert_dimension,
    "ingest_new_files": ingest_new_files,
    "quarantine": quarantine_rows,
    "validate_mart": validate_mart,
    "mart_summary": mart_summary,
}

STAGE_QUERIES = {
    "normalize_aws": normalize_aws,
    "normalize_gcp": normalize_gcp,
    "combined": combined,
    "dim_date": dim_date,
    "dim_service": dim_service,
    "dim_account": dim_account,
    "dim_region": dim_region,
    "fact": fact,
    "fact_lookup": fact_lookup,
    "fact_row_ids": fact_row_ids,
    "fact_ids": fact_ids,
    "dedupe_line_items": dedupe,
    "quality_dropped": quality_dropped,
    "daily_rollup": rollup,
}


def all_queries() -> dict:
    return {**STAGE_QUERIES, **REPORT_QUERIES, **SQL_QUERIES, **STORAGE_QUERIES}
