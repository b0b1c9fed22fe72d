"""Stored layout of the mart (Parquet; no Delta jar in this environment).

* ``landing/bill_month=M/provider=P/source=S/load=N/``: the canonical rows of every load, batch or
  incremental. It is what the fact is rebuilt from, so any load may add rows to a month that another
  one has loaded before.
  ``sinks.compaction`` merges small ones to ``source=merged/load=G``; ``landing_merges`` says which loads those hold.
* ``fact_cloud_costs/bill_month=yyyy-MM/``: the fact, partitioned by month. Rows are distributed by
  day and provider and sorted by date inside each file, so a day's rows lie in a few files of its
  month and a date filter opens only those (Parquet min/max statistics).
* ``daily_rollup/bill_month=yyyy-MM/``: the reports' partial sums, refreshed by whatever writes the
  fact. ``rollup_state`` says whether it agrees with the fact; readers use it only then.
* ``dim_*/source=S/load_id=N/``: each load of a dimension adds its rows under a new ``load_id``
  (rewriting its own folder if the load is replayed). Readers resolve one row per key, which is the
  upsert. No job ever reads and overwrites the same folder.
* ``quarantine``, ``quarantine_fields`` and ``load_counts`` (``/provider=P/source=S/load=N/``): rows a load dropped or could
  read only in part, each field that did not parse, and one row of counts per load and provider.
* ``load_manifest`` and ``input_files`` (``/source=S/load=N/``): the provider's months that a load has landed rows for,
  and whether it came to its end; the export files it has taken.
* ``fact_copies/bill_month=M/source=S/load=N/``: the fingerprints of a load's rows of the month, with counts to be added up, so that a later load numbers its copies without reading the rows again.

A full load (``replace_all``) replaces whole tables; anything else replaces only the partitions it
has rows for. Each write says which, whatever the session's setting.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DateType, LongType, StringType, StructField, StructType, TimestampType

from costmart.functions.dates import bill_month
from costmart.schemas import (
    CANONICAL_COLUMNS,
    CANONICAL_SCHEMA,
    DIM_ACCOUNT_SCHEMA,
    DIM_DATE_SCHEMA,
    DIM_REGION_SCHEMA,
    DIM_SERVICE_SCHEMA,
    FACT_SCHEMA,
    FACT_STORED_SCHEMA,
    assert_schema,
)
from costmart.session import MONTHS_AT_ONCE, exchanged_in_parts_of, together

FACT_TABLE = "fact_cloud_costs"
ROLLUP_TABLE = "daily_rollup"
ROLLUP_STATE = "rollup_state"
LANDING = "landing"
QUARANTINE = "quarantine"
QUARANTINE_FIELDS = "quarantine_fields"
LOAD_COUNTS = "load_counts"
MANIFEST = "load_manifest"
INPUT_FILES = "input_files"
COPIES = "fact_copies"
MERGES = "landing_merges"
MERGED = "merged"  # the landing's source of folders that hold several loads
ROWS_PER_LAYOUT_TASK = 500_000
LANDING_PART_BYTES = 16 << 20  # exchanged bytes a task of the landing's sort: some 500,000 rows, which are ten times as large in memory
LAYOUT_RUN = "layout"  # the manifest's source of a run of optimize_fact
DIM_KEYS = {"dim_date": "date_key", "dim_service": "service_key", "dim_account": "account_key",
            "dim_region": "region_key"}
DIM_SCHEMAS = {"dim_date": DIM_DATE_SCHEMA, "dim_service": DIM_SERVICE_SCHEMA,
               "dim_account": DIM_ACCOUNT_SCHEMA, "dim_region": DIM_REGION_SCHEMA}
INITIAL_LOAD = 0
COMPRESSION = "zstd"  # ids are hex digits, which codecs without an entropy coder leave as long as they are
_LOAD_COLUMNS = [StructField("provider", StringType()), StructField("source", StringType()), StructField("load", LongType())]
_FILE_COLUMNS = [StructField("input_file", StringType()), StructField("input_size", LongType()), StructField("input_time", TimestampType())]
_OF_COLUMNS = [StructField("of_source", StringType()), StructField("of_load", LongType())]  # in merged folders only
LANDING_SCHEMA = StructType([*CANONICAL_SCHEMA.fields, *_FILE_COLUMNS, *_OF_COLUMNS, StructField("bill_month", StringType()), *_LOAD_COLUMNS])
MERGES_SCHEMA = StructType([StructField("provider", StringType()), StructField("bill_month", StringType()), *_OF_COLUMNS,
                            StructField("rows", LongType()), StructField("generation", LongType())])
MANIFEST_SCHEMA = StructType([StructField("provider", StringType()), StructField("bill_month", StringType()), StructField("rows", LongType()),
                              StructField("state", StringType()), *_LOAD_COLUMNS[1:]])
INPUT_FILES_SCHEMA = StructType([*_FILE_COLUMNS, StructField("outcome", StringType()), *_LOAD_COLUMNS[1:]])
COPIES_SCHEMA = StructType([StructField("fp_hi", LongType()), StructField("fp_lo", LongType()), StructField("copies", LongType()),
                            StructField("bill_month", StringType()), *_LOAD_COLUMNS[1:]])
QUARANTINE_SCHEMA = StructType([
    StructField("cloud_provider", StringType()), StructField("reason", StringType()), StructField("kept", BooleanType()),
    *[f for f in CANONICAL_SCHEMA.fields if f.name != "cloud_provider"], StructField("raw_line", StringType()), *_LOAD_COLUMNS])
QUARANTINE_FIELDS_SCHEMA = StructType([StructField(n, StringType()) for n in ("cloud_provider", "field", "text", "raw_line")] + _LOAD_COLUMNS)
COUNT_NAMES = ("raw_rows", "null_date", "null_cost", "null_service", "null_account", "bad_date", "inexact_cost", "malformed_rows",
               "dropped_rows", "kept_rows")
LOAD_COUNTS_SCHEMA = StructType([StructField("cloud_provider", StringType()), *[StructField(n, LongType()) for n in COUNT_NAMES], *_LOAD_COLUMNS])


def _path(base: str, table: str) -> str:
    return f"{base.rstrip('/')}/{table}"


def _write(df: DataFrame, path: str, partitions: tuple[str, ...], replace_all: bool, max_rows: int = 0) -> None:
    """Overwrite the whole table (static) or only the partitions that ``df`` has rows for (dynamic), in files of at most ``max_rows``
    rows if that is not 0."""
    (df.write.mode("overwrite").option("compression", COMPRESSION).option("maxRecordsPerFile", max_rows)
     .option("partitionOverwriteMode", "static" if replace_all else "dynamic")
     .partitionBy(*partitions).parquet(path))


def write_months(frames: dict[str, DataFrame], base: str, table: str, below: str = "", append: bool = False) -> None:
    """Write each month's rows straight to its folder (or to ``below`` in it), as they come, replacing what is there or adding to it.

    A write that Spark deals out to months sorts a task's rows by month first, all of them in memory or spilled; here a task holds
    no more than it is writing."""
    def write(month: str, df: DataFrame) -> None:
        df.write.mode("append" if append else "overwrite").option("compression", COMPRESSION).parquet(f"{_path(base, table)}/bill_month={month}{below}")

    together(*[partial(write, m, df) for m, df in frames.items()], at_once=MONTHS_AT_ONCE)


def has_table(spark: SparkSession, base: str, table: str) -> bool:
    """Whether the mart has a folder for ``table`` (one call to the file system, no listing)."""
    path = spark._jvm.org.apache.hadoop.fs.Path(_path(base, table))
    return path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(path)


def _fs(spark: SparkSession, path: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), path


def _folders(spark: SparkSession, pattern: str) -> list[str]:
    """The folders that a pattern names (the file system's listing; no data is read)."""
    fs, path = _fs(spark, pattern)
    return sorted(f.getPath().toString() for f in fs.globStatus(path) or [])


def drop_folder(spark: SparkSession, path: str) -> None:
    fs, path = _fs(spark, path)
    fs.delete(path, True)


def _values(folder: str) -> dict[str, str]:
    """The partition values in a folder's name."""
    from urllib.parse import unquote

    return {k: unquote(v) for k, _, v in (part.partition("=") for part in folder.split("/")) if v}


def _read(spark: SparkSession, base: str, table: str, schema: StructType) -> DataFrame:
    """A table that may have no file yet, or not even a folder."""
    if not has_table(spark, base, table):
        return literal_rows(spark, schema, [])
    return spark.read.schema(schema).parquet(_path(base, table))


def literal_rows(spark: SparkSession, schema: StructType, rows: list[tuple]) -> DataFrame:
    """A few rows made by the JVM alone."""
    if not rows:
        return spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields])
    structs = [F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(r, schema.fields)]) for r in rows]
    return spark.range(1).select(F.inline(F.array(*structs)))


# --- landing, quarantine, counts -------------------------------------------------------------
def land_rows(canonical: DataFrame, base: str, source: str, load: int, replace_all: bool = False) -> None:
    """Store one load's canonical rows; a replay of the load replaces its own folders. ``canonical`` may carry the
    ``input_`` columns of ``sources.billing_csv.with_input_file``."""
    if source == MERGED:
        raise ValueError(f"no load may have the source {MERGED!r}: it names the landing's merged folders")
    assert_schema(canonical.select(*CANONICAL_COLUMNS), CANONICAL_SCHEMA)
    # by day and provider, as the fact is laid out, so that the fact of these rows needs no exchange of its own; what follows from
    # the row, or is the same in all, is added behind the exchange
    dealt = canonical.hint("rebalance", "date_key", "cloud_provider")
    files = [F.col(f.name) if f.name in canonical.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in _FILE_COLUMNS]
    parts = ("bill_month", "provider", "source", "load")
    rows = dealt.select(
        *CANONICAL_COLUMNS, *files, bill_month("date_key").alias("bill_month"), F.col("cloud_provider").alias("provider"),
        F.lit(source).alias("source"), F.lit(int(load)).cast("long").alias("load"))
    # and by day within the folder, so that its fact need not be sorted; a task holds its rows for that, so they are kept few
    with exchanged_in_parts_of(canonical.sparkSession, LANDING_PART_BYTES):
        _write(rows.sortWithinPartitions(*parts, "date_key"), _path(base, LANDING), parts, replace_all)


def read_landing(spark: SparkSession, base: str, months: list[str] | None = None) -> DataFrame:
    """Canonical rows of all loads, or of the given months: then only those folders are listed."""
    return _landing(spark, base, None if months is None else [f"{_path(base, LANDING)}/bill_month={m}" for m in months]).select(*CANONICAL_COLUMNS)


def _landing(spark: SparkSession, base: str, paths: list[str] | None = None) -> DataFrame:
    """Landed rows, each with the load that it is of, whatever folder it is in."""
    root = _path(base, LANDING)
    if paths is None and has_table(spark, base, LANDING):
        paths = [root]
    rows = spark.read.schema(LANDING_SCHEMA).option("basePath", root).parquet(*paths) if paths else literal_rows(spark, LANDING_SCHEMA, [])
    return rows.withColumns({"source": F.coalesce("of_source", "source"), "load": F.coalesce("of_load", "load")}).drop("of_source", "of_load")


def landed_folders(spark: SparkSession, base: str, source: str = "*", load: int | str = "*", months: list[str] | None = None) -> list[str]:
    found = [f for m in (months if months is not None else ["*"])
             for f in _folders(spark, f"{_path(base, LANDING)}/bill_month={m}/provider=*/source={source}/load={load}")]
    return found


def others_landed(spark: SparkSession, base: str, months: list[str], source: str, load: int) -> bool:
    """Whether the landing has folders of these months that are not the load's own."""
    own = (source, str(load))
    return any((v["source"], v["load"]) != own for v in map(_values, landed_folders(spark, base, months=months)))


def read_landed_load(spark: SparkSession, base: str, source: str, load: int, months: list[str] | None = None) -> DataFrame:
    """All landed columns of one load, or of its rows of the given months; only folders that hold some of it are read."""
    mine = (F.col("of_source") == source) & (F.col("of_load") == load)
    merged = sorted({merged_folder(base, r) for r in merges(spark, base, mine) if months is None or r["bill_month"] in months})
    rows = _landing(spark, base, landed_folders(spark, base, source, load, months) + merged)
    return rows.where((F.col("source") == source) & (F.col("load") == load)) if merged else rows


def merges(spark: SparkSession, base: str, where: Column | None = None) -> list[Row]:
    """Which loads the merged folders of the landing hold, of the records that fit ``where``."""
    there = {(v["provider"], v["bill_month"], int(v["load"])) for v in map(_values, landed_folders(spark, base, MERGED))}
    if not there:
        return []
    rows = _read(spark, base, MERGES, MERGES_SCHEMA)
    return [r for r in (rows if where is None else rows.where(where)).collect() if (r["provider"], r["bill_month"], r["generation"]) in there]


def merged_folder(base: str, record: Row) -> str:
    return f"{_path(base, LANDING)}/bill_month={record['bill_month']}/provider={record['provider']}/source={MERGED}/load={record['generation']}"


def write_load_record(counts: DataFrame, rejected: dict[str, DataFrame], base: str, source: str, load: int,
                      replace_all: bool = False, fields: dict[str, DataFrame] | None = None) -> None:
    """One row of counts per provider; the quarantined rows and their malformed ``fields``, given by provider, each
    provider's straight to its folder as they come: a write that Spark deals out to providers would sort (and spill) them first."""
    tagged = counts.withColumns({"provider": F.col("cloud_provider"), "source": F.lit(source), "load": F.lit(int(load)).cast("long")})
    _write(tagged, _path(base, LOAD_COUNTS), ("provider", "source", "load"), replace_all)
    for table, frames in ((QUARANTINE, rejected), (QUARANTINE_FIELDS, fields or {})):
        if replace_all and frames:
            drop_folder(counts.sparkSession, _path(base, table))
        for provider, df in frames.items():
            df.write.mode("overwrite").option("compression", COMPRESSION).parquet(f"{_path(base, table)}/provider={provider}/source={source}/load={load}")


def read_load_counts(spark: SparkSession, base: str) -> DataFrame:
    return _read(spark, base, LOAD_COUNTS, LOAD_COUNTS_SCHEMA)


def read_quarantine(spark: SparkSession, base: str) -> DataFrame:
    return _read(spark, base, QUARANTINE, QUARANTINE_SCHEMA)


def read_quarantine_fields(spark: SparkSession, base: str) -> DataFrame:
    return _read(spark, base, QUARANTINE_FIELDS, QUARANTINE_FIELDS_SCHEMA)


# --- what a load has done --------------------------------------------------------------------
def write_manifest(spark: SparkSession, base: str, source: str, load: int, months: dict[tuple[str, str], int | None], state: str) -> None:
    """The (provider, month) pairs that a load has, or had, landed rows for; ``state`` is begun or done. A row without a
    month stands for the load itself."""
    rows = [(p, m, n, state, source, load) for (p, m), n in sorted(months.items())] + [(None, None, None, state, source, load)]
    _write(literal_rows(spark, MANIFEST_SCHEMA, rows), _path(base, MANIFEST), ("source", "load"), replace_all=False)


def read_manifest(spark: SparkSession, base: str) -> DataFrame:
    return _read(spark, base, MANIFEST, MANIFEST_SCHEMA)


def read_input_files(spark: SparkSession, base: str) -> DataFrame:
    """The export files that loads have taken (``outcome`` loaded), or passed over since another load had taken
    them (known) or a copy of them (copy), or refused since a required column was missing."""
    return _read(spark, base, INPUT_FILES, INPUT_FILES_SCHEMA)


def write_input_files(files: DataFrame, base: str, source: str, load: int) -> None:
    tagged = files.withColumns({"source": F.lit(source), "load": F.lit(int(load)).cast("long")})
    _write(tagged.coalesce(1), _path(base, INPUT_FILES), ("source", "load"), replace_all=False)


def unfinished_loads(spark: SparkSession, base: str) -> list[tuple[str, int]]:
    """Loads that have begun and not come to their end."""
    if not has_table(spark, base, MANIFEST):
        return []
    rows = read_manifest(spark, base).where("state = 'begun'").select("source", "load").distinct().collect()
    return sorted((r["source"], r["load"]) for r in rows)


def months_of_load(spark: SparkSession, base: str, source: str, load: int) -> set[tuple[str, str]]:
    """(provider, month) that an earlier run of the load has, or may have, brought rows for: by the manifest, or by
    its folders where it broke off before."""
    rows = read_manifest(spark, base).where((F.col("source") == source) & (F.col("load") == load) & F.col("bill_month").isNotNull())
    found = {(r["provider"], r["bill_month"]) for r in rows.select("provider", "bill_month").collect()}
    found |= {(r["provider"], r["bill_month"]) for r in merges(spark, base, (F.col("of_source") == source) & (F.col("of_load") == load))}
    return found | {(v["provider"], v["bill_month"]) for v in map(_values, landed_folders(spark, base, source, load))}


def drop_load(spark: SparkSession, base: str, source: str, load: int, manifest: bool = False) -> None:
    """Remove what a load has stored, but for the fact and the rollup, which are rebuilt by month."""
    from costmart.sinks.compaction import take_out

    own = f"source={source}/load={load}"
    patterns = [f"{LANDING}/bill_month=*/provider=*/{own}", f"{COPIES}/bill_month=*/{own}", f"{QUARANTINE}/provider=*/{own}",
                f"{QUARANTINE_FIELDS}/provider=*/{own}",
                f"{LOAD_COUNTS}/provider=*/{own}", f"{INPUT_FILES}/{own}", *[f"{d}/source={source}/load_id={load}" for d in DIM_KEYS]]
    patterns += [f"{MANIFEST}/{own}"] if manifest else []
    for pattern in patterns:
        for folder in _folders(spark, _path(base, pattern)):
            drop_folder(spark, folder)
    take_out(spark, base, source, load)


# --- copies ----------------------------------------------------------------------------------
def write_copies(rows: dict[str, DataFrame], base: str, source: str, load: int) -> None:
    """The fingerprints of a load's canonical rows, given by month, a count of 1 each: readers add the counts up, so they are not
    gathered here."""
    from costmart.operators.fact import fingerprints

    counted = {m: r.select(*fingerprints(), F.lit(1).cast("long").alias("copies")) for m, r in rows.items()}
    write_months(counted, base, COPIES, f"/source={source}/load={load}")


def read_copies(spark: SparkSession, base: str, months: list[str]) -> DataFrame:
    """The stored counts of the months; those of loads that have none (of an older mart) are taken from their rows."""
    from costmart.operators.fact import fingerprints

    root = _path(base, COPIES)
    have = [f for m in months for f in _folders(spark, f"{root}/bill_month={m}/source=*/load=*")]
    known = {tuple(_values(f)[k] for k in ("bill_month", "source", "load")) for f in have}
    out = spark.read.schema(COPIES_SCHEMA).option("basePath", root).parquet(*have) if have else literal_rows(spark, COPIES_SCHEMA, [])
    names = {f: _values(f) for f in landed_folders(spark, base, months=months)}
    missing = [f for f, v in names.items() if v["source"] != MERGED and (v["bill_month"], v["source"], v["load"]) not in known]
    held = [r for r in merges(spark, base, F.col("bill_month").isin(months)) if (r["bill_month"], r["of_source"], str(r["of_load"])) not in known]
    if missing or held:
        rows = _landing(spark, base, missing + sorted({merged_folder(base, r) for r in held}))
        if held:
            counted = [F.struct(F.lit(m), F.lit(s), F.lit(int(n)).cast("long")) for m, s, n in sorted(known)]
            rows = rows.where(~F.struct("bill_month", "source", "load").isin(counted)) if counted else rows
        rows = rows.select("bill_month", "source", "load", *fingerprints())
        out = out.unionByName(rows.groupBy("fp_hi", "fp_lo", "bill_month", "source", "load").agg(F.count(F.lit(1)).alias("copies")))
    return out


# --- the fact and its rollup -----------------------------------------------------------------
def cluster_layout(fact: DataFrame, distributed: bool = False) -> DataFrame:
    """Add ``bill_month`` and lay rows out for the month-partitioned write.

    Rows are distributed by day and provider with a ``rebalance`` exchange (no fixed count, no
    sampling job: adaptive execution merges small partitions and splits a large one along map-output
    blocks), then sorted by (bill_month, date_key, cloud_provider), which also satisfies the writer's
    required ordering, so no second sort is planned. ``distributed=True`` skips the exchange for input
    that is already distributed so (``operators.fact.build_fact``).
    """
    assert_schema(fact, FACT_SCHEMA)
    out = fact.withColumn("bill_month", bill_month("date_key"))
    if not distributed:
        out = out.hint("rebalance", "date_key", "cloud_provider")
    return out.sortWithinPartitions("bill_month", "date_key", "cloud_provider")


def _mark_rollup(spark: SparkSession, base: str, agrees: bool) -> None:
    spark.range(1).select(F.lit(agrees).alias("agrees")).write.mode("overwrite").parquet(_path(base, ROLLUP_STATE))


def _rollup_agrees(spark: SparkSession, base: str) -> bool:
    if not has_table(spark, base, ROLLUP_STATE):
        return False
    row = spark.read.parquet(_path(base, ROLLUP_STATE)).first()
    return bool(row and row["agrees"])


def write_fact_months(fact: DataFrame | dict[str, DataFrame], base: str, distributed: bool = True, replace_all: bool = False,
                      months: list[str] | None = None, append: bool = False) -> None:
    """Write fact rows: the whole table with ``replace_all``, else only the months present in ``fact``; with
    ``append`` they are added to those months, whose files stay as they are. The daily rollup, if the mart has one, is
    refreshed for the same months; until that is done, readers don't use it.

    ``fact`` is expected as ``build_fact`` returns it (already distributed); pass ``distributed=False``
    for any other input. ``months`` names the months in ``fact`` where the caller knows them; otherwise
    the written rows' first and last month bound what is refreshed. Of ``months`` that have no row left the folder goes.

    ``fact`` may also be a frame for each month, made of landed rows, which lie by day: see ``write_months``.
    """
    by_month = isinstance(fact, dict)
    spark = (next(iter(fact.values())) if by_month else fact).sparkSession
    had_rollup = has_table(spark, base, ROLLUP_TABLE)
    if had_rollup:
        _mark_rollup(spark, base, False)
    laid_out = None if by_month else assert_schema(cluster_layout(fact, distributed), FACT_STORED_SCHEMA)
    if by_month:
        if replace_all:
            drop_folder(spark, _path(base, FACT_TABLE))
        elif months is None:
            months = sorted(fact)
        write_months({m: assert_schema(f, FACT_SCHEMA) for m, f in fact.items()}, base, FACT_TABLE, append=append)
    elif append:
        laid_out.write.mode("append").option("compression", COMPRESSION).partitionBy("bill_month").parquet(_path(base, FACT_TABLE))
    else:
        _write(laid_out, _path(base, FACT_TABLE), ("bill_month",), replace_all)
    if not had_rollup or append:
        return
    if months is None and not replace_all:
        span = fact.agg(F.min("date_key").alias("a"), F.max("date_key").alias("b")).first()
        if span["a"] is None:
            _mark_rollup(spark, base, True)
            return
        write_rollup_months(spark, base, first=span["a"][:7], last=span["b"][:7])
    else:
        write_rollup_months(spark, base, months)


def optimize_fact(spark: SparkSession, base: str, months: list[str] | None = None,
                  columns: tuple[str, ...] = ("date_key", "cloud_provider"), rows_per_file: int = 4_000_000) -> None:
    """Write months of the stored fact (all, or ``months``) anew: the small files that loads have appended become few of about
    ``rows_per_file`` rows, laid out by z-order over ``columns`` so that a filter on any of these opens few files.

    The rows, ids and rollup stay as they are. Spark replaces the months' folders once all tasks have written; the manifest says so
    meanwhile, and if the run breaks off there, the next load rebuilds these months from the landed rows. One writer at a time,
    as for loads.
    """
    from costmart.operators.clustering import z_ordered

    fact = read_fact(spark, base)
    if months is not None:
        fact = fact.where(F.col("bill_month").isin(months))
    rows = {r["bill_month"]: r["count"] for r in fact.groupBy("bill_month").count().collect()}
    if not rows:
        return
    # a task writes many files where these are small: they are cut by the writer, not by the exchange
    tasks = sum(-(-n // max(rows_per_file, ROWS_PER_LAYOUT_TASK)) for n in rows.values())
    write_manifest(spark, base, LAYOUT_RUN, 0, {("-", m): n for m, n in rows.items()}, "begun")
    laid_out = assert_schema(z_ordered(fact, columns, tasks), FACT_STORED_SCHEMA)
    _write(laid_out, _path(base, FACT_TABLE), ("bill_month",), replace_all=False, max_rows=rows_per_file)
    drop_load(spark, base, LAYOUT_RUN, 0, manifest=True)


def drop_months(spark: SparkSession, base: str, months: list[str]) -> None:
    """Remove whole months of the fact and the rollup."""
    for m in months:
        for table in (FACT_TABLE, ROLLUP_TABLE):
            drop_folder(spark, f"{_path(base, table)}/bill_month={m}")


def append_rollup(sums: DataFrame, base: str) -> None:
    """Add the partial sums of rows that were appended to the fact, as ``line_sums`` gives them. A day's key then has a row for each
    load, which reports add up like any others; ``write_rollup_months`` folds them."""
    from costmart.operators.rollup import rollup_of_sums

    rows = rollup_of_sums(sums).withColumn("bill_month", bill_month("date_key"))
    rows.hint("rebalance", "bill_month").sortWithinPartitions("bill_month", "date_key").write.mode("append").partitionBy(
        "bill_month").parquet(_path(base, ROLLUP_TABLE))
    _mark_rollup(sums.sparkSession, base, True)


def read_fact(spark: SparkSession, base: str) -> DataFrame:
    fact = spark.read.schema(FACT_STORED_SCHEMA).parquet(_path(base, FACT_TABLE))
    return assert_schema(fact, FACT_STORED_SCHEMA, ordered=False).select(*FACT_STORED_SCHEMA.fieldNames())


def write_rollup_months(spark: SparkSession, base: str, months: list[str] | None = None,
                        first: str | None = None, last: str | None = None) -> None:
    """(Re)build the daily rollup from the stored fact: for ``months``, for those from ``first`` to
    ``last``, or, if none are given, all of it (then the table is replaced).

    Reads only the fact columns the rollup needs (and only the given month folders), aggregates
    map side and replaces the same month folders of ``daily_rollup``. The rollup is small, so a
    rebalance packs each month into about one file.
    """
    from costmart.operators.rollup import daily_rollup

    fact = read_fact(spark, base)
    if months is not None:
        fact = fact.where(F.col("bill_month").isin(months))
    elif first is not None:
        fact = fact.where(F.col("bill_month").between(first, last))
    whole = months is None and first is None
    laid_out = daily_rollup(fact).hint("rebalance", "bill_month").sortWithinPartitions("bill_month", "date_key")
    _write(laid_out, _path(base, ROLLUP_TABLE), ("bill_month",), replace_all=whole)
    _mark_rollup(spark, base, True)


def read_rollup(spark: SparkSession, base: str) -> DataFrame | None:
    """The stored daily rollup, or None when the mart has none that agrees with its fact."""
    from costmart.operators.rollup import ROLLUP_SCHEMA

    return _read(spark, base, ROLLUP_TABLE, ROLLUP_SCHEMA) if _rollup_agrees(spark, base) else None


# --- dimensions ------------------------------------------------------------------------------
def write_dimension(dim: DataFrame, base: str, name: str, load_id: int = INITIAL_LOAD,
                    source: str = "batch", replace_all: bool = False) -> None:
    """Add one load of a dimension under ``source=S/load_id=N`` (a replay of the same load
    replaces itself), or replace the table. Each writer (batch job, one stream per provider) owns its
    ``source``.

    ``dim_account`` needs ``last_seen`` (the data date of its attributes, see
    ``build_dim_account(keep_last_seen=True)``), so that a late file with older attributes does not
    override newer ones.
    """
    if name == "dim_account":
        if "last_seen" not in dim.columns:
            raise ValueError("dim_account is stored with last_seen: build it with keep_last_seen=True")
        assert_schema(dim.drop("last_seen"), DIM_SCHEMAS[name])
    else:
        assert_schema(dim, DIM_SCHEMAS[name])
    # rebalance: adaptive execution packs a small dimension into one file and cuts a large
    # one (accounts) into files of about the advisory size
    tagged = dim.withColumn("source", F.lit(source)).withColumn("load_id", F.lit(int(load_id)).cast("long"))
    _write(tagged.hint("rebalance"), _path(base, name), ("source", "load_id"), replace_all)


def upsert_dimension(new_rows: DataFrame, base: str, name: str, load_id: int, source: str = "batch") -> None:
    """Upsert: store ``new_rows`` as a later load; readers resolve one row per key."""
    if load_id <= INITIAL_LOAD:
        raise ValueError("an upsert needs a load_id after the initial load")
    write_dimension(new_rows, base, name, load_id, source)


def _current(spark: SparkSession, base: str, name: str) -> DataFrame:
    """For each key the row that counts, in stored form without the load columns.

    Accounts: the greatest (last_seen, account_name, team, environment), which is the rule the full
    build has, so the order and the number of the loads don't matter. Others: the latest load's; of
    loads with one number, that of the greater source name. One map-side combined aggregate.
    """
    last_seen = [StructField("last_seen", DateType())] if name == "dim_account" else []
    loads = _read(spark, base, name, StructType([*DIM_SCHEMAS[name].fields, *last_seen, StructField("source", StringType()),
                                                 StructField("load_id", LongType())]))
    key, attrs = DIM_KEYS[name], [f for f in DIM_SCHEMAS[name].fieldNames() if f != DIM_KEYS[name]]
    if name == "dim_account":
        order = ["last_seen", "account_name", "team", "environment"]
        attrs = [*order, *[a for a in attrs if a not in order]]
        best = F.max(F.struct(*attrs))
    else:
        best = F.max(F.struct("load_id", "source", *attrs))
    return loads.groupBy(key).agg(best.alias("v")).select(key, *[F.col(f"v.{a}").alias(a) for a in attrs])


def read_dimension(spark: SparkSession, base: str, name: str) -> DataFrame:
    """Current dimension rows."""
    schema = DIM_SCHEMAS[name]
    return assert_schema(_current(spark, base, name).select(*schema.fieldNames()), schema)


def compact_dimension(spark: SparkSession, base: str, name: str, new_base: str) -> None:
    """Write the current rows of a dimension as a single load under ``new_base``.

    Loads accumulate with every incremental run; compaction resolves them once (the same aggregate
    readers use) into a fresh folder, never in place. Point readers at ``new_base`` afterwards.
    ``dim_account`` keeps its ``last_seen`` so later loads still merge by data date.
    """
    names = [*DIM_SCHEMAS[name].fieldNames(), *(["last_seen"] if name == "dim_account" else [])]
    write_dimension(_current(spark, base, name).select(*names), new_base, name, INITIAL_LOAD, source="compacted")


def write_dimensions(combined: DataFrame, base: str, load_id: int = INITIAL_LOAD, source: str = "batch",
                     replace_all: bool = False) -> None:
    """Build and write all four dimensions from one pass over ``combined``.

    The grouping-sets aggregate (dimension-sized output) is persisted while the four writes
    read it, side by side, and released afterwards; a lost cache block is recomputed from its lineage.
    """
    from costmart.operators.dimensions import dimension_keys, dimensions_from_keys

    keys = dimension_keys(combined).persist()
    try:
        together(*[partial(write_dimension, dim, base, name, load_id, source, replace_all)
                   for name, dim in dimensions_from_keys(keys, keep_last_seen=True).items()])
    finally:
        keys.unpersist()


# --- the mart --------------------------------------------------------------------------------
def write_mart(fact: DataFrame, dims: dict[str, DataFrame], base: str, load_id: int = INITIAL_LOAD) -> None:
    """Write the five tables whole, replacing what is there (schemas asserted before each write).

    An account dimension without ``last_seen`` gets it from the fact: the last day of each account.
    """
    write_fact_months(fact, base, replace_all=True)
    for name, dim in dims.items():
        if name == "dim_account" and "last_seen" not in dim.columns:
            seen = fact.groupBy("account_key").agg(F.max(F.col("date_key").cast("date")).alias("last_seen"))
            dim = dim.join(seen, "account_key", "left").select(*dim.columns, "last_seen")
        write_dimension(dim, base, name, load_id, replace_all=True)


def load_mart_tables(spark: SparkSession, base: str) -> tuple[DataFrame, dict[str, DataFrame]]:
    return read_fact(spark, base), {n: read_dimension(spark, base, n) for n in DIM_SCHEMAS}
