"""fact_cloud_costs: one row per canonical line item.

Keys (``keys="derive"``, the default): the three dimension keys are md5 of (provider | natural
key), which every row can compute itself, so the fact needs no join at all. ``keys="lookup"``
does the LEFT joins against given (stored) dimensions and leaves NULL where a dimension row is
missing; how each is joined is left to the planner and to adaptive execution.

Row ids: ``cost_id`` = md5(row fingerprint # occurrence number). Identical line items are
interchangeable, so numbering the copies of each distinct row 1..k gives the same set of ids on
every run and under any partitioning. Only rows whose 128-bit fingerprint occurs more than once are
numbered by an aggregate; every other row is occurrence 1 and crosses nothing but the layout
exchange. A group of copies larger than ``chunk`` is cut into chunks that are spread over tasks
before they are expanded, so even a group holding a third of all rows is generated in parallel and
never held in one task's memory (see ``number_copies``).
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from costmart.functions.keys import account_key, fingerprint_halves, fingerprint_hex, region_key, service_key
from costmart.schemas import CANONICAL_COLUMNS, FACT_SCHEMA, assert_schema
from costmart.session import MONTHS_AT_ONCE, scratch_path, together

DEFAULT_CHUNK = 1 << 20
#: Up to so many repeated fingerprints are joined with the rows to mark them.
FEW_REPEATED = 1 << 19
#: Rows that a task counts where all rows are dealt out by day and counted there (``by_day``).
ROWS_PER_DAY_PART = 1 << 18
DAY_BUCKETS = 64  # into so many a day's rows fall when groups of more than a chunk are looked for
#: The canonical columns that the fact is made of.
FACT_INPUTS = tuple(c for c in CANONICAL_COLUMNS if c not in ("account_name", "resource_id"))


def tags_map() -> Column:
    return F.create_map(F.lit("environment"), F.col("environment"), F.lit("team"), F.col("team"))


def fact_lines(combined: DataFrame) -> DataFrame:
    """The fact without ``cost_id``: a pure projection (no shuffle). Reports need only this."""
    return combined.select(
        "date_key",
        service_key().alias("service_key"),
        account_key().alias("account_key"),
        region_key().alias("region_key"),
        "cloud_provider", "cost_usd", "usage_quantity", "usage_unit",
        tags_map().alias("tags"),
    )


def fingerprints() -> list[Column]:
    """The two halves of a canonical row's fingerprint."""
    hi, lo = fingerprint_halves(list(CANONICAL_COLUMNS))
    return [hi.alias("fp_hi"), lo.alias("fp_lo")]


def repeated_fingerprints(combined: DataFrame, copies: DataFrame | None = None, own: DataFrame | None = None,
                          months: list[str] | None = None) -> DataFrame:
    """(fp_hi, copies, repeated_after) of rows that need an occurrence number, stored: an aggregate over a long or two per row.

    These occur more than once in ``combined``, and ``repeated_after`` is 0. ``copies`` are their counts (fp_hi, fp_lo, copies; any
    number of rows each) where they are stored. Half the fingerprint tells them apart well enough here: a row that is among them by
    chance is numbered like the others and gets a 1. With ``own``, the counts of ``combined`` alone, ``copies`` are those of rows
    that have been numbered before: then a row also needs a number where it occurs among them, ``repeated_after`` times, and the set has
    ``fp_lo`` too. With ``months``, all those of the counts, which then have a ``bill_month``, each month's are added up by a job
    of its own (equal rows have one day), and the set has the month, too: there is a group for nearly every row, so a task holds what it reads.

    Stored, so that the planner knows its size when it plans the join with the rows: a small set
    (the usual case) is broadcast and the rows are not shuffled for it."""
    def total(counts: DataFrame, name: str, *keys: str) -> DataFrame:
        return counts.groupBy(*keys).agg(F.sum("copies").alias(name))

    both = ("fp_hi", "fp_lo")
    if copies is None:
        copies = combined.select(fingerprints()[0], F.lit(1).cast("long").alias("copies"))

    def found(copies: DataFrame, own: DataFrame | None) -> DataFrame:
        if own is None:
            return total(copies, "n", "fp_hi").where("n > 1").select(
                "fp_hi", F.col("n").alias("copies"), F.lit(0).cast("long").alias("repeated_after"))
        # both in one aggregate, not one each and a join of the two
        none = F.lit(0).cast("long")
        all_counts = own.select(*both, F.col("copies").alias("n"), none.alias("before")).unionAll(
            copies.select(*both, none.alias("n"), F.col("copies").alias("before")))
        return (all_counts.groupBy(*both).agg(F.sum("n").alias("n"), F.sum("before").alias("before"))
                .where("n > 1 OR (n > 0 AND before > 0)").select(*both, F.col("n").alias("copies"), F.col("before").alias("repeated_after")))

    path = scratch_path(combined.sparkSession, "repeated")
    schema = found(copies, own).schema
    if months:
        of = lambda counts, month: None if counts is None else counts.where(F.col("bill_month") == month)
        together(*[partial(found(of(copies, m), of(own, m)).write.parquet, f"{path}/bill_month={m}") for m in months], at_once=MONTHS_AT_ONCE)
        schema = schema.add("bill_month", "string")
    else:
        found(copies, own).write.parquet(path)
    return combined.sparkSession.read.schema(schema).parquet(path)


def stored(frame: DataFrame, name: str) -> DataFrame:
    """The frame, written to a scratch table and read from there."""
    path = scratch_path(frame.sparkSession, name)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def _counted_by_day(combined: DataFrame, cols: list[str], chunk: int) -> tuple[DataFrame, DataFrame | None]:
    """The groups of equal rows with their ``copies``, lying by day and provider; those of more than ``chunk`` copies apart, if any.

    One exchange: equal rows have one day, so all rows are dealt out to parts of about ``ROWS_PER_DAY_PART`` rows in the order of
    the days, and are counted where they come to lie. A day with more rows than that is cut by fingerprint. How many rows each day
    has is counted first, by two numbers of a row in so many buckets a day, for which no other column is made; that also shows where a
    group of more than ``chunk`` copies may be: those are counted map side. Where all columns cross the exchange the fingerprints need
    not, since they follow from them.
    """
    day, fps = ["date_key", "cloud_provider"], ["fp_hi", "fp_lo"]
    rows = combined.select(*cols, *fingerprints())
    bucket, n = F.pmod(F.xxhash64("cost_usd", "usage_quantity"), F.lit(DAY_BUCKETS)).alias("bucket"), F.count(F.lit(1)).alias("copies")
    buckets = stored(combined.groupBy(*day, bucket).agg(F.count(F.lit(1)).alias("n")), "day-buckets")
    large = buckets.where(F.col("n") > chunk)
    hot = hot_groups = None
    if not large.isEmpty():
        near = combined.select(*day, bucket, *fingerprints()).join(F.broadcast(large.drop("n")), [*day, "bucket"], "left_semi")
        hot = stored(near.groupBy(*fps).agg(n).where(F.col("copies") > chunk), "hot")
        if hot.isEmpty():
            hot = None
    if hot is not None:
        hot_groups = rows.join(F.broadcast(hot.select(*fps)), fps, "left_semi").groupBy(*cols, *fps).agg(n)
        rows = rows.join(F.broadcast(hot.select(*fps)), fps, "left_anti")

    total = buckets.agg(F.sum("n")).first()[0] or 0
    days = buckets.groupBy(*day).agg(F.sum("n").alias("n"))
    # a row per day, whatever the number of rows
    days = days.withColumn("before", F.sum("n").over(Window.orderBy(*day).rowsBetween(Window.unboundedPreceding, -1)))
    days = stored(days.select(*[F.col(c).alias(f"of_{c}") for c in day], "n", F.coalesce("before", F.lit(0).cast("long")).alias("before")), "days")
    place = F.when(F.col("n") <= ROWS_PER_DAY_PART, F.call_function("div", F.col("n"), F.lit(2))).otherwise(F.pmod("fp_lo", "n"))
    part = F.call_function("div", F.col("before") + place, F.lit(ROWS_PER_DAY_PART)).cast("int")
    placed = rows.join(F.broadcast(days), (F.col("date_key").eqNullSafe(F.col("of_date_key")))
                       & (F.col("cloud_provider").eqNullSafe(F.col("of_cloud_provider"))), "left")
    whole = set(cols) == set(CANONICAL_COLUMNS)
    placed = placed.select(*cols, *([] if whole else fps), F.coalesce(part, F.lit(0)).alias("part"))
    dealt = placed.repartitionById(total // ROWS_PER_DAY_PART + 1, F.col("part"))
    if whole:
        dealt = dealt.select("*", *fingerprints())
    return dealt.groupBy("part", *cols, *fps).agg(n).drop("part"), hot_groups


def number_copies(combined: DataFrame, chunk: int = DEFAULT_CHUNK, copies: DataFrame | None = None, own: DataFrame | None = None,
                  columns: tuple[str, ...] = tuple(CANONICAL_COLUMNS), clustered: bool = False, few: int | None = FEW_REPEATED,
                  repeated: DataFrame | None = None, by_day: bool = False) -> DataFrame:
    """Canonical rows plus ``row_fp`` (fingerprint) and ``occurrence``: 1..copies, or behind those that have been numbered
    before (see ``repeated_fingerprints``).

    Plan: rows are marked by whether their fingerprint is repeated. Those that are not go straight to
    the ``rebalance`` exchange that lays the data out for the write, by day and provider. The copies
    of the others are counted (map-side partial aggregation collapses them inside each task first) and
    become one marker per chunk of at most ``chunk`` copies, which goes through the same exchange;
    the chunk is part of its key, so the chunks of a hot group land in different tasks. Markers are
    expanded to occurrence numbers only after the exchange, so no task holds or generates more than
    one chunk of a group at a time.

    Where more than ``few`` fingerprints are repeated, too many to be broadcast, all rows are counted instead: they cross one
    exchange by fingerprint, are read once and are joined with nothing. Groups of more than ``chunk`` copies, which are few, are counted map side
    there too.

    ``columns`` are the canonical ones that the caller needs besides the day and the provider: no others cross an exchange.
    The output is distributed by day, ready for ``sinks.mart_store.write_fact_months``; rows of ``combined`` that are so already
    (``clustered``) stay where they are. ``repeated`` is what ``repeated_fingerprints`` gives, where the caller has it for these rows and
    others; ``few=None``: it is known to be small. ``by_day``: that there are many, of rows that have not been numbered before, is
    known; then they are not looked for, and the rows are dealt out by day first and counted there (``_counted_by_day``).
    """
    cols = [c for c in CANONICAL_COLUMNS if c in {*columns, "date_key", "cloud_provider"}]
    zero, rows = F.lit(0).cast("long"), combined.select(*cols, *fingerprints())
    if by_day and (copies is not None or own is not None or repeated is not None):
        raise ValueError("by_day counts the rows themselves: it takes no counts")
    if repeated is None and not by_day:
        repeated = repeated_fingerprints(combined, copies, own)
    on = [] if by_day else [c for c in ("fp_hi", "fp_lo") if c in repeated.columns]

    def chunks(groups: DataFrame) -> DataFrame:
        return groups.select(*cols, "fp_hi", "fp_lo", "copies", "repeated_after", F.explode(
            F.sequence(zero, F.floor((F.col("copies") - 1) / chunk))).alias("chunk"))

    def laid_out(markers: DataFrame) -> DataFrame:
        return markers.hint("rebalance", "date_key", "cloud_provider", "chunk")

    n = F.count(F.lit(1)).alias("copies")
    if by_day:
        groups, hot = _counted_by_day(combined, cols, chunk)
        markers = chunks(groups.withColumn("repeated_after", zero))
        if hot is not None:
            markers = markers.unionByName(laid_out(chunks(hot.withColumn("repeated_after", zero))))
    elif few is None or repeated.count() <= few:
        marked = rows.join(repeated.select(*on, "repeated_after"), on, "left")
        alone = marked.where(F.col("repeated_after").isNull()).select(
            *cols, "fp_hi", "fp_lo", F.lit(1).cast("long").alias("copies"), zero.alias("repeated_after"), zero.alias("chunk"))
        counted = chunks(marked.where(F.col("repeated_after").isNotNull()).groupBy(*cols, "fp_hi", "fp_lo")
                         .agg(n, F.max("repeated_after").alias("repeated_after")))
        markers = alone.unionByName(laid_out(counted)) if clustered else laid_out(alone.unionByName(counted))
    else:
        hot = repeated.where(F.col("copies") > chunk).select(*on)
        any_hot = not hot.isEmpty()
        others = rows.join(F.broadcast(hot), on, "left_anti") if any_hot else rows
        groups = others.repartition("fp_hi", "fp_lo").groupBy(*cols, "fp_hi", "fp_lo").agg(n)
        if any_hot:
            groups = groups.unionByName(rows.join(F.broadcast(hot), on, "left_semi").groupBy(*cols, "fp_hi", "fp_lo").agg(n))
        if "fp_lo" not in on:
            groups = groups.withColumn("repeated_after", zero)
        else:
            groups = (groups.join(repeated.select(*on, "repeated_after"), on, "left")
                      .withColumn("repeated_after", F.coalesce("repeated_after", zero)))
        markers = laid_out(chunks(groups))
    first = F.col("repeated_after") + F.col("chunk") * chunk + 1
    last = F.col("repeated_after") + F.least((F.col("chunk") + 1) * chunk, F.col("copies"))
    # the fingerprint crosses the exchange as two longs; its text form is built afterwards
    return markers.select(*cols, fingerprint_hex(F.col("fp_hi"), F.col("fp_lo")).alias("row_fp"),
                          F.explode(F.sequence(first, last)).alias("occurrence"))


def cost_id() -> Column:
    return F.md5(F.concat(F.col("row_fp"), F.lit("#"), F.col("occurrence").cast("string")))


def _lookup_keys(rows: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    svc = dims["dim_service"].select("service_key", "cloud_provider", "service_name")
    acc = dims["dim_account"].select("account_key", "cloud_provider", "account_id")
    reg = dims["dim_region"].select("region_key", "cloud_provider", "region_code")
    return (rows
            .join(svc, ["cloud_provider", "service_name"], "left")
            .join(acc, ["cloud_provider", "account_id"], "left")
            .join(reg, ["cloud_provider", "region_code"], "left"))


def build_fact(combined: DataFrame, *, keys: str = "derive", dims: dict[str, DataFrame] | None = None,
               chunk: int = DEFAULT_CHUNK, copies: DataFrame | None = None, own: DataFrame | None = None,
               clustered: bool = False, ids_only: bool = False, few: int | None = FEW_REPEATED, repeated: DataFrame | None = None,
               by_day: bool = False) -> DataFrame:
    """``copies`` and ``own``: stored counts of fingerprints, see ``repeated_fingerprints``; ``clustered``, ``few``, ``repeated`` and ``by_day``:
    see ``number_copies``. ``ids_only``: of the fact the id, day and provider, so that nothing else has to cross the exchanges."""
    numbered = number_copies(combined, chunk, copies, own, () if ids_only else FACT_INPUTS, clustered, few, repeated, by_day)
    if ids_only:
        return numbered.select(cost_id().alias("cost_id"), "date_key", "cloud_provider")
    if keys == "derive":
        keyed = numbered.select("*", service_key().alias("service_key"), account_key().alias("account_key"),
                                region_key().alias("region_key"))
    elif keys == "lookup":
        if not dims:
            raise ValueError("keys='lookup' needs dims")
        keyed = _lookup_keys(numbered, dims)
    else:
        raise ValueError(f"unknown keys mode {keys!r}")
    out = keyed.select(
        cost_id().alias("cost_id"), "date_key", "service_key", "account_key", "region_key",
        "cloud_provider", "cost_usd", "usage_quantity", "usage_unit", tags_map().alias("tags"))
    return assert_schema(out, FACT_SCHEMA)
