"""Data quality: drop counts by reason, quarantine of malformed rows, mart validation.

Each check is one aggregate (one pass), not a series of ``count()`` actions that rescan input.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from costmart.functions.dates import bill_month, valid_date
from costmart.functions.keys import fingerprint_halves
from costmart.functions.money import is_exact
from costmart.operators.fact import fact_lines
from costmart.operators.normalize import keep_condition
from costmart.schemas import CANONICAL_COLUMNS
from costmart.sources.billing_csv import CORRUPT_COLUMN, MALFORMED_FIELDS, malformed_fields
from costmart.sources.layouts import SourceLayout


def _null_reason(layout: SourceLayout, canonical: str):
    return F.col(layout.raw(canonical)).isNull()


def _malformed(raw: DataFrame):
    """True where some field of the line did not parse (needs ``read_export(keep_corrupt=True)``)."""
    return F.col(CORRUPT_COLUMN).isNotNull() if CORRUPT_COLUMN in raw.columns else F.lit(False)


def count_columns(raw: DataFrame, layout: SourceLayout) -> list[Column]:
    """The aggregates of ``drop_counts``, which a load observes while it lands the rows."""
    date_col = F.col(layout.raw("date_key"))
    keep = keep_condition(layout)
    return [
        F.count(F.lit(1)).alias("raw_rows"),
        F.count_if(_null_reason(layout, "date_key")).alias("null_date"),
        F.count_if(_null_reason(layout, "cost_usd")).alias("null_cost"),
        F.count_if(_null_reason(layout, "service_name")).alias("null_service"),
        F.count_if(_null_reason(layout, "account_id")).alias("null_account"),
        F.count_if(date_col.isNotNull() & ~valid_date(date_col)).alias("bad_date"),
        F.count_if(keep & ~is_exact(layout.raw("cost_usd"))).alias("inexact_cost"),
        F.count_if(_malformed(raw)).alias("malformed_rows"),
        F.count_if(~keep).alias("dropped_rows"),
        F.count_if(keep).alias("kept_rows"),
    ]


def drop_counts(raw: DataFrame, layout: SourceLayout) -> DataFrame:
    """One row per source: raw rows, rows failing each rule, rows dropped, rows kept.

    A row can fail several rules; ``dropped_rows`` counts it once. ``inexact_cost`` counts kept rows
    whose cost is summed as DOUBLE (see ``functions.money``), ``malformed_rows`` lines with a field that
    did not parse (kept if the field is optional). The latter needs every field parsed: over CSV text a
    query parses only the columns that it reads.
    """
    return raw.agg(F.lit(layout.provider).alias("cloud_provider"), *count_columns(raw, layout))


def quarantine(raw: DataFrame, layout: SourceLayout) -> DataFrame:
    """Rows the drop rule removes, and kept rows with a malformed optional field (``kept``), each with
    the first reason that applies.

    ``raw`` may carry ``_corrupt_record`` (see ``read_export(keep_corrupt=True)``); a line with
    an unparseable field is reported as ``malformed`` together with its original text.
    """
    has_corrupt = CORRUPT_COLUMN in raw.columns
    date_col = F.col(layout.raw("date_key"))
    keep = keep_condition(layout)
    reason = F.when(_malformed(raw), F.lit("malformed"))
    rules = [
        (date_col.isNull(), "null_date"),
        (~valid_date(date_col), "bad_date"),
        (_null_reason(layout, "cost_usd"), "null_cost"),
        (_null_reason(layout, "service_name"), "null_service"),
        (_null_reason(layout, "account_id"), "null_account"),
    ]
    for cond, name in rules:
        reason = reason.when(cond, F.lit(name))
    # one layout for every provider: raw values under canonical names (no defaults applied)
    cols = [F.lit(layout.provider).alias("cloud_provider"), reason.alias("reason"), keep.alias("kept")]
    cols += [F.col(layout.raw(c)).alias(c) for c in CANONICAL_COLUMNS if c != "cloud_provider"]
    raw_line = F.col(CORRUPT_COLUMN) if has_corrupt else F.lit(None).cast("string")
    cols.append(raw_line.alias("raw_line"))
    return raw.where(~keep | _malformed(raw)).select(*cols)


def quarantine_fields(raw: DataFrame, layout: SourceLayout) -> DataFrame:
    """``(cloud_provider, field, text, raw_line)``: a row for each field of a malformed line that did not parse, by its name in the
    export; of a line that is malformed as a whole (a wrong number of fields) one row without a field."""
    if CORRUPT_COLUMN not in raw.columns:
        raw = raw.withColumn(CORRUPT_COLUMN, F.lit(None).cast("string"))
    found = F.col(MALFORMED_FIELDS) if MALFORMED_FIELDS in raw.columns else malformed_fields(layout.raw_schema)
    # of text only the fields that a query reads are parsed (and found malformed): this condition, always true, reads them all
    parsed = F.length(F.concat_ws("", *layout.raw_schema.fieldNames())) >= 0
    lines = raw.where(_malformed(raw) & parsed).select(F.col(CORRUPT_COLUMN).alias("raw_line"), F.explode_outer(found).alias("f"))
    return lines.select(F.lit(layout.provider).alias("cloud_provider"), F.col("f.field").alias("field"), F.col("f.text").alias("text"), "raw_line")


_FACT_KEYS = {"dim_date": "date_key", "dim_service": "service_key", "dim_account": "account_key", "dim_region": "region_key"}


def content_by_month(lines: DataFrame) -> DataFrame:
    """``(bill_month, num_rows, content)``: a hash of each month's rows as a multiset, whatever their order, ids and files.

    ``lines`` is the fact or ``fact_lines`` of canonical rows. Each row has two seeded 64-bit hashes, and each of their 16-bit
    parts is summed as a long: exact up to 2^47 rows a month, in generated code and combined map side, so a row per month and
    task is shuffled. Equal rows add up (unlike under an exclusive or), so a row stored twice shows, too.
    """
    flat = lines.select(
        bill_month("date_key").alias("bill_month"),
        "date_key", "service_key", "account_key", "region_key", "cloud_provider", "cost_usd", "usage_quantity", "usage_unit",
        F.col("tags")["environment"].alias("tag_environment"), F.col("tags")["team"].alias("tag_team"))
    halves = fingerprint_halves([c for c in flat.columns if c != "bill_month"])
    hashed = flat.select("bill_month", *[h.alias(n) for h, n in zip(halves, ("hi", "lo"))])
    sums = [F.sum(F.shiftrightunsigned(n, shift).bitwiseAND(F.lit(0xFFFF))) for n in ("hi", "lo") for shift in (0, 16, 32, 48)]
    return hashed.groupBy("bill_month").agg(F.count(F.lit(1)).alias("num_rows"), F.array(*sums).alias("content"))


def months_with_other_content(fact: DataFrame, canonical: DataFrame) -> DataFrame:
    """``(bill_month, fact_rows, expected_rows)`` of months in which the fact doesn't hold exactly the lines of ``canonical``:
    rows lost, doubled or swapped, or any value changed, also where the counts agree."""
    have = content_by_month(fact).select("bill_month", F.col("num_rows").alias("fact_rows"), F.col("content").alias("have"))
    want = content_by_month(fact_lines(canonical)).select("bill_month", F.col("num_rows").alias("expected_rows"), F.col("content").alias("want"))
    zero = F.lit(0).cast("long")
    return (have.join(want, "bill_month", "full_outer").where(~F.col("have").eqNullSafe(F.col("want")))
            .select("bill_month", F.coalesce("fact_rows", zero).alias("fact_rows"), F.coalesce("expected_rows", zero).alias("expected_rows")))


def validate_mart(fact: DataFrame, dims: dict[str, DataFrame],
                  expected_fact_rows: DataFrame | None = None, content: bool = False) -> DataFrame:
    """Validation rows ``(table_name, rule, observed, passed)``.

    Rules: every table non-empty; no NULL cost and no NULL dimension key in the fact; no fact row whose
    key has no dimension row; dimension keys unique; optionally, fact rows equal the canonical
    input rows (one fact row per line item), and with ``content`` every month's lines are those of the input, too
    (``content_by_month``, one more scan of both). For the other rules the fact is scanned once: it is counted per
    combination of keys (map-side combined), those few rows meet the dimensions, and one aggregate
    gives all its figures, which ``stack`` turns into rows. Each dimension is scanned once for its own
    rules and once for the key lookup.
    """
    per_key = fact.groupBy(*_FACT_KEYS.values()).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("cost_usd").isNull()).alias("null_cost"))
    null_key = F.col("service_key").isNull() | F.col("account_key").isNull() | F.col("region_key").isNull()
    sums = {"rows": F.col("n"), "null_cost": F.col("null_cost"), "null_keys": F.when(null_key, F.col("n")).otherwise(0)}
    for name, key in _FACT_KEYS.items():
        known = dims[name].select(F.col(key).alias(f"_{key}")).distinct()
        per_key = per_key.join(known, F.col(key) == F.col(f"_{key}"), "left")
        sums[f"orphans_{name}"] = F.when(F.col(key).isNotNull() & F.col(f"_{key}").isNull(), F.col("n")).otherwise(0)
    counted = per_key.select(*[v.alias(k) for k, v in sums.items()], F.lit(0).cast("long").alias("expected"))
    if expected_fact_rows is not None:
        n = expected_fact_rows.agg(F.count(F.lit(1)).alias("expected"))
        counted = counted.unionByName(n.select(*[F.lit(0).cast("long").alias(k) for k in sums], "expected"))
    totals = counted.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in [*sums, "expected"]])
    rules = [("'not_empty'", "rows", "rows > 0"), ("'no_null_cost'", "null_cost", "null_cost = 0"),
             ("'no_null_keys'", "null_keys", "null_keys = 0")]
    rules += [(f"'no_orphans_{n}'", f"orphans_{n}", f"orphans_{n} = 0") for n in _FACT_KEYS]
    if expected_fact_rows is not None:
        rules.append(("'one_row_per_line_item'", "rows", "rows = expected"))
    stack = ", ".join(f"'fact_cloud_costs', {rule}, {value}, {test}" for rule, value, test in rules)
    parts = [totals.selectExpr(f"stack({len(rules)}, {stack}) AS (table_name, rule, observed, passed)")]
    if content:
        if expected_fact_rows is None:
            raise ValueError("content is compared with expected_fact_rows: give them")
        differing = months_with_other_content(fact, expected_fact_rows).agg(F.count(F.lit(1)).alias("observed"))
        parts.append(differing.selectExpr("'fact_cloud_costs' AS table_name", "'same_content_per_month' AS rule", "observed", "observed = 0 AS passed"))
    for name, df in dims.items():
        own = df.groupBy(_FACT_KEYS[name]).agg(F.count(F.lit(1)).alias("n")).agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("rows"), F.count_if(F.col("n") > 1).alias("repeated"))
        parts.append(own.selectExpr(f"stack(2, '{name}', 'not_empty', rows, rows > 0, "
                                    f"'{name}', 'unique_keys', repeated, repeated = 0) AS (table_name, rule, observed, passed)"))
    return reduce(lambda a, b: a.unionAll(b), parts)


def mart_summary(tables: dict[str, DataFrame]) -> DataFrame:
    """Row count per table: ``(table_name, row_count)``, one aggregate per table."""
    parts = [df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
             for name, df in tables.items()]
    return reduce(lambda a, b: a.unionAll(b), parts)


class ValidationFailed(AssertionError):
    pass


def raise_on_failures(validation: DataFrame) -> list:
    """Collect validation rows (a fixed handful, one per table and rule) and raise if any rule
    failed, so a scheduled run stops before bad data reaches a dashboard. Returns the rows."""
    rows = validation.collect()
    failed = [r for r in rows if not r.passed]
    if failed:
        raise ValidationFailed("; ".join(f"{r.table_name}.{r.rule} observed {r.observed}" for r in failed))
    return rows
