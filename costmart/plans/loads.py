"""One load of export rows into a stored mart, full or incremental.

Every kind of load lands its canonical rows in one store, under its source and number. A load that the mart has no
trace of appends: its rows get the occurrence numbers behind those of the month's stored fingerprints, so it writes
its own rows only and the ids are those of a full rebuild. Any other load (a replay, a corrected export, the load after one
that broke off) takes back what its earlier run brought and rebuilds the months of both from all landed rows.

What has happened is read from the mart: the manifest says for which months a load has landed rows and whether it came
to its end, and ``input_files`` which export files have been taken, whoever took them. So a second inbox or a lost
stream checkpoint neither loses rows nor counts them twice. A load that broke off is taken back by the next one.
One load at a time: two loads into one mart at once would race.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from costmart.operators.fact import FEW_REPEATED, build_fact, fingerprints, repeated_fingerprints, stored
from costmart.operators.normalize import normalize_with_files
from costmart.operators.quality import count_columns, quarantine, quarantine_fields
from costmart.operators.rollup import line_sums
from costmart.schemas import CANONICAL_COLUMNS
from costmart.session import together
from costmart.sinks import compaction
from costmart.sinks import mart_store as store
from costmart.sources.billing_csv import INPUT_COLUMNS, missing_columns, read_files_by_header, read_headers
from costmart.sources.layouts import SourceLayout


def _land(spark: SparkSession, exports: list[tuple[SourceLayout, DataFrame]], base: str, source: str, load: int,
          replace_all: bool) -> tuple[dict[tuple[str, str], int], dict[str, dict]]:
    """Land the kept rows, counting all rows on the way: rows by (provider, month), and counts by provider."""
    frames, observed = [], {}
    for layout, raw in exports:
        observed[layout.provider] = Observation()
        counted = raw.observe(observed[layout.provider], *count_columns(raw, layout))
        frames.append(normalize_with_files(counted, layout))
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    store.land_rows(rows, base, source, load, replace_all)
    landed = {(r["provider"], r["bill_month"]): r["count"] for r in
              store.read_landed_load(spark, base, source, load).groupBy("provider", "bill_month").count().collect()}
    counts = {}
    for layout, raw in exports:
        kept = sum(n for (p, _), n in landed.items() if p == layout.provider)
        # of a plan that turns out empty nothing is observed, and a task that ran twice has been observed twice
        found = observed[layout.provider].get if kept else {}
        if found.get("kept_rows") != kept:
            # all columns are asked for, since of text only those are parsed (and found malformed)
            found = raw.agg(*count_columns(raw, layout), F.max(F.xxhash64(*raw.columns))).first().asDict()
        counts[layout.provider] = found
    return landed, counts


def _by_provider(frames: list[tuple[str, DataFrame]]) -> dict[str, DataFrame]:
    return {p: reduce(DataFrame.unionByName, [df for q, df in frames if q == p]) for p, _ in frames}


def load_exports_into(spark: SparkSession, exports: list[tuple[SourceLayout, DataFrame]], base: str, source: str,
                      load: int, replace_all: bool = False, input_files: list[tuple] | None = None,
                      refused: list[tuple[str, str]] | None = None) -> list[str]:
    """Load raw export rows (as ``read_export(keep_corrupt=True)`` gives them) into the mart at ``base``.

    ``replace_all`` is a full load: afterwards the mart holds exactly these rows. Otherwise the rows are
    added to what other loads have landed; a load with the same ``source`` and number replaces its earlier run whole,
    months, quarantine and counts that the new run doesn't have included. ``input_files``: (path, size, time, outcome) to
    remember. ``refused``: (provider, text) of files that were not read at all, for the quarantine. Returns the months touched, a handful of partition values. A load without a single kept row touches none
    and is only recorded.

    The exports are read once for the landed rows and their counts, and once more for the quarantine where there is any.
    """
    if not replace_all and store.has_table(spark, base, store.FACT_TABLE) and not store.has_table(spark, base, store.LANDING):
        raise ValueError(f"{base} holds a fact without landed rows: an incremental load would lose them")
    compaction.finish(spark, base)
    earlier: set[tuple[str, str]] = set()
    if replace_all:
        for table in (store.MANIFEST, store.INPUT_FILES, store.COPIES, store.QUARANTINE, store.QUARANTINE_FIELDS):
            store.drop_folder(spark, f"{base.rstrip('/')}/{table}")
    else:
        broken = [x for x in store.unfinished_loads(spark, base) if x != (source, load)]
        earlier = set().union(*[store.months_of_load(spark, base, *x) for x in [(source, load), *broken]])
    # what is taken back below must be rebuilt even if this run breaks off, too
    store.write_manifest(spark, base, source, load, dict.fromkeys(earlier), "begun")
    if not replace_all:
        store.drop_load(spark, base, source, load)
        for x in broken:
            store.drop_load(spark, base, *x, manifest=True)

    landed, counts = _land(spark, exports, base, source, load, replace_all)

    def record() -> None:
        rows = [(p, *(counts[p][n] for n in store.COUNT_NAMES), p, source, load) for p in counts]
        rejected = [(layout.provider, quarantine(raw, layout)) for layout, raw in exports
                    if counts[layout.provider]["dropped_rows"] or counts[layout.provider]["malformed_rows"]]
        names = {"cloud_provider": 0, "reason": 1, "kept": 2, "raw_line": 3}
        for provider in sorted({p for p, _ in refused or []}):
            lines = [(p, "missing_columns", False, text) for p, text in refused if p == provider]
            rejected.append((provider, store.literal_rows(spark, store.QUARANTINE_SCHEMA, [
                tuple(line[names[f]] if f in names else None for f in store.QUARANTINE_SCHEMA.fieldNames()) for line in lines])
                .drop("provider", "source", "load")))
        fields = [(layout.provider, quarantine_fields(raw, layout)) for layout, raw in exports if counts[layout.provider]["malformed_rows"]]
        store.write_load_record(store.literal_rows(spark, store.LOAD_COUNTS_SCHEMA, rows), _by_provider(rejected), base, source, load,
                                replace_all, _by_provider(fields))
        if input_files:
            files = store.literal_rows(spark, store.INPUT_FILES_SCHEMA, [(*f, source, load) for f in input_files])
            store.write_input_files(files.drop("source", "load"), base, source, load)

    own = store.read_landed_load(spark, base, source, load).select(*CANONICAL_COLUMNS)
    # an appended load's rollup and dimensions come from one aggregate over its rows
    sums = stored(line_sums(own), "line-sums") if landed and not replace_all and not earlier else None
    months = sorted({m for _, m in landed} | {m for _, m in earlier})

    def dimensions() -> None:
        if landed or replace_all:
            store.write_dimensions(own if sums is None else sums, base, load, source, replace_all)

    def fact() -> None:
        first = sums is not None and not any(store.has_table(spark, base, t) for t in (store.FACT_TABLE, store.ROLLUP_TABLE))
        by_month = {m: store.read_landed_load(spark, base, source, load, [m]).select(*CANONICAL_COLUMNS) for m in sorted({m for _, m in landed})}
        if landed:
            store.write_copies(by_month, base, source, load)
        if replace_all:
            store.write_fact_months(_fact(own, by_month, store.read_copies(spark, base, months)), base, replace_all=True)
        elif earlier:
            _rebuild(spark, base, months)
        elif landed:
            _append(spark, base, own, by_month, source, load, sums)
        if (landed or replace_all) and store.read_rollup(spark, base) is None:
            if first:
                store.append_rollup(sums, base)
            else:
                store.write_rollup_months(spark, base)

    together(record, dimensions, fact)
    store.write_manifest(spark, base, source, load, landed, "done")
    return months


def _fact(rows: DataFrame, by_month: dict[str, DataFrame], copies: DataFrame, own: DataFrame | None = None) -> DataFrame | dict[str, DataFrame]:
    """The fact of landed rows, which lie by day and provider, so that each month's stays where it is: by month. Only where many rows are
    repeated it is one frame, dealt out anew. ``copies`` and ``own``: see ``repeated_fingerprints``."""
    repeated = repeated_fingerprints(rows, copies, own, sorted(by_month))
    if by_month and repeated.count() <= FEW_REPEATED:
        return {m: build_fact(r, clustered=True, few=None, repeated=repeated.where(F.col("bill_month") == m)) for m, r in by_month.items()}
    return build_fact(rows, repeated=repeated)


def _rebuild(spark: SparkSession, base: str, months: list[str]) -> None:
    """The fact of these months from all rows landed for them."""
    left = sorted({m for m in months if store.landed_folders(spark, base, months=[m])})
    if left:
        by_month = {m: store.read_landing(spark, base, [m]) for m in left}
        fact = _fact(store.read_landing(spark, base, left), by_month, store.read_copies(spark, base, left))
        store.write_fact_months(fact, base, months=left)
    store.drop_months(spark, base, [m for m in months if m not in left])


def _append(spark: SparkSession, base: str, rows: DataFrame, by_month: dict[str, DataFrame], source: str, load: int, sums: DataFrame) -> None:
    """Add the rows of a load to the fact, and their ``line_sums`` to the rollup; nothing that is stored is written again."""
    agreed = store.read_rollup(spark, base) is not None
    mine = (F.col("source") == source) & (F.col("load") == load)
    copies = store.read_copies(spark, base, list(by_month))
    # of the first load of its months nothing has been numbered before
    fact = (_fact(rows, by_month, copies.where(~mine), copies.where(mine))
            if store.others_landed(spark, base, list(by_month), source, load) else _fact(rows, by_month, copies))
    store.write_fact_months(fact, base, append=True)
    if agreed:
        store.append_rollup(sums, base)


def full_load(spark: SparkSession, exports: list[tuple[SourceLayout, DataFrame]], base: str) -> list[str]:
    """Replace the mart at ``base`` with exactly these export rows."""
    return load_exports_into(spark, exports, base, source="batch", load=store.INITIAL_LOAD, replace_all=True)


# --- loads of files --------------------------------------------------------------------------
def _contents(rows: DataFrame) -> dict[str, tuple]:
    """What tells the files' kept rows apart, in whatever order: their number and the sums of their fingerprints."""
    sums = [F.sum(F.col(c).cast("decimal(38,0)")) for c in ("fp_hi", "fp_lo")]
    marked = rows.select("input_file", *fingerprints())
    return {r[0]: tuple(r)[1:] for r in marked.groupBy("input_file").agg(F.count(F.lit(1)), *sums).collect()}


def load_paths_into(spark: SparkSession, layout: SourceLayout, paths: list[tuple], base: str, source: str, load: int) -> list[str]:
    """Load export files, given as (path, size, time), by each one's own header.

    Columns may be in any order and more than the layout's; optional ones may be missing. A file that lacks a required column, or
    has one twice, is refused whole: it goes to the quarantine (reason ``missing_columns``, its path and header as the line) and is
    recorded, and the others are loaded. A file without a line has nothing to load.
    """
    headers = {p: h for p, h in read_headers(spark, [p for p, _, _ in paths]).items() if h}
    wrong = {p: missing_columns(h, layout) for p, h in headers.items()}
    refused = [(p, size, time) for p, size, time in paths if wrong.get(p)]
    texts = [(layout.provider, f"{p}: {','.join(headers[p])}") for p, _, _ in refused]
    good = {p: h for p, h in headers.items() if not wrong[p]}
    if good:
        raw = read_files_by_header(spark, layout, good)
        return load_files_into(spark, layout, raw, base, source, load, refused, texts)
    empty = store.literal_rows(spark, layout.raw_schema, [])
    return load_exports_into(spark, [(layout, empty)], base, source, load, input_files=[(*f, "refused") for f in refused], refused=texts)


def load_files_into(spark: SparkSession, layout: SourceLayout, raw: DataFrame, base: str, source: str, load: int,
                    refused: list[tuple] = (), texts: list[tuple[str, str]] = ()) -> list[str]:
    """Load the rows of export files (``raw`` as ``with_input_file`` gives it) that no load has taken before.

    A file is known by its path; and, since one may be delivered again elsewhere, by its name, size and content: where name and
    size are those of a file that was taken, both files' kept rows are compared. A known file's rows are left out and it is
    recorded so. Files are listed on the driver, as the file stream does anyway; their rows are not. ``refused`` files and their
    ``texts``: see ``load_paths_into``.
    """
    compaction.finish(spark, base)
    files = sorted((tuple(r) for r in raw.select(*INPUT_COLUMNS).distinct().collect()), key=lambda f: f[0])
    running = {(source, load), *store.unfinished_loads(spark, base)}
    name = lambda path: path.rsplit("/", 1)[-1]
    taken = [r for r in store.read_input_files(spark, base).where("outcome = 'loaded'").where(
        F.element_at(F.split("input_file", "/"), -1).isin([name(f[0]) for f in files])).collect()
        if (r["source"], r["load"]) not in running]
    known = {r["input_file"] for r in taken}
    outcome = {f[0]: "known" if f[0] in known else "loaded" for f in files}

    alike: dict[tuple, list[str]] = {}
    for path, size, _ in files:
        if outcome[path] == "loaded":
            alike.setdefault((name(path), size), []).append(path)
    before = [r for r in taken if (name(r["input_file"]), r["input_size"]) in alike]
    asked = [p for key, own in alike.items() for p in own if len(own) > 1 or any((name(r["input_file"]), r["input_size"]) == key for r in before)]
    if asked:
        found = _contents(normalize_with_files(raw.where(F.col("input_file").isin(asked)), layout))
        there = set()
        for s, n in sorted({(r["source"], r["load"]) for r in before}):
            rows = store.read_landed_load(spark, base, s, n)
            there |= {(name(p), c) for p, c in _contents(rows.where(F.col("input_file").isin([r["input_file"] for r in before]))).items()}
        for path in asked:
            content = found.get(path)
            if content and (name(path), content) in there:
                outcome[path] = "copy"
            there.add((name(path), content))
    passed_over = [p for p, o in outcome.items() if o != "loaded"]
    if files and not refused and len(passed_over) == len(files) and running == {(source, load)} and not store.months_of_load(spark, base, source, load):
        # nothing new and nothing to take back: the files are recorded, and no table is written
        record = store.literal_rows(spark, store.INPUT_FILES_SCHEMA, [(*f, outcome[f[0]], source, load) for f in files])
        store.write_input_files(record.drop("source", "load"), base, source, load)
        return []
    rows = raw.where(~F.col("input_file").isin(passed_over)) if passed_over else raw
    return load_exports_into(spark, [(layout, rows)], base, source, load,
                             input_files=[*[(*f, outcome[f[0]]) for f in files], *[(*f, "refused") for f in refused]], refused=list(texts))
