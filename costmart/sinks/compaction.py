"""Merging what loads have landed: a month's many small folders become one.

Every load lands its rows in folders of its own, so that it can be taken back. ``compact_landing`` writes the small ones of
a provider's month together as ``source=merged/load=G``, each row with the load that it is of, and ``landing_merges/generation=G``
says which loads are in there. A replay of a merged load takes its rows out by the same step: the folder is written anew
without them.

Steps, each of which may be the last one that is reached:

1. the new folders are written to ``landing_staged``, which nothing reads;
2. the record of their loads is written, which counts only for folders that are in the landing;
3. ``landing_swaps/generation=G`` names the folders to replace. From here on the swap is decided;
4. those folders are removed, the staged ones are moved to the landing (a rename), and the swap's record goes.

A run that breaks off before the third step has changed nothing; ``finish`` carries out a later one's steps again, and every load
and compaction begins with it. One writer at a time, as for loads.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from costmart.schemas import CANONICAL_COLUMNS
from costmart.session import together
from costmart.sinks import mart_store as store

STAGED = "landing_staged"
SWAPS = "landing_swaps"
SMALL_BYTES = 64 << 20
ROWS_PER_TASK = 1_000_000


def _size(spark: SparkSession, folder: str) -> int:
    fs, path = store._fs(spark, folder)
    return fs.getContentSummary(path).getLength()


def _relative(folder: str) -> str:
    """A landed folder's path below the table."""
    return "/".join(folder.rstrip("/").split("/")[-4:])


def small_ones(sizes: dict[str, int], small_bytes: int) -> list[str]:
    """The folders to merge: all of at most ``small_bytes``, and larger ones while each is no more than twice what is merged before
    it, so that a month's rows are written again a logarithmic number of times however many loads come."""
    chosen, total = [], 0
    for folder, size in sorted(sizes.items(), key=lambda x: (x[1], x[0])):
        if size > max(small_bytes, 2 * total):
            break
        chosen.append(folder)
        total += size
    return chosen if len(chosen) > 1 else []


def compact_landing(spark: SparkSession, base: str, months: list[str] | None = None, small_bytes: int = SMALL_BYTES) -> int:
    """Merge the small landed folders of each provider's month (all months, or ``months``); returns how many were merged.

    Rows, ids, counts and records stay as they are, and so do fact and rollup, which aren't read. A month with one
    folder, or none, is left alone.
    """
    finish(spark, base)
    sizes: dict[tuple[str, str], dict[str, int]] = {}
    for folder in store.landed_folders(spark, base, months=months):
        v = store._values(folder)
        sizes.setdefault((v["provider"], v["bill_month"]), {})[folder] = _size(spark, folder)
    merged = [folder for group in sizes.values() for folder in small_ones(group, small_bytes)]
    if merged:
        _replace(spark, base, merged)
    return len(merged)


def take_out(spark: SparkSession, base: str, source: str, load: int) -> None:
    """Write the merged folders that hold rows of a load anew without them."""
    folders = sorted({store.merged_folder(base, r) for r in store.merges(spark, base, (F.col("of_source") == source) & (F.col("of_load") == load))})
    if folders:
        _replace(spark, base, folders, (F.col("source") != source) | (F.col("load") != load))


def _gathered(spark: SparkSession, base: str, folders: list[str], keep: Column) -> list[DataFrame]:
    """The rows of landed folders that fit ``keep``, a frame for each provider's month, in a few tasks: these read their files one after
    the other, and no row is exchanged. A single empty frame if there are none."""
    rows = store._landing(spark, base, folders).where(keep)
    groups: dict[tuple[str, str], list[str]] = {}
    for folder in folders:
        v = store._values(folder)
        groups.setdefault((v["provider"], v["bill_month"]), []).append(folder)
    counts = rows.groupBy("provider", "bill_month").count().collect()
    return [store._landing(spark, base, groups[r["provider"], r["bill_month"]]).where(keep).coalesce(-(-r["count"] // ROWS_PER_TASK))
            for r in counts] or [rows]


def _replace(spark: SparkSession, base: str, folders: list[str], keep: Column | None = None) -> None:
    """Put the rows of landed folders (all, or those that fit ``keep``), merged, in their place."""
    used = [*store._folders(spark, f"{store._path(base, store.MERGES)}/generation=*"),
            *store.landed_folders(spark, base, store.MERGED)]
    generation = 1 + max((int(f.rstrip("/").rsplit("=", 1)[1]) for f in used), default=0)
    staged = store._path(base, STAGED)
    parts = ("bill_month", "provider", "source", "load")
    tagged = [rows.select(*CANONICAL_COLUMNS, *[f.name for f in store._FILE_COLUMNS], "bill_month", "provider",
                          F.col("source").alias("of_source"), F.col("load").alias("of_load"),
                          F.lit(store.MERGED).alias("source"), F.lit(generation).cast("long").alias("load"))
              for rows in _gathered(spark, base, folders, F.lit(True) if keep is None else keep)]
    store.drop_folder(spark, staged)
    together(*[partial(store._write, df, staged, parts, replace_all=False) for df in tagged], at_once=store.MONTHS_AT_ONCE)

    held = (spark.read.schema(store.LANDING_SCHEMA).parquet(staged).groupBy("provider", "bill_month", "of_source", "of_load")
            .agg(F.count(F.lit(1)).alias("rows")).withColumn("generation", F.lit(generation).cast("long")))
    store._write(held.coalesce(1), store._path(base, store.MERGES), ("generation",), replace_all=False)
    names = "\n".join(_relative(f) for f in folders)
    swap = spark.range(1).select(F.explode(F.split(F.lit(names), "\n")).alias("replaced"), F.lit(generation).cast("long").alias("generation"))
    store._write(swap.coalesce(1), store._path(base, SWAPS), ("generation",), replace_all=False)
    finish(spark, base)


def finish(spark: SparkSession, base: str) -> None:
    """Carry out the swaps that are decided, and remove what undecided ones have left. Without any, two calls to the file system."""
    landing, staged, swaps = (store._path(base, t) for t in (store.LANDING, STAGED, SWAPS))
    if store.has_table(spark, base, SWAPS):
        for swap in store._folders(spark, f"{swaps}/generation=*"):
            for row in spark.read.schema("replaced STRING").parquet(swap).collect():
                store.drop_folder(spark, f"{landing}/{row['replaced']}")
            generation = swap.rstrip("/").rsplit("=", 1)[1]
            for folder in store._folders(spark, f"{staged}/bill_month=*/provider=*/source={store.MERGED}/load={generation}"):
                _move(spark, folder, f"{landing}/{_relative(folder)}")
            store.drop_folder(spark, swap)
    if store.has_table(spark, base, STAGED):
        store.drop_folder(spark, staged)
        live = {store._values(f)["load"] for f in store.landed_folders(spark, base, store.MERGED)}
        for record in store._folders(spark, f"{store._path(base, store.MERGES)}/generation=*"):
            if record.rstrip("/").rsplit("=", 1)[1] not in live:
                store.drop_folder(spark, record)


def _move(spark: SparkSession, folder: str, to: str) -> None:
    fs, target = store._fs(spark, to)
    fs.mkdirs(target.getParent())
    if not fs.rename(spark._jvm.org.apache.hadoop.fs.Path(folder), target):
        raise RuntimeError(f"could not move {folder} to {to}")
