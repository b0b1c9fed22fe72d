"""Small helpers shared by the operators of this package."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from costmart.session import scratch_path

#: Maps every ASCII capital to its small letter and leaves all other bytes alone. UTF-8 uses only
#: bytes from 0x80 on for other characters, so it can be applied to encoded text.
LOWER_ASCII = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def ship(spark: SparkSession) -> None:
    """Give the executors this package, once per Spark context: functions that run in tasks are looked up by
    module there, and a cluster's machines (or a session started from another folder) need not have it."""
    import costmart

    context, package = spark.sparkContext, os.path.dirname(os.path.abspath(costmart.__file__))
    if getattr(context, "_costmart_shipped", False) or not os.path.isdir(package):  # or itself from an archive
        return
    archive = os.path.join(tempfile.mkdtemp(prefix="costmart-"), "costmart.zip")  # Spark serves it from the driver
    with zipfile.ZipFile(archive, "w") as z:
        for folder, _, names in os.walk(package):
            for name in sorted(names):
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    z.write(path, os.path.join("costmart", os.path.relpath(path, package)))
    context.addPyFile(archive)
    context._costmart_shipped = True


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the corpus, for a query: what its tasks need is shipped first."""
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back: cuts the lineage, survives lost
    executors, and gives later joins a plain scan whose hot keys adaptive execution can split."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def labelled_sample(docs: DataFrame, rated: DataFrame, id_col: str, text_col: str, max_rows: int) -> DataFrame:
    """(id, th, ``rated``'s other columns, text): at most ``max_rows`` rows, those of least id hash and then
    of least text hash, one for each id and text; ``rated`` has a row per id. Only the texts chosen are shuffled."""
    ids = docs.select(F.col(id_col).alias("id")).distinct().join(rated, "id")
    chosen = F.broadcast(ids.orderBy(F.xxhash64("id"), "id").limit(max_rows))
    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("th"), F.col(text_col).alias("text"))
    # an id may repeat without bound, so its texts are chosen among too
    keys = rows.select("id", "th").join(chosen, "id").distinct().orderBy(F.xxhash64("id"), "id", "th").limit(max_rows)
    return (rows.join(F.broadcast(keys), ["id", "th"]).groupBy("id", "th", *[c for c in rated.columns if c != "id"])
            .agg(F.first("text").alias("text")))


def utf8(text_col: str | Column) -> Column:
    """The text's UTF-8 bytes; a null text counts as empty."""
    col = F.col(text_col) if isinstance(text_col, str) else text_col
    return F.coalesce(col.cast("string").cast("binary"), F.lit(b""))


def free_name(df: DataFrame, base: str) -> str:
    """A column name that ``df`` doesn't have yet (names compare without case)."""
    taken, name = {c.lower() for c in df.columns}, base
    while name.lower() in taken:
        name += "_"
    return name
