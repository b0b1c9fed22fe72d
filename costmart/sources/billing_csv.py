"""CSV readers for provider exports (and a CSV writer for handing exports over).

Reads use an explicit schema, never inference. ``enforceSchema=false`` makes Spark compare every
file's header with the schema by position and refuse a file whose columns are in another order,
instead of silently loading values into the wrong columns. ``read_files_by_header`` goes by each file's own header.
"""

from __future__ import annotations

import csv
import re
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from costmart.sources.layouts import SourceLayout

CORRUPT_COLUMN = "_corrupt_record"


def _reader(spark: SparkSession, schema: StructType, corrupt_column: str | None):
    r = (spark.read.schema(schema)
         .option("header", "true")
         .option("nullValue", "")
         .option("mode", "PERMISSIVE")
         .option("enforceSchema", "false"))
    if corrupt_column:
        r = r.option("columnNameOfCorruptRecord", corrupt_column)
    return r


#: What ``with_input_file`` adds.
INPUT_COLUMNS = ("input_file", "input_size", "input_time")


def with_input_file(raw: DataFrame) -> DataFrame:
    """The columns of ``raw``, read from files, with each row's file: path, size and modification time."""
    return raw.select("*", F.col("_metadata.file_path").alias("input_file"), F.col("_metadata.file_size").alias("input_size"),
                      F.col("_metadata.file_modification_time").alias("input_time"))


def read_export(spark: SparkSession, path: str, layout: SourceLayout,
                keep_corrupt: bool = False) -> DataFrame:
    """Raw export rows in ``layout.raw_schema``.

    With ``keep_corrupt`` the result carries ``_corrupt_record``: the whole line for a row in
    which some field could not be parsed (that field itself is NULL), else NULL.
    """
    schema = layout.raw_schema
    if keep_corrupt:
        schema = StructType(schema.fields + [StructField(CORRUPT_COLUMN, StringType(), True)])
    return _reader(spark, schema, CORRUPT_COLUMN if keep_corrupt else None).csv(path)


def write_export(df: DataFrame, path: str, mode: str = "overwrite", compression: str | None = None) -> None:
    """Write raw export rows as CSV with a header (empty field = NULL), one file per partition; ``compression``: of the files, such as gzip."""
    df.write.mode(mode).option("header", "true").option("nullValue", "").csv(path, compression=compression)


# --- files with their own column order ---------------------------------------------------------
#: What ``read_files_by_header`` adds: the fields of a malformed line that did not parse, by name, with their text.
MALFORMED_FIELDS = "_malformed_fields"
HEADER_LIMIT = 1 << 16


def malformed_fields(schema: StructType, line: str = CORRUPT_COLUMN) -> Column:
    """``array<struct<field, text>>`` of the fields in a line of ``schema``'s columns that have a text but not of their type.

    The line is read again as text and each typed field is cast by itself, so one line may name several. Empty where the
    line is malformed as a whole (too few or too many fields), NULL where there is none.
    """
    columns = [f for f in schema.fields if f.name != CORRUPT_COLUMN]
    text = F.from_csv(F.col(line), ", ".join(f"`{f.name}` STRING" for f in columns), {"nullValue": "", "mode": "PERMISSIVE"})
    bad = [F.when(text[f.name].isNotNull() & text[f.name].try_cast(f.dataType).isNull(),
                  F.struct(F.lit(f.name).alias("field"), text[f.name].alias("text")))
           for f in columns if not isinstance(f.dataType, StringType)]
    if not bad:
        bad = [F.lit(None).cast("struct<field: string, text: string>")]
    return F.when(F.col(line).isNotNull(), F.filter(F.array(*bad), lambda x: x.isNotNull()))


def read_headers(spark: SparkSession, paths: list[str], threads: int = 16) -> dict[str, tuple[str, ...] | None]:
    """The column names in each file's first line (None for an empty file), compressed files included.

    The files are opened on the driver, side by side, as the file stream lists them there; of each at most ``HEADER_LIMIT``
    characters are read.
    """
    jvm, conf = spark._jvm, spark._jsparkSession.sessionState().newHadoopConf()
    codecs = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf)

    def names(path: str) -> tuple[str, ...] | None:
        at = jvm.org.apache.hadoop.fs.Path(path)
        stream = at.getFileSystem(conf).open(at)
        try:
            codec = codecs.getCodec(at)
            reader = jvm.java.io.InputStreamReader(codec.createInputStream(stream) if codec else stream, "UTF-8")
            buffer = jvm.java.nio.CharBuffer.allocate(HEADER_LIMIT)
            text = ""
            while buffer.hasRemaining() and "\n" not in text and reader.read(buffer) >= 0:
                text = buffer.duplicate().flip().toString()
        finally:
            stream.close()
        line = text.lstrip("\ufeff").split("\n", 1)[0].rstrip("\r")
        return tuple(n.strip() for n in next(csv.reader([line]))) if line else None

    with ThreadPoolExecutor(max_workers=threads) as pool:
        return dict(zip(paths, pool.map(names, paths)))


def missing_columns(header: tuple[str, ...], layout: SourceLayout) -> list[str]:
    """Why a file with this header can't be loaded: required columns that it lacks, and layout columns that it has twice."""
    return [c for c in layout.raw_schema.fieldNames() if header.count(c) > 1 or (c in layout.required and c not in header)]


def _literal_path(path: str) -> str:
    """A path that is read as it stands, without wildcards."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", path)


def read_files_by_header(spark: SparkSession, layout: SourceLayout, headers: dict[str, tuple[str, ...]]) -> DataFrame:
    """Raw rows of files whose columns may be in any order, with columns beyond the layout's ignored and optional ones that are
    lacking NULL; with ``_corrupt_record``, ``_malformed_fields`` and each row's file. Files with one header are read together, so
    there are as many scans as there are different headers."""
    types = {f.name: f.dataType for f in layout.raw_schema.fields}
    groups: dict[tuple[str, ...], list[str]] = {}
    for path, header in sorted(headers.items()):
        groups.setdefault(header, []).append(path)
    frames = []
    for header, paths in groups.items():
        own = [StructField(n if n in types else f"_other_{i}", types.get(n, StringType()), True) for i, n in enumerate(header)]
        schema = StructType([*own, StructField(CORRUPT_COLUMN, StringType(), True)])
        # the schema is the header's, so there is nothing left to compare by position
        rows = with_input_file(_reader(spark, schema, CORRUPT_COLUMN).option("enforceSchema", "true").csv([_literal_path(p) for p in paths]))
        columns = [F.col(n) if n in header else F.lit(None).cast(t).alias(n) for n, t in types.items()]
        frames.append(rows.select(*columns, CORRUPT_COLUMN, malformed_fields(schema).alias(MALFORMED_FIELDS), *INPUT_COLUMNS))
    return reduce(DataFrame.unionByName, frames)
