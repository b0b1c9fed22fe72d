"""Hard-negative mining with exact integer scores, by matrix products in a residue number system.

Vectors become whole numbers (``floor(scale * x)``). Scores of a block of anchors against a chunk of rows are
one matrix product; it is done modulo several small primes in float32, where every sum stays below 2**24
and so is exact whatever order BLAS adds in, and the signed score is put together from its residues by Chinese
remaindering. How many primes that takes follows from the largest squared norm in the table, which bounds
every score (Cauchy-Schwarz).

The rows stay where they are; the anchors, a stated query set, are stored in the shared folder and
every task streams them past its rows in blocks, so a task holds a chunk of rows, a block of anchors and
their scores, at any size of the table. Two passes: the first multiplies rows with anchors of their own label
only and keeps each chunk's best for each anchor; from the best of all chunks follow the windows of scores in which the
second pass keeps each chunk's best rows of other labels. A window function selects among the chunks'.

Defined cases: rows with a null label, a null vector or a null or non-finite component take no part. Vectors may have
different lengths: missing components count as zero. A null id is no anchor and comes last among ties. Each
copy of a repeated row is a candidate of its own; equal anchor rows are one anchor. An anchor's positives have
another id than it has. A score beyond 2**60 is an error, not a wrong number.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import isqrt

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from costmart.llm.common import ship, stored, table
from costmart.session import scratch_path

#: Rows in a chunk, anchors in a block, and components multiplied before a sum is reduced.
CHUNK_ROWS, BLOCK_ANCHORS, SLICE = 32_768, 128, 256
#: Scores below this can be compared as ``low * score`` in 64 bits.
LARGEST_SCORE = 1 << 60
NO_ID = np.iinfo(np.int64).max
_NONE = np.iinfo(np.int64).min


# --- exact products --------------------------------------------------------------------------
class ResidueProduct:
    """Exact products of the rows of two matrices of whole numbers, none larger than ``bound``."""

    def __init__(self, width: int, bound: int):
        if bound >= LARGEST_SCORE:
            raise ArithmeticError(f"scores up to {bound} do not fit")
        self.slice = max(1, min(width, SLICE))
        self.primes: list[int] = []
        # centred residues are at most (p - 1) / 2, and ``slice`` products of two must add up below 2**24
        p, product = 2 * isqrt((1 << 24) // self.slice) + 1, 1
        while product <= 2 * bound + 1:
            if p < 2:
                raise ArithmeticError("too few primes")
            if all(p % q for q in range(2, isqrt(p) + 1)):
                self.primes.append(p)
                product *= p
            p -= 1

    def residues(self, matrix: np.ndarray) -> list[np.ndarray]:
        out = []
        for p in self.primes:
            r = np.mod(matrix, p)
            out.append((r - p * (r > p // 2)).astype(np.float32))
        return out

    def scores(self, a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
        """a's rows by b's rows; both as ``residues`` gives them."""
        shape = (len(a[0]), len(b[0])) if self.primes else (0, 0)
        value, modulus = np.zeros(shape, dtype=np.int64), 1
        for p, x, y in zip(self.primes, a, b):
            total = np.zeros(shape, dtype=np.int32)
            for start in range(0, x.shape[1], self.slice):
                part = x[:, start:start + self.slice] @ y[:, start:start + self.slice].T
                total += part.astype(np.int32) % p
            # the next mixed-radix digit, centred, so that the sum is the signed number itself
            digit = (total - value % p) * pow(modulus, -1, p) % p
            value += modulus * (digit - p * (digit > p // 2))
            modulus *= p
        return value


def best(scores: np.ndarray, n: int) -> np.ndarray:
    """Positions of the n highest scores, equal ones in order of position."""
    at = np.arange(len(scores))
    if len(scores) > n:
        at = np.flatnonzero(scores >= np.partition(scores, len(scores) - n)[len(scores) - n])
    return at[np.argsort(-scores[at], kind="stable")][:n]


# --- chunks and blocks -----------------------------------------------------------------------
def _matrix(column: pa.ListArray, width: int) -> np.ndarray:
    lengths = pc.list_value_length(column).to_numpy(zero_copy_only=False).astype(np.int64)
    values = column.flatten().to_numpy(zero_copy_only=False)
    if len(lengths) and (lengths == width).all():
        return values.reshape(len(lengths), width)
    out = np.zeros((len(lengths), width))
    out[np.repeat(np.arange(len(lengths)), lengths), np.arange(len(values)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = values
    return out


def _chunks(batches: Iterator[pa.RecordBatch], rows: int = CHUNK_ROWS) -> Iterator[pa.RecordBatch]:
    held, n = [], 0
    for b in batches:
        for start in range(0, b.num_rows, rows):
            held.append(b.slice(start, rows))
            n += held[-1].num_rows
            if n >= rows:
                yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                held, n = [], 0
    if n:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def _blocks(folder: str) -> Iterator[pa.RecordBatch]:
    """The stored anchors, a block at a time."""
    import pyarrow.dataset as ds
    from pyarrow import fs

    store, root = fs.FileSystem.from_uri(folder)
    anchors = ds.dataset(root, filesystem=store, format="parquet")
    for b in anchors.to_batches(batch_size=BLOCK_ANCHORS, batch_readahead=1, fragment_readahead=1):
        if b.num_rows:
            yield b


def _ids(column: pa.Array) -> np.ndarray:
    return pc.fill_null(column, int(NO_ID)).to_numpy(zero_copy_only=False)


def _own_label(batches: Iterator[pa.RecordBatch], folder: str, width: int, bound: int, n: int):
    """(anchor, id, score): each chunk's n best rows of each anchor's label, by the anchors' numbers."""
    product = ResidueProduct(width, bound)
    for chunk in _chunks(batches):
        ids, labels, vectors = _ids(chunk.column(0)), chunk.column(1).to_numpy(), _matrix(chunk.column(2), width)
        order = np.lexsort((ids, labels))
        ids, labels, vectors = ids[order], labels[order], vectors[order]
        for block in _blocks(folder):
            number, own, kind = block["anchor"].to_numpy(), block["id"].to_numpy(), block["label"].to_numpy()
            matrix, out = _matrix(block["vector"], width), []
            for label in np.unique(kind):
                lo, hi = np.searchsorted(labels, [label, label + 1])
                if lo == hi:
                    continue
                mine = np.flatnonzero(kind == label)
                scores = product.scores(product.residues(matrix[mine]), product.residues(vectors[lo:hi]))
                for i, row in zip(mine.tolist(), scores):
                    row[ids[lo:hi] == own[i]] = _NONE
                    at = best(row, n)
                    at = at[row[at] != _NONE]
                    out.append((np.full(len(at), number[i]), ids[lo + at], row[at]))
            if out:
                yield tuple(np.concatenate(c) for c in zip(*out))


def _other_labels(batches: Iterator[pa.RecordBatch], folder: str, width: int, bound: int, n: int, low: int, high: int):
    """(anchor, place, id, score): each chunk's n best rows of other labels in the window of each positive."""
    product = ResidueProduct(width, bound)
    for chunk in _chunks(batches):
        ids, labels, vectors = _ids(chunk.column(0)), chunk.column(1).to_numpy(), _matrix(chunk.column(2), width)
        order = np.argsort(ids, kind="stable")
        ids, labels = ids[order], labels[order]
        rows = product.residues(vectors[order])
        for block in _blocks(folder):
            number, kind, out = block["anchor"].to_numpy(), block["label"].to_numpy(), []
            scores = product.scores(product.residues(_matrix(block["vector"], width)), rows)
            for i, (row, positives) in enumerate(zip(scores, block["positives"].to_pylist())):
                positives = [p["score"] for p in positives]
                near = np.flatnonzero((labels != kind[i]) & (high * row >= low * min(positives)) & (row <= max(positives)))
                for place, p in enumerate(positives):
                    inside = near[(high * row[near] >= low * p) & (row[near] <= p)]
                    at = inside[best(row[inside], n)]
                    out.append((np.full(len(at), number[i]), np.full(len(at), place), ids[at], row[at]))
            yield tuple(np.concatenate(c) for c in zip(*out))


# --- Spark -----------------------------------------------------------------------------------
def whole_numbers(vec: Column, scale: int) -> Column:
    return F.transform(vec, lambda x: F.floor(x.cast("double") * scale).cast("double"))


def mine(vectors: DataFrame, is_anchor: Column, id_col: str = "vec_id", label_col: str = "label", vec_col: str = "embedding",
         scale: int = 256, positives: int = 5, negatives: int = 5, low: int = 4, high: int = 5) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``is_anchor`` is a condition on the columns of ``vectors``. For each anchor and each of its ``positives`` best
    other rows of its label: the ``negatives`` best rows of other labels with a score from ``low / high`` of the
    positive's up to it. Ties go to the smaller id.
    """
    spark = vectors.sparkSession
    ship(spark)
    vec = F.col(vec_col)
    sound = F.col(label_col).isNotNull() & vec.isNotNull() & ~F.exists(
        vec, lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double") * scale) == float("inf")))
    rows = vectors.where(F.coalesce(sound, F.lit(False))).select(
        F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"),
        whole_numbers(vec, scale).alias("vector"), is_anchor.alias("is_anchor"))
    norm = F.aggregate("vector", F.lit(0.0), lambda a, x: a + x * x)
    widest, norm = rows.agg(F.max(F.size("vector")), F.max(norm)).first()
    width, bound = widest or 0, int((norm or 0.0) * (1 + 1e-9)) + 1

    anchors = rows.where(F.col("is_anchor") & F.col("id").isNotNull()).select("id", "label", "vector").distinct()
    first = scratch_path(spark, "hardneg-anchors")
    anchors.select(F.monotonically_increasing_id().alias("anchor"), "*").write.parquet(first)
    anchors = spark.read.parquet(first)
    data = rows.select("id", "label", "vector")

    def batch(columns: tuple, names: list[str]) -> pa.RecordBatch:
        arrays = [pa.array(c, mask=c == NO_ID) if n == "id" else pa.array(c) for c, n in zip(columns, names)]
        return pa.record_batch(arrays, names=names)

    def best_of_label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for found in _own_label(batches, first, width, bound, positives):
            yield batch(found, ["anchor", "id", "score"])

    order = [F.col("score").desc(), F.col("id").asc_nulls_last()]
    found = data.mapInArrow(best_of_label, "anchor long, id long, score long")
    found = found.withColumn("place", F.row_number().over(W.partitionBy("anchor").orderBy(*order))).where(F.col("place") <= positives)
    lists = found.groupBy("anchor").agg(F.sort_array(F.collect_list(F.struct("place", "id", "score"))).alias("positives"))
    second = scratch_path(spark, "hardneg-positives")
    anchors.join(lists, "anchor").write.parquet(second)

    def best_of_others(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for found in _other_labels(batches, second, width, bound, negatives, low, high):
            yield batch(found, ["anchor", "place", "id", "score"])

    found = data.mapInArrow(best_of_others, "anchor long, place long, id long, score long")
    found = found.withColumn("rank", F.row_number().over(W.partitionBy("anchor", "place").orderBy(*order))).where(F.col("rank") <= negatives)
    found = stored(found, "hardneg-found")
    pairs = spark.read.parquet(second).select(
        "anchor", F.col("id").alias("anchor_id"), F.posexplode("positives").alias("at", "positive")).select(
        "anchor", "anchor_id", F.col("at").cast("long").alias("place"), F.col("positive.id").alias("positive_id"),
        F.col("positive.score").alias("positive_score"))
    return pairs.join(found, ["anchor", "place"]).select(
        "anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))


def query(spark, sf_dir) -> DataFrame:
    """op11: all vectors; the label rule and the anchors of the contract."""
    rows = table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(rows.select("vec_id", label.alias("label"), "embedding"), F.col("vec_id") % 100 == 0)


ORACLE = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS a, a.label AS al, r.vec_id AS r, r.label AS rl, CAST(list_dot_product(a.e, r.e) AS BIGINT) AS s
  FROM v a JOIN v r ON a.vec_id % 100 = 0 AND a.vec_id <> r.vec_id),
p AS (SELECT a, al, r AS p, s AS ps FROM s WHERE rl = al QUALIFY row_number() OVER (PARTITION BY a ORDER BY s DESC, r) <= 5)
SELECT p.a AS anchor_id, p.p AS positive_id,
  CAST(row_number() OVER (PARTITION BY p.a, p.p ORDER BY s.s DESC, s.r) AS INTEGER) AS rank,
  s.r AS negative_id, p.ps AS positive_score, s.s AS negative_score
FROM p JOIN s ON s.a = p.a AND s.rl <> p.al AND 80 * p.ps <= 100 * s.s AND s.s <= p.ps
QUALIFY rank <= 5
"""
