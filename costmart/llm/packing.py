"""Best-fit packing of documents into sequences under conflicts.

A document longer than a bin is cut into full bins and a rest. Pieces are placed in order of
decreasing length into the bin with the least residual capacity that still holds them and doesn't
conflict: no bin takes two pieces of one source, nor two of one cluster of duplicates. Each bin
carries one bitmap, with a bit for each source and for each cluster it holds.

Bins are ordered by residual. Over the residuals stands a tree whose nodes keep the AND of the
bitmaps below: where a bit of the piece is set in a node, every bin below conflicts and the search
skips them all. So the successor search goes on from residual to residual until the tightest
compatible bin is found, in logarithmic steps even where most bins hold a frequent source.

Pieces are dealt at random to shards of about ``shard_rows`` rows and each shard is packed by itself,
so the work and the memory of a task are bounded and a frequent source or cluster is spread evenly.

Defined cases: a null text has length 1 (its end mark). A null source conflicts with nothing; a null
cluster neither. Repeated rows are packed one by one. The result has a row per piece.
"""

from __future__ import annotations

from collections import defaultdict

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from costmart.llm.common import stored, table

CAPACITY = 2048
SHARD_ROWS = 8192
WORDS = r"[^\x20\x09-\x0D]+"


class Bins:
    """Open bins, ordered by residual capacity."""

    EMPTY = -1  # all bits set: bit 0, which every piece asks for and no bin has, conflicts, too

    def __init__(self, capacity: int):
        self.base = 1 << capacity.bit_length()
        self.tree = [self.EMPTY] * (2 * self.base)
        self.at: list[dict[int, list[int]]] = [{} for _ in range(capacity + 1)]

    def _refresh(self, residual: int) -> None:
        both = self.EMPTY
        for bitmap in self.at[residual]:
            both &= bitmap
        i = self.base + residual
        tree = self.tree
        while i and tree[i] != both:
            tree[i] = both
            i >>= 1
            both = tree[2 * i] & tree[2 * i + 1] if i else 0

    def add(self, bin_no: int, residual: int, bitmap: int) -> None:
        self.at[residual].setdefault(bitmap, []).append(bin_no)
        self._refresh(residual)

    def successor(self, residual: int, want: int) -> int | None:
        """The least residual, from the given one on, whose bins may be compatible."""
        tree, i = self.tree, self.base + residual
        while i:
            if tree[i] & want:  # all bins below conflict: go on to the next subtree to the right
                while i & 1:
                    i >>= 1
                i = i and i + 1
            elif i >= self.base:
                return i - self.base
            else:
                i *= 2
        return None

    def take(self, length: int, want: int) -> tuple[int, int, int] | None:
        """Removes and returns (bin, residual, bitmap) of the tightest compatible bin."""
        r = self.successor(length, want | 1)
        while r is not None:
            for bitmap, bins in self.at[r].items():
                if not bitmap & want:
                    bin_no = bins.pop(0)
                    if not bins:
                        del self.at[r][bitmap]
                        self._refresh(r)
                    return bin_no, r, bitmap
            r = self.successor(r + 1, want | 1)
        return None


def pack_pieces(lengths, sources, clusters, capacity: int) -> tuple[list[int], list[int]]:
    """(bin, offset in the bin) of each piece; lengths are from 1 to ``capacity`` and not increasing."""
    bit: dict = {}
    often = defaultdict(int)
    for c in clusters:
        often[c] += 1
    bins, n_bins, out_bin, out_at = Bins(capacity), 0, [], []
    for n, s, c in zip(lengths, sources, clusters):
        want = 0
        if s is not None:
            want |= bit.setdefault(("source", s), 2 << len(bit))
        if c is not None and often[c] > 1:
            want |= bit.setdefault(("cluster", c), 2 << len(bit))
        found = bins.take(n, want)
        if found is None:
            bin_no, residual, bitmap = n_bins, capacity, 0
            n_bins += 1
        else:
            bin_no, residual, bitmap = found
        out_bin.append(bin_no)
        out_at.append(capacity - residual)
        if residual > n:  # a full bin takes nothing more
            bins.add(bin_no, residual - n, bitmap | want)
    return out_bin, out_at


def word_length(text_col: str = "text") -> Column:
    """Words, and one for the end mark."""
    return F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORDS)), F.lit(0)) + 1


def copies_cluster(text_col: str = "text") -> Column:
    """One cluster per distinct text; null for no text."""
    return F.when(F.col(text_col).isNotNull(), F.xxhash64(F.col(text_col)))


def pack(docs: DataFrame, id_col: str = "doc_id", length: Column | None = None, source: Column | None = None,
         cluster: Column | None = None, capacity: int = CAPACITY, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """(id, piece, piece_start, piece_length, shard, bin, bin_offset): a row per piece; a bin is (shard, bin)."""
    length = word_length() if length is None else length
    source = F.col("source") if source is None else source
    cluster = copies_cluster() if cluster is None else cluster
    rows = docs.select(F.col(id_col).alias("id"), length.cast("long").alias("n"), source.cast("string").alias("source"),
                       cluster.cast("long").alias("cluster"), F.monotonically_increasing_id().alias("row"))
    # written once: the row numbers, which deal the pieces to shards, must not change in a retry
    rows = stored(rows, "packing-rows")
    pieces = rows.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"greatest(n - 1, 0) div {capacity}"))).alias("piece"))
    pieces = pieces.withColumn("start", F.col("piece") * capacity).withColumn(
        "length", F.greatest(F.least(F.col("n") - F.col("start"), F.lit(capacity)), F.lit(1)).cast("int"))
    total = rows.agg(F.sum(F.expr(f"greatest(n - 1, 0) div {capacity} + 1")).alias("t")).first()["t"] or 0
    shards = -(-total // shard_rows) or 1
    dealt = pieces.withColumn("shard", F.pmod(F.xxhash64("row", "piece"), F.lit(shards)).cast("int"))
    kind = dict(rows.dtypes)["id"]

    def pack_shard(shard: pa.Table) -> pa.Table:
        shard = shard.take(pc.sort_indices(shard, [("length", "descending"), ("row", "ascending"), ("piece", "ascending")]))
        bins, at = pack_pieces(*(shard[c].to_pylist() for c in ("length", "source", "cluster")), capacity)
        names = {"id": "id", "piece": "piece", "start": "piece_start", "length": "piece_length", "shard": "shard"}
        out = shard.select(list(names)).rename_columns(list(names.values()))
        return out.append_column("bin", pa.array(bins, pa.int32())).append_column("bin_offset", pa.array(at, pa.int32()))

    return (dealt.select("id", "piece", "start", "length", "source", "cluster", "row", "shard").groupBy("shard")
            .applyInArrow(pack_shard, f"id {kind}, piece long, piece_start long, piece_length int, shard int, bin int, bin_offset int"))


def pack_documents(docs: DataFrame) -> DataFrame:
    """Documents by words, one per source and one copy of a text in a bin."""
    return pack(docs).withColumnRenamed("id", "doc_id")


def query(spark, sf_dir) -> DataFrame:
    """op3: all documents."""
    return pack_documents(table(spark, sf_dir, "documents"))
