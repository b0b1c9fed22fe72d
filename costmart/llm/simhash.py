"""SimHash near-duplicates by the generalised pigeonhole principle.

A fingerprint has 64 bits; two documents are linked when theirs differ in at most ``max_bits``
bits. All distinct fingerprints are indexed. The 64 bits are grouped into parts of correlated bits,
and each part gets a threshold of its own, -1 (unused) or more, so that the sum of (threshold + 1)
is ``max_bits + 1``: then any two fingerprints within ``max_bits`` are within the threshold in at
least one part. Grouping and thresholds only decide the cost, never the result.

Hot buckets: a bucket of a part that holds more than ``hot_bucket`` distinct fingerprints is not
probed pair by pair. Its fingerprints, and those that probe it, meet at shared neighbours instead:
two fingerprints within 2r bits have a common neighbour within r bits of both, and a fingerprint
within r bits of one key is one of a fixed number, whatever the size of the bucket. The pairs met
there are verified, too, so nothing is dropped.

Defined cases: a null text counts as empty; a text of no words has fingerprint zero and is linked
like any other; one of fewer words than a shingle is one shingle. Rows with one id are one document
for the components (each row keeps its own fingerprint). Rows of a null id are linked like others;
a component of null ids only has a null component_id.
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations, islice

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from costmart.llm.common import LOWER_ASCII, free_name, ship, stored, utf8

SEED = 42
SHINGLES_AT_ONCE = 1 << 15
#: Distinct fingerprints, those of least hash, on which candidate counts are estimated.
ESTIMATE_SAMPLE = 4096
HOT_BUCKET = 512


def fingerprint(text: bytes, shingle_words: int = 3) -> int:
    """The 64-bit SimHash of UTF-8 text, as a signed integer."""
    words = text.translate(LOWER_ASCII).split()
    if not words:
        return 0
    if len(words) < shingle_words:
        shingles = iter([words])
        total = 1
    else:
        shingles = zip(*(islice(words, i, None) for i in range(shingle_words)))
        total = len(words) - shingle_words + 1
    ones = np.zeros(64, dtype=np.int64)
    digest, join = xxhash.xxh64_intdigest, b" ".join
    for _ in range(0, total, SHINGLES_AT_ONCE):
        part = np.array([digest(join(s), SEED) for s in islice(shingles, SHINGLES_AT_ONCE)], dtype="<u8")
        bits = np.unpackbits(part.view(np.uint8), bitorder="little").reshape(-1, 64)
        ones += bits.sum(axis=0, dtype=np.int32)
    packed = np.packbits((2 * ones > total).astype(np.uint8), bitorder="little")
    return int(packed.view("<i8")[0])


def fingerprint_column(text_col: str | Column, shingle_words: int = 3) -> Column:
    @F.pandas_udf(T.LongType())
    def fingerprints(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(t, shingle_words) for t in texts], dtype="int64")

    return fingerprints(utf8(text_col))


# --- the index: parts and thresholds ---------------------------------------------------------
def _bit_counts(distinct: DataFrame) -> tuple[int, np.ndarray]:
    """How many fingerprints there are, and in how many each pair of bits is set: 4,096 sums that
    are added up per task first."""
    def sums(batches):
        both, n = np.zeros((64, 64), dtype=np.float64), 0
        for b in batches:
            bits = np.unpackbits(b["fp"].to_numpy(dtype="<i8").view(np.uint8), bitorder="little")
            bits = bits.reshape(-1, 64).astype(np.float32)
            both += bits.T @ bits
            n += len(bits)
        yield pd.DataFrame({"at": np.arange(4097), "n": np.append(both.ravel(), n).astype(np.int64)})

    rows = distinct.mapInPandas(sums, "at int, n long").groupBy("at").agg(F.sum("n").alias("n")).collect()
    flat = np.zeros(4097)
    for r in rows:
        flat[r["at"]] = r["n"]
    return int(flat[4096]), flat[:4096].reshape(64, 64)


def correlated_parts(both: np.ndarray, n: int, parts: int) -> list[list[int]]:
    """Bits that go together go into one part, so that the parts are as independent as can be."""
    p = np.diag(both) / max(n, 1)
    cov = both / max(n, 1) - np.outer(p, p)
    sd = np.sqrt(np.clip(p * (1 - p), 1e-12, None))
    corr = np.abs(cov / np.outer(sd, sd))
    np.fill_diagonal(corr, 0)
    left, out = list(range(64)), []
    for i in range(parts):
        size = len(left) // (parts - i)
        sub = corr[np.ix_(left, left)]
        own = [left[int(sub.sum(axis=1).argmax())]]
        left.remove(own[0])
        while len(own) < size:
            best = max(left, key=lambda b: (corr[b, own].mean(), -b))
            own.append(best)
            left.remove(best)
        out.append(sorted(own))
    return out


def _variants(width: int, t: int) -> int:
    return sum(len(list(combinations(range(width), k))) for k in range(t + 1)) if t >= 0 else 0


def allocate(parts: list[list[int]], sample: np.ndarray, n: int, max_bits: int) -> tuple[float, list[int]]:
    """Dynamic programming over the parts: the thresholds of least estimated cost (probes made plus
    candidates to verify) whose (threshold + 1) add up to ``max_bits + 1``."""
    def cost(part: list[int], t: int) -> float:
        if t < 0:
            return 0.0
        mask = np.uint64(sum(1 << b for b in part))
        values = sample & mask
        near = 0
        for start in range(0, len(values), 512):
            near += int((np.bitwise_count(values[start:start + 512, None] ^ values[None, :]) <= t).sum())
        pairs = max(near - len(values), 0) / max(len(values) * (len(values) - 1), 1)
        pairs = max(pairs, _variants(len(part), t) / 2.0 ** len(part))
        return n * _variants(len(part), t) + pairs * n * n / 2

    units = max_bits + 1
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for part in parts:
        costs = [cost(part, t) for t in range(-1, max_bits + 1) if t < len(part)]
        step: dict[int, tuple[float, list[int]]] = {}
        for used, (so_far, chosen) in best.items():
            for more, c in enumerate(costs):
                if used + more <= units and (used + more not in step or so_far + c < step[used + more][0]):
                    step[used + more] = (so_far + c, [*chosen, more - 1])
        best = step
    return best[units]


def plan_parts(distinct: DataFrame, max_bits: int) -> list[tuple[list[int], int]]:
    """(bits, threshold) of every part that is used."""
    n, both = _bit_counts(distinct)
    rows = distinct.orderBy(F.xxhash64("fp"), "fp").limit(ESTIMATE_SAMPLE).collect()
    sample = np.array([r["fp"] for r in rows], dtype=np.int64).view(np.uint64)
    plans = []
    for m in range(2, max_bits + 3):
        parts = correlated_parts(both, n, m)
        c, thresholds = allocate(parts, sample, n, max_bits)
        plans.append((c, m, [(p, t) for p, t in zip(parts, thresholds) if t >= 0]))
    return min(plans, key=lambda x: x[:2])[2]


# --- probing ---------------------------------------------------------------------------------
def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >= 1 << 63 else mask


def _masks(bits: list[int] | range, t: int) -> list[int]:
    return [_signed(sum(1 << b for b in c)) for k in range(t + 1) for c in combinations(bits, k)]


def _rows(distinct: DataFrame, parts, query: bool) -> DataFrame:
    """(part, value, fp): the value of the part's bits, and for a query all values within the
    part's threshold."""
    entries = []
    for i, (bits, t) in enumerate(parts):
        own = F.col("fp").bitwiseAND(F.lit(_signed(sum(1 << b for b in bits))).cast("long"))
        values = [own.bitwiseXOR(F.lit(m).cast("long")) for m in (_masks(bits, t) if query else [0])]
        entries += [F.struct(F.lit(i).alias("part"), v.alias("value")) for v in values]
    return distinct.select("fp", F.explode(F.array(*entries)).alias("e")).select("e.part", "e.value", "fp")


def links(distinct: DataFrame, max_bits: int = 2, hot_bucket: int = HOT_BUCKET) -> DataFrame:
    """Pairs (a, b), a < b, of distinct fingerprints that prove, together, which are connected
    within ``max_bits``: all pairs outside hot buckets, and inside them each fingerprint with the
    least one around each neighbour they share that it is within ``max_bits`` of."""
    parts = plan_parts(distinct, max_bits)
    exact = all(t == 0 for _, t in parts)
    data = _rows(distinct, parts, query=False)
    sizes = stored(data.groupBy("part", "value").agg(F.count("*").alias("n"))
                   .where(F.col("n") >= (2 if exact else 1)), "simhash-buckets")
    usual = sizes.where(F.col("n") <= hot_bucket).select("part", "value")
    hot = sizes.where(F.col("n") > hot_bucket).select("part", "value")
    query = _rows(distinct, parts, query=True)
    right = data.join(usual, ["part", "value"], "left_semi")
    left = right if exact else query.join(usual, ["part", "value"], "left_semi")
    near = F.bit_count(F.col("l.fp").bitwiseXOR(F.col("r.fp"))) <= max_bits
    probed = (left.alias("l").join(right.alias("r"), (F.col("l.part") == F.col("r.part"))
                                   & (F.col("l.value") == F.col("r.value")) & (F.col("l.fp") < F.col("r.fp")) & near)
              .select(F.col("l.fp").alias("a"), F.col("r.fp").alias("b")))
    return probed.unionByName(_hot_links(query, hot, max_bits)).distinct()


def _hot_links(query: DataFrame, hot: DataFrame, max_bits: int) -> DataFrame:
    members = query.join(hot, ["part", "value"], "left_semi").select("fp").distinct()
    radius = (max_bits + 1) // 2
    masks = F.array(*[F.lit(m).cast("long") for m in _masks(range(64), radius)])
    around = members.select("fp", F.explode(masks).alias("m")).select("fp", F.col("fp").bitwiseXOR(F.col("m")).alias("key"))
    # at most as many fingerprints as there are masks can be around one key: the list is bounded
    met = around.groupBy("key").agg(F.sort_array(F.collect_set("fp")).alias("fps")).where(F.size("fps") > 1)
    if max_bits % 2 == 0:  # all around one key are within 2 * radius = max_bits of each other
        return met.select(F.col("fps")[0].alias("a"), F.explode(F.slice("fps", 2, len(_masks(range(64), radius)))).alias("b"))
    pairs = met.select(F.explode("fps").alias("a"), "fps").select("a", F.explode("fps").alias("b"))
    return pairs.where((F.col("a") < F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits))


# --- components ------------------------------------------------------------------------------
def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root): the least node that each node of an edge is connected with, by alternating
    large-star and small-star steps. A hub's neighbours are never gathered: each step is a minimum
    per node and a join, and every step's edges are written to the shared folder."""
    def star(e: DataFrame, both_ways: DataFrame) -> DataFrame:
        least = both_ways.groupBy("u").agg(F.min("v").alias("m"))
        return e.join(least.withColumn("m", F.least("u", "m")), "u")

    cur = stored(edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where(F.col("u") != F.col("v"))
                 .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "cc")
    before = None
    while True:
        both = cur.unionByName(cur.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = (star(both, both).where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .where(F.col("u") != F.col("v")).distinct())
        large = stored(large, "cc-large")
        small = star(large, large)
        small = (small.select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(small.select("u", F.col("m").alias("v"))).where(F.col("u") != F.col("v")).distinct())
        cur = stored(small, "cc-small")
        seen = cur.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if tuple(seen) == before:
            break
        before = tuple(seen)
    return cur.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        cur.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = 3,
                    max_bits: int = 2, hot_bucket: int = HOT_BUCKET) -> DataFrame:
    """(id, fp, component_id), one row per row of ``docs``; see the module's docstring."""
    ship(docs.sparkSession)
    prints = stored(docs.select(F.col(id_col).alias("id"), fingerprint_column(text_col, shingle_words).alias("fp")),
                    "simhash-prints")
    return prints.join(_component_ids(prints, max_bits, hot_bucket), "fp").select("id", "fp", "component_id")


def _component_ids(prints: DataFrame, max_bits: int, hot_bucket: int) -> DataFrame:
    """(fp, component_id) of stored (id, fp); fingerprints of one id are one document."""
    distinct = stored(prints.groupBy("fp").agg(F.min("id").alias("id"), F.count("*").alias("n")), "simhash-distinct")
    pairs = links(distinct.select("fp"), max_bits, hot_bucket)
    # a node is ordered by its least id first, so that the root of a component has the least id
    node = F.struct(F.col("id").isNull().alias("z"), F.col("id").alias("id"), F.col("fp").alias("fp"))
    nodes = distinct.select("fp", node.alias("node"))
    named = (pairs.join(nodes.select(F.col("fp").alias("a"), F.col("node").alias("na")), "a")
             .join(nodes.select(F.col("fp").alias("b"), F.col("node").alias("nb")), "b").select("na", "nb"))
    # rows of one id but other texts are one document
    same = (prints.where(F.col("id").isNotNull()).groupBy("id").agg(F.min("fp").alias("lo"), F.max("fp").alias("hi"))
            .where(F.col("lo") != F.col("hi")).select("id"))
    split = prints.join(same, "id").select("id", "fp").distinct().join(nodes, "fp")
    first = split.groupBy("id").agg(F.min("node").alias("na"))
    named = named.unionByName(split.select("id", F.col("node").alias("nb")).join(first, "id").select("na", "nb"))
    roots = components(named, "na", "nb")
    rooted = stored(roots.select(F.col("node.fp").alias("fp"), F.col("root.id").alias("component_id"),
                                 F.lit(True).alias("linked")), "simhash-roots")
    ids = distinct.join(rooted, "fp", "left").select(
        "fp", F.when(F.col("linked"), F.col("component_id")).otherwise(F.col("id")).alias("component_id"))
    return stored(ids, "simhash-components")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = 3,
             max_bits: int = 2, hot_bucket: int = HOT_BUCKET) -> DataFrame:
    """``docs`` with one row per component of linked fingerprints: that of the least id (null last), then of the least hash of
    its text and of its row; of rows equal in every column one stays. Texts are linked by their fingerprints alone: unlike texts of one id are
    different documents here, and equal texts of a null id are copies."""
    ship(docs.sparkSession)
    hashed = [c for c, t in docs.dtypes if not t.startswith(("map", "variant"))]
    names = [free_name(docs, n) for n in ("k_id", "k_text", "k_row")]
    key = dict(zip(names, (F.col(id_col), F.xxhash64(text_col), F.xxhash64(*hashed))))
    prints = stored(docs.select(fingerprint_column(text_col, shingle_words).alias("fp"), *[v.alias(k) for k, v in key.items()]), "simhash-prints")
    ids = _component_ids(prints.select(F.col("fp").alias("id"), "fp"), max_bits, hot_bucket)
    # aggregated per task first, so copies cost a row per task
    rows = stored(prints.groupBy("fp", *key).agg(F.count("*").alias("n")).join(ids, "fp"), "simhash-rows")
    order = F.struct(F.col(names[0]).isNull().alias("z"), *key)
    best = rows.groupBy("component_id").agg(F.min(order).alias("best"))
    judged = rows.join(best, "component_id").withColumn("stays", order == F.col("best"))
    on = reduce(lambda a, b: a & b, [own.eqNullSafe(F.col(k)) for k, own in key.items()])
    gone = stored(judged.where(~F.col("stays")).select(*key), "simhash-gone")
    left = docs.join(gone, on, "left_anti")
    twice = stored(judged.where(F.col("stays") & (F.col("n") > 1)).select(*key), "simhash-repeated")
    if twice.isEmpty():
        return left
    one = left.join(twice, on, "inner").dropDuplicates(list(key)).select(*[left[c] for c in docs.columns])
    return left.join(twice, on, "left_anti").unionByName(one)


def query(spark, sf_dir) -> DataFrame:
    """op9: all documents, 3-word shingles, links of 2 or fewer differing bits."""
    from costmart.llm.common import table

    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                        "component_id")
