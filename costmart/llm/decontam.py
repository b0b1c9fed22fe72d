"""Benchmark decontamination: a prefix-filtered set join, in DataFrame operations only.

A window is ``window_words`` consecutive words of a benchmark item (a shorter item is one window). A
document contains a window only if it contains every shingle of it, so it is enough to look each
window up by one necessary shingle, its prefix: the one that is rarest among all documents.

1. Count how often each benchmark shingle occurs in all documents (one scan, aggregated per task).
2. Order each distinct window's shingles by rarity and keep the rarest as its prefix token.
3. Join the documents' shingles with the prefix tokens. A match fixes where the window would start;
   the position must not lie before the text (positional bound) nor the end behind it (length
   bound); then the words are compared one by one. All of that runs inside the scan's stage, so the
   texts are not shuffled: only verified occurrences and one narrow row per document leave it.

The benchmark side is broadcast only if its measured size is at most ``broadcast_bytes``; a larger
one is joined by shuffles of narrow (token, row, position) rows, and the candidates meet the words
in a second join.

Defined cases: a null text has no words; a document of no words is not contaminated; an item of no
words has no windows; an item with a null id marks words but is not counted as an item. Repeated
document rows are reported one by one with equal results; repeated items count once. A row is told
apart by its id and its text's 64-bit hash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from costmart.llm.common import stored, table

#: What lies between words, after A-Z are made small: all ASCII but digits and letters, by the contract.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WINDOW_WORDS = 13
SHINGLE_WORDS = 3
#: Windows with their words up to this size are broadcast; else their bare keys, each of about so many bytes in a hash table.
BROADCAST_BYTES = 16 << 20
BROADCAST_KEY_BYTES, KEY_BYTES = 64 << 20, 100


def words_of(text: Column) -> Column:
    # cut at what lies between words: regexp_extract_all takes several times the time for the same words
    ascii_only = F.octet_length(text) == F.char_length(text)  # there lower() touches A-Z alone, and is cheaper
    small = F.when(ascii_only, F.lower(text)).otherwise(
        F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    return F.coalesce(F.array_remove(F.split(small, BETWEEN), ""), F.array().cast("array<string>"))


def _key(words: Column, at: Column, n: int) -> Column:
    """The hash of the n words from index ``at`` on; null where the text ends before."""
    parts = [F.get(words, at + i) for i in range(n)]
    return F.when(parts[0].isNotNull() & parts[-1].isNotNull(), F.xxhash64(F.lit(n), *parts))


def benchmark_windows(benchmark: DataFrame, id_col: str, text_col: str, window_words: int) -> tuple[DataFrame, DataFrame]:
    """Distinct windows (wid, words, len) and which items have them (wid, item_id)."""
    items = benchmark.select(F.col(id_col).cast("string").alias("item_id"), words_of(F.col(text_col)).alias("words"))
    items = items.where(F.size("words") > 0)
    last = F.greatest(F.size("words") - window_words, F.lit(0))
    windows = items.select("item_id", F.explode(F.transform(
        F.sequence(F.lit(0), last), lambda s: F.slice("words", s + 1, window_words))).alias("words"))
    windows = stored(windows.select("item_id", "words", F.sha2(F.concat_ws(" ", "words"), 256).alias("wid")).distinct(),
                     "decontam-windows")
    return (windows.select("wid", "words", F.size("words").alias("len")).dropDuplicates(["wid"]),
            windows.select("wid", "item_id").distinct())


def _shingles(windows: DataFrame, shingle_words: int) -> DataFrame:
    """(wid, offset, key) of every shingle of every window; a shorter window is one shingle."""
    rows = windows.select("wid", "words", "len", F.explode(
        F.sequence(F.lit(0), F.greatest(F.col("len") - shingle_words, F.lit(0)))).alias("offset"))
    key = F.lit(None).cast("long")
    for n in range(shingle_words, 0, -1):
        at_most = F.col("len") >= n if n == shingle_words else F.col("len") == n
        key = F.coalesce(key, F.when(at_most, _key(F.col("words"), F.col("offset"), n)))
    return rows.select("wid", "offset", key.alias("key"))


def _exploded(docs: DataFrame, lengths: list[int]) -> DataFrame:
    """A row per shingle of the lengths asked for, and first one per document with pos -1, key null."""
    rows = docs.select("*", F.size("words").alias("n_words")).select(
        "*", F.explode(F.sequence(F.lit(-1), F.col("n_words") - 1)).alias("pos"))
    keys = [F.when(F.col("pos") >= 0, _key(F.col("words"), F.col("pos"), n)) for n in lengths]
    if len(keys) == 1:
        return rows.withColumn("key", keys[0])
    # only with very short items: one more row per length, and still one with pos -1
    rows = rows.withColumn("key", F.explode(F.array(*keys)))
    return rows.where(F.col("key").isNotNull()).unionByName(
        docs.select("*", F.size("words").alias("n_words"), F.lit(-1).alias("pos"), F.lit(None).cast("long").alias("key")))


def _bytes(df: DataFrame, text: Column) -> int:
    return df.agg(F.coalesce(F.sum(F.octet_length(text) + 100), F.lit(0)).alias("b")).first()["b"]


def occurrences(docs: DataFrame, windows: DataFrame, shingle_words: int = SHINGLE_WORDS,
                broadcast_bytes: int = BROADCAST_BYTES, key_bytes: int = BROADCAST_KEY_BYTES) -> DataFrame:
    """Of ``docs`` (doc_id, th, words): rows (doc_id, th, n_words, start, wid, len): one per occurrence
    of a window, and one per document with start -1."""
    shingles = stored(_shingles(windows, shingle_words), "decontam-shingles")
    lengths = sorted(r["n"] for r in windows.select(F.least("len", F.lit(shingle_words)).alias("n")).distinct().collect())
    lengths = lengths or [shingle_words]
    keys = shingles.select("key").distinct()
    small = _bytes(windows, F.concat_ws(" ", "words")) * (WINDOW_WORDS + 1) <= broadcast_bytes
    seen = _exploded(docs, lengths).select("key")
    # bare keys are far smaller than the windows' words: as long as they fit, only the windows' shingles are shuffled
    narrow = small or keys.count() * KEY_BYTES <= key_bytes
    met = seen.join(F.broadcast(keys), "key") if narrow else seen.where(F.col("key").isNotNull())
    counts = met.groupBy("key").agg(F.count("*").alias("df"))
    rarest = F.min(F.struct(F.coalesce("df", F.lit(0)).alias("df"), "key", "offset"))
    prefix = stored(shingles.join(counts, "key", "left").groupBy("wid").agg(rarest.alias("p"))
                    .select("wid", F.col("p.key").alias("w_key"), F.col("p.offset").alias("offset"))
                    .join(windows.select("wid", F.col("words").alias("w_words"), "len"), "wid"), "decontam-prefix")
    start = F.col("pos") - F.col("offset")
    bounds = (start >= 0) & (start + F.col("len") <= F.col("n_words"))
    exact = F.slice("words", F.greatest(start, F.lit(0)) + 1, F.col("len")) == F.col("w_words")
    rows = _exploded(docs, lengths)
    if small:
        on = (F.col("key") == F.col("w_key")) & bounds & exact
        found = rows.join(F.broadcast(prefix), on, "left").where((F.col("pos") == -1) | F.col("wid").isNotNull())
        return found.select("doc_id", "th", "n_words", F.when(F.col("pos") == -1, -1).otherwise(start).alias("start"), "wid", "len")
    starts = prefix.select("w_key", "offset", "wid", "len")
    near = (rows.select("doc_id", "th", "n_words", "pos", "key")
            .join(F.broadcast(starts) if narrow else starts, F.col("key") == F.col("w_key")).where(bounds)
            .select(F.col("doc_id").alias("c_id"), F.col("th").alias("c_th"), start.alias("start"), "wid", "len").distinct())
    one = docs.withColumn("n_words", F.size("words")).dropDuplicates(["doc_id", "th"])
    checked = (near.join(windows.select("wid", F.col("words").alias("w_words")), "wid")
               .join(one, F.col("c_id").eqNullSafe(F.col("doc_id")) & (F.col("c_th") == F.col("th")))
               .where(F.slice("words", F.col("start") + 1, F.col("len")) == F.col("w_words"))
               .select("doc_id", "th", "n_words", "start", "wid", "len"))
    alone = docs.select("doc_id", "th", F.size("words").alias("n_words"), F.lit(-1).alias("start"),
                        F.lit(None).cast("string").alias("wid"), F.lit(None).cast("int").alias("len"))
    return checked.unionByName(alone)


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text", window_words: int = WINDOW_WORDS,
                  shingle_words: int = SHINGLE_WORDS, broadcast_bytes: int = BROADCAST_BYTES,
                  key_bytes: int = BROADCAST_KEY_BYTES) -> DataFrame:
    """(doc_id, th, n_words, n_hit, items), a row per row of ``docs``: words inside occurrences of
    windows, and the sorted ids of the items that these windows belong to."""
    windows, owners = benchmark_windows(benchmark, item_col, item_text_col, window_words)
    words = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("th"),
                        words_of(F.col(text_col)).alias("words"))
    found = stored(occurrences(words, windows, shingle_words, broadcast_bytes, key_bytes), "decontam-found")
    spots = found.where(F.col("start") >= 0)
    by_start = W.partitionBy("doc_id", "th").orderBy("start", "end")
    reached = F.coalesce(F.max("end").over(by_start.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    hit = (spots.select("doc_id", "th", "start", (F.col("start") + F.col("len")).alias("end")).distinct()
           .select("doc_id", "th", F.greatest(F.col("end") - F.greatest("start", reached), F.lit(0)).alias("new"))
           .groupBy("doc_id", "th").agg(F.sum("new").alias("n_hit")))
    items = (spots.select("doc_id", "th", "wid").distinct().join(owners, "wid")
             .groupBy("doc_id", "th").agg(F.array_sort(F.collect_set("item_id")).alias("items")))
    marks = hit.join(items, hit["doc_id"].eqNullSafe(items["doc_id"]) & (hit["th"] == items["th"])).select(
        hit["doc_id"].alias("m_id"), hit["th"].alias("m_th"), "n_hit", "items")
    rows = found.where(F.col("start") == -1).select("doc_id", "th", "n_words")
    marks = stored(marks, "decontam-marks")
    return rows.join(marks, F.col("doc_id").eqNullSafe(F.col("m_id")) & (F.col("th") == F.col("m_th")), "left").select(
        "doc_id", "th", F.col("n_words").cast("long").alias("n_words"),
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"))


def is_contaminated() -> Column:
    return (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without contaminated rows."""
    bad = stored(contamination(docs, benchmark, id_col, text_col).where(is_contaminated())
                 .select(F.col("doc_id").alias("bad_id"), F.col("th").alias("bad_th")).distinct(), "decontam-bad")
    same = docs[id_col].eqNullSafe(bad["bad_id"]) & (F.xxhash64(docs[text_col]) == bad["bad_th"])
    return docs.join(bad, same, "left_anti")


def query(spark, sf_dir) -> DataFrame:
    """op1: all documents against all benchmark items."""
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), is_contaminated().alias("contaminated"))


#: The same by comparing every run of words of a document with every window.
ORACLE = r"""
WITH item AS (
  SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
win AS (
  SELECT DISTINCT item_id, least(len(w), 13) AS n, array_to_string(list_slice(w, s, s + least(len(w), 13) - 1), ' ') AS t
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 13, 0) + 2)) AS s FROM item WHERE len(w) > 0)),
doc AS (
  SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w FROM documents),
run AS (
  SELECT doc_id, p, n, array_to_string(list_slice(w, p, p + n - 1), ' ') AS t
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS p FROM doc, (SELECT DISTINCT n FROM win) WHERE len(w) >= n)),
occ AS (SELECT doc_id, p, run.n, item_id FROM run JOIN win ON run.t = win.t AND run.n = win.n),
hit AS (
  SELECT doc_id, count(DISTINCT q) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + n)) AS q FROM occ) GROUP BY doc_id),
it AS (
  SELECT doc_id, count(*) AS n_items, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids
  FROM (SELECT DISTINCT doc_id, item_id FROM occ) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM doc LEFT JOIN hit USING (doc_id) LEFT JOIN it USING (doc_id)
"""
