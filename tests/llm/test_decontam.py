"""Decontamination against brute force, on both join paths."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from costmart.llm import decontam
from tests.llm.rows import EDGE_TEXTS, docs, prose

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(texts, items, k=13):
    out = []
    for i, text in texts:
        w, hit, found = words(text), set(), set()
        for item_id, item in items:
            v = words(item)
            n = min(k, len(v))
            for s in range(len(v) - n + 1 if n else 0):
                for p in range(len(w) - n + 1):
                    if w[p:p + n] == v[s:s + n]:
                        hit.update(range(p, p + n))
                        found.add(item_id)
        found = sorted(str(x) for x in found if x is not None)
        out.append((i, len(w), len(hit), found))
    return sorted(out, key=str)


def passages():
    rng = random.Random(5)
    items = [(n, prose(100 + n, rng.choice([13, 20, 40]), 30)) for n in range(12)]
    items += [(20, "Two Words"), (21, "solo"), (22, None), (23, "..."), (24, "É accents stay É, A-Z don't " * 2), (None, prose(7, 15)),
              (3, items[3][1]), (30, "again and " * 10)]
    texts = list(EDGE_TEXTS)
    for n in range(40):
        base = prose(n, rng.choice([5, 60, 300]), 30)
        item = rng.choice([t for _, t in items if t])
        cut = rng.choice([0, 0, 3])
        texts.append((100 + n, base + "\n" + " ".join(item.split()[cut:]).upper() + ", " + base if n % 2 else base))
    texts += [(200, "it is two-words: TWO, words; (solo)"), (201, "again and again and again and again and again and again and again"),
              (202, "é accents stay é a z don t " * 3)]
    return texts, items


@pytest.mark.parametrize("limit,keys", [(decontam.BROADCAST_BYTES, 0), (0, decontam.BROADCAST_KEY_BYTES), (0, 0)])
def test_equals_brute_force(spark, limit, keys):
    texts, items = passages()
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = decontam.contamination(docs(spark, texts), bench, broadcast_bytes=limit, key_bytes=keys)
    got = sorted([(r.doc_id, r.n_words, r.n_hit, list(r["items"])) for r in found.collect()], key=str)
    assert got == brute(texts, items)
    assert sum(1 for g in got if g[2]) > 15


def test_words_are_cut_at_separators(spark):
    """The contract's words, at the cost of a split: extracting them one by one was most of the query's time."""
    texts = [None, "", " ", "...", "solo", " Lead", "trail. ", "a--B\n\tC\x00d\x7fe", "[`{@Z09/:az}~", "ÉTÉ É,é Ünder-x",
             "\u212aelvin K\u0130 \u0130stanbul", "no\u00a0break \u2003 \u0085x", "\U0001f600 A\U00010400b", "it's 3.14%", "\u00c9", "A" * 50 + "," * 50]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string").select("i", decontam.words_of(F.col("text")).alias("w"))
    assert {r.i: r.w for r in df.collect()} == {i: words(t) for i, t in enumerate(texts)}
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "split(" in plan and "regexp_extract_all" not in plan


def test_only_the_windows_shingles_are_shuffled(spark):
    """A benchmark beyond the broadcast of its words: the count by key sees only shingles that a window has."""
    texts, items = passages()
    windows, _ = decontam.benchmark_windows(spark.createDataFrame(items, "item_id long, text string"), "item_id", "text", 13)
    words = docs(spark, texts).selectExpr("doc_id", "xxhash64(text) AS th").join(
        docs(spark, texts).select(decontam.F.xxhash64("text").alias("th"), decontam.words_of(decontam.F.col("text")).alias("words")), "th")
    plan = decontam.occurrences(words, windows, broadcast_bytes=0)._jdf.queryExecution().executedPlan().toString()
    hits = [line for line in plan.splitlines() if "BroadcastHashJoin" in line and "w_key" in line]
    assert hits and "SortMergeJoin [key#" not in plan


def test_empty_tables(spark):
    texts, items = passages()
    none = spark.createDataFrame([], "item_id long, text string")
    out = decontam.contamination(docs(spark, texts[:12]), none).collect()
    assert len(out) == 12 and all(r.n_hit == 0 and r["items"] == [] for r in out)
    assert decontam.contamination(docs(spark, []), spark.createDataFrame(items, "item_id long, text string")).collect() == []


def test_rule_and_drop(spark):
    item = prose(3, 13)
    long_text = item + " " + prose(4, 13 * 20 - 13)
    texts = [(1, long_text), (2, long_text + " more"), (3, prose(9, 50)), (3, prose(9, 50)), (4, None)]
    bench = spark.createDataFrame([(0, item)], "item_id long, text string")
    assert sorted(r.doc_id for r in decontam.drop_contaminated(docs(spark, texts), bench).collect()) == [2, 3, 3, 4]
    assert decontam.drop_contaminated(docs(spark, texts), bench).columns == docs(spark, texts).columns


def test_digest_column(spark, tmp_path):
    docs(spark, [(1, "solo " * 13)]).select("doc_id", "text").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(10, "solo"), (9, "solo")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    r = decontam.query(spark, str(tmp_path)).first()
    assert (r.n_items, r.items_sha256, r.contaminated) == (2, hashlib.sha256(b"10,9").hexdigest(), True)


def test_no_python_in_the_plan(spark):
    texts, items = passages()
    bench = spark.createDataFrame(items, "item_id long, text string")
    plan = decontam.contamination(docs(spark, texts), bench).withColumn("c", F.lit(1))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan
