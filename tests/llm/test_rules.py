"""Quality rules: statistics against plain counting, the learned list on held-out rows."""

import random
import re

import numpy as np
from pyspark.sql import functions as F

from costmart.llm import rules
from tests.llm.rows import EDGE_TEXTS, docs, prose


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines, seen, dup = text.split("\n"), set(), 0
    for line in lines:
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    windows = {}
    for i in range(len(words) - 2):
        windows.setdefault(tuple(words[i:i + 3]), []).append(i)
    repeat = {p + k for at in windows.values() if len(at) > 1 for p in at for k in range(3)}
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(repeat))


def texts():
    rng = random.Random(4)
    parts = ["a", "b", "a b a b", "é漢", "😀", "x#y", "<b>|", "\n", "\n\n", " ", "\t", "\x0b", "\x0c", "\r", "\x85", " ", "\x1c", "same line\n"]
    return [" ".join(rng.choice(parts) for _ in range(rng.randint(0, 60))) for _ in range(300)]


def test_statistics_equal_plain_counting(spark):
    rows = EDGE_TEXTS + [(1000 + i, t) for i, t in enumerate(texts())]
    out = rules.judge(docs(spark, rows), []).collect()
    got = sorted((str(r.doc_id), r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in out)
    assert got == sorted((str(i), *brute(t)) for i, t in rows)
    for r in out:
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words) and r.kept == (not r.base_failed)


def labelled(n, seed):
    rng = np.random.default_rng(seed)
    x = {c: rng.random(n) for c in ("symbol_ratio", "upper_ratio", "mean_word")}
    bad = ((x["symbol_ratio"] > 0.7) & (x["mean_word"] <= 0.6)) | (x["upper_ratio"] > 0.85)
    return x, bad


def test_learned_list_on_held_out_rows():
    x, bad = labelled(6000, 1)
    noisy = bad ^ (np.random.default_rng(3).random(len(bad)) < 0.02)
    found = rules.learn(x, noisy)
    assert 2 <= len(found) <= rules.MAX_RULES and all(len(r.tests) <= rules.MAX_TESTS for r in found)
    x, bad = labelled(3000, 2)
    said = np.zeros(len(bad), dtype=bool)
    for r in found:
        said |= r.holds(x, len(bad))
    assert (said == bad).mean() > 0.97


def test_emitted_expression_equals_the_list(spark):
    x, bad = labelled(500, 5)
    found = rules.learn(*labelled(4000, 6))
    table = spark.createDataFrame([tuple(float(x[c][i]) for c in x) for i in range(500)], list(x))
    got = [r.rule for r in table.select(rules.rule_column(found).alias("rule")).collect()]
    want = np.zeros(500, dtype=int)
    for i in range(len(found), 0, -1):
        want[found[i - 1].holds(x, 500)] = i
    assert got == want.tolist()


def test_fit_and_judge(spark):
    good = [(i, prose(i, 120)) for i in range(120)]
    junk = [(500 + i, " ".join(w + "%%%" for w in prose(i, 120).split())) for i in range(60)]
    table = docs(spark, good + junk + EDGE_TEXTS)
    labels = spark.createDataFrame([(i, 1) for i, _ in good] + [(i, 0) for i, _ in junk] + [(None, 0), (1, None), (9999, 0), (0, 1)],
                                   "doc_id long, quality int")
    found = rules.fit(table, labels)
    kept = {r.doc_id for r in rules.judge(table, found).where("kept").collect()}
    assert kept >= {i for i, _ in good} and not kept & {i for i, _ in junk}


def test_one_class_or_nothing(spark):
    table = docs(spark, [(i, prose(i, 80)) for i in range(10)])
    for labels in ([(i, 1) for i in range(10)], [(i, 0) for i in range(10)], []):
        found = rules.fit(table, spark.createDataFrame(labels, "doc_id long, quality int"))
        assert found == [] and rules.judge(table, found).where("kept").count() == 10
    assert rules.judge(docs(spark, []), []).agg(F.count("*")).first()[0] == 0


def test_sample_is_bounded_where_one_id_repeats(spark, monkeypatch):
    texts = [(1, prose(i, 12)) for i in range(300)] + [(1, "same row of the id")] * 50 + [(i, prose(i, 12)) for i in range(2, 30)]
    labels = spark.createDataFrame([(i, int(i != 1)) for i in range(1, 30)], "doc_id long, quality int")
    seen = []
    monkeypatch.setattr(rules, "learn", lambda columns, bad: seen.append(len(bad)) or [])
    rules.fit(docs(spark, texts), labels, max_rows=40)
    rules.fit(docs(spark, texts), labels)
    assert seen == [40, 301 + 28]
