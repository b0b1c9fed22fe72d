"""Ordinal regression: held-out accuracy, degenerate labels, the stage's filter."""

import random

import numpy as np
from pyspark.sql import functions as F

from costmart.llm import toxicity
from tests.llm.rows import EDGE_TEXTS, docs, prose


def sparse(rng, n, true_w, theta):
    x = (rng.random((n, len(true_w))) < 0.15) * rng.uniform(0.5, 2, (n, len(true_w)))
    s = x @ true_w + rng.logistic(size=n) * 0.5
    return x, (s[:, None] > theta[None, :]).sum(axis=1)


def csr(x):
    indices = [np.flatnonzero(r) for r in x]
    return np.cumsum([0, *map(len, indices)]), np.concatenate(indices), x[x != 0]


def test_recovers_four_ordered_grades():
    rng = np.random.default_rng(0)
    true_w, theta = rng.normal(0, 2, 20), np.array([-1.0, 1.5, 3.5])
    x, y = sparse(rng, 4000, true_w, theta)
    w, t = toxicity.fit_cumulative_link(*csr(x), y, 20)
    assert (np.diff(t) > 0).all() and np.corrcoef(w, true_w)[0, 1] > 0.98
    x, y = sparse(rng, 2000, true_w, theta)
    model = toxicity.Model(weights=w, thresholds=t, grades=(0, 1, 2, 3))
    above = model.above(x @ w)
    at = np.hstack([np.ones((len(x), 1)), above]) - np.hstack([above, np.zeros((len(x), 1))])
    assert (at.argmax(axis=1) == y).mean() > 0.75
    assert abs(above.sum(axis=1) - y).mean() < 0.45  # expected severity


def corpus(n):
    bad = ["grumble", "snarl", "sneer", "taunt", "scorn"]
    rng = random.Random(6)
    texts, labels = [], []
    for i in range(n):
        words = prose(i, rng.choice([20, 80, 300])).split()
        toxic = i % 5 == 0
        if toxic:
            for _ in range(rng.choice([1, 2, 6, 12])):
                words.insert(rng.randrange(len(words)), rng.choice(bad).upper() + "!")
        texts.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    return texts, labels


def test_held_out_texts(spark):
    texts, labels = corpus(800)
    table = docs(spark, texts + [(5000 + i, t) for i, t in EDGE_TEXTS if i is not None])
    marks = spark.createDataFrame([x for x in labels if x[0] % 2] + [x for x in labels if x[0] % 4 == 0]
                                  + [(None, 1), (1, None), (9999, 1), (3, 0)], "doc_id long, toxic int")
    model = toxicity.fit(table, marks, F.col("toxic"), levels=3)
    assert model.grades == (0, 1, 2, 3) and (np.diff(model.thresholds) > 0).all()
    scored = {r.doc_id: r.s for r in table.select("doc_id", toxicity.severity_column(model, "text").alias("s")).collect()}
    held = [x for x in labels if x[0] % 4 == 2]
    assert np.mean([(scored[i].p_toxic >= 0.5) == bool(t) for i, t in held]) > 0.95
    assert all(0 <= s.severity <= 3 for s in scored.values())
    kept = toxicity.reject_toxic(table, model)
    assert kept.columns == table.columns
    ids = {r.doc_id for r in kept.collect()}
    assert {i for i, t in labels if not t} <= ids and len(ids & {i for i, t in labels if t}) < 10


def test_without_two_grades_nothing_is_toxic(spark):
    table = docs(spark, EDGE_TEXTS)
    for rows in ([], [(2, 0), (7, 0)], [(2, 1), (7, 1)]):
        model = toxicity.fit(table, spark.createDataFrame(rows, "doc_id long, toxic int"), F.col("toxic"))
        assert toxicity.reject_toxic(table, model).count() == len(EDGE_TEXTS)
    assert toxicity.reject_toxic(docs(spark, []), toxicity.Model()).collect() == []


def test_without_features_the_base_rate_decides(spark):
    table = docs(spark, [(i, prose(i, 30, 100000)) for i in range(20)])
    model = toxicity.fit(table, spark.createDataFrame([(i, int(i < 5)) for i in range(20)], "doc_id long, toxic int"), F.col("toxic"))
    s = table.select(toxicity.severity_column(model, "text").alias("s")).first().s
    assert abs(s.p_toxic - 0.25) < 0.01


def test_sample_is_bounded_where_one_id_repeats(spark, monkeypatch):
    texts = [(1, f"bad{i % 3} {prose(i, 12)}") for i in range(300)] + [(1, "same row of the id")] * 50 + [(i, prose(i, 12)) for i in range(2, 30)]
    labels = spark.createDataFrame([(i, int(i == 1)) for i in range(1, 30)], "doc_id long, toxic int")
    seen = []
    monkeypatch.setattr(toxicity, "fit_cumulative_link", lambda indptr, indices, values, y, n: seen.append(len(indptr) - 1) or (np.zeros(n), np.zeros(max(y))))
    for most, want in ((40, 40), (10_000, 301 + 28)):
        toxicity.fit(docs(spark, texts), labels, F.col("toxic"), max_rows=most)
        assert seen.pop() <= want
