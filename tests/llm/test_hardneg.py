"""Hard negatives against plain Python integers."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from costmart.llm import hardneg
from tests.conftest import SF_SMALL

SCHEMA = "vec_id long, label int, embedding array<float>, anchor string, id string, rank int"


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", 1) for r in rows], SCHEMA).repartition(3)


def brute(rows, anchors, n_pos=5, n_neg=5, scale=256):
    whole = []
    for i, label, v in rows:
        if label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        whole.append((i, label, [math.floor(scale * float(np.float32(x))) for x in v]))
    last = lambda i: (i is None, i or 0)
    out = []
    for i, label, v in {(i, l, tuple(v)) for i, l, v in whole if i is not None and anchors(i)}:
        score = [(-sum(a * b for a, b in zip(v, w)), last(j), j, l) for j, l, w in whole]
        positives = sorted(s for s in score if s[3] == label and s[2] != i)[:n_pos]
        for s, _, p, _ in positives:
            inside = sorted(t for t in score if t[3] != label and 80 * -s <= 100 * -t[0] <= 100 * -s)[:n_neg]
            out += [(i, p, k + 1, t[2], -s, -t[0]) for k, t in enumerate(inside)]
    return sorted(out, key=str)


def mined(df, anchors):
    return sorted(map(tuple, hardneg.mine(df, anchors).collect()), key=str)


@pytest.mark.parametrize("width,size", [(1, 3.0), (7, 1e3), (64, 0.6), (300, 2.0), (600, 40.0)])
def test_products_are_exact(width, size):
    rng = np.random.default_rng(width)
    a, b = (np.floor(rng.uniform(-256 * size, 256 * size, (n, width))) for n in (9, 13))
    bound = int(max((a * a).sum(1).max(), (b * b).sum(1).max())) + 1
    product = hardneg.ResidueProduct(width, bound)
    got = product.scores(product.residues(a), product.residues(b))
    assert got.tolist() == [[sum(int(x) * int(y) for x, y in zip(r, c)) for c in b] for r in a]


def test_too_large_scores_are_refused():
    with pytest.raises(ArithmeticError):
        hardneg.ResidueProduct(64, 1 << 60)


def test_best_breaks_ties_by_position():
    assert hardneg.best(np.array([1, 5, 5, 2, 5, 1]), 2).tolist() == [1, 2]
    assert hardneg.best(np.array([1, 5]), 5).tolist() == [1, 0]


def test_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(hardneg, "CHUNK_ROWS", 40)
    rng = random.Random(4)
    rows = [(i, rng.randrange(4), [round(rng.uniform(-1, 1), 1) for _ in range(3)]) for i in range(300)]
    # ties, nulls, numbers that are none, repeated rows, other lengths, large and negative values
    rows += [(300, None, [1.0, 1.0, 1.0]), (301, 1, None), (302, 1, [1.0, None, 1.0]), (303, 2, [math.nan, 1.0, 0.0]),
             (304, 2, [math.inf, 0.0, 0.0]), (305, 1, []), (306, 2, [0.5]), (307, 3, [0.5] * 5), (None, 1, [0.9, 0.9, 0.9]),
             (None, 2, [0.8, 0.9, 0.9]), (308, -3, [0.7, 0.7, 0.7]), (309, 1, [90.0, -80.0, 70.0])] + rows[:3] + [rows[20]]
    df = table(spark, rows)
    got = mined(df, F.col("vec_id") % 20 == 0)
    assert got == brute(rows, lambda i: i % 20 == 0) and len(got) > 100


def test_hot_label_and_copies(spark):
    rows = [(i, 1 if i % 3 else i % 5, [1.0, 0.5, -0.25] if i % 2 else [0.9, 0.5, i / 500]) for i in range(400)]
    assert mined(table(spark, rows), F.col("vec_id") % 50 == 0) == brute(rows, lambda i: i % 50 == 0)


@pytest.mark.parametrize("rows", [[], [(1, None, None)], [(0, 1, [1.0])], [(0, 1, [0.0]), (1, 1, [0.0]), (2, 2, [0.0])]])
def test_small_tables(spark, rows):
    assert mined(table(spark, rows), F.col("vec_id") % 20 == 0) == brute(rows, lambda i: i % 20 == 0)


def test_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").select("vec_id", "label", "embedding").collect()]
    rows = [(i, (l + 1) % 10 if i % 7 == 0 else l, v) for i, l, v in rows]
    got = hardneg.query(spark, SF_SMALL)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows, lambda i: i % 100 == 0)
