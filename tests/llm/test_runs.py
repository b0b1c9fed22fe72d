"""Periodic runs against a plain search over all periods."""

import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
import pytest

from costmart.llm import runs
from tests.conftest import SF_SMALL
from tests.llm.rows import EDGE_TEXTS, docs, prose


def brute(words, least=6, times=4):
    n, out = len(words), []
    for q in range(1, n // times + 1):
        i = 0
        while i < n - q:
            j = i
            while j < n - q and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(least, times * q):
                out.append((i, j + q - i, q))
            i = j + 1
    # the smallest period of a stretch
    return sorted((s, e, q) for s, e, q in out if not any(p < q and t <= s and t + f >= s + e for t, f, p in out))


def expected(text):
    words = (text or "").encode().split()
    found = brute(words)
    gone = {i for s, e, q in found for i in range(s + q, s + e)}
    top = max(found, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)
    digest = hashlib.sha256("".join(f"{s},{e},{q}\n" for s, e, q in found).encode()).hexdigest()
    kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
    return (len(found), *(top if top else (None,) * 3), 1000 * top[1] // top[2] if top else None, digest, hashlib.sha256(kept).hexdigest())


def planted(i, text):
    h, words = zlib.crc32(str(i).encode()), (text or "").encode().split()
    n, g = len(words), h // 10
    if i is None or h % 10 or not n:
        return text
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return b" ".join(words[j] if j < a else words[a + (j - a) % p] for j in range(n)).decode()


def test_runs_of_many_documents_at_once():
    rng = random.Random(5)
    texts = []
    for _ in range(600):
        words, n = [], rng.randrange(0, 70)
        while len(words) < n:
            if rng.random() < 0.4:
                root = [rng.randrange(3) for _ in range(rng.randint(1, 7))]
                words += (root * 8)[:rng.randint(1, 8 * len(root))]
            else:
                words.append(rng.randrange(4))
        texts.append(words)
    texts += [[0] * 200, [0, 1] * 100, list(range(50)) * 5, list(range(30)) * 4, (list(range(9)) * 4 + [99]) * 5, [], [1]]
    starts = np.cumsum([0] + [len(t) for t in texts])
    found = [tuple(map(int, r)) for r in zip(*runs.find_runs(np.concatenate([np.array(t, np.int64) for t in texts]), starts[:-1]))]
    want = [(s + int(starts[k]), e, q) for k, t in enumerate(texts) for s, e, q in brute(t)]
    assert found == want and len(want) > 300


def test_ties_take_the_first_start():
    assert runs._summary([(0, 12, 2), (20, 6, 1), (30, 6, 1)], 40)[:5] == (3, 0, 12, 2, 6000)
    assert runs._summary([(3, 6, 1), (3, 12, 2)], 40)[1:4] == (3, 6, 1)


def test_texts(spark):
    texts = EDGE_TEXTS + [(20, "a " * 5), (21, "a " * 6 + "b"), (22, " x y z" * 4 + " x"), (23, "b b b b b b c c c c c c c"),
                          (24, ("one two three four. " * 40 + "end ") * 5), (25, prose(3, 200) + " ja nein" * 9 + "\n" + prose(4, 100)),
                          (26, (prose(5, 400) + " ") * 4), (27, "a a a a a a a a a a a a"), (28, "A a " * 7)]
    got = runs.periodic_runs(docs(spark, texts)).collect()
    names = ["n_runs", "start", "length", "period", "exponent_milli", "runs_sha256"]
    have = sorted(((str(r.doc_id), tuple(r[c] for c in names) + (hashlib.sha256(r.collapsed.encode()).hexdigest(),)) for r in got), key=str)
    assert have == sorted(((str(i), expected(t)) for i, t in texts), key=str)
    assert all(r.n_runs == len(r.runs) and r.n_words >= r.length for r in got if r.n_runs)


def test_empty_table(spark):
    assert runs.periodic_runs(docs(spark, [])).collect() == []


def test_fewer_periods_are_refused(spark):
    with pytest.raises(ValueError):
        runs.periodic_runs(docs(spark, []), least_periods=2)


def test_query(spark):
    texts = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()]
    want = {i: expected(planted(i, t)) for i, t in texts}
    got = {r.doc_id: tuple(r)[1:] for r in runs.query(spark, SF_SMALL).collect()}
    assert got == want and sum(v[0] > 0 for v in want.values()) > 5


def test_planted_rule_over_edge_texts(spark):
    ids = [None, 1] + [i for i in range(300) if zlib.crc32(str(i).encode()) % 10 == 0][:14]
    rows = [(i, t) for i in ids for _, t in EDGE_TEXTS]
    got = docs(spark, rows).select("doc_id", "text", runs.with_planted_runs().alias("t")).collect()
    for r in got:
        assert (r.t or "").encode().split() == (planted(r.doc_id, r.text) or "").encode().split(), r
