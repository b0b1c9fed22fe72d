"""Substring dedup: the index against plain search, the operator against brute force."""

import random

import numpy as np
import pytest

from costmart.llm import substring
from tests.llm.rows import EDGE_TEXTS, docs, prose

LAST = 1 << 62


def brute(texts, k):
    """texts: rows (doc_id, text); rows of one id and text are one document."""
    first = {}
    order = [(LAST if i is None else i, (t or "").encode().split()) for i, t in texts]
    for i, w in order:
        for p in range(len(w) - k + 1):
            key = tuple(w[p:p + k])
            first[key] = min(first.get(key, (i, p)), (i, p))
    out = []
    for (i, w), (doc, _) in zip(order, texts):
        gone = set()
        for p in range(len(w) - k + 1):
            if first[tuple(w[p:p + k])] < (i, p):
                gone.update(range(p, p + k))
        out.append((doc, len(w), len(gone), b" ".join(x for q, x in enumerate(w) if q not in gone).decode()))
    return sorted(out, key=str)


def corpus(seed, k):
    rng = random.Random(seed)
    shared = [prose(1000 + i, 2 * k) for i in range(4)]
    texts = list(EDGE_TEXTS)
    for n in range(60):
        t = prose(seed * 100 + n, rng.choice([3, k, 3 * k, 8 * k]), rng.choice([2, 300]))
        if rng.random() < 0.5:
            t = t[:len(t) // 2] + " " + rng.choice(shared) + " " + t[len(t) // 2:]
        if texts and rng.random() < 0.3:
            t = rng.choice(texts[9:] or texts)[1] or t
            words = t.split()
            if words and rng.random() < 0.5:
                words[rng.randrange(len(words))] = "edit"
            t = "  ".join(words)
        texts.append((100 + n, t))
    texts += [(400, "again " * 5 * k), (401, "again " * 3 * k), (None, shared[0]), (100, shared[1] + " other row of an id")]
    return texts


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(spark, seed):
    texts = corpus(seed, 8)
    out = substring.deduplicate(docs(spark, texts), window=8, anchor=3, shard_bytes=4000)
    got = sorted([(r.id, r.n_words, r.n_removed, r.kept) for r in out.collect()], key=str)
    assert got == brute(texts, 8)
    assert sum(g[2] for g in got) > 500


def test_hot_anchors_change_nothing(spark, monkeypatch):
    texts = corpus(3, 8)
    monkeypatch.setattr(substring, "HOT_SHARE", 0.0)  # whatever is in three documents counts as hot
    assert len(substring.hot_anchors(docs(spark, texts), "text", 8, 3)) > 3
    out = substring.deduplicate(docs(spark, texts), window=8, anchor=3, shard_bytes=4000)
    assert sorted([(r.id, r.n_words, r.n_removed, r.kept) for r in out.collect()], key=str) == brute(texts, 8)


def test_a_shard_gets_copies_once_a_batch(spark):
    import zstandard

    passage = prose(77, 60)
    texts = [(i, f"{prose(2000 + i, 12)} {passage} {prose(5000 + i, 12)}") for i in range(900)]
    table = docs(spark, texts).coalesce(2)
    rows = table.selectExpr("cast(doc_id as long) doc", "xxhash64(text) th", "cast(text as binary) text")
    hot = substring.hot_anchors(table, "text", 8, 3)
    assert len(hot)
    got = {}
    for r in substring._routed(rows, 5, 8, 3, hot).where("contents is not null").collect():
        for c in zstandard.ZstdDecompressor().decompress(r.contents).split(b"\n"):
            got[c] = got.get(c, 0) + 1
    assert max(got.values()) <= 2  # 900 when every copy is sent
    out = substring.deduplicate(table, window=8, anchor=3, shard_bytes=4000)
    assert sorted([(r.id, r.n_words, r.n_removed, r.kept) for r in out.collect()], key=str) == brute(texts, 8)


def test_texts_of_one_id_share_an_answer(spark):
    head = prose(78, 30)
    texts = [(None, f"{head} {prose(3000 + i, 20)}") for i in range(60)] + [(7, f"{head} {prose(4000 + i, 9)}") for i in range(30)]
    for early in ([], [(2, prose(79, 5) + " " + " ".join(head.split()[4:22]))]):
        rows = texts + texts[:5] + early
        for parts in (1, 7):
            out = substring.deduplicate(docs(spark, rows).repartition(parts), window=8, anchor=3, shard_bytes=4000)
            assert sorted([(r.id, r.n_words, r.n_removed, r.kept) for r in out.collect()], key=str) == brute(rows, 8)


def test_production_window(spark):
    passage = prose(5, 55)
    texts = [(1, prose(6, 100) + " " + passage), (2, passage + " " + prose(7, 100)), (3, passage[:len(passage) // 4]), (4, prose(8, 100))]
    rows = {r.id: r for r in substring.deduplicate(docs(spark, texts)).collect()}
    assert [rows[i].n_removed for i in (1, 2, 3, 4)] == [0, 55, 0, 0]


def test_index_counts_and_places():
    rng = np.random.default_rng(1)
    for _ in range(20):
        n = int(rng.integers(5, 400))
        tokens = np.append(rng.integers(1, rng.integers(2, 12), n), 0)
        index = substring.FMIndex(tokens, 6)
        for _ in range(30):
            at, length = int(rng.integers(0, n - 4)), int(rng.integers(1, 5))
            pattern = tokens[at:at + length].copy()
            if rng.random() < 0.3:
                pattern[0] = tokens[:n].max()
            lo, hi = np.zeros(1, np.int64), np.full(1, len(tokens))
            for symbol in pattern[::-1]:
                lo, hi = index.extend(np.array([symbol]), lo, hi)
            want = [p for p in range(n - length + 1) if (tokens[p:p + length] == pattern).all()]
            assert sorted(index.places(np.arange(lo[0], hi[0])).tolist()) == want


def test_matching_statistics_equal_plain_search():
    rng = np.random.default_rng(2)
    for trial in range(40):
        depth, words = int(rng.integers(1, 9)), int(rng.integers(2, 9))
        texts = [rng.integers(1, words, int(rng.integers(0, 90))) for _ in range(int(rng.integers(1, 9)))]
        if trial % 3 == 0:
            texts.append(texts[0][3:60])
        lengths = np.array([len(t) for t in texts], dtype=np.int64)
        starts = np.cumsum(lengths + 1) - lengths - 1
        tokens = np.concatenate([np.append(t, 0) for t in texts])
        runs = {}
        for t in texts:
            for p in range(len(t)):
                for k in range(1, min(depth, len(t) - p) + 1):
                    key = tuple(t[p:p + k].tolist())
                    runs[key] = runs.get(key, 0) + 1
        index = substring.FMIndex(tokens, depth, rate=int(rng.integers(1, 10)))
        for least in (1, max(1, depth - 1), depth):
            want = {}
            for i, t in enumerate(texts):
                for p in range(len(t)):
                    k = max((k for k in range(1, min(depth, len(t) - p) + 1) if runs[tuple(t[p:p + k].tolist())] > 1), default=0)
                    if k >= least:
                        want[(i, p)] = (k, runs[tuple(t[p:p + k].tolist())])
            got = list(zip(*(c.tolist() for c in substring.matching_statistics(index, tokens, starts, lengths, least))))
            assert len(got) == len(want)
            assert {(i, p): (k, hi - lo) for i, p, k, lo, hi in got} == want


def test_shared_words_of_long_order():
    """Borders many words of bits apart."""
    tokens = np.append(np.ones(700, dtype=np.int64), 0)
    index = substring.FMIndex(tokens, 5)
    text, at, length, lo, hi = substring.matching_statistics(index, tokens, np.zeros(1, np.int64), np.array([700]), 5)
    assert sorted(at.tolist()) == list(range(696)) and set((hi - lo).tolist()) == {696}
    assert sorted(index.places(np.arange(lo[0], hi[0])).tolist()) == list(range(696))


def test_equal_windows_have_equal_routes():
    words = prose(9, 300).encode().split()
    passage = prose(10, 60).encode().split()
    def windows(w):
        out = {}
        for route, first, count in zip(*substring.segments(w, 20, 5)):
            for p in range(first, first + count):
                assert p not in out
                out[p] = int(route)
        return out
    a, b = windows(words + passage), windows(passage + words)
    assert [a[300 + i] for i in range(41)] == [b[i] for i in range(41)]
    assert len(a) == 341


def test_empty_table(spark):
    assert substring.deduplicate(docs(spark, [])).collect() == []
