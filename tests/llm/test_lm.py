"""The language model against plain dictionaries."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from costmart.llm import lm
from tests.conftest import SF_SMALL
from tests.llm.rows import EDGE_TEXTS, docs, prose


def words(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", lower) + ["</s>"]


def discounts(counts):
    n = Counter(counts)
    if all(n[k] for k in (1, 2, 3, 4)):
        y = n[1] / (n[1] + 2 * n[2])
        d = [k - (k + 1) * y * n[k + 1] / n[k] for k in (1, 2, 3)]
        if all(0 <= x <= k for k, x in enumerate(d, 1)):
            return d
    return [0.5, 1.0, 1.5]


class Plain:
    def __init__(self, texts):
        pairs = Counter(p for t in texts for p in zip(["<s>"] + words(t), words(t)))
        self.count = Counter(w for t in texts for w in words(t))
        self.n, self.v = sum(self.count.values()), len(self.count)
        self.pairs, self.before, self.after = pairs, Counter(w for _, w in pairs), defaultdict(list)
        for (u, _), c in pairs.items():
            self.after[u].append(c)
        self.d1, self.d2 = discounts(self.before.values()), discounts(pairs.values())
        self.all = sum(self.before.values())
        self.rest = sum(self.d1[min(a, 3) - 1] for a in self.before.values()) / self.all if self.all else 1.0

    def part(self, c, d, total):
        return max(c - d[min(c, 3) - 1], 0) / total if c else 0.0

    def alone(self, w):
        return self.part(self.before[w], self.d1, self.all) + self.rest / (self.v + 1)

    def p(self, u, w):
        total = sum(self.after.get(u, []))
        if not total:
            return self.alone(w)
        back = sum(self.d2[min(c, 3) - 1] for c in self.after[u]) / total
        return self.part(self.pairs[u, w], self.d2, total) + back * self.alone(w)

    def row(self, text):
        own = words(text)
        base = sum(math.log10((self.count[w] + 1) / (self.n + self.v + 1)) for w in own)
        return (len(own), sum(self.count[w] > 0 for w in own), self.n, base,
                sum(math.log10(self.p(u, w)) for u, w in zip(["<s>"] + own, own)))


def scored(df, model):
    return [(r.doc_id, (r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score)) for r in lm.score(df, model).collect()]


def check(got, rows, plain):
    got, want = (sorted(x, key=lambda r: (str(r[0]), r[1][3], r[1][4])) for x in (got, [(i, plain.row(t)) for i, t in rows]))
    assert [i for i, _ in got] == [i for i, _ in want]
    for (_, g), (_, w) in zip(got, want):
        assert g[:3] == w[:3] and g[3:] == pytest.approx(w[3:], rel=1e-9)


TEXTS = EDGE_TEXTS + [(20 + i, prose(i % 30, 60, 40)) for i in range(60)] + [(90, "The the THE Ünder ünder ÜNDER"), (91, "İ K  x")]


@pytest.mark.parametrize("word_bytes,pair_bytes,held", [(1 << 20, 1 << 20, 1 << 20), (2000, 700, 50)])
def test_against_plain_counts(spark, monkeypatch, word_bytes, pair_bytes, held):
    monkeypatch.setattr(lm, "HELD_ENTRIES", held)
    monkeypatch.setattr(lm, "GROUP_BYTES", 3000)
    train = [r for r in TEXTS if r[0] is None or r[0] % 3]
    model = lm.fit(docs(spark, train), word_bytes=word_bytes, pair_bytes=pair_bytes)
    assert (model.word_shards > 5) == (word_bytes == 2000)
    check(scored(docs(spark, TEXTS), model), TEXTS, Plain([t for _, t in train]))


def test_probabilities_add_up(spark):
    train = [t for _, t in TEXTS]
    scorer, plain = lm.Scorer(lm.fit(docs(spark, TEXTS))), Plain(train)
    vocabulary = sorted(plain.count)
    hashes = np.array([lm.END if w == "</s>" else lm.xxhash.xxh3_64_intdigest(w) for w in vocabulary] + [1, lm.BEGIN], dtype=np.uint64)
    everything = np.arange(len(vocabulary) + 1)
    for context in [*random.Random(1).sample(range(len(vocabulary)), 12), len(vocabulary), len(vocabulary) + 1]:
        p = scorer.probabilities(hashes, everything, np.full(len(everything), context))[1]
        assert p.sum() == pytest.approx(1) and (p > 0).all()


def test_discounts():
    assert lm.discounts([0, 3, 2, 1]).tolist() == [0, 0.5, 1, 1.5] == lm.discounts([9, 1, 90, 9]).tolist()
    y = 100 / 160
    assert lm.discounts([100, 30, 15, 9]) == pytest.approx([0, 1 - 2 * y * 0.3, 2 - 3 * y * 0.5, 3 - 4 * y * 0.6])


def test_packing_keeps_counts():
    keys = np.array([0, 5, 5 << 40, 2**64 - 1], dtype=np.uint64)
    assert [a.tolist() for a in lm._unpack(lm._pack(keys, np.array([1, 2, 3, 2**40])), 2)] == [keys.tolist(), [1, 2, 3, 2**40]]
    assert len(np.unique(lm.mix(np.arange(100_000, dtype=np.uint64)))) == 100_000


@pytest.mark.parametrize("train", [[], [(1, None)], [(1, "a a a")]])
def test_small_training(spark, train):
    rows = [(1, None), (2, "a b"), (None, "c")]
    check(scored(docs(spark, rows), lm.fit(docs(spark, train))), rows, Plain([t for _, t in train]))
    assert lm.score(docs(spark, []), lm.fit(docs(spark, train))).collect() == []


def test_hot_pair(spark):
    rows = [(i, "new york " * (i % 40) + prose(i, 12)) for i in range(200)]
    check(scored(docs(spark, rows), lm.fit(docs(spark, rows).repartition(7), pair_bytes=4000)), rows, Plain([t for _, t in rows]))


def test_query(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()]
    out = zlib.crc32
    got = lm.query(spark, SF_SMALL).collect()
    assert {r.doc_id: r.held_out for r in got} == {i: out(str(i).encode()) % 7 == 2 for i, _ in rows}
    plain = Plain([t for i, t in rows if out(str(i).encode()) % 7 != 2])
    check([(r.doc_id, (r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score)) for r in got], rows, plain)
    held = [r for r in got if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)  # it predicts unseen texts better than single words
