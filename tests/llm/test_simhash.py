"""SimHash: fingerprints against a plain computation, links and components against brute force."""

import random
import re

import numpy as np
import pytest
import xxhash

from costmart.llm import simhash
from tests.llm.rows import EDGE_TEXTS, docs, prose


def plain(text, k=3):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not w:
        return 0
    shingles = [w[i:i + k] for i in range(len(w) - k + 1)] or [w]
    h = [xxhash.xxh64_intdigest(" ".join(s).encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def reached(nodes, linked):
    """Least id reachable, over (id, fingerprint) rows; ids may be null and may repeat."""
    group = list(range(len(nodes)))
    def find(i):
        while group[i] != i:
            i = group[i]
        return i
    for i, (a, fa) in enumerate(nodes):
        for j, (b, fb) in enumerate(nodes[:i]):
            if linked(fa, fb) or (a is not None and a == b):
                group[find(i)] = find(j)
    least = {}
    for i, (a, _) in enumerate(nodes):
        if a is not None:
            least[find(i)] = min(least.get(find(i), a), a)
    return [least.get(find(i)) for i in range(len(nodes))]


def corpus():
    rng = random.Random(1)
    texts = list(EDGE_TEXTS) + [(None, prose(2, 40)), (50, prose(2, 40)), (51, "SAME ROW " * 25), (7, prose(77, 50))]
    for n in range(60):
        words = prose(n % 15, 400).split()
        for _ in range(rng.choice([0, 1, 2, 4])):
            words[rng.randrange(400)] = "edit%d" % rng.randrange(9)
        texts.append((100 + n, " ".join(words)))
    return texts


@pytest.mark.parametrize("hot", [simhash.HOT_BUCKET, 1])
def test_equals_brute_force(spark, hot):
    texts = corpus()
    out = simhash.near_duplicates(docs(spark, texts), hot_bucket=hot).collect()
    prints = [plain(t) for _, t in texts]
    want = reached([(i, p) for (i, _), p in zip(texts, prints)], lambda a, b: bin(a ^ b).count("1") <= 2)
    got = sorted([(r.id, r.fp % (1 << 64), r.component_id) for r in out], key=str)
    assert got == sorted([(i, p, c) for (i, _), p, c in zip(texts, prints, want)], key=str)
    assert len({c for c in want}) < len(texts) - 20


@pytest.mark.parametrize("bits,hot", [(0, 512), (1, 512), (2, 512), (2, 3), (3, 512), (3, 3), (4, 2)])
def test_no_link_is_lost(spark, bits, hot):
    """Dense groups of random fingerprints: what is connected stays connected."""
    rng = random.Random(bits)
    centers = [rng.getrandbits(64) for _ in range(6)]
    prints = set()
    for _ in range(260):
        f = rng.choice(centers)
        for _ in range(rng.randint(0, 5)):
            f ^= 1 << rng.choice([rng.randrange(64), rng.randrange(8)])
        prints.add(f)
    prints = sorted(prints)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    table = spark.createDataFrame([(s,) for s in signed], "fp long")
    pairs = [(r.a, r.b) for r in simhash.links(table, bits, hot).collect()]
    assert all(a < b and bin((a ^ b) % (1 << 64)).count("1") <= bits for a, b in pairs)
    want = reached([(i, p) for i, p in enumerate(prints)], lambda a, b: bin(a ^ b).count("1") <= bits)
    at = {s: i for i, s in enumerate(signed)}
    joined = {(min(at[a], at[b]), max(at[a], at[b])) for a, b in pairs}
    got = reached([(i, i) for i in range(len(prints))], lambda a, b: (min(a, b), max(a, b)) in joined)
    assert got == want


def test_thresholds_cover_every_distance():
    rng = np.random.default_rng(2)
    sample = rng.integers(0, 1 << 63, 500).astype(np.uint64)
    sample[:250] &= np.uint64((1 << 20) - 1)  # skewed bits
    bits = np.unpackbits(sample.view(np.uint8), bitorder="little").reshape(-1, 64).astype(float)
    for max_bits in range(5):
        for m in (2, 3, 4):
            parts = simhash.correlated_parts(bits.T @ bits, 500, m)
            assert sorted(b for p in parts for b in p) == list(range(64))
            cost, thresholds = simhash.allocate(parts, sample, 100_000, max_bits)
            assert sum(t + 1 for t in thresholds) == max_bits + 1 and cost > 0


def test_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(60)] + [(100, x) for x in range(101, 180)] + [(200, 201), (201, 200), (202, 202)]
    out = {r.node: r.root for r in simhash.components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert out == {**{i: 0 for i in range(61)}, **{i: 100 for i in range(100, 180)}, 200: 200, 201: 200}


def test_one_of_each_group_stays(spark):
    """By fingerprints alone: each text counts as a document of its own."""
    texts = corpus()
    table = docs(spark, texts)
    kept = simhash.keep_one(table)
    assert kept.columns == table.columns
    number = {t: n for n, t in enumerate(dict.fromkeys(t for _, t in texts))}
    alone = docs(spark, [(n, t) for t, n in number.items()])
    component = {r.id: r.component_id for r in simhash.near_duplicates(alone).collect()}
    rows = kept.collect()
    assert sorted(component[number[r.text]] for r in rows) == sorted(set(component.values()))
    for r in rows:
        ids = [i for i, t in texts if component[number[t]] == component[number[r.text]] and i is not None]
        assert r.doc_id == min(ids, default=None)


def test_empty_table(spark):
    assert simhash.near_duplicates(docs(spark, [])).collect() == []
    assert simhash.keep_one(docs(spark, [])).collect() == []


def test_keep_one_judges_texts(spark):
    """Unlike texts of one id stay; of equal texts of null ids, and of rows that repeat, one does."""
    texts = [(1, prose(1, 40)), (1, prose(2, 40)), (None, prose(3, 40)), (None, prose(3, 40)), (5, prose(1, 40)), (6, prose(4, 40)),
             (6, prose(4, 40)), (7, None), (None, ""), (8, prose(5, 40)), (9, prose(5, 40)), (2, prose(2, 40))]
    kept = simhash.keep_one(docs(spark, texts).withColumnRenamed("rows", "k_id"))
    got = sorted(((str(r.doc_id), r.text) for r in kept.collect()), key=str)
    want = [(1, prose(1, 40)), (1, prose(2, 40)), (None, prose(3, 40)), (6, prose(4, 40)), (7, None), (8, prose(5, 40))]
    assert got == sorted(((str(i), t) for i, t in want), key=str)


def test_keep_one_against_components(spark):
    texts = [(i % 37 if i % 11 else None, prose(i % 23, 30) + (" tail" if i % 5 == 0 else "")) for i in range(120)]
    prints = {r.text: r.fp for r in docs(spark, texts).select("text", simhash.fingerprint_column("text", 3).alias("fp")).collect()}
    group = {t: {u for u in prints if bin((prints[t] ^ prints[u]) & (2**64 - 1)).count("1") <= 2} for t in prints}
    for _ in prints:
        group = {t: set().union(*(group[u] for u in g)) for t, g in group.items()}
    kept = simhash.keep_one(docs(spark, texts)).collect()
    assert sorted(min(group[r.text]) for r in kept) == sorted({min(g) for g in group.values()})
    for r in kept:
        ids = [i for i, t in texts if t in group[r.text] and i is not None]
        assert r.doc_id == (min(ids) if ids else None)
