"""Packing: best fit against brute force, conflicts, whole results."""

import random

from pyspark.sql import functions as F

from costmart.llm import packing
from tests.llm.rows import EDGE_TEXTS, docs, prose


def brute(lengths, sources, clusters, capacity):
    """The residual of the bin that each piece should go into: the least that fits and doesn't conflict."""
    bins, fits = [], []
    for n, s, c in zip(lengths, sources, clusters):
        ok = [b for b in bins if b[0] >= n and (s is None or s not in b[1]) and (c is None or c not in b[2])]
        fits.append(min((b[0] for b in ok), default=None))
        yield fits[-1], bins


def test_each_piece_goes_into_the_tightest_compatible_bin():
    rng = random.Random(2)
    for trial in range(60):
        cap = rng.choice([10, 37, 64])
        n = 120
        lengths = sorted((rng.randint(1, cap) for _ in range(n)), reverse=True)
        sources = [rng.choice(["hot", "hot", "a", "b", "c", None]) for _ in range(n)]
        clusters = [rng.choice([1, 2, 3, 4, 5, 6, 7, 8, None]) for _ in range(n)]
        bins, at = packing.pack_pieces(lengths, sources, clusters, cap)
        state: dict[int, list] = {}
        for length, s, c, b, offset in zip(lengths, sources, clusters, bins, at):
            ok = [r for r, ss, cc in state.values() if r >= length and (s is None or s not in ss) and (c is None or c not in cc)]
            if b in state:
                residual, ss, cc = state[b]
                assert residual == min(ok) and (s is None or s not in ss) and (c is None or c not in cc), trial
                assert offset == cap - residual
                state[b] = [residual - length, ss | {s}, cc | {c}]
            else:
                assert not ok and offset == 0
                state[b] = [cap - length, {s}, {c}]


def test_bins_of_a_table(spark):
    texts = EDGE_TEXTS + [(100 + i, prose(i, 40 + i * 7 % 400)) for i in range(300)] + [(900 + i, prose(3, 61)) for i in range(40)]
    table = docs(spark, texts, source=lambda i: None if i is None or i % 11 == 0 else f"s{0 if i % 3 == 0 else i % 9}")
    out = packing.pack(table, capacity=512, shard_rows=100).collect()
    lengths = {}
    for i, t in texts:
        n = len([w for w in (t or "").replace("\n", " ").replace("\t", " ").split(" ") if w]) + 1
        lengths.setdefault(i, []).append(n)
    got = {}
    for r in out:
        got[r.id] = got.get(r.id, 0) + r.piece_length
    assert got == {i: sum(v) for i, v in lengths.items()}  # no row is lost, every piece is whole
    source = {r.doc_id: r.source for r in table.collect()}
    text = dict(texts)
    bins = {}
    for r in out:
        bins.setdefault((r.shard, r.bin), []).append(r)
    assert len({s for s, _ in bins}) > 1
    for rows in bins.values():
        assert sum(r.piece_length for r in rows) <= 512
        spans = sorted((r.bin_offset, r.bin_offset + r.piece_length) for r in rows)
        assert all(a[1] == b[0] for a, b in zip(spans, spans[1:])) and spans[0][0] == 0
        named = [source[r.id] for r in rows if source[r.id] is not None]
        assert len(named) == len(set(named))
        copies = [text[r.id] for r in rows if text[r.id] is not None]
        assert len(copies) == len(set(copies))


def test_empty_and_custom_columns(spark):
    assert packing.pack(docs(spark, [])).collect() == []
    table = spark.createDataFrame([("a", 5), ("b", 3), (None, 3)], "name string, tokens int")
    out = packing.pack(table, "name", F.col("tokens"), F.lit(None), F.lit(None), capacity=8).collect()
    assert {r.id: (r.bin, r.bin_offset) for r in out}["a"] == (0, 0) and len({(r.shard, r.bin) for r in out}) == 2
