"""rANS files: exact round trips, partial decoding, damage, the tokenizer's own ids."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyarrow import fs
from tokenizers import Tokenizer

from costmart.llm import rans
from costmart.session import local_path, scratch_path
from tests.llm.rows import EDGE_TEXTS, docs, prose

TOKENIZER = Tokenizer.from_file(rans.tokenizer_path())


def odd_texts():
    rng = random.Random(4)
    parts = ["it's", "We'LL", "don't.", "<|endoftext|>", "x<|startoftext|>.", "<|ENDOFTEXT|>", "á", "́", " ́b", "é", "É", "ß", "İ", "ﬁ", "漢字",
             "😀", "12ab", "$$$", "word$$$", "%%%.", "\xa0", " ", "\x85", "\x1c", "\n", "\t", " ", "...", "'s", "'", "x'", "ab'S,", "​", "№", "²³"]
    return ["".join(rng.choice(parts) for _ in range(rng.randint(1, 20))) for _ in range(400)]


def ids_of(encoder, texts):
    out = []
    batches = pa.Table.from_arrays([pa.array(texts, pa.string())], ["t"]).to_batches(max_chunksize=7)
    for group in rans.groups(iter(batches), 0, 500):
        assert group.num_rows == 1 or sum(len(t.encode()) for t in group.column(0).to_pylist()) <= 500
        out += [np.frombuffer(x, "<u2").tolist() for x in encoder.encode(group.column(0), 2).to_pylist()]
    return out


def test_word_by_word_equals_whole_texts():
    texts = odd_texts() + [prose(i, 60) for i in range(10)] + ["", " ", "\n a "]
    for text, ids in zip(texts, ids_of(rans.Encoder(rans.tokenizer_path()), texts), strict=True):
        assert ids == TOKENIZER.encode(text, add_special_tokens=False).ids + [2], text


def test_remembered_cores_are_bounded(monkeypatch):
    monkeypatch.setattr(rans, "CACHED_CORES", 10)
    encoder = rans.Encoder(rans.tokenizer_path())
    texts = [prose(i, 7) + " " + "long" * 30 for i in range(20)]
    for _ in range(2):
        for t in texts:
            assert ids_of(encoder, [t])[0] == TOKENIZER.encode(t).ids + [2]
            assert len(encoder.known) <= 10


@pytest.mark.parametrize("n", [0, 1, 2, 63, 64, 65, 5000, 300_000])
def test_block_round_trip(n):
    rng = np.random.default_rng(n)
    for ids in (np.minimum(rng.zipf(1.2, n), 49407), rng.integers(0, 49408, n), np.full(n, 7)):
        ids = ids.astype("<u2")
        counts = np.bincount(ids, minlength=10)
        table = rans.Table.load(rans.Table(rans.quantise(counts)).dump())
        data = rans.encode_block(ids, table)
        assert (rans.decode_block(data, table) == ids).all()
        p = counts[counts > 0] / max(n, 1)
        entropy = -(p * np.log2(p)).sum() * n / 8
        if n > 100_000:
            assert len(data) < 1.08 * entropy + 40_000


def test_frequencies_sum_to_the_table():
    rng = np.random.default_rng(1)
    for n in (1, 2, 1000, 49408):
        counts = np.zeros(n, dtype=np.int64)
        seen = rng.choice(n, max(1, n // 2), replace=False)
        counts[seen] = rng.zipf(1.1, len(seen)).clip(1, 10**12)
        freq = rans.quantise(counts)
        assert freq.sum() == 1 << rans.TABLE_BITS and ((freq > 0) == (counts > 0)).all()
    with pytest.raises(ValueError):
        rans.quantise(np.ones(9, dtype=np.int64), bits=3)


def expected(texts):
    out, start = [], 0
    order = sorted(range(len(texts)), key=lambda n: (texts[n][0] is not None, texts[n][0] or 0))
    for n in order:
        ids = TOKENIZER.encode(texts[n][1] or "", add_special_tokens=False).ids + [2]
        out.append((texts[n][0], start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()), ids))
        start += len(ids)
    return out


def test_files_round_trip(spark):
    texts = EDGE_TEXTS + [(1000 - i, t) for i, t in enumerate(odd_texts()[:100])] + [(-5, prose(3, 900))]
    folder = scratch_path(spark, "rans-test")
    tokens = rans.tokenize(docs(spark, texts).repartition(3))
    index = rans.write_files(tokens, folder, partition_ids=900, file_ids=500, block_ids=300)
    assert index.count() > 4
    got = sorted([(r.start, r.doc_id, r.n_tokens, r.ids_crc32, np.frombuffer(r.ids, "<u4").tolist())
                  for r in rans.read_documents(index, folder).collect()])
    want = expected(texts)
    assert [g[0] for g in got] == [w[1] for w in want]
    assert [(g[1], *g[2:]) for g in got if g[1] != 6] == [(w[0], *w[2:]) for w in want if w[0] != 6]
    # any stretch of ids, from the blocks that hold it
    path = local_path(folder)
    first = index.orderBy("part", "file_no").first()
    table = rans._table(folder)
    reader = rans.Reader(fs.LocalFileSystem().open_input_file(f"{path}/{first.file}"), table)
    ids = np.concatenate([reader.block(i) for i in range(len(reader.blocks))])
    for a, n in ((0, 1), (299, 2), (100, 350), (0, len(ids)), (len(ids) - 1, 1), (3, 0)):
        assert (reader.slice(a, n) == ids[a:a + n]).all()


def test_damage_is_noticed(spark, tmp_path):
    ids = np.arange(2000, dtype="<u2") % 50
    table = rans.Table(rans.quantise(np.bincount(ids)))
    path = str(tmp_path / "x.rans")
    local = fs.LocalFileSystem()
    writer = rans.Writer(local.open_output_stream(path), table, 500)
    writer.add(1, ids)
    writer.close()
    data = bytearray(open(path, "rb").read())
    data[len(rans.MAGIC) + 700] ^= 1
    open(path, "wb").write(bytes(data))
    with pytest.raises(ValueError):
        list(rans.Reader(local.open_input_file(path), table).documents())
    open(path, "wb").write(bytes(data[:-3]))
    with pytest.raises(Exception):
        rans.Reader(local.open_input_file(path), table)


def test_string_ids_and_empty_table(spark):
    folder = scratch_path(spark, "rans-test")
    table = spark.createDataFrame([("b", "x"), ("a", None), (None, "y z")], "name string, body string")
    index = rans.write_files(rans.tokenize(table, "name", "body"), folder)
    assert [(r.doc_id, r.start, r.n_tokens) for r in rans.read_documents(index, folder, "string").orderBy("start").collect()] == [
        (None, 0, 3), ("a", 3, 1), ("b", 4, 2)]
    folder = scratch_path(spark, "rans-test")
    index = rans.write_files(rans.tokenize(docs(spark, [])), folder)
    assert rans.read_documents(index, folder).collect() == []


def test_letters_with_marks_before_punctuation():
    """The tokenizer composes before it lowers: no ASCII letter with a mark behind it may be lowered on the way."""
    import string

    from tokenizers import Tokenizer

    path = rans.tokenizer_path()
    words = [f"{c}{chr(m)}{tail}" for c in string.ascii_letters for m in range(0x300, 0x370) for tail in ("ab,", "b1.", "Q)", ";")]
    encoder, plain = rans.Encoder(path), Tokenizer.from_file(path)
    got = encoder._ids([w.encode() for w in words])
    want = [e.ids for e in plain.encode_batch(words, add_special_tokens=False)]
    assert [np.frombuffer(g, "<u2").tolist() for g in got] == want
