"""Token counts against the tokenizer itself."""

import random

import pytest
from tokenizers import Tokenizer, models, pre_tokenizers

from costmart.llm import unigram
from tests.llm.rows import EDGE_TEXTS, docs, prose


def tokenizer(vocabulary, fallback):
    t = Tokenizer(models.Unigram(vocabulary, unk_id=0, byte_fallback=fallback))
    t.pre_tokenizer = pre_tokenizers.Metaspace(prepend_scheme="always", split=True)
    return t


def test_public_vocabulary(spark):
    vocabulary = unigram.load_vocabulary(unigram.vocabulary_path())
    t = tokenizer(vocabulary, True)
    texts = EDGE_TEXTS + [(100 + i, x) for i, x in enumerate(
        ["  two  spaces ", "▁marked▁text", "日本語 テスト 😀😀", "a\tb\n\nc", "<s> <0x41> </s>", "éx", "a" * 60, "x" * 5000, "\x00\x01", "ⅷ ¼ ½"])]
    texts += [(200 + i, prose(i, 50)) for i in range(20)]
    got = sorted((str(r.doc_id), r.n_tokens, r.n_characters) for r in unigram.token_counts(docs(spark, texts)).collect())
    want = sorted((str(i), len(t.encode(x or "", add_special_tokens=False).ids), len(x or "")) for i, x in texts)
    assert got == want


@pytest.mark.parametrize("fallback", [False, True])
def test_ties_and_unknown_characters(fallback):
    rng = random.Random(int(fallback))
    for trial in range(12):
        pieces = {"".join(rng.choice("ab▁") for _ in range(rng.randint(1, 4))) for _ in range(9)} | {"a"}
        vocabulary = [("<unk>", 0.0)] + [(p, -float(rng.randint(1, 4))) for p in sorted(pieces)]
        if fallback:
            vocabulary += [(f"<0x{b:02X}>", -20.0) for b in range(256)]
        t, counter = tokenizer(vocabulary, fallback), unigram.Counter(vocabulary)
        for _ in range(250):
            text = "".join(rng.choice("aabbb cé😀") for _ in range(rng.randint(0, 14)))
            assert counter.count(text) == len(t.encode(text, add_special_tokens=False).ids), (trial, text)


def test_remembered_pieces_are_bounded(monkeypatch):
    monkeypatch.setattr(unigram, "CACHED_PIECES", 5)
    vocabulary = [("<unk>", 0.0), ("▁", -1.0), ("a", -1.0), ("b", -1.0), ("ab", -1.0)]
    counter = unigram.Counter(vocabulary)
    text = " ".join("ab" * i for i in range(40)) + " " + "ab" * 200
    first = counter.count(text)
    assert len(counter.known) <= 5 and counter.count(text) == first == len(tokenizer(vocabulary, False).encode(text).ids)


def test_empty_table(spark):
    assert unigram.token_counts(docs(spark, [])).collect() == []
