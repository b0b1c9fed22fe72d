"""Token counts of a unigram model, without making the tokens.

The text is cut as the tokenizer cuts it: spaces become U+2581, one is put before a text that has
none in front, and a piece starts at each. A piece's count comes from a Viterbi pass that carries
only the best score and the number of tokens (closed ones, and those of a run of unknown characters that is still open): an Aho-Corasick automaton lists every vocabulary entry
that ends at a position, in one pass over the piece. The tie rules are the tokenizer's: a later
candidate replaces an earlier one only with a higher score, and candidates come in order of their
start, so of equal scores the longest last token wins; a character that is no entry by itself may be
unknown at the lowest score less 10; unknown characters count as their bytes where the vocabulary
has byte entries for them, else a run of them is one token. Sums are doubles added from the left.

Counts of short pieces are kept per Python worker, up to a number, so that a frequent word is counted
once; that changes the cost only.

Defined cases: a null or empty text has no tokens. Every row is counted by itself and whole.
"""

from __future__ import annotations

from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from costmart.llm.common import table

SPACE = "▁"
UNKNOWN_PENALTY = 10.0
#: Pieces of at most so many characters are remembered, and at most so many of them.
CACHED_CHARS, CACHED_PIECES = 40, 400_000


def vocabulary_path(name: str = "piece_bpe_32k.model") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def load_vocabulary(path: str) -> list[tuple[str, float]]:
    """(piece, score) of a sentencepiece file, by id, as a unigram vocabulary."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return [(model.id_to_piece(i), model.get_score(i)) for i in range(model.get_piece_size())]


class Counter:
    """Counts the tokens of a text; made once per Python worker."""

    def __init__(self, vocabulary: list[tuple[str, float]]):
        import ahocorasick

        self.automaton = ahocorasick.Automaton()
        for piece, score in vocabulary:
            if piece:
                self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.single = {p for p, _ in vocabulary if len(p) == 1}
        self.byte_entries = {p for p, _ in vocabulary if len(p) == 6 and p.startswith("<0x")}
        self.unknown = min((s for _, s in vocabulary), default=0.0) - UNKNOWN_PENALTY
        self.known: dict[str, int] = {}

    def _bytes(self, char: str) -> int:
        """Tokens of an unknown character by byte entries; 0 if there are none for it."""
        encoded = char.encode("utf-8", "surrogatepass")
        return len(encoded) if all(f"<0x{b:02X}>" in self.byte_entries for b in encoded) else 0

    def viterbi(self, piece: str) -> int:
        """Each position carries the best score, the tokens closed on the best way there, and what its open run of
        unknown characters will count: 0 none, -1 one token, else its bytes. No way is walked back."""
        n, single = len(piece), self.single
        score: list[float | None] = [0.0] + [None] * n
        closed, run = [0] * (n + 1), [0] * (n + 1)
        open_to, start, at = 0, 0, 0  # positions up to open_to have their unknown candidate; the best start for at

        def admit_unknown(upto: int) -> None:
            for e in range(open_to + 1, upto + 1):
                if piece[e - 1] not in single:
                    s = score[e - 1] + self.unknown
                    if score[e] is None or s > score[e]:
                        count, before = self._bytes(piece[e - 1]), run[e - 1]
                        score[e], closed[e] = s, closed[e - 1]
                        run[e] = before + count if count and before >= 0 else -1

        for last, (length, value) in self.automaton.iter(piece):
            e = last + 1
            if e - 1 > open_to:  # all candidates that end before e have come
                admit_unknown(e - 1)
                open_to = e - 1
            b = e - length
            s = score[b] + value
            if score[e] is None or s > score[e] or (s == score[e] and at == e and b < start):
                score[e], closed[e], run[e] = s, closed[b] + abs(run[b]) + 1, 0
                at, start = e, b
        admit_unknown(n)
        return closed[n] + abs(run[n])

    def count(self, text: str) -> int:
        if not text:
            return 0
        marked = text.replace(" ", SPACE)
        if not marked.startswith(SPACE):
            marked = SPACE + marked
        total, known = 0, self.known
        for part in marked.split(SPACE)[1:]:
            n = known.get(part)
            if n is None:
                n = self.viterbi(SPACE + part)
                if len(part) <= CACHED_CHARS:
                    if len(known) >= CACHED_PIECES:
                        known.clear()
                    known[part] = n
            total += n
        return total


@lru_cache(maxsize=2)
def _counter(path: str) -> Counter:
    return Counter(load_vocabulary(path))


def count_column(text_col: str | Column, vocabulary: str | None = None) -> Column:
    path = vocabulary or vocabulary_path()

    @F.pandas_udf(T.LongType())
    def counts(texts: pd.Series) -> pd.Series:
        count = _counter(path).count
        return pd.Series([count(t) for t in texts], dtype="int64")

    col = F.col(text_col) if isinstance(text_col, str) else text_col
    return counts(F.coalesce(col, F.lit("")))


def token_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str | None = None) -> DataFrame:
    return docs.select(F.col(id_col).alias("doc_id"), count_column(text_col, vocabulary).alias("n_tokens"),
                       F.coalesce(F.char_length(text_col), F.lit(0)).cast("long").alias("n_characters"))


def query(spark, sf_dir) -> DataFrame:
    """op8: all documents."""
    return token_counts(table(spark, sf_dir, "documents"))
