"""Small tables for the operators' tests: nulls, empty and long texts, ties, repeated rows, names that clash."""

from __future__ import annotations

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long, rows binary, s string, id string, fp string"


def docs(spark, texts, source=None):
    """A documents table with further columns named like the operators' own; ``texts``: (doc_id, text)."""
    rows = [(i, t, "en", source(i) if source else "src0", None if t is None else len(t), b"x", "clash", "clash", None)
            for i, t in texts]
    return spark.createDataFrame(rows, DOCS)


def prose(seed: int, n: int, vocabulary: int = 400) -> str:
    rng = random.Random(seed)
    return " ".join(rng.choice("bcdfglmnprst") + rng.choice("aeiou") + str(rng.randrange(vocabulary)) for _ in range(n))


EDGE_TEXTS = [(None, "null id " * 30), (1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "Ein Wört 漢字   x"),
              (6, "same row " * 25), (6, "same row " * 25), (7, prose(1, 3000))]
