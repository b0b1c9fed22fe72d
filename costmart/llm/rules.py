"""Quality rules: text statistics, and a decision list learned from labelled documents.

The list is learned by sequential covering (grow and prune): a rule is a conjunction of threshold
tests (statistic <= or > value) grown on two thirds of the rows for information gain, then pruned
on the rest while its accuracy there doesn't fall; the rows it covers are removed and the next
rule is grown. The result is ordered and readable, and is emitted as a Spark ``when`` chain.

Words are runs of characters other than the six ASCII white-space characters. Defined cases: a null
text has no words and all statistics zero; ratios of a text without words are zero; without two
classes among the labels the list is empty and every text that passes the base rules is kept.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from costmart.llm.common import labelled_sample, table, utf8

#: The classifier is fitted on at most so many labelled rows, those of least id hash.
MAX_ROWS = 20_000
MAX_RULES = 12
MAX_TESTS = 4
#: Values of a statistic tried as thresholds in one step of growing.
CUTS = 64
#: A rule must be right on this share of the pruning rows it covers, and cover so many rows.
MIN_PRECISION = 0.95
MIN_COVER = 5

_SYMBOLS = b"#*$%&|<>"
_UPPER = bytes(range(65, 91))
_DIGITS = bytes(range(48, 58))
_MARKS = b"!?"
#: ASCII white space, and the bytes that continue a UTF-8 character: what is left is one byte a character.
_NOT_IN_WORDS = b"\x20\x09\x0a\x0b\x0c\x0d" + bytes(range(0x80, 0xC0))
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_digits",
          "n_marks")
SCHEMA = T.StructType([T.StructField(c, T.LongType()) for c in COUNTS])
#: Statistics that rules may test, from the counts. All are shares or means, so that a long text is judged as a
#: short one is: a count, or the share of distinct words, which falls with length, would single out long texts.
RATIOS = {
    "mean_word": lambda c: c("word_chars") / c("n_words"),
    "symbol_ratio": lambda c: c("n_symbols") / c("n_words"),
    "dup_line_ratio": lambda c: c("n_dup_lines") / c("n_lines"),
    "repeat_ratio": lambda c: c("n_repeat_words") / c("n_words"),
    "upper_ratio": lambda c: c("n_upper") / c("word_chars"),
    "digit_ratio": lambda c: c("n_digits") / c("word_chars"),
    "mark_ratio": lambda c: c("n_marks") / c("n_words"),
}


def _without(text: bytes, drop: bytes) -> int:
    return len(text) - len(text.translate(None, drop))


def repeated_words(words: list[bytes], window: int = 3) -> int:
    """Words inside windows that occur twice or more."""
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), dtype=np.int64, count=len(words))
    if len(words) <= window:
        return 0
    # number each run of 2, 3, ... words by its first part's number and its last word
    run = ids
    for k in range(1, window):
        run = np.unique(run[:-1] * np.int64(len(number)) + ids[k:], return_inverse=True)[1]
    twice = (np.bincount(run) > 1)[run]
    covered = np.zeros(len(words), dtype=bool)
    for k in range(window):
        covered[k:len(twice) + k] |= twice
    return int(covered.sum())


def statistics(text: bytes) -> tuple[int, ...]:
    words = text.split()
    chars = len(text.translate(None, _NOT_IN_WORDS))
    lines = Counter(x for x in text.split(b"\n") if x.split())
    return (len(words), chars, _without(text, _SYMBOLS), sum(lines.values()) - len(lines), repeated_words(words),
            sum(lines.values()), _without(text, _UPPER), _without(text, _DIGITS), _without(text, _MARKS))


def statistics_column(text_col: str | Column) -> Column:
    @F.pandas_udf(SCHEMA)
    def stats(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([statistics(t) for t in texts], columns=COUNTS, dtype="int64")

    return stats(utf8(text_col))


def ratio_columns(stats: str) -> list[Column]:
    def ratio(f) -> Column:
        return F.coalesce(f(lambda c: F.col(f"{stats}.{c}").try_cast("double")), F.lit(0.0))

    def safe(name: str, f) -> Column:
        return F.when(F.col(f"{stats}.n_words") > 0, ratio(f)).otherwise(0.0).alias(name)

    return [safe(name, f) for name, f in RATIOS.items()]


# --- the decision list -----------------------------------------------------------------------
@dataclass(frozen=True)
class Test:
    name: str
    above: bool  # statistic > value, else <= value
    value: float

    def __str__(self) -> str:
        return f"{self.name} {'>' if self.above else '<='} {self.value:.6g}"


@dataclass(frozen=True)
class Rule:
    tests: tuple[Test, ...]

    def holds(self, x: dict[str, np.ndarray], n: int) -> np.ndarray:
        out = np.ones(n, dtype=bool)
        for t in self.tests:
            out &= (x[t.name] > t.value) if t.above else (x[t.name] <= t.value)
        return out

    def column(self) -> Column:
        out = F.lit(True)
        for t in self.tests:
            out = out & ((F.col(t.name) > t.value) if t.above else (F.col(t.name) <= t.value))
        return out


def _grow(x: dict[str, np.ndarray], y: np.ndarray) -> Rule:
    tests: list[Test] = []
    inside = np.ones(len(y), dtype=bool)
    while len(tests) < MAX_TESTS and not y[inside].all():
        pos, n = y[inside].sum(), inside.sum()
        best, gain = None, 1e-9
        for name, col in x.items():
            own, right = col[inside], y[inside]
            order = np.argsort(own, kind="stable")
            own, right = own[order], right[order]
            ends = np.flatnonzero(np.diff(own) > 0)  # a cut lies between two different values
            if len(ends) > CUTS:
                ends = ends[np.unique(np.linspace(0, len(ends) - 1, CUTS).astype(int))]
            below_n, below_p = ends + 1, np.cumsum(right)[ends]
            for above, cn, cp in ((False, below_n, below_p), (True, n - below_n, pos - below_p)):
                ok = cp > 0
                g = np.where(ok, cp * (np.log2(np.maximum(cp, 1) / cn) - np.log2(pos / n)), -1)
                if len(g) and g.max() > gain:
                    i = int(g.argmax())
                    gain = float(g[i])
                    best = Test(name, above, float((own[ends[i]] + own[ends[i] + 1]) / 2))
        if best is None:
            break
        tests.append(best)
        inside &= Rule((best,)).holds(x, len(y))
    return Rule(tuple(tests))


def _prune(rule: Rule, x: dict[str, np.ndarray], y: np.ndarray) -> Rule:
    def worth(r: Rule) -> float:
        hit = r.holds(x, len(y))
        return (y[hit].sum() - (~y[hit]).sum()) / max(hit.sum(), 1) if r.tests else -1.0

    best, score = rule, worth(rule)
    for k in range(len(rule.tests) - 1, 0, -1):
        shorter = Rule(rule.tests[:k])
        if worth(shorter) >= score:
            best, score = shorter, worth(shorter)
    return best


def learn(x: dict[str, np.ndarray], bad: np.ndarray) -> list[Rule]:
    """Ordered rules for ``bad`` rows; rows that no rule covers are good."""
    rules: list[Rule] = []
    if bad.all() or not bad.any():
        return rules
    left = np.ones(len(bad), dtype=bool)
    part = np.arange(len(bad)) % 3 < 2
    while len(rules) < MAX_RULES and (bad & left & part).any():
        g, p = left & part, left & ~part
        rule = _prune(_grow({k: v[g] for k, v in x.items()}, bad[g]), {k: v[p] for k, v in x.items()}, bad[p])
        hit = rule.holds(x, len(bad)) & left
        held = hit & ~part if (hit & ~part).any() else hit
        if not rule.tests or hit.sum() < MIN_COVER or bad[held].mean() < MIN_PRECISION:
            break
        rules.append(rule)
        left &= ~hit
    return rules


def rule_column(rules: list[Rule]) -> Column:
    """The number of the first rule that holds, from 1; 0 if none does."""
    out = None
    for i, r in enumerate(rules, 1):
        out = F.when(r.column(), i) if out is None else out.when(r.column(), i)
    return F.lit(0) if out is None else out.otherwise(0)


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
        max_rows: int = MAX_ROWS) -> list[Rule]:
    """Rules for texts labelled 0. Rows with a null id or label, or without a document, are not used;
    an id labelled twice counts with its lower label, and equal rows count once."""
    rated = (labels.select(F.col(id_col).alias("id"), F.col(label_col).alias("label")).dropna()
             .groupBy("id").agg(F.min("label").alias("label")))
    sample = labelled_sample(docs, rated, id_col, text_col, max_rows)
    rows = (sample.select("id", "label", statistics_column("text").alias("s"))
            .select("id", "label", *ratio_columns("s")).toPandas().sort_values(["id", *RATIOS], kind="stable"))
    order = pd.util.hash_array(rows["id"].astype(str).to_numpy(dtype=object)).argsort(kind="stable")
    rows = rows.iloc[order]
    return learn({c: rows[c].to_numpy(dtype=float) for c in RATIOS}, (rows["label"] == 0).to_numpy())


def judge(docs: DataFrame, rules: list[Rule], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Statistics, the base rules' verdict, the first learned rule that holds, and ``kept``."""
    stats = docs.select(F.col(id_col).alias("doc_id"), statistics_column(text_col).alias("s"))
    flat = stats.select("doc_id", "s", *ratio_columns("s")).select(
        "doc_id", *[F.col(f"s.{c}").alias(c) for c in COUNTS[:5]], rule_column(rules).alias("rule"))
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return flat.withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & (F.col("rule") == 0))


def query(spark, sf_dir) -> DataFrame:
    """op5: all documents, rules learned from the quality labels."""
    docs = table(spark, sf_dir, "documents")
    return judge(docs, fit(docs, table(spark, sf_dir, "labels")))
