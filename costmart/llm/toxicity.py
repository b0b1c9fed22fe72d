"""Toxicity severity by cumulative-link ordinal regression on sparse word features.

P(grade > k | x) = sigmoid(w.x - theta_k) with theta_0 < theta_1 < ...: one weight vector is shared by
all thresholds. The output is the expected severity, the sum over k of P(grade > k).

* Words are runs of ASCII letters and non-ASCII characters, ASCII capitals made small. A word's
  value in a text is 1 + ln(occurrences), or 0.
* Features are chosen on the labelled sample by the G statistic of a word's document frequency among
  graded (> 0) against ungraded texts, ``min_g`` at least, and at most ``max_features`` of them.
* Where labels only say toxic or not (grade 1 or 0), ``levels`` splits the toxic texts into grades of
  equal size by how many indicative words (features more frequent in toxic texts) each has.
* The fit is bounded: ``max_rows`` labelled rows (those of least id hash) are used, which is the one
  bound of this operator; scoring covers all rows and whole texts.

Defined cases: null or empty text has no features and gets the severity of the intercept; labelled
rows of a null id, of a null grade, or of an id that has no document are not used; an id labelled
more than once counts with its highest grade; without two grades among the labels no text is toxic
(severity 0). Repeated rows are scored alike, each by itself.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from costmart.llm.common import LOWER_ASCII, free_name, labelled_sample, stored, table, utf8

MAX_ROWS = 20_000
MAX_FEATURES = 512
MIN_G = 30.0
MIN_DOCS = 5
L2 = 1.0
#: Grades above 0 that the query and the pipeline make of the label ``toxic``.
LEVELS = 3
#: Texts with P(grade > 0) of this or more are toxic.
TOXIC_FROM = 0.5

_LETTERS = bytes(b if b >= 0x80 or 97 <= b <= 122 else 32 for b in LOWER_ASCII)


def words(text: bytes) -> list[bytes]:
    return text.translate(_LETTERS).split()


@dataclass
class Model:
    vocabulary: dict[bytes, int] = field(default_factory=dict)
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0))
    thresholds: np.ndarray = field(default_factory=lambda: np.zeros(0))
    #: The grade above each threshold: grades that no label has are left out.
    grades: tuple[int, ...] = ()

    def score(self, text: bytes) -> float:
        found = Counter(w for w in words(text) if w in self.vocabulary)
        return float(sum(self.weights[self.vocabulary[w]] * (1 + np.log(n)) for w, n in found.items()))

    def above(self, scores: np.ndarray) -> np.ndarray:
        """P(grade > each threshold), a column per threshold."""
        return 1 / (1 + np.exp(-np.clip(scores[:, None] - self.thresholds[None, :], -40, 40)))


# --- fitting ---------------------------------------------------------------------------------
def _row_ids(indptr: np.ndarray) -> np.ndarray:
    return np.repeat(np.arange(len(indptr) - 1), np.diff(indptr))


def fit_cumulative_link(indptr, indices, values, grades, n_features: int, l2: float = L2,
                        steps: int = 400) -> tuple[np.ndarray, np.ndarray]:
    """Weights and ordered thresholds of most likelihood under an L2 penalty on the weights, by
    gradient steps with momentum and restarts; grades are 0 .. K-1, all of them present."""
    rows, k = _row_ids(np.asarray(indptr)), int(grades.max())
    n = len(grades)
    share = np.array([(grades > j).mean() for j in range(k)])
    theta = -np.log(share / (1 - share))
    w = np.zeros(n_features)
    scale = np.bincount(indices, weights=values * values, minlength=n_features)
    lipschitz_w = 0.25 * scale.max(initial=1.0) * np.diff(indptr).max(initial=1) ** 0.5 + l2
    sign = np.where(np.arange(k)[None, :] < grades[:, None], 1.0, 0.0)  # grade > threshold j
    near = (np.arange(k)[None, :] == grades[:, None]) | (np.arange(k)[None, :] == grades[:, None] - 1)

    def value_and_gradient(w, theta):
        s = np.bincount(rows, weights=values * w[indices], minlength=n)
        p = 1 / (1 + np.exp(-np.clip(s[:, None] - theta[None, :], -40, 40)))
        full = np.hstack([np.ones((n, 1)), p, np.zeros((n, 1))])
        at = np.clip(full[np.arange(n), grades] - full[np.arange(n), grades + 1], 1e-12, None)
        d = p * (1 - p) * near * (2 * sign - 1) / at[:, None]  # of log-likelihood by (s - theta_j)
        loss = -np.log(at).sum() + l2 / 2 * w @ w
        gw = -np.bincount(indices, weights=values * d.sum(axis=1)[rows], minlength=n_features) + l2 * w
        return loss, gw, d.sum(axis=0)

    step, mw, mt, t = 1.0 / lipschitz_w, w, theta, 1.0
    loss, _, _ = value_and_gradient(w, theta)
    for _ in range(steps):
        here, gw, gt = value_and_gradient(mw, mt)
        while True:
            nw, nt = mw - step * gw, np.sort(mt - step * gt)
            new, _, _ = value_and_gradient(nw, nt)
            if new <= here - 0.25 * step * (gw @ gw + gt @ gt) or step < 1e-9:
                break
            step /= 2
        if new > loss:  # restart the momentum
            mw, mt, t = w, theta, 1.0
            step *= 1.1
            continue
        t2 = (1 + (1 + 4 * t * t) ** 0.5) / 2
        mw, mt = nw + (t - 1) / t2 * (nw - w), np.sort(nt + (t - 1) / t2 * (nt - theta))
        done = loss - new < 1e-7 * abs(loss) and t > 5
        w, theta, loss, t = nw, nt, new, t2
        step *= 1.2
        if done:
            break
    return w, theta


def _distinct_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word, 1 if graded above 0): a row per distinct word of each text."""
    for b in batches:
        for grade, text in zip(b.column(0).to_pylist(), b.column(1)):
            own = pa.array(set(words(text.as_py())), pa.binary())
            yield pa.record_batch([own, pa.array(np.full(len(own), int(grade > 0)))], names=["word", "bad"])


def fit(docs: DataFrame, labels: DataFrame, grade: Column, id_col: str = "doc_id", text_col: str = "text",
        levels: int = 1, max_rows: int = MAX_ROWS, max_features: int = MAX_FEATURES, min_g: float = MIN_G) -> Model:
    """Fit on at most ``max_rows`` labelled documents (equal rows count once); ``grade`` is a column of ``labels``. With
    ``levels`` over 1, its grade 1 is split into so many by the number of indicative words."""
    rated = (labels.select(F.col(id_col).alias("id"), grade.cast("int").alias("grade")).dropna()
             .groupBy("id").agg(F.max("grade").alias("grade")))
    sample = labelled_sample(docs, rated, id_col, text_col, max_rows)
    sample = stored(sample.select("grade", utf8("text").alias("text")), "toxicity-sample")
    totals = {bool(r["bad"]): r["n"] for r in
              sample.groupBy((F.col("grade") > 0).alias("bad")).agg(F.count("*").alias("n")).collect()}
    if len(totals) < 2:
        return Model()
    a, b = float(totals[True]), float(totals[False])
    per_word = (sample.mapInArrow(_distinct_words, "word binary, bad long").groupBy("word").agg(F.sum("bad").cast("double").alias("x"), F.sum(1 - F.col("bad")).cast("double").alias("y"))
                .where(F.col("x") + F.col("y") >= MIN_DOCS))

    def term(seen: Column, expected: Column) -> Column:
        return F.when(seen > 0, seen * F.ln(seen / expected)).otherwise(0.0)

    x, y = F.col("x"), F.col("y")
    rate = (x + y) / (a + b)
    g = 2 * (term(x, rate * a) + term(y, rate * b) + term(a - x, (1 - rate) * a) + term(b - y, (1 - rate) * b))
    top = (per_word.where(rate < 1).select("word", g.alias("g"), (x / a > y / b).alias("indicative"))
           .where(F.col("g") >= min_g).orderBy(F.desc("g"), "word").limit(max_features).collect())
    indicative = {i for i, r in enumerate(top) if r["indicative"]}
    vocabulary = {bytes(r["word"]): i for i, r in enumerate(top)}

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for grade, text in zip(b.column(0).to_pylist(), b.column(1)):
                own = Counter(vocabulary[w] for w in words(text.as_py()) if w in vocabulary)
                yield pa.record_batch([pa.array([grade], pa.int32()), pa.array([list(own)], pa.list_(pa.int32())),
                                       pa.array([list(own.values())], pa.list_(pa.int32()))], names=["grade", "words", "times"])

    slim = sample.mapInArrow(found, "grade int, words array<int>, times array<int>").collect()  # max_rows rows
    grades = np.array([r["grade"] for r in slim])
    if levels > 1:
        hits = np.array([sum(n for w, n in zip(r["words"], r["times"]) if w in indicative) for r in slim])
        cuts = np.quantile(hits[grades == 1], np.arange(1, levels) / levels) if (grades == 1).any() else []
        grades = np.where(grades == 1, 1 + np.searchsorted(cuts, hits, side="left"), np.where(grades > 1, grades + levels - 1, 0))
    present = sorted(set(grades.tolist()))
    indptr = np.cumsum([0, *(len(r["words"]) for r in slim)])
    indices = np.array([w for r in slim for w in r["words"]], dtype=np.int64)
    values = 1 + np.log(np.array([n for r in slim for n in r["times"]], dtype=float))
    w, theta = fit_cumulative_link(indptr, indices, values, np.searchsorted(present, grades), len(vocabulary))
    return Model(vocabulary, w, theta, tuple(present))


# --- scoring ---------------------------------------------------------------------------------
def severity_column(model: Model, text_col: str | Column) -> Column:
    """struct(severity double, p_toxic double, grade int)."""
    schema = T.StructType([T.StructField("severity", T.DoubleType()), T.StructField("p_toxic", T.DoubleType()),
                           T.StructField("grade", T.IntegerType())])

    @F.pandas_udf(schema)
    def severity(texts: pd.Series) -> pd.DataFrame:
        if not model.grades:
            return pd.DataFrame({"severity": np.zeros(len(texts)), "p_toxic": 0.0, "grade": 0})
        above = model.above(np.array([model.score(t) for t in texts], dtype=float))
        gaps = np.diff(model.grades)
        at = np.hstack([np.ones((len(above), 1)), above]) - np.hstack([above, np.zeros((len(above), 1))])
        return pd.DataFrame({"severity": model.grades[0] + above @ gaps, "p_toxic": above[:, 0],
                             "grade": np.array(model.grades)[at.argmax(axis=1)].astype(np.int32)})

    return severity(utf8(text_col))


def reject_toxic(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` without those whose P(grade > 0) is ``TOXIC_FROM`` or more."""
    name = free_name(docs, "severity")
    scored = docs.withColumn(name, severity_column(model, text_col))
    return scored.where(F.col(name)["p_toxic"] < TOXIC_FROM).drop(name)


def query(spark, sf_dir) -> DataFrame:
    """op7: expected severity of all documents; the model is fitted on ``labels``."""
    docs = table(spark, sf_dir, "documents")
    model = fit(docs, table(spark, sf_dir, "labels"), F.col("toxic"), levels=LEVELS)
    s = F.col("s")
    return (docs.select("doc_id", severity_column(model, "text").alias("s"))
            .select("doc_id", F.round(s["severity"], 6).alias("severity"), F.round(s["p_toxic"], 6).alias("p_toxic"),
                    s["grade"].alias("grade"), (s["p_toxic"] >= TOXIC_FROM).alias("toxic")))
