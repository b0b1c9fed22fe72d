"""Periodic runs of words, by a dictionary of basic factors.

A run is a stretch of consecutive words with smallest period q (words q apart are identical) that is long enough
and that no neighbouring word extends. For each power of two L the factors of L words get names, equal
factors the same one. A factor's successor is its next occurrence; in a run of period q <= L the successors of
neighbouring places all lie q further on, so occurrences form arithmetic progressions. Where three occurrences of a
factor follow each other at one distance d within 2L, d is the smallest period of the words between, so it is
proposed as a period there; neighbouring proposals of one period are one. Each is extended to both sides by
comparing names, longest factors first, and equal runs are merged. A run of at least four periods has such a
progression at the L from q up to below 2q, so none is missed.

A factor without another occurrence in its document keeps no name, nor does a longer one that begins with it, so in
common text few places are left after the first lengths. All documents of an Arrow batch are worked on together in
numpy; words of two documents never share a name.

Defined cases: a null or empty text has no words and no run. Every row is judged by itself, repeated ids included.
Of runs with equal length / period the first start counts as the greatest, then the smallest period.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from costmart.llm.common import ship, table
from costmart.llm.rans import groups

#: A run has at least so many words and so many periods. The search needs four periods.
LEAST_WORDS, LEAST_PERIODS = 6, 4
#: Texts are worked on in groups of at most so many bytes (or one text).
GROUP_BYTES = 8 << 20


# --- the dictionary --------------------------------------------------------------------------
class BasicFactors:
    """Names of the factors of 1, 2, 4, .. words of several documents; -1 where a factor occurs once only."""

    def __init__(self, words: np.ndarray, starts: np.ndarray):
        """``words``: numbers of all documents' words one after the other; ``starts``: of each document."""
        self.n = len(words)
        lengths = np.diff(np.append(starts, self.n))
        doc = np.repeat(np.arange(len(starts)), lengths)
        longest = int(lengths.max(initial=0))
        self.names: list[np.ndarray] = []
        self.next: list[tuple[np.ndarray, np.ndarray]] = []  # places in order, and the distance of each one's successor
        at, key, length = np.arange(self.n), doc * (int(words.max(initial=0)) + 1) + words, 1
        while True:
            names, at = self._add(at, key)
            # a run of four periods below 2 L of a longer factor would be longer than any document
            if not len(at) or 4 * length > longest:
                return
            behind = at + length
            on = behind < self.n
            at, behind = at[on], behind[on]
            on = (names[behind] >= 0) & (doc[at] == doc[behind])
            at, behind = at[on], behind[on]
            key, length = names[at].astype(np.int64) * (int(names.max(initial=0)) + 1) + names[behind], 2 * length

    def _add(self, at: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        order = np.argsort(key, kind="stable")
        at, key = at[order], key[order]
        new = np.append(True, key[1:] != key[:-1]) if len(key) else np.zeros(0, dtype=bool)
        often = ~new | ~np.append(new[1:], True) if len(key) else new
        at, name, new = at[often], np.cumsum(new)[often], new[often]
        names = np.full(self.n, -1, dtype=np.int32)
        names[at] = name
        gap = np.zeros(len(at), dtype=np.int64)  # 0: no successor
        if len(at):
            gap[:-1] = np.where(new[1:], 0, at[1:] - at[:-1])
        self.names.append(names)
        self.next.append((at, gap))
        return names, np.sort(at)

    def proposals(self) -> tuple[np.ndarray, np.ndarray]:
        """(place, period): three occurrences of the factor there at equal distances, of neighbouring places the first."""
        found = []
        for level, (at, gap) in enumerate(self.next):
            length = 1 << level
            # each period belongs to the lengths from half of it up to below its double
            near = (gap > 0) & (gap <= 2 * length) & (2 * gap > length)
            if len(at):
                near[:-1] &= gap[:-1] == gap[1:]  # places of one name follow each other in order
                near[-1] = False
            place, period = at[near], gap[near]
            order = np.lexsort((place, period))
            place, period = place[order], period[order]
            if len(place):
                first = np.append(True, (period[1:] != period[:-1]) | (place[1:] != place[:-1] + 1))
                found.append((place[first], period[first]))
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return tuple(np.concatenate(c) for c in zip(*found))

    def _agree(self, a: np.ndarray, b: np.ndarray, level: int) -> np.ndarray:
        names, inside = self.names[level], (a >= 0) & (b >= 0) & (a < self.n) & (b < self.n)
        x, y = names[np.where(inside, a, 0)], names[np.where(inside, b, 0)]
        return inside & (x == y) & (x >= 0)

    def extend(self, place: np.ndarray, period: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(start, end) of the longest stretch around ``place`` that keeps ``period``."""
        end, start = place.copy(), place.copy()
        for level in range(len(self.names) - 1, -1, -1):
            length = 1 << level
            for move, side in ((length, end), (-length, start)):
                shift = 0 if move > 0 else -length
                todo = np.arange(len(place))
                while len(todo):  # at most once but for the longest factors
                    todo = todo[self._agree(side[todo] + shift, side[todo] + shift + period[todo], level)]
                    side[todo] += move
        return start, end + period


def find_runs(words: np.ndarray, starts: np.ndarray, least_words: int = LEAST_WORDS,
              least_periods: int = LEAST_PERIODS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, period) of all runs, by start and then period; starts count over all documents."""
    factors = BasicFactors(words, starts)
    place, period = factors.proposals()
    start, end = factors.extend(place, period)
    long = end - start >= np.maximum(least_words, least_periods * period)
    rows = np.unique(np.stack([start[long], period[long], end[long] - start[long]], axis=1), axis=0)
    return rows[:, 0], rows[:, 2], rows[:, 1]


# --- texts -----------------------------------------------------------------------------------
def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """(distinct words, number of each word, first word of each text and the end)."""
    split = pc.ascii_split_whitespace(texts)
    words = split.flatten()
    filled = pc.greater(pc.binary_length(words), 0).to_numpy(zero_copy_only=False)  # white space at the ends makes empty ones
    offsets = split.offsets.to_numpy().astype(np.int64)
    coded = words.filter(pa.array(filled)).dictionary_encode()
    before = np.concatenate([[0], np.cumsum(filled)])
    return coded.dictionary, coded.indices.to_numpy().astype(np.int64), before[offsets - offsets[0]]


def _summary(runs: list[tuple[int, int, int]], n: int) -> tuple:
    """n_runs, the greatest run's start, length, period and exponent, and the runs' digest."""
    digest = hashlib.sha256("".join(f"{s},{length},{q}\n" for s, length, q in runs).encode()).hexdigest()
    if not runs:
        return 0, None, None, None, None, digest
    # exponents that differ do so by more than 1 / n**2, so the whole part tells them apart
    s, length, q = max(runs, key=lambda r: (r[1] * n * n // r[2], -r[0], -r[2]))
    return len(runs), s, length, q, 1000 * length // q, digest


_OUT = "n_words long, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, " \
       "runs array<struct<start: long, length: long, period: long>>, collapsed string"
_RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str | Column = "text", least_words: int = LEAST_WORDS,
                  least_periods: int = LEAST_PERIODS) -> DataFrame:
    """(doc_id, n_words, n_runs, start, length, period, exponent_milli, runs_sha256, runs, collapsed), a row per row
    of ``docs``: the runs, the greatest one, and the text with one period kept of each run (kept words joined by one
    space)."""
    if least_periods < 4:
        raise ValueError("the search finds runs of at least four periods")
    ship(docs.sparkSession)
    text = F.col(text_col) if isinstance(text_col, str) else text_col
    kind = docs.schema[id_col].dataType.simpleString()

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in groups(batches, 1, GROUP_BYTES):
            distinct, words, ends = split_words(b.column(1))
            start, length, period = find_runs(words, ends[:-1], least_words, least_periods)
            gone = np.zeros(len(words) + 1, dtype=np.int64)
            np.add.at(gone, start + period, 1)
            np.add.at(gone, start + length, -1)
            keep = np.cumsum(gone[:-1]) == 0
            kept = distinct.take(pa.array(words[keep]))
            cuts = np.concatenate([[0], np.cumsum(keep)])[ends]
            collapsed = pc.binary_join(pa.ListArray.from_arrays(pa.array(cuts.astype(np.int32)), kept), " ")
            at = np.searchsorted(start, ends)
            rows = []
            for i in range(b.num_rows):
                own = slice(at[i], at[i + 1])
                runs = list(zip((start[own] - ends[i]).tolist(), length[own].tolist(), period[own].tolist()))
                n = int(ends[i + 1] - ends[i])
                rows.append((n, *_summary(runs, n), [{"start": s, "length": e, "period": q} for s, e, q in runs]))
            kinds = (*[pa.int64()] * 6, pa.string(), _RUNS)
            columns = [pa.array(c, t) for c, t in zip(zip(*rows), kinds)]
            yield pa.record_batch([b.column(0), *columns, collapsed], names=["doc_id", *[x.split()[0] for x in (
                "n_words n_runs start length period exponent_milli runs_sha256 runs collapsed").split()]])

    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(text.cast("string"), F.lit("")).alias("text"))
    return rows.mapInArrow(find, f"doc_id {kind}, {_OUT}")


def with_planted_runs(id_col: str = "doc_id", text_col: str = "text") -> Column:
    """The contract's texts: in every tenth document, by its id's CRC, the words from some place on repeat."""
    h = F.crc32(F.col(id_col).cast("string"))
    g = F.floor(h / 10)

    def repeated(w: Column) -> Column:
        n = F.size(w)
        a = F.pmod(g, n).cast("int")
        p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
        times = (1 + F.floor((n - a) / p)).cast("int")
        tail = F.slice(F.flatten(F.array_repeat(F.slice(w, a + 1, p), times)), F.lit(1), n - a)
        return F.when(n > 0, F.array_join(F.concat(F.slice(w, F.lit(1), a), tail), " "))

    # as a lambda's variable the words are cut once
    words = F.array(F.regexp_extract_all(text_col, F.lit(r"([^\x20\x09-\x0D]+)")))
    return F.when(h % 10 == 0, F.coalesce(F.get(F.transform(words, repeated), F.lit(0)), F.col(text_col))).otherwise(F.col(text_col))


def query(spark, sf_dir) -> DataFrame:
    """op12: all documents."""
    found = periodic_runs(table(spark, sf_dir, "documents"), text_col=with_planted_runs())
    return found.select("doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256",
                        F.sha2(F.col("collapsed"), 256).alias("collapsed_sha256"))


#: ``h`` is CRC-32 over the decimal id's characters, bit by bit.
ORACLE = r"""
WITH d AS (
  SELECT doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w,
    xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))),
      lambda c, b: list_reduce(list_prepend(xor(c, b), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]), lambda x, z: xor(x >> 1, 3988292384 * (x & 1))))) AS h
  FROM documents),
e AS (SELECT *, len(w) AS n, h // 10 AS g FROM d),
f AS (SELECT *, CASE WHEN h % 10 = 0 AND n > 0 THEN g % n END AS a FROM e),
t AS (SELECT doc_id, n, CASE WHEN a IS NULL THEN w ELSE list_transform(range(n), lambda i: w[1 + CASE WHEN i < a THEN i
    ELSE a + (i - a) % (1 + (n - a) // (3 + g % 8)) END]) END AS w FROM f),
x AS (SELECT doc_id, n, unnest(w) AS word, unnest(range(n)) AS i FROM t),
same AS (SELECT u.doc_id, u.i, v.i - u.i AS q FROM x u JOIN x v ON u.doc_id = v.doc_id AND u.word = v.word AND v.i > u.i AND 4 * (v.i - u.i) <= u.n),
island AS (SELECT doc_id, q, i, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS k FROM same),
stretch AS (SELECT doc_id, q, min(i) AS s, count(*) + q AS m FROM island GROUP BY doc_id, q, k HAVING count(*) + q >= greatest(6, 4 * q)),
r AS (SELECT * FROM stretch a WHERE NOT EXISTS (
  SELECT 1 FROM stretch b WHERE b.doc_id = a.doc_id AND b.q < a.q AND b.s <= a.s AND b.s + b.m >= a.s + a.m)),
per AS (SELECT doc_id, count(*) AS n_runs, string_agg(concat(s, ',', m, ',', q, chr(10)), '' ORDER BY s, q) AS listed FROM r GROUP BY doc_id),
top AS (SELECT a.doc_id, a.s, a.m, a.q FROM r a WHERE NOT EXISTS (SELECT 1 FROM r b WHERE b.doc_id = a.doc_id AND
  (b.m * a.q > a.m * b.q OR (b.m * a.q = a.m * b.q AND (b.s < a.s OR (b.s = a.s AND b.q < a.q)))))),
gone AS (SELECT DISTINCT doc_id, unnest(range(s + q, s + m)) AS i FROM r),
kept AS (SELECT x.doc_id, string_agg(x.word, ' ' ORDER BY x.i) AS c FROM x ANTI JOIN gone ON x.doc_id = gone.doc_id AND x.i = gone.i GROUP BY x.doc_id)
SELECT t.doc_id, coalesce(n_runs, 0) AS n_runs, CAST(top.s AS BIGINT) AS start, CAST(top.m AS BIGINT) AS length, CAST(top.q AS BIGINT) AS period,
  CAST(1000 * top.m // top.q AS BIGINT) AS exponent_milli, sha256(coalesce(listed, '')) AS runs_sha256, sha256(coalesce(c, '')) AS collapsed_sha256
FROM t LEFT JOIN per USING (doc_id) LEFT JOIN top USING (doc_id) LEFT JOIN kept USING (doc_id)
"""
