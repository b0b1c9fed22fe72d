"""Secret scans: rule-based spans, and random strings found by their token efficiency.

Three kinds of spans come from fixed patterns (assign, access, hex). The fourth, ``random``, is the
token-efficiency test: a run of token characters that a byte-pair vocabulary needs many tokens for
(few characters per token) was not written by a person. Known digests (runs of hex digits of the
usual digest lengths), UUIDs, numbers and dates are excluded first, and so is what has the shape of an
identifier (words in one case, camel case, words joined by ``-_./``, dotted names) if its longer words,
in small letters, are not many tokens either. So keys of letters only, in one case or both, are found.
Of a run that patterns' spans cover in part, the parts that they leave are tested. If a run is not random as a whole, because words of a path or a dotted name
thin out its tokens, the neighbouring pieces between its separators that need the most tokens are tested.

Spans are code points, end exclusive. Defined cases: null counts as empty; an empty text has no spans.
Every row is scanned by itself and whole.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache, wraps

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from costmart.llm.common import free_name, table

KINDS = ("assign", "access", "hex", "random")
ASSIGN = re.compile(r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
MIN_ASSIGN, MIN_ACCESS = 6, 20

#: A run this long is tested; it is random if it has fewer characters per token than MAX_RATIO.
MIN_RANDOM = 20
MAX_RATIO = 2.2
#: For letters with separators among them: many names joined of short words have 1.8 to 2.2, random letters 1.4 to 1.7.
MAX_JOINED = 1.8
#: Runs whose result a worker keeps, and their length.
CACHED_RUNS, CACHED_CHARS = 1 << 16, 256
RUN = re.compile(r"[A-Za-z0-9+/_=.-]{%d,}" % MIN_RANDOM)
_FIXED = re.compile(
    r"(?:[0-9a-f]{32}|[0-9a-f]{40}|[0-9a-f]{56}|[0-9a-f]{64}|[0-9a-f]{96}|[0-9a-f]{128})"  # md5, sha1, sha2
    r"|(?:[0-9A-F]{32}|[0-9A-F]{40}|[0-9A-F]{56}|[0-9A-F]{64}|[0-9A-F]{96}|[0-9A-F]{128})"
    r"|[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}"  # UUID
    r"|[-+=./_0-9TZ]*")  # numbers, dates and times, rulers
_IDENTIFIERS = re.compile(
    r"[-=./_+]*(?:(?:[A-Z]?[a-z]+|[A-Z]+|[0-9]+)(?:[-=./_+]+|$))+"  # words joined by separators
    r"|[A-Z]?[a-z]{2,}(?:[A-Z][a-z]{2,})*[0-9]{0,4}")  # camel case, a word with a number
_WORD = re.compile("[A-Z][a-z]{3,}|[a-z]{4,}|[A-Z]{4,}")
PATTERN = (r"(?i:'s|'t|'re|'ve|'m|'ll|'d)|[^\r\n\p{L}\p{N}]?\p{L}+|\p{N}{1,3}"
           r"| ?[^\s\p{L}\p{N}]+[\r\n]*|\s*[\r\n]+|\s+(?!\S)|\s+")


def vocabulary_path(name: str = "byte_bpe_50k.tiktoken") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@lru_cache(maxsize=4)
def _encoding(path: str):
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding(path, pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def _remembered(f):
    """Results for runs of up to ``CACHED_CHARS`` are kept; a longer one is rarely met twice and would fill the memory."""
    kept = lru_cache(maxsize=CACHED_RUNS)(f)

    @wraps(f)
    def of(run: str, path: str):
        return (kept if len(run) <= CACHED_CHARS else f)(run, path)

    return of


@_remembered
def is_random(run: str, path: str) -> bool:
    core = run.strip("=./-_+")
    if len(core) < MIN_RANDOM or _FIXED.fullmatch(core):
        return False
    if _IDENTIFIERS.fullmatch(core):
        # capitals are many tokens in any word, and short words are few characters to a token
        words = [w.lower() for w in _WORD.findall(core)]
        most = MAX_RATIO if core.isalnum() else MAX_JOINED
        return sum(map(len, words)) < most * sum(len(_encoding(path).encode_ordinary(w)) for w in words)
    most = MAX_RATIO if re.search("[0-9]", core) or core.isalpha() else MAX_JOINED
    return len(core) < most * len(_encoding(path).encode_ordinary(core))


_KNOWN = re.compile(r"(?<![A-Za-z0-9])(?:[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}"
                    r"|[0-9a-fA-F]{32}|[0-9a-fA-F]{40}|[0-9a-fA-F]{56}|[0-9a-fA-F]{64}|[0-9a-fA-F]{96}|[0-9a-fA-F]{128})(?![A-Za-z0-9])")
_PIECE = re.compile("[A-Za-z0-9]+")
_PLAIN = re.compile("[A-Z]?[a-z]+|[A-Z]+|[0-9]+")


def _highest(scores: list[float]) -> list[tuple[int, int]]:
    """All maximal scoring stretches [start, end), as of Ruzzo and Tompa."""
    found: list[tuple[int, int, float, float, int]] = []  # start, end, sum before, sum with it, last one with less before
    total = 0.0
    for i, x in enumerate(scores):
        before, total = total, total + x
        if x <= 0:
            continue
        start, j = i, len(found) - 1
        while True:
            while j >= 0 and found[j][2] >= before:
                j = found[j][4]
            if j < 0 or found[j][3] >= total:
                break
            start, before, link = found[j][0], found[j][2], found[j][4]
            del found[j:]
            j = link
        found.append((start, i + 1, before, total, j))
    return [(s, e) for s, e, *_ in found]


@_remembered
def random_parts(run: str, path: str) -> tuple[tuple[int, int], ...]:
    """(start, end) of what is random in a run: all of it, or stretches of its pieces."""
    if is_random(run, path):
        return ((0, len(run)),)
    if len(run) <= MIN_RANDOM:
        return ()
    out, count, at = [], _encoding(path).encode_ordinary, 0
    for a, b in [*[m.span() for m in _KNOWN.finditer(run)], (len(run), len(run))]:
        pieces, at = [m.span() for m in _PIECE.finditer(run, at, a)], b
        if not pieces or pieces[-1][1] - pieces[0][0] < MIN_RANDOM:
            continue
        scores = [MAX_RATIO * len(count(run[s:e])) - (e - s) for s, e in pieces]
        # a short word or number is no sign of randomness by itself
        scores = [min(x, 0) if e - s < MIN_RANDOM and _PLAIN.fullmatch(run, s, e) else x for x, (s, e) in zip(scores, pieces)]
        for i, j in _highest(scores):
            if is_random(run[pieces[i][0]:pieces[j - 1][1]], path):
                out.append((pieces[i][0], pieces[j - 1][1]))
            else:
                out += [(s, e) for s, e in pieces[i:j] if is_random(run[s:e], path)]
    return tuple(out)


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, kind number, end), sorted: what the fixed patterns find."""
    spans = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= MIN_ASSIGN]
    spans += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= MIN_ACCESS]
    spans += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(spans)


def _left(runs: Iterable[tuple[int, int]], taken: list[tuple[int, int, int]]) -> Iterator[tuple[int, int]]:
    """What the spans leave of the runs. Both are sorted and no two runs overlap: one walk over both."""
    at, covered = 0, 0  # the next span, and where those before it end at the latest
    for start, end in runs:
        while start < end:
            while at < len(taken) and taken[at][0] <= start:
                covered = max(covered, taken[at][2])
                at += 1
            start = max(start, covered)
            stop = min(end, taken[at][0]) if at < len(taken) else end
            if start < stop:
                yield start, stop
            start = max(start, stop)


def random_spans(text: str, taken: list[tuple[int, int, int]], path: str) -> list[tuple[int, int, int]]:
    return [(s + a, 3, s + b) for s, e in _left((m.span() for m in RUN.finditer(text)), taken)
            for a, b in random_parts(text[s:e], path)]


def _joined(spans) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


SCHEMA = T.StructType([T.StructField(f"n_{k}", T.LongType()) for k in KINDS]
                      + [T.StructField("base_spans", T.StringType()), T.StructField("spans", T.StringType()),
                         T.StructField("redacted", T.StringType())])


def scan_column(text_col: str | Column, vocabulary: str | None = None, redact: bool = False) -> Column:
    """struct of ``SCHEMA``: counts by kind, the spans as text, and, if asked for, the text with
    every span (overlapping ones merged) replaced by ``[REDACTED]``."""
    path = vocabulary or vocabulary_path()

    @F.pandas_udf(SCHEMA)
    def scan(texts: pd.Series) -> pd.DataFrame:
        rows = []
        for text in texts:
            base = base_spans(text)
            spans = sorted([*base, *random_spans(text, base, path)])
            n = [sum(k == i for _, k, _ in spans) for i in range(len(KINDS))]
            rows.append((*n, _joined(base), _joined(spans), redacted(text, spans) if redact else None))
        return pd.DataFrame(rows, columns=SCHEMA.names)

    col = F.col(text_col) if isinstance(text_col, str) else text_col
    return scan(F.coalesce(col, F.lit("")))


def redacted(text: str, spans, mark: str = "[REDACTED]") -> str:
    out, at = [], 0
    for start, _, end in spans:
        if start >= at:
            out += [text[at:start], mark]
        at = max(at, end)
    return "".join([*out, text[at:]])


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 vocabulary: str | None = None) -> DataFrame:
    found = docs.select(F.col(id_col).alias("doc_id"), scan_column(text_col, vocabulary).alias("s"))
    return found.select("doc_id", *[F.col(f"s.{c}").alias(c) for c in SCHEMA.names if c != "redacted"])


def redact_secrets(docs: DataFrame, text_col: str = "text", length_col: str | None = "n_chars",
                   vocabulary: str | None = None) -> DataFrame:
    """``docs``, all rows and columns, with secrets replaced; a null text stays null. ``length_col``,
    if the table has it, follows the new text where the text changed."""
    name, kinds = free_name(docs, "secrets"), dict(docs.dtypes)
    scanned = docs.withColumn(name, scan_column(text_col, vocabulary, redact=True))
    changed = scanned[name]["spans"] != ""
    new = {text_col: F.when(changed, scanned[name]["redacted"]).otherwise(scanned[text_col])}
    if length_col in docs.columns:
        new[length_col] = (F.when(changed, F.char_length(scanned[name]["redacted"]).cast(kinds[length_col]))
                           .otherwise(scanned[length_col]))
    return scanned.withColumns(new).select(*docs.columns)


def query(spark, sf_dir) -> DataFrame:
    """op4: all documents."""
    found = find_secrets(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_assign", "n_access", "n_hex", F.sha2(F.col("base_spans"), 256).alias("base_sha256"),
                        "spans", "n_random")
