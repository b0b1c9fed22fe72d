"""Scores of an interpolated modified Kneser-Ney bigram model.

Spark counts the model over all training texts: tasks count their own words (and then pairs of neighbouring words)
and send each shard its sorted, compressed counts, so a frequent word or pair costs one entry per task; a
shard's task merges them and writes one file. A file holds sorted 64-bit hashes and, beside them, arrays of counts.
Workers map the files into memory, so a lookup reads pages that the workers of a machine share and that need not
stay in memory; the hashes of a whole batch are looked up in sorted order, a shard after the other.

* vocabulary: hash of the word, sorted; a word's number is its place over all shards. Its count.
* pairs: a reversible hash of the two words' numbers (so pairs can't collide), sorted; the pair's count.
* for each word number: as a context, its followers' total and how many follow once, twice or more often; as
  a follower, how many different words it follows.

With a text as <s> w1 .. wm </s>, c the pairs' counts and a(w) the number of different words before w:

    p(w | u) = max(c(uw) - D(c(uw)), 0) / c(u.) + g(u) p(w)      g(u) = (D1 N1(u.) + D2 N2(u.) + D3 N3+(u.)) / c(u.)
    p(w)     = max(a(w) - D'(a(w)), 0) / a(.) + g' / (V + 1)     p(unknown) = g' / (V + 1)

D1, D2, D3+ follow from the counts of counts (n1 .. n4) as usual; where those don't give a discount between 0 and the
count, they are 0.5, 1 and 1.5. A word that never was a context (an unknown one) gives p(w). For every
context the probabilities of the V training tokens and of the unknown word add up to 1.

Defined cases: a null or empty text is its end alone. Every row is scored, and learned from, by itself. Without a training text every
token has probability 1 (there is nothing but the unknown word). Words that differ in a 64-bit hash are told apart.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from costmart.llm.common import ship, table
from costmart.llm.rans import groups
from costmart.llm.runs import split_words
from costmart.session import scratch_path

#: Text for which a shard of words and one of pairs is planned, and of a batch that is worked on at once.
WORD_BYTES, PAIR_BYTES, GROUP_BYTES = 32 << 20, 16 << 20, 8 << 20
#: Entries that a task holds before it sends them.
HELD_ENTRIES = 3 << 20
#: No word has a space.
END, BEGIN = (np.uint64(xxhash.xxh3_64_intdigest(w)) for w in (b" ", b"  "))
LARGEST_VOCABULARY = 1 << 32
_MULTIPLY = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


def mix(x: np.ndarray) -> np.ndarray:
    """A reversible hash of 64-bit numbers."""
    for shift, factor in zip((30, 27), _MULTIPLY):
        x = (x ^ (x >> np.uint64(shift))) * factor
    return x ^ (x >> np.uint64(31))


def shard_of(hashes: np.ndarray, shards: int) -> np.ndarray:
    """Ranges of hashes, so that the shards one after the other are sorted."""
    return ((hashes >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)).astype(np.int64)


# --- counting --------------------------------------------------------------------------------
def summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, sorted, and the sums of their counts."""
    if not len(keys):
        return keys, counts
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    return keys[first], np.add.reduceat(counts, first)


def _pack(*arrays: np.ndarray) -> bytes:
    """64-bit arrays of one length, the first one ascending; bytes of equal weight together compress well."""
    import zstandard

    first = np.diff(arrays[0], prepend=np.uint64(0))
    data = b"".join(np.ascontiguousarray(a.astype("<u8").view(np.uint8).reshape(-1, 8).T).tobytes() for a in (first, *arrays[1:]))
    return zstandard.ZstdCompressor(level=1).compress(data)


def _unpack(data: bytes, n: int) -> list[np.ndarray]:
    """n arrays as ``_pack`` got them."""
    import zstandard

    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(n, 8, -1)
    out = [np.ascontiguousarray(r.T).view("<u8").reshape(-1) for r in raw]
    return [np.cumsum(out[0], dtype=np.uint64), *out[1:]]


class _Held:
    """Counts by key, sent shard by shard when there are many."""

    def __init__(self, shards: int, place):
        self.shards, self.place, self.parts, self.size = shards, place, [], 0

    def add(self, keys: np.ndarray, counts: np.ndarray) -> Iterator[pa.RecordBatch]:
        self.parts.append((keys, counts))
        self.size += len(keys)
        if self.size > HELD_ENTRIES:
            self.parts = [summed(*(np.concatenate(c) for c in zip(*self.parts)))]
            self.size = len(self.parts[0][0])
            if self.size > HELD_ENTRIES // 2:
                yield from self.send()

    def send(self) -> Iterator[pa.RecordBatch]:
        if not self.parts:
            return
        keys, counts = summed(*(np.concatenate(c) for c in zip(*self.parts)))
        self.parts, self.size = [], 0
        shard = self.place(keys)
        order = np.argsort(shard, kind="stable")
        cuts = np.append(np.flatnonzero(np.diff(shard[order], prepend=-1)), len(keys))
        for i in range(0, len(cuts) - 1, 64):
            own = [order[s:e] for s, e in zip(cuts[i:i + 64], cuts[i + 1:i + 65])]
            yield pa.record_batch([pa.array([int(shard[o[0]]) for o in own], pa.int64()), pa.array(
                [_pack(keys[o], counts[o].astype(np.uint64)) for o in own], pa.binary())], names=["shard", "data"])


def _merged(group: pa.Table, n: int = 2) -> tuple[np.ndarray, np.ndarray]:
    parts = [_unpack(d.as_py(), n) for d in group.column("data")]
    keys, counts = (np.concatenate(c) for c in zip(*parts))
    return summed(keys, counts.astype(np.int64))


# --- files -----------------------------------------------------------------------------------
def _write(folder: str, arrays: list[np.ndarray]) -> str:
    """One new file with the arrays one after the other; only files that a stored index names count."""
    import uuid

    from pyarrow import fs

    store, root = fs.FileSystem.from_uri(folder)
    store.create_dir(root, recursive=True)
    name = f"{uuid.uuid4().hex}.bin"
    with store.open_output_stream(f"{root}/{name}", compression=None) as out:
        for a in arrays:
            out.write(pa.py_buffer(np.ascontiguousarray(a)))
    return name


def _mapped(folder: str, name: str, n: int, kinds: tuple[str, ...]) -> list[np.ndarray]:
    """The arrays of a file, mapped (a store that has no paths is read instead)."""
    from pyarrow import fs

    store, root = fs.FileSystem.from_uri(folder)
    if isinstance(store, fs.LocalFileSystem):
        data = pa.memory_map(f"{root}/{name}").read_buffer()
    else:
        with store.open_input_file(f"{root}/{name}") as f:
            data = f.read_buffer()
    out, at = [], 0
    for kind in kinds:
        out.append(np.frombuffer(data, kind, n, at))
        at += n * np.dtype(kind).itemsize
    return out


class Shards:
    """The files of a stored index (shard, file, n), opened when they are needed."""

    def __init__(self, index: str, folder: str, kinds: tuple[str, ...], shards: int):
        import pyarrow.dataset as ds
        from pyarrow import fs

        store, root = fs.FileSystem.from_uri(index)
        rows = ds.dataset(root, filesystem=store, format="parquet").to_table(columns=["shard", "file", "n"])
        self.folder, self.kinds, self.shards = folder, kinds, shards
        self.size = np.zeros(shards + 1, dtype=np.int64)
        self.files: dict[int, str] = {}
        for shard, file, n in zip(*(rows[c].to_pylist() for c in ("shard", "file", "n"))):
            if file is not None:
                self.files[shard], self.size[shard + 1] = file, n
        self.first = np.cumsum(self.size)
        self.open: dict[int, list[np.ndarray]] = {}

    def __getitem__(self, shard: int) -> list[np.ndarray]:
        if shard not in self.open:
            self.open[shard] = _mapped(self.folder, self.files[shard], int(self.size[shard + 1]), self.kinds)
        return self.open[shard]

    def parts(self, shard: np.ndarray) -> Iterator[tuple[int, slice]]:
        """The shards that have a file among ascending numbers, with the places of each."""
        cuts = np.append(np.flatnonzero(np.diff(shard, prepend=-1)), len(shard))
        for s, e in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
            if int(shard[s]) in self.files:
                yield int(shard[s]), slice(s, e)

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place over all shards or -1, count or 0) of ascending hashes."""
        place, count = np.full(len(hashes), -1, dtype=np.int64), np.zeros(len(hashes), dtype=np.int64)
        for shard, own in self.parts(shard_of(hashes, self.shards)):
            keys, counts = self[shard]
            at = np.minimum(np.searchsorted(keys, hashes[own]), len(keys) - 1)
            there = keys[at] == hashes[own]
            place[own] = np.where(there, self.first[shard] + at, -1)
            count[own] = np.where(there, counts[at], 0)
        return place, count

    def take(self, places: np.ndarray) -> list[np.ndarray]:
        """The arrays' values at ascending places, 0 at -1."""
        out = [np.zeros(len(places), dtype=np.int64) for _ in self.kinds]
        for shard, own in self.parts(np.searchsorted(self.first, places, side="right") - 1):
            for values, array in zip(out, self[shard]):
                values[own] = array[places[own] - self.first[shard]]
        return out


# --- texts -----------------------------------------------------------------------------------
def tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hashes of distinct words, END and BEGIN; of every token its number; of every token that before it), all texts'
    tokens one after the other; END's number is the last but one and BEGIN's the last."""
    distinct, words, ends = split_words(pc.ascii_lower(texts))
    n = len(distinct)
    hashes = np.append(np.fromiter(map(xxhash.xxh3_64_intdigest, distinct.cast(pa.binary()).to_pylist()), np.uint64, n), [END, BEGIN])
    token = np.insert(words, ends[1:], n)
    before = np.roll(token, 1)
    before[before == n] = n + 1  # a text begins behind the end of another
    return hashes, token, before


def _rows(docs: DataFrame, text_col: str, *columns: Column) -> DataFrame:
    return docs.select(F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"), *columns)


# --- the model -------------------------------------------------------------------------------
def discounts(n: list[int]) -> np.ndarray:
    """D of a count of 0, 1, 2, 3 and more, from the numbers of entries counted once to four times."""
    out = np.array([0.0, 0.5, 1.0, 1.5])
    if all(n):
        y = n[0] / (n[0] + 2 * n[1])
        found = [k - (k + 1) * y * n[k] / n[k - 1] for k in (1, 2, 3)]
        if all(0 <= d <= k for k, d in enumerate(found, 1)):
            out[1:] = found
    return out


@dataclass(frozen=True)
class KneserNey:
    """Where a model's files are, and its totals; small, so that it travels to the tasks."""
    folder: str
    words: str
    pairs: str
    followers: str
    word_shards: int
    pair_shards: int
    train_tokens: int
    vocabulary: int
    continuations: int
    pair_discounts: tuple[float, ...]
    word_discounts: tuple[float, ...]
    rest: float


_CONTEXT = ("total", "once", "twice", "more", "preceding")
_WORD_FILE, _FOLLOWER_FILE = ("<u8", "<i8"), ("<i8", "<i8", "<i4", "<i4", "<i4")


def _store(df: DataFrame, name: str) -> tuple[str, DataFrame]:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return path, df.sparkSession.read.schema(df.schema).parquet(path)


@lru_cache(maxsize=4)
def _shards(index: str, folder: str, kinds: tuple[str, ...], shards: int) -> Shards:
    return Shards(index, folder, kinds, shards)


def _counts_of_counts(counts: np.ndarray) -> list[int]:
    return np.bincount(counts[counts <= 4], minlength=5)[1:5].tolist()


def fit(docs: DataFrame, text_col: str = "text", word_bytes: int = WORD_BYTES, pair_bytes: int = PAIR_BYTES) -> KneserNey:
    """The model of all rows of ``docs``."""
    spark: SparkSession = docs.sparkSession
    ship(spark)
    rows = _rows(docs, text_col)
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    word_shards, pair_shards = (max(1, -(-size // b)) for b in (word_bytes, pair_bytes))
    folder = scratch_path(spark, "lm")

    def count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = _Held(word_shards, lambda keys: shard_of(keys, word_shards))
        for b in groups(batches, 0, GROUP_BYTES):
            hashes, token, _ = tokens(b.column(0))
            yield from held.add(hashes, np.bincount(token, minlength=len(hashes)))
        yield from held.send()

    def merge_words(key: tuple[pa.Scalar, ...], group: pa.Table) -> pa.Table:
        hashes, counts = _merged(group)
        name = _write(folder, [hashes.astype("<u8"), counts.astype("<i8")])
        return pa.table({"shard": pa.array([key[0].as_py()], pa.int64()), "file": [name], "n": pa.array([len(hashes)], pa.int64()),
                         "tokens": pa.array([int(counts.sum())], pa.int64()), "seen": pa.array([int((counts > 0).sum())], pa.int64())})

    counted = rows.mapInArrow(count_words, "shard long, data binary")
    words, index = _store(counted.groupBy("shard").applyInArrow(merge_words, "shard long, file string, n long, tokens long, seen long"), "lm-words")
    entries, train_tokens, vocabulary = (x or 0 for x in index.agg(F.sum("n"), F.sum("tokens"), F.sum("seen")).first())
    if entries >= LARGEST_VOCABULARY:
        raise ArithmeticError("a pair of words is numbered in 64 bits")

    def numbers(hashes: np.ndarray) -> np.ndarray:
        order = np.argsort(hashes)
        out = np.empty(len(hashes), dtype=np.int64)
        out[order] = _shards(words, folder, _WORD_FILE, word_shards).find(hashes[order])[0]
        return out

    def count_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = _Held(pair_shards, lambda keys: shard_of(mix(keys), pair_shards))
        for b in groups(batches, 0, GROUP_BYTES):
            hashes, token, before = tokens(b.column(0))
            number = numbers(hashes).astype(np.uint64)
            yield from held.add(*summed(number[before] << np.uint64(32) | number[token], np.ones(len(token), dtype=np.int64)))
        yield from held.send()

    def merge_pairs(key: tuple[pa.Scalar, ...], group: pa.Table) -> pa.Table:
        keys, counts = _merged(group)
        first, second = (keys >> np.uint64(32)).astype(np.int64), (keys & np.uint64(0xFFFFFFFF)).astype(np.int64)
        hashes = mix(keys)
        order = np.argsort(hashes)
        name = _write(folder, [hashes[order].astype("<u8"), counts[order].astype("<i8")])
        # what the pairs say about their words, for the shards of words
        start = np.flatnonzero(np.append(True, first[1:] != first[:-1]))
        about = [np.add.reduceat(x.astype(np.int64), start) for x in (counts, counts == 1, counts == 2, counts >= 3)]
        after, preceding = np.unique(second, return_counts=True)
        where = _shards(words, folder, _WORD_FILE, word_shards)
        out = [(None, key[0].as_py(), name, len(keys), _counts_of_counts(counts), None, None)]
        for kind, places, values in (("context", first[start], about), ("follower", after, [preceding])):
            for shard, own in where.parts(np.searchsorted(where.first, places, side="right") - 1):
                out.append((kind, shard, None, None, None, len(values) + 1, _pack(places[own].astype(np.uint64), *(v[own] for v in values))))
        names = ["kind", "shard", "file", "n", "by_count", "arrays", "data"]
        kinds = [pa.string(), pa.int64(), pa.string(), pa.int64(), pa.list_(pa.int64()), pa.int32(), pa.binary()]
        return pa.table({n: pa.array(c, t) for n, c, t in zip(names, zip(*out), kinds)})

    counted = rows.mapInArrow(count_pairs, "shard long, data binary")
    found = counted.groupBy("shard").applyInArrow(
        merge_pairs, "kind string, shard long, file string, n long, by_count array<long>, arrays int, data binary")
    found = _store(found, "lm-pairs-found")[1]
    pairs, index = _store(found.where(F.col("kind").isNull()).select("shard", "file", "n", "by_count"), "lm-pairs")
    by_count = [x or 0 for x in index.agg(*[F.sum(F.get("by_count", F.lit(i))) for i in range(4)]).first()]

    def merge_followers(key: tuple[pa.Scalar, ...], group: pa.Table) -> pa.Table:
        shard = key[0].as_py()
        where = _shards(words, folder, _WORD_FILE, word_shards)
        totals = {c: np.zeros(int(where.size[shard + 1]), dtype=np.int64) for c in _CONTEXT}
        for kind, n, data in zip(*(group.column(c) for c in ("kind", "arrays", "data"))):
            places, *values = _unpack(data.as_py(), n.as_py())
            at = places.astype(np.int64) - where.first[shard]  # distinct within a row
            for c, v in zip(_CONTEXT[:4] if kind.as_py() == "context" else _CONTEXT[4:], values):
                totals[c][at] += v.astype(np.int64)
        name = _write(folder, [totals["total"].astype("<i8"), totals["preceding"].astype("<i8"),
                               *(totals[c].astype("<i4") for c in ("once", "twice", "more"))])
        a = totals["preceding"]
        return pa.table({"shard": pa.array([shard], pa.int64()), "file": [name], "n": pa.array([len(a)], pa.int64()),
                         "continuations": pa.array([int(a.sum())], pa.int64()), "more": pa.array([int((a > 2).sum())], pa.int64()),
                         "by_count": pa.array([_counts_of_counts(a)], pa.list_(pa.int64()))})

    about = found.where(F.col("kind").isNotNull()).select("kind", "shard", "arrays", "data")
    followers, index = _store(about.groupBy("shard").applyInArrow(
        merge_followers, "shard long, file string, n long, continuations long, more long, by_count array<long>"), "lm-followers")
    continuations, more, *word_counts = (x or 0 for x in index.agg(
        F.sum("continuations"), F.sum("more"), *[F.sum(F.get("by_count", F.lit(i))) for i in range(4)]).first())
    d = discounts(word_counts)
    rest = float(d[1] * word_counts[0] + d[2] * word_counts[1] + d[3] * more) / continuations if continuations else 1.0
    return KneserNey(folder, words, pairs, followers, word_shards, pair_shards, train_tokens, vocabulary, continuations,
                     tuple(discounts(by_count).tolist()), tuple(d.tolist()), rest)


class Scorer:
    """A model's files, mapped."""

    def __init__(self, model: KneserNey):
        self.model = model
        self.words = _shards(model.words, model.folder, _WORD_FILE, model.word_shards)
        self.pairs = _shards(model.pairs, model.folder, _WORD_FILE, model.pair_shards)
        self.followers = _shards(model.followers, model.folder, _FOLLOWER_FILE, model.word_shards)

    def probabilities(self, hashes: np.ndarray, token: np.ndarray, before: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(count of each distinct word, model probability of each token), as ``tokens`` numbers them."""
        m = self.model
        order = np.argsort(hashes)
        place, count, values = np.empty(len(hashes), np.int64), np.empty(len(hashes), np.int64), np.empty((5, len(hashes)), np.int64)
        place[order], count[order] = self.words.find(hashes[order])
        by_place = np.argsort(place)
        values[:, by_place] = self.followers.take(place[by_place])
        total, preceding, once, twice, more = values
        d = np.array(m.word_discounts)
        alone = np.maximum(preceding - d[np.minimum(preceding, 3)], 0) / max(m.continuations, 1) + m.rest / (m.vocabulary + 1)
        d = np.array(m.pair_discounts)
        back = np.where(total > 0, (d[1] * once + d[2] * twice + d[3] * more) / np.maximum(total, 1), 1.0)
        known = np.flatnonzero((total[before] > 0) & (place[token] >= 0))
        keys, which = np.unique(mix(place[before[known]].astype(np.uint64) << np.uint64(32) | place[token[known]].astype(np.uint64)),
                                return_inverse=True)
        c = np.zeros(len(token), dtype=np.int64)
        c[known] = self.pairs.find(keys)[1][which]
        own = np.maximum(c - d[np.minimum(c, 3)], 0) / np.maximum(total[before], 1)
        return count, own + back[before] * alone[token]


@lru_cache(maxsize=2)
def _scorer(model: KneserNey) -> Scorer:
    return Scorer(model)


def score(docs: DataFrame, model: KneserNey, id_col: str = "doc_id", text_col: str = "text", *others: Column) -> DataFrame:
    """(doc_id, ``others``, n_tokens, n_known, train_tokens, base_score, score, perplexity), a row per row of ``docs``. ``base_score`` is that of
    add-one word counts; both are log10 probabilities."""
    ship(docs.sparkSession)
    rows = _rows(docs, text_col, F.col(id_col).alias("doc_id"), *others)
    kept = rows.schema.fields[1:]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = _scorer(model)
        for b in groups(batches, 0, GROUP_BYTES):
            if not b.num_rows:
                continue
            hashes, token, before = tokens(b.column(0))
            count, probability = scorer.probabilities(hashes, token, before)
            base = np.log10((count + 1) / (model.train_tokens + model.vocabulary + 1))
            starts = np.flatnonzero(before == len(hashes) - 1)
            n = np.diff(np.append(starts, len(token)))
            known = np.add.reduceat((count[token] > 0).astype(np.int64), starts)
            total = np.add.reduceat(np.log10(probability), starts)
            yield pa.record_batch([*b.columns[1:], pa.array(n), pa.array(known), pa.array(np.full(len(n), model.train_tokens)),
                                   pa.array(np.add.reduceat(base[token], starts)), pa.array(total), pa.array(10 ** (-total / n))],
                                  names=[*[f.name for f in kept], "n_tokens", "n_known", "train_tokens", "base_score", "score", "perplexity"])

    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept)
    return rows.mapInArrow(run, f"{columns}, n_tokens long, n_known long, train_tokens long, base_score double, score double, perplexity double")


def query(spark, sf_dir) -> DataFrame:
    """op13: learns from the documents whose id's CRC modulo 7 is not 2 and scores all; a null id counts as empty."""
    docs = table(spark, sf_dir, "documents")
    held_out = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 7 == 2
    model = fit(docs.where(~held_out))
    return score(docs, model, "doc_id", "text", held_out.alias("held_out"))
