"""Token ids in binary files, compressed by a range asymmetric numeral system (rANS).

The texts are tokenised once and the ids stored; symbol counts over all ids give one static frequency
table, which every file shares. Documents are sorted by id over range partitions and each partition
writes one file (more if it is large).

A file holds blocks of ids. A block is encoded by itself with interleaved states ("lanes": lane j
codes the ids j, j + lanes, ...), so numpy codes a whole row of lanes at a time, and any block can
be decoded without the others. The footer holds a checkpoint for each block (offset, length, first
id, CRC-32 of its ids) and the documents with their numbers of ids; files and ranges of blocks are
decoded in parallel.

    file    MAGIC, blocks, footer (zlib-compressed JSON), footer length (u32), MAGIC
    block   ids (u32), lanes (u32), words (u32), final states (lanes x u64), words (u32 each)
    state   64 bits in [2**31, 2**63), renormalised by 32-bit words; frequencies sum to 2**bits

All numbers are little-endian. Defined cases: a null or empty text has only the end id. Documents of one id
are kept apart, in the order of their stored row numbers; null ids come first. An empty table makes
no file.
"""

from __future__ import annotations

import json
import struct
import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from costmart.llm.common import stored, table
from costmart.session import scratch_path

MAGIC = b"RANSIDS1"
END_ID = 2
#: Ids in a block, lanes in a full block, and bits of the frequency table's sum.
BLOCK_IDS, LANES, TABLE_BITS = 1 << 19, 4096, 20
#: A partition is planned for this many ids; a file is closed beyond that many.
PARTITION_IDS, FILE_IDS = 4 << 20, 16 << 20
LOW = np.uint64(1 << 31)
#: Cores that a worker remembers, if they have no more than so many bytes.
CACHED_CORES, CACHED_CHARS = 1_000_000, 32
#: Texts are cut into words in groups of at most so many bytes (or one text).
GROUP_BYTES = 32 << 20
#: Cores that are encoded as one text.
JOINED_CORES = 48


# --- tokenising ------------------------------------------------------------------------------
def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


#: ASCII punctuation that ends a word and is a token run of its own behind a letter or digit. Not the apostrophe,
#: which may begin a contraction, nor what special tokens are written with.
_TAIL = b"!\"#$%&()*+,-./:;=?@[\\]^_`{}~"


class Encoder:
    """Encodes texts word by word. The tokenizer drops white space, and its splits never cross ASCII
    white space, so a text's ids are its words' ids one after the other. A word is further cut into
    its core and the punctuation behind it (the tokenizer cuts there, too), and the ids of cores and
    tails are remembered: a word is small work, and the tokenizer sees each core once.

    Cores of letters only are single pieces of the tokenizer's pre-tokenization, whose last token is
    marked as the end of a word; so many of them are encoded as one text and cut at those marks. Where the
    number of marks is not that of the cores, each is encoded by itself.
    """

    def __init__(self, path: str):
        import tokenizers

        self.tokenizer = tokenizers.Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
        if self.tokenizer.get_vocab_size() > 1 << 16:
            raise ValueError("the files hold ids of 16 bits; this tokenizer has larger ones")
        self.ends = np.zeros(max(vocabulary.values(), default=0) + 1, dtype=bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.known: dict[bytes, bytes] = {}  # ids of cores and tails

    def _learn(self, parts: list[bytes]) -> None:
        """Remembers the ids of words, cores and tails that are not known."""
        text = [p.decode() for p in parts]
        letters = [i for i, t in enumerate(text) if t.isalpha()]
        alone = [i for i, t in enumerate(text) if not t.isalpha()]
        groups = [letters[i:i + JOINED_CORES] for i in range(0, len(letters), JOINED_CORES)]
        for start in range(0, len(groups), 256):
            part = groups[start:start + 256]
            found = self.tokenizer.encode_batch_fast([" ".join([text[i] for i in g]) for g in part], add_special_tokens=False)
            for own, e in zip(part, found):
                ids = np.array(e.ids, dtype=np.int64)
                cuts = np.flatnonzero(self.ends[np.minimum(ids, len(self.ends) - 1)]) + 1
                if len(cuts) != len(own) or cuts[-1] != len(ids):
                    alone += own
                    continue
                data, at = ids.astype("<u2").tobytes(), 0
                for i, cut in zip(own, (2 * cuts).tolist()):
                    self.known[parts[i]] = data[at:cut]
                    at = cut
        for start in range(0, len(alone), 4096):
            own = alone[start:start + 4096]
            for i, e in zip(own, self.tokenizer.encode_batch_fast([text[i] for i in own], add_special_tokens=False)):
                self.known[parts[i]] = np.array(e.ids, dtype="<u2").tobytes()

    def _ids(self, words: list[bytes]) -> list[bytes]:
        """The ids of distinct words."""
        cut = [self._cut(w) for w in words]
        parts = {p for pair in cut for p in pair if p}
        known = self.known
        if len(known) + len(parts) > CACHED_CORES:
            known.clear()
        self._learn([p for p in parts if p not in known])
        out = [known[core] + known[tail] if tail else known[core] if core else b"" for core, tail in cut]
        for part in parts:
            if len(part) > CACHED_CHARS:
                del known[part]
        return out

    def encode(self, texts: pa.StringArray, end_id: int) -> pa.BinaryArray:
        """The ids of each text and the end id, as little-endian 16-bit numbers. Arrow cuts the texts into
        words, numbers the distinct ones and lines their ids up again."""
        split = pc.ascii_split_whitespace(texts)
        coded = split.flatten().cast(pa.binary()).dictionary_encode()
        taken = pa.array(self._ids(coded.dictionary.to_pylist()), pa.binary()).take(coded.indices)
        _, ends, data = taken.buffers()
        at = np.frombuffer(ends, "<i4", len(taken) + 1)[split.offsets.to_numpy()].astype(np.int64)
        ids = np.frombuffer(data, "<u2") if data is not None else np.zeros(0, "<u2")
        out = np.insert(ids[:at[-1] // 2], at[1:] // 2, end_id)
        return pa.BinaryArray.from_buffers(pa.binary(), len(texts), [
            None, pa.py_buffer((at + 2 * np.arange(len(at))).astype("<i4")), pa.py_buffer(out.astype("<u2"))])

    @staticmethod
    def _cut(word: bytes) -> tuple[bytes, bytes]:
        core = word.rstrip(_TAIL)
        # the core must end in an ASCII letter or digit, and no special token may reach across the cut
        if len(core) < len(word) and core[-1:].isalnum() and b"<" not in word:
            # the tokenizer composes marks before it lowers letters, so only a core without them may be lowered here
            return (core.lower() if core.isascii() else core), word[len(core):]
        return (word.lower() if word.isalpha() else word), b""


@lru_cache(maxsize=2)
def _encoder(path: str) -> Encoder:
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return Encoder(path)


def groups(batches: Iterator[pa.RecordBatch], column: int, most: int = GROUP_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows of ``batches`` in batches whose texts have at most so many bytes together (or one row)."""
    held, size = [], 0

    def joined() -> pa.RecordBatch:
        return held[0] if len(held) == 1 else pa.Table.from_batches(held).combine_chunks().to_batches()[0]

    for b in batches:
        sizes = np.cumsum(pc.binary_length(b.column(column)).to_numpy(zero_copy_only=False)) if b.num_rows else np.zeros(0)
        start = 0
        while start < b.num_rows:
            before = sizes[start - 1] if start else 0
            end = int(np.searchsorted(sizes, before + most - size, side="right"))
            if end <= start and held:  # the next text has no room: give what there is
                yield joined()
                held, size = [], 0
                continue
            end = max(end, start + 1)
            held.append(b.slice(start, end - start))
            size += int(sizes[end - 1] - before)
            start = end
    if held:
        yield joined()


# --- the frequency table ---------------------------------------------------------------------
def quantise(counts: np.ndarray, bits: int = TABLE_BITS) -> np.ndarray:
    """Frequencies that sum to 2**bits, at least 1 for every symbol that occurs."""
    total, size = int(counts.sum()), 1 << bits
    seen = np.flatnonzero(counts)
    if len(seen) > size:
        raise ValueError("more symbols than the table has room for")
    freq = np.zeros(len(counts), dtype=np.int64)
    if not total:
        return freq
    freq[seen] = np.maximum(1, counts[seen].astype(np.float64) * size // total)
    order = seen[np.argsort(-counts[seen], kind="stable")]
    rest = size - int(freq.sum())
    if rest > 0:
        freq[order[0]] += rest
    while rest < 0:  # take from the most frequent, which lose least
        give = np.minimum(freq[order] - 1, (freq[order] + 15) // 16)
        give = np.minimum(give, np.maximum(0, -rest - (np.cumsum(give) - give)))
        freq[order] -= give
        rest += int(give.sum())
    return freq


class Table:
    def __init__(self, freq: np.ndarray, bits: int = TABLE_BITS):
        self.freq, self.bits = freq.astype(np.uint64), np.uint64(bits)
        self.start = (np.cumsum(freq) - freq).astype(np.uint64)
        self.mask = np.uint64((1 << bits) - 1)
        self.symbol = np.repeat(np.arange(len(freq), dtype=np.uint32), freq)

    @classmethod
    def load(cls, data: bytes) -> Table:
        bits, n = struct.unpack_from("<II", data)
        return cls(np.frombuffer(data, "<u4", n, 8).astype(np.int64), bits)

    def dump(self) -> bytes:
        return struct.pack("<II", int(self.bits), len(self.freq)) + self.freq.astype("<u4").tobytes()


# --- blocks ----------------------------------------------------------------------------------
def encode_block(ids: np.ndarray, table: Table) -> bytes:
    n = len(ids)
    lanes = int(min(LANES, max(1, n // 64)))
    state = np.full(lanes, LOW, dtype=np.uint64)
    limit = table.freq << np.uint64(63 - int(table.bits))  # above it, a step would overflow 63 bits
    words = []
    for at in range((n - 1) // lanes * lanes if n else -1, -1, -lanes):
        symbols = ids[at:at + lanes]
        x, f = state[:len(symbols)], table.freq[symbols]
        over = x >= limit[symbols]
        words.append(x[over].astype(np.uint32))
        x[over] >>= np.uint64(32)
        q = x // f
        state[:len(symbols)] = (q << table.bits) + (x - q * f) + table.start[symbols]
    stream = np.concatenate(words[::-1]) if words else np.zeros(0, np.uint32)
    return struct.pack("<III", n, lanes, len(stream)) + state.astype("<u8").tobytes() + stream.astype("<u4").tobytes()


def decode_block(data: bytes, table: Table) -> np.ndarray:
    n, lanes, count = struct.unpack_from("<III", data)
    state = np.frombuffer(data, "<u8", lanes, 12).astype(np.uint64)
    stream = np.frombuffer(data, "<u4", count, 12 + 8 * lanes).astype(np.uint64)
    out, used = np.empty(n, dtype=np.uint32), 0
    for at in range(0, n, lanes):
        x = state[:min(lanes, n - at)]
        slot = x & table.mask
        symbols = table.symbol[slot]
        out[at:at + len(x)] = symbols
        x = table.freq[symbols] * (x >> table.bits) + slot - table.start[symbols]
        low = x < LOW
        need = int(low.sum())
        x[low] = (x[low] << np.uint64(32)) | stream[used:used + need]
        used += need
        state[:len(x)] = x
    if used != count or not (state == LOW).all():
        raise ValueError("a block does not decode to its start")
    return out


class Writer:
    """Writes one file: ids in blocks, then the footer."""

    def __init__(self, out, table: Table, block_ids: int = BLOCK_IDS):
        self.out, self.table, self.block_ids = out, table, block_ids
        self.out.write(MAGIC)
        self.at, self.ids, self.blocks, self.docs = len(MAGIC), 0, [], []
        self.waiting: list[np.ndarray] = []
        self.held = 0

    def add(self, doc_id, ids: np.ndarray) -> None:
        self.docs.append((doc_id, len(ids)))
        while len(ids):
            part = ids[:self.block_ids - self.held]
            self.waiting.append(part)
            self.held += len(part)
            ids = ids[len(part):]
            if self.held == self.block_ids:
                self._flush()

    def _flush(self) -> None:
        if self.held:
            ids = np.concatenate(self.waiting)
            data = encode_block(ids, self.table)
            self.out.write(data)
            self.blocks.append((self.at, len(data), self.ids, zlib.crc32(ids.astype("<u4").tobytes())))
            self.at, self.ids = self.at + len(data), self.ids + len(ids)
            self.waiting, self.held = [], 0

    def close(self) -> None:
        self._flush()
        footer = zlib.compress(json.dumps({"blocks": self.blocks, "docs": self.docs}).encode(), 1)
        self.out.write(footer + struct.pack("<I", len(footer)) + MAGIC)
        self.out.close()


class Reader:
    """Reads a file by its checkpoints."""

    def __init__(self, source, table: Table):
        self.source, self.table = source, table
        size = source.size()
        tail = bytes(source.read_at(12, size - 12))
        if tail[4:] != MAGIC or bytes(source.read_at(len(MAGIC), 0)) != MAGIC:
            raise ValueError("not a complete file of ids")
        length = struct.unpack("<I", tail[:4])[0]
        footer = json.loads(zlib.decompress(source.read_at(length, size - 12 - length)))
        self.blocks, self.docs = footer["blocks"], footer["docs"]

    def block(self, i: int) -> np.ndarray:
        offset, length, _, crc = self.blocks[i]
        ids = decode_block(bytes(self.source.read_at(length, offset)), self.table)
        if zlib.crc32(ids.astype("<u4").tobytes()) != crc:
            raise ValueError("a block does not match its checksum")
        return ids

    def slice(self, start: int, count: int) -> np.ndarray:
        """``count`` ids from number ``start`` of the file on; decodes only the blocks that hold them."""
        own = [i for i, (_, _, first, _) in enumerate(self.blocks)
               if first < start + count and (i + 1 == len(self.blocks) or self.blocks[i + 1][2] > start)]
        if not own or count <= 0:
            return np.zeros(0, dtype=np.uint32)
        at = start - self.blocks[own[0]][2]
        return np.concatenate([self.block(i) for i in own])[at:at + count]

    def documents(self) -> Iterator[tuple]:
        """(id, first id's number in the file, ids) in order, block by block."""
        block, at, buffered = 0, 0, np.zeros(0, dtype=np.uint32)
        for doc_id, n in self.docs:
            parts, need = [], n
            while need:
                if not len(buffered):
                    buffered, block = self.block(block), block + 1
                parts.append(buffered[:need])
                buffered, need = buffered[len(parts[-1]):], need - len(parts[-1])
            yield doc_id, at, np.concatenate(parts) if parts else np.zeros(0, dtype=np.uint32)
            at += n


# --- Spark -----------------------------------------------------------------------------------
def _filesystem(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


@lru_cache(maxsize=2)
def _table(folder: str) -> Table:
    fs, root = _filesystem(folder)
    with fs.open_input_file(f"{root}/table.bin") as f:
        return Table.load(f.read())


def symbol_counts(tokens: DataFrame, ids_col: str = "ids") -> np.ndarray:
    """How often each id occurs; one row per task and id is summed, 65,536 at most reach the driver."""
    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << 16, dtype=np.int64)
        for b in batches:  # all ids of a batch lie next to each other in its data buffer
            column = b.column(0)
            data = column.buffers()[2]
            if data is None:
                continue
            ends = np.frombuffer(column.buffers()[1], "<i4", len(column) + 1, 4 * column.offset)
            total += np.bincount(np.frombuffer(data, "<u2", (int(ends[-1]) - int(ends[0])) // 2, int(ends[0])), minlength=1 << 16)
        seen = np.flatnonzero(total)
        yield pa.record_batch([pa.array(seen.astype(np.int32)), pa.array(total[seen])], names=["id", "n"])

    rows = tokens.select(ids_col).mapInArrow(counts, "id int, n long").groupBy("id").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(1 << 16, dtype=np.int64)
    for r in rows:
        out[r["id"]] = r["n"]
    return out[:int(np.flatnonzero(out).max(initial=0)) + 1]


def tokenize(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer: str | None = None,
             end_id: int = END_ID) -> DataFrame:
    """(doc_id, row, ids), stored: the texts are tokenised once. ids: binary, 16 bits each."""
    path = tokenizer or tokenizer_path()
    kind = docs.schema[id_col].dataType.simpleString()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in groups(batches, 2):
            yield pa.record_batch([b.column(0), b.column(1), _encoder(path).encode(b.column(2), end_id)], names=["doc_id", "row", "ids"])

    rows = docs.select(F.col(id_col).alias("doc_id"), F.monotonically_increasing_id().alias("row"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    return stored(rows.mapInArrow(encode, f"doc_id {kind}, row long, ids binary"), "rans-ids")


def write_files(tokens: DataFrame, folder: str, partition_ids: int = PARTITION_IDS, file_ids: int = FILE_IDS,
                block_ids: int = BLOCK_IDS) -> DataFrame:
    """Writes ``tokens`` in ascending order of doc_id (of ids that are numbers or strings) and returns
    the stored index (part, file_no, file, n_ids): files in order of (part, file_no)."""
    counts = symbol_counts(tokens)
    fs, root = _filesystem(folder)
    fs.create_dir(root, recursive=True)
    with fs.open_output_stream(f"{root}/table.bin", compression=None) as f:  # one fixed-size table, written by the driver
        f.write(Table(quantise(counts)).dump())
    parts = max(1, -(-int(counts.sum()) // partition_ids))
    ordered = (tokens.repartitionByRange(parts, F.col("doc_id").asc_nulls_first(), F.col("row"))
               .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), F.col("row")))
    ordered = ordered.select(F.spark_partition_id().alias("part"), "doc_id", "ids")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = _filesystem(folder)
        writer, name, no, part, done = None, "", 0, 0, []

        def close() -> None:
            nonlocal writer, no
            writer.close()
            done.append((part, no, name, writer.ids))
            writer, no = None, no + 1

        for b in batches:
            for part, doc_id, ids in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2)):
                if writer is None:
                    name = f"{uuid.uuid4().hex}.rans"
                    writer = Writer(fs.open_output_stream(f"{root}/{name}", compression=None), _table(folder), block_ids)
                writer.add(doc_id, np.frombuffer(ids.as_buffer(), "<u2"))
                if writer.ids + writer.held >= file_ids:
                    close()
        if writer is not None:
            close()
        if done:
            kinds = (pa.int32(), pa.int32(), pa.string(), pa.int64())
            yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*done), kinds)], names=["part", "file_no", "file", "n_ids"])

    return stored(ordered.mapInArrow(write, "part int, file_no int, file string, n_ids long"), "rans-index")


def read_documents(index: DataFrame, folder: str, id_type: str = "long", with_ids: bool = True) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32, ids) of every document in the files; ``start`` counts the
    ids of all documents before it."""
    # a row per file: the running sum of the parts first, then of the files inside one
    parts = index.groupBy("part").agg(F.sum("n_ids").alias("n"))
    by_part = parts.select("part", (F.sum("n").over(W.orderBy("part")) - F.col("n")).alias("before"))
    inside = F.sum("n_ids").over(W.partitionBy("part").orderBy("file_no")) - F.col("n_ids")
    files = stored(index.select("part", "file", inside.alias("inside")).join(by_part, "part")
                   .select("file", (F.col("before") + F.col("inside")).alias("first")), "rans-files")
    n = max(1, files.count())

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = _filesystem(folder)
        for b in batches:
            for name, first in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                with fs.open_input_file(f"{root}/{name}") as source:
                    rows, size = [], 0
                    for doc_id, at, ids in Reader(source, _table(folder)).documents():
                        data = ids.astype("<u4").tobytes()
                        rows.append((doc_id, first + at, len(ids), zlib.crc32(data), data if with_ids else None))
                        size += len(data) if with_ids else 64
                        if size > 16 << 20:
                            yield _batch(rows)
                            rows, size = [], 0
                    yield _batch(rows)

    kind = T._parse_datatype_string(id_type) if isinstance(id_type, str) else id_type
    is_text = isinstance(kind, T.StringType)

    def _batch(rows: list[tuple]) -> pa.RecordBatch:
        kinds = (pa.string() if is_text else pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
        names = ["doc_id", "start", "n_tokens", "ids_crc32", "ids"]
        columns = list(zip(*rows)) or [[]] * 5
        return pa.record_batch([pa.array(c, t) for c, t in zip(columns, kinds)], names=names)

    found = files.repartition(min(n, 4096), "file").mapInArrow(
        read, f"doc_id {'string' if is_text else 'long'}, start long, n_tokens long, ids_crc32 long, ids binary")
    return found.withColumn("doc_id", F.col("doc_id").cast(kind))


def query(spark, sf_dir) -> DataFrame:
    """op10: all documents are written and read back from the files."""
    docs = table(spark, sf_dir, "documents")
    folder = scratch_path(spark, "rans")
    index = write_files(tokenize(docs), folder)
    return read_documents(index, folder, dict(docs.dtypes)["doc_id"], with_ids=False).select(
        "doc_id", "start", "n_tokens", "ids_crc32")
