"""Exact substring deduplication with a compressed FM-index per shard.

A window is ``window_words`` consecutive words of one document; a word is removed if it is covered by
a window whose word sequence also starts earlier (in a smaller doc_id, or in the same document at an
earlier word). Windows are judged on the input.

Routing. Every window goes to one shard, chosen by its content alone, so that equal windows meet:
its anchor is the run of ``anchor_words`` words of least hash in it (a minimizer). Neighbouring windows
mostly share their anchor and travel together as one segment. So each shard's work is bounded and
the total grows with the text, where streaming every document past every shard's index would grow
with its square. The windows of an anchor that very many documents have are routed one by one by a
hash of all their words, which spreads them over the shards.

Copies. Of a batch's segments with equal words only the earliest goes to the shard. Every window of a
later one starts earlier there, so the later one is removed whole without a search. One at the same place
(another text of the same id) takes over the answer that the shard gives for the one that it got, by a join
that adaptive execution can split. So a shard gets a segment's words at most once per Arrow batch, however
many documents hold them.

In a shard. An anchor that occurs once in the corpus has no repeated window and its segment is
dropped. The distinct other segments are concatenated and indexed: suffixes are sorted, the
Burrows-Wheeler transform is kept in a wavelet matrix of packed bits with rank directories, each eighth place of
the suffix order, and the borders of the suffix intervals of every length up to a window. Then the segments are streamed:
backward search computes the matching statistics from the last word to the first, that is for each word the longest run from
there that the index has elsewhere, too; where it is as long as a window, the suffix interval is reported, and the earliest
place in it is found. Each document's own place is compared with that.

Defined cases: a null text has no words; a text of fewer words than a window loses none. doc_id is a
whole number; null ids come after all others and are one document. Repeated rows (equal id and
text) are one document and lose the same words. Rows of one id with different texts are judged as
parts of one document that start at the same word number.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from costmart.llm.common import stored, table, utf8

WINDOW_WORDS, ANCHOR_WORDS = 20, 5
#: Text that a shard is planned for (before the segments' overlap).
SHARD_BYTES = 6 << 20
#: Anchors that are in this share of a sample of documents are routed window by window. The sample
#: and the list bound the cost of finding them; the result is the same whatever is found.
HOT_SHARE, HOT_SAMPLE, HOT_LIMIT = 0.005, 20_000, 100_000
NO_ID = np.iinfo(np.int64).max
_MUL, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


# --- routing ---------------------------------------------------------------------------------
def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _MIX
    return x ^ (x >> np.uint64(32))


def _runs(hashes: np.ndarray, n: int) -> np.ndarray:
    """A hash of every run of n words."""
    out = np.zeros(len(hashes) - n + 1, dtype=np.uint64)
    for j in range(n):
        out = out * _MUL + hashes[j:len(hashes) - n + 1 + j]
    return _mix(out)


def segments(words: list[bytes], window: int = WINDOW_WORDS, anchor: int = ANCHOR_WORDS, hot: np.ndarray | None = None):
    """(routes, first window, windows) of the segments of a text, as arrays; none if it has no window."""
    if len(words) < window:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    hashes = np.array([xxhash.xxh3_64_intdigest(w) for w in words], dtype=np.uint64)
    runs = _runs(hashes, anchor)
    span = window - anchor + 1
    least = sliding_window_view(runs, span).argmin(axis=1) + np.arange(len(runs) - span + 1)
    cuts = np.flatnonzero(np.diff(least)) + 1
    first = np.concatenate([[0], cuts])
    count = np.diff(np.concatenate([first, [len(least)]]))
    routes = runs[least[first]]
    if hot is not None and len(hot):
        is_hot = hot[np.minimum(np.searchsorted(hot, routes), len(hot) - 1)] == routes
        if is_hot.any():
            whole = _runs(hashes, window)
            single = np.concatenate([np.arange(f, f + c) for f, c in zip(first[is_hot], count[is_hot])])
            routes = np.concatenate([routes[~is_hot], whole[single]])
            first = np.concatenate([first[~is_hot], single])
            count = np.concatenate([count[~is_hot], np.ones(len(single), np.int64)])
    return routes, first, count


def hot_anchors(docs: DataFrame, text_col: str, window: int, anchor: int) -> np.ndarray:
    """Anchors in more than ``HOT_SHARE`` of a sample of documents, sorted."""
    total = docs.count()
    if total == 0:
        return np.zeros(0, np.uint64)
    sample = docs.select(utf8(text_col).alias("text"))
    if total > HOT_SAMPLE:
        sample = sample.sample(fraction=HOT_SAMPLE / total, seed=1)

    def anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for text in b.column(0).to_pylist():
                yield pa.record_batch([pa.array(np.unique(segments(text.split(), window, anchor)[0]).view(np.int64))], names=["anchor"])

    least = max(3, int(min(total, HOT_SAMPLE) * HOT_SHARE))
    rows = (sample.mapInArrow(anchors, "anchor long").groupBy("anchor").count().where(F.col("count") >= least)
            .orderBy(F.desc("count"), "anchor").limit(HOT_LIMIT).collect())
    return np.sort(np.array([r["anchor"] for r in rows], dtype=np.int64).view(np.uint64))


_ROW = np.dtype([("route", "<u8"), ("doc", "<i8"), ("th", "<i8"), ("start", "<i4"), ("windows", "<i4")])
#: Words [start, end) to remove, found in the segment that starts at ``seg``. If ``of`` is not ``th``, it says
#: instead that the text ``th`` loses what the text ``of`` of that id loses in that segment.
_FOUND = np.dtype([("doc", "<i8"), ("th", "<i8"), ("of", "<i8"), ("seg", "<i4"), ("start", "<i4"), ("end", "<i4")])


def without_copies(rows: np.ndarray, contents: list[bytes], window: int) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of the segments to search, the earliest of each content, and what is ``_FOUND`` of the others.
    No two segments may have equal doc, th and start."""
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, contents), np.uint64, len(contents))
    _, which, times = np.unique(hashes, return_inverse=True, return_counts=True)
    often = np.flatnonzero(times[which] > 1)
    number: dict[bytes, int] = {}
    text = np.array([number.setdefault(contents[i], len(number)) for i in often.tolist()], dtype=np.int64)
    order = np.lexsort((rows["th"][often], rows["start"][often], rows["doc"][often], text))
    new = np.diff(text[order], prepend=-1) != 0
    order = often[order]
    least = order[new][np.cumsum(new) - 1]
    same = (rows["doc"][order] == rows["doc"][least]) & (rows["start"][order] == rows["start"][least])
    search = np.ones(len(rows), dtype=bool)
    search[order[~new]] = False

    later = order[~same]
    later = rows[later[np.lexsort((rows["start"][later], rows["th"][later], rows["doc"][later]))]]
    end = later["start"] + later["windows"] + window - 1
    # neighbours of a text make one interval; ends grow with the starts
    apart = np.ones(len(later), dtype=bool)
    apart[1:] = (later["doc"][1:] != later["doc"][:-1]) | (later["th"][1:] != later["th"][:-1]) | (later["start"][1:] > end[:-1])
    gone = np.zeros(int(apart.sum()), _FOUND)
    gone["doc"], gone["th"], gone["of"], gone["seg"] = later["doc"][apart], later["th"][apart], later["th"][apart], -1
    gone["start"], gone["end"] = later["start"][apart], end[np.append(apart[1:], True)] if len(later) else end

    twin = same & ~new
    alike = np.zeros(int(twin.sum()), _FOUND)
    alike["doc"], alike["th"], alike["of"], alike["seg"] = (rows["doc"][order[twin]], rows["th"][order[twin]],
                                                            rows["th"][least[twin]], rows["start"][order[twin]])
    return np.flatnonzero(search), np.concatenate([gone, alike])


def _routed(docs: DataFrame, shards: int, window: int, anchor: int, hot: np.ndarray) -> DataFrame:
    """(shard, rows, contents): of each batch, a shard's segments; compressed. Where contents is null, rows
    are what is ``_FOUND`` already; they are dealt evenly."""
    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        zip_ = zstandard.ZstdCompressor(level=1).compress
        for b in batches:
            rows, contents, seen = [], [], set()
            for doc, th, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist()):
                if (doc, th) in seen:
                    continue
                seen.add((doc, th))
                words = text.split()
                routes, first, count = segments(words, window, anchor, hot)
                if not len(routes):
                    continue
                own = np.zeros(len(routes), _ROW)
                own["route"], own["doc"], own["th"], own["start"], own["windows"] = routes, NO_ID if doc is None else doc, th, first, count
                rows.append(own)
                joined = b" ".join(words)
                at = np.concatenate([[0], np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)])
                contents += [joined[s:e] for s, e in zip(at[first].tolist(), (at[first + count + window - 1] - 1).tolist())]
            if not rows:
                continue
            rows = np.concatenate(rows)
            search, known = without_copies(rows, contents, window)
            rows, contents = rows[search], [contents[i] for i in search.tolist()]
            shard = (_mix(rows["route"]) % np.uint64(shards)).astype(np.int64)
            order = np.argsort(shard, kind="stable")
            bounds = np.flatnonzero(np.diff(shard[order], prepend=-1, append=shards))
            out = [(int(shard[order[s]]), zip_(rows[order[s:e]].tobytes()), zip_(b"\n".join([contents[i] for i in order[s:e].tolist()])))
                   for s, e in zip(bounds[:-1], bounds[1:])]
            if len(known):
                packed = zip_(known.tobytes())
                out.append((xxhash.xxh3_64_intdigest(packed) % shards, packed, None))
            for i in range(0, len(out), 64):
                yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*out[i:i + 64]), (pa.int32(), pa.binary(), pa.binary()))],
                                      names=["shard", "rows", "contents"])

    return docs.mapInArrow(route, "shard int, rows binary, contents binary")


# --- the index -------------------------------------------------------------------------------
class WaveletMatrix:
    """A sequence of numbers below 2**levels as bit vectors, one per level, with rank directories."""

    def __init__(self, values: np.ndarray, levels: int):
        self.n, self.levels, self.bits, self.ranks, self.zeros = len(values), levels, [], [], []
        for level in range(levels - 1, -1, -1):
            bit = ((values >> level) & 1).astype(bool)
            packed = np.zeros(len(values) // 64 + 1, dtype="<u8")
            packed.view(np.uint8)[:-(-len(values) // 8)] = np.packbits(bit, bitorder="little")
            ones = np.bitwise_count(packed).astype(np.int64)
            self.bits.append(packed)
            self.ranks.append((np.cumsum(ones) - ones).astype(np.int32))
            self.zeros.append(int(len(values) - bit.sum()))
            values = np.concatenate([values[~bit], values[bit]])

    def rank(self, symbols: np.ndarray, upto: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before each position, plus the symbol's own offset: positions in
        the last level's order, of which only differences between equal symbols matter."""
        at = upto
        for i in range(self.levels):
            word = at >> 6
            below = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
            ones = self.ranks[i][word] + np.bitwise_count(self.bits[i][word] & below)
            bit = (symbols >> (self.levels - 1 - i)) & 1
            at = np.where(bit == 1, self.zeros[i] + ones, at - ones)
        return at

    def access(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbol at each position, and ``rank`` of it there."""
        symbols = np.zeros(len(at), dtype=np.int64)
        for i in range(self.levels):
            word, shift = self.bits[i][at >> 6], (at & 63).astype(np.uint64)
            bit = ((word >> shift) & np.uint64(1)).astype(np.int64)
            ones = self.ranks[i][at >> 6] + np.bitwise_count(word & ((np.uint64(1) << shift) - np.uint64(1)))
            symbols = symbols * 2 + bit
            at = np.where(bit == 1, self.zeros[i] + ones, at - ones)
        return symbols, at


class Marks:
    """A bit vector with a rank directory."""

    def __init__(self, marked: np.ndarray):
        self.bits = np.zeros(len(marked) // 64 + 1, dtype="<u8")
        self.bits.view(np.uint8)[:-(-len(marked) // 8)] = np.packbits(marked, bitorder="little")
        ones = np.bitwise_count(self.bits).astype(np.int64)
        self.ranks = (np.cumsum(ones) - ones).astype(np.int32)

    def at(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Whether each place is marked, and how many are before it."""
        word, shift = self.bits[places >> 6], (places & 63).astype(np.uint64)
        before = self.ranks[places >> 6] + np.bitwise_count(word & ((np.uint64(1) << shift) - np.uint64(1)))
        return (word >> shift) & np.uint64(1) == 1, before


class Borders:
    """For every length up to ``depth`` the places between suffixes that share fewer words, as bits: where the suffix
    intervals of that length end."""

    def __init__(self, shared: np.ndarray, depth: int):
        words = len(shared) // 64 + 1
        self.words = words
        self.bits = np.zeros((depth + 1, words), dtype="<u8")
        for length in range(1, depth + 1):
            self.bits[length].view(np.uint8)[:-(-len(shared) // 8)] = np.packbits(shared < length, bitorder="little")
        filled, number = self.bits != 0, np.arange(words, dtype=np.int32)
        self.left = np.maximum.accumulate(np.where(filled, number, np.int32(0)), axis=1).ravel()
        self.right = np.minimum.accumulate(np.where(filled, number, np.int32(words - 1))[:, ::-1], axis=1)[:, ::-1].ravel()
        self.bits = self.bits.ravel()

    def around(self, length: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The interval of that length, at least 1, around each [lo, hi)."""
        row, one = length * self.words, np.uint64(1)
        word, shift = lo >> 6, (lo & 63).astype(np.uint64)
        own = self.bits[row + word] & ((one << shift) | ((one << shift) - one))
        none = own == 0
        word = np.where(none, self.left[row + np.maximum(word - 1, 0)], word)
        own = np.where(none, self.bits[row + word], own)
        for s in (1, 2, 4, 8, 16, 32):
            own = own | (own >> np.uint64(s))
        first = word * 64 + np.bitwise_count(own).astype(np.int64) - 1

        word, shift = hi >> 6, (hi & 63).astype(np.uint64)
        own = self.bits[row + word] & ~((one << shift) - one)
        none = own == 0
        word = np.where(none, self.right[row + np.minimum(word + 1, self.words - 1)], word)
        own = np.where(none, self.bits[row + word], own)
        return first, word * 64 + np.bitwise_count(~own & (own - one)).astype(np.int64)


def suffix_order(tokens: np.ndarray) -> np.ndarray:
    """All suffixes in order, by prefix doubling. Token 0 ends each text; the ends differ from each other, so no two
    suffixes are equal and the order is that of the texts' own suffixes."""
    n, ends = len(tokens), tokens == 0
    rank = np.where(ends, np.cumsum(ends) - 1, tokens + int(ends.sum())).astype(np.int64)
    order, have = np.argsort(rank), 1
    while True:
        sorted_rank = rank[order]
        new = np.empty(n, dtype=np.int64)
        new[order] = np.cumsum(np.concatenate([[0], sorted_rank[1:] != sorted_rank[:-1]]))
        if int(new.max(initial=0)) == n - 1:
            return order.astype(np.int32)
        behind = np.zeros(n, dtype=np.int64)
        behind[:max(n - have, 0)] = new[have:] + 1
        rank = new * (n + 1) + behind
        order = np.argsort(rank)
        have *= 2


def shared_words(tokens: np.ndarray, order: np.ndarray, depth: int) -> np.ndarray:
    """How many words, at most ``depth``, each suffix shares with the one before it in order; 0 at both ends."""
    padded = np.concatenate([tokens, np.full(depth, -1, dtype=tokens.dtype)])
    shared = np.zeros(len(order) + 1, dtype=np.int8)
    alike = np.arange(1, len(order))
    for j in range(depth):
        mine = padded[order[alike] + j]
        alike = alike[(padded[order[alike - 1] + j] == mine) & (mine > 0)]
        if not len(alike):
            break
        shared[alike] = j + 1
    return shared


class FMIndex:
    """Counts and places of word sequences in a concatenation of texts. Token 0 ends each text. Of the suffix order only each
    ``rate``-th place of a text is kept; the others are found by walking back to one."""

    def __init__(self, tokens: np.ndarray, depth: int, rate: int = 8):
        order = suffix_order(tokens)
        self.n, self.depth = len(tokens), depth
        self.shared = shared_words(tokens, order, depth)
        self.borders = Borders(self.shared, depth)
        bwt = tokens[order - 1]  # of the suffix at 0, the last token
        symbols = int(tokens.max(initial=0)) + 1
        counts = np.bincount(tokens, minlength=symbols)
        self.first = np.cumsum(counts) - counts  # of each symbol, where its suffixes begin
        self.wavelet = WaveletMatrix(bwt.astype(np.int64), max(1, (symbols - 1).bit_length()))
        self.offset = self.wavelet.rank(np.arange(symbols), np.zeros(symbols, dtype=np.int64))
        place = np.arange(len(tokens))
        begins = np.concatenate([[True], tokens[:-1] == 0])[:len(tokens)]
        kept = (place - np.maximum.accumulate(np.where(begins, place, 0))) % rate == 0
        self.marks = Marks(kept[order])
        self.samples = order[kept[order]]

    def extend(self, symbols: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The suffix intervals of each sequence with the symbol put before it."""
        both = self.wavelet.rank(np.concatenate([symbols, symbols]), np.concatenate([lo, hi]))
        move = self.first[symbols] - self.offset[symbols]
        return both[:len(lo)] + move, both[len(lo):] + move

    def places(self, rows: np.ndarray) -> np.ndarray:
        """Where the suffixes of these numbers in order begin."""
        out, todo, steps = np.zeros(len(rows), dtype=np.int64), np.arange(len(rows)), 0
        while len(todo):
            known, before = self.marks.at(rows)
            out[todo[known]] = self.samples[before[known]] + steps
            todo, rows = todo[~known], rows[~known]
            symbols, rows = self.wavelet.access(rows)
            rows, steps = rows + self.first[symbols] - self.offset[symbols], steps + 1
        return out


def matching_statistics(index: FMIndex, tokens: np.ndarray, starts: np.ndarray, lengths: np.ndarray, least: int):
    """Streams the indexed texts (tokens[start:start + length]) by backward search. For each offset the length of the longest
    run of words from there, at most the index's depth, that is in the index more than once: (text, offset, length, lo, hi) where
    it is ``least`` or more, with its suffix interval.

    A word more is put before the run that the last offset had; if that is in one place only, the run loses the words
    behind, to the next wider interval, and it is tried again. A text is left where what is ahead of it is too short.
    """
    lane = np.flatnonzero(lengths >= max(least, 1))
    at = lengths[lane].astype(np.int64)
    length, lo, hi = np.zeros(len(lane), np.int64), np.zeros(len(lane), np.int64), np.full(len(lane), index.n, np.int64)
    found: list[tuple[np.ndarray, ...]] = []
    while len(lane):
        a, b = index.extend(tokens[starts[lane] + at - 1], lo, hi)
        more = b - a > 1
        lo, hi = np.where(more, a, lo), np.where(more, b, hi)
        at = at - (more | (length == 0))
        shorter = np.flatnonzero(~more & (length > 0))
        length = length + more
        length[shorter] = np.maximum(index.shared[lo[shorter]], index.shared[hi[shorter]])
        whole = shorter[length[shorter] == 0]
        lo[whole], hi[whole] = 0, index.n
        longer = np.flatnonzero(length > index.depth)
        length[longer] = index.depth
        wider = np.concatenate([shorter[length[shorter] > 0], longer])
        if len(wider):
            lo[wider], hi[wider] = index.borders.around(length[wider], lo[wider], hi[wider])
        told = more & (length >= least)
        if told.any():
            found.append((lane[told], at[told], length[told], lo[told], hi[told]))
        on = (at > 0) & (length + at >= least)
        if not on.all():
            lane, at, length, lo, hi = lane[on], at[on], length[on], lo[on], hi[on]
    if not found:
        return tuple(np.zeros(0, dtype=np.int64) for _ in range(5))
    return tuple(np.concatenate(c) for c in zip(*found))


def shard_intervals(rows: np.ndarray, contents: list[bytes], window: int) -> np.ndarray:
    """``_FOUND`` words to remove, from all segments of one shard."""
    none = np.zeros(0, _FOUND)
    _, which, times = np.unique(rows["route"], return_inverse=True, return_counts=True)
    often = np.flatnonzero(times[which] > 1)
    if not len(often):
        return none
    rows = rows[often]
    number: dict[bytes, int] = {}
    text = np.array([number.setdefault(contents[i], len(number)) for i in often.tolist()], dtype=np.int64)
    words: dict[bytes, int] = {}
    split = [c.split(b" ") for c in number]
    lengths = np.array([len(s) for s in split], dtype=np.int64)
    starts = np.cumsum(lengths + 1) - lengths - 1
    tokens = np.zeros(int(lengths.sum()) + len(split), dtype=np.int64)
    tokens[np.repeat(starts, lengths) + np.arange(int(lengths.sum())) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = \
        np.fromiter((words.setdefault(w, len(words) + 1) for s in split for w in s), np.int64, int(lengths.sum()))
    # the first place of each text is the first place of all its windows there
    order = np.lexsort((rows["start"], rows["doc"], text))
    begin = np.flatnonzero(np.diff(text[order], prepend=-1))
    first_doc, first_start = rows["doc"][order][begin], rows["start"][order][begin].astype(np.int64)

    index = FMIndex(tokens, window)
    found_text, at, _, lo, hi = matching_statistics(index, tokens, starts, lengths, window)
    # earliest place of each text's windows: its own first place, unless the interval has an earlier one
    n_windows = lengths - window + 1
    base = np.cumsum(n_windows) - n_windows
    own = np.repeat(np.arange(len(split)), n_windows)
    offset = np.arange(int(n_windows.sum())) - base[own]
    best_doc, best_start = first_doc[own], first_start[own] + offset
    if len(lo):
        intervals, which = np.unique(lo, return_inverse=True)
        ends = np.zeros(len(intervals), dtype=np.int64)
        ends[which] = hi
        place = index.places(np.repeat(intervals, ends - intervals) + _within(ends - intervals))
        in_text = np.searchsorted(starts, place, side="right") - 1
        key = np.lexsort((first_start[in_text] + place - starts[in_text], first_doc[in_text], np.repeat(np.arange(len(intervals)), ends - intervals)))
        least = key[np.cumsum(ends - intervals) - (ends - intervals)]
        slot = base[found_text] + at
        best_doc[slot] = first_doc[in_text[least]][which]
        best_start[slot] = (first_start[in_text[least]] + place[least] - starts[in_text[least]])[which]
    # each row's windows against the earliest place
    count = n_windows[text]
    row = np.repeat(np.arange(len(rows)), count)
    offset = _within(count)
    slot = base[text[row]] + offset
    doc, start = rows["doc"][row], rows["start"][row] + offset
    gone = (best_doc[slot] < doc) | ((best_doc[slot] == doc) & (best_start[slot] < start))
    if not gone.any():
        return none
    # neighbouring windows of a row make one interval
    row, start = row[gone], start[gone]
    new = np.concatenate([[True], (row[1:] != row[:-1]) | (start[1:] != start[:-1] + 1)])
    last = np.concatenate([np.flatnonzero(new)[1:] - 1, [len(row) - 1]])
    out = np.zeros(int(new.sum()), none.dtype)
    out["doc"], out["th"], out["of"] = rows["doc"][row[new]], rows["th"][row[new]], rows["th"][row[new]]
    out["seg"] = rows["start"][row[new]]
    out["start"], out["end"] = start[new], start[last] + window
    return out


def _within(counts: np.ndarray) -> np.ndarray:
    """0 .. count - 1 for each count, one after the other."""
    return np.arange(int(counts.sum())) - np.repeat(np.cumsum(counts) - counts, counts)


# --- Spark -----------------------------------------------------------------------------------
def repeated_intervals(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW_WORDS,
                       anchor: int = ANCHOR_WORDS, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """(doc, th, intervals): word ranges [start, end) to remove of each document that has any; ``th`` is
    xxhash64 of the text and ``doc`` the id, or the largest long for null."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc"), F.xxhash64(text_col).alias("th"), utf8(text_col).alias("text"))
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = max(1, -(-total // shard_bytes))
    routed = _routed(rows, shards, window, anchor, hot_anchors(docs, text_col, window, anchor))

    def search(group: pa.Table) -> pa.Table:
        import zstandard

        unzip = zstandard.ZstdDecompressor().decompress
        segments_, contents, out = [np.zeros(0, _ROW)], [], []
        for r, c in zip(group.column("rows"), group.column("contents")):
            if c.is_valid:
                segments_.append(np.frombuffer(unzip(r.as_py()), _ROW))
                contents += unzip(c.as_py()).split(b"\n")
            else:
                out.append(np.frombuffer(unzip(r.as_py()), _FOUND))
        out = np.concatenate([shard_intervals(np.concatenate(segments_), contents, window), *out])
        return pa.table({c: np.ascontiguousarray(out[c]) for c in _FOUND.names})

    found = routed.groupBy("shard").applyInArrow(search, "doc long, th long, of long, seg int, start int, end int")
    found = stored(found, "substring-found")
    own = found.where(F.col("of") == F.col("th"))
    alike = found.where(F.col("of") != F.col("th")).select("doc", "of", "seg", "th").distinct()
    theirs = own.where("seg >= 0").select("doc", "of", "seg", "start", "end").distinct().join(alike, ["doc", "of", "seg"])
    found = own.select("doc", "th", "start", "end").unionByName(theirs.select("doc", "th", "start", "end"))
    return found.groupBy("doc", "th").agg(F.collect_set(F.struct("start", "end")).alias("intervals"))


def kept_words(words: list[bytes], intervals) -> list[bytes]:
    gone = np.zeros(len(words) + 1, dtype=np.int64)
    for start, end in intervals:
        gone[start] += 1
        gone[end] -= 1
    keep = np.cumsum(gone)[:-1] == 0
    return [w for w, k in zip(words, keep.tolist()) if k]


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW_WORDS,
                anchor: int = ANCHOR_WORDS, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """(id, n_words, n_removed, kept): a row per row of ``docs``; kept words are joined by one space."""
    found = repeated_intervals(docs, id_col, text_col, window, anchor, shard_bytes)
    found = stored(found.select(F.col("doc").alias("i_doc"), F.col("th").alias("i_th"), "intervals"), "substring-intervals")
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(id_col).cast("long"), F.lit(int(NO_ID))).alias("doc"),
                       F.xxhash64(text_col).alias("th"), utf8(text_col).alias("text"))
    joined = rows.join(found, (F.col("doc") == F.col("i_doc")) & (F.col("th") == F.col("i_th")), "left")
    kind = dict(docs.dtypes)[id_col]

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, removed, kept = [], [], []
            for text, gone in zip(b.column(1).to_pylist(), b.column(2).to_pylist()):
                words = text.split()
                left = kept_words(words, [(g["start"], g["end"]) for g in gone]) if gone else words
                n.append(len(words))
                removed.append(len(words) - len(left))
                kept.append(b" ".join(left))
            yield pa.record_batch([b.column(0), pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.binary())],
                                  names=["id", "n_words", "n_removed", "kept"])

    out = joined.select("id", "text", "intervals").mapInArrow(keep, f"id {kind}, n_words long, n_removed long, kept binary")
    return out.withColumn("kept", F.col("kept").cast("string"))


def query(spark, sf_dir) -> DataFrame:
    """op6: all documents, windows of 20 words."""
    found = deduplicate(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), "n_words", "n_removed", F.sha2(F.col("kept"), 256).alias("kept_sha256"))


ORACLE = r"""
WITH d AS (SELECT doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
win AS (
  SELECT doc_id, p, array_to_string(list_slice(w, p, p + 19), ' ') AS t
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS p FROM d WHERE len(w) >= 20)),
dup AS (SELECT doc_id, p FROM (SELECT doc_id, p, row_number() OVER (PARTITION BY t ORDER BY doc_id, p) AS k FROM win) WHERE k > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(p, p + 20)) AS q FROM dup),
kept AS (
  SELECT x.doc_id, string_agg(x.word, ' ' ORDER BY x.q) AS t, count(*) AS n
  FROM (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS q FROM d) x
  LEFT JOIN gone ON gone.doc_id = x.doc_id AND gone.q = x.q WHERE gone.q IS NULL GROUP BY x.doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
  sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""
