"""Byte-substring deduplication with a logarithmic family of suffix arrays for each shard.

A window is ``length`` consecutive bytes of one text. A byte goes if a window
that covers it also starts earlier: in a document with a smaller id, or further
in front in its own.

Windows go to a shard by the least hash of their 16-byte grams; neighbours
mostly share it and travel as one segment, and equal windows always meet. A
slice of documents sends each distinct segment once: equal ones (compared byte
by byte) behind the first are settled where they are, so a passage that very
many documents share leaves a slice once. Shards that would get far more than
the mean are split by further grams, as in :mod:`strutwise.llm.substrings`.

A shard takes its segments in order of documents, a batch at a time. Segments
whose key no other has, and which hold it once, can't repeat and stay out, and so
do windows of the others whose hash no other window has. Each
batch gets a suffix array, which settles repeats inside the batch; what is left
is merge-scanned against every level of the family, and what no level has
becomes a new level. Levels of a like size merge, so ``n`` batches make at most
about ``log2 n`` levels. All comparisons are of whole windows: no hash decides.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strutwise.llm.batches import by_size, bytes_of
from strutwise.llm.common import by_shard
from strutwise.llm.substrings import LAST, _grouped, _opened, _pack, _Routes, _routes, _runs, _squeezed, _taken, _unpack
from strutwise.llm.words import mixed, sequences

#: Bytes of a window, and of the grams that route it.
WINDOW, GRAM = 100, 16
#: Bytes of text in a slice, for each shard, and in a batch of a shard.
SLICE_BYTES, SHARD_BYTES, BATCH = 4 << 20, 8 << 20, 1 << 18
#: Bytes that are hashed at once.
PIECE = 1 << 16
#: Bytes that are compared at once.
STEP = 1 << 20
_SENT = "shard int, kind int, body binary"
_SPANS = "id long, hash long, spans binary"
_BYTE = np.random.default_rng(23).integers(0, 1 << 64, 256, dtype=np.uint64)
_BASE = 0x9E3779B97F4A7C15


def _segments(raw: np.ndarray, doc: np.ndarray, routes: _Routes, base: int = 0, marked: bool = True) -> list[np.ndarray]:
    """Segments of a slice for shards from ``base`` on: start, windows, key, shard, a hash of the bytes, and (if ``marked``) whether the key lies in it more than once."""
    length, gram = routes.length, routes.gram
    many, found = length - gram + 1, []
    powers = np.full(PIECE + length, _BASE, dtype=np.uint64)
    powers[0] = 1
    back = np.full(len(powers), pow(_BASE, -1, 1 << 64), dtype=np.uint64)
    back[0] = 1
    with np.errstate(over="ignore"):
        powers, back = np.cumprod(powers), np.cumprod(back)
        for a in range(0, len(raw) - length + 1, PIECE):
            part = raw[a : a + PIECE + length - 1]
            at = np.flatnonzero(doc[a : a + len(part) - length + 1] == doc[a + length - 1 : a + len(part)])
            if not len(at):
                continue
            spread = _BYTE[part]
            grams = sequences(spread, gram)
            key, shard = routes.keys(grams, at)
            if base:
                own = np.flatnonzero(shard >= base)
                if not len(own):
                    continue
                at, key, shard = at[own], key[own], shard[own]
            opens = np.flatnonzero(_opened(at, key, doc[at + a]))
            start, windows = at[opens], np.diff(np.r_[opens, len(at)])
            sums = np.zeros(len(part) + 1, dtype=np.uint64)
            np.cumsum(spread * powers[: len(part)], out=sums[1:])
            like = mixed((sums[start + windows + length - 1] - sums[start]) * back[start] + windows.astype(np.uint64))
            again = windows > many
            if marked:
                # all windows of a segment have one least gram: the first place of the first and the last of the last differ if it has several
                every = np.lib.stride_tricks.sliding_window_view(grams, many)
                low = start + every[start].argmin(axis=1)
                high = start + windows + many - 2 - every[start + windows - 1][:, ::-1].argmin(axis=1)
                again |= low != high
            found.append([start + a, windows, key[opens], shard[opens], like, again])
    if not found:
        return [np.zeros(0, dtype=t) for t in (np.int64, np.int64, np.uint64, np.int64, np.uint64, bool)]
    return [np.concatenate(x) for x in zip(*found)]


def _weigh(routes: _Routes, slice_bytes: int):
    """Bytes that each shard of the last level would get, summed over what a task reads."""
    base, length = int(routes.bases[-2]), routes.length

    def run(batches):
        total: dict[int, int] = {}
        for batch in by_size(batches, "text", slice_bytes):
            raw, edges = bytes_of(batch.column(0))
            doc = np.repeat(np.arange(len(edges) - 1), np.diff(edges))
            _, windows, _, shard, like, _ = _segments(raw, doc, routes, base, marked=False)
            _, first = np.unique(like, return_index=True)
            found, where = np.unique(shard[first] - base, return_inverse=True)
            for s, w in zip(found.tolist(), np.bincount(where, weights=windows[first] + length - 1).astype(np.int64).tolist()):
                total[s] = total.get(s, 0) + w
        yield pa.RecordBatch.from_pydict({"shard": pa.array(list(total), pa.int32()), "words": pa.array(list(total.values()), pa.int64())})

    return run


def _portions(size: np.ndarray, step: int = STEP):
    """Slices of segments that hold about ``step`` bytes together, one after another."""
    block = np.cumsum(size) // step
    cuts = np.flatnonzero(np.r_[True, block[1:] != block[:-1], True]) if len(block) else []
    for a, b in zip(cuts[:-1], cuts[1:]):
        yield slice(int(a), int(b))


def _drawn(text: np.ndarray, offset: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The bytes of segments, one after another; places are made for a portion at a time."""
    out, at = np.empty(int(size.sum()), dtype=text.dtype), 0
    for own in _portions(size):
        part = text[_taken(offset[own], size[own])]
        out[at : at + len(part)] = part
        at += len(part)
    return out


def _likes(text: np.ndarray, size: np.ndarray) -> np.ndarray:
    """A hash of the bytes of each segment of a text."""
    like, at = np.empty(len(size), dtype=np.uint64), 0
    with np.errstate(over="ignore"):
        for own in _portions(size, PIECE):
            z = size[own]
            ends = np.cumsum(z)
            sums = np.zeros(int(ends[-1]) + 1, dtype=np.uint64)
            np.cumsum(mixed(_BYTE[text[at : at + len(sums) - 1]] + (np.arange(len(sums) - 1) - np.repeat(ends - z, z)).astype(np.uint64)), out=sums[1:])
            like[own] = sums[ends] - sums[ends - z]
            at += len(sums) - 1
    return like


def _copies(text: np.ndarray, offset: np.ndarray, size: np.ndarray, like: np.ndarray, ids: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which segments, in order of documents and starts, are equal to an earlier one that takes their place."""
    order, groups = _grouped(like, stable=True)
    count = np.diff(np.r_[groups, len(order)])
    first = np.empty(len(order), dtype=np.int64)
    first[order] = np.repeat(order[groups], count)
    before = np.empty(len(order), dtype=np.int64)
    before[order] = np.r_[order[:1], order[:-1]]
    earlier = np.where(ids[first] < ids, first, before)
    asks = np.flatnonzero((first != np.arange(len(order))) & ((ids[first] < ids) | ((ids[before] == ids) & (hashes[before] == hashes))) & (size[earlier] == size))
    gone = np.zeros(len(order), dtype=bool)
    upto = np.cumsum(size[asks])
    for k in range(0, int(upto[-1]) if len(asks) else 0, STEP):
        own = asks[np.searchsorted(upto, k, "right") : np.searchsorted(upto, k + STEP, "right")]
        if len(own):
            same = text[_taken(offset[own], size[own])] == text[_taken(offset[earlier[own]], size[own])]
            gone[own] = np.logical_and.reduceat(same, np.cumsum(size[own]) - size[own])
    return gone


def _send(routes: _Routes, slice_bytes: int):
    """For each shard the distinct segments of a slice (kind 0); spans that the slice settles itself (kind 1)."""
    length = routes.length

    def run(batches):
        for batch in by_size(batches, "text", slice_bytes):
            ids = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            hashes = batch.column(1).to_numpy(zero_copy_only=False).astype(np.int64)
            raw, edges = bytes_of(batch.column(2))
            doc = np.repeat(np.arange(len(ids)), np.diff(edges))
            start, windows, key, shard, like, again = _segments(raw, doc, routes)
            if not len(start):
                continue
            place = np.empty(len(ids), dtype=np.int64)
            ranked = np.lexsort((hashes, ids))
            place[ranked] = np.arange(len(ids))
            once = np.r_[True, (ids[ranked][1:] != ids[ranked][:-1]) | (hashes[ranked][1:] != hashes[ranked][:-1])]
            single = np.zeros(len(ids), dtype=bool)
            single[ranked[once]] = True  # a row repeated with its id and text is one document
            d = doc[start]
            order = np.lexsort((start, place[d]))
            order = order[single[d[order]]]
            start, windows, key, shard, like, again, d = (x[order] for x in (start, windows, key, shard, like, again, d))
            size = windows + length - 1
            inside = start - edges[d]
            gone = _copies(raw, start, size, like, ids[d], hashes[d])
            if gone.any():
                g = d[gone]
                body = _pack(ids[g].view("<u8"), hashes[g].view("<u8"), inside[gone].astype("<u4"), (inside + size)[gone].astype("<u4"))
                yield pa.RecordBatch.from_pydict({"shard": pa.array([int(like[0] % np.uint64(routes.levels[0][0]))], pa.int32()), "kind": pa.array([1], pa.int32()), "body": pa.array([body], pa.binary())})
            kept = np.flatnonzero(~gone)
            order, groups = _grouped(shard[kept], stable=True)
            order = kept[order]
            start, size, windows, again, key, inside, rank = (x[order] for x in (start, size, windows, again, key, inside, place[d]))
            # segments of a shard follow each other, documents in order: steps from one to the next
            leads = np.zeros(len(order), dtype=bool)
            leads[groups] = True
            onward, moves = np.r_[True, rank[1:] != rank[:-1]][: len(rank)], np.diff(inside, prepend=0)
            moves[groups] = inside[groups]
            news, steps = leads | onward, (onward & ~leads).astype("<u1")
            turns, bits, check = windows << 1 | again, moves.astype("<u4"), key.astype("<u4")
            ends, shards = np.r_[groups[1:], len(order)], shard[order[groups]]
            sizes = np.add.reduceat(size, groups) if len(groups) else size
            for part in _portions(sizes):
                g, h = part.start, part.stop
                text = raw[_taken(start[groups[g] : ends[h - 1]], size[groups[g] : ends[h - 1]])]
                bodies, at = [], 0
                for k in range(g, h):
                    own, upto = slice(groups[k], ends[k]), at + int(sizes[k])
                    rows = ranked[rank[own][news[own]]]
                    wide = turns[own]
                    bodies.append(_pack(
                        ids[rows].view("<u8"), hashes[rows].astype("<u4"), steps[own], bits[own],
                        wide.astype("<u4" if wide.max() >= 1 << 16 else "<u2"), check[own], text[at:upto], level=3,
                    ))
                    at = upto
                for k in range(0, len(bodies), 64):
                    some = bodies[k : k + 64]
                    yield pa.RecordBatch.from_pydict({"shard": pa.array(shards[g + k : g + k + len(some)], pa.int32()), "kind": pa.array([0] * len(some), pa.int32()), "body": pa.array(some, pa.binary())})

    return run


def suffix_order(text: np.ndarray, at: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """The places ``at`` (ascending) by the ``length`` bytes that follow, equals by place; and whether each begins a new value.

    Prefix doubling; a rank, the rank further on and the place are one packed
    number, so each round is one plain sort. ``text`` has under 2**20 bytes.
    """
    n = len(text)
    bits = np.uint64(max(1, n.bit_length()))
    mask, every = (np.uint64(1) << bits) - np.uint64(1), np.arange(n, dtype=np.uint64)
    rank, reach = np.zeros(n, dtype=np.uint64), min(length, 5)
    for k in range(reach):
        rank = rank << np.uint64(8)
        rank[: n - k] |= text[k:]
    width = np.uint64(0)
    while True:
        own = at if reach >= length else None
        packed = (rank << bits | every) if own is None else (rank[own] << bits | every[own])
        packed.sort()
        opens = np.r_[True, packed[1:] >> bits != packed[:-1] >> bits][: len(packed)]
        places = packed & mask
        if own is not None:
            return places.astype(np.int64), opens
        rank = np.empty(n, dtype=np.uint64)
        rank[places] = np.cumsum(opens)
        step, width = min(reach, length - reach), bits
        ahead = np.zeros(n, dtype=np.uint64)
        ahead[: n - step] = rank[step:]
        rank = rank << width | ahead
        reach += step


def _words(text: np.ndarray, length: int) -> np.ndarray:
    """The 8 bytes from each place on as one number, in an order like that of the bytes; room for a window behind the end."""
    out = np.zeros(len(text) + length, dtype=np.uint64)
    out[: len(text)] = text
    for k in (1, 2, 4):
        out = out << np.uint64(8 * k) | np.r_[out[k:], np.zeros(k, dtype=np.uint64)]
    return out


def _compared(a: np.ndarray, at: np.ndarray, b: np.ndarray, to: np.ndarray, length: int) -> np.ndarray:
    """-1, 0 or 1 as each window of ``a`` is less, equal or greater than its window of ``b`` (both as 8-byte words)."""
    sign, todo = np.zeros(len(at), dtype=np.int8), np.arange(len(at))
    for k in [*range(0, length - 8, 8), length - 8]:
        x, y = a[at[todo] + k], b[to[todo] + k]
        differ = x != y
        sign[todo[differ]] = np.where(x[differ] < y[differ], -1, 1)
        todo = todo[~differ]
        if not len(todo):
            break
    return sign


class Level:
    """Windows of a text in lexicographic order, and whose they are."""

    def __init__(self, words: np.ndarray, order: np.ndarray, ids: np.ndarray, hashes: np.ndarray, length: int):
        self.words, self.order, self.ids, self.hashes, self.length = words, order, ids, hashes, length

    def places(self, words: np.ndarray, at: np.ndarray) -> np.ndarray:
        """For windows of another text, in their order: how many windows of this level are less."""
        heads, asked = self.words[self.order], words[at]
        low, high = np.searchsorted(heads, asked, "left"), np.searchsorted(heads, asked, "right")
        live = np.flatnonzero(low < high)
        while len(live):
            middle = (low[live] + high[live]) >> 1
            less = _compared(self.words, self.order[middle], words, at[live], self.length) < 0
            low[live], high[live] = np.where(less, middle + 1, low[live]), np.where(less, high[live], middle)
            live = live[low[live] < high[live]]
        return low

    def taken(self, words: np.ndarray, at: np.ndarray, ids: np.ndarray, hashes: np.ndarray) -> np.ndarray:
        """Which windows of a later batch this level has, from a smaller document or from their own."""
        place, gone = self.places(words, at), np.zeros(len(at), dtype=bool)
        live = np.flatnonzero(place < len(self.order))
        while len(live):
            to = place[live]
            equal = _compared(self.words, self.order[to], words, at[live], self.length) == 0
            gone[live] = equal & ((self.ids[to] < ids[live]) | ((self.ids[to] == ids[live]) & (self.hashes[to] == hashes[live])))
            # windows of rows that share an id, but not their text, lie side by side
            live = live[equal & ~gone[live]]
            place[live] += 1
            live = live[place[live] < len(self.order)]
        return gone

    def merged(self, other: "Level") -> "Level":
        to = self.places(other.words, other.order)
        put = lambda a, b: np.insert(a, to, b)
        return Level(
            np.concatenate([self.words, other.words]), put(self.order, other.order + len(self.words)), put(self.ids, other.ids), put(self.hashes, other.hashes), self.length
        )


class SuffixFamily:
    """Levels of suffix arrays over batches that come in order of documents; levels of a like size merge."""

    def __init__(self, length: int):
        self.length, self.levels = length, []

    def add(self, text: np.ndarray, at: np.ndarray, ids: np.ndarray, hashes: np.ndarray) -> np.ndarray:
        """Whether each window at ``at`` (ascending; documents in order) starts earlier too, here or in a batch before; the others are indexed."""
        order, opens = suffix_order(text, at, self.length)
        own = np.searchsorted(at, order)
        i, h = ids[own], hashes[own]
        first = i[np.flatnonzero(opens)][np.cumsum(opens) - 1]
        follows = ~opens & np.r_[False, (i[1:] == i[:-1]) & (h[1:] == h[:-1])][: len(i)]
        left = np.flatnonzero(~((first < i) | follows))
        words = _words(text, self.length)
        for level in self.levels:
            left = left[~level.taken(words, order[left], i[left], h[left])]
        new = np.zeros(len(at), dtype=bool)
        new[own[left]] = True
        if len(left):
            self.levels.append(Level(words, order[left], i[left], h[left], self.length))
        while len(self.levels) > 1 and 2 * len(self.levels[-1].order) > len(self.levels[-2].order):
            last = self.levels.pop()
            self.levels[-1] = self.levels[-1].merged(last)
        return ~new


def _shared(text: np.ndarray, at: np.ndarray, length: int) -> np.ndarray:
    """Whether another window's hash is like that of each window at ``at``: equal windows' always are.

    As many bits of a hash and the window's number are one number, so one plain
    sort brings like ones together; it does not matter that others come along.
    """
    bits = np.uint64(max(1, len(at).bit_length()))
    mask = (np.uint64(1) << bits) - np.uint64(1)
    packed = np.arange(len(at), dtype=np.uint64)
    edges = np.searchsorted(at, range(0, len(text) + PIECE, PIECE))
    for k, (a, b) in enumerate(zip(edges[:-1], edges[1:])):
        if a < b:
            packed[a:b] |= sequences(_BYTE[text[k * PIECE : (k + 1) * PIECE + length - 1]], length)[at[a:b] - k * PIECE] & ~mask
    packed.sort()
    same = packed[1:] >> bits == packed[:-1] >> bits
    found = np.zeros(len(at), dtype=bool)
    found[(packed[1:][same] & mask).astype(np.int64)] = True
    found[(packed[:-1][same] & mask).astype(np.int64)] = True
    return found


def _matched(routes: _Routes, batch_bytes: int):
    length = routes.length

    def run(table: pa.Table) -> pa.Table:
        found: list[tuple] = []
        sent: list[list] = []
        for kind, body in zip(table["kind"].to_pylist(), table["body"]):
            arrays = _unpack(body.as_py())
            if kind == 1:
                found.append((arrays[0].view(np.int64), arrays[1].view(np.int64), arrays[2], arrays[3]))
            else:
                sent.append(arrays)
        if sent:
            index = [np.cumsum(x[2].astype(np.int64)) for x in sent]
            ids = np.concatenate([x[0].view(np.int64)[k] for x, k in zip(sent, index)])
            hashes = np.concatenate([x[1].astype(np.int64)[k] for x, k in zip(sent, index)])
            start = np.concatenate([np.cumsum(x[3], dtype=np.uint32) for x in sent]).astype(np.int64)
            marked = np.concatenate([x[4] for x in sent]).astype(np.int64)
            key, text = (np.concatenate([x[k] for x in sent]) for k in (5, 6))
            del sent, index
            found += _search(ids, hashes, start, marked >> 1, key, (marked & 1).astype(bool), text, length, batch_bytes)
        return _by_document(found)

    return run


def _by_document(found: list[tuple]) -> pa.Table:
    """A row ``id, hash, spans`` for each document, from arrays of ids, hashes, begins and ends in any order."""
    none = np.zeros(0, dtype=np.int64)
    ids, hashes, begin, end = (np.concatenate([none, *x]).astype(np.int64) for x in (zip(*found) if found else [()] * 4))
    order = np.lexsort((begin, hashes, ids))
    ids, hashes = ids[order], hashes[order]
    cut = np.flatnonzero(np.r_[True, (ids[1:] != ids[:-1]) | (hashes[1:] != hashes[:-1])][: len(ids)])
    pairs = np.stack([begin[order], end[order]], axis=1).astype("<i4")
    edges = (np.r_[cut, len(ids)] * 8).astype("<i4")
    spans = pa.Array.from_buffers(pa.binary(), len(cut), [None, pa.py_buffer(edges.tobytes()), pa.py_buffer(pairs.tobytes())])
    return pa.table({"id": pa.array(ids[cut]), "hash": pa.array(hashes[cut]), "spans": spans})


def _search(ids, hashes, start, windows, key, again, text, length: int, batch_bytes: int) -> list[tuple]:
    """Spans of the windows of a shard's segments that start earlier too, as arrays of ids, hashes, begins and ends."""
    size = windows + length - 1
    offset = np.cumsum(size) - size
    # keys that one segment has, and once, can't repeat
    order, groups = _grouped(key)
    alone = np.empty(len(key), dtype=bool)
    alone[order] = np.repeat(np.diff(np.r_[groups, len(order)]) == 1, np.diff(np.r_[groups, len(order)]))
    kept = np.flatnonzero(~alone | again)
    kept = kept[np.lexsort((start[kept], hashes[kept], ids[kept]))]
    i, h, s = ids[kept], hashes[kept], start[kept]
    kept = kept[np.r_[True, (i[1:] != i[:-1]) | (h[1:] != h[:-1]) | (s[1:] != s[:-1])][: len(kept)]]
    if not len(kept):
        return []
    # equal segments of several slices
    text = _drawn(text, offset[kept], size[kept])
    ids, hashes, start, windows, size, key, again = (x[kept] for x in (ids, hashes, start, windows, size, key, again))
    offset = np.cumsum(size) - size
    gone = _copies(text, offset, size, _likes(text, size), ids, hashes)
    found = [(ids[gone], hashes[gone], start[gone], (start + size)[gone])]
    order, groups = _grouped(np.where(gone, np.uint64(1 << 32), key.astype(np.uint64)))
    several = np.empty(len(key), dtype=bool)
    several[order] = np.repeat(np.diff(np.r_[groups, len(order)]) > 1, np.diff(np.r_[groups, len(order)]))
    left = np.flatnonzero(~gone & (several | again))
    # runs of windows that may repeat are segments of their own
    text = _drawn(text, offset[left], size[left])
    first = np.cumsum(size[left]) - size[left]
    at, live = _taken(first, windows[left]), np.zeros(len(text), dtype=bool)
    live[at[_shared(text, at, length)]] = True
    begin, end = _runs(live)
    seg = np.searchsorted(first, begin, "right") - 1
    ids, hashes, start, windows, offset = ids[left][seg], hashes[left][seg], start[left][seg] + begin - first[seg], end - begin, begin
    size = windows + length - 1
    family, part = SuffixFamily(length), np.cumsum(size) // batch_bytes
    edges = np.flatnonzero(np.r_[True, part[1:] != part[:-1], True]) if len(part) else []
    for p, q in zip(edges[:-1], edges[1:]):
        own = np.arange(p, q)
        z, w = size[own], windows[own]
        first = np.cumsum(z) - z
        at, owner = _taken(first, w), np.repeat(own, w)
        repeats = np.zeros(int(z.sum()), dtype=bool)
        repeats[at] = family.add(text[_taken(offset[own], z)], at, ids[owner], hashes[owner])
        b, e = _runs(repeats)
        seg = np.searchsorted(first, b, "right") - 1
        o = own[seg]
        found.append((ids[o], hashes[o], start[o] + b - first[seg], start[o] + e - first[seg] + length - 1))
    return found


def _cut(kept_as: str, columns: list[str], schema: T.StructType):
    """Adds n_bytes, n_removed, n_spans and the bytes that stay."""
    at, spans_at = columns.index("text"), columns.index("__spans")

    def run(batches):
        unpack = zstandard.ZstdDecompressor()
        for batch in by_size(batches, "text"):
            out: tuple[list, ...] = ([], [], [], [])
            for packed, spans in zip(batch.column(at).to_pylist(), batch.column(spans_at).to_pylist()):
                raw = b"" if packed is None else unpack.decompress(packed)
                begin = np.zeros(0, dtype=np.int64)
                kept = raw
                if spans:
                    edges = np.zeros(len(raw) + 1, dtype=np.int32)
                    pairs = np.frombuffer(b"".join(spans), "<i4").reshape(-1, 2)
                    np.add.at(edges, pairs[:, 0], 1)
                    np.add.at(edges, pairs[:, 1], -1)
                    keep = np.cumsum(edges[:-1]) == 0
                    begin, _ = _runs(~keep)
                    kept = np.frombuffer(raw, np.uint8)[keep].tobytes()
                for values, value in zip(out, (len(raw), len(raw) - len(kept), len(begin), kept)):
                    values.append(value)
            rest = [c for k, c in enumerate(batch.columns) if k not in (at, spans_at)]
            yield pa.RecordBatch.from_arrays([*rest, *(pa.array(x, pa.int64()) for x in out[:3]), pa.array(out[3], pa.binary())], names=schema.names)

    return run


def without_repeated_bytes(
    docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = WINDOW, kept_as: str = "kept", slice_bytes: int = SLICE_BYTES, shard_bytes: int = SHARD_BYTES, batch_bytes: int = BATCH
) -> DataFrame:
    """The columns of ``docs`` without the text, then ``n_bytes, n_removed, n_spans`` and ``kept_as`` (binary).

    The text's UTF-8 bytes that no repeated window covers stay, also where a cut
    falls inside a character. A null text is empty. A null id comes after all
    others; rows of the same id and text count as one document and are treated
    alike; rows of one id with different texts take nothing from each other.
    Windows are judged on the input. Other columns are kept, also those named
    like the ones used here; ``n_bytes, n_removed, n_spans`` and ``kept_as`` are
    replaced. An empty table gives no rows. A text is one task's work.
    """
    if length <= GRAM:
        raise ValueError(f"windows need more than {GRAM} bytes")
    if not 0 < batch_bytes <= 1 << 19:
        raise ValueError("a batch has 2**19 bytes at most")
    made = ("n_bytes", "n_removed", "n_spans", kept_as)
    others = [c for c in docs.columns if c not in (text, *made)]
    marked = docs.withColumn("__hash", F.xxhash64(text).bitwiseAND(F.lit(0xFFFFFFFF))).withColumn("__id", F.coalesce(F.col(key).cast("long"), F.lit(LAST)))
    volume = docs.agg(F.coalesce(F.sum(F.octet_length(text).cast("long")), F.lit(0))).first()[0]
    routes = _routes(docs.select(F.col(text).alias("text")), length, max(8, -(-int(volume) // shard_bytes)), slice_bytes, GRAM, _weigh)
    sent = marked.select(F.col("__id"), F.col("__hash"), F.col(text).alias("text")).mapInArrow(_send(routes, slice_bytes), _SENT)
    spans = by_shard(sent, int(routes.bases[-1])).applyInArrow(_matched(routes, batch_bytes), _SPANS)
    by_doc = spans.groupBy(F.col("id").alias("__of"), F.col("hash").alias("__like")).agg(F.collect_list("spans").alias("__spans"))
    plain = marked.select(*[docs[c].alias(f"__{k}") for k, c in enumerate(others)], F.col("__id"), F.col("__hash"), docs[text].alias("text"))
    small = plain.mapInArrow(_squeezed(plain.columns), T.StructType([*plain.schema.fields[:-1], T.StructField("text", T.BinaryType())]))
    rows = small.join(by_doc, (F.col("__id") == F.col("__of")) & (F.col("__hash") == F.col("__like")), "left").select(*[f"__{k}" for k in range(len(others))], "text", "__spans")
    schema = T.StructType([*(docs.schema[c] for c in others), *(T.StructField(c, T.LongType()) for c in made[:3]), T.StructField(kept_as, T.BinaryType())])
    return rows.mapInArrow(_cut(kept_as, rows.columns, schema), schema)


def op11_suffix_family(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the bytes of 100-byte strings that start earlier too.

    A null text counts as empty, a null id as the greatest; repeated rows are
    treated alike, an empty table gives no rows, other columns aren't read.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return without_repeated_bytes(docs).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


#: All windows as byte strings; removed spans are islands of windows that have an earlier one.
OP11_SQL = r"""
WITH d AS (
  SELECT doc_id, encode(coalesce(text, '')) AS b FROM documents
), w AS (
  SELECT doc_id, i, b[i:i + 99] AS s
  FROM (SELECT doc_id, b, unnest(generate_series(1, octet_length(b) - 99)) AS i FROM d WHERE octet_length(b) >= 100)
), m AS (
  SELECT doc_id, i, first_value((doc_id, i)) OVER (PARTITION BY s ORDER BY doc_id, i) <> (doc_id, i) AS gone FROM w
), o AS (
  SELECT doc_id, i, coalesce(i > 100 + lag(i) OVER (PARTITION BY doc_id ORDER BY i), true) AS opens FROM m WHERE gone
), n AS (
  SELECT doc_id, i, sum(opens::INT) OVER (PARTITION BY doc_id ORDER BY i) AS span FROM o
), s AS (
  SELECT doc_id, min(i) AS a, max(i) + 99 AS z FROM n GROUP BY doc_id, span
), g AS (
  SELECT doc_id, a, z, coalesce(lag(z) OVER (PARTITION BY doc_id ORDER BY a), 0) + 1 AS front FROM s
), k AS (
  SELECT doc_id, count(*) AS n_spans, sum(z - a + 1) AS n_removed, max(z) AS last,
    string_agg(CASE WHEN a > front THEN hex(b[front:a - 1]) ELSE '' END, '' ORDER BY a) AS kept
  FROM g JOIN d USING (doc_id) GROUP BY doc_id
)
SELECT doc_id, octet_length(b)::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans,
  sha256(unhex(coalesce(kept, '') || CASE WHEN octet_length(b) > coalesce(last, 0) THEN hex(b[coalesce(last, 0) + 1:octet_length(b)]) ELSE '' END)) AS kept_sha256
FROM d LEFT JOIN k USING (doc_id)
"""
