"""Substring deduplication with an FM-index for each shard of word windows.

A window is ``length`` consecutive words of one document. A word goes if a
window that covers it also starts in a document with a smaller id.

Documents are read in slices. A slice has an FM-index of its own, over windows
whose hash two of its documents have: all but those of the smallest document
are known to repeat, so a passage that very many documents share leaves a slice
once. The other windows go to a shard by their minimizer, the least of the hashes of their word triples:
neighbouring windows mostly share it and travel as one segment, and equal
windows always meet. A shard that would get far more than the mean is split: its
windows go by their two least triple hashes, then three, and so on, for as long
as that spreads them. How much each shard would get is counted beforehand, over
all texts.

A shard drops segments whose key occurs in one document only, builds an
FM-index (BWT in a wavelet tree) over the rest, and streams every segment
through it: backward search, dropping what occurs nowhere else, gives each
window's interval. Words are 16-bit symbols there; each window has a check of
32 more bits of its words' hashes, and the least document among an interval's
windows of equal check decides. Removed word spans go back to their documents
by id and text hash.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strutwise.llm.batches import by_size
from strutwise.llm.common import by_shard, discard, keeps_columns, stored
from strutwise.llm.fmindex import FMIndex
from strutwise.llm.words import mixed, sequences, sliding_min, word_hashes

#: Words in a window.
WINDOW = 13
#: Words whose hash stands for a place inside a window.
GRAM = 3
#: Bytes of text in a slice, and for each shard.
SLICE_BYTES = 6 << 20
SHARD_BYTES = 8 << 20
#: Words in one FM-index; a shard with more builds several, each over whole keys.
INDEX_WORDS = 1 << 19
#: A shard is split from this multiple of the mean on, for as long as each split takes a tenth off the fullest.
HOT, GAIN = 2.0, 0.9
LAST = (1 << 63) - 1
_WORDS = re.compile(rb"[^\x20\x09-\x0D]+")
_SENT = "shard int, kind int, body binary"
_SPANS = "id long, hash long, spans binary"


def _pack(*arrays: np.ndarray, level: int = 1) -> bytes:
    """Arrays with their types and lengths, compressed."""
    heads = b"".join(np.array([a.dtype.itemsize, len(a)], dtype="<u4").tobytes() for a in arrays)
    return zstandard.ZstdCompressor(level=level).compress(np.array([len(arrays)], dtype="<u4").tobytes() + heads + b"".join(a.tobytes() for a in arrays))


def _unpack(body: bytes) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(body)
    n = int(np.frombuffer(raw, "<u4", 1)[0])
    heads, at, out = np.frombuffer(raw, "<u4", 2 * n, 4), 4 + 8 * n, []
    for size, count in heads.reshape(-1, 2):
        out.append(np.frombuffer(raw, f"<u{size}", int(count), at))
        at += int(size) * int(count)
    return out


def _frequent(symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The 255 most frequent symbols (from place 1 on) and a table of their places."""
    counts = np.bincount(symbols, minlength=1 << 16)
    chosen = np.argsort(-counts, kind="stable")[:255]
    top = np.zeros(256, dtype="<u2")
    top[1:] = chosen
    table = np.zeros(1 << 16, dtype=np.uint8)
    table[chosen] = np.arange(1, 256, dtype=np.uint8)
    return top, table


def _runs(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of True."""
    edges = np.flatnonzero(np.diff(np.r_[False, mask, False].astype(np.int8)))
    return edges[::2], edges[1::2]


def _grouped(keys: np.ndarray, stable: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """An order by key and where each group starts in it."""
    order = np.argsort(keys, kind="stable" if stable else None)
    ranked = keys[order]
    return order, np.flatnonzero(np.r_[True, ranked[1:] != ranked[:-1]][: len(keys)])


def _spans_of(ids: np.ndarray, hashes: np.ndarray, begin: np.ndarray, end: np.ndarray) -> list[tuple]:
    """(id, hash, spans) for each document among word spans given in any order."""
    if not len(ids):
        return []
    order = np.lexsort((begin, hashes, ids))
    ids, hashes, begin, end = ids[order], hashes[order], begin[order], end[order]
    cut = np.flatnonzero(np.r_[True, (ids[1:] != ids[:-1]) | (hashes[1:] != hashes[:-1])])
    pairs = np.stack([begin, end], axis=1).astype("<i4")
    return [(int(ids[a]), int(hashes[a]), pairs[a:b].tobytes()) for a, b in zip(cut, np.r_[cut[1:], len(ids)])]


def _symbols(flat: np.ndarray) -> np.ndarray:
    """What a shard gets to see of a word: 16 bits of its hash."""
    return flat.astype("<u2")


def _grams(symbols: np.ndarray) -> np.ndarray:
    return sequences(symbols.astype(np.uint64), GRAM)


def _folded(least: np.ndarray) -> np.ndarray:
    """One key for each row of its least triple hashes, in order; a single one is the key itself."""
    key = least[:, 0]
    with np.errstate(over="ignore"):
        for k in range(1, least.shape[1]):
            key = mixed(key * np.uint64(0x9E3779B97F4A7C15) + least[:, k])
    return key


class _Routes:
    """Shards of windows: levels of (number of shards, which of them are split by one more triple)."""

    def __init__(self, length: int, first: int, gram: int = GRAM):
        self.length, self.gram, self.levels = length, gram, [(first, None)]

    def split(self, hot: np.ndarray, shards: int) -> "_Routes":
        more = _Routes(self.length, 0, self.gram)
        more.levels = [*self.levels[:-1], (self.levels[-1][0], hot), (shards, None)]
        return more

    def __getstate__(self) -> dict:
        return {"length": self.length, "gram": self.gram, "levels": [(n, None if hot is None else np.packbits(hot)) for n, hot in self.levels]}

    def __setstate__(self, state: dict) -> None:
        self.length, self.gram = state["length"], state["gram"]
        self.levels = [(n, None if bits is None else np.unpackbits(bits, count=n).astype(bool)) for n, bits in state["levels"]]

    @property
    def bases(self) -> np.ndarray:
        return np.cumsum([0, *(n for n, _ in self.levels)])

    def level(self, shard: int) -> int:
        return int(np.searchsorted(self.bases, shard, "right"))

    def keys(self, grams: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Key and shard of the windows that start at ``at``."""
        many = self.length - self.gram + 1
        key = sliding_min(grams, many)[at]
        shard = ((key >> np.uint64(8)) % np.uint64(self.levels[0][0])).astype(np.int64)
        for k, (_, hot) in enumerate(self.levels[:-1]):
            base, (shards, _) = self.bases[k], self.levels[k + 1]
            rows = np.flatnonzero(shard >= base)
            rows = rows[hot[shard[rows] - base]]
            for a in range(0, len(rows), 1 << 14):
                own = rows[a : a + (1 << 14)]
                every = grams[at[own, None] + np.arange(many)]
                every.partition(k + 1, axis=1)
                key[own] = _folded(np.sort(every[:, : k + 2], axis=1))
            shard[rows] = self.bases[k + 1] + ((key[rows] >> np.uint64(8)) % np.uint64(shards)).astype(np.int64)
        return key, shard


def _opened(at: np.ndarray, key: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Whether a window opens a segment: it doesn't follow one of its document with the same key."""
    return np.r_[True, (np.diff(at) != 1) | (key[1:] != key[:-1]) | (doc[1:] != doc[:-1])][: len(at)]


def _weigh(routes: _Routes, slice_bytes: int):
    """Words that each shard of the last level would get, summed over what a task reads.

    At the first level repeats in a slice are counted too; further levels leave them out.
    """
    base, shards, length = int(routes.bases[-2]), routes.levels[-1][0], routes.length

    def run(batches):
        total = {}
        for batch in by_size(batches, "text", slice_bytes):
            flat, counts = word_hashes(batch.column(0))
            doc = np.repeat(np.arange(len(counts)), counts)
            if len(flat) < length:
                continue
            at = np.flatnonzero(doc[: len(flat) - length + 1] == doc[length - 1 :])
            if not len(at):
                continue
            key, shard = routes.keys(_grams(_symbols(flat)), at)
            if base:
                here = np.flatnonzero(shard >= base)
                _, first = np.unique(sequences(flat, length)[at[here]], return_index=True)
                here = here[np.sort(first)]
                at, key, shard = at[here], key[here], shard[here]
            if not len(at):
                continue
            opens = np.flatnonzero(_opened(at, key, doc[at]))
            sizes = np.diff(np.r_[opens, len(at)]) + length - 1
            found, where = np.unique(shard[opens] - base, return_inverse=True)
            for s, w in zip(found.tolist(), np.bincount(where, weights=sizes).astype(np.int64).tolist()):
                total[s] = total.get(s, 0) + w
        yield pa.RecordBatch.from_pydict({"shard": pa.array(list(total), pa.int32()), "words": pa.array(list(total.values()), pa.int64())})

    return run


def _routes(texts: DataFrame, length: int, shards: int, slice_bytes: int, gram: int = GRAM, weigh=_weigh) -> _Routes:
    """Routes under which no shard is far above the mean, as far as triples (or other grams) can tell windows apart.

    What comes to the driver is a row for each shard that is too full; what
    goes to the executors is a bit for each shard.
    """
    routes, mean, before = _Routes(length, shards, gram), None, None
    while len(routes.levels) <= length - gram + 1:
        weights = texts.mapInArrow(weigh(routes, slice_bytes), "shard int, words long").groupBy("shard").agg(F.sum("words").alias("words"))
        weights = stored(weights, "weights")
        if mean is None:
            mean = (weights.agg(F.coalesce(F.sum("words"), F.lit(0))).first()[0]) / shards
        full = weights.where(F.col("words") > HOT * mean).toPandas()
        discard(weights)
        most = int(full["words"].max()) if len(full) else 0
        if not len(full) or mean == 0 or (len(routes.levels) > 2 and most > GAIN * before):
            return routes
        hot = np.zeros(routes.levels[-1][0], dtype=bool)
        hot[full["shard"].to_numpy()] = True
        routes, before = routes.split(hot, max(2, -(-int(full["words"].sum()) // max(1, int(mean))))), most
    return routes


def _repeated(ids: np.ndarray, flat: np.ndarray, doc: np.ndarray, first: np.ndarray, at: np.ndarray, window: np.ndarray, length: int) -> np.ndarray:
    """Whether a window of a slice starts there that a smaller document of the slice has too, for each word.

    Windows whose hash only one document has are left out; the others go
    through an FM-index whose symbols are 63 bits of the words' hashes.
    """
    order, groups = _grouped(window[at])
    owners = ids[doc[at[order]]]
    shared = np.minimum.reduceat(owners, groups) < np.maximum.reduceat(owners, groups)
    asks = np.sort(at[order[np.repeat(shared, np.diff(np.r_[groups, len(at)]))]])
    del order, owners
    steps = np.zeros(len(flat) + 1, dtype=np.int32)
    if len(asks):
        words = flat >> np.uint64(1)  # one more than a symbol still fits 64 bits
        key = sliding_min(_grams(words), length - GRAM + 1)[asks]
        opens = np.flatnonzero(_opened(asks, key, doc[asks]))
        start, windows = asks[opens], np.diff(np.r_[opens, len(asks)])
        check = (window[asks] >> np.uint64(32)).astype("<u4")
        text = words[_taken(start, windows + length - 1)]
        d = doc[start]
        # the place of a document stands for its hash, so that spans come back to it alone
        for _, own, spans in _search(ids[d], d, start - first[d], windows, check, text, length):
            pairs = np.frombuffer(spans, "<i4").reshape(-1, 2).astype(np.int64) + first[own]
            np.add.at(steps, pairs[:, 0], 1)
            np.add.at(steps, pairs[:, 1] - length + 1, -1)
    return np.cumsum(steps) > 0


def _slice_rows(ids: np.ndarray, hashes: np.ndarray, flat: np.ndarray, counts: np.ndarray, routes: _Routes):
    """What a slice sends: bodies of segments for shards (kind 0), and spans that it can settle itself (kind 1)."""
    length = routes.length
    doc = np.repeat(np.arange(len(counts)), counts)
    first = np.cumsum(counts) - counts
    n = len(flat) - length + 1
    if n < 1:
        return
    window = sequences(flat, length)
    inside = doc[:n] == doc[length - 1 :]
    at = np.flatnonzero(inside)
    if not len(at):
        return
    known = _repeated(ids, flat, doc, first, at, window, length)
    begin, end = _runs(known[:n] & inside)
    # a run of windows covers length - 1 words more; runs never cross documents' last windows
    if len(begin):
        d = doc[begin]
        yield -1, 1, _pack(ids[d].view("<u8"), hashes[d].view("<u8"), (begin - first[d]).astype("<u4"), (end - 1 + length - first[d]).astype("<u4"))
    send = at[~known[at]]
    if not len(send):
        return
    short = _symbols(flat)
    key, place = routes.keys(_grams(short), send)
    opens = np.flatnonzero(_opened(send, key, doc[send]))
    starts, windows = send[opens], np.diff(np.r_[opens, len(send)])
    sizes = windows + length - 1
    check = (window[send] >> np.uint64(32)).astype("<u4")
    top, table = _frequent(short)  # these travel as one byte each
    code = table[short]
    # the segments of one shard follow each other, documents in order
    order, groups = _grouped(place[opens], stable=True)
    for a, b in zip(groups, np.r_[groups[1:], len(starts)]):
        own = order[a:b]
        s, z, w = starts[own], sizes[own], windows[own]
        at = np.arange(z.sum()) - np.repeat(np.cumsum(z) - z - s, z)
        of = np.arange(w.sum()) - np.repeat(np.cumsum(w) - w - opens[own], w)
        codes = code[at]
        d = doc[s]
        docs, index = np.unique(d, return_inverse=True)
        gap = np.diff(np.r_[0, index])
        yield int(place[opens[own[0]]]), 0, _pack(
            ids[docs].view("<u8"), hashes[docs].astype("<u4"), gap.astype("<u2" if gap.max(initial=0) < 1 << 16 else "<u4"),
            (s - first[d]).astype("<u4"), w.astype("<u4" if w.max() >= 1 << 16 else "<u2"), check[of], codes, short[at[codes == 0]], top,
        )


def _send(routes: _Routes, slice_bytes: int):
    def run(batches):
        for batch in by_size(batches, "text", slice_bytes):
            ids = batch.column(0).fill_null(LAST).to_numpy(zero_copy_only=False).astype(np.int64)
            hashes = batch.column(1).to_numpy(zero_copy_only=False).astype(np.int64)
            flat, counts = word_hashes(batch.column(2))
            for s, kind, body in _slice_rows(ids, hashes, flat, counts, routes):
                # settled spans go to any shard and pass through it
                yield pa.RecordBatch.from_pydict({"shard": pa.array([s if s >= 0 else int(hashes[0] % routes.levels[0][0])], pa.int32()), "kind": pa.array([kind], pa.int32()), "body": pa.array([body], pa.binary())})

    return run


def _matched(routes: _Routes):
    length = routes.length

    def run(table: pa.Table) -> pa.Table:
        found: list[tuple] = []
        sent = []
        for kind, body in zip(table["kind"].to_pylist(), table["body"]):
            arrays = _unpack(body.as_py())
            if kind == 1:
                found += _spans_of(arrays[0].view(np.int64), arrays[1].view(np.int64).astype(np.uint32).astype(np.int64), arrays[2].astype(np.int64), arrays[3].astype(np.int64))
            else:
                sent.append(arrays)
        if sent:
            index = [np.cumsum(x[2].astype(np.int64)) for x in sent]
            ids = np.concatenate([x[0].view(np.int64)[i] for x, i in zip(sent, index)])
            hashes = np.concatenate([x[1].astype(np.int64)[i] for x, i in zip(sent, index)])
            start = np.concatenate([x[3] for x in sent]).astype(np.int64)
            windows = np.concatenate([x[4].astype(np.int64) for x in sent])
            check = np.concatenate([x[5] for x in sent])
            text = np.concatenate([_words_of(*x[6:]) for x in sent])
            level = routes.level(table["shard"][0].as_py())
            del sent, index
            found += _search(ids, hashes, start, windows, check, text, length, level)
        return pa.table({"id": pa.array([x[0] for x in found], pa.int64()), "hash": pa.array([x[1] for x in found], pa.int64()), "spans": pa.array([x[2] for x in found], pa.binary())})

    return run


def _words_of(codes: np.ndarray, rare: np.ndarray, top: np.ndarray) -> np.ndarray:
    words = top[codes]
    words[codes == 0] = rare
    return words


def _taken(offset: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Places of runs that begin at ``offset`` and hold ``count`` each, one run after another."""
    return np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count - offset, count)


def _search(ids, hashes, start, windows, check, text, length: int, level: int = 1) -> list[tuple]:
    """Spans of the windows of segments that also start in a document with a smaller id."""
    size = windows + length - 1
    offset, first_check = np.cumsum(size) - size, np.cumsum(windows) - windows
    # the key again, from the symbols that all segments hold alike
    key = np.empty(len(size), dtype=np.uint64)
    for a in range(0, len(size), 1 << 14):
        firsts = text[offset[a : a + (1 << 14), None] + np.arange(length)]
        grams = _grams(np.append(firsts.ravel(), np.zeros(GRAM - 1, dtype=firsts.dtype))).reshape(len(firsts), length)[:, : length - GRAM + 1]
        key[a : a + (1 << 14)] = grams.min(axis=1) if level == 1 else _folded(np.sort(grams, axis=1)[:, :level])
    order, groups = _grouped(key)
    least, most = np.minimum.reduceat(ids[order], groups), np.maximum.reduceat(ids[order], groups)
    repeats = np.diff(np.r_[groups, len(order)])
    # nothing comes before the least document of a key: its windows are found, but don't ask
    asks = ids[order] > np.repeat(least, repeats)
    kept = np.repeat(least < most, repeats)
    order, asks = order[kept], asks[kept]  # whole keys, one after another
    words = np.cumsum(size[order] + 1)
    part = np.zeros(len(order), dtype=np.int64)
    if len(order):
        ranked = key[order]
        opens = np.flatnonzero(np.r_[True, ranked[1:] != ranked[:-1]])
        part = np.repeat(words[opens] // INDEX_WORDS, np.diff(np.r_[opens, len(order)]))
    found: list[tuple] = []
    edges = np.flatnonzero(np.r_[True, part[1:] != part[:-1], True]) if len(part) else []
    for p, q in zip(edges[:-1], edges[1:]):
        own, asking = order[p:q], asks[p:q]
        z, w = size[own], windows[own]
        at = np.cumsum(z + 1) - (z + 1)
        joined = np.zeros(int((z + 1).sum()), dtype=np.uint64)
        joined[_taken(at, z)] = text[_taken(offset[own], z)].astype(np.uint64) + np.uint64(1)
        checks = np.zeros(len(joined) + 1, dtype=np.uint64)
        checks[_taken(at, w)] = check[_taken(first_check[own], w)]
        index = FMIndex(joined, length)
        many = np.where(asking, w, 0)
        places = _taken(at, many)
        segment = np.repeat(np.arange(len(own)), many)
        turn = places - at[segment]
        left, right = index.matches(places, length, alone=True)
        hit = np.flatnonzero(right > left)
        if not len(hit):
            continue
        owner = np.repeat(np.r_[ids[own], LAST], np.r_[z + 1, 1])  # the document of each place
        lefts, where = np.unique(left[hit], return_inverse=True)
        rights = np.zeros(len(lefts), dtype=np.int64)
        rights[where] = right[hit]
        # the least document among the windows of an interval that have the same check
        among = index.order[_taken(lefts, rights - lefts)]
        interval = np.repeat(np.arange(len(lefts), dtype=np.uint64) << np.uint64(32), rights - lefts)
        ranked, cut = _grouped(interval | checks[among])
        smallest = np.minimum.reduceat(owner[among][ranked], cut)
        exact = (interval | checks[among])[ranked][cut]
        asked = where.astype(np.uint64) << np.uint64(32) | checks[places[hit]]
        gone = np.zeros(len(places), dtype=bool)
        gone[hit] = smallest[np.searchsorted(exact, asked)] < ids[own][segment[hit]]
        # windows of one segment follow each other
        breaks = np.r_[segment[1:] != segment[:-1], True]
        stops = gone & (breaks | ~np.r_[gone[1:], False])
        begins = gone & (np.r_[True, breaks[:-1]] | ~np.r_[False, gone[:-1]])
        b, e = np.flatnonzero(begins), np.flatnonzero(stops)
        o = own[segment[b]]
        found += _spans_of(ids[o], hashes[o], start[o] + turn[b], start[o] + turn[e] + length)
    return found


def _squeezed(columns: list[str]):
    """Texts as compressed bytes, null as null: so they take less room in the shuffle."""
    at = columns.index("text")

    def run(batches):
        press = zstandard.ZstdCompressor(level=1)
        for batch in by_size(batches, "text"):
            packed = pa.array([None if t is None else press.compress(t.encode("utf-8")) for t in batch.column(at).to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([packed if k == at else c for k, c in enumerate(batch.columns)], names=columns)

    return run


def _cut(kept_as: str, columns: list[str], schema: T.StructType):
    """Adds n_words, n_removed and ``kept_as``: the kept words joined by a space, or the text without its removed spans."""
    at, spans_at = columns.index("text"), columns.index("__spans")

    def run(batches):
        unpack = zstandard.ZstdDecompressor()
        for batch in by_size(batches, "text"):
            n_words, n_removed, kept = [], [], []
            for packed, spans in zip(batch.column(at).to_pylist(), batch.column(spans_at).to_pylist()):
                raw = b"" if packed is None else unpack.decompress(packed)
                words = raw.split()
                keep = np.ones(len(words), dtype=bool)
                if spans:
                    edges = np.zeros(len(words) + 1, dtype=np.int32)
                    for s in spans:
                        pairs = np.frombuffer(s, "<i4").reshape(-1, 2)
                        np.add.at(edges, pairs[:, 0], 1)
                        np.add.at(edges, pairs[:, 1], -1)
                    keep = np.cumsum(edges[:-1]) == 0
                n_words.append(len(words))
                n_removed.append(int(len(words) - keep.sum()))
                if kept_as == "kept":
                    kept.append(b" ".join(words if keep.all() else [w for w, k in zip(words, keep) if k]).decode("utf-8"))
                elif keep.all():
                    kept.append(None if packed is None else raw.decode("utf-8"))
                else:
                    places = [m.start() for m in _WORDS.finditer(raw)] + [len(raw)]
                    a, b = _runs(keep)
                    lead = raw[: places[0]] if keep[0] else b""
                    kept.append((lead + b"".join(raw[places[x] : places[y]] for x, y in zip(a, b))).decode("utf-8"))
            rest = [c for k, c in enumerate(batch.columns) if k not in (at, spans_at)]
            yield pa.RecordBatch.from_arrays([*rest, pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(kept, pa.string())], names=schema.names)

    return run


def without_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = WINDOW, kept_as: str = "kept", slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """The columns of ``docs`` without the text, then ``n_words, n_removed`` and ``kept_as``.

    ``kept_as="kept"`` gives the kept words joined by one space; any other name
    gives the text itself, cut where words were removed and unchanged where
    none was (then null stays null). A null text has no words. A null id comes
    after all others; rows with the same id never take words from each other,
    and equal rows are treated alike. Windows are judged on the input. Other
    columns are kept, also those named like the ones used here; ``n_words``,
    ``n_removed`` and ``kept_as`` are replaced. An empty table gives no rows.
    """
    if length <= GRAM:
        raise ValueError(f"windows need more than {GRAM} words")
    others = [c for c in docs.columns if c not in (text, "n_words", "n_removed", kept_as)]
    # 32 bits of a hash tell texts under the same id apart
    marked = docs.withColumn("__hash", F.xxhash64(text).bitwiseAND(F.lit(0xFFFFFFFF))).withColumn("__id", F.coalesce(F.col(key).cast("long"), F.lit(LAST)))
    volume = docs.agg(F.coalesce(F.sum(F.octet_length(text).cast("long")), F.lit(0))).first()[0]
    shards = max(8, -(-int(volume) // SHARD_BYTES))
    routes = _routes(docs.select(F.col(text).alias("text")), length, shards, slice_bytes)
    sent = marked.select(F.col("__id"), F.col("__hash"), F.col(text).alias("text")).mapInArrow(_send(routes, slice_bytes), _SENT)
    spans = by_shard(sent, int(routes.bases[-1])).applyInArrow(_matched(routes), _SPANS)
    by_doc = spans.groupBy(F.col("id").alias("__of"), F.col("hash").alias("__like")).agg(F.collect_list("spans").alias("__spans"))
    fields = [docs.schema[c] for c in others]
    plain = marked.select(*[docs[c].alias(f"__{k}") for k, c in enumerate(others)], F.col("__id"), F.col("__hash"), docs[text].alias("text"))
    small = plain.mapInArrow(_squeezed(plain.columns), T.StructType([*plain.schema.fields[:-1], T.StructField("text", T.BinaryType())]))
    rows = small.join(by_doc, (F.col("__id") == F.col("__of")) & (F.col("__hash") == F.col("__like")), "left").select(*[f"__{k}" for k in range(len(others))], "text", "__spans")
    schema = T.StructType([*fields, T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()), T.StructField(kept_as, T.StringType())])
    return rows.mapInArrow(_cut(kept_as, rows.columns, schema), schema)


def op10_fm_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the words of 13-word windows that start in an earlier document too."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return without_repeats(docs).select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


#: Words of a passage that the pipeline takes out where an earlier document has it.
PASSAGE = 50


@keeps_columns
def passage_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of 50 words or more that an earlier document has; the columns of ``docs``.

    A document keeps its row and all other words; ``n_chars`` is counted anew.
    """
    names = docs.columns
    cut = without_repeats(docs, length=PASSAGE, kept_as="__text").withColumnRenamed("__text", "text")
    if "n_chars" in names:
        cut = cut.withColumn("n_chars", F.when(F.col("n_removed") > 0, F.char_length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return cut.select(*[F.col(f"`{c}`") for c in names])


OP10_SQL = r"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents
), g AS (
  SELECT doc_id, i, array_to_string(ws[i:i+12], ' ') AS g
  FROM (SELECT doc_id, ws, unnest(generate_series(1, len(ws) - 12)) AS i FROM w WHERE len(ws) >= 13)
), m AS (
  SELECT g, min(doc_id) AS d FROM g GROUP BY g
), r AS (
  SELECT DISTINCT g.doc_id, g.i + j.j AS p
  FROM g JOIN m USING (g), (SELECT unnest(generate_series(0, 12)) AS j) j WHERE m.d < g.doc_id
), gone AS (
  SELECT doc_id, list(p) AS ps FROM r GROUP BY doc_id
)
SELECT w.doc_id, len(ws)::BIGINT AS n_words, coalesce(len(ps), 0)::BIGINT AS n_removed,
       sha256(array_to_string(CASE WHEN ps IS NULL THEN ws
         ELSE list_filter(ws, lambda x, i: NOT list_contains(ps, i)) END, ' ')) AS kept_sha256
FROM w LEFT JOIN gone ON w.doc_id = gone.doc_id
"""
