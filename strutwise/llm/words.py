"""Word hashes of whole texts, as arrays.

A word's hash is a sum over its bytes, each byte's own random number times a
power of an odd base by its place, spread by a bijection. Sums of the words of
a buffer are differences of one running sum, so no word becomes an object.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_STEP = np.uint64(0x9E3779B97F4A7C15)
_A, _B = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_BYTE = np.random.default_rng(11).integers(0, 1 << 64, 256, dtype=np.uint64)
_BASE = 0x2545F4914F6CDD1D
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: Bytes that are hashed at once; a piece ends with a word.
PIECE = 1 << 18


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[:1] = 1
    with np.errstate(over="ignore"):
        return np.cumprod(out)


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words of the texts, one text after another, and the words in each; a null text has none.

    Words are longest runs of bytes other than 0x20 and 0x09 to 0x0D.
    """
    if texts.null_count:
        texts = pc.fill_null(texts, "")
    wide = pa.types.is_large_string(texts.type)
    _, offsets, data = texts.buffers()
    edges = np.frombuffer(offsets, np.int64 if wide else np.int32, len(texts) + 1, texts.offset * (8 if wide else 4)).astype(np.int64)
    if not len(texts) or edges[-1] == edges[0]:
        return np.zeros(0, dtype=np.uint64), np.zeros(len(texts), dtype=np.int64)
    raw = np.frombuffer(data, np.uint8, int(edges[-1] - edges[0]), int(edges[0]))
    edges = edges - edges[0]
    word = ~_SPACE[raw]
    cut = np.zeros(len(raw) + 1, dtype=bool)
    cut[edges] = True  # words don't run on from text to text
    follows = np.zeros(len(raw), dtype=bool)
    follows[1:] = word[1:] & word[:-1] & ~cut[1:-1]
    starts = np.flatnonzero(word & ~follows)
    ends = np.flatnonzero(word & ~np.r_[follows[1:], False]) + 1
    counts = np.diff(np.searchsorted(starts, edges))
    out = np.empty(len(starts), dtype=np.uint64)
    at = 0
    with np.errstate(over="ignore"):
        while at < len(starts):
            begin = int(starts[at])
            upto = max(at + 1, int(np.searchsorted(ends, begin + PIECE, "right")))
            piece = raw[begin : int(ends[upto - 1])]
            if len(piece) > len(_tables[0]):
                _tables[:] = [_powers(_BASE, len(piece)), _powers(pow(_BASE, -1, 1 << 64), len(piece))]
            sums = np.zeros(len(piece) + 1, dtype=np.uint64)
            np.cumsum(_BYTE[piece] * _tables[0][: len(piece)], out=sums[1:])
            a, z = starts[at:upto] - begin, ends[at:upto] - begin
            out[at:upto] = (sums[z] - sums[a]) * _tables[1][a]
            at = upto
        if len(_tables[0]) > PIECE:  # one very long word needed more
            _tables[:] = [t[:PIECE].copy() for t in _tables]
        return mixed(out), counts


_tables = [_powers(_BASE, PIECE), _powers(pow(_BASE, -1, 1 << 64), PIECE)]


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads their bits."""
    x = (x ^ (x >> np.uint64(30))) * _A
    x = (x ^ (x >> np.uint64(27))) * _B
    return x ^ (x >> np.uint64(31))


def sequences(hashes: np.ndarray, n: int) -> np.ndarray:
    """A hash of each run of ``n`` values (len - n + 1 of them), by doubling."""
    if len(hashes) < n:
        return np.zeros(0, dtype=np.uint64)
    with np.errstate(over="ignore"):
        done, have, whole, size, factor = None, 0, hashes, 1, _STEP
        left = n
        while left:
            if left & 1:
                # appended behind what is there
                done = whole if done is None else done[: len(hashes) - have - size + 1] * factor + whole[have : len(hashes) - size + 1]
                have += size
            left >>= 1
            if left:
                whole = whole[: len(hashes) - 2 * size + 1] * factor + whole[size : len(hashes) - size + 1]
                size, factor = 2 * size, factor * factor
        return mixed(done[: len(hashes) - n + 1])


def sliding_min(x: np.ndarray, n: int) -> np.ndarray:
    """The least of each run of ``n`` values, by doubling."""
    size, out = 1, x
    while 2 * size <= n:
        out = np.minimum(out[: len(out) - size], out[size:])
        size *= 2
    rest = n - size
    return np.minimum(out[: len(out) - rest], out[rest:]) if rest else out
