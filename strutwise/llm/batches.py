"""Arrow batches cut by text size, and bounded tables of distinct chunks."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text that a slice of a batch holds (one row at least).
SLICE = 1 << 20
#: Distinct chunks that a worker keeps; the table starts anew beyond them.
CHUNKS = 250_000
#: Longer chunks are encoded each time.
LONG_CHUNK = 64


def by_size(batches: Iterable[pa.RecordBatch], column: str, limit: int = SLICE) -> Iterator[pa.RecordBatch]:
    """Slices of the batches with about ``limit`` bytes in ``column`` each, rows in order."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(batch.schema.get_field_index(column))), 0)
        group = np.cumsum(sizes.to_numpy(zero_copy_only=False).astype(np.int64)) // limit
        starts = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
        for a, b in zip(starts, np.r_[starts[1:], batch.num_rows]):
            yield batch.slice(int(a), int(b - a))


def bytes_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of the texts, one after another, and where each begins and the last ends; a null text is empty."""
    texts = pc.fill_null(texts, "")
    wide = pa.types.is_large_string(texts.type)
    _, offsets, data = texts.buffers()
    if not len(texts):
        return np.zeros(0, dtype=np.uint8), np.zeros(1, dtype=np.int64)
    edges = np.frombuffer(offsets, np.int64 if wide else np.int32, len(texts) + 1, texts.offset * (8 if wide else 4)).astype(np.int64)
    if edges[-1] == edges[0]:
        return np.zeros(0, dtype=np.uint8), edges - edges[0]
    return np.frombuffer(data, np.uint8, int(edges[-1] - edges[0]), int(edges[0])), edges - edges[0]


class ChunkTable:
    """Distinct chunk -> what ``encode`` makes of it; every distinct chunk is encoded once while it is kept."""

    def __init__(self, encode: Callable[[list[str]], list], most: int = CHUNKS):
        self.encode, self.most, self.known = encode, most, {}

    def __call__(self, texts: list[list[str]]) -> list[list]:
        """For each list of chunks the list of their values, by position."""
        if len(self.known) > self.most:
            self.known = {}
        known, own = self.known, {}
        new = [c for c in set().union(*texts) if c not in known]
        for c, value in zip(new, self.encode(new) if new else ()):
            (known if len(c) <= LONG_CHUNK else own)[c] = value
        if not own:
            return [list(map(known.__getitem__, chunks)) for chunks in texts]
        return [[known[c] if c in known else own[c] for c in chunks] for chunks in texts]
