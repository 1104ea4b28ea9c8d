"""Helpers for Arrow-batched Python work inside tasks."""

from __future__ import annotations

import contextlib
import ctypes
import gc
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Bytes of text handled at once, so that memory does not follow the size of Spark's batches.
SLICE_BYTES = 2 << 20
# Words kept in a worker's cache. A full cache starts anew; results do not depend on it.
CACHE_WORDS = 250_000
# Longer words are worked out each time.
CACHE_BYTES = 64


_OWNER: list = [None, lambda: None]


def holding(owner: str, release: Callable[[], None]) -> None:
    """Say whose caches this worker holds from now on; those of another operator before are released.

    Workers outlive the stages of a pipeline, and so would the caches of each.
    """
    if _OWNER[0] != owner:
        _OWNER[1]()
        returned()
        _OWNER[:] = [owner, release]


def returned() -> None:
    """Give memory that is no longer used back to the system."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # other C libraries do so by themselves
        ctypes.CDLL(None).malloc_trim(0)


def pieces(column: pa.Array, size: int = SLICE_BYTES) -> Iterator[tuple[int, list[bytes]]]:
    """First row and texts, as UTF-8, of stretches of about ``size`` bytes; null is empty."""
    raw = column.cast(pa.binary())
    ends = np.cumsum(pc.binary_length(raw).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64))
    start = done = 0
    while start < len(raw):
        stop = max(start + 1, int(np.searchsorted(ends, done + size, "right")))
        yield start, [t or b"" for t in raw.slice(start, stop - start).to_pylist()]
        start, done = stop, int(ends[stop - 1])


def slices(batches: Iterable[pa.RecordBatch], column: str = "text", size: int = SLICE_BYTES) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Batches cut like ``pieces``, with their texts."""
    for batch in batches:
        for start, texts in pieces(batch.column(column), size):
            yield batch.slice(start, len(texts)), texts


def _cut(column: pa.Array) -> list[bytes]:
    """Values of a column of texts without nulls; much faster than ``to_pylist``."""
    if not len(column):
        return []
    _, ends, data = column.buffers()
    raw = data.to_pybytes() if data else b""
    edges = np.frombuffer(ends, np.int32, column.offset + len(column) + 1)[column.offset :].tolist()
    return [raw[a:b] for a, b in zip(edges, edges[1:])]


def parted(texts: pa.Array) -> tuple[pa.ListArray, pa.DictionaryArray, list[bytes]]:
    """Pieces of texts between white space: per text, coded, and the distinct ones."""
    split = pc.ascii_split_whitespace(texts)
    coded = split.flatten().dictionary_encode()
    return split, coded, _cut(coded.dictionary)


def joined(split: pa.ListArray, coded: pa.DictionaryArray, ids: list[bytes]) -> list[bytes]:
    """Per text the ids of its pieces, joined; ``ids`` are those of the distinct pieces.

    Every piece takes its ids; Arrow puts them one behind the other, so a text is a stretch of that buffer.
    """
    taken = pa.array(ids, pa.large_binary()).take(coded.indices)
    ends = np.frombuffer(taken.buffers()[1], np.int64, len(taken) + 1)
    data, cuts = (taken.buffers()[2] or pa.py_buffer(b"")).to_pybytes(), ends[split.offsets.to_numpy()].tolist()
    return [data[a:b] for a, b in zip(cuts, cuts[1:])]


def gathered(texts: pa.Array | list[bytes], known: dict[bytes, bytes], fill: Callable[[list[bytes], dict[bytes, bytes]], None], most: int) -> list[bytes]:
    """Per text the 32-bit ids of its pieces between white space, joined.

    Each distinct piece is looked up once. ``known`` is a cache of at most about ``most`` pieces, which starts anew when
    it is full; ``fill`` puts the ids of new pieces there.
    """
    texts = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.binary()).cast(pa.string())
    split, coded, distinct = parted(texts)
    known[b""] = b""  # before leading and after trailing white space
    ids = list(map(known.get, distinct))
    places = [i for i, x in enumerate(ids) if x is None]
    new = [distinct[i] for i in places]
    if new and len(known) + len(new) > most:
        # Those of this batch are at hand and stay.
        known.clear()
        known.update((p, x) for p, x in zip([b"", *distinct], [b"", *ids]) if x is not None)
    if new:
        # Millions of small lists come and go and none of them is in a cycle.
        gc.disable()
        try:
            fill(new, known)
        finally:
            gc.enable()
    for i, p in zip(places, new):
        ids[i] = known[p]
    if max(map(len, new), default=0) > CACHE_BYTES:
        for piece in [p for p in new if len(p) > CACHE_BYTES]:
            del known[piece]
    return joined(split, coded, ids)
