"""Arrow text columns as flat byte arrays: the helpers that all text kernels share.

A kernel works on a *slice* of a record batch: about a MB of whole texts in one byte array. Vector
operations then run over many short documents at once, and memory stays bounded by the longest text.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 20

WHITE = np.zeros(256, bool)
WHITE[[9, 10, 11, 12, 13, 32]] = True

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_MIX = np.uint64(0xD6E8FEB86659FD93)
_SHIFT = np.uint64(32)
_BYTE = np.random.Generator(np.random.PCG64(20240501)).integers(0, 1 << 64, 256, dtype=np.uint64)
_powers: list[np.ndarray] = []


def slices(batch: pa.RecordBatch, column: str = "text", most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that a slice has about ``most`` bytes of text; a longer text stands alone."""
    lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(lengths + 16)
    start = 0
    while start < batch.num_rows:
        limit = most + (ends[start - 1] if start else 0)
        stop = max(start + 1, int(np.searchsorted(ends, limit, "right")))
        yield batch.slice(start, stop - start)
        start = stop


def mapped(kernel: Callable[[pa.RecordBatch], pa.RecordBatch], column: str = "text", most: int = SLICE_BYTES):
    """``kernel`` over slices, as a function for ``mapInArrow``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, column, most):
                yield kernel(part)

    return run


def flat(texts: pa.Array, end: bytes = b"") -> tuple[np.ndarray, np.ndarray]:
    """All texts as one byte array, each followed by ``end``, and where each one starts and ends."""
    texts = pc.fill_null(texts.cast(pa.large_binary()), b"")
    if end:
        texts = pc.binary_join_element_wise(texts, *(pa.scalar(x, pa.large_binary()) for x in (b"", end)))
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    if not len(offsets) or texts.buffers()[2] is None:
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    return np.frombuffer(texts.buffers()[2], np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def lower_ascii(data: np.ndarray) -> np.ndarray:
    """A-Z to a-z, every other byte as it is."""
    return _LOWER[data]


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words, and the number of the text each is in.

    ``data`` needs a white byte behind each text, so that no word reaches into the next one.
    """
    inside = np.empty(len(data) + 1, np.int8)
    inside[0] = 0
    np.logical_not(WHITE[data], out=inside[1:].view(bool))
    step = np.diff(inside)
    starts = np.flatnonzero(step == 1)
    ends = np.flatnonzero(step == -1)
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def mix(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit values, one to one."""
    x = (x ^ (x >> _SHIFT)) * _MIX
    x = (x ^ (x >> _SHIFT)) * _MIX
    return x ^ (x >> _SHIFT)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of the hash base and of its inverse, modulo 2**64."""
    if not _powers or len(_powers[0]) < n:
        size = max(n, 5 << 18)
        fills = []
        for base in (_BASE, _INVERSE):
            table = np.full(size, base, np.uint64)
            table[0] = 1
            fills.append(np.multiply.accumulate(table))
        _powers[:] = fills
    return _powers[0][:n], _powers[1][:n]


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """Hashes of all prefixes of bytes or of 64-bit hashes; with them any span is hashed in constant time."""
    values = _BYTE[data] if data.dtype == np.uint8 else data
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(values * powers(len(data))[0], out=out[1:])
    return out


def span_hash(prefixes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of spans: equal bytes give equal values, wherever they stand."""
    inverse = powers(len(prefixes))[1]
    length = (ends - starts).astype(np.uint64)
    return mix((prefixes[ends] - prefixes[starts]) * inverse[starts] + length)


def per_text(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sums of ``values`` over each text."""
    total = np.zeros(len(values) + 1, np.int64)
    np.cumsum(values, out=total[1:])
    return total[offsets[1:]] - total[offsets[:-1]]


def gather_spans(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices of all elements of the given spans, span after span."""
    if not len(starts):
        return np.zeros(0, np.int64)
    ends = np.cumsum(lengths)
    return np.arange(ends[-1]) + np.repeat(starts - (ends - lengths), lengths)
