"""Vectorised words of Arrow text batches: spans and 64-bit hashes with numpy.

Works on the UTF-8 bytes of a batch as one array. A hash takes eight bytes at a
time and feeds each block into the state twice (as key and as input), all spans
of a batch side by side; spans of more than ``_LONG`` bytes are hashed by
BLAKE2b one by one. A second hash of other constants may be taken with the first,
so the two name a span by 128 bits. Spans are taken in portions, so memory does
not grow with a text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_LONG = 128
_PORTION = 1 << 14
_LANES = [(0x9E3779B97F4A7C15, 0xD1342543DE82EF95), (0xC2B2AE3D27D4EB4F, 0xAF251AF3B0F025B5)]
_BITS = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)

IS_SPACE = np.zeros(256, bool)
IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (a bijection)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def text_parts(batch: pa.RecordBatch, column: str = "text", limit: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with at most ``limit`` bytes of text, or one row."""
    sizes = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    at = 0
    while at < batch.num_rows:
        before = sizes[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(sizes, before + limit, "right")))
        yield batch.slice(at, to - at)
        at = to


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of all texts, offset of each text and the end); null counts as empty."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    _, offsets, data = texts.buffers()
    offs = np.frombuffer(offsets, np.int64)[texts.offset:texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offs[0]:offs[-1]], offs - offs[0]


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and text number of the words ``[^\\x20\\x09-\\x0D]+``."""
    inside = ~IS_SPACE[data]
    breaks = np.zeros(len(data) + 1, bool)
    breaks[offsets] = True
    before = np.zeros(len(data), bool)
    before[1:] = inside[:-1]
    starts = np.flatnonzero(inside & (~before | breaks[:-1]))
    after = np.zeros(len(data), bool)
    after[:-1] = inside[1:]
    ends = np.flatnonzero(inside & (~after | breaks[1:])) + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def _stir(state: np.ndarray, block: np.ndarray, factor: np.uint64) -> np.ndarray:
    return state ^ mix(mix(state ^ block) ^ (block * factor))


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each span."""
    return _span_hashes(data, starts, ends, False)[0]


def span_names(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two independent 64-bit hashes of each span, the first as ``span_hashes`` gives it."""
    return _span_hashes(data, starts, ends, True)


def _span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, both: bool) -> tuple[np.ndarray, np.ndarray]:
    (seed, factor), (seed2, factor2) = (tuple(np.uint64(x) for x in lane) for lane in _LANES)
    out = np.empty(len(starts), np.uint64)
    out2 = np.empty(len(starts) if both else 0, np.uint64)
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    blocks = np.ndarray(len(data) + 1, "<u8", padded, strides=(1,))  # the eight bytes from each place on
    for at in range(0, len(starts), _PORTION):
        start, end = starts[at:at + _PORTION], ends[at:at + _PORTION]
        size = end - start
        block = blocks[start] & _BITS[np.minimum(size, 8)]
        number = size.astype(np.uint64) + np.uint64(1)
        state = _stir(number * seed, block, factor)
        second = (number * seed2) ^ (block * factor2) if both else out2  # one to one for a given size
        live = np.flatnonzero((size > 8) & (size <= _LONG))
        place, left, own, own2 = start[live] + 8, size[live] - 8, state[live], second[live] if both else second
        while len(live):
            block = blocks[place] & _BITS[np.minimum(left, 8)]
            own = _stir(own, block, factor)
            if both:
                own2 = _stir(own2, block, factor2)
            done, on = left <= 8, left > 8
            state[live[done]] = own[done]
            if both:
                second[live[done]] = own2[done]
                own2 = own2[on]
            live, place, left, own = live[on], place[on] + 8, left[on] - 8, own[on]
        for k in np.flatnonzero(size > _LONG).tolist():
            digest = hashlib.blake2b(data[start[k]:end[k]], digest_size=16).digest()
            state[k] = int.from_bytes(digest[:8], "little")
            if both:
                second[k] = int.from_bytes(digest[8:], "little")
        out[at:at + _PORTION] = state
        if both:
            out2[at:at + _PORTION] = second
    return out, out2


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices start, start + 1, ... of each run, one run after the other."""
    ends = np.cumsum(lengths)
    if not len(ends):
        return np.zeros(0, np.int64)
    return np.repeat(starts - (ends - lengths), lengths) + np.arange(ends[-1])
