"""Token ids of whole texts through a bounded store of already encoded chunks.

A chunk is a run without spaces and the one space before it, cut again before
a comma or full stop that ends a word and behind a lone line feed before a
letter. A byte-level pre-tokeniser splits at all these places whatever stands
around them, so chunks encode independently, and a text's ids are its chunks'
ids in order. A text in which a space follows white space is encoded whole.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa

from salesmart.llm.words import IS_SPACE, mix, ragged, span_names, text_bytes

# Chunks that one worker keeps before it starts anew (about 60 bytes each).
STORE_CHUNKS = 1_000_000


_LETTER = np.zeros(256, bool)
_LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = True
_MARK = np.zeros(256, bool)
_MARK[[0x2C, 0x2E]] = True


def _inner_cuts(data: np.ndarray, breaks: np.ndarray) -> np.ndarray:
    """Bytes that start a chunk inside a run: a word's closing mark, a letter behind a lone line feed."""
    feed, letter = data == 0x0A, _LETTER[data]
    over = breaks[1:].copy()  # what stands behind ends the word: space, line feed or the text's end
    over[:-1] |= feed[1:] | (data[1:] == 0x20)
    out = np.zeros(len(data), bool)
    out[1:] = _MARK[data[1:]] & letter[:-1] & over[1:]
    out[2:] |= letter[2:] & feed[1:-1] & ~IS_SPACE[data[:-2]] & (data[:-2] < 0x80)
    return out


class ChunkStore:
    """Encodes text batches; ``encode`` maps a list of strings to (ids, counts).

    Known chunks are a sorted array of 64-bit hashes beside their places in one
    array of ids, so the store is a few flat arrays whatever the vocabulary.
    A second, independent hash of each chunk is compared before its ids are
    used; a chunk that shares only the first is encoded by itself.
    """

    def __init__(self, encode: Callable[[list[str]], tuple[np.ndarray, np.ndarray]], limit: int = STORE_CHUNKS):
        self.encode, self.limit = encode, limit
        self._reset()

    def _reset(self) -> None:
        self.keys, self.checks = np.zeros(0, np.uint64), np.zeros(0, np.uint64)
        self.starts, self.counts = np.zeros(0, np.int64), np.zeros(0, np.int32)
        self.odd = np.zeros(0, bool)
        self.ids = np.zeros(4096, np.int32)
        self.used = 0

    def _find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.searchsorted(self.keys, keys)
        if not len(self.keys):
            return at, np.zeros(len(keys), bool)
        return at, self.keys[np.minimum(at, len(self.keys) - 1)] == keys

    def _learn(self, keys: np.ndarray, checks: np.ndarray, texts: list[str]) -> None:
        ids, counts = self.encode(texts)
        if self.used + len(ids) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros(len(self.ids) // 2 + len(ids), np.int32)])
        self.ids[self.used:self.used + len(ids)] = ids
        # white space before a space: the chunk's text cannot be encoded alone
        odd = np.array([bool(t) and (t[-1].isspace() or t[-1] in "\x1c\x1d\x1e\x1f\x85") for t in texts], bool)
        order = np.argsort(both := np.concatenate([self.keys, keys]), kind="stable")
        self.keys, self.checks = both[order], np.concatenate([self.checks, checks])[order]
        self.starts = np.concatenate([self.starts, self.used + np.cumsum(counts) - counts])[order]
        self.counts = np.concatenate([self.counts, counts.astype(np.int32)])[order]
        self.odd = np.concatenate([self.odd, odd])[order]
        self.used += len(ids)

    def lookup(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Place in the store of each span (ordered, apart), learning those that are new."""
        keys, checks = span_names(data, starts, ends)
        unique, where, inverse = np.unique(keys, return_index=True, return_inverse=True)
        if len(self.keys) + len(unique) > self.limit:
            self._reset()
        _, known = self._find(unique)
        if not known.all():
            raw, new = data.tobytes(), where[~known]
            self._learn(unique[~known], checks[new], [raw[a:b].decode() for a, b in zip(starts[new].tolist(), ends[new].tolist(), strict=True)])
        at = self._find(unique)[0][inverse]
        odd = np.flatnonzero(self.checks[at] != checks)
        for k in odd.tolist():
            keys[k] = self._own_key(keys[k], checks[k], data[starts[k]:ends[k]])
        return self._find(keys)[0] if len(odd) else at

    def _own_key(self, key: np.uint64, check: np.uint64, chunk: np.ndarray) -> np.uint64:
        """Key of a chunk whose first hash belongs to another one: the next free key that both its hashes lead to."""
        while True:
            key = mix(np.array([key ^ check]))[0]
            place, known = self._find(np.array([key]))
            if not known[0]:
                self._learn(np.array([key]), np.array([check]), [chunk.tobytes().decode()])
                return key
            if self.checks[place[0]] == check:
                return key

    def texts(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, number of ids of each)."""
        data, offsets = text_bytes(texts)
        breaks = np.zeros(len(data) + 1, bool)
        breaks[offsets] = True
        starts = np.flatnonzero((data == 0x20) | breaks[:-1] | _inner_cuts(data, breaks))
        if not len(starts):
            return np.zeros(0, np.int32), np.zeros(len(texts), np.int64)
        ends = np.append(starts[1:], len(data))
        doc = np.searchsorted(offsets, starts, "right") - 1
        slot = self.lookup(data, starts, ends)
        counts = self.counts[slot].astype(np.int64)
        ids = self.ids[ragged(self.starts[slot], counts)]
        per_doc = np.bincount(doc, counts, len(texts)).astype(np.int64)
        space_next = np.append((doc[1:] == doc[:-1]) & (data[starts[1:]] == 0x20), False)
        broken = np.unique(doc[self.odd[slot] & space_next])
        if not len(broken):
            return ids, per_doc
        whole, whole_counts = self.encode([texts[int(d)].as_py() for d in broken])
        parts = np.split(ids, np.cumsum(per_doc)[:-1])
        for d, own in zip(broken, np.split(whole, np.cumsum(whole_counts)[:-1]), strict=True):
            parts[d], per_doc[d] = own, len(own)
        return np.concatenate(parts), per_doc
