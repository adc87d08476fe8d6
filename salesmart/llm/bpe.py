"""Byte-level BPE over length-bucketed, padded numpy matrices.

The pieces of a batch that the store does not know yet are sorted into
buckets by length and laid out as padded matrices of byte ids. In each round
every row merges its leftmost pair of minimum rank: ranks sit in a second
matrix, the minimum is found per row, and the column behind it is compacted
away, which removes exactly one element from each active row. Only the two
pairs beside a merge are looked up again, in an open-addressing hash table
from (left id, right id) to rank. Rows without a ranked pair leave the matrix.

Decoding gathers the tokens' bytes by id.

Defined cases
* null text counts as empty: no ids, empty bytes
* text that is not valid after decoding cannot occur: ids decode to the input bytes
* rows that repeat and null ids are ordinary rows; extra columns are ignored
* no rows in, no rows out; a text of any length is split into pieces first, and a
  piece of more than ``LONG`` bytes merges all occurrences of a pair in one round
"""

from __future__ import annotations

import base64
import hashlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from salesmart.llm.common import documents
from salesmart.llm.pieces import ChunkStore
from salesmart.llm.words import mix, ragged, text_bytes, text_parts

NO_PAIR = np.int32(2**31 - 1)
LONG = 512  # bytes; longer pieces are rows of their own


class Merges:
    """Ranks of a byte-level vocabulary file (base64 token and rank per line)."""

    def __init__(self, path: str):
        with open(path, "rb") as lines:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        tokens = sorted(self.ranks, key=self.ranks.get)
        size = max(self.ranks.values()) + 1
        self.byte_ids = np.array([self.ranks[bytes([b])] for b in range(256)], np.int32)
        lengths = np.zeros(size, np.int64)
        for t in tokens:
            lengths[self.ranks[t]] = len(t)
        self.token_lengths = lengths
        self.token_starts = np.cumsum(lengths) - lengths
        by_id = [b""] * size
        for t in tokens:
            by_id[self.ranks[t]] = t
        self.token_bytes = np.frombuffer(b"".join(by_id), np.uint8)
        left, right, rank = [], [], []
        for token, r in self.ranks.items():
            for cut in range(1, len(token)):
                a, b = self.ranks.get(token[:cut]), self.ranks.get(token[cut:])
                if a is not None and b is not None:
                    left.append(a), right.append(b), rank.append(r)
        self._hash_pairs(np.array(left, np.int64), np.array(right, np.int64), np.array(rank, np.int32))

    def _hash_pairs(self, left, right, rank) -> None:
        bits = max(4, int(len(left) * 2).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), np.int64((1 << bits) - 1)
        self.slot_key = np.full(1 << bits, -1, np.int64)
        self.slot_rank = np.full(1 << bits, NO_PAIR, np.int32)
        keys = (left << 32) | right
        at, todo = self._slot(keys), np.arange(len(keys))
        while len(todo):
            free = self.slot_key[at[todo]] == -1
            self.slot_key[at[todo[free]]] = keys[todo[free]]  # the last writer of a slot has it
            has = self.slot_key[at[todo]] == keys[todo]
            self.slot_rank[at[todo[has]]] = rank[todo[has]]
            todo = todo[~has]
            at[todo] = (at[todo] + 1) & self.mask

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return (mix(keys.astype(np.uint64)) >> self.shift).astype(np.int64)

    def pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, NO_PAIR where it has none or is padding (negative)."""
        out = np.full(left.shape, NO_PAIR, np.int32)
        real = np.flatnonzero((left >= 0) & (right >= 0))
        keys = (left.ravel()[real].astype(np.int64) << 32) | right.ravel()[real]
        at = self._slot(keys)
        flat = out.reshape(-1)
        while len(real):
            found = self.slot_key[at]
            hit = found == keys
            flat[real[hit]] = self.slot_rank[at[hit]]
            go = ~hit & (found != -1)
            real, keys, at = real[go], keys[go], (at[go] + 1) & self.mask
        return out

    def merge_matrix(self, ids: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Merge the rows of a padded matrix (padding -1); (ids, count of each row)."""
        done = np.full_like(ids, -1)
        counts = lengths.copy()
        row = np.arange(len(ids))
        ranks = self.pair_ranks(ids[:, :-1], ids[:, 1:]) if ids.shape[1] > 1 else np.zeros((len(ids), 0), np.int32)
        while len(row) and ranks.shape[1]:
            at = ranks.argmin(1)  # the leftmost minimum
            n = np.arange(len(row))
            best = ranks[n, at]
            active = best != NO_PAIR
            if not active.all():
                out = ~active
                done[row[out], :ids.shape[1]] = ids[out]
                row, ids, ranks, at, best = row[active], ids[active], ranks[active], at[active], best[active]
                n = np.arange(len(row))
                if not len(row):
                    break
            ids[n, at] = best
            keep = np.ones(ids.shape, bool)
            keep[n, at + 1] = False
            ids = ids[keep].reshape(len(row), -1)
            keep = np.ones(ranks.shape, bool)
            keep[n, at] = False
            ranks = ranks[keep].reshape(len(row), -1)
            counts[row] -= 1
            width = ids.shape[1]
            if width > 1:
                has = np.flatnonzero(at > 0)
                ranks[has, at[has] - 1] = self.pair_ranks(ids[has, at[has] - 1], ids[has, at[has]])
                has = np.flatnonzero(at < width - 1)
                ranks[has, at[has]] = self.pair_ranks(ids[has, at[has]], ids[has, at[has] + 1])
        if len(row):
            done[row, :ids.shape[1]] = ids
        return done, counts

    def merge_long(self, ids: np.ndarray) -> np.ndarray:
        """The same merges for one long row, with all merges of one pair in a round.

        The pairs of least rank merge from left to right; the round stops behind
        a merge that makes a pair of that rank or less, which would come next.
        """
        while len(ids) > 1:
            ranks = self.pair_ranks(ids[:-1], ids[1:])
            best = ranks.min()
            if best == NO_PAIR:
                break
            at = np.flatnonzero(ranks == best)
            at = at[_within(at - np.arange(len(at))) % 2 == 0]  # of overlapping pairs every other one
            before = np.where(at > 0, ids[at - 1], -1)
            before[1:][at[1:] == at[:-1] + 2] = best
            behind = np.where(at + 2 < len(ids), ids[np.minimum(at + 2, len(ids) - 1)], -1)
            new = np.full(len(at), best, np.int32)
            lower = np.minimum(self.pair_ranks(before.astype(np.int32), new), self.pair_ranks(new, behind.astype(np.int32))) <= best
            if lower.any():
                at = at[:int(np.argmax(lower)) + 1]
            ids[at] = best
            ids = np.delete(ids, at + 1)
        return ids

    def encode_pieces(self, pieces: list[bytes], cells: int = 1 << 20) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all pieces in order, count of each)."""
        counts = np.zeros(len(pieces), np.int64)
        lengths = np.array([len(p) for p in pieces], np.int64)
        raw = self.byte_ids[np.frombuffer(b"".join(pieces), np.uint8)]
        starts = np.cumsum(lengths) - lengths
        whole = np.array([self.ranks.get(p, -1) for p in pieces], np.int64)
        known = whole >= 0  # a piece that is a token stays whole
        counts[known] = 1
        found: list[tuple[np.ndarray, np.ndarray]] = [(np.flatnonzero(known), whole[known].astype(np.int32))]
        for i in np.flatnonzero(~known & (lengths > LONG)).tolist():
            merged = self.merge_long(raw[starts[i]:starts[i] + lengths[i]].copy())
            counts[i] = len(merged)
            found.append((np.full(len(merged), i), merged))
        rest = np.flatnonzero(~known & (lengths > 0) & (lengths <= LONG))
        rest = rest[np.argsort(lengths[rest], kind="stable")]
        bucket = np.ceil(np.log2(np.maximum(lengths[rest], 2))).astype(np.int64)
        for b in np.unique(bucket):
            members = rest[bucket == b]
            step = max(1, cells >> int(b))
            for i in range(0, len(members), step):
                rows = members[i:i + step]
                width = int(lengths[rows].max())
                at = np.arange(width)[None, :]
                inside = at < lengths[rows][:, None]
                ids = np.where(inside, raw[np.minimum(starts[rows][:, None] + at, len(raw) - 1)], np.int32(-1))
                merged, n = self.merge_matrix(ids, lengths[rows].copy())
                counts[rows] = n
                found.append((np.repeat(rows, n), merged[np.arange(width)[None, :] < n[:, None]]))
        out = np.empty(int(counts.sum()), np.int32)
        first = np.cumsum(counts) - counts
        for rows, ids in found:
            if len(rows):
                out[first[rows] + _within(rows)] = ids
        return out, counts

    def decode(self, ids: np.ndarray) -> bytes:
        n = self.token_lengths[ids]
        return self.token_bytes[ragged(self.token_starts[ids], n)].tobytes()


def _within(rows: np.ndarray) -> np.ndarray:
    """Position of each element in its run of equal values."""
    new = np.append(True, rows[1:] != rows[:-1])
    at = np.flatnonzero(new)
    return np.arange(len(rows)) - np.repeat(at, np.diff(np.append(at, len(rows))))


class Codec:
    """Whole texts to ids and back, with a store of chunks already encoded."""

    def __init__(self, path: str, pattern: str):
        self.merges = Merges(path)
        self.find = regex.compile(pattern).findall
        self.store = ChunkStore(self._encode)

    def _encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        split = [self.find(t) for t in texts]
        pieces = list({p: None for s in split for p in s})
        number = {p: i for i, p in enumerate(pieces)}
        ids, counts = self.merges.encode_pieces([p.encode() for p in pieces])
        starts = np.cumsum(counts) - counts
        each = np.array([number[p] for s in split for p in s], np.int64)
        doc = np.repeat(np.arange(len(texts)), [len(s) for s in split])
        return ids[ragged(starts[each], counts[each])], np.bincount(doc, counts[each], len(texts)).astype(np.int64)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        return self.store.texts(texts)

    def decode(self, ids: np.ndarray) -> bytes:
        return self.merges.decode(ids)


@lru_cache(maxsize=2)
def codec(path: str, pattern: str) -> Codec:
    """One codec per worker process and vocabulary."""
    return Codec(path, pattern)


def vocabulary() -> tuple[str, str]:
    """Default vocabulary file and split pattern."""
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


def encode_documents(docs: DataFrame, path: str | None = None, pattern: str | None = None) -> DataFrame:
    """doc_id, ids (array of int) of every text."""
    default = vocabulary() if path is None or pattern is None else ("", "")
    file, split = path or default[0], pattern or default[1]

    def run(batches):
        own = codec(file, split)
        for batch in batches:
            for part in text_parts(batch):
                ids, counts = own.encode(part.column("text"))
                offsets = np.append(0, np.cumsum(counts)).astype(np.int32)
                yield pa.record_batch([part.column("doc_id"), pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids))],
                                      names=["doc_id", "ids"])
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, ids array<int>")


def decode_documents(encoded: DataFrame, path: str | None = None, pattern: str | None = None) -> DataFrame:
    """doc_id, data (the bytes the ids stand for)."""
    default = vocabulary() if path is None or pattern is None else ("", "")
    file, split = path or default[0], pattern or default[1]

    def run(batches):
        own = codec(file, split)
        for batch in batches:
            ids = batch.column("ids")
            data = [own.decode(np.asarray(x.values, np.int64)) if x.is_valid else None for x in ids]
            yield pa.record_batch([batch.column("doc_id"), pa.array(data, pa.binary())], names=["doc_id", "data"])
    kind = encoded.schema["doc_id"].dataType.simpleString()
    return encoded.select("doc_id", "ids").mapInArrow(run, f"doc_id {kind}, data binary")


def round_trip(docs: DataFrame, path: str | None = None, pattern: str | None = None, with_ids: bool = False) -> DataFrame:
    """Encode and decode every text; doc_id, n_tokens, ids_sha256, decoded_sha256, same, and the ids if wanted.

    ``same`` tells whether the decoded bytes are the text's.
    """
    default = vocabulary() if path is None or pattern is None else ("", "")
    file, split = path or default[0], pattern or default[1]

    def run(batches):
        own = codec(file, split)
        for batch in batches:
            for part in text_parts(batch):
                ids, counts = own.encode(part.column("text"))
                data, offsets = text_bytes(part.column("text"))
                ends = np.cumsum(counts)
                rows = []
                for i, (end, n) in enumerate(zip(ends.tolist(), counts.tolist(), strict=True)):
                    one = ids[end - n:end]
                    back = own.decode(one)
                    rows.append((n, hashlib.sha256(one.astype("<u4").tobytes()).hexdigest(), hashlib.sha256(back).hexdigest(),
                                 back == data[offsets[i]:offsets[i + 1]].tobytes()))
                cols = list(zip(*rows, strict=True)) if rows else [[], [], [], []]
                out = {"doc_id": part.column("doc_id"), "n_tokens": pa.array(cols[0], pa.int64()), "ids_sha256": pa.array(cols[1], pa.string()),
                       "decoded_sha256": pa.array(cols[2], pa.string()), "same": pa.array(cols[3], pa.bool_())}
                if with_ids:
                    out["ids"] = pa.ListArray.from_arrays(pa.array(np.append(0, ends).astype(np.int32)), pa.array(ids))
                yield pa.record_batch(list(out.values()), names=list(out))
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string, same boolean" + ", ids array<int>" * with_ids)


def op9_byte_bpe(spark, sf_dir):
    """Ids of all documents by the multilingual byte-level vocabulary, and back."""
    return round_trip(documents(spark, sf_dir)).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
