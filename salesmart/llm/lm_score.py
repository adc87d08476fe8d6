"""Language-model scores by deleted interpolation.

A word bigram model: P(w | h) mixes the maximum-likelihood estimates of the
bigram, of the word and a uniform floor. The mixture weights depend on how
often the context h was seen (buckets by powers of two) and are learned by
expectation-maximisation on a deleted part of the training documents whose
n-grams the estimates do not count; the final model then counts all training
documents.

The corpus is laid out in blocks of a few megabytes of text, each as arrays of
64-bit word keys. Counting is one exchange: every block sends its distinct
words and bigrams with their counts to the key range they fall in, the range
adds up the blocks, and the totals go back to the blocks that asked. So no
table of n-grams is ever held in one place, a frequent word costs one entry
per block, and what is exchanged grows with the corpus.

Keys are 64-bit hashes of the lower-cased words (A-Z only); two of n distinct
n-grams share a key with probability n^2 / 2^65.

Defined cases
* null or empty text: one token, the end
* no training documents: N = V = 0, every token is unknown, the floor scores
* no deleted documents with tokens: the weights keep their start values
* null id: hashed as empty text; rows that repeat count and score each
* no rows in, no rows out; extra columns are ignored
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.llm.common import documents, partitions, written
from salesmart.llm.words import LOWER, mix, span_hashes, text_bytes, text_parts, word_spans

FOLDS, HELD_OUT, DELETED = 7, 2, 3
BLOCK_BYTES = 8 << 20
BLOCKS_A_RANGE = 8  # so a key range holds no more than the keys of so many blocks, whatever the corpus
CONTEXT_CLASSES = 64
START_WEIGHTS = (0.5, 0.4, 0.1)  # bigram, word, floor
TOLERANCE = 1e-4
_END = np.uint64(0x452821E638D01377)
_START = np.uint64(0xBE5466CF34E90C6C)
_TRAIN, _SCORE_ONLY = 0, 1


def _packed(counts: np.ndarray) -> bytes:
    """Counts in the narrowest unsigned type, which the first byte names."""
    top = int(counts.max()) if len(counts) else 0
    width = 1 if top < 1 << 8 else 2 if top < 1 << 16 else 4 if top < 1 << 32 else 8
    return bytes([width]) + counts.astype(f"<u{width}").tobytes()


def _unpacked(data: bytes) -> np.ndarray:
    return np.frombuffer(data, f"<u{data[0]}", offset=1).astype(np.int64)


def _squeeze(a: np.ndarray) -> bytes:
    return a.nbytes.to_bytes(8, "little") + pa.compress(np.ascontiguousarray(a), codec="zstd", asbytes=True)


def _expand(data: bytes, dtype: str) -> np.ndarray:
    return np.frombuffer(pa.decompress(data[8:], int.from_bytes(data[:8], "little"), codec="zstd", asbytes=True), dtype)


def blocks(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The corpus as blocks: block, deleted, doc_ids, roles, sizes, words (sorted keys), tokens (places in words)."""
    def lay_out(rows: pa.RecordBatch, block: int, deleted: bool, fold: np.ndarray) -> list:
        data, offsets = text_bytes(rows.column("text"))
        starts, ends, doc = word_spans(LOWER[data], offsets)
        h = span_hashes(LOWER[data], starts, ends)
        sizes = np.bincount(doc, minlength=rows.num_rows) + 1
        tokens = np.empty(int(sizes.sum()), np.uint64)
        inner = np.ones(len(tokens), bool)
        inner[np.cumsum(sizes) - 1] = False
        tokens[inner], tokens[~inner] = h, _END
        words, at, counts = np.unique(tokens, return_inverse=True, return_counts=True)
        # places by falling frequency compress better; the sorted keys follow from them
        rank = np.empty(len(words), np.uint32)
        rank[np.argsort(-counts, kind="stable")] = np.arange(len(words), dtype=np.uint32)
        by_rank = np.empty(len(words), np.uint64)
        by_rank[rank] = words
        roles = np.where(fold == HELD_OUT, _SCORE_ONLY, _TRAIN).astype(np.uint8)
        return [block, deleted, rows.column("doc_id"), roles.tobytes(), sizes.astype("<u4").tobytes(), by_rank.tobytes(), _squeeze(rank[at])]

    def run(batches):
        at = TaskContext.get().partitionId() << 32
        for batch in batches:
            for part in text_parts(batch, limit=block_bytes):
                fold = np.array([zlib.crc32(b"" if i is None else str(i).encode()) % FOLDS for i in part.column("doc_id").to_pylist()])
                for deleted in (False, True):
                    mine = np.flatnonzero((fold == DELETED) == deleted)
                    if len(mine):
                        block, gone, ids, *rest = lay_out(part.take(pa.array(mine)), at, deleted, fold[mine])
                        at += 1
                        yield pa.record_batch(
                            [pa.array([block]), pa.array([gone]), pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids),
                             *[pa.array([x], pa.binary()) for x in rest]],
                            names=["block", "deleted", "doc_ids", "roles", "sizes", "words", "tokens"])
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        run, f"block long, deleted boolean, doc_ids array<{kind}>, roles binary, sizes binary, words binary, tokens binary")


class Block:
    """One block's arrays, and its distinct words and bigrams in key order."""

    def __init__(self, row: dict):
        self.sizes = np.frombuffer(row["sizes"], "<u4").astype(np.int64)
        self.roles = np.frombuffer(row["roles"], np.uint8)
        keys = np.frombuffer(row["words"], np.uint64)[_expand(row["tokens"], "<u4")]
        self.doc = np.repeat(np.arange(len(self.sizes)), self.sizes)
        before = np.empty_like(keys)
        before[1:] = keys[:-1]
        before[np.cumsum(self.sizes) - self.sizes] = _START
        self.words, self.word = np.unique(keys, return_inverse=True)
        pair = mix(before * np.uint64(0x9E3779B97F4A7C15) + mix(keys))
        self.pairs, self.where, self.pair = np.unique(pair, return_index=True, return_inverse=True)
        # a text's first context was seen once in every text, like the end
        context = np.where(before == _START, _END, before)
        self.context = np.searchsorted(self.words, context)

    def train_counts(self) -> tuple[np.ndarray, np.ndarray]:
        train = (self.roles == _TRAIN)[self.doc]
        return np.bincount(self.word[train], minlength=len(self.words)), np.bincount(self.pair[train], minlength=len(self.pairs))


def _ranges(keys: np.ndarray, n: int) -> np.ndarray:
    """Ends of the n key ranges in sorted keys."""
    edges = (np.arange(1, n, dtype=np.float64) / n * 2.0 ** 64).astype(np.uint64)
    return np.concatenate([[0], np.searchsorted(keys, edges), [len(keys)]])


def _asked(laid_out: DataFrame, n: int) -> DataFrame:
    """Per block and key range: the distinct keys with their training counts."""
    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                b = Block(row)
                words, pairs = b.train_counts()
                we, pe = _ranges(b.words, n), _ranges(b.pairs, n)
                hit = np.flatnonzero((np.diff(we) > 0) | (np.diff(pe) > 0))  # ranges the block has keys in
                w, p = [list(zip(e[hit].tolist(), e[hit + 1].tolist(), strict=True)) for e in (we, pe)]
                cols = [hit.astype(np.int32), [row["block"]] * len(hit), [row["deleted"]] * len(hit),
                        [b.words[i:j].tobytes() for i, j in w], [_packed(words[i:j]) for i, j in w],
                        [b.pairs[i:j].tobytes() for i, j in p], [_packed(pairs[i:j]) for i, j in p]]
                kinds = [pa.int32(), pa.int64(), pa.bool_(), *[pa.binary()] * 4]
                yield pa.record_batch([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)],
                                      names=["bucket", "block", "deleted", "words", "word_counts", "pairs", "pair_counts"])
    return laid_out.mapInArrow(run, "bucket int, block long, deleted boolean, words binary, word_counts binary, pairs binary, pair_counts binary")


def _totals(keys: list[bytes], counts: list[bytes], deleted: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(ends of the blocks' runs, kept total and full total of each key as asked, full total of each distinct key, kept)."""
    sizes = np.array([len(k) // 8 for k in keys])
    distinct, at = np.unique(np.frombuffer(b"".join(keys), np.uint64), return_inverse=True)
    n = np.concatenate([_unpacked(c) for c in counts]) if counts else np.zeros(0, np.int64)
    gone = np.repeat(deleted, sizes)
    kept = np.bincount(at[~gone], n[~gone], len(distinct)).astype(np.int64)
    full = kept + np.bincount(at[gone], n[gone], len(distinct)).astype(np.int64)
    return np.append(0, np.cumsum(sizes)), kept[at], full[at], np.stack([kept, full])


def _answers(batches):
    """Add up each key range; one row per asking block, and one with the range's sums (block -1)."""
    from salesmart.llm.minhash import _groups
    for group in _groups(batches, ["bucket"]):
        rows = group.to_pydict()
        deleted = np.array(rows["deleted"], bool)
        we, w_kept, w_full, w_all = _totals(rows["words"], rows["word_counts"], deleted)
        pe, p_kept, p_full, _ = _totals(rows["pairs"], rows["pair_counts"], deleted)
        out = {"block": [-1], "bucket": [rows["bucket"][0]], "deleted": [False], "w_full": [None], "p_full": [None], "w_kept": [None], "p_kept": [None],
               "n_kept": [int(w_all[0].sum())], "v_kept": [int((w_all[0] > 0).sum())], "n_full": [int(w_all[1].sum())], "v_full": [int((w_all[1] > 0).sum())]}
        for i, (block, gone) in enumerate(zip(rows["block"], rows["deleted"], strict=True)):
            w, p = slice(we[i], we[i + 1]), slice(pe[i], pe[i + 1])
            values = [block, rows["bucket"][0], gone, _packed(w_full[w]), _packed(p_full[p]),
                      _packed(w_kept[w]) if gone else None, _packed(p_kept[p]) if gone else None, 0, 0, 0, 0]
            for name, v in zip(out, values, strict=True):
                out[name].append(v)
        kinds = [pa.int64(), pa.int32(), pa.bool_(), *[pa.binary()] * 4, *[pa.int64()] * 4]
        yield pa.record_batch([pa.array(v, k) for v, k in zip(out.values(), kinds, strict=True)], names=list(out))


def exchange(laid_out: DataFrame) -> DataFrame:
    """For every block and key range the training totals of the block's keys, in key order."""
    n = partitions(laid_out.sparkSession)
    ranges = max(4 * n, laid_out.count() // BLOCKS_A_RANGE)
    return (_asked(laid_out, ranges).repartition(n, "bucket").sortWithinPartitions("bucket", "block")
            .mapInArrow(_answers, "block long, bucket int, deleted boolean, w_full binary, p_full binary, w_kept binary, p_kept binary, "
                                  "n_kept long, v_kept long, n_full long, v_full long"))


def _joined(answers: pa.Table, name: str) -> np.ndarray:
    order = np.argsort(answers.column("bucket").to_numpy(), kind="stable")
    column = answers.column(name)
    return np.concatenate([_unpacked(column[int(i)].as_py()) for i in order]) if len(order) else np.zeros(0, np.int64)


def context_class(counts: np.ndarray) -> np.ndarray:
    """0 for unseen contexts, else one more than the power of two below the count."""
    return np.where(counts > 0, np.floor(np.log2(np.maximum(counts, 1))).astype(np.int64) + 1, 0)


def _shares(c2, ch, cw, n: int, v: int) -> np.ndarray:
    """Bigram, word and floor probabilities, one column each."""
    return np.stack([c2 / np.maximum(ch, 1), cw / max(n, 1), np.full(len(c2), 1.0 / (v + 1))], axis=1)


def learn_weights(laid_out: DataFrame, answers: DataFrame, n: int, v: int, tolerance: float = TOLERANCE) -> np.ndarray:
    """Mixture weights per context class, by EM over the deleted documents' bigrams."""
    def events(asked: pa.Table, got: pa.Table) -> pa.Table:
        if not asked.num_rows:
            return pa.table({"block": pa.array([], pa.int64()), "events": pa.array([], pa.binary())})
        b = Block(asked.to_pylist()[0])
        words, pairs = _joined(got, "w_kept"), _joined(got, "p_kept")
        # a bigram's own context and word, from the first place it stands at
        table = np.stack([pairs, words[b.context[b.where]], words[b.word[b.where]], np.bincount(b.pair, minlength=len(b.pairs))])
        return pa.table({"block": asked.column("block"), "events": pa.array([_squeeze(table.astype("<u4").ravel())], pa.binary())})
    held = written(laid_out.filter("deleted").groupBy("block").cogroup(answers.filter("deleted and block >= 0").groupBy("block"))
                   .applyInArrow(events, "block long, events binary"), "lm-events")
    weights = np.tile(np.array(START_WEIGHTS), (CONTEXT_CLASSES, 1))
    seen = np.zeros(CONTEXT_CLASSES, bool)

    def step(now: np.ndarray):
        def run(batches):
            total = np.zeros((CONTEXT_CLASSES, 3))
            for batch in batches:
                for data in batch.column("events"):
                    c2, ch, cw, m = _expand(data.as_py(), "<u4").reshape(4, -1).astype(np.int64)
                    kind = context_class(ch)
                    part = now[kind] * _shares(c2, ch, cw, n, v)
                    part *= (m / part.sum(1))[:, None]
                    for k in range(3):
                        total[:, k] += np.bincount(kind, part[:, k], CONTEXT_CLASSES)
            at = np.flatnonzero(total.sum(1))
            yield pa.record_batch([pa.array(at), *[pa.array(total[at, k]) for k in range(3)]], names=["kind", "a", "b", "c"])
        # one row per context class comes back
        return held.mapInArrow(run, "kind long, a double, b double, c double").groupBy("kind").agg(F.sum("a"), F.sum("b"), F.sum("c")).collect()
    while True:
        new = weights.copy()
        for kind, *mass in step(weights):
            new[kind] = np.array(mass) / sum(mass)
            seen[kind] = True
        change = np.abs(new - weights).max()
        weights = new
        if change < tolerance:
            break
    # the floor keeps a share where nothing was seen, so no token has probability 0
    weights = np.maximum(weights, 1e-6)
    weights /= weights.sum(1, keepdims=True)
    for k in range(2, CONTEXT_CLASSES):
        if not seen[k] and seen[:k].any():
            weights[k] = weights[np.flatnonzero(seen[:k])[-1]]
    return weights


def score(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    laid_out = written(blocks(docs, block_bytes), "lm-blocks")
    answers = written(exchange(laid_out), "lm-totals")
    sums = answers.filter("block = -1").agg(*[F.coalesce(F.sum(c), F.lit(0)) for c in ("n_kept", "v_kept", "n_full", "v_full")]).first()
    n_kept, v_kept, n, v = (int(x) for x in sums)
    weights = learn_weights(laid_out, answers, n_kept, v_kept)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def rate(asked: pa.Table, got: pa.Table) -> pa.Table:
        row = asked.to_pylist()[0]
        b = Block(row)
        words, pairs = _joined(got, "w_full"), _joined(got, "p_full")
        cw, ch = words[b.word], words[b.context]
        base = np.log10((cw + 1) / (n + v + 1))
        p = (weights[context_class(ch)] * _shares(pairs[b.pair], ch, cw, n, v)).sum(1)
        size = len(b.sizes)
        return pa.table({"doc_id": asked.column("doc_ids").combine_chunks().values, "held_out": pa.array(b.roles == _SCORE_ONLY),
                         "n_tokens": pa.array(b.sizes), "n_known": pa.array(np.bincount(b.doc[cw > 0], minlength=size)),
                         "train_tokens": pa.array(np.full(size, n)), "base_score": pa.array(np.bincount(b.doc, base, size)),
                         "score": pa.array(np.bincount(b.doc, np.log10(p), size))})
    return (laid_out.groupBy("block").cogroup(answers.filter("block >= 0").groupBy("block"))
            .applyInArrow(rate, f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"))


def op2_deleted_interpolation(spark, sf_dir):
    """Scores of all documents under a bigram model with deleted interpolation."""
    return score(documents(spark, sf_dir))
