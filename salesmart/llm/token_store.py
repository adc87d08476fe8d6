"""Token ids as Parquet list columns, readable by column, row group and page.

Documents are dealt to files by ascending doc_id and sorted inside each, then
encoded and written by Spark's Parquet writer as one row per document:

* ``ids`` is a list of int; data pages are format version 2, so integers that
  do not fit a dictionary fall back to delta packing, and the dictionary is
  kept where it pays (dictionary size and page size are parameters)
* row groups and pages have a fixed size, pages carry column and offset
  indexes, so a reader that filters on doc_id or start positions reads the pages it needs
* ``part`` and ``at`` (ids of the same file before the document) stand beside
  the ids, so metadata can be read without them

A document's global start is ``at`` plus the ids of all earlier files. That
offset table has one row per file, never one per document.

Ids come from the ``tokenizers`` library: a chunk of text that a worker has
not met yet goes through the file's own pre-tokeniser and BPE model, a chunk
it has met comes from the worker's bounded store.

Defined cases
* null text counts as empty: only the end id; null doc_id sorts first
* rows that repeat in doc_id are ordered by text, then arbitrary among equals
* no rows in: an empty store with the same schema; extra columns are ignored
* a special token's string inside a text is ordinary text
"""

from __future__ import annotations

import os
import re
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from salesmart.llm.common import documents, partitions, work_path
from salesmart.llm.pieces import ChunkStore
from salesmart.llm.words import text_parts

END_ID = 2
_LETTER = "A-Za-zÀ-ÖØ-öø-ÿ"


class LibraryEncoder:
    """Chunks to ids through a tokenizers file, batch by batch."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.library = Tokenizer.from_file(path)
        self.library.encode_special_tokens = True
        self.store = ChunkStore(self._encode)
        # a word alone is one pre-token: it can go to the BPE model directly
        self.word = re.compile(rf" ?[{_LETTER}]+").fullmatch
        self.tokenize = self.library.model.tokenize
        self.spell = str.maketrans(self._byte_letters())

    @staticmethod
    def _byte_letters() -> dict[int, str]:
        """Byte-level alphabet: printable Latin-1 bytes stand for themselves, the others follow from U+0100."""
        plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        others = [b for b in range(256) if b not in set(plain)]
        return {b: chr(b) for b in plain} | {b: chr(0x100 + i) for i, b in enumerate(others)}

    def _word_ids(self, word: str) -> list[int]:
        return [t.id for t in self.tokenize(word.encode().decode("latin-1").translate(self.spell))]

    def _encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found: list[list[int] | None] = [None] * len(texts)
        other = []
        for i, text in enumerate(texts):
            if self.word(text):
                found[i] = self._word_ids(text)
            else:
                other.append(i)
        for i, e in zip(other, self.library.encode_batch_fast([texts[i] for i in other], add_special_tokens=False), strict=True):
            found[i] = e.ids
        counts = np.array([len(x) for x in found], np.int64)
        return np.fromiter((i for x in found for i in x), np.int32, int(counts.sum())), counts

    def texts(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        return self.store.texts(texts)


@lru_cache(maxsize=2)
def encoder(path: str) -> LibraryEncoder:
    """One encoder per worker process and vocabulary file."""
    return LibraryEncoder(path)


def write_store(docs: DataFrame, out: str, path: str, end_id: int = END_ID, files: int | None = None,
                row_group_bytes: int = 64 << 20, page_bytes: int = 256 << 10, page_rows: int = 2_000,
                dictionary_bytes: int = 256 << 10) -> None:
    """Encode all documents and write the store: part, at, doc_id, n_tokens, ids."""
    spark = docs.sparkSession
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        own, part, at = encoder(path), TaskContext.get().partitionId(), 0
        for batch in batches:
            for rows in text_parts(batch):
                ids, counts = own.texts(rows.column("text"))
                lengths = counts + 1
                ends = np.cumsum(lengths)
                closed = np.empty(int(ends[-1]), np.int32)
                inner = np.ones(len(closed), bool)
                inner[ends - 1] = False
                closed[inner] = ids
                closed[ends - 1] = end_id
                yield pa.record_batch(
                    [pa.array(np.full(rows.num_rows, part, np.int32)), pa.array(at + ends - lengths), rows.column("doc_id"),
                     pa.array(lengths), pa.ListArray.from_arrays(pa.array(np.append(0, ends).astype(np.int32)), pa.array(closed))],
                    names=["part", "at", "doc_id", "n_tokens", "ids"])
                at += int(ends[-1])

    dealt = (docs.select("doc_id", "text").repartitionByRange(files or partitions(spark), "doc_id")
             .sortWithinPartitions("doc_id", "text"))
    (dealt.mapInArrow(run, f"part int, at long, doc_id {kind}, n_tokens long, ids array<int>")
     .write.options(**{"parquet.writer.version": "PARQUET_2_0", "parquet.block.size": row_group_bytes,
                       "parquet.page.size": page_bytes, "parquet.page.row.count.limit": page_rows,
                       "parquet.enable.dictionary": "true", "parquet.dictionary.page.size": dictionary_bytes,
                       "compression": "zstd", "parquet.compression.codec.zstd.level": 1}).parquet(out))


def read_store(spark, out: str) -> DataFrame:
    return spark.read.parquet(out)


def offsets(store: DataFrame) -> DataFrame:
    """part, base: ids of all earlier files. One row per file."""
    sizes = store.groupBy("part").agg(F.sum("n_tokens").alias("size"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return sizes.select("part", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("base"))


def store_report(spark, out: str) -> DataFrame:
    """From the files: doc_id, start, n_tokens, ids_crc32, part, at."""
    store = read_store(spark, out)
    kind = store.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            ids = batch.column("ids")
            ends = ids.offsets.to_numpy()
            raw = memoryview(np.ascontiguousarray(ids.values.to_numpy().astype("<u4", copy=False))).cast("B")
            sums = [zlib.crc32(raw[4 * a:4 * b]) for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]
            yield pa.record_batch([batch.column("part"), batch.column("at"), batch.column("doc_id"),
                                   pa.array(np.diff(ends).astype(np.int64)), pa.array(sums, pa.int64())],
                                  names=["part", "at", "doc_id", "n_tokens", "ids_crc32"])
    rows = store.select("part", "at", "doc_id", "ids").mapInArrow(
        run, f"part int, at long, doc_id {kind}, n_tokens long, ids_crc32 long")
    # one row per file, so its size is bounded by the number of files
    return rows.join(F.broadcast(offsets(store)), "part").select(
        "doc_id", (F.col("at") + F.col("base")).alias("start"), "n_tokens", "ids_crc32", "part", "at")


def op4_token_store(spark, sf_dir):
    """All documents as token-id files, reported from the files."""
    import public_tokenizers
    out = work_path(spark, "token-store")
    write_store(documents(spark, sf_dir), out, public_tokenizers.path("byte_bpe_50k.json"))
    return store_report(spark, out).select("doc_id", "start", "n_tokens", "ids_crc32")
