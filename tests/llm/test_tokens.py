import base64
import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
import tiktoken
from tokenizers import Tokenizer

from salesmart.llm import bpe, token_store
from salesmart.llm.common import work_path

from .conftest import by_id, edge_rows

ODD = ["", " ", "a", "  a  b ", "foo\n bar", "x \n y", "a \n\n  b", "it's we'll 'tis", "w.\nNext, end.", "w.,\n\nx", "é.\nÉ", "<|endoftext|> x",
       "a" * 5000, "\x1c a\x85 b  c  d", " \n", "..., .\n\n.a"]


def random_texts(n=1500):
    rng = random.Random(11)
    letters = "abT  \n\n\té.,'s1² \x1c\x85你🙂!? "
    return ["".join(rng.choice(letters) for _ in range(rng.randint(0, 50))) for _ in range(n)]


@pytest.fixture(scope="module")
def library():
    with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def hub():
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    return t


def split(ids, counts):
    ends = np.cumsum(counts)
    return [ids[e - n:e].tolist() for e, n in zip(ends.tolist(), np.asarray(counts).tolist(), strict=True)]


def test_matrix_ids_equal_the_library(library):
    texts = ODD + random_texts()
    codec = bpe.Codec(*bpe.vocabulary())
    codec.store.limit = 300  # the store starts anew again and again
    for at in range(0, len(texts), 100):
        part = texts[at:at + 100]
        got = split(*codec.encode(pa.array(part)))
        assert got == [library.encode_ordinary(t) for t in part]
        assert [codec.decode(np.array(x, np.int64)) for x in got] == [t.encode() for t in part]


def test_long_rows_merge_like_the_matrix():
    merges = bpe.codec(*bpe.vocabulary()).merges
    rng = random.Random(5)
    for _ in range(500):
        letters = rng.choice(["ab", "aab", "thean", "0123", "é字"])
        raw = "".join(rng.choice(letters) for _ in range(rng.randint(2, 70))).encode()
        ids = merges.byte_ids[np.frombuffer(raw, np.uint8)]
        rows, counts = merges.merge_matrix(ids[None, :].copy(), np.array([len(ids)]))
        assert merges.merge_long(ids.copy()).tolist() == rows[0, :counts[0]].tolist()


def test_round_trip_query_on_edge_rows(clashing, empty, library):
    out = bpe.round_trip(clashing, with_ids=True)
    assert out.count() == len(edge_rows()) and bpe.round_trip(empty).count() == 0
    got = by_id(out)
    for i, text, *_ in edge_rows():
        if i is not None:
            ids = library.encode_ordinary(text or "")
            assert got[i]["ids"] == ids and got[i]["n_tokens"] == len(ids) and got[i]["same"]
            assert got[i]["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
            assert got[i]["decoded_sha256"] == hashlib.sha256((text or "").encode()).hexdigest()


def test_encode_then_decode_frames(small):
    back = bpe.decode_documents(bpe.encode_documents(small))
    assert {r["doc_id"]: bytes(r["data"]).decode() for r in back.collect()} == {r["doc_id"]: r["text"] for r in small.collect()}


def test_library_encoder_equals_whole_texts(hub):
    texts = ODD + random_texts()
    own = token_store.LibraryEncoder(public_tokenizers.path("byte_bpe_50k.json"))
    own.store.limit = 300
    for at in range(0, len(texts), 100):
        part = texts[at:at + 100]
        assert split(*own.texts(pa.array(part))) == [e.ids for e in hub.encode_batch(part, add_special_tokens=False)]


@pytest.mark.parametrize("files", [1, 5])
def test_store_reads_back_in_order(spark, clashing, hub, files):
    out = work_path(spark, "test-store")
    token_store.write_store(clashing, out, public_tokenizers.path("byte_bpe_50k.json"), files=files)
    rows = token_store.store_report(spark, out).collect()
    order = sorted(edge_rows(), key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    assert len(rows) == len(order)
    start = 0
    for want, got in zip(order, sorted(rows, key=lambda r: r["start"]), strict=True):
        ids = hub.encode(want[1] or "", add_special_tokens=False).ids + [2]
        assert (got["doc_id"], got["start"], got["n_tokens"]) == (want[0], start, len(ids))
        assert got["ids_crc32"] == zlib.crc32(np.array(ids, "<u4").tobytes())
        start += len(ids)


def test_store_files_are_selective(spark, small, empty):
    """List column with integer encodings, page indexes, and a reader that prunes columns."""
    out = work_path(spark, "test-store")
    token_store.write_store(small, out, public_tokenizers.path("byte_bpe_50k.json"), files=1, page_rows=20, page_bytes=4096)
    file = next(p for p in spark.read.parquet(out).inputFiles())
    meta = pq.ParquetFile(file.removeprefix("file://").removeprefix("file:")).metadata.row_group(0)
    columns = {meta.column(k).path_in_schema: meta.column(k) for k in range(meta.num_columns)}
    ids = columns["ids.list.element"]
    assert {"RLE_DICTIONARY", "DELTA_BINARY_PACKED"} & set(ids.encodings)
    assert all(c.has_offset_index and c.has_column_index for k, c in columns.items() if k == "doc_id")
    plan = token_store.read_store(spark, out).filter("doc_id = 3").select("n_tokens")._jdf.queryExecution().toString()
    assert "ids" not in plan.split("ReadSchema")[1] and "EqualTo(doc_id,3)" in plan
    none = work_path(spark, "test-store")
    token_store.write_store(empty, none, public_tokenizers.path("byte_bpe_50k.json"))
    assert token_store.store_report(spark, none).count() == 0
