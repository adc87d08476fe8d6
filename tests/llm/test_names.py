"""Texts that a structured hash would confuse, first hashes that clash, and contexts without a cut."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from salesmart.llm import bpe, fertility, lm_score, minhash, pieces, secret_scan, spans, token_store, words

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def mirrored(n=10):
    """A text of two letters in Thue-Morse order and its mirror: equal under polynomials in odd bases modulo powers of two."""
    bits = [0]
    for _ in range(n):
        bits += [1 - b for b in bits]
    return "".join("ab"[b] for b in bits), "".join("ba"[b] for b in bits)


@pytest.fixture(scope="module")
def pair(spark):
    a, b = mirrored()
    return spark.createDataFrame([(1, a, "en", "s", 1024), (2, b, "en", "s", 1024)], SCHEMA)


def test_ids_of_confusable_texts(spark, pair):
    import public_tokenizers
    rows = {r["doc_id"]: r for r in bpe.round_trip(pair).collect()}
    assert rows[1]["ids_sha256"] != rows[2]["ids_sha256"] and all(r["same"] for r in rows.values())
    own = token_store.LibraryEncoder(public_tokenizers.path("byte_bpe_50k.json"))
    texts = list(mirrored())
    ids, counts = own.texts(pa.array(texts))
    want = [own.library.encode(t, add_special_tokens=False).ids for t in texts] if hasattr(own, "library") else None
    parts = np.split(ids, np.cumsum(counts)[:-1])
    assert parts[0].tolist() != parts[1].tolist()
    assert want is None or [p.tolist() for p in parts] == want


def test_confusable_texts_stay_apart(pair):
    rows = {r["doc_id"]: r for r in minhash.near_duplicates(pair).collect()}
    assert rows[1]["component_id"] == 1 and rows[2]["component_id"] == 2


def test_confusable_lines_and_words(spark):
    a, b = mirrored()
    data, offsets = words.text_bytes(pa.array([f"{a}\n{b}", f"{a}\n{a}"]))
    assert fertility.repeated_lines(data, offsets).tolist() == [0, 1]
    docs = spark.createDataFrame([(k, a, "en", "s", 1) for k in range(40)] + [(99, b, "en", "s", 1)], SCHEMA)
    held = {r["doc_id"]: r for r in lm_score.scored(docs).collect()} if hasattr(lm_score, "scored") else None
    if held:
        assert held[99]["n_known"] in (1, 2)


@pytest.mark.parametrize("n", [0, 1, 7, 8, 9, 16, 127, 128, 129, 400])
def test_names_depend_on_every_byte(n):
    base = bytes(range(65, 91)) * 20
    texts = [base[:n]] + [base[:k] + b"~" + base[k + 1:n] for k in range(n)] + [base[:n] + b"A"]
    data = np.frombuffer(b"".join(texts), np.uint8)
    ends = np.cumsum([len(t) for t in texts])
    for h in words.span_names(data, ends - [len(t) for t in texts], ends):
        assert len(set(h.tolist())) == len(texts)


def test_chunks_of_one_first_hash_keep_their_ids(monkeypatch):
    real = words.span_names

    def clashing(data, starts, ends):
        first, second = real(data, starts, ends)
        return first % np.uint64(2), second
    monkeypatch.setattr(pieces, "span_names", clashing)

    def encode(texts):
        return np.concatenate([np.frombuffer(t.encode(), np.uint8).astype(np.int32) for t in texts]), np.array([len(t.encode()) for t in texts])
    store = pieces.ChunkStore(encode)
    texts = ["one two three two one", "four one five", "six seven one two"] * 3
    ids, counts = store.texts(pa.array(texts))
    assert bytes(ids.tolist()).decode() == "".join(texts) and counts.tolist() == [len(t) for t in texts]


def test_shingles_of_one_first_hash_are_told_apart():
    sets = [np.array([[5, 5, 7], [1, 2, 3]], np.uint64), np.array([[5, 7], [2, 3]], np.uint64)]
    assert minhash._numbered(sets).tolist() == [0, 1, 2, 1, 2]
    assert minhash.confirmed(np.array([1, 2]), sets, np.array([-1, -1]), 67) == []
    assert minhash.confirmed(np.array([1, 2]), sets, np.array([-1, -1]), 66)


def located(spark, text, pattern="[0-9]+:?"):
    row = spans.located(spark.createDataFrame([(text,)], "text string"), pattern, "x", F.lit(True)).first()
    return [(m["v"], m["before"], m["after"], m["line"]) for m in row["x"]]


def test_neighbours_are_whole_words_and_neighbouring_matches(spark):
    long = "w" * 200
    got = located(spark, f"{long} {long} 12 {long} {long}\nab 7: 8")
    assert got[0][:3] == ("12", f"{long} {long} ", f" {long} {long}\nab {spans.OTHER}")
    assert got[1][1].endswith("ab ") and got[1][3] == 3
    assert got[2][1] == f"{spans.OTHER}:  " and got[2][2] == ""


@pytest.mark.parametrize("text", ["my_long_service_configuration_name_for_the_password = qwertyuiop",
                                  "MY_SERVICE_CONFIGURATION_DATABASE_MASTER_PASSWORD_OF_THE_CLUSTER=qwertyuiop"])
def test_long_keys_give_their_value(spark, text):
    docs = spark.createDataFrame([(1, text, "en", "s", 1)], SCHEMA)
    assert "qwertyuiop" in [r["value"] for r in secret_scan.candidates(docs).collect()]
