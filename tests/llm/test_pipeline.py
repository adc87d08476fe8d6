import hashlib
import re
from collections import Counter

import pytest

import corpus_pipeline
from salesmart.llm import toxicity
from salesmart.llm.common import documents, labels

from .conftest import SMALL, edge_rows
from .test_dedup import brute_near, strip
from .test_quality import WORD, brute_targets


@pytest.fixture(scope="module")
def stages(spark):
    """The rows before the first and after each stage, each stage on what the last one wrote."""
    docs, out = documents(spark, SMALL), [documents(spark, SMALL).collect()]
    from salesmart.llm.common import written
    for name, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, SMALL), name)
        out.append(docs.collect())
    return out


def test_toxic_rows_go(spark, stages):
    docs = documents(spark, SMALL)
    scored = toxicity.score(docs, toxicity.fit(docs, labels(spark, SMALL))).collect()
    clean = {r["doc_id"] for r in scored if r["score"] < toxicity.THRESHOLD}
    assert {r["doc_id"] for r in stages[1]} == clean


def test_one_exact_copy_stays(stages):
    groups = {}
    for r in stages[1]:
        groups.setdefault(strip(r["text"]), []).append((-len(r["text"]), r["doc_id"]))
    assert {r["doc_id"] for r in stages[2]} == {min(g)[1] for g in groups.values()}


def test_one_near_copy_stays(stages):
    component, _ = brute_near([(r["doc_id"], r["text"]) for r in stages[2]], 5, 80)
    assert {r["doc_id"] for r in stages[3]} == {i for i, c in component.items() if i == c}


def test_mix_of_what_is_left(stages):
    sizes, largest, taken = Counter(), Counter(), Counter()
    for r in stages[3]:
        n = len(WORD.findall(r["text"]))
        sizes[r["source"]] += n
        largest[r["source"]] = max(largest[r["source"]], n)
    for r in stages[4]:
        taken[r["source"]] += len(WORD.findall(r["text"]))
    for s, t in brute_targets(sizes).items():
        assert abs(taken[s] - t) <= largest[s] / 2 + 1e-6
    assert max(Counter(r["doc_id"] for r in stages[4]).values()) <= 2


def test_ids_decode_to_the_texts(stages):
    texts = {r["doc_id"]: r["text"] for r in stages[4]}
    assert Counter(r["doc_id"] for r in stages[5]) == Counter(r["doc_id"] for r in stages[4])
    for r in stages[5]:
        assert r["same"] and r["n_tokens"] == len(r["ids"])
        assert r["decoded_sha256"] == hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest()


def test_edge_rows_pass_all_stages(spark, clashing, empty):
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, clashing, SMALL)
        assert out.columns == clashing.columns, name
        assert out.count() <= 2 * len(edge_rows())
        assert stage(spark, empty, SMALL).count() == 0
    assert corpus_pipeline.encode(spark, clashing, SMALL).count() == len(edge_rows())


def test_stage_list():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "exact_dedup", "near_dedup", "source_mix", "byte_bpe"]
    assert all(re.fullmatch("[a-z_]+", n) for n, _ in corpus_pipeline.STAGES)
