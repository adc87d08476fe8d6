"""Findings of the fourth round: small cases that failed before."""

import os
import random

import corpus_pipeline
from salesmart.llm import components, minhash
from salesmart.operators import catalog
from salesmart.session import work_dir
from salesmart.sources import files, fixtures


def _size_bits(frame):
    """Bits of the size in bytes that the planner estimates."""
    return frame._jdf.queryExecution().optimizedPlan().stats().sizeInBytes().bit_length()


def test_estimated_sizes_do_not_grow_with_the_rounds(spark, monkeypatch):
    """Each join multiplies the estimates; handed on from round to round their digits fill the driver."""
    seen, state = [], components._state
    monkeypatch.setattr(components, "_state", lambda edges: (seen.append(_size_bits(edges)), state(edges))[1])
    ids = list(range(60))
    random.Random(1).shuffle(ids)
    chain = spark.createDataFrame([*zip(ids[:-1], ids[1:], strict=True), (100, 101)], "a long, b long")
    found = components.connected(chain, "a", "b")
    assert {(r["node"], r["root"]) for r in found.collect()} == {(n, 0) for n in ids} | {(100, 100), (101, 100)}
    assert len(seen) >= 4 and max(seen) < 64 and _size_bits(found) < 64


def test_near_duplicates_plan_from_the_sizes_that_were_written(spark):
    texts = [(k, " ".join(f"w{k // 3}x{i}" for i in range(40)) + f" tail{k}") for k in range(12)]
    found = minhash.near_duplicates(spark.createDataFrame(texts, "doc_id long, text string"), words=1)
    assert _size_bits(found) < 128
    assert {(r["doc_id"], r["component_id"]) for r in found.collect()} == {(k, k // 3 * 3) for k in range(12)}


def test_files_are_listed_by_the_tasks_as_spark_lists_them(spark, monkeypatch):
    """Nested, hidden, empty, large and oddly named files: the rows of the binaryFile source, without its list on the driver."""
    root = work_dir(spark, "tr ee")
    for name in ("a.json", "_skipped", ".hid", "x._COPYING_", "_k=v.json", "n/b.json", "n/m/o/c.json", "n/_tmp/d.json", "n/.git/e.json", "_p=1/f.json",
                 "n+ é%41/g#?.json", "empty.json", "n/large.json", "_metadata", "document=h.json/part-0"):
        at = f"{root}/{name}"
        os.makedirs(os.path.dirname(at), exist_ok=True)
        with open(at, "wb") as f:
            f.write(b"" if "empty" in name else b"x" * 50 if "large" in name else f'{{"in": "{name}"}}'.encode() + b"\xff")
    os.makedirs(f"{root}/nothing/in/here")
    os.symlink(f"{root}/gone", f"{root}/n/link.json")
    os.symlink(f"{root}/a.json", f"{root}/n/second.json")
    rows = lambda df: sorted((r["path"], r["length"], r["content"] and bytes(r["content"])) for r in df.collect())
    whole = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    want = rows(whole.selectExpr("path", "length", "IF(length > 40, NULL, content) AS content"))
    found = files.whole_files(spark, root, 40)
    assert rows(found) == want and len(want) == 9 and sum(c is None for _, _, c in want) == 1
    assert not found.inputFiles() or not any(f.endswith(".json") for f in found.inputFiles())
    monkeypatch.setattr(files, "_located", lambda *a: None)
    assert rows(files.whole_files(spark, root, 40)) == want


def test_config_files_are_not_on_the_driver(spark):
    root = work_dir(spark, "configs")
    rows = spark.range(400).selectExpr("concat('f', id % 3) AS folder", "concat('d', id, '.json') AS document", "'{}' AS value")
    fixtures.write_documents(rows, root)
    found = catalog.config_files(spark, root)
    assert len(found.inputFiles()) < 100 and found.count() == 400


def test_the_near_stage_of_the_pipeline_plans_from_written_sizes(spark):
    texts = [(k, " ".join(f"w{k // 4}x{i}" for i in range(60)) + f" tail{k}") for k in range(12)]
    out = corpus_pipeline.drop_near_copies(spark, spark.createDataFrame(texts, "doc_id long, text string"), "")
    assert _size_bits(out) < 128 and sorted(r["doc_id"] for r in out.collect()) == [0, 4, 8]
