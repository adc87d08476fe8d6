"""Findings of the third round: small cases that failed before."""

import datetime as dt
import glob
import os
import random
from dataclasses import replace

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesmart.llm import toxicity
from salesmart.operators import catalog, mart, normalize, windows
from salesmart.session import work_dir
from salesmart.sources import fixtures
from tests.test_load import LINES, SCHEMA, loaded

D = dt.date


def test_the_stage_keeps_text_of_rejects_only_and_rejects_are_compressed(spark):
    rejects = work_dir(spark, "bad")
    _, report = loaded(spark, LINES, rejects)
    stage = spark.read.parquet(report.stage)
    assert stage.where("(error IS NULL) <> (_raw IS NULL)").count() == 0 and stage.count() == 11
    files = [f for f in glob.glob(rejects.removeprefix("file://") + "/**/part-*", recursive=True)]
    assert files and all(f.endswith(".json.gz") for f in files)
    assert spark.read.option("recursiveFileLookup", True).json(rejects).where("length(raw) > 0").count() == 7


def test_names_of_a_record_are_normalised_together(spark):
    """Names with the separator in them, empty names, clashing names, no names and no record."""
    lines = [(1, '{"Dish.Sum-Int": "a", "Dish-Sum.Int": "b", "Extra.A": "1", "Extra-A": "2"}'), (2, r'{"x\u0001Dish_Sum_Int": "n", "A\u0001.B": "c"}'),
             (3, '{"": "e", "Dish.Sum.Int": "d"}'), (4, "{}"), (5, None), (6, '{"": "only"}')]
    records = spark.createDataFrame(lines, "k int, line string").select("k", F.from_json("line", "map<string,string>").alias("record"))
    schema = T.StructType([T.StructField("Dish_Sum_Int", T.StringType()), T.StructField("url", T.StringType(), False)])
    out = normalize.project_records(records, schema, F.lit("src"), keep=["k"])
    got = {r["k"]: (r["Dish_Sum_Int"], r["_unknown"], r["_malformed"]) for r in out.collect()}
    assert got == {1: ("b", ["Extra.A", "Extra-A"], False), 2: (None, ["x\x01Dish_Sum_Int", "A\x01.B"], False),
                   3: ("d", [""], False), 4: (None, [], False), 5: (None, [], True), 6: (None, [""], False)}


def test_files_of_a_hot_partition_are_many_but_its_tasks_few(spark):
    """Files hold at most ``range_rows`` rows each; one task writes many of them, and they still do not overlap."""
    schema = T.StructType([T.StructField("day", T.DateType(), False), T.StructField("dish", T.StringType()), T.StructField("url", T.StringType(), False)])
    spec = replace(mart.MartSpec(work_dir(spark, "many"), schema, "day", ("day", "dish")), range_rows=20)
    rows = spark.range(6000).selectExpr("date_add(DATE'2024-03-01', CAST(id * 7 % 28 AS INT)) AS day", "CAST(id * 13 % 50 AS STRING) AS dish",
                                        "IF(id % 50 = 0, IF(id % 100 = 0, NULL, 'http://b'), 'http://a') AS url").repartition(5)
    assert mart._layout(rows, spec).rdd.getNumPartitions() <= 2 * int(spark.conf.get("spark.sql.shuffle.partitions")) + 1
    mart.create_mart(spark, spec, rows)
    found = {r["url"]: r for r in mart.file_overlaps(spark, spec).collect()}
    assert {u: r["rows"] for u, r in found.items()} == {"http://a": 5880, "http://b": 60, None: 60}
    assert all(r["overlapping"] == 0 for r in found.values()) and found["http://a"]["files"] >= 294
    biggest = spark.read.parquet(spec.path).groupBy("_metadata.file_path").count().agg({"count": "max"}).first()[0]
    assert biggest <= 20


def test_every_task_gets_the_rows_of_its_window(spark):
    """One row per task and row of its window: equal, nested, single-day and reversed windows; equal rows stay apart."""
    as_of = D(2024, 1, 31)
    tasks = [("t0", "http://s0", 10, 5), ("t1", "http://s0", 10, 5), ("t2", "http://s1", 8, 2), ("t3", "http://s1", 4, 4), ("t4", "http://s1", 1, 3), ("t5", "http://s2", 3, 1)]
    cfg = spark.createDataFrame(tasks, "id string, source_url string, days_offset_start int, days_offset_end int")
    facts = [(f"http://s{k % 4}", as_of - dt.timedelta(days=k % 13), k // 2 * 2) for k in range(120)] * 2 + [("http://s0", None, 7), (None, as_of, 8)]
    rows = spark.createDataFrame(facts, "url string, day date, k int")
    out = windows.task_rows(cfg, rows, as_of, "day")
    assert out.columns == ["task_id", "url", "day", "k", "n_tasks"]
    held = {(u, d, k): sum(u == s and d is not None and b <= (as_of - d).days <= a for _, s, a, b in tasks) for u, d, k in facts}
    want = sorted((t, u, d, k, held[u, d, k]) for t, s, a, b in tasks for u, d, k in facts if u == s and d is not None and b <= (as_of - d).days <= a)
    assert sorted(tuple(r) for r in out.collect()) == want and want


def test_config_documents_are_files_without_folders_of_their_own(spark):
    """One file per document; odd, null and empty names, repeated and null lines, names that differ by folder."""
    root = work_dir(spark, "con figs")
    doc = '{"iiko": {"api_url": "h"},\n "clickhouse": {"host": "c"},\n "default_report_config": {}}'
    rows = [("a:b", "x_100%.json", doc), ("n/+ é", "y z.json", doc), ("n", "y z.json", doc), ("n", "two.json", doc), ("n", "two.json", doc),
            ("n", "none.json", None), (None, "q.json", doc), ("", "q.json", doc), ("n", None, doc), (".n", ".h.json", doc)]
    fixtures.write_documents(spark.createDataFrame(rows, "folder string, document string, value string").repartition(3), root)
    found = [os.path.join(at, name) for at, _, names in os.walk(root) for name in names]
    assert len(found) == 8 and all(os.path.basename(f).startswith("document=") for f in found)
    got = {r["relative_path"]: r["skip_reason"] for r in catalog.config_files(spark, root).collect()}
    no_name = "__HIVE_DEFAULT_PARTITION__"
    assert got == {"a:b/x_100%.json": None, "n/+ é/y z.json": None, "n/y z.json": None, "n/two.json": None, "n/none.json": "not json",
                   f"{no_name}/q.json": None, f"n/{no_name}": "name", ".n/.h.json": None}
    texts = spark.read.text(root, wholetext=True, recursiveFileLookup=True).collect()
    assert sorted(r["value"] for r in texts) == sorted([doc + "\n"] * 5 + [f"{doc}\n{doc}\n"] * 2 + ["\n"])


def test_config_ingest_makes_one_file_a_customer(spark):
    data, at = work_dir(spark, "tables"), work_dir(spark, "configs")
    spark.range(300).selectExpr("id AS c_custkey", "id % 3 AS c_nationkey").write.parquet(f"{data}/customer.parquet")
    spark.range(3).selectExpr("id AS n_nationkey", "concat('N ', id) AS n_name", "id % 2 AS n_regionkey").write.parquet(f"{data}/nation.parquet")
    spark.range(2).selectExpr("id AS r_regionkey", "concat('R_', id) AS r_name").write.parquet(f"{data}/region.parquet")
    fixtures.write_config_files(spark, data, at)
    levels = list(os.walk(at))
    assert sum(len(names) for _, _, names in levels) == 300
    assert sorted(os.path.basename(d) for d, _, _ in levels[1:]) == ["folder=r-0", "folder=r-1", "folder=temp"]
    before, most = spark.conf.get("spark.sql.files.maxPartitionBytes"), 4 * max(spark.sparkContext.defaultParallelism, 8)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4m")
    try:  # by Spark's own packing each file has a task in each scan
        found = catalog.config_files(spark, at)
        assert found.rdd.getNumPartitions() <= 2 * most < 300 and found.count() == 300
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_words_that_can_hold_no_lexicon_feature_are_not_searched():
    """The scorer finds the same lexicon words as with a search for every word, and searches few of them."""
    rng, alphabet = random.Random(5), "aabcdeilost" * 3 + "ABEIL01345789@$!|+(*.-_~'·€é" + "ßжİſ²"
    logp = np.log(np.random.default_rng(5).dirichlet(np.ones(toxicity._SIZE), (toxicity._SIZE, toxicity._SIZE)))
    words = ["".join(rng.choice(alphabet) for _ in range(rng.randint(1, 9))) for _ in range(6000)] + ["a" * 40 + "bc", "-" * 20 + "idiot", "1d1ot", "b4d", "éta"]
    every = toxicity.WordReader(logp, lambda said: {f for w in said for f in toxicity.features(w)})
    sure = every.reader.read
    names = sorted({f for w in words for f in every.value(every.restored(w))})
    texts = pa.array([" ".join(words[i:i + 40]) for i in range(0, len(words), 40)] + ["s p a c e d", "", None])
    for size in (1, 30, 400):
        chosen = set(rng.sample(names, size)) | {"idiot", "b4d", "éta*", "aaaa*"}
        pick = lambda said: tuple(sorted({f for w in said for f in toxicity.features(w)} & chosen))  # noqa: B023, E731
        found, searched = [], []
        for wanted in (None, chosen):
            own, n = toxicity.WordReader(logp, pick, wanted=wanted), [0]
            own.reader.read = lambda word, n=n: (n.__setitem__(0, n[0] + 1), sure(word))[1]
            doc, word, values, extra_doc, extra = own.texts(texts)
            found.append((sorted((d, values[w]) for d, w in zip(doc.tolist(), word.tolist(), strict=True) if values[w]), extra_doc, extra))
            searched.append(n[0])
        assert found[0] == found[1] and found[0][0] and searched[1] < searched[0] * (0.6 if size == 1 else 1)
    letters = [w for w in words if w.isascii() and w.isalpha()]
    few = toxicity.WordReader(logp, pick, wanted={"zebra"})
    few.texts(pa.array([" ".join(letters)]))
    assert len(letters) > 100 and len(few.known) <= 1  # the long run alone is told by more than its first bytes
