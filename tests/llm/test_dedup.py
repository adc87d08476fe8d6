import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from salesmart.llm import components, exact_dedup, minhash

from .conftest import by_id, edge_rows


def strip(text):
    return re.sub(r"[\x20\x09-\x0D]", "", text or "")


def brute_exact(rows):
    groups = {}
    for r in rows:
        groups.setdefault(strip(r[1]), []).append(r)
    out = {}
    for norm, members in groups.items():
        best = min(members, key=lambda r: (-len(r[1] or ""), r[0] is None, r[0] if r[0] is not None else 0))
        for r in members:
            out[r[0]] = (best[0], len(members), r[0] == best[0])
    return out


def test_exact_groups_on_edge_rows(edge, clashing):
    want = brute_exact(edge_rows())
    for docs in (edge, clashing):
        rows = exact_dedup.exact_groups(docs).collect()
        assert len(rows) == len(edge_rows())
        assert {r["doc_id"]: (r["keep_id"], r["group_size"], r["kept"]) for r in rows if r["doc_id"] is not None} == {
            k: v for k, v in want.items() if k is not None}


def test_exact_groups_on_documents(small):
    rows = [(r["doc_id"], r["text"]) for r in small.collect()]
    want = brute_exact(rows)
    got = {r["doc_id"]: (r["keep_id"], r["group_size"], r["kept"]) for r in exact_dedup.exact_groups(small).collect()}
    assert got == want


def test_clashing_identifiers_fall_back_to_the_text(edge):
    """Identifiers of four values at most: verification fails, the groups stay right."""
    def bad(chunk):
        return F.pmod(F.xxhash64(chunk), F.lit(4))
    want = {k: v for k, v in brute_exact(edge_rows()).items() if k is not None}
    got = {k: (r["keep_id"], r["group_size"], r["kept"]) for k, r in by_id(exact_dedup.exact_groups(edge, bad)).items()}
    assert got == want


def test_chunks_rebuild_the_text(small):
    base = small.select(exact_dedup.normalised().alias("norm"))
    assert base.filter(F.concat_ws("", exact_dedup.chunked()) != F.col("norm")).count() == 0


def test_exact_deduplicate_keeps_whole_rows(clashing, empty):
    kept = exact_dedup.deduplicate(clashing)
    assert kept.columns == clashing.columns
    texts = [strip(r["text"]) for r in kept.collect()]
    assert sorted(texts) == sorted({strip(r[1]) for r in edge_rows()})
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan  # few keys to drop: no text is shuffled for them
    assert exact_dedup.deduplicate(empty).count() == 0
    assert exact_dedup.exact_groups(empty).count() == 0


def shingles(text, n):
    w = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return frozenset(tuple(w[i:i + n]) for i in range(len(w) - n + 1)) if len(w) >= n else frozenset([tuple(w)] if w else [])


def brute_near(rows, n=3, percent=85):
    """Component of each document, by comparing all pairs that share a shingle."""
    sets = {i: shingles(t, n) for i, t in rows}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    holders = {}
    for i in sorted(sets):
        common = Counter(j for s in sets[i] for j in holders.get(s, ()))
        for j, c in common.items():
            if 100 * c >= percent * (len(sets[i]) + len(sets[j]) - c):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
        for s in sets[i]:
            holders.setdefault(s, []).append(i)
    return {i: find(i) for i in sets}, {i: len(s) for i, s in sets.items()}


@pytest.mark.parametrize("block", [512, 3])
def test_near_duplicates_match_brute_force(spark, block):
    """A chain of near copies, exact copies, short texts; small blocks split the cluster."""
    words = [f"w{i}" for i in range(120)]
    rows = []
    for k in range(12):  # each differs from the last in one word: ends of the chain are not linked directly
        words[k * 9 + 4] = f"new{k}"
        rows.append((100 + k, " ".join(words)))
    rows += [(1, " ".join(words).upper()), (2, "a b"), (3, "A  b"), (4, "a b c"), (5, ""), (6, None), (7, "a b c d")]
    want, sizes = brute_near(rows)
    got = by_id(minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), block=block))
    assert {i: r["component_id"] for i, r in got.items()} == want
    assert {i: r["n_shingles"] for i, r in got.items()} == sizes
    assert all(r["kept"] == (i == r["component_id"]) for i, r in got.items())


def template_pages(pages, copies, rng):
    """Pages of one template with texts of their own, some with near copies; sizes from short to long."""
    template = [f"t{i}" for i in range(40)]
    rows = []
    for p in range(pages):
        own = template + [f"p{p}x{i}" for i in range(20 + p % 60)]
        for _ in range(1 + copies * (p % 9 == 0)):
            text = list(own)
            text[rng.randrange(len(text))] = f"c{len(rows)}"
            rows.append((len(rows) + 1, " ".join(text if len(rows) % 2 else own)))
    return rows


@pytest.mark.parametrize(("block", "block_shingles"), [(4, 1 << 20), (512, 300), (6, 200)])
def test_clusters_of_template_pages_are_split(spark, block, block_shingles):
    rows = template_pages(150, 6, random.Random(5))
    want, _ = brute_near(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string").cache()
    # wide bands chain the pages into one cluster, as similarities of a half do among many pages
    got = by_id(minhash.near_duplicates(docs, block=block, block_shingles=block_shingles, split=4, bands=60, rows=2))
    assert {i: r["component_id"] for i, r in got.items()} == want
    members = minhash.classes(minhash.signed(docs, bands=60, rows=2)).cache()
    chained = minhash.candidate_clusters(members)
    assert chained.groupBy("root").count().agg({"count": "max"}).first()[0] > 150
    split = minhash.split_clusters(docs, chained, most=16)
    assert split.groupBy("root").count().agg({"count": "max"}).first()[0] < 20


def test_work_on_template_pages_is_linear(spark):
    """Sets that reach the comparison, copies to blocks counted, against the pages of one cluster."""
    for pages in (100, 400):
        docs = spark.createDataFrame(template_pages(pages, 6, random.Random(6)), "doc_id long, text string").cache()
        members = minhash.classes(minhash.signed(docs, bands=60, rows=2)).cache()
        plan = minhash.planned(minhash.split_clusters(docs, minhash.candidate_clusters(members), most=16), members, block=4)
        meetings = plan.selectExpr("aggregate(map_values(plan), 0, (a, b) -> a + b) as n").agg({"n": "sum"}).first()[0]
        assert meetings < 3 * pages


def test_sets_two_classes_apart_are_never_linked(spark):
    for percent in (50, 67, 80, 85, 99, 100):
        sizes = spark.range(1, 3000).withColumnRenamed("id", "n").withColumn("c", minhash._size_class(percent)).orderBy("n").collect()
        of = {r["n"]: r["c"] for r in sizes}
        assert all(of[n] - of[-(-percent * n // 100)] <= 1 for n in of)


def test_near_duplicates_on_edge_rows(edge, clashing, empty):
    named = {r[0]: r[1] for r in edge_rows() if r[0] is not None}
    want, _ = brute_near(list(named.items()))
    out = minhash.near_duplicates(clashing)
    assert out.count() == len(edge_rows())
    assert {i: r["component_id"] for i, r in by_id(out).items()} == want
    assert out.filter("doc_id is null and not kept").count() == 0
    assert minhash.near_duplicates(empty).count() == 0
    kept = minhash.deduplicate(clashing)
    assert kept.columns == clashing.columns
    assert {r["doc_id"] for r in kept.collect()} - {None} == {i for i, c in want.items() if i == c}


def test_components_of_chains_stars_and_repeats(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, k) for k in range(101, 130)] + [(7, 7), (3, 2), (2, 3), (200, 201)]
    got = {r["node"]: r["root"] for r in components.connected(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()}
    assert got == {**{i: 0 for i in range(41)}, **{k: 100 for k in range(100, 130)}, 200: 200, 201: 200}
    assert components.connected(spark.createDataFrame([], "a long, b long"), "a", "b").count() == 0


