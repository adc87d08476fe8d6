"""Merkle manifest and prefix trie against plain Python."""

import hashlib
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from salesmart.llm import merkle, ranks, trie

from .conftest import edge_rows


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(row):
    return sha(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (row[0], row[3], row[2], row[4], row[1])])


def tree_of(digests, arity):
    """(top, path of each leaf as (left, right) pairs)."""
    paths, owner, now = [[] for _ in digests], list(range(len(digests))), list(digests)
    while len(now) > 1:
        runs = [now[k:k + arity] for k in range(0, len(now), arity)]
        for k, p in enumerate(paths):
            run, slot = divmod(owner[k], arity)
            p.append(("".join(runs[run][:slot]), "".join(runs[run][slot + 1:])))
            owner[k] = run
        now = [sha(*r) for r in runs]
    return now[0], paths


def brute_manifest(rows, arity):
    by_source = defaultdict(list)
    for r in rows:
        by_source[r[3]].append(r)
    order = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    tops, out = [], []
    for s in order:
        own = sorted(by_source[s], key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r)))
        top, paths = tree_of([leaf_of(r) for r in own], arity)
        tops.append(top)
        out.append((own, top, paths))
    root, above = tree_of(tops, arity)
    found = []
    for (own, top, paths), up in zip(out, above, strict=True):
        for r, p in zip(own, paths, strict=True):
            whole = p + up
            found.append((r[0], leaf_of(r), top, root, sha(*[x for step in whole for x in step])))
    return sorted(found, key=str)


def manifest_rows(frame):
    rows = frame.select("doc_id", "leaf", "subroot", "root", merkle.proof_digest("path").alias("proof"), merkle.folded("path", "leaf").alias("folded")).collect()
    assert all(r["folded"] == r["root"] for r in rows)
    return sorted(((r["doc_id"], r["leaf"], r["subroot"], r["root"], r["proof"]) for r in rows), key=str)


@pytest.mark.parametrize("arity", [2, 3, 5])
def test_manifest_on_edge_rows(edge, clashing, arity):
    want = brute_manifest(edge_rows(), arity)
    assert manifest_rows(merkle.manifest(edge, arity=arity)) == want
    if arity == 3:
        assert manifest_rows(merkle.manifest(clashing, arity=arity)) == want


def test_manifest_of_nothing_and_of_one_row(edge, empty):
    assert merkle.manifest(empty).collect() == []
    row = merkle.manifest(edge.filter("doc_id = 8")).first()
    assert row["leaf"] == row["subroot"] == row["root"] and row["path"] == []


def test_a_changed_row_does_not_verify(edge):
    changed = F.concat(F.col("text"), F.lit("."))
    rows = merkle.manifest(edge, carry={"presented": merkle.leaf(altered={"text": changed})}).select(
        "doc_id", (merkle.folded("path", "presented") == F.col("root")).alias("ok")).collect()
    texts = {r[0]: r[1] for r in edge_rows()}
    assert all(r["ok"] == (texts[r["doc_id"]] is None) for r in rows if r["doc_id"] is not None)


def test_places_within_hot_groups(spark):
    rows = spark.range(5000).select(F.when(F.col("id") % 3 == 0, None).otherwise(F.col("id") % 2).alias("g"), (F.col("id") * 7919 % 5000).alias("v"))
    got = ranks.ranked(rows, "g", ["v"], "test-places").collect()
    by = defaultdict(list)
    for r in got:
        by[r["g"]].append((r["v"], r["place"], r["size"]))
    assert len(got) == 5000
    for found in by.values():
        found.sort()
        assert [p for _, p, _ in found] == list(range(len(found))) and {n for _, _, n in found} == {len(found)}


TURNS = "conv_id long, turn long, role string, text string, depth int, key string, place int, size int, length int"


def conversations():
    rows = []
    for c in range(65):
        if c in (20, 41):
            continue  # 21..39 have no base
        own = [("user", f"hello {c % 5}"), ("assistant", "hi there you"), ("user", f"ask {c % 3} one two"), ("assistant", f"{c}"), ("user", None), (None, "")]
        for t, (role, text) in enumerate(own[:c % 7 or 1]):
            rows.append((c, None if t == 0 and c % 4 == 0 else t, role, text))
    for t in range(300):
        rows.append((100, t, "user", f"long {t % 3}"))
    rows += [(c, 0, "user", "one copy of many") for c in range(200, 260)] + [(c, 1, "assistant", "same answer") for c in range(200, 260)]
    rows += [(None, 0, "user", "no conversation"), (300, 0, "user", "twice"), (300, 0, "user", "twice")]
    return [(*r, 1, "k", 2, 3, 4) for r in rows]


def brute_trie(rows):
    turns = defaultdict(list)
    for c, t, role, text, *_ in rows:
        if c is not None:
            role, text = role or "", text or ""
            turns[c].append((t is not None, t or 0, sha(f"{len(role.encode())}:", role, text)[:32], (role, text)))
    turns = {c: [x[3] for x in sorted(v)] for c, v in turns.items()}
    made = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 4
        made[c] = turns.get(c - c % 20, [])[:h] + own[h:]
    members = defaultdict(list)
    for c, seq in made.items():
        for d in range(len(seq) + 1):
            members[tuple(seq[:d])].append(c)
    children = defaultdict(list)
    for key in members:
        if key:
            children[key[:-1]].append(key)
    totals = {}
    for key in sorted(members, key=len, reverse=True):
        below = [totals[k] for k in children[key]]
        saved = (len(members[key]) - 1) * len((key[-1][1] if key else "").split())
        totals[key] = (sum(n for n, _ in below) or 1, saved + sum(s for _, s in below))
    return sorted((min(m), len(k), min(members[k[:-1]]) if k else -1, len(m), len(children[k]), *totals[k],
                   sha(",".join(map(str, sorted(c for c in m if made[c] == list(k)))))) for k, m in members.items())


def trie_rows(frame):
    return sorted((r["conv_id"], r["depth"], -1 if r["parent_conv_id"] is None else r["parent_conv_id"], r["n_convs"], r["n_children"], r["n_leaves"],
                   r["saved_tokens"], r["ends_sha256"]) for r in frame.collect())


@pytest.mark.parametrize(("shard", "fan", "queue"), [(trie.SHARD, trie.FAN, trie.QUEUE), (2, 3, 2), (16, 4, 50)])
def test_trie_against_plain_python(spark, shard, fan, queue):
    """Small shards make several tiers, a small queue spills."""
    frame = spark.createDataFrame(conversations(), TURNS)
    assert trie_rows(trie.prefix_trie(*trie.rebuilt(frame), shard=shard, fan=fan, queue=queue)) == brute_trie(conversations())


def test_trie_of_nothing(spark):
    assert trie.prefix_trie(*trie.rebuilt(spark.createDataFrame([], TURNS))).collect() == []


def test_sums_of_a_conversation_that_spans_tasks():
    key = [int(k).to_bytes(16, "big") for k in (5, 7, 11)]
    spans = [{"task": 0, "first": {"conv_id": 1, "depth": 1}, "last": {"conv_id": 2, "key": key[0]}},
             {"task": 1, "first": {"conv_id": 2, "depth": 4}, "last": {"conv_id": 2, "key": key[1]}},
             {"task": 2, "first": {"conv_id": 2, "depth": 9}, "last": {"conv_id": 3, "key": key[2]}},
             {"task": 3, "first": {"conv_id": 4, "depth": 1}, "last": {"conv_id": 4, "key": key[2]}}]
    assert trie._carried(spans) == {1: (2, 5), 2: (2, 12)}


def test_queue_spills_and_keeps_order():
    queue = trie.MessageQueue(limit=10)
    for k in range(1000):
        queue.push((k * 37 % 100, k))
    assert queue.spilled
    got = [m for head in range(100) for m in queue.take((head,))]
    assert [h for h, _ in got] == sorted(h for h, _ in got) and not len(queue)
    assert sorted(got) == sorted((k * 37 % 100, k) for k in range(1000))
