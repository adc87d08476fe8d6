"""Near-duplicate documents by circulant MinHash, banding and exact Jaccard.

Two permutations make the whole signature: every shingle gets a place by the
first one, coordinate k is the least value of the second one over the places
shifted by k, modulo the domain (2^32). The signature is cut into bands.

* documents with the same shingle set are one class, found by a 128-bit
  fingerprint of the sorted set; the rest works on one document of each class
* documents that share a band are joined to the least one of the band, and the
  components of these edges are candidate clusters: every pair that shares a
  band lies in one cluster, though no pairs are listed
* a cluster of more than ``SPLIT`` blocks is split first: its shingles are put in
  order of how many of its sets hold them, rarest first. Two linked sets share
  one of the first ``n - ceil(t * n) + 1`` shingles of each (prefix filter), so
  the components over these shared shingles lose no link. Pages that share a
  template but have texts of their own fall apart here, at a cost that is linear in
  their shingles: about 260 bytes for each are written and shuffled, as rows, against 16
  for each block that a set meets, so below some 16 blocks the split costs more than
  it can save
* each cluster's full shingle sets are compared exactly. Sets of a cluster that
  is more than one block are dealt by classes of size, such that only sets of
  one class or of neighbouring ones can be linked, and within a class into
  blocks of about ``BLOCK`` sets and ``BLOCK_SHINGLES`` shingles at most. Every
  pair of blocks that can hold a link is a task of its own, so no cluster is held
  by one task and no pair is left out. A task counts intersections over an
  inverted index and returns a spanning forest of the links it confirmed
* components of the confirmed links are the result

With 28 bands of 6 rows a pair at the threshold 0.85 shares no band with
probability 2e-6, a pair at 0.9 with 5e-10.

Defined cases
* null text, no words: empty set, linked with nothing, its own component
* fewer words than a shingle: the whole sequence is the one shingle
* rows that repeat in doc_id are one node; a row without doc_id takes the
  component of an equal set that has one, else null, and is kept
* no rows in, no rows out; extra columns are ignored
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.llm.common import documents, hot_join, partitions, written
from salesmart.llm.components import connected
from salesmart.llm.words import LOWER, mix, ragged, span_names, text_bytes, text_parts, word_spans

SHINGLE = 3
BANDS, ROWS = 28, 6
THRESHOLD = 85  # percent
BLOCK = 512
BLOCK_SHINGLES = 1 << 20  # 16 bytes each
SPLIT = 16  # blocks
_PLACE_SEED = np.uint64(0x6A09E667F3BCC908)
_ORDER_SEED = np.uint32(0x3C6EF372)


def shingle_sets(texts: pa.Array, words: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(sorted distinct shingle hashes of all texts, a second hash of each, number of each text)."""
    raw, offsets = text_bytes(texts)
    data = LOWER[raw]
    starts, ends, doc = word_spans(data, offsets)
    names = span_names(data, starts, ends)
    n = np.bincount(doc, minlength=len(texts))
    first = np.cumsum(n) - n
    width = np.minimum(words, n)  # of a text's shingles
    count = np.where(n > 0, n - width + 1, 0)
    at = ragged(first, count)
    owner = np.repeat(np.arange(len(texts)), count)
    key = mix(width[owner].astype(np.uint64))
    check = mix(key)
    for k in range(words):
        use = k < width[owner]
        key[use], check[use] = (mix(x[use] * np.uint64(0x9E3779B97F4A7C15) + h[at[use] + k]) for x, h in zip((key, check), names, strict=True))
    order = np.lexsort((key, owner))
    key, check, owner = key[order], check[order], owner[order]
    same = (key[1:] == key[:-1]) & (owner[1:] == owner[:-1])
    if (same & (check[1:] != check[:-1])).any():  # a first hash of two shingles
        order = np.lexsort((check, key, owner))
        key, check, owner = key[order], check[order], owner[order]
        same = (key[1:] == key[:-1]) & (check[1:] == check[:-1]) & (owner[1:] == owner[:-1])
    new = np.append(np.ones(min(len(key), 1), bool), ~same)
    return key[new], check[new], np.bincount(owner[new], minlength=len(texts)).astype(np.int64)


def signatures(keys: np.ndarray, counts: np.ndarray, coordinates: int, block: int = 1 << 16) -> np.ndarray:
    """Circulant MinHash signature of each non-empty set, one row each."""
    full = counts[counts > 0]
    ends = np.cumsum(full)
    place = (mix(keys ^ _PLACE_SEED) >> np.uint64(32)).astype(np.uint32)
    out = np.full((len(full), coordinates), 0xFFFFFFFF, np.uint32)
    for lo in range(0, len(keys), block):
        hi = min(lo + block, len(keys))
        d0, d1 = np.searchsorted(ends, lo, "right"), np.searchsorted(ends, hi - 1, "right")
        cuts = np.maximum(ends[d0:d1 + 1] - full[d0:d1 + 1] - lo, 0)
        x, t = np.empty(hi - lo, np.uint32), np.empty(hi - lo, np.uint32)
        for k in range(coordinates):
            np.add(place[lo:hi], np.uint32(k + 1), out=x)  # the circular shift: modulo 2^32
            np.bitwise_xor(x, _ORDER_SEED, out=x)
            for shift, factor in ((16, 0x85EBCA6B), (13, 0xC2B2AE35), (16, 0)):
                np.right_shift(x, np.uint32(shift), out=t)
                np.bitwise_xor(x, t, out=x)
                if factor:
                    np.multiply(x, np.uint32(factor), out=x)
            low = np.minimum.reduceat(x, cuts)
            np.minimum(out[d0:d1 + 1, k], low, out=out[d0:d1 + 1, k])
    return out


def band_keys(signature: np.ndarray, bands: int = BANDS, rows: int = ROWS) -> np.ndarray:
    keys = np.empty((len(signature), bands), np.uint64)
    for b in range(bands):
        k = mix(np.full(len(signature), b + 1, np.uint64))
        for r in range(rows):
            k = mix(k * np.uint64(0x9E3779B97F4A7C15) + signature[:, b * rows + r])
        keys[:, b] = k
    return keys.view(np.int64)


def signed(docs: DataFrame, words: int = SHINGLE, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """doc_id, n_shingles, set_key (fingerprint of the shingle set), bands."""
    def run(batches):
        for batch in batches:
            for part in text_parts(batch):
                keys, checks, counts = shingle_sets(part.column("text"), words)
                has = counts > 0
                own = band_keys(signatures(keys, counts, bands * rows), bands, rows)
                ends = np.cumsum(counts)
                prints = [hashlib.blake2b(keys[e - n:e].tobytes() + checks[e - n:e].tobytes(), digest_size=16).digest() for e, n in zip(ends.tolist(), counts.tolist(), strict=True)]
                offsets = np.append(0, np.cumsum(np.where(has, bands, 0))).astype(np.int32)
                yield pa.record_batch(
                    [part.column("doc_id"), pa.array(counts), pa.array(prints, pa.binary()),
                     pa.ListArray.from_arrays(pa.array(offsets), pa.array(own.ravel()))],
                    names=["doc_id", "n_shingles", "set_key", "bands"])
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n_shingles long, set_key binary, bands array<long>")


def classes(rows: DataFrame) -> DataFrame:
    """The rows with ``rep``, the smallest doc_id that has the same shingle set."""
    same = rows.groupBy("set_key").agg(F.min("doc_id").alias("least"), F.count("*").alias("n")).filter("n > 1 and least is not null").drop("n")
    joined = hot_join(rows, same, ["set_key"], how="left")
    rep = F.when(F.col("n_shingles") > 0, F.coalesce("least", "doc_id")).otherwise(F.col("doc_id"))
    return joined.select("doc_id", "n_shingles", rep.alias("rep"), "bands")


def candidate_clusters(members: DataFrame) -> DataFrame:
    """node, root, size: the documents that share a band with another, by cluster."""
    banded = (members.filter("doc_id = rep and n_shingles > 0").select("rep", F.explode("bands").alias("band")))
    shared = banded.groupBy("band").agg(F.min("rep").alias("hub"), F.max("rep").alias("top")).filter("hub < top").drop("top")
    edges = hot_join(banded, shared, ["band"], salts=8).filter("rep <> hub").select("rep", "hub")
    return connected(edges, "rep", "hub")


def split_clusters(docs: DataFrame, clusters: DataFrame, words: int = SHINGLE, percent: int = THRESHOLD, most: int = SPLIT * BLOCK) -> DataFrame:
    """node, root: clusters of more than ``most`` nodes fall into the components over shared prefix shingles.

    A shingle that one set alone holds is no edge, but it fills a place of its set's prefix.
    Nodes of such clusters that share no prefix shingle have no link and are left out.
    """
    clusters = written(clusters, "clusters")
    large = written(clusters.groupBy("root").agg(F.count("*").alias("size")).filter(F.col("size") > most), "large")
    if not large.head(1):
        return clusters
    parts = hot_join(clusters, large.select("root", F.lit(True).alias("split")), ["root"], how="left")
    rows = docs.select("doc_id", "text").join(parts.filter("split"), docs["doc_id"] == parts["node"]).select("node", "root", "text")
    # rows that repeat a node's id are told apart by their set
    held = written(set_keys(rows, words).select("node", "root", F.xxhash64("keys").alias("set"), F.size("keys").alias("n"), F.explode("keys").alias("key")), "held")
    shared = held.groupBy("root", "key").agg(F.count("*").alias("sets")).filter("sets > 1")
    common = hot_join(held, shared, ["root", "key"], salts=8)
    prefix = F.col("n") - F.ceil(F.col("n") * F.lit(percent) / F.lit(100)) + F.lit(1)
    first = (common.groupBy("root", "node", "set", "n").agg(F.sort_array(F.collect_set(F.struct("sets", "key"))).alias("held"))
             .withColumn("places", (prefix - (F.col("n") - F.size("held"))).cast("int"))
             .filter("places > 0").select("root", "node", F.explode(F.slice("held", F.lit(1), F.col("places"))).alias("h"))
             .select("root", "node", F.col("h.key").alias("key")))
    first = written(first, "first")
    hubs = first.groupBy("root", "key").agg(F.min("node").alias("hub"), F.max("node").alias("top")).filter("hub < top").drop("top")
    edges = hot_join(first, hubs, ["root", "key"], salts=8).filter("node <> hub").select("node", "hub")
    return parts.filter("split is null").select("node", "root").unionByName(connected(edges, "node", "hub"))


def _size_class(percent: int):
    """Class of a set's size: sets two classes apart cannot be linked."""
    step = max(math.log(100 / percent) * (1 + 1e-9), 0.01)
    return F.floor(F.log(F.col("n").cast("double")) / F.lit(step)).cast("int")


def planned(clusters: DataFrame, members: DataFrame, percent: int = THRESHOLD, block: int = BLOCK, block_shingles: int = BLOCK_SHINGLES) -> DataFrame:
    """node, root, plan: blocks of each size class of the cluster; class -1 holds a cluster that is one block."""
    def blocks(sets, shingles):
        return F.ceil(F.greatest(F.col(sets) / F.lit(block), F.col(shingles) / F.lit(block_shingles))).cast("int")
    sized = hot_join(members.filter("n_shingles > 0").select(F.col("doc_id").alias("node"), F.col("n_shingles").alias("n")), clusters, ["node"], salts=8)
    by_class = (sized.withColumn("class", _size_class(percent)).groupBy("root", "class")
                .agg(F.count("*").alias("sets"), F.sum("n").alias("shingles")).withColumn("blocks", blocks("sets", "shingles")))
    plans = (by_class.groupBy("root").agg(F.sum("sets").alias("sets"), F.sum("shingles").alias("shingles"),
                                          F.map_from_entries(F.collect_list(F.struct("class", "blocks"))).alias("plan"))
             .select("root", F.when(blocks("sets", "shingles") > 1, F.col("plan")).otherwise(F.create_map(F.lit(-1), F.lit(1))).alias("plan")))
    return hot_join(clusters, plans, ["root"], salts=8)


def set_keys(docs: DataFrame, words: int = SHINGLE) -> DataFrame:
    """The rows with the distinct first hashes of their shingles instead of the text."""
    names = [c for c in docs.columns if c != "text"]

    def run(batches):
        for batch in batches:
            for part in text_parts(batch):
                keys, _, counts = shingle_sets(part.column("text"), words)
                offsets = pa.array(np.append(0, np.cumsum(counts)).astype(np.int32))
                lists = pa.ListArray.from_arrays(offsets, pa.array(keys.view(np.int64)))
                yield pa.record_batch([*[part.column(c) for c in names], lists], names=[*names, "keys"])
    schema = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in names)
    return docs.select(*names, "text").mapInArrow(run, f"{schema}, keys array<long>")


def set_rows(docs: DataFrame, words: int = SHINGLE) -> DataFrame:
    """The rows with their shingle set (the 64-bit hashes, then the second ones) instead of the text."""
    names = [c for c in docs.columns if c != "text"]

    def run(batches):
        for batch in batches:
            for part in text_parts(batch):
                keys, checks, counts = shingle_sets(part.column("text"), words)
                ends = np.cumsum(counts)
                sets = [keys[e - n:e].tobytes() + checks[e - n:e].tobytes() for e, n in zip(ends.tolist(), counts.tolist(), strict=True)]
                yield pa.record_batch([*[part.column(c) for c in names], pa.array(sets, pa.binary())], names=[*names, "shingles"])
    schema = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in names)
    return docs.select(*names, "text").mapInArrow(run, f"{schema}, shingles binary")


def _groups(batches, keys: list[str]) -> Iterator[pa.Table]:
    """The groups of batches sorted by ``keys``, one table each."""
    open_rows: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        cols = [batch.column(k).to_numpy(zero_copy_only=False) for k in keys]
        change = np.zeros(batch.num_rows, bool)
        for c in cols:
            change[1:] |= c[1:] != c[:-1]
        cuts = [0, *np.flatnonzero(change).tolist(), batch.num_rows]
        for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
            key = tuple(c[lo] for c in cols)
            if last is not None and key != last:
                yield pa.Table.from_batches(open_rows)
                open_rows = []
            last = key
            open_rows.append(batch.slice(lo, hi - lo))
    if open_rows:
        yield pa.Table.from_batches(open_rows)


def _numbered(sets: list[np.ndarray]) -> np.ndarray:
    """A number per shingle of all sets, equal where both hashes are."""
    keys, checks = (np.concatenate([s[k] for s in sets]) for k in (0, 1))
    _, first, number = np.unique(keys, return_index=True, return_inverse=True)
    if (checks == checks[first][number]).all():
        return number
    order = np.lexsort((checks, keys))
    new = np.append(True, (keys[order][1:] != keys[order][:-1]) | (checks[order][1:] != checks[order][:-1]))
    number[order] = np.cumsum(new) - 1
    return number


def confirmed(nodes: np.ndarray, sets: list[np.ndarray], side: np.ndarray, percent: int = THRESHOLD) -> list[tuple[int, int]]:
    """Spanning forest of the exact links between the documents of a group.

    A set is two rows: the hashes of its shingles and their second hashes. ``side`` is 0 or 1 where two blocks meet (links across only) and -1 within one block.
    """
    root = list(range(len(nodes)))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    sizes = np.array([s.shape[1] for s in sets], np.int64)
    links = []
    indexed = np.flatnonzero(side != 0)
    asking = np.flatnonzero(side != 1)
    number = _numbered(sets)
    first = np.cumsum(sizes) - sizes
    posting_doc = np.repeat(indexed, sizes[indexed])
    posting_term = number[ragged(first[indexed], sizes[indexed])]
    order = np.argsort(posting_term, kind="stable")
    posting_doc = posting_doc[order]
    per_term = np.bincount(posting_term, minlength=int(number.max()) + 1)
    at = np.cumsum(per_term) - per_term
    left = len(nodes)
    for i in asking:
        if left == 1:
            break
        terms = number[first[i]:first[i] + sizes[i]]
        common = np.bincount(posting_doc[ragged(at[terms], per_term[terms])], minlength=len(nodes))
        hit = np.flatnonzero(100 * common >= percent * (sizes[i] + sizes - common))
        for j in hit.tolist():
            a, b = find(int(i)), find(j)
            if a != b:
                root[a] = b
                left -= 1
                links.append((int(nodes[i]), int(nodes[j])))
    return links


def links(docs: DataFrame, clusters: DataFrame, words: int = SHINGLE, percent: int = THRESHOLD) -> DataFrame:
    """a, b: confirmed links that connect all documents linked within each cluster."""
    spark = docs.sparkSession
    rows = docs.select("doc_id", "text").join(clusters, docs["doc_id"] == clusters["node"]).select("node", "root", "plan", "text")
    rows = set_rows(rows, words).withColumn("n", (F.length("shingles") / 16).cast("int")).filter("n > 0")
    rows = rows.withColumn("i", F.when(F.col("plan")[-1].isNotNull(), F.lit(-1)).otherwise(_size_class(percent)))
    rows = rows.withColumn("own", F.pmod(F.xxhash64("node"), F.col("plan")[F.col("i")]).cast("int"))

    # the blocks that a block meets, each pair once: (class, block) and the same of the other, the lesser one first
    def meets(other, first, second, side):
        return (f"if(plan[{other}] is null, array(), transform(sequence(0, plan[{other}] - 1), o -> "
                f"named_struct('i', {first[0]}, 'own', {first[1]}, 'j', {second[0]}, 'other', {second[1]}, 'side', {side})))")
    pairs = "concat({}, {}, {})".format(
        meets("i", ("i", "least(own, o)"), ("i", "greatest(own, o)"), "case when own = o then -1 when own < o then 0 else 1 end"),
        meets("i + 1", ("i", "own"), ("i + 1", "o"), "0"),
        meets("i - 1", ("i - 1", "o"), ("i", "own"), "1"))
    keys = ["root", "i", "own", "j", "other"]
    dealt = rows.select("node", "root", "shingles", F.explode(F.expr(pairs)).alias("p")).select("root", "p.*", "node", "shingles")

    def run(batches):
        for group in _groups(batches, keys):
            found = confirmed(group.column("node").to_numpy(), [np.frombuffer(x, np.uint64).reshape(2, -1) for x in group.column("shingles").to_pylist()],
                              group.column("side").to_numpy(), percent)
            if found:
                a, b = zip(*found, strict=True)
                yield pa.record_batch([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])
    return (dealt.repartition(partitions(spark), *keys).sortWithinPartitions(*keys, "node")
            .mapInArrow(run, "a long, b long"))


def near_duplicates(docs: DataFrame, words: int = SHINGLE, percent: int = THRESHOLD, bands: int = BANDS, rows: int = ROWS,
                    block: int = BLOCK, block_shingles: int = BLOCK_SHINGLES, split: int = SPLIT) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    members = written(classes(written(signed(docs, words, bands, rows), "signed")), "members")
    clusters = split_clusters(docs, candidate_clusters(members), words, percent, split * block)
    confirmed_links = links(docs, planned(clusters, members, percent, block, block_shingles), words, percent)
    components = connected(confirmed_links, "a", "b").select(F.col("node").alias("rep"), "root")
    joined = hot_join(members.select("doc_id", "n_shingles", "rep"), components, ["rep"], how="left")
    component = F.coalesce("root", "rep")
    return joined.select("doc_id", "n_shingles", component.alias("component_id"),
                         F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def deduplicate(docs: DataFrame, **options) -> DataFrame:
    """The input rows that stay, one document per component, with all their columns."""
    gone = near_duplicates(docs, **options).filter("not kept").select(F.col("doc_id").alias("_gone")).distinct()
    return docs.join(gone, docs["doc_id"] == gone["_gone"], "leftanti")


def op7_circulant_minhash(spark, sf_dir):
    """Near-duplicate components of all documents."""
    return near_duplicates(documents(spark, sf_dir))
