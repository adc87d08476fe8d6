"""Near-duplicate vectors by lattice hashing: E8 cells, neighbouring cells, verified cosines.

A table projects unit vectors at random into a few blocks of eight dimensions
and names the nearest E8 lattice point of each block. A vector is filed under
its own cell and under the ``PROBES`` neighbouring cells (one block moved by
the root vector that costs least). Width, blocks and number of tables follow
from the number of vectors, so that a pair at the threshold itself shares a
cell with probability ``RECALL``, at the least expected work (``settings``).

Near copies never meet one by one:

* equal vectors are one, with a weight
* vectors of a cell within half the threshold's angle of one of them, the
  pivot, form a ball; any two of a ball are linked, for their angle is below
  the threshold's. A ball's members move to a larger ball near it where its
  pivot is close enough
* cells hold balls, each once. Balls of a cell are compared by pivot, in blocks
  so that no cell is one task; angles and radii decide most pairs of balls as
  a whole. The rest are compared member by member, again in blocks
* links are counted, not listed: a vector's links are its ball, the balls linked
  as a whole and the members counted. One edge per pair of balls gives the components

Defined cases
* vectors that are null, empty, zero or hold null or non-finite components link with nothing
* vectors of different lengths link with nothing of each other
* a null vec_id is a vector like others; components take the smallest id there is,
  null if none; a row whose component is null is kept
* rows that repeat in vec_id are vectors of their own; equal ones link
* no rows in, no rows out; other columns are ignored
"""

from __future__ import annotations

import hashlib
import itertools
import math
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.llm.common import cut, partitions, written
from salesmart.llm.components import connected
from salesmart.llm.words import mix

THRESHOLD = 0.9
RECALL = 0.95  # of pairs exactly at the threshold; nearer pairs are found more often
PROBES = 6
BLOCK = 1024  # balls or members in one block
ROUNDS = 2  # tables that balls are gathered by
_SMALL = 16
_SLACK = 1e-7  # radians; pairs this near to a bound are compared member by member


def _roots() -> np.ndarray:
    """The 240 shortest vectors of E8."""
    out = []
    for i, j in itertools.combinations(range(8), 2):
        for a, b in itertools.product((1, -1), repeat=2):
            v = np.zeros(8)
            v[i], v[j] = a, b
            out.append(v)
    out += [np.array(s) for s in itertools.product((0.5, -0.5), repeat=8) if np.sum(np.array(s) < 0) % 2 == 0]
    return np.array(out)


ROOTS = _roots()


def _nearest_d8(x: np.ndarray) -> np.ndarray:
    near = np.rint(x)
    rest = x - near
    odd = np.flatnonzero(near.sum(1).astype(np.int64) & 1)
    worst = np.abs(rest[odd]).argmax(1)
    near[odd, worst] += np.where(rest[odd, worst] >= 0, 1, -1)
    return near


def nearest_e8(x: np.ndarray) -> np.ndarray:
    """The nearest point of E8 (D8 and D8 moved by a half) of each row."""
    whole, half = _nearest_d8(x), _nearest_d8(x - 0.5) + 0.5
    return np.where((((x - whole) ** 2).sum(1) <= ((x - half) ** 2).sum(1))[:, None], whole, half)


def cell_keys(points: np.ndarray, probes: int, seed: int) -> np.ndarray:
    """Own cell and ``probes`` neighbouring cells of projected rows (n, blocks, 8), as 64-bit keys."""
    n, blocks, _ = points.shape
    own = nearest_e8(points.reshape(-1, 8)).reshape(points.shape)
    factor = np.random.default_rng(seed).integers(1, 1 << 62, (blocks, 8), dtype=np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1)
    home = ((2 * own).astype(np.int64).astype(np.uint64) * factor).sum((1, 2), dtype=np.uint64)
    keys = [home]
    if probes:
        moved = ((2 * ROOTS).astype(np.int64).astype(np.uint64)[None] * factor[:, None, :]).sum(2, dtype=np.uint64).ravel()  # of each (block, root)
        gain = ((points - own).reshape(-1, 8) @ ROOTS.T).reshape(n, -1)
        best = np.argpartition(-gain, probes - 1, axis=1)[:, :probes]
        keys += [home + moved[best[:, k]] for k in range(probes)]
    return mix(np.stack(keys, 1) ^ mix(np.full(1, seed, np.uint64))).view(np.int64)


@dataclass(frozen=True)
class Settings:
    blocks: int
    width: float
    tables: int
    probes: int = PROBES


@lru_cache(maxsize=64)
def _chosen(bits: int, threshold: float, recall: float, probes: int) -> Settings:
    rng = np.random.default_rng(8)
    a, b = rng.standard_normal((2, 1500, 4, 8))
    b = threshold * a + math.sqrt(1 - threshold * threshold) * b
    best, least = None, math.inf
    for blocks, width in itertools.product((1, 2, 3, 4), (1.0, 1.25, 1.5, 1.75, 2.0, 2.5)):
        x, y = (cell_keys(v[:, :blocks] / width, probes, 1) for v in (a, b))
        found = float((x[:, :, None] == y[:, None, :]).any((1, 2)).mean())
        if not found:
            continue
        tables = max(1, math.ceil(math.log(1 - recall) / math.log(1 - min(found, 0.999))))
        by_chance = (1 + 2 * probes) * (width * width / (4 * math.pi)) ** (4 * blocks)
        cost = tables * (1 + probes) + 4 * tables * by_chance * 2 ** bits
        if cost < least:
            best, least = Settings(blocks, width, tables, probes), cost
    return best


def settings(vectors: int, threshold: float = THRESHOLD, recall: float = RECALL, probes: int = PROBES) -> Settings:
    """Cells for so many vectors: a pair at the threshold is found with probability ``recall``.

    How often it shares a cell is measured on drawn pairs; how often others do
    is the chance that two Gaussian points fall into one cell. The finer the
    cells, the more tables; the setting with the fewest rows and comparisons is taken.
    """
    return _chosen(max(10, (max(vectors, 1) - 1).bit_length()), threshold, recall, probes)


def units(raw: pa.Array, kind: str) -> np.ndarray:
    """Rows of one length as unit vectors in double precision."""
    x = np.frombuffer(b"".join(raw.to_pylist()), kind).astype(np.float64).reshape(len(raw), -1)
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def _by_length(raw: pa.Array):
    sizes = np.array([len(r) for r in raw.to_pylist()])
    for size in np.unique(sizes):
        yield np.flatnonzero(sizes == size)


def loaded(embeddings: DataFrame) -> tuple[DataFrame, str]:
    """(row, vec_id, mark, raw of every row, kept as a table; numpy kind of raw). Unusable vectors have no mark."""
    element = embeddings.schema["embedding"].dataType.elementType.simpleString()
    kind = "<f4" if element == "float" else "<f8"
    source = embeddings.select(F.monotonically_increasing_id().alias("row"), F.col("vec_id").cast("long").alias("vec_id"),
                               F.col("embedding").cast("array<float>" if kind == "<f4" else "array<double>").alias("embedding"))

    def run(batches):
        for batch in batches:
            marks, raws = [], []
            for v in batch.column("embedding"):
                values = v.values if v.is_valid else None
                x = None if values is None or values.null_count else values.to_numpy(zero_copy_only=False).astype(kind) + 0.0
                fine = x is not None and len(x) and np.isfinite(x).all() and x.any()
                raws.append(x.tobytes() if fine else None)
                marks.append(hashlib.blake2b(raws[-1], digest_size=16).digest() if fine else None)
            yield pa.record_batch([batch.column("row"), batch.column("vec_id"), pa.array(marks, pa.binary()), pa.array(raws, pa.binary())],
                                  names=["row", "vec_id", "mark", "raw"])
    return written(source.mapInArrow(run, "row long, vec_id long, mark binary, raw binary"), "lattice-rows"), kind


def filed(vectors: DataFrame, kind: str, how: Settings, first: int, tables: int, probes: int, carry: str) -> DataFrame:
    """``carry`` and cell of every (vector, table, cell); each once per batch."""
    def run(batches):
        for batch in batches:
            carried = batch.column(carry).to_numpy(zero_copy_only=False)
            for part in _by_length(batch.column("raw")):
                x = units(batch.column("raw").take(pa.array(part)), kind)
                for table in range(first, first + tables):
                    plane = np.random.default_rng([31, table, x.shape[1]]).standard_normal((x.shape[1], 8 * how.blocks))
                    cells = cell_keys((x @ plane / how.width).reshape(len(x), how.blocks, 8), probes, 1000 * x.shape[1] + table)
                    both = np.unique(np.stack([np.repeat(carried[part], 1 + probes), cells.ravel()], 1), axis=0)
                    yield pa.record_batch([pa.array(both[:, 0]), pa.array(both[:, 1])], names=[carry, "cell"])
    return vectors.select(carry, "raw").mapInArrow(run, f"{carry} long, cell long")


def _angles(pairs: DataFrame, kind: str, keys: list[str]) -> DataFrame:
    """``keys`` with the angle between ``raw`` and ``raw_b``."""
    def run(batches):
        for batch in batches:
            out = np.full(batch.num_rows, np.pi)
            same = np.array([len(a) == len(b) for a, b in zip(batch.column("raw").to_pylist(), batch.column("raw_b").to_pylist(), strict=True)], bool)
            for part in _by_length(batch.column("raw")):
                at = part[same[part]]
                if len(at):
                    a, b = (units(batch.column(c).take(pa.array(at)), kind) for c in ("raw", "raw_b"))
                    out[at] = angle_between(a, b)
            yield pa.record_batch([*[batch.column(k) for k in keys], pa.array(out)], names=[*keys, "angle"])
    return pairs.select(*keys, "raw", "raw_b").mapInArrow(run, ", ".join(f"{k} long" for k in keys) + ", angle double")


def angle_between(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Angles of unit rows, exact for small ones too."""
    return 2 * np.arctan2(np.sqrt(((a - b) ** 2).sum(1)), np.sqrt(((a + b) ** 2).sum(1)))


def balls(reps: DataFrame, kind: str, how: Settings, reach: float) -> DataFrame:
    """rep, pivot, angle: every vector in one ball of radius ``reach`` at most, alone if need be."""
    left, found = reps, None
    for k in range(ROUNDS):
        cells = cut(filed(left, kind, how, 500 + k, 1, 0, "rep"))
        hubs = cells.groupBy("cell").agg(F.min(F.struct(F.xxhash64("rep", F.lit(k)).alias("h"), "rep")).alias("hub"), F.count("*").alias("n"))
        hubs = hubs.filter("n > 1").select("cell", F.col("hub.rep").alias("pivot"))
        pairs = cells.join(hubs, "cell").filter("rep <> pivot").select("rep", "pivot")
        near = _angles(_with_raw(pairs, reps), kind, ["rep", "pivot"]).filter(F.col("angle") <= reach)
        near = cut(near)
        now = near.unionByName(near.select(F.col("pivot").alias("rep"), "pivot", F.lit(0.0).alias("angle")).distinct())
        found = now if found is None else found.unionByName(now)
        left = left.join(now.select("rep"), "rep", "leftanti")
    alone = left.select("rep", F.col("rep").alias("pivot"), F.lit(0.0).alias("angle"))
    return cut(found.unionByName(alone))


def _with_raw(pairs: DataFrame, reps: DataFrame, a: str = "rep", b: str = "pivot") -> DataFrame:
    return (pairs.join(reps.select(F.col("rep").alias(a), "raw"), a)
            .join(reps.select(F.col("rep").alias(b), F.col("raw").alias("raw_b")), b))


def gathered(members: DataFrame, reps: DataFrame, kind: str, how: Settings, reach: float, limit: float) -> DataFrame:
    """The balls once their members have moved to the largest ball near theirs, where that one has no larger one near."""
    sizes = members.groupBy("pivot").agg(F.count("*").alias("n")).filter("n > 1")
    large = sizes.join(reps, F.col("pivot") == F.col("rep")).select("rep", "n", "raw")
    cells = cut(filed(large, kind, how, 0, how.tables, how.probes, "rep").distinct().join(large.select("rep", "n"), "rep"))
    top = cells.groupBy("cell").agg(F.max(F.struct("n", "rep")).alias("top"))
    near = cells.join(top, "cell").filter("rep <> top.rep").select("rep", F.col("top.rep").alias("pivot")).distinct()
    near = _angles(_with_raw(near, reps), kind, ["rep", "pivot"]).filter(F.col("angle") <= limit)
    best = cut(near.join(sizes, "pivot").groupBy("rep").agg(F.max(F.struct("n", "pivot")).alias("best")).select("rep", F.col("best.pivot").alias("goal")))
    goals = best.join(best.select(F.col("rep").alias("goal")), "goal", "leftanti")
    tried = (members.join(goals.select(F.col("rep").alias("pivot"), "goal"), "pivot").select("rep", F.col("goal").alias("pivot")))
    moved = cut(_angles(_with_raw(tried, reps), kind, ["rep", "pivot"]).filter(F.col("angle") <= reach))
    rest = members.join(moved.select("rep"), "rep", "leftanti").select("rep", "pivot", "angle")
    return cut(rest.unionByName(moved))


def _whole_groups(batches, keys: list[str]):
    """(table of whole groups, group number of each row) from batches sorted by ``keys``; the last group waits for its end."""
    held = None
    for batch in itertools.chain(batches, [None]):
        if batch is not None:
            if not batch.num_rows:
                continue
            held = pa.Table.from_batches([batch]) if held is None else pa.concat_tables([held, pa.Table.from_batches([batch])])
        if held is None or not held.num_rows:
            continue
        columns = [held.column(k).to_numpy() for k in keys]
        new = np.zeros(held.num_rows, bool)
        for c in columns:
            new[1:] |= c[1:] != c[:-1]
        end = held.num_rows if batch is None else int(np.flatnonzero(new)[-1]) if new.any() else 0
        if end:
            yield held.slice(0, end).combine_chunks(), np.cumsum(new[:end])
            held = held.slice(end)


def _near_pairs(group: np.ndarray, side: np.ndarray, x: np.ndarray, reach: np.ndarray):
    """Index pairs within each group whose dot product reaches ``reach(i, j)``: small groups by offset, others by product.

    ``side`` -1: all pairs of the group; 0 and 1: only pairs across.
    """
    size = np.bincount(group)[group]
    small = np.flatnonzero(size <= _SMALL)
    for d in range(1, _SMALL):
        i, j = small[:-d], small[d:]
        ok = (group[i] == group[j]) & ((side[i] < 0) | (side[i] != side[j])) if len(i) else np.zeros(0, bool)
        if not ok.any():
            break
        i, j = i[ok], j[ok]
        hit = np.einsum("ij,ij->i", x[i], x[j]) >= reach(i, j)
        yield i[hit], j[hit]
    starts = np.flatnonzero(np.diff(group, prepend=-1))
    for a in starts[size[starts] > _SMALL].tolist():
        own = np.arange(a, a + size[a])
        left, right = (own, own) if side[a] < 0 else (own[side[own] == 0], own[side[own] == 1])
        if not len(left) or not len(right):
            continue
        dots = x[left] @ x[right].T
        i, j = np.nonzero(dots >= reach(left[:, None], right[None, :]))
        i, j = left[i], right[j]
        keep = (i < j) | (side[a] >= 0)
        yield i[keep], j[keep]


def _block_pairs(blocks: str, own: str):
    """Every pair of blocks once for the rows of block ``own``: struct(i, j, side)."""
    return F.transform(F.sequence(F.lit(0), F.col(blocks) - 1), lambda o: F.struct(
        F.least(own, o).alias("i"), F.greatest(own, o).alias("j"),
        F.when(F.col(own) == o, F.lit(-1)).when(F.col(own) < o, F.lit(0)).otherwise(F.lit(1)).alias("side")))


def ball_pairs(cells: DataFrame, pivots: DataFrame, kind: str, limit: float, block: int = BLOCK) -> DataFrame:
    """a, b, whole: balls of a common cell that are linked as a whole, or may hold links."""
    counts = cells.groupBy("cell").agg(F.count("*").alias("n")).filter("n > 1")
    shared = cells.join(counts, "cell").withColumn("blocks", F.ceil(F.col("n") / block).cast("int"))
    shared = shared.withColumn("own", F.pmod(F.xxhash64("pivot"), F.col("blocks")).cast("int"))
    dealt = (shared.join(pivots.select("pivot", "raw", "radius"), "pivot")
             .select("cell", "pivot", "raw", "radius", F.explode(_block_pairs("blocks", "own")).alias("p"))
             .select("cell", "p.i", "p.j", "p.side", "pivot", "raw", "radius"))

    def run(batches):
        for table, group in _whole_groups(batches, ["cell", "i", "j"]):
            raw = table.column("raw").combine_chunks()
            for part in _by_length(raw):
                ids = table.column("pivot").to_numpy()[part]
                radius, side = table.column("radius").to_numpy()[part], table.column("side").to_numpy()[part]
                x = units(raw.take(pa.array(part)), kind)
                _, own = np.unique(group[part], return_inverse=True)
                for i, j in _near_pairs(own, side, x, lambda i, j, r=radius: np.cos(np.minimum(limit + r[i] + r[j] + _SLACK, np.pi)) - 1e-9):
                    angle, wide = angle_between(x[i], x[j]), radius[i] + radius[j]
                    single = wide == 0
                    linked = (x[i] * x[j]).sum(1) >= math.cos(limit)
                    whole = np.where(single, linked, angle + wide <= limit - _SLACK)
                    keep = whole | ~single
                    a, b = np.minimum(ids[i], ids[j])[keep], np.maximum(ids[i], ids[j])[keep]
                    yield pa.record_batch([pa.array(a), pa.array(b), pa.array(whole[keep])], names=["a", "b", "whole"])
    pairs = (dealt.repartition(partitions(cells.sparkSession), "cell", "i", "j").sortWithinPartitions("cell", "i", "j")
             .mapInArrow(run, "a long, b long, whole boolean"))
    return pairs.groupBy("a", "b").agg(F.max("whole").alias("whole"))


def member_links(open_pairs: DataFrame, members: DataFrame, sizes: DataFrame, kind: str, limit: float, block: int = BLOCK) -> DataFrame:
    """a, b, rep, n: for balls that angles do not decide, each member's links across (by weight)."""
    blocks = sizes.select("pivot", F.ceil(F.col("n") / block).cast("int").alias("blocks"))
    dealt = members.join(blocks, "pivot").select("pivot", "rep", "raw", "weight", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int").alias("own"))
    tasks = (open_pairs.select("a", "b").join(blocks.select(F.col("pivot").alias("a"), F.col("blocks").alias("na")), "a")
             .join(blocks.select(F.col("pivot").alias("b"), F.col("blocks").alias("nb")), "b")
             .select("a", "b", F.explode(F.sequence(F.lit(0), F.col("na") - 1)).alias("i"), "nb")
             .select("a", "b", "i", F.explode(F.sequence(F.lit(0), F.col("nb") - 1)).alias("j")))
    rows = [tasks.join(dealt.withColumnsRenamed({"pivot": p, "own": k}), [p, k]).select("a", "b", "i", "j", F.lit(s).alias("side"), "rep", "raw", "weight")
            for s, p, k in ((0, "a", "i"), (1, "b", "j"))]

    def run(batches):
        for table, group in _whole_groups(batches, ["a", "b", "i", "j"]):
            raw = table.column("raw").combine_chunks()
            for part in _by_length(raw):
                x = units(raw.take(pa.array(part)), kind)
                weight, side = table.column("weight").to_numpy()[part], table.column("side").to_numpy()[part]
                _, own = np.unique(group[part], return_inverse=True)
                n = np.zeros(len(part), np.int64)
                for i, j in _near_pairs(own, side, x, lambda i, j: math.cos(limit)):
                    n += np.bincount(i, weight[j], len(part)).astype(np.int64) + np.bincount(j, weight[i], len(part)).astype(np.int64)
                hit = np.flatnonzero(n)
                yield pa.record_batch([*[pa.array(table.column(c).to_numpy()[part][hit]) for c in ("a", "b", "rep")], pa.array(n[hit])],
                                      names=["a", "b", "rep", "n"])
    return (rows[0].unionByName(rows[1]).repartition(partitions(members.sparkSession), "a", "b", "i", "j")
            .sortWithinPartitions("a", "b", "i", "j", "side", "rep").mapInArrow(run, "a long, b long, rep long, n long"))


def near_duplicates(embeddings: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL, how: Settings | None = None, block: int = BLOCK) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept."""
    limit = math.acos(threshold)
    rows, kind = loaded(embeddings)
    same = cut(rows.filter("mark is not null").groupBy("mark").agg(
        F.min("row").alias("rep"), F.count("*").alias("weight"), F.min("vec_id").alias("least")))
    reps = written(rows.select("row", "raw").join(same, F.col("row") == F.col("rep")).select("rep", "raw", "weight", "least"), "lattice-vectors")
    how = how or settings(reps.count(), threshold, recall)
    members = gathered(balls(reps, kind, how, limit / 2 - _SLACK), reps, kind, how, limit / 2 - _SLACK, limit)
    members = written(members.join(reps, "rep"), "lattice-members")
    sizes = cut(members.groupBy("pivot").agg(F.count("*").alias("n"), F.sum("weight").alias("weight"), F.max("angle").alias("radius")))
    pivots = sizes.join(reps.select("rep", "raw"), F.col("pivot") == F.col("rep")).select("pivot", "raw", "radius")
    cells = cut(filed(members, kind, how, 0, how.tables, how.probes, "pivot").distinct())
    pairs = cut(ball_pairs(cells, pivots, kind, limit, block))
    whole = pairs.filter("whole").select("a", "b")
    single = cut(member_links(pairs.filter("not whole"), members, sizes, kind, limit, block))

    both = whole.select(F.col("a").alias("pivot"), F.col("b").alias("other")).unionByName(whole.select(F.col("b").alias("pivot"), F.col("a").alias("other")))
    by_ball = both.join(sizes.select(F.col("pivot").alias("other"), "weight"), "other").groupBy("pivot").agg(F.sum("weight").alias("ball_links"))
    by_member = single.groupBy("rep").agg(F.sum("n").alias("own_links"))
    components = connected(whole.unionByName(single.select("a", "b").distinct()), "a", "b")
    rooted = sizes.join(components.select(F.col("node").alias("pivot"), "root"), "pivot", "left").join(by_ball, "pivot", "left").select(
        "pivot", F.coalesce("root", "pivot").alias("root"), (F.col("weight") - 1 + F.coalesce("ball_links", F.lit(0))).alias("links"))
    linked = cut(members.select("rep", "pivot", "least").join(rooted, "pivot").join(by_member, "rep", "left"))
    smallest = linked.groupBy("root").agg(F.min("least").alias("component_id"))
    per_rep = linked.join(smallest, "root").select("rep", (F.col("links") + F.coalesce("own_links", F.lit(0))).alias("n_links"), "component_id")
    per_mark = same.select("mark", "rep").join(per_rep, "rep").select("mark", "n_links", "component_id", F.lit(True).alias("usable"))
    component = F.when(F.col("usable"), F.col("component_id")).otherwise(F.col("vec_id"))
    return rows.select("vec_id", "mark").join(per_mark, "mark", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, component.isNull()).alias("kept"))


def op13_lattice_near_dup(spark, sf_dir):
    """Near-duplicate components of all vectors."""
    return near_duplicates(spark.read.parquet(f"{sf_dir.rstrip('/')}/embeddings.parquet"))
