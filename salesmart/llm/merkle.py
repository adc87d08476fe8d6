"""Merkle manifest of a dataset: sibling-shift self-joins, level by level.

Every row is a leaf: the SHA-256 of its columns, each written as its length
and value. The leaves of a source are numbered by id, and every ``arity``
consecutive nodes become their parent, up to the source's subroot; subroots
in source order become the root the same way.

One level is a self-join: a node of slot s looks up the nodes of its run at
the slots s+1, s+2, ... modulo the arity (for pairs: its number XOR 1), all by
equality, and the rows of slot zero emit the parents. Each level is written
once with its siblings. Proofs are then handed down, parents to children, so
the widest join moves one proof per run of leaves and not one per leaf.

Texts are read once and never moved. Numbering deals rows by range of (source,
id), so a source with a third of all rows is many tasks (``ranks.ranked``);
joins are on runs of at most ``arity`` nodes.

Defined cases
* a null column is ``-`` in its leaf; a null source is a tree of its own, before all others
* null ids come first; rows that tie in id are ordered by leaf; equal rows are leaves side by side
* a lone leaf is its source's subroot; a lone subroot is the root
* no rows in, no rows out; columns that are not named do not enter the leaves
"""

from __future__ import annotations

from collections.abc import Sequence
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesmart.llm.common import cut, documents, fold, written
from salesmart.llm.ranks import ranked

ARITY = 3
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
_SUBSET_KEYS = "spark.sql.requireAllClusterKeysForCoPartition"


def leaf(columns: Sequence[str] = COLUMNS, altered: dict[str, Column] | None = None) -> Column:
    """Lower-case hex SHA-256 of a row's columns; ``altered`` replaces some of them."""
    def field(name: str) -> Column:
        value = (altered or {}).get(name, F.col(f"`{name}`")).cast("string")
        return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))
    return F.sha2(F.concat(*[field(c) for c in columns]), 256)


def folded(path: str | Column, digest: str | Column) -> Column:
    """The root that a leaf's digest and its path lead to."""
    digest = F.col(digest) if isinstance(digest, str) else digest
    return F.aggregate(path, digest, lambda acc, step: F.sha2(F.concat(step["left"], acc, step["right"]), 256))


def proof_digest(path: str | Column) -> Column:
    """SHA-256 over all siblings of a path, from the leaf upwards, each level left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda step: F.concat(step["left"], step["right"])), ""), 256)


@contextmanager
def _joins_by_run(spark):
    """Within, rows dealt by run meet their siblings without another shuffle."""
    before = spark.conf.get(_SUBSET_KEYS, None)
    spark.conf.set(_SUBSET_KEYS, "false")
    try:
        yield
    finally:
        spark.conf.unset(_SUBSET_KEYS) if before is None else spark.conf.set(_SUBSET_KEYS, before)


def with_siblings(nodes: DataFrame, arity: int = ARITY) -> DataFrame:
    """tree, place, size, digest, ... with run, slot and the run's digests on the ``left`` and ``right``."""
    own = nodes.select("*", F.expr(f"place div {arity}").alias("run"), F.expr(f"place % {arity}").alias("slot")).repartition("tree", "run")
    out = own
    for shift in range(1, arity):
        other = own.select(*[F.col(c).alias(f"{c}_{shift}") for c in ("tree", "run", "slot", "digest")])
        wanted = F.col("slot").bitwiseXOR(F.lit(1)) if arity == 2 else (F.col("slot") + shift) % arity
        out = out.join(other, (F.col("tree") == F.col(f"tree_{shift}")) & (F.col("run") == F.col(f"run_{shift}"))
                       & (wanted == F.col(f"slot_{shift}")), "left")
    found = F.array_sort(F.filter(F.array(*[F.struct(F.col(f"slot_{s}").alias("s"), F.col(f"digest_{s}").alias("d")) for s in range(1, arity)]),
                                  lambda x: x["s"].isNotNull()))
    def side(keep):
        return F.array_join(F.transform(F.filter(found, keep), lambda x: x["d"]), "")
    return out.select(*own.columns, side(lambda x: x["s"] < F.col("slot")).alias("left"), side(lambda x: x["s"] > F.col("slot")).alias("right"))


@dataclass(frozen=True)
class Forest:
    """``levels``: the nodes below each parent, with siblings; ``tops``: tree, digest, height; ``lone``: trees of one leaf."""
    levels: list[DataFrame]
    tops: DataFrame
    lone: DataFrame


def climb(nodes: DataFrame, arity: int = ARITY) -> Forest:
    """All levels of the trees over ``nodes`` (tree, place, size, digest and what the leaves carry)."""
    spark = nodes.sparkSession
    largest = nodes.agg(F.max("size")).first()[0] or 0
    lone, now, levels = nodes.filter("size = 1"), nodes.filter("size > 1"), []
    tops = lone.select("tree", "digest", F.lit(0).alias("height"))
    while largest > 1:
        with _joins_by_run(spark):
            level = written(with_siblings(now, arity), f"merkle-{len(levels)}")
        levels.append(level)
        parents = level.filter("slot = 0").select(
            "tree", F.col("run").alias("place"), F.expr(f"(size + {arity - 1}) div {arity}").alias("size"),
            F.sha2(F.concat("digest", "right"), 256).alias("digest"))
        tops = tops.unionByName(parents.filter("size = 1").select("tree", "digest", F.lit(len(levels)).alias("height")))
        now, largest = parents.filter("size > 1"), -(-largest // arity)
    return Forest(levels, tops, lone)


def descend(forest: Forest, tops: DataFrame, carried: Sequence[str]) -> DataFrame:
    """The leaves with their path: below each top its own siblings, then the top's ``path``.

    ``tops`` has tree, height, path and the columns to hand down; ``carried`` are the leaves' own.
    """
    down = [c for c in tops.columns if c not in ("tree", "height", "path")]
    above = None
    for k in reversed(range(len(forest.levels))):
        parents = tops.filter(F.col("height") == k + 1).select(
            F.col("tree").alias("up_tree"), F.lit(0).cast("long").alias("up_place"), "path", *down)
        if above is not None:
            parents = parents.unionByName(above)
        rows = forest.levels[k].join(parents, (F.col("tree") == F.col("up_tree")) & (F.col("run") == F.col("up_place")))
        longer = F.concat(F.array(F.struct("left", "right")), "path").alias("path")
        if k:
            above = rows.select(F.col("tree").alias("up_tree"), F.col("place").alias("up_place"), longer, *down)
        else:
            leaves = rows.select(*carried, "digest", longer, *down)
    lone = forest.lone.join(tops.filter("height = 0").withColumnRenamed("tree", "up_tree"), F.col("tree") == F.col("up_tree")).select(
        *carried, "digest", "path", *down)
    return leaves.unionByName(lone) if forest.levels else lone


def manifest(docs: DataFrame, columns: Sequence[str] = COLUMNS, tree: str = "source", order: str = "doc_id", arity: int = ARITY,
             carry: dict[str, Column] | None = None) -> DataFrame:
    """One row per input row: ``order``, what it carries, leaf, subroot, root and path (left and right siblings by level).

    ``carry`` are further columns computed where the rows are read, e.g. digests of changed rows.
    """
    names = [f"own_{k}" for k in range(len(carry or {}))]
    key = F.coalesce(F.concat(F.lit("="), F.col(f"`{tree}`").cast("string")), F.lit("-"))  # "-" sorts before "="
    leaves = written(docs.select(key.alias("tree"), F.col(f"`{order}`").alias("id"), leaf(columns).alias("digest"),
                                 *[c.alias(n) for n, c in zip(names, (carry or {}).values(), strict=True)]), "merkle-leaves")
    trees = climb(ranked(leaves, "tree", ["id", "digest"], "merkle-places"), arity)
    subroots = cut(trees.tops.select(F.lit("").alias("forest"), F.col("tree").alias("name"), "digest", "height"))
    top = climb(ranked(subroots, "forest", ["name"], "merkle-tops").select(
        F.col("forest").alias("tree"), "place", "size", "digest", "name", F.col("height").alias("tree_height")), arity)
    root = top.tops.select("tree", "height", F.array().cast("array<struct<left:string,right:string>>").alias("path"), F.col("digest").alias("root"))
    finished = written(descend(top, root, ["name", "tree_height"]).select(
        F.col("name").alias("tree"), F.col("tree_height").alias("height"), "path", F.col("digest").alias("subroot"), "root"), "merkle-finished")
    rows = descend(trees, finished, ["id", *names])
    return rows.select(F.col("id").alias(order), *[F.col(n).alias(c) for n, c in zip(names, carry or {}, strict=True)],
                       F.col("digest").alias("leaf"), "subroot", "root", "path")


def op12_merkle_manifest(spark, sf_dir):
    """The manifest of all documents, checked against rows of which half have lost their line feeds."""
    changed = F.when(fold("doc_id", 2) == 0, F.regexp_replace("text", "\n", "")).otherwise(F.col("text"))
    rows = manifest(documents(spark, sf_dir), carry={"presented": leaf(altered={"text": changed})})
    return rows.select("doc_id", "leaf", "subroot", "root", proof_digest("path").alias("proof_sha256"),
                       folded("path", "presented").alias("folded_root")).withColumn("verified", F.col("folded_root") == F.col("root"))


def crc32_sql(text: str) -> str:
    """DuckDB expression of the unsigned crc32 of an ASCII text."""
    steps = f"flatten(list_transform(string_split({text}, ''), lambda c: [ascii(c), -1, -1, -1, -1, -1, -1, -1, -1]))"
    fed = ("list_reduce(list_concat([4294967295::BIGINT], " + steps + "), lambda a, b: CASE WHEN b >= 0 THEN xor(a, b::BIGINT) "
           "WHEN a % 2 = 1 THEN xor(a // 2, 3988292384::BIGINT) ELSE a // 2 END)")
    return f"xor({fed}, 4294967295::BIGINT)"


def _field_sql(value: str) -> str:
    return f"coalesce(strlen(({value})::VARCHAR)::VARCHAR || ':' || ({value})::VARCHAR, '-')"


def _leaf_sql(text: str = "text") -> str:
    return "sha256(" + " || ".join(_field_sql(text if c == "text" else c) for c in COLUMNS) + ")"


ORACLE = f"""
WITH RECURSIVE leaves AS MATERIALIZED (
  SELECT doc_id, coalesce('=' || source, '-') AS tree, {_leaf_sql()} AS leaf,
         {_leaf_sql(f"CASE WHEN {crc32_sql('doc_id::VARCHAR')} % 2 = 0 THEN replace(text, chr(10), '') ELSE text END")} AS presented
  FROM documents
), numbered AS MATERIALIZED (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place, count(*) OVER (PARTITION BY tree) AS size
  FROM leaves
), nodes AS (
  SELECT 0 AS level, tree, place, size, leaf AS digest FROM numbered
  UNION ALL
  SELECT any_value(level) + 1, tree, place // 3, (any_value(size) + 2) // 3, sha256(string_agg(digest, '' ORDER BY place))
  FROM nodes WHERE size > 1 GROUP BY tree, place // 3
), subroots AS MATERIALIZED (
  SELECT tree, digest AS subroot, level AS height,
         row_number() OVER (ORDER BY tree) - 1 AS place, count(*) OVER () AS size
  FROM nodes WHERE size = 1
), tops AS (
  SELECT 0 AS level, place, size, subroot AS digest FROM subroots
  UNION ALL
  SELECT any_value(level) + 1, place // 3, (any_value(size) + 2) // 3, sha256(string_agg(digest, '' ORDER BY place))
  FROM tops WHERE size > 1 GROUP BY place // 3
), root AS (SELECT digest AS root FROM tops WHERE size = 1),
up AS (
  SELECT n.tree, n.place AS leaf_place, n.place, 0 AS level, n.size, n.presented AS digest, '' AS proof FROM numbered n
  UNION ALL
  SELECT u.tree, u.leaf_place, u.place // 3, u.level + 1, (u.size + 2) // 3,
         sha256(coalesce((SELECT string_agg(s.digest, '' ORDER BY s.place) FROM nodes s WHERE s.level = u.level AND s.tree = u.tree AND s.place // 3 = u.place // 3 AND s.place < u.place), '')
                || u.digest ||
                coalesce((SELECT string_agg(s.digest, '' ORDER BY s.place) FROM nodes s WHERE s.level = u.level AND s.tree = u.tree AND s.place // 3 = u.place // 3 AND s.place > u.place), '')),
         u.proof || coalesce((SELECT string_agg(s.digest, '' ORDER BY s.place) FROM nodes s WHERE s.level = u.level AND s.tree = u.tree AND s.place // 3 = u.place // 3 AND s.place <> u.place), '')
  FROM up u WHERE u.size > 1
), over AS (
  SELECT u.tree, u.leaf_place, t.place, 0 AS level, t.size, u.digest, u.proof FROM up u JOIN subroots t USING (tree) WHERE u.size = 1
  UNION ALL
  SELECT u.tree, u.leaf_place, u.place // 3, u.level + 1, (u.size + 2) // 3,
         sha256(coalesce((SELECT string_agg(s.digest, '' ORDER BY s.place) FROM tops s WHERE s.level = u.level AND s.place // 3 = u.place // 3 AND s.place < u.place), '')
                || u.digest ||
                coalesce((SELECT string_agg(s.digest, '' ORDER BY s.place) FROM tops s WHERE s.level = u.level AND s.place // 3 = u.place // 3 AND s.place > u.place), '')),
         u.proof || coalesce((SELECT string_agg(s.digest, '' ORDER BY s.place) FROM tops s WHERE s.level = u.level AND s.place // 3 = u.place // 3 AND s.place <> u.place), '')
  FROM over u WHERE u.size > 1
)
SELECT n.doc_id, n.leaf, t.subroot, r.root, sha256(o.proof) AS proof_sha256, o.digest AS folded_root, o.digest = r.root AS verified
FROM over o JOIN numbered n ON n.tree = o.tree AND n.place = o.leaf_place JOIN subroots t ON t.tree = o.tree CROSS JOIN root r
WHERE o.size = 1
"""
