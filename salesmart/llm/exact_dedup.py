"""Exact deduplication by content-defined chunk recipes.

White space is deleted from each text, the rest is cut into chunks where the
content says so, and a text becomes its *recipe*: the ordered list of 64-bit
chunk identifiers. Identifiers are verified before recipes are compared: the
distinct (identifier, chunk) pairs are counted per identifier, and a document
that holds a chunk whose identifier stands for two different chunks is
compared by its whole text instead. Chunk text moves once, one copy per map
task; documents themselves never move, only their recipes (about 3 % of the text),
which are written once and read by everything that follows. ``deduplicate`` takes
the rows that go away by an anti-join with their keys: Spark sends those to every
task where they are small enough by its own limit, else the texts move once.

Everything is built from SQL functions; there is no Python on the executors.

Defined cases
* null text counts as empty; all empty texts (and texts of white space only) are one group
* null doc_id is an ordinary row; it loses ties against any other id
* rows that repeat with the same id and equal text are one group; those that tie
  in id and length all carry ``kept``, and ``deduplicate`` returns one of them
* no rows in, no rows out; extra columns of the input are ignored
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.llm.common import WS_CHARS, cut, documents, hot_join, written

MIN_CHUNK = 96
MAX_CHUNK = 1024


def boundary_pattern(min_chunk: int = MIN_CHUNK, max_chunk: int = MAX_CHUNK, mask: int = 8) -> str:
    """Chunk pattern: at least ``min_chunk`` code points, cut after a content-defined pair.

    A pair ends a chunk when its first character's code leaves 1 and the
    second's leaves 2 or 5 modulo ``mask`` (over the Basic Latin and Latin-1
    characters); a chunk is cut at ``max_chunk`` where no such pair comes.
    """
    def chars(rest: set[int]) -> str:
        return "".join(f"\\x{{{c:x}}}" for c in range(0x21, 0x100) if c % mask in rest)
    body = f".{{{min_chunk},{max_chunk - 2}}}?[{chars({1})}][{chars({2, 5})}]"
    return f"(?s){body}|.{{1,{max_chunk}}}"


def normalised(text: str = "text") -> F.Column:
    return F.translate(F.coalesce(F.col(text), F.lit("")), WS_CHARS, "")


def chunked(norm: str = "norm") -> F.Column:
    return F.regexp_extract_all(norm, F.lit(boundary_pattern()), F.lit(0))


def identified(chunk: F.Column) -> F.Column:
    return F.xxhash64(chunk)


def clashing_ids(base: DataFrame, identify=identified) -> DataFrame:
    """Identifiers that stand for more than one chunk (normally none)."""
    pairs = base.select(F.explode(chunked()).alias("chunk")).select(identify(F.col("chunk")).alias("id"), "chunk").distinct()
    return pairs.groupBy("id").agg(F.count("*").alias("texts")).filter("texts > 1").select("id")


def recipes(docs: DataFrame, identify=identified) -> DataFrame:
    """doc_id, n_points, text_sha256, recipe (ordered chunk identifiers), literal.

    ``literal`` is empty unless an identifier of the document failed
    verification; then it holds the normalised text.
    """
    base = docs.select("doc_id", F.length(F.coalesce("text", F.lit(""))).cast("long").alias("n_points"),
                       normalised().alias("norm"))
    plain = written(base.select("doc_id", "n_points", F.sha2("norm", 256).alias("text_sha256"),
                                F.transform(chunked(), identify).alias("recipe")), "recipes")
    clashing = cut(clashing_ids(base, identify))
    if clashing.isEmpty():
        return plain.withColumn("literal", F.lit(""))
    unsafe = (plain.select("text_sha256", F.explode("recipe").alias("id"))
              .join(clashing, "id", "leftsemi").select("text_sha256").distinct())
    texts = (base.withColumn("text_sha256", F.sha2("norm", 256)).join(unsafe, "text_sha256", "leftsemi")
             .groupBy("text_sha256", "norm").count().select("text_sha256", F.col("norm").alias("literal")))
    return plain.join(texts, "text_sha256", "left").withColumn("literal", F.coalesce("literal", F.lit(""))).select(
        "doc_id", "n_points", "text_sha256", "recipe", "literal")


def exact_groups(docs: DataFrame, identify=identified) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256, n_points, n_chunks.

    Of equal texts the row with the most code points in its original text
    stays, then the smallest doc_id.
    """
    rows = recipes(docs, identify)
    best = F.min(F.struct((-F.col("n_points")).alias("n"), F.col("doc_id").isNull().alias("no_id"), F.col("doc_id").alias("id")))
    groups = (rows.groupBy("recipe", "literal").agg(best.alias("best"), F.count("*").alias("group_size"))
              .filter("group_size > 1"))
    joined = hot_join(rows, groups, ["recipe", "literal"], how="left")
    keep = F.when(F.col("best").isNull(), F.col("doc_id")).otherwise(F.col("best.id"))
    return joined.select(
        "doc_id", keep.alias("keep_id"), F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        (F.col("best").isNull() | (F.col("doc_id").eqNullSafe(F.col("best.id")) & (F.col("n_points") == -F.col("best.n")))).alias("kept"),
        "text_sha256", "n_points", F.size("recipe").cast("long").alias("n_chunks"))


def deduplicate(docs: DataFrame) -> DataFrame:
    """The input rows that stay, one per group, with all their columns."""
    same_key = exact_groups(docs).groupBy("doc_id", "text_sha256", "n_points").agg(F.first("kept").alias("_stays"), F.count("*").alias("_copies"))
    special = written(same_key.filter("not _stays or _copies > 1").select(
        F.col("doc_id").alias("_id"), F.col("text_sha256").alias("_sha"), F.col("n_points").alias("_n"), "_stays"), "dedup-keys")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("doc_id").alias("own_id"),
                       F.sha2(normalised(), 256).alias("sha"), F.length(F.coalesce("text", F.lit(""))).cast("long").alias("n"))
    hit = (rows["sha"] == special["_sha"]) & (rows["n"] == special["_n"]) & rows["own_id"].eqNullSafe(special["_id"])
    stay = rows.join(special, hit, "leftanti")
    repeated = special.filter("_stays")  # rows that tie in id and length with equal text
    if not repeated.isEmpty():
        stay = stay.unionByName(rows.join(repeated, hit, "leftsemi").dropDuplicates(["sha"]))
    return stay.select("row.*")


def op1_exact_dedup(spark, sf_dir):
    """Exact copies of all documents, by chunk recipes."""
    return exact_groups(documents(spark, sf_dir)).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


ORACLE = """
WITH n AS (
  SELECT doc_id, length(coalesce(text, '')) AS n_points,
         regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]', '', 'g') AS norm
  FROM documents
)
SELECT doc_id,
       first_value(doc_id) OVER w AS keep_id,
       count(*) OVER (PARTITION BY norm) AS group_size,
       row_number() OVER w = 1 AS kept,
       sha256(norm) AS text_sha256
FROM n
WINDOW w AS (PARTITION BY norm ORDER BY n_points DESC, doc_id)
"""
