"""Helpers shared by the corpus operators: inputs, shared folders, hot-key joins."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# White space that separates words, as a regular-expression class body.
WS = r"\x20\x09-\x0D"
WORD = rf"[^{WS}]+"
WS_CHARS = " \t\n\x0b\x0c\r"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that ``spark.checkpoint.dir`` names, registered for ``checkpoint()``.

    Only a session without that setting (local tests) gets a folder of its own.
    """
    sc = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not base:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="salesmart-llm-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(base)
    return base.rstrip("/")


def work_path(spark: SparkSession, name: str) -> str:
    """A path of its own below the shared folder, for a table written once."""
    return f"{shared_dir(spark)}/salesmart-llm/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """Materialise in the shared folder; later reads do not recompute the plan."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def written(df: DataFrame, name: str, **options) -> DataFrame:
    """Write as Parquet below the shared folder and read it back.

    The shuffle files behind the write are let go with it: nothing reads them again.
    """
    spark = df.sparkSession
    path = work_path(spark, name)
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.options(compression="zstd", **options).parquet(path)
    finally:
        spark.conf.unset(_CLEANUP) if before is None else spark.conf.set(_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def fold(doc_id: Column | str, n: int) -> Column:
    """crc32 of the id as text, modulo ``n`` (a null id counts as empty text)."""
    col = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.pmod(F.crc32(F.coalesce(col.cast("string"), F.lit("")).cast("binary")), F.lit(n))


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def hot_join(rows: DataFrame, small: DataFrame, keys: list[str], salts: int = 16, how: str = "inner") -> DataFrame:
    """Equi-join of a fact side with one row per key, spreading each key over ``salts`` tasks.

    ``small`` has at most one row per key and is repeated ``salts`` times, so a
    key that holds a third of all rows is dealt over ``salts`` partitions
    whether or not the planner notices the skew. The salt is a hash of the
    whole fact row, so a retried task deals its rows the same way. Both sides
    are shuffled: the planner sees ``small`` without its copies, so its size
    would be no safe ground for a broadcast.
    """
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in rows.columns]), F.lit(salts)).cast("int"))
    copies = small.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return salted.join(copies.hint("merge"), [*keys, "_salt"], how).drop("_salt")
