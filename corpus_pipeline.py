"""A corpus from raw documents to token ids, in five stages.

1. toxicity: documents that score as toxic go
2. exact deduplication: one document of each group of equal texts stays
3. near-deduplication: one document of each component of near copies stays
   (five-word shingles, similarity 0.8 or more)
4. source mix: documents are repeated or left out to meet the sources' target weights
5. byte-level BPE: the ids of every document of the mix, checked by decoding them

Every stage takes and returns the columns of ``documents``; the last returns
doc_id, n_tokens, ids_sha256, decoded_sha256, same and ids. A document that
the mix repeats has one row for each copy. Null and empty texts, null ids and
sources, ties and repeated rows are treated as the operators' modules say; an
empty input stays empty. Extra columns pass through stages 1 to 4.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from salesmart.llm import bpe, exact_dedup, minhash, mixing, toxicity
from salesmart.llm.common import documents, labels, work_path
from salesmart.session import apply_defaults

# A pair at similarity 0.8 shares none of 36 bands of 5 rows with probability 6e-7.
NEAR = {"words": 5, "percent": 80, "bands": 36, "rows": 5}


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    apply_defaults(spark)
    return toxicity.accepted(docs, toxicity.fit(docs, labels(spark, sf_dir)))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    apply_defaults(spark)
    return exact_dedup.deduplicate(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    apply_defaults(spark)
    return minhash.deduplicate(docs, **NEAR)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    apply_defaults(spark)
    return mixing.mixed(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    apply_defaults(spark)
    return bpe.round_trip(docs, with_ids=True)


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_exact_copies),
    ("near_dedup", drop_near_copies),
    ("source_mix", mix_sources),
    ("byte_bpe", encode),
]

# The learned toxicity model, MinHash components and BPE are beyond SQL; tests compare run() with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage returns is written and read again for the next."""
    docs = documents(spark, sf_dir)
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            path = work_path(spark, name)
            docs.write.parquet(path)
            docs = spark.read.parquet(path)
    return docs
