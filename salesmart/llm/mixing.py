"""Mixing sources to target weights by capped water-filling.

The budget (a share of all words) is dealt to the sources by weight. A
source never gives more than ``max_epochs`` times its size; what exceeds that
is dealt again among the others, by weight, until no source is above its cap.
The result is the water level L with target = min(cap, L * weight). Each
source then repeats every document floor(target / size) times and draws the
rest as a seeded sample of whole documents.

The draw orders a source's documents by a seeded hash and takes them up to
the fractional target. Where that order crosses the target is found in two
steps, a histogram of hash slots per source and then the one slot that holds
the crossing, so no task ever holds a source. The last document is taken when
that brings the source nearer to its target: the error is at most half that
document. All steps are SQL aggregates, windows over the histogram and joins.

Defined cases
* null or empty text: size 0, taken 0; null source: a source of its own, last in order
* null doc_id: an ordinary row; rows that repeat in id and text share their hash
  and are drawn together
* no words at all: every target is 0; no rows in, no rows out; extra columns are ignored
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salesmart.llm.common import WORD, cut, documents, written

WEIGHTS = (3.0, 1.0, 2.0)
SHARE = 1.5
MAX_EPOCHS = 2.0
SLOTS = 4096


def word_count() -> Column:
    return F.regexp_count(F.coalesce("text", F.lit("")), F.lit(WORD)).cast("long")


def draw_position(seed: int) -> Column:
    """Seeded position of a document in its source's draw, in [0, 2^52)."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.col("doc_id"), F.coalesce("text", F.lit(""))), 12)


def sized(docs: DataFrame, seed: int = 17) -> DataFrame:
    """doc_id, source, size in words, draw."""
    return docs.select("doc_id", "source", word_count().alias("size"), draw_position(seed).alias("draw"))


def ranked(sources: DataFrame) -> DataFrame:
    """Number the sources by code point, null last, from 0.

    Sources are dealt by range and numbered within each range; the ranges'
    counts (one row each) give the offsets, so no task holds all sources.
    """
    dealt = cut(sources.withColumn("no_source", F.col("source").isNull()).repartitionByRange("no_source", "source")
                .withColumn("part", F.spark_partition_id()))
    before = (dealt.groupBy("part").agg(F.count("*").alias("n"))
              .withColumn("before", F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))))
    within = F.row_number().over(Window.partitionBy("part").orderBy("no_source", "source")) - 1
    return (dealt.withColumn("within", within).join(before.select("part", "before"), "part")
            .withColumn("rank", F.col("within") + F.coalesce("before", F.lit(0))).drop("part", "no_source", "within", "before"))


def water_level(sources: DataFrame, share: float = SHARE, max_epochs: float = MAX_EPOCHS) -> float:
    """The level L at which sum(min(max_epochs * size, L * weight)) meets the budget.

    Each round is one aggregate over the sources; the level only rises, and
    the rounds end when no further source is clamped.
    """
    total, weight = sources.agg(F.sum("source_size"), F.sum("weight")).first()
    if not total:
        return 0.0
    budget, level, clamped = share * total, 0.0, -1
    level = budget / weight
    while True:
        full = F.col("source_size") * F.lit(max_epochs) <= F.col("weight") * F.lit(level)
        n, caps, left = sources.agg(
            F.sum(full.cast("int")), F.sum(F.when(full, F.col("source_size") * F.lit(max_epochs)).otherwise(0.0)),
            F.sum(F.when(full, 0.0).otherwise(F.col("weight")))).first()
        if n == clamped:
            return level
        if not left:
            return float("inf")
        clamped, level = n, max(level, (budget - caps) / left)


def targets(rows: DataFrame, weights=WEIGHTS, share: float = SHARE, max_epochs: float = MAX_EPOCHS) -> DataFrame:
    """One row per source: source, source_size, target, epochs (whole), rest (words of the partial epoch)."""
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    deal = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    sources = cut(ranked(sizes).withColumn("weight", deal))
    level = water_level(sources, share, max_epochs)
    target = F.least(F.col("source_size") * F.lit(max_epochs), F.col("weight") * F.lit(level))
    return (sources.withColumn("target", target)
            .withColumn("epochs", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long"))
            .withColumn("rest", F.col("target") - F.col("epochs") * F.col("source_size"))
            .select("source", F.col("source").isNull().alias("no_source"), "source_size", "target", "epochs", "rest"))


def draw_limits(rows: DataFrame, per_source: DataFrame, slots: int = SLOTS) -> DataFrame:
    """Per source the first draw position that the partial epoch no longer takes.

    Null means that it takes none of the source's documents.
    """
    shift = 52 - (slots.bit_length() - 1)
    slotted = rows.filter("size > 0").withColumn("slot", F.shiftright("draw", shift))
    by_slot = slotted.groupBy("source", "slot").agg(F.sum("size").alias("size"))
    upto = Window.partitionBy("source").orderBy("slot")
    crossing = (by_slot.withColumn("upto", F.sum("size").over(upto))
                .join(per_source, by_slot.source.eqNullSafe(per_source.source), "inner").drop(per_source.source)
                .filter((F.col("upto") > F.col("rest")) & (F.col("upto") - F.col("size") <= F.col("rest")))
                .select(F.col("source").alias("c_source"), F.col("slot").alias("c_slot"), "rest",
                        (F.col("upto") - F.col("size")).alias("before")))
    fine = (slotted.join(crossing, slotted.source.eqNullSafe(crossing.c_source) & (slotted.slot == crossing.c_slot))
            .groupBy("source", "slot", "draw", "rest", "before").agg(F.sum("size").alias("size")))
    within = Window.partitionBy("source").orderBy("draw")
    # a draw position is taken when the middle of its words lies below the target
    end = F.col("before") + F.sum("size").over(within)
    left = fine.withColumn("middle", end - F.col("size") / 2).filter(F.col("middle") > F.col("rest"))
    first_out = left.groupBy("source").agg(F.min("draw").alias("first_out"))
    after = crossing.select("c_source", F.shiftleft(F.col("c_slot") + 1, shift).alias("slot_end"))
    return (after.join(first_out, after.c_source.eqNullSafe(first_out.source), "left")
            .select("c_source", F.coalesce("first_out", "slot_end").alias("limit")))


def drawn(rows: DataFrame, known: DataFrame) -> DataFrame:
    """``rows`` (size, draw, source and any more) with source_size, target and ``copies``.

    ``known`` is a table with one row per source: Catalyst broadcasts it below its
    own size limit; above it both sides are shuffled and a hot source is split by AQE.
    """
    keyed = rows.withColumns({"_source": F.coalesce("source", F.lit("")), "_none": F.col("source").isNull()})
    extra = F.coalesce((F.col("draw") < F.col("limit")) & (F.col("size") > 0), F.lit(False)).cast("long")
    return keyed.join(known, ["_source", "_none"]).withColumn("copies", F.col("epochs") + extra).drop("_source", "_none", "epochs", "limit")


def plan(rows: DataFrame, weights=WEIGHTS, share: float = SHARE, max_epochs: float = MAX_EPOCHS) -> DataFrame:
    """Per source: _source, _none (the key), source_size, target, epochs, limit (of the draw).

    Written as a table, so the planner sees its size and sends it to the rows only when it is small.
    """
    per_source = cut(targets(rows, weights, share, max_epochs))
    limits = draw_limits(rows, per_source)
    return written(per_source.join(limits, per_source.source.eqNullSafe(limits.c_source), "left").select(
        F.coalesce("source", F.lit("")).alias("_source"), F.col("no_source").alias("_none"), "source_size",
        F.col("target").cast("double").alias("target"), "epochs", "limit"), "mix-plan")


def mix(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, max_epochs: float = MAX_EPOCHS, seed: int = 17) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, copies, taken, draw.

    ``copies`` is how often the mix holds the document, ``taken`` the words that makes.
    """
    rows = cut(sized(docs, seed))
    return drawn(rows, plan(rows, weights, share, max_epochs)).select(
        "doc_id", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"), "draw")


def mixed(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, max_epochs: float = MAX_EPOCHS, seed: int = 17) -> DataFrame:
    """The mix itself: each input row as often as the mix holds it, with all its columns."""
    known = plan(cut(sized(docs, seed)), weights, share, max_epochs)
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), "source", word_count().alias("size"),
                       draw_position(seed).alias("draw"))
    repeated = drawn(rows, known).filter("copies > 0")
    return repeated.select("row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select("row.*")


def op8_source_mix(spark, sf_dir):
    """All documents mixed to the sources' target weights."""
    return mix(documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken")
