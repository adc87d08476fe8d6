"""Personal data by bootstrapped contextual extraction.

Seeds are the spans that the base formats find (email, ip, card, phone). The
words around a seed induce lexical patterns: the two words before it, the word
before with the word after it, and a cue before it that ends in a colon or an
equals sign. Patterns and instances form a bipartite graph that Spark scores in
rounds. An instance of a kind is a seed, which counts 1, or a string accepted in
an earlier round, which counts as far as it is believed. A pattern's confidence
in a kind, as a string sees it, is the share of instances among the other
distinct strings that stand in it; the string itself counts on neither side. A
pattern needs ``SUPPORT`` other instances, seeds or accepted. An identifier-like
string that no base format found is believed as far as its patterns are confident
(noisy-or over its patterns), if its shape suits the kind, and accepted from
``ACCEPT`` on. Strings that are not accepted lend nothing, so chance seeds in a
common context do not lift each other. Accepted strings induce patterns like
seeds, and rounds go on until none is added and no belief grows by
``TOLERANCE``: beliefs only grow, so they settle. Accepted strings add spans;
base spans stay.

Positions come from one regular expression each: the pieces between matches
and the matches themselves alternate, so running sums of their lengths are the
starts, in code points. All steps are SQL functions, aggregates and joins.

Defined cases
* null or empty text: no spans, the hash of the empty string
* rows that repeat have the same spans each; null ids are ordinary rows
* copies of a text support a pattern once, since instances count by value
* no rows in, no rows out; extra columns are ignored
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.llm.common import WS, cut, documents, hot_join
from salesmart.llm.spans import located

KINDS = ("email", "ip", "card", "phone")
SUPPORT = 3
ACCEPT = 0.8
TOLERANCE = 1e-3
_USER, _HOST = "[A-Za-z0-9._%+-]", "[A-Za-z0-9-]"
# Each finds what the plain format finds, in linear time: a match starts at the
# front of its run or right behind the previous match, and runs are possessive.
FORMATS = {
    "email": rf"(?:(?<!{_USER})|\G){_USER}++@{_HOST}++(?:\.{_HOST}++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++(?:\.[0-9]++){3}",
    "card": r"(?:(?<![0-9])|\G)[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_HINT = {"email": "@", "ip": ".", "card": "", "phone": "+"}
_REGION = "|".join([FORMATS["email"], FORMATS["phone"], r"(?<![0-9A-Za-z])\(?[0-9]{2,4}\)?[ .-][0-9]{2,4}[ .-][0-9]{2,5}(?![0-9A-Za-z])",
                    FORMATS["card"] + rf"(?![^{WS}.,;:!?])", rf"(?<![^{WS}])[^{WS}0-9@]*+[0-9@][^{WS}]*+"])


def _valid(kind: str) -> str:
    """SQL condition on a match ``x.v`` of the kind's format."""
    digits = "regexp_replace(x.v, '[^0-9]', '')"
    if kind == "ip":
        return "forall(split(x.v, '[.]'), p -> length(ltrim('0', p)) <= 3 AND coalesce(try_cast(ltrim('0', p) AS INT), 0) <= 255)"
    if kind == "phone":
        return f"length({digits}) BETWEEN 9 AND 15"
    if kind == "card":
        doubled = "CAST(d AS INT) * (1 + i % 2)"
        luhn = (f"aggregate(transform(split(reverse({digits}), ''), (d, i) -> {doubled} - CASE WHEN {doubled} > 9 THEN 9 ELSE 0 END), "
                "0, (a, x) -> a + x) % 10 = 0")
        return f"CASE WHEN length({digits}) BETWEEN 13 AND 19 THEN {luhn} ELSE false END"
    return "true"


def base_spans(docs: DataFrame) -> DataFrame:
    """doc_id, key of the text, base (array of kind, s, e), regions (identifier-like strings with their neighbours)."""
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    digit = F.col("text").rlike("[0-9]")
    for kind in KINDS:
        want = F.contains("text", F.lit(_HINT[kind])) if kind == "email" else F.contains("text", F.lit(_HINT[kind])) & digit
        rows = located(rows, FORMATS[kind], kind, want)
        rows = rows.withColumn(kind, F.expr(f"filter({kind}, x -> {_valid(kind)})"))
    rows = located(rows, _REGION, "region", digit | F.contains("text", F.lit("@")))
    spans = [f"transform({k}, x -> named_struct('kind', '{k}', 's', x.s, 'e', x.e))" for k in KINDS]
    return rows.select("doc_id", F.xxhash64("text").alias("text_key"), F.expr(f"concat({', '.join(spans)})").alias("base"), "region")


def _words(side: str) -> str:
    return f"filter(split(lower({side}), r'[{WS}]+'), w -> w <> '')"


def occurrences(rows: DataFrame) -> DataFrame:
    """One row per identifier-like string: where it stands, its value, known kind (or null), suiting kinds, patterns."""
    trimmed = "regexp_replace(r.v, r'[.,;:!?)\\]\"\\x27}>]+$', '')"
    flat = rows.select("doc_id", "text_key", "base", F.explode("region").alias("r")).select(
        "doc_id", "text_key", "base", F.col("r.s").alias("s"), F.expr(f"r.s + length({trimmed})").alias("e"),
        F.expr(f"lower({trimmed})").alias("value"), F.expr(_words("r.before")).alias("before"), F.expr(_words("r.after")).alias("after"))
    flat = flat.filter("e > s").withColumn("known", F.expr("get(filter(base, b -> b.s < e AND b.e > s), 0).kind")).drop("base")
    digits = "length(regexp_replace(value, '[^0-9]', ''))"
    suits = F.expr(f"""filter(array(
        CASE WHEN value LIKE '%_@_%' THEN 'email' END,
        CASE WHEN value RLIKE '^[0-9a-f:.]+$' AND (length(value) - length(replace(value, '.', '')) = 3
             OR length(value) - length(replace(value, ':', '')) >= 2) THEN 'ip' END,
        CASE WHEN value RLIKE '^[0-9 -]+$' AND {digits} BETWEEN 12 AND 19 THEN 'card' END,
        CASE WHEN value RLIKE '^[0-9 ().+-]+$' AND {digits} BETWEEN 7 AND 15 THEN 'phone' END), k -> k IS NOT NULL)""")
    patterns = F.expr("""filter(array(
        CASE WHEN size(before) >= 2 THEN concat('2 ', before[size(before) - 2], ' ', before[size(before) - 1]) END,
        CASE WHEN size(before) >= 1 AND size(after) >= 1 THEN concat('1 ', before[size(before) - 1], ' _ ', after[0]) END,
        CASE WHEN size(before) >= 1 AND before[size(before) - 1] RLIKE '[:=]$' THEN concat('c ', before[size(before) - 1]) END),
        p -> p IS NOT NULL)""")
    return flat.withColumn("suits", suits).withColumn("patterns", patterns).drop("before", "after")


def believed(found: DataFrame, support: int = SUPPORT, accept: float = ACCEPT, tolerance: float = TOLERANCE) -> DataFrame:
    """value, kind, belief of the strings that the pattern graph accepts."""
    edges = cut(found.select(F.explode("patterns").alias("pattern"), "value", "known", "suits").distinct())
    seeds = edges.filter("known IS NOT NULL").select("pattern", "value", F.col("known").alias("kind"), F.lit(1.0).alias("mass")).distinct()
    totals = cut(edges.groupBy("pattern").agg(F.countDistinct("value").alias("total")))
    open_edges = cut(edges.filter("known IS NULL").select("pattern", "value", F.explode("suits").alias("kind")).distinct())
    accepted = found.sparkSession.createDataFrame([], "value string, kind string, belief double")
    while True:
        # what each edge's own string lends to the pattern: nothing, or its belief in the kind it was accepted for
        own = cut(hot_join(open_edges, accepted.withColumnRenamed("kind", "held"), ["value"], how="left")
                  .withColumn("own", F.when(F.col("held") == F.col("kind"), F.col("belief"))).drop("belief"))
        lent = own.filter("own IS NOT NULL").select("pattern", "value", "kind", F.col("own").alias("mass"))
        strong = (seeds.union(lent).groupBy("pattern", "kind").agg(F.count("*").alias("instances"), F.sum("mass").alias("mass"))
                  .filter(F.col("instances") >= support).join(totals, "pattern"))
        scored = hot_join(own, strong, ["pattern", "kind"]).filter(F.col("instances") - F.col("own").isNotNull().cast("int") >= support)
        confidence = F.least((F.col("mass") - F.coalesce("own", F.lit(0.0))) / F.greatest(F.col("total") - 1, F.lit(1)), F.lit(0.99))
        beliefs = scored.groupBy("value", "kind", "held").agg((1 - F.exp(F.sum(F.log1p(-confidence)))).alias("belief"))
        # a string takes the kind that is believed most, and keeps it
        best = (beliefs.filter((F.col("belief") >= accept) & (F.col("held").isNull() | (F.col("held") == F.col("kind"))))
                .groupBy("value").agg(F.max(F.struct("belief", "kind")).alias("b")).select("value", "b.kind", "b.belief"))
        best = cut(best)
        before = accepted.select("value", F.col("belief").alias("before"))
        grown = best.join(before, "value", "left").agg(F.max(F.col("belief") - F.coalesce("before", F.lit(0.0)))).first()[0]
        accepted = best
        if grown is None or grown < tolerance:
            return accepted


def _listed(spans: str) -> str:
    rank = "array_position(array('email', 'ip', 'card', 'phone'), x.kind)"
    ordered = f"array_sort(transform({spans}, x -> named_struct('k', {rank}, 's', x.s, 'e', x.e, 'kind', x.kind)))"
    return f"array_join(transform({ordered}, x -> concat(x.kind, ':', x.s, ':', x.e)), ',')"


def find(docs: DataFrame, support: int = SUPPORT, accept: float = ACCEPT, tolerance: float = TOLERANCE) -> DataFrame:
    """One row per document: counts and hash of the base spans, all spans, and how many the patterns added."""
    rows = cut(base_spans(docs))
    seen = cut(occurrences(rows))
    new = believed(seen, support, accept, tolerance)
    added = (hot_join(seen.filter("known IS NULL").drop("patterns", "suits"), new, ["value"])
             .groupBy("doc_id", "text_key").agg(F.collect_set(F.struct("kind", "s", "e")).alias("added"))
             .select(F.col("doc_id").alias("a_id"), F.col("text_key").alias("a_key"), "added"))
    joined = rows.join(added, rows["doc_id"].eqNullSafe(added["a_id"]) & (rows["text_key"] == added["a_key"]), "left")
    counts = [F.expr(f"CAST(size(filter(base, x -> x.kind = '{k}')) AS BIGINT)").alias(f"n_{k}") for k in KINDS]
    everything = "concat(base, coalesce(added, CAST(array() AS ARRAY<STRUCT<kind: STRING, s: BIGINT, e: BIGINT>>)))"
    return joined.select("doc_id", *counts, F.sha2(F.expr(_listed("base")), 256).alias("base_sha256"),
                         F.expr(_listed(everything)).alias("spans"), F.coalesce(F.size("added"), F.lit(0)).cast("long").alias("n_added"))


def op5_contextual_pii(spark, sf_dir):
    """Personal data in all documents."""
    return find(documents(spark, sf_dir))
