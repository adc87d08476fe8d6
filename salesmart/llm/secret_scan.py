"""Secret findings, with false positives removed by a random forest.

Candidates, found with their places, are runs of 12 token characters or more with
a digit, many capitals or a capital behind a small letter, and by context any
value of 8 characters or more but white space and quotes that a cue word is
assigned or that stands in quotes. Each has features of

* length: of the candidate and of the text before it on the line
* characters: how often the kind of character changes, shares of digits, capitals
  and hexadecimal digits, distinct characters, longest run of letters
* dictionary coverage: the share of its letters that lie in words that the
  corpus uses often (at least ``WORD_SHARE`` of all words)
* path: depth and length of the source and whether it names tests or examples
* neighbours: a cue word or an assignment before it, a cue behind it, whether
  the word before it is a dictionary word

The forest is Spark's own, fitted on at most ``FINDINGS`` distinct labelled
findings of each label, chosen by hash, with both labels of equal weight. A
finding labelled as a secret stays one whatever the forest votes. Labelled findings come as a table (doc_id, s, secret) or, where
none are given, from formats that are certain: issued key ids and quoted or
assigned values of high entropy are secrets; mail addresses, numbers, dates,
file names, placeholders and hyphenated words are not.

Defined cases
* null or empty text: no candidates; null source: an empty path
* rows that repeat have the same findings each; null ids are ordinary rows
* findings of one label only, or none: no forest, the certain formats decide alone
* no rows in, no rows out; extra columns are ignored
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.llm.common import cut, documents, hot_join
from salesmart.llm.spans import located

FINDINGS = 20_000
WORD_SHARE = 1e-6
TREES, DEPTH = 40, 8
ACCEPT = 0.5
_C = "[A-Za-z0-9+/_.@:=~-]"
# Words that announce a secret, and formats whose label is certain.
CUES = ["password", "passwd", "pwd", "secret", "token", "key", "apikey", "api_key", "access", "auth", "credential", "bearer"]
_ASSIGN = r"[\"']?[ \t]{0,3}(?::=|=>|[:=])[ \t]{0,3}"
_KEY = rf"(?i:(?=[A-Za-z0-9_.-]*+{_ASSIGN})[A-Za-z0-9_.-]*?(?:{'|'.join(CUES)})[A-Za-z0-9_-]*+{_ASSIGN})[\"']?"  # "password: "
_NO_SMALL, _NO_CAPITAL = "[A-Z0-9+/_.@:=~-]", "[a-z0-9+/_.@:=~-]"
CANDIDATE = (rf"(?<!{_C}){_KEY}[^\s\"']{{8,}}+|(?<=[\"'])[^\s\"']{{8,}}+(?=[\"'])"
             rf"|(?<!{_C})(?={_C}*[0-9]|[A-Z]{{12}}|{_NO_SMALL}*+[a-z]{_NO_CAPITAL}*+[A-Z]){_C}{{12,}}+")
CERTAIN_SECRET = [r"^(AKIA|ASIA)[0-9A-Z]{16}$", r"^(ghp|gho|ghs)_[A-Za-z0-9]{30,}$", r"^xox[abp]-[0-9A-Za-z-]{20,}$"]
CERTAIN_NOT = [r"^[^@]+@[^@]+[.][a-z]+$", r"^[0-9.:/+=-]+$", r"^[A-Za-z]+([-_./][A-Za-z]+)+[0-9]{0,2}$", r"(?i)(example|changeme|placeholder|xxxx|1234567)",
               r"(.)\1{5}", r"^https?:", r"^[a-z]+[0-9]{1,4}$"]
FEATURES = ["length", "lead", "changes", "digits", "capitals", "hex", "distinct", "letter_run", "covered", "path_depth", "path_length", "path_test",
            "cue_before", "assigned", "quoted", "cue_after", "word_before"]


def dictionary(docs: DataFrame, share: float = WORD_SHARE) -> DataFrame:
    """Words of three letters or more that make up at least ``share`` of all words."""
    words = docs.select(F.explode_outer(F.split(F.lower("text"), r"[^\p{L}]+")).alias("word")).filter(F.length("word") >= 3)
    counts = cut(words.groupBy("word").agg(F.count("*").alias("n")).filter("n > 1"))
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    return counts.filter(F.col("n") >= share * total).select("word")


def candidates(docs: DataFrame) -> DataFrame:
    """One row per candidate: doc_id, text_key, path, s, e, value, key (what it is assigned to), before, after."""
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), F.coalesce("source", F.lit("")).alias("path"))
    rows = located(rows, CANDIDATE, "found", F.length("text") >= 8)
    # outer, so that no filter on the matches is pushed below the projections that compute them
    flat = rows.select("doc_id", F.xxhash64("text").alias("text_key"), "path", F.explode_outer("found").alias("x")).filter("x IS NOT NULL")
    key = F.regexp_extract("x.v", rf"^(?:{_KEY}|[A-Za-z_]{{2,20}}[=:])", 0)  # "password=": the value behind it is the candidate
    flat = flat.withColumn("key", key).withColumn("value", F.expr("regexp_replace(substr(x.v, length(key) + 1), '[.:=,]+$', '')"))
    return flat.select("doc_id", "text_key", "path", (F.col("x.s") + F.length("key")).alias("s"),
                       F.expr("x.s + length(key) + length(value)").alias("e"), "value", F.lower("key").alias("key"),
                       F.lower("x.before").alias("before"), F.lower("x.after").alias("after"), "x.line").filter("e - s >= 8")


def with_features(found: DataFrame, words: DataFrame) -> DataFrame:
    """The candidates with a column per feature."""
    keyed = found.withColumn("parts", F.expr(r"filter(split(lower(value), '[^\\p{L}]+'), p -> length(p) >= 3)"))
    keyed = keyed.withColumn("previous", F.regexp_extract(F.concat("before", "key"), r"(\p{L}+)[^\p{L}]*$", 1))
    asked = keyed.select(F.explode(F.array_union("parts", F.array("previous"))).alias("word")).distinct()
    known = asked.join(words, "word").select("word", F.lit(True).alias("is_word"))
    # per candidate value and neighbour, so a value that stands in very many texts is looked up once
    distinct = keyed.select("value", "parts", "previous").distinct()
    covered = (hot_join(distinct.select("value", "previous", F.posexplode("parts").alias("at", "word")), known, ["word"])
               .groupBy("value", "previous").agg(F.sum(F.length("word")).alias("covered_letters")))
    neighbour = hot_join(distinct.select("value", "previous", F.col("previous").alias("word")), known, ["word"]).select(
        "value", "previous", F.lit(1.0).alias("word_before"))
    per_value = cut(distinct.select("value", "previous").join(covered, ["value", "previous"], "left")
                    .join(neighbour, ["value", "previous"], "left"))
    rows = hot_join(keyed, per_value, ["value", "previous"])
    n = F.length("value").cast("double")
    kinds = F.regexp_replace(F.regexp_replace(F.regexp_replace("value", "[0-9]", "0"), "[a-z]", "a"), "[A-Z]", "A")

    def share(chars: str):
        return F.length(F.regexp_replace("value", f"[^{chars}]", "")) / n
    cue = "|".join(CUES)
    return rows.withColumns({
        "length": n,
        "lead": (F.col("line") + F.length("key")).cast("double"),
        "changes": F.length(F.regexp_replace(kinds, r"(.)\1+", "$1")) / n,
        "digits": share("0-9"), "capitals": share("A-Z"), "hex": share("0-9a-fA-F"),
        "distinct": F.size(F.array_distinct(F.split("value", ""))) / n,
        "letter_run": F.array_max(F.transform(F.split("value", "[^A-Za-z]+"), F.length)).cast("double"),
        "covered": F.coalesce("covered_letters", F.lit(0)) / n,
        "path_depth": F.size(F.split("path", "/")).cast("double"), "path_length": F.length("path").cast("double"),
        "path_test": F.col("path").rlike("(?i)test|example|sample|doc").cast("double"),
        "cue_before": F.concat("before", "key").rlike(f"({cue})[^a-z]{{0,4}}$").cast("double"),
        "assigned": (F.col("key") != "").cast("double") + F.col("before").rlike(r"[=:]\s*[\"']?$").cast("double"),
        "quoted": F.concat("before", "key").rlike("[\"']$").cast("double"),
        "cue_after": F.col("after").rlike(f"^[^a-z]{{0,4}}({cue})").cast("double"),
        "word_before": F.coalesce("word_before", F.lit(0.0)),
    }).drop("parts", "previous", "covered_letters")


def certain_labels(rows: DataFrame) -> DataFrame:
    """Adds ``secret``: 1.0 or 0.0 where a format is certain, else null."""
    yes, no = F.lit(False), F.lit(False)
    for p in CERTAIN_SECRET:
        yes = yes | F.col("value").rlike(p)
    yes = yes | ((F.col("cue_before") > 0) & (F.col("assigned") > 0) & F.col("value").rlike("[0-9]") & (F.col("distinct") >= 0.2) & (F.col("covered") < 0.3))
    for p in CERTAIN_NOT:
        no = no | F.col("value").rlike(p)
    return rows.withColumn("secret", F.when(no, F.lit(0.0)).when(yes, F.lit(1.0)))


def fit(labelled: DataFrame, limit: int = FINDINGS, trees: int = TREES, depth: int = DEPTH):
    """Forest over at most ``limit`` distinct labelled findings a label (columns of FEATURES and secret); None without both labels."""
    distinct = cut(labelled.filter("secret IS NOT NULL").select("secret", "value", *FEATURES).distinct().withColumn("_order", F.xxhash64("value", *FEATURES)))
    parts = [distinct.filter(F.col("secret") == label).orderBy("_order", *FEATURES).limit(limit) for label in (0.0, 1.0)]
    sample = cut(parts[0].union(parts[1]).select("secret", *FEATURES))
    counts = {r["secret"]: r["count"] for r in sample.groupBy("secret").count().collect()}  # two rows at most
    if len(counts) < 2:
        return None
    sample = sample.withColumn("_weight", F.when(F.col("secret") > 0, sum(counts.values()) / 2 / counts[1.0]).otherwise(sum(counts.values()) / 2 / counts[0.0]))
    rows = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(sample)
    return RandomForestClassifier(labelCol="secret", featuresCol="features", weightCol="_weight", numTrees=trees, maxDepth=depth, seed=7).fit(rows)


def scan(docs: DataFrame, findings: DataFrame | None = None, limit: int = FINDINGS) -> DataFrame:
    """One row per candidate: doc_id, text_key, s, e, value, score, secret (verdict).

    ``findings`` (doc_id, s, secret 0/1) are labelled findings; without them the certain formats are used.
    """
    rows = cut(with_features(cut(candidates(docs)), dictionary(docs)))
    if findings is None:
        labelled = certain_labels(rows)
    else:
        given = findings.groupBy("doc_id", "s").agg(F.max(F.col("secret").cast("double")).alias("secret"))
        labelled = rows.join(given, ["doc_id", "s"], "left")
    forest = fit(labelled, limit)
    if forest is None:
        scored = certain_labels(rows).withColumn("score", F.coalesce("secret", F.lit(0.0)))
    else:
        ready = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(labelled)
        scored = forest.transform(ready).withColumn("score", F.when(F.col("secret") > 0, F.lit(1.0)).otherwise(vector_to_array("probability")[1]))
    return scored.select("doc_id", "text_key", "s", "e", "value", "score", (F.col("score") >= ACCEPT).alias("secret"))


def report(docs: DataFrame, findings: DataFrame | None = None, limit: int = FINDINGS) -> DataFrame:
    """One row per document: doc_id, n_candidates, n_secrets, spans (start:end of the secrets), score (highest)."""
    found = scan(docs, findings, limit).select("doc_id", "text_key", "s", "e", "score", "secret").distinct()
    by_text = found.groupBy("doc_id", "text_key").agg(
        F.count("*").alias("n_candidates"), F.sum(F.col("secret").cast("long")).alias("n_secrets"), F.max("score").alias("score"),
        F.array_sort(F.collect_list(F.when(F.col("secret"), F.struct("s", "e")))).alias("own"))
    keys = docs.select("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_key"))
    by_text = by_text.select(F.col("doc_id").alias("b_id"), F.col("text_key").alias("b_key"), "n_candidates", "n_secrets", "score", "own")
    joined = keys.join(by_text, keys["doc_id"].eqNullSafe(by_text["b_id"]) & (keys["text_key"] == by_text["b_key"]), "left")
    return joined.select("doc_id", F.coalesce("n_candidates", F.lit(0)).alias("n_candidates"), F.coalesce("n_secrets", F.lit(0)).alias("n_secrets"),
                         F.coalesce(F.expr("array_join(transform(own, x -> concat(x.s, ':', x.e)), ',')"), F.lit("")).alias("spans"),
                         F.coalesce("score", F.lit(0.0)).alias("score"))


def op10_secret_forest(spark, sf_dir):
    """Secrets in all documents."""
    return report(documents(spark, sf_dir))
