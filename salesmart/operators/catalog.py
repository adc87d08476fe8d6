"""Configuration tables as DataFrames (JOIN-3..6, JOIN-11, JOIN-12, AGG-2,
FLT-2..4, DML-3, DML-4, SRC-6).

Tasks, sources, targets, templates and categories are small tables joined
by id. Joins are left to Catalyst: the size estimates of the scans decide
on broadcasts (``autoBroadcastJoinThreshold``) and AQE revisits the choice
with the real sizes at runtime, so nothing is broadcast on assumption.
"""

from __future__ import annotations

import operator
import re
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesmart.functions.names import dataset_name_from_path, surrogate_key, template_name_from_path
from salesmart.sources.files import whole_files


def conjunction(*predicates: Column | None) -> Column:
    """FLT-2: AND of the given predicates; none given -> TRUE."""
    given = [p for p in predicates if p is not None]
    return reduce(operator.and_, given) if given else F.lit(True)


def eq_if(col: str, value) -> Column | None:
    return None if value is None else (F.col(col) == F.lit(value))


def contains_ci(col: str | Column, text: str) -> Column:
    """FLT-3, literal form: case-insensitive substring."""
    c = F.col(col) if isinstance(col, str) else col
    return F.lower(c).contains(text.lower())


def like_ci(col: str | Column, text: str) -> Column:
    """FLT-3, pattern form: ``%``/``_`` in the search text act as wildcards, a backslash stands for itself."""
    c = F.col(col) if isinstance(col, str) else col
    return F.lower(c).like("%" + text.lower().replace("\\", "\\\\") + "%")


def weather_sources(sources: DataFrame) -> DataFrame:
    """FLT-4: weather flag set and a non-empty cloud key."""
    return sources.where(F.col("load_weather") & F.col("cloud_api_key").isNotNull() & (F.col("cloud_api_key") != ""))


def task_details(tasks: DataFrame, sources: DataFrame, targets: DataFrame, templates: DataFrame,
                 categories: DataFrame, category_id: int | None = None, is_active: bool | None = None) -> DataFrame:
    """JOIN-3 + FLT-2 + SRT-1: task with source, target, template (inner) and category (left)."""
    t, s, g, p, c = (tasks.alias("t"), sources.alias("s"), targets.alias("g"), templates.alias("p"),
                     categories.alias("c"))
    j = (t.join(s, F.col("t.source_id") == F.col("s.id"))
         .join(g, F.col("t.target_id") == F.col("g.id"))
         .join(p, F.col("t.template_id") == F.col("p.id"))
         .join(c, F.col("s.category_id") == F.col("c.id"), "left"))
    j = j.where(conjunction(eq_if("s.category_id", category_id), eq_if("t.is_active", is_active)))
    return j.select(
        F.col("t.id").alias("task_id"), F.col("t.name").alias("task_name"), F.col("t.dataset_name"),
        F.col("t.days_offset_start"), F.col("t.days_offset_end"), F.col("t.is_active"),
        F.col("s.name").alias("source_name"), F.col("s.api_url"), F.col("s.currency").alias("source_currency"),
        F.col("s.category_id"), F.col("g.name").alias("target_name"), F.col("g.host"), F.col("g.port"),
        F.col("p.name").alias("template_name"), F.col("c.name").alias("category_name"),
        F.col("c.is_active").alias("category_active"),
    ).orderBy("task_name", "task_id")


def task_filter(tasks: DataFrame, sources: DataFrame, templates: DataFrame, source_name: str | None = None,
                template_name: str | None = None, is_active: bool | None = None,
                category_id: int | None = None) -> DataFrame:
    """JOIN-4 + FLT-2: tasks of the given source/template/state/category."""
    t, s, p = tasks.alias("t"), sources.alias("s"), templates.alias("p")
    j = t.join(s, F.col("t.source_id") == F.col("s.id")).join(p, F.col("t.template_id") == F.col("p.id"))
    j = j.where(conjunction(eq_if("s.name", source_name), eq_if("p.name", template_name),
                            eq_if("t.is_active", is_active), eq_if("s.category_id", category_id)))
    return j.select("t.*").orderBy("name", "id")


def source_categories(sources: DataFrame, categories: DataFrame, category_id: int | None = None) -> DataFrame:
    """JOIN-5: sources with their optional category."""
    s, c = sources.alias("s"), categories.alias("c")
    j = s.join(c, F.col("s.category_id") == F.col("c.id"), "left")
    j = j.where(conjunction(eq_if("s.category_id", category_id)))
    return j.select("s.*", F.col("c.name").alias("category_name"), F.col("c.is_active").alias("category_active"))


def category_counts(categories: DataFrame, sources: DataFrame, tasks: DataFrame | None = None) -> DataFrame:
    """AGG-2: sources (and tasks) per category; categories without any keep 0."""
    c, s = categories.alias("c"), sources.alias("s")
    j = c.join(s, F.col("c.id") == F.col("s.category_id"), "left")
    aggs = [F.countDistinct(F.col("s.id")).alias("connection_count")]
    if tasks is not None:
        t = tasks.alias("t")
        j = j.join(t, F.col("t.source_id") == F.col("s.id"), "left")
        aggs.append(F.count(F.col("t.id")).alias("task_count"))
    return j.groupBy(F.col("c.id").alias("id"), F.col("c.name").alias("name")).agg(*aggs).orderBy("name")


def bulk_update(tasks: DataFrame, sources: DataFrame, templates: DataFrame, source_name: str | None = None,
                template_name: str | None = None, is_active: bool | None = None,
                days_offset_start: int = 14, days_offset_end: int = 0) -> DataFrame:
    """DML-3: new offsets for tasks matched through their source and template.

    Returns the whole task table with the updated values and an ``updated``
    flag; ``count_if(updated)`` is the number of changed rows.
    """
    s = sources.select(F.col("id").alias("_s_id"), F.col("name").alias("_s_name"))
    p = templates.select(F.col("id").alias("_p_id"), F.col("name").alias("_p_name"))
    j = tasks.join(s, tasks.source_id == s._s_id, "left").join(p, tasks.template_id == p._p_id, "left")
    matched = F.col("_s_id").isNotNull() & F.col("_p_id").isNotNull() & conjunction(
        eq_if("_s_name", source_name), eq_if("_p_name", template_name), eq_if("is_active", is_active))
    matched = F.coalesce(matched, F.lit(False))
    out = []
    for c in tasks.columns:
        if c == "days_offset_start":
            out.append(F.when(matched, F.lit(days_offset_start)).otherwise(F.col(c)).alias(c))
        elif c == "days_offset_end":
            out.append(F.when(matched, F.lit(days_offset_end)).otherwise(F.col(c)).alias(c))
        else:
            out.append(F.col(c))
    return j.select(*out, matched.alias("updated"))


def one_per_key(incoming: DataFrame, key: list[str], order: list[str] | None = None, last: bool = False) -> DataFrame:
    """One whole row per key: the first (or last) by ``order``, by default all other columns.

    An ordinary aggregate over a struct: it combines before the shuffle and
    never mixes the fields of two rows.
    """
    rest = [c for c in incoming.columns if c not in key]
    if not rest:
        return incoming.distinct()
    row, by = F.struct(*rest), F.struct(*(order or []), *rest)
    pick = (F.max if last else F.min)(F.struct(by.alias("by"), row.alias("row")))
    return incoming.groupBy(*key).agg(pick.alias("_p")).select(*key, "_p.row.*").select(*incoming.columns)


def insert_if_absent(existing: DataFrame, incoming: DataFrame, key: list[str],
                     name_from: list[str] | None = None, order: list[str] | None = None) -> DataFrame:
    """JOIN-11 (+FN-8): incoming records whose natural key is not present yet.

    Duplicates in the input collapse to the first whole record per key; the
    generated name is the short SHA-256 of the key fields joined by ``|``.
    """
    new = one_per_key(incoming, key, order).join(existing.select(*key).distinct(), key, "left_anti")
    if name_from:
        new = new.withColumn("name", surrogate_key(*name_from))
    return new


def upsert(existing: DataFrame, incoming: DataFrame, key: list[str], update_cols: list[str],
           order: list[str] | None = None) -> DataFrame:
    """DML-4: insert new keys; on a clash overwrite ``update_cols`` from incoming.

    One whole incoming record per key (the last by ``order``); columns not
    listed keep their stored value, or the incoming one for a new key.
    """
    rest = [c for c in incoming.columns if c not in key]
    inc = one_per_key(incoming, key, order, last=True).select(*key, F.lit(True).alias("_in"), *[F.col(c).alias(f"_new_{c}") for c in rest])
    j = existing.withColumn("_ex", F.lit(True)).join(inc, key, "full_outer")
    cols = []
    for c in existing.columns:
        if c in key:
            cols.append(F.col(c))
        elif c in update_cols and c in rest:
            cols.append(F.when(F.col("_in").isNotNull(), F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c))
        elif c in rest:
            cols.append(F.when(F.col("_ex").isNull(), F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c))
        else:
            cols.append(F.col(c))
    return j.select(*cols)


def search_ci(text: str, *cols: str, pattern: bool = False) -> Column:
    """FLT-3 over several columns: the text in any of them; a null column has no match."""
    match = like_ci if pattern else contains_ci
    return reduce(operator.or_, [F.coalesce(match(c, text), F.lit(False)) for c in cols])


def name_clash(candidates: DataFrame, existing: DataFrame, col: str = "name") -> DataFrame:
    """JOIN-12: candidates whose name equals an existing one, ignoring case."""
    ex = existing.select(F.lower(F.col(col)).alias("_lname")).distinct()
    return candidates.join(ex, F.lower(candidates[col]) == ex["_lname"], "left_semi")


# Path parts that mark files which are not dataset configs.
CONFIG_SKIP_PARTS = ["cronicle_info", "config.json", "fields_", "requirements", "style.css"]
CONFIG_SKIP_DIRS = ["templates", "temp"]
# Top-level keys of a dataset config document (report source
# section, mart target section, report template); all three are required.
CONFIG_SOURCE_KEY = "iiko"
CONFIG_TARGET_KEY = "clickhouse"
CONFIG_TEMPLATE_KEY = "default_report_config"
CONFIG_REQUIRED_KEYS = [CONFIG_SOURCE_KEY, CONFIG_TARGET_KEY, CONFIG_TEMPLATE_KEY]


# A document larger than this is no dataset config; it is reported by its size and never read.
CONFIG_MAX_BYTES = 16 << 20


def config_files(spark: SparkSession, root: str, max_bytes: int = CONFIG_MAX_BYTES) -> DataFrame:
    """SRC-6 + FN-9: every file of a directory tree as a dataset config, or the reason why it is none.

    One row per file: ``relative_path`` (below ``root``), the template's and
    dataset's names by that path, the fields of the document, and
    ``skip_reason`` (null for a config): the first that holds of ``name``
    (not ``.json``), ``excluded path``, ``excluded folder``, ``too large``,
    ``not json`` (a blank file too) and ``lacks <section>``; the fields of a
    skipped file are null. Spark lists no files of zero bytes.

    A document may be a file or, as Spark writes it, a folder
    ``document=<name>.json`` in a folder ``folder=<name>`` with one part file,
    or a file of that name in such a folder.
    Files are listed and read whole by the tasks, many to a task; the driver
    neither opens nor knows them.
    """
    files = whole_files(spark, root, max_bytes)
    # Spark escapes what it puts into folder names
    path = F.expr("CASE WHEN path LIKE '%/document=%' THEN regexp_replace(try_url_decode(replace(path, '+', '%2B')), '/part-[^/]*$', '') ELSE path END")
    base = r"^([a-z0-9]+:(//[^/]*)?)?" + _re_escape(re.sub(r"^[a-z0-9]+:(//[^/]*)?(?=/)", "", root.rstrip("/"))) + "/+"
    rel = F.regexp_replace(F.regexp_replace(path, base, ""), r"(^|/)(folder|document)=", "$1")
    sections = T.StructType([
        T.StructField(CONFIG_SOURCE_KEY, T.MapType(T.StringType(), T.StringType())),
        T.StructField(CONFIG_TARGET_KEY, T.MapType(T.StringType(), T.StringType())),
        T.StructField(CONFIG_TEMPLATE_KEY, T.StringType()),
        T.StructField("_corrupt_record", T.StringType()),
    ])
    text = F.col("content").cast("string")
    doc = F.when(text.rlike(r"^\s*\{"), F.from_json(text, sections, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"}))
    found = files.select(rel.alias("relative_path"), doc.alias("doc"), (F.col("length") > F.lit(max_bytes)).alias("large"))
    rel, doc = F.col("relative_path"), F.col("doc")
    reason = F.when(~rel.endswith(".json"), "name")
    reason = reason.when(reduce(operator.or_, [rel.contains(p) for p in CONFIG_SKIP_PARTS]), "excluded path")
    reason = reason.when(reduce(operator.or_, [F.concat(F.lit("/"), rel).contains(f"/{d}/") for d in CONFIG_SKIP_DIRS]), "excluded folder")
    reason = reason.when(F.col("large"), "too large").when(doc.isNull() | doc["_corrupt_record"].isNotNull(), "not json")
    for key in CONFIG_REQUIRED_KEYS:
        reason = reason.when(doc[key].isNull(), f"lacks {key}")
    source, target, report = (F.when(F.col("skip_reason").isNull(), doc[k]) for k in CONFIG_REQUIRED_KEYS)
    return found.withColumn("skip_reason", reason).select(
        "relative_path", template_name_from_path(rel).alias("template_name"), dataset_name_from_path(rel).alias("dataset_name"),
        source["api_url"].alias("api_url"), source["login"].alias("login"), target["host"].alias("host"),
        target_key(target["host"], target["port"], target["user"]).alias("target_key"),
        F.get_json_object(report, "$.reportType").alias("report_type"), report.alias("report_config"), "skip_reason")


def read_config_dir(spark: SparkSession, root: str) -> DataFrame:
    """SRC-6: the dataset configs of a directory tree; files that are none are left out (``config_files`` has them)."""
    return config_files(spark, root).where("skip_reason IS NULL").drop("skip_reason")


def target_key(host: Column, port: Column, user: Column) -> Column:
    """FN-8 for mart connections: the short hash of ``host:port|user``."""
    return F.substring(F.sha2(F.concat(host, F.lit(":"), port, F.lit("|"), user), 256), 1, 16)


def _re_escape(s: str) -> str:
    return re.escape(s)
