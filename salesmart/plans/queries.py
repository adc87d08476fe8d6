"""Registered queries: one callable ``(spark, data_dir) -> DataFrame`` per key.

Each query reads the generated tables (or inputs Spark derives from them)
in full and runs one engine operator chain on them.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesmart.functions.names import dataset_parts
from salesmart.operators import catalog, fx, geo, keyed, latest, load, mart, normalize, template, weather, windows
from salesmart.plans import params as P
from salesmart.session import work_dir
from salesmart.sources import fixtures, landed

Query = Callable[[SparkSession, str], DataFrame]


def report_sales(spark: SparkSession, data_dir: str) -> DataFrame:
    """AGG-1 + FLT-1 over the sales rows."""
    rows = fixtures.sales_raw(spark, data_dir)
    return template.run_report(rows, P.SALES_TEMPLATE, P.REPORT_FROM, P.REPORT_TO)


def report_transactions(spark: SparkSession, data_dir: str) -> DataFrame:
    """AGG-1 on receipts: sum and average of the incoming amount."""
    rows = fixtures.transactions_raw(spark, data_dir)
    return template.run_report(rows, P.TRANSACTIONS_TEMPLATE, P.REPORT_FROM, P.REPORT_TO)


def fx_convert(spark: SparkSession, data_dir: str) -> DataFrame:
    """JOIN-1 + OP-10/11 + WIN-2: base-currency copies of every measure."""
    rows = fixtures.sales_raw(spark, data_dir)
    rows = rows.where(template.date_range_filter("OpenDate_Typed", P.LOAD_FROM, P.LOAD_TO))
    return fx.convert(spark, rows, fixtures.rates(spark), "OpenDate_Typed",
                      ["DishSumInt", "DishAmountInt", "DishDiscountSumInt"], P.LOAD_FROM, P.LOAD_TO)


def fx_exact(spark: SparkSession, data_dir: str) -> DataFrame:
    """JOIN-2: exact-day rate of every sales row."""
    rows = fixtures.sales_raw(spark, data_dir)
    return fx.exact_rates(rows, fixtures.rates(spark), "OpenDate_Typed")


def _rates_with_usd(spark: SparkSession) -> DataFrame:
    r = fixtures.rates(spark)
    n = F.datediff(F.col("date"), F.lit(fixtures.RATES_FIRST_DAY))
    return r.withColumn("usd", ((F.lit(9000) + n % 40) / 100).cast(fx.RATE_TYPE))


def fx_register(spark: SparkSession, data_dir: str) -> DataFrame:
    """EXT-1: register code ``usd`` on rate column ``USD`` (code upper-cased,
    column lower-cased) and convert with the extended mapping."""
    rows = fixtures.sales_raw(spark, data_dir)
    rows = rows.where(template.date_range_filter("OpenDate_Typed", P.LOAD_FROM, P.LOAD_TO))
    params = fx.FxParams().register_currency("usd", "USD")
    return fx.convert(spark, rows, _rates_with_usd(spark), "OpenDate_Typed",
                      ["DishSumInt"], P.LOAD_FROM, P.LOAD_TO, params)


def _landed(spark: SparkSession, data_dir: str) -> DataFrame:
    raw = fixtures.sales_messy(spark, data_dir)
    named = normalize.normalise_columns(raw)
    return normalize.project_to_schema(named, P.MESSY_SCHEMA, F.col("_source"), keep=["_chunk_from", "_chunk_to"])


def normalize_names(spark: SparkSession, data_dir: str) -> DataFrame:
    """OP-1/2/3: renamed, projected to the mart, source address as ``url``."""
    return _landed(spark, data_dir).drop("_chunk_from", "_chunk_to")


def dropped_fields(spark: SparkSession, data_dir: str) -> DataFrame:
    """OP-2 report over map-shaped records: fields with no mart column."""
    raw = fixtures.sales_messy(spark, data_dir)
    fields = [c for c in raw.columns if not c.startswith("_")]
    record = F.map_filter(F.create_map(*[x for c in fields for x in (F.lit(c), F.col(f"`{c}`"))]),
                          lambda k, v: v != F.lit(""))
    records = raw.select(record.alias("record"))
    schema = template.mart_schema(P.SALES_MART_TEMPLATE, convert_currency=False)
    return normalize.dropped_fields_of_records(records, "record", schema)


def _typed(spark: SparkSession, data_dir: str) -> DataFrame:
    return normalize.coerce_to_schema(_landed(spark, data_dir), P.MESSY_SCHEMA)


def coerce_types(spark: SparkSession, data_dir: str) -> DataFrame:
    """OP-4..7: numbers, date-times and dates parsed from report text."""
    return _typed(spark, data_dir).drop("_chunk_from", "_chunk_to")


def _filled(spark: SparkSession, data_dir: str) -> DataFrame:
    return normalize.fill_defaults(_typed(spark, data_dir), P.MESSY_SCHEMA)


def fill_defaults(spark: SparkSession, data_dir: str) -> DataFrame:
    """OP-8: empty text columns of the mart get the default text."""
    return _filled(spark, data_dir).drop("_chunk_from", "_chunk_to")


def quarantine(spark: SparkSession, data_dir: str) -> DataFrame:
    """SNK-4: rows that cannot enter the mart, with the reason and chunk."""
    _, rejects = normalize.split_rejects(_filled(spark, data_dir), P.MESSY_SCHEMA)
    return rejects


def fx_landed(spark: SparkSession, data_dir: str) -> DataFrame:
    """JOIN-1 + OP-10 + OP-11: sources on chunks of their own, rows dated past their
    chunk, connection currencies, very small and very large amounts."""
    rows = fixtures.sales_landed(spark, data_dir)
    return fx.convert(spark, rows, fixtures.rates(spark), "OpenDate_Typed", ["DishSumInt"], P.LOAD_FROM, P.LOAD_TO,
                      connection_currency="connection_currency", chunk_col="_chunk_from", chunk_end_col="_chunk_to")


def _landing(spark: SparkSession, data_dir: str) -> tuple[mart.MartSpec, DataFrame, DataFrame]:
    """(a new mart's layout with converted copies of all measures, the landed records, the rate table)."""
    full = template.mart_schema(P.SALES_MART_TEMPLATE, convert_currency=True)
    spec = mart.add_columns(spark, _mart_spec(spark, P.MESSY_SCHEMA, "load-mart"), full)  # SCH-3: the converted copies come later
    rates_path, landing = work_dir(spark, "rates"), work_dir(spark, "landing")
    fixtures.rates(spark).write.parquet(rates_path)
    fixtures.write_landed_lines(spark, data_dir, landing)
    return spec, landed.read_report_records(spark, landing), landed.read_rates(spark, rates_path)


def _loaded(spark: SparkSession, data_dir: str) -> tuple[mart.MartSpec, str]:
    """The load of the landed lines into a new mart."""
    spec, records, rates = _landing(spark, data_dir)
    mart.create_mart(spark, spec)
    if not mart.mart_exists(spark, spec.path):
        raise ValueError("the mart was not created")
    rejects = work_dir(spark, "rejects")
    load.load_landed(spark, records, spec, P.MEASURES, rates, P.LOAD_FROM, P.LOAD_TO, rejects)
    return spec, rejects


def _reported(spark: SparkSession, data_dir: str) -> load.LoadReport:
    """What the load reports: the pass that all its steps read."""
    spec, records, rates = _landing(spark, data_dir)
    return load.stage_landed(spark, records, spec, P.MEASURES, rates, P.LOAD_FROM, P.LOAD_TO)


def load_pipeline(spark: SparkSession, data_dir: str) -> DataFrame:
    """SRC-1, SRC-2, OP-1..OP-8, OP-10, OP-12, SNK-1..3, SCH-1..4: landed JSON to mart rows."""
    spec, _ = _loaded(spark, data_dir)
    return mart.read_mart(spark, spec).drop(mart.MONTH)


def load_summary(spark: SparkSession, data_dir: str) -> DataFrame:
    """AGG-8: what became of the landed lines, per source and chunk, out of the load's own pass."""
    return _reported(spark, data_dir).summary


def load_unknown_fields(spark: SparkSession, data_dir: str) -> DataFrame:
    """SRC-1 + OP-2: the fields of a load that have no mart column, with their records and sources."""
    return _reported(spark, data_dir).unknown


def load_rejects(spark: SparkSession, data_dir: str) -> DataFrame:
    """SNK-4: the rejects of the load as read back from their JSON lines: fields of the record (FN-10), or
    the text of a line that does not parse, and the source folder it came from."""
    _, rejects = _loaded(spark, data_dir)
    rows = spark.read.schema("record string, error string, chunk string, raw string, file string").option("recursiveFileLookup", True).json(rejects)
    return rows.select(F.get_json_object("record", "$.UniqOrderId_Id").alias("order_id"), F.get_json_object("record", "$.url").alias("url"), "error", "chunk",
                       F.when(F.col("record").isNull(), F.col("raw")).alias("raw"), (F.length("raw") > 0).alias("has_raw"),
                       F.regexp_extract("file", "source=([^/]+)/", 1).alias("source"))


def _mart_spec(spark: SparkSession, schema, name: str) -> mart.MartSpec:
    return mart.MartSpec(work_dir(spark, name), schema, "OpenDate_Typed",
                         tuple(template.sort_key(P.SALES_MART_TEMPLATE, schema)))


def replace_batch(rows: DataFrame) -> DataFrame:
    """The re-load: the window's rows of the re-loaded sources with a
    corrected amount; one dish group is gone and one source returned nothing
    for its second chunk (that chunk must keep its old rows)."""
    w = template.date_range_filter("OpenDate_Typed", P.REPLACE_FROM, P.REPLACE_TO)
    quiet = (F.col("url") == F.lit(P.REPLACE_QUIET_SOURCE)) & \
        F.col("OpenDate_Typed").between(F.lit(P.REPLACE_QUIET_FROM), F.lit(P.REPLACE_QUIET_TO))
    inside = rows.where(w & F.col("url").isin(P.REPLACE_SOURCES) & ~quiet & (F.col("DishGroup") != F.lit(P.REPLACE_GONE_GROUP)))
    # the report range reaches past the window: rows of a later day and month come along
    late = rows.where(F.col("url").isin(P.REPLACE_SOURCES) & (F.col("OpenDate_Typed") == F.lit(P.REPLACE_LATE_DAY)))
    return inside.unionByName(late).withColumn("DishSumInt", F.col("DishSumInt") + F.lit(100.0))


def replace_range(spark: SparkSession, data_dir: str) -> DataFrame:
    """DML-1 + SCH-2: range replace per source into a mart whose schema evolves."""
    rows = fixtures.sales_raw(spark, data_dir)
    full = template.mart_schema(P.SALES_MART_TEMPLATE, convert_currency=False)
    old_schema = T.StructType([f for f in full.fields if f.name != "DishAmountInt"])
    spec = _mart_spec(spark, old_schema, "mart")
    mart.create_mart(spark, spec, rows)
    spec = mart.add_columns(spark, spec, full)
    for _ in range(2):  # the second run changes nothing
        mart.replace_range(spark, spec, replace_batch(rows), P.REPLACE_FROM, P.REPLACE_TO)
    return mart.read_mart(spark, spec).select(*full.fieldNames())


def dataset_profile(spark: SparkSession, data_dir: str) -> DataFrame:
    """AGG-7: rows, date span and sources per month partition."""
    return mart.partition_profile(fixtures.sales_raw(spark, data_dir), "OpenDate_Typed")


def dataset_info(spark: SparkSession, data_dir: str) -> DataFrame:
    """AGG-3: row count and date range of the mart."""
    return mart.profile(fixtures.sales_raw(spark, data_dir), "OpenDate_Typed")


def dataset_columns(spark: SparkSession, data_dir: str) -> DataFrame:
    """AGG-3: the mart's columns with type and number of values."""
    return mart.column_profile(fixtures.sales_raw(spark, data_dir))


def partition_sizes(spark: SparkSession, data_dir: str) -> DataFrame:
    """AGG-7: rows, and whether files and bytes are known, per month partition of a written mart."""
    rows = fixtures.sales_raw(spark, data_dir)
    spec = replace(_mart_spec(spark, template.mart_schema(P.SALES_MART_TEMPLATE, convert_currency=False), "sizes"), max_records_per_file=500)
    mart.create_mart(spark, spec, rows)
    return mart.partition_sizes(spark, spec).select("month", "rows", (F.col("bytes") > 0).alias("has_bytes"),
                                                    (F.col("files") >= F.ceil(F.col("rows") / 500)).alias("batched"))


def hot_partition_files(spark: SparkSession, data_dir: str) -> DataFrame:
    """SNK-1 + SRT-3: rows per partition of a mart whose large partitions are cut by the sort key, and whether any of its files overlap.

    Every third order comes from one hot source, the others from three.
    """
    url = "CASE WHEN CAST(UniqOrderId_Id AS BIGINT) % 3 = 0 THEN 'http://hot' ELSE concat('http://src', CAST(substring(url, 11) AS INT) % 3) END"
    rows = fixtures.sales_raw(spark, data_dir).withColumn("url", F.expr(url))
    schema = template.mart_schema(P.SALES_MART_TEMPLATE, convert_currency=False)
    spec = replace(_mart_spec(spark, schema, "hot"), range_rows=200)
    mart.create_mart(spark, spec, rows)
    return mart.file_overlaps(spark, spec).select("month", "url", "rows", "overlapping")


def reorganize_check(spark: SparkSession, data_dir: str) -> DataFrame:
    """DML-5 + AGG-6: rewrite into the partitioned layout and reconcile per month."""
    rows = fixtures.sales_raw(spark, data_dir)
    schema = template.mart_schema(P.SALES_MART_TEMPLATE, convert_currency=False)
    return mart.reorganize(spark, rows, _mart_spec(spark, schema, "reorg"))


def reorganize_switch(spark: SparkSession, data_dir: str) -> DataFrame:
    """DML-5 + SCH-4 + AGG-6: months of a table read by name, before and after its new layout takes over the name.

    A first attempt, whose new table has changed values in place, is refused.
    """
    rows = fixtures.sales_raw(spark, data_dir)
    spec = _mart_spec(spark, template.mart_schema(P.SALES_MART_TEMPLATE, convert_currency=False), "switch-new")
    name, flat, wrong = "sales_" + uuid.uuid4().hex[:12], work_dir(spark, "switch-old"), work_dir(spark, "switch-wrong")
    mart.align(rows, spec.schema).write.parquet(flat)
    mart.register(spark, name, flat, spec.schema, ())
    spark.table(name).withColumn("DishSumInt", F.col("DishSumInt") + F.when(F.col("DishId") == "1", 1).otherwise(0)).write.parquet(wrong)
    mart.register(spark, f"{name}_wrong", wrong, spec.schema, ())
    first = mart.switch(spark, name, f"{name}_wrong", mart.reconcile(spark.table(name), spark.table(f"{name}_wrong"), spec.schema, "OpenDate_Typed"))
    report = mart.reorganize(spark, spark.table(name), spec)
    mart.register(spark, f"{name}_new", spec.path, spec.table_schema)
    second = mart.switch(spark, name, f"{name}_new", report)
    before = spark.table(f"{name}_old").groupBy(mart.month_key("OpenDate_Typed").alias("_month")).agg(F.count("*").alias("rows_before"))
    after = spark.table(name).groupBy(mart.MONTH).agg(F.count("*").alias("rows_after"))
    return before.join(after, F.col(mart.MONTH) == F.col("_month"), "full_outer").select(
        F.coalesce(mart.MONTH, "_month").alias("month"), "rows_before", "rows_after", F.lit(first).alias("first_switch"), F.lit(second).alias("second_switch"))


def _cfg(spark: SparkSession, data_dir: str):
    return (fixtures.tasks(spark, data_dir), fixtures.sources(spark, data_dir), fixtures.targets(spark, data_dir),
            fixtures.templates(spark, data_dir), fixtures.categories(spark, data_dir))


def task_details(spark: SparkSession, data_dir: str) -> DataFrame:
    """JOIN-3 + SRT-1: tasks with source, target, template and category."""
    return catalog.task_details(*_cfg(spark, data_dir))


def task_filter(spark: SparkSession, data_dir: str) -> DataFrame:
    """JOIN-4 + FLT-2: active tasks of one template."""
    tasks, sources, _, templates, _ = _cfg(spark, data_dir)
    return catalog.task_filter(tasks, sources, templates, template_name=P.FILTER_TEMPLATE, is_active=True)


def source_categories(spark: SparkSession, data_dir: str) -> DataFrame:
    """JOIN-5 + FLT-3 + FLT-4: tasks of weather sources, with the optional category."""
    tasks, sources, _, _, categories = _cfg(spark, data_dir)
    src = catalog.source_categories(catalog.weather_sources(sources), categories)
    t = tasks.where(catalog.contains_ci("name", P.TASK_SEARCH))
    j = t.join(src.withColumnRenamed("id", "_sid").withColumnRenamed("name", "source_name"),
               F.col("source_id") == F.col("_sid"))
    return j.select(F.col("id").alias("task_id"), F.col("name").alias("task_name"), "source_id", "source_name",
                    "api_url", "category_name", "category_active")


def category_counts(spark: SparkSession, data_dir: str) -> DataFrame:
    """AGG-2: sources and tasks per category, empty categories kept."""
    tasks, sources, _, _, categories = _cfg(spark, data_dir)
    return catalog.category_counts(categories, sources, tasks)


def bulk_update(spark: SparkSession, data_dir: str) -> DataFrame:
    """DML-3: reset the offsets of the active tasks of one template."""
    tasks, sources, _, templates, _ = _cfg(spark, data_dir)
    return catalog.bulk_update(tasks, sources, templates, template_name=P.UPDATE_TEMPLATE, is_active=True)


def _incoming_connections(spark: SparkSession, data_dir: str) -> DataFrame:
    c = fixtures.read_table(spark, data_dir, "customer", ["c_custkey"])
    k = (F.col("c_custkey") % 40).cast("string")
    return c.select(F.concat(F.lit("http://src"), k).alias("api_url"), F.concat(F.lit("user"), k).alias("login"),
                    F.concat(F.lit("pw"), F.col("c_custkey").cast("string")).alias("password"),
                    (F.lit(1_000_000) - F.col("c_custkey")).alias("rank"))


def insert_if_absent(spark: SparkSession, data_dir: str) -> DataFrame:
    """JOIN-11 + FN-8: connection configs not registered yet, with generated names."""
    return catalog.insert_if_absent(fixtures.sources(spark, data_dir), _incoming_connections(spark, data_dir),
                                    ["api_url", "login"], name_from=["api_url", "login"])


def upsert(spark: SparkSession, data_dir: str) -> DataFrame:
    """DML-4: connections by (address, login); the last record of a key sets the currency, a new key brings all of it."""
    c = fixtures.read_table(spark, data_dir, "customer", ["c_custkey", "c_name", "c_nationkey"])
    k = (F.col("c_custkey") % 40).cast("string")
    incoming = c.select(F.concat(F.lit("http://src"), k).alias("api_url"), F.concat(F.lit("user"), k).alias("login"), F.col("c_name").alias("name"),
                        F.when(F.col("c_nationkey") % 2 == 0, F.lit("AMD")).otherwise(F.lit("KGS")).alias("currency"), F.col("c_custkey").alias("seq"))
    existing = fixtures.sources(spark, data_dir).select("api_url", "login", "name", "currency")
    return catalog.upsert(existing, incoming, ["api_url", "login"], ["currency"], order=["seq"])


def task_search(spark: SparkSession, data_dir: str) -> DataFrame:
    """FLT-3 + FN-3: tasks whose name or dataset holds the text, with the dataset's two parts."""
    tasks = fixtures.tasks(spark, data_dir)
    hit = catalog.search_ci(P.ANY_SEARCH, "name", "dataset_name")
    return tasks.where(hit).select("id", "name", "dataset_name", *dataset_parts("dataset_name"))


def config_ingest(spark: SparkSession, data_dir: str) -> DataFrame:
    """SRC-6 + FN-8..FN-10: config documents found, read whole and named by their path; a reason for each file that is none."""
    path = work_dir(spark, "configs")
    fixtures.write_config_files(spark, data_dir, path)
    return catalog.config_files(spark, path).drop("report_config")


def name_clash(spark: SparkSession, data_dir: str) -> DataFrame:
    """JOIN-12: proposed task names that clash, ignoring case, with existing ones."""
    c = fixtures.read_table(spark, data_dir, "customer", ["c_custkey", "c_name"])
    cand = c.select(F.col("c_custkey").alias("id"),
                    F.when(F.col("c_custkey") % 3 == 0, F.upper("c_name"))
                    .otherwise(F.concat(F.col("c_name"), F.lit(" copy"))).alias("name"))
    return catalog.name_clash(cand, fixtures.tasks(spark, data_dir))


def multi_source_window(spark: SparkSession, data_dir: str) -> DataFrame:
    """WIN-1 + WIN-5 + JOIN-6: every active task with each row of its window, and how many windows hold the row."""
    tasks, sources, targets, templates, _ = _cfg(spark, data_dir)
    cfg = windows.task_configs(tasks, sources, targets, templates)
    rows = fixtures.sales_raw(spark, data_dir)
    out = windows.task_rows(cfg, rows, P.AS_OF, "OpenDate_Typed")
    return out.select("task_id", "OpenDate_Typed", "UniqOrderId_Id", "DishId", "DishSumInt", "url", "n_tasks")


def task_coverage(spark: SparkSession, data_dir: str) -> DataFrame:
    """WIN-5: how many active tasks' windows cover each source and day."""
    tasks, sources, targets, templates, _ = _cfg(spark, data_dir)
    return windows.coverage(windows.task_configs(tasks, sources, targets, templates), P.AS_OF)


def date_chunks(spark: SparkSession, data_dir: str) -> DataFrame:
    """WIN-2: 7-day chunks of every active task's window."""
    tasks, sources, targets, templates, _ = _cfg(spark, data_dir)
    cfg = windows.task_window(windows.task_configs(tasks, sources, targets, templates), P.AS_OF)
    return windows.explode_chunks(cfg, 7).select(
        F.col("id").alias("task_id"), "date_from", "date_to", "chunk_from", "chunk_to")


def _outlet_ref(spark: SparkSession, data_dir: str) -> DataFrame:
    orgs = fixtures.outlets(spark, data_dir)
    src = catalog.weather_sources(fixtures.sources(spark, data_dir)).select(
        F.col("id").alias("_sid"), "cloud_api_key")
    j = orgs.join(src, orgs.source_id == src._sid)
    return weather.outlet_reference(j, "cloud_api_key", keep=["source_id", "seq", "s_acctbal"])


def outlet_reference(spark: SparkSession, data_dir: str) -> DataFrame:
    """SRC-3 + OP-9 + OP-13: outlet reference rows of weather sources."""
    return _outlet_ref(spark, data_dir).drop("source_id", "seq", "s_acctbal")


def outlet_responses(spark: SparkSession, data_dir: str) -> DataFrame:
    """SRC-3 + OP-9 + OP-13 + FLT-4: landed outlet responses, read from their files, as reference rows of weather sources."""
    path = work_dir(spark, "outlets")
    fixtures.write_outlet_responses(spark, data_dir, path)
    orgs = landed.read_outlet_responses(spark, path, lines=True)
    src = catalog.weather_sources(fixtures.sources(spark, data_dir)).select(F.col("id").alias("_sid"), "cloud_api_key")
    return weather.outlet_reference(orgs.join(src, orgs.source_id == src._sid), "cloud_api_key")


def _stations(spark: SparkSession, data_dir: str) -> DataFrame:
    e = fixtures.read_table(spark, data_dir, "events", ["user_id"])
    loc = (F.col("user_id") % fixtures.WEATHER_LOCATIONS).cast("int")
    st = e.select(loc.alias("station_id")).distinct()
    return st.select("station_id",
                     (F.lit(55.01) + F.col("station_id") * 0.04).alias("lat"),
                     (F.lit(37.01) + (F.col("station_id") % 3) * 0.05).alias("lon"))


def outlet_summary(spark: SparkSession, data_dir: str) -> DataFrame:
    """AGG-9: outlets, outlets with coordinates and distinct points per source."""
    return weather.outlet_summary(_outlet_ref(spark, data_dir), "source_id")


def outlet_stations(spark: SparkSession, data_dir: str) -> DataFrame:
    """JOIN-8: weather points within 5 km of each outlet (haversine)."""
    pts = _outlet_ref(spark, data_dir).where(F.col("lat").isNotNull() & F.col("lon").isNotNull())
    res = geo.stations_within(pts.select("org_id", "lat", "lon"), _stations(spark, data_dir))
    return res.select("org_id", "station_id", F.round("distance_km", 6).alias("distance_km"))


def _clustered(spark: SparkSession, data_dir: str) -> DataFrame:
    ref = _outlet_ref(spark, data_dir).where(F.col("lat").isNotNull() & F.col("lon").isNotNull())
    return ref.withColumn("cluster", (F.col("seq") % fixtures.WEATHER_LOCATIONS).cast("int"))


def cluster_centroids(spark: SparkSession, data_dir: str) -> DataFrame:
    """AGG-4 + FLT-5: centre and members of each source's given clusters."""
    return geo.centroids(_clustered(spark, data_dir), ["source_id", "cluster"])


def weather_requests(spark: SparkSession, data_dir: str) -> DataFrame:
    """AGG-11 + WIN-3 + WIN-4: history and forecast requests, one per source and cluster label."""
    centres = geo.centroids(_clustered(spark, data_dir), ["source_id", "cluster"], order_col="seq").selectExpr(
        "source_id", "concat('city-', CAST(cluster % 4 AS STRING)) AS city_cluster", "c_lat AS lat", "c_lon AS lon", "first_seq")
    return weather.request_windows(weather.cluster_requests(centres, "source_id"), fixtures.WEATHER_AS_OF)


def weather_explode(spark: SparkSession, data_dir: str) -> DataFrame:
    """SRC-4 + WIN-3 + SET-1: history and forecast responses to daily rows."""
    return weather.explode_weather(fixtures.weather_responses(spark, data_dir), ["location", "part"])


def _outlet_weather(spark: SparkSession, data_dir: str) -> tuple[DataFrame, DataFrame]:
    """(stored rows, new rows) of the weather of outlets."""
    new_w = weather.explode_weather(fixtures.weather_responses(spark, data_dir), ["location"]) \
        .withColumnRenamed("location", "cluster")
    ref = _outlet_ref(spark, data_dir).where(F.col("lat").isNotNull() & F.col("lon").isNotNull())
    outlets = ref.select("org_id", "org_name", "lat", "lon",
                         (F.col("seq") % fixtures.WEATHER_LOCATIONS).cast("int").alias("cluster"))
    outlets = outlets.withColumn("city_cluster", F.concat(F.lit("cluster-"), F.col("cluster").cast("string")))
    new_rows = weather.weather_for_outlets(new_w, outlets, ["cluster"]).withColumn("load", F.lit("new"))
    old_w = fixtures.weather_daily(spark, data_dir).select(
        F.col("location").alias("cluster"), F.col("day").alias("date"),
        *[(F.col(v) + F.lit(0.5)).alias(n) if v == "temperature_2m_mean" else F.col(v).alias(n)
          for v, n in weather.WEATHER_FIELDS.items()])
    old_rows = weather.weather_for_outlets(old_w, outlets, ["cluster"]).withColumn("load", F.lit("old"))
    return old_rows, new_rows


def weather_by_outlet(spark: SparkSession, data_dir: str) -> DataFrame:
    """JOIN-7 + JOIN-10 + DML-2 + AGG-11: refresh outlet weather for a range."""
    old_rows, new_rows = _outlet_weather(spark, data_dir)
    out = weather.replace_weather(old_rows, new_rows, P.WEATHER_FROM, P.WEATHER_TO)
    # AGG-5: the table keeps one row per outlet and day, the newer load first
    out = out.drop("cluster").withColumn("_v", F.when(F.col("load") == "new", 1).otherwise(0))
    return latest.latest_by_key(out, ["date", "org_id"], ["_v"]).drop("_v")


def weather_table(spark: SparkSession, data_dir: str) -> DataFrame:
    """SNK-5 + DML-2 + JOIN-10 on a stored table: two syncs, a refresh of a range, compaction of busy buckets, read."""
    old_rows, new_rows = (rows.drop("cluster") for rows in _outlet_weather(spark, data_dir))
    table = keyed.KeyedTable(work_dir(spark, "weather"), old_rows.schema, ("date", "org_id"), buckets=8)
    keyed.sync(spark, table, old_rows.where(F.col("date") < F.lit(P.WEATHER_TO)))
    keyed.sync(spark, table, old_rows.where(F.col("date") >= F.lit(P.WEATHER_FROM)))
    keyed.compact(spark, table)
    keyed.refresh(spark, table, new_rows, P.WEATHER_FROM, P.WEATHER_TO)
    keyed.compact(spark, table, min_syncs=1)
    keyed.clean(spark, table)
    return keyed.read(spark, table)


def outlet_table(spark: SparkSession, data_dir: str) -> DataFrame:
    """SNK-5 + AGG-5 on a stored table: three syncs of outlets, the last compaction between them, latest by sync time."""
    versions = _outlet_versions(spark, data_dir)
    table = keyed.KeyedTable(work_dir(spark, "outlets"), versions[0].schema, ("org_id",), ("synced_at", "seq"), buckets=8)
    keyed.sync(spark, table, versions[2])  # a late one first: it still wins by its time
    keyed.sync(spark, table, versions[0])
    keyed.compact(spark, table, min_syncs=2)
    keyed.sync(spark, table, versions[1])
    return keyed.read(spark, table)


def _outlet_versions(spark: SparkSession, data_dir: str) -> list[DataFrame]:
    """Three syncs of the outlets; the last two at the same time."""
    ref = _outlet_ref(spark, data_dir)
    base = ref.select("org_id", "org_name", "lat", "lon", "s_acctbal")
    t1, t2 = P.SYNC_1, P.SYNC_2
    v1 = base.select("org_id", "org_name", "lat", "lon", F.lit(t1).cast("timestamp_ntz").alias("synced_at"), F.lit(1).alias("seq"))
    v2 = base.where(F.col("s_acctbal") > 5000).select(
        "org_id", F.concat(F.col("org_name"), F.lit(" (moved)")).alias("org_name"), "lat", "lon",
        F.lit(t2).cast("timestamp_ntz").alias("synced_at"), F.lit(2).alias("seq"))
    v3 = base.where(F.col("s_acctbal") > 8000).select(
        "org_id", F.concat(F.col("org_name"), F.lit(" (renamed)")).alias("org_name"), "lat", "lon",
        F.lit(t2).cast("timestamp_ntz").alias("synced_at"), F.lit(3).alias("seq"))
    return [v1, v2, v3]


def latest_by_key(spark: SparkSession, data_dir: str) -> DataFrame:
    """AGG-5 + DML-4: latest outlet record per id over three syncs."""
    v1, v2, v3 = _outlet_versions(spark, data_dir)
    return latest.latest_by_key(v1.unionByName(v2).unionByName(v3), ["org_id"], ["synced_at", "seq"])


def add_column_default(spark: SparkSession, data_dir: str) -> DataFrame:
    """SCH-2 + SCH-5: a column added later reads as its stored default in old rows and as written in new ones,
    for whoever opens the table afterwards."""
    rows = fixtures.sales_raw(spark, data_dir)
    schema = template.mart_schema(P.SALES_MART_TEMPLATE, convert_currency=False)
    first = _mart_spec(spark, schema, "defaults")
    early, late = F.col("OpenDate_Typed") < F.lit(P.REPLACE_FROM), F.col("OpenDate_Typed") >= F.lit(P.REPLACE_FROM)
    mart.create_mart(spark, first, rows.where(early))
    wider = T.StructType([*schema.fields, T.StructField("currency", T.StringType()), T.StructField("rate", T.DoubleType())])
    mart.add_columns(spark, first, wider, {"currency": "RUB"})
    found = mart.open_mart(spark, first.path)
    fresh = rows.where(late).withColumn("currency", F.when(F.col("DishAmountInt") > 25, F.lit("GEL"))).withColumn("rate", F.lit(2.5))
    mart.write_rows(fresh, found)
    return mart.read_mart(spark, mart.open_mart(spark, first.path)).select("UniqOrderId_Id", "DishId", "OpenDate_Typed", "currency", "rate")


def registry() -> dict[str, Query]:
    return {
        "report_sales": report_sales,
        "report_transactions": report_transactions,
        "fx_convert": fx_convert,
        "fx_exact": fx_exact,
        "fx_register": fx_register,
        "normalize_names": normalize_names,
        "dropped_fields": dropped_fields,
        "coerce_types": coerce_types,
        "fill_defaults": fill_defaults,
        "quarantine": quarantine,
        "load_summary": load_summary,
        "fx_landed": fx_landed,
        "load_pipeline": load_pipeline,
        "load_rejects": load_rejects,
        "load_unknown_fields": load_unknown_fields,
        "replace_range": replace_range,
        "dataset_profile": dataset_profile,
        "dataset_info": dataset_info,
        "dataset_columns": dataset_columns,
        "partition_sizes": partition_sizes,
        "hot_partition_files": hot_partition_files,
        "reorganize_check": reorganize_check,
        "reorganize_switch": reorganize_switch,
        "task_details": task_details,
        "task_filter": task_filter,
        "source_categories": source_categories,
        "category_counts": category_counts,
        "bulk_update": bulk_update,
        "insert_if_absent": insert_if_absent,
        "upsert": upsert,
        "task_search": task_search,
        "config_ingest": config_ingest,
        "name_clash": name_clash,
        "multi_source_window": multi_source_window,
        "task_coverage": task_coverage,
        "date_chunks": date_chunks,
        "outlet_reference": outlet_reference,
        "outlet_responses": outlet_responses,
        "outlet_stations": outlet_stations,
        "outlet_summary": outlet_summary,
        "cluster_centroids": cluster_centroids,
        "weather_requests": weather_requests,
        "weather_explode": weather_explode,
        "weather_by_outlet": weather_by_outlet,
        "weather_table": weather_table,
        "outlet_table": outlet_table,
        "latest_by_key": latest_by_key,
        "add_column_default": add_column_default,
    }
