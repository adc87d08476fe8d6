"""Input shapes derived from the benchmark tables.

The engine's real inputs are landed report files, a rate table, config
tables and outlet/weather responses. For tests and the bench they are
derived from the generated tables by plain arithmetic, so every derived
input grows with the data. ``salesmart.plans.oracle`` holds the same
derivations in SQL.
"""

from __future__ import annotations

import datetime as dt
from itertools import groupby
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs as files_of
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesmart.operators.catalog import CONFIG_SOURCE_KEY, CONFIG_TARGET_KEY, CONFIG_TEMPLATE_KEY
from salesmart.operators.weather import WEATHER_FIELDS
from salesmart.sources.landed import ORG_SCHEMA
from salesmart.sources.tables import read_table

# Currency code written on a sales row, chosen by l_suppkey % 6.
# Mixed case, padding and unknown/empty codes exercise the normalisation rules.
ROW_CURRENCY_CODES = ["RUB", "GEL", "amd", " KGS ", "USD", ""]

# Calendar of the derived rate table.
RATES_FIRST_DAY = dt.date(1994, 12, 1)
RATES_LAST_DAY = dt.date(2001, 12, 31)

# Anchor of the 7-day request chunks of the landed report files.
LANDING_ANCHOR = dt.date(1995, 1, 1)
LANDING_CHUNK_DAYS = 7


def _q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


CURRENCY_SQL = "element_at(array(" + ", ".join(_q(c) for c in ROW_CURRENCY_CODES) + \
    f"), CAST(l_suppkey % {len(ROW_CURRENCY_CODES)} + 1 AS INT))"
# price * (1 - discount) in exact decimal arithmetic
DISCOUNTED_SQL = "CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))) AS DECIMAL(18,4))"


def _sales_join(spark: SparkSession, data_dir: str) -> DataFrame:
    li = read_table(spark, data_dir, "lineitem", [
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "l_extendedprice", "l_discount", "l_shipdate"])
    s = read_table(spark, data_dir, "supplier", ["s_suppkey", "s_name", "s_nationkey"])
    p = read_table(spark, data_dir, "part", ["p_partkey", "p_type"])
    return li.join(s, li.l_suppkey == s.s_suppkey).join(p, li.l_partkey == p.p_partkey)


def sales_raw(spark: SparkSession, data_dir: str) -> DataFrame:
    """Typed sales report rows, one per line item (SALES report shape)."""
    return _sales_join(spark, data_dir).selectExpr(
        "CAST(l_shipdate AS DATE) AS OpenDate_Typed",
        "s_name AS Department",
        "p_type AS DishGroup",
        "CAST(p_partkey AS STRING) AS DishId",
        "CAST(l_orderkey AS STRING) AS UniqOrderId_Id",
        f"{CURRENCY_SQL} AS Currencies_Currency",
        "l_extendedprice AS DishSumInt",
        "l_quantity AS DishAmountInt",
        f"{DISCOUNTED_SQL} AS DishDiscountSumInt",
        "concat('http://src', CAST(s_nationkey AS STRING)) AS url",
    )


def transactions_raw(spark: SparkSession, data_dir: str) -> DataFrame:
    """Typed receipt rows (TRANSACTIONS report shape), one per order."""
    o = read_table(spark, data_dir, "orders", [
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"])
    return o.selectExpr(
        "CAST(o_orderdate AS DATE) AS DateTime_DateTyped",
        "concat('Store#', CAST(o_custkey % 7 AS STRING)) AS Department",
        "o_orderstatus AS TransactionType",
        "o_orderpriority AS Product_Category",
        "o_totalprice AS Sum_Incoming",
        "concat('http://src', CAST(o_custkey % 25 AS STRING)) AS url",
    )


def rates(spark: SparkSession) -> DataFrame:
    """Wide daily rate table (date, rub, gel, amd, kgs) with gaps and nulls.

    Weekends (day number % 7 in 5, 6) and a 31-day gap every 400 days are
    missing, gel is null every 11th day, amd every 13th day.
    """
    first, last = RATES_FIRST_DAY.isoformat(), RATES_LAST_DAY.isoformat()
    return spark.sql(f"""
        SELECT date,
               CAST(1 AS DECIMAL(12,6)) AS rub,
               CASE WHEN n % 11 = 0 THEN NULL ELSE CAST((1400 + n % 50) / 100 AS DECIMAL(12,6)) END AS gel,
               CASE WHEN n % 13 = 0 THEN NULL ELSE CAST((200 + n % 30) / 1000 AS DECIMAL(12,6)) END AS amd,
               CAST((80 + n % 20) / 100 AS DECIMAL(12,6)) AS kgs
        FROM (SELECT date, datediff(date, DATE'{first}') AS n
              FROM (SELECT explode(sequence(DATE'{first}', DATE'{last}')) AS date))
        WHERE n % 7 NOT IN (5, 6) AND NOT (n % 400 BETWEEN 200 AND 230)""")


# 68423.46 -> '68 423,46' (space between thousands, comma decimal point)
MONEY_TEXT_SQL = """concat(
  CASE WHEN units >= 1000
       THEN concat(CAST(CAST(floor(units / 1000) AS BIGINT) AS STRING), ' ', lpad(CAST(units % 1000 AS STRING), 3, '0'))
       ELSE CAST(units AS STRING) END,
  ',', lpad(CAST(cents % 100 AS STRING), 2, '0'))"""


def sales_messy(spark: SparkSession, data_dir: str) -> DataFrame:
    """Landed sales report rows as text, with source field names.

    Names carry ``.``/``-``; values mix number formats, date formats and
    junk; ``_source`` is the configured address of the source that
    produced the file and ``_chunk_from``/``_chunk_to`` its request range.
    """
    anchor = LANDING_ANCHOR.isoformat()
    k = LANDING_CHUNK_DAYS
    base = _sales_join(spark, data_dir).selectExpr(
        "*", "l_orderkey % 4 AS k4",
        "CAST(CAST(l_shipdate AS DATE) AS STRING) AS day_text",
        "concat(CAST(CAST(l_shipdate AS DATE) AS STRING), 'T', lpad(CAST(l_linenumber AS STRING), 2, '0'), ':30:15') AS clock",
        "CAST(round(l_extendedprice * 100, 0) AS BIGINT) AS cents",
        "CAST(floor(CAST(round(l_extendedprice * 100, 0) AS BIGINT) / 100) AS BIGINT) AS units",
        f"date_add(DATE'{anchor}', CAST(floor(datediff(CAST(l_shipdate AS DATE), DATE'{anchor}') / {k}) * {k} AS INT)) AS cf",
    )
    return base.selectExpr(
        "CASE k4 WHEN 0 THEN day_text WHEN 1 THEN clock WHEN 2 THEN concat(clock, '.250') "
        "ELSE '29.02.2000' END AS `OpenDate.Typed`",
        "CASE WHEN l_linenumber = 6 THEN '' WHEN k4 = 0 THEN clock WHEN k4 = 1 THEN concat(clock, '.5') "
        "WHEN k4 = 2 THEN concat(clock, 'Z') ELSE concat(clock, '.1234567') END AS CloseTime",
        "CASE WHEN l_linenumber = 5 THEN '' ELSE s_name END AS Department",
        "p_type AS DishGroup",
        "CAST(p_partkey AS STRING) AS DishId",
        "CAST(l_orderkey AS STRING) AS `UniqOrderId.Id`",
        f"{CURRENCY_SQL} AS `Currencies.Currency`",
        "CASE WHEN l_linenumber = 7 THEN '' WHEN l_quantity = 13 THEN 'abc' WHEN l_quantity = 17 THEN '1d' "
        f"ELSE {MONEY_TEXT_SQL} END AS DishSumInt",
        "CAST(l_quantity AS STRING) AS DishAmountInt",
        f"CAST({DISCOUNTED_SQL} AS STRING) AS DishDiscountSumInt",
        "'x' AS `Extra-Field`",
        "'ignored' AS url",
        "concat('src', CAST(s_nationkey AS STRING)) AS _source",
        "cf AS _chunk_from",
        f"date_add(cf, {k - 1}) AS _chunk_to",
    )


def sales_landed(spark: SparkSession, data_dir: str) -> DataFrame:
    """Typed rows as several connections landed them, each on its own request chunks.

    A source's chunks start ``nation % 7`` days off the window's grid; rows of
    line 7 are dated past the chunk they came with; lines 5 and 6 carry very
    small and very large amounts; every third source has a currency of its own.
    """
    anchor, k = LANDING_ANCHOR.isoformat(), LANDING_CHUNK_DAYS
    conn = sources(spark, data_dir).selectExpr("id AS _sid", "currency AS _currency")
    rows = _sales_join(spark, data_dir)
    rows = rows.join(conn, rows.s_nationkey == conn._sid)
    start = f"date_add(DATE'{anchor}', CAST(s_nationkey % 7 AS INT))"
    rows = rows.selectExpr("*", "CAST(l_shipdate AS DATE) AS _day").selectExpr(
        "*", f"date_add({start}, CAST(floor(datediff(_day, {start}) / {k}) * {k} AS INT) - CASE WHEN l_linenumber = 7 THEN {k} ELSE 0 END) AS _chunk_from")
    return rows.selectExpr(
        "_day AS OpenDate_Typed", "CAST(l_orderkey AS STRING) AS UniqOrderId_Id", "l_linenumber AS line",
        f"{CURRENCY_SQL} AS Currencies_Currency",
        "CASE WHEN s_nationkey % 3 = 0 THEN _currency ELSE '' END AS connection_currency",
        "CASE l_linenumber WHEN 5 THEN 0.00004D WHEN 6 THEN 2.0E14D + l_quantity ELSE l_extendedprice END AS DishSumInt",
        "concat('http://src', CAST(s_nationkey AS STRING)) AS url", "_chunk_from", f"date_add(_chunk_from, {k - 1}) AS _chunk_to")


# Length that the line of every 97th part's rows is cut off at, and the field that only some records have.
CUT_LINE = 70
LANDED_ORDER = ["OpenDate.Typed", "CloseTime", "Department", "DishGroup", "DishId", "UniqOrderId.Id", "Currencies.Currency", "DishSumInt",
                "DishAmountInt", "DishDiscountSumInt", "Extra-Field", "url"]


def write_landed_lines(spark: SparkSession, data_dir: str, path: str) -> None:
    """SRC-1 input: the landed report rows as JSON lines, one folder per source.

    Records of every fifth order have one more field, named after the part; the
    lines of every 97th part are cut off.
    """
    rows = sales_messy(spark, data_dir)
    fields = ", ".join(f"'{c}', `{c}`" for c in LANDED_ORDER)
    record = f"""map_concat(map({fields}, 'chunk_from', CAST(_chunk_from AS STRING), 'chunk_to', CAST(_chunk_to AS STRING)),
        CASE WHEN CAST(`UniqOrderId.Id` AS BIGINT) % 5 = 0 THEN map(concat('Guest.Num-', CAST(CAST(DishId AS BIGINT) % 3 AS STRING)), '2')
             ELSE CAST(map() AS MAP<STRING, STRING>) END)"""
    lines = rows.selectExpr("_source AS source", "DishId", f"to_json({record}) AS line").selectExpr(
        "source", f"CASE WHEN CAST(DishId AS BIGINT) % 97 = 0 THEN left(line, {CUT_LINE}) ELSE line END AS value")
    lines.write.partitionBy("source").text(path, compression="gzip")


def write_config_files(spark: SparkSession, data_dir: str, path: str) -> None:
    """SRC-6 input: one config document per customer, in a folder per region, written by Spark.

    Every fifth lacks a section, every seventh is cut off, every eleventh lies
    in a folder of temporary files, every thirteenth is no ``.json`` file.
    Documents have line breaks, so each is one only as a whole file.
    """
    c = read_table(spark, data_dir, "customer", ["c_custkey", "c_nationkey"])
    n, r = read_table(spark, data_dir, "nation"), read_table(spark, data_dir, "region")
    rows = c.join(n, c.c_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey).selectExpr(
        "c_custkey AS k", "translate(lower(n_name), ' _', '--') AS nation", "translate(lower(r_name), ' _', '--') AS region")
    sections = [f"""concat('"{CONFIG_SOURCE_KEY}": {{"api_url": "http://src', k, '", "login": "user', k, '"}},')""",
                f"""CASE WHEN k % 5 = 0 THEN '' ELSE concat('"{CONFIG_TARGET_KEY}": {{"host": "mart', k % 5, '.local", "port": "9000", "user": "loader"}},') END""",
                f"""concat('"{CONFIG_TEMPLATE_KEY}": {{"reportType": "', CASE WHEN k % 2 = 1 THEN 'SALES' ELSE 'TRANSACTIONS' END, '", "groupByRowFields": ["Department"]}}')"""]
    docs = rows.selectExpr("CASE WHEN k % 11 = 0 THEN 'temp' ELSE region END AS folder",
                           "concat('sales_', nation, '-', k, CASE WHEN k % 13 = 0 THEN '.bak' ELSE '.json' END) AS document",
                           f"concat('{{', char(10), {', char(10), '.join(sections)}, char(10), '}}') AS text", "k")
    files = docs.selectExpr("folder", "document", "CASE WHEN k % 7 = 0 THEN left(text, length(text) - 9) ELSE text END AS value")
    write_documents(files, path)


# The name Spark gives to a null or empty partition value.
NO_NAME = "__HIVE_DEFAULT_PARTITION__"


def write_documents(files: DataFrame, path: str) -> None:
    """Every document as one file ``folder=<folder>/document=<document>`` below ``path``, written by the tasks.

    Rows of one document are its lines; names are escaped as in Spark's own
    partition folders. A file gets its name when it is whole, so an attempt of a
    task that is ended leaves hidden files only.
    """
    uri = path if "://" in path else f"file://{quote(path)}"

    def run(batches):
        store, root = files_of.FileSystem.from_uri(uri)
        attempt, made, n = TaskContext.get().taskAttemptId(), set(), 0
        rows = (row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns), strict=True))
        for (folder, document), lines in groupby(rows, key=lambda row: row[:2]):
            at = f"{root}/folder={quote(folder or NO_NAME, safe='')}"
            if at not in made:
                store.create_dir(at)
                made.add(at)
            name = f"document={quote(document or NO_NAME, safe='')}"
            with store.open_output_stream(f"{at}/.{attempt}.{n}") as out:
                for _, _, value in lines:
                    out.write((value or "").encode() + b"\n")
            store.move(f"{at}/.{attempt}.{n}", f"{at}/{name}")
            n += 1
        yield pa.record_batch([pa.array([n], pa.int64())], names=["n"])

    # documents dealt over the writers, the lines of one side by side
    dealt = files.select(F.coalesce("folder", F.lit("")).alias("folder"), F.coalesce("document", F.lit("")).alias("document"), "value")
    dealt.repartition("folder", "document").sortWithinPartitions("folder", "document").mapInArrow(run, "n long").agg(F.sum("n")).collect()


# ---------------------------------------------------------------------------
# Configuration tables (tasks, sources, targets, templates, categories)


def categories(spark: SparkSession, data_dir: str) -> DataFrame:
    """Categories from ``region``; region 4 is left without sources."""
    return read_table(spark, data_dir, "region").selectExpr(
        "r_regionkey AS id", "r_name AS name", "concat('Stores of ', r_name) AS description",
        "r_regionkey <> 3 AS is_active")


def sources(spark: SparkSession, data_dir: str) -> DataFrame:
    """Report sources (connections) from ``nation``."""
    return read_table(spark, data_dir, "nation").selectExpr(
        "n_nationkey AS id", "n_name AS name",
        "CASE WHEN n_nationkey % 2 = 0 THEN concat('http://src', CAST(n_nationkey AS STRING)) "
        "ELSE concat('src', CAST(n_nationkey AS STRING)) END AS api_url",
        "concat('user', CAST(n_nationkey AS STRING)) AS login",
        "CASE WHEN n_nationkey % 4 = 0 THEN 'GEL' ELSE 'RUB' END AS currency",
        "CASE WHEN n_regionkey = 4 THEN CAST(NULL AS INT) ELSE n_regionkey END AS category_id",
        "n_nationkey % 3 <> 1 AS load_weather",
        "CASE n_nationkey % 5 WHEN 0 THEN CAST(NULL AS STRING) WHEN 1 THEN '' "
        "ELSE concat('key', lpad(CAST(n_nationkey AS STRING), 4, '0'), 'abcdef') END AS cloud_api_key")


def targets(spark: SparkSession, data_dir: str) -> DataFrame:
    """Mart targets from ``region``."""
    return read_table(spark, data_dir, "region").selectExpr(
        "r_regionkey AS id", "concat('target-', CAST(r_regionkey AS STRING)) AS name",
        "concat('mart', CAST(r_regionkey AS STRING), '.local') AS host",
        "9000 AS port", "'loader' AS user", "'default' AS storage_policy")


def templates(spark: SparkSession, data_dir: str) -> DataFrame:
    """Report templates, one per customer market segment; the id comes from the name's length and first letter."""
    seg = read_table(spark, data_dir, "customer", ["c_mktsegment"]).selectExpr("lower(c_mktsegment) AS name").distinct()
    return seg.selectExpr("length(name) * 1000 + ascii(name) AS id", "name", "'SALES' AS report_type")


def tasks(spark: SparkSession, data_dir: str) -> DataFrame:
    """Load tasks from ``customer``: source = nation, template = segment."""
    c = read_table(spark, data_dir, "customer", ["c_custkey", "c_name", "c_nationkey", "c_mktsegment"])
    t = templates(spark, data_dir).withColumnRenamed("name", "t_name").withColumnRenamed("id", "t_id")
    j = c.join(t, F.lower(c.c_mktsegment) == t.t_name)
    return j.selectExpr(
        "concat('task-', CAST(c_custkey AS STRING)) AS id",
        "c_name AS name",
        "c_nationkey AS source_id",
        "CAST(c_custkey % 6 AS INT) AS target_id",
        "t_id AS template_id",
        "concat('mart.', t_name, '_', CAST(c_nationkey AS STRING)) AS dataset_name",
        "CAST(7 + c_custkey % 30 AS INT) AS days_offset_start",
        "CAST(c_custkey % 5 AS INT) AS days_offset_end",
        "c_custkey % 4 <> 0 AS is_active")


# ---------------------------------------------------------------------------
# Outlets and weather responses

# Fixed value: day that splits weather history from forecast in the fixture.
WEATHER_AS_OF = dt.date(2024, 1, 20)
WEATHER_LOCATIONS = 10


def outlets(spark: SparkSession, data_dir: str) -> DataFrame:
    """Outlet records as the outlet service returns them, from ``supplier``."""
    s = read_table(spark, data_dir, "supplier", ["s_suppkey", "s_name", "s_nationkey", "s_acctbal"])
    return s.selectExpr(
        "concat('org-', CAST(s_suppkey AS STRING)) AS id",
        "s_nationkey AS source_id",
        "s_suppkey AS seq",
        "concat('  ', s_name, ' ') AS name",
        "CASE WHEN s_suppkey % 9 = 0 THEN CAST(NULL AS STRING) ELSE CAST(s_suppkey % 1000 AS STRING) END AS code",
        "CASE WHEN s_suppkey % 5 = 0 THEN CAST(NULL AS STRING) "
        "ELSE concat(' Street ', CAST(s_nationkey AS STRING), ' ') END AS restaurantAddress",
        "concat('Country ', CAST(s_nationkey % 3 AS STRING)) AS country",
        "CASE WHEN s_suppkey % 17 = 0 THEN 0.0D ELSE 55.0D + (s_suppkey % 20) * 0.02D END AS latitude",
        "CASE WHEN s_suppkey % 17 = 0 THEN 0.0D ELSE 37.0D + (s_suppkey % 7) * 0.03D END AS longitude",
        "concat('77', lpad(CAST(s_suppkey AS STRING), 8, '0')) AS inn",
        "CASE WHEN s_suppkey % 4 = 0 THEN CAST(NULL AS STRING) WHEN s_suppkey % 4 = 1 THEN 'GEL' "
        "ELSE 'RUB' END AS currencyIsoName",
        "CASE WHEN s_suppkey % 3 = 0 THEN 'CourierAndSelfService' ELSE 'SelfServiceOnly' END AS deliveryServiceType",
        "concat('8.', CAST(s_suppkey % 4 AS STRING)) AS version",
        "s_acctbal",
    )


# Outlets of one response of the outlet service.
OUTLETS_A_RESPONSE = 100


def write_outlet_responses(spark: SparkSession, data_dir: str, path: str) -> None:
    """SRC-3 input: responses of at most so many outlets, one JSON document per line, in a folder per connection."""
    fields = [f.name for f in ORG_SCHEMA.fields]
    pages = outlets(spark, data_dir).groupBy("source_id", F.expr(f"floor(seq / {OUTLETS_A_RESPONSE})").alias("page")).agg(
        F.sort_array(F.collect_list(F.struct(*fields))).alias("organizations"))
    pages.selectExpr("source_id", "to_json(struct(organizations)) AS value").repartition("source_id").write.partitionBy("source_id").text(path)


def weather_daily(spark: SparkSession, data_dir: str) -> DataFrame:
    """Daily weather per location from ``events``: location = user_id % 10."""
    e = read_table(spark, data_dir, "events", ["ts", "user_id", "value"])
    return (e.selectExpr(f"CAST(user_id % {WEATHER_LOCATIONS} AS INT) AS location", "CAST(ts AS DATE) AS day",
                         "CAST(value AS DECIMAL(12,2)) AS v", "value")
            .groupBy("location", "day")
            .agg(F.expr("CAST(sum(v) AS DOUBLE) / CAST(count(1) AS DOUBLE)").alias("temperature_2m_mean"),
                 F.expr("min(value)").alias("temperature_2m_min"),
                 F.expr("max(value)").alias("temperature_2m_max"),
                 F.expr("CAST(sum(v) AS DOUBLE)").alias("precipitation_sum"),
                 F.expr("CAST(count(1) AS DOUBLE)").alias("cloud_cover_mean"),
                 F.expr("max(value) - min(value)").alias("wind_speed_10m_max")))


WEATHER_VARS = list(WEATHER_FIELDS)


def weather_responses(spark: SparkSession, data_dir: str) -> DataFrame:
    """Weather service responses: one per location and part (history /
    forecast), daily variables as parallel arrays ordered by day.

    A response covers one location over at most the requested days, so its
    arrays are bounded by the window length. The forecast of location 7
    arrives with a short wind array and must be rejected whole.
    """
    d = weather_daily(spark, data_dir).selectExpr(
        "*", f"CASE WHEN day < DATE'{WEATHER_AS_OF}' THEN 'history' ELSE 'forecast' END AS part")
    packed = d.groupBy("location", "part").agg(
        F.expr(f"array_sort(collect_list(struct(day, {', '.join(WEATHER_VARS)})))").alias("days"))
    arrays = [f"days.{v} AS {v}" for v in WEATHER_VARS if v != "wind_speed_10m_max"]
    wind = ("CASE WHEN location = 7 AND part = 'forecast' THEN slice(days.wind_speed_10m_max, 1, size(days) - 1) "
            "ELSE days.wind_speed_10m_max END AS wind_speed_10m_max")
    return packed.selectExpr(
        "location", "part",
        f"struct(transform(days, x -> CAST(x.day AS STRING)) AS time, {', '.join(arrays)}, {wind}) AS daily")
